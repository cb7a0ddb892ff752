"""Scores of multi-select predictions, and runs that go on where an earlier one stopped."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions.measures import parsed_answer, set_metrics

METRICS = ("exact_match", "precision", "recall", "f1")


def scored(rows: DataFrame) -> DataFrame:
    """rows with gold and raw_output, plus pred and the four metrics."""
    parsed = rows.withColumn("pred", parsed_answer(F.col("raw_output")))
    return parsed.withColumns(set_metrics(F.col("gold"), F.col("pred")))


def summary(rows: DataFrame, file_col: str = "file") -> DataFrame:
    """Count and mean metrics per file and, in the row whose file is null, over all rows; 0 where there are none."""
    parts = rows.groupBy(F.col(file_col).alias("file")).agg(F.count("*").alias("count"), *[F.sum(m).alias(m) for m in METRICS])
    total = parts.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("count"), *[F.sum(m).alias(m) for m in METRICS]).withColumn("file", F.lit(None).cast("string"))
    both = parts.withColumn("file", F.col("file").cast("string")).unionByName(total)
    return both.select("file", "count", *[F.coalesce(F.try_divide(m, "count"), F.lit(0.0)).alias(m) for m in METRICS])


def cube(rows: DataFrame, *dims: str) -> DataFrame:
    """Count and mean metrics for each combination of values of dims and for all totals over some of them, with ``level``, the grouping id.

    A bit of level, the first of dims the highest, says that the row is a total over that column, so that a null of the data
    differs from a total. Rows are summed by all of dims first, and the totals are made of these sums.
    """
    parts = rows.groupBy(*dims).agg(F.count("*").alias("count"), *[F.sum(m).alias(m) for m in METRICS])
    return parts.cube(*dims).agg(F.grouping_id().alias("level"), F.sum("count").alias("_n"), *[(F.sum(m) / F.sum("count")).alias(m) for m in METRICS]).withColumnRenamed("_n", "count")


def pending(rows: DataFrame, done: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows whose id no stored result has."""
    return rows.join(done.select(id_col).distinct(), id_col, "left_anti")


def answered(rows: DataFrame, model: Callable[[str], str], concurrency: int = 4) -> DataFrame:
    """rows with raw_output, the model's reply to their prompt; a failure becomes a marked output.

    ``model`` is called in the tasks, ``concurrency`` calls at a time in each.
    """

    def one(prompt: str) -> str:
        try:
            return model(prompt) or "__EMPTY_RESPONSE__"
        except Exception as why:  # any failure of one call is that row's result
            return f"__ERROR__ {type(why).__name__}: {why}"

    def run(frames):
        with ThreadPoolExecutor(concurrency) as calls:
            for frame in frames:
                yield frame.assign(raw_output=pd.Series(list(calls.map(one, frame["prompt"])), index=frame.index, dtype="object"))

    kept = rows.drop("raw_output")
    return kept.mapInPandas(run, T.StructType([*kept.schema.fields, T.StructField("raw_output", T.StringType())]))
