"""Vectors of texts: a stored table that only gets the texts it lacks, and rankings from it."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.functions import measures, text
from lectern.sources.files import exists

SCHEMA = "text string, vector array<float>"
#: Models of this worker process, by name.
_MODELS: dict[str, Callable[[list[str]], Sequence]] = {}


def known(spark: SparkSession, path: str) -> DataFrame:
    """(text, vector) of the table at a path, one row a text; empty where there is none yet."""
    if not exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path).groupBy("text").agg(F.any_value("vector").alias("vector"))


def _embedded(name: str, load: Callable[[], Callable[[list[str]], Sequence]], batch: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if name not in _MODELS:  # a worker loads a model once, and only when there is a text for it
                _MODELS[name] = load()
            texts = rows.column("text").to_pylist()
            for i in range(0, len(texts), batch):
                some = texts[i : i + batch]
                vectors = [np.asarray(v, np.float32) for v in _MODELS[name](some)]
                yield pa.record_batch({"text": pa.array(some, pa.string()), "vector": pa.array(vectors, pa.list_(pa.float32()))})

    return run


def fill(texts: DataFrame, path: str, name: str, load: Callable[[], Callable[[list[str]], Sequence]], text_col: str = "text", batch: int = 256) -> DataFrame:
    """(text, vector) of the table at ``path`` after the texts it lacked were added.

    Texts are squeezed, blank ones left out, each once. ``load`` runs once in each worker process and gives a function from a
    list of texts to their vectors; ``name`` tells models apart. A run that dies has added nothing, and a rerun
    asks the model only for what is missing.
    """
    spark = texts.sparkSession
    wanted = texts.select(text.squeezed(F.col(text_col)).alias("text")).where("text <> ''").distinct()
    missing = wanted.join(known(spark, path).select("text"), "text", "left_anti")
    missing.mapInArrow(_embedded(name, load, batch), SCHEMA).write.mode("append").parquet(path)
    return known(spark, path)


def nearest(queries: DataFrame, candidates: DataFrame, vectors: DataFrame, most: int = 10) -> DataFrame:
    """(query, node, sim, rank) of the ``most`` candidates (query, node, text) most similar to the query's text (query, text).

    Ties go by node. A text without a vector has similarity 0. Each task keeps its best rows of a query before they meet.
    """
    keyed = lambda df: df.withColumn("_key", text.squeezed(F.col("text"))).drop("text")
    units = vectors.select(F.col("text").alias("_key"), measures.unit(F.col("vector")).alias("v"))
    asked = keyed(queries).join(units, "_key", "left").select("query", F.col("v").alias("q"))
    # rows of a text share its vector, so distinct pairs are scored
    rows = keyed(candidates).select("query", "node", "_key")
    pairs = rows.select("query", "_key").distinct().join(units, "_key", "left").join(asked, "query")
    scores = pairs.select("query", "_key", F.round(measures.unit_similarity(F.col("v"), F.col("q")), 9).alias("sim"))
    order = Window.partitionBy("query").orderBy(F.desc("sim"), "node")
    return rows.join(scores, ["query", "_key"]).select("query", "node", "sim", F.row_number().over(order).cast("long").alias("rank")).where(F.col("rank") <= most)
