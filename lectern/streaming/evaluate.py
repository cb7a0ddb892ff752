"""Evaluation as a stream: new question files are answered and scored as they arrive, and never twice."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lectern.operators import evaluate


def questions(spark: SparkSession, path: str) -> DataFrame:
    """A stream of question files (id, prompt, gold) with ``file``, the path that a question came from."""
    rows = spark.readStream.schema("id string, prompt string, gold array<string>").json(path)
    return rows.select("*", F.col("_metadata.file_path").alias("file"))


def run(rows: DataFrame, model: Callable[[str], str], out: str, checkpoint: str) -> StreamingQuery:
    """Scored answers, with their file, appended to Parquet under ``out``; the checkpoint remembers which files are done."""
    scored = evaluate.scored(evaluate.answered(rows, model))
    return scored.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def activity(events: DataFrame, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Counts and sums of events (ts, event_type, value) by window, with a watermark for late rows."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return timed.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
