"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of rows in one Arrow batch between Spark and a Python worker.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """The session's Arrow batches end at BATCH_BYTES: by rows alone, long texts make them large in both processes.

    Results are read after an operator returned, so this stays set. Every operator that sends texts to
    Python calls it, so that none depends on what ran before.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def free(df: DataFrame, *names: str) -> list[str]:
    """names with as many ``_`` at their ends as it takes to be no columns of df, whatever the case."""
    taken = {c.lower() for c in df.columns}
    tail = ""
    while any((n + tail).lower() in taken for n in names):
        tail += "_"
    return [n + tail for n in names]


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a new temporary folder, which only a local master can share with its tasks."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir names no folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="lectern-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def stored(df: DataFrame, *parts: str) -> DataFrame:
    """df as a Parquet table in the shared folder, in folders by ``parts``: its lineage ends there, and a lost executor costs nothing."""
    path = f"{folder(df.sparkSession)}/lectern-{uuid.uuid4().hex}"
    df.write.partitionBy(*parts).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Remove the files of a table from stored(), once nothing reads it any more."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        while "=" in path.getName():  # a folder of stored()'s parts
            path = path.getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bucketed(df: DataFrame, key: str) -> DataFrame:
    """df as a table in the shared folder, bucketed by key: joins by key move only the other side. drop_bucketed() removes it.

    df comes dealt by key in as many parts as a shuffle has, else each task writes a file a bucket.
    """
    spark = df.sparkSession
    name = f"lectern_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).option("path", f"{folder(spark)}/{name}").saveAsTable(name, format="parquet")
    return spark.table(name)


def drop_bucketed(df: DataFrame) -> None:
    """Remove a table from bucketed()."""
    (name,) = {x.rsplit("/", 2)[-2] for x in df.inputFiles()[:1]} or {None}
    drop(df)
    if name:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


#: Rows of one key that a task of a join may get before they are parted.
HOT_ROWS = 2_048


def spread_join(rows: DataFrame, table: DataFrame, key: str, other: str, most: int | None) -> DataFrame:
    """rows with the columns of table, which has one row of each key at most.

    ``most``: rows of the most frequent key. Rows of one key part by a hash of ``other``, and the table's row
    goes to each part that has rows, so that no task gets more than about HOT_ROWS rows of a key.
    """
    salts = -(-(most or 0) // HOT_ROWS)
    if salts <= 1:
        return rows.join(table, key)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(other), F.lit(salts)))
    parts = salted.select(key, "_salt").distinct().join(table, key)
    return salted.join(parts, [key, "_salt"]).drop("_salt")


def most_rows(rows: DataFrame, *columns: str) -> list[int]:
    """For each of the columns, all of one type, the number of rows of its most frequent value."""
    ends = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.col(c).alias("v")) for i, c in enumerate(columns))))
    found = rows.select(ends.alias("x")).groupBy("x").agg(F.count("*").alias("c")).groupBy("x.i").agg(F.max("c")).collect()
    most = dict(tuple(r) for r in found)
    return [most.get(i, 0) for i in range(len(columns))]
