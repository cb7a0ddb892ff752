"""Tables between rounds of an iteration, and numbers of rows in an order."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a new temporary folder where that is unset and the master local."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir names no folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="lectern-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder, so that plans stay short."""
    path = f"{folder(df.sparkSession)}/lectern-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Remove the files of a stored() table, once nothing reads it any more."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def dealt(table: DataFrame) -> DataFrame:
    """table, to be dealt by key where it is joined and not sent whole through the driver: ids pack so well that the size of files, by which Spark chooses, tells too little."""
    return table.hint("merge")


def union(tables: list[DataFrame]) -> DataFrame:
    """All rows of tables of the same columns."""
    return reduce(DataFrame.unionByName, tables)


def ranked(rows: DataFrame, *order: str | Column, name: str = "n", by: tuple[str, ...] = ()) -> DataFrame:
    """rows with their number from 1 in an order without ties, and with ``by`` within each value of these columns.

    Rows are sorted by ranges, and the counts of a value's ranges before are added: no task sorts more than a range,
    also where one value has most rows. The counts are one row a range and value.
    """
    mask = (1 << 33) - 1
    sorted_ = rows.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
    placed = stored(sorted_.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND(F.lit(mask))}))
    sizes = placed.groupBy("_part", *by).agg(F.count("*").alias("_c"), F.min("_at").alias("_first"))
    before = F.coalesce(F.sum("_c").over(Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select(F.col("_part").alias("_p"), *[F.col(b).alias(f"_{i}") for i, b in enumerate(by)], (before - F.col("_first")).alias("_start"))
    same = reduce(Column.__and__, [F.col(b).eqNullSafe(F.col(f"_{i}")) for i, b in enumerate(by)], F.col("_part") == F.col("_p"))
    numbered = placed.join(starts if by else F.broadcast(starts), same)
    return numbered.withColumn(name, F.col("_start") + F.col("_at") + 1).drop("_part", "_at", "_start", "_p", *[f"_{i}" for i in range(len(by))])
