"""A stored library of book graphs: only books whose sections changed are merged again.

Each run writes the books it merged to a folder of its own, and then a list of all books with the run that has each. The list is
renamed into place last; readers and the next run go by the newest list, so a run that dies changes nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators import levels
from lectern.operators.fixpoint import stored
from lectern.sources.files import exists

LISTED = "graph string, digest string, run string"


def _system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path
    return at, at(path).getFileSystem(spark._jsc.hadoopConfiguration())


def _lists(spark: SparkSession, out: str) -> list[str]:
    at, system = _system(spark, out)
    if not exists(spark, f"{out}/lists"):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(at(f"{out}/lists")))


def listed(spark: SparkSession, out: str) -> DataFrame:
    """(graph, digest, run) of the newest list; empty where there is none."""
    names = _lists(spark, out)
    return spark.read.schema(LISTED).parquet(f"{out}/lists/{names[-1]}") if names else spark.createDataFrame([], LISTED)


def books(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of all books of the newest list."""
    now = listed(spark, out)
    take = lambda name: spark.read.option("mergeSchema", False).parquet(*[f"{out}/runs/{r.run}/{name}" for r in now.select("run").distinct().collect()]).join(now.select("graph", "run"), ["graph", "run"], "left_semi").drop("run")
    return take("nodes"), take("edges")


def update(nodes: DataFrame, edges: DataFrame, sections: DataFrame, books_: DataFrame, out: str, properties: tuple[str, ...] = (), previous: DataFrame | None = None) -> tuple[dict[str, tuple[DataFrame, DataFrame]], DataFrame]:
    """(graphs of each level as levels.build() gives them, (graph) of the books that were merged in this run).

    A book is merged again where the digest of its nodes, edges, sections and own row is not the listed one; books that
    are gone leave the list. Levels above are made from the stored books.
    """
    spark = nodes.sparkSession
    digests = stored(levels.digests(nodes, edges, sections, books_))
    old = listed(spark, out)
    changed = stored(digests.join(old.select("graph", "digest"), ["graph", "digest"], "left_anti").select("graph"))
    run = f"{len(_lists(spark, out)):08d}-{uuid.uuid4().hex}"
    if not changed.isEmpty():
        of = lambda df, key="graph": stored(df.join(changed.withColumnRenamed("graph", key), key, "left_semi").select(df.columns))
        made = levels.books_of(of(nodes), of(edges), of(sections, "book_prefix"), of(books_, "book_prefix"), properties)
        for rows, name in zip(made, ("nodes", "edges"), strict=True):
            rows.withColumn("run", F.lit(run)).write.parquet(f"{out}/runs/{run}/{name}")
    kept = digests.join(old, ["graph", "digest"]).select("graph", "digest", "run")
    fresh = digests.join(changed, "graph", "left_semi").select("graph", "digest", F.lit(run).alias("run"))
    kept.unionByName(fresh).write.parquet(f"{out}/_list-{run}")
    at, system = _system(spark, out)
    system.mkdirs(at(f"{out}/lists"))
    if not system.rename(at(f"{out}/_list-{run}"), at(f"{out}/lists/{run}")):
        raise RuntimeError(f"list of run {run} could not be renamed")
    graphs = books(spark, out)
    return {"book": graphs} | levels.above(*graphs, books_, properties, previous), changed
