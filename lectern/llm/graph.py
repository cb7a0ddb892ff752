"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.tables import drop, spread_join, stored

#: A graph whose longest shortest path has n nodes needs about log n rounds.
ROUNDS = 60


def stars(edges: DataFrame) -> DataFrame:
    """(node, root): every node of ``edges`` (a long, b long) but roots, with the least node of its component.

    Self loops and repeated edges change nothing. Tables between rounds lie in the shared folder. Rows of a
    node with many neighbours are dealt to several tasks.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct())
    before = None
    for _ in range(ROUNDS):
        both = now.unionByName(now.select(F.col("root").alias("node"), F.col("node").alias("root")))
        hashes = F.sum(F.xxhash64(F.least("node", "root"), F.greatest("node", "root")).cast("decimal(20,0)"))
        state = both.groupBy("node").agg(F.count("*").alias("c"), hashes.alias("h")).agg(F.max("c"), F.sum("c"), F.sum("h")).first()
        if state[1:] == before:
            return now
        before, most = state[1:], state[0]
        around = both.groupBy("node").agg(F.least(F.min("root"), F.col("node")).alias("least"))
        # large star: every neighbour above a node goes to the least of its neighbours and itself
        above = spread_join(both.where("root > node"), around, "node", "root", most)
        large = stored(above.select(F.col("root").alias("node"), F.col("least").alias("root")).where("node <> root").distinct())
        # small star: a node and its neighbours below go to the least of them
        under = large.groupBy("node").agg(F.min("root").alias("least"))
        below = spread_join(large, under, "node", "root", most)
        after = stored(below.select(F.col("root").alias("node"), F.col("least").alias("root")).where("node <> root").unionByName(under.select("node", F.col("least").alias("root"))).distinct())
        drop(now)
        drop(large)
        now = after
    raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
