"""Strongly connected components: trims, contracted chains, then forward and backward colours.

Most nodes of a curriculum graph lie on no cycle. Nodes without in or out edges go first, then chains and rings of nodes
with one edge in and one out become single edges by pointer doubling, and only what is left is coloured.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.operators.fixpoint import dropped, stored, union

#: A trim or a contraction that takes less than this share of the edges leaves the rest to the next step.
WORTH = 0.1


def _trimmed(edges: DataFrame) -> DataFrame:
    """edges whose source has an edge in and whose target has an edge out, again and again while it pays."""
    now, size = edges, edges.count()
    while size:
        ins, outs = now.select(F.col("target").alias("source")).distinct(), now.select(F.col("source").alias("target")).distinct()
        after = stored(now.join(ins, "source", "left_semi").join(outs, "target", "left_semi").select("source", "target"))
        left = after.count()
        if now is not edges:
            dropped(now)
        now, took, size = after, size - left, left
        if took <= WORTH * (took + left):
            break
    return now


def _chains(edges: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """(members, rings) of nodes with one edge in and one out: members (node, head, tail) between other nodes, rings (node, component); None if there are few.

    Round k knows the 2**k nodes after each, so a chain of n nodes takes log n rounds.
    """
    outs = edges.groupBy(F.col("source").alias("node")).agg(F.count("*").alias("outs"), F.min("target").alias("next"))
    ins = edges.groupBy(F.col("target").alias("node")).agg(F.count("*").alias("ins"), F.min("source").alias("before"))
    links = stored(outs.join(ins, "node").where("ins = 1 AND outs = 1").select("node", "next", "before"))
    if links.count() <= WORTH * edges.count():
        return None
    inner = links.select("node").withColumn("inner", F.lit(True))
    known = lambda end: inner.select(F.col("node").alias(end), F.col("inner").alias(f"{end}_inner"))
    first = links.join(known("next"), "next", "left").join(known("before"), "before", "left")
    now = stored(first.select("node", F.when(F.col("before_inner").isNull(), F.col("before")).alias("head"), F.col("node").alias("last"), F.col("next").alias("to"), F.col("next_inner").isNull().alias("done"), F.col("node").alias("least")))
    before = None
    while True:
        ahead = now.select(F.col("node").alias("to"), F.col("last").alias("_last"), F.col("to").alias("_to"), F.col("done").alias("_done"), F.col("least").alias("_least"))
        jump = now.where("NOT done").join(ahead, "to").select("node", "head", F.col("_last").alias("last"), F.col("_to").alias("to"), F.col("_done").alias("done"), F.least("least", "_least").alias("least"))
        after = stored(now.where("done").unionByName(jump))
        # open nodes and their least ones so far stay the same once only whole rings are open
        state = after.where("NOT done").agg(F.count("*"), F.sum(F.xxhash64("node", "least").cast("decimal(38,0)"))).first()
        dropped(now)
        now = after
        if not state[0] or tuple(state) == before:
            break
        before = tuple(state)
    ends = now.where("done").groupBy("last").agg(F.max("head").alias("_head"), F.max("to").alias("tail"))
    members = stored(now.where("done").join(ends, "last").select("node", F.col("_head").alias("head"), "tail"))
    return members, stored(now.where("NOT done").select("node", F.col("least").alias("component")))


def _coloured(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(components, edges left): those that the largest node reaching each one is in, and edges that may lie in others."""
    nodes = edges.select(F.col("source").alias("node")).unionByName(edges.select(F.col("target").alias("node"))).distinct()
    colour = stored(nodes.withColumn("colour", F.col("node")))
    news = colour
    while True:
        sent = news.join(edges, F.col("node") == F.col("source")).groupBy("target").agg(F.max("colour").alias("sent"))
        both = stored(colour.join(sent, F.col("node") == F.col("target"), "left").select("node", F.greatest("colour", "sent").alias("colour"), (F.coalesce("sent", "colour") > F.col("colour")).alias("new")))
        dropped(colour)
        colour, news = both, both.where("new").select("node", "colour")
        if news.isEmpty():
            break
    at = colour.select("node", "colour")
    mine = edges.join(at.withColumnsRenamed({"node": "source", "colour": "c"}), "source").join(at.withColumnsRenamed({"node": "target", "colour": "d"}), "target")
    inside = stored(mine.where("c = d").select("source", "target", F.col("c").alias("component")))
    # backward from the node that gave the colour, along edges of its colour
    found = [stored(at.where("node = colour").select("node", F.col("colour").alias("component")))]
    while True:
        step = found[-1].select(F.col("node").alias("target"), "component").join(inside, ["target", "component"]).select(F.col("source").alias("node"), "component").distinct()
        new = stored(step.join(union(found), ["node", "component"], "left_anti"))
        if new.isEmpty():
            break
        found.append(new)
    found = stored(union(found))
    gone = found.select(F.col("node").alias("source"))
    left = inside.select("source", "target").join(gone, "source", "left_anti").join(gone.withColumnRenamed("source", "target"), "target", "left_anti")
    return found, stored(left.select("source", "target"))


def strong(edges: DataFrame) -> DataFrame:
    """(node, component): nodes of strongly connected components of two nodes or more, and the least node of their component.

    edges: (source, target) of any one type that sorts; nulls, self loops and repeated edges count for nothing.
    """
    now = stored(edges.where("source <> target").select("source", "target").distinct())
    loops, folded, found = [], [], []
    while not (now := _trimmed(now)).isEmpty():
        chains = _chains(now)
        if chains:
            members, rings = chains
            found.append(rings)
            folded.append(members)
            inner = members.select("node").unionByName(rings.select("node"))
            ends = stored(members.select(F.col("head").alias("source"), F.col("tail").alias("target")).distinct())
            loops.append(ends.where("source = target").select(F.col("source").alias("node")))
            rest = now.join(inner.withColumnRenamed("node", "source"), "source", "left_anti").join(inner.withColumnRenamed("node", "target"), "target", "left_anti")
            now = stored(rest.select("source", "target").unionByName(ends.where("source <> target")).distinct())
        else:
            some, now = _coloured(now)
            found.append(some)
    if not found:
        return now.select(F.col("source").alias("node"), F.col("source").alias("component"))
    whole = stored(union(found).distinct())
    for members, own in zip(reversed(folded), reversed(loops), strict=True):
        # a node whose chain comes back to it has a component, if only with that chain
        alone = own.join(whole, "node", "left_anti").select("node", F.col("node").alias("component"))
        known = whole.unionByName(alone)
        h, t = known.withColumnsRenamed({"node": "head", "component": "h"}), known.withColumnsRenamed({"node": "tail", "component": "t"})
        whole = stored(known.unionByName(members.join(h, "head").join(t, "tail").where("h = t").select("node", F.col("h").alias("component"))))
    sizes = whole.groupBy("component").agg(F.min("node").alias("least"), F.count("*").alias("c")).where("c > 1")
    return whole.join(sizes, "component").select("node", F.col("least").alias("component"))
