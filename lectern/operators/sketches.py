"""Distinct names of graphs by mergeable sketches: a level's sketch is the union of those below it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a sketch's number of buckets.
BITS = 12


def error(bits: int = BITS) -> float:
    """Relative standard error of an estimate."""
    return 1.04 / 2 ** (bits / 2)


def built(rows: DataFrame, name_col: str, levels: tuple[str, ...], bits: int = BITS) -> DataFrame:
    """(level columns, sketch) of the names of each lowest graph; levels are columns of rows, the lowest first."""
    return rows.groupBy(*levels).agg(F.hll_sketch_agg(name_col, F.lit(bits)).alias("sketch"))


def estimates(sketches: DataFrame, levels: tuple[str, ...]) -> DataFrame:
    """(level, graph, names): distinct names of each graph of each level, from unions of the sketches alone."""
    out = None
    for level in levels:
        rows = sketches.groupBy(F.col(level).alias("graph")).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("names")).select(F.lit(level).alias("level"), "graph", "names")
        out = rows if out is None else out.unionByName(rows)
    return out
