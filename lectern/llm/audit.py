"""Filter interaction audit: what each filter removes in every order of the filters, from masks of failed filters."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Separators of words, and the marks that filter D looks for.
SPACE = " \t\n\x0b\x0c\r"
MARKS = "[#$%&*|]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Filters in the order of their bits: few words, repeated words, capitals, marks, copies.
FILTERS = "ABCDE"


def _bit(filters: str, letter: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), F.instr(F.lit(filters), letter) - 1)


def text_mask(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    bare = F.btrim(text, F.lit(SPACE))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+", -1))
    # numbers of words in a struct, so that a text is split once
    n = F.transform(F.array(words), lambda w: F.struct(F.size(w).cast("long").alias("all"), F.size(F.array_distinct(w)).cast("long").alias("distinct")))[0]
    capitals = F.length(text) - F.length(F.translate(text, UPPER, ""))
    return F.transform(
        F.array(n),
        lambda n: (n["all"] < 200).cast("int") + 2 * (100 * n["distinct"] < 50 * n["all"]).cast("int") + 4 * (100 * capitals > 3 * F.length(text)).cast("int") + 8 * text.rlike(MARKS).cast("int"),
    )[0]


def cells(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part by the filters A to E that they fail, those of quality 1 and those toxic.

    A null text is empty, a null part the empty string. Filter E fails a text that a smaller id has; a row without an id
    comes after all that have one, and of rows without one none is before another. Rows of one id and text count each.
    A document has a label if one of its rows in ``labels`` has it; null labels are none.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
        F.xxhash64(text).alias("h"), F.xxhash64(F.lit(1), text).alias("g"), text_mask(text).alias("mask"),
    )
    flag = lambda c: F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0))
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(flag("quality").alias("good"), flag("toxic").alias("toxic")).withColumn("salt", F.lit(0).cast("long"))
    # rows without an id have no labels; the salt keeps them from meeting in one task
    salted = rows.withColumn("salt", F.when(F.col("id").isNull(), F.col("h")).otherwise(F.lit(0).cast("long")))
    known = salted.join(marks, ["id", "salt"], "left").na.fill(0, ["good", "toxic"])
    kind = ["h", "g", "part", "mask", "good", "toxic"]
    each = known.groupBy(*kind, "id").agg(F.count("*").alias("n"))
    groups = each.groupBy(*kind).agg(F.sum("n").alias("n"), F.min("id").alias("first"), F.min_by("n", "id").alias("n_first"))
    # a text has as many rows here as parts and labels, however many copies
    least = F.min("first").over(Window.partitionBy("h", "g"))
    split = groups.withColumn("holders", F.when(least.isNull(), F.col("n")).when(F.col("first") == least, F.col("n_first")).otherwise(F.lit(0)))
    both = F.explode(F.array(F.struct(F.col("holders").alias("n"), F.col("mask").alias("mask")), F.struct((F.col("n") - F.col("holders")).alias("n"), (F.col("mask") + 16).alias("mask"))))
    out = split.select("part", "good", "toxic", both.alias("x")).where("x.n > 0")
    return out.groupBy("part", "x.mask").agg(F.sum("x.n").alias("n"), F.sum(F.col("x.n") * F.col("good")).alias("good"), F.sum(F.col("x.n") * F.col("toxic")).alias("toxic"))


def audit(cells_: DataFrame, filters: str = FILTERS) -> DataFrame:
    """(part, filter_order, step, filter, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for all orders of the filters.

    cells_: (part, mask, n, good, toxic), bit k of mask being filters[k]. Each cell is unpivoted to the steps of
    every order; the bit-or of the steps before tells whether an earlier filter took it. The work is that of
    parts, masks and orders, not of documents. Columns are counts of documents of the part: kept after the step, removed
    by it, failing its filter but removed before, failing its filter alone, removed with quality 1 and removed toxic;
    shapley is the number that the filter removes, over all orders. No cells, no rows.
    """
    orders = F.array(*[F.lit("".join(p)) for p in permutations(filters)])
    steps = cells_.select("*", F.explode(orders).alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(filters)))).alias("step"))
    steps = steps.withColumn("filter", F.expr("substring(filter_order, step, 1)")).withColumn("bit", _bit(filters, F.col("filter")))
    before = Window.partitionBy("part", "mask", "filter_order").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    seen = F.coalesce(F.bit_or("bit").over(before), F.lit(0))
    steps = steps.withColumns({"fails": F.col("mask").bitwiseAND(F.col("bit")) != 0, "earlier": F.col("mask").bitwiseAND(seen) != 0})
    own, again = F.col("fails") & ~F.col("earlier"), F.col("fails") & F.col("earlier")
    total = lambda rule, c="n": F.sum(F.when(rule, F.col(c)).otherwise(F.lit(0)))
    metrics = steps.groupBy("part", "filter_order", "step", "filter").agg(
        total(~F.col("fails") & ~F.col("earlier")).alias("kept"), total(own).alias("removed"), total(again).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"), total(own, "good").alias("good_lost"), total(own, "toxic").alias("toxic_lost"),
    )
    return metrics.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "filter")))
