"""Mixing sources to target weights by Poisson replication, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sources whose statistics may be broadcast; with more, they are joined by shuffle.
BROADCAST_SOURCES = 50_000
#: Mean of one Poisson draw at most.
MEAN = 64


def uniform(id_col: Column, seed: int, draw: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of md5(seed:id), or of md5(seed:id:draw) in draws from 1 on."""
    text = F.concat(F.lit(f"{seed}:"), id_col, F.when(draw > 0, F.concat(F.lit(":"), draw.cast("string"))).otherwise(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson_cdf(mean: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... of a Poisson distribution, as far as 12 deviations and 20 beyond its mean."""
    top = (mean + 12 * F.sqrt(mean) + 20).cast("int")
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("c"))
    return F.aggregate(
        F.sequence(F.lit(1), top),
        start,
        lambda s, k: F.struct((s.p * mean / k).alias("p"), F.concat(s.c, F.array(F.element_at(s.c, -1) + s.p * mean / k)).alias("c")),
        lambda s: s.c,
    )


def mix(docs: DataFrame, weights: dict[str, float] | None = None, *, total: float = 1.0, seed: int = 17, max_rate: float | None = None, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Each document as many times as a Poisson draw says, in an order that mixes all sources.

    A source's mean repetition rate is target rows / its rows, where target rows are its share of the
    weights times ``total`` times all rows; ``max_rate`` bounds it only where it is given. Without weights every
    source weighs alike; a source that ``weights`` lacks weighs 0, and a null source is a source of its own, which
    weighs 0 unless ``weights`` has the key None. The draw inverts the distribution at a number
    hashed from seed and id; a mean beyond MEAN is the sum of several draws of equal means, which has the same
    distribution. The same row gets the same count on every run, whichever task reads it,
    and rows of one id get one count each. A row without an id goes by its text (a null text is an empty one), so that
    equal texts without ids share a draw and others have their own. Columns of docs stay, whatever their names; ``mix_copy`` (from 1) and
    ``mix_order`` (hash by which rows are sorted) are new and replace columns of those names. Empty in, empty out.
    """
    spark = docs.sparkSession
    own = "_mix"
    while any(c.lower().startswith(own) for c in docs.columns):
        own += "_"
    name = lambda c: f"{own}{c}"
    col = lambda c: F.col(name(c))
    counts = docs.groupBy(F.col(source_col).alias(name("source"))).agg(F.count("*").alias(name("rows")))
    if weights is None:
        counts = counts.withColumn(name("weight"), F.lit(1.0))
    else:
        given = spark.createDataFrame([(k, float(v)) for k, v in weights.items()], f"{name('key')} string, {name('weight')} double")
        counts = counts.join(given, col("source").cast("string").eqNullSafe(col("key")), "left").select(name("source"), name("rows"), F.coalesce(col("weight"), F.lit(0.0)).alias(name("weight")))
    sums = counts.agg(F.sum(name("rows")).alias(name("all")), F.sum(name("weight")).alias(name("sum")))
    rate = F.coalesce(F.lit(float(total)) * col("all") * col("weight") / F.nullif(col("sum"), F.lit(0.0)) / col("rows"), F.lit(0.0))
    rate = rate if max_rate is None else F.least(F.lit(float(max_rate)), rate)
    # one row of totals, so this join is a broadcast of that row
    rates = counts.crossJoin(F.broadcast(sums)).select(name("source"), rate.alias(name("rate")))
    rates = rates.withColumn(name("draws"), F.greatest(F.lit(1), F.ceil(col("rate") / MEAN)).cast("int"))
    rates = rates.withColumn(name("cdf"), poisson_cdf(col("rate") / col("draws"))).drop(name("rate"))
    if counts.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    named = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"))) if text_col in docs.columns else F.lit("null"))
    kept = docs.join(rates, docs[source_col].eqNullSafe(rates[name("source")]))
    below = lambda u: F.size(F.filter(name("cdf"), lambda c: c <= u))
    n = F.when(col("draws") == 1, below(col("u"))).otherwise(F.aggregate(F.sequence(F.lit(1), col("draws") - 1), below(col("u")), lambda s, j: s + below(uniform(named, seed, j))))
    drawn = kept.withColumn(name("u"), uniform(named, seed, F.lit(0))).withColumn(name("n"), n)
    columns = [F.col(f"`{c}`") for c in docs.columns if c not in ("mix_copy", "mix_order")]
    copies = drawn.where(col("n") > 0).select(*columns, named.alias(name("id")), F.explode(F.sequence(F.lit(1), col("n"))).alias("mix_copy"))
    order = F.md5(F.concat_ws(":", F.lit(f"order {seed}"), col("id"), F.col("mix_copy").cast("string")).cast("binary"))
    return copies.withColumn("mix_order", order).drop(name("id")).orderBy("mix_order")
