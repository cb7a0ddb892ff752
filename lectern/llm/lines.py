"""Line dedup: lines that many documents hold stay in one of them, by levelled sorted runs of line hashes."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.tables import drop, folder, stored

#: Characters stripped from both ends of a line, and letters whose case does not count.
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Keys that have more than a share 1/HOT_KEYS of all lines in one batch are fewer than HOT_KEYS, so they may be broadcast.
HOT_KEYS = 20_000

_KEY = ["h", "g"]


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once a row."""
    return F.transform(F.array(value), use)[0]


def _digest(*values: Column) -> tuple[Column, Column]:
    """128 bits as two longs."""
    return F.xxhash64(*values), F.xxhash64(F.lit(1), *values)


def _split(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_keys(text: Column, min_chars: int) -> Column:
    """array<struct<at, h, g>>: place and 128-bit hash of the key of each line whose key has ``min_chars`` code points or more."""
    key = lambda line: F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)
    at = F.transform(_split(text), lambda line, i: F.struct(i.alias("at"), key(line).alias("key")))
    long = F.filter(at, lambda x: F.length(x.key) >= min_chars)
    return F.transform(long, lambda x: F.struct(x["at"].alias("at"), _digest(x.key)[0].alias("h"), _digest(x.key)[1].alias("g")))


class Runs:
    """Sorted runs of line keys in levels: (h, g, n, last), the documents of a run that hold a key and the largest id of these.

    A run is a table bucketed and sorted by its keys, so that merges and anti-joins of runs move no rows of earlier
    runs. ``fanout`` runs of a level are compacted to one of the level above, so that a key is written again once a level.
    Batches come in the order of preference: a key's holder is in the first batch that has it. Keys that a run
    knows in ``min_docs`` documents are settled, and later batches no longer add them.
    """

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 2, buckets: int | None = None):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []

    def _dropped(self, run: DataFrame, name: str) -> None:
        drop(run)
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def add(self, keys: DataFrame) -> None:
        """The keys (h, g, n, last) of a batch: anti-joined with the settled keys of all runs, then a run of their own."""
        for _, run in self:
            keys = keys.join(run.where(F.col("n") >= self.min_docs).select(*_KEY).hint("merge"), _KEY, "left_anti")
        self._place(keys, 0)

    def _place(self, rows: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(self._written(rows))
        if len(self.levels[level]) == self.fanout:
            old, self.levels[level] = self.levels[level], []
            self._place(self._merged([run for _, run in old]), level + 1)
            for name, run in old:
                self._dropped(run, name)

    def _written(self, rows: DataFrame) -> tuple[str, DataFrame]:
        name = f"lectern_run_{uuid.uuid4().hex}"
        rows.select(*_KEY, "n", "last").write.bucketBy(self.buckets, *_KEY).sortBy(*_KEY).option("path", f"{folder(self.spark)}/{name}").saveAsTable(name, format="parquet")
        return name, self.spark.table(name)

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        def two(a: DataFrame, b: DataFrame) -> DataFrame:
            both = a.join(b.select(*_KEY, F.col("n").alias("_n"), F.col("last").alias("_last")).hint("merge"), _KEY, "full")
            return both.select(*_KEY, (F.coalesce("n", F.lit(0)) + F.coalesce("_n", F.lit(0))).alias("n"), F.greatest("last", "_last").alias("last"))

        return reduce(two, reversed(runs))

    def __iter__(self):
        return (pair for level in reversed(self.levels) for pair in level)

    def known(self) -> DataFrame:
        """(h, g, n, last) of all runs; n counts up to min_docs at least, and last is the holder."""
        return self._merged([run for _, run in self])

    def clear(self) -> None:
        """Remove all runs."""
        for name, run in list(self):
            self._dropped(run, name)
        self.levels = []


def _batches(pairs: DataFrame, batches: int) -> DataFrame:
    """(batch, h, g, n, last): keys of each batch; batches are equal ranges of ids, the largest ids first, rows without an id last."""
    least, most = pairs.agg(F.min("id"), F.max("id")).first()
    width = max(1, -(-((most or 0) - (least or 0) + 1) // batches))
    batch = F.coalesce(F.floor((F.lit(most or 0) - F.col("id")) / width), F.lit(batches - 1)).cast("int")
    rows = pairs.select("id", F.explode("lines").alias("x")).select(batch.alias("batch"), "id", "x.h", "x.g")
    # a struct, so that the rows without an id count as a document
    return rows.groupBy("batch", *_KEY).agg(F.count_distinct(F.struct("id")).alias("n"), F.max("id").alias("last"))


def _hot(keys: DataFrame) -> DataFrame:
    """(h, g): the keys of batches with more than a share 1/HOT_KEYS of all lines in one of them, fewer than HOT_KEYS rows."""
    total = keys.agg(F.sum("n")).first()[0] or 0
    return keys.where(F.col("n") > total / HOT_KEYS).select(*_KEY).distinct()


def _drops(pairs: DataFrame, common: DataFrame, hot: DataFrame) -> DataFrame:
    """(a, b, drops): for each row the places, in order, of lines whose key is common and held by another document."""
    rows = pairs.select("a", "b", "id", F.explode("lines").alias("x")).select("a", "b", "id", "x.*")
    often = F.broadcast(common.join(F.broadcast(hot), _KEY, "left_semi"))
    rest = common.join(F.broadcast(hot), _KEY, "left_anti")
    found = rows.join(often, _KEY).unionByName(rows.join(F.broadcast(hot), _KEY, "left_anti").join(rest, _KEY))
    gone = found.where(~F.col("id").eqNullSafe(F.col("last")))
    return gone.groupBy("a", "b").agg(F.array_sort(F.collect_set("at")).alias("drops"))


def _without(lines: Column, drops: Column) -> Column:
    """lines but those at the places, joined: the stretches between the places, end to end."""
    stretch = lambda s, i: _let(F.struct(F.when(i == 0, 0).otherwise(s.p[i - 1] + 1).alias("start"), F.when(i == F.size(s.p), F.size(s.lines)).otherwise(s.p[i]).alias("stop")), lambda r: F.slice(s.lines, r.start + 1, r.stop - r.start))
    return _let(F.struct(lines.alias("lines"), drops.alias("p")), lambda s: F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(s.p)), lambda i: stretch(s, i))), "\n"))


def dedup(docs: DataFrame, *, min_docs: int = 5, min_chars: int = 40, batches: int = 4, fanout: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with n_lines, n_dropped and kept: the text without lines that ``min_docs`` documents or more hold, but for the largest id of these.

    A line's key is the line without white space at its ends and with A-Z in lower case; keys of fewer than
    ``min_chars`` code points are never dropped. Documents go through levelled runs of key hashes (128 bits) in
    ``batches`` ranges of ids, the largest first; see Runs. All is DataFrame functions.

    A null or empty text is one empty line. Rows of one id are one document, as are all rows without an id, which
    come after those with one. Lines repeated in a document count once, and all go or stay. Ids are integers.
    Columns of docs stay, whatever their names, but for n_lines, n_dropped and kept, which replace theirs. An empty
    table gives an empty one.
    """
    own = "_line"
    while any(c.lower().startswith(own) for c in docs.columns):
        own += "_"
    kind = docs.schema[id_col].dataType.typeName()
    if kind not in ("byte", "short", "integer", "long", "void"):
        raise TypeError(f"{id_col} holds no integers but {kind}")
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("n_lines", "n_dropped", "kept") and c not in (id_col, text_col)])
    id_, text = F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")
    a, b = _digest(id_, text)
    pairs = docs.select(a.alias("a"), b.alias("b"), id_.alias("id"), line_keys(text, min_chars).alias("lines")).where(F.size("lines") > 0)
    pairs = stored(pairs)
    keys = stored(_batches(pairs, batches), "batch")
    runs = Runs(docs.sparkSession, min_docs, fanout)
    for i in range(batches):
        runs.add(keys.where(F.col("batch") == i).drop("batch"))
    common, hot = stored(runs.known().where(F.col("n") >= min_docs)), stored(_hot(keys))
    runs.clear()
    drop(keys)
    drops = _drops(pairs, common, hot).withColumnsRenamed({"a": f"{own}_a", "b": f"{own}_b", "drops": f"{own}_drops"})
    keyed = docs.withColumns({f"{own}_a": a, f"{own}_b": b}).join(drops, [f"{own}_a", f"{own}_b"], "left")
    gone, lines = F.col(f"{own}_drops"), _split(text)
    added = {"n_lines": F.size(lines).cast("long"), "n_dropped": F.coalesce(F.size(gone), F.lit(0)).cast("long"), "kept": F.when(gone.isNull(), F.coalesce(text, F.lit(""))).otherwise(_without(lines, gone))}
    return keyed.select(*[F.col(f"`{c}`") for c in docs.columns], *[v.alias(k) for k, v in added.items()])
