"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or not at all on each document. Expectation-
maximisation estimates from the agreement of all votes in the corpus how each labeller
votes on good and on bad documents. The posterior of a document's votes is its soft
label; a linear scorer over hashed word features learns from a bounded sample of these.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm import words as W
from lectern.llm.tables import drop, free, small_batches, stored

#: Distinct texts, and features of them, from which the linear scorer learns at most: those of the least hashes. EM uses all distinct texts.
TRAIN_ROWS, TRAIN_FEATURES = 6_000, 4_000_000
BUCKETS = 1 << 14
STEPS = 300
#: Features that the driver handles at once.
BLOCK = 1 << 18
LEARNING = 0.5
RIDGE = 1e-4
#: Words without any evidence that each text counts as having besides its own, so that two or three words decide little.
PRIOR_WORDS = 10

#: Labellers in the order of their votes.
LABELLERS = ("symbols", "marked_words", "capitals", "variety", "frequent_word", "repeated_lines", "short_words", "sentences", "letters")

_LOWER, _UPPER, _DIGIT, _HIGH, _STOP, _SYMBOL = range(6)


def _kinds() -> np.ndarray:
    kind = np.full(256, _SYMBOL, np.uint8)
    kind[97:123], kind[65:91], kind[48:58], kind[128:] = _LOWER, _UPPER, _DIGIT, _HIGH
    kind[[ord(c) for c in ".,;:?'\"()-"]] = _STOP
    return kind


def _word_kinds(data: np.ndarray, words: W.Words) -> np.ndarray:
    """Bytes of each kind in each word; shape (words, 6)."""
    kind = _kinds()[data]
    out = np.zeros((len(words.starts), 6), np.int64)
    if len(words.starts):
        for k in range(6):
            sums = np.concatenate([[0], np.cumsum(kind == k)])
            out[:, k] = sums[words.ends] - sums[words.starts]
    return out


def _by_row(values: np.ndarray, words: W.Words) -> np.ndarray:
    return np.bincount(words.row_of(), weights=values, minlength=len(words.first) - 1)


def votes(data: np.ndarray, bounds: np.ndarray, words: W.Words, parts: np.ndarray) -> np.ndarray:
    """Votes of all labellers on each text: 1 good, -1 bad, 0 none. Shape (texts, labellers)."""
    n = np.diff(words.first)
    some = np.maximum(1, n)
    size = parts.sum(axis=1)
    bytes_ = np.maximum(1, _by_row(size, words))
    symbols = _by_row(parts[:, _SYMBOL], words) / bytes_
    marked = _by_row(parts[:, _SYMBOL] > 0, words) / some
    cased = np.maximum(1, _by_row(parts[:, _LOWER] + parts[:, _UPPER], words))
    capitals = _by_row(parts[:, _UPPER], words) / cased
    row = words.row_of()
    order = np.lexsort((words.hashes, row))
    h, r = words.hashes[order], row[order]
    new = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (r[1:] != r[:-1]))) if len(h) else np.zeros(0, np.int64)
    times = np.diff(np.append(new, len(h)))
    distinct = np.bincount(r[new], minlength=len(n))
    most = np.zeros(len(n), np.int64)
    np.maximum.at(most, r[new], times)
    variety = distinct / some
    line = np.ones(256, bool)
    line[10] = False
    lines = W.split(data, bounds, line)
    line_row = lines.row_of()
    order = np.lexsort((lines.hashes, line_row))
    lh, lr = lines.hashes[order], line_row[order]
    again = np.bincount(lr[1:][(lh[1:] == lh[:-1]) & (lr[1:] == lr[:-1])], minlength=len(n)) if len(lh) > 1 else np.zeros(len(n))
    repeated = again / np.maximum(1, np.diff(lines.first))
    short = _by_row(size <= 3, words) / some
    last = data[words.ends - 1] if len(words.ends) else np.zeros(0, np.uint8)
    ends = _by_row((last == 46) | (last == 63), words) / some
    letters = _by_row(parts[:, _LOWER] + parts[:, _UPPER] + parts[:, _HIGH], words) / bytes_
    vote = lambda good, bad: np.where(bad, -1, np.where(good, 1, 0))
    long = n >= 20
    return np.stack([
        vote(symbols < 0.005, symbols > 0.04),
        vote(marked < 0.02, marked > 0.2),
        vote((capitals < 0.15) & (cased > 20), capitals > 0.3),
        vote((variety > 0.3) & long, (variety < 0.1) & long),
        vote((most / some < 0.12) & long, (most / some > 0.25) & long),
        vote((repeated == 0) & long, repeated > 0.3),
        vote((short > 0.15) & (short < 0.75), (short < 0.04) | (short > 0.9)),
        vote((ends > 0.02) & (ends < 0.35), (ends == 0) & long),
        vote(letters > 0.9, letters < 0.75),
    ], axis=1).astype(np.int8)


def features(data: np.ndarray, words: W.Words, parts: np.ndarray) -> np.ndarray:
    """Hashed buckets of each word, shape (3, words): the word, its shape, and its shape with the one before or, if it repeats the word before, one bucket for all such."""
    size = parts.sum(axis=1)
    level = lambda k: (parts[:, k] > 0).astype(np.uint64) + (parts[:, k] * 2 > size)
    shape = np.minimum(size, 12).astype(np.uint64)
    for k in range(6):
        shape = shape * np.uint64(3) + level(k)
    before = np.append(np.uint64(0), shape[:-1])[: len(shape)]
    same = np.append(False, words.hashes[1:] == words.hashes[:-1])[: len(shape)].astype(np.uint64)
    heads = words.first[:-1][np.diff(words.first) > 0]
    before[heads], same[heads] = 0, 0
    pair = W.mixed(shape * np.uint64(1 << 20) + before)
    half, third = np.uint64(BUCKETS // 2), np.uint64(BUCKETS // 4)
    pair = np.where(same == 1, half + third, half + third + np.uint64(1) + pair % (third - np.uint64(1)))
    return np.stack([words.hashes % half, half + W.mixed(shape) % third, pair]).astype(np.int64)


def _patterns(batches):
    """Hash of each text, and its votes as one number, base 3."""
    base = 3 ** np.arange(len(LABELLERS))
    for rows, data, bounds in W.texts(batches):
        words = W.split(data, bounds, W.not_space())
        found = votes(data, bounds, words, _word_kinds(data, words))
        yield pa.record_batch({"h": rows.column("h"), "pattern": pa.array(((found + 1) * base).sum(axis=1))})


def maximise(patterns: np.ndarray, weights: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, float, np.ndarray]:
    """EM over two classes from distinct vote patterns (rows of -1, 0, 1) and their counts.

    Returns (probability of each vote by class and labeller, share of good, posterior of good of each pattern).
    It starts from the mean vote, so that good is what most labellers call good.
    """
    good = np.clip(0.5 + 0.9 * patterns.mean(axis=1), 0.05, 0.95)
    one_hot = np.stack([patterns == v for v in (-1, 0, 1)], axis=2).astype(np.float64)
    table, share = np.zeros((2, patterns.shape[1], 3)), 0.5
    for _ in range(rounds):
        before = good
        for c, p in enumerate((1 - good, good)):
            sums = np.einsum("p,pjv->jv", p * weights, one_hot) + 0.5
            table[c] = sums / sums.sum(axis=1, keepdims=True)
        share = float((good * weights).sum() + 1) / (weights.sum() + 2)
        logs = [np.einsum("pjv,jv->p", one_hot, np.log(table[c])) for c in (0, 1)]
        good = 1 / (1 + np.exp(np.clip(logs[0] + np.log(1 - share) - logs[1] - np.log(share), -500, 500)))
        if np.abs(good - before).max(initial=0) < 1e-9:
            break
    return table, share, good


def _training(batches):
    """Hash and features of each text: buckets and their shares of its words."""
    for rows, data, bounds in W.texts(batches):
        words = W.split(data, bounds, W.not_space())
        row = np.tile(words.row_of(), 3)
        code, count = np.unique(row * BUCKETS + features(data, words, _word_kinds(data, words)).ravel(), return_counts=True)
        owner = code // BUCKETS
        value = count / (np.diff(words.first) + PRIOR_WORDS)[owner]
        first = np.searchsorted(owner, np.arange(len(rows) + 1))
        yield pa.record_batch({"h": rows.column("h"), "pattern": rows.column("pattern"), "bucket": W.lists(pa.array((code % BUCKETS).astype(np.int32)), first), "value": W.lists(pa.array(value.astype(np.float32)), first)})


def regress(row: np.ndarray, bucket: np.ndarray, value: np.ndarray, target: np.ndarray, bias: float) -> np.ndarray:
    """Weights of the buckets by logistic regression on soft targets, gradient steps with momentum; the bias is given.

    row is sorted. Features are taken in blocks of whole rows, so that beside them the driver holds little.
    """
    weights, speed = np.zeros(BUCKETS), np.zeros(BUCKETS)
    n = max(1, len(target))
    cuts = np.unique(np.searchsorted(row, row[np.arange(0, len(row), BLOCK)])) if len(row) else np.zeros(0, np.int64)
    blocks = [slice(a, b) for a, b in zip(cuts, [*cuts[1:], len(row)], strict=True)]

    def total(each) -> np.ndarray:
        out = np.zeros(BUCKETS)
        for at in blocks:
            out += np.bincount(bucket[at], weights=each(at, value[at].astype(np.float64)), minlength=BUCKETS)
        return out

    def slope(at: slice, v: np.ndarray) -> np.ndarray:
        r = row[at] - row[at.start]
        margin = np.bincount(r, weights=weights[bucket[at]] * v) + bias
        p = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        return (p - target[row[at.start] : row[at.start] + len(p)])[r] * v

    rate = LEARNING / (total(lambda at, v: v * v) / n + 1e-3)
    for _ in range(STEPS):
        step = total(slope) / n + RIDGE * weights
        speed = 0.8 * speed - rate * step * 0.05
        weights = weights + speed
    return weights


def fit(docs: DataFrame, text_col: str = "text") -> dict:
    """Model of the corpus docs: labellers' tables and share from all distinct texts; weights from a sample of them.

    A text counts once, however often it occurs, so that copies crowd out nothing. The sample is that of the
    least hashes, bounded by TRAIN_ROWS and TRAIN_FEATURES: the same table gives the same model on every run.
    Null and empty texts are one text. Without rows the model's score is 0.5 everywhere.
    """
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.xxhash64(text).alias("h"), text.alias("text"))
    # texts of one hash have one pattern, but for a chance of 2**-64; the least then counts
    distinct = stored(rows.mapInArrow(_patterns, "h long, pattern long").groupBy("h").agg(F.min("pattern").alias("pattern")))
    counts = distinct.groupBy("pattern").agg(F.count("*").alias("c")).orderBy("pattern").collect()
    code = np.array([r[0] for r in counts], np.int64)
    weight = np.array([r[1] for r in counts], np.float64)
    patterns = code[:, None] // 3 ** np.arange(len(LABELLERS)) % 3 - 1
    table, share, good = maximise(patterns, weight)
    model = {"table": table, "share": share, "weights": np.zeros(BUCKETS), "bias": 0.0}
    if len(counts):
        last = distinct.orderBy("h").limit(TRAIN_ROWS).agg(F.max("h")).first()[0]
        one = rows.where(F.col("h") <= last).groupBy("h").agg(F.min("text").alias("text"))
        got = stored(one.join(distinct, "h").mapInArrow(_training, "h long, pattern long, bucket array<int>, value array<float>"))
        sizes = sorted(tuple(r) for r in got.select("h", F.size("bucket")).collect())
        fits = max(1, int(np.searchsorted(np.cumsum([n for _, n in sizes]), TRAIN_FEATURES, "right")))
        sample = got.where(F.col("h") <= sizes[min(fits, len(sizes)) - 1][0]).toArrow().combine_chunks().sort_by("h")
        lists, values = (sample.column(c).combine_chunks() for c in ("bucket", "value"))
        target = good[np.searchsorted(code, sample.column("pattern").to_numpy())]
        row = np.repeat(np.arange(len(sample), dtype=np.int32), np.diff(lists.offsets.to_numpy()))
        # without evidence a text is as likely good as the corpus is
        model["bias"] = float(np.log(share / (1 - share)))
        model["weights"] = regress(row, lists.flatten().to_numpy(), values.flatten().to_numpy(), target, model["bias"])
        del sample, lists, values, row
        pa.default_memory_pool().release_unused()
        drop(got)
    drop(distinct)
    return model


def _score(model, column):
    def run(batches):
        weights, bias = model.value
        for rows, data, bounds in W.texts(batches, column):
            words = W.split(data, bounds, W.not_space())
            parts = _word_kinds(data, words)
            each = weights[features(data, words, parts)].sum(axis=0)
            total = _by_row(each, words) / (np.diff(words.first) + PRIOR_WORDS) + bias
            score = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
            out = rows.drop_columns([column])
            yield out.append_column("quality_score", pa.array(score)).append_column("quality_keep", pa.array(score >= 0.5))

    return run


def classify(docs: DataFrame, text_col: str = "text", model: dict | None = None) -> DataFrame:
    """docs with quality_score (0 to 1) and quality_keep (score of 0.5 or more), which replace columns of those names in any case.

    All rows and columns stay, whatever they hold. A null or empty text has no features: its score is
    the bias alone, alike for all. Equal texts have equal scores.
    """
    small_batches(docs.sparkSession)
    model = fit(docs, text_col) if model is None else model
    kept = docs.drop("quality_score", "quality_keep")
    (column,) = free(kept, "_quality_text")
    rows = kept.withColumn(column, F.col(text_col).cast("string"))
    shared = docs.sparkSession.sparkContext.broadcast((model["weights"], model["bias"]))
    schema = T.StructType([*kept.schema.fields, T.StructField("quality_score", T.DoubleType()), T.StructField("quality_keep", T.BooleanType())])
    return rows.mapInArrow(_score(shared, column), schema)
