"""Language-model scores from Brown word classes.

Words that the corpus uses alike share a class: exchange clustering moves one word at a
time to the class that raises the likelihood of the class bigrams most. It runs over the
most frequent words; every other word of the corpus then takes the class that its own
neighbours make likeliest, all in one distributed pass. A token's probability mixes class
transition times word emission with a smoothed unigram, so every word, seen or not, has one.

Counts cover every training text. The lexicon, a count and a class of each word, is a table
that grows with the corpus; the part of its COMMON most frequent words goes to every task, and
the rest is joined.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm import words as W
from lectern.llm.tables import drop, small_batches, stored

#: Most frequent words, which get their classes by exchange; all others are assigned to these classes.
VOCABULARY = 1_000
CLASSES = 60
SWEEPS = 4
#: Words, at most, whose counts and classes travel to every task (24 bytes each): all from a count on.
COMMON = 300_000
#: Share of the class model in a token's probability.
CLASS_SHARE = 0.7

#: Key of the token that ends a text; no word has it but by a chance of 2**-64.
END = np.uint64(0x5BD1E995ACE0FFED)


class Model(NamedTuple):
    """known: sorted hashes of the common words and the end, with their counts and classes; unknown: class of words outside the lexicon."""

    known: np.ndarray
    counts: np.ndarray
    of: np.ndarray
    unknown: int
    end: int
    transition: np.ndarray
    class_tokens: np.ndarray
    class_words: np.ndarray
    tokens: int
    words: int


def _batch_counts(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(h, return_counts=True)


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[new], np.add.reduceat(counts, new)


def _token_counts(limit: int):
    """Counts of words and ends of the texts of a task, given out whenever ``limit`` distinct ones are held."""

    def out(keys, counts):
        return pa.record_batch({"word": W.longs(keys), "c": pa.array(counts.astype(np.int64))})

    def run(batches):
        held: list = []
        size = 0
        for _, data, bounds in W.texts(batches):
            words = W.split(W.lowered(data), bounds, W.not_space())
            held.append(_batch_counts(np.append(words.hashes, np.full(len(bounds) - 1, END))))
            size += len(held[-1][0])
            if size > limit:
                held = [_merge(held)]
                size = len(held[0][0])
                if size > limit // 2:
                    yield out(*held[0])
                    held, size = [], 0
        if held:
            yield out(*_merge(held))

    return run


def _class_ids(hashes: np.ndarray, vocabulary: np.ndarray, ids: np.ndarray, other: int) -> np.ndarray:
    if not len(vocabulary):
        return np.full(len(hashes), other)
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return np.where(vocabulary[at] == hashes, ids[at], other)


def _with_ends(values: np.ndarray, first: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The values with an end after each text; (sequence, first positions). What precedes a text is the end before it."""
    n = len(first) - 1
    where = first + np.arange(n + 1)
    out = np.full(len(values) + n, end, np.int64)
    out[np.arange(len(values)) + np.repeat(np.arange(n), np.diff(first))] = values
    return out, where


def _bigrams(vocabulary: np.ndarray):
    size = len(vocabulary) + 2

    def run(batches):
        total: list = []
        for _, data, bounds in W.texts(batches):
            words = W.split(W.lowered(data), bounds, W.not_space())
            ids = _class_ids(words.hashes, vocabulary, np.arange(len(vocabulary)), size - 2)
            seq, _ = _with_ends(ids, words.first, size - 1)
            total.append(_batch_counts(np.append(size - 1, seq[:-1]) * size + seq))
            if sum(len(x[0]) for x in total) > 4_000_000:
                total = [_merge(total)]
        if total:
            keys, counts = _merge(total)
            yield pa.record_batch({"a": pa.array(keys // size), "b": pa.array(keys % size), "c": pa.array(counts.astype(np.int64))})

    return run


def exchange(pairs: np.ndarray, counts: np.ndarray, order: np.ndarray, classes: int, sweeps: int) -> np.ndarray:
    """Classes of words 0 to n - 1 from bigram counts (a, b, count) over ids 0 to n + 1; n: all other words, n + 1: end.

    ``order``: word ids by falling count. Words start in classes by rank; the two last ids keep classes of
    their own. A word moves to the class with the largest sum of N log N over class bigrams less class counts.
    """
    n = len(order)
    size = n + 2
    dense = np.zeros((size, size), np.float64)
    dense[pairs[:, 0], pairs[:, 1]] = counts
    of = np.empty(size, np.int64)
    of[order] = np.minimum(np.arange(n), np.arange(n) % classes)
    of[n], of[n + 1] = classes, classes + 1
    k = classes + 2
    member = np.zeros((size, k))
    member[np.arange(size), of] = 1
    grid = member.T @ dense @ member
    f = lambda x: np.where(x > 0, x * np.log(np.maximum(x, 1)), 0.0)
    out_by, in_by = dense @ member, dense.T @ member  # counts of each word before and after each class
    for _ in range(sweeps):
        moved = 0
        for w in order.tolist():
            now, own = of[w], dense[w, w]
            to, frm = out_by[w].copy(), in_by[w].copy()
            to[now] -= own
            frm[now] -= own
            # take the word out of its class
            grid[now] -= to
            grid[:, now] -= frm
            grid[now, now] -= own
            rows, cols = grid[:classes], grid.T[:classes]
            left, right = rows.sum(1) + frm[:classes], cols.sum(1) + to[:classes]
            gain = (f(rows + to) - f(rows)).sum(1) + (f(cols + frm) - f(cols)).sum(1)
            c = np.arange(classes)
            corner = grid[c, c]
            gain += f(corner + to[c] + frm[c] + own) - f(corner + to[c]) - f(corner + frm[c]) + f(corner)
            gain -= f(left + to.sum() + own) - f(left) + f(right + frm.sum() + own) - f(right)
            best = int(np.argmax(gain))
            if gain[now] >= gain[best] - 1e-9:
                best = int(now)
            grid[best] += to
            grid[:, best] += frm
            grid[best, best] += own
            if best != now:
                moved += 1
                of[w] = best
                out_by[:, now] -= dense[:, w]
                out_by[:, best] += dense[:, w]
                in_by[:, now] -= dense[w]
                in_by[:, best] += dense[w]
        if not moved:
            break
    return of


def _contexts(vocabulary: np.ndarray, of: np.ndarray, classes: int):
    """Of each word outside the vocabulary how often a class precedes it (entries 0 to classes + 1) and follows it (the entries after)."""
    kinds = classes + 2

    def run(batches):
        for _, data, bounds in W.texts(batches, size=4 * W.SLICE_BYTES):
            words = W.split(W.lowered(data), bounds, W.not_space())
            seq, _ = _with_ends(_class_ids(words.hashes, vocabulary, of, classes), words.first, classes + 1)
            where = np.arange(len(words.hashes)) + words.row_of()  # places of the words in seq
            before, after = np.append(classes + 1, seq[:-1])[where], seq[where + 1]
            rare = np.flatnonzero(seq[where] == classes)
            known, at = np.unique(words.hashes[rare], return_inverse=True)
            code, count = np.unique(np.concatenate([at * 2 * kinds + before[rare], at * 2 * kinds + kinds + after[rare]]), return_counts=True)
            first = np.searchsorted(code, np.arange(len(known) + 1) * 2 * kinds)
            x = pa.StructArray.from_arrays([pa.array((code % (2 * kinds)).astype(np.int16)), pa.array(count.astype(np.int32))], ["entry", "c"])
            yield pa.record_batch({"word": W.longs(known), "x": W.lists(x, first)})

    return run


def _assign(transition: np.ndarray, class_tokens: np.ndarray):
    """The class of each word that makes its neighbours likeliest.

    The rows of a word follow each other; one batch and one word's counts are held.
    """
    kinds = len(transition)
    classes = kinds - 2
    logs = np.concatenate([np.log(transition[:, :classes]), np.log(transition[:classes].T)])  # (entries, classes)
    size = np.log(np.maximum(1.0, class_tokens[:classes]))

    def run(batches):
        held, counts = None, np.zeros(2 * kinds)

        def chosen(words, table):
            best = (table @ logs - table[:, :kinds].sum(axis=1, keepdims=True) * size).argmax(axis=1)
            return pa.record_batch({"word": pa.array(words, pa.int64()), "class": pa.array(best.astype(np.int32))})

        for b in batches:
            if not len(b):
                continue
            word, lists = b.column("word").to_numpy(), b.column("x")
            part, owner = lists.flatten(), np.repeat(np.arange(len(b)), np.diff(lists.offsets.to_numpy()))
            new = np.append(True, word[1:] != word[:-1])
            entry, c = (part.field(k).to_numpy(zero_copy_only=False) for k in ("entry", "c"))
            at = np.cumsum(new) - 1
            table = np.bincount(at[owner] * 2 * kinds + entry, weights=c, minlength=(at[-1] + 1) * 2 * kinds).reshape(-1, 2 * kinds)
            names = word[new]
            if held is not None and names[0] == held:
                table[0] += counts
            elif held is not None:
                yield chosen([held], counts[None])
            held, counts = int(names[-1]), table[-1].copy()
            if len(names) > 1:
                yield chosen(names[:-1], table[:-1])
        if held is not None:
            yield chosen([held], counts[None])

    return run


def _classes_of(known: np.ndarray, of: np.ndarray, end: int, data: np.ndarray, bounds: np.ndarray):
    """(words, where tokens of rows begin, class of each token or -1, hash of each token, class and hash of the token before each; an end comes before the first of a row)."""
    words = W.split(W.lowered(data), bounds, W.not_space())
    at = np.minimum(np.searchsorted(known, words.hashes), max(0, len(known) - 1))
    common = known[at] == words.hashes if len(known) else np.zeros(len(at), bool)
    kinds, where = _with_ends(np.where(common, of[at], -1), words.first, end)
    names, _ = _with_ends(words.hashes.view(np.int64), words.first, int(END.view(np.int64)))
    return words, at, common, where, kinds, names, np.append(end, kinds[:-1]), np.append(np.int64(0), names[:-1])


def _open_pairs(pick: np.ndarray, before: np.ndarray, last: np.ndarray, kinds: np.ndarray, names: np.ndarray) -> pa.StructArray:
    """Pairs of neighbours of which one's class is to be looked up: word or 0, and class or -1, of both."""
    return pa.StructArray.from_arrays([pa.array(np.where(before[pick] < 0, last[pick], 0)), pa.array(before[pick].astype(np.int32)), pa.array(np.where(kinds[pick] >= 0, 0, names[pick])), pa.array(kinds[pick].astype(np.int32))], ["w0", "k0", "w1", "k1"])


def _class_pairs(common):
    """Of each slice its pairs that need a look-up; at the end, in a row of its own, how often each class follows each, of all other pairs."""

    def run(batches):
        known, of, end, size = common.value
        grid = np.zeros(size * size, np.int64)
        for _, data, bounds in W.texts(batches):
            _, _, _, _, kinds, names, before, last = _classes_of(known, of, end, data, bounds)
            both = (kinds >= 0) & (before >= 0)
            grid += np.bincount(before[both] * size + kinds[both], minlength=size * size)
            pairs = _open_pairs(np.flatnonzero(~both), before, last, kinds, names)
            yield pa.record_batch({"open": W.lists(pairs, np.array([0, len(pairs)])), "grid": pa.array([None], pa.list_(pa.int64()))})
        yield pa.record_batch({"open": pa.array([None], pa.list_(pa.struct([("w0", pa.int64()), ("k0", pa.int32()), ("w1", pa.int64()), ("k1", pa.int32())]))), "grid": pa.array([grid.tolist()], pa.list_(pa.int64()))})

    return run


def looked_up(pairs: DataFrame, lexicon: DataFrame) -> DataFrame:
    """pairs (w0, k0, w1, k1, ...) with class0, c0, class1 and c1 of the words whose class is -1, null where the lexicon has none."""
    side = lambda i: lexicon.select(F.col("word").alias(f"w{i}"), F.col("class").alias(f"class{i}"), F.col("c").alias(f"c{i}"))
    none = lambda i: {f"class{i}": F.lit(None).cast("int"), f"c{i}": F.lit(None).cast("long")}
    first = pairs.where("k0 >= 0").withColumns(none(0)).unionByName(pairs.where("k0 < 0").join(side(0), "w0", "left"))
    return first.where("k1 >= 0").withColumns(none(1)).unionByName(first.where("k1 < 0").join(side(1), "w1", "left"))


def class_bigrams(rows: DataFrame, lexicon: DataFrame, known: np.ndarray, of: np.ndarray, end: int, size: int) -> np.ndarray:
    """How often each class follows each in all texts: of all pairs of neighbours, an end before the first word and after the last.

    ``known``: sorted hashes of the common words, with their classes ``of``; the others are joined with the lexicon, which has every
    word of rows.
    """
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((known, of, end, size))
    counted = stored(rows.mapInArrow(_class_pairs(shared), "open array<struct<w0:long,k0:int,w1:long,k1:int>>, grid array<long>"))
    zero = F.array_repeat(F.lit(0).cast("long"), size * size)
    whole = counted.where("grid IS NOT NULL").agg(F.aggregate(F.collect_list("grid"), zero, lambda x, y: F.zip_with(x, y, lambda p, q: p + q)).alias("grid")).first()[0]
    grid = np.array(whole or [0] * size * size, np.float64).reshape(size, size)
    found = looked_up(counted.select(F.explode("open").alias("x")).select("x.*"), lexicon)
    of_side = lambda i: F.when(F.col(f"k{i}") < 0, F.col(f"class{i}")).otherwise(F.col(f"k{i}")).alias(f"k{i}")
    for a, b, c in found.select(of_side(0), of_side(1)).groupBy("k0", "k1").count().collect():  # a row for each pair of classes
        grid[a, b] += c
    drop(counted)
    return grid


def fit(train: DataFrame, text_col: str = "text") -> tuple[Model, DataFrame]:
    """(model, lexicon): lexicon is the stored table (word hash, count c, class) of all training words.

    Class bigrams are counted over all pairs of neighbours of all training texts, whatever their words.
    """
    small_batches(train.sparkSession)
    rows = train.select(F.col(text_col).cast("string").alias("text"))
    counts = stored(rows.mapInArrow(_token_counts(2_000_000), "word long, c long").groupBy("word").agg(F.sum("c").alias("c")))
    end = int(END.view(np.int64))
    total = counts.agg(F.sum("c"), F.count("*")).first()
    ends = counts.where(F.col("word") == end).agg(F.sum("c")).first()[0] or 0
    tokens, distinct = int(total[0] or 0), int(total[1])
    top = counts.where(F.col("word") != end).orderBy(F.desc("c"), "word").limit(VOCABULARY).toArrow()
    chosen = top.column("word").to_numpy().view(np.uint64)
    by = np.argsort(chosen)
    vocabulary, own = chosen[by], top.column("c").to_numpy()[by].astype(np.float64)
    size = len(vocabulary)
    order = np.argsort(by)  # ids, in the sorted vocabulary, by falling count
    bigrams = rows.mapInArrow(_bigrams(vocabulary), "a long, b long, c long").groupBy("a", "b").agg(F.sum("c").alias("c")).toArrow()
    pairs, times = np.stack([bigrams.column(k).to_numpy() for k in ("a", "b")], axis=1), bigrams.column("c").to_numpy().astype(np.float64)
    classes = max(1, min(CLASSES, size))
    tail, last, kinds = classes, classes + 1, classes + 2
    of = exchange(pairs, times, order, classes, SWEEPS)
    grid = np.zeros((kinds, kinds))
    np.add.at(grid, (of[pairs[:, 0]], of[pairs[:, 1]]), times)
    smooth = lambda g: (g + 1) / (g.sum(1, keepdims=True) + kinds)
    in_class = np.bincount(of[:size], weights=own, minlength=kinds).astype(np.float64)
    # each word outside the vocabulary: its neighbours' classes, then its own
    contexts = rows.mapInArrow(_contexts(vocabulary, of[:size], classes), "word long, x array<struct<entry:short,c:int>>").repartition("word").sortWithinPartitions("word")
    assigned = stored(contexts.mapInArrow(_assign(smooth(grid), in_class), "word long, class int"))
    known = train.sparkSession.createDataFrame([(int(h), int(k)) for h, k in zip(vocabulary.view(np.int64), of[:size], strict=True)], "word long, class int")
    lexicon = stored(counts.join(assigned.unionByName(known), "word"))
    drop(assigned)
    in_class, kinds_of = np.zeros(kinds), np.zeros(kinds)
    for k, c, n in lexicon.groupBy("class").agg(F.sum("c"), F.count("*")).collect():
        in_class[k], kinds_of[k] = c, n
    in_class[last], kinds_of[last] = ends, 1
    steps = sorted((tuple(r) for r in lexicon.groupBy("c").agg(F.count("*")).collect()), reverse=True)
    fits = int(np.searchsorted(np.cumsum([n for _, n in steps]), COMMON, "right"))
    common = lexicon.where(F.col("c") >= (steps[fits - 1][0] if fits else (1 << 62))).toArrow().combine_chunks()
    hashes = common.column("word").to_numpy().view(np.uint64)
    at = np.argsort(hashes)
    with_end = lambda values, x: np.append(values[at], x)
    classes_of = common.column("class").to_numpy().astype(np.int64)[at]
    grid = class_bigrams(rows, lexicon, hashes[at], np.append(classes_of, last), last, kinds)
    model = Model(with_end(hashes, END), with_end(common.column("c").to_numpy(), ends), with_end(common.column("class").to_numpy().astype(np.int64), last), tail, last, smooth(grid), in_class, kinds_of, tokens, distinct)
    drop(counts)
    return model, lexicon


def _probability(m: Model, before: np.ndarray, here: np.ndarray) -> np.ndarray:
    """Probability of a word of class ``here`` after one of class ``before``, over its count plus one."""
    smooth = m.tokens + 1 * (m.words + 1)
    emit = m.class_tokens + m.class_words + 1
    return CLASS_SHARE * m.transition[before, here] / emit[here] + (1 - CLASS_SHARE) / smooth


def _score(model):
    """Scores of each text as far as its words are common, and its pairs of neighbours of which one is not."""

    def run(batches):
        m = Model(**model.value)
        smooth = m.tokens + 1 * (m.words + 1)
        for rows, data, bounds in W.texts(batches):
            n = len(rows)
            words, at, common, where, kinds, names, before, last = _classes_of(m.known[:-1], m.of, m.end, data, bounds)
            count, _ = _with_ends(np.where(common, m.counts[at], 0), words.first, int(m.counts[-1]))
            row = np.repeat(np.arange(n), np.diff(where))
            sure = kinds >= 0
            both = sure & (before >= 0)
            factor = np.where(sure, np.log10(count + 1.0), 0.0)
            rest = np.where(both, np.log10(_probability(m, np.maximum(before, 0), np.maximum(kinds, 0))), 0.0)
            base = np.add.reduceat(factor - np.log10(smooth), where[:-1]) if n else np.zeros(0)
            score = np.add.reduceat(factor + rest, where[:-1]) if n else np.zeros(0)
            found = np.add.reduceat(sure & (count > 0), where[:-1], dtype=np.int64)
            open_ = np.flatnonzero(~both)
            pair = _open_pairs(open_, before, last, kinds, names)
            yield pa.record_batch({
                "row": rows.column("row"),
                "id": rows.column("id"),
                "held_out": rows.column("held_out"),
                "n_tokens": pa.array(np.diff(words.first) + 1),
                "n_known": pa.array(found),
                "base_score": pa.array(base),
                "score": pa.array(score),
                "open": W.lists(pair, np.searchsorted(row[open_], np.arange(n + 1))),
            })

    return run


def _later(model):
    """What pairs with joined classes add to their texts: log10 of count plus one, of the rest, and whether the word is known."""

    def run(batches):
        m = Model(**model.value)
        for b in batches:
            k0, k1, c = (b.column(k).to_numpy() for k in ("k0", "k1", "c"))
            yield pa.record_batch({"row": b.column("row"), "more": pa.array(np.log10(c + 1.0)), "rest": pa.array(np.log10(_probability(m, k0, k1))), "seen": pa.array((c > 0).astype(np.int64))})

    return run


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn from the rows where ``held_out`` is false (null: true) and score every row of docs.

    Returns id, held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity
    (10 ** (-score / n_tokens)). Tokens are the text's words, A-Z in lower case, then one end; a null
    or empty text is an end alone. Words outside the lexicon are one unknown word. Without training rows every
    token has count 0. Rows of one id are scored each on its own; other columns are not read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.coalesce(held_out, F.lit(True)).alias("held_out"))
    model, lexicon = fit(rows.where(~F.col("held_out")), "text")
    kind = docs.schema[id_col].dataType.simpleString()
    keyed = rows.withColumn("row", F.monotonically_increasing_id())
    shape = f"row long, id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double, open array<struct<w0:long,k0:int,w1:long,k1:int>>"
    shared = docs.sparkSession.sparkContext.broadcast(model._asdict())
    local = stored(keyed.mapInArrow(_score(shared), shape))
    pairs = local.select("row", F.explode("open").alias("x")).select("row", "x.*")
    joined = looked_up(pairs, lexicon)
    of = lambda i: F.when(F.col(f"k{i}") < 0, F.coalesce(f"class{i}", F.lit(model.unknown))).otherwise(F.col(f"k{i}"))
    # the count of a common word is in its text's sum already
    count = F.when(F.col("k1") < 0, F.coalesce("c1", F.lit(0))).otherwise(0)
    later = joined.select("row", of(0).cast("long").alias("k0"), of(1).cast("long").alias("k1"), count.cast("long").alias("c")).mapInArrow(_later(shared), "row long, more double, rest double, seen long")
    later = later.groupBy("row").agg(F.sum("more").alias("more"), F.sum("rest").alias("rest"), F.sum("seen").alias("seen"))
    whole = local.drop("open").join(later, "row", "left")
    more, rest = F.coalesce("more", F.lit(0.0)), F.coalesce("rest", F.lit(0.0))
    total = F.col("score") + more + rest
    return whole.select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + more).alias("base_score"),
        total.alias("score"),
        F.pow(F.lit(10.0), -total / F.col("n_tokens")).alias("perplexity"),
    )
