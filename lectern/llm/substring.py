"""Substring dedup: words of long passages that an earlier document also has.

Every window of ``window`` words has an anchor, the least hash of the runs of
``anchor`` words in it, which depends on the window's words alone. Equal windows
so meet in one shard, wherever they stand. A shard indexes each distinct passage
(windows in a row with one anchor) once, in an FM-index, and streams the same
passages through backward search; each window learns the least id that has it.
Work grows with the text, not with the pairs of documents.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm import words as W
from lectern.llm.fmindex import DEPTH, FMIndex
from lectern.llm.tables import drop, small_batches, stored

#: Words that one index should hold, and words of distinct passages beyond which an anchor is split by window.
SHARD_WORDS = 500_000
HOT_WORDS = 100_000
#: Windows in one passage at most; a longer run of windows with one anchor is cut into several passages.
PASSAGE_WINDOWS = 128

#: A null id stands for this one in the order of documents.
NO_ID = (1 << 63) - 1

_PASSAGES = "row long, id long, start int, n int, anchor long, passage long"
_BODIES = "anchor long, passage long, n int, id long, last long, hot boolean, body binary"
_RUNS = "array<struct<at:int,size:int,first_id:long>>"


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of each ``width`` neighbours."""
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[: len(x) - done], x[done:])
        done *= 2
    return np.minimum(x[: len(x) - (width - done)], x[width - done :]) if width > done else x


def _passages(window: int, anchor: int):
    def run(batches):
        for rows, data, bounds in W.texts(batches):
            words = W.split(data, bounds, W.not_space())
            h, n = words.hashes, len(words.hashes)
            if n < window:
                continue
            grams = W.gram_hashes(h, np.arange(n - anchor + 1), anchor)
            least = sliding_least(grams, window - anchor + 1)
            first, last = words.first[:-1], words.first[1:] - window
            at, row = W.runs(first, last + 1)
            if not len(at):
                continue
            value = least[at]
            new = np.ones(len(at), bool)
            new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
            begin = np.flatnonzero(new)
            size = np.diff(np.append(begin, len(at)))
            parts = -(-size // PASSAGE_WINDOWS)
            offset, of = W.runs(np.zeros(len(size), np.int64), parts)
            begin, size = begin[of] + offset * PASSAGE_WINDOWS, np.minimum(size[of] - offset * PASSAGE_WINDOWS, PASSAGE_WINDOWS)
            start, r = at[begin], row[begin]
            yield pa.record_batch({
                "row": rows.column("row").take(pa.array(r)),
                "id": rows.column("id").take(pa.array(r)),
                "start": pa.array((start - first[r]).astype(np.int32)),
                "n": pa.array(size.astype(np.int32)),
                "anchor": W.longs(value[begin]),
                "passage": W.longs(W.gram_hashes(h, start, size + window - 1)),
            })

    return run


def _windows(window: int):
    """The windows of cut passages, each with its words' hash as anchor and its place ``at`` in the passage."""

    def run(batches):
        for rows, data, bounds in W.texts(batches):
            words = W.split(data, bounds, W.not_space())
            at, r = W.runs(words.first[:-1], words.first[1:] - window + 1)
            out = {k: rows.column(k).take(pa.array(r)) for k in ("of_anchor", "of_passage", "of_n", "id", "last")}
            out["at"] = pa.array((at - words.first[r]).astype(np.int32))
            out["anchor"] = W.longs(W.gram_hashes(words.hashes, at, window)) if len(at) else pa.array([], pa.int64())
            yield pa.record_batch(out)

    return run


def _cut(window: int):
    """Bytes of the wanted passages of each text."""

    def run(batches):
        for rows, data, bounds in W.texts(batches):
            words = W.split(data, bounds, W.not_space())
            want = rows.column("want")
            r = np.repeat(np.arange(len(rows)), np.diff(want.offsets.to_numpy()))
            part = want.flatten()
            start, n, same = (part.field(k).to_numpy(zero_copy_only=False) for k in ("start", "n", "passage"))
            keep = np.flatnonzero(words.first[r] + start + n + window - 1 <= words.first[r + 1])
            at, size = words.first[r[keep]] + start[keep], n[keep] + window - 1
            right = W.gram_hashes(words.hashes, at, size).view(np.int64) == same[keep]
            keep, at, size = keep[right], at[right], size[right]
            if not len(keep):
                continue
            low, high = words.starts[at], words.ends[at + size - 1]
            index, _ = W.runs(low, high)
            offsets = np.concatenate([[0], np.cumsum(high - low)]).astype(np.int32)
            body = pa.Array.from_buffers(pa.binary(), len(keep), [None, pa.py_buffer(offsets), pa.py_buffer(data[index])])
            chosen = part.take(pa.array(keep))
            out = {k: chosen.field(k) for k in ("anchor", "passage", "n", "last", "hot")}
            yield pa.record_batch(out | {"id": rows.column("id").take(pa.array(r[keep])), "body": body}).select(["anchor", "passage", "n", "id", "last", "hot", "body"])

    return run


def _search(window: int):
    """One index over the passages of a partition, and all of them through it."""

    def run(batches):
        held = [b for b in batches if len(b)]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        body = table.column("body").chunk(0)
        bounds = np.frombuffer(body.buffers()[1], np.int32, len(body) + 1, body.offset * 4).astype(np.int64)
        data = np.frombuffer(body.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
        words = W.split(data, bounds - bounds[0], W.not_space())
        distinct, symbol = np.unique(words.hashes, return_inverse=True)
        total, count = len(symbol), len(body)
        row = words.row_of()
        sequence = np.zeros(total + count, np.int64)
        sequence[np.arange(total) + row] = symbol + 1
        starts, ends = words.first[:-1] + np.arange(count), words.first[1:] + np.arange(count)
        index = FMIndex(sequence, window)
        ids = table.column("id").to_numpy()
        owner = np.full(len(sequence), NO_ID)
        owner[np.arange(total) + row] = ids[row]
        least = index.least(owner)
        n = ends - starts - window + 1
        base = np.concatenate([[0], np.cumsum(n)])
        first_id = np.empty(base[-1], np.int64)
        for query, at, group in index.matches(sequence, starts, ends):
            first_id[base[query] + at - starts[query]] = least[group]
        new = np.ones(len(first_id), bool)
        new[1:] = first_id[1:] != first_id[:-1]
        new[base[:-1]] = True
        begin = np.flatnonzero(new)
        of = np.searchsorted(base, begin, "right") - 1
        length = np.diff(np.append(begin, len(first_id)))
        lists = np.searchsorted(begin, base)
        runs = pa.StructArray.from_arrays([pa.array((begin - base[of]).astype(np.int32)), pa.array(length.astype(np.int32)), pa.array(first_id[begin])], ["at", "size", "first_id"])
        out = {k: table.column(k).chunk(0) for k in ("anchor", "passage", "n")}
        out["runs"] = W.lists(runs, lists)
        for i in range(0, count, 20_000):
            yield pa.record_batch({k: v.slice(i, 20_000) for k, v in out.items()})

    return run


def _apply(window: int):
    def run(batches):
        for rows, data, bounds in W.texts(batches):
            want = rows.column("found")
            sizes = np.diff(want.offsets.to_numpy())
            gone = None
            if sizes.sum():
                words = W.split(data, bounds, W.not_space())
                r = np.repeat(np.arange(len(rows)), sizes)
                part = want.flatten()
                start, n, same, at, size = (part.field(k).to_numpy(zero_copy_only=False) for k in ("start", "n", "passage", "at", "size"))
                keep = words.first[r] + start + n + window - 1 <= words.first[r + 1]
                r, start, n, same, at, size = (x[keep] for x in (r, start, n, same, at, size))
                begin = words.first[r] + start
                keep = W.gram_hashes(words.hashes, begin, n + window - 1).view(np.int64) == same
                begin, stop = (begin + at)[keep], (begin + at + size + window - 1)[keep]
                steps = np.bincount(begin, minlength=len(words.hashes) + 1) - np.bincount(stop, minlength=len(words.hashes) + 1)
                gone = np.cumsum(steps)[:-1] > 0
            raw = data.tobytes()
            out = []
            for i in range(len(rows)):
                has = raw[bounds[i] : bounds[i + 1]].split()
                total = len(has)
                if gone is not None and sizes[i]:
                    has = list(compress(has, ~gone[words.first[i] : words.first[i + 1]]))
                kept = b" ".join(has)
                out.append((total, total - len(has), hashlib.sha256(kept).hexdigest(), kept))
            total, removed, digest, kept = zip(*out, strict=True)
            yield pa.record_batch({
                "id": rows.column("key"),
                "n_words": pa.array(total, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "kept_sha256": pa.array(digest),
                "kept": pa.array(kept, pa.binary()).cast(pa.string()),
            })

    return run


def dedup(docs: DataFrame, window: int = 50, anchor: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: id, n_words, n_removed, kept_sha256 and ``kept``, the words left, joined by one space.

    A word goes if a window of ``window`` words that covers it also starts in a row with a smaller
    integer id. Windows are judged on the input. A null or empty text has no words and keeps an empty
    string; a text shorter than the window keeps all. Rows of one id are judged each on its own text,
    and none is earlier than the other. A null id is later than all others, which lie below NO_ID.
    Rows are stored once with a number, by which passages come back to them, so that rows of one id
    do not carry each other's. Other columns are not read. An empty table gives an empty one.
    """
    if not anchor < window <= DEPTH:
        raise ValueError(f"anchor < window <= {DEPTH} is asked for")
    small_batches(docs.sparkSession)
    order = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id")
    rows = stored(docs.select(F.monotonically_increasing_id().alias("row"), order, F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text")))
    texts = rows.select("row", "id", "text")
    place = ["anchor", "passage", "n"]

    def with_texts(passages: DataFrame) -> DataFrame:
        wanted = passages.groupBy("row").agg(F.collect_list(F.struct("start", *place, "last", "hot")).alias("want"))
        return wanted.join(texts, "row").select("id", "text", "want")

    # Passages whose anchor also stands in another document, and each distinct one with the least id that has it.
    everywhere = stored(texts.mapInArrow(_passages(window, anchor), _PASSAGES))
    twice = everywhere.groupBy("anchor").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("anchor")
    found = stored(everywhere.join(twice, "anchor"))
    drop(everywhere)
    one = stored(found.groupBy(*place).agg(F.min(F.struct("id", "row", "start")).alias("first"), F.max("id").alias("last")).select(*place, "first.*", "last"))
    hot = stored(one.groupBy("anchor").agg(F.sum(F.col("n") + window - 1).alias("held")).where(F.col("held") > HOT_WORDS).select("anchor"))
    some_hot = not hot.isEmpty()
    marked = one.join(hot.withColumn("hot", F.lit(True)), "anchor", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    bodies = with_texts(marked).mapInArrow(_cut(window), _BODIES)
    words = F.sum(F.col("n") + window - 1)
    if some_hot:
        # Anchors with many contexts: their passages are cut like all; those of their windows that two documents have are indexed instead.
        bodies = stored(bodies)
        whole = [f"of_{k}" for k in place]
        split = bodies.where("hot").select(*(F.col(k).alias(f"of_{k}") for k in place), "id", "last", F.col("body").cast("string").alias("text"))
        windows = stored(split.mapInArrow(_windows(window), "of_anchor long, of_passage long, of_n int, id long, last long, at int, anchor long"))
        least = F.min(F.struct("id", "at", *whole)).alias("first")
        again = windows.groupBy("anchor").agg(least, F.min("id").alias("lo"), F.max("last").alias("last")).where("lo < last").select("anchor", "last", "first.at", *(f"first.{k}" for k in whole))
        part = F.struct(F.col("at").alias("start"), "anchor", F.col("anchor").alias("passage"), F.lit(1).alias("n"), "last", F.lit(False).alias("hot"))
        want = again.groupBy(*whole).agg(F.collect_list(part).alias("want"))
        single = stored(split.join(want, whole).select("id", "text", "want").mapInArrow(_cut(window), _BODIES))
        bodies = bodies.where("NOT hot").unionByName(single)
        held = bodies.agg(words).first()[0] or 0
    else:
        held = one.agg(words).first()[0] or 0
    shards = max(1, -(-held // SHARD_WORDS))
    answers = bodies.select(*place, "id", "body").repartition(shards, "anchor").mapInArrow(_search(window), f"anchor long, passage long, n int, runs {_RUNS}")
    if some_hot:
        answers = stored(answers)
        of_window = windows.join(answers.select("anchor", F.col("runs")[0]["first_id"].alias("first_id")), "anchor")
        of_passage = of_window.groupBy(*(F.col(f"of_{k}").alias(k) for k in place)).agg(F.collect_list(F.struct("at", F.lit(1).alias("size"), "first_id")).cast(_RUNS).alias("runs"))
        answers = answers.join(hot, "anchor", "left_anti").unionByName(of_passage)
    covered = found.join(answers, place)
    runs = covered.select("row", "start", "n", "passage", F.explode(F.filter("runs", lambda r: r.first_id < F.col("id"))).alias("run"))
    by_row = runs.groupBy("row").agg(F.collect_list(F.struct("start", "n", "passage", "run.at", "run.size")).alias("found"))
    empty = F.array().cast("array<struct<start:int,n:int,passage:long,at:int,size:int>>")
    joined = rows.join(by_row, "row", "left").select("key", "text", F.coalesce("found", empty).alias("found"))
    kind = docs.schema[id_col].dataType.simpleString()
    return joined.mapInArrow(_apply(window), f"id {kind}, n_words long, n_removed long, kept_sha256 string, kept string").withColumnRenamed("id", id_col)
