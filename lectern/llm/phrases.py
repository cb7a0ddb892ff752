"""Benchmark decontamination by a positional inverted index over training text.

The index is cut by documents: a shard holds the token postings of some megabytes of
text, sorted by term and position. A phrase query is answered in each shard from its
rarest terms on: their positions, less their place in the phrase, are candidate
starts, and each further term's list, offset likewise, is intersected with them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm import words as W
from lectern.llm.tables import small_batches, stored

#: Bytes of text in a shard, and words of queries that travel to every task at once; more queries go in several blocks.
SHARD_BYTES = 4 << 20
BLOCK_WORDS = 1_000_000

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_SHARD = "shard long, ids binary, null_ids binary, first binary, terms binary, lists binary, gaps binary"


class Queries:
    """Distinct windows of items as arrays of term hashes, by length, with the items that have them."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        names = sorted({name for name, _ in items})
        of = {name: i for i, name in enumerate(names)}
        text = pa.array([t or "" for _, t in items], pa.string())
        found: dict[int, dict[bytes, set[int]]] = {}
        row = 0
        for _, data, bounds in W.texts([pa.record_batch({"text": text})] if items else []):
            words = W.split(W.lowered(data), bounds, W.alphanumeric())
            for a, b in zip(words.first[:-1], words.first[1:], strict=True):
                size = min(window, b - a)
                for i in range(a, b - size + 1 if size else a):
                    found.setdefault(int(size), {}).setdefault(words.hashes[i : i + size].tobytes(), set()).add(of[items[row][0]])
                row += 1
        self.names = names
        self.windows = {n: np.frombuffer(b"".join(x), np.uint64).reshape(-1, n) for n, x in found.items()}
        self.items = {n: [np.fromiter(sorted(s), np.int64) for s in x.values()] for n, x in found.items()}
        self.terms = np.unique(np.concatenate([np.zeros(0, np.uint64), *(x.ravel() for x in self.windows.values())]))


def _index(terms: np.ndarray | None):
    def run(batches):
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        for rows, data, bounds in W.texts(batches, size=SHARD_BYTES):
            words = W.split(W.lowered(data), bounds, W.alphanumeric())
            if terms is None:
                known, term = np.unique(words.hashes, return_inverse=True)
                position = np.arange(len(term))
            else:
                known = terms
                at = np.minimum(np.searchsorted(terms, words.hashes), max(0, len(terms) - 1))
                position = np.flatnonzero(terms[at] == words.hashes) if len(terms) else np.zeros(0, np.int64)
                term = at[position] if len(terms) else position
            small = term.astype(np.uint16) if len(known) < 1 << 16 else term
            order = np.argsort(small, kind="stable")
            position = position[order]
            counts = np.bincount(term, minlength=len(known))
            begin = np.cumsum(counts) - counts
            gaps = np.diff(position, prepend=0)
            heads = begin[counts > 0]
            gaps[heads] = position[heads]
            ids = rows.column("id")
            values = [
                np.array([part << 32 | number]),
                pc.fill_null(ids, 0).to_numpy().tobytes(),
                np.packbits(ids.is_null().to_numpy(zero_copy_only=False)).tobytes(),
                words.first.astype(np.int32).tobytes(),
                known[counts > 0].tobytes(),
                counts[counts > 0].astype(np.int32).tobytes(),
                gaps.astype(np.int32).tobytes(),
            ]
            number += 1
            yield pa.record_batch([pa.array(values[0]), *(pa.array([v], pa.binary()) for v in values[1:])], [x.split()[0] for x in _SHARD.split(", ")])

    return run


def build(docs: DataFrame, terms: np.ndarray | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored index of docs: a row per shard, with documents, term hashes, list sizes and gap-coded positions.

    With ``terms`` (sorted hashes) only postings of these are stored, else of all terms.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return stored(rows.mapInArrow(_index(terms), _SHARD))


class Shard:
    """A decoded row of the index."""

    def __init__(self, first: bytes, terms: bytes, lists: bytes, gaps: bytes):
        self.first = np.frombuffer(first, np.int32).astype(np.int64)
        self.terms = np.frombuffer(terms, np.uint64)
        self.sizes = np.frombuffer(lists, np.int32).astype(np.int64)
        self.begin = np.cumsum(self.sizes) - self.sizes
        total = np.cumsum(np.frombuffer(gaps, np.int32).astype(np.int64))
        before = np.where(self.begin > 0, total[self.begin - 1], 0) if len(self.begin) else self.begin
        self.positions = total - np.repeat(before, self.sizes)
        self.width = int(self.first[-1]) + 1
        self.posting = np.repeat(np.arange(len(self.terms)), self.sizes) * self.width + self.positions

    def find(self, windows: np.ndarray, slop: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of the window, first position, document) of each match of windows[k] in one document.

        Every term stands at its place in the phrase, or up to ``slop`` words before or after it;
        the place is counted from the phrase's rarest term in the shard, so with slop the first position
        may lie before the document.
        """
        none = np.zeros(0, np.int64)
        if not len(self.terms) or not len(windows):
            return none, none, none
        at = np.minimum(np.searchsorted(self.terms, windows), len(self.terms) - 1)
        which = np.flatnonzero((self.terms[at] == windows).all(axis=1))
        at = at[which]
        by = np.argsort(self.sizes[at], axis=1, kind="stable")  # the rarest term of each window first
        pick = lambda k: np.take_along_axis(at, by[:, k : k + 1], 1)[:, 0]
        rarest = pick(0)
        index, query = W.runs(self.begin[rarest], self.begin[rarest] + self.sizes[rarest])
        anchor = self.positions[index]
        row = np.searchsorted(self.first, anchor, "right") - 1
        start = anchor - by[query, 0]
        fits = (start >= self.first[row]) & (start + windows.shape[1] <= self.first[row + 1]) if not slop else np.ones(len(start), bool)
        query, start, row = query[fits], start[fits], row[fits]
        for k in range(1, windows.shape[1]):
            place = start + by[query, k]
            low = np.maximum(place - slop, self.first[row])
            high = np.minimum(place + slop, self.first[row + 1] - 1)
            key = pick(k)[query] * self.width
            there = np.minimum(np.searchsorted(self.posting, key + low), len(self.posting) - 1)
            fits = (self.posting[there] >= key + low) & (self.posting[there] <= key + high)
            query, start, row = query[fits], start[fits], row[fits]
        return which[query], start, row


def _decoded(batches, windows: dict[int, np.ndarray], slop: int):
    """For each shard: its row of the index, itself, and the matches in order of document and place, as (document, place, words, number of the window within its length)."""
    for b in batches:
        for x in b.to_pylist():
            shard = Shard(x["first"], x["terms"], x["lists"], x["gaps"])
            parts = [[np.zeros(0, np.int64)] for _ in range(4)]
            for size, grams in windows.items():
                which, start, row = shard.find(grams, slop)
                for part, values in zip(parts, (row, start, np.full(len(row), size), which), strict=True):
                    part.append(values)
            row, start, size, which = map(np.concatenate, parts)
            order = np.lexsort((which, size, start, row))
            yield x, shard, row[order], np.maximum(0, start - shard.first[row])[order], size[order], which[order]


def _rows(x: dict, shard: Shard) -> dict[str, pa.Array]:
    n = len(shard.first) - 1
    null = np.unpackbits(np.frombuffer(x["null_ids"], np.uint8), count=n).astype(bool)
    return {"shard": pa.array(np.full(n, x["shard"])), "row": pa.array(np.arange(n)), "id": pa.array(np.frombuffer(x["ids"], np.int64), mask=null), "n_words": pa.array(np.diff(shard.first))}


def _matches(queries, slop: int):
    """For each document of a shard: its words, and the matches as (start, words, item)."""

    def run(batches):
        names, windows, items_of = queries.value
        for x, shard, row, at, size, which in _decoded(batches, windows, slop):
            count = np.array([len(items_of[n][k]) for n, k in zip(size.tolist(), which.tolist(), strict=True)], np.int64)
            item = np.concatenate([np.zeros(0, np.int64), *(items_of[n][k] for n, k in zip(size.tolist(), which.tolist(), strict=True))])
            row, at, size = (np.repeat(v, count) for v in (row, at, size))
            match = pa.StructArray.from_arrays([pa.array(at.astype(np.int32)), pa.array(size.astype(np.int32)), pa.array(names, pa.string()).take(pa.array(item))], ["at", "size", "item"])
            yield pa.record_batch(_rows(x, shard) | {"matches": W.lists(match, np.searchsorted(row, np.arange(len(shard.first))))})

    return run


def _covers(queries):
    """For each document of a shard: its words, the spans (at, stop) that matches cover, joined where they meet, and the items that have these windows, each once.

    Items are looked up for the distinct windows of a document, not for each place where one stands.
    """

    def run(batches):
        names, windows, items_of = queries.value
        for x, shard, row, at, size, which in _decoded(batches, windows, 0):
            first = np.searchsorted(row, np.arange(len(shard.first)))
            spans, items, n_spans, n_items = [np.zeros((2, 0), np.int64)], [np.zeros(0, np.int64)], [0], [0]
            for a, z in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                if z > a:
                    reach = np.maximum.accumulate(at[a:z] + size[a:z])
                    new = np.flatnonzero(np.append(True, at[a + 1 : z] > reach[:-1]))
                    spans.append(np.stack([at[a:z][new], reach[np.append(new[1:], z - a) - 1]]))
                    distinct = np.unique(size[a:z] << 32 | which[a:z])
                    items.append(np.unique(np.concatenate([items_of[k >> 32][k & 0xFFFFFFFF] for k in distinct.tolist()])))
                    n_spans.append(spans[-1].shape[1])
                    n_items.append(len(items[-1]))
                else:
                    n_spans.append(0)
                    n_items.append(0)
            both = np.concatenate(spans, axis=1).astype(np.int32)
            span = pa.StructArray.from_arrays([pa.array(both[0]), pa.array(both[1])], ["at", "stop"])
            named = pa.array(names, pa.string()).take(pa.array(np.concatenate(items)))
            yield pa.record_batch(_rows(x, shard) | {"spans": W.lists(span, np.cumsum(n_spans)), "items": W.lists(named, np.cumsum(n_items))})

    return run


def _pieces(window: int):
    """Items longer than a block in pieces that share window - 1 words, so that each of their windows is in one."""

    def run(batches):
        for b in batches:
            for item, text in zip(b.column("item").to_pylist(), b.column("text").to_pylist(), strict=True):
                places = [m.span() for m in _WORD.finditer(text.translate(_LOWER))]
                for i in range(0, max(1, len(places) - window + 1), BLOCK_WORDS):
                    some = places[i : i + BLOCK_WORDS + window - 1]
                    yield pa.record_batch({"item": pa.array([item], pa.string()), "text": pa.array([text[some[0][0] : some[-1][1]] if some else ""], pa.string())})

    return run


def _blocks(docs: DataFrame, items: DataFrame, window: int, columns: tuple[str, str, str, str]) -> Iterator[tuple[Queries, DataFrame]]:
    """The queries of each block of items, and the index of all rows for them.

    A text goes to a block by its item and itself, so that the texts of one item id share no block of their own.
    """
    id_col, text_col, item_col, item_text_col = columns
    named = items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"), F.col(item_text_col).cast("string").alias("text")).distinct()
    length = F.length("text")
    size, longest = named.agg(F.sum(length), F.max(length)).first()
    blocks = max(1, -(-(size or 0) // (BLOCK_WORDS * 6)))
    if blocks > 1:
        # numbers of rows come from scans of one table, which are all alike
        docs = stored(docs.select(id_col, text_col))
        if longest > BLOCK_WORDS * 6:
            cut = named.where(length > BLOCK_WORDS * 6).mapInArrow(_pieces(window), "item string, text string")
            named = named.where(F.coalesce(length, F.lit(0)) <= BLOCK_WORDS * 6).unionByName(cut)
        named = stored(named)
    for k in range(blocks):
        part = named if blocks == 1 else named.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        queries = Queries([tuple(x) for x in part.toLocalIterator()], window)
        yield queries, build(docs, queries.terms, id_col, text_col)


def search(docs: DataFrame, items: DataFrame, window: int = 10, slop: int = 0, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """For each row of docs: shard, row, id, n_words and ``matches``, an array of (at, size, item) in the order of at.

    With slop, ``at`` is counted from the phrase's rarest term and is 0 at least. Matches of one place come
    in no order; rows of one id are each on their own, and columns but id and text are not read.
    Queries are all runs of ``window`` words of an item; an item of fewer words is one query, and one
    without words (or null) is none. A null item id is named ``null``, and repeated items count once. Items are read in
    blocks of about BLOCK_WORDS words, a longer one in pieces; each block is indexed for and searched in all rows.
    Empty tables give no rows, or rows without matches. Each place of a window is given for each item that has it:
    contamination() is the way where many items share one.
    """
    spark, parts = docs.sparkSession, []
    for queries, index in _blocks(docs, items, window, (id_col, text_col, item_col, item_text_col)):
        shared = spark.sparkContext.broadcast((queries.names, queries.windows, queries.items))
        parts.append(index.mapInArrow(_matches(shared, slop), "shard long, row long, id long, n_words long, matches array<struct<at:int,size:int,item:string>>"))
    out = reduce(DataFrame.unionByName, parts)
    if len(parts) > 1:
        out = out.groupBy("shard", "row").agg(F.first("id").alias("id"), F.first("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list("matches"))).alias("matches"))
    return out


def _digest(batches):
    """Covered words and items of each document."""
    for b in batches:
        spans, items = b.column("spans").to_pylist(), b.column("items").to_pylist()
        hit, count, digest = [], [], []
        for some, names in zip(spans, items, strict=True):
            total = reach = 0
            for s in sorted(some, key=lambda s: s["at"]):
                total += max(0, s["stop"] - max(reach, s["at"]))
                reach = max(reach, s["stop"])
            found = sorted(set(names))
            hit.append(total)
            count.append(len(found))
            digest.append(hashlib.sha256(",".join(found).encode()).hexdigest())
        yield pa.record_batch({"id": b.column("id"), "n_words": b.column("n_words"), "n_hit": pa.array(hit, pa.int64()), "n_items": pa.array(count, pa.int64()), "items_sha256": pa.array(digest, pa.string())})


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """For each row of docs: id, n_words, n_hit (words inside a match), n_items, items_sha256, contaminated.

    Words are lower-cased (A-Z) runs of letters, digits and non-ASCII characters. A null or empty text
    has no words. Rows of one id are judged each on its own text; ids are integers or null. An empty table of documents
    gives an empty one, and without items nothing is contaminated.
    """
    spark, parts = docs.sparkSession, []
    for queries, index in _blocks(docs, items, window, (id_col, text_col, item_col, item_text_col)):
        shared = spark.sparkContext.broadcast((queries.names, queries.windows, queries.items))
        parts.append(index.mapInArrow(_covers(shared), "shard long, row long, id long, n_words long, spans array<struct<at:int,stop:int>>, items array<string>"))
    found = reduce(DataFrame.unionByName, parts)
    if len(parts) > 1:
        found = found.groupBy("shard", "row").agg(F.first("id").alias("id"), F.first("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    rows = found.select("id", "n_words", "spans", "items").mapInArrow(_digest, "id long, n_words long, n_hit long, n_items long, items_sha256 string")
    return rows.withColumn("contaminated", F.col("n_hit") > 0).withColumn("id", F.col("id").cast(docs.schema[id_col].dataType)).withColumnRenamed("id", id_col)
