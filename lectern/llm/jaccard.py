"""N-gram Jaccard join: documents whose sets of word shingles overlap enough, and the groups they form.

Candidates come from size-banded blocks. In a band of set sizes the space of shingle hashes is cut
into ranges of about BLOCK shingles. Sets with Jaccard similarity t or more differ by at most
(1 - t) / t of the smaller one's size, and each differing shingle spoils one range; so of a set's
first that many non-empty ranges plus one, at least one is the same in both. A document has a key for
each of these, and linked documents share a key: no link is lost, and documents that share a passage
only rarely meet.

The documents of a key are a tile. First each is held against the tile's pivots; then, in tiles whose
documents are still in several groups, against all members of other groups, block by block. Parity
bitmaps of the hashed sets bound the overlap from above by their bit counts; pairs within the bound
are decided by intersection of the sorted arrays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm import words as W
from lectern.llm.graph import stars
from lectern.llm.tables import bucketed, drop, drop_bucketed, most_rows, small_batches, spread_join, stored

#: Shingles in a range, on average, at the top of a size band.
BLOCK = 3
#: Sets below this size have about one shingle in a range, since few ranges vary much in number.
SMALL = 256
#: Bits for each shingle at the top of a band; with more, differing shingles seldom meet in one bit and the bound is tighter.
SPREAD = 2
#: Documents in one side of a block of pairs.
TILE = 1024
#: Pairs of a block, and bytes of bitmaps, that a worker holds as arrays at once.
PAIRS, COMPARED_BYTES = 250_000, 4 << 20
#: Pairs of rows of the last step in one task, about, and tasks at most (beyond, tasks get more).
TASK_PAIRS, MOST_TASKS = 4_000_000, 20_000
#: Parts of a key's rows in joins by key, so that no task gets all rows of a large tile.
SALTS = 64

#: Stand-ins for null ids lie above this, one for each text.
NO_ID = (1 << 63) - (1 << 41)


def shingle_sets(data, bounds, size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the shingles of each text; all words as one where they are fewer than ``size``."""
    words = W.split(W.lowered(data), bounds, W.not_space())
    counts = np.diff(words.first)
    grams = np.zeros(0, np.uint64)
    if len(words.hashes) >= size:
        grams = W.gram_hashes(words.hashes, np.arange(len(words.hashes) - size + 1), size)
    short = np.flatnonzero((counts > 0) & (counts < size))
    whole = dict(zip(short.tolist(), W.gram_hashes(words.hashes, words.first[short], counts[short]), strict=True))
    out = []
    for i, n in enumerate(counts.tolist()):
        if n >= size:
            x = np.sort(grams[words.first[i] : words.first[i + 1] - size + 1])
            out.append(x[np.append(True, x[1:] != x[:-1])])
        else:
            out.append(np.array([whole[i]] if i in whole else [], np.uint64))
    return out


def band(n: int) -> int:
    """Sizes of band k: 2**k to 2**(k + 1) - 1."""
    return n.bit_length() - 1


def keys(x: np.ndarray, at: int, percent: int) -> np.ndarray:
    """Keys of the sorted set x in band ``at``: its own, or the one below if a partner may lie there."""
    top = min(len(x), (2 << at) - 1)
    spoiled = top * (100 - percent) // percent
    ranges = -(-(2 << at) // BLOCK) if (2 << at) > SMALL else 8 << at
    where = (x >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
    begin = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
    tag = np.uint64((at + 1) * 0xA0761D6478BD642F & 0xFFFFFFFFFFFFFFFF)
    chosen = begin[: spoiled + 1]
    stop = np.append(begin, len(x))[1 : len(chosen) + 1]
    sizes = stop - chosen
    got = W.mixed(np.add.reduceat(W.mixed(x[: stop[-1]] ^ tag), chosen) + sizes.astype(np.uint64))
    if len(begin) <= spoiled:  # too few ranges for the rule; two such sets meet in any common shingle
        got = np.concatenate([got, W.mixed(x ^ ~tag)])
    return got


def bitmap(x: np.ndarray, at: int) -> bytes:
    """Bit i: whether an odd number of shingles has hash i modulo SPREAD * 2**(band + 1)."""
    bits = max(64, SPREAD * 2 << at)
    odd = (np.bincount((W.mixed(x) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(bool)
    return np.packbits(odd).tobytes()


def folded(maps: list[bytes], size: int) -> np.ndarray:
    """Bitmaps as rows of 64-bit words, larger ones folded to ``size`` bytes: parities of i modulo fewer bits."""
    out = np.empty((len(maps), size // 8), np.uint64)
    for i, m in enumerate(maps):
        m = np.frombuffer(m, np.uint64)
        while len(m) > size // 8:
            m = m[: len(m) // 2] ^ m[len(m) // 2 :]
        out[i] = m
    return out


def _sets(size: int, percent: int):
    def run(batches):
        for rows, data, bounds in W.texts(batches):
            sets = shingle_sets(data, bounds, size)
            n = np.array([len(x) for x in sets])
            all_keys, maps = [], []
            for x in sets:
                k, maps_ = np.zeros(0, np.uint64), None
                if len(x):
                    at = band(len(x))
                    k, maps_ = keys(x, at, percent), bitmap(x, at)
                    if at and ((1 << at) - 1) * 100 >= len(x) * percent:
                        k = np.concatenate([k, keys(x, at - 1, percent)])
                all_keys.append(k)
                maps.append(maps_)
            first = np.concatenate([[0], np.cumsum([len(k) for k in all_keys])])
            yield pa.record_batch({
                "id": rows.column("id"),
                "n": pa.array(n.astype(np.int32)),
                "s1": W.longs(np.array([np.bitwise_xor.reduce(W.mixed(x ^ np.uint64(0x5851F42D4C957F2D))) if len(x) else 0 for x in sets], np.uint64)),
                "s2": W.longs(np.array([np.add.reduce(W.mixed(x ^ np.uint64(0x14057B7EF767814F))) if len(x) else 0 for x in sets], np.uint64)),
                "bits": pa.array(maps, pa.binary()),
                "keys": W.lists(W.longs(np.concatenate(all_keys)), first),
            })

    return run


def _within(percent: int):
    """Pairs whose bit counts allow the overlap that is asked for."""

    def run(batches):
        for b in batches:
            n, m = (b.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("n", "m"))
            maps = b.column("x").to_pylist() + b.column("y").to_pylist()
            at = np.arange(len(b))
            yield b.select(["a", "b"]).filter(pa.array(possible(n, m, distances(maps, at, at + len(b)), percent), pa.bool_()))

    return run


def distances(maps: list[bytes], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of maps[a[i]] and maps[b[i]], the larger folded to the size of the smaller."""
    sizes = np.array([len(m) for m in maps], np.int64)
    least = np.minimum(sizes[a], sizes[b]) if len(a) else np.zeros(0, np.int64)
    out = np.zeros(len(a), np.int64)
    for size in np.unique(least):
        pairs = np.flatnonzero(least == size)
        used, at = np.unique(np.concatenate([a[pairs], b[pairs]]), return_inverse=True)
        rows = folded([maps[i] for i in used], int(size))
        left, right = at[: len(pairs)], at[len(pairs) :]
        step = max(1, COMPARED_BYTES // int(size))
        for i in range(0, len(pairs), step):
            out[pairs[i : i + step]] = np.bitwise_count(rows[left[i : i + step]] ^ rows[right[i : i + step]]).sum(axis=1)
    return out


def possible(n, m, apart, percent: int):
    """Whether sets of n and m shingles that differ by ``apart`` or more may be similar enough."""
    most = (n + m - apart) // 2
    return (100 * most >= percent * (n + m - most)) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))


def _exact(size: int, percent: int):
    def sets(batch, column):
        return [x for rows, data, bounds in W.texts([batch], column) for x in shingle_sets(data, bounds, size)]

    def run(batches):
        for b in batches:
            if not len(b):
                continue
            keep = []
            for x, y in zip(sets(b, "x"), sets(b, "y"), strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both) and both > 0)
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _tiles(percent: int):
    """Pairs of different groups within each block of a tile that the bit counts allow.

    The rows of a block follow each other; at most 2 * TILE rows and a batch are held.
    """

    def pairs(rows: pa.Table) -> pa.RecordBatch:
        key, p, q, node, root, n, side = (rows.column(k).to_numpy() for k in ("key", "p", "q", "node", "root", "n", "side"))
        new = np.append(True, (key[1:] != key[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1]))
        end = np.append(np.flatnonzero(new)[1:], len(key))[np.cumsum(new) - 1]
        kinds, first_of = np.unique(node, return_index=True)
        index = np.searchsorted(kinds, node)
        fit = []
        cut = np.cumsum(end - np.arange(len(key)) - 1)
        edges = np.searchsorted(cut, np.arange(0, (cut[-1] if len(cut) else 0) + PAIRS, PAIRS), "right")
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            j, i = W.runs(np.arange(lo, hi) + 1, end[lo:hi])
            i = i + lo
            keep = (root[i] != root[j]) & (side[i] + side[j] != 0) & ((side[i] != 1) | (side[j] != 1))
            keep &= 100 * np.minimum(n[i], n[j]).astype(np.int64) >= percent * np.maximum(n[i], n[j]).astype(np.int64)
            i, j = index[i[keep]], index[j[keep]]
            fit.append(np.unique(np.minimum(i, j) * len(kinds) + np.maximum(i, j)))
        code = np.unique(np.concatenate([np.zeros(0, np.int64), *fit]))
        a, b = code // max(1, len(kinds)), code % max(1, len(kinds))
        count = n[first_of].astype(np.int64)
        maps = rows.column("bits").take(pa.array(first_of)).to_pylist()
        keep = possible(count[a], count[b], distances(maps, a, b), percent)
        return pa.record_batch({"a": pa.array(kinds[a[keep]]), "b": pa.array(kinds[b[keep]])})

    def run(batches):
        held = None
        for batch in batches:
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            if not len(held):
                continue
            key, p, q = (held.column(k).to_numpy() for k in ("key", "p", "q"))
            last = np.flatnonzero((key != key[-1]) | (p != p[-1]) | (q != q[-1]))
            whole = int(last[-1]) + 1 if len(last) else 0
            if whole:
                yield pairs(held.slice(0, whole).combine_chunks())
                held = held.slice(whole)
        if held is not None and len(held):
            yield pairs(held.combine_chunks())

    return run


def _meet(rows: DataFrame, values: list) -> DataFrame:
    """rows (key, node, ...) with values over all rows of their key: (name, aggregate of rows, function that joins aggregates).

    The rows of a key are dealt by node to SALTS parts, and the values go to each part that has rows: no task gets a whole hot key.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    parts = salted.groupBy("key", "_salt").agg(*(first.alias(name) for name, first, _ in values))
    whole = parts.groupBy("key").agg(*(again(name).alias(name) for name, _, again in values), F.collect_list("_salt").alias("_salts"))
    return salted.join(whole.withColumn("_salt", F.explode("_salts")).drop("_salts"), ["key", "_salt"]).drop("_salt")


def join(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Links between documents, collapsed to groups: (rows, links).

    rows: for each row of docs its id, n_shingles and component_id, the least id reachable by links.
    links: the links (a, b) that were verified between representatives (least ids of equal sets); they
    connect every group, but not every linked pair of a group need be among them.

    Sets are those of ``size``-word shingles of the text in lower case (A-Z); texts of fewer words are
    one shingle, and null or empty ones, or without words, have none and link with nothing: their
    component is their own id. Two documents link when 100 * shared >= percent * all shingles.
    Ids are integers; rows of one id are one document and share a component. Rows without an id count
    as one document where their texts are equal; their component is null unless it has an id. An empty table
    gives empty ones.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent is over 50 and at most 100")
    small_batches(docs.sparkSession)
    text = F.col(text_col).cast("string")
    stand_in = F.lit(NO_ID) + F.pmod(F.xxhash64(F.coalesce(text, F.lit(""))), F.lit(1 << 40))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), stand_in).alias("id"), text.alias("text"))
    sets = stored(rows.mapInArrow(_sets(size, percent), "id long, n int, s1 long, s2 long, bits binary, keys array<long>"))
    nodes = sets.where("n > 0").groupBy("s1", "s2", "n").agg(F.min("id").alias("node"))
    members = stored(sets.select("id", "n", "s1", "s2").join(nodes, ["s1", "s2", "n"], "left").select("id", "n", F.coalesce("node", "id").alias("node")))

    postings = sets.select(F.explode("keys").alias("key"), "id")
    shared = postings.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    found = stored(postings.join(shared, "key"))
    to_node = members.where("n > 0").select("id", "node").distinct()
    many = to_node.groupBy("id").agg(F.min("node").alias("a"), F.count("*").alias("c")).where("c > 1")
    same_id = to_node.join(many, "id").where("node <> a").select("a", F.col("node").alias("b"))
    by_node = stored(found.join(to_node, "id").select("key", "node").distinct())
    drop(found)
    tiles = stored(_meet(by_node, [("c", F.count("*"), F.sum)]).where("c > 1").select("key", "node"))
    drop(by_node)
    marked = stored(tiles.select("node").distinct())
    bits = stored(sets.join(marked, sets["id"] == marked["node"], "left_semi").select(F.col("id").alias("node"), "n", "bits"))
    # texts are moved once, here, and not for each end of the pairs of each round; a merge join deals them by node
    bodies = bucketed(rows.join(marked.hint("merge"), rows["id"] == marked["node"], "left_semi").select(F.col("id").alias("node"), "text"), "node")
    drop(sets)
    drop(marked)

    def linked(pairs: DataFrame) -> DataFrame:
        """Of stored distinct pairs (a, b) those that link, stored: first by their bit counts, then decided on their texts."""

        counts = most_rows(pairs, "a", "b")

        def both(pairs: DataFrame, table: DataFrame, names: dict[str, tuple[str, str]]) -> DataFrame:
            for end, other, most in zip("ab", "ba", counts, strict=True):
                side = table.select(F.col("node").alias(end), *(F.col(c).alias(names[c]["ab".index(end)]) for c in names))
                pairs = spread_join(pairs, side, end, other, most)
            return pairs

        near = stored(both(pairs, bits, {"n": ("n", "m"), "bits": ("x", "y")}).select("a", "b", "n", "m", "x", "y").mapInArrow(_within(percent), "a long, b long"))
        out = stored(both(near, bodies, {"text": ("x", "y")}).select("a", "b", "x", "y").mapInArrow(_exact(size, percent), "a long, b long"))
        drop(near)
        drop(pairs)
        return out

    def grouped(rows: DataFrame, roots: DataFrame) -> DataFrame:
        return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))

    links = None
    roots = None
    left = tiles
    for pivot in (F.min, F.max):
        pairs = _meet(left, [("pivot", pivot("node"), pivot)]).where("node <> pivot")
        if roots is not None:
            pairs = stored(pairs)
            known = pairs.select("pivot").distinct().join(roots.select(F.col("node").alias("pivot"), F.col("root").alias("up")), "pivot", "left")
            pairs = spread_join(pairs, known, "pivot", "node", most_rows(pairs, "pivot")[0]).where("root <> coalesce(up, pivot)")
        pairs = stored(pairs.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct())
        new = linked(pairs)
        links = new if links is None else links.unionByName(new)
        roots = stars(new.unionByName(same_id) if roots is None else new.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))
        after = stored(_meet(grouped(tiles, roots), [("lo", F.min("root"), F.min), ("hi", F.max("root"), F.max)]).where("lo < hi").select("key", "node", "root"))
        if left is not tiles:
            drop(left)
        left = after
        if left.isEmpty():
            break

    if not left.isEmpty():
        # What is left: members of different groups in one tile. Tiles of one least member are one, so that tiles
        # of one passage are compared once. A large tile is cut into blocks, each pair of blocks a task's group.
        merged = stored(_meet(left, [("least", F.min("node"), F.min)]).select(F.col("least").alias("key"), "node", "root").distinct())
        sizes = merged.groupBy("key").agg(F.count("*").alias("c"))
        work = sizes.agg(F.sum(F.col("c") * F.col("c"))).first()[0]
        placed = _meet(merged, [("c", F.count("*"), F.sum)]).withColumn("parts", F.ceil(F.col("c") / TILE).cast("int"))
        placed = placed.withColumn("part", F.pmod(F.xxhash64("node", "key"), F.col("parts")).cast("int"))
        dealt = placed.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
        dealt = dealt.select("key", "node", "root", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), F.expr("CASE WHEN part = other THEN 2 WHEN part < other THEN 0 ELSE 1 END").alias("side"))
        blocks = dealt.join(bits, "node")
        # the number of tasks follows from the pairs of rows, not from the bytes, which few pairs of large tiles have
        tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(MOST_TASKS, -(-work // TASK_PAIRS)))
        near = blocks.repartition(tasks, "key", "p", "q").sortWithinPartitions("key", "p", "q")
        rest = near.select("key", "p", "q", "node", "root", "n", "side", "bits").mapInArrow(_tiles(percent), "a long, b long").distinct()
        new = linked(stored(rest))
        links = links.unionByName(new)
        if not new.isEmpty():
            roots = stars(new.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    for table in (tiles, bits):
        drop(table)
    drop_bucketed(bodies)
    kind = docs.schema[id_col].dataType.simpleString()
    named = grouped(members, roots).select(F.when(F.col("id") < NO_ID, F.col("id")).cast(kind).alias(id_col), F.col("n").cast("long").alias("n_shingles"), F.when(F.col("root") < NO_ID, F.col("root")).cast(kind).alias("component_id"))
    return named, links
