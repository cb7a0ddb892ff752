"""Line dedup, filter audit and centroid clustering against plain versions of their rules."""

import math
import random
import re
from collections import Counter
from hashlib import sha256
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm import audit, exponion, lines

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SPACE = " \t\n\x0b\x0c\r"


# ---- line dedup


def texts_with_lines(seed=3):
    """Lines shared by few and many documents, in other case and with spaces, long documents, nulls, repeats and no ids."""
    rng = random.Random(seed)
    pool = [f"Line {i} " + "x" * rng.randrange(20, 60) for i in range(40)] + ["é" * 40, "É" * 40, "y" * 39, "z" * 40, ""]
    rows = []
    for i in range(120):
        some = [rng.choice(pool) for _ in range(rng.randrange(0, 12))]
        some = [rng.choice([x, x.upper() if x.isascii() else x, f" \t{x}\r"]) for x in some]
        rows.append((i * 7 - 50, "\n".join(some)))
    rows += [(rows[3][0], rows[3][1]), (rows[4][0], rows[4][1] + "\nmore"), (None, rows[5][1]), (None, rows[5][1]), (None, None), (900, None), (901, ""), (902, "\n\n"), (903, "\n".join(pool * 30))]
    rng.shuffle(rows)
    return rows


def plain_dedup(rows, min_docs, min_chars):
    key = lambda line: line.strip(SPACE).translate(LOWER)
    held = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                held.setdefault(key(line), set()).add(i)
    last = {k: max((i for i in ids if i is not None), default=None) for k, ids in held.items() if len(ids) >= min_docs}
    out = []
    for i, text in rows:
        all_ = (text or "").split("\n")
        kept = [x for x in all_ if key(x) not in last or last[key(x)] == i]
        out.append((i, len(all_), len(all_) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("batches, fanout, min_docs", [(1, 2, 5), (4, 2, 5), (5, 3, 2), (7, 2, 1)])
def test_line_dedup(spark, batches, fanout, min_docs):
    rows = texts_with_lines()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = lines.dedup(docs, batches=batches, fanout=fanout, min_docs=min_docs)
    assert got.columns == ["doc_id", "text", "n_lines", "n_dropped", "kept"]
    plain = plain_dedup(rows, min_docs, 40)
    assert sum(r[2] for r in plain) > 50
    assert sorted([(r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got.collect()], key=repr) == plain


def test_line_dedup_of_hot_lines(spark, monkeypatch):
    rows = texts_with_lines(4)
    monkeypatch.setattr(lines, "HOT_KEYS", 30)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted([(r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in lines.dedup(docs).collect()], key=repr) == plain_dedup(rows, 5, 40)


def test_line_dedup_takes_odd_tables(spark):
    docs = spark.createDataFrame([(1, "a", 2, 3, "k")], "doc_id long, text string, _line_a int, h int, kept string")
    got = lines.dedup(docs)
    assert got.columns == ["doc_id", "text", "_line_a", "h", "n_lines", "n_dropped", "kept"]
    assert [tuple(r) for r in got.collect()] == [(1, "a", 2, 3, 1, 0, "a")]
    assert lines.dedup(docs.limit(0)).count() == 0
    with pytest.raises(TypeError, match="no integers"):
        lines.dedup(docs.withColumn("doc_id", F.lit("d1")))


def test_runs_are_compacted(spark):
    runs = lines.Runs(spark, min_docs=3, fanout=2, buckets=2)
    rng, seen = random.Random(1), []
    for _ in range(5):
        batch = [(rng.randrange(30), 0, rng.randrange(1, 3), rng.randrange(100)) for _ in range(12)]
        batch = list({r[0]: r for r in batch}.values())
        seen.append(batch)
        runs.add(spark.createDataFrame(batch, "h long, g long, n long, last long"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    rows = runs.known().collect()
    known = {r.h: (r.n, r.last) for r in rows}
    assert len(known) == len(rows)
    total = Counter()
    for batch in seen:
        for h, _, n, _ in batch:
            total[h] += n
    assert set(known) == set(total) and all(known[h][0] == total[h] for h in total if total[h] < 3) and all(known[h][0] >= 3 for h in total if total[h] >= 3)
    # runs are joined where they lie
    plan = runs.known()._jdf.queryExecution().toString()
    assert "Bucketed: true" in plan and "Exchange" not in plan
    runs.clear()
    assert not list(runs) and not [t for t in spark.catalog.listTables() if t.name.startswith("lectern_run")]


# ---- filter audit


def plain_mask(text, copy):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    fails = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), bool(re.search("[#$%&*|]", text)), copy]
    return fails


def plain_audit(rows, labels):
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, x in labels if x == 1 and i is not None}
    fails = [(p or "", i, plain_mask(t or "", (t or "") in first and (i is None or i > first[t or ""]))) for i, t, p in rows]
    out, by_filter = [], Counter()
    for part in {p for p, _, _ in fails}:
        mine = [(i, f) for p, i, f in fails if p == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, letter in enumerate(order, 1):
                k = "ABCDE".index(letter)
                gone = [(i, f) for i, f in left if f[k]]
                left = [x for x in left if not x[1][k]]
                redundant = sum(f[k] for _, f in mine) - len(gone)
                alone = sum(f[k] and sum(f) == 1 for _, f in mine)
                out.append((part, "".join(order), step, len(left), len(gone), redundant, alone, sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)))
                by_filter[part, letter] += len(gone)
    return sorted((*r, by_filter[r[0], r[1][r[2] - 1]]) for r in out)


def test_filter_audit(spark):
    rng = random.Random(5)
    text = lambda: " ".join(rng.choice([f"w{rng.randrange(9)}", f"w{rng.randrange(900)}", "Up", "#", "é漢"]) for _ in range(rng.choice([0, 5, 199, 200, 400])))
    pool = [text() for _ in range(30)] + ["", None, " \n ", "A", "x" * 100]
    rows = [(rng.choice([None, *range(150)]), rng.choice(pool), rng.choice(["en", "de", "", None])) for _ in range(200)]
    rows += [(7, "same", "en"), (7, "same", "en"), (8, "same", "de"), (None, "same", "de"), (None, "alone", "en"), (None, "alone", "en")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 150, 2)] + [(2, 1, 1), (2, 0, 0), (None, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("mask", F.lit(1))
    got = audit.audit(audit.cells(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))).drop("filter")
    assert sorted(tuple(r) for r in got.collect()) == plain_audit(rows, labels)
    assert audit.audit(audit.cells(docs.limit(0), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))).count() == 0


# ---- centroid clustering


def plain_clusters(rows, k, rounds, dims):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (sha256(f"2:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    c = [v for _, v in first]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, m, strict=True)), j) for j, m in enumerate(c))
    for _ in range(rounds):
        at = [near(v)[1] for _, v in kept]
        for j in range(len(c)):
            mine = [v for (_, v), a in zip(kept, at, strict=True) if a == j]
            if mine:
                c[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    found = [(i, *near(v)) for i, v in kept]
    inertia = Counter()
    for _, d, j in found:
        inertia[j] += d
    return sorted([(i, j, d, inertia[j], sum(inertia.values()), sha256(",".join(map(str, c[j])).encode()).hexdigest()) for i, d, j in found], key=repr)


@pytest.mark.parametrize("spread", [2, 40])
def test_centroid_clustering(spark, spread):
    """Coarse values give many ties and equal centroids."""
    rng = random.Random(spread)
    rows = [(i, [rng.randrange(-spread, spread) / 256 for _ in range(4)]) for i in range(300)]
    rows += [(300, None), (301, []), (302, [1.0, 2.0, 3.0]), (303, [1.0, None, 0.0, 0.0]), (304, [math.nan, 0.0, 0.0, 0.0]), (305, [math.inf, 0.0, 0.0, 0.0]), (None, [0.01, -0.01, 0.0, 0.0]), (5, rows[5][1]), (5, rows[6][1])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"cluster": F.lit("x"), "v": F.lit(1)}).repartition(5)
    got = exponion.cluster(vectors, k=12, rounds=5, dims=4)
    assert sorted([tuple(r) for r in got.collect()], key=repr) == plain_clusters(rows, 12, 5, 4)


def test_few_and_no_vectors(spark):
    rows = [(1, [0.0, 1.0]), (2, [1.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in exponion.cluster(vectors, dims=2).collect()) == plain_clusters(rows, 40, 5, 2)
    assert exponion.cluster(vectors, dims=3).count() == 0 and exponion.cluster(vectors.limit(0), dims=2).count() == 0


def test_search_compares_few_centroids():
    """Far groups of centroids: after the first round most vectors need no centroid outside a small ball."""
    rng = np.random.default_rng(1)
    centres = rng.integers(-4000, 4000, (32, 8))
    x = np.repeat(centres, 40, 0) + rng.integers(-30, 30, (1280, 8))
    before = centres + rng.integers(-20, 20, centres.shape)
    state = exponion.Search(before, None).first(x)
    compared = []
    real = exponion.two_nearest
    exponion.two_nearest = lambda d: (compared.append(d.size), real(d))[1]
    try:
        cluster, upper, lower = exponion.Search(centres, before).again(x, *state)
    finally:
        exponion.two_nearest = real
    d = exponion.squared(x, centres)
    assert (cluster == d.argmin(1)).all() and sum(compared) < d.size / 10
    assert (upper**2 >= d.min(1)).all() and (lower <= np.sqrt(np.sort(d, 1)[:, 1])).all()


def test_large_integers_are_exact():
    x = np.array([[exponion.MOST, 3], [1, 2]], np.int64)
    c = np.array([[-exponion.MOST, 2], [1, 2]], np.int64)
    assert exponion.squared(x, c).tolist() == [[(2 * exponion.MOST) ** 2 + 1, (exponion.MOST - 1) ** 2 + 1], [(1 + exponion.MOST) ** 2, 0]]


def test_regression_takes_features_in_blocks(monkeypatch):
    import tracemalloc

    from lectern.llm import quality as Q

    monkeypatch.setattr(Q, "STEPS", 2)
    rng = np.random.default_rng(3)
    row, bucket = np.sort(rng.integers(0, 3_000, 2_000_000)).astype(np.int32), rng.integers(0, Q.BUCKETS, 2_000_000).astype(np.int32)
    value, target = (rng.random(2_000_000) / 600).astype(np.float32), rng.random(3_000)
    tracemalloc.start()
    got = Q.regress(row, bucket, value, target, 0.5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 25e6
    monkeypatch.setattr(Q, "BLOCK", len(row), raising=False)
    assert np.abs(got - Q.regress(row, bucket, value, target, 0.5)).max() < 1e-12
