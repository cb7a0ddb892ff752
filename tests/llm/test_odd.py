"""Shared windows, long items, rows without ids, and columns with clashing names."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from lectern.llm import jaccard, media, mixing, phrases, quality, secrets, substring, tokens


def test_items_that_share_a_window(spark):
    """The work is that of places and of items, not of their product."""
    docs = spark.createDataFrame([(i, "alpha " * 500) for i in range(20)], "doc_id long, text string")
    items = spark.range(5_000).select(F.col("id").cast("string").alias("item_id"), F.lit("Alpha!").alias("text"))
    got = phrases.contamination(docs, items).select("n_words", "n_hit", "n_items").distinct().collect()
    assert [tuple(r) for r in got] == [(500, 500, 5_000)]


def test_items_longer_than_a_block(spark, monkeypatch):
    """Texts of one id fall into several blocks, and a long one into pieces."""
    monkeypatch.setattr(phrases, "BLOCK_WORDS", 40)
    rng = random.Random(1)
    words = [f"w{rng.randrange(50)}" for _ in range(900)]
    docs = [(i, " ".join(rng.sample(words, 15) + words[i * 7 : i * 7 + rng.randrange(8, 30)])) for i in range(100)]
    items = [("a", " ".join(words[:600])), ("a", " ".join(words[500:])), ("a", "w1 w2"), (None, " ".join(words[100:140])), ("b", None), ("c", "")]
    item_words = [(n or "null", (t or "").split()) for n, t in items]
    expected = []
    for i, text in docs:
        w, hit, found = text.split(), set(), set()
        for name, q in item_words:
            k = min(10, len(q))
            for a in range(len(q) - k + 1 if k else 0):
                for p in range(len(w) - k + 1):
                    if w[p : p + k] == q[a : a + k]:
                        hit |= set(range(p, p + k))
                        found.add(name)
        expected.append((i, len(w), len(hit), len(found)))
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = phrases.contamination(table, spark.createDataFrame(items, "item_id string, text string"))
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.n_items) for r in got.collect()) == expected


def test_rows_without_an_id_have_their_own_draws(spark):
    rows = spark.range(4_000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"), F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("source"))
    got = mixing.mix(rows).groupBy("source").count().collect()
    assert all(abs(r["count"] - 2_000) < 200 for r in got) and len(got) == 2


def test_clashing_columns_stay(spark):
    """Columns named as those that operators make inside come back as they were."""
    text = " ".join(f"word{i}" for i in range(60))
    names = ("_key", "_quality_text", "_QUALITY_TEXT_", "_secret_text", "_secret_path", "_mix", "component_id", "h", "id", "key", "found")
    rows = [(i, f"{text} {i}", "en", "s", 7, *range(len(names))) for i in range(4)] + [(None, text, "en", "s", 7, *range(len(names)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} int" for n in names))
    kept = docs
    for name, stage in corpus_pipeline.STAGES[1:]:
        kept = stage(spark, kept, "/root/testdata/sf0.001")
        assert kept.columns[: len(docs.columns)] == docs.columns, name
        assert {tuple(r)[5 : 5 + len(names)] for r in kept.collect()} <= {tuple(range(len(names)))}, name
    whole = quality.classify(docs)
    assert whole.columns == [*docs.columns, "quality_score", "quality_keep"] and whole.count() == 5
    assert secrets.scan(docs).columns[: len(docs.columns)] == docs.columns
    for made in (substring.dedup(docs), phrases.contamination(docs, docs.select(F.lit("i").alias("item_id"), "text")), tokens.count(docs), jaccard.join(docs)[0], media.read_ogg(media.to_ogg(docs))):
        assert made.count() == 5


def test_media_of_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert media.read_ogg(media.to_ogg(docs)).count() == 0
