import random

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lectern.llm import registry

DATA = "/root/testdata/sf0.001"


def test_stages_keep_clean_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    clean = {r.doc_id for r in spark.read.parquet(f"{DATA}/labels.parquet").where("quality = 1").collect()}
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    good = corpus_pipeline.by_quality(spark, docs, DATA)
    assert good.columns == docs.columns and len(clean - ids(good)) <= 0.02 * len(clean)
    first = corpus_pipeline.without_near_duplicates(spark, good, DATA)
    assert first.columns == docs.columns and ids(first) <= ids(good) and first.count() == len(ids(first))
    rest = corpus_pipeline.without_benchmark(spark, first, DATA)
    assert rest.columns == docs.columns and 0 < len(ids(first) - ids(rest)) < 20
    safe = corpus_pipeline.without_secrets(spark, rest, DATA)
    assert safe.columns == docs.columns and ids(safe) == ids(rest) and safe.where("text RLIKE 'token = \"[0-9a-f]{40}'").count() == 0
    assert corpus_pipeline.mixed(spark, safe, DATA).count() > 0.7 * safe.count()


def test_stages_take_odd_rows(spark):
    rng = random.Random(1)
    text = " ".join(f"word{rng.randrange(900)}" for _ in range(80)) + "."
    rows = [(1, text, "en", "s", 1), (2, text, "en", "s", 1), (1, text, "en", "s", 1), (None, None, None, None, None), (3, "", "en", "s", 0), (4, "short", None, None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.without_near_duplicates(spark, docs, DATA)
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "None"]
    for table in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            table = stage(spark, table, DATA)
        table.count()


def test_decisions_apply_to_rows_without_an_id(spark):
    rng = random.Random(2)
    new = lambda: " ".join(f"word{rng.randrange(9000)}" for _ in range(60))
    leak = next(r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").orderBy("item_id").collect() if r.text and len(r.text.split()) > 12)
    a, b, c = new(), new(), new()
    rows = [(1, a), (None, a), (None, a + " more"), (None, b), (None, b), (None, b + " end"), (None, c), (None, f"{c} {leak} {c}"), (2, f"{a} {leak}"), (None, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clean = corpus_pipeline.without_benchmark(spark, docs, DATA)
    assert clean.columns == docs.columns
    assert sorted(map(tuple, clean.collect()), key=repr) == sorted((r for r in rows if leak not in (r[1] or "")), key=repr)
    kept = [tuple(r) for r in corpus_pipeline.without_near_duplicates(spark, docs.where(~F.coalesce(F.contains("text", F.lit(leak)), F.lit(False))), DATA).collect()]
    assert (1, a) in kept and (None, c) in kept and kept.count((None, None)) == 2
    assert len(kept) == 5 and sum(t is not None and t.startswith(b) for _, t in kept) == 1


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    got = registry.QUERIES[name](spark, DATA)
    expected = con.execute(registry.SQL[name]).df()
    rows = [tuple(r[c] for c in sorted(got.columns)) for r in got.collect()]
    assert sorted(rows, key=repr) == sorted(expected[sorted(expected.columns)].itertuples(index=False, name=None), key=repr)
