"""Answers over restarts, stored vectors, as-of places, cubes and sketches on small cases."""

import random

import pytest
from pyspark.sql import functions as F

from lectern.operators import evaluate, graph, sketches, vectors
from lectern.streaming import answers
from lectern.streaming import evaluate as stream


def _file(path, name, *rows):
    path.mkdir(exist_ok=True)
    (path / name).write_text("".join(f'{{"id": "{i}", "prompt": "{p}", "gold": ["A"]}}\n' for i, p in rows))


def test_answers_survive_a_kill(spark, tmp_path):
    """The second of three files kills the run; after the restart no id has two answers and no finished call is repeated."""
    into, out, mark, calls = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark"), tmp_path / "calls"
    calls.mkdir()
    fatal = tmp_path / "fatal"
    fatal.touch()

    def model(prompt):
        import uuid

        (calls / f"{prompt}-{uuid.uuid4().hex}").touch()
        if prompt == "fatal" and fatal.exists():
            raise SystemExit("killed")
        if prompt.startswith("bad"):
            raise ValueError("no")
        return "A"

    called = lambda prompt: len(list(calls.glob(f"{prompt}-*")))
    start = lambda: answers.run(stream.questions(spark, str(into)), model, out, mark, attempts=2, most=3)
    _file(into, "1.json", ("a", "one"), ("b", "bad1"), ("a", "one"))
    start().awaitTermination()
    _file(into, "2.json", ("a", "one"), ("c", "fatal"))
    with pytest.raises(Exception):  # noqa: B017  the worker's exit ends the query
        start().awaitTermination()
    fatal.unlink()
    _file(into, "3.json", ("c", "fatal"), ("b", "bad1"), ("d", "four"))
    start().awaitTermination()
    _file(into, "4.json", ("b", "bad1"), ("d", "four"), ("a", "one"))
    start().awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert sorted(r.id for r in rows if not r.failed) == ["a", "c", "d"] and all(r.exact_match == 1.0 for r in rows if not r.failed)
    # a failed id had two calls, then the one left of three, then none
    assert sorted(r.calls for r in rows if r.id == "b") == [2, 3] and called("bad1") == 3 and called("one") == 1 and called("four") == 1
    assert {r.id: r.failed for r in answers.latest(spark.read.parquet(out)).collect()} == {"a": False, "b": True, "c": False, "d": False}


def test_vectors_are_made_once(spark, tmp_path):
    asked = tmp_path / "asked"
    asked.mkdir()

    def load():
        import uuid

        def model(texts):
            for t in texts:
                (asked / f"{t}-{uuid.uuid4().hex}").touch()
            return [[float(len(t)), 1.0] for t in texts]

        return model

    path = str(tmp_path / "vectors")
    table = lambda *texts: spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    first = vectors.fill(table("a", " a ", "bb", "", None, "a  b"), path, "t1", load)
    assert {r.text: r.vector for r in first.collect()} == {"a": [1, 1], "bb": [2, 1], "a b": [3, 1]}
    again = vectors.fill(table("bb", "cccc", "a"), path, "t1", load, batch=1)
    assert sorted(r.text for r in again.collect()) == ["a", "a b", "bb", "cccc"]
    assert sorted(p.name.split("-")[0] for p in asked.iterdir()) == ["a", "a b", "bb", "cccc"]
    nodes = spark.createDataFrame([("q", 1, "bb"), ("q", 2, "a"), ("q", 3, " bb"), ("q", 4, "none"), ("q", 5, "cccc")], "query string, node long, text string")
    got = vectors.nearest(spark.createDataFrame([("q", "bb")], "query string, text string"), nodes, again, most=4)
    assert [(r.node, r.rank) for r in got.orderBy("rank").collect()] == [(1, 1), (3, 2), (5, 3), (2, 4)]


def test_as_of_places(spark):
    rng = random.Random(4)
    asks = [(i, rng.choice(["hot"] * 6 + ["b", None]), rng.randrange(400)) for i in range(900)]
    places = [(i, rng.choice(["hot"] * 6 + ["b", None, "c"]), rng.randrange(400)) for i in range(300)]
    expected = []
    for i, scope, key in asks:
        before = [(k, p) for p, s, k in places if s == scope and k < key]
        expected.append((i, max(before)[1] if before else None))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = graph.as_of(spark.createDataFrame(asks, "id long, scope string, key long"), spark.createDataFrame(places, "place long, scope string, key long"))
        assert sorted((r.id, r.place) for r in got.collect()) == expected
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_cube_tells_nulls_from_totals(spark):
    rows = spark.createDataFrame([("m", None, 1.0), ("m", "t", 0.0), ("n", "t", 1.0)], "model string, task string, exact_match double").withColumns({m: F.col("exact_match") for m in evaluate.METRICS[1:]})
    got = {(r.model, r.task, r.level): (r["count"], r.f1) for r in evaluate.cube(rows, "model", "task").collect()}
    assert got[None, None, 3] == (3, 2 / 3) and got["m", None, 0] == (1, 1.0) and got["m", None, 1] == (2, 0.5) and got[None, None, 2] == (1, 1.0) and got[None, "t", 2] == (2, 0.5)


def test_unions_of_sketches(spark):
    rows = spark.range(6_000).select((F.col("id") % 3).alias("book"), F.lit("s").alias("subject"), (F.col("id") % 2_000).alias("name"))
    got = {(r.level, r.graph): r.names for r in sketches.estimates(sketches.built(rows.withColumn("book", F.col("book").cast("string")), "name", ("book", "subject")), ("book", "subject")).collect()}
    assert len(got) == 4 and all(abs(n - 2_000) <= 4 * sketches.error() * 2_000 for n in got.values())
