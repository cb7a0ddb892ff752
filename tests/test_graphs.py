"""Numbers in ranges, reachability and strongly connected components against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from lectern.operators import components, fixpoint, graph, layers, resolve, tasks


def plain_components(edges):
    """Tarjan's rule by reachability, for small graphs."""
    nodes = sorted({x for e in edges for x in e})
    reach = {n: {t for s, t in edges if s == n} for n in nodes}
    grown = True
    while grown:
        grown = False
        for n in nodes:
            more = set().union(*[reach[m] for m in reach[n]], reach[n])
            grown |= len(more) > len(reach[n])
            reach[n] = more
    out = {}
    for n in nodes:
        same = {m for m in nodes if m == n or (m in reach[n] and n in reach[m])}
        if len(same) > 1:
            out[n] = min(same)
    return out


def table(spark, edges, kind="long"):
    return spark.createDataFrame(edges, f"source {kind}, target {kind}").repartition(3)


CASES = {
    "chain": [(i, i + 1) for i in range(50)],
    "ring": [(i, (i + 1) % 37) for i in range(37)],
    "ring with a tail and a way in": [(i, (i + 1) % 11) for i in range(11)] + [(100 + i, 101 + i) for i in range(9)] + [(109, 3), (5, 200), (200, 201)],
    "chain back to its head": [(0, 1), (1, 2), (2, 3), (3, 0), (0, 10), (10, 11), (11, 0), (20, 0), (0, 30)],
    "two rings joined one way": [(0, 1), (1, 2), (2, 0), (2, 3), (3, 4), (4, 5), (5, 3)],
    "loops, repeats and nulls": [(1, 1), (1, 2), (1, 2), (None, 2), (2, None)],
    "complete": [(i, j) for i in range(6) for j in range(6) if i != j],
    "none": [],
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_strong_components(spark, name):
    edges = CASES[name]
    got = components.strong(table(spark, edges)).collect()
    assert len(got) == len({r.node for r in got})
    assert {r.node: r.component for r in got} == plain_components([e for e in edges if None not in e])


@pytest.mark.parametrize("seed, nodes, edges", [(1, 25, 30), (2, 30, 36), (3, 20, 60)])
def test_strong_components_of_random_graphs(spark, seed, nodes, edges):
    rng = random.Random(seed)
    made = [(f"n{rng.randrange(nodes)}", f"n{rng.randrange(nodes)}") for _ in range(edges)]
    assert {r.node: r.component for r in components.strong(table(spark, made, "string")).collect()} == plain_components(made)


def test_long_chain_ends_in_trims(spark, monkeypatch):
    """A chain never reaches the colours, and takes rounds by the logarithm of its length."""
    monkeypatch.setattr(components, "_coloured", None)
    chain = spark.range(20_000).select(F.col("id").alias("source"), (F.col("id") + 1).alias("target"))
    assert graph.on_cycle(chain).isEmpty() and graph.cycles(chain).isEmpty()


@pytest.mark.parametrize("seed", [1, 2])
def test_reachable(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(30), rng.randrange(30)) for _ in range(28)] + [(40 + i, 41 + i) for i in range(13)]
    starts = [("a", rng.randrange(30)), ("a", rng.randrange(30)), ("b", 40), ("c", 99), ("b", rng.randrange(30))]
    paths = graph.closure(table(spark, edges))
    asked = spark.createDataFrame(starts, "query string, node long")
    expected = asked.join(paths, F.col("node") == F.col("source")).select("query", "target").distinct()
    got = sorted(map(tuple, graph.reachable(table(spark, edges), asked, merge_after=3).collect()))
    assert got == sorted(map(tuple, expected.collect()))


def test_numbers_within_a_key(spark):
    """One key with most rows is shared by ranges; nulls are a key."""
    rng = random.Random(1)
    rows = [(rng.choice(["hot"] * 8 + ["a", "b", None]), rng.randrange(10**6), i) for i in range(6000)]
    table_ = spark.createDataFrame(rows, "key string, x long, i long").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = fixpoint.ranked(table_, F.desc("x"), "i", by=("key",))
        assert got.where("key = 'hot'").select(F.spark_partition_id()).distinct().count() > 1
        rows_ = {r.i: r.n for r in got.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for key in ("hot", "a", "b", None):
        mine = sorted(((-x, i) for k, x, i in rows if k == key))
        assert [rows_[i] for _, i in mine] == list(range(1, len(mine) + 1))


def test_reindex_has_no_window_over_a_book(spark):
    nodes = spark.createDataFrame([(f"math_7a_rjb_x{i}", ["Concept", "Skill", "Book"][i % 3], i) for i in range(30)], "id string, label string, ord long")
    got = resolve.reindex(nodes)
    assert {r.id: r.new_id for r in got.collect()} == {f"math_7a_rjb_x{i}": f"math_7a_rjb_{['cpt', 'skl'][i % 3]}{i // 3 + 1}" for i in range(30) if i % 3 < 2}
    assert "row_number" not in got._jdf.queryExecution().toString()


def _sizes(spark, monkeypatch):
    """Rows of all tables that graph stores from now on."""
    sizes, plain = [], graph.stored
    monkeypatch.setattr(graph, "stored", lambda df: (lambda t: sizes.append(t.count()) or t)(plain(df)))
    return sizes


def test_pairs_of_chains_are_not_stored(spark, monkeypatch):
    """A chain of 100 nodes has 4,950 pairs; only its nodes and edges are stored. Branches, rings and what touches them go the general way."""
    chain = [(i, i + 1) for i in range(100)]
    other = [(200, 201), (201, 202), (202, 200), (202, 203), (301, 302), (300, 302), (302, 303), (400, 400), (401, 402), (402, 401)]
    sizes = _sizes(spark, monkeypatch)
    found = graph.closure(spark.createDataFrame(chain, "source long, target long"))
    assert {tuple(r) for r in found.collect()} == {(i, j) for i in range(101) for j in range(i + 1, 101)}
    assert found.count() == 5050 and max(sizes) <= 101
    mixed = graph.closure(spark.createDataFrame(chain[:9] + other, "source long, target long")).collect()
    expected = set(chain[:9] + other)
    while True:
        more = {(a, d) for a, b in expected for c, d in expected if b == c} - expected
        if not more:
            break
        expected |= more
    assert sorted(map(tuple, mixed)) == sorted(expected)


def test_blocks_of_a_chain(spark):
    at = spark.createDataFrame([(i, 0, 10 - i) for i in range(11)], "node long, end long, left long")
    rows = [tuple(r) for r in graph.along(at, block=3).collect()]
    assert sorted(rows) == [(i, j) for i in range(11) for j in range(i + 1, 11)]


def test_long_rings_are_listed_without_their_paths(spark, monkeypatch):
    ring = [(i, (i + 1) % 60) for i in range(60)]
    sizes = _sizes(spark, monkeypatch)
    found = graph.cycles(spark.createDataFrame(ring + [(70, 71), (71, 70), (71, 72), (72, 71)], "source long, target long")).collect()
    assert [tuple(r) for r in found] == [(">".join(map(str, range(60))), 60), ("70>71", 2), ("71>72", 2)]
    assert sum(sizes) < 60 * 20


def test_pool_keeps_pairs_of_one_place_apart(spark, monkeypatch):
    """Queries with one place need no distinct over pairs; those with several give each node once."""
    at = spark.createDataFrame([("a", "section", "x"), ("b", "section", "x"), ("b", "section", "y"), ("n", "section", "x"), ("n", "section", "y"), ("m", "section", "y"), ("n", "section", "x")], "node_id string, level string, value string")
    nodes = spark.createDataFrame([("n", "Concept"), ("m", "Concept"), ("a", "Skill")], "id string, label string")
    asked = spark.createDataFrame([("a", "a"), ("b", "b")], "query string, node string")
    for salts in (1, 3):
        rows = graph.pool(at, nodes, asked, "section", ("Concept",), salts)
        assert sorted(map(tuple, rows.collect())) == [("a", "n"), ("b", "m"), ("b", "n")]


def test_wider_layers_are_stored_once(spark, monkeypatch):
    """A wider layer is added to the ones before without writing these again, and full queries get no more."""
    nodes = spark.createDataFrame([(x, "Concept", x) for x in "abcdef"], "id string, label string, name string")
    places = [("a", "section", "s"), ("b", "section", "s"), ("a", "chapter", "c"), ("c", "chapter", "c"), ("a", "book", "k"), ("d", "book", "k"), ("a", "subject", "u"), ("e", "subject", "u")]
    g = tasks.Graph(nodes, spark.createDataFrame([], "source string, target string, type string"), spark.createDataFrame(places, "node_id string, level string, value string"))
    rows = lambda data, columns: spark.createDataFrame(data, columns)
    parts = tasks.Parts(rows([("q", "a")], "query string, node string"), rows([("q", "f")], "query string, node string"), rows([("q", 1, "f")], "query string, layer int, node string"), ("Concept",), 3, (("Concept",), 2, False))
    kept, plain = [], tasks.stored
    monkeypatch.setattr(tasks, "stored", lambda df: (lambda t: kept.append(t) or t)(plain(df)))
    found = sorted(tuple(r) for r in tasks.filled(g, parts).select("query", "layer", "node").collect())
    assert found == [("q", 1, "f"), ("q", 2, "a"), ("q", 2, "b"), ("q", 3, "a"), ("q", 3, "c"), ("q", 4, "a"), ("q", 4, "d")]
    written = [tuple(r) for t in kept if "layer" in t.columns for r in t.select("query", "layer", "node").collect()]
    assert sorted(written) == found


def test_rows_of_a_query_are_moved_once(spark):
    """Answers and their names go without moving the rows again, also of a union, and a node in several places of a query is one pair."""
    rows = spark.createDataFrame([("q", "a", "x"), ("q", "b", "y"), ("q", "c", "z"), ("r", "a", "x")], "query string, node string, name string")
    barred, taken = spark.createDataFrame([("q", "a")] * 2, "query string, node string"), spark.createDataFrame([("q", "z")], "query string, name string")
    kept = layers.without(rows.union(rows), barred, taken)
    assert sorted(map(tuple, kept.collect())) == [("q", "b", "y")] * 2 + [("r", "a", "x")] * 2
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Repartition") < plan.index("Union")
    places = spark.createDataFrame([(f"q{i}", v) for i in range(130) for v in ("s", "t")], "query string, value string")
    members = spark.createDataFrame([(v, n, n, "Concept") for v in "st" for n in "ab"] + [("u", "c", "c", "Concept")], "value string, node string, name string, label string")
    found = tasks._pairs(places, members, ["value"]).collect()
    assert sorted((r.query, r.node) for r in found) == sorted((f"q{i}", n) for i in range(130) for n in "ab")


def test_edges_are_aggregated_in_all_parts_of_a_shuffle(spark):
    """Edges are moved once for their sources, and their parts are not merged by size."""
    nodes = spark.createDataFrame([(x, x.upper()) for x in "abc"] + [(f"o{i}", "") for i in range(40)], "id string, name string")
    edges = spark.createDataFrame([(f"o{i}", t, "tests_concept", o) for i in range(40) for o, t in enumerate("bab")], "source string, target string, type string, ord int")
    mapping = spark.createDataFrame([("c", "a")], "id string, canonical string")
    rows = resolve.aggregated(resolve.rebuild_edges(edges, mapping, nodes))
    assert {tuple(t.target + t.target_name for t in r.target_name_to_ids) for r in rows.collect()} == {("bB", "aA")}
    assert rows.count() == 40
    tasks_ = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = resolve.aggregated(resolve.rebuild_edges(edges, mapping, nodes))._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "REPARTITION_BY_NUM" in line]
    assert len(moved) == 3 and all(f", {tasks_})" in line for line in moved)


def test_hops_of_a_hub_are_not_moved_as_pairs(spark):
    """Leaves of a hub see each other in two hops; what is moved are blocks of queries, not pairs."""
    pairs = spark.createDataFrame([p for i in range(130) for p in ((0, i + 1), (i + 1, 0))], "node long, other long")
    starts = spark.createDataFrame([(f"q{i}", i) for i in range(131)] + [("both", 0), ("both", 1)], "query string, node long")
    found = graph.exact_hops(pairs, starts)
    assert sorted(map(tuple, found.collect())) == sorted((f"q{i}", j) for i in range(1, 131) for j in range(1, 131) if i != j)
    assert "hashpartitioning(query" not in found._jdf.queryExecution().executedPlan().toString()


def test_places_past_a_full_layer_are_not_made(spark):
    """Layers of earlier places are made only for first places whose layers before may be short; what layered() keeps is what all pairs give."""
    sections = [f"physics_{code}_rjb_ch{c}_s{s}" for code in ("7a", "8a") for c in range(1, 5) for s in range(1, 5)]
    nodes = [(s, "Section", s) for s in sections] + [(f"physics_8a_rjb_cpt{i}", "Concept", f"c{i}") for i in range(3)]
    placed = [("physics_8a_rjb_cpt0", sections[-1]), ("physics_8a_rjb_cpt1", sections[17]), ("physics_8a_rjb_cpt2", sections[0])]
    n = spark.createDataFrame(nodes, "id string, label string, name string")
    appears = spark.createDataFrame(placed, "source string, target string")
    part_of = spark.createDataFrame([(s, s.rsplit("_s", 1)[0]) for s in sections], "source string, target string")
    g = tasks.Graph(n, spark.createDataFrame([], "source string, target string, type string"), graph.locations(n, appears, part_of))
    parts = tasks.first_place(g, "Section")
    made = {(r.query[-1], r.layer) for r in parts.candidates.select("query", "layer").distinct().collect()}
    # the last place has 15 names in its book, the 18th has 3 in its chapter and 17 in its stage, the first has 3 and none before it
    assert made == {("0", 1), ("0", 2), ("0", 3), ("1", 1), ("1", 2), ("1", 3), ("1", 4), ("2", 1), ("2", 2)}


def test_pairs_of_one_value_are_dealt_to_many_tasks(spark):
    rows = spark.range(40).selectExpr("id AS query", "'x' AS value")
    members = spark.range(50).selectExpr("id AS node", "'x' AS value")
    made = graph.dealt(rows, members, ["value"], 1)
    assert made.distinct().count() == 2000
    assert made.select(F.spark_partition_id()).distinct().count() > 1


def test_graph_of_chapters_has_no_content(spark):
    from lectern.plans.standin import school

    g = school(spark, "/root/testdata/sf0.001", (), ("leads_to",))
    whole = school(spark, "/root/testdata/sf0.001")
    assert {r.label for r in g.nodes.select("label").distinct().collect()} == {"Book", "Chapter", "Section"}
    assert {r.type for r in g.edges.select("type").distinct().collect()} == {"leads_to"}
    assert sorted(g.edges.collect()) == sorted(whole.edges.where("type = 'leads_to'").collect())
    assert sorted(g.nodes.collect()) == sorted(whole.nodes.where("label IN ('Book', 'Chapter', 'Section')").collect())


def test_hops_of_an_answer_are_found_once(spark, monkeypatch):
    """Task 2.1 starts its hops from each node once, however many queries it answers."""
    chain = [(f"n{i}", f"n{i + 1}", "prerequisites_for") for i in range(9)]
    nodes = spark.createDataFrame([(f"n{i}", "Concept", f"n{i}") for i in range(10)], "id string, label string, name string")
    g = tasks.Graph(nodes, spark.createDataFrame(chain, "source string, target string, type string"), spark.createDataFrame([], "node_id string, level string, value string"))
    starts, plain = [], graph.exact_hops
    monkeypatch.setattr(graph, "exact_hops", lambda pairs, rows, hops=2: starts.append(rows.count()) or plain(pairs, rows, hops))
    parts = tasks.predecessors(g)
    assert starts == [9]
    found = {(r.query, r.node) for r in parts.candidates.where("layer = 2").collect()}
    # two steps after an answer, or before it where that is no answer itself
    assert found == {(f"n{i}", f"n{j + 2}") for i in range(1, 10) for j in range(i) if j + 2 < 10 and j + 2 >= i}
