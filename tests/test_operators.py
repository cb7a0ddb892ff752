import duckdb
from pyspark.sql import functions as F

from lectern.config import Settings, expanded, load_env
from lectern.functions import ids
from lectern.operators import evaluate, graph, layers, mcq, qa, resolve, segment, tasks
from lectern.sources import files
from lectern.streaming import evaluate as stream


def nodes(spark, rows):
    return spark.createDataFrame([(i, label, name, o) for o, (i, label, name) in enumerate(rows)], "id string, label string, name string, ord long")


def edges(spark, rows):
    return spark.createDataFrame([(*r, o) for o, r in enumerate(rows)], "source string, target string, type string, ord long")


def test_dedup_keeps_first_and_blank(spark):
    n = nodes(spark, [("a1", "Concept", "Force "), ("a2", "Concept", "force"), ("a3", "Skill", "force"), ("a4", "Concept", " "), ("a5", "Concept", ""), ("a6", "Book", "Force"), ("a7", "Book", "Force")])
    got = {r.id: r.canonical for r in resolve.canonical_ids(n).collect()}
    assert got == {"a1": "a1", "a2": "a1", "a3": "a3", "a4": "a4", "a5": "a5", "a6": "a6", "a7": "a7"}


def test_fold_properties(spark):
    rows = [("a", "Concept", "x", 0, None, ["p"], ""), ("b", "Concept", "x", 1, "short", ["q", "p"], "imp"), ("c", "Concept", "x", 2, "longer one", None, "later"), ("d", "Concept", "x", 3, "longer 1.", ["r"], None), ("e", "Concept", "x", 4, "longer two", None, None)]
    n = spark.createDataFrame(rows, "id string, label string, name string, ord long, definition string, examples array<string>, importance string")
    got, _ = resolve.dedup_nodes(n, properties=("definition", "examples", "importance"))
    assert [(r.id, r.definition, r.examples, r.importance) for r in got.collect()] == [("a", "longer one", ["p", "q", "r"], "imp")]


def test_fold_equals_sql_for_large_ids_and_empty_texts(spark, tmp_path):
    from lectern.plans import QUERIES, SQL

    rows = [(0, "a b c first"), (2, "a b c second"), (5_000_000_002, "a b c the longest one"), (3_000_000_000_004, "d e f one"), (9_000_000_000_006, "d e f much longer"), (8, ""), (10, "")]
    spark.createDataFrame([(i, t, "en", "s") for i, t in rows], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    expected = con.execute(f"SELECT id, label, name, ord, definition_md5, importance FROM ({SQL['property_fold_longest']})").fetchall()
    got = QUERIES["property_fold_longest"](spark, str(tmp_path)).select("id", "label", "name", "ord", "definition_md5", "importance")
    assert len(expected) == 4 and sorted(map(tuple, got.collect())) == sorted(expected)



def test_dedup_nodes_works_out_names_and_ids_once(spark):
    n = spark.createDataFrame([("a", "Concept", "Force", 1), ("b", "Concept", "force", 2), ("b", "Skill", "push", 3), (None, "Concept", "lost", 4)], "id string, label string, name string, ord int")
    got, mapping = resolve.dedup_nodes(n)
    assert sorted(map(tuple, got.select("id", "label", "name", "grouped").collect())) == [("a", "Concept", "Force", True), ("a", "Skill", "push", True)]
    assert {tuple(r) for r in mapping.collect()} == {("a", "a"), ("b", "a"), (None, None)}
    # the mapping reads what the nodes read: nothing is moved for it again
    assert "Exchange" not in mapping._jdf.queryExecution().executedPlan().toString()


def test_rebuild_edges(spark):
    n = nodes(spark, [("a", "Concept", "A"), ("b", "Concept", "B"), ("x", "Exercise", "X")])
    e = edges(spark, [("a", "b", "is_a"), ("a2", "b", "is_a"), ("a", "a2", "relates_to"), ("a", "gone", "is_a"), ("x", "a", "tests_concept"), ("x", "x", "tests_concept"), ("x", "a2", "tests_concept")])
    mapping = spark.createDataFrame([("a2", "a")], "id string, canonical string")
    got = resolve.rebuild_edges(e, mapping, n)
    assert sorted((r.source, r.target, r.type, r.ord, r.target_name) for r in got.collect()) == [("a", "b", "is_a", 0, "B"), ("x", "a", "tests_concept", 4, "A"), ("x", "x", "tests_concept", 5, "X")]
    packed = resolve.aggregated(got)
    assert [[t.target for t in r.target_name_to_ids] for r in packed.collect()] == [["a", "x"]]
    assert resolve.pairs(packed).count() == 2


def test_carried_edges(spark):
    n = nodes(spark, [("math_1", "Chapter", ""), ("math_2", "Chapter", ""), ("bio_1", "Chapter", "")])
    old = edges(spark, [("math_1", "math_2", "leads_to"), ("math_1", "bio_1", "leads_to"), ("math_1", "math_9", "leads_to"), ("math_1", "math_1", "leads_to")]).drop("ord")
    none = old.limit(0)
    assert [tuple(r) for r in resolve.carried_edges(none, old, n, False).collect()] == [("math_1", "math_2", "leads_to")]
    assert [tuple(r) for r in resolve.carried_edges(none, old, n, True).collect()] == [("math_1", "bio_1", "leads_to")]


def test_closure_and_cycles(spark):
    e = edges(spark, [("a", "b", ""), ("b", "c", ""), ("a", "d", ""), ("d", "c", ""), ("x", "y", ""), ("y", "z", ""), ("z", "x", ""), ("z", "z", "")])
    got = {tuple(r) for r in graph.closure(e).collect()}
    assert {("a", "c"), ("x", "x"), ("y", "x")} <= got and ("c", "a") not in got and ("a", "a") not in got
    assert [tuple(r) for r in graph.cycles(e).collect()] == [("x>y>z", 3)]
    assert {r.node for r in graph.on_cycle(e).collect()} == {"x", "y", "z"}


def test_cycles_of_any_length(spark):
    ring = [(f"r{i:02}", f"r{(i + 1) % 13:02}") for i in range(13)]
    rows = [*ring, ("r03", "r07"), ("r09", "r02"), ("tail", "r00"), ("r05", "leaf"), ("a", "b"), ("b", "a"), ("a", "a"), ("c", "d")]

    def plain():
        out = set()

        def walk(path):
            for x, y in rows:
                if x == path[-1] and y == path[0] and len(path) > 1:
                    out.add((">".join(path), len(path)))
                elif x == path[-1] and y > path[0] and y not in path:
                    walk([*path, y])

        for node in {x for x, _ in rows}:
            walk([node])
        return sorted(out)

    e = spark.createDataFrame(rows, "source string, target string")
    assert max(n for _, n in plain()) == 13
    assert [tuple(r) for r in graph.cycles(e).collect()] == plain()
    assert [tuple(r) for r in graph.cycles(e, most=2).collect()] == plain()[:2]


def test_exact_hops_from_a_set(spark):
    pairs = graph.neighbours(edges(spark, [("a", "b", "is_a"), ("b", "c", "is_a"), ("c", "d", "is_a"), ("d", "e", "is_a")]))
    starts = spark.createDataFrame([("q", "a"), ("q", "d")], "query string, node string")
    assert graph.exact_hops(pairs, starts).count() == 0
    assert [r.node for r in graph.exact_hops(pairs, starts.where("node = 'a'")).collect()] == ["c"]


def test_layers_equal_the_sequential_rule(spark):
    import random

    rng = random.Random(4)
    rows = [(q, rng.randint(1, 5), f"n{i}", f"name{rng.randint(0, 25)}", rng.choice(["Concept", "Skill"]), round(rng.random(), 2), 0.0, 0.0) for q in range(30) for i in range(30)]
    answers = [(q, "n0", next(r[3] for r in rows if r[0] == q and r[2] == "n0")) for q in range(30)]
    blocked = [(q, f"n{rng.randint(1, 5)}") for q in range(30)]
    c = spark.createDataFrame(rows, "query int, layer int, node string, name string, label string, sim_score double, sim_question double, sim_answer double")
    got = layers.layered(c, spark.createDataFrame(answers, "query int, node string, name string"), spark.createDataFrame(blocked, "query int, node string"), ("Concept",), stop_at=4)
    expected = set()
    for q in range(30):
        seen, kept = {answers[q][2]}, 0
        for layer in range(1, 6):
            if kept >= 4:
                break
            for r in sorted((r for r in rows if r[0] == q and r[1] == layer), key=lambda r: (-r[5], r[3], r[2])):
                if r[4] == "Concept" and r[2] not in ("n0", blocked[q][1]) and r[3] not in seen:
                    seen.add(r[3])
                    kept += 1
                    expected.add((q, layer, r[2]))
    assert {(r.query, r.layer, r.node) for r in got.collect()} == expected
    assert layers.nested(got).count() == len({e[0] for e in expected})


def school(spark):
    """Two mathematics books of two chapters with two sections each, concepts in all sections."""
    sections = [(f"math_{b}_rjb", f"Book {b}", f"math_{b}_rjb_ch{c}", f"Chapter {b}{c}", f"math_{b}_rjb_ch{c}_s{s}", f"Section {s}", o) for o, (b, c, s) in enumerate((b, c, s) for b in ("7a", "bx1") for c in (1, 2) for s in (1, 2))]
    n, part_of = graph.structure(spark.createDataFrame(sections, "book string, book_name string, chapter string, chapter_title string, section string, section_title string, ord long"))
    content = [(f"math_7a_rjb_cpt{i}", "Concept", f"concept {i}", i) for i in range(8)] + [("math_7a_rjb_exe1", "Exercise", "ex 1", 9), ("math_7a_rjb_exe2", "Exercise", "ex 2", 10), ("math_7a_rjb_exp1", "Experiment", "lab", 11)]
    n = n.unionByName(spark.createDataFrame(content, "id string, label string, name string, ord long"))
    c = lambda i: f"math_7a_rjb_cpt{i}"
    e = [(c(0), c(1), "prerequisites_for"), (c(1), c(2), "prerequisites_for"), (c(2), c(3), "relates_to"), (c(4), c(5), "is_a"), ("math_7a_rjb_exe1", c(1), "tests_concept"), ("math_7a_rjb_exe2", c(4), "tests_concept"), ("math_7a_rjb_exp1", c(2), "verifies"), ("math_7a_rjb_ch1", "math_7a_rjb_ch2", "leads_to")]
    at = [(c(i), sections[i][4]) for i in range(8)] + [(c(0), sections[5][4]), ("math_7a_rjb_exe1", sections[0][4]), ("math_7a_rjb_exe2", sections[1][4]), ("math_7a_rjb_exp1", sections[2][4])]
    appears = spark.createDataFrame(at, "source string, target string")
    return tasks.Graph(n.select("id", "label", "name"), spark.createDataFrame(e, "source string, target string, type string"), graph.locations(n, appears, part_of).cache())


def test_nine_tasks(spark):
    g = school(spark)
    c = lambda i: f"math_7a_rjb_cpt{i}"
    pairs = lambda df: {(r["query"], r["node"]) for r in df.collect()}
    t11 = tasks.tested_by_exercise(g, "Concept")
    assert pairs(t11.answers) == {("math_7a_rjb_exe1", c(1)), ("math_7a_rjb_exe2", c(4))}
    assert pairs(t11.blocked) == {("math_7a_rjb_exe1", c(0)), ("math_7a_rjb_exe1", c(2)), ("math_7a_rjb_exe2", c(5))}
    assert pairs(t11.candidates.where("layer = 1")) == {("math_7a_rjb_exe1", c(3))}
    t21 = tasks.predecessors(g)
    assert pairs(t21.answers) == {(c(1), c(0)), (c(2), c(0)), (c(2), c(1))}
    assert pairs(tasks.successors(g).answers) == {(c(0), c(1)), (c(1), c(2))}
    assert pairs(tasks.related(g).answers) == {(c(2), c(3)), (c(3), c(2)), (c(4), c(5)), (c(5), c(4))}
    assert pairs(tasks.verifying(g).answers) == {(c(2), "math_7a_rjb_exp1")} and pairs(tasks.verified(g).answers) == {("math_7a_rjb_exp1", c(2))}
    first = tasks.first_place(g)
    assert (c(0), "math_7a_rjb_ch1_s1") in pairs(first.answers) and (c(0), "math_bx1_rjb_ch1_s2") in pairs(first.candidates.where("layer = 1"))
    assert pairs(tasks.leading_chapters(g).answers) == {("math_7a_rjb_ch2", "math_7a_rjb_ch1")}
    assert tasks.exercises_of(g, "Concept").answers.count() == 2
    assert tasks.first_place(g, "Chapter").answers.count() == 0


def test_mcq(spark):
    rows = [(f"q{i}", "Q", [f"a{j}" for j in range(i % 4)], ["a0", "w1", "w2", " w1 ", "w3", "w4"], i, "f") for i in range(40)]
    got = mcq.build(spark.createDataFrame(rows, "id string, question string, answer_names array<string>, candidate_names array<string>, ord long, file string")).collect()
    assert len(got) == 30
    for r in got:
        n = int(r.id[1:]) % 4
        right = {r.options[x] for x in r.answer}
        assert sorted(r.options) == list("ABCD") and len(set(r.options.values())) == 4
        assert 1 <= len(r.answer) <= n and right == {v for v in r.options.values() if v[0] == "a"} and r.answer == sorted(r.answer)
    assert sum(len(r.answer) == 1 for r in got) >= 10


def test_questions_rendered(spark):
    row = spark.createDataFrame([("i", "math_7a_rjb_cpt1", "力")], "id string, query_id string, query_text string")
    for task in mcq.QUESTIONS:
        got = row.select(mcq.question(task)).first()[0]
        assert "【力】" in got and "{" not in got


def test_mix(spark):
    t = spark.createDataFrame([(k, n) for k in ("is_a", "relates_to", "other") for n in (0, 1, 10, 50)], "task string, n long")
    got = {(r.task, r.n): r.w for r in t.select("task", "n", qa.wanted(F.col("task"), F.col("n")).alias("w")).collect()}
    assert got[("relates_to", 50)] == 18 and got[("relates_to", 1)] == 1 and got[("is_a", 10)] == 6 and got[("other", 50)] == 50 and got[("is_a", 0)] == 0
    rows = spark.createDataFrame([(" a ", "b", 1), ("a", "b", 2), ("", "b", 3), ("a", None, 4)], "question string, answer string, ord long")
    assert [r.ord for r in qa.deduped(qa.records(rows)).collect()] == [1]


def test_exercise_modes(spark):
    long = "首先设未知数然后代入方程解得结果因此可以得到最后的答案是四十二这个数目前后一致没有矛盾。" * 2
    items = [("1", "math", "题", "一个足够长的答案，可以使用。", long, "计算题"), ("2", "math", "题", "对", "", "选择题"), ("3", "math", " ", "x", long, "选择题"), ("4", "math", "题", "证毕", long, "证明题")]
    df = spark.createDataFrame(items, "id string, subject string, stem string, answer string, analysis string, type string")
    got = lambda mode: sorted((r.source_id, r.source_mode) for r in qa.exercise_records(df, mode).collect())
    assert got("answer") == [("1", "answer"), ("2", "answer")]
    assert got("analysis") == [("1", "analysis"), ("4", "analysis")]
    assert got("hybrid") == [("1", "analysis"), ("2", "answer"), ("4", "analysis")]
    assert got("dual") == [("1", "analysis"), ("1", "answer"), ("2", "answer"), ("4", "analysis")]
    assert got("reasoning") == [("1", "reasoning"), ("4", "reasoning")]


def test_segments_and_questions(spark):
    docs = spark.createDataFrame([("d", "intro\n# One\na\n## Two\nb\n\n# Three")], "id string, text string")
    got = [(r.title, r.level, r.start, r.stop) for r in segment.heading_segments(docs, "id", "text").orderBy("start").collect()]
    assert got == [("One", 1, 1, 3), ("Two", 2, 3, 6), ("Three", 1, 6, 7)]
    s = spark.createDataFrame([("x/a.md", "bk", 1, "head\n1. first\nmore\n2、\n3. 见下图"), ("x/b.md", "bk", 2, "1. last")], "source_md string, book_prefix string, ord int, body string")
    q = segment.questions(s)
    assert [(r.question_id, r.global_no, r.stem) for r in q.orderBy("global_no").collect()] == [("a_t1", 1, "first\nmore"), ("a_t3", 3, "见下图"), ("b_t4", 4, "last")]
    assert segment.kept_questions(q).count() == 2


def test_matched_choices(spark):
    picks = spark.createDataFrame([("e", ["ＦＯＲＣＥ", "mass", "force "])], "id string, picks array<string>")
    known = spark.createDataFrame([("e", "force", 0), ("e", "Force", 1), ("e", "Work", 2)], "id string, name string, ord long")
    assert [r.names for r in segment.matched_choices(picks, known).collect()] == [["Force"]]


def test_evaluation_goes_on(spark, tmp_path):
    rows = spark.createDataFrame([("1", "A?", ["A"]), ("2", "fail", ["B"])], "id string, prompt string, gold array<string>")

    def model(prompt):
        if prompt == "fail":
            raise ValueError("no")
        return prompt

    got = {r.id: (r.pred, r.exact_match) for r in evaluate.scored(evaluate.answered(rows, model)).collect()}
    assert got == {"1": (["A"], 1.0), "2": ([], 0.0)}
    assert evaluate.summary(evaluate.scored(evaluate.answered(rows.limit(0), model)).withColumn("file", F.lit("f"))).where("file IS NULL").first()["count"] == 0
    into, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    for part in (rows.where("id = '1'"), rows.where("id = '2'")):
        part.write.mode("append").json(into)
        stream.run(stream.questions(spark, into), model, out, mark).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["1", "2"]


def test_sources(spark, tmp_path):
    import json

    path = tmp_path / "g"
    path.mkdir()
    (path / "a.json").write_text(json.dumps({"nodes": [{"id": "1", "label": "Concept", "name": " A  b ", "properties": {"examples": ["x"]}}], "edges": [{"source": "1", "target": "2", "type": "is_a"}]}))
    n, e = files.graphs(spark, str(path))
    assert n.select("id", "properties.examples").count() == 1 and e.count() == 1
    assert [tuple(r) for r in files.names_by_id(n).collect()] == [("1", "A b")]
    lines = tmp_path / "l.jsonl"
    lines.write_text('{"id": "1"}\n\nnot json\n')
    assert files.json_lines(spark, str(lines), "id string", lenient=True).count() == 1
    assert files.optional(spark, str(tmp_path / "none"), "id string").count() == 0
    assert files.books(spark, [{"book_prefix": "b ", "subject": "s", "stage": "m", "grade": "7", "publisher": "p"}]).first().book_prefix == "b"


def test_settings(monkeypatch):
    monkeypatch.setenv("ROOT_", "/r")
    s = Settings.of({"root": "${ROOT_}/x", "books": [{"book_prefix": "a"}, {"book_prefix": "b"}]})
    assert s.book("book_kg", "a") == "/r/x/book_kg/book_prefix=a" and s.selected(["b"]) == [{"book_prefix": "b"}]
    assert expanded(["${NONE_}"]) == [""] and load_env("# c\nROOT_=no\n") == {}


def test_locations(spark):
    g = school(spark)
    got = {(r.level, r.value) for r in g.locations.where("node_id = 'math_7a_rjb_cpt0'").collect()}
    assert {("section", "math_7a_rjb_ch1_s1"), ("section", "math_bx1_rjb_ch1_s2"), ("book", "math_bx1_rjb"), ("subject_stage", "math:highschool"), ("subject", "math")} <= got
    assert ids.ORDER[0] == "1a"
