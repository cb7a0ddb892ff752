from pyspark.sql import functions as F

from lectern.functions import ids, measures, replies, text


def values(spark, rows, column):
    """column over rows of texts, in order."""
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t string")
    return [r[1] for r in df.select("i", column.alias("v")).orderBy("i").collect()]


def test_normal_forms(spark):
    t = F.col("t")
    assert values(spark, ["  A　B \n c ", "", None], text.normal_name(t)) == ["a b c", "", None]
    assert values(spark, ["Ａ １　b"], text.compact(t)) == ["a1b"]
    assert values(spark, ["# 第一章 (x) $y$ 力，与 运动"], text.title_key(t)) == ["第一章力与运动"]
    assert values(spark, ["a\r\n\r\n\r\n\r\nb \t c d"], text.markdown_body(t)) == ["a\n\nb c d"]
    assert values(spark, ["解析： 因为", "因为"], text.analysis_text(t)) == ["因为", "因为"]
    assert values(spark, ["第一章 力 …… 12"], text.contents_line(t)) == ["第一章 力"]
    assert values(spark, ["._a/b c?_"], text.file_token(t)) == ["a_bc"]


def test_numerals(spark):
    t = F.col("t")
    words = ["7", "十", "十二", "二十", "九十九", "五", "百", "", "x"]
    assert values(spark, words, text.numeral(t)) == [7, 10, 12, 20, 99, 5, None, None, None]
    assert values(spark, ["0", "1", "10", "11", "20", "99", "100"], text.ordinal(t.cast("int"))) == [None, "一", "十", "十一", "二十", "九十九", "100"]


def test_words_and_difficulty(spark):
    t = F.col("t")
    assert values(spark, ["如下图所示", "见<TABLE>", "无"], text.multimodal_words(t)) == [["下图"], ["<table"], []]
    assert values(spark, ["课后 练习", "正文"], text.is_exercise_section(t)) == [True, False]
    assert values(spark, ["3", '"4"', "5.0", "6", "true", None], text.difficulty(t)) == [3, 4, 5, None, None, None]


def test_ids(spark):
    t = F.col("t")
    assert values(spark, ["math_7a_rjb_ch1_s2", "physics_xzxbx1_rjb", "x"], ids.book_code(t)) == ["7a", "xzxbx1", ""]
    assert values(spark, ["f::math_7a_rjb_cpt3", "abc"], ids.prefix(t)) == ["math_7a_rjb", "abc"]
    keys = values(spark, ["math_7a_rjb_ch10_s1", "math_7a_rjb_ch2_s3", "math_bx1_rjb_ch1_s1", "math_7a_rjb_ch1_s课题1"], ids.location_key(t, "Section"))
    assert sorted(range(4), key=lambda i: tuple(keys[i])) == [1, 0, 2, 3]
    order = values(spark, ["2", "10", "", "a3", "a12", "zz"], ids.natural_key(t))
    assert sorted(range(6), key=lambda i: tuple(order[i])) == [0, 1, 2, 3, 4, 5]


def test_parsed_answers(spark):
    cases = {"A,C": ["A", "C"], "ANSWER: B": ["A", "B"], "<think>D</think>\n b": ["B"], "": [], "__ERROR__ A": [], "\n\nxyz\nC": ["C"], "__EMPTY_RESPONSE__": []}
    assert values(spark, list(cases), measures.parsed_answer(F.col("t"))) == list(cases.values())


def test_set_metrics_of_nothing(spark):
    row = spark.range(1).select(F.array().cast("array<string>").alias("g")).withColumns(measures.set_metrics(F.col("g"), F.col("g"))).first()
    assert (row.exact_match, row.precision, row.recall, row.f1) == (1.0, 0.0, 0.0, 0.0)


def test_answer_rules(spark):
    t = F.col("t")
    assert values(spark, ["对", "12.5%", "短", "短，但有标点", "这是一个足够长的答案"], measures.too_short(t)) == [True, True, True, False, False]
    got = values(spark, ["x" * 15, "x" * 16], measures.emits_answer(F.lit("解答题"), t))
    assert got == [False, True]
    assert values(spark, ["x" * n for n in (39, 40, 79, 80, 139, 140)], measures.analysis_score(F.lit("zz"), t)) == [0, 1, 1, 2, 2, 3]
    assert values(spark, ["结果是 42 米", "结果是 43 米"], measures.aligned(F.lit("得 42"), t)) == [True, False]


def test_similarity(spark):
    rows = spark.createDataFrame([([1.0, 0.0], [0.0, 1.0]), ([1.0, 0.0], [2.0, 0.0]), ([0.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [-1.0, 0.0])], "a array<float>, b array<float>")
    assert [r[0] for r in rows.select(measures.similarity(F.col("a"), F.col("b"))).collect()] == [0.5, 1.0, 0.0, 0.0]


def test_replies(spark):
    t = F.col("t")
    one = '{"question": "q", "answer": "a"}'
    texts = [one, f"text\n```json\n[{one}]\n```", f'so {{"items": [{one}, {{"question": "", "answer": "x"}}]}} end', "no json", None]
    assert [[tuple(p) for p in ps or []] for ps in values(spark, texts, replies.pairs(t))] == [[("q", "a")]] * 3 + [[], []]
    assert values(spark, ["x"], replies.rendered("{{a}}-{{b}}", {"a": t, "b": F.lit(None)})) == ["x-"]
