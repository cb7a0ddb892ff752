"""Vector similarity, answer parsing, set metrics and rules on exercise answers, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions.text import without_space

# Fixed values of the data format.
SHORT_ANSWER = ("计算题", "应用题")
REASONING = ("证明题", "综合题", "解答题")
PROOF = "证明题"
TRIVIAL = ("对", "错", "正确", "错误", "是", "否")
STOP_TOKENS = ("答案", "分析", "所以", "因此", "则", "得", "可得", "说明", "因为", "最后", "其中", "分别")
TOKEN = r"[A-Za-z]+(?:[0-9]+)?|[0-9]+(?:\.[0-9]+)?[%％]?|[一-鿿]{2,}"
NUMBER = r"^[0-9]+(?:\.[0-9]+)?[%％]?$"
CONNECTIVES = "首先|先|再|然后|最后|因此|所以|据此|由此|设|代入|解得|可得|分两种|分情况|步骤|思路|分别"
STRUCTURE = r"[（(]1[)）]|①|1\.|2\.|3\.|×|÷|=|→|⇒"


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def similarity(a: Column, b: Column) -> Column:
    """(cosine, held to -1 to 1, + 1) / 2; 0 where a norm is 0 or a vector is null."""
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    cosine = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot(a, b) / norm))
    return F.when(norm > 0, (cosine + 1) / 2).otherwise(0.0)


def unit(v: Column) -> Column:
    """A vector over its norm, in double; null where that is 0."""
    norm = F.sqrt(dot(v, v))
    return F.when(norm > 0, F.transform(v, lambda x: x.cast("double") / norm))


def unit_similarity(a: Column, b: Column) -> Column:
    """similarity() of vectors that unit() made."""
    cosine = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot(a, b)))
    return F.when(a.isNotNull() & b.isNotNull(), (cosine + 1) / 2).otherwise(0.0)


def letters(x: Column) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(x, F.lit("([ABCD])"), 1)))


def parsed_answer(raw: Column) -> Column:
    """Letters A to D of a model's reply: of its first line that is not blank, else of all; none for marked failures.

    What precedes the last closing think tag is left out.
    """
    text = F.btrim(F.coalesce(raw, F.lit("")), F.lit(" \n\r\t"))
    upper = F.element_at(F.split(F.upper(text), "</THINK>"), -1)
    first = F.coalesce(F.try_element_at(F.filter(F.split(upper, r"\r\n|\n|\r"), lambda line: F.btrim(line, F.lit(" \t")) != ""), F.lit(1)), F.lit(""))
    found = F.when(F.size(letters(first)) > 0, letters(first)).otherwise(letters(upper))
    return F.when(F.startswith(text, F.lit("__ERROR__")) | (text == "__EMPTY_RESPONSE__"), F.array().cast("array<string>")).otherwise(found)


def clean_labels(xs: Column) -> Column:
    """Option labels A to D in upper case, each once, sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(xs, lambda x: F.upper(F.btrim(x))), lambda x: x.isin("A", "B", "C", "D"))))


def set_metrics(gold: Column, pred: Column) -> dict[str, Column]:
    """exact_match, precision, recall and f1 of two sets; 0 where a denominator is 0."""
    g, p = F.array_distinct(gold), F.array_distinct(pred)
    hit = F.size(F.array_intersect(g, p)).cast("double")
    precision = F.when(F.size(p) > 0, hit / F.size(p)).otherwise(0.0)
    recall = F.when(F.size(g) > 0, hit / F.size(g)).otherwise(0.0)
    f1 = F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)
    exact = F.when((hit == F.size(g)) & (hit == F.size(p)), 1.0).otherwise(0.0)
    return {"exact_match": exact, "precision": precision, "recall": recall, "f1": f1}


def too_short(answer: Column) -> Column:
    """Whether an answer is blank, trivial, a few characters without punctuation, or a bare number."""
    t = without_space(answer)
    return (t == "") | t.isin(*TRIVIAL) | ((F.length(t) < 8) & ~answer.rlike("[，。；：,.!?！？]")) | t.rlike(r"^[-+−]?\d+(?:\.\d+)?(?:[%％a-zA-Z℃°/]+)?$")


def emits_answer(kind: Column, answer: Column) -> Column:
    short = kind.isin(*SHORT_ANSWER) & too_short(answer)
    brief = kind.isin(*REASONING) & (F.length(without_space(answer)) < 16)
    return (answer != "") & (kind != PROOF) & ~short & ~brief


def emits_analysis(analysis: Column) -> Column:
    return F.length(without_space(analysis)) >= 20


def compare_tokens(x: Column) -> Column:
    """Distinct latin, number and CJK tokens without stop tokens."""
    return F.array_except(F.array_distinct(F.regexp_extract_all(x, F.lit(TOKEN), 0)), F.array(*[F.lit(t) for t in STOP_TOKENS]))


def aligned(answer: Column, analysis: Column) -> Column:
    """Whether an analysis leads to its answer: holds it, or all its numbers, or enough of its tokens."""
    a, b = without_space(answer), without_space(analysis)
    x, y = compare_tokens(answer), compare_tokens(analysis)
    numbers = F.filter(x, lambda t: t.rlike(NUMBER))
    all_numbers = (F.size(numbers) > 0) & (F.size(F.array_except(numbers, y)) == 0)
    enough = F.size(F.array_intersect(x, y)) >= F.greatest(F.lit(1), F.least(F.lit(3), F.floor(F.size(x) / 2)))
    return (a != "") & (b != "") & (F.contains(b, a) | ((F.size(x) > 0) & (F.size(y) > 0) & (all_numbers | enough)))


def analysis_score(answer: Column, analysis: Column) -> Column:
    """0 to 6: three steps of length, connectives, structure, alignment."""
    n = F.length(without_space(analysis))
    points = [n >= 40, n >= 80, n >= 140, analysis.rlike(CONNECTIVES), analysis.rlike(STRUCTURE), aligned(answer, analysis)]
    total = points[0].cast("int")
    for p in points[1:]:
        total = total + p.cast("int")
    return total


def hybrid_mode(kind: Column, answer_ok: Column, analysis_ok: Column) -> Column:
    """answer or analysis, whichever a question type prefers and the row can give; null if neither."""
    long = kind.isin(*SHORT_ANSWER, *REASONING)
    return F.when(long & analysis_ok, "analysis").when(answer_ok, "answer").when(analysis_ok, "analysis")
