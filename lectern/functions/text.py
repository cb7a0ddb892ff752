"""Text functions as Spark columns. Only Unicode NFKC needs Python, as an Arrow function."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the data format.
PUNCTUATION_OF_TITLES = r"[\\\s\-—_·•\.。,:：;；，、'\"`~!@#$%^&*+=|<>?\[\]{}()]+"
MULTIMODAL_WORDS = ("<table", "</table>", "下图", "图示", "图中", "画图", "下表", "填表")
EXERCISE_WORDS = ("课后练习", "练习", "习题", "复习题", "复习参考题", "整理和复习", "总复习", "做一做")
ANALYSIS_LABELS = "分析|思路|解题思路|解析|说明|判断依据"
HIGH_SCHOOL = r"(选择性必修|必修)\s*第?([一二三四五六七八九十\d]+)\s*册?"
GRADES = ("([一二三四五六七八九]|[1-9])年级[上下]册", "([一二三四五六七八九]|[1-9])年级", r"(必修|选择性必修|选修)\s*[第一二三四五六七八九十\d]+册")
DIGITS = {"零": 0, "〇": 0, "一": 1, "二": 2, "两": 2, "三": 3, "四": 4, "五": 5, "六": 6, "七": 7, "八": 8, "九": 9}


@F.pandas_udf(T.StringType())
def _nfkc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def own_form(x: Column) -> Column:
    """Whether a text has only characters of blocks that are their own NFKC form."""
    return x.rlike(r"^[\x00-\x7F\u00C0-\u0131\u4E00-\u9FFF]*\z")


def nfkc(x: Column) -> Column:
    """Unicode NFKC of a text; null stays null. Texts of characters that are their own form do not leave the JVM."""
    same = own_form(x)
    return F.when(same, x).otherwise(_nfkc(F.when(~same, x)))


def squeezed(x: Column) -> Column:
    """Trimmed, each run of white space as one space."""
    return F.btrim(F.regexp_replace(x, r"(?U)\s+", " "))


def normal_name(x: Column) -> Column:
    """Key by which names are equal: lower case, squeezed."""
    return F.lower(squeezed(x))


def stripped(x: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def clean(x: Column) -> Column:
    """Stripped text; null is empty."""
    return stripped(F.coalesce(x.cast("string"), F.lit("")))


def clean_list(xs: Column) -> Column:
    """Squeezed entries without blanks, each once, in first-seen order."""
    return F.array_distinct(F.filter(F.transform(xs, squeezed), lambda x: x != ""))


def distinct_names(xs: Column) -> Column:
    """Entries trimmed, without blanks, the first of each compact text, in order; lists are short."""
    rows = F.filter(F.transform(xs, lambda x: F.btrim(F.coalesce(x, F.lit("")))), lambda x: x != "")
    return F.aggregate(
        F.zip_with(rows, F.split(compact(F.array_join(rows, "\u0001")), "\u0001"), lambda n, k: F.struct(n.alias("n"), k.alias("k"))),
        F.array().cast("array<struct<n:string,k:string>>"),
        lambda out, r: F.when(F.exists(out, lambda o: o.k == r.k), out).otherwise(F.array_append(out, r)),
        lambda out: F.transform(out, lambda o: o.n),
    )


def without_space(x: Column) -> Column:
    return F.regexp_replace(x, r"(?U)\s+", "")


def compact(x: Column) -> Column:
    """NFKC, no white space, lower case."""
    return F.lower(without_space(nfkc(x)))


def unix_lines(x: Column) -> Column:
    return F.regexp_replace(x, "\r\n?", "\n")


def markdown_body(x: Column) -> Column:
    """Unix lines, plain and single blanks, at most one empty line in a row, stripped."""
    plain = F.regexp_replace(F.replace(unix_lines(x), F.lit(" "), F.lit(" ")), r"[ \t]+", " ")
    return stripped(F.regexp_replace(plain, r"\n{3,}", "\n\n"))


def exercise_text(x: Column) -> Column:
    """Unix lines without blanks at their ends, at most one empty line in a row, stripped."""
    return stripped(F.regexp_replace(F.regexp_replace(unix_lines(F.coalesce(x, F.lit(""))), r"[ \t]+\n", "\n"), r"\n{3,}", "\n\n"))


def analysis_text(x: Column) -> Column:
    """exercise_text without one leading label."""
    return stripped(F.regexp_replace(exercise_text(x), rf"^({ANALYSIS_LABELS})\s*[：:]\s*", ""))


def title_key(x: Column) -> Column:
    """Key by which titles match: no heading marks, formulas, bracketed parts or punctuation."""
    t = F.regexp_replace(F.regexp_replace(F.regexp_replace(nfkc(x), r"^#+\s*", ""), r"\$[^$]*\$", ""), r"\([^)]*\)", "")
    return F.lower(F.regexp_replace(t, r"(?U)" + PUNCTUATION_OF_TITLES, ""))


def titles_match(a: Column, b: Column) -> Column:
    """Whether one key holds the other; false if either is empty."""
    return (a != "") & (b != "") & (F.contains(a, b) | F.contains(b, a))


def file_token(x: Column) -> Column:
    """A text fit for a file name."""
    return F.regexp_replace(F.regexp_replace(without_space(nfkc(x)), r'[\\/:*?"<>|]+', "_"), r"^[._]+|[._]+$", "")


def without_images(x: Column) -> Column:
    """Markdown without image links and tags, ending with one newline."""
    t = F.regexp_replace(F.regexp_replace(x, r"!\[[^\]]*\]\([^)]*\)", ""), r"(?i)<img\b[^>]*>", "")
    return F.concat(stripped(F.regexp_replace(t, r"\n{3,}", "\n\n")), F.lit("\n"))


def contents_line(x: Column) -> Column:
    """A line of a table of contents without marks, dot leaders and page number."""
    t = F.regexp_replace(F.regexp_replace(stripped(nfkc(x)), r"^#+\s*", ""), r"[${}^*]", "")
    t = F.regexp_replace(F.regexp_replace(t, r"\s*[…\.。·•]+\s*\d+\s*$", ""), r"\s+\d+\s*$", "")
    return squeezed(t)


def _numerals() -> dict[str, int]:
    """Chinese digits, and those around a ten."""
    out = dict(DIGITS)
    for left, tens in ({"": 1} | DIGITS).items():
        for right, ones in ({"": 0} | DIGITS).items():
            out[f"{left}十{right}"] = tens * 10 + ones
    return out


def numeral(x: Column) -> Column:
    """Integer of digits or of a Chinese numeral up to 99; null for anything else."""
    t = stripped(x)
    # a map of literals is one constant of the plan
    known = F.create_map(*[F.lit(v) for kv in _numerals().items() for v in kv])
    return F.coalesce(F.when(t.rlike(r"^\d+$"), t.try_cast("int")), F.try_element_at(known, t))


def _ordinals() -> list[str]:
    """1 to 99 in Chinese."""
    digits = "一二三四五六七八九"
    tens = ["", "十", *[f"{d}十" for d in digits[1:]]]
    return [tens[n // 10] + (digits[n % 10 - 1] if n % 10 else "") for n in range(1, 100)]


def ordinal(n: Column) -> Column:
    """Chinese numeral of 1 to 99; the digits from 100 on; null below 1."""
    names = F.array(*[F.lit(x) for x in _ordinals()])
    return F.when(n >= 100, n.cast("string")).when(n >= 1, F.try_element_at(names, n.cast("int")))


def high_school_grade(book: Column) -> Column:
    """必修 or 选择性必修 with the Chinese numeral, 1 to 10, of a book's name; null for other books."""
    t = nfkc(book)
    number = F.regexp_extract(t, HIGH_SCHOOL, 2)
    n = numeral(number)
    return F.when(t.rlike(HIGH_SCHOOL) & n.between(1, 10), F.concat(F.regexp_extract(t, HIGH_SCHOOL, 1), ordinal(n)))


def grade(book: Column) -> Column:
    """Grade that a book's name gives: a high-school course, or a year with its half where it has one; null if none."""
    t = nfkc(book)
    found = [F.nullif(F.regexp_extract(t, p, 0), F.lit("")) for p in GRADES]
    return F.coalesce(high_school_grade(book), *found[:-1], F.replace(found[-1], F.lit(" "), F.lit("")))


def output_grade(stage: Column, given: Column, book: Column) -> Column:
    """Grade under which a book is filed: in middle school the given one if it names a half, else the name's; in high school the course."""
    raw, own = nfkc(given), grade(book)
    half = "年级[上下]册"
    middle = F.when(raw.rlike(half), given).when(own.rlike(half), own)
    high = F.coalesce(high_school_grade(book), high_school_grade(given))
    by_stage = F.when(stage == "初中", middle).when(stage == "高中", high)
    return F.coalesce(by_stage, own, given)


def prefixed(number: Column, title: Column, unit: str) -> Column:
    """Title with its ordinal, such as 第一章, unless it has one."""
    name = F.concat(F.lit("第"), F.coalesce(ordinal(numeral(number)), number), F.lit(unit))
    return F.when(title.rlike(rf"^第\s*\S+\s*{unit}"), title).otherwise(squeezed(F.concat_ws(" ", name, title)))


def multimodal_words(x: Column) -> Column:
    """Words in the text that point to a table or figure."""
    t = F.lower(nfkc(x))
    return F.array_compact(F.array(*[F.when(F.contains(t, F.lit(w)), F.lit(w)) for w in MULTIMODAL_WORDS]))


def is_exercise_section(*titles: Column) -> Column:
    """Whether any title names exercises."""
    whole = compact(F.concat_ws("\u0001", *titles))
    return whole.rlike("|".join(EXERCISE_WORDS))


def difficulty(x: Column) -> Column:
    """1 to 5 from a JSON value's text (integer, integral number or digits in quotes); null else, for true and false too."""
    n = F.regexp_extract(x, r'^\s*"?\s*([1-5])(\.0+)?\s*"?\s*$', 1)
    return F.nullif(n, F.lit("")).cast("int")
