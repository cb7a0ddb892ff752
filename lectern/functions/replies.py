"""JSON in model replies: fenced or bare, with prose around it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_text(reply: Column) -> Column:
    """The JSON part of a reply: a fenced object or array, else from the first to the last brace, else bracket; null if none parses."""
    fenced = F.regexp_extract(reply, r"(?s)```(?:json)?\s*([\[{].*?[\]}])\s*```", 1)
    braces = F.regexp_extract(reply, r"(?s)(\{.*\})", 1)
    brackets = F.regexp_extract(reply, r"(?s)(\[.*\])", 1)
    parts = F.filter(F.array(F.btrim(reply, F.lit(" \n\r\t")), fenced, braces, brackets), lambda t: t.rlike(r"^[\[{]") & F.try_parse_json(t).isNotNull())
    return F.try_element_at(parts, F.lit(1))


def pairs(reply: Column) -> Column:
    """Question-answer pairs of a reply: one object, a list, or a list under items, qas or qa_items; blank ones left out."""
    text = json_text(reply)
    kind = "array<struct<question:string,answer:string>>"
    under = F.coalesce(*[F.from_json(F.get_json_object(text, f"$.{k}"), kind) for k in ("items", "qas", "qa_items")])
    one = F.from_json(text, "struct<question:string,answer:string>")
    rows = F.when(F.startswith(text, F.lit("[")), F.from_json(text, kind)).otherwise(F.coalesce(under, F.array(one)))
    return F.filter(rows, lambda r: (F.btrim(F.coalesce(r.question, F.lit(""))) != "") & (F.btrim(F.coalesce(r.answer, F.lit(""))) != ""))


def rendered(template: str | Column, fields: dict[str, Column]) -> Column:
    """A template with each {{name}} replaced by its field; null fields are empty."""
    out = F.lit(template) if isinstance(template, str) else template
    for name, value in fields.items():
        out = F.replace(out, F.lit("{{" + name + "}}"), F.coalesce(value.cast("string"), F.lit("")))
    return out
