"""Curriculum graphs over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.functions import ids
from lectern.operators import graph, tasks
from lectern.operators.fixpoint import stored, union


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def part_chain(part: DataFrame, *by: str) -> DataFrame:
    """(source, target): each part and the next one, by key, within a group."""
    nxt = F.lead("p_partkey").over(Window.partitionBy(*by).orderBy("p_partkey"))
    return part.select(F.col("p_partkey").alias("source"), nxt.alias("target")).where("target IS NOT NULL")


#: SQL of part_chain by brand and type.
CHAIN = "SELECT * FROM (SELECT p_partkey AS source, lead(p_partkey) OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) AS target FROM part) WHERE target IS NOT NULL"

#: SQL of the edges of the stand-in graph, as edges() makes them.
EDGES = f"""
SELECT source, target, 'prerequisites_for' AS type FROM ({CHAIN})
UNION ALL SELECT * FROM (SELECT p_partkey, lead(p_partkey) OVER (PARTITION BY p_name, p_brand ORDER BY p_partkey) AS t, 'relates_to' FROM part) WHERE t IS NOT NULL
UNION ALL SELECT * FROM (SELECT p_partkey, min(p_partkey) OVER (PARTITION BY p_name, p_size) AS t, 'is_a' FROM part) WHERE t <> p_partkey
"""


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prerequisites, relations and is_a edges between parts."""
    part = table(spark, sf_dir, "part")
    star = part.select(F.col("p_partkey").alias("source"), F.min("p_partkey").over(Window.partitionBy("p_name", "p_size")).alias("target")).where("source <> target")
    out = part_chain(part, "p_brand", "p_type").withColumn("type", F.lit("prerequisites_for"))
    return out.unionByName(part_chain(part, "p_name", "p_brand").withColumn("type", F.lit("relates_to"))).unionByName(star.withColumn("type", F.lit("is_a")))


def book_of(block):
    """Book of a block of twenty parts: two subjects, 25 codes."""
    code = F.element_at(F.array(*[F.lit(c) for c in ids.ORDER]), (block % len(ids.ORDER) + 1).cast("int"))
    return F.concat_ws("_", F.when(block % 2 == 0, "math").otherwise("physics"), code, F.lit("rjb"))


def chapter_of(block):
    return F.concat(book_of(block), F.lit("_ch"), (F.floor(block / 100) + 1).cast("string"))


def section_of(block):
    return F.concat(chapter_of(block), F.lit("_s"), (F.floor(block / 25) % 4 + 1).cast("string"))


TYPES = ("tests_concept", "tests_skill", "verifies", "prerequisites_for", "relates_to", "is_a", "leads_to")


def school(spark: SparkSession, sf_dir: str, labels: tuple[str, ...] = (*tasks.KNOWLEDGE, "Exercise"), types: tuple[str, ...] = TYPES):
    """A curriculum graph that grows with the tables, with all edges that they have.

    Parts are concepts, suppliers skills, urgent orders experiments and other orders exercises. Every line is
    an edge from its order to its part, and for exercises one to its supplier. Twenty parts make a section, four
    sections a chapter; a part also appears in a later section by its size, and an order in the sections of its parts.
    All sections are there; of the content only nodes of the labels, and edges of the types, are made and placed.
    """
    part, supplier, orders = (table(spark, sf_dir, t) for t in ("part", "supplier", "orders"))
    block = lambda c: F.floor(F.col(c) / 20)
    parts = part.select("p_partkey", block("p_partkey").alias("b"), F.floor((F.col("p_partkey") + 40 * F.col("p_size")) / 20).alias("b2"), F.concat_ws(" ", "p_name", "p_size").alias("name"), "p_name", "p_brand", "p_type", "p_size")
    parts = parts.withColumn("id", F.concat(book_of(F.col("b")), F.lit("_cpt"), F.col("p_partkey").cast("string")))
    skills = supplier.select("s_suppkey", F.col("s_suppkey").alias("b"), F.concat(book_of(F.col("s_suppkey")), F.lit("_skl"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_name").alias("name"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey").join(orders.select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_orderpriority") == "1-URGENT").alias("urgent")), "l_orderkey")
    place = F.col("l_orderkey") % 1000
    order_id = F.concat(book_of(place), F.when(F.col("urgent"), "_exp").otherwise("_exe"), F.col("l_orderkey").cast("string"))
    ordered_kinds = {"Experiment": "urgent", "Exercise": "urgent IS NOT TRUE"}
    kept_once = stored if {"Experiment", "Exercise", "tests_concept", "tests_skill", "verifies"} & {*labels, *types} else (lambda df: df)
    lines = kept_once(lines.select(order_id.alias("order_id"), F.concat(F.lit("Order "), F.col("l_orderkey").cast("string")).alias("order_name"), "urgent", "l_partkey", "l_suppkey", block("l_partkey").alias("b")))
    concept = lines.join(parts.select(F.col("p_partkey").alias("l_partkey"), F.col("id").alias("target")), "l_partkey").select(F.col("order_id").alias("source"), "target", "urgent").distinct()
    skill = lines.where("NOT urgent").join(skills.select(F.col("s_suppkey").alias("l_suppkey"), F.col("id").alias("target")), "l_suppkey").select(F.col("order_id").alias("source"), "target").distinct()

    key = parts.select("id", "p_partkey", "p_name", "p_brand", "p_type", "p_size", (F.col("p_size") % 4).alias("quarter"))
    chain = lambda *by: key.select(F.col("id").alias("source"), F.lead("id").over(Window.partitionBy(*by).orderBy("p_partkey")).alias("target")).where("target IS NOT NULL")
    star = key.select(F.col("id").alias("source"), F.first("id").over(Window.partitionBy("p_name", "p_size").orderBy("p_partkey")).alias("target")).where("source <> target")
    chosen = lines.where(" OR ".join(ordered_kinds[x] for x in ordered_kinds if x in labels) or "false")
    blocks = [parts.select("b"), parts.select(F.col("b2").alias("b")), skills.select("b"), lines.select("b")]
    at = {"Concept": [parts.select(F.col("id").alias("source"), "b"), parts.select(F.col("id").alias("source"), F.col("b2").alias("b"))], "Skill": [skills.select(F.col("id").alias("source"), "b")]}
    at = union([rows for label, tables in at.items() if label in labels for rows in tables] + [chosen.select(F.col("order_id").alias("source"), "b")]).distinct()
    places = stored(union([rows.distinct() for rows in blocks]).distinct().select(book_of(F.col("b")).alias("book"), chapter_of(F.col("b")).alias("chapter"), section_of(F.col("b")).alias("section"), "b"))
    nodes, part_of = graph.structure(places.select("book", F.col("book").alias("book_name"), "chapter", F.col("chapter").alias("chapter_title"), "section", F.col("section").alias("section_title"), F.col("b").alias("ord")))
    label = lambda df, label: df.select("id", F.lit(label).alias("label"), "name")
    ordered = chosen.select(F.col("order_id").alias("id"), F.col("order_name").alias("name"), "urgent").distinct()
    content = [label(rows, kind) for rows, kind in ((parts, "Concept"), (skills, "Skill")) if kind in labels] + [ordered.select("id", F.when(F.col("urgent"), "Experiment").otherwise("Exercise").alias("label"), "name")]
    nodes = stored(union([nodes.select("id", "label", "name"), *content]))
    number = F.regexp_extract("chapter", r"(\d+)$", 1).cast("int")
    leads = places.select(F.col("chapter").alias("source"), number.alias("k"), "book").distinct()
    leads = leads.select("source", F.lead("source").over(Window.partitionBy("book").orderBy("k")).alias("target")).where("target IS NOT NULL")
    typed = [(concept.where("NOT urgent"), "tests_concept"), (skill, "tests_skill"), (concept.where("urgent"), "verifies"), (chain("p_brand", "p_type", "quarter"), "prerequisites_for"), (chain("p_name", "p_brand"), "relates_to"), (star, "is_a"), (leads, "leads_to")]
    none = spark.createDataFrame([], "source string, target string, type string")
    edges_ = stored(union([none, *(rows.select("source", "target", F.lit(name).alias("type")) for rows, name in typed if name in types)]))
    appears = at.select("source", section_of(F.col("b")).alias("target"))
    places_ = graph.locations(nodes, appears, stored(part_of))
    return tasks.Graph(nodes, edges_, stored(places_) if labels else places_)
