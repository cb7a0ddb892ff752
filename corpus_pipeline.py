"""A training-data pipeline over ``documents``: five stages, each written as Parquet and read again for the next.

Quality classifier, n-gram Jaccard join, benchmark decontamination, secret scans, mixing.
Each stage works on all rows that the one before kept; all but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import jaccard, mixing, phrases, quality, secrets
from lectern.llm.tables import drop, free, stored


def with_keys(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a key column, and its name: doc_id, or in rows without one a number of their own above all ids, stored so that it stays the same."""
    (key,) = free(docs, "_key")
    seen = docs.agg(F.max(F.col("doc_id").cast("long")), F.count("*") - F.count("doc_id")).first()
    if not seen[1]:
        return docs.withColumn(key, F.col("doc_id").cast("long")), key
    own = F.lit(max(0, (seen[0] or 0) + 1)) + F.monotonically_increasing_id()
    return stored(docs.withColumn(key, F.coalesce(F.col("doc_id").cast("long"), own))), key


def by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier, fitted on docs, does not reject.

    Each row is judged on its text, whatever its id; equal texts are judged alike. A null or empty text gives no
    evidence: it stays where the corpus is good for the most part, as do texts of few words without marks of bad ones.
    """
    return quality.classify(docs).where("quality_keep").select(docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least doc_id, of each group linked at 0.8.

    Repeated rows of one doc_id are one document: one of them stays. Each row without a doc_id is a
    document of its own, and goes where it is linked to a document with one.
    """
    keyed, key = with_keys(docs)
    groups, _ = jaccard.join(keyed.select(key, "text"), id_col=key)
    first = groups.where(F.col(key) == F.col("component_id")).select(key).distinct()
    return keyed.join(first, key, "left_semi").dropDuplicates([key]).select(docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents none of whose words lie in a window of a benchmark item.

    Null and empty texts have no words and stay. A row without an id goes by its own text; rows of one id are one
    document, and all go if one of them has such words.
    """
    keyed, key = with_keys(docs)
    found = phrases.contamination(keyed.select(key, "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=key)
    return keyed.join(found.where("contaminated").select(key).distinct(), key, "left_anti").select(docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret in their texts replaced by a mark; n_chars follows.

    Null and empty texts stay as they are, and repeated rows are changed alike.
    """
    clean = secrets.scan(docs)
    change = F.size("secrets") > 0
    changed = {"text": F.when(change, F.col("redacted")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(change, F.length("redacted").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return clean.withColumns(changed).select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that all sources weigh alike, in an order that mixes them.

    Rows without a source are a source of their own; rows of one id get one count each, by their
    id's hash and source, and rows without one by their text's. Null and empty texts are drawn like all others. Two columns are new: mix_copy and mix_order.
    """
    return mixing.mix(docs)


STAGES = [
    ("quality", by_quality),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("mixing", mixed),
]

#: No SQL: the first stages fit models.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        after = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return after
        after = stored(after)
        if i:
            drop(docs)  # nothing reads the table of the stage before any more
        docs = after
