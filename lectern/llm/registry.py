"""Queries of this subpackage, each with production parameters over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import audit, brown, exponion, jaccard, language, lines, media, mixing, phrases, quality, secrets, substring, tokens


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words that an earlier document has."""
    return substring.dedup(_docs(spark, sf_dir)).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages learnt from the rows whose crc32(doc_id) mod 5 is not 0."""
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    return language.identify(_docs(spark, sf_dir), rest == 0)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents in windows of 10 words of a benchmark item."""
    return phrases.contamination(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brown class bigrams learnt from the texts whose crc32(doc_id) mod 7 is not 2."""
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7
    return brown.score(_docs(spark, sf_dir), rest == 2)


def op4_lm_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts and the base score of op4, rounded, which SQL can give too."""
    return op4_lm_scoring(spark, sf_dir).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 4).alias("base_score"))


def op5_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ogg round trip of every text."""
    read = media.read_ogg(media.to_ogg(_docs(spark, sf_dir)))
    return read.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal weights for all sources."""
    mixed = mixing.mix(_docs(spark, sf_dir))
    return mixed.select("doc_id", "source", "lang", "text", F.col("mix_copy").cast("int").alias("mix_copy"), "mix_order")


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents, by a forest trained on made findings."""
    return secrets.report(_docs(spark, sf_dir))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weak-label quality scores of all documents."""
    return quality.classify(_docs(spark, sf_dir)).select("doc_id", "quality_score", "quality_keep")


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents linked at a Jaccard similarity of 0.8 on five-word shingles."""
    return jaccard.join(_docs(spark, sf_dir))[0]


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text under the default vocabulary."""
    return tokens.count(_docs(spark, sf_dir))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of 40 code points or more that five documents hold, kept in the last of them."""
    rows = lines.dedup(_docs(spark, sf_dir))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in all orders, by language."""
    cells = audit.cells(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return audit.audit(cells).select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """40 clusters of the vectors of 64 components after five rounds."""
    return exponion.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP6_SQL = """
WITH counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
means AS (SELECT source, 1.0 * (SELECT sum(n) FROM counts)::DOUBLE * 1.0 / (SELECT count(*) FROM counts)::DOUBLE / n AS mean FROM counts),
rates AS (SELECT source, greatest(1, ceil(mean / 64))::INTEGER AS draws, mean / greatest(1, ceil(mean / 64))::INTEGER AS rate FROM means),
cdf AS (
  WITH RECURSIVE steps AS (
    SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS c FROM rates
    UNION ALL
    SELECT source, rate, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) FROM steps
    WHERE k + 1 <= floor(rate + 12 * sqrt(rate) + 20))
  SELECT source, k, c FROM steps),
draws AS (
  SELECT doc_id, source, lang, text, j,
    ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, 'text ' || md5(coalesce(text, ''))) || CASE WHEN j > 0 THEN ':' || j ELSE '' END), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u
  FROM (SELECT d.*, unnest(range(0, draws)) AS j FROM documents d JOIN rates r ON r.source IS NOT DISTINCT FROM d.source)),
counted AS (
  SELECT d.*, (SELECT count(*) FROM cdf WHERE cdf.source IS NOT DISTINCT FROM d.source AND cdf.c <= d.u) AS n FROM draws d),
whole AS (SELECT doc_id, source, lang, text, sum(n)::BIGINT AS n FROM counted GROUP BY ALL)
SELECT doc_id, source, lang, text, copy::INTEGER AS mix_copy,
  md5('order 17:' || coalesce(doc_id::VARCHAR, 'text ' || md5(coalesce(text, ''))) || ':' || copy) AS mix_order
FROM (SELECT *, unnest(range(1, n + 1)) AS copy FROM whole WHERE n > 0)
"""

#: Words of the contracts, and lower case of A-Z alone.
_SPACED, _ALNUM = r"[^\x20\x09-\x0D]+", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_SQL = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w FROM documents),
windows AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w)),
firsts AS (SELECT h, min(doc_id) AS least FROM windows GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM windows JOIN firsts ON windows.h = firsts.h WHERE least < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM w),
kept AS (SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.p) AS kept, count(*) AS n FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p WHERE gone.p IS NULL GROUP BY words.doc_id)
SELECT w.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""

OP3_SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM benchmark),
queries AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS q FROM (SELECT item, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM queries),
places AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS q FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d JOIN sizes ON len(w) >= k)),
found AS (SELECT doc_id, item, places.k AS k, i FROM places JOIN queries ON places.k = queries.k AND places.q = queries.q),
hits AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(hits.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(hits.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hits ON d.doc_id = hits.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
"""

#: crc32 of the digits of an id, by the table of its bytes.
_CRC = """tab AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM (SELECT unnest(range(0, 256))::BIGINT AS i)),
crc AS (SELECT doc_id, text, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda a, x: xor(t[(xor(a, x) & 255) + 1], a >> 8)), 4294967295) AS crc FROM documents, tab)"""

OP4_BASE_SQL = f"""
WITH {_CRC},
tokens AS (SELECT doc_id, crc % 7 = 2 AS held_out, unnest(list_append(regexp_extract_all({_LOWER}, '{_SPACED}'), '')) AS token FROM crc),
counts AS (SELECT token, count(*) AS c FROM tokens WHERE NOT held_out GROUP BY token),
whole AS (SELECT sum(c)::BIGINT AS n, count(*) AS v FROM counts)
SELECT doc_id, held_out, count(*) AS n_tokens, count(c) AS n_known, any_value(n) AS train_tokens, round(sum(log10((coalesce(c, 0) + 1) / (n + 1 * (v + 1))::DOUBLE)), 4) AS base_score
FROM tokens LEFT JOIN counts ON tokens.token = counts.token, whole GROUP BY doc_id, held_out
"""

OP9_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_SPACED}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 80 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a AS doc_id, b AS other FROM edges UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON r.other = e.a)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, least(w.doc_id, coalesce(min(other), w.doc_id)) AS component_id
FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN reach ON w.doc_id = reach.doc_id GROUP BY w.doc_id
"""

OP11_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, generate_subscripts(l, 1) AS p, unnest(l) AS line FROM d),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
kept AS (SELECT doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY p) AS kept FROM keyed LEFT JOIN common ON keyed.key = common.key WHERE last IS NULL OR last = doc_id GROUP BY doc_id)
SELECT d.doc_id, len(l) AS n_lines, len(l) - coalesce(n, 0) AS n_dropped, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""

OP12_SQL = r"""
WITH letters AS (SELECT unnest(range(0, 5)) AS f),
orders AS (SELECT a.f AS a, b.f AS b, c.f AS c, d.f AS d, e.f AS e FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.f NOT IN (b.f, c.f, d.f, e.f) AND b.f NOT IN (c.f, d.f, e.f) AND c.f NOT IN (d.f, e.f) AND d.f <> e.f),
steps AS (SELECT array_to_string(list_transform([a, b, c, d, e], lambda x: chr(65 + x::INTEGER)), '') AS filter_order, [a, b, c, d, e] AS o, unnest(range(1, 6)) AS step FROM orders),
t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
m AS (SELECT doc_id, part, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text), regexp_matches(text, '[#$%&*|]'), doc_id > least] AS fails FROM t),
x AS (SELECT m.part, fails, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic, count(*) AS n FROM m LEFT JOIN labels ON m.doc_id = labels.doc_id GROUP BY ALL),
r AS (SELECT part, filter_order, step, o[step] AS f, n, good, toxic, fails[o[step] + 1] AS now, len(list_filter(o[1:step - 1], lambda k: fails[k + 1])) > 0 AS before, len(list_filter(fails, lambda y: y)) AS n_fails FROM x, steps),
s AS (SELECT part, filter_order, step, f, coalesce(sum(n) FILTER (NOT now AND NOT before), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (now AND NOT before), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (now AND before), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (now AND n_fails = 1), 0)::BIGINT AS unique_fails,
  coalesce(sum(n) FILTER (now AND NOT before AND good), 0)::BIGINT AS good_lost, coalesce(sum(n) FILTER (now AND NOT before AND toxic), 0)::BIGINT AS toxic_lost FROM r GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM s
"""


def _op13_sql(k: int = 40, rounds: int = 5) -> str:
    """Lloyd's rounds one after another; lists of integers, so that all is exact."""
    near = """a{i} AS MATERIALIZED (SELECT id, min(d * {k} + j) // {k} AS d, min(d * {k} + j) % {k} AS j FROM (
  SELECT id, j, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM v, c{i}) GROUP BY id)"""
    mean = """c{n} AS MATERIALIZED (SELECT c{i}.j, coalesce(m.c, c{i}.c) AS c FROM c{i} LEFT JOIN (
  SELECT j, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY p) AS c FROM (SELECT j, p, sum(x)::BIGINT AS s, count(*) AS n FROM (
    SELECT j, unnest(v) AS x, generate_subscripts(v, 1) AS p FROM v JOIN a{i} ON v.id = a{i}.id) GROUP BY j, p) GROUP BY j) m ON c{i}.j = m.j)"""
    ctes = [
        "v AS MATERIALIZED (SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS j, v AS c FROM (SELECT v, sha256('2:' || vec_id) AS h FROM v ORDER BY h LIMIT {k}))",
    ]
    for i in range(rounds):
        ctes += [near.format(i=i, k=k), mean.format(i=i, n=i + 1)]
    ctes.append(near.format(i=rounds, k=k))
    return f"""WITH {", ".join(ctes)}
SELECT vec_id, a.j::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a.j))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM v JOIN a{rounds} a ON v.id = a.id JOIN c{rounds} c ON a.j = c.j"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_substring_dedup, op2_language_id, op3_decontamination, op4_lm_scoring, op4_lm_base, op5_media_columns, op6_mixing, op7_secret_scans, op8_quality, op9_ngram_jaccard, op10_token_counts, op11_line_dedup, op12_filter_audit, op13_centroid_clustering)
}
SQL = {"op1_substring_dedup": OP1_SQL, "op3_decontamination": OP3_SQL, "op4_lm_base": OP4_BASE_SQL, "op6_mixing": OP6_SQL, "op9_ngram_jaccard": OP9_SQL, "op11_line_dedup": OP11_SQL, "op12_filter_audit": OP12_SQL, "op13_centroid_clustering": _op13_sql()}
