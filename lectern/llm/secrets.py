"""Secret scans: pattern candidates, and a random forest that removes false positives.

The forest sees a candidate's length and character transitions, how much of it the
letter trigrams of words cover, the path it came from and its neighbouring words. The
trigrams are those usual in the whole corpus and in the findings' surroundings, the same
in training and in use. It learns from labelled findings; a seeded maker of such findings
stands in where none are given.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm import words as W
from lectern.llm.tables import free, small_batches

#: Characters of a candidate that no keyword names, and of the text before and after it that count as neighbours.
SHORTEST, NEIGHBOURS = 16, 64
#: Labelled findings at most, trees and depth of the forest, and the probability from which a candidate is a secret.
FINDINGS, TREES, DEPTH, LEVEL = 20_000, 40, 12, 0.5
REDACTED = "[SECRET]"
#: Share of all letter trigrams that the usual ones make up.
USUAL = 0.9

_CANDIDATE = re.compile(r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{16,}+={0,2}+(?![A-Za-z0-9_+/-])")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[a-z]{3,}")

#: Neighbouring words that stand beside secrets, and beside harmless look-alikes.
KEYWORDS = ("token", "secret", "password", "passwd", "pwd", "apikey", "api_key", "api-key", "access_key", "credential", "bearer", "authorization", "private_key", "client_secret")
HARMLESS = ("sha", "md5", "checksum", "commit", "digest", "hash", "uuid", "guid", "etag", "revision", "example", "sample", "placeholder", "http://", "https://")
EMPTY_VALUES = ("none", "null", "nil", "true", "false", "yes", "no", "required", "optional", "undefined", "changeme")
TEST_PATHS = ("test", "example", "sample", "fixture", "doc", "mock")

#: What stands left of an assignment to a keyword, and right of its first sign. A value in quotes goes up to these, another up to a separator.
_NAMED = re.compile(rf"(?:{'|'.join(map(re.escape, KEYWORDS))})[\w.-]*+[\"'`\])]*[ \t]*$", re.IGNORECASE)
_SIGN = re.compile(r"[=:]")
_VALUE = re.compile(r"[=:]{1,3}>?[ \t]*(?:(?:bearer|basic|token)[ \t]+)?(?:\"([^\"\s]+)|'([^'\s]+)|`([^`\s]+)|([^\s\"'`<>(){}\[\],;&|]+))", re.IGNORECASE)

#: Keys whose own shape or place tells them: bodies of private keys, signed tokens, passwords in addresses, and what a sentence says a keyword is.
_PEM = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----\s*([A-Za-z0-9+/=\s]*[A-Za-z0-9+/=])\s*-----END [A-Z ]*PRIVATE KEY-----")
_SIGNED = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")
_ADDRESS = re.compile(r"://[^\s/:@]{1,64}:([^\s/@]{1,256})@")
_SAID = re.compile(r"[ \t](?:is|was)[ \t]+[\"'`]?([^\s\"'`<>(){}\[\],;&|]{4,})", re.IGNORECASE)
_ENDS = re.compile(rf"(?:{'|'.join(map(re.escape, KEYWORDS))})[ \t]*$", re.IGNORECASE)

FEATURES = ("shaped", "said", "length", "transitions", "entropy", "digits", "uppers", "hex", "repeats", "coverage", "keyword", "assigned", "quoted", "harmless", "slashes", "test_path", "empty_value")


def _kind(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def describe(token: str, before: str, after: str, path: str, dictionary: set[str]) -> list[float]:
    """FEATURES of a candidate."""
    n = len(token)
    low, near = token.lower(), before.lower()
    kinds = [_kind(c) for c in token]
    counts = Counter(token)
    grams = [low[i : i + 3] for i in range(n - 2)]
    letters = [g for g in grams if g.isalpha()]
    words = near.split()[-4:]
    beside = " ".join(words)
    shaped = before.rstrip().endswith("PRIVATE KEY-----") or _SIGNED.fullmatch(token) or (re.search(r"://[^\s/:@]{1,64}:$", before) and after.startswith("@"))
    return [
        float(bool(shaped)),
        float(bool(re.search(r"\b(?:is|was)[ \t]+[\"'`]?$", near))),
        float(n),
        sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / max(1, n - 1),
        -sum(c / n * math.log2(c / n) for c in counts.values()),
        kinds.count(2) / n,
        kinds.count(1) / n,
        sum(c in "0123456789abcdef" for c in low) / n,
        sum(a == b for a, b in zip(token, token[1:], strict=False)) / max(1, n - 1),
        sum(g in dictionary for g in letters) / max(1, len(grams)),
        float(any(k in beside for k in KEYWORDS)),
        float(bool(re.search(r"[=:]\s*[\"']?$", near))),
        float(before.endswith(('"', "'")) and after.startswith(('"', "'"))),
        float(any(k in beside for k in HARMLESS)),
        token.count("/") / n,
        float(any(k in (path or "").lower() for k in TEST_PATHS)),
        float(low in EMPTY_VALUES),
    ]


def dictionary(text: str) -> set[str]:
    """Trigrams of the plain words of a text."""
    out = set()
    for word in set(_WORD.findall(text.lower())):
        out.update(word[i : i + 3] for i in range(len(word) - 2))
    return out


def _trigram_counts(batches):
    """Counts of all runs of three letters a to z, in lower case, of the texts of a task: 26 ** 3 numbers at most."""
    total = np.zeros(26**3, np.int64)
    for _, data, bounds in W.texts(batches):
        letter = W.lowered(data).astype(np.int64) - 97
        inside = (letter >= 0) & (letter < 26)
        row_ends = np.zeros(len(data) + 1, bool)
        row_ends[bounds] = True
        # no run crosses from one text into the next
        runs = inside[:-2] & inside[1:-1] & inside[2:] & ~row_ends[1:-2] & ~row_ends[2:-1] if len(data) > 2 else np.zeros(0, bool)
        at = np.flatnonzero(runs)
        total += np.bincount(letter[at] * 676 + letter[at + 1] * 26 + letter[at + 2], minlength=26**3)
    seen = np.flatnonzero(total)
    yield pa.record_batch({"code": pa.array(seen), "c": pa.array(total[seen])})


def usual_trigrams(docs: DataFrame, text_col: str = "text") -> set[str]:
    """The most frequent letter trigrams of all texts that together make up USUAL of all their trigrams."""
    rows = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(_trigram_counts, "code long, c long")
    counts = rows.groupBy("code").agg(F.sum("c").alias("c")).orderBy(F.desc("c"), "code").collect()
    until, out = 0, set()
    whole = sum(r[1] for r in counts)
    for code, c in counts:
        if until >= USUAL * whole:
            break
        out.add("".join(chr(97 + x) for x in (code // 676, code // 26 % 26, code % 26)))
        until += c
    return out


def assigned(text: str):
    """(start, end) of every value assigned to a keyword, whatever its length and characters; full stops and colons after an unquoted one aside."""
    done = 0
    for sign in _SIGN.finditer(text):
        at = sign.start()
        if at < done or not _NAMED.search(text[max(0, at - NEIGHBOURS) : at]):
            continue
        if m := _VALUE.match(text, at):
            start, end = m.span(m.lastindex)
            if m.lastindex == 4:
                end = start + len(m[4].rstrip(".:"))
            if end > start:
                yield start, end
                done = end


def candidates(text: str):
    """(start, end) of every run that may be a secret, none inside another.

    These are the bodies of private keys, over several lines too, the values assigned to a keyword, signed tokens,
    passwords in addresses, what a sentence says a keyword is, and elsewhere SHORTEST characters or more of a
    key's alphabet, a digit among them.
    """
    found: list[tuple[int, int]] = []

    def take(spans):
        at = 0
        for start, end in spans:
            while at < len(taken) and taken[at][1] <= start:
                at += 1
            if at == len(taken) or taken[at][0] >= end:
                found.append((start, end))

    groups = (
        (m.span(1) for m in _PEM.finditer(text)),
        assigned(text),
        (m.span() for m in _SIGNED.finditer(text)),
        (m.span(1) for m in _ADDRESS.finditer(text)),
        ((m.start(1), m.start(1) + len(m[1].rstrip(".:!?"))) for m in _SAID.finditer(text) if _ENDS.search(text[max(0, m.start() - NEIGHBOURS) : m.start()])),
        (m.span() for m in _CANDIDATE.finditer(text) if _DIGIT.search(m[0])),
    )
    for spans in groups:  # what an earlier group has found is no candidate of a later one
        taken = sorted(found)
        take(spans)
    yield from sorted(found)


def made_findings(n: int = 8_000, seed: int = 5) -> list[tuple[str, str, str, str, int]]:
    """Labelled findings (token, before, after, path, label) by a seeded rule, half of them secrets.

    Secrets: random keys of usual alphabets and lengths, and short passwords or keys of letters, after an
    assignment with spaces or without, or in a URL. Others: digests and ids under their names, placeholders,
    paths, words run together with numbers, and plain words and placeholders assigned to a keyword.
    """
    rng = random.Random(seed)
    syllables = ["con", "ter", "ing", "ment", "ora", "del", "ein", "que", "the", "ati", "sch", "ion", "lar", "est", "ver", "per"]
    hex_, base, upper = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    prose = lambda: " ".join(word() for _ in range(rng.randint(2, 6)))
    key = lambda alphabet, sizes: "".join(rng.choice(alphabet) for _ in range(rng.choice(sizes)))
    out = []
    for i in range(n):
        path = rng.choice(["src1", "app/config.py", "deploy/env", "notes.txt", "tests/data.py"])
        shout = rng.random() < 0.15
        if i % 2:
            token = rng.choice([lambda: key(hex_, (32, 40, 48, 64)), lambda: key(base, (20, 24, 32, 40, 64)), lambda: "AKIA" + rng.choice([key(upper, (16,)), "".join(word() for _ in range(8)).upper()[:16]]), lambda: "ghp_" + key(base, (36,)), lambda: key(base + "+/", (40, 44)) + "=", lambda: key(base[:52], (16, 20, 24, 32)), lambda: key(base + "!#$%@_-", range(6, 16)), lambda: "".join(word() for _ in range(3))])()
            name = rng.choice(KEYWORDS)
            quote = rng.choice(['"', '"', "'", ""])
            before, after = rng.choice([
                lambda: (f"{prose()} {name} {rng.choice(['=', '=', ':'])} {quote}", quote + " " + prose()),
                lambda: (f"{prose()} {rng.choice(['', word().upper() + '_', 'export '])}{rng.choice([name, name.upper()])}{rng.choice('==:')}{quote}", quote + " " + prose()),
                lambda: (f"{prose()} {rng.choice(['https://', 'http://', ''])}{word()}.org/{word()}{rng.choice('?&')}{name}=", rng.choice(["", "&" + word() + "=1"]) + " " + prose()),
            ])()
            if rng.random() < 0.1:
                before, after = f"{prose()} {name} {rng.choice(['is', 'was'])} {quote}", quote + rng.choice([" ", ". ", ", "]) + prose()
            elif rng.random() < 0.1:
                # keys that their own shape or place tells
                token, before, after = rng.choice([
                    lambda: ("\n".join(key(base + "+/", (64,)) for _ in range(rng.randint(2, 12))) + "==", f"{prose()} -----BEGIN {rng.choice(['', 'RSA ', 'EC '])}PRIVATE KEY-----\n", "\n-----END " + prose()),
                    lambda: ("eyJ" + key(base, (17, 33)) + "." + key(base, (40, 90)) + "." + key(base, (43,)), prose() + " ", " " + prose()),
                    lambda: (key(base + "!#$%_-", range(6, 20)), f"{prose()} {rng.choice(['mysql', 'https', 'postgres', 'amqp'])}://{word()}:", f"@{word()}.org/{word()} " + prose()),
                ])()
                shout = False
        else:
            token = rng.choice([lambda: key(hex_, (32, 40, 64)), lambda: "".join(word() for _ in range(5)) + str(rng.randint(0, 99)), lambda: rng.choice("xX0*a") * rng.randint(16, 40) + "1", lambda: "/".join(word() for _ in range(4)) + f"/{rng.randint(1, 999)}", lambda: "-".join(key(hex_, (k,)) for k in (8, 4, 4, 4, 12)), lambda: key("0123456789", (16, 18, 20, 24)), lambda: f"{rng.randint(1990, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}-{word()}-{word()}"])()
            before, after = rng.choice([f"{prose()} {rng.choice(HARMLESS)} ", f"{prose()} {rng.choice(HARMLESS)}: ", f"{prose()} {rng.choice(HARMLESS)}=", f"{prose()} {word()}=", prose() + " "]), " " + prose()
            if rng.random() < 0.4:
                # a word of the text, or a placeholder, is no key although a keyword stands before it
                token = rng.choice([word, lambda: word().title(), lambda: rng.choice(EMPTY_VALUES), lambda: rng.choice(EMPTY_VALUES).title(), lambda: rng.choice(["xxxx", "****", "your-" + word()]), lambda: rng.choice("xX*.") * rng.randint(6, 40)])()
                before, after = f"{prose()} {rng.choice(KEYWORDS)}{rng.choice(['=', ' = ', ': ', ': ', ' is '])}", f" {prose()} {token if token.isalpha() and rng.random() < 0.5 else word()} {prose()}"
        if shout:
            token, before = token.upper(), before.upper()
        out.append((token, before, after, path, i % 2))
    return out


def labelled(findings: DataFrame | None) -> list[tuple]:
    """Labelled findings (token, before, after, path, label 0 or 1), FINDINGS of them at most; made ones where none are given."""
    if findings is None:
        return made_findings()
    rows = findings.select("token", "before", "after", "path", F.col("label").cast("int")).where("token <> '' AND label IS NOT NULL")
    return [tuple(r) for r in rows.orderBy(F.xxhash64("token"), "before", "label").limit(FINDINGS).collect()]


def known_trigrams(rows: list[tuple]) -> set[str]:
    """Trigrams of the words around findings."""
    return dictionary(" ".join(f"{before} {after}" for _, before, after, _, _ in rows))


def fit(spark: SparkSession, rows: list[tuple], known: set[str]):
    """Random forest on labelled findings; ``known``: the trigrams that count as those of words."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    values = [(*describe(t, b or "", a or "", p or "", known), float(y)) for t, b, a, p, y in rows]
    shape = ", ".join(f"{n} double" for n in (*FEATURES, "label"))
    frame = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(spark.createDataFrame(values, shape).coalesce(1))
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=7, featureSubsetStrategy="sqrt").fit(frame)


def flat_trees(forest) -> list[tuple[np.ndarray, ...]]:
    """The fitted trees as arrays (feature, threshold, left, right, probability of a secret), to score inside tasks."""
    out = []
    for tree in forest.trees:
        rows: list = []

        def walk(node) -> int:
            at = len(rows)
            rows.append(None)
            stats = node.impurityStats().stats()
            p = stats[1] / max(1e-12, stats[0] + stats[1])
            if node.subtreeDepth() == 0:
                rows[at] = (-1, 0.0, at, at, p)
            else:
                split = node.split()
                left, right = walk(node.leftChild()), walk(node.rightChild())
                rows[at] = (split.featureIndex(), split.threshold(), left, right, p)
            return at

        walk(tree._call_java("rootNode"))
        out.append(tuple(np.array(c) for c in zip(*rows, strict=True)))
    return out


def probability(trees, x: np.ndarray) -> np.ndarray:
    """Mean probability over the trees of each row of features."""
    total = np.zeros(len(x))
    for feature, threshold, left, right, p in trees:
        at = np.zeros(len(x), np.int64)
        for _ in range(DEPTH):
            inner = feature[at] >= 0
            down = x[np.arange(len(x)), np.maximum(feature[at], 0)] <= threshold[at]
            at = np.where(inner, np.where(down, left[at], right[at]), at)
        total += p[at]
    return total / max(1, len(trees))


def _scan(trees, text_at, path_at):
    def run(batches):
        forest, known = trees.value
        for b in batches:
            texts, paths = b.column(text_at).to_pylist(), b.column(path_at).to_pylist()
            found, rows, x = [], [], []
            for i, text in enumerate(texts):
                spans = list(candidates(text or ""))
                if not spans:
                    continue
                for s, e in spans:
                    found.append((s, e))
                    rows.append(i)
                    x.append(describe(text[s:e], text[max(0, s - NEIGHBOURS) : s], text[e : e + NEIGHBOURS], paths[i] or "", known))
            p = probability(forest, np.array(x).reshape(-1, len(FEATURES)))
            spans_of: list[list] = [[] for _ in texts]
            for i, span, q in zip(rows, found, p.tolist(), strict=True):
                if q >= LEVEL:
                    spans_of[i].append({"start": span[0], "end": span[1], "probability": q})
            clean = []
            for text, spans in zip(texts, spans_of, strict=True):
                for s in reversed(spans):
                    text = text[: s["start"]] + REDACTED + text[s["end"] :]
                clean.append(text)
            total = np.bincount(np.array(rows, np.int64), minlength=len(texts))
            out = b.drop_columns([text_at, path_at])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))
            yield out.append_column("secret_candidates", pa.array(total)).append_column("secrets", pa.array(spans_of, kind)).append_column("redacted", pa.array(clean, pa.string()))

    return run


def scan(docs: DataFrame, findings: DataFrame | None = None, text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """docs with secret_candidates, secrets (start, end in characters, probability) and redacted, the text without them.

    These replace columns of those names; all rows and other columns stay, whatever they hold. A null
    text has no candidates and stays null, an empty one stays empty. Without a path column, or where it
    is null, the path counts as unknown. Equal texts with equal paths have equal results.
    """
    small_batches(docs.sparkSession)
    kept = docs.drop("secret_candidates", "secrets", "redacted")
    path = F.col(path_col).cast("string") if path_col and path_col in docs.columns else F.lit(None).cast("string")
    names = free(kept, "_secret_text", "_secret_path")
    rows = kept.withColumns(dict(zip(names, (F.col(text_col).cast("string"), path), strict=True)))
    found = labelled(findings)
    known = usual_trigrams(docs, text_col) | known_trigrams(found)
    trees = docs.sparkSession.sparkContext.broadcast((flat_trees(fit(docs.sparkSession, found, known)), known))
    more = T._parse_datatype_string("secret_candidates long, secrets array<struct<start:int,end:int,probability:double>>, redacted string")
    return rows.mapInArrow(_scan(trees, *names), T.StructType([*kept.schema.fields, *more.fields]))


def report(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """For each row of docs: id, n_candidates, n_secrets, spans (start-end, comma-joined) and redacted_sha256 (null for a null text)."""
    found = scan(docs, **options)
    spans = F.array_join(F.transform("secrets", lambda s: F.concat_ws("-", s.start, s.end)), ",")
    return found.select(F.col(id_col), F.col("secret_candidates").alias("n_candidates"), F.size("secrets").cast("long").alias("n_secrets"), spans.alias("spans"), F.sha2(F.col("redacted").cast("binary"), 256).alias("redacted_sha256"))
