"""Language identification by cross-parsing entropy.

For each language, a suffix automaton of labelled text recognises every string that
occurs in it. A text is parsed greedily into longest matches, phrases; the language
that needs the fewest phrases for its characters wins.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm import words as W
from lectern.llm.tables import small_batches, stored

#: Bounds of the sample of a language: distinct texts, their characters together, and those of one text. Only whole texts are
#: taken, and one in any case: where a language has no text within LONGEST, its shortest.
SAMPLE_ROWS, SAMPLE_CHARS, LONGEST = 400, 60_000, 4_000
#: Characters in a piece; the pieces of all texts are parsed side by side, and joined to the parse of the whole text.
PIECE = 256
#: Languages whose automata a task holds at once; with more, the texts are parsed block by block of languages.
BLOCK = 16
#: Entries of a dense table of states and characters; a larger one (alphabets of thousands) is kept as sorted keys.
DENSE = 1 << 24


def normalised(text: str | None) -> str:
    """Lower case, each run of characters other than letters as one space."""
    return " ".join("".join(c if c.isalpha() else " " for c in (text or "").lower()).split())


def automaton(text: str) -> tuple[list[dict[str, int]], list[int]]:
    """Suffix automaton: transitions of each state, and the length of its longest string. State 0 is the start."""
    nexts: list[dict[str, int]] = [{}]
    links, lengths, last = [-1], [0], 0
    for c in text:
        new = len(nexts)
        nexts.append({})
        links.append(0)
        lengths.append(lengths[last] + 1)
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = new
            p = links[p]
        if p >= 0:
            q = nexts[p][c]
            if lengths[q] == lengths[p] + 1:
                links[new] = q
            else:
                copy = len(nexts)
                nexts.append(dict(nexts[q]))
                links.append(links[q])
                lengths.append(lengths[p] + 1)
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = copy
                    p = links[p]
                links[q] = links[new] = copy
        last = new
    return nexts, lengths


class Language:
    """The automaton of one sample. Characters have numbers; one that the sample lacks has the last, which nothing follows."""

    def __init__(self, name: str, sample: str):
        self.name = name
        alphabet = sorted(set(sample))
        self.codes = np.array([ord(c) for c in alphabet], np.uint32)
        self.wide = len(alphabet) + 1
        column = {c: i for i, c in enumerate(alphabet)}
        nexts, _ = automaton(sample)
        self.states, self.grid, self.steps = len(nexts), None, None
        keys = np.fromiter((state * self.wide + column[c] for state, step in enumerate(nexts) for c in step), np.int64)
        to = np.fromiter((t for step in nexts for t in step.values()), np.int32, len(keys))
        order = np.argsort(keys)
        self.keys, self.to = keys[order], to[order]

    def opened(self) -> Language:
        """With its dense table where that is small enough; only the sorted keys travel to tasks."""
        if self.grid is None and self.states * self.wide <= DENSE:
            self.grid = np.full(self.states * self.wide, -1, np.int32)
            self.grid[self.keys] = self.to
        return self

    def follow(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        """States after the characters; -1 where nothing follows."""
        key = state.astype(np.int64) * self.wide + c
        if self.grid is not None:
            return self.grid[key]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.to[at], -1)

    def numbers(self, points: np.ndarray) -> np.ndarray:
        """Numbers of code points."""
        if not len(self.codes):
            return np.zeros(len(points), np.int64)
        top = int(self.codes[-1]) + 1
        table = np.full(top + 1, self.wide - 1, np.int64)
        table[self.codes] = np.arange(len(self.codes))
        return table[np.minimum(points, top)]

    def pieces(self, c: np.ndarray, begin: np.ndarray, stop: np.ndarray, end: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy parse of each piece from its start: (phrases that start in it, start of the first phrase after it).

        ``end`` is the end of the text. The number of each phrase start in its piece is written into mark.
        """
        order = np.argsort(begin - stop, kind="stable")
        first, size = begin[order], (stop - begin)[order]
        state, count = np.zeros(len(order), np.int64), np.ones(len(order), np.int64)
        mark[first] = 0
        for step in range(int(size[0]) if len(size) else 0):
            live = int(np.searchsorted(-size, -step, "left"))
            here = c[first[:live] + step]
            to = self.follow(state[:live], here)
            cut = np.flatnonzero(to < 0)
            if len(cut):
                # a match ends here and a phrase starts; one that starts with an unknown character ends with it
                at = cut[state[cut] != 0]
                mark[first[at] + step] = count[at]
                count[at] += 1
                again = self.follow(np.zeros(len(cut), np.int64), here[cut])
                to[cut] = np.maximum(again, 0)
                lone = cut[again < 0]
                lone = lone[size[lone] > step + 1]
                mark[first[lone] + step + 1] = count[lone]
                count[lone] += 1
            state[:live] = to
        after = stop[order]
        live = np.flatnonzero((state != 0) & (after < end[order]))
        while len(live):  # the last phrase may end in the next piece
            to = self.follow(state[live], c[after[live]])
            live, to = live[to >= 0], to[to >= 0]
            state[live] = to
            after[live] += 1
            live = live[after[live] < end[order[live]]]
        out = np.empty((2, len(order)), np.int64)
        out[0, order], out[1, order] = count, after
        return out[0], out[1]

    def parse(self, c: np.ndarray, begin: np.ndarray, stop: np.ndarray, end: np.ndarray, mark: np.ndarray, base: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """As pieces(), from starts within or after the pieces.

        base: what pieces() gave. A parse that meets one of its phrase starts ends there, as both go on alike.
        """
        pos, state, count = begin.copy(), np.zeros(len(begin), np.int64), np.zeros(len(begin), np.int64)
        live = np.flatnonzero(begin < end)
        while len(live):
            p, s = pos[live], state[live]
            to = np.full(len(live), -1, np.int64)
            inner = np.flatnonzero(s != 0)
            to[inner] = self.follow(s[inner], c[p[inner]])
            starts = np.flatnonzero(to < 0)  # a phrase starts here: at the entry, after an unknown character, or where a match ends
            inside = p[starts] < stop[live[starts]]
            done, starts = starts[~inside], starts[inside]
            same = mark[p[starts]] >= 0
            met, starts = starts[same], starts[~same]
            count[live[met]] += base[0][live[met]] - mark[p[met]]
            pos[live[met]] = base[1][live[met]]
            count[live[starts]] += 1
            to[starts] = np.maximum(self.follow(np.zeros(len(starts), np.int64), c[p[starts]]), 0)
            keep = np.ones(len(live), bool)
            keep[done] = keep[met] = False
            live = live[keep]
            pos[live] += 1
            state[live] = to[keep]
            live = live[pos[live] < end[live]]
        return count, pos

    def phrases(self, points: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Phrases of each text; text k has the characters first[k] to first[k] + size[k].

        All pieces are parsed from their own start at once. Then each is entered where the parse of the piece
        before left it, which soon meets a start of its own parse. The few pieces where this does not settle, those
        of periodic texts, are walked in order.
        """
        c = self.numbers(points)
        number, of = W.runs(np.zeros(len(size), np.int64), -(-size // PIECE))
        begin = first[of] + number * PIECE
        end = (first + size)[of]
        stop = np.minimum(begin + PIECE, end)
        mark = np.full(len(points), -1, np.int64)
        base = self.pieces(c, begin, stop, end, mark)
        count, after, entry = base[0].copy(), base[1].copy(), begin.copy()
        inner = np.flatnonzero(number > 0)
        changed = inner[entry[inner] != after[inner - 1]]
        entry[changed] = after[changed - 1]
        count[changed], after[changed] = self.parse(c, entry[changed], stop[changed], end[changed], mark, (base[0][changed], base[1][changed]))
        changed = inner[entry[inner] != after[inner - 1]]
        if len(changed):
            ends = np.append(np.flatnonzero(np.diff(of)), len(of) - 1)
            last = ends[np.searchsorted(ends, np.arange(len(of)))]  # the last piece of each piece's text
            done = -1
            for k in changed.tolist():
                while done < k <= last[k] and entry[k] != after[k - 1]:
                    entry[k] = after[k - 1]
                    count[k], after[k] = self.walk(c, int(entry[k]), int(stop[k]), int(end[k]), mark, int(base[0][k]), int(base[1][k]))
                    done = k
                    if k == last[k]:
                        break
                    k += 1
        return np.bincount(of, weights=count, minlength=len(size)).astype(np.int64)

    def walk(self, c: np.ndarray, at: int, stop: int, end: int, mark: np.ndarray, total: int, leaves: int) -> tuple[int, int]:
        """As parse() with a base, for one piece, character by character."""
        upto = min(end, stop + len(self.keys))
        codes, marks = c[at:upto].tolist(), mark[at:stop].tolist()
        step = memoryview(self.grid) if self.grid is not None else None
        if step is None and self.steps is None:
            self.steps = dict(zip(self.keys.tolist(), self.to.tolist(), strict=True))
        wide, state, count, p = self.wide, 0, 0, 0
        while p < len(codes):
            if not state:
                if at + p >= stop:
                    return count, at + p
                if marks[p] >= 0:
                    return count + total - marks[p], leaves
                count += 1
            key = state * wide + codes[p]
            to = step[key] if step is not None else self.steps.get(key, -1)
            if to >= 0:
                state = to
                p += 1
            elif state:
                state = 0
            else:
                p += 1  # an unknown character is a phrase of its own
        return count, at + p


_FOUND = "best string, low double, rest double, known boolean"


def _measure(block, with_text: bool):
    """Best language of each text so far, and the fewest and next fewest phrases a character."""

    def run(batches):
        languages = [x.opened() for x in block.value]
        for rows, _, _ in W.texts(batches, size=2 * W.SLICE_BYTES):  # more pieces side by side
            points, size = _points([t or "" for t in rows.column("text").to_pylist()])
            first = np.cumsum(size) - size
            rate = np.stack([x.phrases(points, first, size) for x in languages]) / np.maximum(1, size)
            before = rows.column("best")
            low = rows.column("low").to_numpy(zero_copy_only=False)
            order = np.argsort(np.concatenate([low[None], rate]), axis=0, kind="stable")
            both = np.sort(np.concatenate([low[None], rows.column("rest").to_numpy(zero_copy_only=False)[None], rate]), axis=0)
            names = pa.array([None, *(x.name for x in languages)], pa.string()).take(pa.array(order[0]))
            best = pc.if_else(pa.array(order[0] == 0), before, names)
            columns = {k: rows.column(k) for k in ("id", "held_out", "text") if with_text or k != "text"}
            yield pa.record_batch(columns | {"best": best, "low": pa.array(both[0]), "rest": pa.array(both[1]), "known": pa.array(size > 0)})

    return run


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of normalised() of each text, end to end, and their numbers; a text without a letter has none."""
    lowered = [t.lower() for t in texts]
    lengths = np.array([len(t) for t in lowered], np.int64)
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(texts)), lengths)
    letter = _letters(points)
    space = ~letter
    # runs of non-letters become one space; none at either end of a text
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    before = np.concatenate([[True], space[:-1]])[: len(points)]
    before[bounds[:-1][lengths > 0]] = True
    total = np.concatenate([[0], np.cumsum(letter)])[bounds]
    lone = space & ~before & ((np.cumsum(letter) < total[1:][row]) if len(row) else space)
    chosen = np.flatnonzero(letter | lone)
    values = points[chosen].copy()
    values[lone[chosen]] = 32
    return values, np.bincount(row[chosen], minlength=len(texts)).astype(np.int64)


def _letters(points: np.ndarray) -> np.ndarray:
    """Whether each code point is a letter, as str.isalpha says."""
    distinct, at = np.unique(points, return_inverse=True) if len(points) < 1 << 12 else _distinct(points)
    return np.array([chr(c).isalpha() if not 0xD800 <= c < 0xE000 else False for c in distinct.tolist()], bool)[at] if len(distinct) else np.zeros(0, bool)


def _distinct(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    there = np.zeros(int(points.max()) + 1, bool)
    there[points] = True
    distinct = np.flatnonzero(there)
    place = np.cumsum(there) - 1
    return distinct, place[points]


def sample(labelled: DataFrame) -> dict[str, str]:
    """Normalised text of distinct whole texts of each language of labelled (lang, text), those of the least hashes within the bounds."""
    spark = labelled.sparkSession
    rows = labelled.where("text IS NOT NULL").withColumns({"h": F.xxhash64("text"), "n": F.length("text")})
    short = rows.where(F.col("n") <= LONGEST)
    kinds = {r[0]: r[1] for r in short.groupBy("lang").agg(F.approx_count_distinct("h")).collect()}
    texts: dict[str, list[str]] = {}
    if kinds:
        # about twice the texts asked for, by a threshold on the hash, so that only these are sorted; it has one row a language of the block
        share = spark.createDataFrame([(k, int(min(1.0, 2 * SAMPLE_ROWS / n + 50 / n) * ((1 << 62) - 1))) for k, n in kinds.items()], "lang string, most long")
        few = short.join(F.broadcast(share), "lang").where(F.shiftrightunsigned("h", 2) <= F.col("most")).groupBy("lang", "h").agg(F.min("text").alias("text"))
        for lang, found in few.groupBy("lang").agg(F.slice(F.array_sort(F.collect_list(F.struct("h", "text"))), 1, SAMPLE_ROWS)).toLocalIterator():
            texts[lang] = [x.text for x in found]
    out = {}
    for lang, parts in texts.items():
        plain = [p for p in map(normalised, parts) if p]
        fits = max(1, int(np.searchsorted(np.cumsum([len(p) + 1 for p in plain]), SAMPLE_CHARS, "right"))) if plain else 0
        if fits:
            out[lang] = " ".join(plain[:fits])
    if lacking := [r[0] for r in rows.select("lang").distinct().collect() if r[0] not in out]:
        least = rows.where(F.col("lang").isin(lacking) & F.col("text").rlike(r"\p{L}")).groupBy("lang").agg(F.min(F.struct("n", "text")).alias("x"))
        out |= {r[0]: normalised(r[1].text) for r in least.toLocalIterator()}
    return {k: v for k, v in out.items() if v}


def identify(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Language of every row of docs: id, held_out, lang_pred, score, phrases_per_char.

    Automata are fitted on rows where ``held_out`` is false and lang is not null: distinct whole texts within
    SAMPLE_ROWS, SAMPLE_CHARS and LONGEST a language. Every labelled language that has a letter takes part;
    beyond BLOCK of them the texts are parsed block by block, stored between. ``score`` is the runner-up's
    phrases over the sum of its and the winner's (0.5: as many; 1: none for the winner). A null or empty text,
    or one without a letter, is ``und`` with score 0, as is all if nothing is labelled. Ties go to the language
    whose name sorts first. Rows of one id are judged each on its own text; only id, text and lang are read.
    """
    small_batches(docs.sparkSession)
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.coalesce(held_out, F.lit(True)).alias("held_out"), F.col(lang_col).cast("string").alias("lang"))
    labelled = base.where(~F.col("held_out") & F.col("lang").isNotNull()).select("lang", "text")
    names = sorted(r[0] for r in labelled.select("lang").distinct().collect())
    kind = docs.schema[id_col].dataType.simpleString()
    far = F.lit(float("inf"))
    found = base.select("id", "held_out", "text", F.lit(None).cast("string").alias("best"), far.alias("low"), far.alias("rest"), F.lit(False).alias("known"))
    for i in range(0, len(names), BLOCK):
        samples = sample(labelled if len(names) <= BLOCK else labelled.where(F.col("lang").isin(names[i : i + BLOCK])))
        more = i + BLOCK < len(names)
        languages = docs.sparkSession.sparkContext.broadcast([Language(k, v) for k, v in sorted(samples.items())])
        found = found.mapInArrow(_measure(languages, more), f"id {kind}, held_out boolean, {'text string, ' if more else ''}{_FOUND}")
        found = stored(found) if more else found
    known = F.col("known") & F.col("best").isNotNull()
    rest = F.when(F.col("rest") == far, 2 * F.col("low")).otherwise(F.col("rest"))
    return found.select(
        F.col("id").alias(id_col),
        "held_out",
        F.when(known, F.col("best")).otherwise("und").alias("lang_pred"),
        F.when(known, rest / (rest + F.col("low"))).otherwise(0.0).alias("score"),
        F.when(known, F.col("low")).otherwise(0.0).alias("phrases_per_char"),
    )
