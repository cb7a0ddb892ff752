"""Token counts of a unigram vocabulary by dynamic programming over a trie of pre-tokens.

The distinct pre-tokens of a slice of text form a trie. Each node is a prefix; its
forward score is the best over all pieces that end there, of the score at the piece's
start plus the piece's own. A prefix that many pre-tokens share is scored once. The
tokens on the best path to a node where a pre-token ends are that pre-token's count.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm import words as W
from lectern.llm.tables import small_batches

#: Vocabulary file of a public tokenizer; only its pieces and their order are read.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁".encode()
#: Bytes of a pre-token in the trie; a longer one is scored alone, in blocks of BLOCK bytes.
LONGEST, BLOCK = 256, 1 << 16
#: Distinct pre-tokens whose counts a task remembers from slice to slice.
REMEMBERED = 500_000

_STEP = np.uint64(0x9E3779B97F4A7C15)


def pieces(path: str = VOCABULARY) -> dict[bytes, float]:
    """Pieces and their log probabilities: Zipf's law on their order. Control and byte pieces, and those with inner spaces, are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out = {}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or "▁" in piece[1:]):
            out[piece.encode()] = -math.log(len(out) + 10.0)
    return out


class Table:
    """Pieces by length: sorted hashes and scores. A byte that no piece covers is a token of its own."""

    def __init__(self, scores: dict[bytes, float]):
        by: dict[int, list[tuple[int, float]]] = {}
        for piece, score in scores.items():
            h = 0
            for b in piece:
                h = (h * int(_STEP) + b + 1) & 0xFFFFFFFFFFFFFFFF
            by.setdefault(len(piece), []).append((h, score))
        self.lengths = {}
        for n, rows in by.items():
            rows.sort()
            self.lengths[n] = (np.array([h for h, _ in rows], np.uint64), np.array([s for _, s in rows]))
        self.other = min(scores.values(), default=0.0) - 10.0
        self.shift = W.powers(int(_STEP), max(by, default=0) + 1)

    def counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of each of the given distinct byte strings, by one trie over all but the long ones."""
        out = np.zeros(len(starts), np.int64)
        long = ends - starts > LONGEST
        for i in np.flatnonzero(long).tolist():
            out[i] = self.long_count(data[starts[i] : ends[i]])
        out[~long] = self.trie_counts(data, starts[~long], ends[~long])
        return out

    def long_count(self, data: np.ndarray) -> int:
        """Tokens of one byte string of any length: pieces are found block by block, and the scores of the last ``reach`` bytes carried over."""
        reach = max(self.lengths, default=1)
        score, token = [0.0], [0]
        for low in range(0, len(data), BLOCK):
            high, back = min(low + BLOCK, len(data)), max(0, low - reach)
            piece = np.zeros(high - back, np.uint64)  # of n bytes from each start on
            found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
            for n in range(1, min(reach, high - back) + 1):
                many = high - back - n + 1
                piece = piece[:many] * _STEP + data[back + n - 1 : back + n - 1 + many] + np.uint64(1)
                if n not in self.lengths:
                    continue
                known, value = self.lengths[n]
                at = np.minimum(np.searchsorted(known, piece), len(known) - 1)
                hit = np.flatnonzero((known[at] == piece) & (np.arange(many) + back + n > low))
                found.append((hit + back + n, np.full(len(hit), n), value[at[hit]]))
            end, size, value = map(np.concatenate, zip(*found, strict=True))
            order = np.lexsort((size, end))
            first = np.searchsorted(end[order], np.arange(low + 1, high + 2)).tolist()
            size, value = size[order].tolist(), value[order].tolist()
            for a, z in zip(first[:-1], first[1:], strict=True):
                best, count = score[-1] + self.other, token[-1] + 1
                for k in range(a, z):
                    # of equal scores the longer piece counts
                    if score[-size[k]] + value[k] >= best:
                        best, count = score[-size[k]] + value[k], token[-size[k]] + 1
                score.append(best)
                token.append(count)
            del score[: -reach - 1], token[: -reach - 1]
        return token[-1]

    def trie_counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of each of the given distinct byte strings, by one trie over all of them."""
        size = ends - starts
        out = np.zeros(len(size), np.int64)
        order = np.argsort(-size, kind="stable")
        node_of = [np.zeros(len(size), np.int64)]  # the node of each string at each depth, strings in falling length
        hashes, scores, tokens = [np.zeros(1, np.uint64)], [np.zeros(1)], [np.zeros(1, np.int64)]
        size, starts = size[order], starts[order]
        word_hash = np.zeros(len(size), np.uint64)
        reach = max(self.lengths, default=1)
        for depth in range(1, int(size[0]) + 1 if len(size) else 1):
            live = int(np.searchsorted(-size, -depth, "right"))
            word_hash = word_hash[:live] * _STEP + data[starts[:live] + depth - 1] + np.uint64(1)
            node_hash, example, node = np.unique(word_hash, return_index=True, return_inverse=True)
            node_of.append(node)
            above = node_of[depth - 1][example]
            score, token = scores[-1][above] + self.other, tokens[-1][above] + 1
            for n in range(1, min(depth, reach) + 1):
                if n not in self.lengths:
                    continue
                known, value = self.lengths[n]
                start = node_of[depth - n][example]
                piece = node_hash - hashes[-n][start] * self.shift[n]
                at = np.minimum(np.searchsorted(known, piece), len(known) - 1)
                # of equal scores the longer piece counts
                better = np.flatnonzero((known[at] == piece) & (scores[-n][start] + value[at] >= score))
                score[better] = scores[-n][start[better]] + value[at[better]]
                token[better] = tokens[-n][start[better]] + 1
            hashes.append(node_hash)
            scores.append(score)
            tokens.append(token)
            if len(hashes) > reach:
                hashes.pop(0), scores.pop(0), tokens.pop(0)
                node_of[depth - reach] = None
            done = int(np.searchsorted(-size, -depth, "left"))
            out[order[done:live]] = token[node[done:live]]
        return out


def _count(scores):
    def run(batches):
        table = Table(scores.value)
        held, tokens = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for rows, data, bounds in W.texts(batches):
            words = W.split(data, bounds, W.not_space())
            starts, ends = words.starts, words.ends
            keys = W.mixed(W.span_hashes(data, starts, ends))
            distinct, example, at = np.unique(keys, return_index=True, return_inverse=True)
            place = np.minimum(np.searchsorted(held, distinct), max(0, len(held) - 1))
            new = np.flatnonzero(held[place] != distinct) if len(held) else np.arange(len(distinct))
            count = np.zeros(len(distinct), np.int64)
            if len(held):
                count = tokens[place]
            if len(new):
                head = len(MARK)
                span = ends[example[new]] - starts[example[new]]
                begin = np.cumsum(head + span) - (head + span)
                joined = np.empty(int((head + span).sum()), np.uint8)
                index, _ = W.runs(starts[example[new]], ends[example[new]])
                target, _ = W.runs(begin + head, begin + head + span)
                joined[target] = data[index]
                for i, b in enumerate(MARK):
                    joined[begin + i] = b
                count[new] = table.counts(joined, begin, begin + head + span)
                if len(held) + len(new) > REMEMBERED:
                    held, tokens = np.zeros(0, np.uint64), np.zeros(0, np.int64)
                merged = np.concatenate([held, distinct[new]])
                order = np.argsort(merged)
                held, tokens = merged[order], np.concatenate([tokens, count[new]])[order]
            total = np.bincount(words.row_of(), weights=count[at], minlength=len(rows)).astype(np.int64)
            yield pa.record_batch({"id": rows.column("id"), "n_words": pa.array(np.diff(words.first)), "n_tokens": pa.array(total)})

    return run


def count(docs: DataFrame, scores: dict[bytes, float] | None = None, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """For each row of docs: id, n_words and n_tokens under the vocabulary ``scores`` (default: the pieces of the file ``vocabulary``).

    Pre-tokens are the text's words ``[^\\x20\\x09-\\x0D]+``, each with the mark of a space before it,
    whatever its length. Segmentations have the highest total score; of equal ones, the one whose last
    piece is longer. A null or empty text has 0 tokens. Rows of one id, and rows without one, are counted each on their
    own. Other columns are not read. An empty table gives an empty one.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    table = docs.sparkSession.sparkContext.broadcast(pieces(vocabulary) if scores is None else scores)
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(_count(table), f"id {kind}, n_words long, n_tokens long").withColumnRenamed("id", id_col)
