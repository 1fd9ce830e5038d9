"""Token counts by a count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton enumerates the vocabulary's matches that end at each
character; dynamic programming carries the best score and the number of pieces on the
best path, and no path. Ties follow the unigram tokenizer's rule: starts are tried in
ascending order and only a greater score replaces the best, so of equal scores the
earliest start wins. A character that is no piece by itself may be unknown, at 10 below
the least score; unknown characters fall back to a piece for each of their bytes.

A space becomes the vocabulary's space mark and one more mark goes before the text.
Where no piece has a mark behind another character and all scores are whole numbers,
paths split at marks exactly, so words are counted once and remembered.

Defined results: a null or empty text has no tokens; texts are counted whole, very long
ones too; repeated rows get the same count; an empty table gives no rows; only the id and
the count are returned, so other columns' names cannot clash.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.llm.words import REMEMBERED, arrow_map

MARK = "▁"
PENALTY = 10.0
_WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model file, in order of their ids."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    return [(p.piece, p.score) for p in model.pieces]


class Counter(dict):
    """Numbers of pieces of words, remembered. unknown is the id of the unknown piece."""

    def __init__(self, vocab: list[tuple[str, float]], unknown: int = 0) -> None:
        super().__init__()
        self.unknown = vocab[unknown][0]
        self.cost = min(s for _, s in vocab) - PENALTY
        self.pieces = {}
        for piece, score in vocab:
            self.pieces[piece] = score
        self.bytes = all(f"<0x{b:02X}>" in self.pieces for b in range(256))
        self.automaton = ahocorasick.Automaton()
        for piece, score in self.pieces.items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.splits = all(float(s).is_integer() for s in self.pieces.values()) and not any(MARK in p.lstrip(MARK) for p in self.pieces)

    def __missing__(self, word: str) -> int:
        out = len(self.path(word)) if self.unknown in word else self.best(word)
        if len(word) <= 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = out
        return out

    def _ends(self, word: str) -> list[list[tuple[int, float]]]:
        """For each character, the matches that end there, the longest first."""
        ends: list[list[tuple[int, float]]] = [[] for _ in word]
        for end, match in self.automaton.iter(word):
            ends[end].append(match)
        return ends

    def _size(self, char: str) -> int:
        return len(char.encode()) if self.bytes else 1

    def best(self, word: str) -> int:
        """The number of pieces on the best path of a word without the unknown piece's own string."""
        scores, counts, joins = [0.0], [0], [False]
        for at, found in enumerate(self._ends(word)):
            top, count, single, alone = None, 0, False, False
            for length, score in found:
                start = at + 1 - length
                if top is None or scores[start] + score > top:
                    top, count = scores[start] + score, counts[start] + 1
                single |= length == 1
            if not single and (top is None or scores[at] + self.cost > top):
                # without bytes to fall back to, unknown characters in a row are one piece
                top, alone = scores[at] + self.cost, True
                count = counts[at] + (self._size(word[at]) if self.bytes else int(not joins[at]))
            scores.append(top)
            counts.append(count)
            joins.append(alone)
        return counts[-1]

    def path(self, word: str) -> list[str]:
        """The pieces themselves; for words that hold the unknown piece's string, and for tests."""
        scores, back = [0.0], [0]
        for at, found in enumerate(self._ends(word)):
            top, begin, single = None, 0, False
            for length, score in found:
                start = at + 1 - length
                if top is None or scores[start] + score > top:
                    top, begin = scores[start] + score, start
                single |= length == 1
            if not single and (top is None or scores[at] + self.cost > top):
                top, begin = scores[at] + self.cost, at
            scores.append(top)
            back.append(begin)
        cuts, at = [], len(word)
        while at:
            cuts.append(word[back[at] : at])
            at = back[at]
        out: list[str] = []
        run = ""
        for piece in [*cuts[::-1], None]:
            if piece is not None and (piece == self.unknown or piece not in self.pieces):
                run += piece
                continue
            if run:  # unknown pieces in a row are one string
                out += [run] if run in self.pieces or not self.bytes else [f"<0x{b:02X}>" for b in run.encode()]
                run = ""
            if piece is not None:
                out.append(piece)
        return out

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        marked = MARK + text.replace(" ", MARK)
        return sum(map(self.__getitem__, _WORDS.findall(marked))) if self.splits else self[marked]


_loaded: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if (found := _loaded.get(path)) is None:
        found = _loaded[path] = Counter(vocabulary(path))
    return found


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", out: str = "n_tokens") -> DataFrame:
    """One row for each document: id and its number of tokens."""
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = counter(path)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([own.count(t) for t in batch.column(1).to_pylist()], pa.int64())], names=["id", "n"])

    return arrow_map(picked, each, f"id {kind}, n long").select(F.col("id").alias(id_col), F.col("n").alias(out))
