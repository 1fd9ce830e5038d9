"""Best-fit-decreasing packing of token sequences, planned on the histogram of lengths.

Pieces of one length are alike, so best fit decreasing needs only how many pieces each
length has: at most as many numbers as the capacity, whatever the table holds. The
driver runs the whole algorithm on them. A segment tree over remaining capacities
gives the tightest open bin that takes a length in logarithmic time; bins that have
come about alike are one entry, and a run of equal pieces fills them at once. The
result is the same packing as piece by piece, as rules "of this length, pieces number
so to so go to bins from b on". Pieces are numbered within their length without
bringing a length together, and the rules tell each its sequence and offset.

Every rule either uses up a length or lowers a whole entry to under half its capacity,
so there are fewer than 4 * capacity * (log2(capacity) + 2) rules; the plan that is
broadcast is bounded by the capacity alone.

Defined results: a null text is an empty one, a document's tokens end with id 0, so
every document has a piece; only documents longer than the capacity are cut; repeated
rows are packed once for each row; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plinth.llm.store import count_off, materialise
from plinth.llm.words import REMEMBERED, arrow_map, arrow_stream, own_array

CAPACITY = 2048


class OpenBins:
    """A segment tree over remaining capacities: which of them have open bins."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.tree = bytearray(2 * self.size)

    def set(self, capacity: int, there: bool) -> None:
        at = self.size + capacity
        self.tree[at] = there
        while at > 1:
            at //= 2
            now = self.tree[2 * at] | self.tree[2 * at + 1]
            if self.tree[at] == now:
                break
            self.tree[at] = now

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of at least ``least`` that has an open bin."""
        at = self.size + least
        if self.tree[at]:
            return least
        while at > 1:
            if at % 2 == 0 and self.tree[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.tree[2 * at] else 2 * at + 1
                return at - self.size
            at //= 2
        return None


@dataclass(frozen=True)
class Rule:
    """Pieces first to first + pieces - 1 of a length go, each at a time, to bins from bin on, from offset on."""

    length: int
    first: int
    pieces: int
    each: int
    bin: int
    offset: int


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Rule], int]:
    """Best fit decreasing of so many pieces of each length; the rules and the number of bins."""
    if any(not 0 < n <= capacity for n in histogram):
        raise ValueError("lengths run from 1 to the capacity")
    rules: list[Rule] = []
    tree = OpenBins(capacity)
    alike: dict[int, list[tuple[int, int]]] = {}  # remaining capacity: (first bin, bins)
    bins = 0

    def put(left: int, first: int, n: int) -> None:
        if n and left:
            alike.setdefault(left, []).append((first, n))
            tree.set(left, True)

    for length in sorted(histogram, reverse=True):
        done, todo = 0, histogram[length]
        while todo:
            left = tree.tightest(length)
            if left is None:
                left, first = capacity, bins
                n = math.ceil(todo / (capacity // length))
                bins += n
            else:
                first, n = alike[left].pop()
                if not alike[left]:
                    tree.set(left, False)
            each = left // length  # what still fits after one piece is the tightest bin for the next
            pieces = min(todo, n * each)
            rules.append(Rule(length, done, pieces, each, first, capacity - left))
            full, over = divmod(pieces, each)
            put(left - each * length, first, full)
            put(left - over * length, first + full, int(over > 0))
            rest = full + (over > 0)
            put(left, first + rest, n - rest)
            done, todo = done + pieces, todo - pieces
    return rules, bins


class Pieces:
    """Token ids of texts, word by word, with the ids of words remembered.

    The tokenizer drops white space, at which no token crosses, and takes runs of
    letters and digits apart from marks behind them; so a text is its words, and a word
    its letters and the marks at its end. Arrow parts a batch's texts and numbers the
    distinct words; only words that nobody remembers are encoded, letters-only ones
    together as one text, and each text's ids are gathered by number.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.known: dict[bytes, int] = {}
        #: Ids of all remembered words end to end, and where each word's end.
        self.ids, self.stops = np.empty(0, "<u4"), np.zeros(1, np.int64)

    def _encoded(self, words: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _learn(self, words: list[bytes]) -> None:
        decoded = [w.decode(errors="replace") for w in words]
        found: list[np.ndarray | None] = [None] * len(words)
        plain = [i for i, w in enumerate(decoded) if w.isalpha()]
        for at in range(0, len(plain), 1000):
            some = plain[at : at + 1000]
            (ids,) = self._encoded([" ".join(decoded[i] for i in some)])
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(some):  # one end a word, so the words can be told apart
                for i, begin, end in zip(some, [0, *cuts[:-1].tolist()], cuts.tolist()):
                    found[i] = ids[begin:end]
        rest = [i for i, x in enumerate(found) if x is None]
        for i, ids in zip(rest, self._encoded([decoded[i] for i in rest])):
            found[i] = ids
        self._store(words, np.concatenate(found), np.array([len(x) for x in found], np.int64))

    def _store(self, words: list[bytes], ids: np.ndarray, lengths: np.ndarray) -> None:
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))
        self.stops = np.concatenate((self.stops, self.stops[-1] + np.cumsum(lengths)))
        self.ids = np.concatenate((self.ids, ids))

    def _gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of remembered words end to end, and how many each has."""
        starts = self.stops[numbers]
        lengths = self.stops[numbers + 1] - starts
        before = np.cumsum(lengths) - lengths
        return self.ids[np.repeat(starts - before, lengths) + np.arange(lengths.sum())], lengths

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        numbers = np.fromiter((self.known.get(w, -1) for w in words), np.int64, len(words))
        if len(self.known) >= REMEMBERED:  # only what this batch needs stays
            there = numbers >= 0
            ids, lengths = self._gather(numbers[there])
            self.known, self.ids, self.stops = {}, np.empty(0, "<u4"), np.zeros(1, np.int64)
            self._store([w for w, t in zip(words, there) if t], ids, lengths)
            numbers[there] = np.arange(len(lengths))
        new = np.flatnonzero(numbers < 0)
        if len(new):
            first = len(self.known)
            self._learn([words[i] for i in new])
            numbers[new] = np.arange(first, first + len(new))
        return numbers

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids end to end, each text's followed by id 0, and how many each text has with it."""
        texts = own_array(texts)
        # marks behind an ASCII letter or digit, or a small accented letter, never join with it
        parted = pc.replace_substring_regex(pc.ascii_lower(texts), pattern=r"([a-z0-9\x{DF}-\x{F6}\x{F8}-\x{FF}])([.,;:!?]+)([ \t\n\v\f\r]|$)", replacement=r"\1 \2\3")
        # a special token's case matters
        split = pc.ascii_split_whitespace(pc.if_else(pc.match_substring(texts, "<|"), texts, parted))
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.cast(pa.large_binary()).to_pylist()
        numbers = self._numbers(words)
        places = np.asarray(split.offsets) - split.offsets[0].as_py()
        in_order = numbers[np.asarray(coded.indices)]
        ids, lengths = self._gather(in_order)
        upto = np.concatenate((np.zeros(1, np.int64), np.cumsum(lengths)))[places]
        return np.insert(ids, upto[1:], 0), np.diff(upto) + 1


_loaded: dict[str, Pieces] = {}


def pieces_of(path: str) -> Pieces:
    if (known := _loaded.get(path)) is None:
        known = _loaded[path] = Pieces(path)
    return known


def tokenise(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row for each piece: id, piece, start, length, tokens (binary, little-endian unsigned 32-bit)."""
    kind = docs.schema[id_col].dataType

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, lengths = pieces_of(path).encode(batch.column(1))
        many = -(-lengths // capacity)
        at = np.repeat(np.arange(len(lengths)), many)
        piece = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
        start = piece * capacity
        length = np.minimum(lengths[at] - start, capacity)
        ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(length) * 4)).astype(np.int32)
        tokens = pa.BinaryArray.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(ids))])
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), tokens], names=["id", "piece", "start", "length", "tokens"])

    out = arrow_map(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), each, f"id {kind.simpleString()}, piece int, start long, length long, tokens binary")
    return out.withColumnRenamed("id", id_col)


def assign(pieces: DataFrame, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """pieces (materialised, with a column length) with sequence_id and offset."""
    counts = pieces.groupBy("length").count().collect()  # at most one row for each length up to the capacity
    hottest = max((r["count"] for r in counts), default=0)
    rules, _ = plan({r["length"]: r["count"] for r in counts}, capacity)
    table = np.array(sorted((r.length, r.first, r.each, r.bin, r.offset) for r in rules), np.int64).reshape(-1, 5)
    numbered = count_off(pieces, ["length"], order, "__p_number", hottest)
    shared = pieces.sparkSession.sparkContext.broadcast(table)
    names = pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, firsts, each, bins, offsets = shared.value.T
        step = hottest + 1  # length and number as one sortable number
        for batch in batches:
            length, number = (np.asarray(batch.column(n), np.int64) for n in ("length", "__p_number"))
            rule = np.searchsorted(lengths * step + firsts, length * step + number, "right") - 1
            far, within = np.divmod(number - firsts[rule], each[rule])
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(bins[rule] + far), pa.array(offsets[rule] + within * length)], names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return arrow_stream(numbered, place, f"{schema}, sequence_id long, offset long")


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """All documents' pieces with their tokens, sequence and place."""
    return assign(materialise(tokenise(docs, path, id_col, text_col, capacity)), [id_col, "piece", "start"], capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """One row for each sequence: sequence_id, length, tokens in order; a sequence is no longer than the capacity."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "tokens")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts")).select("sequence_id", "length", F.transform("parts", lambda p: p["tokens"]).alias("tokens"))
