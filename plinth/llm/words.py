"""Words, tokens and Arrow batches, for the operators that run Python."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame

from plinth.functions import batches as arrow_batches

#: Distinct words that a worker remembers at once; beyond that it starts anew.
REMEMBERED = 400_000
#: Bytes that a function sees of a batch at once.
SLICE_BYTES = 4 << 20


def texts_of(column: pa.Array) -> list[bytes | None]:
    """A text column's values as UTF-8, without decoding them."""
    return column.cast(pa.large_binary()).to_pylist()


def own_array(column: pa.Array) -> pa.Array:
    """A text column's values, null as empty, in buffers of their own: Arrow's text functions misread slices."""
    return pc.fill_null(column.take(pa.array(np.arange(len(column)))).cast(pa.large_string()), "")


def lower_ascii(raw: bytes) -> bytes:
    """A-Z lower-cased, all else as it is."""
    return raw.lower()


def split_words(raw: bytes | None) -> list[bytes]:
    r"""The runs of [^\x20\x09-\x0D]; bytes.split() parts at just these six."""
    return raw.split() if raw else []


def mixed(x: np.ndarray) -> np.ndarray:
    """A finaliser for 64-bit hashes; x is overwritten."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(raw: bytes | None, width: int = 5) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles of width lower-cased words.

    With fewer words the whole sequence is the one shingle; without words there is none.
    """
    words = split_words(lower_ascii(raw)) if raw else []
    if not words:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(width, len(words))
    out = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):  # a polynomial in the words' hashes
        out *= _STEP
        out += ids[i : len(words) - n + 1 + i]
    out = mixed(out)
    out.sort()
    return out[np.append(True, out[1:] != out[:-1])]


def arrow_stream(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow by batches of bounded bytes: the session's limit on them is lowered."""
    arrow_batches.bound(df.sparkSession)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def trimmed() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch
                del batch
                arrow_batches.give_back()

        yield from run(trimmed())
        arrow_batches.give_back()

    return df.mapInArrow(whole, schema)


def arrow_map(df: DataFrame, each: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """arrow_stream with a function of one batch; a batch holds few rows where texts are long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, min(batch.num_rows, batch.num_rows * SLICE_BYTES // max(batch.nbytes, 1)))
            for at in range(0, batch.num_rows, step):
                yield each(batch.slice(at, step))

    return arrow_stream(df, run, schema)
