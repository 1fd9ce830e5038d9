"""Embedding near-dedup by Euclidean p-stable hashing.

Normalised vectors are projected on random Gaussian directions, shifted, and cut into
cells of WIDTH; WIDER of them together are a table's bucket. Vectors that share a
bucket in some table are candidates, and an exact cosine in double precision decides.
How many directions a bucket has grows with the logarithm of the number of vectors, so
that chance meetings stay rare, and the number of tables follows from the recall
asked for at the least cosine; above it recall only rises.

Candidates are first compared by short sketches, the signs of other random projections.
Equal vectors are one node. Links between nodes of one component are counted at the
end, block against block within the component, so that each is counted once.

Defined results: a vector that is null, empty, zero or holds a null or non-finite
component is linked with nothing and is its own component; vectors of different
dimensions are never linked; very long vectors are read whole; repeated rows are vectors
of their own; rows that tie for the least id are all kept; a component's least id ignores
null ids; an empty table gives no rows; other columns of the input are not read, so their
names cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.llm.linking import link
from plinth.llm.store import materialise, release, scoped
from plinth.llm.words import arrow_stream

LEAST_COSINE = 0.9
WIDTH = 2.0
#: Chance meetings that a vector may expect in a table, and misses allowed at LEAST_COSINE.
BY_CHANCE, MISSED = 0.5, 0.005
#: Signs of projections in a sketch. Vectors at LEAST_COSINE differ in MOST_DIFFERENT of them or fewer but for one in a million; unrelated ones in half.
SIGNS, MOST_DIFFERENT = 256, 65
BLOCK = 512
_SEED = 20_231


def meeting(distance: float, width: float = WIDTH) -> float:
    """The probability that two points at this distance share a cell of one direction."""
    r = width / distance
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def shape(vectors: int, least: float = LEAST_COSINE) -> tuple[int, int]:
    """Directions of a bucket, and tables."""
    near, far = meeting(math.sqrt(2 - 2 * least)), meeting(math.sqrt(2))
    k = max(4, round(math.log(max(vectors, 2) / BY_CHANCE) / -math.log(far)))
    return k, math.ceil(math.log(1 / MISSED) / near**k)


def unit(rows: list[bytes]) -> np.ndarray:
    """Payloads of one dimension as normalised rows."""
    x = np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that no square overflows or vanishes
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosines_reach(a: np.ndarray, b: np.ndarray, least: float = LEAST_COSINE) -> np.ndarray:
    """For all rows of a and b whether their cosine is least or more, at the bound by the one sum that decides everywhere here."""
    product = a @ b.T
    out = product >= least
    for i, j in zip(*np.nonzero(np.abs(product - least) < 1e-9)):
        out[i, j] = (a[i] * b[j]).sum() >= least
    return out


def linked(first: list[bytes], second: list[bytes], least: float = LEAST_COSINE) -> np.ndarray:
    out = np.zeros(len(first), bool)
    at = [i for i, (a, b) in enumerate(zip(first, second)) if len(a) == len(b)]
    for size in {len(first[i]) for i in at}:
        own = [i for i in at if len(first[i]) == size]
        for s in range(0, len(own), 4096):
            some = own[s : s + 4096]
            out[some] = (unit([first[i] for i in some]) * unit([second[i] for i in some])).sum(axis=1) >= least
    return out


def among(rows: list[bytes], least: float = LEAST_COSINE) -> Callable[[int], np.ndarray]:
    """For a block of payloads: which of them each is linked with."""
    sizes = np.array([len(r) for r in rows])
    at = {int(s): np.flatnonzero(sizes == s) for s in np.unique(sizes)}
    units = {s: unit([rows[i] for i in own]) for s, own in at.items()}
    place = {int(i): (s, k) for s, own in at.items() for k, i in enumerate(own)}

    def row(i: int) -> np.ndarray:
        size, k = place[i]
        out = np.zeros(len(rows), bool)
        out[at[size]] = (units[size] * units[size][k]).sum(axis=1) >= least
        return out

    return row


def alike(first: list[bytes], second: list[bytes]) -> np.ndarray:
    """Which pairs of sketches may belong to linked vectors."""
    a, b = (np.frombuffer(b"".join(x), np.uint64).reshape(len(x), -1) for x in (first, second))
    return np.bitwise_count(a ^ b).sum(axis=1) <= MOST_DIFFERENT


def alike_among(sketches: list[bytes]) -> Callable[[int], np.ndarray]:
    x = np.frombuffer(b"".join(sketches), np.uint64).reshape(len(sketches), -1)
    return lambda i: np.bitwise_count(x ^ x[i]).sum(axis=1) <= MOST_DIFFERENT


def signs(rows: np.ndarray) -> np.ndarray:
    """The sketch of each normalised row: the signs of its projections, as bytes."""
    directions = np.random.default_rng((_SEED, rows.shape[1], 1)).standard_normal((rows.shape[1], SIGNS))
    return np.packbits(rows @ directions > 0, axis=1)


def payloads(vectors: DataFrame, id_col: str, column: str) -> DataFrame:
    """id, digest, payload (doubles) and sketch of each vector; null but for the id if it can't be linked."""
    picked = vectors.select(F.col(id_col).alias("id"), F.col(column).cast("array<double>").alias("v"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[bytes | None] = []
            for v in batch.column(1):
                x = v.values.to_numpy(zero_copy_only=False) if v.is_valid and len(v) and not v.values.null_count else None
                good = x is not None and np.isfinite(x).all() and np.any(x)
                out.append(np.ascontiguousarray(x + 0.0, np.float64).tobytes() if good else None)
            digests = [None if p is None else xxhash.xxh3_128_digest(p) for p in out]
            sketches: list[bytes | None] = [None] * len(out)
            for size in {len(p) for p in out if p is not None}:
                at = [i for i, p in enumerate(out) if p is not None and len(p) == size]
                for i, row in zip(at, signs(unit([out[i] for i in at]))):
                    sketches[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), pa.array(out, pa.binary()), pa.array(sketches, pa.binary())], names=["id", "digest", "payload", "sketch"])

    kind = vectors.schema[id_col].dataType.simpleString()
    return arrow_stream(picked, each, f"id {kind}, digest binary, payload binary, sketch binary")


def keys_of(classes: DataFrame, k: int, tables: int) -> DataFrame:
    """(key, node): each node's bucket in each table."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        odd = np.random.default_rng(_SEED).integers(1, 1 << 63, (tables, k), np.int64).view(np.uint64) | np.uint64(1)
        names = np.arange(1, tables + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for batch in batches:
            nodes, rows = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for size in {len(r) for r in rows}:
                at = [i for i, r in enumerate(rows) if len(r) == size]
                if size not in drawn:
                    rng = np.random.default_rng((_SEED, size))
                    drawn[size] = rng.standard_normal((size // 8, tables * k)), rng.uniform(0, WIDTH, tables * k)
                directions, shift = drawn[size]
                for s in range(0, len(at), 256):
                    some = at[s : s + 256]
                    cells = np.floor((unit([rows[i] for i in some]) @ directions + shift) / WIDTH).astype(np.int64)
                    parts = cells.view(np.uint64).reshape(len(some), tables, k) * odd
                    key = parts.sum(axis=2, dtype=np.uint64)
                    key ^= key >> np.uint64(29)
                    key = (key + names) * np.uint64(0xBF58476D1CE4E5B9)
                    key ^= key >> np.uint64(32)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64).ravel()), pa.array(np.repeat(nodes[some], tables))], names=["key", "node"])

    return arrow_stream(classes.select("node", "payload"), each, "key long, node long")


def _counted(members: DataFrame) -> DataFrame:
    """(node, n) of links to vectors of other nodes. members: component, node, copies, payload; of components of several nodes."""
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    many = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), many).cast("int")
    rows = members.join(sizes, "component").select("component", "node", "copies", "payload", own.alias("own"), F.explode(F.sequence(F.lit(0), many - 1)).alias("other"))
    rows = rows.select("component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "copies", "payload")
    dealt = rows.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "own", "node")

    def count(group: list[tuple]) -> pa.RecordBatch:
        """Rows: component, i, j, own, node, copies, payload."""
        i, j = group[0][1:3]
        a, b = [r for r in group if r[3] == i], [r for r in group if r[3] == j]
        total: dict[int, int] = {}
        for size in {len(r[6]) for r in a} & {len(r[6]) for r in b}:
            x, y = [r for r in a if len(r[6]) == size], [r for r in b if len(r[6]) == size]
            hit = cosines_reach(unit([r[6] for r in x]), unit([r[6] for r in y]))
            if i == j:
                np.fill_diagonal(hit, False)
            for own, n in zip(x, hit @ np.array([r[5] for r in y], np.int64)):
                total[own[4]] = total.get(own[4], 0) + int(n)
            if i != j:
                for own, n in zip(y, np.array([r[5] for r in x], np.int64) @ hit):
                    total[own[4]] = total.get(own[4], 0) + int(n)
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["node", "n"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if group and group[0][:3] != row[:3]:
                    yield count(group)
                    group = []
                group.append(row)
        if group:
            yield count(group)

    return arrow_stream(dealt, each, "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))


@scoped
def near_vectors(vectors: DataFrame, id_col: str = "vec_id", column: str = "embedding") -> DataFrame:
    """One row for each vector: id, n_links, component_id (least id reachable), kept."""
    rows = materialise(payloads(vectors, id_col, column))
    classes = materialise(
        rows.filter("digest is not null")
        .groupBy("digest")
        .agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"), F.min("payload").alias("payload"), F.min("sketch").alias("sketch"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    k, tables = shape(classes.count())
    keys = materialise(keys_of(classes, k, tables))
    own = classes.select("node", "payload")
    found = link(keys, classes.select("node", F.col("sketch").alias("payload")), lambda nodes: own.join(nodes, "node"), (alike, alike_among), (linked, among))
    release(keys)
    named = classes.select("node", "digest", "least", "copies", "payload").join(found, "node", "left")
    members = materialise(named.filter("component is not null").select("component", "node", "copies", "payload"))
    links = _counted(members)
    least = classes.select("node", "least").join(found, "node").groupBy("component").agg(F.min("least").alias("reached"))
    table = (
        named.select("node", "digest", "least", "copies", "component")
        .join(links, "node", "left")
        .join(least, "component", "left")
        .select("digest", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("reached", "least").alias("reached"))
    )
    known = rows.filter("digest is not null").select("id", "digest").join(materialise(table), "digest", "left")
    # vectors that can't be linked would all meet in one task
    out = known.unionByName(rows.filter("digest is null").select("id", "digest"), allowMissingColumns=True)
    component = F.coalesce("reached", "id")
    kept = F.when(component.isNull(), True).otherwise(F.col("id").eqNullSafe(component))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), kept.alias("kept"))
