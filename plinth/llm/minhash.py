"""MinHash near-dedup with tensored banding.

Two small collections of bands are computed for each set of shingles, so many tables of
WIDTH minhashes each. A table's key is a pair of a band of the first and a band of the
second collection, so 2 * tables * WIDTH minhashes serve tables ** 2 tables of
2 * WIDTH minhashes. Sets of similarity s meet in no table with a probability below
2 * (1 - s ** WIDTH) ** tables: 3e-5 at the least similarity that links. For 0.80 these are
16 tables, for 0.85, 12 (7e-8 at 0.9). A byte of each minhash makes a sketch; sets of the
least similarity agree in fewer of these than SHAPES says with a probability below 1e-6.
Pairs that pass are verified on their full sets.

Texts with equal sets are one node from the start, however many there are. Bands that
a node shares with no other make no keys, so most documents leave after one shuffle
of their bands.

Defined results: A-Z are lower-cased; words are the runs of other than the six ASCII
white-space characters; a text of fewer words than a shingle has is one shingle; a null
or wordless text has no set, is linked with nothing and is its own component; rows that
share an id and a text are copies, those that share an id alone are rows of their own;
rows with a null id are compared like others, and a component's least id ignores nulls;
very long texts are read whole; of documents that tie for the one to keep, the least
hash of the text decides, and of equal rows one stays; an empty table gives no rows.
near_copies returns its own columns only, keep_one all of the input's under their names,
whatever these are. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.llm.linking import broadcast_if_small, link
from plinth.llm.store import join_small, materialise, release, same, scoped
from plinth.llm.words import arrow_map, mixed, shingle_set, texts_of

WIDTH, SHINGLE = 3, 5
#: Least similarity, in percent, of linked sets, where none is given.
PERCENT = 80
#: For each least similarity: tables, and bytes of two sketches, of 2 * tables * WIDTH, that agree at least if the sets may be linked.
SHAPES = {80: (16, 56), 85: (12, 44)}
TABLES, LEAST_ALIKE = SHAPES[PERCENT]


@cache
def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    seeds = mixed(np.arange(1, 3 * n + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    times, plus, again = (seeds >> np.uint64(32)).astype(np.uint32).reshape(3, n, 1)
    return times | np.uint32(1), plus, again | np.uint32(1)


_ONCE = 4096


def minhashes(shingles: np.ndarray, tables: int = TABLES) -> np.ndarray:
    """The least 32-bit hash of the set under each of the 2 * tables * WIDTH functions."""
    times, plus, again = _multipliers(2 * tables * WIDTH)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(times), np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(short), _ONCE):
        x = short[at : at + _ONCE] * times
        x += plus
        x ^= x >> np.uint32(15)
        x *= again
        np.minimum(out, x.min(axis=1), out=out)
    return out


def bands(mins: np.ndarray) -> np.ndarray:
    """A hash for each band of both collections, as signed 64-bit."""
    of_band = mins.astype(np.uint64).reshape(-1, WIDTH)
    out = np.arange(1, len(of_band) + 1, dtype=np.uint64)
    for i in range(WIDTH):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + of_band[:, i])
    return out.view(np.int64)


def sketch(mins: np.ndarray) -> bytes:
    return (mins >> np.uint32(24)).astype(np.uint8).tobytes()


def alike(first: list[bytes], second: list[bytes], least: int = LEAST_ALIKE) -> np.ndarray:
    """Which pairs of sketches may belong to linked sets."""
    a, b = (np.frombuffer(b"".join(x), np.uint8).reshape(len(x), -1) for x in (first, second))
    return (a == b).sum(axis=1) >= least


def alike_among(sketches: list[bytes], least: int = LEAST_ALIKE) -> Callable[[int], np.ndarray]:
    x = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), -1)
    return lambda i: (x == x[i]).sum(axis=1) >= least


def signed(docs: DataFrame, id_col: str, text_col: str, tables: int = TABLES) -> DataFrame:
    """id, text_hash, n_shingles, digest (of the set), bands and sketch, all three null if it is empty."""
    picked = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, digests, signs, shorts = [], [], [], []
        for raw in texts_of(batch.column(2)):
            shingles = shingle_set(raw, SHINGLE)
            counts.append(len(shingles))
            mins = minhashes(shingles, tables) if len(shingles) else None
            digests.append(None if mins is None else xxhash.xxh3_128_digest(shingles.tobytes()))
            signs.append(None if mins is None else bands(mins))
            shorts.append(None if mins is None else sketch(mins))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(signs, pa.list_(pa.int64())), pa.array(shorts, pa.binary())],
            names=["id", "text_hash", "n_shingles", "digest", "bands", "sketch"],
        )

    return arrow_map(picked, each, f"id {kind}, text_hash long, n_shingles long, digest binary, bands array<long>, sketch binary")


def keys_of(classes: DataFrame, tables: int = TABLES) -> DataFrame:
    """(key, node): a key for each pair of a band of the one and one of the other collection.

    A node's bands that no other node has are left out before pairing.
    """
    single = classes.select("node", F.posexplode("bands").alias("slot", "band")).select("node", "slot", F.xxhash64("slot", "band").alias("h"))
    shared = single.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    live = single.join(shared, "h", "left_semi")
    of = live.groupBy("node").agg(F.collect_list(F.struct("slot", "h")).alias("all"))  # 2 * tables at most
    first = F.filter("all", lambda x: x["slot"] < tables)
    second = F.filter("all", lambda x: x["slot"] >= tables)
    pairs = F.flatten(F.transform(first, lambda x: F.transform(second, lambda y: F.xxhash64(x["h"], y["h"]))))
    return of.select(F.explode(pairs).alias("key"), "node")


def linked(first: list[bytes], second: list[bytes], percent: int = PERCENT) -> np.ndarray:
    """Which pairs of sets, sorted hashes as bytes, have that similarity."""
    out = np.zeros(len(first), bool)
    for i, (one, other) in enumerate(zip(first, second)):
        small, large = sorted((len(one), len(other)))
        if 100 * small < percent * large:
            continue
        both = np.concatenate((np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64)))
        both.sort(kind="stable")  # two sorted runs are merged
        common = np.count_nonzero(both[1:] == both[:-1])
        out[i] = 100 * common >= percent * (len(both) - common)
    return out


def among(sets: list[bytes], percent: int = PERCENT) -> Callable[[int], np.ndarray]:
    """For a block of sets: which of them each is linked with, by one lookup of all that hold its shingles."""
    sizes = np.array([len(s) // 8 for s in sets])
    ends = np.cumsum(sizes)
    _, shingle, holders = np.unique(np.frombuffer(b"".join(sets), np.uint64), return_inverse=True, return_counts=True)
    by_shingle = np.repeat(np.arange(len(sets)), sizes)[np.argsort(shingle, kind="stable")]
    begins = np.cumsum(holders) - holders

    def row(i: int) -> np.ndarray:
        own = shingle[ends[i] - sizes[i] : ends[i]]
        n = holders[own]
        places = np.arange(n.sum()) + np.repeat(begins[own] - (np.cumsum(n) - n), n)
        common = np.bincount(by_shingle[places], minlength=len(sets))
        return 100 * common >= percent * (sizes[i] + sizes - common)

    return row


def compared(docs: DataFrame, id_col: str, text_col: str, percent: int) -> tuple[DataFrame, DataFrame]:
    """signed() of docs, and (digest, component, component_id) of all sets. percent is one of SHAPES."""
    if percent not in SHAPES:
        raise ValueError(f"no tables are set for a least similarity of {percent} percent")
    tables, least_alike = SHAPES[percent]
    rows = materialise(signed(docs, id_col, text_col, tables))
    classes = materialise(
        rows.filter("n_shingles > 0")
        .groupBy("digest")
        .agg(F.min("id").alias("least"), F.min_by(F.struct("id", "text_hash"), F.struct("id", "text_hash")).alias("of"), F.min("bands").alias("bands"), F.min("sketch").alias("sketch"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    keys = materialise(keys_of(classes, tables))

    def sets(nodes: DataFrame) -> DataFrame:
        wanted = classes.join(nodes, "node").select("node", "digest", F.col("of.id").alias("id"), F.col("of.text_hash").alias("text_hash"))
        texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
        found = texts.alias("t").join(broadcast_if_small(wanted).alias("w"), same("t", "w", ["id", "text_hash"])).select("w.node", "t.text", "w.digest")

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = [shingle_set(raw, SHINGLE).tobytes() for raw in texts_of(batch.column(1))]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["node", "payload"])

        # repeated rows come several times with one and the same text
        return arrow_map(found, each, "node long, payload binary").groupBy("node").agg(F.first("payload").alias("payload"))

    short = partial(alike, least=least_alike), partial(alike_among, least=least_alike)
    full = partial(linked, percent=percent), partial(among, percent=percent)
    found = link(keys, classes.select("node", F.col("sketch").alias("payload")), sets, short, full)
    release(keys)
    named = classes.select("node", "digest", "least").join(found, "node", "left").select("digest", "least", F.coalesce("component", "node").alias("component"))
    named = materialise(named)
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return rows, named.join(least, "component").select("digest", "component", "component_id")


@scoped
def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row for each document: id, text_hash, n_shingles, component_id (least id reachable), kept."""
    rows, table = compared(docs, id_col, text_col, percent)
    # rows without a set would all meet in one task
    out = rows.filter("digest is not null").join(table.select("digest", "component_id"), "digest", "left").unionByName(rows.filter("digest is null"), allowMissingColumns=True)
    component = F.coalesce("component_id", "id")
    kept = F.when(component.isNull(), True).otherwise(F.col("id").eqNullSafe(component))
    return out.select(F.col("id").alias(id_col), "text_hash", "n_shingles", component.alias("component_id"), kept.alias("kept"))


@scoped
def _verdicts(docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """__p_id, __p_hash and __p_once of documents that don't simply stay: false if none of these rows stays, true if one of them does."""
    rows, table = compared(docs, id_col, text_col, percent)
    with_set = rows.filter("digest is not null").select("id", "text_hash", "digest").join(table.select("digest", "component"), "digest", "left")
    of = with_set.select("component", "id", "text_hash").unionByName(rows.filter("digest is null").select(F.lit(None).cast("long").alias("component"), "id", "text_hash"))
    counted = materialise(of.groupBy("component", "id", "text_hash").agg(F.count(F.lit(1)).alias("n")))
    lone = counted.filter("component is null and n > 1").select("id", "text_hash", F.lit(True).alias("once"))
    linked_ = counted.filter("component is not null")
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "text_hash")).alias("v")
    groups = linked_.groupBy("component").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("rows"), first).filter("rows > 1")
    chosen = groups.select("v.id", "v.text_hash", F.lit(True).alias("chosen"))
    # a group's members and whether each is the one that stays
    members = linked_.join(groups.select("component"), "component", "left_semi").select("id", "text_hash", "n")
    told = members.alias("m").join(chosen.alias("c"), same("m", "c", ["id", "text_hash"]), "left").select("m.id", "m.text_hash", "m.n", F.col("c.chosen").isNotNull().alias("once"))
    return told.filter("not once or n > 1").select("id", "text_hash", "once").unionByName(lone).toDF("__p_id", "__p_hash", "__p_once")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One document of each group: the one with the least id, nulls last, then the least hash of its text; once even if its row is repeated.

    Only keys of documents that go, or come repeated, are joined to the texts: broadcast
    while they are few, else by a shuffle whose keys are salted.
    """
    special = _verdicts(docs, id_col, text_col, percent)
    own = docs.toDF(*(f"__p_c{i}" for i in range(len(docs.columns))))
    at, text = (f"__p_c{docs.columns.index(c)}" for c in (id_col, text_col))
    marked = own.withColumns({"__p_id": F.col(at), "__p_hash": F.xxhash64(F.col(text).cast("string"))})
    told = join_small(marked, special, ["__p_id", "__p_hash"], F.monotonically_increasing_id(), "left")
    out = told.filter("__p_once is null").select(*own.columns)
    if special.filter("__p_once").limit(1).count():
        out = out.unionByName(told.filter("__p_once").dropDuplicates(["__p_id", "__p_hash"]).select(*own.columns))
    return out.toDF(*docs.columns)
