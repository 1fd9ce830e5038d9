"""Mixing sources to target weights by hash-threshold histograms.

Every document has a hash that depends on its id and text alone. A source whose
target is e + f times its size takes each document e times, and once more those
whose hash lies below a threshold. The threshold comes from sums of sizes by source
and hash bucket: the bucket in which the running sum passes the budget is refined by
the next bits of the hash, all others are settled. Nothing is sorted, and what is
gathered is one row for each source and bucket.

Defined results: a null text or one without words has size 0 and is taken with its
hash like any other; a null source is a source of its own, the last; rows that agree
in id and text are taken together, and so are those whose hashes tie; very long texts are
read whole; an empty table gives an empty mix; input columns named like an output column
are replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plinth.llm.store import is_small, join_small, keep_names, materialise, release

WORD = r"[^\x20\x09-\x0D]+"
#: Bits of the hash, and bits that each refinement settles.
HASH_BITS, STEP_BITS = 60, 12
#: Partitions among which sources are ranked.
RANK_PARTITIONS = 32


def size_of(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def hash_of(id_col: str, text: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.col(text)), 64 - HASH_BITS)


def rank_sources(sources: DataFrame) -> DataFrame:
    """Sources numbered from 0 by code point, null last, in a new column rank."""
    n = RANK_PARTITIONS
    ranged = sources.repartitionByRange(n, F.col("source").asc_nulls_last()).withColumn("_part", F.spark_partition_id())
    kept = materialise(ranged)
    counts = dict(sorted((r["_part"], r["n"]) for r in kept.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()))
    start, at = F.lit(0), 0
    for part, rows in counts.items():
        start = F.when(F.col("_part") == part, F.lit(at)).otherwise(start)
        at += rows
    order = Window.partitionBy("_part").orderBy(F.col("source").asc_nulls_last())
    out = materialise(kept.withColumn("rank", (F.row_number().over(order) - 1 + start).cast("long")).drop("_part"))
    release(kept)
    return out


def share_out(ranked: DataFrame, weights: tuple[int, ...], ratio: float, most: int) -> DataFrame:
    """Adds target: ratio times all sizes shared by weight, none above most times its size.

    Each pass caps the sources above their limit and shares the rest anew, until none is
    above; a pass gathers one row.
    """
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    cap = (F.col("source_size") * most).cast("double")
    base = ranked.withColumns({"_weight": weight, "_cap": cap})
    total = base.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        over = F.col("_weight") * level > F.col("_cap")
        row = base.agg(
            F.sum(F.when(over, F.col("_cap")).otherwise(0.0)).alias("capped"),
            F.sum(F.when(over, 0.0).otherwise(F.col("_weight"))).alias("weight"),
        ).first()
        new = (ratio * total - (row["capped"] or 0.0)) / row["weight"] if row["weight"] else level
        if new <= level:
            break
        level = new
    over = F.col("_weight") * level > F.col("_cap")
    return base.withColumn("target", F.when(over, F.col("_cap")).otherwise(F.col("_weight") * level)).drop("_weight", "_cap", "rank")


def plan_mix(measured: DataFrame, weights: tuple[int, ...] = (5, 2, 1), ratio: float = 1.5, most: int = 2) -> DataFrame:
    """One row for each source: source, source_size, target, epochs, threshold.

    measured: source, size, hash of every document. It is read a few times.
    """
    sizes = measured.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = rank_sources(sizes)
    shared = share_out(ranked, weights, ratio, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    shared = shared.withColumn("epochs", epochs)
    state = materialise(
        shared.select(
            *shared.columns,
            (F.col("target") - F.col("epochs") * F.col("source_size")).alias("need"),
            F.lit(0).cast("long").alias("threshold"),
            ((F.col("epochs") < most) & (F.col("source_size") > 0)).alias("open"),
        )
    )
    release(ranked)
    names = ["source", "source_size", "target", "epochs"]
    few = is_small(state)
    left, width = HASH_BITS, HASH_BITS
    while left and state.filter("open").limit(1).count():
        left -= STEP_BITS
        # state.threshold has the settled leading bits of the boundary bucket
        active = state.filter("open").select("source", F.col("threshold").alias("_from"))
        inside = join_small(measured, active, ["source"], F.col("hash"), small_enough=few)
        inside = inside.filter(F.shiftright("hash", width) == F.shiftright("_from", width)) if width < HASH_BITS else inside
        bucket = F.shiftright("hash", left).alias("bucket")
        sums = inside.groupBy("source", bucket).agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("docs"))
        by = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        run = F.coalesce(F.sum("n").over(by), F.lit(0))
        step = join_small(sums.withColumn("_to", run), state.select("source", "need"), ["source"], F.col("bucket"), small_enough=few)
        first = step.filter(F.col("_to") > F.col("need")).groupBy("source").agg(F.min(F.struct("bucket", "_to", "n", "docs")).alias("_at"))
        low, before = F.shiftleft(F.col("_at.bucket"), left), F.col("need") - (F.col("_at._to") - F.col("_at.n"))
        done = (F.col("_at.docs") <= 1) | F.lit(left == 0)
        take = before * 2 >= F.col("_at.n")
        joined = join_small(state, first, ["source"], F.xxhash64("source"), "left", small_enough=few)
        moved = F.col("open") & F.col("_at").isNotNull()
        new = materialise(
            joined.select(
                *names,
                F.when(moved, before).otherwise(F.col("need")).alias("need"),
                F.when(moved & done & take, low + F.shiftleft(F.lit(1).cast("long"), left))
                .when(moved, low)
                # the whole bucket fits: its end is the threshold
                .when(F.col("open"), F.shiftleft(F.shiftright("threshold", width) + 1, width))
                .otherwise(F.col("threshold"))
                .alias("threshold"),
                (moved & ~done).alias("open"),
            )
        )
        release(state)
        state, width = new, left
    return state.select(*names, "threshold")


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """source, size, hash of every document: what plan_mix reads."""
    return docs.select(F.col(source_col).alias("source"), size_of(text_col).alias("size"), hash_of(id_col, text_col).alias("hash"))


def apply_mix(docs: DataFrame, plan: DataFrame, source: Column, size: Column, hashed: Column) -> DataFrame:
    """docs with size, source_size, target, copies (times it is taken) and taken (words taken)."""
    marked = keep_names(docs, {"__p_source": source, "__p_size": size, "__p_hash": hashed})
    table = plan.select(
        F.col("source").alias("__p_source"), F.col("source_size").alias("__p_ss"), F.col("target").alias("__p_tg"), F.col("epochs").alias("__p_ep"), F.col("threshold").alias("__p_th")
    )
    joined = join_small(marked, table, ["__p_source"], F.col("__p_hash"))
    copies = (F.col("__p_ep") + F.when(F.col("__p_hash") < F.col("__p_th"), 1).otherwise(0)).cast("int")
    out = keep_names(
        joined,
        {
            "size": F.col("__p_size"),
            "source_size": F.col("__p_ss"),
            "target": F.col("__p_tg"),
            "copies": copies,
            "taken": F.col("__p_size") * copies,
        },
    )
    return out.drop("__p_source", "__p_size", "__p_hash", "__p_ss", "__p_tg", "__p_ep", "__p_th")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """All documents with how often the mix takes each; filter copies > 0 and repeat for the mix itself."""
    narrow = materialise(measure(docs, id_col, text_col, source_col))
    plan = plan_mix(narrow, **how)
    release(narrow)
    return apply_mix(docs, plan, F.col(source_col), size_of(text_col), hash_of(id_col, text_col))
