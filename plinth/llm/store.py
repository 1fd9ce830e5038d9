"""Cutting lineage, counting off rows and joining small tables, shared by the operators here."""

from __future__ import annotations

import atexit
import functools
import math
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plinth.sources.files import shared_dir

#: Rows and bytes up to which a side of a join is broadcast; both are counted every time.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 16 << 20
#: Bytes, as Spark estimates them, up to which a side that nobody counted is broadcast; the estimate goes by compressed columns and may be a small part of the truth.
UNCOUNTED_BYTES = 256 << 10
_AUTO, _ADAPTIVE = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
#: Rows that one salt of a hot key should hold.
ROWS_PER_SALT = 100_000

_written: list[tuple[SparkSession, str]] = []
#: Tables that the innermost scoped call has written.
_scope: ContextVar[list[DataFrame] | None] = ContextVar("_scope", default=None)


@contextmanager
def counted_broadcasts(spark: SparkSession) -> Iterator[None]:
    """What runs inside broadcasts what is marked so, and by Spark's own estimate no more than UNCOUNTED_BYTES."""
    before = {k: spark.conf.get(k, None) for k in (_AUTO, _ADAPTIVE)}
    spark.conf.set(_AUTO, str(min(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold(), UNCOUNTED_BYTES)))
    if before[_ADAPTIVE] and not before[_ADAPTIVE].startswith("-"):
        spark.conf.unset(_ADAPTIVE)  # the other one holds
    try:
        yield
    finally:
        for k, v in before.items():
            if v is not None:
                spark.conf.set(k, v)


def materialise(df: DataFrame) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back.

    Unlike a checkpoint of an RDD this keeps column pruning and compression, and
    like one it survives the loss of any executor. ``release`` drops it early. Its joins
    are by counted_broadcasts, so the driver builds no large table.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/plinth/{uuid.uuid4().hex}"
    with counted_broadcasts(spark):
        df.write.parquet(path)
    _written.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._plinth_path = path
    if (own := _scope.get()) is not None:
        own.append(out)
    return out


def scoped(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """An operator whose result is materialised, and whose other tables are deleted when it returns."""

    @functools.wraps(operator)
    def run(*args, **kwargs) -> DataFrame:
        outer, own = _scope.get(), []
        token = _scope.set(own)
        try:
            result = operator(*args, **kwargs)
            _scope.set(outer)  # the result belongs to whoever called
            return materialise(result)
        finally:
            _scope.reset(token)
            release(*own)

    return run


def release(*frames: DataFrame) -> None:
    """Delete materialised frames that nothing will read again."""
    for df in frames:
        path = df._plinth_path
        if any(x[1] == path for x in _written):
            _delete(df.sparkSession, path)
            _written[:] = [x for x in _written if x[1] != path]


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        if spark.sparkContext._jsc is not None:
            _delete(spark, path)
    _written.clear()


def same(left: str, right: str, keys: list[str]) -> Column:
    """Null-safe equality of keys between two aliased frames."""
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`"))
    return out


def is_small(df: DataFrame) -> bool:
    """Whether df may be broadcast: few rows, and few bytes, of which it counts those of texts and of arrays of numbers."""
    width = F.lit(16 + 16 * len(df.columns))
    for f in df.schema:
        kind = f.dataType.simpleString()
        if kind in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0))
        elif kind.startswith("array"):
            width = width + 16 * F.greatest(F.size(f"`{f.name}`"), F.lit(0))
    rows, size = df.limit(BROADCAST_ROWS + 1).agg(F.count(F.lit(1)), F.sum(width.cast("long"))).first()
    return rows <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES


def join_small(df: DataFrame, small: DataFrame, keys: list[str], salt: Column, how: str = "inner", small_enough: bool | None = None) -> DataFrame:
    """df joined with a table of one row a key, whose other columns are new names.

    A small table is broadcast, which is_small tells unless the caller has asked it. Beyond that, a hot key is dealt out:
    df's rows get a salt and the table one copy of each row a salt.
    """
    more = [c for c in small.columns if c not in keys]
    pick = [F.col(f"_a.`{c}`") for c in df.columns] + [F.col(f"_b.`{c}`") for c in more]
    if is_small(small) if small_enough is None else small_enough:
        return df.alias("_a").join(F.broadcast(small).alias("_b"), same("_a", "_b", keys), how).select(*pick)
    n = 32
    salted = df.withColumn("__p_salt", F.pmod(salt, F.lit(n)).cast("int"))
    copies = small.withColumn("__p_salt", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).hint("merge")  # the copies are not in Spark's estimate
    return salted.alias("_a").join(copies.alias("_b"), same("_a", "_b", [*keys, "__p_salt"]), how).select(*pick)


def count_off(df: DataFrame, group: list[str], order: list[str], out: str, hottest: int) -> DataFrame:
    """Number the rows of each group from 0 without gaps, without bringing a group together.

    A group's rows are dealt to hashed salts, ``hottest / ROWS_PER_SALT`` of them (64
    at least); rows are numbered within a salt, and the salts' counts, summed up in
    order, give where each starts. Rows that agree in ``order`` get numbers in any order.
    df is read twice: materialise it first.
    """
    n = max(64, math.ceil(hottest / ROWS_PER_SALT))
    salted = df.withColumn("__p_salt", F.pmod(F.xxhash64(*order, F.lit(11)), F.lit(n)).cast("int"))
    keys = [*group, "__p_salt"]
    counts = salted.groupBy(*keys).agg(F.count(F.lit(1)).alias("__p_n"))
    before = Window.partitionBy(*group).orderBy("__p_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, F.coalesce(F.sum("__p_n").over(before), F.lit(0)).alias("__p_start"))
    ranked = salted.withColumn("__p_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)
    return (
        ranked.alias("_a")
        .join(starts.alias("_b"), same("_a", "_b", keys))
        .select(*(F.col(f"_a.`{c}`") for c in df.columns), (F.col("_b.__p_start") + F.col("_a.__p_rank")).cast("long").alias(out))
    )


def keep_names(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """df with columns added; an input column of the same name, in either case, is replaced."""
    taken = {c.lower() for c in new}
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c.lower() not in taken), *(x.alias(c) for c, x in new.items()))
