"""Leases on a pool of resources, and reconciling the pool with a list, as snapshots."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEASE, EXTENSION = timedelta(minutes=10), timedelta(minutes=5)


def available(pool: DataFrame) -> DataFrame:
    """Active resources that are in no use, by id; a lease that has run out still counts as use."""
    return pool.filter((F.col("is_active") == F.lit(True)) & (F.col("is_in_use") == F.lit(False))).orderBy("id").select("id", "proxy_url")


def acquire(pool: DataFrame, tokens: list[str], now: datetime, lease: timedelta = LEASE) -> DataFrame:
    """pool with a lease for each token, as far as there are free or run-out resources, the least used first."""
    free = pool.filter((F.col("is_active") == F.lit(True)) & ((F.col("is_in_use") == F.lit(False)) | (F.col("lease_until") <= F.lit(now))))
    taken = free.orderBy("times_used", "id").limit(len(tokens))  # as many rows as there are requests
    ranked = taken.select(F.col("id").alias("_id"), F.row_number().over(Window.orderBy("times_used", "id")).alias("_n"))
    token = F.get(F.array(*(F.lit(t) for t in tokens)).cast("array<string>"), F.col("_n") - 1)
    joined = pool.join(ranked, F.col("id") == F.col("_id"), "left")
    change = {"is_in_use": F.lit(True), "lease_token": token, "lease_until": F.lit(now + lease), "times_used": F.col("times_used") + 1}
    return _set(joined, F.col("_n").isNotNull(), change).select(*pool.columns)


def _set(rows: DataFrame, on: Column, change: dict[str, Column]) -> DataFrame:
    return rows.select(*((F.when(on, change[c]).otherwise(F.col(c)) if c in change else F.col(c)).alias(c) for c in rows.columns))


def _held(token: str) -> Column:
    return F.coalesce((F.col("lease_token") == token) & (F.col("is_in_use") == F.lit(True)), F.lit(False))


def renew(pool: DataFrame, token: str, now: datetime, by: timedelta = EXTENSION) -> DataFrame:
    """pool with the token's lease extended from its end, or from now if that is later; an unknown token changes nothing."""
    until = F.greatest(F.coalesce("lease_until", F.lit(now)), F.lit(now)) + F.lit(by)
    return _set(pool, _held(token), {"lease_until": until})


def release(pool: DataFrame, token: str, now: datetime) -> DataFrame:
    none = F.lit(None)
    return _set(pool, _held(token), {"is_in_use": F.lit(False), "lease_token": none.cast("string"), "lease_until": none.cast("timestamp"), "last_used_at": F.lit(now)})


def reconcile(pool: DataFrame, listed: DataFrame, key: str = "proxy_url") -> DataFrame:
    """key, is_active, change of pool (key, is_active) against a list (key, is_active, position).

    change: added (whatever its flag), deactivated (missing or switched off),
    reactivated, or same. Of a key listed twice the row with the greatest position counts;
    a list without positions is taken in the order of its rows.
    """
    placed = listed if "position" in listed.columns else listed.withColumn("position", F.monotonically_increasing_id())
    once = placed.groupBy(key).agg(F.max_by("is_active", "position").alias("is_active"))
    joined = pool.select(key, "is_active").alias("p").join(once.alias("l"), F.col(f"p.{key}") == F.col(f"l.{key}"), "full")
    was, now = F.col("p.is_active"), F.col("l.is_active")
    known, there = F.col(f"p.{key}").isNotNull(), F.col(f"l.{key}").isNotNull()
    change = (
        F.when(~known, "added")
        .when(was & (~there | ~now), "deactivated")
        .when(there & ~was & now, "reactivated")
        .otherwise("same")
    )
    return joined.select(F.coalesce(f"p.{key}", f"l.{key}").alias(key), F.when(there, now).otherwise(False).alias("is_active"), change.alias("change"))


def counts(reconciled: DataFrame) -> DataFrame:
    n = lambda s: F.count_if(F.col("change") == s).alias(s)
    return reconciled.agg(n("added"), n("deactivated"), n("reactivated"))
