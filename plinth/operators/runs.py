"""Progress records of discovery runs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.sources.schemas import RUN_STATUSES, RUNS


def start(runs: DataFrame, run_id: int, directory: str, start_url: str, target_profile: int, max_pages: int, now: datetime) -> DataFrame:
    row = (run_id, directory, start_url, target_profile, max_pages, 0, 0, None, start_url, "running", None, now, None)
    return runs.unionByName(runs.sparkSession.createDataFrame([row], RUNS))


def update(runs: DataFrame, run_id: int, **values: object) -> DataFrame:
    if unknown := set(values) - {f.name for f in RUNS}:
        raise ValueError(f"unknown fields: {sorted(unknown)}")
    if not runs.filter(F.col("id") == run_id).limit(1).count():
        raise LookupError(f"run {run_id} was not found")
    on = F.col("id") == run_id
    return runs.select(*((F.when(on, F.lit(values[f.name]).cast(f.dataType)).otherwise(F.col(f.name)) if f.name in values else F.col(f.name)).alias(f.name) for f in RUNS))


def finish(runs: DataFrame, run_id: int, status: str, now: datetime, last_error: str | None = None) -> DataFrame:
    """A pending run stays open, any other ends now."""
    if status not in RUN_STATUSES:
        raise ValueError(f"unknown status {status}")
    return update(runs, run_id, status=status, last_error=last_error, completed_at=now if status != "pending" else None)


def resumable(
    runs: DataFrame, run_id: int | None = None, status: str | None = None, directory: str | None = None, start_url: str | None = None
) -> DataFrame:
    """The one run to go on with: the oldest that is running, whatever is asked for, else the oldest that fits."""
    running = F.col("completed_at").isNull() & (F.col("status") == "running")
    fits = F.col("status") == status if status else F.col("status").isin("pending", "failed")
    for name, value in (("id", run_id), ("directory", directory), ("start_url", start_url)):
        if value is not None:
            fits = fits & (F.col(name) == value)
    open_ = runs.filter(F.col("next_page_url").isNotNull() & (running | fits))
    return open_.orderBy(F.when(running, 0).otherwise(1), "created_at", "id").limit(1)
