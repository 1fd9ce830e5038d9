"""Discovered profiles as a stream: each batch is folded into the next snapshot."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from plinth.operators import state


def snapshots(found: DataFrame, read: Callable[[], DataFrame], write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Upserts a stream of discovered profiles batch by batch.

    read gives the newest snapshot, write stores the next under the batch's number; a
    batch that is run again writes the same snapshot under the same number.
    """

    def fold(batch: DataFrame, number: int) -> None:
        write(state.save_profiles(read(), batch), number)

    return found.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).outputMode("append").start()
