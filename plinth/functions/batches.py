"""Arrow batches of bounded bytes, and memory that workers hand back."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import SparkSession

#: Bytes that come to a worker at once.
BATCH_BYTES = 8 << 20
_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound(spark: SparkSession) -> None:
    """Lower the session's limit on the bytes of a batch to BATCH_BYTES."""
    if not 0 < int(spark.conf.get(_LIMIT).removesuffix("b")) <= BATCH_BYTES:
        spark.conf.set(_LIMIT, str(BATCH_BYTES))


def give_back() -> None:
    """Hand memory that was freed back to the system, for workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    if (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)) is not None:
        trim(0)
