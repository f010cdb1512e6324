"""Memory of executors: batches of few MB, and what arrays of Python workers free goes back to the system at once.

Workers live on between stages.  By default the allocator keeps freed blocks of
up to 32 MB for later, so a worker holds its largest past need while other
stages run beside it.  Importing this module fixes the size from which blocks are mapped on
their own (and unmapped when freed), and lets Arrow allocate the same way.

Whole texts make batches large: by default a scan holds 4096 of them and
an Arrow batch up to 64 MB, both sides of the pipe to Python.  ``small_batches``
bounds them for the session; the plans are run after the stage returns.
"""

from __future__ import annotations

import ctypes

import pyarrow as pa

M_MMAP_THRESHOLD = -3
MAPPED_FROM = 1 << 18

try:
    ctypes.CDLL(None).mallopt(M_MMAP_THRESHOLD, MAPPED_FROM)
    pa.set_memory_pool(pa.system_memory_pool())
except (OSError, AttributeError):          # another C library: nothing to set
    pass

BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m", "spark.sql.parquet.columnarReaderBatchSize": "512"}


def small_batches(spark) -> None:
    """Small batches for this session; what the application's own configuration names stays."""
    given = spark.sparkContext.getConf()
    for key, value in BATCHES.items():
        if not given.contains(key):
            spark.conf.set(key, value)
