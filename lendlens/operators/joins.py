"""Joins against aggregate tables whose size is checked, not assumed."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest small side pinned as a literal relation and broadcast.
BROADCAST_ROW_LIMIT = 200_000
# Larger lookup tables up to this many rows are written to the shared folder,
# counted there and still broadcast (about 40 MB for the narrow count rows).
STORED_ROW_LIMIT = 1_000_000


def together(spark: SparkSession, *calls):
    """Results of independent Spark actions started at the same time (each a function without arguments)."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max(1, len(calls))) as pool:
        return [f.result() for f in [pool.submit(inherit(c)) for c in calls]]


def local_table(spark, rows: list, schema) -> DataFrame:
    """A literal relation (``LocalRelation``) from driver-side rows.

    Built through an Arrow table, so it lives in the JVM plan: broadcasting
    it needs no Python worker, and NaN stays distinct from NULL.
    """
    try:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema
        tbl = pa.Table.from_pylist([r.asDict() if hasattr(r, "asDict") else dict(zip(schema.names, r))
                                    for r in rows], schema=to_arrow_schema(schema))
        return spark.createDataFrame(tbl)
    except Exception:                                   # no Arrow support for a type: plain rows
        return spark.createDataFrame(rows, schema)


def pin_small(small: DataFrame, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame | None:
    """Return ``small`` as a local relation if it has at most ``limit`` rows.

    The rows are fetched with ``limit + 1`` so an oversized table is detected
    without pulling it whole.  A pinned table is computed once, cannot change
    on a task retry and is safe to broadcast.  Returns None when too big.
    """
    rows = small.limit(limit + 1).collect()
    if len(rows) > limit:
        return None
    return local_table(small.sparkSession, rows, small.schema)


def join_small(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner",
               null_safe: bool = True, limit: int = BROADCAST_ROW_LIMIT, pinned: bool = False) -> DataFrame:
    """Join ``big`` to an aggregate ``small`` on ``keys``.

    Broadcasts when the small side is within ``limit`` rows (checked), else
    falls back to a shuffle join.  ``null_safe`` matches NULL keys to NULL
    keys (``<=>``), like pandas merges and grouped lookups expect.
    ``pinned=True``: ``small`` is already a pinned table (size proven).
    """
    pinned = small if pinned else pin_small(small, limit)
    right = F.broadcast(pinned) if pinned is not None else small
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c)
                             for c in right.columns])
    conds = [(big[k].eqNullSafe(renamed[f"__r_{k}"]) if null_safe else big[k] == renamed[f"__r_{k}"])
             for k in keys]
    cond = reduce(lambda a, b: a & b, conds)
    out = big.join(renamed, cond, how)
    return out.drop(*[f"__r_{k}" for k in keys])


def pin_or_store(df: DataFrame, limit: int = BROADCAST_ROW_LIMIT,
                 stored_limit: int = STORED_ROW_LIMIT) -> DataFrame | None:
    """``pin_small``, else a written copy under the shared folder if it has at
    most ``stored_limit`` rows (counted on the written files), else None."""
    pinned = pin_small(df, limit)
    if pinned is not None or stored_limit <= limit:
        return pinned
    from lendlens.session import materialize
    stored = materialize(df, "lookup")
    return stored if stored.count() <= stored_limit else None


def pinned_grouping_sets(df: DataFrame, sets: list[list[str]], aggs: list, limit: int = BROADCAST_ROW_LIMIT,
                         stored_limit: int = 0):
    """Several small group-bys of ``df`` in one scan (GROUPING SETS), pinned.

    Returns one DataFrame per grouping set (its key columns plus the
    aggregates), or None when the combined result exceeds ``limit`` rows
    (``stored_limit`` rows when a stored copy is allowed, see ``pin_or_store``).
    """
    cols = []
    for s in sets:
        for c in s:
            if c not in cols:
                cols.append(c)
    grouped = df.groupingSets(sets, *cols).agg(*aggs, F.grouping_id().alias("__gid"))
    pinned = pin_or_store(grouped, limit, stored_limit)
    if pinned is None:
        return None
    names = [c for c in grouped.columns if c not in cols and c != "__gid"]
    m = len(cols)
    out = []
    for s in sets:
        gid = sum(1 << (m - 1 - j) for j, c in enumerate(cols) if c not in s)
        out.append(pinned.filter(F.col("__gid") == gid).select(*s, *names))
    return out
