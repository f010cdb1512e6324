"""Rounding that gives the same bits in Spark and in SQL engines.

``F.round`` rounds the decimal text of a double (0.285 -> 0.29) while most
SQL engines round the binary value (0.285 -> 0.28).  The expression below
rounds half away from zero on the binary value and is spelled identically
in plain SQL, so reports and oracles agree bit for bit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(c, digits: int) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    p = float(10 ** digits)
    return (F.when(c < 0, -F.floor(-c * p + 0.5)).otherwise(F.floor(c * p + 0.5)) / p).cast("double")


def round_half_away_sql(expr: str, digits: int) -> str:
    p = f"{float(10 ** digits)!r}"
    return (f"(CASE WHEN ({expr}) < 0 THEN -floor(-({expr})*{p}+0.5) "
            f"ELSE floor(({expr})*{p}+0.5) END / {p})")


# Comparison keys for the oracle gate.  Exact means over 2^k rows and short
# decimals sit on round-half ties, where one ulp of summation-order noise
# flips a rounded digit.  Snapping with cell edges at fraction 0.618034...
# keeps such values in the interior of a cell; the same expression in both
# engines gives the same key.
SNAP_OFFSET = 0.381966


def gate_snap(c, digits: int) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    p = float(10 ** digits)
    return (F.floor(c * p + SNAP_OFFSET) / p).cast("double")


def gate_snap_sql(expr: str, digits: int) -> str:
    p = f"{float(10 ** digits)!r}"
    return f"(floor(({expr})*{p}+{SNAP_OFFSET!r}) / {p})"
