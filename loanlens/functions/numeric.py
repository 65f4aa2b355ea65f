"""Numeric helpers shared by the rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_dp(c: Column, digits: int) -> Column:
    """Round the binary double value to ``digits`` places, halves away from zero.

    Spark's ``round(x, d)`` rounds the shortest decimal string of ``x``
    (0.62045 -> 0.6205), while Python's ``round`` and DuckDB round the binary
    value (0.620449999... -> 0.6204). Scaling first keeps the binary value.
    """
    m = float(10 ** digits)
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c * F.lit(m), 0) / F.lit(m)
