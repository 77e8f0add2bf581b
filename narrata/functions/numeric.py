"""Numeric helpers shared by operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round6(c) -> Column:
    """Round a double to 6 places as ``round(x * 1e6) / 1e6``.

    Rounding the scaled double (not its decimal string) gives the same
    result in engines that implement ``round(x, 6)`` either way, so reported
    metrics compare exactly across engines.
    """
    x = F.col(c) if isinstance(c, str) else c
    return F.round(x.cast("double") * F.lit(1e6)) / F.lit(1e6)

