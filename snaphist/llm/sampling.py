"""Bounded samples by hash, at any size of the input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def near_bottom(h: Column, want: int, n: Column) -> Column:
    """Whether a 64-bit hash is among about the ``2 * want`` smallest of ``n``
    (all, if there are not many more): few enough to sort, and enough to hold
    the ``want`` smallest."""
    share = (2 * want + 64) / n.cast("double")
    return (share >= 0.99) | (h < F.when(share < 0.99, F.lit(-(2.0 ** 63)) + share * 2.0 ** 64))
