"""Bounded samples by hash."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def about(hashed: Column, wanted: int, total: int) -> Column:
    """Whether a row is in a sample of about ``wanted`` of ``total`` rows: those whose 64-bit ``hashed`` is smallest.

    Shares are told to 2^-64, so the sample keeps its size however many rows there are. All rows
    if ``wanted`` is not below ``total``. Equal hashes are taken together.
    """
    if wanted >= total:
        return F.lit(True)
    return hashed < F.lit(max(0, wanted) * (1 << 64) // total - (1 << 63))
