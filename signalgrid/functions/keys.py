"""Cell key spelling."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def normalize_key(cell: Column) -> Column:
    """Upper case without any white space, so ``'c 12'`` and ``'C12'`` are one cell."""
    return F.upper(F.regexp_replace(cell, r"\s+", ""))
