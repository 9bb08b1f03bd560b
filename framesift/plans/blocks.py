"""Order-preserving block expressions.

A sequence (all frames of one scene, all gaps of one scene, ...) may hold a
large part of a table, so it is never handed to one task.  It is cut into
blocks by a *monotone* expression of its order column: ``a <= b`` implies
``block(a) <= block(b)``.  Rows of one block meet in one task, and only one
summary row per block travels on.  The expressions depend on the row alone, so
a retried or repeated stage always sees the same blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

FRAMES_PER_BLOCK = 4096


def text_block(column: Column, width: int = 3) -> Column:
    """Prefix of a text key; frame ids are six digits, so 3 keeps 1,000 per block."""
    return F.substring(column, 1, width)


def index_block(column: Column, size: int = FRAMES_PER_BLOCK) -> Column:
    return F.floor(column / F.lit(size)).cast("long")


def time_block(column: Column, unit: str = "HOUR") -> Column:
    return F.date_trunc(unit, column)


def number_block(column: Column, per_doubling: int = 32) -> Column:
    """Signed logarithmic buckets of a numeric column."""
    magnitude = F.floor(F.log2(F.lit(1.0) + F.abs(column)) * F.lit(per_doubling))
    return F.when(column < 0, -magnitude).otherwise(magnitude).cast("long")
