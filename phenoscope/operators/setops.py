"""Set operations on key columns (U1-U4), written as joins where that is what
they are."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def bag_union(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name (no shuffle)."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def difference(left: DataFrame, right: DataFrame, keys: Sequence[str] | None = None,
               keep_duplicates: bool = True) -> DataFrame:
    """Rows of ``left`` whose key is absent from ``right``.

    ``keep_duplicates=True`` is the RDD ``subtract`` semantics (a left-anti
    join, duplicates of ``left`` survive); ``False`` is EXCEPT DISTINCT.
    """
    keys = list(keys or left.columns)
    # distinct first: a key that holds most rows of ``right`` crosses the shuffle
    # once per task
    out = left.join(right.select(*keys).distinct(), keys, "left_anti")
    return out if keep_duplicates else out.distinct()


def intersection(left: DataFrame, right: DataFrame,
                 keys: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows of ``left`` whose key appears in ``right``
    (left-semi join of both sides' distinct rows, so hot keys collapse before
    the shuffle)."""
    keys = list(keys or left.columns)
    return left.distinct().join(right.select(*keys).distinct(), keys, "left_semi")


def distinct(df: DataFrame) -> DataFrame:
    """U4."""
    return df.distinct()
