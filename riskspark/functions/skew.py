"""Joins on keys of which a few may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot if it holds more than one in so many of the rows; so there are at most so many hot keys.
HOT_PARTS = 2000
#: Rows of a key that are few enough for one task, whatever the number of rows.
FEW = 50


def join_hot(rows: DataFrame, keys: DataFrame, on: str, weight: str, total: int, how: str = "inner") -> DataFrame:
    """``rows.join(keys, on, how)`` for inner and left joins, without gathering a hot key's rows in one task.

    ``keys`` has one row a key, with ``weight``, the key's number of rows, which
    isn't returned; ``total`` is the number of rows. Keys that hold more than one
    in ``HOT_PARTS`` of them, at most ``HOT_PARTS`` keys, are broadcast and their
    rows stay where they are; the others are joined by a shuffle. Null keys find
    no partner; a null weight counts as 0.
    """
    hot = [r[on] for r in keys.filter(F.col(weight) * HOT_PARTS > total).select(on).collect()] if total > FEW * HOT_PARTS else []
    keys = keys.drop(weight)
    if not hot:
        return rows.join(keys, on, how)
    is_hot = F.coalesce(F.col(on).isin(hot), F.lit(False))
    few = rows.filter(is_hot).join(F.broadcast(keys.filter(is_hot)), on)
    return few.unionByName(rows.filter(~is_hot).join(keys.filter(~is_hot), on, how))
