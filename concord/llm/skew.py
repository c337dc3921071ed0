"""Joins on keys of which one may be on a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys that may be broadcast: fewer than so many can each hold more than this fraction of the rows.
HOT_KEYS = 1_000
#: A key on fewer rows is never hot.
LEAST_ROWS = 1_000


def split_join(left: DataFrame, right: DataFrame, on: list[str], rows: str) -> DataFrame:
    """The inner join of ``left`` with ``right``, a stored table with one row a key; hot keys are not shuffled.

    ``rows`` is a column of ``right`` with the number of rows of ``left`` that have the key.  A key on more than
    1 / HOT_KEYS of the rows is hot; there are fewer than HOT_KEYS of those, whatever the input, which
    bounds the broadcast.  All other keys are joined by a shuffle, in which none is frequent.
    """
    total = right.agg(F.sum(rows)).first()[0] or 0
    bound = max(total // HOT_KEYS, LEAST_ROWS)
    hot, rest = right.where(F.col(rows) > bound).drop(rows), right.where(F.col(rows) <= bound).drop(rows)
    if hot.isEmpty():
        return left.join(rest, on)
    return left.join(F.broadcast(hot), on).unionByName(left.join(F.broadcast(hot.select(*on)), on, "left_anti").join(rest, on))
