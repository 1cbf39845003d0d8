"""Joins in which one key may hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot if it has more than one in so many of the rows, so there are fewer hot keys than this.
HOT_KEYS = 64


def left_join(rows: DataFrame, table: DataFrame, keys: Sequence[str], weight: str, total: int) -> DataFrame:
    """``rows`` with the columns of ``table``, which has each key once, and in ``weight`` at least the number of rows that
    have it; ``total`` is the sum of what ``weight`` bounds. Rows of hot keys stay where they are, as the few entries
    for them are sent to all tasks; only the others are shuffled. Columns other than the keys must differ.

    ``rows`` is read twice, so it should be a stored table.
    """
    hot = F.col(weight) * HOT_KEYS > total
    few = table.filter(hot).drop(weight).withColumn("is_hot", F.lit(True))
    marked = rows.join(F.broadcast(few), list(keys), "left")
    many = marked.filter("is_hot IS NULL").select(*rows.columns)
    found = many.join(table.filter(~hot).drop(weight), list(keys), "left")
    return marked.filter("is_hot").drop("is_hot").unionByName(found)
