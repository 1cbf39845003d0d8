"""Exact order statistics of groups of any size.

A group may hold most of a table, so no step sorts a whole group in one task. The values are sorted by
range over all tasks, with bounds that Spark takes from the data, so crowded values are split like any others. Each
part counts its rows per group, prefix sums over the parts tell which part holds a wanted rank, and only those
parts are ranked within.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.session import materialise

Rank = Callable[[Column], Column]


def value_cells(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Distinct values per group with their row count ``_n``, as a scratch table."""
    known = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    return materialise(known.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n")), "cells")


def select_ranks(
    cells: DataFrame,
    keys: Sequence[str],
    value: str,
    low: Rank,
    high: Rank,
    *,
    tiebreak: Sequence[str] = (),
    targets: DataFrame | None = None,
) -> DataFrame:
    """The cells of every group that hold its 0-based ranks ``low`` to ``high``.

    ``low`` and ``high`` map the group's row count to a rank; they may use columns of ``targets``, which has one
    row per group. The keys must not be null. The result has the keys, the value, the tie-break columns, ``_n``,
    ``_before`` (rows ranked before the cell), ``_low``, ``_high`` and ``_total`` (rows of the group).

    The number of parts is ``spark.sql.shuffle.partitions``, whatever the size. The prefix sums run over one row
    per part and group, so their largest window has as many rows as there are parts.
    """
    keys, order = list(keys), [value, *tiebreak]
    parts = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    earlier = (Window.unboundedPreceding, -1)
    placed = materialise(
        cells.select(*keys, *order, "_n")
        .repartitionByRange(parts, *keys, *order)
        .withColumn("_part", F.spark_partition_id()),
        "placed",
    )

    def running(rows: str, by: list[str], order_by: list[str]) -> Column:
        window = Window.partitionBy(*by).orderBy(*order_by).rowsBetween(*earlier)
        return F.coalesce(F.sum(rows).over(window), F.lit(0))

    counted = placed.groupBy(*keys, "_part").agg(F.sum("_n").alias("_rows"))
    summed = counted.withColumns(
        {
            "_total": F.sum("_rows").over(Window.partitionBy(*keys)),
            "_base": running("_rows", keys, ["_part"]),
        }
    )
    extra = []
    if targets is not None:
        extra = [c for c in targets.columns if c not in keys]
        summed = summed.join(targets, keys)
    wanted = (
        summed.withColumn("_low", low(F.col("_total")).cast("bigint"))
        .withColumn("_high", high(F.col("_total")).cast("bigint"))
        .drop(*extra)
        .where((F.col("_base") <= F.col("_high")) & (F.col("_base") + F.col("_rows") > F.col("_low")))
    )
    opened = placed.join(materialise(wanted.drop("_rows"), "picked"), [*keys, "_part"])
    ranked = opened.withColumn("_before", F.col("_base") + running("_n", [*keys, "_part"], order))
    holds = (F.col("_before") <= F.col("_high")) & (F.col("_before") + F.col("_n") > F.col("_low"))
    return ranked.where(holds).select(*keys, *order, "_n", "_low", "_high", "_total", "_before")


def exact_quantile(
    cells: DataFrame,
    keys: Sequence[str],
    value: str,
    p: float,
    out: str,
) -> DataFrame:
    """The interpolated ``p``-quantile of every group of ``cells`` (see :func:`value_cells`)."""
    position = lambda n: (n - 1) * F.lit(float(p))
    found = select_ranks(
        cells,
        keys,
        value,
        lambda n: F.floor(position(n)),
        lambda n: F.ceil(position(n)),
    )
    # The share of the upper neighbour follows from the group's size.
    share = position(F.col("n")) - F.floor(position(F.col("n")))
    ends = found.groupBy(*keys).agg(
        F.min(value).alias("_a"), F.max(value).alias("_b"), F.max("_total").alias("n")
    )
    return ends.select(*keys, (F.col("_a") * (1 - share) + F.col("_b") * share).alias(out), "n")


def exact_rank(cells: DataFrame, value: str, rank: Rank, out: str) -> DataFrame:
    """The value at one 0-based rank of the whole table."""
    found = select_ranks(cells, [], value, rank, rank)
    return found.select(F.col(value).alias(out), (F.col("_low")).alias("rank"))
