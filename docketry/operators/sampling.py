"""Representative subsets: quotas per (month, class) and a reproducible choice inside each."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry import schema as S
from docketry.functions.values import month_key, random_score
from docketry.operators.frames import classification_rows
from docketry.operators.selection import select_ranks
from docketry.session import materialise

STRATUM = (S.MONTH, S.TARGET)
#: Half the width of the band of scores that is ranked, in standard deviations; it only saves work.
BAND = 6.0


def sampling_rows(prepared: DataFrame, target: str = S.TARGET) -> DataFrame:
    """Usable rows with their month key."""
    usable = classification_rows(prepared, target)
    return usable.withColumn(S.MONTH, month_key(F.col(S.CREATED)))


def strata_counts(rows: DataFrame, keys: Sequence[str] = STRATUM) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def _deal(frame: DataFrame, room: str, amount: Column, order: list[Column], out: str) -> DataFrame:
    """Deal ``amount`` units to the groups one at a time, round after round.

    Within a round the groups come in ``order``; a group takes part while it has room. Every
    group therefore gets ``min(room, level)`` for the highest level that the amount reaches, and
    the first groups in order share what is left. The level follows from running sums, so no
    unit is dealt one by one.
    """
    everyone = Window.partitionBy()
    ascending = Window.orderBy(room).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    r, groups = F.col(room), F.count(F.lit(1))
    # Units handed out if every group stopped at this group's room, and groups with more room.
    frame = frame.withColumns(
        {
            "_amount": F.least(amount, F.sum(r).over(everyone)),
            "_more": groups.over(everyone) - groups.over(ascending),
            "_upto": F.sum(r).over(ascending),
        }
    ).withColumn("_cost", F.col("_upto") + F.col("_more") * r)
    # The highest room that the amount fills for everyone who has it.
    full = F.col("_cost") <= F.col("_amount")

    def at_full(fold, value: Column, none: Column) -> Column:
        return F.coalesce(fold(F.when(full, value)).over(everyone), none)

    frame = frame.withColumns(
        {
            "_floor": at_full(F.max, r, F.lit(0)),
            "_spent": at_full(F.max, F.col("_cost"), F.lit(0)),
            "_open": at_full(F.min, F.col("_more"), groups.over(everyone)),
        }
    )
    rest = F.col("_amount") - F.col("_spent")
    steps = F.coalesce(F.floor(rest / F.nullif(F.col("_open"), F.lit(0))), F.lit(0))
    frame = frame.withColumn("_steps", steps.cast("bigint")).withColumns(
        {
            "_level": F.col("_floor") + F.col("_steps"),
            "_left": rest - F.col("_steps") * F.col("_open"),
        }
    )
    still_open = (r > F.col("_level")).cast("int")
    place = F.sum(still_open).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    extra = F.when((still_open == 1) & (place <= F.col("_left")), 1).otherwise(0)
    dealt = F.least(r, F.col("_level")) + extra
    return frame.withColumn(out, dealt).drop(
        "_amount", "_more", "_upto", "_cost", "_floor", "_spent", "_open", "_steps", "_level", "_left"
    )


def allocate_quotas(
    counts: DataFrame,
    target_rows: int,
    min_per_group: int,
    keys: Sequence[str] = STRATUM,
    fill_order: str = "smallest_remainder",
) -> DataFrame:
    """How many rows each group gives to a sample of ``target_rows``.

    Proportional shares are rounded down, lifted to ``min_per_group`` where the group has that
    many rows, and then trimmed or filled to meet the target. The minimum wins over the target.
    ``counts`` has one row per group and a column ``n``; the windows run over that group table
    alone. ``fill_order`` may be ``largest_remainder`` for the usual rounding instead.
    """
    if fill_order not in ("smallest_remainder", "largest_remainder"):
        raise ValueError(f"unknown fill order: {fill_order}")
    everyone = Window.partitionBy()
    n = F.col("n")
    total = F.sum(n).over(everyone)
    goal = F.least(F.lit(int(target_rows)), F.col("_total"))
    frame = (
        counts.select(*keys, n)
        .where(n > 0)
        .withColumn("_total", total)
        .withColumn("_target", goal)
        .withColumns(
            {
                "_raw": n / F.col("_total") * F.col("_target"),
                "_min": F.least(n, F.lit(int(min_per_group))),
            }
        )
        .withColumn(
            "_share",
            F.least(F.greatest(F.floor("_raw").cast("bigint"), F.col("_min")), n),
        )
        .withColumns(
            {
                "_sum": F.sum("_share").over(everyone),
                "_over": F.col("_share") - F.col("_min"),
                "_under": n - F.col("_share"),
                "_fraction": F.col("_raw") - F.floor("_raw"),
            }
        )
    )

    names = [F.col(k) for k in keys]
    excess = F.greatest(F.col("_sum") - F.col("_target"), F.lit(0))
    frame = _deal(frame, "_over", excess, [F.col("_over").desc(), *names], "_cut")
    deficit = F.greatest(F.col("_target") - F.col("_sum"), F.lit(0))
    if fill_order == "smallest_remainder":
        order = [F.col("_fraction").asc(), F.col("_under").asc(), *names]
    else:
        order = [F.col("_fraction").desc(), F.col("_under").desc(), *names]
    frame = _deal(frame, "_under", deficit, order, "_add")
    quota = F.col("_share") - F.col("_cut") + F.col("_add")
    return frame.select(*keys, "n", quota.cast("bigint").alias("quota"))


def threshold_cells(
    scored: DataFrame, quotas: DataFrame, row_id: str, keys: Sequence[str] = STRATUM
) -> tuple[DataFrame, DataFrame]:
    """The rows near each group's last chosen score, and (keys, quota, ``_under``, ``_from``, ``_to``) of each group.

    Scores are uniform, so the score of rank ``quota`` of ``n`` lies within ``BAND`` standard deviations of
    ``quota / n``, but for one group in some 10^8. One aggregate counts each group's rows below that band and within it. If the
    wanted rank isn't within, as when the counts in ``quotas`` are those of other rows, the band of that group is
    everything, so the result is exact in any case. ``_under`` is the number of rows below the band.
    """
    keys = list(keys)
    share = F.col("quota") / F.col("n")
    # Bernstein's bound: the second term covers small groups and shares next to 0 or 1.
    width = BAND * F.sqrt(share * F.greatest(1 - share, F.lit(0.0)) / F.col("n")) + BAND * BAND / F.col("n")
    bands = (
        quotas.where(F.col("quota") > 0)
        .select(*keys, "quota", (share - width).alias("_from"), (share + width).alias("_to"))
    )
    low = F.count_if(F.col("_score") < F.col("_from"))
    inside = F.count_if((F.col("_score") >= F.col("_from")) & (F.col("_score") <= F.col("_to")))
    counted = scored.join(bands, keys).groupBy(*keys).agg(low.alias("_low_rows"), inside.alias("_in_rows"))
    hit = (F.col("_low_rows") < F.col("quota")) & (F.col("quota") <= F.col("_low_rows") + F.col("_in_rows"))
    ranges = materialise(
        bands.join(counted, keys).select(
            *keys,
            "quota",
            F.when(hit, F.col("_low_rows")).otherwise(F.lit(0)).alias("_under"),
            F.when(hit, F.col("_from")).otherwise(F.lit(float("-inf"))).alias("_from"),
            F.when(hit, F.col("_to")).otherwise(F.lit(float("inf"))).alias("_to"),
        ),
        "bands",
    )
    near = scored.join(ranges, keys).where((F.col("_score") >= F.col("_from")) & (F.col("_score") <= F.col("_to")))
    return near.select(*keys, "_score", row_id, F.lit(1).cast("bigint").alias("_n")), ranges


def choose_rows(
    rows: DataFrame,
    quotas: DataFrame,
    row_id: str,
    keys: Sequence[str] = STRATUM,
    seed: int = 42,
) -> DataFrame:
    """The ``quota`` rows with the smallest scores of every group, with all columns of ``rows``.

    The last score of each group is looked up among the few rows that can hold it, then the rows are filtered where
    they lie: a group that holds most of the table is neither sorted nor gathered anywhere. ``rows`` is read several
    times, so it should be a narrow stored table; ``quotas`` must be stored as well.
    """
    keys = list(keys)
    scored = rows.withColumn("_score", random_score(seed, F.col(row_id)))
    cells, ranges = threshold_cells(scored, quotas, row_id, keys)
    rank = lambda _: F.col("quota") - 1 - F.col("_under")
    wanted = ranges.select(*keys, "quota", "_under")
    last = select_ranks(cells, keys, "_score", rank, rank, tiebreak=[row_id], targets=wanted)
    last = materialise(
        last.select(*keys, F.col("_score").alias("_last"), F.col(row_id).alias("_last_id")), "last"
    )
    within = (F.col("_score") < F.col("_last")) | (
        (F.col("_score") == F.col("_last")) & (F.col(row_id) <= F.col("_last_id"))
    )
    return scored.join(last, keys).where(within).drop("_score", "_last", "_last_id")


def rows_with_ids(rows: DataFrame, ids: DataFrame, row_id: str) -> DataFrame:
    """Full rows of chosen ids."""
    return rows.join(ids.select(row_id), row_id, "left_semi")


def sample_metadata(
    quotas: DataFrame,
    target_rows: int,
    min_per_group: int,
    seed: int,
    keys: Sequence[str] = STRATUM,
    max_rows: int | None = None,
) -> DataFrame:
    """One row that says how a sample was drawn, with counts per ``month|class``."""
    name = F.concat_ws("|", *keys)

    def per_group(value: str) -> Column:
        return F.map_from_entries(F.array_sort(F.collect_list(F.struct(name, F.col(value)))))

    return quotas.agg(
        F.sum("n").alias("source_rows_with_valid_time_and_nature"),
        F.sum("quota").alias("sampled_rows"),
        F.lit(int(target_rows)).alias("target_rows"),
        F.lit(int(min_per_group)).alias("min_per_group"),
        F.lit(int(seed)).alias("random_state"),
        F.lit(max_rows).cast("bigint").alias("max_rows"),
        per_group("n").alias("monthly_nature_counts"),
        per_group("quota").alias("monthly_nature_sampled_counts"),
    )


def representative_subset(
    records: DataFrame,
    row_id: str,
    target_rows: int = 300_000,
    min_per_group: int = 25,
    seed: int = 42,
    target: str = S.TARGET,
    fill_order: str = "smallest_remainder",
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    max_rows: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The sampled rows in chronological order, and the sampling metadata.

    Month, class and row id of every usable row are stored first; pruning leaves only the two
    source columns they come from. Rows are chosen from that narrow table, and ``prepare`` cleans
    all columns of the chosen rows alone. ``max_rows`` is the cap that ``records`` were read with,
    for the metadata.
    """
    keys = (S.MONTH, target)
    rows = sampling_rows(prepare(records), target)
    narrow = materialise(rows.select(*keys, row_id), "strata-rows")
    counts = strata_counts(narrow, keys)
    quotas = materialise(
        allocate_quotas(counts, target_rows, min_per_group, keys, fill_order), "quotas"
    )
    ids = materialise(choose_rows(narrow, quotas, row_id, keys, seed).select(row_id), "chosen")
    chosen = sampling_rows(prepare(rows_with_ids(records, ids, row_id)), target)
    metadata = sample_metadata(quotas, target_rows, min_per_group, seed, keys, max_rows)
    return chosen.orderBy(S.CREATED, row_id), metadata
