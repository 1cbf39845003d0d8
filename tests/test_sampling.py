import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketry import schema as S
from docketry.catalog import sampling as sampling_catalog
from docketry.operators import sampling as SM
from docketry.session import materialise
from docketry.streaming import files

KEYS = ("sample_month", "NATURE_TARGET")


def dealt_by_hand(rooms, amount, order):
    """One unit per round and group, in the given order of group numbers."""
    given = [0] * len(rooms)
    while amount > 0 and any(r > g for r, g in zip(rooms, given)):
        for i in order:
            if amount and rooms[i] > given[i]:
                given[i] += 1
                amount -= 1
    return given


def quotas_by_hand(groups, target, minimum, largest_first=False):
    groups = {k: n for k, n in groups.items() if n > 0}
    names = sorted(groups)
    n = [groups[k] for k in names]
    target = min(target, sum(n))
    raw = [x / sum(n) * target for x in n]
    low = [min(x, minimum) for x in n]
    share = [min(max(int(np.floor(r)), m), x) for r, m, x in zip(raw, low, n)]
    spread = [s - m for s, m in zip(share, low)]
    room = [x - s for x, s in zip(n, share)]
    gap = sum(share) - target
    if gap > 0:
        order = sorted(range(len(n)), key=lambda i: (-spread[i], names[i]))
        share = [s - c for s, c in zip(share, dealt_by_hand(spread, gap, order))]
    elif gap < 0:
        sign = -1 if largest_first else 1
        part = [r - np.floor(r) for r in raw]
        order = sorted(range(len(n)), key=lambda i: (sign * part[i], sign * room[i], names[i]))
        share = [s + a for s, a in zip(share, dealt_by_hand(room, -gap, order))]
    return dict(zip(names, share))


CASES = [(s, t, m) for s, (t, m) in enumerate([(40, 3), (100, 8), (25, 10), (300, 1), (10_000, 5), (60, 0), (77, 20)])]


@pytest.mark.parametrize("seed,target,minimum", CASES)
@pytest.mark.parametrize("order", ["smallest_remainder", "largest_remainder"])
def test_quotas_match_dealing_by_hand(spark, seed, target, minimum, order):
    rng = random.Random(seed)
    groups = {(f"2020-{m:02d}", c): rng.choice([0, 1, 2, 5, 9, 40, 200]) for m in range(1, 7) for c in "ab"}
    counts = spark.createDataFrame(
        [(m, c, n) for (m, c), n in groups.items()], "sample_month string, NATURE_TARGET string, n bigint"
    )
    found = SM.allocate_quotas(counts, target, minimum, fill_order=order).collect()
    got = {(r[0], r[1]): r["quota"] for r in found}
    assert got == quotas_by_hand(groups, target, minimum, order == "largest_remainder")


def test_fill_goes_to_the_smallest_fraction_then_the_smallest_room(spark):
    frame = spark.createDataFrame(
        [("0", 0.9, 5), ("1", 0.1, 9), ("2", 0.5, 2), ("3", 0.5, 7)], "k string, f double, room bigint"
    )
    for amount, expected in [(1, "1"), (2, "12"), (3, "123"), (4, "0123")]:
        dealt = SM._deal(
            frame, "room", F.lit(amount), [F.col("f"), F.col("room"), F.col("k")], "got"
        )
        assert "".join(sorted(r["k"] for r in dealt.where("got = 1").collect())) == expected


def test_unknown_fill_order(spark):
    counts = spark.createDataFrame([("a", "b", 1)], "sample_month string, NATURE_TARGET string, n bigint")
    with pytest.raises(ValueError):
        SM.allocate_quotas(counts, 1, 1, fill_order="other")


@pytest.fixture(scope="module")
def rows(spark):
    """A third of all rows lies in one group."""
    skewed = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7)
    return spark.range(6000).select(
        F.col("id").alias("row_id"),
        F.concat(F.lit("2020-0"), (skewed + 1).cast("string")).alias("sample_month"),
        F.lit("x").alias("NATURE_TARGET"),
    )


def chosen(rows, seed=42):
    quotas = materialise(SM.allocate_quotas(SM.strata_counts(rows), 900, 20))
    picked = SM.choose_rows(rows, quotas, "row_id", seed=seed)
    return quotas, picked


def test_each_group_yields_its_quota_and_ids_are_unique(rows):
    quotas, picked = chosen(rows)
    per_group = {r[0]: r["count"] for r in picked.groupBy("sample_month").count().collect()}
    assert per_group == {r["sample_month"]: r["quota"] for r in quotas.collect()}
    assert picked.select("row_id").distinct().count() == 900


def test_same_rows_however_partitioned(rows):
    base = {r["row_id"] for r in chosen(rows)[1].collect()}
    assert {r["row_id"] for r in chosen(rows.repartition(9))[1].collect()} == base
    assert {r["row_id"] for r in chosen(rows, seed=1)[1].collect()} != base


def lowest_by_hand(rows, quotas, seed=42):
    """The ids with the smallest scores of each group, by sorting whole groups on the driver."""
    scored = rows.withColumn("s", SM.random_score(seed, F.col("row_id"))).collect()
    groups = {}
    for r in scored:
        groups.setdefault((r["sample_month"], r["NATURE_TARGET"]), []).append((r["s"], r["row_id"]))
    wanted = {(q[0], q[1]): q["quota"] for q in quotas.collect()}
    return sorted(i for k, own in groups.items() for _, i in sorted(own)[: wanted.get(k, 0)])


@pytest.mark.parametrize("band", [0.0, 0.2, 6.0])
def test_missed_bands_do_not_change_the_choice(rows, monkeypatch, band):
    """Without a band, or with a narrow one, the threshold is missed in most groups."""
    monkeypatch.setattr(SM, "BAND", band)
    quotas, picked = chosen(rows)
    assert sorted(r["row_id"] for r in picked.collect()) == lowest_by_hand(rows, quotas)


def test_counts_of_other_rows_do_not_change_the_choice(spark, rows):
    """Wrong group sizes, quotas of none and all rows, one row groups, and groups without rows."""
    extra = spark.createDataFrame([(9000, "2020-09", "x")], "row_id bigint, sample_month string, NATURE_TARGET string")
    rows = rows.unionByName(extra)
    table = [("2020-01", "x", 90, 40), ("2020-02", "x", 10**6, 5), ("2020-03", "x", 571, 0), ("2020-04", "x", 571, 571)]
    table += [("2020-08", "x", 50, 5), ("2020-09", "x", 1, 1)]
    quotas = materialise(spark.createDataFrame(table, "sample_month string, NATURE_TARGET string, n bigint, quota bigint"))
    picked = SM.choose_rows(rows, quotas, "row_id")
    assert sorted(r["row_id"] for r in picked.collect()) == lowest_by_hand(rows, quotas)


def test_only_a_small_share_of_a_group_is_ranked(spark):
    rows = spark.range(200_000).select(F.col("id").alias("row_id"), F.lit("2020-01").alias("sample_month"), F.lit("x").alias("NATURE_TARGET"))
    for quota, most in [(20_000, 0.02), (200_000, 0.001), (10, 0.001)]:
        quotas = materialise(rows.limit(1).select("sample_month", "NATURE_TARGET", F.lit(200_000).alias("n"), F.lit(quota).alias("quota")))
        scored = rows.withColumn("_score", SM.random_score(42, F.col("row_id")))
        cells, ranges = SM.threshold_cells(scored, quotas, "row_id")
        assert ranges.first()["_to"] < 2
        assert 0 < cells.count() <= most * 200_000
        assert SM.choose_rows(rows, quotas, "row_id").count() == quota


def test_subset_is_chronological_and_cleaned_last(spark, rows):
    records = rows.select(
        "row_id",
        F.timestamp_add("DAY", (F.col("row_id") % 90).cast("int"), F.lit("2020-01-01").cast("timestamp_ntz")).alias("creation_ts"),
        F.lit("x").alias("NATURE_TARGET"),
    )
    subset, metadata = SM.representative_subset(
        records, "row_id", 300, 5, prepare=lambda df: df.withColumn("clean", F.lit(1)), max_rows=9999
    )
    stamps = [r["creation_ts"] for r in subset.collect()]
    assert len(stamps) == 300 and stamps == sorted(stamps) and "clean" in subset.columns
    info = metadata.first()
    assert info["sampled_rows"] == 300 and info["max_rows"] == 9999
    assert info["source_rows_with_valid_time_and_nature"] == 6000
    assert sum(info["monthly_nature_sampled_counts"].values()) == 300
    assert set(info["monthly_nature_counts"]) == {"2020-01|x", "2020-02|x", "2020-03|x"}


def test_pruned_scan_reads_two_columns(spark):
    counts = sampling_catalog.pruned_scan_counts(spark, "/root/testdata/sf0.001")
    plan = counts._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all(s == f"{S.CREATED}:string,{S.TARGET}:string" for s in schemas)


def test_streaming_scan_without_line_breaks(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("v,w\n" + "".join(f"{i},NA\n" for i in range(50)))
    raw = files.read_arriving(spark, str(folder), ["v", "w"], encoding="UTF-8", multi_line=False)
    out = str(tmp_path / "out")
    query = raw.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "check"))
    query.trigger(availableNow=True).start().awaitTermination()
    found = spark.read.parquet(out)
    assert (found.count(), found.where("w IS NOT NULL").count()) == (50, 0)
