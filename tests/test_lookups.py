import statistics

import pytest
from pyspark.sql import functions as F

from docketry.operators.lookups import MedianLookup
from docketry.operators import uncertainty as U

ROWS = (
    [("a", "x", float(v)) for v in (1, 2, 10)]
    + [("a", "y", 100.0), ("b", "x", 7.0), (None, "x", 50.0), ("missing", None, 70.0)]
    + [("hot", "x", float(v % 37)) for v in range(900)]
)


@pytest.fixture(scope="module")
def lookup(spark):
    train = spark.createDataFrame(ROWS, "k string, g string, y double")
    return MedianLookup.fit(train, "k", "g", "y")


def test_medians_at_all_levels(lookup):
    got = {(r["level"], r["first_key"], r["second_key"]): r["median"] for r in lookup.table.collect()}
    rows = [(k or "missing", g or "missing", y) for k, g, y in ROWS]
    want = {("all", None, None): statistics.median(y for *_, y in rows)}
    for k, g, _ in rows:
        want["pair", k, g] = statistics.median(y for a, b, y in rows if (a, b) == (k, g))
        want["first", k, None] = statistics.median(y for a, b, y in rows if a == k)
        want["second", None, g] = statistics.median(y for a, b, y in rows if b == g)
    assert got == pytest.approx(want)


def test_fallback_order(spark, lookup):
    asked = [("a", "x"), ("b", "y"), ("new", "y"), ("new", "new"), (None, "x"), ("new", None)]
    df = spark.createDataFrame([(i, *a) for i, a in enumerate(asked)], "i int, k string, g string")
    got = [r["prediction"] for r in lookup.transform(df).orderBy("i").collect()]
    overall = statistics.median(y for *_, y in ROWS)
    assert got == [2.0, 7.0, 100.0, overall, 50.0, 70.0]


def test_absent_key_columns_share_one_key(spark):
    train = spark.createDataFrame([(1.0,), (3.0,)], "y double")
    lookup = MedianLookup.fit(train, "k", "g", "y")
    assert lookup.transform(train.select("y")).first()["prediction"] == 2.0


@pytest.mark.parametrize("n,index", [(1, 0), (9, 8), (19, 17), (99, 89), (2000, 1800)])
def test_conformal_radius(spark, n, index):
    df = spark.range(n).select((F.col("id") + 0.5).alias("y"), F.lit(0.0).alias("p"))
    row = U.conformal_radius(df, "y", "p", 0.1).first()
    assert (row["rank"], row["radius"]) == (index, index + 0.5)


def test_conformal_rank_in_double_arithmetic(spark):
    sizes = spark.createDataFrame([(9,), (19,), (99,), (24065,)], "n bigint")
    got = [r[0] for r in sizes.select(U.conformal_rank(F.col("n"), 0.1)).collect()]
    assert got == [8, 17, 89, 21659]


def test_conformal_errors(spark):
    df = spark.createDataFrame([(1.0, 1.0)], "y double, p double")
    for alpha in (0.0, 1.0, -1.0):
        with pytest.raises(ValueError):
            U.conformal_radius(df, "y", "p", alpha)
    with pytest.raises(ValueError):
        U.conformal_radius(df.where("y > 5"), "y", "p")


def test_intervals(spark):
    df = spark.createDataFrame([(1.0, 2.0), (5.0, 2.0), (3.0, 2.0), (0.0, 2.0)], "y double, p double")
    table = U.interval_table(df, "y", "p", 1.0)
    assert [r["covered"] for r in table.collect()] == [True, False, True, False]
    row = U.interval_metrics(table).first()
    assert (row["coverage"], row["mean_interval_width"], row["median_interval_width"]) == (0.5, 2.0, 2.0)


def test_calibration_rows_are_covered_often_enough(spark):
    df = spark.range(500).select((F.col("id") * 37 % 101).cast("double").alias("y"), F.lit(50.0).alias("p"))
    radius = U.conformal_radius(df, "y", "p", 0.2)
    assert U.interval_metrics(U.interval_table(df, "y", "p", radius)).first()["coverage"] >= 0.8


def test_a_key_without_targets_still_matches(spark):
    rows = [("x", "p", None), ("x", "q", 5.0), ("y", "p", 7.0), ("z", "r", None)]
    train = spark.createDataFrame(rows, "k string, g string, y double")
    lookup = MedianLookup.fit(train, "k", "g", "y")
    asked = spark.createDataFrame([("x", "p"), ("x", "q"), ("x", "new"), ("z", "new"), ("new", "r"), ("new", "new")], "k string, g string")
    got = {(r["k"], r["g"]): r["prediction"] for r in lookup.transform(asked).collect()}
    assert got == {("x", "p"): None, ("x", "q"): 5.0, ("x", "new"): 5.0, ("z", "new"): None, ("new", "r"): None, ("new", "new"): 6.0}
    assert {r["n"] for r in lookup.table.where("level = 'pair'").collect()} == {0, 1}


def test_intervals_with_a_bound_that_is_no_number(spark):
    rows = [(1.0, 1.0), (2.0, 2.0), (3.0, float("nan")), (9.0, 1.0)]
    table = U.interval_table(spark.createDataFrame(rows, "y double, p double"), "y", "p", 0.5)
    got = U.interval_metrics(table).first()
    assert got["coverage"] == 0.5
    assert got["mean_interval_width"] != got["mean_interval_width"]
    assert got["median_interval_width"] == 1.0


def test_hot_keys_are_spread_over_tasks(spark):
    rows = [(i, None if i % 2 else f"k{i % 900}", None if i % 3 else f"g{i % 40}", float(i % 50)) for i in range(8_000)]
    df = spark.createDataFrame(rows, "i int, k string, g string, y double")
    lookup = MedianLookup.fit(df, "k", "g", "y")
    assert lookup._hot("first") == ["missing"] and lookup._hot("second") == ["missing"]
    wanted = {r["i"]: r["prediction"] for r in lookup.transform(df).collect()}
    pairs = {}
    for _, k, g, y in rows:
        pairs.setdefault((k, g), []).append(y)
    assert wanted == {i: statistics.median(pairs[k, g]) for i, k, g, _ in rows}
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = lookup.transform(df).withColumn("part", F.spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r["i"]: r["prediction"] for r in found} == wanted
    sizes = {}
    for r in found:
        sizes[r["part"]] = sizes.get(r["part"], 0) + 1
    assert max(sizes.values()) < 0.25 * len(rows)
