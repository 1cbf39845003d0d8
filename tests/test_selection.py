import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from docketry.operators.selection import (
    exact_quantile,
    exact_rank,
    select_ranks,
    value_cells,
)

@pytest.fixture(scope="module")
def values():
    rng = random.Random(5)
    rows = [("hot", rng.expovariate(0.01)) for _ in range(3000)]
    rows += [("ties", float(rng.choice([1, 2, 2, 3]))) for _ in range(500)]
    rows += [("wide", rng.choice([-1, 1]) * 10 ** rng.uniform(-9, 12)) for _ in range(400)]
    rows += [("one", 4.5)]
    return rows


@pytest.mark.parametrize("p", [0.5, 0.25, 0.9])
def test_grouped_quantiles(spark, values, p):
    cells = value_cells(spark.createDataFrame(values, "g string, v double"), ["g"], "v")
    found = exact_quantile(cells, ["g"], "v", p, "q")
    got = {r["g"]: (r["q"], r["n"]) for r in found.collect()}
    for group in {g for g, _ in values}:
        numbers = sorted(v for g, v in values if g == group)
        place = (len(numbers) - 1) * p
        a, b = numbers[math.floor(place)], numbers[math.ceil(place)]
        share = place - math.floor(place)
        assert got[group][0] == pytest.approx(a * (1 - share) + b * share, rel=1e-12)
        assert got[group][1] == len(numbers)


def test_median_of_whole_table(spark, values):
    numbers = [v for _, v in values]
    cells = value_cells(spark.createDataFrame(values, "g string, v double"), [], "v")
    found = exact_quantile(cells, [], "v", 0.5, "q").first()
    assert found["q"] == pytest.approx(statistics.median(numbers), rel=1e-12)


def test_every_rank(spark):
    numbers = [-3.0, -0.001, 0.0, 0.001, 0.5, 2.0, 2.0, 7.0]
    cells = value_cells(spark.createDataFrame([(n,) for n in numbers], "v double"), [], "v")
    for k in range(len(numbers)):
        found = exact_rank(cells, "v", lambda n, k=k: F.lit(k), "x").first()
        assert found["x"] == sorted(numbers)[k]


def test_tied_values_fall_back_to_the_tiebreak(spark):
    rows = [("a", 0.5, i) for i in range(50)]
    cells = spark.createDataFrame(rows, "g string, v double, id bigint").withColumn(
        "_n", F.lit(1).cast("bigint")
    )
    found = select_ranks(
        cells, ["g"], "v", lambda _: F.lit(9), lambda _: F.lit(9),
        tiebreak=["id"],
    )
    assert [r["id"] for r in found.collect()] == [9]


@pytest.mark.parametrize("number", [lambda i: i * 1e-12, lambda i: 1.7e9 + i / 100])
def test_crowded_values_are_split(spark, number):
    """100,000 close values: the median is exact, and no part of the sorted cells holds them all."""
    n = 100_001
    rows = spark.range(n).select(
        (F.col("id") * 1e-12 if number(1) < 1 else F.lit(1.7e9) + F.col("id") / 100).alias("v")
    )
    cells = value_cells(rows, [], "v")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = cells.repartitionByRange(parts, "v").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 0.5 * n
    assert exact_quantile(cells, [], "v", 0.5, "q").first()["q"] == pytest.approx(number(n // 2), rel=1e-12)


def test_nulls_and_nan_are_left_out(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "v double")
    assert exact_quantile(value_cells(df, [], "v"), [], "v", 0.5, "q").first()["q"] == 2.0
