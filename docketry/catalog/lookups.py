"""Median lookups and what is predicted with them."""

from __future__ import annotations

from pyspark.sql import functions as F

from docketry import schema as S
from docketry.catalog import bindings as B
from docketry.operators import frames, metrics, uncertainty
from docketry.operators.lookups import MedianLookup, median_levels
from docketry.models.registry import ModelSpec
from docketry.models.regressors import MedianRegressor
from docketry.plans import report
from docketry.plans.workflows import conformal_run, train_regression
from docketry.session import materialise

QUERIES, ORACLES, register = B.registrar()

KEYS = ("ACTI_NOM", "ARRONDISSEMENT")


def median_sql(where: str) -> str:
    return f"""
medians AS (
  SELECT CASE grouping(activity) * 2 + grouping(borough) WHEN 0 THEN 'pair' WHEN 1 THEN 'first'
              WHEN 2 THEN 'second' ELSE 'all' END AS level,
         activity AS first_key, borough AS second_key, median(days) AS median, count(*) AS n
  FROM durations WHERE {where} GROUP BY GROUPING SETS ((activity, borough), (activity), (borough), ())),
predicted AS (
  SELECT d.*, CASE WHEN p.level IS NOT NULL THEN p.median WHEN f.level IS NOT NULL THEN f.median
                   WHEN s.level IS NOT NULL THEN s.median
                   ELSE (SELECT median FROM medians WHERE level = 'all') END AS prediction
  FROM durations d
  LEFT JOIN medians p ON p.level = 'pair' AND p.first_key = activity AND p.second_key = borough
  LEFT JOIN medians f ON f.level = 'first' AND f.first_key = activity
  LEFT JOIN medians s ON s.level = 'second' AND s.second_key = borough)
"""


PREDICTED_SQL = f"WITH {B.LINE_SQL}, {median_sql(chr(39).join(['split = ', 'train', '']))}"


def _stored(spark, sf_dir):
    """The joined records once; fit and predict read the stored columns."""
    return materialise(
        B.duration_records(spark, sf_dir).select(*B.LINE_KEY, S.DURATION, "split", *KEYS), "durations"
    )


def _predicted(spark, sf_dir):
    records = _stored(spark, sf_dir)
    lookup = MedianLookup.fit(records.where("split = 'train'"), *KEYS, S.DURATION)
    return lookup.transform(records)


@register(
    "median_grouping_sets",
    PREDICTED_SQL + "SELECT level, first_key, second_key, median, n FROM medians",
)
def median_grouping_sets(spark, sf_dir):
    train = B.duration_records(spark, sf_dir).where("split = 'train'")
    return median_levels(train, *KEYS, S.DURATION)


@register(
    "median_lookup_predict",
    PREDICTED_SQL + "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, split, days AS actual, prediction FROM predicted",
)
def median_lookup_predict(spark, sf_dir):
    return _predicted(spark, sf_dir).select(
        *B.LINE_KEY, "split", F.col(S.DURATION).alias("actual"), "prediction"
    )


@register(
    "median_lookup_metrics",
    PREDICTED_SQL
    + """SELECT split, count(*) AS n_rows, round(avg(abs(days - prediction)), 6) AS mae,
         round(sqrt(avg((days - prediction) * (days - prediction))), 6) AS rmse FROM predicted GROUP BY split""",
)
def median_lookup_metrics(spark, sf_dir):
    """Fit on train, predict every split, one aggregate for all errors."""
    gap = F.col(S.DURATION) - F.col("prediction")
    return B.rounded(
        _predicted(spark, sf_dir)
        .groupBy("split")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.avg(F.abs(gap)).alias("mae"),
            F.sqrt(F.avg(gap * gap)).alias("rmse"),
        )
    )


@register(
    "regression_metrics",
    PREDICTED_SQL
    + """SELECT round(avg(abs(days - prediction)), 6) AS mae,
         round(sqrt(avg((days - prediction) * (days - prediction))), 6) AS rmse FROM predicted WHERE split = 'validation'""",
)
def regression_metrics(spark, sf_dir):
    scored = _predicted(spark, sf_dir).where("split = 'validation'")
    return B.rounded(metrics.regression_metrics(scored, S.DURATION, "prediction"))


# A borough whose targets are all null: its pairs and its own level still match, with a null median.
NO_TARGET = "BUILDING"
NULLED_SQL = PREDICTED_SQL.replace("FROM durations", "FROM known").replace("count(*) AS n", "count(days) AS n").replace(
    "medians AS (",
    f"known AS (SELECT * REPLACE (CASE WHEN borough <> '{NO_TARGET}' THEN days END AS days) FROM durations),\nmedians AS (",
)


@register(
    "median_lookup_null_key",
    NULLED_SQL
    + """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, borough, prediction FROM predicted
         UNION ALL SELECT NULL, NULL, NULL, n, level || '|' || coalesce(first_key, '') || '|' || coalesce(second_key, ''),
         median FROM medians""",
)
def median_lookup_null_key(spark, sf_dir):
    """Predictions, and below them the levels of the fitted table."""
    records = _stored(spark, sf_dir)
    target = F.when(F.col("ARRONDISSEMENT") != NO_TARGET, F.col(S.DURATION))
    records = records.withColumn(S.DURATION, target)
    lookup = MedianLookup.fit(records.where("split = 'train'"), *KEYS, S.DURATION)
    scored = lookup.transform(records).select(*B.LINE_KEY, F.col("ARRONDISSEMENT").alias("borough"), "prediction")
    none = F.lit(None).cast("bigint")
    name = F.concat_ws("|", "level", F.coalesce("first_key", F.lit("")), F.coalesce("second_key", F.lit("")))
    levels = lookup.table.select(
        *[none.alias(c) for c in B.LINE_KEY[:3]], F.col("n").alias(B.LINE_KEY[3]), name.alias("borough"),
        F.col("median").alias("prediction"),
    )
    return scored.unionByName(levels)


# --- intervals ------------------------------------------------------------------------------


def radius_sql(where: str, alpha: float = 0.1) -> str:
    return f"""
errors AS (SELECT abs(days - prediction) AS error, row_number() OVER (ORDER BY abs(days - prediction)) - 1 AS place,
                  count(*) OVER () AS n FROM predicted WHERE {where}),
radius AS (SELECT error AS radius, place AS rank FROM errors
           WHERE place = least(greatest(ceil((n + 1)::DOUBLE * {1.0 - alpha!r}::DOUBLE)::BIGINT - 1, 0), n - 1)),
bounds AS (SELECT *, prediction - radius AS lower_bound, prediction + radius AS upper_bound
           FROM predicted, radius WHERE split = 'test'),
intervals AS (SELECT *, days >= lower_bound AND days <= upper_bound AS covered FROM bounds)
"""


INTERVAL_SQL = PREDICTED_SQL + "," + radius_sql("split = 'validation'")


def _radius(scored):
    return uncertainty.conformal_radius(
        scored.where("split = 'validation'"), S.DURATION, "prediction", 0.1
    )


def _intervals(spark, sf_dir):
    scored = materialise(_predicted(spark, sf_dir), "scored")
    return uncertainty.interval_table(
        scored.where("split = 'test'"), S.DURATION, "prediction", _radius(scored), keep=B.LINE_KEY
    )


@register("conformal_radius", INTERVAL_SQL + "SELECT radius, rank FROM radius")
def conformal_radius(spark, sf_dir):
    return _radius(_predicted(spark, sf_dir))


@register(
    "interval_table",
    INTERVAL_SQL
    + """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, days AS actual, prediction, lower_bound, upper_bound,
         covered FROM intervals""",
)
def interval_table(spark, sf_dir):
    return _intervals(spark, sf_dir)


METRICS_SQL = """round(avg(covered::INTEGER), 6) AS coverage, round(avg(upper_bound - lower_bound), 6) AS mean_interval_width,
         round(median(upper_bound - lower_bound), 6) AS median_interval_width"""


@register("interval_metrics", INTERVAL_SQL + f"SELECT {METRICS_SQL} FROM intervals")
def interval_metrics(spark, sf_dir):
    return B.rounded(uncertainty.interval_metrics(_intervals(spark, sf_dir)))


@register(
    "interval_metrics_nan",
    INTERVAL_SQL
    + """, marked AS (SELECT CASE WHEN l_linenumber = 1 THEN 'NaN'::DOUBLE ELSE lower_bound END AS lower_bound,
         CASE WHEN l_linenumber = 1 THEN 'NaN'::DOUBLE ELSE upper_bound END AS upper_bound, covered, l_linenumber FROM intervals)
       SELECT round(avg((covered AND l_linenumber <> 1)::INTEGER), 6) AS coverage,
              round(avg(upper_bound - lower_bound), 6) AS mean_interval_width,
              round(median(upper_bound - lower_bound) FILTER (l_linenumber <> 1), 6) AS median_interval_width FROM marked""",
)
def interval_metrics_nan(spark, sf_dir):
    """A third of the predictions is not a number: those rows are not covered, and the mean width is no number."""
    scored = materialise(_predicted(spark, sf_dir), "scored")
    radius = _radius(scored)
    broken = F.when(F.col("l_linenumber") == 1, F.lit(float("nan"))).otherwise(F.col("prediction"))
    test = scored.where("split = 'test'").withColumn("prediction", broken)
    intervals = uncertainty.interval_table(test, S.DURATION, "prediction", radius)
    return B.rounded(uncertainty.interval_metrics(intervals))


HEAD_SQL = """(SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, days AS actual, prediction, lower_bound,
               upper_bound, covered FROM intervals ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber LIMIT {n})"""


def _head(spark, sf_dir, take, n):
    intervals = _intervals(spark, sf_dir)
    return take(intervals.withColumn("line", F.struct(*B.LINE_KEY)), "line", n).drop("line")


@register("interval_head", INTERVAL_SQL + f"SELECT * FROM {HEAD_SQL.format(n=10)}")
def interval_head(spark, sf_dir):
    return _head(spark, sf_dir, report.first_intervals, 10)


@register("interval_head_sorted", INTERVAL_SQL + f"SELECT * FROM {HEAD_SQL.format(n=60)} ORDER BY prediction")
def interval_head_sorted(spark, sf_dir):
    return _head(spark, sf_dir, report.interval_series, 60)


MEDIAN_SPEC = ModelSpec("conditional_median_lookup", "activity_borough_lookup", MedianRegressor)


def _with_id(records):
    return records.withColumn("row_id", F.col("l_orderkey"))


@register("conformal_workflow", INTERVAL_SQL + f"SELECT radius, {METRICS_SQL} FROM intervals GROUP BY radius")
def conformal_workflow(spark, sf_dir):
    """Radius on validation and coverage on test, from a model fitted on train alone."""
    records = _with_id(_stored(spark, sf_dir))
    splits = [records.where(F.col("split") == s) for s in frames.SPLITS]
    radius, intervals = conformal_run(MEDIAN_SPEC, *splits, S.DURATION, "row_id", 0.1)
    found = uncertainty.interval_metrics(intervals)
    return B.rounded(found.withColumn("radius", radius.select("radius").scalar()))


@register(
    "refit_test_metrics",
    f"WITH {B.LINE_SQL}, {median_sql(chr(39).join(['split <> ', 'test', '']))}"
    + """SELECT round(avg(abs(days - prediction)), 6) AS mae,
         round(sqrt(avg((days - prediction) * (days - prediction))), 6) AS rmse FROM predicted WHERE split = 'test'""",
)
def refit_test_metrics(spark, sf_dir):
    records = _stored(spark, sf_dir)
    lookup = MedianLookup.fit(frames.train_and_validation(records), *KEYS, S.DURATION)
    scored = lookup.transform(records.where("split = 'test'"))
    return B.rounded(metrics.regression_metrics(scored, S.DURATION, "prediction"))


@register(
    "report_interval_summary",
    INTERVAL_SQL
    + """SELECT 0.1::DOUBLE AS alpha, 0.9::DOUBLE AS nominal_coverage, round(avg(covered::INTEGER), 6) AS observed_coverage,
         max(radius) AS interval_radius_days, round(avg(upper_bound - lower_bound), 6) AS mean_interval_width_days
         FROM intervals""",
)
def report_interval_summary(spark, sf_dir):
    records = _with_id(_stored(spark, sf_dir))
    run = train_regression(records, S.DURATION, "row_id", 0.1, specs=[MEDIAN_SPEC])
    return B.rounded(report.interval_summary(run.summary))
