"""Metrics of classifications: all from confusion counts of scored orders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.catalog import bindings as B
from docketry.models.classifiers import class_weights as weights_table
from docketry.models.classifiers import mean_coefficients
from docketry.operators import metrics as M
from docketry.plans import report

QUERIES, ORACLES, register = B.registrar()

LABELS = list(B.PRIORITIES)


def scores_sql(source: str, keys: str = "") -> str:
    """Per-label scores of ``source(keys, actual, prediction)`` as ``label_scores``."""
    k = f"{keys}, " if keys else ""
    return f"""
sides AS (SELECT {k}actual AS label, 1 AS support, 0 AS guessed, (actual = prediction)::INTEGER AS hits FROM {source}
          UNION ALL SELECT {k}prediction, 0, 1, 0 FROM {source}),
label_sums AS (SELECT {k}label, sum(support)::BIGINT AS support, sum(guessed)::BIGINT AS guessed, sum(hits)::BIGINT AS hits
               FROM sides GROUP BY ALL),
label_scores AS (SELECT {k}label, support, hits,
                        coalesce(hits / nullif(guessed, 0)::DOUBLE, 0) AS precision,
                        coalesce(hits / nullif(support, 0)::DOUBLE, 0) AS recall,
                        coalesce(2 * hits / nullif(support + guessed, 0)::DOUBLE, 0) AS f1 FROM label_sums)
"""


SCORED_SQL = f"WITH {B.scored_sql()}, {scores_sql('scored')}"

MACRO_SQL = """round(sum(hits) / sum(support)::DOUBLE, 6) AS accuracy, round(avg(f1), 6) AS macro_f1,
       round(avg(precision), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall"""

BRIER_SQL = """list_sum(list_transform(probability, lambda p, i: pow(p - (i = list_position(
       ['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'], actual))::INTEGER, 2)))"""


def _counts(spark, sf_dir, groups=()):
    scored = B.scored_orders(spark, sf_dir)
    return M.confusion_counts(scored, "actual", "prediction", groups)


@register(
    "confusion_counts",
    f"WITH {B.scored_sql()} SELECT actual, prediction AS predicted, count(*) AS n FROM scored GROUP BY ALL",
)
def confusion_counts(spark, sf_dir):
    return _counts(spark, sf_dir)


@register(
    "argmax_label",
    f"WITH {B.scored_sql()} SELECT o_orderkey, prediction FROM scored",
)
def argmax_label(spark, sf_dir):
    return B.scored_orders(spark, sf_dir).select("o_orderkey", "prediction")


@register("classification_metrics", SCORED_SQL + f"SELECT {MACRO_SQL} FROM label_scores")
def classification_metrics(spark, sf_dir):
    return B.rounded(M.classification_metrics(_counts(spark, sf_dir)))


@register(
    "brier_multiclass",
    f"WITH {B.scored_sql()} SELECT round(avg({BRIER_SQL}), 6) AS multiclass_brier FROM scored",
)
def brier_multiclass(spark, sf_dir):
    scored = B.scored_orders(spark, sf_dir)
    return B.rounded(M.multiclass_brier(scored, "actual", "probability", LABELS))


# One more label than the data have, which must appear with zeros.
REPORT_LABELS = [*LABELS, "9-NONE"]
REPORT_SQL = (
    SCORED_SQL
    + """, report AS (SELECT l.label, round(coalesce(precision, 0), 6) AS precision, round(coalesce(recall, 0), 6) AS recall,
       round(coalesce(f1, 0), 6) AS f1, coalesce(support, 0) AS support
       FROM (SELECT unnest(["""
    + ", ".join(f"'{v}'" for v in REPORT_LABELS)
    + """]) AS label) l LEFT JOIN label_scores s ON s.label = l.label) """
)


@register("class_report", REPORT_SQL + "SELECT * FROM report")
def class_report(spark, sf_dir):
    return B.rounded(M.class_report(_counts(spark, sf_dir), REPORT_LABELS))


@register("minority_classes", REPORT_SQL + "SELECT * FROM report WHERE support < 3000 ORDER BY support")
def minority_classes(spark, sf_dir):
    table = M.class_report(_counts(spark, sf_dir), REPORT_LABELS)
    return B.rounded(report.minority_classes(table, 3000))


@register("series_f1_by_class", REPORT_SQL + "SELECT label, f1 FROM report")
def series_f1_by_class(spark, sf_dir):
    table = M.class_report(_counts(spark, sf_dir), REPORT_LABELS)
    return B.rounded(report.f1_by_class(table))


@register(
    "confusion_matrix",
    f"WITH {B.scored_sql()}, {B.LABEL_LIST_SQL} SELECT label AS actual, "
    + ", ".join(f"count(*) FILTER (prediction = '{v}') AS \"{v}\"" for v in LABELS)
    + " FROM labels_list LEFT JOIN scored ON actual = label GROUP BY label",
)
def confusion_matrix(spark, sf_dir):
    return M.confusion_matrix(_counts(spark, sf_dir), LABELS)


GROUPED_SQL = f"""SELECT "group"::VARCHAR AS "group", sum(support)::BIGINT AS count,
       round(sum(hits) / sum(support)::DOUBLE, 6) AS accuracy, round(sum(f1) / {len(LABELS)}.0::DOUBLE, 6) AS macro_f1
       FROM label_scores WHERE "group" IS NOT NULL GROUP BY "group" HAVING sum(support) >= 50 """


@register(
    "metrics_by_group",
    f"""WITH {B.scored_sql()}, grouped AS (SELECT scored.*, CASE WHEN n_nationkey <> 3 THEN n_name END AS "group" FROM scored
        JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
        {scores_sql('grouped', '"group"')} {GROUPED_SQL}""",
)
def metrics_by_group(spark, sf_dir):
    """Orders by nation of the customer; one nation is null and must disappear."""
    customer = B.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey")
    )
    nation = B.table(spark, sf_dir, "nation")
    name = F.when(F.col("n_nationkey") != 3, F.col("n_name"))
    grouped = (
        B.scored_orders(spark, sf_dir)
        .join(customer, "o_custkey")
        .join(nation, "n_nationkey")
        .withColumn("place", name)
    )
    counts = M.confusion_counts(grouped, "actual", "prediction", ["place"])
    return B.rounded(M.metrics_by_group(counts, "place", LABELS))


BY_MONTH_SQL = f"""WITH {B.scored_sql()}, grouped AS (SELECT *, month(o_orderdate) AS "group" FROM scored),
       {scores_sql('grouped', '"group"')} """


def _by_month(spark, sf_dir):
    scored = B.scored_orders(spark, sf_dir).withColumn("month", F.month("o_orderdate"))
    return M.metrics_by_group(
        M.confusion_counts(scored, "actual", "prediction", ["month"]), "month", LABELS
    )


@register("metrics_by_group_month", BY_MONTH_SQL + GROUPED_SQL)
def metrics_by_group_month(spark, sf_dir):
    return B.rounded(_by_month(spark, sf_dir))


@register(
    "series_f1_by_month",
    BY_MONTH_SQL + f'SELECT "group" AS month, macro_f1 FROM ({GROUPED_SQL})',
)
def series_f1_by_month(spark, sf_dir):
    return B.rounded(report.f1_by_month(_by_month(spark, sf_dir)))


@register(
    "reliability_table",
    f"""WITH {B.scored_sql()}, binned AS (SELECT list_max(probability) AS confidence, (prediction = actual)::INTEGER AS correct,
          least(greatest(len(list_filter(range(11), lambda i: (CASE WHEN i = 10 THEN 1.0::DOUBLE ELSE i * 0.1::DOUBLE END)
                                                              < list_max(probability))) - 1, 0), 9)::INTEGER AS bin
        FROM scored)
        SELECT bin, round(avg(confidence), 6) AS avg_confidence, round(avg(correct), 6) AS accuracy, count(*) AS count
        FROM binned GROUP BY bin""",
)
def reliability_table(spark, sf_dir):
    scored = B.scored_orders(spark, sf_dir)
    return B.rounded(M.reliability_table(scored, "actual", "probability", LABELS))


@register(
    "evaluation_one_pass",
    f"""WITH {B.scored_sql()}, terms AS (
          SELECT actual, prediction AS predicted, month(o_orderdate) AS month, list_max(probability) AS confidence,
                 (prediction = actual)::INTEGER AS correct,
                 least(greatest(len(list_filter(range(11), lambda i: (CASE WHEN i = 10 THEN 1.0::DOUBLE ELSE i * 0.1::DOUBLE END)
                                                              < list_max(probability))) - 1, 0), 9)::INTEGER AS bin,
                 list_sum(list_transform(range(5), lambda i: pow(probability[i + 1] - ([{", ".join(f"'{p}'" for p in B.PRIORITIES)}][i + 1] = actual)::INTEGER, 2))) AS brier
          FROM scored)
        SELECT CASE WHEN grouping(bin) = 0 THEN 'bin' WHEN grouping(month) = 0 THEN 'actual,predicted,month' ELSE 'actual,predicted' END AS "set",
               actual, predicted, bin, month::INTEGER AS month, count(*) AS n, round(sum(confidence), 6) AS confidence,
               round(sum(correct), 6)::DOUBLE AS correct, round(sum(brier), 6) AS brier
        FROM terms GROUP BY GROUPING SETS ((actual, predicted), (actual, predicted, month), (bin))""",
)
def evaluation_one_pass(spark, sf_dir):
    """The counts and sums behind every classification report, from one pass over the scored rows."""
    scored = B.scored_orders(spark, sf_dir).withColumn("month", F.month("o_orderdate"))
    return B.rounded(M.evaluation_table(scored, "actual", "prediction", "probability", LABELS, ["month"]))


# --- model comparison -----------------------------------------------------------------------

# Three score rules stand for three models; the last equals the first and so ties with it.
RULES = {"rule_a": B.MULTIPLIERS, "rule_b": (43, 31, 47, 37, 41), "rule_c": B.MULTIPLIERS}


def _comparison(spark, sf_dir) -> DataFrame:
    rows = []
    for position, (name, multipliers) in enumerate(RULES.items()):
        scored = B.scored_orders(spark, sf_dir, multipliers)
        found = M.classification_metrics(M.confusion_counts(scored, "actual", "prediction"))
        rows.append(
            found.select(
                F.lit(position).alias("position"), F.lit(name).alias("model"), "accuracy", "macro_f1"
            )
        )
    # A model that failed has no metrics.
    empty = rows[0].select(
        F.lit(len(RULES)).alias("position"),
        F.lit("failed").alias("model"),
        F.lit(None).cast("double").alias("accuracy"),
        F.lit(None).cast("double").alias("macro_f1"),
    )
    return reduce(DataFrame.unionByName, [*rows, empty])


def _comparison_sql() -> str:
    parts = ["WITH " + ", ".join(B.scored_sql(m, n) for n, m in RULES.items())]
    lines = []
    for position, name in enumerate(RULES):
        lines.append(
            f"""(WITH {scores_sql(name)} SELECT {position}::INTEGER AS position, '{name}' AS model,
                round(sum(hits) / sum(support)::DOUBLE, 6) AS accuracy, round(avg(f1), 6) AS macro_f1 FROM label_scores)"""
        )
    lines.append(f"(SELECT {len(RULES)}::INTEGER, 'failed', NULL::DOUBLE, NULL::DOUBLE)")
    return parts[0] + ", results AS (" + " UNION ALL ".join(lines) + ") "


@register("model_comparison", _comparison_sql() + "SELECT * FROM results ORDER BY macro_f1 DESC NULLS LAST, position")
def model_comparison(spark, sf_dir):
    return M.compare_models(B.rounded(_comparison(spark, sf_dir)), "macro_f1", True)


@register(
    "best_model_pick",
    _comparison_sql()
    + "SELECT model, macro_f1 FROM results WHERE macro_f1 IS NOT NULL ORDER BY macro_f1 DESC, position LIMIT 1",
)
def best_model_pick(spark, sf_dir):
    return M.best_model(B.rounded(_comparison(spark, sf_dir)), "macro_f1", True)


# --- labels and weights ---------------------------------------------------------------------


@register("label_universe", "SELECT DISTINCT o_orderpriority AS label FROM orders ORDER BY 1")
def label_universe(spark, sf_dir):
    orders = B.table(spark, sf_dir, "orders")
    return orders.select(F.col("o_orderpriority").alias("label")).distinct().orderBy("label")


WEIGHT_SQL = """WITH c AS (SELECT quality AS label, count(*) AS n FROM labels GROUP BY quality),
       w AS (SELECT label, n, round(n / (sum(n) OVER ())::DOUBLE, 6) AS prior,
                    round((sum(n) OVER ())::DOUBLE / (count(*) OVER () * n), 6) AS weight FROM c) """


@register("class_prior", WEIGHT_SQL + "SELECT label, n, prior FROM w")
def class_prior(spark, sf_dir):
    return B.rounded(weights_table(B.table(spark, sf_dir, "labels"), "quality").drop("weight"))


@register("class_weights", WEIGHT_SQL + "SELECT label, n, weight FROM w")
def class_weights(spark, sf_dir):
    return B.rounded(weights_table(B.table(spark, sf_dir, "labels"), "quality").drop("prior"))


# --- coefficients ---------------------------------------------------------------------------


@register(
    "topn_abs_per_group",
    """WITH weights AS (SELECT p_type AS "group", 'part_' || p_partkey AS feature,
              ((p_partkey * 7919) % 2001 - 1000) / 1000.0::DOUBLE AS coefficient FROM part),
       ranked AS (SELECT *, row_number() OVER (PARTITION BY "group" ORDER BY abs(coefficient) DESC, feature)::INTEGER AS rank
                  FROM weights)
       SELECT "group", rank, feature, coefficient, abs(coefficient) AS abs_coefficient,
              CASE WHEN coefficient >= 0 THEN 'positive' ELSE 'negative' END AS direction FROM ranked WHERE rank <= 20""",
)
def topn_abs_per_group(spark, sf_dir):
    weight = ((F.col("p_partkey") * 7919) % 2001 - 1000) / F.lit(1000.0)
    parts = B.table(spark, sf_dir, "part").select(
        F.col("p_type").alias("group"),
        F.concat(F.lit("part_"), F.col("p_partkey").cast("string")).alias("feature"),
        weight.alias("coefficient"),
    )
    return M.top_coefficients(parts)


@register(
    "coef_fold_mean",
    """SELECT p_brand AS "group", p_name AS feature, round(avg(p_size), 6) AS coefficient FROM part GROUP BY ALL""",
)
def coef_fold_mean(spark, sf_dir):
    parts = B.table(spark, sf_dir, "part").select(
        (F.col("p_partkey") % 3).alias("fold"),
        F.col("p_brand").alias("group"),
        F.col("p_name").alias("feature"),
        F.col("p_size").cast("double").alias("coefficient"),
    )
    return B.rounded(mean_coefficients(parts))
