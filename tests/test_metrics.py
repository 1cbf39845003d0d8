import pytest
from pyspark.sql import functions as F

from docketry.operators import metrics as M

NAN = float("nan")


def counts(spark, pairs, groups=None):
    if groups is None:
        df = spark.createDataFrame(pairs, "a string, p string")
        return M.confusion_counts(df, "a", "p")
    df = spark.createDataFrame([(g, *x) for g, x in zip(groups, pairs)], "g int, a string, p string")
    return M.confusion_counts(df, "a", "p", ["g"])


def test_macro_scores_count_predicted_only_labels(spark):
    row = M.classification_metrics(counts(spark, [("a", "a"), ("a", "b"), ("a", "a")])).first()
    assert row["accuracy"] == pytest.approx(2 / 3)
    assert row["macro_f1"] == pytest.approx((0.8 + 0) / 2)
    assert row["macro_precision"] == pytest.approx(0.5)
    assert row["macro_recall"] == pytest.approx((2 / 3) / 2)


def test_class_report_keeps_order_and_fills_zeros(spark):
    table = M.class_report(counts(spark, [("b", "b"), ("a", "b")]), ["z", "b", "a"]).collect()
    assert [tuple(r) for r in table] == [
        ("z", 0.0, 0.0, 0.0, 0),
        ("b", 0.5, 1.0, pytest.approx(2 / 3), 1),
        ("a", 0.0, 0.0, 0.0, 1),
    ]


def test_confusion_matrix_ignores_other_labels(spark):
    pairs = [("a", "a"), ("a", "b"), ("x", "a"), ("b", "x")]
    table = M.confusion_matrix(counts(spark, pairs), ["b", "a", "c"]).collect()
    assert [tuple(r) for r in table] == [("b", 0, 0, 0), ("a", 1, 1, 0), ("c", 0, 0, 0)]


def test_group_metrics(spark):
    pairs = [("a", "a")] * 3 + [("b", "a")] * 2 + [("a", "a")]
    found = M.metrics_by_group(
        counts(spark, pairs, [10, 10, 10, 10, 10, 9]), "g", ["a", "b", "c", "d"], min_count=2
    )
    row = found.collect()
    assert [tuple(r) for r in row] == [("10", 5, 0.6, pytest.approx((6 / 8) / 4))]


def test_groups_come_in_number_order_as_text(spark):
    groups = [10, 9, 2, None]
    found = M.metrics_by_group(counts(spark, [("a", "a")] * 4, groups), "g", ["a"], min_count=1)
    assert [r["group"] for r in found.collect()] == ["2", "9", "10"]


def scored(spark, rows):
    return spark.createDataFrame(rows, "y string, q array<double>")


def test_brier(spark):
    df = scored(spark, [("A", [0.8, 0.2]), ("B", [0.3, 0.7])])
    assert M.multiclass_brier(df, "y", "q", ["A", "B"]).first()[0] == pytest.approx((0.08 + 0.18) / 2)


def test_brier_rejects_unknown_labels(spark):
    with pytest.raises(Exception, match="label not in the label list"):
        M.multiclass_brier(scored(spark, [("C", [0.8, 0.2])]), "y", "q", ["A", "B"]).collect()


def test_first_label_wins_a_tie(spark):
    df = scored(spark, [("", [0.3, 0.4, 0.4])])
    assert df.select(M.argmax_label(F.col("q"), ["a", "b", "c"])).first()[0] == "b"


BINS = [
    (0.0, 0), (0.1, 0), (0.3, 2), (0.30000000000000004, 2), (0.6, 5), (0.7, 6), (0.9, 8), (1.0, 9),
    (1.0000000001, 9), (NAN, 9), (0.05, 0), (0.95, 9),
]


def test_reliability_bins(spark):
    for confidence, bin_number in BINS:
        df = scored(spark, [("a", [confidence])])
        row = M.reliability_table(df, "y", "q", ["a"]).collect()
        assert [r["bin"] for r in row] == [bin_number]


def test_reliability_counts_sum_up(spark):
    df = spark.range(500).select(
        F.lit("a").alias("y"), F.array(F.col("id") / 500, 1 - F.col("id") / 500).alias("q")
    )
    assert M.reliability_table(df, "y", "q", ["a", "b"]).agg(F.sum("count")).first()[0] == 500


def test_best_model_needs_a_strict_gain(spark):
    rows = [(0, "x", NAN), (1, "a", 0.5), (2, "b", 0.5), (3, "c", None), (4, "d", 0.4)]
    df = spark.createDataFrame(rows, "position int, model string, s double")
    assert M.best_model(df, "s", True).first()["model"] == "a"
    assert M.best_model(df, "s", False).first()["model"] == "d"
    order = [r["model"] for r in M.compare_models(df.where("model <> 'x'"), "s", True).collect()]
    assert order == ["a", "b", "d", "c"]


def test_top_coefficients(spark):
    rows = [("g", "u", -3.0), ("g", "v", 2.0), ("g", "w", 3.0), ("h", "u", 0.0)]
    df = spark.createDataFrame(rows, "group string, feature string, coefficient double")
    got = [tuple(r)[:3] + (r["direction"],) for r in M.top_coefficients(df, 2).orderBy("group", "rank").collect()]
    assert got == [("g", 1, "u", "negative"), ("g", 2, "w", "positive"), ("h", 1, "u", "positive")]


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 3.5)], "y double, p double")
    row = M.regression_metrics(df, "y", "p").first()
    assert (row["mae"], row["rmse"]) == (1.0, pytest.approx(1.25**0.5))


def test_one_pass_evaluation(spark):
    rows = [(i, "abc"[i % 3], "xyz"[i % 7 % 3] if i % 5 else None, (i * 37) % 11 / 10 / 2, (i * 53) % 7 / 7 / 2) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, k string, g string, p double, q double").select(
        "id", "k", "g", F.lit(1).alias("month"), F.array("p", "q", 1 - F.col("p") - F.col("q")).alias("probability")
    )
    labels = ["a", "b", "c"]
    df = df.withColumn("prediction", M.argmax_label(F.col("probability"), labels))
    table = M.evaluation_table(df, "k", "prediction", "probability", labels, ["g", "month"]).cache()
    rows_of = lambda t: sorted(map(tuple, t.collect()), key=str)
    assert rows_of(M.evaluation_counts(table).drop("brier")) == rows_of(M.confusion_counts(df, "k", "prediction"))
    for g in ("g", "month"):
        assert rows_of(M.evaluation_counts(table, g).drop("brier")) == rows_of(M.confusion_counts(df, "k", "prediction", [g]))
    for got, want in zip(M.evaluation_reliability(table).collect(), M.reliability_table(df, "k", "probability", labels).collect(), strict=True):
        assert tuple(got) == pytest.approx(tuple(want))
    brier = M.evaluation_counts(table).agg(F.sum("brier") / F.sum("n")).first()[0]
    assert brier == pytest.approx(M.multiclass_brier(df, "k", "probability", labels).first()[0])
