"""Classification and regression metrics.

Every classification table derives from one aggregate, the confusion counts, which has at most
labels x labels rows per group. The data are shuffled once, after partial aggregation, however
many metrics are asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def confusion_counts(
    df: DataFrame, actual: str, predicted: str, groups: Sequence[str] = ()
) -> DataFrame:
    return df.groupBy(
        *groups, F.col(actual).alias("actual"), F.col(predicted).alias("predicted")
    ).agg(F.count(F.lit(1)).alias("n"))


def _ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, and 0 where there is nothing to divide by."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def label_scores(counts: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support of every label that occurs, actual or predicted."""
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    sides = counts.select(
        *groups,
        F.inline(
            F.array(
                F.struct(
                    F.col("actual").alias("label"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("bigint").alias("guessed"),
                    hit.cast("bigint").alias("hits"),
                ),
                F.struct(
                    F.col("predicted").alias("label"),
                    F.lit(0).cast("bigint").alias("support"),
                    F.col("n").alias("guessed"),
                    F.lit(0).cast("bigint").alias("hits"),
                ),
            )
        ),
    )
    sums = sides.groupBy(*groups, "label").agg(
        *[F.sum(c).alias(c) for c in ("support", "guessed", "hits")]
    )
    return sums.select(
        *groups,
        "label",
        _ratio(F.col("hits"), F.col("guessed")).alias("precision"),
        _ratio(F.col("hits"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("hits"), F.col("support") + F.col("guessed")).alias("f1"),
        "support",
        "hits",
    )


def classification_metrics(counts: DataFrame) -> DataFrame:
    """One row: accuracy and macro averages over all labels, actual or predicted."""
    return label_scores(counts).agg(
        (F.sum("hits") / F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
    )


def label_frame(df: DataFrame, labels: Sequence) -> DataFrame:
    """A given label list as rows ``(position, label)``."""
    rows = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(v).alias("label")) for i, v in enumerate(labels)])
    return df.sparkSession.range(1).select(F.inline(rows))


def class_report(counts: DataFrame, labels: Sequence) -> DataFrame:
    """One row per given label, in that order; labels that never occur score 0."""
    scores = label_scores(counts).drop("hits")
    return (
        label_frame(counts, labels)
        .join(scores, "label", "left")
        .na.fill(0, ["precision", "recall", "f1", "support"])
        .orderBy("position")
        .select("label", "precision", "recall", "f1", "support")
    )


def confusion_matrix(counts: DataFrame, labels: Sequence) -> DataFrame:
    """Rows are actual labels, columns predicted ones; pairs outside ``labels`` are left out."""
    wide = counts.groupBy("actual").pivot("predicted", list(labels)).agg(F.sum("n"))
    names = [str(v) for v in labels]
    return (
        label_frame(counts, labels)
        .join(wide, F.col("label") == F.col("actual"), "left")
        .na.fill(0, names)
        .orderBy("position")
        .select(F.col("label").alias("actual"), *[F.col(f"`{n}`") for n in names])
    )


def metrics_by_group(
    counts: DataFrame, group: str, labels: Sequence, min_count: int = 50
) -> DataFrame:
    """Count, accuracy and macro F1 over the fixed label list, per group of ``min_count`` rows.

    ``counts`` are confusion counts per ``group``. A listed label that a group lacks counts as 0.
    The rows come in group order, with the group printed as text.
    """
    known = counts.where(F.col(group).isNotNull())
    scores = label_scores(known, [group])
    listed = F.when(F.col("label").isin(*labels), F.col("f1")).otherwise(0.0)
    return (
        scores.groupBy(group)
        .agg(
            F.sum("support").alias("count"),
            (F.sum("hits") / F.sum("support")).alias("accuracy"),
            (F.sum(listed) / F.lit(float(len(labels)))).alias("macro_f1"),
        )
        .where(F.col("count") >= min_count)
        .orderBy(group)
        .select(F.col(group).cast("string").alias("group"), "count", "accuracy", "macro_f1")
    )


def brier_term(actual: Column, probabilities: Column, labels: Sequence) -> Column:
    """Squared distance between the probabilities and the actual label, for one row.

    Written out per label, which compiles to plain arithmetic. An actual label that is not in the
    list is an error and not skipped.
    """
    total = F.lit(0.0)
    for i, label in enumerate(labels):
        gap = F.get(probabilities, F.lit(i)) - F.when(actual == F.lit(label), 1.0).otherwise(0.0)
        total = total + gap * gap
    message = F.concat(F.lit("label not in the label list: "), actual.cast("string"))
    return F.when(actual.isin(*labels), total).otherwise(F.raise_error(message).cast("double"))


def multiclass_brier(df: DataFrame, actual: str, probabilities: str, labels: Sequence) -> DataFrame:
    term = brier_term(F.col(actual), F.col(probabilities), labels)
    return df.agg(F.avg(term).alias("multiclass_brier"))


def argmax_label(probabilities: Column, labels: Sequence) -> Column:
    """The label with the highest probability; the first one wins a tie."""
    place = F.array_position(probabilities, F.array_max(probabilities))
    return F.element_at(F.array(*[F.lit(v) for v in labels]), place.cast("int"))


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    gap = F.col(actual) - F.col(predicted)
    return df.agg(F.avg(F.abs(gap)).alias("mae"), F.sqrt(F.avg(gap * gap)).alias("rmse"))


def reliability_table(
    df: DataFrame, actual: str, probabilities: str, labels: Sequence, bins: int = 10
) -> DataFrame:
    """Mean confidence, accuracy and row count per confidence bin; empty bins are left out.

    Bins are open on the left, over explicit edges: multiplying the confidence instead would
    put values next to an edge in the wrong bin.
    """
    confidence = F.array_max(probabilities)
    step = 1.0 / bins
    edges = [i * step for i in range(bins)] + [1.0]
    below = sum(((F.lit(e) < F.col("confidence")).cast("int") for e in edges), F.lit(0))
    number = F.greatest(F.least(below - 1, F.lit(bins - 1)), F.lit(0))
    correct = (argmax_label(F.col(probabilities), labels) == F.col(actual)).cast("double")
    return (
        df.select(confidence.alias("confidence"), correct.alias("correct"))
        .groupBy(number.cast("int").alias("bin"))
        .agg(
            F.avg("confidence").alias("avg_confidence"),
            F.avg("correct").alias("accuracy"),
            F.count(F.lit(1)).alias("count"),
        )
        .orderBy("bin")
    )


def evaluation_table(
    df: DataFrame,
    actual: str,
    predicted: str,
    probabilities: str,
    labels: Sequence,
    groups: Sequence[str] = (),
    bins: int = 10,
) -> DataFrame:
    """All counts and sums that the classification reports need, from one pass over the scored rows.

    One aggregate over several grouping sets: label pairs, label pairs per group, and confidence bins. ``set`` names a
    row's grouping set by the columns that it groups by.
    """
    columns = ["actual", "predicted", "bin", *groups]
    sets = [["actual", "predicted"], *[["actual", "predicted", g] for g in groups], ["bin"]]
    confidence = F.array_max(probabilities)
    step = 1.0 / bins
    below = sum(((F.lit(e) < confidence).cast("int") for e in [i * step for i in range(bins)] + [1.0]), F.lit(0))
    rows = df.select(
        *[F.col(g) for g in groups],
        F.col(actual).alias("actual"),
        F.col(predicted).alias("predicted"),
        F.greatest(F.least(below - 1, F.lit(bins - 1)), F.lit(0)).cast("int").alias("bin"),
        confidence.alias("confidence"),
        (argmax_label(F.col(probabilities), labels) == F.col(actual)).cast("double").alias("correct"),
        brier_term(F.col(actual), F.col(probabilities), labels).alias("brier"),
    )
    sums = [F.sum(c).alias(c) for c in ("confidence", "correct", "brier")]
    found = rows.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns]).agg(
        F.grouping_id().alias("_id"), F.count(F.lit(1)).alias("n"), *sums
    )
    # A bit for each column that a set does not group by, the first column's the highest.
    named = F
    for s in sets:
        number = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in s)
        named = named.when(F.col("_id") == number, ",".join(s))
    return found.withColumn("set", named).drop("_id")


def evaluation_counts(table: DataFrame, group: str | None = None) -> DataFrame:
    """Confusion counts out of an evaluation table, of all rows or per group."""
    keys = ["actual", "predicted", *([group] if group else [])]
    return table.where(F.col("set") == ",".join(keys)).select(*([group] if group else []), "actual", "predicted", "n", "brier")


def evaluation_reliability(table: DataFrame) -> DataFrame:
    """The reliability table out of an evaluation table."""
    return (
        table.where(F.col("set") == "bin")
        .select("bin", (F.col("confidence") / F.col("n")).alias("avg_confidence"), (F.col("correct") / F.col("n")).alias("accuracy"), F.col("n").alias("count"))
        .orderBy("bin")
    )


def top_coefficients(coefficients: DataFrame, top_n: int = 20) -> DataFrame:
    """The ``top_n`` features per group by absolute weight, ranked from 1.

    ``coefficients`` has one row per (group, feature), that is one per model weight.
    """
    size = F.abs("coefficient")
    window = Window.partitionBy("group").orderBy(size.desc(), F.col("feature"))
    return (
        coefficients.withColumn("rank", F.row_number().over(window))
        .where(F.col("rank") <= top_n)
        .select(
            F.col("group").cast("string").alias("group"),
            "rank",
            "feature",
            "coefficient",
            size.alias("abs_coefficient"),
            F.when(F.col("coefficient") >= 0, "positive").otherwise("negative").alias("direction"),
        )
    )


def compare_models(results: DataFrame, metric: str, higher_is_better: bool) -> DataFrame:
    """Model results with the best first and missing metrics last."""
    order = F.desc_nulls_last(metric) if higher_is_better else F.asc_nulls_last(metric)
    return results.orderBy(order, "position")


def best_model(results: DataFrame, metric: str, higher_is_better: bool) -> DataFrame:
    """The best row; on a tie the model listed first, and never one without a metric."""
    usable = results.where(F.col(metric).isNotNull() & ~F.isnan(metric))
    sign = 1 if higher_is_better else -1
    key = F.struct(F.col(metric) * sign, -F.col("position"))
    return usable.agg(F.max_by("model", key).alias("model"), F.max_by(metric, key).alias(metric))
