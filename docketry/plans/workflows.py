"""The three workflows: draw a subset, compare classifiers, compare regressors."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry import schema as S
from docketry.models.classifiers import label_universe
from docketry.models.registry import ModelSpec, classification_models, regression_models, save_model
from docketry.operators import frames, metrics, sampling, uncertainty
from docketry.operators.features import shared_fits
from docketry.schema import FeatureColumns, RecordSchema
from docketry.session import materialise, scratch_path, small_table
from docketry.sources import tables

COMPARISON = (
    "position int, model string, feature_view string, error string, "
    "accuracy double, macro_f1 double, macro_precision double, macro_recall double, "
    "multiclass_brier double"
)
REGRESSION_COMPARISON = (
    "position int, model string, feature_view string, error string, mae double, rmse double"
)


def build_subset(
    spark: SparkSession,
    csv_path: str,
    output_path: str,
    target_rows: int = 300_000,
    min_per_group: int = 25,
    seed: int = 42,
    max_rows: int | None = None,
    schema: RecordSchema = RecordSchema(),
) -> DataFrame:
    """Raw CSV to a saved representative subset; returns the metadata row."""
    raw = tables.ingest(spark, csv_path, scratch_path(spark, "requests"))
    raw = tables.first_rows(raw, max_rows)
    subset, metadata = sampling.representative_subset(
        raw,
        tables.ROW_ID,
        target_rows,
        min_per_group,
        seed,
        prepare=lambda df: frames.prepare_base(df, schema),
        max_rows=max_rows,
    )
    tables.save_subset(subset, output_path, metadata)
    return metadata


#: Records from which they are dealt anew, however few tasks the source was read by.
SPREAD_ROWS = 10_000


def spread(rows: DataFrame, row_id: str) -> DataFrame:
    """Many ``rows`` dealt out by id, in its order within a task, so that every later pass runs on all cores.

    A table of few row groups is read by as few tasks, and what is stored from it keeps their number: a large table
    would be cut into words, and passed over by every solver step, on one or two cores.
    """
    if rows.limit(SPREAD_ROWS + 1).count() <= SPREAD_ROWS:
        return rows
    return rows.repartition(row_id).sortWithinPartitions(row_id)


# --- classification -------------------------------------------------------------------------


@dataclass
class ClassificationRun:
    comparison: DataFrame
    best_name: str
    labels: list
    summary: DataFrame
    scored: DataFrame
    class_report: DataFrame
    confusion: DataFrame
    by_group: dict[str, DataFrame]
    reliability: DataFrame
    contributions: DataFrame | None
    model: Any

    def save(self, path: str) -> None:
        tables.save_report(prefixed(self.comparison, 4), f"{path}/model_comparison")
        tables.save_summary(self.summary, f"{path}/summary")
        tables.save_report(self.class_report, f"{path}/class_report")
        tables.save_report(self.confusion, f"{path}/confusion_matrix")
        for name, table in self.by_group.items():
            tables.save_report(table, f"{path}/by_{name}")
        tables.save_report(self.reliability, f"{path}/reliability")
        if self.contributions is not None:
            tables.save_report(self.contributions, f"{path}/feature_contributions")
        save_model(self.model, f"{path}/best_model")


def prefixed(comparison: DataFrame, first: int, prefix: str = "validation_") -> DataFrame:
    """A comparison table with its metric columns named after the validation split."""
    names = comparison.columns
    return comparison.select(
        *names[1:first], *[F.col(n).alias(prefix + n) for n in names[first:]]
    )


def classification_scores(scored: DataFrame, target: str, labels: Sequence) -> DataFrame:
    """One row with all metrics of a scored frame, from one pass over it."""
    term = metrics.brier_term(F.col(target), F.col("probability"), labels)
    counts = scored.groupBy(F.col(target).alias("actual"), F.col("prediction").alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(term).alias("brier")
    )
    return scores_of_counts(materialise(counts, "counts"))


def scores_of_counts(counts: DataFrame) -> DataFrame:
    """One row with all metrics, from confusion counts with their sums of Brier terms."""
    brier = counts.agg((F.sum("brier") / F.sum("n")).alias("b"))
    return metrics.classification_metrics(counts).withColumn("multiclass_brier", brier.scalar())


#: Faults of the cluster, not of a model: these end a comparison.
_LOST = re.compile(r"ExecutorLost|FetchFailed|SparkContext was shut down|cancelled|No space left|OutOfMemory|Answer from Java side is empty")


def compare_classifiers(
    specs: Sequence[ModelSpec],
    train: DataFrame,
    validation: DataFrame,
    target: str,
    row_id: str,
    labels: Sequence,
) -> DataFrame:
    """Fit every spec on train and score it on validation; a failing one becomes an error row."""
    results = []
    for position, spec in enumerate(specs):
        head = (position, spec.name, spec.feature_view)
        try:
            model = spec.build().fit(train, target, row_id)
            scored = materialise(
                model.transform(validation).select(target, "prediction", "probability"), "scored"
            )
            results.append((*head, "", *classification_scores(scored, target, labels).first()))
        except Exception as error:  # noqa: BLE001 - the comparison reports what failed
            if _LOST.search(str(error)):
                raise
            results.append((*head, f"{type(error).__name__}: {error}", None, None, None, None, None))
    return small_table(train.sparkSession, results, COMPARISON)


def _spec(specs: Sequence[ModelSpec], name: str | None) -> ModelSpec:
    for spec in specs:
        if spec.name == name:
            return spec
    raise RuntimeError("no model could be trained; see the error column of the comparison")


def train_classification(
    tagged: DataFrame,
    target: str = S.TARGET,
    row_id: str = tables.ROW_ID,
    groups: Sequence[str] = ("creation_month", "ARRONDISSEMENT"),
    columns: FeatureColumns = FeatureColumns(),
    specs: Sequence[ModelSpec] | None = None,
    min_count: int = 50,
) -> ClassificationRun:
    """Compare classifiers on validation, refit the best on train + validation, test it once.

    ``tagged`` has a ``split`` column; it is stored by split, so that every fit reads its own
    part. The test rows are scored once into a stored table, and
    every report is an aggregate of it.
    """
    specs = classification_models(columns) if specs is None else specs
    tagged = materialise(spread(tagged, row_id), "tagged", by=["split"])
    sizes = frames.check_splits(tagged, target, min_labels=2)
    train, validation, test = (tagged.where(F.col("split") == s) for s in frames.SPLITS)
    # Labels are those of the training rows; an unseen label in validation is an error.
    with shared_fits():
        results = compare_classifiers(specs, train, validation, target, row_id, label_universe(train, target))
    comparison = metrics.compare_models(results, "macro_f1", True)
    best = metrics.best_model(results, "macro_f1", True).first()["model"]
    fitting = frames.train_and_validation(tagged)
    labels = label_universe(fitting, target)
    model = _spec(specs, best).build().fit(fitting, target, row_id)
    scored = materialise(
        model.transform(test).select(row_id, *groups, target, "prediction", "probability"), "scored"
    )
    table = materialise(
        metrics.evaluation_table(scored, target, "prediction", "probability", labels, groups), "evaluation"
    )
    counts = metrics.evaluation_counts(table)
    summary = scores_of_counts(counts).select(
        F.lit(best).alias("best_model"),
        F.array(*[F.lit(v) for v in labels]).alias("labels"),
        *[F.lit(sizes[s]).cast("bigint").alias(f"{s}_rows") for s in frames.SPLITS],
        F.struct("accuracy", "macro_f1", "macro_precision", "macro_recall", "multiclass_brier").alias(
            "final_test_metrics"
        ),
    )
    weights = model.coefficients()
    return ClassificationRun(
        comparison=comparison,
        best_name=best,
        labels=labels,
        summary=summary,
        scored=scored,
        class_report=metrics.class_report(counts, labels),
        confusion=metrics.confusion_matrix(counts, labels),
        by_group={
            g: metrics.metrics_by_group(metrics.evaluation_counts(table, g), g, labels, min_count) for g in groups
        },
        reliability=metrics.evaluation_reliability(table),
        contributions=None if weights is None else metrics.top_coefficients(weights),
        model=model,
    )


# --- regression -----------------------------------------------------------------------------


@dataclass
class RegressionRun:
    comparison: DataFrame
    best_name: str
    summary: DataFrame
    intervals: DataFrame
    contributions: DataFrame | None
    model: Any

    def save(self, path: str) -> None:
        tables.save_report(prefixed(self.comparison, 4), f"{path}/model_comparison")
        tables.save_summary(self.summary, f"{path}/summary")
        # One row per test record, so this table stays in as many files as it has partitions.
        self.intervals.write.mode("overwrite").option("header", True).csv(f"{path}/intervals")
        if self.contributions is not None:
            tables.save_report(self.contributions, f"{path}/feature_contributions")
        save_model(self.model, f"{path}/best_model")


def fitted_regressors(
    specs: Sequence[ModelSpec], train: DataFrame, validation: DataFrame, target: str, row_id: str
) -> tuple[DataFrame, dict[str, Any]]:
    """Fit every spec on train and score it on validation; an error ends the comparison. The models by name, too."""
    results, models = [], {}
    for position, spec in enumerate(specs):
        model = models[spec.name] = spec.build().fit(train, target, row_id)
        scores = metrics.regression_metrics(model.transform(validation), target, "prediction").first()
        results.append((position, spec.name, spec.feature_view, "", *scores))
    return small_table(train.sparkSession, results, REGRESSION_COMPARISON), models


def compare_regressors(
    specs: Sequence[ModelSpec], train: DataFrame, validation: DataFrame, target: str, row_id: str
) -> DataFrame:
    return fitted_regressors(specs, train, validation, target, row_id)[0]


def conformal_run(
    spec: ModelSpec,
    train: DataFrame,
    validation: DataFrame,
    test: DataFrame,
    target: str,
    row_id: str,
    alpha: float = 0.1,
    fitted: Any = None,
) -> tuple[DataFrame, DataFrame]:
    """Radius from a model that has seen train only, and the test intervals it gives.

    This model is not the refitted one: its validation errors must be honest. ``fitted`` is one of ``spec`` that train
    has already been given to.
    """
    calibrated = spec.build().fit(train, target, row_id) if fitted is None else fitted
    radius = materialise(
        uncertainty.conformal_radius(calibrated.transform(validation), target, "prediction", alpha),
        "radius",
    )
    scored = calibrated.transform(test)
    table = uncertainty.interval_table(scored, target, "prediction", radius, keep=(row_id,))
    return radius, materialise(table, "intervals")


def train_regression(
    tagged: DataFrame,
    target: str = S.DURATION,
    row_id: str = tables.ROW_ID,
    alpha: float = 0.1,
    columns: FeatureColumns = FeatureColumns(),
    specs: Sequence[ModelSpec] | None = None,
) -> RegressionRun:
    """Compare regressors on validation, refit the best, and give conformal intervals on test."""
    specs = regression_models(columns) if specs is None else specs
    tagged = materialise(tagged, "tagged", by=["split"])
    sizes = frames.check_splits(tagged, target)
    train, validation, test = (tagged.where(F.col("split") == s) for s in frames.SPLITS)
    with shared_fits():
        results, models = fitted_regressors(specs, train, validation, target, row_id)
    best = metrics.best_model(results, "mae", False).first()["model"]
    spec = _spec(specs, best)
    radius, intervals = conformal_run(spec, train, validation, test, target, row_id, alpha, models[best])
    model = spec.build().fit(frames.train_and_validation(tagged), target, row_id)
    scores = metrics.regression_metrics(model.transform(test), target, "prediction")
    coverage = uncertainty.interval_metrics(intervals)
    summary = scores.select(
        F.lit(best).alias("best_model"),
        *[F.lit(sizes[s]).cast("bigint").alias(f"{s}_rows") for s in frames.SPLITS],
        F.struct("mae", "rmse").alias("final_test_metrics"),
        F.struct(
            F.lit(alpha).alias("alpha"),
            F.lit(1.0 - alpha).alias("nominal_coverage"),
            F.lit(sizes["validation"]).cast("bigint").alias("calibration_rows"),
            radius.select("radius").scalar().alias("interval_radius_days"),
            coverage.select(F.struct(*coverage.columns)).scalar().alias("test_metrics"),
        ).alias("conformal_interval"),
    )
    weights = model.coefficients()
    return RegressionRun(
        comparison=metrics.compare_models(results, "mae", False),
        best_name=best,
        summary=summary,
        intervals=intervals,
        contributions=None if weights is None else metrics.top_coefficients(weights),
        model=model,
    )
