"""The baselines that are compared, each with the name of its feature view."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import SparkSession

from docketry.models.classifiers import (
    CalibratedSvm,
    CalibratedSvmModel,
    LogisticClassifier,
    LogisticModel,
    PriorClassifier,
    PriorModel,
)
from docketry.models.regressors import (
    LogLinearModel,
    LogLinearRegressor,
    MeanModel,
    MeanRegressor,
    MedianModel,
    MedianRegressor,
)
from docketry.schema import FeatureColumns
from docketry.session import load_rows, save_rows

MODEL_CLASSES = (PriorModel, LogisticModel, CalibratedSvmModel, MeanModel, MedianModel, LogLinearModel)


def save_model(model: Any, path: str) -> None:
    """Any fitted model, with its kind beside it."""
    model.save(path)
    save_rows([(type(model).__name__,)], "kind string", f"{path}/kind")


def load_model(spark: SparkSession, path: str) -> Any:
    """A model that :func:`save_model` has written."""
    kind = load_rows(spark, "kind string", f"{path}/kind", "kind")[0]["kind"]
    return {c.__name__: c for c in MODEL_CLASSES}[kind].load(spark, path)


@dataclass(frozen=True)
class ModelSpec:
    name: str
    feature_view: str
    build: Callable[[], Any]


def classification_models(columns: FeatureColumns = FeatureColumns()) -> list[ModelSpec]:
    text = replace(columns, categories=(), numbers=())
    tabular = replace(columns, text=None)
    return [
        ModelSpec("dummy_prior", "all_features_ignored", PriorClassifier),
        ModelSpec("logistic_text_only", "text_only", lambda: LogisticClassifier(text)),
        ModelSpec("logistic_tabular_only", "categorical_numeric", lambda: LogisticClassifier(tabular)),
        ModelSpec(
            "logistic_sparse_combined", "text_categorical_numeric", lambda: LogisticClassifier(columns)
        ),
        ModelSpec(
            "linear_svc_calibrated_sparse", "text_categorical_numeric", lambda: CalibratedSvm(columns)
        ),
    ]


def regression_models(
    columns: FeatureColumns = FeatureColumns(),
    first: str = "ACTI_NOM",
    second: str = "ARRONDISSEMENT",
) -> list[ModelSpec]:
    return [
        ModelSpec("dummy_mean", "all_features_ignored", MeanRegressor),
        ModelSpec(
            "conditional_median_lookup", "activity_borough_lookup", lambda: MedianRegressor(first, second)
        ),
        ModelSpec(
            "ridge_sparse_combined",
            "text_categorical_numeric",
            lambda: LogLinearRegressor(columns, alpha=1.0, summed=True),
        ),
        ModelSpec(
            "elasticnet_sparse_combined",
            "text_categorical_numeric",
            lambda: LogLinearRegressor(columns, alpha=0.0005, l1_ratio=0.5),
        ),
    ]
