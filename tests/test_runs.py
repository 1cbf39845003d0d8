"""Runs from a file to reports: stages, resumption, and scratch tables that are gone afterwards."""

import os
from multiprocessing.pool import ThreadPool

import pytest
from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from docketry import schema as S
from docketry.models.registry import classification_models, regression_models
from docketry.plans import runs, workflows
from docketry.session import materialise, scratch_root, scratch_scope
from tests.test_workflows import BOUNDS, VIEW, raw_csv, raw_rows  # noqa: F401


def owned(spark):
    folder = f"{scratch_root(spark)}/docketry".removeprefix("file:")
    return [n for n in os.listdir(folder) if n.startswith("run-")] if os.path.isdir(folder) else []


def test_scope_deletes_what_it_owns(spark):
    outside = materialise(spark.range(3), "kept")
    with scratch_scope(spark) as folder:
        inner = materialise(spark.range(5), "gone")
        assert inner.count() == 5 and os.listdir(folder.removeprefix("file:"))
        # Threads of the run store in the same folder.
        store = inheritable_thread_target(spark)(lambda n: materialise(spark.range(n), "thread").count())
        with ThreadPool(2) as pool:
            assert pool.map(store, [1, 2]) == [1, 2]
        assert len(os.listdir(folder.removeprefix("file:"))) == 3
        with scratch_scope(spark) as nested:
            materialise(spark.range(2), "nested")
        assert not os.path.exists(nested.removeprefix("file:"))
        assert materialise(spark.range(4), "again").count() == 4
    assert not os.path.exists(folder.removeprefix("file:"))
    with pytest.raises(ZeroDivisionError), scratch_scope(spark) as failed:
        materialise(spark.range(5), "gone")
        raise ZeroDivisionError
    assert not os.path.exists(failed.removeprefix("file:"))
    assert outside.count() == 3


def test_classification_resumes(spark, raw_csv, tmp_path, monkeypatch):  # noqa: F811
    out = f"{tmp_path}/out"
    specs = [s for s in classification_models(VIEW) if s.name in ("dummy_prior", "logistic_tabular_only")]
    before = owned(spark)
    train = workflows.train_classification

    def killed(*args, **kwargs):
        materialise(spark.range(3), "half")
        raise KeyboardInterrupt

    monkeypatch.setattr(workflows, "train_classification", killed)
    with pytest.raises(KeyboardInterrupt):
        runs.classify_file(spark, raw_csv, out, BOUNDS, columns=VIEW, specs=specs, min_count=10)
    assert runs.finished(spark, out, "classification_rows") and not runs.finished(spark, out, "classification")
    monkeypatch.setattr(workflows, "train_classification", train)
    # The input is not read again.
    path = runs.classify_file(spark, f"{tmp_path}/no-such-file.csv", out, BOUNDS, columns=VIEW, specs=specs, min_count=10)
    assert {"best_model", "model_comparison", "summary", "class_report", "reliability"} <= set(os.listdir(path))
    monkeypatch.setattr(workflows, "train_classification", killed)
    assert runs.classify_file(spark, raw_csv, out, BOUNDS, columns=VIEW, specs=specs) == path
    assert owned(spark) == before


def test_regression_from_a_file(spark, raw_csv, tmp_path):  # noqa: F811
    specs = [s for s in regression_models(VIEW) if s.name in ("dummy_mean", "conditional_median_lookup")]
    before = owned(spark)
    path = runs.regress_file(spark, raw_csv, f"{tmp_path}/out", BOUNDS, columns=VIEW, specs=specs)
    summary = spark.read.json(f"{path}/summary").first()
    rows = spark.read.parquet(f"{tmp_path}/out/regression_rows")
    tagged = rows.where(F.col(S.CREATED) > F.lit(BOUNDS[1]).cast("timestamp_ntz"))
    assert summary["test_rows"] == tagged.count() > 0
    assert owned(spark) == before
