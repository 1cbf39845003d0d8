"""Certificates hold for the fitted problem and break for any other."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.linalg import DenseMatrix, SparseMatrix, Vectors

from docketry.models import certificates as X
from docketry.models import classifiers as C
from docketry.models import regressors as R
from docketry.operators.features import vector_entries
from docketry.schema import FeatureColumns
from docketry.session import materialise

VIEW = FeatureColumns("said", ("k",), ("u",))


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(6)
    words = ["late", "lost", "fine", "good", "bad", "slow", "wet", "dry"]
    data = []
    for i in range(600):
        said = " ".join(rng.choice(words, rng.integers(1, 6)))
        label = "c" if "bad" in said and rng.random() < 0.8 else ("b" if rng.random() < 0.3 else "a")
        data.append((i, said, "xyz"[int(rng.integers(0, 3))], float(rng.normal()), label, float(np.exp(rng.normal() + said.count("late")))))
    return materialise(spark.createDataFrame(data, "id bigint, said string, k string, u double, label string, y double"), "rows")


def broken(found):
    return found.where("NOT holds").count()


def test_logistic(rows):
    model = C.LogisticClassifier(VIEW).fit(rows, "label", "id")
    found = X.logistic_certificate(model, rows, "label")
    assert broken(found) == 0 and found.count() == 3 * (len(model.view.names) + 1)
    assert broken(X.logistic_certificate(model, rows, "label", c=2.0)) > 10
    swapped = replace(model, labels=["b", "a", "c"])
    assert broken(X.logistic_certificate(swapped, rows, "label")) > 10
    # Other class weights: as if the rarest class had been left out of the balance.
    fewer = rows.where("label <> 'c' OR id % 2 = 0")
    assert broken(X.logistic_certificate(model, fewer, "label")) > 10
    early = C.LogisticClassifier(VIEW, max_iter=2).fit(rows, "label", "id")
    assert broken(X.logistic_certificate(early, rows, "label")) > 10


def test_moments_are_those_of_the_rows(rows):
    model = C.LogisticClassifier(VIEW).fit(rows, "label", "id")
    found = {(r["label"], r["feature"]): r["moment"] for r in X.logistic_certificate(model, rows, "label").collect()}
    data = rows.collect()
    for label in "abc":
        own = [r for r in data if r["label"] == label]
        weight = len(data) / (3 * len(own))
        assert found[label, "intercept"] == pytest.approx(len(data) / 3)
        assert found[label, "u"] == pytest.approx(weight * sum(r["u"] for r in own))
        assert found[label, "k_x"] == pytest.approx(weight * sum(r["k"] == "x" for r in own))


@pytest.mark.parametrize("alpha, ratio, summed", [(5.0, 0.0, True), (0.01, 0.5, False)])
def test_linear(rows, alpha, ratio, summed):
    model = R.LogLinearRegressor(VIEW, alpha=alpha, l1_ratio=ratio, summed=summed).fit(rows, "y", "id")
    of = lambda a, r=ratio, s=summed: broken(X.linear_certificate(model, rows, "y", a, r, s, tolerance=1e-4))
    assert of(alpha) == 0
    assert of(alpha * 2) > 3 and of(alpha, s=not summed) > 3
    if ratio:
        assert of(alpha, 0.1) > 3


def test_weights_of_every_kind_of_matrix(spark):
    dense = np.array([[1.0, 0.0, 3.0], [0.0, 5.0, 6.0]])
    kinds = [
        DenseMatrix(2, 3, dense.T.ravel()),
        DenseMatrix(2, 3, dense.ravel(), True),
        SparseMatrix(2, 3, [0, 1, 2, 4], [0, 1, 0, 1], [1.0, 5.0, 3.0, 6.0]),
        SparseMatrix(2, 3, [0, 2, 4], [0, 2, 1, 2], [1.0, 3.0, 5.0, 6.0], True),
    ]
    for m in kinds:
        table = X.weight_table(spark.createDataFrame([(m,)], ["coefficientMatrix"]))
        got = np.zeros((2, 3))
        for r in table.collect():
            got[r["class"], r["place"]] = r["coefficient"]
        assert np.array_equal(got, dense)
    for v in (Vectors.dense([0.0, 2.0]), Vectors.sparse(2, [1], [2.0])):
        table = X.weight_table(spark.createDataFrame([(v,)], ["coefficients"]))
        assert {r["place"]: r["coefficient"] for r in table.collect() if r["coefficient"]} == {1: 2.0}


def test_entries(spark):
    df = spark.createDataFrame([(Vectors.dense([1.0, 0.0]),), (Vectors.sparse(5, [3], [2.0]),), (Vectors.sparse(5, [], []),)], ["v"])
    got = [[tuple(e) for e in r[0]] for r in df.select(vector_entries("v").alias("e")).collect()]
    assert got == [[(0, 1.0), (1, 0.0)], [(3, 2.0)], []]
