import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketry.models import classifiers as C
from docketry.models import regressors as R
from docketry.operators import metrics as M
from docketry.schema import FeatureColumns
from docketry.session import materialise

NUMBERS = FeatureColumns(None, (), ("u", "v"))


@pytest.fixture(scope="module")
def points(spark):
    """Three separable clouds of different size, with a number to regress on."""
    rng = random.Random(3)
    centres = {"a": (0, 0, 120), "b": (4, 0, 60), "c": (0, 5, 40)}
    rows = [(x + rng.gauss(0, 0.7), y + rng.gauss(0, 0.7), k) for k, (x, y, n) in centres.items() for _ in range(n)]
    rng.shuffle(rows)
    rows = [(i, u, v, k, abs(10 + 3 * u + v + rng.gauss(0, 1))) for i, (u, v, k) in enumerate(rows)]
    return materialise(spark.createDataFrame(rows, "id bigint, u double, v double, k string, y double"))


def accuracy(model, df):
    counts = M.confusion_counts(model.transform(df), "k", "prediction")
    return M.classification_metrics(counts).first()["accuracy"]


def design(points):
    rows = points.orderBy("id").collect()
    return np.array([[r["u"], r["v"]] for r in rows]), np.log1p([r["y"] for r in rows])


def test_prior(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "k string")
    row = C.PriorClassifier().fit(df, "k", "id").transform(df).first()
    assert row["prediction"] == "a" and row["probability"] == pytest.approx([1 / 3] * 3)


def test_class_weights(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)], "k string")
    got = {r["label"]: (r["n"], r["prior"], r["weight"]) for r in C.class_weights(df, "k").collect()}
    assert got == {"a": (3, 0.75, pytest.approx(4 / 6)), "b": (1, 0.25, 2.0)}


def test_logistic(points):
    model = C.LogisticClassifier(NUMBERS, max_iter=200).fit(points, "k", "id")
    assert accuracy(model, points) > 0.97
    row = model.transform(points).first()
    assert sum(row["probability"]) == pytest.approx(1.0)
    assert model.coefficients().count() == 3 * 2


def test_logistic_optimum(points):
    """The gradient of the balanced, penalised loss vanishes at the fitted weights."""
    model = C.LogisticClassifier(NUMBERS, max_iter=500).fit(points, "k", "id")
    x, _ = design(points)
    labels = np.array([r["k"] for r in points.orderBy("id").collect()])
    beta, bias = model.model.coefficientMatrix.toArray(), model.model.interceptVector.toArray()
    z = x @ beta.T + bias
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    truth = (labels[:, None] == np.array(model.labels)).astype(float)
    weight = len(x) / (3 * truth.sum(0))
    per_row = (truth * weight).sum(1, keepdims=True)
    gradient = ((p - truth) * per_row).T @ x + beta
    assert np.abs(gradient).max() < 0.05


def test_fold_sizes_like_round_robin():
    for counts in ([5, 4, 8], [3, 3], [10, 1, 1]):
        order = np.repeat(np.arange(len(counts)), counts)
        want = [[int((order[i::3] == c).sum()) for i in range(3)] for c in range(len(counts))]
        assert C.fold_sizes(counts, 3) == want


def test_folds_are_consecutive_per_class(points):
    folded = C.stratified_folds(points, "k", "id", 3)
    for label, sizes in zip("abc", C.fold_sizes([120, 60, 40], 3)):
        folds = [r["fold"] for r in folded.where(F.col("k") == label).orderBy("id").collect()]
        assert folds == sorted(folds)
        assert [folds.count(f) for f in range(3)] == sizes


def test_too_few_rows_for_the_folds(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id bigint, k string")
    with pytest.raises(ValueError):
        C.stratified_folds(df, "k", "id", 3)


def test_sigmoid_matches_smoothed_logistic(spark):
    rng = random.Random(1)
    rows = [(float(m + rng.gauss(0, 1.5) > 0), m) for m in (rng.gauss(0, 2) for _ in range(400))]
    slope, offset = C.fit_sigmoid(spark.createDataFrame(rows, "_label double, _margin double"))
    n1 = sum(y for y, _ in rows)
    high, low = (n1 + 1) / (n1 + 2), 1 / (len(rows) - n1 + 2)
    m = np.array([x for _, x in rows])
    t = np.array([high if y else low for y, _ in rows])
    gap = 1 / (1 + np.exp(-(slope * m + offset))) - t
    assert abs(gap.mean()) < 1e-4 and abs((gap * m).mean()) < 1e-3


def test_svm_three_classes(points, tmp_path):
    model = C.CalibratedSvm(NUMBERS, max_iter=30).fit(points, "k", "id")
    assert accuracy(model, points) > 0.95
    assert all(sum(r["probability"]) == pytest.approx(1) for r in model.transform(points).take(20))
    assert model.fold_coefficients().count() == 3 * 3 * 2
    mean = {(r["group"], r["feature"]): r["coefficient"] for r in model.coefficients().collect()}
    assert mean["b", "u"] > 0 > mean["a", "u"]
    model.save(f"{tmp_path}/svm")


def test_svm_two_classes(points):
    two = materialise(points.where("k <> 'c'"))
    model = C.CalibratedSvm(NUMBERS, max_iter=30).fit(two, "k", "id")
    assert accuracy(model, two) > 0.97
    assert {r["group"] for r in model.coefficients().collect()} == {"b"}


def test_mean(points):
    mean = points.agg(F.avg("y")).first()[0]
    assert R.MeanRegressor().fit(points, "y", "id").transform(points).first()["prediction"] == mean


def test_ridge_closed_form(points):
    model = R.LogLinearRegressor(NUMBERS, alpha=20.0, summed=True).fit(points, "y", "id")
    x, y = design(points)
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 20.0 * np.eye(2), xc.T @ yc)
    assert model.model.coefficients.toArray() == pytest.approx(want, rel=1e-5)
    row = model.transform(points.orderBy("id")).first()
    log = x[0] @ want + y.mean() - x.mean(0) @ want
    assert row["prediction"] == pytest.approx(np.expm1(log), rel=1e-4)


def test_elastic_net_coordinate_descent(points):
    alpha, ratio = 0.1, 0.5
    model = R.LogLinearRegressor(NUMBERS, alpha=alpha, l1_ratio=ratio).fit(points, "y", "id")
    x, y = design(points)
    xc, yc, n = x - x.mean(0), y - y.mean(), len(y)
    w = np.zeros(2)
    for _ in range(500):
        for j in range(2):
            rest = yc - xc @ w + xc[:, j] * w[j]
            rho = xc[:, j] @ rest / n
            scale = xc[:, j] @ xc[:, j] / n + alpha * (1 - ratio)
            w[j] = np.sign(rho) * max(abs(rho) - alpha * ratio, 0) / scale
    assert model.model.coefficients.toArray() == pytest.approx(w, rel=1e-4, abs=1e-6)
    assert {r["group"] for r in model.coefficients().collect()} == {"target"}
