"""Baseline classifiers: class prior, balanced logistic regression, calibrated linear SVM.

A classifier is fitted with ``fit(train, target, row_id)`` and then adds ``prediction`` (a label)
and ``probability`` (an array in label order) to a frame.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.classification import LinearSVC, LinearSVCModel, LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.operators.features import FeatureView
from docketry.operators.metrics import argmax_label
from docketry.operators.selection import select_ranks
from docketry.schema import FeatureColumns
from docketry.session import load_rows, materialise, save_rows, small_table

PARALLEL_FITS = 4


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """``(label, n, prior, weight)``; the weights give every class the same total."""
    counts = df.groupBy(F.col(target).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes"))
    rows, classes = totals.select("rows").scalar(), totals.select("classes").scalar()
    return counts.select(
        "label",
        "n",
        (F.col("n") / rows).alias("prior"),
        (rows / (classes * F.col("n"))).alias("weight"),
    )


def label_universe(df: DataFrame, target: str) -> list:
    """Sorted distinct labels: one entry per class of the model."""
    return [r[0] for r in df.select(target).distinct().orderBy(target).collect()]


def _per_label(label: Column, values: dict, otherwise: float | None = None) -> Column:
    found = F
    for key, value in values.items():
        found = found.when(label == key, value)
    return found if otherwise is None else found.otherwise(otherwise)


def _class_rows(train: DataFrame, target: str) -> list:
    rows = class_weights(train, target).orderBy("label").collect()
    if len(rows) < 2:
        raise ValueError("training rows need at least two classes")
    return rows


# Labels are text in saved models.
LABELS = "place int, label string"
PRIORS = "place int, label string, prior double"
SIGMOIDS = "fold int, class int, slope double, offset double"


def save_labels(labels: list, path: str) -> None:
    save_rows(list(enumerate(labels)), LABELS, f"{path}/labels")


def load_labels(spark: SparkSession, path: str) -> list:
    return [r["label"] for r in load_rows(spark, LABELS, f"{path}/labels", "place")]


# --- prior ----------------------------------------------------------------------------------


@dataclass
class PriorModel:
    labels: list
    priors: list[float]

    def transform(self, df: DataFrame) -> DataFrame:
        """Every row gets the most frequent label and the training priors."""
        top = self.labels[max(range(len(self.priors)), key=lambda i: (self.priors[i], -i))]
        return df.withColumns(
            {
                "prediction": F.lit(top),
                "probability": F.array(*[F.lit(float(p)) for p in self.priors]),
            }
        )

    def coefficients(self) -> None:
        return None

    def save(self, path: str) -> None:
        save_rows(list(zip(range(len(self.labels)), self.labels, self.priors)), PRIORS, f"{path}/priors")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> PriorModel:
        rows = load_rows(spark, PRIORS, f"{path}/priors", "place")
        return cls([r["label"] for r in rows], [r["prior"] for r in rows])


class PriorClassifier:
    def fit(self, train: DataFrame, target: str, row_id: str) -> PriorModel:
        rows = class_weights(train, target).orderBy("label").collect()
        return PriorModel([r["label"] for r in rows], [r["prior"] for r in rows])


# --- logistic regression --------------------------------------------------------------------


@dataclass
class LogisticModel:
    labels: list
    view: FeatureView
    model: LogisticRegressionModel

    def transform(self, df: DataFrame) -> DataFrame:
        scored = self.model.transform(self.view.transform(df, "_features"))
        return scored.select(
            *[F.col(f"`{c}`") for c in df.columns],
            vector_to_array("_probability").alias("probability"),
        ).withColumn("prediction", argmax_label(F.col("probability"), self.labels))

    def coefficients(self) -> DataFrame:
        """One row per class and feature: the model's own weights."""
        matrix = self.model.coefficientMatrix.toArray()
        return weight_rows(self.view, dict(zip(self.labels, matrix.tolist())))

    def save(self, path: str) -> None:
        save_labels(self.labels, path)
        self.view.save(f"{path}/view")
        self.model.write().overwrite().save(f"{path}/model")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LogisticModel:
        view, model = FeatureView.load(spark, f"{path}/view"), LogisticRegressionModel.load(f"{path}/model")
        return cls(load_labels(spark, path), view, model)


def weight_rows(view: FeatureView, weights: dict) -> DataFrame:
    spark = SparkSession.getActiveSession()
    rows = [
        (str(group), name, float(value))
        for group, values in weights.items()
        for name, value in zip(view.names, values)
    ]
    return small_table(spark, rows, "group string, feature string, coefficient double")


@dataclass
class LogisticClassifier:
    """Multinomial logistic regression with balanced class weights and an L2 penalty of 1/C."""

    columns: FeatureColumns
    max_iter: int = 2_000
    c: float = 1.0

    def fit(self, train: DataFrame, target: str, row_id: str) -> LogisticModel:
        classes = _class_rows(train, target)
        labels = [r["label"] for r in classes]
        view = FeatureView.fit(train, self.columns, row_id)
        index = {v: float(i) for i, v in enumerate(labels)}
        weight = {r["label"]: float(r["weight"]) for r in classes}
        table = materialise(
            view.transform(train, "_features").select(
                _per_label(F.col(target), index).alias("_label"),
                _per_label(F.col(target), weight).alias("_weight"),
                "_features",
            ),
            "vectors",
        )
        # The weights sum to n, so a penalty of 1/(C n) per mean loss equals C against the sum.
        model = LogisticRegression(
            featuresCol="_features",
            labelCol="_label",
            weightCol="_weight",
            family="multinomial",
            standardization=False,
            elasticNetParam=0.0,
            regParam=1.0 / (self.c * sum(r["n"] for r in classes)),
            maxIter=self.max_iter,
            probabilityCol="_probability",
            rawPredictionCol="_raw",
            predictionCol="_index",
        ).fit(table)
        return LogisticModel(labels, view, model)


# --- calibrated linear SVM ------------------------------------------------------------------


def fold_sizes(counts: Sequence[int], folds: int) -> list[list[int]]:
    """Rows of each class in each fold.

    Lay the classes out one after another and deal the positions round-robin: fold ``i`` gets
    the positions that leave remainder ``i``.
    """
    sizes, start = [], 0
    for n in counts:
        sizes.append([(start + n - i + folds - 1) // folds - (start - i + folds - 1) // folds for i in range(folds)])
        start += n
    return sizes


def stratified_folds(
    df: DataFrame,
    label: str,
    order_by: str,
    folds: int = 3,
) -> DataFrame:
    """``df`` with ``fold``: consecutive stretches of every class, in ``order_by`` order.

    ``order_by`` is a unique number. Only the last row of each stretch is looked up; the rows
    stay where they are, so a class that holds most of the table is not gathered anywhere.
    """
    classes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(label).collect()
    if min(r["n"] for r in classes) < folds:
        raise ValueError(f"every class needs at least {folds} rows for {folds} folds")
    sizes = fold_sizes([r["n"] for r in classes], folds)
    cells = df.select(label, order_by, F.lit(1).cast("bigint").alias("_n"))
    fold = F.lit(0)
    for cut in range(1, folds):
        before = {r[label]: sum(s[:cut]) for r, s in zip(classes, sizes)}
        rank = lambda _, b=before: _per_label(F.col(label), b) - 1
        last = select_ranks(
            cells,
            [label],
            order_by,
            rank,
            rank,
        ).collect()
        ends = {r[label]: r[order_by] for r in last}
        fold = fold + (F.col(order_by) > _per_label(F.col(label), ends)).cast("int")
    return df.withColumn("fold", fold)


@dataclass
class SvmFold:
    """One fold: per class (one for two classes) a margin model and its sigmoid."""

    margins: list[LinearSVCModel]
    sigmoids: list[tuple[float, float]]


@dataclass
class CalibratedSvmModel:
    labels: list
    view: FeatureView
    folds: list[SvmFold]

    def transform(self, df: DataFrame) -> DataFrame:
        scored = self.view.transform(df, "_features")
        per_fold = []
        for f, fold in enumerate(self.folds):
            parts = []
            for c, (model, (slope, offset)) in enumerate(zip(fold.margins, fold.sigmoids)):
                scored = _margin(model, scored, f"_m{f}_{c}")
                parts.append(1 / (1 + F.exp(-(F.col(f"_m{f}_{c}") * slope + offset))))
            if len(self.labels) == 2:
                per_fold.append([1 - parts[0], parts[0]])
            else:
                total = sum(parts[1:], parts[0])
                even = 1.0 / len(parts)
                per_fold.append([F.when(total > 0, p / total).otherwise(even) for p in parts])
        mean = [
            sum((fold[i] for fold in per_fold[1:]), per_fold[0][i]) / len(per_fold)
            for i in range(len(self.labels))
        ]
        return scored.select(
            *[F.col(f"`{c}`") for c in df.columns], F.array(*mean).alias("probability")
        ).withColumn("prediction", argmax_label(F.col("probability"), self.labels))

    def fold_coefficients(self) -> DataFrame:
        """Weights of every fold, as ``(fold, group, feature, coefficient)``."""
        groups = self.labels[1:] if len(self.labels) == 2 else self.labels
        frames = [
            weight_rows(
                self.view, {g: m.coefficients.toArray().tolist() for g, m in zip(groups, fold.margins)}
            ).withColumn("fold", F.lit(f))
            for f, fold in enumerate(self.folds)
        ]
        out = frames[0]
        for frame in frames[1:]:
            out = out.unionByName(frame)
        return out

    def coefficients(self) -> DataFrame:
        return mean_coefficients(self.fold_coefficients())

    def save(self, path: str) -> None:
        save_labels(self.labels, path)
        self.view.save(f"{path}/view")
        rows = []
        for f, fold in enumerate(self.folds):
            for c, (model, (slope, offset)) in enumerate(zip(fold.margins, fold.sigmoids)):
                model.write().overwrite().save(f"{path}/margin-{f}-{c}")
                rows.append((f, c, slope, offset))
        save_rows(rows, SIGMOIDS, f"{path}/sigmoids")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> CalibratedSvmModel:
        folds: dict[int, list] = {}
        for r in load_rows(spark, SIGMOIDS, f"{path}/sigmoids", "class"):
            margin = LinearSVCModel.load(f"{path}/margin-{r['fold']}-{r['class']}")
            folds.setdefault(r["fold"], []).append((margin, (r["slope"], r["offset"])))
        parts = [folds[f] for f in sorted(folds)]
        return cls(
            load_labels(spark, path),
            FeatureView.load(spark, f"{path}/view"),
            [SvmFold([m for m, _ in part], [s for _, s in part]) for part in parts],
        )


def mean_coefficients(by_fold: DataFrame) -> DataFrame:
    return by_fold.groupBy("group", "feature").agg(F.avg("coefficient").alias("coefficient"))


def _margin(model: LinearSVCModel, df: DataFrame, out: str) -> DataFrame:
    model.setRawPredictionCol("_raw").setPredictionCol("_index")
    raw = model.transform(df).drop("_index")
    return raw.withColumn(out, vector_to_array("_raw")[1]).drop("_raw")


@dataclass
class CalibratedSvm:
    """One-vs-rest linear SVM with balanced weights and sigmoid calibration on held-out folds.

    Spark's SVM minimises the plain hinge loss. The calibration uses smoothed targets: a held-out
    row enters with both labels, weighted by its target and the rest.
    """

    columns: FeatureColumns
    folds: int = 3
    max_iter: int = 100
    c: float = 1.0

    def fit(self, train: DataFrame, target: str, row_id: str) -> CalibratedSvmModel:
        labels = [r["label"] for r in _class_rows(train, target)]
        view = FeatureView.fit(train, self.columns, row_id)
        vectors = view.transform(train, "_features").select(row_id, target, "_features")
        # Stored once: every fold, class and solver pass reads this table.
        stored = materialise(vectors, "vectors")
        folded = stratified_folds(stored, target, row_id, self.folds)
        table = materialise(folded, "folds", by=["fold"])
        positives = labels[1:] if len(labels) == 2 else labels
        tasks = [(f, label) for f in range(self.folds) for label in positives]
        run = inheritable_thread_target(train.sparkSession)(
            partial(self._fit_one, table, target, len(labels))
        )
        with ThreadPool(min(PARALLEL_FITS, len(tasks))) as pool:
            fitted = pool.map(run, tasks)
        k = len(positives)
        groups = [fitted[i * k : (i + 1) * k] for i in range(self.folds)]
        return CalibratedSvmModel(
            labels, view, [SvmFold([m for m, _ in g], [s for _, s in g]) for g in groups]
        )

    def _fit_one(self, table: DataFrame, target: str, classes: int, task: tuple):
        fold, label = task
        flag = (F.col(target) == label).cast("double")
        rest = table.where(F.col("fold") != fold).withColumn("_label", flag)
        counts = {r["_label"]: r["count"] for r in rest.groupBy("_label").count().collect()}
        n = sum(counts.values())
        up = n / (classes * counts[1.0])
        # With two classes the other side has its own balanced weight, otherwise it counts 1.
        down = n / (classes * counts[0.0]) if classes == 2 else 1.0
        weighted = rest.withColumn("_weight", F.when(F.col("_label") == 1, up).otherwise(down))
        model = LinearSVC(
            featuresCol="_features",
            labelCol="_label",
            weightCol="_weight",
            standardization=False,
            maxIter=self.max_iter,
            regParam=1.0 / (self.c * (up * counts[1.0] + down * counts[0.0])),
        ).fit(weighted)
        held = table.where(F.col("fold") == fold).withColumn("_label", flag)
        margins = materialise(_margin(model, held, "_margin").select("_label", "_margin"), "margins")
        return model, fit_sigmoid(margins)


def fit_sigmoid(margins: DataFrame) -> tuple[float, float]:
    """Slope and offset of a sigmoid from ``(_label, _margin)`` rows, with smoothed targets."""
    n = {r["_label"]: r["count"] for r in margins.groupBy("_label").count().collect()}
    high = (n.get(1.0, 0) + 1.0) / (n.get(1.0, 0) + 2.0)
    low = 1.0 / (n.get(0.0, 0) + 2.0)
    goal = F.when(F.col("_label") == 1, high).otherwise(low)
    both = margins.select(
        F.array("_margin").alias("_x"),
        F.inline(
            F.array(
                F.struct(F.lit(1.0).alias("_y"), goal.alias("_w")),
                F.struct(F.lit(0.0).alias("_y"), (1 - goal).alias("_w")),
            )
        ),
    )
    fitted = LogisticRegression(
        featuresCol="_x", labelCol="_y", weightCol="_w", family="binomial", maxIter=100
    ).fit(both.withColumn("_x", array_to_vector("_x")))
    return float(fitted.coefficients[0]), float(fitted.intercept)
