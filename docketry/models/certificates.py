"""Proof that a fitted linear model solves its own problem, from one aggregate over its training vectors.

At the optimum of a penalised linear model two sums agree for every weight: the *moment* of the data, which the labels and
the features alone decide, and what the model puts in its place, predictions and penalty together. A wrong
penalty, class weight or label order, a shifted feature block or a solver that stopped early breaks the equation
somewhere. The moment does not depend on the model, so it can be computed by other means, in SQL for instance.

Every entry of a vector becomes a row and is added up by weight: partial sums in each task, then a shuffle of one row for
each weight and task. The weights themselves come as a table (``weight_table``), so nothing grows on the driver.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.models.classifiers import LogisticModel, class_weights
from docketry.models.regressors import LogLinearModel
from docketry.operators.features import FeatureView, vector_entries
from docketry.session import materialise, scratch_path, small_table

#: The place of the intercept, whose feature is 1 in every row and which no penalty pulls.
INTERCEPT = -1
#: Gap allowed, as a share of the sum of the feature's absolute values over the weighted rows, and in any case as a share
#: of the largest pull of the penalty on any weight.
TOLERANCE = 1e-3
PULL_SHARE = 0.02


def with_intercept(vector: str) -> Column:
    one = F.array(F.struct(F.lit(INTERCEPT).alias("place"), F.lit(1.0).alias("x")))
    return F.concat(one, vector_entries(vector))


def name_table(view: FeatureView, spark) -> DataFrame:
    """(place, feature) of every weight, the intercept included."""
    return small_table(spark, [(INTERCEPT, "intercept"), *enumerate(view.names)], "place int, feature string")


def weight_table(matrix: DataFrame) -> DataFrame:
    """(class, place, coefficient) of a saved coefficient matrix or vector, exploded by Spark from the stored model.

    ``matrix`` is the data of a saved model, with ``coefficientMatrix`` or ``coefficients``.
    """
    if "coefficientMatrix" in matrix.columns:
        m = F.unwrap_udt("coefficientMatrix")
        rows = matrix.select(m["numRows"].alias("_r"), m["numCols"].alias("_c"), m["isTransposed"].alias("_t"), m["type"].alias("_dense"),
                             m["colPtrs"].alias("_ptr"), m["rowIndices"].alias("_row"), F.posexplode(m["values"]).alias("_at", "coefficient"))
        # Values lie by column, or by row if transposed; a sparse matrix names the inner place and where each outer one starts.
        outer = F.when(F.col("_dense") == 1, F.floor(F.col("_at") / F.when(F.col("_t"), F.col("_c")).otherwise(F.col("_r")))).otherwise(
            F.size(F.filter("_ptr", lambda p: p <= F.col("_at"))) - 1
        )
        inner = F.when(F.col("_dense") == 1, F.col("_at") % F.when(F.col("_t"), F.col("_c")).otherwise(F.col("_r"))).otherwise(F.get("_row", F.col("_at")))
        located = rows.select(outer.cast("int").alias("_o"), inner.cast("int").alias("_i"), "_t", "coefficient")
        return located.select(
            F.when(F.col("_t"), F.col("_o")).otherwise(F.col("_i")).alias("class"),
            F.when(F.col("_t"), F.col("_i")).otherwise(F.col("_o")).alias("place"),
            "coefficient",
        )
    return matrix.select(F.lit(0).alias("class"), F.inline(vector_entries("coefficients")).alias("place", "coefficient"))


def saved_weights(model, spark) -> DataFrame:
    """The weights of a Spark ML model, read from the files it is saved in."""
    path = scratch_path(spark, "weights")
    model.write().overwrite().save(path)
    return weight_table(spark.read.parquet(f"{path}/data"))


def _judged(sums: DataFrame, weights: DataFrame, names: DataFrame, tolerance: float, pulled: Column) -> DataFrame:
    joined = sums.join(weights, ["class", "place"], "left").join(names, "place").fillna(0.0, ["coefficient"])
    pull = F.when(F.col("place") == INTERCEPT, 0.0).otherwise(pulled)
    told = joined.select("class", "feature", "moment", F.abs(F.col("moment") - F.col("fitted") - pull).alias("gap"), "size", pull.alias("pull"))
    told = materialise(told, "certificate")
    most = F.greatest(tolerance * F.col("size"), PULL_SHARE * told.agg(F.max(F.abs("pull"))).scalar())
    return told.select("class", "feature", "moment", "gap", (F.col("gap") <= most).alias("holds"))


def logistic_certificate(
    model: LogisticModel, train: DataFrame, target: str, c: float = 1.0, tolerance: float = TOLERANCE
) -> DataFrame:
    """(label, feature, moment, gap, holds) of every weight of a balanced, L2-penalised logistic regression.

    The moment of a class and a feature is the sum of the feature over the rows of the class, each with its class weight;
    the model puts its class probabilities in place of the labels, and adds the weight over C.
    """
    spark = train.sparkSession
    weight = {r["label"]: float(r["weight"]) for r in class_weights(train, target).collect()}
    of_label = F.create_map(*[F.lit(x) for pair in weight.items() for x in pair])
    vectors = model.model.transform(model.view.transform(train, "_features"))
    # An entry of zero, which dense vectors have, adds nothing.
    rows = vectors.select(F.col(target).alias("_label"), of_label[F.col(target)].alias("_w"), vector_to_array("_probability").alias("_p"),
                          F.inline(with_intercept("_features")).alias("place", "x")).where("x <> 0")
    sides = F.array(
        *[
            F.struct(
                F.lit(k).alias("class"),
                F.when(F.col("_label") == label, F.col("_w") * F.col("x")).otherwise(0.0).alias("moment"),
                (F.col("_w") * F.get("_p", F.lit(k)) * F.col("x")).alias("fitted"),
            )
            for k, label in enumerate(model.labels)
        ]
    )
    each = rows.select("place", F.abs(F.col("_w") * F.col("x")).alias("size"), F.inline(sides))
    sums = each.groupBy("class", "place").agg(*[F.sum(x).alias(x) for x in ("moment", "fitted", "size")])
    judged = _judged(sums, saved_weights(model.model, spark), name_table(model.view, spark), tolerance, F.col("coefficient") / c)
    named = F.element_at(F.array(*[F.lit(v) for v in model.labels]), F.col("class") + 1)
    return judged.select(named.alias("label"), "feature", "moment", "gap", "holds")


def linear_certificate(
    model: LogLinearModel, train: DataFrame, target: str, alpha: float, l1_ratio: float = 0.0, summed: bool = False, tolerance: float = TOLERANCE
) -> DataFrame:
    """(feature, moment, gap, holds) of every weight of a penalised linear model of log(1 + target).

    The moment of a feature is its mean product with the log target (its sum, if the penalty counts against the sum); the
    model puts its own prediction in place of the target, and adds the penalty's slope. A weight of zero may have any
    slope of the absolute part's size at most.
    """
    spark = train.sparkSession
    scored = model.model.transform(model.view.transform(train, "_features"))
    rows = scored.select(F.log1p(F.col(target)).alias("_y"), "_log", F.inline(with_intercept("_features")).alias("place", "x")).where("x <> 0")
    sums = rows.groupBy(F.lit(0).alias("class"), "place").agg(
        F.sum(F.col("x") * F.col("_y")).alias("moment"), F.sum(F.col("x") * F.col("_log")).alias("fitted"), F.sum(F.abs("x")).alias("size")
    )
    if not summed:
        n = rows.where(F.col("place") == INTERCEPT).agg(F.count(F.lit(1))).scalar()
        sums = sums.select("class", "place", *[(F.col(x) / n).alias(x) for x in ("moment", "fitted", "size")])
    w, bound = F.col("coefficient"), alpha * l1_ratio
    rest = F.col("moment") - F.col("fitted")
    slope = F.when(w != 0, F.signum(w) * bound).otherwise(F.greatest(F.least(rest, F.lit(bound)), F.lit(-bound)))
    judged = _judged(sums, saved_weights(model.model, spark), name_table(model.view, spark), tolerance, w * alpha * (1 - l1_ratio) + slope)
    return judged.drop("class")
