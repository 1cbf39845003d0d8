"""Baseline models on labelled documents and line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from docketry import schema as S
from docketry.catalog import bindings as B
from docketry.models.classifiers import CalibratedSvm, LogisticClassifier, PriorClassifier, label_universe
from docketry.models.registry import load_model, save_model
from docketry.models.regressors import LogLinearRegressor, MeanRegressor, MedianRegressor
from docketry.operators import metrics
from docketry.plans.workflows import classification_scores
from docketry.schema import FeatureColumns
from docketry.session import materialise, scratch_path

QUERIES, ORACLES, register = B.registrar()

COMBINED = FeatureColumns("text", ("lang", "source"), ("n_chars", "day", "hour"))
TEXT = FeatureColumns("text", (), ())
TABULAR = FeatureColumns(None, COMBINED.categories, COMBINED.numbers)


def _documents(spark, sf_dir):
    return materialise(B.labelled_documents(spark, sf_dir), "documents")


def _score(spark, sf_dir, classifier):
    documents = _documents(spark, sf_dir)
    train = documents.where("split = 'train'")
    model = classifier.fit(train, "grade", "doc_id")
    scored = model.transform(documents.where("split = 'validation'"))
    kept = materialise(scored.select("doc_id", "grade", "prediction", "probability"), "scored")
    return B.rounded(classification_scores(kept, "grade", label_universe(train, "grade")))


SPLIT_DOCS_SQL = f"""WITH docs AS (SELECT d.doc_id, CASE WHEN quality = 1 THEN 'good' ELSE 'poor' END AS grade,
         CASE WHEN {B.DOCUMENT_TIME_SQL} <= TIMESTAMP '{B.DOC_TRAIN_END}' THEN 'train'
              WHEN {B.DOCUMENT_TIME_SQL} <= TIMESTAMP '{B.DOC_VALIDATION_END}' THEN 'validation' ELSE 'test' END AS split
         FROM documents d JOIN labels l ON l.doc_id = d.doc_id),
       p AS (SELECT count(*) FILTER (grade = 'good') / count(*)::DOUBLE AS good FROM docs WHERE split = 'train'),
       scored AS (SELECT grade, good, CASE WHEN good >= 0.5 THEN 'good' ELSE 'poor' END AS prediction FROM docs, p
                  WHERE split = 'validation') """


@register(
    "model_dummy_prior",
    SPLIT_DOCS_SQL
    + """SELECT count(*) AS n_rows, round(avg((grade = prediction)::INTEGER), 6) AS accuracy,
       round(avg(2 * pow(CASE WHEN grade = 'good' THEN 1 - good ELSE good END, 2)), 6) AS multiclass_brier FROM scored""",
)
def model_dummy_prior(spark, sf_dir):
    documents = _documents(spark, sf_dir)
    model = PriorClassifier().fit(documents.where("split = 'train'"), "grade", "doc_id")
    scored = model.transform(documents.where("split = 'validation'"))
    term = metrics.brier_term(F.col("grade"), F.col("probability"), model.labels)
    correct = (F.col("grade") == F.col("prediction")).cast("double")
    return B.rounded(
        scored.agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.avg(correct).alias("accuracy"),
            F.avg(term).alias("multiclass_brier"),
        )
    )


@register("model_logistic_text")
def model_logistic_text(spark, sf_dir):
    return _score(spark, sf_dir, LogisticClassifier(TEXT))


@register("model_logistic_tabular")
def model_logistic_tabular(spark, sf_dir):
    return _score(spark, sf_dir, LogisticClassifier(TABULAR))


@register("model_logistic_combined")
def model_logistic_combined(spark, sf_dir):
    return _score(spark, sf_dir, LogisticClassifier(COMBINED))


@register("model_svc_calibrated")
def model_svc_calibrated(spark, sf_dir):
    return _score(spark, sf_dir, CalibratedSvm(COMBINED))


# --- regression -----------------------------------------------------------------------------

LINE_COLUMNS = FeatureColumns("ACTI_NOM", ("ARRONDISSEMENT",), ("creation_year", "creation_month"))


def line_table(spark, sf_dir):
    records = B.duration_records(spark, sf_dir)
    return materialise(
        records.select(
            *B.LINE_KEY, S.DURATION, "split", "ACTI_NOM", "ARRONDISSEMENT",
            F.year(S.CREATED).alias("creation_year"), F.month(S.CREATED).alias("creation_month"),
        ),
        "lines",
    )


def _errors(spark, sf_dir, regressor):
    lines = line_table(spark, sf_dir)
    model = regressor.fit(lines.where("split = 'train'"), S.DURATION, "l_orderkey")
    scored = model.transform(lines.where("split = 'validation'"))
    return B.rounded(metrics.regression_metrics(scored, S.DURATION, "prediction"))


@register(
    "model_dummy_mean",
    f"""WITH {B.LINE_SQL}, m AS (SELECT avg(days) AS mean FROM durations WHERE split = 'train')
        SELECT round(avg(abs(days - mean)), 6) AS mae, round(sqrt(avg((days - mean) * (days - mean))), 6) AS rmse
        FROM durations, m WHERE split = 'validation'""",
)
def model_dummy_mean(spark, sf_dir):
    return _errors(spark, sf_dir, MeanRegressor())


@register("model_ridge")
def model_ridge(spark, sf_dir):
    return _errors(spark, sf_dir, LogLinearRegressor(LINE_COLUMNS, alpha=1.0, summed=True))


@register("model_elasticnet")
def model_elasticnet(spark, sf_dir):
    return _errors(spark, sf_dir, LogLinearRegressor(LINE_COLUMNS, alpha=0.0005, l1_ratio=0.5))


@register("linear_contributions")
def linear_contributions(spark, sf_dir):
    """The strongest weights of a fitted ridge model, with their feature names."""
    lines = line_table(spark, sf_dir)
    model = LogLinearRegressor(LINE_COLUMNS, alpha=1.0, summed=True).fit(
        lines.where("split = 'train'"), S.DURATION, "l_orderkey"
    )
    return B.rounded(metrics.top_coefficients(model.coefficients()))


@register(
    "model_save_load",
    f"""WITH {B.LINE_SQL} SELECT model, (SELECT count(*) FROM durations WHERE split = 'test') AS n_rows, 0.0::DOUBLE AS gap
        FROM (VALUES ('LogLinearModel'), ('MeanModel'), ('MedianModel')) t(model)
        UNION ALL SELECT model, (SELECT count(*) FROM documents d JOIN labels l USING (doc_id)
                                 WHERE {B.DOCUMENT_TIME_SQL} > TIMESTAMP '{B.DOC_VALIDATION_END}'), 0.0
        FROM (VALUES ('CalibratedSvmModel'), ('LogisticModel'), ('PriorModel')) t(model)""",
)
def model_save_load(spark, sf_dir):
    """Predictions of every kind of model after saving and loading; ``gap`` to the original ones must be 0."""
    lines, documents = line_table(spark, sf_dir), _documents(spark, sf_dir)
    regressors = (LogLinearRegressor(LINE_COLUMNS, alpha=1.0, summed=True), MeanRegressor(), MedianRegressor())
    classifiers = (CalibratedSvm(TABULAR), LogisticClassifier(TABULAR), PriorClassifier())
    tasks = [(r, lines, S.DURATION, "l_orderkey", F.col("prediction")) for r in regressors]
    # All class scores of a row weigh in, each with its place.
    weighed = F.aggregate("probability", F.lit(0.0), lambda s, p: s * 7 + p)
    tasks += [(c, documents, "grade", "doc_id", weighed) for c in classifiers]
    found = None
    for estimator, rows, target, row_id, shown in tasks:
        model = estimator.fit(rows.where("split = 'train'"), target, row_id)
        path = scratch_path(spark, "model")
        save_model(model, path)
        again = load_model(spark, path)
        test = rows.where("split = 'test'")
        first = model.transform(test).withColumn("first", shown).drop("prediction", "probability")
        gap = F.coalesce(F.max(F.abs(F.col("first") - shown)), F.lit(0.0))
        row = again.transform(first).agg(
            F.lit(type(model).__name__).alias("model"), F.count(F.lit(1)).alias("n_rows"), gap.alias("gap")
        )
        found = row if found is None else found.unionByName(row)
    return found
