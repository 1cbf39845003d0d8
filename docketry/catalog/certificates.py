"""Fitted models against the moments of their training rows, which SQL computes without any model."""

from __future__ import annotations

from pyspark.sql import functions as F

from docketry import schema as S
from docketry.catalog import bindings as B
from docketry.catalog.features import TERMS_SQL
from docketry.catalog.models import COMBINED, LINE_COLUMNS, TABULAR, TEXT, line_table
from docketry.models import certificates
from docketry.models.classifiers import LogisticClassifier
from docketry.models.regressors import LogLinearRegressor
from docketry.operators.features import RARE_BELOW, RARE_NAME
from docketry.session import materialise

QUERIES, ORACLES, register = B.registrar()


def _entries_sql(text: bool, categories: tuple[str, ...], numbers: tuple[str, ...]) -> str:
    """The named entries of the rows of ``source`` (doc_id, text and the columns)."""
    parts = ["SELECT doc_id, 'intercept' AS feature, 1.0::DOUBLE AS x FROM source"]
    if text:
        parts.append("SELECT doc_id, 'text__' || term, weight FROM weights")
    for c in categories:
        name = f"CASE WHEN n >= {RARE_BELOW} THEN '{c}_' || k ELSE '{c}_{RARE_NAME}' END"
        parts.append(
            f"SELECT doc_id, {name}, 1.0 FROM (SELECT doc_id, coalesce({c}, 'missing') AS k, "
            f"count(*) OVER (PARTITION BY coalesce({c}, 'missing')) AS n FROM source)"
        )
    parts += [f"SELECT doc_id, '{c}', coalesce({c}, (SELECT median({c}) FROM source))::DOUBLE FROM source" for c in numbers]
    terms = TERMS_SQL.replace("documents", "source") + ", " if text else ""
    return f"{terms} entries AS (SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE x <> 0)"


def _logistic_sql(columns) -> str:
    when = B.DOCUMENT_TIME_SQL
    return f"""WITH source AS MATERIALIZED (
          SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, day({when}) AS day, hour({when}) AS hour,
                 CASE WHEN quality = 1 THEN 'good' ELSE 'poor' END AS grade
          FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE {when} <= TIMESTAMP '{B.DOC_TRAIN_END}'),
        grades AS (SELECT grade AS label, (SELECT count(*) FROM source) / (count(*) OVER () * count(*))::DOUBLE AS w FROM source GROUP BY grade),
        {_entries_sql(bool(columns.text), columns.categories, columns.numbers)}
        SELECT label, feature, round(sum(CASE WHEN grade = label THEN w * x ELSE 0 END), 4) AS moment, true AS holds
        FROM entries JOIN source USING (doc_id) CROSS JOIN grades GROUP BY label, feature"""


LINES_SQL = f"""WITH {B.LINE_SQL}, source AS MATERIALIZED (
          SELECT row_number() OVER () AS doc_id, activity AS text, borough AS ARRONDISSEMENT, year(creation_ts) AS creation_year,
                 month(creation_ts) AS creation_month, ln(1 + days) AS y FROM durations WHERE split = 'train'),
        {_entries_sql(True, LINE_COLUMNS.categories, LINE_COLUMNS.numbers)}
        SELECT feature, round(MOMENT, 4) AS moment, true AS holds FROM entries JOIN source USING (doc_id) GROUP BY feature"""


def _logistic(spark, sf_dir, columns, tolerance=certificates.TOLERANCE):
    train = materialise(B.labelled_documents(spark, sf_dir).where("split = 'train'"), "documents")
    model = LogisticClassifier(columns).fit(train, "grade", "doc_id")
    return _shown(certificates.logistic_certificate(model, train, "grade", tolerance=tolerance))


def _linear(spark, sf_dir, alpha, l1_ratio, summed):
    train = line_table(spark, sf_dir).where("split = 'train'")
    model = LogLinearRegressor(LINE_COLUMNS, alpha=alpha, l1_ratio=l1_ratio, summed=summed).fit(train, S.DURATION, "l_orderkey")
    return _shown(certificates.linear_certificate(model, train, S.DURATION, alpha, l1_ratio, summed, tolerance=1e-4))


def _shown(certificate):
    return certificate.drop("gap").withColumn("moment", F.round("moment", 4))


@register("certificate_logistic_tabular", _logistic_sql(TABULAR))
def certificate_logistic_tabular(spark, sf_dir):
    return _logistic(spark, sf_dir, TABULAR, 1e-4)


@register("certificate_logistic_text", _logistic_sql(TEXT))
def certificate_logistic_text(spark, sf_dir):
    return _logistic(spark, sf_dir, TEXT)


@register("certificate_logistic_combined", _logistic_sql(COMBINED))
def certificate_logistic_combined(spark, sf_dir):
    return _logistic(spark, sf_dir, COMBINED)


@register("certificate_ridge", LINES_SQL.replace("MOMENT", "sum(x * y)"))
def certificate_ridge(spark, sf_dir):
    return _linear(spark, sf_dir, 1.0, 0.0, True)


@register("certificate_elasticnet", LINES_SQL.replace("MOMENT", "sum(x * y) / (SELECT count(*) FROM source)"))
def certificate_elasticnet(spark, sf_dir):
    return _linear(spark, sf_dir, 0.0005, 0.5, False)
