"""Text, category and number features."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from docketry.catalog import bindings as B
from docketry.functions import text as TX
from docketry.operators import features as FT
from docketry.schema import FeatureColumns
from docketry.session import materialise, small_table

QUERIES, ORACLES, register = B.registrar()

TOKEN_SQL = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"

TERMS_SQL = f"""
tokens AS (SELECT doc_id, {TOKEN_SQL} AS w FROM documents),
grams AS (SELECT doc_id, unnest(w) AS term, 1 AS size FROM tokens
          UNION ALL
          SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])), 2 FROM tokens),
counts AS (SELECT doc_id, term, count(*) AS tf FROM grams GROUP BY ALL),
totals AS (SELECT term, sum(tf)::BIGINT AS total, count(*) AS df FROM counts GROUP BY term),
vocab AS (SELECT * FROM totals WHERE df >= 5 ORDER BY total DESC, term LIMIT 4000),
raw AS (SELECT doc_id, c.term, tf * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)::DOUBLE) + 1) AS raw
        FROM counts c JOIN vocab v ON c.term = v.term),
weights AS (SELECT doc_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM raw)
"""


def _documents(spark, sf_dir):
    return B.documents_table(spark, sf_dir)


@register(
    "tokenize_counts",
    f"WITH {TERMS_SQL} SELECT doc_id, len(w)::BIGINT AS n_tokens, len(list_distinct(w))::BIGINT AS n_distinct FROM tokens",
)
def tokenize_counts(spark, sf_dir):
    words = _documents(spark, sf_dir).select("doc_id", TX.words(F.col("text")).alias("w"))
    return words.select(
        "doc_id",
        F.size("w").cast("bigint").alias("n_tokens"),
        F.size(F.array_distinct("w")).cast("bigint").alias("n_distinct"),
    )


@register(
    "ngram_counts",
    f"WITH {TERMS_SQL} SELECT term, count(*) AS total, count(DISTINCT doc_id) AS df FROM grams WHERE size = 2 GROUP BY term",
)
def ngram_counts(spark, sf_dir):
    return FT.term_statistics(_documents(spark, sf_dir), "text", sizes=(2,)).where("term IS NOT NULL")


@register("df_filter_vocab", f"WITH {TERMS_SQL} SELECT * FROM vocab")
def df_filter_vocab(spark, sf_dir):
    return FT.vocabulary(FT.term_statistics(_documents(spark, sf_dir), "text").where("term IS NOT NULL"))


@register("tfidf_weights", f"WITH {TERMS_SQL} SELECT doc_id, term, round(weight, 6) AS weight FROM weights")
def tfidf_weights(spark, sf_dir):
    return B.rounded(FT.text_weights(_documents(spark, sf_dir), "text", "doc_id"))


@register(
    "impute_constant",
    "SELECT c_custkey, CASE WHEN c_mktsegment = 'FURNITURE' THEN 'missing' ELSE c_mktsegment END AS segment FROM customer",
)
def impute_constant(spark, sf_dir):
    segment = F.nullif(F.col("c_mktsegment"), F.lit("FURNITURE"))
    customer = B.table(spark, sf_dir, "customer")
    return customer.select("c_custkey", TX.key_or_missing(segment).alias("segment"))


@register(
    "impute_median",
    """SELECT c_custkey, round(coalesce(CASE WHEN c_acctbal > 0 THEN c_acctbal END,
              (SELECT median(c_acctbal) FROM customer WHERE c_acctbal > 0)), 6) AS balance FROM customer""",
)
def impute_median(spark, sf_dir):
    customer = B.table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance")
    )
    median = FT.column_medians(customer, ["balance"]).select("median").scalar()
    return B.rounded(customer.select("c_custkey", F.coalesce("balance", median).alias("balance")))


# --- categories -----------------------------------------------------------------------------

RARE_BELOW = 32


@register(
    "onehot_rare_bucket",
    f"""WITH c AS (SELECT col AS "column", category, count(*) AS n FROM (
          SELECT 'p_name' AS col, p_name AS category FROM part UNION ALL SELECT 'p_brand', p_brand FROM part) GROUP BY ALL),
        f AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY category) - 1 AS slot FROM c WHERE n >= {RARE_BELOW})
        SELECT "column", category, n, slot::INTEGER AS slot, false AS rare FROM f
        UNION ALL SELECT "column", category, n, (SELECT count(*) FROM f WHERE f."column" = c."column")::INTEGER, true
        FROM c WHERE n < {RARE_BELOW}""",
)
def onehot_rare_bucket(spark, sf_dir):
    counts = FT.category_counts(B.table(spark, sf_dir, "part"), ["p_name", "p_brand"])
    return FT.category_codes(counts, RARE_BELOW)


@register(
    "onehot_unknown",
    f"""WITH keyed AS (SELECT p_partkey, p_brand || '/' || p_size AS key, p_type = 'ECONOMY' AS fresh FROM part),
        c AS (SELECT key, count(*) AS n FROM keyed WHERE NOT fresh GROUP BY key),
        f AS (SELECT key, row_number() OVER (ORDER BY key) - 1 AS slot FROM c WHERE n >= 3)
        SELECT p_partkey, CASE WHEN f.key IS NOT NULL THEN f.slot WHEN c.key IS NOT NULL THEN (SELECT count(*) FROM f) END::INTEGER AS slot
        FROM keyed k LEFT JOIN c ON c.key = k.key LEFT JOIN f ON f.key = k.key""",
)
def onehot_unknown(spark, sf_dir):
    """Slots learnt without one part type; categories seen only there have no slot."""
    key = F.concat_ws("/", "p_brand", F.col("p_size").cast("string"))
    parts = B.table(spark, sf_dir, "part").withColumn("key", key)
    codes = FT.category_codes(FT.category_counts(parts.where("p_type <> 'ECONOMY'"), ["key"]), 3)
    coded = FT.apply_codes(parts, materialise(codes, "codes"), ["key"])
    return coded.select("p_partkey", F.col("key_slot").alias("slot"))


# --- views ----------------------------------------------------------------------------------

COLUMNS = FeatureColumns("text", ("lang", "source"), ("n_chars",))


def _view(spark, sf_dir, columns):
    """Vector width, entries and sum of every document's vector."""
    documents = _documents(spark, sf_dir)
    view = FT.FeatureView.fit(documents, columns, "doc_id")
    values = view.transform(documents).select("doc_id", vector_to_array("features").alias("v"))
    return values.select(
        "doc_id",
        F.size("v").cast("bigint").alias("width"),
        F.size(F.filter("v", lambda x: x != 0)).cast("bigint").alias("entries"),
        F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x), 4).alias("total"),
    )


# Per document: one entry per category column, and the text length.
TABULAR_SQL = """
cats AS (SELECT 'lang' AS col, lang AS category, count(*) AS n FROM documents GROUP BY ALL
         UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY ALL),
widths AS (SELECT sum(k) AS width FROM (SELECT col, count(*) FILTER (n >= 20) + max((n < 20)::INTEGER) AS k FROM cats GROUP BY col)),
tabular AS (SELECT doc_id, (SELECT width FROM widths) + 1 AS width, 2 + (n_chars <> 0)::INTEGER AS entries,
                   2.0::DOUBLE + n_chars AS total FROM documents)
"""

TEXT_SQL = """
textual AS (SELECT d.doc_id, (SELECT count(*) FROM vocab) AS width, count(w.term) AS entries, coalesce(sum(weight), 0) AS total
            FROM documents d LEFT JOIN weights w ON w.doc_id = d.doc_id GROUP BY d.doc_id)
"""


@register(
    "feature_view_text",
    f"WITH {TERMS_SQL}, {TEXT_SQL} SELECT doc_id, width, entries, round(total, 4) AS total FROM textual",
)
def feature_view_text(spark, sf_dir):
    return _view(spark, sf_dir, FeatureColumns("text", (), ()))


@register(
    "feature_view_tabular",
    f"WITH {TABULAR_SQL} SELECT doc_id, width::BIGINT AS width, entries::BIGINT AS entries, round(total, 4) AS total FROM tabular",
)
def feature_view_tabular(spark, sf_dir):
    return _view(spark, sf_dir, FeatureColumns(None, COLUMNS.categories, COLUMNS.numbers))


@register(
    "feature_view_combined",
    f"""WITH {TERMS_SQL}, {TEXT_SQL}, {TABULAR_SQL} SELECT doc_id, (x.width + t.width)::BIGINT AS width,
        (x.entries + t.entries)::BIGINT AS entries, round(x.total + t.total, 4) AS total
        FROM textual x JOIN tabular t USING (doc_id)""",
)
def feature_view_combined(spark, sf_dir):
    return _view(spark, sf_dir, COLUMNS)


@register(
    "feature_names",
    f"""WITH {TERMS_SQL}, {TABULAR_SQL}, named AS (
          SELECT 0 AS block, false AS last, term AS sorter, 'text__' || term AS name FROM vocab
          UNION ALL SELECT CASE col WHEN 'lang' THEN 1 ELSE 2 END, false, category, col || '_' || category FROM cats WHERE n >= 20
          UNION ALL SELECT DISTINCT CASE col WHEN 'lang' THEN 1 ELSE 2 END, true, '', col || '_{FT.RARE_NAME}' FROM cats WHERE n < 20
          UNION ALL SELECT 3, false, '', 'n_chars')
        SELECT row_number() OVER (ORDER BY block, last, sorter) - 1 AS position, name FROM named""",
)
def feature_names(spark, sf_dir):
    view = FT.FeatureView.fit(_documents(spark, sf_dir), COLUMNS, "doc_id")
    return small_table(spark, list(enumerate(view.names)), "position bigint, name string")
