"""How the record roles bind to the test tables, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry import schema as S
from docketry.operators import frames
from docketry.schema import RecordSchema

Query = Callable[[SparkSession, str], DataFrame]

TRAIN_END = "1999-06-30 23:59:59"
VALIDATION_END = "2000-06-30 23:59:59"

DOC_TRAIN_END = "2024-01-02 12:00:00"
DOC_VALIDATION_END = "2024-01-03 06:00:00"

# Closing states among the lower-case order states.
ORDER_SCHEMA = RecordSchema(closed_states=("f", "o"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def registrar() -> tuple[dict[str, Query], dict[str, str], Callable]:
    """Two tables, and a decorator that adds a query and its SQL to them."""
    queries: dict[str, Query] = {}
    oracles: dict[str, str] = {}

    def register(name: str, sql: str | None = None):
        def add(run: Query) -> Query:
            queries[name] = run
            if sql is not None:
                oracles[name] = sql
            return run

        return add

    return queries, oracles, register


def six(column: Column | str, name: str | None = None) -> Column:
    """Rounded to six places, so that the order of a floating-point sum does not show."""
    out = F.round(F.col(column) if isinstance(column, str) else column, 6)
    return out.alias(name or column) if isinstance(column, str) or name else out


def rounded(df: DataFrame) -> DataFrame:
    """All double columns to six places; minus zero becomes zero."""
    return df.select(
        *[
            (F.round(F.col(f"`{n}`"), 6) + F.lit(0.0)).alias(n) if t == "double" else F.col(f"`{n}`")
            for n, t in df.dtypes
        ]
    )


def documents_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


# --- orders as records for sampling ---------------------------------------------------------


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_orderdate").alias(S.CREATED),
        F.col("o_orderpriority").alias(S.TARGET),
    )


# --- line items as records for regression ---------------------------------------------------

LINE_KEY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


def line_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with order, part and customer; columns are pruned before the joins.

    Returned items of later orders carry an activity that training never saw.
    """
    line = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_shipdate", "l_returnflag")
    order = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate", "o_orderstatus"
    )
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_mktsegment"
    )
    joined = line.join(order, "l_orderkey").join(part, "l_partkey").join(customer, "o_custkey")
    later = F.col("o_orderdate") > F.lit(TRAIN_END).cast("timestamp_ntz")
    unseen = (F.col("l_returnflag") == "R") & later
    return joined.select(
        *LINE_KEY,
        F.col("o_orderdate").alias(S.CREATED),
        F.col("l_shipdate").alias(S.UPDATED),
        F.lower("o_orderstatus").alias(S.STATUS),
        F.when(unseen, F.concat("p_name", F.lit(" (new)"))).otherwise(F.col("p_name")).alias("ACTI_NOM"),
        F.col("c_mktsegment").alias("ARRONDISSEMENT"),
    )


def duration_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.regression_rows(line_records(spark, sf_dir), ORDER_SCHEMA).withColumn(
        "split", frames.split_label(F.col(S.CREATED), TRAIN_END, VALIDATION_END)
    )


LINE_SQL = f"""
lines AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
         o_orderdate AS creation_ts, l_shipdate AS last_status_ts, lower(o_orderstatus) AS status,
         CASE WHEN l_returnflag = 'R' AND o_orderdate > TIMESTAMP '{TRAIN_END}'
              THEN p_name || ' (new)' ELSE p_name END AS activity,
         c_mktsegment AS borough
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey),
durations AS (
  SELECT *, date_diff('microsecond', creation_ts, last_status_ts) / 1e6 / 86400.0 AS days,
         CASE WHEN creation_ts <= TIMESTAMP '{TRAIN_END}' THEN 'train'
              WHEN creation_ts <= TIMESTAMP '{VALIDATION_END}' THEN 'validation'
              ELSE 'test' END AS split
  FROM lines WHERE status IN ('f', 'o') AND last_status_ts >= creation_ts)
"""


# --- orders with made-up class scores for metric queries ------------------------------------

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
MULTIPLIERS = (31, 37, 41, 43, 47)


def scored_orders(
    spark: SparkSession, sf_dir: str, multipliers: tuple[int, ...] = MULTIPLIERS
) -> DataFrame:
    """Orders with class probabilities from integer arithmetic, and the most probable class."""
    from docketry.operators.metrics import argmax_label

    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", F.col("o_orderpriority").alias("actual")
    )
    raw = [(F.col("o_orderkey") * m) % 97 + 1 for m in multipliers]
    total = sum(raw[1:], raw[0])
    scored = orders.withColumn("probability", F.array(*[r / total for r in raw]))
    return scored.withColumn("prediction", argmax_label(F.col("probability"), PRIORITIES))


def scored_sql(multipliers: tuple[int, ...] = MULTIPLIERS, name: str = "scored") -> str:
    raw = ", ".join(f"(o_orderkey * {m}) % 97 + 1" for m in multipliers)
    labels = ", ".join(f"'{p}'" for p in PRIORITIES)
    return f"""
{name}_raw AS (SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority AS actual, [{raw}] AS s FROM orders),
{name} AS (
  SELECT *, [{labels}][list_position(s, list_max(s))] AS prediction,
         list_transform(s, lambda x: x::DOUBLE / list_sum(s)) AS probability
  FROM {name}_raw)
"""


LABEL_LIST_SQL = "labels_list AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{p}')" for i, p in enumerate(PRIORITIES)
) + ") t(position, label))"


# --- documents as labelled text records -----------------------------------------------------


def document_time(column: str = "doc_id") -> Column:
    """A time within three days that the id alone decides."""
    minutes = F.pmod(F.col(column) * 37, F.lit(4320)).cast("int")
    return F.timestamp_add("MINUTE", minutes, F.lit("2024-01-01").cast("timestamp_ntz"))


DOCUMENT_TIME_SQL = "TIMESTAMP '2024-01-01' + to_minutes(((d.doc_id * 37) % 4320)::INTEGER)"


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All labelled documents, with a creation time from the id."""
    documents = documents_table(spark, sf_dir).select("doc_id", "text", "lang", "source", "n_chars")
    labels = table(spark, sf_dir, "labels")
    joined = documents.join(labels, "doc_id").withColumn(S.CREATED, document_time())
    when = F.col(S.CREATED)
    return joined.withColumns(
        {
            "split": frames.split_label(when, DOC_TRAIN_END, DOC_VALIDATION_END),
            "grade": F.when(F.col("quality") == 1, "good").otherwise("poor"),
            "hour": F.hour(when),
            "day": F.dayofmonth(when),
        }
    )
