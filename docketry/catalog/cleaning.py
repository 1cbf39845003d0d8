"""Scans, scalar functions, frames and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from docketry import schema as S
from docketry.catalog import bindings as B
from docketry.functions import text as TX
from docketry.functions import values as V
from docketry.operators import frames
from docketry.session import scratch_path
from docketry.sources import tables

QUERIES, ORACLES, register = B.registrar()

# Unicode white space, spelled out: the SQL engine's own class is ASCII only.
SPACE_SQL = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def collapse_sql(text: str) -> str:
    return f"trim(regexp_replace({text}, '{SPACE_SQL}', ' ', 'g'))"


def damage_sql(text: str) -> str:
    """UTF-8 bytes read as Latin-1."""
    return (
        f"array_to_string(list_transform(regexp_extract_all(hex(encode({text})), '..'), "
        "lambda h: chr(('0x' || h)::INTEGER)), '')"
    )


def repair_sql(text: str) -> str:
    """``text`` must be collapsed."""
    as_bytes = (
        f"unhex(array_to_string(list_transform(string_split({text}, ''), "
        "lambda c: printf('%02x', unicode(c))), ''))"
    )
    return (
        f"CASE WHEN regexp_matches({text}, '[ÃÂâ�]') AND NOT regexp_matches({text}, '[^\\x{{00}}-\\x{{FF}}]') "
        f"THEN coalesce(try(decode({as_bytes})), {text}) ELSE {text} END"
    )


def fold_sql(text: str) -> str:
    """Lower-case ASCII of a text without damage marks."""
    plain = f"regexp_replace(strip_accents({collapse_sql(text)}), '[^\\x00-\\x7F]', '', 'g')"
    return collapse_sql(f"lower({plain})")


# --- scans ----------------------------------------------------------------------------------


@register(
    "scan_csv_clean",
    f"""SELECT doc_id::VARCHAR AS doc_id, CASE WHEN lang = 'en' THEN NULL ELSE lang END AS lang,
               {collapse_sql('text')} AS text FROM documents""",
)
def scan_csv_clean(spark, sf_dir):
    """Whole documents through a UTF-16 CSV file: line breaks in quotes, missing-value words."""
    path = scratch_path(spark, "raw-csv")
    lang = F.when(F.col("lang") == "en", "N/A").otherwise(F.col("lang"))
    raw = B.documents_table(spark, sf_dir).select("doc_id", lang.alias("lang"), "text")
    raw.write.options(header=True, encoding="UTF-16", escape='"', quoteAll=True).csv(path)
    scanned = tables.scan_csv(spark, path)
    return scanned.select("doc_id", "lang", TX.repair_text(F.col("text")).alias("text"))


@register(
    "row_id_assign",
    "SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_id, o_orderkey, o_orderdate FROM orders",
)
def row_id_assign(spark, sf_dir):
    orders = B.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return tables.with_row_id(orders, ["o_orderdate", "o_orderkey"])


@register(
    "row_id_files",
    """SELECT row_number() OVER (ORDER BY part, o_orderkey) - 1 AS row_id, o_orderkey, part
       FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'a' WHEN o_orderkey % 10 < 8 THEN 'b' ELSE 'c' END AS part
             FROM orders)""",
)
def row_id_files(spark, sf_dir):
    """Row ids follow the files' names and the rows in them, whatever the files' sizes."""
    path = scratch_path(spark, "files")
    key = F.col("o_orderkey")
    part = F.when(key % 10 == 0, "a").when(key % 10 < 8, "b").otherwise("c")
    orders = B.table(spark, sf_dir, "orders").select("o_orderkey", part.alias("part"))
    sorted_rows = orders.repartitionByRange("part", "o_orderkey").sortWithinPartitions("part", "o_orderkey")
    sorted_rows.write.partitionBy("part").csv(path)
    scanned = spark.read.schema("o_orderkey bigint, part string").csv(path)
    return tables.with_row_id(scanned)


@register(
    "limit_first_rows",
    "SELECT * FROM (SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_id, o_orderkey "
    "FROM orders) WHERE row_id < 1000",
)
def limit_first_rows(spark, sf_dir):
    orders = B.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    numbered = tables.with_row_id(orders, ["o_orderdate", "o_orderkey"])
    return tables.first_rows(numbered, 1000).select("row_id", "o_orderkey")


# --- text -----------------------------------------------------------------------------------


@register(
    "text_ws_collapse",
    f"""SELECT doc_id, {collapse_sql("replace(text, 'e ', 'e' || chr(160) || chr(28) || chr(8195))")} AS text
        FROM documents""",
)
def text_ws_collapse(spark, sf_dir):
    spaced = F.replace(F.col("text"), F.lit("e "), F.lit("e \u001c "))
    documents = B.documents_table(spark, sf_dir)
    return documents.select("doc_id", TX.collapse_spaces(spaced).alias("text"))


@register(
    "text_mojibake_repair",
    f"""WITH damaged AS (SELECT doc_id, {collapse_sql(f"CASE WHEN lang = 'de' THEN text ELSE {damage_sql('text')} END")} AS c
                         FROM documents)
        SELECT doc_id, {repair_sql('c')} AS text FROM damaged""",
)
def text_mojibake_repair(spark, sf_dir):
    """All texts but the German ones are damaged first."""
    damaged = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    documents = B.documents_table(spark, sf_dir).select(
        "doc_id", F.when(F.col("lang") == "de", F.col("text")).otherwise(damaged).alias("raw")
    )
    return TX.repair_columns(documents, {"text": F.col("raw")}).select("doc_id", "text")


@register("text_fold_ascii", f"SELECT doc_id, {fold_sql('text')} AS folded FROM documents")
def text_fold_ascii(spark, sf_dir):
    documents = B.documents_table(spark, sf_dir)
    return TX.fold_columns(documents, {"folded": F.col("text")}).select("doc_id", "folded")


ORDER_LABELS = {"1-urgent": "Urgent", "2-high": "High", "3-medium": "Medium"}


@register(
    "label_canonicalize",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'High'
              WHEN '3-MEDIUM' THEN 'Medium' END AS label FROM orders""",
)
def label_canonicalize(spark, sf_dir):
    orders = B.table(spark, sf_dir, "orders")
    raw = F.concat(F.lit(" "), F.translate("o_orderpriority", "UEI", "ÙÊÏ"), F.lit(" "))
    folded = TX.fold_columns(orders, {"folded": raw})
    return folded.select("o_orderkey", TX.label_of(F.col("folded"), ORDER_LABELS).alias("label"))


# --- numbers and time -----------------------------------------------------------------------


@register(
    "numeric_coerce",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN o_totalprice WHEN 'P' THEN NULL
              ELSE round(o_totalprice) END AS price FROM orders""",
)
def numeric_coerce(spark, sf_dir):
    """Padded numbers parse; a Java suffix does not; exponents do."""
    price = F.col("o_totalprice")
    raw = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("  "), price.cast("string"), F.lit(" ")))
        .when(F.col("o_orderstatus") == "P", F.concat(price.cast("string"), F.lit("d")))
        .otherwise(F.concat(F.round(price).cast("bigint").cast("string"), F.lit("e0")))
    )
    orders = B.table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw"))
    return orders.select("o_orderkey", V.to_number(F.col("raw")).alias("price"))


@register(
    "ts_parse_mixed",
    """SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN date_trunc('day', ts)
              WHEN 'purchase' THEN ts ELSE date_trunc('second', ts) END AS parsed FROM events""",
)
def ts_parse_mixed(spark, sf_dir):
    """Slashes, ISO with and without fraction, compact dates, and one unreadable form."""
    kind, ts = F.col("event_type"), F.col("ts")
    raw = (
        F.when(kind == "error", F.date_format(ts, "dd/MM/yyyy"))
        .when(kind == "signup", F.date_format(ts, "yyyyMMdd"))
        .when(kind == "purchase", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .when(kind == "click", F.date_format(ts, "yyyy/MM/dd HH:mm:ss"))
        .otherwise(F.date_format(ts, "yyyy-M-d H:mm:ss"))
    )
    events = B.table(spark, sf_dir, "events").select("event_id", raw.alias("raw"))
    return events.select("event_id", V.to_timestamp(F.col("raw")).alias("parsed"))


@register(
    "calendar_features",
    """SELECT event_id, year(ts)::INTEGER AS creation_year, month(ts)::INTEGER AS creation_month,
              (isodow(ts) - 1)::INTEGER AS creation_dayofweek, hour(ts)::INTEGER AS creation_hour FROM events""",
)
def calendar_features(spark, sf_dir):
    events = B.table(spark, sf_dir, "events")
    return events.select(
        "event_id", *[c.alias(n) for n, c in V.calendar_parts(F.col("ts")).items()]
    )


@register(
    "presence_flag",
    """SELECT c_custkey, CASE WHEN c_acctbal > 0 AND c_mktsegment <> 'FURNITURE' THEN 1.0 ELSE 0.0 END::DOUBLE AS flag
       FROM customer""",
)
def presence_flag(spark, sf_dir):
    balance = F.when(F.col("c_acctbal") > 0, F.col("c_acctbal"))
    segment = F.nullif(F.col("c_mktsegment"), F.lit("FURNITURE"))
    customer = B.table(spark, sf_dir, "customer")
    return customer.select("c_custkey", V.presence_flag(balance, segment).alias("flag"))


@register(
    "month_key_counts",
    "SELECT strftime(o_orderdate, '%Y-%m') AS sample_month, count(*) AS n FROM orders GROUP BY ALL",
)
def month_key_counts(spark, sf_dir):
    orders = B.table(spark, sf_dir, "orders")
    return orders.groupBy(V.month_key(F.col("o_orderdate")).alias(S.MONTH)).agg(
        F.count(F.lit(1)).alias("n")
    )


@register(
    "duration_days",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
              date_diff('microsecond', o_orderdate, l_shipdate) / 1e6 / 86400.0 AS days
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def duration_days(spark, sf_dir):
    lines = B.line_records(spark, sf_dir)
    return lines.select(
        *B.LINE_KEY, V.duration_days(F.col(S.CREATED), F.col(S.UPDATED)).alias("days")
    )


@register(
    "optional_columns",
    """SELECT o_orderkey, o_orderdate AS creation_ts, NULL::TIMESTAMP AS last_status_ts,
              NULL::VARCHAR AS "NATURE_TARGET", NULL::VARCHAR AS "FINAL_STATUS_FOLDED", '' AS "ACTI_NOM",
              year(o_orderdate)::INTEGER AS creation_year, 0.0::DOUBLE AS has_geo FROM orders""",
)
def optional_columns(spark, sf_dir):
    """A table with a creation time and nothing else that cleaning knows."""
    orders = B.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias("DDS_DATE_CREATION")
    )
    return frames.prepare_base(orders).select(
        "o_orderkey", S.CREATED, S.UPDATED, S.TARGET, S.STATUS, "ACTI_NOM", "creation_year", S.HAS_PLACE
    )


@register(
    "log_target_roundtrip",
    """SELECT o_orderkey, round(ln(1 + o_totalprice), 6) AS logged, round(o_totalprice, 4) AS price FROM orders""",
)
def log_target_roundtrip(spark, sf_dir):
    orders = B.table(spark, sf_dir, "orders").withColumn("logged", F.log1p("o_totalprice"))
    return orders.select(
        "o_orderkey", B.six("logged"), F.round(F.expm1("logged"), 4).alias("price")
    )


# --- frames and filters ---------------------------------------------------------------------

# Damaged, padded and accented spellings that fold to the canonical labels; one folds to none.
NATURE_SPELLINGS = {
    "1-URGENT": "RequÃªte",
    "2-HIGH": "  Plainte ",
    "3-MEDIUM": "INFORMATION",
    "4-NOT SPECIFIED": "Commentaire",
    "5-LOW": "Autre",
}
STATUS_SPELLINGS = {"F": "TerminÃ©", "O": "Annulé ", "P": "En cours"}


def raw_records(spark, sf_dir):
    """Orders dressed as raw text records."""
    orders = B.table(spark, sf_dir, "orders")
    customer = B.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_acctbal", "c_mktsegment"
    )

    def spell(name, words):
        pairs = F.create_map(*[F.lit(x) for kv in words.items() for x in kv])
        return pairs[F.col(name)]

    date = F.col("o_orderdate")
    created = F.when(F.col("o_orderstatus") == "O", F.date_format(date, "yyyy/MM/dd HH:mm:ss")).otherwise(
        F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss")
    )
    updated = F.date_format(F.date_add(date, F.lit(30)), "yyyy-MM-dd")
    return orders.join(customer, "o_custkey").select(
        "o_orderkey",
        spell("o_orderpriority", NATURE_SPELLINGS).alias("NATURE"),
        spell("o_orderstatus", STATUS_SPELLINGS).alias("DERNIER_STATUT"),
        created.alias("DDS_DATE_CREATION"),
        F.when(F.col("o_orderstatus") == "F", updated).alias("DATE_DERNIER_STATUT"),
        F.nullif(F.col("c_mktsegment"), F.lit("FURNITURE")).alias("ACTI_NOM"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal").cast("string")).otherwise("none").alias("LOC_LAT"),
        F.lit("-73.5").alias("LOC_LONG"),
    )


BASE_SQL = """
WITH base AS (
  SELECT o_orderkey,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Requête' WHEN '2-HIGH' THEN 'Plainte'
              WHEN '3-MEDIUM' THEN 'INFORMATION' WHEN '4-NOT SPECIFIED' THEN 'Commentaire' ELSE 'Autre' END AS "NATURE",
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Requete' WHEN '2-HIGH' THEN 'Plainte'
              WHEN '3-MEDIUM' THEN 'Information' WHEN '4-NOT SPECIFIED' THEN 'Commentaire' END AS "NATURE_TARGET",
         CASE o_orderstatus WHEN 'F' THEN 'termine' WHEN 'O' THEN 'annule' ELSE 'en cours' END AS "FINAL_STATUS_FOLDED",
         o_orderdate AS creation_ts,
         CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 30 DAY END AS last_status_ts,
         CASE WHEN c_mktsegment = 'FURNITURE' THEN '' ELSE c_mktsegment END AS "ACTI_NOM",
         CASE WHEN c_acctbal > 0 THEN c_acctbal END AS "LOC_LAT",
         year(o_orderdate)::INTEGER AS creation_year, month(o_orderdate)::INTEGER AS creation_month,
         (isodow(o_orderdate) - 1)::INTEGER AS creation_dayofweek, hour(o_orderdate)::INTEGER AS creation_hour,
         CASE WHEN c_acctbal > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS has_geo
  FROM orders JOIN customer ON o_custkey = c_custkey)
"""


@register("clean_base", BASE_SQL + "SELECT * FROM base")
def clean_base(spark, sf_dir):
    return frames.prepare_base(raw_records(spark, sf_dir)).select(
        "o_orderkey", "NATURE", S.TARGET, S.STATUS, S.CREATED, S.UPDATED, "ACTI_NOM", "LOC_LAT",
        *S.CALENDAR_FEATURES, S.HAS_PLACE,
    )


@register(
    "classification_frame",
    BASE_SQL + """SELECT o_orderkey, creation_ts, "NATURE_TARGET" FROM base WHERE "NATURE_TARGET" IS NOT NULL""",
)
def classification_frame(spark, sf_dir):
    rows = frames.classification_rows(frames.prepare_base(raw_records(spark, sf_dir)))
    return rows.select("o_orderkey", S.CREATED, S.TARGET)


@register(
    "regression_frame",
    f"WITH {B.LINE_SQL} SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, days AS resolution_time_days, split FROM durations",
)
def regression_frame(spark, sf_dir):
    return B.duration_records(spark, sf_dir).select(*B.LINE_KEY, S.DURATION, "split")


@register(
    "time_split_counts",
    f"WITH {B.LINE_SQL} SELECT split, count(*) AS n_rows FROM durations GROUP BY split",
)
def time_split_counts(spark, sf_dir):
    return B.duration_records(spark, sf_dir).groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


@register(
    "split_guard",
    f"""WITH tagged AS (SELECT CASE WHEN o_orderdate <= TIMESTAMP '{B.TRAIN_END}' THEN 'train'
               WHEN o_orderdate <= TIMESTAMP '{B.VALIDATION_END}' THEN 'validation' ELSE 'test' END AS split,
               o_orderpriority FROM orders)
        SELECT split, count(*) AS n_rows, count(DISTINCT o_orderpriority) AS n_labels FROM tagged GROUP BY split""",
)
def split_guard(spark, sf_dir):
    tagged = B.order_records(spark, sf_dir).withColumn(
        "split", frames.split_label(F.col(S.CREATED), B.TRAIN_END, B.VALIDATION_END)
    )
    return frames.split_summary(tagged, S.TARGET)


@register(
    "union_train_validation",
    f"""WITH {B.LINE_SQL} SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, days AS resolution_time_days
        FROM durations WHERE split <> 'test'""",
)
def union_train_validation(spark, sf_dir):
    rows = frames.train_and_validation(B.duration_records(spark, sf_dir))
    return rows.select(*B.LINE_KEY, S.DURATION)


