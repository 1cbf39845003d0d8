"""Stratified sampling of orders by month and priority."""

from __future__ import annotations

from pyspark.sql import functions as F

from docketry import schema as S
from docketry.catalog import bindings as B
from docketry.operators import sampling as SM
from docketry.session import materialise, scratch_path
from docketry.sources import tables

QUERIES, ORACLES, register = B.registrar()

SEED = 42


def quota_sql(target: int, minimum: int, largest_first: bool = False) -> str:
    """Quotas by dealing single units in rounds, which is what the closed form replaces."""
    way = "DESC" if largest_first else "ASC"
    return f"""
strata AS (SELECT strftime(o_orderdate, '%Y-%m') AS sample_month, o_orderpriority AS "NATURE_TARGET", count(*) AS n
           FROM orders GROUP BY ALL),
raws AS (SELECT *, n / (sum(n) OVER ())::DOUBLE * least({target}, sum(n) OVER ())::DOUBLE AS raw,
                least({target}, sum(n) OVER ())::BIGINT AS goal, least(n, {minimum}) AS low FROM strata),
shares AS (SELECT *, least(greatest(floor(raw)::BIGINT, low), n) AS share FROM raws),
rooms AS (SELECT *, share - low AS over, n - share AS room, raw - floor(raw) AS fraction,
                 sum(share) OVER () - goal AS gap FROM shares),
cut_units AS (SELECT sample_month, "NATURE_TARGET", gap,
                     row_number() OVER (ORDER BY u, over DESC, sample_month, "NATURE_TARGET") AS place
              FROM (SELECT *, unnest(range(over)) AS u FROM rooms WHERE gap > 0)),
add_units AS (SELECT sample_month, "NATURE_TARGET", gap,
                     row_number() OVER (ORDER BY u, fraction {way}, room {way}, sample_month, "NATURE_TARGET") AS place
              FROM (SELECT *, unnest(range(room)) AS u FROM rooms WHERE gap < 0)),
cuts AS (SELECT sample_month, "NATURE_TARGET", count(*) AS k FROM cut_units WHERE place <= gap GROUP BY ALL),
adds AS (SELECT sample_month, "NATURE_TARGET", count(*) AS k FROM add_units WHERE place <= -gap GROUP BY ALL),
quotas AS (SELECT r.sample_month, r."NATURE_TARGET", n, (share - coalesce(c.k, 0) + coalesce(a.k, 0))::BIGINT AS quota
           FROM rooms r LEFT JOIN cuts c USING (sample_month, "NATURE_TARGET")
           LEFT JOIN adds a USING (sample_month, "NATURE_TARGET"))
"""


def _quotas(spark, sf_dir, target, minimum, fill_order="smallest_remainder"):
    rows = SM.sampling_rows(B.order_records(spark, sf_dir))
    counts = materialise(SM.strata_counts(rows), "strata")
    return SM.allocate_quotas(counts, target, minimum, fill_order=fill_order)


@register(
    "strata_counts",
    """SELECT strftime(o_orderdate, '%Y-%m') AS sample_month, o_orderpriority AS "NATURE_TARGET", count(*) AS n
       FROM orders GROUP BY ALL""",
)
def strata_counts(spark, sf_dir):
    return SM.strata_counts(SM.sampling_rows(B.order_records(spark, sf_dir)))


@register(
    "pruned_scan_counts",
    """SELECT strftime(o_orderdate, '%Y-%m') AS sample_month, o_orderpriority AS "NATURE_TARGET", count(*) AS n
       FROM orders GROUP BY ALL""",
)
def pruned_scan_counts(spark, sf_dir):
    """Strata counted from a raw file with all columns of the table, of which the scan parses two."""
    path = scratch_path(spark, "raw")
    renamed = {"o_orderdate": S.CREATED, "o_orderpriority": S.TARGET}
    B.table(spark, sf_dir, "orders").withColumnsRenamed(renamed).write.options(header=True, escape='"').csv(path)
    raw = tables.scan_csv(spark, path, [S.CREATED, S.TARGET], encoding="UTF-8", multi_line=False)
    return SM.strata_counts(SM.sampling_rows(raw.withColumn(S.CREATED, F.col(S.CREATED).cast("timestamp"))))


# Targets that reach each branch at sf0.01: fill, trim within one round, trim over several
# rounds, and minimum sizes that exceed the target.
VARIANTS = {
    "strata_quotas": (6000, 10, "smallest_remainder"),
    "strata_quotas_fill": (3000, 5, "smallest_remainder"),
    "strata_quotas_fill_largest": (3000, 5, "largest_remainder"),
    "strata_quotas_trim": (9000, 20, "smallest_remainder"),
    "strata_quotas_trim_rounds": (12000, 30, "smallest_remainder"),
    "strata_quotas_floor_wins": (3000, 25, "smallest_remainder"),
}

for _name, (_target, _minimum, _order) in VARIANTS.items():
    register(
        _name,
        f"WITH {quota_sql(_target, _minimum, _order == 'largest_remainder')} SELECT * FROM quotas",
    )(lambda spark, sf_dir, a=_target, b=_minimum, c=_order: _quotas(spark, sf_dir, a, b, c))


TARGET_ROWS, MINIMUM = 3000, 5

SAMPLE_SQL = f"""WITH {quota_sql(TARGET_ROWS, MINIMUM)},
ranked AS (SELECT o_orderkey, o_orderdate, strftime(o_orderdate, '%Y-%m') AS sample_month,
                  o_orderpriority AS "NATURE_TARGET",
                  row_number() OVER (PARTITION BY strftime(o_orderdate, '%Y-%m'), o_orderpriority
                                     ORDER BY substr(md5('{SEED}|' || o_orderkey), 1, 13), o_orderkey) AS place
           FROM orders),
chosen AS (SELECT o_orderkey, o_orderdate AS creation_ts, r.sample_month, r."NATURE_TARGET"
           FROM ranked r JOIN quotas q USING (sample_month, "NATURE_TARGET") WHERE place <= quota)
"""


def _sample(spark, sf_dir, max_rows=None):
    return SM.representative_subset(
        B.order_records(spark, sf_dir), "o_orderkey", TARGET_ROWS, MINIMUM, SEED, max_rows=max_rows
    )


@register("stratified_sample", SAMPLE_SQL + "SELECT * FROM chosen")
def stratified_sample(spark, sf_dir):
    return _sample(spark, sf_dir)[0].select("o_orderkey", S.CREATED, S.MONTH, S.TARGET)


@register(
    "sample_rows_semi",
    SAMPLE_SQL + "SELECT o.o_orderkey, o_custkey, o_totalprice FROM orders o SEMI JOIN chosen c ON o.o_orderkey = c.o_orderkey",
)
def sample_rows_semi(spark, sf_dir):
    """Ids first, full rows afterwards."""
    ids = _sample(spark, sf_dir)[0]
    orders = B.table(spark, sf_dir, "orders")
    return SM.rows_with_ids(orders, ids, "o_orderkey").select("o_orderkey", "o_custkey", "o_totalprice")


# A cap beyond the table: every row counts, and the metadata names the cap.
CAP = 1_000_000_000_000


@register(
    "sample_metadata",
    SAMPLE_SQL
    + f"""SELECT (SELECT sum(n) FROM quotas)::BIGINT AS source_rows_with_valid_time_and_nature,
          (SELECT sum(quota) FROM quotas)::BIGINT AS sampled_rows, {TARGET_ROWS}::INTEGER AS target_rows,
          {MINIMUM}::INTEGER AS min_per_group, {SEED}::INTEGER AS random_state, {CAP}::BIGINT AS max_rows,
          sample_month || '|' || "NATURE_TARGET" AS group_name, n::BIGINT AS n, quota::BIGINT AS quota FROM quotas""",
)
def sample_metadata(spark, sf_dir):
    """Metadata of a capped sample, with one row for each entry of its two maps."""
    metadata = _sample(spark, sf_dir, max_rows=CAP)[1]
    counts, sampled = "monthly_nature_counts", "monthly_nature_sampled_counts"
    entries = metadata.select("*", F.explode(counts).alias("group_name", "n"))
    return entries.withColumn("quota", F.element_at(sampled, F.col("group_name"))).drop(counts, sampled)


@register(
    "subset_sink_roundtrip",
    SAMPLE_SQL
    + """SELECT o_orderkey::VARCHAR AS o_orderkey, sample_month, "NATURE_TARGET" FROM chosen""",
)
def subset_sink_roundtrip(spark, sf_dir):
    """The sample written as gzip CSV with its metadata, and scanned again."""
    path = scratch_path(spark, "subset") + ".csv.gz"
    subset, metadata = _sample(spark, sf_dir)
    tables.save_subset(subset, path, metadata)
    return tables.scan_csv(spark, path, ["o_orderkey", S.MONTH, S.TARGET])
