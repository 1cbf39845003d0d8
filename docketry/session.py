"""Session settings and the shared scratch tables that cut long lineages."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def local_session(
    cores: str = "*", name: str = "docketry", checkpoint_dir: str | None = None
) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="docketry-")
    spark.sparkContext.setCheckpointDir(root)
    return root


#: Local property with the folder of the run that owns the scratch tables; threads of the run inherit it.
_OWNER = "docketry.scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    folder = spark.sparkContext.getLocalProperty(_OWNER) or f"{scratch_root(spark)}/docketry"
    return f"{folder}/{name}-{uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Owns the scratch tables made within it, and deletes them at its end, also after an error.

    What is to stay has to be saved elsewhere before.
    """
    folder = f"{scratch_root(spark)}/docketry/run-{uuid4().hex}"
    before = spark.sparkContext.getLocalProperty(_OWNER)
    spark.sparkContext.setLocalProperty(_OWNER, folder)
    try:
        yield folder
    finally:
        spark.sparkContext.setLocalProperty(_OWNER, before)
        delete_path(spark, folder)


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    where, files = _file_system(spark, path)
    return files.exists(where)


def delete_path(spark: SparkSession, path: str) -> None:
    where, files = _file_system(spark, path)
    files.delete(where, True)


def materialise(df: DataFrame, name: str = "stage", by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to a scratch table and read it back.

    Later passes read the table instead of repeating the work, a lost executor costs one file
    and not the lineage, and the file size is a true size: Catalyst broadcasts the table in a
    join only when it is below ``spark.sql.autoBroadcastJoinThreshold``. ``by`` partitions the
    table for readers that take one part of it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*[f"`{c}`" for c in df.columns])


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A few driver-side rows (fitted parameters, one row per model) as a local relation."""
    struct = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in struct]
    arrow = pa.Table.from_arrays(
        [pa.array(c, t.type) for c, t in zip(columns, to_arrow_schema(struct))],
        schema=to_arrow_schema(struct),
    )
    return spark.createDataFrame(arrow, struct)


def save_rows(rows: Sequence[tuple], schema: str, path: str) -> None:
    """A few driver-side rows (labels, fitted parameters) as one JSON file."""
    small_table(SparkSession.active(), rows, schema).coalesce(1).write.mode("overwrite").json(path)


def load_rows(spark: SparkSession, schema: str, path: str, order: str) -> list:
    return spark.read.schema(schema).json(path).orderBy(order).collect()
