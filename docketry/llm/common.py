"""Small helpers that the operators share."""

from __future__ import annotations

import re
import tempfile
import zipfile
from collections.abc import Iterator, Sequence
from pathlib import Path
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id's decimal text leaves the remainder ``fold``; never null."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(False))


def keep_rows(docs: DataFrame, verdict: Column) -> DataFrame:
    """The rows whose verdict is true, with the columns of ``docs`` and no other.

    The row travels as one struct, so a column of any name in ``docs`` is safe.
    """
    return docs.select(F.struct("*").alias("row"), verdict.alias("kept")).filter("kept").select("row.*")


def scratch(spark: SparkSession) -> str:
    """The folder that driver and executors share, from the session; set here only where it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="llm-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def stored(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """``df`` written to the shared folder and read back: later passes neither repeat nor lose it."""
    path = f"{scratch(df.sparkSession)}/llm/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Gives the Python workers this package, once per application: they need not have it installed."""
    context = spark.sparkContext
    if getattr(context, "_docketry_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    # The driver serves the file to all executors; no other machine looks into this folder.
    target = Path(tempfile.mkdtemp(prefix="docketry-")) / "docketry.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(target))
    context._docketry_shipped = True


def arrow_udf(schema: str):
    """``pandas_udf`` for functions that use this package."""
    ship(SparkSession.active())
    return F.pandas_udf(schema)


#: Text bytes that a Python worker is handed at a time, where a row isn't longer.
BATCH_BYTES = 4 << 20


#: Rows that a Parquet reader holds at a time, uncompressed; Spark's 4,096 texts fill arrays of tens of megabytes.
SCAN_ROWS = 512


def small_batches(spark: SparkSession) -> None:
    """Bounds what Python workers are handed at a time by bytes, not rows alone, and what scans hold by fewer rows, from
    now on in this session.

    Ten thousand rows, Spark's bound, are as large as their texts; results don't depend on the cut.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(SCAN_ROWS))


#: Text bytes that a task works on at a time, where a text isn't longer.
SLICE_BYTES = 1 << 20


def byte_slices(texts: Sequence[str | None], most: int = SLICE_BYTES) -> Iterator[list[str | None]]:
    """The texts in order, in lists of some ``most`` characters; a longer text is a list of its own."""
    part: list[str | None] = []
    size = 0
    for text in texts:
        n = len(text or "")
        if part and size + n > most:
            yield part
            part, size = [], 0
        part.append(text)
        size += n + 1
    if part:
        yield part
