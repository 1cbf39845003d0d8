"""Whole runs from an input file to saved reports, in stages that a second start does not repeat.

A stage writes a folder of the output, and a mark in ``_finished`` once the folder is complete. A run that was killed
starts again with the first stage without a mark; what that stage had written is deleted. Everything else a run
stores lies in its own scratch folder, which is deleted at its end.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry import schema as S
from docketry.models.registry import ModelSpec
from docketry.operators import frames
from docketry.plans import workflows
from docketry.schema import FeatureColumns, RecordSchema
from docketry.session import delete_path, path_exists, save_rows, scratch_scope
from docketry.sources import tables

Bounds = tuple[str, str]


def finished(spark: SparkSession, output: str, stage: str) -> bool:
    return path_exists(spark, f"{output}/_finished/{stage}/_SUCCESS")


def run_stage(spark: SparkSession, output: str, stage: str, write: Callable[[str], None]) -> str:
    """The folder of a stage, written now unless it is complete."""
    path = f"{output}/{stage}"
    if not finished(spark, output, stage):
        delete_path(spark, path)
        write(path)
        save_rows([(stage,)], "stage string", f"{output}/_finished/{stage}")
    return path


def _records(
    spark: SparkSession, csv_path: str, output: str, stage: str, schema: RecordSchema, keep: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    def write(path: str) -> None:
        raw = tables.with_row_id(tables.scan_csv(spark, csv_path))
        keep(frames.prepare_base(raw, schema)).write.parquet(path)

    return spark.read.parquet(run_stage(spark, output, stage, write))


def classify_file(
    spark: SparkSession,
    csv_path: str,
    output: str,
    bounds: Bounds = (S.TRAIN_END, S.VALIDATION_END),
    schema: RecordSchema = RecordSchema(),
    columns: FeatureColumns = FeatureColumns(),
    specs: Sequence[ModelSpec] | None = None,
    min_count: int = 50,
) -> str:
    """Records of a CSV file to a compared, refitted, tested and saved classifier with its reports."""
    with scratch_scope(spark):
        records = _records(spark, csv_path, output, "classification_rows", schema, frames.classification_rows)
        tagged = records.withColumn("split", frames.split_label(F.col(S.CREATED), *bounds))

        def write(path: str) -> None:
            workflows.train_classification(tagged, columns=columns, specs=specs, min_count=min_count).save(path)

        return run_stage(spark, output, "classification", write)


def regress_file(
    spark: SparkSession,
    csv_path: str,
    output: str,
    bounds: Bounds = (S.TRAIN_END, S.VALIDATION_END),
    schema: RecordSchema = RecordSchema(),
    columns: FeatureColumns = FeatureColumns(),
    specs: Sequence[ModelSpec] | None = None,
    alpha: float = 0.1,
) -> str:
    """Records of a CSV file to a compared, refitted, tested and saved regressor with intervals and reports."""
    with scratch_scope(spark):
        records = _records(spark, csv_path, output, "regression_rows", schema, lambda df: frames.regression_rows(df, schema))
        tagged = records.withColumn("split", frames.split_label(F.col(S.CREATED), *bounds))

        def write(path: str) -> None:
            workflows.train_regression(tagged, columns=columns, specs=specs, alpha=alpha).save(path)

        return run_stage(spark, output, "regression", write)
