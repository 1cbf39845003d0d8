"""Cleaned record frames, modelling frames and chronological splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry import schema as S
from docketry.functions import text as TX
from docketry.functions import values as V
from docketry.schema import RecordSchema

SPLITS = ("train", "validation", "test")


def prepare_base(df: DataFrame, schema: RecordSchema = RecordSchema()) -> DataFrame:
    """Clean a raw record table; every input column is kept, absent ones are tolerated.

    A chain of projections without a shuffle: repaired and typed source columns, then what is
    derived from them. Labels and states are repaired a second time while folding, which undoes
    text that was damaged twice.
    """
    kinds = dict(df.dtypes)
    texts = {n: F.col(f"`{n}`") for n in schema.text_columns if kinds.get(n) == "string"}
    numbers = {n: V.to_number(F.col(f"`{n}`")) for n in schema.number_columns if n in kinds}
    typed = df.withColumns(numbers) if numbers else df
    clean = TX.repair_columns(typed, texts) if texts else typed

    # A source column that already is a timestamp keeps its type.
    def stamp(name: str) -> Column:
        column = V.col_or_null(clean, name)
        if kinds.get(name, "").startswith("timestamp"):
            return column.cast("timestamp_ntz")
        return V.to_timestamp(column)

    folds = {S.TARGET: schema.label, S.STATUS: schema.status}
    present = {out: F.col(f"`{name}`") for out, name in folds.items() if name in kinds}
    folded = TX.fold_columns(clean, present) if present else clean
    places = {schema.latitude, schema.longitude} <= set(kinds)
    null = F.lit(None).cast("string")
    derived = {
        S.CREATED: stamp(schema.created),
        S.UPDATED: stamp(schema.updated),
        S.TARGET: TX.label_of(F.col(S.TARGET), schema.labels) if S.TARGET in present else null,
        S.STATUS: F.col(S.STATUS) if S.STATUS in present else null,
        schema.text: TX.text_or_empty(V.col_or_null(clean, schema.text)),
        S.HAS_PLACE: V.presence_flag(F.col(f"`{schema.latitude}`"), F.col(f"`{schema.longitude}`"))
        if places
        else F.lit(0.0),
    }
    return folded.withColumns(derived).withColumns(V.calendar_parts(F.col(S.CREATED)))


def classification_rows(prepared: DataFrame, target: str = S.TARGET) -> DataFrame:
    """Rows with a creation time and a usable label."""
    return prepared.dropna(subset=[S.CREATED, target])


def regression_rows(prepared: DataFrame, schema: RecordSchema = RecordSchema()) -> DataFrame:
    """Closed records with a non-negative duration between both timestamps, in days."""
    days = V.duration_days(F.col(S.CREATED), F.col(S.UPDATED))
    closed = prepared.dropna(subset=[S.CREATED, S.UPDATED]).where(
        F.col(S.STATUS).isin(*schema.closed_states)
    )
    return closed.withColumn(S.DURATION, days).where(
        (F.col(S.DURATION) >= 0) & ~F.isnan(S.DURATION)
    )


def _bound(value: str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def split_label(
    ts: Column, train_end: str = S.TRAIN_END, validation_end: str = S.VALIDATION_END
) -> Column:
    """``train``, ``validation`` or ``test``; null for a null timestamp. Bounds are inclusive."""
    if train_end > validation_end:
        raise ValueError("overlapping splits have no single label; use split_frames")
    return (
        F.when(ts <= _bound(train_end), "train")
        .when(ts <= _bound(validation_end), "validation")
        .when(ts > _bound(validation_end), "test")
    )


def split_frames(
    df: DataFrame,
    train_end: str = S.TRAIN_END,
    validation_end: str = S.VALIDATION_END,
    ts: str = S.CREATED,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three frames; train and test overlap if the bounds are given in reverse."""
    when = F.col(ts)
    return (
        df.where(when <= _bound(train_end)),
        df.where((when > _bound(train_end)) & (when <= _bound(validation_end))),
        df.where(when > _bound(validation_end)),
    )


def split_summary(tagged: DataFrame, target: str, split: str = "split") -> DataFrame:
    """Rows and distinct labels of every split."""
    pairs = tagged.groupBy(split, target).agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy(split).agg(
        F.sum("n").alias("n_rows"), F.count(F.col(target)).alias("n_labels")
    )


def check_splits(
    tagged: DataFrame, target: str, min_labels: int | None = None, split: str = "split"
) -> dict[str, int]:
    """Row count per split; raises if a split is empty or training has too few labels."""
    found = {r[split]: r for r in split_summary(tagged, target, split).collect()}
    empty = [name for name in SPLITS if name not in found]
    if empty:
        raise ValueError(f"empty chronological split: {', '.join(empty)}")
    if min_labels is not None and found["train"]["n_labels"] < min_labels:
        raise ValueError(f"training rows need at least {min_labels} labels")
    return {name: found[name]["n_rows"] for name in SPLITS}


def train_and_validation(tagged: DataFrame, split: str = "split") -> DataFrame:
    """Both fitting splits as one frame; a predicate, so the table is scanned once."""
    return tagged.where(F.col(split).isin("train", "validation"))
