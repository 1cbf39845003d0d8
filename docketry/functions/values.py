"""Numbers, timestamps, calendar parts and reproducible random scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_SECONDS = 86400.0


def col_or_null(df: DataFrame, name: str | None, kind: str = "string") -> Column:
    """The column if the table has it, else a typed null."""
    if name is not None and name in df.columns:
        return F.col(f"`{name}`")
    return F.lit(None).cast(kind)


def to_number(value: Column) -> Column:
    """A double, or null where the text is no number.

    Spark also reads Java suffixes such as ``1.0d``; those are no numbers here. NaN counts as null.
    """
    text = value.cast("string")
    number = F.when(~text.rlike(r"[0-9.][dDfF]\s*$"), F.trim(text).try_cast("double"))
    return F.when(~F.isnan(number), number)


def to_timestamp(value: Column) -> Column:
    """ISO or slash-separated text as a zone-free timestamp, or null.

    Slashes and the compact form are rewritten to ISO before one cast. Going through a
    zoned timestamp would move clock times inside a daylight-saving gap.
    """
    text = F.trim(value.cast("string"))
    text = F.regexp_replace(text, r"^(\d{4})/(\d{1,2})/", "$1-$2-")
    text = F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    return text.try_cast("timestamp_ntz")


def month_key(ts: Column) -> Column:
    """``yyyy-MM``, from date parts: formatting would go through the session time zone."""
    year = F.lpad(F.year(ts).cast("string"), 4, "0")
    return F.concat(year, F.lit("-"), F.lpad(F.month(ts).cast("string"), 2, "0"))


def calendar_parts(ts: Column) -> dict[str, Column]:
    """Year, month, day of week with Monday as 0, and hour."""
    return {
        "creation_year": F.year(ts),
        "creation_month": F.month(ts),
        "creation_dayofweek": F.weekday(ts),
        "creation_hour": F.hour(ts),
    }


def duration_days(start: Column, end: Column) -> Column:
    """Days between two zone-free timestamps.

    Their difference is taken as an interval: ``timestampdiff`` would read both clocks in the
    session time zone and be an hour off across a daylight-saving change.
    """
    gap = end.cast("timestamp_ntz") - start.cast("timestamp_ntz")

    def part(name: str) -> Column:
        return F.extract(F.lit(name), gap)

    whole = part("DAY").cast("bigint") * 86400 + part("HOUR") * 3600 + part("MINUTE") * 60
    micros = whole * 1_000_000 + (part("SECOND") * 1_000_000).cast("bigint")
    return micros / F.lit(1e6) / F.lit(DAY_SECONDS)


def presence_flag(*columns: Column) -> Column:
    """1.0 if every column is present, else 0.0."""
    flag = F.lit(True)
    for column in columns:
        flag = flag & column.isNotNull()
    return flag.cast("double")


def random_score(seed: int, row_id: Column) -> Column:
    """A uniform score in [0, 1) that depends on seed and row id only.

    Partitioning, retries and file order do not change it. 13 hex digits are 52 bits, which a
    double holds exactly.
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), row_id.cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))
