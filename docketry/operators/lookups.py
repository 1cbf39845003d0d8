"""Median lookups at four grouping levels, and their use for prediction."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.functions.text import key_or_missing
from docketry.functions.values import col_or_null
from docketry.operators.selection import exact_quantile
from docketry.session import materialise


#: A key is hot if it has more than one in so many of the rows, so there are fewer hot keys than this.
HOT_KEYS = 64
#: Parts that the rows of a hot key are dealt to.
SALTS = 32


def median_levels(df: DataFrame, first: str, second: str, target: str) -> DataFrame:
    """Exact medians per (first, second), first, second and overall, as one stored table.

    The rows are reduced to distinct (first, second, value) counts once. Every count then stands
    for its row in all four levels; this happens within the row, so the passes of the rank
    selection read the stored counts without another shuffle of them. A key whose targets are all
    null is in the table too, with a null median and ``n`` 0.
    """
    keyed = df.select(
        key_or_missing(col_or_null(df, first)).alias("first_key"),
        key_or_missing(col_or_null(df, second)).alias("second_key"),
        F.col(target).cast("double").alias("value"),
    )
    counts = materialise(
        keyed.groupBy("first_key", "second_key", "value").agg(F.count(F.lit(1)).alias("_n")), "cells"
    )

    def as_level(name: str, first_key: Column, second_key: Column) -> Column:
        return F.struct(
            F.lit(name).alias("level"), first_key.alias("first_key"), second_key.alias("second_key")
        )

    a, b, none = F.col("first_key"), F.col("second_key"), F.lit("")
    levels = F.array(
        as_level("pair", a, b),
        as_level("first", a, none),
        as_level("second", none, b),
        as_level("all", none, none),
    )
    keys = ["level", "first_key", "second_key"]
    cells = counts.where(F.col("value").isNotNull() & ~F.isnan("value"))
    medians = exact_quantile(cells.select("value", "_n", F.inline(levels)), keys, "value", 0.5, "median")
    seen = counts.select("first_key", "second_key").distinct().select(F.inline(levels)).distinct()
    out = seen.join(medians, keys, "left").select(
        "level",
        F.when(F.col("level").isin("pair", "first"), F.col("first_key")).alias("first_key"),
        F.when(F.col("level").isin("pair", "second"), F.col("second_key")).alias("second_key"),
        "median",
        F.coalesce("n", F.lit(0)).alias("n"),
    )
    # Stored by level, so that each join sees the true size of its own part.
    return materialise(out, "medians", by=["level"])


@dataclass(frozen=True)
class MedianLookup:
    """Predicts with the most specific median known: pair, first key, second key, overall."""

    first: str
    second: str
    table: DataFrame

    def _hot(self, level: str) -> list[str]:
        """Keys of a one-key level that more than one row in ``HOT_KEYS`` had at fitting; so there are few."""
        key = f"{level}_key"
        total = self.table.where(F.col("level") == "all").select("n").scalar()
        rows = self.table.where((F.col("level") == level) & (F.col("n") * HOT_KEYS > total))
        return [r[0] for r in rows.select(key).collect()]

    @classmethod
    def fit(cls, df: DataFrame, first: str, second: str, target: str) -> MedianLookup:
        return cls(first, second, median_levels(df, first, second, target))

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """Three left joins on the stored table. A key that matches wins even if its median is
        null, so the match itself is tested and not the value.

        Rows of a hot key, as ``missing`` often is, are dealt to ``SALTS`` salts, and the table's row for
        it is there once for each, so that no join task holds more than its part of them.
        """
        t = self.table
        hot = {"_first": self._hot("first"), "_second": self._hot("second")}

        def is_hot(keys: list[str]) -> Column:
            # A pair can be hot only if both of its keys are.
            out = F.lit(True)
            for k in keys:
                out = out & F.col(k).isin(*hot[k])
            return out

        def level(name: str, keys: dict[str, str]) -> DataFrame:
            rows = t.where(F.col("level") == name).select(
                *[F.col(k).alias(a) for k, a in keys.items()],
                F.col("median").alias(f"_median_{name}"),
                F.lit(True).alias(f"_has_{name}"),
            )
            return salted(rows, list(keys.values()), F.sequence(F.lit(0), F.lit(SALTS - 1)), F.array(F.lit(0)), F.explode)

        def salted(df: DataFrame, keys: list[str], many: Column, one: Column, how=lambda c: c) -> DataFrame:
            if not all(hot[k] for k in keys):
                return df
            return df.withColumn("_salt", how(F.when(is_hot(keys), many).otherwise(one)))

        def find(df: DataFrame, name: str, keys: dict[str, str]) -> DataFrame:
            on = list(keys.values())
            if all(hot[k] for k in on):
                return salted(df, on, F.col("_deal"), F.lit(0)).join(level(name, keys), [*on, "_salt"], "left").drop("_salt")
            return df.join(level(name, keys), on, "left")

        overall = t.where(F.col("level") == "all").select("median").scalar()
        keyed = df.withColumns(
            {
                "_first": key_or_missing(col_or_null(df, self.first)),
                "_second": key_or_missing(col_or_null(df, self.second)),
            }
        )
        # Which salt a row takes follows from the row, so a task that runs again deals in the same way.
        plain = [F.col(f"`{n}`") for n, kind in df.dtypes if "map<" not in kind]
        joined = keyed.withColumn("_deal", F.pmod(F.xxhash64(*plain), F.lit(SALTS)).cast("int"))
        joined = find(joined, "pair", {"first_key": "_first", "second_key": "_second"})
        joined = find(joined, "first", {"first_key": "_first"})
        joined = find(joined, "second", {"second_key": "_second"})
        value = (
            F.when(F.col("_has_pair"), F.col("_median_pair"))
            .when(F.col("_has_first"), F.col("_median_first"))
            .when(F.col("_has_second"), F.col("_median_second"))
            .otherwise(overall)
        )
        return joined.withColumn(out, value).select(*[f"`{c}`" for c in df.columns], out)

    def save(self, path: str) -> None:
        self.table.write.mode("overwrite").parquet(path)
