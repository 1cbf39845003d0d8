"""Text, category and number features, as tables and as model-ready vectors."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Hashable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    NGram,
    Normalizer,
    OneHotEncoder,
    RegexTokenizer,
    SQLTransformer,
    VectorAssembler,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docketry.functions import text as TX
from docketry.functions.values import col_or_null
from docketry.operators.selection import exact_quantile, value_cells
from docketry.schema import FeatureColumns
from docketry.session import materialise, small_table

MAX_TERMS = 4_000
MIN_DOCUMENTS = 5
RARE_BELOW = 20

# Fixed value: the name of the shared column of rare categories.
RARE_NAME = "infrequent_sklearn"

CODES = "category string, n bigint, slot int, rare boolean, column string"


# --- text -----------------------------------------------------------------------------------


def term_counts(df: DataFrame, row_id: str, text: str, sizes: Sequence[int] = (1, 2)) -> DataFrame:
    """``(row_id, term, tf)`` for every word and word pair of every text.

    Each text is sorted and run-length counted within its own row, so no shuffle happens before
    the terms are aggregated.
    """
    tokens = df.select(row_id, TX.words(F.col(text)).alias("_tokens"))
    parts = []
    if 1 in sizes:
        parts.append(F.col("_tokens"))
    if 2 in sizes:
        parts.append(TX.bigrams(F.col("_tokens")))
    terms = tokens.select(row_id, F.sort_array(F.concat(*parts)).alias("_terms"))
    # Where each run of equal terms starts; null for a text without terms.
    starts = F.when(
        F.size("_terms") > 0,
        F.filter(
            F.sequence(F.lit(0), F.size("_terms") - 1),
            lambda i: (i == 0) | (F.get("_terms", i) != F.get("_terms", i - 1)),
        ),
    )
    located = terms.select(row_id, "_terms", starts.alias("_starts"))
    ends = F.concat(F.slice("_starts", F.lit(2), F.size("_starts")), F.array(F.size("_terms")))
    runs = F.zip_with(
        "_starts",
        ends,
        lambda a, b: F.struct(F.get("_terms", a).alias("term"), (b - a).cast("bigint").alias("tf")),
    )
    # The outer form keeps the optimiser from copying all of the above into a filter on the size.
    found = located.select(row_id, runs.alias("_runs")).select(row_id, F.inline_outer("_runs"))
    return found.where(F.col("term").isNotNull())


def term_totals(counts: DataFrame) -> DataFrame:
    """Total count and document count of every term."""
    return counts.groupBy("term").agg(
        F.sum("tf").alias("total"), F.count(F.lit(1)).alias("df")
    )


def term_statistics(df: DataFrame, text: str, sizes: Sequence[int] = (1, 2)) -> DataFrame:
    """``(term, total, df)`` of every word and word pair, and in the row of the null term the number of rows.

    Terms leave their row as they are, and once more for each distinct one, straight into one hash aggregate that
    adds up before the shuffle; nothing is sorted or counted within the row.
    """
    # Columns of their own, so that each text is cut up once and not where its words are used.
    tokens = df.select(TX.words(F.col(text)).alias("_tokens"))
    parts = [part for size, part in ((1, F.col("_tokens")), (2, TX.bigrams(F.col("_tokens")))) if size in sizes]
    terms = tokens.select(F.concat(*parts).alias("_terms"))

    # Rows of the first kind count occurrences, of the second one texts.
    none = F.array(F.lit(None).cast("string"))
    kinds = [(1, 0, F.col("_terms")), (0, 1, F.concat(F.array_distinct("_terms"), none))]
    number = lambda n, name: F.lit(n).cast("bigint").alias(name)
    every = terms.select(F.inline(F.array(*[F.struct(number(a, "_one"), number(b, "_row"), t.alias("_terms")) for a, b, t in kinds])))
    each = every.select(F.explode("_terms").alias("term"), "_one", "_row")
    counts = each.groupBy("term").agg(F.sum("_one").alias("total"), F.sum("_row").alias("df"))
    return counts.select("term", F.when(F.col("term").isNull(), F.col("df")).otherwise(F.col("total")).alias("total"), "df")


def vector_entries(vector: str) -> Column:
    """The stored entries of a sparse or dense vector as an array of (place, value)."""
    raw = F.unwrap_udt(vector)
    places = F.coalesce(raw["indices"], F.sequence(F.lit(0), F.size(raw["values"]) - 1))
    return F.zip_with(places, raw["values"], lambda i, x: F.struct(i.cast("int").alias("place"), x.cast("double").alias("x")))


def text_weights(df: DataFrame, text: str, row_id: str, max_terms: int | None = None, min_df: int | None = None) -> DataFrame:
    """Length-normalised TF-IDF weights as rows ``(row_id, term, weight)``, made within the row.

    A row is scored against the vocabulary, which has ``max_terms`` entries at most, before it is taken apart: there is
    one shuffle, of the terms' counts, and none of the weights.
    """
    fitted = fit_text(df, text, row_id, max_terms or MAX_TERMS, min_df or MIN_DOCUMENTS)
    if fitted is None:
        return small_table(df.sparkSession, [], "term string, weight double").select(F.lit(None).cast(df.schema[row_id].dataType).alias(row_id), "term", "weight")
    model, names = fitted
    vectors = model.transform(df.select(row_id, TX.text_or_empty(F.col(text)).alias("_text")))
    rows = vectors.select(row_id, F.inline(vector_entries("_text_vector")).alias("place", "weight"))
    terms = small_table(df.sparkSession, list(enumerate(names)), "place int, term string")
    return rows.join(F.broadcast(terms), "place").select(row_id, "term", "weight")


def vocabulary(
    totals: DataFrame, max_terms: int = MAX_TERMS, min_df: int = MIN_DOCUMENTS
) -> DataFrame:
    """The most frequent terms among those in at least ``min_df`` texts."""
    return totals.where(F.col("df") >= min_df).orderBy(F.col("total").desc(), "term").limit(max_terms)


def tfidf_weights(
    counts: DataFrame, vocab: DataFrame, n_rows: DataFrame, row_id: str
) -> DataFrame:
    """Length-normalised TF-IDF weights as rows ``(row_id, term, weight)``.

    ``vocab`` has at most ``max_terms`` rows, which is what makes it safe to broadcast;
    ``n_rows`` is one row with the number of texts, empty ones included.
    """
    idf = F.log((1 + n_rows.scalar()) / (1 + F.col("df"))) + 1
    raw = counts.join(F.broadcast(vocab.select("term", idf.alias("idf"))), "term").select(
        row_id, "term", (F.col("tf") * F.col("idf")).alias("raw")
    )
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(row_id)))
    return raw.select(row_id, "term", (F.col("raw") / length).alias("weight"))


def fit_text(
    df: DataFrame, text: str, row_id: str, max_terms: int, min_df: int
) -> tuple[PipelineModel, list[str]] | None:
    """A fitted chain of Spark ML stages, and its terms in vector order."""
    counts = term_statistics(df, text).where(F.col("term").isNull() | (F.col("df") >= min_df))
    # The number of rows and at most max_terms terms: these are the model's parameters.
    top = counts.orderBy(F.col("term").isNotNull(), F.desc("total"), "term").limit(max_terms + 1).collect()
    n = sum(r["df"] for r in top if r["term"] is None)
    terms = sorted((r["term"], r["df"]) for r in top if r["term"] is not None)
    if not terms:
        return None
    names = [t for t, _ in terms]
    scale = Vectors.dense([math.log((1 + n) / (1 + d)) + 1 for _, d in terms])
    stages = [
        RegexTokenizer(
            inputCol="_text", outputCol="_words", pattern=TX.TOKEN, gaps=False, toLowercase=True
        ),
        NGram(n=2, inputCol="_words", outputCol="_pairs"),
        SQLTransformer(statement="SELECT *, concat(_words, _pairs) AS _terms FROM __THIS__"),
        CountVectorizerModel.from_vocabulary(names, inputCol="_terms", outputCol="_tf"),
        ElementwiseProduct(scalingVec=scale, inputCol="_tf", outputCol="_tfidf"),
        Normalizer(p=2.0, inputCol="_tfidf", outputCol="_text_vector"),
    ]
    return PipelineModel(stages), names


# --- categories -----------------------------------------------------------------------------


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, category, n)`` of several columns in one pass; null counts as ``missing``."""
    pairs = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"), TX.key_or_missing(col_or_null(df, c)).alias("category")
            )
            for c in columns
        ]
    )
    return df.select(F.inline(pairs)).groupBy("column", "category").agg(
        F.count(F.lit(1)).alias("n")
    )


def category_codes(counts: DataFrame, rare_below: int = RARE_BELOW) -> DataFrame:
    """A slot for every category seen: its own, or the column's last one shared by rare ones.

    Only the frequent categories are numbered; they are the columns of the feature vector.
    """
    frequent = F.col("n") >= rare_below
    numbered = counts.where(frequent).withColumn(
        "slot", F.row_number().over(Window.partitionBy("column").orderBy("category")) - 1
    )
    widths = numbered.groupBy("column").agg(F.count(F.lit(1)).alias("_width"))
    shared = (
        counts.where(~frequent)
        .join(widths, "column", "left")
        .withColumn("slot", F.coalesce(F.col("_width"), F.lit(0)).cast("int"))
    )
    columns = ["column", "category", "n", "slot"]
    return (
        numbered.select(*columns, F.lit(False).alias("rare"))
        .unionByName(shared.select(*columns, F.lit(True).alias("rare")))
    )


def apply_codes(df: DataFrame, codes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with ``<column>_slot``: the category's slot, or null if training never saw it."""
    out = df
    for c in columns:
        table = codes.where(F.col("column") == c).select(
            F.col("category").alias("_key"), F.col("slot").alias(f"{c}_slot")
        )
        keyed = out.withColumn("_key", TX.key_or_missing(col_or_null(out, c)))
        out = keyed.join(table, "_key", "left").drop("_key")
    return out


# --- numbers --------------------------------------------------------------------------------


def column_medians(
    df: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """``(column, median)`` of several number columns, exact; an all-null column is left out."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column"), col_or_null(df, c, "double").cast("double").alias("value"))
            for c in columns
        ]
    )
    cells = value_cells(df.select(F.inline(pairs)), ["column"], "value")
    return exact_quantile(
        cells, ["column"], "value", 0.5, "median"
    ).select("column", "median")


# --- views ----------------------------------------------------------------------------------

_SHARED: ContextVar[dict[Hashable, Any] | None] = ContextVar("shared", default=None)


@contextmanager
def shared_fits() -> Iterator[None]:
    """Within this context every block of features is fitted once for a frame, whichever views ask for it, and the text
    vectors of a frame are made and stored once. Frames are the same if their plans are."""
    token = _SHARED.set({})
    try:
        yield
    finally:
        _SHARED.reset(token)


def _once(key: Hashable, make: Callable[[], Any]) -> Any:
    known = _SHARED.get()
    if known is None:
        return make()
    if key not in known:
        known[key] = make()
    return known[key]


@dataclass
class FeatureView:
    """Fitted feature blocks: text, then categories, then numbers, in one vector."""

    columns: FeatureColumns
    text_model: PipelineModel | None = None
    terms: list[str] = field(default_factory=list)
    codes: DataFrame | None = None
    widths: dict[str, int] = field(default_factory=dict)
    category_names: list[str] = field(default_factory=list)
    medians: dict[str, float] = field(default_factory=dict)

    @classmethod
    def fit(
        cls,
        train: DataFrame,
        columns: FeatureColumns,
        row_id: str,
        max_terms: int = MAX_TERMS,
        min_df: int = MIN_DOCUMENTS,
        rare_below: int = RARE_BELOW,
    ) -> FeatureView:
        view = cls(columns)
        frame = train.semanticHash()
        if columns.text:
            fitted = _once(
                ("text", frame, columns.text, max_terms, min_df), lambda: fit_text(train, columns.text, row_id, max_terms, min_df)
            )
            if fitted:
                view.text_model, view.terms = fitted
        if columns.categories:
            view.codes = _once(
                ("codes", frame, columns.categories, rare_below),
                lambda: materialise(category_codes(category_counts(train, columns.categories), rare_below), "codes", by=["column"]),
            )
            view._name_categories()
        if columns.numbers:
            rows = _once(("medians", frame, columns.numbers), lambda: column_medians(train, columns.numbers).collect())
            found = {r["column"]: r["median"] for r in rows}
            view.medians = {c: found[c] for c in columns.numbers if c in found}
        if not view.names:
            raise ValueError("the training rows yield no feature")
        return view

    def _name_categories(self) -> None:
        """Names and widths of the one-hot blocks: one row per vector column, no rare category."""
        frequent = self.codes.where(~F.col("rare")).select("column", "category", "slot")
        has_rare = {r[0] for r in self.codes.where("rare").select("column").distinct().collect()}
        rows = sorted(frequent.collect(), key=lambda r: r["slot"])
        for c in self.columns.categories:
            names = [f"{c}_{r['category']}" for r in rows if r["column"] == c]
            if c in has_rare:
                names.append(f"{c}_{RARE_NAME}")
            self.widths[c] = len(names)
            self.category_names += names

    @property
    def names(self) -> list[str]:
        """Feature names in vector order."""
        return [f"text__{t}" for t in self.terms] + self.category_names + list(self.medians)

    def transform(self, df: DataFrame, out: str = "features") -> DataFrame:
        """Add the feature vector; stored tables are joined, everything else is per row."""
        kept = df.columns
        blocks = []
        if self.text_model is not None:
            df = self._with_text(df)
            blocks.append("_text_vector")
        used = [c for c in self.columns.categories if self.widths.get(c)]
        if used:
            df = apply_codes(df, self.codes, used)
            # A category unknown to training takes the slot that the encoder drops.
            df = df.withColumns(
                {
                    f"{c}_slot": F.coalesce(F.col(f"{c}_slot"), F.lit(self.widths[c])).cast("double")
                    for c in used
                }
            )
            hot = {c: f"{c}_hot" for c in used}
            df = self._encode(df, hot)
            blocks += list(hot.values())
        if self.medians:
            df = df.withColumns(
                {
                    f"{c}_filled": F.coalesce(col_or_null(df, c, "double").cast("double"), F.lit(float(m)))
                    for c, m in self.medians.items()
                }
            )
            blocks += [f"{c}_filled" for c in self.medians]
        assembled = VectorAssembler(inputCols=blocks, outputCol=out).transform(df)
        return assembled.select(*[F.col(f"`{c}`") for c in kept], out)

    def _with_text(self, df: DataFrame) -> DataFrame:
        told = df.withColumn("_text", TX.text_or_empty(col_or_null(df, self.columns.text)))
        out = self.text_model.transform(told).select(*[F.col(f"`{c}`") for c in df.columns], "_text_vector")
        if _SHARED.get() is None:
            return out
        # The memory holds the text model too, so its identity stays its own.
        return _once(("vectors", df.semanticHash(), id(self.text_model)), lambda: materialise(out, "text-vectors"))

    def _encode(self, df: DataFrame, hot: dict[str, str]) -> DataFrame:
        """One-hot vectors of fixed width. The encoder learns the widths from one row."""
        spark = df.sparkSession
        sizes = spark.range(1).select(
            *[F.lit(float(self.widths[c])).alias(f"{c}_slot") for c in hot]
        )
        encoder = OneHotEncoder(
            inputCols=[f"{c}_slot" for c in hot], outputCols=list(hot.values()), dropLast=True
        )
        return encoder.fit(sizes).transform(df)

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        meta = {
            "text": self.columns.text,
            "categories": list(self.columns.categories),
            "numbers": list(self.columns.numbers),
            "terms": self.terms,
            "medians": self.medians,
            "has_text": self.text_model is not None,
            "has_codes": self.codes is not None,
        }
        text = small_table(spark, [(json.dumps(meta),)], "meta string")
        text.coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")
        if self.text_model is not None:
            self.text_model.write().overwrite().save(f"{path}/text")
        if self.codes is not None:
            self.codes.write.mode("overwrite").partitionBy("column").parquet(f"{path}/codes")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FeatureView:
        meta = json.loads(spark.read.parquet(f"{path}/meta").first()["meta"])
        columns = FeatureColumns(meta["text"], tuple(meta["categories"]), tuple(meta["numbers"]))
        view = cls(columns, terms=meta["terms"], medians=meta["medians"])
        if meta["has_text"]:
            view.text_model = PipelineModel.load(f"{path}/text")
        if meta["has_codes"]:
            view.codes = spark.read.schema(CODES).parquet(f"{path}/codes")
            view._name_categories()
        return view
