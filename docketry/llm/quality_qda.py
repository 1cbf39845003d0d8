"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each document becomes a short vector of statistics of its whole text, on scales where classes are closer to normal (log
counts, logits of shares). Per class, mean and covariance come from moments that Spark sums over all labelled
training rows. A covariance is shrunk towards the pooled one and then towards a multiple of the identity; the
two weights are those with the least log loss on an inner fold. Scoring takes the Cholesky factor of each class,
inverted once per model: the log density is a triangular product, its squared norm (the Mahalanobis distance) and
the log determinant. The difference of the log densities and log priors passes a logistic calibration.

Bounds: the driver receives the moments and at most ``TUNING_ROWS`` vectors of the inner fold (those whose ids hash
lowest), for the two weights and the calibration. Everything else covers all rows.

Defined results: a null text is an empty one and scored as such. Labels other than 0 and 1 are left out; a document
with several label rows counts once for each. Without rows of both classes in training every score is the
share of label 1 with one row of each class added, or 0.5 without any label. An empty table gives an empty result;
columns of other names are not looked at. A text is measured whole, however long, and repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import arrow_udf, held_out, ship, stored, table
from docketry.llm.fertility import duplicate_lines

TUNING_ROWS = 20_000
TOWARDS_POOLED = (0.0, 0.1, 0.3, 0.6, 1.0)
TOWARDS_IDENTITY = (0.001, 0.01, 0.05, 0.2)
INNER_FOLD = 1
THRESHOLD = 0.3

FEATURES = (
    "log_words", "log_chars_per_word", "symbol_share", "upper_share", "digit_share", "blank_share", "pipe_share",
    "stop_mark_share", "mark_share", "distinct_share", "distinct_pair_share", "duplicate_lines", "log_line_words",
    "letter_entropy", "compression",
)

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LOWER = (_BYTES >= 97) & (_BYTES <= 122)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_BLANK = np.isin(_BYTES, [9, 10, 11, 12, 13, 32])
_MARK = (_BYTES > 32) & (_BYTES < 127) & ~(_UPPER | _LOWER | _DIGIT)
_SYMBOL = np.isin(_BYTES, [ord(c) for c in "#*$%&<>{}[]=_^~@\\/"])


def logit(part: float, whole: float) -> float:
    """Log odds of a share, half a unit added to both sides."""
    return float(np.log((part + 0.5) / (whole - part + 0.5)))


def statistics(text: str | None, press: zstandard.ZstdCompressor) -> list[float]:
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = text.split()
    size, n = len(data), len(words)
    solid = size - int(counts[_BLANK].sum())
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    folded = counts[97:123] + counts[65:91]
    letters = int(folded.sum())
    used = folded[folded > 0]
    entropy = float(np.log2(letters) - (used * np.log2(used)).sum() / letters) if letters else 0.0
    marks = int(counts[_MARK].sum())
    return [
        np.log1p(n),
        np.log1p(solid / n if n else 0.0),
        logit(int(counts[_SYMBOL].sum()), solid),
        logit(int(counts[_UPPER].sum()), solid),
        logit(int(counts[_DIGIT].sum()), solid),
        logit(size - solid, size),
        logit(int(counts[124]), solid),
        logit(int(counts[[33, 63]].sum()), solid),
        logit(marks, solid),
        logit(len(set(words)), n),
        logit(len(set(zip(words, words[1:], strict=False))), max(n - 1, 0)),
        logit(duplicate_lines(text), len(lines)),
        np.log1p(n / len(lines) if lines else 0.0),
        entropy,
        logit(len(press.compress(data)), size + 64) if size else 0.0,
    ]


def vectors(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, x) of each row."""

    @arrow_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        press = zstandard.ZstdCompressor(level=1, write_content_size=False)
        for texts in batches:
            yield pd.Series([statistics(t, press) for t in texts.tolist()])

    return docs.select(F.col(doc_id).alias("doc_id"), run(F.col(text)).alias("x"))


@dataclass(frozen=True)
class Moments:
    n: float
    total: np.ndarray
    square: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.n + other.n, self.total + other.total, self.square + other.square)

    @property
    def mean(self) -> np.ndarray:
        return self.total / self.n

    @property
    def scatter(self) -> np.ndarray:
        return self.square - np.outer(self.total, self.total) / self.n


def moments(rows: DataFrame, size: int) -> dict[tuple[int, bool], Moments]:
    """Of (x, label, inner) rows, by label and inner fold. Each task sums its rows; Spark adds up the sums."""
    ship(rows.sparkSession)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (label, inner), part in batch.groupby(["label", "inner"]):
                x = np.stack(part["x"].to_numpy())
                flat = np.concatenate(([len(x)], x.sum(axis=0), (x.T @ x).ravel()))
                yield pd.DataFrame({"label": label, "inner": inner, "place": np.arange(len(flat)), "value": flat})

    parts = rows.mapInPandas(sums, "label int, inner boolean, place int, value double")
    added = parts.groupBy("label", "inner", "place").agg(F.sum("value").alias("value"))
    found: dict[tuple[int, bool], np.ndarray] = {}
    for r in added.collect():
        found.setdefault((r["label"], r["inner"]), np.zeros(1 + size + size * size))[r["place"]] = r["value"]
    return {
        key: Moments(v[0], v[1 : 1 + size], v[1 + size :].reshape(size, size)) for key, v in found.items()
    }


@dataclass(frozen=True)
class Discriminant:
    """Class means, inverse Cholesky factors, log determinants, log priors; slope and offset of the calibration."""

    means: tuple[np.ndarray, np.ndarray]
    factors: tuple[np.ndarray, np.ndarray]
    log_dets: tuple[float, float]
    log_prior: float
    slope: float = 1.0
    offset: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        density = []
        for mean, factor, log_det in zip(self.means, self.factors, self.log_dets, strict=True):
            z = (x - mean) @ factor.T
            density.append(-0.5 * ((z * z).sum(axis=1) + log_det))
        return density[1] - density[0] + self.log_prior

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * self.margin(x) + self.offset, -40, 40)))


def discriminant(zero: Moments, one: Moments, pooled_weight: float, identity_weight: float) -> Discriminant:
    size = len(zero.total)
    pooled = (zero.scatter + one.scatter) / max(zero.n + one.n - 2, 1)
    # Statistics have different units: shrinkage works on their pooled scale.
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
    factors, log_dets = [], []
    for m in (zero, one):
        own = m.scatter / max(m.n - 1, 1)
        cov = ((1 - pooled_weight) * own + pooled_weight * pooled) / np.outer(scale, scale)
        cov = (1 - identity_weight) * cov + identity_weight * max(np.trace(cov) / size, 1e-3) * np.eye(size)
        lower = np.linalg.cholesky(cov)
        log_dets.append(float(2 * np.log(np.diag(lower)).sum()))
        factors.append(np.linalg.solve(lower, np.diag(1 / scale)))
    return Discriminant((zero.mean, one.mean), tuple(factors), tuple(log_dets), float(np.log(one.n / zero.n)))


def calibrate(margin: np.ndarray, label: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of a logistic curve on the margin, by Newton steps with a slight pull to (1, 0)."""
    spread = max(float(margin.std()), 1e-9)
    z = np.stack([margin / spread, np.ones_like(margin)], axis=1)
    w, pull = np.array([1.0, 0.0]), 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        grad = z.T @ (p - label) + pull * (w - [1.0, 0.0])
        hess = (z * (p * (1 - p))[:, None]).T @ z + pull * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-10:
            break
    return float(w[0] / spread), float(w[1])


def log_loss(p: np.ndarray, label: np.ndarray) -> float:
    p = np.clip(p, 1e-12, 1 - 1e-12)
    return float(-np.where(label == 1, np.log(p), np.log(1 - p)).mean())


def fit(labelled: DataFrame, key: str = "doc_id") -> Discriminant | float:
    """Of (doc_id, x, label, inner) rows; a constant score where training lacks a class."""
    size = len(FEATURES)
    found = moments(labelled.select("x", "label", "inner"), size)
    whole = {c: [found[k] for k in sorted(found) if k[0] == c] for c in (0, 1)}
    if not whole[0] or not whole[1]:
        n0, n1 = (sum(m.n for m in whole[c]) for c in (0, 1))
        return (n1 + 1.0) / (n0 + n1 + 2.0)
    zero, one = (sum(whole[c][1:], whole[c][0]) for c in (0, 1))
    grid = [(a, b) for a in TOWARDS_POOLED for b in TOWARDS_IDENTITY]
    outer = {c: found.get((c, False)) for c in (0, 1)}
    tuning = (
        labelled.filter("inner").orderBy(F.xxhash64(key), key, "x").limit(TUNING_ROWS).select("x", "label").collect()
    )
    label = np.array([r["label"] for r in tuning])
    if outer[0] is None or outer[1] is None or len(set(label.tolist())) < 2:
        return discriminant(zero, one, grid[len(grid) // 2][0], 0.05)
    x = np.array([r["x"] for r in tuning], dtype=float)
    best = None
    for a, b in grid:
        trial = discriminant(outer[0], outer[1], a, b)
        margin = trial.margin(x)
        slope, offset = calibrate(margin, label)
        loss = log_loss(1 / (1 + np.exp(-np.clip(slope * margin + offset, -40, 40))), label)
        if best is None or loss < best[0]:
            best = loss, a, b, slope, offset
    _, a, b, slope, offset = best
    final = discriminant(zero, one, a, b)
    return Discriminant(final.means, final.factors, final.log_dets, final.log_prior, slope, offset)


def score(x: Column, model: Discriminant | float) -> Column:
    if isinstance(model, float):
        return F.lit(model)

    @arrow_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in batches:
            yield pd.Series(model.score(np.stack(rows.to_numpy())) if len(rows) else np.zeros(0))

    return run(x)


def classify(
    docs: DataFrame, labels: DataFrame, target: str = "quality", folds: int = 5, fold: int = 0
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row; learned from labelled rows that aren't held out.

    The vectors are written once; text is read once and never shuffled.
    """
    found = stored(vectors(docs.select("doc_id", "text")), "vectors")
    given = labels.select("doc_id", F.col(target).cast("int").alias("label")).filter("label IN (0, 1)")
    inner = F.crc32(F.col("doc_id").cast("string")) % folds == INNER_FOLD
    training = found.join(given, "doc_id").filter(~held_out("doc_id", folds, fold)).withColumn("inner", inner)
    model = fit(training)
    scored = found.select("doc_id", held_out("doc_id", folds, fold).alias("held_out"), score(F.col("x"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op1_quality_qda(spark, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op1_quality_qda": op1_quality_qda}
ORACLES: dict[str, str] = {}
