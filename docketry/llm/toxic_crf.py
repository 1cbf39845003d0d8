"""Toxicity: a linear-chain conditional random field tags offending words; marginals make document scores and spans.

Labels come per document, so tokens are labelled first: a word, or its first four or five letters, offends if the
share of toxic training documents that hold it is ``MIN_LIFT`` log units above that of clean ones. In toxic documents
such words are tagged, everything else is not. The chain has two states; a token's weight is a sum over
hashed features of the word (itself, prefixes, suffixes), and pairs of neighbours have transition weights.
Sequences are the words between sentence marks. Forward and backward passes run over all sequences of a batch in
step; with two states each is one recurrence of a ratio. A document's score is a logistic function of its largest
marginal, its expected number of offending words and its length, fitted on documents the chain has not seen; the
spans are runs of words with a marginal of a half or more, as code point offsets into the text.

Bounds: training takes ``TOXIC_DOCS`` and ``CLEAN_DOCS`` labelled documents at most (those whose ids hash lowest), and
the ``MAX_TERMS`` terms of the largest lift. Terms are counted over whole documents. The chain learns from whole
sentences, cut where scoring cuts: all that hold a word with an offending term, in documents of both classes, and
``OTHER_SENTENCES`` of each document's other ones, evenly spread; ``MAX_SENTENCES`` in all. A sentence without a mark is
cut after ``LONGEST`` words, in training as in scoring. Scoring covers every word of every document. As each
class has its own bound, the curve and the constant score weight the sampled documents by their class's count over all
training labels: scores are chances in the labelled documents, not in the sample.

Defined results: a null text is an empty one; a text without words gets the fitted curve's value at zero. Of several
label rows of a document the largest label counts, labels other than 0 and 1 are left out. Where no word offends in
training, every score is the share of toxic ones among all training documents (0 without any) and there are no spans.
An empty table gives an empty result; columns of other names are not looked at. Work is cut by text bytes, so a very
long text is a slice of its own.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import arrow_udf, byte_slices, held_out, keep_rows, ship, small_batches, stored, table

TOXIC_DOCS = 6_000
CLEAN_DOCS = 10_000
OTHER_SENTENCES = 4
MIN_LIFT = 2.5
MIN_DOCS = 4
MAX_TERMS = 20_000
#: Words after which a sequence ends without a mark, in training and in scoring; the longest one sets the number of steps.
LONGEST = 256
#: Sentences that the chain learns from at most, those whose hashes are lowest.
MAX_SENTENCES = 400_000
#: Words whose weights a task remembers.
MEMORY = 200_000
HASH_BITS = 18
CALIBRATION_FOLD = 3
THRESHOLD = 0.3

PART = re.compile(r"[^\W_]+|[.!?\n]")
_BREAKS = frozenset(".!?\n")


def parts_of(text: str | None) -> list[str]:
    """Lower-case words and sentence marks."""
    return PART.findall(text.lower()) if text else []


def stems(word: str) -> tuple[str, ...]:
    return ("w" + word, "4" + word[:4], "5" + word[:5]) if len(word) > 4 else ("w" + word,)


def features(word: str) -> list[int]:
    """Hashed features; the first is the bias."""
    names = ["b", "w" + word, "a" + word[:3], "4" + word[:4], "5" + word[:5], "y" + word[-3:], "z" + word[-4:]]
    mask = (1 << HASH_BITS) - 1
    return [crc32(n.encode("utf-8", "surrogatepass")) & mask for n in names]


N_FEATURES = 7


@dataclass(frozen=True)
class Sequences:
    """Token places of each sequence in a flat array; sequences lie longest first, so that those with a token at
    step t are the first ``active[t]``."""

    starts: np.ndarray
    active: np.ndarray

    @staticmethod
    def of(starts: np.ndarray, lengths: np.ndarray) -> Sequences:
        order = np.argsort(-lengths, kind="stable")
        lengths = lengths[order]
        steps = int(lengths[0]) if len(lengths) else 0
        return Sequences(starts[order], np.searchsorted(-lengths, -np.arange(1, steps + 1), side="right"))


def forward_backward(weight: np.ndarray, seq: Sequences, trans: np.ndarray, start: float) -> tuple[np.ndarray, np.ndarray]:
    """Ratios offending : plain of the forward and of the backward values at every token; their product is the odds
    of its marginal. ``trans`` is exp of the transition weights, [from, to], state 1 offending."""
    up = np.exp(np.clip(weight, -30, 30))
    ahead, back = np.empty_like(up), np.ones_like(up)
    for t, n in enumerate(seq.active):
        at = seq.starts[:n] + t
        if t == 0:
            ahead[at] = up[at] * np.exp(start)
        else:
            r = ahead[at - 1]
            ahead[at] = up[at] * (trans[0, 1] + r * trans[1, 1]) / (trans[0, 0] + r * trans[1, 0])
    for t in range(len(seq.active) - 2, -1, -1):
        at = seq.starts[: seq.active[t + 1]] + t
        q = up[at + 1] * back[at + 1]
        back[at] = (trans[1, 0] + trans[1, 1] * q) / (trans[0, 0] + trans[0, 1] * q)
    return ahead, back


def train(
    tokens: np.ndarray,
    tags: np.ndarray,
    lengths: np.ndarray,
    rounds: int = 80,
    pull: float = 0.02,
    place: np.ndarray | None = None,
):
    """Maximum likelihood of the tag sequences with an L2 pull, by full-batch adaptive gradient steps.

    ``tokens`` is tokens x features; with ``place``, it is words x features and ``place`` names each token's word.
    Returns feature weights, transition weights [from, to] and the start weight.
    """
    place = np.arange(len(tokens)) if place is None else place
    size = 1 << HASH_BITS
    weights, trans, start = np.zeros(size), np.zeros((2, 2)), 0.0
    first = np.cumsum(lengths) - lengths
    seq = Sequences.of(first, lengths)
    inner = np.ones(len(tags), bool)
    inner[first] = False
    here = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (tags[here - 1], tags[here]), 1)
    flat = tokens.ravel()
    gain, gain_t, gain_s = np.full(size, 1e-8), np.full((2, 2), 1e-8), 1e-8
    for _ in range(rounds):
        emit = weights[tokens].sum(axis=1)[place]
        expt = np.exp(trans)
        ahead, back = forward_backward(emit, seq, expt, start)
        odds = np.minimum(ahead * back, 1e12)
        marginal = odds / (1 + odds)
        # Joint of neighbours: forward ratio on the left, token weight and backward ratio on the right.
        left, right = ahead[here - 1], np.exp(np.clip(emit[here], -30, 30)) * back[here]
        joint = [expt[0, 0], expt[0, 1] * right, expt[1, 0] * left, expt[1, 1] * left * right]
        total = joint[0] + joint[1] + joint[2] + joint[3]
        joint = np.array([(x / total).sum() for x in joint])
        wrong = np.repeat(np.bincount(place, weights=tags - marginal, minlength=len(tokens)), N_FEATURES)
        grad = np.bincount(flat, weights=wrong, minlength=size) - pull * weights
        grad_t = seen - joint.reshape(2, 2) - pull * trans
        grad_s = float((tags - marginal)[first].sum()) - pull * start
        gain += grad * grad
        gain_t += grad_t * grad_t
        gain_s += grad_s * grad_s
        weights += 0.5 * grad / np.sqrt(gain)
        trans += 0.3 * grad_t / np.sqrt(gain_t)
        start += 0.3 * grad_s / np.sqrt(gain_s)
    return weights, trans, start


@dataclass(frozen=True)
class Tagger:
    """The chain, and the curve from (logit of the largest marginal, log1p of the expected count, log1p of words)."""

    weights: np.ndarray
    trans: np.ndarray
    start: float
    curve: tuple[float, float, float, float] | None = None

    def marginals(self, texts: list[str | None], memory: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of all words of the texts, one after the other, and the number of words of each text."""
        weights = self.weights
        found = array("d")
        sizes, lengths = array("q"), array("q")
        for text in texts:
            before, run = len(found), 0
            for part in parts_of(text):
                if part in _BREAKS or run == LONGEST:
                    if run:
                        lengths.append(run)
                        run = 0
                    if part in _BREAKS:
                        continue
                w = memory.get(part)
                if w is None:
                    w = memory[part] = float(weights[features(part)].sum())
                found.append(w)
                run += 1
            if run:
                lengths.append(run)
            sizes.append(len(found) - before)
        size = np.array(lengths, np.int64)
        seq = Sequences.of(np.cumsum(size) - size, size)
        ahead, back = forward_backward(np.array(found), seq, np.exp(self.trans), self.start)
        odds = np.minimum(ahead * back, 1e12)
        return odds / (1 + odds), np.array(sizes, np.int64)

    def judge(self, texts: list[str | None], memory: dict[str, float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores of some texts, the marginals of all their words, and where each text's words end."""
        if len(memory) > MEMORY:
            memory.clear()
        marginal, sizes = self.marginals(texts, memory)
        return self.scores(self.aggregate(marginal, sizes)), marginal, np.cumsum(sizes)

    def aggregate(self, marginal: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """texts x 3: what the curve reads of each text."""
        ends = np.cumsum(sizes)
        out = np.zeros((len(sizes), 3))
        out[:, 0] = -14.0
        has = sizes > 0
        if has.any():
            starts = (ends - sizes)[has]
            top = np.clip(np.maximum.reduceat(marginal, starts), 1e-6, 1 - 1e-6)
            out[has, 0] = np.log(top / (1 - top))
            out[has, 1] = np.log1p(np.add.reduceat(marginal, starts))
            out[has, 2] = np.log1p(sizes[has])
        return out

    def scores(self, found: np.ndarray) -> np.ndarray:
        a, b, c, d = self.curve
        return 1 / (1 + np.exp(-np.clip(found @ [a, b, c] + d, -40, 40)))


def spans_of(text: str, marginal: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) code point offsets of runs of words with a marginal of a half or more; a run ends at a sentence mark."""
    if not (marginal >= 0.5).any():
        return []
    low = text.lower()
    if len(low) != len(text):
        # Lowering has made a character longer: find each one's place in the text.
        place = [i for i, c in enumerate(text) for _ in c.lower()] + [len(text)]
        place = place if len(place) == len(low) + 1 else None
    else:
        place = range(len(text) + 1)
    out, k, open_run = [], 0, False
    for m in PART.finditer(low):
        if m[0] in _BREAKS:
            open_run = False
            continue
        if marginal[k] >= 0.5:
            s, e = (place[m.start()], place[m.end() - 1] + 1) if place else (m.start(), m.end())
            if open_run:
                out[-1] = (out[-1][0], e)
            else:
                out.append((s, e))
            open_run = True
        else:
            open_run = False
        k += 1
    return out


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> tuple[float, float, float, float]:
    """Logistic regression by Newton steps on standardised columns, with a pull to zero on the slopes.

    ``weight`` is how many rows each row stands for; the pull stays that of the rows given.
    """
    weight = np.ones(len(x)) if weight is None else weight * (len(x) / weight.sum())
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    pull = np.diag([1.0, 1.0, 1.0, 1e-3])
    w = np.zeros(4)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + pull, z.T @ (weight * (p - y)) + pull @ w)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    slopes = w[:3] / scale
    return (*map(float, slopes), float(w[3] - slopes @ mean))


def training_sample(docs: DataFrame, labels: DataFrame, target: str, folds: int, fold: int) -> DataFrame:
    """(doc_id, text, label, inner, weight) of the labelled training documents, at most ``TOXIC_DOCS`` + ``CLEAN_DOCS``
    ids; the weight is how many ids of its class, among all labelled for training, a row stands for.

    The ids are that few by their limits, so they are broadcast and the text is not shuffled.
    """
    given = (
        labels.select("doc_id", F.col(target).cast("int").alias("label"))
        .filter("label IN (0, 1) AND doc_id IS NOT NULL")
        .filter(~held_out("doc_id", folds, fold))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    key = F.xxhash64("doc_id")
    counts = {r["label"]: r["n"] for r in given.groupBy("label").agg(F.count("*").alias("n")).collect()}
    own = [
        given.filter(F.col("label") == label)
        .orderBy(key, "doc_id")
        .limit(most)
        .withColumn("weight", F.lit(max(1.0, counts.get(label, 0) / most)))
        for label, most in ((1, TOXIC_DOCS), (0, CLEAN_DOCS))
    ]
    sample = own[0].unionByName(own[1]).withColumn(
        "inner", F.crc32(F.col("doc_id").cast("string")) % folds == CALIBRATION_FOLD
    )
    return docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")


def offending_terms(sample: DataFrame) -> set[str]:
    """Words and stems by their lift; counts are by document, added up in each task and then by Spark."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen = (Counter(), Counter())
            for text, label in zip(batch["text"], batch["label"], strict=True):
                words = {p for p in parts_of(text) if p not in _BREAKS}
                seen[label].update({s for w in words for s in stems(w)})
            terms = list(seen[0].keys() | seen[1].keys())
            yield pd.DataFrame({"term": terms, "clean": [seen[0][t] for t in terms], "toxic": [seen[1][t] for t in terms]})

    totals = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not totals.get(1):
        return set()
    ship(sample.sparkSession)
    terms = sample.select("text", "label").mapInPandas(count, "term string, clean bigint, toxic bigint")
    summed = terms.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    lift = F.log((F.col("toxic") + 0.5) / (totals[1] + 1)) - F.log((F.col("clean") + 0.5) / (totals.get(0, 0) + 1))
    best = summed.filter(F.col("toxic") >= MIN_DOCS).withColumn("lift", lift).filter(F.col("lift") >= MIN_LIFT)
    return {r["term"] for r in best.orderBy(F.desc("lift"), "term").limit(MAX_TERMS).select("term").collect()}


def sentences(sample: DataFrame, terms: set[str]) -> list[tuple[str, bytes]]:
    """Whole sentences to train on, their words with a space between them and a tag for each: of every document, toxic or
    not, all that hold a word with one of the terms, and ``OTHER_SENTENCES`` of the others at most, evenly spread."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, label in zip(batch["text"], batch["label"], strict=True):
                others: list[list[str]] = []
                own: list[str] = []
                for part in [*parts_of(text), "."]:
                    if part not in _BREAKS and len(own) < LONGEST:
                        own.append(part)
                        continue
                    if own:
                        hits = [any(s in terms for s in stems(w)) for w in own]
                        if any(hits):
                            rows.append((" ".join(own), bytes(h and label for h in hits)))
                        else:
                            others.append(own)
                    own = [] if part in _BREAKS else [part]
                n = min(len(others), OTHER_SENTENCES)
                for words in (others[(2 * k + 1) * len(others) // (2 * n)] for k in range(n)):
                    rows.append((" ".join(words), bytes(len(words))))
            yield pd.DataFrame(rows, columns=["words", "tags"])

    found = sample.select("text", "label").mapInPandas(cut, "words string, tags binary")
    chosen = found.orderBy(F.xxhash64("words", "tags"), "words", "tags").limit(MAX_SENTENCES)
    return sorted((r["words"], bytes(r["tags"])) for r in chosen.collect())


def fit(docs: DataFrame, labels: DataFrame, target: str = "toxic", folds: int = 4, fold: int = 2) -> Tagger | float:
    """The chain and its curve, or a constant score where nothing can be learned."""
    sample = stored(training_sample(docs, labels, target, folds, fold), "labelled")
    learn = sample.filter("NOT inner")
    terms = offending_terms(learn)
    share = sample.agg(F.sum(F.col("label") * F.col("weight")) / F.sum("weight")).first()[0] or 0.0
    if not terms:
        return float(share)
    rows = sentences(learn, terms)
    known: dict[str, int] = {}
    place = np.fromiter((known.setdefault(w, len(known)) for words, _ in rows for w in words.split(" ")), np.int32)
    tags = np.frombuffer(b"".join(tags for _, tags in rows), np.int8)
    weights, trans, start = train(
        np.array([features(w) for w in known]), tags, np.array([len(tags) for _, tags in rows]), place=place
    )
    del rows, known, place, tags
    chain = Tagger(np.round(weights, 4).astype(np.float32), trans, start)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memory: dict[str, float] = {}
        for batch in batches:
            found = [x for part in byte_slices(batch["text"].tolist()) for x in chain.aggregate(*chain.marginals(part, memory))]
            yield pd.DataFrame({"x": found} | {c: batch[c].tolist() for c in ("label", "inner", "weight")})

    columns = "x array<double>, label int, inner boolean, weight double"
    rows = sample.select("text", "label", "inner", "weight").mapInPandas(read, columns).collect()
    unseen = [r for r in rows if r["inner"]]
    if {r["label"] for r in unseen} != {0, 1}:
        unseen = rows
    if {r["label"] for r in unseen} != {0, 1}:
        return float(share)
    unseen.sort(key=lambda r: (r["label"], r["x"]))
    x, y, weight = (np.array([r[c] for r in unseen]) for c in ("x", "label", "weight"))
    return Tagger(chain.weights, trans, start, fit_curve(x, y, weight))


def predict(text: Column, model: Tagger | float) -> Column:
    """struct<score, predicted, spans> of a text column."""
    if isinstance(model, float):
        none = F.array().cast("array<struct<start:int,end:int>>")
        return F.struct(
            F.lit(model).alias("score"), F.lit(int(model >= THRESHOLD)).alias("predicted"), none.alias("spans")
        )

    @arrow_udf("score double, predicted int, spans array<struct<start:int,end:int>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        memory: dict[str, float] = {}
        for texts in batches:
            rows: list[tuple] = []
            for part in byte_slices(texts.tolist()):
                score, marginal, ends = model.judge(part, memory)
                start = 0
                for t, p, end in zip(part, score.tolist(), ends.tolist(), strict=True):
                    spans = [{"start": a, "end": b} for a, b in spans_of(t, marginal[start:end])] if end > start else []
                    rows.append((p, int(p >= THRESHOLD), spans))
                    start = end
            yield pd.DataFrame(rows, columns=["score", "predicted", "spans"])

    return run(text)


def is_clean(text: Column, model: Tagger | float) -> Column:
    """Whether a text is not predicted toxic; spans are not made."""
    if isinstance(model, float):
        return F.lit(model < THRESHOLD)

    @arrow_udf("boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memory: dict[str, float] = {}
        for texts in batches:
            yield pd.Series([p < THRESHOLD for part in byte_slices(texts.tolist()) for p in model.judge(part, memory)[0].tolist()], dtype=bool)

    return run(text)


def classify(docs: DataFrame, labels: DataFrame, folds: int = 4, fold: int = 2) -> DataFrame:
    """(doc_id, held_out, score, predicted, spans) of each row; learned from labelled rows that aren't held out."""
    small_batches(docs.sparkSession)
    model = fit(docs, labels, folds=folds, fold=fold)
    found = docs.select("doc_id", held_out("doc_id", folds, fold).alias("held_out"), predict(F.col("text"), model).alias("found"))
    return found.select("doc_id", "held_out", "found.*")


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic."""
    small_batches(docs.sparkSession)
    return keep_rows(docs, is_clean(F.col("text"), fit(docs, labels)))


def op10_toxic_crf(spark, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op10_toxic_crf": op10_toxic_crf}
ORACLES: dict[str, str] = {}
