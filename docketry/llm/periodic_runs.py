"""Periodic runs of words, found with a dictionary of basic factors, and texts with the repeats taken out.

A run is a stretch of consecutive words whose smallest period is q, that no neighbouring word extends, of at least
``LEAST`` words and ``TIMES`` periods. Words are runs of anything but space, tab, line feed, vertical tab, form feed and
carriage return; they are compared as they are.

1. *Basic factors.* Every stretch of L = 1, 2, 4, ... words gets a name, equal stretches of a text the same one; the name
   for 2 L is that of the pair of names for L. A stretch that occurs once in its text is dropped at once: no
   longer stretch that holds it can recur, so prose is done after two or three lengths.
2. *Proposals.* For each L from ``FIRST`` on, an occurrence whose successor starts d <= L words later (both within a
   stretch of twice the length) proposes the period d. As L >= d, the stretch from the one to the end of the other has no
   smaller period, and all occurrences within a run follow each other at that distance: they are arithmetic
   progressions, and those that touch are merged into one stretch on which words d apart agree.
3. *Extension.* Each stretch grows at both ends while words d apart agree; equal (start, length, period) count once.
   Every run is proposed: with the power of two L for which L / 2 < q <= L (or L = ``FIRST`` for smaller q), a run of 3 q
   words has a place with L + q words left.

Rows are judged one by one: no shuffle, equal texts get equal results. A task holds some ``PASS_BYTES`` of text at a time,
or one text that is longer; its work is the text's words times the logarithm of its longest repeated stretch.

Defined results: a null or empty text and one without words have no run and an empty collapsed text. A row without id
is judged like any other. An empty table gives an empty result; columns of other names are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import arrow_udf, small_batches, table

#: Words and periods that a run has at least.
LEAST = 24
TIMES = 3
#: The shortest stretch that proposes periods: a run of LEAST words and a period up to it holds a stretch and its successor.
FIRST = 8
#: Text bytes that are worked on at a time.
PASS_BYTES = 1 << 21

FOUND = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def name_words(texts: Sequence[Sequence[bytes]]) -> np.ndarray:
    """The words of all texts as numbers, equal ones of a text alike; each text ends with a number of its own."""
    known: dict[bytes, int] = {}
    flat = np.concatenate(
        [np.fromiter((known.setdefault(w, len(known)) for w in [*words, b" "]), np.int64, len(words) + 1) for words in texts]
    )
    text_of = np.repeat(np.arange(len(texts)), [len(w) + 1 for w in texts])
    return pd.factorize(text_of * len(known) + flat)[0].astype(np.int64)


def repeated(names: np.ndarray) -> np.ndarray:
    return np.bincount(names)[names] > 1


def proposals(words: np.ndarray) -> np.ndarray:
    """(start, stop, period) rows: words d apart agree for all starts from ``start`` up to ``stop``."""
    out = [np.zeros((0, 3), np.int64)]
    at = np.flatnonzero(repeated(words))
    name = np.full(len(words) + 1, -1, np.int64)
    name[at] = words[at]
    size = 1
    while len(at):
        if size >= FIRST:
            out.append(progressions(at, name[at], size))
        ahead = at + size
        at = at[(ahead < len(words)) & (name[np.minimum(ahead, len(words))] >= 0)]
        if not len(at):
            break
        pair = pd.factorize(name[at] * (int(name.max()) + 1) + name[at + size])[0]
        keep = repeated(pair)
        at, pair = at[keep], pair[keep]
        name.fill(-1)
        name[at] = pair
        size *= 2
    return np.concatenate(out)


def progressions(at: np.ndarray, names: np.ndarray, size: int) -> np.ndarray:
    """Proposals of one length: places ascend."""
    order = np.argsort(names, kind="stable")
    place, name = at[order], names[order]
    step = np.diff(place)
    near = (np.diff(name) == 0) & (step <= size) & (step > (0 if size == FIRST else size // 2))
    start, period = place[:-1][near], step[near]
    order = np.lexsort((start, period))
    start, period = start[order], period[order]
    # Stretches of one period that overlap or touch are one.
    new = np.ones(len(start), bool)
    new[1:] = (period[1:] != period[:-1]) | (start[1:] > start[:-1] + size)
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(start)] - 1 if len(first) else first
    return np.stack([start[first], start[last] + size, period[first]], axis=1)


def find_runs(words: np.ndarray) -> np.ndarray:
    """(start, length, period) rows of all runs, by start and period."""
    start, stop, period = proposals(words).T.copy()
    # A text's end has a number of its own, so nothing grows beyond it.
    grows = np.arange(len(start))
    while len(grows):
        grows = grows[start[grows] > 0]
        grows = grows[words[start[grows] - 1] == words[start[grows] - 1 + period[grows]]]
        start[grows] -= 1
    grows = np.arange(len(start))
    while len(grows):
        grows = grows[stop[grows] + period[grows] < len(words)]
        grows = grows[words[stop[grows]] == words[stop[grows] + period[grows]]]
        stop[grows] += 1
    length = stop - start + period
    long_enough = length >= np.maximum(LEAST, TIMES * period)
    found = np.stack([start, length, period], axis=1)[long_enough]
    found = np.unique(found, axis=0)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def dropped(runs: np.ndarray, n: int) -> np.ndarray:
    """Whether each of n words lies in a run, after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:n]) > 0


def judge(texts: Sequence[str | None]) -> Iterator[tuple[int, list[dict], str]]:
    """Number of words, runs and collapsed text of each text."""
    words = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
    found = find_runs(name_words(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    cuts = np.searchsorted(found[:, 0], np.r_[0, ends])
    for own, end, s, e in zip(words, ends.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        runs: list[dict] = []
        if e > s:
            rows = found[s:e] - [end - len(own) - 1, 0, 0]
            runs = [dict(zip(("start", "length", "period"), r, strict=True)) for r in rows.tolist()]
            gone = dropped(rows, len(own))
            kept = [w for w, g in zip(own, gone.tolist(), strict=True) if not g]
        else:
            kept = own
        yield len(own), runs, b" ".join(kept).decode("utf-8", "surrogatepass")


def passes(texts: Sequence[str | None]) -> Iterator[list[str | None]]:
    run: list[str | None] = []
    size = 0
    for text in texts:
        if run and size + len(text or "") > PASS_BYTES:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text or "") + 1
    if run:
        yield run


def runs(text: Column) -> Column:
    """struct<n_words, runs, collapsed> of a text column."""

    @arrow_udf(FOUND)
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = [row for part in passes(texts.tolist()) for row in judge(part)]
        return pd.DataFrame(rows, columns=["n_words", "runs", "collapsed"])

    return run(text)


def collapse(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of each row."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(doc_id).alias("doc_id"), runs(F.col(text)).alias("found")).select("doc_id", "found.*")


# --- the query ------------------------------------------------------------------------------


def planted(doc_id: Column, text: Column) -> Column:
    """The text, or for one id in ten its words up to a place and then, to its end, repeats of a period from there."""

    @arrow_udf("string")
    def rewrite(ids: pd.Series, texts: pd.Series) -> pd.Series:
        return pd.Series([repeat(i, t) for i, t in zip(ids.tolist(), texts.tolist(), strict=True)], dtype=object)

    return F.when(F.crc32(doc_id.cast("string")) % 10 == 0, rewrite(doc_id.cast("string"), text)).otherwise(text)


def repeat(doc_id: str | None, text: str | None) -> str | None:
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if doc_id is None or not words:
        return text
    n, g = len(words), crc32(doc_id.encode()) // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    again = words[a : a + p]
    whole = words[:a] + again * ((n - a) // len(again)) + again[: (n - a) % len(again)]
    return b" ".join(whole).decode("utf-8", "surrogatepass")


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = collapse(docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text")))
    # Fractions are compared by cross products, which are exact.
    better = lambda a, b: F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a)
    best = F.when(F.size("runs") > 0, F.aggregate(F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))), F.element_at("runs", 1), better))
    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES = {"op11_periodic_runs": op11_periodic_runs}
ORACLES: dict[str, str] = {}
