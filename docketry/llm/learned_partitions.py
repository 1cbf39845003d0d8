"""Nearest neighbours by learned partitions: a balanced partitioning of a neighbour graph, and a small classifier that
routes vectors to its parts.

On a bounded sample the exact neighbour graph is built and cut into parts of about equal size with few edges between
them (balanced bisection, then moves that keep the balance). A network with one hidden layer learns from a
vector which parts its neighbours lie in. Every row of the table is indexed: it goes to its most probable part. A
query is sent to its ``probes`` most probable parts and compared there with every member, in double precision.
``probes`` is the smallest number that finds ``TARGET_RECALL`` of the true neighbours of sample vectors left out of the
training, so hard data are searched wider; with all parts probed the search is exact.

Equal vectors are one member with its smallest ids, as many as a result can name: a vector that a third of all rows
share costs what one does. Members of a part are compared in blocks of ``BLOCK`` vectors, so a part may have any size.

Bounds: the driver receives ``SAMPLE`` vectors and trains on them; the network (some hundred kilobytes, whatever the
table) goes to all tasks.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, nor do those of
another than the most frequent length (of two as frequent ones, the longer). Rows without id take no part.
With fewer candidates than asked for, all are returned. Repeated rows of one id and vector are one row. An empty
table gives an empty result; columns of other names are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketry.llm.common import arrow_udf, ship, stored, table

TOP = 20
SAMPLE = 8_192
#: Sample vectors that only measure recall.
PROBE_SAMPLE = 1_024
#: Rows that a part should have, within the numbers of parts that the sample can teach.
PART_ROWS = 1_024
MIN_PARTS, MAX_PARTS = 8, 64
GRAPH_NEIGHBOURS = 16
HIDDEN = 256
TARGET_RECALL = 0.95
BLOCK = 1_024


def neighbours(queries: np.ndarray, base: np.ndarray, k: int, own: bool) -> np.ndarray:
    """Places of the k nearest of ``base`` by inner product; ``own`` leaves out a query's own place."""
    out = np.empty((len(queries), k), np.int64)
    for at in range(0, len(queries), 1024):
        s = queries[at : at + 1024] @ base.T
        if own:
            s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        out[at : at + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def bisect(x: np.ndarray, parts: int) -> np.ndarray:
    """Parts of equal size by halving along the direction of the largest spread."""
    part = np.zeros(len(x), np.int64)
    todo = [(np.arange(len(x)), 0, parts)]
    while todo:
        rows, low, n = todo.pop()
        if n == 1:
            part[rows] = low
            continue
        centred = x[rows] - x[rows].mean(axis=0)
        axis = np.linalg.eigh(centred.T @ centred)[1][:, -1]
        order = np.argsort(centred @ axis, kind="stable")
        left = n // 2
        cut = len(rows) * left // n
        todo += [(rows[order[:cut]], low, left), (rows[order[cut:]], low + left, n - left)]
    return part


def partition_graph(graph: np.ndarray, part: np.ndarray, parts: int, slack: float = 0.1, rounds: int = 12) -> np.ndarray:
    """Moves vertices to the part with most of their neighbours, best gains first, while sizes stay balanced."""
    n = len(graph)
    part = part.copy()
    most, least = int(np.ceil(n / parts * (1 + slack))), int(n / parts * (1 - slack))
    sizes = np.bincount(part, minlength=parts)
    # Both directions of an edge count.
    src, dst = np.repeat(np.arange(n), graph.shape[1]), graph.ravel()
    src, dst = np.concatenate([src, dst]), np.concatenate([dst, src])
    for _ in range(rounds):
        weight = np.zeros((n, parts), np.float32)
        np.add.at(weight, (src, part[dst]), 1.0)
        gain = weight - weight[np.arange(n), part][:, None]
        best = gain.argmax(axis=1)
        value = gain[np.arange(n), best]
        moved = 0
        for v in np.argsort(-value, kind="stable").tolist():
            if value[v] <= 0:
                break
            a, b = int(part[v]), int(best[v])
            # The best part with room; a half of the moves per round keeps neighbours from swapping places.
            if sizes[b] < most and sizes[a] > least:
                part[v] = b
                sizes[a] -= 1
                sizes[b] += 1
                moved += 1
        if moved < n // 500:
            break
    return part


@dataclass(frozen=True)
class Router:
    """A network with one hidden layer over unit vectors; logits of the parts."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def logits(self, x: np.ndarray) -> np.ndarray:
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        return np.maximum(unit @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def train_router(x: np.ndarray, target: np.ndarray, rounds: int = 30, rate: float = 2e-3, seed: int = 1) -> Router:
    """Cross entropy against the shares of a vector's neighbours in each part, by Adam."""
    rng = np.random.default_rng(seed)
    size, parts = x.shape[1], target.shape[1]
    unit = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    target = target.astype(np.float32)
    p = [
        rng.normal(0, np.sqrt(2 / size), (size, HIDDEN)) * np.sqrt(size) / 2,
        np.zeros(HIDDEN),
        rng.normal(0, np.sqrt(2 / HIDDEN), (HIDDEN, parts)),
        np.zeros(parts),
    ]
    p = [a.astype(np.float32) for a in p]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    step, batch = 0, 256
    for turn in range(rounds):
        now = rate * 0.5 * (1 + np.cos(np.pi * turn / rounds))
        order = rng.permutation(len(unit))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            hidden = np.maximum(unit[rows] @ p[0] + p[1], 0)
            z = hidden @ p[2] + p[3]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            dz = (z / z.sum(axis=1, keepdims=True) - target[rows]) / len(rows)
            dh = (dz @ p[2].T) * (hidden > 0)
            grads = [unit[rows].T @ dh, dh.sum(axis=0), hidden.T @ dz, dz.sum(axis=0)]
            step += 1
            for i, g in enumerate(grads):
                m[i] += 0.1 * (g - m[i])
                v[i] += 0.001 * (g * g - v[i])
                p[i] -= now * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8) + now * 1e-3 * p[i]
    return Router(*p)


def learn(x: np.ndarray, rows: int) -> tuple[Router, int, int]:
    """The router, its number of parts and of probes, from sample vectors of a table of so many distinct ones."""
    parts = int(min(max(rows // PART_ROWS, MIN_PARTS), MAX_PARTS, max(1, len(x) // 32)))
    size = x.shape[1]
    if parts == 1:
        return Router(np.zeros((size, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)), 1, 1
    held = min(PROBE_SAMPLE, len(x) // 8)
    train, test = x[held:], x[:held]
    k = min(GRAPH_NEIGHBOURS, len(train) - 1)
    graph = neighbours(train, train, k, own=True)
    part = partition_graph(graph, bisect(train, parts), parts)
    target = np.zeros((len(train), parts))
    np.add.at(target, (np.repeat(np.arange(len(train)), k), part[graph.ravel()]), 1.0 / k)
    target[np.arange(len(train)), part] += 1.0 / k
    router = train_router(train, target / target.sum(axis=1, keepdims=True))
    # Neighbours of left-out vectors: as many as lie in the share of the table that the sample is.
    near = neighbours(test, train, min(TOP, len(train)), own=False)
    home = router.logits(train).argmax(axis=1)
    rank = np.empty((len(test), parts), np.int64)
    order = np.argsort(-router.logits(test), axis=1, kind="stable")
    np.put_along_axis(rank, order, np.arange(parts)[None, :], axis=1)
    needed = np.sort(np.take_along_axis(rank, home[near], axis=1).ravel())
    probes = int(needed[min(len(needed) - 1, int(np.ceil(TARGET_RECALL * len(needed))))]) + 1
    return router, parts, probes


def usable(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, v) of the rows that take part, each once; ``v`` in double precision."""
    v = F.col(vector).cast("array<double>")
    limit = F.lit(float("inf"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit)) & F.exists("v", lambda x: x != 0)
    found = rows.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()
    ).filter(fine)
    sizes = found.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    return found.filter(F.size("v") == (sizes["size"] if sizes else 0)).distinct()


def members_of(rows: DataFrame, top: int) -> DataFrame:
    """(key, v, ids): each distinct vector with its ``top`` + 1 smallest ids; the smallest is its key."""
    place = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = rows.withColumn("place", place).filter(F.col("place") <= top + 1)
    grouped = few.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    return grouped.select(F.col("ids")[0].alias("key"), "v", "ids")


def routed(members: DataFrame, router: Router, probes: int) -> DataFrame:
    """With a column ``route``: the most probable parts, the first one first."""

    @arrow_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vectors in batches:
            x = np.stack(vectors.to_numpy()).astype(float) if len(vectors) else np.zeros((0, router.w1.shape[0]))
            order = np.argsort(-router.logits(x), axis=1, kind="stable")[:, :probes].astype(np.int32)
            yield pd.Series(list(order), dtype=object)

    return members.withColumn("route", run(F.col("v")))


def blocks(rows: DataFrame, schema: str, name: str) -> DataFrame:
    """Rows (part, key, v, ids) packed into blocks of about ``BLOCK`` rows of one part each."""
    counts = rows.groupBy("part").agg(F.count("*").alias("n"))
    dealt = rows.join(counts, "part").withColumn(
        "block", F.pmod(F.xxhash64("key"), F.ceil(F.col("n") / BLOCK)).cast("int")
    )

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("key")
        out = {
            "part": [int(part["part"].iloc[0])],
            f"{name}_keys": [part["key"].to_numpy(np.int64)],
            f"{name}_vectors": [np.stack(part["v"].to_numpy()).astype("<f8").tobytes()],
        }
        if "ids" in part:
            out |= {
                f"{name}_ids": [np.concatenate(part["ids"].to_numpy()).astype(np.int64)],
                f"{name}_sizes": [np.fromiter(map(len, part["ids"]), np.int32, len(part))],
            }
        return pd.DataFrame(out)

    ship(rows.sparkSession)
    return dealt.drop("n").groupBy("part", "block").applyInPandas(pack, schema)


def compare(batches: Iterator[pd.DataFrame], top: int) -> Iterator[pd.DataFrame]:
    """Of pairs of a query block and a member block: for each query the best ids there, with scores below zero."""
    for batch in batches:
        for r in batch.itertuples():
            queries = np.frombuffer(r.q_vectors, "<f8").reshape(len(r.q_keys), -1)
            base = np.frombuffer(r.m_vectors, "<f8").reshape(len(r.m_keys), -1)
            scores = queries @ base.T
            ends = np.cumsum(r.m_sizes)
            rows = []
            for key, own in zip(r.q_keys.tolist(), scores, strict=True):
                if len(own) > top + 1:
                    # All members down to the last place's score, so that ties go by id and not by place.
                    floor = np.partition(own, len(own) - top - 1)[len(own) - top - 1]
                    near = np.flatnonzero(own >= floor)
                else:
                    near = np.arange(len(own))
                ids = np.concatenate([r.m_ids[ends[i] - r.m_sizes[i] : ends[i]] for i in near])
                value = np.repeat(own[near], r.m_sizes[near])
                order = np.lexsort((ids, -value))[: top + 1]
                rows.append((key, r.part, -value[order], ids[order]))
            yield pd.DataFrame(rows, columns=["key", "part", "far", "ids"])


def merged(entries: DataFrame, by: list[str], top: int) -> DataFrame:
    """The first ``top`` + 1 entries of all lists of a group; entries sort by distance, then id."""
    every = F.array_sort(F.flatten(F.collect_list("near")))
    return entries.groupBy(*by).agg(F.slice(every, 1, top + 1).alias("near"))


def search(rows: DataFrame, asked: DataFrame | None = None, vec_id: str = "vec_id", vector: str = "embedding", top: int = TOP, every: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest rows found for every row whose id is divisible by ``every`` (or
    those of ``asked``, a column ``vec_id``), nearest first, ties to the smaller id, the query itself left out."""
    use = stored(usable(rows, vec_id, vector), "vectors")
    members = stored(members_of(use, top), "members")
    n = members.count()
    queries = use.filter(F.col("vec_id") % every == 0) if asked is None else use.join(asked.select("vec_id").distinct(), "vec_id", "left_semi")
    sample = members.orderBy(F.xxhash64("key", F.lit(7)), "key").limit(SAMPLE).select("v").collect()
    if not sample:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    router, parts, probes = learn(np.array([r["v"] for r in sample], dtype=float), n)
    # Queries of one vector are one question; its key stands for them.
    asks = stored(queries.join(members.select("key", "v"), "v").select(F.col("vec_id").alias("query_id"), "key"), "asks")
    questions = members.select("key", "v").join(asks.select("key").distinct(), "key", "left_semi")

    index = routed(members, router, 1).select(F.col("route")[0].alias("part"), "key", "v", "ids")
    member_blocks = blocks(index, "part int, m_keys array<long>, m_vectors binary, m_ids array<long>, m_sizes array<int>", "m")
    sent = routed(questions, router, probes).select(F.explode("route").alias("part"), "key", "v")
    query_blocks = blocks(sent, "part int, q_keys array<long>, q_vectors binary", "q")
    met = query_blocks.join(member_blocks, "part")
    found = met.mapInPandas(lambda b: compare(b, top), "key long, part int, far array<double>, ids array<long>")
    # Short lists are merged first by part, then over all parts; none is longer than a part has blocks, or parts.
    entries = found.select("key", "part", F.arrays_zip("far", "ids").alias("near"))
    lists = merged(merged(entries, ["key", "part"], top), ["key"], top)
    answered = asks.join(lists, "key").select("query_id", F.filter("near", lambda x: x["ids"] != F.col("query_id")).alias("near"))
    ranked = answered.select("query_id", F.posexplode(F.slice("near", 1, top)).alias("i", "x"))
    return ranked.select("query_id", (F.col("i") + 1).cast("int").alias("rank"), F.col("x.ids").alias("vec_id"), (-F.col("x.far")).alias("score"))


def op3_learned_partitions(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))


QUERIES = {"op3_learned_partitions": op3_learned_partitions}
ORACLES: dict[str, str] = {}
