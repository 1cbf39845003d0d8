"""SimHash near duplicates: fingerprints compared tile by tile, exactly, with exclusive-or and bit counts.

A document's fingerprint has a bit where over half of its four-word shingles, repeats included, have it in their XXH64
(seed 42). Words are runs of anything but space, tab, line feed, vertical tab, form feed and carriage return, A-Z
lowered; a shingle is its words with a space between. Documents whose fingerprints differ in ``RADIUS`` bits or fewer are
linked; the result names each document's component under these links.

1. *Distinct fingerprints.* Equal ones are one from here on, however many documents have them.
2. *Tiles.* A tile holds some ``TILE`` fingerprints of one population count; which of the tiles of a count, goes by hash.
   Two fingerprints within the radius have counts that differ by no more than it, so only such tiles meet, each
   pair of tiles once and as one task's work of a fixed size.
3. *Comparison.* Inside a pair of tiles the same is done with the counts of the four quarters: cells of equal counts meet
   where the four differences sum up to the radius at most. What is left is compared in blocks of ``BLOCK`` numbers.
4. *Links.* Of the links of a pair of tiles only a spanning forest is returned, at most a row for each of their
   fingerprints; a group of copies that are all near each other never becomes all its pairs. Components follow from it.

The comparison is exact and so quadratic in the number of distinct fingerprints, less the skipped tiles and cells (for
evenly spread bits about one pair in twelve is compared). Tiles are 512 KiB; each is sent to the pairs it takes part in.

Defined results: a null or empty text and one without words have the fingerprint zero and are linked like any other; a
row without id keeps its fingerprint, takes no part and has a null component. Repeated rows are judged one by one.
An empty table gives an empty result; columns of other names are not looked at. A text is hashed in one task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import starmap

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import arrow_udf, ship, small_batches, stored, table
from docketry.llm.components import components
from docketry.llm.skew import left_join

RADIUS = 4
SHINGLE = 4
SEED = 42
#: Fingerprints of a tile.
TILE = 1 << 16
#: Numbers of a block of comparisons, and links after which a forest takes their place.
BLOCK = 1 << 20
#: Pairs of tiles for each task.
PAIRS_PER_TASK = 4


# --- fingerprints ---------------------------------------------------------------------------


def shingle_hashes(text: str | None) -> np.ndarray:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    whole = b" ".join(words)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(whole, SEED)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    slices = starmap(slice, zip(starts[: len(words) - SHINGLE + 1].tolist(), ends[SHINGLE - 1 :].tolist(), strict=True))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(whole[s], SEED) for s in slices), np.uint64, len(words) - SHINGLE + 1)


def majority(hashes: np.ndarray) -> int:
    """The number whose bits are set in over half of the hashes, as a signed one."""
    count = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[at : at + (1 << 16)], "<u8").view(np.uint8).reshape(-1, 8)
        count += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text as a signed 64-bit number."""

    @arrow_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([majority(shingle_hashes(t)) for t in texts.tolist()], dtype="int64")

    return run(text)


# --- comparison -----------------------------------------------------------------------------


def by_cell(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The numbers sorted by the bit counts of their quarters; each cell's first place (and the end), and its counts."""
    quarters = np.bitwise_count(np.ascontiguousarray(numbers, "<u8").view("<u2").reshape(-1, 4)).astype(np.int16)
    order = np.lexsort(quarters.T)
    numbers, quarters = numbers[order], quarters[order]
    first = np.flatnonzero(np.r_[True, (quarters[1:] != quarters[:-1]).any(axis=1)])
    return numbers, np.r_[first, len(numbers)], quarters[first]


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of the same components as the links (u, v), one less than a component has numbers."""
    nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = place[: len(u)], place[len(u) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        if (root[a] == low).all() and (root[b] == low).all():
            break
        before = root.copy()
        for end in (a, b):
            np.minimum.at(root, before[end], low)
            np.minimum.at(root, end, low)
        while (root[root] != root).any():
            root = root[root]
    tied = root != np.arange(len(nodes))
    return nodes[tied], nodes[root[tied]]


def links(left: np.ndarray, right: np.ndarray | None, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the pairs of numbers that differ in ``radius`` bits or fewer, between the two tiles or, without
    a second one, within the first."""
    a, a_cuts, a_cells = by_cell(left)
    b, b_cuts, b_cells = (a, a_cuts, a_cells) if right is None else by_cell(right)
    size = np.diff(b_cuts)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    for k, cell in enumerate(a_cells):
        near = np.abs(b_cells - cell).sum(axis=1) <= radius
        if right is None:
            near[:k] = False
        own, beside = a[a_cuts[k] : a_cuts[k + 1]], b[np.repeat(near, size)]
        if not len(beside):
            continue
        step = max(1, BLOCK // len(beside))
        for at in range(0, len(own), step):
            apart = np.bitwise_count(own[at : at + step, None] ^ beside[None, :])
            i, j = np.nonzero((apart <= radius) & (apart > 0))
            if len(i):
                found.append((own[at + i], beside[j]))
                held += len(i)
            if held > BLOCK:
                found = [forest(*map(np.concatenate, zip(*found, strict=True)))]
                held = len(found[0][0])
    none = np.zeros(0, np.uint64)
    return forest(*map(np.concatenate, zip(*found, strict=True))) if found else (none, none)


def tile_links(fingerprints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v) links that connect the same of the distinct numbers (fp) as all pairs within the radius do."""
    spark = fingerprints.sparkSession
    counted = fingerprints.select("fp", F.bit_count("fp").alias("bits"))
    sizes = {r["bits"]: r["n"] for r in counted.groupBy("bits").agg(F.count("*").alias("n")).collect()}
    tiles = [-(-sizes.get(bits, 0) // TILE) for bits in range(65 + radius)]
    n_pairs = sum(
        n * (n + 1) // 2 if far == 0 else n * tiles[bits + far] for bits, n in enumerate(tiles[:65]) for far in range(radius + 1)
        if bits + far < len(tiles)
    )
    # What tiles a tile meets follows from the number of tiles of each count.
    tiles_of = F.array(*[F.lit(n) for n in tiles])
    tile = F.pmod(F.xxhash64("fp"), F.greatest(F.element_at(tiles_of, F.col("bits") + 1), F.lit(1))).cast("int")
    packed = counted.withColumn("tile", tile).groupBy("bits", "tile").agg(F.collect_list("fp").alias("fps"))

    def others(bits: Column) -> Column:
        there = F.element_at(tiles_of, bits + 1)
        return F.when(there > 0, F.transform(F.sequence(F.lit(0), there - 1), lambda t: F.struct(bits.alias("bits"), t.alias("tile"))))

    empty = F.array().cast("array<struct<bits:int,tile:int>>")
    own = F.struct("bits", "tile")
    counts = F.sequence(F.greatest(F.col("bits") - radius, F.lit(0)), F.col("bits") + radius)
    met = F.flatten(F.transform(counts, lambda c: F.coalesce(others(c), empty)))
    sent = packed.select("fps", own.alias("own"), F.explode(met).alias("other"))
    pair = F.struct(F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    tasks = min(n_pairs, max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_pairs // PAIRS_PER_TASK)) or 1
    dealt = sent.select(pair.alias("pair"), "fps").repartition(tasks, "pair")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        both = [np.asarray(x, np.int64).view(np.uint64) for x in rows["fps"]]
        u, v = links(both[0], both[1] if len(both) > 1 else None, radius)
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    ship(spark)
    return dealt.groupBy("pair").applyInPandas(compare, "u long, v long")


def similar_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) of each row; ``component_id`` is the smallest id reachable by links."""
    small_batches(docs.sparkSession)
    rows = stored(docs.select(F.col(doc_id).cast("long").alias("doc_id"), fingerprint(F.col(text)).alias("fp")), "fingerprints")
    total = rows.count()
    classes = rows.filter("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"))
    classes = stored(classes, "classes")
    roots = components(stored(tile_links(classes.select("fp"), radius), "links"))
    named = stored(classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")), "named")
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count("*").alias("nodes"))
    by_fp = left_join(named.select("fp", "n", "root"), stored(least, "least"), ["root"], "nodes", total).drop("root")
    out = left_join(rows, stored(by_fp, "by_fp"), ["fp"], "n", total)
    return out.select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def op13_simhash_tiles(spark, sf_dir: str) -> DataFrame:
    found = similar_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op13_simhash_tiles": op13_simhash_tiles}
ORACLES: dict[str, str] = {}
