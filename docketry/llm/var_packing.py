"""Best-fit packing into sequences of several permitted lengths.

A document longer than the largest capacity is cut: each full stretch is a bin of its own, and the rest is an item. All
items are dealt to shards of about ``SHARD_ITEMS`` by a hash, so a shard is bounded whatever the table's size, and each
shard is packed by itself, largest items first. An item goes to the open bin that it leaves the least room in. If none
takes it, a bin is opened, of the capacity with the least cost per word: each permitted capacity is filled on trial
with the largest items still to come, which weighs all capacities against what is there to fill them. At last every
bin is cut down to the cheapest capacity that holds its contents.

Lengths are numbers of words of the whole text. Defined results: a null text and one without words have length 0 and
get one row without a bin. A null id is an id like any other. Repeated rows are packed once each. An empty
table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import ship, stored, table

CAPACITIES = (1024, 2048, 4096, 8192)
#: Words that a bin costs besides its capacity (its share of a step's fixed work).
BIN_COST = 32
SHARD_ITEMS = 20_000
COLUMNS = (
    "doc_id long, copy long, piece long, start long, length long, bin_id string, bin_start long, capacity long"
)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def trial_fill(first: int, capacity: int, sizes: list[int], left: dict[int, int]) -> int:
    """Words in a bin that starts with ``first`` and takes the largest fitting items that are left."""
    room, taken = capacity - first, {first: 1}
    end = len(sizes)
    while room > 0 and (end := bisect_left(sizes, room + 1, 0, end)):
        size = sizes[end - 1]
        n = min(left[size] - taken.get(size, 0), room // size)
        if n > 0:
            taken[size] = taken.get(size, 0) + n
            room -= n * size
        end -= 1
    return capacity - room


def pack(
    lengths: Sequence[int], capacities: Sequence[int] = CAPACITIES, bin_cost: float = BIN_COST
) -> list[tuple[int, int, int]]:
    """(bin, start in the bin, capacity) of each item. Lengths are from 1 to the largest capacity."""
    capacities = sorted(set(capacities))
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    left: dict[int, int] = {}
    for n in lengths:
        left[n] = left.get(n, 0) + 1
    sizes = sorted(left)
    rooms: list[int] = []  # distinct free spaces of open bins
    open_bins: dict[int, list[int]] = {}
    used: list[int] = []
    full: list[int] = []
    out: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    for i in order:
        size = lengths[i]
        at = bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms[at]
            bin_id = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room], rooms[at]
        else:
            fitting = [c for c in capacities if c >= size]
            best = min(fitting, key=lambda c: ((c + bin_cost) / trial_fill(size, c, sizes, left), c))
            bin_id, room = len(used), best
            used.append(0)
            full.append(best)
        out[i] = (bin_id, used[bin_id])
        used[bin_id] += size
        room -= size
        if room:
            if room not in open_bins:
                open_bins[room] = []
                insort(rooms, room)
            open_bins[room].append(bin_id)
        left[size] -= 1
        if not left[size]:
            del left[size]
            sizes.pop()  # items come largest first, so this was the last size
    final = [capacities[bisect_left(capacities, n)] for n in used]
    return [(b, s, final[b]) for b, s in out]


def pack_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    length: Column | None = None,
    capacities: Sequence[int] = CAPACITIES,
    bin_cost: float = BIN_COST,
    shard_items: int = SHARD_ITEMS,
) -> DataFrame:
    """A row for each piece of each document: which words (start, length) lie where (bin, start there, capacity).

    ``copy`` numbers the rows of one id and length, from 0. Only ids and lengths are shuffled.
    """
    largest = max(capacities)
    size = word_count(F.col("text")) if length is None else length.cast("long")
    lengths = docs.select(F.col(doc_id).cast("long").alias("doc_id"), size.alias("total"))
    # Rows of one id and length are counted first: a row that is there a million times is spread like others.
    counted = stored(lengths.groupBy("doc_id", "total").agg(F.count("*").alias("rows")), "lengths")
    numbered = counted.select("doc_id", "total", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)).alias("copy"))

    cut = numbered.filter(F.col("total") >= largest).select(
        "doc_id", "total", "copy", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("total") / largest) - 1)).alias("piece")
    )
    whole_bins = cut.select(
        "doc_id",
        "copy",
        "piece",
        (F.col("piece") * largest).alias("start"),
        F.lit(largest).cast("long").alias("length"),
        F.concat_ws("-", F.lit("whole"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "total", "copy", "piece").alias("bin_id"),
        F.lit(0).cast("long").alias("bin_start"),
        F.lit(largest).cast("long").alias("capacity"),
    )
    none = F.lit(None)
    empty = numbered.filter("total <= 0").select(
        "doc_id", "copy", F.lit(0).cast("long").alias("piece"), F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("length"),
        none.cast("string").alias("bin_id"), none.cast("long").alias("bin_start"), none.cast("long").alias("capacity"),
    )
    rest = F.col("total") % largest
    items = numbered.filter((F.col("total") > 0) & (rest > 0)).select(
        "doc_id", "copy", F.floor(F.col("total") / largest).alias("piece"), (F.col("total") - rest).alias("start"), rest.alias("length"),
    )
    n_items = counted.filter((F.col("total") > 0) & (rest > 0)).agg(F.sum("rows")).first()[0] or 0
    shards = max(1, -(-n_items // shard_items))

    def pack_shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start", "copy", "no_id"], ascending=[False, True, True, True, True])
        found = pack(rows["length"].tolist(), capacities, bin_cost)
        rows = rows[["doc_id", "copy", "piece", "start", "length", "no_id"]]
        return rows.assign(
            bin_id=[f"{key[0]}-{b}" for b, _, _ in found],
            bin_start=np.array([s for _, s, _ in found], np.int64),
            capacity=np.array([c for _, _, c in found], np.int64),
        )

    ship(docs.sparkSession)
    shard = F.pmod(F.xxhash64("doc_id", "start", "length", "copy"), F.lit(shards)).cast("int")
    # pandas has no null in an integer column: a flag stands for the null id.
    dealt = items.withColumns({"shard": shard, "no_id": F.col("doc_id").isNull(), "doc_id": F.coalesce("doc_id", F.lit(0))})
    packed = dealt.groupBy("shard").applyInPandas(pack_shard, COLUMNS + ", no_id boolean")
    packed = packed.withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id"))).drop("no_id")
    return packed.unionByName(whole_bins).unionByName(empty)


def op9_var_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op9_var_packing": op9_var_packing}
ORACLES: dict[str, str] = {}
