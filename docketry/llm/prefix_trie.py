"""Conversations as a prefix trie, with totals over subtrees by centroid decomposition of the parent edges.

A node is a distinct sequence of the first d turns (role, text); its members are the conversations that start with it.
Every node is reported with its members, children, the leaves of its subtree and the text bytes that storing the subtree's
turns once would save.

1. *Prefixes.* Each turn gets a 128-bit number from its place, role and text, and a prefix the exclusive-or of its turns'
   numbers, running along the conversation. Texts end there: what follows moves numbers only.
2. *Nodes.* One aggregate by prefix. A node is named by its smallest member and its depth. The rows of a subtree (turns of
   its members from the node on) add up in the same aggregate, so every subtree's weight is known before any rollup.
3. *Components.* Subtrees of ``LIMIT`` rows at most, as large as can be, are dealt out to tasks. What is above them is a
   smaller forest, to which they hand up their totals; it is treated in the same way, with one conversation for each of
   its nodes' names, until nothing is above. The number of rounds follows the depth over ``LIMIT``, mostly one or two.
4. *Centroids.* In a task, every component is split at its centroid, the deepest node with over half of the component's
   weight, all components at once: the total of what the component has at and below the centroid is added along the path
   from the centroid to the component's top; the centroid's children and the rest above become new components, each of
   at most half the weight. So a node takes part in a logarithmic number of splits, however deep the tree.

Defined results: rows without conv_id are left out; a null role or text is an empty one; turns go by number, null first,
equal numbers by role and text; repeated rows are turns of their own. An empty table gives an empty result; columns
of other names are not looked at. A node's list of ends is hashed in one task as it streams by, in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.llm.common import ship, stored, table
from docketry.llm.skew import left_join

#: Rows of a component that one task takes.
LIMIT = 50_000

NODE = ["depth", "p1", "p2"]
VALUES = ["n_leaves", "saved_tokens"]
NOTHING = hashlib.sha256(b"").hexdigest()


# --- in a task ------------------------------------------------------------------------------


def preorder(parent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in an order in which every subtree is a stretch, and the end of each one's stretch; -1 is no parent."""
    below: list[list[int]] = [[] for _ in parent]
    stack = []
    for i, p in enumerate(parent.tolist()):
        (below[p] if p >= 0 else stack).append(i)
    order: list[int] = []
    end = np.zeros(len(parent), np.int64)
    while stack:
        i = stack.pop()
        if i < 0:
            end[~i] = len(order)
            continue
        order.append(i)
        stack.append(~i)
        stack.extend(below[i])
    return np.array(order, np.int64), end


def rollup(parent: np.ndarray, weight: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (nodes x columns) over subtrees. ``weight`` is that of each whole subtree; it falls from every
    node to its children."""
    order, end = preorder(parent)
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    up = np.where(parent[order] >= 0, place[parent[order]], -1)
    end, left, own = end[order], weight[order].astype(np.int64), values[order]
    total = np.zeros_like(own)
    # In this order every tree is a stretch that begins with its top.
    tops = np.flatnonzero(up < 0)
    top = np.repeat(tops, np.diff(np.r_[tops, len(order)]))
    active = np.arange(len(order))
    while len(active):
        first = np.flatnonzero(np.r_[True, top[1:] != top[:-1]])
        size = np.diff(np.r_[first, len(active)])
        # Nodes with over half of the weight are a path from the top; the last one is the centroid.
        half = 2 * left[active] > left[top]
        centre = np.maximum.reduceat(np.where(half, active, -1), first)
        of = np.repeat(centre, size)
        low = (active >= of) & (active < end[of])
        sums = np.add.reduceat(np.where(low[:, None], own[active], 0), first, axis=0)
        gone = left[centre]
        total[centre] += sums
        at, goal = centre.copy(), top[first]
        climbs = np.flatnonzero(at != goal)
        while len(climbs):
            at[climbs] = up[at[climbs]]
            total[at[climbs]] += sums[climbs]
            left[at[climbs]] -= gone[climbs]
            climbs = climbs[at[climbs] != goal[climbs]]
        # Below the centroid, a component for each child; the last child before a node is the one above it.
        child = np.maximum.accumulate(np.where(low & (up[active] == of), np.arange(len(active)), -1))
        top = np.where(low, active[child], top)
        stays = active != of
        active, top = active[stays], top[stays]
        order_now = np.argsort(top, kind="stable")
        active, top = active[order_now], top[order_now]
    out = np.empty_like(total)
    out[order] = total
    return out


DONE = "conv_id long, depth long, parent_conv_id long, n_leaves long, saved_tokens long, is_top boolean"


def roll_group(rows: pd.DataFrame) -> pd.DataFrame:
    """Totals of all nodes of some whole subtrees."""
    ids = pd.MultiIndex.from_arrays([rows["conv_id"], rows["depth"]])
    above = pd.MultiIndex.from_arrays([rows["parent_conv_id"].fillna(0).astype("int64"), rows["depth"] - 1])
    parent = np.where(rows["depth"] > rows["top_depth"], ids.get_indexer(above), -1)
    total = rollup(parent, rows["weight"].to_numpy(), rows[VALUES].to_numpy(np.int64))
    out = rows[["conv_id", "depth", "parent_conv_id"]].copy()
    out["n_leaves"], out["saved_tokens"] = total[:, 0], total[:, 1]
    out["is_top"] = parent < 0
    return out


def hash_ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One digest for each node of (depth, p1, p2, conv_id) rows in that order, fed as they come."""
    node, digest = None, None

    def row() -> tuple:
        return (*node, digest.hexdigest())

    for batch in batches:
        out = []
        for *key, conv in batch[[*NODE, "conv_id"]].itertuples(index=False):
            if key != node:
                if node is not None:
                    out.append(row())
                node, digest = key, hashlib.sha256(str(conv).encode())
            else:
                digest.update(b",%d" % conv)
        yield pd.DataFrame(out, columns=[*NODE, "ends_sha256"])
    if node is not None:
        yield pd.DataFrame([row()], columns=[*NODE, "ends_sha256"])


# --- prefixes and nodes ---------------------------------------------------------------------


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, bytes, h1, h2) of each turn: place from 1, text bytes, and two hashes of role and text."""
    said = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    in_order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    return said.select(
        "conv_id",
        F.row_number().over(in_order).cast("long").alias("pos"),
        F.octet_length("text").cast("long").alias("bytes"),
        *[F.xxhash64(F.lit(k), "role", "text").alias(f"h{k}") for k in (1, 2)],
    )


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, bytes, p1, p2, q1, q2, rest) of each prefix of each conversation, the empty one included: its
    number, that of the prefix one turn shorter, and how many prefixes of the conversation are at least as long.

    ``turns`` is (conv_id, pos, bytes, h1, h2) with places 0 (no turn), 1, 2, ...
    """
    own = Window.partitionBy("conv_id")
    along = own.orderBy("pos")
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = [F.when(F.col("pos") == 0, F.lit(0)).otherwise(F.xxhash64("pos", F.lit(k), *h)).cast("long") for k, h in ((3, ("h1", "h2")), (4, ("h2", "h1")))]
    run = turns.select(
        "conv_id",
        F.col("pos").alias("depth"),
        "bytes",
        *[F.bit_xor(e).over(so_far).alias(p) for e, p in zip(each, ("p1", "p2"), strict=True)],
        (F.max("pos").over(own) - F.col("pos") + 1).alias("rest"),
    )
    before = Window.partitionBy("conv_id").orderBy("depth")
    return run.select("*", F.lag("p1").over(before).alias("q1"), F.lag("p2").over(before).alias("q2"))


def nodes_of(rows: DataFrame) -> DataFrame:
    """The nodes of prefix rows, with their parents' names, own values and subtrees' weights."""
    n_rows = rows.count()
    nodes = stored(
        rows.groupBy(*NODE).agg(
            F.min("conv_id").alias("conv_id"),
            F.count("*").alias("n_convs"),
            F.sum("rest").alias("weight"),
            *[F.max(c).alias(c) for c in ("bytes", "q1", "q2")],
        ),
        "nodes",
    )
    counted = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2"))
    nodes = nodes.join(counted.agg(F.count("*").alias("n_children")), NODE, "left").fillna(0, ["n_children"])
    nodes = stored(
        nodes.withColumn("n_leaves", (F.col("n_children") == 0).cast("long")).withColumn(
            "saved_tokens", (F.col("n_convs") - 1) * F.coalesce("bytes", F.lit(0))
        ),
        "nodes",
    )
    parents = nodes.filter("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("n")
    )
    return stored(left_join(nodes, stored(parents, "parents"), ["depth", "q1", "q2"], "n", n_rows), "nodes")


def ends_of(rows: DataFrame) -> DataFrame:
    """(depth, p1, p2, ends_sha256) of each node at which conversations end: their ids, ascending."""
    ends = rows.filter("rest = 1").select(*NODE, "conv_id").repartition("p1", "p2", "depth").sortWithinPartitions(*NODE, "conv_id")
    ship(rows.sparkSession)
    return ends.mapInPandas(hash_ends, "depth long, p1 long, p2 long, ends_sha256 string")


# --- rollup ---------------------------------------------------------------------------------


def subtree_totals(nodes: DataFrame, rows: DataFrame, limit: int) -> DataFrame:
    """(conv_id, depth, n_leaves, saved_tokens) summed over the subtree of each node."""
    spark = nodes.sparkSession
    ship(spark)
    nodes = nodes.select(*NODE, "conv_id", "parent_conv_id", "weight", *VALUES, F.col("n_convs").alias("n"))
    rows = rows.select("conv_id", *NODE)
    finished: list[DataFrame] = []
    while True:
        heavy = F.col("weight") > limit
        n_rows, n_light, n_heavy = nodes.agg(
            F.coalesce(F.sum("n"), F.lit(0)), F.count_if(~heavy), F.count_if(heavy)
        ).first()
        above = stored(nodes.filter(heavy).select(*NODE, F.lit(True).alias("heavy"), "n"), "above")
        marked = stored(left_join(rows, above, NODE, "n", n_rows), "marked")
        # Weights fall along a conversation: its first light prefix is the top of a component.
        tops = marked.groupBy("conv_id").agg(
            F.min(F.when(F.col("heavy").isNull(), F.struct("depth", "p1", "p2"))).alias("top"), F.count_if("heavy").alias("n_heavy")
        )
        bucket = F.pmod(F.xxhash64("top.p1", "top.p2"), F.lit(max(1, -(-n_light // limit)))).cast("int")
        light = nodes.filter(~heavy).join(tops.select("conv_id", "top"), "conv_id")
        dealt = light.select("conv_id", "depth", "parent_conv_id", "weight", *VALUES, F.col("top.depth").alias("top_depth"), bucket.alias("bucket"))
        done = stored(dealt.groupBy("bucket").applyInPandas(roll_group, DONE), "done")
        finished.append(done.select("conv_id", "depth", *VALUES))
        if not n_heavy:
            break
        up = done.filter("is_top").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
        handed = up.agg(*[F.sum(v).alias(f"up_{v}") for v in VALUES])
        # What is left: heavy nodes, and the heavy prefixes of the conversations that name one.
        left = stored(nodes.filter(heavy).join(handed, ["conv_id", "depth"], "left"), "left")
        named = left.select("conv_id").distinct()
        own = tops.filter("n_heavy > 0").select("conv_id", "n_heavy").join(named, "conv_id", "left_semi")
        rest = stored(marked.filter("heavy").drop("heavy").join(own, "conv_id"), "rows")
        # Depths count from 0, so the last heavy prefix has the depth n_heavy - 1.
        weights = rest.groupBy(*NODE).agg(F.sum(F.col("n_heavy") - F.col("depth")).alias("weight"), F.count("*").alias("n"))
        total = [(F.col(v) + F.coalesce(f"up_{v}", F.lit(0))).alias(v) for v in VALUES]
        nodes = left.select(*NODE, "conv_id", "parent_conv_id", *total).join(weights, NODE)
        nodes, rows = stored(nodes, "nodes"), rest.select("conv_id", *NODE)
    out = finished[0]
    for more in finished[1:]:
        out = out.unionByName(more)
    return out


def trie(turns: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The nodes of conversations given as ``prefixes`` takes them."""
    rows = stored(prefixes(turns), "prefixes")
    nodes = nodes_of(rows)
    totals = subtree_totals(nodes, rows, limit)
    found = nodes.drop(*VALUES).join(totals, ["conv_id", "depth"]).join(ends_of(rows), NODE, "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", *VALUES, F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256")
    )


def with_root(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """``turns`` and, of every conversation of (conv_id), the place before its first turn."""
    none = convs.select("conv_id", F.lit(0).cast("long").alias("pos"), *[F.lit(None).cast("long").alias(c) for c in ("bytes", "h1", "h2")])
    return turns.select("conv_id", "pos", "bytes", "h1", "h2").unionByName(none)


def conversation_trie(conversations: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The nodes of the conversations of (conv_id, turn, role, text) rows."""
    turns = stored(numbered_turns(conversations), "turns")
    return trie(with_root(turns, turns.filter("pos = 1")), limit)


# --- the query ------------------------------------------------------------------------------


def rebuilt(turns: DataFrame) -> DataFrame:
    """Every conversation c with its first h turns, h = crc32(c) % 9, replaced by those of conversation c - c % 5."""
    cut = (F.crc32(F.col("conv_id").cast("string")) % 9).alias("h")
    lengths = turns.groupBy("conv_id").agg(F.max("pos").alias("len"))
    convs = lengths.select("conv_id", (F.col("conv_id") - F.col("conv_id") % 5).alias("base"), cut)
    base = lengths.select(F.col("conv_id").alias("base"), F.col("len").alias("base_len"))
    convs = stored(convs.join(base, "base", "left").withColumn("k", F.least("h", F.coalesce("base_len", F.lit(0)))), "convs")
    place = ["bytes", "h1", "h2"]
    rest = turns.join(convs.select("conv_id", "h", "k"), "conv_id").filter("pos > h")
    rest = rest.select("conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), *place)
    first = turns.filter("pos <= 8").withColumnRenamed("conv_id", "base").join(convs.select("conv_id", "base", "h"), "base").filter("pos <= h")
    return with_root(first.select("conv_id", "pos", *place).unionByName(rest), convs)


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return trie(rebuilt(stored(numbered_turns(table(spark, sf_dir, "conversations")), "turns")))


def _crc32(number: str) -> str:
    """DuckDB SQL for crc32 of a number's decimal text: each byte, then eight shifts."""
    steps = f"list_prepend(4294967295, flatten(list_transform(string_split({number}::VARCHAR, ''), lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])))"
    shift = "CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END"
    return f"xor(list_reduce({steps}, lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE {shift} END), 4294967295)"


_SQL = f"""
WITH src AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS said_by, coalesce(text, '') AS said FROM conversations WHERE conv_id IS NOT NULL),
conv AS (
  SELECT c, list({{'r': said_by, 't': said}} ORDER BY turn NULLS FIRST, said_by, said) AS turns, {_crc32("c")} % 9 AS h
  FROM src GROUP BY c),
rebuilt AS (
  SELECT a.c, list_concat(coalesce(b.turns[1:a.h], []), a.turns[a.h + 1:]) AS path
  FROM conv a LEFT JOIN conv b ON b.c = a.c - a.c % 5),
pre AS (
  SELECT c, d, path[1:d] AS node, len(path) AS n FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM rebuilt)),
node AS (
  SELECT d, node, min(c) AS conv_id, count(*) AS n_convs, string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d) AS ends
  FROM pre GROUP BY d, node),
linked AS (
  SELECT x.*, p.conv_id AS parent_conv_id FROM node x LEFT JOIN node p ON p.d = x.d - 1 AND p.node = x.node[1:x.d - 1]),
kids AS (SELECT parent_conv_id, d - 1 AS d, count(*) AS n FROM linked WHERE d > 0 GROUP BY ALL),
own AS (
  SELECT l.*, coalesce(k.n, 0) AS n_children, CASE WHEN k.n IS NULL THEN 1 ELSE 0 END AS leaf,
         CASE WHEN l.d = 0 THEN 0 ELSE (l.n_convs - 1) * octet_length(encode(l.node[l.d].t)) END AS saved
  FROM linked l LEFT JOIN kids k ON k.parent_conv_id = l.conv_id AND k.d = l.d),
under AS (
  SELECT node[1:e] AS node, e AS d, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT *, unnest(range(d + 1)) AS e FROM own) GROUP BY ALL)
SELECT o.conv_id, o.d::BIGINT AS depth, o.parent_conv_id, o.n_convs, o.n_children, u.n_leaves::BIGINT AS n_leaves,
       u.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(o.ends, '')) AS ends_sha256
FROM own o JOIN under u ON u.d = o.d AND u.node = o.node"""

QUERIES = {"op12_prefix_trie": op12_prefix_trie}
ORACLES = {"op12_prefix_trie": _SQL}
