"""Exact n-gram Jaccard join by vertical partitioning: the global shingle order is cut into fragments, candidate pairs are
joined with the segments of their sets fragment by fragment, and the partial overlaps are summed per pair.

Two documents link when 100 * |A and B| >= 75 * |A or B| for their sets of five-word shingles (``shingles``). The
result names each document's component under these links. Pairs inside a large group of near copies are never
all made; no link that could change a component is lost.

1. *Shared shingles, fragment by fragment.* Every batch of documents sends each of its distinct shingles once to the
   fragment that its number falls in, with the place of the document if only one of the batch has it. A fragment
   answers how many shingles of a document other batches hold too; the counts are summed per document. A
   linked document shares at least ceil(0.75 n) of its n shingles, so one that shares fewer has no link. Documents
   of more than ``SMALL`` shingles send only the half of the order whose top bit is clear, and need as many fewer:
   at most n - ceil(0.75 n) shingles can be missing, wherever they are. Truncated numbers can only raise a count.
2. *Classes.* Of what remains, equal sets become one class; only a class's first document goes on.
3. *Order.* Exact counts over the remaining sets give the global order, rare shingles first, equal ones by number;
   ``PIVOTS`` cut it into fragments.
4. *Candidates.* Linked sets share a shingle among the first n - ceil(0.75 n) + 1 of each (prefix). First every
   class meets one neighbour only: of each prefix shingle the class with the lowest hash, and of these the most
   frequent one. Links found join classes into components. Then all pairs *between* components that share
   a prefix shingle are candidates, found over (shingle, component) rows; if they are many, another
   round with other neighbours comes before. Large groups are looked at in blocks, at first for the likeliest links only;
   no pair is made that a bound rules out. Pairs within a component need no look: they can't change it. Sizes, places,
   the lengths of the segments and small bit tables bound the overlap before a pair is made.
5. *Overlaps.* A set is stored as rows (node, fragment, segment). Each candidate pair meets the two segments of every
   fragment that both sets have; the partial overlaps are counted there and summed per pair, and the sum decides.

Defined results: a null or empty text and one without words have an empty set and no link; a row without id is returned
with its set's size and a null component. Rows that share an id are judged one by one; repeated rows link like
any others. ``docs`` has to come in a repeatable order, as a table scan does: batches are numbered. An empty table gives
an empty result; columns of other names are not looked at. Work is cut by text bytes, so a very long text is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import arrow_udf, byte_slices, ship, small_batches, stored, table
from docketry.llm.components import components
from docketry.llm.shingles import Shingler, set_key

#: Similarity in percent.
PERCENT = 75
#: Sets up to this size are counted over the whole order, larger ones over half of it.
SMALL = 96
#: Text bytes for each fragment of step 1.
FRAGMENT_BYTES = 8 << 20
#: Where step 3 cuts the order (count, and the shingle's bits after the point): most shingles that two sets share are
#: shared by just two or three.
PIVOTS = (2.25, 2.5, 2.75, 3.0, 4.0, 8.0, 32.0)
#: Another round of single neighbours comes while pairs between components outnumber prefix rows so many times.
PAIRS_PER_ROW = 4
ROUNDS = 4
#: Rows and text bytes of a batch, which bound a task's memory; places in it have 16 bits.
BATCH_ROWS = 4_000
BATCH_BYTES = 4 << 20
SHARED = 0xFFFF
#: Bits of the table of a set's shared shingles that bounds what two sets lack of each other.
TABLE_BITS = 4096
#: A shingle of up to so many prefixes makes its pairs in a join, one of more in blocks of so many.
LIGHT = 32
BLOCK = 256
#: Bits of the table that tells most rows apart without a join (1 MiB, whatever the data).
SIEVE_BITS = 1 << 23


def spare(n: np.ndarray | int) -> np.ndarray | int:
    """Shingles of a set of n that a linked one may lack: n - ceil(0.75 n)."""
    return n - -(-PERCENT * n // 100)


# --- step 1 ---------------------------------------------------------------------------------


def pack_block(low: np.ndarray, place: np.ndarray) -> tuple[bytes, bytes]:
    """Ascending 32-bit numbers as differences, low halves before high ones (which compress), and the places."""
    step = np.diff(low, prepend=np.uint32(0)).astype("<u4").view("<u2")
    return step[0::2].tobytes() + step[1::2].tobytes(), place.astype("<u2").tobytes()


def unpack_block(keys: bytes, places: bytes) -> tuple[np.ndarray, np.ndarray]:
    halves = np.frombuffer(keys, "<u2")
    n = len(halves) // 2
    step = halves[:n].astype(np.uint32) | (halves[n:].astype(np.uint32) << np.uint32(16))
    return np.cumsum(step, dtype=np.uint32), np.frombuffer(places, "<u2")


SENT_SCHEMA = "fragment int, uid long, ids array<string>, body binary, keys binary, places binary"
ANSWER_SCHEMA = "uid long, ids array<string>, body binary, places binary"
SHARED_SCHEMA = "id string, n long, key binary, need long, cnt long"


def batch_rows(ids: list, sets: list[np.ndarray], uid: int, fragments: int) -> list[tuple]:
    """Rows of one batch: its documents (ids; sizes, needs, what the batch itself shares, and keys), and a block of
    shingles for each fragment."""
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    place = np.repeat(np.arange(len(sets)), size)
    low_half = (flat >> np.uint64(63)) == 0
    # A set of up to SMALL may link to one of SMALL / 0.75, so those send all they have as well.
    sent = low_half | (size[place] * PERCENT <= 100 * SMALL)
    told = np.where(size <= SMALL, size, np.bincount(place[low_half], minlength=len(sets)))
    need = told - spare(size)
    flat, place = flat[sent], place[sent]
    order = np.argsort(flat, kind="stable")
    flat, place = flat[order], place[order]
    new = np.r_[True, flat[1:] != flat[:-1]] if len(flat) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    count = np.diff(np.r_[starts, len(flat)])
    within = np.bincount(place[np.repeat(count > 1, count)], minlength=len(sets))
    numbers = np.stack([size, need, within]).astype("<i8").tobytes()
    out = [(uid % fragments, uid, ids, numbers + b"".join(map(set_key, sets)), None, None)]
    number, owner = flat[starts], np.where(count > 1, SHARED, place[starts])
    fragment = ((number >> np.uint64(32)) % np.uint64(fragments)).astype(np.int64)
    low = (number & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    order = np.lexsort((low, fragment))
    fragment, low, owner = fragment[order], low[order], owner[order]
    cuts = np.r_[0, np.flatnonzero(fragment[1:] != fragment[:-1]) + 1, len(fragment)]
    for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if e > s:
            out.append((int(fragment[s]), uid, None, None, *pack_block(low[s:e], owner[s:e])))
    return out


def answer(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one fragment: its batches' documents as they are, and for each batch how many shingles of each of its
    places other batches have, as one row."""
    is_block = rows["keys"].notna()
    own = rows.loc[~is_block, ["uid", "ids", "body", "places"]]
    blocks = rows.loc[is_block, ["uid", "keys", "places"]]
    if not len(blocks):
        return own
    parts = [unpack_block(k, p) for k, p in zip(blocks["keys"], blocks["places"], strict=True)]
    number = np.concatenate([p[0] for p in parts])
    place = np.concatenate([p[1] for p in parts])
    block = np.repeat(np.arange(len(parts), dtype=np.uint32), [len(p[0]) for p in parts])
    del parts
    order = np.argsort(number, kind="stable")
    number = number[order]
    same = number[1:] == number[:-1]
    met = np.zeros(len(number), bool)
    met[order] = np.r_[False, same] | np.r_[same, False]
    del order, number, same
    met &= place != SHARED
    where, counts = np.unique(block[met].astype(np.int64) * (SHARED + 1) + place[met], return_counts=True)
    cuts = np.searchsorted(where, np.arange(len(blocks) + 1) * (SHARED + 1))
    found = [
        (uid, None, counts[s:e].astype("<u4").tobytes(), (where[s:e] % (SHARED + 1)).astype("<u2").tobytes())
        for uid, s, e in zip(blocks["uid"], cuts[:-1], cuts[1:], strict=True)
        if e > s
    ]
    return pd.concat([own, pd.DataFrame(found, columns=own.columns)], ignore_index=True)


def sum_answers(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one batch: its documents with the counts of all fragments added up."""
    is_docs = rows["ids"].notna()
    docs = rows[is_docs].iloc[0]
    n = len(docs["ids"])
    size, need, cnt = np.frombuffer(docs["body"], "<i8", 3 * n).reshape(3, n)
    cnt, keys = cnt.copy(), docs["body"][24 * n :]
    for body, places in zip(rows.loc[~is_docs, "body"], rows.loc[~is_docs, "places"], strict=True):
        # A place comes once in a row.
        cnt[np.frombuffer(places, "<u2")] += np.frombuffer(body, "<u4")
    each = [keys[16 * i : 16 * i + 16] for i in range(n)]
    return pd.DataFrame({"id": docs["ids"], "n": size, "key": each, "need": need, "cnt": cnt})


def slices(ids: list, texts: list) -> Iterator[tuple[list, list]]:
    """Both lists in batches."""
    at = 0
    for part in byte_slices(texts, BATCH_BYTES):
        for cut in range(0, len(part), BATCH_ROWS):
            own = part[cut : cut + BATCH_ROWS]
            yield ids[at : at + len(own)], own
            at += len(own)


def shared_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, n, key, need, cnt) of each row of (doc_id, text): set size, set key, shingles that a link demands
    others to hold, and shingles that others hold."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    fragments = max(1, -(-total // FRAGMENT_BYTES))

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler()
        uid = TaskContext.get().partitionId() << 32
        for batch in batches:
            for ids, texts in slices(batch["id"].tolist(), batch["text"].tolist()):
                rows = batch_rows(ids, list(shingler.sets(texts)), uid, fragments)
                yield pd.DataFrame(rows, columns=["fragment", "uid", "ids", "body", "keys", "places"])
                uid += 1

    ship(docs.sparkSession)
    sent = docs.select(F.col("doc_id").cast("string").alias("id"), "text").mapInPandas(send, SENT_SCHEMA)
    answers = sent.groupBy("fragment").applyInPandas(answer, ANSWER_SCHEMA)
    summed = answers.groupBy("uid").applyInPandas(sum_answers, SHARED_SCHEMA)
    return stored(summed.select(F.col("id").cast("long").alias("doc_id"), "n", "key", "need", "cnt"), "shared")


# --- a sieve of ids, to join texts without shuffling most of them ---------------------------


def sieve(ids: DataFrame) -> DataFrame:
    """One row (bits) with the hash of every id of (doc_id) in a bit table, as a map of its chunks of 4 KiB; its size is
    bounded, so it may be sent to all tasks."""
    # Spark numbers bits and chunks from 1.
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(SIEVE_BITS)) + 1
    chunks = (
        ids.select(slot.alias("slot"))
        .groupBy(F.bitmap_bucket_number("slot").alias("chunk"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    )
    return stored(chunks.agg(F.map_from_entries(F.collect_list(F.struct("chunk", "bits"))).alias("bits")), "sieve")


def sieved(bits: DataFrame) -> Column:
    """A column that is true for every id in the sieve, and for few others while the sieve is sparse. The rows hold texts,
    so no Python worker is asked: its task would keep the rows while they wait, and a second worker for the sets."""
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(SIEVE_BITS)) + 1
    place = F.bitmap_bit_position(slot)
    chunk = F.try_element_at(bits.scalar(), F.bitmap_bucket_number(slot))
    byte = F.substring(chunk, F.shiftright(place, 3).cast("int") + 1, F.lit(1))
    return F.coalesce(F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (place % 8).cast("int")) == 1, F.lit(False))


def with_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, n, shingles) of the sets that ``wanted`` (doc_id, key, node) names; more than once where rows are repeated."""
    near = docs.select("doc_id", "text").filter(sieved(sieve(wanted)))
    rows = near.join(wanted, "doc_id").select("text", "key", "node")

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler()
        for batch in batches:
            keys, nodes, at = batch["key"].tolist(), batch["node"].tolist(), 0
            for part in byte_slices(batch["text"].tolist()):
                kept = []
                for own in shingler.sets(part):
                    if set_key(own) == bytes(keys[at]):
                        kept.append((nodes[at], own.view(np.int64)))
                    at += 1
                yield pd.DataFrame(kept, columns=["node", "shingles"])

    ship(docs.sparkSession)
    made = rows.mapInPandas(make, "node long, shingles array<long>")
    return stored(made.select("node", F.size("shingles").alias("n"), "shingles"), "sets")


# --- steps 3 to 5 ---------------------------------------------------------------------------


def ordered_sets(sets: DataFrame) -> DataFrame:
    """(node, n, shared, segments, lengths, prefix): the shingles that other sets hold too, in the global order and by
    fragment, their number, and how many of them are in the prefix. Sets with an empty prefix have no link."""
    rows = sets.select("node", F.explode("shingles").alias("shingle"))
    counts = rows.groupBy("shingle").agg(F.count("*").alias("freq")).filter("freq > 1")
    known = rows.join(counts, "shingle").select("node", F.struct("freq", "shingle").alias("at"))
    # A repeated row brings its shingles again.
    gathered = known.groupBy("node").agg(F.array_sort(F.collect_set("at")).alias("at"))
    sizes = sets.groupBy("node").agg(F.max("n").alias("n"))
    # The order as a number: the count, and the shingle's place among those of one count.
    rank = lambda a: a["freq"] + (F.shiftrightunsigned(a["shingle"], 44) + F.lit(0.0)) / float(1 << 20)
    bounds = [0.0, *PIVOTS, float("inf")]
    spare_n = F.col("n") - F.ceil(F.col("n") * PERCENT / 100)

    def segment(low: float, high: float) -> Column:
        # The order is by fragment, within it by count and number: the same for every set.
        inside = F.filter("at", lambda a: (rank(a) >= low) & (rank(a) < high))
        return F.transform(inside, lambda a: a["shingle"])

    cut = F.array(*[segment(a, b) for a, b in zip(bounds, bounds[1:], strict=False)])
    return stored(
        gathered.join(sizes, "node").withColumn("segments", cut).select(
            "node",
            "n",
            F.size("at").alias("shared"),
            "segments",
            F.transform("segments", lambda x: F.size(x)).alias("lengths"),
            # Shingles that no other set holds come first in the order and take up places of the prefix.
            (spare_n + 1 - (F.col("n") - F.size("at"))).cast("int").alias("prefix"),
        ).filter("prefix > 0"),
        "ordered",
    )


def segments_of(nodes: DataFrame) -> DataFrame:
    """(node, n, fragment, segment): the vertical partitions, a row for each fragment in which a set has shingles."""
    rows = nodes.select("node", "n", F.posexplode("segments").alias("fragment", "segment"))
    return stored(rows.filter(F.size("segment") > 0), "segments")


def overlaps(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """Linked pairs (a, b) of candidate pairs: partial overlaps of each fragment, summed per pair."""

    def side(x: str) -> DataFrame:
        return segments.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), "fragment", F.col("segment").alias(f"s{x}"))

    met = pairs.join(side("a"), "a").join(side("b"), ["b", "fragment"])
    partial = met.select("a", "b", "na", "nb", F.size(F.array_intersect("sa", "sb")).alias("common"))
    summed = partial.groupBy("a", "b").agg(F.sum("common").alias("common"), F.first("na").alias("na"), F.first("nb").alias("nb"))
    return summed.filter(possible(F.col("common"), "na", "nb")).select("a", "b")


def possible(most: Column, n: str, m: str) -> Column:
    """Whether sets of n and m shingles link if they have so many in common."""
    return most * (100 + PERCENT) >= PERCENT * (F.col(n) + F.col(m))


def reach(n: Column, place: Column) -> Column:
    """75 times the largest size of a set that may have its first common shingle with one of n at this place of the
    whole order: n - place shingles are left to reach the overlap that the two sizes demand."""
    return 100 * n - (100 + PERCENT) * place


def near(a: str = "a", b: str = "b") -> Column:
    """Whether two sets can link whose common shingle lies at places pa and pb of the order: one such shingle is within
    reach of both, and what lies before the one place only meets what lies before the other, and so after it."""
    na, nb, pa, pb, ua, ub = (F.col(c + x) for c in ("n", "p", "u") for x in (a, b))
    most = F.least(pa - ua, pb - ub) + 1 + F.least(na - pa - 1, nb - pb - 1)
    within = (reach(na, pa) >= PERCENT * nb) & (reach(nb, pb) >= PERCENT * na)
    return within & possible(most, f"n{a}", f"n{b}")


def matching_segments(a: str = "a", b: str = "b") -> Column:
    """Whether the segments' lengths leave room for the overlap: a partial one is no longer than the shorter segment."""
    each = F.zip_with(f"lengths{a}", f"lengths{b}", lambda x, y: F.least(x, y))
    return possible(F.aggregate(each, F.lit(0), lambda total, part: total + part), f"n{a}", f"n{b}")


def bit_table(shingles: np.ndarray) -> bytes:
    """A bit for each shingle, by its low bits. A bit that one set has and another has not stands for at least one
    shingle that the other lacks."""
    bits = np.zeros(TABLE_BITS, bool)
    bits[shingles % TABLE_BITS] = True
    return np.packbits(bits).tobytes()


def block_pairs(rows: pd.DataFrame, best: bool = False) -> pd.DataFrame:
    """Pairs (a, b) of one shingle's prefixes, between two blocks or within one, that no bound rules out; or of those
    only each node's best one, by the largest overlap that the bit tables leave."""
    first = rows["own"].to_numpy() == rows["own"].min()
    one = first.all()
    sides = []
    for mask in (first, first if one else ~first):
        own = rows[mask]
        table = np.frombuffer(b"".join(own["bits"]), np.uint64).reshape(len(own), -1)
        sides.append((table, np.stack(own["lengths"].tolist()), *[own[c].to_numpy(np.int64) for c in ("node", "root", "n", "u", "p")]))
    (bits_a, len_a, a, root_a, na, ua, pa), (bits_b, len_b, b, root_b, nb, ub, pb) = sides
    ia, ib = np.nonzero((root_a[:, None] != root_b[None, :]) & ((a[:, None] < b[None, :]) if one else True))

    def still(most: np.ndarray) -> None:
        nonlocal ia, ib
        left = most * (100 + PERCENT) >= PERCENT * (na[ia] + nb[ib])
        ia, ib = ia[left], ib[left]

    still(np.minimum(pa[ia] - ua[ia], pb[ib] - ub[ib]) + 1 + np.minimum(na[ia] - pa[ia] - 1, nb[ib] - pb[ib] - 1))
    still(np.minimum(len_a[ia], len_b[ib]).sum(axis=1))
    both = np.empty(len(ia), np.int64)
    for at in range(0, len(ia), 4096):
        x, y = bits_a[ia[at : at + 4096]], bits_b[ib[at : at + 4096]]
        lack_b, lack_a = (np.bitwise_count(p & ~q).sum(axis=1, dtype=np.int64) for p, q in ((x, y), (y, x)))
        both[at : at + 4096] = np.minimum(len_a[ia[at : at + 4096]].sum(axis=1) - lack_b, len_b[ib[at : at + 4096]].sum(axis=1) - lack_a)
    if best and len(both):
        order = np.argsort(both, kind="stable")[::-1]
        first_of = [order[np.unique(x[order], return_index=True)[1]] for x in (ia, ib)]
        chosen = np.unique(np.concatenate(first_of))
        ia, ib, both = ia[chosen], ib[chosen], both[chosen]
    still(both)
    low, high = np.minimum(a[ia], b[ib]), np.maximum(a[ia], b[ib])
    return pd.DataFrame({"a": low, "b": high}).drop_duplicates()


def pairs_between(marked: DataFrame, nodes: DataFrame, best: bool = False) -> DataFrame:
    """Pairs of nodes of different components that share a prefix shingle and that no bound rules out; with ``best``,
    only some of them that are likely to link, so that fewer components are left for all others.

    Of a shingle in few prefixes, the pairs are made by a join, so they are in proportion to the rows. Those of a
    shingle that a large group of near copies shares are looked at in blocks, and only what the bounds leave is made.
    """
    by_shingle = marked.groupBy("shingle").agg(F.count("*").alias("c"), F.min("root").alias("low"), F.max("root").alias("high"))
    here = marked.join(by_shingle.filter("low < high").select("shingle", "c"), "shingle")
    here = stored(here.select("shingle", "node", "root", "n", "u", "p", "c"), "open")

    def side(x: str) -> DataFrame:
        return here.filter(F.col("c") <= LIGHT).select("shingle", F.col("node").alias(x), *[F.col(c).alias(c + x) for c in ("root", "n", "u", "p")])

    light = side("a").join(side("b"), "shingle").filter("a < b AND roota <> rootb").filter(near()).select("a", "b", "na", "nb").distinct()
    lengths = nodes.select("node", "lengths")
    for x in ("a", "b"):
        light = light.join(lengths.select(F.col("node").alias(x), F.col("lengths").alias(f"lengths{x}")), x)
    light = light.filter(matching_segments()).select("a", "b")

    @arrow_udf("binary")
    def table_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for sets in batches:
            yield pd.Series([bit_table(np.asarray(x, np.int64).view(np.uint64)) for x in sets], dtype=object)

    heavy = here.filter(F.col("c") > LIGHT)
    wanted = nodes.join(heavy.select("node").distinct(), "node", "left_semi")
    bounds = stored(wanted.select("node", "lengths", table_of(F.flatten("segments")).alias("bits")), "bounds")
    blocks = F.ceil(F.col("c") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    dealt = heavy.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.join(bounds, "node").withColumn("block", F.struct(F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")))
    ship(marked.sparkSession)
    found = dealt.drop("other", "c").groupBy("shingle", "block").applyInPandas(lambda rows: block_pairs(rows, best), "a long, b long")
    return found.distinct() if best else light.unionByName(found).distinct()


def link_components(sets: DataFrame) -> DataFrame:
    """(node, root) of every set that has a link; sets are (node, n, shingles)."""
    nodes = ordered_sets(sets)
    segments = segments_of(nodes)
    front = F.slice(F.flatten("segments"), F.lit(1), F.col("prefix"))
    # Places count from the start of the whole order: u shingles that no other set holds come first.
    prefix = nodes.select("node", "n", (F.col("n") - F.col("shared")).alias("u"), F.posexplode(front).alias("i", "shingle"))
    prefix = prefix.select("node", "n", "u", (F.col("u") + F.col("i")).alias("p"), "shingle")
    # A set that reaches not even the smallest one beside it can't link there.
    beside = prefix.groupBy("shingle").agg(F.min("n").alias("least_n"), F.count("*").alias("rows")).filter("rows > 1")
    prefix = prefix.join(beside, "shingle").filter(reach(F.col("n"), F.col("p")) >= PERCENT * F.col("least_n"))
    prefix = stored(prefix.select("node", "n", "u", "p", "shingle"), "prefix")

    roots = None
    marked = prefix.withColumn("root", F.col("node"))
    n_rows = prefix.count()
    last = None
    for turn in range(ROUNDS):
        # Pairs between components, counted without making them.
        by_root = marked.groupBy("shingle", "root").agg(F.count("*").alias("c"))
        by_shingle = by_root.groupBy("shingle").agg(F.sum("c").alias("c"), F.sum(F.col("c") * F.col("c")).alias("own"))
        open_pairs = by_shingle.agg(F.sum((F.col("c") * F.col("c") - F.col("own")) / 2)).first()[0] or 0
        if open_pairs == 0 or (turn > 0 and open_pairs <= PAIRS_PER_ROW * n_rows) or (last is not None and open_pairs > 0.9 * last):
            break
        last = open_pairs
        order = [F.xxhash64(c, F.lit(turn)).alias(f"h_{c}") for c in ("root", "node")]
        seat = F.struct(order[0], F.col("root").alias("rb"), order[1], *[F.col(c).alias(x) for c, x in (("node", "b"), ("n", "nb"), ("u", "ub"), ("p", "pb"))])
        first = marked.groupBy("shingle").agg(F.min(seat).alias("f")).select("shingle", *[f"f.{c}" for c in ("rb", "b", "nb", "ub", "pb")])
        own = marked.select("shingle", "root", *[F.col(c).alias(x) for c, x in (("node", "a"), ("n", "na"), ("u", "ua"), ("p", "pa"))])
        met = own.join(first, "shingle").filter((F.col("root") != F.col("rb")) & near())
        votes = met.groupBy("a", "b").agg(F.count("*").alias("votes"))
        best = votes.groupBy("a").agg(F.max(F.struct("votes", "b")).alias("f")).select("a", F.col("f.b").alias("b"))
        roots, marked = grow(roots, marked, overlaps(best, segments), prefix)
    # Of the groups that share common shingles, first the likely links, then all that is left between components.
    roots, marked = grow(roots, marked, overlaps(stored(pairs_between(marked, nodes, best=True), "pairs"), segments), prefix)
    last_links = stored(overlaps(stored(pairs_between(marked, nodes), "pairs"), segments), "links")
    return merged(roots, last_links)


def merged(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, root) after the stored ``links`` (a, b) have joined the components of ``roots``. Only their ends' roots are
    searched anew, so a later search is as large as its new links, not as all links so far."""
    if roots is None:
        return stored(components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "roots")
    for x, y in (("a", "u"), ("b", "v")):
        known = roots.select(F.col("node").alias(x), F.col("root").alias("known"))
        links = links.join(known, x, "left").withColumn(y, F.coalesce("known", x)).drop("known")
    joined = components(links.select("u", "v"))
    moved = roots.join(joined.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left")
    moved = moved.select("node", F.coalesce("to", "root").alias("root"))
    return stored(moved.unionByName(joined.join(roots, "node", "left_anti")), "roots")


def grow(roots: DataFrame | None, marked: DataFrame, found: DataFrame, prefix: DataFrame) -> tuple[DataFrame | None, DataFrame]:
    """The components after the links ``found``, and the prefix rows marked with their component."""
    links = stored(found, "links")
    if links.isEmpty():
        return roots, marked
    roots = merged(roots, links)
    marked = prefix.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return roots, stored(marked, "marked")


def similar_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, key) of each row; ``component_id`` is the smallest id reachable by links."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = shared_counts(docs)
    left = rows.filter("n > 0 AND cnt >= need AND doc_id IS NOT NULL")
    # Classes are numbered once, in the table that is stored.
    numbered = left.groupBy("key").agg(F.min("doc_id").alias("first_id")).withColumn("node", F.monotonically_increasing_id())
    classes = stored(numbered, "classes")
    sets = with_sets(docs, classes.select(F.col("first_id").alias("doc_id"), "key", "node"))
    roots = link_components(sets)
    named = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_key = named.join(smallest, "root").select("key", "component_id")
    out = rows.join(by_key, "key", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNull(), None).when(F.col("n") == 0, F.col("doc_id")).otherwise(F.coalesce("component_id", "doc_id")).alias("component_id"),
        "key",
    )
    return out


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are the first of their component (least id, then least set key; of rows equal in
    both, one). Rows without id or without words are kept. Texts that can't be concerned are not shuffled."""
    found = stored(similar_components(docs).filter("doc_id IS NOT NULL AND n_shingles > 0"), "found")
    first = found.groupBy("component_id").agg(F.min(F.struct("doc_id", "key")).alias("first")).select("first.*")
    rows = found.groupBy("doc_id", "key").agg(F.count("*").alias("rows"))
    judged = rows.join(first.withColumn("stays", F.lit(True)), ["doc_id", "key"], "left")
    concerned = stored(judged.filter("stays IS NULL OR rows > 1").select("doc_id").distinct(), "concerned")
    keepers = first.join(concerned, "doc_id", "left_semi")
    whole = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    marked = whole.withColumn("maybe", sieved(sieve(concerned)))
    clear = marked.filter("NOT maybe OR doc_id IS NULL").select("row.*")
    near = marked.filter("maybe AND doc_id IS NOT NULL")
    apart = near.join(concerned, "doc_id", "left_anti").select("row.*")

    @arrow_udf("binary")
    def key_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        shingler = Shingler()
        for texts in batches:
            yield pd.Series([set_key(s) if len(s) else b"" for s in shingler.sets(texts.tolist())], dtype=object)

    # Declared so, a key isn't made once more, by a second worker, for a filter that the join below would push under it.
    keyed = near.join(concerned, "doc_id", "left_semi").withColumn("key", key_of.asNondeterministic()(F.col("text")))
    wordless = keyed.filter(F.length("key") == 0).select("row.*")
    one = keyed.join(keepers, ["doc_id", "key"], "left_semi").dropDuplicates(["doc_id", "key"]).select("row.*")
    return clear.unionByName(apart).unionByName(wordless).unionByName(one)


def op8_vertical_jaccard(spark, sf_dir: str) -> DataFrame:
    return similar_components(table(spark, sf_dir, "documents")).drop("key")


QUERIES = {"op8_vertical_jaccard": op8_vertical_jaccard}
ORACLES: dict[str, str] = {}
