import random

import numpy as np
import pytest
import xxhash

from docketry.llm import simhash_tiles as s
from docketry.llm.skew import left_join
from tests.llm import cases
from tests.llm.test_jaccard import near_copies


def plain_fingerprint(text):
    words = cases.WORD.findall((text or "").translate(cases.LOWER))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, radius=4):
    """(doc_id, fingerprint, component_id) of each row, every pair compared."""
    prints = [plain_fingerprint(r[1]) for r in rows]
    use = [i for i, r in enumerate(rows) if r[0] is not None]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in use:
        for j in use:
            if j < i and (prints[i] ^ prints[j]).bit_count() <= radius:
                parent[root(i)] = root(j)
    least = {}
    for i in use:
        least[root(i)] = min(rows[i][0], least.get(root(i), rows[i][0]))
    return [(r[0], f"{p:016x}", None if r[0] is None else least[root(i)]) for i, (r, p) in enumerate(zip(rows, prints, strict=True))]


@pytest.fixture(scope="module")
def copies(spark, tmp_path_factory):
    rows = near_copies(seed=14) + [r for r in cases.documents(60) if r[0] is None or r[0] > 400 or r[0] < 30]
    rows = [cases.row(5000 + i if r[0] is not None else None, r[1], "en") for i, r in enumerate(rows)]
    path = str(tmp_path_factory.mktemp("simhash"))
    spark.createDataFrame(rows, cases.SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    return rows, path


def test_query_against_all_pairs(spark, copies):
    rows, path = copies
    found = [tuple(r) for r in s.op13_simhash_tiles(spark, path).collect()]
    plain = plain_components(rows)
    assert sorted(found, key=str) == sorted(plain, key=str)
    assert 10 < len({r[2] for r in plain}) < len(rows) - 10


def test_many_tiles_give_the_same(spark, copies, monkeypatch):
    rows, path = copies
    monkeypatch.setattr(s, "TILE", 7)
    found = [tuple(r) for r in s.op13_simhash_tiles(spark, path).collect()]
    assert sorted(found, key=str) == sorted(plain_components(rows), key=str)


def numbers(seed, n=400):
    """Centres, near and not so near numbers, and the extremes."""
    rng = random.Random(seed)
    out = {0, 2**64 - 1, 1, 2**63}
    while len(out) < n:
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 6)):
            out.add(x)
            for _ in range(rng.randint(1, 7)):
                x ^= 1 << rng.randrange(64)
    return np.array(sorted(out), np.uint64)


def connected(u, v):
    groups = {}
    for a, b in zip(u.tolist(), v.tolist(), strict=True):
        x = groups.get(a, {a}) | groups.get(b, {b})
        for y in x:
            groups[y] = x
    return {frozenset(x) for x in groups.values()}


@pytest.mark.parametrize("block", [1, 100, 1 << 20])
def test_links_of_tiles_against_all_pairs(block, monkeypatch):
    monkeypatch.setattr(s, "BLOCK", block)
    own, rest = numbers(1), numbers(2)
    near = [(a, b) for a in own.tolist() for b in own.tolist() if a < b and (a ^ b).bit_count() <= 4]
    u, v = s.links(own, None)
    assert connected(u, v) == connected(*np.array(near, np.uint64).T)
    assert len(u) == sum(len(g) - 1 for g in connected(u, v))
    mixed = np.setdiff1d(np.concatenate([rest, own ^ np.uint64(5)]), own)
    near = [(a, b) for a in own.tolist() for b in mixed.tolist() if (a ^ b).bit_count() <= 4]
    assert connected(*s.links(own, mixed)) == connected(*np.array(near, np.uint64).T)


def test_a_dense_group_gives_a_forest(monkeypatch):
    monkeypatch.setattr(s, "BLOCK", 500)
    group = np.array([sum(1 << b for b in range(11) if k >> b & 1) for k in range(1 << 11)], np.uint64)
    u, v = s.links(group, None)
    assert len(u) == len(group) - 1 and len(connected(u, v)) == 1


def test_fingerprints():
    texts = [None, "", " \n", "One", "one two three", "A b C d", "a b c d e f g h", "é É x\x85y z", "x " * 300, "漢 字 \U0001f600 ok no"]
    assert [s.majority(s.shingle_hashes(t)) % 2**64 for t in texts] == [plain_fingerprint(t) for t in texts]


def test_long_hash_lists_are_added_up():
    hashes = np.random.default_rng(3).integers(0, 2**63, 200_001, dtype=np.uint64)
    hashes[100_000:] |= np.uint64(0xFF)
    assert s.majority(hashes) & 0xFF == 0xFF and s.majority(hashes) >= 0


def test_empty_table(spark, no_docs):
    assert s.similar_components(no_docs).count() == 0


def test_join_with_hot_keys(spark):
    rows = spark.createDataFrame([(i % 7 if i % 3 else 0, i) for i in range(300)] + [(None, 1000), (99, 1001)], "k int, v int")
    table = rows.filter("k IS NOT NULL AND k < 99").groupBy("k").count().selectExpr("k", "k * 10 AS ten", "count AS n")
    for total in (1, 302, 10**9):
        found = left_join(rows, table, ["k"], "n", total).collect()
        assert len(found) == 302
        assert all(r["ten"] == (None if r["k"] in (None, 99) else r["k"] * 10) for r in found)
