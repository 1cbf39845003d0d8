import hashlib
import random
import zlib

import numpy as np
import pytest

from docketry.llm import prefix_trie as t
from tests.oracle import compare, connect

SCHEMA = "conv_id long, turn long, role string, text string, depth int, n int, weight double, p1 string"


def talks(seed=1, n=60):
    """Conversations over few texts, so that prefixes are shared; one very long; nulls, ties and repeated rows."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        if c % 11 == 7:
            continue
        for turn in range(rng.choice([1, 2, 4, 7, 12])):
            said = rng.choice(["a", "b", "", None]) if turn % 2 else "hello"
            rows.append((c, turn, "user" if turn % 2 == 0 else "assistant", said))
    rows += [(100, i, "user", "hello" if i == 0 else f"long {i}") for i in range(300)]
    rows += [(101, i, "user", "hello" if i == 0 else f"long {i}") for i in range(200)]
    rows += [(None, 0, "user", "nobody"), (102, None, None, None), (102, 1, "user", "x"), (102, 1, "user", "x"), (102, 1, "bot", "y")]
    rows += [(103, 0, "é\x00", "漢字"), (-7, 0, "user", "hello"), (-3, 0, "user", "hello")]
    rng.shuffle(rows)
    return rows


def plain(rows, rebuild=True):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9 if rebuild else 0
        base = c - int(np.fmod(c, 5))
        paths[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(paths[c]) == len(p))))
        parent = min(members[p[:-1]]) if p else None
        out.append((min(m), len(p), parent, len(m), len(children.get(p, [])), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("talks"))
    rows = [(*r, 1, 2, 3.0, "p") for r in talks()]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/conversations.parquet")
    return path


@pytest.mark.parametrize("limit", [3, 40, 50_000])
def test_query_against_plain(spark, folder, limit, monkeypatch):
    monkeypatch.setattr(t.trie, "__defaults__", (limit,))
    if limit == 3:
        # Paths are cut three nodes at a time, so the two long ones would take a hundred rounds.
        kept = spark.read.parquet(f"{folder}/conversations.parquet").filter("conv_id < 100 OR conv_id IS NULL OR conv_id > 101")
        found = t.trie(t.rebuilt(t.stored(t.numbered_turns(kept), "turns"))).collect()
        assert sorted(map(tuple, found), key=str) == plain([r for r in talks() if r[0] not in (100, 101)])
        return
    found = [tuple(r) for r in t.op12_prefix_trie(spark, folder).collect()]
    assert sorted(found, key=str) == plain(talks())


def test_given_conversations(spark, folder):
    docs = spark.read.parquet(f"{folder}/conversations.parquet")
    found = [tuple(r) for r in t.conversation_trie(docs, 60).collect()]
    assert sorted(found, key=str) == plain(talks(), rebuild=False)


def test_query_against_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    assert compare(spark, connect(sf_dir), t.op12_prefix_trie, t._SQL, sf_dir) is None


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert t.conversation_trie(none).count() == 0


@pytest.mark.parametrize("shape", ["random", "path", "star", "forest", "caterpillar"])
def test_rollup_against_sums(shape):
    rng = np.random.default_rng(4)
    n = 400
    parent = {
        "random": lambda i: rng.integers(0, i),
        "path": lambda i: i - 1,
        "star": lambda i: 0,
        "forest": lambda i: -1 if i % 9 == 0 else rng.integers(i - i % 9, i),
        "caterpillar": lambda i: i - 1 if i % 2 else max(i - 2, 0),
    }[shape]
    parent = np.array([-1] + [int(parent(i)) for i in range(1, n)])
    own = rng.integers(1, 9, n)
    values = rng.integers(-50, 50, (n, 2))
    weight, sums = own.copy(), values.copy()
    for i in range(n - 1, 0, -1):
        if parent[i] >= 0:
            weight[parent[i]] += weight[i]
            sums[parent[i]] += sums[i]
    shuffled = rng.permutation(n)
    back = np.empty(n, np.int64)
    back[shuffled] = np.arange(n)
    moved = np.where(parent[shuffled] >= 0, back[parent[shuffled]], -1)
    assert np.array_equal(t.rollup(moved, weight[shuffled], values[shuffled]), sums[shuffled])
