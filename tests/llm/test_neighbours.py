import numpy as np
import pytest

from docketry.llm import learned_partitions as lp

SCHEMA = "vec_id long, embedding array<float>, label int, key int, v int, score double, part int"


def plain(rows, top, every=20):
    """Exact neighbours of the rows that take part."""
    good = {}
    sizes = {}
    for i, x in rows:
        if i is None or x is None or any(a is None or not np.isfinite(a) for a in x) or not any(x):
            continue
        sizes[len(x)] = sizes.get(len(x), 0) + 1
        good[(i, tuple(np.float32(x).tolist()))] = None
    size = max(sizes, key=lambda s: (sizes[s], s), default=0)
    pairs = [(i, np.array(x)) for i, x in good if len(x) == size]
    out = {}
    for i, x in pairs:
        if i % every == 0:
            near = sorted((-float(x @ y), j) for j, y in pairs if j != i)[:top]
            out[i] = [(j, -s) for s, j in near]
    return out


def frame(spark, rows):
    floats = [(i, x if x is None else [a if a is None else float(a) for a in x]) for i, x in rows]
    return spark.createDataFrame([(i, x, 0, 1, 2, 0.5, 3) for i, x in floats], SCHEMA)


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


def test_awkward_vectors_are_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).round(2).tolist()) for i in range(100)]
    same = rows[0][1]
    rows += [(200 + i, same) for i in range(45)]  # one vector that many rows share, queries among them
    rows += [
        (300, None), (320, [0.0] * 6), (340, [1.0, None, 0, 0, 0, 0]), (360, [float("nan")] + [1.0] * 5),
        (380, [float("inf")] + [1.0] * 5), (400, [1.0, 2.0]), (420, []), (None, same), (1, rows[1][1]), (440, [-0.0, 1, 0, 0, 0, 0]),
    ]
    found, wanted = answers(lp.search(frame(spark, rows))), plain(rows, 20)
    assert set(found) == set(wanted)
    for q, near in wanted.items():
        assert [r for r, _, _ in found[q]] == list(range(1, len(near) + 1))
        assert np.allclose([s for _, _, s in found[q]], [s for _, s in near], atol=1e-12)
        assert [j for _, j, _ in found[q]] == [j for j, _ in near]


def test_few_and_no_rows(spark):
    rows = [(20, [1.0, 0.0]), (21, [0.5, 0.5]), (22, [0.5, 0.5])]
    assert answers(lp.search(frame(spark, rows))) == {20: [(1, 21, 0.5), (2, 22, 0.5)]}
    assert lp.search(frame(spark, rows[:1])).count() == 0
    assert lp.search(frame(spark, [])).count() == 0
    assert lp.search(frame(spark, [(20, None)])).count() == 0


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(24, 16))
    x = np.repeat(centres, 160, axis=0) + 0.4 * rng.normal(size=(3840, 16))
    return x[rng.permutation(len(x))]


def test_partitions_are_balanced_and_follow_the_graph(clustered):
    x = clustered[:1500]
    graph = lp.neighbours(x, x, 10, own=True)
    start = lp.bisect(x, 8)
    assert np.ptp(np.bincount(start)) <= 2
    part = lp.partition_graph(graph, start, 8)
    sizes = np.bincount(part, minlength=8)
    assert sizes.max() <= 1.1 * 1500 / 8 + 1 and sizes.min() >= 0.9 * 1500 / 8 - 1
    within = lambda p: (p[graph] == p[:, None]).mean()
    assert within(part) > within(start)


def test_recall_with_few_probes(spark, clustered):
    rows = [(i, x.tolist()) for i, x in enumerate(clustered)]
    router, parts, probes = lp.learn(np.float32(clustered)[:2000].astype(float), len(rows) * 4)
    assert parts >= 8 and probes <= parts // 2
    found, wanted = answers(lp.search(frame(spark, rows))), plain(rows, 20)
    hits = sum(len({j for _, j, _ in found[q]} & {j for j, _ in near}) for q, near in wanted.items())
    assert hits >= 0.9 * 20 * len(wanted)


def test_recall_on_the_given_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    found, wanted = answers(lp.search(table)), plain(rows, 20)
    hits = sum(len({j for _, j, _ in found[q]} & {j for j, _ in near}) for q, near in wanted.items())
    assert hits >= 0.9 * 20 * len(wanted)
