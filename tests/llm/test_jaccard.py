import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketry.llm import components as c
from docketry.llm import shingles as s
from docketry.llm import vertical_jaccard as v
from tests.llm import cases


def near_copies(seed: int = 4) -> list[tuple]:
    """Chains and stars of near copies around the threshold, and a passage that many documents share."""
    rng = random.Random(seed)
    rows, n = [], 0
    passage = cases.prose(rng, 60, cases.ENGLISH).split()
    for group in range(25):
        words = cases.prose(rng, rng.choice([6, 20, 60, 95, 130, 300]), cases.ENGLISH).split()
        if group % 4 == 0:
            words += passage
        for _ in range(rng.randint(1, 8)):
            own = list(words)
            for _ in range(rng.randint(0, 1 + len(own) // 30)):
                own[rng.randrange(len(own))] = rng.choice(cases.ENGLISH)
            rows.append(cases.row(n, " ".join(own), "en"))
            n += 1
            if rng.random() < 0.5:
                words = own  # a chain: later copies differ from earlier ones
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def copies(spark, tmp_path_factory):
    rows = near_copies() + cases.documents(40)
    path = str(tmp_path_factory.mktemp("copies") / "documents.parquet")
    spark.createDataFrame(rows, cases.SCHEMA).repartition(4).write.parquet(path)
    return rows, spark.read.parquet(path)


def test_shingles_are_the_distinct_windows():
    texts = [r[1] for r in near_copies()] + [None, "", " ", "a", "A", "a b c d", "a b c d e", "x " * 9, "é É\x85b\xa0c"]
    own = list(s.Shingler().sets(texts))
    plain = [cases.shingles(t) for t in texts]
    assert [len(x) for x in own] == [len(x) for x in plain]
    for i in range(len(texts)):
        for j in range(i):
            assert len(np.intersect1d(own[i], own[j])) == len(plain[i] & plain[j])
    assert [x.tolist() for x in s.Shingler().sets(texts[:3])] == [x.tolist() for x in own[:3]]


def test_passes_do_not_change_sets(monkeypatch):
    texts = [r[1] for r in near_copies()]
    whole = [x.tolist() for x in s.Shingler().sets(texts)]
    monkeypatch.setattr(s, "PASS_BYTES", 10)
    assert [x.tolist() for x in s.Shingler().sets(texts)] == whole


def test_blocks_round_trip():
    low = np.array([0, 0, 5, 70_000, 2**32 - 1], np.uint32)
    place = np.array([1, v.SHARED, 3, 0, 9])
    keys, places = v.unpack_block(*v.pack_block(low, place))
    assert keys.tolist() == low.tolist() and places.tolist() == place.tolist()


def test_components_against_all_pairs(spark, copies):
    rows, docs = copies
    found = [tuple(r) for r in v.similar_components(docs).drop("key").collect()]
    assert sorted(found, key=str) == sorted(cases.plain_components(rows), key=str)


def test_small_batches_and_no_single_rounds(spark, copies, monkeypatch):
    """Many batches, every shingle counted over half of the order, all pairs in the last step."""
    rows, docs = copies
    monkeypatch.setattr(v, "BATCH_ROWS", 7)
    monkeypatch.setattr(v, "SMALL", 12)
    monkeypatch.setattr(v, "FRAGMENT_BYTES", 4096)
    monkeypatch.setattr(v, "ROUNDS", 0)
    found = [tuple(r) for r in v.similar_components(docs).drop("key").collect()]
    assert sorted(found, key=str) == sorted(cases.plain_components(rows), key=str)


def test_blocks_of_common_shingles(spark, copies, monkeypatch):
    """Pairs are looked at in blocks of three, whatever the shingle."""
    rows, docs = copies
    monkeypatch.setattr(v, "LIGHT", 1)
    monkeypatch.setattr(v, "BLOCK", 3)
    monkeypatch.setattr(v, "ROUNDS", 1)
    found = [tuple(r) for r in v.similar_components(docs).drop("key").collect()]
    assert sorted(found, key=str) == sorted(cases.plain_components(rows), key=str)


def test_first_of_each_component_stays(spark, copies):
    rows, docs = copies
    kept = v.keep_first(docs)
    assert kept.columns == docs.columns
    wanted, seen = [], set()
    plain = cases.plain_components(rows)
    for r, (doc, n, component) in sorted(zip(rows, plain, strict=True), key=lambda x: (x[0][0] is None, x[0][0] or 0)):
        if doc is None or n == 0:
            wanted.append(doc)
        elif component == doc and component not in seen:
            seen.add(component)
            wanted.append(doc)
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(map(str, wanted))


def test_empty_tables(spark, no_docs):
    assert v.similar_components(no_docs).count() == 0
    assert v.keep_first(no_docs).count() == 0


def test_sieve_holds_every_id(spark):
    ids = spark.range(0, 5000).select((F.col("id") * 7).alias("doc_id"))
    bits = v.sieve(ids)
    assert ids.filter(~v.sieved(bits)).count() == 0
    assert spark.range(1_000_000, 1_010_000).select(F.col("id").alias("doc_id")).filter(v.sieved(bits)).count() < 100


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(60)] + [(500, 100 + i) for i in range(50)] + [(900, 901), (901, 902), (902, 900), (7, 7)]
    random.Random(1).shuffle(edges)
    found = {r["node"]: r["root"] for r in c.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {found[i] for i in range(61)} == {0}
    assert {found[i] for i in [500, *range(100, 150)]} == {100}
    assert {found[i] for i in (900, 901, 902)} == {900}
    assert c.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_merged_components_are_those_of_all_links(spark):
    rng = random.Random(9)
    every, roots = [], None
    for size in (40, 25, 0, 60):
        links = [tuple(sorted(rng.sample(range(150), 2))) for _ in range(size)]
        every += links
        roots = v.merged(roots, spark.createDataFrame(links, "a long, b long"))
        found = sorted(tuple(r) for r in roots.collect())
        assert found == sorted(tuple(r) for r in c.components(spark.createDataFrame(every, "u long, v long")).collect())


def test_sieve_is_as_told_bit_by_bit(spark, monkeypatch):
    monkeypatch.setattr(v, "SIEVE_BITS", 1 << 17)
    ids = spark.range(0, 40_000, 7).select(F.col("id").alias("doc_id"))
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(v.SIEVE_BITS)).alias("slot")
    held = {r["slot"] for r in ids.select(slot).collect()}
    bits = v.sieve(ids)
    rows = spark.range(50_000).select(F.col("id").alias("doc_id")).select(slot, v.sieved(bits).alias("maybe")).collect()
    assert all(r["maybe"] == (r["slot"] in held) for r in rows)
    none = v.sieve(ids.filter("doc_id < 0"))
    assert ids.filter(v.sieved(none)).count() == 0


def python_steps(df):
    """How many steps of one branch of the plan run Python row by row, at most; groups are made anew and so not counted."""
    plan = df._jdf.queryExecution().sparkPlan().toString()
    most, stack = 0, []
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-*"))
        stack = [x for x in stack if x[0] < depth]
        python = any(name in line.split("[")[0] for name in ("ArrowEvalPython", "MapInPandas", "BatchEvalPython"))
        stack.append((depth, python))
        most = max(most, sum(x[1] for x in stack))
    return most


def test_a_task_has_one_python_worker(spark, copies, monkeypatch):
    _, docs = copies
    assert python_steps(v.keep_first(docs)) == 1
    made = []
    real = v.stored
    monkeypatch.setattr(v, "stored", lambda df, name, *a: made.append(python_steps(df)) or real(df, name, *a))
    v.similar_components(docs).count()
    assert len(made) > 5 and max(made) == 1


def test_scans_of_texts_hold_few_rows(spark, docs):
    spark.conf.unset("spark.sql.parquet.columnarReaderBatchSize")
    v.similar_components(docs)
    assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 512
