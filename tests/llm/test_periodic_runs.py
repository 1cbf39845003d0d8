import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from docketry.llm import periodic_runs as p
from tests.llm import cases


def plain_runs(words):
    """Every period, every stretch on which words that far apart agree; only smallest periods stay."""
    n, found = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            own = words[i : i + length]
            if length >= max(24, 3 * q) and not any(
                all(own[k] == own[k + r] for k in range(length - r)) for r in range(1, q)
            ):
                found.append((i, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_query(doc_id, text):
    words = cases.WORD.findall(text or "")
    if doc_id is not None and words:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g, n = h // 10, len(words)
            a = g % n
            period = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % period] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)]
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], *sha)


def periodic(seed):
    """Texts over few words, powers of short stretches among them, some with a word changed."""
    rng = random.Random(seed)
    out = []
    for _ in range(60):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += [rng.choice("abcd") for _ in range(rng.randint(0, 20))]
            unit = [rng.choice("ab") for _ in range(rng.randint(1, 12))]
            words += (unit * 40)[: rng.randint(0, 90)]
        if words and rng.random() < 0.5:
            words[rng.randrange(len(words))] = "x"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_runs_against_every_period(seed, monkeypatch):
    texts = periodic(seed)
    found = [[tuple(r.values()) for r in runs] for _, runs, _ in p.judge(texts)]
    assert found == [plain_runs(t.split()) for t in texts]
    monkeypatch.setattr(p, "PASS_BYTES", 50)
    again = [row for part in p.passes(texts) for row in p.judge(part)]
    assert [[tuple(r.values()) for r in runs] for _, runs, _ in again] == found


def test_long_runs_and_nested_ones():
    unit = "a a a b".split()
    texts = ["x " * 50_000, " ".join((unit * 7 + ["c"]) * 4), "a b " * 11 + "a", "a b " * 12, " ".join(map(str, range(5_000))) + " z" * 24]
    found = [[tuple(r.values()) for r in runs] for _, runs, _ in p.judge(texts)]
    assert found[0] == [(0, 50_000, 1)]
    assert found[1] == plain_runs(texts[1].split()) and len(found[1]) == 5
    assert found[2:] == [[], [(0, 24, 2)], [(5_000, 24, 1)]]


def test_proposals_need_no_extension():
    words = p.name_words([t.encode().split() for t in periodic(9)])
    for start, stop, period in p.proposals(words).tolist():
        assert (words[start:stop] == words[start + period : stop + period]).all()
        assert start == 0 or words[start - 1] != words[start - 1 + period]
        assert words[stop] != words[stop + period]
    assert np.array_equal(p.find_runs(words), np.unique(p.find_runs(words), axis=0)[np.argsort(p.find_runs(words)[:, 0], kind="stable")])


def test_query_against_plain(spark, tmp_path):
    rows = cases.documents(150, seed=8) + [cases.row(2000 + i, t, "en") for i, t in enumerate(periodic(5))]
    rows = [r for r in rows if len(cases.WORD.findall(r[1] or "")) < 3_000]
    spark.createDataFrame(rows, cases.SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = [tuple(r) for r in p.op11_periodic_runs(spark, str(tmp_path)).collect()]
    plain = [plain_query(r[0], r[1]) for r in rows]
    assert sorted(found, key=str) == sorted(plain, key=str)
    assert sum(r[1] > 0 for r in plain) > 30


def test_collapsed_texts_and_long_ones(spark, docs, no_docs):
    found = {r["doc_id"]: r for r in p.collapse(docs).collect()}
    assert found[1000]["n_words"] == 0 and found[1000]["runs"] == [] and found[1000]["collapsed"] == ""
    assert found[1007]["n_words"] == 20_000 and found[1007]["runs"] == []
    assert found[1004]["collapsed"] == "Two words"
    assert p.collapse(no_docs).count() == 0
    assert p.collapse(no_docs).columns == ["doc_id", "n_words", "runs", "collapsed"]
