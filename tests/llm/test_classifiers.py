"""The three trained operators: recovered truth on held-out rows, and every awkward row with a defined result."""

import math

import numpy as np
import pytest

from docketry.llm import quality_qda as q
from docketry.llm import toxic_crf as t
from docketry.llm import zstd_language as z
from tests.llm import cases


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Enough labelled prose to learn from, with the awkward rows."""
    rows = cases.documents(600, seed=11)
    path = str(tmp_path_factory.mktemp("corpus") / "documents.parquet")
    spark.createDataFrame(rows, cases.SCHEMA).repartition(3).write.parquet(path)
    labels = spark.createDataFrame(cases.labels(rows), "doc_id long, quality int, toxic int")
    return rows, spark.read.parquet(path), labels


def sane(found, rows):
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in found) == sorted((r[0] is None, r[0] or 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and not math.isnan(r["score"]) for r in found)
    assert all(r["held_out"] is not None for r in found)


def held(found, want):
    own = [r for r in found if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 1000]
    assert len(own) > 50
    return sum(want(r) for r in own) / len(own)


def test_quality(spark, corpus, no_docs):
    rows, docs, labels = corpus
    found = q.classify(docs, labels).collect()
    sane(found, rows)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in found)
    assert held(found, lambda r: r["predicted"] == int(r["doc_id"] % 10 != 0)) > 0.97
    assert q.classify(no_docs, labels).count() == 0
    assert {r["score"] for r in q.classify(docs, labels.limit(0)).collect()} == {0.5}
    only = {r["score"] for r in q.classify(docs, labels.filter("quality = 1")).collect()}
    assert len(only) == 1 and 0.99 < only.pop() < 1


def test_discriminant_is_the_log_density_difference():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(200, 4)), rng.normal(size=(300, 4)) @ rng.normal(size=(4, 4)) + 1

    def moments(x):
        return q.Moments(len(x), x.sum(axis=0), x.T @ x)

    model = q.discriminant(moments(a), moments(b), 0.0, 0.0)

    def density(x, own):
        cov = np.cov(own.T)
        d = x - own.mean(axis=0)
        return -0.5 * (np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) + np.linalg.slogdet(cov)[1])

    # Log determinants are taken on the pooled scale; the difference of the two is the same.
    assert np.allclose(model.margin(a), density(a, b) - density(a, a) + np.log(300 / 200))
    merged = moments(a) + moments(b)
    assert np.allclose(merged.mean, np.vstack([a, b]).mean(axis=0))
    same = q.discriminant(moments(a), moments(b), 1.0, 0.0)
    assert np.allclose(same.factors[0], same.factors[1])


def test_language(spark, corpus, no_docs):
    rows, docs, _ = corpus
    found = z.identify(docs).collect()
    sane(found, rows)
    truth = {r[0]: r[2] for r in rows}
    assert held(found, lambda r: r["lang_pred"] == truth[r["doc_id"]]) > 0.98
    by_id = {r["doc_id"]: r for r in found}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["rejected"] and by_id[i]["score"] == 0 for i in (1000, 1001, 1002, 1006))
    assert {r["lang_pred"] for r in found} <= {"en", "de", "und"}
    kept = z.keep_identified(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in found if not r["rejected"]}
    assert z.identify(no_docs).count() == 0
    unlabelled = docs.drop("lang").selectExpr("*", "CAST(NULL AS string) AS lang")
    assert {r["lang_pred"] for r in z.identify(unlabelled).collect()} == {"und"}
    single = z.Models((("en", b"some words"),), 3)
    assert single.answer("words")[:2] == ("en", 1.0)
    tie = z.Models((("aa", b"same"), ("bb", b"same")), 3).answer("something else")
    assert tie[0] == "aa" and tie[3]


def test_dictionaries_read_the_whole_text(spark):
    header, schema = "all rights reserved by the author of this page " * 40, "doc_id long, text string, lang string"
    rows = [(i, header + f"größe straße{i} " * 400, "de") for i in range(40)]
    rows += [(100 + i, "и" * 300 + "ж" * 300 + "щ" * 300 + "ю" * 300, "ru") for i in range(3)]
    rows += [(200, "short text", "en"), (201, None, "en"), (202, "", "en"), (203, "漢字" * 300, "zh")]
    docs = spark.createDataFrame(rows, schema)
    found = z.learn_dictionaries(docs, z.F.lit(True))
    assert found["de"].count("straße".encode()) > 40 * 10 and b"rights reserved" in found["de"]
    # Letters of two bytes don't crowd out the text's last parts, and equal texts count once.
    assert {"и", "ж", "щ", "ю"} <= set(found["ru"].decode(errors="ignore")) and len(found["ru"]) <= z.SAMPLE_BYTES
    assert found["zh"].count(b"\n") == z.PIECES - 1 and len(found["zh"]) <= z.SAMPLE_BYTES
    assert found["en"].strip() == b"short text"
    assert all(len(x) <= z.DICTIONARY_BYTES for x in found.values())


def test_toxicity(spark, corpus, no_docs):
    rows, docs, labels = corpus
    found = t.classify(docs, labels).collect()
    sane(found, rows)
    assert held(found, lambda r: r["predicted"] == int(r["doc_id"] % 8 == 0)) > 0.98
    texts = {r[0]: r[1] for r in rows}
    spans = [texts[r["doc_id"]][s["start"] : s["end"]].lower() for r in found if r["doc_id"] is not None and r["doc_id"] < 1000 for s in r["spans"]]
    assert len(spans) > 200
    assert sum({"idiot", "moron", "scum"} >= set(x.replace(",", " ").split()) for x in spans) > 0.95 * len(spans)
    odd = next(r for r in found if r["doc_id"] == 1012)
    assert [texts[1012][s["start"] : s["end"]] for s in odd["spans"]] == ["idiot \u2028 idiot漢字"]
    kept = t.keep_clean(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["predicted"] == 0 for r in found)
    assert t.classify(no_docs, labels).count() == 0
    assert {r["score"] for r in t.classify(docs, labels.limit(0)).collect()} == {0.0}


def test_scores_follow_the_label_rate_not_the_sample(spark, corpus, monkeypatch):
    rows, docs, labels = corpus
    seen = []
    plain = t.fit_curve
    monkeypatch.setattr(t, "fit_curve", lambda x, y, *weight: seen.append((x, y, *weight)) or plain(x, y, *weight))
    docs, labels = docs.dropDuplicates(["doc_id"]), labels.filter("doc_id < 1000").distinct()
    given = [r["toxic"] for r in labels.filter(~t.held_out("doc_id", 4, 2)).collect()]
    monkeypatch.setattr(t, "CLEAN_DOCS", 60)
    monkeypatch.setattr(t, "TOXIC_DOCS", 50)
    model = t.fit(docs, labels)
    (x, y, weight), rate = seen[0], {c: max(1, given.count(c) / n) for c, n in ((0, 60), (1, 50))}
    assert rate[0] > 2 and np.allclose(weight, [rate[c] for c in y])
    # The curve's mean score is the weighted share of its rows, as of any logistic regression with an intercept.
    assert np.isclose(np.average(model.scores(x), weights=weight), np.average(y, weights=weight), atol=1e-3)
    monkeypatch.setattr(t, "MIN_LIFT", 99.0)
    assert np.isclose(t.fit(docs, labels), sum(given) / len(given))


def test_training_reads_all_sentences_with_a_term(spark):
    plain = " ".join(f"plain{i}" for i in range(40))
    toxic = ". ".join([f"You bad{i} one" for i in range(9)] + [plain])
    clean = "\n".join([plain] * 7 + [plain + " bad tooth"] + [plain] * 7)
    sample = spark.createDataFrame([(toxic, 1), (clean, 0), (None, 0), ("?!", 1)], "text string, label int")
    found = t.sentences(sample, {f"wbad{i}" for i in range(9)} | {"wbad"})
    held = [(words, list(tags)) for words, tags in found if "bad" in words]
    assert held == sorted([(f"you bad{i} one", [0, 1, 0]) for i in range(9)] + [(plain + " bad tooth", [0] * 42)])
    # No sentence is cut or joined to the next one.
    others = [(words, list(tags)) for words, tags in found if "bad" not in words]
    assert others == [(plain, [0] * 40)] * (1 + t.OTHER_SENTENCES)


def test_training_by_words_equals_training_by_tokens():
    words = ["a", "bad", "bad", "c", "d", "a", "bad"] * 4
    tags, lengths = np.array([0, 1, 1, 0, 0, 0, 1] * 4), np.array([4, 3] * 4)
    known = sorted(set(words))
    by_token = t.train(np.array([t.features(w) for w in words]), tags, lengths, 20)
    place = np.array([known.index(w) for w in words])
    by_word = t.train(np.array([t.features(w) for w in known]), tags, lengths, 20, place=place)
    assert all(np.allclose(x, y) for x, y in zip(by_token, by_word, strict=True))


def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(3)
    lengths = np.array([1, 4, 2, 6])
    weight = rng.normal(size=lengths.sum())
    trans, start = np.exp(rng.normal(size=(2, 2))), 0.3
    first = np.cumsum(lengths) - lengths
    ahead, back = t.forward_backward(weight, t.Sequences.of(first, lengths), trans, start)
    odds = ahead * back
    for s, n in zip(first, lengths, strict=True):
        on, total = np.zeros(n), 0.0
        for path in range(1 << n):
            tags = [path >> i & 1 for i in range(n)]
            p = np.exp(start * tags[0] + sum(w for w, tag in zip(weight[s : s + n], tags, strict=True) if tag))
            p *= np.prod([trans[a, b] for a, b in zip(tags, tags[1:], strict=False)])
            total += p
            on += p * np.array(tags)
        assert np.allclose(odds[s : s + n] / (1 + odds[s : s + n]), on / total)


def test_training_raises_the_likelihood():
    words = [["a", "bad", "bad", "c"], ["d", "a", "c"], ["bad", "a"]] * 5
    tags = [[0, 1, 1, 0], [0, 0, 0], [1, 0]] * 5
    tokens = np.array([t.features(w) for own in words for w in own])
    weights, trans, start = t.train(tokens, np.array(sum(tags, [])), np.array([len(w) for w in words]))
    model = t.Tagger(weights, trans, start)
    marginal, sizes = model.marginals(["a bad, bad c. d", None, ""], {})
    assert sizes.tolist() == [5, 0, 0]
    assert (marginal >= 0.5).tolist() == [False, True, True, False, False]
    assert t.spans_of("a bad, bad c. d", marginal) == [(2, 10)]


def test_offsets_with_letters_that_grow():
    text = "İİ idiot"
    assert t.spans_of(text, np.array([0.0] * (len(t.parts_of(text)) - 1) + [1.0])) == [(3, 8)]
