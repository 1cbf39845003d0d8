import math
import re
from collections import Counter

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from docketry.operators import features as FT
from docketry.schema import FeatureColumns
from docketry.session import materialise

TEXTS = ["Feu de rue, feu vert", "Éclairage de rue", "rue x y 12", "", None, "feu de rue feu de rue", "de"]


def grams(text):
    tokens = [t for t in re.findall(r"\w+", (text or "").lower()) if len(t) > 1]
    return tokens + [f"{a} {b}" for a, b in zip(tokens, tokens[1:])]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id bigint, t string")


def test_term_counts(docs):
    got = {(r["id"], r["term"]): r["tf"] for r in FT.term_counts(docs, "id", "t").collect()}
    assert got == {(i, g): n for i, t in enumerate(TEXTS) for g, n in Counter(grams(t)).items()}


def test_vocabulary_order_and_floor(docs):
    totals = FT.term_totals(FT.term_counts(docs, "id", "t"))
    total, df = Counter(), Counter()
    for text in TEXTS:
        total.update(grams(text))
        df.update(set(grams(text)))
    want = sorted((t for t in total if df[t] >= 2), key=lambda t: (-total[t], t))
    for size in (2, 3, 5):
        found = FT.vocabulary(totals, size, 2).collect()
        assert {(r["term"], r["total"], r["df"]) for r in found} == {(t, total[t], df[t]) for t in want[:size]}
    assert FT.vocabulary(totals, 10, 100).isEmpty()


def test_vector_equals_weights(docs):
    counts = FT.term_counts(docs, "id", "t")
    vocab = FT.vocabulary(FT.term_totals(counts), 4000, 2)
    n_rows = docs.agg(F.count(F.lit(1)))
    table = {(r["id"], r["term"]): r["weight"] for r in FT.tfidf_weights(counts, vocab, n_rows, "id").collect()}
    view = FT.FeatureView.fit(docs, FeatureColumns("t", (), ()), "id", min_df=2)
    names = [n.removeprefix("text__") for n in view.names]
    assert names == sorted(names)
    for row in view.transform(docs).select("id", vector_to_array("features").alias("v")).collect():
        for name, value in zip(names, row["v"]):
            assert value == pytest.approx(table.get((row["id"], name), 0.0))
    df = sum("rue" in grams(t) for t in TEXTS)
    idf = {t: math.log((1 + len(TEXTS)) / (1 + sum(t in grams(x) for x in TEXTS))) + 1 for t in names}
    assert df == 4
    tf = Counter(g for g in grams(TEXTS[0]) if g in idf)
    norm = math.sqrt(sum((n * idf[t]) ** 2 for t, n in tf.items()))
    assert table[0, "rue"] == pytest.approx(idf["rue"] / norm)


CATEGORIES = ["b"] * 20 + ["a"] * 25 + ["rare"] * 3 + [None] * 21 + ["odd"]


@pytest.fixture(scope="module")
def view(spark):
    rows = [(i, c, float(i % 10) if i % 4 else None, None) for i, c in enumerate(CATEGORIES)]
    train = spark.createDataFrame(rows, "id bigint, c string, x double, empty double")
    return FT.FeatureView.fit(train, FeatureColumns(None, ("c",), ("x", "empty")), "id")


def test_names_and_dropped_empty_column(view):
    assert view.names == ["c_a", "c_b", "c_missing", f"c_{FT.RARE_NAME}", "x"]


def test_rare_unknown_and_missing_categories(spark, view):
    rows = [(0, "a", 1.0), (1, "rare", 1.0), (2, "never seen", 1.0), (3, None, None), (4, "odd", 2.0)]
    df = spark.createDataFrame(rows, "id bigint, c string, x double")
    median = view.medians["x"]
    got = [r["v"] for r in view.transform(df).orderBy("id").select(vector_to_array("features").alias("v")).collect()]
    assert got == [
        [1, 0, 0, 0, 1], [0, 0, 0, 1, 1], [0, 0, 0, 0, 1], [0, 0, 1, 0, median], [0, 0, 0, 1, 2],
    ]


def test_absent_columns(spark, view):
    df = spark.createDataFrame([(1,)], "id bigint")
    assert view.transform(df).select(vector_to_array("features")).first()[0] == [0, 0, 1, 0, view.medians["x"]]


def test_all_rare_column_has_one_slot(spark):
    counts = FT.category_counts(spark.createDataFrame([("a",), ("b",)], "c string"), ["c"])
    got = {(r["category"], r["slot"], r["rare"]) for r in FT.category_codes(counts, 5).collect()}
    assert got == {("a", 0, True), ("b", 0, True)}


def test_column_medians(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (9, 7.0)], "a int, b double")
    got = {r["column"]: r["median"] for r in FT.column_medians(df, ["a", "b"]).collect()}
    assert got == {"a": 2.0, "b": 6.0}


def test_save_and_load(spark, docs, tmp_path):
    docs = materialise(docs.withColumn("c", F.when(F.col("id") < 4, "p").otherwise("q")))
    view = FT.FeatureView.fit(docs, FeatureColumns("t", ("c",), ("id",)), "id", min_df=2, rare_below=2)
    view.save(f"{tmp_path}/view")
    again = FT.FeatureView.load(spark, f"{tmp_path}/view")
    assert again.names == view.names
    first = [r["features"] for r in view.transform(docs).orderBy("id").collect()]
    assert [r["features"] for r in again.transform(docs).orderBy("id").collect()] == first


def test_no_features(spark, docs):
    with pytest.raises(ValueError):
        FT.FeatureView.fit(docs, FeatureColumns("t", (), ()), "id", min_df=100)


def test_term_statistics(docs):
    total, df = Counter(), Counter()
    for text in TEXTS:
        total.update(grams(text))
        df.update(set(grams(text)))
    got = {r["term"]: (r["total"], r["df"]) for r in FT.term_statistics(docs, "t").collect()}
    assert got.pop(None) == (len(TEXTS), len(TEXTS))
    assert got == {t: (total[t], df[t]) for t in total}
    pairs = FT.term_statistics(docs, "t", sizes=(2,)).where("term IS NOT NULL").collect()
    assert {r["term"] for r in pairs} == {t for t in total if " " in t}


def test_text_weights_equal_joined_ones(docs):
    counts = FT.term_counts(docs, "id", "t")
    vocab = FT.vocabulary(FT.term_totals(counts), 6, 1)
    joined = FT.tfidf_weights(counts, vocab, docs.agg(F.count("*")), "id").collect()
    found = FT.text_weights(docs, "t", "id", 6, 1)
    want = {(r["id"], r["term"]): r["weight"] for r in joined}
    assert {(r["id"], r["term"]): r["weight"] for r in found.collect()} == pytest.approx(want)
    plan = found._jdf.queryExecution().toString()
    after = plan[plan.index("== Physical Plan ==") :]
    assert "hashpartitioning" not in after
    assert FT.text_weights(docs.where("false"), "t", "id").count() == 0


def test_shared_fits_are_made_once(spark, monkeypatch):
    rows = [(i, f"red blue {i % 3}0 green", "xy"[i % 2], float(i)) for i in range(40)]
    df = materialise(spark.createDataFrame(rows, "id bigint, t string, k string, u double"))
    views = [FeatureColumns("t", (), ()), FeatureColumns("t", ("k",), ("u",)), FeatureColumns(None, ("k",), ("u",))]
    alone = [[r[0] for r in FT.FeatureView.fit(df, v, "id").transform(df).orderBy("id").select("features").collect()] for v in views]
    calls = []
    for name in ("fit_text", "category_counts", "column_medians"):
        whole = getattr(FT, name)
        monkeypatch.setattr(FT, name, lambda *a, _n=name, _f=whole, **k: calls.append(_n) or _f(*a, **k))
    with FT.shared_fits():
        fitted = [FT.FeatureView.fit(df, v, "id") for v in views]
        shared = [[r[0] for r in v.transform(df).orderBy("id").select("features").collect()] for v in fitted]
        assert sorted(calls) == ["category_counts", "column_medians", "fit_text"]
        # Another frame is fitted anew.
        FT.FeatureView.fit(df.where("id < 30"), views[0], "id")
        assert calls.count("fit_text") == 2
    assert shared == alone
    FT.FeatureView.fit(df, views[0], "id")
    assert calls.count("fit_text") == 3
