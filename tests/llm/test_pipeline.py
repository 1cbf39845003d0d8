import pytest

import corpus_pipeline as p
from docketry.llm import toxic_crf, zstd_language
from docketry.llm.common import stored
from tests.llm import cases


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows = cases.documents(400, seed=21)
    path = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(rows, cases.SCHEMA).repartition(2).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(cases.labels(rows), "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def plain_first(rows):
    kept = []
    for r, (doc, n, component) in zip(rows, cases.plain_components([(r["doc_id"], r["text"]) for r in rows]), strict=True):
        if doc is None or n == 0 or component == doc:
            kept.append(r["doc_id"])
    return sorted(set(map(str, kept)))


def test_stages_one_by_one(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    columns = docs.columns
    for name, stage in p.STAGES:
        before = docs.collect()
        after = stored(stage(spark, docs, folder), "test")
        ids = [r["doc_id"] for r in after.collect()]
        if name == "toxicity":
            toxic = {r["doc_id"] for r in toxic_crf.classify(docs, labels).collect() if r["predicted"]}
            assert len(toxic) > 30 and all(i % 8 == 0 or i >= 1000 for i in toxic if i is not None)
            assert len(ids) == sum(r["doc_id"] not in toxic for r in before)
        elif name == "language":
            rejected = {r["doc_id"] for r in zstd_language.identify(docs).collect() if r["rejected"]}
            assert set(ids) == {r["doc_id"] for r in before} - (rejected - {None})
        elif name == "near_duplicates":
            assert sorted(set(map(str, ids))) == plain_first(before)
        else:
            assert sorted(set(map(str, ids))) == sorted({str(r["doc_id"]) for r in before})
        if name != "packing":
            assert after.columns == columns
        docs = after


def test_run_equals_its_stages_and_clean_documents_stay(spark, folder):
    found = p.run(spark, folder).collect()
    ids = {r["doc_id"] for r in found}
    clean = {i for i in range(400) if i % 8 and i % 10}
    assert len(clean & ids) >= 0.98 * len(clean)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert p.run(spark, str(tmp_path)).count() == 0
