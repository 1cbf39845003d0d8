"""From a raw UTF-16 export to a subset, compared models, intervals and saved reports."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from docketry import schema as S
from docketry.models.classifiers import PriorClassifier
from docketry.models.registry import ModelSpec, classification_models, regression_models
from docketry.operators import frames
from docketry.plans import report, workflows
from docketry.schema import FeatureColumns
from docketry.sources import tables
from docketry.streaming import files

COLUMNS = [
    "NATURE", "ACTI_NOM", "TYPE_LIEU_INTERV", "ARRONDISSEMENT", "ARRONDISSEMENT_GEO", "PROVENANCE_ORIGINALE",
    "UNITE_RESP_PARENT", "DERNIER_STATUT", "DDS_DATE_CREATION", "DATE_DERNIER_STATUT", "LOC_LAT", "LOC_LONG", "extra",
]
NATURES = {"Requête": "Requete", "RequÃªte": "Requete", " Information": "Information", "Plainte": "Plainte"}


@pytest.fixture(scope="module")
def raw_rows():
    rng = random.Random(11)
    rows = []
    for i in range(1200):
        nature = rng.choice(["Requête", "RequÃªte", " Information", "Plainte", "bogus"])
        created = datetime(2020, 1, 1) + timedelta(days=i // 2, hours=rng.randrange(24))
        closed = created + timedelta(days=rng.randrange(-2, 40))
        activity = {"P": "Bruit, voisin", "I": "Collecte \"verte\"\nhoraire", "R": "Nid-de-poule"}.get(nature.strip()[0], "NA")
        slash = i % 2
        rows.append(
            (
                nature,
                activity if rng.random() < 0.9 else "Nid-de-poule",
                rng.choice(["rue", "parc", "null"]),
                rng.choice(["Ouest", "Est"]),
                rng.choice(["Ouest", "Est"]),
                "Telephone",
                "U",
                rng.choice(["TerminÃ©", "Annulé", "Ouvert"]),
                created.strftime("%Y/%m/%d %H:%M:%S" if slash else "%Y-%m-%dT%H:%M:%S"),
                closed.strftime("%Y-%m-%d %H:%M:%S"),
                "45.5" if i % 3 else "x",
                "-73.5",
                str(i),
            )
        )
    return rows


@pytest.fixture(scope="module")
def raw_csv(raw_rows, tmp_path_factory):
    import csv

    path = tmp_path_factory.mktemp("raw") / "requests.csv"
    with open(path, "w", encoding="utf-16", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(COLUMNS)
        writer.writerows(raw_rows)
    return str(path)


@pytest.fixture(scope="module")
def prepared(spark, raw_csv, tmp_path_factory):
    table = tables.ingest(spark, raw_csv, str(tmp_path_factory.mktemp("table") / "requests"))
    return frames.prepare_base(table)


def test_scan_keeps_quotes_breaks_and_nulls(spark, raw_csv, raw_rows):
    rows = tables.scan_csv(spark, raw_csv).collect()
    assert len(rows) == len(raw_rows)
    for got, want in zip(rows, raw_rows):
        assert tuple(got) == tuple(None if v in ("NA", "null") else v for v in want)


def test_row_ids_follow_the_file(prepared):
    rows = prepared.select("row_id", F.col("extra").cast("bigint").alias("i")).collect()
    assert all(r["row_id"] == r["i"] for r in rows)


def test_prepared_columns(prepared, raw_rows):
    rows = prepared.orderBy("row_id").collect()
    for got, want in zip(rows, raw_rows):
        assert got[S.TARGET] == NATURES.get(want[0])
        assert got[S.STATUS] in ("termine", "annule", "ouvert")
        assert got["has_geo"] == (0.0 if want[10] == "x" else 1.0)
        assert got["creation_dayofweek"] == got[S.CREATED].weekday()
        assert got["ACTI_NOM"] == ("" if want[1] == "NA" else " ".join(want[1].split()))


def test_frames(prepared, raw_rows):
    assert frames.classification_rows(prepared).count() == sum(r[0] in NATURES for r in raw_rows)
    days = [r[0] for r in frames.regression_rows(prepared).select(S.DURATION).collect()]
    closed = [r for r in raw_rows if r[7] != "Ouvert" and r[9] >= r[8].replace("/", "-").replace("T", " ")]
    assert len(days) == len(closed) and min(days) >= 0


def test_first_rows(prepared):
    assert [r["row_id"] for r in tables.first_rows(prepared, 3).select("row_id").orderBy("row_id").collect()] == [0, 1, 2]
    assert tables.first_rows(prepared, None) is prepared


def test_split_edges(spark):
    stamps = [datetime(2020, 12, 31, 23, 59, 59), datetime(2020, 12, 31, 23, 59, 59, 500000), None]
    df = spark.createDataFrame([(t,) for t in stamps], f"{S.CREATED} timestamp_ntz")
    assert [r[0] for r in df.select(frames.split_label(F.col(S.CREATED))).collect()] == ["train", "validation", None]
    train, validation, test = frames.split_frames(df, "2021-06-30 23:59:59", "2020-01-01 00:00:00")
    assert (train.count(), validation.count(), test.count()) == (2, 0, 2)
    with pytest.raises(ValueError):
        frames.split_label(F.col(S.CREATED), "2021-01-01", "2020-01-01")


def test_splits_are_disjoint_and_complete(prepared):
    tagged = prepared.withColumn("split", frames.split_label(F.col(S.CREATED), "2020-09-30 23:59:59", "2021-03-31 23:59:59"))
    sizes = frames.check_splits(tagged, S.TARGET, 2)
    assert sum(sizes.values()) == prepared.count()
    with pytest.raises(ValueError, match="empty"):
        frames.check_splits(tagged.where("split <> 'test'"), S.TARGET)
    with pytest.raises(ValueError, match="at least"):
        frames.check_splits(tagged, S.TARGET, 9)


def test_build_subset(spark, raw_csv, tmp_path):
    path = f"{tmp_path}/subset.csv.gz"
    metadata = workflows.build_subset(spark, raw_csv, path, target_rows=300, min_per_group=2, max_rows=1000).first()
    saved = tables.scan_csv(spark, path)
    assert saved.count() == metadata["sampled_rows"] == 300
    assert set(COLUMNS) <= set(saved.columns)
    again = spark.read.json(f"{path}.metadata.json").first()
    assert again["sampled_rows"] == 300 and again["random_state"] == 42
    # Cleaning a saved subset again changes nothing that models read.
    twice = frames.prepare_base(saved.drop(S.CREATED, S.UPDATED))
    assert twice.where(F.col(S.TARGET).isNull()).isEmpty()
    per_group = twice.groupBy(F.date_format(S.CREATED, "yyyy-MM").alias("m"), S.TARGET).count().collect()
    counts = {f"{r['m']}|{r[S.TARGET]}": r["count"] for r in per_group}
    assert counts == {k: v for k, v in again["monthly_nature_sampled_counts"].asDict().items() if v}


BOUNDS = ("2020-09-30 23:59:59", "2021-03-31 23:59:59")
VIEW = FeatureColumns("ACTI_NOM", ("ARRONDISSEMENT",), ("creation_month", "has_geo"))


class Broken:
    def fit(self, *_):
        raise ValueError("cannot be fitted")


def test_classification(spark, prepared, tmp_path):
    tagged = frames.classification_rows(prepared).withColumn("split", frames.split_label(F.col(S.CREATED), *BOUNDS))
    specs = [s for s in classification_models(VIEW) if s.name in ("dummy_prior", "logistic_text_only")]
    specs.append(ModelSpec("broken", "none", Broken))
    run = workflows.train_classification(tagged, specs=specs, min_count=10)
    rows = run.comparison.collect()
    assert [r["model"] for r in rows] == ["logistic_text_only", "dummy_prior", "broken"]
    assert rows[2]["error"] == "ValueError: cannot be fitted" and rows[2]["macro_f1"] is None
    summary = run.summary.first()
    assert summary["labels"] == ["Information", "Plainte", "Requete"]
    support = run.class_report.agg(F.sum("support")).first()[0]
    assert support == summary["test_rows"] == run.reliability.agg(F.sum("count")).first()[0]
    mean_f1 = run.class_report.agg(F.avg("f1")).first()[0]
    assert mean_f1 == pytest.approx(summary["final_test_metrics"]["macro_f1"])
    assert set(run.by_group) == {"creation_month", "ARRONDISSEMENT"}
    assert run.contributions.where("rank = 1").count() == 3
    run.save(f"{tmp_path}/classification")
    saved = tables.load_report(
        spark, f"{tmp_path}/classification/model_comparison",
        "model string, feature_view string, error string, validation_accuracy double, validation_macro_f1 double",
    )
    assert saved.first()["model"] == "logistic_text_only"
    loaded = tables.load_summary(spark, f"{tmp_path}/classification/summary").first()
    assert loaded["best_model"] == "logistic_text_only"


def test_no_model_can_be_trained(prepared):
    tagged = frames.classification_rows(prepared).withColumn("split", frames.split_label(F.col(S.CREATED), *BOUNDS))
    with pytest.raises(RuntimeError):
        workflows.train_classification(tagged, specs=[ModelSpec("broken", "none", Broken)])


def test_unseen_validation_label_is_an_error_row(prepared):
    tagged = frames.classification_rows(prepared).withColumn("split", frames.split_label(F.col(S.CREATED), *BOUNDS))
    odd = tagged.withColumn(
        S.TARGET, F.when(F.col("split") == "validation", "Other").otherwise(F.col(S.TARGET))
    )
    found = workflows.compare_classifiers(
        [ModelSpec("dummy_prior", "none", PriorClassifier)],
        odd.where("split = 'train'"), odd.where("split = 'validation'"),
        S.TARGET, "row_id", ["Information", "Plainte", "Requete"],
    ).first()
    assert "label not in the label list" in found["error"]


def test_regression(spark, prepared, tmp_path):
    tagged = frames.regression_rows(prepared).withColumn("split", frames.split_label(F.col(S.CREATED), *BOUNDS))
    specs = [s for s in regression_models(VIEW) if s.name != "elasticnet_sparse_combined"]
    run = workflows.train_regression(tagged, specs=specs, alpha=0.2)
    assert run.comparison.count() == 3
    summary = run.summary.first()
    interval = summary["conformal_interval"]
    assert interval["nominal_coverage"] == 0.8 and interval["calibration_rows"] == summary["validation_rows"]
    metrics = interval["test_metrics"]
    assert metrics["mean_interval_width"] == pytest.approx(2 * interval["interval_radius_days"])
    assert run.intervals.count() == summary["test_rows"]
    assert report.interval_summary(run.summary).first()["observed_coverage"] == metrics["coverage"]
    series = report.interval_series(run.intervals, "row_id", 60).collect()
    assert [r["prediction"] for r in series] == sorted(r["prediction"] for r in series)
    run.save(f"{tmp_path}/regression")

    with pytest.raises(ValueError, match="cannot be fitted"):
        workflows.train_regression(tagged, specs=[ModelSpec("broken", "none", Broken)])


def test_arriving_files(spark, raw_rows, tmp_path):
    import csv

    folder = tmp_path / "in"
    folder.mkdir()

    def arrive(name, rows):
        with open(folder / name, "w", encoding="utf-16", newline="") as out:
            writer = csv.writer(out)
            writer.writerow(COLUMNS)
            writer.writerows(rows)

    def run():
        raw = files.read_arriving(spark, str(folder), COLUMNS)
        files.clean_arriving(raw, f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
        return spark.read.parquet(f"{tmp_path}/out")

    arrive("1.csv", raw_rows[:100])
    assert run().count() == 100
    arrive("2.csv", raw_rows[100:250])
    found = run()
    assert found.count() == 250
    assert found.where(F.col(S.TARGET).isNotNull()).count() == sum(r[0] in NATURES for r in raw_rows[:250])


def test_row_ids_follow_files_of_unequal_size(spark, tmp_path):
    (tmp_path / "a.csv").write_text("v\n" + "\n".join(f"a{i}" for i in range(3)) + "\n")
    (tmp_path / "b.csv").write_text("v\n" + "\n".join(f"b{i}" for i in range(3000)) + "\n")
    (tmp_path / "c.csv").write_text("v\n" + "\n".join(f"c{i}" for i in range(40)) + "\n")
    want = [f"a{i}" for i in range(3)] + [f"b{i}" for i in range(3000)] + [f"c{i}" for i in range(40)]
    for multi_line in (True, False):
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
        try:
            scanned = tables.scan_csv(spark, str(tmp_path), encoding="UTF-8", multi_line=multi_line)
            rows = tables.with_row_id(scanned).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert [r["v"] for r in sorted(rows, key=lambda r: r["row_id"])] == want
        assert sorted(r["row_id"] for r in rows) == list(range(len(want)))


def test_many_records_of_one_row_group_are_dealt_out(spark, tmp_path, monkeypatch):
    rng = random.Random(5)
    rows = [(i, rng.randbytes(1500).hex(), "ab"[i % 3 == 0], ("train", "validation", "test")[i % 3 if i % 5 else 0]) for i in range(3000)]
    spark.createDataFrame(rows, "id long, text string, grade string, split string").coalesce(1).write.parquet(f"{tmp_path}/one")
    one = spark.read.parquet(f"{tmp_path}/one")
    made = {}
    real = workflows.materialise

    def kept(df, name, by=()):
        made[name] = real(df, name, by)
        return made[name]

    monkeypatch.setattr(workflows, "materialise", kept)
    specs = [ModelSpec("prior", "none", PriorClassifier)]
    runs = []
    for most in (3000, 2999):
        monkeypatch.setattr(workflows, "SPREAD_ROWS", most)
        run = workflows.train_classification(one, "grade", "id", groups=("split",), specs=specs)
        train = made["tagged"].where("split = 'train'")
        runs.append((run.class_report.collect(), sorted(made["tagged"].collect()), train.select(F.input_file_name()).distinct().count()))
    assert runs[0][:2] == runs[1][:2] and len(runs[0][1]) == 3000
    assert runs[0][2] == 1 and runs[1][2] > 1
