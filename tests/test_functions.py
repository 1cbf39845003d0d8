import unicodedata
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from docketry.functions import text as TX
from docketry.functions import values as V
from docketry.schema import LABELS


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def results(df, expression):
    return [r[0] for r in df.select(expression).collect()]


REPAIRS = [
    ("RequÃ©te", "Requéte"),
    ("BÃ¢timent", "Bâtiment"),
    ("Bâtiment", "Bâtiment"),
    ("x�y", "x�y"),
    ("â€™", "â€™"),
    ("Ã ", "Ã"),
    ("Å\u0093uvre", "Å\u0093uvre"),
    ("Å\u0093 Ã©", "œ é"),
    ("   ", ""),
    (None, None),
    ("  a   b\u001c", "a b"),
    ("a \tb\r\nc\u0085d", "a b c d"),
]


def test_repair(spark):
    df = column(spark, [a for a, _ in REPAIRS])
    assert results(df, TX.repair_text(F.col("x"))) == [b for _, b in REPAIRS]


def reference_fold(value):
    plain = unicodedata.normalize("NFKD", value).encode("ascii", "ignore").decode()
    return " ".join(plain.lower().split())


def test_fold_known_values(spark):
    pairs = [
        ("Requête", "requete"), ("Terminé ", "termine"), ("œuvre", "uvre"), ("½", "12"), ("ﬁn", "fin"),
        ("ß", ""), ("l’eau", "leau"), ("№", "no"), (None, ""), ("RequÃªte", "requete"),
        ("a\U0001d400b\U0001f100", "aab0."),
    ]
    df = column(spark, [a for a, _ in pairs])
    assert results(df, TX.fold_text(F.col("x"))) == [b for _, b in pairs]


def test_fold_every_character(spark):
    """One text per 64 code points, as long as no damage mark is among them."""
    texts = []
    for start in range(0x20, 0x20000, 64):
        chars = [chr(p) for p in range(start, start + 64) if not 0xD800 <= p <= 0xDFFF]
        texts.append("".join(c for c in chars if c not in "ÃÂâ�"))
    # A lone surrogate cannot be stored; everything else is compared.
    df = column(spark, texts)
    found = [r[0] for r in TX.fold_columns(df, {"y": F.col("x")}).select("y").collect()]
    wrong = [(t[:5], a, reference_fold(t)) for t, a in zip(texts, found) if a != reference_fold(t)]
    assert not wrong


def test_doubly_damaged_label(spark):
    damaged = "Requête".encode().decode("latin-1").encode().decode("latin-1")
    df = column(spark, [damaged, "Plainte", "autre", None])
    once = TX.repair_columns(df, {"x": F.col("x")})
    folded = TX.fold_columns(once, {"y": F.col("x")})
    assert results(folded, TX.label_of(F.col("y"), LABELS)) == ["Requete", "Plainte", None, None]


def test_to_number(spark):
    values = ["1.5", " 2 ", "1e3", "inf", "-", "1,5", "1.0d", "2F", "0x10", "True", "1_000", "nan", None]
    expected = [1.5, 2.0, 1000.0, float("inf")] + [None] * 9
    assert results(column(spark, values), V.to_number(F.col("x"))) == expected


STAMPS = [
    ("2019-01-05T03:04:05", datetime(2019, 1, 5, 3, 4, 5)),
    ("2019/01/05 03:04:05", datetime(2019, 1, 5, 3, 4, 5)),
    ("2019/1/5 3:04:05", datetime(2019, 1, 5, 3, 4, 5)),
    ("2019-01", datetime(2019, 1, 1)),
    ("2019", datetime(2019, 1, 1)),
    ("20190105", datetime(2019, 1, 5)),
    ("2019/03/10 02:30:00", datetime(2019, 3, 10, 2, 30)),
    ("05/01/2019", None),
    ("2019-02-30", None),
    ("12:30", None),
    ("NaT", None),
    ("", None),
    (None, None),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_to_timestamp(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = column(spark, [a for a, _ in STAMPS])
        assert results(df, V.to_timestamp(F.col("x"))) == [b for _, b in STAMPS]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_monday_is_zero(spark):
    df = column(spark, [datetime(2019, 1, 7), datetime(2019, 1, 13)], "timestamp_ntz")
    assert results(df, V.calendar_parts(F.col("x"))["creation_dayofweek"]) == [0, 6]


def test_score_ignores_partitioning(spark):
    df = spark.range(1000)
    one = df.select("id", V.random_score(7, F.col("id")).alias("s"))
    many = df.repartition(7).select("id", V.random_score(7, F.col("id")).alias("s"))
    assert one.exceptAll(many).isEmpty()
    low, high, mean = one.agg(F.min("s"), F.max("s"), F.avg("s")).first()
    assert 0 <= low < 0.01 and 0.99 < high < 1 and abs(mean - 0.5) < 0.03


def test_words_and_bigrams(spark):
    df = column(spark, ["L'Été a 12 jours", "un", "", None])
    assert results(df, TX.words(F.col("x"))) == [["été", "12", "jours"], ["un"], [], []]
    pairs = results(df.select(TX.words(F.col("x")).alias("w")), TX.bigrams(F.col("w")))
    assert pairs == [["été 12", "12 jours"], [], [], []]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_durations_and_months_ignore_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        pairs = [
            (datetime(2019, 3, 9, 12), datetime(2019, 3, 10, 12)),
            (datetime(2019, 11, 1), datetime(2019, 11, 30, 6, 30, 15, 250000)),
            (datetime(2019, 3, 11, 1, 2, 3, 4), datetime(2019, 3, 10, 2, 30)),
            (datetime(2019, 3, 10, 2, 30), None),
        ]
        df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
        rows = df.select(V.duration_days(F.col("a"), F.col("b")), V.month_key(F.col("a"))).collect()
        want = [None if b is None else (b - a).total_seconds() / 86400 for a, b in pairs]
        assert [r[0] for r in rows] == want
        assert [r[1] for r in rows] == ["2019-03", "2019-11", "2019-03", "2019-03"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
