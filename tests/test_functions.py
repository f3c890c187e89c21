import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallywright.functions import (
    clean_amount,
    clean_date,
    clean_email,
    clean_name,
    clean_phone,
    exposure_first,
    exposure_max,
    lcs_ratio,
    whole_days_between,
)
from tallywright.operators import cleaning


def apply(spark, fn, *values):
    rows = [(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)]
    width = len(rows[0]) - 1
    names = [f"c{j}" for j in range(width)]
    df = spark.createDataFrame(rows, ", ".join(["i int", *[f"{n} string" for n in names]]))
    out = df.select("i", fn(*[F.col(n) for n in names]).alias("r")).orderBy("i").collect()
    return [r.r for r in out]


def test_clean_name(spark):
    got = apply(
        spark, clean_name, "\t asha    costa 　", "A  B\n\nC", "x\ty", None, "", "  "
    )
    assert got == ["ASHA COSTA", "A B C", "X Y", None, "", ""]


def test_clean_email(spark):
    assert apply(spark, clean_email, "  A.B@X.com ", "a b@x", None) == [
        "a.b@x.com",
        "a b@x",
        None,
    ]


def test_clean_phone(spark):
    got = apply(spark, clean_phone, "+91 98765-43210", "123", "none", None, "00441234567890123")
    assert got == ["9876543210", "123", "", None, "4567890123"]


def test_clean_amount(spark):
    got = apply(
        spark, clean_amount, "1,000", " 12.345 ", "1e3", "NaN", "", None, "-0.005", "12.344"
    )
    assert got == [
        None,
        Decimal("12.35"),
        Decimal("1000.00"),
        None,
        None,
        None,
        Decimal("-0.01"),
        Decimal("12.34"),
    ]


def test_clean_date_does_not_depend_on_the_time_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = apply(
                spark,
                lambda c: clean_date(c).cast("string"),
                "bad",
                "2026-03-08",
                "2026-03-08 02:30:00",
                None,
            )
            assert got == [None, "2026-03-08 00:00:00", "2026-03-08 02:30:00", None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_whole_days(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    cases = [
        ("2026-03-07 23:00:00", "2026-03-08 21:00:00", 0),  # 22 hours over midnight
        ("2026-03-08 10:00:00", "2026-03-08 09:00:00", -1),
        ("2026-03-08", "2026-03-09", 1),
        ("2026-03-08", "2026-03-07", -1),
        ("2026-03-07 12:00:00", "2026-03-09 12:00:00", 2),
        ("2026-03-09 12:00:00", "2026-03-07 12:00:01", -2),
        ("2026-03-09 12:00:00", "2026-03-07 12:00:00", -2),
        (None, "2026-03-07", None),
        ("2026-03-07", "bad", None),
    ]
    try:
        got = apply(
            spark,
            lambda a, b: whole_days_between(clean_date(a), clean_date(b)),
            *[c[:2] for c in cases],
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [c[2] for c in cases]


def brute_lcs(a, b):
    above = [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(above[j] + 1 if x == y else max(above[j + 1], row[j]))
        above = row
    return above[-1]


def test_lcs_ratio_against_the_textbook_table(spark):
    rnd = random.Random(7)

    def text(low, high):
        return "".join(rnd.choice("abcdé ñ😀xy") for _ in range(rnd.randint(low, high)))

    pairs = [(text(0, 20), text(0, 20)) for _ in range(300)]
    pairs += [(text(60, 64), text(60, 64)) for _ in range(40)]
    pairs += [(text(120, 130), text(110, 200)) for _ in range(10)]
    pairs += [(None, "a"), ("a", None), ("", "a"), ("ASHA COSTA", "COSTA ASHA"), ("same", "same")]
    got = apply(spark, lambda a, b: lcs_ratio("c0", "c1"), *pairs)
    for (a, b), r in zip(pairs, got):
        want = 200.0 * brute_lcs(a, b) / (len(a) + len(b)) if a and b else 0.0
        assert r == pytest.approx(want, abs=1e-9), (a, b)


def test_the_two_exposures(spark):
    rows = [("0", "5.00"), (None, "5.00"), ("3", "-5.00"), ("-7", None), (None, None)]
    df = spark.createDataFrame(rows, "p string, b string").select(
        F.col("p").cast("decimal(19,2)").alias("p"), F.col("b").cast("decimal(19,2)").alias("b")
    )
    got = df.select(exposure_max(df.p, df.b), exposure_first(df.p, df.b)).collect()
    assert [tuple(map(float, r)) for r in got] == [(5, 0), (5, 5), (5, 3), (7, 7), (0, 0)]


def test_declared_date_formats(spark):
    texts = ["2026-01-08", "08/01/2026", "8 Jan 2026 13:45", "2026/99/01", "", None, "29/03/2026"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    formats = ("dd/MM/yyyy", "d MMM yyyy HH:mm")
    got = df.select("i", clean_date(F.col("t"), formats).cast("string").alias("d")).collect()
    assert [r.d for r in sorted(got)] == [
        "2026-01-08 00:00:00", "2026-01-08 00:00:00", "2026-01-08 13:45:00", None, None, None,
        "2026-03-29 00:00:00",
    ]


def test_a_zone_without_the_hour_changes_nothing(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        df = spark.createDataFrame([("29.03.2026 02:30",)], "t string")
        row = df.select(clean_date(F.col("t"), ("dd.MM.yyyy HH:mm",)).cast("string").alias("d")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert row.d == "2026-03-29 02:30:00"


def test_unparsed_texts_are_counted(spark):
    rows = [("1", "2026-01-01"), ("x", "01/02/2026"), ("12345678901234567.00", ""), (None, None)]
    raw = spark.createDataFrame(rows, "amount string, transaction_date string").withColumns(
        {c: F.lit("") for c in ("customer_name", "email", "phone")}
    )
    count = lambda *formats: {
        r.column_name: r.lost for r in cleaning.unparsed("erp_transactions", raw, formats).collect()
    }
    assert count() == {"amount": 2, "transaction_date": 1}
    assert count("dd/MM/yyyy") == {"amount": 2, "transaction_date": 0}
