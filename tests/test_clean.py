import datetime as dt

import pytest
from pyspark.sql import functions as F

import fixtures
from oddspend import schema as S
from oddspend.operators import clean as C, profile as V


def test_clean_fixture(spark):
    raw = fixtures.raw(spark)
    parsed = C.parse_datetime(C.parse_amount(raw)).orderBy("row_id").collect()
    assert parsed[0][S.AMOUNT] == 12.4 and parsed[0][S.HOUR] == 7 and parsed[5][S.AMOUNT] == 1900.25
    assert all(r[S.TS] is not None for r in parsed)
    rows, stats = C.clean(raw)
    got = rows.collect()
    assert len(got) == 5 and sum(r[S.LABEL] for r in got) == 1
    assert S.LABEL_RAW not in rows.columns
    assert all(r["Merchant State"] and r["Zip"] is not None for r in got)
    assert max(r[S.AMOUNT] for r in got) < 1900.25
    assert stats.clip_high < 1900.25


def test_stats_are_reused(spark):
    raw = fixtures.raw(spark)
    rows, _ = C.clean(raw, C.CleanStats(7.0, 0.0, 50.0))
    assert {r[S.AMOUNT] for r in rows.collect()} == {12.4, 50.0, 0.0}


def test_bad_dates_and_times(spark):
    base = list(fixtures.CLEAN_ROWS[0])
    rows = []
    for month, day, time in [(2, 30, "10:00"), (1, 1, "7"), (1, 2, "25:61"), (1, 3, "xx:10"), (1, 4, "10:05.9")]:
        r = list(base)
        r[3], r[4], r[5] = month, day, time
        rows.append(tuple(r))
    got = {r.row_id: r[S.TS] for r in C.parse_datetime(fixtures.raw(spark, rows)).collect()}
    assert got == {1: dt.datetime(2019, 1, 1, 7, 0), 2: dt.datetime(2019, 1, 2, 23, 59), 3: dt.datetime(2019, 1, 3, 0, 10),
                   4: dt.datetime(2019, 1, 4, 10, 5)}


def test_junk_amount(spark):
    row = list(fixtures.CLEAN_ROWS[0])
    row[6] = "n/a"
    raw = fixtures.raw(spark, [tuple(row)])
    with pytest.raises(Exception, match="not an amount"):
        C.parse_amount(raw).collect()
    assert C.parse_amount(raw, strict=False).first()[S.AMOUNT] is None


def test_null_and_unknown_twins_merge(spark):
    a, b = list(fixtures.CLEAN_ROWS[0]), list(fixtures.CLEAN_ROWS[0])
    a[13], b[13] = None, "UNKNOWN"
    raw = fixtures.raw(spark, [tuple(a), tuple(b)])
    assert V.duplicates(raw.drop("row_id")).first().n_duplicate_rows == 0
    kept = C.clean(raw)[0].collect()
    assert [r.row_id for r in kept] == [0]


def test_label_follows_its_row(spark):
    rows = [(*r[:14], "Yes" if r[8] % 7 == 3 else "No") for r in fixtures.card_rows(spark)]
    raw = fixtures.raw(spark, rows).orderBy(F.rand(1))
    got = C.clean(raw)[0].collect()
    assert got and all(r[S.LABEL] == int(r[S.MERCHANT] % 7 == 3) for r in got)


def test_schema_gate(spark):
    raw = fixtures.raw(spark).drop("MCC", "Zip")
    with pytest.raises(S.SchemaValidationError, match="MCC"):
        V.validate(raw)
    assert V.validate_schema(raw, raise_on_error=False) == ["MCC", "Zip"]


def test_min_history(spark):
    rows = fixtures.payments(spark)
    assert {r[S.USER] for r in C.min_history(rows, 3).collect()} == {11}
