"""Small tables of our own with answers worked out by hand, and slices of the test tables."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import TINY
from oddspend import schema as S
from oddspend.sources import views

# A trip through three countries: a commuter, a refund after midnight, a row that came twice.
CLEAN_ROWS = [
    (7, 2, 2019, 6, 14, "07:45", "$12.40", "Swipe Transaction", 9001, "Oslo", "NO", 150.0, 5814, None, "No"),
    (7, 2, 2019, 6, 14, "19:20", "$310.00", "Chip Transaction", 9002, "Bergen", "NO", 5003.0, 4511, "Bad Zipcode", "Yes"),
    (8, 0, 2019, 6, 15, "00:05", "$-310.00", "Online Transaction", 9002, "ONLINE", None, None, 4511, None, "No"),
    (9, 1, 2019, 6, 16, "13:59", "$12.40", None, 9001, None, None, None, None, None, None),
    (9, 1, 2019, 6, 16, "13:59", "$12.40", None, 9001, None, None, None, None, None, None),
    (9, 1, 2019, 6, 17, "21:30", "$1,900.25", "Chip Transaction", 9003, "Lyon", "FR", 69001.0, 5732, None, "No"),
]
# A Friday morning with three payments inside an hour, a Sunday night far above them, and a second customer.
PAYMENTS = [
    (11, "2021-03-05 08:10", 12.0, 70), (11, "2021-03-05 08:55", 18.0, 71), (11, "2021-03-05 09:05", 30.0, 70),
    (11, "2021-03-07 23:40", 900.0, 72), (12, "2021-03-06 10:00", 5.0, 71), (12, "2021-03-08 10:00", 7.0, 71),
]


def raw(spark, rows=CLEAN_ROWS):
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in S.RAW_SCHEMA)
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], f"{fields}, row_id long")


def payments(spark, rows=PAYMENTS):
    """Cleaned rows from (user, time, amount, merchant)."""
    from oddspend.operators.clean import time_parts

    data = [(i, u, dt.datetime.fromisoformat(t), float(a), m) for i, (u, t, a, m) in enumerate(rows)]
    return time_parts(spark.createDataFrame(
        data, f"row_id long, `{S.USER}` long, {S.TS} timestamp_ntz, {S.AMOUNT} double, `{S.MERCHANT}` long"))


def shifted_vectors(spark):
    """312 vectors of the embeddings table, six components each; every 26th is moved far out."""
    far = F.col("vec_id") % 26 == 25
    x = F.transform(F.slice("embedding", 1, 6), lambda v, i: 8.0 * v.cast("double") + F.when(far, 14.0 - 2.0 * (i % 3)).otherwise(0.0))
    rows = spark.read.parquet(f"{TINY}/embeddings.parquet").filter("vec_id < 312")
    return rows.select(F.col("vec_id").alias("row_id"), x.alias("features"), far.cast("int").alias("is_fraud"))


def card_rows(spark, n=300):
    """The first n different raw rows with a date that exists, from the events table."""
    out = {}
    for r in views.raw_card(spark, TINY).orderBy("row_id").drop("row_id").select(*S.RAW_COLUMNS).collect():
        try:
            dt.date(r["Year"], r["Month"], r["Day"])
        except ValueError:
            continue
        out.setdefault(tuple(r))
    return list(out)[:n]
