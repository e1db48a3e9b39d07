"""Payment-shaped views over the generic tables of a data folder."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from oddspend import schema as S
from oddspend.operators.clean import time_parts


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def txn_events(spark, folder) -> DataFrame:
    """events as payments; the label is event_type = 'error'."""
    e = table(spark, folder, "events")
    return time_parts(e.select(
        F.col("event_id").alias(S.ROW_ID), F.col("user_id").alias(S.USER), F.col("ts").alias(S.TS),
        F.col("value").alias(S.AMOUNT), F.regexp_extract("props", "[0-9]+", 0).cast("long").alias(S.MERCHANT),
        F.col("event_type").alias("channel"), (F.col("event_type") == "error").cast("int").alias(S.LABEL)))


def txn_orders(spark, folder) -> DataFrame:
    o = table(spark, folder, "orders")
    return time_parts(o.select(
        F.col("o_orderkey").alias(S.ROW_ID), F.col("o_custkey").alias(S.USER), F.col("o_orderdate").alias(S.TS),
        F.col("o_totalprice").alias(S.AMOUNT), F.col("o_orderpriority").alias(S.MERCHANT),
        F.col("o_orderstatus").alias("status"), (F.col("o_orderstatus") == "P").cast("int").alias(S.LABEL)))


def txn_lines(spark, folder) -> DataFrame:
    l, o = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    return time_parts(l.join(o, l.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias(S.USER), F.col("l_shipdate").alias(S.TS), F.col("l_extendedprice").alias(S.AMOUNT),
        F.col("l_suppkey").alias(S.MERCHANT), "l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax",
        (F.col("l_returnflag") == "R").cast("int").alias(S.LABEL)))


_RAW = [
    "user_id AS `User`", "event_id % 3 AS `Card`",
    "year(ts) AS `Year`",
    "CASE WHEN event_id % 307 = 0 THEN 2 ELSE month(ts) END AS `Month`",
    "CASE WHEN event_id % 307 = 0 THEN 30 ELSE day(ts) END AS `Day`",
    """CASE WHEN event_id % 401 = 0 THEN '25:61' WHEN event_id % 403 = 0 THEN '7'
            WHEN event_id % 409 = 0 THEN 'xx:10' ELSE date_format(ts, 'HH:mm') END AS `Time`""",
    "{amount} AS `Amount`",
    """CASE WHEN event_id % 41 = 0 THEN NULL WHEN k % 3 = 0 THEN 'Chip Transaction'
            WHEN k % 3 = 1 THEN 'Swipe Transaction' ELSE 'Online Transaction' END AS `Use Chip`""",
    "k AS `Merchant Name`", "concat('City', k % 20) AS `Merchant City`",
    "CASE WHEN k % 3 = 2 THEN NULL ELSE concat('S', k % 7) END AS `Merchant State`",
    "CASE WHEN k % 3 = 2 THEN NULL ELSE CAST(10000 + k AS DOUBLE) END AS `Zip`",
    "CAST(5000 + k % 12 AS INT) AS `MCC`",
    "CASE WHEN event_id % 50 = 0 THEN 'Insufficient Balance' END AS `Errors?`",
    """CASE WHEN event_type = 'error' THEN 'Yes' WHEN event_id % 503 = 0 THEN 'Maybe'
            ELSE 'No' END AS `Is Fraud?`""",
]
_MONEY = """CASE WHEN event_id % 97 = 0 THEN NULL
    {junk}
    WHEN event_id % 29 = 0 THEN concat('$-', CAST(CAST(value AS DECIMAL(18,2)) AS STRING))
    ELSE concat('$', CAST(CAST(value AS DECIMAL(18,2)) AS STRING)) END"""


def raw_card(spark, folder, junk: bool = False) -> DataFrame:
    """events in the raw 15-column shape, with nulls, bad dates and repeats;
    junk adds amounts that are no numbers."""
    e = table(spark, folder, "events").withColumn("k", F.regexp_extract("props", "[0-9]+", 0).cast("long"))
    amount = _MONEY.format(junk="WHEN event_id % 211 = 0 THEN 'n/a'" if junk else "")
    cols = [c.replace("{amount}", amount) for c in _RAW]
    once = e.selectExpr("event_id AS row_id", *cols)
    again = e.filter("event_id % 101 = 0").selectExpr("event_id + 1000000000000 AS row_id", *cols)
    return once.unionByName(again)


def vectors(spark, folder) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias(S.ROW_ID), F.transform("embedding", lambda x: x.cast("double")).alias("features"),
        (F.col("label") == 0).cast("int").alias(S.LABEL))
