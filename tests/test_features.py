import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import fixtures
from conftest import TINY
from oddspend import schema as S
from oddspend.operators import features as B
from oddspend.sources import views


def test_fixture_answers(spark):
    out = B.engineer(fixtures.payments(spark)).orderBy("row_id").toPandas()
    assert list(out.columns[-14:]) == S.FEATURES
    assert np.isfinite(out[S.FEATURES].to_numpy(dtype=float)).all()
    one = out[out.User == 11]
    assert one.customer_txn_count.tolist() == [0, 1, 2, 3]
    assert one.customer_avg_amount.iloc[2] == 15.0
    assert one.merchant_diversity.tolist() == [0, 1, 2, 2]
    assert one.transaction_velocity.tolist() == [0, 1, 2, 0]
    assert one.business_hour_indicator.tolist() == [0, 0, 1, 0]
    assert out.weekend_indicator.tolist() == [0, 0, 0, 1, 1, 0]


def test_missing_columns(spark):
    with pytest.raises(ValueError, match="Merchant Name"):
        B.engineer(fixtures.payments(spark).drop(S.MERCHANT))


def test_ties_boundary_and_constants(spark):
    rows = [(1, "2020-01-01 09:00", 10.0, 5)] * 3 + [(1, "2020-01-01 10:00", 10.0, 5), (1, "2020-01-01 10:01", 10.0, 5)]
    out = B.engineer(fixtures.payments(spark, rows)).orderBy("row_id").toPandas()
    # equal times count in row order; a payment exactly one hour ago still counts
    assert out.transaction_velocity.tolist() == [0, 1, 2, 3, 1]
    assert (out.amount_deviation_from_customer_mean == 0).all() and (out.amount_zscore_by_merchant == 0).all()


def brute_force(p):
    p = p.sort_values(["User", S.TS, "row_id"]).reset_index(drop=True)
    rows = []
    for _, g in p.groupby("User"):
        a, t, m = g.Amount.to_numpy(), g[S.TS].to_numpy(), g[S.MERCHANT].to_numpy()
        day = g[S.TS].dt.date.to_numpy()
        for i in range(len(g)):
            q = a[:i]
            sd = q.std(ddof=1) if i > 1 else 0.0
            days = max(1, len(set(day[:i])))
            rows.append({
                "row_id": g.row_id.iloc[i], "customer_avg_amount": q.mean() if i else a[i], "customer_max_amount": q.max() if i else a[i],
                "customer_txn_count": i, "avg_daily_spending": q.sum() / days,
                "time_since_prev_txn": (t[i] - t[i - 1]) / np.timedelta64(1, "us") / 6e7 if i else np.nan,
                "rolling_avg_amount": q[-5:].mean() if i else a[i],
                "transaction_velocity": int((t[:i] >= t[i] - np.timedelta64(3600, "s")).sum()),
                "merchant_diversity": len(set(m[:i])), "customer_activity_frequency": i / days,
                "amount_deviation_from_customer_mean": (a[i] - q.mean()) / sd if sd > 1e-9 else 0.0})
    out = pd.DataFrame(rows)
    out["time_since_prev_txn"] = out.time_since_prev_txn.fillna(out.time_since_prev_txn.median())
    g = p.groupby(S.MERCHANT).Amount
    z = (p.Amount - g.transform("mean")) / g.transform("std").replace(0, np.nan)
    extra = pd.DataFrame({"row_id": p.row_id, "merchant_txn_frequency": p[S.MERCHANT].map(p[S.MERCHANT].value_counts(normalize=True)),
                          "amount_zscore_by_merchant": z.fillna(0.0)})
    return out.merge(extra, on="row_id").sort_values("row_id").reset_index(drop=True)


def skewed(spark):
    t = views.txn_events(spark, TINY)
    return t.withColumn(S.USER, F.when(F.col("row_id") % 3 == 0, 7).otherwise(F.col(S.USER))).withColumn(
        S.TS, F.date_trunc("minute", S.TS).cast("timestamp_ntz"))


@pytest.mark.parametrize("source", ["plain", "skewed"])
def test_against_brute_force(spark, source):
    t = views.txn_events(spark, TINY) if source == "plain" else skewed(spark)
    got = B.engineer(t.orderBy(F.rand(3))).orderBy("row_id").toPandas()
    want = brute_force(t.toPandas())
    for c in want.columns:
        np.testing.assert_allclose(got[c].to_numpy(dtype=float), want[c].to_numpy(dtype=float), rtol=1e-9, atol=1e-9, err_msg=c)


@pytest.mark.parametrize("hot,chunk", [(20, 12), (60, 40), (150, 7)])
def test_cut_histories_change_nothing(spark, hot, chunk):
    t = skewed(spark)
    a = B.engineer(t).orderBy("row_id").toPandas()
    b = B.engineer(t, hot_rows=hot, chunk_rows=chunk).orderBy("row_id").toPandas()
    pd.testing.assert_frame_equal(a, b, check_exact=True)


def test_partition_count_changes_nothing(spark):
    t = views.txn_events(spark, TINY)
    out = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        out.append(B.engineer(t).orderBy("row_id").toPandas())
    spark.conf.set("spark.sql.shuffle.partitions", before)
    pd.testing.assert_frame_equal(*out, check_exact=True)


def test_large_merchant_table_path(spark):
    t = views.txn_events(spark, TINY).withColumn(S.MERCHANT, F.when(F.col("row_id") % 2 == 0, 1).otherwise(F.col(S.MERCHANT)))
    a = B.merchant_features(t).orderBy("row_id").toPandas()
    b = B.merchant_features(t, broadcast_keys=1, hot_rows=100).orderBy("row_id").toPandas()
    pd.testing.assert_frame_equal(a, b[a.columns], check_exact=True)


def test_history_continues(spark):
    rows = fixtures.payments(spark)
    old, new = rows.filter("row_id < 2"), rows.filter("row_id = 2")
    got = B.engineer(new, {"gap_median": 1.0}, history=old).collect()
    assert len(got) == 1 and got[0].customer_avg_amount == 15.0 and got[0].customer_txn_count == 2


def test_one_exchange_for_the_rows(spark):
    plan = B.customer_history(views.txn_events(spark, TINY))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(User") == 2  # rows by customer, marker aggregation
    assert plan.count("Sort [User") == 1
