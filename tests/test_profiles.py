"""Stored customer profiles: parts merge to the whole, and a batch scored from them meets its history."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import fixtures
from conftest import TINY
from oddspend import schema as S
from oddspend.operators import features as B, profiles as P
from oddspend.sources import views


def payments(spark):
    """A customer with a third of the rows, ties, and merchants and amounts that are null."""
    t = views.txn_events(spark, TINY).withColumn(S.USER, F.when(F.col("row_id") % 3 == 0, 7).otherwise(F.col(S.USER) % 20))
    return t.withColumn(S.TS, F.date_trunc("hour", S.TS).cast("timestamp_ntz")).withColumn(
        S.MERCHANT, F.when(F.col("row_id") % 11 == 0, None).otherwise(F.col(S.MERCHANT) % 9))


def stretches(t, *shares):
    """t cut by (time, row id), so that ties are cut apart."""
    place = P.place(F.unix_micros(F.col(S.TS).cast("timestamp")), F.col(S.ROW_ID))
    order = sorted(r[0] for r in t.select(place).collect())
    cuts = [order[int(len(order) * s)] for s in shares]
    return [t.filter((place >= lo if lo else F.lit(True)) & (place < hi if hi else F.lit(True))) for lo, hi in zip([None, *cuts], [*cuts, None])]


def rows_of(df):
    return sorted(map(repr, (r.asDict(recursive=True) for r in df.select(*sorted(df.columns)).collect())))


def test_parts_merge_to_the_whole(spark):
    t = payments(spark)
    a, b, c = [P.build(x, rolling_window=3) for x in stretches(t, 0.2, 0.7)]
    whole = P.build(t, rolling_window=3)
    for merged in (P.merge(P.merge(a, b), c), P.merge(a, P.merge(b, c))):
        for name in ("customers", "merchants", "recent"):
            got, want = getattr(merged, name), getattr(whole, name)
            assert got.schema.simpleString() == want.select(*got.columns).schema.simpleString()
            assert rows_of(got) == rows_of(want)
    salted = P.build(t, rolling_window=3, broadcast_keys=1, hot_rows=50)
    assert rows_of(salted.recent) == rows_of(whole.recent)


def test_profile_against_pandas(spark):
    t = payments(spark)
    p = t.toPandas().sort_values([S.TS, "row_id"])
    got = P.build(t).customers.toPandas().set_index(S.USER)
    for user, g in p.groupby(S.USER):
        r, last = got.loc[user], g[S.TS].max()
        assert (r.n, r.nd, r.nm) == (len(g), g[S.TS].dt.date.nunique(), g[S.MERCHANT].nunique(dropna=False))
        assert r.old == (g[S.TS] < last - pd.Timedelta("1h")).sum() and r.last_id == g.row_id.iloc[-1] and r.first_id == g.row_id.iloc[0]
        np.testing.assert_allclose([float(x["amount"]) for x in r["tail"]], g.Amount.tail(5), atol=1e-6)


@pytest.mark.parametrize("options", [{}, {"hot_rows": 40, "chunk_rows": 15}, {"with_merchants": False}])
def test_batch_from_profiles_equals_whole_history(spark, options):
    t = payments(spark)
    old, mid, new = stretches(t, 0.3, 0.6)
    stored = P.merge(P.build(old), P.build(mid))
    ids = new.select("row_id")
    want = B.customer_history(t, with_merchants=options.get("with_merchants", True)).join(ids, "row_id").orderBy("row_id").toPandas()
    got = B.customer_history(new, profiles=stored, **options).orderBy("row_id").toPandas()
    assert len(got) == len(want) > 300
    pd.testing.assert_frame_equal(got[want.columns], want, check_exact=True)


def test_equals_history_and_keeps_its_files(spark, tmp_path):
    rows = fixtures.payments(spark)
    old, new = rows.filter("row_id < 2"), rows.filter("row_id = 2 OR row_id = 5")
    P.save(P.build(old), str(tmp_path / "p"))
    stored, fitted = P.load(spark, str(tmp_path / "p")), {"gap_median": 1.0}
    got = B.engineer(new, fitted, profiles=stored).orderBy("row_id").toPandas()
    want = B.engineer(new, fitted, history=old).orderBy("row_id").toPandas()
    same = [c for c in got.columns if c not in ("merchant_txn_frequency", "amount_zscore_by_merchant")]  # of the batch
    pd.testing.assert_frame_equal(got[same], want[same], check_exact=True)
    assert got.customer_txn_count.tolist() == [2, 0] and got.customer_avg_amount.iloc[0] == 15.0


def test_what_is_refused_and_what_is_empty(spark):
    rows = fixtures.payments(spark)
    stored = P.build(rows.filter("row_id < 3"))
    with pytest.raises(ValueError, match="1 customers"):
        B.customer_history(rows.filter("row_id = 1"), profiles=stored)
    with pytest.raises(ValueError, match="1 customers"):
        P.merge(stored, P.build(rows.filter("row_id IN (0, 3)")))
    with pytest.raises(ValueError, match="rolling_window"):
        B.customer_history(rows.filter("row_id = 3"), rolling_window=4, profiles=stored)
    with pytest.raises(ValueError, match="settings"):
        P.merge(stored, P.build(rows.filter("row_id = 3"), rolling_window=4))
    with pytest.raises(ValueError, match="not both"):
        B.engineer(rows, history=rows, profiles=stored)
    none = P.build(rows.limit(0))
    assert none.customers.count() == 0 and rows_of(P.merge(none, stored).customers) == rows_of(stored.customers)
    a, b = B.customer_history(rows), B.customer_history(rows, profiles=none)
    assert rows_of(a) == rows_of(b)
    lost = P.build(rows.withColumn(S.USER, F.lit(None).cast("long")))
    assert lost.customers.count() == 0
