"""Quantiles, running totals, samples and look-up joins against NumPy / pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from oddspend import schema as S
from oddspend.functions import quantiles as Q, sampling
from oddspend.functions.lookup import lookup_join
from oddspend.functions.running import running_totals
from oddspend.operators import insights


def frame(spark, values, groups=None):
    g = groups if groups is not None else [0] * len(values)
    return spark.createDataFrame([(i, int(a), float(v)) for i, (a, v) in enumerate(zip(g, values))], "row_id long, g long, v double")


@pytest.mark.parametrize("kind", ["random", "ties", "heavy"])
def test_selected_quantiles_equal_numpy(spark, kind):
    rng = np.random.default_rng(1)
    v = {"random": rng.normal(0, 1, 5000), "ties": rng.integers(0, 9, 5000), "heavy": np.exp(rng.normal(0, 6, 5000))}[kind]
    df, probs = frame(spark, v), [0.0, 0.001, 0.25, 0.5, 0.98, 0.999, 1.0]
    want = np.percentile(np.asarray(v, dtype=float), [100 * p for p in probs])
    for small in (10, 300, 10_000):
        np.testing.assert_allclose(Q.exact_quantiles(df, "v", probs, small=small), want, rtol=1e-12)


def test_quantiles_are_bit_equal_at_every_size(spark):
    rng = np.random.default_rng(11)
    v = rng.normal(0, 3, 1237)
    df, probs = frame(spark, v), [i / 14 for i in range(15)]
    small = Q.exact_quantiles(df, "v", probs, small=10_000)
    assert small == Q.exact_quantiles(df, "v", probs, small=50)
    for limit in (10_000, 50):
        assert small == list(Q.grouped_quantiles(df, ["g"], "v", probs, small=limit).first()["q"])
        assert small == Q.column_quantiles(df, ["v"], probs, small=limit)["v"]


def test_integers_are_selected_without_rounding(spark):
    big = 2 ** 53
    df = spark.createDataFrame([(big + i,) for i in range(9)], "row_id long")
    assert [r.row_id - big for r in sampling.head_rows(df, 4, "row_id").orderBy("row_id").collect()] == [0, 1, 2, 3]
    assert Q.order_statistic(df, "row_id", 5, small=2) == big + 5


def test_ids_of_many_scan_partitions_hash_apart(spark):
    ids = spark.range(200_000).select(((F.col("id") % 1000) * (1 << 33) + F.floor(F.col("id") / 1000)).alias("row_id"), (F.col("id") % 2).alias("g"))
    assert ids.select(sampling.id_hash("row_id", 42)).distinct().count() > 199_900
    got = {(r.g, r.split): r["count"] for r in sampling.stratified_split(ids, "row_id", "g").groupBy("g", "split").count().collect()}
    assert got == {(0, "test"): 20_000, (1, "test"): 20_000, (0, "train"): 80_000, (1, "train"): 80_000}
    assert sampling.take_fixed(ids, 777, "row_id").count() == 777


def test_equal_hashes_are_cut_by_id(spark, monkeypatch):
    df = frame(spark, range(500))
    monkeypatch.setattr(sampling, "id_hash", lambda c, seed: F.pmod(F.col("row_id"), F.lit(3)))
    assert sampling.take_fixed(df, 200, "row_id").count() == 200
    assert sampling.stratified_split(df, "row_id", "g").filter("split = 'test'").count() == 100


def test_grouped_quantiles_with_a_hot_group(spark):
    rng = np.random.default_rng(2)
    g = np.where(rng.random(4000) < 0.6, 0, rng.integers(1, 9, 4000))
    v = rng.normal(0, 5, 4000).round(2)
    got = {r.g: (r.n, r.q) for r in Q.grouped_quantiles(frame(spark, v, g), ["g"], "v", [0.25, 0.5, 0.75], small=600).collect()}
    for k in set(g):
        assert got[k][0] == (g == k).sum()
        np.testing.assert_allclose(got[k][1], np.percentile(v[g == k], [25, 50, 75]), rtol=1e-12)


def test_a_rank_between_two_heavy_values_ends_the_search(spark):
    v = [25.0] * 600 + [26.0] * 600 + [27.0] * 3
    seen = []

    def spy(vals, targets, keys, on_range, join=Q._join_targets):
        seen.append(len(targets))
        assert len(seen) < 20, "the bracket does not shrink"
        return join(vals, targets, keys, on_range)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(Q, "_join_targets", spy)
        for data in (v[:1200], v):
            want = [float(np.percentile(data, p)) for p in (0, 49.9, 50, 100)]
            assert Q.exact_quantiles(frame(spark, data), "v", [0, 0.499, 0.5, 1], small=100) == want
            seen.clear()
            assert Q.column_quantiles(frame(spark, data), ["v"], [0, 0.499, 0.5, 1], small=100)["v"] == want
            assert seen[0] == 1  # ranks with one bracket share a pass
            seen.clear()
        assert Q.order_statistic(frame(spark, data), F.col("v").cast("long"), 599, small=100) == 25


def test_a_column_is_computed_once_for_all_passes(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def costly(x):
        made.add(1)
        return x

    df = frame(spark, range(2000)).withColumn("c", costly("v"))
    assert Q.exact_quantiles(df, "c", [0.5], small=100) == [999.5]
    assert made.value == 2000


def test_box_stats_compute_their_rows_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def costly(x):
        made.add(1)
        return x

    df = frame(spark, range(500), [i % 2 for i in range(500)]).withColumn("c", costly("v"))
    assert [r.n for r in insights.box_stats(df, "g", "c").collect()] == [250, 250]
    assert made.value == 500


def test_quantiles_skip_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "v double")
    assert Q.exact_quantiles(df, "v", [0.5]) == [2.0]
    assert Q.exact_quantiles(df.filter("v > 5 and not isnan(v)"), "v", [0.5]) == [None]


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_in_buckets(spark, descending):
    rng = np.random.default_rng(3)
    p = pd.DataFrame({"g": rng.integers(0, 3, 3000), "o": rng.permutation(3000).astype(float), "x": rng.integers(0, 5, 3000)})
    df = spark.createDataFrame(p)
    got = running_totals(df, ["g"], "o", ["x"], descending, small=200).toPandas().sort_values(["g", "o"], ascending=[True, not descending])
    want = p.sort_values(["g", "o"], ascending=[True, not descending])
    assert got.cum_x.tolist() == want.groupby("g").x.cumsum().tolist()


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_of_null_nan_and_infinite_values(spark, descending):
    values = [None, float("nan"), float("inf"), float("-inf"), 0.0, 1.0, 2.0, 3.0, 4.0, 5.0]
    df = spark.createDataFrame([(g, v, 1) for g in "ab" for v in values], "g string, o double, x long")
    whole, cut = ({(r.g, str(r.o)): r.cum_x for r in running_totals(df, ["g"], "o", ["x"], descending, small=n).collect()} for n in (100, 4))
    assert whole == cut and len(cut) == 20


def test_samples_have_exact_size_and_are_whole(spark):
    df = frame(spark, range(1000), [i % 37 for i in range(1000)])
    for k in (0, 1, 250, 1000, 5000):
        assert sampling.take_fixed(df, k, "row_id").count() == min(k, 1000)
    users = sampling.sample_users(df, "g", 0.2)
    got = users.groupBy("g").count().collect()
    assert len(got) == round(37 * 0.2)
    assert all(r["count"] == len(range(r.g, 1000, 37)) for r in got)
    assert sampling.sample_users(df, "g", 0.0001).select("g").distinct().count() == 1
    assert [r.row_id for r in sampling.head_rows(df, 3, "row_id").orderBy("row_id").collect()] == [0, 1, 2]


def test_split_is_stratified(spark):
    df = frame(spark, range(1003), [int(i % 10 == 0) for i in range(1003)])
    got = {(r.g, r.split): r["count"] for r in sampling.stratified_split(df, "row_id", "g").groupBy("g", "split").count().collect()}
    assert got == {(0, "test"): 181, (0, "train"): 721, (1, "test"): 21, (1, "train"): 80}


def test_time_split_is_ordered(spark):
    df = frame(spark, range(500))
    s = sampling.time_split(df, F.col("v").cast("long")).groupBy("split").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n"))
    got = {r.split: r for r in s.collect()}
    assert got["test"].n == 100 and got["train"].hi < got["test"].lo


def test_lookup_join_paths_agree(spark):
    keys = [None if i % 50 == 0 else ("hot" if i % 3 == 0 else f"k{i % 90}") for i in range(3000)]
    rows = spark.createDataFrame(list(enumerate(keys)), "row_id long, key string")
    table = rows.filter("key is not null and key != 'k7'").groupBy("key").agg(F.count("*").alias("w"), F.count("*").alias("n"))
    a = lookup_join(rows, table, "key", 100, "w", "row_id").select("row_id", "key", "n").orderBy("row_id").collect()
    b = lookup_join(rows, table, "key", 10**9, "w", "row_id", hot_rows=500).select("row_id", "key", "n").orderBy("row_id").collect()
    assert a == b and len(a) == 3000
