"""Whole path, sources and stream."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import fixtures
from conftest import TINY
from oddspend import schema as S
from oddspend.operators import features as B
from oddspend.plans import scoring as P
from oddspend.sources import readers, views, writers
from oddspend.streaming import profile_stream as stream
from oddspend.streaming.profile_stream import replay


@pytest.fixture(scope="module")
def prepared(spark):
    return P.prepare(fixtures.raw(spark, fixtures.card_rows(spark)))


def test_prepared_rows(spark, prepared):
    rows = prepared.rows
    assert rows.count() == 300
    parts = {r.split: r["count"] for r in rows.groupBy("split").count().collect()}
    assert sum(parts.values()) == 300 and 60 <= parts["test"] <= 62
    cols = prepared.encoder.feature_columns()
    assert len(cols) == 21 and not any(S.LABEL in c for c in cols)
    x = np.array([r.features for r in rows.select("features").collect()])
    assert x.shape == (300, 21) and np.isfinite(x).all()
    train = rows.filter("split = 'train'").agg(F.avg(S.AMOUNT)).first()[0]
    assert abs(prepared.encoder.scaler[S.AMOUNT][0] - train) < 1e-9


def test_train_compare_score_save_load(spark, prepared, tmp_path):
    opts = {"isolation_forest": {"n_estimators": 30}, "autoencoder": {"epochs": 3}}
    models = P.train_models(prepared.rows.filter("split = 'train'"), options=opts)
    report = P.training_report(models, spark).collect()
    assert {r.model for r in report} == {"isolation_forest", "autoencoder"} and all(r.n_features == 21 for r in report)
    table, pick = P.compare_models(models, prepared.rows.filter("split = 'test'"))
    assert table.count() == 2 and pick.first().recommended_model in models
    raw = fixtures.raw(spark, fixtures.card_rows(spark)[:10])
    out = P.score_transactions(raw, prepared, models, "isolation_forest").toPandas()
    assert len(out) == 10 and set(out.is_anomaly) <= {0, 1} and {"anomaly_score", "anomaly_score_normalized"} <= set(out.columns)
    with pytest.raises(ValueError, match="not available"):
        P.score_transactions(raw, prepared, models, "no_such_model")
    with pytest.raises(ValueError, match="unknown models"):
        P.train_models(prepared.rows, ["no_such_model"])
    P.save(str(tmp_path), prepared, models)
    again, loaded = P.load(spark, str(tmp_path))
    for stats in ("batch", "fitted"):
        a = P.score_transactions(raw, prepared, models, "autoencoder", stats).orderBy("row_id").toPandas()
        b = P.score_transactions(raw, again, loaded, "autoencoder", stats).orderBy("row_id").toPandas()
        np.testing.assert_allclose(a.anomaly_score, b.anomaly_score, rtol=1e-9)


def test_fitted_statistics_reproduce_training_rows(spark, prepared):
    models = P.train_models(prepared.rows, ["pca_reconstruction"])
    raw = fixtures.raw(spark, fixtures.card_rows(spark))
    a = P.score_transactions(raw, prepared, models, "pca_reconstruction", "fitted").orderBy("row_id").toPandas()
    b = models["pca_reconstruction"].score_batch(prepared.rows).orderBy("row_id").toPandas()
    np.testing.assert_allclose(a.anomaly_score, b.anomaly_score, rtol=1e-9)


def test_param_sweep(spark, prepared):
    rows = prepared.rows
    got = P.param_sweep("isolation_forest", rows.filter("split = 'train'"), rows.filter("split = 'test'"),
                        {"n_estimators": [5, 10], "max_features": [0.5, 1.0]}, 3).collect()
    assert len(got) == 3 and got == sorted(got, key=lambda r: -(r.roc_auc or 0))


def test_param_sweep_query_tries_all_declared_settings(spark, prepared, monkeypatch):
    from oddspend.plans import model_queries as M

    tried = []

    def scores(models, train, test):
        tried.extend((m.n_estimators, m.max_samples, m.max_features) for m in models)
        return test.select(F.explode(F.array(*[F.lit(str(i)) for i in range(len(models))])).alias("model"), "row_id",
                           F.rand(1).alias("score"), F.col(S.LABEL).alias("label"))

    monkeypatch.setattr(M.Q, "encoded", lambda spark, d: prepared.rows)
    monkeypatch.setattr(P, "_sweep_forests", scores)
    assert M.param_sweep(spark, "nowhere").count() == len(set(tried)) == P.SEARCH["isolation_forest"][1] == 10


def test_csv_round_trip(spark, tmp_path):
    rows = fixtures.card_rows(spark)
    path = writers.write_csv(fixtures.raw(spark, rows).drop("row_id").coalesce(1), str(tmp_path / "raw.csv"))
    df = readers.read_csv(spark, path)
    assert df.columns == [*S.RAW_COLUMNS, "row_id"] and df.count() == len(rows)
    assert {tuple(r)[:15] for r in df.collect()} == set(rows)
    assert readers.read_csv(spark, path, sample_frac=0.2).select(S.USER).distinct().count() == max(1, int(len({r[0] for r in rows}) * 0.2 + 0.5))
    assert [tuple(r)[:15] for r in readers.read_csv(spark, path, nrows=4).orderBy("row_id").collect()] == rows[:4]
    new = writers.write_csv(fixtures.raw(spark, rows).drop("row_id", S.LABEL_RAW).coalesce(1), str(tmp_path / "new.csv"))
    got = readers.read_csv(spark, new)
    assert got.columns == [*S.RAW_COLUMNS, "row_id"] and got.filter(F.col(f"`{S.LABEL_RAW}`").isNotNull()).count() == 0
    (tmp_path / "junk.csv").write_text(",".join(S.RAW_COLUMNS) + "\n" + "someone" + "," * 14 + "\n" + "1" + "," * 14 + "\n")
    assert readers.read_csv(spark, str(tmp_path / "junk.csv"), corrupt=True).cache().filter("_corrupt_record is not null").count() == 1
    with pytest.raises(FileNotFoundError):
        readers.read_csv(spark, str(tmp_path / "absent.csv"))
    with pytest.raises(FileNotFoundError):
        readers.read_table(spark, str(tmp_path / "absent"))
    bad = writers.write_csv(spark.createDataFrame([(1, 2)], "User long, Card long"), str(tmp_path / "bad.csv"))
    with pytest.raises(S.SchemaValidationError):
        readers.read_csv(spark, bad)
    empty = writers.write_csv(fixtures.raw(spark, rows).drop("row_id").limit(0).coalesce(1), str(tmp_path / "empty.csv"))
    with pytest.raises((ValueError, S.SchemaValidationError)):
        readers.read_csv(spark, empty)
    assert writers.scored_path("/d/in.csv", "m") == "/d/in_m_scored.csv"


def test_stream_equals_batch(spark):
    t = views.txn_events(spark, TINY).drop("channel", S.LABEL)
    got = replay(t).orderBy("row_id").toPandas()
    want = B.customer_history(t).orderBy("row_id").toPandas()
    assert len(got) == len(want) == 1000
    for c in got.columns[2:]:
        np.testing.assert_allclose(got[c].to_numpy(dtype=float), want[c].to_numpy(dtype=float), rtol=1e-9, atol=1e-9, err_msg=c)


def test_rows_that_arrive_out_of_order_meet_the_profile_in_order(spark):
    """Delays of up to three days within a watermark of four; times tie."""
    t = views.txn_events(spark, TINY).drop("channel", S.LABEL).filter("row_id < 300")
    t = t.withColumn(S.USER, F.col(S.USER) % 7).withColumn(S.TS, F.date_trunc("hour", S.TS).cast("timestamp_ntz"))
    got = replay(t, files=5, jitter_seconds=3 * 86_400, watermark_seconds=4 * 86_400).orderBy("row_id").toPandas()
    want = B.customer_history(t).orderBy("row_id").toPandas()
    assert len(got) == len(want) == 300
    for c in got.columns[2:]:
        np.testing.assert_allclose(got[c].to_numpy(dtype=float), want[c].to_numpy(dtype=float), rtol=1e-9, atol=1e-9, err_msg=c)


def test_state_holds_no_row_that_has_been_scored(spark, tmp_path):
    stream.use_rocksdb(spark)
    t = views.txn_events(spark, TINY).drop("channel", S.LABEL).filter("row_id < 60")
    _, root, end = stream._arrivals(t, t.columns, 3, 86_400, 2 * 86_400)
    time = F.timestamp_micros(F.lit(end)).cast(t.schema[S.TS].dataType)
    spark.range(1).select(*[(time if c == S.TS else F.lit(None).cast(t.schema[c].dataType)).alias(c) for c in t.columns]).write.parquet(f"{root}/in/part=9999")
    query = stream.score_stream(stream._read_arrivals(spark, root, t.schema), "2 days").writeStream.format("noop").option(
        "checkpointLocation", str(tmp_path)).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    waiting = spark.read.format("statestore").option("stateVarName", "waiting").load(str(tmp_path)).collect()
    assert len(waiting) <= 1 and all(r["user_map_key"]["us"] == end for r in waiting)


@pytest.mark.parametrize("jitter", [0, 86_400])
def test_model_scores_in_the_stream_equal_the_batch(spark, prepared, jitter):
    models = P.train_models(prepared.rows, ["isolation_forest"], {"isolation_forest": {"n_estimators": 20}})
    rows = fixtures.card_rows(spark)
    raw = fixtures.raw(spark, [*rows, *rows[:20]])  # repeated rows go
    got = stream.replay_scores(raw, prepared, models["isolation_forest"], 3, jitter, 2 * 86_400).orderBy("row_id").toPandas()
    want = P.score_transactions(raw, prepared, models, "isolation_forest", "fitted").orderBy("row_id").toPandas()
    assert len(got) == len(want) == 300 and set(want.columns) - set(got.columns) <= {"features", "anomaly_score_normalized"}
    for c in [*S.FEATURES, "anomaly_score", "is_anomaly", S.AMOUNT, S.LABEL]:
        np.testing.assert_allclose(got[c].to_numpy(dtype=float), want[c].to_numpy(dtype=float), rtol=1e-9, atol=1e-9, err_msg=c)
    assert got[S.CATEGORICALS].equals(want[S.CATEGORICALS]) and got[S.TS].equals(want[S.TS])


def test_csv_stream(spark, tmp_path):
    writers.write_csv(fixtures.raw(spark).drop("row_id"), str(tmp_path / "in"))
    q = readers.stream_csv(spark, str(tmp_path / "in")).writeStream.format("memory").queryName("csv_in").option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("csv_in").count() == len(fixtures.CLEAN_ROWS)


def test_release_removes_only_intermediate_tables(spark, tmp_path, monkeypatch):
    import os

    from oddspend import session

    monkeypatch.setattr(session, "_written", [])
    df = session.materialize(spark.range(5), "gone")
    kept = writers.write_table(spark.range(3), str(tmp_path / "kept"))
    path = session._written[0]
    assert df.count() == 5 and session.release(spark) == 1
    assert not os.path.exists(path.removeprefix("file:")) and spark.read.parquet(kept).count() == 3


def test_state_store_is_asked_a_few_times_a_customer(monkeypatch):
    """Not some times a payment; merchants move into more buckets and none is counted twice."""
    from types import SimpleNamespace as Fake

    from pyspark.sql import Row

    calls = []

    class Value(Fake):
        kept = None

        def get(self):
            calls.append("get")
            return self.kept

        def update(self, value):
            calls.append("update")
            self.kept = value

    class Map(dict):
        def iterator(self):
            calls.append("iterator")
            return iter(list(self.items()))

        def __getattr__(self, name):
            do = {"updateValue": self.__setitem__, "removeKey": self.__delitem__, "containsKey": self.__contains__, "getValue": self.__getitem__}[name]
            return lambda *x: calls.append(name) or do(*x)

    count = lambda *x: calls.append("timer")
    monkeypatch.setattr(stream, "BUCKET", 40, raising=False)
    profile = stream.CustomerProfile()
    profile.init(Fake(getValueState=lambda *x: Value(), getMapState=lambda *x: Map(), registerTimer=count, deleteTimer=count))
    rows = [Row(row_id=i, us=i * 10_000_000, micro=1_000_000 + i, merchant=(i % 300) * 1024, row=None) for i in range(900)]
    seen, now = [], Fake(getCurrentWatermarkInMs=lambda: -1)
    for at in (0, 300, 600, 900):
        seen += profile.handleInputRows((7,), iter(rows[at:at + 300]), now) if at < 900 else profile.handleExpiredTimer((7,), now, None)
        now = Fake(getCurrentWatermarkInMs=lambda at=at: (at + 300) * 10_000 - 1)
    assert [r.row_id for r in seen] == list(range(900)) and len(calls) < 100
    assert [r.merchant_diversity for r in seen] == [min(i, 300) for i in range(900)]
    assert [r.transaction_velocity for r in seen] == [min(i, 360) for i in range(900)]
    assert len(profile.merchants) == 8 and sum(len(v[0]) for v in profile.merchants.values()) == 300 and not profile.waiting


def _written_by(build):
    """Names of the intermediate tables a call writes, with their columns."""
    from oddspend import session

    first = len(session._written)
    build()
    return {p.rsplit("/", 1)[-1].rsplit("-", 1)[0]: p for p in session._written[first:]}


def test_shared_rows_are_not_copied_for_arithmetic(spark):
    from oddspend.plans import queries as Q

    folder = f"{TINY}/"  # a key of its own, so that the tables are built here
    names = _written_by(lambda: Q.encoded(spark, folder))
    assert not {"card", "card_split", "encoded"} & set(names)
    kept = spark.read.parquet(names["looked_up"]).columns
    assert "features" not in kept and not [c for c in kept if c.endswith("_scaled")]
    a = Q.encoded(spark, folder).select("row_id", "split", "features").orderBy("row_id").toPandas()
    b = Q.encoder(spark, folder).matrix(Q.card_split(spark, folder)).select("row_id", "split", "features").orderBy("row_id").toPandas()
    assert len(a) > 0 and a["row_id"].equals(b["row_id"]) and a["split"].equals(b["split"])
    assert [list(x) for x in a["features"]] == [list(x) for x in b["features"]]


def test_scores_are_written_without_their_inputs(spark):
    from oddspend.plans import model_queries as M, queries as Q

    Q.encoded(spark, TINY), M.model(spark, TINY, "pca_reconstruction")
    names = _written_by(lambda: M._scores("pca_reconstruction")(spark, TINY))
    assert set(spark.read.parquet(names["scored"]).columns) == {"row_id", "split", "anomaly_score"}
    m = M.model(spark, TINY, "pca_reconstruction")
    whole = m.score_batch(Q.encoded(spark, TINY)).orderBy("row_id").toPandas()
    short = m.score_batch(Q.encoded(spark, TINY), keep_features=False).orderBy("row_id").toPandas()
    assert "features" in whole and "features" not in short
    assert whole.drop(columns="features").equals(short)
