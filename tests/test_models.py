import numpy as np
import pytest
from pyspark.sql import functions as F

import fixtures
from oddspend.operators import evaluate as A, explain as X
from oddspend.operators.knn import knn
from oddspend.operators.models.iforest import IsolationForest, path_length
from oddspend.operators.models.lof import LocalOutlierFactor
from oddspend.operators.neighbour_graph import measured_recall, neighbour_graph
from oddspend.operators.models.base import matrix_udf
from oddspend.operators.models.ocsvm import OneClassSvm
from oddspend.plans.scoring import MODELS

OPTIONS = {"autoencoder": {"epochs": 15, "batch_size": 32, "learning_rate": 0.005},
           "pca_reconstruction": {"components": 2, "contamination": 0.05}, "local_outlier_factor": {"contamination": 0.05},
           "one_class_svm": {"nu": 0.05}, "isolation_forest": {"n_estimators": 60}}


@pytest.fixture(scope="module")
def data(spark):
    return fixtures.shifted_vectors(spark).repartition(4).cache()


@pytest.mark.parametrize("name", sorted(MODELS))
def test_contract(spark, data, name, tmp_path):
    model = MODELS[name](**OPTIONS.get(name, {}))
    with pytest.raises(RuntimeError):
        model.predict(data)
    # fitted on normal rows only where few outliers would be learned as normal
    model.fit(data if name not in ("pca_reconstruction", "autoencoder", "local_outlier_factor", "one_class_svm", "mahalanobis")
              else data.filter("is_fraud = 0"))
    out = model.score_batch(data).orderBy("row_id").toPandas()
    assert len(out) == 312 and set(out.is_anomaly) <= {0, 1}
    assert out.anomaly_score_normalized.min() == 0 and out.anomaly_score_normalized.max() == 1
    assert (out.is_anomaly == (out.anomaly_score >= model.threshold)).all()
    long = model.score(data).select(F.lit(name).alias("model"), "row_id", F.col("anomaly_score").alias("score"), F.col("is_fraud").alias("label"))
    assert A.auc_metrics(long).first().roc_auc >= 0.95
    model.save(spark, str(tmp_path))
    again = MODELS[name].load(spark, str(tmp_path)).score_batch(data).orderBy("row_id").toPandas()
    np.testing.assert_allclose(again.anomaly_score, out.anomaly_score, rtol=1e-9, atol=1e-12)
    assert (again.is_anomaly == out.is_anomaly).all()
    assert model.params()["n_features"] == 6


def test_constant_batch_normalizes_to_zero(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(30)], "row_id long, features array<double>")
    m = IsolationForest(n_estimators=5).fit(df)
    assert {r.anomaly_score_normalized for r in m.score_batch(df).collect()} == {0.0}


def test_path_length():
    assert path_length(1) == 0 and path_length(2) == 1
    assert abs(path_length(256) - 10.2448) < 1e-3


def test_forest_depth_counts_isolated_row_first(spark, data):
    m = IsolationForest(n_estimators=80)
    m.n_features = 6
    m._fit(data)
    assert len(m.trees["roots"]) == 80
    got = m.raw_score(data).groupBy("is_fraud").agg(F.avg("_raw").alias("s")).collect()
    s = {r.is_fraud: r.s for r in got}
    assert 0 < s[0] < s[1] < 1


def test_large_samples_grow_over_all_tasks(spark, data, monkeypatch):
    """Trees on half of the rows, with groups so small that most levels are split by aggregates."""
    import oddspend.operators.models.iforest as mod

    monkeypatch.setattr(mod, "GROUP", 10)
    copies = data.unionByName(data.filter("row_id < 40").withColumn("row_id", F.col("row_id") + 1000).withColumn(
        "features", F.array(*[F.lit(0.5)] * 6)))  # many rows that no split can part
    m = IsolationForest(n_estimators=40, max_samples=0.5).fit(copies)
    assert len(m.trees["roots"]) == 40
    s = {r.is_fraud: r.s for r in m.raw_score(data).groupBy("is_fraud").agg(F.avg("_raw").alias("s")).collect()}
    assert 0 < s[0] < s[1] < 1


@pytest.mark.parametrize("group", [10, 100])
def test_every_tree_gets_its_sample_whole(spark, monkeypatch, group):
    """Exactly max_samples rows a tree, on a table much larger than all samples."""
    import oddspend.operators.models.iforest as mod

    seen = []
    monkeypatch.setattr(mod, "GROUP", group)
    monkeypatch.setattr(mod, "CELL_BITS", 2)
    rows = spark.range(3000).select(F.col("id").alias("row_id"), F.array(F.rand(1), F.rand(2)).alias("features"))
    upper = IsolationForest._upper_levels
    monkeypatch.setattr(IsolationForest, "_upper_levels", lambda self, x, *a: seen.append({r[0]: r[1] for r in x.groupBy("tree").count().collect()}) or upper(self, x, *a))
    m = IsolationForest(n_estimators=4, max_samples=60)
    m.n_features = 2
    m._fit(rows)
    assert len(m.trees["roots"]) == 4
    assert seen == ([] if group == 100 else [{k: 60 for k in range(4)}])


def test_default_search_space_runs_at_any_size(spark, data, monkeypatch):
    import oddspend.operators.models.iforest as mod
    from oddspend.plans import scoring

    monkeypatch.setattr(mod, "GROUP", 100)
    settings = scoring.SEARCH["isolation_forest"][0]
    small = {**settings, "n_estimators": [5]}
    assert scoring.param_sweep("isolation_forest", data, data, small, 9).count() == 9


def test_node_table_scores_as_the_collected_forest(spark, data, monkeypatch, tmp_path):
    """The same draws, once as groups of whole trees, once as a table of nodes: every part of a
    tree is drawn with a generator of its own, so the means agree, and paths are those of the table."""
    import oddspend.operators.models.iforest as mod

    whole = IsolationForest(n_estimators=60, max_samples=0.8)
    whole.n_features = 6
    whole._fit(data)
    assert whole.nodes is None
    monkeypatch.setattr(mod, "GROUP", 25)
    table = IsolationForest(n_estimators=60, max_samples=0.8).fit(data)
    assert table.nodes is not None and set(table.trees) == {"roots", "shape"}
    upper, parts = ([r.asDict() for r in x.collect()] for x in table.nodes)
    splits, below = {(r["tree"], r["node"]): r for r in upper}, {(r["tree"], r["node"]): r for r in parts}
    got = {r.row_id: r._raw for r in table.raw_score(data).collect()}
    rows = data.collect()
    assert len(got) == len(rows)
    for r in rows[::17]:
        total = 0.0
        for tree in range(60):
            node = 0
            while (tree, node) in splits and splits[tree, node]["j"] >= 0:
                s = splits[tree, node]
                node = 2 * node + (1 if r.features[s["j"]] <= s["cut"] else 2)
            level = (node + 1).bit_length() - 1
            if (tree, node) in splits:
                total += level + float(path_length(splits[tree, node]["n"]))
            elif (tree, node) in below:
                b, at = below[tree, node], 0
                while b["feature"][at] >= 0:
                    at = b["left" if r.features[b["feature"][at]] <= b["split"][at] else "right"][at]
                total += b["value"][at]
            else:
                total += level
        assert abs(got[r.row_id] - 2.0 ** (-total / 60 / float(path_length(table.trees["shape"][1])))) < 1e-9
    a = np.array([got[r.row_id] for r in rows])
    b = np.array([x._raw for x in whole.raw_score(data).select("row_id", "_raw").orderBy("row_id").collect()])
    a = a[np.argsort([r.row_id for r in rows])]
    assert np.corrcoef(a, b)[0, 1] > 0.95
    table.save(spark, str(tmp_path))
    again = {r.row_id: r.anomaly_score for r in IsolationForest.load(spark, str(tmp_path)).score(data).collect()}
    assert all(abs(again[r.row_id] - r.anomaly_score) < 1e-9 for r in table.score(data).collect())


@pytest.mark.parametrize("group", [8192, 60])
def test_settings_grown_together_score_as_grown_alone(spark, data, monkeypatch, group):
    import oddspend.operators.models.iforest as mod

    monkeypatch.setattr(mod, "GROUP", group)
    settings = [{"n_estimators": 5}, {"n_estimators": 8, "max_samples": 0.5}, {"n_estimators": 8, "max_samples": 0.5, "max_features": 0.5}, {"n_estimators": 6, "max_samples": 20}]
    together, alone = ([IsolationForest(**x) for x in settings] for _ in range(2))
    for f in [*together, *alone]:
        f.n_features = 6
    mod.grow(data, together)
    got = {r.row_id: r.scores for r in mod.score_together(data, together).collect()}
    for k, f in enumerate(alone):
        f._fit(data)
        assert all(abs(got[r.row_id][k] - r._raw) < 1e-9 for r in f.raw_score(data).collect())


def test_svm_flags_about_nu_of_the_training_rows(spark, data):
    m = OneClassSvm(nu=0.1, contamination=0.1)
    normal = data.filter("is_fraud = 0")
    m.fit(normal)
    share = m.raw_score(normal).agg(F.avg((F.col("_raw") > 0).cast("double"))).first()[0]
    assert abs(share - 0.1) <= 0.02


def test_autoencoder_errors_and_history(spark, data):
    m = MODELS["autoencoder"](epochs=4, batch_size=32).fit(data)
    e = m.feature_errors(data).join(m.score(data).select("row_id", "anomaly_score"), "row_id").collect()
    assert all(len(r.feature_errors) == 6 for r in e)
    np.testing.assert_allclose([np.mean(r.feature_errors) for r in e], [r.anomaly_score for r in e], rtol=1e-9)
    assert [h[0] for h in m.history] == [0, 1, 2, 3] and all(h[1] > 0 and h[2] > 0 for h in m.history)
    assert m.history[-1][2] < m.history[0][2]
    worst = X.reconstruction_breakdown(m.feature_errors(data), [f"f{i}_scaled" for i in range(6)], 2)
    assert worst.count() == 624


def test_autoencoder_gradient():
    from oddspend.operators.models.autoencoder import Net

    rng = np.random.default_rng(0)
    net = Net([3, 4, 2, 3], 0.0)
    flat, x = net.start(rng), rng.normal(size=(7, 3))
    _, g = net.gradient(flat.copy(), x, rng)
    for i in rng.choice(net.trainable, 20, replace=False):
        up, down = flat.copy(), flat.copy()
        up[i] += 1e-6
        down[i] -= 1e-6
        num = (net.gradient(up, x, rng)[0] - net.gradient(down, x, rng)[0]) / 2e-6
        assert abs(num - g[i]) < 1e-6


def test_levels_grow_as_nodes_one_by_one(spark):
    """The same forest in distribution, complete trees, and no Python step for every node."""
    from oddspend.operators.models import iforest as mod

    rng = np.random.default_rng(1)
    x = np.stack([rng.normal(size=900), rng.integers(0, 3, 900), np.ones(900), rng.exponential(size=900)], axis=1)
    x[:100] = x[0]
    columns, calls = np.arange(4), []

    class Counted:
        def __init__(self, seed):
            self.rng = np.random.default_rng(seed)

        def __getattr__(self, name):
            calls.append(name)
            return getattr(self.rng, name)

    def depths(found):
        f, s, left, right, v = (np.asarray(c) for c in found)
        tree = {"roots": [0], "feature": np.where(f < 0, 0, f), "split": np.where(f < 0, np.inf, s), "child": np.stack([left, right], axis=1).ravel(), "value": v}
        return mod.forest_depths(x, depth=12, **tree)

    one = np.mean([depths(zip(*mod.grow_tree(x, np.random.default_rng(i), 2, 10, columns))) for i in range(150)], axis=0)
    levels = [mod.grow_levels(x, np.random.default_rng(i), 2, 10, columns) for i in range(150)]
    many = np.mean([depths(f) for f in levels], axis=0)
    assert np.corrcoef(one, many)[0, 1] > 0.95 and abs(one.mean() / many.mean() - 1) < 0.03
    for f, _, left, right, _ in levels[:5]:
        inner = f >= 0
        assert sorted([0, *left[inner], *right[inner]]) == list(range(len(f))) and 2 not in f
    nodes = len(mod.grow_levels(x, Counted(0), 2, 10, columns)[0])
    assert nodes > 100 and len(calls) < 80
    assert [len(c) for c in mod.grow_levels(np.ones((5, 2)), rng, 1, 9, np.arange(2))] == [1] * 5


def test_rows_of_large_samples_are_written_once_and_not_once_a_tree(spark, data, monkeypatch):
    from oddspend.operators.models import iforest as mod

    written, real = [], mod.materialize

    def counted(df, *a, **options):
        table = real(df, *a, **options)
        written.append(table.count())
        return table

    monkeypatch.setattr(mod, "GROUP", 25)
    monkeypatch.setattr(mod, "materialize", counted)
    m = mod.IsolationForest(n_estimators=12, max_samples=0.5)
    m.n_features = 6
    m._fit(data)
    assert m.nodes[0].count() > 12 and max(written) <= data.count()


def test_autoencoder_packs_every_row_once():
    import pyarrow as pa

    from oddspend.operators.models import autoencoder as mod

    x, held = np.arange(42.0).reshape(14, 3), np.arange(14) % 4 == 0
    batches = [pa.RecordBatch.from_pydict({"features": x[i:j].tolist(), "held": held[i:j]}) for i, j in ((0, 9), (9, 10), (10, 14))]
    blocks = list(mod._pack(iter(batches)))
    got = [np.concatenate([v for b in blocks for v in mod._unpacked(b.column(i), 3)]) for i in (0, 1)]
    np.testing.assert_array_equal(got[0], x[~held])
    np.testing.assert_array_equal(got[1], x[held])


def test_autoencoder_gradient_in_single_precision():
    """Steps run in the precision of the weights, with the same draws and the same result up to rounding."""
    from oddspend.operators.models.autoencoder import Net

    rng = np.random.default_rng(0)
    net = Net([5, 8, 4, 8, 5], 0.3)
    flat, x = net.start(rng), rng.normal(size=(64, 5))
    loss, g = net.gradient(flat.copy(), x, np.random.default_rng(1))
    small = flat.astype(np.float32)
    low, h = net.gradient(small, x.astype(np.float32), np.random.default_rng(1))
    assert h.dtype == small.dtype == np.float32 and g.dtype == float
    np.testing.assert_allclose(h, g, atol=1e-5)
    assert abs(low - loss) < 1e-5


def brute_knn(x, k):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    np.fill_diagonal(d, np.inf)
    order = np.argsort(d, axis=1, kind="stable")[:, :k]
    return order, np.take_along_axis(d, order, 1)


@pytest.mark.parametrize("block", [16, 70, 1000])
def test_knn_blocks_equal_brute_force(spark, block):
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (300, 4)) + rng.integers(0, 3, (300, 1)) * 10
    x[100:160] = x[100]  # a group of copies
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "row_id long, features array<double>")
    got = knn(df, df, 6, block_rows=block).orderBy("id", "rank").toPandas()
    order, dist = brute_knn(x, 6)
    assert (got.nbr.to_numpy().reshape(300, 6) == order).all()
    np.testing.assert_allclose(got.dist.to_numpy().reshape(300, 6), dist, rtol=1e-12, atol=1e-12)


def test_knn_meetings_emit_only_rows_within_reach(spark, monkeypatch):
    from oddspend.operators import knn as K

    rng, n, k = np.random.default_rng(3), 1500, 5
    x = np.repeat(rng.normal(0, 50, (10, 6)), n // 10, axis=0) + rng.normal(0, 1, (n, 6))
    x[::50] = x[0]  # equal distances
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "row_id long, features array<double>")
    emitted, real = spark.sparkContext.accumulator(0), K._neighbours

    def counted(*options):
        meet = real(*options)

        def run(q, r):
            out = meet(q, r)
            emitted.add(out.num_rows)
            return out

        return run

    monkeypatch.setattr(K, "_neighbours", counted)
    got = {}
    for r in K.knn(df, df, k, block_rows=30).collect():
        got.setdefault(r.id, {})[r["rank"]] = r.nbr
    d = np.zeros((n, n))
    for c in range(6):
        d += (x[:, None, c] - x[None, :, c]) ** 2
    d = np.sqrt(d)
    for i in range(n):
        order = [j for j in np.lexsort((np.arange(n), d[i])) if j != i][:k]
        assert [got[i][q] for q in range(1, k + 1)] == order
    assert emitted.value < 4 * k * n  # a block of every meeting gave k before: over 10 k n


def test_knn_sends_a_query_only_where_its_reach_goes(spark, monkeypatch):
    """A query came to every block of every cell the pivots could not rule out; now to pieces whose box it reaches."""
    from oddspend.operators import knn as K

    x = np.random.default_rng(6).uniform(0, 100, (3000, 2))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "row_id long, features array<double>")
    sent, real = spark.sparkContext.accumulator(0), K._neighbours

    def counted(*options):
        meet = real(*options)

        def run(q, r):
            sent.add(sum(len(v) for v in q.column("ids").to_pylist()) // 8)
            return meet(q, r)

        return run

    monkeypatch.setattr(K, "_neighbours", counted)
    got = K.knn(df, df, 4, block_rows=100).orderBy("id", "rank").toPandas()
    assert (got.nbr.to_numpy().reshape(3000, 4) == brute_knn(x, 4)[0]).all()
    assert 0 < sent.value < 2 * 3000


def test_knn_of_copies_that_no_region_can_part(spark, monkeypatch):
    """More copies than a region may hold lie in several pieces, and pairs are trimmed on the way."""
    from oddspend.operators import knn as K

    rng = np.random.default_rng(8)
    x = np.concatenate([np.ones((500, 3)), rng.normal(0, 1e6, (200, 3)), rng.normal(0, 1e17, (60, 3))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(900, [0.0, float("nan"), 1.0])], "row_id long, features array<double>")
    monkeypatch.setattr(K, "QUERIES", 40)
    got = K.knn(df, df, 5, block_rows=60).orderBy("id", "rank").toPandas()
    order, dist = brute_knn(x, 5)
    assert (got.nbr.to_numpy().reshape(760, 5) == order).all()
    np.testing.assert_allclose(got.dist.to_numpy().reshape(760, 5), dist, rtol=1e-12)
    monkeypatch.setattr(K, "HELD", 1000)
    monkeypatch.setattr(K, "LEAF", 16)
    for reach in (np.inf, 2e6):
        i, j, near = K._nearest(x, x, 6, np.full(760, reach))
        for q in range(0, 760, 7):
            mine, full = near[i == q], np.sort(np.sqrt(((x - x[q]) ** 2).sum(axis=1)))[:6]
            np.testing.assert_allclose(mine, full[full <= reach], rtol=1e-12)


def test_rows_that_are_not_finite_are_no_neighbours():
    from oddspend.operators.knn import _nearest

    y = np.array([[0.0], [np.nan], [1.0], [3.0]])
    i, j, dist = _nearest(np.array([[0.0], [np.nan]]), y, 4, np.array([2.0, 2.0]))
    assert (i.tolist(), j.tolist(), dist.tolist()) == ([0, 0], [0, 2], [0.0, 1.0])


def test_neighbour_graph_against_brute_force(spark):
    """Clusters in 12 dimensions and a quarter of exact copies, in many small blocks."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(10, 12))[rng.integers(10, size=1200)] * 3 + rng.normal(size=(1200, 12))
    x[900:] = x[0]
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "row_id long, features array<double>")
    g = neighbour_graph(df.union(df.limit(1).selectExpr("cast(null as long) row_id", "features")), 8, block=64)
    got = g.edges.orderBy("id", "rank").toPandas()
    assert len(got) == 1200 * 8 and not (got.id == got.nbr).any() and not got.duplicated(["id", "nbr"]).any()
    assert np.allclose(got.dist, np.sqrt(((x[got.id] - x[got.nbr]) ** 2).sum(axis=1)))
    far = brute_knn(x, 8)[1][:, -1]
    recall = (got.dist.to_numpy() <= far[got.id] * (1 + 1e-9)).mean()
    assert recall >= 0.95 and g.changed <= 0.002
    assert abs(measured_recall(g.edges, df, 8, queries=1200) - recall) < 1e-9


@pytest.mark.parametrize("n", [0, 1, 3])
def test_neighbour_graph_of_few_rows(spark, n):
    df = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(n)], "row_id long, features array<double>")
    assert neighbour_graph(df, 5).edges.count() == n * (n - 1)


def test_lof_equals_definition(spark, data):
    rows = data.orderBy("row_id").collect()
    x = np.array([r.features for r in rows])
    order, dist = brute_knn(x, 10)
    kd = dist[:, -1]
    lrd = 1 / (np.maximum(dist, kd[order]).mean(1) + 1e-10)
    want = lrd[order].mean(1) / lrd
    m = LocalOutlierFactor(n_neighbors=10, block_rows=64).fit(data)
    got = m.raw_score(data).orderBy("row_id").toPandas()._raw
    np.testing.assert_allclose(got, want, rtol=1e-9)


def test_permutation_importance_of_a_linear_score(spark, data):
    def score(df):
        return df.withColumn("anomaly_score", 3.0 * F.get("features", F.lit(0)) + F.get("features", F.lit(1)))

    names = ["a_scaled", "b_freq", "c", "d", "e", "f"]
    got = X.permutation_importance(data, names, score).collect()
    assert [r.feature for r in got[:2]] == ["a_scaled", "b_freq"] and [r.base_feature for r in got[:2]] == ["a", "b"]
    assert all(r.importance == 0 for r in got[2:])
    # a column is shuffled: every value appears exactly once per repeat
    x = np.array([r.features[0] for r in data.collect()])
    expected = 3 * np.abs(x[:, None] - x[None]).mean()
    assert abs(got[0].importance - expected) < 0.25 * expected


def test_forest_effects_equal_scoring_every_swapped_row(spark, data):
    m = IsolationForest(n_estimators=20).fit(data)
    names = [f"x{i}" for i in range(m.n_features)]
    calls = []

    def score(rows):
        calls.append(rows)
        return m.score(rows)

    slow = {r.feature: r.importance for r in X.permutation_importance(data, names, score).collect()}
    assert calls
    calls.clear()
    fast = {r.feature: r.importance for r in X.permutation_importance(data, names, score, effects=m.swap_effects(spark)).collect()}
    assert not calls and set(fast) == set(names)
    for name in names:
        assert fast[name] == pytest.approx(slow[name], rel=1e-9, abs=1e-15)


def test_svm_maps_the_rows_twice_a_step(spark, data, monkeypatch):
    passes = []
    real = OneClassSvm._map

    def counted(self):
        passes.append(1)
        return real(self)

    monkeypatch.setattr(OneClassSvm, "_map", counted)
    rows = spark.sparkContext.accumulator(0)

    def counting(self, w):
        z = real(self)

        def project(x):
            rows.add(len(x))
            return z(x) @ w

        return matrix_udf(project)

    monkeypatch.setattr(OneClassSvm, "_projection", counting)
    m = OneClassSvm(nu=0.1, max_steps=3)
    m.n_features = len(data.first().features)
    m._fit(data)
    steps = len(passes) - 1  # one mean map of all rows, then one a step
    assert rows.value == data.count() * (steps + 1)  # a projection a step, and that of rho


def test_svm_screens_rows_in_single_precision_and_keeps_double_results():
    """Projections that may lie below the bound are those of double precision; the others lie above it."""
    from oddspend.operators.models.ocsvm import _screened

    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(3000, 5)), rng.normal(size=(20, 5)) * 1e5, [[np.nan] * 5, [1e300] * 5]])
    freq, phase, w = rng.normal(size=(5, 64)), rng.uniform(0, 6, 64), rng.normal(size=64)
    full = np.sqrt(2 / 64) * np.cos(x @ freq + phase) @ w
    bound = np.nanquantile(full, 0.1)
    got = _screened(freq, phase, np.sqrt(2 / 64))(x, w, bound)
    low = full <= bound
    np.testing.assert_allclose(got[low], full[low], rtol=1e-12, atol=1e-13)
    assert (got[~low & np.isfinite(full)] > bound).all() and np.isnan(got[-2])
    assert (np.abs(got - full)[~np.isnan(full)] > 1e-12).mean() > 0.8


def test_svm_fit_does_not_depend_on_the_probe(spark, data, monkeypatch):
    import oddspend.operators.models.ocsvm as mod

    def fitted(bound=None):
        m = OneClassSvm(nu=0.1, max_steps=4)
        m.n_features = len(data.first().features)
        if bound is not None:
            monkeypatch.setattr(mod.OneClassSvm, "_bound", lambda self, w: bound)
        m._fit(data)
        return m

    a, b, c = fitted(), fitted(np.inf), fitted(-1e9)  # guessed, all in double precision, too low a guess
    for m in (b, c):
        np.testing.assert_allclose(m.weights, a.weights, rtol=1e-12, atol=1e-14)
        assert abs(m.rho - a.rho) < 1e-12


def test_svm_of_equal_rows_keeps_its_mean(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0, 3.0]) for i in range(300)], "row_id long, features array<double>")
    m = OneClassSvm(nu=0.1)
    m.n_features = 3
    m._fit(same)
    assert m.converged and abs(m.rho - float(m.weights @ m.weights)) < 1e-9


def test_neighbour_graph_sends_a_vector_once_a_group():
    """A vector in every meeting of a group comes once, and no more than k rows an id go out."""
    import pyarrow as pa
    from oddspend.operators.neighbour_graph import _meet

    x = np.random.default_rng(7).normal(size=(12, 3)).astype(np.float32)
    hosts = [[100, 101, 102]] * 6 + [[101]] * 6
    rows = pa.table({"id": pa.array(range(12), pa.int64()), "features": pa.array(x.tolist(), pa.list_(pa.float32())),
                     "kdist": pa.array([np.inf] * 12), "hosts": pa.array(hosts, pa.list_(pa.int64()))})
    got = _meet(2)(rows).to_pandas()
    gap = np.sqrt(((x[:, None].astype(float) - x[None].astype(float)) ** 2).sum(axis=2))
    np.fill_diagonal(gap, np.inf)
    want = {(i, int(j)) for i in range(12) for j in np.argsort(gap[i])[:2]}
    assert set(zip(got.id, got.nbr)) == want and len(got) == 24
    assert np.allclose(got.dist, gap[got.id, got.nbr], rtol=1e-15)


def test_neighbour_graph_rounds_single_precision_only_where_exact(spark):
    from oddspend.operators.neighbour_graph import _single

    exact = spark.createDataFrame([(1, [0.5, float("nan")])], "id long, features array<double>")
    other = spark.createDataFrame([(1, [0.5, 0.1])], "id long, features array<double>")
    assert _single(exact).schema["features"].dataType.elementType.typeName() == "float"
    assert _single(other).schema["features"].dataType.elementType.typeName() == "double"
