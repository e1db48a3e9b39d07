"""Registered queries that fit or apply a model."""

import zlib

from pyspark.sql import functions as F

from oddspend import schema as S
from oddspend.operators import explain as X
from oddspend.operators.encode import Encoder
from oddspend.operators.knn import knn
from oddspend.operators.neighbour_graph import neighbour_graph as near_graph
from oddspend.operators.models.iforest import IsolationForest
from oddspend.operators.models.linear import Mahalanobis
from oddspend.operators.models.lof import LocalOutlierFactor, outlier_factor
from oddspend.plans import queries as Q, reports, scoring as P
from oddspend.session import materialize, on_release, shared_dir
from oddspend.sources import readers, views, writers

_fitted: dict = {}
on_release(_fitted.clear)


def model(spark, d, name):
    """Model fitted on the training rows, once per session and folder."""
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _fitted:
        _fitted[key] = P.MODELS[name]().fit(Q.encoded(spark, d).filter("split = 'train'"))
    return _fitted[key]


def _scores(name):
    def run(spark, d):
        m = model(spark, d, name)
        return m.score_batch(Q.encoded(spark, d).select(S.ROW_ID, "split", "features"), keep_features=False).select(
            S.ROW_ID, "split", F.round("anomaly_score", 6).alias("anomaly_score"),
            F.round("anomaly_score_normalized", 6).alias("anomaly_score_normalized"), "is_anomaly")
    return run


def knn_edges(spark, d):
    v = materialize(views.vectors(spark, d), "vectors")
    return knn(v, v, 35).select("id", "nbr", "rank", F.round("dist", 6).alias("dist"))


def neighbour_graph(spark, d):
    return near_graph(views.vectors(spark, d), 35).edges.select("id", "nbr", "rank", F.round("dist", 6).alias("dist"))


def lof_score(spark, d):
    m = LocalOutlierFactor().fit(views.vectors(spark, d))
    own = m.reference
    return outlier_factor(m._edges, own, own, m._n).select(F.col("id").alias(S.ROW_ID), F.round("lof", 6).alias("lof"))


def mahalanobis_score(spark, d):
    f = Q.features(spark, d).select(S.ROW_ID, F.array(S.AMOUNT, "rolling_avg_amount").alias("features"))
    m = Mahalanobis()
    m.n_features = 2
    m._fit(f)
    return m.raw_score(f).select(S.ROW_ID, F.round("_raw", 5).alias("distance"))


def train_models(spark, d):
    names = [n for n in P.MODELS if n != "mahalanobis"]
    return P.training_report({n: model(spark, d, n) for n in names}, spark)


def compare_models(spark, d):
    names = [n for n in P.MODELS if n != "mahalanobis"]
    return P.compare_models({n: model(spark, d, n) for n in names}, Q.encoded(spark, d).filter("split = 'test'"))[0]


def recommendation(spark, d):
    models = {n: model(spark, d, n) for n in P.DEFAULT_MODELS}
    return P.compare_models(models, Q.encoded(spark, d).filter("split = 'test'"))[1]


def score_batch(spark, d):
    """New rows without a label, read from a CSV file and scored with the encoder and the
    forest as they were saved; the scored rows are written as CSV and read back."""
    folder = f"{shared_dir(spark)}/scoring-{spark.sparkContext.applicationId}-{zlib.crc32(d.encode())}"
    source = writers.write_csv(views.raw_card(spark, d).drop(S.LABEL_RAW, S.ROW_ID), f"{folder}/new.csv")
    Q.encoder(spark, d).save(f"{folder}/encoder")
    model(spark, d, "isolation_forest").save(spark, f"{folder}/forest")
    prepared = P.Prepared(Q.encoded(spark, d), Encoder.load(spark, f"{folder}/encoder"), None, 0.0, None, 0)
    models = {"isolation_forest": IsolationForest.load(spark, f"{folder}/forest")}
    out = P.score_transactions(readers.read_csv(spark, source), prepared, models, "isolation_forest", keep_features=False)
    path = writers.write_csv(out, writers.scored_path(source, "isolation_forest"))
    return spark.read.schema(out.schema).option("header", True).csv(path)


def written_reports(spark, d):
    """Every report of the run, written and read back: (report, rows)."""
    folder = f"{shared_dir(spark)}/reports-{spark.sparkContext.applicationId}-{zlib.crc32(d.encode())}"
    models = {n: model(spark, d, n) for n in P.DEFAULT_MODELS}
    paths = reports.write_reports(folder, views.raw_card(spark, d), models, Q.encoded(spark, d).filter("split = 'test'"))
    rows = [(name, (spark.read.json(p) if not p.endswith(".csv") else spark.read.option("header", True).csv(p)).count()) for name, p in paths.items()]
    return spark.createDataFrame(rows, "report string, rows long")


def param_sweep(spark, d):
    """The declared search: as many settings as it names, drawn from its grid."""
    e = Q.encoded(spark, d)
    return P.param_sweep("isolation_forest", e.filter("split = 'train'"), e.filter("split = 'test'"))


def permutation_importance(spark, d):
    m = model(spark, d, "isolation_forest")
    return X.permutation_importance(Q.encoded(spark, d), Q.encoder(spark, d).feature_columns(), m.score, effects=m.swap_effects(spark))


def _worst(spark, d):
    m = model(spark, d, "autoencoder")
    flagged = m.predict(Q.encoded(spark, d)).filter("is_anomaly = 1")
    return materialize(m.feature_errors(flagged).select(S.ROW_ID, "feature_errors"), "errors"), Q.encoder(spark, d).feature_columns()


def stream_score(spark, d):
    from oddspend.streaming.profile_stream import replay

    return replay(views.txn_events(spark, d).drop("channel", S.LABEL))


def stream_model_score(spark, d):
    """Raw rows that arrive up to half an hour late, through the customer profiles and the fitted forest."""
    from oddspend.streaming.profile_stream import replay_scores

    fit = P.prepare(views.raw_card(spark, d))
    forest = IsolationForest(n_estimators=50).fit(fit.rows.filter("split = 'train'"))
    found = replay_scores(views.raw_card(spark, d), fit, forest, jitter_seconds=1800)
    return found.select(S.ROW_ID, S.USER, *S.FEATURES, "anomaly_score", "is_anomaly")


def model_queries() -> dict:
    return {
        "knn_edges": knn_edges,
        "neighbour_graph": neighbour_graph,
        "lof_score": lof_score,
        "mahalanobis_score": mahalanobis_score,
        "iforest_score": _scores("isolation_forest"),
        "local_density_score": _scores("local_outlier_factor"),
        "ocsvm_score": _scores("one_class_svm"),
        "autoencoder_score": _scores("autoencoder"),
        "pca_reconstruction": _scores("pca_reconstruction"),
        "robust_covariance_score": _scores("elliptic_envelope"),
        "train_models": train_models,
        "compare_models": compare_models,
        "recommendation": recommendation,
        "score_batch": score_batch,
        "written_reports": written_reports,
        "param_sweep": param_sweep,
        "permutation_importance": permutation_importance,
        "reconstruction_breakdown": lambda spark, d: X.reconstruction_breakdown(*_worst(spark, d)),
        "reconstruction_text": lambda spark, d: X.reconstruction_text(*_worst(spark, d)),
        "stream_score": stream_score,
        "stream_model_score": stream_model_score,
    }
