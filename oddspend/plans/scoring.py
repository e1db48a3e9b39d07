"""The whole path: raw rows -> encoded rows -> fitted models -> metrics, and the
scoring of new rows with what was fitted."""

import itertools
import json
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from oddspend import schema as S
from oddspend.functions.sampling import id_hash, stratified_split
from oddspend.operators import clean as C, encode as E, evaluate as A, features as B
from oddspend.operators.models.autoencoder import Autoencoder
from oddspend.operators.models.iforest import IsolationForest, grow, score_together
from oddspend.operators.models.linear import EllipticEnvelope, Mahalanobis, PcaReconstruction
from oddspend.operators.models.lof import LocalOutlierFactor
from oddspend.operators.models.ocsvm import OneClassSvm
from oddspend.operators.profiles import Profiles
from oddspend.session import materialize

MODELS = {m.name: m for m in (IsolationForest, LocalOutlierFactor, OneClassSvm, Autoencoder, EllipticEnvelope,
                              PcaReconstruction, Mahalanobis)}
DEFAULT_MODELS = ("isolation_forest", "autoencoder")


@dataclass
class Prepared:
    """Encoded rows with their split, and everything needed to treat new rows alike."""
    rows: DataFrame
    encoder: E.Encoder
    clean: C.CleanStats
    gap_median: float
    merchants: DataFrame
    merchant_total: int

    def fitted(self):
        return {"gap_median": self.gap_median, "merchant_stats": self.merchants, "merchant_total": self.merchant_total}


def prepare(raw: DataFrame, test_size: float = 0.2, seed: int = 42, scaler: str = "standard", train_only_stats: bool = False,
            **feature_options) -> Prepared:
    """Clean, engineer, split by label and encode. The encoder sees training rows only.

    Merchant statistics and the gap median describe all rows, unless
    train_only_stats is set: then test rows do not influence them."""
    cleaned, stats = C.clean(raw)
    cleaned = materialize(stratified_split(cleaned, S.ROW_ID, S.LABEL, test_size, seed), "cleaned")
    base = cleaned.filter("split = 'train'") if train_only_stats else cleaned
    merchants = materialize(B.merchant_stats(base), "merchants")
    total = base.filter(F.col(f"`{S.MERCHANT}`").isNotNull()).count()
    core = materialize(B.customer_history(cleaned, **feature_options), "history")
    gap = B.gap_median(core.filter("split = 'train'") if train_only_stats else core)
    rows = B.time_flags(B.merchant_features(B.fill_first_gap(core, gap), merchants, total))
    rows = materialize(rows.select(*[F.col(f"`{c}`") for c in cleaned.columns], *S.FEATURES), "engineered")
    enc = E.Encoder(scaler).fit(rows.filter("split = 'train'"))
    return Prepared(materialize(enc.matrix(rows), "encoded", parallel=True), enc, stats, gap, merchants, total)


def train_models(rows: DataFrame, names=DEFAULT_MODELS, options: dict | None = None) -> dict:
    unknown = sorted(set(names) - set(MODELS))
    if unknown:
        raise ValueError(f"unknown models {unknown}; known: {sorted(MODELS)}")
    return {n: MODELS[n](**(options or {}).get(n, {})).fit(rows) for n in names}


def training_report(models: dict, spark) -> DataFrame:
    rows = [(n, float(m.fit_seconds), float(m.threshold), int(m.n_features)) for n, m in models.items()]
    return spark.createDataFrame(rows, "model string, fit_seconds double, threshold double, n_features int")


def long_scores(models: dict, rows: DataFrame):
    """((model, row_id, score, label, flag) scored once and written, timings per model)."""
    spark, out, seconds = rows.sparkSession, None, []
    for name, model in models.items():
        start = time.perf_counter()
        part = materialize(model.predict(rows).select(
            F.lit(name).alias("model"), S.ROW_ID, F.col("anomaly_score").alias("score"), F.col(S.LABEL).alias("label"),
            F.col("is_anomaly").alias("flag")), "scores")
        seconds.append((name, float(model.fit_seconds), round(time.perf_counter() - start, 4)))
        out = part if out is None else out.unionByName(part)
    return out, spark.createDataFrame(seconds, "model string, train_time_seconds double, prediction_time_seconds double")


def compare_models(models: dict, test_rows: DataFrame):
    """(metrics table best first, recommendation), from one scoring pass per model."""
    scores, timings = long_scores(models, test_rows)
    table = A.model_table(A.evaluate_models(scores, timings))
    return table, A.recommend(table)


def score_transactions(raw: DataFrame, prepared: Prepared, models: dict, name: str, stats: str = "batch",
                       history: DataFrame | None = None, profiles: Profiles | None = None, keep_features: bool = True) -> DataFrame:
    """Raw rows plus features, anomaly_score, anomaly_score_normalized, is_anomaly. Without
    keep_features the array `features` is left out; its parts are columns anyway.

    stats='batch' recomputes medians, clip bounds and merchant statistics on these
    rows; 'fitted' uses those of training. history: cleaned earlier rows; profiles:
    what is stored of them (profiles.build, profiles.merge), so that they are not read again."""
    if name not in models:
        raise ValueError(f"model '{name}' is not available; have {sorted(models)}")
    if stats not in ("batch", "fitted"):
        raise ValueError("stats is 'batch' or 'fitted'")
    fixed = stats == "fitted"
    rows, _ = C.clean(raw, prepared.clean if fixed else None)
    feats = B.engineer(rows, prepared.fitted() if fixed else None, history, profiles)
    return models[name].score_batch(prepared.encoder.matrix(feats), keep_features)


def save(path: str, prepared: Prepared, models: dict):
    spark = prepared.rows.sparkSession
    prepared.encoder.save(f"{path}/encoder")
    prepared.merchants.write.mode("overwrite").parquet(f"{path}/merchant_stats")
    meta = {"clean": vars(prepared.clean), "gap": prepared.gap_median, "total": prepared.merchant_total, "models": list(models)}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").parquet(f"{path}/meta")
    prepared.rows.write.mode("overwrite").parquet(f"{path}/rows")
    for n, m in models.items():
        m.save(spark, f"{path}/models/{n}")


def load(spark, path: str):
    meta = json.loads(spark.read.parquet(f"{path}/meta").first().meta)
    prepared = Prepared(spark.read.parquet(f"{path}/rows"), E.Encoder.load(spark, f"{path}/encoder"), C.CleanStats(**meta["clean"]),
                        meta["gap"], spark.read.parquet(f"{path}/merchant_stats"), meta["total"])
    return prepared, {n: MODELS[n].load(spark, f"{path}/models/{n}") for n in meta["models"]}


# The declared search space of each model.
SEARCH = {
    "isolation_forest": ({"n_estimators": [100, 200, 300], "max_samples": ["auto", 0.5, 0.8], "max_features": [0.5, 0.8, 1.0]}, 10),
    "local_outlier_factor": ({"n_neighbors": [10, 20, 35, 50]}, 8),
    "one_class_svm": ({"nu": [0.01, 0.02, 0.05], "gamma": ["scale", "auto", 0.01, 0.1]}, 8),
}


def param_sweep(name: str, train: DataFrame, test: DataFrame, grid: dict | None = None, n_iter: int | None = None, seed: int = 42):
    """ROC-AUC on the test rows for n_iter settings drawn from the grid, best first."""
    import random

    default, count = SEARCH.get(name, ({}, 1))
    grid = grid or default
    settings = [dict(zip(grid, v)) for v in itertools.product(*grid.values())]
    chosen = random.Random(seed).sample(settings, min(n_iter or count, len(settings)))
    names = train.sparkSession.createDataFrame([(str(i), json.dumps(p, sort_keys=True)) for i, p in enumerate(chosen)], "model string, params string")
    models = [MODELS[name](**params) for params in chosen]
    if name == IsolationForest.name and "seed" not in grid:
        scores = _sweep_forests(models, train, test)
    else:
        scores = None
        for i, model in enumerate(models):
            part = materialize(model.fit(train).score(test).select(
                F.lit(str(i)).alias("model"), S.ROW_ID, F.col("anomaly_score").alias("score"), F.col(S.LABEL).alias("label")), "sweep")
            scores = part if scores is None else scores.unionByName(part)
    return A.auc_metrics(scores).join(F.broadcast(names), "model").select("params", "roc_auc", "average_precision").orderBy(
        F.col("roc_auc").desc_nulls_last(), "params")


def _sweep_forests(models: list, train: DataFrame, test: DataFrame) -> DataFrame:
    """(model, row_id, score, label) of forests that grow in one job over shared draws and score
    the test rows together. Scores are not shifted by thresholds, which no ranking needs."""
    width = len(train.select("features").first().features)
    for model in models:
        model.n_features = width
    grow(train, models)
    found = score_together(test.select(S.ROW_ID, "features", F.col(S.LABEL).alias("label")), models)
    found = materialize(found.select(S.ROW_ID, "label", "scores"), "sweep")
    return found.select(F.posexplode("scores").alias("model", "score"), S.ROW_ID, "label").withColumn("model", F.col("model").cast("string"))
