"""Registered queries: each takes (spark, folder) and reads the folder's tables."""

import zlib

from pyspark.sql import DataFrame, functions as F

from oddspend import schema as S
from oddspend.functions import sampling
from oddspend.functions.quantiles import exact_quantiles, grouped_quantiles
from oddspend.operators import clean as C, encode as E, evaluate as A, explain as X, features as B, insights as I, profile as V, profiles as R
from oddspend.plans.oracle import CORR_COLS, INTS, OWN_FEATURES
from oddspend.session import materialize, on_release, shared_dir
from oddspend.sources import readers, views, writers

_tables: dict = {}
on_release(_tables.clear)


def once(spark, folder, name, build):
    """What several queries start from, built once per session and folder."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _tables:
        _tables[key] = build()
    return _tables[key]


def shared(spark, folder, name, build, parallel=False) -> DataFrame:
    """A derived table several queries start from, written once per session and folder."""
    return once(spark, folder, name, lambda: materialize(build(), name, parallel))


def r6(c, alias=None):
    return F.round(F.col(f"`{c}`"), 6).alias(alias or c)


def rounded(df, columns, keep=(), places=None):
    return df.select(*keep, *[F.col(c) if c in INTS else (F.round(F.col(f"`{c}`"), places).alias(c) if places else F.col(f"`{c}`")) for c in columns])


def txn(spark, d):
    return views.txn_events(spark, d)


def features(spark, d):
    return shared(spark, d, "features", lambda: B.engineer(txn(spark, d)))


def card(spark, d):
    return once(spark, d, "card", lambda: C.clean(views.raw_card(spark, d))[0])  # clipping over a table that cleaning wrote


def card_features(spark, d):
    return shared(spark, d, "card_features", lambda: B.engineer(card(spark, d)))


def card_split(spark, d):
    # a condition on the id's hash, cheaper to compute than to write
    return once(spark, d, "card_split", lambda: sampling.stratified_split(card_features(spark, d), S.ROW_ID, S.LABEL))


def encoder(spark, d):
    return once(spark, d, "encoder", lambda: E.Encoder().fit(card_split(spark, d).filter("split = 'train'")))


def looked_up(spark, d):
    return shared(spark, d, "looked_up", lambda: encoder(spark, d).encode_frequencies(card_split(spark, d)), parallel=True)


def encoded(spark, d):
    """Only what needs a join is written; scaling and the array are arithmetic on it."""
    return once(spark, d, "encoded", lambda: encoder(spark, d).assemble(looked_up(spark, d)))


def two_scores(spark, d):
    """Two plain behavioural scores as a long (model, row_id, score, label) table."""
    f = features(spark, d)
    cols = {"customer_deviation": "amount_deviation_from_customer_mean", "merchant_zscore": "amount_zscore_by_merchant"}
    return f.select(S.ROW_ID, F.col(S.LABEL).alias("label"), F.explode(F.array(*[
        F.struct(F.lit(m).alias("model"), F.abs(F.col(c)).alias("score")) for m, c in cols.items()])).alias("s")).select(
        "s.model", S.ROW_ID, "s.score", "label")


def thresholds(scored):
    return grouped_quantiles(scored, ["model"], "score", [0.98]).select("model", F.get("q", F.lit(0)).alias("threshold"))


def flagged_scores(spark, d):
    s = two_scores(spark, d)
    return s.join(F.broadcast(thresholds(s)), "model").withColumn("flag", (F.col("score") >= F.col("threshold")).cast("int"))


def flag_by_deviation(f):
    f = f.withColumn("anomaly_score", F.abs("amount_deviation_from_customer_mean"))
    cut = exact_quantiles(f, "anomaly_score", [0.98])[0]
    return f.withColumn("is_anomaly", (F.col("anomaly_score") >= F.lit(cut)).cast("int"))


def flagged(spark, d):
    return flag_by_deviation(features(spark, d))


def flagged_card(spark, d):
    return flag_by_deviation(card_features(spark, d))


def suspicious_now(spark, d):
    """Payments that break the customer's own pattern while several came within the hour."""
    h = B.customer_history(txn(spark, d), with_merchants=False)
    dev = "amount_deviation_from_customer_mean"
    return h.filter((F.abs(dev) > 3) & (F.col("transaction_velocity") >= 1)).orderBy(F.abs(dev).desc(), S.ROW_ID).select(
        S.ROW_ID, S.USER, r6(S.AMOUNT), "customer_txn_count", "transaction_velocity", r6("customer_avg_amount"), r6(dev))


def scan_project(spark, d):
    path = f"{shared_dir(spark)}/raw-{spark.sparkContext.applicationId}-{zlib.crc32(d.encode())}"
    writers.write_csv(views.raw_card(spark, d).drop(S.ROW_ID), path)
    return readers.read_csv(spark, path).drop(S.ROW_ID)


def user_sample(spark, d):
    return sampling.sample_users(views.raw_card(spark, d), S.USER, 0.05).select(S.ROW_ID, S.USER)


def head_n(spark, d):
    return sampling.head_rows(views.raw_card(spark, d), 1000, S.ROW_ID).select(S.ROW_ID, S.USER, S.AMOUNT)


def parquet_roundtrip(spark, d):
    path = f"{shared_dir(spark)}/engineered-{spark.sparkContext.applicationId}-{zlib.crc32(d.encode())}"
    writers.write_table(features(spark, d), path)
    return rounded(readers.read_table(spark, path), S.FEATURES, (S.ROW_ID, S.LABEL))


def _raw(f, junk=False, drop=True):
    def run(spark, d):
        df = views.raw_card(spark, d, junk)
        return f(df.drop(S.ROW_ID) if drop else df)
    return run


def _lines(f):
    return lambda spark, d: f(views.txn_lines(spark, d))


def impute_median(df):
    a = C.parse_amount(df)
    return C.impute_amount(a, C.amount_median(a)).select(S.ROW_ID, r6(S.AMOUNT))


def winsorize(df):
    return C.clip_amount(df, *C.clip_bounds(df)).groupBy(r6(S.AMOUNT)).agg(F.count("*").alias("n"))


def _history(*cols):
    return lambda spark, d: rounded(B.customer_history(
        txn(spark, d), with_merchants="merchant_diversity" in cols), cols, (S.ROW_ID,))


def feat_time_since_prev(spark, d):
    h = materialize(B.customer_history(txn(spark, d), with_merchants=False).select(S.ROW_ID, "time_since_prev_txn"), "gap")
    return rounded(B.fill_first_gap(h, B.gap_median(h)), ["time_since_prev_txn"], (S.ROW_ID,))


def _stretches(spark, d):
    """Payments in three stretches of time: the first 40 %, up to 80 %, and the rest."""
    us = F.unix_micros(F.col(S.TS).cast("timestamp"))
    parts = sampling.time_split(txn(spark, d), us)
    old = sampling.time_split(parts.filter("split = 'train'").drop("split"), us, 0.5)
    return [old.filter("split = 'train'").drop("split"), old.filter("split = 'test'").drop("split"), parts.filter("split = 'test'").drop("split")]


def customer_profiles(spark, d):
    """Stored profiles of three stretches, merged: the state of every customer."""
    a, b, c = map(R.build, _stretches(spark, d))
    p = R.merge(R.merge(a, b), c).customers
    return p.select(S.USER, "n", *[F.col(x).cast("double").alias(x) for x in ("s1", "s2", "mx", "mn")], "nd", "nm", "old", "first_id", "last_id",
                    F.col("first_day").cast("string").alias("first_day"), F.col("last_day").cast("string").alias("last_day"),
                    F.aggregate("tail", F.lit(0).cast("decimal(28,6)"), lambda s, t: (s + t["amount"]).cast("decimal(28,6)")).cast("double").alias("tail_sum"))


def profiled_features(spark, d):
    """Customer features of the last stretch, from the merged profiles of the earlier two."""
    a, b, c = _stretches(spark, d)
    rows = B.customer_history(c, profiles=R.merge(R.build(a), R.build(b)))
    return rounded(rows, OWN_FEATURES, (S.ROW_ID,))


def _merchant(col):
    return lambda spark, d: rounded(B.merchant_features(txn(spark, d)), [col], (S.ROW_ID,))


def _scaled(columns, kind):
    def run(df):
        s = E.scale(df, E.fit_scaler(df, columns, kind))
        return s.groupBy(*[r6(f"{c}_scaled") for c in columns]).agg(F.count("*").alias("n"))
    return _lines(run)


def freq_fit(spark, d):
    train = sampling.stratified_split(card(spark, d), S.ROW_ID, S.LABEL).filter("split = 'train'")
    return E.frequency_table(train, [*S.CATEGORICALS, S.MERCHANT]).select("column", "value", "n", r6("freq"))


def freq_transform(spark, d):
    enc = encoder(spark, d)
    return rounded(enc.encode_frequencies(card_split(spark, d)), [f"{c}_freq" for c in enc.sizes], (S.ROW_ID,), 6)


def scale_standard(spark, d):
    enc = encoder(spark, d)
    return rounded(E.scale(card_split(spark, d), enc.scaler), [f"{c}_scaled" for c in enc.scaler], (S.ROW_ID,), 6)


def encode_full(spark, d):
    enc = encoder(spark, d)
    return rounded(enc.transform(card_split(spark, d)), enc.feature_columns(), (S.ROW_ID, "split", S.LABEL), 6)


def normalize_score(spark, d):
    s = two_scores(spark, d)
    ends = s.groupBy("model").agg(F.min("score").alias("lo"), F.max("score").alias("hi"))
    span = F.col("hi") - F.col("lo")
    return s.join(F.broadcast(ends), "model").select("model", S.ROW_ID, F.round(
        F.when(span < 1e-12, 0.0).otherwise((F.col("score") - F.col("lo")) / F.when(span >= 1e-12, span)), 6).alias("normalized"))


def _metric(f, *cols):
    return lambda spark, d: f(flagged_scores(spark, d)).withColumns({c: F.round(c, 6) for c in cols})


METRICS = ["roc_auc", "average_precision", *[f"{m}_at_{k}" for k in A.K_VALUES for m in ("precision", "recall")], "precision", "recall", "f1"]


def recommend_model(spark, d):
    m = A.auc_metrics(two_scores(spark, d)).withColumn(
        "prediction_time_seconds", F.when(F.col("model") == "customer_deviation", 0.4).otherwise(0.2))
    return A.recommend(m).select("recommended_model", "primary_metric", r6("metric_value"), "candidates")


def base_feature(spark, d):
    e, cols = encoded(spark, d), encoder(spark, d).feature_columns()
    one = e.agg(*[F.avg(F.col(f"`{c}`")).alias(str(i)) for i, c in enumerate(cols)])
    long = one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{i}`").alias("mean"))
                                          for i, c in enumerate(cols)])).alias("p")).select("p.*")
    return long.select("feature", X.base_feature(F.col("feature")).alias("base_feature"), r6("mean"))


def _explained(f):
    def run(spark, d):
        e, cols = encoded(spark, d), encoder(spark, d).feature_columns()
        return f(flag_by_deviation(e).filter("is_anomaly = 1"), X.reference_stats(e.filter("split = 'train'"), cols))
    return run


def runtime_long(spark, d):
    t = two_scores(spark, d).groupBy("model").agg(
        F.count("*").cast("double").alias("train_time_seconds"), F.sum("label").cast("double").alias("prediction_time_seconds"))
    return I.runtime_long(t)


def queries() -> dict:
    plain = {
        "suspicious_now": suspicious_now,
        "scan_project": scan_project,
        "user_sample": user_sample,
        "head_n": head_n,
        "parquet_roundtrip": parquet_roundtrip,
        "profile_counts": _raw(V.counts),
        "profile_missing": _raw(V.missing),
        "profile_duplicates": _raw(V.duplicates),
        "profile_cardinality": _raw(V.cardinality),
        "profile_amount": _raw(V.amounts, junk=True),
        "profile_labels": _raw(V.labels),
        "profile_report": _raw(V.validate, junk=True),
        "describe_numeric": _lines(lambda t: V.describe_numeric(t, ["Amount", "l_quantity", "l_discount", "l_tax"])),
        "describe_text": _raw(lambda t: V.describe_text(t, ["Use Chip", "Merchant City", "Merchant State", "Errors?", "Is Fraud?"])),
        "clean_amount": _raw(lambda t: C.parse_amount(t).select(S.ROW_ID, S.AMOUNT), drop=False),
        "parse_datetime": _raw(lambda t: C.parse_datetime(t).select(S.ROW_ID, S.TS, S.HOUR, S.WEEKDAY), drop=False),
        "time_parts": _lines(lambda t: t.groupBy(S.USER, S.TS, S.HOUR, S.WEEKDAY).agg(F.count("*").alias("n"))),
        "fill_missing": _raw(lambda t: C.fill_categories(t).select(S.ROW_ID, *[F.col(f"`{c}`") for c in S.CATEGORICALS], "Zip"), drop=False),
        "impute_median": _raw(impute_median, drop=False),
        "dedupe_rows": _raw(C.drop_duplicates, drop=False),
        "dedupe_subset": _raw(lambda t: C.drop_duplicates(t, [S.USER, S.MERCHANT, "Day"]).select(
            S.ROW_ID, S.USER, F.col(f"`{S.MERCHANT}`"), "Day", S.AMOUNT), drop=False),
        "winsorize": _lines(winsorize),
        "extract_label": _raw(lambda t: C.extract_label(t).select(S.ROW_ID, S.LABEL), drop=False),
        "clean_full": lambda spark, d: C.clean(views.raw_card(spark, d))[0],
        "min_history_filter": lambda spark, d: C.min_history(views.txn_orders(spark, d), 5).select(S.ROW_ID, S.USER),
        "feat_customer_avg": _history("customer_avg_amount"),
        "feat_customer_max": _history("customer_max_amount"),
        "feat_customer_count": _history("customer_txn_count"),
        "feat_amount_deviation": _history("amount_deviation_from_customer_mean"),
        "feat_merchant_freq": _merchant("merchant_txn_frequency"),
        "feat_merchant_zscore": _merchant("amount_zscore_by_merchant"),
        "feat_time_flags": lambda spark, d: B.time_flags(txn(spark, d)).select(S.ROW_ID, "weekend_indicator", "business_hour_indicator"),
        "feat_time_since_prev": feat_time_since_prev,
        "feat_rolling_avg": _history("rolling_avg_amount"),
        "feat_velocity": _history("transaction_velocity"),
        "feat_merchant_diversity": _history("merchant_diversity"),
        "feat_daily_spend": _history("avg_daily_spending"),
        "feat_activity_freq": _history("customer_activity_frequency"),
        "features_full": lambda spark, d: rounded(B.engineer(txn(spark, d)), S.FEATURES, (S.ROW_ID,)),
        "features_orders": lambda spark, d: rounded(B.engineer(views.txn_orders(spark, d)), S.FEATURES, (S.ROW_ID,)),
        "features_card": lambda spark, d: rounded(card_features(spark, d), S.FEATURES, (S.ROW_ID,)),
        "customer_profiles": customer_profiles,
        "profiled_features": profiled_features,
        "merchant_stats_lines": _lines(lambda t: B.merchant_stats(t).select(
            F.col(f"`{S.MERCHANT}`"), "m_count", r6("m_mean"), F.round("m_std", 4).alias("m_std"))),
        "stratified_split": lambda spark, d: sampling.stratified_split(txn(spark, d), S.ROW_ID, S.LABEL).select(S.ROW_ID, S.LABEL, "split"),
        "time_split": lambda spark, d: sampling.time_split(txn(spark, d), F.unix_micros(F.col(S.TS).cast("timestamp"))).select(S.ROW_ID, "split"),
        "freq_fit": freq_fit,
        "freq_transform": freq_transform,
        "scale_standard": scale_standard,
        "scale_robust": _scaled(["Amount", "l_tax"], "robust"),
        "scale_minmax": _scaled(["Amount", "l_quantity"], "minmax"),
        "encode_full": encode_full,
        "score_threshold": lambda spark, d: thresholds(two_scores(spark, d)).select("model", r6("threshold")),
        "flag_anomalies": lambda spark, d: flagged_scores(spark, d).select("model", S.ROW_ID, "flag"),
        "normalize_score": normalize_score,
        "fixed_sample": lambda spark, d: sampling.take_fixed(txn(spark, d), 400, S.ROW_ID).select(S.ROW_ID),
        "precision_at_k": _metric(A.precision_at_k, "precision_at_k"),
        "recall_at_k": _metric(A.recall_at_k, "recall_at_k"),
        "roc_auc": _metric(lambda s: A.auc_metrics(s).select("model", "roc_auc"), "roc_auc"),
        "average_precision": _metric(lambda s: A.auc_metrics(s).select("model", "average_precision"), "average_precision"),
        "ranking_metrics": _metric(A.ranking_metrics, "value"),
        "classification_metrics": _metric(A.classification_metrics, "precision", "recall", "f1"),
        "roc_curve": _metric(A.roc_curve, "fpr", "tpr", "threshold"),
        "pr_curve": _metric(A.pr_curve, "precision", "recall", "threshold"),
        "evaluate_models": _metric(A.evaluate_models, *METRICS),
        "model_table": lambda spark, d: A.model_table(A.evaluate_models(flagged_scores(spark, d))).select(
            "model", r6("roc_auc"), r6("average_precision")),
        "recommend_model": recommend_model,
        "base_feature": base_feature,
        "explain_topn": _explained(X.explain_rows),
        "explain_text": _explained(X.explain_text),
        "correlation_matrix": lambda spark, d: I.correlation_matrix(features(spark, d), CORR_COLS),
        "amount_histogram": _lines(lambda t: I.histogram(t, S.AMOUNT)),
        "amount_log_histogram": _lines(lambda t: I.histogram(t, I.log_amount())),
        "amount_box_by_category": _lines(lambda t: I.box_stats(t, "l_returnflag")),
        "customer_frequency_hist": _lines(I.customer_frequency_histogram),
        "top_merchants": _lines(lambda t: I.top_by_count(t, S.MERCHANT)),
        "hourly_volume": lambda spark, d: I.hourly_volume(txn(spark, d)),
        "daily_volume": _lines(I.daily_volume),
        "weekday_volume": _lines(I.weekday_volume),
        "top_customer_spend": _lines(lambda t: I.top_spend(t, S.USER)),
        "top_merchant_spend": _lines(lambda t: I.top_spend(t, S.MERCHANT)),
        "score_histogram": lambda spark, d: I.histogram(flagged(spark, d), "anomaly_score"),
        "runtime_long": runtime_long,
        "scatter_points": lambda spark, d: I.scatter_points(flagged(spark, d), S.AMOUNT, "customer_avg_amount").withColumns(
            {"x": F.round("x", 6), "y": F.round("y", 6)}),
        "anomaly_rate_by_mcc": lambda spark, d: I.anomaly_rate(flagged_card(spark, d), "MCC", 5, 15),
        "anomaly_rate_by_channel": lambda spark, d: I.anomaly_rate(flagged_card(spark, d), "Use Chip"),
        "anomaly_rate_by_hour": lambda spark, d: I.anomaly_rate(flagged(spark, d), S.HOUR),
        "anomaly_rate_by_weekday": lambda spark, d: I.anomaly_rate(flagged(spark, d), S.WEEKDAY),
        "impact_summary": lambda spark, d: I.impact_summary(flagged(spark, d)),
        "top_flagged_merchants": lambda spark, d: I.top_flagged_merchants(flagged(spark, d)),
        "dataset_summary": _lines(I.dataset_summary),
        "flagged_sorted": lambda spark, d: I.flagged_sorted(flagged(spark, d)).select(S.ROW_ID, S.USER, r6(S.AMOUNT), r6("anomaly_score")),
        "prediction_counters": lambda spark, d: I.prediction_counters(flagged(spark, d)),
    }
    from oddspend.plans.model_queries import model_queries

    return plain | model_queries()
