"""The aggregates behind the usual charts and business roll-ups."""

from pyspark.sql import DataFrame, functions as F

from oddspend import schema as S
from oddspend.functions.lookup import lookup_join
from oddspend.functions.quantiles import grouped_quantiles
from oddspend.session import materialize


def _q(c):
    return F.col(f"`{c}`")


def correlation_matrix(df: DataFrame, columns) -> DataFrame:
    """(a, b, corr) for every pair, one aggregation."""
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    one = df.agg(*[F.corr(_q(columns[i]).cast("double"), _q(columns[j]).cast("double")).alias(f"_{i}_{j}") for i, j in pairs])
    items = []
    for i, j in pairs:
        items.append(F.struct(F.lit(columns[i]).alias("a"), F.lit(columns[j]).alias("b"), F.col(f"_{i}_{j}").alias("corr")))
        if i != j:
            items.append(F.struct(F.lit(columns[j]).alias("a"), F.lit(columns[i]).alias("b"), F.col(f"_{i}_{j}").alias("corr")))
    return one.select(F.explode(F.array(*items)).alias("p")).select("p.a", "p.b", F.round("p.corr", 6).alias("corr"))


def histogram(df: DataFrame, value, bins: int = 60) -> DataFrame:
    """(bin, lo, hi, n) of equal-width bins over the value range, non-empty bins."""
    v = value if not isinstance(value, str) else _q(value)
    vals = df.select(v.cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    lo, hi = vals.agg(F.min("v"), F.max("v")).first()
    if lo is None:
        return vals.select(F.lit(0).cast("long").alias("bin"), F.col("v").alias("lo"), F.col("v").alias("hi"), F.lit(0).cast("long").alias("n")).limit(0)
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((F.col("v") - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("long")
    return vals.groupBy(b.alias("bin")).agg(F.count("*").alias("n")).select(
        "bin", F.round(F.lit(lo) + F.col("bin") * F.lit(width), 6).alias("lo"),
        F.round(F.lit(lo) + (F.col("bin") + 1) * F.lit(width), 6).alias("hi"), "n")


def log_amount(col=S.AMOUNT):
    return F.log1p(F.greatest(_q(col).cast("double"), F.lit(0.0)))


def box_stats(df: DataFrame, category: str, amount: str = S.AMOUNT) -> DataFrame:
    """Quartiles and 1.5 IQR whiskers per category, biggest category first."""
    df = materialize(df.select(_q(category), _q(amount).cast("double").alias(amount)), "box_rows")  # read three times
    q = grouped_quantiles(df, [category], amount, [0.25, 0.5, 0.75]).select(
        _q(category), "n", F.get("q", F.lit(0)).alias("q1"), F.get("q", F.lit(1)).alias("median"), F.get("q", F.lit(2)).alias("q3"))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    q = materialize(q, "box")
    rows = df.select(_q(category), _q(amount).alias("_a"), F.monotonically_increasing_id().alias("_i"))
    near = lookup_join(rows, q.withColumn("_w", F.col("n")), category, q.count(), "_w", "_i")
    ends = near.groupBy(category).agg(
        F.min(F.when(F.col("_a") >= F.col("q1") - reach, F.col("_a"))).alias("whisker_low"),
        F.max(F.when(F.col("_a") <= F.col("q3") + reach, F.col("_a"))).alias("whisker_high"))
    return q.join(ends, category).select(
        _q(category), "n", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")]
    ).orderBy(F.col("n").desc(), category)


def customer_frequency_histogram(df: DataFrame, user: str = S.USER, bins: int = 40) -> DataFrame:
    return histogram(df.groupBy(user).agg(F.count("*").alias("_n")), "_n", bins)


def volume(df: DataFrame, by, name: str) -> DataFrame:
    return df.groupBy(by.alias(name)).agg(F.count("*").alias("n"))


def hourly_volume(df: DataFrame) -> DataFrame:
    return volume(df, F.col(S.HOUR), "hour").orderBy("hour")


def daily_volume(df: DataFrame) -> DataFrame:
    return volume(df, F.to_date(S.TS), "day").orderBy("day")


def weekday_name(col):
    return F.get(F.array(*[F.lit(d) for d in S.WEEKDAY_NAMES]), col.cast("int"))


def weekday_volume(df: DataFrame) -> DataFrame:
    return volume(df, F.col(S.WEEKDAY), "weekday").select("weekday", weekday_name(F.col("weekday")).alias("name"), "n").orderBy("weekday")


def top_by_count(df: DataFrame, key: str, n: int = 20) -> DataFrame:
    return df.groupBy(_q(key)).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), _q(key)).limit(n)


def top_spend(df: DataFrame, key: str, n: int = 15, amount: str = S.AMOUNT) -> DataFrame:
    """Average amount of the n most frequent keys, highest average first."""
    g = df.groupBy(_q(key)).agg(F.count("*").alias("n"), F.avg(amount).alias("_avg"))
    return g.orderBy(F.col("n").desc(), _q(key)).limit(n).select(
        _q(key), "n", F.round("_avg", 6).alias("avg_amount")).orderBy(F.col("avg_amount").desc(), _q(key))


def runtime_long(table: DataFrame) -> DataFrame:
    cols = [c for c in ("train_time_seconds", "prediction_time_seconds") if c in table.columns]
    return table.unpivot(["model"], cols, "stage", "seconds")


def scatter_points(scored: DataFrame, x: str, y: str) -> DataFrame:
    return scored.select(S.ROW_ID, _q(x).alias("x"), _q(y).alias("y"),
                         F.when(F.col("is_anomaly") == 1, "Anomaly").otherwise("Normal").alias("kind"))


def anomaly_rate(scored: DataFrame, by: str, min_count: int = 0, top_n: int | None = None) -> DataFrame:
    """(by, rate, n) of flagged rows per group, highest rate first."""
    g = scored.groupBy(_q(by)).agg(F.avg(F.col("is_anomaly").cast("double")).alias("_r"), F.count("*").alias("n"))
    out = g.filter(F.col("n") >= min_count).select(_q(by), F.round("_r", 6).alias("rate"), "n").orderBy(F.col("rate").desc(), _q(by))
    return out if top_n is None else out.limit(top_n)


def impact_summary(scored: DataFrame, amount: str = S.AMOUNT) -> DataFrame:
    a = _q(amount).cast("decimal(18,6)")
    flagged = F.col("is_anomaly") == 1
    one = scored.agg(F.count("*").alias("n_total"), F.coalesce(F.sum(flagged.cast("long")), F.lit(0)).alias("n_flagged"),
                     F.sum(F.when(flagged, a)).cast("double").alias("f"), F.sum(a).cast("double").alias("t"))
    return one.select("n_total", "n_flagged", F.round(F.try_divide(100.0 * F.col("n_flagged"), F.col("n_total")), 6).alias("flagged_pct"),
                      F.round(F.coalesce("f", F.lit(0.0)), 2).alias("flagged_value"),
                      F.round(F.try_divide(100.0 * F.coalesce("f", F.lit(0.0)), F.col("t")), 6).alias("value_share_pct"))


def top_flagged_merchants(scored: DataFrame, n: int = 15, merchant: str = S.MERCHANT, amount: str = S.AMOUNT) -> DataFrame:
    g = scored.filter("is_anomaly = 1").groupBy(_q(merchant)).agg(
        F.count("*").alias("flagged_count"), F.sum(_q(amount).cast("decimal(18,6)")).cast("double").alias("_s"))
    return g.select(_q(merchant), "flagged_count", F.round("_s", 2).alias("total_flagged_amount")).orderBy(
        F.col("flagged_count").desc(), _q(merchant)).limit(n)


def dataset_summary(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), F.lit(len(df.columns)).cast("long").alias("n_columns"),
                  F.countDistinct(S.USER).alias("n_customers"), F.countDistinct(_q(S.MERCHANT)).alias("n_merchants"))


def flagged_sorted(scored: DataFrame) -> DataFrame:
    """Flagged rows, highest score first."""
    return scored.filter("is_anomaly = 1").orderBy(F.col("anomaly_score").desc(), S.ROW_ID)


def prediction_counters(scored: DataFrame) -> DataFrame:
    return scored.agg(F.count("*").alias("n_scored"), F.coalesce(F.sum(F.col("is_anomaly").cast("long")), F.lit(0)).alias("n_flagged"),
                      F.round(100.0 * F.avg(F.col("is_anomaly").cast("double")), 6).alias("flagged_pct"))
