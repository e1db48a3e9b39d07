"""Behavioural features of each payment against its customer's and merchant's history.

Customer features look only at earlier rows of the customer, in the order
(transaction_datetime, row_id). They come from one exchange by customer and one
sort. The flag "first payment at this merchant" is brought into that order as a
marker row made by a map-side combined aggregation, so it needs no window of its
own.

A customer with more than `hot_rows` rows would put all of them in one task. Such
customers are cut into time chunks that are sorted and scanned separately; what
earlier chunks contribute (counts, exact sums, extremes, last rows, distinct days
and merchants, payments still inside the velocity hour) is computed from small
per-chunk summaries and added. Sums are DECIMAL, so a cut changes no result.
Stored profiles (see profiles.py) are added in the same way.
"""

from pyspark.sql import DataFrame, functions as F, Window

from oddspend import schema as S
from oddspend.functions.lookup import lookup_join
from oddspend.functions.quantiles import exact_quantiles
from oddspend.functions.running import bucket_of, value_cuts
from oddspend.functions.sampling import top_per_group
from oddspend.operators.profiles import Profiles, place
from oddspend.session import materialize

HOT_ROWS = 5_000_000
_AMT = "decimal(18,6)"
_SUM = "decimal(28,6)"
_SQ = "decimal(38,12)"
_REQUIRED = {S.USER, S.AMOUNT, S.TS, S.HOUR, S.WEEKDAY, S.MERCHANT, S.ROW_ID}


def _micros(c):
    return F.unix_micros(c.cast("timestamp"))


def _hot_users(df, hot_rows):
    """{customer: rows} of customers one task should not sort alone: at most
    total rows / hot_rows of them."""
    sizes = df.groupBy(S.USER).agg(F.count("*").alias("n")).filter(F.col("n") > hot_rows)
    return {r[0]: r[1] for r in sizes.collect()}


def _time_chunk(df, cuts, us):
    """Chunk number of the row: the interval of the cut list its time falls into."""
    return bucket_of(df.withColumn("_cut_at", us.cast("double")), "_cut_at", cuts, "_chunk").drop("_cut_at")


def _measures(df):
    """Exact amount, its square, and the day; made after the shuffle, not carried through it."""
    a = F.col(S.AMOUNT).cast(_AMT)
    return df.withColumns({"_amt": a, "_sq": (a * a).cast("decimal(36,12)"), "_day": F.to_date(S.TS)})


def _carry(rows, marks, horizon, window_rows):
    """Per (customer, chunk): what the chunks before it contribute."""
    key = [S.USER, "_chunk"]
    base = rows.groupBy(*key).agg(
        F.count("*").alias("n"), F.sum("_amt").alias("s1"), F.sum("_sq").alias("s2"),
        F.max("_amt").alias("mx"), F.min("_amt").alias("mn"), F.max("_us").alias("last_us"),
        F.min("_day").alias("first_day"), F.max("_day").alias("last_day"))
    days = rows.groupBy(*key, "_day").agg(F.lit(1).alias("_one")).groupBy(*key).agg(F.count("*").alias("nd"))
    new = marks.groupBy(*key).agg(F.count("*").alias("nm"))
    gone = horizon.groupBy(*key).agg(F.count("*").alias("ne"))
    sums = base.join(days, key, "full").join(new, key, "full").join(gone, key, "full")
    o = Window.partitionBy(S.USER).orderBy("_chunk")
    p = o.rowsBetween(Window.unboundedPreceding, -1)
    seen_day = F.last("last_day", ignorenulls=True).over(p)
    sums = sums.withColumn("nd", F.col("nd") - F.coalesce((F.col("first_day") == seen_day).cast("int"), F.lit(0)))

    def before(c, agg=F.sum):
        return agg(c).over(p)

    carry = sums.select(
        *key, F.col("n").isNotNull().alias("_real"),
        F.coalesce(before("n"), F.lit(0)).alias("c_n"), before("s1").alias("c_s1"), before("s2").alias("c_s2"),
        before("mx", F.max).alias("c_mx"), before("mn", F.min).alias("c_mn"),
        before("last_us", F.max).alias("c_us"), before("first_day", F.min).alias("c_first"),
        F.coalesce(before("nd"), F.lit(0)).alias("c_nd"), F.coalesce(before("nm"), F.lit(0)).alias("c_nm"),
        F.coalesce(before("ne"), F.lit(0)).alias("c_ne")).filter("_real").drop("_real")

    # the last window_rows amounts before a chunk are among the tails of earlier chunks
    tails = top_per_group(rows.select(*key, "_us", S.ROW_ID, "_amt"), key,
                          [F.col("_us").desc(), F.col(S.ROW_ID).desc()], window_rows)
    t = Window.partitionBy(S.USER).orderBy("_us", S.ROW_ID)
    prev = F.collect_list("_amt").over(t.rowsBetween(-window_rows, -1))
    first = Window.partitionBy(*key).orderBy("_us", S.ROW_ID)
    tails = tails.withColumn("c_tail", prev).withColumn("_rn", F.row_number().over(first))
    return carry.join(tails.filter("_rn = 1").select(*key, "c_tail"), key, "left")


def _carry_profiles(stored, carry, hot_df, rolling_window):
    """Per customer (per chunk of a hot one): what chunks and stored profiles contribute together."""
    p = stored.select(S.USER, *[F.col(c).alias(f"p_{c}") for c in ("n", "s1", "s2", "mx", "mn", "nd", "nm", "old", "last_us", "last_day")],
                      F.transform("tail", lambda t: t["amount"]).alias("p_tail"))
    if carry is None:
        c = p
        for name, kind in (("n", "long"), ("s1", _SUM), ("s2", _SQ), ("mx", _AMT), ("mn", _AMT), ("us", "long"), ("nd", "long"),
                           ("nm", "long"), ("ne", "long"), ("first", "date"), ("tail", f"array<{_AMT}>")):
            c = c.withColumn(f"c_{name}", F.lit(None).cast(kind))
    else:
        cold = p.join(hot_df, S.USER, "left_anti").withColumn("_chunk", F.lit(-1))
        c = carry.join(p, S.USER, "left").unionByName(cold, allowMissingColumns=True)

    def total(a, b):
        return F.coalesce(F.col(a) + F.col(b), a, b)

    none = F.array().cast(f"array<{_AMT}>")
    tail = F.concat(F.coalesce("p_tail", none), F.coalesce("c_tail", none))
    return c.select(
        S.USER, *([] if carry is None else ["_chunk"]), total("c_n", "p_n").alias("c_n"), total("c_s1", "p_s1").cast(_SUM).alias("c_s1"),
        total("c_s2", "p_s2").cast(_SQ).alias("c_s2"), F.greatest("c_mx", "p_mx").alias("c_mx"), F.least("c_mn", "p_mn").alias("c_mn"),
        F.coalesce("c_us", "p_last_us").alias("c_us"), total("c_nm", "p_nm").alias("c_nm"), total("c_ne", "p_old").alias("c_ne"),
        (total("c_nd", "p_nd") - F.coalesce((F.col("c_first") == F.col("p_last_day")).cast("int"), F.lit(0))).alias("c_nd"),
        F.slice(tail, F.greatest(F.lit(1), F.size(tail) - rolling_window + 1), F.lit(rolling_window)).alias("c_tail"))


def customer_history(txns: DataFrame, rolling_window: int = 5, velocity_hours: float = 1, hot_rows: int = HOT_ROWS,
                     chunk_rows: int | None = None, with_merchants: bool = True, profiles: Profiles | None = None) -> DataFrame:
    """Input rows plus the causal customer features (time_since_prev_txn is null on
    a customer's first row, see fill_first_gap). With profiles, the rows continue the
    payments these were built from; rows at or before a profile's end are an error."""
    absent = sorted(_REQUIRED - set(txns.columns))
    if absent:
        raise ValueError(f"features need the columns {absent}; clean the rows first")
    hour = int(velocity_hours * 3600) * 1_000_000
    base = txns.withColumn("_us", _micros(F.col(S.TS)))
    marks = base.select(S.USER, F.col(f"`{S.MERCHANT}`"), "_us", S.ROW_ID).groupBy(S.USER, S.MERCHANT).agg(
        F.min("_us").alias("_us"), F.min_by(S.ROW_ID, place(F.col("_us"), F.col(S.ROW_ID))).alias(S.ROW_ID))
    ends = carry = hot_df = None
    if profiles is not None:
        profiles = profiles.of(txns)
        profiles.check(txns, rolling_window, velocity_hours)
        met = profiles.merchants.select(F.col(S.USER).alias("_met_user"), F.col(f"`{S.MERCHANT}`").alias("_met"))
        marks = marks.join(met, (F.col(S.USER) == F.col("_met_user")) & F.col(f"`{S.MERCHANT}`").eqNullSafe(F.col("_met")), "left_anti")
        # stored payments of the last hour show up as end markers where they leave it
        ends = profiles.recent.select(S.USER, (F.col("us") + hour + 1).alias("_us"), F.lit(-2).alias("_from"))
    marks = marks.drop(S.MERCHANT)

    hot = _hot_users(txns, hot_rows)
    if hot:
        spark = txns.sparkSession
        kind = txns.schema[S.USER].dataType.simpleString()
        hot_df = F.broadcast(spark.createDataFrame([(u,) for u in hot], f"`{S.USER}` {kind}"))
        pooled = base.join(hot_df, S.USER, "left_semi")
        per_chunk = chunk_rows or hot_rows
        n_chunks = min(20_000, max(2, -(-2 * sum(hot.values()) // per_chunk)))
        cuts = value_cuts(pooled.select(F.col("_us").cast("double").alias("_us")), "_us", n_chunks)
        flags = F.broadcast(spark.createDataFrame([(u, True) for u in hot], f"`{S.USER}` {kind}, _hot boolean"))

        def cut(df, us):
            out = _time_chunk(df.join(flags, S.USER, "left"), cuts, us)
            return out.withColumn("_chunk", F.when(F.col("_hot"), F.col("_chunk")).otherwise(-1)).drop("_hot")

        base, marks = cut(base, F.col("_us")), cut(marks, F.col("_us"))
        hot_rows_df = _measures(base.filter("_chunk >= 0")).select(S.USER, "_chunk", "_us", S.ROW_ID, "_amt", "_sq", "_day")
        horizon = hot_rows_df.select(S.USER, (F.col("_us") + hour + 1).alias("_us"), F.col("_chunk").alias("_from"))
        horizon = _time_chunk(horizon, cuts, F.col("_us"))
        if ends is not None:
            horizon = horizon.unionByName(cut(ends, F.col("_us")))
        carry = _carry(hot_rows_df, marks.filter("_chunk >= 0"), horizon.filter("_chunk >= 0"), rolling_window)
        # a payment that leaves the velocity hour in a later chunk shows up there as an end marker
        ends = horizon.filter("_chunk > _from")
    else:
        base, marks = base.withColumn("_chunk", F.lit(-1)), marks.withColumn("_chunk", F.lit(-1))
        if ends is not None:
            ends = ends.withColumn("_chunk", F.lit(-1))
    if profiles is not None:
        carry = _carry_profiles(profiles.customers, carry, hot_df, rolling_window)

    stream = base.withColumn("_kind", F.lit(0))
    if with_merchants:
        stream = stream.unionByName(marks.withColumn("_kind", F.lit(1)), allowMissingColumns=True)
    if carry is not None:
        ends = ends.select(S.USER, "_chunk", "_us", F.lit(-1).cast("long").alias(S.ROW_ID), F.lit(-1).alias("_kind"))
        stream = stream.unionByName(ends, allowMissingColumns=True)
    # first scan: what the neighbours in the merged order say
    part = Window.partitionBy(S.USER, "_chunk")
    merged = part.orderBy("_us", S.ROW_ID, "_kind")
    before = merged.rowsBetween(Window.unboundedPreceding, -1)
    extra = {"_prev": F.last(F.when(F.col("_kind") == 0, F.col("_us")), ignorenulls=True).over(before)}
    if with_merchants:
        extra["_new_m"] = F.coalesce((F.lead("_kind").over(merged) == 1).cast("long"), F.lit(0))
    if carry is not None:
        extra["_ended"] = F.sum((F.col("_kind") == -1).cast("long")).over(before)
    rows = stream.withColumns(extra).filter("_kind = 0").drop("_kind")
    if carry is not None:
        # co-partitioned with the window output: only the small side moves
        rows = rows.join(carry, [S.USER, "_chunk"] if hot else S.USER, "left").withColumn("_prev", F.coalesce("_prev", "c_us"))
    rows = _measures(rows)
    day_before = F.to_date(F.timestamp_micros("_prev"))
    rows = rows.withColumn("_new_d", (day_before.isNull() | (day_before != F.col("_day"))).cast("long"))

    # second scan: running values over the customer's rows, then the velocity hour
    o = part.orderBy("_us", S.ROW_ID)
    p = o.rowsBetween(Window.unboundedPreceding, -1)
    expired = part.orderBy("_us").rangeBetween(Window.unboundedPreceding, -(hour + 1))
    running = {
        "_pos": (F.row_number().over(o) - 1).cast("long"),
        "_s1": F.sum("_amt").over(p), "_s2": F.sum("_sq").over(p),
        "_mx": F.max("_amt").over(p), "_mn": F.min("_amt").over(p),
        "_roll": F.sum("_amt").over(o.rowsBetween(-rolling_window, -1)),
        "_nd": F.coalesce(F.sum("_new_d").over(p), F.lit(0)),
    }
    if with_merchants:
        running["_nm"] = F.coalesce(F.sum("_new_m").over(p), F.lit(0))
    rows = rows.withColumns(running).withColumn("_left", F.count(F.lit(1)).over(expired))
    if carry is not None:
        short = F.greatest(F.lit(0), F.lit(rolling_window) - F.col("_pos")).cast("int")
        tail = F.coalesce("c_tail", F.array().cast(f"array<{_AMT}>"))
        used = F.slice(tail, F.greatest(F.lit(1), F.size(tail) - short + 1).cast("int"), short)
        none = F.lit(0).cast("long")
        joined = {
            "_n": F.col("_pos") + F.coalesce("c_n", none), "_nd": F.col("_nd") + F.coalesce("c_nd", none),
            "_s1": F.coalesce(F.col("_s1") + F.col("c_s1"), "_s1", "c_s1").cast(_SUM),
            "_s2": F.coalesce(F.col("_s2") + F.col("c_s2"), "_s2", "c_s2").cast(_SQ),
            "_mx": F.greatest("_mx", "c_mx"), "_mn": F.least("_mn", "c_mn"),
            "_roll": F.coalesce(F.col("_roll"), F.lit(0).cast(_SUM)) + F.aggregate(
                used, F.lit(0).cast(_SUM), lambda s, x: (s + F.coalesce(x, F.lit(0).cast(_AMT))).cast(_SUM)),
            "_roll_n": F.least(F.col("_pos"), F.lit(rolling_window)) + F.size(used),
            "_left": F.col("_left") + F.coalesce("_ended", none) + F.coalesce("c_ne", none),
        }
        if with_merchants:
            joined["_nm"] = F.col("_nm") + F.coalesce("c_nm", none)
    else:
        joined = {"_n": F.col("_pos"), "_roll_n": F.least(F.col("_pos"), F.lit(rolling_window))}
    rows = rows.withColumns(joined)

    n, a = F.col("_n"), _guard(F.col(S.AMOUNT).cast("double"))
    s1, s2 = F.col("_s1").cast("double"), F.col("_s2").cast("double")
    mean = F.when(n > 0, s1 / n)
    var = F.when((n > 1) & (F.col("_mx") > F.col("_mn")), (n * s2 - s1 * s1) / (n * (n - 1)))
    days = F.greatest(F.col("_nd"), F.lit(1))
    out = {
        "customer_avg_amount": F.coalesce(mean, a),
        "customer_max_amount": F.coalesce(F.col("_mx").cast("double"), a),
        "customer_txn_count": n.cast("long"),
        "avg_daily_spending": F.coalesce(s1, F.lit(0.0)) / days,
        "time_since_prev_txn": (F.col("_us") - F.col("_prev")) / F.lit(6e7),
        "rolling_avg_amount": F.when(F.col("_roll_n") > 0, F.col("_roll").cast("double") / F.col("_roll_n")).otherwise(a),
        "transaction_velocity": (n - F.col("_left")).cast("long"),
        "customer_activity_frequency": n.cast("double") / days,
        "amount_deviation_from_customer_mean": F.when(var > 0, (a - mean) / F.sqrt(var)).otherwise(0.0),
    }
    if with_merchants:
        out["merchant_diversity"] = F.col("_nm").cast("long")
    return rows.select(*[F.col(f"`{c}`") for c in txns.columns], *[v.alias(k) for k, v in out.items()])


def _guard(c):
    """0 for null, NaN and infinities."""
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), 0.0).otherwise(F.coalesce(c, F.lit(0.0)))


def gap_median(history: DataFrame):
    """Median minutes between payments over all customers; 0 if nobody paid twice."""
    m = exact_quantiles(history, "time_since_prev_txn", [0.5])[0]
    return 0.0 if m is None else m


def fill_first_gap(history: DataFrame, median: float) -> DataFrame:
    return history.withColumn("time_since_prev_txn", F.coalesce("time_since_prev_txn", F.lit(float(median))))


def merchant_stats(txns: DataFrame) -> DataFrame:
    """Per merchant: rows, mean, sample std, extremes; exact sums, combined map-side."""
    amt = F.col(S.AMOUNT).cast(_AMT)
    g = txns.filter(F.col(f"`{S.MERCHANT}`").isNotNull()).groupBy(S.MERCHANT).agg(
        F.count("*").alias("m_rows"), F.sum(amt).alias("_s1"), F.sum((amt * amt).cast("decimal(36,12)")).alias("_s2"),
        F.max(amt).alias("_mx"), F.min(amt).alias("_mn"))
    n, s1, s2 = F.col("m_rows"), F.col("_s1").cast("double"), F.col("_s2").cast("double")
    var = F.when((n > 1) & (F.col("_mx") > F.col("_mn")), (n * s2 - s1 * s1) / (n * (n - 1)))
    return g.select(F.col(f"`{S.MERCHANT}`"), "m_rows", F.col("m_rows").alias("m_count"),
                    (s1 / n).alias("m_mean"), F.sqrt(F.when(var > 0, var)).alias("m_std"))


def merchant_features(txns: DataFrame, stats: DataFrame | None = None, total: int | None = None,
                      broadcast_keys: int | None = None, hot_rows: int | None = None) -> DataFrame:
    """merchant_txn_frequency and amount_zscore_by_merchant; stats/total may come
    from a fitted table, else they describe these rows."""
    m = F.col(f"`{S.MERCHANT}`")
    if stats is None:
        stats = merchant_stats(txns)
        keys, total = txns.agg(F.approx_count_distinct(m), F.count(m)).first()
    else:
        keys = stats.count()
    opts = {k: v for k, v in (("broadcast_keys", broadcast_keys), ("hot_rows", hot_rows)) if v is not None}
    out = lookup_join(txns, stats, S.MERCHANT, keys, "m_rows", S.ROW_ID, **opts)
    a = F.col(S.AMOUNT).cast("double")
    return out.withColumns({
        "merchant_txn_frequency": F.coalesce(F.col("m_count") / F.lit(float(max(1, total))), F.lit(0.0)),
        "amount_zscore_by_merchant": _guard(F.when(F.col("m_std") > 0, (a - F.col("m_mean")) / F.col("m_std")).otherwise(0.0)),
    }).drop("m_count", "m_mean", "m_std")


def time_flags(df: DataFrame, business_hours=(9, 17), weekend_days=(5, 6)) -> DataFrame:
    return df.withColumns({
        "weekend_indicator": F.col(S.WEEKDAY).isin(*weekend_days).cast("long"),
        "business_hour_indicator": F.col(S.HOUR).between(*business_hours).cast("long"),
    })


def engineer(txns: DataFrame, fitted: dict | None = None, history: DataFrame | None = None,
             profiles: Profiles | None = None, **options) -> DataFrame:
    """All 14 features, appended in FEATURES order.

    fitted may hold gap_median, merchant_stats and merchant_total from training;
    history holds earlier payments so customer features do not restart, profiles
    what is stored of them: then nothing but the profiles and txns is read."""
    fitted = fitted or {}
    if history is not None and profiles is not None:
        raise ValueError("give history or profiles, not both")
    rows = txns
    if history is not None:
        keep = [F.col(f"`{c}`") for c in txns.columns]
        rows = txns.withColumn("_now", F.lit(True)).unionByName(
            history.select(*keep).withColumn("_now", F.lit(False)))
    core = customer_history(rows, profiles=profiles, **options)
    if history is not None:
        core = core.filter("_now").drop("_now")
    median = fitted.get("gap_median")
    if median is None:
        core = materialize(core, "history")
        median = gap_median(core)
    out = fill_first_gap(core, median)
    out = time_flags(merchant_features(out, fitted.get("merchant_stats"), fitted.get("merchant_total")))
    return out.select(*[F.col(f"`{c}`") for c in txns.columns], *S.FEATURES)
