"""Scores payments as they arrive against a running profile of each customer.

State per customer lives in the state store: counters, exact sums, the last amounts
and per-timestamp counts of the latest velocity hour as one value, with the distinct
merchants; many merchants lie in buckets, of which a batch reads those it meets; and
payments that wait for their turn, in chunks. A batch so makes a few calls a customer to the store, not
some a payment. A payment waits until the watermark has passed it, when nothing
earlier can arrive any more; then it meets the profile in event time, ties by row_id,
whatever order it came in. An event-time timer releases what waits when its customer
stays silent. Payments behind the watermark are dropped by Spark.

`score_stream` gives the customer features; `clean_stream` and `model_scores`
make a path from raw rows to the score of a fitted model.
"""

import uuid
from collections import deque
from decimal import Decimal

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from oddspend import schema as S
from oddspend.operators import clean as C, features as B
from oddspend.session import materialize, shared_dir

OUT = StructType([
    StructField(S.ROW_ID, LongType()), StructField(S.USER, LongType()),
    StructField("customer_avg_amount", DoubleType()), StructField("customer_max_amount", DoubleType()),
    StructField("customer_txn_count", LongType()), StructField("avg_daily_spending", DoubleType()),
    StructField("time_since_prev_txn", DoubleType()), StructField("rolling_avg_amount", DoubleType()),
    StructField("transaction_velocity", LongType()), StructField("merchant_diversity", LongType()),
    StructField("customer_activity_frequency", DoubleType()),
    StructField("amount_deviation_from_customer_mean", DoubleType()),
])
#: With what else a row had, as JSON, and its time.
OUT_ROWS = StructType([*OUT.fields, StructField("us", LongType()), StructField("row", StringType())])
_DAY = 86_400_000_000
_NO_MERCHANT = -(1 << 63)  # stands for null, so that identifiers stay whole numbers
CHUNK = 1024  # waiting payments of one entry of the store
BUCKET = 512  # merchants kept in the profile; a customer with more has buckets of so many in the mean
_ROW = Row(*OUT_ROWS.fieldNames())
_NEW = (0, "0", "0", None, None, None, 0, [], 0, [], 0, [], [], 0, None)


def _in_order(row):
    return row[:3]


def _place(merchant, buckets):
    """One of the buckets, a power of two, by the middle bits of a product: ids may share their low bits."""
    return (merchant * 0x9E3779B97F4A7C15 >> 32) & (buckets - 1)


class CustomerProfile(StatefulProcessor):
    """unique: of rows of one time that are alike in all but row_id, only the one with the lowest counts."""

    def __init__(self, rolling_window=5, velocity_hours=1.0, unique=False):
        self.window, self.span, self.unique = rolling_window, int(velocity_hours * 3600) * 1_000_000, unique

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # sums are integers in millionths, as text: exact and unbounded
        self.profile = handle.getValueState(
            "profile", "n long, s1 string, s2 string, mx long, mn long, last long, days long, recent array<long>, merchants long, "
            "own array<long>, buckets long, hour array<long>, hour_n array<long>, arrived long, timer long")
        # merchants of a customer with more than BUCKET; own holds them up to there
        self.merchants = handle.getMapState("merchants", "bucket long", "ids array<long>")
        # us: the earliest time of the chunk; rows in order
        self.waiting = handle.getMapState(
            "waiting", "us long, row_id long, k long", "us array<long>, row_id array<long>, k array<long>, micro array<long>, merchant array<long>, row array<string>")

    def handleInputRows(self, key, rows, timerValues):
        *profile, arrived, timer = self.profile.get() or _NEW
        fresh = [(r.us, r[S.ROW_ID], arrived + k, r.micro, r.merchant, r.row) for k, r in enumerate(rows)]
        yield from self._release(key, fresh, profile, arrived + len(fresh), timer, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        *profile, arrived, _ = self.profile.get()
        yield from self._release(key, [], profile, arrived, None, timerValues)

    def _release(self, key, fresh, profile, arrived, timer, timerValues):
        """Scores all rows that the watermark has passed, in order; keeps the others."""
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        ready, later, due = [r for r in fresh if r[0] <= passed], [r for r in fresh if r[0] > passed], []
        if arrived > len(fresh):
            for k, chunk in list(self.waiting.iterator()):
                if k[0] > passed:
                    due.append(k[0])
                    continue
                self.waiting.removeKey(k)
                for r in zip(*chunk):
                    (ready if r[0] <= passed else later).append(r)
        later.sort(key=_in_order)
        for at in range(0, len(later), CHUNK):
            part = later[at:at + CHUNK]
            self.waiting.updateValue(part[0][:3], tuple(list(c) for c in zip(*part)))
            due.append(part[0][0])
        due = -(-min(due) // 1000) if due else None
        if due != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if due is not None:
                self.handle.registerTimer(due)
        ready.sort(key=_in_order)
        if self.unique:
            ready = list({(r[0], *r[3:]): r for r in reversed(ready)}.values())[::-1]
        out, profile = self._score(key[0], ready, profile) if ready else ([], profile)
        self.profile.update((*profile, arrived, due))
        return out

    def _bucket(self, i):
        return set(self.merchants.getValue((i,))[0]) if self.merchants.containsKey((i,)) else set()

    def _add_merchants(self, buckets, count, found):
        """found: {bucket: merchants} as they are now; without buckets, all under -1. Returns (merchants
        to keep beside the profile, number of buckets), doubled while they are too full."""
        if count <= BUCKET:
            return sorted(found[-1]), 0
        wanted = max(1, buckets)
        while count > BUCKET * wanted:
            wanted *= 2
        if wanted > buckets:
            every = found[-1] if not buckets else [m for i in range(buckets) for m in (found[i] if i in found else self._bucket(i))]
            found = {i: [] for i in range(wanted)}
            for m in every:
                found[_place(m, wanted)].append(m)
        for i, ids in found.items():
            self.merchants.updateValue((i,), (sorted(ids),))
        return [], wanted

    def _score(self, user, ready, profile):
        n, s1, s2, mx, mn, last, days, recent, merchants, own, buckets, times, counts = profile
        s1, s2, recent, hour = int(s1), int(s2), list(recent), deque(zip(times, counts))
        within, out, known, added = sum(counts), [], {-1: set(own)}, {}
        for us, rid, _, a, merchant, row in ready:
            while hour and hour[0][0] < us - self.span:
                within -= hour.popleft()[1]
            x = a / 1e6
            mean = (s1 / 1e6) / n if n else x
            dev = 0.0
            if n > 1 and mx > mn:
                f1, f2 = s1 / 1e6, s2 / 1e12
                var = (n * f2 - f1 * f1) / (n * (n - 1))
                dev = (x - mean) / var ** 0.5 if var > 0 else 0.0
            d = max(1, days)
            out.append(_ROW(
                rid, user, mean, mx / 1e6 if n else x, n, s1 / 1e6 / d,
                None if last is None else (us - last) / 6e7,
                sum(recent) / 1e6 / len(recent) if recent else x,
                within, merchants, float(n) / d, dev, us, row))
            if last is None or us // _DAY != last // _DAY:
                days += 1
            n, s1, s2 = n + 1, s1 + a, s2 + a * a
            mx, mn = (a, a) if mx is None else (max(mx, a), min(mn, a))
            recent = (recent + [a])[-self.window:]
            if hour and hour[-1][0] == us:
                hour[-1] = (us, hour[-1][1] + 1)
            else:
                hour.append((us, 1))
            within += 1
            last = us
            if merchant != _NO_MERCHANT:
                at = _place(merchant, buckets) if buckets else -1
                if at not in known:
                    known[at] = self._bucket(at)
                if merchant not in known[at]:
                    known[at].add(merchant)
                    added[at] = known[at]
                    merchants += 1
        if added:
            own, buckets = self._add_merchants(buckets, merchants, added)
        return out, (n, str(s1), str(s2), mx, mn, last, days, recent, merchants, own, buckets, [h[0] for h in hour], [h[1] for h in hour])

    def close(self) -> None:
        pass


def _profiles(txns: DataFrame, watermark: str, row, **options) -> DataFrame:
    rows = txns.withColumn("event", F.col(S.TS).cast("timestamp")).withWatermark("event", watermark).select(
        F.coalesce(S.ROW_ID, F.lit(-1)).alias(S.ROW_ID), S.USER, "event", F.unix_micros("event").alias("us"),
        F.coalesce((F.col(S.AMOUNT).cast("decimal(18,6)") * F.lit(Decimal(1000000))).cast("long"), F.lit(0)).alias("micro"),
        F.coalesce(F.col(f"`{S.MERCHANT}`").cast("long"), F.lit(_NO_MERCHANT)).alias("merchant"), row.alias("row"))
    return rows.groupBy(S.USER).transformWithState(
        statefulProcessor=CustomerProfile(**options), outputStructType=OUT_ROWS, outputMode="Append", timeMode="EventTime")


def score_stream(txns: DataFrame, watermark: str = "1 hour", **options) -> DataFrame:
    """Streaming rows (row_id, User, transaction_datetime, Amount, Merchant Name) with
    the running customer features of each, append mode. The session needs the
    RocksDB state store provider."""
    return _profiles(txns, watermark, F.lit(None).cast("string"), **options).select(*OUT.fieldNames())


def clean_stream(raw: DataFrame, stats: C.CleanStats, watermark: str = "1 hour", strict: bool = True, **options) -> DataFrame:
    """Raw streaming rows cleaned with fitted statistics, with the running customer
    features of each. Repeated rows have one time, so they leave the state together
    and all but the one with the lowest row_id go, as in a batch."""
    rows = C.fill_categories(C.parse_datetime(C.parse_amount(raw, strict)))
    rows = C.impute_amount(rows, stats.amount_median)
    rest = [c for c in rows.columns if c not in (S.ROW_ID, S.TS, S.USER)]
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rest]), {"ignoreNullFields": "false", "timestampFormat": _JSON_TIME, "timestampNTZFormat": _JSON_NTZ})
    clipped = C.clip_amount(rows.withColumn("row", row), stats.clip_low, stats.clip_high)
    found = _profiles(clipped, watermark, F.col("row"), unique=True, **options)
    kinds = StructType([rows.schema[c] for c in rest])
    found = found.withColumn("row", F.from_json("row", kinds, {"timestampFormat": _JSON_TIME, "timestampNTZFormat": _JSON_NTZ}))
    time = F.timestamp_micros("us").cast(rows.schema[S.TS].dataType).alias(S.TS)
    places = {S.ROW_ID: F.col(S.ROW_ID), S.USER: F.col(S.USER), S.TS: time}
    found = found.select(*[places.get(c, F.col(f"row.`{c}`").alias(c)) for c in rows.columns], *[c for c in OUT.fieldNames() if c not in (S.ROW_ID, S.USER)])
    return C.extract_label(C.clip_amount(found, stats.clip_low, stats.clip_high))


_JSON_TIME, _JSON_NTZ = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def model_scores(profiled: DataFrame, fitted, path: str, checkpoint: str, trigger: dict | None = None):
    """Starts a query that writes each micro-batch of cleaned, profiled rows with its
    merchant and time features, anomaly_score and is_anomaly to <path>/batch=<n>.

    fitted() -> (Prepared, model) is asked once per batch, so a merchant table, an encoder or
    a model that was fitted anew takes effect with the next batch. A batch that is repeated
    after a failure replaces its own files."""

    def score(rows: DataFrame, number: int) -> None:
        prepared, model = fitted()
        found = B.fill_first_gap(rows, prepared.gap_median)
        found = B.time_flags(B.merchant_features(found, prepared.merchants, prepared.merchant_total))
        found = found.select(*[c for c in (F.col(f"`{c}`") for c in rows.columns if c not in S.FEATURES)], *S.FEATURES)
        model.predict(prepared.encoder.matrix(found)).drop("features").write.mode("overwrite").parquet(f"{path}/batch={number}")

    return profiled.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint).outputMode("append").trigger(
        **(trigger or {"availableNow": True})).start()


def use_rocksdb(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def _arrivals(rows: DataFrame, columns, files: int, jitter_seconds: int, watermark_seconds: int):
    """(session, folder of a streaming source, time of its end): timed rows in `files` files by
    arrival, which is the time of the row plus a delay drawn by hash below jitter_seconds. The
    end is so late that the watermark passes all rows when a row of that time has arrived."""
    spark, root = rows.sparkSession, f"{shared_dir(rows.sparkSession)}/stream-{uuid.uuid4().hex}"
    delay = F.pmod(F.xxhash64(S.ROW_ID), F.lit(max(1, jitter_seconds))) * 1_000_000
    us = F.unix_micros(F.col(S.TS).cast("timestamp"))
    cut = materialize(rows.withColumn("_at", us + delay).select(*[F.col(f"`{c}`") for c in columns], "_at"), "replay")
    lo, hi = cut.agg(F.min("_at"), F.max("_at")).first()
    if lo is None:
        lo = hi = 0
    part = F.floor((F.col("_at") - lo) / F.lit(max(1, -(-(hi - lo + 1) // files)))).cast("int")
    for i in range(files):
        cut.filter(part == i).drop("_at").coalesce(1).write.parquet(f"{root}/in/part={i:04d}")
    return spark, root, hi + (watermark_seconds + 60) * 1_000_000


def _read_arrivals(spark, root: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{root}/in")


def replay(txns: DataFrame, files: int = 4, jitter_seconds: int = 0, watermark_seconds: int = 3600, **options) -> DataFrame:
    """Runs a table through the stream in `files` micro-batches, by the time rows would
    arrive with delays below jitter_seconds, and returns the profiled rows."""
    use_rocksdb(txns.sparkSession)
    spark, root, end = _arrivals(txns, txns.columns, files, jitter_seconds, watermark_seconds)
    time = F.timestamp_micros(F.lit(end)).cast(txns.schema[S.TS].dataType)
    last = spark.range(1).select(*[(time if c == S.TS else F.lit(None).cast(txns.schema[c].dataType)).alias(c) for c in txns.columns])
    last.coalesce(1).write.parquet(f"{root}/in/part=9999")
    query = score_stream(_read_arrivals(spark, root, txns.schema), f"{watermark_seconds} seconds", **options).writeStream.format("parquet").option(
        "path", f"{root}/out").option("checkpointLocation", f"{root}/state").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(OUT).parquet(f"{root}/out")


def replay_scores(raw: DataFrame, prepared, model, files: int = 4, jitter_seconds: int = 0, watermark_seconds: int = 3600) -> DataFrame:
    """Runs raw rows through the stream and the fitted model and returns the scored rows."""
    use_rocksdb(raw.sparkSession)
    spark, root, end = _arrivals(C.parse_datetime(raw), raw.columns, files, jitter_seconds, watermark_seconds)
    moment = F.timestamp_micros(F.lit(end))
    parts = {"Year": F.year(moment), "Month": F.month(moment), "Day": F.dayofmonth(moment), "Time": F.date_format(moment, "HH:mm")}
    last = spark.range(1).select(*[(parts[c] if c in parts else F.lit(None)).cast(raw.schema[c].dataType).alias(c) for c in raw.columns])
    last.coalesce(1).write.parquet(f"{root}/in/part=9999")
    profiled = clean_stream(_read_arrivals(spark, root, raw.schema), prepared.clean, f"{watermark_seconds} seconds")
    model_scores(profiled, lambda: (prepared, model), f"{root}/out", f"{root}/state").awaitTermination()
    return spark.read.parquet(f"{root}/out").drop("batch")
