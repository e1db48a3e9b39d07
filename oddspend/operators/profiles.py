"""Stored customer profiles: what a customer's past contributes to the features of later payments.

A profile is built from a stretch of payments and merged with that of a later stretch, so a new
batch is scored from the profiles and the batch alone; earlier payments are not read again.
Three tables hold it, none with an array that grows with the history:

* customers: one row each, with count, exact sums, extremes, distinct days and merchants, first
  and last place in the order (transaction_datetime, row_id), the last `rolling_window` amounts,
  and the number of payments older than the velocity hour of the last one;
* merchants: the distinct (customer, merchant) pairs, a null merchant being one;
* recent: (customer, time) of the payments within the velocity hour of the customer's last one.

Sums are DECIMAL, so profiles of parts merge to the profile of the whole, bit for bit. Stretches
must follow each other for every customer: an overlap raises. Payments without a customer have
no profile, those without a time are refused by cleaning. An empty table gives empty profiles.
"""

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from oddspend import schema as S
from oddspend.functions.lookup import lookup_join
from oddspend.functions.sampling import top_per_group
from oddspend.session import materialize

_AMT, _SUM, _SQ = "decimal(18,6)", "decimal(28,6)", "decimal(38,12)"
_TABLES = ("customers", "merchants", "recent")


def place(us, row_id):
    """One number that orders (time, row id), so that extremes combine in hash aggregates."""
    return (us.cast("decimal(38,0)") * F.lit("10000000000000000000").cast("decimal(20,0)") + row_id).cast("decimal(38,0)")


@dataclass
class Profiles:
    customers: DataFrame
    merchants: DataFrame
    recent: DataFrame
    rolling_window: int = 5
    velocity_hours: float = 1

    @property
    def hour(self) -> int:
        return int(self.velocity_hours * 3600) * 1_000_000

    def of(self, txns: DataFrame) -> "Profiles":
        """The profiles of the customers that txns holds."""
        users = txns.select(S.USER).distinct()
        return replace(self, **{t: getattr(self, t).join(users, S.USER, "left_semi") for t in _TABLES})

    def check(self, txns: DataFrame, rolling_window: int, velocity_hours: float):
        """Raises unless txns follow these profiles and the settings are those they were built with."""
        if (rolling_window, velocity_hours) != (self.rolling_window, self.velocity_hours):
            raise ValueError(f"the profiles were built with rolling_window={self.rolling_window}, velocity_hours={self.velocity_hours}")
        us = F.unix_micros(F.col(S.TS).cast("timestamp"))
        first = txns.groupBy(S.USER).agg(F.min(place(us, F.col(S.ROW_ID))).alias("_from"))
        _refuse_overlap(first.join(self.customers.select(S.USER, place(F.col("last_us"), F.col("last_id")).alias("_upto")), S.USER))


def _refuse_overlap(pairs: DataFrame):
    n = pairs.filter("_from <= _upto").count()
    if n:
        raise ValueError(f"{n} customers have payments before the end of their stored profile")


def build(txns: DataFrame, rolling_window: int = 5, velocity_hours: float = 1, **join_options) -> Profiles:
    """Profiles of cleaned payments. Rows are reduced to (customer, day) in the scan's own tasks,
    and the last amounts to a few rows per customer and task, before anything is shuffled."""
    hour = int(velocity_hours * 3600) * 1_000_000
    a = F.col(S.AMOUNT).cast(_AMT)
    rows = txns.filter(F.col(S.USER).isNotNull()).select(
        S.USER, F.col(f"`{S.MERCHANT}`"), S.ROW_ID, a.alias("_amt"), (a * a).cast("decimal(36,12)").alias("_sq"),
        F.unix_micros(F.col(S.TS).cast("timestamp")).alias("_us"), F.to_date(S.TS).alias("_day"))
    at = place(F.col("_us"), F.col(S.ROW_ID))
    days = rows.groupBy(S.USER, "_day").agg(
        F.count("*").alias("n"), F.sum("_amt").alias("s1"), F.sum("_sq").alias("s2"), F.max("_amt").alias("mx"), F.min("_amt").alias("mn"),
        F.min("_us").alias("first_us"), F.min_by(S.ROW_ID, at).alias("first_id"), F.max("_us").alias("last_us"), F.max_by(S.ROW_ID, at).alias("last_id"))
    base = materialize(days.groupBy(S.USER).agg(
        F.sum("n").alias("n"), F.sum("s1").cast(_SUM).alias("s1"), F.sum("s2").cast(_SQ).alias("s2"), F.max("mx").alias("mx"), F.min("mn").alias("mn"),
        F.count("_day").alias("nd"), F.min("_day").alias("first_day"), F.max("_day").alias("last_day"),
        F.min("first_us").alias("first_us"), F.min_by("first_id", place(F.col("first_us"), F.col("first_id"))).alias("first_id"),
        F.max("last_us").alias("last_us"), F.max_by("last_id", place(F.col("last_us"), F.col("last_id"))).alias("last_id")), "profile")
    tails = top_per_group(rows.select(S.USER, "_us", S.ROW_ID, "_amt"), [S.USER], [F.col("_us").desc(), F.col(S.ROW_ID).desc()], rolling_window)
    tails = tails.groupBy(S.USER).agg(F.sort_array(F.collect_list(F.struct(
        F.col("_us").alias("us"), F.col(S.ROW_ID).alias("id"), F.col("_amt").alias("amount")))).alias("tail"))
    ends = base.select(S.USER, F.col("n").alias("_rows"), F.col("last_us").alias("_last"))
    recent = lookup_join(rows.select(S.USER, "_us", S.ROW_ID), ends, S.USER, base.count(), "_rows", S.ROW_ID, **join_options)
    recent = materialize(recent.filter(F.col("_us") >= F.col("_last") - hour).select(S.USER, F.col("_us").alias("us")), "profile_recent")
    merchants = materialize(rows.select(S.USER, F.col(f"`{S.MERCHANT}`")).distinct(), "profile_merchants")
    return _counted(base.join(tails, S.USER), merchants, recent, rolling_window, velocity_hours)


def _counted(customers: DataFrame, merchants: DataFrame, recent: DataFrame, rolling_window: int, velocity_hours: float) -> Profiles:
    """Adds to the customers what the two other tables say: merchants, and payments older than the last hour."""
    met = merchants.groupBy(S.USER).agg(F.count("*").alias("nm"))
    late = recent.groupBy(S.USER).agg(F.count("*").alias("_recent"))
    table = customers.join(met, S.USER).join(late, S.USER).withColumn("old", F.col("n") - F.col("_recent")).drop("_recent")
    return Profiles(materialize(table, "profile_customers"), merchants, recent, rolling_window, velocity_hours)


def merge(early: Profiles, late: Profiles) -> Profiles:
    """Profiles of both stretches; every customer's late payments must follow the early ones."""
    if (early.rolling_window, early.velocity_hours) != (late.rolling_window, late.velocity_hours):
        raise ValueError("the profiles were built with different settings")
    window, key = early.rolling_window, F.col(S.USER)
    left = early.customers.select(key, *[F.col(c).alias(f"a_{c}") for c in early.customers.columns if c != S.USER])
    right = late.customers.select(key, *[F.col(c).alias(f"b_{c}") for c in early.customers.columns if c != S.USER])
    both = materialize(left.join(right, S.USER, "full"), "profile_pairs")
    _refuse_overlap(both.select(place(F.col("b_first_us"), F.col("b_first_id")).alias("_from"), place(F.col("a_last_us"), F.col("a_last_id")).alias("_upto")))

    def total(c, kind="bigint"):
        return F.coalesce(F.col(f"a_{c}") + F.col(f"b_{c}"), f"a_{c}", f"b_{c}").cast(kind).alias(c)

    same_day = F.coalesce((F.col("a_last_day") == F.col("b_first_day")).cast("int"), F.lit(0))
    tail = F.when(F.col("a_tail").isNull(), F.col("b_tail")).when(F.col("b_tail").isNull(), F.col("a_tail")).otherwise(F.concat("a_tail", "b_tail"))
    customers = both.select(
        key, total("n"), total("s1", _SUM), total("s2", _SQ), F.greatest("a_mx", "b_mx").alias("mx"), F.least("a_mn", "b_mn").alias("mn"),
        (total("nd") - same_day).cast("bigint").alias("nd"),
        *[F.coalesce(f"a_{c}", f"b_{c}").alias(c) if c.startswith("first") else F.coalesce(f"b_{c}", f"a_{c}").alias(c)
          for c in ("first_day", "last_day", "first_us", "first_id", "last_us", "last_id")],
        F.slice(tail, F.greatest(F.lit(1), F.size(tail) - window + 1), F.lit(window)).alias("tail"))
    merchants = materialize(early.merchants.unionByName(late.merchants).distinct(), "profile_merchants")
    ends = late.customers.select(S.USER, F.col("last_us").alias("_last"))
    kept = early.recent.join(ends, S.USER, "left").filter(F.col("_last").isNull() | (F.col("us") >= F.col("_last") - early.hour)).drop("_last")
    recent = materialize(kept.unionByName(late.recent), "profile_recent")
    return _counted(customers, merchants, recent, window, early.velocity_hours)


def save(profiles: Profiles, path: str):
    """Writes the tables as Parquet below path, which must not be the folder they are read from."""
    spark = profiles.customers.sparkSession
    for t in _TABLES:
        getattr(profiles, t).write.mode("overwrite").parquet(f"{path}/{t}")
    spark.createDataFrame([(profiles.rolling_window, float(profiles.velocity_hours))], "rolling_window int, velocity_hours double").write.mode(
        "overwrite").parquet(f"{path}/settings")


def load(spark: SparkSession, path: str) -> Profiles:
    s = spark.read.parquet(f"{path}/settings").first()
    return Profiles(*[spark.read.parquet(f"{path}/{t}") for t in _TABLES], s.rolling_window, s.velocity_hours)
