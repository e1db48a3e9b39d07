"""Running totals along one global order without a single-task window."""

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F, Window

SMALL = 1_000_000


def value_cuts(df: DataFrame, col: str, buckets: int):
    """Sorted split points for Bucketizer: approximate quantiles, so only the
    balance of the buckets depends on them, never a result."""
    probs = [i / buckets for i in range(1, buckets)]
    got = df.agg(F.percentile_approx(col, probs, max(10000, 20 * buckets)).alias("q")).first().q or []
    return [float("-inf"), *sorted({float(v) for v in got if math.isfinite(v)}), float("inf")]


def bucket_of(df: DataFrame, col: str, cuts, out: str) -> DataFrame:
    """Index of the interval [cut, next cut) that holds the value (binary search); NaN has one of its own."""
    if len(cuts) < 3:
        return df.withColumn(out, F.lit(0))
    b = Bucketizer(splits=cuts, inputCol=col, outputCol=out, handleInvalid="keep")
    return b.transform(df).withColumn(out, F.col(out).cast("int"))


def running_totals(df: DataFrame, keys, order: str, sums, descending=False, small: int = SMALL) -> DataFrame:
    """Adds cum_<c> for each c of sums: the inclusive running total per key along
    `order` (unique inside a key). Up to `small` rows one window per key does it.
    Beyond, rows are cut into value buckets, totals of earlier buckets are joined
    in, and each window covers one bucket."""
    o = F.col(order).desc() if descending else F.col(order).asc()
    n = df.count()
    if n <= small:
        w = Window.partitionBy(*keys).orderBy(o).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({f"cum_{c}": F.sum(c).over(w) for c in sums})
    cuts = value_cuts(df.withColumn("_o", F.col(order).cast("double")), "_o", max(2, -(-4 * n // small)))
    cut = bucket_of(df.withColumn("_o", F.col(order).cast("double")), "_o", cuts, "_b")
    cut = cut.withColumn("_b", F.when(F.col("_o").isNull(), -1).otherwise(F.col("_b"))).drop("_o")  # null is lowest in Spark's order
    wb = Window.partitionBy(*keys).orderBy(F.col("_b").desc() if descending else F.col("_b").asc()).rowsBetween(
        Window.unboundedPreceding, -1)
    totals = cut.groupBy(*keys, "_b").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    before = totals.select(*keys, "_b", *[F.coalesce(F.sum(f"_t_{c}").over(wb), F.lit(0)).alias(f"_p_{c}") for c in sums])
    w = Window.partitionBy(*keys, "_b").orderBy(o).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.withColumns({f"_c_{c}": F.sum(c).over(w) for c in sums})
    joined = local.join(before, [*keys, "_b"])
    return joined.select(*df.columns, *[(F.col(f"_c_{c}") + F.col(f"_p_{c}")).alias(f"cum_{c}") for c in sums])
