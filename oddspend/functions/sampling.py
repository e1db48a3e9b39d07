"""Seeded samples of an exact size, chosen by a hash cut-off instead of a sort."""

from pyspark.sql import DataFrame, functions as F, Window

from oddspend.functions.quantiles import order_statistic

PRIME = 2147483647
WORD = 2147483648
MULT, CARRY, FOLD = 1103515245, 69621, 48271
SPAN = PRIME * WORD  # hashes are below this


def id_hash(col, seed: int):
    """Hash of an integer id to about 62 bits, made of its high and its low 31-bit word by
    congruences; any SQL engine can compute it. Ids of different scan partitions differ in
    the high word and get hashes of their own."""
    c = (F.col(f"`{col}`") if isinstance(col, str) else col).cast("bigint")
    low = F.pmod(c, F.lit(WORD))
    high = F.pmod(F.shiftright(c, 31), F.lit(PRIME))
    x = F.pmod(low * F.lit(MULT) + F.pmod(high * F.lit(CARRY), F.lit(PRIME)) + F.lit(seed), F.lit(PRIME))
    return x * F.lit(WORD) + F.pmod(x * F.lit(FOLD) + high, F.lit(PRIME))


def _smallest(df: DataFrame, h, row_id: str, k: int):
    """Condition for the k rows of df with the smallest (hash, id), 0 < k <= rows."""
    cut = order_statistic(df.select(h.alias("_h")), "_h", k - 1)
    upto, below = df.agg(F.count_if(h <= cut), F.count_if(h < cut)).first()
    if upto == k:
        return h <= F.lit(cut)
    last = order_statistic(df.filter(h == F.lit(cut)), f"`{row_id}`", k - below - 1)
    return (h < F.lit(cut)) | ((h == F.lit(cut)) & (F.col(f"`{row_id}`") <= F.lit(last)))


def take_fixed(df: DataFrame, k: int, row_id: str, seed: int = 42, n: int | None = None) -> DataFrame:
    """Exactly min(k, rows) rows with the smallest (hash, id).

    The k-th smallest hash, and the id among equal hashes, are found by distributed
    selection and rows are kept by comparing with them: no task sorts or holds the sample."""
    n = df.count() if n is None else n
    if k >= n:
        return df
    if k <= 0:
        return df.limit(0)
    return df.filter(_smallest(df, id_hash(row_id, seed), row_id, k))


def sample_users(df: DataFrame, user: str, frac: float, seed: int = 42) -> DataFrame:
    """Whole histories of max(1, round(users * frac)) users."""
    users = df.select(F.col(f"`{user}`")).distinct()
    n = users.count()
    k = max(1, int(n * frac + 0.5))
    return df.join(take_fixed(users, k, user, seed, n), user, "left_semi")


def stratified_split(df: DataFrame, row_id: str, label: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds `split`: in every label class (null is one) exactly the ceil(test_size * n)
    rows with the smallest (hash, id) are 'test'. One class only means a plain split of all rows."""
    import math

    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}  # two classes
    h = id_hash(row_id, seed)
    test = F.lit(False)
    for cls, n in counts.items():
        k = math.ceil(round(n * test_size, 9))
        if k == 0:
            continue
        own = F.col(label).eqNullSafe(F.lit(cls))
        test = test | (own & _smallest(df.filter(own), h, row_id, k))
    return df.withColumn("split", F.when(test, "test").otherwise("train"))


def time_split(df: DataFrame, ts_micros, test_size: float = 0.2) -> DataFrame:
    """Adds `split` by time: the latest test_size share of rows is 'test'."""
    n = df.count()
    cut = order_statistic(df.select(ts_micros.alias("_t")), "_t", max(0, int(n * (1 - test_size)) - 1))
    return df.withColumn("split", F.when(ts_micros > F.lit(int(cut)), "test").otherwise("train"))


def head_rows(df: DataFrame, n: int, row_id: str) -> DataFrame:
    """The first n rows in row_id order, by cut-off (n may be large)."""
    total = df.count()
    if n >= total:
        return df
    if n <= 0:
        return df.limit(0)
    cut = order_statistic(df, F.col(f"`{row_id}`"), n - 1)
    return df.filter(F.col(f"`{row_id}`") <= F.lit(int(cut)))


def top_per_group(df: DataFrame, groups, order, k: int) -> DataFrame:
    """First k rows per group; Spark prunes each map task to k rows per group
    before the shuffle, so a hot group stays small."""
    w = Window.partitionBy(*[F.col(f"`{g}`") for g in groups]).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")
