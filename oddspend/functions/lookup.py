"""Joins of rows with a per-key table, safe for hot keys and large tables."""

from pyspark.sql import DataFrame, functions as F

BROADCAST_KEYS = 500_000
HOT_ROWS = 5_000_000
_SALTS = 4096


def lookup_join(rows: DataFrame, table: DataFrame, key: str, n_keys: int, weight: str,
                spread: str, broadcast_keys: int = BROADCAST_KEYS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left join rows with table on key.

    n_keys is the (estimated) number of keys; up to broadcast_keys of them the
    table is broadcast and the rows do not move. Beyond that, the keys that
    weight says hold more than hot_rows rows (few by definition) are broadcast
    and the rest is joined by shuffle; rows of hot keys get a null key plus a
    salt made from the spread column, so they scatter evenly through that shuffle.
    """
    k = f"`{key}`"
    if n_keys <= broadcast_keys:
        return rows.join(F.broadcast(table.drop(weight)), key, "left")
    values = [c for c in table.columns if c not in (key, weight)]
    hot = table.filter(F.col(weight) > hot_rows)
    cold = table.filter(F.col(weight) <= hot_rows)
    hot = hot.select(F.col(k).alias("_hot_key"), *[F.col(f"`{v}`").alias(f"_hot_{v}") for v in values])
    cold = cold.select(F.col(k).alias("_cold_key"), F.lit(0).alias("_cold_salt"),
                       *[F.col(f"`{v}`").alias(f"_cold_{v}") for v in values])
    out = rows.join(F.broadcast(hot), F.col(k) == F.col("_hot_key"), "left")
    is_hot = F.col("_hot_key").isNotNull() | F.col(k).isNull()
    out = out.withColumn("_join_key", F.when(~is_hot, F.col(k))).withColumn(
        "_salt", F.when(is_hot, F.pmod(F.hash(spread), F.lit(_SALTS)) + 1).otherwise(0))
    out = out.join(cold, (F.col("_join_key") == F.col("_cold_key")) & (F.col("_salt") == F.col("_cold_salt")), "left")
    picked = [F.coalesce(F.col(f"`_hot_{v}`"), F.col(f"`_cold_{v}`")).alias(v) for v in values]
    return out.select(*[F.col(f"`{c}`") for c in rows.columns], *picked)
