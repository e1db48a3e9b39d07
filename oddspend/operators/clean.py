"""Cleaning: raw 15-column rows to typed, filled, deduplicated, clipped rows.

Rows carry a unique BIGINT `row_id` and the label stays on its row.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

from oddspend import schema as S
from oddspend.functions.lookup import lookup_join
from oddspend.functions.quantiles import exact_quantiles
from oddspend.functions.sampling import top_per_group
from oddspend.session import materialize


@dataclass
class CleanStats:
    """Whole-table values cleaning needs; keep them to clean later batches alike."""
    amount_median: float | None
    clip_low: float | None
    clip_high: float | None


def currency(col):
    """Number in a '$1,234.50' text, null where there is none."""
    v = F.translate(col.cast("string"), "$,", "").try_cast("double")
    return F.nanvl(v, F.lit(None).cast("double"))


def parse_amount(df: DataFrame, strict: bool = True, col: str = S.AMOUNT) -> DataFrame:
    """Amount as DOUBLE. strict raises on text that is no number; else it becomes null."""
    raw = F.col(col)
    if isinstance(df.schema[col].dataType, T.NumericType):
        return df.withColumn(col, F.nanvl(raw.cast("double"), F.lit(None).cast("double")))
    v = currency(raw)
    if strict:
        # every step refers to the parsed value once, so it is parsed once
        v = F.coalesce(v, F.when(raw.isNotNull() & (F.lower(F.trim(raw)) != "nan"),
                                 F.raise_error(F.concat(F.lit("not an amount: "), raw)).cast("double")))
    return df.withColumn(col, v)


def parse_datetime(df: DataFrame) -> DataFrame:
    """Timestamp from Year/Month/Day/Time plus hour and weekday (Monday = 0).

    Hour and minute that are no numbers count as 0 and are clipped to their
    range; rows with an impossible date are dropped."""
    def piece(i, top):
        text = F.split_part(F.col("Time"), F.lit(":"), F.lit(i + 1))
        v = F.coalesce(F.nanvl(text.try_cast("double"), F.lit(0.0)), F.lit(0.0))
        return F.least(F.greatest(v, F.lit(0.0)), F.lit(float(top))).cast("int")

    ts = F.expr("try_make_timestamp_ntz(`Year`, `Month`, `Day`, _hh, _mi, 0)")
    out = df.withColumns({"_hh": piece(0, 23), "_mi": piece(1, 59)}).withColumn(S.TS, ts)
    return time_parts(out.filter(F.col(S.TS).isNotNull()).drop("_hh", "_mi"))


def time_parts(df: DataFrame) -> DataFrame:
    return df.withColumns({S.HOUR: F.hour(S.TS).cast("bigint"), S.WEEKDAY: F.weekday(S.TS).cast("bigint")})


def fill_categories(df: DataFrame) -> DataFrame:
    """Null categories become 'UNKNOWN' text, null Zip becomes -1."""
    out = df.withColumns({c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("UNKNOWN"))
                          for c in S.CATEGORICALS if c in df.columns})
    if "Zip" in df.columns:
        out = out.withColumn("Zip", F.coalesce("Zip", F.lit(-1.0)))
    return out


def amount_median(df: DataFrame, col: str = S.AMOUNT):
    return exact_quantiles(df, col, [0.5])[0]


def impute_amount(df: DataFrame, median, col: str = S.AMOUNT) -> DataFrame:
    return df if median is None else df.withColumn(col, F.coalesce(F.col(col), F.lit(float(median))))


def drop_duplicates(df: DataFrame, subset=None, row_id: str = S.ROW_ID) -> DataFrame:
    """Keep the lowest row_id of identical rows (or of rows equal on subset)."""
    if subset:
        return top_per_group(df, subset, [F.col(row_id)], 1)
    cols = [c for c in df.columns if c != row_id]
    kept = df.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.min(row_id).alias(row_id))
    return kept.select(*[F.col(f"`{c}`") for c in df.columns])


def clip_bounds(df: DataFrame, low=0.001, high=0.999, col: str = S.AMOUNT):
    lo, hi = exact_quantiles(df, col, [low, high])
    return (None, None) if lo is None else (round(lo, 6), round(hi, 6))


def clip_amount(df: DataFrame, lo, hi, col: str = S.AMOUNT) -> DataFrame:
    if lo is None:
        return df
    v = F.col(col)
    return df.withColumn(col, F.when(v < lo, lo).when(v > hi, hi).otherwise(v))


def extract_label(df: DataFrame, positive: str = "Yes") -> DataFrame:
    """Replaces the label text by is_fraud 0/1 on the same row; 0 if there is none."""
    if S.LABEL_RAW not in df.columns:
        return df.withColumn(S.LABEL, F.lit(0))
    flag = F.coalesce((F.col(f"`{S.LABEL_RAW}`") == positive).cast("int"), F.lit(0))
    return df.withColumn(S.LABEL, flag).drop(S.LABEL_RAW)


def min_history(df: DataFrame, n: int = 5, user: str = S.USER) -> DataFrame:
    """Rows of users that have at least n rows."""
    users = df.groupBy(user).agg(F.count("*").alias("_n")).withColumn("_w", F.col("_n"))
    keys = df.agg(F.approx_count_distinct(user)).first()[0]
    joined = lookup_join(df, users, user, keys, "_w", S.ROW_ID)
    return joined.filter(F.col("_n") >= n).select(*[F.col(f"`{c}`") for c in df.columns])


def clean(raw: DataFrame, stats: CleanStats | None = None, strict: bool = True,
          quantiles=(0.001, 0.999), subset=None):
    """All steps in order. Returns (rows, stats).

    Without stats the median and clip bounds come from this batch; with stats
    the given ones are used and nothing runs until the result is used."""
    rows = parse_datetime(parse_amount(raw, strict))
    filled = fill_categories(rows)
    median = stats.amount_median if stats else amount_median(rows)
    unique = drop_duplicates(impute_amount(filled, median), subset)
    if stats:
        lo, hi = stats.clip_low, stats.clip_high
    else:
        unique = materialize(unique, "clean")  # read twice: quantiles, then rows
        lo, hi = clip_bounds(unique, *quantiles)
    out = extract_label(clip_amount(unique, lo, hi))
    return out, CleanStats(median, lo, hi)
