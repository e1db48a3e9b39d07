"""Data-quality profile of a raw table, one aggregation each."""

from pyspark.sql import DataFrame, functions as F

from oddspend import schema as S
from oddspend.functions.quantiles import column_quantiles
from oddspend.operators.clean import currency


def _q(c):
    return F.col(f"`{c}`")


def missing_columns(df: DataFrame, required=None):
    return sorted(set(required or S.RAW_COLUMNS) - set(df.columns))


def validate_schema(df: DataFrame, required=None, raise_on_error: bool = True):
    missing = missing_columns(df, required)
    if missing and raise_on_error:
        raise S.SchemaValidationError(f"missing columns: {missing}")
    return missing


def counts(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_cols"))


def missing(df: DataFrame) -> DataFrame:
    """Columns that have nulls: (column, missing, pct)."""
    one = df.agg(F.count("*").alias("_n"), *[F.sum(_q(c).isNull().cast("bigint")).alias(c) for c in df.columns])
    tidy = one.select("_n", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), _q(c).alias("missing")) for c in df.columns])).alias("m"))
    return tidy.select("m.column", "m.missing", F.round(100.0 * F.col("m.missing") / F.col("_n"), 3).alias("pct")
                       ).filter("missing > 0")


def duplicates(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each identical row."""
    return df.groupBy(*[_q(c) for c in df.columns]).agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicate_rows"))


def cardinality(df: DataFrame, columns=None, approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column: (column, n_distinct)."""
    cols = [c for c in (columns or [S.MERCHANT, *S.CATEGORICALS, S.USER, S.CARD]) if c in df.columns]
    if approximate:
        one = df.agg(*[F.approx_count_distinct(_q(c)).alias(c) for c in cols])
        return one.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), _q(c).alias("n_distinct")) for c in cols])).alias("m")).select("m.*")
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), _q(c).cast("string").alias("value")) for c in cols])).alias("p")).select("p.*")
    seen = pairs.groupBy("column", "value").agg(F.lit(1).alias("_one"))
    return seen.groupBy("column").agg(F.count("value").alias("n_distinct"))


def amounts(df: DataFrame) -> DataFrame:
    v = currency(F.col(S.AMOUNT))
    return df.agg(F.coalesce(F.sum((v < 0).cast("bigint")), F.lit(0)).alias("n_negative"),
                  F.coalesce(F.sum(v.isNull().cast("bigint")), F.lit(0)).alias("n_non_numeric"))


def labels(df: DataFrame, valid=("Yes", "No")) -> DataFrame:
    c = _q(S.LABEL_RAW)
    return df.agg(F.coalesce(F.sum((~c.isin(*valid) & c.isNotNull()).cast("bigint")), F.lit(0)).alias("n_unexpected_labels"))


def describe_numeric(df: DataFrame, columns) -> DataFrame:
    """count, mean, std, min, quartiles, max per numeric column.

    The quartiles are exact selections, the rest is one aggregation."""
    one = df.agg(*[f.alias(f"{i}_{n}") for i, c in enumerate(columns) for n, f in (
        ("count", F.count(_q(c))), ("mean", F.avg(_q(c).cast("double"))), ("std", F.stddev_samp(_q(c).cast("double"))),
        ("min", F.min(_q(c)).cast("double")), ("max", F.max(_q(c)).cast("double")))])
    quart = list(column_quantiles(df, columns, [0.25, 0.5, 0.75]).values())

    def lit(v):
        return F.lit(v).cast("double")

    rows = F.explode(F.array(*[F.struct(
        F.lit(c).alias("column"), F.col(f"{i}_count").alias("count"), F.round(f"{i}_mean", 7).alias("mean"),
        F.round(f"{i}_std", 7).alias("std"), F.col(f"{i}_min").alias("min"),
        F.round(lit(quart[i][0]), 6).alias("p25"), F.round(lit(quart[i][1]), 6).alias("p50"),
        F.round(lit(quart[i][2]), 6).alias("p75"), F.col(f"{i}_max").alias("max"))
        for i, c in enumerate(columns)]))
    return one.select(rows.alias("r")).select("r.*")


def describe_text(df: DataFrame, columns) -> DataFrame:
    """count, unique, most frequent value and its count per text column (ties: lowest value)."""
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), _q(c).cast("string").alias("value")) for c in columns])).alias("p")).select("p.*")
    per = pairs.filter("value is not null").groupBy("column", "value").agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("neg"), F.col("value"))).alias("b")
    return per.groupBy("column").agg(F.sum("n").alias("count"), F.count("*").alias("unique"), best).select(
        "column", "count", "unique", F.col("b.value").alias("top"), (-F.col("b.neg")).alias("freq"))


def report(df: DataFrame) -> DataFrame:
    """The whole profile as tidy rows (metric, column, value). Everything countable
    row by row comes from one scan; repeats and cardinality are one shuffle each."""
    facts = {("n_rows", None): F.count("*"), ("n_cols", None): F.max(F.lit(len(df.columns)))}
    nulls = {c: F.sum(_q(c).isNull().cast("bigint")) for c in df.columns}
    facts |= {("missing", c): v for c, v in nulls.items()}
    facts |= {("missing_pct", c): F.round(100.0 * v / F.count("*"), 3) for c, v in nulls.items()}
    always = {("n_rows", None), ("n_cols", None)}
    if S.AMOUNT in df.columns:
        v = currency(F.col(S.AMOUNT))
        facts[("negative", S.AMOUNT)] = F.sum((v < 0).cast("bigint"))
        facts[("non_numeric", S.AMOUNT)] = F.sum(v.isNull().cast("bigint"))
        always |= {("negative", S.AMOUNT), ("non_numeric", S.AMOUNT)}
    if S.LABEL_RAW in df.columns:
        c = _q(S.LABEL_RAW)
        facts[("unexpected_labels", S.LABEL_RAW)] = F.sum((~c.isin("Yes", "No") & c.isNotNull()).cast("bigint"))
        always.add(("unexpected_labels", S.LABEL_RAW))
    one = df.agg(*[v.cast("double").alias(f"_{i}") for i, v in enumerate(facts.values())])
    rows = one.select(F.explode(F.array(*[F.struct(
        F.lit(m).alias("metric"), F.lit(c).cast("string").alias("column"),
        (F.coalesce(F.col(f"_{i}"), F.lit(0.0)) if (m, c) in always else F.col(f"_{i}")).alias("value"))
        for i, (m, c) in enumerate(facts)])).alias("r")).select("r.*")
    rows = rows.filter(~F.col("metric").isin("missing", "missing_pct") | (F.col("value") > 0))
    again = duplicates(df).select(F.lit("duplicate_rows").alias("metric"), F.lit(None).cast("string").alias("column"),
                                  F.col("n_duplicate_rows").cast("double").alias("value"))
    sizes = cardinality(df).select(F.lit("cardinality").alias("metric"), "column", F.col("n_distinct").cast("double").alias("value"))
    return rows.unionByName(again).unionByName(sizes)


def validate(df: DataFrame) -> DataFrame:
    """Schema gate, then the profile."""
    validate_schema(df)
    return report(df)
