"""Frequency encoding and scaling, fitted as small tables."""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from oddspend import schema as S
from oddspend.functions.lookup import lookup_join
from oddspend.functions.quantiles import column_quantiles
from oddspend.session import materialize


def frequency_table(df: DataFrame, columns) -> DataFrame:
    """(column, value, n, freq): share of the rows per value, one pass for all columns."""
    total = df.count()
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("null")).alias("value"))
        for c in columns])).alias("p")).select("p.*")
    return pairs.groupBy("column", "value").agg(F.count("*").alias("n")).withColumn(
        "freq", F.col("n") / F.lit(float(max(1, total))))


def fit_scaler(df: DataFrame, columns, kind: str = "standard"):
    """{column: (center, scale)} so that the scaled value is (x - center) / scale."""
    def safe(v):
        return 1.0 if v is None or v == 0 else float(v)

    if kind == "robust":
        q = column_quantiles(df, columns, [0.25, 0.5, 0.75])
        return {c: (q[c][1] or 0.0, safe((q[c][2] or 0.0) - (q[c][0] or 0.0))) for c in columns}
    pair = {"standard": (F.avg, F.stddev_pop), "minmax": (F.min, F.max)}[kind]
    row = df.agg(*[f(F.col(f"`{c}`").cast("double")).alias(f"_{i}_{j}")
                   for i, c in enumerate(columns) for j, f in enumerate(pair)]).first()
    out = {}
    for i, c in enumerate(columns):
        a, b = row[2 * i] or 0.0, row[2 * i + 1] or 0.0
        out[c] = (float(a), safe(b if kind == "standard" else b - a))
    return out


def scale(df: DataFrame, scaler) -> DataFrame:
    absent = [c for c in scaler if c not in df.columns]
    if absent:
        raise ValueError(f"columns the scaler needs are absent: {absent}")
    return df.withColumns({f"{c}_scaled": (F.col(f"`{c}`").cast("double") - F.lit(m)) / F.lit(s)
                           for c, (m, s) in scaler.items()})


@dataclass
class Encoder:
    """Fit on training rows, transform any rows; save/load as Parquet tables."""
    scaler_kind: str = "standard"
    categoricals: list = field(default_factory=lambda: [*S.CATEGORICALS, S.MERCHANT])
    freq: DataFrame | None = None
    sizes: dict = field(default_factory=dict)   # column -> (distinct values, lowest share)
    scaler: dict = field(default_factory=dict)

    def fit(self, df: DataFrame, numeric=None) -> "Encoder":
        cols = [c for c in self.categoricals if c in df.columns]
        self.freq = materialize(frequency_table(df, cols), "enc_freq")
        self._measure(cols)
        self.scaler = fit_scaler(df, list(numeric or S.NUMERIC_INPUTS), self.scaler_kind)
        return self

    def _measure(self, cols):
        got = {r["column"]: (r["k"], r["lowest"]) for r in self.freq.groupBy("column").agg(
            F.count("*").alias("k"), F.min("freq").alias("lowest")).collect()}
        self.sizes = {c: got.get(c, (0, 0.0)) for c in cols}

    def transform(self, df: DataFrame) -> DataFrame:
        if self.freq is None:
            raise RuntimeError("encoder used before fit")
        out = self.encode_frequencies(df)
        return scale(out, self.scaler)

    def encode_frequencies(self, df: DataFrame) -> DataFrame:
        """<c>_freq per category; values unseen in training get the lowest share."""
        out = df
        for c, (k, lowest) in self.sizes.items():
            if c not in df.columns:
                continue
            table = self.freq.filter(F.col("column") == c).select(F.col("value").alias("_value"), "n", "freq")
            keyed = out.withColumn("_value", F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("null")))
            out = lookup_join(keyed, table, "_value", k, "n", S.ROW_ID).drop("_value").withColumn(
                f"{c}_freq", F.coalesce("freq", F.lit(float(lowest)))).drop("freq")
        return out

    def feature_columns(self):
        return [f"{c}_freq" for c in self.sizes] + [f"{c}_scaled" for c in self.scaler]

    def matrix(self, df: DataFrame) -> DataFrame:
        """transform plus `features` ARRAY<DOUBLE> in feature_columns order."""
        if self.freq is None:
            raise RuntimeError("encoder used before fit")
        return self.assemble(self.encode_frequencies(df))

    def assemble(self, looked_up: DataFrame) -> DataFrame:
        """matrix of rows that encode_frequencies went over: no join, arithmetic inside the row."""
        return scale(looked_up, self.scaler).withColumn("features", F.array(*[F.col(f"`{c}`") for c in self.feature_columns()]))

    def save(self, path: str):
        spark = self.freq.sparkSession
        self.freq.write.mode("overwrite").parquet(f"{path}/enc_freq")
        rows = [(i, c, m, s, self.scaler_kind) for i, (c, (m, s)) in enumerate(self.scaler.items())]
        spark.createDataFrame(rows, "pos int, column string, center double, scale double, kind string").write.mode(
            "overwrite").parquet(f"{path}/enc_scale")
        names = [(i, c) for i, c in enumerate(self.sizes)]
        spark.createDataFrame(names, "pos int, column string").write.mode("overwrite").parquet(f"{path}/enc_columns")

    @classmethod
    def load(cls, spark, path: str) -> "Encoder":
        rows = spark.read.parquet(f"{path}/enc_scale").orderBy("pos").collect()
        cats = [r["column"] for r in spark.read.parquet(f"{path}/enc_columns").orderBy("pos").collect()]
        enc = cls(rows[0]["kind"] if rows else "standard", cats, spark.read.parquet(f"{path}/enc_freq"))
        enc.scaler = {r["column"]: (r["center"], r["scale"]) for r in rows}
        enc._measure(cats)
        return enc
