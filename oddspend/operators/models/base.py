"""Contract of every outlier model: higher score = more unusual.

Models read a DataFrame with `features` ARRAY<DOUBLE>. Fitting runs as Spark
aggregations or bounded per-group work; the fitted state is a few small arrays,
saved as Parquet tables.
"""

import json
import time

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from oddspend.functions.quantiles import exact_quantiles
from oddspend.session import materialize


def to_matrix(col: pa.Array) -> np.ndarray:
    """(rows, width) view of an Arrow list column."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def matrix_udf(fn, returns="double"):
    """Arrow UDF applying fn(matrix) -> vector (or matrix for array results)."""
    @F.arrow_udf(returns)
    def apply(col: pa.Array) -> pa.Array:
        if len(col) == 0:
            return pa.array([], pa.float64() if returns == "double" else pa.list_(pa.float64()))
        out = fn(to_matrix(col))
        if out.ndim == 1:
            return pa.array(out)
        ends = np.arange(0, out.size + 1, out.shape[1], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(out, dtype=float).ravel()))
    return apply


def sum_vectors(df: DataFrame, col: str) -> np.ndarray:
    """Element-wise sum of an array column, added up on the executors."""
    rows = df.select(F.posexplode(col).alias("pos", "v")).groupBy("pos").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(len(rows))
    for r in rows:
        out[r.pos] = r.v
    return out


def moments(df: DataFrame):
    """(n, mean vector, population covariance) of `features`; one row of partial
    sums per task, shifted by the first row for numerical safety."""
    head = df.select("features").first()
    if head is None:
        raise ValueError("no rows to fit on")
    shift = np.asarray(head.features, dtype=float)
    d = len(shift)

    def partial(batches):
        acc = np.zeros(1 + d + d * d)
        for b in batches:
            if b.num_rows:
                x = to_matrix(b.column(0)) - shift
                acc[0] += len(x)
                acc[1:1 + d] += x.sum(axis=0)
                acc[1 + d:] += (x.T @ x).ravel()
        yield pa.RecordBatch.from_pydict({"s": pa.array([acc], pa.list_(pa.float64()))})

    s = sum_vectors(df.select("features").mapInArrow(partial, "s array<double>"), "s")
    n = s[0]
    mu = s[1:1 + d] / n
    return int(n), mu + shift, s[1 + d:].reshape(d, d) / n - np.outer(mu, mu)


class OutlierModel:
    name = "model"

    def __init__(self, contamination: float = 0.02, seed: int = 42):
        self.contamination = contamination
        self.seed = seed
        self.threshold = None
        self.offset = 0.0
        self.n_features = None
        self.fit_seconds = None

    # subclasses: _fit(df) sets the state, raw_score(df) adds `_raw`
    def _fit(self, df):
        raise NotImplementedError

    def raw_score(self, df) -> DataFrame:
        raise NotImplementedError

    def fit(self, df: DataFrame) -> "OutlierModel":
        """Fit, then put the threshold at the (1 - contamination) quantile of the
        training scores."""
        start = time.perf_counter()
        head = df.select("features").first()
        if head is None:
            raise ValueError("no rows to fit on")
        self.n_features = len(head.features)
        self._fit(df)
        self.fit_seconds = round(time.perf_counter() - start, 4)
        cut = exact_quantiles(self._training_score(df), "_raw", [1 - self.contamination])[0]
        self._set_threshold(cut)
        return self

    def _training_score(self, df):
        return self.raw_score(df)

    def _set_threshold(self, cut):
        self.offset, self.threshold = 0.0, cut

    @property
    def is_fitted(self):
        return self.threshold is not None

    def _check(self):
        if not self.is_fitted:
            raise RuntimeError(f"{self.name} is not fitted")

    def score(self, df: DataFrame) -> DataFrame:
        self._check()
        return self.raw_score(df).withColumn("anomaly_score", F.col("_raw") - F.lit(float(self.offset))).drop("_raw")

    def predict(self, df: DataFrame) -> DataFrame:
        """score plus is_anomaly 0/1."""
        return self.flag(self.score(df))

    def flag(self, scored: DataFrame) -> DataFrame:
        self._check()
        return scored.withColumn("is_anomaly", (F.col("anomaly_score") >= F.lit(float(self.threshold))).cast("int"))

    def score_batch(self, df: DataFrame, keep_features: bool = True) -> DataFrame:
        """anomaly_score, anomaly_score_normalized (min-max of this batch) and is_anomaly.
        Rows are scored once, written with all their columns (without `features`, if the caller
        has no use for it), and the rest is derived from the table."""
        scored = self.score(df)
        return self.flag(normalize(materialize(scored if keep_features else scored.drop("features"), "scored")))

    def params(self):
        return {"name": self.name, "contamination": self.contamination, "seed": self.seed, "threshold": self.threshold,
                "n_features": self.n_features, "fit_seconds": self.fit_seconds}

    # persistence: arrays as rows, settings as one JSON row
    def _arrays(self) -> dict:
        return {}

    def _set_arrays(self, arrays):
        pass

    def _settings(self) -> dict:
        return {}

    def save(self, spark, path: str):
        self._check()
        rows = [(k, [int(s) for s in np.shape(v)], np.asarray(v, dtype=float).ravel().tolist()) for k, v in self._arrays().items()]
        spark.createDataFrame(rows, "name string, shape array<int>, values array<double>").write.mode("overwrite").parquet(f"{path}/arrays")
        meta = json.dumps({"params": self.params(), "offset": self.offset, "settings": self._settings()})
        spark.createDataFrame([(self.name, meta)], "model string, meta string").write.mode("overwrite").parquet(f"{path}/model_meta")

    @classmethod
    def load(cls, spark, path: str) -> "OutlierModel":
        meta = json.loads(spark.read.parquet(f"{path}/model_meta").first().meta)
        p = meta["params"]
        model = cls(contamination=p["contamination"], seed=p["seed"], **meta["settings"])
        model.threshold, model.offset = p["threshold"], meta["offset"]
        model.n_features, model.fit_seconds = p["n_features"], p["fit_seconds"]
        model._set_arrays({r.name: np.asarray(r["values"]).reshape(r.shape) for r in spark.read.parquet(f"{path}/arrays").collect()})
        return model


class OffsetModel(OutlierModel):
    """Scores are shifted so that the threshold is 0."""

    def _set_threshold(self, cut):
        self.offset, self.threshold = cut, 0.0


def normalize(scored: DataFrame) -> DataFrame:
    """Min-max of anomaly_score over the batch; all 0 when the range is below 1e-12."""
    lo, hi = scored.agg(F.min("anomaly_score"), F.max("anomaly_score")).first()
    if lo is None or hi - lo < 1e-12:
        v = F.lit(0.0)
    else:
        v = (F.col("anomaly_score") - F.lit(lo)) / F.lit(hi - lo)
    return scored.withColumn("anomaly_score_normalized", v)
