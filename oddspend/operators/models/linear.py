"""Models that need only means and covariances: PCA reconstruction, Mahalanobis
distance, and the robust envelope (minimum covariance determinant)."""

import numpy as np
from pyspark.sql import functions as F

from oddspend.functions.quantiles import exact_quantiles
from oddspend.operators.models.base import OffsetModel, OutlierModel, matrix_udf, moments


class PcaReconstruction(OutlierModel):
    """Mean squared distance to the span of the leading components: the linear
    special case of an autoencoder with the same bottleneck."""
    name = "pca_reconstruction"

    def __init__(self, components=8, contamination=0.02, seed=42):
        super().__init__(contamination, seed)
        self.components, self.mean, self.basis = components, None, None

    def _fit(self, df):
        _, self.mean, cov = moments(df)
        values, vectors = np.linalg.eigh(cov)
        self.basis = vectors[:, np.argsort(values)[::-1][:min(self.components, len(values))]]

    def raw_score(self, df):
        mean, basis = self.mean, self.basis

        def score(x):
            c = x - mean
            return ((c - (c @ basis) @ basis.T) ** 2).mean(axis=1)

        return df.withColumn("_raw", matrix_udf(score)("features"))

    def _arrays(self):
        return {"mean": self.mean, "basis": self.basis}

    def _set_arrays(self, a):
        self.mean, self.basis = a["mean"], a["basis"]

    def _settings(self):
        return {"components": self.components}


def _distance_udf(center, precision):
    def score(x):
        c = x - center
        return ((c @ precision) * c).sum(axis=1)
    return matrix_udf(score)


class Mahalanobis(OffsetModel):
    """Squared distance from the plain mean under the plain covariance."""
    name = "mahalanobis"

    def __init__(self, contamination=0.02, seed=42):
        super().__init__(contamination, seed)
        self.center = self.precision = None

    def _fit(self, df):
        _, self.center, cov = moments(df)
        self.precision = np.linalg.pinv(cov, hermitian=True)

    def raw_score(self, df):
        return df.withColumn("_raw", _distance_udf(self.center, self.precision)("features"))

    def _arrays(self):
        return {"center": self.center, "precision": self.precision}

    def _set_arrays(self, a):
        self.center, self.precision = a["center"], a["precision"]


def chi2_quantile(p, d):
    """Wilson-Hilferty approximation of the chi-square quantile."""
    from statistics import NormalDist

    z = NormalDist().inv_cdf(p)
    return d * (1 - 2 / (9 * d) + z * (2 / (9 * d)) ** 0.5) ** 3


class EllipticEnvelope(Mahalanobis):
    """Robust version: concentration steps keep the support_fraction of rows nearest
    to the centre until the determinant settles, then rows within the 97.5 %
    chi-square radius give the final centre and covariance. The start is the
    coordinate-wise median and quartile range."""
    name = "elliptic_envelope"

    def __init__(self, support_fraction=0.8, contamination=0.02, seed=42, max_steps=10):
        super().__init__(contamination, seed)
        self.support_fraction, self.max_steps = support_fraction, max_steps

    def _fit(self, df):
        d = self.n_features
        cols = df.select(*[F.get("features", F.lit(i)).alias(f"x{i}") for i in range(d)])
        from oddspend.functions.quantiles import column_quantiles

        q = list(column_quantiles(cols, cols.columns, [0.25, 0.5, 0.75]).values())
        center = np.array([v[1] for v in q])
        spread = np.array([v[2] - v[0] for v in q])
        spread[spread <= 0] = 1.0
        precision = np.diag(1.0 / spread ** 2)
        last = np.inf
        for _ in range(self.max_steps):
            dist = df.select("features", _distance_udf(center, precision)("features").alias("_d"))
            cut = exact_quantiles(dist, "_d", [self.support_fraction])[0]
            _, center, cov = moments(dist.filter(F.col("_d") <= cut))
            precision = np.linalg.pinv(cov, hermitian=True)
            values = np.linalg.eigvalsh(cov)
            det = float(np.log(values[values > 1e-12]).sum())
            if last - det < 1e-6:
                break
            last = det
        dist = df.select("features", _distance_udf(center, precision)("features").alias("_d"))
        scale = exact_quantiles(dist, "_d", [0.5])[0] / chi2_quantile(0.5, d)
        limit = chi2_quantile(0.975, d) * (scale if scale > 0 else 1.0)
        _, self.center, cov = moments(dist.filter(F.col("_d") <= limit))
        self.precision = np.linalg.pinv(cov, hermitian=True)

    def _settings(self):
        return {"support_fraction": self.support_fraction, "max_steps": self.max_steps}
