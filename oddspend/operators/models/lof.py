"""Local outlier factor (Breunig et al. 2000): density of a row against the density
of its neighbours. Neighbour edges come from the kNN join, the rest is joins and
aggregations over them."""

from pyspark.sql import DataFrame, functions as F

from oddspend.functions.lookup import lookup_join
from oddspend.operators.knn import knn
from oddspend.operators.models.base import OffsetModel
from oddspend.operators.neighbour_graph import neighbour_graph
from oddspend.session import materialize

_TINY = 1e-10  # fixed value: keeps the density of identical rows finite


def _with_stats(edges: DataFrame, stats: DataFrame, n: int) -> DataFrame:
    """Neighbour columns joined to the edges; a neighbour of very many rows is a hot key."""
    used = edges.groupBy("nbr").agg(F.count("*").alias("_w"))
    return lookup_join(edges, stats.join(used, "nbr"), "nbr", n, "_w", "id")


def reach_density(edges: DataFrame, kdist: DataFrame, n: int) -> DataFrame:
    """(id, lrd) from edges (id, nbr, dist) and the neighbours' k-distance."""
    e = _with_stats(edges, kdist.select(F.col("id").alias("nbr"), "kdist"), n)
    return e.groupBy("id").agg((1.0 / (F.avg(F.greatest("dist", "kdist")) + F.lit(_TINY))).alias("lrd"))


def outlier_factor(edges: DataFrame, own: DataFrame, reference: DataFrame, n: int) -> DataFrame:
    """(id, lof) = mean density of the neighbours / own density."""
    e = _with_stats(edges, reference.select(F.col("id").alias("nbr"), F.col("lrd").alias("_nlrd")), n)
    return e.groupBy("id").agg(F.avg("_nlrd").alias("_m")).join(own.select("id", "lrd"), "id").select(
        "id", (F.col("_m") / F.col("lrd")).alias("lof"))


class LocalOutlierFactor(OffsetModel):
    """All training rows are the reference. Training rows do not count themselves
    as neighbours; include_self=True does count them. neighbours="graph" takes the training
    rows' neighbours from the approximate graph, for tables too large for the exact join;
    rows that come later meet the reference by the exact join."""
    name = "local_outlier_factor"

    def __init__(self, n_neighbors=35, include_self=False, block_rows=None, contamination=0.02, seed=42, neighbours="exact"):
        super().__init__(contamination, seed)
        if neighbours not in ("exact", "graph"):
            raise ValueError(f"neighbours must be exact or graph, not {neighbours}")
        self.neighbours = neighbours
        self.n_neighbors, self.include_self, self.block_rows = n_neighbors, include_self, block_rows
        self.reference, self._edges, self._n, self._k = None, None, 0, n_neighbors

    def _fit(self, df):
        rows = materialize(df.select("row_id", "features"), "lof_rows")
        self._n = rows.count()
        self._k = min(self.n_neighbors, max(1, self._n - 1))
        if self.neighbours == "graph":
            found = neighbour_graph(rows, self._k, seed=self.seed).edges
        else:
            found = knn(rows, rows, self._k, block_rows=self.block_rows)
        edges = materialize(found, "lof_edges")
        kdist = edges.groupBy("id").agg(F.max("dist").alias("kdist"))
        lrd = reach_density(edges, kdist, self._n)
        self.reference = materialize(
            rows.withColumnRenamed("row_id", "id").join(kdist, "id").join(lrd, "id"), "lof_reference")
        self._edges = edges

    def _training_score(self, df):
        if self.include_self:
            return self.raw_score(df)
        own = self.reference
        return outlier_factor(self._edges, own, own, self._n).withColumnRenamed("lof", "_raw")

    def raw_score(self, df):
        ref = self.reference.select(F.col("id").alias("row_id"), "features")
        edges = materialize(knn(df.select("row_id", "features"), ref, self._k, exclude_self=not self.include_self,
                                block_rows=self.block_rows), "lof_query_edges")
        own = reach_density(edges, self.reference, self._n)
        lof = outlier_factor(edges, own, self.reference, self._n).select(F.col("id").alias("row_id"), F.col("lof").alias("_raw"))
        return df.join(lof, "row_id")

    def _settings(self):
        return {"n_neighbors": self.n_neighbors, "include_self": self.include_self, "block_rows": self.block_rows,
                "neighbours": self.neighbours}

    def save(self, spark, path):
        super().save(spark, path)
        self.reference.write.mode("overwrite").parquet(f"{path}/lof_reference")

    @classmethod
    def load(cls, spark, path):
        model = super().load(spark, path)
        model.reference = spark.read.parquet(f"{path}/lof_reference")
        model._n = model.reference.count()
        model._k = min(model.n_neighbors, max(1, model._n - 1))
        return model
