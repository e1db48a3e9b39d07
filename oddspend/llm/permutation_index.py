"""Nearest neighbours by a permutation index.

Vectors are represented by the order of their nearest pivots. Pivots are a bounded sample of
the table (PIVOTS vectors, by smallest hash, no two alike). A vector is posted in the
inverted files of its POST nearest pivots; a query reads the files of its PROBE nearest
pivots. Within a file, vectors are ranked by the footrule distance of their permutations to
the query's (sum of differences of each pivot's place), and the nearest SHARE of the file,
LEAST at least, is ranked again by cosine on the original vectors, in double precision.

A vector that a query meets in several files is looked at in the first of them only. Files
are cut into blocks of about BLOCK vectors, the queries of a file into blocks of QUERIES, and
each pair of blocks is one group: a pivot that a third of all vectors are nearest to is many
groups. A group returns k rows a query; no pair of vectors is ever a row. All vectors are
indexed; nothing is capped.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows
without an id or with another dimension than most of the sample. Components may be as large
or small as doubles are. Rows with one id count once,
with their best score; a query never finds its own id. Equal scores go by id. Extra columns
are ignored; an empty table gives an empty result.
"""

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from oddspend.session import materialize

PIVOTS, POST, PROBE = 128, 4, 32
SHARE, LEAST = 0.25, 64
BLOCK, QUERIES = 4096, 1024


def valid(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), v.alias("v"))
    return rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1. They are scaled by a power of two first, which changes no digit and
    keeps the squares of very large or small components finite."""
    y = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    return y / np.linalg.norm(y, axis=1, keepdims=True)


def choose_pivots(rows: DataFrame, n: int = PIVOTS) -> np.ndarray | None:
    """At most n unit vectors of the commonest dimension (the smallest of equally common ones)
    among the 4 n rows of smallest hash."""
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(4 * n).collect()
    if not sample:
        return None
    counts = Counter(len(r["v"]) for r in sample)
    width = min(counts, key=lambda w: (-counts[w], w))
    found = np.array(list(dict.fromkeys(tuple(r["v"]) for r in sample if len(r["v"]) == width)))[:n]
    return unit(found)


def permuted(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """id, v (bytes of doubles), order (bytes: pivots, nearest first, two bytes each)."""
    width = pivots.shape[1]

    def run(batches):
        for batch in batches:
            values = batch.column(1)
            x = values.flatten().to_numpy(zero_copy_only=False).reshape(-1, width) if len(values) else np.zeros((0, width))
            order = np.argsort(-unit(x) @ pivots.T, axis=1, kind="stable").astype("<u2")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r.tobytes() for r in x], pa.binary()), pa.array([r.tobytes() for r in order], pa.binary()), pa.array(order[:, : max(POST, PROBE)].astype("i4").tolist(), pa.list_(pa.int32()))],
                names=["id", "v", "order", "nearest"],
            )

    return rows.filter(F.size("v") == width).mapInArrow(run, "id bigint, v binary, order binary, nearest array<int>")


def places(orders: np.ndarray) -> np.ndarray:
    """Place of each pivot in each order."""
    out = np.empty_like(orders, dtype=np.int16)
    np.put_along_axis(out, orders.astype(np.int64), np.broadcast_to(np.arange(orders.shape[1], dtype=np.int16), orders.shape), 1)
    return out


def search_block(key: tuple, posted: pd.DataFrame, queries: pd.DataFrame, k: int, share: float, least: int) -> pd.DataFrame:
    """query_id, vec_id, score: the k best of a block for each query of a block."""
    none = pd.DataFrame({"query_id": np.zeros(0, "i8"), "vec_id": np.zeros(0, "i8"), "score": np.zeros(0)})
    if not len(posted) or not len(queries):
        return none
    posted = posted.sort_values("id", ignore_index=True)
    ids, x = posted["id"].to_numpy(), np.stack([np.frombuffer(b) for b in posted["v"]])
    orders = np.stack([np.frombuffer(b, "<u2") for b in posted["order"]])
    rank, where = posted["rank"].to_numpy(), places(orders)
    x = unit(x)
    out = []
    for q in queries.itertuples():
        order = np.frombuffer(q.q_order, "<u2")
        probed = np.zeros(len(order), bool)
        probed[order[:PROBE]] = True
        met = ids == q.q_id
        for e in range(POST - 1):  # met already in a file of a nearer pivot of the vector
            met |= (rank > e) & probed[orders[:, min(e, orders.shape[1] - 1)]]
        rows = np.flatnonzero(~met)
        if not len(rows):
            continue
        foot = np.abs(where[rows] - places(order[None])).sum(axis=1, dtype=np.int32)
        rows = rows[np.argsort(foot, kind="stable")[: max(least, int(np.ceil(share * len(rows))))]]
        score = (x[rows] * unit(np.frombuffer(q.q_v)[None])).sum(axis=1)
        best = np.lexsort((ids[rows], -score))[:k]
        out.append(pd.DataFrame({"query_id": q.q_id, "vec_id": ids[rows[best]], "score": score[best]}))
    return pd.concat(out, ignore_index=True) if out else none


def search(vectors: DataFrame, queries, k: int = 5, key: str = "vec_id", vector: str = "embedding", share: float = SHARE, least: int = LEAST) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found for each row for which the
    condition `queries` (on column id) holds."""
    spark, rows = vectors.sparkSession, valid(vectors, key, vector)
    schema = "query_id bigint, vec_id bigint, score double"
    pivots = choose_pivots(rows)
    if pivots is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    index = materialize(permuted(rows, pivots), "permutations")
    posted = index.select("id", "v", "order", F.posexplode(F.slice("nearest", 1, POST)).alias("rank", "pivot"))
    asked = index.filter(queries).select(F.col("id").alias("q_id"), F.col("v").alias("q_v"), F.col("order").alias("q_order"), F.explode(F.slice("nearest", 1, PROBE)).alias("q_pivot"))
    # one row for each pivot: blocks of its file and of its queries
    sizes = posted.groupBy("pivot").agg(F.count(F.lit(1)).alias("n")).join(asked.groupBy(F.col("q_pivot").alias("pivot")).agg(F.count(F.lit(1)).alias("m")), "pivot")
    sizes = [(r["pivot"], -(-r["n"] // BLOCK), -(-r["m"] // QUERIES)) for r in sizes.collect()]
    sizes = F.broadcast(spark.createDataFrame(sizes, "pivot int, blocks int, parts int"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block")
    part = F.pmod(F.xxhash64("q_id", F.lit(1)), F.col("parts")).cast("int").alias("part")
    posted = posted.join(sizes, "pivot").select("id", "v", "order", "rank", "pivot", block, every("parts").alias("part"))
    asked = asked.withColumnRenamed("q_pivot", "pivot").join(sizes, "pivot").select("q_id", "q_v", "q_order", "pivot", every("blocks").alias("block"), part)
    where = ["pivot", "block", "part"]
    found = posted.groupBy(*where).cogroup(asked.groupBy(*where)).applyInPandas(lambda key, a, b: search_block(key, a, b, k, share, least), schema)
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
