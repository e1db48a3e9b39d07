"""Approximate k-nearest-neighbour graph, for tables on which the exact join of knn.py compares
nearly all blocks (many dimensions).

A forest of random projections gives the start: every tree cuts the rows into blocks of bounded
size, in which all distances are compared. Rounds of NN-descent (Dong et al. 2011) then let the
neighbours of a row, and those that it is a neighbour of, meet each other. A round that changes
less than `settled` of the edges is the last. Work and shuffle grow with rows x k: the meetings
of a block of the first tree are one group, to which a vector goes once for all its meetings there;
vectors that single precision holds exactly travel in it. Distances are in double precision.

Null ids take no part; ids must be unique; ties in distance go to the lower id. Exact copies fall
into blocks by the hash of their id, so that no block grows with them.
"""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window

from oddspend.functions.sampling import take_fixed, top_per_group
from oddspend.operators.knn import _SHAPE, _distances, knn
from oddspend.operators.models.base import to_matrix
from oddspend.session import materialize

FIT = 4096  # rows on which the hyperplanes of the trees are drawn
BLOCK = 512  # rows of a block, about


class Graph(NamedTuple):
    edges: DataFrame  # id, nbr, rank, dist
    rounds: int
    changed: float  # share of edges that the last round changed


def _grow(x: np.ndarray, depth: int, rng) -> list:
    """Hyperplanes of a tree of `depth` levels in heap order: each halves its part of the sample,
    across the line through two of its rows."""
    planes, parts = [], [x]
    for _ in range(2 ** depth - 1):
        part = parts.pop(0)
        a, b = part[rng.integers(len(part), size=2)] if len(part) else (np.zeros(x.shape[1]),) * 2
        way = a - b if np.any(a != b) else rng.normal(size=x.shape[1])
        at = part @ way
        cut = float(np.median(at)) if len(part) else 0.0
        planes.append((way, cut))
        parts += [part[at <= cut], part[at > cut]]
    return planes


def _matrix(col) -> np.ndarray:
    return to_matrix(col).astype(float, copy=False)


def _single(rows: DataFrame) -> DataFrame:
    """Rows with `features` in single precision if that loses no digit of any of them."""
    lossy = F.exists("features", lambda v: v.cast("float").cast("double") != v.cast("double"))
    return rows if not rows.filter(lossy).isEmpty() else rows.withColumn("features", F.col("features").cast("array<float>"))


def _leaves(forest: list, depth: int):
    """(tree, leaf, place along a direction of the tree) of a row, for every tree."""
    ways = [np.array([w for w, _ in planes]) for planes, _ in forest]
    cuts = [np.array([c for _, c in planes]) for planes, _ in forest]

    @F.arrow_udf("array<struct<tree:int,leaf:int,place:double>>")
    def assign(col: pa.Array) -> pa.Array:
        x = _matrix(col) if len(col) else np.zeros((0, 1))
        trees, leaf, place = [], [], []
        for t, (_, along) in enumerate(forest):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(depth if len(x) else 0):
                at = 2 * at + 1 + (np.einsum("ij,ij->i", x, ways[t][at]) > cuts[t][at])
            trees.append(np.full(len(x), t, dtype=np.int32))
            leaf.append(at.astype(np.int32))
            place.append(x @ along if len(x) else np.zeros(0))
        flat = [np.stack(v, axis=1).ravel() if len(x) else v[0] for v in (trees, leaf, place)]
        items = pa.StructArray.from_arrays([pa.array(v) for v in flat], ["tree", "leaf", "place"])
        return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(forest), pa.int32()), items)
    return assign


def _blocks(rows: DataFrame, n: int, trees: int, block: int, seed: int) -> DataFrame:
    """Rows once a tree with their block: leaves of the tree, cut along a direction where a leaf
    holds more than a block, and by hash where even equal places do."""
    rng = np.random.default_rng(seed)
    sample = np.array([r.features for r in take_fixed(rows, min(n, FIT), "id", seed, n).orderBy("id").select("features").collect()])
    depth = int(max(0, min(np.ceil(np.log2(max(1.0, n / block))), np.log2(FIT / 4))))
    forest = [(_grow(sample, depth, rng), rng.normal(size=sample.shape[1])) for _ in range(trees)]
    placed = rows.select("id", "features", F.explode(_leaves(forest, depth)("features")).alias("p")).select("id", "features", "p.*")
    placed = materialize(placed, "graph_places")
    sizes = placed.groupBy("tree", "leaf").agg(F.count("*").alias("n"), F.percentile_approx("place", [k / 64 for k in range(1, 64)], 1000).alias("q"))
    # every leaf in as many of the 64 stretches as it fills blocks
    keep = F.ceil(F.col("n") / block)
    ends = F.when(keep <= 1, F.array().cast("array<double>")).otherwise(
        F.filter("q", lambda _, i: (F.floor((i + 1) * F.least(keep, F.lit(64)) / 64) > F.floor(i * F.least(keep, F.lit(64)) / 64))))
    cut = placed.join(F.broadcast(sizes.select("tree", "leaf", ends.alias("ends"))), ["tree", "leaf"])  # at most trees x FIT / 4 rows of 63 numbers
    cut = cut.withColumn("stretch", F.size(F.filter("ends", lambda e: e < F.col("place")))).drop("ends", "place")
    counts = cut.groupBy("tree", "leaf", "stretch").agg(F.ceil(F.count("*") / (2 * block)).alias("salts"))
    cut = cut.join(counts, ["tree", "leaf", "stretch"])
    return cut.withColumn("salt", F.pmod(F.xxhash64("id", "tree"), F.col("salts")))


def _best(dist, ids, k):
    """Rows and columns of the k smallest entries of each row, the diagonal left out."""
    d = dist.copy()
    np.fill_diagonal(d, np.inf)
    k = min(k, len(ids) - 1)
    if k < 1:
        return np.zeros(0, dtype=int), np.zeros(0, dtype=int)
    order = np.argpartition(d, k - 1, axis=1)[:, :k]
    return np.repeat(np.arange(len(ids)), k), order.ravel()


def _compare_block(k):
    def run(rows: pa.Table) -> pa.Table:
        ids, x = rows["id"].to_numpy(), _matrix(rows["features"])
        dist = _distances(x, x)
        i, j = _best(dist, ids, k)
        return pa.table([ids[i], ids[j], dist[i, j]], schema=_SHAPE)
    return run


def _meet(k):
    """Members of each meeting of a group are compared; of what is no farther than a member's k-th
    neighbour, its k nearest go out, once a group."""
    def run(rows: pa.Table) -> pa.Table:
        hosts = rows["hosts"].combine_chunks()
        host, at = hosts.flatten().to_numpy(), np.repeat(np.arange(len(rows)), hosts.value_lengths().to_numpy())
        ids, limit, x = rows["id"].to_numpy(), rows["kdist"].to_numpy(), _matrix(rows["features"])
        order = np.lexsort((ids[at], host))
        host, at = host[order], at[order]
        out = []
        for part in np.split(at, np.flatnonzero(np.diff(host)) + 1):
            part = part[np.r_[True, np.diff(ids[part]) != 0]]  # neighbours in both directions
            dist = _distances(x[part], x[part])
            i, j = _best(dist, part, k)
            near = dist[i, j] <= limit[part[i]]
            i, j = i[near], j[near]
            out.append((ids[part[i]], ids[part[j]], dist[i, j]))
        a, b, d = (np.concatenate(v) for v in zip(*out))
        order = np.lexsort((b, a))
        a, b, d = a[order], b[order], d[order]
        once = np.r_[True, (np.diff(a) != 0) | (np.diff(b) != 0)] if len(a) else order
        a, b, d = a[once], b[once], d[once]
        order = np.lexsort((b, d, a))
        a, b, d = a[order], b[order], d[order]
        starts = np.flatnonzero(np.r_[True, np.diff(a) != 0]) if len(a) else order
        place = np.arange(len(a)) - np.repeat(starts, np.diff(np.r_[starts, len(a)]))
        return pa.table([a[place < k], b[place < k], d[place < k]], schema=_SHAPE)
    return run


def _top(found: DataFrame, k: int) -> DataFrame:
    """The k nearest of each id among (id, nbr, dist, new); `gain` marks new ones nearer than the
    k-th that is not new. Rows move once, by id."""
    once = found.repartition("id").groupBy("id", "nbr").agg(F.min("dist").alias("dist"), F.min("new").alias("new"))
    own = Window.partitionBy("id")
    old = F.when(~F.col("new"), F.col("dist"))
    kdist = F.when(F.count(old).over(own) >= k, F.max(old).over(own)).otherwise(float("inf"))
    ranked = top_per_group(once.withColumn("gain", F.col("new") & (F.col("dist") < kdist)), ["id"], [F.col("dist"), F.col("nbr")], k)
    return ranked.select("id", "nbr", "dist", "gain")


def neighbour_graph(rows: DataFrame, k: int, row_id: str = "row_id", trees: int = 6, max_rounds: int = 6,
                    settled: float = 0.002, block: int = BLOCK, seed: int = 42) -> Graph:
    """k near neighbours of every row by Euclidean distance. Meetings hold at most k neighbours in
    each direction; of more rows that point at one, those nearest to it take part."""
    rows = materialize(rows.select(F.col(row_id).cast("long").alias("id"), "features").filter("id IS NOT NULL"), "graph_rows", parallel=True)
    n = rows.count()
    if n == 0:
        return Graph(rows.sparkSession.createDataFrame([], "id long, nbr long, rank long, dist double"), 0, 0.0)
    rows = _single(rows)
    block = max(block, 4 * k)
    key = ["tree", "leaf", "stretch", "salt"]
    blocks = _blocks(rows, n, trees, block, seed)
    homes = materialize(blocks.filter("tree = 0").select(F.col("id").alias("host"), F.xxhash64("leaf", "stretch", "salt").alias("part")), "graph_homes")
    start = blocks.groupBy(*key).applyInArrow(_compare_block(k), "id long, nbr long, dist double")
    edges = materialize(_top(start.withColumn("new", F.lit(True)), k), "graph_edges")
    rounds, changed = 0, 1.0
    while rounds < max_rounds and changed > settled:
        back = top_per_group(edges.select(F.col("nbr").alias("host"), F.col("id"), "dist"), ["host"], [F.col("dist"), F.col("id")], k)
        members = edges.select(F.col("id").alias("host"), F.col("nbr").alias("id")).union(back.select("host", "id"))
        members = members.join(homes, "host").union(homes.select("host", F.col("host").alias("id"), "part"))
        members = members.groupBy("part", "id").agg(F.collect_list("host").alias("hosts"))  # at most a block of them, twice
        own = rows.join(edges.groupBy("id").agg(F.when(F.count("*") >= k, F.max("dist")).otherwise(float("inf")).alias("kdist")), "id", "left")
        own = own.withColumn("kdist", F.coalesce("kdist", F.lit(float("inf"))))
        found = members.join(own, "id").groupBy("part").applyInArrow(_meet(k), "id long, nbr long, dist double")
        found = edges.select("id", "nbr", "dist").withColumn("new", F.lit(False)).union(found.withColumn("new", F.lit(True)))
        edges = materialize(_top(found, k), "graph_edges")
        rounds, changed = rounds + 1, edges.filter("gain").count() / max(1, n * min(k, n - 1))  # equals that change places are no gain
    place = F.row_number().over(Window.partitionBy("id").orderBy("dist", "nbr")).cast("long")
    return Graph(edges.withColumn("rank", place).select("id", "nbr", "rank", "dist"), rounds, changed)


def measured_recall(edges: DataFrame, rows: DataFrame, k: int, row_id: str = "row_id", queries: int = 500, seed: int = 3) -> float:
    """Share of the true k neighbours of `queries` sampled rows that the graph holds, by the exact
    join. A neighbour as near as the true k-th counts, since ties are arbitrary."""
    rows = materialize(rows.select(F.col(row_id).cast("long").alias("id"), "features"), "recall_rows")
    asked = materialize(take_fixed(rows, queries, "id", seed), "recall_queries")
    true = knn(asked, rows, k, row_id="id").groupBy("id").agg(F.max("dist").alias("far"), F.count("*").alias("n"))
    held = edges.join(true, "id").filter(F.col("dist") <= F.col("far") * (1 + 1e-9)).groupBy("id").count()
    row = true.join(held, "id", "left").agg(F.sum(F.coalesce("count", F.lit(0))) / F.sum("n")).first()
    return float(row[0] if row[0] is not None else 1.0)
