"""Isolation forest (Liu, Ting, Zhou 2008).

Every tree is drawn by hash. A tree on few rows grows in a group of its own. A tree on
more grows its upper levels over all tasks: a row lies in the table once, with the trees that
drew it. In every level it walks the splits there are, a task adds up the range of every input
in every open node, and a node's split is drawn from the ranges by hash. What is left below, at
most GROUP rows, moves once, in blocks, and grows in groups of single nodes. A node that stays
large for lack of luck is divided further, so no group is unbounded.

Forests of small trees (at most 2 GROUP nodes each) are collected and broadcast. Forests of
larger ones stay a node table: upper splits by (tree, node), and the trees below them as one
row each. Rows to score walk the upper splits, move in blocks beside the trees of their nodes,
and path lengths are summed up per row. Of such a forest only the upper splits, a few for every
GROUP rows of a tree, pass through the driver.

`grow` builds the forests of many settings in one job: settings with the same sample share
their draws.
"""

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Window, functions as F

from oddspend.functions.sampling import take_fixed, top_per_group
from oddspend.operators.models.base import OffsetModel, matrix_udf, to_matrix
from oddspend.session import materialize

GROUP = 8192  # rows that grow in one task; larger nodes are split over all tasks first
CELL_BITS = 16  # leading bits of a hash by which the rows of large samples are counted


def path_length(n):
    """Average depth of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3.0)
    long = 2.0 * (np.log(safe - 1.0) + np.euler_gamma) - 2.0 * (safe - 1.0) / safe
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, long))


def grow_tree(x, rng, level, depth, columns):
    """Nodes (feature, split, left, right, value); leaves have feature -1, roots place 0."""
    nodes = [None]
    todo = [(0, level, np.arange(len(x)))]
    while todo:
        place, level, rows = todo.pop()
        part = x[rows][:, columns]
        usable = np.flatnonzero(part.max(axis=0) > part.min(axis=0)) if len(rows) > 1 and level < depth else []
        if len(usable) == 0:
            nodes[place] = (-1, 0.0, place, place, level + float(path_length(len(rows))))
            continue
        j = rng.choice(usable)
        cut = rng.uniform(part[:, j].min(), part[:, j].max())
        nodes[place] = (int(columns[j]), cut, len(nodes), len(nodes) + 1, 0.0)
        left = part[:, j] <= cut
        todo += [(len(nodes), level + 1, rows[left]), (len(nodes) + 1, level + 1, rows[~left])]
        nodes += [None, None]
    return nodes


def grow_levels(x, rng, level, depth, columns):
    """grow_tree for the nodes of large samples: all nodes of a level at once, numbered in the order of levels.
    An input is drawn for every open node and drawn again where all rows agree in it, which is a draw from the
    inputs that can part the node; nodes left after a few draws look at all of them."""
    rows, sizes, places, count, out = np.arange(len(x)), np.array([len(x)]), np.zeros(1, np.int64), 1, []
    while True:
        m, owner = len(places), np.repeat(np.arange(len(places)), sizes)
        feature, split, todo = np.full(m, -1), np.zeros(m), np.flatnonzero(sizes > 1) if level < depth else np.empty(0, np.int64)
        for draw in range(4):
            if not len(todo):
                break
            asked = np.zeros(m, dtype=bool)
            asked[todo] = True
            mine = asked[owner]
            own, part = owner[mine], rows[mine]
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            if draw < 3:
                j = np.zeros(m, np.int64)
                j[todo] = columns[rng.integers(len(columns), size=len(todo))]
                values, j = x[part, j[own]], j[todo]
                low, high = np.minimum.reduceat(values, first), np.maximum.reduceat(values, first)
            else:
                values = x[part][:, columns]
                low, high = np.minimum.reduceat(values, first, axis=0), np.maximum.reduceat(values, first, axis=0)
                pick = np.arange(len(todo)), np.where(high > low, rng.random(low.shape), -1.0).argmax(axis=1)
                low, high, j = low[pick], high[pick], columns[pick[1]]
            fine = high > low
            feature[todo[fine]], split[todo[fine]] = j[fine], rng.uniform(low[fine], high[fine])
            todo = todo[~fine]
        cut = np.flatnonzero(feature >= 0)
        left, right, value = places.copy(), places.copy(), level + path_length(sizes)
        left[cut] = count + 2 * np.arange(len(cut))
        right[cut], value[cut] = left[cut] + 1, 0.0
        out.append((feature, split, left, right, value))
        if not len(cut):
            return tuple(np.concatenate(c) for c in zip(*out))
        mine = (feature >= 0)[owner]
        own, rows = owner[mine], rows[mine]
        number = np.zeros(m, np.int64)
        number[cut] = np.arange(len(cut))
        side = 2 * number[own] + (x[rows, feature[own]] > split[own])
        rows = rows[np.argsort(side, kind="stable")]
        sizes, places = np.bincount(side, minlength=2 * len(cut)), count + np.arange(2 * len(cut))
        count, level = count + 2 * len(cut), level + 1


def forest_depths(x, roots, feature, split, child, value, depth):
    """Sum over the trees of the path length of every row. child holds the left and right
    places of each node in turn; leaves lead to themselves."""
    n, d = x.shape
    total = np.zeros(n)
    for at in range(0, n, 4096):
        part = np.ascontiguousarray(x[at:at + 4096])
        flat, base = part.ravel(), np.arange(len(part)) * d
        acc = np.zeros(len(part))
        for root in roots:
            place = np.full(len(part), root, dtype=np.int64)
            for _ in range(depth):
                high = flat.take(base + feature.take(place)) > split.take(place)
                place = child.take(2 * place + high)
            acc += value.take(place)
        total[at:at + 4096] = acc
    return total


def swapped_depths(x, other, roots, feature, split, child, value, depth):
    """(path lengths of every row summed over the trees, their change when input j alone takes the
    value it has in other). A swapped row leaves its own path at the first node that tells the two
    values of j apart, so only what lies below such nodes is walked again."""
    n, d = x.shape
    total, change = np.zeros(n), np.zeros((n, d))
    for at in range(0, n, 4096):
        own, swap = np.ascontiguousarray(x[at:at + 4096]).ravel(), np.ascontiguousarray(other[at:at + 4096]).ravel()
        base, acc, moved = np.arange(0, len(own), d), np.zeros(len(own) // d), np.zeros(len(own))
        for root in roots:
            place, left = np.full(len(base), root, dtype=np.int64), np.zeros(len(own), dtype=bool)
            cell, side = np.empty(0, np.int64), np.empty(0, np.int64)  # (row, input) off the row's path, and where it is
            for _ in range(depth):
                if len(cell):
                    here = cell - cell % d + feature.take(side)
                    high = np.where(here == cell, swap.take(here), own.take(here)) > split.take(side)
                    side = child.take(2 * side + high)
                here, cut = base + feature.take(place), split.take(place)
                high = own.take(here) > cut
                turn = np.flatnonzero((swap.take(here) > cut) != high)
                turn = turn[~left[here[turn]]]
                if len(turn):
                    left[here[turn]] = True
                    cell = np.concatenate([cell, here[turn]])
                    side = np.concatenate([side, child.take(2 * place[turn] + ~high[turn])])
                place = child.take(2 * place + high)
            end = value.take(place)
            acc += end
            moved[cell] += value.take(side) - end[cell // d]
        total[at:at + 4096], change[at:at + 4096] = acc, moved.reshape(-1, d)
    return total, change


def _leaf_level(node):
    """The level of a node by its number: the root is 0, children of i are 2 i + 1 and 2 i + 2."""
    return (node + 1).bit_length() - 1


def grow(df, forests):
    """Grows forests of one seed, on the same rows, together: the table is counted and sampled
    once, and all trees grow in one grouped job."""
    n, seed, width = df.count(), forests[0].seed, forests[0].n_features
    if any(f.seed != seed for f in forests):
        raise ValueError("forests that grow together have one seed")
    shapes, offsets, columns, depths = [f._shape(n) for f in forests], [], [], []
    for f, (psi, depth) in zip(forests, shapes):
        offsets.append(len(columns))
        k = max(1, int(f.max_features * width)) if isinstance(f.max_features, float) else int(f.max_features)
        columns += [np.sort(np.random.default_rng((seed, i)).choice(width, size=k, replace=False)) for i in range(f.n_estimators)]
        depths += [depth] * f.n_estimators
    draws: dict = {}
    for f, (psi, _), first in zip(forests, shapes, offsets):
        draws.setdefault((f.n_estimators, psi), []).append(first)
    most = min(n, max(2 * t * psi for t, psi in draws))
    pool = take_fixed(df.select("row_id", "features"), most, "row_id", seed, n)
    if len(draws) > 1:
        pool = materialize(pool, "forest_pool")
    small = large = None
    for (t, psi), firsts in draws.items():
        size = min(n, 2 * t * psi)
        rows = take_fixed(pool, size, "row_id", seed, most)
        if psi <= GROUP:
            rows = _sample(rows, t, psi, size, seed)
            rows = rows.withColumn("tree", F.explode(F.array(*[F.col("tree") + F.lit(first) for first in firsts])))
            rows = rows.select("row_id", "features", "tree", F.lit(0).cast("long").alias("node"))
            small = rows if small is None else small.unionByName(rows)
        else:
            rows = _members(rows, t, psi, size, seed, firsts)
            large = rows if large is None else large.unionByName(rows)
    local = [i for f in forests for i in range(f.n_estimators)]
    upper = parts = None

    def grown(pdf, ids, x, grower):
        tree, node = int(pdf["tree"].iloc[0]), int(pdf["node"].iloc[0])
        rng = np.random.default_rng((seed, local[tree], node))
        found = grower(x[np.argsort(ids, kind="stable")], rng, _leaf_level(node), depths[tree], columns[tree])
        return pd.DataFrame({"tree": [tree], "node": [node], **{c: [v] for c, v in zip(("feature", "split", "left", "right", "value"), found)}})

    def grow_group(pdf: pd.DataFrame) -> pd.DataFrame:
        return grown(pdf, pdf["row_id"].to_numpy(), np.stack(pdf["features"].to_numpy()), lambda *a: map(list, zip(*grow_tree(*a))))

    def grow_blocks(pdf: pd.DataFrame) -> pd.DataFrame:
        return grown(pdf, *_joined(pdf, width), grow_levels)

    tasks, kinds = 2 * df.sparkSession.sparkContext.defaultParallelism, "tree int, node long, feature array<int>, split array<double>, left array<int>, right array<int>, value array<double>"
    if small is not None:
        parts = small.repartition(tasks, "tree", "node").groupBy("tree", "node").applyInPandas(grow_group, kinds)
    if large is not None:
        large = materialize(large, "forest_members", parallel=True)
        drawn = large.select("row_id", F.explode("trees").alias("tree"))
        upper, blocks = forests[0]._upper_levels(drawn, columns, depths, local, large)
        below = blocks.repartition(max(tasks, blocks.rdd.getNumPartitions()), "tree", "node").groupBy("tree", "node").applyInPandas(grow_blocks, kinds)
        parts = below if parts is None else parts.unionByName(below)
    if upper is not None:
        parts = materialize(parts, "forest_parts")
    whole = [(first, f) for f, (psi, _), first in zip(forests, shapes, offsets) if psi <= GROUP]
    if whole:
        ours = F.lit(False)
        for first, f in whole:
            ours = ours | F.col("tree").between(first, first + f.n_estimators - 1)
        got = {r.tree: r for r in parts.filter(ours).collect()}  # at most 2 GROUP nodes a tree
    for f, (psi, depth), first in zip(forests, shapes, offsets):
        f.nodes = None
        if psi <= GROUP:
            f._join_parts([got[first + i] for i in range(f.n_estimators)])
        else:
            mine = lambda x: x.filter(F.col("tree").between(first, first + f.n_estimators - 1)).withColumn("tree", F.col("tree") - F.lit(first))  # noqa: B023, E731
            f.nodes, f.trees = (mine(upper), mine(parts)), {"roots": np.zeros(f.n_estimators, np.int64)}
        f.trees["shape"] = np.array([depth, psi])


def _drawn(t, psi, n, seed, also=None):
    """The trees, of t, that draw a row from a pool of n rows: about 2 psi rows a tree, if there are so many."""
    limit = int(min(1.0, 2.0 * psi / n) * 2 ** 31)

    def chosen(i):
        hit = F.pmod(F.xxhash64("row_id", i, F.lit(seed)), F.lit(2 ** 31)) < F.lit(limit)
        return hit if also is None else hit & also(i)

    return F.filter(F.sequence(F.lit(0), F.lit(t - 1)), chosen)


def _sample(pool, t, psi, n, seed):
    """Exactly psi rows of the pool of n rows for each of t small trees (all, if it has fewer)."""
    draws = pool.withColumn("tree", F.explode(_drawn(t, psi, n, seed)))
    return top_per_group(draws, ["tree"], [F.xxhash64("row_id", "tree", F.lit(seed + 1)), F.col("row_id")], psi)


def _members(pool, t, psi, n, seed, firsts):
    """(row_id, features, trees): for each of t trees exactly the psi rows of the pool with the smallest
    (hash, row_id) (all, if it has fewer). The cut-off is found from counts, and only rows that agree
    with it in the leading bits of the hash are ranked."""
    order = lambda i: F.xxhash64("row_id", i, F.lit(seed + 1))
    draws = pool.select("row_id", F.explode(_drawn(t, psi, n, seed)).alias("tree")).withColumn("_order", order(F.col("tree")))
    cells = draws.withColumn("_cell", F.shiftright("_order", 64 - CELL_BITS))
    counts = cells.groupBy("tree", "_cell").agg(F.count(F.lit(1)).alias("_n"))  # at most 2 ** CELL_BITS a tree
    upto = F.sum("_n").over(Window.partitionBy("tree").orderBy("_cell"))
    edge = counts.withColumn("_before", upto - F.col("_n")).filter((F.col("_before") < psi) & (F.col("_before") + F.col("_n") >= psi))
    edge = F.broadcast(edge.select("tree", "_cell", (F.lit(psi) - F.col("_before")).alias("_rest")))  # a row a tree
    last = cells.join(edge, ["tree", "_cell"])
    last = last.withColumn("_rn", F.row_number().over(Window.partitionBy("tree").orderBy("_order", "row_id"))).filter("_rn = _rest")
    cuts = {r.tree: (r._order, r.row_id) for r in last.select("tree", "_order", "row_id").collect()}
    top = 2 ** 63 - 1
    ends = [F.array(*[F.lit(cuts.get(i, (top, top))[k]).cast("long") for i in range(t)]) for k in (0, 1)]

    def within(i):
        return (order(i) < F.get(ends[0], i)) | ((order(i) == F.get(ends[0], i)) & (F.col("row_id") <= F.get(ends[1], i)))

    trees = _drawn(t, psi, n, seed, within)
    return pool.select("row_id", "features", F.flatten(F.array(*[F.transform(trees, lambda i: i + F.lit(first)) for first in firsts])).alias("trees"))  # noqa: B023


def score_together(df, forests):
    """df with `scores`, one raw score for each of the forests, from one pass over df for all
    forests that fit into a broadcast."""
    spark, whole = df.sparkSession, [k for k, f in enumerate(forests) if f.nodes is None]
    shared = spark.sparkContext.broadcast([forests[k]._compiled() for k in whole])

    @F.pandas_udf("array<double>")
    def score(features: pd.Series) -> pd.Series:
        x = np.stack(features.to_numpy()) if len(features) else np.empty((0, 1))
        return pd.Series(list(np.stack([_scores(x, f, norm) for f, norm in shared.value], axis=1)), index=features.index)

    out = df.withColumn("_whole", score("features") if whole else F.array().cast("array<double>"))
    places = {k: F.get("_whole", F.lit(i)) for i, k in enumerate(whole)}
    for k, f in enumerate(forests):
        if f.nodes is not None:
            out = f.raw_score(out).withColumnRenamed("_raw", f"_raw{k}")
            places[k] = F.col(f"_raw{k}")
    return out.select(*[F.col(f"`{c}`") for c in df.columns], F.array(*[places[k] for k in range(len(forests))]).alias("scores"))


def _scores(x, forest, norm):
    return 2.0 ** (-forest_depths(x, **forest) / len(forest["roots"]) / norm)


def _compile_upper(splits, t):
    """Upper splits (tree, node, j, cut, n) as arrays over places, the roots of the t trees first. Places
    without a split lead to themselves; value is the path length where a tree ends, else NaN."""
    node, feature, cut, child, value, tree = [0] * t, [0] * t, [np.inf] * t, [[i, i] for i in range(t)], [np.nan] * t, list(range(t))
    place, depth = {(i, 0): i for i in range(t)}, 0
    for r in sorted(splits, key=lambda r: r[1]):
        at, level = place[r[0], r[1]], _leaf_level(r[1])
        if r[2] < 0:
            value[at] = level + float(path_length(r[4]))
            continue
        depth = max(depth, level + 1)
        feature[at], cut[at], child[at] = r[2], r[3], [len(node), len(node) + 1]
        for side in (1, 2):
            place[r[0], 2 * r[1] + side] = len(node)
            node.append(2 * r[1] + side)
            feature.append(0), cut.append(np.inf), value.append(np.nan), tree.append(r[0])
            child.append([len(node) - 1] * 2)
    return {"node": np.array(node, np.int64), "tree": np.array(tree, np.int32), "feature": np.array(feature, np.int32), "split": np.array(cut, float),
            "child": np.array(child, np.int64).ravel(), "value": np.array(value, float), "depth": depth}


def _walked(x, tree, upper):
    """Place of every row of x after the upper splits of the tree."""
    flat, base, place = np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1], np.full(len(x), tree, dtype=np.int64)
    for _ in range(upper["depth"]):
        place = upper["child"].take(2 * place + (flat.take(base + upper["feature"].take(place)) > upper["split"].take(place)))
    return place


def _runs(values):
    """(order that sorts values, where each value begins in it)"""
    order = np.argsort(values, kind="stable")
    held = values[order]
    return order, np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1]])) if len(held) else np.empty(0, np.int64)


def _row_trees(col):
    """(tree, numbers of the rows it drew) for a column of lists of trees."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    trees = col.flatten().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(col)), np.diff(col.offsets.to_numpy()))
    order, starts = _runs(trees)
    for part in np.split(order, starts[1:]) if len(order) else []:
        yield int(trees[part[0]]), rows[part]


def _blocks(ids, x, tree, place, upper):
    """Record batch (tree, node, ids, x) of the rows, a block for each node."""
    order, starts = _runs(place)
    ids, x, ends = ids[order], x[order], [*starts[1:], len(order)]
    return pa.RecordBatch.from_pydict({
        "tree": pa.array([tree] * len(starts), pa.int32()), "node": pa.array(upper["node"][place[order[starts]]]),
        "ids": pa.array([ids[i:j].tobytes() for i, j in zip(starts, ends)], pa.binary()),
        "x": pa.array([x[i:j].tobytes() for i, j in zip(starts, ends)], pa.binary())})


_BLOCKS = "tree int, node long, ids binary, x binary"


def _joined(pdf, width):
    """(ids, matrix) of blocks."""
    return np.frombuffer(b"".join(pdf["ids"]), np.int64), np.frombuffer(b"".join(pdf["x"])).reshape(-1, width)


def _walk_parts(depth, width):
    """(_k, path length) of blocks of rows that stream behind the tree of their node, sorted by (tree, node);
    lengths of one row are added up where they meet."""

    def added(out):
        keys, at = np.unique(np.concatenate([k for k, _ in out]), return_inverse=True)
        return pd.DataFrame({"_k": keys, "value": np.bincount(at, np.concatenate([v for _, v in out]))})

    def run(batches):
        now, tree, out, held = None, None, [], 0
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                key = int(r.tree), int(r.node)
                if key != now:
                    now, tree = key, None
                if r.kind == 0:
                    feature = np.asarray(r.feature)
                    tree = {"roots": [0], "feature": np.where(feature < 0, 0, feature), "split": np.where(feature < 0, np.inf, r.split),
                            "child": np.stack([r.left, r.right], axis=1).ravel(), "value": np.asarray(r.value), "depth": depth}
                    continue
                ids = np.frombuffer(r.ids, np.int64)
                # a side that drew no row has no tree: it ends at its level
                found = np.full(len(ids), float(_leaf_level(key[1]))) if tree is None else forest_depths(np.frombuffer(r.x).reshape(-1, width), **tree)
                out.append((ids, found))
                held += len(ids)
                if held > 1_000_000:
                    yield added(out)
                    out, held = [], 0
        if out:
            yield added(out)

    return run


class IsolationForest(OffsetModel):
    name = "isolation_forest"

    def __init__(self, n_estimators=200, max_samples="auto", max_features=1.0, contamination=0.02, seed=42):
        super().__init__(contamination, seed)
        self.n_estimators, self.max_samples, self.max_features = n_estimators, max_samples, max_features
        self.trees = self.nodes = None

    def _shape(self, n):
        """(rows of a tree, its depth) on a table of n rows."""
        if self.max_samples == "auto":
            psi = min(256, n)
        else:
            psi = int(self.max_samples * n) if isinstance(self.max_samples, float) else min(int(self.max_samples), n)
        return max(psi, 1), max(1, math.ceil(math.log2(max(psi, 2))))

    def _fit(self, df):
        grow(df, [self])

    def _upper_levels(self, drawn, columns, depths, local, members):
        """(splits as a table (tree, node, j, cut, n), blocks of rows in the nodes below them) while nodes
        hold over GROUP rows. j is -1 for leaves: copies of one row, or the lowest level. drawn: (row_id,
        tree), members: the same rows with their features and the list of their trees."""
        spark, seed, width, t = members.sparkSession, self.seed, self.n_features, len(columns)

        def draw(batches):
            for pdf in batches:
                out = []
                for r in pdf.itertuples(index=False):
                    low, high = np.asarray(r.low), np.asarray(r.high)
                    usable = [j for j in columns[r.tree] if high[j] > low[j]]
                    j, cut = -1, 0.0
                    if usable and _leaf_level(int(r.node)) < depths[r.tree]:
                        rng = np.random.default_rng((seed, local[r.tree], int(r.node)))
                        j = int(rng.choice(usable))
                        cut = float(rng.uniform(low[j], high[j]))
                    out.append((r.tree, r.node, j, cut, r.n))
                yield pd.DataFrame(out, columns=["tree", "node", "j", "cut", "n"])

        def ranges(shared):
            def run(batches):
                upper, number = shared.value
                size = int(number.max()) + 1
                n, low, high = np.zeros(size, np.int64), np.full((size, width), np.inf), np.full((size, width), -np.inf)
                for b in batches:
                    x = to_matrix(b.column(0))
                    for tree, rows in _row_trees(b.column(1)):
                        part = x[rows]
                        at = number[_walked(part, tree, upper)]
                        part, at = part[at >= 0], at[at >= 0]
                        if len(at):
                            order, starts = _runs(at)
                            own, part = at[order[starts]], part[order]
                            n[own] += np.diff([*starts, len(at)])
                            low[own] = np.minimum(low[own], np.minimum.reduceat(part, starts, axis=0))
                            high[own] = np.maximum(high[own], np.maximum.reduceat(part, starts, axis=0))
                place = np.flatnonzero(number >= 0)
                place = place[n[number[place]] > 0]
                for at in range(0, len(place), 1024):
                    part = place[at:at + 1024]
                    own = number[part]
                    yield pa.RecordBatch.from_pydict({
                        "tree": pa.array(upper["tree"][part]), "node": pa.array(upper["node"][part]), "n": pa.array(n[own]),
                        "low": pa.array(list(low[own]), pa.list_(pa.float64())), "high": pa.array(list(high[own]), pa.list_(pa.float64()))})
            return run

        splits, opened = [], {(r.tree, 0) for r in drawn.groupBy("tree").count().filter(F.col("count") > GROUP).collect()}
        while opened:
            # only what the last splits divided is open: other nodes are small or have ended
            upper, at = _compile_upper(splits, t), 0
            number = np.full(len(upper["node"]), -1)
            for i, key in enumerate(zip(upper["tree"].tolist(), upper["node"].tolist())):
                if key in opened:
                    number[i], at = at, at + 1
            got = members.select("features", "trees").mapInArrow(ranges(spark.sparkContext.broadcast((upper, number))), "tree int, node long, n long, low array<double>, high array<double>")
            of = lambda f, c: F.array(*[f(F.get(c, F.lit(j))) for j in range(width)]).alias(c)
            got = got.groupBy("tree", "node").agg(F.sum("n").alias("n"), of(F.min, "low"), of(F.max, "high")).filter(F.col("n") > GROUP)
            fresh = [tuple(r) for r in got.mapInPandas(draw, "tree int, node long, j int, cut double, n long").collect()]
            splits += fresh
            opened = {(r[0], 2 * r[1] + side) for r in fresh if r[2] >= 0 for side in (1, 2)}
        shared = spark.sparkContext.broadcast(_compile_upper(splits, t))

        def below(batches):
            upper = shared.value
            for b in batches:
                ids, x = b.column(0).to_numpy(), to_matrix(b.column(1))
                for tree, rows in _row_trees(b.column(2)):
                    place = _walked(x[rows], tree, upper)
                    live = np.isnan(upper["value"][place])
                    if live.any():
                        yield _blocks(ids[rows[live]], x[rows[live]], tree, place[live], upper)

        table = materialize(spark.createDataFrame(splits, "tree int, node long, j int, cut double, n long"), "forest_splits")
        return table, members.select("row_id", "features", "trees").mapInArrow(below, _BLOCKS)

    def _join_parts(self, parts):
        """One list of nodes for all trees, with the places of their roots."""
        flat, roots = {c: [] for c in ("feature", "split", "left", "right", "value")}, []
        for part in parts:
            base = len(flat["feature"])
            roots.append(base)
            for c in flat:
                flat[c] += [x + base for x in part[c]] if c in ("left", "right") else list(part[c])
        kinds = {"feature": np.int32, "split": float, "left": np.int64, "right": np.int64, "value": float}
        self.trees = {"roots": np.array(roots, np.int64), **{c: np.array(v, kinds[c]) for c, v in flat.items()}}

    def _table_score(self, df):
        """_raw by the node table: rows meet the splits level by level, then the tree of their node."""
        upper, parts = self.nodes
        depth, psi = (int(v) for v in self.trees["shape"])
        t, norm, seen = len(self.trees["roots"]), float(path_length(psi)) or 1.0, df.columns
        base = materialize(df.withColumn("_k", F.monotonically_increasing_id()), "to_score", parallel=True)
        splits = [tuple(r) for r in upper.select("tree", "node", "j", "cut", "n").collect()]  # a few for every GROUP rows of a tree
        shared, width = df.sparkSession.sparkContext.broadcast(_compile_upper(splits, t)), self.n_features

        def spread(batches):
            upper = shared.value
            for b in batches:
                if not b.num_rows:
                    continue
                ids, x, ended = b.column(0).to_numpy(), to_matrix(b.column(1)), np.zeros(b.num_rows)
                for tree in range(t):
                    place = _walked(x, tree, upper)
                    value = upper["value"][place]
                    live = np.isnan(value)
                    ended += np.where(live, 0.0, value)
                    if live.any():
                        yield _blocks(ids[live], x[live], tree, place[live], upper)
                # what ended in the upper levels, as rows of no tree: the ids and their sums
                yield pa.RecordBatch.from_pydict({"tree": pa.array([-1], pa.int32()), "node": pa.array([0], pa.int64()), "ids": pa.array([ids.tobytes()]), "x": pa.array([ended.tobytes()])})

        def sums(batches):
            for pdf in batches:
                for r in pdf.itertuples(index=False):
                    yield pd.DataFrame({"_k": np.frombuffer(r.ids, np.int64), "value": np.frombuffer(r.x)})

        blocks = materialize(base.select("_k", "features").mapInArrow(spread, _BLOCKS), "forest_blocks")
        beside = parts.withColumn("kind", F.lit(0)).unionByName(blocks.filter("tree >= 0").withColumn("kind", F.lit(1)), allowMissingColumns=True)
        beside = beside.repartition("tree", "node").sortWithinPartitions("tree", "node", "kind")
        beside = beside.select("tree", "node", "kind", "ids", "x", "feature", "split", "left", "right", "value")
        lengths = blocks.filter("tree < 0").mapInPandas(sums, "_k long, value double").unionByName(beside.mapInPandas(_walk_parts(depth, width), "_k long, value double"))
        lengths = lengths.groupBy("_k").agg(F.sum("value").alias("_sum"))
        out = base.join(lengths, "_k").withColumn("_raw", F.pow(F.lit(2.0), -F.col("_sum") / F.lit(float(t)) / F.lit(norm)))
        return out.select(*[F.col(f"`{c}`") for c in seen], "_raw")

    def _compiled(self):
        t, leaf = self.trees, np.asarray(self.trees["feature"]) < 0
        depth, psi = (int(v) for v in t["shape"])
        forest = {
            "roots": t["roots"].astype(np.int64), "feature": np.where(leaf, 0, t["feature"]).astype(np.int32),
            "split": np.where(leaf, np.inf, t["split"]), "value": t["value"], "depth": depth,
            "child": np.stack([t["left"], t["right"]], axis=1).ravel().astype(np.int64)}
        return forest, float(path_length(psi)) or 1.0

    def raw_score(self, df):
        if self.trees is None:
            raise RuntimeError(f"{self.name} is not fitted")
        if self.nodes is not None:
            return self._table_score(df)
        shared = df.sparkSession.sparkContext.broadcast(self._compiled())

        def score(x):
            return _scores(x, *shared.value)

        return df.withColumn("_raw", matrix_udf(score)("features"))

    def swap_effects(self, spark):
        """Function of the columns (features, other): |score change| of each input when it alone takes
        the other row's value. None for a forest that is a table of nodes."""
        if self.nodes is not None:
            return None
        shared = spark.sparkContext.broadcast(self._compiled())

        @F.arrow_udf("array<double>")
        def effects(features: pa.Array, other: pa.Array) -> pa.Array:
            if not len(features):
                return pa.array([], pa.list_(pa.float64()))
            x, (forest, norm) = to_matrix(features), shared.value
            total, change = swapped_depths(x, to_matrix(other), **forest)
            t = len(forest["roots"])
            out = np.abs(2.0 ** (-(total[:, None] + change) / t / norm) - 2.0 ** (-total / t / norm)[:, None])
            return pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, x.shape[1], dtype=np.int32)), pa.array(out.ravel()))

        return effects

    def save(self, spark, path):
        super().save(spark, path)
        if self.nodes is not None:
            for name, table in zip(("upper", "parts"), self.nodes):
                table.write.mode("overwrite").parquet(f"{path}/nodes/{name}")

    @classmethod
    def load(cls, spark, path):
        model = super().load(spark, path)
        if "feature" not in model.trees:
            model.nodes = tuple(spark.read.parquet(f"{path}/nodes/{name}") for name in ("upper", "parts"))
        return model

    def _arrays(self):
        return self.trees

    def _set_arrays(self, arrays):
        self.trees = arrays

    def _settings(self):
        return {"n_estimators": self.n_estimators, "max_samples": self.max_samples, "max_features": self.max_features}
