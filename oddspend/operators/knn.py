"""Exact k nearest neighbours as a partitioned join.

Space is cut into regions by a tree over the principal axes of a sample; regions that hold too
many rows are dealt over pieces. Rows travel in blocks, a region's rows of one batch in one row.
A query first meets the piece it lies in: the distance of the k-th row there bounds how far its
neighbours can be. It then goes only to pieces whose box is within that reach, and a meeting
emits only rows within reach, at most k + 1 a query. Inside a meeting the reference rows lie in
small leaves, a leaf sees only the queries that reach its box, and distances are screened by a
matrix product in single precision with a margin for its rounding; those that pass are computed
exactly. Pairs are merged by id.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from oddspend.functions.sampling import take_fixed
from oddspend.operators.models.base import to_matrix
from oddspend.session import materialize

MAX_REGIONS = 1024
SAMPLE = 64  # rows a region in the sample that the regions are made from
QUERIES = 32768  # query rows of a meeting
LEAF, WINDOW = 256, 8  # rows of a leaf, leaves that give a query its first reach
HELD = 4_000_000  # pairs a meeting holds before it keeps the nearest of them
MERGED = 1_000_000  # pairs of a merge
_SHAPE = pa.schema([("id", pa.int64()), ("nbr", pa.int64()), ("dist", pa.float64())])


def _distances(x, y):
    acc = np.zeros((len(x), len(y)))
    for j in range(x.shape[1]):
        gap = x[:, j, None] - y[None, :, j]
        acc += gap * gap
    return np.sqrt(acc)


def _halves(z, size):
    """Row numbers of z in runs of at most size rows that lie close together."""
    found, todo = [], [np.arange(len(z))]
    while todo:
        rows = todo.pop()
        if len(rows) <= size:
            found.append(rows)
            continue
        half, values = len(rows) // 2, z[rows]
        order = np.argpartition(values[:, values.var(axis=0).argmax()], half)
        todo += [rows[order[half:]], rows[order[:half]]]
    return found


class _Leaves:
    """Reference rows in leaves, with boxes along the axes."""

    def __init__(self, y, names, axes, kind):
        self.mid, self.axes, self.kind = y.mean(axis=0), axes, kind
        z = self.turned(y)
        parts = _halves(z, LEAF)
        order, self.starts = np.concatenate(parts), np.cumsum([0, *[len(p) for p in parts]])
        self.y, self.names, self.z = y[order], names[order], z[order]
        self.place = order
        self.half = (self.z * self.z).sum(axis=1) / 2
        self.low, self.high = (f.reduceat(self.z, self.starts[:-1]) for f in (np.minimum, np.maximum))
        self.most = np.maximum.reduceat(self.half, self.starts[:-1])
        self.center = (np.add.reduceat(self.z, self.starts[:-1]) / np.diff(self.starts)[:, None]).astype(kind)

    def turned(self, x):
        return ((x - self.mid) @ self.axes).astype(self.kind)


def _first_reach(ref, z, xx, slack, take):
    """A distance within which every query has `take` rows of the leaves around it."""
    near = (ref.center * ref.center).sum(axis=1) / 2 - z @ ref.center.T
    home, leaves, reach = near.argmin(axis=1), len(ref.starts) - 1, np.full(len(z), np.inf)
    order = np.argsort(home, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(home[order])) + 1):
        first = max(0, min(home[rows[0]] // WINDOW * WINDOW, leaves - WINDOW))
        a, b = ref.starts[first], ref.starts[min(leaves, first + WINDOW)]
        if b - a < take:
            a, b = 0, len(ref.z)
        for at in range(0, len(rows), 2048):
            part = rows[at:at + 2048]
            kth = np.partition(ref.half[a:b] - z[part] @ ref.z[a:b].T, take - 1, axis=1)[:, take - 1]
            reach[part] = np.sqrt(np.maximum(0.0, 2.0 * kth.astype(float) + xx[part] + slack * (xx[part] + 2.0 * ref.half[a:b].max())))
    return reach


def _kept(found, ref, x, reach, take):
    """(query, place, distance) of the `take` nearest of the pairs within reach, by query, distance, name."""
    i, j = (np.concatenate(v) for v in zip(*found))
    dist = np.zeros(len(i))
    for c in range(x.shape[1]):
        gap = x[i, c] - ref.y[j, c]
        dist += gap * gap
    dist = np.sqrt(dist)
    fine = dist <= reach[i]
    i, j, dist = i[fine], j[fine], dist[fine]
    order = np.lexsort((ref.names[j], dist, i))
    i, j, dist = i[order], j[order], dist[order]
    keep = np.arange(len(i)) - np.searchsorted(i, i) < take
    return i[keep], j[keep], dist[keep]


def _met(x, y, names, take, reach, axes):
    """(i, j, distance) of the `take` nearest rows of y within reach for every row of x, by name among
    equal distances. Rows of y that are not finite are nobody's neighbours."""
    fine = np.flatnonzero(np.isfinite(y).all(axis=1))
    none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    if not len(fine) or not len(x):
        return none
    span = max(np.abs(y[fine]).max(), np.abs(np.where(np.isfinite(x), x, 0.0)).max())
    ref = _Leaves(y[fine], names[fine], axes, np.float32 if span < 1e15 else float)
    slack, reach = 4.0 * np.finfo(ref.kind).eps * (x.shape[1] + 4), np.array(reach, float)
    with np.errstate(invalid="ignore", over="ignore"):
        z = ref.turned(x)
        xx = (z * z).sum(axis=1).astype(float)
        open_ = np.flatnonzero(np.isinf(reach))
        if len(open_) and len(fine) >= take:
            reach[open_] = _first_reach(ref, z[open_], xx[open_], slack, take)
        columns, found, held = np.ascontiguousarray(z[:, :12].T), [], 0
        for leaf, (a, b) in enumerate(zip(ref.starts, ref.starts[1:])):
            limit = reach * reach + slack * (xx + 2.0 * ref.most[leaf])
            at, gap = np.arange(len(x)), 0.0
            for c, values in enumerate(columns):
                side = np.maximum(np.maximum(ref.low[leaf, c] - values[at], values[at] - ref.high[leaf, c]), 0)
                gap = gap + side * side
                if c in (0, 2, 4, 7) or c == len(columns) - 1:
                    near = np.flatnonzero(gap <= limit[at])
                    at, gap = at[near], gap[near]
            for s in range(0, len(at), 4096):
                part = at[s:s + 4096]
                hit = ref.half[a:b] - z[part] @ ref.z[a:b].T <= ((limit[part] - xx[part]) / 2)[:, None].astype(ref.kind)
                i, j = np.divmod(np.flatnonzero(hit), b - a)
                found.append((part[i], a + j))
                held += len(i)
                if held > HELD:
                    i, j, dist = _kept(found, ref, x, reach, take)
                    last = np.flatnonzero(np.bincount(i, minlength=len(x)) == take)
                    if len(last):
                        far = np.zeros(len(x))
                        np.maximum.at(far, i, dist)
                        reach[last] = far[last]
                    found, held = [(i, j)], 0
        if not found:
            return none
        i, j, dist = _kept(found, ref, x, reach, take)
    return i, fine[ref.place[j]], dist


def _nearest(x, y, take, reach):
    """(i, j, distance) of the `take` nearest rows of y within reach for every row of x, in the
    order of y among equal distances. Rows of y that are not finite are nobody's neighbours."""
    return _met(x, y, np.arange(len(y)), take, reach, np.eye(x.shape[1]))


class _Regions:
    """The tree over the axes, and the pieces of its regions with their boxes."""

    def __init__(self, sample, most):
        sample = sample[np.isfinite(sample).all(axis=1)]
        d = sample.shape[1]
        self.mid = sample.mean(axis=0) if len(sample) else np.zeros(d)
        self.axes = np.linalg.eigh(np.cov(sample.T).reshape(d, d))[1][:, ::-1] if len(sample) > 1 else np.eye(d)
        z = self.turned(sample)
        size, todo, self.feature, self.cut, self.child = max(1, -(-len(z) // most)), [(0, np.arange(len(z)))], [0], [np.inf], [0, 0]
        while todo:
            place, rows = todo.pop()
            part = z[rows]
            j = int(part.var(axis=0).argmax()) if len(rows) > size else 0
            values = np.unique(part[:, j]) if len(rows) > size else []
            if len(values) < 2:
                continue
            cut = min(np.median(part[:, j]), values[-2])
            left, at = part[:, j] <= cut, len(self.cut)
            self.feature[place], self.cut[place], self.child[2 * place:2 * place + 2] = j, cut, [at, at + 1]
            self.feature += [0, 0]
            self.cut += [np.inf, np.inf]
            self.child += [at, at, at + 1, at + 1]
            todo += [(at, rows[left]), (at + 1, rows[~left])]
        self.feature, self.cut, self.child = np.array(self.feature), np.array(self.cut), np.array(self.child)
        self.pieces = np.ones(len(self.cut), np.int64)

    def turned(self, x):
        return (x - self.mid) @ self.axes

    def of(self, x):
        """Region of every row."""
        z, place = np.ascontiguousarray(self.turned(x)), np.zeros(len(x), np.int64)
        base = np.arange(len(x)) * x.shape[1]
        while True:
            to = self.child.take(2 * place + (z.ravel().take(base + self.feature.take(place)) > self.cut.take(place)))
            if (to == place).all():
                return place
            place = to

    def divided(self, rows, boxes):
        """rows: {region: pieces}; boxes: {region: (low, high)} of the finite rows of those that have any."""
        for region, n in rows.items():
            self.pieces[region] = n
        self.first = np.concatenate([[0], np.cumsum(self.pieces)[:-1]])
        owner, d = np.repeat(np.arange(len(self.pieces)), self.pieces), len(self.mid)
        low, high = np.full((len(self.pieces), d), np.inf), np.full((len(self.pieces), d), -np.inf)
        for region, (a, b) in boxes.items():
            low[region], high[region] = a, b
        self.low, self.high = low[owner], high[owner]

    def piece(self, region, ids):
        return self.first[region] + _mixed(ids) % self.pieces[region]

    def within(self, x, reach):
        """(row, piece) where the box of the piece is within the row's reach."""
        z, rows, pieces = self.turned(x), [], []
        size = np.maximum(np.abs(np.where(np.isfinite(self.low), self.low, 0)), np.abs(np.where(np.isfinite(self.high), self.high, 0))).max(axis=1)
        some = np.flatnonzero(np.isfinite(self.low).all(axis=1))
        for at in range(0, len(x), 512):
            part, far = z[at:at + 512], reach[at:at + 512]
            gap = np.zeros((len(part), len(some)))
            for c in range(z.shape[1]):
                side = np.maximum(np.maximum(self.low[some, c] - part[:, c, None], part[:, c, None] - self.high[some, c]), 0)
                gap += side * side
            limit = (far * far)[:, None] * (1 + 1e-9) + 1e-9 * ((part * part).max(axis=1)[:, None] + size[some] ** 2) * 1e-3
            i, j = np.nonzero(gap <= limit)
            rows.append(at + i)
            pieces.append(some[j])
        return np.concatenate(rows), np.concatenate(pieces)


def _mixed(ids):
    """Numbers from 0 that spread ids of any pattern."""
    return ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)


_BLOCK = "key int, part int, ids binary, x binary, reach binary"


def _cut_up(key, part, *columns):
    """Record batch with a row for every (key, part) that there is, the columns as bytes."""
    order = np.lexsort((part, key))
    key, part = key[order], part[order]
    starts = np.flatnonzero(np.concatenate([[True], (np.diff(key) != 0) | (np.diff(part) != 0)])) if len(order) else np.empty(0, np.int64)
    ends = [*starts[1:], len(order)]
    packed = [[c[order[a:b]].tobytes() for a, b in zip(starts, ends)] for c in columns]
    return pa.RecordBatch.from_arrays([pa.array(key[starts], pa.int32()), pa.array(part[starts], pa.int32()), *[pa.array(p, pa.binary()) for p in packed]],
                                      names=["key", "part", "ids", "x", "reach"][:2 + len(columns)])


def _read(table, name, kind):
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def _rows(table, width):
    return _read(table, "ids", np.int64), _read(table, "x", float).reshape(-1, width)


def _neighbours(k, skip_same, axes):
    """Per query of a meeting: its k + 1 nearest reference rows within reach, lower id first
    among equal distances."""
    def meet(q: pa.Table, r: pa.Table) -> pa.Table:
        qi, x = _rows(q, len(axes))
        ri, y = _rows(r, len(axes))
        i, j, dist = _met(x, y, ri, k + 1, _read(q, "reach", float), axes)
        keep = (qi[i] != ri[j]) if skip_same else np.ones(len(i), dtype=bool)
        return pa.table([qi[i[keep]], ri[j[keep]], dist[keep]], schema=_SHAPE)
    return meet


def _merged(k):
    """(id, nbr, rank, dist): the k nearest of all pairs of a part, lower id first among equal distances."""
    def merge(pairs: pa.Table) -> pa.Table:
        ids, nbr, dist = _read(pairs, "ids", np.int64), _read(pairs, "x", np.int64), _read(pairs, "reach", float)
        order = np.lexsort((nbr, dist, ids))
        ids, nbr, dist = ids[order], nbr[order], dist[order]
        rank = np.arange(len(ids)) - np.searchsorted(ids, ids) + 1
        keep = rank <= k
        return pa.table({"id": ids[keep], "nbr": nbr[keep], "rank": rank[keep], "dist": dist[keep]})
    return merge


def knn(queries: DataFrame, reference: DataFrame, k: int, row_id: str = "row_id", exclude_self: bool = True,
        block_rows: int | None = None) -> DataFrame:
    """(id, nbr, rank, dist): the k nearest reference rows of every query row by
    Euclidean distance, ties by lower id. exclude_self skips a pair with equal ids."""
    spark = queries.sparkSession
    same, cores = queries is reference, spark.sparkContext.defaultParallelism
    ref0 = reference.select(F.col(row_id).cast("long").alias("id"), "features")
    n = ref0.count()
    if block_rows is None:  # bounded, and enough of them to keep the cores busy
        block_rows = min(32768, max(1024, n // (4 * cores)))
    wanted = int(min(MAX_REGIONS, max(1, n // block_rows)))
    block_rows = max(block_rows, -(-n // wanted) if wanted == MAX_REGIONS else 0)
    sample = np.array([r.features for r in take_fixed(ref0, SAMPLE * wanted, "id", 7, n).select("features").collect()], dtype=float)
    if not n:
        return spark.createDataFrame([], "id long, nbr long, rank long, dist double")
    regions = _Regions(sample, wanted)
    width, axes = len(regions.mid), regions.axes

    def place(batches):
        for b in batches:
            if b.num_rows:
                ids, x = b.column(0).to_numpy(), to_matrix(b.column(1))
                yield _cut_up(regions.of(x), np.zeros(len(x), np.int64), ids, x)

    def placed(df, name):
        return materialize(df.mapInArrow(place, "key int, part int, ids binary, x binary"), name, parallel=True)

    ref = placed(ref0, "knn_ref")
    qry = ref if same else placed(queries.select(F.col(row_id).cast("long").alias("id"), "features"), "knn_query")

    def boxes(batches):
        for b in batches:
            for key, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x = np.frombuffer(x).reshape(-1, width)
                z = regions.turned(x[np.isfinite(x).all(axis=1)])
                ends = [z.min(axis=0).tolist(), z.max(axis=0).tolist()] if len(z) else [None, None]
                yield pa.RecordBatch.from_pydict({"key": pa.array([key], pa.int32()), "n": pa.array([len(x)], pa.int64()), **{
                    c: pa.array([v], pa.list_(pa.float64())) for c, v in zip(("low", "high"), ends)}})

    edge = lambda f, c: F.array(*[f(F.get(c, F.lit(j))) for j in range(width)]).alias(c)
    sizes = ref.select("key", "x").mapInArrow(boxes, "key int, n long, low array<double>, high array<double>").groupBy("key").agg(
        F.sum("n").alias("n"), edge(F.min, "low"), edge(F.max, "high")).collect()  # a row a region
    regions.divided({r.key: -(-r.n // (2 * block_rows)) for r in sizes}, {r.key: (r.low, r.high) for r in sizes if r.low[0] is not None})
    count = {r.key: r.n for r in (sizes if same else qry.groupBy("key").agg(F.sum(F.octet_length("ids") / 8).cast("long").alias("n")).collect())}
    parts = max(2 * cores, -(-sum(count.values()) * (k + 1) * 2 // MERGED))

    def meetings(left, rows, function, shape):
        """left meets the reference by piece; rows: {piece: query rows}, which say over how many meetings a piece's queries go."""
        shares = np.zeros(int(regions.pieces.sum()), np.int64)
        for p, m in rows.items():
            shares[p] = -(-m // QUERIES)

        def dealt(batches):
            for b in batches:
                for key, ids, x in zip(*[b.column(i).to_pylist() for i in range(3)]):
                    ids, x = np.frombuffer(ids, np.int64), np.frombuffer(x).reshape(-1, width)
                    to = regions.piece(np.full(len(ids), key), ids)
                    for p in np.unique(to):
                        for share in range(shares[p]):
                            yield _cut_up(to[to == p], np.full((to == p).sum(), share), ids[to == p], x[to == p])

        def shared(batches):
            for found in left(batches):
                yield _cut_up(found[0], _mixed(found[1] + 1) % np.maximum(1, shares[found[0]]), *found[1:])

        keys, total = ["key", "part"], int(shares.sum())
        tasks = max(1, min(20_000, total, max(4 * cores, total // 4)))  # few bytes, much CPU
        right = ref.select("key", "ids", "x").mapInArrow(dealt, "key int, part int, ids binary, x binary")
        return lambda df: df.mapInArrow(shared, _BLOCK).repartition(tasks, *keys).groupBy(*keys).cogroup(
            right.repartition(tasks, *keys).groupBy(*keys)).applyInArrow(function, shape)

    neighbours = _neighbours(k, exclude_self, axes)

    def packed(pairs):
        ids, nbr, dist = (pairs.column(c).to_numpy() for c in ("id", "nbr", "dist"))
        return _cut_up(_mixed(ids) % parts, np.zeros(len(ids), np.int64), ids, nbr, dist)

    def at_home(batches):
        for b in batches:
            for key, ids, x in zip(*[b.column(i).to_pylist() for i in range(3)]):
                ids, x = np.frombuffer(ids, np.int64), np.frombuffer(x).reshape(-1, width)
                yield regions.piece(np.full(len(ids), key), ids), ids, x, np.full(len(ids), np.inf)

    def first(q: pa.Table, r: pa.Table) -> pa.Table:
        """The pairs of the home piece, as blocks with part -1; the queries with their reach, part -2; how many of them go to a piece, part -3."""
        empty = pa.RecordBatch.from_pydict({c: pa.array([], t) for c, t in zip(("key", "part", "ids", "x", "reach"), (pa.int32(),) * 2 + (pa.binary(),) * 3)})
        if not q.num_rows:
            return pa.Table.from_batches([empty])
        qi, x = _rows(q, width)
        ri, y = _rows(r, width)
        i, j, dist = _met(x, y, ri, k + 1, np.full(len(x), np.inf), axes)
        reach = np.zeros(len(x))
        np.maximum.at(reach, i, dist)
        reach = np.where(np.bincount(i, minlength=len(x)) == k + 1, reach, np.inf)
        keep = (qi[i] != ri[j]) if exclude_self else np.ones(len(i), dtype=bool)
        home = q.column("key")[0].as_py()
        _, to = regions.within(x, reach)
        to, times = np.unique(to[to != home], return_counts=True)
        blocks = [packed(pa.table([qi[i[keep]], ri[j[keep]], dist[keep]], schema=_SHAPE)), _cut_up(np.full(len(x), home), np.full(len(x), -2), qi, x, reach),
                  _cut_up(to, np.full(len(to), -3), times.astype(np.int64), times, times)]
        blocks[0] = blocks[0].set_column(1, "part", pa.array(np.full(blocks[0].num_rows, -1), pa.int32()))
        return pa.Table.from_batches(blocks)

    def further(batches):
        for b in batches:
            for key, ids, x, reach in zip(*[b.column(i).to_pylist() for i in range(4)]):
                ids, x, reach = np.frombuffer(ids, np.int64), np.frombuffer(x).reshape(-1, width), np.frombuffer(reach)
                for at in range(0, len(ids), 4096):
                    own = slice(at, at + 4096)
                    i, to = regions.within(x[own], reach[own])
                    i, to = i[to != key] + at, to[to != key]
                    yield to, ids[i], x[i], reach[i]

    # a region's queries are counted for each of its pieces alike
    home = {int(regions.first[c]) + p: -(-m // int(regions.pieces[c])) for c, m in count.items() for p in range(int(regions.pieces[c]))}
    near = materialize(meetings(at_home, home, first, _BLOCK)(qry.select("key", "ids", "x")), "knn_first", parallel=True)
    rows = {}
    for r in near.filter("part = -3").select("key", "ids").groupBy("key").agg(F.collect_list("ids").alias("ids")).collect():  # numbers, a few a piece
        rows[r.key] = sum(int(np.frombuffer(v, np.int64).sum()) for v in r.ids)
    pairs = near.filter("part = -1").select("key", "ids", "x", "reach")
    if rows:
        more = meetings(further, rows, lambda q, r: pa.Table.from_batches([packed(neighbours(q, r) if q.num_rows and r.num_rows else _SHAPE.empty_table())]), _BLOCK)
        pairs = pairs.unionByName(more(near.filter("part = -2").select("key", "ids", "x", "reach")).select("key", "ids", "x", "reach"))
    return pairs.repartition(parts, "key").groupBy("key").applyInArrow(_merged(k), "id long, nbr long, rank long, dist double")
