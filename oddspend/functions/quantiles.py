"""Exact quantiles and order statistics that never gather a column in one task.

A quantile is made of two order statistics and one formula, whatever the size. Up
to a known number of rows, a group's values are counted and the counts added up in
one task. Beyond it, the answer is bracketed with the mergeable approximate sketch,
the rows inside the bracket and at its two ends are counted exactly, and the bracket
is narrowed until few enough rows are left. An end that holds the rank is the answer,
else it leaves the bracket, so a value that very many rows share ends the search and
cannot stall it. Every pass is a map-side combined aggregation, so hot groups do no
harm. The column is written once; passes read it and not what it was made from.
Integer columns are selected as integers, so that no id is rounded on the way.
"""

import math

from pyspark.sql import DataFrame, functions as F, Window

from oddspend.session import materialize

SMALL = 250_000
_GRID = 1000


def _clean(df, value, groups, keep_type=False):
    cols = [F.col(f"`{g}`").alias(f"_g{i}") for i, g in enumerate(groups)]
    v = F.col(value) if isinstance(value, str) else value
    if keep_type and df.select(v.alias("v")).schema["v"].dataType.typeName() in ("byte", "short", "integer", "long"):
        return df.select(*(cols or [F.lit(0).alias("_g0")]), v.cast("bigint").alias("_v"))
    # NaN counts as missing; aggregates and range conditions skip nulls by themselves
    return df.select(*(cols or [F.lit(0).alias("_g0")]), F.nanvl(v.cast("double"), F.lit(None).cast("double")).alias("_v"))


def _keys(groups):
    return [f"_g{i}" for i in range(max(1, len(groups)))]


def _next(value, side):
    return value + side if isinstance(value, int) else math.nextafter(value, side * math.inf)


def _join_targets(vals, targets, keys, on_range):
    spark = vals.sparkSession
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vals.schema if f.name in keys)
    kind = vals.schema["_v"].dataType.simpleString()
    t = spark.createDataFrame(targets, f"{fields}, _t long, _lo {kind}, _hi {kind}")
    cond = None
    for k in keys:
        c = vals[k].eqNullSafe(t[k])
        cond = c if cond is None else cond & c
    if on_range:
        cond = cond & (vals["_v"] >= t["_lo"]) & (vals["_v"] <= t["_hi"])
    return vals.join(F.broadcast(t), cond).select(*[vals[k] for k in keys], "_t", "_v", "_lo", "_hi")


def _brackets(wanted):
    """Rows (group..., t, lo, hi), one for each different bracket of a group, and the row's
    (group..., t) for each key: neighbouring ranks share their passes."""
    rows, place = {}, {}
    for key, (lo, hi) in wanted.items():
        row = rows.setdefault((key[:-1], lo, hi), (*key, lo, hi))
        place[key] = row[:-2]
    return list(rows.values()), place


def _select_ranks(vals, keys, targets, small, sizes):
    """targets: {(group..., t): rank}; group keys on the driver are the big ones
    only, at most total rows / small of them. sizes: {group: (rows, min, max)}.
    Returns {(group..., t): value}."""
    done, state = {}, {}
    for key, rank in targets.items():
        n, lo, hi = sizes[key[:-1]]
        state[key] = (rank, lo, hi, 0, n)  # lo <= answer <= hi, rows below lo, rows inside
    while state:
        for key in [k for k, v in state.items() if v[1] == v[2]]:
            done[key] = state.pop(key)[1]
        if not state:
            break
        rows, place = _brackets({key: v[1:3] for key, v in state.items()})
        inside = _join_targets(vals, rows, keys, True)
        if max(v[4] for v in state.values()) <= small:
            by_value = inside.groupBy(*keys, "_t", "_v").count()
            w = Window.partitionBy(*keys, "_t").orderBy("_v")
            run = by_value.withColumn("_end", F.sum("count").over(w))
            fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vals.schema if f.name in keys)
            want = vals.sparkSession.createDataFrame(
                list({(*place[k], v[0] - v[3]) for k, v in state.items()}), f"{fields}, _t long, _want long")
            cond = run["_t"] == want["_t"]
            for k in keys:
                cond = cond & run[k].eqNullSafe(want[k])
            hit = run.join(F.broadcast(want), cond).filter(
                (F.col("_want") < F.col("_end")) & (F.col("_want") >= F.col("_end") - F.col("count"))
            ).select(*[run[k] for k in keys], run["_t"], "_want", "_v")
            found = {(*[r[k] for k in keys], r["_t"], r["_want"]): r["_v"] for r in hit.collect()}
            for key, v in state.items():
                done[key] = found[(*place[key], v[0] - v[3])]
            break
        probs = [i / _GRID for i in range(_GRID + 1)]
        # the sketch works on doubles: integers are taken from the bracket's lower end
        offset = F.col("_v") - F.col("_lo") if vals.schema["_v"].dataType.typeName() == "long" else F.col("_v")
        grids = inside.groupBy(*keys, "_t").agg(F.percentile_approx(offset, probs, 20000).alias("grid"))
        grids = {(*[r[k] for k in keys], r["_t"]): r.grid for r in grids.collect()}
        fresh = {}
        for key, (rank, lo, hi, below, n) in state.items():
            grid, at = grids[place[key]], (rank - below) / max(1, n - 1) * _GRID
            first, last = grid[max(0, int(at) - 1)], grid[min(_GRID, math.ceil(at) + 1)]
            if isinstance(lo, int):
                first, last = lo + first, lo + last
            fresh[key] = (max(lo, first), min(hi, last))
        rows, place = _brackets(fresh)
        check = _join_targets(vals, rows, keys, False).groupBy(*keys, "_t").agg(
            F.count_if(F.col("_v") < F.col("_lo")).alias("below"), F.count_if(F.col("_v") <= F.col("_lo")).alias("from_lo"),
            F.count_if(F.col("_v") < F.col("_hi")).alias("to_hi"), F.count_if(F.col("_v") <= F.col("_hi")).alias("upto"))
        counts = {(*[r[k] for k in keys], r["_t"]): r for r in check.collect()}
        for key, (lo, hi) in fresh.items():
            r = counts[place[key]]
            rank, plo, phi, pbelow, pn = state[key]
            # a bracket that missed its rank gives way to the rest of its parent
            if rank < r.below:
                state[key] = (rank, plo, _next(lo, -1), pbelow, r.below - pbelow)
            elif rank >= r.upto:
                state[key] = (rank, _next(hi, 1), phi, r.upto, pbelow + pn - r.upto)
            elif rank < r.from_lo:
                state[key] = (rank, lo, lo, r.below, r.from_lo - r.below)
            elif rank >= r.to_hi:
                state[key] = (rank, hi, hi, r.to_hi, r.upto - r.to_hi)
            else:
                state[key] = (rank, _next(lo, 1), _next(hi, -1), r.from_lo, r.to_hi - r.from_lo)
    return done


def _size(vals):
    r = vals.agg(F.count("_v"), F.min("_v"), F.max("_v")).first()
    return r[0], r[1], r[2]


def _ranks_for(n, p):
    at = p * (n - 1)
    k = int(math.floor(at))
    return k, min(k + 1, n - 1), at - k


def _between(a, b, share):
    """The one interpolation of all sizes; works on numbers and on columns."""
    return a + (b - a) * share


def _counted_quantiles(vals, keys, probs):
    """n and q for each small group, from running counts of its values."""
    values = vals.filter("_v is not null").groupBy(*keys, "_v").count()
    run = values.withColumn("_end", F.sum("count").over(Window.partitionBy(*keys).orderBy("_v"))).withColumn(
        "_n", F.sum("count").over(Window.partitionBy(*keys)))
    at = [F.lit(float(p)) * (F.col("_n") - 1) for p in probs]

    def value(rank):
        return F.min(F.when(F.col("_end") > rank, F.col("_v")))

    parts = [(value(F.floor(x)), value(F.least(F.floor(x) + 1, F.col("_n") - 1)), F.first(x - F.floor(x))) for x in at]
    return run.groupBy(*keys).agg(F.first("_n").alias("n"), F.array(*[_between(*x) for x in parts]).alias("q"))


def exact_quantiles(df: DataFrame, value, probs, small: int = SMALL):
    """Linear-interpolated quantiles of one column as Python floats (None if empty)."""
    vals = materialize(_clean(df, value, []), "quantile")
    size = _size(vals)
    n = size[0]
    if n == 0:
        return [None] * len(probs)
    targets = {}
    for i, p in enumerate(probs):
        k, k1, _ = _ranks_for(n, p)
        targets[(0, 2 * i)], targets[(0, 2 * i + 1)] = k, k1
    got = _select_ranks(vals, ["_g0"], targets, small, {(0,): size})
    out = []
    for i, p in enumerate(probs):
        a, b = got[(0, 2 * i)], got[(0, 2 * i + 1)]
        out.append(_between(a, b, _ranks_for(n, p)[2]))
    return out


def low_quantile(df: DataFrame, value, p: float, n: int, small: int = SMALL):
    """Quantile p of n values, of which those above some bound may be null or NaN. None if too few are there."""
    vals = materialize(_clean(df, value, []), "quantile")
    size = _size(vals)
    k, k1, share = _ranks_for(n, p)
    if size[0] <= k1:
        return None
    got = _select_ranks(vals, ["_g0"], {(0, 0): k, (0, 1): k1}, small, {(0,): size})
    return _between(got[(0, 0)], got[(0, 1)], share)


def order_statistic(df: DataFrame, value, rank: int, small: int = SMALL):
    """The value at 0-based rank of the ascending order."""
    vals = materialize(_clean(df, value, [], keep_type=True), "quantile")
    return _select_ranks(vals, ["_g0"], {(0, 0): rank}, small, {(0,): _size(vals)})[(0, 0)]


def grouped_quantiles(df: DataFrame, groups, value, probs, small: int = SMALL) -> DataFrame:
    """One row per group: the group columns, `n`, and `q` ARRAY<DOUBLE>."""
    vals = materialize(_clean(df, value, groups), "quantile")
    keys = _keys(groups)
    names = [F.col(k).alias(g) for k, g in zip(keys, groups)]
    sizes = vals.groupBy(*keys).agg(F.count("_v").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    big = sizes.filter(F.col("n") > small).collect()  # at most rows / small groups
    direct = vals
    if big:
        spark = vals.sparkSession
        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vals.schema if f.name in keys)
        hot = F.broadcast(spark.createDataFrame([tuple(r[k] for k in keys) for r in big], fields))
        cond = None
        for k in keys:
            c = vals[k].eqNullSafe(hot[k])
            cond = c if cond is None else cond & c
        direct = vals.join(hot, cond, "left_anti")
        heavy = vals.join(hot, cond, "left_semi")
    out = _counted_quantiles(direct, keys, probs)
    if big:
        targets = {}
        for r in big:
            g = tuple(r[k] for k in keys)
            for i, p in enumerate(probs):
                k, k1, _ = _ranks_for(r.n, p)
                targets[(*g, 2 * i)], targets[(*g, 2 * i + 1)] = k, k1
        got = _select_ranks(heavy, keys, targets, small, {tuple(r[k] for k in keys): (r.n, r.lo, r.hi) for r in big})
        rows = []
        for r in big:
            g = tuple(r[k] for k in keys)
            q = []
            for i, p in enumerate(probs):
                a, b = got[(*g, 2 * i)], got[(*g, 2 * i + 1)]
                q.append(_between(a, b, _ranks_for(r.n, p)[2]))
            rows.append((*g, r.n, q))
        out = out.unionByName(spark.createDataFrame(rows, f"{fields}, n long, q array<double>"))
    return out.select(*names, "n", "q")


def column_quantiles(df: DataFrame, columns, probs, small: int = SMALL):
    """{column: [quantile, ...]}; all columns share every pass, as groups of one table."""
    number = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").cast("double").alias("v")) for i, c in enumerate(columns)])
    rows = df.select(F.explode(number).alias("x")).select(F.col("x.i").alias("i"), F.col("x.v").alias("v"))
    got = {r["i"]: list(r["q"]) for r in grouped_quantiles(rows, ["i"], "v", probs, small).collect()}
    return {c: got.get(i, [None] * len(probs)) for i, c in enumerate(columns)}
