"""Why a row was flagged, and which inputs drive a model."""

from pyspark.sql import DataFrame, functions as F

from oddspend import schema as S
from oddspend.functions.running import running_totals
from oddspend.functions.sampling import take_fixed
from oddspend.session import materialize


def base_feature(col):
    return F.regexp_replace(col, "_(scaled|freq)$", "")


def describe(col, default_to_name=True):
    """Wording of a base feature; unknown names stay as they are (or become '')."""
    m = F.create_map(*[x for k, v in S.DESCRIPTIONS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, col), col if default_to_name else F.lit(""))


def reference_stats(ref: DataFrame, columns):
    """{column: (mean, population std or 1)} of the reference rows."""
    row = ref.agg(*[f(F.col(f"`{c}`").cast("double")).alias(f"_{i}_{j}") for i, c in enumerate(columns)
                    for j, f in enumerate((F.avg, F.stddev_pop))]).first()
    out = {}
    for i, c in enumerate(columns):
        m, s = float(row[2 * i] or 0.0), float(row[2 * i + 1] or 0.0)
        out[c] = (m, s if s >= 1e-9 else 1.0)
    return out


def _ranked(stats, top_n):
    """Array of the top_n structs by |z|, built and sorted inside the row."""
    items = []
    for pos, (c, (m, s)) in enumerate(stats.items()):
        v = F.col(f"`{c}`").cast("double")
        z = (v - F.lit(m)) / F.lit(s)
        items.append(F.struct((-F.abs(z)).alias("neg"), F.lit(pos).alias("pos"), F.lit(c).alias("feature"),
                              F.round(z, 3).alias("z_score"), F.round(v, 4).alias("value"),
                              F.round(F.lit(m), 4).alias("reference_mean")))
    return F.slice(F.sort_array(F.array(*items)), 1, top_n)


def explain_rows(rows: DataFrame, stats, top_n: int = 5, row_id: str = S.ROW_ID) -> DataFrame:
    """(row_id, rank, feature, z_score, value, reference_mean, description) of the
    most deviant inputs of every given row. Row-local: nothing is shuffled."""
    top = rows.select(row_id, F.posexplode(_ranked(stats, top_n)).alias("_i", "t"))
    return top.select(row_id, (F.col("_i") + 1).cast("long").alias("rank"), "t.feature", "t.z_score", "t.value",
                      "t.reference_mean", describe(base_feature(F.col("t.feature"))).alias("description"))


def explain_text(rows: DataFrame, stats, row_id: str = S.ROW_ID) -> DataFrame:
    """(row_id, explanation): one sentence on the three most deviant inputs."""
    def clause(t):
        side = F.when(t["z_score"] > 0, "far above normal").otherwise("far below normal")
        return F.concat(describe(base_feature(t["feature"])), F.lit(" ("), side, F.lit(", z="),
                        F.format_string("%+.2f", t["z_score"]), F.lit(")"))

    text = F.array_join(F.transform(_ranked(stats, 3), clause), "; ")
    return rows.select(row_id, F.concat(F.lit("Flagged mainly for: "), text, F.lit(".")).alias("explanation"))


def permutation_importance(df: DataFrame, names, score, row_id: str = S.ROW_ID, n_repeats: int = 5,
                           sample_size: int | None = None, seed: int = 42, effects=None) -> DataFrame:
    """Mean |score change| when one input is shuffled among all rows (or, if the caller
    gives sample_size, among so many).

    score maps a frame with `features` to the frame plus `anomaly_score`. Rows are
    numbered once. Each repeat pairs row k with row (a k + b) mod n, a and n coprime: a
    permutation that is a join on row numbers, so no window holds the rows of a run. All
    inputs of a repeat take their values from the same partner, one input at a time, inside
    the task that scores them: rows move once a repeat, not once an input and repeat.

    effects, if a model has it (IsolationForest.swap_effects), is a function of the columns
    (features, partner's features) that gives the score changes of all inputs at once; then no
    swapped row is made."""
    import math
    import random

    rows = df.select(row_id, "features")
    rows = rows if sample_size is None else take_fixed(rows, sample_size, row_id, seed)
    rows = running_totals(rows.withColumn("_one", F.lit(1)).withColumn("_all", F.lit(0)), ["_all"], row_id, ["_one"])
    rows = materialize(rows.select(row_id, "features", (F.col("cum__one") - 1).cast("long").alias("_k")), "ranked")
    n, rng, d = rows.count(), random.Random(seed), len(names)
    shifts = []
    for r in range(n_repeats):
        a = rng.randrange(1, max(2, n))
        while math.gcd(a, max(n, 1)) != 1:
            a = rng.randrange(1, max(2, n))
        shifts.append(F.struct(F.lit(r).alias("r"), F.lit(a).cast("long").alias("a"), F.lit(rng.randrange(max(1, n))).cast("long").alias("b")))
    own = rows
    if effects is None:
        base = materialize(score(rows).select("_k", F.col("anomaly_score").alias("_base")), "base_scores")
        own = rows.join(base, "_k")
    runs = own.withColumn("_s", F.explode(F.array(*shifts))).withColumn("_r", F.col("_s.r"))
    # exact products: row numbers may have more than 31 bits
    target = ((F.col("_s.a").cast("decimal(19,0)") * F.col("_k") + F.col("_s.b")) % F.lit(max(n, 1))).cast("long")
    moved = rows.select(F.col("_k").alias("_from"), F.col("features").alias("_other"))
    pairs = runs.withColumn("_from", target).join(moved, "_from")
    if effects is None:
        per_run = _rescored(pairs, score, d)
    else:
        changes = pairs.select("_r", effects("features", "_other").alias("_c"))
        means = changes.groupBy("_r").agg(F.array(*[F.avg(F.get("_c", F.lit(j))) for j in range(d)]).alias("_m"))
        per_run = means.select(F.posexplode("_m").alias("_j", "_d"))
    feature = F.get(F.array(*[F.lit(c) for c in names]), F.col("_j"))
    return per_run.groupBy("_j").agg(F.avg("_d").alias("importance")).select(
        feature.alias("feature"), "importance", base_feature(feature).alias("base_feature"),
        describe(base_feature(feature), False).alias("description")).orderBy(F.col("importance").desc(), "feature")


def _rescored(pairs: DataFrame, score, d: int) -> DataFrame:
    """(_j, _r, _d): mean |score change| of a repeat, from a row for every input that is scored anew."""
    shuffled = pairs.select("_r", "_base", "features", "_other").withColumn("_j", F.explode(F.sequence(F.lit(0), F.lit(d - 1)))).withColumn("_new", F.get("_other", F.col("_j")))
    shuffled = shuffled.withColumn("features", F.transform("features", lambda x, i: F.when(i == F.col("_j"), F.col("_new")).otherwise(x)))
    delta = score(shuffled.select("_j", "_r", "_base", "features"))
    return delta.groupBy("_j", "_r").agg(F.avg(F.abs(F.col("anomaly_score") - F.col("_base"))).alias("_d"))


def reconstruction_breakdown(errors: DataFrame, names, top_n: int = 5, row_id: str = S.ROW_ID) -> DataFrame:
    """Inputs an autoencoder rebuilt worst, per row. errors has (row_id, feature_errors)."""
    items = F.transform("feature_errors", lambda e, i: F.struct((-e).alias("neg"), i.alias("pos"), e.alias("error")))
    feature = F.get(F.array(*[F.lit(c) for c in names]), F.col("t.pos"))
    total = F.aggregate("feature_errors", F.lit(0.0), lambda a, x: a + x)
    top = errors.select(row_id, total.alias("total_error"), F.posexplode(F.slice(F.sort_array(items), 1, top_n)).alias("_i", "t"))
    return top.select(row_id, (F.col("_i") + 1).cast("long").alias("rank"), feature.alias("feature"),
                      F.round("t.error", 6).alias("reconstruction_error"), "total_error",
                      describe(base_feature(feature)).alias("description"))


def reconstruction_text(errors: DataFrame, names, row_id: str = S.ROW_ID) -> DataFrame:
    top = reconstruction_breakdown(errors, names, 3, row_id)
    said = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "description"))), lambda t: t["description"]), "; ")
    return top.groupBy(row_id).agg(F.concat(F.lit("Hardest to rebuild: "), said, F.lit(".")).alias("explanation"))
