"""Divergence audit of sources by a sparse merge for each pair of them.

Terms are counted per (lang, source) group; a language keeps the terms that at least
`min_docs` of its documents have. Each kept term gets the share of a group in parts of SCALE,
smoothed so that absent terms have one too, and two shares p and q differ by
floor((p - q)^2 / (p + q)). The difference of two sources is the sum over all kept terms.

Kept terms get rising ids, dealt into blocks of BLOCK ids, and a group becomes sorted
(term id, count) arrays, one for each block that it has terms in. Every unordered pair of
sources is a task per block: the two arrays meet in an outer join, a galloping intersection
finds the overlap, and overlapping and one-sided terms are priced both ways. Terms that both
lack all have one price, so a block only reports by how much its terms differ from that, and
the number of kept terms settles the rest.

Counting combines on the map side, within a bounded number of terms, so a source that has a
third of all rows sends no more than its terms per task; a group's size never matters later
because its arrays are cut by block. The result itself has a row for each ordered pair.

Null texts, languages and sources count as empty. Each row is a document, repeated or not.
Long texts are cut between terms, PIECE bytes at a time. Ties are ranked by the item's UTF-8
bytes. A language without kept terms has pairs of value 0; an empty table gives no rows. Other
columns are ignored, whatever their names. Counts may add up to 9 * 10^15 for exact results.
"""

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from oddspend.functions.lookup import lookup_join
from oddspend.session import materialize

SCALE = 1_000_000_000
BLOCK_BITS = 12  # ids of a block
PIECE = 1 << 20  # bytes of a text that are cut at a time
HELD = 400_000  # terms that a counting task holds before it sends them on

#: Letters stay, capitals of ASCII are lowered, everything else in ASCII parts terms.
_FOLD = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def term_lists(data: bytes):
    """The terms of a text as UTF-8, in lists of about PIECE bytes."""
    start, n = 0, len(data)
    while start < n:
        folded = data[start : start + PIECE].translate(_FOLD)
        rest = start + PIECE
        while rest < n and folded[-1] != 32:  # finish the last term
            more = data[rest : rest + PIECE].translate(_FOLD)
            cut = more.find(b" ")
            folded, rest = folded + (more if cut < 0 else more[: cut + 1]), rest + (len(more) if cut < 0 else cut + 1)
        yield folded.split()
        start = rest


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term (UTF-8), n, docs; a row with an empty term stands for the group itself."""

    def run(batches):
        groups, held = {}, 0

        def sent():
            for (lang, source), (n, in_docs) in groups.items():
                terms = list(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()), pa.array(terms, pa.binary()),
                     pa.array(n.values(), pa.int64()), pa.array([in_docs[t] for t in terms], pa.int64())],
                    names=["lang", "source", "term", "n", "docs"],
                )
            groups.clear()

        for batch in batches:
            for lang, source, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if (lang, source) not in groups:
                    groups[lang, source] = (Counter({b"": 0}), Counter())
                n, in_docs = groups[lang, source]
                before, seen = len(n), set()
                for terms in term_lists(data):
                    n.update(terms)
                    seen.update(terms)
                in_docs.update(seen)
                held += len(n) - before
                if held > HELD:
                    yield from sent()
                    held = 0
        yield from sent()

    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(text("lang").alias("lang"), text("source").alias("source"), text("text").cast("binary").alias("text"))
    parts = rows.mapInArrow(run, "lang string, source string, term binary, n bigint, docs bigint")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count, total, terms) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)), exactly."""
    wide = lambda c: F.expr(f"cast({c} as decimal(19, 0))")
    return F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (wide(count) + 2), wide(total) + 2 * wide(terms)) + 1


def difference(p, q) -> Column:
    return F.call_function("div", (F.col(p) - F.col(q)) * (F.col(p) - F.col(q)), F.col(p) + F.col(q))


def _shares(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """`share` over an array: a long division, three digits at a time, that stays within 64 bits."""
    by = total + 2 * terms
    out, left = np.divmod(counts + 2, by)
    for _ in range(3):
        digits, left = np.divmod(left * 1000, by)
        out = out * 1000 + digits
    return out + 1


def _differences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def gallop(few: np.ndarray, many: np.ndarray, run: int = 64) -> np.ndarray:
    """The place in `many` of each element of `few`, -1 where it is absent; both are sorted. From
    where the last run ended, steps double until they pass the run; a binary search inside them
    places its elements."""
    out = np.full(len(few), -1, dtype=np.int64)
    low = 0
    for k in range(0, len(few), run):
        part = few[k : k + run]
        step = 1
        while low + step < len(many) and many[low + step] < part[-1]:
            step *= 2
        at = low + np.searchsorted(many[low : low + step + 1], part)
        inside = at < len(many)
        hit = np.zeros(len(part), dtype=bool)
        hit[inside] = many[at[inside]] == part[inside]
        out[k : k + run][hit] = at[hit]
        low = int(at[-1])
    return out


def merge(a, b, terms: int) -> int:
    """By how much the terms of two arrays differ from as many terms that both lack.
    a and b: (sorted ids, counts, total of the group)."""
    if len(a[0]) > len(b[0]):
        a, b = b, a
    (ids, n, total), (other_ids, other_n, other_total) = a, b
    zero = np.zeros(1, dtype=np.int64)
    p0, q0 = _shares(zero, total, terms), _shares(zero, other_total, terms)
    p, q = _shares(n, total, terms), _shares(other_n, other_total, terms)
    at = gallop(ids, other_ids)
    both = at >= 0
    alone = np.ones(len(other_ids), dtype=bool)
    alone[at[both]] = False
    found = _differences(p[both], q[at[both]]).sum() + _differences(p[~both], q0).sum() + _differences(p0, q[alone]).sum()
    return int(found) - (len(ids) + int(alone.sum())) * int(_differences(p0, q0)[0])


def _merged(batches):
    def array(column, k, kind):
        got = column[k]
        return got.values.field(kind).to_numpy() if got.is_valid else np.empty(0, dtype=np.int64)

    for batch in batches:
        totals_a, totals_b, terms, left, right = (batch.column(k) for k in range(3, 8))
        found = [
            merge((array(left, k, "id"), array(left, k, "n"), totals_a[k].as_py()), (array(right, k, "id"), array(right, k, "n"), totals_b[k].as_py()), terms[k].as_py())
            for k in range(batch.num_rows)
        ]
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), pa.array(found, pa.int64())], names=["lang", "a", "b", "part"])


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank. Part `pair`: the difference to each other source of
    the language. Part `term`: the `top` terms that the source has more of than its language."""
    counts = materialize(term_counts(docs), "term_counts")
    kept = counts.filter(F.length("term") > 0).groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all_n")).filter(F.col("docs") >= min_docs)
    # sorted over the whole cluster, so ids rise with the terms and are dense within a task
    kept = kept.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term").withColumn("id", F.monotonically_increasing_id())
    kept = materialize(kept.select("lang", "term", "id", "all_n"), "kept_terms")
    rows = materialize(counts.join(kept, ["lang", "term"]).select("lang", "source", "id", "term", "n", "all_n"), "kept_counts")

    groups = counts.filter(F.length("term") == 0).select("lang", "source", F.lit(0).cast("bigint").alias("n")).unionByName(rows.select("lang", "source", "n"))
    groups = groups.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("all_n").alias("lang_total"))
    groups = groups.join(langs, "lang", "left").fillna(0, ["terms", "lang_total"])
    groups = materialize(groups, "groups")
    return _pairs(rows, groups).unionByName(_terms(rows, groups, top))


def _terms(rows: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    of = groups.select(F.struct("lang", "source").alias("group"), "total", "terms", "lang_total", F.col("total").alias("weight"))
    priced = lookup_join(rows.withColumn("group", F.struct("lang", "source")), of, "group", groups.count(), "weight", "id")
    found = priced.withColumn("p", share("n", "total", "terms")).withColumn("q", share("all_n", "lang_total", "terms")).filter("p > q")
    found = found.withColumn("value", difference("p", "q"))
    order = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "term")
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return found.select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), "value", "rank")


def _pairs(rows: DataFrame, groups: DataFrame) -> DataFrame:
    side = lambda s: groups.select("lang", "terms", F.col("source").alias(s), F.col("total").alias(f"total_{s}"))
    pairs = side("a").join(side("b").drop("terms"), "lang").filter("a < b")
    blocks = rows.groupBy("lang", "source", F.shiftright("id", BLOCK_BITS).alias("block"))
    blocks = materialize(blocks.agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("array")), "term_arrays")
    of = lambda s: blocks.withColumnRenamed("source", s).join(pairs, ["lang", s])
    both = of("a").alias("x").join(of("b").alias("y"), ["lang", "a", "b", "block"], "full")
    one = lambda c: F.coalesce(f"x.{c}", f"y.{c}").alias(c)
    both = both.select("lang", "a", "b", one("total_a"), one("total_b"), one("terms"), F.col("x.array").alias("left"), F.col("y.array").alias("right"))
    parts = both.mapInArrow(_merged, "lang string, a string, b string, part bigint").groupBy("lang", "a", "b").agg(F.sum("part").alias("part"))
    absent = pairs.filter("terms > 0").withColumn("zero", F.lit(0)).withColumn("p", share("zero", "total_a", "terms")).withColumn("q", share("zero", "total_b", "terms"))
    absent = absent.select("lang", "a", "b", (F.col("terms") * difference("p", "q")).alias("absent"))
    found = pairs.select("lang", "a", "b").join(absent, ["lang", "a", "b"], "left").join(parts, ["lang", "a", "b"], "left")
    found = found.withColumn("value", F.coalesce("absent", F.lit(0)) + F.coalesce("part", F.lit(0)))
    ways = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    found = found.select("lang", "value", F.explode(ways).alias("way")).select("lang", "way.source", F.lit("pair").alias("part"), "way.item", "value")
    return found.withColumn("rank", F.row_number().over(W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")))
