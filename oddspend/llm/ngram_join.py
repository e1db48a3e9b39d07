"""N-gram Jaccard join by MinHash banding.

1. Every document becomes the set of its word n-grams (5 words; a shorter text is one
   n-gram), as 64-bit hashes. Documents with one set are one class; classes are compared, not
   documents.
2. The MinHash signature of a class is cut into bands; the numbers of bands and rows are
   chosen for the wanted recall at the threshold. Classes that agree in a band share a bucket.
3. Buckets with the same members (told by their number and two xors of hashes, partial
   aggregates) are reduced to the first band of them. Buckets are cut into blocks, and each
   pair of blocks is one task group: however many classes agree, no group is unbounded and no
   pair is ever a row. A group compares the full sets and emits, for each class, how many
   documents it links to and the smallest class it is connected with inside the group. A pair
   counts only in the first band in which it agrees, so it counts once.
4. Links are summed; connected components of what the groups emitted give the groups of near
   duplicates.

Nothing is capped: recall is that of the banding at the threshold, and higher above it.

Null texts and texts without a word have no set: they are classes of their own, with no
links. Rows with one id and one text count as often as they come. Null ids are ids like any
other. Extra columns are ignored (`links`) or kept (`drop_near_copies`); an empty table gives
an empty result.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from oddspend.functions.lookup import lookup_join
from oddspend.llm import shingles
from oddspend.llm.components import components
from oddspend.session import materialize

BLOCK = 256  # classes to a block
COLUMNS = 4096  # n-grams compared at a time
NO_ID = -(1 << 63)


def signatures(docs: DataFrame, n: int, bands: int, rows: int, key: str, text: str) -> DataFrame:
    """id, hash (of the text), sig (names the n-gram set, null if empty), bands."""
    def run(batches):
        for batch in batches:
            sigs, all_bands = [], []
            for t in batch.column(2).to_pylist():
                found = shingles.shingles(t, n)
                sigs.append(shingles.set_key(found) if len(found) else None)
                all_bands.append(shingles.band_hashes(found, bands, rows) if len(found) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sigs, pa.binary()), pa.array(all_bands, pa.list_(pa.int64()))], names=["id", "hash", "sig", "bands"])

    return _named(docs, key, text).mapInArrow(run, "id bigint, hash bigint, sig binary, bands array<bigint>")


def _named(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(key).cast("bigint"), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))


def sets_of(docs: DataFrame, wanted: DataFrame, n: int, key: str, text: str) -> DataFrame:
    """sig, grams for each row (id, hash, sig) of wanted."""
    def run(batches):
        for batch in batches:
            found = [shingles.shingles(t, n).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["sig", "grams"])

    rows = _named(docs, key, text).join(wanted, ["id", "hash"])
    return rows.select("sig", "text").mapInArrow(run, "sig binary, grams binary").dropDuplicates(["sig"])


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set of left with each of right."""
    both = left + right
    sizes = np.array([len(x) for x in both])
    _, place = np.unique(np.concatenate(both), return_inverse=True)
    owner, order = np.repeat(np.arange(len(both)), sizes), np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    out = np.zeros((len(left), len(right)), np.float64)
    edges = np.searchsorted(place, np.arange(0, (place[-1] if len(place) else 0) + COLUMNS + 1, COLUMNS))
    for a, b in zip(edges[:-1], edges[1:]):
        part = np.zeros((len(both), COLUMNS), np.float32)
        part[owner[a:b], place[a:b] % COLUMNS] = 1
        out += part[: len(left)] @ part[len(left) :].T
    return out


def compare(key: tuple, group: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links inside a pair of blocks: sig, root, links."""
    band, _, i, j = key
    group = group.sort_values("sig", ignore_index=True)
    sets = [np.frombuffer(x, np.uint64) for x in group["grams"]]
    bands = np.stack([np.asarray(x) for x in group["bands"]])
    blocks = group["block"].to_numpy()
    a, b = np.flatnonzero(blocks == i), np.flatnonzero(blocks == j)
    if not len(a) or not len(b):
        return pd.DataFrame({"sig": [], "root": [], "links": []})
    shared = overlaps([sets[k] for k in a], [sets[k] for k in b])
    sizes = np.array([len(x) for x in sets], np.float64)
    linked = shared / (sizes[a][:, None] + sizes[b][None, :] - shared) >= threshold
    agree = bands[a][:, None, :] == bands[b][None, :, :]
    linked &= agree[:, :, band] & ~agree[:, :, :band].any(axis=2)
    if i == j:
        np.fill_diagonal(linked, False)
    copies, n = group["copies"].to_numpy(), len(group)
    links, near = np.zeros(n, np.int64), np.zeros((n, n), bool)
    np.add.at(links, a, linked @ copies[b])
    near[np.ix_(a, b)] = linked
    if i != j:
        np.add.at(links, b, linked.T @ copies[a])
    near |= near.T
    root = np.full(n, -1)
    for k in np.flatnonzero(links):
        if root[k] < 0:
            reached = np.zeros(n, bool)
            front = np.zeros(n, bool)
            front[k] = True
            while front.any():
                reached |= front
                front = near[front].any(axis=0) & ~reached
            root[reached] = k  # rows are sorted: k is the smallest
    some = np.flatnonzero(links)
    return pd.DataFrame({"sig": group["sig"].to_numpy()[some], "root": group["sig"].to_numpy()[root[some]], "links": links[some]})


def links(docs: DataFrame, threshold: float = 0.8, n: int = 5, recall: float = 0.999, most_hashes: int = 256, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id, hash, sig, class_id, group_id, copies, n_links for each row of docs.

    class_id: smallest id with the same n-grams; group_id: smallest id connected by links;
    copies: rows of the class; n_links: other rows at the threshold or above, copies included."""
    count, rows = shingles.choose_bands(threshold, recall, most_hashes)
    signed = materialize(signatures(docs, n, count, rows, key, text), "signatures")
    classes = signed.filter(F.col("sig").isNotNull()).groupBy("sig").agg(
        F.min(F.struct("id", "hash")).alias("first"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands")
    )
    classes = materialize(classes, "classes")
    members = classes.select("sig", F.posexplode("bands").alias("band", "h"))
    buckets = members.groupBy("band", "h").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("sig")).alias("x"), F.bit_xor(F.xxhash64("sig", F.lit(1))).alias("y"))
    buckets = buckets.filter("n > 1").groupBy("n", "x", "y").agg(F.min(F.struct("band", "h")).alias("b")).select("n", "b.*")
    members = materialize(members.join(buckets, ["band", "h"]), "bucket_members")
    wanted = classes.join(members.select("sig").distinct(), "sig", "left_semi").select("first.*", "sig", "bands", "copies")
    grams = sets_of(docs, wanted.select("id", "hash", "sig"), n, key, text).join(wanted.select("sig", "bands", "copies"), "sig")
    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    dealt = members.withColumn("block", F.pmod(F.xxhash64("sig", F.lit(2)), blocks).cast("int"))
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    dealt = dealt.select("sig", "band", "h", "block", other.alias("o"))
    dealt = dealt.select("sig", "band", "h", "block", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"))
    found = dealt.join(materialize(grams, "grams"), "sig").groupBy("band", "h", "i", "j").applyInPandas(
        lambda k, g: compare(k, g, threshold), "sig binary, root binary, links bigint"
    )
    found = materialize(found, "block_links")
    summed = found.groupBy("sig").agg(F.sum("links").alias("links"))
    labels = components(found.filter("sig != root").select(F.col("sig").alias("a"), F.col("root").alias("b")))
    known = classes.select("sig", "first", "copies").join(summed, "sig", "left").filter("copies > 1 or links is not null")
    known = known.join(labels.withColumnRenamed("node", "sig"), "sig", "left").withColumn("label", F.coalesce("label", "sig"))
    heads = known.groupBy("label").agg(F.min("first").alias("head"))
    known = known.join(heads, "label").select("sig", F.col("first.id").alias("class_id"), "head", "copies", F.coalesce("links", F.lit(0)).alias("links"))
    known = materialize(known, "linked_classes")
    return _look_up(signed, known)


def _look_up(signed: DataFrame, known: DataFrame) -> DataFrame:
    table = known.withColumn("rows", F.col("copies"))
    out = lookup_join(signed.select("id", "hash", "sig"), table, "sig", known.count(), "rows", "id", broadcast_keys=100_000)
    mine = F.col("class_id").isNull()
    return out.select(
        "id", "hash", "sig",
        F.when(mine, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(mine, F.struct("id", "hash")).otherwise(F.col("head")).alias("head"),
        F.coalesce("copies", F.lit(1)).alias("copies"),
        F.when(mine, 0).otherwise(F.col("links") + F.col("copies") - 1).cast("bigint").alias("n_links"),
    )


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """docs with one row of each group: of the smallest id, once if that row is repeated."""
    names = docs.columns
    own = lambda base: base if base not in names else own(base + "_")
    ident, body, drop, again = own("_id"), own("_hash"), own("_drop"), own("_again")
    found = links(docs, key=key, text=text, **options).filter("n_links > 0")
    head = (F.col("id") == F.col("head.id")) & (F.col("hash") == F.col("head.hash"))
    found = found.groupBy("id", "hash").agg(F.first(~head).alias(drop), (F.count(F.lit(1)) > 1).alias(again))
    found = found.select(F.col("id").alias(own("_id2")), F.col("hash").alias(own("_hash2")), drop, again)
    rows = docs.withColumn(ident, F.coalesce(F.col(key).cast("bigint"), F.lit(NO_ID))).withColumn(body, F.xxhash64(text))
    rows = rows.join(found, (F.col(ident) == F.col(own("_id2"))) & (F.col(body) == F.col(own("_hash2"))), "left")
    rows = rows.filter(~F.coalesce(drop, F.lit(False)))
    repeated = F.coalesce(again, F.lit(False))
    once = rows.filter(~repeated).unionByName(rows.filter(repeated).dropDuplicates([ident, body]))
    return once.select(*[f"`{c}`" for c in names])
