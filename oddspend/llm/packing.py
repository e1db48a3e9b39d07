"""Best-fit packing planned on a histogram of lengths.

1. Documents become pieces of at most `size` tokens (their ids and an end id). Pieces are
   written once, without ids: key, place, length, checksum.
2. Pieces are counted by length: at most `size` counts, whatever the corpus. Best-fit
   decreasing runs on these counts. Sequences with the same room left are alike, so the
   state is, for each amount of room, ranges of sequence numbers; a length takes ranges
   with the least room that fits, and opens sequences filled with its own kind if none does.
   The plan has a row for each range taken; its size depends on `size`, not on the corpus.
3. Pieces get a rank within their length and take the slot with that rank. A length is split
   into as many salted groups as its count asks for (GROUP pieces each), ranked separately and
   offset by the groups' counts, so a length that a third of all documents have is no single
   task, however many they are.

Null and empty texts are one piece of length 1 (the end id). Repeated rows are packed as
often as they come; ties (pieces alike in everything) may swap places. An empty table gives
an empty result. Other columns of the input are ignored, whatever their names.
"""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from oddspend.llm import tokens
from oddspend.session import materialize

GROUP = 500_000  # pieces of one length that are ranked together, about


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: all of `size` but the first, which has the rest."""
    first = n % size or size
    edges = [0, *range(first, n + 1, size)] if n > size else [0, n]
    return list(zip(edges, np.diff(edges).tolist()))


def pieces(docs: DataFrame, path: str, size: int, end_id: int) -> DataFrame:
    """A row for each piece of each document."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        encode = tokens.ids(path).encode
        for batch in batches:
            rows, keys = [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                data = encode(text) + end
                for j, (start, length) in enumerate(cut(len(data) // 4, size)):
                    keys.append(k)
                    rows.append((j, start, length, zlib.crc32(data[4 * start : 4 * (start + length)])))
            columns = list(zip(*rows)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keys, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.int64())))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def plan(counts: dict[int, int], size: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: (length, first rank, ranks, first sequence, offset)."""
    room: dict[int, list[list[int]]] = defaultdict(list)  # room left: [first sequence, how many]
    slots, opened = [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]

        def place(first: int, n: int, space: int):
            nonlocal rank, left
            slots.append((length, rank, n, first, size - space))
            rank, left = rank + n, left - n
            if space > length:
                room[space - length].append([first, n])

        while left:
            space = min((r for r, ranges in room.items() if r >= length and ranges), default=0)
            if space:
                first, n = room[space].pop()
                if n > left:
                    room[space].append([first + left, n - left])
                place(first, min(n, left), space)
            else:  # sequences of this length alone, and one for what does not fill a sequence
                fit = size // length
                n = left // fit or 1
                for k in range(min(fit, left)):
                    place(opened, n, size - k * length)
                    if k:
                        _take(room, size - k * length, opened, n)
                opened += n
    return slots


def _take(room: dict, space: int, first: int, n: int) -> None:
    """Removes a range that was put back with `space` left while its sequences were being filled."""
    room[space].remove([first, n])


def pack(docs: DataFrame, path: str, size: int = 2048, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for each piece."""
    spark = docs.sparkSession
    table = materialize(pieces(docs, path, size, end_id), "pieces")
    counts = {r["length"]: r["n"] for r in table.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `size` rows
    slots = spark.createDataFrame(plan(counts, size), "length bigint, first_rank bigint, ranks bigint, first_sequence bigint, offset bigint")
    dealt = spark.createDataFrame([(k, -(-n // GROUP)) for k, n in counts.items()], "length bigint, salts bigint")
    salt = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("salts")).alias("salt")
    table = table.join(F.broadcast(dealt), "length").select(*table.columns, salt)
    groups = table.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1))
    offsets = groups.select("length", "salt", F.coalesce(before, F.lit(0)).alias("before"))
    rank = F.row_number().over(W.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = table.withColumn("rank", rank).join(offsets, ["length", "salt"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before"))
    fits = (ranked["length"] == slots["length"]) & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("first_rank") + F.col("ranks"))
    return ranked.join(F.broadcast(slots), fits).select(
        "doc_id", "piece", "start", ranked["length"], "ids_crc32",
        (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id"), "offset",
    )
