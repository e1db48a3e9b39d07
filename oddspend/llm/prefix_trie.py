"""Trie of conversation prefixes, finished in sorted shards around a skeleton of splitters.

A conversation is a path of turn digests (128 bits of SHA-256 over role and text); each
distinct prefix is a node. Paths are range-partitioned by (path, conv_id), so a shard holds
neighbours of the sorted order and copies of one conversation spread over as many shards as
they fill. The first paths of the shards are the splitters. A node whose members lie in
several shards is a prefix of a splitter: the trie of the splitter paths is the skeleton. It
is broadcast; every shard runs through its paths once, with a stack as deep as one path,
finishes all nodes off the skeleton, and sends one partial aggregate for each node on it.
Partial aggregates are reduced by key, and the skeleton (at most shards x (SEGMENT + 1)
nodes) is summed up from its ends.

Long conversations are cut into segments of SEGMENT turns, so a path has a bounded size. A
segment's paths start with the key of the prefix before it. Conversations that share their
prefix with no other one have only nodes of their own from there on, which are made row by
row; the others meet in the next segment. Segments are finished last to first, and each hands
what hangs below its roots to the one before. Only conversations that agree in whole segments
make a further round, and a conversation that holds a third of all turns is no single task.

Turns of one conversation are ordered by turn (null first), then role and text; repeated rows
are turns of their own; null roles and texts count as empty. Rows without conv_id belong to no
conversation and take no part. Other columns are ignored, whatever their names. An empty table
has no nodes, not even a root. The ids of the members that end at one node are streamed through
one digest, in chunks: SHA-256 has no other way.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from oddspend.functions.lookup import lookup_join
from oddspend.session import materialize

SEGMENT = 512  # turns of a path
CHUNK = 1 << 16  # bytes of ids that a row carries to the digest of a skeleton node
ROWS = 8192  # rows of a batch that a task sends
NODE = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
NOTHING = hashlib.sha256().hexdigest()
_DONE, _PART, _IDS, _ROOT = range(4)  # kinds of rows that a shard sends

_SENT = pa.schema([
    ("kind", pa.int8()), ("key", pa.binary()), ("parent_key", pa.binary()), ("shard", pa.int32()), ("chunk", pa.int32()), ("ids", pa.binary()),
    ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
    ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("size", pa.int64()),
    ("below_children", pa.int64()), ("below_leaves", pa.int64()), ("below_saved", pa.int64()),
])
_SENT_TYPES = ", ".join(f"{f.name} {dict(int8='tinyint', int32='int', int64='bigint', binary='binary', string='string')[str(f.type)]}" for f in _SENT)


def number_turns(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, d, a, b, size) with the place of each turn, its digest and the bytes of its
    text; (conv_id, n) with the turns of each conversation. One range shuffle of the rows;
    places of conversations that cross a task's edge are mended with one number per task."""

    def run(batches):
        now, k = None, 0
        for batch in batches:
            convs = batch.column(0).to_numpy()
            roles, texts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            digests = b"".join([hashlib.sha256(b"%d:" % len(r) + r + t).digest()[:16] for r, t in zip(roles, texts)])
            places = np.empty(len(convs), dtype=np.int64)
            for i, c in enumerate(convs.tolist()):
                now, k = (now, k + 1) if c == now else (c, 1)
                places[i] = k
            pairs = np.frombuffer(digests, dtype="<i8").reshape(-1, 2)
            sizes = [len(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(3), pa.array(places), pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(sizes, pa.int64())],
                names=["conv_id", "task", "k", "a", "b", "size"],
            )

    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    turns = rows.select(F.col("conv_id").cast("bigint"), "turn", text("role"), text("text")).filter("conv_id IS NOT NULL")
    order = ["conv_id", "turn", "role", "text"]
    turns = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    turns = turns.select("conv_id", F.col("role").cast("binary"), F.col("text").cast("binary"), F.spark_partition_id().alias("task"))
    turns = materialize(turns.mapInArrow(run, "conv_id bigint, task int, k bigint, a bigint, b bigint, size bigint"), "turn_digests")
    counts = materialize(turns.groupBy("task", "conv_id").agg(F.count(F.lit(1)).alias("n")), "turn_counts")
    # at most one conversation enters a task from the one before: one row per task
    entering = counts.groupBy("task").agg(F.min("conv_id").alias("conv_id")).select("conv_id").distinct()
    earlier = W.partitionBy("conv_id").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    edges = counts.join(F.broadcast(entering), "conv_id").select("task", "conv_id", F.sum("n").over(earlier).alias("before")).filter("before > 0")
    turns = turns.join(F.broadcast(edges), ["task", "conv_id"], "left")
    turns = turns.select("conv_id", (F.col("k") + F.coalesce("before", F.lit(0))).alias("d"), "a", "b", "size")
    return turns, materialize(counts.groupBy("conv_id").agg(F.sum("n").alias("n")), "conversations")


def share_heads(turns: DataFrame, convs: DataFrame, family: int = 5, most: int = 8) -> tuple[DataFrame, DataFrame]:
    """Numbered turns in which conversation c starts with the first h turns of conversation
    c - c % family (all if it has fewer, none if it is absent), then has its own turns after its
    first h; h = crc32(decimal c) % (most + 1)."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).alias("h")
    base = (F.col("conv_id") - F.col("conv_id") % family).alias("base")
    heads = convs.select("conv_id", "n", h, base).join(convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n")), "base", "left")
    heads = heads.withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0)))).withColumn("weight", F.col("n"))
    heads = materialize(heads, "shared_heads")
    own = lookup_join(turns, heads.select("conv_id", "h", "taken", "weight"), "conv_id", heads.count(), "weight", "d")
    own = own.filter("d > h").select("conv_id", (F.col("d") - F.col("h") + F.col("taken")).alias("d"), "a", "b", "size")
    shared = turns.filter((F.col("d") <= most) & (F.col("conv_id") % family == 0)).withColumnRenamed("conv_id", "base")
    shared = shared.join(heads.select("conv_id", "base", "h"), "base").filter("d <= h").select("conv_id", "d", "a", "b", "size")
    lengths = heads.select("conv_id", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n"))
    return own.unionByName(shared), lengths


class _Node:
    __slots__ = ("symbol", "size", "low", "high", "key", "n", "least", "children", "leaves", "saved", "ends", "held", "chunk", "waiting", "below")

    def __init__(self, symbol, size, low, high, key):
        self.symbol, self.size, self.low, self.high, self.key = symbol, size, low, high, key
        self.n = self.children = self.leaves = self.saved = self.chunk = self.held = 0
        self.least, self.ends, self.below, self.waiting = None, None, (0, 0, 0), []


class _Shard:
    """Runs through the sorted paths of one shard; `sent` collects the rows it gives."""

    def __init__(self, number: int, low: list, high: list, first_depth: int):
        self.number, self.low, self.high, self.first_depth = number, low, high, first_depth
        self.stack: list[_Node] = []
        self.sent: list[tuple] = []

    def add(self, conv: int, path: list, sizes: list, below: tuple) -> None:
        stack, shared = self.stack, 0
        for node, symbol in zip(stack, path):
            if node.symbol != symbol:
                break
            shared += 1
        while len(stack) > shared:
            self.close()
        for j in range(shared, len(path)):
            up, symbol = stack[-1] if stack else None, path[j]
            low = (up is None or up.low) and j < len(self.low) and self.low[j] == symbol
            high = (up is None or up.high) and j < len(self.high) and self.high[j] == symbol
            key = None
            if low or high:
                key = symbol if up is None else hashlib.sha256(up.key + symbol).digest()[:16]
            stack.append(_Node(symbol, sizes[j] if j else 0, low, high, key))
        node = stack[-1]
        node.n += 1
        node.least = conv if node.least is None else min(node.least, conv)
        if below is None:  # it ends here
            text = b"%d" % conv
            if node.key is None:
                if node.ends is None:
                    node.ends = hashlib.sha256(text)
                else:
                    node.ends.update(b"," + text)
            else:
                node.ends = node.ends or []
                node.ends.append(text)
                node.held += len(text) + 1
                if node.held > CHUNK:
                    self.send_ids(node)
        else:
            node.below = below

    def send_ids(self, node: _Node) -> None:
        self.sent.append((_IDS, node.key, None, self.number, node.chunk, b",".join(node.ends), *[None] * 12))
        node.ends, node.held, node.chunk = None, 0, node.chunk + 1

    def close(self) -> None:
        node = self.stack.pop()
        up = self.stack[-1] if self.stack else None
        depth = self.first_depth + len(self.stack)
        if node.key is not None:
            if node.ends:
                self.send_ids(node)
            self.sent.append((_PART, node.key, up.key if up else None, self.number, None, None, node.least, depth, None, node.n, node.children,
                              node.leaves, node.saved, None, node.size, *node.below))
        else:
            children = node.children + node.below[0]
            leaves = node.leaves + node.below[1] if children else 1
            saved = node.saved + node.below[2] + (node.n - 1) * node.size
            ends = node.ends.hexdigest() if node.ends else NOTHING
            for row in node.waiting:
                self.sent.append((_DONE, None, None, None, None, None, row[0], row[1], node.least, *row[2:], None, None, None, None))
            row = (node.least, depth, node.n, children, leaves, saved, ends)
            if up is None:  # the root of a later segment: what hangs below it goes to the segment before
                self.sent.append((_ROOT, *[None] * 5, *row[:2], None, row[2], children, node.leaves + node.below[1], saved, None, None, *_pair(node.symbol), None))
            elif up.key is not None:
                self.sent.append((_DONE, None, up.key, None, None, None, *row[:2], None, *row[2:], None, None, None, None))
            else:
                up.waiting.append(row)
            if up is not None:
                up.children, up.leaves, up.saved = up.children + 1, up.leaves + leaves, up.saved + saved
        if up is not None:
            up.n += node.n
            up.least = node.least if up.least is None else min(up.least, node.least)

    def taken(self):
        sent, self.sent = self.sent, []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*sent), _SENT)], schema=_SENT)


def _pair(symbol: bytes) -> list[int]:
    return np.frombuffer(symbol, dtype="<i8").tolist()


def _symbols(raw: bytes) -> list[bytes]:
    return [raw[k : k + 16] for k in range(0, len(raw), 16)]


def _run_shards(splitters, first_depth: int):
    """splitters: broadcast list of (shard, path as bytes), in order."""

    def run(batches):
        every = splitters.value
        place = {number: k for k, (number, _) in enumerate(every)}
        shard = None
        for batch in batches:
            numbers, convs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            lists, sizes = batch.column(2), batch.column(3)
            at = lists.offsets.to_pylist()
            raw = np.stack([lists.values.field(f).to_numpy() for f in ("a", "b")], axis=1).astype("<i8").tobytes()
            size_at, size_of = sizes.offsets.to_pylist(), sizes.values.to_pylist()
            below = batch.column(4).to_pylist()
            for k, (number, conv) in enumerate(zip(numbers, convs)):
                if shard is None or shard.number != number:
                    if shard is not None:
                        while shard.stack:
                            shard.close()
                        yield shard.taken()
                    i = place[number]
                    shard = _Shard(number, _symbols(every[i][1]), _symbols(every[i + 1][1]) if i + 1 < len(every) else [], first_depth)
                hanging = below[k] and (below[k]["children"], below[k]["leaves"], below[k]["saved"])
                shard.add(conv, _symbols(raw[16 * at[k] : 16 * at[k + 1]]), size_of[size_at[k] : size_at[k + 1]], hanging)
                if len(shard.sent) >= ROWS:
                    yield shard.taken()
        if shard is not None:
            while shard.stack:
                shard.close()
            yield shard.taken()

    return run


def _paths(turns: DataFrame, members: DataFrame, segment: int, size: int) -> DataFrame:
    """shard, conv_id, n, path, sizes of the members in this segment, sorted into shards."""
    first = segment * size
    marks = members.select("conv_id", F.lit(first).cast("bigint").alias("d"), "a", "b", F.col("n").alias("size"))
    rows = turns.filter((F.col("d") > first) & (F.col("d") <= first + size)).select("conv_id", "d", "a", "b", "size").unionByName(marks)
    rows = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("d", "a", "b", "size"))).alias("x")).filter(F.col("x")[0]["d"] == first)
    rows = rows.select(
        "conv_id", F.col("x")[0]["size"].alias("n"),
        F.transform("x", lambda t: F.struct(t["a"].alias("a"), t["b"].alias("b"))).alias("path"), F.transform("x", lambda t: t["size"]).alias("sizes"),
    )
    shards = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(shards, "path", "conv_id").withColumn("shard", F.spark_partition_id())
    return materialize(rows, "paths")


def _next_members(paths: DataFrame, segment: int, size: int) -> DataFrame:
    """conv_id, n, key (a, b) of the prefix that the next segment starts from, alone."""
    text = F.concat_ws(",", F.transform("path", lambda t: F.concat_ws(":", t["a"], t["b"])))
    digest = F.sha2(text, 256)
    part = lambda k: F.conv(F.substring(digest, k, 15), 16, 10).cast("bigint")
    rows = paths.filter(F.col("n") >= (segment + 1) * size).select("conv_id", "n", part(1).alias("a"), part(16).alias("b"))
    rows = materialize(rows, "next_members")
    alone = rows.groupBy("a", "b").agg((F.count(F.lit(1)) == 1).alias("alone"))
    return materialize(rows.join(alone, ["a", "b"]), "next_members")


def _own_nodes(turns: DataFrame, alone: DataFrame, depth: int) -> DataFrame:
    """Nodes below `depth` of conversations that share them with no other."""
    alone = alone.select("conv_id", "n", F.col("n").alias("weight"))
    rows = lookup_join(turns.filter(F.col("d") > depth), alone, "conv_id", alone.count(), "weight", "d").filter("n IS NOT NULL")
    last = F.col("d") == F.col("n")
    return rows.select(
        "conv_id", F.col("d").alias("depth"), F.col("conv_id").alias("parent_conv_id"), F.lit(1).cast("bigint").alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("bigint").alias("n_children"), F.lit(1).cast("bigint").alias("n_leaves"), F.lit(0).cast("bigint").alias("saved_tokens"),
        F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(NOTHING).alias("ends_sha256"),
    )


def _skeleton(parts: list, segment: int, first_depth: int) -> tuple[list, list]:
    """(finished nodes, what hangs below each root) from the reduced nodes of the skeleton."""
    nodes = {bytes(p["key"]): p for p in parts}
    sums = {key: [p["n_children"] + p["below_children"], p["n_leaves"] + p["below_leaves"], p["saved_tokens"] + p["below_saved"]] for key, p in nodes.items()}
    done, roots = [], []
    for key, p in sorted(nodes.items(), key=lambda x: -x[1]["depth"]):
        children, leaves, saved = sums[key]
        saved += (p["n_convs"] - 1) * p["size"]
        if p["parent_key"] is None and segment:
            roots.append((*_pair(key), children, leaves, saved))
            done.append((bytearray(key), p["conv_id"], None, None, None, None, None, None))
            continue
        leaves = leaves if children else 1
        up = None
        if p["parent_key"] is not None:
            up = bytes(p["parent_key"])
            sums[up] = [sums[up][0] + 1, sums[up][1] + leaves, sums[up][2] + saved]
        done.append((bytearray(key), p["conv_id"], p["depth"], nodes[up]["conv_id"] if up else None, p["n_convs"], children, leaves, saved))
    return done, roots


def _finish(paths: DataFrame, below: DataFrame | None, segment: int, size: int) -> tuple[DataFrame, DataFrame]:
    """(nodes of the segment, what hangs below each of its roots). below: conv_id and a struct for
    conversations that go on after the segment or end where it ends."""
    spark = paths.sparkSession
    kind = "struct<children:bigint,leaves:bigint,saved:bigint>"
    rows = paths.withColumn("below", F.lit(None).cast(kind)) if below is None else paths.join(below, "conv_id", "left")
    firsts = paths.groupBy("shard").agg(F.min(F.struct("path", "conv_id")).alias("first")).select("shard", "first.path").collect()  # one per shard
    splitters = sorted((r["shard"], np.array([(t["a"], t["b"]) for t in r["path"]], dtype="<i8").tobytes()) for r in firsts)
    run = _run_shards(spark.sparkContext.broadcast(splitters), segment * size)
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(shards, "shard").sortWithinPartitions("shard", "path", "conv_id")
    sent = materialize(rows.select("shard", "conv_id", "path", "sizes", "below").mapInArrow(run, _SENT_TYPES), "trie_parts")

    total = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    same = [F.max(c).alias(c) for c in ("parent_key", "depth", "size", "below_children", "below_leaves", "below_saved")]
    parts = sent.filter(F.col("kind") == _PART).groupBy("key").agg(F.min("conv_id").alias("conv_id"), *total, *same)
    done, roots = _skeleton(parts.collect(), segment, segment * size)  # at most shards x (size + 1) rows
    skeleton = spark.createDataFrame(done, "key binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint")
    ends = sent.filter(F.col("kind") == _IDS).select("key", "shard", "chunk", "ids").repartition("key").sortWithinPartitions("key", "shard", "chunk")
    ends = ends.select("key", "ids").mapInArrow(_digest_ids, "key binary, ends_sha256 string")
    on_it = skeleton.filter("depth IS NOT NULL").join(ends, "key", "left").fillna(NOTHING, ["ends_sha256"]).drop("key")
    columns = [c.split()[0] for c in NODE.split(", ")]
    inside = sent.filter((F.col("kind") == _DONE) & F.col("parent_key").isNull()).select(*columns)
    beside = sent.filter((F.col("kind") == _DONE) & F.col("parent_key").isNotNull()).drop("parent_conv_id")
    beside = beside.join(F.broadcast(skeleton.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))), "parent_key").select(*columns)
    hanging = sent.filter(F.col("kind") == _ROOT).selectExpr("below_children AS a", "below_leaves AS b", "n_children AS children", "n_leaves AS leaves", "saved_tokens AS saved")
    hanging = hanging.unionByName(spark.createDataFrame(roots, hanging.schema))
    return inside.unionByName(beside).unionByName(on_it.select(*columns)), hanging


def _digest_ids(batches):
    """Chunks of ids of one key after another, in order, into one digest per key."""
    key, digest = None, None
    row = lambda: pa.RecordBatch.from_pydict({"key": pa.array([key], pa.binary()), "ends_sha256": [digest.hexdigest()]})
    for batch in batches:
        for k, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if k == key:
                digest.update(b"," + ids)
                continue
            if key is not None:
                yield row()
            key, digest = k, hashlib.sha256(ids)
    if key is not None:
        yield row()


def build(turns: DataFrame, convs: DataFrame, size: int = SEGMENT) -> DataFrame:
    """The nodes of the trie of numbered turns (conv_id, d, a, b, size) of convs (conv_id, n):
    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256, the digest of the ids of the members that end there."""
    convs = materialize(convs, "members")
    longest = convs.agg(F.max("n")).first()[0] or 0
    if longest >= size:
        turns = materialize(turns, "turns")
    members, levels, own = convs.select("conv_id", "n", F.lit(0).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b")), [], []
    while True:
        segment = len(levels)
        paths = _paths(turns, members, segment, size)
        after = _next_members(paths, segment, size) if longest >= (segment + 1) * size else None
        levels.append((paths, after))
        if after is None:
            break
        own.append(_own_nodes(turns, after.filter("alone"), (segment + 1) * size))
        members = after.filter("NOT alone")
        if members.isEmpty():
            break
    hanging, found = None, []
    for segment in range(len(levels) - 1, -1, -1):
        paths, after = levels[segment]
        nodes, hanging = _finish(paths, None if after is None else _below(after, hanging, (segment + 1) * size), segment, size)
        found.append(nodes)
    for nodes in [*found[1:], *own]:
        found[0] = found[0].unionByName(nodes)
    return found[0]


def _below(after: DataFrame, hanging: DataFrame | None, depth: int) -> DataFrame:
    """conv_id and what hangs below the node at `depth` of each conversation that goes on there."""
    rows = after.filter(F.col("n") > depth)
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    below = rows.filter("alone").select("conv_id", F.struct(one.alias("children"), one.alias("leaves"), none.alias("saved")).alias("below"))
    if hanging is not None:
        shared = rows.filter("NOT alone").join(hanging, ["a", "b"]).select("conv_id", F.struct("children", "leaves", "saved").alias("below"))
        below = below.unionByName(shared)
    return below


def trie(rows: DataFrame, size: int = SEGMENT) -> DataFrame:
    """The trie of conversations (conv_id, turn, role, text) as they are."""
    return build(*number_turns(rows), size)
