"""Chat formatting in budgeted windows.

Turns are marked with control strings and laid out in windows of at most `budget` tokens.
Prefix sums of turn tokens choose the spans, always whole turns: a window takes the turns
whose tokens end within the room that is left. It starts with the conversation's system turn
and with the latest turns before it, `history` tokens at most, so that a reply keeps its
context. The loss mask covers the texts of assistant turns, each in the window it belongs to
and not where it is repeated.

A turn is never cut. One that does not fit a window of its own gets one without history,
and exceeds the budget by what it has too much.

Prefix sums in two levels: the sorted table's partitions sum their own turns, partition
totals are summed per conversation. They deal a conversation into cells of CELL budgets, and
windows are chosen within cells, so one very long conversation spreads over many tasks.

Null texts and roles count as empty. Rows of one conversation are ordered by turn (null
first), then role and text; repeated rows are turns of their own. Rows without conv_id make
one conversation. An empty table gives no windows. Other columns are ignored.
"""

import hashlib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from oddspend.llm import tokens
from oddspend.session import materialize

START, END = "<|im_start|>", "<|im_end|>"
CELL = 16  # budgets to a cell
SYSTEM, TARGET = "system", "assistant"

WINDOWS = "conv_id bigint, cell bigint, place int, text string, repeated int, targets array<struct<first:int,last:int>>, n_tokens bigint"
_CONTROL, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(START) + r"(.*?)\n(.*?)" + re.escape(END) + r"\n", re.S)


def escape(text: str) -> str:
    """No control string can start in the result: `<|` gets a backslash, `<\\|` one more."""
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def turn_text(role: str, text: str) -> str:
    return f"{START}{escape_role(role)}\n{escape(text)}{END}\n"


def spans(sizes: list[int], old: list[int], budget: int, history: int):
    """(first repeated, first, end) of each window over turns of these sizes. old: sizes of
    the turns that end where the first one starts; repeated turns count from -len(old)."""
    every = np.concatenate([[0], np.cumsum([*old, *sizes])])
    k, n, first = len(old), len(old) + len(sizes), len(old)
    while first < n:
        since = int(np.searchsorted(every, every[first] - history))
        while since < first and every[first + 1] - every[since] > budget:
            since += 1
        end = max(first + 1, int(np.searchsorted(every, every[since] + budget, side="right")) - 1)
        yield since - k, first - k, min(end, n) - k
        first = min(end, n)


def lay_out(turns: list, old: list, system, budget: int, history: int):
    """Windows of a cell. Turns are (role, text, n_tokens); system is one of these or None.
    The system turn itself is the first of the first cell and is not repeated there."""
    own = bool(turns) and system is not None and turns[0] is system
    room = budget - (system[2] if system else 0)
    for since, first, end in spans([t[2] for t in turns[own:]], [t[2] for t in old], room, history) if len(turns) > own else ([(0, 0, 0)] if own else []):
        lead = [] if system is None else [system]
        rest = turns[own:]
        again = [old[len(old) + i] if i < 0 else rest[i] for i in range(since, first)]
        repeated = len(again) + (len(lead) if not (own and first == 0) else 0)
        parts, targets, size = [], [], 0
        for k, (role, text, n) in enumerate([*lead, *again, *rest[first:end]]):
            whole = turn_text(role, text)
            if k >= repeated and role == TARGET:
                targets.append((size + len(whole) - len(escape(text)) - len(END) - 1, size + len(whole) - len(END) - 1))
            size += len(whole)
            parts.append(whole)
        yield "".join(parts), repeated, targets, sum(t[2] for t in [*lead, *again, *rest[first:end]])


def format_windows(rows: DataFrame, path: str, budget: int = 1024, history: int = 128) -> DataFrame:
    """A row for each window: conv_id, cell and place (its order), text, how many turns at its
    start are repeated, the spans of the loss mask in code points, and its tokens."""

    @F.pandas_udf("bigint")
    def count(roles, texts):
        encode = tokens.ids(path).encode
        return pd.Series([len(encode(turn_text(r, t))) // 4 for r, t in zip(roles, texts)], dtype="int64")

    def text(name):
        return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)

    order = ["turn", "role", "text"]
    turns = rows.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), text("role"), text("text"))
    turns = turns.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id())
    turns = materialize(turns.withColumn("n", count("role", "text")), "turns")
    inside = W.partitionBy("part", "conv_id").orderBy(*order)
    upto = inside.rowsBetween(W.unboundedPreceding, -1)
    turns = turns.withColumn("start", F.coalesce(F.sum("n").over(upto), F.lit(0))).withColumn("k", F.row_number().over(inside) - 1)
    totals = turns.groupBy("part", "conv_id").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"))
    before = W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select(F.col("part").alias("p"), F.col("conv_id").alias("c"), *[F.coalesce(F.sum(x).over(before), F.lit(0)).alias(f"{x}0") for x in ("n", "k")])
    turns = turns.join(totals, (F.col("part") == F.col("p")) & F.col("conv_id").eqNullSafe(F.col("c")))
    turns = turns.select("conv_id", "role", "text", "n", (F.col("start") + F.col("n0")).alias("start"), (F.col("k") + F.col("k0")).alias("k"))
    turns = materialize(turns.withColumn("cell", F.floor(F.col("start") / F.lit(CELL * budget))), "placed_turns")
    # a cell's last turns are the history of the next one's first window, which starts where they end
    end = F.max(F.col("start") + F.col("n")).over(W.partitionBy("conv_id", "cell"))
    again = turns.withColumn("end", end).filter((F.col("end") - F.col("start") <= history) & ~((F.col("k") == 0) & (F.col("role") == SYSTEM)))
    again = again.withColumn("next", F.floor(F.col("end") / F.lit(CELL * budget))).filter("next > cell")
    again = again.select("conv_id", "role", "text", "n", "start", "k", F.col("next").alias("cell"), F.lit(True).alias("old"))
    both = turns.withColumn("old", F.lit(False)).unionByName(again)
    cells = both.groupBy("conv_id", "cell").agg(F.collect_list(F.struct("k", "role", "text", "n", "old")).alias("turns"))
    cells = cells.filter(F.exists("turns", lambda t: ~t["old"]))
    system = turns.filter((F.col("k") == 0) & (F.col("role") == SYSTEM)).select(F.col("conv_id").alias("c"), F.struct("k", "role", "text", "n").alias("system"))
    cells = cells.join(system, F.col("conv_id").eqNullSafe(F.col("c")), "left").select("conv_id", "cell", "turns", "system")

    def run(batches):
        for batch in batches:
            out = []
            for conv, cell, all_turns, lead in zip(*(batch.column(i).to_pylist() for i in range(4))):
                all_turns.sort(key=lambda t: t["k"])
                triple = lambda t: (t["role"], t["text"], t["n"])
                own, old = [triple(t) for t in all_turns if not t["old"]], [triple(t) for t in all_turns if t["old"]]
                lead = triple(lead) if lead else None
                if lead and cell == 0:
                    own[0] = lead
                for place, (text, repeated, targets, n) in enumerate(lay_out(own, old, lead, budget, history)):
                    out.append((conv, cell, place, text, repeated, [{"first": a, "last": b} for a, b in targets], n))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 7, kinds)], names=[x.split()[0] for x in WINDOWS.split(", ")])

    return cells.mapInArrow(run, WINDOWS)


def read_turns(text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted window."""
    return [(unescape_role(r), unescape(t)) for r, t in _TURN.findall(text)]


def digests(windows: DataFrame) -> DataFrame:
    """Per conversation, read back from the windows: turns, their digest, the characters and
    digest of what the loss mask covers, and characters of all windows. Windows stream
    through in order, so a task holds one window at a time."""

    def run(batches):
        state = None

        def row():
            conv, n, turns, chars, loss, total = state
            return pa.RecordBatch.from_pylist([dict(zip(names, (conv, n, turns.hexdigest(), chars, loss.hexdigest(), total)))], schema=schema)

        for batch in batches:
            for conv, text, repeated, targets in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if state is None or state[0] != conv:
                    if state is not None:
                        yield row()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, body in read_turns(text)[repeated:]:
                    state[1] += 1
                    state[2].update(f"{role}\n{body}\n".encode())
                for t in targets:
                    body = unescape(text[t["first"] : t["last"]])
                    state[3] += len(body)
                    state[4].update(body.encode())
                state[5] += len(text)
        if state is not None:
            yield row()

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    schema = pa.schema(list(zip(names, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))))
    ordered = windows.repartition("conv_id").sortWithinPartitions("conv_id", "cell", "place")
    return ordered.select("conv_id", "text", "repeated", "targets").mapInArrow(
        run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    )
