"""Repair of conversation structure: the cheapest edits that leave an optional system turn and then user
and assistant turns in alternation, and among them the edits whose initials (the audit) are least.

1. Rows of a conversation are put in order and get their fault by windows that share one exchange by
   conv_id. What the search needs of a row is one small code: initial of the role and fault.
2. Cost: a node is (rows read, state), states are the start and the initial written last. Costs to
   the end are filled backwards, for many conversations at a time.
3. Path: an arc is optimal if its cost and its head's make its tail's. Nodes get the rank of their
   least audit of 1, 2, 4, ... letters: a node's rank for 2k letters comes from the pair of its rank and
   the rank of the node that its pointer reaches after k, and the pointers double. An edit's letter
   fixes the node it leads to (each state allows one role to write), so one pointer a node is enough.
   With the final ranks every node takes its arc of least (letter, rank of the head), and the path
   from the first node is read off through pointers doubled over these arcs.
4. A second pass streams each conversation's rows in order behind its audit, applies the edits and
   digests the result as it goes.

A conversation is one output row with one audit and one digest, so its codes (a struct for each
row) meet in one task; its texts are streamed there, never held together.

Inputs: null role and text are one space; rows go by turn (null first), ties by role, then text;
repeated rows are rows of their own; rows with a null conv_id are one conversation; an empty role has no
initial; texts of any length are kept whole; an empty table has no conversations; further columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from histwise.llm.common import ready, stored

SPACE = " \t\n\x0b\x0c\r"
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
#: Rows that a task takes through the search at once (one longer conversation goes by itself).
RUN_ROWS = 50_000

# Costs of the edits; states 0 start, 1 system, 2 user, 3 assistant.
DELETE, INSERT, REROLE, CUT_OFF = 4, 3, 3, 3
LETTERS = np.frombuffer(b"DIKR", np.uint8)
#: The state after the one role that each state lets an inserted or reroled row have.
WRITES = np.array([2, 2, 3, 2])
#: The state after keeping a row, by its initial (other, s, u, a) and the state before; -1: not allowed.
KEEPS = np.array([[-1, -1, -1, -1], [1, -1, -1, -1], [2, 2, -1, 2], [-1, -1, 3, -1]])
FAR = np.int64(1) << 40


def insertions(cost: np.ndarray) -> np.ndarray:
    """Costs of the four states once rows may be inserted in front."""
    s, t, u, a = cost.T
    u, a = np.minimum(u, a + INSERT), np.minimum(a, u + INSERT)
    return np.stack([np.minimum(s, u + INSERT), np.minimum(t, u + INSERT), u, a], axis=1)


def steps(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cost of keeping and of reroling rows, and the states after keeping them, by state."""
    fault = code >> 2
    own = np.where(fault == TRUNCATED, CUT_OFF, 0) + np.where((fault == BLANK) | (fault == DUPLICATE), FAR, 0)
    return own, KEEPS[code & 3]


def costs(code: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Cost to the end of (layer, state). Conversation c has layers first[c] .. first[c] + n[c]."""
    out = np.empty((len(code), 4), np.int64)
    end = insertions(np.array([[0, FAR, FAR, 0]], np.int64))
    out[first + n] = end
    long_first = np.argsort(-n, kind="stable")
    tail = (first + n)[long_first]
    lengths = n[long_first]
    for back in range(1, int(lengths[0]) + 1 if len(lengths) else 1):
        at = tail[:np.searchsorted(-lengths, -back, "right")] - back
        after = out[at + 1]
        own, kept = steps(code[at])
        best = np.minimum(after + DELETE, after[:, WRITES] + (own + REROLE)[:, None])
        keep = np.where(kept < 0, FAR, np.take_along_axis(after, np.maximum(kept, 0), axis=1) + own[:, None])
        out[at] = insertions(np.minimum(best, keep))
    return out


def arcs(code: np.ndarray, cost: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Heads of the four arcs (D, I, K, R) of each node, and which of them are optimal."""
    layers = len(code)
    here, after = np.arange(layers)[:, None] * 4, np.minimum(np.arange(layers) + 1, layers - 1)[:, None] * 4
    own, kept = steps(code)
    state = np.arange(4)[None, :]
    heads = np.stack([after + state, np.broadcast_to(here + WRITES, (layers, 4)), after + np.maximum(kept, 0), np.broadcast_to(after + WRITES, (layers, 4))], axis=2).reshape(-1, 4)
    price = np.empty((layers, 4, 4), np.int64)
    price[:, :, 0], price[:, :, 1], price[:, :, 3] = DELETE, INSERT, (own + REROLE)[:, None]
    price[:, :, 2] = np.where(kept < 0, FAR, own[:, None])
    closed = np.zeros((layers, 1, 4), bool)
    closed[last] = np.array([True, False, True, True])
    flat = cost.reshape(-1)
    good = (price.reshape(-1, 4) + flat[heads] == flat[:, None]) & (flat[:, None] < FAR)
    return heads, good & ~np.broadcast_to(closed, (layers, 4, 4)).reshape(-1, 4)


def doubled(pointer: np.ndarray) -> Iterator[np.ndarray]:
    """The pointers after 1, 2, 4, ... steps, up to the one whose every node has come to an end."""
    while True:
        yield pointer
        further = pointer[pointer]
        if np.array_equal(further, pointer):
            return
        pointer = further


def ranks(letter: np.ndarray, pointer: np.ndarray) -> np.ndarray:
    """Ranks of the nodes' least audits; ``letter`` is 0 at an end, which points to itself."""
    rank = letter.astype(np.int64)
    for reach in doubled(pointer):
        _, rank = np.unique(rank * (rank.max() + 1) + rank[reach], return_inverse=True)
    return rank


def plans(codes: list[np.ndarray]) -> list[tuple[int, str]]:
    """Cost and audit of each conversation's cheapest repair; codes: initial + 4 x fault of each row."""
    n = np.array([len(c) for c in codes], np.int64)
    first = np.concatenate([[0], np.cumsum(n + 1)[:-1]])
    code = np.zeros(int((n + 1).sum()), np.int64)
    for at, own in zip(first, codes):
        code[at:at + len(own)] = own
    cost = costs(code, first, n)
    heads, good = arcs(code, cost, first + n)
    nodes, some = np.arange(len(heads)), good.any(axis=1)
    least = good.argmax(axis=1)
    rank = ranks(np.where(some, least + 1, 0), np.where(some, heads[nodes, least], nodes))
    order = np.where(good, np.arange(4) * (rank.max() + 1) + rank[heads], np.iinfo(np.int64).max)
    taken = order.argmin(axis=1)
    levels = list(doubled(np.where(some, heads[nodes, taken], nodes)))
    out = []
    for at in first:
        path = np.array([4 * at])
        for reach in levels:
            if not some[path[-1]]:
                break
            path = np.concatenate([path, reach[path]])
        path = path[:int(np.argmin(some[path]))] if not some[path].all() else path
        out.append((int(cost[at, 0]), LETTERS[taken[path]].tobytes().decode()))
    return out


def plan_column(codes: pa.Array) -> pa.Array:
    """cost, audit and the number of illegal neighbours for lists of codes."""
    lists = [np.asarray(c, np.int64) for c in codes.to_pylist()]
    out: list[tuple[int, str]] = []
    at = 0
    while at < len(lists):
        to, rows = at + 1, len(lists[at])
        while to < len(lists) and rows + len(lists[to]) < RUN_ROWS:
            rows += len(lists[to])
            to += 1
        out += plans(lists[at:to])
        at = to
    legal = np.zeros((4, 4), bool)
    legal[[1, 2, 3], [2, 3, 2]] = True
    illegal = [int((~legal[c[:-1] & 3, c[1:] & 3]).sum()) for c in lists]
    return pa.StructArray.from_arrays(
        [pa.array([c for c, _ in out], pa.int64()), pa.array([a for _, a in out], pa.string()), pa.array(illegal, pa.int64())], ["cost", "audit", "illegal"])


class Editor:
    """Applies an audit to a conversation's rows as they come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.last = audit, 0, ""

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self.write(), ""

    def write(self) -> str:
        role = "assistant" if self.last == "u" else "user"
        self.last = role[0]
        return role

    def feed(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self.last = role[:1]
            yield role, text
        elif letter == "R":
            yield self.write(), text


def rows_in_order(messages: DataFrame, gone: Column) -> DataFrame:
    """The rows with their place and code; rows for which ``gone`` holds only name their conversation."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"), gone.alias("gone"))
    order = Window.partitionBy("conv_id").orderBy("gone", F.asc_nulls_first("turn"), "role", "text")
    rows = rows.withColumn("pos", F.row_number().over(order)).withColumn("before", F.lag("turn").over(order))
    seen = F.row_number().over(Window.partitionBy("conv_id", "gone", "role", "text").orderBy("pos")) > 1
    rows = rows.withColumn("seen", seen)
    end = F.rtrim(F.col("text"), F.lit(SPACE))
    fault = F.when(end == "", BLANK).when(F.col("seen"), DUPLICATE).when(~F.right(end, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(0)
    initial = F.position(F.substring("role", 1, 1), F.lit("sua"))
    initial = F.when(F.col("role") == "", 0).otherwise(initial)
    new_turn = F.col("turn").isNotNull() & (F.col("before").isNull() | (F.col("before") != F.col("turn")))
    here = ~F.col("gone")
    return rows.select("conv_id", "pos", "role", "text", F.when(here, F.col("turn")).alias("turn"), F.when(here, initial + 4 * fault).alias("code"), (here & new_turn).alias("new_turn"))


def summaries(rows: DataFrame) -> DataFrame:
    """One row for each conversation: counts of faults, cost, audit."""
    ready(rows.sparkSession)
    plan = arrow_udf(plan_column, "cost long, audit string, illegal long")
    fault = F.shiftright("code", 2)
    count = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    found = rows.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - count(F.col("new_turn")), F.lit(0)).alias("gaps"),
        *[count(fault == kind).alias(name) for kind, name in ((BLANK, "blank"), (DUPLICATE, "duplicate"), (TRUNCATED, "truncated"))],
        F.array_sort(F.collect_list(F.when(F.col("code").isNotNull(), F.struct("pos", "code")))).alias("codes"))
    found = found.withColumn("plan", plan(F.transform("codes", lambda x: x["code"])))
    return found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "plan.illegal", "plan.cost", "plan.audit")


COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def behind_audits(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of each conversation in order, its summary in front of them (pos 0)."""
    heads = found.select("conv_id", F.lit(0).alias("pos"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), F.struct(*found.columns[1:]).alias("found"))
    body = rows.where("code is not null").select("conv_id", "pos", "role", "text", F.lit(None).cast(f"struct<{COUNTS.replace(' ', ':').replace(',:', ',')}>").alias("found"))
    return heads.unionByName(body).repartition("conv_id").sortWithinPartitions("conv_id", "pos")


def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict | None, Iterator[tuple[str, str]]]]:
    """Runs of repaired turns: the summary at the head of a conversation, else None, and the turns."""
    editor = None
    for batch in batches:
        for conv, pos, role, text, found in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "pos", "role", "text", "found"))):
            if pos == 0:
                if editor is not None:
                    yield None, editor.inserted()
                editor = Editor(found["audit"])
                yield {"conv_id": conv, **found}, iter(())
            else:
                yield None, editor.feed(role, text)
    if editor is not None:
        yield None, editor.inserted()


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(c, pa.int64()) for c in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", pa.string()), ("repaired_sha256", pa.string())])
    out, now, digest, empty = [], None, None, True
    for head, turns in edited(batches):
        if head is not None:
            if now is not None:
                out.append({**now, "repaired_sha256": digest.hexdigest()})
            if len(out) >= 10_000:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
            now, digest, empty = head, hashlib.sha256(), True
        for role, text in turns:
            digest.update(f"{role}:{text}".encode() if empty else f"\n{role}:{text}".encode())
            empty = False
    if now is not None:
        out.append({**now, "repaired_sha256": digest.hexdigest()})
    yield pa.RecordBatch.from_pylist(out, schema=schema)


def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    out, conv, n = [], None, 0
    for head, edits in edited(batches):
        if head is not None:
            conv, n = head["conv_id"], 0
        for role, text in edits:
            out.append({"conv_id": conv, "turn": n, "role": role, "text": text})
            n += 1
        if len(out) >= 1000:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out = []
    yield pa.RecordBatch.from_pylist(out, schema=schema)


def repair(messages: DataFrame) -> DataFrame:
    """The repaired turns of ``messages`` (conv_id, turn, role, text), numbered from 0."""
    rows = stored(rows_in_order(messages, F.lit(False)), "repair-rows", "zstd")
    return behind_audits(rows, summaries(rows)).mapInArrow(turns, "conv_id long, turn long, role string, text string")


def report(messages: DataFrame, gone: Column | None = None) -> DataFrame:
    """One row for each conversation: faults, cost, audit and the digest of the repaired turns."""
    rows = stored(rows_in_order(messages, F.lit(False) if gone is None else gone), "repair-rows", "zstd")
    return behind_audits(rows, summaries(rows)).mapInArrow(digests, f"conv_id long, {COUNTS}, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with the contract's damage, by crc32 of ``conv_id:turn`` modulo 20; ``gone`` marks those it drops."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")), F.lit(20))
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind"))
    rows = rows.withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    hurt = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), hurt.alias("text"), (F.col("kind") == 0).alias("gone"))


def contract(conversations: DataFrame) -> DataFrame:
    rows = damaged(conversations)
    return report(rows, F.col("gone"))
