"""Exact top-k inner products: norm order, SVD rotation, Cauchy-Schwarz bounds.

Candidates are cut into bands by length. Every query first meets the head band, the longest
candidates; its k-th best score there is its floor. It is then sent only to those further bands whose
longest vector can still reach the floor, and a band is copied once for each block of the queries that
it gets, so a band that no query can need is not shuffled at all. Where all lengths are alike, no
band can be left out, and the copies grow with rows times queries.

In a band queries go to blocks and candidates to stripes, both by a hash of the id; a task has one block
against one stripe. Its candidates come by descending length and are read as a stream, so it
holds the queries, their best k so far and one batch of candidates, whatever the table's size.
A batch is compared in steps: the product of lengths, then partial sums over the leading axes
of an SVD rotation plus the product of the residual lengths; pairs whose bound is below the
query's floor or its k-th best in the task are dropped, and the rest get the exact integer product. Once the
longest candidate left cannot reach any query's floor, the stripe's rest is passed over.

The rotation comes from sums of products over all vectors (one row per pair of axes, of the first
``AXES`` components; later ones stay as they are and count in the residual); an error
in it could only cost time, since the bounds hold for any rotation and have a slack for rounding.

Inputs: vectors that are null or hold a null or a non-finite number, and rows without an id, take
no part; shorter vectors count as padded with zeros; ties go to the smaller id; repeated rows
are candidates each, repeated queries give one ranking for each distinct vector, and rows with
the query's own id are not its candidates; integer products are exact while they fit a long; an
empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histwise.llm.common import ready, stored

#: Queries that a task holds, about.
QUERY_BLOCK = 4096
#: Candidates that a task streams, about.
STRIPE = 1 << 17
BATCH = 512
STEPS = (1 / 8, 1 / 4, 1 / 2)
#: Components that are rotated: bounds the rows that the driver gets.
AXES = 512
#: Share of the candidates in the head band, and number of the further bands.
HEAD, BANDS = 1 / 16, 15
SLACK = 1e-9
LEAST = np.iinfo(np.int64).min


def quantized(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, v (integers) of the rows that take part."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"), bad.alias("bad"))
            .where("vec_id is not null and x is not null and not bad")
            .select("vec_id", F.transform("x", lambda e: F.floor(F.lit(float(scale)) * e).cast("long")).alias("v")))


def dense(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as a matrix, padded with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Axes of the first ``width`` components by falling share of the vectors' energy (columns)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            m = dense(batch.column("v"), width).astype(float)
            total += m.T @ m
        i, j = np.triu_indices(width)
        yield pa.record_batch({"i": i.astype(np.int32), "j": j.astype(np.int32), "s": total[i, j]})

    total = np.zeros((width, width))
    for r in vectors.select(F.slice("v", 1, width).alias("v")).mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        total[r["i"], r["j"]] = total[r["j"], r["i"]] = r["s"]
    return np.linalg.svd(total / max(1.0, np.abs(total).max()))[0]


class Best:
    """The best k of each query of a block, and the search through a stripe."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, axes: np.ndarray, k: int, least: np.ndarray):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.axes, self.least = axes, least
        self.rotated, self.beyond = self.turned(vectors)
        self.steps = sorted({max(1, int(s * len(axes))) for s in STEPS}) if len(axes) > 1 else []
        self.length = np.sqrt((vectors.astype(float) ** 2).sum(axis=1))
        self.rest = {s: np.sqrt((self.rotated[:, s:] ** 2).sum(axis=1) + self.beyond) for s in self.steps}
        self.score = np.full((len(ids), k), LEAST)
        self.id = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.found = np.zeros(len(ids), np.int64)

    def turned(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rotated leading components, and the squared length of the others."""
        n = len(self.axes)
        return vectors[:, :n] @ self.axes, (vectors[:, n:].astype(float) ** 2).sum(axis=1)

    def floor(self) -> np.ndarray:
        """What a bound must reach: each query's k-th best or the floor it came with, less a slack for rounding."""
        last = self.score[:, -1].astype(float)
        return np.maximum(np.where(self.found >= self.k, last - SLACK * np.abs(last) - 1e-6, -np.inf), self.least)

    def take(self, ids: np.ndarray, vectors: np.ndarray) -> bool:
        """Search one batch; False if neither it nor any shorter candidate can matter."""
        length = np.sqrt((vectors.astype(float) ** 2).sum(axis=1))
        floor = self.floor()
        slack = 1 + SLACK
        live = np.nonzero(self.length * length.max() * slack >= floor)[0]
        if not live.size:
            return False
        near = (self.length[live, None] * length * slack >= floor[live, None]) & (self.ids[live, None] != ids)
        rotated, beyond = self.turned(vectors)
        for s in self.steps:
            if not near.any():
                return True
            rest = np.sqrt((rotated[:, s:] ** 2).sum(axis=1) + beyond)
            bound = self.rotated[live, :s] @ rotated[:, :s].T + self.rest[s][live, None] * rest
            near &= bound + SLACK * self.length[live, None] * length + 1e-6 >= floor[live, None]
        some = near.any(axis=1)
        live, near = live[some], near[some]
        if not live.size:
            return True
        q, c = np.nonzero(near)
        score = np.full(near.shape, LEAST)
        for i in range(0, len(q), 1 << 16):
            a, b = q[i:i + (1 << 16)], c[i:i + (1 << 16)]
            score[a, b] = np.einsum("ij,ij->i", self.vectors[live[a]], vectors[b])
        every = np.concatenate([self.id[live], np.where(near, ids, np.iinfo(np.int64).max)], axis=1)
        score = np.concatenate([self.score[live], score], axis=1)
        order = np.argsort(every, axis=1, kind="stable")
        score, every = np.take_along_axis(score, order, 1), np.take_along_axis(every, order, 1)
        order = np.argsort(~score, axis=1, kind="stable")[:, :self.k]
        self.score[live], self.id[live] = np.take_along_axis(score, order, 1), np.take_along_axis(every, order, 1)
        self.found[live] = np.minimum(self.k, self.found[live] + near.sum(axis=1))
        return True

    def rows(self, query_hash: np.ndarray) -> pa.RecordBatch:
        held = np.arange(self.k) < self.found[:, None]
        q = np.nonzero(held)[0]
        return pa.record_batch({"query_id": self.ids[q], "q": query_hash[q], "vec_id": self.id[held], "score": self.score[held]})


def pmod_hash(n: Column) -> Column:
    return F.pmod(F.xxhash64("vec_id"), n).cast("int")


def upto(n: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), n - 1))


def search(given: DataFrame, asked: DataFrame, sizes: dict[int, int], blocks: dict[int, int], axes: Broadcast, width: int, k: int) -> DataFrame:
    """query_id, q, vec_id, score: the best k in each stripe of the bands that a query is sent to.

    ``given``: band, length, vec_id, v. ``asked``: band, vec_id, v, q and the floor (-inf: none). ``sizes`` has the
    candidates of each band, ``blocks`` the blocks of queries of the bands that are searched."""
    split = {b: -(-sizes.get(b, 0) // STRIPE) or 1 for b in blocks}
    of = lambda counts: F.coalesce(*[F.when(F.col("band") == b, F.lit(n)) for b, n in counts.items()])
    number, stripes = of(blocks), of(split)
    left = asked.select("band", pmod_hash(number).alias("block"), upto(stripes).alias("stripe"), F.lit(float("inf")).alias("length"), "vec_id", "v", "q", "floor")
    right = given.where(F.col("band").isin(list(blocks))).select("band", upto(number).alias("block"), pmod_hash(stripes).alias("stripe"), "length", "vec_id", "v",
                                                                  F.lit(None).cast("long").alias("q"), F.lit(None).cast("double").alias("floor"))
    key = ["band", "block", "stripe"]
    rows = left.unionByName(right).repartition(sum(split[b] * n for b, n in blocks.items()), *key).sortWithinPartitions(*key, F.desc("length"), "vec_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, asked, best, over = None, [], None, False
        for batch in batches:
            at = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in key])
            query = batch.column("q").is_valid().to_numpy(zero_copy_only=False)
            parts = np.concatenate([[0], np.nonzero((np.diff(at) != 0).any(axis=0) | (np.diff(query.astype(int)) != 0))[0] + 1, [batch.num_rows]])
            for a, z in zip(parts[:-1].tolist(), parts[1:].tolist()):
                if a == z:
                    continue
                if (place := tuple(at[:, a].tolist())) != now:
                    if best:
                        yield best.rows(hashes)
                    now, asked, best, over = place, [], None, False
                part = batch.slice(a, z - a)
                if over or not (query[a] or asked):
                    continue
                ids = part.column("vec_id").to_numpy(zero_copy_only=False)
                v = dense(part.column("v"), width)
                if query[a]:
                    asked.append((ids, v, part.column("q").to_numpy(zero_copy_only=False), part.column("floor").to_numpy(zero_copy_only=False)))
                    continue
                if best is None:
                    i, m, hashes, least = (np.concatenate(x) for x in zip(*asked))
                    best = Best(i, m, axes.value, k, least)
                over = not all(best.take(ids[i:i + BATCH], v[i:i + BATCH]) for i in range(0, len(ids), BATCH))
        if best:
            yield best.rows(hashes)

    return rows.mapInArrow(run, "query_id long, q long, vec_id long, score long")


def ranked(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def banded(vectors: DataFrame) -> DataFrame:
    """``vectors`` with length and band: 0 for the longest ``HEAD`` of them, then ``BANDS`` equal shares."""
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    measured = stored(vectors.select("vec_id", "v", length.alias("length")), "topk-vectors")
    shares = [(1 - HEAD) * (BANDS - i) / BANDS for i in range(BANDS)]
    limits = measured.approxQuantile("length", shares, 1e-3)
    return measured.withColumn("band", sum(((F.col("length") < x).cast("int") for x in limits), F.lit(0)))


def reachable(asked: DataFrame, head: DataFrame, longest: dict[int, float], k: int) -> DataFrame:
    """``asked`` once for each further band whose longest vector reaches the query's k-th best of the head."""
    kth = head.groupBy("query_id", "q").agg(F.when(F.count("*") >= k, F.min("score").cast("double")).alias("kth"))
    floor = F.coalesce(F.col("kth") - SLACK * F.abs("kth") - 1e-6, F.lit(float("-inf"))).alias("floor")
    known = asked.join(kth.withColumnRenamed("query_id", "vec_id"), ["vec_id", "q"], "left").select("vec_id", "v", "q", "length", floor)
    bands = F.array(*[F.when(F.col("length") * (x * (1 + SLACK)) >= F.col("floor"), F.lit(b)) for b, x in sorted(longest.items())])
    return known.select(F.explode(F.array_compact(bands)).alias("band"), "vec_id", "v", "q", "floor")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id and score for both tables' rows (vec_id, v: integers)."""
    spark = ready(vectors.sparkSession)
    given = banded(vectors)
    bands = {r["band"]: r for r in given.groupBy("band").agg(F.max("length").alias("longest"), F.max(F.size("v")).alias("width"), F.count("*").alias("n")).collect()}  # at most BANDS + 1
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    asked = stored(queries.dropDuplicates(["vec_id", "v"]).select("vec_id", "v", F.xxhash64("v").alias("q"), length.alias("length")), "topk-queries")
    number, wide = asked.agg(F.count("*"), F.max(F.size("v"))).first()
    width = max([wide or 0, *(r["width"] for r in bands.values())])
    axes = spark.sparkContext.broadcast(rotation(given, min(width, AXES)) if width else np.zeros((0, 0)))
    sizes = {b: r["n"] for b, r in bands.items()}
    blocks = lambda n: max(1, -(-n // query_block))
    everyone = asked.select(F.lit(0).alias("band"), "vec_id", "v", "q", F.lit(float("-inf")).alias("floor"))
    head = stored(ranked(search(given, everyone, sizes, {0: blocks(number)}, axes, width, k), k).drop("rank"), "topk-head")
    longest = {b: r["longest"] for b, r in bands.items() if b}
    found = head
    if longest:
        sent = stored(reachable(asked, head, longest, k), "topk-sent")
        need = {r["band"]: blocks(r["n"]) for r in sent.groupBy("band").agg(F.count("*").alias("n")).collect()}  # at most BANDS
        if need:
            found = head.unionByName(search(given, sent, sizes, need, axes, width, k))
    return ranked(found, k).select("query_id", "rank", "vec_id", "score")


def contract(vectors: DataFrame) -> DataFrame:
    v = quantized(vectors)
    return top_k(v, v.where("vec_id % 50 = 0"))


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""
