"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints: 64 bits, the bitwise majority of the hashes of a text's word shingles. Two of
them link at ``max_bits`` or fewer differing bits; the classes are the connected components.

1. One pass over the texts writes (doc_id, fingerprint); copies collapse to one fingerprint.
2. The distinct fingerprints are range-partitioned by Gray rank into blocks of about ``BLOCK_CODES``.
   Neighbours in that order share bits, so a block is an upper node: the bits that all its codes
   share (mask) and their values (pattern). Runs of blocks are factored again, up to one small root level.
3. A search starts at the root level. Each node compares only the bits that no node above it has
   compared, the differences add up along the path, and a node whose sum passes ``max_bits`` is
   pruned with all that lies under it. What is left are the blocks a fingerprint has to visit; of a pair in
   two blocks, the one in the lower block visits.
4. Each block builds the same hierarchy over its own codes and its visitors search it to the leaves.
   Visitors of a busy block are dealt to slices, each with a copy of the block's codes.
5. A slice gives back one link per visitor and one per code (to the smallest code of its class there),
   never all pairs; components are found over these.

Sizes: the upper nodes are broadcast and are at most ``MAX_BLOCKS`` rows of 20 bytes, whatever the corpus;
beyond ``MAX_BLOCKS * BLOCK_CODES`` distinct fingerprints the blocks grow (8 bytes a code in a task).
A search's working set is at most ``FRONTIER`` places (or one visitor's): where it would pass them, half the
visitors are searched at a time. With p bits shared in a block, a random fingerprint's visits go with
1 + p + p (p - 1) / 2; p is about the logarithm of the number of blocks, so visits grow with its square.

Inputs: a null or empty text, or one without words, has fingerprint zero and links like any other;
fewer words than a shingle: the whole sequence is the shingle; texts of any length are read
whole, in blocks; repeated rows give repeated results; rows with a null doc_id are in a class
whose id is its smallest doc_id that is not null (null if there is none); an empty table gives
an empty result; further columns are not read.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from histwise.llm.bpe import slices
from histwise.llm.common import hot_join, ready, stored, text_or_empty
from histwise.llm.components import components

WORDS_PER_SHINGLE = 3
MAX_BITS = 2
SEED = 42
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+").findall
BLOCK = 1 << 14
#: Codes in a run at the lowest level, and nodes in a run above it.
LEAF, FAN = 8, 8
#: Distinct fingerprints in a block, blocks at least (so that tasks have work) and at most (their patterns
#: are broadcast), visitors in a slice.
BLOCK_CODES, MIN_BLOCKS, MAX_BLOCKS, SLICE = 1 << 16, 64, 1 << 16, 1 << 19
#: Most places (visitor, node) that a search of several visitors holds.
FRONTIER = 1 << 18


def fingerprint(text: str, words_per_shingle: int = WORDS_PER_SHINGLE) -> int:
    words = _WORDS(text.encode().lower())
    if not words:
        return 0
    n, joined = len(words), b" ".join(words)
    ones, total = np.zeros(64, np.int64), max(1, n - words_per_shingle + 1)
    if n <= words_per_shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
        return _majority(np.unpackbits(hashes.view(np.uint8), bitorder="little").astype(np.int64), 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    digest, data = xxhash.xxh64_intdigest, memoryview(joined)
    spans = zip(begins[:total].tolist(), ends[words_per_shingle - 1:].tolist())
    while block := list(itertools.islice(spans, BLOCK)):
        hashes = np.array([digest(data[a:b], SEED) for a, b in block], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return _majority(ones, total)


def _majority(ones: np.ndarray, total: int) -> int:
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words_per_shingle: int = WORDS_PER_SHINGLE) -> DataFrame:
    """doc_id and fp (the 64 bits as a long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                fp = np.array([fingerprint(t, words_per_shingle) for t in part.column("t").to_pylist()], np.uint64)
                yield pa.record_batch({"doc_id": part.column("doc_id"), "fp": fp.view(np.int64)})

    ready(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("t")).mapInArrow(run, "doc_id long, fp long")


def coded(spark, words_per_shingle: int = WORDS_PER_SHINGLE):
    """A column function: text to its fingerprint (as a long)."""

    def run(text: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t, words_per_shingle) for t in text.to_pylist()], np.uint64).view(np.int64))

    ready(spark)
    return arrow_udf(run, "long")


def gray_order(code: Column) -> Column:
    """A long that sorts as the code's place in Gray order does."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code.bitwiseXOR(F.lit(-(1 << 63)))


class GrayIndex:
    """Nodes over codes sorted by Gray rank: runs of codes, then runs of nodes. The lowest level may
    be nodes itself (``mask`` tells which bits of a pattern count)."""

    def __init__(self, codes: np.ndarray, mask: np.ndarray | None = None):
        self.levels = [(codes, np.full(len(codes), ~np.uint64(0)) if mask is None else mask)]  # pattern and mask, leaves first
        while len(self.levels[-1][0]) > FAN:
            pattern, mask = self.levels[-1]
            width = LEAF if len(self.levels) == 1 else FAN
            first = np.arange(0, len(pattern), width)
            run = np.repeat(pattern[first], np.diff([*first, len(pattern)]))
            shared = np.bitwise_and.reduceat(mask & ~(pattern ^ run), first)
            self.levels.append((pattern[first] & shared, shared))
        #: Nodes compared and nodes pruned by searches so far, by level (leaves first).
        self.compared, self.pruned = [0] * len(self.levels), [0] * len(self.levels)

    def search(self, queries: np.ndarray, most: int, places: int | None = None) -> tuple[np.ndarray, np.ndarray] | None:
        """Places (query, code) of all pairs with at most ``most`` differences, by query; None where a step
        would hold more than ``places``."""
        pattern, mask = self.levels[-1]
        query = np.repeat(np.arange(len(queries)), len(pattern))
        node = np.tile(np.arange(len(pattern)), len(queries))
        known = np.zeros(len(query), np.uint64)  # bits that nodes above have compared
        differ = np.zeros(len(query), np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            pattern, mask = self.levels[depth]
            differ = differ + np.bitwise_count((queries[query] ^ pattern[node]) & mask[node] & ~known)
            near = np.nonzero(differ <= most)[0]
            self.compared[depth] += len(query)
            self.pruned[depth] += len(query) - len(near)
            query, node, differ = query[near], node[near], differ[near]
            if not depth:
                break
            known, below = mask[node], len(self.levels[depth - 1][0])
            width = LEAF if depth == 1 else FAN
            size = np.minimum(width, below - node * width)
            if places is not None and size.sum() > places:
                return None
            begin = np.repeat(node * width - np.cumsum(size) + size, size)
            query, known, differ = np.repeat(query, size), np.repeat(known, size), np.repeat(differ, size)
            node = begin + np.arange(len(begin))
        return query, node

    def searches(self, queries: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``search`` over any number of queries, so many at a time that ``FRONTIER`` holds."""
        open_parts = [(i, min(i + 1024, len(queries))) for i in range(0, len(queries), 1024)][::-1]
        while open_parts:
            a, b = open_parts.pop()
            found = self.search(queries[a:b], most, FRONTIER if b - a > 1 else None)
            if found is None:
                open_parts += [((a + b) // 2, b), (a, (a + b) // 2)]
            else:
                yield found[0] + a, found[1]


def roots(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest place of each place's class: the classes of ``label``, joined by the links a - b."""
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


class Block:
    """The codes of one block (by Gray rank) and the classes that searches have found among them."""

    def __init__(self, codes: np.ndarray, max_bits: int):
        self.codes, self.max_bits = codes, max_bits
        self.index, self.label = GrayIndex(codes), np.arange(len(codes))

    def visit(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A link from each query that reaches a code; codes that share a visitor are of one class."""
        u, v = [queries[:0]], [queries[:0]]
        for query, found in self.index.searches(queries, self.max_bits):
            if len(query):
                who, first, which = np.unique(query, return_index=True, return_inverse=True)
                self.label = roots(self.label, found, found[first][which])
                u.append(queries[who])
                v.append(self.codes[found[first]])
        return np.concatenate(u), np.concatenate(v)

    def ties(self) -> tuple[np.ndarray, np.ndarray]:
        tied = np.nonzero(self.label != np.arange(len(self.label)))[0]
        return self.codes[tied], self.codes[self.label[tied]]


def upper_nodes(blocks: DataFrame) -> tuple[np.ndarray, GrayIndex]:
    """The blocks' numbers, and the index over their patterns: at most ``MAX_BLOCKS`` rows."""
    rows = blocks.groupBy("block").agg(F.bit_and("fp").alias("all"), F.bit_or("fp").alias("any")).orderBy("block").collect()
    low, high = (np.array([r[c] for r in rows], np.int64).view(np.uint64) for c in ("all", "any"))
    mask = ~(low ^ high)
    return np.array([r["block"] for r in rows], np.int32), GrayIndex(low & mask, mask)


def links(codes: DataFrame, max_bits: int = MAX_BITS, block_codes: int = BLOCK_CODES, slice_rows: int = SLICE, least_blocks: int = MIN_BLOCKS) -> DataFrame:
    """Links u - v between distinct fingerprints (fp), enough to connect all pairs within reach."""
    spark = ready(codes.sparkSession)
    codes = stored(codes, "simhash-codes")
    count = min(MAX_BLOCKS, max(least_blocks, -(-codes.count() // block_codes)))
    blocks = codes.repartitionByRange(count, gray_order(F.col("fp"))).select(F.spark_partition_id().alias("block"), "fp")
    blocks = stored(blocks, "simhash-blocks")
    upper = spark.sparkContext.broadcast(upper_nodes(blocks))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, index = upper.value
        for batch in batches:
            own = batch.column("block").to_numpy()
            fp = batch.column("fp").to_numpy().view(np.uint64)
            for query, node in index.searches(fp, max_bits):
                later = names[node] > own[query]
                yield pa.record_batch({"block": names[node[later]], "fp": fp[query[later]].view(np.int64)})

    visits = stored(blocks.mapInArrow(route, "block int, fp long"), "simhash-visits")
    slices = F.broadcast(visits.groupBy("block").agg(F.ceil(F.count("*") / F.lit(slice_rows)).cast("int").alias("slices")))  # MAX_BLOCKS rows at most
    slices_or_one = F.coalesce("slices", F.lit(1))
    own = blocks.join(slices, "block", "left").select("block", F.explode(F.sequence(F.lit(0), slices_or_one - 1)).alias("slice"), F.lit(False).alias("visitor"), "fp")
    others = visits.join(slices, "block").select("block", F.pmod(F.xxhash64("fp"), "slices").cast("int").alias("slice"), F.lit(True).alias("visitor"), "fp")
    dealt = own.unionByName(others).repartition("block", "slice").sortWithinPartitions("block", "slice", "visitor", gray_order(F.col("fp")))

    def linked(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch({"u": u.view(np.int64), "v": v.view(np.int64)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by block and slice: the codes first, then their visitors."""
        now, held, block = None, [], None

        def opened() -> Block:
            new = Block(np.concatenate(held), max_bits)
            if now[1] == 0:  # once for each block
                new.visit(new.codes)
            return new

        for batch in batches:
            if not batch.num_rows:
                continue
            numbers = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("block", "slice", "visitor")])
            fp = batch.column("fp").to_numpy().view(np.uint64)
            cuts = np.nonzero((np.diff(numbers) != 0).any(axis=0))[0] + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(fp)]):
                if now != (key := (int(numbers[0, a]), int(numbers[1, a]))):
                    if now is not None:
                        yield linked(*(block or opened()).ties())
                    now, held, block = key, [], None
                if numbers[2, a]:
                    block = block or opened()
                    yield linked(*block.visit(fp[a:b]))
                else:
                    held.append(fp[a:b])
        if now is not None:
            yield linked(*(block or opened()).ties())

    return dealt.mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, words_per_shingle: int = WORDS_PER_SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp (64 bits as a long), root (which names the class) and component_id (smallest doc_id of
    the class) of every row of ``docs`` (doc_id, text)."""
    fps = stored(fingerprints(docs, words_per_shingle), "simhash")
    by_code = fps.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    tied = components(links(fps.select("fp").distinct(), max_bits))
    rooted = by_code.join(tied, by_code["fp"] == tied["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "least", "n")
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = stored(rooted.join(names, "root").select("fp", "root", "component_id", "n"), "simhash-classes")
    spread = F.coalesce(F.xxhash64(F.col("doc_id")), F.lit(0)) + F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).otherwise(0)
    return hot_join(fps, classes, ["fp"], "n", spread).select("doc_id", "fp", "root", "component_id")


def contract(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs.select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
