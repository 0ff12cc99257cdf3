"""Packing by lexical retrieval: windows are filled with a seed document and its BM25 neighbours.

1. Texts become token ids and are stored with an end id (one pass, no shuffle). Each task counts in
   the same pass the documents that hold each term and stores these counts beside its documents.
2. The document frequencies of all terms (token ids, so at most the vocabulary's size) are the sums
   over all tasks and are broadcast: that bound does not grow with the corpus.
3. Documents are routed by content: a sketch of ``SKETCH`` terms, rare ones before common ones, is
   drawn the same way from every document, so those that share their rare terms have the same
   sketch with a probability that grows with the share. The documents are dealt and sorted by the
   whole sketch, then by row, which also splits a sketch that very many share.
4. The inverted index is sharded: each task builds the index of one run of sorted documents after
   the other, each of about ``shard_tokens`` ids. In a shard the first unused document is the seed;
   the unused neighbours of highest BM25 score (all terms of the seed are the query, statistics
   are those of the corpus) fill its window greedily. A document that does not fit is cut at
   the window's end and is the seed of the next window. So every window is full; the rest of a
   shard is cut into lengths that are powers of two, which need no padding.

A seed asks its own shard only: equal documents meet there except at a shard's ends, others as far
as the sketch brings them together (the README has the recall against BM25 over all documents).
The pieces are stored, so that a sequence's id (task, number in the task) is the same in each read.

Inputs: a null text counts as empty; an empty text is the end id alone; a document longer than
a window or a shard is cut over windows, with no limit; equal documents and repeated rows are
packed each (ties in score go to the earlier in the sorted order); a null doc_id is kept; an empty table gives
an empty result; further columns are not read.
"""

from __future__ import annotations

import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histwise.llm.bpe import PRETOKEN, Bpe, slices
from histwise.llm.common import OWN, shared_path, stored, text_or_empty

WINDOW = 2048
SHARD_TOKENS = 1 << 19
END_ID = 1
#: Terms of a document's sketch; shards that a task builds one after the other; seed of the draw.
SKETCH, TASK_SHARDS, SEED = 4, 4, 71
# Usual constants of BM25.
K1, B = 1.2, 0.75


class FastIds:
    """Ids of whole texts, the same as the tokenizers library's, by tiktoken's merge loop.

    tiktoken merges the pair whose token has the lowest number, the library the pair that stands first among
    the merges. Both are one where numbers rise with the merges and every token of more than a byte is
    made by one; another vocabulary is read by ``Bpe``. Special tokens are cut out of a text first."""

    def __init__(self, path: str):
        self.own = Bpe(path)
        made = [token for _, token in sorted(self.own.pairs.values())]
        ranks = {b: i for i, b in self.own.id_bytes.items() if i not in self.own.special.values()}
        rising = all(a < b for a, b in zip([int(self.own.byte_id.max()), *made], made))
        self.encoding = None
        if rising and len(ranks) == 256 + len(made):
            import tiktoken
            self.encoding = tiktoken.Encoding("ids", pat_str=PRETOKEN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if self.encoding is None:
            return self.own.encode(text)
        if not any(token in text for token in self.own.special):
            return self.encoding.encode_ordinary(text)
        parts = [p for p in self.own.splitter.split(text) if p]
        return [i for p in parts for i in ([self.own.special[p]] if p in self.own.special else self.encoding.encode_ordinary(p))]


_LOADED: dict[str, FastIds] = {}


def loaded(path: str) -> FastIds:
    """One vocabulary for each Python worker, which Spark keeps for later tasks."""
    if path not in _LOADED:
        _LOADED[path] = FastIds(path)
    return _LOADED[path]


def greatest(vocabulary: str, end_id: int = END_ID) -> int:
    return max(max(loaded(vocabulary).own.id_bytes), end_id)


def number(vocabulary: str, end_id: int = END_ID) -> str:
    """The numbers in which ids of ``vocabulary`` are stored: two bytes where all fit."""
    return "<u2" if greatest(vocabulary, end_id) < 1 << 16 else "<u4"


TOKENS = "doc_id long, ids binary, term long, n long"


class TermCounts:
    """For each term the number of documents that hold it; term -1: documents, -2: ids in all."""

    def __init__(self, size: int):
        self.counts, self.documents, self.total = np.zeros(size, np.int64), 0, 0
        # marks of one document, and their sums over at most 255 documents
        self.mark, self.recent = np.zeros(size, np.uint8), np.zeros(size, np.uint8)

    def add(self, ids: np.ndarray) -> None:
        self.mark[ids] = 1
        self.recent += self.mark
        self.mark[ids] = 0
        self.documents, self.total = self.documents + 1, self.total + len(ids)
        if self.documents % 255 == 0:
            self.settle()

    def settle(self) -> None:
        self.counts += self.recent
        self.recent[:] = 0

    def rows(self) -> pa.RecordBatch:
        self.settle()
        held = np.nonzero(self.counts)[0]
        term = np.concatenate([held, [-1, -2]]).astype(np.int64)
        n = np.concatenate([self.counts[held], [self.documents, self.total]]).astype(np.int64)
        return pa.record_batch({"doc_id": pa.nulls(len(term), pa.int64()), "ids": pa.nulls(len(term), pa.binary()), "term": term, "n": n})


def tokenize(docs: DataFrame, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """doc_id and ids (little-endian numbers of type ``number``, the end id last) of each document, their term
    null; and each task's ``TermCounts`` as rows (term, n), their ids null. So one pass gives both."""
    stored_as = number(vocabulary, end_id)
    code = np.dtype(stored_as).char

    def packed(ids: list[int]) -> bytes:
        """A list's numbers as bytes; ``array`` reads a list faster than numpy does."""
        out = array(code, ids)
        out.append(end_id)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, counts = loaded(vocabulary).encode, TermCounts(greatest(vocabulary, end_id) + 1)
        for batch in batches:
            for part in slices(batch):
                coded = [packed(encode(t)) for t in part.column("t").to_pylist()]
                for ids in coded:
                    counts.add(np.frombuffer(ids, stored_as))
                none = pa.nulls(len(coded), pa.int64())
                yield pa.record_batch({"doc_id": part.column("doc_id"), "ids": pa.array(coded, pa.binary()), "term": none, "n": none})
        yield counts.rows()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("t")).mapInArrow(run, TOKENS)


def kind(idf: np.ndarray) -> str:
    """The numbers that ids are shuffled as: two bytes where all ids fit."""
    return "<u2" if len(idf) <= 1 << 16 else "<u4"


def routed(tokens: DataFrame, idf: np.ndarray, partitions: int, stored_as: str = "<u4") -> DataFrame:
    """``tokens`` (ids of type ``stored_as``) dealt and sorted by their sketch, the terms of smallest draw: an exponential one for each
    term, the same in all documents, over the square of its idf. The ids are numbers of ``kind``."""
    draws = np.random.default_rng(SEED).exponential(size=(SKETCH, len(idf))) / idf ** 2
    shared, shuffled_as = tokens.sparkSession.sparkContext.broadcast(draws), kind(idf)
    names = [f"{OWN}sketch{i}" for i in range(SKETCH)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draws = shared.value
        for batch in batches:
            found, small = np.empty((SKETCH, batch.num_rows), np.int64), []
            for at, ids in enumerate(batch.column("ids")):
                terms = np.frombuffer(ids.as_buffer(), stored_as)
                for i in range(SKETCH):
                    found[i, at] = terms[draws[i][terms].argmin()]
                if stored_as != shuffled_as:
                    small.append(terms.astype(shuffled_as).tobytes())
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "ids": pa.array(small, pa.binary()) if stored_as != shuffled_as else batch.column("ids"), f"{OWN}row": batch.column(f"{OWN}row"), **dict(zip(names, found))})

    numbered = tokens.withColumn(f"{OWN}row", F.monotonically_increasing_id())
    keyed = numbered.mapInArrow(run, f"doc_id long, ids binary, {OWN}row long, " + ", ".join(f"{n} long" for n in names))
    order = [*names, f"{OWN}row"]
    return keyed.repartitionByRange(partitions, *order).sortWithinPartitions(*order).select("doc_id", "ids")


class Shard:
    """The inverted index of a run of documents."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean: float):
        self.docs = docs
        self.lengths = np.array([len(d) for d in docs], np.int64)
        found = [np.unique(d, return_counts=True) for d in docs]
        self.terms = [t for t, _ in found]
        term = np.concatenate(self.terms)
        tf = np.concatenate([n for _, n in found]).astype(np.float64)
        doc = np.repeat(np.arange(len(docs)), [len(t) for t in self.terms])
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * self.lengths[doc] / mean))
        order = np.argsort(term, kind="stable")
        self.doc, self.weight = doc[order], weight[order]
        self.begin = np.zeros(len(idf) + 1, np.int64)
        np.cumsum(np.bincount(term, minlength=len(idf)), out=self.begin[1:])

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused documents that share a term with the seed, by falling score."""
        terms = self.terms[seed]
        first, size = self.begin[terms], self.begin[terms + 1] - self.begin[terms]
        at = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
        score = np.bincount(self.doc[at], self.weight[at], minlength=len(self.docs))
        score[~unused] = 0
        order = np.argsort(-score, kind="stable")
        return order[:np.count_nonzero(score > 0)]

    def order(self, window: int) -> list[int]:
        """The documents in the order in which they fill the windows."""
        unused = np.ones(len(self.docs), bool)
        out, filled, last = [], 0, None

        def place(d: int) -> None:
            nonlocal filled, last
            out.append(d)
            unused[d] = False
            filled, last = filled + int(self.lengths[d]), d

        for first in range(len(self.docs)):
            while unused[first]:
                if filled % window == 0 or last is None:
                    place(first)
                    continue
                # the document that crossed into this window, or the one that began it
                before, seed = filled // window, last
                for d in self.neighbours(seed, unused):
                    place(int(d))
                    if filled // window != before:
                        break
                else:
                    if unused[first]:  # no neighbour left for this window
                        place(first)
        return out


def cuts(total: int, window: int) -> np.ndarray:
    """Ends of the sequences of a shard: full windows, then falling powers of two."""
    ends = list(range(window, total + 1, window))
    at = total - total % window
    for bit in reversed(range(max(1, window).bit_length())):
        if (total % window) >> bit & 1:
            at += 1 << bit
            ends.append(at)
    return np.array(ends, np.int64)


SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """The pieces of all rows of ``docs`` (doc_id, text): doc_id, start, length, ids (binary, little-endian
    32-bit), doc_tokens, sequence_id and offset (place in the sequence)."""
    spark = docs.sparkSession
    path = shared_path(spark, "packing-tokens")
    tokenize(docs, vocabulary, end_id).write.option("compression", "zstd").parquet(path)
    coded = spark.read.schema(TOKENS).parquet(path)
    tokens = coded.where("term is null").select("doc_id", "ids")
    stored_as = number(vocabulary, end_id)
    counts = {r["term"]: r["n"] for r in coded.where("term is not null").groupBy("term").agg(F.sum("n").alias("n")).collect()}  # at most the vocabulary's size
    documents, total = counts.pop(-1, 0), counts.pop(-2, 0)
    df = np.zeros(max(counts, default=0) + 1)
    df[list(counts)] = list(counts.values())
    idf = np.log1p((documents - df + 0.5) / (df + 0.5))
    shared = spark.sparkContext.broadcast((idf, total / max(1, documents)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        idf, mean = shared.value
        sequence = TaskContext.get().partitionId() << 32
        for names, texts in shards(batches, shard_tokens, kind(idf)):
            shard = Shard(texts, idf, mean)
            order = np.array(shard.order(window), np.int64)
            result, used = pieces(shard, order, window)
            doc, start, length, number, offset = result
            data = [texts[d][s:s + n].tobytes() for d, s, n in zip(doc.tolist(), start.tolist(), length.tolist())]
            yield pa.record_batch({
                "doc_id": pa.array([names[d] for d in doc.tolist()], pa.int64()), "start": start, "length": length, "ids": pa.array(data, pa.binary()),
                "doc_tokens": shard.lengths[doc], "sequence_id": sequence + number, "offset": offset})
            sequence += used

    return stored(routed(tokens, idf, -(-total // (TASK_SHARDS * shard_tokens)) or 1, stored_as).mapInArrow(run, SCHEMA), "packing-pieces", "zstd")


def shards(batches: Iterator[pa.RecordBatch], most: int, kind: str = "<u4") -> Iterator[tuple[list, list[np.ndarray]]]:
    names, texts, size = [], [], 0
    for batch in batches:
        for name, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
            names.append(name)
            texts.append(np.frombuffer(ids.as_py(), kind).astype("<u4", copy=False))
            size += len(texts[-1])
            if size >= most:
                yield names, texts
                names, texts, size = [], [], 0
    if texts:
        yield names, texts


def pieces(shard: Shard, order: np.ndarray, window: int) -> tuple[tuple[np.ndarray, ...], int]:
    """Document, start, length, sequence number and offset of each piece; the number of sequences."""
    lengths = shard.lengths[order]
    ends = np.cumsum(lengths)
    sequence_ends = cuts(int(ends[-1]), window)
    borders = np.union1d(ends, sequence_ends)
    begin = np.concatenate([[0], borders[:-1]])
    at = np.searchsorted(ends, begin, side="right")
    number = np.searchsorted(sequence_ends, begin, side="right")
    sequence_begin = np.concatenate([[0], sequence_ends[:-1]])
    return (order[at], begin - (ends - lengths)[at], borders - begin, number, begin - sequence_begin[number]), len(sequence_ends)
