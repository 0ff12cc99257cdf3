"""Phrase collocations by prefix-free parsing.

1. Texts are cut into pieces at punctuation and line ends, pieces into words. Inside a piece, a
   window of ``max_words - 1`` words whose hash is 0 modulo ``modulus`` ends a chunk and starts the
   next one, so neighbours overlap by that window. Cuts depend on the words alone: equal passages
   give equal chunks wherever they stand.
2. The dictionary has each distinct chunk of a language once, with its parse frequency (combined
   before the shuffle, so a passage that a third of all documents share is one row for each task).
3. n-grams are counted inside distinct chunks, weighted by frequency. A chunk owns the starts in
   front of its closing window, the last of a piece owns all; so each occurrence counts once, and
   an n-gram that starts at an owned word always lies whole in the chunk.
4. Pairs are first summed by a 64-bit hash. A phrase of ``min_count`` occurrences holds only pairs
   that reach the sum, so a filter of these pairs spares the shuffle of the others; hash collisions
   only let more through. The filter has 16 bits for each such pair, at most ``MAX_BITS`` in all;
   beyond that bound it passes more phrases on to the exact count, whose result is the same.
5. Counts of words and of the remaining phrases are exact, by the phrase itself. Scores come from
   joins of the frequent phrases with the counts of their parts; a part that many phrases share
   ("the") is joined apart (``hot_join``).

Inputs: null text is empty and has no words; a null lang is ``und``; an empty lang is a language of
its own; words of any length count; texts of any length are read whole; repeated rows count each;
equal scores go by count, then by phrase (UTF-8 bytes); an empty table gives an empty result;
further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from histwise.llm.common import hot_join, ready, stored, text_or_empty

MODULUS = 16
#: Upper bound of the filter of frequent pairs: 64 MiB.
MAX_BITS = 1 << 29
PROBES = 4
#: Bytes of text that a task takes apart at once (one longer text goes by itself).
RUN_BYTES = 4 << 20

# What ends a piece, what stands between words.
BREAKS = b".,;:!?\n\x0b\x0c\r"
SPACES = b" \t"

KIND = np.zeros(256, np.uint8)
KIND[list(SPACES)] = 1
KIND[list(BREAKS)] = 2
LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
MIX = np.uint64(0x9E3779B97F4A7C15)


class Words:
    """The words of the texts of an Arrow string column, in order.

    ``ids`` and ``names``: dictionary-coded words; ``row``: the text of each word; ``first``: whether
    the word starts a piece."""

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        kind = KIND[data]
        inside = kind == 0
        filled = offsets[1:] > offsets[:-1]
        heads = inside.copy()
        heads[1:] &= ~inside[:-1]
        begin = offsets[:-1][filled]
        heads[begin] = inside[begin]
        tails = inside.copy()
        tails[:-1] &= ~inside[1:]
        last = offsets[1:][filled] - 1
        tails[last] = inside[last]
        starts, ends = np.flatnonzero(heads), np.flatnonzero(tails) + 1
        self.row = np.searchsorted(offsets[1:], starts, "right")
        piece = np.cumsum(kind == 2)[starts] + self.row if len(starts) else starts
        self.first = np.ones(len(starts), bool)
        self.first[1:] = piece[1:] != piece[:-1]
        at = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        kept = np.ascontiguousarray(LOWER[data[inside]])
        coded = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at.tobytes()), pa.py_buffer(kept.tobytes())).dictionary_encode()
        self.ids = np.asarray(coded.indices.to_numpy(zero_copy_only=False), np.int64)
        self.names = coded.dictionary

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        own = np.fromiter((xxhash.xxh64_intdigest(w) for w in self.names.to_pylist()), np.uint64, len(self.names))
        return own[self.ids] if len(own) else np.zeros(0, np.uint64)

    def phrases(self, at: np.ndarray, n: int) -> pa.Array:
        """The ``n`` words from each of ``at``, joined by spaces."""
        return pc.binary_join_element_wise(*[self.names.take(pa.array(self.ids[at + j])) for j in range(n)], pa.scalar(" ", pa.large_string())).cast(pa.string())


def mixed(state: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a run of words and one word more."""
    x = (state ^ word) * MIX
    x ^= x >> np.uint64(32)
    return (x + word) * MIX


def together(new: np.ndarray, n: int) -> np.ndarray:
    """For each word, whether the ``n - 1`` words after it belong to its run (``new`` starts runs)."""
    run = np.cumsum(new)
    out = np.zeros(len(new), bool)
    if len(new) >= n:
        out[:len(new) - n + 1] = run[:len(new) - n + 1] == run[n - 1:]
    return out


def shifted(values: np.ndarray, by: int) -> np.ndarray:
    """``values`` from ``by`` places on, padded with zeros."""
    return np.concatenate([values[by:], np.zeros(min(by, len(values)), values.dtype)])


def parse(texts: pa.Array, max_words: int, modulus: int) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The chunks of ``texts``: row, words joined by spaces, number of owned starts."""
    w = Words(texts)
    n, window = len(w.ids), max_words - 1
    h = w.hashes()
    state = np.zeros(n, np.uint64)
    for j in range(window):
        state = mixed(state, shifted(h, j))
    cut = (state >> np.uint64(7)) % np.uint64(modulus) == 0
    cut &= together(w.first, window) & ~w.first
    starts = np.flatnonzero(w.first | cut)
    after = np.append(starts[1:], n)
    final = np.append(w.first, True)[after]
    ends = np.where(final, after, after + window)
    sizes = ends - starts
    at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    places = np.arange(at[-1]) + np.repeat(starts - at[:-1], sizes)
    lists = pa.LargeListArray.from_arrays(pa.array(at), w.names.take(pa.array(w.ids[places])))
    return w.row[starts], pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string()), after - starts


def runs(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows of some ``RUN_BYTES`` of text."""
    size = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        done = size[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(size, done + RUN_BYTES, "right")))
        yield batch.slice(at, to - at)
        at = to


def gathered(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The rows of short batches in runs of some ``RUN_BYTES`` of text, so that equal words meet in one run."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(column).nbytes
        if size >= RUN_BYTES:
            yield from runs(pa.Table.from_batches(held).combine_chunks().to_batches()[0], column)
            held, size = [], 0
    if size:
        yield from runs(pa.Table.from_batches(held).combine_chunks().to_batches()[0], column)


def summed(keys: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the first place of each, and the sums of their ``f``."""
    found, at, back = np.unique(keys, return_index=True, return_inverse=True)
    n = np.zeros(len(found), np.int64)
    np.add.at(n, back, f)
    return found, at, n


def dictionary(docs: DataFrame, max_words: int = 3, modulus: int = MODULUS) -> DataFrame:
    """lang, chunk, owned (starts that it owns) and f (times it was parsed) of each distinct chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in runs(batch, "t"):
                row, chunk, owned = parse(part.column("t"), max_words, modulus)
                yield pa.record_batch({"lang": part.column("lang").take(pa.array(row)), "chunk": chunk, "owned": pa.array(owned, pa.int32())})

    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_or_empty().alias("t"))
    return texts.mapInArrow(run, "lang string, chunk string, owned int").groupBy("lang", "chunk", "owned").agg(F.count("*").alias("f"))


class Chunks(Words):
    """The words of dictionary rows, with what belongs to each word's chunk."""

    def __init__(self, part: pa.RecordBatch):
        super().__init__(part.column("chunk"))
        self.f = part.column("f").to_numpy()[self.row]
        lang = part.column("lang").dictionary_encode()
        self.langs, self.lang = lang.dictionary, lang.indices.to_numpy(zero_copy_only=False)[self.row]
        heads = np.flatnonzero(self.first)
        place = np.arange(len(self.ids)) - np.repeat(heads, np.diff(np.append(heads, len(self.ids))))
        self.own = place < part.column("owned").to_numpy()[self.row]

    def pairs(self) -> np.ndarray:
        """A hash of (lang, word, next word) at each word."""
        seeds = np.fromiter((xxhash.xxh64_intdigest(x, seed=1) for x in self.langs.to_pylist()), np.uint64, len(self.langs))
        h = self.hashes()
        return mixed(mixed(seeds[self.lang] if len(h) else h, h), shifted(h, 1))


def frequent_pairs(chunks: DataFrame, min_count: int) -> DataFrame:
    """Hashes (h) of pairs that sum to ``min_count`` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in gathered(batches, "chunk"):
            w = Chunks(part)
            at = np.flatnonzero(w.own & together(w.first, 2))
            found, _, n = summed(w.pairs()[at], w.f[at])
            yield pa.record_batch({"h": found.view(np.int64), "n": n})

    return chunks.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count).select("h")


def probes(h: np.ndarray, bits: int) -> np.ndarray:
    one, two = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return (one[:, None] + two[:, None] * np.arange(PROBES, dtype=np.uint64)) & np.uint64(bits - 1)


def pair_filter(pairs: DataFrame) -> np.ndarray:
    """A Bloom filter over ``pairs`` (h), as words of 64 bits."""
    bits = min(MAX_BITS, 1 << max(16, (16 * pairs.count() - 1).bit_length()))
    h = F.col("h")
    place = F.explode(F.array(*[(h.bitwiseAND(F.lit(0xFFFFFFFF)) + F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1)) * j).bitwiseAND(F.lit(bits - 1)) for j in range(PROBES)]))
    words = pairs.select(place.alias("p")).select(F.shiftright("p", 6).alias("i"), F.expr("shiftleft(1L, cast(p & 63 as int))").alias("b"))
    out = np.zeros(bits // 64, np.int64)
    found = words.groupBy("i").agg(F.bit_or("b").alias("b")).toArrow()  # bits / 64 rows at most
    out[found.column("i").to_numpy()] = found.column("b").to_numpy()
    return out.view(np.uint64)


def phrase_counts(chunks: DataFrame, held: np.ndarray, min_count: int, max_words: int) -> DataFrame:
    """lang, phrase, words (their number) and f of every phrase of up to ``max_words`` words with
    ``min_count`` occurrences or more."""
    shared = chunks.sparkSession.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = shared.value
        for part in gathered(batches, "chunk"):
            w = Chunks(part)
            at = probes(w.pairs(), len(filled) * 64)
            good = w.own.copy()
            maybe = ((filled[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)
            # a number for each (lang, first words) of the run; the next word makes it the next length's
            key = w.lang.astype(np.int64) * len(w.names) + w.ids
            for n in range(1, max_words + 1):
                at = np.flatnonzero(good & together(w.first, n))
                if not len(at):
                    break
                _, one, f = summed(key[at], w.f[at])
                one = at[one]
                yield pa.record_batch({
                    "lang": w.langs.take(pa.array(w.lang[one])), "phrase": w.phrases(one, n), "words": pa.array(np.full(len(one), n, np.int32)), "f": f})
                good &= shifted(maybe, n - 1)
                key = np.unique(key, return_inverse=True)[1] * len(w.names) + shifted(w.ids, n)

    rows = chunks.mapInArrow(run, "lang string, phrase string, words int, f long")
    return rows.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f")).where(F.col("f") >= min_count)


def parts_of(candidates: DataFrame) -> DataFrame:
    """A row for each way to cut a candidate: k (words of the first part), first, rest."""
    cut = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    return cut.withColumn("first", F.expr("substring_index(phrase, ' ', k)")).withColumn("rest", F.expr("substring(phrase, length(first) + 2)"))


def collocations(docs: DataFrame, max_words: int = 3, min_count: int = 10, share: int = 50, modulus: int = MODULUS) -> DataFrame:
    """Phrases of 2 to ``max_words`` words with ``min_count`` occurrences or more: lang, phrase, words,
    a (occurrences), l and r (of the parts of the lowest-scoring cut), n (words of the language) and
    score. A phrase goes if a longer one with at least ``share`` per cent of its count holds it."""
    ready(docs.sparkSession)
    chunks = stored(dictionary(docs, max_words, modulus), "phrase-chunks", "zstd")
    pairs = stored(frequent_pairs(chunks, min_count), "phrase-pairs")
    counts = stored(phrase_counts(chunks, pair_filter(pairs), min_count, max_words), "phrase-counts")
    n = chunks.groupBy("lang").agg(F.sum(F.col("owned") * F.col("f")).alias("n"))
    candidates = counts.where("words >= 2")
    halves = parts_of(candidates).withColumn("half", F.explode(F.array(F.struct(F.lit(True).alias("left"), F.col("first").alias("part")), F.struct(F.lit(False).alias("left"), F.col("rest").alias("part")))))
    halves = halves.select("lang", "phrase", "words", "f", "k", "half.left", "half.part")
    asked = halves.groupBy("lang", "part").agg(F.count("*").alias("asked"))
    of_part = stored(counts.select("lang", F.col("phrase").alias("part"), F.col("f").alias("of_part")).join(asked, ["lang", "part"]), "phrase-parts")
    halves = hot_join(halves, of_part, ["lang", "part"], "asked", F.xxhash64("phrase", "k"))
    cuts = halves.groupBy("lang", "phrase", "words", "f", "k").agg(*[F.max(F.when(F.col("left") == side, F.col("of_part"))).alias(name) for side, name in ((True, "l"), (False, "r"))])
    for c in ("f", "l", "r"):
        cuts = cuts.withColumn(f"wide_{c}", F.col(c).cast("decimal(38,0)"))
    cuts = cuts.withColumn("score", F.expr("(1000000 * wide_f * wide_f) div (wide_l * wide_r)"))
    best = cuts.groupBy("lang", "phrase", "words", F.col("f").alias("a")).agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = candidates.where("words >= 3").select(
        "lang", "f", F.explode(F.expr("flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1), s -> array_join(slice(split(phrase, ' '), s, m), ' '))))")).alias("phrase"))
    longer = inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = best.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * share))
    return kept.join(n, "lang").select("lang", "phrase", "words", "a", "cut.l", "cut.r", "n", F.col("cut.score").alias("score"))


def contract(docs: DataFrame, first: int = 2000) -> DataFrame:
    """The ``first`` phrases of each language by score."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = collocations(docs).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, list_filter(string_split_regex(unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')), '[\x20\x09]+'), lambda x: x <> '') AS w FROM d),
c AS (SELECT lang, len(g) AS words, array_to_string(g, ' ') AS phrase, count(*) AS f
      FROM (SELECT lang, unnest(flatten(list_transform(range(1, 4), lambda m: list_transform(range(1, len(w) - m + 2), lambda s: w[s:s + m - 1])))) AS g FROM p)
      GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM c WHERE words = 1 GROUP BY lang),
q AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM c WHERE words >= 2 AND f >= 10),
k AS (SELECT q.*, unnest(range(1, words)) AS k FROM q),
s AS (SELECT k.lang, k.phrase, k.words, k.a, k.w, k.k, x.f AS l, y.f AS r,
             (1000000::HUGEINT * k.a * k.a) // (x.f::HUGEINT * y.f) AS score
      FROM k JOIN c x ON x.lang = k.lang AND x.phrase = array_to_string(k.w[1:k.k], ' ')
             JOIN c y ON y.lang = k.lang AND y.phrase = array_to_string(k.w[k.k + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
g AS (SELECT lang, phrase, max(a) AS longer
      FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM q WHERE words = 3) GROUP BY ALL),
o AS (SELECT b.* FROM b LEFT JOIN g ON g.lang = b.lang AND g.phrase = b.phrase WHERE g.longer IS NULL OR 100 * g.longer < 50 * b.a),
z AS (SELECT o.*, n.n, row_number() OVER (PARTITION BY o.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM o JOIN n ON n.lang = o.lang)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM z WHERE rank <= 2000
"""
