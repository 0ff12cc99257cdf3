"""Removal of lines that many documents share, with two Bloom filters before the shuffle.

0. The filters' size follows the data: at least ``BITS_PER_KEY`` bits for each distinct line (an
   estimate by ``approx_count_distinct``, partially aggregated), up to ``MOST_BITS``.
1. Every task reads its texts and keeps two filters over the hashes of line keys: keys seen
   once, and keys seen in a second document (both halves of a pair set the second filter).
   Filters of two tasks merge to (A | B, T | U | A & B): a key that both hold is in A & B, so no
   repeat is lost. They travel as compressed pieces and are merged piece by piece.
2. The merged "seen twice" filter has ``bits`` / 8 bytes, at most ``MOST_BITS`` / 8, and is broadcast. Only
   keys that it holds are suspects; only these are shuffled, with their documents.
3. Suspects are counted exactly, by the key itself (partial counts before the shuffle, so a key
   of a third of all documents is one row for each task), and the first occurrence is chosen.
4. Dropped keys are joined back with a salt and end as one list for each document.

A filter that is too small for a corpus lets more suspects through; the result is the same. At
``BITS_PER_KEY`` 8 and many tasks, each bit of a key seen once is set in the second filter if another key set it in
another task, with 1 - e^-(HASHES / 8) at most, so at most 0.39 ** HASHES = 2.4 % of these keys are suspects, until
the size reaches ``MOST_BITS``; beyond that the share grows.

Inputs: a null or empty text is one empty line; texts of any length are read whole; empty keys
are never dropped while ``min_chars`` is at least 1; each row counts as a document, so repeated
rows count each; rows with a null doc_id take part like others; first occurrence: smallest
(doc_id, line), so rows that repeat the first document's id keep the line as well; an empty
table gives an empty result; further columns are kept as they are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from histwise.llm.bpe import slices
from histwise.llm.common import OWN, ready, stored, text_or_empty

BITS_PER_KEY = 8
#: 128 MiB to broadcast and twice that in a task that fills: enough for 134 million distinct lines.
MOST_BITS = 1 << 30
HASHES = 4
PIECE = 1 << 16
#: Shares into which the documents of one dropped key are dealt for the join.
SALTS = 16

# The white space that a key loses at both ends.
SPACE = b" \t\n\x0b\x0c\r"


def keys_of(text: str) -> list[bytes]:
    """The key of each line: UTF-8, stripped, A-Z in lower case."""
    return [line.strip(SPACE) for line in text.encode().lower().split(b"\n")]


def places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The filter's bits of each hash (double hashing)."""
    one, two = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    return ((one[:, None] + two[:, None] * np.arange(HASHES, dtype=np.uint64)) & np.uint64(bits - 1)).astype(np.int64)


def long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (min_chars <= 1 or len(key.decode()) >= min_chars)


def distinct_keys(text: str, min_chars: int) -> dict[bytes, int]:
    """Keys of a text that count, each with its first line."""
    out: dict[bytes, int] = {}
    for at, key in enumerate(keys_of(text)):
        if key not in out and long_enough(key, min_chars):
            out[key] = at
    return out


def hashed(keys: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys))


def filter_bits(texts: DataFrame) -> int:
    """The size of the filters for ``texts`` (t): a power of two."""
    lines = texts.select(F.explode(F.split("t", "\n")).alias("line"))
    count = lines.agg(F.approx_count_distinct(F.xxhash64("line"), 0.02)).first()[0] or 0
    return min(MOST_BITS, max(PIECE, 1 << (BITS_PER_KEY * count - 1).bit_length() if count else 0))


class Bits:
    """A set of bits, eight in a byte."""

    def __init__(self, bits: int):
        self.bytes = np.zeros(bits // 8, np.uint8)

    def add(self, at: np.ndarray) -> None:
        np.bitwise_or.at(self.bytes, at >> 3, np.uint8(128) >> (at & 7).astype(np.uint8))

    def has(self, at: np.ndarray) -> np.ndarray:
        return held(self.bytes, at)


def held(packed: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which bits of ``at`` are set (highest bit of a byte first)."""
    return (packed[at >> 3] & (np.uint8(128) >> (at & 7).astype(np.uint8))) != 0


def twice_filter(texts: DataFrame, bits: int, min_chars: int) -> bytes:
    """The filter of keys that at least two rows of ``texts`` (t) hold, ``bits`` / 8 bytes."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = Bits(bits), Bits(bits)
        for batch in batches:
            for part in slices(batch):
                found, count = np.unique(hashed([k for t in part.column("t").to_pylist() for k in distinct_keys(t, min_chars)]), return_counts=True)
                at = places(found, bits)
                twice.add(at[(count > 1) | once.has(at).all(axis=1)].ravel())
                once.add(at.ravel())
        one, two = once.bytes, twice.bytes
        size = PIECE // 8
        for piece in range(len(one) // size):
            a, b = one[piece * size:(piece + 1) * size], two[piece * size:(piece + 1) * size]
            if a.any():
                yield pa.record_batch({"piece": pa.array([piece], pa.int32()), "once": [zlib.compress(a.tobytes(), 1)], "twice": [zlib.compress(b.tobytes(), 1)]})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by piece; one piece is held at a time."""
        now, once, twice = None, None, None
        for batch in batches:
            for piece, a, b in zip(*(batch.column(c).to_pylist() for c in ("piece", "once", "twice"))):
                a, b = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (a, b))
                if piece != now:
                    if now is not None and twice.any():
                        yield pa.record_batch({"piece": pa.array([now], pa.int32()), "twice": [zlib.compress(twice.tobytes(), 1)]})
                    now, once, twice = piece, a, b
                else:
                    once, twice = once | a, twice | b | (once & a)
        if now is not None and twice.any():
            yield pa.record_batch({"piece": pa.array([now], pa.int32()), "twice": [zlib.compress(twice.tobytes(), 1)]})

    parts = texts.mapInArrow(fill, "piece int, once binary, twice binary")
    merged = parts.repartition("piece").sortWithinPartitions("piece").mapInArrow(merge, "piece int, twice binary")
    out = bytearray(bits // 8)
    for row in merged.collect():  # bits / 8 bytes at most, whatever the corpus
        out[row["piece"] * PIECE // 8:(row["piece"] + 1) * PIECE // 8] = zlib.decompress(row["twice"])
    return bytes(out)


def suspects(docs: DataFrame, seen_twice: bytes, bits: int, min_chars: int) -> DataFrame:
    """id, key and first line of every key that may be in two documents."""
    shared = docs.sparkSession.sparkContext.broadcast(seen_twice)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            for part in slices(batch):
                ids, keys, lines = [], [], []
                for i, t in zip(part.column("id").to_pylist(), part.column("t").to_pylist()):
                    own = distinct_keys(t, min_chars)
                    ids += [i] * len(own)
                    keys += own.keys()
                    lines += own.values()
                if keys:
                    maybe = np.nonzero(held(packed, places(hashed(keys), bits)).all(axis=1))[0].tolist()
                    yield pa.record_batch({"id": pa.array([ids[i] for i in maybe], pa.int64()), "key": pa.array([keys[i] for i in maybe], pa.binary()), "line": pa.array([lines[i] for i in maybe], pa.int32())})

    return docs.mapInArrow(run, "id long, key binary, line int")


def without(text: pa.Array, dropped: pa.Array) -> pa.Array:
    """The text without the lines of dropped keys (key, line that stays or -1)."""
    out = []
    for t, gone in zip(text.to_pylist(), dropped.to_pylist()):
        lines = t.split("\n")
        if gone:
            stays = {g["key"]: g["stays"] for g in gone}
            kept = [line for at, (line, key) in enumerate(zip(lines, keys_of(t))) if stays.get(key, at) == at]
            out.append({"kept": "\n".join(kept), "n_lines": len(lines), "n_dropped": len(lines) - len(kept)})
        else:
            out.append({"kept": t, "n_lines": len(lines), "n_dropped": 0})
    return pa.array(out, pa.struct({"kept": pa.string(), "n_lines": pa.int64(), "n_dropped": pa.int64()}))


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False, bits: int | None = None) -> DataFrame:
    """``docs`` (doc_id, text, ...) with the column ``__llm_lines``, a struct of kept (text), n_lines and
    n_dropped. Keys in at least ``min_docs`` rows lose their lines, all of them or, with
    ``keep_first``, all but the first occurrence. ``bits``: size of the filters, by default from the data."""
    if bits is not None and (bits & (bits - 1) or bits < PIECE):
        raise ValueError(f"bits must be a power of two from {PIECE} on")
    ready(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), text_or_empty().alias("t"))
    bits = bits or filter_bits(rows)
    maybe = stored(suspects(rows, twice_filter(rows.select("t"), bits, min_chars), bits, min_chars), "line-suspects")
    dropped = (maybe.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("id", "line")).alias("first"))
               .where(F.col("n") >= min_docs)
               .select("key", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    stays = F.when(F.lit(keep_first) & F.col("id").eqNullSafe(F.col("first.id")), F.col("first.line")).otherwise(F.lit(-1))
    by_doc = (maybe.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
              .join(dropped, ["key", "salt"])
              .groupBy("id").agg(F.collect_set(F.struct("key", stays.alias("stays"))).alias(f"{OWN}dropped"))
              .withColumnRenamed("id", f"{OWN}id"))
    joined = docs.join(by_doc, docs["doc_id"].cast("long").eqNullSafe(by_doc[f"{OWN}id"]), "left")
    return joined.withColumn(f"{OWN}lines", arrow_udf(without, "struct<kept: string, n_lines: long, n_dropped: long>")(text_or_empty(), F.col(f"{OWN}dropped"))).drop(f"{OWN}id", f"{OWN}dropped")


def digests(docs: DataFrame) -> DataFrame:
    """The contract's columns for every row."""
    lines = dedup_lines(docs.select("doc_id", "text"))
    return lines.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"{OWN}lines.n_lines").alias("n_lines"), F.col(f"{OWN}lines.n_dropped").alias("n_dropped"), F.sha2(F.col(f"{OWN}lines.kept"), 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
gone AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
f AS (SELECT k.*, gone.key IS NOT NULL AS dropped FROM k LEFT JOIN gone ON k.key = gone.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM f GROUP BY r
"""
