"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

A word (one pre-token) is a row of symbols. A segment tree holds the merge rank of every
adjacent pair; its root names the leftmost pair of the lowest rank. One merge changes two
neighbouring pairs, so it costs a few point updates of logarithmic length, until the root
says that no mergeable pair is left. A word of n symbols takes O(n log n).

Texts are cut into chunks at spaces that a non-space character follows, which are always borders
of pre-tokens, and a task remembers the ids of the chunks it has seen (bounded; see
``MEMO_CHUNKS``). Texts with a space before white space or the end, or with a special token, are not cut.

Inputs: null text counts as empty; an empty text has no ids; a text of any length is read
whole; repeated rows give repeated results; an empty table gives an empty table; further
columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from histwise.llm.common import text_or_empty

# The byte-level pre-tokenizer pattern of the vocabulary file.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Chunks that a task remembers before it forgets the older half: bounds the memory only.
MEMO_CHUNKS = 1 << 20

NO_PAIR = ROW_NO_PAIR = 1 << 40

#: Largest tree (pairs) of a forest, and words merged at once; longer words get a tree of their own.
FOREST, FOREST_ROWS = 64, 8192


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary: printable
    Latin-1 stands for itself, the others follow from code point 256 on."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(kept)]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(others)}


class PairTree:
    """Minimum segment tree over ranks of adjacent pairs, keyed by (rank, position)."""

    def __init__(self, ranks: list[int]):
        size = 1
        while size < len(ranks):
            size *= 2
        self.size = size
        self.tree = [NO_PAIR] * size + ranks + [NO_PAIR] * (size - len(ranks))
        for i in range(size - 1, 0, -1):
            left, right = self.tree[2 * i], self.tree[2 * i + 1]
            self.tree[i] = left if left <= right else right

    def update(self, position: int, rank: int) -> None:
        tree, i = self.tree, self.size + position
        tree[i] = rank
        i >>= 1
        while i:
            left, right = tree[2 * i], tree[2 * i + 1]
            low = left if left <= right else right
            if tree[i] == low:
                return
            tree[i] = low
            i >>= 1

    def leftmost(self) -> int:
        """Position of the lowest rank, the leftmost of equal ones; -1 without a pair."""
        tree, low = self.tree, self.tree[1]
        if low == NO_PAIR:
            return -1
        i = 1
        while i < self.size:
            i = 2 * i if tree[2 * i] == low else 2 * i + 1
        return i - self.size


class Forest:
    """Segment trees of many short words at once: a row of each matrix is one word."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]]):
        order = sorted((a << 32 | b, rank, made) for (a, b), (rank, made) in pairs.items())
        self.keys = np.array([k for k, _, _ in order] + [1 << 62], np.int64)
        self.ranks = np.array([r for _, r, _ in order] + [ROW_NO_PAIR], np.int64)
        self.made = np.zeros(max((r for _, r, _ in order), default=0) + 1, np.int64)
        for _, rank, made in order:
            self.made[rank] = made

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge ranks of symbol pairs; a symbol of -1 is none."""
        key = np.where((a < 0) | (b < 0), -1, a << 32 | b)
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], ROW_NO_PAIR)

    def merge(self, symbols: np.ndarray) -> np.ndarray:
        """Rows of symbols, padded with -1 to 2**k + 1 columns, after all merges; merged-away
        symbols are -1."""
        rows, width = symbols.shape
        size = width - 1
        symbols = np.hstack([symbols, np.full((rows, 1), -1, np.int64)])  # column of "no symbol"
        tree = np.full((rows, 2 * size), ROW_NO_PAIR, np.int64)
        tree[:, size:] = self.rank(symbols[:, :size], symbols[:, 1:width])
        level = size // 2
        while level:
            tree[:, level:2 * level] = np.minimum(tree[:, 2 * level:4 * level:2], tree[:, 2 * level + 1:4 * level:2])
            level //= 2
        after = np.tile(np.minimum(np.arange(1, width + 2), width), (rows, 1))
        before = np.tile(np.arange(-1, width), (rows, 1))
        live = np.nonzero(tree[:, 1] < ROW_NO_PAIR)[0]
        while live.size:
            low = tree[live, 1]
            node = np.ones(live.size, np.int64)
            while node[0] < size:
                node = 2 * node + (tree[live, 2 * node] != low)
            i = node - size
            j = after[live, i]
            k, h, made = after[live, j], before[live, i], self.made[low]
            symbols[live, i], symbols[live, j], after[live, i], before[live, k] = made, -1, k, i
            self.update(tree, live, j, np.full(live.size, ROW_NO_PAIR), j < size)
            self.update(tree, live, i, self.rank(made, symbols[live, k]), i < size)
            self.update(tree, live, h, self.rank(symbols[live, h], made), h >= 0)
            live = live[tree[live, 1] < ROW_NO_PAIR]
        return symbols[:, :width]

    @staticmethod
    def update(tree: np.ndarray, live: np.ndarray, position: np.ndarray, rank: np.ndarray, where: np.ndarray) -> None:
        rows, node = live[where], position[where] + tree.shape[1] // 2
        if not rows.size:
            return
        tree[rows, node] = rank[where]
        while node[0] > 1:
            node = node >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])


class Bpe:
    """A byte-level BPE vocabulary file of the tokenizers format. Ids are kept as bytes of
    little-endian 32-bit numbers, so that the ids of a text are a join of those of its chunks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        alphabet = byte_alphabet()
        back = {c: b for b, c in alphabet.items()}
        self.byte_id = np.array([vocab[alphabet[b]] for b in range(256)], np.int64)
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.pairs[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.forest = Forest(self.pairs)
        self.id_bytes: dict[int, bytes] = {
            i: bytes(back[c] for c in token) for token, i in vocab.items() if i not in self.special.values()}
        self.id_bytes |= {i: token.encode() for token, i in self.special.items()}
        self.id_text = {i: str(i) for i in self.id_bytes}
        self.pretokens: Callable[[str], list[str]] = regex.compile(PRETOKEN).findall
        self.splitter = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # the memo before this one, still asked

    def merge(self, word: str) -> list[int]:
        """The ids of one pre-token by a segment tree of its own."""
        symbols = self.byte_id[np.frombuffer(word.encode(), np.uint8)].tolist()
        n, pairs = len(symbols), self.pairs
        if n < 2:
            return symbols
        known = pairs.get
        tree = PairTree([p[0] if (p := known(pair)) else NO_PAIR for pair in zip(symbols, symbols[1:])])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (i := tree.leftmost()) >= 0:
            j = after[i]
            symbols[i] = pairs[symbols[i], symbols[j]][1]
            symbols[j] = -1
            after[i] = k = after[j]
            if j < n - 1:
                tree.update(j, NO_PAIR)
            if k < n:
                before[k] = i
                tree.update(i, p[0] if (p := known((symbols[i], symbols[k]))) else NO_PAIR)
            elif i < n - 1:
                tree.update(i, NO_PAIR)
            h = before[i]
            if h >= 0:
                tree.update(h, p[0] if (p := known((symbols[h], symbols[i]))) else NO_PAIR)
        return [s for s in symbols if s >= 0]

    def words(self, words: list[str]) -> list[bytes]:
        """The ids of pre-tokens: short ones in forests of one tree size each."""
        out: list[bytes] = [b""] * len(words)
        groups: dict[int, list[int]] = {}
        coded = [w.encode() for w in words]
        for at, w in enumerate(coded):
            groups.setdefault(max(2, 1 << (len(w) - 2).bit_length()) if 2 <= len(w) <= FOREST + 1 else len(w) if len(w) < 2 else 0, []).append(at)
        for size, members in groups.items():
            if size < 2:
                for at in members:
                    out[at] = array("i", self.merge(words[at])).tobytes()
                continue
            for i in range(0, len(members), FOREST_ROWS):
                some = members[i:i + FOREST_ROWS]
                raw = b"".join(coded[at].ljust(size + 1, b"\0") for at in some)
                symbols = self.byte_id[np.frombuffer(raw, np.uint8)].reshape(len(some), size + 1)
                length = np.array([len(coded[at]) for at in some])
                symbols = np.where(np.arange(size + 1) < length[:, None], symbols, -1)
                merged = self.forest.merge(symbols).astype("<i4")
                flat, ends = merged[merged >= 0].tobytes(), np.cumsum(4 * (merged >= 0).sum(1)).tolist()
                begin = 0
                for at, end in zip(some, ends):
                    out[at] = flat[begin:end]
                    begin = end
        return out

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of whole texts."""
        memo, rows, missing, whole = self.memo, [], set(), set()
        for text in texts:
            head, rest = self.pieces(text)
            found = list(map(memo.get, rest))
            if None in found:
                own = {x for x, ids in zip(rest, found) if ids is None}
                if any(not x or x[0].isspace() for x in own):  # never remembered, so never missed here
                    head, rest, found = self.pretokens(text), [], []
                else:
                    missing |= own
            whole.update(head)
            rows.append((head, rest, found))
        fresh = {x: self.older[x] for x in missing if x in self.older}
        fresh |= self.chunks(list(missing - fresh.keys()))
        plain = list(whole - self.special.keys())
        ids = dict(zip(plain, self.words(plain)))
        ids |= {x: array("i", [i]).tobytes() for x, i in self.special.items()}
        out = [b"".join([ids[w] for w in head]) + b"".join([fresh[x] if c is None else c for x, c in zip(rest, found)])
               for head, rest, found in rows]
        if len(memo) + len(fresh) > MEMO_CHUNKS // 2:
            self.older, self.memo = memo, {}
        self.memo.update((x, c) for x, c in fresh.items() if len(x) <= 64)
        return out

    def chunks(self, chunks: list[str]) -> dict[str, bytes]:
        """The ids of chunks that each follow a space."""
        split = {x: self.pretokens(" " + x) for x in chunks}
        words = list({w for row in split.values() for w in row})
        ids = dict(zip(words, self.words(words)))
        return {x: b"".join([ids[w] for w in row]) for x, row in split.items()}

    def pieces(self, text: str) -> tuple[list[str], list[str]]:
        """Pre-tokens and special tokens of a text's beginning, and the chunks after it that
        each follow a space; the ids of neither depend on their neighbours."""
        if self.splitter and self.splitter.search(text):
            return [w for part in self.splitter.split(text) if part
                    for w in ([part] if part in self.special else self.pretokens(part))], []
        first, *rest = text.split(" ")
        return self.pretokens(first), rest

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_batch([text])[0], "<i4").tolist()

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.id_bytes.__getitem__, ids)).decode("utf-8", "replace")


_LOADED: dict[str, Bpe] = {}


def loaded(path: str) -> Bpe:
    """One vocabulary for each Python worker, which Spark keeps for later tasks."""
    if path not in _LOADED:
        _LOADED[path] = Bpe(path)
    return _LOADED[path]


SCHEMA = "doc_id long, ids array<int>, decoded string"


def encode_decode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, ids and the text decoded from the ids, one row per row of ``docs`` (doc_id,
    text), in one pass without a shuffle. ``vocabulary``: the file's path on the workers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(vocabulary)
        for batch in batches:
            for part in slices(batch):
                ids = [np.frombuffer(x, "<i4") for x in bpe.encode_batch(part.column("t").to_pylist())]
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                yield pa.record_batch({
                    "doc_id": part.column("doc_id"),
                    "ids": pa.ListArray.from_arrays(ends, np.concatenate(ids)),
                    "decoded": pa.array([bpe.decode(x.tolist()) for x in ids], pa.string())})

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty().alias("t")).mapInArrow(run, SCHEMA)


def slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Short runs of a batch's rows, so that what a task holds as Python objects stays small."""
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """n_tokens and the SHA-256 of the ids and of the decoded text for every document.

    The digests are taken where the ids are made: the ids of the corpus take several times
    its stored size, and nothing but the digests would be read of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(vocabulary)
        text = bpe.id_text.__getitem__
        for batch in batches:
            for part in slices(batch):
                count, of_ids, of_text = [], [], []
                for coded in bpe.encode_batch(part.column("t").to_pylist()):
                    ids = np.frombuffer(coded, "<i4").tolist()
                    count.append(len(ids))
                    of_ids.append(hashlib.sha256(",".join(map(text, ids)).encode()).hexdigest())
                    of_text.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
                yield pa.record_batch({"doc_id": part.column("doc_id"), "n_tokens": pa.array(count, pa.int64()), "ids_sha256": of_ids, "decoded_sha256": of_text})

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty().alias("t")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
