"""BPE, packing, line dedup, SimHash and exact dedup against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from paths import SF01
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from histwise.llm import bpe, exact_dedup, line_dedup, packing, simhash
from histwise.llm.components import components

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
BPE = bpe.Bpe(PATH)
PIECES = [" ", "  ", "\n", "\t", "a", "b", "the", "é", "日", "😀", "'s", "'", "1", "23", "<|endoftext|>", ".", ",", "\r\n", "\x0b", "\x85", "ing", "TION"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=16).map("".join))
def test_bpe_is_the_library(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    assert BPE.encode(text) == want
    assert BPE.decode(want) == LIBRARY.decode(want, skip_special_tokens=False)
    assert packing.loaded(PATH).encode(text) == want


@pytest.mark.parametrize("word", ["a" * 3000, "ab" * 200, "thethe" * 50, "é" * 100, "x", ""])
def test_tree_of_one_word_and_forest_agree(word):
    want = LIBRARY.encode(word, add_special_tokens=False).ids
    assert (BPE.merge(word) if word else []) == want == BPE.encode(word)


def test_decode_replaces_broken_bytes():
    for ids in ([BPE.byte_id[0xF0]], [BPE.byte_id[0xE6], BPE.byte_id[0x97]], [BPE.byte_id[0xFF], BPE.byte_id[0x41]]):
        ids = [int(i) for i in ids]
        assert BPE.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_bpe_query_columns(docs, rows, none):
    got = Counter(map(tuple, bpe.digests(docs, PATH).collect()))
    want = Counter()
    for i, t in rows:
        ids = LIBRARY.encode(t or "", add_special_tokens=False).ids
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert got == want
    assert bpe.digests(none, PATH).count() == 0
    assert {(r["doc_id"], tuple(r["ids"])) for r in bpe.encode_decode(docs, PATH).collect()} == {(i, tuple(LIBRARY.encode(t or "", add_special_tokens=False).ids)) for i, t in rows}


@pytest.mark.parametrize("shard", [packing.SHARD_TOKENS, 500])
def test_packing_holds_every_id_once(docs, rows, none, shard):
    got = packing.pack(docs, PATH, shard_tokens=shard).collect()
    by_doc, by_sequence = Counter(), {}
    pieces = {}
    for r in got:
        assert len(r["ids"]) == 4 * r["length"] > 0
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["doc_tokens"], bytes(r["ids"])))
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    want = {}
    for i, t in rows:
        ids = LIBRARY.encode(t or "", add_special_tokens=False).ids + [packing.END_ID]
        want.setdefault(i, []).append(np.array(ids, "<u4").tobytes())
        by_doc[i] += len(ids)
    for i, texts in want.items():
        assert sum(len(p[2]) // 4 for p in pieces[i]) == by_doc[i]
        if len(texts) == 1:
            assert b"".join(p[2] for p in sorted(pieces[i])) == texts[0]
            assert [p[0] for p in sorted(pieces[i])] == np.cumsum([0, *[len(p[2]) // 4 for p in sorted(pieces[i])]])[:-1].tolist()
    for places in by_sequence.values():
        places.sort()
        size = sum(n for _, n in places)
        assert [o for o, _ in places] == np.cumsum([0, *[n for _, n in places]])[:-1].tolist()
        assert size == packing.WINDOW or size < packing.WINDOW and size & (size - 1) == 0
    assert packing.pack(none, PATH).count() == 0


def test_neighbours_are_ranked_by_bm25():
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 40, rng.integers(1, 60)).astype("<u4") for _ in range(30)]
    df = np.bincount(np.concatenate([np.unique(t) for t in texts]), minlength=40)
    idf, mean = np.log1p((30 - df + 0.5) / (df + 0.5)), np.mean([len(t) for t in texts])
    shard = packing.Shard(texts, idf, mean)
    unused = rng.random(30) < 0.7
    plain = np.zeros(30)
    for d, t in enumerate(texts):
        for term in set(texts[0].tolist()):
            tf = (t == term).sum()
            plain[d] += idf[term] * tf * (packing.K1 + 1) / (tf + packing.K1 * (1 - packing.B + packing.B * len(t) / mean))
    want = [d for d in np.argsort(-plain, kind="stable") if unused[d] and plain[d] > 0]
    assert shard.neighbours(0, unused).tolist() == want
    assert sorted(shard.order(64)) == list(range(30))


def test_fast_ids_are_the_library(tmp_path):
    """Odd, long and special texts, and a vocabulary whose numbers do not follow its merges."""
    import json
    ids = packing.loaded(PATH)
    assert ids.encoding is not None and packing.number(PATH) == "<u2" and packing.number(PATH, 70_000) == "<u4"
    for text in (" " * 200_000, "\n" * 100_000 + "a", "a" * 100_000, "^" * 50_000, "é日😀" * 5_000, "<|endoftext|>" * 300, "x <|endoftext|>", " \x85\u2028 \u3000a ", "<|endoftext| >", "1" * 20_000):
        assert ids.encode(text) == LIBRARY.encode(text, add_special_tokens=False).ids, text[:20]
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    vocab = spec["model"]["vocab"]
    low, high = sorted(vocab.values())[300], sorted(vocab.values())[400]
    names = {i: t for t, i in vocab.items()}
    vocab[names[low]], vocab[names[high]] = high, low
    other = tmp_path / "other.json"
    other.write_text(json.dumps(spec), encoding="utf-8")
    assert packing.FastIds(str(other)).encoding is None
    assert packing.FastIds(str(other)).encode("the other thing is here") == Tokenizer.from_file(str(other)).encode("the other thing is here").ids


def test_packing_of_wide_ids(docs):
    """An end id beyond two bytes: ids are stored in four, and every piece is right."""
    got = packing.pack(docs, PATH, end_id=70_000, shard_tokens=500).select("length", "ids").collect()
    assert all(len(r["ids"]) == 4 * r["length"] for r in got)
    assert 70_000 in {int(i) for r in got for i in np.frombuffer(r["ids"], "<u4")}


def test_packing_routes_neighbours_to_one_shard(llm):
    rng = np.random.default_rng(6)
    texts = [(rng.zipf(1.3, 60) % 3000).astype("<u4") for _ in range(200)]
    near = [t.copy() for t in texts]
    for t in near[100:]:
        t[rng.integers(0, 60, 4)] = rng.integers(0, 3000, 4)
    texts += near  # copies and near copies, 200 documents apart
    df = np.bincount(np.concatenate([np.unique(t) for t in texts]), minlength=3000)
    idf = np.log1p((400 - df + 0.5) / (df + 0.5))
    whole = packing.Shard(texts, idf, 60.0)
    best = [int(whole.neighbours(i, np.arange(400) != i)[0]) for i in range(400)]

    def recall(order, kind):
        run = {i: n for n, (names, _) in enumerate(packing.shards(order.toArrow().to_batches(), 1800, kind)) for i in names}
        found = [run[i] == run[b] for i, b in enumerate(best)]
        return np.mean(found[:100] + found[200:300]), np.mean(found[100:200] + found[300:])

    tokens = llm.createDataFrame([(i, t.tobytes()) for i, t in enumerate(texts)], "doc_id long, ids binary").coalesce(1)
    assert max(recall(tokens, "<u4")) < 0.2
    for partitions in (1, 3):
        copies, others = recall(packing.routed(tokens, idf, partitions), packing.kind(idf))
        assert copies > 0.9 and others > 0.6


def plain_lines(rows, least=10, first=False):
    keyed = [[(line, line.strip(" \t\n\x0b\x0c\r").translate({i: i + 32 for i in range(65, 91)})) for line in (t or "").split("\n")] for _, t in rows]
    count = Counter(k for lines in keyed for k in {k for _, k in lines if k})
    where = {}
    for (i, _), lines in zip(rows, keyed):
        for at, (_, k) in enumerate(lines):
            where.setdefault(k, []).append((i is not None, i or 0, at))
    out = Counter()
    for (i, _), lines in zip(rows, keyed):
        stays = [line for at, (line, k) in enumerate(lines) if count[k] < least or first and min(where[k]) == (i is not None, i or 0, at)]
        out[i, len(lines), len(lines) - len(stays), hashlib.sha256("\n".join(stays).encode()).hexdigest()] += 1
    return out


def test_line_dedup(docs, rows, none):
    from pyspark.sql import functions as F
    assert Counter(map(tuple, line_dedup.digests(docs).collect())) == plain_lines(rows)
    # A filter far too small lets all through as suspects; the result is the same.
    small = line_dedup.dedup_lines(docs, bits=line_dedup.PIECE, keep_first=True)
    got = small.select("doc_id", "__llm_lines.n_lines", "__llm_lines.n_dropped", F.sha2("__llm_lines.kept", 256)).collect()
    assert Counter(map(tuple, got)) == plain_lines(rows, first=True)
    assert small.columns == [*docs.columns, "__llm_lines"]
    assert line_dedup.digests(none).count() == 0


@pytest.mark.parametrize("count", [20_000, 200_000])
def test_filters_follow_the_data(llm, count):
    """Of lines seen once, few are suspects, whatever their number; lines seen twice all are."""
    text = F.concat_ws("\n", F.transform(F.sequence(F.lit(0), F.lit(99)), lambda i: F.concat(F.lit("line "), F.col("id") * 100 + i)), F.concat(F.lit("Twice "), F.floor(F.col("id") / 2)))
    rows = llm.range(0, count // 100, 1, 16).select("id", text.alias("t"))
    bits = line_dedup.filter_bits(rows)
    assert 8 * 0.9 * count <= bits <= 17 * count
    found = line_dedup.suspects(rows, line_dedup.twice_filter(rows.select("t"), bits, 1), bits, 1)
    kinds = {r["kind"].decode(): r["count"] for r in found.groupBy(F.substring("key", 1, 4).alias("kind")).count().collect()}
    most = (1 - np.exp(-line_dedup.HASHES / line_dedup.BITS_PER_KEY)) ** line_dedup.HASHES  # 2.4 %
    assert kinds["twic"] == count // 100 and kinds.get("line", 0) < most * count


def test_filter_size_has_bounds(llm, none, monkeypatch):
    assert line_dedup.filter_bits(none.select(F.col("text").alias("t"))) == line_dedup.PIECE
    monkeypatch.setattr(line_dedup, "MOST_BITS", 1 << 17)
    rows = llm.range(100_000).select(F.col("id").cast("string").alias("t"))
    assert line_dedup.filter_bits(rows) == 1 << 17


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(codes, most):
    root = list(range(len(codes)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(codes)):
        for j in range(i):
            if bin(codes[i] ^ codes[j]).count("1") <= most:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(codes))]


def plain_classes(rows, codes, most):
    root = plain_roots(codes, most)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root[i]] = min(d, least.get(root[i], d))
    return Counter((d, f"{codes[i]:016x}", least.get(root[i])) for i, (d, _) in enumerate(rows))


def test_simhash_query(docs, rows, none):
    codes = [plain_fingerprint(t) for _, t in rows]
    assert [simhash.fingerprint(t or "") for _, t in rows] == codes
    assert Counter(map(tuple, simhash.contract(docs).collect())) == plain_classes(rows, codes, 2)
    assert simhash.contract(none).count() == 0


@pytest.mark.parametrize("sizes", [{}, {"block_codes": 32, "slice_rows": 16, "least_blocks": 1}, {"least_blocks": 1}])
def test_links_join_all_within_reach(llm, sizes):
    rng = random.Random(5)
    codes = [rng.getrandbits(64) for _ in range(60)]
    for _ in range(400):  # chains and dense groups, also in one block of the index
        code = rng.choice(codes)
        for _ in range(rng.randint(1, 3)):
            code ^= 1 << rng.choice([rng.randrange(64), rng.randrange(16)])
        codes.append(code)
    codes = sorted(set(codes) | {0, 1, 3, 2**64 - 1})
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    found = simhash.links(llm.createDataFrame([(c,) for c in signed], "fp long"), **sizes).collect()
    assert {c for r in found for c in r} <= set(signed)
    tied = {r["node"]: r["root"] for r in components(llm.createDataFrame(found, "u long, v long")).collect()}
    got = {}
    for i, c in enumerate(signed):
        got.setdefault(tied.get(c, c), set()).add(i)
    want = {}
    for i, r in enumerate(plain_roots(codes, 2)):
        want.setdefault(r, set()).add(i)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_upper_nodes_prune_whole_groups(llm):
    fps = simhash.fingerprints(llm.read.parquet(f"{SF01}/documents.parquet")).select("fp").distinct()
    blocks = fps.repartitionByRange(64, simhash.gray_order(F.col("fp"))).select(F.spark_partition_id().alias("block"), "fp").cache()
    names, upper = simhash.upper_nodes(blocks)
    rows = blocks.collect()
    codes, own = np.array([r["fp"] for r in rows], np.int64).view(np.uint64), np.array([r["block"] for r in rows])
    visited = set()
    for query, node in upper.searches(codes, 2):
        visited.update(zip(query.tolist(), names[node].tolist()))
    assert visited >= {(i, b) for i, b in enumerate(own.tolist())}
    near = np.nonzero(np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 2)
    assert visited >= {(i, int(own[j])) for i, j in zip(*(x.tolist() for x in near))}
    # 9 root nodes share about 3 bits, so up to one in eight differs by more than 2; 64 blocks share about 5 (their
    # ends are no powers of two), of which random codes differ in 2 or fewer with (1 + 5 + 10) / 32
    assert len(upper.levels) == 2 and upper.pruned[1] > 0 and upper.compared[0] < len(codes) * len(names)
    assert len(visited) < 0.5 * len(codes) * len(names)
    # and so it goes on inside a block
    inner = simhash.Block(codes[np.argsort([rank(c) for c in codes.tolist()])], 2)
    inner.visit(codes)
    assert sum(inner.index.pruned[1:]) > 0 and inner.index.compared[0] < 0.5 * len(codes) ** 2


def test_searches_in_halves_are_the_search(monkeypatch):
    codes = np.arange(2048, dtype=np.uint64)
    codes ^= codes >> np.uint64(1)  # by Gray rank, and all close to each other
    whole = [x.tolist() for x in simhash.GrayIndex(codes).search(codes, 2)]
    monkeypatch.setattr(simhash, "FRONTIER", 5000)
    parts = list(simhash.GrayIndex(codes).searches(codes, 2))
    assert len(parts) > 16 and [np.concatenate(x).tolist() for x in zip(*parts)] == whole


def test_gray_index_finds_all_pairs():
    rng = np.random.default_rng(1)
    base = np.uint64(0x123456789ABC0000)
    codes = np.unique(base | rng.integers(0, 1 << 16, 3000, dtype=np.uint64))
    codes = codes[np.argsort(np.array([rank(int(c)) for c in codes], np.uint64))]
    found = set(zip(*(x.tolist() for x in simhash.GrayIndex(codes).search(codes[:200], 2))))
    plain = np.bitwise_count(codes[:200, None] ^ codes[None, :]) <= 2
    assert found == set(zip(*(x.tolist() for x in np.nonzero(plain))))


def rank(code):
    out = 0
    while code:
        out ^= code
        code >>= 1
    return out


def test_exact_dedup(llm, docs, rows, tmp_path):
    from pyspark.sql import functions as F
    path = str(tmp_path / "documents.parquet")
    docs.repartition(3).write.parquet(path)
    largest, size = {}, Counter((t or "") for _, t in rows)
    for i, t in rows:
        largest[t or ""] = max(largest.get(t or "", -1), -1 if i is None else i)
    want = Counter()
    for i, t in rows:
        keep = largest[t or ""] if largest[t or ""] >= 0 else None
        want[i, keep, size[t or ""], i == keep, hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert Counter(map(tuple, exact_dedup.contract(llm, path).collect())) == want
    # The state goes on: a second run takes only new files.
    checkpoint = str(tmp_path / "state")
    exact_dedup.deduplicate(llm, path, checkpoint).count()
    llm.createDataFrame([(99, "a")], "doc_id long, text string").write.mode("append").parquet(path)
    again = exact_dedup.deduplicate(llm, path, checkpoint).where(F.col("digest") == hashlib.sha256(b"a").hexdigest()).select("doc_id", "keep_id", "group_size").collect()
    assert sorted(map(tuple, again)) == [(3, 99, 2), (99, 99, 2)]
    empty = str(tmp_path / "empty.parquet")
    docs.limit(0).write.parquet(empty)
    assert exact_dedup.contract(llm, empty).count() == 0


def test_crc_is_the_usual_one(llm):
    from pyspark.sql import functions as F
    assert llm.range(1).select(F.crc32(F.lit("abc"))).first()[0] == zlib.crc32(b"abc")
