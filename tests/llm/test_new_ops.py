"""WARC archive, conversation repair and collocations against plain versions."""

import base64
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from histwise.llm import catalog, collocations, repair, warc
from histwise.llm.common import hot_join, shared_path

SF = "/root/testdata/sf0.001"


# ---- WARC

PAGES = [
    (5, "http://a/5", "<p>same</p>"), (3, "http://a/3", "<p>same</p>"), (9, None, "<p>same</p>"), (None, "http://a/x", "<p>same</p>"),
    (4, "http://a/4\r\nX-Page-Id: 77", "other é日😀"), (6, "u", None), (7, "u", ""), (8, "u", "x" * 300_000), (10, "u", "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
    (11, "u", "twice"), (11, "u", "twice"), (None, "u", "no id"), (None, "v", "no id"), (12, "u", "\r\n\r\n"),
]


def plain_warc(rows, min_bytes=0):
    least = {}
    for i, _, html in rows:
        if i is not None:
            least[html or ""] = min(i, least.get(html or "", i))
    out = Counter()
    for i, _, html in rows:
        t = (html or "").encode()
        first = least.get(html or "")
        revisit = i != first and len(t) >= min_bytes
        out[i, len(t), base64.b32encode(hashlib.sha1(t).digest()).decode(), "revisit" if revisit else "response", first if revisit else None] += 1
    return out


@pytest.fixture(scope="module")
def pages(llm):
    return llm.createDataFrame(PAGES, "page_id long, url string, html string").withColumns({c: F.lit(0) for c in ("payload", "digest", "n", "record", "head", "bytes")})


@pytest.mark.parametrize("min_bytes", [0, 12, 10**6])
def test_archive_reads_back(llm, pages, min_bytes):
    path = shared_path(llm, "test-warc")
    warc.write_archive(pages, path, min_bytes)
    assert Counter(map(tuple, warc.resolve(llm, path).collect())) == plain_warc(PAGES, min_bytes)
    payloads = llm.read.parquet(f"{path}/payloads")
    assert payloads.count() == payloads.select("payload").distinct().count() == len({h or "" for _, _, h in PAGES})


def test_records_are_whole(llm, pages):
    path = shared_path(llm, "test-warc")
    warc.write_archive(pages, path)
    found = [bytes(r["record"]) for kind in (False, True) for r in warc.records(llm, path, kind).collect()]
    assert len(found) == len(PAGES)
    bodies = Counter()
    for record in found:
        head, _, rest = record.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        assert lines[0] == "WARC/1.1" and len(fields) == len(lines) - 1 and rest.endswith(b"\r\n\r\n")
        assert int(fields["Content-Length"]) == len(rest) - 4 and "\n" not in fields.get("WARC-Target-URI", "")
        bodies[rest[:-4].partition(b"\r\n\r\n")[2].decode()] += fields["WARC-Type"] == "response"
        if fields["WARC-Type"] == "revisit":
            assert fields["WARC-Refers-To"] in {re.search(rb"WARC-Record-ID: (\S+)", r).group(1).decode() for r in found}
    assert {b for b, n in bodies.items() if n} == {h or "" for _, _, h in PAGES}


def test_broken_records_raise(llm, pages):
    path = shared_path(llm, "test-warc")
    warc.write_archive(pages, path)
    cut = warc.records(llm, path, False).select(F.expr("substring(record, 1, length(record) - 1)").alias("record"))
    with pytest.raises(Exception, match="broken record"):
        warc.read_records(cut).collect()
    other = shared_path(llm, "test-warc")
    for name in ("headers", "payloads"):
        table = llm.read.parquet(f"{path}/{name}")
        if name == "payloads":  # a byte of each payload changed
            table = table.withColumn("payload", F.when(F.octet_length("payload") > 0, F.concat(F.lit(b"?"), F.expr("substring(payload, 2)"))).otherwise(F.col("payload")))
        table.write.parquet(f"{other}/{name}")
    with pytest.raises(Exception, match="does not match its digest"):
        warc.resolve(llm, other).collect()


def test_warc_empty_table(llm):
    none = llm.createDataFrame([], "page_id long, url string, html string")
    assert warc.contract(none).count() == 0


def test_hot_join_holds_every_row(llm):
    rows = llm.createDataFrame([("hot" if i % 3 else f"k{i}", i, i % 7) for i in range(3000)], "k string, i long, deal int")
    one = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("i").alias("most"))
    got = sorted(map(tuple, hot_join(rows, one, ["k"], "n", F.col("i")).collect()))
    most = {r["k"]: r["most"] for r in one.collect()}
    assert got == sorted((k, i, d, most[k]) for k, i, d in map(tuple, rows.collect()))


# ---- conversation repair

def plain_repair(rows):
    """rows: (role, text) in order. Faults, cost, audit and repaired turns by search over (cost, audit)."""
    seen, faults = set(), []
    for role, text in rows:
        last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        faults.append("b" if not last else "d" if (role, text) in seen else "t" if last not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    best = {(len(rows), q): ((0, "", ()) if q in ("", "a") else None) for q in ("", "s", "u", "a")}

    def options(i, q):
        if i < len(rows):
            role, text = rows[i]
            extra = 3 if faults[i] == "t" else 0
            yield 4, "D", (i + 1, q), None
            if faults[i] not in ("b", "d"):
                if (q, role[:1]) in {("", "s"), ("", "u"), ("s", "u"), ("a", "u"), ("u", "a")}:
                    yield extra, "K", (i + 1, role[:1]), (role, text)
                to = "assistant" if q == "u" else "user"
                yield 3 + extra, "R", (i + 1, to[0]), (to, text)
        to = "assistant" if q == "u" else "user"
        yield 3, "I", (i, to[0]), (to, "")

    for i in range(len(rows), -1, -1):
        for q in ("", "s", "u", "a"):
            best.setdefault((i, q), None)
        for _ in range(4):  # insertions lead from state to state of the same row
            for q in ("", "s", "u", "a"):
                for cost, letter, to, turn in options(i, q):
                    if best.get(to) is not None:
                        c, audit, turns = best[to]
                        new = (c + cost, letter + audit, ((turn,) if turn else ()) + turns)
                        if best[i, q] is None or new[:2] < best[i, q][:2]:
                            best[i, q] = new
    cost, audit, turns = best[0, ""]
    return faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, turns


def as_codes(rows):
    faults, seen = [], set()
    for role, text in rows:
        last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        kind = 1 if not last else 2 if (role, text) in seen else 3 if last not in ".!?" else 0
        seen.add((role, text))
        faults.append("sua".find(role[:1] or "?") + 1 + 4 * kind)
    return np.array(faults, np.int64)


ROLES = ["system", "user", "assistant", "tool", "", "u"]
TEXTS = ["A.", "B!", "C", "", " \n", "D?  ", "e.f"]
TURNS = st.lists(st.tuples(st.sampled_from(ROLES), st.sampled_from(TEXTS)), max_size=9)


@settings(max_examples=200, deadline=None)
@given(st.lists(TURNS, min_size=1, max_size=6))
def test_plans_are_cheapest_and_least(talks):
    got = repair.plans([as_codes(t) for t in talks])
    want = [plain_repair(t)[4:] for t in talks]
    assert got == [(c, a) for c, a, _ in want]
    for rows, (_, audit), (_, _, turns) in zip(talks, got, want):
        editor = repair.Editor(audit)
        out = [x for role, text in rows for x in editor.feed(role, text)] + list(editor.inserted())
        assert tuple(out) == turns
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out))


def test_all_short_conversations():
    turns = list(itertools.product(["system", "user", "assistant", "x"], ["A.", "B", ""]))
    talks = [list(t) for n in range(4) for t in itertools.product(turns, repeat=n)]
    assert repair.plans([as_codes(t) for t in talks]) == [plain_repair(t)[4:6] for t in talks]


def test_long_conversation_in_one_plan():
    rng = random.Random(3)
    rows = [(rng.choice(ROLES), f"{rng.random()}{rng.choice('.!?x')}") for _ in range(3000)]
    assert repair.plans([as_codes(rows)])[0] == plain_repair(rows)[4:6]


def plain_contract(rows):
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        talks[conv]
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        talks[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = set()
    for conv, turns in talks.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        known = {t for t, _, _ in turns if t is not None}
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        *facts, fixed = plain_repair([t[1:] for t in turns])
        out.add((conv, gaps, *facts, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()))
    return out


def test_repair_query_is_brute_force(llm):
    rows = [tuple(r) for r in llm.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = catalog.op12_repair(llm, "/root/testdata/sf0.01")
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert set(map(tuple, got.collect())) == plain_contract(rows)


def test_repair_of_odd_rows(llm):
    rng = random.Random(1)
    rows = [(rng.choice([None, *range(12)]), rng.choice([None, *range(8)]), rng.choice([*ROLES, None]), rng.choice([*TEXTS, None, "é日." * 9, "x" * 70_000])) for _ in range(300)]
    rows += rows[:20]
    gone = next(i for i in range(100, 10_000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows.append((gone, 0, "user", "All that is here goes."))
    df = llm.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(0) for c in ("pos", "code", "audit", "gone", "kind", "copy", "n")})
    got = repair.contract(df).collect()
    assert set(map(tuple, got)) == plain_contract(rows)
    assert (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in set(map(tuple, got))
    fixed = defaultdict(list)
    for r in repair.repair(df).collect():
        fixed[r["conv_id"]].append((r["turn"], r["role"]))
    for turns in fixed.values():
        assert re.fullmatch("(s?(ua)+)?", "".join(role[:1] for _, role in sorted(turns)))
    none = llm.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.contract(none).count() == 0 and repair.repair(none).count() == 0


# ---- collocations

def plain_counts(rows, longest=3):
    count, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        t = (text or "").encode().lower().decode()
        for piece in re.split("[.,;:!?\x0a-\x0d]", t):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            for n in range(1, longest + 1):
                count.update((lang, tuple(w[i:i + n])) for i in range(len(w) - n + 1))
    return count, total


def plain_collocations(rows, longest=3, least=10, share=50):
    count, total = plain_counts(rows, longest)
    found = {k: a for k, a in count.items() if len(k[1]) > 1 and a >= least}
    out = []
    for (lang, w), a in found.items():
        if any(100 * b >= share * a for (other, v), b in found.items() if other == lang and len(v) > len(w) and any(v[i:i + len(w)] == w for i in range(len(v)))):
            continue
        score, k = min((10**6 * a * a // (count[lang, w[:k]] * count[lang, w[k:]]), k) for k in range(1, len(w)))
        out.append((lang, " ".join(w), len(w), a, count[lang, w[:k]], count[lang, w[k:]], total[lang], score))
    return out


def sample_texts():
    rng = random.Random(5)
    words = ["of", "the", "new", "york", "Times", "é", "日", "x y", "a" * 300, "<nul>\x00"]
    ends = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "!", "\x0b", "\x1c", " "]
    text = lambda n: "".join(rng.choice(words) + rng.choice(ends) for _ in range(n))
    rows = [(rng.choice(["en", "de", None, ""]), text(rng.randint(0, 60))) for _ in range(150)]
    same = text(40)
    return rows + [("en", same)] * 60 + [("en", None), ("en", ""), (None, None), ("en", "..."), ("de", text(6000)), ("one", "New York Times " * 40)]


@pytest.mark.parametrize("longest, least, modulus", [(3, 10, 16), (2, 3, 2), (4, 4, 1), (3, 1, 3)])
def test_collocations_are_brute_force(llm, longest, least, modulus):
    rows = sample_texts()
    df = llm.createDataFrame(rows, "lang string, text string").withColumns({c: F.lit(0) for c in ("doc_id", "phrase", "f", "chunk", "owned", "h", "n")})
    got = collocations.collocations(df, longest, least, modulus=modulus).collect()
    assert sorted(map(tuple, got)) == sorted(plain_collocations(rows, longest, least))


@pytest.mark.parametrize("longest, modulus", [(2, 1), (3, 1), (3, 4), (5, 2)])
def test_chunks_own_each_start_once(longest, modulus):
    """The owned starts of the chunks are the words of the texts, each with the n-grams that start there."""
    texts = [t or "" for _, t in sample_texts()]
    row, chunk, owned = collocations.parse(pa.array(texts), longest, modulus)
    got = Counter()
    for c, o in zip(chunk.to_pylist(), owned.tolist()):
        w = c.split(" ")
        got.update(tuple(w[i:i + n]) for i in range(o) for n in range(1, longest + 1) if i + n <= len(w))
    want = Counter()
    for (_, w), n in plain_counts([("x", t) for t in texts], longest)[0].items():
        want[w] += n
    assert got == want


def test_filter_lets_every_frequent_pair_through(llm):
    h = np.random.default_rng(1).integers(-2**63, 2**63 - 1, 5000)
    held = collocations.pair_filter(llm.createDataFrame([(int(x),) for x in h], "h long"))
    at = collocations.probes(h.view(np.uint64), len(held) * 64)
    hit = lambda at: ((held[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)
    assert hit(at).all()
    other = np.random.default_rng(2).integers(-2**63, 2**63 - 1, 5000)
    assert hit(collocations.probes(other.view(np.uint64), len(held) * 64)).mean() < 0.05


def test_scores_beyond_64_bits(llm):
    """A count whose square times a million passes 64 bits: the same phrase in many copies of one chunk."""
    a = 30_000
    df = llm.range(a).select(F.lit("en").alias("lang"), F.lit("big deal " * 100).alias("text"))
    got = {r["phrase"]: r for r in collocations.collocations(df, 2).collect()}
    n = a * 100
    assert (got["big deal"]["a"], got["big deal"]["l"], got["big deal"]["score"]) == (n, n, 10**6)
    assert got["deal big"]["score"] == 10**6 * (a * 99) ** 2 // (n * n)


def test_collocations_empty_tables(llm):
    none = llm.createDataFrame([], "lang string, text string")
    assert collocations.contract(none).count() == 0
    assert collocations.contract(llm.createDataFrame([("en", "...")], "lang string, text string")).count() == 0


def test_sql_of_the_new_operators_on_plain_tables(llm):
    from oracle_check import compare, duck
    con = duck(SF)
    for key in ("op11_warc", "op13_collocations"):
        msg = compare(llm, con, key, catalog.QUERIES[key], catalog.ORACLES[key], SF)
        assert msg.startswith("ok"), msg


def test_simhash_search_of_a_large_near_group_is_small():
    """One group of near codes: a search holds little at a time and finds the links of a wide one."""
    import tracemalloc
    import numpy as np
    from histwise.llm import simhash
    rng, codes = np.random.default_rng(1), np.full(15_000, 77, np.uint64)
    for _ in range(3):
        codes ^= np.uint64(1) << rng.integers(0, 64, len(codes)).astype(np.uint64)
    block = simhash.Block(np.unique(codes), 2)
    tracemalloc.start()
    u, v = block.visit(block.codes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(u) and peak < 32e6
    assert (np.bitwise_count(u ^ v) <= 2).all()
