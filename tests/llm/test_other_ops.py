"""HTML extraction, top-k, chat, toxicity, personal data and the pipeline against plain versions."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from histwise.llm import catalog, chat, html_text, pii, topk, toxicity

SF = "/root/testdata/sf0.001"

PAGE = """<html><head><title>No</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="cookie-notice">We use cookies on this site.</div>
<main><article><h1>Head &amp; line</h1><p>First <b>bold</b>  text,\n long enough to be an article.<br>
<p>Second paragraph that was never closed properly &lt;x&gt;<div class="ad">Buy now</div><p>Short.</p>
<form><input><p>Sign up</p></form><aside>Also read</aside><section id="comments"><p>I disagree</p></section></article></main>
<div id="sidebar"><p>Popular posts and a lot of words to look like text</p></div><footer>&copy; us</footer><script>var t="</p>";</script></body></html>"""


def test_main_text():
    want = "Head & line\nFirst bold text, long enough to be an article.\nSecond paragraph that was never closed properly <x>\nShort."
    assert html_text.main_text(PAGE) == want
    # A page without marks: the container with the text, not the links.
    body = "<p>" + "words of a story " * 20 + "</p>"
    plain = f"<div><a href=x>One</a> <a href=y>Two</a> <a href=z>Three</a></div><div><h2>Title</h2>{body}{body}</div><div><a href=x>Four</a><a href=x>Five</a></div>"
    assert html_text.main_text(plain).startswith("Title\nwords of a story")
    assert "Four" not in html_text.main_text(plain) and "One" not in html_text.main_text(plain)
    for odd in ("", "   ", "<", "<nav>x", "</p></div>", "<!-- ", "<article>", "<article><p>a &am"):
        html_text.main_text(odd)


def test_names_hide_no_article():
    body = "".join(f"<p>{'words of a story ' * 20}</p>" for _ in range(3))
    want = html_text.main_text(f"<body><article>{body}</article></body>")
    assert len(want) > 900
    for page in (f'<div class="content-sidebar-wrap">{body}</div>', f'<div class="site has-sidebar"><article>{body}</article></div>', f'<article class="post comments-open">{body}</article>',
                 f'<div class="no-comments">{body}</div>', f'<div class="side-by-side">{body}</div>', f'<div id="sidebar"><main>{body}</main></div>', f'<div class="widget"><div class="menu"><article class="share">{body}</article></div></div>',
                 f'<div class="widget">{body}</div>'):
        assert html_text.main_text(f"<body>{page}</body>") == want, page
    rest = '<div class="x nav-menu">Menu</div><div class="cookie-notice">Cookies</div><p>Now <b class="ad">buy</b> end</p><section id="comments"><article><p>No</p></article></section>'
    assert html_text.main_text(f"<body><article>{body}{rest}</article></body>") == want + "\nNow end"


def test_short_blocks_stay_with_their_article():
    long = ["words of a story " * n for n in (20, 14, 25, 18)]
    links = "<div><a href=x>One</a> <a href=y>Two</a> <a href=z>Three</a></div>"
    for tag in ("div", "section"):
        blocks = [f"<h2><a href=t><b>Head</b></a></h2>", long[0], "<i><b>No.</b></i>", long[1], "Short", long[2], "<span><b>So it is.</b></span>", long[3]]
        page = "".join(f"<{tag}>{b if b[:3] == '<h2' else f'<p>{b}</p>'}</{tag}>" for b in blocks)
        got = html_text.main_text(f"<body>{links}<div>{page}</div>{links}</body>").split("\n")
        assert [x[:9] for x in got] == ["Head", "words of ", "No.", "words of ", "Short", "words of ", "So it is.", "words of "]
    several = "".join(f"<article><p>{x}</p></article>" for x in (long[0], "<i><b><u>Few</u></b></i>", long[1]))
    assert "Few" in html_text.main_text(f"<body>{links}{several}{links}</body>").split("\n")
    assert "One" not in html_text.main_text(f"<body>{links}{several}{links}</body>")


@pytest.mark.parametrize("broken", ["<div>{n}</b>", "<div><p>{n}", "<li>x{n}</i>", "<nav>{n}<article>", "<span class=ad>{n}</div>", "<p>a{n}<table>"])
def test_broken_pages_take_linear_time(broken):
    """A megabyte of tags that are never closed: no event scans what is open."""
    import time
    head, _, tail = broken.partition("{n}")
    page = head * (500_000 // len(head)) + tail * (500_000 // len(tail) if tail else 0)
    begin = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - begin < 15  # it was over an hour


def test_pages_query(llm):
    def plain(page):
        m = re.search(r"<article>(.*?)(?:</article>|$)", page, re.S)
        import html
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", m.group(1))]
        return "\n".join(b for b in blocks if b)

    pages = llm.read.parquet(f"{SF}/pages.parquet")
    want = {(r["page_id"], r["url"], plain(r["html"]), len(plain(r["html"]))) for r in pages.collect()}
    assert set(map(tuple, catalog.op3_html(llm, SF).collect())) == want
    odd = llm.createDataFrame([(1, "u", None, 1), (None, None, PAGE, 2), (None, None, PAGE, 2)], "page_id long, url string, html string, text int")
    assert Counter(r["n_chars"] > 0 for r in html_text.contract(odd).collect()) == {False: 1, True: 2}
    assert html_text.contract(odd.limit(0)).count() == 0


def test_top_k(llm):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=8) * rng.exponential()], i) for i in range(300)]
    rows += [(300 + i, rows[i % 3][1], 0) for i in range(200)]  # a third are copies: ties
    rows += [(1000, None, 0), (1050, [1.0, None], 0), (1100, [float("nan")], 0), (1150, [float("inf")], 0), (1200, [], 0), (1250, [3.0], 0), (None, [1.0], 0), (7, rows[7][1], 0)]
    df = llm.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    good = [(i, [int(np.floor(256 * x)) for x in v]) for i, v, _ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = Counter()
    for q, a in good:
        if q % 50 == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in good if c != q)[:5]
            want.update((q, n + 1, c, -s) for n, (s, c) in enumerate(found))
    assert Counter(map(tuple, topk.contract(df).select("query_id", "rank", "vec_id", "score").collect())) == want
    v = topk.quantized(df)
    small = topk.top_k(v, v.where("vec_id % 50 = 0"), query_block=3)
    assert Counter(map(tuple, small.select("query_id", "rank", "vec_id", "score").collect())) == want
    assert topk.contract(df.limit(0)).count() == 0


def exact_top(vectors, queries, k):
    return Counter((q, n + 1, c, -s) for q, a in queries for n, (s, c) in enumerate(sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in vectors if c != q)[:k]))


def test_top_k_bands(llm, monkeypatch):
    """Where lengths fall, few queries leave the head band; results are whole with alike lengths, too, and with few rotated axes."""
    rng = np.random.default_rng(4)
    direction = rng.normal(size=(640, 12))
    direction /= np.linalg.norm(direction, axis=1, keepdims=True)
    falling = (direction * 4000 * 0.99 ** np.arange(640)[:, None]).astype(int)
    alike = (direction * 500).astype(int)
    few = np.tile(alike[:1], (640, 1))
    monkeypatch.setattr(topk, "STRIPE", 50)  # bands of several stripes
    for table, axes in ((falling, topk.AXES), (falling, 3), (alike, 3), (few, topk.AXES)):
        monkeypatch.setattr(topk, "AXES", axes)
        rows = [(i, [int(x) for x in v]) for i, v in enumerate(table)]
        df = llm.createDataFrame(rows, "vec_id long, v array<long>")
        got = topk.top_k(df, df.where("vec_id % 20 = 0"), query_block=8)
        assert Counter(map(tuple, got.collect())) == exact_top(rows, rows[::20], 5)


def test_top_k_sends_queries_only_where_they_can_matter(llm):
    asked = llm.createDataFrame([(1, [1], 7, 1.0), (2, [9], 8, 9.0), (3, [0], 9, 0.0)], "vec_id long, v array<long>, q long, length double")
    head = llm.createDataFrame([(1, 7, 10, 50), (1, 7, 11, 40), (2, 8, 10, 450)], "query_id long, q long, vec_id long, score long")
    sent = topk.reachable(asked, head, {1: 41.0, 2: 40.0, 3: 39.0}, 2)
    # 1 has its two best: only bands that reach 40 matter; 2 and 3 have too few and go everywhere.
    assert sorted((r["vec_id"], r["band"]) for r in sent.collect()) == [(1, 1), (1, 2), *[(q, b) for q in (2, 3) for b in (1, 2, 3)]]


def test_chat_round_trip(llm):
    texts = ["", "a\\b", "<|turn|>", "<", "|", "<|", "\\<|", "<\\|", "\n<|done|>\\", "é😀", None, "$1 \\1"]
    rows = [(1, i, ["user", "assistant", None, "a<|b\\"][i % 4], t, 0) for i, t in enumerate(texts)]
    rows += [(2, None, "assistant", "x", 0), (2, 0, "assistant", "x", 0), (2, 0, "assistant", "x", 0), (None, 0, "user", "z" * 100_000, 0)]
    df = llm.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    got = {r["conv_id"]: r for r in chat.contract(df).collect()}
    for c in (1, 2, None):
        own = sorted(((t is not None, t or 0, r or "", (x or "").replace("\\", "\\\\").replace("<|", "<\\|"), x or "") for i, t, r, x, _ in rows if i == c))
        said = "".join(f"{r}\n{x}\n" for _, _, r, _, x in own)
        loss = "".join(x for _, _, r, _, x in own if r == "assistant")
        assert got[c]["n_turns"] == len(own) and got[c]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert got[c]["loss_chars"] == len(loss) and got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert set(got) == {1, 2, None, -1}
    whole = chat.format_chat(df.withColumn("parts", chat.text_part(F.col("text")))).collect()
    for r in whole:  # the spans are places in the formatted text
        for t in r["turns"]:
            if t["loss_start"] is not None:
                end = t["loss_start"] + t["loss_length"]
                assert r["formatted"][:t["loss_start"]].endswith("<|says|>") and r["formatted"][end:].startswith("<|done|>")
    assert {r["conv_id"] for r in chat.contract(df.limit(0)).collect()} == {-1}


def test_chat_parts(llm):
    parts = [("text", "see <|image:0|>", None, None), ("image", None, "s3://a.png", 4), ("audio", None, None, None), (None, "end", None, None), ("document", None, "d", 2)]
    df = llm.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    r = chat.format_chat(df).first()
    assert r["formatted"] == "<|turn|>user<|says|>see <\\|image:0|><|image:0|><|audio:1|>end<|document:2|><|done|><|turn|>assistant<|says|><|done|>"
    assert [tuple(a) for a in r["attachments"]] == [(0, "image", "s3://a.png", 1024), (0, "audio", None, 25), (0, "document", "d", 1024)]


def test_marginals_are_those_of_all_paths():
    import itertools
    rng = np.random.default_rng(4)
    chain = toxicity.Chain({}, -0.7, rng.normal(size=(2, 2)))
    emission = [0.0, 1.5, 0.0, 0.0, -2.0, 0.7, 0.0]
    total, toxic = 0.0, np.zeros(7)
    for path in itertools.product((0, 1), repeat=7):
        weight = np.exp(sum(chain.steps[a, b] for a, b in zip((0, *path), path)) + sum((chain.bias + emission[i]) * t for i, t in enumerate(path)))
        total += weight
        toxic += weight * np.array(path)
    got = chain.marginals([(i, e) for i, e in enumerate(emission) if e], 7)
    assert np.allclose(got, (toxic / total)[[1, 4, 5]])
    gamma, _ = toxicity.forward_backward(np.array([emission]) + chain.bias, np.exp(chain.steps), np.ones((1, 7), bool))
    assert np.allclose(gamma[0], toxic / total)


def test_toxicity_held_out(llm):
    sf = "/root/testdata/sf0.01"
    rows = catalog.op9_toxicity(llm, sf).join(llm.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["predicted"] == r["toxic"] for r in held]) >= 0.95
    import zlib
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)


def test_toxicity_edges(docs, rows, none, llm):
    labels = llm.createDataFrame([(i, i % 2, 0) for i in range(1, 60)] + [(None, 1, 0), (5, None, 0), (5, 1, 0)], "doc_id long, toxic int, score int")
    assert toxicity.contract(docs, labels).count() == len(rows)
    got = toxicity.score(docs, labels.where("toxic = 0"))  # one class only
    assert got.columns == [*docs.columns, "__llm_toxicity"] and got.where("__llm_toxicity.score < 0.5").count() == len(rows)
    assert toxicity.contract(none, labels).count() == 0 and toxicity.contract(docs, labels.limit(0)).count() == len(rows)


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    def valid(kind, m):
        digits = re.sub("[^0-9]", "", m)
        luhn = sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(digits))) % 10 == 0
        return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.split(".")), "card": 12 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15}[kind]
    return sorted((m.start(), i, k, m.end()) for i, k in enumerate(BASE) for m in re.finditer(BASE[k], text) if valid(k, m.group()))


PII = ["a.b@c.de", "a@b.c_d@x.org", "x@y", "a@b@c.d.e..f", "1.2.3.4.5.6.7.8", "256.1.1.1", "00255.1.1.01", "4111 1111 1111 1111", "4111-1111-1111-1112", "79927398713", "000000000000",
       "+1 (017) 555-7713 x", "+1+12345678901", "+12 3", "é😀 a@b.cd 1.2.3.4", "4111111111111111 4111111111111111", "+4111111111111111", "12345678901234567890", "a" * 20_000, "1 " * 5_000, ".@" * 3000]


def test_pii_base(llm, docs, rows, none):
    texts = [(i, t) for i, t in enumerate(PII + [" ".join(PII[:18]), None, ""])]
    df = llm.createDataFrame(texts + [texts[0]], "doc_id long, text string").withColumn("spans", F.lit(1))
    got = pii.contract(df).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        want = plain_spans(dict(texts)[r["doc_id"]] or "")
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{z}" for a, _, k, z in want).encode()).hexdigest(), (dict(texts)[r["doc_id"]], want, r["spans"])
        assert [r[f"n_{k}"] for k in BASE] == [sum(x[2] == k for x in want) for k in BASE]
    assert pii.contract(docs).count() == len(rows) and pii.contract(none).count() == 0


def test_pii_contexts_find_identifiers(llm):
    known = [(i, f"some words here, call me at +1 555 010 {1000 + i} today") for i in range(20)]
    texts = known + [(50, "some words here, call me at 0049-5550-9876 today"), (51, "the part number is 0049-5550-1234 today"), (52, None)]
    got = {r["doc_id"]: r for r in pii.contract(llm.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got[50]["spans"] == "id:28:42" and got[51]["spans"] == "" and got[3]["n_phone"] == 1
    clean = pii.redact(llm.createDataFrame(texts, "doc_id long, text string")).where("doc_id in (3, 50)").orderBy("doc_id").collect()
    assert [r["__llm_masked"] for r in clean] == ["some words here, call me at [PHONE] today", "some words here, call me at [ID] today"]


def test_pii_contexts_reach_over_earlier_matches(llm):
    known = [(i, f"call line {i % 10} +1 555 010 {1000 + i} today") for i in range(20)]
    known += [(30 + i, f"all ids: 0000-0000-{2000 + i}, a{i}@b.cd") for i in range(20)]
    texts = known + [(60, "call line 2 0049-5550-9876 today"), (61, "all ids: 0049-5550-1111, 0049-5550-2222"), (62, "call part 2 0049-5550-1234 today")]
    df = llm.createDataFrame(texts, "doc_id long, text string")
    _, spans = pii.occurrences(df)
    left = {r["match"]: r["left"] for r in spans.collect()}
    assert left["0049-5550-9876"] == "call line 2 " and left["0049-5550-2222"] == "all ids: 0049-5550-1111, "
    assert left["+1 555 010 1003"] == "call line 3 " and left["a4@b.cd"] == "all ids: 0000-0000-2004, "
    got = {r["doc_id"]: r["spans"] for r in pii.contract(df).collect()}
    assert "id:12:26" in got[60] and "id:25:39" in got[61] and "id:" not in got[62]
    long = "x " * 60 + "1 2 é3 " * 30 + "9999-8888-7777"
    _, spans = pii.occurrences(llm.createDataFrame([(1, long)], "doc_id long, text string"))
    assert {r["match"]: r["left"] for r in spans.collect()}["9999-8888-7777"] == long[:-14][-80:]


def test_pii_instances_of_any_form(llm):
    known = [(i, f"some words here, call me at +1 555 010 {1000 + i} today") for i in range(60)]
    forms = ["555 010 4567", "(020) 7946 0958", "GB82 WEST 1234 5698 7654 32", "4471923", "bob@intranet", "fe80::1ff:fe23:4567", "12", "0049-5550-9876"]
    new = [(100 + i, f"some words here, call me at {x} today") for i, x in enumerate(forms)]
    other = [(200 + i, f"the part number is {x} today") for i, x in enumerate(["777 020 1234", "8812345", "eve@extranet", "13"])]
    df = llm.createDataFrame(known + new + other, "doc_id long, text string")
    got = {r["doc_id"]: r["__llm_masked"] for r in pii.redact(df).collect()}
    assert {got[i] for i, _ in new} == {"some words here, call me at [ID] today"}
    assert all("[ID]" not in got[i] for i, _ in other)


@pytest.fixture(scope="module")
def staged(llm, tmp_path_factory):
    """Each stage's input and output at the smallest scale, written and read again."""
    import corpus_pipeline
    base, out = tmp_path_factory.mktemp("stages"), []
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        result = stage(llm, docs, SF)
        result.write.parquet(f"{base}/{name}")
        done = llm.read.parquet(f"{base}/{name}")
        out.append((name, docs, done))
        docs = done
    return out


def test_pipeline_stages(staged):
    (_, a, b), (_, _, c), (_, _, d), (_, _, e), (_, _, packed) = staged
    assert [n for n, _, _ in staged] == ["toxicity", "line_dedup", "near_dedup", "pii", "packing"]
    assert a.columns == b.columns == c.columns == d.columns == e.columns
    assert 0 < b.count() <= a.count() and c.count() == b.count() and d.count() == e.count()
    # near dedup: one of each class, and no two that are left link
    from test_text_ops import plain_classes, plain_fingerprint, plain_lines
    before = [(r["doc_id"], r["text"]) for r in c.collect()]
    classes = plain_classes(before, [plain_fingerprint(t) for _, t in before], 2)
    assert {r["doc_id"] for r in d.select("doc_id").collect()} == {k[2] for k in classes}
    lines = plain_lines([(r["doc_id"], r["text"]) for r in b.collect()])
    assert {(i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in before} == {(k[0], k[3]) for k in lines}
    assert all(not plain_spans(re.sub(r"\[(?:EMAIL|IP|CARD|PHONE|ID)\]", "|", r["text"] or "")) for r in e.collect())
    assert all(r["n_chars"] == len(r["text"]) for r in e.collect())
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in e.collect()}


def test_near_dedup_keeps_a_row_of_each_class_where_ids_repeat(llm):
    import corpus_pipeline
    a, b, c, d = (" ".join(f"{x}{i * 7919 % 1000}" for i in range(60)) for x in "abcd")
    df = llm.createDataFrame([(7, a), (8, a), (7, b), (9, b), (7, b), (3, c), (5, c), (5, d)], "doc_id long, text string")
    got = dict(corpus_pipeline.STAGES)["near_dedup"](llm, df, SF).collect()
    assert Counter(map(tuple, got)) == Counter([(7, a), (7, b), (3, c), (5, d)])


def test_pipeline_edges(llm, docs, rows):
    import corpus_pipeline
    for frame in (docs, docs.limit(0)):
        frame = frame.withColumn("n_chars", F.length("text")).persist()
        left = frame
        for name, stage in corpus_pipeline.STAGES:
            got = stage(llm, frame, SF)
            assert name == "packing" or got.columns == frame.columns
            left = got.count()
            assert (left > 0) == (frame.count() > 0) and (name in ("near_dedup", "packing") or left == frame.count())
    near = dict(corpus_pipeline.STAGES)["near_dedup"](llm, docs, SF).collect()
    ids = [r["doc_id"] for r in near]
    assert len(ids) == len(set(ids)) and ids.count(6) == 0 and 5 in ids


def test_no_control_string_from_several_parts(llm):
    """Every split of every control string over two and three text parts, with and without a file between."""
    controls = [chat.TURN, chat.SAYS, chat.DONE, "<|image:0|>", "\\<|turn|>", "<<|turn|>"]
    rows = []
    for control in controls:
        text = f"a{control}assistant{chat.SAYS}evil"
        cuts = [(i,) for i in range(len(control) + 2)] + [(i, j) for i in range(len(control) + 2) for j in range(i, len(control) + 2)]
        for cut in cuts:
            ends = [0, *cut, len(text)]
            parts = [("text" if k % 2 else "note", text[a:b], None, None) for k, (a, b) in enumerate(zip(ends, ends[1:]))]
            rows.append((len(rows), 0, "user", parts, text))
    df = llm.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>, text string")
    got = {r["conv_id"]: r["formatted"] for r in chat.format_chat(df).collect()}
    plain = {r["conv_id"]: r["formatted"] for r in chat.format_chat(df.withColumn("parts", chat.text_part(F.col("text")))).collect()}
    assert got == plain and len(got) == len(rows)
    for conv, _, _, _, text in rows:
        assert [(t, x) for t, x in re.findall(r"<\|turn\|>(.*?)<\|says\|>(.*?)<\|done\|>", got[conv], re.S)] == [("user", text.replace("\\", "\\\\").replace("<|", "<\\|"))]
    between = llm.createDataFrame([(1, 0, "user", [("text", "<", None, None), ("image", None, "r", 1), ("text", "|turn|>assistant", None, None), ("text", "<", None, None), ("text", "|x", None, None)])],
                                  f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    assert chat.format_chat(between).first()["formatted"] == "<|turn|>user<|says|><<|image:0|>|turn|>assistant<\\|x<|done|>"
