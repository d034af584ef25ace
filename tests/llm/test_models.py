"""Tokens, pages, vectors and the pipeline."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from gazetta.llm import ann, bpe, htmltext

WORDS = "the of and in to a is that for it as with was on be by he his at from".split()


@pytest.fixture(scope="module")
def model():
    return bpe.PieceModel(open(bpe.model_path(), "rb").read())


def test_bpe_equals_the_library(model):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=bpe.model_path())
    rng = random.Random(1)
    texts = ["", " ", "  a", "▁", "▁▁ a", "a" * 5000, " " * 3000, "ab" * 2500, "<0x0A>", "</s>", "⁇", "Hello  World", "x" * 2001 + " " * 2500]
    texts += ["".join(rng.choice("ab  ▁éüx\n\t0中🎉<>\x00theingtion") for _ in range(rng.randrange(60))) for _ in range(500)]
    for t, (n, ids, text) in zip(texts, bpe.BatchCoder(model)(texts), strict=True):
        want = sp.encode(t, add_eos=True)
        assert (n, ids, text) == (len(want), " ".join(map(str, want)), sp.decode(want)), t
    assert model.encode(["a b", ""]) == [sp.encode("a b", add_eos=True), [2]]
    assert model.decode(sp.encode("Grüße an alle")) == "Grüße an alle"


def test_bpe_frame(spark):
    df = spark.createDataFrame([(1, None, 3), (2, "hello", 3), (2, "hello", 3), (None, "", 3)], "doc_id long, text string, ids int")
    out = {(r.doc_id, r.n_tokens, r.ids, r.decoded) for r in bpe.encode_documents(df, bpe.model_path()).collect()}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert (1, 1, digest("2"), digest("")) in out and (None, 1, digest("2"), digest("")) in out and len(out) == 3
    real = bpe.encode_documents(df.filter("text = 'hello'"), bpe.model_path(), real=True).first()
    assert real.ids[-1] == 2 and real.decoded == "hello"
    assert bpe.encode_documents(df.filter("false"), bpe.model_path()).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/x">Menu</a></li></ul></nav><!-- c --><div class="ad">Buy</div><header>Site</header>
<article><h1>Head &amp; line</h1><p><b>First &eacute;<br>more<p>Second   one.</p><ul><li>item</li></ul><div class="share">Share</div>
<aside>Side</aside><form>Mail <input></form></article><div id="comments"><p>Nice</p></div><footer>&copy; 2020</footer></body></html>"""


def test_html():
    assert htmltext.extract(htmltext.parse(PAGE), None) == "Head & line\n\nFirst é more\n\nSecond one.\n\nitem"
    assert htmltext.extract(htmltext.parse("just text"), None) == "just text"
    assert htmltext.extract(htmltext.parse("<p>a<p>b <i>c</i>"), None) == "a\n\nb c"
    assert htmltext.extract(htmltext.parse("<div class='x"), None) in ("", "<div class='x")
    assert htmltext.extract(htmltext.parse("<div><p>deep</p></div>" * 3), None) == "deep\n\ndeep\n\ndeep"


def test_html_names_inside_an_article():
    page = """<article><p>one two</p><p class="related-work">rel</p><h2 id="search">Search</h2><h2 id="legal">Legal</h2><p>text</p>
    <div id="notice"><p>A long notice text</p></div><div class="related-links"><a>x</a></div><div class="ad">Buy</div><div class="ad-box">Buy</div>
    <section class="related-work"><p>long text of the section</p></section><section class="related-stories"><a>see more</a></section>
    <p class="advert">Buy</p><div class="comments-list">Nice</div><xmp>&amp; <b></xmp><div hidden>no</div></article>"""
    want = ["one two", "rel", "Search", "Legal", "text", "A long notice text", "long text of the section", "&amp; <b>"]
    assert htmltext.extract(htmltext.parse(page), None).split("\n\n") == want


def test_html_long_broken_pages():
    import time

    parts = ['<div class="', "<![CDATA[>", "<!", "<b>", "<div>", "<b><h1></h1>", "</script ", "<a <b", "<td><p><button><b>", '<div class="related-work">x', "<i></b>"]
    for part in parts:
        start = time.process_time()
        htmltext.extract(htmltext.parse(part * (1_000_000 // len(part)) + ">"), None)
        assert time.process_time() - start < 8, part
    assert htmltext.extract(htmltext.parse("<p>a</p>" * 3 + '<p class="b>c</p><p>d</p>'), None) == "a\n\na\n\na\n\nc\n\nd"


def test_html_paths_keep_all_classes_and_depths():
    deep = lambda last: "<div>" * 12 + f"<div class='a b c d {last}'>"
    one, two = ({n.path for n in htmltext.parse(deep(x) + "text")[2][1:]} for x in "ef")
    assert len(one) == 13 and len(one - two) == 1
    outer = htmltext.parse("<section>" + deep("e") + "text")[2][-1].path
    assert outer not in one


def test_html_equals_a_plain_reading(spark):
    """Pages put together from known blocks: the text must be those blocks."""
    rng = random.Random(4)
    sentence = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    junk = ["<nav><a href='/'>Home</a></nav>", "<div class='ad'>Buy now</div>", "<aside>Side</aside>", "<form><input>Mail</form>", "<script>x<1</script>", "<!-- <p>no</p> -->", "<footer>Foot</footer>"]
    rows, want = [], {}
    for i in range(120):
        blocks = [sentence(rng.randrange(5, 60)) for _ in range(rng.randrange(2, 9))]
        inner = "".join(rng.choice(junk) * rng.randrange(2) + f"<p id='p{k}' class='related-{k}'>{b.replace(' ', rng.choice([' ', '  ', chr(10)]), 1)}</p>" for k, b in enumerate(blocks))
        body = "".join(rng.choice(junk) for _ in range(3)) + f"<article><h1 id='menu'>{sentence(4)} &amp; x</h1>{inner}</article>" + rng.choice(junk)
        rows.append((i, f"https://h{i % 3}.example/{i}", f"<html><body>{body}</body></html>"))
        head = body.split("<h1 id='menu'>")[1].split("</h1>")[0].replace("&amp;", "&")
        want[i] = "\n\n".join([head, *blocks])
    out = htmltext.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in out} == want


def test_html_consensus(spark):
    page = lambda body, side: f"<html><body><div class='left'><p>{side}</p></div><div class='post-1'><p>{body}</p></div></body></html>"
    rows = [(i, f"http://h.example/{i}", page("long article text " * 20, "x"), 1) for i in range(5)]
    rows += [(5, "http://h.example/5", page("short", "an unusually long side bar " * 9), 1), (6, None, None, 1), (7, "no url", "", 1), (8, "http://o.example", PAGE, 1), (8, "http://o.example", PAGE, 1)]
    out = htmltext.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string, path int")).collect()
    got = {r.page_id: r.text for r in out}
    assert len(out) == len(rows) and got[5] == "short" and got[6] == "" and got[7] == "" and got[8].startswith("Head")
    assert all(r.n_chars == len(r.text) for r in out)
    assert htmltext.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_html_keeps_what_stands_beside_a_large_box():
    main = "<div class='content'><p>" + "long article text " * 60 + "</p></div>"
    wrapped = lambda head: f"<body><div class='page'>{head}{main}<div class='left'><p>side</p></div></div></body>"
    text = ("long article text " * 60).strip()
    assert htmltext.extract(htmltext.parse(wrapped("<h1>Title</h1><p>lead</p><p><a href='/'>Home page</a></p>")), None) == f"Title\n\nlead\n\n{text}"
    assert htmltext.extract(htmltext.parse(wrapped("<div class='top'><h1>Title</h1></div>")), None) == f"Title\n\n{text}"
    assert htmltext.extract(htmltext.parse(f"<body><p>beside</p><article><p>{text}</p></article></body>"), None) == text


def test_html_host_with_several_templates(spark):
    text = "long article text " * 30
    plain = f"<html><body><div><p>{text}</p></div></body></html>"
    other = f"<html><body><article><p>{text}</p></article><div>small box</div></body></html>"
    boxed = f"<html><body><div class='story'><p>{text}</p></div><div>small box</div></body></html>"
    rows = [(i, "http://h.example/", page) for i, page in enumerate([plain] * 12 + [boxed] * 5 + [other])]
    out = htmltext.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.text for r in out} == {text.strip()}
    assert {r.page_id: r.path.split(">")[-1] for r in out} == {i: "div" if i < 12 else "div.story" if i < 17 else "article" for i in range(18)}


def test_html_forms_and_class_words_do_not_cut_prose():
    text = "Long prose of the article goes on here. " * 40
    read = lambda page: htmltext.extract(htmltext.parse(page), None)
    whole = read(f'<body><form id="f"><input type="hidden"><div class="content"><h1>Title</h1><p>{text}</p></div><input><button>Go</button></form></body>')
    assert whole == f"Title\n\n{text.strip()}"
    assert read(f'<body class="comments"><div class="content"><p>{text}</p></div></body>') == text.strip()
    kept = '<section class="share"><h2>Market share</h2><p>Market share rose.</p></section><div class="section-search"><p>Binary search halves.</p></div><div class="notice"><p>Mind this.</p></div>'
    gone = '<div class="share"><a href="x">Tweet</a></div><div class="notice">We use things.</div><form><p>Leave a reply to us all.</p><label>Name</label><input><textarea></textarea></form>'
    gone += '<div class="comments"><p>nice one</p></div><article class="comment"><p>so true</p></article><div class="newsletter"><p>Sign up now.</p></div>'
    got = read(f"<body><article><p>{text}</p>{kept}{gone}</article></body>")
    assert got.split("\n\n") == [text.strip(), "Market share", "Market share rose.", "Binary search halves.", "Mind this."]
    # outside of articles these words take a box out by themselves
    assert read(f'<body><div class="content"><p>{text}</p></div><div class="notice"><p>Mind this.</p></div></body>') == text.strip()


def test_html_hosts_of_many_paths_give_the_same_texts(spark, monkeypatch):
    text = "long article text " * 30
    shapes = [f"<html><body><div class='t{chr(97 + i)}'><p>{text}{i}</p></div><div>small box</div></body></html>" for i in range(12)]
    rows = [(i, "http://h.example/" if i % 5 else None, shapes[i % 12]) for i in range(60)] + [(99, "http://h.example/", None), (100, "http://h.example/", "<p>x</p>"), (0, "http://h.example/", shapes[0])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    first = sorted(map(str, htmltext.extract_pages(df).collect()))
    monkeypatch.setattr(htmltext, "LISTED", 2)
    assert sorted(map(str, htmltext.extract_pages(df).collect())) == first and len(first) == len(rows)


def brute_neighbours(rows, k):
    good = [(i, np.array(v, float)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for at, (i, q) in enumerate(good):
        if i % 20 == 0:
            near = sorted((-float(np.einsum("d,d->", q, v)), j) for b, (j, v) in enumerate(good) if b != at and len(v) == len(q))[:k]
            out += [(i, rank, j) for rank, (_, j) in enumerate(near, 1)]
    return out


@pytest.mark.parametrize("small", [False, True])
def test_ann(spark, monkeypatch, small):
    if small:
        for name, value in [("BLOCK_ROWS", 15), ("CHUNK_ROWS", 7), ("LEAF", 8), ("SAMPLE", 200), ("FIRST", 3), ("SECOND", 5), ("PAIRS", 9)]:
            monkeypatch.setattr(ann, name, value)
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(12) * (1 + i % 3)]) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(30)]  # ties
    rows += [(500, None), (501, []), (502, [0.0] * 12), (503, [float("nan")] * 12), (504, [None] * 12), (505, [float("inf")] + [1.0] * 11), (520, [1.0, 2.0]), (521, [2.0, 2.0])]
    rows += [rows[40], rows[40], (60, rows[61][1])]  # a query row three times, two query rows of one vec_id
    df = spark.createDataFrame([(i, v, 1, 0.0) for i, v in rows], "vec_id long, embedding array<float>, rank int, score double")
    got = [(r.query_id, r["rank"], r.vec_id) for r in ann.nearest(df).collect()]
    want = brute_neighbours(rows, ann.K)
    assert Counter(x[:2] for x in got) == Counter(x[:2] for x in want) and (520, 1, 521) in got
    assert sum(((Counter((q, j) for q, _, j in got)) & Counter((q, j) for q, _, j in want)).values()) >= 0.97 * len(want)
    assert sorted(x for x in got if x[0] == 40)[::3] == sorted(x for x in got if x[0] == 40)[1::3]
    assert ann.nearest(df.filter("false")).count() == 0


def test_ann_recall_on_the_test_table(spark):
    import duckdb

    folder = "/root/testdata/sf0.1"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    want = {(q, j) for q, _, j in con.execute(ann.OP8_EXACT).fetchall()}
    got = {(r.query_id, r.vec_id) for r in ann.op8_ann(spark, folder).collect()}
    assert len(want & got) >= 0.9 * len(want)


def test_ann_prunes_where_vectors_form_clusters(spark):
    """Several hundred cells: few rows are compared, and nearly all true neighbours are found."""
    rng = np.random.default_rng(8)
    n, centres = 40_000, rng.standard_normal((800, 32))
    v = centres[rng.integers(0, 800, n)] + 0.3 * rng.standard_normal((n, 32))
    v = (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32).astype(float)
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(n), "embedding": v.tolist()}))
    out, work = ann.search(df, every=200)
    found = {}
    for r in out.collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    compared = work.agg({"compared": "sum"}).first()[0]
    hits = 0
    for q in range(0, n, 200):
        s = v @ v[q]
        s[q] = -np.inf
        hits += len(found[q] & set(np.argsort(-s)[:20].tolist()))
    assert hits >= 0.92 * 20 * len(found) and len(found) == n // 200
    assert compared < 0.15 * n * len(found)


def test_chi_square():
    assert abs(ann.chi_square_cdf(np.array([7.344]))[0] - 0.5) < 1e-3


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as cp
    from gazetta.llm import toxicity

    rng = random.Random(2)
    text = lambda n: " ".join(f"{rng.choice(WORDS)}{rng.randrange(500)}" for _ in range(n))
    item = text(12)
    near = text(60).split()
    docs = [text(40) for _ in range(300)]
    docs = [f"{d} blockhead nitwit" if i % 5 == 0 else d for i, d in enumerate(docs)]
    copy = " ".join([*near[:30], "changed", *near[31:]])
    extra = [None, "", " ".join(near), copy, f"{text(20)} {item} {text(5)}", "repeated line of text\nown line " + text(6), "repeated line of text\nother " + text(6)]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(docs + extra)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 5 == 0), 1) for i in range(300)], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    d = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {r.doc_id: r.text for r in cp.toxicity(spark, d, str(tmp_path)).collect()}
    assert len(kept) == 240 + len(extra) and not any(i % 5 == 0 for i in kept if i < 300)
    out = {r.doc_id: r for r in cp.run(spark, str(tmp_path)).collect()}
    n = len(docs)
    # the near copy and the contaminated document go; null, empty and clean documents stay
    assert set(out) == set(kept) - {n + 3, n + 4}
    assert out[n].n_tokens == out[n + 1].n_tokens == 1
    lines = {r.doc_id: r for r in cp.line_dedup(spark, d, str(tmp_path)).collect()}
    assert lines[n + 5].text == docs[0][:0] + extra[5] and lines[n + 6].text == extra[6].split("\n")[1] and lines[n + 6].n_chars == len(lines[n + 6].text)
    assert [k for k, _ in cp.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "tokens"]
    assert toxicity.TRAIN_ROWS > 0
