"""Main text on written pages and on the given ones; top-k search against brute force."""

import html
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from verlog.llm import search
from verlog.llm.extract import extract_pages, main_text
from verlog.sources.testdata import table

PAGE = """<html><head><title>T</title><style>p{}</style></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav><div class="cookie-notice">We use cookies.</div>
<aside>Other things</aside><article><h1>Big &amp; small</h1><p>First  line<br>goes on, and on.<p>Second <b>bold</b>,
<a href="/x">linked</a> text.<ul><li>one<li>two</ul><div class="ad">Buy now!</div><form><p>Your name</p></form>
<script>var p = "<p>no</p>";</script><!-- <p>no</p> --><blockquote>Quoted&hellip;</blockquote></article>
<section id="comments"><p>Great article, thanks a lot for it.</p></section><footer>&copy; me</footer></body></html>"""


def test_article_only():
    assert main_text(PAGE) == "Big & small\nFirst line goes on, and on.\nSecond bold, linked text.\none\ntwo\nQuoted…"


def test_without_article_element():
    body = "".join(f"<p>Sentence {i}, which has a few words, and then some more of them.</p>" for i in range(6))
    page = (f"<body><div class=nav-bar><a href=a>A</a></div><div><a href=1>one</a> <a href=2>two</a></div>"
            f"<div id=content><h2>Head</h2>{body}</div><div class=footer>end</div></body>")
    assert main_text(page) == "Head\n" + "\n".join(
        f"Sentence {i}, which has a few words, and then some more of them." for i in range(6))


LONG = "A sentence of the text, with a mark, and then some more words to make it long enough. " * 3


@pytest.mark.parametrize("around", ["<div id=content>{}</div>", "<div><div id=content>{}</div></div>",
                                    "<div id=page><nav><a href=/>Home</a></nav><div>{}</div><footer>end</footer></div>", "{}"])
def test_short_blocks_without_article_element(around):
    """Lists, cells and references beside long paragraphs stay; links before and after the text go."""
    body = (f"<h1>Title</h1><p>{LONG}</p><ul><li>one<li>two</ul><p>{LONG}</p><dl><dt>term<dd>sense</dl>"
            f"<table><tr><th>a<td>1<tr><th>b<td>2</table><p>{LONG}</p><h2>References</h2>"
            f"<ol><li><a href=r>Ref one</a><li><a href=s>Ref two</a></ol>")
    page = "<body><div><a href=1>one</a> <a href=2>two</a></div>{}<div><a href=3>more</a></div></body>".format(
        around.format(body))
    p = LONG.strip()
    assert main_text(page).split("\n") == ["Title", p, "one", "two", p, "term", "sense", "a", "1", "b", "2", p,
                                          "References", "Ref one", "Ref two"]


def test_sections_without_article_element():
    page = (f"<body><div id=content><h1>T</h1><section><h2>A</h2><p>{LONG}</p></section>"
            f"<section><h2>B</h2><table><tr><td>x<td>y</table></section><section><p>{LONG}</p></section></div></body>")
    assert main_text(page).split("\n") == ["T", "A", LONG.strip(), "B", "x", "y", LONG.strip()]
    page = f"<body><div id=a><h1>T</h1><div><p>{LONG}</p></div><ul><li>x</ul></div><div><a href=1>one</a></div></body>"
    assert main_text(page).split("\n") == ["T", LONG.strip(), "x"]


@pytest.mark.parametrize("start", ["<body>", "", "<script>x</script>\n<body class=b>", "<meta name=a>\n"])
@pytest.mark.parametrize("end", ["", "</body></html>"])
def test_head_without_end_tag(start, end):
    head = "<!DOCTYPE html><html><head>\n<title>T</title><link rel=x href=y><style>p{}</style>"
    assert main_text(f"{head}{start}<p>Some words, here.<p>And more, there.{end}") == "Some words, here.\nAnd more, there."
    assert main_text(f"{head}{start}Some words, here.{end}") == "Some words, here."


@pytest.mark.parametrize("name", ["discussion", "related-work", "side-effects", "share-price", "legal", "responses",
                                  "alert-systems", "comment-period", "ad-hoc-methods"])
@pytest.mark.parametrize("around", ["<article>{}</article>", "<div id=content>{}</div>"])
def test_sections_named_like_furniture(name, around):
    p = LONG.strip()
    for part in (f"<section id={name}><h2>B</h2><p>{p}</p></section>", f"<h2 id={name} class={name}>B</h2><p>{p}</p>",
                 f"<div class={name}><h2>B</h2><p>{p}</p></div>", f"<h2>B</h2><p id={name}>{p}</p>"):
        page = around.format(f"<h1>T</h1><p>{p}</p>{part}<p>{p}</p>")
        assert main_text(f"<body>{page}</body>").split("\n") == ["T", p, "B", p, p]
    furniture = "<div class=share-buttons><a href=x>Share it</a></div><div class='related posts'><a href=y>More</a></div>"
    page = around.format(f"<div class=post-header><h1>T</h1></div><p>{p}</p>{furniture}<div class=ad>Buy, now!</div><ul class=comments><li>Nice.</ul>")
    assert main_text(f"<body>{page}</body>").split("\n") == ["T", p]


def test_formulas():
    x = "<math><mrow><mi>x</mi><mo>=</mo><mspace/><mn>2</mn></mrow><annotation>x=2</annotation></math>"
    assert main_text(f"<article><p>Where {x} holds, <svg><text>no</text></svg>all is well.</p></article>") == (
        "Where x=2 holds, all is well.")


CARDS = "".join(f"<article><h3><a href={i}>Card {i}</a></h3><p>Teaser {i}, in short.</p></article>" for i in range(4))


@pytest.mark.parametrize("page", [
    "<body><div class=grid>{cards}</div><div id=content>{text}</div></body>",
    "<body><div id=content>{text}</div>{cards}</body>",
    "<body><div id=page><nav>x</nav><div id=content>{text}</div><div>{cards}</div></div></body>",
    "<body><main><div id=content>{text}</div><div>{cards}</div></main></body>"])
def test_cards_are_not_the_text(page):
    text = f"<h1>T</h1><p>{LONG}</p><ul><li>x<li>y</ul><p>{LONG}</p>"
    p = LONG.strip()
    assert main_text(page.format(text=text, cards=CARDS)).split("\n") == ["T", p, "x", "y", p]


@pytest.mark.parametrize("page", ["<body><nav>x</nav>{}<footer>y</footer></body>", "<body><div id=page>{}</div></body>"])
def test_text_in_and_after_article(page):
    p = LONG.strip()
    both = f"<article><h1>T</h1><p>{p}</p><ul><li>x</ul></article><div><h2>U</h2><p>{p}</p><ul><li>y</ul><p>{p}</p></div>"
    assert main_text(page.format(both)).split("\n") == ["T", p, "x", "U", p, "y", p]
    alone = f"<article><h1>T</h1><p>{p}</p><p>{p}</p><div>z</div></article><div>Get our letter.</div>"
    assert main_text(f"<body>{alone}</body>").split("\n") == ["T", p, p, "z"]
    assert main_text(f"<body><div>{CARDS}</div></body>").count("Teaser") == 4
    assert main_text("<body><article><h1>T</h1><p>Short.</p></article></body>") == "T\nShort."


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "<!-- open", "<script>x", "</p></div>", "&amp", "<a><b></a></b>"])
def test_odd_pages(page):
    assert isinstance(main_text(page), str)


def test_long_and_deep_pages():
    assert main_text("<article>" + "<p>word, word.</p>" * 20000 + "</article>").count("\n") == 19999
    assert main_text("<article>" + "<div>" * 2000 + "<p>deep text.</p>") == "deep text."
    assert len(main_text("<article><p>" + "a <i>b</i> " * 30000)) == 30000 * 4 - 1
    assert main_text("<body>" + f"<div><p>{LONG}" * 1500 + "<footer>end").count("\n") == 1499


@pytest.mark.parametrize("piece", ["<a ", "<a x='>'", "<a \"", "</b", "<b>", "</i><b>", "<i><u></b>", "<!-", "<", "<p", "<!x", "'<a '>"])
def test_broken_pages_take_linear_time(piece):
    import time

    page = "<p>Some text, words. " + piece * (1_000_000 // len(piece))
    before = time.process_time()
    assert main_text(page).startswith("Some text, words.")
    assert time.process_time() - before < 8


def test_reader_comments_and_notices():
    p = LONG.strip()
    start = f"<article><h1>T</h1><p>{p}</p>"
    for beside in ('<div class="notice">This site uses cookies, see our policy.</div>',
                   '<section id="reader-feedback"><h2>Comments</h2><p>I like it, really.</p><div><p>So do I, and more.</p></div></section>',
                   '<div class="alert">Subscribe to our letter, it is free.</div>'):
        assert main_text(f"<body>{start}{beside}<p>{p}</p></article></body>").split("\n") == ["T", p, p], beside
    after = "<div class=opinions><h3>12 Comments</h3><p>What a text, thanks.</p><p>No, it is not, sorry.</p></div>"
    assert main_text(f"<body><main><h1>T</h1><p>{p}</p><p>{p}</p></main>{after}</body>").split("\n") == ["T", p, p]
    # A section of the text about comments, and one after them, stay.
    own = f"<h2>Comments on the treaty</h2><p>{p}</p><h2>Discussion</h2><p>{p}</p>"
    assert main_text(f"<body>{start}{own}</article></body>").split("\n") == ["T", p, "Comments on the treaty", p, "Discussion", p]
    flat = f"<h2>Comments</h2><p>Nice, I think.</p><h2>Sources</h2><p>{p}</p>"
    assert main_text(f"<body>{start}{flat}</article></body>").split("\n") == ["T", p, "Sources", p]


def test_given_pages(spark):
    """The article region of the given pages, cut by its tags alone."""
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    for r in extract_pages(pages.withColumn("source", F.col("html"))).collect():
        region = re.sub(r"</?b>", "", r["source"][r["source"].find("<article>") + 9:r["source"].find("</article>")])
        parts = [re.sub(r"\s+", " ", html.unescape(x)).strip() for x in re.split(r"<[^>]*>", region)]
        assert r["text"] == "\n".join(x for x in parts if x) and r["n_chars"] == len(r["text"])


def test_extract_frame(spark):
    frame = spark.createDataFrame([(1, None, "t"), (2, "<p>Some words, here.", "u"), (2, "<p>Some words, here.", "u")],
                                  "page_id long, html string, text string")
    assert sorted(map(tuple, extract_pages(frame).select("page_id", "text", "n_chars").collect())) == [
        (1, "", 0), (2, "Some words, here.", 17), (2, "Some words, here.", 17)]
    assert extract_pages(frame.limit(0)).collect() == []


def brute(vectors, queries, k):
    out = []
    ok = [(i, np.floor(256 * np.array(v, dtype=float)).astype(int)) for i, v in vectors
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    for n, (i, v) in enumerate(ok):
        if queries(i):
            scored = sorted((-int(sum(a * b for a, b in zip(v.tolist(), w.tolist()))), j)
                            for m, (j, w) in enumerate(ok) if m != n)
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def test_search_odd_rows(spark):
    rng = np.random.default_rng(5)
    data = [(i, [float(x) for x in rng.normal(size=3).round(1)]) for i in range(120)]
    data += [(3, data[3][1]), (50, data[50][1]), (200, None), (201, [0.1, None, 0.2]), (250, [float("nan"), 1.0, 1.0]),
             (300, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (350, [2.0]), (400, []), (-50, [1.0, 1.0, 1.0])]
    frame = spark.createDataFrame([(*d, 1, 2) for d in data], "vec_id long, embedding array<double>, at int, v int")
    for size in (1000, 16):
        got = search.top_k(frame, F.col("id") % 50 == 0, range_rows=size, chunk=size)
        assert sorted(map(tuple, got.collect())) == brute(data, lambda i: i % 50 == 0, 5)
    assert search.top_k(frame.limit(0), F.col("id") % 50 == 0).collect() == []
    few = spark.createDataFrame(data[:3], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, search.top_k(few, F.col("id") == 0).collect())) == brute(data[:3], lambda i: i == 0, 5)


def test_blocks_are_pruned():
    rng = np.random.default_rng(2)
    blocks = []
    for b in range(20):
        centre = rng.normal(size=16) * 200
        m = (centre + rng.normal(size=(64, 16)) * 10).astype(np.int64)
        blocks.append((np.arange(64) + 64 * b, np.arange(64) + 64 * b, m))
    queries = np.concatenate([m[:1] for _, _, m in blocks])
    of, score, ids, _, scored = search.search_range(blocks, np.full(20, -1), queries, 5)
    every = np.concatenate([m for _, _, m in blocks])
    want = -np.sort(-(queries @ every.T), axis=1)[:, :5]
    assert score.reshape(20, 5).tolist() == want.tolist() and scored < 20 * 20 / 3


def test_a_start_prunes_and_loses_nothing():
    """With the k-th score of its own block a query leaves out every block that cannot reach it, also in other ranges."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 16)) * 200
    blocks = [(np.arange(64) + 64 * b, np.arange(64) + 64 * b, (c + rng.normal(size=(64, 16)) * 10).astype(np.int64))
              for b, c in enumerate(centres)]
    queries = np.concatenate([m[:1] for _, _, m in blocks])
    every = np.concatenate([m for _, _, m in blocks])
    own = np.array([np.sort(q @ m[1:].T)[-5] for q, (_, _, m) in zip(queries, blocks)])
    q_at = np.array([ats[0] for _, ats, _ in blocks])
    found, pairs = [], 0
    for some in (blocks[:10], blocks[10:20], blocks[20:]):
        of, score, ids, _, scored = search.search_range(some, q_at, queries, 5, own)
        pairs += scored
        found += list(zip(of.tolist(), (-score).tolist(), ids.tolist()))
    alone = sum(search.search_range(some, q_at, queries, 5)[4] for some in (blocks[:10], blocks[10:20], blocks[20:]))
    assert pairs < alone and pairs < 30 * 30 / 3
    for n, q in enumerate(queries):
        scores = every @ q
        scores[q_at[n]] = -(1 << 62)
        want = sorted(zip((-scores).tolist(), range(len(every))))[:5]
        assert sorted((s, i) for m, s, i in found if m == n)[:5] == want


def test_share_of_blocks_scored_on_the_given_vectors(spark):
    """Random unit vectors: a block's extremes bound far above any score, so no layout of blocks is pruned (README)."""
    given = search.integer_vectors(table(spark, "/root/testdata/sf0.01", "embeddings"), "vec_id", "embedding", 256)
    m = np.array([r.v for r in given.orderBy("id").collect()], dtype=np.int64)
    queries = m[::50]
    scores = queries @ m.T
    kth = np.sort(scores, axis=1)[:, -6]  # the best is the query itself
    for size in (256, 16, 2):
        high, low = (np.stack([f(m[i:i + size], axis=0) for i in range(0, len(m), size)]) for f in (np.max, np.min))
        share = (search.block_bounds(queries, high, low) >= kth[:, None]).mean()
        assert share > (0.99 if size > 2 else 0.3), (size, share)
