"""Merkle manifest, ranked search and page text against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from html import unescape

import pytest
from pyspark.sql import functions as F

from ordertide.llm import html_text, merkle, queries, search
from test_llm_operators import SF, edge_rows

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


# ---- Merkle manifest ---------------------------------------------------------------

def brute_leaf(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def brute_climb(nodes):
    """Levels of digests from the leaves to the root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha(*last[i:i + 16]) for i in range(0, len(last), 16)])
    return levels


def brute_steps(levels, pos):
    out = []
    for level in levels[:-1]:
        run = pos - pos % 16
        out.append((level[run:pos], level[pos + 1:run + 16]))
        pos //= 16
    return out


def brute_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text); the columns of op11, sorted."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees, ordered = {}, {}
    for s in names:
        ordered[s] = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, brute_leaf(r)))
        trees[s] = brute_climb([brute_leaf(r) for r in ordered[s]])
    top = brute_climb([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for pos, r in enumerate(ordered[s]):
            steps = brute_steps(trees[s], pos) + brute_steps(top, k)
            given = r
            if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 5 == 0 and r[4] is not None:
                given = r[:4] + (re.sub("[A-Z]", lambda m: m.group().lower(), r[4]),)
            h = brute_leaf(given)
            for left, right in steps:
                h = sha(*left, h, *right)
            out.append((r[0], brute_leaf(r), trees[s][-1][0], top[-1][0], sha(*[x for a, b in steps for x in a + b]), h, h == top[-1][0]))
    return sorted(out, key=str)


def op11(monkeypatch, spark, df):
    monkeypatch.setattr(queries, "table", lambda *a: df)
    cols = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in queries.op11_merkle(spark, "").select(cols).collect()), key=str)


def test_merkle_on_edge_rows(spark, monkeypatch):
    rows = edge_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns(
        {c: F.lit("clash") for c in ("id", "g", "h", "pos", "n", "slot", "path", "height", "above", "task", "at")})
    assert op11(monkeypatch, spark, df) == brute_manifest([(i, s, la, n, t) for i, t, la, s, n in rows])
    assert op11(monkeypatch, spark, df.limit(0)) == []
    assert op11(monkeypatch, spark, df.where("doc_id = 7")) == brute_manifest([(i, s, la, n, t) for i, t, la, s, n in rows if i == 7])


def test_merkle_of_deep_and_single_groups(spark, monkeypatch):
    """A hot source of four levels over several window blocks, runs of one node, and 20 sources."""
    rng = random.Random(4)
    rows = [(i, f"Text {i}", "en", "hot", i) for i in range(4096 + 17)] + [(10_000 + i, "One", None, f"s{i:02d}é", None) for i in range(19)]
    rows += [(20_000 + i, "Null source", "de", None, 1) for i in range(17)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert op11(monkeypatch, spark, df) == brute_manifest([(i, s, la, n, t) for i, t, la, s, n in rows])


# ---- Ranked search -----------------------------------------------------------------

def brute_terms(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))


def brute_search(docs, items, k):
    counts = [(i, Counter(brute_terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, total = len(counts), sum(c.total() for _, c in counts)
    df = Counter(w for _, c in counts for w in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in counts:
            m = 100 - 90 + 90 * c.total() * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m))
                    for w in set(brute_terms(text)) if w in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def hits(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


ITEMS = [(1, "a b c d"), (2, None), (3, ""), (4, "THIS line, of text!"), (5, "漢字 É 12ab"), (5, "a b c d"), (None, "documents"), (6, "zzzznone"), (7, "x" * 50_000)]


@pytest.mark.parametrize("known", [1 << 17, 2])
def test_search_on_edge_rows(spark, monkeypatch, known):
    """With postings of the items' terms only, and of all terms."""
    monkeypatch.setattr(search, "KNOWN_TERMS", known)
    df = spark.createDataFrame(edge_rows(), SCHEMA).repartition(3).withColumns(
        {c: F.lit("clash") for c in ("id", "m", "n", "term", "tf", "q", "keys", "part", "chunk")})
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("q", F.lit("clash"))
    docs = [(r[0], r[1]) for r in edge_rows()]
    assert hits(search.ranked_search(df, items, 3)) == brute_search(docs, ITEMS, 3)
    assert hits(search.ranked_search(df.limit(0), items, 3)) == []
    assert hits(search.ranked_search(df, items.limit(0), 3)) == []


def test_search_in_many_parts_waves_and_blocks(spark, monkeypatch):
    """Split strata, several waves a task and several blocks of items give the same hits; equal scores by id."""
    monkeypatch.setattr(search, "PART_POSTINGS", 40)
    monkeypatch.setattr(search, "WAVE_POSTINGS", 100)
    monkeypatch.setattr(search, "BLOCK_TERMS", 30)
    monkeypatch.setattr(search, "CHUNK_DOCS", 16)
    rng = random.Random(9)
    draw = lambda n: " ".join(f"w{min(int(rng.paretovariate(0.6)), 400)}" for _ in range(n))
    docs = [(i, draw(rng.choice([5, 5, 5, 12, 40]))) for i in range(400)]
    docs += [(1000 + i, docs[7][1]) for i in range(60)]
    items = [(i, draw(8)) for i in range(20)] + [(99, docs[7][1])]
    out = search.ranked_search(spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
                               spark.createDataFrame(items, "item_id long, text string"), 10)
    assert hits(out) == brute_search(docs, items, 10)


# ---- Page text ---------------------------------------------------------------------

def test_page_text_of_the_pages(spark):
    """On whole pages of the small table: what stands in the article element, read by plain patterns."""
    def brute(h):
        body = h[h.index("<article>") + 9:h.index("</article>")]
        return " ".join(unescape(re.sub("<[^>]*>", " ", body)).split())
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r.page_id: r for r in queries.op13_html_text(spark, SF).collect()}
    assert len(got) == len(pages)
    for i, h in pages.items():
        assert got[i].text == brute(h) and got[i].n_chars == len(got[i].text)


PARA = ["A first paragraph of the story, long enough to count as running text in any page, with some more words.",
        "A second one follows it; <a href='/x'>a linked phrase</a> stands &amp; stays in it, <b>bold</b>ly, for all to read here.",
        "Short one.", "And the last paragraph closes the story with a good number of words so that the sums stay high."]
WANT = " ".join(["Title of it", *[" ".join(unescape(re.sub("<[^>]*>", "", p)).split()) for p in PARA]])
STORY = "<h1>Title of it</h1>" + "".join(f"<p>{p}</p>" for p in PARA)
CASES = {
    "article": f"<body><header>Site name</header><nav><a href='/'>Home</a></nav><article>{STORY}</article><aside>Aside text of some length here</aside></body>",
    "no article": f"<body><div id=top>My site</div><div class='menu'><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></div>"
                  f"<div class=content>{STORY}</div><div class='sidebar left'><p>{PARA[0]}</p></div><div id=foot>(c) me</div></body>",
    "links around": f"<div><a href=1>{PARA[0]}</a> <a href=2>{PARA[3]}</a></div><div>{STORY}</div><div><a href=3>{PARA[0]}</a></div>",
    "comments": f"<main>{STORY}<section id='comments'><p>{PARA[0]}</p></section><div class='cookie-notice'>{PARA[0]}</div></main>",
    "in article": f"<article><div class=adSlot>{PARA[0]}</div>{STORY}<form><p>{PARA[0]}</p><input></form><footer>by me</footer></article>",
    "scripts": f"<script>var t = '<p>no</p>';</script><style>p {{}}</style><article>{STORY}<noscript><p>no</p></noscript><!-- <p>no</p> --></article>",
    "unclosed": f"<article><h1>Title of it{''.join(f'<p>{p}' for p in PARA)}</article><footer>foot",
    "unclosed aside": f"<div><div><aside><p>{PARA[0]}</div></div><article>{STORY}</article>",
    "not dropped": f"<body class='has-sidebar'><div class='no-ads with-menu'><article class='post sidebar'>{STORY}</article></div>",
    "names": f"<div class='page-with-sidebar'><div class='noAds wideMenuLayout'><main>{STORY}</main></div></div>",
    "form around": f"<form action=x><div>{PARA[0]}</div><article>{STORY}</article><p>{PARA[0]}</p></form>",
    "heading apart": f"<div>x</div><div><h1>Title of it</h1></div><div>{STORY[len('<h1>Title of it</h1>'):]}</div>",
    "hidden": f"<article><p hidden>no</p><p style='display: none'>no</p><div aria-hidden=true>no</div>{STORY}</article>",
    "quotes": f"<article data-x='>' title=\"a > b\">{STORY}<p title=\"open></article>",
    "white space": "<article>" + STORY.replace(" ", "\n\t&nbsp; ").replace("\n\t&nbsp; href", " href") + "</article>",
}


@pytest.mark.parametrize("name", CASES)
def test_page_text_of_odd_pages(name):
    assert html_text.main_text(CASES[name]) == WANT


@pytest.mark.parametrize("html,text", [
    ("", ""), ("<nav>menu</nav>", ""), ("plain words &lt;here&gt;", "plain words <here>"), ("a < b & c", "a < b & c"),
    ("<p>one<p>two<br>three", "one two three"), ("<p>un<b>bro</b>ken</p>", "unbroken"), ("<!-- never closed <p>x", ""),
    ("<script>never closed <p>x", ""), ("<p>cut in a tag <a href=", "cut in a tag"), ("</p></div>stray", "stray"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"), ("<![CDATA[x]]><?php y ?><!DOCTYPE html>z", "z"), ("<p>&am &amp &#65;&#x42;", "&am & AB")])
def test_page_text_of_fragments(html, text):
    assert html_text.main_text(html) == text


def test_page_text_rows(spark):
    rows = [(1, "u", None), (1, "u", None), (None, None, "<p>no id"), (2, "v", ""), (3, "w", "<article><p>" + "many words " * 200_000 + "</article>"),
            (4, "x", "<i>" * 20_000 + "deep" + "</b>" * 20_000), (5, "y", "<a<a<a" * 20_000), (6, "z", "<p title=\"" * 20_000 + ">x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("clash") for c in ("id", "text", "n_chars")})
    out = {(r.id, r.url): (r.text, r.n_chars, r.n_kept <= r.n_blocks) for r in html_text.extract_text(df).collect()}
    long = " ".join(["many words"] * 200_000)
    assert out == {(1, "u"): ("", 0, True), (None, None): ("no id", 5, True), (2, "v"): ("", 0, True), (3, "w"): (long, len(long), True),
                   (4, "x"): ("deep", 4, True), (5, "y"): ("", 0, True), (6, "z"): ("x", 1, True)}
    assert html_text.extract_text(df).count() == len(rows) and html_text.extract_text(df.limit(0)).count() == 0
