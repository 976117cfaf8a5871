import html
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from rawloom.llm import main_text, neighbours, url_filter


def test_url_filter_matches_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    want = sorted(con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({url_filter.SQL})").fetchall(), key=str)
    assert sorted(map(tuple, url_filter.op8_url_filter(spark, sf).collect()), key=str) == want


ODD_URLS = [
    None, "", "no scheme", "http://", "http://EXAMPLE.org", "http://EXAMPLE.org/", "x://a.example.org/es/1", "http://example.org/en/1?x=/es/",
    "http://example.org/en/2#/en/1", "http://badexample.org/es/", "http://a.com/DE/", "http://a.com/de/", "http://com/fr/x", "http://a.com?/fr/",
    "http://user@org:80/", "http://x.org:80/es/", "http://a.net/x.org/", "://b.com/fr/", "http://a.com/fr/ü/" + "y" * 3000, "http://a.com/fr/", "http://é.org/",
]


def by_hand(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group().translate({i: i + 32 for i in range(65, 91)})
    path = re.match(r"[^?#]*", rest[len(host) :], re.S).group()
    best = None
    for rule in url_filter.RULES:
        if (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path) and (best is None or len(rule.name) > len(best.name)):
            best = rule
    return host, path, best.name if best else None, best.verdict if best else "allow"


def test_odd_urls(spark):
    df = spark.createDataFrame([(u, 1, "h") for u in ODD_URLS * 2], "url string, fitting_rule int, host string")
    got = url_filter.url_filter(df).collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in got] == [by_hand(u) for u in ODD_URLS * 2]
    assert url_filter.url_filter(df.limit(0)).count() == 0


def test_many_globs_over_several_words():
    import pyarrow as pa

    from rawloom.llm import ragged

    globs = [f"*.site{i}.example/a{i}/**" for i in range(40)] + ["**", "x*y", "*", ""]
    texts = ["www.site7.example/a7/b", "site7.example/a7/b", ".site39.example/a39/", "xy", "x/y", "xaay", "", "q.site7.example/a8/"]
    data, offsets = ragged.flat(pa.array(texts))
    got = url_filter.Automaton(globs).matches(data, offsets)
    as_pattern = lambda g: "".join(".*" if p == "**" else "[^/]*" if p == "*" else re.escape(p) for p in re.split(r"(\*\*|\*)", g))
    assert got.tolist() == [[bool(re.fullmatch(as_pattern(g), t, re.S)) for g in globs] for t in texts]


def test_main_text_of_pages(spark, sf):
    got = {r.page_id: (r.text, r.n_chars) for r in main_text.op7_html_extraction(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S).group(1)
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inner.replace("<br>", " ")))
        text = "\n".join(t for t in (" ".join(html.unescape(p).split()) for p in parts) if t)
        assert got[r.page_id] == (text, len(text))


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header class=top><h2>Site</h2></header><nav role="navigation"><ul><li><a href="/a">A</a></ul></nav>
<!-- note <p>no</p> --><div id="cookie-notice">We use cookies</div>
<article class="post"><header><h1>Head &amp; more</h1></header><p>First <b>bold</b>&nbsp;text<br>goes
on<p>Second<ul><li>one<li>two <i>&lt;3</i></ul><form><input value="x">Mail</form><script>var a="</p>"</script>
<table><tr><td>c1<td>c2<tr><td>c3</table><aside>Aside</aside><section class="comments"><p>First!</p></section><footer>By me</footer></article>
<div class="sidebar">Side</div><footer>Foot</footer>"""


def test_marked_page():
    assert main_text.main_text(PAGE).split("\n") == ["Head & more", "First bold text goes on", "Second", "one", "two <3", "c1", "c2", "c3"]


def test_pages_without_marks():
    assert main_text.main_text("<div class=ad>buy</div><div><h1>A</h1>b &#x41; c</div>tail<p>d") == "A\nb A c\ntail\nd"
    assert main_text.main_text("plain text\n only") == "plain text only"
    assert main_text.main_text("<p hidden>x</p><p aria-hidden='true'>y</p><article class='comment'>z</article><p>w</p>") == "w"


@pytest.mark.parametrize("attributes", ['style="overflow:hidden"', 'title="Hidden gems"', 'data-hidden="false"', 'data-id="ad"', "data-role=menu", "data-x='a id=ad hidden'"])
def test_attributes_by_whole_names(attributes):
    assert main_text.main_text(f"<article {attributes}><p>Text</article>") == "Text"
    assert main_text.main_text(f"<div {attributes}><p>Text</div>") == "Text"


def test_articles_below_noise_and_main_elements():
    text = main_text.main_text
    for wrapper in ('div class="sidebar-right"', "div id=menu-open", "form action=/x", "div class=widget", "aside"):
        tag = wrapper.split()[0]
        assert text(f"<{wrapper}><div>Other</div><article><header>H</header><p>Story</article></{tag}><footer>F</footer>") == "H\nStory"
        assert text(f"<{wrapper}><nav>N</nav><main><p>Story</main></{tag}>") == "Story"
    assert text("<article>Short</article><form><article>The long story itself</article></form>") == "The long story itself"
    assert text("<article>Short</article><aside><article>A longer teaser</article></aside>") == "Short"
    assert text("<div hidden><article>Old</article></div><p>New") == "New"
    assert text("<main><p>All of the long story</p><article>Teaser</article></main>") == "All of the long story\nTeaser"
    assert text("<main><p>All of the long story</p></main><article>Teaser</article>") == "All of the long story"
    assert text("<main><p>Intro</p><article>The long story itself</article></main>") == "The long story itself"


def test_style_tree(spark):
    """Branches that the pages of a host repeat go, from pages that don't mark their article."""
    page = "<body><div class='box'>Always the same {k}<ul><li>x</li></ul></div><div class='text'><p>Story {i} about {i}</p></div></body>"
    rows = [(i, f"http://one.example/{i}", page.format(i=i, k="here")) for i in range(8)]
    rows += [(10, "http://two.example/1", page.format(i=10, k="here")), (11, None, page.format(i=11, k="here")), (12, "http://one.example/n", None), (13, "http://one.example/n", "")]
    rows += [(14, "http://one.example/m", "<article>" + page.format(i=14, k="here") + "</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"site": F.lit(1), "text": F.lit("t")})
    got = {r.page_id: r.text for r in main_text.extract(df).collect()}
    for i in range(8):
        assert got[i] == f"Story {i} about {i}"
    for i in (10, 11, 14):
        assert got[i] == f"Always the same here\nx\nStory {i} about {i}"
    assert got[12] == got[13] == ""
    assert main_text.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("opening, closing", [("<article class=p{i}>", "</article>"), ("<main>", "</main>"), ("<div role=main>", "</div>")])
def test_style_tree_below_marks(spark, opening, closing):
    """What a host repeats inside its articles or mains goes; copies of a page are one page."""
    block = "<div class=box>Read our <b>daily</b> letter</div>"
    rows = [(i, "http://one.example/a", f"<nav>N</nav>{opening.format(i=i)}<h1>Story {i}</h1>{block}<p>Text {i * i}</p>{closing}") for i in range(8)]
    rows += [(i, f"http://two.example/{i}", f"{opening.format(i=0)}<h1>Same story</h1><p>Same text</p>{closing}<div class=ad>{i}</div>") for i in range(10, 18)]
    rows += [(i, f"http://three.example/{i}", f"<!-- <article> --><script>'<main>'</script><p>Story {i}</p>{block}") for i in range(20, 28)]
    rows += [(30, "http://one.example/b", f"<p>Unmarked</p>{block}")]
    rows += [(31, "http://four.example/b", f"{opening.format(i=0)}{'<div>' * 3000}deep")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in main_text.extract(df).collect()}
    assert got == {i: f"Story {i}\nText {i * i}" for i in range(8)} | {i: "Same story\nSame text" for i in range(10, 18)} | {
        **{i: f"Story {i}" for i in range(20, 28)}, 30: "Unmarked\nRead our daily letter", 31: "deep"
    }


def test_nothing_lost_in_articles():
    text = main_text.main_text
    for part in ('p class="related-work"', 'p class="ad-hoc"', 'div class="social"', "p class=menu-of-the-day", "p id=shared-memory", "math"):
        tag = part.split()[0]
        assert text(f"<article><h1>A</h1><{part}>Kept</{tag}><p>B</article>").split() == ["A", "Kept", "B"]
    for part in ('div class="ad"', "section id=comments", "div class=cookie-notice", "aside", "nav", "form", "div role=navigation"):
        assert text(f"<article><h1>A</h1><{part}>Gone</{part.split()[0]}><p>B</article>") == "A\nB"
    assert text("<p title=it's>first</p><p>don't</p><p>z</p>") == "first\ndon't\nz"
    assert text("<p a= b>x</p><p a==b c='>' d=\">\">y</p><p class=>z</p><p q='>w") == "x\ny\nz\nw"
    assert text("<p " + "a=b " * 50_000).startswith("<p a=b")  # no end, in linear time


def test_style_tree_of_wrappers(spark):
    """What surrounds an article stays, whatever it is called; boxes of one form go, an ambiguous name only if its contents repeat."""
    page = '<div class=widget><article><h1>S {i}</h1><div class=social>{s}</div><p>T {i}</article></div><div class="box">{b}</div><footer>F {i}</footer>'
    rows = [(i, f"http://one.example/{i}", page.format(i=i, s=f"about {i}", b="b")) for i in range(6)]
    rows += [(i, f"http://two.example/{i}", page.format(i=i, s="Share this", b="b")) for i in range(10, 16)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in main_text.extract(df).collect()}
    assert got == {i: f"S {i}\nabout {i}\nT {i}" for i in range(6)} | {i: f"S {i}\nT {i}" for i in range(10, 16)}


def test_style_tree_against_plain_entropies(spark, sf):
    rows = [(by_hand(r.url)[0], r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    seen = {}
    for host, page in rows:
        for path, above, named, style, content, whole in main_text.branches(page or "") if host else ():
            seen.setdefault((host, path), {}).setdefault(whole, []).append((above, named, style, content))

    def entropy(values):
        counts, n = {}, len(values)
        for v in values:
            counts[v] = counts.get(v, 0) + 1
        return -sum(c / n * np.log(c / n) for c in counts.values()) / np.log(n) if n > 1 else 1.0

    low = {}
    for (host, path), pages in seen.items():
        first = [min((named, style, content) for _, named, style, content in rows) for rows in pages.values()]
        style, content = entropy([f[1] for f in first]), entropy([f[2] for f in first])
        named = min(f[0] for f in first)
        importance = style if named else (1 - main_text.CONTENT) * style + main_text.CONTENT * content
        if len(pages) >= main_text.PAGES and importance < main_text.LEAST:
            low[host, path] = min(rows[0][0] for rows in pages.values())
    want = {(host, path) for (host, path), above in low.items() if (host, above) not in low}
    df = spark.createDataFrame(rows, "host string, html string")
    got = [(r.site, r.path) for r in main_text.style_tree(df).collect()]
    assert set(got) == want and len(got) == len(want) > 0
    # menus, adverts and footers of every host with enough pages
    top = lambda name: main_text._below(0, name)
    hosts = {h for h, _ in want}
    assert {(h, top(name)) for h in hosts for name in ("nav", "div.ad", "footer")} <= want


def brute_nearest(ids, vectors, queries, k=5):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    out = {}
    for q in queries:
        i = ids.index(q)
        score = unit @ unit[i]
        best = sorted((-s, o) for s, o in zip(score, ids) if o != q)[:k]
        out[q] = [o for _, o in best]
    return out


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_recall(spark, sf):
    got = {}
    for r in neighbours.op4_nearest_neighbours(spark, sf).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids, vectors = [r.vec_id for r in rows], np.array([r.embedding for r in rows], float)
    want = brute_nearest(ids, vectors, [i for i in ids if i % 50 == 0])
    assert set(got) == set(want)
    recall = np.mean([len({v for _, v, _ in got[q]} & set(want[q])) / 5 for q in want])
    assert recall >= 0.9
    for q, found in got.items():
        assert [r for r, _, _ in sorted(found)] == list(range(1, len(found) + 1))
        for _, v, s in found:
            a, b = vectors[ids.index(q)], vectors[ids.index(v)]
            assert abs(s - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-12


def test_odd_vectors(spark):
    same = [1.0, 2.0, 3.0]
    rows = [(i, same) for i in range(0, 40)] + [(100, None), (101, []), (102, [0.0, 0.0, 0.0]), (103, [1.0, None, 1.0]), (104, [1.0, float("nan"), 0.0]),
            (105, [float("inf"), 1.0, 1.0]), (None, same), (150, [2.0, 4.0, 6.0]), (200, [1.0, 1.0]), (250, [-0.0, 1.0, 0.0]), (250, [-0.0, 1.0, 0.0])]
    df = spark.createDataFrame([(k, v, 1, 2.0) for k, v in rows], "vec_id long, embedding array<float>, bucket int, score double")
    got = {}
    for r in neighbours.nearest(df, df.where("vec_id % 50 = 0")).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert [v for _, v in sorted(got[0])] == [1, 2, 3, 4, 5]
    assert [v for _, v in sorted(got[150])] == [0, 1, 2, 3, 4]
    assert 200 not in got and 100 not in got
    assert neighbours.nearest(df.limit(0), df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [2, 3, 4, 6, 40])
def test_all_candidates_of_small_tables(spark, n):
    """Random vectors that share no bucket, besides some of another size: each query has all others up to five, in order."""
    rng = np.random.default_rng(n)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((n, 64)))] + [(100 + i, v.tolist()) for i, v in enumerate(rng.standard_normal((2, 8)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.nearest(df, df).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    for i, v in rows:
        near = sorted((-float(np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w)), j) for j, w in rows if j != i and len(w) == len(v))
        assert len(got.get(i, [])) == min(5, len(near))
        if n <= 6:
            assert got[i] == [j for _, j in near[:5]]
