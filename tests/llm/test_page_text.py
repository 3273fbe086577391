"""Page texts against known articles and a plain longest common subsequence."""

from __future__ import annotations

import html
import random
import re

from riskmill.llm import page_text
from riskmill.llm.page_text import LOOSE, MAIN, page_lines, shared_places
from riskmill.llm.queries import QUERIES


def test_query_gives_articles(spark, small):
    pages = {r.page_id: r for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    rows = QUERIES["op6_page_text"](spark, small).collect()
    assert len(rows) == len(pages)
    for row in rows:
        article = re.search("<article>(.*?)</article>", pages[row.page_id].html, re.S)[1]
        blocks = re.split("</?(?:p|h1)>", article)
        texts = [" ".join(html.unescape(re.sub("<[^>]*>", " " if "br" in b else "", b)).split()) for b in blocks]
        assert row.text == "\n".join(t for t in texts if t)
        assert row.n_chars == len(row.text) and row.url == pages[row.page_id].url


def test_markup():
    source = """<html><head><title>no</title></head><body class="header-fixed"><header>no</header>
      <div class="cookie-notice">no<div>no</div></div><main><h1>A &amp; B&copy;</h1><p>one<br>two <b>three
      <p>four&nbsp;five<!-- no > --><script>var a = "</p><p>no";</script><form><p>no</form>
      <section id="comments"><p>no</p></section><ul><li>x<li>y</ul><p hidden>hid<a title="a > b" href='>'>link</a></main>
      <aside>no</aside>loose<footer>no</footer></body></html>tail"""
    assert page_lines(source) == [("A & B©", MAIN), ("one two three", MAIN), ("four five", MAIN), ("x", MAIN), ("y", MAIN),
                                  ("loose", LOOSE), ("tail", LOOSE)]
    assert page_lines("") == [] and page_lines("a < b") == [("a < b", LOOSE)]
    assert page_lines("<script>x") == [] and page_lines("<p>a<!-- x") == [("a", LOOSE)]
    assert page_lines('<p>a<a href="x>b</a>c') == page_lines('<p>a<a href="x>b</a>c')


def test_roles_inside_an_article():
    source = """<div class="share-box">no</div><article><header><h1>Head</h1></header><p>a</p><div class="share-price">b</div>
      <div class="big share">no</div><nav>no</nav><footer>no</footer></article>"""
    assert page_lines(source) == [("Head", MAIN), ("a", MAIN), ("b", MAIN)]


def slow_pages(rows):
    """Every version of a host against the versions before and after it, by the plain subsequence table."""
    versions = {}
    for page, url, source in rows:
        host, path = page_text.address(url)
        lines = tuple(t for t, _ in page_lines(source or ""))
        at = (path, page is not None, page or 0)
        versions[host, lines] = min(versions.get((host, lines), at), at)
    out = []
    for page, url, source in rows:
        host = page_text.address(url)[0]
        found = page_lines(source or "")
        if any(r == MAIN for _, r in found):
            out.append((page, "\n".join(t for t, r in found if r == MAIN)))
            continue
        lines = tuple(t for t, _ in found)
        order = sorted((at, other) for (h, other), at in versions.items() if h == host)
        place = [other for _, other in order].index(lines)
        drop = set()
        for i in (place - 1, place + 1):
            if 0 <= i < len(order):
                drop |= set(shared_places(list(lines), list(order[i][1])))
        out.append((page, "\n".join(t for i, t in enumerate(lines) if i not in drop)))
    return sorted(out, key=repr)


def test_pages_without_marks_equal_brute_force(spark, small, monkeypatch):
    monkeypatch.setattr(page_text, "BUCKET", 4)
    plain = lambda h: re.sub("</?article>", "", h)
    rows = [(r.page_id, r.url, plain(r.html)) for r in spark.read.parquet(f"{small}/pages.parquet").collect()]
    rng = random.Random(4)
    top = [f"<div>line {i}</div>" for i in range(6)]
    rows += [(1000 + i, f"http://h{i % 3}/p/{rng.randrange(40)}", "".join(rng.sample(top, 3)) + f"<p>own {i // 2}</p>") for i in range(120)]
    rows += [(2000 + i, "http://h0/p/7", "<p>copy</p><div>line 1</div>") for i in range(30)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)
    got = sorted(((r.page_id, r.text) for r in page_text.extract_pages(pages).collect()), key=repr)
    assert got == slow_pages(rows)


def slow_common(a: list[str], b: list[str]) -> int:
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_longest_common_subsequence():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(12))] for _ in range(2))
        places = shared_places(a, b)
        assert places == sorted(set(places)) and len(places) == slow_common(a, b)
        rest = iter(b)
        assert all(a[i] in rest for i in places)


def test_unmarked_pages_lose_shared_lines(spark, monkeypatch):
    monkeypatch.setattr(page_text, "BUCKET", 3)
    page = "<div>Top {h}</div><div>text {i} a</div><p>text {i} b</p><div>Bottom</div>"
    rows = [(i, f"http://{h}/p/{i:03d}", page.format(h=h, i=i)) for i, h in enumerate(["x"] * 20 + ["y"] * 2)]
    rows += [(50, "http://alone/", "<p>Top x</p>"), (51, None, None), (52, "", ""), (None, "http://z/a", "<p>q</p>"), (None, "http://z/a", "<p>q</p>")]
    pages = spark.createDataFrame([(*r, "c", 1) for r in rows], "page_id bigint, url string, html string, host string, rank int")
    out = page_text.extract_pages(pages.repartition(5)).collect()
    assert len(out) == len(rows)
    by = {r.page_id: r.text for r in out}
    for i in range(22):
        assert by[i] == f"text {i} a\ntext {i} b"
    assert by[50] == "Top x" and by[51] == by[52] == "" and by[None] == "q"  # copies do not blank each other
    assert page_text.extract_pages(pages.limit(0)).count() == 0


def test_elements():
    source = """<main><h1>Head</h1><article>a<div itemprop="articleBody">b</div><main>c</main></article><p>d</p>
      <article>e</article></main>f<div role="main">g</div>"""
    assert page_text.page_blocks(source) == [("Head", 1), ("a", 2), ("b", 2), ("c", 2), ("d", 1), ("e", 3), ("f", 0), ("g", 4)]


def test_dense_subsequences(monkeypatch):
    rng = random.Random(5)
    monkeypatch.setattr(page_text, "DENSE", -1)
    for n in [0, 1, 3, 12, 90] * 60:
        a, b = ([rng.choice("abcdefgh"[: 1 + n // 10]) for _ in range(rng.randrange(n + 1))] for _ in range(2))
        pairs = page_text.shared_pairs(a, b)
        assert len(pairs) == slow_common(a, b) and all(a[i] == b[j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))


def texts(spark, *rows):
    pages = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id bigint, url string, html string")
    return [r.text for r in page_text.extract_pages(pages.repartition(3)).orderBy("page_id").collect()]


def test_differencing_decides_about_marked_elements(spark, monkeypatch):
    monkeypatch.setattr(page_text, "BUCKET", 3)
    page = "<div>Top</div><article class=x><p>Our story</p><p>Read it</p></article><article><h1>News</h1><p>own {i}</p></article>"
    assert texts(spark, *[(f"http://x/{i:02d}", page.format(i=i)) for i in range(9)]) == [f"News\nown {i}" for i in range(9)]
    area = "<main><div>Top stories</div><article><p>Same</p><p>own {i}</p></article></main>"
    assert texts(spark, *[(f"http://x/{i:02d}", area.format(i=i)) for i in range(9)]) == [f"Same\nown {i}" for i in range(9)]


def test_marks_keep_articles_that_neighbours_share(spark):
    one, two = "<article><p>a</p><p>b</p></article>", "<article><p>c</p></article>"
    # A neighbour without other text of its own is no evidence of a template, nor is a lone article or a copy.
    assert texts(spark, ("http://x/1", one + two), ("http://x/2", one)) == ["a\nb\nc", "a\nb"]
    assert texts(spark, ("http://x/1", one), ("http://x/2", one + "<div>ad</div>"), ("http://x/3", one)) == ["a\nb"] * 3
    assert texts(spark, ("http://x/1", one + two), ("http://y/2", one + "<article>d</article>")) == ["a\nb\nc", "a\nb\nd"]
    # Shared with one neighbour of two; a line marked on one of two pages with equal lines.
    assert texts(spark, ("http://x/1", one + two), ("http://x/2", one + "<article>d</article>"), ("http://x/3", "<article>e</article>")) == ["c", "a\nb\nd", "e"]
    assert texts(spark, ("http://x/1", "<p>top</p><article>q</article>"), ("http://x/2", "<p>top</p><p>q</p>")) == ["q", "top\nq"]
