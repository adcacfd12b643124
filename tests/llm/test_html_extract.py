"""HTML lines, alignment and differences of near pages against brute force."""

import random
import re
from html import unescape
from html.parser import HTMLParser

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from txprep.llm.html_extract import common_lines, extract_pages, shared_path
from txprep.llm.html_lines import decided, read_lines

PAGES = "page_id long, url string, html string, host string, path string, page_a long, deleted string, place long, text string"


def text_of(page):
    lines = read_lines(page)
    return " ".join(x.text for x, k in zip(lines, decided(lines)) if k)


def lcs_length(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=30), st.lists(st.integers(0, 5), max_size=30), st.sampled_from([8, 1 << 28]))
def test_common_lines_are_a_longest_common_subsequence(a, b, bits):
    found = common_lines(a, b, bits)
    assert found == sorted(set(found)) and len(found) == lcs_length(a, b)
    rest = iter(b)
    assert all(any(a[i] == y for y in rest) for i in found)


@pytest.mark.parametrize("page, text", [
    ("", ""), ("just text", "just text"), ("x < y & z &lt;b&gt; &copy; &#8364;", "x < y & z <b> © €"),
    ("<article><p>a<b>b</b>c<p>d&nbsp;\n\t e<br>f</article>", "abc d e f"),
    ("<body><nav><p>menu</nav><article><h1>T</h1>one<span class='ad'>no</span>two</article><footer>f</footer>", "T onetwo"),
    ("<header>site</header><article><header><h1>H</h1></header>x</article>", "H x"),
    ("<div class='site-header'>s</div><div>text</div><div id=cookieNotice>c</div><form>f<input value=v></form>", "text"),
    ("<article>a<aside>s</aside>b<section class=comments><article class=comment>c</article></section></article>", "a b"),
    ("<main><h1>M</h1><p>m</main><p>after", "M m"), ("<main>m<article>a</article></main>", "a"),
    ("<script>if (a<b) '</p>'</script>s<style>x</style>t<!-- <p>c</p> -->u<textarea><p>v</textarea>", "s tu"),
    ("<ul><li><a href=x>menu</a><li><a>more</a></ul><p>t", "t"), ("<article><ul><li><a href=x>kept</a></ul></article>", "kept"),
    ("<p title='a>b'>q</p></div></p>r</ >s", "q rs"), ("text <a title=\"never ends", "text"), ("a <b", "a"),
    ("<div class='layout-with-sidebar'><p>in</p></div><p hidden>h</p><p style='display: none'>n</p>", "in"),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1 2 3"), ("<title>t</title><p>&amp;amp; &am", "&amp; &am"),
])
def test_text_of_pages(page, text):
    assert text_of(page) == text


class Article(HTMLParser):
    """The article of well-formed pages, by another parser."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.inside, self.parts = False, []

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        self.parts.append(" " if tag in ("p", "br", "h1") else "")

    def handle_endtag(self, tag):
        self.inside &= tag != "article"
        self.parts.append(" " if tag in ("p", "h1") else "")

    def handle_data(self, data):
        self.parts.append(unescape(data) if self.inside else "")

    def handle_entityref(self, name):
        self.parts.append(unescape(f"&{name};") if self.inside else "")


def test_given_pages_equal_another_parser(spark):
    from txprep.llm.queries import QUERIES
    rows = QUERIES["op13_html_extract"](spark, "/root/testdata/sf0.01").collect()
    pages = {r["page_id"]: r for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        other = Article()
        other.feed(pages[r["page_id"]]["html"] or "")
        assert r["text"] == " ".join("".join(other.parts).split())
        assert r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]


def site(host, path, own, menu=("Home", "News"), foot="All rights", mark=""):
    body = "".join(f"<div>{x}</div>" for x in (*menu, *own, foot))
    return f"http://{host}/{path}{mark}", f"<html><body>{body}</body></html>"


def without_near(pages):
    """Brute force: for each (url, html) the lines that its neighbours in the
    order of (host, path) don't share, for pages without any mark-up of theirs."""
    split = {}
    for url, page in pages:
        found = re.match(r"[a-z]+://([^/?#]*)([^?#]*)", url or "")
        if found and found[1]:
            split.setdefault(found[1].lower(), {}).setdefault(page, []).append(found[2])
    out = {}
    for host, contents in split.items():
        order = sorted((min(paths).replace("/", "\x01"), page) for page, paths in contents.items())
        for i, (path, page) in enumerate(order):
            lines = re.findall(r"<div>(.*?)</div>", page)
            near = [order[j] for j in (i - 1, i + 1) if 0 <= j < len(order)]
            most = max((shared_path(path.replace("\x01", "/"), p.replace("\x01", "/")) for p, _ in near), default=0)
            gone = set()
            for p, other in near:
                if shared_path(path.replace("\x01", "/"), p.replace("\x01", "/")) == most:
                    common = common_lines(lines, re.findall(r"<div>(.*?)</div>", other))
                    if sum(len(lines[k]) for k in common) <= 0.9 * sum(map(len, lines)):
                        gone.update(common)
            out[host, page] = " ".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def test_differences_of_near_pages(spark):
    rng = random.Random(4)
    pages = []
    for host in ("a.example.com", "b.example.org"):
        for i in range(40):
            own = [f"{host} page {i} line {k} says {rng.random()}" for k in range(rng.randrange(1, 6))]
            menu = ("Home", "News") if i % 2 else ("Home", "About us", "News")
            pages.append(site(host, f"{rng.choice(['x', 'y', 'y/z'])}/{i:02d}.html", own, menu))
    pages += [pages[3]] * 30                                               # copies of a page are one neighbour
    pages.append(site("c.example.net", "only", ["alone"]))
    rows = [(i, url, page) for i, (url, page) in enumerate(pages)]
    docs = spark.createDataFrame([(*r, "h", "p", 1, "d", 2, "t") for r in rows], PAGES).repartition(5)
    got = {r["page_id"]: r["text"] for r in extract_pages(spark, docs).collect()}
    want = without_near(pages)
    assert len(got) == len(rows)
    for i, url, page in rows:
        assert got[i] == want[re.match(r"http://([^/]*)", url)[1], page], url
    assert got[80] == got[3] and "Home" not in got[3]
    assert got[len(rows) - 1] == "Home News alone All rights"


def test_prose_and_copies_stay_and_classed_lines_go(spark):
    article = "<article><p>Same sentence.</p><p class='tag'>Filed under news</p><p>{}</p></article>"
    rows = [(i, f"https://h.example.com/n/{i}", article.format(f"own text of page number {i} " * 3)) for i in range(4)]
    copies = [(10 + i, f"https://k.example.com/n/{i}", f"<p>a copied page with one line</p><p>and a second</p><p>{i}</p>")
              for i in range(3)]
    docs = spark.createDataFrame(rows + copies, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in extract_pages(spark, docs).collect()}
    for i in range(4):
        assert got[i] == f"Same sentence. {' '.join([f'own text of page number {i}'] * 3)}"
    assert got[11] == "a copied page with one line and a second 1"


def test_awkward_pages(spark):
    long_page = "<div>" + "</div><div>".join(f"line {i}" for i in range(20_000)) + "</div>"
    rows = [(None, None, None), (1, None, "<p>no url"), (2, "not a url", "<p>x"), (3, "http://h/a", ""), (3, "http://h/a", ""),
            (4, "http://h/b", long_page), (5, "http://h/c", long_page.replace("line 7<", "line seven<")), (6, "http://h/\x00", "<p>\x00")]
    docs = spark.createDataFrame([(*r, "h", "p", 1, "d", 2, "t") for r in rows], PAGES)
    out = extract_pages(spark, docs)
    assert out.columns == ["page_id", "url", "text", "n_lines", "n_shared"]
    got = sorted(((r["page_id"] or 0, r["text"]) for r in out.collect()))
    assert got[0] == (0, "") and got[1] == (1, "no url") and got[2] == (2, "x") and got[3] == got[4] == (3, "")
    assert got[5][1] == " ".join(f"line {i}" for i in range(20_000)) and got[6][1].count("line") == 20_000
    assert extract_pages(spark, docs.limit(0)).count() == 0
