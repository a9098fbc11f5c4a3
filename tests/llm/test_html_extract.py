"""HTML extraction: hand-marked pages, the article element of real pages, hard rows."""

import html
import re

import pytest

from winback.llm import html_extract as h

RULES = h.Rules(h.STOP_WORDS, h.LONG, h.STOP_SHARE, h.LINK_SHARE)
PROSE = "It was the first day of the year and all of them had gone to the sea by noon, as is the custom."


def text(page):
    return h.main_text(page, RULES)


def test_article_of_real_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in h.extract(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        blocks = re.split("</?(?:p|h1)>", re.search("<article>(.*)</article>", r.html, re.S)[1])
        blocks = [" ".join(html.unescape(re.sub("<br>|</?b>", " ", b)).split()) for b in blocks]
        want = "\n".join(filter(None, blocks))
        assert got[r.page_id] == (r.url, want, len(want))


@pytest.mark.parametrize("tag,end", [
    ("<nav>", "</nav>"), ("<header class=top>", "</header>"), ("<footer>", "</footer>"), ("<aside>", "</aside>"),
    ("<div class='page-ad wide'>", "</div>"), ("<div id=cookieNotice>", "</div>"), ("<form>", "</form>"),
    ("<section class=\"comments\" title=\"a > b\">", "</section>"), ("<div role=navigation>", "</div>"),
    ("<div hidden>", "</div>"), ("<p class=advert>", "</p>"), ("<article class='comment'>", "</article>"),
    ("<noscript>", "</noscript>"), ("<script>", "</script>"), ("<style>", "</style>"), ("<!-- ", " -->"),
    ("<template>", "</template>")])
def test_boilerplate_containers(tag, end):
    junk = f"{tag}{PROSE}{end}"
    assert text(f"<body>{junk}<article><h1>Title</h1><p>{PROSE}</p><p>Short.</p></article>{junk}") == \
        f"Title\n{PROSE}\nShort."
    if "header" not in tag:         # an article's own header holds its title
        assert text(f"<body><article><h1>Title</h1><p>{PROSE}</p>{junk}<p>Short.</p></article>") == \
            f"Title\n{PROSE}\nShort."
    assert text(f"<div>{PROSE}</div>{junk}<div>Short.</div>") == f"{PROSE}\nShort."


def test_densities_and_neighbours():
    links = "<ul>" + "<li><a href=/x>One of the many things to see</a></li>" * 3 + "</ul>"
    # outside of articles: links decide lists, a short block follows the nearest decided block
    assert text(f"<div>{links}<p>Ours</p><p>{PROSE}</p><p>Next</p></div>") == f"{PROSE}\nNext"
    assert text(f"<div>{links}<p>a</p><p>b</p><p>{PROSE}</p></div>") == f"b\n{PROSE}"
    # no known stop words: ambiguous, kept in an article, and on a page without one
    other = "слово " * 30
    assert text(f"<article><p>{other}</p></article>") == other.strip()
    assert text(f"<div>{other}</div>") == other.strip()
    # prose outside of the article of a page that has one
    assert text(f"<div>{PROSE}</div><article><p>Tiny</p></article><p>{PROSE}</p>") == "Tiny"
    assert text("<div class=has-sidebar><main><div class='entry-header'><h1>T</h1></div>x</main></div>") == "T\nx"


def test_markup():
    assert text("<article><p>a &lt;b&gt; &amp;amp; &eacute;&#233; x&amp</p></article>") == "a <b> &amp; éé x&"
    assert text("<article><p>a\n\t b&nbsp; c<br>d<b>e</b>f</p>g<div>h</div></article>") == "a b c def\ng\nh"
    assert text("<article><p><b>a<br><p>b<p>c</b>d</article>e") == "a\nb\ncd"
    assert text("<article>1 < 2 <3 <p>x</div>y</article>") == "1 < 2 <3\nx\ny"
    assert text('<article><p title="</article>>">a</p><script>"</p>"</SCRIPT >b</article') == "a\nb"
    assert text("<article><p>a</p><!-- never closed <p>b</p>") == "a"
    assert text("<article><table><tr><td>a<td>b<tr><td>c</table><ul><li>d<li>e</ul>") == "a\nb\nc\nd\ne"
    assert text("<ARTICLE><P>a</P></ARTICLE>") == "a"
    assert text("<p>a<p class='") == "a"
    assert text("") == text(None) == text("<p></p> <br>") == ""


def test_long_and_broken_pages_are_linear():
    import time
    t = time.time()
    n = 100_000
    assert text("<article><p>" + "<b>" * n + "x" + "</i>" * n) == "x"
    assert text("<div>" * n + "x" + "</div>" * n) == "x"
    assert text("<article>" + "<" * n) == "<" * n
    assert text("<article>" + "<p>a" * n).count("\n") == n - 1
    assert text("<article>" + "y" * 3_000_000) == "y" * 3_000_000
    assert len(text("<a " + "='" * n)) == 0
    assert time.time() - t < 30


def test_hard_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    rows = [(None, None, f"<p>{PROSE}</p>", "clash", "c"), (1, "u", None, None, None), (1, "u", "", None, None),
            (2, "v", "<article>a</article>", "z", None), (2, "v", "<article>a</article>", "z", None)]
    got = h.extract(spark.createDataFrame(rows, schema))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted([
        (None, None, PROSE, len(PROSE)), (1, "u", "", 0), (1, "u", "", 0), (2, "v", "a", 1), (2, "v", "a", 1)], key=str)
    assert h.extract(spark.createDataFrame([], schema)).collect() == []
