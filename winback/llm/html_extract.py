"""Operator 12, HTML extraction: two-pass block rules.

A page is cut into blocks at block-level tags. The first pass decides blocks: a
block is boilerplate if it lies in a container that HTML itself marks as such
(nav, header, footer, aside, form, dialog, or a class, id or role that says menu,
sidebar, notice, advert, comments ...) or if most of its characters are link text;
it is main text if it is long, has a share of stop words as prose has, and few
links. All other blocks (short ones, long ones without known stop words) stay
ambiguous. The second pass gives an ambiguous block the label of the nearest
decided block of its own section (an ``article``/``main``, or what lies outside of
them); of two as near, main text wins inside an article, boilerplate outside.
Where a section has no decided block, an article's blocks are main text, and so
are those of a page without any article; other blocks are not. Long prose outside
of the articles of a page that has one is boilerplate as well.

One narrow pass over the pages, no shuffle: a page is read whole and alone. The
scanner is linear in the page (possessive patterns, indexed stacks).

Defined results. Null html counts as empty; an empty page, or one without main
text, gives an empty text. Null ids and urls are kept, repeated rows give repeated
rows, an empty table an empty result, other columns are ignored. Tags cut off by
the end of the page are dropped; unclosed elements end with the page or where HTML
closes them (p, li, table cells); stray end tags are ignored. Very long texts are
kept whole, with or without blanks.
"""

from __future__ import annotations

import re
from collections import defaultdict
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winback.llm.common import bounded_batches

LONG = 70               # characters from which a block can be decided by its words
STOP_SHARE = 0.12       # stop words among the words of prose, at least
LINK_SHARE = 0.5        # link characters of a boilerplate block, over
PAGES_PER_BATCH = 200

# Frequent function words of the languages that are told from lists.
STOP_WORDS = {
    "en": "the of and to a in is it that for on are as with was be by this from or at an not have has had but which you they we his her".split(),
    "fr": "le la les de des du et un une en que qui dans pour sur est par pas au aux avec ce se plus ne il elle sont cette".split(),
    "de": "der die das und in zu den von mit ist ein eine im dem nicht des auf für sich es auch als an werden aus bei er sie".split(),
    "es": "el la los las de del y en que un una es por para con no se su al lo como más o pero sus este".split(),
}
# Words in a class, id or role that mark a container as no main text;
# the second set inside articles too, the third on an article itself.
OUTER_MARKS = {"header", "masthead", "banner"}
MARKS = set("""ad ads advert adverts advertisement advertising adsense adsbygoogle sponsor sponsored promo promotion
menu menubar nav navbar navigation breadcrumb breadcrumbs pagination pager toc
footer colophon contentinfo
sidebar aside complementary widget widgets related share sharing social
notice notices alert cookie cookies consent gdpr popup modal overlay dialog alertdialog disclaimer
form search login signup newsletter subscribe subscription
comment comments commentlist respond replies disqus""".split())
ARTICLE_MARKS = {"comment", "comments", "reply", "replies"}
NEGATIONS = {"has", "no", "with", "without", "is", "hide"}     # "has-sidebar" is no sidebar

SKIPPED = {"script", "style", "title", "textarea", "noscript", "iframe", "xmp", "noembed", "noframes"}
HIDDEN = {"template", "svg", "math", "canvas", "object", "audio", "video", "select", "datalist", "button", "head"}
BOILERPLATE = {"nav", "footer", "aside", "form", "dialog", "menu", "fieldset"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr", "param"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir",
          "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "frameset", "h1", "h2", "h3", "h4",
          "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "listing", "main", "menu", "nav", "ol",
          "optgroup", "option", "p", "plaintext", "pre", "search", "section", "select", "summary", "table", "tbody",
          "td", "tfoot", "th", "thead", "tr", "ul", "button", "template", "svg", "math", "canvas", "object", "audio",
          "video", "datalist"}
# an opening tag closes an open element of these, unless one of the second kind is nearer
_ROW, _LIST = {"table"}, {"ul", "ol", "dir", "menu"}
CLOSES = {"li": ({"li"}, _LIST), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "td": ({"td", "th"}, _ROW), "th": ({"td", "th"}, _ROW), "tr": ({"tr"}, _ROW),
          "option": ({"option"}, {"select", "datalist"})}
# a paragraph is not looked for beyond these
P_LIMITS = BLOCKS - {"p", "address", "center", "h1", "h2", "h3", "h4", "h5", "h6"}

_TAG = re.compile(
    r"""<!--(?:.*?-->|.*\Z)"""
    r"""|<[!?][^>]*+(?:>|\Z)"""
    r"""|<(/?)([A-Za-z][^\s/>]*+)((?:[^>"'=]++|=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z))?+|["'])*+)(>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]++)(?:\s*+=\s*+("[^"]*+|'[^']*+|[^\s>]++))?""")
_MARK = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_WORD = re.compile(r"[^\W\d_]+")
_SPACE = re.compile(r"\s+")
_ENDS = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in SKIPPED}


def attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        out.setdefault(m[1].lower(), unescape((m[2] or "").strip("\"'")))
    return out


def marked(tag: str, text: str, in_article: bool) -> bool:
    """Whether an opening tag starts a container that is not main text."""
    if tag in BOILERPLATE or tag == "header" and not in_article:
        return True
    if not text or tag in ("html", "body"):
        return False
    a = attributes(text)
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or \
            "display:none" in a.get("style", "").replace(" ", "").lower():
        return True
    marks = ARTICLE_MARKS if tag in ("article", "main") else MARKS if in_article else MARKS | OUTER_MARKS
    for name in " ".join(a[k] for k in ("class", "id", "role") if k in a).split():
        words = [w.lower() for w in _MARK.findall(name)]
        if words and words[0] not in NEGATIONS and not marks.isdisjoint(words):
            return True
    return False


class Block:
    __slots__ = ("text", "links", "bad", "section", "article", "label")

    def __init__(self, text: str, links: int, bad: bool, section: int, article: bool):
        self.text, self.links, self.bad, self.section, self.article, self.label = text, links, bad, section, article, 0


class Scanner:
    """Blocks of one page, in page order."""

    def __init__(self, html: str):
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.links: list[str] = []
        self.stack: list[tuple] = []            # (tag, bad, hidden, section, article, links)
        self.at: dict[str, list[int]] = defaultdict(list)
        self.limits: list[int] = [-1]           # where elements lie that a paragraph isn't looked for beyond
        self.state = (False, False, 0, False, False)
        self.sections = 0
        self.scan(html)

    def scan(self, html: str) -> None:
        at, size = 0, len(html)
        while at < size:
            start = html.find("<", at)
            if start < 0:
                self.text(html[at:])
                break
            m = _TAG.match(html, start)
            if not m:                           # a bare "<" is text
                self.text(html[at:start + 1])
                at = start + 1
                continue
            if start > at:
                self.text(html[at:start])
            at = m.end()
            if m[2] is None or m[4] == "":      # a comment, or cut off by the end
                continue
            tag = m[2].lower()
            if m[1]:
                self.close(tag)
            elif tag in SKIPPED:
                end = _ENDS[tag].search(html, at)
                at = size if end is None else end.start()
            else:
                self.open(tag, m[3])
        self.flush()

    def text(self, raw: str) -> None:
        if not self.state[1]:
            self.parts.append(raw)
            if self.state[4]:
                self.links.append(raw)

    def flush(self) -> None:
        if self.parts:
            text = _SPACE.sub(" ", unescape("".join(self.parts))).strip()
            if text:
                links = len(_SPACE.sub(" ", unescape(" ".join(self.links))).strip()) if self.links else 0
                self.blocks.append(Block(text, links, self.state[0], self.state[2], self.state[3]))
            self.parts, self.links = [], []

    def last(self, tags) -> int:
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=-1)

    def cut(self, depth: int, flush: bool = True) -> None:
        """Close all elements from ``depth`` on."""
        if flush:
            self.flush()
        while len(self.stack) > depth:
            self.at[self.stack.pop()[0]].pop()
        while self.limits[-1] >= depth:
            self.limits.pop()
        self.state = self.stack[-1][1:] if self.stack else (False, False, 0, False, False)

    def open(self, tag: str, rest: str) -> None:
        if tag == "br":
            self.text(" ")
            return
        block = tag in BLOCKS
        if block:
            self.flush()
            if tag in CLOSES:
                kinds, limits = CLOSES[tag]
                if (i := self.last(kinds)) >= 0 and i > self.last(limits):
                    self.cut(i)
            if self.at.get("p") and (i := self.at["p"][-1]) > self.limits[-1]:
                self.cut(i)
        if tag in VOID:
            return
        bad, hidden, section, article, links = self.state
        if not bad and (rest or block) and marked(tag, rest, article):
            self.flush()
            bad = True
        if tag in ("article", "main") or rest and "role" in rest and \
                attributes(rest).get("role", "").lower() == "main":
            self.sections += 1
            section, article = self.sections, True
        self.at[tag].append(len(self.stack))
        if tag in P_LIMITS:
            self.limits.append(len(self.stack))
        self.state = (bad, hidden or tag in HIDDEN, section, article, links or tag == "a")
        self.stack.append((tag, *self.state))

    def close(self, tag: str) -> None:
        if tag == "p" and not self.at.get("p") or tag == "br":
            self.flush() if tag == "p" else self.text(" ")
            return
        if not self.at.get(tag):
            if tag in BLOCKS:
                self.flush()
            return
        i = self.at[tag][-1]
        if tag not in BLOCKS and i < self.limits[-1]:
            return                              # an inline end tag doesn't close a block
        # after an inline element the block goes on
        self.cut(i, tag in BLOCKS or self.stack[i][1] != (self.stack[i - 1][1] if i else False))


class Rules:
    """The two passes over a page's blocks."""

    def __init__(self, stop_words: dict[str, list[str]], long: int, stop_share: float, link_share: float):
        self.stop = {w for words in stop_words.values() for w in words}
        self.long, self.stop_share, self.link_share = long, stop_share, link_share

    def first(self, b: Block, articles: bool) -> int:
        """1 main text, -1 boilerplate, 0 ambiguous."""
        if b.bad or b.links > self.link_share * len(b.text):
            return -1
        if len(b.text) < self.long:
            return 0
        words = _WORD.findall(b.text.lower())
        if sum(map(self.stop.__contains__, words)) < self.stop_share * len(words) or not words:
            return 0
        return 1 if b.article or not articles else -1

    def label(self, blocks: list[Block]) -> None:
        articles = any(b.article and not b.bad for b in blocks)
        near: dict[int, list[int]] = defaultdict(list)      # decided blocks by section
        for i, b in enumerate(blocks):
            b.label = self.first(b, articles)
            if b.label and not b.bad:
                near[b.section].append(i)
        before: dict[int, int] = {}             # how many decided blocks of a section lie before
        for i, b in enumerate(blocks):
            known, k = near[b.section], before.get(b.section, 0)
            while k < len(known) and known[k] < i:
                k += 1
            before[b.section] = k
            if b.label:
                continue
            sides = [(abs(j - i), blocks[j].label) for j in known[max(0, k - 1):k + 1]]
            if not sides:
                b.label = 1 if b.article or not articles else -1
            else:
                least = min(sides)[0]
                labels = {x for d, x in sides if d == least}
                b.label = labels.pop() if len(labels) == 1 else 1 if b.article else -1


def main_text(html: str | None, rules: Rules) -> str:
    if not html:
        return ""
    blocks = Scanner(html).blocks
    rules.label(blocks)
    return "\n".join(b.text for b in blocks if b.label > 0)


def extract(pages: DataFrame, stop_words: dict[str, list[str]] | None = None, long: int = LONG,
            stop_share: float = STOP_SHARE, link_share: float = LINK_SHARE) -> DataFrame:
    """page_id, url and the main text (never null) with its length in code points."""
    bounded_batches(pages.sparkSession, PAGES_PER_BATCH)
    d = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in d.schema.fields[:2])
    words = stop_words or STOP_WORDS

    def work(batches):
        rules = Rules(words, long, stop_share, link_share)
        for batch in batches:
            texts = [main_text(x.as_py(), rules) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return d.mapInArrow(work, f"{fields}, text string, n_chars long")
