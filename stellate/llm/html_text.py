"""Main text of web pages by tree scoring.

A page is read into a tree of its block elements.  Every block of text passes
points to the elements around it: one for a sentence's worth of text, one a
comma, and up to three for length, whole to its container, a half to the next
one, and a third, a sixth, a ninth, ... further out.  An element's points are
discounted by the share of its text that is link text.  The element with the
most points is the article; siblings with a fifth of its points, and prose
paragraphs beside it, are kept with it.  If the best element lies in an
``article``, that is taken, as a page's author marks the article so.

Elements that say by their tag, role, class, id or style that they are menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles, comments
of readers or hidden are left out before the scoring; so are sections under a
heading like "3 comments".  One that holds more than half of the page's points
and an ``article``, ``main`` or ``h1`` is a wrapper with a misleading name and
stays, as does a header in the article itself that holds its ``h1``.  In
the article, lists and boxes that are mostly links go too.

Defined results: a null, empty or tag-free page gives its text (null: empty);
a page without text gives an empty text; of equal points the first element in
the page wins; rows that repeat give equal rows; an empty table gives none.
Texts are read whole.  Unclosed tags end where HTML ends them (a ``p`` at the
next block, an ``li`` at the next one); an unclosed comment or script runs to
the end of the page.  Reading is one pass without recursion, so neither very
long nor very deep pages are a problem.  A page is handled by one task; a batch
holds at most ``BATCH_ROWS`` pages.

No SQL form: the tests compare with a plain reading of made and given pages.
"""

from __future__ import annotations

import html as _html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellate.llm.common import col, fresh, ship

BATCH_ROWS = 512

BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody "
    "td tfoot th thead tr caption ul".split())
#: Their content is text up to their end tag and never part of an article.
RAW = ("script", "style", "title", "textarea", "noscript", "iframe", "noembed", "noframes", "xmp")
#: Elements left out whole; they nest.
SKIP = frozenset("button select svg template object canvas audio video map datalist".split())
#: Left out by tag and by role.
CHROME_TAGS = frozenset("nav aside footer header form menu dialog search".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu "
                         "menubar toolbar tablist".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_CHROME_WORDS = frozenset(
    "nav navbar navigation menu submenu topbar toolbar header masthead footer colophon sidebar sidebars aside rail ad "
    "ads adv advert adverts advertisement advertising adsense adbox sponsor sponsored sponsors promo promos promotion "
    "banner cookie cookies consent gdpr notice notices notification alert popup modal overlay lightbox newsletter "
    "subscribe subscription signup login share sharing social related recommended recommendations breadcrumb "
    "breadcrumbs pagination pager comment comments commentlist disqus respond replies copyright disclaimer widget "
    "widgets skip hidden".split())
_COMMENT_WORDS = frozenset("comment comments commentlist disqus respond replies".split())
_COMMENT_HEADING = re.compile(
    r"(?:\d+\s+)?(?:reader'?s?\s+)?(?:comments?|responses?|replies|discussion|leave a (?:reply|comment)|"
    r"post a comment|join the (?:discussion|conversation))(?:\s*\(?\d+\)?)?\W*", re.I)
_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>")
_PLAIN_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_WORD = re.compile(r"[a-z]+")
#: Classes like "has-sidebar" tell of something else on the page.
_ABOUT = re.compile(r"(?<!\S)(?:has|with|no|without)-\S+", re.I)
_COMMA = re.compile(r"[,،、，]")
_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}

#: Blocks that a start tag ends: (tags it closes, tags beyond which it doesn't look).
_CLOSES = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dd": (frozenset(["dd", "dt"]), frozenset(["dl"])), "dt": (frozenset(["dd", "dt"]), frozenset(["dl"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])), "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "tbody": (frozenset(["thead", "tbody", "tfoot"]), frozenset(["table"])),
    "thead": (frozenset(["thead", "tbody", "tfoot"]), frozenset(["table"])),
    "tfoot": (frozenset(["thead", "tbody", "tfoot"]), frozenset(["table"])),
}


def _words(value: str) -> set[str]:
    return set(_WORD.findall(_CAMEL.sub(" ", _ABOUT.sub("", value)).lower()))


def _is_chrome(tag: str, attrs: str) -> bool:
    """Whether an element says that it isn't part of an article."""
    if tag in ("html", "body", "main"):
        return False
    if tag in CHROME_TAGS:
        return True
    if not attrs or attrs.isspace():
        return False
    for name, a, b, c in _ATTR.findall(attrs):
        name, value = name.lower(), a or b or c
        if name in ("class", "id"):
            if _words(value) & (_COMMENT_WORDS if tag == "article" else _CHROME_WORDS):
                return True
        elif name == "role":
            if value.strip().lower() in CHROME_ROLES:
                return True
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        elif name == "style" and _HIDDEN.search(value):
            return True
    return False


class Page:
    """A page's block elements in page order (a parent before its children)
    and its blocks of text: (element, text, characters of link text)."""

    def __init__(self, source: str):
        self.tag, self.parent, self.chrome = ["#root"], [-1], [False]
        self.blocks: list[tuple[int, str, int]] = []
        self._read(source)

    def _read(self, s: str) -> None:
        tag, parent, chrome = self.tag, self.parent, self.chrome
        stack, opened = [0], {}          # open elements; how many of each tag
        text, linked = [], []            # the running block: its texts, and which of them stand in a link
        link_at, skip = 0, []            # stack depth of an open link; open elements left out

        def flush():
            if text:
                words = " ".join(_html.unescape("".join(text)).split())
                if words:
                    inside = "".join(t for t, k in zip(text, linked) if k)
                    self.blocks.append((stack[-1], words, len(" ".join(_html.unescape(inside).split()))))
                text.clear(), linked.clear()

        def pop_to(depth):
            nonlocal link_at
            flush()
            while len(stack) > depth:
                opened[tag[stack.pop()]] -= 1
            if link_at > len(stack):
                link_at = 0

        pattern, at, n, last = _TAG, 0, len(s), s.rfind(">")
        while at < n:
            lt = s.find("<", at)
            if lt > last:                 # no tag ends any more
                lt = s.find("<!--", lt)
            if lt < 0:
                lt = n
            if lt > at and not skip:
                text.append(s[at:lt]), linked.append(bool(link_at))
            if lt == n:
                break
            nxt = s[lt + 1:lt + 2]
            if nxt == "!" or nxt == "?":
                if s.startswith("<!--", lt):
                    end = s.find("-->", lt + 2)
                    at = n if end < 0 else end + 3
                else:
                    end = s.find(">", lt)
                    at = n if end < 0 else end + 1
                continue
            m = pattern.match(s, lt)
            if m is None and pattern is _TAG and (nxt.isalpha() or nxt == "/"):
                rest = s[lt + 1:lt + 3].lstrip("/")
                if rest[:1].isalpha() and rest[:1].isascii():
                    pattern = _PLAIN_TAG  # an attribute that never ends: read on without quotes
                    m = pattern.match(s, lt)
            if m is None:
                if nxt == "/":            # </ and no name: a comment
                    end = s.find(">", lt)
                    at = n if end < 0 else end + 1
                    continue
                if not skip:
                    text.append("<"), linked.append(bool(link_at))
                at = lt + 1
                continue
            at = m.end()
            name, closing = m[1].lower(), nxt == "/"
            if skip:
                if name == skip[-1]:
                    if closing:
                        skip.pop()
                    elif not m[2].endswith("/"):
                        skip.append(name)
                continue
            if closing:
                if name == "a":
                    link_at = 0
                elif opened.get(name):
                    depth = len(stack) - 1
                    while tag[stack[depth]] != name:
                        depth -= 1
                    pop_to(depth)
                elif name in BLOCK:
                    flush()
                continue
            if name in RAW:
                end = _END[name].search(s, at)
                at = n if end is None else end.start()
                if end is not None:
                    close = s.find(">", at)
                    at = n if close < 0 else close + 1
                continue
            if name in SKIP:
                if not m[2].endswith("/"):
                    skip.append(name)
                continue
            if name == "a":
                link_at = len(stack)
                continue
            if name == "br":
                text.append(" "), linked.append(False)
                continue
            if name not in BLOCK:
                continue
            if opened.get("p") and tag[stack[-1]] == "p":
                pop_to(len(stack) - 1)
            flush()
            closes = _CLOSES.get(name)
            if closes and any(opened.get(t) for t in closes[0]):
                depth = len(stack) - 1
                while depth and tag[stack[depth]] not in closes[0] and tag[stack[depth]] not in closes[1]:
                    depth -= 1
                if tag[stack[depth]] in closes[0]:
                    pop_to(depth)
            if name == "hr" or (name in ("html", "body") and opened.get(name)):
                continue
            tag.append(name), parent.append(stack[-1]), chrome.append(_is_chrome(name, m[2]))
            stack.append(len(tag) - 1)
            opened[name] = opened.get(name, 0) + 1
        flush()


def _points(text: str, link: int) -> float:
    n = len(text)
    share = 1.0 - min(1.0, link / n)
    return ((1.0 if n >= 25 else n / 25.0) + len(_COMMA.findall(text)) + min(n / 100.0, 3.0)) * share


def _pass_up(page: Page, blocks) -> tuple[list[float], list[int], list[int]]:
    """Points, characters and link characters of every element.  Points go to
    the container of a block (a paragraph's is the element around it) whole,
    halved to the next, then divided by three times the level."""
    size = len(page.tag)
    score, chars, links = [0.0] * size, [0] * size, [0] * size
    for node, text, link in blocks:
        chars[node] += len(text)
        links[node] += link
        if page.tag[node] in HEADINGS:
            continue
        points = _points(text, link)
        up = page.parent[node] if page.tag[node] in ("p", "pre", "li", "dd", "dt", "td", "th") else node
        level = 0
        while up > 0 and level <= LEVELS:
            score[up] += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            up, level = page.parent[up], level + 1
    for i in range(size - 1, 0, -1):
        chars[page.parent[i]] += chars[i]
        links[page.parent[i]] += links[i]
    return score, chars, links


#: Points go this many levels up beyond the container.
LEVELS = 8


def _left_out(page: Page) -> list[bool]:
    """Elements that are no part of any article, those inside them included."""
    size, tag, parent = len(page.tag), page.tag, page.parent
    points, marks, first = [0.0] * size, [False] * size, [None] * size
    titled = [tag[i] == "h1" for i in range(size)]
    for node, text, link in page.blocks:
        points[node] += 0.0 if tag[node] in HEADINGS else _points(text, link)
        up = node
        while up > 0 and first[up] is None:     # the first block of every element around it
            first[up] = (tag[node], text)
            up = parent[up]
    in_article = [False] * size
    for i in range(1, size):
        in_article[i] = in_article[parent[i]] or (tag[i] in ("article", "main") and not page.chrome[i])
    for i in range(size - 1, 0, -1):
        points[parent[i]] += points[i]
        marks[parent[i]] |= marks[i] or (tag[i] in ("article", "main", "h1") and not page.chrome[i])
        titled[parent[i]] |= titled[i]
    out = [False] * size
    for i in range(1, size):
        drop = page.chrome[i]
        if drop and marks[i] and points[i] > 0.5 * points[0]:
            drop = False
        elif drop and titled[i] and in_article[parent[i]]:
            drop = False
        elif not drop and tag[i] in ("div", "section", "ol", "ul") and first[i] and first[i][0] in HEADINGS:
            drop = bool(_COMMENT_HEADING.fullmatch(first[i][1])) and points[i] <= 0.5 * points[0]
        out[i] = out[parent[i]] or drop
    return out


def main_text(source: str | None) -> str:
    """The article of a page: its blocks, one a line."""
    if not source:
        return ""
    page = Page(source)
    out = _left_out(page)
    tag, parent = page.tag, page.parent
    blocks = [b for b in page.blocks if not out[b[0]]]
    if not blocks:
        return ""
    score, chars, links = _pass_up(page, blocks)
    size = len(tag)
    density = [links[i] / chars[i] if chars[i] else 0.0 for i in range(size)]
    value = [score[i] * (1.0 - min(1.0, density[i])) for i in range(size)]
    best = max(range(size), key=lambda i: (value[i], -i))
    if value[best] <= 0.0:
        best = 0
    up = best
    while up > 0:
        if tag[up] == "article":
            best = up
            break
        up = parent[up]
    keep = [False] * size
    if best == 0:
        keep[0] = True
    else:
        keep[best] = True
        wanted = 0.2 * value[best]
        box = parent[best]
        own = {}                         # text of the paragraphs beside the best element
        for node, text, link in blocks:
            if node != best and parent[node] == box:
                own[node] = text
        for i in range(best + 1 if box < 0 else box + 1, size):
            if parent[i] != box or i == best or out[i]:
                continue
            if tag[i] in ("p", "blockquote", "pre"):
                text = own.get(i, "")
                keep[i] = (len(text) > 80 and density[i] < 0.25) or (
                    0 < len(text) <= 80 and links[i] == 0 and text[-1] in ".!?。")
            elif tag[i] == "h1":
                keep[i] = i < best
            else:
                keep[i] = value[i] >= wanted
    for i in range(1, size):
        if keep[parent[i]] and not keep[i]:
            linky = tag[i] in ("ul", "ol", "div", "section", "table", "dl") and density[i] > 0.5
            keep[i] = not out[i] and not linky
        elif out[i]:
            keep[i] = False
    return "\n".join(text for node, text, _ in blocks if keep[node])


def extract_text(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``pages`` with a column ``text``: the main text of the page in ``html``,
    its blocks joined by a line feed.  All other columns stay; an old ``text``
    column is replaced."""
    ship(pages.sparkSession)
    others = [f for f in pages.schema.fields if f.name != text]
    schema = T.StructType(others + [T.StructField(text, T.StringType())])
    name = fresh("__html", pages.columns)
    rows = pages.select(*[col(f.name) for f in others], col(html).cast("string").alias(name))
    at = len(others)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(start, BATCH_ROWS)
                found = pa.array([main_text(v.as_py()) for v in part.column(at)], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(at)] + [found],
                                                 names=part.schema.names[:at] + [text])

    return rows.mapInArrow(run, schema)


def with_length(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``n_chars``, the number of code points of the text."""
    return df.withColumn("n_chars", F.char_length(col(text)).cast("long"))
