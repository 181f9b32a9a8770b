"""Main text of HTML pages by tree scoring.

A page is parsed into a tree (unclosed paragraphs, list items and inline tags
are closed as browsers do; scripts, styles and other raw elements are left
out).  Elements that are navigation, headers, footers, sidebars, notices,
adverts, forms or reader comments, by tag, role, class or id, are left out
with all they hold.  Of a class or id whole names count, or the first or last
word of a compound one (``no-sidebar``, ``has-header`` or ``overflow-hidden``
don't).  A name or a ``form`` never leaves out ``main``, the article or most of
the page's paragraph text; if nothing is left, names and forms don't count.  Every text block passes points, for its length and its
commas, to the container it stands in, half of them to the next ancestor and
a third to the one above.  A container's points are discounted by its link
density.  The best container stands for its whole: the outermost ``article``
or ``main`` around it, or without one the outermost ancestor up to which the
text that comes along isn't mostly links.  All of the whole that isn't left
out is kept, however short (sections, headings, quotes, tables), but for lists
and boxes of bare links (a list of cited links in the article stays); text blocks and scored containers beside the whole
are kept too.  The text blocks are joined in page order.

Result: character references decoded, white space in a block turned into one
space, blocks trimmed and joined by a line feed.

Edge cases: a null, empty or textless page gives an empty text; markup that
is cut off at the end of the page is closed there; a page without any scored
container gives its ``article``, ``main`` or ``body`` text.  Parsing is
iterative and linear in the page, whatever its length or depth.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                  r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]+|=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|=)*)(?:>|\Z)", re.S)
#: One attribute with its value; a tag's attributes are read one after another, so no value is taken for a name.
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)(?:"|\Z)|'([^']*)(?:'|\Z)|([^\s"'<>]+)))?""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript textarea title iframe template svg math object canvas noembed xmp".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select
    summary table tbody td tfoot th thead tr ul""".split())
#: Blocks that hold text; their points go to the element around them.
TEXT_BLOCK = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt pre blockquote figcaption summary td th tr caption address".split())
#: Opening one of the keys closes an open element of the values, up to a limit element.
CLOSES = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",)}
LIMIT = frozenset("ul ol dl table menu select body html article section div main".split())
#: Elements that are never part of the main text.
BAD_TAG = frozenset("""nav footer aside form button select option menu dialog head label input fieldset legend dir
    datalist output progress audio video""".split())
BAD_ROLE = frozenset("""navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar
    toolbar tablist status""".split())
BAD_NAME = frozenset("""ad ads adv advert adverts advertisement advertising adbox adsense banner sponsor sponsored promo
    promotion nav navbar navigation menu sidebar sidenav footer header masthead topbar breadcrumb breadcrumbs cookie cookies
    consent gdpr notice notices notification alert popup modal overlay comment comments disqus reply replies respond
    discussion share sharing social related recommended newsletter subscribe subscription signup login signin form search
    pagination pager toolbar widget copyright skip hidden rail outbrain taboola""".split())
#: Of these only the whole name counts, of the others also the last word of a compound name ...
WHOLE_NAME = frozenset("widget hidden skip header".split())
#: ... and of all but these the first word as well, or the last one of a name with a good word in it.
LAST_NAME = WHOLE_NAME | frozenset("""form search overlay banner notice notices notification alert popup modal rail ad ads
    toolbar login signin signup reply replies respond discussion sponsor sponsored promo promotion""".split())
FIRST_NAME = BAD_NAME - LAST_NAME | frozenset("ad ads promo sponsor sponsored".split())
COMPOUND = frozenset("sr-only visually-hidden is-hidden site-header main-header top-header global-header".split())
#: Words of a compound name that tell how the page is laid out.
LAYOUT = frozenset("no non not has have having with without hide overflow layout".split())
#: Reader comments can have more text than the article.
COMMENTS = frozenset("comment comments disqus reply replies respond discussion".split())
GOOD_NAME = frozenset("article content post entry main story text body".split())
KEEP_TAG = frozenset("html body article main".split())
NO_NAMES, HEADER, FORM = frozenset(), frozenset({"header"}), frozenset({"form"})
#: Blocks that are kept beside the article, if they aren't links.
BESIDE = frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre ul ol dl table figure article main".split())


def _bad_word(token: str) -> str:
    """The word for which a class or id is one that isn't main text, or ""."""
    words = [w.lower() for w in _WORDS.findall(token)]
    if not words:
        return ""
    first, last = words[0], words[-1]
    if len(words) == 1:
        return last if last in BAD_NAME else ""
    if "-".join(words) in COMPOUND:
        return last
    if not LAYOUT.isdisjoint(words):
        return ""
    if last in BAD_NAME and last not in WHOLE_NAME and (last in FIRST_NAME or GOOD_NAME.isdisjoint(words)):
        return last
    return first if first in FIRST_NAME else ""


@lru_cache(65_536)
def _name(value: str) -> tuple[frozenset[str], bool]:
    """(bad words, looks like content) of a class or id."""
    return (frozenset(w for w in map(_bad_word, value.split()) if w),
            not GOOD_NAME.isdisjoint(w.lower() for w in _WORDS.findall(value)))


def _attributes(raw: str) -> tuple[bool, frozenset[str], bool]:
    """(left out, bad words of the names, looks like content)"""
    bad = good = False
    names = NO_NAMES
    for m in _ATTR.finditer(raw):
        name = m[1].lower()
        value = m[2] or m[3] or m[4] or ""
        if name in ("class", "id"):
            words, content = _name(value)
            names |= words
            good |= content
        elif name == "role":
            bad |= value.strip().lower() in BAD_ROLE
            good |= value.strip().lower() in ("main", "article")
        elif name == "hidden":
            bad = True
        elif name == "aria-hidden":
            bad |= value.strip().lower() == "true"
        elif name == "style":
            bad |= re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I) is not None
    return bad, names, good


class Page:
    """The tree, as lists by node number (a parent comes before its children),
    and the page's texts and block edges in order."""

    def __init__(self, source: str):
        self.tag, self.parent, self.out, self.good, self.link = ["html"], [-1], [False], [False], [False]
        self.named: dict[int, bool] = {}    # left out by name or as a form; True for reader comments
        self.texts: list[tuple[int, str] | None] = []     # None: the edge of a block
        self._parse(source)
        self.hard = self.out
        if self.named:
            self.out = self._left_out()

    def _spread(self, named) -> list[bool]:
        """``out`` when these nodes are left out too."""
        out = self.hard[:]
        for k in range(1, len(out)):
            out[k] = out[k] or out[self.parent[k]] or k in named
        return out

    def _left_out(self) -> list[bool]:
        """``out`` with the named elements, but for those that hold the main
        text: ``main``, an article with more paragraph text than the names
        leave, or most of the page's paragraph text."""
        tag, parent, n = self.tag, self.parent, len(self.tag)
        within = [False] * n        # a paragraph
        for k in range(1, n):
            within[k] = within[parent[k]] or tag[k] == "p"
        prose, loose = [0] * n, [0] * n
        for t in self.texts:
            if t is not None and not self.hard[t[0]] and not self.link[t[0]]:
                size = len(t[1].strip())
                loose[t[0]] += size
                if within[t[0]]:
                    prose[t[0]] += size
        if not any(prose):          # a page without paragraphs
            prose = loose
        out = self._spread(self.named)
        left = sum(prose[k] for k in range(n) if not out[k])
        for k in range(n - 1, 0, -1):
            prose[parent[k]] += prose[k]
        comments = [False] * n
        for k in range(1, n):
            comments[k] = comments[parent[k]] or self.named.get(k, False)
        held = [k for k in range(n) if tag[k] == "main" and not self.hard[k]]
        articles = [k for k in range(n) if tag[k] == "article" and out[k] and not self.hard[k] and not comments[k]]
        if articles:
            longest = max(articles, key=lambda k: (prose[k], -k))
            if prose[longest] > left:
                held.append(longest)
        spared = {k for k, comment in self.named.items() if 2 * prose[k] > prose[0] and not (comment and left)}
        for k in held:
            while k > 0:
                spared.add(k)
                k = parent[k]
        return self._spread(self.named.keys() - spared)

    def without_names(self) -> bool:
        """A second look, if names left anything out: is there more to see?"""
        if not self.named:
            return False
        self.out = self.hard
        return True

    def _open(self, tag: str, raw: str, stack: list[int]) -> None:
        top = stack[-1]
        bad, names, good = _attributes(raw) if raw and not raw.isspace() else (False, NO_NAMES, False)
        inside = self.out[top]
        if names == HEADER and any(self.tag[n] in ("article", "main") for n in stack):
            names = NO_NAMES
        if tag in KEEP_TAG:
            bad, names = False, NO_NAMES
        elif tag == "header":   # the page's header; an article's own one holds its headline
            bad = bad or not any(self.tag[n] in ("article", "main") for n in stack)
        elif tag == "form":
            names |= FORM
        elif tag in BAD_TAG:
            bad = True
        self.tag.append(tag)
        self.parent.append(top)
        self.out.append(inside or bad)
        self.good.append(good or tag in ("article", "main"))
        self.link.append(self.link[top] or tag == "a")
        if names:
            self.named[len(self.tag) - 1] = not COMMENTS.isdisjoint(names)
        stack.append(len(self.tag) - 1)

    def _parse(self, source: str) -> None:
        stack, at, n = [0], 0, len(source)
        texts = self.texts
        depth: dict[str, int] = {}     # open elements by tag, so that a stray end tag costs nothing
        lower = None

        def pop_to(k: int) -> None:
            for node in stack[k:]:
                depth[self.tag[node]] -= 1
            del stack[k:]

        while at < n:
            lt = source.find("<", at)
            if lt < 0:
                texts.append((stack[-1], source[at:]))
                break
            m = _TAG.match(source, lt)
            if m is None:              # a lone "<" is text
                nxt = source.find("<", lt + 1)
                nxt = n if nxt < 0 else nxt
                texts.append((stack[-1], source[at:nxt]))
                at = nxt
                continue
            if lt > at:
                texts.append((stack[-1], source[at:lt]))
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:                   # an end tag
                if tag in BLOCK:
                    texts.append(None)
                if tag == "br":
                    texts.append((stack[-1], " "))
                elif depth.get(tag):
                    for k in range(len(stack) - 1, 0, -1):
                        if self.tag[stack[k]] == tag:
                            pop_to(k)
                            break
                        # an inline end tag doesn't close blocks
                        if tag not in BLOCK and self.tag[stack[k]] in BLOCK:
                            break
                continue
            if tag in RAW:
                if not m[3].endswith("/"):
                    if lower is None:
                        lower = source.lower()
                        if len(lower) != n:    # a few characters change length in lower case
                            lower = "".join(c.lower() if c.isascii() else c for c in source)
                    end = lower.find(f"</{tag}", at)
                    at = n if end < 0 else (source.find(">", end) + 1 or n)
                continue
            if tag in ("br", "hr", "wbr", "img"):
                texts.append(None if tag == "hr" else (stack[-1], "" if tag == "wbr" else " "))
                continue
            if tag in VOID:
                continue
            if tag in BLOCK:
                texts.append(None)
                if depth.get("p"):     # a block closes an open paragraph
                    for k in range(len(stack) - 1, 0, -1):
                        t = self.tag[stack[k]]
                        if t == "p":
                            pop_to(k)
                            break
                        if t in BLOCK:
                            break
                for other in CLOSES.get(tag, ()):
                    if depth.get(other):
                        for k in range(len(stack) - 1, 0, -1):
                            t = self.tag[stack[k]]
                            if t == other:
                                pop_to(k)
                                break
                            if t in LIMIT:
                                break
            elif tag == "a" and depth.get("a"):
                for k in range(len(stack) - 1, 0, -1):
                    t = self.tag[stack[k]]
                    if t == "a":
                        pop_to(k)
                        break
                    if t in BLOCK:
                        break
            if tag in ("html", "body") and depth.get(tag):
                continue
            self._open(tag, m[3], stack)
            depth[tag] = depth.get(tag, 0) + 1

    def blocks(self) -> list[tuple[int, str, int]]:
        """(block element, text, characters in links) in page order; left-out elements have none."""
        found, parts, linked, owner = [], [], 0, -1
        above: dict[int, int] = {}

        def block_of(node: int) -> int:
            path = []
            k = node
            while k not in above and k > 0 and self.tag[k] not in BLOCK:
                path.append(k)
                k = self.parent[k]
            k = above.get(k, k)
            for p in path:
                above[p] = k
            return k

        def flush() -> None:
            nonlocal parts, linked, owner
            if parts:
                text = " ".join("".join(parts).split())
                if text:
                    found.append((owner, text, linked))
            parts, linked, owner = [], 0, -1

        for t in self.texts:
            if t is None:
                flush()
                continue
            node, raw = t
            if self.out[node]:
                continue
            own = block_of(node)
            if own != owner and parts:
                flush()
            owner = own
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if self.link[node]:
                linked += len(text.strip())
        flush()
        return found


def _whole(page: Page, best: int, size: list[int], linked: list[int]) -> int:
    """The element that holds the best container and all that belongs to it:
    the outermost article or main around it, or else the outermost ancestor
    up to which the text that comes along isn't mostly links."""
    path = [best]
    while page.parent[path[-1]] >= 0:
        path.append(page.parent[path[-1]])
    named = [k for k in path if page.tag[k] in ("article", "main")]
    if named:
        return named[-1]
    top = best
    for k in path[1:]:
        if linked[k] - linked[top] > 0.5 * (size[k] - size[top]):
            break
        top = k
    return top


def main_text(source: str | None) -> str:
    """The main text of one page."""
    if not source:
        return ""
    page = Page(source)
    blocks = page.blocks()
    if not blocks and page.without_names():
        blocks = page.blocks()
    if not blocks:
        return ""
    tag, parent = page.tag, page.parent
    n = len(tag)
    points, size, linked, links = [0.0] * n, [0] * n, [0] * n, [0] * n
    for node, text, in_links in blocks:
        size[node] += len(text)
        linked[node] += in_links
        links[node] += in_links > 0
        worth = (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - min(1, in_links / len(text)))
        at = parent[node] if tag[node] in TEXT_BLOCK and node else node
        for share in (1, 2, 3):
            if at < 0:
                break
            points[at] += worth / share
            at = parent[at]
    for k in range(n - 1, 0, -1):
        size[parent[k]] += size[k]
        linked[parent[k]] += linked[k]
        links[parent[k]] += links[k]
    score = [0.0] * n
    for k in range(n):
        if points[k] and not page.out[k]:
            score[k] = (points[k] + (25 if page.good[k] else 0)) * (1 - min(1, linked[k] / max(1, size[k])))
    best = max(range(n), key=lambda k: (score[k], -k))
    if not score[best]:
        best = next((k for want in ("article", "main", "body") for k in range(n) if tag[k] == want and not page.out[k]), 0)
    top = _whole(page, best, size, linked)

    def dense(k: int, share: float) -> bool:
        return linked[k] > share * size[k]

    inside = [False] * n           # of the best container
    article = [False] * n
    kept = [False] * n
    for k in range(n):
        up = parent[k]
        inside[k] = k == best or up >= 0 and inside[up]
        article[k] = tag[k] == "article" or up >= 0 and article[up]
        if k == top or up >= 0 and kept[up]:
            # a list or box of bare links is a menu; numbered lists, tables and lists in the article's text are references
            cited = tag[k] == "ul" and inside[k] and article[k]
            box = tag[k] in ("ul", "div", "section") and not cited and (links[k] >= 3 or not inside[k])
            kept[k] = k in (top, best) or not (box and dense(k, 0.8))
        elif up >= 0 and up == parent[top] and not page.out[k]:
            # beside the whole: text blocks and scored containers, however they compare with the best
            kept[k] = not dense(k, 0.25) and (tag[k] in BESIDE or score[k] >= 10)
    return "\n".join(text for node, text, _ in blocks if kept[node])


def extract(pages: DataFrame, html_col: str = "html", carry: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The carried columns, ``text`` and ``n_chars`` of every page."""
    wanted = pages.select(*carry, F.col(html_col).alias("_html"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.schema.fields[:-1])
    at = len(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                texts = [main_text(x) for x in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:at], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                    names=[*carry, "text", "n_chars"])

    return wanted.mapInArrow(run, f"{schema}, text string, n_chars long")
