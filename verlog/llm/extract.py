"""Main text of HTML pages by tag-path ratios.

A page is read once into blocks of text, each with its root-to-leaf tag path.
Per path, text length, punctuation and link text are summed; a path's ratio is
its text length for each block that has the path, and its punctuation ratio the
same with punctuation marks. Both are smoothed with the path's parent subtree
(a short heading beside long paragraphs shares their container), fused as a
geometric mean, and blocks whose path's fused ratio reaches ``threshold`` times
the page's text-weighted mean are dense. Blocks that go through an element that
is boilerplate by its tag, role, class or id never are, nor are what a heading of
reader comments introduces and short notices (by name and words). An article or main
element is a weight, not a switch: the threshold is a fifth inside it and, if
it holds a quarter of the page's text, five times as high outside. Several
articles that are the smaller part of a page get the higher threshold (cards).
Names count by whole words; where a name may also be that of a section, or the
element is a section or paragraph, its own ratio has to confirm it. Headings are
not judged by name, and inside an article neither are ids and paragraphs.

Dense blocks only find the place of the text: the content container is their
lowest common ancestor, widened while its parent adds no page furniture, and
every block under it that is not boilerplate stays, however short or linked; an
article with dense blocks is a container as a whole. A
container that is the page itself (body, or an element around nav, header or
footer) is taken child by child: children without dense blocks stay too, except,
before or after the text, cards, link lists that no heading introduces, and
whatever stands outside an article that has the text.

Inside a block, white space (line breaks of the markup included) becomes one
space; blocks are joined in page order by one line feed. Character references
are decoded; formulas (math) are text. Unclosed and misnested tags are tolerated as browsers do in the
common cases (implied ends of p, li, option, cells, and of head at the first
thing that is not metadata; stray ends ignored).

Nulls and odd rows: a null or empty page and a page without content give an
empty text; repeated rows and null ids pass through; very long pages are read
whole; an empty table gives an empty result; an input column named like a
result column gives way to it.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter
from functools import lru_cache
from itertools import groupby
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verlog.llm.common import others, q

# Element names and naming habits.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp svg select annotation annotation-xml".split())
MATH = frozenset("math maction menclose merror mfenced mfrac mglyph mi mmultiscripts mn mo mover mpadded mphantom "
                 "mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover "
                 "none semantics".split())
INLINE = MATH | frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
                          "samp small span strike strong sub sup time tt u var wbr br img".split())
#: Elements without text of the page that do not end a block either.
UNSEEN = frozenset("script style noscript iframe template svg annotation annotation-xml".split())
DROPPED = frozenset("head nav footer aside form button dialog menu object applet audio video canvas map "
                    "datalist input".split()) | RAW
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar "
                  "toolbar".split())
#: Names of page furniture; names that sections of a text have as well; and words that go with either.
FIXED = re.compile(r"ads?|advert(?:s|ise\w*|ising)?|adbox|adsense|sponsor(?:s|ed)?|promos?|promotions?|promoted|banners?|"
                   r"nav|navbar|navigation|menu|menubar|breadcrumbs?|header|masthead|topbar|foot|footer|sidebar\w*|"
                   r"widgets?|cookies?|consent|gdpr|popup|modal|overlay|newsletters?|subscribe|subscription|signup|login|"
                   r"comments?|comment(?:list|form|box|area)|disqus|pagination|pager|hidden", re.I)
LOOSE = re.compile(r"side|aside|rail|share|sharing|social|related|recommend\w*|legal|discussion|responses|respond|reply|replies|"
                   r"alert|notices?|copyright|comment\w+|nav\w+|menu\w+|promo\w+|advert\w+|sponsor\w+|subscri\w+|widget\w+",
                   re.I)
BESIDE = re.compile(r"bars?|box|buttons?|btn|links?|posts?|articles?|stories|story|news|lists?|items?|widgets?|containers?|wrap|"
                    r"wrapper|block|section|area|tools?|icons?|content|media|form|panel|col|column|top|bottom|left|right|main|"
                    r"inner|outer|title|more|text|messages?|page|site|global|primary|secondary|js|is|the|my|slot|unit|"
                    r"toggle|thread|mobile|desktop|count|\d*", re.I)
#: Words beside which "header" names the head of the text, as it does inside an article.
OF_TEXT = frozenset("article content entry post section story text title".split())
FIXED_NAME, LOOSE_NAME = 2, 1
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
                   "h5 h6 header hr main nav ol p pre section table ul".split())
CONTENT = frozenset("h1 h2 h3 h4 h5 h6 p li dd dt blockquote pre td th caption figcaption article main".split())
IMPLIED = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
           "th": ("td", "th"), "option": ("option",)}
LISTS = frozenset("ul ol dl table".split())
METADATA = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that are not judged by class and id.
UNNAMED = HEADINGS | frozenset("html body article main".split())
#: Elements that hold a part of a text, never the whole of it; and those that stand beside it.
PARTS = (CONTENT - {"article", "main"}) | LISTS | frozenset("tr thead tbody tfoot figure hgroup".split())
FURNITURE = frozenset("nav header footer".split())
#: Share of a text's characters in links above which it counts as a list of links.
LINKED = 0.8
#: How much an article or main element divides its blocks' threshold by and multiplies the others' with, and the
#: share of the page's text (by length and ratio) that it must hold for the latter.
ARTICLE, HELD = 5, 0.25
#: Share of the text's mean ratio from which on an element is text although its name may be one of furniture.
CONFIRMED = 0.5
#: Elements that a container is widened by, and pages within pages, at most (unclosed elements nest without end).
LEVELS = 20
_MARK = re.compile(r"<(?:!--|[!?]|(/?)([A-Za-z][^\s/>]*))", re.S)
_REST = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|([^\s=/"'>]+)""")
_SPACE = re.compile(r"\s+")
_POINTS = re.compile(r"[.,;:!?…。、，！？；：]")


@lru_cache(maxsize=4096)
def _named(token: str, in_article: bool = False) -> int:
    """Whether a class or id is a name of page furniture (FIXED_NAME), may be one (LOOSE_NAME) or is none (0)."""
    words = [w for w in re.split(r"[-_]+", token.lower()) if w]
    if "header" in words and (in_article or OF_TEXT & set(words)):
        return 0
    fixed = [w for w in words if FIXED.fullmatch(w)]
    loose = [w for w in words if LOOSE.fullmatch(w)]
    if all(w in fixed or w in loose or BESIDE.fullmatch(w) for w in words):
        return FIXED_NAME if fixed else LOOSE_NAME if loose else 0
    return LOOSE_NAME if fixed else 0


class _Marks:
    """The tags of a page in order; each character is looked at a bounded number of times, whatever is left open."""

    def __init__(self, page: str):
        self.page = page
        self.unclosed = False  # some tag ran to the end of the page for an open quote

    def next(self, at: int) -> tuple[int, int, bool, str | None, str] | None:
        """Where the next mark starts and ends, whether it is an end tag, its tag (None: a comment) and attributes."""
        page = self.page
        while (m := _MARK.search(page, at)) is not None:
            if m[2] is None:
                close = "-->" if m[0] == "<!--" else ">"
                end = page.find(close, m.end())
                return m.start(), end + len(close) if end >= 0 else len(page), False, None, ""
            end = len(page) if self.unclosed else _REST.match(page, m.end()).end()
            if end >= len(page) or page[end] != ">":
                # Quotes that do not pair up: from here on a tag ends at the first bracket.
                self.unclosed = True
                end = page.find(">", m.end())
                if end < 0:  # no tag ends any more; comments are still left out
                    m = re.compile("<[!?]").search(page, m.end())
                    return None if m is None else (m.start(), len(page), False, None, "")
            return m.start(), end + 1, bool(m[1]), m[2].lower(), page[m.end():end]
        return None


def _judged(tag: str, attributes: str, in_article: bool) -> int:
    """FIXED_NAME for boilerplate, LOOSE_NAME for an element whose name says so but whose ratio has to confirm it."""
    if tag in DROPPED or tag == "header" and not in_article:
        return FIXED_NAME
    if not attributes.strip():
        return 0
    found = 0
    for m in _ATTRIBUTE.finditer(attributes):
        name = (m[1] or m[3] or "").lower()
        value = (m[2] or "").strip("\"'")
        if name == "role" and value.lower() in ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return FIXED_NAME
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return FIXED_NAME
        if (name == "class" or name == "id" and not in_article) and tag not in UNNAMED:
            by_name = max((_named(t, in_article) for t in value.split()), default=0)
            if tag in ("p", "section"):
                by_name = 0 if in_article and (tag == "p" or by_name < FIXED_NAME) else min(by_name, LOOSE_NAME)
            found = max(found, by_name)
    # Inside a block there is no ratio to confirm a name by.
    return 0 if tag in INLINE and found < FIXED_NAME else found


class Block(NamedTuple):
    path: tuple[str, ...]  # tags from the root
    text: str
    linked: int  # characters in links
    boilerplate: bool
    inside: bool  # an article or main element
    nodes: tuple[int, ...]  # the path's elements, numbered in page order
    suspect: int  # the outermost element that is furniture by name if its ratio confirms it, or 0


def blocks(page: str) -> list[Block]:
    """The blocks of text in page order."""
    out: list[Block] = []
    stack: list[tuple[str, bool, bool, int, int]] = []  # tag, boilerplate so far, in article so far, number, suspect
    buffer: list[str] = []
    linked, started = 0, False
    where: tuple = ((), False, False, (), 0)
    opened = 0
    open_tags: Counter[str] = Counter()  # what the stack holds, by tag
    around: tuple | None = None  # the path of the stack as it is, once asked for

    def push(entry: tuple[str, bool, bool, int, int]) -> None:
        nonlocal around
        stack.append(entry)
        open_tags[entry[0]] += 1
        if entry[0] not in INLINE:
            around = None

    def cut(k: int, upto: int | None = None) -> None:
        """Takes the elements from place k (up to another) off the stack."""
        nonlocal around
        for e in stack[k:upto]:
            open_tags[e[0]] -= 1
            if e[0] not in INLINE:
                around = None
        del stack[k:upto]

    def close(tags: tuple[str, ...], barrier: frozenset | set) -> None:
        """Ends the innermost open element among ``tags``, unless a barrier lies above it."""
        if not any(open_tags[t] for t in tags):
            return
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in tags:
                cut(k)
                return
            if stack[k][0] in barrier:
                return

    def path() -> tuple:
        nonlocal around
        if around is None:
            outer = [e for e in stack if e[0] not in INLINE]
            around = tuple(e[0] for e in outer), tuple(e[3] for e in outer)
        return around

    def state() -> tuple[bool, bool]:
        return (stack[-1][1], stack[-1][2]) if stack else (False, False)

    def flush() -> None:
        nonlocal linked, started
        text = _SPACE.sub(" ", _html.unescape("".join(buffer))).strip()
        if text:
            out.append(Block(where[0], text, linked, *where[1:]))
        buffer.clear()
        linked, started = 0, False

    def add(text: str) -> None:
        nonlocal where, linked, started
        if not text:
            return
        if not started and not text.isspace():
            started = True
            if stack and stack[-1][0] == "head":
                cut(len(stack) - 1)
            bad, inside = state()
            tags, nodes = path()
            where = (tags, bad, inside, nodes, stack[-1][4] if stack else 0)
        if open_tags["a"]:
            linked += len(text)
        # Inline boilerplate inside a block (a hidden span) is left out of it.
        if not state()[0] or where[1]:
            buffer.append(text)

    at, n = 0, len(page)
    marks = _Marks(page)
    while at < n:
        m = marks.next(at)
        if m is None:
            add(page[at:])
            break
        start, end, closes, tag, attributes = m
        add(page[at:start])
        at = end
        if tag is None:
            continue
        if closes:
            if open_tags[tag]:
                if tag not in INLINE:
                    flush()
                    k = len(stack) - 1
                    while stack[k][0] != tag:
                        k -= 1
                    cut(k)
                else:  # closes the innermost one of its block only
                    for k in range(len(stack) - 1, -1, -1):
                        if stack[k][0] == tag:
                            cut(k, k + 1)
                            break
                        if stack[k][0] not in INLINE:
                            break
            elif tag == "p":
                flush()
            continue
        if stack and stack[-1][0] == "head" and tag not in METADATA:  # its end tag may be left out
            flush()
            cut(len(stack) - 1)
        if tag == "br":
            add(" ")
            continue
        if tag not in INLINE and tag not in UNSEEN:
            flush()
            if tag in ENDS_P:
                close(("p",), LISTS | {"td", "th", "div", "article", "section", "main", "body"})
            if tag in IMPLIED:
                close(IMPLIED[tag], LISTS - ({"table"} if tag == "li" else set()))
        if tag in VOID or attributes.rstrip().endswith("/") and (tag in ("svg", "path") or tag in MATH):
            continue
        bad, inside = state()
        inside = inside or tag in ("article", "main")
        opened += 1
        judged = _judged(tag, attributes, inside)
        suspect = stack[-1][4] if stack else 0
        push((tag, bad or judged == FIXED_NAME, inside, opened, suspect or (judged == LOOSE_NAME) * opened))
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else n
            cut(len(stack) - 1)
    flush()
    return out


def _fused(found: list[Block]) -> dict[tuple, float]:
    """Each tag path's text and punctuation ratio, smoothed with its parent's; 0 for mostly links."""
    sums: dict[tuple, list[float]] = {}
    under: dict[tuple, list[float]] = {}
    for b in found:
        facts = (1, len(b.text), len(_POINTS.findall(b.text)), b.linked)
        for place, key in ((sums, b.path), (under, b.path[:-1])):
            have = place.setdefault(key, [0, 0, 0, 0])
            for i, x in enumerate(facts):
                have[i] += x
    fused = {}
    for path, (k, length, points, linked) in sums.items():
        pk, plength, ppoints, _ = under[path[:-1]]
        ratio, marks = (length / k + plength / pk) / 2, (points / k + ppoints / pk) / 2
        fused[path] = 0.0 if linked > LINKED * length else (ratio * (marks + 0.5)) ** 0.5
    return fused


def _only_links(some: list[Block]) -> bool:
    return sum(b.linked for b in some) > LINKED * sum(len(b.text) for b in some)


def _depth(b: Block) -> int:
    """Depth of the innermost element around a block that can hold a whole text."""
    n = b.path.index("article") + 1 if "article" in b.path else len(b.path)
    while n and b.path[n - 1] in PARTS:
        n -= 1
    return n


def _ancestor(some: list[Block]) -> int:
    """Depth of the lowest common ancestor of blocks."""
    first = some[0].nodes
    depth = min(_depth(b) for b in some)
    for b in some:
        while b.nodes[:depth] != first[:depth]:
            depth -= 1
    return depth


def _under(some: list[Block], holder: tuple[int, ...]) -> list[Block]:
    return [b for b in some if b.nodes[:len(holder)] == holder]


def _is_page(path: tuple[str, ...], holder: tuple[int, ...], found: list[Block]) -> bool:
    """Whether an element is around the whole page: the root, html, body, or one around nav, header or footer."""
    return (not path or path[-1] in ("html", "body")
            or path[-1] != "article" and any(b.boilerplate and FURNITURE & set(b.path[len(path):]) for b in _under(found, holder)))


def _children(some: list[Block], depth: int):
    """Runs of blocks with the same child of an element at a depth (text of the element's own is alone)."""
    for child, run in groupby(some, key=lambda b: b.nodes[depth:depth + 1]):
        run = list(run)
        yield from ([run] if child else ([b] for b in run))


def _contents(found: list[Block], usable: list[Block], dense: set[int], top: int = 0, level: int = 0) -> list[Block]:
    """The usable blocks of the containers of the dense ones (given by ``id``), from the depth ``top`` on."""
    strong = [b for b in usable if id(b) in dense]
    depth = max(top, _ancestor(strong))
    path, nodes = strong[0].path, strong[0].nodes
    for _ in range(LEVELS):
        if depth <= top or path[depth - 1] in ("article", "main"):
            break
        outer = _under(usable, nodes[:depth - 1])
        if _is_page(path[:depth - 1], nodes[:depth - 1], found) or any(
                _only_links(x) or any("article" in b.path[depth - 1:] for b in x)
                for x in _children(outer, depth - 1) if not any(id(b) in dense for b in x)):
            break
        depth -= 1
    held = _under(usable, nodes[:depth])
    if not _is_page(path[:depth], nodes[:depth], found):
        kept = held
    else:
        kept = []
        runs = list(_children(held, depth))
        articles = any(b.inside for b in strong)
        at = [k for k, run in enumerate(runs) if any(id(b) in dense for b in run)]
        for k, run in enumerate(runs):
            if k in (at[0], at[-1]) or any(id(b) in dense for b in run):
                part = run[0].path
                whole = level == LEVELS or len(part) <= depth or part[depth] in PARTS
                kept += run if whole else _contents(found, run, dense, depth + 1, level + 1)
            elif at[0] < k < at[-1] or not any("article" in b.path[depth:] for b in run) and (
                    not articles and not _only_links(run)
                    or k > at[0] and (_is_heading(run[0]) or _is_heading(runs[k - 1][-1]))):
                kept += run
    # A title above the container, in an element around it.
    ids = {id(b) for b in kept}
    end = kept[0].nodes
    titles = "article" not in kept[0].path
    return [b for b in usable if id(b) in ids or titles and _is_heading(b) and b.nodes < end
            and len(b.nodes) - 1 >= top and b.nodes[:-1] == nodes[:depth][:len(b.nodes) - 1]]


def _is_heading(b: Block) -> bool:
    return bool(b.path) and b.path[-1] in HEADINGS and b.linked <= LINKED * len(b.text)


def _article(b: Block) -> int | None:
    """The number of the outermost article element around a block."""
    return b.nodes[b.path.index("article")] if "article" in b.path else None


def _dense(usable: list[Block], threshold: float) -> set[int]:
    """The blocks (by ``id``) whose path's ratio is that of a text; article and main elements only shift the threshold."""
    fused = _fused(usable)
    weight = {id(b): fused[b.path] * len(b.text) for b in usable}
    total = sum(weight.values())
    mean = total / sum(len(b.text) for b in usable)
    each: dict[int | None, float] = {}
    for b in usable:
        each[_article(b)] = each.get(_article(b), 0.0) + weight[id(b)]
    each.pop(None, None)
    # Several articles that are a small part of the page are cards beside its text, as far as their ratios agree.
    cards = len(each) > 1 and max(each.values()) < HELD * total and sum(each.values()) < total / 2
    likely = {id(b) for b in usable if b.inside and not (cards and _article(b))}
    held = sum(weight[x] for x in likely) >= HELD * total and bool(likely)

    def factor(b: Block) -> float:
        if id(b) in likely:
            return 1 / ARTICLE
        return ARTICLE if held or cards and _article(b) else 1

    return {id(b) for b in usable if fused[b.path] >= threshold * mean * factor(b)} or {id(b) for b in usable}


def _confirmed(some: list[Block]) -> list[Block]:
    """Without the blocks of suspects that are not as dense as the text, or stand outside an article that has text."""
    sure = [b for b in some if not b.suspect]
    if len(sure) in (0, len(some)):
        return some
    fused = _fused(sure)
    mean = sum(fused[b.path] * len(b.text) for b in sure) / sum(len(b.text) for b in sure)
    articles = any(b.inside for b in sure)
    by: dict[int, list[Block]] = {}
    for b in some:
        if b.suspect:
            by.setdefault(b.suspect, []).append(b)
    text = set()
    for suspect, run in by.items():
        length, marks = sum(len(b.text) for b in run), sum(len(_POINTS.findall(b.text)) for b in run)
        ratio = 0.0 if _only_links(run) else (length / len(run) * (marks / len(run) + 0.5)) ** 0.5
        if ratio >= CONFIRMED * mean and (run[0].inside or not articles) and not _notice(run, suspect):
            text.add(suspect)
    return [b for b in some if not b.suspect or b.suspect in text]


#: Headings that introduce what readers wrote, and notices by what they say (beside a name that says so).
READERS = re.compile(r"(?:\d[\d,.]*\s+)?(?:(?:reader|user|visitor)s?['’]?\s+)?(?:comments|opinions|feedback|replies)(?:\s*[(:]?\s*\d*\s*[):]?)?|"
                     r"(?:leave|post|add|write)\s+(?:a|your)\s+(?:comment|reply|response)|"
                     r"what\s+(?:do\s+you\s+think|readers\s+(?:say|think|wrote))\s*\??", re.I)
NOTICE = re.compile(r"\bcookies?\b|privacy\s+policy|terms\s+of\s+(?:use|service)|\b(?:sign\s+up|subscribe|log\s*in)\b|all\s+rights\s+reserved",
                    re.I)


def _without_readers(some: list[Block]) -> list[Block]:
    """Without what a heading of reader comments introduces: it, and all after it in the element around it. (Where the
    element is that of the text itself, a heading of its own rank or above ends it.)"""
    out: list[Block] = []
    around: tuple[int, ...] | None = None
    rank = ""
    for b in some:
        if around is not None and b.nodes[:len(around)] == around and not (_is_heading(b) and b.path[-1] <= rank
                                                                           and not READERS.fullmatch(b.text)):
            continue
        around = None
        if _is_heading(b) and READERS.fullmatch(b.text):
            around, rank = b.nodes[:-1], b.path[-1]
            continue
        out.append(b)
    return out


def _notice(some: list[Block], suspect: int) -> bool:
    """Whether a short suspect element is a notice by its words."""
    own = [b for b in some if b.suspect == suspect]
    return len(own) <= 3 and sum(len(b.text) for b in own) <= 400 and any(NOTICE.search(b.text) for b in own)


def main_text(page: str | None, threshold: float = 0.1) -> str:
    found = blocks(page or "")
    usable = _without_readers(_confirmed([b for b in found if not b.boilerplate]))
    if not usable:
        return ""
    return "\n".join(b.text for b in _contents(found, usable, _dense(usable, threshold)))


def extracted(page: Column, threshold: float = 0.1) -> Column:
    @F.pandas_udf("string")
    def one(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(p, threshold) for p in pages], dtype=object)

    return one(page)


def extract_pages(pages: DataFrame, page: str = "html", threshold: float = 0.1) -> DataFrame:
    """Every row of ``pages`` with ``text`` and ``n_chars`` instead of a column of those names."""
    kept = others(pages, ["text", "n_chars"])
    return (pages.select(*[q(c) for c in kept], extracted(q(page), threshold).alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
