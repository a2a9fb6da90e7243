"""HTML main text (operator 10) by tag-path ratios.

A page is read into text blocks, each with its root-to-leaf tag path.  Text
length and punctuation are summed per path over the page; a path's two ratios
(characters per block, punctuation marks per block) are fused by multiplication,
the fused values are smoothed along the page order with a short Gaussian, and
blocks above the threshold (the standard deviation of the smoothed values) are
taken as content.  A sectioning element that holds such blocks counts where one of its own
blocks is of some weight too (a line of a footer that merely shares the content's path is not).
The content's container is the deepest sectioning element that holds all of these (no
deeper than an article or main).  Every block of an article or main that is no boilerplate
is returned; of any other container those from the first element that counts to the last
one, with what lies between, and the container's own blocks around them.  So a short paragraph or a
heading between long ones is kept, and so is a second section or article.

Boilerplate is left out before the ratios are computed: scripts, styles, forms,
menus, page headers and footers, sidebars, notices, adverts and reader comments,
by element, role, or a name of the class or id.  A name counts if it is nothing but cues and
words for a place (``ad-slot``, not ``share-price``); a cue among other words counts outside
articles only, and only where the ratios may still decide: not where its elements hold more
text than the page has outside all elements with cues, nor does a plain name there on a page without an
article or main elsewhere.

Character references are decoded, white space inside a block becomes one space,
blocks are joined by a blank line.  Null or empty html, or a page without any
text, gives an empty text.  Every row gives one row; pages are independent, so
there is no shuffle, and a hot url or host does not matter.
"""

from __future__ import annotations

import html as _html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import slices

# Fixed values of HTML: element classes by name.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr br img".split())
SECTIONS = frozenset("html body main article section div center table tbody thead tr td".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
                     "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul li dd dt".split())
CLOSED_BY = {"li": ("li", frozenset(("ul", "ol", "menu"))), "dt": ("dt dd", frozenset(("dl",))),
             "dd": ("dt dd", frozenset(("dl",))), "tr": ("tr td th", frozenset(("table",))),
             "td": ("td th", frozenset(("tr", "table"))), "th": ("td th", frozenset(("tr", "table"))),
             "option": ("option", frozenset(("select",)))}
BOILERPLATE = frozenset("head script style noscript template nav aside form button select textarea input iframe svg "
                        "object canvas dialog footer menu title".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
CUES = frozenset(
    "ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion banner sidebar "
    "sidebars widget widgets related recommended recommendations menu menus nav navbar navigation breadcrumb breadcrumbs "
    "footer cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription share "
    "sharing social comment comments commentlist disqus reply replies respond login signup form toolbar pagination "
    "pager skip".split())
HEADER_CUES = frozenset("header masthead topbar".split())
#: words of a name that say where or how an element stands, not what it is
PLACES = frozenset("box block slot container wrapper wrap area zone section list item items link links button buttons bar "
                   "panel pane unit row col column inner outer top bottom left right main body content wide fixed "
                   "posts post articles stories thread icons form js x s m l".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/)?(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_PUNCT = re.compile(r"[.,;:!?…。，、！？；：]")


@dataclass
class Block:
    path: str
    elements: tuple[int, ...]  # the open sectioning elements, outermost first
    text: str


@dataclass
class Cued:
    """An element with a cue in its class or id (number 0: the page), and the text inside it and no deeper one."""
    kind: tuple[str, frozenset[str], bool]
    inner: list[int]
    length: int = 0
    article: bool = False  # some of that text is in an article or main


def _boilerplate(name: str, attrs: str, inside_article: bool) -> tuple[bool, frozenset[str], bool]:
    """Whether an element is boilerplate by its name, role or being hidden; the cues in its class and id, and
    whether one of their names has no other words."""
    if name in BOILERPLATE or (name == "header" and not inside_article):
        return True, frozenset(), False
    cues: set[str] = set()
    plain = False
    for m in _ATTR.finditer(attrs):
        key, value = m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or ""
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return True, frozenset(), False
        if key == "role" and value.strip().lower() in ROLES:
            return True, frozenset(), False
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True, frozenset(), False
        if key in ("class", "id") and name not in ("html", "body", "main", "article"):
            for one in value.split():
                words = {w.lower() for w in _WORDS.findall(one)}
                some = words & (CUES if inside_article else CUES | HEADER_CUES)
                whole = bool(some) and all(w in some or w in PLACES or w.isdigit() for w in words)
                if whole or not inside_article:
                    cues |= some
                plain |= whole
    return False, frozenset(cues), plain


def _content(cued: list[Cued]) -> set[int]:
    """The numbers of the elements whose cues are not believed, so that their own text stays.

    The outermost elements are weighed first, those of one name and cue together.  Where they hold more than all text
    outside such elements, the cue is not believed and the elements inside are weighed next.  A name that is nothing
    but a cue is believed if the page has an article or main outside all of them.
    """
    held = [c.length for c in cued]
    for e in range(len(cued) - 1, -1, -1):
        held[e] += sum(held[i] for i in cued[e].inner)
    kept = {0}
    clear, article = cued[0].length, cued[0].article
    outer: dict[tuple, list[int]] = {}
    totals: dict[tuple, int] = {}
    more = cued[0].inner
    while True:
        for e in more:
            outer.setdefault(cued[e].kind, []).append(e)
            totals[cued[e].kind] = totals.get(cued[e].kind, 0) + held[e]
        large = [k for k, n in totals.items() if n > clear]
        large = [k for k in large if not k[2]] or ([] if article else large)
        if not large:
            return kept
        more = []
        for k in large:
            del totals[k]
            for e in outer.pop(k):
                kept.add(e)
                clear += cued[e].length
                article |= cued[e].article
                more += cued[e].inner


def blocks_of(page: str) -> tuple[list[Block], dict[int, str]]:
    """The page's text blocks outside boilerplate, in order, and the names of its sectioning elements."""
    blocks: list[Block] = []
    names: dict[int, str] = {}
    stack: list[tuple[str, int, bool]] = []  # name, number (sections) or -1, boilerplate
    cued = [Cued(("", frozenset(), False), [])]
    around = [(-1, 0)]  # the open cued elements: place in the stack, number
    raw: list[tuple[str, tuple[int, ...], list[tuple[int, str]]]] = []
    buffer: list[tuple[int, str]] = []  # pieces with the innermost cued element
    dropped = articles = number = 0
    where: tuple[str, tuple[int, ...]] | None = None

    def flush() -> None:
        nonlocal where
        if buffer:
            raw.append((*where, buffer.copy()))
            buffer.clear()
        where = None

    def say(text: str) -> None:
        nonlocal where
        if dropped or not text:
            return
        if where is None:
            where = ("/".join(s[0] for s in stack if s[0] not in INLINE), tuple(s[1] for s in stack if s[1] >= 0))
        inner = around[-1][1]
        buffer.append((inner, text))
        if said := len(text.strip()):
            cued[inner].length += said
            cued[inner].article |= articles > 0

    def pop_to(k: int) -> None:
        nonlocal dropped, articles
        while len(stack) > k:
            name, _, out = stack.pop()
            dropped -= out
            articles -= name in ("article", "main")
            if name not in INLINE:
                flush()
            if around[-1][0] == len(stack):
                around.pop()

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if not m:
            say(page[at:])
            break
        say(page[at:m.start()])
        at = m.end()
        if m["cdata"]:
            say(_html.escape(m["cdata"]))
        if not m["name"]:
            continue
        name = m["name"].lower()
        if m["close"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    pop_to(k)
                    break
            continue
        if name in RAW:  # its content is no markup
            end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)|\Z", re.I).search(page, at)
            at = end.end()
            continue
        if name in CLOSES_P:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p":
                    pop_to(k)
                    break
                if stack[k][0] not in INLINE:
                    break
        if name in CLOSED_BY:
            closed, scope = CLOSED_BY[name]
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in scope:
                    break
                if stack[k][0] in closed.split():
                    pop_to(k)
                    break
        if name == "br":
            say(" ")
            continue
        if name not in INLINE:
            flush()
        if name in VOID or m["attrs"].endswith("/"):
            continue
        out, cues, plain = _boilerplate(name, m["attrs"], articles > 0)
        if cues and not dropped:
            cued[around[-1][1]].inner.append(len(cued))
            around.append((len(stack), len(cued)))
            cued.append(Cued((name, cues, plain), []))
        if name in SECTIONS:
            names[number] = name
            stack.append((name, number, out))
            number += 1
        else:
            stack.append((name, -1, out))
        dropped += out
        articles += name in ("article", "main")
    flush()
    kept = _content(cued)
    for path, elements, pieces in raw:
        text = " ".join(_html.unescape("".join(t for e, t in pieces if e in kept)).split())
        if text:
            blocks.append(Block(path, elements, text))
    return blocks, names


def path_scores(blocks: list[Block]) -> list[float]:
    """Each block's fused ratio of its path: characters per block times punctuation marks per block (plus one)."""
    totals: dict[str, list[float]] = {}
    for b in blocks:
        t = totals.setdefault(b.path, [0, 0, 0])
        t[0] += len(b.text)
        t[1] += len(_PUNCT.findall(b.text))
        t[2] += 1
    fused = {p: (c / n) * (1 + q / n) for p, (c, q, n) in totals.items()}
    return [fused[b.path] for b in blocks]


def smooth(values: list[float], radius: int = 2) -> list[float]:
    """Gaussian smoothing along the page order."""
    kernel = [math.exp(-0.5 * (d / (radius / 2)) ** 2) for d in range(-radius, radius + 1)]
    out = []
    for i in range(len(values)):
        total = weight = 0.0
        for d in range(-radius, radius + 1):
            if 0 <= i + d < len(values):
                total += kernel[d + radius] * values[i + d]
                weight += kernel[d + radius]
        out.append(total / weight)
    return out


def main_text(page: str) -> str:
    """The main text of a page."""
    blocks, names = blocks_of(page)
    if not blocks:
        return ""
    fused = path_scores(blocks)
    scores = smooth(fused)
    mean = sum(scores) / len(scores)
    threshold = min(math.sqrt(sum((s - mean) ** 2 for s in scores) / len(scores)), max(scores))
    chosen = [i for i, s in enumerate(scores) if s >= threshold]
    own = [i for i in chosen if fused[i] >= threshold] or chosen  # not those chosen for their neighbours alone
    heavy = {b.elements for b in blocks if 4 * len(b.text) * (1 + len(_PUNCT.findall(b.text))) >= threshold}
    own = [i for i in own if blocks[i].elements in heavy] or own
    container: tuple[int, ...] = ()
    for level in zip(*(blocks[i].elements for i in own), strict=False):
        if len(set(level)) > 1:
            break
        container += level[:1]
        if names[level[0]] in ("article", "main"):
            break
    depth = len(container)
    inside = [i for i, b in enumerate(blocks) if b.elements[:depth] == container]
    if not container or names[container[-1]] not in ("article", "main"):
        # the elements of the container that count; its own blocks are not cut off
        parts = {blocks[i].elements[:depth + 1] for i in own}
        stays = [i for i in inside if blocks[i].elements[:depth + 1] in parts or len(blocks[i].elements) == depth]
        inside = [i for i in inside if stays[0] <= i <= stays[-1]]
    return "\n\n".join(blocks[i].text for i in inside)


def extract_main_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "html"):
            texts = [main_text(p) for p in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
                        F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("html"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:2])
    return rows.mapInArrow(run, f"{kinds}, text string, n_chars long")
