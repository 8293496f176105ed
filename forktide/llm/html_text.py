"""Main text of web pages by the line-block distribution.

Markup is stripped into lines, one per block element, and every line has a length: that of its text
outside links, or 0 if at least two thirds of it are links or it stands in an element that is never part of
an article (menus, adverts, forms, notices, comments, ...). Where ``article`` and ``main`` elements hold
at least ``MAIN_SHARE`` of the page's length, the lines outside have length 0 too, and those inside weigh
``MAIN_WEIGHT`` times; where they hold less, as teaser cards do, they count as other elements. Lengths
are summed over windows of ``WINDOW`` lines. The sums surge from zero where running text begins and dive back to zero
where it ends; between a surge and the next dive lies a stretch. Excluded lines between two lines of
one container, as an advert between paragraphs, are passed over and make no dive. The stretches whose
highest sum is at least ``LEAST`` characters, or ``SHARE`` of the highest on pages of less text, are kept,
with every line in them that is not excluded, less the lines of length 0 at their ends (a heading before
the first line stays). If that leaves nothing, as on a page of links, all lines are kept. One long line so makes no other stretch fall.

In a kept line character references are decoded, runs of white space become one space and the ends
are trimmed; kept lines are joined by an empty line, in page order. Nothing is cut.

Defined results: NULL, empty and text-free pages give the empty text; broken markup (tags that are
never closed or never opened, stray ``<``) is read as far as it can be; repeated rows give repeated
results; columns other than those asked for are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

WINDOW = 3
LEAST = 80
SHARE = 0.2
MAIN_SHARE = 1 / 3
MAIN_WEIGHT = 8
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

# Elements and attribute words, as the HTML standard and common practice have them.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript template iframe xmp svg math object".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p "
    "pre section summary table tbody tfoot thead tr ul".split()
)
SPACED = {"br", "td", "th", "option"}
DROPPED = set(
    "nav footer aside form button select fieldset dialog menu audio video canvas map datalist".split()
)
MAIN = {"article", "main"}
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
DROPPED_WORDS = set(
    "ad ads advert adverts advertisement advertisements advertising adsense adslot sponsor sponsored "
    "promo promos promotion banner cookie cookies consent gdpr notice notices popup overlay modal "
    "newsletter subscribe subscription nav navbar navigation menu menus breadcrumb breadcrumbs sidebar "
    "sidebars aside widget widgets related recommended recommendations share sharing social footer "
    "header masthead comment comments reply replies respond disqus login signin signup search toolbar "
    "pagination pager paging skip outbrain taboola".split()
)
# What may be put around a whole page, and words of what readers write, which never is.
FRAMES = {"form", "fieldset", "search"}
READERS = set("comment comments reply replies respond disqus".split())
KEPT, HINT, SURELY = 0, 1, 2
# A part that is left out by a hint is a frame of the page if it holds so much of the text outside links
# while so little is left without it.
FRAME_SHARE, LEFT_SHARE = 0.8, 0.1
# A new one of these ends an open one of the second set, up to the element that holds them.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?"
    r"|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class _Element:
    __slots__ = ("name", "dropped", "start", "end", "up", "inside_main", "out")

    def __init__(self, name: str, dropped: int, start: int, up: _Element | None, inside_main: bool):
        self.name, self.dropped, self.start, self.end, self.up = name, dropped, start, -1, up
        self.inside_main = inside_main
        self.out: bool | None = None  # whether it or an element around it is left out, once known


class _Line:
    __slots__ = ("parts", "linked", "element", "start")

    def __init__(self, element: _Element, start: int):
        self.parts: list[str] = []
        self.linked = 0
        self.element = element
        self.start = start


def _is_dropped(name: str, attributes: str, inside_main: bool) -> int:
    """Whether an element is left out: KEPT, by a HINT of its name or words, or SURELY."""
    if name in ("html", "body") or name in MAIN:
        return KEPT
    if name in DROPPED or (name == "header" and not inside_main):
        return HINT if name in FRAMES else SURELY
    if not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return KEPT
    found = KEPT
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key in ("class", "id"):
            words = {w.lower() for w in WORD.findall(value)}
            if words & DROPPED_WORDS and not (words & {"header"} == words & DROPPED_WORDS and inside_main):
                found = max(found, SURELY if words & READERS else HINT)
        elif key == "role" and value.lower() in ROLES:
            found = max(found, HINT if value.lower() in FRAMES else SURELY)
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return SURELY
        elif key == "style" and HIDDEN.search(value):
            return SURELY
    return found


def lines_of(html: str) -> tuple[list[_Line], list[int]]:
    """Lines of a page, and the positions at which its article elements begin."""
    root = _Element("", KEPT, 0, None, False)
    here, links = root, 0
    line = _Line(root, 0)
    lines, mains = [line], []
    at = 0
    open_names: Counter[str] = Counter()
    never_closed: set[str] = set()

    def end_upto(outer: _Element, place: int) -> None:
        """End the open elements inside ``outer``."""
        nonlocal here, links
        while here is not outer:
            here.end = place
            links -= here.name == "a"
            open_names[here.name] -= 1
            here = here.up

    def text(piece: str) -> None:
        if piece:
            line.parts.append(piece)
            if links:
                line.linked += len(piece)

    for m in TOKEN.finditer(html):
        if m.start() < at:
            continue  # inside raw text
        text(html[at : m.start()])
        at = m.end()
        closing, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            if m[0].startswith("<![CDATA["):
                text(m[0][9:].removesuffix("]]>"))
            continue
        name = name.lower()
        if closing:
            open_one = here if open_names[name] > 0 else None
            while open_one is not None and open_one.name != name:
                open_one = open_one.up
            if open_one is not None and open_one.name and not (
                name not in BLOCKS and any(e.name in BLOCKS for e in _between(here, open_one))
            ):
                end_upto(open_one.up, m.start())
            if name in BLOCKS:
                line = _Line(here, m.start())
                lines.append(line)
            elif name in SPACED:
                text(" ")
            continue
        if name in RAW:
            end = None
            if name not in never_closed:
                end = re.compile(rf"</{re.escape(name)}\s*[^>]*>", re.I).search(html, at)
            if end:
                at = end.end()
            elif name not in ("svg", "math", "object", "iframe", "noscript", "template"):
                at = len(html)
            else:
                never_closed.add(name)
            continue
        if name in SPACED:
            text(" ")
        if name in VOID:
            if name in BLOCKS:
                line = _Line(here, m.start())
                lines.append(line)
            continue
        if name in BLOCKS:
            # A block ends an open paragraph and the inline elements within it.
            probe = here
            while probe.name and (probe.name not in BLOCKS or probe.name == "p"):
                if probe.name == "p" or probe.name == "a":
                    end_upto(probe.up, m.start())
                    if probe.name == "p":
                        break
                probe = probe.up
        if name in ENDS:
            siblings, holders = ENDS[name]
            probe = here
            while probe.name and probe.name not in holders:
                if probe.name in siblings:
                    end_upto(probe.up, m.start())
                    probe = here
                    continue
                probe = probe.up
        inside_main = here.inside_main or name in MAIN
        if name in MAIN:
            mains.append(m.start())
        if not (m[0].endswith("/>") and name not in BLOCKS):
            here = _Element(name, _is_dropped(name, attributes, here.inside_main), m.start(), here, inside_main)
            links += name == "a"
            open_names[name] += 1
        if name in BLOCKS:
            line = _Line(here, m.start())
            lines.append(line)
        elif here.dropped and here.name == name:
            # An inline element that is dropped, as a button, takes its text out of the line.
            line = _Line(here, m.start())
            lines.append(line)
    text(html[at:])
    return lines, mains


def _between(inner: _Element, outer: _Element) -> Iterator[_Element]:
    while inner is not outer:
        yield inner
        inner = inner.up


def _frames(lines: list[_Line], mains: list[int]) -> None:
    """Elements that hold the article, or next to all text of the page, are frames of it, not parts
    beside it, whatever their names hint at."""
    hinted: dict[int, _Element] = {}
    seen: set[int] = set()
    for line in lines:
        e = line.element
        while e is not None and id(e) not in seen:
            seen.add(id(e))
            if e.dropped:
                k = bisect_left(mains, e.start)
                if k < len(mains) and (e.end < 0 or mains[k] < e.end):
                    e.dropped = KEPT
                elif e.dropped == HINT:
                    hinted[id(e)] = e
            e = e.up
    if not hinted:
        return
    plain = [0]
    for line in lines:
        size = len("".join(line.parts).strip()) - line.linked
        plain.append(plain[-1] + max(size, 0))
    starts = [line.start for line in lines]
    total = plain[-1]
    left = sum(b - a for line, a, b in zip(lines, plain, plain[1:]) if not _left_out(line.element))
    if left >= LEFT_SHARE * total:
        return
    for e in hinted.values():
        a = bisect_left(starts, e.start)
        b = len(lines) if e.end < 0 else bisect_left(starts, e.end)
        if plain[b] - plain[a] >= FRAME_SHARE * total:
            e.dropped = KEPT
    for line in lines:  # as it was found out above
        e = line.element
        while e is not None and e.out is not None:
            e.out, e = None, e.up


def _left_out(e: _Element) -> bool:
    """Whether an element or one around it is left out."""
    chain = []
    while e is not None and e.out is None:
        chain.append(e)
        e = e.up
    out = e is not None and e.out
    for one in reversed(chain):
        out = one.out = bool(out or one.dropped)
    return bool(out)


def main_text(html: str | None) -> str:
    """The main text of one page."""
    if not html:
        return ""
    lines, mains = lines_of(html)
    _frames(lines, mains)

    found, inside, total = [], 0, 0
    for line in lines:
        clean = " ".join(unescape("".join(line.parts)).split()) if line.parts else ""
        out = _left_out(line.element)
        if not clean and not out:
            continue
        plain = 0 if out or 3 * line.linked >= 2 * len(clean) else len(clean) - line.linked
        found.append((line, "" if out else clean, plain))
        total += plain
        inside += plain if line.element.inside_main else 0
    some_main = inside > 0 and inside >= MAIN_SHARE * total
    if not total:
        some_main = any(clean and line.element.inside_main for line, clean, _ in found)
    texts, lengths, headings, passed, last = [], [], [], [], None
    for line, clean, plain in found:
        if not clean or some_main and not line.element.inside_main:
            passed.append(line)
            continue
        if passed and not (last and _beside(last.element, line.element)):
            texts += [""] * len(passed)
            lengths += [0] * len(passed)
            headings += [False] * len(passed)
        passed, last = [], line
        texts.append(clean)
        lengths.append(plain * MAIN_WEIGHT if some_main else plain)
        headings.append(_in_heading(line.element))
    return "\n\n".join(t for t in _stretches(texts, lengths, headings) or texts if t)


def _in_heading(e: _Element | None) -> bool:
    while e is not None and e.name not in BLOCKS:
        e = e.up
    return e is not None and e.name in HEADINGS


def _beside(a: _Element, b: _Element) -> bool:
    """Whether two lines stand in one container, or in sections of one."""
    if a is b or a is b.up or b is a.up or a.up is b.up:
        return True
    x, y = a.up, b.up
    return x is not None and y is not None and x.name == y.name == "section" and x.up is y.up


def _stretches(texts: list[str], lengths: list[int], headings: list[bool]) -> list[str]:
    """Texts between the surges and dives of the sums over WINDOW lines."""
    n = len(lengths)
    total, run = [0] * n, 0
    for i in range(n):
        run += lengths[i] - (lengths[i - WINDOW] if i >= WINDOW else 0)
        total[i] = run  # of the lines i - WINDOW + 1 .. i
    least = min(LEAST, SHARE * max(total, default=0))
    kept, i = [], 0
    while i < n:
        if total[i] == 0:
            i += 1
            continue
        surge = i
        while i < n and total[i] > 0:
            i += 1
        dive = i
        while lengths[dive - 1] == 0:
            dive -= 1
        if max(total[surge:i]) >= least:
            if surge and headings[surge - 1]:
                kept.append(texts[surge - 1])
            kept.extend(texts[surge:dive])
    return kept


def extract(pages: DataFrame, key: str = "page_id", html: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per page: key, the columns in ``keep``, ``text`` and ``n_chars``."""
    fields = pages.select(key, *keep).schema.fields
    schema = T.StructType(
        [*fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(html).to_pylist()]
            columns = [batch.column(c) for c in (key, *keep)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[key, *keep, "text", "n_chars"],
            )

    return pages.select(key, *keep, html).mapInArrow(run, schema)
