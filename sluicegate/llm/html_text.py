"""Main text of web pages by the distribution of text over lines.

Markup is stripped to lines: every block element begins one, and what is never text (scripts, styles,
comments, the head, forms) goes.  A line weighs as many characters as it has outside links; lines
in containers that are boilerplate by their element or by a class that is or ends in one of a list of words weigh nothing
(unless such a class holds the page's only article, or its only text), and
so do lines outside the article where the page marks one.  Summed over a sliding window of lines the weights surge
where the text begins and dive to nothing where it ends; lines with weight between
a surge and the next dive are the text.

Pages are independent, so this is one narrow pass.  Null, empty and blank pages have the empty text.
Very long pages are handled whole.  Repeated rows and null ids are kept; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
# A window with this much text is a surge; on short pages, half of the fullest window is.
SURGE = 86

# Elements by what they do.
DROPPED = frozenset(
    "script style noscript template head title svg math iframe object canvas textarea select button audio video map".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody tfoot thead tr "
    "ul legend caption".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CELLS = frozenset(("td", "th"))
# Elements whose close is not left out; one that opened before a dropped element ends it.
CLOSING = (BLOCKS | {"html", "a"}) - {"p", "br", "hr"}
ARTICLE = frozenset(("article", "main"))
BOILERPLATE = frozenset(("nav", "header", "footer", "aside", "form", "menu", "dialog"))
# Inside an article its header holds the title.
NOT_IN_ARTICLE = frozenset(("header", "hgroup"))
BOILERPLATE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner promo promotion sponsor sponsored sponsors "
    "sidebar side aside rail menu nav navbar navigation breadcrumb breadcrumbs masthead topbar footer foot cookie cookies "
    "consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup signin login register "
    "social share sharing shares follow related recommended recommendations trending popular comment comments commentlist "
    "discussion disqus replies reply respond widget widgets pagination pager toolbar search copyright legal disclaimer "
    "taboola outbrain complementary contentinfo search".split()
)

# A tag as browsers read it: a quote opens a value only behind an equals sign, and may hold anything but itself.
_OPENING = re.compile(r"<(?:[!?]|/?[a-zA-Z])")
_NAME = r"<(/?)([a-zA-Z][\w:.-]*+)"
_ELEMENT = re.compile(
    _NAME + r"""((?:=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]*+)|[^>=]++)*+)>"""
)
# Where a quote is never closed, a tag ends at the next angle bracket.
_UNCLOSED = re.compile(_NAME + r"([^>]*+)>")
_REMARK = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))()()()|<[!?][^>]*+>()()()", re.DOTALL)
_ATTRIBUTE = re.compile(r"""([^\s/=][^\s/=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s]*+)))?+""")
_NOT_SHOWN = re.compile(r"display\s*:\s*none", re.IGNORECASE)
_WORD = re.compile(r"[a-z0-9]+")
# First words of a class that tells what a page's layout has or lacks ("no-sidebar").
LAYOUT_WORDS = frozenset("no not without with has hide".split())
# Elements whose content is no markup.
RAW = frozenset("script style textarea title iframe".split())
_SPACE = re.compile(r"\s+")


_RAW_END = {name: re.compile(f"</{name}(?=[\\s/>])", re.IGNORECASE) for name in RAW}


def _tags(page: str) -> Iterator[re.Match]:
    """Tags, comments and declarations in order; groups tell the slash, name and attributes of a tag.

    Every tag is read once, so malformed pages take no longer.
    """
    at = 0
    quotes_fail_before = -1
    while opening := _OPENING.search(page, at):
        start = opening.start()
        if page[start + 1] in "!?":
            tag = _REMARK.match(page, start)
        else:
            tag = None
            if start >= quotes_fail_before:
                tag = _ELEMENT.match(page, start)
            if not tag and (tag := _UNCLOSED.match(page, start)):
                quotes_fail_before = max(page.rfind('"'), page.rfind("'"))
        if not tag:
            return
        yield tag
        at = tag.end()
        name = (tag[2] or "").lower()
        if name in RAW and not tag[1] and not tag[3].endswith("/"):
            end = _RAW_END[name].search(page, at)
            if not end:
                return
            at = end.start()


def _attributes(text: str) -> dict[str, str]:
    """Values by name in lower case; of repeated names the first counts."""
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), "".join(values))
    return found


def _is_hidden(attributes: dict[str, str]) -> bool:
    return (
        "hidden" in attributes
        or "hidden" in attributes.get("class", "").lower().split()
        or bool(_NOT_SHOWN.search(attributes.get("style", "")))
    )


class _Lines:
    """The lines of a page: text, weight, and whether an article holds it."""

    def __init__(self) -> None:
        self.rows: list[tuple[str, int, bool]] = []
        self._parts: list[str] = []
        self._linked = 0
        self._state = (False, False)

    def add(self, raw: str, link: bool) -> None:
        self._parts.append(raw)
        if link:
            self._linked += len(_SPACE.sub(" ", html.unescape(raw)).strip())

    def end(self, state: tuple[bool, bool]) -> None:
        """Close the line, which stood in the state so far, and begin one in a new state."""
        text = _SPACE.sub(" ", html.unescape("".join(self._parts))).strip()
        boilerplate, article = self._state
        if text:
            weight = 0 if boilerplate else max(len(text) - self._linked, article and 1)
            self.rows.append((text, int(weight), article))
        self._parts, self._linked, self._state = [], 0, state


def _names_boilerplate(value: str) -> bool:
    """Whether a class is one of the words, or ends in one that it does not use to tell the layout."""
    for token in value.lower().split():
        words = _WORD.findall(token)
        if words and words[-1] in BOILERPLATE_WORDS and not (len(words) > 1 and words[0] in LAYOUT_WORDS):
            return True
    return False


def _is_boilerplate(name: str, attributes: dict[str, str], article: bool, named: bool) -> bool:
    if name in BOILERPLATE:
        return not (article and name in NOT_IN_ARTICLE)
    if not attributes or name in ("html", "body"):
        return False
    if _is_hidden(attributes):
        return True
    return named and any(
        _names_boilerplate(html.unescape(attributes.get(key, ""))) for key in ("class", "id", "role")
    )


def lines_of(page: str, named: bool = True, lift: bool = False) -> list[tuple[str, int, bool]]:
    """Strip a page's markup to its lines.

    ``named`` says whether classes tell boilerplate, ``lift`` whether an article in such an element ends it.
    """
    lines = _Lines()
    at = 0
    links = articles = 0
    # The element that holds boilerplate, and how many of its name are open within it.
    outer, depth, by_name = "", 0, False
    skip_to, inside = "", Counter()
    for tag in _tags(page):
        if skip_to:
            name = (tag[2] or "").lower()
            if not tag[0].startswith("</"):
                # A body ends a head that is not closed.
                if not (skip_to == "head" and name == "body"):
                    inside[name] += name not in VOID and not tag[0].endswith("/>")
                    continue
                at = tag.start()
            elif name == skip_to and (skip_to in RAW or not inside[name]):
                skip_to, at = "", tag.end()
                continue
            elif skip_to in RAW or name not in CLOSING or inside[name]:
                inside[name] -= inside[name] > 0
                continue
            else:  # The parent's close ends an element that is not closed.
                at = tag.start()
            skip_to = ""
        if tag.start() < at:
            continue
        if tag.start() > at:
            lines.add(page[at : tag.start()], links > 0)
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue
        closing = bool(tag[1])
        if name in DROPPED and not closing:
            if not tag[3].endswith("/"):
                skip_to, inside = name, Counter()
            continue
        if name == "a":
            links = 0 if closing else 1
        if closing:
            if name in ARTICLE:
                articles = max(0, articles - 1)
            if outer and name == outer:
                depth -= 1
                if not depth:
                    outer = ""
            elif outer and name in ARTICLE and not depth:
                outer = ""
        elif name not in VOID:
            if outer and lift and by_name and name in ARTICLE:
                outer, depth = "", 0
            if outer:
                depth += name == outer
            elif _is_boilerplate(name, attributes := _attributes(tag[3]), articles > 0, named):
                outer, depth = name, 1
                by_name = name not in BOILERPLATE and not _is_hidden(attributes)
            if name in ARTICLE:
                articles += 1
        if name in BLOCKS:
            lines.end((bool(outer), articles > 0))
        elif name in CELLS:
            lines.add(" ", False)
    if not skip_to and at < len(page):
        lines.add(page[at:], links > 0)
    lines.end((False, False))
    return lines.rows


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    """The main text of a page, one block a line."""
    rows = lines_of(page or "")
    marked = any(article and weight for _, weight, article in rows)
    if not marked:
        # Classes do not close over the page's own article, nor over its only text that surges.
        lifted = lines_of(page or "", lift=True)
        if any(article and weight for _, weight, article in lifted):
            rows, marked = lifted, True
        elif sum(weight for _, weight, _ in rows) < surge:
            whole = lines_of(page or "", named=False)
            if sum(weight for _, weight, _ in whole) >= surge:
                rows = whole
    weights = [0 if marked and not article else weight for _, weight, article in rows]
    if not any(weights):
        return ""
    size = len(weights)
    sums, total = [0] * size, 0
    for at in range(size - 1, -1, -1):
        total += weights[at] - (weights[at + window] if at + window < size else 0)
        sums[at] = total
    # An article is text however short; elsewhere a stretch needs a window that surges.
    least = 1 if marked else min(surge, max(sums) / 2)
    kept: list[str] = []
    at = 0
    while at < size:
        if not sums[at]:
            at += 1
            continue
        dive = at
        while dive < size and sums[dive]:
            dive += 1
        if max(sums[at:dive]) >= least:
            kept += [rows[i][0] for i in range(at, dive) if weights[i]]
        at = dive
    return "\n".join(kept)


def extract(
    pages: DataFrame, id_column: str = "page_id", html_column: str = "html", keep: tuple[str, ...] = ("url",)
) -> DataFrame:
    """The id, the columns to keep, and the main text of every page."""
    kept = [id_column, *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(len(kept))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept)], pa.array(texts, pa.string())], [*kept, "text"]
            )

    kinds = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in kept)
    return pages.select(*kept, F.col(html_column).cast("string").alias("_page")).mapInArrow(
        run, f"{kinds}, text string"
    )
