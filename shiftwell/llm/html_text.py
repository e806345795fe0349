"""Main text of web pages by the distribution of text over line blocks."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
SURGE = 86

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>",
    re.S,
)
ATTRIBUTE = re.compile(
    r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S
)

# Element names of HTML by their role.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main "
    "menu nav ol optgroup option p pre search section summary table tbody tfoot thead tr ul "
    "caption".split()
)
NO_CONTENT = frozenset(
    "head script style noscript template svg math canvas nav footer aside form button select "
    "textarea title iframe object audio video dialog menu search noembed noframes datalist".split()
)
CELLS = frozenset("td th br wbr img".split())
HEADINGS = "header"
HEADS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
WRAPPERS = frozenset("html body main article".split())
SAME_CLOSES = {
    "li": ("ul", "ol", "menu"),
    "dt": ("dl",),
    "dd": ("dl",),
    "tr": ("table",),
    "option": ("select",),
}
ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar "
    "toolbar form".split()
)
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot adsense banner sponsor "
    "sponsored promo promos promotion sidebar widget widgets menu nav navbar navigation topnav "
    "breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices notification "
    "popup modal overlay newsletter subscribe subscription signup login share sharing sharebar "
    "social related recommended recommendations comment comments commentlist disqus respond "
    "reply replies toolbar pagination pager searchform searchbox copyright paywall alert "
    "hidden".split()
)
PLAIN_LEADS = frozenset("with has no without js is".split())
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Line:
    """One block of a page: its text in pieces, and whether it lies in an article."""

    scope: int
    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    empty: bool = False
    heading: bool = False


def _is_boilerplate(name: str, attributes: dict[str, str], in_article: bool) -> bool:
    if name in NO_CONTENT or (name == HEADINGS and not in_article):
        return True
    if name in WRAPPERS and not attributes.get("class", "") + attributes.get("id", ""):
        return False
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", "")):
        return True
    if attributes.get("role", "").lower() in ROLES:
        return True
    if name in ("html", "body", "main"):
        return False
    for label in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        parts = [part.lower() for part in NAME_PARTS.findall(label)]
        if parts and parts[0] not in PLAIN_LEADS and {parts[0], parts[-1]} & BOILERPLATE:
            return True
        if parts and parts[-1] == HEADINGS and not in_article and name == "div":
            return True
    return False


def page_lines(page: str) -> list[Line]:
    """A page as lines: one per block with text of its own, and one per empty block.

    A block is empty if nothing but white space stands between its tags; tags that only
    nest make no line, nor does boilerplate. ``scope`` is 2 inside an article element, 1
    inside main, 0 elsewhere.
    """
    lines: list[Line] = [Line(0)]
    opened = None
    stack: list[tuple[str, bool, int]] = []
    links = 0

    def now() -> tuple[bool, int]:
        return (stack[-1][1], stack[-1][2]) if stack else (False, 0)

    def cut(scope: int) -> None:
        lines.append(Line(scope))

    def add(text: str) -> None:
        skipped, scope = now()
        if not text or skipped:
            return
        if lines[-1].scope != scope and not lines[-1].pieces:
            lines[-1].scope = scope
        lines[-1].pieces.append(text)
        if links:
            lines[-1].linked += len(text.strip())

    def close(name: str, stops: tuple[str, ...] = ()) -> None:
        for place in range(len(stack) - 1, -1, -1):
            if stack[place][0] == name:
                del stack[place:]
                return
            if stack[place][0] in stops:
                return

    at = 0
    while True:
        found = TAG.search(page, at)
        if found is None:
            add(page[at:])
            break
        add(page[at : found.start()])
        at = found.end()
        name = (found["name"] or found["name2"] or "").lower()
        if not name:
            if found[0].startswith("<![CDATA["):
                add(html.escape(found[0][9:].removesuffix("]]>")))
            continue
        if found["end"] or found["end2"]:
            if name == "a":
                links = max(0, links - 1)
            inside = any(entry[0] == name for entry in stack)
            if inside and lines[-1] is opened and stack[-1][:2] == (name, False):
                opened.empty = True
            close(name)
            if name in BLOCKS and (inside or name == "p"):
                cut(now()[1])
            continue
        if name in RAW:
            shut = re.compile(rf"</{name}[\s/>]", re.I).search(page, at)
            at = shut.start() if shut else len(page)
            if name in ("title", "textarea", "script", "style", "xmp", "iframe"):
                continue
        if name in BLOCKS:
            close("p", ("table", "button", "td", "th", "caption"))
            if name in SAME_CLOSES:
                close(name, SAME_CLOSES[name])
                if name in ("dt", "dd"):
                    close("dd" if name == "dt" else "dt", SAME_CLOSES[name])
        skipped, scope = now()
        attributes = {
            key.lower(): a or b or c
            for key, a, b, c in ATTRIBUTE.findall(found["attrs"] or found["attrs2"] or "")
        }
        skipped = skipped or _is_boilerplate(name, attributes, scope == 2)
        if name == "article" or attributes.get("itemprop", "").lower() == "articlebody":
            scope = 2
        elif name == "main" or attributes.get("role", "").lower() == "main":
            scope = max(scope, 1)
        if name in CELLS:
            add(" ")
        if name in VOID:
            if name in BLOCKS:
                cut(scope)
            continue
        if name == "a":
            links += 1
        stack.append((name, skipped, scope))
        if name in BLOCKS:
            cut(scope)
            opened = lines[-1]
            opened.heading = name in HEADS
    return [line for line in lines if line.empty or "".join(line.pieces).strip()]


def _text(line: Line) -> str:
    return " ".join(html.unescape("".join(line.pieces)).split())


def _headed(lines: list[Line], texts: list[str]) -> list[int]:
    """The places of all lines but the empty ones between a heading and what it heads."""
    places, headed = [], False
    for place, (line, text) in enumerate(zip(lines, texts)):
        if text:
            headed = line.heading
        elif headed:
            continue
        places.append(place)
    return places


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    """The blocks of a page between the points where its text surges and dives.

    Each line weighs the length of its own text, none if over half of it is links on
    other pages. Where the articles of a page, or else its main part, hold over half of
    its text, lines outside weigh nothing and each line of text inside half a ``surge``
    more. The sums over ``window`` lines from each line on are the page's distribution.
    A surge is a line whose sum exceeds ``surge``, a dive the next line from which the
    sum is nothing; text between them is kept. Empty blocks between a heading and the
    text under it count as no lines. A page that never surges keeps all lines
    of any weight.
    """
    lines = page_lines(page or "")
    texts = [_text(line) for line in lines]
    places = _headed(lines, texts)
    lines, texts = [lines[i] for i in places], [texts[i] for i in places]
    lengths = [
        len(text) if 2 * line.linked <= len(text) or not line.linked else 0
        for line, text in zip(lines, texts)
    ]
    scope = next(
        scope
        for scope in (2, 1, 0)
        if 2 * sum(n for line, n in zip(lines, lengths) if line.scope >= scope) > sum(lengths)
        or not scope
    )
    if scope:
        weights = [
            len(text) + surge / 2 if text and line.scope >= scope else 0
            for line, text in zip(lines, texts)
        ]
    else:
        weights = lengths
    sums = [sum(weights[i : i + window]) for i in range(len(weights))]
    kept, inside = [], False
    for i, total in enumerate(sums):
        inside = total > surge or (inside and total > 0)
        if inside and weights[i]:
            kept.append(texts[i])
    if not kept:
        kept = [text for text, weight in zip(texts, weights) if weight]
    return "\n".join(kept)


def extract_text(
    pages: DataFrame, window: int = WINDOW, surge: int = SURGE, source: str = "html"
) -> DataFrame:
    """The columns of ``pages`` but ``source``, plus text and n_chars.

    White space inside a block is one space, blocks are joined by a line end,
    character references are decoded, whole pages are read. A NULL or empty page, and
    one without text, gives the empty string. Each row is worked on alone, so
    repeated rows and NULL ids keep their place, and an empty table stays empty.
    Columns named as a result column are replaced.
    """

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(page, window, surge) for page in batch], dtype=object)

    rest = pages.drop(*[name for name in ("text", "n_chars") if name != source])
    return (
        rest.withColumn("text", extract(F.col(source)))
        .withColumn("n_chars", F.length("text").cast("long"))
        .drop(*[source] if source not in ("text", "n_chars") else [])
    )
