"""Main text of HTML pages by two passes of block rules.

The page is cut into blocks at block-level tags. The first pass decides blocks by where they stand,
their link density, length and density of stop words; short ones stay open. The second pass gives
open blocks the label of the nearest decided neighbours, looking inside their own region first.
Stop words say nothing of a text in another language than theirs: there length and links decide. A
form or an element named like furniture that encloses the page's text is no furniture.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlens.llm.common import chunks, raw_text

# Elements by what they mean for the text.
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav"
    " ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_SKIPPED = frozenset(
    "script style template noscript svg math iframe object canvas audio video select textarea"
    " button title option datalist".split()
)
_FURNITURE = frozenset("nav footer aside form menu dialog".split())
_TEXT_REGIONS = frozenset("article main".split())
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_INLINE_CONTAINERS = frozenset("span a b i em strong small label font".split())
_FURNITURE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs byline"
    " comment comments cookie cookies consent copyright disqus footer header masthead menu modal"
    " nav navbar navigation newsletter notice notices pagination popup promo promoted promotion"
    " recommended related share sharing sidebar signup social sponsor sponsored subscribe"
    " subscription toolbar widget".split()
)
# Furniture that may hold whole articles of its own.
_LIST_NAMES = frozenset("comment comments disqus recommended related".split())
# With one of these a name tells how a page is laid out or what state it is in.
_STATE_NAMES = frozenset("col cols column columns has is js layout no not show with without".split())
_TEXT_NAMES = frozenset("article content entry main post story text".split())
_FURNITURE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert menu menubar".split()
)

# Frequent words of English, French, German and Spanish.
STOP_WORDS = frozenset(
    "a an and are as at be but by for from had has have he her his in is it its not of on or she"
    " that the their they this to was were which with you"
    " au aux avec ce ces dans de des du elle en est et il ils la le les mais ne nous on ou par pas"
    " plus pour qu que qui sa se ses son sont sur un une vous"
    " als am auch auf aus bei das dass dem den der des die durch ein eine einem einen einer er es"
    " für hat ich im ist mit nach nicht noch nur oder sich sie sind so und vom von war wie wird zu"
    " zum zur"
    " al como con cuando del el ella era esta este fue ha hay la las lo los más me mi muy no nos"
    " para pero por que se sin sobre son su sus también una uno y ya".split()
)


@dataclass(frozen=True)
class BlockRules:
    short: int = 70
    long: int = 200
    link_density: float = 0.5
    stop_low: float = 0.15
    stop_high: float = 0.25


@dataclass(eq=False)
class Element:
    """An open element: what it makes of its content, and when it is no furniture after all.

    ``wraps``: if it encloses the page's text regions; ``weak``: if it encloses most of the text.
    """

    name: str
    kind: str
    region: int
    wraps: bool = False
    weak: bool = False
    holds: bool = False
    released: bool = False


@dataclass
class Block:
    """A block's text and what the rules ask about it."""

    text: str
    linked: int
    region: int
    in_text: bool
    furniture: bool
    label: str = ""
    words: list[str] = field(default_factory=list)


_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME_PARTS = re.compile(r"[^a-z0-9]+")
_WORD_EDGES = re.compile(r"^\W+|\W+$")


def _furniture_name(token: str) -> str:
    """How a class or id names furniture: whole, by its first or last part (weak), or not ('')."""
    if token in _FURNITURE_NAMES:
        return "whole"
    parts = [p for p in _NAME_PARTS.split(token) if p]
    if not parts or _STATE_NAMES & set(parts):
        return ""
    return "weak" if parts[0] in _FURNITURE_NAMES or parts[-1] in _FURNITURE_NAMES else ""


def _opened(name: str, rest: str, in_text: bool) -> Element:
    """The opened element, its kind furniture, text or nothing special."""
    element = Element(name, "", 0)
    strong = name in _FURNITURE and name != "form"
    weak = name == "form"
    soft = name == "header" and not in_text
    text = name in _TEXT_REGIONS
    lists = False
    for match in _ATTRIBUTE.finditer(rest) if rest else ():
        value = html.unescape(match[2] or match[3] or match[4] or "").lower()
        tokens = value.split()
        if match[1].lower() == "role":
            roles = set(tokens) | set(_NAME_PARTS.split(value))
            weak |= "form" in roles
            soft |= bool(roles & _FURNITURE_ROLES - {"form"})
            text |= "main" in roles or "article" in roles
            continue
        found = {t: _furniture_name(t) for t in tokens}
        if name not in _TEXT_REGIONS and name != "body":
            named_text = any(t in _TEXT_NAMES for t in tokens)
            soft |= "whole" in found.values()
            weak |= "weak" in found.values() and not named_text
            lists |= any(
                f and _LIST_NAMES & set(_NAME_PARTS.split(t)) for t, f in found.items()
            )
        if name in ("div", "section", "td"):
            text |= any(
                _TEXT_NAMES & set(_NAME_PARTS.split(t)) for t, f in found.items() if not f
            )
    if strong or soft or weak:
        element.kind = "furniture"
        element.wraps = not strong and not lists
        element.weak = weak and not (strong or soft or lists)
    elif text:
        element.kind = "text"
    return element


def page_blocks(page: str) -> list[Block]:
    """The blocks of a page in its order; markup, comments and embedded code are gone."""
    blocks: list[Block] = []
    stack: list[Element] = []
    enclosing: list[list[tuple[Element, bool]]] = []  # furniture around each block
    parts: list[str] = []
    state = {"linked": 0, "links": 0, "regions": 0, "breaks": 0}

    def close_block() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                regions = [e.region for e in stack if e.kind == "text"]
                around = [(e, e.holds) for e in stack if e.kind == "furniture" and not e.released]
                region = regions[-1] if regions else 0
                blocks.append(Block(text, state["linked"], region, bool(regions), bool(around)))
                enclosing.append(around)
            parts.clear()
        state["linked"] = state["breaks"] = 0

    def add(text: str) -> None:
        parts.append(text)
        if not text.isspace():
            state["breaks"] = 0
            if state["links"]:
                state["linked"] += len(" ".join(html.unescape(text).split()))

    def open_element(name: str, rest: str) -> None:
        if name in _BLOCKS:
            close_block()
            while stack and stack[-1].name in ("p", *_INLINE_CONTAINERS):
                stack.pop()
            if name in ("li", "dt", "dd", "td", "th", "tr") and stack and stack[-1].name == name:
                stack.pop()
            state["links"] = 0
        if name in _TEXT_REGIONS:
            # An article ends what was left open before it.
            for element in reversed(stack):
                if element.kind != "furniture" or element.name in _FURNITURE:
                    break
                element.released = True
        element = _opened(name, rest, any(e.kind == "text" for e in stack))
        if element.kind == "text":
            state["regions"] += 1
            for outer in stack:
                outer.holds = True
        element.region = state["regions"]
        if name in _BLOCKS or element.kind:
            if element.kind and name not in _BLOCKS:
                close_block()
            stack.append(element)

    def close_element(name: str) -> None:
        names = [e.name for e in stack]
        if name in names:
            close_block()
            del stack[len(names) - 1 - names[::-1].index(name):]
        elif name in _BLOCKS:
            close_block()

    at = 0
    while at < len(page):
        match = _TAG.search(page, at)
        if match is None:
            add(page[at:])
            break
        if match.start() > at:
            add(page[at : match.start()])
        at = match.end()
        name = (match["name"] or "").lower()
        if not name:
            continue
        if match["end"]:
            if name == "a":
                state["links"] = 0
            close_element(name)
        elif name in _SKIPPED:
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif name == "br":
            add(" ")
            state["breaks"] += 1
            if state["breaks"] > 1:
                close_block()
        elif name == "a":
            state["links"] = 1
            open_element(name, match["rest"])
        elif name in _VOID:
            if name == "hr":
                close_block()
        else:
            open_element(name, match["rest"])
    close_block()
    _release(blocks, enclosing)
    return blocks


def _release(blocks: list[Block], enclosing: list[list[tuple[Element, bool]]]) -> None:
    """Takes blocks out of furniture that encloses the page's text.

    That is furniture whose text regions hold at least half as much as the largest region outside,
    the largest first, and then a form or a weak name around more than half of the text.
    """
    if not any(e.wraps for around in enclosing for e, _ in around):
        return
    plain = [len(b.text) - b.linked for b in blocks]
    wrapping = [all(e.wraps for e, _ in around) for around in enclosing]
    caught: dict[Element, int] = {}
    regions: dict[int, int] = {}
    for block, around, n, loose in zip(blocks, enclosing, plain, wrapping):
        if block.in_text and not around:
            regions[block.region] = regions.get(block.region, 0) + n
        if block.in_text and loose:
            for element, held in around:
                if held:
                    caught[element] = caught.get(element, 0) + n
    largest = max(regions.values(), default=0)
    for element, n in sorted(caught.items(), key=lambda item: -item[1]):
        if 2 * n > largest:
            element.released = True
            largest = max(largest, n)
    total = sum(n for n, loose in zip(plain, wrapping) if loose)
    weak: dict[Element, int] = {}
    for around, n, loose in zip(enclosing, plain, wrapping):
        for element, _ in around if loose else ():
            if element.weak and not element.released:
                weak[element] = weak.get(element, 0) + n
    most = {element for element, n in weak.items() if 2 * n > total}
    for block, around in zip(blocks, enclosing):
        # Before its first region a named element keeps what it names; a form does not.
        block.furniture = any(
            not (e in most or (e.released and (held or e.name == "form"))) for e, held in around
        )


def classify(blocks: list[Block], rules: BlockRules = BlockRules()) -> None:
    """Labels every block good or bad."""
    running = [b for b in blocks if not _set_apart(b, rules) and len(b.text) >= rules.short]
    counted = {}
    if not all(b.in_text for b in running):  # inside a text, stop words decide nothing
        counted = {id(b): _stop_words(b.text) for b in running}
    stops, words = (sum(x) for x in zip((0, 0), *counted.values()))
    known = stops >= rules.stop_low * words
    for block in blocks:
        block.label = "bad" if _set_apart(block, rules) else "open"
    for block in running:
        if block.in_text:
            block.label = "good"
            continue
        stops, words = counted[id(block)]
        density = stops / words
        if not known or density >= rules.stop_high or _other_script(block.text):
            block.label = "good" if len(block.text) >= rules.long else "medium"
        elif density < rules.stop_low:
            block.label = "bad"
    # Medium blocks count as decided where the regions do not hold the page's text.
    inside = sum(len(b.text) - b.linked for b in blocks if b.in_text and not b.furniture)
    medium = [b for b in blocks if b.label == "medium"]
    seeds = sum(len(b.text) for b in medium) > inside
    for block in medium:
        block.label = "good" if seeds else "open"
    if not inside and all(b.label != "good" for b in blocks):
        for block in blocks:
            if block.label == "open" and len(block.text) >= rules.short:
                block.label = "good"
    for i, label in _inherited(blocks).items():
        blocks[i].label = label


def _stop_words(text: str) -> tuple[int, int]:
    """Stop words and words of a text."""
    words = [_WORD_EDGES.sub("", w).lower() for w in text.split()]
    return sum(w in STOP_WORDS for w in words), len(words)


def _other_script(text: str) -> bool:
    """Whether most letters are none that the languages of the stop words use."""
    if text.isascii():
        return False
    letters = [c for c in text if c.isalpha()]
    return 2 * sum(c > "\u024f" for c in letters) > len(letters)


def _set_apart(block: Block, rules: BlockRules) -> bool:
    """Furniture, mostly links, or a copyright line outside a text."""
    text = block.text
    if block.furniture or block.linked > rules.link_density * len(text):
        return True
    return not block.in_text and ("©" in text or text.lower().startswith("copyright"))


def _inherited(blocks: list[Block]) -> dict[int, str]:
    """The labels of open blocks, from the nearest decided neighbours; inside a text, those of the
    text alone.

    The edges of a text count as good: there only a block between two bad ones is bad. Elsewhere
    the nearer neighbour decides, and bad if both are as near. One sweep from either end finds the
    neighbours of all blocks.
    """
    before, after = _neighbours(blocks, range(len(blocks))), _neighbours(blocks, range(len(blocks))[::-1])
    own = {b.region for b in blocks if b.label != "open" and not b.furniture}
    labels = {}
    for i in before:
        block = blocks[i]
        if block.in_text:
            ends = [side[i][0].get(block.region, "good") for side in (before, after)]
            labels[i] = "bad" if ends == ["bad", "bad"] else "good"
            continue
        at = 1 if block.region in own else 2
        near = {
            label: min(abs(i - side[i][at].get(label, 2 * len(blocks) + i)) for side in (before, after))
            for label in ("good", "bad")
        }
        labels[i] = "good" if near["good"] < near["bad"] else "bad"
    return labels


def _neighbours(blocks: list[Block], order: range) -> dict[int, tuple[dict, dict, dict]]:
    """Per open block what lies before it in ``order``: the last label of its region, and the last
    place of each label in its region and anywhere."""
    last_label, in_region, anywhere, found = {}, {}, {}, {}
    for i in order:
        block = blocks[i]
        if block.label == "open":
            region = block.region
            known = {region: last_label[region]} if region in last_label else {}
            found[i] = known, dict(in_region.get(region, {})), dict(anywhere)
            continue
        anywhere[block.label] = i
        if not block.furniture:
            last_label[block.region] = block.label
            in_region.setdefault(block.region, {})[block.label] = i
    return found


def main_text(page: str, rules: BlockRules = BlockRules()) -> str:
    blocks = page_blocks(page)
    classify(blocks, rules)
    return "\n\n".join(b.text for b in blocks if b.label == "good")


def extract_text(
    pages: DataFrame, html_column: str = "html", rules: BlockRules = BlockRules()
) -> DataFrame:
    """The rows of ``pages`` with text in place of the HTML column, and n_chars (code points).

    White space inside a block becomes one space, blocks are joined by an empty line. A null or
    empty page and a page without main text have an empty text. Repeated rows are each extracted.
    Columns named text or n_chars are replaced.
    """
    source = pages.withColumn("__page", raw_text(html_column)).drop("text", "n_chars", html_column)
    schema = T.StructType(
        [f for f in source.schema.fields if f.name != "__page"]
        + [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "__page"):
            texts = [
                main_text(page.decode("utf-8"), rules)
                for page in batch.column("__page").to_pylist()
            ]
            columns = {n: batch.column(n) for n in batch.schema.names if n != "__page"}
            columns["text"] = pa.array(texts, pa.string())
            columns["n_chars"] = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_pydict(columns)

    return source.mapInArrow(work, schema)
