"""The main text of web pages.

Method: tag-path ratios. The text of a page is split at block elements, and every block
belongs to the path of tags from the root to it. Per path, text length and punctuation
are aggregated over its blocks; a path's own ratios are fused by multiplication
with those smoothed along the page, and the paths above a threshold are content. Only if
the best path lies in an article or main element, what is outside of such is left out. Blocks inside the container
of the content belong to the same article, however short they are: its nearest article or
main element, else the lowest element around all content paths.

What is never main text by its element, role or a hidden state is left out while parsing,
but for a header in an article or main element. A class or id leaves out a block element,
whatever it scores, if all words of one of its names are hints; mere words of longer names
say nothing, and headings and inline elements are never left out by a name. A main element
stays inside of such a name. A form is left out unless the best path of the page lies in it.
Where these rules leave nothing, the ratios alone decide. Pages are taken one by one where
they are read, so no page meets another and nothing is shuffled.

Defined cases: NULL and empty html give an empty text; a page without markup is one
block. Unclosed elements end with their parent, and stray end tags are ignored. NULL
ids and urls are passed on, and repeated rows give repeated results.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements of HTML by what they do here.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = set(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody"
    " tfoot tr td th caption blockquote pre figure figcaption address center details summary"
    " fieldset legend hr hgroup header footer nav aside form menu dialog search".split()
)
LEFT_OUT = set(
    "head script style noscript template nav header footer aside button select option"
    " textarea iframe svg canvas object audio video dialog menu search noembed noframes xmp"
    " title".split()
)
ROLES = set("navigation banner contentinfo complementary search dialog alert menu form".split())
HINTS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner"
    " cookie cookies consent gdpr notice notices alert sidebar side menu nav navbar navigation"
    " breadcrumb breadcrumbs footer header masthead topbar toolbar share sharing social related"
    " recommended newsletter subscribe subscription signup login search popup modal overlay widget"
    " pagination pager comment comments disqus respond reply replies".split()
)
# Words that stand beside hints in names of page parts and say nothing about a topic.
PLACES = set(
    "site page main top bottom left right container wrapper wrap box area block bar inner outer"
    " list section slot unit holder zone panel form thread item body".split()
)
HEADINGS = set("h1 h2 h3 h4 h5 h6 hgroup caption figcaption legend summary".split())
# A start tag of the first kind ends an open element of the second.
ENDS = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
SCOPES = set("html body main article section div ul ol dl table td th blockquote form".split())
ROOMS = {"article", "main"}
# What is but a part of the element around it.
PARTS = set("section blockquote ul ol li dl dt dd p pre figure details h1 h2 h3 h4 h5 h6".split())
PUNCTUATION = re.compile(r"[.,;:!?…、。，；：！？¿¡]")
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
INVISIBLE = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)


@dataclass(frozen=True)
class Ratios:
    """Settings: reach of the smoothing in blocks, the share of the best score needed, and
    what an article or main element counts for in the choice of the best path."""

    radius: int = 2
    threshold: float = 0.25
    room: float = 2.0


def _hinted(value: str) -> bool:
    """Whether one of the names in a class or id consists of hints, but for words of place."""
    for name in value.split():
        words = set(re.split(r"[\W\d_]+", name)) - {""}
        if words & HINTS and words <= HINTS | PLACES:
            return True
    return False


def _judged(tag: str, attributes: str) -> tuple[bool, bool, str]:
    """Whether an element is left out, whether its name says so, and its name in paths."""
    if tag in LEFT_OUT:
        return True, False, tag
    name, drop, hint = tag, False, False
    for kind, *values in ATTRIBUTE.findall(attributes) if attributes else ():
        kind, value = kind.lower(), next(filter(None, values), "").strip().lower()
        if kind == "role":
            drop |= value in ROLES
        elif kind == "hidden":
            drop |= value != "until-found"
        elif kind == "style":
            drop |= bool(INVISIBLE.search(value))
        elif kind in ("class", "id"):
            name += "." + value
            hint |= _hinted(value)
    exempt = tag in ("html", "body", *ROOMS)
    return drop and not exempt, hint and not exempt and tag in BLOCKS - HEADINGS, name


def blocks(html: str) -> Iterator[tuple[tuple[str, ...], str, bool]]:
    """``(path, text, hinted)`` of the blocks in page order.

    ``hinted`` says whether the name of the block or of an element around it says that it
    is no main text.
    """
    stack: list[tuple[str, str, bool, bool]] = []  # tag, name in paths, left out, hinted
    parts: list[str] = []
    at, end = 0, len(html)

    def block():
        text = " ".join(unescape("".join(parts)).split())
        parts.clear()
        if text:
            names = tuple(name for tag, name, *_ in stack if tag in BLOCKS)
            yield names, text, bool(stack) and stack[-1][3]

    def leave(place: int):
        """End all elements from ``place`` on, and the block if one of them is a block."""
        if any(tag in BLOCKS for tag, *_ in stack[place:]):
            yield from block()
        del stack[place:]

    while at < end:
        start = html.find("<", at)
        start = end if start < 0 else start
        if start > at and not (stack and stack[-1][2]):
            parts.append(html[at:start])
        if start == end:
            break
        if html.startswith("<!--", start):
            stop = html.find("-->", start + 4)
            at = end if stop < 0 else stop + 3
            continue
        if html.startswith(("<!", "<?"), start):
            stop = html.find(">", start)
            at = end if stop < 0 else stop + 1
            continue
        found = TAG.match(html, start)
        if not found:
            # No tag at all, or one with an open quote, which then ends at the next bracket.
            stop = html.find(">", start) if re.match(r"</?[a-zA-Z]", html[start : start + 3]) else -1
            if stop < 0:
                if not (stack and stack[-1][2]):
                    parts.append("<")
                at = start + 1
            else:
                at = stop + 1
            continue
        at = found.end()
        closing, tag, attributes = found[1], found[2].lower(), found[3]
        if closing:
            place = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
            if place is not None:
                yield from leave(place)
            elif tag in BLOCKS:
                yield from block()
            continue
        if tag in BLOCKS:
            closes = {"p"} | ENDS.get(tag, set())
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in closes:
                    yield from leave(k)
                    break
                if stack[k][0] in SCOPES:
                    break
            yield from block()
        if tag in VOID:
            parts.append(" ")
            continue
        drop, hint, name = _judged(tag, attributes)
        if tag == "header" and any(outer in ROOMS for outer, *_ in stack):
            drop = False
        if stack:
            drop, hint = drop or stack[-1][2], (hint or stack[-1][3]) and tag != "main"
        if tag in RAW:
            stop = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)
            at = stop.end() if stop else end
            continue
        if attributes.endswith("/") and tag not in BLOCKS:
            continue
        stack.append((tag, name, drop, hint))
    yield from block()


def _tag(name: str) -> str:
    return name.partition(".")[0]


def _in_room(path: tuple[str, ...]) -> bool:
    """Whether an article or main element is around the block."""
    return any(_tag(name) in ROOMS for name in path)


def _scores(found: list[tuple[tuple[str, ...], str, bool]], ratios: Ratios) -> dict[tuple, float]:
    """The score of every path."""
    # Length and punctuation per path, as means over its blocks.
    totals: dict[tuple, list[int]] = defaultdict(lambda: [0, 0, 0])
    for path, text, _ in found:
        total = totals[path]
        total[0] += 1
        total[1] += len(text)
        total[2] += len(PUNCTUATION.findall(text))
    ratio = np.array([[totals[p][1] / totals[p][0], totals[p][2] / totals[p][0]] for p, _, _ in found])
    reach = np.arange(-ratios.radius, ratios.radius + 1)
    kernel = np.exp(-(reach**2) / 2.0)
    spread = lambda x: np.convolve(x, kernel, "full")[ratios.radius : ratios.radius + len(found)]
    smooth = np.stack([spread(ratio[:, k]) / spread(np.ones(len(found))) for k in (0, 1)])
    fused = np.sqrt(ratio[:, 0] * smooth[0]) * (1 + np.sqrt(ratio[:, 1] * smooth[1]))
    # A path scores as its blocks do on average, weighted by how much text they hold.
    score: dict[tuple, float] = defaultdict(float)
    for (path, text, _), value in zip(found, fused):
        score[path] += value * len(text) / totals[path][1]
    return score


def _in_form(path: tuple[str, ...]) -> bool:
    return any(_tag(name) == "form" for name in path)


def _candidates(found: list, ratios: Ratios) -> list:
    """The blocks that may be content: all that are not left out, or all if that is none."""
    plain = [one for one in found if not one[2]]
    if any(_in_form(path) for path, *_ in plain):
        score = _scores(plain, ratios)
        if not _in_form(max(score, key=score.get)):
            plain = [one for one in plain if not _in_form(one[0])]
    return plain or found


def _containers(content: set[tuple[str, ...]]) -> set[tuple[str, ...]]:
    """The paths of the elements that the content lies in.

    They are the nearest article or main elements, where there are such; for all the rest,
    the one element that is around it, or what that is but a part of.
    """
    found, rest = set(), []
    for path in content:
        room = max((k + 1 for k, name in enumerate(path) if _tag(name) in ROOMS), default=0)
        if room:
            found.add(path[:room])
        else:
            rest.append(path[:-1])
    if rest:
        common = commonprefix(rest)
        while common and _tag(common[-1]) in PARTS:
            common = common[:-1]
        found.add(tuple(common))
    return found


def _holds(container: tuple[str, ...], path: tuple[str, ...], groups: set[tuple[str, ...]]) -> bool:
    """Whether a block is kept for the container: all in it, and a title beside its way.

    Where that is the whole page, a plain group right in it is kept only if it is one of
    ``groups``, those with content.
    """
    if path[: len(container)] != container:
        return _in_room(path) and _tag(path[-1]) == "h1" and container[: len(path) - 1] == path[:-1]
    depth = len(container)
    if depth and _tag(container[-1]) not in ("html", "body"):
        return True
    while depth < len(path) and _tag(path[depth]) in ("html", "body"):
        depth += 1
    return depth == len(path) or _tag(path[depth]) not in ("div", "center") or path[: depth + 1] in groups


def content_blocks(html: str, ratios: Ratios) -> list[str]:
    """The texts of the blocks that are content, in page order."""
    found = list(blocks(html))
    if not found:
        return []
    found = _candidates(found, ratios)
    score = _scores(found, ratios)
    strongest = max(score, key=lambda path: score[path] * (ratios.room if _in_room(path) else 1.0))
    best = score[strongest]
    if _in_room(strongest):
        found = [one for one in found if _in_room(one[0])]
        score = {path: score[path] for path, _, _ in found}
    content = {path for path, value in score.items() if value >= ratios.threshold * best}
    containers = _containers(content)
    groups = {path[:k] for path in content for k in range(1, len(path) + 1)}
    inside = lambda path: any(_holds(c, path, groups) for c in containers)
    return [text for path, text, _ in found if path in content or inside(path)]


def extract(
    df: DataFrame,
    html: str = "html",
    page_id: str = "page_id",
    url: str = "url",
    ratios: Ratios = Ratios(),
) -> DataFrame:
    """One row per row of ``df``: ``page_id``, ``url``, ``text``, ``n_chars``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = ["\n".join(content_blocks(page or "", ratios)) for page in part.column(2).to_pylist()]
                yield pa.record_batch(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(texts, pa.string()),
                        pa.array(map(len, texts), pa.int64()),
                    ],
                    names=["page_id", "url", "text", "n_chars"],
                )

    rows = df.select(F.col(page_id).cast("bigint"), F.col(url), F.col(html))
    return rows.mapInArrow(run, "page_id BIGINT, url STRING, text STRING, n_chars BIGINT")
