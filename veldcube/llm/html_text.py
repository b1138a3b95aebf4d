"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from html import unescape
from math import log1p

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements by what they mean for text.
BLOCKS = frozenset(
    "html body div p article section main h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th "
    "blockquote pre figure figcaption header footer nav aside form fieldset address details summary hgroup center menu "
    "head title search dialog noscript template iframe object select button svg canvas video audio".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea xmp noembed noframes".split())
NEVER = frozenset(
    "head title nav footer aside form fieldset menu search dialog noscript template iframe object select button svg canvas "
    "video audio".split())
ENDS_PARAGRAPH = BLOCKS - {"html", "body", "button", "svg", "iframe", "object", "canvas", "video", "audio", "select"}
#: A new element of these ends an open one of the named kinds, up to the boundary.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
#: Words of classes, ids and roles that mark what is not the article.
NOISE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation "
    "breadcrumb breadcrumbs sidebar footer masthead comment comments disqus reply replies respond cookie cookies consent "
    "gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social "
    "related recommended widget copyright pagination pager toolbar contentinfo complementary search hidden".split())
HEADS = frozenset({"header", "topbar"})
ROOTS = frozenset({"article", "main"})
PUNCTUATION = re.compile(r"[.,;:!?。、，！？：；…]")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Share of a path's score that is its own; its parent has that share of the rest, and so on upwards.
OWN = 0.4
#: Share of the best path's score that a content path has at least, inside of an article element and elsewhere.
THRESHOLD = 0.05
#: Share of link text from which a path inside an article element is left out.
LINKED = 0.7

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z](?:[^\"'>]|\"[^\"]*\"|'[^']*')*>|</?[a-zA-Z][^>]*(?:>|\Z)", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
#: One attribute after the other, so that words in a value are not taken for names.
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
#: First words of classes that say what a wrapper holds, not what it is.
HOLDS = frozenset("has have with without no not is".split())
#: A word of noise that is none before another word.
FINE_BEFORE = {"related": {"work", "works", "literature", "research"}}


def noise_words(value: str) -> set[str]:
    """Words of the tokens of a class, id or role that may mark noise."""
    found: set[str] = set()
    for token in value.split():
        words = [w.lower() for w in _WORD.findall(token)]
        if words and words[0] not in HOLDS:
            found.update(w for w, after in zip(words, [*words[1:], ""], strict=True) if after not in FINE_BEFORE.get(w, ()))
    return found


class Element:
    __slots__ = ("block", "label", "noise", "tag")

    def __init__(self, tag: str, markup: str):
        words: set[str] = set()
        hidden, label = False, ""
        if len(markup) > len(tag) + 2:
            for name, *values in _ATTRIBUTE.findall(markup, len(tag) + 1):
                name, value = name.lower(), values[0] or values[1] or values[2]
                if name in ("class", "id", "role"):
                    words |= noise_words(value)
                    label += "." + value if name == "class" else ""
                elif name == "style":
                    hidden |= "display:none" in value.replace(" ", "").lower()
                elif name in ("hidden", "aria-hidden"):
                    hidden |= value.lower() != "false"
        self.tag, self.label, self.block = tag, tag + label, tag in BLOCKS
        self.noise = 2 if hidden or tag in NEVER else 1 if words & NOISE or words & HEADS or tag == "header" else 0
        if self.noise == 1 and not words & NOISE:
            self.noise = 3  # a header, which belongs to the article inside of one


def blocks(html: str) -> list[tuple[tuple[Element, ...], str, int]]:
    """Text blocks in page order: the open elements, the text and its characters inside links."""
    found: list[tuple[tuple[Element, ...], str, int]] = []
    stack: list[Element] = []
    pieces: list[str] = []
    linked, in_link = 0, False
    muted = False  # inside inline noise, whose block goes on behind it
    open_tags: Counter[str] = Counter()
    inline = 0  # open elements that are no blocks

    def push(element: Element) -> None:
        nonlocal inline
        stack.append(element)
        open_tags[element.tag] += 1
        inline += not element.block

    def cut(k: int) -> None:
        nonlocal inline
        for x in stack[k:]:
            open_tags[x.tag] -= 1
            inline -= not x.block
        del stack[k:]

    def flush() -> None:
        nonlocal linked, in_link
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                found.append((tuple(stack), text, min(linked, len(text))))
            pieces.clear()
        linked, in_link = 0, False

    at, end = 0, len(html)
    for match in iter(lambda: _TOKEN.search(html, at), None):
        if match.start() > at and not muted:
            pieces.append(html[at : match.start()])
            linked += (match.start() - at) * in_link
        at = match.end()
        markup = match[0]
        named = _NAME.match(markup)
        if not named:
            continue
        tag = named[1].lower()
        if markup[1] == "/":
            if tag == "a":
                in_link = False
            for k in range(len(stack) - 1, -1, -1) if open_tags[tag] else ():
                if stack[k].tag == tag:
                    if any(x.block for x in stack[k:]):
                        flush()
                    cut(k)
                    muted = inline > 0
                    break
            continue
        if tag in RAW:
            shut = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(html, at)
            at = shut.end() if shut else end
            continue
        if tag in VOID:
            if tag in ("br", "hr", "img", "wbr"):
                pieces.append("" if tag == "wbr" else " ")
            continue
        if tag == "a":
            in_link = True
        if tag not in BLOCKS:
            if len(markup) > len(tag) + 8 and not markup.endswith("/>"):
                element = Element(tag, markup)
                if element.noise:
                    push(element)
                    muted = True
            continue
        flush()
        if tag in ENDS_PARAGRAPH and open_tags["p"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag == "p":
                    cut(k)
                    break
        if tag in SIBLINGS:
            ended, boundary = SIBLINGS[tag]
            for k in range(len(stack) - 1, -1, -1) if any(open_tags[x] for x in ended) else ():
                if stack[k].tag in boundary:
                    break
                if stack[k].tag in ended:
                    cut(k)
        if not markup.endswith("/>"):
            push(Element(tag, markup))
        muted = inline > 0
    if not muted:
        pieces.append(html[at:])
    flush()
    return found


def _wrapped(found: list[tuple[tuple[Element, ...], str, int]]) -> int:
    """How many elements all blocks lie in."""
    first, common = found[0][0], len(found[0][0])
    for path, _, _ in found:
        common = next((k for k, (a, b) in enumerate(zip(first[:common], path, strict=False)) if a is not b), min(common, len(path)))
    return common


def _is_noise(path: tuple[Element, ...], inside: int, spared: int = 0) -> bool:
    """Whether an element of a block's path rules it out; `inside` is where the article begins in it. Words do not
    count against the `spared` outermost elements."""
    for k, element in enumerate(path):
        if element.noise == 2 or (element.noise == 1 and k >= max(inside, spared) and element.tag not in ("html", "body")):
            return True
        if element.noise == 3 and (inside == 0 or k < inside) and not any(x.tag in ROOTS for x in path[:k]):
            return True
    return False


def main_text(html: str) -> str:
    """The blocks of content paths, joined by an empty line.

    Blocks that lie in navigation, adverts and the like are left out. Where a page has an article or main
    element with text, only what lies inside counts. On every page the text length and punctuation of the blocks of
    each path of tags give a ratio, and paths below a share of the best are left out; inside an article, so are paths
    that are mostly links, while headings stay in any case. The ratio grows with
    the logarithm of the length, so that no block, however long, rules out the others. Ratios and
    shares of links are smoothed with those of all ancestors, up to the article element or below body.
    """
    found = blocks(html)
    rooted = [next((k + 1 for k in range(len(p) - 1, -1, -1) if p[k].tag in ROOTS), 0) for p, _, _ in found]
    kept = [(p, t, n, inside) for (p, t, n), inside in zip(found, rooted, strict=True) if inside and not _is_noise(p, inside)]
    in_article = bool(kept)
    if not kept:
        kept = [(p, t, n, 0) for p, t, n in found if not _is_noise(p, 0)]
    if not kept and found:
        # Everything lies in one wrapper: it is no noise if it holds noise and something else.
        spared = _wrapped(found)
        kept = [(p, t, n, 0) for p, t, n in found if not _is_noise(p, 0, spared)]
        kept = kept if len(kept) < len(found) else []
    if not kept:
        return ""
    sums: dict[tuple[str, int], list[int]] = {}
    chains: dict[int, list[tuple[str, int]]] = {}
    known: dict[tuple[int, str], int] = {}  # paths by the path above and the last label
    paths = []
    for path, text, linked, inside in kept:
        above = [-1]
        for x in path:
            if x.block:
                above.append(known.setdefault((above[-1], x.label), len(known)))
        labels = above[-1]
        paths.append(labels)
        # Paths from the block's own to the article element or, without one, to that below body.
        least = sum(x.block for x in path[:inside]) if inside else 3
        chain = chains.get(labels) or [("", labels), *(("*", above[depth]) for depth in range(len(above) - 2, least - 1, -1))]
        chains[labels] = chain
        marks = len(PUNCTUATION.findall(text))
        for key in chain:
            entry = sums.setdefault(key, [0, 0, 0, 0])
            for k, x in enumerate((len(text), marks, 1, linked)):
                entry[k] += x

    def density(key: tuple[str, int]) -> float:
        length, marks, n, linked = sums[key]
        return log1p(length / n) * (1 + min(1, 25 * marks / length)) * (1 - 0.9 * linked / length)

    def link_share(key: tuple[str, int]) -> float:
        return sums[key][3] / sums[key][0]

    def smoothed(value: Callable[[tuple[str, int]], float], chain: list[tuple[str, int]]) -> float:
        total, left = 0.0, 1.0
        for key in chain[:-1]:
            total += left * OWN * value(key)
            left *= 1 - OWN
        return total + left * value(chain[-1])

    scores = {labels: smoothed(density, chain) for labels, chain in chains.items()}
    best = max(scores.values())
    stays = {labels: score >= THRESHOLD * best for labels, score in scores.items()}
    if in_article:
        mostly_text = {labels: smoothed(link_share, chain) < LINKED for labels, chain in chains.items()}
        if any(mostly_text.values()):  # else an article that is links throughout
            stays = {labels: stays[labels] and text for labels, text in mostly_text.items()}
    return "\n\n".join(
        text for labels, (path, text, _, _) in zip(paths, kept, strict=True)
        if stays[labels] or (in_article and any(x.tag in HEADINGS for x in path)))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Main text of every page: page_id, url, text and n_chars.

    Null and empty html and pages without an article give an empty text. Pages may repeat, ids and
    urls may be null. Other columns are not read. Each page is read whole and on its own.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                piece = batch.slice(at, 500)
                texts = [main_text(x.as_py() or "") for x in piece.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
