"""Main text of web pages: a minimum cut separates content blocks from boilerplate.

A page is read into blocks of text with their place in the document tree. A linear classifier scores each
block (container, names, links, length, punctuation); the score is its capacity to the content or to the
boilerplate terminal. Blocks next to each other, and neighbours among the children of one element, are tied
by smoothness edges that are stronger the closer they are in the tree. The maximum flow between the
terminals gives the labelling of least total cost.

Class and id names inside an article are weighed by how much of its text the element holds, so that a thread of
comments or a notice goes and a section that is most of the article stays.

Defined results: null or empty html, and pages without content, give an empty text; unclosed, misnested
and cut-off markup is read as far as it goes; repeated rows give the same text; other columns pass through.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",  # a quote that is never closed
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

# Elements of HTML by what they mean for reading order.
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody tfoot thead "
    "title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup.
RAW = frozenset("script style textarea iframe".split())
#: What a form control with options holds up to its end tag.
_OPTIONS = re.compile(r"(?:[^<]++|</?(?:option|optgroup|hr)\b[^>]*+>)*+</select\b[^>]*>", re.I)
#: How much the text of controls and of what stands in for other media counts as boilerplate.
EMBEDDED = {
    "button": 1.0, "select": 1.0, "template": 1.0, "video": 0.85, "audio": 0.85, "canvas": 0.85, "svg": 0.5, "noscript": 0.5, "object": 0.5,
}
CELL = frozenset("br td th img wbr".split())
CLOSES_P = BLOCK - {"html", "head", "body", "option", "legend", "summary", "title", "tr", "tbody", "thead", "tfoot"}
# Elements, roles and name parts that mark boilerplate.
APART = frozenset("nav footer aside form head menu dialog".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads advert advertisement adverts sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead comment comments reply replies "
    "disqus share sharing social related recommended subscribe subscription newsletter signup login popup modal overlay "
    "widget pagination pager copyright disclaimer toolbar form search skip responses feedback bio".split()
)
# Those of NAMES that are also what articles are about, and the words that go with names of places.
TOPICS = frozenset(
    "promotion banner cookie cookies consent notice menu navigation footer header comment reply replies share sharing social "
    "related recommended subscription signup login modal overlay widget copyright disclaimer form search skip "
    "responses feedback bio".split()
)
# Those of TOPICS that name what readers write.
READERS = frozenset("comment reply replies responses feedback".split())
LAYOUT = frozenset(
    "area bar blog block body box bottom btn button buttons card cards container content entry form global group holder icon "
    "icons inner item items left line link links list main outer page panel post posts article articles stories right row "
    "section site slot story text to top unit wrap wrapper user users reader readers author authors thread".split()
)
HEADED = frozenset("article entry post section story".split())
#: How much a name counts by (only layout words beside it, only topics, is an id, inside an article or main element).
NAMED = {
    (True, False, False, False): 1.0, (True, False, False, True): 1.0, (True, False, True, False): 1.0, (True, False, True, True): 1.0,
    (True, True, False, False): 1.0, (True, True, False, True): 0.6, (True, True, True, False): 0.6, (True, True, True, True): 0.15,
    (False, False, False, False): 0.8, (False, False, False, True): 0.6, (False, True, False, False): 0.5, (False, True, False, True): 0.25,
}
#: Inside an article, an element whose class is a topic alone counts in full unless it holds this share of the article's text.
MOST_OF_IT, MOST_OF_IT_READERS = 0.5, 0.9
#: How much a name counts among other words of an id, which may be the slug of a heading, and a class of headings and paragraphs.
SLUG = 0.15

# The classifier: what each feature adds to the score (positive: content).
WEIGHTS = {
    "bias": -0.6, "apart": -12.0, "named": -6.5, "embedded": -6.0, "main": 3.0, "paragraph": 1.2, "heading": 0.4, "item": -0.4,
    "words": 0.9, "sentence": 0.8, "links": -4.0,
}
#: The feature ``main`` of all blocks of a page that has neither an article nor a main element.
NO_MAIN = 0.4
#: Smoothness of blocks in reading order and of neighbouring children of one element.
ADJACENT, SIBLING = 0.8, 0.5
#: Capacities are whole numbers of this fraction, so that cuts are exact.
UNIT = 1000


@dataclass
class Block:
    text: str
    path: tuple[int, ...]
    tag: str
    apart: bool
    named: float
    main: float
    linked: int
    embedded: float
    score: float = field(default=0.0)


def _marks_apart(tag: str, attributes: str, in_main: bool) -> bool:
    if tag in APART or (tag == "header" and not in_main):
        return True
    if not attributes or tag in ("html", "body"):
        return False
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "role" and value.lower() in ROLES:
            return True
        if name == "style" and "display:none" in value.replace(" ", "").lower():
            return True
    return False


def _named(tag: str, attributes: str, in_main: bool) -> float:
    """How much the classes and the id of an element say that it is boilerplate, from 0 to 1."""
    if not attributes or tag in ("html", "body", "article", "main"):
        return 0.0
    most = 0.0
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name not in ("class", "id"):
            continue
        for token in value.split():
            words = {x.lower() for x in _NAME.findall(token) if not x.isdigit()}
            names = words & NAMES
            if in_main or words & HEADED:
                names.discard("header")
            if not names:
                continue
            if tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6"):
                most = max(most, SLUG if name == "class" else 0.0)
            else:
                kind = (words <= NAMES | LAYOUT, names <= TOPICS, name == "id", in_main)
                most = max(most, NAMED.get(kind, SLUG))
    return most


def _aside(tag: str, attributes: str) -> float:
    """For an element inside an article: the share of its text below which the names of the element count in full, or 0."""
    if not attributes or tag in ("html", "body", "article", "main", "p", "h1", "h2", "h3", "h4", "h5", "h6"):
        return 0.0
    most = 0.0
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        if name.lower() not in ("class", "id"):
            continue
        for token in (a or b or c).split():
            words = {x.lower() for x in _NAME.findall(token) if not x.isdigit()}
            names = (words & NAMES) - {"header"}
            if names and words <= NAMES | LAYOUT:
                if names & READERS or not names <= TOPICS:
                    most = max(most, MOST_OF_IT_READERS)
                elif name.lower() == "class":
                    most = max(most, MOST_OF_IT)
    return most


def _self_closing(attributes: str) -> bool:
    """A slash ends the tag and is no part of a value without quotes."""
    if not attributes.endswith("/"):
        return False
    word = re.split(r"[\s\"']", attributes)[-1]
    return "=" not in word and not attributes[: len(attributes) - len(word)].rstrip().endswith("=")


def blocks(page: str | None) -> list[Block]:
    """The page's blocks of text in page order: decoded, white space folded, empty ones left out."""
    page = page or ""
    found: list[Block] = []
    # open elements: tag, number, is apart, is main, how much names count
    stack: list[tuple[str, int, bool, bool, float]] = [("", 0, False, False, 0.0)]
    anywhere = False
    count, text, linked, links = 0, [], 0, 0
    # open embedded elements by number; the numbers of those with an end tag; their characters in this and in each block
    embeds: dict[int, str] = {}
    ended: dict[int, str] = {}
    inside: dict[int, int] = {}
    held: list[dict[int, int]] = []
    # elements inside an article whose names count in full below a share of its text
    asides: dict[int, float] = {}

    def flush() -> None:
        nonlocal linked
        joined = " ".join("".join(text).split())
        if joined:
            _, _, apart, main, named = stack[-1]
            path = tuple(e[1] for e in stack)
            tag = next((e[0] for e in reversed(stack) if e[0] in BLOCK), "")
            found.append(Block(joined, path, tag, apart, named, main, min(linked, len(joined)), 0.0))
            held.append(dict(inside))
        text.clear()
        inside.clear()
        linked = 0

    def close(tag: str) -> None:
        nonlocal links
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] == tag:
                if tag in BLOCK or any(e[0] in BLOCK for e in stack[i:]):
                    flush()
                links -= sum(e[0] == "a" for e in stack[i:])
                if tag in EMBEDDED:
                    ended[stack[i][1]] = tag
                    text.append(" ")
                while embeds and next(reversed(embeds)) >= stack[i][1]:
                    embeds.popitem()
                del stack[i:]
                return

    def add(chunk: str) -> None:
        nonlocal linked
        chunk = html.unescape(chunk) if "&" in chunk else chunk
        text.append(chunk)
        if links:
            linked += len(chunk)
        if embeds and not chunk.isspace():
            number = next(reversed(embeds))
            inside[number] = inside.get(number, 0) + len(chunk)

    at = 0
    while at < len(page):
        m = _MARKUP.search(page, at)
        if m is None:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        ending, tag, attributes = m.group(1, 2, 3) if m[2] else m.group(4, 5, 6)
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "title" and "svg" in embeds.values():
            tag = "svg:title"  # names a picture, not the page
        if ending:
            if tag in BLOCK or tag not in VOID:
                close(tag)
            continue
        if tag in RAW and not _self_closing(attributes):
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            text.append(" ")
            continue
        if tag == "select" and (control := _OPTIONS.match(page, at)):
            at = control.end()
            text.append(" ")
            continue
        if tag in CELL or tag in EMBEDDED:
            text.append(" ")
        if tag in VOID:
            if tag in BLOCK:
                flush()
            continue
        if tag in CLOSES_P and any(e[0] == "p" for e in stack[-6:]):
            close("p")
        if tag == "body" and any(e[0] == "head" for e in stack):
            close("head")
        if tag in ("li", "tr", "option", "dt", "dd") and stack[-1][0] == tag:
            close(tag)
        if tag in BLOCK:
            flush()
        _, _, apart, main, named = stack[-1]
        main = main or tag in ("article", "main")
        anywhere = anywhere or main
        count += 1
        links += tag == "a"
        if tag in BLOCK or not _self_closing(attributes):
            if main and (share := _aside(tag, attributes)):
                asides[count] = share
            apart = apart or _marks_apart(tag, attributes, main)
            stack.append((tag, count, apart, main, max(named, _named(tag, attributes, main))))
            if tag in EMBEDDED:
                embeds[count] = tag
        else:
            links -= tag == "a"
    flush()
    for b, numbers in zip(found, held):  # an element that is never closed is read as its tag alone
        shares = {x: EMBEDDED[ended[x]] * n / len(b.text) for x, n in numbers.items() if x in ended}
        b.embedded = min(sum(shares.values()), max((EMBEDDED[ended[x]] for x in shares), default=0.0))
    if asides:
        total, own = 0, dict.fromkeys(asides, 0)
        for b in found:
            if b.main and not b.apart:
                total += len(b.text)
                for number in asides.keys() & b.path:
                    own[number] += len(b.text)
        small = {number for number, share in asides.items() if own[number] < share * total}
        for b in found:
            if not small.isdisjoint(b.path):
                b.named = 1.0
    for b in found:  # without such an element the whole page may be the article
        b.main = float(b.main) if anywhere else NO_MAIN
    return found


def features(b: Block) -> dict[str, float]:
    n = b.text.count(" ") + 1
    return {
        "bias": 1.0,
        "apart": float(b.apart),
        "named": b.named,
        "embedded": b.embedded,
        "main": b.main,
        "paragraph": float(b.tag in ("p", "pre", "blockquote", "dd")),
        "heading": float(b.tag in ("h1", "h2", "h3", "h4", "h5", "h6")),
        "item": float(b.tag in ("li", "option", "dt")),
        "words": min(n, 40) / 20 - 0.5,
        "sentence": float(b.text.rstrip("\"'»”)").endswith((".", "!", "?", "…", ":", "。"))),
        "links": b.linked / max(1, len(b.text)),
    }


def _ties(found: list[Block]) -> list[tuple[int, int, int]]:
    """Smoothness edges: blocks next to each other, and the next child of the same element."""
    ties: dict[tuple[int, int], float] = {}
    last: dict[tuple[int, ...], int] = {}
    for i, b in enumerate(found):
        if i:
            shared = 0
            for x, y in zip(found[i - 1].path, b.path):
                if x != y:
                    break
                shared += 1
            apart = len(found[i - 1].path) + len(b.path) - 2 * shared
            ties[i - 1, i] = ADJACENT / (1 + apart / 2)
        parent = b.path[:-1]
        if parent in last:
            pair = (last[parent], i)
            ties[pair] = ties.get(pair, 0) + SIBLING
        last[parent] = i
    return [(i, j, round(w * UNIT)) for (i, j), w in ties.items()]


def minimum_cut(terminals: list[int], ties: list[tuple[int, int, int]]) -> list[bool]:
    """True for nodes on the source side of a minimum cut.

    terminals: capacity from the source (positive) or to the sink (negative); ties: undirected capacities.
    A node whose terminal outweighs all its ties is on that side in some minimum cut, so it is settled first
    and its ties become terminal capacity of its neighbours; Dinic's algorithm settles the rest.
    """
    n, rest = len(terminals), list(terminals)
    near: list[dict[int, int]] = [{} for _ in range(n)]
    for i, j, w in ties:
        near[i][j] = near[i].get(j, 0) + w
        near[j][i] = near[j].get(i, 0) + w
    weight = [sum(x.values()) for x in near]
    side: list[bool | None] = [None] * n
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if side[i] is not None or abs(rest[i]) < weight[i] or (rest[i] == 0 and near[i]):
            continue
        side[i] = rest[i] > 0
        for j, w in near[i].items():
            if side[j] is None:
                rest[j] += w if side[i] else -w
                weight[j] -= w
                del near[j][i]
                queue.append(j)
    open_nodes = [i for i in range(n) if side[i] is None]
    if open_nodes:
        for i, is_source in zip(open_nodes, _dinic(open_nodes, rest, near)):
            side[i] = is_source
    return [bool(s) for s in side]


def _dinic(nodes: list[int], rest: list[int], near: list[dict[int, int]]) -> list[bool]:
    place = {node: i for i, node in enumerate(nodes)}
    source, sink = len(nodes), len(nodes) + 1
    to: list[int] = []
    room: list[int] = []
    out: list[list[int]] = [[] for _ in range(len(nodes) + 2)]

    def edge(a: int, b: int, there: int, back: int) -> None:
        out[a].append(len(to))
        out[b].append(len(to) + 1)
        to.extend((b, a))
        room.extend((there, back))

    for node, i in place.items():
        if rest[node] > 0:
            edge(source, i, rest[node], 0)
        elif rest[node] < 0:
            edge(i, sink, -rest[node], 0)
        for other, w in near[node].items():
            if other in place and place[other] > i:
                edge(i, place[other], w, w)
    while True:
        level = [-1] * len(out)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(len(nodes))]
        turn = [0] * len(out)
        path: list[int] = []
        at = source
        while True:
            if at == sink:
                pushed = min(room[e] for e in path)
                for e in path:
                    room[e] -= pushed
                    room[e ^ 1] += pushed
                cut = next(k for k, e in enumerate(path) if not room[e])
                at = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while turn[at] < len(out[at]):
                e = out[at][turn[at]]
                if room[e] and level[to[e]] == level[at] + 1:
                    break
                turn[at] += 1
            if turn[at] < len(out[at]):
                path.append(out[at][turn[at]])
                at = to[path[-1]]
            elif at == source:
                break
            else:
                level[at] = -1
                at = to[path.pop() ^ 1]


def labelled(page: str | None) -> list[tuple[Block, bool]]:
    """The page's blocks, each with True if it is content."""
    found = blocks(page)
    for b in found:
        b.score = sum(WEIGHTS[k] * v for k, v in features(b).items())
    return list(zip(found, minimum_cut([round(b.score * UNIT) for b in found], _ties(found))))


def main_text(page: str | None) -> str:
    return "\n\n".join(b.text for b, content in labelled(page) if content)


def with_main_text(pages: DataFrame, source: str = "html", into: str = "text") -> DataFrame:
    """Adds the main text of each page; the name must be free."""
    if into.lower() in {c.lower() for c in pages.columns}:
        raise ValueError(f"column already there: {into}")

    @F.arrow_udf("string")
    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for each in batches:
            yield pa.array([main_text(p.as_py()) for p in each], pa.string())

    return pages.withColumn(into, extract(F.col(source).cast("string")))
