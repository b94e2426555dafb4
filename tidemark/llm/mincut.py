"""Main text of HTML pages by minimum-cut labelling of blocks.

A page is cut into blocks (runs of text between block-level tags). A linear classifier scores each block by its
marked ancestors (semantic tags, class and id words: the lowest boilerplate mark, else the nearest mark), its tag, link density, length and punctuation; the score
becomes the capacity to the content or the boilerplate terminal. Blocks next to each other in the page and blocks under
one parent are joined by smoothness edges that weaken with DOM distance. The maximum flow's minimum cut is the labelling
of least total cost; blocks on the content side, in page order, are the main text.

White space inside a block (line breaks too) becomes one space; blocks are joined by one line feed; character
references are decoded. Scripts, styles, templates, head elements and markup never become text.

Defined results: null or blank html gives an empty text; a page without any content block gives an empty text;
unclosed or stray tags are tolerated (text after an unclosed element such as svg, title or iframe is text of the page); ids and urls are passed through, null or repeated; extra columns are ignored; an
empty table gives no rows. Long pages are read whole.
"""

from __future__ import annotations

import html as entities
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>|([^<]+|<)", re.S)
ATTR = re.compile(r"(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg", "math", "head", "title", "object",
       "canvas", "video", "audio", "select", "datalist"}
RAW_END = {t: re.compile(f"</{t}\\s*>", re.I) for t in RAW}
VOID = {"br", "img", "hr", "meta", "link", "input", "wbr", "area", "base", "col", "embed", "source", "track", "param"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog",
         "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5",
         "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre",
         "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
#: Tags that a start tag closes when they are open in the same container.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
LIMITS = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
          "option": {"form"}}
MARK = {"nav": -9.0, "footer": -9.0, "aside": -9.0, "form": -9.0, "button": -9.0, "menu": -9.0, "dialog": -9.0,
        "header": -6.0, "article": 6.0, "main": 4.0}
BAD = set("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar
navigation menu breadcrumb breadcrumbs sidebar aside widget footer header masthead topbar toolbar cookie cookies consent
gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login register share sharing
social comment comments commentlist disqus reply replies respond discussion related recommended recommendations trending
popular pagination pager copyright legal disclaimer skip search form""".split())
GOOD = set("article content main post entry story body prose maintext articlebody text".split())
ROLES = {"navigation": -9.0, "banner": -6.0, "contentinfo": -9.0, "complementary": -9.0, "search": -9.0, "form": -9.0,
         "dialog": -9.0, "alert": -9.0, "main": 4.0, "article": 6.0}
DEEPEST = 512  # elements open at once, as browsers have it; what is nested deeper belongs to the innermost of them
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
NEAR, FAR = 1.0, 0.5  # smoothness of neighbours under one parent, and how it fades with DOM distance


class Block:
    __slots__ = ("text", "links", "path", "tag", "mark")

    def __init__(self, text: str, links: int, path: tuple[int, ...], tag: str, mark: float):
        self.text, self.links, self.path, self.tag, self.mark = text, links, path, tag, mark


def mark_of(tag: str, attrs: str, inside: bool = False) -> tuple[float, float | None]:
    """(weight, weight without class words) that an element's tag, role, class and id give to what it holds; 0 for none.

    The second is None unless the weight is a boilerplate one by class or id words alone, or by a form. ``inside``: in an
    article or main element, where a header is its own."""
    weight, words = MARK.get(tag, 0.0), set()
    if inside and tag == "header":
        weight = 0.0
    if attrs and tag not in ("html", "body"):
        for name, value in ATTR.findall(attrs):
            name, value = name.lower(), value.strip("\"'")
            if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(
                    r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return -9.0, None
            if name == "role" and value.lower() in ROLES:
                weight = ROLES[value.lower()]
            elif name in ("class", "id"):
                words |= {w.lower() for w in WORD.findall(value)}
    if inside or tag == "header":
        words.discard("header")
    if weight > -7.0 and words & BAD:
        return -7.0, weight
    if not weight and words & GOOD:
        weight = 2.0
    return weight, 0.0 if tag == "form" and weight < 0 else None


def blocks_of(page: str) -> list[Block]:
    """The page's text blocks in order."""
    out: list[Block] = []
    serial = 0
    # tag, node number, mark, mark without its class words (None: not by class words alone)
    stack: list[tuple[str, int, float, float | None]] = [("#", 0, 0.0, None)]
    parts: list[str] = []
    links = 0  # characters inside links of the running block
    in_link = 0
    soft_text: dict[int, int] = {}
    soft_keep: set[int] = set()
    marks: list[list[tuple[int, float, float | None]]] = []  # of each block, outermost first
    met: set[str] = set()

    def wrappers() -> list[int]:
        """Open elements marked by class words that no article holds."""
        tags = [s[0] for s in stack]
        end = tags.index("article") + 1 if "article" in tags else len(tags)
        return [s[1] for s in stack[:end] if s[3] is not None]

    def flush() -> None:
        nonlocal links
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, links, tuple(s[1] for s in stack), stack[-1][0], 0.0))
                marks.append([(node, m, plain) for _, node, m, plain in stack if m])
                for _, node, _, plain in stack:
                    if plain is not None:
                        soft_text[node] = soft_text.get(node, 0) + len(text)
                if stack[-1][0] == "h1":
                    soft_keep.update(wrappers())
            parts.clear()
        links = 0

    pos, n = 0, len(page)
    while pos < n:
        m = TOKEN.match(page, pos)
        if not m:  # an unfinished tag at the end of the page
            break
        pos = m.end()
        data = m[4]
        if data is not None:
            parts.append(data)
            if in_link:
                links += len(data)
            continue
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "a":
                in_link = 0
            elif tag in BLOCK:
                flush()
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == tag:
                        del stack[k:]
                        break
            continue
        if tag in RAW:
            if not m[3].endswith("/"):
                if tag not in ("svg", "math", "object", "canvas", "video", "audio"):
                    flush()
                end = RAW_END[tag].search(page, pos)
                if not end and tag not in ("script", "style"):
                    continue  # unclosed: go on with its elements; only code runs to the end of the page
                pos = end.end() if end else n
            continue
        if tag == "br":
            parts.append(" ")
        elif tag == "a":
            in_link = 1
        elif tag in BLOCK:
            flush()
            if tag in CLOSES:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in CLOSES[tag]:
                        del stack[k:]
                        break
                    if stack[k][0] in LIMITS[tag]:
                        break
            if stack[-1][0] == "p":  # a block never sits inside a paragraph
                stack.pop()
            if tag not in VOID and len(stack) < DEEPEST:
                serial += 1
                mark, plain = mark_of(tag, m[3], any(s[0] in ("article", "main") for s in stack))
                around = wrappers()
                stack.append((tag, serial, mark, plain))
                if tag in ("article", "main") and tag not in met and (mark > 0 or plain is not None and not around):
                    met.add(tag)  # the page's first: what holds it may be a wrapper of the page
                    soft_keep.update(wrappers())
    flush()
    total = sum(len(b.text) for b in out)
    # class words on a wrapper of most of the page say nothing about its text
    wrap = {node for node in soft_keep if soft_text.get(node, 0) > 0.6 * total}
    for b, held in zip(out, marks):
        weights = [plain if node in wrap else m for node, m, plain in held]
        # a boilerplate mark holds for all that its element contains; otherwise the innermost mark counts
        b.mark = min((w for w in weights if w < 0), default=next((w for w in reversed(weights) if w), 0.0))
    return out


def score(b: Block) -> float:
    """Content score of a block (log-odds like): positive for content."""
    n = len(b.text)
    s = -0.8 + min(n / 60, 3.0) - 5.0 * min(1.0, b.links / n) + b.mark
    s += 0.7 if re.search(r"[.!?…:;,]", b.text) else -0.3
    if b.tag == "p":
        s += 0.6
    elif b.tag[0] == "h" and b.tag[1:].isdigit():
        s += 0.5
    elif b.tag in ("li", "td", "th", "dt", "option", "legend"):
        s -= 0.4
    if re.match(r"(?:©|\(c\)|copyright\b)", b.text, re.I):
        s -= 5.0
    return s


def edges_of(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness edges: each block with the next one, and with the next one under the same parent."""
    out = []
    last: dict[int, int] = {}
    for j, b in enumerate(blocks):
        if j:
            a = blocks[j - 1].path
            common = 0
            for x, y in zip(a, b.path):
                if x != y:
                    break
                common += 1
            apart = max(0, len(a) + len(b.path) - 2 * common - 2)
            out.append((j - 1, j, NEAR * FAR**apart))
        parent = b.path[-2] if len(b.path) > 1 else b.path[-1]
        if parent in last and last[parent] != j - 1:
            out.append((last[parent], j, NEAR * FAR))
        last[parent] = j
    return out


def min_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for the nodes on the content side of a minimum cut (source capacity: positive score; sink: negative).

    A node whose terminal outweighs its edges to undecided nodes keeps that side in some minimum cut; such nodes are
    settled first, exactly, and their edges become terminal capacity. The rest goes through shortest augmenting paths."""
    n = len(scores)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in edges:
        near[a][b] = near[a].get(b, 0.0) + w
        near[b][a] = near[b].get(a, 0.0) + w
    s, side = list(scores), [None] * n
    todo = deque(range(n))
    while todo:
        i = todo.popleft()
        if side[i] is None and abs(s[i]) > sum(near[i].values()):
            side[i] = s[i] > 0
            for j, w in near[i].items():
                s[j] += w if side[i] else -w
                del near[j][i]
                todo.append(j)
    free = [i for i in range(n) if side[i] is None]
    if not free:
        return side
    cap = {i: dict(near[i]) for i in free}
    src, dst = -1, -2
    cap[src] = {i: s[i] for i in free if s[i] > 0}
    cap[dst] = {}
    for i in free:
        if s[i] > 0:
            cap[i][src] = 0.0
        elif s[i] < 0:
            cap[i][dst] = -s[i]
            cap[dst][i] = 0.0
    while True:
        back, queue = {src: src}, deque([src])
        while queue and dst not in back:
            x = queue.popleft()
            for y, c in cap[x].items():
                if c > 1e-12 and y not in back:
                    back[y] = x
                    queue.append(y)
        if dst not in back:
            for i in free:  # reachable in the residual graph: content
                side[i] = i in back
            return side
        path, y = [], dst
        while y != src:
            path.append((back[y], y))
            y = back[y]
        flow = min(cap[a][b] for a, b in path)
        for a, b in path:
            cap[a][b] -= flow
            cap[b][a] = cap[b].get(a, 0.0) + flow


def main_text(page: str | None) -> str:
    """The main text of one page."""
    if not page:
        return ""
    blocks = blocks_of(page)
    keep = min_cut([score(b) for b in blocks], edges_of(blocks))
    return "\n".join(b.text for b, k in zip(blocks, keep) if k)


def extract(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """``keep`` with ``text`` and ``n_chars``."""
    rows = pages.select(*[F.col(c) for c in keep], F.col(html))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [main_text(p) for p in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(keep))], pa.array(got, pa.string()),
                                              pa.array([len(t) for t in got], pa.int64())], names=[*keep, "text", "n_chars"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return map_arrow(rows, run, f"{kinds}, text string, n_chars long")


def op1(pages: DataFrame) -> DataFrame:
    return extract(pages, ["page_id", "url"])
