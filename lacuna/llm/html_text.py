"""Main text of web pages by minimum-cut labelling of their blocks.

A page becomes a list of blocks (runs of text between block-level tags), each
with the features of its place in the tree.  A linear classifier turns these into
a cost of calling the block boilerplate and a cost of calling it content: the
capacities of its edges to the two terminals.  Blocks that follow one another, or
that are the nearest of one container, are joined by smoothness edges whose
capacity falls with their distance in the tree.  The minimum cut (maximum flow)
is the cheapest labelling; content blocks are joined in page order by one space.

There are no labelled pages, so the classifier's weights are the fixed table
below, not trained.  Nothing of a page is dropped or capped before the cut.

Null, empty and text-free pages give an empty text; a page without tags is one
block.  Unclosed and stray tags, truncated pages and repeated rows are read like
any other.  Only the id, the url and the html column are read.
"""

from __future__ import annotations

import html as _html
import math
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as tx

# --- fixed values of the classifier -------------------------------------------------
BIAS = 0.4
#: Evidence of an element for the text inside it, by tag; the nearest ``RESET`` tag
#: forgets what stood above it, but for the noise of the ``KEPT_TAGS``, of hidden elements
#: and of elements named after a part of the page (``_names_part``).
TAG_WEIGHT = {"article": 4.0, "main": 4.0, "nav": -9.0, "footer": -9.0, "aside": -9.0,
              "form": -9.0, "header": -5.0, "menu": -9.0, "dialog": -9.0, "address": -1.0,
              "button": -9.0, "label": -6.0, "fieldset": -9.0, "legend": -6.0,
              "blockquote": 0.5, "pre": 0.5, "figcaption": 0.5, "h1": 1.0, "h2": 0.5, "p": 1.0}
RESET = {"article", "main"}
KEPT_TAGS = {"nav", "footer", "aside", "menu", "dialog"}
#: Words of class, id and role attributes that mark what is not the article.
NOISE_WORDS = frozenset("""ad ads advert adverts advertisement advertising adsbygoogle banner
    sponsor sponsored sponsors promo promotion promoted sidebar aside menu nav navbar navigation
    breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices alert
    popup modal overlay share sharing social related recommended newsletter subscribe
    subscription signup login form search widget widgets pagination pager comment comments
    commentlist disqus respond reply replies complementary contentinfo dialog toolbar tags
    copyright legal disclaimer hidden skip""".split())
NOISE_WEIGHT = -9.0
#: Noise words that name what a text is about as often as a part of the page.
TOPICS = frozenset("search legal notice notices alert".split())
PART_WORDS = NOISE_WORDS - TOPICS
COMMENTS = frozenset("comment comments commentlist disqus respond reply replies".split())
#: Ids of sections of an article that are no topic of it.
PLACES = frozenset("""comments commentlist disqus respond sidebar breadcrumbs navbar adsbygoogle
    pagination pager""".split())
#: Words beside a noise word in the name of a part of the page; numbers and letters likewise.
FURNITURE = frozenset("""posts post articles article stories story entry entries content body text
    card cards teaser teasers tile item items list box boxes button buttons bar block container
    wrapper wrap inner outer panel slot unit area section thread links icons title""".split())
#: The same beside a word of ``COMMENTS`` or ``PLACES``.
SIDES = frozenset("""left right top bottom above below site page reader readers user users
    facebook fb wp""".split())
#: Words of names that tell of the page or its subject, not of the element.
LAYOUT = frozenset("""has with without no not layout open closed enabled disabled category tag
    topic type format status""".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Of a name inside an article that may be its topic; the share of links adds ``NOISE_WEIGHT``.
SOFT_WEIGHT = -1.0
GOOD_WORDS = frozenset("article content post entry story main body text".split())
GOOD_WEIGHT = 1.5
LINK_WEIGHT = -5.0        # times the share of letters inside links
LENGTH_WEIGHT = 0.35      # times the logarithm of the words, at most LENGTH_MOST
LENGTH_MOST = 2.0
SENTENCE_WEIGHT = 0.4     # the text ends a sentence
SYMBOL_WEIGHT = -3.0      # copyright lines
NEXT_CAPACITY = 1.2       # of an edge between neighbours
CONTAINER_CAPACITY = 0.8  # of an edge to the nearest earlier block of the container

SKIPPED = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object",
           "canvas", "audio", "video", "map", "head", "select", "option", "textarea", "datalist"}
RAW = {"script", "style", "noscript", "iframe", "textarea", "title", "template"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
        "track", "wbr", "param"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "br", "button", "caption", "center",
         "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure",
         "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr",
         "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre",
         "section", "select", "summary", "table", "tbody", "td", "textarea", "tfoot", "th",
         "thead", "title", "tr", "ul"}
#: A start tag closes an open element of these kinds, up to the nearest container.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CONTAINER = {"article", "aside", "body", "div", "dl", "footer", "form", "header", "html", "main",
             "nav", "ol", "section", "table", "ul", "blockquote"}
# -------------------------------------------------------------------------------------

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
                  r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTR = re.compile(r"(?:^|\s)(class|id|role|hidden|style|aria-hidden)"
                   r"(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_SPACE = re.compile(r"\s+")


class _Node:
    __slots__ = ("tag", "depth", "parent", "weight", "noise", "soft", "inside", "skip", "link")

    def __init__(self, tag, parent, weight, skip, link, noise=0.0, soft=False, inside=False):
        self.tag, self.parent, self.weight = tag, parent, weight
        self.skip, self.link = skip, link
        #: what a RESET tag below keeps; under a doubtful name; in an article or main
        self.noise, self.soft, self.inside = noise, soft, inside
        self.depth = parent.depth + 1 if parent else 0


def _parts(name: str) -> set[str]:
    return {p.lower() for p in _PART.findall(name)}


def _names_part(parts: set[str], slug: bool) -> bool:
    """Whether a class or role, or an id (``slug``), as a whole names a part of the page."""
    found = parts & PART_WORDS
    if not found or parts & LAYOUT:
        return False
    if not slug and parts & COMMENTS:
        return True
    rest = {p for p in parts - found - FURNITURE if len(p) > 1 and not p.isdigit()}
    if slug and found & (COMMENTS | PLACES):
        rest -= SIDES
    return not rest and not ("sidebar" in parts and "content" in parts)


def _words_noise(tag: str, name: str, parts: set[str], inside: bool, section: bool) -> bool:
    """Whether a class, role or id with a noise word marks noise beyond doubt."""
    if name != "id":
        if tag in RESET:
            return _names_part(parts, False)
        if name == "role":
            return not inside or parts != {"alert"}
        return not inside or bool(parts & PART_WORDS) and not parts & LAYOUT
    if tag in HEADINGS:
        return False  # its anchor
    if tag not in RESET and not inside:
        return True
    if not section or parts & NOISE_WORDS <= PLACES:
        return _names_part(parts, True)
    return _names_part(parts, True) and not parts <= NOISE_WORDS


def _evidence(tag: str, attrs: str, parent: _Node) -> tuple[float, float, bool, bool]:
    """Weight, the noise in it that RESET tags keep, whether a name is in doubt, and ``inside``."""
    above = parent.noise if tag in RESET else parent.weight
    own = TAG_WEIGHT.get(tag, 0.0)
    kept, soft = own if tag in KEPT_TAGS else 0.0, False
    if tag == "header" and parent.weight > 0:
        own = 0.0  # the head of an article, not of the page
    if attrs and tag not in ("html", "body"):
        found = [(m[1].lower(), m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(attrs)]
        section = tag not in ("div", *RESET) or any(
            n == "class" and "section" in _parts(v) for n, v in found)
        for name, value in found:
            if name in ("class", "id", "role"):
                names = [_parts(v) for v in value.split()]
                noise = [p for p in names if p & NOISE_WORDS]
                if any(_words_noise(tag, name, p, parent.inside, section) for p in noise):
                    own += NOISE_WEIGHT
                elif noise and tag not in RESET:
                    soft = True
                elif any(p & GOOD_WORDS for p in names):
                    own += GOOD_WEIGHT
                if tag not in HEADINGS and any(_names_part(p, name == "id") for p in noise):
                    kept += NOISE_WEIGHT
            elif (name == "hidden" or name == "aria-hidden" and value.lower() == "true"
                  or name == "style" and re.search(r"display\s*:\s*none", value, re.I)):
                own += NOISE_WEIGHT
                kept += NOISE_WEIGHT
    if tag not in RESET:
        return above + own, parent.noise + kept, parent.soft or soft, parent.inside
    if above + kept < 0:
        own = min(0.0, own - TAG_WEIGHT[tag])  # of no more use than another element there
    return above + own, above + kept, soft, True


def blocks(page: str) -> list[tuple[str, _Node, int]]:
    """(text, innermost element, letters inside links) of each block with text."""
    root = _Node("", None, 0.0, False, False)
    node, found, buf, linked = root, [], [], 0
    at, end = 0, len(page)

    def flush():
        nonlocal linked
        if buf:
            s = _SPACE.sub(" ", "".join(buf)).strip()
            if s:
                found.append((s, holder, linked))
            buf.clear()
        linked = 0

    holder = root
    while at < end:
        m = _TAG.search(page, at)
        stop = m.start() if m else end
        if stop > at and not node.skip:
            s = _html.unescape(page[at:stop])
            if not buf:
                holder = node
            buf.append(s)
            if node.link:
                linked += sum(map(str.isalnum, s))
        if not m:
            break
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in BLOCK:
            flush()
        if m[1]:
            n = node
            while n.parent is not None and n.tag != tag:
                n = n.parent
            if n.parent is not None:
                node = n.parent
            continue
        if tag in VOID or m[3].endswith("/") and tag not in BLOCK and tag not in RAW:
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at)
            if tag == "textarea" or close or tag in ("script", "style", "title"):
                at = close.end() if close else end
                continue
        shut = CLOSES.get(tag) or ({"p"} if tag in BLOCK else None)
        if shut:
            n = node
            while n.parent is not None and n.tag not in shut and n.tag not in CONTAINER:
                n = n.parent
            if n.tag in shut:
                node = n.parent
        weight, *marks = _evidence(tag, m[3], node)
        node = _Node(tag, node, weight, node.skip or tag in SKIPPED, node.link or tag == "a", *marks)
        if tag == "body":
            node.skip = False  # a head that was never closed
    flush()
    return found


def score(text: str, node: _Node, linked: int) -> float:
    """Log-odds that a block is content."""
    letters = sum(map(str.isalnum, text)) if linked else 1
    share = min(1.0, linked / max(1, letters))
    s = BIAS + node.weight + LINK_WEIGHT * share
    if node.soft:
        s += SOFT_WEIGHT + NOISE_WEIGHT * share
    s += min(LENGTH_MOST, LENGTH_WEIGHT * math.log1p(text.count(" ") + 1))
    if text[-1] in ".!?…\"'”":
        s += SENTENCE_WEIGHT
    if "©" in text[:40]:
        s += SYMBOL_WEIGHT
    return s


def _apart(a: _Node, b: _Node) -> int:
    """Steps in the tree between two elements."""
    d = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        d += 1
    return d


def edges(found) -> list[tuple[int, int, float]]:
    """Smoothness edges: page neighbours, and the nearest earlier block of a container."""
    out, last = [], {}
    for j, (_, node, _) in enumerate(found):
        if j:
            out.append((j - 1, j, NEXT_CAPACITY / (1 + _apart(found[j - 1][1], node))))
        n = node
        while n.parent is not None and n.tag not in CONTAINER:
            n = n.parent
        i = last.get(id(n))
        if i is not None and i != j - 1:
            out.append((i, j, CONTAINER_CAPACITY / (1 + _apart(found[i][1], node))))
        last[id(n)] = j
    return out


def min_cut(scores: list[float], links: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the source in a minimum cut.

    A node's terminal edge carries its score (to the source if positive).  A node
    whose terminal edge outweighs all its other edges has that label in every
    minimum cut, so it is merged into its terminal, again and again; shortest
    augmenting paths settle the rest.
    """
    n = len(scores)
    pull = list(scores)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, c in links:
        near[i][j] = near[i].get(j, 0.0) + c
        near[j][i] = near[j].get(i, 0.0) + c
    label: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:
        i = todo.popleft()
        if label[i] is not None or abs(pull[i]) < sum(near[i].values()) or pull[i] == 0:
            continue
        label[i] = pull[i] > 0
        for j, c in near[i].items():
            pull[j] += c if label[i] else -c
            del near[j][i]
            todo.append(j)
        near[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        side = _max_flow(rest, pull, near)
        for i in rest:
            label[i] = i in side
    return [bool(x) for x in label]


def _max_flow(rest: list[int], pull: list[float], near: list[dict[int, float]]) -> set[int]:
    """Nodes that the source still reaches after a maximum flow."""
    s, t = -1, -2
    left: dict[int, dict[int, float]] = {s: {}, t: {}}
    for i in rest:
        left[i] = dict(near[i])
    for i in rest:
        left[s][i], left[i][s] = max(pull[i], 0.0), 0.0
        left[i][t], left[t][i] = max(-pull[i], 0.0), 0.0
    while True:
        came, line = {s: s}, deque([s])
        while line and t not in came:
            u = line.popleft()
            for v, c in left[u].items():
                if c > 1e-12 and v not in came:
                    came[v] = u
                    line.append(v)
        if t not in came:
            return set(came) - {s}
        path, v = [], t
        while v != s:
            path.append((came[v], v))
            v = came[v]
        push = min(left[u][v] for u, v in path)
        for u, v in path:
            left[u][v] -= push
            left[v][u] += push


def main_text(page: str | None) -> str:
    """The article of one page."""
    found = blocks(page or "")
    if not found:
        return ""
    keep = min_cut([score(*b) for b in found], edges(found))
    return " ".join(b[0] for b, k in zip(found, keep) if k)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url",
            html: str = "html") -> DataFrame:
    """``key``, ``url``, the main ``text`` and its ``n_chars`` of every page."""
    schema = T.StructType([pages.schema[key], pages.schema[url],
                           T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tx.slices(batches, "__html"):
            texts = [main_text(p) for p in b.column("__html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()),
                 pa.array(list(map(len, texts)), pa.int64())], names=schema.names)

    return pages.select(F.col(key), F.col(url),
                        F.col(html).cast("string").alias("__html")).mapInArrow(run, schema)


def op9_html_extraction(spark, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
