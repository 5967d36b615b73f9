"""Main text of web pages by composite text density.

Every DOM node gets a link-adjusted number of characters per tag (composite
density); a node's sum is that of its children's densities. The smallest
density on the path from the body to the node with the largest sum is the
threshold: from the body down, every subtree at or over it gives its own
heaviest subtree to the content, so that articles in several parts stay whole.
Menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and comments are taken out of the
tree first, by tag and by the words of class, id and role. Forms, and elements
with such a word, stay when they hold an article or main element or most of
the page's text outside links (unless a far larger article stands beside
them); what they hold is judged on its own.

Rows: null or empty html gives an empty text; repeated rows are kept; an
empty table gives an empty result; other columns are not read, whatever their
names; pages of any length are parsed whole, with any depth of elements. The
work is narrow: one pass, no shuffle, one page in memory at a time.
"""

from __future__ import annotations

import re
from bisect import insort
from heapq import heappop, heappush
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrail.llm.common import table

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+[^>]*+)>?", re.S)
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
#: Content of these is text for programs or not shown.
RAW = frozenset("script style title textarea noscript template iframe xmp object svg math select option canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROP_TAGS = frozenset("head nav header footer aside form button dialog menu fieldset label".split()) | RAW
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
DROP_WORDS = frozenset((
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promoted banner sidebar side menu nav navbar navigation "
    "breadcrumb breadcrumbs header masthead footer cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "comment comments disqus respond share sharing social related recommended newsletter subscribe signup login widget toolbar pagination pager").split())
#: Of the dropped tags, those that also wrap whole pages; words behind one of QUALIFIERS say nothing about the element itself.
WRAPPERS = frozenset("form fieldset label".split())
QUALIFIERS = frozenset("with has no without".split())
BLOCKS = frozenset((
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hgroup hr html li "
    "main ol p pre section summary table tbody td tfoot th thead tr ul").split()) | DROP_TAGS
_CELLS, _PARTS = frozenset(("td", "th")), frozenset(("tbody", "thead", "tfoot"))
_LIST, _TABLE = BLOCKS - {"address", "div", "p"}, frozenset(("table",))
#: An opening tag of the key ends the open elements of the first value that no element of the second holds.
ENDS = {"li": (frozenset(("li",)), _LIST), **dict.fromkeys(("dt", "dd"), (frozenset(("dt", "dd")), _LIST)),
        **dict.fromkeys(_CELLS, (_CELLS | {"caption"}, _TABLE | _PARTS | {"tr"})), "tr": (_CELLS | {"tr", "caption"}, _TABLE | _PARTS),
        **dict.fromkeys(_PARTS, (_CELLS | _PARTS | {"tr", "caption"}, _TABLE))}
ARTICLE = frozenset(("article", "main"))
#: What stays beside content, however short.
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre figure table hgroup hr".split())


def _named(attrs: str) -> bool:
    """Does a class, id or role name an unwanted part?"""
    for name, *value in _ATTR.findall(attrs):
        for one in re.sub(r"(?<=[a-z])(?=[A-Z])", "-", "".join(value)).lower().split():
            words = re.split(r"[^a-z0-9]+", one)
            if name.lower() != "role":
                words = words[:next((i for i, w in enumerate(words) if w in QUALIFIERS), None)]
            if not (DROP_ROLES if name.lower() == "role" else DROP_WORDS).isdisjoint(words):
                return True
    return False


class _Node:
    __slots__ = ("tag", "parent", "kids", "lost", "doubt", "chars", "links", "tags", "link_tags", "density", "total")

    def __init__(self, tag, parent, lost=False):
        self.tag, self.parent, self.kids, self.lost, self.doubt = tag, parent, [], lost, False
        self.chars = self.links = self.tags = self.link_tags = 0
        self.density = self.total = 0.0
        if parent is not None and not lost:
            parent.kids.append(self)


def parse(html: str) -> _Node:
    """The wanted tree below the body; kids are nodes and decoded strings."""
    root = node = _Node("body", None)
    doubts = False
    at, n = 0, len(html)
    while at < n:
        m = _TOKEN.search(html, at)
        text = html[at:m.start() if m else n]
        if text:
            if node.tag == "head" and not text.isspace():
                node = node.parent  # text ends an open head
            if not node.lost:
                node.kids.append(unescape(text))
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag or tag in ("html", "body"):
            if tag == "body" and node.tag == "head":
                node = node.parent
            continue
        if m[1]:
            up = node
            while up is not root and up.tag != tag:
                # An inline end tag does not close the blocks around it.
                if up.tag in BLOCKS and tag not in BLOCKS:
                    up = root
                    break
                up = up.parent
            if up is not root:
                node = up.parent
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(html, at)
            if m[0].rstrip(">").endswith("/") and tag in ("svg", "math", "object", "iframe"):
                continue
            at = n if end is None else end.start()
            if end is not None:
                at = html.find(">", at) + 1 or n
            continue
        if tag in VOID:
            if not node.lost:
                _Node(tag, node)
            continue
        if node.tag == "head":
            node = node.parent  # no other element stands in a head
        if tag in BLOCKS:
            if tag in ENDS:
                (ends, holds), up = ENDS[tag], node
                while up is not root:
                    if up.tag in ends:
                        node = up.parent
                        if holds is _LIST:
                            break
                    elif up.tag in holds:
                        break
                    up = up.parent
            # A block ends an open paragraph.
            up = node
            while up is not root and up.tag not in BLOCKS:
                up = up.parent
            if up.tag == "p":
                node = up.parent
        # Unwanted elements are open elements as well, so that they end as wanted ones do; the tree does not hold them.
        # Those that may be wrappers of the content are settled when the page has been read.
        node = _Node(tag, node, node.lost or (tag in DROP_TAGS and tag not in WRAPPERS))
        if not node.lost and (tag in WRAPPERS or (m[3] and tag not in ARTICLE and _named(m[3]))):
            node.doubt = doubts = True
    if doubts:
        _settle(root)
    return root


def _settle(root: _Node) -> None:
    """Take the doubtful elements out of the tree, but for those that hold the content."""
    order = _order(root)
    at = {x: i for i, x in enumerate(order)}
    plain, holds, last, inside = [0] * len(order), [False] * len(order), list(range(len(order))), []
    for i, x in enumerate(order):
        inside.append(x.tag == "a" or (x is not root and inside[at[x.parent]]))
    for i in range(len(order) - 1, -1, -1):
        x = order[i]
        if not inside[i]:
            plain[i] += sum(len("".join(k.split())) for k in x.kids if isinstance(k, str))
        holds[i] = holds[i] or (x.tag in ARTICLE and plain[i] > 0)
        if x is not root:
            p = at[x.parent]
            plain[p] += plain[i]
            holds[p] = holds[p] or holds[i]
            last[p] = max(last[p], last[i])
    # The fullest first, so that a wrapper comes before what it holds; articles in kept parts compete with the rest.
    articles: list[tuple[int, int]] = []
    waiting: list[tuple[int, int]] = []

    def walk(start: int) -> None:
        i, end = start, last[start]
        while i <= end:
            if i != start and order[i].doubt:
                heappush(waiting, (-plain[i], i))
                i = last[i] + 1
                continue
            if order[i].tag in ARTICLE:
                insort(articles, (-plain[i], i))
            i += 1

    walk(0)
    gone = set()
    while waiting:
        _, i = heappop(waiting)
        beside = next((-n for n, a in articles if not a < i <= last[a]), 0)
        if (holds[i] or 2 * plain[i] > plain[0]) and 4 * beside < plain[i]:
            walk(i)
        else:
            gone.add(order[i])
    for p in {x.parent for x in gone}:
        p.kids = [k for k in p.kids if isinstance(k, str) or k not in gone]


def _order(root: _Node) -> list[_Node]:
    out, todo = [], [root]
    while todo:
        x = todo.pop()
        out.append(x)
        todo += [k for k in reversed(x.kids) if isinstance(k, _Node)]
    return out


def density(chars: int, links: int, tags: int, link_tags: int, share: float) -> float:
    """Composite density: characters per tag, less where links hold them;
    ``share`` is the page's own part of linked characters."""
    if not chars:
        return 0.0
    plain = max(1, chars - links)
    tags, links, link_tags = max(1, tags), max(1, links), max(1, link_tags)
    base = log(chars / plain * links + share * chars + e)
    return max(0.0, chars / tags * log(max(1.0, chars / links * tags / link_tags) * e) / log(base * e))


def weigh(root: _Node) -> list[_Node]:
    """Set densities and sums; returns the nodes in page order."""
    order = _order(root)
    inside = {}
    for x in order:
        inside[x] = x.tag == "a" or (x.parent is not None and inside[x.parent])
    for x in reversed(order):
        own = sum(len("".join(k.split())) for k in x.kids if isinstance(k, str))
        x.chars += own
        x.links += own if inside[x] else 0
        if x.parent is not None:
            p = x.parent
            p.chars += x.chars
            p.links += x.links
            p.tags += x.tags + 1
            p.link_tags += x.link_tags + (x.tag == "a")
    share = root.links / max(1, root.chars)
    for x in order:
        x.density = density(x.chars, x.links, x.tags, x.link_tags, share)
    for x in order:
        x.total = sum(k.density for k in x.kids if isinstance(k, _Node))
    return order


def _heaviest(order: list[_Node]) -> dict[_Node, _Node]:
    """Per node, the node of its subtree with the largest sum; the first in page order wins a tie."""
    best = {x: x for x in order}
    for x in reversed(order):
        p = x.parent
        # Later kids come first here, so an equal earlier one replaces them; the node itself comes before its kids.
        if p is not None and best[x].total >= best[p].total and best[x].total > p.total:
            best[p] = best[x]
    return best


def _runs(x: _Node, bare: dict[_Node, bool]) -> list[list]:
    """The node's kids, with neighbouring text and inline kids as one run."""
    out: list[list] = []
    inline = False
    for k in x.kids:
        own = isinstance(k, str) or bare[k]
        if own and inline:
            out[-1].append(k)
        else:
            out.append([k])
        inline = own
    return out


def select(root: _Node) -> list:
    """The content: subtrees and runs of text, in page order.

    The threshold is the least density between the body and the node with the
    largest sum of densities. From the body down, every subtree at or over it
    gives up its own heaviest subtree to the content, and its kids are looked
    at in turn; a run of text between blocks is judged like a subtree. Beside
    content, paragraphs, headings, lists and tables that are mostly not links
    stay as well, however short. Content inside an article or main element
    takes the whole of it, and then nothing outside such elements counts.
    """
    order = weigh(root)
    if not root.chars:
        return []
    heaviest = _heaviest(order)
    best = heaviest[root]
    if best.total <= 0:
        return [root]
    threshold, up = best.density, best
    while up is not None:
        threshold = min(threshold, up.density)
        up = up.parent
    share = root.links / max(1, root.chars)
    marked = set()
    todo = [root]
    while todo:
        x = todo.pop()
        if x.density >= threshold:
            marked.add(heaviest[x])
            todo += [k for k in x.kids if isinstance(k, _Node)]
    home = {}
    for x in order:
        home[x] = x if x.tag in ARTICLE and x.chars else home.get(x.parent)
    if home[best] is not None:
        marked = {home[x] for x in marked if home[x] is not None}
    bare = {}
    for x in reversed(order):
        bare[x] = x.tag not in BLOCKS and all(isinstance(k, str) or bare[k] for k in x.kids)
    holds = {x: x in marked for x in order}
    for x in reversed(order):
        if holds[x] and x.parent is not None:
            holds[x.parent] = True

    def judged(run: list) -> bool:
        nodes = [k for k in run if isinstance(k, _Node)]
        chars = sum(len("".join(k.split())) for k in run if isinstance(k, str)) + sum(k.chars for k in nodes)
        links = sum(k.links for k in nodes)
        if any(k in marked for k in nodes):
            return True
        return density(chars, links, sum(k.tags + 1 for k in nodes), sum(k.link_tags + (k.tag == "a") for k in nodes), share) >= threshold

    out: list = []
    todo = [root]
    while todo:
        x = todo.pop()
        if not isinstance(x, _Node) or x in marked:
            out.append(x)
            continue
        keep: list = []
        runs = _runs(x, bare)
        plain = home[best] is None
        texts = [plain and (isinstance(r[0], str) or bare[r[0]]) and judged(r) for r in runs]
        beside = plain and any(t or (isinstance(r[0], _Node) and r[0] in marked and r[0].tag in PARAGRAPHS) for r, t in zip(runs, texts))
        for r, t in zip(runs, texts):
            k = r[0]
            if t:
                keep += [None, *r, None] if len(r) > 1 or isinstance(k, str) else r
            elif isinstance(k, _Node) and holds[k]:
                keep.append(("down", k))
            elif beside and isinstance(k, _Node) and k.tag in PARAGRAPHS and 2 * k.links <= k.chars:
                keep.append(k)
        todo += [k[1] if isinstance(k, tuple) else _Taken(k) for k in reversed(keep)]
    return [x.what if isinstance(x, _Taken) else x for x in out]


class _Taken:
    """Content that is not looked into again (None: a border between blocks)."""

    __slots__ = ("what",)

    def __init__(self, what):
        self.what = what


def blocks(content: list) -> list[str]:
    """Text of the content's blocks in page order, white space as one space."""
    out: list[str] = []
    run: list[str] = []

    def flush():
        text = " ".join("".join(run).split())
        if text:
            out.append(text)
        run.clear()

    todo: list = list(reversed(content))
    while todo:
        x = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            run.append(x)
        elif x.tag in ("br", "wbr"):
            run.append(" " if x.tag == "br" else "")
        elif x.tag in BLOCKS:
            flush()
            todo.append(None)
            todo += reversed(x.kids)
        else:
            todo += reversed(x.kids)
    flush()
    return out


def extract(html: str | None) -> str:
    """Main text of one page."""
    return "\n\n".join(blocks(select(parse(html or ""))))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every row."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def run(batches):
        for b in batches:
            texts = [extract(h.as_py()) for h in b.column("html")]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")


def op1_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))
