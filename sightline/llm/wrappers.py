"""Main text of web pages by wrapper induction.

Pages of one host share a template. Each page becomes a tree of its block
elements (runs of siblings of one shape folded into one), and simple tree
matching aligns it with the host's wrapper: the order-keeping matching of
children that maximises the number of matched nodes, worked out once per pair of
shapes; lists of children beyond ``CELLS`` pairs are matched block by block. A wrapper node counts the
pages it matched and the texts of the single elements it saw there (lossy counts
with error bounds); an element whose text is the same on nearly all of them is
template, one whose text varies is a slot for content.

* ``induce``: every task aligns its pages with a wrapper per host and sends one
  wrapper per host; wrappers of a host are merged by aligning them with one
  another, first in a few dozen parts, then the parts. A host with a third of
  all pages is thereby split over all tasks.
* ``extract``: each page is aligned with its host's wrapper. What a page marks
  as navigation, header, footer, sidebar, notice, advert, form, script, style
  or reader comment by element, role or class never counts. Inside an article
  class words other than those of adverts and reader comments decide only if the
  host has no wrapper: a section of class "legal" that varies is text. If the page has an
  article (or main) element, its text is that element's; otherwise it is the
  text of all slots, without the nodes that are template.

Wrappers reach the pages by broadcast while all of them together are small
(``BROADCAST_BYTES``, measured), else by a join on the host.

Defined cases: null and empty html give an empty text; a page without a usable
url has no host and is cut by element, role and class alone, as is a host of
fewer than ``MIN_PAGES`` pages; a page of which nothing would be left (all
pages of a host alike) keeps its slots and template alike; broken markup is read
as far as it goes; repeated rows each get their row; extra columns are not
looked at.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import write_once

MIN_PAGES, CONSTANT = 4, 0.75
SHARE = 0.1                  # of its parent's pages: layouts of one host side by side
BUCKET = 50                  # pages between prunings; what rarer nodes and texts are dropped
DEPTH = 60                   # deeper elements count as part of their ancestor
PARTS = 64
BROADCAST_BYTES = 32 << 20
CELLS = 1 << 18              # pairs of children looked at for one pair of nodes

# Fixed values of HTML: elements by kind.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe svg math".split())
ENDLESS = {"script", "style", "textarea", "title"}  # without an end tag they take the rest of the page
FOREIGN = {"svg", "math"}    # may close themselves
BLOCK = set("""address article aside blockquote body caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html li main menu nav ol
optgroup option p pre search section select summary table tbody td tfoot th thead tr ul head""".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "p": {"p"}}
NEVER = set("""script style noscript template iframe svg math head title nav footer aside form button
select textarea label dialog menu object canvas audio video""".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
# Words of class and id names that say what an element is for.
PURPOSE = set("""nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar sidenav aside footer
foot masthead topbar toolbar skip ad ads adv advert adverts advertisement advertising sponsor sponsored
promo promotion banner cookie cookies consent gdpr notice notices notification alert disclaimer popup
modal overlay newsletter subscribe subscription signup login share sharing social related recommended
recommendations trending widget comment comments commentlist disqus respond reply replies discussion
pagination pager search copyright legal hidden""".split())
COMMENTS = {"comment", "comments", "commentlist", "disqus"}
ADVERTS = set("ad ads advert adverts advertisement advertising sponsored".split())  # as whole class names
CONTENT, DOUBTFUL, BY_CLASS, BY_ELEMENT = range(4)

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
                  r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>", re.S)
_ATTR = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'=<>`]+))?""")
_SPLIT = re.compile(r"[^a-z]+")
_SPACE = re.compile(r"\s+")


class Node:
    """A block element: its label, own texts, and block children in order."""

    __slots__ = ("label", "kids", "own")

    def __init__(self, label: str):
        self.label, self.kids, self.own = label, [], []



def _purpose(tag: str, attrs: str, inside: bool) -> tuple[int, str, str]:
    """(how surely it is no content, "main" or "article" if it marks the article,
    name for the label)."""
    if tag in NEVER or (tag == "header" and not inside):
        return BY_ELEMENT, "", ""
    article = tag if tag in ("article", "main") else ""
    if not attrs or "=" not in attrs and "hidden" not in attrs:
        return CONTENT, article, ""
    found = {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(attrs)}
    role = found.get("role", "").lower()
    names = f"{found.get('class', '')} {found.get('id', '')}".lower()
    words = set(_SPLIT.split(names))
    if role == "main" or found.get("itemprop", "").lower() == "articlebody":
        article = "main"
    elif role == "article":
        article = article or "article"
    if ("hidden" in found or found.get("aria-hidden") == "true" or role in ROLES
            or "display:none" in found.get("style", "").replace(" ", "").lower()):
        return BY_ELEMENT, "", ""
    level = CONTENT
    if tag not in ("html", "body"):  # classes of the page or of the article speak of the whole layout
        if words & COMMENTS or not article and ADVERTS.intersection(names.split()):
            level = BY_CLASS
        elif not article and words & PURPOSE:
            level = BY_CLASS if not inside else DOUBTFUL if tag in BLOCK else CONTENT
    if level == CONTENT and "header" in words and not inside and not article:
        level = BY_CLASS
    return level, article, " ".join(sorted(w for w in words if w))


class Mark(str):
    """The element that is, or holds, the article; its kind as a string."""


def parse(page: str) -> tuple[Node, list[tuple[str, int, Mark | None, Node]]]:
    """The tree of block elements, and the blocks of text in page order:
    (text, how surely no content, article it is in, element). Work is in
    proportion to the page: an end tag without its element is not searched for."""
    root = Node("#")
    leaves: list[tuple[str, int, Mark | None, Node]] = []
    # element, node (None: inline), never, article, never of the nearest node
    stack = [("#", root, 0, None, 0)]
    tops = [0]                   # places in the stack that have a node
    inline: list[Counter] = [Counter()]  # per such place: open elements without one
    blocks: Counter = Counter()  # open elements that have a node
    buffer: list[str] = []
    at = 0
    last = page.rfind(">") + 1   # no tag ends behind it
    unclosed: set[str] = set()   # raw elements that no end tag follows

    def flush() -> None:
        if buffer:
            text = _SPACE.sub(" ", entities.unescape("".join(buffer))).strip()
            buffer.clear()
            if text:
                node = stack[tops[-1]][1]
                leaves.append((text, stack[-1][4], stack[-1][3], node))
                node.own.append(text)

    def close(k: int) -> None:
        """Leave all elements from place k of the stack on."""
        if tops[-1] >= k:
            flush()
        for name, node, *_ in reversed(stack[k:]):
            if node is None:
                inline[-1][name] -= 1
            else:
                blocks[name] -= 1
                tops.pop()
                inline.pop()
        del stack[k:]

    def say(text: str) -> None:
        if stack[-1][2] == stack[-1][4]:  # else in an inline element that is no content
            buffer.append(text)

    while m := _TAG.search(page, at, max(at, last)):
        if m.start() > at:
            say(page[at:m.start()])
        at = m.end()
        end, tag, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            if at == last and m[0].startswith("<!--") and not m[0].endswith("-->"):
                at = len(page)   # a comment without an end
            continue
        tag = tag.lower()
        if end:  # an element that has no node ends within the nearest that has one
            if inline[-1][tag] or blocks[tag]:
                close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag))
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            buffer.append(" ")
            continue
        if tag in RAW:
            if tag in FOREIGN and attrs.endswith("/") or tag in unclosed:
                continue
            stop = re.compile(f"</{tag}\\s*>", re.I).search(page, at)
            if stop or tag in ENDLESS:
                at = stop.end() if stop else len(page)
            else:  # only the tag itself
                unclosed.add(tag)
            continue
        if tag in BLOCK:
            shut = CLOSES.get(tag, {"p"} if tag not in ("html", "body", "head") else set())
            for i in reversed(tops[1:] if tag == "tr" else tops[1:][-1:]):
                name = stack[i][0]
                if name in shut:
                    close(i)
                    break
                if not (tag == "tr" and name in ("td", "th")):
                    break
            flush()
        _, _, never, article, base = stack[-1]
        own, marks, name = _purpose(tag, attrs, article is not None)
        node = None
        if tag in BLOCK and len(tops) <= DEPTH:
            node = Node(f"{tag} {name}" if name else tag)
            stack[tops[-1]][1].kids.append(node)
        if attrs.endswith("/") and tag not in BLOCK:
            continue
        low = max(never, own)
        if node is None:
            inline[-1][tag] += 1
        else:
            blocks[tag] += 1
            tops.append(len(stack))
            inline.append(Counter())
        if marks and not own and never < BY_ELEMENT and (article is None or article == "article" != marks):
            article = Mark(marks)
        stack.append((tag, node, low, article, low if node is not None else base))
    if at < len(page):
        say(page[at:])
    flush()
    return root, leaves


def _hash(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "replace"))


def fold(node: Node, shapes: dict | None = None) -> list:
    """The tree as nested lists [label, pages, {text hash: pages}, children,
    elements, shape]; a run of siblings of one shape is one node that holds the
    elements of all, so a long table is one row."""
    shapes = {} if shapes is None else shapes
    kids: list = []
    for k in node.kids:
        got = fold(k, shapes)
        if kids and kids[-1][5] == got[5]:
            _absorb(kids[-1], got)
        else:
            kids.append(got)
    key = (node.label, *(k[5] for k in kids))
    return [node.label, 1, None, kids, [node], shapes.setdefault(key, len(shapes))]


def _absorb(into: list, other: list) -> None:
    into[4] += other[4]
    for x, y in zip(into[3], other[3]):
        _absorb(x, y)


def _text_key(element: Node) -> str:
    return str(_hash("\n".join(element.own)))


class Alignment:
    """Simple tree matching of two trees. Nodes of one shape (label and shapes of
    the children) match others alike, so a pair of shapes is worked out once."""

    def __init__(self):
        self.ids: dict[tuple, int] = {}
        self.kids: list[tuple] = []   # by shape
        self.label: list[str] = []
        self.size: list[int] = []
        self.known: dict[int, tuple[int, list]] = {}  # the node is held: its id stays its own
        self.scores: dict[tuple[int, int], int] = {}

    def shape(self, node: list) -> int:
        held = self.known.get(id(node))
        if held is None:
            kids = tuple(self.shape(k) for k in node[3])
            s = self.ids.setdefault((node[0], kids), len(self.kids))
            if s == len(self.kids):
                self.kids.append(kids)
                self.label.append(node[0])
                self.size.append(1 + sum(self.size[k] for k in kids))
            held = self.known[id(node)] = s, node
        return held[0]

    def score(self, a: int, b: int) -> int:
        """The largest number of node pairs of equal labels that keeps order and ancestors."""
        if self.label[a] != self.label[b]:
            return 0
        if a == b:
            return self.size[a]
        if not self.kids[a] or not self.kids[b]:
            return 1
        got = self.scores.get((a, b))
        if got is None:
            pairs = self.pairs(self.kids[a], self.kids[b])
            got = self.scores[a, b] = 1 + sum(self.score(self.kids[a][i], self.kids[b][j]) for i, j in pairs)
        return got

    def pairs(self, xs: tuple, ys: tuple) -> list[tuple[int, int]]:
        """Index pairs of the children (as shapes) that the best matching joins."""
        n, m, head = len(xs), len(ys), 0
        while head < n and head < m and xs[head] == ys[head]:  # nothing matches them better
            head += 1
        while n > head and m > head and xs[n - 1] == ys[m - 1]:
            n, m = n - 1, m - 1
        out = [(i, i) for i in range(head)]
        blocks = -(-(n - head) * (m - head) // CELLS)
        for k in range(blocks):
            i0, i1 = (head + (n - head) * b // blocks for b in (k, k + 1))
            j0, j1 = (head + (m - head) * b // blocks for b in (k, k + 1))
            out += [(i0 + i, j0 + j) for i, j in self._best(xs[i0:i1], ys[j0:j1])]
        return out + [(n + i, m + i) for i in range(len(xs) - n)]

    def _best(self, xs: tuple, ys: tuple) -> list[tuple[int, int]]:
        best, pair = [[0] * (len(ys) + 1)], []
        rows: dict[int, list] = {}
        for x in xs:
            if x not in rows:
                mine = {y: self.score(x, y) for y in set(ys)}
                rows[x] = [mine[y] for y in ys]
            row, up, scores = [0], best[-1], rows[x]
            for j, w in enumerate(scores):
                row.append(max(up[j + 1], row[j], up[j] + w))
            best.append(row)
            pair.append(scores)
        i, j, out = len(xs), len(ys), []
        while i and j:
            w = pair[i - 1][j - 1]
            if w and best[i][j] == best[i - 1][j - 1] + w:
                out.append((i - 1, j - 1))
                i, j = i - 1, j - 1
            elif best[i][j] == best[i - 1][j]:
                i -= 1
            else:
                j -= 1
        return out[::-1]

    def children(self, xs: list, ys: list) -> list[tuple[int, int]]:
        return self.pairs(tuple(map(self.shape, xs)), tuple(map(self.shape, ys)))


def matching(a: list, b: list) -> int:
    """Number of node pairs of the best matching of two trees."""
    by = Alignment()
    return by.score(by.shape(a), by.shape(b))


def aligned(xs: list, ys: list) -> list[tuple[int, int]]:
    """Index pairs of the children that the best matching joins."""
    return Alignment().children(xs, ys)


def _add(a: dict, b: dict, pages_a: int, pages_b: int) -> dict:
    """Lossy counts {text: [pages, error]} of a part with those of another
    added, of so many pages each."""
    if pages_b >= BUCKET:
        for k in a.keys() - b.keys():
            a[k][1] += pages_b // BUCKET
    for k, (n, error) in b.items():
        held = a.setdefault(k, [0, pages_a // BUCKET])
        held[0] += n
        held[1] += error
    return a


def own_wrapper(tree: list) -> list:
    """A page as the wrapper of one page: [label, pages, {text: [pages, error]},
    children, error]. Texts are those of the single elements."""
    return [tree[0], 1, {_text_key(n): [1, 0] for n in tree[4] if n.own}, [own_wrapper(k) for k in tree[3]], 0]


def _late(w: list, missed: int) -> list:
    """A node that another part, which may have dropped it, does not have."""
    return [w[0], w[1], w[2], [_late(k, missed) for k in w[3]], w[4] + missed] if missed else w


def merged(a: list, b: list, pages_a: int | None = None, pages_b: int | None = None,
           by: Alignment | None = None) -> list:
    """Two wrappers of a host aligned; what only one has stays in its place."""
    by = by or Alignment()
    pages_a, pages_b = pages_a or a[1], pages_b or b[1]
    kids, i, j = [], 0, 0
    for x, y in [*by.children(a[3], b[3]), (len(a[3]), len(b[3]))]:
        kids += [_late(k, pages_b // BUCKET) for k in a[3][i:x]] + [_late(k, pages_a // BUCKET) for k in b[3][j:y]]
        if x < len(a[3]):
            kids.append(merged(a[3][x], b[3][y], pages_a, pages_b, by))
        i, j = x + 1, y + 1
    return [a[0], a[1] + b[1], _add(a[2], b[2], a[1], b[1]), kids, a[4] + b[4]]


def pruned(w: list, total: int | None = None) -> list:
    """Without nodes that at most a ``BUCKET``-th of the pages can have, and
    without such texts of a node: no template. Lossy counting: what is not held
    was on no more pages, and a new entry starts with that as its error."""
    total = total or w[1]
    texts = {k: v for k, v in w[2].items() if v[0] + v[1] > w[1] // BUCKET}
    return [w[0], w[1], texts, [pruned(k, total) for k in w[3] if k[1] + k[4] > total // BUCKET], w[4]]


def template_nodes(w: list, tree: list, out: set, parent: int | None = None,
                   by: Alignment | None = None) -> set:
    """Elements of a page whose text is constant in the aligned wrapper node; the
    node must be on a fair share of the pages that have its parent."""
    if w[1] >= MIN_PAGES and w[1] >= SHARE * (parent or w[1]):
        out.update(id(n) for n in tree[4] if n.own and w[2].get(_text_key(n), (0,))[0] >= CONSTANT * w[1])
    by = by or Alignment()
    for x, y in by.children(w[3], tree[3]):
        template_nodes(w[3][x], tree[3][y], out, w[1], by)
    return out


def host_of(url: F.Column) -> F.Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


WRAPPER = T.StructType([T.StructField("host", T.StringType()), T.StructField("part", T.IntegerType()),
                        T.StructField("wrapper", T.StringType())])


def induce(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, wrapper as JSON) over all pages, written."""
    src = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    src = src.where("host <> '' and html is not null")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine: dict[str, list] = {}
        for batch in batches:
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                new = own_wrapper(fold(parse(page)[0]))
                held = mine.get(host)
                new = merged(held, new) if held else new
                mine[host] = pruned(new) if new[1] % BUCKET == 0 else new
        part = TaskContext.get().partitionId() % PARTS
        hosts = sorted(mine)
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array([part] * len(hosts), pa.int32()),
             pa.array([json.dumps(mine[h]) for h in hosts], pa.string())], names=WRAPPER.names)

    def merge(key, pdf):
        import pandas as pd
        total = None
        for w in sorted(pdf["wrapper"]):
            w = json.loads(w)
            total = pruned(merged(total, w)) if total else w
        return pd.DataFrame({"host": [key[0]], "part": [0], "wrapper": [json.dumps(total)]})

    parts = src.mapInArrow(learn, WRAPPER).groupBy("host", "part").applyInPandas(merge, WRAPPER)
    whole = parts.groupBy("host").applyInPandas(merge, WRAPPER)
    return write_once(whole.select("host", "wrapper"), "wrappers")


def main_text(page: str | None, wrapper: list | None) -> str:
    if not page:
        return ""
    root, leaves = parse(page)
    fixed = template_nodes(wrapper, fold(root), set()) if wrapper else set()
    known = bool(wrapper) and wrapper[1] >= MIN_PAGES
    live = [x for x in leaves if x[1] <= (DOUBTFUL if known else CONTENT)]
    # an article in an element whose class alone speaks against it is taken
    # if the page has no other
    inside = [x for x in live if x[2]] or [x for x in leaves if x[2] and x[1] < BY_ELEMENT]
    slots, within = ([x for x in xs if id(x[3]) not in fixed] for xs in (live, inside))
    if inside and _narrows(inside, within, slots, known):
        return "\n".join(x[0] for x in within or inside)
    return "\n".join(x[0] for x in slots or live)


def _narrows(inside: list, within: list, slots: list, known: bool) -> bool:
    """Whether the text is in the article: always for main and its like and,
    without a wrapper, for an only article; else if no more slot text stands
    outside (an article may also be a teaser card)."""
    marks = {id(x[2]): x[2] for x in inside}.values()
    if any(m != "article" for m in marks) or (not known and len(marks) == 1):
        return True
    outside = sum(len(x[0]) for x in slots if not x[2])
    return outside <= sum(len(x[0]) for x in within)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            wrappers: DataFrame | None = None) -> DataFrame:
    """One row per page: id, url, text, n_chars (code points of the text)."""
    wrappers = induce(pages, url_col, html_col) if wrappers is None else wrappers
    src = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.col(html_col).alias("_html"),
                       host_of(F.col(url_col)).alias("_host"))
    schema = T.StructType([
        T.StructField(id_col, src.schema["_id"].dataType), T.StructField(url_col, src.schema["_url"].dataType),
        T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    shared = None
    size = wrappers.agg(F.sum(F.octet_length("host") + F.octet_length("wrapper"))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        shared = pages.sparkSession.sparkContext.broadcast(
            {r["host"]: r["wrapper"] for r in wrappers.toLocalIterator()})
    else:
        src = src.join(wrappers.withColumnRenamed("host", "_host"), "_host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list] = {}
        for batch in batches:
            col = lambda c: batch.column(batch.schema.get_field_index(c))
            texts = []
            given = col("wrapper").to_pylist() if shared is None else [None] * batch.num_rows
            for host, page, w in zip(col("_host").to_pylist(), col("_html").to_pylist(), given):
                if host not in known:
                    w = shared.value.get(host) if shared is not None else w
                    if len(known) > 2000:
                        known.clear()
                    known[host] = json.loads(w) if w else None
                texts.append(main_text(page, known[host]))
            yield pa.RecordBatch.from_arrays(
                [col("_id"), col("_url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=schema.names)

    return src.mapInArrow(run, schema)
