"""Main text of web pages by wrapper induction.

Pages of one host come from a few layouts. The DOM trees of all different pages of a host are aligned by simple tree
matching, in outlines that hold digests in place of texts, and counted in trees that are added up: first those of a task,
then those of a host. What most pages of a layout that have a node there have with the same text is template, what
varies is a slot. Every page is then aligned with the layout it fits best, its constant nodes are dropped, and the text
is read from the slots of the main container. Names (menu, sidebar, comments and the like) are weak evidence: they set aside a part that holds the
lesser share of what varies on a page, and never one around its article or main element.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantroom.llm.shared import stored
from plantroom.llm.words import pieces

#: A text is constant at its node if this share of the pages that have the node have it, if they are this share of the
#: layout's pages, and at least LEAST of them. Layouts of fewer pages need all of these, two at least, and have no
#: constants inside the main container, where two pages may well share a paragraph.
CONSTANT, SELDOM, LEAST = 0.8, 0.02, 4
#: Two trees are of one layout if this share of their nodes is paired. Further layouts join the one they fit best.
ALIKE, LAYOUTS = 0.5, 32
#: Texts counted at a node: beyond these the rarer half is forgotten, and how much that takes off the others is kept.
#: Runs below a node: beyond these, runs that less than half of SELDOM of the pages have are forgotten, which are no constants.
TEXTS, RUNS = 64, 400
#: Elements nested deeper are read as part of the one above.
DEPTH = 200

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>", re.S
)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe noembed xmp svg math".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
_CLOSES_P = _BLOCK - frozenset("body caption dd dt html legend li summary tbody td tfoot th thead tr".split())
_CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
_SKIPPED = frozenset("head script style noscript template iframe svg math nav footer button select textarea input menu object canvas audio video".split())
#: Elements that are weak evidence as the words are: whole pages stand in a form.
_WEAK = frozenset("aside form dialog".split())
_HINT = frozenset(
    "ad ads adv advert adverts advertisement advertising banner banners sponsor sponsored promo promotion nav navbar navigation menu menus breadcrumb "
    "breadcrumbs sidebar side aside footer foot header masthead topbar toolbar cookie cookies consent notice notices alert popup modal overlay subscribe "
    "newsletter signup login search share sharing social related recommended comment comments discussion disqus replies respond form widget widgets "
    "pagination pager skip copyright legal disclaimer complementary contentinfo".split()
)
#: Before a word these say what a page or part has or lacks, not what it is.
_STATE = frozenset("has have no not with without is".split())


class Node:
    """An element: label (tag with classes and id), children (nodes and texts), whether it is no content; `weak` if only
    its name says so, which `settle` weighs against what it holds."""

    __slots__ = ("tag", "label", "children", "aside", "weak")

    def __init__(self, tag: str, label: str, aside: bool, weak: bool = False):
        self.tag, self.label, self.children, self.aside, self.weak = tag, label, [], aside, weak


def _hints(value: str) -> bool:
    """Whether one of the names in an attribute is made of a word that hints at no content."""
    for name in value.split():
        words = [w for w in re.split(r"[^a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower()) if w]
        if words and words[0] not in _STATE and not _HINT.isdisjoint(words):
            return True
    return False


def _element(tag: str, attributes: str) -> Node:
    label, aside, weak, main = tag, tag in _SKIPPED, tag in _WEAK, False
    if attributes and ("=" in attributes or "hidden" in attributes.lower()):
        for name, a, b, c in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), a or b or c
            if name == "hidden" or name == "aria-hidden":
                aside |= name == "hidden" or value.lower() == "true"
            elif name in ("class", "id", "role"):
                weak |= tag not in ("html", "body", "article", "main") and _hints(value)
                main |= name == "role" and value.lower() == "main"
                label += "." + re.sub(r"\d+", "", value.lower())
    return Node("main" if main else tag, label, aside, weak and not main)


def parse(text: str) -> Node:
    """The tree of a page; tolerant of missing, stray and crossed tags. Comments are left out."""
    root = Node("html", "html", False)
    stack, deeper, at = [root], [], 0
    for token in iter(lambda: _TOKEN.search(text, at), None):
        if token.start() > at:
            stack[-1].children.append(text[at : token.start()])
        at = token.end()
        name = token[2] or token[5]
        if name is None:
            continue
        tag, closing, attributes = name.lower(), token[1] or token[4], token[3] or token[6] or ""
        if closing:
            if deeper and tag in deeper:
                deeper.remove(tag)
                continue
            for place in range(len(stack) - 1, 0, -1):
                if stack[place].tag == tag or stack[place].label.split(".")[0] == tag:
                    del stack[place:]
                    break
                if tag not in _BLOCK and stack[place].tag in _BLOCK:
                    break
            continue
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}(?:\s[^>]*)?/?>|\Z", re.I).search(text, at)
            at = end.end()
            continue
        if tag in ("html", "body", "head"):
            if tag == "head" or any(n.tag == tag for n in stack):
                if tag == "head":
                    stack[-1].children.append(node := Node("head", "head", True))
                    stack.append(node)
                continue
            if stack[-1].tag == "head":
                stack.pop()
        if tag in _CLOSES_P:
            for place in range(len(stack) - 1, 0, -1):
                if stack[place].tag == "p":
                    del stack[place:]
                    break
                if stack[place].tag in _BLOCK:
                    break
        elif tag in _CLOSED_BY:
            closed, bounds = _CLOSED_BY[tag]
            for place in range(len(stack) - 1, 0, -1):
                if stack[place].tag in closed:
                    del stack[place:]
                    if tag != "tr":
                        break
                elif stack[place].tag in bounds:
                    break
        if tag in _VOID:
            stack[-1].children.append(Node(tag, tag, False))
        elif len(stack) >= DEPTH:
            deeper.append(tag)
        else:
            node = _element(tag, attributes)
            stack[-1].children.append(node)
            if not attributes.endswith("/") or tag in _BLOCK:
                stack.append(node)
    if at < len(text):
        stack[-1].children.append(text[at:])
    return root


def _plain(text: str) -> str:
    return " ".join(html.unescape(text).split())


def text_of(node: Node | str) -> str:
    """All text below a node, for comparing nodes."""
    if isinstance(node, str):
        return _plain(node)
    return " ".join(filter(None, map(text_of, node.children)))


def settle(tree: Node, constant: set[int], induced: bool = False) -> None:
    """Sets aside the weak nodes of a page, but those that hold a main element, an article where none stands elsewhere,
    the headline, or more than half of what varies on the page. Beside a main element only what stands in it can hold
    most. With a template (`induced`), a headline is known by varying; without one only an article's own is."""
    chars: dict[int, int] = {}
    holds: dict[int, frozenset] = {}
    free = False

    def weigh(node: Node, below_weak: bool, inside: bool) -> None:
        nonlocal free
        size, held = 0, set()
        inside = inside or node.tag in ("article", "main")
        below_weak = below_weak or node.weak
        free |= node.tag in ("article", "main") and not below_weak
        for child in node.children:
            if id(child) in constant:
                continue
            if isinstance(child, str):
                size += len(child.strip())
            elif not child.aside:
                weigh(child, below_weak, inside)
                size += chars[id(child)]
                held |= holds[id(child)]
        if node.tag in ("article", "main"):
            held.add(node.tag)
        if node.tag == "h1" and size and (inside or induced):
            held.add("h1")
        chars[id(node)], holds[id(node)] = size, frozenset(held)

    weigh(tree, False, False)
    total = chars[id(tree)]

    named = "main" in holds[id(tree)]

    def decide(node: Node, inside: bool) -> None:
        if id(node) not in chars:
            return
        inside = inside or node.tag == "main"
        if node.weak:
            held = holds[id(node)]
            most = 2 * chars[id(node)] > total and (inside or not named)
            node.aside = not ("main" in held or "h1" in held or ("article" in held and not free and not named) or most)
        for child in node.children:
            if isinstance(child, Node):
                decide(child, inside)

    decide(tree, False)


def _digest(text: str) -> str:
    return hashlib.md5(text.encode("utf-8", "surrogatepass")).hexdigest()[:16]


def runs(node: Node) -> list[tuple[str, list]]:
    """Children in order, neighbours of one label together: a list has as many items as it likes in one run."""
    out: list[tuple[str, list]] = []
    for child in node.children:
        if isinstance(child, str):
            if not child.strip():
                continue
            label = "#"
        else:
            label = child.label
        if out and out[-1][0] == label:
            out[-1][1].append(child)
        else:
            out.append((label, [child]))
    return out


def outline(node: Node) -> list:
    """A tree without its texts: label, and runs as [label, digest, characters that count as content, outline below]."""
    out = []
    for label, members in runs(node):
        text = " ".join(map(text_of, members))
        apart = isinstance(members[0], Node) and members[0].aside
        below = outline(members[0]) if len(members) == 1 and isinstance(members[0], Node) else None
        out.append([label, _digest(text), 0 if apart else len(text), below])
    return [node.label, out]


def size_of(tree: list) -> int:
    """Nodes of an outline or of a template that simple tree matching can pair."""
    return 1 + sum(size_of(run[-1]) if run[-1] else 1 for run in tree[1])


def _pairs(ours: list, theirs: list) -> tuple[int, list]:
    """Simple tree matching: the largest number of nodes of two trees paired in order, and the pairs of runs below."""
    a, b = ours[1], theirs[1]
    both = lambda x, y: _pairs(x[-1], y[-1])[0] if x[-1] and y[-1] else 1
    if [x[0] for x in a] == [y[0] for y in b]:
        return 1 + sum(map(both, a, b)), list(zip(a, b, strict=True))
    # weights of pairs with something below; all other pairs weigh 1
    deep: dict[tuple[int, int], int] = {}
    best = [array("q", bytes(8 * (len(b) + 1)))]
    for i, x in enumerate(a):
        above, row, here = best[-1], array("q", [0]), 0
        for j, y in enumerate(b):
            here = max(here, above[j + 1])
            if x[0] == y[0]:
                weight = 1
                if x[-1] and y[-1]:
                    weight = deep[i, j] = both(x, y)
                here = max(here, above[j] + weight)
            row.append(here)
        best.append(row)
    pairs, i, j = [], len(a), len(b)
    while i and j:
        if a[i - 1][0] == b[j - 1][0] and best[i][j] == best[i - 1][j - 1] + deep.get((i - 1, j - 1), 1):
            pairs.append((a[i - 1], b[j - 1]))
            i, j = i - 1, j - 1
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return 1 + best[-1][-1], pairs[::-1]


def counted(tree: list) -> list:
    """One page as a counted tree: label, and runs as [label, pages, pages by digest, characters by digest, characters in
    all, pages that forgetting took off a digest, counted tree below]."""
    return [tree[0], [[label, 1, {digest: 1}, {digest: chars}, chars, 0, counted(below) if below else None] for label, digest, chars, below in tree[1]]]


def add(ours: list, theirs: list, pages: int) -> None:
    """Adds one counted tree to another: runs that simple tree matching pairs are added, all others stand beside them.

    The sum is of so many pages. Below a node with very many runs those that hardly any page has are forgotten: a run
    that SELDOM of the pages have, as a constant must, is never among them.
    """
    met = _pairs(ours, theirs)[1]
    paired = {id(y): x for x, y in met}
    out, place = [], {id(x): k for k, x in enumerate(ours[1])}
    done = 0
    for run in theirs[1]:
        own = paired.get(id(run))
        if own is None:
            out.append(run)
            continue
        out += ours[1][done : place[id(own)] + 1]
        done = place[id(own)] + 1
        own[1] += run[1]
        own[4] += run[4]
        for digest, n in run[2].items():
            own[2][digest] = own[2].get(digest, 0) + n
            own[3][digest] = own[3].get(digest, 0) + run[3][digest]
        own[5] += run[5]
        if len(own[2]) > TEXTS:
            _forget(own)
        if own[-1] and run[-1]:
            add(own[-1], run[-1], pages)
        else:
            own[-1] = own[-1] or run[-1]
    out += ours[1][done:]
    if len(out) > RUNS:
        rare = SELDOM / 2 * pages
        rest = sum(run[4] for run in out if run[1] < rare)
        # no run has this label: characters of what is forgotten still count as varying
        out = [run for run in out if run[1] >= rare] + [["", 0, {}, {}, rest, 0, None]]
    ours[1][:] = out


def _forget(run: list) -> None:
    """Of the texts at a node only frequent ones stay counted: what the rarest kept one has is taken off all of them. No
    count is short by more than the sum of that, less than two in TEXTS pages; one that stands in all parts by just it."""
    less = sorted(run[2].values(), reverse=True)[TEXTS // 2]
    run[5] += less
    run[2] = {d: n - less for d, n in run[2].items() if n > less}
    run[3] = {d: run[3][d] for d in run[2]}


class Layouts:
    """The counted trees of a host's layouts, with their pages."""

    def __init__(self):
        self.trees: list[list] = []
        self.known: dict[str, int] = {}

    def place(self, tree: list) -> int | None:
        """The layout that a tree fits best, by the share of nodes that are paired, if it fits one."""
        size = size_of(tree)
        found = [(2 * _pairs(own, tree)[0] / (size_of(own) + size), -k) for k, (_, own) in enumerate(self.trees)]
        share, k = max(found, default=(0.0, 0))
        return -k if found and (share >= ALIKE or len(self.trees) >= LAYOUTS) else None

    def take(self, tree: list, pages: int = 1) -> None:
        """Adds a counted tree of so many pages."""
        shape = _digest(_shape(tree))
        k = self.known.get(shape)
        if k is None:
            k = self.place(tree)
            if len(self.known) < 10_000:
                self.known[shape] = len(self.trees) if k is None else k
        if k is None:
            self.trees.append([pages, tree])
        else:
            self.trees[k][0] += pages
            add(self.trees[k][1], tree, self.trees[k][0])


def _shape(tree: list) -> str:
    return tree[0] + "(" + ",".join(_shape(run[-1]) if run[-1] else run[0] for run in tree[1]) + ")"


class Template:
    """A node of a layout. `slots` are its runs: label, digest of the constant text or None, whether as many pages have it
    as a constant in the main container needs, template below or None; `share` is the varying text seen below it. At the
    root of a host's template, `others` are the further layouts."""

    __slots__ = ("label", "slots", "share", "others", "drawn")

    def __init__(self, label: str, slots: list, share: int, others: list | None = None):
        self.label, self.slots, self.share, self.others, self.drawn = label, slots, share, others or [], None

    def packed(self) -> list:
        return [self.label, [[a, b, t, c.packed() if c else None] for a, b, t, c in self.slots], self.share, [o.packed() for o in self.others]]

    @classmethod
    def unpacked(cls, value: list) -> Template:
        slots = [[a, b, t, cls.unpacked(c) if c else None] for a, b, t, c in value[1]]
        return cls(value[0], slots, value[2], [cls.unpacked(o) for o in value[3]])

    def tree(self) -> list:
        if self.drawn is None:
            self.drawn = [self.label, [[slot[0], slot, slot[3].tree() if slot[3] else None] for slot in self.slots]]
        return self.drawn


def _template(tree: list, pages: int) -> Template:
    """What is constant in a counted tree of so many pages; runs that one page of many has are left out."""
    slots, share = [], 0
    for label, n, digests, chars, size, less, below in tree[1]:
        if n < min(2, pages):
            share += size
            continue
        digest, same = max(digests.items(), key=lambda x: (x[1], x[0]), default=(None, 0))
        constant = same > 0 and same + less >= CONSTANT * n and n >= max(2, min(LEAST, pages)) and n >= SELDOM * pages
        share += size - chars[digest] if constant else size
        slots.append([label, digest if constant else None, n >= LEAST, _template(below, pages) if below else None])
    return Template(tree[0], slots, share)


def host_template(layouts: Layouts) -> Template:
    """The template of a host: that of its commonest layout, with those of the others."""
    first, *others = [_template(tree, pages) for pages, tree in sorted(layouts.trees, key=lambda x: -x[0])]
    first.others = others
    return first


def matching(template: Template, node: Node) -> list:
    """The pairs of slots and of runs of a page below a node, by simple tree matching."""
    theirs = runs(node)
    if [s[0] for s in template.slots] == [r[0] for r in theirs]:
        return list(zip(template.slots, theirs, strict=True))
    tree = [node.label, [[label, (label, members), _skeleton(members)] for label, members in theirs]]
    return [(a[1], b[1]) for a, b in _pairs(template.tree(), tree)[1]]


def _skeleton(members: list) -> list | None:
    if len(members) != 1 or not isinstance(members[0], Node):
        return None
    return [members[0].label, [[label, below, _skeleton(below)] for label, below in runs(members[0])]]


def fitting(template: Template, node: Node) -> Template:
    """Of a host's layouts, the one with the largest share of nodes paired with a page's."""
    if not template.others:
        return template
    tree = _skeleton([node])
    share = lambda t: 2 * _pairs(t, tree)[0] / (size_of(t) + size_of(tree))
    found = [template, *template.others]
    return max(enumerate(found), key=lambda x: (share(x[1].tree()), -x[0]))[1]


def outlined(page: str) -> list:
    tree = parse(page)
    settle(tree, set())
    return outline(tree)


def induce(pages: list[str]) -> Template:
    """The template of different pages of one host; of a single page, nothing is constant."""
    layouts = Layouts()
    for page in pages:
        layouts.take(counted(outlined(page)))
    return host_template(layouts)


def _constants(template: Template, node: Node, found: set[int], inside: bool) -> None:
    """Nodes and texts of a page that its template holds, by identity. In the main container only if enough pages do."""
    for slot, (_, members) in matching(template, node):
        constant = slot[1] is not None and slot[1] == _digest(" ".join(map(text_of, members)))
        within = inside or any(isinstance(m, Node) and m.tag in ("article", "main") for m in members)
        if constant and (slot[2] or not within):
            found.update(map(id, members))
        elif slot[3] is not None and len(members) == 1 and isinstance(members[0], Node):
            _constants(slot[3], members[0], found, within)


def _mains(node: Node) -> list[Node]:
    """The outermost articles or main elements that are not set aside."""
    if node.aside:
        return []
    if node.tag in ("article", "main"):
        return [node]
    return [m for c in node.children if isinstance(c, Node) for m in _mains(c)]


def _induced_main(template: Template, node: Node) -> Node:
    """Down from the root, the child that holds most of what varies on the host's pages."""
    while True:
        inner = [(s[3], m[0]) for s, (_, m) in matching(template, node) if s[3] is not None and len(m) == 1 and isinstance(m[0], Node) and not m[0].aside]
        below = sum(t.share for t, _ in inner)
        chosen = max(inner, key=lambda x: x[0].share, default=None)
        if chosen is None or 2 * chosen[0].share <= template.share + below or chosen[1].tag not in _BLOCK or chosen[1].tag in ("p", "ul", "ol", "table"):
            return node
        template, node = chosen


def _blocks(node: Node, constant: set[int], out: list[list[str]]) -> None:
    for child in node.children:
        if id(child) in constant:
            continue
        if isinstance(child, str):
            out[-1].append(child)
        elif child.tag == "br":
            out[-1].append(" ")
        elif not child.aside:
            block = child.tag in _BLOCK
            if block:
                out.append([])
            _blocks(child, constant, out)
            if block:
                out.append([])


def extract(page: str, template: Template | None, references: int) -> str:
    """The main text of a page."""
    tree = parse(page)
    constant: set[int] = set()
    if template is not None and references > 1:
        template = fitting(template, tree)
        _constants(template, tree, constant, False)
    settle(tree, constant, template is not None and references > 1)
    mains = _mains(tree)
    if not mains:
        mains = [_induced_main(template, tree) if template is not None else tree]
    out: list[list[str]] = [[]]
    for main in mains:
        out.append([])
        _blocks(main, constant, out)
    return "\n".join(filter(None, (_plain("".join(b)) for b in out)))


def _host(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)), F.lit(""))


def templates(pages: DataFrame) -> DataFrame:
    """host, template, references (its different pages) of every host.

    Copies of a page collapse by their digest; then each task adds up the outlines it has, one host after the other, and
    only counted trees of hosts meet: as many as there are tasks, however many pages a host has.
    """
    keyed = pages.select(_host(F.col("url")).alias("host"), "html")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "html"):
            html = batch.column("html").to_pylist()
            digests = [hashlib.md5(page.encode("utf-8", "surrogatepass")).digest() for page in html]
            outlines = [json.dumps(outlined(page), separators=(",", ":")) for page in html]
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(digests, pa.binary()), pa.array(outlines, pa.string())], names=["host", "digest", "outline"])

    different = keyed.mapInArrow(read, "host string, digest binary, outline string").groupBy("host", "digest").agg(F.first("outline").alias("outline"))

    def rows(host: str, layouts: Layouts) -> pa.RecordBatch:
        trees = [json.dumps(tree, separators=(",", ":")) for _, tree in layouts.trees]
        return pa.RecordBatch.from_arrays([pa.array([host] * len(trees)), pa.array([n for n, _ in layouts.trees], pa.int64()), pa.array(trees)], names=["host", "pages", "tree"])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, layouts = None, Layouts()
        for batch in batches:
            for host, packed in zip(batch.column("host").to_pylist(), batch.column("outline").to_pylist(), strict=True):
                if host != at:
                    if layouts.trees:
                        yield rows(at, layouts)
                    at, layouts = host, Layouts()
                layouts.take(counted(json.loads(packed)))
        if layouts.trees:
            yield rows(at, layouts)

    parts = different.sortWithinPartitions("host", "digest").select("host", "outline").mapInArrow(align, "host string, pages long, tree string")

    def merge(group: pa.Table) -> pa.Table:
        layouts, counts = Layouts(), group.column("pages").to_pylist()
        for pages, packed in sorted(zip(counts, group.column("tree").to_pylist(), strict=True), key=lambda x: (-x[0], x[1])):
            layouts.take(json.loads(packed), pages)
        template = json.dumps(host_template(layouts).packed(), separators=(",", ":"))
        return pa.table({"host": group.column("host").slice(0, 1), "template": [template], "references": pa.array([sum(counts)], pa.int64())})

    return stored(parts.groupBy("host").applyInArrow(merge, "host string, template string, references long"), "templates")


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page; text is empty where a page has none.

    One row for each row of the input. Null html counts as empty; pages without url or host share one template; further
    columns are ignored. Nothing is cut: pages are read whole, however long or deeply nested.
    """
    pages = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    held = templates(pages)
    joined = pages.withColumn("host", _host(F.col("url"))).join(held, "host", "left").select("page_id", "url", "template", "references", "html")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Template] = {}
        for batch in pieces(batches, "html"):
            found = []
            for packed, references, page in zip(*(batch.column(c).to_pylist() for c in ("template", "references", "html")), strict=True):
                if packed is not None and packed not in known:
                    if len(known) > 500:
                        known.clear()
                    known[packed] = Template.unpacked(json.loads(packed))
                found.append(extract(page, known.get(packed), references or 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    kinds = joined.schema
    return joined.mapInArrow(read, f"page_id {kinds['page_id'].dataType.simpleString()}, url {kinds['url'].dataType.simpleString()}, text string, n_chars long")
