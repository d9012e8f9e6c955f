"""Main text of web pages by wrapper induction.

Pages of one host come from few templates. Pages are grouped by host, a host with many pages into several groups, and the
DOM trees of a group are aligned by simple tree matching: the greatest number of node pairs that keeps parents and the order
of siblings, found by dynamic programming over the children of matched nodes. The first tree grows into a wrapper; each
further tree is aligned with it, and what finds no partner is added. A wrapper node knows on how many pages it occurs and how many
different texts it has had there:

* constant nodes (one text on nearly all of enough different pages) are template, as are the nodes that a page's own mark-up declares
  as such (navigation, header, footer, aside, forms, adverts, notices, comments ...) by tag, role or a whole class or id,
* varying nodes are slots. The slots below the wrapper's article node (or main node) are the content; without such a node, all slots
  outside the template are, but for lists that are mostly links.

Pages that are equal or hold the same article count once for a wrapper, so copies don't turn an article into a template. A
host with few pages has no constant nodes, and only the declared template goes. Declared classes never hide a page's only
articles, and a template word within a longer class or id counts only where the alignment finds that container constant.
"""

from __future__ import annotations

import html
import re
import zlib
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlehouse.llm.common import checkpoint
from candlehouse.llm.url_filter import host_of

#: Different pages of a group on average; larger hosts are split.
GROUP_PAGES = 64
#: Buckets of page hashes that tell pages that may be repeated.
BUCKETS = 1 << 20
#: Different pages that a constant node needs, and the share of them on which its text must be the same.
SUPPORT, SAME = 6, 0.9
#: Share of the words of two pages' regions that make them the same article for a wrapper.
ALIKE = 0.75
#: A longer constant text is content that pages share, not template.
TEMPLATE_WORDS = 40
#: Children that tree matching aligns by dynamic programming; longer lists are aligned in order by their tags.
WIDE = 60
#: Deeper elements are taken as siblings, so no page exhausts the stack.
DEEPEST = 120

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li listing main menu nav ol optgroup option p pre search section
summary table tbody td tfoot th thead tr ul""".split())
DROPPED = frozenset("""script style noscript template nav header footer aside form button select option textarea input iframe object embed
applet svg canvas math audio video map menu dialog title head noembed noframes datalist""".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
CLOSED_BY = {
    "p": BLOCK - {"body", "html", "option", "optgroup", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"},
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"}, "tr": {"tr", "tbody", "tfoot", "thead"},
    "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"},
    "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"},
}
SCOPE = frozenset("html body table td th ul ol dl div article section main aside nav header footer form blockquote fieldset".split())

# Words in class or id that declare template: alone, together, or with the words of _PARTS. A name that holds one beside other
# words ("share-price") declares nothing; such a container goes only where the alignment finds its text constant.
_WORDS = """ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar side menu nav navbar
navigation breadcrumb breadcrumbs header masthead footer foot comment comments disqus replies cookie cookies consent gdpr notice notices
notification alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended
recommendations pagination pager widget toolbar search copyright""".split()
TEMPLATE = frozenset(_WORDS)
_PARTS = frozenset("""area articles bar box button buttons container form icon icons items link links list posts site stories
wrapper""".split())
#: Hosts of several groups that are broadcast at most, by name and a number.
LARGE_HOSTS = 100_000
#: Words that parts of an article are named by as well: inside one the alignment decides on them.
OPEN_WORDS = frozenset("foot footer header masthead menu notice notices notification search side".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose id is an anchor of their text rather than a name of their part of the page.
ANCHORS = frozenset("h1 h2 h3 h4 h5 h6 p section li dt dd span a b i em strong td th tr".split())
#: Elements that a word within a longer name may mark for the alignment.
CONTAINERS = BLOCK - {"h1", "h2", "h3", "h4", "h5", "h6", "p", "body", "html", "article", "main"}

_TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)
|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*?)(/?)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S | re.X)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_SPLIT = re.compile(r"[^a-z0-9]+")


@dataclass(slots=True, eq=False)
class Node:
    tag: str
    key: str  # what two nodes must share to match
    template: bool = False
    soft: bool = False  # template by class, id or as a form: what doesn't hide an article
    hinted: bool = False  # holds a template word in a longer name
    parent: Node | None = None
    depth: int = 0
    children: list = field(default_factory=list)  # nodes and texts
    elements: list = field(default_factory=list)  # nodes alone
    # of a page's node: where it was aligned, its own text, and of a hinted one the text of all it holds
    wrapper: Node | None = None
    mark: int = 0
    words: int = 0
    whole: int = 0
    # of wrapper nodes
    pages: int = 0
    texts: dict = field(default_factory=dict)
    wholes: dict = field(default_factory=dict)


def parse(page: str) -> Node:
    """A tree of elements and decoded texts. Any text gives a tree; wrong nesting is mended as browsers do in the common cases."""
    root = Node("html", "html")
    at, here = 0, root
    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            break
        if m.start() > at:
            here.children.append(html.unescape(page[at:m.start()]))
        at = m.end()
        name = m[2] or m[6]
        if not name:
            continue
        tag, closing, attributes = name.lower(), m[1] or m[5], (m[3] if m[2] else m[7]) or ""
        if closing:
            node = here
            while node is not root and node.tag != tag:
                if node.tag in SCOPE and tag not in SCOPE:  # an inline or paragraph end doesn't close a container
                    node = root
                    break
                node = node.parent
            if node is not root:
                here = node.parent
            continue
        if tag in ("html", "body"):
            tag = "body" if tag == "body" else "html"
            if tag == "html":
                continue
        if tag in BLOCK:  # a block ends the inline elements and paragraphs around it
            node = here
            while node is not root and node.tag not in SCOPE:
                if tag in CLOSED_BY.get(node.tag, ()):
                    here = node.parent
                node = node.parent
            if node.tag in ("td", "th") and tag in CLOSED_BY[node.tag]:
                here = node.parent
                if here.tag == "tr" and tag in CLOSED_BY["tr"]:
                    here = here.parent
                if here.tag in CLOSED_BY and tag in CLOSED_BY[here.tag]:
                    here = here.parent
        declared, soft, hinted, label = _declared(tag, attributes)
        if soft and _open(tag, label, here):
            declared, soft, hinted = False, False, tag in CONTAINERS
        node = Node(tag, f"{tag} {label}" if label else tag, declared, soft, hinted, here, here.depth + 1)
        here.children.append(node)
        here.elements.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            stop = end.start() if end else len(page)
            if tag not in DROPPED:
                node.children.append(html.unescape(page[at:stop]))
            at = end.end() if end else len(page)
        elif tag not in VOID and node.depth < DEEPEST and not (m[4] and tag not in BLOCK and tag not in ("a", "b", "i", "span", "em", "strong")):
            here = node
    if at < len(page):
        here.children.append(html.unescape(page[at:]))
    _reveal(root)
    return root


def _reveal(root: Node) -> None:
    """Where all articles (without any, all main nodes) lie in template by class, id or form, these ancestors are none."""
    for tag in ("article", "main"):
        seen, hidden = False, []
        stack = [(root, ())]
        while stack:
            node, above = stack.pop()
            for c in node.elements:
                if c.tag == tag:
                    if not above:
                        seen = True
                    hidden.append(above)
                elif not c.template:
                    stack.append((c, above))
                elif c.soft:
                    stack.append((c, (*above, c)))
        for above in [] if seen else hidden:
            for node in above:
                if node.template:
                    node.template, node.key = False, node.key + " shown"
        if hidden:
            return


def _open(tag: str, label: str, above: Node) -> bool:
    """Whether a class or id says too little to go by: that of a heading, and in an article one of ``OPEN_WORDS`` alone."""
    if tag in HEADINGS:
        return True
    words_ = {w for w in _SPLIT.split(label) if w in TEMPLATE}
    if not words_ or not words_ <= OPEN_WORDS:
        return False
    while above is not None and above.tag not in ("article", "main"):
        above = above.parent
    return above is not None


def _known(token: str) -> bool:
    parts = [w for w in _SPLIT.split(token) if w and not w[0].isdigit()]
    return any(w in TEMPLATE for w in parts) and all(w in TEMPLATE or w in _PARTS for w in parts)


def _declared(tag: str, attributes: str) -> tuple[bool, bool, bool, str]:
    """Whether tag and attributes declare template, whether only softly, whether a name hints at it, and the class nodes are matched by."""
    firm, soft, hinted, label = tag in DROPPED and tag != "form", tag == "form", False, ""
    if attributes and "=" in attributes or "hidden" in attributes:
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), html.unescape(value.strip("\"'")).lower()
            if name in ("class", "id"):
                if name == "class" or not label:
                    label = value
                if tag not in ("body", "article", "main", "html"):
                    if (name == "class" or tag not in ANCHORS) and any(_known(t) for t in value.split()):
                        soft = True
                    elif tag in CONTAINERS:
                        hinted = hinted or any(w in TEMPLATE for w in _SPLIT.split(value))
            elif name == "role":
                firm = firm or value in ROLES
            elif name == "hidden" or name == "aria-hidden" and value == "true":
                firm = True
    return firm or soft, soft and not firm, hinted and not firm and not soft, label


def own_text(node: Node) -> str:
    """A node's text outside of block elements and template, white space turned into one space each."""
    parts: list[str] = []

    def walk(n: Node) -> None:
        for c in n.children:
            if type(c) is str:
                parts.append(c)
            elif c.tag == "br" or c.tag in BLOCK:
                parts.append(" ")
            elif not c.template:
                walk(c)

    walk(node)
    return " ".join("".join(parts).split())


def match(a: list[Node], b: list[Node]) -> list[tuple[int, int]]:
    """Simple tree matching of two sibling lists: pairs (i, j), in order, whose subtrees share the most nodes."""
    if not a or not b:
        return []
    if len(a) > WIDE or len(b) > WIDE:
        out, j = [], 0
        for i, x in enumerate(a):
            k = next((k for k in range(j, min(j + WIDE, len(b))) if b[k].key == x.key), None)
            if k is not None:
                out.append((i, k))
                j = k + 1
        return out
    if [x.key for x in a] == [y.key for y in b] and not any(x.elements and not x.template for x in a):
        return [(i, i) for i in range(len(a))]
    weight = [[0 if x.key != y.key else 1 if x.template or not x.elements or not y.elements else _shared(x, y) for y in b] for x in a]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        row, below, w = best[i], best[i + 1], weight[i]
        for j in range(len(b) - 1, -1, -1):
            row[j] = max(below[j], row[j + 1], below[j + 1] + w[j])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if weight[i][j] and best[i][j] == best[i + 1][j + 1] + weight[i][j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i][j] == best[i + 1][j]:
            i += 1
        else:
            j += 1
    return out


def _shared(a: Node, b: Node) -> int:
    """Nodes of the best match of two subtrees whose roots match; what template holds doesn't count."""
    x, y = a.elements, b.elements
    if a.template or not x or not y:
        return 1
    if len(x) * len(y) >= 400:
        return 1 + min(len(x), len(y))
    return 1 + sum(_shared(x[i], y[j]) for i, j in match(x, y))


def _mark(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) if text else 0


def whole_text(node: Node) -> str:
    parts: list[str] = []

    def walk(n: Node) -> None:
        for c in n.children:
            if type(c) is str:
                parts.append(c)
            elif not c.template:
                parts.append(" ")
                walk(c)

    walk(node)
    return " ".join("".join(parts).split())


def regions(tree: Node) -> list[Node]:
    """The article nodes of a page, else its main nodes, else none."""
    found: list[Node] = []

    def walk(node: Node, tag: str) -> None:
        for c in node.elements:
            if c.tag == tag:
                found.append(c)
            elif not c.template:
                walk(c, tag)

    for tag in ("article", "main"):
        walk(tree, tag)
        if found:
            break
    return found


class Wrapper:
    """The aligned template of a group of pages."""

    def __init__(self) -> None:
        self.root = Node("html", "html")
        self.pages = 0

    def align(self, tree: Node) -> None:
        """Add a page: its nodes join the wrapper nodes they match, others become new ones."""
        self._join(self.root, tree)

    def _join(self, to: Node, node: Node) -> None:
        node.wrapper = to
        text = own_text(node)
        node.mark, node.words = _mark(text), len(text.split())
        if node.hinted:
            node.whole = _mark(whole_text(node))
        if to.template or node.template:
            return
        theirs = node.elements
        if not theirs:
            return
        pairs = dict((j, i) for i, j in match(to.elements, theirs))
        merged, done = [], 0
        for j, child in enumerate(theirs):
            if j in pairs:
                own = to.elements[pairs[j]]
                merged += to.elements[done:pairs[j] + 1]
                done = pairs[j] + 1
            else:
                own = Node(child.tag, child.key, child.template, parent=to)
                merged.append(own)
            self._join(own, child)
        to.elements = merged + to.elements[done:]

    def count(self, trees: list[Node]) -> None:
        """Count nodes and their texts over the aligned pages, once for all pages that hold the same article.

        Two pages do if slots with the same text have at least ALIKE of the words of either one's region.
        """
        kinds: list[tuple[dict, int, list[Node]]] = []
        for tree in trees:
            slots: dict[tuple[int, int], int] = {}
            for n in regions(tree) or [tree]:
                for c in _nodes(n):
                    if c.words:
                        slots[id(c.wrapper), c.mark] = c.words
            size = sum(slots.values())
            for other, other_size, members in kinds:
                low, high = sorted((size, other_size))
                if low >= ALIKE * high and sum(k for s, k in slots.items() if s in other) >= ALIKE * high:
                    members.append(tree)
                    break
            else:
                kinds.append((slots, size, [tree]))
        self.pages = len(kinds)
        for _, _, members in kinds:
            seen: dict[int, Node] = {}
            texts, wholes = set(), set()
            for tree in members:
                for c in _nodes(tree):
                    seen[id(c.wrapper)] = c.wrapper
                    texts.add((id(c.wrapper), c.mark))
                    if c.hinted:
                        wholes.add((id(c.wrapper), c.whole))
            for n in seen.values():
                n.pages += 1
            for at, mark in texts:
                seen[at].texts[mark] = seen[at].texts.get(mark, 0) + 1
            for at, mark in wholes:
                seen[at].wholes[mark] = seen[at].wholes.get(mark, 0) + 1

    def constant(self, node: Node) -> bool:
        """Whether a page's own text at this node belongs to the template."""
        if self.pages < SUPPORT or not node.words or node.words > TEMPLATE_WORDS:
            return False
        return node.wrapper.texts.get(node.mark, 0) >= SAME * self.pages

    def agreed(self, node: Node) -> bool:
        """Whether a hinted node holds the same on nearly all pages that have it, and no article."""
        pages = node.wrapper.pages
        return (node.hinted and pages >= SUPPORT and node.wrapper.wholes.get(node.whole, 0) >= SAME * pages
                and not any(c.tag in ("article", "main") for c in _nodes(node)))

    def content(self, tree: Node) -> str:
        """The text in the content slots of a page of this group."""
        constant: set[int] = set()
        if self.pages >= SUPPORT:
            for node in _nodes(tree):
                if self.constant(node):
                    constant.add(id(node))
                if node.hinted and self.agreed(node):
                    node.template = True
        found = regions(tree)
        return "\n\n".join(b for n in found or [tree] for b in blocks(n, constant, bool(found)))


def _nodes(tree: Node) -> list[Node]:
    """The aligned nodes of a tree outside of template, from the top."""
    out = [tree]
    for node in out:
        out += [c for c in node.elements if not c.template and c.wrapper is not None]
    return out


def blocks(region: Node, constant: set[int], inside: bool) -> list[str]:
    """The region's blocks in page order; ``inside`` an article, link lists stay."""
    out: list[str] = []
    parts: list[str] = []

    def flush() -> None:
        text = " ".join("".join(parts).split())
        if text:
            out.append(text)
        parts.clear()

    def walk(node: Node) -> None:
        drop = id(node) in constant
        for c in node.children:
            if type(c) is str:
                if not drop:
                    parts.append(c)
            elif c.tag == "br":
                parts.append(" ")
            elif c.template or not inside and c.tag in ("ul", "ol", "dl") and mostly_links(c):
                if c.tag in BLOCK:
                    flush()
            elif c.tag in BLOCK:
                flush()
                walk(c)
                flush()
            elif not drop:
                walk(c)

    walk(region)
    flush()
    return out


def mostly_links(node: Node) -> bool:
    def size(n: Node, linked: bool) -> tuple[int, int]:
        whole = links = 0
        for c in n.children:
            if type(c) is str:
                k = len(c.strip())
                whole, links = whole + k, links + k * linked
            else:
                w, k = size(c, linked or c.tag == "a")
                whole, links = whole + w, links + k
        return whole, links

    whole, links = size(node, False)
    return whole > 0 and links > 0.7 * whole


def extract_group(pages: list[str]) -> list[str]:
    """Main texts of the pages of one group, in their order. Equal pages are parsed and aligned once."""
    different = sorted(set(pages))
    trees = {}
    wrapper = Wrapper()
    for page in different:
        trees[page] = tree = parse(page)
        wrapper.align(tree)
    wrapper.count(list(trees.values()))
    texts = {page: wrapper.content(trees[page]) for page in different}
    return [texts[p] for p in pages]


def extract(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """``pages`` with text and n_chars instead of ``page``.

    Null pages are empty, and empty or text-free pages have an empty text. Null URLs and those without a host form one host. Rows keep
    their number and other columns; columns named text or n_chars are replaced.

    Groups are dealt over a host's different pages. A page that occurs once carries its row through its group; of a page that
    a host repeats one copy does the work, and its text is joined back to all rows.
    """
    names = [c for c in pages.columns if c not in (page, "text", "n_chars")]
    work = pages.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
                        F.coalesce(F.col(f"`{page}`"), F.lit("")).alias("__html"),
                        F.coalesce(host_of(F.col(f"`{url}`")), F.lit("")).alias("__host"))
    work = work.withColumns({"__h1": F.xxhash64("__host", "__html"), "__h2": F.xxhash64(F.lit(7), "__host", "__html")})
    different = checkpoint(work.groupBy("__host", "__h1", "__h2").agg((F.count("*") > 1).alias("again")))
    large = checkpoint(different.groupBy("__host").count().where(F.col("count") > GROUP_PAGES)
                       .select("__host", F.ceil(F.col("count") / GROUP_PAGES).alias("__groups")))
    if large.count() <= LARGE_HOSTS:  # so the pages are shuffled once; more hosts are joined by a shuffle of the pages
        large = F.broadcast(large)
    # repeated pages by buckets of their hash: a page in such a bucket by chance only takes the longer way
    bucket = F.pmod("__h1", F.lit(BUCKETS)).alias("__bucket")
    repeated = checkpoint(different.where("again").select(bucket).distinct())
    out_row = T.StructField("row", work.schema["row"].dataType, True)
    if repeated.isEmpty():
        apart, once = None, work.select("row", "__html", "__host", "__h1", "__h2")
    else:
        marked = work.withColumn("__bucket", bucket)
        once = marked.join(F.broadcast(repeated), "__bucket", "left_anti")
        apart = marked.join(F.broadcast(repeated), "__bucket", "left_semi")
        one = apart.groupBy("__host", "__h1", "__h2").agg(F.first("__html").alias("__html"))
        once = (once.select("row", "__html", "__host", "__h1", "__h2")
                .unionByName(one.withColumn("row", F.lit(None).cast(out_row.dataType))))
    dealt = once.join(large, "__host", "left").withColumn("__group", F.pmod("__h2", F.coalesce("__groups", F.lit(1))))
    schema = T.StructType([out_row, T.StructField("__h1", T.LongType()), T.StructField("__h2", T.LongType()),
                           T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(table: pa.Table) -> pa.Table:
        texts = extract_group(table["__html"].to_pylist())
        out = table.select(["row", "__h1", "__h2"])
        return out.append_column("text", pa.array(texts, pa.string())).append_column(
            "n_chars", pa.array([len(t) for t in texts], pa.int64()))

    # one column: rows that are dealt by host already, as after a join, would count as dealt by host and group too
    dealt = dealt.withColumn("__task", F.struct("__host", "__group"))
    found = dealt.drop("__groups").groupBy("__task").applyInArrow(run, schema)
    if apart is None:
        return found.select("row.*", "text", "n_chars")
    found = checkpoint(found)
    copies = (apart.select("row", "__h1", "__h2")
              .join(found.where("row is null").select("__h1", "__h2", "text", "n_chars"), ["__h1", "__h2"]))
    return (found.where("row is not null").select("row", "text", "n_chars")
            .unionByName(copies.select("row", "text", "n_chars")).select("row.*", "text", "n_chars"))
