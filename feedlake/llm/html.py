"""Main text of web pages: what a site repeats is its template, the rest is the page.

A page is parsed into a tree of elements. Every element's subtree has a hash of its tag, its
class and id, its text and its children's hashes. Spark counts on how many pages of a host
each subtree occurs; those that recur on many pages are deleted, unless they are the running
text of an article. Elements that by tag, role or class are menus, headers, footers, side
bars, notices, adverts, forms, scripts, styles or comments go on every page, so that a host
with few pages is served too.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import Scratch, add_columns

#: A subtree is template if it is on at least this many pages of a host, and on this share.
MIN_PAGES, MIN_SHARE = 4, 0.2

# Fixed values of HTML: elements without content, with raw text, and those that start a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noframes noembed template".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p "
    "pre search section select summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - frozenset("br caption legend option summary tbody td tfoot th thead tr body head html".split())
#: An open element of the key is closed by a start tag of the value, up to the element `until`.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}

#: Within these a new block does not close the paragraph around them.
P_ENDS = ("table", "td", "th", "button", "object")
#: Elements a slash closes; on those of HTML it means nothing.
FOREIGN = frozenset("svg path circle rect line use g polygon polyline ellipse math".split())

# Boilerplate by tag, by role and by words of class or id.
DROP_TAGS = frozenset(
    "head script style title noscript template nav footer aside form button select textarea input label iframe object "
    "embed svg canvas audio video map dialog menu search option datalist fieldset xmp noframes noembed".split()
)
DROP_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar "
    "tablist status tooltip".split()
)
DROP_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adbox adslot banner banners sponsor sponsored promo "
    "promotion promoted nav navbar navigation navi menu menus topbar toolbar breadcrumb breadcrumbs pagination pager "
    "header masthead footer foot sidebar sidebars aside rail widget widgets related recommended recommendations "
    "comment comments commentlist disqus respond reply replies cookie cookies consent gdpr notice notices notification "
    "alert popup modal overlay newsletter subscribe subscription signup login share sharing social breaking skip "
    "copyright legal disclaimer tags outbrain taboola".split()
)
#: Articles are comments or teasers by these words only.
ARTICLE_DROP_WORDS = frozenset("comment comments reply ad ads advert advertisement sponsored promo related teaser".split())
#: Elements that carry running text; inside an article they are never template.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th tr table ul ol dl figcaption figure section article main body html b i em strong a span code br".split())

# A quote means something behind an equals sign only; one that never closes is a character.
_TAG = re.compile(
    r"<(?:!--(.*?)(?:--!?>|\Z)"
    r"|(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))*+)>"
    r"|([!?/][^>]*)(?:>|\Z))",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_DIGITS = re.compile(r"\d+")
_WORD = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")


class Node:
    __slots__ = ("tag", "attributes", "parts", "parent", "digest", "level")

    def __init__(self, tag: str, attributes: str, parent: Node | None):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.level = 0 if parent is None else parent.level + 1
        self.parts: list[Node | str] = []
        self.digest = 0

    def attribute(self, *names: str) -> list[str]:
        if not self.attributes.strip():
            return []
        return [a or b or c for n, a, b, c in _ATTRIBUTE.findall(self.attributes) if n.lower() in names]


def parse(page: str) -> Node:
    """The element tree of a page; end tags that are missing or without a start are tolerated."""
    root = top = Node("#page", "", None)
    # open elements by tag, outermost first, so that none is looked for by climbing the tree
    opened: dict[str, list[Node]] = {}

    def close(until: Node) -> None:
        nonlocal top
        while top is not until:
            opened[top.tag].pop()
            top = top.parent

    def deepest(tags: Iterable[str]) -> int:
        return max((opened[t][-1].level for t in tags if opened.get(t)), default=0)

    # behind the last > there is no tag
    at, end, last = 0, len(page), page.rfind(">")
    while at < end:
        found = _TAG.search(page, at) if at <= last or page.find("<!", at) >= 0 or page.find("<?", at) >= 0 or page.find("</", at) >= 0 else None
        if not found:
            top.parts.append(page[at:])
            break
        if found.start() > at:
            top.parts.append(page[at : found.start()])
        at = found.end()
        slash, tag, attributes = found[2], found[3], found[4]
        if not tag:
            continue
        tag = tag.lower()
        if slash:
            if opened.get(tag):
                close(opened[tag][-1].parent)
            elif tag in ("p", "br"):
                top.parts.append(Node(tag, "", top))
            continue
        if tag in CLOSES_P and opened.get("p") and opened["p"][-1].level > deepest(P_ENDS):
            close(opened["p"][-1].parent)
        if tag in IMPLIED:
            closed, until = IMPLIED[tag]
            floor = deepest(until)
            # the outermost of those to be closed
            outer = [opened[t][i] for t in closed if opened.get(t) and (i := bisect_right(opened[t], floor, key=lambda n: n.level)) < len(opened[t])]
            if outer:
                close(min(outer, key=lambda n: n.level).parent)
        node = Node(tag, attributes, top)
        top.parts.append(node)
        if tag in RAW:
            stop = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            node.parts.append(page[at : stop.start() if stop else end])
            at = stop.end() if stop else end
        elif tag not in VOID and not (attributes.endswith("/") and tag in FOREIGN):
            top = node
            opened.setdefault(tag, []).append(node)
    return root


def elements(root: Node) -> list[Node]:
    """All elements in page order; without recursion, as pages may be deep."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        found.append(node)
        stack.extend(p for p in reversed(node.parts) if isinstance(p, Node))
    return found


def hash_subtrees(root: Node) -> list[Node]:
    """Digests of all subtrees. Numbers are one to them, so that pages and blocks that differ in
    a date or a counter only are the same."""
    nodes = elements(root)
    for node in reversed(nodes):
        state = xxhash.xxh64(f"{node.tag}|{'|'.join(node.attribute('class', 'id', 'role'))}".encode())
        for part in node.parts:
            if isinstance(part, Node):
                state.update(part.digest.to_bytes(8, "little"))
            else:
                state.update(_DIGITS.sub("0", " ".join(part.split())).encode("utf-8", "replace") + b"\n")
        node.digest = state.intdigest()
    return nodes


def _signed(digest: int) -> int:
    return digest - (1 << 64) if digest >> 63 else digest


def _is_article(node: Node) -> bool:
    return node.tag in ("article", "main") or "main" in node.attribute("role") or "articleBody" in node.attribute("itemprop")


def countable(page: str) -> tuple[int, list[int]]:
    """Hash of a page's content, and the distinct hashes of its subtrees that may be template."""
    nodes = hash_subtrees(parse(page))
    inside: dict[int, bool] = {}
    found = set()
    for node in nodes:
        inside[id(node)] = _is_article(node) or (node.parent is not None and inside[id(node.parent)])
        if node.parent is None or node.tag in VOID or node.tag in ("html", "body") or inside[id(node)] and node.tag in PROSE:
            continue
        found.add(_signed(node.digest))
    return _signed(nodes[0].digest), sorted(found)


def _boilerplate(node: Node, inside: bool) -> bool:
    """Whether an element is boilerplate by itself. An article's own header holds its title."""
    if node.tag in DROP_TAGS:
        return True
    if node.tag == "header":
        return not inside
    if not node.attributes.strip() or node.tag in ("html", "body", "main"):
        return False
    if any(r.lower() in DROP_ROLES for r in node.attribute("role")):
        return True
    if re.search(r"(?:^|\s)hidden(?=$|[\s=/])", node.attributes) or "true" in node.attribute("aria-hidden"):
        return True
    if any("display:none" in s.replace(" ", "").lower() for s in node.attribute("style")):
        return True
    words = {w.lower() for value in node.attribute("class", "id") for w in _WORD.findall(value)}
    if node.tag == "article":
        return bool(words & ARTICLE_DROP_WORDS)
    return bool(words & (DROP_WORDS - {"header"} if inside else DROP_WORDS))


def _article_ancestors(root: Node) -> set[int]:
    """Ids of the elements around an article; what they are called says nothing about it."""
    around: set[int] = set()
    for node in elements(root):
        if _is_article(node) and not _boilerplate(node, True):
            up = node.parent
            while up is not None and id(up) not in around:
                around.add(id(up))
                up = up.parent
    return around


#: Elements whose text is none of the page's, whatever they are called.
NO_TEXT = frozenset("head script style title noscript template iframe svg noframes noembed".split())


def main_text(page: str, template: frozenset[int], names: bool = True) -> str:
    """The text of a page without boilerplate and without the subtrees of `template`.

    Where a page has an article or main element with text, only that counts. Without `names`
    nothing is taken for boilerplate by its tag, role or class, and the template alone decides.
    """
    root = parse(page)
    if template:
        hash_subtrees(root)
    around = _article_ancestors(root)
    whole: list[str] = []
    article: list[str] = []
    stack: list[tuple[Node | str, bool]] = [(root, False)]
    while stack:
        part, inside = stack.pop()
        if isinstance(part, str):
            whole.append(part)
            if inside:
                article.append(part)
            continue
        if part.parent is not None:
            within = inside or _is_article(part)
            if id(part) not in around and (_boilerplate(part, within) if names else part.tag in NO_TEXT):
                stack.append((" ", inside))
                continue
            spared = within and part.tag in PROSE or id(part) in around or part.tag in ("html", "body")
            if template and not spared and _signed(part.digest) in template:
                stack.append((" ", inside))
                continue
            inside = within
        breaks = part.tag in BLOCKS
        if breaks:
            stack.append((" ", inside))
        for child in reversed(part.parts):
            stack.append((entities.unescape(child), inside) if isinstance(child, str) else (child, inside))
        if breaks:
            stack.append((" ", inside))
    text = " ".join("".join(article).split())
    return text or " ".join("".join(whole).split())


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, names: bool = True) -> DataFrame:
    """`pages` with `text` (main text, empty if none) and `n_chars` (its code points).

    A NULL page is empty. Pages whose url has no host count as one host of their own. Pages
    of a host with the same content (elements, classes, ids, text but for numbers) count as one.
    `names` turns off what is decided by tags, roles and classes. White space is one space everywhere, as blocks are joined by one
    as well. Input columns `text` and `n_chars` are replaced, all others stay.

    Template subtrees of a host are at most as many as its pages have subtrees on average,
    over `min_share`; pages meet them by a join on the host, and adaptive execution splits a
    host that holds a large part of all pages.
    """
    spark, scratch = pages.sparkSession, Scratch(pages.sparkSession, "html")
    host = F.coalesce(F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))
    narrow = pages.select(host.alias("host"), F.coalesce("html", F.lit("")).alias("html"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, contents, hashes = [], [], []
            for name, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                content, own = countable(page)
                hosts.append(name)
                contents.append(content)
                hashes.append(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(contents, pa.int64()), pa.array(hashes, pa.list_(pa.int64()))],
                names=["host", "content", "subtrees"],
            )

    # copies of a page are one: its own content is no template
    contents = narrow.mapInArrow(hashed, "host string, content long, subtrees array<long>")
    contents = scratch.keep(contents.groupBy("host", "content").agg(F.max("subtrees").alias("subtrees")), "contents")
    counts = contents.select("host", F.explode("subtrees").alias("subtree")).groupBy("host", "subtree").count()
    sizes = contents.groupBy("host").agg(F.count("*").alias("pages"))
    frequent = scratch.keep(counts.filter(F.col("count") >= min_pages), "frequent")
    template = (
        frequent.join(scratch.keep(sizes.filter(F.col("pages") >= min_pages), "hosts"), "host")
        .filter(F.col("count") >= min_share * F.col("pages"))
        .groupBy("host")
        .agg(F.sort_array(F.collect_list("subtree")).alias("template"))
    )
    template = scratch.keep(template, "template")
    rows = pages.select(F.struct("*").alias("row"), host.alias("host"))
    rows = rows.join(template, "host", "left").select("row", F.col("row.html").alias("html"), "template")

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                main_text(page or "", frozenset(own or ()), names)
                for page, own in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "text"])

    out = rows.mapInArrow(extracted, rows.select("row").schema.add("text", "string"))
    named = out.select("row.*", F.col("text").alias("__text"))
    return add_columns(named, text=F.col("__text"), n_chars=F.char_length("__text").cast("long")).drop("__text")
