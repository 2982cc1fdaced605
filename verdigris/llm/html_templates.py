"""HTML extraction: the main text of pages, without what recurs across the pages of a host."""

from __future__ import annotations

import hashlib
import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdigris.llm.shared import stored

#: A subtree is template if at least so many pages of its host have it, and this power of the host's
#: number of pages: 5 of 16, 10 of 100, 100 of 10,000.
LEAST_PAGES = 5
GROWTH = 0.5

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is not markup.
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th "
    "thead tr ul".split()
)
#: Elements that never hold main text.
_NEVER = frozenset(
    "head script style noscript template textarea title xmp iframe noembed noframes nav header footer aside form button "
    "select option input label fieldset svg math canvas object audio video dialog menu search".split()
)
#: Words of a token of a class, id or role that mark menus, notices, adverts and comments.
_MARKED = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert popup modal overlay sidebar menu menus nav navbar navigation breadcrumb breadcrumbs pagination pager "
    "footer header masthead topbar toolbar share sharing social related recommended newsletter subscribe signup login "
    "comment comments disqus respond reply replies widget complementary contentinfo".split()
)
#: Words beside a marked one that leave what it says as it is: `ad-container`, not `no-sidebar` or `related-work`.
_NEUTRAL = frozenset(
    "area bar block body bottom box button buttons container form holder icons inner item items left link links list main message outer page "
    "panel posts reader right section site slot top unit user view wrap wrapper".split()
)
#: Elements that can be marked inside of a page's own article or main element; running text there stays.
_STRUCTURE = frozenset("div section ul ol table figure dl article center details".split())
#: A start tag on the left ends open elements on the right, up to an element that holds them.
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_HOLDS = frozenset("ul ol menu dl table tbody thead tfoot select html body article section div main".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*)(>|\Z)", re.DOTALL
)
_ATTRIBUTE = re.compile(r"(?:^|[\s/\"'])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)
_MARK_WORDS = re.compile(r"[a-z0-9]+")


@dataclass(slots=True)
class Node:
    tag: str
    attributes: str = ""
    parts: list[Node | str] = field(default_factory=list)  # children and raw text, in order


def parse(page: str) -> Node:
    """The tree of a page; unclosed and stray tags are mended as browsers mostly do."""
    root = Node("#root")
    stack = [root]
    at = 0
    while True:
        match = _TOKEN.search(page, at)
        if match is None:
            if at < len(page):
                stack[-1].parts.append(page[at:])
            return root
        if match.start() > at:
            stack[-1].parts.append(page[at : match.start()])
        at = match.end()
        tag = match[2]
        if tag is None or not match[4]:
            continue  # a comment, a declaration, or a tag that the page's end cuts off
        tag = tag.lower()
        if match[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        if tag in _BLOCK:
            # a block ends an open paragraph and what is open in it
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag in _BLOCK and stack[k].tag not in _CLOSES:
                    break
        if tag in _CLOSES:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in _CLOSES[tag]:
                    del stack[k:]
                    if tag != "tr":
                        break
                elif stack[k].tag in _HOLDS:
                    break
        node = Node(tag, match[3])
        stack[-1].parts.append(node)
        if tag in _RAW:
            end = re.compile(f"</{tag}(?=[\\s/>]|\\Z)", re.IGNORECASE).search(page, at)
            node.parts.append(page[at : end.start() if end else len(page)])
            at = page.find(">", end.start()) + 1 if end else len(page)
            if end and not at:
                at = len(page)
        elif tag not in _VOID and not match[3].endswith("/"):
            stack.append(node)
        elif tag not in _VOID and tag in _BLOCK:
            stack.append(node)  # a slash means nothing on a block


def _named(node: Node) -> bool:
    """Whether an element hides itself, or a whole token of its class, id or role says that it holds no main text."""
    if not node.attributes:
        return False
    for name, *values in _ATTRIBUTE.findall(node.attributes):
        value = "".join(values).lower()
        if name.lower() == "hidden" or (name.lower() == "aria-hidden" and value == "true"):
            return True
        if name.lower() in ("class", "id", "role"):
            for token in value.split():
                words = set(_MARK_WORDS.findall(token))
                if not _MARKED.isdisjoint(words) and words <= _MARKED | _NEUTRAL:
                    return True
    return False


def marked(root: Node) -> frozenset[int]:
    """The elements (by ``id`` of the node) that their names mark and that can be left out for it.

    Not html, body or main, nor what holds an article or more than half of the page's text: such a name tells of the page's
    layout. Inside of an article or main element that is not marked itself only structural elements are marked.
    """
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(p for p in node.parts if isinstance(p, Node))
    size: dict[int, int] = {}
    holds: dict[int, bool] = {}
    for node in reversed(order):
        children = [p for p in node.parts if isinstance(p, Node)]
        own = 0 if node.tag in _RAW or node.tag == "head" else sum(len(p.strip()) for p in node.parts if isinstance(p, str))
        size[id(node)] = 0 if node.tag == "head" else own + sum(size[id(c)] for c in children)
        holds[id(node)] = any(c.tag == "article" or holds[id(c)] for c in children)
    found = set()
    walk = [(root, False)]
    while walk:
        node, inside = walk.pop()
        if node.tag not in ("#root", "html", "body", "main") and _named(node):
            if not holds[id(node)] and 2 * size[id(node)] <= size[id(root)] and (not inside or node.tag in _STRUCTURE):
                found.add(id(node))
                continue  # all below goes with it
        inside = inside or node.tag in ("article", "main")
        walk.extend((p, inside) for p in node.parts if isinstance(p, Node))
    return frozenset(found)


def main_roots(root: Node, left_out: frozenset[int]) -> list[Node]:
    """Outermost articles that aren't marked; else the main element; else the whole page."""
    found: dict[str, list[Node]] = {"article": [], "main": []}

    def walk(top: Node) -> None:
        stack = [top]
        while stack:
            node = stack.pop()
            if (node.tag in _NEVER and node.tag != "form") or id(node) in left_out:
                continue
            if node.tag in found:
                found[node.tag].append(node)
                if node.tag == "article":
                    continue
            stack.extend(p for p in reversed(node.parts) if isinstance(p, Node))

    walk(root)
    return found["article"] or found["main"][:1] or [root]


def subtree_hashes(root: Node, roots: list[Node]) -> dict[int, int]:
    """Hash of each candidate element (by ``id`` of the node): its tag, attributes, and all below it.

    Inside a page's own article or main element only structural elements can be template, not running text.
    """
    inside = {id(r) for r in roots if r.tag != "#root"}
    out: dict[int, int] = {}
    # children before parents, without recursion: pages can nest deeply
    order, stack = [], [(root, False)]
    while stack:
        node, main = stack.pop()
        order.append((node, main))
        main = main or id(node) in inside
        stack.extend((p, main) for p in node.parts if isinstance(p, Node))
    digest: dict[int, int] = {}
    for node, main in reversed(order):
        value = zlib.crc32(f"{node.tag} {node.attributes.strip()}".encode("utf-8", "surrogatepass")) + 1
        empty = True
        for part in node.parts:
            if isinstance(part, Node):
                value = (value * 0x9E3779B97F4A7C15 + digest[id(part)]) & 0xFFFFFFFFFFFFFFFF
                empty = False
            elif text := " ".join(part.split()):
                raw = text.encode("utf-8", "surrogatepass")
                value = (value * 0xBF58476D1CE4E5B9 + (zlib.crc32(raw) << 32 | zlib.adler32(raw))) & 0xFFFFFFFFFFFFFFFF
                empty = False
        value = (value ^ value >> 29) * 0x94D049BB133111EB & 0xFFFFFFFFFFFFFFFF
        digest[id(node)] = value
        if empty or node.tag in ("#root", "html", "body", "head") or id(node) in inside:
            continue
        if node.tag in ("div", "section", "ul", "ol", "table", "figure", "dl") or (not main and node.tag in _BLOCK):
            out[id(node)] = value - (1 << 64) if value >= 1 << 63 else value
    return out


def text_of(roots: list[Node], left_out: frozenset[int], template: frozenset[int] | set[int], hashes: dict[int, int]) -> str:
    """Blocks of the roots in page order, without elements that hold no main text, are left out or are template."""
    blocks: list[str] = []
    line: list[str] = []

    def end_block() -> None:
        # white space inside a block is one space; references are decoded before, as &nbsp; is white space too
        text = " ".join(html.unescape("".join(line)).split())
        line.clear()
        if text:
            blocks.append(text)

    for top in roots:
        stack: list[tuple[str, object]] = [("node", top)]
        while stack:
            kind, item = stack.pop()
            if kind == "end":
                end_block()
            elif kind == "text":
                line.append(item)
            else:
                node = item
                if node is not top and (node.tag in _NEVER or id(node) in left_out or hashes.get(id(node)) in template):
                    if node.tag in _BLOCK:
                        end_block()
                    continue
                if node.tag == "br":
                    line.append(" ")
                    continue
                if node.tag in _BLOCK:
                    end_block()
                    stack.append(("end", None))
                for part in reversed(node.parts):
                    stack.append(("node", part) if isinstance(part, Node) else ("text", part))
        end_block()
    return "\n".join(blocks)


_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def subtrees(pages: DataFrame) -> DataFrame:
    """(host, doc, part, page, hashes): of each row with a host, the hash of its main text, all blocks that no element or
    word marks, and its candidate elements; ``doc`` and ``part`` are kept. Stored, so that pages are parsed once for it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = [], []
            for page in batch.column(3).to_pylist():
                root = parse(page)
                left_out = marked(root)
                roots = main_roots(root, left_out)
                text = text_of(roots, left_out, frozenset(), {}).encode("utf-8", "surrogatepass")
                texts.append(int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "big", signed=True))
                found.append(list(set(subtree_hashes(root, roots).values())))
            columns = [*batch.columns[:3], pa.array(texts, pa.int64()), pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["host", "doc", "part", "page", "hashes"])

    source = pages.where("host <> '' AND html IS NOT NULL").select("host", "doc", "part", "html")
    return stored(source.mapInArrow(run, "host string, doc long, part long, page long, hashes array<long>"), "subtrees")


def templates(found: DataFrame, least_pages: int = LEAST_PAGES, growth: float = GROWTH) -> DataFrame:
    """(host, hash): of each host the subtrees that recur across its pages, from the rows of ``subtrees``.

    Pages of one main text count once, so that copies of an article don't make its blocks template.
    """
    each = found.select("host", "page", F.explode("hashes").alias("hash")).distinct()
    counts = each.groupBy("host", "hash").agg(F.count("*").alias("n"))
    sizes = found.groupBy("host").agg(F.count_distinct("page").alias("pages"))
    recurring = counts.where(F.col("n") >= least_pages).join(sizes, "host").where(F.col("n") >= F.pow("pages", F.lit(growth)))
    return recurring.select("host", "hash")


#: A key with more than one row in so many of the table is hot, so there are fewer hot keys than this.
HOT_PARTS = 1_000


def hot_keys(rows: DataFrame, *keys: str) -> DataFrame:
    """(keys, salts): those with over 1 / HOT_PARTS of all rows, and into how many parts of that size each goes.

    Fewer than HOT_PARTS rows, whatever the input.
    """
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    total = sizes.agg(F.sum("n").alias("total"))
    parts = F.ceil(F.col("n") * HOT_PARTS / F.col("total"))
    return sizes.join(F.broadcast(total)).where(F.col("n") * HOT_PARTS > F.col("total")).select(*keys, parts.alias("salts"))


def dealt_join(rows: DataFrame, few: DataFrame, hot: DataFrame, keys: list[str], others: list[str], how: str) -> DataFrame:
    """``rows`` (with a hash ``part``) joined with ``few`` on ``keys`` and ``others``; the rows of a key of ``hot``
    are dealt over several tasks, each with a copy of what ``few`` has for it."""
    dealt = rows.join(F.broadcast(hot), keys, "left").withColumn("salt", F.coalesce(F.pmod("part", F.col("salts")), F.lit(0)).cast("int"))
    copies = few.join(F.broadcast(hot), keys, "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("salts"), F.lit(1)).cast("int") - 1))
    )
    return dealt.drop("salts").join(copies.drop("salts"), [*keys, "salt", *others], how)


def extract_main_text(pages: DataFrame, least_pages: int = LEAST_PAGES, growth: float = GROWTH) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of each row of ``pages`` (page_id, url, html).

    The main text is that of the articles, else of the main element, else of the page; without menus,
    headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments, known by element
    or by a word of class, id or role, and without subtrees that recur across the host's pages, those of one main text counted once. Running text inside an
    article stays, however often it recurs. A null or empty html has an empty text; a null or odd url has no host and no
    templates; null ids and repeated rows stay; an empty table gives no rows; other columns are not read.
    """
    narrow = pages.select(pages["page_id"], pages["url"], pages["html"])
    hosted = (
        narrow.withColumn("host", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), _HOST, 1)))
        .withColumn("doc", F.xxhash64("html"))
        .withColumn("part", F.xxhash64("page_id", "url", "html"))
    )
    found = subtrees(hosted)
    # each page gets the templates that it has itself, however many its host has
    each = found.select("host", "doc", "part", F.explode("hashes").alias("hash"))
    own = dealt_join(each, templates(found, least_pages, growth), hot_keys(found, "host"), ["host"], ["hash"], "inner")
    lists = own.groupBy("host", "doc").agg(F.collect_set("hash").alias("hashes"))
    schema = f"{narrow.select('page_id').schema[0].simpleString().replace(':', ' ', 1)}, url string, text string, n_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, hashes in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                root = parse(page or "")
                left_out = marked(root)
                roots = main_roots(root, left_out)
                own = frozenset(hashes or ())
                texts.append(text_of(roots, left_out, own, subtree_hashes(root, roots) if own else {}))
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    joined = dealt_join(hosted, lists, hot_keys(hosted, "host", "doc"), ["host", "doc"], [], "left")
    return joined.select("page_id", "url", "html", "hashes").mapInArrow(run, schema)
