"""Main text of web pages: site templates are the subtrees that many pages of one host share.

Each page is read into a small tree. Elements that name themselves as something else than the article
(menus, footers, forms, scripts, notices, adverts, comments ...) go. The hashes of the remaining
subtrees are counted per host in Spark, each article text once however many copies it has, and subtrees
found in many pages of their host go as well. Inside an article, plain text blocks (paragraphs,
headings, list items ...) are never taken for templates: articles may quote each other.

The main text is that of the page's article or main element, or else of what is left of its body.
Character references are decoded, white space inside a block is one space, blocks are joined by line
breaks in page order; a line break element is white space.

Defined results: null or empty pages give the empty text; unclosed and cut-off elements end with their
parent, a tag cut off at the end of the page is no text; pages without a host share no templates; rows
with equal or null ids stay separate; extra columns are ignored.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import join_small, known, map_texts, spark_schema, stage, text_or_empty

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PLAIN = HEADINGS | frozenset("p li td th dt dd pre blockquote figcaption caption summary address".split())
BLOCKS = PLAIN | frozenset(
    "html body article main section div ul ol dl table thead tbody tfoot tr header footer nav aside form fieldset figure details hr menu center root".split()
)
NEVER = frozenset(
    "head title script style noscript template nav aside footer form button select textarea option iframe svg canvas object dialog menu audio video map math".split()
)
#: Words in class, id and role that tell what an element is.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist disqus replies complementary consent contentinfo cookie cookies"
    " footer gdpr masthead menu menubar modal nav navbar navigation navi newsletter notice notices notification pager pagination popup promo promotion related search share sharing sidebar"
    " social sponsor sponsored subscribe subscription teaser toolbar toc widget widgets dialog alert skip".split()
)
#: Elements of which only these names tell.
NAMED_ONLY = {"article": frozenset("comment teaser related promo ad advert sponsored reply".split()), "main": frozenset(), "body": frozenset(), "html": frozenset()}
#: An open element ends where one of these starts.
ENDS = {t: frozenset({"p"}) for t in BLOCKS - {"html", "body", "root"}}
ENDS |= {"li": frozenset({"p", "li"}), "dt": frozenset({"p", "dt", "dd"}), "dd": frozenset({"p", "dt", "dd"}), "td": frozenset({"p", "td", "th"}), "th": frozenset({"p", "td", "th"}), "tr": frozenset({"p", "td", "th", "tr"})}
SCOPES = frozenset("ul ol dl table article main section div body html root blockquote aside header footer nav form".split())
CUT_OFF = re.compile(r"<[!/?a-zA-Z][^<>]*\Z")


class Node:
    __slots__ = ("tag", "names", "hidden", "parent", "kids", "hash", "size", "heading", "gone")

    def __init__(self, tag: str, names: str, hidden: bool, parent: Node | None) -> None:
        self.tag, self.names, self.hidden, self.parent = tag, names, hidden, parent
        self.kids: list[Node | str] = []
        self.hash, self.size, self.heading, self.gone = 0, 0, tag in HEADINGS, False


class Tree(HTMLParser):
    """The elements of a page in order; children always come after their parents."""

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        root = Node("root", "", False, None)
        self.nodes, self.open = [root], [root]
        self.feed(CUT_OFF.sub("", html))
        self.close()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        ends = ENDS.get(tag)
        if ends:
            # everything up to an element that this one ends, within the nearest container
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i].tag in ends:
                    del self.open[i:]
                    break
                if self.open[i].tag in SCOPES and self.open[i].tag != tag:
                    break
        told = dict(attrs)
        names = " ".join(told.get(k) or "" for k in ("class", "id", "role"))
        hidden = "hidden" in told or told.get("aria-hidden") == "true" or "display:none" in (told.get("style") or "").replace(" ", "").lower()
        node = Node(tag, names, hidden, self.open[-1])
        self.open[-1].kids.append(node)
        self.nodes.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open[-1].tag == tag:
            self.open.pop()

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                break

    def handle_data(self, data: str) -> None:
        self.open[-1].kids.append(data)


def _says(node: Node) -> bool:
    """Whether an element names itself as no part of the article."""
    if node.tag in NEVER or node.hidden and node.tag not in NAMED_ONLY:
        return True
    if not node.names:
        return False
    words = set(re.split(r"[^a-z0-9]+", re.sub(r"([a-z0-9])([A-Z])", r"\1 \2", node.names).lower()))
    return bool(words & NAMED_ONLY.get(node.tag, NAMES))


def _digest(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _measure(tree: Tree) -> None:
    """Fill in hash, size of text and headings of every subtree."""
    for node in reversed(tree.nodes):
        parts = [node.tag, node.names]
        for kid in node.kids:
            if isinstance(kid, str):
                text = " ".join(kid.split())
                if text:
                    parts.append(text)
                    node.size += len(text)
            else:
                parts.append(str(kid.hash))
                node.size += kid.size
                node.heading |= kid.heading
        node.hash = _digest("\x1f".join(parts))


def _clear(tree: Tree, templates: frozenset) -> Node:
    """Mark what goes, and return the root of the main text."""
    inside = {id(tree.nodes[0]): False}
    for node in tree.nodes[1:]:
        parent = node.parent
        inside[id(node)] = within = inside[id(parent)] or node.tag in ("article", "main")
        node.gone = parent.gone or _says(node)
        if not node.gone and node.tag == "header":
            node.gone = not (inside[id(parent)] and node.heading)
        if not node.gone and node.hash in templates and node.tag not in ("html", "body", "root"):
            node.gone = not (inside[id(parent)] and node.tag in PLAIN) and node.tag not in ("article", "main")
    left = [n for n in tree.nodes if not n.gone]
    articles = [n for n in left if n.tag == "article" and not any(p.tag == "article" for p in _above(n))]
    if articles:
        longest = max(articles, key=lambda n: n.size)
        if len(articles) == 1 or 2 * longest.size > sum(n.size for n in articles):
            return longest
        holders = _above(articles[0])
        return next(p for p in holders if all(p in _above(a) for a in articles))
    mains = [n for n in left if n.tag == "main" or "main" in n.names.split() and n.tag in BLOCKS]
    return max(mains, key=lambda n: n.size) if mains else tree.nodes[0]


def _above(node: Node) -> list[Node]:
    out = []
    while node.parent is not None:
        node = node.parent
        out.append(node)
    return out


def _blocks(root: Node) -> list[str]:
    """Text of the blocks under a node, without what goes."""
    out: list[str] = []
    inline: list[str] = []

    def close() -> None:
        text = " ".join("".join(inline).split())
        if text:
            out.append(text)
        inline.clear()

    walk: list = [(root, iter(root.kids))]
    while walk:
        node, kids = walk[-1]
        for kid in kids:
            if isinstance(kid, str):
                inline.append(kid)
            elif kid.tag == "br":
                inline.append(" ")
            elif not kid.gone:
                if kid.tag in BLOCKS:
                    close()
                walk.append((kid, iter(kid.kids)))
                break
        else:
            walk.pop()
            if node.tag in BLOCKS:
                close()
    close()
    return out


def main_text(html: str, templates: frozenset = frozenset()) -> str:
    """The main text of a page; subtrees whose hash is among ``templates`` go."""
    tree = Tree(html)
    _measure(tree)
    return "\n".join(_blocks(_clear(tree, templates)))


def subtrees(html: str) -> tuple[int, list[int]]:
    """A digest of the page's main text, and the hashes of subtrees that may be templates."""
    tree = Tree(html)
    _measure(tree)
    text = "\n".join(_blocks(_clear(tree, frozenset())))
    found = set()
    for node in tree.nodes[1:]:
        if not node.gone and node.size and node.tag in BLOCKS and node.tag not in NAMED_ONLY:
            if not (node.tag in PLAIN and any(p.tag in ("article", "main") for p in _above(node))):
                found.add(node.hash)
    return _digest(text), sorted(found)


def host(url: str = "url") -> Column:
    """Host of a URL in lower case, without user and port; null where there is none."""
    name = F.lower(F.regexp_extract(F.col(f"`{url}`"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(name != "", name)


def page_subtrees(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """host, key (a digest of the page), text (a digest of its main text) and parts (subtree hashes) of every page with a host."""
    rows = pages.select(host(url).alias("host"), text_or_empty(html).alias("page")).where(F.col("host").isNotNull()).withColumn("key", F.md5("page"))

    def work(texts: list[str]) -> dict:
        made = [subtrees(t) for t in texts]
        return {"text": pa.array([m[0] for m in made], pa.int64()), "parts": pa.array([m[1] for m in made], pa.list_(pa.int64()))}

    return map_texts(rows, work, "text bigint, parts array<bigint>", text="page")


def site_templates(read: DataFrame, share: float = 0.3, least: int = 5, many: int = 50) -> DataFrame:
    """host and part: the subtrees in ``share`` of the different pages of a host, ``least`` at least, or in ``many``.

    A page counts once for all pages with its main text. On a large host a box of one section or layout is in a
    small share of the pages, so a number of pages tells there.
    """
    totals = read.select("host", "text").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    parts = read.select("host", "text", F.explode("parts").alias("part")).distinct().groupBy("host", "part").agg(F.count(F.lit(1)).alias("n"))
    found = parts.where(F.col("n") >= least).join(totals, "host")
    return found.where((F.col("n") >= many) | (F.col("n") >= share * F.col("pages"))).select("host", "part")


def _own_templates(rows: DataFrame, read: DataFrame, found: DataFrame, long: int, bound: int) -> DataFrame:
    """The rows with templates, the hashes that go from their page.

    Hosts of up to ``long`` templates have one array. The subtrees of pages of other hosts are joined with the
    templates as narrow rows, so a page gets those that it has itself.
    """
    sizes = stage(found.groupBy("host").agg(F.count(F.lit(1)).alias("n")), "template-counts")
    large = stage(sizes.where(F.col("n") > long).select("host"), "large-hosts")
    short = stage(join_small(found, large, "host", "left_anti").groupBy("host").agg(F.collect_list("part").alias("templates")), "templates")
    # a broadcast holds at most ``bound`` hashes; beyond that pages are shuffled by host
    total = sizes.where(F.col("n") <= long).agg(F.sum("n")).first()[0] or 0
    out = rows.join(F.broadcast(short) if total <= bound else short, "host", "left")
    if large.isEmpty():
        return out
    parts = join_small(read, large, "host", "left_semi").select("host", "key", F.explode("parts").alias("part")).distinct()
    own = join_small(parts, found, ["host", "part"], "inner").groupBy("host", "key").agg(F.collect_list("part").alias("own"))
    own = stage(own, "page-templates")
    of_large = F.broadcast(large) if known(large, bound) else large
    few, many = out.join(of_large, "host", "left_anti"), out.join(of_large, "host", "left_semi")
    told = join_small(many.withColumn("key", F.md5("page")), own, ["host", "key"], "left").withColumn("templates", F.col("own"))
    return few.unionByName(told.select(*few.columns))


def extract(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", many: int = 50, long: int = 2_000, bound: int = 1_000_000
) -> DataFrame:
    """page_id, url, text and n_chars of every row."""
    read = stage(page_subtrees(pages, url, html), "subtrees")
    found = stage(site_templates(read, many=many), "template-rows")
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), host(url).alias("host"), text_or_empty(html).alias("page"))
    rows = _own_templates(rows, read, found, long, bound).drop("host")
    schema = spark_schema("text string")
    kept = [f for f in rows.schema.fields if f.name in ("page_id", "url")]
    out = type(rows.schema)(kept + schema.fields)

    def work(batches):
        for batch in batches:
            texts = []
            for page, own in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                texts.append(main_text(page, frozenset(own or ())))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    read = rows.select("page_id", "url", "page", "templates").mapInArrow(work, out)
    return read.withColumn("n_chars", F.length("text").cast("bigint"))
