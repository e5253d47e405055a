"""Main text of web pages by a site style tree.

The pages of one host are merged into a tree: its nodes are presentation paths (elements with
their classes, from the root down), and every branch is in it, those of the article too.  A
node has three measures over the distinct pages that hold it:

* presentation: the entropy of the child sequences that pages have there;
* content: the entropy of its own contents, for each content the part -log(share of pages);
* the branch: GAMMA parts of the mean content entropy of all blocks below it and 1 - GAMMA
  parts of its own presentation entropy.

All are relative to the largest entropy that so many pages can have, so what every page shows
alike has 0 and what differs from page to page has 1.  A node that m pages hold speaks for
itself with weight m - 1 (one page alone says nothing); the same path over all hosts, and
before that a neutral 1, speak with the weight of TRUST pages.  So small and large hosts follow one rule.  A block goes if the
branch of any of its ancestors, its own node or its content has an importance under
MIN_IMPORTANCE.

What an element says about itself (tag, and words of class, id and role) is a factor on the
importance of its branch: menus, headers, footers, sidebars, notices, adverts, forms and comments
get UNIMPORTANT, which no entropy can make up for.  The page's main element (the article or
main element with most text) and the elements that hold it never get it, whatever their words.
Prose that stands in a main element without a box of its own (a div or section, or anything
with a class) has PROSE parts of its importance from there and 1 - PROSE parts from the
tree: a sentence that many articles share is no boilerplate, but one that nearly all pages
of a large host show in one place is.  Boxes inside the main element are judged like all
other branches.

Counts are aggregated map-side by host, path and content, and marks meet pages by host and
page digest, so that a host with a third of all pages is no group: nothing is grouped by host alone.

Edge cases: a null html counts as empty and gives an empty text.  Equal pages of a host count
once and get equal texts; repeated rows of one page_id, and null ids, are kept as rows.  Broken markup
(unclosed elements, stray end tags) is read as browsers read it, roughly: blocks end
paragraphs, stray ends are ignored.  Very long pages are read in time linear in their length (and depth).  Input columns other
than page_id, url and html are not carried; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm import htmltokens, tables

MIN_IMPORTANCE, UNIMPORTANT, PROSE, TRUST, GAMMA = 0.3, 0.2, 0.29, 4.0, 0.9
_MAIN = {"article", "main"}
_UNIMPORTANT = {"nav", "header", "footer", "aside", "form", "dialog", "menu", "template", "button", "select", "fieldset"}
_BOXES = {"div", "section", "details"}
_HIDDEN = {"head", "script", "style", "noscript", "title", "textarea", "iframe", "xmp", "noembed", "noframes", "svg", "template"}
_CONTAINERS = _MAIN | _UNIMPORTANT | {"html", "body", "div", "section", "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd", "table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption", "blockquote", "pre", "figure", "figcaption", "address", "details", "summary", "center"}
_CLOSED_BY_SAME = {"p", "li", "dt", "dd", "tr", "td", "th"}
#: Words of class, id and role that mark an unimportant branch.
_MARKS = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|banner|menu|nav|navbar|navigation|sidebar|side|header|masthead|footer|cookies?|consent|notices?|popup|modal|promo\w*|sponsor\w*|share|social|related|recommend\w*|newsletter|subscribe|comments?|replies|respond|breadcrumbs?|pagination|pager|widget|toolbar|search|login|complementary|contentinfo)(?=$|[\s_-])", re.I)
FEATURES = "host string, digest long, blocks array<struct<path:long,content:long,again:boolean,above:array<long>>>, nodes array<struct<path:long,style:long>>"
RESULT = "page_id long, url string, text string"
#: The name of all hosts together (no host has a slash), and the node of text outside all elements.
ALL, ROOT = "/", 0
#: As in browsers, elements nested deeper than this become neighbours.
MAX_DEPTH = 512


class Page:
    """Elements (parent, name, style, hash of the style path, marked) and blocks (element, text); -1 is the root."""

    def __init__(self, html: str):
        self.parent: list[int] = []
        self.name: list[str] = []
        self.style: list[str] = []
        self.path: list[int] = []
        self.mains: list[int] = []
        self.marked: list[bool] = []
        self.prose: list[bool] = []
        self.children: list[list[str]] = []
        self.blocks: list[tuple[int, str]] = []
        self._read(html)
        self._weigh()

    def _read(self, html: str) -> None:
        stack: list[int] = []
        buffer: list[str] = []
        hidden: list[str] = []

        def flush() -> None:
            if buffer:
                text = " ".join("".join(buffer).split())
                buffer.clear()
                if text:
                    self.blocks.append((stack[-1] if stack else -1, text))
                    if stack:
                        self.children[stack[-1]].append("#")

        for kind, name, rest in htmltokens.tokens(html):
            if kind == "text":
                if not hidden:
                    buffer.append(rest)
                continue
            if hidden:
                if kind == "close" and name in hidden:
                    del hidden[len(hidden) - 1 - hidden[::-1].index(name) :]
                elif kind == "open" and name in _HIDDEN and name != "head":
                    hidden.append(name)
                elif kind == "open" and name == "body":
                    hidden.clear()
                if hidden or kind == "close":
                    continue
            if name in _HIDDEN:
                if kind == "open" and not rest.rstrip().endswith("/"):
                    hidden.append(name)
                continue
            if name == "br":
                buffer.append(" ")
                continue
            if name == "hr":
                flush()
                continue
            if name not in _CONTAINERS:
                continue
            flush()
            if kind == "close":
                at = next((i for i in range(len(stack) - 1, -1, -1) if self.name[stack[i]] == name), None)
                if at is not None:
                    del stack[at:]
                continue
            while stack and (self.name[stack[-1]] == "p" or self.name[stack[-1]] == name and name in _CLOSED_BY_SAME):
                stack.pop()
            a = htmltokens.attributes(rest) if rest.strip() else {}
            style = name + "".join("." + c for c in sorted(a.get("class", "").split()))
            if len(stack) >= MAX_DEPTH:
                stack.pop()
            above = stack[-1] if stack else -1
            if stack:
                self.children[above].append(style)
            self.parent.append(above)
            self.name.append(name)
            self.style.append(style)
            self.path.append(_hash(str(self.path[above] if stack else ROOT), style))
            main = name in _MAIN or a.get("role") == "main"
            if main:
                self.mains.append(len(self.name) - 1)
            self.prose.append(main or bool(stack) and self.prose[above] and name not in _BOXES and "." not in style)
            self.marked.append(bool(name in _UNIMPORTANT or "hidden" in a or _MARKS.search(" ".join((a.get("class", ""), a.get("id", ""), a.get("role", ""))))))
            self.children.append([])
            stack.append(len(self.parent) - 1)
        flush()

    def _weigh(self) -> None:
        """Takes the marks off the main element (most text among article and main) and off what holds it."""
        size = [0] * len(self.parent)
        for element, text in self.blocks:
            if element >= 0:
                size[element] += len(text)
        for i in range(len(size) - 1, -1, -1):
            if self.parent[i] >= 0:
                size[self.parent[i]] += size[i]
        at = max(self.mains, key=lambda i: (size[i], -i), default=-1)
        while at >= 0:
            self.marked[at] = False
            at = self.parent[at]
        # A mark holds for everything below.
        for i, above in enumerate(self.parent):
            self.marked[i] = self.marked[i] or above >= 0 and self.marked[above]

    def nodes(self) -> list[int]:
        """Each element's node of the tree: its style path, and in the lowest bits whether it is marked or prose."""
        return [path & ~3 | prose << 1 | mark for path, prose, mark in zip(self.path, self.prose, self.marked)]

    def lines(self, node: list[int]) -> list[list[int]]:
        """Of each element the nodes from itself up; linear in their total length."""
        out: list[list[int]] = []
        for i, above in enumerate(self.parent):
            out.append([node[i], *(n for n in (out[above] if above >= 0 else ()) if n != node[i])])
        return out


def _hash(*parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\0".join(parts)) - (1 << 63)


def page_blocks(html: str) -> list[tuple[str, str]]:
    """(style path, text) of the blocks that no mark of their own or above them rules out."""
    page, out = Page(html), []
    for e, text in page.blocks:
        if e < 0 or not page.marked[e]:
            styles = []
            while e >= 0:
                styles.append(page.style[e])
                e = page.parent[e]
            out.append(("".join("/" + x for x in reversed(styles)), text))
    return out


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block_type = pa.list_(pa.struct([("path", pa.int64()), ("content", pa.int64()), ("again", pa.bool_()), ("above", pa.list_(pa.int64()))]))
    node_type = pa.list_(pa.struct([("path", pa.int64()), ("style", pa.int64())]))
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            blocks, nodes = [], []
            for html in part.column(2).to_pylist():
                page = Page(html)
                node = page.nodes()
                lines = page.lines(node)
                own, seen = [], set()
                for e, text in page.blocks:
                    key = (node[e] if e >= 0 else ROOT, _hash(text))
                    own.append({"path": key[0], "content": key[1], "again": key in seen, "above": lines[e] if e >= 0 else [ROOT]})
                    seen.add(key)
                styles = {n: _hash(*c) for n, c in zip(node, page.children)} | ({ROOT: 0} if any(e < 0 for e, _ in page.blocks) else {})
                blocks.append(own)
                nodes.append([{"path": n, "style": h} for n, h in styles.items()])
            yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(blocks, block_type), pa.array(nodes, node_type)], ["host", "digest", "blocks", "nodes"])


def _keyed(pages: DataFrame) -> DataFrame:
    html = F.coalesce("html", F.lit(""))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return pages.select(F.col("page_id").cast("long"), "url", host.alias("host"), F.xxhash64(html, F.length(html)).alias("digest"), html.alias("html"))


def page_features(pages: DataFrame) -> DataFrame:
    """Hashed blocks and nodes of each distinct page of a host; written, for several uses."""
    read = _keyed(pages).select("host", "digest", "html").mapInArrow(tables.lean_batches(_features), FEATURES)
    return tables.written(read.groupBy("host", "digest").agg(F.first("blocks").alias("blocks"), F.first("nodes").alias("nodes")))


def _with_all(counts: DataFrame, *keys: str) -> DataFrame:
    """Counts ``n`` by host and other keys, with those of all hosts together."""
    return counts.unionByName(counts.groupBy(*keys).agg(F.sum("n").alias("n")).withColumn("host", F.lit(ALL)))


def _entropy(m: Column) -> Column:
    """Entropy of counts n (pages with a value) of m pages, relative to its largest, log m."""
    n = F.col("n").cast("double")
    return F.when(m > 1, 1 - F.sum(n * F.log(n)) / (F.sum(n) * F.log(m))).otherwise(F.lit(1.0))


def _shrunk(own: Column, m: Column, prior: Column) -> Column:
    """``own`` with the weight of m - 1 pages, ``prior`` with that of TRUST pages."""
    return ((m - 1) * own + TRUST * prior) / (m - 1 + TRUST)


def _placed(importance: Column) -> Column:
    """The importance of a node or content, with the part that prose has from its place."""
    return F.when(F.col("path").bitwiseAND(F.lit(2)) == 2, PROSE + (1 - PROSE) * importance).otherwise(importance)


def style_tree(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Branches (``host, path, m, importance``) and contents (``host, path, content, importance``) of each host."""
    nodes = features.select("host", F.explode("nodes").alias("k")).select("host", "k.path", "k.style")
    styles = _with_all(nodes.groupBy("host", "path", "style").agg(F.count("*").alias("n")), "path", "style")
    branch = tables.cut(styles.groupBy("host", "path").agg(F.sum("n").alias("m"), _entropy(F.sum("n")).alias("style_entropy")))

    block = features.select("host", F.explode("blocks").alias("b")).select("host", "b.*")
    contents = tables.cut(block.where("NOT again").groupBy("host", "path", "content").agg(F.count("*").alias("n")))
    pages_of = branch.select("host", "path", "m")
    # The largest share any content can have is that of all pages that hold its node.
    met = _with_all(contents, "path", "content").join(pages_of, ["host", "path"])
    content_entropy = met.groupBy("host", "path").agg(_entropy(F.first("m")).alias("content_entropy"))

    below = block.select("host", "path", F.explode("above").alias("branch")).groupBy("host", "path", "branch").agg(F.count("*").alias("n"))
    weighed = _with_all(below, "path", "branch").join(content_entropy, ["host", "path"])
    mean = weighed.groupBy("host", F.col("branch").alias("path")).agg((F.sum(F.col("n") * F.col("content_entropy")) / F.sum("n")).alias("mean"))
    known = branch.join(mean, ["host", "path"]).select("host", "path", "m", (GAMMA * F.col("mean") + (1 - GAMMA) * F.col("style_entropy")).alias("own"))
    over_all = known.where(F.col("host") == ALL).select("path", _shrunk(F.col("own"), F.col("m"), F.lit(1.0)).alias("_all"))
    factor = F.when(F.col("path").bitwiseAND(F.lit(1)) == 1, F.lit(UNIMPORTANT)).otherwise(F.lit(1.0))
    shrunk = _placed(_shrunk(F.col("own"), F.col("m"), F.col("_all")))
    branches = known.where(F.col("host") != ALL).join(over_all, "path").select("host", "path", "m", (factor * shrunk).alias("importance"))

    n, m = F.col("n").cast("double"), F.col("m").cast("double")
    told = contents.join(pages_of, ["host", "path"])
    said = told.select("host", "path", "content", _placed(_shrunk(F.when(m > 1, F.log(m / n) / F.log(m)).otherwise(F.lit(1.0)), m, F.lit(1.0))).alias("importance"))
    return branches, said


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            texts = []
            for html, branches, contents in zip(*(part.column(c).to_pylist() for c in ("html", "branches", "contents"))):
                page = Page(html)
                low, said = set(branches or ()), {(c["path"], c["content"]) for c in contents or ()}
                node = page.nodes()
                gone: list[bool] = []
                for i, above in enumerate(page.parent):
                    gone.append(page.marked[i] or node[i] in low or above >= 0 and gone[above])
                stay = []
                for e, text in page.blocks:
                    path, removed = (node[e], gone[e]) if e >= 0 else (ROOT, ROOT in low)
                    if not removed and not (said and (path, _hash(text)) in said):
                        stay.append(text)
                texts.append("\n\n".join(stay))
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text``: the blocks that stay, joined by an empty line."""
    features = page_features(pages)
    branches, contents = style_tree(features)
    low = F.col("importance") < MIN_IMPORTANCE
    # A marked branch is under the bound whatever its entropy (at most UNIMPORTANT): each page drops it by itself.
    unmarked = F.col("path").bitwiseAND(F.lit(1)) == 0
    low_branches = tables.cut(branches.where(low & unmarked).select("host", "path"))
    low_contents = tables.cut(contents.where(low & unmarked).select("host", "path", "content"))
    node = features.select("host", "digest", F.explode("nodes.path").alias("path")).where(unmarked)
    block = features.select("host", "digest", F.explode("blocks").alias("b")).select("host", "digest", "b.path", "b.content", "b.again").where(~F.col("again") & unmarked)
    one = node.join(low_branches, ["host", "path"]).select("host", "digest", "path", F.lit(None).cast("long").alias("content"))
    two = block.join(low_contents, ["host", "path", "content"]).select("host", "digest", "path", "content")
    found = one.unionByName(two)
    gone = found.groupBy("host", "digest").agg(
        F.collect_set(F.when(F.col("content").isNull(), F.col("path"))).alias("branches"), F.collect_set(F.when(F.col("content").isNotNull(), F.struct("path", "content"))).alias("contents")
    )
    marked = tables.skewed_join(_keyed(pages), tables.cut(gone), ["host", "digest"], how="left")
    return marked.select("page_id", "url", "html", "branches", "contents").mapInArrow(tables.lean_batches(_cleaned), RESULT)


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(tables.pages(spark, sf_dir)).withColumn("n_chars", F.length("text").cast("long"))


QUERIES = {"op8_html_extraction": op8_html_extraction}
ORACLE_SQL: dict[str, str] = {}
