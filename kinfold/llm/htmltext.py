"""Main text of pages by a site style tree.

A page is parsed once, in time proportional to its length, into blocks of text and the paths of the elements around them. The
DOMs of a host's pages are merged into one tree of element paths (tag, normalised class and id, number among those alike). Over
the m pages that hold a path:

- presentation: the entropy (to base m) of the styles, i.e. sequences of child elements, in which
  pages fill it; many styles say that a node carries content;
- content: one less the mean entropy over the pages of its texts, those of paragraphs, headings and list items in it
  included; a text that every page repeats has entropy 1 and makes the node noise;
- a node's importance joins both with its children's, weighted by ``gamma`` to the power of their number.

Branches that are below ``threshold`` with all that is in them are noise and left out of each page. Paragraphs and
headings are never judged by themselves, as articles may share passages. A page of which less than a tenth would be left is a
copy of others, not a template, and stays whole. Elements that HTML or their names
mark as no content (menus, footers, adverts, forms, comments, ...) are noise whatever the entropy says, and don't enter the tree.

A tree has a row per path and style of its host, however many pages the host has; counts are added up
in each task first, so a host with a third of all pages weighs no more than its template.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

# Element names and the words of class, id and role that mark what isn't main text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript template".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th caption figcaption".split())
NOISE_TAGS = frozenset("nav footer aside form button select menu dialog svg canvas object audio video head".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer "
    "cookie cookies consent gdpr notice notices alert popup modal newsletter subscribe subscription signup login comment comments disqus respond replies reply "
    "share sharing social related recommended pagination pager widget toolbar masthead form search skip".split()
)
#: Words that leave a name with one of the above what it is ("social-links"); others make it another ("share-price", "with-sidebar").
PLAIN_WORDS = frozenset(
    "site main page top bottom left right list area box container wrapper wrap inner outer item items link links bar block section unit slot button buttons icon icons "
    "post posts article articles story stories entry entries content text body row col column group panel global primary secondary header head title heading user reader visitor "
    "more also for the and of to us me you your in on this that thread node root holder space zone region module component view first last sticky fixed small large mobile desktop".split()
)
HEADER_WORDS = frozenset("header masthead".split())
#: Names that make an element content even if another of its names says otherwise.
CONTENT_NAMES = frozenset("content article post entry story main body text".split())
REGIONS = ("article", "main")
#: An opening element that ends those of its kind (or a paragraph) that are still open, within the last of BOUNDS.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
BOUNDS = frozenset("ul ol dl table select".split())
#: Elements of one parent with one tag and the same names that have paths of their own; further ones share one.
ALIKE = 8
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>")
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_COMMENT_END = re.compile(r"--!?>")
_RAW_END = {tag: re.compile(f"</{tag}(?=[\\s/>])[^>]*>?", re.I) for tag in RAW}
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)
_DIGITS = re.compile(r"\d+")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _hash(*parts: object) -> int:
    return xxhash.xxh3_64_intdigest("\x00".join(map(str, parts))) >> 1


@lru_cache(maxsize=20_000)
def named_noise(kind: str) -> tuple[bool, bool]:
    """Whether class names and an id mark noise, and whether they mark a header.

    A name marks noise if it has a noise word and no words but such and plain ones; another name of the
    element that means content outweighs it.
    """
    names = [{w.lower() for w in _WORDS.findall(name)} for name in kind.split()]
    if any(len(words) == 1 and words <= CONTENT_NAMES for words in names):
        return False, False
    noise = any(words & NOISE_WORDS and words <= NOISE_WORDS | PLAIN_WORDS for words in names)
    return noise, any(words & HEADER_WORDS and words <= HEADER_WORDS | PLAIN_WORDS for words in names)


class Node:
    __slots__ = ("tag", "parent", "path", "noise", "header", "under_noise", "holds_region", "regions", "children", "texts", "left_out", "header_out", "judged_at", "judged_above", "alike")

    def __init__(self, tag: str, parent: Node | None, path: int) -> None:
        self.tag, self.parent, self.path = tag, parent, path
        self.noise = self.header = self.under_noise = self.holds_region = False
        self.regions: frozenset[str] = parent.regions if parent else frozenset()
        self.children: list[str] = []
        self.texts: list[str] = []
        self.alike: dict[str, int] | None = None  # numbers of children by tag and names

    @property
    def judged(self) -> bool:
        return self.tag not in PROSE and self.tag not in REGIONS and self.tag not in ("html", "body", "#root")


class Page:
    """The block elements of a page and its texts in page order; unclosed and stray tags are tolerated.

    Every step takes time in proportion to what it consumes, however tags nest or fail to end: after an attribute whose
    quote never ends, a tag ends at the next ``>``.
    """

    def __init__(self, source: str) -> None:
        self.root = Node("#root", None, 0)
        self.nodes = [self.root]
        self.blocks: list[tuple[Node, str]] = []
        self._stack, self._held = [self.root], []
        self._open_at: defaultdict[str, list[int]] = defaultdict(list)  # places in the stack by tag
        self._bounds = [0]
        self._parse(source)
        self._flush()
        self._settle()

    def _parse(self, source: str) -> None:
        hold, at, loose, last, last_cdata = self._held.append, 0, False, source.rfind(">"), source.rfind("]]>")
        while (begin := source.find("<", at)) >= 0:
            if begin > at:
                hold(source[at:begin])
            at = begin
            if source.startswith("<!--", at):
                end = _COMMENT_END.search(source, at + 4)
                at = end.end() if end else len(source)
            elif source.startswith("<![CDATA[", at) and at < last_cdata:
                end = source.find("]]>", at)
                hold(source[at + 9 : end])
                at = end + 3
            elif at > last:
                break  # no tag ends any more
            elif source[at + 1 : at + 2] in ("!", "?"):
                at = source.find(">", at) + 1
            else:
                m = None if loose else _TAG.match(source, at)
                if m is None and (m := _LOOSE_TAG.match(source, at)):
                    loose = True
                if m is None:
                    hold("<")
                    at += 1
                    continue
                at, tag = m.end(), m[2].lower()
                if m[1]:
                    self._close(tag)
                elif tag in RAW:
                    end = _RAW_END[tag].search(source, at)
                    at = end.end() if end else len(source)
                elif tag in INLINE:
                    if tag == "br":
                        hold(" ")
                else:
                    self._open(tag, m[3], source[at - 2] == "/")
        hold(source[at:])

    def _flush(self) -> None:
        if not self._held:
            return
        text = " ".join(html.unescape("".join(self._held)).split())
        self._held.clear()
        if text:
            node = self._stack[-1]
            self.blocks.append((node, text))
            node.texts.append(text)

    def _cut(self, at: int) -> None:
        """Close the stack's elements from ``at`` on."""
        while len(self._stack) > at:
            self._open_at[self._stack.pop().tag].pop()
        while self._bounds[-1] >= at > 0:
            self._bounds.pop()

    def _open(self, tag: str, attributes: str, empty: bool) -> None:
        self._flush()
        stack = self._stack
        if tag in VOID:
            return
        if stack[-1].tag == "p":  # a block element ends a paragraph
            self._cut(len(stack) - 1)
        for name in CLOSES.get(tag, ()):
            if self._open_at[name] and self._open_at[name][-1] > self._bounds[-1]:
                self._cut(self._open_at[name][-1])
        named = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes)} if attributes.strip(" /") else {}
        kind = f"{named.get('class', '')} {named.get('id', '')}".strip()
        label = f"{tag}.{' '.join(sorted(_DIGITS.sub('#', kind).split()))}" if kind else tag
        parent = stack[-1]
        if tag not in PROSE and tag not in REGIONS:  # those alike are told apart by their order, the first ones at least
            parent.alike = counts = parent.alike or {}
            counts[label] = number = min(counts.get(label, 0) + 1, ALIKE)
            label = f"{label}:{number}"
        node = Node(tag, parent, _hash(parent.path, label))
        if tag not in ("html", "body", "main"):
            noise, header = named_noise(kind) if kind else (False, False)
            node.header = tag == "header" or header
            node.noise = tag in NOISE_TAGS or noise or named.get("role", "").lower() in NOISE_ROLES or "hidden" in named or named.get("aria-hidden") == "true" or bool(_HIDDEN.search(named.get("style", "")))
        node.under_noise = parent.under_noise or node.noise
        if tag in REGIONS:
            node.regions = parent.regions | {tag}
            above = None if node.under_noise else parent
            while above is not None and not above.holds_region:
                above.holds_region = True
                above = above.parent
        parent.children.append(label)
        self.nodes.append(node)
        if not empty:
            self._open_at[tag].append(len(stack))
            if tag in BOUNDS:
                self._bounds.append(len(stack))
            stack.append(node)

    def _close(self, tag: str) -> None:
        if tag in INLINE:
            return
        self._flush()
        if self._open_at[tag]:
            self._cut(self._open_at[tag][-1])

    def _settle(self) -> None:
        """What each node is left out for, and the nearest path that the tree may judge it by, from the root down."""
        self.root.left_out = self.root.header_out = False
        self.root.judged_at = self.root.judged_above = 0
        for node in self.nodes[1:]:
            above = node.parent
            node.left_out = above.left_out or (node.noise and not node.holds_region)
            node.header_out = above.header_out or (node.header and not node.holds_region)
            node.judged_above = node.judged_at = 0 if node.tag in REGIONS else above.judged_at
            if node.judged and not node.holds_region:
                node.judged_at = node.path

    def kept(self) -> tuple[str, list[tuple[Node, str]]]:
        """The region that holds the main text (article, else main, else "") and the blocks in it outside named noise."""
        # A page's header goes; of an article's, its headings stay.
        kept = [(n, t) for n, t in self.blocks if not n.left_out and not (n.header_out and not (n.regions and n.tag in _HEADINGS))]
        for region in REGIONS:
            inside = [(n, t) for n, t in kept if region in n.regions]
            if inside:
                return region, inside
        return "", kept

    def main_text(self, pruned: frozenset[int] | set[int] = frozenset()) -> str:
        """The kept blocks outside ``pruned`` paths, joined by empty lines; all, if less than a tenth would be left."""
        _, kept = self.kept()
        left = [(n, t) for n, t in kept if n.judged_at not in pruned]
        if 10 * sum(len(t) for _, t in left) < sum(len(t) for _, t in kept):
            left = kept
        return "\n\n".join(t for _, t in left)


def host_of(url: str | None) -> str:
    _, found, rest = (url or "").partition("://")
    return re.split(r"[/?#]", rest, maxsplit=1)[0].lower() if found else ""


_BLOCKS = pa.list_(pa.struct([("text", pa.string()), ("path", pa.int64())]))
_ROW = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("blocks", _BLOCKS),
    ("host", pa.string()), ("path", pa.int64()), ("parent", pa.int64()), ("kind", pa.int32()), ("feature", pa.int64()), ("pages", pa.int64()), ("extra", pa.int64()),
])
_ROW_DDL = "page_id long, url string, blocks array<struct<text: string, path: long>>, host string, path long, parent long, kind int, feature long, pages long, extra long"
_PAGE, _NODE, _STYLE, _TEXT = -1, 0, 1, 2
#: Bytes of html whose blocks are put out at once.
_OUT_BYTES = 4 << 20


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each page with its kept blocks, and counts of pages by node, style and text, added up over a batch."""
    for ids, urls, sources in common.columns_of(batches, "page_id", "url", "html"):
        counts: Counter = Counter()
        extra: dict[tuple, int] = {}
        rows: list[tuple] = []
        held = 0
        for page_id, url, source in zip(ids, urls, sources, strict=True):
            host, page, seen = host_of(url), Page(source or ""), set()
            region, kept = page.kept()
            rows.append((page_id, url, [{"text": t, "path": n.judged_at} for n, t in kept], host, None, None, _PAGE, None, None, None))
            for node in page.nodes[1:]:
                # What the main text isn't taken from anyway has no part in the tree.
                if node.left_out or not node.judged_at or (region and region not in node.regions):
                    continue
                if node.judged_at == node.path:
                    seen.add((host, node.path, node.judged_above, _NODE, 0))
                    style = [c for i, c in enumerate(node.children) if i == 0 or c != node.children[i - 1]]
                    seen.add(key := (host, node.path, node.judged_above, _STYLE, _hash(*style)))
                    extra[key] = len(style)
                # Texts are those of the nearest judged node; its other rows name its parent.
                seen.update((host, node.judged_at, None, _TEXT, _hash(t)) for t in node.texts)
            counts.update(seen)
            held += len(source or "")
            if held > _OUT_BYTES:
                yield common.batch_of(_ROW, *zip(*rows, strict=True))
                rows, held = [], 0
        rows += [(None, None, None, *key, n, extra.get(key, 0)) for key, n in counts.items()]
        if rows:
            yield common.batch_of(_ROW, *zip(*rows, strict=True))


def importance(nodes: dict[int, dict], gamma: float) -> dict[int, float]:
    """Importance by path of one host's tree.

    ``nodes``: path -> parent, m (pages), presentation (entropy of its styles), width (mean number of children),
    content (one less mean entropy of its texts, None without texts).
    """
    below: dict[int, list[int]] = defaultdict(list)
    for path, node in nodes.items():
        below[node["parent"]].append(path)
    out: dict[int, float] = {}
    order, todo = [], [p for p, n in nodes.items() if n["parent"] not in nodes or n["parent"] == p]
    placed = set(todo)
    while todo:
        path = todo.pop()
        order.append(path)
        for child in below[path]:
            if child not in placed:
                placed.add(child)
                todo.append(child)
    for path in reversed(order):
        node = nodes[path]
        if node["m"] <= 1:
            out[path] = 1.0
            continue
        parts = [(nodes[c]["m"], out[c]) for c in below[path] if c in out and c != path]
        if node["content"] is not None:
            parts.append((node["m"], node["content"]))
        if not parts:
            out[path] = node["presentation"]
            continue
        mean = sum(m * v for m, v in parts) / sum(m for m, _ in parts)
        weight = gamma ** max(1.0, node["width"])
        # Presentation can only speak for a node with child elements.
        out[path] = (1 - weight) * node["presentation"] + weight * mean if below[path] else mean
    return out


def noisy(nodes: dict[int, dict], gamma: float, threshold: float) -> set[int]:
    """Paths that are of low importance and so are all paths below them: a branch with content in it isn't noise."""
    low = {p for p, v in importance(nodes, gamma).items() if v < threshold}
    spared = set()
    for path in nodes:
        if path not in low:
            at = nodes[path]["parent"]
            while at in low and at not in spared:
                spared.add(at)
                at = nodes[at]["parent"]
    return low - spared


def noise_paths(parsed: DataFrame, threshold: float = 0.2, gamma: float = 0.9, least_pages: int = 2) -> DataFrame:
    """One row per host with noise by entropy: host, paths.

    ``parsed``: rows of ``_parsed``. What only fewer than ``least_pages`` pages hold can't be told from content and isn't judged.
    """
    counted = parsed.where(F.col("kind") != _PAGE).groupBy("host", "path", "kind", "feature").agg(F.sum("pages").alias("pages"), F.min("parent").alias("parent"), F.max("extra").alias("extra"))
    spread = F.col("pages") * F.log("pages")
    # Sums from which each node's entropies follow: by node, one row.
    nodes = counted.groupBy("host", "path").agg(
        F.min("parent").alias("parent"),
        F.sum(F.when(F.col("kind") == _NODE, F.col("pages"))).alias("m"),
        F.sum(F.when(F.col("kind") == _STYLE, spread)).alias("style_spread"),
        F.sum(F.when(F.col("kind") == _STYLE, F.col("pages") * F.col("extra"))).alias("width"),
        F.sum(F.when(F.col("kind") == _TEXT, F.log("pages"))).alias("text_entropy"),
        F.count(F.when(F.col("kind") == _TEXT, 1)).alias("texts"),
    ).where(F.col("m") >= least_pages)

    def judge(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        tree = {}
        for r in rows:
            log_m = math.log(r["m"])
            tree[r["path"]] = {
                "parent": r["parent"], "m": r["m"], "width": (r["width"] or 0) / r["m"],
                "presentation": max(0.0, (log_m - (r["style_spread"] or 0.0) / r["m"]) / log_m),
                "content": 1 - r["text_entropy"] / r["texts"] / log_m if r["texts"] else None,
            }
        low = sorted(noisy(tree, gamma, threshold))
        return pa.table([pa.array([rows[0]["host"]] if low else [], pa.string()), pa.array([low] if low else [], pa.list_(pa.int64()))], names=["host", "paths"])

    return nodes.groupBy("host").applyInArrow(judge, "host string, paths array<long>")


def main_texts(pages: DataFrame, threshold: float = 0.2, gamma: float = 0.9, least_pages: int = 2) -> DataFrame:
    """One row per page: page_id, url, text (empty if none), n_chars.

    A null html is empty. Pages with a null or odd url are one host. Null page ids and repeated rows give rows
    like others; pages that repeat count as pages of their own. Other columns are not read; an empty
    table gives no rows. ``threshold`` 0 switches the tree off.
    """
    common.tune(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    parsed = common.saved(rows.mapInArrow(_parsed, _ROW_DDL), "parsed-pages")
    noise = common.saved(noise_paths(parsed, threshold, gamma, least_pages), "noise-paths")
    joined = parsed.where(F.col("kind") == _PAGE).select("page_id", "url", "blocks", "host").join(noise, "host", "left")
    left = F.filter("blocks", lambda b: ~F.coalesce(F.array_contains("paths", b["path"]), F.lit(False)))

    def size(blocks: Column) -> Column:
        return F.aggregate(blocks, F.lit(0).cast("long"), lambda n, b: n + F.char_length(b["text"]))

    texts = joined.select("page_id", "url", "blocks", F.when(F.col("paths").isNull(), F.col("blocks")).otherwise(left).alias("left"))
    final = F.when(10 * size(F.col("left")) < size(F.col("blocks")), F.col("blocks")).otherwise(F.col("left"))
    texts = texts.select("page_id", "url", F.array_join(F.transform(final, lambda b: b["text"]), "\n\n").alias("text"))
    return texts.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages. Nulls, odd urls, repeats and empty tables: see ``main_texts``."""
    return main_texts(spark.read.parquet(f"{sf_dir}/pages.parquet"))
