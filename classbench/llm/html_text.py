"""Main text of web pages with a site style tree.

Pages are parsed into blocks of text below a tree of styled elements; a node is
known by a chained hash of the labels down to it.  The trees of a host's pages
are merged, each distinct page counting once.  Where a node holds text, its
features are phrases (words cut after every word whose hash is a multiple of
four, so that passages that recur give equal phrases) and link targets, and its
content importance is one less the mean entropy of its features over the pages
that have the node.  An inner node's importance mixes the entropy of its styles
(the sets of child labels that pages give it) with the importance of what it
holds, ``decay ** styles`` to the latter.  A node is unimportant below a share
of the content importance of the node with most of the host's text, with an
allowance for the chance that few features leave; the topmost
nodes that are unimportant with all below them are cut as branches from each
page.

A second signal are elements and names that mark page furniture, though names
never cut what holds the page's own article.  What is left of the article, or of
the body where a page marks no article, is the text.  A page of which the tree
would cut all keeps what the names leave of it.

Statistics are aggregated before they are shuffled, per node and feature.  Only
nodes on ``least_pages`` pages or more of a host are judged, so what meets in one
group is bounded by the nodes of the host's templates: labels carry no numbers.

Markup: parsing is linear in the page.  A tag without a ``>`` after it is text.
When 64 tags of a page had quotes that no bare ``>`` follows, its later tags end
at the first ``>``, quoted or not.

Defined results: null and empty pages have an empty text; a null URL belongs to
the host ``""``; repeated rows repeat and count once in the tree; an empty
table yields no rows; other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import html as entities
import re
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from classbench.llm.common import materialize, read_table
from classbench.llm.urls import url_host
from classbench.session import ship_by_value

QUOTED_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
#: Tags of a page with unclosed quotes after which quotes are not heeded.
BROKEN_QUOTES = 64
TARGET = re.compile(r"href\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
#: Fixed values of HTML: elements without content, raw text, inline ones, and ones that a block start closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
                   "strong sub sup time tt u var".split())
CLOSED_BY_BLOCK = frozenset(["p"])
SIBLING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
           "option": ("option",)}
#: Elements, roles and name words of page furniture; the second set counts outside the article alone.
NOISE_TAGS = frozenset("nav footer aside form script style noscript template iframe svg button select textarea dialog head title "
                       "object canvas menu".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
NOISE_WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs footer sidebar aside widget ad ads advert adverts advertisement "
    "advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice popup modal newsletter subscribe signup "
    "share sharing social related recommended comment comments discussion disqus reply replies respond pagination pager login".split())
#: Words that say where a part is; the word after them says what it is, as in ``site-footer``.
PLACES = frozenset("site page main top bottom left right side post entry article blog global primary secondary mobile desktop inner outer".split())
OUTER_TAGS, OUTER_WORDS = frozenset(["header"]), frozenset("header masthead banner search topbar toolbar".split())
MAIN_TAGS, MAIN_ROLES = frozenset(["article", "main"]), frozenset(["main", "article"])


@dataclass(eq=False)
class Part:
    """An article or an element whose names mark it as furniture: characters of text, and the part that holds it."""

    named: bool
    tag: str = ""  # "main" or "article" for what marks the page's own text
    free: bool = True  # no element that holds it is furniture by name
    shown: bool = False  # an article outside of noise elements
    chars: int = 0
    holder: Part | None = None
    holds_own: bool = False
    cut: bool = False


@dataclass
class Node:
    tag: str
    label: str
    noise: bool
    main: bool
    part: Part | None = None
    key: int = 0


@dataclass
class Block:
    """Text of one block: its pieces in order, the node that holds it, whether furniture, article or a cut branch does."""

    node: int
    noise: bool
    main: bool
    cut: bool = False
    pieces: list[str] = field(default_factory=list)
    links: list[str] = field(default_factory=list)
    part: Part | None = None

    def text(self) -> str:
        return " ".join("".join(self.pieces).split())


def _names_part(name: str, words: frozenset[str]) -> bool:
    """Whether a name is one of the words, starts with one, or has one next to words of place."""
    found = [w for w in re.split(r"[^a-z]+", name) if w]
    while len(found) > 1 and found[0] in PLACES:
        del found[0]
    return bool(found) and found[0] in words


def _styled(tag: str, attributes: str, in_main: bool) -> Node:
    """A node's label is its element and its names without numbers; its part is set where names alone call it noise."""
    names, role = [], ""
    if "=" in attributes:
        for m in ATTRIBUTE.finditer(attributes):
            value = entities.unescape(m[2] or m[3] or m[4] or "").lower()
            if m[1].lower() == "role":
                role = value
            else:
                names += value.split()
    noise = tag in NOISE_TAGS or role in NOISE_ROLES or (not in_main and tag in OUTER_TAGS)
    named = any(_names_part(n, NOISE_WORDS) or (not in_main and _names_part(n, OUTER_WORDS)) for n in names)
    label = ".".join([tag, *sorted({re.sub(r"\d+", "#", n) for n in names})])
    whole = tag in ("html", "body")
    kind = tag if tag in MAIN_TAGS else role if role in MAIN_ROLES else ""
    part = Part(named and not whole, kind) if (named and not whole or kind) and not noise else None
    return Node(tag, label, noise and not whole, bool(kind) and not noise, part)


def _judge_names(blocks: list[Block], parts: list[Part]) -> None:
    """Make blocks noise that lie in furniture by name, other than what holds the page's own text.

    That is what is or holds a main element or the longest article, or, if no
    article stands outside of furniture by name, any article (with a main
    element: if they are most of it).  Articles that a name calls furniture, as
    comments often are, count where the page marks nothing else.  On a page
    without marks it is what holds most of the text.
    """
    total = 0
    for b in blocks:
        if not b.noise:
            size = len(b.text())
            total += size
            if b.part:
                b.part.chars += size
    for p in reversed(parts):  # parts come after what holds them
        if p.holder:
            p.holder.chars += p.chars
    marked = [p for p in parts if p.tag and p.chars]
    mains, articles = [p for p in marked if p.tag == "main"], [p for p in marked if p.tag == "article"]
    clean = [p for p in articles if not p.named]
    own = list(mains)
    if any(p.free for p in clean):
        own += [p for p in clean if p.free] + [max(clean, key=lambda p: p.chars)]
    elif clean and (not mains or 2 * sum(p.chars for p in clean) > max(p.chars for p in mains)):
        own += clean
    elif not mains:
        own += articles
    for p in own:
        p.holds_own = p.shown
    for p in reversed(parts):
        if p.holder:
            p.holder.holds_own |= p.holds_own
    for p in parts:
        p.cut = (p.named and not p.holds_own and (bool(marked) or 2 * p.chars <= total)) or (p.holder is not None and p.holder.cut)
    for b in blocks:
        b.noise = b.noise or (b.part is not None and b.part.cut)


def _joined(runs: list[Block]) -> Block:
    """One block of a line's runs, without the furniture in a line of text; white space at its ends parts words."""
    if len(runs) == 1:
        return runs[0]
    first = runs[0]
    block = Block(first.node, all(run.noise or not "".join(run.pieces).strip() for run in runs), first.main, first.cut)
    block.links = [link for run in runs for link in run.links]
    for run in runs:
        text = "".join(run.pieces)
        if block.noise or not run.noise:
            block.pieces.append(text)
        elif text[:1].isspace() or text[-1:].isspace():
            block.pieces.append(" ")
    return block


def page_blocks(page: str | None, cut: frozenset[int] = frozenset(), tree: dict[int, int] | None = None) -> list[Block]:
    """Blocks with text, in page order; malformed markup is closed as browsers close it.

    Blocks below a node of ``cut`` are marked; ``tree`` receives each node's parent.
    """
    import xxhash

    page = page or ""
    lines: list[list[Block]] = []  # the runs of each block that the same parts hold
    stack: list[Node] = []
    places: dict[str, list[int]] = {}  # positions of each open tag in the stack
    depth_noise = depth_main = depth_cut = 0
    parts: list[Part] = []
    held: Part | None = None  # the innermost part that holds what comes next
    block: list[Block] | None = None
    link: str | None = None  # the target of a link whose text comes next
    broken, last_end = 0, page.rfind(">")
    at, size = 0, len(page)

    def push(node: Node) -> None:
        nonlocal depth_noise, depth_main, depth_cut, held
        above = stack[-1].key if stack else 0
        node.key = above
        if node.tag not in INLINE:
            node.key = xxhash.xxh64_intdigest(f"{above:x} {node.label}".encode("utf-8", "replace")) >> 1
            depth_cut += node.key in cut
            if tree is not None:
                tree[node.key] = above
        places.setdefault(node.tag, []).append(len(stack))
        stack.append(node)
        depth_noise += node.noise
        depth_main += node.main
        if node.part:
            node.part.free = held is None or (held.free and not held.named)
            node.part.holder, held = held, node.part
            node.part.shown = bool(node.part.tag) and not depth_noise
            parts.append(node.part)

    def pop_to(k: int) -> bool:
        """Close all from position ``k`` on; whether a block element was among them."""
        nonlocal depth_noise, depth_main, depth_cut, held, link
        outer = False
        for node in stack[k:]:
            places[node.tag].pop()
            if node.part:
                held = held.holder
            depth_noise -= node.noise
            depth_main -= node.main
            if node.tag not in INLINE:
                depth_cut -= node.key in cut
                outer = True
            elif node.tag == "a":
                link = None
        del stack[k:]
        return outer

    def find(tags, stop=()) -> int:
        """Position of the innermost open element of ``tags``, -1 if one of ``stop`` is further in."""
        innermost = lambda names: max((places[n][-1] for n in names if places.get(n)), default=-1)
        k = innermost(tags)
        return k if k >= innermost(stop) else -1

    def say(text: str) -> None:
        nonlocal block, link
        if block is None:
            if text.isspace():
                return
            block = [Block(stack[-1].key if stack else 0, depth_noise > 0, depth_main > 0, depth_cut > 0, part=held)]
            lines.append(block)
        elif block[-1].noise != (depth_noise > 0) or block[-1].part is not held:  # furniture within a line of text
            block.append(Block(block[0].node, depth_noise > 0, block[0].main, block[0].cut, part=held))
        block[-1].pieces.append(entities.unescape(text))
        if link:
            block[-1].links.append(link)
            link = None

    while at < size:
        if page[at] != "<":
            end = page.find("<", at)
            end = size if end < 0 else end
            say(page[at:end])
            at = end
            continue
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            at = size if end < 0 else end + 3
            continue
        if at > last_end:  # no tag can end any more: all is text up to a comment
            end = page.find("<!--", at)
            end = size if end < 0 else end
            say(page[at:end])
            at = end
            continue
        if page[at + 1] in "!?":
            at = page.find(">", at) + 1
            continue
        m = QUOTED_TAG.match(page, at) if broken < BROKEN_QUOTES else None
        if m is None:
            m = PLAIN_TAG.match(page, at)
            if m is None:
                say("<")
                at += 1
                continue
            broken += 1
        at = m.end()
        tag, closing, attributes = m[2].lower(), m[1], m[3] or ""
        if closing:
            if tag == "br":
                if block:
                    block[-1].pieces.append(" ")
                continue
            k = find((tag,), ("td", "th", "table") if tag in INLINE else ())
            if k >= 0 and pop_to(k):
                block = None
            elif tag not in INLINE:
                block = None
            continue
        if tag in VOID:
            if tag == "hr":
                block = None
            elif tag == "br" and block:
                block[-1].pieces.append(" ")
            continue
        if tag not in INLINE:
            k = find(CLOSED_BY_BLOCK, ("button", "td", "th", "table", "article", "div", "section", "body"))
            if k >= 0:
                pop_to(k)
            if tag in SIBLING:
                k = find(SIBLING[tag], ("ul", "ol", "dl", "table", "select"))
                if k >= 0:
                    pop_to(k)
            block = None
        node = _styled(tag, attributes, depth_main > 0)
        if attributes.rstrip().endswith("/") and tag in RAW:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            at = size if end is None else max(page.find(">", end.start()) + 1, end.end())
            continue
        push(node)
        if tag == "a" and (target := TARGET.search(attributes)):
            link = entities.unescape(target[1] or target[2] or target[3] or "")
    if parts:
        _judge_names([run for line in lines for run in line], parts)
    return [b for b in map(_joined, lines) if not b.text() == ""]


def phrases(text: str) -> Iterator[bytes]:
    """The text's lower-cased words in phrases, each cut after a word whose hash is a multiple of four."""
    words, start = text.lower().encode("utf-8", "replace").split(b" "), 0
    for i, checksum in enumerate(map(zlib.crc32, words), 1):
        if not checksum & 3:
            yield b" ".join(words[start:i])
            start = i
    if start < len(words):
        yield b" ".join(words[start:])


def page_features(page: str | None) -> list[tuple[int, int, int | None]]:
    """What a page adds to its host's tree: (node, feature, null) for each distinct phrase and link target of a node, and
    (node, style, parent) for each node; a style is the set of the labels of the node's children."""
    import xxhash

    tree: dict[int, int] = {}
    blocks = page_blocks(page, tree=tree)
    digest = xxhash.xxh64_intdigest
    seen = {(b.node, digest(f) >> 1) for b in blocks for f in phrases(b.text())}
    seen |= {(b.node, digest(f"\n{link}".encode("utf-8", "replace")) >> 1) for b in blocks for link in b.links}
    styles = dict.fromkeys(tree, 0)
    for node, above in tree.items():
        if above:
            styles[above] ^= node
    return [(node, f, None) for node, f in seen] + [(node, style, tree[node]) for node, style in styles.items()]


def node_importance(nodes: pd.DataFrame, share: float, decay: float) -> pd.DataFrame:
    """The judged nodes of one host (node, parent, content, uses, presentation, styles) with their ``importance`` and ``cut``.

    ``content`` is null where a node holds no text of its own.  What a node holds
    is its own text and its judged children, weighed by their features.  Half the
    inverse root of their number is the allowance that a node has for chance.
    """
    rows = {r.node: r for r in nodes.itertuples()}
    children: dict[int, list[int]] = {}
    for r in rows.values():
        children.setdefault(r.parent, []).append(r.node)
    order = [n for n, r in rows.items() if r.parent not in rows]
    for n in order:  # grows: parents before children
        order += children.get(n, [])
    texts = [r for r in rows.values() if r.uses > 0]
    least = share * max(texts, key=lambda r: (r.uses, r.content)).content if texts else 0.0
    mass, value, low = {}, {}, {}
    for n in reversed(order):
        r, below = rows[n], [c for c in children.get(n, []) if mass[c] > 0]
        mass[n] = r.uses + sum(mass[c] for c in below)
        inner = (r.content * r.uses if r.uses > 0 else 0.0) + sum(value[c] * mass[c] for c in below)
        value[n] = inner / mass[n] if mass[n] > 0 else 0.0
        if below:
            kept = decay ** r.styles
            value[n] = (1 - kept) * r.presentation + kept * value[n]
        low[n] = value[n] + 0.5 * max(mass[n], 1) ** -0.5 < least and all(low[c] for c in below)
    out = nodes[["node", "parent"]].copy()
    out["importance"] = [value[n] for n in out["node"]]
    out["cut"] = [bool(mass[n] > 0 and low[n] and not low.get(up, False)) for n, up in zip(out["node"], out["parent"])]
    return out


def style_tree(pages: DataFrame, page_col: str = "html", host_col: str = "host", least_pages: int = 3,
               share: float = 0.9, decay: float = 0.9) -> DataFrame:
    """(host, node, parent, importance, cut) of the nodes on at least ``least_pages`` distinct pages of a host.

    ``cut`` marks the topmost nodes of unimportant branches.
    """
    ship_by_value(sys.modules[__name__])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):  # few pages' features at once
                some = batch.slice(at, 64)
                found = [page_features(x.as_py()) for x in some.column(2)]
                row = pa.array([i for i, f in enumerate(found) for _ in f], pa.int32())
                node, value, parent = (pa.array([f[k] for one in found for f in one], pa.int64()) for k in range(3))
                yield pa.record_batch([some.column(0).take(row), some.column(1).take(row), node, value, parent],
                                      ["host", "w", "node", "value", "parent"])

    keyed = pages.select(F.coalesce(F.col(host_col), F.lit("")).alias("host"), F.col(page_col).alias("html")).withColumn(
        "key", F.xxhash64("html"))
    repeated = materialize(keyed.groupBy("host", "key").agg(F.count("*").alias("n")).where("n > 1"), "repeated")
    # a page that a host repeats counts once: each of its n rows adds 1 / n
    once = keyed.join(repeated, ["host", "key"], "left").withColumn("w", 1 / F.coalesce("n", F.lit(1)))
    rows = once.select("host", "w", "html").mapInArrow(features, "host string, w double, node long, value long, parent long")
    uses = rows.groupBy("host", "node", "value", "parent").agg(F.round(F.sum("w")).alias("c"))
    style = F.col("parent").isNotNull()
    spread = F.col("c") * F.log("c")
    per = uses.groupBy("host", "node").agg(
        F.max("parent").alias("parent"), F.sum(F.when(style, F.col("c"))).alias("m"), F.count_if(style).alias("styles"),
        F.sum(F.when(style, spread)).alias("_style"), F.coalesce(F.sum(F.when(~style, F.col("c"))), F.lit(0.0)).alias("uses"),
        F.sum(F.when(~style, spread)).alias("_content")).where(F.col("m") >= least_pages)
    judged = per.select("host", "node", "parent", "styles", "uses", (1 - F.col("_content") / F.col("uses") / F.log("m")).alias("content"),
                        (1 - F.col("_style") / F.col("m") / F.log("m")).alias("presentation"))

    def importance(nodes: pd.DataFrame) -> pd.DataFrame:
        found = node_importance(nodes, share, decay)
        found.insert(0, "host", nodes["host"])
        return found

    return judged.groupBy("host").applyInPandas(importance, "host string, node long, parent long, importance double, cut boolean")


def site_styles(pages: DataFrame, page_col: str = "html", host_col: str = "host", **settings) -> DataFrame:
    """(host, cut): the topmost nodes of the branches of each host's style tree that are too unimportant to keep."""
    tree = style_tree(pages, page_col, host_col, **settings)
    return tree.where("cut").groupBy("host").agg(F.sort_array(F.collect_list("node")).alias("cut"))


def main_text(blocks: list[Block], names: bool = True) -> str:
    """Text of the article where the page marks one, else of the body, without cut branches unless nothing else is left.

    Without ``names`` neither articles nor furniture marks count: the tree alone decides.
    """
    held = [b for b in blocks if not b.noise] if names else blocks
    held = ([b for b in held if b.main] if names else []) or held
    return " ".join(b.text() for b in [b for b in held if not b.cut] or held)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", page_col: str = "html") -> DataFrame:
    """(page_id, url, text) of every page."""
    ship_by_value(sys.modules[__name__])
    rows = pages.select(id_col, url_col, F.coalesce(F.col(page_col), F.lit("")).alias("html"), url_host(F.col(url_col)).alias("host"))
    styles = materialize(site_styles(rows), "styles").withColumnRenamed("host", "_host")

    @F.pandas_udf("string")
    def text(page: pd.Series, cut: pd.Series) -> pd.Series:
        return pd.Series([main_text(page_blocks(p, frozenset(c) if c is not None else frozenset())) for p, c in zip(page, cut)])

    joined = rows.join(styles, rows["host"] == styles["_host"], "left")
    return joined.select(id_col, url_col, text("html", "cut").alias("text"))


def op8_html(spark, sf_dir) -> DataFrame:
    """Main text of every page."""
    return extract_text(read_table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
