"""Main text of web pages by wrapper induction.

Every page becomes a tree of its block elements, siblings of one kind taken together, and a list of text blocks, each
in a node.  The tree that most different pages of a host have is its template; every other tree of that host is aligned
with it by simple tree matching, so that nodes get the template's slots; nodes that the template lacks are slots of
their own by the path of element names above them.  A block that stands in its slot on nearly all different pages that
have this slot is constant and becomes template; blocks that vary are content, also in a slot that holds constant ones
beside them.  What varies from page to page without being content (menus, comments, adverts, forms) no comparison of
pages can tell; such elements, and the article where a page marks it, are known by their tags, roles and class names.

Plan: one scan parses the pages and writes trees, block texts and block hashes; alignments are made once for each
different pair of trees of a host, not for each page; equal pages of a host count once, and blocks are counted by hash
with partial sums, so a host with any share of the pages is a few rows a task; what to drop goes back to the pages by a
join on (host, tree), broadcast only while it is small, and no page text is shuffled then.

Defined results: null html counts as empty and gives an empty text; a null or odd url is a host of its own name (the
empty one) and is returned as it is; a page all of whose blocks are template keeps them; a host with fewer than
``least_pages`` different pages has no template; elements may be nested to any depth; repeated rows each get a row and
never make a text constant; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commlens.llm.common import slices, written

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style|template|noscript|textarea|svg|math|iframe|object)\b(?:[^>"']++|"[^"]*+"|'[^']*+')*+>.*?(?:</\1\s*>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[!?/][^>]*>|([^<]++)|(<)""",
    re.S | re.I,
)
ATTR = re.compile(r"""\b(class|id|role|itemprop|aria-hidden|hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
P_CLOSERS = frozenset("address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section table ul".split())
OWN_CLOSERS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
DROP = frozenset("head title nav footer aside form button select dialog menu datalist input".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
AWAY = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|sponsored|sponsor|promo|promotion|banner|cookies?|consent|gdpr|notice|notification|alert|sidebar|side-?bar|widget|menu|nav|navbar|navigation"
    r"|breadcrumbs?|footer|masthead|site-?header|page-?header|topbar|comments?|respond|replies|disqus|share|sharing|social|related|recommended|newsletter|subscribe|signup|popup|modal|overlay|pagination|pager|skip-?link)(?:$|[\s_-])",
    re.I,
)
MAIN = re.compile(r"(?:^|[\s_-])(?:article-?body|post-?(?:content|body)|entry-?content|main-?content)(?:$|[\s_-])", re.I)


class Node:
    __slots__ = ("tag", "id", "away", "main", "key")

    def __init__(self, tag, id_, away, main):
        self.tag, self.id, self.away, self.main = tag, id_, away, main


def parse(html: str) -> tuple[str, list[int], list[str], list[int]]:
    """tree (a line for each node: parent number, kind) and content blocks: node numbers, texts, hashes of texts."""
    from xxhash import xxh3_64_intdigest

    kinds: dict[tuple[int, str], int] = {}
    lines: list[str] = []
    root = Node("", 0, False, False)
    stack, piece = [root], []
    blocks: list[tuple[int, bool, bool, str]] = []

    def flush():
        if piece:
            words = unescape("".join(piece)).split()
            piece.clear()
            if words:
                # the block that the text stands in: the nearest that is not inline
                n = stack[-1]
                blocks.append((n.id, n.away, n.main, " ".join(words)))

    for m in TOKEN.finditer(html):
        text = m[5]
        if text is not None:
            piece.append(text)
            continue
        tag = m[3]
        if tag is None:
            if m[6]:
                piece.append("<")
            continue
        tag = tag.lower()
        if m[2]:
            if tag in INLINE:
                continue
            if tag == "br":
                piece.append(" ")
                continue
            flush()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        if tag == "br" or tag in ("img", "wbr"):
            if tag == "br":
                piece.append(" ")
            continue
        attrs = m[4]
        found = {a.lower(): v1 or v2 or v3 for a, v1, v2, v3 in ATTR.findall(attrs)} if attrs and "=" in attrs or attrs and "hidden" in attrs else None
        if tag in INLINE and not (found and tag not in ("a",) and AWAY.search(" ".join((found.get("class") or "", found.get("id") or "")))):
            continue
        flush()
        if tag in P_CLOSERS:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    del stack[i:]
                    break
                if stack[i].tag in ("article", "div", "section", "main", "td", "body"):
                    break
        if tag in OWN_CLOSERS:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in OWN_CLOSERS[tag]:
                    del stack[i:]
                    break
                if stack[i].tag in ("ul", "ol", "dl", "table", "select"):
                    break
        if tag in VOID:
            continue
        up = stack[-1]
        name, away, main = tag, up.away or tag in DROP, up.main
        if tag == "header":
            away = away or not main
        if found:
            names = " ".join(x for x in (found.get("class"), found.get("id")) if x)
            role, style = (found.get("role") or "").lower(), (found.get("style") or "").replace(" ", "").lower()
            name = f"{tag}.{names}" if names else tag
            away = away or role in ROLES or "hidden" in found or (found.get("aria-hidden") or "").lower() == "true" or "display:none" in style
            if names and tag not in ("html", "body"):
                away = away or bool(AWAY.search(names))
            main = main or role == "main" or (found.get("itemprop") or "").lower() == "articlebody" or bool(names and MAIN.search(names))
        main = main or tag in ("article", "main")
        key = (up.id, name)
        if key not in kinds:
            kinds[key] = len(lines) + 1
            lines.append(f"{up.id} {' '.join(name.split())}")
        stack.append(Node(tag, kinds[key], away, main))
    flush()
    own = [b for b in blocks if not b[1]]
    if any(b[2] for b in own):
        own = [b for b in own if b[2]]
    return "\n".join(lines), [b[0] for b in own], [b[3] for b in own], [_signed(xxh3_64_intdigest(b[3])) for b in own]


def _signed(x: int) -> int:
    """A 64-bit number as a signed long."""
    return x - (1 << 64) if x >> 63 else x


def children_of(tree: str) -> tuple[list[str], list[list[int]]]:
    names, kids = [""], [[]]
    for line in tree.split("\n") if tree else []:
        up, _, name = line.partition(" ")
        kids[int(up)].append(len(names))
        names.append(name)
        kids.append([])
    return names, kids


@lru_cache(maxsize=4096)
def align(tree: str, template: str) -> tuple[int, ...]:
    """Simple tree matching: for each node of ``tree``, the node of ``template`` that it is matched with, or -1."""
    an, ak = children_of(tree)
    bn, bk = children_of(template)
    tables: dict[tuple[int, int], list[list[int]]] = {}
    stack = [(0, 0)]
    while stack:
        i, j = stack[-1]
        x, y = ak[i], bk[j]
        pairs = [(p, q) for p in x for q in y if an[p] == bn[q]] if (i, j) not in tables else []
        open_ = [c for c in pairs if c not in tables]
        if open_:
            stack += open_
            continue
        stack.pop()
        if (i, j) not in tables:
            size = {c: tables[c][-1][-1] + 1 for c in pairs}
            m = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
            for p, u in enumerate(x, 1):
                for q, v in enumerate(y, 1):
                    m[p][q] = max(m[p - 1][q], m[p][q - 1], m[p - 1][q - 1] + size.get((u, v), 0))
            tables[i, j] = m
    out, todo = [-1] * len(an), [(0, 0)]
    while todo:
        i, j = todo.pop()
        out[i] = j
        m, p, q = tables[i, j], len(ak[i]), len(bk[j])
        while p and q:
            u, v = ak[i][p - 1], bk[j][q - 1]
            if an[u] == bn[v] and m[p][q] == m[p - 1][q - 1] + tables[u, v][-1][-1] + 1:
                todo.append((u, v))
                p, q = p - 1, q - 1
            elif m[p][q] == m[p - 1][q]:
                p -= 1
            else:
                q -= 1
    return tuple(out)


def slots_of(tree: str, template: str) -> list[int]:
    """A slot for each node of ``tree``: the template's node, or a negative number that stands for the path of names above it."""
    from xxhash import xxh3_64_intdigest

    names, kids = children_of(tree)
    paths = [0] * len(names)
    for i, own in enumerate(kids):  # parents come before their children
        for c in own:
            paths[c] = xxh3_64_intdigest(f"{paths[i]} {names[c]}")
    return [j if j >= 0 else -1 - (paths[i] >> 2) for i, j in enumerate(align(tree, template))]


def _parse(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from xxhash import xxh3_64_intdigest

    kinds = [pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.int64()), pa.int64()]
    for b in slices(parts, 0):
        rows = [parse(h or "") for h in b.column(0).to_pylist()]
        rows = [(_signed(xxh3_64_intdigest(r[0])), *r, _signed(xxh3_64_intdigest(f"{r[0]}\n{r[1]}\n{r[3]}"))) for r in rows]
        cols = list(zip(*rows)) if rows else [()] * len(kinds)
        yield pa.RecordBatch.from_arrays([*b.columns[1:], *[pa.array(x, k) for x, k in zip(cols, kinds, strict=True)]], names=[*b.schema.names[1:], "tree_id", "tree", "nodes", "texts", "hashes", "page"])


def _aligned(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in parts:
        got = [slots_of(t, s) for t, s in zip(b.column("tree").to_pylist(), b.column("template").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("host"), b.column("tree_id"), pa.array(got, pa.list_(pa.int64()))], names=["host", "tree_id", "slot_of"])


def extract(
    df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", share: float = 0.8, least_pages: int = 5, broadcast_rows: int = 100_000,
) -> DataFrame:
    """id, url, text, n_chars.  A block is template if it stands in its slot on ``share`` of at least ``least_pages`` different pages with that slot."""
    kind = df.schema[id_col].dataType.simpleString()
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url_col), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit("")))
    pages = df.select(F.col(html_col).alias("html"), F.col(id_col).alias("id"), F.col(url_col).alias("url"), host.alias("host"))
    pages = written(pages.mapInArrow(_parse, f"id {kind}, url string, host string, tree_id long, tree string, nodes array<int>, texts array<string>, hashes array<long>, page long"), "pages")
    # Equal pages of a host count once, whatever their number.
    once = pages.groupBy("host", "page").agg(F.first("tree_id").alias("tree_id"), F.first(F.arrays_zip("nodes", "hashes")).alias("blocks"))
    once = written(once, "different-pages")
    trees = once.groupBy("host", "tree_id").agg(F.count("*").alias("n")).join(pages.groupBy("host", "tree_id").agg(F.min("tree").alias("tree")), ["host", "tree_id"])
    trees = written(trees, "trees")
    # What is aggregated is written before its join, so that adaptive execution can split a host with many trees.
    template = trees.groupBy("host").agg(F.max(F.struct("n", F.col("tree_id").alias("i"), "tree")).alias("t"), F.sum("n").alias("all")).where(F.col("all") >= least_pages)
    template = written(template.select("host", F.col("t.tree").alias("template")), "templates")
    aligned = written(trees.join(template, "host").select("host", "tree_id", "tree", "template").mapInArrow(_aligned, "host string, tree_id long, slot_of array<long>"), "aligned")
    node = F.col("b.nodes").alias("node")
    held = once.select("host", "tree_id", F.explode(F.array_distinct("blocks")).alias("b")).groupBy("host", "tree_id", node, F.col("b.hashes").alias("hash")).agg(F.count("*").alias("n"))
    held = written(held.join(aligned, ["host", "tree_id"]).select("host", "tree_id", "node", "hash", "n", F.expr("slot_of[node]").alias("slot")), "held")
    filled = once.select("host", "tree_id", F.explode(F.array_distinct("blocks.nodes")).alias("node")).groupBy("host", "tree_id", "node").agg(F.count("*").alias("n"))
    filled = filled.join(aligned, ["host", "tree_id"]).groupBy("host", F.expr("slot_of[node]").alias("slot")).agg(F.sum("n").alias("all")).where(F.col("all") >= least_pages)
    texts = held.groupBy("host", "slot", "hash").agg(F.sum("n").alias("n"))
    constant = written(texts.join(filled, ["host", "slot"]).where(F.col("n") >= share * F.col("all")).select("host", "slot", "hash"), "constant")
    gone = held.join(constant, ["host", "slot", "hash"], "left_semi").groupBy("host", "tree_id").agg(F.collect_set(F.struct("node", "hash")).alias("gone"))  # a page's constant blocks
    gone = written(gone, "gone")
    small = (gone.agg(F.sum(F.size("gone") + 1)).first()[0] or 0) <= broadcast_rows
    both = pages.join(F.broadcast(gone) if small else gone, ["host", "tree_id"], "left")
    blocks = F.arrays_zip("nodes", "hashes", "texts")
    varies = F.filter(blocks, lambda b: ~F.array_contains("gone", F.struct(b["nodes"].alias("node"), b["hashes"].alias("hash"))))
    kept = F.when(F.col("gone").isNull(), blocks).otherwise(varies)
    text = F.array_join(F.transform(F.when(F.size(kept) > 0, kept).otherwise(blocks), lambda b: b["texts"]), " ")
    return both.select(F.col("id").alias(id_col), "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
