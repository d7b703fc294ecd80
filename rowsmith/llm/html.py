"""Main text of web pages by site style trees.

The pages of one host are merged into one tree: a node is a path of tags with their classes, and it
keeps how often it shows which sequence of children (presentation) and which text (content). The
entropy of a feature over the pages of its host, relative to that of one on all pages, says how far it belongs to the
site rather than to a page; a node's importance is 1 less the mean of its features. A branch is as
important as the most important node in it. Pages drop branches of low importance.

The relative entropy has PRIOR more pages in its base, so that few pages prove little: no number of pages is
a bound, and more pages of one template lower the importance of what they share, never of what differs.

Roles that markup states are priors of the importance: menus, footers, adverts, forms, comments and
the like (NOISE_TAGS, NOISE_NAMES) have importance 0 however varied they are, and what stands in an
article keeps importance 1, with all nodes around it, even if several pages have the same article. Entropy decides
about all other nodes.

Counts are keyed by host, path and feature, so that a host with a large share of all pages is spread
over its features and combined before the shuffle. What a host's tree holds after that is its
templates' paths, not its pages. Pages meet their host's low nodes in a plain join, in which adaptive
execution splits the pages of a large host.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.text import slices, split_rows

PRIOR = 3
LOW = 0.3

# HTML elements by kind, and words in class, id and role that name a part of a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea title iframe".split())
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot "
    "thead tr ul".split()
)
CLOSED_BY_SAME = {"li": {"ul", "ol", "menu"}, "tr": {"table"}, "td": {"tr"}, "th": {"tr"}, "option": {"select"}}
NOISE_TAGS = set(
    "head script style noscript template textarea title iframe nav footer aside form button select dialog menu svg "
    "object canvas audio video".split()
)
CONTENT_TAGS = ("article", "main")
NOISE_NAMES = set(
    "ad ads advert adverts advertisement adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe subscription sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs comment comments reply replies respond discussion disqus related recommended share sharing "
    "social footer widget toolbar pagination pager login signin search form complementary contentinfo".split()
)
SITE_HEADER = {"header", "masthead", "topbar"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL
)
_NAMED = re.compile(r"""(?<![\w-])(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HOST = re.compile(r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


def host(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


class Node:
    __slots__ = ("tag", "path", "parent", "noise", "content", "children", "texts")

    def __init__(self, tag: str, names: str, words: set[str], hidden: bool, parent: Node | None):
        self.tag, self.parent = tag, parent
        self.path = (parent.path if parent else ()) + (f"{tag}.{names}" if names else tag,)
        self.content = tag in CONTENT_TAGS or bool(parent and parent.content)
        header = not self.content and (tag == "header" or bool(words & SITE_HEADER))
        self.noise = bool(parent and parent.noise) or hidden or tag in NOISE_TAGS or header or (
            bool(words & NOISE_NAMES) and tag not in ("html", "body", *CONTENT_TAGS)
        )
        self.children: list[str] = []
        self.texts: list[str] = []


def parse(page: str) -> tuple[list[Node], list[tuple[Node | None, str | None]]]:
    """All nodes, and the page's pieces in order: (node, text), or (node, None) where a block begins or ends."""
    nodes: list[Node] = []
    pieces: list[tuple[Node | None, str | None]] = []
    stack: list[Node] = []
    at, size = 0, len(page)
    folded = None

    def say(text: str) -> None:
        if text:
            node = stack[-1] if stack else None
            text = entities.unescape(text)
            pieces.append((node, text))
            if node is not None:
                node.texts.append(text)

    while at < size:
        found = _TOKEN.search(page, at)
        if found is None:
            say(page[at:])
            break
        say(page[at : found.start()])
        at = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag = tag.lower()
        if found[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag == tag:
                    pieces.extend((x, None) for x in stack[k:] if x.tag in BLOCKS)
                    del stack[k:]
                    break
            continue
        if tag == "br" or tag in ("td", "th"):
            say(" ")
        if tag in BLOCKS:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag in BLOCKS:
                    break
        if tag in CLOSED_BY_SAME:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if stack[k].tag in CLOSED_BY_SAME[tag]:
                    break
        names, words, hidden = [], set(), False
        if found[3]:
            for name, value in _NAMED.findall(found[3]):
                name, value = name.lower(), value.strip("\"'")
                if name == "hidden" or name == "aria-hidden":
                    hidden = hidden or name == "hidden" or value.lower() == "true"
                else:
                    words |= {w.lower() for w in _WORD.findall(value)}
                    if name != "id":
                        names.append(value)
        node = Node(tag, " ".join(names), words, hidden, stack[-1] if stack else None)
        if stack:
            stack[-1].children.append(tag)
        nodes.append(node)
        if tag in BLOCKS:
            pieces.append((node, None))
        if tag in VOID or found[3].endswith("/") and tag not in BLOCKS:
            continue
        if tag in RAW:
            if folded is None:
                folded = page.lower() if len(page.lower()) == size else page
            end = folded.find(f"</{tag}", at)
            at = size if end < 0 else end
        stack.append(node)
    return nodes, pieces


def main_text(page: str, low: set[int]) -> str:
    """Text of a page without branches of noise or of low importance, a line for each block."""
    nodes, pieces = parse(page)
    dropped: dict[int, bool] = {}
    around: set[int] = set()
    for node in nodes:
        if node.content and not node.noise:
            above = node.parent
            while above is not None and id(above) not in around:
                around.add(id(above))
                above = above.parent

    def drop(node: Node | None) -> bool:
        if node is None:
            return False
        known = dropped.get(id(node))
        if known is None:
            kept = node.content or id(node) in around
            known = node.noise or drop(node.parent) or (not kept and path_hash(node.path) in low)
            dropped[id(node)] = known
        return known

    for tag in CONTENT_TAGS:
        if any(n.tag == tag and not drop(n) for n in nodes):
            wanted = tag
            break
    else:
        wanted = None
    inside: dict[int, bool] = {}

    def chosen(node: Node | None) -> bool:
        if wanted is None:
            return True
        if node is None:
            return False
        known = inside.get(id(node))
        if known is None:
            known = node.tag == wanted or chosen(node.parent)
            inside[id(node)] = known
        return known

    lines, held = [], []
    for node, text in pieces:
        if text is None:
            line = " ".join("".join(held).split())
            if line:
                lines.append(line)
            held = []
        elif chosen(node) and not drop(node):
            held.append(text)
    line = " ".join("".join(held).split())
    if line:
        lines.append(line)
    return "\n".join(lines)


def path_hash(path: tuple[str, ...]) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest("/".join(path)) - (1 << 63)


def _hash(text: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Host, node, parent, kind of feature (0 presentation, 1 content, 2 page), feature, times, pages that have it."""
    for batch in slices(batches, 1):
        seen: dict[tuple, int] = {}
        having: dict[tuple, int] = {}
        for url, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            site = host(url)
            hashes: dict[tuple, int] = {}
            here: dict[tuple, int] = {}
            for node in parse(page or "")[0]:
                path = hashes.get(node.path)
                if path is None:
                    path = hashes[node.path] = path_hash(node.path)
                parent = hashes[node.path[:-1]] if node.parent is not None else None
                features = [(0, _hash(" ".join(node.children)))]
                text = " ".join("".join(node.texts).split())
                if text:
                    features.append((1, _hash(text)))
                for kind, value in features:
                    key = (site, path, parent, kind, value)
                    here[key] = here.get(key, 0) + 1
                here[site, path, parent, 2, 0] = 1
            for key, n in here.items():
                seen[key] = seen.get(key, 0) + n
                having[key] = having.get(key, 0) + 1
        columns = list(zip(*seen, strict=True)) if seen else [[]] * 5
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int8(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)),
                pa.array(list(seen.values()), pa.int64()),
                pa.array(list(having.values()), pa.int64()),
            ],
            names=["host", "node", "parent", "kind", "feature", "n", "pages"],
        )


def importance(tree: dict[int, tuple[int | None, float, float | None]]) -> dict[int, float]:
    """Importance of each node's branch, (parent, presentation, content or none) to a number from 0 to 1."""
    below: dict[int, list[int]] = {}
    for node, (parent, *_) in tree.items():
        below.setdefault(parent, []).append(node)
    found: dict[int, float] = {}
    todo = [(n, False) for n, (p, *_) in tree.items() if p not in tree]
    while todo:
        node, ready = todo.pop()
        if not ready:
            todo.append((node, True))
            todo += [(c, False) for c in below.get(node, ())]
            continue
        _, presentation, content = tree[node]
        own = presentation if content is None else max(presentation, content)
        found[node] = max([own, *(found[c] for c in below.get(node, ()))])
    return found


def _low(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for nodes in batch.column(1).to_pylist():
            tree = {x["node"]: (x["parent"], x["presentation"], x["content"]) for x in nodes}
            out.append([n for n, v in importance(tree).items() if v < LOW])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(out, pa.list_(pa.int64()))], names=["host", "low"]
        )


def _host_of(url: str):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")), _HOST.pattern, 1))


def style_trees(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """For each host, ``low``: the nodes of its style tree that have low importance.

    Each distinct html of a host counts once. Only pages that may have copies are shuffled for that.
    """
    rows = pages.select(F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    key = F.xxhash64(_host_of("url"), F.coalesce("html", F.lit("")))
    copied = rows.groupBy(key.alias("h")).count().filter("count > 1").select("h")
    alone, copies = split_rows(rows, key, copied)
    copies = copies.groupBy(_host_of("url").alias("host"), "html").agg(F.count(F.lit(1)))
    copies = copies.select(F.concat(F.lit("http://"), "host").alias("url"), "html")
    counted = (
        alone.union(copies)
        .mapInArrow(_features, "host string, node bigint, parent bigint, kind tinyint, feature bigint, n bigint, pages bigint")
        .groupBy("host", "node", "parent", "kind", "feature")
        .agg(F.sum("n").alias("n"), F.sum("pages").alias("pages"))
    )
    # The entropy of a feature over its pages, as if it were equally often on each.
    shared = F.sum(F.col("n") * F.log("pages")) / F.sum("n")
    nodes = counted.groupBy("host", "node", "parent", "kind").agg(F.sum("n").alias("times"), shared.alias("shared"))
    of = lambda kind, column: F.max(F.when(F.col("kind") == kind, F.col(column)))
    nodes = nodes.groupBy("host", "node", "parent").agg(
        of(0, "shared").alias("presentation"), of(1, "shared").alias("content"), of(2, "times").alias("pages")
    )
    base = F.log(F.col("pages") + PRIOR)
    important = lambda c: F.when(F.col(c).isNotNull(), F.greatest(1 - F.col(c) / base, F.lit(0.0))).alias(c)
    nodes = nodes.select("host", "node", "parent", important("presentation"), important("content"))
    trees = nodes.groupBy("host").agg(F.collect_list(F.struct("node", "parent", "presentation", "content")).alias("nodes"))
    return trees.mapInArrow(_low, "host string, low array<bigint>")


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Page id, url and main ``text`` of each page.

    Character references are decoded, white space within a block becomes one space, and blocks are
    joined by one line feed. Null or empty html gives an empty text; pages whose url is null or has
    no host form one site. Repeated rows are kept; each distinct html counts once as a page of its
    site. An empty table
    gives an empty result.
    """
    kind = pages.schema[page_id].dataType.simpleString()
    link = pages.schema[url].dataType.simpleString()
    rows = pages.select(
        F.col(page_id).alias("id"),
        F.col(url).alias("url"),
        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"),
        _host_of(url).alias("host"),
    )
    low = style_trees(pages, url, html).filter(F.size("low") > 0)
    joined = rows.join(low, "host", "left").select("id", "url", "html", "low")

    def texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            found = [
                main_text(page, set(nodes or ()))
                for page, nodes in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.string())], names=["id", "url", "text"]
            )

    found = joined.mapInArrow(texts, f"id {kind}, url {link}, text string")
    return found.withColumnsRenamed({"id": page_id, "url": url})
