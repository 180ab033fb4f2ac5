"""Main text of web pages by consensus of each host's pages.

Each page scores its containers by the paragraphs they hold. Pages of a host
vote, in Spark, on the generalised tag-class path of their best container. Paths
with enough votes win, several where a host has several layouts, and every page
is then read again through the winning path that holds most of it.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, grown, sheltered
from .urlfilter import host_of

#: Script, style and textarea hold no tags up to their end tag or the page's end. The other named elements are skipped only where they are closed before the next of their name.
_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(script|style|textarea)(?=[\s/>])[^>]*(?<!/)>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)"
    r"|<(noscript|template|iframe|svg|select)(?=[\s/>])[^>]*(?<!/)>[^<]*(?:<(?!/?\2[\s/>])[^<]*)*</\2(?=[\s/>])[^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)>|<[!?][^>]*(?:>|\Z)|<(?=/?[a-zA-Z])[^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_DROPPED = frozenset("nav header footer aside form head title script style noscript template iframe button select option optgroup textarea menu dialog svg audio video canvas label input".split())
#: An unclosed one of these ends as if it were void: what follows it belongs to its parent.
_LOOSE = frozenset("noscript template iframe button select option optgroup svg math object audio video canvas label".split())
_NOISE = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo banner sidebar side menu nav navbar navigation breadcrumb breadcrumbs footer header masthead cookie cookies consent notice notices alert popup modal overlay newsletter subscribe signup share sharing social related recommended recommendations comment comments commentlist disqus reply replies respond toolbar pagination pager widget hidden".split()
)
_CONTENT = frozenset("article content post entry story main body text".split())
#: Least share, in percent, of a host's votes with which a path wins beside the first, and least number of votes.
SUPPORT = 5
LEAST_VOTES = 2
#: A page whose winning paths hold less than this part of its best container's score is read through that container.
HOLDS = 0.5
_SPLIT = re.compile(r"[^a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_DIGITS = re.compile(r"\d+")
#: Elements that the start of one of the keys ends, if it is the innermost open block.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


class Node:
    __slots__ = ("tag", "step", "noise", "named", "parent", "children", "score")

    def __init__(self, tag: str, attributes: str, parent: Node | None) -> None:
        self.tag, self.parent, self.children, self.score = tag, parent, [], 0
        given = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)} if "=" in attributes else {}
        classes = given.get("class", "").split()
        words = set(_SPLIT.split(_CAMEL.sub("-", " ".join([*classes, given.get("id", ""), given.get("role", "")])).lower()))
        self.noise = tag in _DROPPED and not (tag == "header" and inside(parent, ("article", "main"))) or bool(words & _NOISE) and tag not in ("html", "body", "article", "main") or bool(given.get("hidden")) or given.get("aria-hidden") == "true"
        if tag == "article" and words & {"comment", "comments", "reply", "ad", "advert", "sponsored", "related"}:
            self.noise = True
        self.named = bool(words & _CONTENT)
        self.step = ".".join([tag, *sorted({_DIGITS.sub("#", c).lower().replace("/", "|") for c in classes})])

    def path(self) -> str:
        steps, node = [], self
        while node is not None and node.tag != "#":
            steps.append(node.step)
            node = node.parent
        return "/".join(reversed(steps))


def inside(node: Node | None, tags: tuple[str, ...]) -> bool:
    while node is not None:
        if node.tag in tags:
            return True
        node = node.parent
    return False


def _left_open(node: Node, to: Node) -> None:
    """Gives the children of the loose nodes from node up to below to, which have no end tag, to their parents."""
    chain = []
    while node is not to:
        if node.tag in _LOOSE:
            chain.append(node)
        node = node.parent
    for n in reversed(chain):  # from the outermost, so that a child moves once
        up = n.parent
        up.children.pop()
        at = 0
        if n.tag == "option":  # its label, up to the first block
            while at < len(n.children) and (isinstance(n.children[at], str) or n.children[at].tag not in _BLOCKS and n.children[at].tag not in _LOOSE):
                at += 1
        for c in n.children[at:]:
            up.children.append(c)
            if not isinstance(c, str):
                c.parent = up


def parse(text: str | None) -> Node:
    """A tree of nodes and strings from any html; unclosed, crossed and cut-off tags are borne."""
    root = node = Node("#", "", None)
    source, at = text or "", 0
    for m in _TOKEN.finditer(source):
        if m.start() > at:
            node.children.append(source[at : m.start()])
        at = m.end()
        tag = (m[4] or "").lower()
        if not tag:
            continue
        if m[3]:
            up = node
            while up.tag not in (tag, "#") and not (up.tag in ("article", "main", "td", "table", "body") and tag not in _BLOCKS):
                up = up.parent
            if up.tag == tag:
                _left_open(node, up)
                node = up.parent
            continue
        if tag in ("br", "wbr"):
            node.children.append(" " if tag == "br" else "")
            continue
        if tag in _BLOCKS:
            up = node
            while up.tag not in _BLOCKS and up.tag != "#":
                up = up.parent
            if up.tag == "p":
                _left_open(node, up)
                node = up = up.parent
            elif up.tag in _ENDS.get(tag, ()):
                _left_open(node, up)
                node = up.parent
                if tag == "tr" and up.tag != "tr" and node.tag == "tr":
                    node = node.parent
        child = Node(tag, m[5], node)
        node.children.append(child)
        if tag not in _VOID and not m[5].rstrip().endswith("/"):
            node = child
    if at < len(source):
        node.children.append(source[at:])
    _left_open(node, root)
    return root


def blocks_of(node: Node) -> list[str]:
    """Texts of the blocks below a node, noise left out."""
    out: list[str] = []
    parts: list[str] = []

    def flush() -> None:
        if parts:
            if block := " ".join(entities.unescape("".join(parts)).split()):
                out.append(block)
            parts.clear()

    stack: list[tuple[Node, int]] = [(node, 0)]
    while stack:
        now, i = stack.pop()
        if i == 0 and now.tag in _BLOCKS:
            flush()
        while i < len(now.children):
            child = now.children[i]
            i += 1
            if isinstance(child, str):
                parts.append(child)
            elif not child.noise:
                stack += [(now, i), (child, 0)]
                break
            elif child.tag in _BLOCKS:
                flush()
        else:
            if now.tag in _BLOCKS:
                flush()
    flush()
    return out


def _text_and_links(node: Node) -> tuple[int, int, int]:
    """Characters, characters in links and commas of the text directly in a block (through inline elements)."""
    size = linked = commas = 0
    stack = [(c, node.tag == "a") for c in node.children]
    while stack:
        child, link = stack.pop()
        if isinstance(child, str):
            n = len(child.strip())
            size, commas = size + n, commas + child.count(",")
            linked += n * link
        elif child.tag not in _BLOCKS and not child.noise:
            stack += [(c, link or child.tag == "a") for c in child.children]
    return size, linked, commas


def best_container(root: Node) -> tuple[Node | None, int]:
    """The container with the most paragraph score, and the score. Within an article or main element, that element stands for its parts."""
    held: list[Node] = []
    stack = [root]
    while stack:
        node = stack.pop()
        if node.noise:
            continue
        stack += [c for c in node.children if not isinstance(c, str)]
        size, linked, commas = _text_and_links(node) if node.tag in _BLOCKS or node.tag == "#" else (0, 0, 0)
        if size and linked * 2 < size:
            score = 2 + 2 * min(commas, 20) + min(size // 50, 20) + size // 400
            up = node.parent if node.tag in ("p", "pre", "blockquote", "li", "td", "h1", "h2", "h3", "h4", "h5", "h6", "dd", "dt") and node.parent is not None else node
            for share in (4, 2, 1):
                if up is None:
                    break
                if up.score == 0:
                    held.append(up)
                up.score += score * share
                up = up.parent
    if not held:
        return None, 0
    top = max(held, key=_weight)
    node, whole = top, None
    while node is not None:
        if node.tag in ("article", "main"):
            whole = node if whole is None or node.tag == "article" else whole
        node = node.parent
    top, score = whole or top, top.score
    return top, score


def _weight(node: Node) -> int:
    return node.score * (5 if node.named or node.tag in ("article", "main") else 4) // (8 if node.tag in ("body", "html", "#") else 4)


def _held(nodes: list[Node]) -> int:
    """The largest weight of a container in these nodes."""
    most, stack = 0, [*nodes]
    while stack:
        node = stack.pop()
        if not node.noise:
            most = max(most, _weight(node))
            stack += [c for c in node.children if not isinstance(c, str)]
    return most


def extract(text: str | None, winners: Sequence[str] | str | None) -> str:
    """Blocks of all containers with one of the winning paths, in page order; of the page's own best container where they hold much less than it.

    Of several paths (most voted first) the one whose containers hold most counts.
    """
    root = parse(text)
    found: dict[str, list[Node]] = {w: [] for w in ([winners] if isinstance(winners, str) else winners or ())}
    top, _ = best_container(root)
    ways: dict = {}  # the paths by their steps, so that only what leads to one of them is walked
    for w in found:
        at = ways
        for step in w.split("/") if w else ():
            at = at.setdefault(step, {})
        at[""] = w
    stack: list[tuple[Node, dict]] = [(root, ways)]
    while stack:
        node, at = stack.pop()
        if node.noise:
            continue
        if "" in at:
            found[at[""]].append(node)
        stack += [(c, at[c.step]) for c in reversed(node.children) if not isinstance(c, str) and c.step in at]
    path = max(found, key=lambda p: _held(found[p]), default=None)  # the first of equal ones
    blocks = []
    if path is not None and _held(found[path]) >= HOLDS * (_held([top]) if top is not None else 0):
        blocks = [b for n in found[path] for b in blocks_of(n)]
    if not blocks:
        blocks = blocks_of(top) if top is not None else blocks_of(root)
    return "\n\n".join(blocks)


def votes(pages: DataFrame) -> DataFrame:
    """host, path, votes and score: what the pages of each host hold for their best container."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            paths, scores = [], []
            for t in b.column(1):
                top, score = best_container(parse(t.as_py()))
                paths.append(top.path() if top is not None else None)
                scores.append(score)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(paths, pa.string()), pa.array(scores, pa.int64())], names=["host", "path", "score"])

    cast = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(vote, "host string, path string, score long")
    return cast.where("path is not null").groupBy("host", "path").agg(F.count("*").alias("votes"), F.sum("score").alias("score"))


def winning(cast: DataFrame) -> DataFrame:
    """_host and _paths, most voted first, from votes: the path with most votes, then score, then by name, and all others with enough votes."""
    # Windows, not a join: the size of the result stays known, and the join with pages is planned by it.
    host = Window.partitionBy("host")
    cast = cast.withColumn("_all", F.sum("votes").over(host)).withColumn("_rank", F.row_number().over(host.orderBy(F.desc("votes"), F.desc("score"), F.desc("path"))))
    enough = (F.col("votes") >= LEAST_VOTES) & (F.col("votes") * 100 >= F.col("_all") * SUPPORT)  # at most 100 / SUPPORT of a host
    won = cast.where(enough | (F.col("_rank") == 1)).groupBy(F.col("host").alias("_host"))
    return won.agg(F.array_sort(F.collect_list(F.struct("_rank", "path")))["path"].alias("_paths"))


def extract_pages(pages: DataFrame) -> DataFrame:
    """pages with text (empty if none) and n_chars, its code points.

    A host's paths are those that winning() keeps. Pages without a host vote
    together. Null and empty html give an empty text; repeated pages stay,
    an empty table stays empty; columns of pages named text or n_chars are
    replaced, others may have any names.
    """
    return sheltered(pages.drop("text", "n_chars"), ("url", "html"), _extracted)


#: Most bytes of winning paths that go to every task; beyond, pages meet their host's paths in a shuffle.
_BROADCAST_MOST = 32 << 20


def _extracted(kept: DataFrame) -> DataFrame:
    disk = Scratch(kept.sparkSession, "html")
    best = disk.keep(winning(votes(kept)))
    size = best.agg(F.sum(F.length("_host") + F.aggregate(F.transform("_paths", F.length), F.lit(0), lambda a, b: a + b))).first()[0] or 0
    joined = kept.withColumn("_h", host_of(F.col("url"))).join(F.broadcast(best) if size <= _BROADCAST_MOST else best, F.col("_h") == F.col("_host"), "left").select(*kept.columns, "_paths")
    at, path_at = kept.columns.index("html"), len(kept.columns)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(t.as_py(), p) for t, p in zip(b.column(at), b.column(path_at).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:path_at], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*b.schema.names[:path_at], "text", "n_chars"])

    return joined.mapInArrow(read, grown(kept.schema, "text string, n_chars long"))


def op8(pages: DataFrame) -> DataFrame:
    """Every page with its main text; null html gives an empty one."""
    return extract_pages(pages.select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
