"""Main text of web pages by site style trees.

The pages of a host are merged into one tree: a node is the path of elements
(tag, class) from the root. Per node Spark counts on how many pages it occurs, in
which styles (sequences of child elements) and with which contents. A node
matters as far as its styles and contents differ between pages:

* presentation: the entropy of its styles to the base of its pages, 0 when every
  page has the same style;
* content: 1 minus the mean entropy of its contents, where a content on ``k`` of
  ``m`` pages has the entropy ``log k / log m``, so 1 when each occurs on one page
  and 0 when all pages show the same.

Branches whose composite importance is low are templates and are removed from
every page of the host. Elements that HTML or their class and id declare as
navigation, headers, footers, sidebars, notices, adverts, forms or comments have
no importance by themselves; a word that also names a layout or a subject drops
neither the only article of a page nor the element with most of an article's text. Where a page marks its article (``article``,
``main`` or an equal role), text outside it has none either. The
nodes inside articles are in the tree as the others are, but equal articles of a host
count once: an article that a host shows on many of its pages is a copy, not a
template. Near copies share most of their nodes, so where templates hold more than
half of an article's text, nothing is removed inside it.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import stage
from .common import arrow_map, pa_type

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe noembed noframes textarea title xmp svg math object".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("body caption html legend tbody td tfoot th thead tr li dd dt".split())
# An opening tag ends these open elements, up to the nearest element of the second set.
ENDS = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir".split())),
    "dt": (frozenset("dt dd".split()), frozenset(["dl"])),
    "dd": (frozenset("dt dd".split()), frozenset(["dl"])),
    "tr": (frozenset("tr td th".split()), frozenset(["table"])),
    "td": (frozenset("td th".split()), frozenset("tr table".split())),
    "th": (frozenset("td th".split()), frozenset("tr table".split())),
    "option": (frozenset(["option"]), frozenset(["select"])),
    "body": (frozenset(["head"]), frozenset(["html"])),
}
# Elements, roles and words of class or id that mark what is not the article.
NO_CONTENT = frozenset(
    "nav header footer aside form button select datalist dialog menu head audio video canvas map".split()
)
NO_CONTENT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu form".split())
NO_CONTENT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs byline captcha comment comments "
    "consent cookie cookies copyright disqus disclaimer footer gdpr header legal masthead menu modal nav navbar "
    "navigation newsletter notice notification pagination pager popup promo promoted promotion recommended related "
    "replies respond share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget".split()
)
# Words among these that also name the layout around an article, or its subject.
DOUBTFUL_WORDS = frozenset("banner footer header legal masthead menu nav navbar navigation share sharing sidebar skip social toolbar".split())
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)>", re.DOTALL
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)|(\bhidden\b)")
WORD = re.compile(r"[a-z]+")


@dataclass(frozen=True)
class Limits:
    """A template node occurs on ``fewest_pages`` pages and on ``share`` of the host's, with less than ``importance``."""

    fewest_pages: int = 5
    share: float = 0.2
    importance: float = 0.3
    content_weight: float = 0.9


class Node:
    __slots__ = ("boring", "children", "doubtful", "main", "name", "tag")

    def __init__(self, tag: str, attributes: str) -> None:
        found = {}
        if "=" in attributes or "hidden" in attributes:
            for name, value, alone in ATTRIBUTE.findall(attributes):
                found.setdefault((alone or name).lower(), value.strip("\"'").lower())
        words = [*WORD.findall(found.get("class", "")), *WORD.findall(found.get("id", ""))]
        role = found.get("role", "")
        self.tag = tag
        self.name = ".".join([tag, *WORD.findall(found.get("class", ""))])
        self.main = tag in ("article", "main") or role in ("main", "article")
        listed = NO_CONTENT_WORDS.intersection(words)
        declared = tag in NO_CONTENT or role in NO_CONTENT_ROLES or "hidden" in found or found.get("aria-hidden") == "true"
        self.boring = (declared or bool(listed)) and tag not in ("html", "body")
        self.doubtful = self.boring and not declared and listed <= DOUBTFUL_WORDS
        self.children: list[Node | str] = []


def parse(page: str) -> Node:
    """The element tree of a page, however broken: unknown and missing end tags are mended."""
    root = Node("", "")
    stack = [root]
    at = 0

    def close(down_to: int) -> None:
        del stack[down_to:]

    last = page.rfind(">") + 1  # no tag ends behind it, so none is looked for there
    while match := TAG.search(page, at, last):
        if match.start() > at:
            stack[-1].children.append(page[at : match.start()])
        at = match.end()
        if match[2] is None:
            if match[0].startswith("<!--") and not match[0].endswith("-->"):
                at = len(page)
            continue
        tag = match[2].lower()
        if match[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
            continue
        if tag in RAW and not (tag in ("svg", "math") and match[3].endswith("/")):
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
            continue
        ends, within = (frozenset(["p"]), frozenset("td th li button".split())) if tag in CLOSES_P else ENDS.get(tag, ((), ()))
        for i in range(len(stack) - 1, 0, -1) if ends else ():
            if stack[i].tag in within:
                break
            if stack[i].tag in ends:
                close(i)
                break
        if tag == "br":
            stack[-1].children.append(" ")
            continue
        node = Node(tag, match[3])
        stack[-1].children.append(node)
        if tag not in VOID and not match[3].endswith("/"):
            stack.append(node)
    if at < len(page):
        stack[-1].children.append(page[at:].partition("<!--")[0])
    relieve(root)
    return root


def relieve(root: Node) -> None:
    """Take back what a doubtful word of class or id declared.

    When no article is left, the elements around one are; inside an article,
    elements that hold more than three quarters of its text are.
    """
    nodes = [(node, event) for event, node, _ in walk(root)]
    if not any(node.doubtful for node, _ in nodes):
        return
    sizes: dict[int, int] = {}
    around: set[int] = set()
    open_nodes: list[Node] = []
    for node, event in nodes:
        if event == "in":
            open_nodes.append(node)
            sizes[id(node)] = sum(len(c.strip()) for c in node.children if isinstance(c, str))
            continue
        open_nodes.pop()
        if node.main:
            around.add(id(node))
        if open_nodes:
            sizes[id(open_nodes[-1])] += sizes[id(node)]
            if id(node) in around:
                around.add(id(open_nodes[-1]))
    if not has_article(root):
        for node, _ in nodes:
            if node.doubtful and id(node) in around:
                node.boring = False
    articles: list[int] = []
    for node, event in nodes:
        if node.main and event == "out":
            articles.pop()
        if event == "in" and articles and node.doubtful and 4 * sizes[id(node)] > 3 * articles[-1]:
            node.boring = False
        if node.main and event == "in":
            articles.append(sizes[id(node)])


def walk(root: Node) -> Iterator[tuple[str, Node, str]]:
    """(event, node, path) for the whole tree without recursion; events are ``in`` and ``out``."""
    todo: list[tuple[bool, Node, str]] = [(True, root, "")]
    while todo:
        entering, node, path = todo.pop()
        yield ("in" if entering else "out"), node, path
        if entering:
            todo.append((False, node, path))
            todo += [(True, c, f"{path}/{c.name}") for c in reversed(node.children) if isinstance(c, Node)]


def has_article(root: Node) -> bool:
    inside = 0
    for event, node, _ in walk(root):
        if node.boring:
            inside += 1 if event == "in" else -1
        if event == "in" and node.main and not inside:
            return True
    return False


def digest(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


Feature = tuple[str, str, int]


def features(page: str) -> tuple[set[Feature], set[Feature]]:
    """(path, kind, value) of the nodes outside and inside the articles, each once per page.

    Nodes without text have nothing to remove, and the article and what is around it
    is no template. The text of an article is no content of the nodes around it.
    """
    outside: set[Feature] = {("", "page", 0)}
    inside: set[Feature] = set()
    contents: list[list[str]] = []
    around: list[bool] = []
    skipped = articles = 0
    for event, node, path in walk(parse(page)):
        if node.boring:
            skipped += 1 if event == "in" else -1
            continue
        if skipped:
            continue
        if event == "in":
            contents.append([c for c in node.children if isinstance(c, str)])
            around.append(node.tag in ("", "html", "body"))
            if node.main:
                around = [True] * len(around)
                articles += 1
            continue
        articles -= node.main
        text = " ".join(" ".join(contents.pop()).split())
        if contents and (articles or not node.main):
            contents[-1].append(text)
        if not around.pop() and text:
            style = " ".join(dict.fromkeys(c.name for c in node.children if isinstance(c, Node)))
            into = inside if articles else outside
            into |= {(path, "page", 0), (path, "style", digest(style)), (path, "content", digest(text))}
    return outside, inside


def copies(root: Node, templates: frozenset[str]) -> set[int]:
    """The articles, by ``id``, that templates hold more than half of."""
    found: set[int] = set()
    skipped = articles = under = held = size = 0
    for event, node, path in walk(root):
        step = 1 if event == "in" else -1
        if node.boring:
            skipped += step
            continue
        if skipped:
            continue
        if node.main and event == "in" and not articles:
            held = size = 0
        articles += step * node.main
        under += step * (path in templates)
        if event == "in":
            here = sum(len(c.strip()) for c in node.children if isinstance(c, str))
            size += here
            held += here if under else 0
        elif node.main and not articles and 2 * held > size:
            found.add(id(node))
    return found


def main_text(page: str, templates: frozenset[str]) -> str:
    root = parse(page)
    only_article = has_article(root)
    whole = copies(root, templates) if templates else ()
    blocks: list[str] = []
    piece: list[str] = []

    def flush() -> None:
        if piece and (text := " ".join(html.unescape("".join(piece)).split())):
            blocks.append(text)
        piece.clear()

    # Texts and elements in page order, without recursion.
    todo: list[tuple[object, str, bool, bool, str]] = [(root, "", not only_article, False, "in")]
    while todo:
        item, path, wanted, copied, event = todo.pop()
        if isinstance(item, str):
            if wanted:
                piece.append(item)
            continue
        if item.tag in BLOCK:
            flush()
        copied = copied or id(item) in whole
        if event == "out" or item.boring or (path in templates and not copied):
            continue
        wanted = wanted or item.main
        todo.append((item, path, wanted, copied, "out"))
        for child in reversed(item.children):
            todo.append((child, f"{path}/{child.name}" if isinstance(child, Node) else path, wanted, copied, "in"))
    flush()
    return "\n\n".join(blocks)


def host_of(url: Column) -> Column:
    """The lower-case host of a URL without user and port, null when there is none."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(found != "", F.lower(found))


COUNTS = T.StructType(
    [
        T.StructField("host", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("value", T.LongType()),
        T.StructField("pages", T.LongType()),
        T.StructField("paths", T.ArrayType(T.StringType())),
        T.StructField("kinds", T.ArrayType(T.StringType())),
        T.StructField("values", T.ArrayType(T.LongType())),
    ]
)


def count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features outside articles with their pages; per article one row of the kind ``article``, named by the features inside."""
    types = [pa_type(f.dataType) for f in COUNTS.fields]
    for batch in batches:
        found: Counter = Counter()
        articles: dict[tuple[str, int], list[Feature]] = {}
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            outside, inside = features(page)
            for feature in outside:
                found[(host, *feature)] += 1
            if inside:
                listed = sorted(inside)
                articles[(host, digest(repr(listed)))] = listed
        rows = [(*k, n, None, None, None) for k, n in found.items()]
        rows += [(host, "", "article", name, 1, *map(list, zip(*listed, strict=True))) for (host, name), listed in articles.items()]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(types)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], COUNTS.names)


def counted(sites: DataFrame) -> DataFrame:
    """(host, path, kind, value, k): the pages of every feature outside articles, and the different articles of every one inside."""
    key = ("host", "path", "kind", "value")
    # Equal articles have equal lists, so any of them will do.
    lists = [F.first(c, ignorenulls=True).alias(c) for c in ("paths", "kinds", "values")]
    once = arrow_map(sites, count_features, COUNTS).groupBy(*key).agg(F.sum("pages").alias("k"), *lists)
    one = F.array(F.struct("path", "kind", "value", "k"))
    each = F.transform(
        F.arrays_zip("paths", "kinds", "values"),
        lambda f: F.struct(f["paths"].alias("path"), f["kinds"].alias("kind"), f["values"].alias("value"), F.lit(1).cast("bigint").alias("k")),
    )
    rows = once.select("host", F.inline(F.when(F.col("kind") == "article", each).otherwise(one)))
    return rows.groupBy(*key).agg(F.sum("k").alias("k"))


def style_tree(pages: DataFrame, limits: Limits) -> DataFrame:
    """(host, path, pages, host_pages, presentation, content, importance) of every node that may be a template.

    Inside articles ``pages`` are different articles.
    """
    sites = pages.select(host_of(F.col("url")).alias("host"), "html").filter("host IS NOT NULL AND html IS NOT NULL")
    counts = counted(sites)

    def over(kind: str, value: Column) -> Column:
        return F.sum(F.when(F.col("kind") == kind, value))

    k = F.col("k")
    nodes = stage(
        counts.groupBy("host", "path").agg(
            over("page", k).alias("pages"),
            over("style", k * F.ln(k)).alias("style_sum"),
            over("content", F.ln(k)).alias("content_sum"),
            over("content", F.lit(1)).alias("contents"),
        )
    )
    m = F.col("pages")
    presentation = F.when(m > 1, (F.ln(m) - F.col("style_sum") / m) / F.ln(m)).otherwise(1.0)
    content = F.when(m > 1, 1 - F.col("content_sum") / F.col("contents") / F.ln(m)).otherwise(1.0)
    w = limits.content_weight
    sizes = nodes.filter("path = ''").select("host", m.alias("host_pages"))
    return (
        nodes.filter("path <> ''")
        .join(sizes, "host")
        .select("host", "path", "pages", "host_pages", presentation.alias("presentation"), content.alias("content"))
        .withColumn("importance", (1 - w) * F.col("presentation") + w * F.col("content"))
    )


def templates_by_host(pages: DataFrame, limits: Limits) -> DataFrame:
    """The template paths of each host.

    A list is bounded: each of its paths is on ``share`` of the host's pages, so
    it has at most 1 / ``share`` times as many paths as a page has nodes.
    """
    low = (
        (F.col("importance") < limits.importance)
        & (F.col("pages") >= limits.fewest_pages)
        & (F.col("pages") >= limits.share * F.col("host_pages"))
    )
    return style_tree(pages, limits).filter(low).groupBy("host").agg(F.sort_array(F.collect_set("path")).alias("paths"))


def extract_main_text(pages: DataFrame, limits: Limits | None = None) -> DataFrame:
    """Per row of ``pages`` (``page_id``, ``url``, ``html``): its main text and length.

    Null or empty html gives an empty text. Pages without a host take no part in
    the statistics and keep what their own markup leaves. Repeated rows are
    extracted one by one; other columns are ignored.
    """
    limits = limits or Limits()
    lists = stage(templates_by_host(pages, limits))
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host_of(F.col("url")).alias("host"))
    joined = rows.join(lists, "host", "left").select("page_id", "url", "html", "paths")
    schema = T.StructType(
        [joined.schema["page_id"], joined.schema["url"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    )

    def work(batches):
        for batch in batches:
            texts = [
                main_text(page, frozenset(paths or ()))
                for page, paths in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            ]
            made = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], schema.names)

    return arrow_map(joined, work, schema)
