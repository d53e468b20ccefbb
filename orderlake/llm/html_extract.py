"""Main text of web pages by site template removal.

First pass: every page is read into elements, and each container element's
subtree (tags and text) is hashed.  Spark counts the pages of each host that
hold a subtree.  Second pass: subtrees that recur across many pages of their
host are deleted, as are elements whose tag, role, class or id says that they
are furniture; what is left of the article (or of the main element, or of the
body) is the main text.

Plain paragraphs, headings and list entries inside an article are never
counted as template: an article may quote a line that others quote too.
"""

from __future__ import annotations

import bisect
import html
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import checkpoint, map_arrow

#: A subtree is template if at least this many pages, and this share of its host's pages, hold it.
MIN_PAGES, MIN_SHARE = 5, 0.05
#: Template subtrees in one broadcast (16 bytes each); more are handled in blocks of hosts.
BLOCK = 500_000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg object canvas math xmp noembed noframes".split())
DROP = frozenset("nav footer aside form button select menu dialog fieldset head".split()) | RAW
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form toolbar".split())
WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promoted banner cookie cookies consent gdpr notice notices "
    "notification alert sidebar menu nav navbar navigation breadcrumb breadcrumbs comment comments reply replies respond disqus discussion share sharing "
    "social related recommended footer popup modal overlay newsletter subscribe subscription signup login paywall pagination pager widget "
    "masthead topbar toolbar skip sitemap copyright disclaimer".split()
)
#: Dropped outside of an article only: an article may have a header of its own.
OUTER = frozenset("header".split())
CONTENT = frozenset("article main body html".split())
TEXT_LEVEL = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre dd dt td th tr b i em strong a span code q cite small sub sup u s font mark time abbr br".split())
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"),
}
WALLS = frozenset("table ul ol dl select article section div main body html aside nav".split())

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^"'>]|"[^"]*"|'[^']*')*)(?:>|\Z)""", re.S)
ATTR = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
NAMES = re.compile(r"[A-Za-z]+")


class Node:
    __slots__ = ("tag", "children", "named", "furniture", "hash", "holds")

    def __init__(self, tag: str, named: bool = False, furniture: bool = False):
        self.tag, self.children, self.named, self.furniture, self.hash, self.holds = tag, [], named, furniture, 0, False


def _furniture(tag: str, attrs: str) -> tuple[bool, bool]:
    """Whether the element has a class, id or role; whether that says it is furniture."""
    if "=" not in attrs:
        return False, tag in DROP
    named = said = False
    for name, a, b, c in ATTR.findall(attrs):
        name, value = name.lower(), html.unescape(a or b or c)
        if name in ("class", "id"):
            named = True
            if tag not in CONTENT or tag == "article":
                said = said or any(w.lower() in WORDS for w in NAMES.findall(value))
        elif name == "role":
            named = True
            said = said or value.strip().lower() in ROLES
        elif name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", "").lower():
            said = True
    return named, said or tag in DROP or (not named and " hidden" in attrs.lower() and tag not in CONTENT)


def tree(page: str) -> Node:
    """The elements of a page, with the implied end tags of HTML; never fails, whatever the markup."""
    root = Node("")
    stack = [root]
    places: dict[str, list[int]] = {}  # of each tag, the places of its open elements in the stack
    at, n = 0, len(page)
    while at < n:
        m = TAG.search(page, at)
        if m is None:
            stack[-1].children.append(html.unescape(page[at:]))
            break
        if m.start() > at:
            stack[-1].children.append(html.unescape(page[at : m.start()]))
        at = m.end()
        close, name, attrs = m.groups()
        if name is None:
            if m[0].startswith("<![CDATA["):
                stack[-1].children.append(m[0][9:].removesuffix("]]>"))
            continue
        name = name.lower()
        if close:
            if name == "br":
                stack[-1].children.append(" ")
            at_name = _last(places, (name,))
            if at_name and (name in CONTENT or at_name > _last(places, ("article", "main", "body"))):
                _cut(stack, places, at_name)
            continue
        if name == "br":
            stack[-1].children.append(" ")
            continue
        if name in BLOCKS:
            _pop(stack, places, ("p",), WALLS)
        if name in CLOSES:
            _pop(stack, places, CLOSES[name], WALLS - {"tbody"})
        named, furniture = _furniture(name, attrs or "")
        node = Node(name, named, furniture)
        stack[-1].children.append(node)
        if name in RAW and not (attrs or "").endswith("/"):
            end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else n
        elif name not in VOID and not ((attrs or "").endswith("/") and name not in BLOCKS):
            places.setdefault(name, []).append(len(stack))
            stack.append(node)
    return root


def _last(places: dict[str, list[int]], tags: Iterable[str]) -> int:
    """The place of the innermost open element of these tags, 0 if none is open."""
    return max((places[t][-1] for t in tags if places.get(t)), default=0)


def _cut(stack: list[Node], places: dict[str, list[int]], at: int) -> None:
    """Close the elements from place ``at`` on; each is closed once, so a page costs its length."""
    for node in stack[at:]:
        places[node.tag].pop()
    del stack[at:]


def _pop(stack: list[Node], places: dict[str, list[int]], tags: tuple[str, ...], walls: frozenset) -> None:
    """Close the outermost of the open ``tags`` inside the innermost wall (a tag that is itself in ``tags`` is no wall)."""
    wall = _last(places, (t for t in walls if t not in tags))
    found = [places[t][bisect.bisect_right(places[t], wall)] for t in tags if places.get(t) and places[t][-1] > wall]
    if found:
        _cut(stack, places, min(found))


def _walk(root: Node) -> Iterator[tuple[Node, bool, bool]]:
    """(node, whether inside an article or main, after its children) in page order, without recursion."""
    stack: list[tuple[Node, bool, bool]] = [(root, False, False)]
    while stack:
        node, inside, done = stack.pop()
        yield node, inside, done
        if not done:
            stack.append((node, inside, True))
            within = inside or node.tag in ("article", "main")
            stack += [(c, within, False) for c in reversed(node.children) if isinstance(c, Node)]


def hash_subtrees(root: Node) -> set[int]:
    """Hash every element's subtree; the hashes of those that may be template."""
    out = set()
    for node, inside, done in _walk(root):
        if not done:
            continue
        parts = [node.tag]
        for c in node.children:
            if isinstance(c, Node):
                node.holds = node.holds or c.holds
                parts.append(f"\x01{c.hash:x}")
            elif words := c.split():
                parts.append("\x02" + " ".join(words))
        node.hash = xxhash.xxh3_64_intdigest("\x00".join(parts).encode("utf-8", "surrogatepass")) - 2**63
        node.holds = node.holds or node.tag in ("article", "main", "body", "html")
        if node.tag and not node.holds and node.tag not in RAW and node.tag not in VOID and (node.named or node.tag not in TEXT_LEVEL or not inside) and len(parts) > 1:
            out.add(node.hash)
    return out


def main_text(page: str | None, template: frozenset | set = frozenset()) -> str:
    """The blocks of the article without furniture and template, joined by line feeds."""
    root = tree(page or "")
    hash_subtrees(root)
    kept: dict[str, list[list[str]]] = {"article": [], "main": [], "": []}
    depth = {"article": 0, "main": 0}
    skipped = None

    def new_block() -> None:
        for rows in kept.values():
            if rows and rows[-1]:
                rows.append([])

    stack: list = [(root, 0)]
    while stack:
        node, done = stack.pop()
        if isinstance(node, str):
            for kind, rows in kept.items():
                if not kind or depth[kind]:
                    if not rows:
                        rows.append([])
                    rows[-1].append(node)
            continue
        block = node.tag in BLOCKS
        if done:
            if node.tag in depth:
                depth[node.tag] -= 1
            if block:
                new_block()
            continue
        inside = depth["article"] or depth["main"]
        if node.furniture or (node.tag in OUTER and not inside):
            skipped = True
        elif template and not node.holds and node.hash in template and (node.named or node.tag not in TEXT_LEVEL or not inside):
            skipped = True
        else:
            skipped = False
        if block:
            new_block()
        if skipped:
            continue
        if node.tag in depth:
            depth[node.tag] += 1
        stack.append((node, 1))
        stack += [(c, 0) for c in reversed(node.children)]
    for kind in ("article", "main", ""):
        blocks = [" ".join("".join(b).split()) for b in kept[kind]]
        if blocks := [b for b in blocks if b]:
            return "\n".join(blocks)
    return ""


def host_of(url: Column) -> Column:
    """The URL's host in lower case; empty if there is none, and such pages have no site template."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def site_templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, subtree) pairs that recur, checkpointed; hosts as 64-bit hashes."""
    rows = pages.select(F.xxhash64("host").alias("host"), "html").where(F.col("host") != F.xxhash64(F.lit("")))

    def subtrees(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[tuple[int, int], int] = {}
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for h in hash_subtrees(tree(page or "")):
                    counts[host, h] = counts.get((host, h), 0) + 1
            keys = list(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array(list(counts.values()), pa.int64())],
                ["host", "subtree", "n"],
            )

    counted = map_arrow(rows, subtrees, "host long, subtree long, n long").groupBy("host", "subtree").agg(F.sum("n").alias("n")).where(F.col("n") >= min_pages)
    sizes = rows.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    return checkpoint(counted.join(sizes, "host").where(F.col("n") >= min_share * F.col("pages")).select("host", "subtree"))


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages`` (page_id, url, html).

    Null or empty html gives an empty text.  Null identifiers, null URLs and
    repeated rows are rows like any other; broken markup is read as far as it
    goes; an empty table gives no rows; extra columns are ignored.
    """
    spark = pages.sparkSession
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    found = site_templates(rows, min_pages, min_share)
    blocks = max(1, -(-found.count() // BLOCK))
    rows = rows.select("page_id", "url", "html", F.xxhash64("host").alias("host"))
    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("page_id", "url")) + ", text string, n_chars long"
    out = None
    for block in range(blocks):
        by_host: dict[int, set[int]] = {}
        for r in found.where(F.pmod("host", F.lit(blocks)) == block).collect():
            by_host.setdefault(r["host"], set()).add(r["subtree"])
        sent = spark.sparkContext.broadcast(by_host)

        def texts(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hosts, pages_ = batch.column(3).to_pylist(), batch.column(2).to_pylist()
                got = [main_text(p, sent.value.get(h, frozenset())) for p, h in zip(pages_, hosts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(got, pa.string()), pa.array([len(t) for t in got], pa.int64())], ["page_id", "url", "text", "n_chars"]
                )

        part = map_arrow(rows.where(F.pmod("host", F.lit(blocks)) == block) if blocks > 1 else rows, texts, schema)
        out = part if out is None else out.unionByName(part)
    return out
