"""Main text of HTML pages by removing the templates of a site.

A page is parsed once into text blocks. Every block element is a subtree with a hash, made of its tag, attributes, own text and the
hashes of its children; the hashes are counted per host in Spark, and subtrees that recur across many different pages of a
host are deleted. A paragraph, heading, list item or cell of the main text is never deleted for itself: two authors may write the same
sentence. Elements that are page furniture by their tag, role or class (menus, headers, footers, forms,
adverts, notices, comments) go as well, so that a host's first page is cleaned like its thousandth.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vejrkraft.llm.steps import MOST_KEYS
from vejrkraft.llm.url_rules import host_of
from vejrkraft.session import staged

MIN_PAGES = 10

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<(?P<loose_close>/?)(?P<loose>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"  # a quote that does not end
    r"|</[^>]*(?:>|\Z)|(?P<text>[^<]+|<)",
    re.S,
)
_ATTR = re.compile(r"([^\s=\"'/>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")

_set = lambda s: frozenset(s.split())
VOID = _set("area base br col embed hr img input link meta param source track wbr")
RAW = _set("script style textarea title xmp iframe noembed noframes noscript plaintext")
BLOCKS = _set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section summary table tbody td tfoot th thead tr ul"
)
HEADINGS = _set("h1 h2 h3 h4 h5 h6")
# Blocks that hold the author's words themselves; the other blocks hold blocks.
SENTENCES = HEADINGS | _set("blockquote caption dd dt figcaption legend li option p pre summary td th")
FURNITURE = _set(
    "annotation annotation-xml aside audio button canvas datalist dialog footer form frame frameset head iframe input map menu nav "
    "noembed noframes noscript object script search select style svg template textarea title video"
)
ROLES = _set(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar tablist"
)
NAMES = _set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie "
    "cookies copyright disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices "
    "overlay pager pagination popup promo promoted promotion recommended related replies reply respond share sharebar "
    "sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget widgets"
)
# Words that only say what kind of box a name is on.
BOXES = _set(
    "area articles bar block bottom box btn button buttons container content form group icons inline inner item items left link links list "
    "module panel posts right row section slot stories top unit wrap wrapper"
)
_WITHOUT = _set("no has with without is")
# An open <p> ends where one of these begins; the others end their own kind.
_ENDS_P = BLOCKS - _set("body caption dd dt head html legend optgroup option tbody td tfoot th thead tr summary figcaption li")
_ENDS = {
    "li": _set("li"), "dt": _set("dt dd"), "dd": _set("dt dd"), "tr": _set("tr td th"), "td": _set("td th"), "th": _set("td th"),
    "option": _set("option"), "optgroup": _set("option optgroup"), "tbody": _set("tbody thead tfoot tr td th"),
    "tfoot": _set("tbody thead tfoot tr td th"), "thead": _set("tbody thead tfoot tr td th"),
}
_LIMIT = {
    "li": _set("ul ol menu dir"), "dt": _set("dl"), "dd": _set("dl"), "option": _set("select datalist"), "optgroup": _set("select"),
    "tr": _set("table"), "td": _set("table"), "th": _set("table"), "tbody": _set("table"), "tfoot": _set("table"), "thead": _set("table"),
}
_P_LIMIT = _set("td th table caption button object html body")


def _is_furniture(tag: str, attrs: str, in_article: bool) -> bool:
    if tag in FURNITURE or (tag == "header" and not in_article):
        return True
    if not attrs or tag in ("html", "body", "main"):
        return False
    for name, a, b, c in _ATTR.findall(attrs):
        name, value = name.lower(), a or b or c
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "role" and value.lower() in ROLES:
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
        if name in ("class", "id") and tag in BLOCKS and tag not in HEADINGS:
            for whole in unescape(value).lower().split():
                parts = [x for x in re.split(r"[^a-z]+", whole) if x]
                if in_article or tag == "article":
                    # Here an author's words may begin or end with such a name; an article has a header of its own.
                    known = {x for x in parts if x in NAMES and x != "header"}
                    if known and all(x in known or x in BOXES for x in parts):
                        return True
                elif parts and parts[0] not in _WITHOUT and {parts[0], parts[-1]} & NAMES:
                    return True
    return False


class _Element:
    __slots__ = ("tag", "furniture", "article", "main", "hash", "mark")

    def __init__(self, tag: str, parent: "_Element | None", attrs: str) -> None:
        self.tag = tag
        above = parent is not None
        self.article = above and parent.article
        self.furniture = (above and parent.furniture) or _is_furniture(tag, attrs, self.article)
        if tag == "article" and not self.furniture:
            self.article = True
        role_main = tag == "main" or (attrs and re.search(r"role\s*=\s*[\"']?main\b", attrs, re.I) is not None)
        self.main = (above and parent.main) or (bool(role_main) and not self.furniture)
        # Text and inline elements count for the block around them.
        self.mark = parent.mark if above else -1
        self.hash = parent.hash if above else None


class Page:
    """What parsing leaves of a page: ``blocks`` (text, innermost subtree or -1, rank 2 in an article, 1 in main, else 0, whether
    it is a headline), and per subtree its hash, the subtree around it (or -1) and whether it may be deleted for itself."""

    def __init__(self) -> None:
        self.blocks: list[tuple[str, int, int, bool]] = []
        self.hashes: list[int] = []
        self.parents: list[int] = []
        self.whole: list[bool] = []


def parse(html: str) -> Page:
    """Reads a page once; the work per tag does not grow with the depth of the tags around it."""
    page = Page()
    stack: list[_Element] = []
    open_at: dict[str, list[int]] = defaultdict(list)  # places in the stack, by tag
    pieces: list[str] = []

    def flush() -> None:
        if pieces:
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text:
                top = stack[-1] if stack else None
                rank = 2 if top and top.article else 1 if top and top.main else 0
                page.blocks.append((text, top.mark if top else -1, rank, bool(open_at["h1"])))

    def add(text: str) -> None:
        if stack:
            if stack[-1].hash is not None:
                stack[-1].hash.update(text)
            if stack[-1].furniture:
                return
        pieces.append(text)

    def push(tag: str, attrs: str) -> None:
        parent = stack[-1] if stack else None
        element = _Element(tag, parent, attrs)
        if tag in BLOCKS:
            page.parents.append(element.mark)
            element.mark = len(page.hashes)
            page.hashes.append(0)
            page.whole.append(tag not in SENTENCES)
            element.hash = xxhash.xxh64(tag)
            element.hash.update(" ".join(attrs.split()))
        elif element.hash is not None:
            element.hash.update(f"<{tag}>")
        open_at[tag].append(len(stack))
        stack.append(element)

    def pop() -> None:
        element = stack[-1]
        if element.tag in BLOCKS:
            flush()
        stack.pop()
        open_at[element.tag].pop()
        if element.tag in BLOCKS:
            digest = element.hash.intdigest()
            page.hashes[element.mark] = digest - (1 << 64) if digest >> 63 else digest
            if stack and stack[-1].hash is not None:
                stack[-1].hash.update(element.hash.digest())

    def last(tags: frozenset) -> int:
        return max((open_at[t][-1] for t in tags if open_at[t]), default=-1)

    def end(tags: frozenset, limit: frozenset) -> bool:
        """Close the nearest open element among ``tags``, if none of ``limit`` was opened after it."""
        at = last(tags)
        if at < 0 or last(limit) > at:
            return False
        while len(stack) > at:
            pop()
        return True

    at, size = 0, len(html)
    while at < size:
        m = _TOKEN.match(html, at)
        at = m.end()
        kind = m.lastgroup
        if kind == "text":
            add(unescape(m.group()))
            continue
        if kind == "cdata":
            add(m.group("cdata"))
            continue
        tag = m.group("tag") or m.group("loose")
        if tag is None:
            continue
        tag, attrs = tag.lower(), m.group("attrs") or ""
        if m.group("close") or m.group("loose_close"):
            if tag == "br":
                add(" ")
            elif tag not in RAW and tag not in VOID:
                end(frozenset((tag,)), frozenset())
            continue
        if tag == "br" or tag == "wbr":
            if tag == "br":
                add(" ")
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, at)
            at = close.end() if close and tag != "plaintext" else size
            continue
        if tag in BLOCKS:
            if tag in _ENDS_P:
                end(frozenset(("p",)), _P_LIMIT)
            if tag in _ENDS:
                while end(_ENDS[tag], _LIMIT[tag]):
                    pass
            flush()
        if tag in VOID or attrs.endswith("/") and tag not in BLOCKS and tag not in ("a", "b", "i", "span"):
            continue
        push(tag, attrs)
    while stack:
        pop()
    flush()
    return page


_PARSED = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("page", pa.int64()),
        ("texts", pa.list_(pa.string())),
        ("within", pa.list_(pa.int32())),
        ("hashes", pa.list_(pa.int64())),
        ("parents", pa.list_(pa.int32())),
        ("whole", pa.list_(pa.bool_())),
    ]
)
_PARSED_SCHEMA = (
    "page_id long, url string, page long, texts array<string>, within array<int>, hashes array<bigint>, parents array<int>, "
    "whole array<boolean>"
)


def _parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, 256):
            part = batch.slice(low, 256)
            out = {"page_id": part.column("page_id"), "url": part.column("url")}
            rows = [_main_blocks(html or "") for html in part.column("html").to_pylist()]
            for i, name in enumerate(_PARSED.names[2:]):
                out[name] = [row[i] for row in rows]
            yield pa.RecordBatch.from_pydict(out, schema=_PARSED)


def _main_blocks(html: str) -> tuple[int, list[str], list[int], list[int], list[int], list[bool]]:
    """Fingerprint of the page's main text; texts of its blocks and their innermost subtrees; the subtrees around main text
    (renumbered): hashes, parents, and which may be deleted for themselves.

    The main text is that of the main element if it holds half of all; else of the articles, with the page's one headline if they have
    none, if they hold two thirds; else all, and then paragraphs that recur are templates too.
    """
    page = parse(html)
    size = [sum(len(text) for text, _, rank, _ in page.blocks if rank >= least) for least in range(3)]
    best = 1 if 2 * size[1] >= size[0] and any(rank == 1 for _, _, rank, _ in page.blocks) else 2 if 3 * size[2] >= 2 * size[0] > 0 else 0
    above = [i for i, (_, _, rank, headline) in enumerate(page.blocks) if headline and rank < best]
    if best == 1 or len(above) != 1 or any(rank == 2 and headline for _, _, rank, headline in page.blocks):
        above = []
    kept = [(text, mark) for i, (text, mark, rank, _) in enumerate(page.blocks) if rank >= best or i in above]
    # Only subtrees around these blocks can take text away.
    used: set[int] = set()
    for _, mark in kept:
        while mark >= 0 and mark not in used:
            used.add(mark)
            mark = page.parents[mark]
    number = {mark: i for i, mark in enumerate(sorted(used))}
    digest = xxhash.xxh64("\n".join(text for text, _ in kept)).intdigest()
    return (
        digest - (1 << 64) if digest >> 63 else digest,
        [text for text, _ in kept],
        [number.get(mark, -1) for _, mark in kept],
        [page.hashes[mark] for mark in number],
        [number.get(page.parents[mark], -1) for mark in number],
        [page.whole[mark] or best == 0 for mark in number],
    )


def _without_lost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of pages less those inside a lost subtree."""
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("texts", "within", "hashes", "parents", "whole", "lost"))
        texts = []
        for text, within, hashes, parents, whole, lost in zip(*columns):
            gone, dead = set(lost), [False] * len(hashes)
            for i, (own, parent) in enumerate(zip(hashes, parents)):  # a subtree comes after the one around it
                dead[i] = (whole[i] and own in gone) or (parent >= 0 and dead[parent])
            texts.append([t for t, mark in zip(text, within) if mark < 0 or not dead[mark]])
        yield pa.RecordBatch.from_pydict(
            {"page_id": batch.column("page_id"), "url": batch.column("url"), "texts": pa.array(texts, pa.list_(pa.string()))}
        )


def main_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """Per row of ``pages``: page_id, url, text (blocks joined by a blank line, "" if none) and n_chars.

    Blocks come from the page's main element if it holds half of its text, else from its articles and its headline if the articles hold
    two thirds, else from its body, where paragraphs count as subtrees too. A subtree recurs if it stands around main text on at least ``min_pages`` pages of its host with different
    main text: copies of one page count once, and the size of the host does not matter. Character references are decoded and white space in a
    block becomes one space. Null html is empty, a null url has the empty host. Repeated rows are extracted each; other
    columns are not read; an empty table gives no rows.
    """
    read = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")
    )
    parsed = staged(
        read.mapInArrow(_parse_batches, _PARSED_SCHEMA).withColumns(
            {"host": F.coalesce(host_of(F.col("url")), F.lit("")), "row": F.monotonically_increasing_id()}
        )
    )
    eligible = F.array_distinct(F.filter("hashes", lambda _, i: F.get("whole", i)))
    stood = parsed.select("host", "page", "row", F.explode(eligible).alias("subtree"))
    # (host, page, subtree) is spread by all three, so a hot host or menu is counted in many tasks.
    recurring = (
        stood.select("host", "page", "subtree")
        .distinct()
        .groupBy("host", "subtree")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_pages)
        .select("host", "subtree")
    )
    lost = stood.join(recurring, ["host", "subtree"]).groupBy("row").agg(F.collect_set("subtree").alias("lost"))
    lost = staged(lost)
    rows = lost.select("row")
    # The number of pages that lose something is known now: pages that lose nothing stay where they are.
    rows = F.broadcast(rows) if rows.limit(MOST_KEYS + 1).count() <= MOST_KEYS else rows
    touched = parsed.join(rows, "row", "left_semi").join(lost, "row")
    touched = touched.select("page_id", "url", "texts", "within", "hashes", "parents", "whole", "lost")
    cleaned = touched.mapInArrow(_without_lost, "page_id long, url string, texts array<string>")
    text = F.array_join("texts", "\n\n")
    untouched = parsed.join(rows, "row", "left_anti").select("page_id", "url", "texts")
    return untouched.unionByName(cleaned).select(
        "page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars")
    )
