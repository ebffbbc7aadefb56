"""Main text of web pages: element roles, then nearest-URL page differencing.

A page becomes text lines, one per block. Lines inside elements that never
belong to an article (menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles, reader comments) are dropped. The other lines of every
page are compared with those of the nearest URLs of the same host: pages are sorted
by host and path, each looks at its ``NEAR`` neighbours on either side; the lines of
both are aligned by longest common subsequence, and lines shared with a neighbour
that is otherwise unlike, being the site's and not the page's, are deleted. A
neighbour that shares more than half of the characters of either page is a copy of
it, such as a print view, and tells nothing.

The marks of a page (``article`` or ``main``) are the check that follows: lines inside
a marked article stay even if shared, for pages share lines of their articles, and
copies whole ones (see the README for figures); of a page that marks its article,
unshared lines outside are dropped too.

Pages are sorted by range, so a host of any size is spread over many tasks, and
only line hashes take part in the sort and the comparison, which goes by blocks of
``BLOCK`` pages in that order.

Defined results: a null or empty page has an empty text; a null or relative URL
belongs to the empty host; repeated rows get the same text; an empty table gives
no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.work import staged, table

_RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "xmp")
_DROPPED = {
    "nav", "header", "footer", "aside", "form", "button", "select", "option", "dialog", "menu",
    "head", "object", "canvas", "audio", "video", "map", "datalist", "fieldset", "legend", "label",
}
_DROPPED_ROLES = {
    "navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog",
    "alertdialog", "form", "menu", "menubar", "toolbar",
}
#: Names of what is not the article, as a whole class or id, or joined with each other
#: and with names of layout: "ad", "share-buttons", "post-comments", not "social-history".
_DROPPED_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "banner",
    "sponsor", "sponsored", "promo", "promotion", "cookie", "cookies", "consent", "gdpr", "notice",
    "notification", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup",
    "login", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "widget",
    "related", "recommended", "recommendations", "share", "sharing", "social", "footer", "masthead",
    "copyright", "comment", "comments", "reply", "replies", "respond", "disqus", "pagination",
    "pager", "toolbar", "skip",
}
_LAYOUT_NAMES = {
    "area", "article", "bar", "block", "body", "bottom", "box", "button", "buttons", "column", "container",
    "content", "count", "entry", "form", "global", "group", "head", "header", "inline", "inner", "item",
    "items", "left", "link", "links", "list", "main", "outer", "page", "panel", "post", "posts", "primary",
    "right", "section", "site", "slot", "story", "text", "thread", "title", "top", "unit", "wrap", "wrapper",
}
_MAIN = {"article", "main"}
_VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
    "track", "wbr",
}
_INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em",
    "font", "i", "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span",
    "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "img", "wbr", "br", "input",
    "label", "button", "picture", "source",
}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAMES = re.compile(r"[a-z]+")
#: Names that mark a part of the article even beside a name of layout's parts ("post-banner").
_KEPT_NAMES = {"article", "post", "entry", "content", "story", "body", "main"}
_PARTS = {"banner", "masthead", "sidebar", "widget", "overlay", "modal", "skip", "toolbar"}
#: Elements that may be left unclosed, and the opening tags that end them; p is ended by any block.
_ROWS = {"tr", "tbody", "tfoot", "thead"}
_UNCLOSED = {
    "p": None, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": _ROWS,
    "td": {"td", "th"} | _ROWS, "th": {"td", "th"} | _ROWS,
}
#: Closing tags that end an unclosed element inside them.
_CLOSERS = {"p": {"li", "dt", "dd", "td", "th", "tr"}, "td": {"tr"}, "th": {"tr"}}

DROPPED, OPEN, MAIN = 0, 1, 2
#: Neighbours by URL on either side that a page is compared with.
NEAR = 2
#: Pages that are compared in one group, in the order of URLs.
BLOCK = 500


def _is_dropped(name: str, attributes: str) -> bool:
    if name in _DROPPED:
        return True
    if not attributes or name in ("html", "body"):
        return False
    for found in _ATTRIBUTE.finditer(attributes):
        key = found[1].lower()
        value = (found[2] or found[3] or found[4] or "").lower()
        if key == "role" and value.strip() in _DROPPED_ROLES:
            return True
        if key in ("class", "id"):
            whole = [set(_NAMES.findall(part)) for part in value.split()]
            kept = name in _MAIN or any(names & _KEPT_NAMES for names in whole)
            dropped = _DROPPED_NAMES - _PARTS if kept else _DROPPED_NAMES
            if any(names & dropped and names <= dropped | _LAYOUT_NAMES for names in whole):
                return True
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
    return False


def page_lines(html: str) -> list[tuple[int, str]]:
    """(kind, text) of every block with text, in page order."""
    lines: list[tuple[int, str]] = []
    parts: list[str] = []
    stack: list[tuple[str, int]] = []  # open block elements and the kind inside
    kind, at, size = OPEN, 0, len(html)

    def flush() -> None:
        text = " ".join(unescape("".join(parts)).split()) if parts else ""
        parts.clear()
        if text:
            lines.append((kind, text))

    while at < size:
        found = _TAG.search(html, at)
        if kind != DROPPED:
            parts.append(html[at : found.start() if found else size])
        if not found:
            break
        at = found.end()
        closing, name, attributes = (found[1], found[2], found[3]) if found[2] else found.group(4, 5, 6)
        if not name:
            continue
        name = name.lower()
        if name in _RAW and not closing:
            end = re.compile(f"</{name}", re.IGNORECASE).search(html, at)
            after = html.find(">", end.end()) if end else -1
            at = after + 1 if after >= 0 else size
            continue
        if name in _INLINE and not (not closing and _is_dropped(name, attributes)):
            # A dropped inline element is on the stack; any other is markup only.
            if not (closing and any(open_name == name for open_name, _ in stack)):
                if name in ("br", "img", "input", "wbr") and kind != DROPPED:
                    parts.append(" " if name == "br" else "")
                continue
        flush()
        if stack and stack[-1][0] in _UNCLOSED:
            top = stack[-1][0]
            ends = _CLOSERS.get(top, ()) if closing else _UNCLOSED[top]
            if ends is None or name in ends:
                stack.pop()
                kind = stack[-1][1] if stack else OPEN
        if closing:
            place = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
            if place is not None:
                del stack[place:]
                kind = stack[-1][1] if stack else OPEN
        elif name not in _VOID and not attributes.endswith("/"):
            if name == "option" or (name in _UNCLOSED and (kind == DROPPED or not _is_dropped(name, attributes))):
                continue  # may be left unclosed; only dropped ones hold a kind of their own
            if kind != DROPPED:
                if _is_dropped(name, attributes):
                    kind = DROPPED
                elif name in _MAIN:
                    kind = MAIN
            stack.append((name, kind))
    flush()
    return [line for line in lines if line[0] != DROPPED]


def common_subsequence(ours: list, theirs: list) -> list[int]:
    """Places in ``ours`` of a longest common subsequence (Hunt and Szymanski)."""
    places: dict = {}
    for j, line in enumerate(theirs):
        places.setdefault(line, []).append(j)
    ends: list[int] = []  # least end in theirs of a subsequence of each length
    chains: list = []
    for i, line in enumerate(ours):
        for j in reversed(places.get(line, ())):
            k = bisect_left(ends, j)
            chain = (i, chains[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                chains.append(chain)
            else:
                ends[k], chains[k] = j, chain
    found, chain = [], chains[-1] if chains else None
    while chain:
        found.append(chain[0])
        chain = chain[1]
    return found[::-1]


def host_and_path(url: str | None) -> tuple[str, str]:
    found = re.match(r"(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)([^?#]*)", url or "")
    return (found[1].lower(), found[2]) if found else ("", (url or "").split("?")[0].split("#")[0])


def _hash(line: str) -> int:
    return xxhash.xxh3_64_intdigest(line.encode("utf-8", "surrogatepass")) - (1 << 63)


_OUTLINE = "page_id long, url string, digest string, host string, path string, inside array<boolean>, lines array<long>, sizes array<int>"
_KEY = ["page_id", "url", "digest"]


def outlines(pages: DataFrame) -> DataFrame:
    """Per page its host, path, and of its lines that are not dropped whether they are
    inside a marked article, their hashes and lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for page, url, html in zip(*(c.to_pylist() for c in batch.columns)):
                lines = page_lines(html or "")
                inside = [kind == MAIN for kind, _ in lines]
                hashes, sizes = [_hash(text) for _, text in lines], [len(text) for _, text in lines]
                rows.append((page, url, _digest(html), *host_and_path(url), inside, hashes, sizes))
            kinds = [pa.int64(), *[pa.string()] * 4, *map(pa.list_, (pa.bool_(), pa.int64(), pa.int32()))]
            columns = list(zip(*rows)) or [()] * len(kinds)
            names = [part.split()[0] for part in _OUTLINE.split(", ")]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return pages.mapInArrow(run, _OUTLINE)


def _digest(html: str | None) -> str:
    return xxhash.xxh3_128_hexdigest((html or "").encode("utf-8", "surrogatepass"))


def _ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with their place in the order of host, path and key."""
    order = ["host", "path", *_KEY]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * n, pa.int32()), pa.array(range(count, count + n), pa.int64())],
                [*batch.schema.names, "part", "number"],
            )
            count += n

    numbered = staged(
        rows.orderBy(*order).mapInArrow(number, f"{_OUTLINE}, part int, number long"), "ordered"
    )
    # One row per task, so the running total is a small sum however many pages there are.
    sizes = numbered.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return numbered.join(F.broadcast(bases), "part").withColumn("rank", F.col("base") + F.col("number"))


def unlike(shared: int, ours: int, theirs: int) -> bool:
    """Whether two pages that share so many characters are pages of their own."""
    return 2 * shared <= min(ours, theirs)


def _blocks(ranked: DataFrame) -> DataFrame:
    """``ranked`` with the blocks a page is compared in; the ``NEAR`` pages on either
    side of a block are in it too."""
    first, last = (F.floor((F.col("rank") + step) / BLOCK) for step in (-NEAR, NEAR))
    return ranked.withColumn("block", F.explode(F.sequence(first, last)))


def shared_lines(outline: DataFrame) -> DataFrame:
    """(page key, gone): places of the lines outside a marked article that a page
    shares with neighbours that are otherwise unlike."""
    order = Window.partitionBy("block").orderBy("rank")
    steps = [step for step in range(-NEAR, NEAR + 1) if step]
    near = {f"near{k}": F.lead(F.struct("host", "lines", "sizes"), step).over(order) for k, step in enumerate(steps)}
    compared = _blocks(_ranked(outline.dropDuplicates(_KEY))).withColumns(near)
    joined = compared.where(F.col("block") == F.floor(F.col("rank") / BLOCK))

    kind = pa.list_(pa.int32())

    @F.arrow_udf("array<int>")
    def gone(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in columns:
            out = []
            for host, inside, lines, sizes, *near in zip(*(column.to_pylist() for column in batch)):
                away: set[int] = set()
                for other in near:
                    if other and other["host"] == host:
                        shared = common_subsequence(lines, other["lines"])
                        if unlike(sum(sizes[k] for k in shared), sum(sizes), sum(other["sizes"])):
                            away.update(shared)
                out.append(sorted(k for k in away if not inside[k]))
            yield pa.array(out, kind)

    found = joined.withColumn("gone", gone("host", "inside", "lines", "sizes", *near))
    return found.select(*_KEY, "gone").where(F.size("gone") > 0)


_TEXTS = "page_id long, url string, text string, n_deleted long"


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_deleted) of every page; the last is the number of lines
    that differencing deleted."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    gone = staged(shared_lines(staged(outlines(rows), "outlines")), "shared-lines")
    keyed = rows.withColumn("digest", _digest_column("html"))
    renamed = gone.select(*[F.col(c).alias(f"_{c}") for c in _KEY], "gone")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _KEY]
    joined = keyed.join(renamed, same[0] & same[1] & same[2], "left")
    joined = joined.select("page_id", "url", "html", "gone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, deleted = [], []
            for html, places in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                away = set(places or ())
                left = [line for k, line in enumerate(page_lines(html or "")) if k not in away]
                chosen = [text for kind, text in left if kind == MAIN] or [text for _, text in left]
                texts.append("\n".join(chosen))
                deleted.append(len(away))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(deleted, pa.int64())],
                ["page_id", "url", "text", "n_deleted"],
            )

    return joined.mapInArrow(run, _TEXTS)


def _digest_column(html: str):
    @F.arrow_udf("string")
    def digest(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array([_digest(text) for text in column.to_pylist()], pa.string())

    return digest(F.col(html))


def op6_htmltext(spark, sf_dir: str) -> DataFrame:
    texts = main_texts(table(spark, sf_dir, "pages"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_deleted")
