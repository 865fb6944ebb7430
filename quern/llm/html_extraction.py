"""Main text of web pages: page structure, then differencing against the page with the nearest URL.

A page is cut into lines, one a block. Lines inside navigation, notices, adverts, forms, comments and the like go by their structure. Where
a page marks its article, the article's lines stay, for neighbouring pages may well carry the same passages. Every other line is at stake:
pages of one host are ordered by URL path, each is aligned with its neighbours by longest common subsequence, and shared lines are deleted.
Neighbours are the nearest pages before and after with other content: copies of a page would take all of it away.

Only hashes and lengths of lines are sorted, by (host, path, page id), so a host with a third of all pages is spread over many ranges. A
range hands on its last page and the last one before it with other content, once in each direction; the driver gets these short rows.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import cut, table

SAME = 0.9  # share of the characters of the longer page in lines of the other, from which two pages are copies
BROADCAST_PAGES = 200_000  # pages with deleted lines that are sent whole to every task; above, they are joined by shuffle

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:"[^"]*"|'[^']*'|[^'">])*)>|<[!?][^>]*>""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
#: Elements by their part in a page.
RAW = frozenset("script style textarea title noscript iframe xmp svg math template".split())
DROPPED = frozenset("nav footer aside form button select dialog menu object canvas audio video head datalist".split())
ARTICLE = frozenset(("article", "main"))
CONTAINERS = frozenset("div section article main nav header footer aside form figure ul ol dl table body html button select dialog menu object canvas audio video head datalist blockquote details fieldset".split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr td th caption figcaption pre address hr summary thead tbody tfoot legend title option".split())
BOILER_WORDS = frozenset("ad ads advert adverts advertisement banner banners cookie cookies consent gdpr sidebar comment comments disqus menu nav navbar navigation breadcrumb breadcrumbs share sharing social promo sponsor sponsored newsletter subscribe subscription related footer popup modal notice notices alert signup login search pagination toolbar widget masthead copyright".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())


#: Elements that class words never drop, and the containers of which a whole name must be made of such words, for they can hold the page.
KEPT = frozenset(("html", "body", "main", "article"))
OUTER = frozenset(("div", "section", "table"))
#: Words beside boilerplate words in the names of containers that hold nothing else.
BESIDE = frozenset("list box area wrap wrapper inner block slot unit links items top bottom left right".split())


def _named(tag: str, names: str) -> bool:
    """Whether a class or id says that an element is boilerplate."""
    if tag in KEPT:
        return False
    if tag not in OUTER:
        return not BOILER_WORDS.isdisjoint(re.split(r"[^a-z0-9]+", names))
    for name in names.split():
        parts = [x for x in re.split(r"[^a-z0-9]+", name) if not x.isdigit() and x]
        if not BOILER_WORDS.isdisjoint(parts) and BOILER_WORDS.union(BESIDE).issuperset(parts):
            return True
    return False


def _boiler(tag: str, attributes: str, inside_article: bool) -> bool:
    if tag in DROPPED or tag == "header" and not inside_article:
        return True
    if not attributes or not attributes.strip():
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        value, name = "".join(values).lower(), name.lower()
        if name in ("class", "id") and _named(tag, value):
            return True
        if name == "role" and value in BOILER_ROLES or name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return False


def lines(html: str) -> list[tuple[str, bool, bool]]:
    """(text, in the article, dropped by structure) of each non-empty block, in page order."""
    out: list[tuple[str, bool, bool]] = []
    stack: list[tuple[str, bool, bool]] = []  # open containers: tag, in an article, dropped
    parts: list[str] = []
    article = dropped = False
    at = 0

    def close_line() -> None:
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                out.append((text, article, dropped))
            parts.clear()

    while True:
        m = TOKEN.search(html, at)
        if not m:
            rest = html[at:]
            parts.append(re.sub(r"<[a-zA-Z/!?].*", "", rest, flags=re.S))
            break
        if m.start() > at:
            parts.append(html[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag, closing = m[2].lower(), m[1] == "/"
        if tag in BLOCKS:
            close_line()
        elif tag == "br":
            parts.append(" ")
        if tag in RAW and not closing:
            if not m[3].endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)
                at = end.end() if end else len(html)
        elif tag in CONTAINERS or tag in DROPPED:
            if not closing:
                if not m[3].endswith("/"):
                    bad = dropped or _boiler(tag, m[3], article)
                    stack.append((tag, article, dropped))
                    article, dropped = article or tag in ARTICLE and not bad, bad
            elif any(t == tag for t, _, _ in stack):
                while True:
                    t, article, dropped = stack.pop()
                    if t == tag:
                        break
        elif tag in BLOCKS and not closing and not dropped and m[3] and _boiler(tag, m[3], article):
            # a paragraph or list item marked as boilerplate goes up to its end tag
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)
            at = end.end() if end else at
    close_line()
    return out


def shared(a: list[int], b: list[int]) -> set[int]:
    """Positions of ``a`` on a longest common subsequence with ``b``."""
    where: dict[int, list[int]] = {}
    for j, x in enumerate(b):
        where.setdefault(x, []).append(j)
    ends: list[int] = []  # smallest last position in b of a subsequence of each length
    last: list[tuple | None] = []
    for i, x in enumerate(a):
        for j in reversed(where.get(x, ())):
            k = bisect_left(ends, j)
            node = (i, last[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                last.append(node)
            else:
                ends[k] = j
                last[k] = node
    found, node = set(), last[-1] if last else None
    while node:
        found.add(node[0])
        node = node[1]
    return found


def host_path(url: str | None) -> tuple[str, str]:
    try:
        parts = urlsplit(url or "")
    except ValueError:
        return "", url or ""
    return (parts.hostname or "").lower(), parts.path.rstrip("/") or "/"


NAMES = ["page_id", "host", "path", "hashes", "lengths", "stake"]
KINDS = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32())]
LEAN = "page_id long, host string, path string, hashes array<long>, lengths array<int>, stake array<int>"


def _batch(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _lean(pages: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = lines(html or "")
                every = [xxhash.xxh3_64_intdigest(t.encode()) >> 1 for t, _, _ in found]
                stake = [k for k, (_, article, bad) in enumerate(found) if not bad and not article]
                if host := host_path(url)[0]:
                    out.append((page, host, host_path(url)[1], every, [0 if bad else len(t) for t, _, bad in found], stake))
            yield _batch(out, NAMES, KINDS)

    return pages.mapInArrow(run, LEAN)


def _copies(a: tuple, b: tuple) -> bool:
    """Whether two pages of ``NAMES`` are one page or hold the same lines, dropped ones aside."""
    if a[0] == b[0]:
        return True
    x, y = ({h: n for h, n in zip(p[3], p[4], strict=True) if n} for p in (a, b))
    return sum(n for h, n in x.items() if h in y) >= SAME * max(sum(x.values()), sum(y.values()))


def _next(state: tuple, page: tuple) -> tuple:
    """The last page and, before it, the last with other content, after ``page`` of the same or another host."""
    last, other = state
    if last is None or last[1] != page[1]:
        return page, None
    return page, other if _copies(last, page) else last


def _neighbour(state: tuple, page: tuple) -> tuple | None:
    """The nearest page of the host with other content."""
    return next((p for p in state if p is not None and p[1] == page[1] and not _copies(p, page)), None)


def _pass(parts: DataFrame, side: int) -> DataFrame:
    """(page_id, gone): positions of the lines at stake that the neighbour before (side 0) or after (1) shares."""
    keys = ["host", "path", "page_id"]
    order = parts.sortWithinPartitions(*keys, ascending=not side)
    from pyspark import TaskContext

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None, None
        for batch in batches:
            for page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                state = _next(state, page)
        at = TaskContext.get().partitionId()
        yield _batch([(*p, at, k) for k, p in enumerate(state) if p], [*NAMES, "part", "k"], [*KINDS, pa.int32(), pa.int32()])

    found: dict[int, list] = {}
    for r in order.mapInArrow(ends, LEAN + ", part int, k int").collect():
        found.setdefault(r["part"], [None, None])[r["k"]] = tuple(r)[:6]
    into, state = {}, (None, None)
    for part in sorted(found, reverse=bool(side)):
        into[part] = state
        last, other = found[part]
        # a range with one host's copies alone hands on what came before them
        state = (last, other) if other is not None else _next(state, last)
    into = parts.sparkSession.sparkContext.broadcast(into)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = into.value.get(TaskContext.get().partitionId(), (None, None))
        for batch in batches:
            out = []
            for page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if page[5] and (other := _neighbour(state, page)):
                    out.append((page[0], sorted(shared(page[3], other[3]) & set(page[5]))))
                state = _next(state, page)
            yield _batch(out, ["page_id", "gone"], [KINDS[0], KINDS[5]])

    return order.mapInArrow(run, "page_id long, gone array<int>")


def shared_lines(pages: DataFrame) -> DataFrame:
    """(page_id, gone): positions of the lines that a page shares with the page before or after it in its host's order of paths."""
    parts = cut(_lean(pages).repartitionByRange(F.col("host"), F.col("path"), F.col("page_id")))
    return _pass(parts, 0).union(_pass(parts, 1))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text, n_chars.

    A null or blank html gives an empty text. A null or malformed url, or one without a host, has no neighbours: structure alone decides.
    Repeated rows of one page don't count as neighbours of each other. Pages with a null id are extracted by structure alone. Other columns
    are ignored; an empty table gives an empty result. Whole pages are read; nothing is capped.
    """
    lean = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    gone = cut(shared_lines(lean.filter("page_id IS NOT NULL")).select("page_id", F.explode("gone").alias("g")).groupBy("page_id").agg(F.array_sort(F.collect_set("g")).alias("gone")))
    if gone.count() <= BROADCAST_PAGES:
        gone = F.broadcast(gone)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for html, away in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                found, away = lines(html or ""), set(away or ())
                texts.append("\n\n".join(t for k, (t, _, bad) in enumerate(found) if not bad and k not in away))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return lean.join(gone, "page_id", "left").select("page_id", "url", "html", "gone").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op4_html_extraction(spark, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
