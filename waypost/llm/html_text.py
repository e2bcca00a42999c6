"""Main text of web pages by nearest-URL page differencing.

Pages are sorted by host and URL path, so a page's nearest page by path is one of its
two neighbours; adjacent pages with one body are copies, and the nearest one beyond them
counts. Text lines are aligned by longest common subsequence, and shared lines are
deleted: what two pages of a site have in common is its frame. By tags, lines of the
page's own article element are kept in spite of that, and elements that hold no main text
by their kind or name (menus, footers, adverts, forms, comments and so on) are left out
wherever they are; sharing decides for all other lines.

The sort is a range partitioning by (host, path, a hash of id and URL): a host with a
third of all pages is many partitions. Their bounds come from a sample of the keys, as
those of Spark's own range partitioning do. A first pass shuffles keys and digests of
bodies only; it finds for each partition the one page before and the one after it that
its own pages at the edges, with their copies, are to be compared with. The second pass
sends these two to the partition as well, so that no page's text depends on where
partitions end. Pages are parsed in both passes, and only their lines are shuffled. A
task holds four pages at a time, and the ids and URLs of adjacent copies.
"""

from __future__ import annotations

import bisect
import hashlib
import html
import itertools
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

# HTML's element kinds.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object", "canvas"}
FRAME = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "head"}
ARTICLE = {"article", "main"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCK = ARTICLE | FRAME | {
    "address", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption",
    "figure", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "ol", "optgroup",
    "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}

#: Least pages in a partition; there are no more partitions than Spark's shuffles have.
PARTITION_PAGES = 500

#: Keys sampled for the bounds of partitions, of each and in all.
SAMPLED_KEYS = (100, 1_000_000)

#: Words in a class, id or role that mark a part as no main text.
_MARKED = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|banner|breadcrumbs?|comments?|consent|cookies?|disqus|dialog"
    r"|footer|masthead|menu|modal|nav|navbar|navigation|newsletter|notice|popup|promo|promoted|related|replies|search"
    r"|share|sharing|sidebar|social|sponsor|sponsored|subscribe|subscription|toolbar|complementary|contentinfo)(?:$|[\s_-])",
    re.IGNORECASE,
)
_TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*+)(?:>|\Z)", re.DOTALL)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.IGNORECASE)
_SPACE = re.compile(r"\s+")


@dataclass
class Line:
    text: str
    framed: bool  # within an element that holds no main text
    article: bool  # within the page's article


def _framed(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in FRAME or (tag == "header" and not in_article):
        return True
    if tag in ("html", "body") or tag in ARTICLE or not attributes:
        return False
    if _HIDDEN.search(attributes):
        return True
    return any(_MARKED.search(a or b or c) for a, b, c in _NAMED.findall(attributes))


def lines(page: str) -> list[Line]:
    """The non-empty blocks of a page in order, references decoded, white space as one space.

    Cut or unclosed markup is taken as far as it goes: a start of an article ends
    whatever part was left open before it, and an end tag closes all within it.
    """
    out: list[Line] = []
    held: list[str] = []
    open_: list[tuple[str, bool, bool]] = []  # tag, framed, article; of this and all around

    def flush() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(held))).strip()
        held.clear()
        if text:
            _, framed, article = open_[-1] if open_ else ("", False, False)
            out.append(Line(text, framed, article))

    at, raw = 0, None
    while at < len(page):
        if raw:  # nothing is markup until its end tag
            end = re.compile(rf"</{re.escape(raw)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at, raw = (end.end() if end else len(page)), None
            continue
        found = page.find("<", at)
        if found < 0:
            held.append(page[at:])
            break
        token = _TOKEN.match(page, found)
        if not token:  # a bare sign, or a tag cut off by the end
            cut = re.match(r"</?\Z", page[found : found + 3]) is not None
            held.append(page[at:found] if cut else page[at : found + 1])
            at = found + 1
            if cut:
                break
            continue
        held.append(page[at:found])
        at = token.end()
        if token[2] is None:
            continue
        tag = token[2].lower()
        if tag in BLOCK or tag in RAW:
            flush()
        elif tag == "br":
            held.append(" ")
        if token[1]:
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] == tag:
                    flush()
                    del open_[k:]
                    break
        elif tag in RAW:
            raw = tag
        elif tag not in VOID:
            if tag in ARTICLE and not any(o[2] for o in open_):
                open_.clear()
            _, framed, article = open_[-1] if open_ else ("", False, False)
            if tag == "p" and open_ and open_[-1][0] == "p":  # a paragraph ends the one before
                open_.pop()
                _, framed, article = open_[-1] if open_ else ("", False, False)
            article |= tag in ARTICLE
            framed |= _framed(tag, token[3] or "", article)
            if (framed, article) != (open_[-1][1:] if open_ else (False, False)):
                flush()
            open_.append((tag, framed, article))
    flush()
    return out


def shared(own: list[str], other: list[str]) -> set[int]:
    """Places in ``own`` of a longest common subsequence with ``other``.

    A line that occurs more than once is matched in the order of its occurrences.
    """

    def labelled(texts: list[str]) -> list[tuple[str, int]]:
        seen: dict[str, int] = {}
        out = []
        for t in texts:
            seen[t] = seen.get(t, 0) + 1
            out.append((t, seen[t]))
        return out

    place = {x: k for k, x in enumerate(labelled(other))}
    tails: list[int] = []  # last place in other of the best run of each length
    ends: list[int] = []
    back: dict[int, int | None] = {}
    for k, x in enumerate(labelled(own)):
        if x in place:
            at = bisect.bisect_left(tails, place[x])
            back[k] = ends[at - 1] if at else None
            tails[at : at + 1] = [place[x]]
            ends[at : at + 1] = [k]
    out, k = set(), ends[-1] if ends else None
    while k is not None:
        out.add(k)
        k = back[k]
    return out


def main_text(own: list[Line], near: list[str] | None) -> str:
    """The lines of ``own`` that are main text, given those of the nearest page."""
    common = shared([x.text for x in own], near) if near else set()
    kept = [x.text for k, x in enumerate(own) if not x.framed and (x.article or k not in common)]
    return "\n".join(kept)


def _same_start(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


@dataclass
class Near:
    """A neighbour: its path and the text of its lines."""

    path: str
    texts: list[str]


@dataclass
class Group:
    """Adjacent pages with one body on one host."""

    host: str
    body: list[Line]
    first: Near
    last: Near
    members: list[tuple] = field(default_factory=list)  # id, url, path; none if pages of another partition


def _packed(found: list[Line]) -> str:
    """Lines as one text; a line has no line end, and its first character holds both flags."""
    return "\n".join(f"{x.framed + 2 * x.article}{x.text}" for x in found)


def _unpacked(packed: str) -> list[Line]:
    return [Line(x[1:], x[0] in "13", x[0] in "23") for x in packed.split("\n")] if packed else []


Key = tuple[str, str, int, int]  # host, path, hash of id and URL, hash of lines


def _parsed(batches: Iterator[pa.RecordBatch], bounds: list[tuple]) -> Iterator[tuple]:
    """Per page its partition, id, URL, key and lines."""
    for batch in batches:
        for page_id, url, host, path, print_, page in zip(*(c.to_pylist() for c in batch.columns)):
            found = lines(page or "")
            mark = xxhash.xxh3_64_intdigest(_packed(found)) >> 1
            yield bisect.bisect_right(bounds, (host, path, print_)), page_id, url, (host, path, print_, mark), found


def _sketching(bounds: list[tuple]):
    """Pages' keys and digests of their bodies."""
    names = ["pid", "host", "path", "print", "mark", "digest"]
    types = [pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for pid, _, _, key, found in _parsed(batches, bounds):
            body = _packed([x for x in found if not x.framed])
            yield pid, *key, hashlib.blake2b(body.encode(), digest_size=16).digest()

    return lambda batches: _batches(rows(batches), names, types, [])


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per partition the first and last page of its first two and its last two groups, if it has two."""
    key = pa.struct([("host", pa.string()), ("path", pa.string()), ("print", pa.int64()), ("mark", pa.int64())])
    group = pa.struct([("first", key), ("last", key), ("digest", pa.binary())])
    names = ["pid", "head", "tail"]

    def rows() -> Iterator[tuple]:
        pages = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        for pid, own in itertools.groupby(pages, lambda row: row[0]):
            head, tail = [], []
            for (_, digest), same in itertools.groupby(own, lambda row: (row[1], row[5])):
                first = last = next(same)
                for last in same:
                    pass
                made = {"first": _key(first), "last": _key(last), "digest": digest}
                head, tail = (head + [made])[:2], (tail + [made])[-2:]
            yield pid, head, tail

    return _batches(rows(), names, [pa.int32(), pa.list_(group), pa.list_(group)], [])


def _key(row: tuple) -> dict:
    return dict(zip(("host", "path", "print", "mark"), row[1:5]))


def _handed_over(partitions: list) -> dict[Key, list[int]]:
    """Pages that partitions other than their own need, from the groups at partitions' edges.

    Groups of adjacent partitions with one body are one; the page is the one beyond all of it.
    """
    out: dict[Key, list[int]] = {}
    for ordered, near_end, far_end, side in (
        (partitions, "head", "tail", "last"),
        (partitions[::-1], "tail", "head", "first"),
    ):
        page, near = None, 0 if near_end == "head" else -1
        for before, here in zip(ordered, ordered[1:]):
            edge, beyond = here[near_end][near], before[far_end][-1 - near]
            if (beyond["first"]["host"], beyond["digest"]) != (edge["first"]["host"], edge["digest"]):
                page = tuple(beyond[side])
            elif len(before[far_end]) > 1:
                page = tuple(before[far_end][near][side])
            # Else all of that partition is one group with this one's, and has the same page beyond it.
            if page and page[0] == edge["first"]["host"] != "":
                out.setdefault(page, []).append(here["pid"])
    return out


def _dealing(bounds: list[tuple], wanted: dict[Key, list[int]], id_type: pa.DataType):
    """Pages' lines to their own partition, and to those that they are handed over to."""
    names = ["pid", "own", "id", "url", "host", "path", "print", "mark", "lines"]
    types = [pa.int32(), pa.bool_(), id_type, *[pa.string()] * 3, pa.int64(), pa.int64(), pa.string()]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for pid, page_id, url, key, found in _parsed(batches, bounds):
            packed = _packed(found)
            yield pid, True, page_id, url, *key, packed
            for other in wanted.get(key, ()):
                yield other, False, None, None, *key, packed

    return lambda batches: _batches(rows(batches), names, types, [8])


def _groups(rows: Iterable[tuple]) -> Iterator[Group]:
    held = None
    for _, own, page_id, url, host, path, packed in rows:
        found = _unpacked(packed)
        body, here = [x for x in found if not x.framed], Near(path, [x.text for x in found])
        if held is None or held.host != host or held.body != body:
            if held is not None:
                yield held
            held = Group(host, body, here, here)
        held.last = here
        if own:
            held.members.append((page_id, url, path))
    if held is not None:
        yield held


def _nearest(path: str, before: str | None, after: str | None) -> int:
    """0 for the neighbour before, 1 for the one after, -1 for none; the one before if equally near."""
    if before is None or after is None:
        return -1 if before is after else int(before is None)
    return int(_same_start(after, path) > _same_start(before, path))


def _batches(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], sized: list[int]) -> Iterator[pa.RecordBatch]:
    """Rows in batches of a few megabytes by the text columns ``sized``."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(row[k] or "") for k in sized) + 100
        if size > 4_000_000:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), types)], names)
            held, size = [], 0
    if held:
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), types)], names)


def _extracting(id_type: pa.DataType) -> Callable:
    def on_host(x: Group | None, here: Group) -> bool:
        return x is not None and x.host == here.host != ""

    def texts(rows: Iterable[tuple]) -> Iterator[tuple]:
        before = here = None
        for after in _then_none(_groups(rows)):
            if here is not None:
                near = [before.last if on_host(before, here) else None, after.first if on_host(after, here) else None]
                made: dict[int, str] = {}
                for page_id, url, path in here.members:
                    k = _nearest(path, *(x and x.path for x in near))
                    if k not in made:
                        made[k] = main_text(here.body, near[k].texts if k >= 0 else None)
                    yield page_id, url, made[k]
            before, here = here, after

    def partitions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        for _, own in itertools.groupby(rows, lambda row: row[0]):
            yield from texts(own)

    types = [id_type, pa.string(), pa.string()]
    return lambda batches: _batches(partitions(batches), ["id", "url", "text"], types, [2])


def _then_none(rows: Iterator) -> Iterator:
    yield from rows
    yield None


def _bounds(keys: DataFrame, total: int, n: int) -> list[tuple]:
    """Where partitions of about equal numbers of rows begin, from a sample of bounded size."""
    if n == 1:
        return []
    wanted = min(n * SAMPLED_KEYS[0], SAMPLED_KEYS[1])
    sample = sorted(tuple(r) for r in keys.sample(min(1.0, wanted / total), seed=1).collect())
    return sorted({sample[k * len(sample) // n] for k in range(1, n)}) if sample else []


def extract_text(
    pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Per row of ``pages`` its id, ``url``, ``text`` (blocks joined by newlines) and ``n_chars``.

    A null or empty page has an empty text. A page without a URL or host, or alone on
    its host, is compared with none. Repeated rows come out each time, with one text.
    Other columns are not read, and no rows give no rows. The result does not depend on
    the partitioning.
    """
    id_type = to_arrow_type(pages.schema[id_col].dataType)
    kind = pages.schema[id_col].dataType.simpleString()
    url = F.coalesce(F.col(url_col), F.lit(""))
    parts = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)([^?#]*)"
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).alias("url"),
        F.lower(F.regexp_extract(url, parts, 1)).alias("host"),
        F.regexp_extract(url, parts, 2).alias("path"),
        F.xxhash64(id_col, url_col).alias("print"),
        F.col(html_col).alias("html"),
    )
    total = pages.count()
    n = min(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // PARTITION_PAGES + 1)
    bounds = _bounds(rows.select("host", "path", "print"), total, n)
    order = ["pid", "host", "path", "print", "mark"]
    key = "host string, path string, print long, mark long"
    wanted = {}
    if n > 1:
        sketches = rows.mapInArrow(_sketching(bounds), f"pid int, {key}, digest binary")
        group = f"array<struct<first struct<{key}>, last struct<{key}>, digest binary>>"
        edges = sketches.repartitionById(n, "pid").sortWithinPartitions(*order)
        # A row of at most four keys for each partition.
        partitions = edges.mapInArrow(_edges, f"pid int, head {group}, tail {group}").collect()
        wanted = _handed_over(sorted(partitions, key=lambda p: p.pid))
    dealt = rows.mapInArrow(_dealing(bounds, wanted, id_type), f"pid int, own boolean, id {kind}, url string, {key}, lines string")
    sorted_ = dealt.repartitionById(n, "pid").sortWithinPartitions(*order).drop("print", "mark")
    texts = sorted_.mapInArrow(_extracting(id_type), f"id {kind}, url string, text string")
    return texts.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))
