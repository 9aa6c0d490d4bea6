"""Main text of HTML pages by differencing against the nearest page of the same host.

A page is cut into blocks of text. Inside an element that marks the main content (article,
main) everything but marked furniture is content; furniture (menus, headers, footers, sidebars,
notices, adverts, forms, comments, scripts and styles) is told by its element, its role or a
whole token of its class or id, and is dropped; tokens tell nothing of the main element and of
elements that contain one, and inside it fewer of them count. A header inside it holds the headline
and stays; a menu, header or form whose end is missing ends where it begins. Other blocks are template or content, and that is decided
by differencing: pages of a host stand in the order of their URL path, each is compared with the
neighbour whose path shares the longer beginning (ties: the one before), their blocks are
aligned by longest common subsequence, and blocks found in both are deleted. Blocks inside the
main element are aligned too but never deleted: an article may quote what another one says.

Pages of a host with equal blocks are one, whatever their paths: the one first in order stands for
all, is compared with the nearest different page, and every copy loses the same blocks.

Blocks are compared by 64-bit hashes, and only these are moved and stored; the comparison gives the
positions that go, and the text is cut from the page as it is parsed for the result.

Order over pages is global, so no host is gathered: first the keys alone are sorted by range and
the first and last key of each range noted (as many rows as tasks reach the driver); then pages
go to those ranges, and the two pages at each cut go to both sides. A task streams its sorted
range and holds three pages.

Nulls: null html is an empty page with empty text; a null url is a host of its own, ordered by
page_id; a null page_id sorts first. Rows that
repeat a url are neighbours like others if their blocks differ. A page alone on its host keeps its
unmarked blocks. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from html.parser import HTMLParser
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import RowWriter, materialise

RESULT = "page_id long, url string, text string, n_chars long"
#: Elements as fixed values of the language.
MAIN = frozenset("article main".split())
#: Furniture that an unclosed tag may stretch over the main element, which then ends it.
OPENED = frozenset("nav header form menu button select option".split())
FURNITURE = frozenset("nav header footer aside form script style noscript template iframe svg button select option textarea dialog menu head title object canvas".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img br".split())
CLOSES_PARAGRAPH = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
#: Class and id words of furniture, as fixed values. The first kind counts everywhere, the second
#: only outside the main element, where an article has no sections of such names.
_STRONG = (
    r"(?:ads?|adverts?|advertis\w+|sponsor(?:ed|s)?|banner|nav|nav-?bar|navigation|menu|breadcrumbs?|side-?bar|footer|"
    r"masthead|cookies?|consent|popup|modal|newsletter|subscribe|signup|comments?|replies|pagination|pager|toolbar|disclaimer)"
)
_WEAK = r"(?:promo\w*|header|notice|login|search|share|social|related|recommend\w*|widget)"
_COMMENTS = r"(?:comments?[_-]?(?:list|body|area|section|form|thread|content|wrap\w*|respond|reply)|disqus\w*|respond)"
_EITHER = rf"(?:{_STRONG}|{_WEAK})"
#: A token of such words alone, as cookie-notice, or one that ends in one, as site-footer; but not a
#: state, as has-sidebar.
_STATE = r"(?:has|no|with|without|is|not|hide|show|open|close|closed|full)"
_ENDS = rf"(?!{_STATE}[_-])[a-z0-9]+(?:[_-][a-z0-9]+)*[_-](?:menu|nav|nav-?bar|navigation|footer|comments|side-?bar|breadcrumbs?|banner|ads?)"


def _tokens(pattern: str):
    return re.compile(rf"(?<!\S)(?:{pattern})(?!\S)", re.IGNORECASE).search


_MARKS_INSIDE = _tokens(rf"{_STRONG}(?:[_-]+{_EITHER})*|{_COMMENTS}|{_ENDS}")
_MARKS = _tokens(rf"{_EITHER}(?:[_-]+{_EITHER})*|{_COMMENTS}|{_ENDS}")
_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
_SPACE = re.compile(r"\s+")


class _Blocks(HTMLParser):
    """Collects (text, in the main element) of every block that is not furniture."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[list[tuple[str, tuple[int, ...]]], bool]] = []
        self.open: list[tuple[str, int, bool, int]] = []  # name, furniture, main, number of its mark
        self.hidden = self.main = self.last = 0
        self.parts: list[tuple[str, tuple[int, ...]]] = []  # text, marks around it
        self.marks: tuple[int, ...] = ()
        self.wrong: set[int] = set()  # marks of elements that turned out to contain the main one

    def flush(self) -> None:
        if self.parts:
            self.found.append((self.parts, self.main > 0))
            self.parts = []

    @property
    def blocks(self) -> list[tuple[str, bool]]:
        out = []
        for parts, main in self.found:
            shown = "".join(text for text, marks in parts if self.wrong.issuperset(marks))
            if text := _SPACE.sub(" ", shown).strip():
                out.append((text, main))
        return out

    def handle_starttag(self, tag, attrs):
        if tag not in INLINE:
            self.flush()
        elif tag in VOID:
            self.parts.append((" ", self.marks))
        if tag in VOID:
            return
        if tag in CLOSES_PARAGRAPH:
            self._close_to("p", stop=("table", "td", "th", "button"))
        elif tag in ("li", "dt", "dd", "tr", "td", "th"):
            kin = ("dt", "dd") if tag in ("dt", "dd") else ("td", "th") if tag in ("td", "th") else (tag,)
            for name in kin:
                self._close_to(name, stop=("ul", "ol", "dl", "table", "menu"))
        furniture, marked, main = tag in FURNITURE, False, tag in MAIN
        if tag == "header" and self.main:
            furniture = False  # the headline of an article stands there
        marks = _MARKS_INSIDE if self.main else _MARKS
        if not furniture and tag not in ("html", "body") and attrs:
            for name, value in attrs:
                if value and name == "role" and value.lower() in _ROLES:
                    furniture = True
                elif value and not main and name in ("class", "id") and marks(value):
                    marked = True
                elif name == "hidden" or name == "aria-hidden" and value == "true":
                    furniture = True
        if main:
            self.wrong.update(self.marks)
            for at, (name, hides, is_main, mark) in enumerate(self.open):
                if hides and name in OPENED:
                    self.hidden -= 1
                    self.open[at] = name, False, is_main, mark
        self.last += marked
        self.open.append((tag, furniture, main, self.last if marked else 0))
        if marked:
            self.marks += (self.last,)
        self.hidden += furniture
        self.main += main

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.flush()
        if tag in VOID:
            return
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                self._close(at)
                return
            if self.open[at][0] in MAIN and tag in INLINE:
                return

    def _close_to(self, tag, stop):
        for at in range(len(self.open) - 1, -1, -1):
            name = self.open[at][0]
            if name == tag:
                self._close(at)
                return
            if name in stop or name in MAIN:
                return

    def _close(self, at):
        for _, furniture, main, mark in self.open[at:]:
            self.hidden -= furniture
            self.main -= main
            if mark:
                self.marks = self.marks[:-1]
        del self.open[at:]

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append((data, self.marks))


def blocks(html: str | None) -> list[tuple[str, bool]]:
    """Blocks of a page in order: text with single spaces, and whether it is protected."""
    parser = _Blocks()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    return parser.blocks


def shared(a: list[str], b: list[str]) -> set[int]:
    """Positions in a of a longest common subsequence of a and b.

    Lines that are in only one of them are left out first, and so are equal beginnings and ends;
    the table is then one row of bits per line (Hyyro's form of the algorithm), so memory is one
    bit for each pair of remaining lines.
    """
    both = set(a) & set(b)
    x = [i for i, line in enumerate(a) if line in both]
    y = [line for line in b if line in both]
    begin = 0
    while begin < min(len(x), len(y)) and a[x[begin]] == y[begin]:
        begin += 1
    end = 0
    while end < min(len(x), len(y)) - begin and a[x[-1 - end]] == y[-1 - end]:
        end += 1
    out = set(x[:begin]) | set(x[len(x) - end :])
    x, y = x[begin : len(x) - end], y[begin : len(y) - end]
    if not x or not y:
        return out
    where: dict[str, int] = {}
    for j, line in enumerate(y):
        where[line] = where.get(line, 0) | 1 << j
    full, row, rows = (1 << len(y)) - 1, (1 << len(y)) - 1, []
    for i in x:
        match = where.get(a[i], 0)
        row = ((row + (row & match)) | (row & ~match)) & full
        rows.append(row)  # a zero bit: the length rises at this line of b
    # walk back: a line of a is used where it raised the length
    j = len(y)
    for k in range(len(x) - 1, -1, -1):
        mask = (1 << j) - 1
        here = j - (rows[k] & mask).bit_count()
        above = j - (rows[k - 1] & mask).bit_count() if k else 0
        if here > above:
            out.add(x[k])
            # move to the last line of b before which the length was one less
            while j and (j - (rows[k] & ((1 << j) - 1)).bit_count()) == here:
                j -= 1
    return out


def deleted(page, other) -> list[int]:
    """Positions of a page's blocks (line, protected) that its neighbour shares and that may go."""
    if other is None or all(kept for _, kept in page):
        return []
    gone = shared([line for line, _ in page], [line for line, _ in other])
    return sorted(i for i in gone if not page[i][1])


def host_and_path(url: str | None) -> tuple[str, str]:
    if url is None:
        return "", ""
    try:
        parts = urlsplit(url)
        return (parts.hostname or "").lower(), parts.path + ("?" + parts.query if parts.query else "")
    except ValueError:
        return "", url


def _common(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _digest(found: list[tuple[str, bool]]) -> str:
    """Names the blocks of a page."""
    out = hashlib.sha256()
    for text, kept in found:
        data = text.encode("utf-8", "surrogatepass")
        out.update(b"%d %d " % (kept, len(data)) + data)
    return out.hexdigest()


def _line(text: str) -> int:
    """A signed 64-bit hash that stands for a line; equal lines of two pages are told by it."""
    from xxhash import xxh64_intdigest

    value = xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
    return value - (1 << 64) if value >> 63 else value


def _parsed(pages: DataFrame, whole: bool) -> DataFrame:
    """host and digest of every page; with its path and lines if whole, else with its url and blocks."""
    fields = [("host", pa.string()), ("digest", pa.string()), ("page_id", pa.int64())]
    lines = [("path", pa.string()), ("lines", pa.list_(pa.int64())), ("kept", pa.list_(pa.bool_()))]
    schema = pa.schema(fields + (lines if whole else [("url", pa.string()), ("texts", pa.list_(pa.string()))]))

    def run(batches):
        for batch in batches:
            out = RowWriter(schema)
            for page_id, url, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                host, path = host_and_path(url)
                found = blocks(html.as_py())
                texts = [t for t, _ in found]
                row = (path, list(map(_line, texts)), [k for _, k in found]) if whole else (url, texts)
                out.add(host, _digest(found), page_id, *row)
            yield out.take()

    names = "host string, digest string, page_id long, "
    return pages.mapInArrow(run, names + ("path string, lines array<long>, kept array<boolean>" if whole else "url string, texts array<string>"))


def _cuts(pages: DataFrame) -> list[tuple[tuple, tuple]]:
    """(last key of one range, first key of the next) for all neighbouring ranges."""
    order = ["host", "path", F.col("page_id").asc_nulls_first(), "digest"]
    # a fixed number of ranges: of keys alone, adaptive execution would make very few
    ranges = 2 * int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = ["host", "path", "page_id", "digest"]
    keys = pages.select(names).repartitionByRange(ranges, *order).sortWithinPartitions(*order)

    def run(batches):
        first = last = None
        for batch in batches:
            if batch.num_rows:
                first = first if first is not None else batch.slice(0, 1)
                last = batch.slice(batch.num_rows - 1)
        if first is not None:
            yield pa.Table.from_batches([first, last]).combine_chunks().to_batches()[0]

    def key(row):
        return row[0], row[1], row[2] is not None, row[2] or 0, row[3]

    ends = sorted(key(r) for r in keys.mapInArrow(run, "host string, path string, page_id long, digest string").collect())
    return [(ends[i], ends[i + 1]) for i in range(1, len(ends) - 1, 2)]


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every page."""
    pages = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].alias("url"), pages["html"].alias("html"))
    spark = pages.sparkSession
    # one page of each host and digest, with its lines as hashes; no text is moved
    first = F.min(F.struct("path", F.col("page_id").isNotNull().alias("named"), "page_id", "lines", "kept"))
    different = _parsed(pages, True).groupBy("host", "digest").agg(first.alias("first"))
    different = materialise(
        different.select("host", "first.path", "first.page_id", "digest", "first.lines", "first.kept"), "pages"
    )
    cuts = _cuts(different)
    starts = [after for _, after in cuts]
    lasts = {before: i for i, (before, _) in enumerate(cuts)}
    firsts = {after: i for i, (_, after) in enumerate(cuts)}
    schema = pa.schema(
        [
            ("piece", pa.int32()), ("own", pa.bool_()), ("host", pa.string()), ("path", pa.string()),
            ("page_id", pa.int64()), ("digest", pa.string()), ("lines", pa.list_(pa.int64())), ("kept", pa.list_(pa.bool_())),
        ]
    )
    fields = (
        "piece int, own boolean, host string, path string, page_id long, digest string, lines array<long>, kept array<boolean>"
    )

    def cut(batches):
        for batch in batches:
            out = RowWriter(schema)
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                host, path, page_id, digest = row[:4]
                key = host, path, page_id is not None, page_id or 0, digest
                piece = bisect_right(starts, key)
                out.add(piece, True, *row)
                # the pages on either side of a cut are seen from both
                if key in lasts and lasts[key] == piece:
                    out.add(piece + 1, False, *row)
                if key in firsts and firsts[key] == piece - 1:
                    out.add(piece - 1, False, *row)
            yield out.take()

    result = pa.schema([("host", pa.string()), ("digest", pa.string()), ("gone", pa.list_(pa.int32()))])

    def compare(batches):
        out = RowWriter(result)

        def rows():
            for batch in batches:
                for *values, lines, kept in zip(*(c.to_pylist() for c in batch.columns)):
                    yield values, list(zip(lines, kept))

        def near(row, other):
            """How far the paths agree; None if it is no neighbour."""
            if other is None or other[0][2] != row[0][2] or other[0][0] != row[0][0]:
                return None
            return _common(row[0][3], other[0][3])

        def done(before, row, after):
            if not row[0][1]:
                return
            back, forth = near(row, before), near(row, after)
            other = None
            if back is not None and (forth is None or back >= forth):
                other = before[1]
            elif forth is not None:
                other = after[1]
            gone = deleted(row[1], other)
            if gone:
                out.add(row[0][2], row[0][5], gone)

        before = now = None
        for row in rows():
            if now is not None:
                done(before, now, row)
                if out.full():
                    yield out.take()
            before, now = now, row
        if now is not None:
            done(before, now, None)
        yield out.take()

    parallel = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = different.mapInArrow(cut, fields).repartition(parallel, "piece")
    ordered = dealt.sortWithinPartitions("piece", "host", "path", F.col("page_id").asc_nulls_first(), "digest", "own")
    # written first, so that its size is known when the blocks are joined with it: Spark broadcasts
    # it below its own limit and else moves the blocks of the pages once
    gone = materialise(ordered.mapInArrow(compare, "host string, digest string, gone array<int>"), "deleted")
    found = _parsed(pages, False).join(gone, ["host", "digest"], "left")
    left = F.filter("texts", lambda t, i: ~F.array_contains("gone", i))
    text = F.array_join(F.when(F.col("gone").isNull(), F.col("texts")).otherwise(left), "\n")
    return found.select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"))
