"""Main text of web pages: pages near by URL are aligned line by line, and what they share is deleted."""

from __future__ import annotations

import html
import re

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from brackish.llm.texts import fresh, small_batches, widened

# What a line is: dropped for where it stands, open to comparison, or a paragraph of the article.
FURNITURE, OPEN, ARTICLE = 0, 1, 2

SAME_PAGE = 0.95  # share of the text from which two pages are versions of one
QUOTES = 256  # quoted strings in a tag; in one with more a quote is a sign like any other

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_URL = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)([^?#]*)"

_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style textarea title noscript template iframe svg math select option xmp noframes".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
_PARAGRAPHS = set("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th figcaption caption".split())
_CLOSED_BY_NEXT = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_FURNITURE_TAGS = set("head nav footer aside form button dialog menu fieldset".split())
_FURNITURE_ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
_FURNITURE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices notification popup modal overlay newsletter subscribe subscription sidebar menu nav navbar navigation breadcrumb "
    "breadcrumbs footer masthead topbar comment comments commentlist respond reply replies disqus share sharing social related "
    "recommended recommendations widget toolbar pagination pager login signup search skip copyright legal disclaimer".split()
)
_COMMENT_WORDS = set("comment comments commentlist respond reply replies disqus".split())


def _kind(tag: str, attributes: str, inside: bool) -> tuple[bool, bool]:
    """(furniture, comments) of an element."""
    if tag in _FURNITURE_TAGS or tag == "header" and not inside:
        return True, False
    if not attributes or tag in ("body", "html", "article", "main") and "comment" not in attributes:
        return False, False
    have = {m[0].lower(): (m[1] or m[2] or m[3]).lower() for m in _ATTRIBUTE.findall(attributes)}
    words = set(re.findall(r"[a-z0-9]+", f"{have.get('class', '')} {have.get('id', '')}"))
    comments = bool(words & _COMMENT_WORDS)
    hidden = have.get("aria-hidden") == "true" or "display:none" in have.get("style", "").replace(" ", "") or re.search(r"\shidden(?:\s|/|=|$)", attributes) is not None
    furniture = bool(words & _FURNITURE_WORDS) or "header" in words and not inside or have.get("role") in _FURNITURE_ROLES or hidden
    return furniture or comments, comments


class _Tags:
    """The tags of a page in order, each found in time that grows with its length."""

    def __init__(self, page: str):
        self.page = page
        self.lost: set[str] = set()  # signs that do not come again

    def find(self, sign: str, at: int) -> int:
        if sign in self.lost:
            return -1
        found = self.page.find(sign, at)
        if found < 0:
            self.lost.add(sign)
        return found

    def _end(self, at: int) -> int:
        """Where the tag that starts before ``at`` ends: at the first > outside quotes, or at the first one at all; -1 without one."""
        if self.find(">", at) < 0:
            return -1
        spot = at
        for _ in range(QUOTES):
            stop = _STOP.search(self.page, spot)
            if not stop:
                break
            if stop[0] == ">":
                return stop.start()
            closed = self.find(stop[0], stop.end())
            spot = closed + 1 if closed >= 0 else stop.end()
        return self.page.find(">", at)

    def next(self, at: int) -> tuple[int, int, str, bool, str] | None:
        """Start, end, name, whether an end tag, and attributes of the next tag or comment (name '')."""
        page = self.page
        while (start := self.find("<", at)) >= 0:
            if page.startswith("<!--", start):
                end = self.find("-->", start + 4)
                return start, len(page) if end < 0 else end + 3, "", False, ""
            if page.startswith(("<!", "<?"), start):
                end = self.find(">", start)
                return start, len(page) if end < 0 else end + 1, "", False, ""
            closing = page.startswith("/", start + 1)
            name = _NAME.match(page, start + 1 + closing)
            if name:
                end = self._end(name.end())
                if end >= 0:
                    return start, end + 1, name[0].lower(), closing, page[name.end() : end]
                if self.find("<", start + 1) < 0:  # a tag that the page breaks off
                    return start, len(page), "", False, ""
            at = start + 1
        return None


class _Open:
    """The open elements, with what is asked about them at hand."""

    def __init__(self):
        self.stack: list[tuple[str, int, bool]] = []  # tag, furniture, comments
        self.at: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.furniture: list[int] = []
        self.articles: list[int] = []
        self.comments = 0

    def push(self, tag: str, furniture: int, comments: bool) -> None:
        n = len(self.stack)
        self.stack.append((tag, furniture, comments))
        self.at.setdefault(tag, []).append(n)
        if tag not in _INLINE:
            self.blocks.append(n)
        if furniture:
            self.furniture.append(n)
        if tag in ("article", "main"):
            self.articles.append(n)
        self.comments += comments

    def cut(self, n: int) -> None:
        """Close all elements from the n-th on."""
        while len(self.stack) > n:
            tag, _, comments = self.stack.pop()
            self.at[tag].pop()
            for held in (self.blocks, self.furniture, self.articles):
                if held and held[-1] == len(self.stack):
                    held.pop()
            self.comments -= comments

    def last(self, tag: str) -> int:
        return self.at[tag][-1] if self.at.get(tag) else -1


def outline(page: str) -> list[tuple[str, int, int]]:
    """The text lines of a page, one for each block element: text, what it is, and the number of the article it is in (0: none).

    Unclosed elements end with what encloses them.  An article inside a piece of furniture belongs to it, unless
    the page leaves elements of that name unclosed: then the article ends it.
    """
    found: list[tuple[str, int, int]] = []
    parts: list[str] = []
    open_, tags, at, number, inside = _Open(), _Tags(page), 0, 0, 0
    closed = page.lower()

    def unclosed(tag: str) -> bool:
        return len(re.findall(rf"<{re.escape(tag)}\b", closed)) > closed.count(f"</{tag}")

    known: dict[str, bool] = {}

    def flush() -> None:
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            paragraph = any(t in _PARAGRAPHS for t, _, _ in reversed(open_.stack[-4:]))
            kind = FURNITURE if open_.furniture else ARTICLE if open_.articles and paragraph else OPEN
            found.append((text, kind, inside if open_.articles else 0))

    while (tag_ := tags.next(at)) is not None:
        start, end, tag, closing, attributes = tag_
        if start > at:
            parts.append(html.unescape(page[at:start]))
        at = end
        if not tag:
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in _RAW:
            if not closing and not attributes.endswith("/"):
                over = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = over.end() if over else len(page)
            continue
        inline = tag in _INLINE
        if not inline:
            flush()
        if tag in _VOID:
            continue
        if closing:
            spot = open_.last(tag)
            # An inline end tag does not close blocks.
            if spot >= 0 and not (inline and open_.blocks and open_.blocks[-1] > spot):
                open_.cut(spot)
            continue
        if attributes.endswith("/") and inline:
            continue
        if closes := _CLOSED_BY_NEXT.get(tag):
            if open_.blocks and open_.stack[open_.blocks[-1]][0] in closes:
                open_.cut(open_.blocks[-1])
        if tag in ("article", "main"):
            if open_.furniture and not open_.comments:
                outer = open_.stack[open_.furniture[0]][0]
                if outer not in known:
                    known[outer] = unclosed(outer)
                if known[outer]:
                    open_.cut(open_.furniture[0])
            if not open_.articles:
                number += 1
                inside = number
        furniture, comments = _kind(tag, attributes, bool(open_.articles))
        open_.push(tag, int(furniture), comments)
    parts.append(html.unescape(page[at:]))
    flush()
    return found


def chosen(found: list[tuple[str, int, int]]) -> list[bool]:
    """Which lines are main text: those of the article with most text, or, where there is more outside of articles, those."""
    size: dict[int, int] = {}
    for text, kind, article in found:
        if kind != FURNITURE:
            size[article] = size.get(article, 0) + len(text)
    outside = size.pop(0, 0)
    best = max(size, key=lambda n: (size[n], -n), default=0)
    best = best if size.get(best, 0) >= outside else 0
    return [kind != FURNITURE and article == best for _, kind, article in found]


def lines(page: str) -> list[tuple[str, int]]:
    """The text lines of a page with what each is by its markup alone."""
    found = outline(page)
    return [(text, kind if stays else FURNITURE) for (text, kind, _), stays in zip(found, chosen(found), strict=True)]


def shared(page: list[str], other: list[str], most: int = 1 << 25) -> set[int]:
    """Which lines of ``page`` a longest common subsequence with ``other`` matches.

    Rows of the usual table are kept as bits, of which at most ``most`` at once: a longer page is
    cut in two where the halves' subsequences are longest together.
    """
    a, b = 0, 0
    while a < min(len(page), len(other)) and page[a] == other[a]:
        a += 1
    while b < min(len(page), len(other)) - a and page[-1 - b] == other[-1 - b]:
        b += 1
    matched = set(range(a)) | set(range(len(page) - b, len(page)))
    waiting = [(a, len(page) - b, a, len(other) - b)]
    while waiting:
        i0, i1, j0, j1 = waiting.pop()
        if i0 >= i1 or j0 >= j1:
            continue
        if (i1 - i0) * (j1 - j0) <= most or i1 - i0 == 1:
            matched |= _traced(page, other, i0, i1, j0, j1)
        else:
            middle = (i0 + i1) // 2
            left = _lengths(page[i0:middle], other[j0:j1])
            right = _lengths(page[middle:i1][::-1], other[j0:j1][::-1])[::-1]
            cut = max(range(j1 - j0 + 1), key=lambda j: left[j] + right[j])
            waiting += [(i0, middle, j0, j0 + cut), (middle, i1, j0 + cut, j1)]
    return matched


def _rows(page: list[str], other: list[str]):
    """For each line of ``page``: bits, 0 where the subsequence gets longer with the next line of ``other``."""
    spots: dict[str, int] = {}
    for j, line in enumerate(other):
        spots[line] = spots.get(line, 0) | 1 << j
    full = row = (1 << len(other)) - 1
    for line in page:
        same = row & spots.get(line, 0)
        row = ((row + same) | (row - same)) & full
        yield row


def _lengths(page: list[str], other: list[str]) -> list[int]:
    row = (1 << len(other)) - 1
    for row in _rows(page, other):  # noqa: B007
        pass
    total = [0]
    for bit in reversed(bin(row)[2:].rjust(len(other), "0")):
        total.append(total[-1] + (bit == "0"))
    return total


def _traced(page: list[str], other: list[str], i0: int, i1: int, j0: int, j1: int) -> set[int]:
    rows = list(_rows(page[i0:i1], other[j0:j1]))
    i, j, found = len(rows), j1 - j0, set()
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if not i or rows[i - 1] >> (j - 1) & 1:
                found.add(i0 + i)
                j -= 1
    return found


def main_text(found: list[tuple[str, int, int]], neighbours: list[list[str]]) -> str:
    """What stays of a page's lines beside the lines of its neighbours.

    A line outside paragraphs of an article goes if a neighbour shares it; such a paragraph if two do and it stands at the
    head or foot of its article, as notices do, for articles quote the same passages now and then.  A neighbour
    that shares nearly all text is a version of the page and says nothing.
    """
    texts = [text for text, _, _ in found]
    size = sum(len(text) for text, kind, _ in found if kind != FURNITURE)
    times = [0] * len(found)
    for other in neighbours:
        same = shared(texts, other)
        if sum(len(texts[i]) for i in same if found[i][1] != FURNITURE) <= SAME_PAGE * size:
            for i in same:
                times[i] += 1
    kept: dict[int, list[int]] = {}  # of each article the paragraphs that do not stand in both neighbours
    for i, (_, kind, article) in enumerate(found):
        if kind == ARTICLE and times[i] < 2:
            kept.setdefault(article, []).append(i)

    def goes(i: int, kind: int, article: int) -> bool:
        return times[i] > 0 if kind != ARTICLE else times[i] > 1 and article in kept and not kept[article][0] < i < kept[article][-1]

    left = [(text, FURNITURE if goes(i, kind, article) else kind, article) for i, (text, kind, article) in enumerate(found)]
    return "\n\n".join(text for (text, _, _), stays in zip(left, chosen(left), strict=True) if stays)


def beside(found: list[list[str]], hosts: list[str]) -> list[list[int]]:
    """For each page of a run in order of host and path the places of its two neighbours: the nearest other text on either side.

    Pages without text and copies of the page are passed over; at the first (last) page of a host both
    neighbours come from behind (ahead).
    """
    def walk(order: list[int]) -> list[list[int]]:
        """The last two different texts of the same host before each page."""
        out: list[list[int]] = [[] for _ in order]
        seen: list[int] = []
        for n, i in enumerate(order):
            if n and hosts[i] != hosts[order[n - 1]]:
                seen = []
            out[i] = [j for j in reversed(seen) if found[j] != found[i]][:2]
            if found[i]:
                seen = [j for j in seen if found[j] != found[i]][-2:] + [i]
        return out

    before, behind = walk(list(range(len(found)))), walk(list(range(len(found)))[::-1])
    return [b[:1] + a[:1] if a and b else b + a for b, a in zip(before, behind, strict=True)]


def _place(url: Column) -> list[Column]:
    host = F.lower(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")))
    path = F.regexp_replace(F.coalesce(F.regexp_extract(url, _URL, 2), F.lit("")), r"(?:\.html?)?/*$", "")
    return [host, path]


def extract(pages: DataFrame) -> DataFrame:
    """Add ``text``, the main text, and ``n_chars``, its code points, to each page (replacing such columns).

    Pages are sorted by host and path, in ranges that split a host of any size, and each is aligned with its
    neighbours in that order (see ``beside``) by longest common subsequences of their lines.  What a neighbour
    shares is deleted, paragraphs of an article only where both do, and so is what the markup names as
    furniture (menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, comments).  Of what is left
    the article with most text is taken, or the text outside of articles if that is more.

    Blocks are joined by an empty line; white space in a block is one space.  Null, empty and
    text-free html gives an empty text.  Pages without a url are one host.  Rows that repeat a page stay and get the
    same text; pages of one path follow each other by page_id.  Very long pages are read in time that grows with their length.
    At the border of a range the neighbours lie on one side, so that there a paragraph may be judged by other pages.
    """
    pages = pages.drop("text", "n_chars")
    names = pages.columns
    html_, host_, path_ = (fresh(pages, f"__{n}") for n in ("html", "host", "path"))
    host, path = _place(F.col("url"))

    def squeeze(batches):
        pack = zstandard.ZstdCompressor(level=3).compress
        for part in small_batches(batches, "html", 1 << 22):
            packed = [None if page is None else pack(page) for page in part.column("html").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(part.column(n) for n in part.schema.names if n != "html"), pa.array(packed, pa.binary())], [*(n for n in part.schema.names if n != "html"), html_])

    # The pages travel compressed: they are all that the shuffle moves.
    kept = StructType([*[f for f in pages.schema.fields if f.name != "html"], StructField(html_, BinaryType())])
    rows = pages.mapInArrow(squeeze, kept).select("*", host.alias(host_), path.alias(path_))
    order = [host_, path_, "page_id"]
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def finish(batches):
        unpack = zstandard.ZstdDecompressor().decompress

        def read(part: pa.RecordBatch):
            whole = [None if page is None else unpack(page).decode("utf-8", "replace") for page in part.column(html_).to_pylist()]
            found = [outline(page or "") for page in whole]
            return part, whole, found, [[text for text, _, _ in f] for f in found], part.column(host_).to_pylist()

        def judged(held, ahead: list[tuple], behind: list[tuple]) -> pa.RecordBatch:
            part, whole, found, texts, hosts = held
            every, n = [*ahead, *zip(texts, hosts, strict=True), *behind], len(ahead)
            places = beside([t for t, _ in every], [h for _, h in every])[n : n + len(found)]
            out = [main_text(f, [every[j][0] for j in near]) for f, near in zip(found, places, strict=True)]
            columns = [pa.array(whole, pa.string()) if c == "html" else part.column(c) for c in names] + [pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, [*names, "text", "n_chars"])

        held, ahead = None, []
        for part in small_batches(batches, html_, 1 << 19):
            new = read(part)
            if held:
                yield judged(held, ahead, _few(zip(new[3], new[4], strict=True)))
                ahead = _few([*zip(held[3][::-1], held[4][::-1], strict=True), *ahead[::-1]])[::-1]
            held = new
        if held:
            yield judged(held, ahead, [])

    return sorted_.mapInArrow(finish, widened(pages, "text string, n_chars long"))


def _few(every) -> list[tuple[list[str], str]]:
    """The first three different texts of the first host, as (lines, host)."""
    out: list[tuple[list[str], str]] = []
    for texts, host in every:
        if len(out) == 3 or out and host != out[0][1]:
            break
        if texts and all(texts != t for t, _ in out):
            out.append((texts, host))
    return out
