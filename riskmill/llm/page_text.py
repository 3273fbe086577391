"""Main text of web pages by nearest-URL page differencing, checked against the page's own marks.

Pages of one host are put in the order of their URL paths, so neighbours come from one
template. The text lines of every page are aligned with those of both neighbours by a longest common subsequence. On a page without
marks, lines shared with a neighbour are template. On a page that marks articles, differencing decides which
of the marked elements are the page's own: one that it shares line by line with every neighbour, beside other text
that differs, is template. Differencing alone cannot be right where menus and adverts change from page to
page or where one article stands at two addresses. Therefore a check of the marks follows: an element with a line of its own
is kept whole, and so are all elements of a page that has no line of its own; lines outside of marked elements, and
inside menus, footers, adverts and the like, are dropped.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from math import isqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from riskmill.llm.chunks import slices
from riskmill.llm.common import join_sized, materialize, plain, running_start

#: Elements without text of their own, or whose text is not content.
DROPPED = frozenset(
    "head nav header footer aside form script style noscript template iframe svg math canvas object embed audio video "
    "button select textarea dialog menu datalist map applet frameset".split()
)
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hr html legend li main nav ol p pre section summary table tbody tfoot thead tr ul caption".split()
)
#: Elements that an open paragraph cannot contain, or that close one of their own kind.
CLOSED_BY_OWN_KIND = frozenset("p li dt dd tr td th option".split())
NEVER_DROPPED = frozenset("html body main h1 h2 h3 h4 h5 h6 p".split())
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr notice notices banner popup modal newsletter "
    "subscribe comment comments disqus respond share sharing social related widget toolbar login search complementary "
    "contentinfo alert dialog".split()
)
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*+)(?:>|\Z)""", re.S
)
NAMING = re.compile(r"""(?:^|\s)(class|id|role|itemprop|hidden|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
MAIN, LOOSE = 1, 0
#: What a tag marks: nothing, the main area of the page, an article.
AREA, ARTICLE = 1, 2
MARKING = {"main": AREA, "article": ARTICLE}


def _kind(name: str, attributes: str, inside: bool = False) -> tuple[bool, int]:
    """(dropped, marked) for an opening tag. ``inside`` a marked article only whole class names count, and its header stays."""
    dropped, marked = name in DROPPED and not (inside and name == "header"), MARKING.get(name, 0)
    if attributes:
        for key, value in NAMING.findall(attributes):
            key, value = key.lower(), value.strip("\"'").lower()
            if key == "hidden" or (key == "aria-hidden" and value == "true"):
                dropped = name not in ("html", "body") or dropped
            elif name in NEVER_DROPPED:
                continue
            elif key == "itemprop" or key == "role":
                marked = max(marked, ARTICLE if value == "articlebody" else MARKING.get(value, 0))
                dropped = dropped or value in MARKS or value == "comment"
            elif key in ("class", "id"):
                dropped = dropped or not MARKS.isdisjoint(value.split() if inside else re.split("[^a-z]+", value))
    return dropped, marked


def page_lines(source: str) -> list[tuple[str, int]]:
    """(line, MAIN or LOOSE) of every block outside dropped elements, in page order."""
    return [(line, MAIN if element else LOOSE) for line, element in page_blocks(source)]


def page_blocks(source: str) -> list[tuple[str, int]]:
    """(line, number of its marked element or 0) of every block outside dropped elements, in page order.

    What an article holds belongs to it; articles inside a main area are elements of their own, and the rest of the area is one.
    """
    lines, held, stack = [], [], []
    articles = set()
    dropped = element = elements = at = 0

    def close_line(region: int) -> None:
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            held.clear()
            if text:
                lines.append((text, region))

    def pop(depth: int) -> None:
        nonlocal dropped, element
        for _, was_dropped, outer in reversed(stack[depth:]):
            dropped -= was_dropped
            element = outer
        del stack[depth:]

    while True:
        token = TOKEN.search(source, at)
        if not dropped:
            held.append(source[at : token.start() if token else len(source)])
        if token is None:
            break
        at = token.end()
        name = (token[2] or "").lower()
        if not name:
            continue
        if name in BLOCKS:
            close_line(element)
        elif name in ("br", "td", "th"):
            held.append(" ")
        if token[1]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if depth is not None:
                pop(depth)
            continue
        if name in CLOSED_BY_OWN_KIND or (name in BLOCKS and stack and stack[-1][0] == "p"):
            wanted = name if name in CLOSED_BY_OWN_KIND else "p"
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == wanted:
                    pop(i)
                    break
                if stack[i][0] in BLOCKS:
                    break
        if name in VOID or token[3].endswith("/") and name in ("svg", "path"):
            continue
        is_dropped, marked = _kind(name, token[3], element > 0)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?|\Z", re.I).search(source, at)
            at = end.end()
            continue
        stack.append((name, is_dropped, element))
        dropped += is_dropped
        if marked and element not in articles and (not element or marked == ARTICLE):
            elements += 1
            element = elements
            if marked == ARTICLE:
                articles.add(element)
    close_line(element)
    return lines


def shared_places(a: list, b: list) -> list[int]:
    """Places in ``a`` of a longest common subsequence of ``a`` and ``b``."""
    return [i for i, _ in shared_pairs(a, b)]


#: Equal pairs of lines beyond which the subsequence is found by rows of bits instead of by pairs.
DENSE = 2_000_000


def shared_pairs(a: list, b: list) -> list[tuple[int, int]]:
    """Places in ``a`` and in ``b`` of a longest common subsequence of both.

    Matching pairs are visited in order of ``a``; the ends of the best chains of each length are
    kept in a sorted list, and links back give one longest chain.
    """
    where: dict = {}
    for j, line in enumerate(b):
        where.setdefault(line, []).append(j)
    if sum(len(where.get(line, ())) for line in a) > DENSE:
        return _dense_pairs(a, len(b), where)
    ends: list[int] = []
    links: list[tuple | None] = []
    for i, line in enumerate(a):
        for j in reversed(where.get(line, ())):
            k = bisect_left(ends, j)
            link = ((i, j), links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            elif j < ends[k]:
                ends[k], links[k] = j, link
    chain = links[-1] if links else None
    places = []
    while chain:
        places.append(chain[0])
        chain = chain[1]
    return places[::-1]


def _dense_pairs(a: list, size: int, where: dict) -> list[tuple[int, int]]:
    """``shared_pairs`` for lists with very many equal pairs, ``where`` being the places of lines in the second of ``size``.

    Rows of the table of lengths are bits of long integers: bit j of a row is 0 where place j makes the subsequence longer.
    A row in every square root of rows is kept, the others are computed again on the way back.
    """
    every, step, often = (1 << size) - 1, isqrt(len(a)) + 1, {}

    def matches(line) -> int:
        if line in often:
            return often[line]
        bits = bytearray(size // 8 + 1)
        for j in where.get(line, ()):
            bits[j >> 3] |= 1 << (j & 7)
        found = int.from_bytes(bits, "little")
        if len(where.get(line, ())) > 64:
            often[line] = found
        return found

    def rows(row: int, lines: Sequence) -> Iterator[int]:
        for line in lines:
            same = row & matches(line)
            row = ((row + same) | (row - same)) & every
            yield row

    kept = [every]
    for at in range(0, len(a), step):
        row = kept[-1]
        for row in rows(row, a[at : at + step]):
            pass
        kept.append(row)
    pairs, j = [], size - 1
    for block in range(len(kept) - 2, -1, -1):
        first = block * step
        table = [kept[block], *rows(kept[block], a[first : first + step])]
        table = [row.to_bytes(size // 8 + 1, "little") for row in table]
        for i in range(len(table) - 1, 0, -1):
            while j >= 0 and table[i][j >> 3] >> (j & 7) & 1:
                j -= 1
            if j < 0:
                return pairs[::-1]
            if table[i - 1][j >> 3] >> (j & 7) & 1:  # longer by this row: a match
                pairs.append((first + i - 1, j))
                j -= 1
    return pairs[::-1]


def kept_lines(elements: Sequence[int], neighbours: Sequence[tuple[set[int], bool]]) -> list[bool]:
    """Whether each line of a page is text, given the marked element of every line and, per neighbour, the places
    of the lines that it shares and whether it has text beside them."""
    numbers = set(elements) - {0}
    if not numbers:
        shared = set().union(*(places for places, _ in neighbours))
        return [i not in shared for i in range(len(elements))]
    template = set(numbers) if neighbours else set()
    for places, has_own in neighbours:
        template -= {e for i, e in enumerate(elements) if i not in places} if has_own else numbers
    if template == numbers:  # the article stands at the neighbouring addresses too
        template = set()
    return [e != 0 and e not in template for e in elements]


URL = re.compile(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://)?([^/?#]*)([^?#]*)(.*)", re.S)


def address(url: str | None) -> tuple[str, str]:
    """(host, path and the rest) of a URL; a URL without host has the empty one."""
    host, path, rest = URL.fullmatch(url or "").groups()
    return host.lower(), path + rest


SCHEMA = "page_id bigint, url string, lines array<string>, elements array<int>, host string, path string, mark string, form string, hashes array<bigint>"
#: Ranks that share a bucket; each also holds its two outer neighbours.
BUCKET = 1024


def line_hash(line: str) -> int:
    return xxhash.xxh64_intdigest(line) - (1 << 63)


def _form(elements: Sequence[int]) -> str:
    return xxhash.xxh3_128_hexdigest(np.array(elements, "<i4").tobytes())


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("lines", pa.list_(pa.string())), ("elements", pa.list_(pa.int32())),
                        ("host", pa.string()), ("path", pa.string()), ("mark", pa.string()), ("form", pa.string()), ("hashes", pa.list_(pa.int64()))])
    for batch in batches:
        for part in slices(batch, 2, 4_000_000):
            rows = []
            for page, url, source in zip(*(c.to_pylist() for c in part.columns)):
                host, path = address(url)
                found = page_blocks(source or "")
                elements = [e for _, e in found]
                marked = any(elements)
                hashes = [line_hash(t) for t, _ in found]
                # Null where the marks rule a line out, whatever its neighbours have.
                lines = [t if e or not marked else None for t, e in found]
                rows.append({"page_id": page, "url": url, "lines": lines, "elements": elements, "host": host, "path": path,
                             "mark": xxhash.xxh3_128_hexdigest(np.array(hashes, "<i8").tobytes()), "form": _form(elements), "hashes": hashes})
            yield pa.RecordBatch.from_pylist(rows, schema)


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        many = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(many, part, np.int32)), pa.array(np.arange(at, at + many)), *batch.columns],
            ["part", "place", *batch.schema.names],
        )
        at += many


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which lines of a version stay by its neighbours on the same host, for each of its forms that loses some."""
    schema = pa.schema([("host", pa.string()), ("mark", pa.string()), ("form", pa.string()), ("size", pa.int64()), ("kept", pa.list_(pa.bool_()))])
    for batch in batches:
        rows = []
        for i in range(batch.num_rows):
            r = {name: column[i].as_py() for name, column in zip(batch.schema.names, batch.columns)}
            neighbours = []
            for side in ("before", "after"):
                if r[side] is None or r[f"host_{side}"] != r["host"]:
                    continue
                pairs = shared_pairs(r["hashes"], r[side])
                elements = max(r[f"forms_{side}"])
                marked, there = any(elements), {j for _, j in pairs}
                has_own = any((e or not marked) and j not in there for j, e in enumerate(elements))
                neighbours.append(({i for i, _ in pairs}, has_own))
            for elements in r["forms"]:
                kept = kept_lines(elements, neighbours)
                if kept != kept_lines(elements, []):
                    rows.append({"host": r["host"], "mark": r["mark"], "form": _form(elements), "size": r["size"], "kept": kept})
        yield pa.RecordBatch.from_pylist(rows, schema)


def shared_lines(versions: DataFrame) -> DataFrame:
    """(host, mark, form, size, kept) of ``versions`` (host, mark, path, page_id, hashes, size, forms): the lines that
    stay, where the neighbours take some.

    Versions are ranked by host, path and page_id over range partitions, and neighbours meet
    in buckets of consecutive ranks, so a host may hold any share of all pages.
    """
    key = ["host", "path", "page_id", "mark"]
    ordered = versions.repartitionByRange(*key).sortWithinPartitions(*key)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in versions.schema)
    numbered = materialize(ordered.mapInArrow(_number, f"part int, place bigint, {kinds}"), "ranked-versions")
    starts = running_start(numbered.groupBy("part").agg(F.count("*").alias("n")), ["part"], "n", "first")
    ranked = numbered.join(F.broadcast(starts), "part").withColumn("rank", F.col("first") + F.col("place"))
    own, at = F.floor(F.col("rank") / BUCKET), F.col("rank") % BUCKET
    buckets = F.array_compact(F.array(own, F.when(at == 0, own - 1), F.when(at == BUCKET - 1, own + 1)))
    dealt = ranked.withColumn("bucket", F.explode(buckets))
    window = Window.partitionBy("bucket").orderBy("rank")
    near = {"before": F.lag, "after": F.lead}
    paired = dealt.select("*", *(step("hashes").over(window).alias(name) for name, step in near.items()),
                          *(step(c).over(window).alias(f"{c}_{name}") for c in ("host", "forms") for name, step in near.items()))
    wanted = paired.filter(F.col("bucket") == own)
    wanted = wanted.select("host", "mark", "size", "hashes", "forms", *(c for name in near for c in (name, f"host_{name}", f"forms_{name}")))
    return wanted.mapInArrow(_decide, "host string, mark string, form string, size bigint, kept array<boolean>")


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html).

    Pages of one host with the same lines are copies: they are one version, at the smallest of their addresses,
    so they never delete each other's lines. All versions are compared with their neighbours in the order of paths. Texts are
    written once where they were read; only hashes of lines are dealt out, and come back for the pages that
    lose lines by them. A null html is empty; pages with a null url form the
    host "". Pages without another version on their host keep all unmarked lines. Repeated rows stay.
    """
    rows = plain(pages, "page_id", "url", "html")
    found = materialize(rows.mapInArrow(_extract, SCHEMA), "page-lines")
    first = F.min(F.struct("path", "page_id"))
    versions = found.groupBy("host", "mark").agg(
        first.alias("at"), F.first("hashes").alias("hashes"), F.count("*").alias("size"), F.collect_set("elements").alias("forms"))
    versions = materialize(versions.select("host", "mark", "at.path", "at.page_id", "hashes", "size", "forms"), "versions")
    losses = materialize(shared_lines(versions), "line-losses")
    texts = found.select("page_id", "url", "lines", "host", "mark", "form")
    decided = join_sized(texts, losses, ["host", "mark", "form"], "size")
    left = F.when(F.col("kept").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda line, i: F.get("kept", i)))
    out = decided.select("page_id", "url", F.array_join(left, "\n").alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
