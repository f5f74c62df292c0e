"""Main text of web pages: marked structure, and a suffix array over the pages of each host for what is unmarked.

A page is cut into blocks at its block-level tags. Containers made for something else than the article (menus,
headers, footers, sidebars, notices, adverts, forms, comments, by tag, role, class or id) mark their blocks. An
article or main element marks the blocks of its flow: its own, its main heading and those of the kind of box (divisions
of one place, tag and class) that holds most of its words. Two sorts of blocks are undecided: those of an article's
other boxes, and all unmarked blocks of a page without an article. They are decided by the host: the words that are
asked about are concatenated per page, all pages' suffixes of a host are sorted, and what neighbouring suffixes of
different pages share for at least eight words is boilerplate. Covered words leave the blocks of pages without an
article, unique runs stay; a block of an article's box leaves if it is covered whole.

An article's boxes are compared with other articles' boxes only, since a sidebar also shows other articles' leads.
There a repeat is boilerplate if the eight words before the boxes differ somewhere and so do the eight behind them;
where both or one of them are alike on all pages, an article is shown twice.

The marks of the flow come first because repeats alone cannot give the contract's text: a menu on a host's only page
repeats nowhere, an article that a host shows on several pages repeats everywhere, and lines of an article's flow
also stand in adverts and footers of its host.

On Spark: suffixes are sorted by range over (host, first eight words, page), so that a host with a third of all
pages, or one passage on all of them, is spread over many tasks. Only suffixes cut at eight words are needed:
a longer repeat is a chain of them. Equal streams of a host are one page. Neighbours are compared inside each
range, and the first and last suffix of each range again among themselves. Pages without undecided blocks never
leave the narrow pass; for the others a table of covered words is joined by the page's content.

Defined results: null and empty html give an empty text; a null or odd url's pages share an empty host; repeated
rows are rows like others and get the same text; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creamline.llm.common import map_batches, stored, table

# Elements of HTML by what they do to text.
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary"
    " table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SILENT = frozenset(
    "head title script style noscript template iframe object svg math canvas audio video map select textarea button"
    " datalist".split()
)
_ASIDE = frozenset("nav header footer aside form menu dialog search".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
#: Words in classes and ids of containers that hold something else than the article.
_MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent"
    " gdpr notice notices alert alerts popup modal overlay nav navbar navigation menu menus breadcrumb breadcrumbs header"
    " masthead footer foot sidebar side aside widget widgets related recommended share sharing social newsletter subscribe"
    " subscription signup login form comment comments commentlist disqus respond replies pagination pager skip toolbar"
    " copyright".split()
)
_ARTICLES = ("article", "main")
#: Elements that set a part of an article off from its flow.
_BOXES = frozenset(("article", "main", "div", "section", "details"))
_IMPLIED = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_WORDS = re.compile(r"[^\W_]+")

MARKED, OPEN, ARTICLE, BOX = 0, 1, 2, 3
#: Shortest repeat that counts, in words.
LEAST = 8


class _Blocks(HTMLParser):
    """(text, mark, kind of box) of a page's blocks in order; the box is 0 outside articles and in main headings."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks, self.parts, self.stack, self.aside, self.article, self.silent = [], [], [], 0, 0, 0
        self.box, self.heading, self.kinds, self.own = 0, 0, {}, {0}

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            self.parts = []
            if text:
                mark = MARKED if self.aside else ARTICLE if self.article else OPEN
                self.blocks.append((text, mark, 0 if self.heading else self.box))

    def handle_starttag(self, tag, attrs):
        if tag in _BLOCKS:
            self.flush()
        elif tag == "br":
            self.parts.append(" ")
        if tag in _VOID:
            return
        if tag in _IMPLIED and self.stack:
            self._close_implied(_IMPLIED[tag])
        aside = tag not in ("html", "body") and tag not in _SILENT and _set_aside(tag, attrs)
        if tag == "header" and self.article and not self.aside:
            aside = _named(attrs)  # an article's own heading is part of it
        article = tag in _ARTICLES or dict(attrs).get("role") in _ARTICLES
        silent = tag in _SILENT
        self.stack.append((tag, aside, article, silent, self.box))
        self.aside += aside
        self.article += article
        self.silent += silent
        self.heading += tag == "h1"
        if article or self.article and tag in _BOXES:
            self.box = self.kinds.setdefault((self.box, tag, dict(attrs).get("class")), len(self.kinds) + 1)
            if article:
                self.own.add(self.box)

    def handle_endtag(self, tag):
        if tag in _BLOCKS:
            self.flush()
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at][0] == tag:
                self._drop(at)
                return

    def handle_startendtag(self, tag, attrs):
        if tag in _BLOCKS:
            self.flush()
        elif tag == "br":
            self.parts.append(" ")

    def handle_data(self, data):
        if not self.silent:
            self.parts.append(data)

    def close(self):
        super().close()
        self.flush()

    def _drop(self, at: int) -> None:
        for tag, aside, article, silent, _ in self.stack[at:]:
            self.aside -= aside
            self.article -= article
            self.silent -= silent
            self.heading -= tag == "h1"
        self.box = self.stack[at][4]
        del self.stack[at:]

    def _close_implied(self, tags) -> None:
        """A new paragraph, item or cell ends an open one of its own list or table; text styles do not hold it open."""
        for at in range(len(self.stack) - 1, -1, -1):
            name = self.stack[at][0]
            if name in tags:
                self._drop(at)
                return
            if name in _BLOCKS:
                return


def _named(attrs) -> bool:
    for name, value in attrs:
        if name in ("class", "id") and value:
            words = re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value).lower())
            if not _MARKS.isdisjoint(words):
                return True
        elif name == "role" and value in _ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return True
    return False


def _set_aside(tag: str, attrs) -> bool:
    return tag in _ASIDE or bool(attrs) and _named(attrs)


def blocks_of(html: str) -> list[tuple[str, int]]:
    """(text, mark) of each block: of an article's flow, of its other boxes, of something else, or open."""
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    size = {}
    for text, mark, box in parser.blocks:
        if mark == ARTICLE and box:
            size[box] = size.get(box, 0) + text.count(" ") + 1
    flow = set(parser.own)
    if size:
        largest = max(size, key=size.get)
        if 2 * size[largest] > sum(size.values()) or flow.isdisjoint(size):
            flow.add(largest)
    return [(text, BOX if mark == ARTICLE and box not in flow else mark) for text, mark, box in parser.blocks]


def main_text(blocks: list[tuple[str, int]], hits: list[int] = ()) -> str:
    """The text of the article's blocks, or of the open blocks where none is marked, less what repeats cover.

    ``hits`` are the places among the words asked about at which a repeat of LEAST words begins.
    """
    marked = _marked(blocks)
    covered = _covered(blocks, hits)
    out = []
    for (text, mark), own in zip(blocks, covered, strict=True):
        if mark == MARKED or mark == OPEN and marked:
            continue
        if mark == ARTICLE or not any(own):
            out.append(text)
        elif not all(own):
            out.append(text if mark == BOX else _unique_runs(text, [m.span() for m in _WORDS.finditer(text)], own))
    return "\n\n".join(text for text in out if text)


def _marked(blocks: list[tuple[str, int]]) -> bool:
    return any(mark == ARTICLE for _, mark in blocks)


def _covered(blocks: list[tuple[str, int]], hits: list[int]) -> list[bytes]:
    """Of each block, a flag per word: whether a repeat covers it. Only words asked about have places."""
    if not hits:
        return [b""] * len(blocks)
    least = BOX if _marked(blocks) else MARKED
    sizes = [len(_WORDS.findall(text)) if mark >= least else 0 for text, mark in blocks]
    covered = bytearray(sum(sizes))
    for at in hits:
        covered[at : at + LEAST] = b"\1" * LEAST
    ends = np.cumsum(sizes).tolist()
    return [bytes(covered[end - n : end]) for n, end in zip(sizes, ends, strict=True)]


def _unique_runs(text: str, words: list[tuple[int, int]], covered: bytearray) -> str:
    """The text from each uncovered word to the next word, and what stands before the first one."""
    starts = [first for first, _ in words] + [len(text)]
    kept = [text[a:b] for a, b, gone in zip(starts, starts[1:], covered, strict=False) if not gone]
    return " ".join(((text[: starts[0]] if not covered[0] else "") + "".join(kept)).split())


def _host(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _digests(words: list[str]) -> bytes:
    return np.array([xxhash.xxh64_intdigest(w.encode()) for w in words], dtype=">u8").tobytes()


def _stream(blocks: list[tuple[str, int]]) -> bytes:
    """64-bit digests of the words outside articles."""
    return _digests([w for text, mark in blocks if mark < ARTICLE for w in _WORDS.findall(text.lower())])


def _box_runs(blocks: list[tuple[str, int]]) -> tuple[list[str], list[dict]]:
    """The words of an article's boxes, and their runs without flow between them, with what stands before and behind.

    Where nothing stands on one side, as at an article's end, the other side counts for both.
    """
    inside = [(w, mark == BOX) for text, mark in blocks if mark >= ARTICLE for w in _WORDS.findall(text.lower())]
    edges = [i for i in range(len(inside) + 1) if (0 < i and inside[i - 1][1]) != (i < len(inside) and inside[i][1])]
    runs, at = [], 0
    for first, end in zip(edges[::2], edges[1::2], strict=True):
        sides = [" ".join(w for w, _ in inside[a:b]) for a, b in ((max(first - LEAST, 0), first), (end, end + LEAST))]
        left, right = (xxhash.xxh64_intdigest(side.encode()) >> 1 for side in (sides[0] or sides[1], sides[1] or sides[0]))
        runs.append({"first": at, "grams": end - first - LEAST + 1, "left": left, "right": right})
        at += end - first
    return [w for w, boxed in inside if boxed], [run for run in runs if run["grams"] > 0]


def _boxed(blocks: list[tuple[str, int]]) -> bool:
    return any(m == BOX for _, m in blocks)


def _undecided(blocks: list[tuple[str, int]]) -> bool:
    return bool(blocks) and not _marked(blocks) and any(m == OPEN for _, m in blocks)


def _streams(host: str, blocks: list[tuple[str, int]]) -> list[dict]:
    """What a page gives to its host's array: the words outside its article and those of the article's boxes.

    open tells which of them it asks about. Different streams outside articles differ on both sides.
    """
    outside = _stream(blocks)
    side = xxhash.xxh64_intdigest(outside) >> 1
    runs = [{"first": 0, "grams": len(outside) // 8 - LEAST + 1, "left": side, "right": side}]
    out = [{"host": host, "stream": outside, "runs": runs, "open": _undecided(blocks)}]
    if _boxed(blocks):
        words, runs = _box_runs(blocks)
        # no host holds a slash
        out.append({"host": host + "/article", "stream": _digests(words), "runs": runs, "open": True})
    return out


def _per_page(batches, give, schema: pa.Schema, room: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows that give() makes of each page, if any, in batches of bounded size."""
    held, size = [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            for row in batch.slice(start, 64).to_pylist():
                for out in give(row):
                    held.append(out)
                    size += sum(len(v) for v in out.values() if isinstance(v, str | bytes))
                    if size > room or len(held) >= 4096:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


_RUNS = pa.list_(pa.struct([("first", pa.int32()), ("grams", pa.int32()), ("left", pa.int64()), ("right", pa.int64())]))
_STREAM = [("host", pa.string()), ("stream", pa.binary()), ("runs", _RUNS)]
_STREAM_SQL = "host string, stream binary, runs array<struct<first: int, grams: int, left: long, right: long>>"


def _key():
    return F.xxhash64("host", "stream", "runs").alias("page")


def word_streams(pages: DataFrame) -> DataFrame:
    """(host, stream, runs, open) of pages: their words outside articles and those of articles' boxes, and whether they must be decided."""
    schema = pa.schema([*_STREAM, ("open", pa.bool_())])

    def give(row):
        return [s for s in _streams(row["host"], blocks_of(row["html"] or "")) if len(s["stream"]) >= 8 * LEAST and s["runs"]]

    own = pages.select("html", _host(F.col("url")).alias("host"))
    return map_batches(own, lambda batches: _per_page(batches, give, schema), f"{_STREAM_SQL}, open boolean")


def suffix_array(streams: DataFrame) -> DataFrame:
    """(host, gram, page, at, open, left, right) of all suffixes of the hosts' different streams, sorted by range.

    page is the stream's key; a host's equal streams are one page, so copies of a page are not its boilerplate.
    """
    distinct = streams.groupBy("host", "stream", "runs").agg(F.max("open").alias("open"))
    runs = distinct.select("host", "stream", _key(), "open", F.explode("runs").alias("run"))
    at = F.sequence(F.col("run.first"), F.col("run.first") + F.col("run.grams") - 1)
    suffixes = runs.select("host", "stream", "page", "open", "run.left", "run.right", F.explode(at).alias("at")).select(
        "host", F.substring(F.col("stream"), F.col("at") * 8 + 1, F.lit(LEAST * 8)).alias("gram"), "page", "at", "open", "left", "right"
    )
    return suffixes.repartitionByRange("host", "gram", "page").sortWithinPartitions("host", "gram", "page", "at")


def repeated(suffixes: DataFrame) -> DataFrame:
    """(page, at) of undecided pages' suffixes whose first words stand elsewhere between other words on both sides.

    Equal suffixes follow one another. What a range's first and last ones lack may stand in the next range, so
    those that show its sides go on to be compared among all ranges' ends; so does a group of which many
    suffixes were read without other sides.
    """
    schema = pa.schema([
        ("host", pa.string()), ("gram", pa.binary()), ("page", pa.int64()), ("at", pa.int32()), ("open", pa.bool_()),
        ("left", pa.int64()), ("right", pa.int64()), ("end", pa.bool_()),
    ])

    def row(suffix, end):
        return dict(zip(schema.names, (*suffix, end), strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, waiting, shared, sent, last, first_group = [], [], False, False, None, True
        other = [False, False]
        for batch in batches:
            for suffix in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if last is not None and suffix[:2] == last[:2]:
                    if shared or sent:
                        out.append(row(suffix, sent))
                    else:
                        waiting.append(suffix)
                        other = [o or a != b for o, a, b in zip(other, suffix[5:], waiting[0][5:], strict=True)]
                        if all(other):
                            shared = True
                            out += [row(s, False) for s in waiting]
                        elif len(waiting) == 4096:
                            sent = True
                            out += [row(s, True) for s in waiting]
                            waiting = []
                else:
                    if first_group and last is not None:
                        out += [row(s, True) for s in waiting]
                        first_group = False
                    waiting, shared, sent, other = [suffix], False, False, [False, False]
                last = suffix
                if len(out) >= 8192:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out = []
        out += [row(s, True) for s in waiting]
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    found = stored(map_batches(
        suffixes, run, "host string, gram binary, page long, at int, open boolean, left long, right long, end boolean"
    ))
    ends = found.filter("end")
    across = ends.groupBy("host", "gram").agg(
        *(f(side).alias(f"{name}_{side}") for side in ("left", "right") for name, f in (("min", F.min), ("max", F.max)))
    ).filter("min_left <> max_left AND min_right <> max_right")
    hits = found.filter("NOT end").select("page", "at", "open").unionAll(
        ends.join(across, ["host", "gram"], "left_semi").select("page", "at", "open")
    )
    return hits.filter("open").select("page", "at").distinct()


def texts(pages: DataFrame) -> DataFrame:
    """page_id, url and text of every page."""
    by_page = repeated(suffix_array(word_streams(pages))).groupBy("page").agg(F.collect_set("at").alias("hits"))
    keyed = pages.select("page_id", "url", "html", _host(F.col("url")).alias("host"))
    decided = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])
    open_ = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string()), *_STREAM])
    final = pa.schema(list(decided))

    def asked(row):
        """What a page asks its host about, if the marks leave anything open; with its blocks."""
        blocks = blocks_of(row["html"] or "")
        asks = _boxed(blocks) or _undecided(blocks)
        return blocks, next(s for s in _streams(row["host"], blocks) if s["open"]) if asks else None

    def plain(row):
        blocks, question = asked(row)
        if question is None:
            yield {"page_id": row["page_id"], "url": row["url"], "text": main_text(blocks)}

    def left_open(row):
        _, question = asked(row)
        if question is not None:
            yield {**row, **{name: question[name] for name, _ in _STREAM}}

    def cleaned(row):
        yield {"page_id": row["page_id"], "url": row["url"], "text": main_text(blocks_of(row["html"]), row["hits"] or ())}

    out = "page_id long, url string, text string"
    sure = map_batches(keyed, lambda batches: _per_page(batches, plain, decided), out)
    unsure = map_batches(keyed, lambda batches: _per_page(batches, left_open, open_), f"page_id long, url string, html string, {_STREAM_SQL}")
    met = unsure.withColumn("page", _key()).drop("stream", "host", "runs").join(by_page, "page", "left")
    return sure.unionAll(map_batches(met, lambda batches: _per_page(batches, cleaned, final), out))


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
