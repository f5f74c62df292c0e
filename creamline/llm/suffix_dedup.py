"""Exact repeated byte strings by a column-wise multi-document suffix construction.

Every string of WINDOW bytes that starts anywhere a second time, in the same document or another, is removed.

1. Anchors. In each window of a document the gram of GRAM bytes with the smallest hash is picked, the leftmost of
   equals. The pick follows from the window's bytes alone, so equal windows pick the gram at the same offset.
   Windows are thus to be compared only where they share an anchor, and there only at the same offset.
2. Grams that occur once are left. For the others the region of all windows that may have picked them is known
   by a hash; equal regions are counted before they move, and one of each stands for all. A region met twice is
   repeated whole.
3. Of each gram with several different regions, the regions are a collection of aligned strings. It is built
   column by column from the right: each round puts one symbol before every string, re-sorts by (symbol, old
   rank), which is the step of the collection's Burrows-Wheeler transform, and updates the common prefix of
   neighbours. As windows never match across columns, each column's ranks and prefixes are held alone, not merged
   into one index: the state is two numbers a string. A window is repeated where a neighbour shares WINDOW bytes.
   Strings reach a task as a sorted stream and are worked on in groups of whole grams; the columns of a stream
   piece are the only state. A gram with more than MOST_REGIONS different regions is not gathered: its windows
   are counted by hash instead, with the same result.
4. Repeated stretches return to their documents, are merged and cut out.

Texts are shuffled once, by document, and read from there both for regions and for the result.

Defined results: a null text is empty: 0 bytes, nothing removed, the hash of nothing; texts under WINDOW bytes
are kept whole; rows that repeat id and text are copies of each other; rows with equal id and different text are
documents of their own; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creamline.llm.common import map_batches, stored, table

WINDOW, GRAM = 200, 64
#: Bytes left of an anchor that a window which picks it may hold.
AHEAD = WINDOW - GRAM
#: Strings that one construction takes on together, unless one gram has more.
PIECE = 8192
#: A gram with more different regions than this is not built in one task; see crowded().
MOST_REGIONS = 50_000
_BASE, _OTHER = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_BLOCK = 1 << 18
_LOW = np.uint64((1 << 24) - 1)
#: place = anchor << 17 | bytes of the region ahead of the anchor << 9 | bytes of the region
_SHAPE = (1 << 17) - 1


@lru_cache(maxsize=4)
def _powers(base: int = _BASE, n: int = _BLOCK + 4 * WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, by default for a block and its margins."""
    inverse = pow(base, -1, 1 << 64)
    with np.errstate(over="ignore"):
        return tuple(np.cumprod(np.r_[np.uint64(1), np.full(n, b, np.uint64)], dtype=np.uint64) for b in (base, inverse))


def _mixed(code: np.ndarray) -> np.ndarray:
    code = (code ^ (code >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return code ^ (code >> np.uint64(29))


def picked(hashes: np.ndarray, span: int) -> np.ndarray:
    """Places of the smallest hashes (their upper 40 bits, the leftmost of equals) of all runs of span hashes."""
    m = len(hashes) - span + 1
    keys = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
    short = -len(keys) % span
    grid = np.concatenate([keys, np.full(short, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, span)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:m], ahead[span - 1 : span - 1 + m]) & _LOW
    return least[np.flatnonzero(np.r_[True, least[1:] != least[:-1]])].astype(np.int64)


def anchors(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """place, gram hash and region hash of each anchor of a text."""
    whole, n = np.frombuffer(raw, np.uint8), len(raw)
    power, inverse = _powers()
    found = [(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64))]
    for start in range(0, n - WINDOW + 1, _BLOCK):
        low, high = max(0, start - AHEAD), min(n, start + _BLOCK + 2 * WINDOW)
        part = whole[low:high].astype(np.uint64) + np.uint64(1)
        running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * power[: len(part)], dtype=np.uint64)])
        end = min(n, start + _BLOCK + WINDOW - 1) - low  # of the windows that start in the block
        first = start - low
        grams = _mixed((running[first + GRAM : end + 1] - running[first : end + 1 - GRAM]) * inverse[first : end + 1 - GRAM])
        at = picked(grams, AHEAD + 1)
        anchor = at + first
        left = np.minimum(anchor + low, AHEAD)
        size = left + np.minimum(n - anchor - low, WINDOW)
        s = anchor - left
        region = _mixed((running[s + size] - running[s]) * inverse[s])
        found.append(((anchor + low) << 17 | left << 9 | size, grams[at], region))
    place, gram, region = (np.concatenate(x) for x in zip(*found, strict=True))
    place, first = np.unique(place, return_index=True)
    return place, gram[first], region[first]


def all_anchors(keyed: DataFrame) -> DataFrame:
    """key, place, gram and region of all anchors of (key, doc_id, text)."""
    schema = pa.schema([(c, pa.int64()) for c in ("key", "place", "gram", "region")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def give():
            columns = [np.concatenate(x) for x in zip(*held, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], schema=schema)

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                place, gram, region = anchors((text.as_py() or "").encode())
                if len(place):
                    held.append((np.full(len(place), key.as_py(), np.int64), place, gram, region))
                    rows += len(place)
                if rows > 50_000:
                    yield give()
                    held, rows = [], 0
        if held:
            yield give()

    return map_batches(keyed.select("key", "text"), run, "key long, place long, gram long, region long")


def column_wise(columns: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last column at which each string opens a window that another string of its group opens too (-1: none).

    columns: symbol + 1 by (column, string), 0 outside of a string, which equals nothing. group: ascending.
    Each round inserts one symbol of every string: ranks are re-sorted by symbol, keeping old order between
    equals, and the common prefix of new neighbours is one more than the least between their old ranks.
    """
    n = len(group)
    order, shared = np.arange(n), np.zeros(n + 1, np.int64)  # shared[k]: prefix shared by ranks k - 1 and k
    base = group.astype(np.int64) * 257
    first, last = np.full(n, -1), np.full(n, -1)
    for c in range(len(columns) - 1, -1, -1):
        symbol = columns[c][order].astype(np.int64)
        key = base[order] + symbol
        moved = bool((key[1:] < key[:-1]).any())
        rank = np.argsort(key, kind="stable") if moved else np.arange(n)
        key, symbol = key[rank], symbol[rank]
        i, j = rank[:-1], rank[1:]
        together = (key[1:] == key[:-1]) & (symbol[1:] > 0)
        least = shared[j]
        if len(far := np.flatnonzero(together & (j - i > 1))):
            least[far] = np.minimum.reduceat(shared, np.stack([i[far] + 1, j[far] + 1], axis=1).ravel())[::2]
        order = order[rank]
        shared = np.zeros(n + 1, np.int64)
        shared[1:n] = np.where(together, least + 1, 0)
        if c <= AHEAD:
            twice = order[(shared[:-1] >= WINDOW) | (shared[1:] >= WINDOW)]
            first[twice] = c
            last[twice] = np.where(last[twice] < 0, c, last[twice])
    return first, last


def collections(strings: DataFrame) -> DataFrame:
    """gram, region, shape, low, high (stretch about the anchor) of the single regions that hold repeated windows."""
    schema = pa.schema([(c, pa.int64()) for c in ("gram", "region", "shape", "low", "high")])

    def build(held: list[dict]) -> pa.RecordBatch:
        columns = np.zeros((AHEAD + WINDOW, len(held)), np.uint16)
        for k, row in enumerate(held):
            start = AHEAD - (row["shape"] >> 9)
            columns[start : start + len(row["bytes"]), k] = np.frombuffer(row["bytes"], np.uint8) + np.uint16(1)
        grams = np.array([row["gram"] for row in held])
        group = np.cumsum(np.r_[0, grams[1:] != grams[:-1]])
        first, last = column_wise(columns, group)
        out = [
            (row["gram"], row["region"], row["shape"], a - AHEAD, b - AHEAD + WINDOW)
            for row, a, b in zip(held, first.tolist(), last.tolist(), strict=True) if a >= 0 and row["n"] == 1
        ]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(5)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if len(held) >= PIECE and row["gram"] != held[-1]["gram"]:
                    yield build(held)
                    held = []
                held.append(row)
        if held:
            yield build(held)

    placed = strings.repartition("gram").sortWithinPartitions("gram", "region", "shape")
    return map_batches(placed, run, "gram long, region long, shape long, low long, high long")


def crowded(strings: DataFrame) -> DataFrame:
    """As collections(), for grams with too many regions for one task.

    Each window of each region becomes a row with its offset and a hash of 128 bits; equal ones are counted,
    combined before the shuffle, and those found more than once are joined back.
    """
    schema = pa.schema([(c, pa.int64()) for c in ("gram", "region", "shape", "n", "column", "h1", "h2")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                line = np.frombuffer(row["bytes"], np.uint8).astype(np.uint64) + np.uint64(1)
                m, hashes = len(line) - WINDOW + 1, []
                for base in (_BASE, _OTHER):
                    power, inverse = _powers(base, 2 * WINDOW)
                    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(line * power[: len(line)], dtype=np.uint64)])
                    hashes.append(_mixed((running[WINDOW:] - running[:-WINDOW]) * inverse[:m]).view(np.int64))
                same = [np.full(m, row[c], np.int64) for c in ("gram", "region", "shape", "n")]
                columns = AHEAD - (row["shape"] >> 9) + np.arange(m)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*same, columns, *hashes)], schema=schema)

    windows = map_batches(strings, run, "gram long, region long, shape long, n long, column long, h1 long, h2 long")
    window = ["gram", "column", "h1", "h2"]
    twice = windows.groupBy(*window).agg(F.sum("n").alias("times")).filter("times > 1").drop("times")
    return (
        windows.filter("n = 1").join(twice, window, "left_semi").groupBy("gram", "region", "shape")
        .agg((F.min("column") - AHEAD).alias("low"), (F.max("column") - AHEAD + WINDOW).alias("high"))
    )


def _regions(texts: DataFrame) -> DataFrame:
    """The bytes of the wanted regions of each text."""
    schema = pa.schema([("gram", pa.int64()), ("region", pa.int64()), ("shape", pa.int64()), ("n", pa.int64()), ("bytes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("key", "doc_id", "text", "wanted")
        for batch in batches:
            for text, wanted in zip(batch.column(names.index("text")), batch.column(names.index("wanted")), strict=True):
                raw, out = text.as_py().encode(), []
                for w in wanted.as_py():
                    start = (w["place"] >> 17) - ((w["place"] & _SHAPE) >> 9)
                    out.append({"gram": w["gram"], "region": w["region"], "shape": w["place"] & _SHAPE, "n": w["n"], "bytes": raw[start : start + (w["place"] & 511)]})
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return map_batches(texts.select("key", "doc_id", "text", "wanted"), run, "gram long, region long, shape long, n long, bytes binary")


def merged(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Stretches that overlap or touch become one."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(stretches):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def repeated_stretches(docs: DataFrame) -> DataFrame:
    """key, doc_id, text and stretches: the byte stretches (low, high) of each row that lie in repeated windows, unmerged."""
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text")
    found = all_anchors(keyed)
    # stored, so that the join below meets two plain shuffles and a hot gram's rows can be split over tasks
    often = stored(found.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1").select("gram"))
    again = stored(found.join(often, "gram", "left_semi").withColumn("shape", F.col("place").bitwiseAND(_SHAPE)))
    same = ["gram", "region", "shape"]
    regions = again.groupBy(*same).agg(F.count("*").alias("n"), F.min(F.struct("key", "place")).alias("one"))
    several = stored(regions.groupBy("gram").agg(F.count("*").alias("kinds")).filter("kinds > 1"))
    wanted = (
        regions.join(several.select("gram"), "gram", "left_semi").groupBy(F.col("one.key").alias("key"))
        .agg(F.collect_list(F.struct("gram", "region", F.col("one.place").alias("place"), "n")).alias("wanted"))
    )
    # rows that repeat id and text give the same strings: once is enough
    strings = _regions(keyed.join(wanted, "key")).dropDuplicates(same)
    many = several.filter(F.col("kinds") > MOST_REGIONS).select("gram")
    if many.isEmpty():
        part = collections(strings)
    else:
        part = collections(strings.join(many, "gram", "left_anti")).unionAll(crowded(strings.join(many, "gram", "left_semi")))
    left = F.shiftright(F.col("shape"), 9)
    whole = regions.filter("n > 1").select(*same, (-left).alias("low"), (F.col("shape").bitwiseAND(511) - left).alias("high"))
    at = F.shiftright(F.col("place"), 17)
    stretches = (
        again.join(whole.unionAll(part), same).select("key", (at + F.col("low")).alias("low"), (at + F.col("high")).alias("high"))
        .groupBy("key").agg(F.collect_set(F.struct("low", "high")).alias("stretches"))
    )
    return keyed.join(stretches, "key", "left").select("key", "doc_id", "text", "stretches")


def remove_repeats(docs: DataFrame, digest: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and, by digest, kept_sha256 or else kept (the remaining bytes)."""
    last = ("kept_sha256", pa.string()) if digest else ("kept", pa.binary())
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), last])

    def row_of(row: dict) -> dict:
        raw = (row["text"] or "").encode()
        spans = merged([(s["low"], s["high"]) for s in row["stretches"] or ()])
        edges = [0, *(e for span in spans for e in span), len(raw)]
        kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
        return {
            "doc_id": row["doc_id"], "n_bytes": len(raw), "n_removed": len(raw) - len(kept), "n_spans": len(spans),
            last[0]: hashlib.sha256(kept).hexdigest() if digest else kept,
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                yield pa.RecordBatch.from_pylist([row_of(r) for r in batch.slice(start, 256).to_pylist()], schema=schema)

    return map_batches(repeated_stretches(docs), run, f"doc_id long, n_bytes long, n_removed long, n_spans long, {last[0]} {'string' if digest else 'binary'}")


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), digest=True)
