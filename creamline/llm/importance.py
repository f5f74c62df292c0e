"""Resampling documents to a target distribution by the importance of their hashed word runs.

An untrained Split of the tokenizers library cuts each ASCII-lowered text into words with offsets. Windows over
neighbouring offset pairs are the features: all runs of one to two words. A run's CRC-32 follows from the CRCs and
byte lengths of its words alone (appending is linear in the checksum), so words are hashed once and windows are a few
table lookups in numpy. Buckets are counted over all documents and over the target; a bucket's gain is the rounded
logarithm of how much likelier the target makes it, a document's weight the mean gain of its features. Gumbel noise
from the id's hash turns the best scores into a sample without replacement in proportion to the weights.

On Spark: one narrow pass cuts the texts and writes two bytes a feature; histograms add up per task and then by
bucket, so the driver sees as many numbers as there are buckets; weights are a narrow pass over the written
features. Ranks come from a range sort of narrow rows with the counts of the ranges before.

Defined results: null texts have no words; null ids draw noise from the seed alone and come after other ids in
ties; repeated rows are rows like others; without documents the result is empty, without target texts the target
is even; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creamline.llm.common import LOWER, UPPER, map_batches, stored, table, written
from creamline.operators.ordering import with_place

#: Characters between words, as a class body.
BETWEEN = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
_CUT = 1 << 20
_KNOWN = 1 << 18
_SHORT = 64


@cache
def splitter():
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(f"[{BETWEEN}]+"), "removed")


def words_with_offsets(text: str) -> Iterator[list[tuple[str, tuple[int, int]]]]:
    """Words of the text, lowered, with their offsets, in pieces cut between words."""
    lowered, split, start = text.encode().translate(_FOLD).decode(), splitter(), 0
    while len(lowered) - start > _CUT:
        gap = _between().search(lowered, start + _CUT)
        if gap is None:
            break
        yield [(w, (a + start, b + start)) for w, (a, b) in split.pre_tokenize_str(lowered[start : gap.start()])]
        start = gap.start()
    yield [(w, (a + start, b + start)) for w, (a, b) in split.pre_tokenize_str(lowered[start:])]


@cache
def _between() -> re.Pattern:
    return re.compile(f"[{BETWEEN}]")


@cache
def _shifts() -> np.ndarray:
    """What appending n bytes does to the four bytes of a checksum: [n, byte's place, byte]."""
    table_ = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table_ = np.where(table_ & 1, (table_ >> 1) ^ np.uint32(0xEDB88320), table_ >> 1)
    now = np.array([np.arange(256, dtype=np.uint32) << (8 * place) for place in range(4)])
    out = [now]
    for _ in range(_SHORT):
        now = (now >> 8) ^ table_[now & 255]
        out.append(now)
    return np.array(out)


def appended(crc: np.ndarray, length: np.ndarray, more: np.ndarray) -> np.ndarray:
    """The CRC-32 of a text and a second one behind it of at most 64 bytes, from both checksums."""
    shift = _shifts()
    return (
        shift[length, 0, crc & 255] ^ shift[length, 1, (crc >> 8) & 255]
        ^ shift[length, 2, (crc >> 16) & 255] ^ shift[length, 3, crc >> 24] ^ more
    )


class Features:
    """Buckets of all runs of 1 to ``most`` words; the checksums of words met are kept up to a bound."""

    def __init__(self, buckets: int, most: int):
        self.buckets, self.most, self.known = buckets, most, {}
        self.kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def _mark(self, word: str) -> int:
        raw = word.encode()
        mark = self.known[word] = zlib.crc32(raw) | len(raw) << 32
        return mark

    def __call__(self, text: str) -> tuple[int, bytes]:
        """Number of words, and the buckets of the features: single words first, then pairs, and so on."""
        parts, words = [], []
        for found in words_with_offsets(text):
            own = [word for word, _ in found]
            if len(self.known) > _KNOWN:
                self.known = {}
            get, mark = self.known.get, self._mark
            parts.append(np.fromiter((get(w) or mark(w) for w in own), dtype=np.int64, count=len(own)))
            words.append(own)
        marks = np.concatenate(parts)
        crc, length = (marks & 0xFFFFFFFF).astype(np.uint32), marks >> 32
        long_ = np.flatnonzero(length > _SHORT)
        fits, runs, run = np.minimum(length, _SHORT), [crc], crc
        blank, one = np.uint32(zlib.crc32(b" ")), np.ones(1, dtype=np.int64)
        flat = [w for own in words for w in own] if len(long_) else []
        for size in range(2, self.most + 1):
            n = len(crc) - size + 1
            if n < 1:
                break
            run = appended(appended(run[:n], one, blank), fits[size - 1 :], crc[size - 1 :])
            for end in long_[long_ >= size - 1].tolist():  # a word too long for the tables ends these runs
                run[end - size + 1] = zlib.crc32(" ".join(flat[end - size + 1 : end + 1]).encode())
            runs.append(run)
        return len(crc), (np.concatenate(runs) % np.uint32(self.buckets)).astype(self.kind).tobytes()


def features(texts: DataFrame, key: str, buckets: int, most: int) -> DataFrame:
    """(key, n_words, features) of each row; features holds a bucket number for each run."""
    schema = pa.schema([("key", pa.int64()), ("n_words", pa.int64()), ("features", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, held, size = Features(buckets, most), [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                some = batch.slice(start, 64)
                for name, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                    n, found = of(text or "")
                    held.append((name, n, found))
                    size += len(found)
                    if size > 4 << 20 or len(held) == 4096:
                        yield _rows(held, schema)
                        held, size = [], 0
        if held:
            yield _rows(held, schema)

    return map_batches(texts.select(F.col(key).alias("key"), "text"), run, "key long, n_words long, features binary")


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def histogram(found: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket; each task sends one count a bucket at most."""
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])
    kind = Features(buckets, 1).kind

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for one in batch.column(0):
                total += np.bincount(np.frombuffer(one.as_buffer(), dtype=kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], schema=schema)

    counts = map_batches(found.select("features"), run, "bucket int, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for row in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of how much likelier the target makes each bucket, both counts raised by one."""
    n = len(own)
    ratio = (target + 1.0) * (own.sum() + float(n)) / ((own + 1.0) * (target.sum() + float(n)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighed(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """(key, n_words, n_features, weight): the floored mean gain of a document's features."""
    schema = pa.schema([(c, pa.int64()) for c in ("key", "n_words", "n_features", "weight")])
    kind = Features(len(gain), 1).kind

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, weights = [], []
            for one in batch.column(2):
                at = np.frombuffer(one.as_buffer(), dtype=kind)
                sizes.append(len(at))
                weights.append(int(gain[at].sum()) // len(at) if len(at) else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(weights, pa.int64())], schema=schema
            )

    return map_batches(found, run, "key long, n_words long, n_features long, weight long")


def resampled(
    docs: DataFrame, target: DataFrame, buckets: int = 10_000, most: int = 2, least_words: int = 20, percent: int = 25, seed: int = 7
) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null: not drawn) of every document.

    ``percent`` of the documents with at least ``least_words`` words are drawn, the best scores first.
    """
    found = written(features(docs, "doc_id", buckets, most))
    aimed = features(target.withColumn("doc_id", F.lit(None).cast("long")), "doc_id", buckets, most)
    gain = gains(histogram(found, buckets), histogram(aimed, buckets))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit(""))).cast("binary"), 256)
    draw = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log(draw)))
    scored = stored(weighed(found, gain).withColumn("score", F.col("weight") + noise))
    eligible = F.col("n_words") >= least_words
    draws = scored.filter(eligible).count() * percent // 100
    placed = with_place(scored.filter(eligible), [F.desc("score"), F.asc_nulls_last("key")], stored, "rank")
    drawn = placed.withColumn("rank", F.when(F.col("rank") <= draws, F.col("rank")))
    rest = scored.filter(~eligible).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).select(F.col("key").alias("doc_id"), "n_features", "weight", "score", "rank")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
