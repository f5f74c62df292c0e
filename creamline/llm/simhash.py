"""SimHash near-duplicates with deletion-variant signatures.

A fingerprint is cut into fewer segments than bits may differ, so that of two close fingerprints at least one
segment differs by one bit at most. Each segment is indexed under all its variants with one bit wiped out: two
such segments share the variant that lacks the differing bit. Equal variants meet in one bucket by a shuffle on
(wiped bit, rest of the segment), where the Hamming distance of whole fingerprints is verified.

Equal fingerprints are one before they are indexed, so a group of copies is one row. A bucket gives at most the
edges of a spanning forest, never its pairs: a search from one fingerprint takes all close ones out of those
not yet reached, so a bucket full of near copies costs little more than reading it. A bucket holds eight
bytes for each different fingerprint in it. A hot group's rows spread over 64 variants.

Defined results: null texts are empty, texts without a word have fingerprint zero and are linked like others;
texts with fewer words than a shingle are one shingle; repeated rows and rows with a null id are rows like
others (a component made of null ids alone has a null id); an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creamline.llm.common import LOWER, UPPER, as_row, map_batches, map_rows, row_columns, stored, table
from creamline.llm.components import components

BITS, SEED = 64, 42
_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
#: Runs of equal variants up to this length are compared by shifting, longer ones by search.
_SHORT = 12


def fingerprint(text: str, shingle: int = 4) -> int:
    """The SimHash of the word shingles as a signed 64-bit number."""
    words = text.encode().translate(_FOLD).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return _signed(xxhash.xxh64_intdigest(joined, SEED))
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(words) - shingle + 1].tolist()
    ends = ends[shingle - 1 :].tolist()
    ones, digest = np.zeros(BITS, dtype=np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), 1 << 15):
        some = [digest(joined[s:e], SEED) for s, e in zip(starts[at : at + (1 << 15)], ends[at : at + (1 << 15)])]
        octets = np.array(some, dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<i8")[0])


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """doc_id, text_hash (tells rows of one id apart) and fp of each row."""

    def make():
        return lambda row: {"doc_id": row["doc_id"], "text_hash": row["text_hash"], "fp": fingerprint(row["text"] or "", shingle)}

    return map_rows(
        docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")), make, "doc_id long, text_hash long, fp long"
    )


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, end) of the fewest segments of which one differs by at most one bit."""
    n = distance // 2 + 1
    edges = [BITS * i // n for i in range(n + 1)]
    return list(zip(edges, edges[1:], strict=False))


def variants(prints: DataFrame, distance: int) -> DataFrame:
    """(wiped, rest, fp): for each bit of the fingerprint, its segment without that bit."""
    mask = None
    for first, end in segments(distance):
        bits = F.lit(_signed(((1 << end) - 1) ^ ((1 << first) - 1)))
        mask = F.when(F.col("wiped") < end, bits) if mask is None else mask.when(F.col("wiped") < end, bits)
    one = F.expr("shiftleft(1L, wiped)")
    return prints.select("fp", F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))).alias("wiped")).select(
        F.col("wiped").cast("byte").alias("wiped"),
        F.col("fp").bitwiseAND(mask).bitwiseAND(F.bitwise_not(one)).alias("rest"),
        "fp",
    )


def forest(prints: np.ndarray, distance: int) -> Iterator[tuple[int, int]]:
    """Edges (places) that join all of the prints linked within the distance, found by widening search."""
    left = np.arange(len(prints))
    while len(left):
        found, left = [left[0]], left[1:]
        while found and len(left):
            at = found.pop()
            near = np.bitwise_count(prints[left] ^ prints[at]) <= distance
            if near.any():
                for other in left[near].tolist():
                    yield at, other
                    found.append(other)
                left = left[~near]


def linked_in_buckets(keyed: DataFrame, distance: int) -> DataFrame:
    """Edges (a, b) that join what is linked in each bucket; the rows come sorted by bucket."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def edges_of(wiped, rest, fp, whole: bool):
        """Edges among the runs of equal keys, and where the last run begins (it may go on)."""
        change = np.flatnonzero((wiped[1:] != wiped[:-1]) | (rest[1:] != rest[:-1])) + 1
        starts, ends = np.r_[0, change], np.r_[change, len(fp)]
        if not whole:
            keep, starts, ends = starts[-1], starts[:-1], ends[:-1]
        else:
            keep = len(fp)
        sizes, out = ends - starts, []
        for size in range(2, _SHORT + 1):
            at = starts[sizes == size]
            for i in range(size if len(at) else 0):
                for j in range(i + 1, size):
                    near = np.bitwise_count(fp[at + i] ^ fp[at + j]) <= distance
                    out.append((fp[at[near] + i], fp[at[near] + j]))
        for s, e in zip(starts[sizes > _SHORT].tolist(), ends[sizes > _SHORT].tolist(), strict=True):
            own = fp[s:e]
            if pairs := list(forest(own, distance)):
                i, j = np.array(pairs).T
                out.append((own[i], own[j]))
        return out, keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.zeros(0, np.int8), np.zeros(0, np.int64), np.zeros(0, np.uint64))

        def give(pieces):
            if pieces:
                a, b = (np.concatenate([p[k] for p in pieces]).view(np.int64) for k in (0, 1))
                for at in range(0, len(a), 1 << 16):
                    yield pa.RecordBatch.from_arrays([pa.array(a[at : at + (1 << 16)]), pa.array(b[at : at + (1 << 16)])], schema=schema)

        for batch in batches:
            new = (batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy().view(np.uint64))
            held = tuple(np.concatenate(x) for x in zip(held, new, strict=True))
            if len(held[0]):
                pieces, keep = edges_of(*held, whole=False)
                yield from give(pieces)
                held = tuple(x[keep:] for x in held)
        if len(held[0]):
            yield from give(edges_of(*held, whole=True)[0])

    return map_batches(keyed, run, "a long, b long")


def near_duplicates(docs: DataFrame, distance: int = 4, shingle: int = 4) -> DataFrame:
    """doc_id, text_hash, fp, component_id (smallest doc_id reachable) and first_hash, the text_hash that goes with it."""
    prints = stored(fingerprints(docs, shingle))
    groups = prints.groupBy("fp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("first")
    )
    keyed = variants(groups.select("fp"), distance)
    keyed = keyed.repartition("wiped", "rest").sortWithinPartitions("wiped", "rest")
    roots = components(linked_in_buckets(keyed, distance))
    rooted = groups.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    firsts = rooted.groupBy("root").agg(F.min("first").alias("first"))
    named = rooted.select("fp", "root").join(firsts, "root").select(
        "fp", F.col("first.doc_id").alias("component_id"), F.col("first.text_hash").alias("first_hash")
    )
    return prints.join(named, "fp")


def keep_one(docs: DataFrame, distance: int = 4, shingle: int = 4) -> DataFrame:
    """One document of each component, the one of the smallest id; rows that repeat id and text count once."""
    return first_of_each(docs, near_duplicates(docs, distance, shingle))


def first_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The documents that found (doc_id, text_hash, component_id, first_hash) names as the first of a component."""
    keys = ["id_and_text", "text_hash"]
    kept = (
        found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("first_hash")))
        .select(F.xxhash64("doc_id", "text_hash").alias(keys[0]), keys[1]).distinct()
    )
    # both keys are hashes without nulls, so that the join and removing repeated rows share one shuffle of the texts
    text = F.xxhash64("text")
    keyed = docs.select(F.xxhash64("doc_id", text).alias(keys[0]), text.alias(keys[1]), as_row(docs))
    return keyed.join(kept, keys, "left_semi").dropDuplicates(keys).select(*row_columns(docs))


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts stays that share enough of their five-word shingles."""
    from creamline.llm.similar_text import near_copies

    return first_of_each(docs, near_copies(docs))
