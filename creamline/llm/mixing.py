"""Mixing sources to target weights by cube-method balanced sampling.

Every source gets a target amount of words. Target over source size is how often each of its documents is wanted
on average: the whole part is taken outright, the fraction is the inclusion probability of one more copy. The
cube method moves the probabilities of three documents at a time along the null space of the balancing
constraints (words, documents), so that both totals stay as they are, until one of the three is 0 or 1. Blocks
of a source are walked apart, each in a task that reads it as a stream; at most three documents of a block stay
undecided, and those of many blocks are walked together on the next level. What stays at the end, three
documents a source and some of middling lengths that the last walk leaves out, is the landing problem, solved by
trying all roundings.

A hot source is many blocks. Blocks and random draws follow from hashes of the ids, so reruns agree.

Defined results: a null text has size 0; a null source is a source of its own, last in order; sources of size 0
have target 0; where no source has words everything is taken 0 times; rows that repeat an id are documents of
their own (those that repeat id and text may change places); other columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creamline.llm.common import BLANKS, as_row, map_batches, row_columns, stored, table

WEIGHTS, SHARE, MOST = (3.0, 1.0, 2.0), 1.5, 2.0
#: Documents that one walk takes on.
BLOCK = 8192
#: Documents of a source, spread over all but the greatest lengths, that only the landing decides.
LANDING = 14
_SURE = 1e-9


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, text_hash and the number of words of each row."""
    return docs.select(
        "doc_id", "source", F.xxhash64("text").alias("text_hash"),
        F.coalesce(F.regexp_count("text", F.lit(f"[^{BLANKS}]+")), F.lit(0)).cast("long").alias("size"),
    )


def targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, documents, source_size and target, one row a source.

    Shares that pass their cap are cut and the excess is dealt again by weight. In order of cap over weight the
    capped sources come first, so running sums find the final level at once. The windows run over one row a
    source, summed before.
    """
    per = sized.groupBy("source").agg(F.count("*").alias("documents"), F.sum("size").alias("source_size"))
    place = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int")))
    per = per.withColumn("cap", F.lit(most) * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(Window.partitionBy())
    level = (F.lit(share) * total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(
        order.rowsBetween(0, Window.unboundedFollowing)
    )
    capped = F.col("cap") <= F.col("level") * F.col("weight")
    return (
        per.withColumn("level", level).withColumn("capped", capped)
        .withColumn("open_level", F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(Window.partitionBy())["level"])
        .select("source", "documents", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(F.col("open_level") * F.col("weight")).alias("target"))
    )


def flight(p: np.ndarray, x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Walks the probabilities p (n) with balancing values x (n x 2) until at most three are undecided."""
    p, values, draws = p.tolist(), x.tolist(), rng.random(len(p) + 8).tolist()
    hand: list[int] = []
    for i in range(len(p)):
        if not _SURE < p[i] < 1 - _SURE:
            p[i] = float(round(p[i]))
            continue
        hand.append(i)
        if len(hand) == 3:
            _move(p, values, hand, draws[i])
    k = len(p)
    while len(hand) == 3 and k < len(draws):
        _move(p, values, hand, draws[k])
        k += 1
    return np.array(p)


def _move(p: list[float], values: list[list[float]], hand: list[int], draw: float) -> None:
    """Moves three probabilities along the direction that keeps both totals; settled ones leave the hand."""
    (a0, a1), (b0, b1), (c0, c1) = (values[i] for i in hand)
    u = (b0 * c1 - b1 * c0, c0 * a1 - c1 * a0, a0 * b1 - a1 * b0)
    if max(map(abs, u)) < 1e-12:  # all alike: two of them suffice
        d, e = a0 * a0 + a1 * a1, a0 * b0 + a1 * b1
        u = (e, -d, 0.0) if d > 1e-18 else (1.0, 0.0, 0.0)
    up = min((((1 - p[i]) if v > 0 else p[i]) / abs(v) for i, v in zip(hand, u, strict=True) if v), default=0.0)
    down = min(((p[i] if v > 0 else (1 - p[i])) / abs(v) for i, v in zip(hand, u, strict=True) if v), default=0.0)
    step = up if draw * (up + down) < down else -down
    for i, v in zip(list(hand), u, strict=True):
        p[i] += step * v
        if p[i] <= _SURE or p[i] >= 1 - _SURE:
            p[i] = 0.0 if p[i] < 0.5 else 1.0
            hand.remove(i)


def landing(p: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The rounding of the undecided probabilities that misses by least: a document of mean length counts as seven documents."""
    open_ = np.flatnonzero((p > _SURE) & (p < 1 - _SURE))
    if len(open_):
        ways = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_)) & 1).astype(float)
        words, documents = np.abs(ways @ x[open_] - p[open_] @ x[open_]).T
        p[open_] = ways[np.argmin(words / max(x[:, 0].mean(), 1e-12) + documents**2 / 50)]
    return p


def settled(p: np.ndarray, x: np.ndarray, rng: np.random.Generator, last: bool) -> np.ndarray:
    """The walked probabilities; on the last level all are 0 or 1."""
    if not last:
        return flight(p, x, rng)
    p = p.copy()
    kept = np.unique(np.linspace(0.15 * len(p), len(p) - 1, min(len(p), LANDING)).astype(int))
    others = np.setdiff1d(np.arange(len(p)), kept)
    p[others] = flight(p[others], x[others], rng)
    return landing(p, x)


def _walked(rows: DataFrame, last: bool) -> DataFrame:
    """One level: each block of a source, whose rows come together and in order, is walked; only p changes."""
    names = rows.columns

    def settle(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(held)
        size = whole.column("size").to_numpy().astype(float)
        x = np.stack([size / max(size.max(), 1.0), np.ones(len(size))], axis=1)
        seed = whole.column("id_hash").slice(0, 4).to_numpy().view(np.uint64).tolist()
        p = settled(whole.column("p").to_numpy(), x, np.random.default_rng([*seed, len(size)]), last)
        whole = whole.set_column(names.index("p"), whole.schema.field("p"), pa.array(p))
        yield from whole.combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            keys = list(zip(batch.column(names.index("source")).to_pylist(), batch.column(names.index("block")).to_pylist(), strict=True))
            start = 0
            for i, key in enumerate(keys):
                if key != now:
                    held += [batch.slice(start, i - start)] if i > start else []
                    if held:
                        yield from settle(held)
                    held, now, start = [], key, i
            held.append(batch.slice(start))
        if any(len(b) for b in held):
            yield from settle(held)

    return map_batches(rows, run, rows.schema)


def balanced(rows: DataFrame, most_rows: int, block: int = BLOCK) -> DataFrame:
    """The rows with p moved to 0 or 1, balanced in each source over size and count.

    rows need source, documents (of the source), id_hash, size and p; most_rows is the greatest documents and
    gives the number of levels.
    """
    done, level, most_blocks = None, 0, max(1, -(-most_rows // block))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("documents") / block))
    now = rows
    while True:
        placed = now.withColumn("blocks", blocks.cast("long")).withColumn("block", F.pmod(F.xxhash64("id_hash", F.lit(level)), "blocks"))
        placed = placed.repartition("source", "block").sortWithinPartitions("source", "block", F.desc("size"), "id_hash")
        walked = stored(_walked(placed, most_blocks == 1))
        if most_blocks == 1:
            done = walked if done is None else done.unionAll(walked)
            return done.drop("blocks", "block")
        sure = walked.filter("p IN (0, 1)")
        done = sure if done is None else done.unionAll(sure)
        now, level = walked.filter("p NOT IN (0, 1)").drop("block"), level + 1
        blocks, most_blocks = F.ceil(F.col("blocks") * 3 / block), max(1, -(-most_blocks * 3 // block))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, block: int = BLOCK) -> DataFrame:
    """doc_id, source, text_hash, size, source_size, target and copies (how often the mix takes the row)."""
    sized = stored(sizes(docs))
    per = stored(targets(sized, weights, share, most))
    most_rows = per.agg(F.coalesce(F.max("documents"), F.lit(0))).first()[0]
    per = per.withColumnRenamed("source", "its_source")
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(most))).otherwise(0.0)
    rows = (
        sized.join(per, F.col("source").eqNullSafe(F.col("its_source"))).drop("its_source")
        .withColumn("whole", F.floor(rate)).withColumn("p", rate - F.col("whole"))
        .withColumn("id_hash", F.xxhash64("doc_id", "text_hash"))
    )
    return balanced(rows, most_rows, block).select(
        "doc_id", "source", "text_hash", "size", "source_size", "target",
        (F.col("whole") + F.col("p")).cast("long").alias("copies"),
    )


def take(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents, each as often as it is taken; the columns stay as they are."""
    keys, text = ["whole_row", "text_hash"], F.xxhash64("text")
    named = F.xxhash64("doc_id", "source", "text_hash").alias(keys[0])
    times = mix(docs, **options).groupBy(named, keys[1]).agg(F.sum("copies").cast("int").alias("copies"))
    # both keys are hashes without nulls, so that removing repeated rows and the join share one shuffle of the texts
    keyed = docs.select(F.xxhash64("doc_id", "source", text).alias(keys[0]), text.alias(keys[1]), as_row(docs))
    return (
        keyed.dropDuplicates(keys).join(times.filter("copies > 0"), keys)
        .select("row", F.explode(F.sequence(F.lit(1), "copies"))).select(*row_columns(docs))
    )


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, 0 to 2 times."""
    return take(docs)
