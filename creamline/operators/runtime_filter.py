"""A filter built while a query runs: rows of a large table are dropped in its scan unless their key may be wanted.

The wanted keys set bits in one array of 64-bit words, a blocked Bloom filter made of built-in aggregates. The large
side tests it as a scalar subquery, so Spark builds it before that side's scan starts, once, on any size of wanted
side, and the test moves down to the scan like any other filter. It never drops a wanted key. Others pass with a
probability that falls with the bits a key has, so a semi join still makes the cut exact, over few rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Least bits of a filter: half a megabyte, good for some 300,000 keys (one other key in fifty passes).
BITS = 1 << 22
#: A filter for more keys has this many bits for each at least, up to 8 megabytes: the array passes through the driver
#: and goes out with the tasks of the scan. Beyond that it lets more through.
BITS_A_KEY, MOST_BITS = 14, 1 << 26
_WORD = 64
#: Words gathered at a time, so that no task holds a row for every word of a large filter.
_CHUNK = 1 << 12


def _place(keys: list[Column], words: Column) -> tuple[Column, Column]:
    """The word of a key, and the two bits that it sets there."""
    digest = F.xxhash64(*keys)
    one = F.lit(1).cast("bigint")
    first, second = (
        F.call_function("shiftleft", one, F.shiftright(digest, shift).bitwiseAND(F.lit(_WORD - 1)).cast("int"))
        for shift in (0, 6)
    )
    return F.shiftrightunsigned(digest, 32) % words, first.bitwiseOR(second)


def _gathered(masks: DataFrame) -> DataFrame:
    """One row with the ``chunks`` of rows (word, mask), all in the order of their words."""
    chunk = F.floor(F.col("word") / _CHUNK).alias("chunk")
    rows = masks.groupBy(chunk).agg(F.array_sort(F.collect_list(F.struct("word", "mask"))).alias("rows"))
    return rows.agg(F.array_sort(F.collect_list(F.struct("chunk", "rows")))["rows"].alias("chunks"))


def _sized(wanted: DataFrame, columns: list[str], bits: int, grows: bool) -> DataFrame:
    """One row: ``chunks`` of the words that the keys set in a filter of the largest size, and the ``size`` for them.

    The keys are read once: how many words they set tells how many keys there are.
    """
    least, doubled = bits // _WORD, 0
    while grows and least << doubled + 1 <= MOST_BITS // _WORD:
        doubled += 1
    most = least << doubled
    word, mask = _place([F.col(c) for c in columns], F.lit(most))
    own = wanted.select(word.alias("word"), mask.alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    filled = F.aggregate("chunks", F.lit(0), lambda n, rows: n + F.size(rows))
    needed = F.log1p(-filled / most) * (-most * BITS_A_KEY / _WORD)  # unknown when all words are set
    times = F.when(filled == 0, 0).otherwise(F.coalesce(F.ceil(F.log2(needed / least)), F.lit(doubled)))
    times = F.least(F.lit(doubled), F.greatest(F.lit(0), times)).cast("int")
    return _gathered(own).withColumn("size", F.call_function("shiftleft", F.lit(least).cast("bigint"), times))


def key_bits(wanted: DataFrame, columns: list[str], bits: int = BITS, grows: bool = False) -> DataFrame:
    """One row with the array of words: of ``bits``, or where it ``grows`` of twice as many as often as the keys need."""
    size = F.col("size")
    none = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.floor((size - 1) / _CHUNK)),
        lambda chunk: F.transform(
            F.sequence(chunk * _CHUNK, F.least(size, (chunk + 1) * _CHUNK) - 1),
            lambda word: F.struct(word.alias("word"), F.lit(0).cast("bigint").alias("mask")),
        ),
    )
    rows = _sized(wanted, columns, bits, grows).select("size", F.inline(F.transform(F.concat("chunks", none), lambda rows: F.struct(rows.alias("rows")))))
    words = rows.select("size", F.inline("rows")).groupBy((F.col("word") % size).alias("word")).agg(F.bit_or("mask").alias("mask"))
    return _gathered(words).select(F.flatten(F.transform("chunks", lambda rows: rows["mask"])).alias("words"))


def may_be_wanted(wanted: DataFrame, columns: list[str], bits: int = BITS, grows: bool = False) -> Column:
    """Whether a row's columns may be among the wanted keys. Null keys are not.

    The array stands in the test once, since each place of it is a copy in every task; its size is a subquery of its own.
    """
    word, mask = _place([F.col(c) for c in columns], _sized(wanted, columns, bits, grows).select("size").scalar())
    return F.get(key_bits(wanted, columns, bits, grows).scalar(), word.cast("int")).bitwiseAND(mask) == mask
