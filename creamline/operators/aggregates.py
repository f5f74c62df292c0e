"""Collapsing, averaging, concatenating and counting.

All aggregates combine on the map side first, so a hot group reaches its reducer as one partial row
per map task.
"""

from collections.abc import Collection, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creamline.functions.numbers import rounded_mean
from creamline.functions.text import has_text, is_short, number_text, text_in, text_number
from creamline.operators.joins import enrich_results, name_parameters


def _rest(frame: DataFrame, keys: Collection[str]) -> list[str]:
    return [c for c in frame.columns if c not in keys]


def concat_distinct(col: Column, separator: str = ",") -> Column:
    return F.array_join(F.array_sort(F.collect_set(col)), separator)


def concat_all(
    frame: DataFrame, keys: Sequence[str], columns: Sequence[str], separator: str = ","
) -> DataFrame:
    """Every value of the group, repeats included, in order; one text per column.

    Repeats are counted first, so a group is gathered by its distinct values only.
    """
    counted = frame.groupBy(*keys, *columns).agg(F.count(F.lit(1)).cast("int").alias("_times"))

    def joined(column: str) -> Column:
        runs = F.array_sort(F.collect_list(F.struct(column, "_times")))
        known = F.filter(runs, lambda run: run[column].isNotNull())
        repeats = F.transform(
            known,
            lambda run: F.concat(
                run[column], F.repeat(F.concat(F.lit(separator), run[column]), run["_times"] - 1)
            ),
        )
        return F.when(F.size(known) > 0, F.array_join(repeats, separator))

    return counted.groupBy(*keys).agg(*[joined(c).alias(c) for c in columns])


def collapse_by_key(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key holding the greatest value of every other column (text compares as text)."""
    return frame.groupBy(*keys).agg(*[F.max(f"`{c}`").alias(c) for c in _rest(frame, keys)])


def average_by_group(
    frame: DataFrame,
    keys: Sequence[str],
    averaged: Sequence[str],
    concatenated: Sequence[str] = (),
    where: Column | None = None,
    strict: bool = False,
) -> DataFrame:
    """One row per key: rounded means, distinct concatenations and maxima.

    ``where`` limits the means and maxima but not the concatenations, and drops groups without any
    such row. One pass does both, so no group is joined back to its own members. Keys are returned
    as aggregates too: a later filter on them then stays above the grouping, so that two groupings
    of the same input keep reading one shuffle.
    """
    counts = F.lit(True) if where is None else F.coalesce(where, F.lit(False))

    def measure(name: str) -> Column:
        value = F.when(counts, F.col(f"`{name}`"))
        if name in concatenated:
            return concat_distinct(F.col(f"`{name}`")).alias(name)
        if name in averaged:
            return rounded_mean(value, strict).alias(name)
        return F.max(value).alias(name)

    columns = [measure(c) for c in _rest(frame, keys)]
    columns += [F.max(k).alias(k) for k in keys]
    grouped = frame.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        *columns, F.max(counts).alias("_counts")
    )
    return grouped.filter("_counts").select([F.col(f"`{c}`") for c in frame.columns])


def average_or_collapse(
    frame: DataFrame,
    regions: Iterable[str],
    averaged: Sequence[str],
    concatenated: Sequence[str] = ("tank", "seq"),
    group: Sequence[str] = ("producer_code", "sampling_date"),
    unit: str = "bar_code",
    strict: bool = False,
) -> DataFrame:
    """Official rows averaged per producer and day in ``regions``, collapsed per bar code elsewhere.

    Both halves apply their conditions inside the aggregation instead of filtering before it: the
    pivoted input then stays identical and its shuffle is read twice rather than computed twice.
    Rows without a region belong to neither half.
    """
    usable = (F.col("is_official") == "Y") & has_text(F.col("seq"))
    inside = text_in(F.col("region"), regions)
    means = average_by_group(frame, group, averaged, concatenated, usable & inside, strict)
    others = collapse_where(frame, [unit], usable & ~inside)
    return means.unionByName(others.select(means.columns))


def collapse_where(frame: DataFrame, keys: Sequence[str], where: Column) -> DataFrame:
    """:func:`collapse_by_key` over the rows matching ``where``, decided inside the aggregation."""
    return average_by_group(frame, keys, averaged=(), where=where)


def count_tests(frame: DataFrame, key: str = "bar_code", label: str = "numOfTests") -> DataFrame:
    return frame.agg(F.countDistinct(key).alias(label))


def report_totals(frame: DataFrame, stamp: Column) -> DataFrame:
    """Row count and execution time printed under a report."""
    return frame.agg(F.count(F.lit(1)).alias("rows")).withColumn("executed_at", stamp)


_WORD = 64


def lines_by_parameter(results: DataFrame, test_parameter: DataFrame) -> DataFrame:
    """How many different order lines have results, by parameter code and name; column ``lines``.

    The named parameters are numbered, and a line's are bits of one number, so that a line is shuffled once and not
    with each of its parameters. Unknown parameters are counted with their code as a key.
    """
    entries = F.array_sort(F.collect_list(F.struct("test_parameter_code", "test_parameter_name"))).alias("entries")
    numbered = test_parameter.agg(entries).select(F.posexplode("entries").alias("at", "entry")).select("at", "entry.*")
    word, bit = F.floor(F.col("at") / _WORD), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("at") % _WORD)
    named = name_parameters(results, numbered)
    by_line = named.filter(F.col("commercial_order_line_id").isNotNull()).groupBy(
        "commercial_order_line_id", word.alias("word"), F.when(F.col("at").isNull(), F.col("commercial_parameter_code")).alias("unknown"),
    ).agg(F.bit_or(bit).alias("bits"))
    ones = [F.sum(F.shiftrightunsigned("bits", k).bitwiseAND(F.lit(1).cast("bigint"))) for k in range(_WORD)]
    counted = by_line.groupBy("word", "unknown").agg(F.array(*ones).alias("ones"), F.count(F.lit(1)).alias("rows"))
    known = counted.filter(F.col("word").isNotNull()).select("word", F.posexplode("ones").alias("k", "lines")).select(
        (F.col("word") * _WORD + F.col("k")).cast("int").alias("at"), "lines"
    )
    others = counted.filter(F.col("word").isNull()).select(
        F.col("unknown").alias("commercial_parameter_code"), F.lit(None).cast("string").alias("test_parameter_name"),
        F.col("rows").alias("lines"),
    )
    names = numbered.withColumnRenamed("test_parameter_code", "commercial_parameter_code")
    found = known.filter("lines > 0").join(names, "at").groupBy("commercial_parameter_code", "test_parameter_name")
    return found.agg(F.max("lines").alias("lines")).unionAll(others)


def results_by_code(rows: DataFrame, keys: Sequence[str], value: str = "aggregated_value") -> DataFrame:
    """Count (``results``) and ``greatest_text`` by ``keys``, one row per key and long text, for a sum and maximum later.

    Short texts are compared as numbers and a longer one is a key, so that no row is sorted for its text.
    """
    long_text = F.when(~is_short(F.col(value)), F.col(value))
    counted = rows.groupBy(*keys, long_text.alias("_long")).agg(
        F.count(F.lit(1)).alias("results"), F.max(text_number(F.col(value))).alias("_number")
    )
    greatest = F.coalesce(number_text(F.col("_number")), F.col("_long")).alias("greatest_text")
    return counted.select(*keys, "results", greatest)


def samples_by_name(results: DataFrame, lines: DataFrame, test_parameter: DataFrame, keys: Sequence[str], unit: str = "bar_code") -> DataFrame:
    """How many different ``unit`` values have results, by ``keys`` of their lines and parameter name; column ``samples``.

    The names are numbered, and those of a line are bits of one number, so that a line meets what is known of it, and
    is shuffled, once and not with each of its results. Unknown and unnamed parameters together have a word of their own.
    """
    names = F.array_sort(F.collect_set("test_parameter_name")).alias("names")
    numbers = test_parameter.agg(names).select(F.posexplode("names").alias("at", "test_parameter_name"))
    named = name_parameters(results, test_parameter.join(numbers, "test_parameter_name", "left").select("test_parameter_code", "at"))
    one = F.lit(1).cast("bigint")
    word = F.coalesce(F.floor(F.col("at") / _WORD).cast("int"), F.lit(-1))
    bit = F.coalesce(F.call_function("shiftleft", one, F.col("at") % _WORD), one)
    by_line = named.groupBy("commercial_order_line_id", word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    by_unit = enrich_results(by_line, lines).filter(F.col(unit).isNotNull()).groupBy(*keys, unit, "word").agg(F.bit_or("bits").alias("bits"))
    ones = [F.sum(F.shiftrightunsigned("bits", k).bitwiseAND(one)) for k in range(_WORD)]
    counted = by_unit.groupBy(*keys, "word").agg(F.array(*ones).alias("ones"))
    each = counted.select(*keys, "word", F.posexplode("ones").alias("k", "samples")).filter("samples > 0")
    numbered = each.select(*keys, (F.col("word") * _WORD + F.col("k")).alias("at"), "samples")
    return numbered.join(numbers, "at", "left").select(*keys, "test_parameter_name", "samples")
