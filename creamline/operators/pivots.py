"""Test names to columns."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creamline.functions.text import folded, is_short, number_text, text_number
from creamline.operators.aggregates import collapse_by_key
from creamline.operators.joins import name_parameters

_LABEL, _TEXT = "_label", "_text"
_LONG_LABEL, _LONG_TEXT = "_long_label", "_long_text"


def pivot_results(
    frame: DataFrame,
    labels: Sequence[str],
    name: str = "test_parameter_name",
    value: str = "aggregated_value",
    exact: bool = False,
    merged: bool = True,
) -> DataFrame:
    """One column per label holding the greatest value; every other column is a key.

    The keys are taken from the frame, so two rows that differ anywhere else stay apart. Rows with
    an unlisted name still make their group appear. ``exact`` skips folding names that are already
    spelled like the labels.

    Two aggregations. The first takes most rows and works by hash, without sorting them: short texts are compared
    as numbers in the order of the texts, and a longer text is a key of its own. The second, over about a row per
    group, brings a group's rows together; ``merged=False`` leaves it to a caller that merges rows later anyway.
    """
    keys = [c for c in frame.columns if c not in (name, value)]
    by_fold = {label if exact else label.lower(): label for label in labels}
    named = F.col(name) if exact else folded(F.col(name))
    listed = F.when(named.isin(list(by_fold)), named)
    rows = frame.select(*[F.col(f"`{c}`") for c in keys], listed.alias(_LABEL), F.when(listed.isNotNull(), F.col(value)).alias(_TEXT))
    long_text = F.when(~is_short(F.col(_TEXT)), F.col(_TEXT))
    long_label = F.when(long_text.isNotNull(), F.col(_LABEL))
    codes = [
        F.max(F.when(F.col(_LABEL) == fold, text_number(F.col(_TEXT)))).alias(label) for fold, label in by_fold.items()
    ]
    numbers = rows.groupBy(*[F.col(f"`{c}`") for c in keys], long_label.alias(_LONG_LABEL), long_text.alias(_LONG_TEXT)).agg(*codes)
    wide = numbers.select(*[F.col(f"`{c}`") for c in keys], *[
        F.coalesce(number_text(F.col(f"`{label}`")), F.when(F.col(_LONG_LABEL) == fold, F.col(_LONG_TEXT))).alias(label)
        for fold, label in by_fold.items()
    ])
    return collapse_by_key(wide, keys) if merged else wide


def spelled_like(test_parameter: DataFrame, labels: Sequence[str]) -> DataFrame:
    """The parameter table with its names spelled like the labels they equal.

    Doing this on the small table spares every result the comparison.
    """
    name = F.col("test_parameter_name")
    spelled = F.coalesce(*[F.when(folded(name) == m.lower(), m) for m in labels], name)
    return test_parameter.withColumn("test_parameter_name", spelled)


def pivot_by_line(
    results: DataFrame,
    test_parameter: DataFrame,
    labels: Sequence[str],
    value: Column,
    keys: Mapping[str, Column],
    merged: bool = True,
) -> DataFrame:
    """First stage of a pivot: names the results and gives one row per order line and ``keys``.

    Results of a line are stored together, so most of the work happens before the shuffle, and a
    line with very many results is spread by its keys instead of being sent to one task. Results
    with an unknown parameter count like unlisted ones. ``merged`` as in ``pivot_results``.
    """
    named = name_parameters(results, spelled_like(test_parameter, labels))
    rows = named.select(
        "commercial_order_line_id", "test_parameter_name", value.alias("aggregated_value"),
        *[col.alias(name) for name, col in keys.items()],
    )
    return pivot_results(rows, labels, exact=True, merged=merged)


def merge_pivoted(frame: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Second stage: rows alike in everything but their measures become one."""
    return collapse_by_key(frame, [c for c in frame.columns if c not in labels])
