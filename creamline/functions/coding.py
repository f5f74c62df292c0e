"""Coding of result values and derived flags."""

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from creamline.functions.text import is_blank, same_text

INHIBITOR_PARAMETER = "Z001JJPC"  # fixed value
OFFICIAL_ITEM = "MVPQVP8"  # fixed value


def code_results(value: Column, positives: bool = True) -> Column:
    """NOT FOUND to NF and, unless switched off, Positive to AL; other values unchanged."""
    coded = F.when(same_text(value, "NOT FOUND"), "NF")
    if positives:
        coded = coded.when(same_text(value, "Positive"), "AL")
    return coded.otherwise(value)


def flag_official(test_code: Column, codes: Iterable[str]) -> Column:
    return F.when(test_code.isin(list(codes)), "Y").otherwise("N")


def official_by_item(item: Column, yes: str, no: str | None, official_item: str = OFFICIAL_ITEM) -> Column:
    return F.when(item == official_item, yes).otherwise(F.lit(no).cast("string"))


def inhibitor_flag(
    value: Column,
    parameter: Column,
    not_found: str,
    positive: str,
    untested: str,
    other_is_null: bool = False,
    inhibitor: str = INHIBITOR_PARAMETER,
) -> Column:
    """Outcome of the inhibitor test carried by this result.

    ``other_is_null`` leaves the flag empty for an inhibitor result with any other value;
    otherwise such a result reads as ``untested``.
    """
    tested = parameter == inhibitor
    flag = F.when(tested & same_text(value, "Not Found"), not_found)
    flag = flag.when(tested & same_text(value, "Positive"), positive)
    if other_is_null:
        return flag.when(parameter != inhibitor, untested)
    return flag.otherwise(untested)


def antibiotic_flag(
    item: Column,
    parameter: Column,
    official_item: str = OFFICIAL_ITEM,
    inhibitor: str = INHIBITOR_PARAMETER,
) -> Column:
    return F.when((item == official_item) & (parameter == inhibitor), "2").otherwise("0")


def grade_or_zero(grade: Column) -> Column:
    return F.coalesce(grade, F.lit("0"))


def grade_or_na(grade: Column) -> Column:
    return F.when(is_blank(grade), "N/A").otherwise(grade)
