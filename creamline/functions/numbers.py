"""Text to numbers, rounding rules and fixed number layouts."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from creamline.functions.text import has_text


def number(value: Column, kind: str = "double", strict: bool = False) -> Column:
    """Text as a number; blank text counts as zero and NULL stays NULL.

    Other non-numeric text becomes NULL, or raises under ANSI mode when ``strict``.
    """
    trimmed = F.trim(value)
    parsed = trimmed.cast(kind) if strict else trimmed.try_cast(kind)
    return F.when(trimmed == "", F.lit(0).cast(kind)).otherwise(parsed)


def whole_number(value: Column, strict: bool = False) -> Column:
    """Text holding an integer; a fraction is not a whole number."""
    plain = F.trim(value).rlike(r"^[+-]?\d*$")
    return number(value if strict else F.when(plain, value), "int", strict)


def rounded_mean(value: Column, strict: bool = False) -> Column:
    """Mean rounded half away from zero, as whole-number text."""
    return F.round(F.avg(number(value, strict=strict)), 0).cast("bigint").cast("string")


def to_decimal(value: Column, places: int = 2) -> Column:
    return value.try_cast(f"decimal(18,{places})")


def half_even_int(value: Column) -> Column:
    """Nearest integer, ties to even; a missing value counts as zero, unreadable text gives NULL."""
    whole = F.bround(value.try_cast("decimal(18,6)"), 0).cast("int")
    return F.when(value.isNull(), F.lit(0)).otherwise(whole)


def padded(value: Column, width: int, parens: bool = False) -> Column:
    """Integer with leading zeros. Negatives: a sign, or unpadded in parentheses."""
    size = F.abs(value)
    text = F.when(
        F.length(size.cast("string")) < width, F.lpad(size.cast("string"), width, "0")
    ).otherwise(size.cast("string"))
    if parens:
        negative = F.concat(F.lit("("), size.cast("string"), F.lit(")"))
    else:
        negative = F.concat(F.lit("-"), text)
    return F.when(value < 0, negative).otherwise(text)


def decimals(value: Column, places: int, parens: bool = True) -> Column:
    """Decimal text with a fixed number of places; negatives in parentheses or signed."""
    value = value.try_cast(f"decimal(18,{places})")
    if not parens:
        return value.cast("string")
    negative = F.concat(F.lit("("), F.abs(value).cast("string"), F.lit(")"))
    return F.when(value < 0, negative).otherwise(value.cast("string"))


def grouped(value: Column) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(value, 0)


def implied_decimal(value: Column) -> Column:
    """Two decimals with the point removed; thousands separators stay in, as on the old sheets."""
    return F.regexp_replace(F.format_number(to_decimal(value), 2), r"\.", "")


def total_solids(fat: Column, solids_not_fat: Column) -> Column:
    """Fat plus other solids as text, or '' when either is missing."""
    total = fat.try_cast("decimal(18,6)") + solids_not_fat.try_cast("decimal(18,6)")
    present = has_text(fat) & has_text(solids_not_fat)
    return F.when(present, without_tail_zeros(total.cast("string"))).otherwise("")


def freezing_point(value: Column, negate: bool = True) -> Column:
    """Thousandths of a degree to degrees, three places."""
    scale = -1000 if negate else 1000
    return (value.try_cast("decimal(12,3)") / F.lit(scale)).cast("decimal(12,3)")


def water_percent(freezing: Column) -> Column:
    """Added water in percent from the freezing point; ``<0.1`` outside (0, 540) or when missing."""
    fp = F.when(freezing.isNull(), F.lit(0.0)).otherwise(freezing.try_cast("double"))
    percent = F.bround((F.lit(540) - fp) / F.lit(5.4), 2)
    shown = without_tail_zeros(percent.cast("decimal(18,2)").cast("string"))
    inside = (fp > 0) & (fp < 540)
    return F.when(inside, shown).when(fp.isNotNull(), "<0.1")


def state_rounding(value: Column) -> Column:
    """Regulatory rounding of a count given as text.

    Only a value whose third digit is 5 is rounded, to hundreds (four digits or more) or tens
    (three digits), towards the even second digit. Every other value gives '0'.
    """
    parsed = value.try_cast("bigint")
    unit = F.when(F.length(value) > 3, F.lit(100)).when(F.length(value) == 3, F.lit(10))
    even = F.substring(value, 2, 1).isin("0", "2", "4", "6", "8")
    moved = F.when(even, parsed - unit / 2).otherwise(parsed + unit / 2).cast("bigint")
    rounded = (moved - moved % unit).cast("string")
    applies = unit.isNotNull() & (F.substring(value, 3, 1) == "5")
    return F.when(applies, rounded).otherwise("0")


def state_rounding_shown(value: Column) -> Column:
    """As :func:`state_rounding`, with zero left blank."""
    return F.nullif(state_rounding(value), F.lit("0"))


def without_tail_zeros(text: Column) -> Column:
    """Decimal text without closing zeros or a closing point."""
    return F.regexp_replace(text, r"\.?0+$", "")


def plain_decimal(value: Column) -> Column:
    """Numeric text as it stands; other text becomes NULL and a missing value zero."""
    text = F.coalesce(F.trim(value), F.lit("0"))
    return F.when(text.try_cast("decimal(18,6)").isNotNull(), text)
