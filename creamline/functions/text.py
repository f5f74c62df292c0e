"""Text comparison under the laboratory's rules, and sample sequence numbers.

Human-entered text compares without regard to case or trailing blanks. Machine codes (test,
parameter and item codes) compare exactly, so that those filters reach the Parquet scan.
"""

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def folded(col: Column) -> Column:
    return F.lower(F.rtrim(col))


def same_text(col: Column, value: str) -> Column:
    return folded(col) == value.rstrip(" ").lower()


def text_in(col: Column, values: Iterable[str]) -> Column:
    return folded(col).isin(sorted({v.rstrip(" ").lower() for v in values}))


def has_text(col: Column) -> Column:
    """True when anything but trailing blanks is present; NULL counts as absent."""
    return F.coalesce(F.length(F.rtrim(col)) > 0, F.lit(False))


def is_blank(col: Column) -> Column:
    return col.isNull() | (F.rtrim(col) == "")


def seq_right(bar_code: Column) -> Column:
    return F.right(bar_code, F.lit(4))


def seq_middle(bar_code: Column) -> Column:
    return F.substring(bar_code, 11, 4)


def pad_seq(seq: Column) -> Column:
    """One leading zero when shorter than four characters; never more than one."""
    seq = F.coalesce(seq, F.lit(""))
    return F.when(F.length(F.rtrim(seq)) < 4, F.concat(F.lit("0"), seq)).otherwise(seq)


#: Bytes of a text that text_number() can hold.
SHORT = 7


def is_short(col: Column) -> Column:
    """Whether :func:`text_number` holds the text: at most SHORT bytes, the first one below 128."""
    return (F.octet_length(col) <= SHORT) & (F.ascii(col) < 128)


def text_number(col: Column) -> Column:
    """A short text as a number that sorts like the text: its bytes, filled up with zeros, then their number. Others are NULL."""
    padded = F.call_function("rpad", col.cast("binary"), F.lit(SHORT), F.lit(b"\0"))
    number = F.conv(F.hex(padded), 16, 10).cast("bigint") * 256 + F.octet_length(col)
    return F.when(is_short(col), number)


def number_text(number: Column) -> Column:
    """The text that :func:`text_number` has made a number."""
    padded = F.unhex(F.lpad(F.hex(number), 2 * SHORT + 2, "0"))
    return F.substring(padded, F.lit(1), number.bitwiseAND(F.lit(255)).cast("int")).cast("string")
