"""Row filters: required fields, optional slices, key lists, gaps and thresholds."""

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creamline.functions.numbers import whole_number
from creamline.functions.text import has_text, is_blank, same_text, text_in
from creamline.operators.joins import Tables, group_members

UNKNOWN_WEEKS = ("N/A", "NA")  # fixed values


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def require_columns(frame: DataFrame, columns: Sequence[str], filled: Sequence[str] = ()) -> DataFrame:
    """Rows where all ``columns`` are known and all ``filled`` hold text.

    Separate IS NOT NULL terms, unlike ``dropna``, are pushed to the scans they belong to.
    """
    terms = [_col(c).isNotNull() for c in columns] + [has_text(_col(c)) for c in filled]
    return frame.filter(reduce(and_, terms))


def optional_filters(frame: DataFrame, **wanted: str | None) -> DataFrame:
    """One equality per given argument; ``None`` leaves that column unrestricted."""
    for column, value in wanted.items():
        if value is not None:
            frame = frame.filter(same_text(F.col(column), value))
    return frame


SLICE_COLUMNS = {  # fixed values: the report's slice choices
    "state": "region",
    "field rep": "field_rep",
    "state rep": "state_rep",
    "producer group": "producer_group_name",
}


def slice_by(frame: DataFrame, kind: str | None, value: str | None, tables: Tables) -> DataFrame:
    """Rows of one reporting state, field rep, state rep or producer group.

    An unknown kind or missing value selects everything. Group membership is a semi join: a producer
    in several groups must not repeat rows.
    """
    column = SLICE_COLUMNS.get((kind or "").rstrip(" ").lower())
    if column is None or value is None:
        return frame
    if column != "producer_group_name":
        return optional_filters(frame, **{column: value})
    members = optional_filters(group_members(tables), producer_group_name=value)
    return frame.join(members.select("producer_id"), "producer_id", "left_semi")


def restrict_to_keys(frame: DataFrame, keys: DataFrame | None, column: str) -> DataFrame:
    """Rows whose ``column`` is in the one-column list ``keys``; no list means no restriction."""
    if keys is None:
        return frame
    listed = keys.select(F.col(keys.columns[0]).alias(column))
    return frame.join(listed, column, "left_semi")


def any_present(frame: DataFrame, columns: Iterable[str]) -> DataFrame:
    return frame.filter(F.coalesce(*[_col(c) for c in columns]).isNotNull())


def any_present_or_blank(frame: DataFrame, columns: Iterable[str], doubtful: str) -> DataFrame:
    """As :func:`any_present`, except that ``doubtful`` counts only when it holds text."""
    known = F.coalesce(*[_col(c) for c in columns if c != doubtful]).isNotNull()
    return frame.filter(known | has_text(_col(doubtful)))


def all_present(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    return require_columns(frame, columns)


def find_incomplete(
    frame: DataFrame,
    text_columns: Sequence[str],
    other_columns: Sequence[str],
    week: str = "billing_week",
    day: str = "sampling_date",
) -> DataFrame:
    """Rows with an unknown billing week, an empty text or a missing number or day.

    The first day of 1900 is what an empty date was stored as, so it counts as missing.
    """
    gaps = [text_in(F.col(week), UNKNOWN_WEEKS)]
    gaps += [is_blank(_col(c)) for c in text_columns]
    gaps += [_col(c).isNull() for c in other_columns]
    gaps += [F.col(day).isNull() | (F.col(day) == F.to_date(F.lit("1900-01-01")))]
    return frame.filter(reduce(or_, gaps))


def find_complete(
    frame: DataFrame,
    columns: Sequence[str],
    week: str = "billing_week",
) -> DataFrame:
    """Rows with an acceptable billing week and no NULL in ``columns``.

    Not the complement of :func:`find_incomplete`: an empty text passes both.
    """
    accepted = F.col(week).isNull() | ~text_in(F.col(week), UNKNOWN_WEEKS)
    return frame.filter(reduce(and_, [_col(c).isNotNull() for c in columns], accepted))


def threshold_alert(
    frame: DataFrame, measure: str, limit: int, scale: int = 1000, strict: bool = False
) -> DataFrame:
    """Rows whose measure exceeds ``limit``, with the measure rescaled to single units.

    A measure that cannot be read as a whole number may be above any limit: its row stays, the measure
    NULL, unless ``strict`` makes it an error.
    """
    count = whole_number(_col(measure), strict)
    unreadable = _col(measure).isNotNull() & count.isNull()
    return frame.filter((count > limit) | unreadable).withColumn(measure, count * scale)
