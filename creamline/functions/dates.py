"""Fixed-offset time shifts, report windows and date layouts."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, time, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

UTC_OFFSET_HOURS = -5  # fixed value: the laboratory ignores daylight saving


def to_local(ts: Column, offset_hours: int = UTC_OFFSET_HOURS) -> Column:
    return ts + F.make_dt_interval(hours=F.lit(offset_hours))


def local_date(ts: Column, offset_hours: int = UTC_OFFSET_HOURS) -> Column:
    return to_local(ts, offset_hours).cast("date")


def tested_at(validated: Column, measured: Column) -> Column:
    """Local time of validation, or of measurement where not validated."""
    return to_local(F.coalesce(validated, measured))


def measured_date(measured: Column, validated: Column) -> Column:
    """Local day of measurement, or of validation where not measured."""
    return F.coalesce(local_date(measured), local_date(validated))


def _stamp(value: datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


@dataclass(frozen=True)
class ReportWindow:
    """Completion bounds in UTC. The end always counts; the start only when ``closed``."""

    start: datetime | None
    end: datetime | None
    closed: bool = False

    def after_start(self, ts: Column) -> Column:
        if self.start is None:
            return F.lit(False)
        return ts >= _stamp(self.start) if self.closed else ts > _stamp(self.start)

    def before_end(self, ts: Column) -> Column:
        return F.lit(False) if self.end is None else ts <= _stamp(self.end)


def _local_now(now: datetime | None) -> datetime:
    if now is not None:
        return now
    utc = datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
    return utc + timedelta(hours=UTC_OFFSET_HOURS)


def _utc(local: datetime) -> datetime:
    return local - timedelta(hours=UTC_OFFSET_HOURS)


def between_dates(first: date | None, last: date | None) -> ReportWindow:
    """Both days at local midnight, closed at both ends; a missing date selects nothing."""
    if first is None or last is None:
        return ReportWindow(None, None, closed=True)
    return ReportWindow(
        _utc(datetime.combine(first, time())), _utc(datetime.combine(last, time())), closed=True
    )


def days_from_midnight(
    days: int | None, now: datetime | None = None, default: int = 30, zero_is_unset: bool = False
) -> ReportWindow:
    """From local midnight ``days`` ago (open) to ``now`` (closed).

    With ``zero_is_unset`` a zero leaves the start unknown, so the window selects nothing.
    """
    now = _local_now(now)
    if days is None:
        days = default
    if days == 0 and zero_is_unset:
        return ReportWindow(None, _utc(now))
    return ReportWindow(_utc(datetime.combine(now.date() - timedelta(days=days), time())), _utc(now))


def days_from_now(days: float, now: datetime | None = None) -> ReportWindow:
    """From exactly ``days`` before ``now`` (open) to ``now`` (closed)."""
    now = _local_now(now)
    return ReportWindow(_utc(now - timedelta(days=days)), _utc(now))


# The layouts below go through plain dates and hours, so that the session's time zone and its
# daylight saving gaps cannot move a zoneless time.


def date_text(col: Column, layout: str = "MM/dd/yyyy") -> Column:
    return F.date_format(col.cast("date"), layout)


def date_or_zeros(col: Column) -> Column:
    return F.coalesce(date_text(col, "yyyyMMdd"), F.lit("00000000"))


def clock_text(col: Column) -> Column:
    return F.when(col.isNotNull(), F.format_string("%02d:%02d", F.hour(col), F.minute(col)))


def execution_stamp(now: datetime | None = None, day_first: bool = False) -> Column:
    now = _local_now(now)
    day = f"{now:%d/%m/%Y}" if day_first else f"{now:%m/%d/%Y}"
    return F.lit(f"{day}  {now.hour % 12 or 12}:{now:%M:%S} {'AM' if now.hour < 12 else 'PM'}")
