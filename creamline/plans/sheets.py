"""Component, inspector and dairy sheets: results whose parameter belongs to the ordered item."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creamline.functions.coding import code_results, inhibitor_flag, official_by_item
from creamline.functions.dates import ReportWindow, days_from_now
from creamline.functions.text import seq_middle
from creamline.operators.aggregates import count_tests
from creamline.operators.filters import require_columns
from creamline.operators.joins import Tables
from creamline.operators.layout import present
from creamline.operators.pivots import merge_pivoted
from creamline.plans.rules import (
    COMPONENT_MEASURES,
    DEFAULT_RULES,
    FEED_MEASURES,
    INSPECTOR_MEASURES,
    INSPECTOR_WIDE_MEASURES,
    LabRules,
)
from creamline.plans.steps import IDENTIFIED, mapped_lines, mapped_results, sheet_rows

KEYS = ("producer_code", "tank", "bar_code", "sampling_time")

_TITLES = {  # fixed values: report column names
    "producer_code": "producercode",
    "state": "State",
    "producer_name": "ProducerName",
    "state_rep": "StateRep",
    "tank": "Tank",
    "seq": "seq",
    "bar_code": "BarCode",
    "route_number": "RouteNumber",
    "visit_number": "VisitNumber",
    "sampling_time": "SamplingTime",
    "IHB": "IHB",
    "Official": "Official",
}


def titled(frame: DataFrame) -> DataFrame:
    return present(frame, {c: _TITLES.get(c, c) for c in frame.columns})


_VALUE = "aggregated_value"


def components_report(
    tables: Tables, days: float = 20, now: datetime | None = None, rules: LabRules = DEFAULT_RULES
) -> DataFrame:
    """Samples with all eight components."""
    window = days_from_now(days, now)
    lines = mapped_lines(tables, window, rules, required=())
    rows = sheet_rows(
        tables, window, rules, lines, COMPONENT_MEASURES,
        ["producer_code", "tank", seq_middle(F.col("bar_code")).alias("seq"), "bar_code",
         "visit_number", "sampling_time"],
        {}, F.col(_VALUE), only=COMPONENT_MEASURES,
    )
    wide = merge_pivoted(rows, COMPONENT_MEASURES)
    return titled(require_columns(wide, [*KEYS, *COMPONENT_MEASURES], filled=["seq"]))


def _inspector_rows(
    tables: Tables,
    window: ReportWindow,
    rules: LabRules,
    labels: Sequence[str],
    *extra: str,
    only: Sequence[str] | None = None,
) -> DataFrame:
    lines = mapped_lines(tables, window, rules, rules.feed_state)
    shown = ["producer_code", "state", *extra, "state_rep", "tank",
             seq_middle(F.col("bar_code")).alias("seq"), "bar_code", "visit_number", "sampling_time"]
    value = code_results(F.col(_VALUE), positives=False)
    return merge_pivoted(sheet_rows(tables, window, rules, lines, labels, shown, {}, value, only), labels)


def inspector_report(
    tables: Tables, days: float = 20, now: datetime | None = None, rules: LabRules = DEFAULT_RULES
) -> DataFrame:
    """Samples with cell count and freezing point; bacteria and inhibitor may be missing."""
    wide = _inspector_rows(
        tables, days_from_now(days, now), rules, INSPECTOR_MEASURES, "producer_name",
        only=INSPECTOR_MEASURES,
    )
    kept = require_columns(wide, [*KEYS, "Somatic cells", "Freezing point"], filled=["seq"])
    return titled(kept.select(
        "producer_code", "tank", "seq", "producer_name", "visit_number", "sampling_time",
        "Bacteria", "Somatic cells", "Freezing point", "Delvo Inhibitor",
    ))


def inspector_wide(
    tables: Tables, days: float = 7, now: datetime | None = None, rules: LabRules = DEFAULT_RULES
) -> DataFrame:
    """Every sample with eleven measures, complete or not."""
    return titled(_inspector_rows(tables, days_from_now(days, now), rules, INSPECTOR_WIDE_MEASURES))


def inspector_count(
    tables: Tables, days: float = 7, now: datetime | None = None, rules: LabRules = DEFAULT_RULES
) -> DataFrame:
    """How many samples :func:`inspector_wide` is about."""
    window = days_from_now(days, now)
    lines = mapped_lines(tables, window, rules, rules.feed_state, IDENTIFIED)
    measured = mapped_results(tables, window, lines, rules).select("commercial_order_line_id").distinct()
    return count_tests(lines.join(measured, "commercial_order_line_id", "left_semi"))


def dairy_sheet(
    tables: Tables, days: float = 80, now: datetime | None = None, rules: LabRules = DEFAULT_RULES
) -> DataFrame:
    """All identified rows of a client's samples. The inhibitor flag keeps rows of a sample apart."""
    window = days_from_now(days, now)
    lines = mapped_lines(tables, window, rules, required=())
    value, parameter = F.col(_VALUE), F.col("commercial_parameter_code")
    rows = sheet_rows(
        tables, window, rules, lines, FEED_MEASURES,
        ["producer_code", "tank", seq_middle(F.col("bar_code")).alias("seq"), "bar_code",
         "route_number", F.col("sampling_time").cast("date").alias("sampling_time"),
         official_by_item(F.col("commercial_item"), "Y", "N").alias("Official")],
        {"IHB": inhibitor_flag(value, parameter, "NF", "AL", "NT", other_is_null=True)}, value,
    )
    wide = merge_pivoted(rows, FEED_MEASURES)
    return titled(require_columns(wide, KEYS, filled=["seq"]))
