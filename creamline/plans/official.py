"""The official report: averages for some regions, one row per sample elsewhere."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creamline.functions.dates import ReportWindow, between_dates, local_date
from creamline.functions.text import has_text, seq_right
from creamline.operators.aggregates import average_or_collapse, collapse_by_key
from creamline.operators.completion import completed_in_window, expand_to_samples
from creamline.operators.filters import find_complete, find_incomplete, require_columns, slice_by
from creamline.operators.joins import Tables, enrich_lines, enrich_results, fill_from_lookup, lines_of_samples
from creamline.operators.layout import present, with_text_null
from creamline.operators.ordering import with_place
from creamline.operators.pivots import merge_pivoted
from creamline.plans.rules import (
    DEFAULT_RULES,
    OFFICIAL_MEASURES,
    OFFICIAL_REPORT_TESTS,
    LabRules,
)
from creamline.plans.steps import (
    COMPLETION_STATE,
    IDENTIFIED,
    TECHNICIAN_SET,
    kept_technicians,
    measured_lines,
    report_lines,
    shared_rows,
    technician_set,
)

AVERAGED = ("Bacteria Count", "Somatic cells", "Freezing point")

TITLES = {  # fixed values: report column names
    "producer_code": "ProducerCode",
    "tank": "Tank",
    "seq": "Seq",
    "producer_name": "ProducerName",
    "permit_number": "PermitNumber",
    "sampling_date": "SamplingTime",
    "Bacteria Count": "Bacteria Count",
    "Somatic cells": "Somatic Cells",
    "Freezing point": "Freezing Point",
    "Delvo Inhibitor": "Delvo Inhibitor",
    "region": "Region",
    "field_rep": "FieldRep",
    "state_rep": "StateRep",
    "sample_temp": "Sample Temp",
    "parcel_temp": "Parcel Temp",
    "client_name": "Client Name",
    "bar_code": "Barcode",
    "lab_tech": "Lab Tech",
    "Analysis Temperature": "Analysis Temperature",
    "billing_week": "BillingWeek",
    "order_line_status": "CommercialOrderLineStatus",
    "btu_number": "BtuNumber",
    "is_official": "Isofficial",
    "result_validation_date": "ResultValidationDate",
}
SORT = ("Client Name", "ProducerCode", "SamplingTime", "Tank")

_TEXTS = ("tank", "bar_code", "Somatic cells", "Freezing point", "Delvo Inhibitor",
          "Bacteria Count", "lab_tech")
_OTHERS = ("sample_temp", "parcel_temp", "Analysis Temperature")


def sample_columns(lines: DataFrame, *extra: str) -> DataFrame:
    """The columns official-style reports show, from enriched lines, and what ``extra`` asks for."""
    return lines.select(
        "commercial_order_line_id", "producer_code", "region", "producer_name", "state_rep", "tank",
        seq_right(F.col("bar_code")).alias("seq"),
        "bar_code", "permit_number",
        local_date(F.col("sampling_time")).alias("sampling_date"),
        "field_rep",
        F.col("temperature_at_sampling").alias("sample_temp"),
        F.col("temperature_at_registration").alias("parcel_temp"),
        "billing_week",
        F.col("commercial_order_line_status").alias("order_line_status"),
        "client_name", "btu_number", *extra,
    )


def eligible_lines(tables: Tables, window: ReportWindow, rules: LabRules) -> DataFrame:
    return completed_in_window(
        tables["reportable_result"], tables["commercial_order_line"], window, rules.status,
        tables.get(COMPLETION_STATE),
    )


def official_pivot(
    tables: Tables,
    window: ReportWindow,
    slice_kind: str | None = None,
    slice_value: str | None = None,
    rules: LabRules = DEFAULT_RULES,
) -> DataFrame:
    """One row per sample, item, official flag and validation time, with the five measures."""
    lines = _shown_lines(tables, window, slice_kind, slice_value, rules)
    measured = measured_lines(
        tables, tables["reportable_result"], lines, OFFICIAL_MEASURES, OFFICIAL_REPORT_TESTS,
        {"result_validation_date": F.col("result_validation_date")}, rules,
    )
    return _merged(measured, lines)


def pivot_and_technicians(
    tables: Tables,
    window: ReportWindow,
    slice_kind: str | None = None,
    slice_value: str | None = None,
    rules: LabRules = DEFAULT_RULES,
) -> tuple[DataFrame, DataFrame]:
    """:func:`official_pivot`, and the technicians (bar_code, operator_code) of its bar codes, from one scan of results.

    A technician may have tested any order line of the bar code, so the scan covers all of them; the join with
    the report's lines drops the others' measures.
    """
    lines = _shown_lines(tables, window, slice_kind, slice_value, rules)
    every = report_lines(lines_of_samples(tables, lines.select("bar_code").distinct()), rules)
    measured = shared_rows(measured_lines(
        tables, tables["reportable_result"], every, OFFICIAL_MEASURES, OFFICIAL_REPORT_TESTS,
        {"result_validation_date": F.col("result_validation_date"), **technician_set(rules)}, rules,
    ), rules)
    return _merged(measured.drop(TECHNICIAN_SET), lines), kept_technicians(measured, every, tables, rules)


def _shown_lines(
    tables: Tables, window: ReportWindow, slice_kind: str | None, slice_value: str | None, rules: LabRules
) -> DataFrame:
    lines = expand_to_samples(
        eligible_lines(tables, window, rules),
        tables["commercial_order_line"],
        rules.official_items,
        rules.status,
    )
    lines = require_columns(enrich_lines(lines, tables), IDENTIFIED)
    lines = slice_by(lines, slice_kind, slice_value, tables)
    return report_lines(sample_columns(lines, "commercial_item"), rules)


def _merged(measured: DataFrame, lines: DataFrame) -> DataFrame:
    rows = enrich_results(measured, lines)
    return merge_pivoted(rows.drop("commercial_order_line_id"), OFFICIAL_MEASURES)


def official_rows(pivoted: DataFrame) -> DataFrame:
    return pivoted.filter((F.col("is_official") == "Y") & has_text(F.col("seq")))


def official_report(
    tables: Tables,
    first: date | None,
    last: date | None,
    slice_kind: str | None = None,
    slice_value: str | None = None,
    mode: str | None = None,
    rules: LabRules = DEFAULT_RULES,
    sort: bool = True,
    place: str | None = None,
) -> DataFrame:
    """Results completed between two days.

    ``place`` names a column to be added, which gives each row's place in the report's order.

    ``mode`` 'All' lists incomplete rows, 'Raw' lists every region per sample without averages, and
    anything else lists complete rows.
    """
    window = between_dates(first, last)
    pivoted, technicians = pivot_and_technicians(tables, window, slice_kind, slice_value, rules)
    chosen = (mode or "").rstrip(" ").lower()
    if chosen == "raw":
        rows = collapse_by_key(official_rows(pivoted).drop("commercial_item"), ["bar_code"])
    else:
        # over shared lines Spark does not see that both halves read the same shuffle
        rows = average_or_collapse(
            shared_rows(pivoted.drop("commercial_item"), rules), rules.averaged_regions, AVERAGED,
            strict=rules.strict_numbers,
        )
    rows = fill_from_lookup(with_text_null(rows, "lab_tech"), technicians, "bar_code", "operator_code", "lab_tech")
    if chosen == "all":
        rows = find_incomplete(rows, _TEXTS, _OTHERS)
    elif chosen != "raw":
        rows = find_complete(rows, [*_TEXTS, *_OTHERS, "sampling_date"])
    report = present(rows, TITLES)
    if place is not None:
        rest = [F.col(f"`{c}`") for c in report.columns if c not in SORT]
        return with_place(report, [*SORT, *rest], lambda frame: shared_rows(frame, rules), place)
    return report.orderBy(*SORT) if sort else report
