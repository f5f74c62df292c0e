"""Immediate response: samples above a regulatory limit."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creamline.functions.dates import days_from_midnight, measured_date
from creamline.functions.text import text_in
from creamline.operators.aggregates import collapse_by_key
from creamline.operators.filters import find_complete, require_columns, slice_by, threshold_alert
from creamline.operators.joins import Tables, enrich_results
from creamline.operators.layout import present
from creamline.plans.official import official_rows, sample_columns
from creamline.plans.rules import ALERT_LIMITS, ALERT_TESTS, DEFAULT_RULES, LabRules
from creamline.plans.steps import (
    IDENTIFIED,
    finished_lines,
    measured_lines,
    report_lines,
    results_until,
    with_technician,
)

TEMPERATURE = "Analysis Temperature"


def alert_candidates(
    tables: Tables,
    measure: str,
    days: int | None,
    now: datetime | None = None,
    slice_kind: str | None = "State",
    slice_value: str | None = "WI",
    rules: LabRules = DEFAULT_RULES,
) -> DataFrame:
    """Complete rows per producer and bar code, before the limit is applied."""
    window = days_from_midnight(days, now, default=7)
    lines = require_columns(finished_lines(tables, window, rules), IDENTIFIED)
    lines = slice_by(lines, slice_kind, slice_value, tables)
    lines = lines.filter(text_in(F.col("region"), [rules.alert_region]))
    tested = measured_date(F.col("result_measured_time"), F.col("result_validation_date"))
    measures = [measure, TEMPERATURE]
    results = results_until(tables["reportable_result"], window)
    lines = report_lines(sample_columns(lines), rules)
    measured = measured_lines(tables, results, lines, measures, ALERT_TESTS, {"test_date": tested}, rules)
    rows = enrich_results(measured, lines)
    samples = collapse_by_key(
        official_rows(rows).drop("is_official", "commercial_order_line_id"),
        ["producer_code", "bar_code"],
    )
    samples = with_technician(samples, tables, rules, lines.select("bar_code").distinct())
    needed = ["tank", "bar_code", "sampling_date", measure, "sample_temp", "parcel_temp",
              TEMPERATURE, "lab_tech"]
    return find_complete(samples, needed)


def immediate_response(
    tables: Tables,
    measure: str,
    days: int | None = None,
    now: datetime | None = None,
    slice_kind: str | None = "State",
    slice_value: str | None = "WI",
    rules: LabRules = DEFAULT_RULES,
    sort: bool = True,
) -> DataFrame:
    """Rows above the limit of 'Bacteria Count' or 'Somatic Cells', in single units."""
    limits = {name.lower(): (name, limit) for name, limit in ALERT_LIMITS.items()}
    measure, limit = limits[measure.lower()]
    rows = alert_candidates(tables, measure, days, now, slice_kind, slice_value, rules)
    alerts = threshold_alert(rows, measure, limit, strict=rules.strict_numbers)
    report = present(alerts, {
        "client_name": "Client Name",
        "producer_code": "ProducerCode",
        "bar_code": "Barcode",
        measure: measure,
        "sampling_date": "SamplingTime",
        "test_date": "TestDate",
        "sample_temp": "Sample Temp",
        TEMPERATURE: TEMPERATURE,
    })
    return report.orderBy("ProducerCode", "SamplingTime", "TestDate") if sort else report
