"""Two older forms of the official report, listing complete rows only."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creamline.functions.dates import days_from_now
from creamline.functions.text import seq_middle, text_in
from creamline.operators.aggregates import average_by_group, concat_all
from creamline.operators.filters import optional_filters, require_columns, slice_by
from creamline.operators.joins import Tables, enrich_results
from creamline.operators.layout import present
from creamline.operators.pivots import merge_pivoted
from creamline.plans.official import AVERAGED, TITLES, sample_columns
from creamline.plans.rules import (
    DEFAULT_RULES,
    LEGACY_MEASURES,
    OFFICIAL_MEASURES,
    RED_TAG_TESTS,
    LabRules,
)
from creamline.plans.steps import (
    IDENTIFIED,
    finished_lines,
    measured_lines,
    report_lines,
    results_until,
    shared_rows,
    with_technician,
)

DAY = ["producer_code", "sampling_date"]
_COMPLETE = (*IDENTIFIED[:2], "bar_code", "sampling_date", *LEGACY_MEASURES)


def _lines(tables: Tables, days: float, now: datetime | None, rules: LabRules):
    window = days_from_now(days, now)
    return window, require_columns(finished_lines(tables, window, rules), IDENTIFIED)


def legacy_samples(lines: DataFrame, lab_copy: bool, rules: LabRules = DEFAULT_RULES) -> DataFrame:
    """What the report shows of its lines, computed once for the pivot and the technicians."""
    unused = ["billing_week", "order_line_status", "btu_number", *([] if lab_copy else ["region"])]
    samples = sample_columns(lines, "state").withColumn("seq", seq_middle(F.col("bar_code")))
    return report_lines(samples.drop(*unused), rules)


def legacy_pivot(
    tables: Tables, window, samples: DataFrame, lab_copy: bool, rules: LabRules = DEFAULT_RULES
) -> DataFrame:
    labels = OFFICIAL_MEASURES if lab_copy else LEGACY_MEASURES
    results = results_until(tables["reportable_result"], window)
    measured = measured_lines(tables, results, samples, labels, RED_TAG_TESTS, {}, rules)
    rows = enrich_results(measured, samples)
    return merge_pivoted(rows.drop("commercial_order_line_id"), labels)


def legacy_official(
    tables: Tables,
    variant: str = "state",
    days: float = 7,
    now: datetime | None = None,
    slice_kind: str | None = None,
    slice_value: str | None = None,
    rules: LabRules = DEFAULT_RULES,
) -> DataFrame:
    """'state' averages per producer and day by postal state; choosing a state has no effect there.

    'lab' averages per producer, day and bar code by reporting state and adds the technician. Both
    concatenate every tank and sequence number of the producer's day, repeats included.
    """
    lab_copy = variant.lower() == "lab"
    window, lines = _lines(tables, days, now, rules)
    if lab_copy:
        lines = slice_by(lines, slice_kind, slice_value, tables)
    elif slice_kind and slice_kind.lower() in ("field rep", "state rep"):
        lines = optional_filters(lines, **{slice_kind.lower().replace(" ", "_"): slice_value})
    samples = legacy_samples(lines, lab_copy, rules)
    # the means, the lists of tanks and the other rows read it
    pivoted = shared_rows(legacy_pivot(tables, window, samples, lab_copy, rules), rules)
    averaged_by = "region" if lab_copy else "state"
    usable = require_columns(pivoted, _COMPLETE, filled=["seq"]).filter(
        F.col("is_official") == "Y"
    ).drop("is_official")
    inside = text_in(F.col(averaged_by), rules.averaged_regions)
    keys = [*DAY, "bar_code"] if lab_copy else DAY
    means = average_by_group(
        usable.filter(inside), keys, AVERAGED, strict=rules.strict_numbers
    ).drop("tank", "seq")
    means = means.join(concat_all(pivoted, DAY, ["tank", "seq"]), DAY, "left")
    others = usable.filter(~inside)
    rows = means.select(others.columns).unionByName(others)
    if lab_copy:
        rows = with_technician(rows, tables, rules, samples.select("bar_code").distinct())
    report = present(rows, _titles(lab_copy))
    if lab_copy:
        return report.orderBy("Client Name", "ProducerCode", "SamplingTime", "Tank")
    return report


def _titles(lab_copy: bool) -> dict[str, str]:
    """Column names of the current report, with State added and later additions left out."""
    later = {"region", "billing_week", "order_line_status", "btu_number", "is_official",
             "result_validation_date"}
    if not lab_copy:
        later |= {"bar_code", "lab_tech", "Analysis Temperature"}
    kept = {c: t for c, t in TITLES.items() if c not in later} | {"state": "State"}
    return kept | {"region": "ReportingState"} if lab_copy else kept
