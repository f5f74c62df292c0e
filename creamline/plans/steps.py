"""Stages shared by the reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creamline.functions.coding import code_results, flag_official
from creamline.functions.dates import ReportWindow
from creamline.functions.text import text_in
from creamline.operators.completion import completed_in_window
from creamline.operators.filters import optional_filters, require_columns
from creamline.operators.joins import (
    Tables,
    enrich_lines,
    enrich_results,
    fill_from_lookup,
    lines_of_samples,
    mapped_pairs,
    near_lines,
    technicians,
)
from creamline.operators.layout import with_text_null
from creamline.operators.pivots import pivot_by_line
from creamline.plans.rules import LabRules
from creamline.sources.shared import REPORTS
from creamline.sources.stored import in_months

IDENTIFIED = ("producer_code", "tank", "sampling_time")
#: Name under which tables may hold the state of ``operators.completion_state``; reports then read completion there.
COMPLETION_STATE = "completion_state"
_ITEM = "_item"


def finished_lines(tables: Tables, window: ReportWindow, rules: LabRules) -> DataFrame:
    """Enriched lines completed in the window."""
    eligible = completed_in_window(
        tables["reportable_result"], tables["commercial_order_line"], window, rules.status,
        tables.get(COMPLETION_STATE),
    )
    return enrich_lines(eligible, tables)


def results_until(results: DataFrame, window: ReportWindow) -> DataFrame:
    """Results that a line completed in the window can have: none is later than its end."""
    stamp = F.col("result_validation_date")
    return in_months(results, window).filter(window.before_end(stamp) | stamp.isNull())


def report_lines(lines: DataFrame, rules: LabRules) -> DataFrame:
    """The lines of a report with what it shows of them: computed once for the cut of the results and for the report."""
    return rules.shared.share(lines, "lines") if rules.shared is not None else lines


def shared_rows(rows: DataFrame, rules: LabRules) -> DataFrame:
    """Rows that several readers use, computed once; a store of the rules' own or the reports' common one."""
    return (rules.shared or REPORTS).share(rows, "rows")


def measured_lines(
    tables: Tables,
    results: DataFrame,
    lines: DataFrame,
    labels: Sequence[str],
    official_tests: Sequence[str],
    keys: Mapping[str, Column],
    rules: LabRules,
) -> DataFrame:
    """Coded results of these lines, pivoted per order line, official flag and ``keys``.

    Some of other lines may be among them, for the join with the lines that follows to drop. A line with long
    texts has several rows, for the merge that follows.
    """
    official = flag_official(F.col("commercial_test_code"), official_tests)
    return pivot_by_line(
        near_lines(results, lines, rules.filter_bits), tables["test_parameter"], labels,
        code_results(F.col("aggregated_value")), {"is_official": official, **keys}, merged=False,
    )


def mapped_lines(
    tables: Tables,
    window: ReportWindow,
    rules: LabRules,
    state: str | None = None,
    required: Sequence[str] = IDENTIFIED,
) -> DataFrame:
    """Finished lines whose item has mapped parameters, enriched."""
    lines = optional_filters(finished_lines(tables, window, rules), state=state)
    if required:
        lines = require_columns(lines, required)
    return lines.join(mapped_pairs(tables).select("commercial_item"), "commercial_item", "left_semi")


def mapped_results(
    tables: Tables,
    window: ReportWindow,
    lines: DataFrame,
    rules: LabRules,
    only: Sequence[str] | None = None,
) -> DataFrame:
    """Results of the lines for known parameters that are mapped to the line's item.

    The scan cuts the results to the lines. They get their line's item, and the small table of items and
    parameters cuts them again. They are then dealt by line, as the pivot and the join with what is shown
    of the lines want them. A line given twice would repeat results, which no maximum or distinct count
    shows. ``only`` drops other measures early; it may be given where a report keeps a row only if one of those measures is present, since
    the others then add nothing.
    """
    parameters = tables["test_parameter"]
    if only is not None:
        parameters = parameters.filter(text_in(F.col("test_parameter_name"), only))
    known = parameters.select(F.col("test_parameter_code").alias("commercial_parameter_code"))
    pairs = mapped_pairs(tables).join(known, "commercial_parameter_code", "left_semi")
    results = near_lines(results_until(tables["reportable_result"], window), lines, rules.filter_bits)
    if only is not None:
        results = results.join(known, "commercial_parameter_code", "left_semi")
    results = results.join(lines.select("commercial_order_line_id", "commercial_item"), "commercial_order_line_id")
    return results.join(pairs, ["commercial_item", "commercial_parameter_code"], "left_semi").drop("commercial_item")


def sheet_rows(
    tables: Tables,
    window: ReportWindow,
    rules: LabRules,
    lines: DataFrame,
    labels: Sequence[str],
    shown: Sequence[str | Column],
    flags: Mapping[str, Column],
    value: Column,
    only: Sequence[str] | None = None,
) -> DataFrame:
    """Mapped results in two stages: pivoted per line and flags, then with what is shown of the lines.

    ``shown`` are columns of the lines, ``flags`` columns of a result that keep rows apart. A line with long
    texts has several rows, for the merge that follows.
    """
    line, item = "commercial_order_line_id", "commercial_item"
    lines = report_lines(lines.select(line, *shown, F.col(item).alias(_ITEM)), rules)
    results = mapped_results(tables, window, lines.select(line, F.col(_ITEM).alias(item)), rules, only)
    measured = pivot_by_line(results, tables["test_parameter"], labels, value, flags, merged=False)
    return enrich_results(measured, lines.drop(_ITEM)).drop("commercial_order_line_id")


#: The result set of a line's technician test, as a key that keeps its rows apart from others.
TECHNICIAN_SET = "technician_set"


def technician_set(rules: LabRules) -> dict[str, Column]:
    """The key that ``measured_lines`` needs to keep them."""
    tested = F.col("commercial_parameter_code") == rules.technician_parameter
    return {TECHNICIAN_SET: F.when(tested, F.col("result_set_sequence_no"))}


def kept_technicians(measured: DataFrame, lines: DataFrame, tables: Tables, rules: LabRules) -> DataFrame:
    """(bar_code, operator_code) by the result sets kept in measured lines; lines have line ids and bar codes."""
    known = tables["test_parameter"].filter(F.col("test_parameter_code") == rules.technician_parameter)
    sets = measured.filter(F.col(TECHNICIAN_SET).isNotNull()).select(
        "commercial_order_line_id", F.col(TECHNICIAN_SET).alias("sequence_number"),
        F.lit(rules.technician_parameter).alias("test_parameter_code"),
    )
    return (
        sets.join(known, "test_parameter_code", "left_semi").join(lines, "commercial_order_line_id")
        .join(tables["result_set"], "sequence_number").select("bar_code", "operator_code")
    )


def with_technician(
    frame: DataFrame, tables: Tables, rules: LabRules, bar_codes: DataFrame
) -> DataFrame:
    """Adds ``lab_tech``, the operator of the bar code's technician test."""
    lines = report_lines(lines_of_samples(tables, bar_codes), rules)
    lookup = technicians(tables, rules.technician_parameter, lines, rules.filter_bits)
    return fill_from_lookup(
        with_text_null(frame, "lab_tech"), lookup, "bar_code", "operator_code", "lab_tech"
    )
