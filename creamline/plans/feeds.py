"""Electronic records for a goat milk client and three states.

Flags that differ between the results of one sample keep its rows apart, and the rows without a cell
count then drop out. The records therefore carry the flags of the counting tests, as they always did.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creamline.functions.coding import (
    INHIBITOR_PARAMETER,
    antibiotic_flag,
    grade_or_zero,
    inhibitor_flag,
    official_by_item,
)
from creamline.functions.dates import clock_text, days_from_now, tested_at
from creamline.functions.text import seq_middle
from creamline.operators.filters import require_columns
from creamline.operators.joins import Tables
from creamline.operators.layout import feed_layout
from creamline.operators.pivots import merge_pivoted
from creamline.plans.rules import (
    CELL_COUNT_PARAMETER,
    COUNT_MEASURES,
    DEFAULT_RULES,
    FEED_MEASURES,
    TECHNICIAN_PARAMETER,
    LabRules,
)
from creamline.plans.sheets import KEYS
from creamline.plans.steps import mapped_lines, sheet_rows

CELLS, FREEZING = "Somatic cells", "Freezing point"

_VALUE = "aggregated_value"
_PARAMETER = "commercial_parameter_code"
_ITEM = "commercial_item"
_INHIBITOR = "inhibitor_result"


def _tested() -> Column:
    return tested_at(F.col("result_validation_date"), F.col("result_measured_time"))


def _tested_for(parameter: str, only: bool) -> Column:
    """Test time of a result; with ``only`` it is left empty for other parameters."""
    return F.when(F.col(_PARAMETER) == parameter, _tested()) if only else _tested()


def feed_rows(
    tables: Tables,
    days: float,
    now: datetime | None,
    rules: LabRules,
    shown: Sequence[str | Column],
    flags: Mapping[str, Column],
    measures: Sequence[str],
    needed: Sequence[str],
    late: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Pivoted rows of one feed. ``shown`` columns of the line and ``flags`` of a result are keys.

    ``late`` flags need both a line and a result flag; they take the place of the columns they use.
    """
    window = days_from_now(days, now)
    lines = mapped_lines(tables, window, rules, rules.feed_state)
    columns = ["producer_code", "tank", seq_middle(F.col("bar_code")).alias("seq"), "bar_code",
               "visit_number", "sampling_time", *shown]
    rows = sheet_rows(tables, window, rules, lines, measures, columns, flags, F.col(_VALUE), only=measures)
    if late:
        rows = rows.withColumns(late).drop(_ITEM, _INHIBITOR)
    return require_columns(merge_pivoted(rows, measures), [*KEYS, *needed], filled=["seq"])


def goat_feed(
    tables: Tables,
    days: float = 90,
    now: datetime | None = None,
    rules: LabRules = DEFAULT_RULES,
    test_dates: bool = True,
) -> DataFrame:
    """Client record. Without ``test_dates`` both dates print as zeros."""
    value, parameter = F.col(_VALUE), F.col(_PARAMETER)
    derived = {
        "IHB": inhibitor_flag(value, parameter, "NF", "AL", "NT"),
        "Anti #": inhibitor_flag(value, parameter, "2", "1", "0"),
    }
    official = official_by_item(F.col(_ITEM), "99", None).alias("Official")
    if test_dates:
        derived |= {"TestDate": _tested(), "CompTestDate": _tested()}
    rows = feed_rows(tables, days, now, rules, ["temperature_at_sampling", official],
                     derived, FEED_MEASURES, [CELLS, FREEZING])
    col = F.col
    return feed_layout(rows, {  # fixed values: record fields and fillers, in order
        "DSI Company": "01", "DSI Division": "141", "ProducerCode": col("producer_code"),
        "Load": "", "Fixed1": "0", "SamplingTime": col("sampling_time"),
        "TestDate": col("TestDate") if test_dates else "00000000",
        "Official": col("Official"), "Fat": col("Fat"), "True Protein": col("True Protein"),
        "Lactose": col("Lactose"), "Solids not fat (SNF)": col("Solids not fat (SNF)"),
        "Total Solids": "", CELLS: col(CELLS),
        "TemperatureAtSampling": col("temperature_at_sampling"), "Bacteria": col("Bacteria"),
        FREEZING: col(FREEZING), "Water": "00.00", "Blank1": "", "IHB": col("IHB"), "Sedi": "",
        "Blank2": "", "Tank": col("tank"), "Blank3": "", "Fixed Lab": rules.lab_code,
        "Coliforms": col("Coliforms"), "Lab Pasteurized Count": col("Lab Pasteurized Count"),
        "Pre-incubation Count (PI)": col("Pre-incubation Count (PI)"), "Blank4": "",
        "seq": col("seq"), "Sample ID ?": "",
        "Milk Urea Nitrogen (MUN)": col("Milk Urea Nitrogen (MUN)"), "Fixed2": "0",
        "Anti #": col("`Anti #`"), "Fixed3": "0",
        "CompTestDate": col("CompTestDate") if test_dates else "00000000", "Fixed4": "0",
    })


def minnesota_feed(
    tables: Tables,
    days: float = 90,
    now: datetime | None = None,
    rules: LabRules = DEFAULT_RULES,
    need_freezing_point: bool = False,
    test_dates: bool = True,
) -> DataFrame:
    """State record. The printed form also asks for a freezing point.

    Without ``test_dates`` both dates are zeros and the last columns go by the names of that form.
    """
    derived = {
        "IHB": inhibitor_flag(F.col(_VALUE), F.col(_PARAMETER), "2", "1", "0", other_is_null=True),
    }
    if test_dates:
        derived |= {"SccTestDate": _tested(), "SpcTestDate": _tested()}
    measures = [*COUNT_MEASURES, FREEZING] if need_freezing_point else COUNT_MEASURES
    rows = feed_rows(
        tables, days, now, rules,
        ["state", "producer_name", "state_rep", "grade", "temperature_at_sampling",
         grade_or_zero(F.col("grade")).alias("MilkGrade")],
        derived, measures, [CELLS, FREEZING] if need_freezing_point else [CELLS],
    )
    col = F.col
    if test_dates:
        dates = {"SccTestDate": col("SccTestDate"), "SpcTestDate": col("SpcTestDate")}
    else:
        dates = {"ESCC Date": "00000000", "PLC Date": "00000000"}
    return feed_layout(rows, {  # fixed values: record fields and fillers, in order
        "ProducerCode": col("producer_code"), "SamplingTime": col("sampling_time"),
        "TemperatureAtSampling": col("temperature_at_sampling"), CELLS: col(CELLS),
        "Bacteria": col("Bacteria"), "IHB": col("IHB"), "ST#": "00", "Plant BTU#": "000",
        "FIXED(5)": "00000", "Fixed(1)": "0", **dates, "FIXED(6)": "000000",
        "FIXED(8)": "00000000", "MilkGrade" if test_dates else "Grade": col("MilkGrade"),
    })


def wisconsin_feed(
    tables: Tables,
    days: float = 90,
    now: datetime | None = None,
    rules: LabRules = DEFAULT_RULES,
    dates_per_test: bool = False,
) -> DataFrame:
    """State record. With ``dates_per_test`` a row has only the date of its own test."""
    derived = {
        "SccTestDate": _tested_for(CELL_COUNT_PARAMETER, dates_per_test),
        "SpcTestDate": _tested_for(TECHNICIAN_PARAMETER, dates_per_test),
        _INHIBITOR: F.col(_PARAMETER) == INHIBITOR_PARAMETER,
    }
    anti = F.when(F.col(_INHIBITOR), INHIBITOR_PARAMETER).otherwise("")
    rows = feed_rows(
        tables, days, now, rules,
        ["route_number", "state", "producer_name", "state_rep", "grade", "temperature_at_sampling",
         _ITEM],
        derived, COUNT_MEASURES, [CELLS], late={"Anti": antibiotic_flag(F.col(_ITEM), anti)},
    )
    col = F.col
    return feed_layout(rows, {  # fixed values: record fields and fillers, in order
        "Fixed1": "7", "Fixed2": "1", "Fixed3": "3", "PlantNum": "4100",
        "ProducerCode": col("producer_code"), "SamplingTime": col("sampling_time"),
        "Fixed4": "1", "LabNum": "7134", "TemperatureAtSampling": col("temperature_at_sampling"),
        "Fixed5": "1", "Bacteria": col("Bacteria"), CELLS: col(CELLS), "Anti": col("Anti"),
        "Fixed6": "0", "Fixed7": "00000000", "Fixed8": "0", "Grade": col("grade"),
        "SccTestDate": col("SccTestDate"), "SpcTestDate": col("SpcTestDate"), "Fixed9": "000",
        "Fixed10": "ELECTRONIC",
    })


def tennessee_feed(
    tables: Tables,
    days: float = 90,
    now: datetime | None = None,
    rules: LabRules = DEFAULT_RULES,
    plate_count: str | None = None,
) -> DataFrame:
    """State record. ``plate_count`` replaces the measured plate count by a constant."""
    derived = {"IHB": inhibitor_flag(F.col(_VALUE), F.col(_PARAMETER), "NF", "AL", "NT")}
    rows = feed_rows(
        tables, days, now, rules,
        ["route_number", "state", "producer_name", "state_rep", "grade", "temperature_at_sampling"],
        derived, FEED_MEASURES, [CELLS, FREEZING],
    )
    col = F.col
    spc = col("Bacteria") if plate_count is None else plate_count
    return feed_layout(rows, {  # fixed values: record fields and fillers, in order
        "Lab Number": "27-B-00134", "Division": "", "Member": col("producer_code"),
        "Tank": col("tank"), "Permit": "T54048", "Producer Name": col("producer_name"),
        "Class": "", "Pickup Date": col("sampling_time").cast("date"),
        "Pickup Time": clock_text(col("sampling_time")), "Recd Date": "00/00/00",
        "Temp-F": col("temperature_at_sampling"), "SPC (x1000)": spc,
        "SPC Reported (x1000)": spc, "SPC Source": "BSC", CELLS: col(CELLS),
        "AB Delvo 5 Pack": col("IHB"), "Sedi": "", "FreezePoint": col(FREEZING),
        "BTU": "47-167", "Route": col("route_number"), "Load": "",
    })
