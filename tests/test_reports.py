"""Reports on the hand-made laboratory, sources, sinks and plan shapes."""

import re
from datetime import date, datetime

import pytest
from lab import CELLS, FULL, ROWS, results, tables
from pyspark.sql import functions as F

from creamline.catalog import QUERIES
from creamline.plans import alerts, feeds, legacy, official, records, redtag, sheets
from creamline.plans.rules import LabRules
from creamline.sources.shared import SharedTables
from creamline.schemas import SCHEMAS
from creamline.functions.dates import between_dates
from creamline.operators.completion import completed_in_window
from creamline.sources.retail import lab_tables
from creamline.sources.sinks import save_bucketed, write_report
from creamline.sources.tables import load_tables, with_bucketed

FIRST, LAST = date(2018, 10, 1), date(2018, 10, 10)
NOW = datetime(2018, 10, 10, 12)


@pytest.fixture(scope="module")
def lab(spark):
    return tables(spark)


def test_official_modes(lab):
    complete = official.official_report(lab, FIRST, LAST).collect()
    assert [(r.ProducerCode, r.Tank, r["Bacteria Count"], r["Lab Tech"]) for r in complete] == [
        ("P1", "A,B", "65", "Cy")]  # '99' is the greater text than '100'; 64.5 rounds up
    assert complete[0].Isofficial == "Y" and complete[0].SamplingTime == date(2018, 10, 1)
    gaps = official.official_report(lab, FIRST, LAST, mode="ALL").collect()
    assert [r.Barcode[-2:] for r in gaps] == ["14"]
    raw = official.official_report(lab, FIRST, LAST, mode="raw").collect()
    assert sorted((r.Barcode[-2:], r["Bacteria Count"]) for r in raw) == [
        ("10", "99"), ("11", "30"), ("14", "12"), ("16", "99")]
    sliced = official.official_report(lab, FIRST, LAST, "State", "IA", mode="all").collect()
    assert [r.Barcode[-2:] for r in sliced] == ["14"]
    assert official.official_report(lab, None, LAST, mode="raw").count() == 0


def test_official_sheet(lab):
    row = records.official_sheet(official.official_report(lab, FIRST, LAST)).first()
    assert (row.SamplingTime, row["Freezing Point"]) == ("10/01/2018", "-0.530")


def test_alert(spark):
    rows = results(1, *FULL[1:], ("UM0004ZH", "800")) + results(3, *FULL)
    lab = tables(spark, reportable_result=rows)
    rules = LabRules(alert_region="MN")
    found = alerts.immediate_response(lab, "bacteria count", 30, NOW, "State", "MN", rules)
    assert [(r.Barcode[-2:], r["Bacteria Count"]) for r in found.collect()] == [("10", 800000)]
    assert records.alert_sheet(found).first()["Bacteria Count"] == "800,000"
    assert alerts.immediate_response(lab, "Somatic Cells", 30, NOW, "State", "MN", rules).count() == 0


def test_red_tag_sections(spark):
    extra = [
        *results(1, ("PR", "")), *results(3, ("PR", "found")), *results(4, ("XX", "1")),
    ]
    lab = tables(spark, reportable_result=extra)
    def bars(section, **kw):
        found = redtag.red_tag(lab, section, "co18-08-1", 30, NOW, **kw).collect()
        return sorted(r.Barcode[-2:] for r in found)
    assert bars("all") == ["10", "11", "12"]
    assert bars("cultures") == ["11"]
    assert bars("bacteria") == bars("components") == []
    assert bars("all", bar_codes="00000000000010") == ["10"]
    assert redtag.red_tag(lab, "all", None, 30, NOW).count() == 0
    assert redtag.red_tag(lab, "all", "CO18-08-1", 0, NOW).count() == 0


def test_red_tag_datasets_are_written(lab, tmp_path):
    datasets = redtag.red_tag_datasets(lab, "CO18-08-1", 30, NOW)
    assert list(datasets) == ["all", "components", "bacteria", "cultures"]
    written = write_report(datasets, str(tmp_path))
    spark = lab["sample"].sparkSession
    assert len(written) == 4
    assert spark.read.parquet(written[0]).count() == datasets["all"].count()
    assert "Bacteria Count(PI)" in spark.read.parquet(written[2]).columns


def test_feed_rows_split_by_flags(spark):
    """The inhibitor result stays in a row of its own, so the record shows an untested sample."""
    lab = tables(
        spark,
        commercial_item_test_parameter_map=[
            ("MVPQVP1", p) for p in ("UM0004ZH", "Z001JJPC", CELLS, "FP")],
        test_parameter=[("UM0004ZH", "Bacteria"), ("Z001JJPC", "Delvo Inhibitor"),
                        (CELLS, "Somatic cells"), ("FP", "Freezing point")],
    )
    goat = feeds.goat_feed(lab, 30, NOW).collect()
    assert {(r.ProducerCode, r.IHB, r["Anti #"]) for r in goat} == {("P1", "NT", "0"), ("P2", "NT", "0")}
    assert {r.IHB for r in sheets.dairy_sheet(lab, 30, NOW).collect()} == {"NT", "NF", "AL"}
    wisconsin = records.wisconsin_record(feeds.wisconsin_feed(lab, 30, NOW)).collect()
    assert {(r["Somatic cells"], r.Grade) for r in wisconsin} == {("0200", "N/A"), (None, "N/A")}
    tennessee = feeds.tennessee_feed(lab, 30, NOW, plate_count="575").first()
    assert tennessee["SPC Reported (x1000)"] == "575"
    assert feeds.goat_feed(lab, 30, NOW, test_dates=False).first().TestDate == "00000000"


def test_legacy_lists_repeats(lab):
    rows = legacy.legacy_official(lab, "lab", 30, NOW).collect()
    assert {(r.Barcode[-2:], r.Tank) for r in rows} == {
        ("10", "A,B"), ("11", "A,B"), ("14", "A")}
    state = legacy.legacy_official(lab, "state", 30, NOW).collect()
    assert {(r.ProducerCode, r.Tank) for r in state} == {
        ("P1", "A"), ("P1", "B"), ("P2", "A"), ("P3", "C")}


@pytest.mark.parametrize("file_format", ["parquet", "orc"])
def test_tables_round_trip(spark, lab, tmp_path, file_format):
    for name, frame in lab.items():
        frame.write.format(file_format).save(f"{tmp_path}/{name}")
    loaded = load_tables(spark, str(tmp_path), file_format=file_format)
    assert set(loaded) == set(SCHEMAS)
    for name, frame in lab.items():
        assert sorted(map(str, loaded[name].collect())) == sorted(map(str, frame.collect()))


def test_reference_tables_may_live_elsewhere(spark, lab, tmp_path):
    for name, frame in lab.items():
        place = "b" if name in ("commercial_item", "commercial_item_test_parameter_map",
                                "test_parameter") else "a"
        frame.write.parquet(f"{tmp_path}/{place}/{name}")
    loaded = load_tables(spark, f"{tmp_path}/a", reference_path=f"{tmp_path}/b")
    assert loaded["test_parameter"].count() == len(ROWS["test_parameter"])


def test_csv_record(lab, tmp_path, spark):
    feed = official.official_report(lab, FIRST, LAST)
    target, = write_report(feed, str(tmp_path), "csv")
    back = spark.read.option("header", True).csv(target)
    assert back.columns == feed.columns and back.count() == 1


SF = "/root/testdata/sf0.001"


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def final_plan_of(frame) -> str:
    frame.collect()
    return plan_of(frame)


@pytest.mark.parametrize("name", ["official_report_complete", "immediate_response_bacteria",
                                  "red_tag_all", "goat_feed", "legacy_official_lab"])
def test_no_cross_joins_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in plan


def test_official_pivot_is_shuffled_once(spark):
    plan = final_plan_of(QUERIES["average_or_collapse"](spark, SF))
    assert "ReusedExchange" in plan


@pytest.mark.parametrize("name", ["official_report_raw", "immediate_response_bacteria", "red_tag_all",
                                  "goat_feed", "dairy_sheet", "legacy_official_state"])
def test_results_are_cut_to_the_lines_before_anything_else(spark, name):
    """In the plan that ran, each scan of raw results is the completion's or has the run-time filter of the lines."""
    plan = final_plan_of(QUERIES[name](spark, SF)).split("Initial Plan")[0]
    lines = plan.split("\n")
    depth = [len(line) - len(line.lstrip(" :+-|")) for line in lines]
    seen = with_filter = 0
    for at, line in enumerate(lines):
        if "Generate explode(" not in line:
            continue
        above, level = [], depth[at]
        for k in range(at - 1, -1, -1):
            if depth[k] < level:
                above.append(lines[k])
                level = depth[k]
        below = next((k for k in range(at + 1, len(lines)) if depth[k] <= depth[at]), len(lines))
        cut = any("Filter" in x and "ubquery" in x for x in lines[at:below])
        first = next(x for x in above if re.search(r"Aggregate|Join|Exchange", x))
        assert cut or "max(result_validation_date" in first, first
        seen += 1
        with_filter += cut
    assert with_filter and seen


def test_filters_reach_the_scan(spark, lab, tmp_path):
    for name, frame in lab.items():
        frame.write.parquet(f"{tmp_path}/{name}")
    loaded = load_tables(spark, str(tmp_path))
    plan = plan_of(official.official_report(loaded, FIRST, LAST))
    assert "GreaterThanOrEqual(result_validation_date" in plan
    assert "IsNotNull(tank)" in plan
    technician = "EqualTo(commercial_parameter_code,UM0004ZH)"
    assert technician not in plan  # technicians come from the scan of the measures
    assert technician in plan_of(alerts.immediate_response(loaded, "Bacteria Count", 30, NOW))


def test_bucketed_results_are_not_shuffled(spark, lab, tmp_path):
    for name, frame in lab.items():
        frame.write.parquet(f"{tmp_path}/plain/{name}")
    loaded = load_tables(spark, f"{tmp_path}/plain")
    stored = with_bucketed(loaded, spark, save_bucketed(loaded, f"{tmp_path}/stored", 4))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        window = between_dates(FIRST, LAST)
        done = completed_in_window(
            stored["reportable_result"], stored["commercial_order_line"], window, "Completed")
        assert "Exchange" not in plan_of(done)
        assert sorted(r.id for r in done.collect()) == [1, 3, 6, 7, 8]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    rows = official.official_report(stored, FIRST, LAST, mode="raw").collect()
    assert rows == official.official_report(lab, FIRST, LAST, mode="raw").collect()


def shuffled_bytes(spark) -> int:
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    executors = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(executors.apply(k).totalShuffleWrite() for k in range(executors.size()))


def test_shuffles_follow_the_window_and_not_the_history(spark):
    """Six times the history, the same few days: what a report shuffles stays about the same."""
    source = lab_tables(spark, SF.replace("sf0.001", "sf0.01"))
    tables = {name: source[name] for name in SCHEMAS}
    facts = tables["reportable_result"]
    older = [
        facts.withColumn("commercial_order_line_id", F.col("commercial_order_line_id") + k * 10**9)
        .withColumn("result_validation_date", F.expr(f"result_validation_date - INTERVAL {8 * k} YEARS"))
        for k in range(1, 6)
    ]
    long = facts
    for part in older:
        long = long.unionAll(part)
    now, rules, moved, rows = datetime(1996, 6, 10, 12), LabRules(feed_state=None), [], []
    for history in (facts, long):
        before = shuffled_bytes(spark)
        sheet = sheets.inspector_wide(tables | {"reportable_result": history}, 7, now, rules)
        rows.append(sorted(map(str, sheet.collect())))
        moved.append(shuffled_bytes(spark) - before)
    assert rows[0] == rows[1] and rows[0]
    assert moved[1] < 1.3 * moved[0]


def test_same_rows_however_the_lines_are_held_and_cut(spark, lab):
    """Shared or computed by each reader, and with a filter so small that it lets nearly all results through."""
    others = [LabRules(shared=None), LabRules(filter_bits=64), LabRules(shared=SharedTables(most=1))]
    for build in (
        lambda rules: official.official_report(lab, FIRST, LAST, mode="raw", rules=rules),
        lambda rules: redtag.red_tag(lab, "all", "CO18-08-1", 30, NOW, rules=rules),
        lambda rules: sheets.dairy_sheet(lab, 30, NOW, rules),
    ):
        rows = [sorted(map(str, build(rules).collect())) for rules in (LabRules(), *others)]
        assert rows[0] and all(other == rows[0] for other in rows[1:])


@pytest.mark.parametrize(("name", "columns"), [
    ("official_report_complete", official.SORT), ("official_report_raw", official.SORT),
    ("red_tag_all", ("ProducerCode", "Tank", "SamplingTime")),
    ("immediate_response_bacteria", ("ProducerCode", "SamplingTime", "TestDate")),
    ("legacy_official_lab", official.SORT),
])
def test_reports_come_sorted(spark, name, columns):
    rows = [tuple((r[c] is not None, r[c]) for c in columns) for r in QUERIES[name](spark, SF).collect()]
    assert rows == sorted(rows) and len(rows) > 1


def test_report_columns_keep_their_types(lab):
    kinds = dict(official.official_report(lab, FIRST, LAST).dtypes)
    assert (kinds["SamplingTime"], kinds["Sample Temp"], kinds["Bacteria Count"]) == ("date", "decimal(9,2)", "string")
    alert = dict(alerts.immediate_response(lab, "Bacteria Count", 30, NOW).dtypes)
    assert (alert["Bacteria Count"], alert["TestDate"]) == ("int", "date")
    goat = dict(feeds.goat_feed(lab, 30, NOW).dtypes)
    assert goat["SamplingTime"] == "timestamp_ntz" and goat["TemperatureAtSampling"] == "decimal(9,2)"
