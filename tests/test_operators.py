"""Operators on the hand-made laboratory and on small frames."""

import pytest
from lab import AFTER, END, START, results, tables
from pyspark.sql import functions as F

from creamline.functions.dates import ReportWindow
from creamline.operators import aggregates, completion, filters, joins, pivots
from creamline.plans.rules import OFFICIAL_ITEMS
from creamline.sources.tables import parse_key_list


@pytest.fixture(scope="module")
def lab(spark):
    return tables(spark)


def ids(frame, column="id"):
    return sorted(r[0] for r in frame.select(column).collect())


def test_window_bounds(spark):
    rows = (results(1, ("a", "1"), at=START) + results(2, ("a", "1"), at=END)
            + results(3, ("a", "1")) + results(3, ("a", "1"), at=AFTER)
            + results(4, ("a", "1"), at=None))
    frame = tables(spark, reportable_result=rows)
    lines, facts = frame["commercial_order_line"], frame["reportable_result"]
    closed = completion.completed_in_window(facts, lines, ReportWindow(START, END, closed=True))
    opened = completion.completed_in_window(facts, lines, ReportWindow(START, END))
    assert ids(closed) == [1, 2]
    assert ids(opened) == [2]
    assert ids(completion.completed_in_window(facts, lines, ReportWindow(None, END))) == []


def test_expansion_brings_lines_from_outside_the_window(lab):
    eligible = completion.completed_in_window(
        lab["reportable_result"], lab["commercial_order_line"],
        ReportWindow(START, END, closed=True), "Completed")
    assert ids(eligible) == [1, 3, 6, 7, 8]  # line 4 has a later result, line 5 is pending
    expanded = completion.expand_to_samples(
        eligible, lab["commercial_order_line"], OFFICIAL_ITEMS, "Completed")
    assert ids(expanded) == [1, 2, 3, 6, 7, 8]


def test_groups_fan_out_but_slices_do_not(lab):
    lines = joins.enrich_lines(lab["commercial_order_line"], lab)
    assert joins.group_members(lab).count() == 4
    assert ids(filters.slice_by(lines, "producer group", "SOUTH", lab), "commercial_order_line_id") == [
        1, 2, 3, 4, 5, 6]
    assert filters.slice_by(lines, "Producer Group", "North", lab).count() == 5
    assert filters.slice_by(lines, "State Rep", "Rep", lab).count() == 8
    assert filters.slice_by(lines, "State", "MN", lab).count() == 5
    assert filters.slice_by(lines, "Other", "MN", lab).count() == 8


def test_null_region_is_in_neither_half(lab):
    inside = F.col("region").isin("MN")
    assert lab["producer"].filter(inside).count() + lab["producer"].filter(~inside).count() == 2


def test_mapped_results_ignore_repeated_mappings(lab):
    lines = lab["commercial_order_line"].withColumnRenamed("id", "commercial_order_line_id")
    rows = joins.restrict_to_mapped(joins.enrich_results(lab["reportable_result"], lines), lab)
    counts = rows.groupBy("commercial_item", "commercial_parameter_code").count().collect()
    assert {tuple(r) for r in counts} == {
        ("MVPQVP1", "UM0004ZH", 6), ("MVPQVP1", "Z001JJPC", 4), ("MVPQVP8", "JJ00047N", 1)}


def test_technician_is_single_and_optional(lab):
    lookup = joins.technicians(lab, "UM0004ZH")
    frame = lab["sample"].select("bar_code").withColumn("lab_tech", F.lit(None).cast("string"))
    filled = joins.fill_from_lookup(frame, lookup, "bar_code", "operator_code", "lab_tech")
    found = {r.bar_code[-2:]: r.lab_tech for r in filled.collect()}
    assert found == {"10": "Bob", "11": "Cy", "12": "Ann", "13": "Ann", "14": "Ann", "15": "Ann",
                     "16": "Ann"}
    nobody = joins.fill_from_lookup(
        frame, joins.technicians(lab, "AT"), "bar_code", "operator_code", "lab_tech")
    assert {r.bar_code[-2:]: r.lab_tech for r in nobody.collect()}["14"] is None
    assert nobody.count() == frame.count()


@pytest.mark.parametrize("listed", ["a,b", "a,b,", "a, b,a", ",,b,a"])
def test_key_list_forms(spark, listed):
    frame = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "bar_code string")
    kept = filters.restrict_to_keys(frame, parse_key_list(spark, listed), "bar_code")
    assert ids(kept, "bar_code") == ["a", "b", "b"]


def test_key_list_single_and_empty(spark):
    assert ids(parse_key_list(spark, "a"), "bar_code") == ["a"]
    assert parse_key_list(spark, None) is None
    assert parse_key_list(spark, " , ") is None


def test_results_of_lines_with_and_without_broadcast(spark, lab):
    lines = lab["commercial_order_line"].filter("id < 3").select(
        F.col("id").alias("commercial_order_line_id"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for bound in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
        try:
            own = joins.of_lines(lab["reportable_result"], lines.unionAll(lines))
            assert ids(own, "commercial_order_line_id") == [1] * 6 + [2] * 5
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_pivot_keys_names_and_text_maximum(spark):
    rows = [("s", "x", "Somatic Cells", "99"), ("s", "x", "somatic cells ", "100"),
            ("s", "y", "Other", "1"), (None, "x", "Fat", "2"), (None, "x", None, "3")]
    frame = spark.createDataFrame(
        rows, "sample string, flag string, test_parameter_name string, aggregated_value string")
    wide = pivots.pivot_results(frame, ["Somatic cells", "Fat"])
    assert wide.columns == ["sample", "flag", "Somatic cells", "Fat"]
    assert {tuple(r) for r in wide.collect()} == {
        ("s", "x", "99", None), ("s", "y", None, None), (None, "x", None, "2")}


def test_two_stage_pivot_equals_single_stage(lab):
    lines = joins.enrich_lines(lab["commercial_order_line"], lab).select(
        "commercial_order_line_id", "producer_code", "tank")
    labels = ["Bacteria Count", "Somatic cells"]
    value, keys = F.col("aggregated_value"), {"test": F.col("commercial_test_code")}
    staged = joins.enrich_results(
        pivots.pivot_by_line(lab["reportable_result"], lab["test_parameter"], labels, value, keys),
        lines).drop("commercial_order_line_id")
    staged = pivots.merge_pivoted(staged, labels)
    named = joins.name_parameters(
        joins.enrich_results(lab["reportable_result"], lines), lab["test_parameter"])
    single = pivots.pivot_results(
        named.select("producer_code", "tank", F.col("commercial_test_code").alias("test"),
                     "test_parameter_name", "aggregated_value"), labels)
    assert set(staged.select(single.columns).collect()) == set(single.collect())


def test_collapse_keeps_one_row_per_key(spark):
    frame = spark.createDataFrame(
        [("k", "99", None), ("k", "100", "b"), ("l", None, None)], "key string, v string, w string")
    assert {tuple(r) for r in aggregates.collapse_by_key(frame, ["key"]).collect()} == {
        ("k", "99", "b"), ("l", None, None)}


def test_concatenations(spark):
    frame = spark.createDataFrame([("k", "b"), ("k", "a"), ("k", "b"), ("k", None)], "key string, v string")
    assert aggregates.concat_all(frame, ["key"], ["v"]).first().v == "a,b,b"
    both = frame.withColumn("w", F.lit("x"))
    assert aggregates.concat_all(both, ["key"], ["v", "w"]).first()[:] == ("k", "a,b,b", "x,x,x,x")
    assert frame.groupBy("key").agg(aggregates.concat_distinct(F.col("v"))).first()[1] == "a,b"


@pytest.fixture(scope="module")
def measured(spark):
    rows = [
        ("P1", "d", "b1", "A", "1", "MN", "Y", "10"), ("P1", "d", "b2", "B", "2", "MN", "Y", "11"),
        ("P1", "d", "b3", "C", "3", "MN", "N", "90"), ("P2", "d", "b4", "A", "4", "IA", "Y", "99"),
        ("P2", "d", "b4", "A", "4", "IA", "Y", "100"), ("P2", "d", "b5", "A", "", "IA", "Y", "1"),
        ("P3", "d", "b6", "A", "6", None, "Y", "1"), ("P4", "d", "b7", "A", "7", "wi ", "Y", ""),
    ]
    return spark.createDataFrame(
        rows, "producer_code string, sampling_date string, bar_code string, tank string, seq string,"
              " region string, is_official string, m string")


def test_average_or_collapse(measured):
    rows = aggregates.average_or_collapse(measured, ["MN", "WI"], ["m"]).collect()
    found = {(r.producer_code, r.tank, r.seq, r.bar_code, r.m) for r in rows}
    # P1's mean leaves the unofficial row out, its tank stays; 10.5 rounds up; blank text is zero.
    assert found == {("P1", "A,B,C", "1,2,3", "b2", "11"), ("P2", "A", "4", "b4", "99"),
                     ("P4", "A", "7", "b7", "0")}


def test_halves_are_disjoint(measured):
    rows = aggregates.average_or_collapse(measured, ["MN", "WI"], ["m"])
    assert rows.select("bar_code").distinct().count() == rows.count()


@pytest.fixture(scope="module")
def gaps(spark):
    rows = [(1, "W1", "t", 1.0, "2018-10-01"), (2, "n/a ", "t", 1.0, "2018-10-01"),
            (3, None, "", 1.0, "2018-10-01"), (4, "", None, 1.0, "2018-10-01"),
            (5, "W1", "t", None, "2018-10-01"), (6, "W1", "t", 1.0, "1900-01-01"),
            (7, "W1", "t", 1.0, None)]
    frame = spark.createDataFrame(rows, "id int, billing_week string, t string, n double, d string")
    return frame.withColumn("sampling_date", F.to_date("d"))


def test_complete_and_incomplete_overlap_and_cover(gaps):
    complete = ids(filters.find_complete(gaps, ["t", "n", "sampling_date"]))
    incomplete = ids(filters.find_incomplete(gaps, ["t"], ["n"]))
    assert complete == [1, 3, 6]
    assert incomplete == [2, 3, 4, 5, 6, 7]
    assert set(complete) | set(incomplete) == set(range(1, 8))


def test_presence_filters(spark):
    rows = [(1, "x", None), (2, None, "p"), (3, None, ""), (4, None, None), (5, "", "")]
    frame = spark.createDataFrame(rows, "id int, g string, p string")
    assert ids(filters.any_present(frame, ["g", "p"])) == [1, 2, 3, 5]
    assert ids(filters.any_present_or_blank(frame, ["g", "p"], "p")) == [1, 2, 5]
    assert ids(filters.all_present(frame, ["g", "p"])) == [5]


def test_threshold(spark):
    rows = [(1, "750"), (2, "751"), (3, "NF"), (4, ""), (5, None)]
    frame = spark.createDataFrame(rows, "id int, m string")
    assert [tuple(r) for r in filters.threshold_alert(frame, "m", 750).collect()] == [
        (2, 751000), (3, None)]  # a count that cannot be read may be above any limit


def test_totals_and_counts(spark):
    frame = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "bar_code string")
    assert aggregates.count_tests(frame).first()[0] == 2
    assert aggregates.report_totals(frame, F.lit("now")).first()[:] == (4, "now")
