"""Aggregations whose shuffles and spills follow the order lines, not their results."""

import re

import pytest
from pyspark.sql import functions as F

from creamline.catalog import QUERIES
from creamline.functions.text import is_short, number_text, text_number
from creamline.operators import aggregates, joins, pivots, runtime_filter
from creamline.sources import retail

SF = "/root/testdata/sf0.001"
TEXTS = ["", "0", "99", "100", "1250", ">3000", "NF", "1234567", "12345678", "a\0", "a", "a\0b", "é", "zé", "zzzzzé", "zzzzzzé", "\x7f", "\U0001f95b"]


def test_short_texts_as_numbers_sort_like_texts(spark):
    frame = spark.createDataFrame([(t,) for t in [*TEXTS, None]], "t string")
    rows = frame.select("t", text_number(F.col("t")).alias("n"), is_short(F.col("t")).alias("short")).withColumn("back", number_text(F.col("n"))).collect()
    short = [r for r in rows if r.short]
    assert {r.t for r in short} == {t for t in TEXTS if len(t.encode()) <= 7 and t[:1] < "\x80"}
    assert all(r.back == r.t for r in short) and all(r.n is None for r in rows if not r.short)
    assert [r.t for r in sorted(short, key=lambda r: r.n)] == sorted((r.t for r in short), key=str.encode)


@pytest.mark.parametrize("merged", [True, False])
def test_pivot_of_short_and_long_texts(spark, merged):
    rows = [(i % 5, label, text) for i, text in enumerate(TEXTS * 3) for label in ("Fat", "fat ", "Lactose", "Other")]
    rows += [(7, "Fat", None), (8, "Other", "x"), (None, "Fat", "longer than seven"), (None, "Fat", "zz"), (None, "Lactose", "9")]
    frame = spark.createDataFrame(rows, "line int, test_parameter_name string, aggregated_value string")
    wide = pivots.pivot_results(frame, ["Fat", "Lactose"], merged=merged)
    assert wide.columns == ["line", "Fat", "Lactose"]
    found = wide.collect()
    assert not merged or len(found) == 8
    expected = {}
    for line, label, text in rows:
        own = expected.setdefault(line, {"Fat": None, "Lactose": None})
        name = label.rstrip().capitalize()
        if name in own and text is not None and (own[name] is None or text.encode() > own[name].encode()):
            own[name] = text
    got = {(r.line, r.Fat, r.Lactose) for r in pivots.merge_pivoted(wide, ["Fat", "Lactose"]).collect()}
    assert got == {(line, own["Fat"], own["Lactose"]) for line, own in expected.items()}


@pytest.mark.parametrize("name", ["threshold_alert", "official_report_raw", "official_sheet", "collapse_by_key", "stored_inspector_report"])
def test_results_are_not_sorted_before_they_are_pivoted(spark, name):
    frame = QUERIES[name](spark, SF)
    frame.collect()
    lines = frame._jdf.queryExecution().executedPlan().toString().split("\n")
    pivoted = [line for line in lines if re.search(r"Aggregate.*partial_max\(CASE WHEN \(_label", line)]
    assert pivoted and all("HashAggregate" in line and "ObjectHash" not in line for line in pivoted)


def test_lines_by_parameter(spark):
    known = [(f"P{n:03}", f"name {n % 90}") for n in range(100)] + [("P003", "second name"), ("Q", None), (None, "none")]
    rows = [(line, f"P{(line * 7 + k) % 120:03}") for line in range(40) for k in range(30)] * 2
    rows += [(None, "P001"), (1, None), (2, None), (None, "only without a line"), (3, "Q"), (4, "Q"), (4, "Q")]
    results = spark.createDataFrame(rows, "commercial_order_line_id long, commercial_parameter_code string")
    names = spark.createDataFrame(known, "test_parameter_code string, test_parameter_name string")
    found = {tuple(r) for r in aggregates.lines_by_parameter(results, names).collect()}
    expected = {}
    for line, code in rows:
        for name in [n for c, n in known if c == code and c is not None] or [None]:
            expected.setdefault((code, name), set()).update([line] if line is not None else [])
    assert found == {(*key, len(lines)) for key, lines in expected.items() if lines}


def test_results_scan_deals_no_line_with_each_of_its_parameters(spark):
    plan = QUERIES["results_scan"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    assert not [keys for keys in dealt if "commercial_order_line_id" in keys and "test_parameter_name" in keys]


def test_samples_and_results_by_name(spark):
    known = [(f"P{n:03}", f"name {n % 90}") for n in range(100)] + [("P003", "second name"), ("Q", None), (None, "none")]
    lines = [(line, "ab"[line % 2], None if line % 5 == 0 else f"R{line % 3}", None if line % 7 == 0 else f"B{line // 3}") for line in range(60)]
    rows = [(line, f"P{(line * 7 + k) % 120:03}", TEXTS[(line + k) % len(TEXTS)]) for line in range(65) for k in range(30)] * 2
    rows += [(None, "P001", "x"), (1, None, "x"), (2, None, None), (3, "Q", "zzzzzzzzz"), (4, "Q", None), (7, "unmeasured elsewhere", "1")]
    results = spark.createDataFrame(rows, "commercial_order_line_id long, commercial_parameter_code string, aggregated_value string")
    names = spark.createDataFrame(known, "test_parameter_code string, test_parameter_name string")
    shown = spark.createDataFrame(lines, "commercial_order_line_id long, client_name string, region string, bar_code string")
    keys = ["client_name", "region"]
    by_code = aggregates.results_by_code(joins.enrich_results(results, shown), [*keys, "commercial_parameter_code"])
    named = joins.name_parameters(by_code, names).groupBy(*keys, "test_parameter_name").agg({"results": "sum", "greatest_text": "max"})
    samples = {tuple(r)[:3]: r.samples for r in aggregates.samples_by_name(results, shown, names, keys).collect()}
    found = {tuple(r)[:3]: (r["sum(results)"], samples.pop(tuple(r)[:3], 0), r["max(greatest_text)"]) for r in named.collect()}
    expected = {}
    own = {line: rest for line, *rest in lines}
    for line, code, text in rows:
        for name in [n for c, n in known if c == code and c is not None] or [None]:
            if line in own:
                *key, bar_code = own[line]
                expected.setdefault((*key, name), []).append((bar_code, text))
    assert not samples and found == {
        key: (len(own), len({b for b, _ in own if b is not None}), max((t for _, t in own if t is not None), key=str.encode, default=None))
        for key, own in expected.items()
    }


def test_enriched_results_deals_no_sample_with_each_of_its_parameters(spark):
    plan = QUERIES["enriched_results"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    assert dealt and not [keys for keys in dealt if "bar_code" in keys and ("test_parameter_name" in keys or "parameter_code" in keys)]
    assert not re.findall(r"SortAggregate\([^\n]*max\(aggregated_value", plan)


def test_halves_of_the_official_report_read_the_pivot_where_it_is_kept(spark):
    frame = QUERIES["official_report_complete"](spark, SF)
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    kept = re.findall(r"InMemoryRelation \[is_official#\d+, result_validation_date", plan)
    assert len(kept) == 2


def test_filter_grows_with_its_keys(spark):
    keys = spark.range(0, 40_000, 2)
    few = runtime_filter.key_bits(keys.filter("id < 100"), ["id"], 1 << 12, grows=True).first().words
    many = runtime_filter.key_bits(keys, ["id"], 1 << 12, grows=True).first().words
    assert len(few) == (1 << 12) // 64 and len(many) >= 20_000 * runtime_filter.BITS_A_KEY // 64
    others = spark.range(1, 40_000, 2)
    wanted = runtime_filter.may_be_wanted(keys, ["id"], 1 << 12, grows=True)
    assert keys.filter(wanted).count() == 20_000 and others.filter(wanted).count() < 2_000
    assert others.filter(runtime_filter.may_be_wanted(keys.limit(0), ["id"], 1 << 12, grows=True)).count() == 0


def test_filter_of_very_many_keys_stays_small(spark, monkeypatch):
    monkeypatch.setattr(runtime_filter, "_CHUNK", 64)
    keys, most = spark.range(0, 200_000, 2), 1 << 17
    assert runtime_filter.MOST_BITS <= 1 << 26  # through the driver and to every task of a scan
    monkeypatch.setattr(runtime_filter, "MOST_BITS", most)  # 1.3 bits a key
    assert len(runtime_filter.key_bits(keys, ["id"], 1 << 12, grows=True).first().words) == most // 64
    wanted = runtime_filter.may_be_wanted(keys, ["id"], 1 << 12, grows=True)
    others = spark.range(1, 200_000, 2)
    assert keys.filter(wanted).count() == 100_000 and others.filter(wanted).count() < 70_000
    test = others.filter(wanted)._jdf.queryExecution().optimizedPlan().toString().split("\n")[0]
    assert test.startswith("Filter") and len(re.findall(r"scalar-subquery#\d+ \[\]\[", test)) == 1
    lines = runtime_filter.key_bits(keys, ["id"], 1 << 12, grows=True)._jdf.queryExecution().optimizedPlan().toString()
    assert lines.count("Range (0, 200000") == 1  # what the keys come from is read, and planned, once


def test_halves_of_average_or_collapse_read_the_pivot_where_it_is_kept(spark):
    plan = QUERIES["average_or_collapse"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"InMemoryRelation \[is_official#\d+, result_validation_date", plan)) == 2


def test_order_lines_travel_as_one_row_an_order(spark):
    numbers = [1, 7, 7, 3, None, None, -2, -7]
    rows = [(order, n) for order in (5, 6, None) for n in numbers[order or 0 :] + numbers[:3]]
    lineitem = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int")
    orders = spark.createDataFrame([(5, 1, "P"), (6, 2, "F"), (7, 1, "F"), (8, 9, "F")], "o_orderkey long, o_custkey long, o_orderstatus string")
    customer = spark.createDataFrame([(1, 11), (2, 12)], "c_custkey long, c_nationkey int")
    lines = retail._order_lines(lineitem, orders, customer)
    pick = lambda n: None if n is None else retail.ITEMS[n - 1 if n > 0 else n]
    expected = {
        (None if n is None else order * 10 + n, order, order + 6, pick(n), "Pending" if order == 5 else "Completed")
        for order, n in rows if order in (5, 6)
    }
    found = [tuple(r) if r.id is not None else (None, *r[1:3], None, r[4]) for r in lines.collect()]  # without a number, the item is undefined
    assert set(found) == expected and len(found) == len(expected)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert not re.findall(r"Exchange hashpartitioning\([^\n]*l_linenumber#\d+, \d+\)", plan)
