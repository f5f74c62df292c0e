"""Deliveries, the completion state, stored results and shared tables."""

from datetime import date, datetime, timedelta

import pytest
from lab import ROWS, results, tables
from pyspark.sql import functions as F

from creamline.functions.dates import ReportWindow, between_dates, days_from_now
from creamline.operators import completion_state
from creamline.operators.completion import completions
from creamline.operators.ordering import with_place
from creamline.operators.runtime_filter import key_bits, may_be_wanted
from creamline.plans import official, redtag, sheets
from creamline.schemas import ddl
from creamline.sources.published import current, publish, read_published
from creamline.sources.shared import SharedTables, shared_tables
from creamline.sources.stored import MONTH, save_lab
from creamline.sources.tables import load_tables

FIRST, LAST = date(2018, 10, 1), date(2018, 10, 10)
NOW = datetime(2018, 10, 10, 12)


@pytest.fixture(scope="module")
def lab(spark):
    return tables(spark)


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


# --- deliveries

def test_a_failing_delivery_leaves_the_former_one(spark, lab, tmp_path):
    path = str(tmp_path)
    good = redtag.red_tag_datasets(lab, "CO18-08-1", 30, NOW)
    assert publish(good, path) == 1
    before = {name: rows(read_published(spark, path, name)) for name in good}
    failing = {**good, "bacteria": good["bacteria"].withColumn("Tank", F.raise_error(F.lit("broken")).cast("string"))}
    with pytest.raises(Exception, match="broken"):
        publish({name: frame.limit(0) if name != "bacteria" else frame for name, frame in failing.items()}, path)
    assert {name: rows(read_published(spark, path, name)) for name in good} == before
    assert before["all"] and len(list((tmp_path / "data" / "all").iterdir())) == 1  # nothing of the failed run stays
    assert publish({name: frame.limit(0) for name, frame in good.items()}, path) == 2
    assert all(read_published(spark, path, name).count() == 0 for name in good)


def test_only_delivered_partitions_are_replaced(spark, tmp_path):
    path, kind = str(tmp_path), "state string, day date, n int"
    one, two = date(2020, 1, 1), date(2020, 1, 2)

    def send(*some, **named):
        return publish({"feed": spark.createDataFrame(list(some), kind)}, path, ("state", "day"), **named)

    send(("MN", one, 1), ("MN", two, 2), ("a/b =+%20", one, 3), (None, one, 4))
    send(("MN", two, 20), ("WI", one, 5))
    now = {(r.state, str(r.day)): r.n for r in read_published(spark, path, "feed").collect()}
    assert now == {("MN", "2020-01-01"): 1, ("MN", "2020-01-02"): 20, ("a/b =+%20", "2020-01-01"): 3, (None, "2020-01-01"): 4, ("WI", "2020-01-01"): 5}
    send(delivers=[{"state": "MN", "day": one}, {"state": None, "day": one}])
    assert {r.n for r in read_published(spark, path, "feed").collect()} == {20, 3, 5}
    assert current(spark, path)[0] == 3


def test_old_runs_are_removed_once_no_reader_can_want_them(spark, tmp_path):
    for n in range(6):
        publish({"x": spark.range(n, n + 1)}, str(tmp_path))
    assert read_published(spark, str(tmp_path), "x").first().id == 5
    assert len(list((tmp_path / "data" / "x").glob("run=*"))) == 3
    assert len(list((tmp_path / "manifests").glob("version=*"))) == 3
    with pytest.raises(ValueError, match="no rows"):
        read_published(spark, str(tmp_path), "y")


# --- completion state

WINDOWS = [between_dates(FIRST, LAST), days_from_now(9, NOW), ReportWindow(None, NOW), days_from_now(0.5, datetime(2018, 10, 5, 7))]


def test_state_equals_all_results_in_any_order(spark, tmp_path):
    start = datetime(2018, 9, 28)
    facts = []
    for line in range(1, 60):
        for k in range(line % 4 + 1):
            at = start + timedelta(hours=(line * 37 + k * 53) % 400)
            facts += results(line, ("UM0004ZH", str(k)), at=at)
    facts += [(61, None, None, "T", "P", "1", 1), (None, start, None, "T", "P", "1", 1)]
    batches = [facts[2::3], facts[::3], facts[::3], facts[1::3], [], facts[5:9]]  # late, repeated and empty ones
    path, seen = str(tmp_path), []
    for batch in batches:
        completion_state.merge_results(spark.createDataFrame(batch, ddl("reportable_result")), path)
        seen += batch
        everything = spark.createDataFrame(seen, ddl("reportable_result")).filter("commercial_order_line_id IS NOT NULL")
        for window in WINDOWS:
            state = completion_state.read_state(spark, path)
            assert rows(completion_state.state_completions(state, window)) == rows(completions(everything, window))
    log = completion_state.read_state(spark, path).count()
    completion_state.compact(spark, path)
    state = completion_state.read_state(spark, path)
    assert state.count() == 59 < log
    assert all(rows(completion_state.state_completions(state, w)) == rows(completions(everything, w)) for w in WINDOWS)


def test_a_failed_merge_changes_nothing(spark, tmp_path):
    good = spark.createDataFrame(results(1, ("P", "1")), ddl("reportable_result"))
    completion_state.merge_results(good, str(tmp_path))
    before = rows(completion_state.read_state(spark, str(tmp_path)))
    bad = good.withColumn("result_validation_date", F.raise_error(F.lit("broken")).cast("timestamp_ntz"))
    with pytest.raises(Exception, match="broken"):
        completion_state.merge_results(bad, str(tmp_path))
    assert rows(completion_state.read_state(spark, str(tmp_path))) == before


def test_reports_read_the_state_and_not_the_results(spark, lab, tmp_path):
    completion_state.merge_results(lab["reportable_result"], str(tmp_path))
    with_state = {**lab, "completion_state": completion_state.read_state(spark, str(tmp_path))}
    for build in (
        lambda t: official.official_report(t, FIRST, LAST, mode="raw"),
        lambda t: sheets.dairy_sheet(t, 30, NOW),
    ):
        assert rows(build(with_state)) == rows(build(lab)) != []
    window = between_dates(FIRST, LAST)
    plan = official.eligible_lines(with_state, window, official.DEFAULT_RULES)._jdf.queryExecution().executedPlan().toString()
    assert "result_validation_date" not in plan and "PartitionFilters: [isnotnull(day" in plan


# --- stored results

def test_a_report_reads_the_months_of_its_window(spark, lab, tmp_path):
    save_lab(lab, f"{tmp_path}/lab", f"{tmp_path}/reference")
    stored = load_tables(spark, f"{tmp_path}/lab", f"{tmp_path}/reference")
    assert MONTH in stored["reportable_result"].columns
    months = {(r.commercial_order_line_id, r[MONTH]) for r in stored["reportable_result"].collect()}
    assert {m for line, m in months if line == 2} == {201809} and len(months) == 8
    for build in (
        lambda t: official.official_report(t, FIRST, LAST),
        lambda t: official.official_report(t, FIRST, LAST, mode="raw"),
        lambda t: redtag.red_tag(t, "all", "CO18-08-1", 30, NOW),
        lambda t: sheets.dairy_sheet(t, 30, NOW),
    ):
        assert rows(build(stored)) == rows(build(lab)) != []
    plan = sheets.dairy_sheet(stored, 5, NOW)._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({MONTH}" in plan


# --- shared tables

def cached(spark):
    return spark.sparkContext._jsc.getPersistentRDDs().size()


def test_shared_rows_are_computed_once_and_given_up(spark):
    own, ran = SharedTables(most=2), spark.sparkContext.accumulator(0)

    def count(part):
        for row in part:
            ran.add(1)
            yield row

    base = spark.createDataFrame(spark.range(10).rdd.mapPartitions(count), "id long")
    before = cached(spark)
    with shared_tables(own):
        shared = own.share(base.filter("id > 2"), "rows")
        assert ran.value == 0 and cached(spark) == before  # nothing ran
        assert shared.join(shared.selectExpr("id + 1 AS id"), "id").count() == 6
        assert ran.value == 10 and own.names() == ["rows"]
        own.share(base.filter("id > 3"), "b")
        own.share(base.filter("id > 4"), "c")
        assert own.names() == ["b", "c"]
    assert own.names() == [] and cached(spark) == before


def test_a_new_report_reads_new_results(spark, tmp_path):
    path = str(tmp_path)
    spark.range(3).write.parquet(f"{path}/t")
    own = SharedTables()
    assert own.share(spark.read.parquet(f"{path}/t"), "t").count() == 3
    import shutil

    spark.range(5).write.parquet(f"{path}/u")
    for file in (tmp_path / "u").glob("part-*.parquet"):
        shutil.copy(file, tmp_path / "t" / f"new-{file.name}")
    assert own.share(spark.read.parquet(f"{path}/t"), "t").count() == 8
    own.release()


# --- run-time filter and places

def test_filter_keeps_all_wanted_and_few_others(spark):
    wanted = spark.range(0, 40_000, 20).select(F.col("id").alias("k"))
    keys = spark.range(200_000).select(F.col("id").alias("k"))
    kept = keys.filter(may_be_wanted(wanted, ["k"], 1 << 16))
    assert kept.join(wanted, "k", "left_semi").count() == wanted.count()
    assert kept.count() < 6_000
    assert keys.filter(may_be_wanted(wanted.limit(0), ["k"], 1 << 12)).count() == 0
    assert len(key_bits(wanted, ["k"], 1 << 12).first().words) == 64
    null = spark.createDataFrame([(None,), (20,)], "k long")
    assert null.filter(may_be_wanted(wanted, ["k"])).count() == 1


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_places_follow_the_order(spark, n):
    frame = spark.range(0, n, 1, 7).select(F.col("id"), (F.col("id") * 7919 % 101).alias("v"))
    own = SharedTables()
    got = with_place(frame, [F.desc("v"), F.asc("id")], lambda f: own.share(f, "rows")).collect()
    assert sorted(((r.id, r.v) for r in got), key=lambda r: (-r[1], r[0])) == [(r.id, r.v) for r in sorted(got, key=lambda r: r.place)]
    assert sorted(r.place for r in got) == list(range(1, n + 1))
    own.release()
