"""Column helpers on single values."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from creamline.functions import coding, dates, numbers, text


@pytest.fixture(scope="module")
def apply(spark):
    def run(function, values, kind="string"):
        rows = [(i, v) for i, v in enumerate(values)]
        frame = spark.createDataFrame(rows, f"i int, v {kind}")
        out = frame.select("i", function(F.col("v")).alias("v")).orderBy("i").collect()
        return [r.v for r in out]

    return run


def test_state_rounding(apply):
    values = ["1250", "1350", "1050", "255", "355", "245", "12550", "1240", "12", "", None]
    assert apply(numbers.state_rounding, values) == [
        "1200", "1400", "1000", "260", "360", "240", "12500", "0", "0", "0", "0"]
    assert apply(numbers.state_rounding_shown, ["1250", "12"]) == ["1200", None]


def test_water_percent(apply):
    assert apply(numbers.water_percent, ["0", "539", "540", "530.5", "432", None, "x"]) == [
        "<0.1", "0.19", "<0.1", "1.76", "20", "<0.1", None]


def test_total_solids(apply):
    assert apply(lambda v: numbers.total_solids(v, F.lit("8.5")), ["3.25", "3.5", "", None]) == [
        "11.75", "12", "", ""]


def test_implied_decimal_keeps_thousands_separator(apply):
    assert apply(numbers.implied_decimal, ["3.456", "12", "1234.5", "", None]) == [
        "346", "1200", "1,23450", None, None]


def test_half_even_and_padding(apply):
    assert apply(numbers.half_even_int, ["2.5", "3.5", "-2.5", None, "7"]) == [2, 4, -2, 0, 7]
    assert apply(numbers.half_even_int, [">3000", "NF", "", None]) == [None, None, None, 0]
    assert apply(lambda v: numbers.padded(v, 4), [7, 12345, -3], "int") == ["0007", "12345", "-0003"]
    assert apply(lambda v: numbers.padded(v, 4, parens=True), [7, -3], "int") == ["0007", "(3)"]


def test_decimals_and_freezing_point(apply):
    assert apply(lambda v: numbers.decimals(v, 2), ["3.456", "-1.2", None]) == ["3.46", "(1.20)", None]
    assert apply(lambda v: numbers.freezing_point(v).cast("string"), ["540", "0", "", None]) == [
        "-0.540", "0.000", None, None]
    assert apply(lambda v: numbers.freezing_point(v, False).cast("string"), ["540"]) == ["0.540"]


def test_plain_decimals(apply):
    assert apply(numbers.plain_decimal, ["12.50", " 3", "NF", None]) == ["12.50", "3", None, "0"]
    assert apply(numbers.without_tail_zeros, ["-0.530", "0.000", "-1.000", "20.00"]) == [
        "-0.53", "0", "-1", "20"]


def test_numbers_from_text(apply):
    assert apply(numbers.number, ["1.5", " 2 ", "", " ", "NF", None]) == [1.5, 2.0, 0.0, 0.0, None, None]
    assert apply(numbers.whole_number, ["7", "1.5", "", "NF", None]) == [7, None, 0, None, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        apply(lambda v: numbers.number(v, strict=True), ["NF"])


def test_text_rules(apply):
    assert apply(lambda v: text.same_text(v, "Completed"), ["completed  ", "Complete", None]) == [
        True, False, None]
    assert apply(text.has_text, ["a", " ", "", None]) == [True, False, False, False]
    assert apply(text.seq_right, ["28000301932152", "12"]) == ["2152", "12"]
    assert apply(text.seq_middle, ["28000301932152", "12"]) == ["2152", ""]
    assert apply(text.pad_seq, ["7", "1234", "12345", None]) == ["07", "1234", "12345", "0"]


def test_codings(apply):
    values = ["NOT FOUND", "Not Found ", "Positive", "99", "", None]
    assert apply(coding.code_results, values) == ["NF", "NF", "AL", "99", "", None]
    assert apply(lambda v: coding.code_results(v, False), ["Positive"]) == ["Positive"]
    for other_is_null, last in ((True, None), (False, "NT")):
        flags = apply(
            lambda v, o=other_is_null: coding.inhibitor_flag(
                v, F.lit("Z001JJPC"), "NF", "AL", "NT", other_is_null=o),
            ["not found", "POSITIVE", "?"],
        )
        assert flags == ["NF", "AL", last]
    assert apply(coding.grade_or_na, ["", " ", None, "A"]) == ["N/A", "N/A", "N/A", "A"]
    assert apply(coding.grade_or_zero, ["", None]) == ["", "0"]


def test_local_time_has_no_daylight_saving(apply):
    stamps = [datetime(2018, 7, 1, 4, 59), datetime(2018, 7, 1, 5), datetime(2018, 1, 1, 5), None]
    assert apply(dates.local_date, stamps, "timestamp_ntz") == [
        date(2018, 6, 30), date(2018, 7, 1), date(2018, 1, 1), None]
    assert apply(dates.date_or_zeros, [stamps[0], None], "timestamp_ntz") == ["20180701", "00000000"]
    assert apply(dates.clock_text, [datetime(2018, 7, 1, 16, 5)], "timestamp_ntz") == ["16:05"]


def test_layouts_do_not_depend_on_the_session_zone(spark, apply):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        gap = [datetime(2018, 3, 11, 2, 30), None]
        assert apply(dates.clock_text, gap, "timestamp_ntz") == ["02:30", None]
        assert apply(dates.date_text, gap, "timestamp_ntz") == ["03/11/2018", None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_windows():
    now = datetime(2018, 10, 10, 15, 30)
    assert dates.between_dates(date(2018, 10, 1), date(2018, 10, 10)) == dates.ReportWindow(
        datetime(2018, 10, 1, 5), datetime(2018, 10, 10, 5), closed=True)
    assert dates.between_dates(None, date(2018, 10, 10)).start is None
    window = dates.days_from_midnight(7, now)
    assert (window.start, window.end) == (datetime(2018, 10, 3, 5), datetime(2018, 10, 10, 20, 30))
    assert dates.days_from_midnight(None, now).start == datetime(2018, 9, 10, 5)
    assert dates.days_from_midnight(None, now, default=7).start == datetime(2018, 10, 3, 5)
    assert dates.days_from_midnight(0, now, zero_is_unset=True).start is None
    assert dates.days_from_midnight(0, now).start == datetime(2018, 10, 10, 5)
    assert dates.days_from_now(20, now).start == datetime(2018, 9, 20, 20, 30)


def test_execution_stamp(spark):
    stamp = dates.execution_stamp(datetime(2018, 3, 4, 15, 6, 7))
    late = dates.execution_stamp(datetime(2018, 3, 4, 15, 6, 7), day_first=True)
    assert spark.range(1).select(stamp, late).first()[:] == (
        "03/04/2018  3:06:07 PM", "04/03/2018  3:06:07 PM")
