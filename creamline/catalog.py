"""Every operator and report bound to the provided tables, each with the SQL it must agree with.

Days are shown as text and decimals as doubles, so that both engines print them alike.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType

from creamline.checks import Lists as L
from creamline.checks import CODED, DAY, lab, mean, measures, number, official
from creamline.functions import coding, dates, numbers, text
from creamline.operators import aggregates, completion, completion_state, filters, joins, layout, pivots
from creamline.plans import alerts, feeds, legacy, records, redtag, sheets
from creamline.plans import official as official_plan
from creamline.plans import rules as R
from creamline.plans.steps import shared_rows
from creamline.schemas import SCHEMAS
from creamline.sources import published
from creamline.sources.retail import lab_tables
from creamline.sources.shared import shared_folder
from creamline.sources.stored import save_lab
from creamline.sources.tables import load_tables, parse_key_list

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

FIRST, LAST = date(1997, 1, 1), date(1999, 1, 1)
NOW, DAYS = datetime(2000, 7, 1, 12), 1500
ORDER = "co-7"
LISTED = "00000000000003,00000000000004,00000000000004, 00000000000077,,00000000000123"


def portable(frame: DataFrame) -> DataFrame:
    def cell(field):
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DateType):
            return F.date_format(col, "yyyy-MM-dd").alias(field.name)
        if isinstance(field.dataType, DecimalType):
            return col.cast("double").alias(field.name)
        return col

    return frame.select([cell(f) for f in frame.schema.fields])


def query(name: str, sql: str):
    """Registers a function of the laboratory tables, with its SQL."""

    def register(build: Callable[[dict[str, DataFrame]], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: portable(build(lab_tables(spark, sf_dir)))
        SQL[name] = sql
        return build

    return register


def _lines(t) -> DataFrame:
    """All completed lines, enriched."""
    return joins.enrich_lines(
        completion.with_status(t["commercial_order_line"], R.DEFAULT_RULES.status), t
    )


def _closed():
    return dates.between_dates(FIRST, LAST)


def _same_keys(found: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    """Left join as f and l on keys that may be null."""
    same = reduce(Column.__and__, [F.col(f"f.{k}").eqNullSafe(F.col(f"l.{k}")) for k in keys])
    return found.alias("f").join(others.alias("l"), same, "left")


# --- sources -------------------------------------------------------------------------------------

@query("results_scan", lab("""
    SELECT param AS commercial_parameter_code, name AS test_parameter_name, count(*) AS results,
      count(DISTINCT line_id) AS lines, max(value) AS greatest_text, max(validated) AS last
    FROM rr GROUP BY param, name"""))
def _(t):
    named = joins.name_parameters(t["reportable_result"], t["test_parameter"])
    keys = ["commercial_parameter_code", "test_parameter_name"]
    # by value first: a key of a hash aggregation, where the greatest text would have all results sorted
    by_value = named.groupBy(*keys, "aggregated_value").agg(
        F.count(F.lit(1)).alias("results"), F.max("result_validation_date").alias("last")
    )
    found = by_value.groupBy(*keys).agg(
        F.sum("results").alias("results"), F.max("aggregated_value").alias("greatest_text"), F.max("last").alias("last")
    )
    lines = aggregates.lines_by_parameter(t["reportable_result"], t["test_parameter"])
    return _same_keys(found, lines, keys).select(
        *[f"f.{k}" for k in keys], "results", F.coalesce("lines", F.lit(0)).alias("lines"), "greatest_text", "last"
    )


_KEYED = """
    SELECT sample_id AS id, bar_code, tank FROM smp WHERE bar_code IN ('00000000000003',
      '00000000000004', '00000000000077', '00000000000123')"""


@query("key_list_restriction", lab(_KEYED))
def _(t):
    keys = parse_key_list(t["sample"].sparkSession, LISTED)
    return filters.restrict_to_keys(t["sample"], keys, "bar_code").select("id", "bar_code", "tank")


@query("key_list_with_closing_comma", lab(_KEYED))
def _(t):
    keys = parse_key_list(t["sample"].sparkSession, LISTED + ",")
    return filters.restrict_to_keys(t["sample"], keys, "bar_code").select("id", "bar_code", "tank")


@query("key_list_empty", lab("SELECT sample_id AS id, bar_code, tank FROM smp"))
def _(t):
    keys = parse_key_list(t["sample"].sparkSession, "")
    return filters.restrict_to_keys(t["sample"], keys, "bar_code").select("id", "bar_code", "tank")


# --- completion windows and sample expansion -----------------------------------------------------

def _completed(t, window) -> DataFrame:
    return completion.completed_in_window(
        t["reportable_result"], t["commercial_order_line"], window
    ).select("id", "sample_id", "completed_at")


def _completed_sql(having: str) -> str:
    return lab(f"""
    SELECT line_id AS id, sample_id, max(validated) AS completed_at
    FROM rr JOIN lines USING (line_id) GROUP BY ALL HAVING {having}""")


@query("completed_between_dates", _completed_sql(
    "max(validated) BETWEEN TIMESTAMP '1997-01-01 05:00:00' AND TIMESTAMP '1999-01-01 05:00:00'"))
def _(t):
    return _completed(t, _closed())


@query("completed_from_midnight", _completed_sql(
    "max(validated) > TIMESTAMP '1996-05-23 05:00:00'"
    " AND max(validated) <= TIMESTAMP '2000-07-01 17:00:00'"))
def _(t):
    return _completed(t, dates.days_from_midnight(DAYS, NOW))


@query("completed_default_week", _completed_sql(
    "max(validated) > TIMESTAMP '1997-12-24 05:00:00'"
    " AND max(validated) <= TIMESTAMP '1997-12-31 17:00:00'"))
def _(t):
    return _completed(t, dates.days_from_midnight(None, datetime(1997, 12, 31, 12), default=7))


@query("completed_from_now", _completed_sql(
    "max(validated) > TIMESTAMP '1996-05-23 17:00:00'"
    " AND max(validated) <= TIMESTAMP '2000-07-01 17:00:00'"))
def _(t):
    return _completed(t, dates.days_from_now(DAYS, NOW))


@query("completed_by_state", _completed_sql(
    "max(validated) > TIMESTAMP '1996-05-23 17:00:00'"
    " AND max(validated) <= TIMESTAMP '2000-07-01 17:00:00'"))
def _(t):
    """From the kept state, into which results came in four batches, the latest of them first."""
    spark = t["sample"].sparkSession
    path = f"{shared_folder(spark)}/state-{uuid4().hex}"
    results, last = t["reportable_result"], F.col("result_validation_date") >= F.lit("1997-06-01").cast("timestamp_ntz")
    part = F.col("commercial_order_line_id") % 2 == 0
    for batch in (results.filter(last & part), results.filter(~last), results.filter(last & ~part), results.filter(last)):
        completion_state.merge_results(batch, path)
    done = completion.completed_in_window(
        results, t["commercial_order_line"], dates.days_from_now(DAYS, NOW), state=completion_state.read_state(spark, path))
    return done.select("id", "sample_id", "completed_at")


@query("completed_default_days", _completed_sql(
    "max(validated) > TIMESTAMP '2000-06-01 05:00:00'"
    " AND max(validated) <= TIMESTAMP '2000-07-01 17:00:00'"))
def _(t):
    return _completed(t, dates.days_from_midnight(None, NOW))


def _official_eligible(t) -> DataFrame:
    return official_plan.eligible_lines(t, _closed(), R.DEFAULT_RULES)


_ELIGIBLE_SAMPLES = """picked AS (
      SELECT DISTINCT sample_id FROM closed JOIN lines USING (line_id)
      WHERE item IN ('MVPQVP1', 'MVPQVP2', 'MVPQVPG', 'MVPQVP8')
    )"""


@query("eligible_samples", lab("SELECT sample_id FROM picked", _ELIGIBLE_SAMPLES))
def _(t):
    return completion.samples_with_items(_official_eligible(t), R.OFFICIAL_ITEMS)


# Said in one pass, since every retail line has at least one result: a sample's lines are taken if any of them is
# completed in the window and ordered an official item.
@query("sample_expansion", lab("""
    SELECT line_id AS id, sample_id, item AS commercial_item FROM (
      SELECT *, max(CASE WHEN item IN ('MVPQVP1', 'MVPQVP2', 'MVPQVPG', 'MVPQVP8')
          AND validated >= TIMESTAMP '1997-01-01 05:00:00' AND validated <= TIMESTAMP '1999-01-01 05:00:00'
          THEN 1 ELSE 0 END) OVER (PARTITION BY sample_id) AS wanted
      FROM (
        SELECT l_orderkey * 10 + l_linenumber AS line_id, l_orderkey AS sample_id, items.item AS item,
          max(l_shipdate + to_hours(CAST(l_suppkey % 24 AS INT))) AS validated
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
        JOIN items ON items.pos = l_linenumber
        WHERE o_orderstatus <> 'P'
        GROUP BY l_orderkey, l_linenumber, items.item
      )
    ) WHERE wanted = 1"""))
def _(t):
    return completion.expand_to_samples(
        _official_eligible(t), t["commercial_order_line"], R.OFFICIAL_ITEMS, "COMPLETED"
    ).select("id", "sample_id", "commercial_item")


# --- joins ---------------------------------------------------------------------------------------

@query("enriched_lines", lab("""
    SELECT line_id AS commercial_order_line_id, bar_code, producer_code, region, client_name,
      order_code AS commercial_order_code, item AS commercial_item, sample_temp
    FROM ctx"""))
def _(t):
    return _lines(t).select(
        "commercial_order_line_id", "bar_code", "producer_code", "region", "client_name",
        "commercial_order_code", "commercial_item",
        F.col("temperature_at_sampling").alias("sample_temp"),
    )


@query("enriched_results", lab("""
    SELECT client_name, region, name AS test_parameter_name, count(*) AS results,
      count(DISTINCT bar_code) AS samples, max(value) AS greatest_text
    FROM rr JOIN ctx USING (line_id) GROUP BY client_name, region, name"""))
def _(t):
    lines, keys = _lines(t), ["client_name", "region"]
    rows = joins.enrich_results(t["reportable_result"], lines)
    by_code = aggregates.results_by_code(rows, [*keys, "commercial_parameter_code"])
    found = joins.name_parameters(by_code, t["test_parameter"]).groupBy(*keys, "test_parameter_name").agg(
        F.sum("results").alias("results"), F.max("greatest_text").alias("greatest_text")
    )
    samples = aggregates.samples_by_name(t["reportable_result"], lines, t["test_parameter"], keys)
    return _same_keys(found, samples, [*keys, "test_parameter_name"]).select(
        *[f"f.{k}" for k in [*keys, "test_parameter_name"]], "results", F.coalesce("samples", F.lit(0)).alias("samples"), "greatest_text"
    )


@query("group_membership", lab("""
    SELECT producer_id, group_name AS producer_group_name FROM prod LEFT JOIN grp USING (producer_id)"""))
def _(t):
    return joins.group_members(t)


_MAPPED = """mapped AS (
      SELECT rr.*, ctx.* EXCLUDE (line_id) FROM rr JOIN ctx USING (line_id)
      WHERE item IN (SELECT item FROM known) AND (item, param) IN (SELECT (item, code) FROM map)
    )"""


@query("mapped_results", lab("""
    SELECT item AS commercial_item, param AS commercial_parameter_code, name AS test_parameter_name,
      count(*) AS results, count(DISTINCT bar_code) AS samples
    FROM mapped GROUP BY item, param, name""", _MAPPED))
def _(t):
    named = joins.name_parameters(t["reportable_result"], t["test_parameter"], "inner")
    rows = joins.restrict_to_mapped(joins.enrich_results(named, _lines(t)), t)
    return rows.groupBy(
        "commercial_item", "commercial_parameter_code", "test_parameter_name"
    ).agg(F.count(F.lit(1)).alias("results"), F.countDistinct("bar_code").alias("samples"))


_TECH = """tech AS (
      SELECT bar_code, max(s_name) AS lab_tech FROM rr JOIN lines USING (line_id)
      JOIN smp USING (sample_id) JOIN supplier ON s_suppkey = set_no
      WHERE param = 'UM0004ZH' GROUP BY bar_code
    )"""


@query("technician_fill", lab(
    "SELECT bar_code, tank, lab_tech FROM smp LEFT JOIN tech USING (bar_code)", _TECH))
def _(t):
    frame = layout.with_text_null(t["sample"].select("bar_code", "tank"), "lab_tech")
    lookup = joins.technicians(t, R.TECHNICIAN_PARAMETER)
    return joins.fill_from_lookup(frame, lookup, "bar_code", "operator_code", "lab_tech")


# --- filters -------------------------------------------------------------------------------------

def _slice(name: str, kind: str, value: str, where: str) -> None:
    @query(f"slice_by_{name}", lab(f"""
        SELECT producer_code, count(*) AS lines FROM ctx WHERE {where} GROUP BY producer_code"""))
    def _(t):
        rows = filters.slice_by(_lines(t), kind, value, t)
        return rows.groupBy("producer_code").agg(F.count(F.lit(1)).alias("lines"))


_slice("state", "State", "mn ", "region = 'MN'")
_slice("field_rep", "Field Rep", "Machinery", "field_rep = 'MACHINERY'")
_slice("state_rep", "state rep", "REP NATION_3", "state_rep = 'REP NATION_3'")
_slice("producer_group", "Producer Group", "every third",
       "producer_id IN (SELECT producer_id FROM grp WHERE group_name = 'EVERY THIRD')")
_slice("nothing", "All", "MN", "TRUE")


@query("optional_filters", lab("""
    SELECT producer_id AS id, producer_code FROM prod WHERE region = 'WI' AND field_rep = 'BUILDING'"""))
def _(t):
    rows = filters.optional_filters(
        t["producer"], region="WI", state_rep=None, field_rep="building"
    )
    return rows.select("id", "producer_code")


@query("region_membership", lab("""
    SELECT region, CASE WHEN region IN ('MN', 'MO', 'WI') THEN 'averaged' ELSE 'single' END AS part,
      count(*) AS producers
    FROM prod WHERE region IN ('MN', 'MO', 'WI') OR region NOT IN ('MN', 'MO', 'WI')
    GROUP BY region"""))
def _(t):
    inside = text.text_in(F.col("region"), R.AVERAGED_REGIONS)
    parts = t["producer"].filter(inside).withColumn("part", F.lit("averaged")).unionByName(
        t["producer"].filter(~inside).withColumn("part", F.lit("single"))
    )
    return parts.groupBy("region", "part").agg(F.count(F.lit(1)).alias("producers"))


@query("required_columns", lab("""
    SELECT sample_id AS id, tank, substr(bar_code, 11, 4) AS seq FROM smp
    WHERE tank IS NOT NULL AND sampling_time IS NOT NULL AND length(rtrim(substr(bar_code, 11, 4))) > 0
    """))
def _(t):
    frame = t["sample"].withColumn("seq", text.seq_middle(F.col("bar_code")))
    kept = filters.require_columns(frame, ["tank", "sampling_time"], filled=["seq"])
    return kept.select("id", "tank", "seq")


# Samples with the most frequent measures as columns, for the operators that need such a table.
SAMPLE_LABELS = ["Bacteria Count", "Delvo Inhibitor", "Somatic cells", "Freezing point",
                 "Analysis Temperature", "Gram negative Bacteria", "Prototheca species"]


def _wide(t) -> DataFrame:
    """One row per completed line with coded measures."""
    by_line = pivots.pivot_by_line(
        t["reportable_result"], t["test_parameter"], SAMPLE_LABELS,
        coding.code_results(F.col("aggregated_value")), {},
    )
    rows = official_plan.sample_columns(_lines(t), "chr_number")
    return joins.enrich_results(by_line, rows)


_WIDE = f"""wide AS (
      SELECT line_id, bar_code, tank, producer_code, region, sampling_date, billing_week, sample_temp,
        parcel_temp, {measures(SAMPLE_LABELS, CODED)}
      FROM rr JOIN ctx USING (line_id) GROUP BY ALL
    )"""
_SHOWN = ["commercial_order_line_id", "bar_code", "Bacteria Count", "Freezing point"]
_SHOWN_SQL = 'line_id AS commercial_order_line_id, bar_code, "Bacteria Count", "Freezing point"'


@query("any_present", lab(f"""
    SELECT {_SHOWN_SQL} FROM wide
    WHERE "Gram negative Bacteria" IS NOT NULL OR "Freezing point" IS NOT NULL""", _WIDE))
def _(t):
    return filters.any_present(_wide(t), ["Gram negative Bacteria", "Freezing point"]).select(_SHOWN)


@query("any_present_or_blank", lab(f"""
    SELECT {_SHOWN_SQL} FROM wide
    WHERE "Gram negative Bacteria" IS NOT NULL OR length(rtrim("Prototheca species")) > 0""", _WIDE))
def _(t):
    return filters.any_present_or_blank(
        _wide(t), ["Gram negative Bacteria", "Prototheca species"], "Prototheca species"
    ).select(_SHOWN)


@query("all_present", lab(f"""
    SELECT {_SHOWN_SQL} FROM wide WHERE "Bacteria Count" IS NOT NULL
      AND "Delvo Inhibitor" IS NOT NULL AND "Freezing point" IS NOT NULL""", _WIDE))
def _(t):
    return filters.all_present(
        _wide(t), ["Bacteria Count", "Delvo Inhibitor", "Freezing point"]
    ).select(_SHOWN)


_GAP_TEXTS = ["tank", "bar_code", "Somatic cells", "Freezing point", "Bacteria Count"]
_GAP_NUMBERS = ["sample_temp", "parcel_temp", "Analysis Temperature"]


@query("find_incomplete", lab(f"""
    SELECT {_SHOWN_SQL} FROM wide
    WHERE upper(billing_week) IN ('N/A', 'NA')
      OR {" OR ".join(f'''"{c}" IS NULL OR rtrim("{c}") = '' ''' for c in _GAP_TEXTS)}
      OR {" OR ".join(f'"{c}" IS NULL' for c in _GAP_NUMBERS)}
      OR sampling_date IS NULL OR sampling_date = DATE '1900-01-01'""", _WIDE))
def _(t):
    return filters.find_incomplete(_wide(t), _GAP_TEXTS, _GAP_NUMBERS).select(_SHOWN)


@query("find_complete", lab(f"""
    SELECT {_SHOWN_SQL} FROM wide
    WHERE (upper(billing_week) NOT IN ('N/A', 'NA') OR billing_week IS NULL)
      AND {" AND ".join(f'"{c}" IS NOT NULL' for c in [*_GAP_TEXTS, *_GAP_NUMBERS, "sampling_date"])}
    """, _WIDE))
def _(t):
    return filters.find_complete(
        _wide(t), [*_GAP_TEXTS, *_GAP_NUMBERS, "sampling_date"]
    ).select(_SHOWN)


def _int(value: str) -> str:
    return (f"CASE WHEN trim({value}) = '' THEN 0 WHEN regexp_matches(trim({value}), '^[+-]?[0-9]+$')"
            f" THEN TRY_CAST({value} AS INT) END")


def _above(value: str, limit: int) -> str:
    """Above the limit, or not readable and so perhaps above it."""
    return f"({_int(value)} > {limit} OR ({value} IS NOT NULL AND {_int(value)} IS NULL))"


@query("threshold_alert", lab(f"""
    SELECT line_id AS commercial_order_line_id, bar_code,
      {_int('"Bacteria Count"')} * 1000 AS "Bacteria Count", "Freezing point"
    FROM wide WHERE {_above('"Bacteria Count"', 750)}""", _WIDE))
def _(t):
    return filters.threshold_alert(_wide(t), "Bacteria Count", 750).select(_SHOWN)


# --- pivot and aggregation -----------------------------------------------------------------------

_PIVOT_KEYS = ["bar_code", "commercial_item", "is_official"]


@query("pivot_results", lab(f"""
    SELECT bar_code, item AS commercial_item, {official(L.OFFICIAL_REPORT_TESTS)} AS is_official,
      {measures(L.OFFICIAL_MEASURES, CODED)}
    FROM rr JOIN ctx USING (line_id) GROUP BY ALL"""))
def _(t):
    rows = joins.name_parameters(
        joins.enrich_results(t["reportable_result"], _lines(t)), t["test_parameter"]
    )
    return pivots.pivot_results(
        rows.select(
            "bar_code", "commercial_item",
            coding.flag_official(F.col("commercial_test_code"), R.OFFICIAL_REPORT_TESTS).alias(
                "is_official"),
            "test_parameter_name",
            coding.code_results(F.col("aggregated_value")).alias("aggregated_value"),
        ),
        R.OFFICIAL_MEASURES,
    )


@query("collapse_by_key", lab("""
    SELECT bar_code, max(tank) AS tank, max(sampling_date)::VARCHAR AS sampling_date,
      max("Bacteria Count") AS "Bacteria Count", max("Delvo Inhibitor") AS "Delvo Inhibitor"
    FROM wide GROUP BY bar_code""", _WIDE))
def _(t):
    rows = _wide(t).select("bar_code", "tank", "sampling_date", "Bacteria Count", "Delvo Inhibitor")
    return aggregates.collapse_by_key(rows, ["bar_code"])


_MEAN_COLUMNS = ["producer_code", "sampling_date", "tank", "region", "Bacteria Count",
                 "Freezing point", "Delvo Inhibitor"]


@query("average_by_group", lab(f"""
    SELECT producer_code, sampling_date::VARCHAR AS sampling_date,
      string_agg(DISTINCT tank, ',' ORDER BY tank) AS tank, max(region) AS region,
      {mean('"Bacteria Count"')} AS "Bacteria Count", {mean('"Freezing point"')} AS "Freezing point",
      max("Delvo Inhibitor") AS "Delvo Inhibitor"
    FROM (SELECT * FROM wide WHERE tank IS NOT NULL) GROUP BY producer_code, sampling_date""", _WIDE))
def _(t):
    rows = _wide(t).filter(F.col("tank").isNotNull()).select(_MEAN_COLUMNS)
    return aggregates.average_by_group(
        rows, ["producer_code", "sampling_date"], ["Bacteria Count", "Freezing point"], ["tank"]
    )


@query("average_by_group_and_bar_code", lab(f"""
    SELECT producer_code, sampling_date::VARCHAR AS sampling_date, bar_code, max(tank) AS tank,
      {mean('"Bacteria Count"')} AS "Bacteria Count", {mean('"Freezing point"')} AS "Freezing point"
    FROM wide GROUP BY producer_code, wide.sampling_date, bar_code""", _WIDE))
def _(t):
    averaged = ["Bacteria Count", "Freezing point"]
    keys = ["producer_code", "sampling_date", "bar_code"]
    return aggregates.average_by_group(_wide(t).select(*keys, "tank", *averaged), keys, averaged)


@query("concat_distinct", lab("""
    SELECT producer_code, string_agg(DISTINCT tank, ',' ORDER BY tank) AS tank
    FROM (SELECT * FROM ctx WHERE tank IS NOT NULL) GROUP BY producer_code"""))
def _(t):
    rows = _lines(t).filter(F.col("tank").isNotNull())
    return rows.groupBy("producer_code").agg(aggregates.concat_distinct(F.col("tank")).alias("tank"))


@query("concat_all", lab(f"""
    SELECT producer_code, {DAY.format("sampling_date", "sampling_date")},
      string_agg(tank, ',' ORDER BY tank) AS tank
    FROM ctx GROUP BY producer_code, ctx.sampling_date"""))
def _(t):
    rows = _lines(t).withColumn("sampling_date", dates.local_date(F.col("sampling_time")))
    return aggregates.concat_all(rows, ["producer_code", "sampling_date"], ["tank"])


@query("count_tests", lab("SELECT count(DISTINCT bar_code) AS \"numOfTests\" FROM ctx"))
def _(t):
    return aggregates.count_tests(_lines(t))


@query("report_totals", lab("""
    SELECT count(*) AS rows, '07/01/2000  12:00:00 PM' AS executed_at FROM ctx"""))
def _(t):
    return aggregates.report_totals(_lines(t), dates.execution_stamp(NOW))


# --- codings, flags and layouts over all results -------------------------------------------------

@query("result_coding", lab(f"""
    SELECT value AS aggregated_value, {CODED} AS coded,
      CASE WHEN lower(value) = 'not found' THEN 'NF' ELSE value END AS coded_without_positives,
      count(*) AS results
    FROM rr GROUP BY ALL"""))
def _(t):
    value = F.col("aggregated_value")
    return t["reportable_result"].groupBy(
        value,
        coding.code_results(value).alias("coded"),
        coding.code_results(value, positives=False).alias("coded_without_positives"),
    ).agg(F.count(F.lit(1)).alias("results"))


@query("official_flags", lab(f"""
    SELECT test_code AS commercial_test_code, item AS commercial_item,
      {official(L.OFFICIAL_REPORT_TESTS)} AS official_report,
      {official(L.ALERT_TESTS)} AS alert, {official(L.RED_TAG_TESTS)} AS red_tag,
      CASE WHEN item = 'MVPQVP8' THEN '99' END AS by_item,
      CASE WHEN item = 'MVPQVP8' AND param = 'Z001JJPC' THEN '2' ELSE '0' END AS antibiotic,
      count(*) AS results
    FROM rr JOIN lines USING (line_id) GROUP BY ALL"""))
def _(t):
    code, item = F.col("commercial_test_code"), F.col("commercial_item")
    lines = t["commercial_order_line"].select(
        F.col("id").alias("commercial_order_line_id"), "commercial_item")
    return joins.enrich_results(t["reportable_result"], lines).groupBy(
        code, item,
        coding.flag_official(code, R.OFFICIAL_REPORT_TESTS).alias("official_report"),
        coding.flag_official(code, R.ALERT_TESTS).alias("alert"),
        coding.flag_official(code, R.RED_TAG_TESTS).alias("red_tag"),
        coding.official_by_item(item, "99", None).alias("by_item"),
        coding.antibiotic_flag(item, F.col("commercial_parameter_code")).alias("antibiotic"),
    ).agg(F.count(F.lit(1)).alias("results"))


def _inhibitor_sql(not_found: str, positive: str, untested: str, other_is_null: bool) -> str:
    rest = f"WHEN param <> 'Z001JJPC' THEN '{untested}'" if other_is_null else f"ELSE '{untested}'"
    return (f"CASE WHEN param = 'Z001JJPC' AND lower(value) = 'not found' THEN '{not_found}'"
            f" WHEN param = 'Z001JJPC' AND lower(value) = 'positive' THEN '{positive}' {rest} END")


@query("inhibitor_flags", lab(f"""
    SELECT param AS commercial_parameter_code, {_inhibitor_sql('NF', 'AL', 'NT', False)} AS letters,
      {_inhibitor_sql('2', '1', '0', False)} AS digits,
      {_inhibitor_sql('NF', 'AL', 'NT', True)} AS letters_or_null,
      {_inhibitor_sql('2', '1', '0', True)} AS digits_or_null, count(*) AS results
    FROM rr GROUP BY ALL"""))
def _(t):
    value, code = F.col("aggregated_value"), F.col("commercial_parameter_code")
    flag = coding.inhibitor_flag
    return t["reportable_result"].groupBy(
        code,
        flag(value, code, "NF", "AL", "NT").alias("letters"),
        flag(value, code, "2", "1", "0").alias("digits"),
        flag(value, code, "NF", "AL", "NT", other_is_null=True).alias("letters_or_null"),
        flag(value, code, "2", "1", "0", other_is_null=True).alias("digits_or_null"),
    ).agg(F.count(F.lit(1)).alias("results"))


@query("grade_defaults", lab("""
    SELECT producer_id AS id, coalesce(grade, '0') AS or_zero,
      CASE WHEN grade IS NULL OR rtrim(grade) = '' THEN 'N/A' ELSE grade END AS or_na
    FROM prod"""))
def _(t):
    grade = F.col("grade")
    return t["producer"].select(
        "id", coding.grade_or_zero(grade).alias("or_zero"), coding.grade_or_na(grade).alias("or_na")
    )


@query("test_dates", lab("""
    SELECT strftime(coalesce(validated, measured) - INTERVAL 5 HOUR, '%Y-%m-%d') AS tested,
      strftime(coalesce(CAST(measured - INTERVAL 5 HOUR AS DATE),
        CAST(validated - INTERVAL 5 HOUR AS DATE)), '%Y-%m-%d') AS measured_day,
      coalesce(strftime(measured, '%Y%m%d'), '00000000') AS measured_or_zeros, count(*) AS results
    FROM rr GROUP BY ALL"""))
def _(t):
    validated, measured = F.col("result_validation_date"), F.col("result_measured_time")
    return t["reportable_result"].groupBy(
        dates.tested_at(validated, measured).cast("date").alias("tested"),
        dates.measured_date(measured, validated).alias("measured_day"),
        dates.date_or_zeros(measured).alias("measured_or_zeros"),
    ).agg(F.count(F.lit(1)).alias("results"))


@query("sample_layouts", lab("""
    SELECT sample_id AS id, right(bar_code, 4) AS seq_right, substr(bar_code, 11, 4) AS seq_middle,
      CASE WHEN length(substr(bar_code, 11, 4)) < 4 THEN '0' || substr(bar_code, 11, 4)
        ELSE substr(bar_code, 11, 4) END AS seq_padded,
      strftime(sampling_time - INTERVAL 5 HOUR, '%Y-%m-%d') AS local_day,
      strftime(sampling_time, '%m/%d/%Y') AS month_first, strftime(sampling_time, '%m%d%Y') AS plain,
      strftime(sampling_time, '%Y%d%m') AS day_before_month, strftime(sampling_time, '%H:%M') AS clock,
      printf('%02d', CAST(coalesce(sample_temp, 0) AS INT)) AS temperature
    FROM smp"""))
def _(t):
    code, taken = F.col("bar_code"), F.col("sampling_time")
    return t["sample"].select(
        "id",
        text.seq_right(code).alias("seq_right"),
        text.seq_middle(code).alias("seq_middle"),
        text.pad_seq(text.seq_middle(code)).alias("seq_padded"),
        dates.local_date(taken).alias("local_day"),
        dates.date_text(taken).alias("month_first"),
        dates.date_text(taken, "MMddyyyy").alias("plain"),
        dates.date_text(taken, "yyyyddMM").alias("day_before_month"),
        dates.clock_text(taken).alias("clock"),
        numbers.padded(numbers.half_even_int(F.col("temperature_at_sampling")), 2).alias(
            "temperature"),
    )


_ROUNDED = """CASE WHEN length(value) > 3 AND substr(value, 3, 1) = '5' THEN CAST(
        (TRY_CAST(value AS BIGINT) + CASE WHEN substr(value, 2, 1) IN ('0', '2', '4', '6', '8')
          THEN -50 ELSE 50 END) // 100 * 100 AS VARCHAR)
      WHEN length(value) = 3 AND substr(value, 3, 1) = '5' THEN CAST(
        (TRY_CAST(value AS BIGINT) + CASE WHEN substr(value, 2, 1) IN ('0', '2', '4', '6', '8')
          THEN -5 ELSE 5 END) // 10 * 10 AS VARCHAR)
      ELSE '0' END"""
_FP = "TRY_CAST(value AS DOUBLE)"


def _degrees(sign: str) -> str:
    return f"CAST(CAST({sign}{_FP} / 1000 AS DECIMAL(12, 3)) AS VARCHAR)"


_WATER = f"""CASE WHEN {_FP} > 0 AND {_FP} < 540 THEN regexp_replace(
        CAST(CAST(round_even((540 - {_FP}) / 5.4, 2) AS DECIMAL(18, 2)) AS VARCHAR), '\\.?0+$', '')
      WHEN {_FP} IS NOT NULL THEN '<0.1' END"""


@query("count_layouts", lab(f"""
    SELECT value, {_ROUNDED} AS state_rounded, nullif({_ROUNDED}, '0') AS state_shown,
      CASE WHEN value IS NULL THEN '0000' ELSE printf('%04d', TRY_CAST(value AS INT)) END AS four_digits,
      format('{{:,}}', TRY_CAST(value AS INT)) AS separated,
      {_degrees('-')} AS freezing, {_degrees('')} AS freezing_unsigned, {_WATER} AS water
    FROM (SELECT DISTINCT value FROM rr WHERE param IN ('UM0004ZH', 'JJ00047N', 'P003'))"""))
def _(t):
    codes = ["UM0004ZH", "JJ00047N", "P003"]
    value = F.col("value")
    whole = numbers.half_even_int(value)
    values = t["reportable_result"].filter(F.col("commercial_parameter_code").isin(codes)).select(
        F.col("aggregated_value").alias("value")).distinct()
    return values.select(
        "value",
        numbers.state_rounding(value).alias("state_rounded"),
        numbers.state_rounding_shown(value).alias("state_shown"),
        numbers.padded(whole, 4).alias("four_digits"),
        numbers.grouped(value.try_cast("int")).alias("separated"),
        numbers.freezing_point(value).cast("string").alias("freezing"),
        numbers.freezing_point(value, negate=False).cast("string").alias("freezing_unsigned"),
        numbers.water_percent(value).alias("water"),
    )


@query("component_layouts", lab("""
    SELECT fat, snf, CAST(TRY_CAST(fat AS DECIMAL(18, 2)) AS VARCHAR) AS fat_decimal,
      replace(format('{:,.2f}', TRY_CAST(fat AS DOUBLE)), '.', '') AS fat_implied,
      CASE WHEN length(rtrim(fat)) > 0 AND length(rtrim(snf)) > 0 THEN regexp_replace(
        CAST(TRY_CAST(fat AS DECIMAL(18, 6)) + TRY_CAST(snf AS DECIMAL(18, 6)) AS VARCHAR),
        '\\.?0+$', '') ELSE '' END AS solids,
      CAST(round_even(TRY_CAST(fat AS DOUBLE), 0) AS INT) AS fat_whole
    FROM (SELECT DISTINCT fat, snf FROM (
      SELECT line_id, max(CASE WHEN param = '7027A006' THEN value END) AS fat,
        max(CASE WHEN param = 'P009' THEN value END) AS snf FROM rr GROUP BY line_id))
    WHERE fat IS NOT NULL"""))
def _(t):
    labels = ["Fat", "Solids not fat (SNF)"]
    by_line = pivots.pivot_by_line(
        t["reportable_result"], t["test_parameter"], labels, F.col("aggregated_value"), {}
    )
    pairs = by_line.select(F.col("Fat").alias("fat"), F.col(labels[1]).alias("snf")).distinct()
    fat, snf = F.col("fat"), F.col("snf")
    return pairs.filter(fat.isNotNull()).select(
        "fat", "snf",
        numbers.decimals(fat, 2).alias("fat_decimal"),
        numbers.implied_decimal(fat).alias("fat_implied"),
        numbers.total_solids(fat, snf).alias("solids"),
        numbers.half_even_int(fat).alias("fat_whole"),
    )


# --- reports: official ---------------------------------------------------------------------------

_LABELS = [*L.OFFICIAL_MEASURES]
_ATTRIBUTES = """producer_code, region, producer_name, state_rep, tank, seq, bar_code, permit_number,
        sampling_date, field_rep, sample_temp, parcel_temp, billing_week, status, client_name,
        btu_number"""
_PIVOT = f"""piv AS (
      SELECT {_ATTRIBUTES}, item, {official(L.OFFICIAL_REPORT_TESTS)} AS is_official, validated,
        {measures(_LABELS, CODED)}
      FROM rr JOIN ctx USING (line_id)
      WHERE sample_id IN (SELECT sample_id FROM picked) AND tank IS NOT NULL
        AND sampling_time IS NOT NULL
      GROUP BY ALL
    )"""
_OFFICIAL = """is_official = 'Y' AND length(rtrim(seq)) > 0"""
_MAXED = [("field_rep", "FieldRep"), ("state_rep", "StateRep"), ("sample_temp", "Sample Temp"),
          ("parcel_temp", "Parcel Temp"), ("client_name", "Client Name"),
          ("Analysis Temperature", "Analysis Temperature"), ("billing_week", "BillingWeek"),
          ("status", "CommercialOrderLineStatus"), ("btu_number", "BtuNumber"),
          ("is_official", "Isofficial"), ("validated", "ResultValidationDate"),
          ("producer_name", "ProducerName"), ("permit_number", "PermitNumber"),
          ("Delvo Inhibitor", "Delvo Inhibitor"), ("region", "Region")]
_MAXED_SQL = ", ".join(f'max("{c}") AS "{n}"' for c, n in _MAXED)
_CELLS = [("Bacteria Count", "Bacteria Count"), ("Somatic cells", "Somatic Cells"),
          ("Freezing point", "Freezing Point")]
_SINGLE = f"""SELECT bar_code AS "Barcode", max(producer_code) AS "ProducerCode",
        max(tank) AS "Tank", max(seq) AS "Seq", max(sampling_date) AS "SamplingTime",
        {", ".join(f'max("{c}") AS "{n}"' for c, n in _CELLS)}, {_MAXED_SQL}
      FROM piv WHERE {_OFFICIAL}"""
_PARTS = f"""parts AS (
      SELECT * FROM (
        SELECT max(bar_code) AS "Barcode", producer_code AS "ProducerCode", u.tank AS "Tank",
          u.seq AS "Seq", piv.sampling_date AS "SamplingTime",
          {", ".join(f'''{mean(f'"{c}"')} AS "{n}"''' for c, n in _CELLS)}, {_MAXED_SQL}
        FROM piv JOIN (
          SELECT producer_code, sampling_date, string_agg(DISTINCT tank, ',' ORDER BY tank) AS tank,
            string_agg(DISTINCT seq, ',' ORDER BY seq) AS seq FROM piv GROUP BY ALL
        ) u USING (producer_code, sampling_date)
        WHERE is_official = 'Y' AND length(rtrim(piv.seq)) > 0 AND region IN ('MN', 'MO', 'WI')
        GROUP BY producer_code, piv.sampling_date, u.tank, u.seq)
      UNION ALL BY NAME {_SINGLE} AND region NOT IN ('MN', 'MO', 'WI') GROUP BY bar_code
    )"""
_NEEDED = ["Tank", "Barcode", "Somatic Cells", "Freezing Point", "Delvo Inhibitor", "Bacteria Count"]


def _finish(source: str, where: str) -> str:
    return f"""SELECT * EXCLUDE (bar_code, lab_tech, "SamplingTime"), lab_tech AS "Lab Tech",
      {DAY.format('"SamplingTime"', '"SamplingTime"')}
    FROM {source} LEFT JOIN tech ON bar_code = "Barcode" WHERE {where}"""


_COMPLETE = " AND ".join(
    ["""("BillingWeek" IS NULL OR upper("BillingWeek") NOT IN ('N/A', 'NA'))"""]
    + [f'"{c}" IS NOT NULL' for c in [*_NEEDED, "SamplingTime", "Sample Temp", "Parcel Temp",
                                      "Analysis Temperature"]] + ["lab_tech IS NOT NULL"])
_INCOMPLETE = " OR ".join(
    ["""upper("BillingWeek") IN ('N/A', 'NA')"""]
    + [f"""coalesce(rtrim("{c}"), '') = ''""" for c in _NEEDED]
    + [f'"{c}" IS NULL' for c in ["SamplingTime", "Sample Temp", "Parcel Temp",
                                  "Analysis Temperature"]] + ["coalesce(lab_tech, '') = ''"])
_OFFICIAL_CTES = (_ELIGIBLE_SAMPLES, _PIVOT, _PARTS, _TECH)


@query("official_report_complete", lab(_finish("parts", _COMPLETE), *_OFFICIAL_CTES))
def _(t):
    return official_plan.official_report(t, FIRST, LAST)


_IN_ORDER = ", ".join(f'"{c}" NULLS FIRST' for c in [
    *official_plan.SORT, *(c for c in official_plan.TITLES.values() if c not in official_plan.SORT)])


@query("official_report_in_order", f"""SELECT *, row_number() OVER (ORDER BY {_IN_ORDER}) AS place
    FROM ({lab(_finish("parts", _COMPLETE), *_OFFICIAL_CTES)})""")
def _(t):
    return official_plan.official_report(t, FIRST, LAST, place="place")


@query("official_report_incomplete", lab(_finish("parts", _INCOMPLETE), *_OFFICIAL_CTES))
def _(t):
    return official_plan.official_report(t, FIRST, LAST, mode="all")


@query("official_report_raw", lab(
    _finish(f"({_SINGLE} GROUP BY bar_code)", "TRUE"), *_OFFICIAL_CTES))
def _(t):
    return official_plan.official_report(t, FIRST, LAST, mode="Raw")


@query("official_report_for_group", lab(
    _finish("parts", _COMPLETE),
    _ELIGIBLE_SAMPLES,
    _PIVOT.replace("GROUP BY ALL", """AND producer_id IN (
        SELECT producer_id FROM grp WHERE group_name = 'EVERY THIRD') GROUP BY ALL"""),
    _PARTS, _TECH))
def _(t):
    return official_plan.official_report(t, FIRST, LAST, "Producer Group", "Every third")


@query("official_sheet", lab(
    f"""SELECT * REPLACE (strftime(CAST("SamplingTime" AS DATE), '%m/%d/%Y') AS "SamplingTime",
      CAST(CAST(-TRY_CAST("Freezing Point" AS DOUBLE) / 1000 AS DECIMAL(12, 3)) AS VARCHAR)
        AS "Freezing Point")
    FROM ({_finish("parts", _COMPLETE)})""", *_OFFICIAL_CTES))
def _(t):
    return records.official_sheet(official_plan.official_report(t, FIRST, LAST))


@query("average_or_collapse", lab(
    f'SELECT * REPLACE ({DAY.format(chr(34) + "SamplingTime" + chr(34), chr(34) + "SamplingTime" + chr(34))})'
    " FROM parts", _ELIGIBLE_SAMPLES, _PIVOT, _PARTS))
def _(t):
    # kept for both halves, as in the report
    pivoted = shared_rows(official_plan.official_pivot(t, _closed()).drop("commercial_item"), R.DEFAULT_RULES)
    rows = aggregates.average_or_collapse(pivoted, R.AVERAGED_REGIONS, official_plan.AVERAGED)
    titles = {c: n for c, n in official_plan.TITLES.items() if c != "lab_tech"}
    return layout.present(rows, titles)


# --- reports: immediate response -----------------------------------------------------------------

def _alert_sql(measure: str, limit: int) -> str:
    label = {"Somatic Cells": "Somatic cells"}.get(measure, measure)
    tested = """strftime(max(coalesce(CAST(measured - INTERVAL 5 HOUR AS DATE),
            CAST(validated - INTERVAL 5 HOUR AS DATE))), '%Y-%m-%d')"""
    return lab(f"""
    SELECT "Client Name", "ProducerCode", bar_code AS "Barcode", {_int('m')} * 1000 AS "{measure}",
      "SamplingTime", "TestDate", "Sample Temp", temperature AS "Analysis Temperature"
    FROM found JOIN tech USING (bar_code)
    WHERE {_above('m', limit)} AND lab_tech IS NOT NULL
      AND (week IS NULL OR upper(week) NOT IN ('N/A', 'NA'))
      AND "Sample Temp" IS NOT NULL AND parcel IS NOT NULL AND temperature IS NOT NULL""",
    _TECH, f"""found AS (
      SELECT max(client_name) AS "Client Name", producer_code AS "ProducerCode", bar_code,
        {DAY.format("max(sampling_date)", '"SamplingTime"')}, {tested} AS "TestDate",
        max(sample_temp) AS "Sample Temp", max(parcel_temp) AS parcel, max(billing_week) AS week,
        max(CASE WHEN name = '{label}' THEN {CODED} END) AS m,
        max(CASE WHEN name = 'Analysis Temperature' THEN {CODED} END) AS temperature
      FROM rr JOIN recent USING (line_id) JOIN ctx USING (line_id)
      WHERE tank IS NOT NULL AND sampling_time IS NOT NULL AND region = 'WI'
        AND {official(L.ALERT_TESTS)} = 'Y' AND length(rtrim(seq)) > 0
      GROUP BY producer_code, bar_code
    )""")


@query("immediate_response_bacteria", _alert_sql("Bacteria Count", 750))
def _(t):
    return alerts.immediate_response(t, "Bacteria Count", DAYS, NOW)


@query("immediate_response_cells", _alert_sql("Somatic Cells", 1000))
def _(t):
    return alerts.immediate_response(t, "Somatic Cells", DAYS, NOW)


@query("immediate_response_sheet", """SELECT * REPLACE (
      format('{:,}', "Bacteria Count") AS "Bacteria Count",
      strftime(CAST("SamplingTime" AS DATE), '%m/%d/%Y') AS "SamplingTime",
      strftime(CAST("TestDate" AS DATE), '%m/%d/%Y') AS "TestDate") FROM ("""
       + _alert_sql("Bacteria Count", 750) + ")")
def _(t):
    return records.alert_sheet(alerts.immediate_response(t, "Bacteria Count", DAYS, NOW))


# --- reports: red tag ----------------------------------------------------------------------------

def _red_tag_sql(section: str, where: str = "TRUE", only: str = "TRUE") -> str:
    shown = L.SECTIONS[section]
    ckr = "" if section == "all" else 'max(ckr_number) AS "CkrNumber",'
    return lab(f"""
    SELECT "Barcode", {"" if section == "all" else '"CkrNumber",'} "ChrNumber", "ProducerCode",
      "Tank", "Seq", "SamplingTime", "Client Name", {", ".join(f'"{m}"' for m in shown)}
    FROM samples WHERE {where}""", f"""samples AS (
      SELECT bar_code AS "Barcode", {ckr} max(chr_number) AS "ChrNumber",
        max(producer_code) AS "ProducerCode", max(tank) AS "Tank", max(seq) AS "Seq",
        {DAY.format("max(sampling_date)", '"SamplingTime"')}, max(client_name) AS "Client Name",
        {measures(L.RED_TAG_MEASURES, CODED)}
      FROM rr JOIN recent USING (line_id) JOIN ctx USING (line_id)
      WHERE order_code = 'CO-7' AND {only} GROUP BY bar_code
    )""")


@query("red_tag_all", _red_tag_sql("all"))
def _(t):
    return redtag.red_tag(t, "all", ORDER, DAYS, NOW)


@query("red_tag_components", _red_tag_sql(
    "components", " AND ".join(f'"{m}" IS NOT NULL' for m in L.COMPONENT_MEASURES)))
def _(t):
    return redtag.red_tag(t, "Components", ORDER, DAYS, NOW)


@query("red_tag_bacteria", _red_tag_sql(
    "bacteria", " OR ".join(f'"{m}" IS NOT NULL' for m in L.BACTERIA_MEASURES)))
def _(t):
    return redtag.red_tag(t, "bacteria", ORDER, DAYS, NOW)


@query("red_tag_cultures", _red_tag_sql("cultures", " OR ".join(
    f'"{m}" IS NOT NULL' for m in L.CULTURE_MEASURES if m != L.DOUBTFUL)
    + f" OR length(rtrim(\"{L.DOUBTFUL}\")) > 0"))
def _(t):
    return redtag.red_tag(t, "cultures", ORDER, DAYS, NOW)


_TAGGED = ["00000000005931", "00000000012021", "00000000001668", "00000000000001"]


@query("red_tag_for_bar_codes", _red_tag_sql(
    "all", only="bar_code IN (" + ", ".join(f"'{b}'" for b in _TAGGED) + ")"))
def _(t):
    return redtag.red_tag(t, "all", ORDER, DAYS, NOW, bar_codes=",".join(_TAGGED))


def _sections_sql() -> str:
    """The four section queries one below the other, measures of other sections NULL."""
    parts = []
    for section, measures_ in L.SECTIONS.items():
        shown = ", ".join(f'"{m}"' if m in measures_ else f'NULL AS "{m}"' for m in L.RED_TAG_MEASURES)
        number = 'NULL AS "CkrNumber"' if section == "all" else '"CkrNumber"'
        parts.append(f"""SELECT '{section}' AS section, "Barcode", {number}, "ChrNumber", "ProducerCode",
          "Tank", "Seq", "SamplingTime", "Client Name", {shown} FROM samples WHERE {_RED_TAG_WHERE[section]}""")
    return " UNION ALL ".join(parts)


_RED_TAG_WHERE = {
    "all": "TRUE",
    "components": " AND ".join(f'"{m}" IS NOT NULL' for m in L.COMPONENT_MEASURES),
    "bacteria": " OR ".join(f'"{m}" IS NOT NULL' for m in L.BACTERIA_MEASURES),
    "cultures": " OR ".join(f'"{m}" IS NOT NULL' for m in L.CULTURE_MEASURES if m != L.DOUBTFUL)
    + f' OR length(rtrim("{L.DOUBTFUL}")) > 0',
}


@query("red_tag_datasets", lab(_sections_sql(), f"""samples AS (
      SELECT bar_code AS "Barcode", max(ckr_number) AS "CkrNumber", max(chr_number) AS "ChrNumber",
        max(producer_code) AS "ProducerCode", max(tank) AS "Tank", max(seq) AS "Seq",
        {DAY.format("max(sampling_date)", '"SamplingTime"')}, max(client_name) AS "Client Name",
        {measures(L.RED_TAG_MEASURES, CODED)}
      FROM rr JOIN recent USING (line_id) JOIN ctx USING (line_id)
      WHERE order_code = 'CO-7' GROUP BY bar_code
    )"""))
def _(t):
    return redtag.red_tag_all_sections(t, ORDER, DAYS, NOW)


@query("red_tag_delivery", SQL["red_tag_datasets"])
def _(t):
    """The four datasets delivered together and read back, one below the other."""
    spark = t["sample"].sparkSession
    datasets = redtag.red_tag_datasets(t, ORDER, DAYS, NOW)
    path = f"{shared_folder(spark)}/delivery-{uuid4().hex}"
    published.publish(datasets, path)
    read = [published.read_published(spark, path, name).withColumn("section", F.lit(name)) for name in datasets]
    return reduce(lambda above, below: above.unionByName(below, allowMissingColumns=True), read)


@query("red_tag_zero_days", _red_tag_sql("all").replace(
    "TIMESTAMP '1996-05-23 05:00:00'", "CAST(NULL AS TIMESTAMP)"))  # zero leaves the start unknown
def _(t):
    return redtag.red_tag(t, "all", ORDER, 0, NOW)


# --- reports: sheets and feeds -------------------------------------------------------------------

def _mapped_pivot(labels, keys: str, value: str = "value", where: str = "TRUE") -> str:
    return f"""final AS (
      SELECT {keys}, {measures(labels, value)}
      FROM mapped JOIN exact USING (line_id) WHERE {where} GROUP BY ALL
    )"""


_PRESENT = """producer_code IS NOT NULL AND tank IS NOT NULL AND bar_code IS NOT NULL
      AND sampling_time IS NOT NULL AND length(rtrim(mid_seq)) > 0"""
_IN_IOWA = "state = 'IA' AND tank IS NOT NULL AND sampling_time IS NOT NULL"
_CODED_NF = "CASE WHEN lower(value) = 'not found' THEN 'NF' ELSE value END"


def _quoted(labels) -> str:
    return ", ".join(f'"{m}"' for m in labels)


_COMPONENTS = (
    f"""SELECT producer_code AS producercode, tank AS "Tank", mid_seq AS seq, bar_code AS "BarCode",
      visit_number AS "VisitNumber", sampling_time AS "SamplingTime", {_quoted(L.COMPONENT_MEASURES)}
    FROM final WHERE {_PRESENT} AND {" AND ".join(f'"{m}" IS NOT NULL' for m in L.COMPONENT_MEASURES)}""",
    _MAPPED,
    _mapped_pivot(L.COMPONENT_MEASURES,
                  "producer_code, tank, mid_seq, bar_code, visit_number, sampling_time"),
)


@query("components_report", lab(*_COMPONENTS))
def _(t):
    return sheets.components_report(t, DAYS, NOW)


def _mask(label: str) -> str:
    return f"""CAST(TRY_CAST(coalesce("{label}", '0') AS DECIMAL(18, 2)) AS VARCHAR) AS "{label}" """


def _frozen(label: str, sign: str = "-") -> str:
    return (f'CAST(CAST({sign}TRY_CAST("{label}" AS DOUBLE) / 1000 AS DECIMAL(12, 3)) AS VARCHAR)'
            f' AS "{label}"')


_MASKED = ["Fat", "True Protein", "Lactose", "Other Solids"]


@query("components_sheet", lab(
    f"""SELECT * REPLACE ({", ".join(map(_mask, _MASKED))}, {_frozen("Freezing point")})
    FROM ({_COMPONENTS[0]})""", *_COMPONENTS[1:]))
def _(t):
    return records.components_sheet(sheets.components_report(t, DAYS, NOW))


_INSPECTOR = (
    f"""SELECT producer_code AS producercode, tank AS "Tank", mid_seq AS seq,
      producer_name AS "ProducerName", visit_number AS "VisitNumber",
      sampling_time AS "SamplingTime", "Bacteria", "Somatic cells", "Freezing point", "Delvo Inhibitor"
    FROM final WHERE {_PRESENT} AND "Somatic cells" IS NOT NULL AND "Freezing point" IS NOT NULL""",
    _MAPPED,
    _mapped_pivot(
        L.INSPECTOR_MEASURES,
        "producer_code, state, producer_name, state_rep, tank, mid_seq, bar_code, visit_number,"
        " sampling_time", _CODED_NF, _IN_IOWA),
)


@query("inspector_report", lab(*_INSPECTOR))
def _(t):
    return sheets.inspector_report(t, DAYS, NOW)


@query("inspector_sheet", lab(
    f"""SELECT * REPLACE (regexp_replace("Freezing point", '\\.?0+$', '') AS "Freezing point")
    FROM (SELECT * REPLACE ({_frozen("Freezing point")}) FROM ({_INSPECTOR[0]}))""", *_INSPECTOR[1:]))
def _(t):
    return records.inspector_sheet(sheets.inspector_report(t, DAYS, NOW))


@query("inspector_wide", lab(
    f"""SELECT producer_code AS producercode, state AS "State", state_rep AS "StateRep",
      tank AS "Tank", mid_seq AS seq, bar_code AS "BarCode", visit_number AS "VisitNumber",
      sampling_time AS "SamplingTime", {_quoted(L.INSPECTOR_WIDE_MEASURES)} FROM final""",
    _MAPPED,
    _mapped_pivot(
        L.INSPECTOR_WIDE_MEASURES,
        "producer_code, state, state_rep, tank, mid_seq, bar_code, visit_number, sampling_time",
        _CODED_NF, _IN_IOWA)))
def _(t):
    return sheets.inspector_wide(t, DAYS, NOW)


@query("inspector_count", lab(
    f"""SELECT count(DISTINCT bar_code) AS "numOfTests" FROM mapped JOIN exact USING (line_id)
    WHERE {_IN_IOWA}""", _MAPPED))
def _(t):
    return sheets.inspector_count(t, DAYS, NOW)


_DAIRY = (
    f"""SELECT producer_code AS producercode, tank AS "Tank", mid_seq AS seq, bar_code AS "BarCode",
      route_number AS "RouteNumber", {DAY.format("taken", '"SamplingTime"')}, ihb AS "IHB",
      official AS "Official", {_quoted(L.FEED_MEASURES)}
    FROM final WHERE {_PRESENT.replace("sampling_time", "taken")}""",
    _MAPPED,
    _mapped_pivot(
        L.FEED_MEASURES,
        "producer_code, tank, mid_seq, bar_code, route_number, CAST(sampling_time AS DATE) AS taken,"
        f" {_inhibitor_sql('NF', 'AL', 'NT', True)} AS ihb,"
        " CASE WHEN item = 'MVPQVP8' THEN 'Y' ELSE 'N' END AS official"),
)


@query("dairy_sheet", lab(*_DAIRY))
def _(t):
    return sheets.dairy_sheet(t, DAYS, NOW)


@query("dairy_print", lab(
    f"""SELECT * REPLACE ({", ".join(map(_mask, [*_MASKED, "Solids not fat (SNF)", "Milk Urea Nitrogen (MUN)"]))}),
      CASE WHEN "Freezing point" IS NULL THEN '<0.1'
        ELSE {_WATER.replace("value", '"Freezing point"')} END AS "Water"
    FROM ({_DAIRY[0]})""", *_DAIRY[1:]))
def _(t):
    return records.dairy_print(sheets.dairy_sheet(t, DAYS, NOW))


_TESTED = "coalesce(validated, measured) - INTERVAL 5 HOUR"
_FEED_KEYS = "producer_code, tank, mid_seq, bar_code, visit_number, sampling_time, sample_temp"


def _feed(select: str, keys: str, labels, needed) -> tuple[str, ...]:
    where = " AND ".join([_PRESENT, *[f'"{m}" IS NOT NULL' for m in needed]])
    return (f"SELECT {select} FROM final WHERE {where}", _MAPPED,
            _mapped_pivot(labels, f"{_FEED_KEYS}, {keys}", where=_IN_IOWA))


_GOAT = _feed(
    """'01' AS "DSI Company", '141' AS "DSI Division", producer_code AS "ProducerCode", '' AS "Load",
      '0' AS "Fixed1", sampling_time AS "SamplingTime", tested AS "TestDate", official AS "Official",
      "Fat", "True Protein", "Lactose", "Solids not fat (SNF)", '' AS "Total Solids",
      "Somatic cells", sample_temp AS "TemperatureAtSampling", "Bacteria", "Freezing point",
      '00.00' AS "Water", '' AS "Blank1", ihb AS "IHB", '' AS "Sedi", '' AS "Blank2",
      tank AS "Tank", '' AS "Blank3", 'LAB' AS "Fixed Lab", "Coliforms", "Lab Pasteurized Count",
      "Pre-incubation Count (PI)", '' AS "Blank4", mid_seq AS seq, '' AS "Sample ID ?",
      "Milk Urea Nitrogen (MUN)", '0' AS "Fixed2", anti_flag AS "Anti #", '0' AS "Fixed3",
      tested AS "CompTestDate", '0' AS "Fixed4" """,
    f"""{_inhibitor_sql('NF', 'AL', 'NT', False)} AS ihb, {_inhibitor_sql('2', '1', '0', False)} AS anti_flag,
      CASE WHEN item = 'MVPQVP8' THEN '99' END AS official, {_TESTED} AS tested""",
    L.FEED_MEASURES, ["Somatic cells", "Freezing point"])


@query("goat_feed", lab(*_GOAT))
def _(t):
    return feeds.goat_feed(t, DAYS, NOW)


_GOAT_ZERO = tuple(
    part.replace('tested AS "TestDate"', '\'00000000\' AS "TestDate"')
    .replace('tested AS "CompTestDate"', '\'00000000\' AS "CompTestDate"')
    .replace(f", {_TESTED} AS tested", "") for part in _GOAT)


@query("goat_feed_zero_dates", lab(*_GOAT_ZERO))
def _(t):
    return feeds.goat_feed(t, DAYS, NOW, test_dates=False)


def _implied(label: str) -> str:
    return f"""replace(format('{{:,.2f}}', TRY_CAST("{label}" AS DOUBLE)), '.', '') AS "{label}" """


@query("goat_record", lab(
    f"""SELECT * REPLACE ({", ".join(map(_implied, [
        "Fat", "True Protein", "Lactose", "Solids not fat (SNF)", "Milk Urea Nitrogen (MUN)"]))},
      strftime("SamplingTime", '%m%d%Y') AS "SamplingTime",
      coalesce(replace(format('{{:,.2f}}', CAST(TRY_CAST("Fat" AS DECIMAL(18, 2))
        + TRY_CAST("Solids not fat (SNF)" AS DECIMAL(18, 2)) AS DOUBLE)), '.', ''), '')
        AS "Total Solids",
      CAST(CAST(coalesce("TemperatureAtSampling", 0) AS INT) AS VARCHAR) AS "TemperatureAtSampling",
      CASE WHEN length(seq) < 4 THEN '0' || seq ELSE seq END AS seq)
    FROM ({_GOAT[0]})""", *_GOAT[1:]))
def _(t):
    return records.goat_record(feeds.goat_feed(t, DAYS, NOW))


_MN_KEYS = f"""state, producer_name, state_rep, grade, {_TESTED} AS tested,
      {_inhibitor_sql('2', '1', '0', True)} AS ihb"""
_MN_SELECT = """producer_code AS "ProducerCode", sampling_time AS "SamplingTime",
      sample_temp AS "TemperatureAtSampling", "Somatic cells", "Bacteria", ihb AS "IHB",
      '00' AS "ST#", '000' AS "Plant BTU#", '00000' AS "FIXED(5)", '0' AS "Fixed(1)",
      tested AS "SccTestDate", tested AS "SpcTestDate", '000000' AS "FIXED(6)",
      '00000000' AS "FIXED(8)", coalesce(grade, '0') AS "MilkGrade" """
_MN = _feed(_MN_SELECT, _MN_KEYS, L.COUNT_MEASURES, ["Somatic cells"])


@query("minnesota_feed", lab(*_MN))
def _(t):
    return feeds.minnesota_feed(t, DAYS, NOW)


def _digits(label: str, width: int) -> str:
    return f"""CASE WHEN "{label}" IS NULL THEN '{"0" * width}'
      ELSE printf('%0{width}d', CAST(TRY_CAST("{label}" AS DOUBLE) AS INT)) END AS "{label}" """


_COUNTED = ", ".join([_digits("TemperatureAtSampling", 2), _digits("Somatic cells", 4),
                      _digits("Bacteria", 4)])


_MN_DEPLOYED = _feed(
    _MN_SELECT.replace('tested AS "SccTestDate", tested AS "SpcTestDate"',
                       '\'00000000\' AS "ESCC Date", \'00000000\' AS "PLC Date"')
    .replace('"MilkGrade"', '"Grade"'),
    _MN_KEYS.replace(f"{_TESTED} AS tested,", ""), [*L.COUNT_MEASURES, "Freezing point"],
    ["Somatic cells", "Freezing point"])


@query("minnesota_record_zero_dates", lab(
    f"""SELECT * REPLACE (strftime("SamplingTime", '%Y%d%m') AS "SamplingTime", {_COUNTED})
    FROM ({_MN_DEPLOYED[0]})""", *_MN_DEPLOYED[1:]))
def _(t):
    return records.minnesota_record(
        feeds.minnesota_feed(t, DAYS, NOW, need_freezing_point=True, test_dates=False))


@query("minnesota_feed_with_freezing_point", lab(*_feed(
    _MN_SELECT, _MN_KEYS, [*L.COUNT_MEASURES, "Freezing point"],
    ["Somatic cells", "Freezing point"])))
def _(t):
    return feeds.minnesota_feed(t, DAYS, NOW, need_freezing_point=True)


@query("minnesota_record", lab(
    f"""SELECT * REPLACE (strftime("SamplingTime", '%Y%d%m') AS "SamplingTime", {_COUNTED})
    FROM ({_MN[0]})""", *_MN[1:]))
def _(t):
    return records.minnesota_record(feeds.minnesota_feed(t, DAYS, NOW))


def _wisconsin_sql(scc: str, spc: str) -> tuple[str, ...]:
    return _feed(
        """'7' AS "Fixed1", '1' AS "Fixed2", '3' AS "Fixed3", '4100' AS "PlantNum",
      producer_code AS "ProducerCode", sampling_time AS "SamplingTime", '1' AS "Fixed4",
      '7134' AS "LabNum", sample_temp AS "TemperatureAtSampling", '1' AS "Fixed5", "Bacteria",
      "Somatic cells", anti_flag AS "Anti", '0' AS "Fixed6", '00000000' AS "Fixed7", '0' AS "Fixed8",
      grade AS "Grade", scc AS "SccTestDate", spc AS "SpcTestDate", '000' AS "Fixed9",
      'ELECTRONIC' AS "Fixed10" """,
        f"""route_number, state, producer_name, state_rep, grade, {scc} AS scc, {spc} AS spc,
      CASE WHEN item = 'MVPQVP8' AND param = 'Z001JJPC' THEN '2' ELSE '0' END AS anti_flag""",
        L.COUNT_MEASURES, ["Somatic cells"])


_WI = _wisconsin_sql(_TESTED, _TESTED)


@query("wisconsin_feed", lab(*_WI))
def _(t):
    return feeds.wisconsin_feed(t, DAYS, NOW)


@query("wisconsin_feed_dates_per_test", lab(*_wisconsin_sql(
    f"CASE WHEN param = 'JJ00047N' THEN {_TESTED} END",
    f"CASE WHEN param = 'UM0004ZH' THEN {_TESTED} END")))
def _(t):
    return feeds.wisconsin_feed(t, DAYS, NOW, dates_per_test=True)


@query("wisconsin_record", lab(
    f"""SELECT * REPLACE (strftime("SamplingTime", '%Y%m%d') AS "SamplingTime", {_COUNTED},
      CASE WHEN coalesce(rtrim("Grade"), '') = '' THEN 'N/A' ELSE "Grade" END AS "Grade",
      coalesce(strftime("SccTestDate", '%Y%m%d'), '00000000') AS "SccTestDate",
      coalesce(strftime("SpcTestDate", '%Y%m%d'), '00000000') AS "SpcTestDate")
    FROM ({_WI[0]})""", *_WI[1:]))
def _(t):
    return records.wisconsin_record(feeds.wisconsin_feed(t, DAYS, NOW))


_TN = _feed(
    f"""'27-B-00134' AS "Lab Number", '' AS "Division", producer_code AS "Member", tank AS "Tank",
      'T54048' AS "Permit", producer_name AS "Producer Name", '' AS "Class",
      {DAY.format("sampling_time", '"Pickup Date"')}, strftime(sampling_time, '%H:%M') AS "Pickup Time",
      '00/00/00' AS "Recd Date", sample_temp AS "Temp-F", "Bacteria" AS "SPC (x1000)",
      "Bacteria" AS "SPC Reported (x1000)", 'BSC' AS "SPC Source", "Somatic cells",
      ihb AS "AB Delvo 5 Pack", '' AS "Sedi", "Freezing point" AS "FreezePoint", '47-167' AS "BTU",
      route_number AS "Route", '' AS "Load" """,
    f"""route_number, state, producer_name, state_rep, grade,
      {_inhibitor_sql('NF', 'AL', 'NT', False)} AS ihb""",
    L.FEED_MEASURES, ["Somatic cells", "Freezing point"])


@query("tennessee_feed", lab(*_TN))
def _(t):
    return feeds.tennessee_feed(t, DAYS, NOW)


@query("tennessee_feed_fixed_count", lab(
    _TN[0].replace('"Bacteria" AS "SPC (x1000)"', '\'575\' AS "SPC (x1000)"')
    .replace('"Bacteria" AS "SPC Reported (x1000)"', '\'575\' AS "SPC Reported (x1000)"'), *_TN[1:]))
def _(t):
    return feeds.tennessee_feed(t, DAYS, NOW, plate_count="575")


def _state_rounded(label: str) -> str:
    return f"""nullif({_ROUNDED.replace("value", f'"{label}"')}, '0') AS "{label}" """


@query("tennessee_record", lab(
    f"""SELECT * REPLACE (strftime(CAST("Pickup Date" AS DATE), '%m/%d/%Y') AS "Pickup Date",
      CAST(CAST(coalesce("Temp-F", 0) AS INT) AS VARCHAR) AS "Temp-F",
      {_state_rounded("SPC Reported (x1000)")}, {_state_rounded("Somatic cells")},
      {_frozen("FreezePoint", "")})
    FROM ({_TN[0]})""", *_TN[1:]))
def _(t):
    return records.tennessee_record(feeds.tennessee_feed(t, DAYS, NOW))


# --- reports: legacy official --------------------------------------------------------------------

def _legacy_sql(lab_copy: bool) -> str:
    labels = L.OFFICIAL_MEASURES if lab_copy else L.LEGACY_MEASURES
    by = "region" if lab_copy else "state"
    keys = ["producer_name", "permit_number", "field_rep", "state_rep", "sample_temp", "parcel_temp",
            "client_name", "state"] + (["region"] if lab_copy else [])
    names = ["ProducerName", "PermitNumber", "FieldRep", "StateRep", "Sample Temp", "Parcel Temp",
             "Client Name", "State"] + (["ReportingState"] if lab_copy else [])
    extra = ["Delvo Inhibitor"] + (["Analysis Temperature"] if lab_copy else [])
    unit = ', bar_code AS "Barcode"' if lab_copy else ""
    columns = [*zip(keys, names), *zip(extra, extra)]
    usable = f"""usable AS (SELECT * FROM piv WHERE is_official = 'Y' AND length(rtrim(mid_seq)) > 0
      AND bar_code IS NOT NULL AND sampling_date IS NOT NULL
      AND {" AND ".join(f'"{m}" IS NOT NULL' for m in L.LEGACY_MEASURES)})"""
    pivot = f"""piv AS (
      SELECT producer_code, tank, mid_seq, bar_code, sampling_date, {", ".join(keys)},
        {official(L.RED_TAG_TESTS)} AS is_official, {measures(labels, CODED)}
      FROM rr JOIN exact USING (line_id) JOIN ctx USING (line_id)
      WHERE tank IS NOT NULL AND sampling_time IS NOT NULL GROUP BY ALL)"""
    parts = f"""parts AS (
      SELECT producer_code AS "ProducerCode", u.tank AS "Tank", u.seq AS "Seq",
        usable.sampling_date AS "SamplingTime"{unit},
        {", ".join(f'''{mean(f'"{c}"')} AS "{n}"''' for c, n in _CELLS)},
        {", ".join(f'max("{c}") AS "{n}"' for c, n in columns)}
      FROM usable JOIN (
        SELECT producer_code, sampling_date, string_agg(tank, ',' ORDER BY tank) AS tank,
          string_agg(mid_seq, ',' ORDER BY mid_seq) AS seq FROM piv GROUP BY ALL
      ) u USING (producer_code, sampling_date)
      WHERE {by} IN ('MN', 'MO', 'WI')
      GROUP BY producer_code, usable.sampling_date, u.tank, u.seq{", bar_code" if lab_copy else ""}
      UNION ALL BY NAME
      SELECT producer_code AS "ProducerCode", tank AS "Tank", mid_seq AS "Seq",
        sampling_date AS "SamplingTime"{unit}, {", ".join(f'"{c}" AS "{n}"' for c, n in _CELLS)},
        {", ".join(f'"{c}" AS "{n}"' for c, n in columns)}
      FROM usable WHERE {by} NOT IN ('MN', 'MO', 'WI'))"""
    if lab_copy:
        return lab(_finish("parts", "TRUE"), pivot, usable, parts, _TECH)
    return lab(f"""SELECT * REPLACE ({DAY.format('"SamplingTime"', '"SamplingTime"')}) FROM parts""",
               pivot, usable, parts)


@query("legacy_official_state", _legacy_sql(lab_copy=False))
def _(t):
    return legacy.legacy_official(t, "state", DAYS, NOW)


@query("legacy_official_lab", _legacy_sql(lab_copy=True))
def _(t):
    return legacy.legacy_official(t, "lab", DAYS, NOW)


# --- from stored tables --------------------------------------------------------------------------

def _stored(t) -> dict[str, DataFrame]:
    """The tables written in the stored layout and read back, reference data from a place of their own."""
    spark = t["sample"].sparkSession
    path = f"{shared_folder(spark)}/lab-{uuid4().hex}"
    save_lab({name: t[name] for name in SCHEMAS}, f"{path}/lab", f"{path}/reference")
    return load_tables(spark, f"{path}/lab", f"{path}/reference")


@query("stored_inspector_report", SQL["inspector_report"])
def _(t):
    return sheets.inspector_report(_stored(t), DAYS, NOW)


@query("stored_official_report", SQL["official_report_raw"])
def _(t):
    return official_plan.official_report(_stored(t), FIRST, LAST, mode="Raw")
