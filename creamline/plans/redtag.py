"""Red tag report: everything measured for one order, in four sections."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creamline.functions.dates import days_from_midnight, local_date
from creamline.functions.text import has_text, same_text, seq_right
from creamline.operators.aggregates import collapse_by_key
from creamline.operators.completion import completions, with_status
from creamline.operators.filters import (
    all_present,
    any_present,
    any_present_or_blank,
    restrict_to_keys,
)
from creamline.operators.joins import Tables, enrich_lines, enrich_results, near_lines
from creamline.operators.layout import present
from creamline.plans.rules import (
    BACTERIA_MEASURES,
    COMPONENT_MEASURES,
    CULTURE_MEASURES,
    DEFAULT_RULES,
    RED_TAG_TESTS,
    LabRules,
)
from creamline.plans.steps import measured_lines, report_lines, results_until, shared_rows
from creamline.sources.tables import parse_key_list

MEASURES = tuple(dict.fromkeys([*COMPONENT_MEASURES, *BACTERIA_MEASURES, *CULTURE_MEASURES]))
LATE_MEASURE = "Bulk Tank Coliforms"  # only the cultures section shows it
DOUBTFUL = "Prototheca species"  # counts as present only when it holds text

_HEAD = {  # fixed values: report column names
    "bar_code": "Barcode",
    "ckr_number": "CkrNumber",
    "chr_number": "ChrNumber",
    "producer_code": "ProducerCode",
    "tank": "Tank",
    "seq": "Seq",
    "sampling_date": "SamplingTime",
    "client_name": "Client Name",
}
SECTIONS = {
    "all": [m for m in MEASURES if m != LATE_MEASURE],
    "components": list(COMPONENT_MEASURES),
    "bacteria": list(BACTERIA_MEASURES),
    "cultures": list(CULTURE_MEASURES),
}


def red_tag_samples(
    tables: Tables,
    order_code: str | None,
    days: int | None = None,
    now: datetime | None = None,
    bar_codes: str | None = None,
    rules: LabRules = DEFAULT_RULES,
) -> DataFrame:
    """One row per bar code with all measures; what the sections select from."""
    window = days_from_midnight(days, now, default=30, zero_is_unset=True)
    lines = enrich_lines(with_status(tables["commercial_order_line"], rules.status), tables)
    wanted = F.lit(False) if order_code is None else same_text(
        F.col("commercial_order_code"), order_code
    )
    keys = parse_key_list(lines.sparkSession, bar_codes)
    lines = restrict_to_keys(lines.filter(wanted), keys, "bar_code")
    lines = report_lines(lines.select(
        "commercial_order_line_id",
        "producer_code", "tank", seq_right(F.col("bar_code")).alias("seq"), "bar_code",
        local_date(F.col("sampling_time")).alias("sampling_date"),
        "client_name", "chr_number", "ckr_number", "commercial_order_code",
    ), rules)
    results = near_lines(tables["reportable_result"], lines, rules.filter_bits)
    finished = completions(results, window).withColumnRenamed("id", "commercial_order_line_id")
    samples = lines.join(finished, "commercial_order_line_id").drop("completed_at")
    measured = measured_lines(
        tables, results_until(tables["reportable_result"], window), lines, MEASURES, RED_TAG_TESTS, {}, rules
    )
    rows = enrich_results(measured, samples).drop("commercial_order_line_id")
    return collapse_by_key(rows, ["bar_code"])


def _in_section(section: str) -> Column:
    """Whether a sample belongs to a section."""
    present = [F.col(f"`{m}`").isNotNull() for m in SECTIONS[section]]
    if section == "components":
        return reduce(and_, present)
    if section == "bacteria":
        return reduce(or_, present)
    if section == "cultures":
        known = [F.col(f"`{m}`").isNotNull() for m in SECTIONS[section] if m != DOUBTFUL]
        return reduce(or_, known) | has_text(F.col(f"`{DOUBTFUL}`"))
    return F.lit(True)


def red_tag_section(samples: DataFrame, section: str = "all", sort: bool = True) -> DataFrame:
    """All samples, those with every component, any bacteria measure, or any culture measure."""
    section = section.lower()
    measures = SECTIONS[section]
    if section == "components":
        samples = all_present(samples, measures)
    elif section == "bacteria":
        samples = any_present(samples, measures)
    elif section == "cultures":
        samples = any_present_or_blank(samples, measures, DOUBTFUL)
    head = {c: t for c, t in _HEAD.items() if section != "all" or c != "ckr_number"}
    report = present(samples, head | {m: m for m in measures})
    return report.orderBy("ProducerCode", "Tank", "SamplingTime") if sort else report


def red_tag(
    tables: Tables,
    section: str,
    order_code: str | None,
    days: int | None = None,
    now: datetime | None = None,
    bar_codes: str | None = None,
    rules: LabRules = DEFAULT_RULES,
    sort: bool = True,
) -> DataFrame:
    samples = red_tag_samples(tables, order_code, days, now, bar_codes, rules)
    return red_tag_section(samples, section, sort)


def red_tag_all_sections(
    tables: Tables,
    order_code: str | None,
    days: int | None = None,
    now: datetime | None = None,
    bar_codes: str | None = None,
    rules: LabRules = DEFAULT_RULES,
) -> DataFrame:
    """All four sections in one frame, each row under the ``section`` it belongs to.

    The samples are computed once. A measure that a section does not list is NULL in its rows.
    """
    samples = red_tag_samples(tables, order_code, days, now, bar_codes, rules)
    sections = F.array_compact(F.array(*[F.when(_in_section(s), F.lit(s)) for s in SECTIONS]))
    rows = samples.withColumn("section", F.explode(sections))
    listed = {m: [s for s, own in SECTIONS.items() if m in own] for m in MEASURES}
    shown = {m: F.when(F.col("section").isin(in_), F.col(f"`{m}`")) for m, in_ in listed.items()}
    number = F.when(F.col("section") != "all", F.col("ckr_number"))
    heads = {title: number if c == "ckr_number" else F.col(c) for c, title in _HEAD.items()}
    return rows.select("section", *[col.alias(title) for title, col in (heads | shown).items()])


def red_tag_datasets(
    tables: Tables,
    order_code: str | None,
    days: int | None = None,
    now: datetime | None = None,
    bar_codes: str | None = None,
    rules: LabRules = DEFAULT_RULES,
) -> dict[str, DataFrame]:
    """The four sections as frames of their own, for writers that want one folder each; computed once for all."""
    samples = shared_rows(red_tag_samples(tables, order_code, days, now, bar_codes, rules), rules)
    return {section: red_tag_section(samples, section) for section in SECTIONS}
