"""Joining results with their order line, sample, order, client and producer.

No join carries a hint. A side is broadcast when its size, known from the files or measured at run time,
is under the session's threshold, and both are shuffled otherwise. Results are cut to the lines of a report
in their scan, by a filter built at run time, before they meet anything in a join.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creamline.operators.runtime_filter import BITS, may_be_wanted

Tables = Mapping[str, DataFrame]


def enrich_lines(lines: DataFrame, tables: Tables) -> DataFrame:
    """Order lines with everything known about them except their results."""
    sample = tables["sample"].withColumnRenamed("id", "sample_id")
    order = tables["commercial_order"].withColumnRenamed("id", "commercial_order_id")
    client = tables["customer_framework"].select(
        F.col("id").alias("customer_framework_id"),
        F.col("internal_name").alias("client_name"),
        "customer_code",
    )
    producer = tables["producer"].withColumnRenamed("id", "producer_id")
    return (
        lines.withColumnRenamed("id", "commercial_order_line_id")
        .join(order, "commercial_order_id")
        .join(client, "customer_framework_id")
        .join(sample, "sample_id")
        .join(producer, "producer_id")
    )


def enrich_results(results: DataFrame, enriched_lines: DataFrame) -> DataFrame:
    """Results, or measures pivoted per line, with their enriched order line."""
    return results.join(enriched_lines, "commercial_order_line_id")


def near_lines(results: DataFrame, lines: DataFrame, bits: int = BITS) -> DataFrame:
    """The results of these lines and few others, cut in the scan of the results.

    For results that are joined with the lines later: that join drops the few.
    """
    return results.filter(may_be_wanted(lines, ["commercial_order_line_id"], bits, grows=True))


def of_lines(results: DataFrame, lines: DataFrame, bits: int = BITS) -> DataFrame:
    """Only the results of these lines: cut in the scan, then exactly by a semi join over what is left."""
    ids = lines.select("commercial_order_line_id")
    return near_lines(results, ids, bits).join(ids, "commercial_order_line_id", "left_semi")


def name_parameters(results: DataFrame, test_parameter: DataFrame, how: str = "left") -> DataFrame:
    """Adds ``test_parameter_name``; with ``how='left'`` unknown parameters stay, unnamed."""
    names = test_parameter.withColumnRenamed("test_parameter_code", "commercial_parameter_code")
    return results.join(names, "commercial_parameter_code", how)


def mapped_pairs(tables: Tables) -> DataFrame:
    """Known items with each parameter mapped to them."""
    items = tables["commercial_item"].withColumnRenamed("commercial_item_code", "commercial_item")
    mapped = tables["commercial_item_test_parameter_map"].select(
        F.col("commercial_item_id").alias("commercial_item"),
        F.col("test_parameter_code").alias("commercial_parameter_code"),
    )
    return mapped.join(items, "commercial_item", "left_semi")


def restrict_to_mapped(results: DataFrame, tables: Tables) -> DataFrame:
    """Keeps results whose item is known and mapped to their parameter."""
    return results.join(
        mapped_pairs(tables), ["commercial_item", "commercial_parameter_code"], "left_semi"
    )


def group_members(tables: Tables) -> DataFrame:
    """Producer ids with each of their group names; a producer without groups has a NULL one."""
    groups = tables["producer_group"].withColumnRenamed("id", "producer_group_id")
    membership = tables["producer_list"].join(groups, "producer_group_id", "left")
    producers = tables["producer"].select(F.col("id").alias("producer_id"))
    return producers.join(membership, "producer_id", "left").select(
        "producer_id", "producer_group_name"
    )


def fill_from_lookup(
    frame: DataFrame, lookup: DataFrame, key: str, value: str, target: str
) -> DataFrame:
    """Overwrites ``target`` with the lookup's value where the key is found.

    ``lookup`` may hold several rows per key; the greatest value is taken, so that the outcome does
    not depend on row order and the frame keeps its row count.
    """
    single = lookup.groupBy(key).agg(F.max(value).alias("_found"))
    columns = [
        F.coalesce("_found", target).alias(c) if c == target else F.col(f"`{c}`")
        for c in frame.columns
    ]
    return frame.join(single, key, "left").select(columns)


def lines_of_samples(tables: Tables, bar_codes: DataFrame | None = None) -> DataFrame:
    """(commercial_order_line_id, bar_code) of every order line; ``bar_codes`` limits them to samples with these."""
    samples = tables["sample"].select(F.col("id").alias("sample_id"), "bar_code")
    if bar_codes is not None:
        samples = samples.join(bar_codes, "bar_code", "left_semi")
    lines = tables["commercial_order_line"].select(F.col("id").alias("commercial_order_line_id"), "sample_id")
    return lines.join(samples, "sample_id").drop("sample_id")


def technicians(
    tables: Tables, parameter: str, lines: DataFrame | None = None, bits: int = BITS
) -> DataFrame:
    """Bar codes with the operators who measured ``parameter`` on any of their order lines.

    ``lines`` (``commercial_order_line_id``, ``bar_code``) limits the work to all lines of samples that will be
    looked up. It is read twice, for the cut of the results and for the join.
    """
    known = tables["test_parameter"].filter(F.col("test_parameter_code") == parameter)
    measured = (
        tables["reportable_result"]
        .filter(F.col("commercial_parameter_code") == parameter)
        .join(
            known.withColumnRenamed("test_parameter_code", "commercial_parameter_code"),
            "commercial_parameter_code",
            "left_semi",
        )
        .select("commercial_order_line_id", F.col("result_set_sequence_no").alias("sequence_number"))
    )
    wanted = lines_of_samples(tables) if lines is None else lines
    return (
        near_lines(measured, wanted, bits)
        .join(wanted, "commercial_order_line_id")
        .join(tables["result_set"], "sequence_number")
        .select("bar_code", "operator_code")
    )
