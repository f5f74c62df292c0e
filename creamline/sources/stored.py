"""The laboratory's results in files laid out for reports.

Results lie in a folder for the month in which their line was completed, sorted by line. All results of a line are
in one folder, so a report on a window reads the folders of its months and no others, and a line's results lie
together in few row groups, which the run-time filter of the lines and the files' own statistics use.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creamline.functions.dates import ReportWindow
from creamline.sources.tables import REFERENCE_TABLES

MONTH = "completed_month"


def with_month(results: DataFrame) -> DataFrame:
    """Results with the month (year * 100 + month; 0: never validated) in which their line was completed."""
    line, stamp = "commercial_order_line_id", F.max("result_validation_date")
    month = F.coalesce(F.year(stamp) * 100 + F.month(stamp), F.lit(0))
    months = results.groupBy(F.col(line).alias("_line")).agg(month.alias(MONTH))
    return results.join(months, F.col(line).eqNullSafe(F.col("_line"))).drop("_line")


def save_lab(tables: Mapping[str, DataFrame], path: str, reference_path: str | None = None) -> None:
    """Writes all tables, the results by month and line, for ``load_tables``.

    Rows are dealt by ranges of (month, line): a month with very many results gets many files, and a month with
    few no more than it needs.
    """
    for name, frame in tables.items():
        base = reference_path if reference_path and name in REFERENCE_TABLES else path
        target = f"{base.rstrip('/')}/{name}"
        if name == "reportable_result":
            order = [MONTH, "commercial_order_line_id"]
            laid = with_month(frame).repartitionByRange(*order).sortWithinPartitions(*order)
            laid.write.partitionBy(MONTH).parquet(target)
        else:
            frame.write.parquet(target)


def in_months(results: DataFrame, window: ReportWindow) -> DataFrame:
    """The results of the months that a window touches, where results are laid out by month.

    Lines completed in the window have all their results there; of other lines all or none are.
    """
    if MONTH not in results.columns or window.start is None or window.end is None:
        return results
    first, last = (day.year * 100 + day.month for day in (window.start, window.end))
    return results.filter(F.col(MONTH).between(first, last))
