"""Which order lines count for a report, and which lines come along with them."""

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creamline.functions.dates import ReportWindow
from creamline.functions.text import same_text
from creamline.operators.completion_state import state_completions
from creamline.sources.stored import in_months


def completions(results: DataFrame, window: ReportWindow) -> DataFrame:
    """Order line ids (``id``) whose last validation falls inside the window.

    Results from before the start cannot be a line's last one inside the window, so that bound goes
    to the scan. Results after the end stay: they are what disqualifies a line.
    """
    stamp = F.col("result_validation_date")
    return (
        in_months(results, window).filter(window.after_start(stamp))
        .groupBy(F.col("commercial_order_line_id").alias("id"))
        .agg(F.max(stamp).alias("completed_at"))
        .filter(window.before_end(F.col("completed_at")))
    )


def completed_in_window(
    results: DataFrame,
    lines: DataFrame,
    window: ReportWindow,
    status: str | None = None,
    state: DataFrame | None = None,
) -> DataFrame:
    """Order lines completed in the window. Results are reduced to lines before the join.

    With the ``state`` of ``completion_state`` the days of the window are read from there, and no results.
    """
    done = completions(results, window) if state is None else state_completions(state, window)
    return with_status(lines, status).join(done, "id")


def with_status(lines: DataFrame, status: str | None) -> DataFrame:
    if status is None:
        return lines
    return lines.filter(same_text(F.col("commercial_order_line_status"), status))


def samples_with_items(eligible: DataFrame, items: Iterable[str]) -> DataFrame:
    """Distinct samples having an eligible line for one of ``items``."""
    return eligible.filter(F.col("commercial_item").isin(list(items))).select("sample_id").distinct()


def expand_to_samples(
    eligible: DataFrame, lines: DataFrame, items: Iterable[str], status: str | None = None
) -> DataFrame:
    """All lines of those samples, whether or not the line itself is inside the window."""
    samples = samples_with_items(eligible, items)
    return with_status(lines, status).join(samples, "sample_id", "left_semi")
