"""Completion kept up to date as results arrive, so that a report need not read all later results.

The state is a log of short rows. Each merge of a batch adds, per line whose last validation moved, the new time under
its day, and under the former day, if another, that the line left it. A report reads the days of its window only:
of each line's rows there the newest batch's counts. Late results, repeated ones and batches in any order leave the
state right, since a time only ever moves up.

Batches become visible by a manifest (``sources.published``): a merge that fails leaves the state as it was, and the
same batch can be merged again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creamline.functions.dates import ReportWindow
from creamline.operators.runtime_filter import BITS, may_be_wanted
from creamline.sources.published import current, publish, read_published

_STATE = "line_completions"
_DAYS = ("batch", "day")
SCHEMA = "id bigint, completed_at timestamp_ntz, left boolean, batch bigint, day date"


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the state (id, completed_at, left, batch, day)."""
    return read_published(spark, path, _STATE, SCHEMA)


def _newest(rows: DataFrame) -> DataFrame:
    """(id, completed_at) by the newest batch's word on each line, of the lines that are still there."""
    last = F.max(F.struct("batch", ~F.col("left"), "completed_at")).alias("last")
    there = F.col("last.col2")
    return rows.groupBy("id").agg(last).filter(there).select("id", F.col("last.completed_at").alias("completed_at"))


def state_completions(state: DataFrame, window: ReportWindow) -> DataFrame:
    """What ``completions`` gives from all results: (id, completed_at) of the lines completed in the window."""
    if window.start is None or window.end is None:
        return state.select("id", "completed_at").filter(F.lit(False))
    days = F.col("day").between(F.lit(window.start.date()), F.lit(window.end.date()))
    done = _newest(state.filter(days))
    return done.filter(window.after_start(F.col("completed_at")) & window.before_end(F.col("completed_at")))


def merge_results(results: DataFrame, path: str, bits: int = BITS) -> int:
    """Takes a batch of results into the state; returns the state's version."""
    spark = results.sparkSession
    version, _ = current(spark, path)
    stamp = F.col("result_validation_date")
    fresh = (
        results.filter(stamp.isNotNull() & F.col("commercial_order_line_id").isNotNull())
        .groupBy(F.col("commercial_order_line_id").alias("id")).agg(F.max(stamp).alias("completed_at"))
    )
    known = read_state(spark, path).filter(may_be_wanted(fresh.select("id"), ["id"], bits))
    before = _newest(known).withColumnRenamed("completed_at", "former")
    moved = fresh.join(before, "id", "left").filter("former IS NULL OR completed_at > former")
    arrived = F.struct(F.col("completed_at"), F.lit(False).alias("left"))
    gone = F.struct(F.col("former").alias("completed_at"), F.lit(True).alias("left"))
    leaves = F.col("former").isNotNull() & (F.to_date("former") != F.to_date("completed_at"))
    rows = moved.select("id", F.explode(F.when(leaves, F.array(arrived, gone)).otherwise(F.array(arrived))).alias("row"))
    rows = rows.select("id", "row.*", F.lit(version + 1).cast("bigint").alias("batch"), F.to_date("row.completed_at").alias("day"))
    return publish({_STATE: rows.repartition("day")}, path, _DAYS)


def compact(spark: SparkSession, path: str) -> int:
    """Rewrites the state as one batch with one row a line."""
    version, _ = current(spark, path)
    rows = _newest(read_state(spark, path)).select(
        "id", "completed_at", F.lit(False).alias("left"), F.lit(version + 1).cast("bigint").alias("batch"), F.to_date("completed_at").alias("day")
    )
    return publish({_STATE: rows.repartition("day")}, path, _DAYS, whole=True)
