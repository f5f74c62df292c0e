"""Writing report datasets."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def write_report(
    datasets: DataFrame | Mapping[str, DataFrame],
    path: str,
    file_format: str = "parquet",
    mode: str = "overwrite",
) -> list[str]:
    """One folder per named dataset; a single frame is written as ``report``."""
    named = {"report": datasets} if isinstance(datasets, DataFrame) else datasets
    written = []
    for name, frame in named.items():
        target = f"{path.rstrip('/')}/{name}"
        writer = frame.write.mode(mode).format(file_format)
        if file_format == "csv":
            writer = writer.option("header", True).option("emptyValue", "")
        writer.save(target)
        written.append(target)
    return written


BUCKET_KEYS = {"reportable_result": "commercial_order_line_id", "commercial_order_line": "id"}


def save_bucketed(
    tables: Mapping[str, DataFrame], path: str, buckets: int, prefix: str = "lab_"
) -> dict[str, str]:
    """Stores results and order lines as catalog tables bucketed by order line.

    Completion, the pivot per line and the join of both then need no shuffle of the results. Choose
    ``buckets`` so that one bucket of results fits a task. Rows are first dealt to their buckets, so
    that every bucket is one file.
    """
    names = {}
    for name, key in BUCKET_KEYS.items():
        names[name] = f"{prefix}{name}"
        (
            tables[name].repartition(buckets, key)
            .write.mode("overwrite")
            .option("path", f"{path.rstrip('/')}/{name}")
            .bucketBy(buckets, key)
            .sortBy(key)
            .saveAsTable(names[name])
        )
    return names

