"""Times the headline reports and prints one JSON line."""

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from creamline.catalog import QUERIES  # noqa: E402

HEADLINE = (
    "official_report_complete",
    "official_report_raw",
    "immediate_response_bacteria",
    "red_tag_all",
    "components_report",
    "inspector_report",
    "dairy_sheet",
    "goat_record",
    "minnesota_record",
    "wisconsin_record",
    "tennessee_record",
    "legacy_official_state",
)


#: Run once before the clock starts, so that the first report does not pay for compiling and class loading.
WARM_UP = ("tennessee_record", "official_report_raw")


def moved(spark: SparkSession) -> int:
    """Bytes written to shuffles so far, by the engine's own counter."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    executors = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    each = [executors.apply(k) for k in range(executors.size())]
    return sum(e.totalShuffleWrite() for e in each)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("creamline-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in WARM_UP:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds, shuffled = {}, {}
    for name in HEADLINE:
        before = moved(spark)
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        shuffled[name] = round((moved(spark) - before) / 1e6, 2)
    spark.stop()
    print(json.dumps({
        "metric": "headline_reports_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "shuffle_mb": shuffled,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
