"""Deliveries of several datasets that become visible together.

A run writes its datasets into folders of its own. Only when all are complete is a manifest written, one small file
that names for every dataset and partition the folder that counts; the file's rename makes the whole delivery
visible. A run that fails before leaves the former delivery as it was. A run takes the place of the partitions it
delivers (say state, client and day) and leaves all others alone. Readers read the folders of the newest manifest.

One program at a time delivers to a path.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ENTRY = "dataset string, partition string, run string, folder string"
#: Manifests that stay readable for readers that found them before a newer one.
_OLDER = 2


def _manifests(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(f"{_ENTRY}, version long").option("basePath", f"{path}/manifests").json(f"{path}/manifests/version=*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def current(spark: SparkSession, path: str) -> tuple[int, list]:
    """The newest version and its entries (dataset, partition, run, folder): a few short texts per partition."""
    listed = _manifests(spark, path.rstrip("/"))
    if listed is None:
        return 0, []
    version = listed.agg(F.max("version")).first()[0]
    return (version, listed.filter(F.col("version") == version).collect()) if version is not None else (0, [])


def publish(
    datasets: Mapping[str, DataFrame],
    path: str,
    partitions: Sequence[str] = (),
    delivers: Sequence[Mapping[str, object]] = (),
    whole: bool = False,
) -> int:
    """Delivers all datasets or none; returns the version under which they are visible.

    ``partitions`` are the columns by which a delivery is replaced in parts. Without any, or if it is ``whole``, a
    dataset is replaced altogether. ``delivers`` names partitions that this run answers for even where it has no row for them.
    """
    path, run = path.rstrip("/"), uuid4().hex
    spark = next(iter(datasets.values())).sparkSession
    before, entries = current(spark, path)
    fresh = []
    try:
        for name, frame in datasets.items():
            target = f"{path}/data/{name}/run={run}"
            frame.write.partitionBy(*partitions).parquet(target)
            fresh += _delivered(spark, name, target, run, partitions, frame.schema.json(), delivers)
        replaced = {(e["dataset"], e["partition"]) for e in fresh}
        if whole or not partitions:
            replaced |= {(e.dataset, e.partition) for e in entries if e.dataset in datasets}
        kept = [e.asDict() for e in entries if (e.dataset, e.partition) not in replaced]
        rows = [tuple(e[c] for c in ("dataset", "partition", "run", "folder")) for e in kept + fresh]
        spark.createDataFrame(rows, _ENTRY).coalesce(1).write.json(f"{path}/manifests/version={before + 1:012d}")
    except BaseException:
        for name in datasets:
            remove(spark, f"{path}/data/{name}/run={run}")
        raise
    _tidy(spark, path, before + 1)
    return before + 1


def _delivered(spark, name, target, run, partitions, schema, delivers) -> list[dict]:
    """An entry for each partition folder that was written, and for named partitions without rows."""
    if not partitions:
        return [{"dataset": name, "partition": "{}", "run": run, "folder": target}]
    shown = F.to_json(F.struct(*[F.col(p).cast("string").alias(p) for p in partitions]), {"ignoreNullFields": "false"})
    frame = spark.read.parquet(target) if _has_files(spark, target) else None
    # a file's path is given as a URI, in which a plus is a plus
    folder = F.url_decode(F.replace(F.regexp_replace("_metadata.file_path", "/[^/]*$", ""), F.lit("+"), F.lit("%2B")))
    found = [] if frame is None else frame.select(shown.alias("partition"), folder.alias("folder")).distinct().collect()
    out = [{"dataset": name, "partition": r.partition, "run": run, "folder": r.folder} for r in found]
    have = {e["partition"] for e in out}
    if delivers:
        named = spark.createDataFrame([tuple(None if d[p] is None else str(d[p]) for p in partitions) for d in delivers], ", ".join(f"`{p}` string" for p in partitions))
        out += [
            {"dataset": name, "partition": r[0], "run": run, "folder": None}
            for r in named.select(shown).distinct().collect() if r[0] not in have
        ]
    return out


def read_published(spark: SparkSession, path: str, name: str, schema: str | None = None) -> DataFrame:
    """A dataset as last delivered. ``schema`` serves for a dataset of which no row was ever delivered."""
    folders = sorted(e.folder for e in current(spark, path)[1] if e.dataset == name and e.folder)
    if not folders:
        if schema is None:
            raise ValueError(f"no rows of {name} in {path}")
        return spark.createDataFrame([], schema)
    base = f"{path.rstrip('/')}/data/{name}"
    reader = spark.read.option("basePath", base)
    return (reader.schema(f"{schema}, run string") if schema else reader).parquet(*folders).drop("run")


def _tidy(spark: SparkSession, path: str, version: int) -> None:
    """Removes manifests that nobody should read any more, and the runs that only they name."""
    listed = _manifests(spark, path)
    rows = listed.collect()
    old = version - _OLDER
    live = {(r.dataset, r.run) for r in rows if r.version >= old}
    for dataset, run in {(r.dataset, r.run) for r in rows if r.version < old} - live:
        remove(spark, f"{path}/data/{dataset}/run={run}")
    for gone in {r.version for r in rows if r.version < old}:
        remove(spark, f"{path}/manifests/version={gone:012d}")


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _has_files(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return any(not s.getPath().getName().startswith(("_", ".")) for s in files.listStatus(place))


def remove(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.delete(place, True)
