"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creamline.sources.published import remove
from creamline.sources.shared import shared_folder

#: Characters that separate words, as a Java and Python class body.
BLANKS = r"\x20\x09-\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Gives the executors this package through Spark's own file transfer, once for each context."""
    context = spark.sparkContext
    if getattr(context, "creamline_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="creamline-code-")) / "creamline_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    context.creamline_shipped = True


def _shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; one is set here only where a session without a cluster has none, as in tests."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    return context.getCheckpointDir()


def release(spark: SparkSession) -> None:
    """Removes all that this session has stored or written; for when its results have been read."""
    folder = spark.sparkContext.getCheckpointDir()
    if folder is not None:
        remove(spark, folder)


def as_row(docs: DataFrame) -> Column:
    """A whole input row as one column. Helper columns beside it cannot meet a name of the input's."""
    return F.struct(*[F.col(_quoted(c)) for c in docs.columns]).alias("row")


def row_columns(docs: DataFrame, **instead: Column) -> list[Column]:
    """The columns of the input, taken out of its row again; some by other values."""
    return [(instead[c] if c in instead else F.col("row." + _quoted(c))).alias(c) for c in docs.columns]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def stored(frame: DataFrame) -> DataFrame:
    """The frame in the session's checkpoint folder, its lineage cut; for narrow tables that are read again."""
    _shared_folder(frame.sparkSession)
    return frame.checkpoint(eager=True)


def written(frame: DataFrame) -> DataFrame:
    """The frame as Parquet below the session's checkpoint folder, read again; for whole documents, and in loops.

    Nothing of the plan is left, while a checkpoint keeps what Spark has inferred of equal columns, which
    doubles with every round of a loop.
    """
    path = f"{_shared_folder(frame.sparkSession)}/table-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def map_rows(
    frame: DataFrame, make: Callable[[], Callable[[dict], dict]], schema: str, rows_at_once: int = 256
) -> DataFrame:
    """One row out for each row in. make() runs once per task and gives the row function.

    Rows go out in small batches, so that memory follows the longest texts and not the batch size.
    """
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_of = make()
        for batch in batches:
            for start in range(0, batch.num_rows, rows_at_once):
                rows = batch.slice(start, rows_at_once).to_pylist()
                yield pa.RecordBatch.from_pylist([row_of(row) for row in rows], schema=arrow)

    return map_batches(frame, run, schema)


def arrow_schema(schema: str) -> pa.Schema:
    """The Arrow schema of a schema text; on the driver only."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def map_batches(frame: DataFrame, run, schema) -> DataFrame:
    """mapInArrow with this package at hand on the executors."""
    ship(frame.sparkSession)
    return frame.mapInArrow(run, schema)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, n: int, where=None, max_bytes: int = 200_000
) -> DataFrame:
    """(doc_id, text, label) of at most n labelled documents of at most max_bytes bytes, for training.

    The ids are the n with the smallest hash; only they reach the driver. Where an id has several labels
    the smallest counts. Null ids, null labels and labels without a document are passed over.
    """
    marked = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter("doc_id IS NOT NULL AND label IN (0, 1)")
    if where is not None:
        marked = marked.filter(where)
    chosen = (
        marked.groupBy("doc_id").agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(n).collect()
    )
    spark = docs.sparkSession
    if not chosen:
        return spark.createDataFrame([], "doc_id long, text string, label int")
    ids = {value: [row.doc_id for row in chosen if row.label == value] for value in (0, 1)}
    value = F.when(F.col("doc_id").isin(ids[1]), 1).when(F.col("doc_id").isin(ids[0]), 0) if ids[1] and ids[0] else (
        F.when(F.col("doc_id").isin(ids[1] or ids[0]), 1 if ids[1] else 0)
    )
    return (
        docs.select("doc_id", "text").filter(F.col("doc_id").isin([row.doc_id for row in chosen]))
        .filter(F.octet_length("text") <= max_bytes)
        .select("doc_id", "text", value.alias("label"))
    )
