"""Intermediates that several readers of a report use: computed once, when first read, and given up again.

A shared table is a persisted frame. Nothing runs when it is declared, the first reader fills it, later readers of
the same plan find it, a lost part is computed again from its lineage, and no file is left behind. What this module
adds is a lifetime: a table lives until its scope ends, or until newer ones take its place.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections import OrderedDict
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


class SharedTables:
    """At most ``most`` shared tables, by name and plan; the oldest is given up for a new one."""

    def __init__(self, most: int = 8):
        self.most, self._kept = most, OrderedDict()

    def share(self, frame: DataFrame, name: str) -> DataFrame:
        """The frame, to be computed once by its readers.

        Declaring the same plan again gives up what was computed before, so that a new report reads what its
        tables hold now; a report declares each of its intermediates once.
        """
        key = (frame.sparkSession.sparkContext.applicationId, name, frame.semanticHash())
        self._give_up(key)
        self._kept[key] = frame.persist(StorageLevel.MEMORY_AND_DISK)
        while len(self._kept) > self.most:
            self._give_up(next(iter(self._kept)))
        return frame

    def names(self) -> list[str]:
        return [name for _, name, _ in self._kept]

    def release(self) -> None:
        for key in list(self._kept):
            self._give_up(key)

    def _give_up(self, key: tuple) -> None:
        frame = self._kept.pop(key, None)
        if frame is not None and key[0] == _running(frame):
            frame.unpersist()


def _running(frame: DataFrame) -> str | None:
    """The application that the frame's session belongs to, if it still runs."""
    context = frame.sparkSession.sparkContext
    return context.applicationId if context._jsc is not None else None


#: What the reports use. A report is lazy, so its tables outlive the call that builds it.
REPORTS = SharedTables()


@contextmanager
def shared_tables(tables: SharedTables = REPORTS) -> Iterator[SharedTables]:
    """Gives up, at the end, whatever was shared; for a program that builds and delivers reports in one place."""
    try:
        yield tables
    finally:
        tables.release()


def shared_folder(spark: SparkSession) -> str:
    """A folder that the driver and all executors see: the session's ``spark.checkpoint.dir``.

    Only a session without a cluster may go without that setting; it gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _local_folder(spark.sparkContext.applicationId)
    return folder.rstrip("/")


@cache
def _local_folder(application: str) -> str:
    folder = tempfile.mkdtemp(prefix=f"creamline-{application}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder
