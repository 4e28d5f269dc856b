"""Where tables and files of a run go that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_own: dict[str, str] = {}
_scopes: list[list[str]] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir), deleted when the driver ends.

    Where the setting is absent and all work is in this process, as in tests, a temporary folder is used and set as
    the session's checkpoint folder. Elsewhere its absence is an error, since other machines could not read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = "file://" + tempfile.mkdtemp(prefix="alloyframe-")
            spark.sparkContext.setCheckpointDir(_own[app])
        base = _own[app]
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(there)
    if _scopes:
        _scopes[-1].append(path)
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Folders whose paths are made within are deleted at its end; what is read later needs a path from outside."""
    made: list[str] = []
    _scopes.append(made)
    try:
        yield
    finally:
        _scopes.remove(made)
        for path in made:
            drop_path(spark, path)
