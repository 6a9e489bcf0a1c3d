"""Scratch tables in folders that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_scratch: dict[str, list[str]] = {}
#: What ``stored`` makes inside of a ``scratch`` block; each thread has its own.
_inside: ContextVar[list[str] | None] = ContextVar("inside", default=None)


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder only where that is unset in local mode."""
    if root := spark.conf.get("spark.checkpoint.dir", None):
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="spark-ledgerstream-")
        atexit.register(shutil.rmtree, _own[app], True)
    return "file://" + _own[app]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and survives lost executors."""
    path = f"{shared_root(df.sparkSession)}/ledgerstream-{uuid.uuid4().hex[:12]}/{name}"
    df.write.parquet(path)
    if (made := _inside.get()) is None:
        made = _scratch.setdefault(df.sparkSession.sparkContext.applicationId, [])
    made.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """A block whose ``stored`` tables are deleted at its end, with nothing of other callers: nothing may read them afterwards."""
    made: list[str] = []
    token = _inside.set(made)
    try:
        yield
    finally:
        _inside.reset(token)
        for path in made:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def scratch_made(spark: SparkSession) -> int:
    """How many scratch tables ``stored`` has made so far, for ``discard_scratch``."""
    return len(_scratch.get(spark.sparkContext.applicationId, []))


def discard_scratch(spark: SparkSession, since: int, until: int | None = None) -> None:
    """Delete the scratch tables made between two counts, once nothing reads them any more."""
    made = _scratch.get(spark.sparkContext.applicationId, [])
    for i, path in enumerate(made[since:until], since):
        if path:
            _delete(spark, path)
            made[i] = ""
