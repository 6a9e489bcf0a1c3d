"""Sends this package to the executors where they can't import it."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Add the package as a zip to the session's Python files, once, unless PYTHONPATH already has it."""
    root = Path(__file__).resolve().parent.parent
    app = spark.sparkContext.applicationId
    if app in _sent or str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    folder = tempfile.mkdtemp(prefix="spark-ledgerstream-")
    path = os.path.join(folder, "ledgerstream.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted((root / "ledgerstream").rglob("*.py")):
            z.write(f, f.relative_to(root))
    spark.sparkContext.addPyFile(path)
    _sent[app] = path


def shipped(f):
    """``f(spark, ...)`` after ``ship(spark)``."""

    @functools.wraps(f)
    def run(spark, *args):
        ship(spark)
        return f(spark, *args)

    return run
