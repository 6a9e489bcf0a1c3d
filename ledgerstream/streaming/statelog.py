"""The live job's state: append-only deltas, a snapshot every so many of them, a head that names what the newest state consists of.

    path/delta/TABLE/v=N       rows that batch N added to a table
    path/snapshot/TABLE/v=N    all rows of a table after batch N, ranges of its key in files of their own
    path/head/0, path/head/1   the state after an even and an odd batch, as one line of JSON with its checksum
    path/plan/0, path/plan/1   what a batch was begun with, likewise

A batch reads the head of the batch before, whose files never change, so a retry of the newest batch reads what its first attempt read. Its
own head goes to the other slot: one small file a batch, and if that is cut short the slot doesn't count and the one before
still does. What a batch costs depends on the tables' sizes, never on how many batches came before: two heads are read, and a table's state is
one snapshot and fewer than ``every`` deltas. Folders that no head names any more are deleted one batch later, when no retry
can need them.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


class Files:
    """Small files by Spark's own file systems; ``calls`` counts what is asked of them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.calls = spark, 0

    def _at(self, path: str):
        self.calls += 1
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def read(self, path: str) -> str | None:
        fs, p = self._at(path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        fs, p = self._at(path)
        stream = fs.create(p, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)


@dataclass(frozen=True)
class Table:
    """A table's schema, the key its snapshots are sorted by, and what a snapshot keeps of all rows, given the head's values."""

    schema: str
    key: str
    compact: Callable[[DataFrame, dict], DataFrame] = lambda rows, values: rows


@dataclass
class Head:
    """The state after ``version``: of each table its snapshot and deltas, small values, and folders to delete."""

    version: int = -1
    tables: dict = field(default_factory=dict)  # name -> {"snapshot": version or None, "deltas": [versions]}
    values: dict = field(default_factory=dict)
    retired: list = field(default_factory=list)


def sealed(data: dict) -> str:
    body = json.dumps(data, sort_keys=True)
    return f"{zlib.crc32(body.encode()):08x} {body}\n"


def opened(text: str | None) -> dict | None:
    """What ``sealed`` wrote, or None where that is missing or was cut short."""
    mark, _, body = (text or "").rstrip("\n").partition(" ")
    return json.loads(body) if body and f"{zlib.crc32(body.encode()):08x}" == mark else None


class StateLog:
    def __init__(self, spark: SparkSession, path: str, tables: dict[str, Table], every: int = 32, options: dict | None = None):
        self.spark, self.path, self.tables, self.every, self.files = spark, path, tables, every, Files(spark)
        self.options = options or {}  # of the files' writer

    def _slots(self, kind: str) -> list[dict]:
        return [x for i in (0, 1) if (x := opened(self.files.read(f"{self.path}/{kind}/{i}"))) is not None]

    def before(self, batch_id: int) -> Head:
        """The state that ``batch_id`` starts from: the newest of an earlier batch."""
        older = [x for x in self._slots("head") if x["version"] < batch_id]
        return Head(**max(older, key=lambda x: x["version"])) if older else Head()

    def newest(self) -> Head:
        return self.before(1 << 62)

    def plan(self, batch_id: int, make: Callable[[], dict]) -> dict:
        """What a batch begins with: made once, then the same for each retry."""
        found = next((x for x in self._slots("plan") if x["version"] == batch_id), None)
        if found is None:
            found = {"version": batch_id, **make()}
            self.files.write(f"{self.path}/plan/{batch_id % 2}", sealed(found))
        return found

    def read(self, head: Head, name: str) -> DataFrame:
        at = head.tables.get(name, {"snapshot": None, "deltas": []})
        paths = [f"{self.path}/snapshot/{name}/v={at['snapshot']}"] if at["snapshot"] is not None else []
        paths += [f"{self.path}/delta/{name}/v={v}" for v in at["deltas"]]
        schema = self.tables[name].schema
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def commit(self, batch_id: int, head: Head, added: dict[str, DataFrame], values: dict, reset: frozenset[str] = frozenset()) -> Head:
        """State after ``batch_id``: ``head``'s, the ``added`` rows (instead of the former ones for tables in ``reset``; a table without new
        rows isn't in it, and nothing is written for it) and ``values``."""
        new = Head(batch_id, {}, {**head.values, **values})
        for name, table in self.tables.items():
            at = head.tables.get(name, {"snapshot": None, "deltas": []})
            old = [f"snapshot/{name}/v={at['snapshot']}"] if at["snapshot"] is not None else []
            old += [f"delta/{name}/v={v}" for v in at["deltas"]]
            if name in reset:
                at, new.retired = {"snapshot": None, "deltas": []}, new.retired + old
                old = []
            if name in added:
                self._write(added[name], f"delta/{name}/v={batch_id}")
                at = {**at, "deltas": [*at["deltas"], batch_id]}
                old.append(f"delta/{name}/v={batch_id}")
            new.tables[name] = at
            if len(at["deltas"]) >= self.every:
                rows = table.compact(self.read(new, name), new.values)
                self._write(rows.repartitionByRange(table.key).sortWithinPartitions(table.key), f"snapshot/{name}/v={batch_id}")
                new.tables[name], new.retired = {"snapshot": batch_id, "deltas": []}, new.retired + old
        self.files.write(f"{self.path}/head/{batch_id % 2}", sealed(new.__dict__))
        for folder in head.retired:  # of the batch before: no retry reads them any more
            self.files.delete(f"{self.path}/{folder}")
        return new

    def _write(self, rows: DataFrame, folder: str) -> None:
        rows.write.mode("overwrite").options(**self.options).parquet(f"{self.path}/{folder}")
