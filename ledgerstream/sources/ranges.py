"""A stored ledger table as a stream whose offset is the ledger number.

    path/ledger_bucket=K/...   rows of the ledgers K * BUCKET up to the next bucket
    path/_latest               the last ledger that stands here whole

``write_ledgers`` lands whole ledgers and then moves ``_latest``. The stream (format ``ledger_ranges``) reads what lies behind its offset: a
restart goes on at a ledger, not at a list of files, and a table that was compacted or written anew meanwhile is the same to it.
A batch is planned as ranges of at most ``ledgers_per_task`` ledgers, each of one bucket, so a task opens one bucket's
files and skips their row groups by ledger. Paths may be in any store that pyarrow reads on driver and executors.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

BUCKET = 10_000


def write_ledgers(df: DataFrame, path: str, latest: int | None = None) -> None:
    """Append rows of whole ledgers (``ledger_seq``) in buckets, then tell the last ledger that stands here (else the rows' own)."""
    rows = df.withColumn("ledger_bucket", F.floor(F.col("ledger_seq") / BUCKET))
    rows.repartitionByRange("ledger_bucket", "ledger_seq").sortWithinPartitions("ledger_bucket", "ledger_seq").write.mode("append").partitionBy("ledger_bucket").parquet(path)
    latest = df.agg(F.max("ledger_seq")).first()[0] if latest is None else latest
    if latest is not None:
        fs, at = _store(path)
        with fs.open_output_stream(f"{at}/_latest") as out:
            out.write(json.dumps({"ledger": latest}).encode())


def _store(path: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(path if "://" in path else f"file://{path}")


def latest_ledger(path: str) -> int | None:
    fs, at = _store(path)
    try:
        with fs.open_input_stream(f"{at}/_latest") as f:
            return json.loads(f.read())["ledger"]
    except FileNotFoundError:
        return None


class LedgerRange(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


def planned(first: int, last: int, most: int) -> list[LedgerRange]:
    """``[first, last]`` in ranges of at most ``most`` ledgers, none over the edge of a bucket."""
    out = []
    while first <= last:
        end = min(last, first + most - 1, (first // BUCKET + 1) * BUCKET - 1)
        out.append(LedgerRange(first, end))
        first = end + 1
    return out


class Ranges:
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.path = schema, options["path"]
        self.start, self.end = int(options.get("start", 1)), int(options.get("end", 0))
        self.per_task, self.per_batch = int(options.get("ledgers_per_task", 1000)), int(options.get("ledgers_per_batch", 0))

    def rows(self, part: LedgerRange) -> Iterator:
        import pyarrow as pa
        import pyarrow.dataset as ds
        from pyspark.sql.pandas.types import to_arrow_schema

        if part.last < part.first:  # Spark wants a range even where there is none
            return
        fs, at = _store(self.path)
        try:
            files = ds.dataset(f"{at}/ledger_bucket={part.first // BUCKET}", filesystem=fs, format="parquet")
        except FileNotFoundError:  # no ledger of this bucket has rows
            return
        want = to_arrow_schema(self.schema)
        keep = (ds.field("ledger_seq") >= part.first) & (ds.field("ledger_seq") <= part.last)
        for b in files.to_batches(columns=want.names, filter=keep):
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column(f.name).cast(f.type) for f in want], schema=want)


class LedgerReader(Ranges, DataSourceReader):
    def partitions(self) -> list[LedgerRange]:
        newest = latest_ledger(self.path) or 0
        return planned(self.start, min(self.end, newest) if self.end else newest, self.per_task) or [LedgerRange(1, 0)]

    def read(self, partition: LedgerRange) -> Iterator:
        return self.rows(partition)


class LedgerStream(Ranges, DataSourceStreamReader):
    """The offset ``{"ledger": n}``: everything up to ledger n has been read."""

    def __init__(self, schema: StructType, options: dict):
        super().__init__(schema, options)
        self.at: int | None = None

    def initialOffset(self) -> dict:
        self.at = self.start - 1
        return {"ledger": self.at}

    def latestOffset(self) -> dict:
        newest = max(latest_ledger(self.path) or 0, self.start - 1)
        if self.per_batch and self.at is not None:
            newest = min(newest, self.at + self.per_batch)
        return {"ledger": max(newest, self.at or 0)}

    def partitions(self, start: dict, end: dict) -> list[LedgerRange]:
        self.at = end["ledger"]
        return planned(start["ledger"] + 1, end["ledger"], self.per_task) or [LedgerRange(1, 0)]

    def read(self, partition: LedgerRange) -> Iterator:
        return self.rows(partition)

    def commit(self, end: dict) -> None:
        self.at = max(self.at or 0, end["ledger"])


class LedgerRanges(DataSource):
    """Format ``ledger_ranges`` with a schema and the options ``path``, ``start`` (first ledger), ``end`` (last one, batch only),
    ``ledgers_per_task`` and ``ledgers_per_batch`` (0: all there are)."""

    @classmethod
    def name(cls) -> str:
        return "ledger_ranges"

    def reader(self, schema: StructType) -> LedgerReader:
        return LedgerReader(schema, self.options)

    def streamReader(self, schema: StructType) -> LedgerStream:
        return LedgerStream(schema, self.options)


def read_ranges(spark: SparkSession, path: str, schema: StructType, first: int, last: int, per_task: int = 1000) -> DataFrame:
    spark.dataSource.register(LedgerRanges)
    return spark.read.format("ledger_ranges").schema(schema).options(path=path, start=first, end=last, ledgers_per_task=per_task).load()


def stream_ranges(spark: SparkSession, path: str, schema: StructType, start: int = 1, per_task: int = 1000, per_batch: int = 0) -> DataFrame:
    spark.dataSource.register(LedgerRanges)
    return spark.readStream.format("ledger_ranges").schema(schema).options(path=path, start=start, ledgers_per_task=per_task, ledgers_per_batch=per_batch).load()
