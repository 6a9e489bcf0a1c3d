"""A topic as files with a commit protocol: readers see whole batches, each once.

    path/data/UUID.parquet       what a task wrote
    path/commits/N.json          the files of batch N: written once, when all its tasks have ended

Tasks write files that nobody knows of yet and report them; the driver then writes the batch's list, or deletes the files where the batch is given
up. A batch that is run again after its list was written leaves the list and drops its new files, so no message comes twice, however
often a batch is retried. Files that neither happened to, as their task was lost, are deleted by ``sweep``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from ..sources.ranges import _store

MESSAGES = "topic_key string, message_id string, value string"
ROWS_PER_FILE = 100_000


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class TopicWriter(DataSourceStreamWriter):
    def __init__(self, schema: StructType, path: str):
        self.schema, self.path = schema, path

    def write(self, iterator: Iterator) -> Written:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        fs, at = _store(self.path)
        fs.create_dir(f"{at}/data", recursive=True)
        want, files, rows = to_arrow_schema(self.schema), [], []

        def flush() -> None:
            if rows:
                name = f"{uuid.uuid4().hex}.parquet"
                with fs.open_output_stream(f"{at}/data/{name}") as out:
                    pq.write_table(pa.Table.from_pylist(rows, schema=want), out)
                files.append(name)
                rows.clear()

        for r in iterator:
            rows.append(dict(zip(want.names, r, strict=True)))
            if len(rows) >= ROWS_PER_FILE:
                flush()
        flush()
        return Written(files)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        fs, at = _store(self.path)
        fs.create_dir(f"{at}/commits", recursive=True)
        files = [f for m in messages if m for f in m.files]
        if batchId in committed(self.path):
            self._drop(files)
            return
        # Under another name first: a list that is cut short is none.
        with fs.open_output_stream(f"{at}/commits/{batchId}.part") as out:
            out.write(json.dumps(files).encode())
        fs.move(f"{at}/commits/{batchId}.part", f"{at}/commits/{batchId}.json")

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        self._drop([f for m in messages if m for f in m.files])

    def _drop(self, files: list[str]) -> None:
        fs, at = _store(self.path)
        for f in files:
            fs.delete_file(f"{at}/data/{f}")


class Topic(DataSource):
    """Format ``ledger_topic`` for streams of ``topic_key, message_id, value``, option ``path``."""

    @classmethod
    def name(cls) -> str:
        return "ledger_topic"

    def streamWriter(self, schema: StructType, overwrite: bool) -> TopicWriter:
        return TopicWriter(schema, self.options["path"])


def committed(path: str) -> dict[int, list[str]]:
    """The files of each batch that stands."""
    from pyarrow.fs import FileSelector

    fs, at = _store(path)
    out = {}
    for info in fs.get_file_info(FileSelector(f"{at}/commits", allow_not_found=True)):
        if info.base_name.endswith(".json"):
            with fs.open_input_stream(info.path) as f:
                out[int(info.base_name[:-5])] = json.loads(f.read())
    return out


def write_topic(messages: DataFrame, path: str, checkpoint: str, source: type[DataSource] = Topic):
    """Start a stream of messages into a topic, up to what there is now."""
    messages.sparkSession.dataSource.register(source)
    return messages.writeStream.format(source.name()).option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def read_topic(spark: SparkSession, path: str, after: int = -1) -> DataFrame:
    """Messages of whole batches, those behind batch ``after``."""
    files = [f"{path}/data/{f}" for n, names in committed(path).items() if n > after for f in names]
    return spark.read.schema(MESSAGES).parquet(*files) if files else spark.createDataFrame([], MESSAGES)


def sweep(path: str, before_s: float) -> int:
    """Delete files that belong to no batch and were last touched before a time (Unix seconds) at which no batch was running."""
    from pyarrow.fs import FileSelector

    fs, at = _store(path)
    known = {f for names in committed(path).values() for f in names}
    lost = [i.path for i in fs.get_file_info(FileSelector(f"{at}/data", allow_not_found=True)) if i.base_name not in known and i.mtime.timestamp() < before_s]
    for p in lost:
        fs.delete_file(p)
    return len(lost)
