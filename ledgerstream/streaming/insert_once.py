"""Insert-once by message id without a bound: what is seen is kept in buckets of ids, and a batch looks into those it touches.

    path/delta/bucket-B/v=N      ids that batch N brought to a bucket, with a Bloom filter of them in each file's footer
    path/snapshot/bucket-B/v=N   all of a bucket's ids after batch N (see ``statelog``)

State by watermark forgets, so a repeat that comes late enough passes it. Here an id's bucket is its hash; a batch reads the buckets of its own ids
and of these only what may hold one of them: up to ``PUSHED`` ids of a bucket go down to the files as a list, which their Bloom filters and
statistics answer, so a few late repeats cost a few footers. What a batch found new is written under its number, and a retry
overwrites that and doesn't read it. A bucket of ``every`` batches' files is written as one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .statelog import StateLog, Table

#: Ids of one batch that are pushed to the files as a list (the driver holds them); more are joined.
PUSHED = 2_000
BLOOM = {"parquet.bloom.filter.enabled#message_id": "true", "parquet.bloom.filter.expected.ndv#message_id": "1000000"}


class InsertOnce:
    """``new_of`` gives the rows of a batch whose ``message_id`` no earlier batch had, each id once; ``keep`` then remembers them.

    Rows are of any columns besides. Of rows that share an id in a batch the one with the least (``published_at``, content) stays, as in
    ``history_view``. Null ids are messages that can't be told apart, and all stay. Batches are numbered as a stream's are.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, every: int = 16):
        self.spark, self.buckets = spark, buckets
        tables = {self.name(b): Table("message_id string", "message_id", lambda rows, values: rows.distinct()) for b in range(buckets)}
        self.log = StateLog(spark, path, tables, every, BLOOM)

    @staticmethod
    def name(bucket: int) -> str:
        return f"bucket-{bucket}"

    def bucket(self):
        return F.pmod(F.xxhash64("message_id"), F.lit(self.buckets))

    def touched(self, df: DataFrame) -> list[int]:
        return sorted(r[0] for r in df.where("message_id is not null").select(self.bucket().alias("b")).distinct().collect())

    def seen(self, df: DataFrame, head) -> DataFrame:
        """Ids of earlier batches, from the buckets of ``df``'s ids; of a small ``df`` only those that it asks for."""
        wanted = [r[0] for r in df.where("message_id is not null").select("message_id").distinct().limit(PUSHED + 1).collect()]
        found = self.spark.createDataFrame([], "message_id string")
        for b in self.touched(df):
            rows = self.log.read(head, self.name(b))
            found = found.unionByName(rows.where(F.col("message_id").isin(wanted)) if len(wanted) <= PUSHED else rows)
        return found

    def new_of(self, df: DataFrame, batch_id: int) -> DataFrame:
        head = self.log.before(batch_id)
        once = self.once(df)
        return once.join(self.seen(df, head), "message_id", "left_anti").select(*df.columns)

    @staticmethod
    def once(df: DataFrame) -> DataFrame:
        from ..operators.envelope import history_view

        named = history_view(df.where("message_id is not null")).select(*df.columns)
        return named.unionByName(df.where("message_id is null"))

    def keep(self, new: DataFrame, batch_id: int) -> None:
        """Remember ``new_of``'s rows; what is written is read from ``new``, so it should be a stored table by then."""
        ids = new.where("message_id is not null").select("message_id", self.bucket().alias("b")).persist()
        try:
            added = {self.name(b): ids.where(F.col("b") == b).select("message_id") for b in self.touched(new)}
            self.log.commit(batch_id, self.log.before(batch_id), added, {})
        finally:
            ids.unpersist()


def insert_once(messages: DataFrame, out: str, checkpoint: str, buckets: int = 64, then: Callable[[DataFrame, int], None] = lambda df, n: None):
    """Start a stream that lands each message once under ``out``, in a folder a batch, however late a repeat comes."""
    spark = messages.sparkSession
    once = InsertOnce(spark, f"{out}/seen", buckets)

    def land(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            once.new_of(df, batch_id).write.mode("overwrite").parquet(f"{out}/messages/batch_id={batch_id}")
        finally:
            df.unpersist()
        landed = spark.read.schema(df.schema).parquet(f"{out}/messages/batch_id={batch_id}")
        then(landed, batch_id)
        once.keep(landed, batch_id)

    return messages.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
