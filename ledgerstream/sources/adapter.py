"""The driver's ``events`` table as ledgers, raw events, entry changes, entries, commands and logs (FIXTURES.md)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..streaming.tables import stored

BUCKET_S, FIRST = 300, 5680224


class Tables:
    """Every table is derived lazily from ``events``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._kept = spark, sf_dir, {}

    def kept(self, name: str, make) -> DataFrame:
        """``make()``, stored the first time it is asked for."""
        if name not in self._kept:
            self._kept[name] = stored(make(), name)
        return self._kept[name]

    @cached_property
    def ev(self) -> DataFrame:
        e = self.spark.read.parquet(f"{self.sf_dir}/events.parquet")
        # The table's times are UTC without a zone, and stay so in any session time zone.
        micros = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")
        bucket = F.expr(f"timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', ts) div {BUCKET_S}")
        return e.select("event_id", F.timestamp_micros(micros).alias("ts"), F.col("user_id").cast("string").alias("uid"), "user_id", "event_type", "value", (bucket - FIRST + 1).alias("ledger_seq"), F.timestamp_seconds((bucket + 1) * BUCKET_S).alias("closed_at"), F.get_json_object("props", "$.k").cast("bigint").alias("k"))

    @cached_property
    def raw_events(self) -> DataFrame:
        topic = lambda t, v: F.struct(t.alias("type"), v.alias("value"))
        symbol = lambda v: topic(F.lit("symbol"), v)
        sender = F.when(F.col("value") >= 5, topic(F.lit("address"), F.col("uid"))).otherwise(symbol(F.lit("junk")))
        topics = F.when(F.col("event_type") == "purchase", F.array(symbol(F.lit("transfer")), sender, topic(F.lit("address"), F.col("k").cast("string")))).otherwise(F.array(symbol(F.col("event_type"))))
        rank = F.dense_rank().over(Window.partitionBy("ledger_seq").orderBy("user_id")).cast("long")
        return self.ev.select("ledger_seq", "closed_at", F.md5(F.concat_ws(":", "ledger_seq", "user_id").cast("binary")).alias("tx_hash"), rank.alias("tx_index"), F.lit(0).cast("long").alias("op_index"), F.col("event_id").alias("op_event_pos"), F.col("uid").alias("emitter"), topics.alias("topics"), F.base64(F.col("event_id").cast("string").cast("binary")).alias("raw_xdr"))

    @cached_property
    def instance_changes(self) -> DataFrame:
        h = F.md5((F.col("k") % 4).cast("string").cast("binary"))
        return self.ev.where("event_type = 'signup'").select("ledger_seq", F.col("uid").alias("contract_id"), F.lit("contract_data").alias("entry_type"), F.lit("instance").alias("key_type"), F.lit(True).alias("post_present"), F.lit("wasm").alias("executable_type"), F.concat(h, h).alias("wasm_hash"), F.col("event_id").alias("log_seq"))

    @cached_property
    def approved(self) -> DataFrame:
        return self.spark.range(1).select(F.expr("concat(md5(cast('0' as binary)), md5(cast('0' as binary)))").alias("wasm_hash"))

    @cached_property
    def commands(self) -> DataFrame:
        kind = F.when(F.col("k") < 2, "remove_escrow").when(F.col("k") == 2, "track_escrow").when(F.col("k") == 3, "pause").otherwise("resume")
        return self.ev.where("event_type = 'error' and k <= 4").select(F.col("event_id").alias("cmd_seq"), "ts", F.col("ledger_seq").alias("after_ledger"), kind.alias("command"), F.when(F.col("k") <= 2, F.col("uid")).alias("contract_id"), F.lit(None).cast("array<string>").alias("contract_ids"), F.when(F.col("k") == 3, F.col("value").cast("long")).alias("ttl_seconds"))

    @cached_property
    def entries(self) -> DataFrame:
        rows = self.ev.where("event_type in ('view', 'click') and user_id % 17 <> 0")
        last = rows.groupBy("uid", "event_type").agg(F.max_by(F.struct("event_id", "ledger_seq"), "event_id").alias("e"))
        data = F.col("event_type") == "click"
        return last.select(F.col("uid").alias("contract_id"), F.col("e.event_id").alias("pos"), F.when(data, "vec/persistent").otherwise("instance/persistent").alias("key_kind"), data.alias("is_data"), F.col("e.ledger_seq").alias("last_modified_ledger"), F.base64(F.col("e.event_id").cast("string").cast("binary")).alias("raw_xdr"))

    @cached_property
    def ledgers(self) -> DataFrame:
        rows = self.ev.groupBy("ledger_seq").agg(F.max("closed_at").alias("closed_at"))
        h = lambda c: F.md5(c.cast("string").cast("binary"))
        before = F.lag("ledger_seq").over(Window.orderBy("ledger_seq"))  # one row a ledger
        return rows.select("ledger_seq", "closed_at", F.lit("testnet").alias("network"), h(F.col("ledger_seq")).alias("ledger_hash"), F.when(F.col("ledger_seq") % 97 == 0, h(F.lit("fork"))).otherwise(h(before)).alias("prev_hash"))

    @cached_property
    def progress(self) -> DataFrame:
        return self.ledgers.select("ledger_seq", "closed_at", F.expr("closed_at + make_interval(0, 0, 0, 0, 0, cast((ledger_seq div 50) % 40 as int))").alias("processed_at"))

    @cached_property
    def sources(self) -> DataFrame:
        part = lambda p, where, net: self.ledgers.where(where).drop("network").withColumn("network", F.lit(net)).withColumn("priority", F.lit(p).cast("long"))
        return part(0, "ledger_seq >= 4000", "testnet").unionByName(part(1, "ledger_seq % 2 = 0", "testnet")).unionByName(part(2, "true", "othernet"))

    @cached_property
    def fetch_log(self) -> DataFrame:
        k, n = F.col("k"), F.col("ledger_seq")
        window = lambda a, b: F.concat(F.lit("start ledger must be between the oldest ledger: "), a.cast("string"), F.lit(" and the latest ledger: "), b.cast("string"))
        text = F.when(k < 30, window(F.lit(2), n - 1)).when(k < 60, window(n + 10, n + 500)).otherwise("connection reset")
        bad = F.col("event_type") == "error"
        return self.ev.select("event_id", "ts", n.alias("requested"), (~bad).alias("ok"), (F.col("value") / 100).alias("duration_s"), F.when(bad, text).alias("error"))

    @cached_property
    def bindings(self) -> DataFrame:
        rows = [("all", "stellar.*.escrow.#"), ("history", "stellar.*.escrow.event.#"), ("deposits", "stellar.*.escrow.deposit.#"), ("one", "stellar.testnet.escrow.event.view")]
        return self.spark.createDataFrame(rows, "queue string, pattern string")
