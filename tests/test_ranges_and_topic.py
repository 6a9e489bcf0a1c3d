"""Ledgers as a stream with ledger offsets, and topics with a commit protocol."""

import os
import time

import pytest
from pyspark.sql import functions as F

from ledgerstream.sources import ranges, readers
from ledgerstream.streaming import topic


def ledgers(spark, first, last, per=2):
    return spark.range(first, last + 1).selectExpr("id as ledger_seq", f"explode(sequence(1, {per})) as n").withColumn("at", F.timestamp_seconds("ledger_seq"))


def run(stream, tmp_path, out="out"):
    q = stream.writeStream.format("parquet").option("path", str(tmp_path / out)).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def seen(spark, tmp_path):
    return sorted((r.ledger_seq, r.n, r.at.timestamp()) for r in spark.read.parquet(str(tmp_path / "out")).collect())


def test_a_restart_goes_on_at_a_ledger(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "in")
    df = ledgers(spark, 9_995, 10_020)
    ranges.write_ledgers(df.where("ledger_seq <= 10005"), path)
    stream = lambda **o: ranges.stream_ranges(spark, path, df.schema, 9_998, per_task=4, **o)
    run(stream(), tmp_path)
    assert [r[0] for r in seen(spark, tmp_path)] == [n for n in range(9_998, 10_006) for _ in range(2)]
    # All files are written anew in the meantime; a ledger that isn't told of yet waits.
    whole = ledgers(spark, 9_995, 10_020)
    import shutil

    shutil.rmtree(path)
    ranges.write_ledgers(whole.where("ledger_seq <= 10004"), path)
    ranges.write_ledgers(whole.where("ledger_seq between 10005 and 10020"), path, latest=10_015)
    run(stream(), tmp_path)
    run(stream(), tmp_path)
    want = sorted((n, k, float(n)) for n in range(9_998, 10_016) for k in (1, 2))
    assert seen(spark, tmp_path) == want
    ranges.write_ledgers(ledgers(spark, 10_021, 10_040), path)
    run(stream(), tmp_path)
    assert [r[0] for r in seen(spark, tmp_path)] == [n for n in range(9_998, 10_041) for _ in range(2)]


def test_planned_ranges():
    parts = [(p.first, p.last) for p in ranges.planned(9_990, 20_003, 4_000)]
    assert parts == [(9_990, 9_999), (10_000, 13_999), (14_000, 17_999), (18_000, 19_999), (20_000, 20_003)] and ranges.planned(5, 4, 10) == []
    stream = ranges.LedgerStream.__new__(ranges.LedgerStream)
    stream.path, stream.start, stream.per_batch, stream.per_task, stream.at = "/nowhere", 7, 5, 2, None
    assert stream.latestOffset() == {"ledger": 6} and stream.initialOffset() == {"ledger": 6}


def test_ranges_of_a_batch_and_pruned_scans(spark, tmp_path):
    path = str(tmp_path / "in")
    df = ledgers(spark, 9_900, 30_100, 1)
    ranges.write_ledgers(df, path)
    got = ranges.read_ranges(spark, path, df.schema, 9_990, 20_010)
    assert sorted(r.ledger_seq for r in got.select("ledger_seq").collect()) == list(range(9_990, 20_011))
    assert ranges.read_ranges(spark, path, df.schema, 40_000, 50_000).count() == 0
    # The plain scan skips buckets too.
    scan = readers.scan_range(spark.read.parquet(path), 10_000, 10_500)
    assert scan.count() == 501
    files = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in files and "ledger_bucket" in files.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_topic_readers_see_whole_batches_once(spark, tmp_path):
    path, flag = str(tmp_path / "topic"), str(tmp_path / "fail")
    os.makedirs(tmp_path / "in")
    rows = spark.range(60).selectExpr("concat('k', id % 3) as topic_key", "cast(id as string) as message_id", "repeat('v', 9) as value")
    for i in range(3):
        rows.where(F.col("message_id").cast("int") % 3 == i).coalesce(2).write.mode("append").parquet(str(tmp_path / "in"))
    open(flag, "w").close()

    from ledgerstream.streaming.topic import Topic, TopicWriter

    class Breaks(TopicWriter):
        def commit(self, messages, batchId):
            if batchId == 1 and os.path.exists(flag):
                os.remove(flag)
                raise RuntimeError("between write and commit")
            super().commit(messages, batchId)

        def abort(self, messages, batchId):
            pass  # the driver is gone: nothing is cleaned up

    class Breaking(Topic):
        def streamWriter(self, schema, overwrite):
            return Breaks(schema, self.options["path"])

    stream = lambda: spark.readStream.schema(topic.MESSAGES).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    with pytest.raises(Exception, match="between write and commit"):
        topic.write_topic(stream(), path, str(tmp_path / "cp"), Breaking).awaitTermination()
    whole = topic.read_topic(spark, path)
    n = whole.count()
    assert 0 < n < 60 and len(topic.committed(path)) == 1
    topic.write_topic(stream(), path, str(tmp_path / "cp"), Breaking).awaitTermination()
    got = [r.message_id for r in topic.read_topic(spark, path).collect()]
    assert len(got) == 60 and len(set(got)) == 60
    assert sorted(r.message_id for r in topic.read_topic(spark, path, after=0).collect()) == sorted(set(got) - {r.message_id for r in whole.collect()})
    # The first attempt's files belong to no batch.
    known = sum(len(f) for f in topic.committed(path).values())
    assert len(os.listdir(tmp_path / "topic" / "data")) > known
    assert topic.sweep(path, 0) == 0 and topic.sweep(path, time.time() + 9) > 0 and topic.read_topic(spark, path).count() == 60


def test_a_batch_that_stands_is_not_written_again(tmp_path):
    w = topic.TopicWriter(__import__("pyspark.sql.types", fromlist=["StructType"]).StructType.fromDDL(topic.MESSAGES), str(tmp_path))
    first = w.write(iter([("k", "1", "v"), ("k", "2", "v")]))
    w.commit([first, None], 4)
    again = w.write(iter([("k", "1", "v"), ("k", "2", "v")]))
    w.commit([again], 4)
    assert topic.committed(str(tmp_path)) == {4: first.files} and sorted(os.listdir(tmp_path / "data")) == sorted(first.files)
    given_up = w.write(iter([("k", "3", "v")]))
    w.abort([given_up, None], 5)
    assert topic.committed(str(tmp_path)) == {4: first.files} and sorted(os.listdir(tmp_path / "data")) == sorted(first.files)
