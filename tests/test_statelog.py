"""The live job's state log: retries, cut-short heads, expiry, and a cost a batch that doesn't grow."""

import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerstream.operators import state, watchlist
from ledgerstream.streaming.statelog import StateLog, Table, opened, sealed

TABLES = {"a": Table("x long", "x", lambda rows, values: rows.distinct()), "b": Table("y string", "y")}


def rows_of(log, head, name):
    return sorted(r[0] for r in log.read(head, name).collect())


def test_a_retry_reads_what_the_first_attempt_read(spark, tmp_path):
    log = StateLog(spark, str(tmp_path), TABLES, every=3)
    want = []
    for n in range(8):
        for attempt in range(2):  # the second one after the head was written, the stream's checkpoint not
            head = log.before(n)
            assert rows_of(log, head, "a") == want and head.values.get("n", 0) == len(want)
            log.commit(n, head, {"a": spark.createDataFrame([(n,)], "x long")}, {"n": len(want) + 1})
        want.append(n)
    assert rows_of(log, log.newest(), "a") == want


def test_a_head_cut_short_does_not_count(spark, tmp_path):
    log = StateLog(spark, str(tmp_path), TABLES)
    for n in range(3):
        log.commit(n, log.before(n), {"a": spark.createDataFrame([(n,)], "x long")}, {"n": n})
    path = tmp_path / "head" / "0"  # batch 2's
    path.write_text(path.read_text()[:-9])
    (tmp_path / "head" / ".0.crc").unlink(missing_ok=True)
    assert log.newest().version == 1 and rows_of(log, log.newest(), "a") == [0, 1]
    assert opened("") is None and opened(None) is None and opened("00000000 {}") is None and opened(sealed({"v": 1})) == {"v": 1}


def test_reset_and_expiry(spark, tmp_path):
    log = StateLog(spark, str(tmp_path), TABLES, every=4)
    folders = lambda: sum(len(os.listdir(tmp_path / d / t)) for d in ("delta", "snapshot") if (tmp_path / d).exists() for t in os.listdir(tmp_path / d))
    most, want = 0, []
    for n in range(30):
        reset = frozenset({"b"}) if n % 7 == 6 else frozenset()
        added = {"a": spark.createDataFrame([(n,)], "x long")} | ({"b": spark.createDataFrame([(f"{n:02}",)], "y string")} if n % 2 else {})
        log.commit(n, log.before(n), added, {}, reset)
        want = ([] if reset else want) + ([f"{n:02}"] if n % 2 else [])
        assert rows_of(log, log.newest(), "b") == want
        most = max(most, folders())
    assert rows_of(log, log.newest(), "a") == list(range(30)) and most <= 2 * (2 * 4 + 2)


def test_batch_ten_thousand_costs_what_batch_ten_does(spark, tmp_path):
    log = StateLog(spark, str(tmp_path), TABLES)
    plan = lambda n: log.plan(n, lambda: {"now_s": n})
    calls, sizes = {}, {}
    for n in [*range(12), *range(9_000, 10_002)]:
        was = log.files.calls
        head = log.before(n)
        assert plan(n)["now_s"] == n and plan(n)["now_s"] == n
        log.commit(n, head, {}, {"n": n})
        calls[n] = log.files.calls - was
    assert calls[10] == calls[10_000] <= 8
    sizes = {d: len([f for f in os.listdir(tmp_path / d) if not f.startswith(".")]) for d in ("head", "plan")}
    assert sizes == {"head": 2, "plan": 2}


def test_compacted_operations_decide_the_same_from_then_on(spark):
    rng = random.Random(4)
    kinds = ["discover", "seed", "track", "remove", "seed_removed"]
    rows = [(f"C{rng.randint(0, 40)}", rng.choice(kinds), rng.randint(0, 60), i) for i in range(600)]
    ops = spark.createDataFrame(rows, "contract_id string, op string, ledger_seq long, log_seq long")
    small = watchlist.compact_ops(ops, 40).persist()
    assert small.where("ledger_seq < 40").count() <= 2 * 41 + 5 < ops.where("ledger_seq < 40").count()
    at = lambda o: {(r.contract_id, n) for r in watchlist.watchlist_intervals(watchlist.watchlist_fold(o)).collect() for n in range(41, 64) if r.from_ledger <= n < (r.to_ledger or 99)}
    assert at(small) == at(ops)


@pytest.mark.parametrize("size", [1, 2, 5, 7])
def test_rotation_by_key(spark, size):
    ids = spark.createDataFrame([(f"C{i}",) for i in range(5)], "contract_id string")
    after, seen = None, []
    for _ in range(-(-5 // size)):
        batch, after = state.rotate(ids, after, size)
        seen += batch
    assert seen == [f"C{i}" for i in range(5)] and after is None
    # What stands behind the place has gone: the next pass begins; an empty list has no batch.
    assert state.rotate(ids.where("contract_id < 'C3'"), "C3", 2) == (["C0", "C1"], "C1")
    assert state.rotate(ids.where("false"), "C3", 2) == ([], None)
    # A new id behind the place comes in this pass, one before it in the next.
    more = ids.union(spark.createDataFrame([("B",), ("C11",)], "contract_id string"))
    assert state.rotate(more, "C1", 2) == (["C11", "C2"], "C2")
    plan = state.next_ids(ids, "C1", 2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Window" not in plan


def test_insert_once_beyond_any_watermark(spark, tmp_path, monkeypatch):
    from ledgerstream.streaming import insert_once

    schema = "message_id string, published_at timestamp, body string"
    parts = [[("a", 1, "x"), ("b", 1, "x"), ("a", 0, "first")], [("c", 2, "x"), (None, 2, "n"), (None, 2, "n")], [("b", 9_000_000, "late"), ("d", 9_000_000, "x")], [("a", 1, "x"), ("c", 3, "late"), ("e", 9, "x")]]
    for rows in parts:
        spark.createDataFrame(rows, "message_id string, s long, body string").select("message_id", F.timestamp_seconds("s").alias("published_at"), "body").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    broken = {"left": 1}

    def then(df, n):
        if n == 2 and broken["left"]:
            broken["left"] = 0
            raise RuntimeError("between write and commit")

    run = lambda: insert_once.insert_once(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp"), 4, then).awaitTermination()
    with pytest.raises(Exception, match="between write and commit"):
        run()
    monkeypatch.setattr(insert_once, "PUSHED", 1)  # the rest by joins
    run()
    got = sorted((r.message_id or "", r.body) for r in spark.read.parquet(str(tmp_path / "out" / "messages")).collect())
    assert got == [("", "n"), ("", "n"), ("a", "first"), ("b", "x"), ("c", "x"), ("d", "x"), ("e", "x")]


def test_a_late_repeat_probes_few_buckets(spark, tmp_path):
    from ledgerstream.streaming.insert_once import InsertOnce

    once = InsertOnce(spark, str(tmp_path), buckets=8, every=2)
    ids = lambda a, b: spark.range(a, b).selectExpr("cast(id as string) as message_id", "timestamp_seconds(id) as published_at")
    for n in range(3):
        once.keep(once.new_of(ids(100 * n, 100 * n + 150), n).persist(), n)
    late = ids(7, 8)
    assert once.new_of(late, 3).count() == 0 and len(once.touched(late)) == 1
    plan = once.seen(late, once.log.newest())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "EqualTo(message_id,7)" in plan
    total = sum(once.log.read(once.log.newest(), once.name(b)).distinct().count() for b in range(8))
    assert total == 350
