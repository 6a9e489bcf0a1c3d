"""Ordered scans and the as-of join against brute force, with few and many ranges, hot ids and rows without an id."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerstream.operators import asof, detect, gaps, ops, state, watchlist
from ledgerstream.operators.ordered import Ordered

rng = random.Random(8)
ROWS = [(n, rng.randint(-3, 5), n if rng.random() < 0.1 else None) for n in rng.sample(range(500), 200)]


@pytest.mark.parametrize("rows", [ROWS, ROWS[:3], ROWS[:1], [], [(n, None, None) for n in range(9)]])
def test_scans(spark, rows):
    df = spark.createDataFrame(rows, "n long, d long, tip long").repartition(3)
    up = sorted(rows)
    total, want = 0, {}
    for i, (n, d, _) in enumerate(up):
        total += d or 0
        before, behind = up[i - 1][1] if i else "none", up[i + 1][1] if i + 1 < len(up) else "none"
        want[n] = (total, i + 1, before, behind, next((t for _, _, t in up[i:] if t is not None), None))
    o = Ordered(df, "n")
    run = {r.n: (r.s, r.c) for r in o.running(s=F.col("d"), c=F.lit(1)).collect()}
    of = lambda x: "none" if x is None else x.d
    before = {r.n: of(r.x) for r in o.neighbour("x", "d", behind=False).collect()}
    behind = {r.n: of(r.x) for r in o.neighbour("x", "d", behind=True).collect()}
    near = {r.n: r.t for r in o.nearest("t", F.col("tip")).collect()}
    assert {n: (*run[n], before[n], behind[n], near[n]) for n in run} == want


def test_scans_have_no_window_over_all_rows(spark):
    n = spark.range(1, 1000).selectExpr("id as ledger_seq", "id % 7 = 0 as at_tip", "timestamp_seconds(id) as processed_at", "cast(id % 5 as string) as contract_id", "id as from_ledger", "id + 9 as to_ledger", "id as pass_no", "id as start_ledger", "id % 9 = 0 as is_reset")
    zero = n.select("ledger_seq")
    plans = {
        "W9": state.deferred_flush(n.select("ledger_seq", "contract_id"), n), "W11": state.pass_anchor(n.select("pass_no", "start_ledger", "is_reset")), "W12": ops.stall_windows(n), "A7": watchlist.watchlist_size(n),
        "A2": ops.ledger_progress(n, zero, zero, n, n), "coverage": gaps.coverage_gaps(n), "W10": state.sweep_batches(n, 10),
    }
    for name, df in plans.items():
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        windows = [line for line in plan.splitlines() if "Window [" in line]
        assert windows and all("[_part" in w.split("windowspecdefinition")[1] or "windowspecdefinition(_part" in w for w in windows), (name, windows)


def skewed(spark, n=4000):
    """Nine in ten rows without a transfer's recipient; half of all rows of one emitter; a few per cent tracked."""
    e = spark.range(n).withColumn("ledger_seq", F.col("id") % 97 + 1).withColumn("tx_index", F.col("id") % 3)
    emitter = F.when(F.col("id") % 2 == 0, "HOT").when(F.col("id") % 31 == 1, F.lit(None)).otherwise(F.concat(F.lit("E"), F.col("id") % 50))
    topic = lambda kind, v: F.struct(F.lit(kind).alias("type"), v.alias("value"))
    transfer = F.array(topic("symbol", F.lit("transfer")), topic("address", F.lit("x")), topic("address", F.concat(F.lit("E"), F.col("id") % 40)))
    topics = F.when(F.col("id") % 10 == 1, transfer).otherwise(F.array(topic("symbol", F.lit("fund"))))
    raw = e.select("ledger_seq", F.timestamp_seconds("ledger_seq").alias("closed_at"), F.concat_ws(":", "ledger_seq", "tx_index").alias("tx_hash"), "tx_index", (F.col("id") % 2).alias("op_index"), F.col("id").alias("op_event_pos"), emitter.alias("emitter"), topics.alias("topics"), F.repeat(F.col("id").cast("string"), 20).alias("raw_xdr"))
    iv = [("HOT", 5, 7), ("HOT", 20, 22), ("HOT", 96, None), ("E3", 1, None), ("E7", 10, 50), ("E7", 60, None), ("E11", 200, None), ("E12", -5, 3)]
    return raw, spark.createDataFrame(iv, "contract_id string, from_ledger long, to_ledger long"), iv


def brute_facts(raw, intervals):
    tracked = lambda c, n: any(c == i and a <= n and (b is None or n < b) for i, a, b in intervals)
    seen, out = {}, set()
    for r in sorted(raw.collect(), key=lambda r: (r.ledger_seq, r.tx_index, r.op_index, r.op_event_pos)):
        k = seen[r.ledger_seq, r.tx_index] = seen.get((r.ledger_seq, r.tx_index), -1) + 1
        to = r.topics[2].value if len(r.topics) == 3 else None
        if tracked(r.emitter, r.ledger_seq):
            out.add(("event", r.emitter, r.topics[0].value, r.ledger_seq, r.tx_hash, k, r.raw_xdr))
        elif tracked(to, r.ledger_seq):
            out.add(("deposit", to, "token_transfer", r.ledger_seq, r.tx_hash, k, r.raw_xdr))
    return out


@pytest.mark.parametrize("sent,hot", [(200_000, 2_000_000), (0, 2_000_000), (0, 100)])
def test_detection_of_skewed_rows(spark, monkeypatch, sent, hot):
    monkeypatch.setattr(asof, "SENT_INTERVALS", sent)
    monkeypatch.setattr(asof, "HOT_ROWS", hot)
    raw, intervals, iv = skewed(spark)
    got = detect.detect(raw.repartition(5), intervals).select("type", "contract_id", "event_kind", "ledger_seq", "tx_hash", "event_index", "raw_xdr").collect()
    assert len(got) == len({tuple(r) for r in got}) and {tuple(r) for r in got} == brute_facts(raw, iv)
    at = asof.tracked_at(raw, intervals, "emitter").select("op_event_pos", "is_tracked").collect()
    held = {r.op_event_pos: any(r.emitter == i and a <= r.ledger_seq and (b is None or r.ledger_seq < b) for i, a, b in iv) for r in raw.collect()}
    assert len(at) == 4000 and {r[0]: r[1] for r in at} == held


def test_the_plan_of_detection(spark, monkeypatch):
    raw, intervals, _ = skewed(spark)
    facts = detect.detect(raw, intervals)
    plan = facts._jdf.queryExecution().executedPlan().toString()
    # Few intervals: one shuffle, in which only facts carry their payload.
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 1 and "ledger_seq" in shuffles[0] and plan.count("BroadcastHashJoin") == 2
    below = plan.split("Exchange hashpartitioning")[1]
    assert "op_event_pos" in below and "fact" in below.splitlines()[1]
    # Many: rows without a recipient aren't dealt for it, and a hot id is dealt over many buckets.
    monkeypatch.setattr(asof, "HOT_ROWS", 100)
    roles = raw.select("ledger_seq", F.col("emitter").alias("_id")).where("_id is not null")
    left, right = asof.bucketed(roles, intervals, "_id", "ledger_seq")
    sizes = {(r._id, r._b): r["count"] for r in left.groupBy("_id", "_b").count().collect()}
    assert sum(n for (i, _), n in sizes.items() if i == "HOT") == 2000 and max(sizes.values()) <= 200 and sum(i == "HOT" for i, _ in sizes) >= 10
    assert right.where("_c = 'E3'").count() == 1 and right.where("_c = 'HOT'").count() >= 3
    nulls = raw.select("ledger_seq", F.lit(None).cast("string").alias("_id"), F.col("op_event_pos"))
    spread, _ = asof.bucketed(nulls, intervals, "_id", "ledger_seq")
    assert spread.select("_b").distinct().count() > 3000
    monkeypatch.setattr(asof, "SENT_INTERVALS", 0)
    plan = detect.detect(raw, intervals)._jdf.queryExecution().optimizedPlan().toString()
    # The events themselves, with their payload, are dealt once: by transaction.
    assert plan.count("RepartitionByExpression") == 1


def test_quantiles_of_panes(spark):
    from collections import defaultdict

    rows = [(60 * rng.randint(0, 14) + rng.random() * 59, rng.random() < 0.9, rng.choice([rng.expovariate(1), 5.0, None])) for _ in range(30_000)]
    log = spark.createDataFrame(rows, "s double, ok boolean, duration_s double").withColumn("ts", F.timestamp_seconds("s"))
    panes = ops.fetch_panes(log)
    assert panes.count() == 15 and panes.agg(F.max(F.length("sketch"))).first()[0] < 20_000
    # Panes of two parts of the log are one row each more, and merge to the same.
    both = ops.fetch_panes(log.where("s < 300")).unionByName(ops.fetch_panes(log.where("s >= 300")))
    of = defaultdict(list)
    for s, ok, d in rows:
        if ok and d is not None:
            for i in range(1, 11):
                of[int(s) // 60 * 60 + 60 * i].append(d)
    for found in (ops.quantiles_of_panes(panes), ops.quantiles_of_panes(both)):
        got = found.collect()
        assert {r.end_s: r.n for r in got} == {e: len(v) for e, v in of.items()}
        for r in got:
            for q in ops.QUANTILES:
                x, v = r[f"p{round(q * 100)}"], of[r.end_s]
                assert sum(d < x for d in v) <= (q + 0.02) * len(v) + 1 and sum(d <= x for d in v) >= (q - 0.02) * len(v) - 1


def test_source_cover_against_each_ledger(spark):
    r = random.Random(2)
    for _ in range(4):
        windows = [(p, *sorted((r.randint(0, 60), r.randint(0, 60)))) for p in range(6)] + [(9, 50, 40), (7, None, 3)]
        cover = gaps.source_cover(spark.createDataFrame(windows, "priority long, oldest long, latest long"), 5, 55).collect()
        got = {n: c.priority for c in cover for n in range(c.from_ledger, c.to_ledger + 1)}
        assert sum(c.to_ledger - c.from_ledger + 1 for c in cover) == len(got)
        assert got == {n: min(p for p, a, b in windows if a is not None and a <= n <= b) for n in range(5, 56) if any(a is not None and a <= n <= b for _, a, b in windows)}
        # Neighbouring ranges of one source are one.
        c = sorted(cover, key=lambda c: c.from_ledger)
        assert all(x.priority != y.priority or x.to_ledger + 1 != y.from_ledger for x, y in zip(c, c[1:], strict=False))
    asked = []
    read = lambda p, a, b: asked.append((p, a, b)) or spark.range(a, b + 1).selectExpr("id as ledger_seq", f"{p} as priority")
    windows = spark.createDataFrame([(0, 10, 20), (1, 1, 30)], "priority long, oldest long, latest long")
    assert gaps.read_cover(gaps.source_cover(windows), read).count() == 30 and asked == [(1, 1, 9), (0, 10, 20), (1, 21, 30)]
    assert gaps.read_cover(gaps.source_cover(windows.limit(0)), read) is None
