"""Literal cases, closed forms against brute force, and streams against batches."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerstream import functions as fn
from ledgerstream.operators import control, detect, envelope, gaps, routing, state, watchlist
from ledgerstream.plans.queries import facts as batch_facts
from ledgerstream.sources import readers
from ledgerstream.sources.adapter import Tables
from ledgerstream.streaming import live

SF = "/root/testdata/sf0.001"


def test_guard_table(spark):
    cases = {(3, 3): False, (9, 9): False, (10, 10): True, (200, 200): True, (200, 100): False, (200, 101): True, (200, 3): False, (50, 0): False}
    df = spark.createDataFrame(list(cases), "requested long, missing long").withColumn("bad", state.implausible())
    assert {(r.requested, r.missing): r.bad for r in df.collect()} == cases


def test_clamp_table(spark):
    rows = [(1500, 1000, 2000), (1000, 1000, 2000), (2001, 1000, 2000), (2060, 1000, 2000), (500, 1000, 2000), (2061, 1000, 2000), (5, 20, 10)]
    got = [(r.outcome, r.resolved, r.gap_from, r.gap_to) for r in gaps.clamp_start(spark.createDataFrame(rows, "start long, oldest long, latest long")).collect()]
    assert got == [("ok", 1500, None, None), ("ok", 1000, None, None), ("ok", 2001, None, None), ("ok", 2060, None, None), ("clamped", 1000, 500, 999), ("beyond_tip", None, None, None), ("inverted", None, None, None)]


@pytest.mark.parametrize(("pattern", "key", "hit"), [("a.#", "a", True), ("a.#", "a.b.c", True), ("a.#", "ab", False), ("#", "x.y", True), ("#.c", "c", True), ("#.c", "a.b.c", True), ("#.c", "a.bc", False), ("a.*.c", "a.b.c", True), ("a.*.c", "a.c", False), ("a.#.c", "a.c", True), ("a.#.c", "a.x.y.c", True), ("a+b.*", "a+b.x", True)])
def test_topics(spark, pattern, key, hit):
    import re

    assert bool(re.fullmatch(fn.topic_regex(pattern), key)) == hit
    m = spark.createDataFrame([(key, "m")], "topic_key string, message_id string")
    b = spark.createDataFrame([("q", pattern)], "queue string, pattern string")
    assert routing.route(m, b).count() == int(hit)
    assert routing.unroutable(m, b).count() == 1 - int(hit)


def test_transfer_cases(spark):
    t = "topics array<struct<type:string,value:string>>, n long"
    a, s = lambda v: ("address", v), lambda v: ("symbol", v)
    rows = [([s("transfer"), a("X"), a("Y")], 1), ([s("transfer"), s("junk"), a("Y")], 2), ([s("transfer"), a("X")], 3), ([], 4), ([a("transfer"), a("X"), a("Y")], 5), (None, 6)]
    got = {r.n: (r.r, r.s) for r in spark.createDataFrame(rows, t).select("n", fn.transfer_recipient().alias("r"), fn.first_topic_symbol().alias("s")).collect()}
    assert got == {1: ("Y", "transfer"), 2: (None, "transfer"), 3: (None, "transfer"), 4: (None, None), 5: (None, None), 6: (None, None)}


def test_fold_matches_a_state_machine(spark):
    rng = random.Random(3)
    log = [(f"C{rng.randrange(12)}", rng.choice(["discover", "seed", "track", "remove", "seed_removed"]), rng.randrange(40), i) for i in range(600)]
    got = {(r.contract_id, r.log_seq): r.status for r in watchlist.watchlist_fold(spark.createDataFrame(log, "contract_id string, op string, ledger_seq long, log_seq long")).collect()}
    key = lambda x: (x[0], x[2] + (x[1] in ("track", "remove")), 0 if x[1] in ("track", "remove") else 1, x[3])
    now = {}
    for c, op, _, i in sorted(log, key=key):
        s = now.get(c, "untracked")
        now[c] = "tracked" if op == "track" else "tombstoned" if op in ("remove", "seed_removed") else "tracked" if s == "untracked" else s
        assert got[c, i] == now[c]


def test_window_errors(spark):
    m = "[-32600] start ledger (5) must be between the oldest ledger: {} and the latest ledger: {} for this instance"
    rows = [(m.format(2, 10), 11, "beyond_tip"), (m.format(20, 30), 11, "below_retention"), (m.format(2, 30), 11, "none"), (m.format(2, 99999999999), 11, "none"), ("reset", 11, "none"), (None, 11, "none")]
    df = spark.createDataFrame(rows, "error string, requested long, want string").withColumn("got", fn.window_error_class())
    assert all(r.got == r.want for r in df.collect())


def test_sources(spark, tmp_path):
    (tmp_path / "seeds").write_text("# list\n C1 \n\nC2\n")
    assert sorted(r[0] for r in readers.read_seed_list(spark, str(tmp_path / "seeds")).collect()) == ["C1", "C2"]
    assert readers.read_seed_list(spark, "").count() == 0
    (tmp_path / "s.json").write_text('{"network": "testnet", "last_ledger": 7, "escrow_contracts": ["C1", "C2"], "removed_contracts": ["C2"]}')
    st = readers.load_state(spark, str(tmp_path / "s.json"), "testnet")
    now = watchlist.watchlist_now(watchlist.watchlist_fold(readers.state_ops(st)))
    assert {r.contract_id: r.status for r in now.collect()} == {"C1": "tracked", "C2": "tombstoned"}
    with pytest.raises(Exception, match="another network"):
        readers.load_state(spark, str(tmp_path / "s.json"), "public").collect()
    readers.valid_range(1, 2)
    for bad in ((0, 2), (3, 2), (1, 1 << 33)):
        with pytest.raises(ValueError):
            readers.valid_range(*bad)


def test_strict_raises(spark):
    e = envelope.event_envelope(batch_facts(Tables(spark, SF)), "", F.current_timestamp())
    with pytest.raises(Exception, match="missing network"):
        envelope.split_valid(e, strict=True)[0].collect()


def test_commands(spark):
    rows = [(1, "reseed", None, ["A"] * 5001, 0), (2, "reseed", None, ["A"], 0), (3, "pause", None, None, 3601), (4, "dance", None, None, 0), (5, "track_escrow", "C", None, 0), (6, None, None, None, 0)]
    df = spark.createDataFrame(rows, "cmd_seq long, command string, contract_id string, contract_ids array<string>, ttl_seconds long")
    got = {r.cmd_seq: r.reject_reason for r in control.validate_command(df).collect()}
    assert got == {1: "too many ids", 2: None, 3: "ttl over an hour", 4: "unknown command", 5: None, 6: "unknown command"}


def landed(t):
    ev = t.raw_events.select(F.lit("event").alias("kind"), "*")
    ch = t.instance_changes.select(F.lit("instance").alias("kind"), "*")
    return ev.unionByName(ch, allowMissingColumns=True)


@pytest.mark.parametrize("parts", [1, 3])
def test_stream_equals_batch_with_a_failure(spark, tmp_path, parts):
    t = Tables(spark, SF)
    rows = landed(t).withColumn("part", F.floor((F.col("ledger_seq") - 1) / (8641 / parts))).persist()
    src = str(tmp_path / "in")
    for i in range(parts):  # a file holds whole ledgers
        rows.where(F.col("part") == i).drop("part").coalesce(1).write.mode("append").parquet(f"{src}")
    broken = {"left": 1}

    def sink(df, batch_id):
        if broken["left"]:
            broken["left"] -= 1
            raise RuntimeError("between write and commit")

    job = live.LiveJob(spark, str(tmp_path / "out"), watchlist.approved_hashes(t.approved), commands=lambda: t.commands, sinks=[(sink, True), (live.noop_sink, False)])
    stream = lambda: readers.tail_ledgers(spark, src, rows.drop("part").schema, 1)
    with pytest.raises(Exception, match="between write and commit"):
        job.start(stream(), str(tmp_path / "cp")).awaitTermination()
    job.start(stream(), str(tmp_path / "cp")).awaitTermination()
    want = {tuple(r) for r in batch_facts(t).select("type", "contract_id", "tx_hash", "event_index").collect()}
    got = [tuple(r) for r in job.facts().select("type", "contract_id", "tx_hash", "event_index").collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_replay_needs_the_whole_range(spark):
    t = Tables(spark, SF)
    now = spark.createDataFrame([("1", "tracked")], "contract_id string, status string")
    low, high = t.ledgers.agg(F.min("ledger_seq"), F.max("ledger_seq")).first()
    stamp = F.current_timestamp()
    assert live.run_replay(t.raw_events, t.ledgers, now, low - 5, high, "testnet", stamp).count() == 0
    assert live.run_replay(t.raw_events, t.ledgers, now, low, high, "testnet", stamp).count() == detect.detect(t.raw_events, now.selectExpr("contract_id", "0L as from_ledger", "cast(null as bigint) as to_ledger")).count()


def test_stream_state_and_history(spark, tmp_path):
    rows = [("C1", "updated", 5, "2024-01-01 00:00:00"), ("C1", "removed", 7, "2024-01-01 00:01:00"), ("C2", "updated", 6, "2024-01-01 00:02:00")]
    df = spark.createDataFrame(rows, "contract_id string, state_change_type string, ledger_seq long, published_at string").withColumn("published_at", F.to_timestamp("published_at"))
    for i in range(3):
        df.limit(i + 1).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    run = lambda: live.stream_state(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    run()
    view = lambda: {(r.contract_id, r.ledger_seq, r.state_change_type) for r in live.state_now(spark, str(tmp_path / "out")).collect()}
    assert view() == {("C1", 7, "removed"), ("C2", 6, "updated")}
    # Each of the three files repeats what came before: a row a change, none a repeat.
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    # After a restart from the checkpoint older rows change nothing, newer ones do.
    late = [("C1", "updated", 6, "2024-01-01 00:03:00"), ("C2", "updated", 9, "2024-01-01 00:04:00"), ("C3", "updated", 1, None)]
    spark.createDataFrame(late, "contract_id string, state_change_type string, ledger_seq long, published_at string").withColumn("published_at", F.coalesce(F.to_timestamp("published_at"), F.lit("2024-01-01").cast("timestamp"))).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    assert view() == {("C1", 7, "removed"), ("C2", 9, "updated"), ("C3", 1, "updated")}
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5
    want = state.state_view(spark.read.parquet(str(tmp_path / "in")))
    assert {tuple(r) for r in live.state_now(spark, str(tmp_path / "out")).select(*want.columns).collect()} == {tuple(r) for r in want.collect()}


LANDED = "kind string, ledger_seq long, closed_at timestamp, ledger_hash string, prev_hash string, tx_hash string, tx_index long, op_index long, op_event_pos long, emitter string, topics array<struct<type:string,value:string>>, raw_xdr string, contract_id string, entry_type string, key_type string, post_present boolean, executable_type string, wasm_hash string, log_seq long"
H = "ab" * 32


def small_chain(spark, folder, active, broken=None):
    """Six ledgers, two a file; A, B and C are discovered in the first, ``active`` says who has an event where."""
    from datetime import datetime, timezone

    at = lambda n: datetime.fromtimestamp(1000 * n, timezone.utc)
    rows = []
    for n in range(1, 7):
        rows.append({"kind": "ledger", "ledger_seq": n, "closed_at": at(n), "ledger_hash": f"h{n}", "prev_hash": "fork" if n == broken else f"H{n - 1}"})
        for c in active.get(n, ""):
            rows.append({"kind": "event", "ledger_seq": n, "closed_at": at(n), "tx_hash": f"t{n}{c}", "tx_index": 1, "op_index": 0, "op_event_pos": 0, "emitter": c, "topics": [("symbol", "fund")], "raw_xdr": "x"})
    rows += [{"kind": "instance", "ledger_seq": 1, "contract_id": c, "entry_type": "contract_data", "key_type": "instance", "post_present": True, "executable_type": "wasm", "wasm_hash": H, "log_seq": i} for i, c in enumerate("ABC")]
    names = [f.split()[0] for f in LANDED.split(", ")]
    for i in range(3):
        part = [tuple(r.get(k) for k in names) for r in rows if (r["ledger_seq"] - 1) // 2 == i]
        spark.createDataFrame(part, LANDED).coalesce(1).write.mode("append").parquet(folder)


def small_job(spark, tmp_path, **more):
    entries = spark.createDataFrame([(c, 1, "vec/persistent", True, 3, f"s{c}") for c in "AC"], "contract_id string, pos long, key_kind string, is_data boolean, last_modified_ledger long, raw_xdr string")
    log = [(1, "track_escrow", "D"), (2, "track_escrow", None), (3, "refresh_escrow", "A"), (4, "refresh_escrow", "Z")]
    commands = spark.createDataFrame([(n, "2000-01-01 00:00:00", 1, k, c, None, None) for n, k, c in log], "cmd_seq long, ts string, after_ledger long, command string, contract_id string, contract_ids array<string>, ttl_seconds long").withColumn("ts", F.to_timestamp("ts"))
    approved = spark.createDataFrame([(H,)], "wasm_hash string")
    return live.LiveJob(spark, str(tmp_path / "out"), approved, commands=lambda: commands, **{"entries": lambda: entries, "now_s": lambda: 6010, "catching_up_s": 1500, "sweep_size": 2, **more})


def run_small(spark, tmp_path, job):
    job.start(readers.tail_ledgers(spark, str(tmp_path / "in"), LANDED, 1), str(tmp_path / "cp")).awaitTermination()


def test_states_wait_for_the_tip(spark, tmp_path):
    small_chain(spark, str(tmp_path / "in"), {1: "A", 4: "B", 6: "C"})
    broken = {"left": 1}

    def sink(df, batch_id):
        if batch_id == 2 and broken["left"] and df.where("type = 'state'").count():
            broken["left"] = 0
            raise RuntimeError("between write and commit")

    job = small_job(spark, tmp_path, sinks=[(sink, True)])
    with pytest.raises(Exception, match="between write and commit"):
        run_small(spark, tmp_path, job)
    run_small(spark, tmp_path, job)
    got = {(r.contract_id, r.ledger_seq, r.state_change_type) for r in job.states().collect()}
    # Commands' ids at the first batch's last ledger; A and B held until ledger 5, the first at the tip; a sweep of two at 6.
    want = {("D", 2, "removed"), ("A", 2, "updated"), ("A", 5, "updated"), ("B", 5, "removed"), ("C", 6, "updated"), ("A", 6, "updated"), ("B", 6, "removed")}
    assert got == want and job.states().count() == len(want)
    assert {(r.cmd_seq, r.reject_reason) for r in spark.read.parquet(str(tmp_path / "out" / "rejected_commands")).collect()} == {(2, "no contract_id")}
    assert {r.contract_id for r in job.facts().collect()} == {"A", "B", "C"}
    assert job.log.newest().tables["pending"] == {"snapshot": None, "deltas": []}
    assert {r.contract_id for r in job.log.read(job.log.newest(), "watchlist").collect()} == {"A", "B", "C", "D"}


def test_resume_must_continue_the_chain(spark, tmp_path):
    small_chain(spark, str(tmp_path / "in"), {2: "A"}, broken=3)
    with pytest.raises(Exception, match="ledger 3 does not continue ledger 2"):
        run_small(spark, tmp_path, small_job(spark, tmp_path))


def test_pause_holds_a_batch(spark, tmp_path):
    from datetime import datetime, timezone

    small_chain(spark, str(tmp_path / "in"), {2: "A"})
    clock = {"now": 6010}
    log = spark.createDataFrame([(1, datetime.fromtimestamp(6000, timezone.utc), 1, "pause", None, None, 60)], "cmd_seq long, ts timestamp, after_ledger long, command string, contract_id string, contract_ids array<string>, ttl_seconds long")
    job = small_job(spark, tmp_path, now_s=lambda: clock["now"], hold=lambda s: clock.update(now=clock["now"] + 30))
    job.commands = lambda: log
    run_small(spark, tmp_path, job)
    assert clock["now"] == 6070 and job.facts().count() == 1


def test_gaps_come_before_processing(spark, tmp_path):
    seen = []
    job = small_job(spark, tmp_path, sinks=[(lambda df, b: seen.append((b, [r.message_id for r in df.collect()])), True)])
    ledgers = spark.createDataFrame([(n,) for n in range(100, 121)], "ledger_seq long")
    assert job.record_gap(ledgers, 40) == 100 and job.record_gap(ledgers, 110) == 110
    assert seen == [(-1, ["gap:testnet:40:99"])] * 2 and job.gaps().count() == 1
    for start in (181, 5000):
        with pytest.raises(ValueError, match="beyond_tip"):
            job.record_gap(ledgers, start)


def test_sinks(spark, tmp_path):
    df = envelope.event_envelope(batch_facts(Tables(spark, SF)), "testnet", F.current_timestamp())
    live.topic_sink(str(tmp_path / "topic"))(df, 3)
    out = spark.read.parquet(str(tmp_path / "topic" / "batch_id=3"))
    assert out.count() == df.count() and {r.topic_key for r in out.select("topic_key").distinct().collect()} == {r.topic_key for r in envelope.messages(df).select("topic_key").distinct().collect()}

    def bad(df, batch_id):
        raise RuntimeError("no broker")

    seen = []
    assert live.fan_out(df, 0, [(bad, False), (lambda d, b: seen.append(b), True)]) == ["no broker"] and seen == [0]
    with pytest.raises(RuntimeError):
        live.fan_out(df, 0, [(bad, True)])


def test_stream_history_drops_repeats(spark, tmp_path):
    e = envelope.event_envelope(batch_facts(Tables(spark, SF)), "testnet", F.current_timestamp())
    for _ in range(2):  # the second file repeats the first
        e.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    live.stream_history(source, "2 days").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    got = [r.message_id for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert len(got) == len(set(got)) and set(got) == {r.message_id for r in e.collect()}


def test_continuity_after_a_cursor(spark):
    ledgers = spark.createDataFrame([(8, "aa", "Ff00"), (9, "bb", "AA")], "ledger_seq long, ledger_hash string, prev_hash string")
    continues = lambda n, h: [r.continues for r in gaps.chain_continuity(ledgers, n, h).collect()]
    assert continues(7, "fF00") == [True] and continues(8, "AA") == [True] and continues(8, "cc") == [False] and continues(7, None) == [] and continues(3, "aa") == []


def test_first_source_only(spark):
    rows = [(1, 1, "n"), (2, 1, "n"), (2, 2, "n"), (3, 2, "n"), (1, 0, "other")]
    df = spark.createDataFrame(rows, "ledger_seq long, priority long, network string")
    best = {(r.ledger_seq, r.priority) for r in gaps.coalesce_sources(df, "n").collect()}
    first = {(r.ledger_seq, r.priority) for r in gaps.coalesce_sources(df, "n", "first_source").collect()}
    assert best == {(1, 1), (2, 1), (3, 2)} and first == {(1, 1), (2, 1)}


def test_times_are_utc_in_any_session(spark):
    stamps = [0, 1706572800, 1710054000 + 1800, 1730611800, 1730615400]  # among them both changes of the clock in New York
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([(s,) for s in stamps], "s long")
        got = [r[0] for r in df.select(fn.rfc3339(F.timestamp_seconds("s"))).collect()]
        facts = {(r.tx_hash, r.ledger_seq) for r in batch_facts(Tables(spark, SF)).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    from datetime import datetime, timezone

    assert got == [datetime.fromtimestamp(s, timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ") for s in stamps]
    assert facts == {(r.tx_hash, r.ledger_seq) for r in batch_facts(Tables(spark, SF)).collect()}


def test_urls(spark):
    rows = [("https://u:p@ss@h.org:8443/x", "h.org:8443", "https://u:***@h.org:8443/x"), ("https://h.org/a:b@c", "h.org", "https://h.org/a:b@c"), ("not a url", "unknown", "not a url"), ("https://u@h/", "h", "https://u@h/"), (None, "unknown", None)]
    df = spark.createDataFrame(rows, "u string, host string, redacted string")
    assert all((r.a, r.b) == (r.host, r.redacted) for r in df.select("*", fn.url_host("u").alias("a"), fn.redact_url("u").alias("b")).collect())


def test_sanitized_bytes(spark):
    rows = [(b"a\x00b", "ab"), (b"a\xff\xfeb\xc3", "a?b?"), ("\u00e9".encode(), "\u00e9"), (b"", ""), (None, None)]
    df = spark.createDataFrame(rows, "raw binary, want string")
    assert all(r.got == r.want for r in df.select("want", fn.sanitize_text("raw").alias("got")).collect())


def test_split_state_records(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"network": "testnet", "last_ledger": 9, "escrow_contracts": ["old"]}')
    (tmp_path / "w.json").write_text('{"escrow_contracts": ["C1"], "removed_contracts": ["C2"], "gaps": [{"from_ledger": 1, "to_ledger": 2, "reason": "r"}]}')
    r = readers.load_state(spark, str(tmp_path / "c.json"), "testnet", str(tmp_path / "w.json")).first()
    assert (r.last_ledger, r.escrow_contracts, r.removed_contracts, len(r.gaps)) == (9, ["C1"], ["C2"], 1)
    assert readers.load_state(spark, str(tmp_path / "c.json"), "testnet").first().escrow_contracts == ["old"]


def test_reseeded_ids_respect_tombstones(spark):
    rows = [(1, 5, "remove_escrow", "C9", None), (2, 6, "reseed", None, ["C1", "C9"]), (3, 7, "track_escrow", "C9", None)]
    ops = watchlist.command_ops(spark.createDataFrame(rows, "cmd_seq long, after_ledger long, command string, contract_id string, contract_ids array<string>"))
    got = {(r.contract_id, r.from_ledger, r.to_ledger) for r in watchlist.watchlist_intervals(watchlist.watchlist_fold(ops)).collect()}
    assert got == {("C1", 7, None), ("C9", 8, None)}


def test_flush_and_gaps_stay_linear(spark):
    """A quarter of a million ledgers in seconds: a frame that is computed anew for each row would take hours."""
    import time

    n = 250_000
    ledgers = spark.range(1, n + 1).selectExpr("id as ledger_seq", "id % 1000 = 0 as at_tip")
    active = spark.range(1, n + 1).selectExpr("id as ledger_seq", "cast(id % 7 as string) as contract_id")
    began = time.time()
    assert state.deferred_flush(active, ledgers).count() == 7 * (n // 1000)
    g = spark.range(0, n, 1000).selectExpr("id + 1 as from_ledger", "id + 1000 as to_ledger")
    left = gaps.remaining_gaps(g, ledgers.where("ledger_seq % 500 <> 0"))
    assert left.count() == n // 500 and left.agg(F.sum(F.col("to_ledger") - F.col("from_ledger"))).first()[0] == 0
    assert time.time() - began < 60


def test_many_bindings(spark, monkeypatch):
    m = spark.createDataFrame([("a.b", "m1"), ("a.c", "m2")], "topic_key string, message_id string")
    b = spark.createDataFrame([("q1", "a.*"), ("q2", "#.c"), ("q2", "a.c")], "queue string, pattern string")
    monkeypatch.setattr(routing, "MOST_BINDINGS", 2)
    assert {(r.message_id, r.queue) for r in routing.route(m, b).collect()} == {("m1", "q1"), ("m2", "q1"), ("m2", "q2")}


def test_a_fork_is_seen_without_entries(spark, tmp_path):
    small_chain(spark, str(tmp_path / "in"), {2: "A"}, broken=3)
    with pytest.raises(Exception, match="ledger 3 does not continue ledger 2"):
        run_small(spark, tmp_path, small_job(spark, tmp_path, entries=None))


def test_a_running_job_leaves_no_scratch_and_tells_its_status(spark, tmp_path):
    import os

    from ledgerstream.operators import ops
    from ledgerstream.streaming import tables

    small_chain(spark, str(tmp_path / "in"), {1: "A", 4: "B", 6: "C"})
    root = tables.shared_root(spark).removeprefix("file://")
    before = set(os.listdir(root))
    job = small_job(spark, tmp_path)
    run_small(spark, tmp_path, job)
    assert set(os.listdir(root)) == before
    got = {r.metric: r.value for r in job.metrics(6020).collect()}
    counts = spark.createDataFrame([(job.facts().count(), job.states().count(), 4, 0, 0)], "events long, states long, tracked long, gaps long, suppressed long")
    progress = spark.createDataFrame([(6, 6000, 6010)], "ledger_seq long, c long, p long").select("ledger_seq", F.timestamp_seconds("c").alias("closed_at"), F.timestamp_seconds("p").alias("processed_at"))
    want = {r.metric: r.value for r in ops.metrics_long(ops.status(progress, counts, 6020), "testnet").collect()}
    assert got == want and len(got) == 11 and got["events_published_total"] == 3 and got["state_changes_published_total"] == 7


def test_a_job_resumes_from_a_saved_state(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"network": "testnet", "last_ledger": 2, "escrow_contracts": ["E"], "removed_contracts": ["A"]}')
    saved = readers.load_state(spark, str(tmp_path / "s.json"), "testnet")
    small_chain(spark, str(tmp_path / "in"), {3: "AE", 5: "BE"})
    job = small_job(spark, tmp_path, entries=None, initial=readers.state_ops(saved), initial_cursor=(2, "other"))
    job.commands = None
    with pytest.raises(Exception, match="ledger 3 does not continue ledger 2"):
        job.start(spark.readStream.schema(LANDED).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")).where("ledger_seq > 2"), str(tmp_path / "cp")).awaitTermination()
    job.initial_cursor = (2, "h2")
    job.start(spark.readStream.schema(LANDED).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")).where("ledger_seq > 2 or kind = 'instance'"), str(tmp_path / "cp2")).awaitTermination()
    # A is tombstoned by the saved state, E seeded by it, B discovered.
    assert {(r.contract_id, r.ledger_seq) for r in job.facts().collect()} == {("E", 3), ("B", 5), ("E", 5)}


def test_a_retry_publishes_the_states_that_were_written(spark, tmp_path):
    small_chain(spark, str(tmp_path / "in"), {6: "A"})
    broken, reads, seen = {"left": 1}, [], []

    def sink(df, batch_id):
        seen.extend((batch_id, r.message_id, r.raw_xdr) for r in df.where("type = 'state'").collect())
        if batch_id == 2 and broken["left"] and df.where("type = 'state'").count():
            broken["left"] = 0
            raise RuntimeError("between write and commit")

    def entries():  # another snapshot each time
        reads.append(1)
        return spark.createDataFrame([(c, 1, "vec/persistent", True, 3, f"s{c}{len(reads)}") for c in "ABC"], "contract_id string, pos long, key_kind string, is_data boolean, last_modified_ledger long, raw_xdr string")

    job = small_job(spark, tmp_path, sinks=[(sink, True)], entries=entries)
    with pytest.raises(Exception, match="between write and commit"):
        run_small(spark, tmp_path, job)
    run_small(spark, tmp_path, job)
    last = [x[1:] for x in seen if x[0] == 2]
    assert len(last) == 2 * len(set(last)) and job.states().count() == len({x[1:] for x in seen})
    assert {r.metric: r.value for r in job.metrics(6010).collect()}["state_changes_published_total"] == job.states().count()
