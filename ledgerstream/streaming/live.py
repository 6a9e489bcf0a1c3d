"""The live job: one foreachBatch over landed ledgers, with replay, backfill, fan-out and stateful views.

A landed file holds whole ledgers, so a transaction is never split over micro-batches. Order inside a batch comes from
ledger numbers, not arrival. Everything of a batch is written to folders named after it and overwritten by a retry; the
stream's checkpoint moves after that, so a crash between write and commit repeats the batch with the same result. What a
batch depends on besides its rows, the clock and the end of the command log, is written down first and read by a retry; states,
which come from a snapshot of entries that moves on, are published again by a retry as they were once written.

What the job remembers (the watchlist's operations, contracts held back, the cursor, totals) is a ``StateLog``.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..functions import command_problem
from ..operators import control, detect, envelope, gaps, ops, state, watchlist
from .statelog import Head, StateLog, Table, opened, sealed
from .tables import scratch

OPS = "contract_id string, op string, ledger_seq long, log_seq long"
GAPS = "from_ledger long, to_ledger long, reason string, detected_at timestamp"
STATE = {
    "watchlist": Table(OPS, "contract_id", lambda rows, values: watchlist.compact_ops(rows, values.get("ledger_seq") or 0)),
    "pending": Table("contract_id string", "contract_id", lambda rows, values: rows.distinct()),
}
TOTALS = ("events_published", "state_changes_published", "suppressed_removals")


@dataclass
class LiveJob:
    """``landed``: rows with ``kind``: ``event`` (raw events), ``instance`` (instance changes) and, where continuity is to
    be checked or states are published, ``ledger`` (ledger_seq, closed_at, ledger_hash, prev_hash); files hold whole ledgers.

    ``entries`` returns the snapshot of state entries as it stands; without it no states are published. States of active,
    tracked contracts wait until a ledger is at most ``catching_up_s`` old, then come once; at a last ledger at most
    ``sweep_s`` old the next ``sweep_size`` contracts of the rotation are read as well. ``initial`` are operations a first
    batch starts with (seeds, or ``state_ops`` of a saved state), ``initial_cursor`` the ledger and hash that one ended at.
    """

    spark: SparkSession
    out: str
    approved: DataFrame
    network: str = "testnet"
    commands: Callable[[], DataFrame] | None = None  # the command log as it stands when a batch starts
    published_at: str = "1970-01-01 00:00:00"
    sinks: Iterable[tuple[Callable[[DataFrame, int], None], bool]] = ()
    entries: Callable[[], DataFrame] | None = None
    now_s: Callable[[], int] = lambda: int(time.time())
    hold: Callable[[float], None] = time.sleep  # waits while an operator's pause is on
    catching_up_s: int = 1200
    sweep_s: int = 30
    sweep_size: int = 200
    snapshot_every: int = 32
    initial: DataFrame | None = None
    initial_cursor: tuple[int, str | None] | None = None

    @cached_property
    def log(self) -> StateLog:
        return StateLog(self.spark, f"{self.out}/state", STATE, self.snapshot_every)

    def stamp(self):
        return F.lit(self.published_at).cast("timestamp")

    # -- before the stream --

    def record_gap(self, ledgers: DataFrame, start: int, slack: int = 60) -> int:
        """Clamp ``start`` to what the source (``ledgers``) has; a range that is skipped is recorded, and every recorded gap
        published again, before anything is processed. Returns the ledger to start at."""
        clamped = gaps.clamp_start(gaps.window_of(ledgers).select(F.lit(start).cast("long").alias("start"), "oldest", "latest"), slack)
        row = clamped.first()
        if row["outcome"] in ("beyond_tip", "inverted") or row["oldest"] is None:
            raise ValueError(f"ledger {start} can't be served: {row['outcome']}")
        gaps.as_gaps(clamped, F.timestamp_seconds(F.lit(self.now_s()))).write.mode("append").parquet(f"{self.out}/gaps")
        found = envelope.gap_envelope(self.gaps().dropDuplicates(["from_ledger", "to_ledger"]), self.network, self.stamp())
        fan_out(found, -1, self.sinks)
        return row["resolved"]

    def gaps(self) -> DataFrame:
        if not self.log.files.exists(f"{self.out}/gaps"):
            return self.spark.createDataFrame([], GAPS)
        return self.spark.read.schema(GAPS).parquet(f"{self.out}/gaps")

    # -- a batch --

    def begin(self, head: Head) -> dict:
        """The clock, and the command log's part (after one number, up to another) of a batch; waits while a pause is on."""
        first = head.values.get("commands_upto", -1)
        last = first
        if self.commands:
            while True:
                log = self.commands()
                now = self.now_s()
                until = control.pause_intervals(log.where(command_problem().isNull())).where((F.col("from_s") <= now) & (F.col("to_s") > now)).agg(F.max("to_s")).first()[0]
                if until is None:
                    break
                self.hold(min(5.0, until - now))
            last = max(first, log.agg(F.max("cmd_seq")).first()[0] or first)
        return {"now_s": self.now_s(), "first": first, "last": last, "token": uuid.uuid4().hex}

    def batch(self, df: DataFrame, batch_id: int) -> None:
        with scratch(self.spark):
            self.process(df, batch_id)

    def process(self, df: DataFrame, batch_id: int) -> None:
        head = self.log.before(batch_id)
        plan = self.log.plan(batch_id, lambda: self.begin(head))
        if head.version < 0 and self.initial_cursor:
            head.values |= dict(zip(("ledger_seq", "ledger_hash"), self.initial_cursor, strict=True))
        df = df.persist()  # read for continuity, changes, events and ledgers
        held = [df]
        try:
            cursor = self.cursor(df, head)
            before = self.log.read(head, "watchlist")
            if head.version < 0 and self.initial is not None:
                before = self.initial.select("contract_id", "op", "ledger_seq", "log_seq")
            changes = df.where("kind = 'instance'").select("ledger_seq", "contract_id", "entry_type", "key_type", "post_present", "executable_type", "wasm_hash", "log_seq")
            found = watchlist.discover(changes, self.approved).select("contract_id", F.lit("discover").alias("op"), "ledger_seq", "log_seq")
            new = watchlist.new_discoveries(found, before)
            asked = None
            if self.commands:
                checked = control.validate_command(self.commands().where((F.col("cmd_seq") > plan["first"]) & (F.col("cmd_seq") <= plan["last"])))
                if plan["last"] > plan["first"]:
                    checked.where("reject_reason is not null").select("cmd_seq", "command", "reject_reason").write.mode("overwrite").parquet(f"{self.out}/rejected_commands/batch_id={batch_id}")
                asked = checked.where("reject_reason is null")
                new = new.unionByName(watchlist.command_ops(asked))
            if head.version < 0 and self.initial is not None:
                new = new.unionByName(before)
                before = before.limit(0)
            new = new.distinct().persist()
            held.append(new)
            fold = watchlist.watchlist_fold(before.unionByName(new))
            intervals = watchlist.watchlist_intervals(fold).persist()
            held.append(intervals)
            facts = detect.detect(df.where("kind = 'event'"), intervals)
            events = self.publish("facts", "rejected", envelope.event_envelope(facts, self.network, self.stamp()), batch_id)
            values = {**cursor, "commands_upto": plan["last"], "now_s": plan["now_s"], "events_published": head.values.get("events_published", 0) + events}
            added, reset = ({} if new.isEmpty() else {"watchlist": new}), frozenset()
            status = watchlist.watchlist_now(fold).where("status = 'tracked'").select("contract_id", "status").persist()
            held.append(status)
            if self.entries and cursor["ledgers"]:
                more, pending, reset = self.publish_states(df, batch_id, head, plan, status, watchlist.watchlist_now(fold), asked, cursor)
                values |= more
                if pending is not None:
                    added["pending"] = pending
            values |= {"tracked": status.count(), "gaps": self.gaps().dropDuplicates(["from_ledger", "to_ledger"]).count()}
            self.log.commit(batch_id, head, added, values, reset)
        finally:
            for x in held:
                x.unpersist()

    def publish(self, good_to: str, bad_to: str, envelopes: DataFrame, batch_id: int, written: Callable[[int], None] = lambda n: None) -> int:
        """Valid envelopes written and given to the sinks, rejected ones written with their reason; the number of valid ones.

        ``written`` is called with it when the rows stand and no sink has seen them yet."""
        counted = Observation()
        marked = envelope.with_problem(envelopes).observe(counted, F.count_if(F.col("reject_reason").isNull()).alias("good")).persist()
        good, bad = (f"{self.out}/{x}/batch_id={batch_id}" for x in (good_to, bad_to))
        try:
            marked.where("reject_reason is null").drop("reject_reason").write.mode("overwrite").parquet(good)
            marked.where("reject_reason is not null").write.mode("overwrite").parquet(bad)
        finally:
            marked.unpersist()
        n = counted.get["good"]
        written(n)
        fan_out(self.spark.read.schema(marked.drop("reject_reason").schema).parquet(good), batch_id, self.sinks)
        return n

    def cursor(self, df: DataFrame, head: Head) -> dict:
        """The last ledger of a batch, which must continue the last one processed where both hashes are known.

        A batch whose rows don't tell ledgers leaves the hash unknown, so the next one isn't held against an older ledger."""
        last, last_hash = head.values.get("ledger_seq"), head.values.get("ledger_hash")
        names = set(df.columns)
        if "ledger_hash" in names:
            ledgers = df.where("kind = 'ledger'")
            if last is not None and "prev_hash" in names:
                found = gaps.chain_continuity(ledgers, last, last_hash).first()
                if found is not None and not found["continues"]:
                    raise ValueError(f"ledger {found['ledger_seq']} does not continue ledger {last}")
            row = ledgers.agg(F.max("ledger_seq"), F.max_by("ledger_hash", "ledger_seq"), F.max_by(F.unix_seconds("closed_at"), "ledger_seq"), F.min("ledger_seq")).first()
            if row[0] is not None:
                return {"ledger_seq": row[0], "ledger_hash": row[1], "closed_s": row[2], "first_seq": row[3], "ledgers": True}
        top = df.agg(F.max("ledger_seq")).first()[0]
        if top is None or last is not None and top <= last:
            return {"ledger_seq": last, "ledger_hash": last_hash, "ledgers": False}
        return {"ledger_seq": top, "ledger_hash": None, "ledgers": False}

    def publish_states(self, df: DataFrame, batch_id: int, head: Head, plan: dict, tracked: DataFrame, status: DataFrame, asked: DataFrame | None, cursor: dict) -> tuple[dict, DataFrame | None, frozenset[str]]:
        """Writes and publishes states; the values to remember, contracts newly held back, and whether former ones are let go."""
        now_s, last = plan["now_s"], cursor["ledger_seq"]
        ledgers = df.where("kind = 'ledger'").select("ledger_seq", "closed_at").dropDuplicates(["ledger_seq"]).withColumn("at_tip", now_s - F.unix_seconds("closed_at") <= self.catching_up_s)
        facts = self.spark.read.parquet(f"{self.out}/facts/batch_id={batch_id}")
        before = self.log.read(head, "pending")
        active = detect.active_entities(facts).unionByName(before.select(F.lit(cursor["first_seq"]).cast("long").alias("ledger_seq"), "contract_id"))
        last_tip = ledgers.where("at_tip").agg(F.max("ledger_seq")).first()[0]
        # Held until a later batch reaches the tip: active after this batch's last ledger at the tip.
        waits = active.where(F.col("ledger_seq") > (last_tip or -1)).select("contract_id").distinct()
        pending, reset = (waits, frozenset({"pending"})) if last_tip is not None else (waits.join(before, "contract_id", "left_anti"), frozenset())
        pending = None if pending.isEmpty() else pending
        values = {k: head.values.get(k, 0) for k in ("pass_start", "modified_since", "state_changes_published", "suppressed_removals")} | {"swept_to": head.values.get("swept_to")}
        if asked is not None and not asked.where("command = 'reconcile'").isEmpty():
            values |= {"swept_to": None, "pass_start": 0, "modified_since": 0}
        if self.pinned(batch_id, plan) is not None:  # a retry: the states that were written stand
            values |= self.pinned(batch_id, plan)
            fan_out(self.spark.read.parquet(f"{self.out}/states/batch_id={batch_id}"), batch_id, self.sinks)
            return values, pending, reset
        always = F.lit(0).cast("long")
        at = F.lit(last).cast("long").alias("ledger_seq")
        flushed = state.deferred_flush(active, ledgers.select("ledger_seq", "at_tip"))
        wanted = flushed.select(F.col("flush_ledger").alias("batch_id"), "contract_id", F.col("flush_ledger").alias("ledger_seq"), always.alias("since")).join(tracked, "contract_id", "left_semi")
        if asked is not None:  # commands' ids are read at the last processed ledger
            targets = control.refresh_targets(asked, status)
            wanted = wanted.unionByName(targets.select((-F.col("cmd_seq") - 1).alias("batch_id"), "contract_id", at, always.alias("since")))
        if now_s - cursor["closed_s"] <= self.sweep_s:
            if values["swept_to"] is None:
                values |= {"modified_since": values["pass_start"], "pass_start": last}
            swept, values["swept_to"] = state.rotate(tracked, values["swept_to"], self.sweep_size)
            rows = self.spark.createDataFrame([(c,) for c in swept], "contract_id string")
            wanted = wanted.unionByName(rows.select(F.lit(-(1 << 62)).cast("long").alias("batch_id"), "contract_id", at, F.lit(values["modified_since"]).cast("long").alias("since")))
        judged = state.judged(wanted, state.updates(state.known_entries(self.entries(), tracked))).persist()
        values["suppressed_removals"] += judged.where("is_implausible and state_change_type is null").count()
        found = state.plausible_states(judged).join(wanted.select("batch_id", "contract_id", "ledger_seq", "since").distinct(), ["batch_id", "contract_id"])
        found = state.filter_unchanged(found, F.col("since")).join(ledgers.select("ledger_seq", "closed_at"), "ledger_seq")
        # A contract that several reasons ask for at a ledger is published once.
        once = found.select("contract_id", "state_change_type", "ledger_seq", "closed_at", "raw_xdr", "last_modified_ledger").dropDuplicates(["contract_id", "ledger_seq"])
        n = self.publish("states", "rejected_states", envelope.state_envelope(once, self.network, self.stamp()), batch_id, lambda n: self.pin(batch_id, plan, values | {"state_changes_published": values["state_changes_published"] + n}))
        judged.unpersist()
        return values | {"state_changes_published": values["state_changes_published"] + n}, pending, reset

    def pin(self, batch_id: int, plan: dict, values: dict) -> None:
        self.log.files.write(f"{self.out}/state/states/{batch_id % 2}", sealed({"token": plan["token"], "values": values}))

    def pinned(self, batch_id: int, plan: dict) -> dict | None:
        """The values that go with this batch's states, where an earlier attempt has written them all."""
        found = opened(self.log.files.read(f"{self.out}/state/states/{batch_id % 2}"))
        return found["values"] if found and found["token"] == plan["token"] else None

    # -- figures --

    def status(self, now_s: int | None = None) -> DataFrame:
        """One row of ``status``, from what the newest batch has left."""
        v = self.log.newest().values
        now_s = self.now_s() if now_s is None else now_s
        progress = self.spark.createDataFrame([(v["ledger_seq"], v.get("closed_s"), v["now_s"])] if v else [], "ledger_seq long, closed_s long, processed_s long")
        progress = progress.select("ledger_seq", F.timestamp_seconds("closed_s").alias("closed_at"), F.timestamp_seconds("processed_s").alias("processed_at"))
        counts = self.spark.createDataFrame([(v.get("events_published", 0), v.get("state_changes_published", 0), v.get("tracked", 0), v.get("gaps", 0), v.get("suppressed_removals", 0))], "events long, states long, tracked long, gaps long, suppressed long")
        pauses = control.pause_intervals(self.commands().where(command_problem().isNull())) if self.commands else None
        return ops.status(progress, counts, now_s, pauses=pauses)

    def metrics(self, now_s: int | None = None) -> DataFrame:
        return ops.metrics_long(self.status(now_s), self.network)

    def start(self, landed: DataFrame, checkpoint: str, available_now: bool = True):
        trigger = {"availableNow": True} if available_now else {"processingTime": "5 seconds"}
        return landed.writeStream.foreachBatch(self.batch).option("checkpointLocation", checkpoint).trigger(**trigger).start()

    def facts(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.out}/facts")

    def states(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.out}/states")


def fan_out(df: DataFrame, batch_id: int, sinks: Iterable[tuple[Callable[[DataFrame, int], None], bool]]) -> list[str]:
    """Give a batch to each sink; a required one's failure fails the batch, an optional one's is returned."""
    failures = []
    for sink, required in sinks:
        try:
            sink(df, batch_id)
        except Exception as e:
            if required:
                raise
            failures.append(str(e))
    return failures


def noop_sink(df: DataFrame, batch_id: int) -> None:
    """Writes nothing; rows are still computed, and validated before they come here."""
    df.write.format("noop").mode("overwrite").save()


def topic_sink(path: str) -> Callable[[DataFrame, int], None]:
    return lambda df, batch_id: envelope.messages(df).write.mode("overwrite").partitionBy("topic_key").parquet(f"{path}/batch_id={batch_id}")


def run_backfill(raw: DataFrame, ops: DataFrame, first: int, last: int, network: str, published_at) -> DataFrame:
    """Envelopes of a bounded range; states are left out."""
    from ..sources.readers import scan_range, valid_range

    valid_range(first, last)
    intervals = watchlist.watchlist_intervals(watchlist.watchlist_fold(ops))
    # A range cuts between ledgers, so no transaction loses events to it.
    return envelope.event_envelope(detect.detect(scan_range(raw, first, last), intervals), network, published_at)


def run_replay(raw: DataFrame, ledgers: DataFrame, now: DataFrame, first: int, last: int, network: str, published_at) -> DataFrame:
    """Envelopes of a range by a borrowed watchlist (``now``: contract_id, status); none if the source lacks part of it."""
    served = gaps.require_full_range(ledgers, first, last).select("ledger_seq").distinct()
    tracked = now.where("status = 'tracked'").select("contract_id", F.lit(0).cast("long").alias("from_ledger"), F.lit(None).cast("long").alias("to_ledger"))
    return envelope.event_envelope(detect.detect(raw.join(served, "ledger_seq", "left_semi"), tracked), network, published_at)


def stream_history(envelopes: DataFrame, within: str = "1 hour") -> DataFrame:
    """Insert-once within a bound. Later duplicates pass; ``history_view`` at read is what decides."""
    return envelopes.withWatermark("ledger_closed_at", within).dropDuplicatesWithinWatermark(["message_id"])


class LatestState(StatefulProcessor):
    """The place (ledger, time) of a contract's newest state in the state store: a newer row moves it and goes out, others leave no trace."""

    def init(self, handle) -> None:
        self.held = handle.getValueState("newest", "ledger_seq long, at long")

    def handleInputRows(self, key, rows, timerValues):
        new = max(rows, key=lambda r: (r.ledger_seq, r.at))
        if not self.held.exists() or (new.ledger_seq, new.at) > tuple(self.held.get()):
            self.held.update((new.ledger_seq, new.at))
            yield Row(**new.asDict())

    def close(self) -> None:
        pass


STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def state_changes(states: DataFrame) -> DataFrame:
    """Latest-wins state by keyed state: each contract's newest row so far, whenever a batch brings a newer one (update mode).

    Needs the session's state store to be RocksDB (``STORE``: ``ROCKS``). What a batch costs depends on the contracts in it, not on how
    many there are. A row of the same ledger and time as the held one changes nothing, so a repeated row doesn't either.
    """
    times = [c for c, kind in states.dtypes if kind == "timestamp"]
    # Times go through Python as numbers, so no time zone comes into it.
    rows = states.select(*[F.unix_micros(c).alias(c) if c in times else F.col(c) for c in states.columns], F.coalesce(F.unix_micros("published_at"), F.lit(-(1 << 63))).alias("at"))
    found = rows.groupBy("contract_id").transformWithState(statefulProcessor=LatestState(), outputStructType=rows.schema, outputMode="Update", timeMode="None")
    return found.select(*[F.timestamp_micros(c).alias(c) if c in times else F.col(c) for c in states.columns])


def stream_state(states: DataFrame, out: str, checkpoint: str):
    """Keep a log of state changes under ``out``, one row a change, in a folder a batch that a retry overwrites; ``state_now`` reads it."""
    spark = states.sparkSession
    spark.conf.set(STORE, ROCKS)

    def append(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return state_changes(states).writeStream.outputMode("update").foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def state_now(spark: SparkSession, out: str) -> DataFrame:
    """The view: each contract's newest row of the log. A contract's changes come in order, so this is a look-up, not a vote."""
    return state.state_view(spark.read.parquet(out).drop("batch_id"))
