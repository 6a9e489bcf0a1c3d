"""One query per operator, over the tables derived from ``events``. Times are Unix seconds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import asof, control, detect, envelope, gaps, ops, routing, state, watchlist
from ..sources import readers
from ..sources.adapter import Tables
from ..streaming import live

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
NOW_S = 1706572800  # 2024-01-30


def query(f):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(Tables(spark, sf_dir))

    run.__name__ = f.__name__
    REGISTRY[f.__name__] = run
    return f


def stamp():
    return F.timestamp_seconds(F.lit(NOW_S))


def ops_log(t: Tables) -> DataFrame:
    found = watchlist.discover(t.instance_changes, watchlist.approved_hashes(t.approved)).select("contract_id", F.lit("discover").alias("op"), "ledger_seq", "log_seq")
    return found.unionByName(watchlist.command_ops(t.commands))


def fold(t: Tables) -> DataFrame:
    return watchlist.watchlist_fold(ops_log(t))


def intervals(t: Tables) -> DataFrame:
    return watchlist.watchlist_intervals(fold(t))


def held_intervals(t: Tables) -> DataFrame:
    """``intervals``, stored: several steps of a query read them."""
    return t.kept("intervals", lambda: intervals(t))


def facts(t: Tables) -> DataFrame:
    return detect.detect(t.raw_events, held_intervals(t))


def tracked_now(t: Tables) -> DataFrame:
    return t.kept("tracked", lambda: watchlist.watchlist_now(fold(t)).where("status = 'tracked'").select("contract_id"))


def envelopes(t: Tables) -> DataFrame:
    return envelope.event_envelope(facts(t), "testnet", stamp())


def changes(t: Tables) -> DataFrame:
    return state.updates(state.known_entries(t.entries, tracked_now(t)))


def states(t: Tables) -> DataFrame:
    """States of all tracked contracts at the last ledger's stamp."""
    s = state.append_removed(tracked_now(t), changes(t))
    return s.select("contract_id", "state_change_type", F.when(F.col("last_modified_ledger") == 0, 8640).otherwise(F.col("last_modified_ledger")).cast("long").alias("ledger_seq"), stamp().alias("closed_at"), "raw_xdr", "last_modified_ledger")


def batches(t: Tables) -> DataFrame:
    """Requested ids in batches by their number."""
    return t.ev.select("uid", "user_id").distinct().select((F.col("user_id") % 7).alias("batch_id"), F.col("uid").alias("contract_id"))


def missing_rows(t: Tables) -> DataFrame:
    b = batches(t).join(state.updates(t.entries).select("contract_id", "state_change_type"), "contract_id", "left")
    # Batches 0 to 2 are made to look empty, so the guard has something to do.
    return b.select("batch_id", "contract_id", ((F.col("batch_id") < 3) | F.col("state_change_type").isNull()).alias("is_missing"))


def gap_rows(t: Tables) -> DataFrame:
    return gaps.coverage_gaps(t.ledgers).select("from_ledger", "to_ledger", F.lit(fn.GAP_REASON).alias("reason"), stamp().alias("detected_at"))


def flat(df: DataFrame) -> DataFrame:
    """Times as Unix seconds, for comparison."""
    return df.select(*[F.unix_seconds(c).alias(c) if k == "timestamp" else F.col(c) for c, k in df.dtypes])


# -- sources --
@query
def scan_range(t):
    return readers.scan_range(t.ledgers, 1000, 2000).select("ledger_seq", "ledger_hash")


@query
def resolve_start(t):
    r = t.ledgers.select(F.when(F.col("ledger_seq") % 3 == 0, F.col("ledger_seq")).alias("cursor"), F.when(F.col("ledger_seq") % 2 == 0, F.col("ledger_seq")).otherwise(0).cast("long").alias("start"))
    return gaps.resolve_start(t.ledgers, r)


def clamp_requests(t):
    n = F.col("ledger_seq")
    return t.ledgers.select(n.alias("start"), F.when(n % 11 == 0, 9000).otherwise(2000).cast("long").alias("oldest"), F.lit(7000).cast("long").alias("latest"))


@query
def clamp_start(t):
    return gaps.clamp_start(clamp_requests(t))


@query
def require_full_range(t):
    return gaps.require_full_range(t.ledgers, 100, 8000).select("ledger_seq")


@query
def coalesce_sources(t):
    return gaps.coalesce_sources(t.sources, "testnet").select("ledger_seq", "priority", "ledger_hash")


@query
def source_cover(t):
    return gaps.source_cover(gaps.source_windows(t.sources, "testnet"))


@query
def covered_ledgers(t):
    """Ledgers by the cover of the sources' windows, which is known before they are read."""
    cover = gaps.source_cover(gaps.source_windows(t.sources, "testnet"), 2000, 8000)
    read = lambda priority, first, last: readers.scan_range(t.sources.where((F.col("priority") == priority) & (F.col("network") == "testnet")), first, last)
    found = gaps.read_cover(cover, read)
    return (t.sources.limit(0) if found is None else found).select("ledger_seq", "priority", "ledger_hash")


@query
def read_seed_list(t):
    lines = t.ev.select(F.when(F.col("k") < 30, F.concat(F.lit("# "), "uid")).when(F.col("k") < 40, F.lit("  ")).otherwise(F.concat(F.lit(" "), "uid", F.lit(" "))).alias("value"))
    return readers.seed_list(lines)


@query
def load_state(t):
    s = t.ev.groupBy((F.col("user_id") % 5).alias("g")).agg(F.collect_set("uid").alias("escrow_contracts"), F.collect_set(F.when(F.col("k") < 3, F.col("uid"))).alias("removed_contracts"))
    return watchlist.watchlist_now(watchlist.watchlist_fold(readers.state_ops(s)))


@query
def replay_watchlist(t):
    return readers.replay_watchlist(ops_log(t), 4000)


@query
def entry_lookup(t):
    return state.entry_lookup(t.ev.select(F.col("uid").alias("contract_id")), t.entries).select("contract_id", "pos", "key_kind", "last_modified_ledger")


# -- sinks --
@query
def sink_topic(t):
    return envelope.messages(envelopes(t))


@query
def split_valid(t):
    e = envelopes(t).withColumn("tx_hash", F.when(F.col("event_index") > 0, F.col("tx_hash")).otherwise(F.when(F.col("ledger_seq") % 5 == 0, F.lit("")).otherwise(F.col("tx_hash"))))
    good, bad = envelope.split_valid(e)
    return good.select("message_id", F.lit("").alias("reason")).union(bad.select("message_id", "reject_reason"))


@query
def route(t):
    return routing.route(envelope.messages(envelopes(t)), t.bindings).select("message_id", "queue")


@query
def unroutable(t):
    return routing.unroutable(envelope.messages(envelopes(t)), t.bindings.where("queue = 'one'")).select("message_id", "topic_key")


# -- projections and predicates --
@query
def instance_filter(t):
    c = t.instance_changes.withColumn("post_present", F.col("log_seq") % 3 != 0).withColumn("executable_type", F.when(F.col("log_seq") % 5 == 0, "asset").otherwise(F.col("executable_type")))
    return watchlist.instance_filter(c).select("contract_id", "ledger_seq", "log_seq")


@query
def first_topic_symbol(t):
    return t.raw_events.select("raw_xdr", fn.first_topic_symbol().alias("symbol"))


@query
def transfer_shape(t):
    return t.raw_events.select("raw_xdr", fn.transfer_recipient().alias("recipient")).where("recipient is not null")


@query
def event_envelope(t):
    return flat(envelopes(t)).select("schema_version", "type", "network", "contract_id", "ledger_seq", "ledger_closed_at", "tx_hash", "tx_index", "event_kind", "event_index", "raw_xdr", "message_id", "published_at")


@query
def state_envelope(t):
    return flat(envelope.state_envelope(states(t), "testnet", stamp())).select("type", "contract_id", "ledger_seq", "state_change_type", "raw_xdr", "message_id", "published_at")


@query
def gap_envelope(t):
    return flat(envelope.gap_envelope(gap_rows(t), "testnet", stamp())).select("type", "ledger_seq", "raw_xdr", "message_id", "control_kind", "gap_from_ledger", "gap_to_ledger", "gap_reason", "gap_detected_at")


@query
def routing_key(t):
    e = envelope.union_facts(envelopes(t), envelope.state_envelope(states(t), "testnet", stamp()), envelope.gap_envelope(gap_rows(t), "testnet", stamp()))
    return e.select("message_id", fn.routing_key().alias("topic_key"))


@query
def wire_json(t):
    return envelopes(t).select("message_id", envelope.wire_json().alias("value"))


@query
def validate_envelope(t):
    n = F.col("tx_index") + F.col("ledger_seq")
    e = envelopes(t).withColumn("raw_xdr", F.when(n % 5 == 0, F.lit("")).otherwise(F.col("raw_xdr"))).withColumn("event_kind", F.when(n % 7 == 0, F.lit(None)).otherwise(F.col("event_kind"))).withColumn("type", F.when(n % 11 == 0, F.lit("other")).otherwise(F.col("type")))
    return e.select("message_id", fn.envelope_problem().alias("reason"))


@query
def filter_unchanged(t):
    return state.filter_unchanged(states(t), 6000).select("contract_id", "state_change_type", "last_modified_ledger")


def odd_commands(t):
    k = F.col("k")
    kind = F.when(k < 20, "track_escrow").when(k < 40, "reseed").when(k < 60, "pause").when(k < 80, "resume").otherwise("dance")
    return t.ev.where("event_type = 'error'").select(F.col("event_id").alias("cmd_seq"), kind.alias("command"), F.when(k % 2 == 0, F.col("uid")).otherwise("").alias("contract_id"), F.when(k % 3 == 0, F.array("uid")).alias("contract_ids"), ((k - 45) * 300).alias("ttl_seconds"))


@query
def validate_command(t):
    return control.validate_command(odd_commands(t)).select("cmd_seq", "command", "reject_reason")


@query
def pause_ttl(t):
    return odd_commands(t).select("cmd_seq", fn.pause_ttl().alias("ttl"))


@query
def classify_fetch_errors(t):
    return ops.classify_fetch_errors(t.fetch_log).select("event_id", "class")


@query
def approved_hashes(t):
    h = t.ev.select(F.when(F.col("k") < 10, F.lit("zz")).when(F.col("k") < 20, F.lit("  ")).otherwise(F.concat(F.lit(" "), F.upper(F.repeat(F.md5((F.col("k") % 4).cast("string").cast("binary")), 2)))).alias("wasm_hash"))
    return watchlist.approved_hashes(h)


@query
def address_shape(t):
    text = F.concat(F.when(F.col("k") < 40, "C").when(F.col("k") < 80, "G").otherwise("X"), F.lpad(F.upper(F.translate(F.col("uid"), "01890", "ABCDE")), 55, "A"))
    return t.ev.select("event_id", fn.address_shape(text).alias("shape"))


@query
def sanitize_text(t):
    return t.ev.select("event_id", F.concat(F.col("event_type").cast("binary"), F.unhex(F.lit("00FFFE41"))).alias("raw")).select("event_id", fn.sanitize_text("raw").alias("text"))


@query
def url_host(t):
    u = t.ev.select("event_id", F.concat(F.lit("https://user"), F.when(F.col("k") < 50, F.lit(":pw")).otherwise(""), F.lit("@host"), "uid", F.lit(".example.org/p")).alias("url"))
    return u.select("event_id", fn.url_host("url").alias("host"), fn.redact_url("url").alias("redacted"))


@query
def tip_mode(t):
    return ops.tip_mode(t.progress).select("ledger_seq", "age_s", "catching_up", "sweep_eligible")


# -- joins --
@query
def discover(t):
    return watchlist.discover(t.instance_changes, watchlist.approved_hashes(t.approved))


@query
def asof_watchlist(t):
    return asof.tracked_at(t.raw_events, held_intervals(t), "emitter").select("raw_xdr", "is_tracked")


@query
def detect_events(t):
    return detect.detect_events(t.raw_events, held_intervals(t)).select("emitter", "tx_hash", "event_index", "ledger_seq")


@query
def detect_deposits(t):
    return detect.detect_deposits(t.raw_events, held_intervals(t)).select("contract_id", "tx_hash", "event_index", "ledger_seq")


@query
def detect_facts(t):
    return flat(facts(t))


@query
def known_entries(t):
    return state.known_entries(t.entries, tracked_now(t)).select("contract_id", "pos")


@query
def missing_from(t):
    return state.missing_from(tracked_now(t), changes(t))


@query
def append_removed(t):
    return state.append_removed(tracked_now(t), changes(t))


@query
def guarded_states(t):
    c = state.updates(t.entries).where(F.col("contract_id").cast("long") % 7 >= 3)
    return state.guarded_states(batches(t), c).select("batch_id", "contract_id", "state_change_type", "last_modified_ledger")


@query
def chain_continuity(t):
    cursor = t.ledgers.agg(F.min("ledger_seq").alias("n")).select("n").first()[0]
    return gaps.chain_continuity(t.ledgers, cursor or 0, "0")


@query
def refresh_targets(t):
    c = t.ev.where("event_type = 'error' and k < 30").select(F.col("event_id").alias("cmd_seq"), F.when(F.col("k") < 10, "track_escrow").when(F.col("k") < 20, "refresh_escrow").otherwise("reseed").alias("command"), F.col("uid").alias("contract_id"), F.array("uid", F.col("k").cast("string")).alias("contract_ids"))
    return control.refresh_targets(c, watchlist.watchlist_now(fold(t)))


# -- aggregations --
@query
def active_entities(t):
    return detect.active_entities(facts(t))


@query
def ledger_progress(t):
    return ops.ledger_progress(t.ledgers, facts(t), states(t), held_intervals(t), gap_rows(t))


def status_row(t):
    counts = facts(t).agg(F.count("*").alias("events")).crossJoin(states(t).agg(F.count("*").alias("states"))).crossJoin(tracked_now(t).agg(F.count("*").alias("tracked"))).crossJoin(gap_rows(t).agg(F.count("*").alias("gaps"))).crossJoin(state.suppressed_total(state.removal_guard(missing_rows(t))))
    return ops.status(t.progress, counts, NOW_S, started_s=NOW_S - 3600, pauses=control.pause_intervals(t.commands))


@query
def status(t):
    return status_row(t)


@query
def removal_guard(t):
    return state.removal_guard(missing_rows(t))


@query
def suppressed_total(t):
    return state.suppressed_total(state.removal_guard(missing_rows(t)))


@query
def fetch_quantiles(t):
    q = ops.fetch_quantiles(t.fetch_log)
    return q.select("end_s", *[F.round(c, 6).alias(c) for c in ("p50", "p90", "p99")], "n")


@query
def fetch_quantile_panes(t):
    """Sketched quantiles of each window, as whether their ranks are within 3 % of what they stand for."""
    found = ops.fetch_quantiles(t.fetch_log, exact=False)
    rows = t.fetch_log.where("ok").select(F.explode(F.sequence(F.lit(1), F.lit(10))).alias("i"), (F.unix_seconds("ts") - F.unix_seconds("ts") % 60).alias("m"), "duration_s").select((F.col("m") + 60 * F.col("i")).alias("end_s"), "duration_s")
    of = {q: f"p{round(q * 100)}" for q in ops.QUANTILES}
    # A value's rank is anything from what is below it to what is at most it.
    ranks = [f(F.col("duration_s") < F.col(p)).alias(f"{p}_below") for p in of.values() for f in (F.count_if,)] + [F.count_if(F.col("duration_s") <= F.col(p)).alias(f"{p}_upto") for p in of.values()]
    held = found.join(rows, "end_s").groupBy("end_s", "n").agg(F.count("*").alias("rows"), *ranks)
    near = [(F.col(f"{p}_below") <= (q + 0.03) * F.col("n") + 1) & (F.col(f"{p}_upto") >= (q - 0.03) * F.col("n") - 1) for q, p in of.items()]
    return held.select("end_s", "n", (near[0] & near[1] & near[2] & (F.col("rows") == F.col("n"))).alias("near"))


@query
def rotation_batch(t):
    """The rotation's next 25 ids behind an id."""
    return state.next_ids(tracked_now(t), "120", 25)


@query
def watchlist_size(t):
    return watchlist.watchlist_size(intervals(t))


@query
def event_kind_counts(t):
    return envelope.event_kind_counts(envelopes(t))


@query
def metrics_long(t):
    return ops.metrics_long(status_row(t), "testnet")


# -- windows --
@query
def watchlist_fold(t):
    return fold(t).select("contract_id", "effective", "op", "log_seq", "status")


@query
def watchlist_now(t):
    return watchlist.watchlist_now(fold(t))


@query
def watchlist_intervals(t):
    return intervals(t)


@query
def event_index(t):
    return detect.event_index(t.raw_events).select("raw_xdr", "tx_hash", "tx_index", "event_index")


@query
def pick_state_entry(t):
    return state.pick_state_entry(t.entries).select("contract_id", "is_data", "pos", "raw_xdr")


@query
def continuity_breaks(t):
    return gaps.continuity_breaks(t.ledgers)


@query
def history_view(t):
    e = envelopes(t).select("message_id", "type", "contract_id", "published_at")
    return flat(envelope.history_view(e.unionByName(e.withColumn("published_at", F.timestamp_seconds(F.lit(NOW_S + 60))))))


def many_states(t):
    e = t.ev.where("event_type in ('view', 'click')")
    return e.select(F.col("uid").alias("contract_id"), F.when(F.col("k") < 5, "removed").otherwise("updated").alias("state_change_type"), "ledger_seq", F.timestamp_seconds(F.col("event_id")).alias("published_at"))


@query
def state_view(t):
    return flat(state.state_view(many_states(t)))


def tip_ledgers(t):
    return ops.tip_mode(t.progress).select("ledger_seq", (~F.col("catching_up")).alias("at_tip"))


@query
def deferred_flush(t):
    return state.deferred_flush(detect.active_entities(facts(t)), tip_ledgers(t))


@query
def sweep_batches(t):
    return state.sweep_batches(tracked_now(t), 20)


@query
def pass_anchor(t):
    p = t.ledgers.where("ledger_seq % 50 = 0").select((F.col("ledger_seq") / 50).cast("long").alias("pass_no"), F.col("ledger_seq").alias("start_ledger"), (F.col("ledger_seq") % 400 == 0).alias("is_reset"))
    return state.pass_anchor(p)


@query
def stall_windows(t):
    return ops.stall_windows(t.progress, 1800)


@query
def pause_intervals(t):
    return control.pause_intervals(t.commands)


# -- sorts, sets --
@query
def ordered_history(t):
    return detect.ordered_history(facts(t)).select("ledger_seq", "tx_index", "event_index", "contract_id")


@query
def sorted_states(t):
    return states(t).orderBy("contract_id").select("contract_id", "state_change_type")


@query
def next_batch(t):
    return state.next_batch(tracked_now(t), 10, 25)


@query
def union_facts(t):
    e = envelope.union_facts(envelopes(t), envelope.state_envelope(states(t), "testnet", stamp()), envelope.gap_envelope(gap_rows(t), "testnet", stamp()))
    return e.select("type", "message_id", "ledger_seq")


@query
def pending_union(t):
    return state.pending_union(t.entries, facts(t))


@query
def watchlist_minus(t):
    gone = watchlist.watchlist_now(fold(t)).where("status = 'tombstoned'")
    return watchlist.watchlist_minus(t.entries, gone)


@query
def replay_merge(t):
    e = envelopes(t).select("message_id", "ledger_seq", "published_at")
    return flat(envelope.replay_merge(e.where("ledger_seq between 2000 and 5000").withColumn("published_at", F.timestamp_seconds(F.lit(NOW_S + 60))), e.where("ledger_seq >= 3000")))


@query
def gap_republish(t):
    g = envelope.gap_envelope(gap_rows(t), "testnet", stamp()).select("message_id", "ledger_seq", "published_at")
    return flat(envelope.history_view(g.unionByName(g.withColumn("published_at", F.timestamp_seconds(F.lit(NOW_S + 60))))))


# -- runs: the batch forms of the streaming operators --
@query
def run_backfill(t):
    return flat(live.run_backfill(t.raw_events, ops_log(t), 2000, 5000, "testnet", stamp())).select("message_id", "type", "contract_id", "ledger_seq")


@query
def run_replay(t):
    return flat(live.run_replay(t.raw_events, t.ledgers, readers.replay_watchlist(ops_log(t), 4000), 100, 8000, "testnet", stamp())).select("message_id", "type", "contract_id", "ledger_seq")


@query
def gap_detect(t):
    return flat(gaps.as_gaps(gaps.clamp_start(clamp_requests(t)), stamp()))


@query
def tip_states(t):
    """States a run publishes at ledgers at the tip: of contracts active since the tip ledger before, guarded."""
    flushed = state.deferred_flush(detect.active_entities(facts(t)), tip_ledgers(t)).join(tracked_now(t), "contract_id", "left_semi")
    wanted = flushed.select(F.col("flush_ledger").alias("batch_id"), "contract_id")
    return state.guarded_states(wanted, changes(t)).select(F.col("batch_id").alias("ledger_seq"), "contract_id", "state_change_type", "last_modified_ledger")


@query
def coverage_gaps(t):
    return gaps.coverage_gaps(t.ledgers)


@query
def remaining_gaps(t):
    g = t.ledgers.where("ledger_seq % 100 = 0").select(F.col("ledger_seq").alias("from_ledger"), (F.col("ledger_seq") + 49).alias("to_ledger"))
    return gaps.remaining_gaps(g, t.ledgers)
