"""Snapshots of state entries: picking, absence, and the guard against implausible mass removals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import Ordered

KEYS = ("vec/persistent", "symbol/persistent", "vec/temporary", "instance/persistent")


def entry_lookup(ids: DataFrame, entries: DataFrame) -> DataFrame:
    """Candidate entries of each requested id; ids without one stay, with nulls. Empty ids can't form a key and go."""
    wanted = ids.where("contract_id is not null and contract_id <> ''").select("contract_id").distinct()
    return wanted.join(entries.where(F.col("key_kind").isin(*KEYS)), "contract_id", "left")


def pick_state_entry(entries: DataFrame) -> DataFrame:
    """One entry per contract: the first dedicated one, else the last instance one."""
    best = F.struct(F.col("is_data").cast("int"), F.when(F.col("is_data"), -F.col("pos")).otherwise(F.col("pos")))
    cols = [c for c in entries.columns if c != "contract_id"]
    return entries.groupBy("contract_id").agg(F.max_by(F.struct(*cols), best).alias("e")).select("contract_id", "e.*")


def updates(entries: DataFrame) -> DataFrame:
    return pick_state_entry(entries).select("contract_id", F.lit("updated").alias("state_change_type"), "raw_xdr", "last_modified_ledger")


def known_entries(entries: DataFrame, tracked: DataFrame) -> DataFrame:
    return entries.join(tracked.select("contract_id").distinct(), "contract_id", "left_semi")


def missing_from(requested: DataFrame, changes: DataFrame) -> DataFrame:
    return requested.select("contract_id").distinct().join(changes, "contract_id", "left_anti")


def append_removed(requested: DataFrame, changes: DataFrame) -> DataFrame:
    gone = missing_from(requested, changes).select("contract_id", F.lit("removed").alias("state_change_type"), F.lit("").alias("raw_xdr"), F.lit(0).cast("long").alias("last_modified_ledger"))
    return changes.unionByName(gone)


def implausible(requested: str = "requested", missing: str = "missing", least: int = 10) -> Column:
    """More than half of ten or more requested ids are missing."""
    return (F.col(requested) >= least) & (2 * F.col(missing) > F.col(requested))


def removal_guard(batches: DataFrame) -> DataFrame:
    """``batch_id, requested, missing, is_implausible`` from rows ``batch_id, contract_id, is_missing``."""
    return batches.groupBy("batch_id").agg(F.count("*").alias("requested"), F.sum(F.col("is_missing").cast("long")).alias("missing")).withColumn("is_implausible", implausible())


def suppressed_total(guard: DataFrame) -> DataFrame:
    return guard.agg(F.coalesce(F.sum(F.when(F.col("is_implausible"), F.col("missing"))), F.lit(0)).alias("suppressed"))


def filter_unchanged(states: DataFrame, since: int | Column = 0) -> DataFrame:
    s = since if isinstance(since, Column) else F.lit(since)
    return states.where((F.col("state_change_type") == "removed") | (s == 0) | (F.col("last_modified_ledger") >= s))


def judged(requested: DataFrame, changes: DataFrame) -> DataFrame:
    """Requested ids (``batch_id, contract_id``) with their changes, and whether their batch's missing ones are implausible."""
    rows = requested.select("batch_id", "contract_id").distinct().join(changes, "contract_id", "left")
    guard = removal_guard(rows.select("batch_id", "contract_id", F.col("state_change_type").isNull().alias("is_missing")))
    return rows.join(guard.select("batch_id", "is_implausible"), "batch_id")


def plausible_states(rows: DataFrame) -> DataFrame:
    """States of ``judged`` rows: updates, and removals of plausible batches."""
    kept = rows.where("state_change_type is not null or not is_implausible").drop("is_implausible")
    return kept.withColumn("last_modified_ledger", F.coalesce("last_modified_ledger", F.lit(0))).withColumn("raw_xdr", F.coalesce("raw_xdr", F.lit(""))).withColumn("state_change_type", F.coalesce("state_change_type", F.lit("removed")))


def guarded_states(requested: DataFrame, changes: DataFrame, since: int = 0) -> DataFrame:
    """States of batches of requested ids (``batch_id, contract_id``): updates, and removals of plausible batches."""
    return filter_unchanged(plausible_states(judged(requested, changes)), since)


def numbered(ids: DataFrame, c: str = "contract_id") -> DataFrame:
    """``ids`` with ``rn``, the place from 1 in sort order, by ranges of ids."""
    return Ordered(ids.select(c).distinct(), c).running(rn=F.lit(1))


def sweep_batches(ids: DataFrame, size: int) -> DataFrame:
    """The rotation over sorted ids in batches, and whether a batch completes a pass."""
    rows = numbered(ids)
    total = rows.agg(F.max("rn").alias("total"))
    return rows.crossJoin(F.broadcast(total)).select("contract_id", F.floor((F.col("rn") - 1) / size).alias("batch_id"), (F.floor((F.col("rn") - 1) / size) == F.floor((F.col("total") - 1) / size)).alias("completes_pass"))


def next_batch(ids: DataFrame, position: int, size: int) -> DataFrame:
    """The batch behind a place in the rotation. It numbers all ids; a running job goes by ``rotate``."""
    return numbered(ids).where(F.col("rn") > position).orderBy("rn").limit(max(1, size))


def next_ids(ids: DataFrame, after: str | None, size: int) -> DataFrame:
    """The next ``size`` ids of the rotation in sort order, those behind ``after`` (None: from the first); one at least where there is any.

    A top-k over a filter: every task keeps ``size`` ids, nothing is numbered, and files sorted by id are skipped below ``after``.
    """
    behind = ids if after is None else ids.where(F.col("contract_id") > after)
    return behind.select("contract_id").distinct().orderBy("contract_id").limit(max(1, size))


def rotate(ids: DataFrame, after: str | None, size: int) -> tuple[list[str], str | None]:
    """The rotation's next batch, and where the one after it goes on: None where this one completes the pass."""
    found = [r[0] for r in next_ids(ids, after, max(1, size) + 1).collect()]
    if not found and after is not None:  # what was behind has gone meanwhile: the next pass begins
        found = [r[0] for r in next_ids(ids, None, max(1, size) + 1).collect()]
    batch = found[: max(1, size)]
    return batch, batch[-1] if len(found) > len(batch) else None


def pass_anchor(passes: DataFrame) -> DataFrame:
    """``modified_since`` of each pass (``pass_no, start_ledger, is_reset``): the previous pass's start, 0 at the first and after a reset."""
    rows = Ordered(passes, "pass_no").neighbour("before", "start_ledger", behind=False)
    return rows.select("pass_no", "start_ledger", F.when(F.col("is_reset") | F.col("before").isNull(), 0).otherwise(F.col("before.start_ledger")).cast("long").alias("modified_since"))


def deferred_flush(active: DataFrame, ledgers: DataFrame) -> DataFrame:
    """Each active id once at the next ledger at the tip (``ledgers (ledger_seq, at_tip)``), where there is one.

    Ledgers look for theirs in ranges, and ids are joined to them.
    """
    flush = Ordered(ledgers.select("ledger_seq", "at_tip"), "ledger_seq").nearest("flush_ledger", F.when(F.col("at_tip"), F.col("ledger_seq")))
    return active.join(flush.where("flush_ledger is not null").select("ledger_seq", "flush_ledger"), "ledger_seq").select("contract_id", "flush_ledger").distinct()


def pending_union(held: DataFrame, active: DataFrame) -> DataFrame:
    return held.select("contract_id").union(active.select("contract_id")).distinct()


def state_view(states: DataFrame) -> DataFrame:
    """The latest state of each contract, removals included."""
    cols = [c for c in states.columns if c != "contract_id"]
    return states.groupBy("contract_id").agg(F.max_by(F.struct(*cols), F.struct("ledger_seq", "published_at")).alias("s")).select("contract_id", "s.*")
