"""Which contracts are tracked, at each ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordered import Ordered


def approved_hashes(df: DataFrame, c: str = "wasm_hash") -> DataFrame:
    """Trimmed, lower-cased distinct hashes; blanks are skipped, malformed ones left to ``rejected_hashes``."""
    h = F.lower(F.trim(c))
    return df.select(h.alias(c)).where(F.col(c).rlike("^[0-9a-f]{64}$")).distinct()


def rejected_hashes(df: DataFrame, c: str = "wasm_hash") -> DataFrame:
    return df.where((F.trim(c) != "") & ~F.lower(F.trim(c)).rlike("^[0-9a-f]{64}$"))


def instance_filter(changes: DataFrame) -> DataFrame:
    """Instance entries of contract data that are present afterwards and run a Wasm."""
    return changes.where("entry_type = 'contract_data' and key_type = 'instance' and post_present and executable_type = 'wasm' and contract_id <> ''")


def discover(changes: DataFrame, approved: DataFrame) -> DataFrame:
    """First ledger at which each contract ran an approved Wasm: ``contract_id, ledger_seq, log_seq``.

    Tombstones are left to the fold, which knows them at each ledger.
    """
    found = instance_filter(changes).withColumn("wasm_hash", F.lower("wasm_hash")).join(approved, "wasm_hash", "left_semi")
    return found.groupBy("contract_id").agg(F.min(F.struct("ledger_seq", "log_seq")).alias("f")).select("contract_id", "f.*")


def command_ops(commands: DataFrame) -> DataFrame:
    """Tracking commands as operations; they take effect at the ledger after the one they were drained at. A reseed's ids
    are seeds from that ledger on, so tombstones hold against them."""
    op = F.when(F.col("command") == "track_escrow", "track").when(F.col("command") == "remove_escrow", "remove")
    one = commands.select("contract_id", op.alias("op"), F.col("after_ledger").alias("ledger_seq"), F.col("cmd_seq").alias("log_seq")).where("op is not null")
    many = commands.where("command = 'reseed'").select(F.explode("contract_ids").alias("contract_id"), F.lit("seed").alias("op"), (F.col("after_ledger") + 1).alias("ledger_seq"), F.col("cmd_seq").alias("log_seq"))
    return one.unionByName(many.where("contract_id <> ''"))


def watchlist_fold(ops: DataFrame) -> DataFrame:
    """``ops (contract_id, op, ledger_seq, log_seq)`` with ``effective`` ledger and ``status`` after each operation.

    discover and seed add only an untracked contract, track always adds, remove and seed_removed tombstone. Commands
    count from the next ledger on, and before discoveries of that ledger.
    """
    command = F.col("op").isin("track", "remove")
    keyed = ops.withColumn("effective", F.when(command, F.col("ledger_seq") + 1).otherwise(F.col("ledger_seq"))).withColumn("late", F.when(command, 0).otherwise(1))
    w = Window.partitionBy("contract_id").orderBy("effective", "late", "log_seq").rowsBetween(Window.unboundedPreceding, 0)
    last = F.last(F.when(F.col("op").isin("track", "remove", "seed_removed"), F.col("op")), True).over(w)
    added = F.max(F.col("op").isin("discover", "seed")).over(w)
    status = F.when(last == "track", "tracked").when(last.isNotNull(), "tombstoned").when(added, "tracked").otherwise("untracked")
    return keyed.withColumn("status", status)


def compact_ops(ops: DataFrame, upto: int) -> DataFrame:
    """The operations that decide what is tracked after ledger ``upto``: of those in effect by then, each contract's last that tracks or
    removes whatever was before, and its first discovery or seed; all later ones."""
    command, strong = F.col("op").isin("track", "remove"), F.col("op").isin("track", "remove", "seed_removed")
    effective = F.when(command, F.col("ledger_seq") + 1).otherwise(F.col("ledger_seq"))
    place, row = F.struct(effective, F.when(command, 0).otherwise(1), F.col("log_seq")), F.struct("op", "ledger_seq", "log_seq")
    past = ops.where(effective <= upto).groupBy("contract_id").agg(F.max_by(F.when(strong, row), F.when(strong, place)).alias("a"), F.min_by(F.when(~strong, row), F.when(~strong, place)).alias("b"))
    kept = past.select("contract_id", F.explode(F.array_compact(F.array("a", "b"))).alias("o")).select("contract_id", "o.*")
    return kept.unionByName(ops.where(effective > upto).select("contract_id", "op", "ledger_seq", "log_seq"))


def new_discoveries(found: DataFrame, ops: DataFrame) -> DataFrame:
    """Discoveries that change something: a contract that ``ops`` discovers or seeds already stays as it is, tracked or not."""
    return found.join(ops.where(F.col("op").isin("discover", "seed")).select("contract_id").distinct(), "contract_id", "left_anti")


def watchlist_now(fold: DataFrame) -> DataFrame:
    """The last status of each contract."""
    return fold.groupBy("contract_id").agg(F.max_by("status", F.struct("effective", "late", "log_seq")).alias("status"))


def watchlist_intervals(fold: DataFrame) -> DataFrame:
    """``contract_id, from_ledger, to_ledger``: tracked from the first, inclusive, to the second, exclusive (null: still)."""
    last = fold.groupBy("contract_id", "effective").agg(F.max_by("status", F.struct("late", "log_seq")).alias("status"))
    w = Window.partitionBy("contract_id").orderBy("effective")
    tracked = last.withColumn("on", F.col("status") == "tracked").withColumn("was", F.lag("on").over(w))
    turns = tracked.where("was is null or was <> on").withColumn("to_ledger", F.lead("effective").over(w))
    return turns.where("on").select("contract_id", F.col("effective").alias("from_ledger"), "to_ledger")


def watchlist_size(intervals: DataFrame) -> DataFrame:
    """Tracked contracts from each ledger on at which their number changes."""
    turns = intervals.select(F.col("from_ledger").alias("ledger_seq"), F.lit(1).alias("d")).union(intervals.where("to_ledger is not null").select("to_ledger", F.lit(-1)))
    return Ordered(turns.groupBy("ledger_seq").agg(F.sum("d").alias("d")), "ledger_seq").running(tracked=F.col("d")).select("ledger_seq", "tracked")


def watchlist_minus(seeds: DataFrame, tombstones: DataFrame) -> DataFrame:
    return seeds.select("contract_id").distinct().join(tombstones, "contract_id", "left_anti")
