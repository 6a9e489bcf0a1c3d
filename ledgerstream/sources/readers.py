"""Scans of stored ledgers, seed lists and saved state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import MAX_UINT32

STATE = "network string, last_ledger long, escrow_contracts array<string>, removed_contracts array<string>, gaps array<struct<from_ledger:long,to_ledger:long,reason:string,detected_at:timestamp>>"


def valid_range(first: int, last: int, bounded: bool = True) -> None:
    """Raises unless the range is one of ledgers; ``last`` 0 means unbounded where that is allowed."""
    if not (0 < first <= MAX_UINT32 and (0 < last <= MAX_UINT32 or not bounded and last == 0)) or last and first > last:
        raise ValueError(f"[{first}, {last}] is not a range of ledgers")


def scan_range(ledgers: DataFrame, first: int, last: int) -> DataFrame:
    """Both ends inclusive. Written with a ``ledger_bucket`` partition, whole buckets are pruned as well."""
    out = ledgers.where(F.col("ledger_seq").between(first, last))
    return out.where(F.col("ledger_bucket").between(first // 10_000, last // 10_000)) if "ledger_bucket" in ledgers.columns else out


def tail_ledgers(spark: SparkSession, path: str, schema, files_per_batch: int = 100) -> DataFrame:
    """An unbounded stream of landed files, each holding whole ledgers; 1 to 200 files a batch."""
    if not 1 <= files_per_batch <= 200:
        raise ValueError("files_per_batch must be 1 to 200")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def seed_list(lines: DataFrame) -> DataFrame:
    """Ids of lines (``value``): trimmed, blank ones and comments skipped."""
    return lines.select(F.trim("value").alias("contract_id")).where("contract_id <> '' and not startswith(contract_id, '#')")


def read_seed_list(spark: SparkSession, path: str) -> DataFrame:
    return seed_list(spark.read.text(path)) if path else spark.createDataFrame([], "contract_id string")


def load_state(spark: SparkSession, path: str, network: str, watchlist_path: str | None = None) -> DataFrame:
    """One row of saved state; older layouts have empty fields, another network's state or a corrupt file raises.

    In the split layout the lists and gaps are a record of their own at ``watchlist_path``, which then counts alone.
    """
    read = lambda p: spark.read.schema(STATE).option("mode", "FAILFAST").option("multiLine", True).json(p)
    s = read(path)
    if watchlist_path is not None:
        lists = read(watchlist_path).select("escrow_contracts", "removed_contracts", "gaps")
        s = s.select("network", "last_ledger").crossJoin(F.broadcast(lists))  # one row each
    checked = F.when(F.col("network") == network, F.col("network")).otherwise(F.raise_error(F.lit("the state is of another network")))
    empty = lambda c: F.coalesce(F.col(c), F.array()).alias(c)
    return s.select(checked.alias("network"), "last_ledger", empty("escrow_contracts"), empty("removed_contracts"), F.coalesce("gaps", F.array().cast(s.schema["gaps"].dataType)).alias("gaps"))


def state_ops(state: DataFrame) -> DataFrame:
    """A saved state as operations at ledger 0, tombstones first, so that they beat the lists."""
    one = lambda c, op, n: state.select(F.explode(c).alias("contract_id"), F.lit(op).alias("op"), F.lit(0).cast("long").alias("ledger_seq"), F.lit(n).cast("long").alias("log_seq"))
    return one("removed_contracts", "seed_removed", 0).union(one("escrow_contracts", "seed", 1))


def replay_watchlist(ops: DataFrame, at_ledger: int) -> DataFrame:
    """Status of each contract by the operations up to a ledger, for a replay that writes nothing."""
    from ..operators.watchlist import watchlist_fold, watchlist_now

    return watchlist_now(watchlist_fold(ops).where(F.col("effective") <= at_ledger))
