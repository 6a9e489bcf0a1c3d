"""Start ledgers, skipped ranges and chain continuity."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import GAP_REASON
from .ordered import Ordered


def window_of(ledgers: DataFrame) -> DataFrame:
    return ledgers.agg(F.min("ledger_seq").alias("oldest"), F.max("ledger_seq").alias("latest"))


def resolve_start(ledgers: DataFrame, requests: DataFrame) -> DataFrame:
    """``requests (cursor, start)`` with ``resolved``: the ledger after the cursor, else the start, else the tip."""
    return requests.crossJoin(F.broadcast(window_of(ledgers))).select("cursor", "start", F.coalesce(F.col("cursor") + 1, F.nullif("start", F.lit(0).cast("long")), "latest").alias("resolved"))


def clamp_start(requests: DataFrame, slack: int = 60) -> DataFrame:
    """``requests (start, oldest, latest)`` with ``outcome, resolved, gap_from, gap_to, reason``."""
    outcome = F.when(F.col("oldest") > F.col("latest"), "inverted").when(F.col("start") > F.col("latest") + slack, "beyond_tip").when(F.col("start") < F.col("oldest"), "clamped").otherwise("ok")
    cut = F.col("outcome") == "clamped"
    return requests.withColumn("outcome", outcome).select("start", "oldest", "latest", "outcome", F.when(cut, F.col("oldest")).when(F.col("outcome") == "ok", F.col("start")).alias("resolved"), F.when(cut, F.col("start")).alias("gap_from"), F.when(cut, F.col("oldest") - 1).alias("gap_to"), F.when(cut, F.lit(GAP_REASON)).alias("reason"))


def require_full_range(ledgers: DataFrame, first: int, last: int) -> DataFrame:
    """The ledgers of a range, or none if the source's window doesn't hold all of it."""
    ok = window_of(ledgers).where((F.col("oldest") <= first) & (F.col("latest") >= last)).select(F.lit(True).alias("ok"))
    return ledgers.where(F.col("ledger_seq").between(first, last)).join(F.broadcast(ok)).drop("ok")


def coalesce_sources(ledgers: DataFrame, network: str, mode: str = "best") -> DataFrame:
    """Each ledger from the source of least ``priority`` that serves it; sources of another network are ignored.

    ``mode="first_source"``: only the first source that serves anything counts.
    """
    own = ledgers.where(F.col("network") == network)
    if mode == "first_source":
        return own.join(F.broadcast(own.agg(F.min("priority").alias("priority"))), "priority", "left_semi")
    cols = [c for c in own.columns if c != "ledger_seq"]
    return own.groupBy("ledger_seq").agg(F.min_by(F.struct(*cols), "priority").alias("l")).select("ledger_seq", "l.*")


def source_windows(ledgers: DataFrame, network: str) -> DataFrame:
    """``priority, oldest, latest`` of each source of the network."""
    return ledgers.where(F.col("network") == network).groupBy("priority").agg(F.min("ledger_seq").alias("oldest"), F.max("ledger_seq").alias("latest"))


def source_cover(windows: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """``from_ledger, to_ledger, priority``: disjoint ranges of ledgers, each with the best source whose window (``priority, oldest, latest``) holds all of it.

    Known before any ledger is read. A sweep over the windows' ends: between two neighbouring ends the same sources serve; ranges of one
    source that touch are one. Inverted windows and nulls serve nothing. A row a source: a range per end at most, in one small sort.
    """
    ok = windows.where("oldest <= latest").select("priority", F.greatest("oldest", F.lit(first)).alias("oldest"), F.least("latest", F.lit(last)).alias("latest")).where("oldest <= latest")
    ends = ok.select(F.col("oldest").alias("at")).union(ok.select(F.col("latest") + 1)).distinct()
    parts = Ordered(ends, "at").neighbour("behind", "at", behind=True).where("behind is not null").select(F.col("at").alias("from_ledger"), (F.col("behind.at") - 1).alias("to_ledger"))
    served = parts.join(ok, (F.col("oldest") <= F.col("from_ledger")) & (F.col("latest") >= F.col("to_ledger"))).groupBy("from_ledger", "to_ledger").agg(F.min("priority").alias("priority"))
    # A range goes on while the next one begins behind it with the same source.
    marked = Ordered(served, "from_ledger").neighbour("before", "to_ledger", "priority", behind=False)
    begins = F.col("before").isNull() | (F.col("before.priority") != F.col("priority")) | (F.col("before.to_ledger") + 1 != F.col("from_ledger"))
    numbered = Ordered(marked.withColumn("begins", begins.cast("int")), "from_ledger").running(run=F.col("begins"))
    return numbered.groupBy("run").agg(F.min("from_ledger").alias("from_ledger"), F.max("to_ledger").alias("to_ledger"), F.min("priority").alias("priority")).drop("run")


def read_cover(cover: DataFrame, read: Callable[[int, int, int], DataFrame]) -> DataFrame | None:
    """The union of ``read(priority, first, last)`` over a cover's ranges: each ledger is read from one source, and no source
    beyond its ranges. The driver holds the ranges, at most two a source; None where there are none."""
    found = [read(r["priority"], r["from_ledger"], r["to_ledger"]) for r in cover.orderBy("from_ledger").collect()]
    return reduce(DataFrame.unionByName, found) if found else None


def continuity_breaks(ledgers: DataFrame) -> DataFrame:
    """Ledgers whose prev_hash isn't the hash of the ledger before, where that one is stored. A join by number: no global window."""
    before = ledgers.select((F.col("ledger_seq") + 1).alias("ledger_seq"), F.col("ledger_hash").alias("expected"))
    return ledgers.join(before, "ledger_seq").where(F.lower("prev_hash") != F.lower("expected")).select("ledger_seq", "prev_hash", "expected")


def chain_continuity(ledgers: DataFrame, cursor_ledger: int, cursor_hash: str | None) -> DataFrame:
    """The first ledger after a cursor and whether it continues it; none if it isn't there or a hash is unknown."""
    return ledgers.where((F.col("ledger_seq") == cursor_ledger + 1) & F.lit(bool(cursor_hash)) & F.col("prev_hash").isNotNull()).select("ledger_seq", (F.lower("prev_hash") == (cursor_hash or "").lower()).alias("continues"))


def coverage_gaps(ledgers: DataFrame) -> DataFrame:
    """Missing ranges between stored ledgers, over ranges of ledgers."""
    rows = Ordered(ledgers.select("ledger_seq").distinct(), "ledger_seq").neighbour("after", "ledger_seq", behind=True)
    return rows.where("after.ledger_seq > ledger_seq + 1").select((F.col("ledger_seq") + 1).alias("from_ledger"), (F.col("after.ledger_seq") - 1).alias("to_ledger"))


def remaining_gaps(gaps: DataFrame, replayed: DataFrame, bucket: int = 10_000) -> DataFrame:
    """What is left of recorded gaps after the ledgers of ``replayed``, as ranges within each gap.

    Gaps and ledgers meet by equal buckets of ledger numbers; a gap stands in each bucket it reaches into.
    """
    of = lambda c: F.floor(F.col(c) / bucket)
    r = replayed.select(F.col("ledger_seq").alias("r")).distinct().withColumn("bucket", of("r"))
    reach = gaps.select("from_ledger", "to_ledger").distinct().withColumn("bucket", F.explode(F.sequence(of("from_ledger"), of("to_ledger"))))
    inside = reach.join(r, "bucket").where(F.col("r").between(F.col("from_ledger"), F.col("to_ledger")))
    ends = inside.select("from_ledger", "to_ledger", "r").union(gaps.select("from_ledger", "to_ledger", F.col("from_ledger") - 1)).union(gaps.select("from_ledger", "to_ledger", F.col("to_ledger") + 1)).where("r is not null")
    w = Window.partitionBy("from_ledger", "to_ledger").orderBy("r")
    return ends.withColumn("after", F.lead("r").over(w)).where("after > r + 1").select((F.col("r") + 1).alias("from_ledger"), (F.col("after") - 1).alias("to_ledger"))


def as_gaps(clamped: DataFrame, detected_at: Column) -> DataFrame:
    return clamped.where("outcome = 'clamped'").select(F.col("gap_from").alias("from_ledger"), F.col("gap_to").alias("to_ledger"), "reason", detected_at.alias("detected_at"))
