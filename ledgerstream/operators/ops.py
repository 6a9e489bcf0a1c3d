"""Operating figures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import window_error_class
from .ordered import Ordered


def tip_mode(progress: DataFrame, catching_up_s: int = 1200, sweep_s: int = 30) -> DataFrame:
    age = F.unix_seconds("processed_at") - F.unix_seconds("closed_at")
    return progress.withColumn("age_s", age).withColumn("catching_up", F.col("age_s") > catching_up_s).withColumn("sweep_eligible", F.col("age_s") <= sweep_s)


def ledger_progress(ledgers: DataFrame, facts: DataFrame, states: DataFrame, intervals: DataFrame, gaps: DataFrame) -> DataFrame:
    """``events, states`` of each ledger, 0 for ledgers without; ``known_escrows`` tracked at it, ``gaps`` that end before it.

    Everything is summed by ledger first: the running sums go over one row a ledger or change, in ranges of ledgers.
    """
    turns = [intervals.selectExpr("from_ledger as ledger_seq", "1 as tracked"), intervals.where("to_ledger is not null").selectExpr("to_ledger", "-1")]
    parts = [ledgers.selectExpr("ledger_seq", "1 as here", "0 as events", "0 as states", "0 as tracked", "0 as gaps"), facts.selectExpr("ledger_seq", "0", "1", "0", "0", "0"), states.selectExpr("ledger_seq", "0", "0", "1", "0", "0"), *(t.selectExpr("ledger_seq", "0", "0", "0", "tracked", "0") for t in (turns[0], turns[1].toDF("ledger_seq", "tracked"))), gaps.selectExpr("to_ledger + 1", "0", "0", "0", "0", "1")]
    summed = reduce(DataFrame.union, parts).groupBy("ledger_seq").agg(F.max("here").alias("here"), *[F.sum(c).cast("long").alias(c) for c in ("events", "states", "tracked", "gaps")])
    running = Ordered(summed, "ledger_seq").running(known_escrows=F.col("tracked"), gaps_so_far=F.col("gaps"))
    return running.where("here = 1").select("ledger_seq", "events", "states", "known_escrows", F.col("gaps_so_far").alias("gaps"))


def status(progress: DataFrame, counts: DataFrame, now_s: int, stale_s: int = 60, started_s: int | None = None, pauses: DataFrame | None = None) -> DataFrame:
    """One row: current ledger, its age, totals and readiness. ``counts``: one row of events, states, tracked, gaps, suppressed.

    ``started_s`` is when the job began (else its first processed ledger counts); ``pauses`` are ``pause_intervals``.
    """
    one = progress.agg(F.max("ledger_seq").alias("current_ledger"), F.max_by(F.unix_seconds("closed_at"), "ledger_seq").alias("closed_s"), F.max(F.unix_seconds("processed_at")).alias("processed_s"), F.min(F.unix_seconds("processed_at")).alias("first_s"))
    held = pauses.agg(F.coalesce(F.max((F.col("from_s") <= now_s) & (F.col("to_s") > now_s)), F.lit(False)).alias("paused")) if pauses is not None else None
    one = one.withColumn("paused", F.lit(False)) if held is None else one.crossJoin(held)
    began = F.lit(started_s) if started_s is not None else F.col("first_s")
    silent = F.lit(now_s) - F.col("processed_s")
    reason = F.when(F.col("processed_s").isNull(), "no ledger processed yet").when(silent > stale_s, F.concat(F.lit("no ledger processed in "), silent, F.lit("s"))).otherwise("")
    return one.crossJoin(counts).select("current_ledger", (F.lit(now_s) - F.col("closed_s")).alias("ledger_age_seconds"), silent.alias("seconds_since_last_ledger"), F.col("tracked").alias("known_escrows"), F.col("events").alias("events_published_total"), F.col("states").alias("state_changes_published_total"), F.col("gaps").alias("gaps_recorded"), F.col("suppressed").alias("suppressed_removals_total"), (reason == "").alias("ready"), reason.alias("ready_reason"), "paused", F.greatest(F.lit(0).cast("long"), F.lit(now_s) - began).alias("uptime_seconds"))


def metrics_long(status_row: DataFrame, network: str) -> DataFrame:
    # Metric names and kinds.
    gauges = ["current_ledger", "ledger_age_seconds", "seconds_since_last_ledger", "known_escrows", "gaps_recorded", "ready", "paused", "uptime_seconds"]
    counters = ["events_published_total", "state_changes_published_total", "suppressed_removals_total"]
    rows = status_row.select(*[F.col(c).cast("int").cast("double") if c in ("ready", "paused") else F.col(c).cast("double") for c in gauges + counters]).toDF(*gauges, *counters)
    long = rows.unpivot([], gauges + counters, "metric", "value")
    return long.select("metric", F.when(F.col("metric").isin(*counters), "counter").otherwise("gauge").alias("kind"), F.lit(network).alias("network"), "value")


def stall_windows(progress: DataFrame, threshold_s: int = 60) -> DataFrame:
    """Periods without a processed ledger, over ranges of their times."""
    rows = Ordered(progress.select(F.unix_seconds("processed_at").alias("from_s")), "from_s").neighbour("after", "from_s", behind=True)
    rows = rows.select("from_s", F.col("after.from_s").alias("to_s"))
    return rows.where(F.col("to_s") - F.col("from_s") > threshold_s).select("from_s", "to_s", (F.col("to_s") - F.col("from_s")).alias("silent_s"))


QUANTILES = (0.5, 0.9, 0.99)


def fetch_quantiles(log: DataFrame, width: str = "10 minutes", slide: str = "1 minute", exact: bool = True) -> DataFrame:
    """Quantiles of successful fetches' durations over sliding windows, by their end.

    ``exact`` takes each row into all of its windows and keeps their values; else ``fetch_panes`` are merged. ``width`` is then a multiple of ``slide``.
    """
    if not exact:
        return quantiles_of_panes(fetch_panes(log, slide), width, slide)
    return log.where("ok").groupBy(F.window("ts", width, slide).alias("w")).agg(*[F.percentile("duration_s", F.lit(q)).alias(f"p{round(q * 100)}") for q in QUANTILES], F.count("*").alias("n")).select(F.unix_seconds("w.end").alias("end_s"), "p50", "p90", "p99", "n")


def fetch_panes(log: DataFrame, slide: str = "1 minute", k: int = 400) -> DataFrame:
    """``pane_s`` (a pane's start), ``sketch, n``: one mergeable quantile sketch of durations a pane, made map-side.

    A row goes into one pane, and a pane is a few KB however many rows it has. Ranks that a sketch of ``k`` gives are off by less than 1 %
    in all likelihood; null durations aren't counted. Panes of several parts of a log can be united and stored."""
    pane = F.unix_seconds(F.window("ts", slide)["start"])
    return log.where("ok and duration_s is not null").groupBy(pane.alias("pane_s")).agg(F.kll_sketch_agg_double("duration_s", k).alias("sketch"), F.count("*").alias("n"))


def quantiles_of_panes(panes: DataFrame, width: str = "10 minutes", slide: str = "1 minute", k: int = 400) -> DataFrame:
    """``fetch_quantiles`` of windows of panes: only sketches are taken into several windows."""
    seconds = lambda x: F.expr(f"unix_seconds(timestamp_seconds(0) + interval {x})")
    ends = F.sequence(F.col("pane_s") + seconds(slide), F.col("pane_s") + seconds(width), seconds(slide))
    merged = panes.select(F.explode(ends).alias("end_s"), "sketch", "n").groupBy("end_s").agg(F.kll_merge_agg_double("sketch", k).alias("s"), F.sum("n").alias("n"))
    return merged.select("end_s", *[F.kll_sketch_get_quantile_double("s", F.lit(q)).alias(f"p{round(q * 100)}") for q in QUANTILES], "n")


def classify_fetch_errors(log: DataFrame) -> DataFrame:
    return log.where("not ok").withColumn("class", window_error_class())
