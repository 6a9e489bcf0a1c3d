"""Operator commands."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import command_problem, pause_ttl


def validate_command(commands: DataFrame) -> DataFrame:
    return commands.withColumn("reject_reason", command_problem())


def pause_intervals(commands: DataFrame) -> DataFrame:
    """``from_s, to_s`` (Unix seconds) of each pause: its time to live, cut by the next pause or resume.

    Commands are an operator's log: one window over it.
    """
    rows = commands.where(F.col("command").isin("pause", "resume")).select("cmd_seq", "command", F.unix_seconds("ts").alias("from_s"), pause_ttl().alias("ttl"))
    rows = rows.withColumn("after", F.lead("from_s").over(Window.orderBy("from_s", "cmd_seq")))
    return rows.where("command = 'pause'").select("cmd_seq", "from_s", F.least(F.col("from_s") + F.col("ttl"), "after").alias("to_s"))


def refresh_targets(commands: DataFrame, now: DataFrame) -> DataFrame:
    """``cmd_seq, contract_id`` to read again: tracked by the command, or asked for and tracked (``now``: contract_id, status)."""
    ids = F.when(F.col("command") == "reseed", F.col("contract_ids")).when(F.col("command").isin("track_escrow", "refresh_escrow"), F.array("contract_id"))
    asked = commands.select("cmd_seq", "command", F.explode(ids).alias("contract_id")).distinct()
    held = asked.join(now, "contract_id", "left")
    keep = (F.col("command") == "track_escrow") | (F.col("status") == "tracked") | ((F.col("command") == "reseed") & F.coalesce(F.col("status") != "tombstoned", F.lit(True)))
    return held.where(keep).select("cmd_seq", "contract_id")
