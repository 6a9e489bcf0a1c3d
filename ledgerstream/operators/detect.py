"""Events and deposits of tracked contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import DEPOSIT_KIND, first_topic_symbol, transfer_recipient
from .asof import are_few, bucketed, named, tracked_at, within


def event_index(raw: DataFrame) -> DataFrame:
    """Numbers every event of a transaction from 0. Filters on other columns stay above the window, so all are counted."""
    w = Window.partitionBy("ledger_seq", "tx_index").orderBy("op_index", "op_event_pos")
    return raw.withColumn("event_index", (F.row_number().over(w) - 1).cast("long"))


def detect_events(raw: DataFrame, intervals: DataFrame) -> DataFrame:
    return tracked_at(event_index(raw), intervals, "emitter").where("is_tracked").drop("is_tracked")


PLACE = ("ledger_seq", "tx_index", "op_index", "op_event_pos")
#: What only facts carry through the shuffle.
PAYLOAD = ("closed_at", "tx_hash", "raw_xdr")


def detect(raw: DataFrame, intervals: DataFrame) -> DataFrame:
    """Facts: events of tracked emitters, and deposits (transfers to tracked recipients from others), each once.

    All events of a transaction are numbered, but only facts take more than their place through that shuffle. Where intervals are few they
    are sent, and it is the one shuffle there is; else places and ids alone are dealt to the intervals (``bucketed``), events
    without a recipient only for their emitter, and what matched joins the events' one shuffle by transaction. ``intervals``
    are read more than once: store them first where they are dear.
    """
    rows = raw.select(*PLACE, *PAYLOAD, "emitter", transfer_recipient().alias("recipient"), first_topic_symbol().alias("symbol"))
    found = sent_hits(rows, intervals) if are_few(intervals) else dealt_hits(rows, intervals)
    by_emitter = F.col("hit._role") == 0
    kind = F.when(by_emitter, F.col("symbol")).otherwise(F.lit(DEPOSIT_KIND))
    fact = F.struct(F.when(by_emitter, "event").otherwise("deposit").alias("type"), F.col("hit._id").alias("contract_id"), kind.alias("event_kind"), *PAYLOAD)
    narrow = found.select(*PLACE, F.when(F.col("hit").isNotNull(), fact).alias("fact"))
    facts = event_index(narrow).where("fact is not null")
    return facts.select("fact.type", "fact.contract_id", "fact.event_kind", "ledger_seq", "fact.closed_at", "fact.tx_hash", "tx_index", "event_index", "fact.raw_xdr")


def sent_hits(rows: DataFrame, intervals: DataFrame) -> DataFrame:
    """``rows`` with ``hit``: the id that is tracked at the row's ledger, and whether as emitter (0) or recipient (1)."""
    sent = F.broadcast(named(intervals))
    for c, flag in (("emitter", "_e"), ("recipient", "_r")):
        rows = rows.join(sent, (F.col(c) == F.col("_c")) & within(F.col("ledger_seq")), "left").withColumn(flag, F.col("_c")).drop("_c", "_f", "_t")
    hit = lambda c, role: F.struct(F.lit(role).alias("_role"), F.col(c).alias("_id"))
    return rows.withColumn("hit", F.when(F.col("_e").isNotNull(), hit("_e", 0)).when(F.col("_r").isNotNull(), hit("_r", 1))).drop("_e", "_r")


def dealt_hits(rows: DataFrame, intervals: DataFrame) -> DataFrame:
    """``sent_hits`` by shuffles of places and ids, and one of the events by transaction, which the numbering then uses."""
    roles = F.filter(F.array(*[F.struct(F.lit(i).alias("_role"), F.col(c).alias("_id")) for i, c in enumerate(("emitter", "recipient"))]), lambda x: x["_id"].isNotNull())
    left, right = bucketed(rows.select(*PLACE, F.inline(roles)), intervals, "_id", "ledger_seq")
    matched = left.join(right.withColumnRenamed("_b", "_rb"), (F.col("_id") == F.col("_c")) & (F.col("_b") == F.col("_rb")) & within(F.col("ledger_seq")))
    hits = matched.groupBy(*PLACE).agg(F.min(F.struct("_role", "_id")).alias("hit"))
    both = rows.withColumn("_row", F.lit(True)).unionByName(hits, allowMissingColumns=True).repartition("ledger_seq", "tx_index")
    return both.withColumn("hit", F.max("hit").over(Window.partitionBy(*PLACE))).where("_row")


def detect_deposits(raw: DataFrame, intervals: DataFrame) -> DataFrame:
    return detect(raw, intervals).where("type = 'deposit'")


def active_entities(facts: DataFrame) -> DataFrame:
    return facts.select("ledger_seq", "contract_id").distinct()


def ordered_history(facts: DataFrame) -> DataFrame:
    return facts.orderBy("ledger_seq", "tx_index", "event_index")
