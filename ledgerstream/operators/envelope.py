"""Envelopes: facts, states and gaps in one flat schema, their JSON, validation and views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import GAP_KIND, SCHEMA_VERSION, envelope_problem, rfc3339, routing_key

FIELDS = "schema_version string, type string, network string, contract_id string, ledger_seq long, ledger_closed_at timestamp, tx_hash string, tx_index long, event_kind string, event_index long, state_change_type string, raw_xdr string, message_id string, published_at timestamp, control_kind string, gap_from_ledger long, gap_to_ledger long, gap_reason string, gap_detected_at timestamp"


def _flat(df: DataFrame, **columns) -> DataFrame:
    return df.select(*[columns.get(n, F.lit(None)).cast(t).alias(n) for n, t in (f.split() for f in FIELDS.split(", "))])


def event_envelope(facts: DataFrame, network: str, published_at: Column) -> DataFrame:
    c = F.col
    return _flat(facts, schema_version=F.lit(SCHEMA_VERSION), type=c("type"), network=F.lit(network), contract_id=c("contract_id"), ledger_seq=c("ledger_seq"), ledger_closed_at=c("closed_at"), tx_hash=c("tx_hash"), tx_index=c("tx_index"), event_kind=c("event_kind"), event_index=c("event_index"), raw_xdr=c("raw_xdr"), message_id=F.concat_ws(":", "tx_hash", "event_index"), published_at=published_at)


def state_envelope(states: DataFrame, network: str, published_at: Column) -> DataFrame:
    c = F.col
    return _flat(states, schema_version=F.lit(SCHEMA_VERSION), type=F.lit("state"), network=F.lit(network), contract_id=c("contract_id"), ledger_seq=c("ledger_seq"), ledger_closed_at=c("closed_at"), state_change_type=c("state_change_type"), raw_xdr=c("raw_xdr"), message_id=F.concat_ws(":", "contract_id", "ledger_seq"), published_at=published_at)


def gap_envelope(gaps: DataFrame, network: str, published_at: Column) -> DataFrame:
    c = F.col
    return _flat(gaps, schema_version=F.lit(SCHEMA_VERSION), type=F.lit("control"), network=F.lit(network), ledger_seq=c("to_ledger") + 1, raw_xdr=F.lit(""), message_id=F.concat_ws(":", F.lit("gap"), F.lit(network), "from_ledger", "to_ledger"), published_at=published_at, control_kind=F.lit(GAP_KIND), gap_from_ledger=c("from_ledger"), gap_to_ledger=c("to_ledger"), gap_reason=c("reason"), gap_detected_at=c("detected_at"))


def union_facts(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def wire_json() -> Column:
    """The message body: zero and empty optional fields are left out, times are RFC 3339."""
    always = {"schema_version", "type", "network", "ledger_seq", "raw_xdr", "message_id"}
    parts = []
    for n, t in (f.split() for f in FIELDS.split(", ")):
        value = rfc3339(n) if t == "timestamp" else F.col(n)
        if n in always:
            value = F.coalesce(value, F.lit(0 if t == "long" else ""))
        elif t != "timestamp":
            value = F.nullif(value, F.lit(0).cast("long") if t == "long" else F.lit(""))
        parts.append(value.alias(n))
    return F.to_json(F.struct(*parts))


def messages(envelopes: DataFrame, prefix: str = "stellar", entity: str = "escrow") -> DataFrame:
    """``topic_key, message_id, value``: what a topic sink gets."""
    return envelopes.select(routing_key(prefix, entity).alias("topic_key"), "message_id", wire_json().alias("value"))


def with_problem(envelopes: DataFrame) -> DataFrame:
    return envelopes.withColumn("reject_reason", envelope_problem())


def split_valid(envelopes: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Valid envelopes, and rejected ones with their reason; ``strict`` raises on the first rejected one instead."""
    marked = with_problem(envelopes)
    if strict:
        marked = marked.withColumn("reject_reason", F.when(F.col("reject_reason").isNotNull(), F.raise_error(F.col("reject_reason"))))
    return marked.where("reject_reason is null").drop("reject_reason"), marked.where("reject_reason is not null")


def history_view(envelopes: DataFrame) -> DataFrame:
    """The first arrival (by published_at, then content) of each message id."""
    cols = [c for c in envelopes.columns if c != "message_id"]
    return envelopes.groupBy("message_id").agg(F.min_by(F.struct(*cols), F.struct("published_at", F.xxhash64(*cols))).alias("e")).select("message_id", "e.*")


def replay_merge(replayed: DataFrame, live: DataFrame) -> DataFrame:
    return history_view(live.unionByName(replayed))


def event_kind_counts(envelopes: DataFrame) -> DataFrame:
    return envelopes.groupBy("type", "event_kind").agg(F.count("*").alias("n"))
