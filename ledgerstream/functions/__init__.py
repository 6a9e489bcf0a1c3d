"""Column expressions: no joins, no shuffles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_UINT32 = 4294967295
# Fixed values of the wire contract.
SCHEMA_VERSION, GAP_REASON, GAP_KIND, DEPOSIT_KIND = "1.1", "rpc_retention", "gap", "token_transfer"
# Fixed value: the text of a ledger service's error.
WINDOW_ERROR = r"oldest ledger:?\s*(\d+).*?latest ledger:?\s*(\d+)"


def first_topic_symbol(topics="topics") -> Column:
    """The first topic's value if it is a symbol, else null."""
    first = F.try_element_at(F.col(topics), F.lit(1))
    return F.when(first["type"] == "symbol", first["value"])


def transfer_recipient(topics="topics") -> Column:
    """The recipient of a well-formed transfer, else null: symbol ``transfer``, then two addresses."""
    at = lambda i: F.try_element_at(F.col(topics), F.lit(i))
    return F.when((F.size(topics) >= 3) & (first_topic_symbol(topics) == "transfer") & (at(2)["type"] == "address") & (at(3)["type"] == "address"), at(3)["value"])


def routing_key(prefix: str = "stellar", entity: str = "escrow") -> Column:
    kind = F.when(F.col("type") == "state", F.col("state_change_type")).when(F.col("type") == "control", F.col("control_kind")).otherwise(F.col("event_kind"))
    text = lambda c: F.coalesce(c, F.lit(""))
    return F.concat_ws(".", F.lit(prefix), text(F.col("network")), F.lit(entity), text(F.col("type")), text(kind))


def envelope_problem() -> Column:
    """Null for a valid envelope, else the first rule it fails."""
    empty = lambda c: F.coalesce(F.col(c) == "", F.lit(True))
    zero = lambda c: F.coalesce(F.col(c) == 0, F.lit(True))
    out = F.when(empty("schema_version"), "missing schema_version").when(empty("type"), "missing type").when(empty("network"), "missing network").when(empty("message_id"), "missing message_id").when(zero("ledger_seq"), "no ledger_seq")
    fact, state, control = F.col("type").isin("event", "deposit"), F.col("type") == "state", F.col("type") == "control"
    for c in ("contract_id", "raw_xdr", "event_kind", "tx_hash"):
        out = out.when(fact & empty(c), f"missing {c}")
    out = out.when(state & empty("contract_id"), "missing contract_id").when(state & empty("state_change_type"), "missing state_change_type").when(state & (F.col("state_change_type") != "removed") & empty("raw_xdr"), "missing raw_xdr")
    out = out.when(control & empty("control_kind"), "missing control_kind").when(control & (zero("gap_from_ledger") | zero("gap_to_ledger") | (F.col("gap_from_ledger") > F.col("gap_to_ledger"))), "bad gap range")
    return out.when(~(fact | state | control), "unknown type")


def command_problem(max_reseed: int = 5000, max_ttl: int = 3600) -> Column:
    """Null for a valid command, else the rule it fails."""
    kind, n, ttl = F.col("command"), F.coalesce(F.size("contract_ids"), F.lit(0)), F.coalesce(F.col("ttl_seconds"), F.lit(0))
    one = kind.isin("track_escrow", "refresh_escrow", "remove_escrow")
    return (
        F.when(one & F.coalesce(F.col("contract_id") == "", F.lit(True)), "no contract_id")
        .when((kind == "reseed") & (n <= 0), "no contract_ids")
        .when((kind == "reseed") & (n > max_reseed), "too many ids")
        .when((kind == "pause") & (ttl < 0), "ttl below zero")
        .when((kind == "pause") & (ttl > max_ttl), "ttl over an hour")
        .when(~F.coalesce(one | kind.isin("reseed", "pause", "resume", "reconcile"), F.lit(False)), "unknown command")
    )


def pause_ttl(ttl="ttl_seconds", default: int = 600, most: int = 3600) -> Column:
    t = F.coalesce(F.col(ttl), F.lit(0))
    return F.least(F.when(t <= 0, F.lit(default)).otherwise(t), F.lit(most)).cast("long")


def window_error_class(error="error", requested="requested") -> Column:
    """``beyond_tip``, ``below_retention`` or ``none``; bounds over 32 bits are none."""
    number = lambda i: F.regexp_extract(F.col(error), WINDOW_ERROR, i).try_cast("decimal(38,0)")
    oldest, latest = number(1), number(2)
    ok = oldest.isNotNull() & latest.isNotNull() & (oldest <= MAX_UINT32) & (latest <= MAX_UINT32)
    return F.when(ok & (F.col(requested) > latest), "beyond_tip").when(ok & (F.col(requested) < oldest), "below_retention").otherwise("none")


def address_shape(c) -> Column:
    """``contract``, ``account`` or ``invalid`` by shape; checksums are not verified."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.rlike("^C[A-Z2-7]{55}$"), "contract").when(c.rlike("^G[A-Z2-7]{55}$"), "account").otherwise("invalid")


def sanitize_text(c) -> Column:
    """A string or binary column as text: NULs dropped, each run of invalid UTF-8 one question mark."""
    valid = F.make_valid_utf8(F.col(c).cast("string"))
    return F.regexp_replace(F.translate(valid, "\u0000", ""), "�+", "?")


def url_host(c) -> Column:
    """Host and port of a URL; ``unknown`` for what can't be parsed or has none."""
    return F.coalesce(F.nullif(F.regexp_replace(F.try_parse_url(F.col(c), F.lit("AUTHORITY")), "^.*@", ""), F.lit("")), F.lit("unknown"))


def redact_url(c) -> Column:
    """The URL, its password masked; a password may hold any sign but those that end the authority."""
    return F.regexp_replace(F.col(c), "(//[^:/?#@]*):[^/?#]*@", "$1:***@")


def topic_regex(pattern: str) -> str:
    """An anchored regular expression of a topic pattern: ``*`` is one token, ``#`` none or more."""
    import re

    tokens = pattern.split(".")
    while any(a == b == "#" for a, b in zip(tokens, tokens[1:], strict=False)):
        tokens = [t for i, t in enumerate(tokens) if not (t == "#" and i and tokens[i - 1] == "#")]
    if tokens == ["#"]:
        return r"^.*$"
    out = ""
    for i, t in enumerate(tokens):
        if t == "#":
            # A leading run takes the dot after it along, any other the dot before it.
            out += r"([^.]+\.)*" if i == 0 else r"(\.[^.]+)*"
        else:
            out += ("" if i == 0 or i == 1 and tokens[0] == "#" else r"\.") + (r"[^.]+" if t == "*" else re.escape(t))
    return f"^{out}$"


def topic_regex_column(pattern="pattern") -> Column:
    """``topic_regex`` of a column, for tables of bindings."""
    p = F.regexp_replace(F.col(pattern), r"(#\.)+#", "#")
    p = F.regexp_replace(p, r"([\\^$|?+(){}\[\]-])", r"\\$1")
    p = F.regexp_replace(p, r"^#\.", "\u0001")
    p = F.regexp_replace(p, r"\.#", "\u0002")
    p = F.replace(F.replace(p, F.lit("."), F.lit(r"\.")), F.lit("*"), F.lit("[^.]+"))
    p = F.replace(F.replace(p, F.lit("\u0001"), F.lit(r"([^.]+\.)*")), F.lit("\u0002"), F.lit(r"(\.[^.]+)*"))
    return F.concat(F.lit("^"), F.when(F.col(pattern) == "#", F.lit(".*")).otherwise(p), F.lit("$"))


def rfc3339(c) -> Column:
    """A time in UTC to the second, whatever the session's time zone is."""
    seconds = F.unix_seconds(F.col(c) if isinstance(c, str) else c)
    return F.concat(F.replace(F.substring((F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds)).cast("string"), 1, 19), F.lit(" "), F.lit("T")), F.lit("Z"))
