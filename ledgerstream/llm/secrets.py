"""Secret scans with corpus-wide ownership frequency.

Every candidate's hash is counted over the distinct documents (repositories) and sources (owners) that hold it. A value
that many owners or many documents hold is a widely copied example; one that few hold looks live. The base kinds are always reported;
the further kinds, which on their own would be too broad, are reported only where the corpus shows them to be
owner-specific. Counts are over the whole corpus, summed map-side before each shuffle.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

KINDS = ("assign", "access", "hex", "vendor", "bearer", "mixed")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
# A run shorter than the bound holds no longer match, so these find just the long ones of all runs.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_VENDOR = re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{20,}|sk_(?:live|test)_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}")
_BEARER = re.compile(r"\b(?:bearer|basic)\x20+([A-Za-z0-9+/_.~-]{20,}=*)", re.I | re.A)
_MIXED = re.compile(r"[A-Za-z0-9+/_-]{24,}")


def _entropy(s: str) -> float:
    return -sum(c / len(s) * math.log2(c / len(s)) for c in Counter(s).values())


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """``(start, kind, end, value)`` of the base kinds, sorted by start, then kind; leftmost and non-overlapping in each kind."""
    found = [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(found)


def more_spans(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Further candidates that overlap neither a base span nor each other."""
    taken: list[tuple[int, int]] = []  # disjoint, in order
    for s, e in sorted((s, e) for s, _, e, _ in base):
        if taken and s < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(e, taken[-1][1]))
        else:
            taken.append((s, e))
    found = []
    tries = [(3, m.start(), m.end(), m[0]) for m in _VENDOR.finditer(text)] + [(4, m.start(), m.end(), m[1]) for m in _BEARER.finditer(text)]
    tries += [(5, m.start(), m.end(), m[0]) for m in _MIXED.finditer(text) if re.search(r"[0-9]", m[0]) and re.search(r"[a-z]", m[0]) and re.search(r"[A-Z]", m[0]) and _entropy(m[0]) >= 3.5]
    for kind, s, e, v in tries:
        i = bisect_left(taken, (e,))  # the first that begins at or after the end
        if not i or taken[i - 1][1] <= s:
            insort(taken, (s, e))
            found.append((s, kind, e, v))
    return found


def join_spans(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, *_ in spans)


def scan(docs: DataFrame, owner_col: str = "source", whole: bool = False) -> DataFrame:
    """Candidates of every whole text: ``row, doc_id, owner, n_assign, n_access, n_hex, base_sha256, found``.

    ``found`` is an array of (start, kind, finish, value hash), base and further ones; ``row`` is unique in the
    stored result. Null texts are empty. Without an ``owner_col`` each document is its own owner. ``whole`` keeps the
    row of ``docs`` as a struct ``doc``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int64()), ("finish", pa.int64()), ("value", pa.string())]))
        for b in batches:
            counts, shas, found = ([], [], []), [], []
            for t in b.column(2).field("text") if whole else b.column(2):
                text = t.as_py() or ""
                base = base_spans(text)
                of = Counter(k for _, k, _, _ in base)
                for k in range(3):
                    counts[k].append(of[k])
                shas.append(hashlib.sha256(join_spans(base).encode()).hexdigest())
                found.append([{"start": s, "kind": k, "finish": e, "value": hashlib.sha256(v.encode("utf-8", "surrogatepass")).hexdigest()} for s, k, e, v in sorted(base + more_spans(text, base))])
            more = [b.column(2)] if whole else []
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c, pa.int64()) for c in counts), pa.array(shas), pa.array(found, kind), *more], names=["doc_id", "owner", "n_assign", "n_access", "n_hex", "base_sha256", "found", *["doc"][: len(more)]])

    owner = F.col(owner_col).cast("string") if owner_col in docs.columns else F.col("doc_id").cast("string")
    schema = "doc_id long, owner string, n_assign long, n_access long, n_hex long, base_sha256 string, found array<struct<start:long,kind:long,finish:long,value:string>>"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(owner, F.lit("")).alias("owner"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc") if whole else F.col("text").cast("string").alias("text"))
    out = rows.mapInArrow(run, schema + (f", doc {docs.schema.simpleString()}" if whole else ""))
    return stored(out.withColumn("row", F.monotonically_increasing_id()), "secrets-scan")


def ownership(scanned: DataFrame, max_owners: int = 2, max_docs: int = 8) -> DataFrame:
    """``value, n_docs, n_owners, live`` of every candidate value: live if at most ``max_owners`` owners and ``max_docs`` distinct
    documents hold it (rows without an id are a document each)."""
    repository = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("row "), "row"))
    held = scanned.select("owner", repository.alias("repository"), F.explode(F.array_distinct("found.value")).alias("value")).distinct()
    by_owner = held.groupBy("value", "owner").agg(F.count("*").alias("n"))
    return by_owner.groupBy("value").agg(F.sum("n").alias("n_docs"), F.count("*").alias("n_owners")).withColumn("live", (F.col("n_owners") <= max_owners) & (F.col("n_docs") <= max_docs))


def find_secrets(docs: DataFrame, owner_col: str = "source", max_owners: int = 2, max_docs: int = 8) -> DataFrame:
    """One row per row of ``docs``: doc_id, base counts and digest, all reported spans as text, ``n_live``, ``n_example``.

    ``spans_found`` holds the reported spans with kind, start, finish and whether the value looks live. Repeated rows
    are reported each; null texts and texts without a candidate have no spans.
    """
    scanned = scan(docs, owner_col)
    values = stored(ownership(scanned, max_owners, max_docs), "secrets-owners")
    spans = scanned.select("row", F.explode("found").alias("f")).select("row", "f.*").join(values.select("value", "live", "n_owners"), "value").where("kind < 3 or live")
    kinds = F.array(*[F.lit(k) for k in KINDS])
    # A document's own spans, bounded by its length.
    by_row = spans.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "finish", "live"))).alias("spans_found"))
    text = F.array_join(F.transform("spans_found", lambda x: F.concat_ws(":", F.element_at(kinds, (x.kind + 1).cast("int")), x.start, x.finish)), ",")
    n = lambda live: F.coalesce(F.size(F.filter("spans_found", lambda x: x.live == live)), F.lit(0)).cast("long")
    none = F.array().cast("array<struct<start:long,kind:long,finish:long,live:boolean>>")
    return scanned.drop("found", "owner").join(by_row, "row", "left").withColumn("spans_found", F.coalesce("spans_found", none)).select("row", "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", text.alias("spans"), n(True).alias("n_live"), n(False).alias("n_example"), "spans_found")


#: Characters of example values sent to all tasks; beyond, rows are shuffled to them.
SENT_CHARACTERS = 8 << 20


def redact(docs: DataFrame, owner_col: str = "source", max_owners: int = 2, max_docs: int = 8) -> DataFrame:
    """``docs`` with every base span, and every further span that looks live, replaced by ``[SECRET]``, or ``[EXAMPLE]``
    where many hold the value. Other texts, and all other columns but ``n_chars``, stay as they are; so do null texts,
    repeated rows and rows with a null id. The rows are written once with what was found, so texts are scanned once."""
    scanned = scan(docs, owner_col, whole=True)
    example = ownership(scanned, max_owners, max_docs).where("not live").select("value")
    held = stored(scanned.select("row", F.explode(F.array_distinct("found.value")).alias("value")).join(example, "value").groupBy("row").agg(F.collect_list("value").alias("examples")), "secrets-examples")
    size = held.agg(F.sum(64 * F.size("examples") + 24)).first()[0] or 0
    joined = scanned.select("row", "doc", "found").join(F.broadcast(held) if size <= SENT_CHARACTERS else held, "row", "left")
    names, text_at = docs.columns, docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = b.column(0).flatten()
            texts = columns[text_at]
            if pc.sum(pc.list_value_length(b.column(1))).as_py():
                texts = pa.array([_blank(t.as_py(), f.as_py(), frozenset(e.as_py() or ())) if len(f) else t.as_py() for t, f, e in zip(texts, b.column(1), b.column(2), strict=True)], texts.type)
            columns[text_at] = texts
            yield pa.RecordBatch.from_arrays(columns, names=names)

    out = joined.select("doc", "found", "examples").mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def _blank(text: str, found: list[dict], examples: frozenset) -> str:
    out, at = [], 0
    for x in found:
        s, e, example = x["start"], x["finish"], x["value"] in examples
        if x["kind"] >= 3 and example or e <= at:
            continue
        if s >= at:
            out += [text[at:s], "[EXAMPLE]" if example else "[SECRET]"]
        at = max(at, e)
    return "".join([*out, text[at:]])
