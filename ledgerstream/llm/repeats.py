"""Repeated byte strings across documents: every byte that a string of ``length`` bytes covers which starts earlier too.

The dealt method inserts one symbol of each document a round and rewrites the collection's transform and common prefixes
each time. Its rounds are as many as the longest string has bytes, each over all that is stored, so whole documents are not
one collection (see the README for figures): strings that can be equal are first brought together by what they share, their
anchor, and the contexts of an anchor are a collection of strings of less than 2 * ``length`` bytes, aligned at it
(``columns``). A context that occurs several times is one string of its collection, with several places.

1. Each window of ``length`` bytes has an anchor, the least of its k-gram hashes (leftmost of equals). Equal windows have
   equal anchors at equal offsets. Neighbouring windows with one anchor are a run; a run's bytes are its context.
2. Runs are dealt by anchor. Of a context's places, all but the first go whole. Where an anchor has several contexts,
   the first place of each stays open; a single context has nothing to be compared with. What a task sees again is
   taken out before the shuffle.
3. Open runs of an anchor with over ``COLLECTION`` of them are cut into runs of 8 windows that are dealt by the bytes all
   of these hold, and settled as in 2; what is still so frequent is cut into single windows, which leaves nothing open.
4. Contexts of open runs are dealt by anchor and put in order column by column; of windows with a common prefix of
   ``length`` all but the first by (document, start) go.
5. The spans found are joined with the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import repeated_windows
from .common import stored

LENGTH, GRAM = 100, 24
#: Anchors are dealt by this many bits of their hash: one that two grams share costs a comparison, no more.
ANCHOR_BITS = 48
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_TABLE = np.random.default_rng(20240101).integers(0, 2**63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
PIECE = 1 << 19
#: Contexts put in order at once (whole anchors, so up to ``COLLECTION`` more), and open runs of an anchor beyond which
#: they are cut. Both bound memory, not the result.
AT_ONCE, COLLECTION = 16_000, 4_000
#: Runs to be cut are sent to the texts up to this number (24 bytes each), beyond it the texts are shuffled to them.
SENT_RUNS = 300_000
CUTS = (8, 1)
_PLACE = np.uint64((1 << 20) - 1)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(BASE), n, 1 << 64))


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """64-bit polynomial hashes of all runs of ``k`` bytes, from those of powers of 2."""
    if len(data) < k:
        return np.empty(0, np.uint64)
    part, m, out, done = _TABLE[data], 1, None, 0
    rest = k
    while rest:
        if rest & 1:
            if out is None:
                out = part.copy()
            else:
                n = len(part) - done
                out = out[:n] * _power(m) + part[done:]
            done += m
        rest >>= 1
        if rest:
            part = part[:-m] * _power(m) + part[m:]
            m *= 2
    return out[: len(data) - k + 1]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def runs(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of a text: anchor hash, first window, last window, anchor's place. Long texts go piece by piece."""
    w = length - gram + 1
    out = []
    for at in range(0, max(0, len(data) - length + 1), PIECE):
        h = _mixed(gram_hashes(data[at : at + PIECE + length - 1], gram))
        low = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
        m = 1
        while 2 * m <= w:
            low = np.minimum(low[:-m], low[m:])
            m *= 2
        if m < w:
            low = np.minimum(low[: len(low) - (w - m)], low[w - m :])
        place = (low & _PLACE).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(np.diff(place)) + 1))
        last = np.concatenate((first[1:] - 1, [len(place) - 1]))
        out.append(((h[place[first]] >> np.uint64(64 - ANCHOR_BITS)).view(np.int64), first + at, last + at, place[first] + at))
    if not out:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


# A run's place in one long: copy number of the id (for repeated ids), first window. Its shape in another: context bytes,
# anchor's offset; below zero where the run is settled.
def _pack(a, b, bits):
    return (a << bits) | b


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        parts = []
        for d, copy, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
            raw = text.as_buffer()
            raw = memoryview(raw) if raw is not None else b""
            if len(raw) < LENGTH:
                continue
            anchor, first, last, place = runs(np.frombuffer(raw, np.uint8))
            h = xxhash.xxh3_64_intdigest
            ends = (last + LENGTH).tolist()
            context = np.array([h(raw[i:j]) for i, j in zip(first.tolist(), ends, strict=True)], np.uint64)
            shape = _pack(last - first + LENGTH, place - first, 10)
            context = (context ^ _mixed(shape.astype(np.uint64))).view(np.int64)
            parts.append((anchor, context, np.full(len(anchor), d, np.int64), _pack(np.int64(copy), first, 40), shape))
        if not parts:
            continue
        anchor, context, doc, at, shape = (np.concatenate(x) for x in zip(*parts, strict=True))
        # What this batch sees again is settled here: only the first of equal runs is dealt out as open.
        order = np.lexsort((at, doc, context, anchor))
        same = np.zeros(len(order), bool)
        same[1:] = (anchor[order][1:] == anchor[order][:-1]) & (context[order][1:] == context[order][:-1])
        moved = np.zeros(len(order), bool)
        moved[order] = same
        head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
        itself = np.zeros(len(order), bool)
        itself[order] = (doc[order] == doc[order][head]) & (at[order] == at[order][head])
        keep = ~(moved & itself)  # a row that repeats id and text goes
        # Settled runs need no others any more, so they are dealt evenly.
        anchor = np.where(moved, (_mixed(doc.view(np.uint64) * BASE + at.view(np.uint64)) >> np.uint64(64 - ANCHOR_BITS)).view(np.int64), anchor)
        shape = np.where(moved, -shape, shape)
        yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (anchor, context, doc, at, shape)], names=["anchor", "context", "doc", "at", "shape"])


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted by anchor, context, doc, at. Runs seen before: spans. First runs of anchors with several contexts: open."""
    anchor = context = None
    first: tuple | None = None  # (doc, at, shape) of the context at hand
    pending: tuple | None = None  # the first run of an anchor's first context, until another context comes
    for b in batches:
        cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
        done = cols[4] < 0
        if done.any():
            d, p, s = (x[done] for x in cols[2:5])
            yield pa.RecordBatch.from_arrays([pa.array(d), pa.array(p), pa.array(-s), pa.array(np.zeros(len(d), bool)), pa.array(np.zeros(len(d), np.int64))], names=["doc", "at", "shape", "open", "anchor"])
            cols = [x[~done] for x in cols]
        a, c = cols[0], cols[1]
        n = len(a)
        new_a = np.ones(n, bool)
        new_c = np.ones(n, bool)
        new_a[1:] = a[1:] != a[:-1]
        new_c[1:] = new_a[1:] | (c[1:] != c[:-1])
        if n and anchor is not None:
            new_a[0] = a[0] != anchor
            new_c[0] = new_a[0] or c[0] != context
        # Most anchors have one run; they are passed over together.
        lone = np.zeros(n, bool)
        if n > 1:
            lone[:-1] = new_a[:-1] & new_a[1:]
        lone[-1:] = False
        docs, ats, shapes, opens, anchors = [], [], [], [], []
        rest = np.flatnonzero(~lone)
        for x, d, p, s, na, nc in zip(a[rest].tolist(), cols[2][rest].tolist(), cols[3][rest].tolist(), cols[4][rest].tolist(), new_a[rest].tolist(), new_c[rest].tolist(), strict=True):
            if na:
                pending = first = (d, p, s)
            elif nc:
                if pending is not None:
                    docs.append(pending[0]), ats.append(pending[1]), shapes.append(pending[2]), opens.append(True), anchors.append(x)
                    pending = None
                first = (d, p, s)
                docs.append(d), ats.append(p), shapes.append(s), opens.append(True), anchors.append(x)
            elif (d, p) != first[:2]:
                docs.append(d), ats.append(p), shapes.append(s), opens.append(False), anchors.append(x)
        if n:
            anchor, context = int(a[-1]), int(c[-1])
        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(ats, pa.int64()), pa.array(shapes, pa.int64()), pa.array(opens, pa.bool_()), pa.array(anchors, pa.int64())], names=["doc", "at", "shape", "open", "anchor"])


def _cut(step: int):
    """A document's open runs cut where their windows' anchor offset passes a multiple of ``step``, dealt by common bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h = xxhash.xxh3_64_intdigest
        for b in batches:
            for d, text, want in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
                raw = memoryview(text.as_buffer())
                out = []
                for r in want.as_py():
                    first, size, offset = r["at"] & ((1 << 40) - 1), r["shape"] >> 10, r["shape"] & 1023
                    last = size - LENGTH
                    j = 0
                    while j <= last:
                        block = (offset - j) // step
                        end = min(last, offset - block * step)
                        shape = ((end - j + LENGTH) << 10) | (offset - j)
                        low = first + offset - block * step
                        out.append((h(raw[low : low - step + 1 + LENGTH], block), h(raw[first + j : first + end + LENGTH], shape), r["at"] + j, shape))
                        j = end + 1
                key, context, at, shape = zip(*out, strict=True)
                signed = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays([signed(key), signed(context), pa.array(np.full(len(at), d, np.int64)), pa.array(at, pa.int64()), pa.array(shape, pa.int64())], names=["anchor", "context", "doc", "at", "shape"])

    return run


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of a document's open runs."""
    for b in batches:
        for d, text, want in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
            raw = bytes(text.as_buffer())
            v = want.values
            at, shape, anchor = (v.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            first, size = at & ((1 << 40) - 1), shape >> 10
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(np.full(len(at), d, np.int64)), pa.array(at), pa.array(shape), pa.array([raw[i : i + n] for i, n in zip(first.tolist(), size.tolist(), strict=True)], pa.binary())], names=["anchor", "doc", "at", "shape", "bytes"])


def _compare(batches: Iterator[pa.RecordBatch], rows_at_once: int = AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Sorted by anchor, doc, at: windows whose like an earlier context of the anchor holds become spans.

    The contexts of some whole anchors are a collection, put in order column by column; suffixes with a common prefix of
    ``LENGTH`` follow each other, and all but the earliest go.
    """

    def work(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        anchor, doc, at, shape = (t.column(i).to_numpy() for i in range(4))
        # Rows that repeat id and text bring the same context again.
        fresh = np.ones(len(anchor), bool)
        fresh[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]) | (at[1:] != at[:-1])
        held = t.column(4).chunk(0)
        start = np.frombuffer(held.buffers()[1], np.int32)[held.offset : held.offset + len(held)].astype(np.int64)
        data = np.frombuffer(held.buffers()[2], np.uint8)
        anchor, doc, at, shape, start = (x[fresh] for x in (anchor, doc, at, shape, start))
        lead, size = shape & 1023, shape >> 10
        group = np.cumsum(np.concatenate(([False], anchor[1:] != anchor[:-1])))
        again = repeated_windows(data, start, lead, size, group.astype(np.uint16 if group[-1] < 1 << 16 else np.int64), LENGTH)
        # Neighbouring windows are one span.
        edge = np.diff(np.pad(again, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, first = np.nonzero(edge == 1)
        last = np.nonzero(edge == -1)[1] - 1
        return pa.RecordBatch.from_arrays([pa.array(doc[row]), pa.array(at[row] + first - (again.shape[1] - 1) + lead[row]), pa.array(last - first + LENGTH)], names=["doc", "at", "bytes"])

    waiting: list[pa.RecordBatch] = []
    n = 0
    for b in batches:
        if not b.num_rows:
            continue
        anchor = b.column(0).to_numpy()
        while n + b.num_rows > rows_at_once:
            # The next anchor's first row, where the collection may end.
            begins = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
            if n and anchor[0] != waiting[-1].column(0)[-1].as_py():
                begins = np.concatenate(([0], begins))
            begins = begins[begins >= rows_at_once - n]
            if not len(begins):
                break
            waiting.append(b.slice(0, int(begins[0])))
            yield work(pa.Table.from_batches(waiting))
            waiting, n = [], 0
            b, anchor = b.slice(int(begins[0])), anchor[int(begins[0]) :]
        waiting.append(b)
        n += b.num_rows
    if waiting:
        yield work(pa.Table.from_batches(waiting))


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for text, spans in zip(b.column(1), b.column(2), strict=True):
            raw = memoryview(text.as_buffer() or b"")
            kept, removed, n = [], 0, 0
            at = 0
            if spans.is_valid:
                lo = spans.values.field(0).to_numpy(zero_copy_only=False) & ((1 << 40) - 1)
                hi = lo + spans.values.field(1).to_numpy(zero_copy_only=False)
                order = np.argsort(lo, kind="stable")
                end = -1
                for i, j in zip(lo[order].tolist(), hi[order].tolist(), strict=True):
                    if i > end:
                        n += 1
                        kept.append(raw[max(at, 0) : i])
                        removed += j - i
                        end = j
                    elif j > end:
                        removed += j - end
                        end = j
                    at = end
            kept.append(raw[at:])
            out.append((len(raw), removed, n, b"".join(kept)))
        cols = list(zip(*out, strict=True)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array([hashlib.sha256(x).hexdigest() for x in cols[3]], pa.string()), pa.array(cols[3], pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def _with_copies(docs: DataFrame) -> DataFrame:
    """``doc, copy, text``: copy numbers the texts of a repeated id; a null id counts after all others."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("doc"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    if rows.groupBy("doc").count().where("count > 1").isEmpty():
        return rows.withColumn("copy", F.lit(0).cast("long"))
    texts = rows.select("doc", F.sha2("text", 256).alias("sha")).distinct()
    many = texts.groupBy("doc").count().where("count > 1").select("doc")
    # Written, so that its size is known: where few ids have several texts, numbering them does not shuffle the texts.
    numbered = stored(texts.join(many, "doc").selectExpr("doc", "sha", "cast(row_number() over (partition by doc order by sha) - 1 as bigint) as copy"), "repeats-copies")
    if numbered.isEmpty():
        return rows.withColumn("copy", F.lit(0).cast("long"))
    return stored(rows.withColumn("sha", F.sha2("text", 256)).join(numbered, ["doc", "sha"], "left").withColumn("copy", F.coalesce("copy", F.lit(0).cast("long"))).drop("sha"), "repeats-docs")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` for every row of ``docs (doc_id, text)``.

    Null texts are empty. Rows that repeat an id and text are one document and get the same result; other texts of a
    repeated id follow each other in order of their SHA-256. Null ids come last, as the id 2^63 - 1, with its texts where a row
    has it. Texts shorter than a window lose nothing; other columns are ignored; an empty table gives none.
    """
    rows = _with_copies(docs)
    copy = F.shiftright("at", 40).alias("copy")

    def settle(runs: DataFrame) -> DataFrame:
        return stored(runs.repartition("anchor").sortWithinPartitions("anchor", "context", "doc", "at").mapInArrow(_settle, "doc long, at long, shape long, open boolean, anchor long"), "repeats-runs")

    def with_text(runs: DataFrame, how: str = "merge") -> DataFrame:
        # A document's own runs: its length bounds the group.
        wanted = runs.groupBy("doc", copy).agg(F.collect_list(F.struct("at", "shape", "anchor")).alias("runs"))
        # The same columns and the same kind of join as at the end, so that both read one shuffle of the texts.
        return rows.join(wanted.hint(how), ["doc", "copy"]).select("doc", "text", "runs", "doc_id")

    settled = settle(rows.select("doc", "copy", "text").mapInArrow(_scan, "anchor long, context long, doc long, at long, shape long"))
    done, still, few = settled.where("not open"), settled.where("open"), []
    for step in CUTS:
        hot = stored(still.groupBy("anchor").count().where(F.col("count") > COLLECTION).select("anchor"), "repeats-hot")
        if hot.isEmpty():
            break
        few.append(still.join(hot, "anchor", "left_anti").select(*settled.columns))
        frequent = still.join(hot, "anchor", "left_semi")
        how = "broadcast" if frequent.count() <= SENT_RUNS else "merge"
        again = settle(with_text(frequent, how).mapInArrow(_cut(step), "anchor long, context long, doc long, at long, shape long"))
        done, still = done.union(again.where("not open")), again.where("open")
    contexts = with_text(reduce(DataFrame.union, few, still)).mapInArrow(_contexts, "anchor long, doc long, at long, shape long, bytes binary")
    compared = contexts.repartition("anchor").sortWithinPartitions("anchor", "doc", "at").mapInArrow(_compare, "doc long, at long, bytes long")
    spans = done.select("doc", "at", F.shiftright("shape", 10).alias("bytes")).union(compared)
    by_doc = spans.groupBy("doc", copy).agg(F.collect_list(F.struct("at", "bytes")).alias("spans"))
    return rows.join(by_doc.hint("merge"), ["doc", "copy"], "left").select("doc_id", "text", "spans").mapInArrow(_apply, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
