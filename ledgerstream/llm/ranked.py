"""Ranked lexical search over a length-stratified index.

A term's part of a document's score depends on the document by ``tf`` and the normaliser ``m`` alone. Documents of equal ``m`` are a
stratum; in it postings are in order of term and ``tf``, and what a (term, tf) run adds is computed once for all its documents.
The sum of each term's greatest part is the stratum's bound for an item: no document of it scores more.

Bounds order the visits. First each item visits the strata of its greatest bounds, and its k-th best score there is a threshold
that every final result reaches; then it visits those of the others whose bound reaches it, and no more. A stratum is cut
into segments of at most an Arrow batch of rows, which tasks visit alone, so one with a large share of all documents is many tasks' work.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Characters of items searched for in one go (their terms are sent to all tasks); strata each item visits first. They change no result.
ITEM_CHARS, FIRST = 4_000_000, 3
#: Visits (pairs of a stratum and an item, 4 bytes each) sent to all tasks, beyond which the index is shuffled to them.
SENT_VISITS = 2_000_000
#: A-Z in lower case, other letters' and digits' bytes as they are, everything else in ASCII a space.
TERM_BYTES = bytes(b if chr(b).isalnum() or b > 127 else 32 for b in range(256)).lower()


def terms_of(text: str | None) -> list[bytes]:
    """Runs of letters and digits of ASCII and of any other characters, only A-Z lower-cased, in order, with repeats."""
    return (text or "").encode("utf-8", "surrogatepass").translate(TERM_BYTES).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Query:
    """Items to search for: their terms by number, and each item's numbers."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        self.ids = [i for i, _ in items]
        self.number: dict[bytes, int] = {}
        self.of = [np.array(sorted({self.number.setdefault(t, len(self.number)) for t in terms_of(text)}), np.int64) for _, text in items]
        self.weights = np.zeros(len(self.number), np.int64)
        self.ends = np.cumsum([0, *map(len, self.of)])
        self.flat = np.concatenate([np.empty(0, np.int64), *self.of]).astype(np.int64)


class Segment:
    """Some documents of one stratum: for each (term, tf) run its part of the score, and the documents it is for."""

    def __init__(self, m: int, terms: np.ndarray, tfs: np.ndarray, docs: np.ndarray, n_docs: int, weights: np.ndarray):
        order = np.lexsort((tfs, terms))
        terms, tfs, self.docs, self.n_docs = terms[order], tfs[order], docs[order], n_docs
        first = np.flatnonzero(np.concatenate(([True], (terms[1:] != terms[:-1]) | (tfs[1:] != tfs[:-1])))) if len(terms) else np.empty(0, np.int64)
        tf = tfs[first]
        impact = weights[terms[first]] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
        self.parts = np.repeat(impact, np.diff(np.append(first, len(terms))))
        edges = np.searchsorted(terms, np.arange(len(weights) + 1))
        self.edges = edges
        # Runs of a term are in order of tf, and so of what they add: the last is the greatest.
        self.most = np.where(edges[1:] > edges[:-1], self.parts[np.maximum(edges[1:] - 1, 0)] if len(terms) else 0, 0)

    def bounds(self, query: Query) -> np.ndarray:
        run = np.concatenate(([0], np.cumsum(self.most[query.flat])))
        return run[query.ends[1:]] - run[query.ends[:-1]]

    def scores(self, terms: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n_docs, np.int64)
        for t in terms:
            a, b = self.edges[t], self.edges[t + 1]
            out[self.docs[a:b]] += self.parts[a:b]  # a document stands once under a term
        return out


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A list column's values, and how many each row has."""
    return column.flatten().to_numpy(), np.diff(column.offsets.to_numpy())


def _segments(b: pa.RecordBatch, weights: np.ndarray) -> Iterator[tuple[int, np.ndarray, Segment]]:
    """``m``, rows and postings of each stratum's part of a batch of ``m, ..., terms, tfs`` (the last two columns)."""
    m = b.column(0).to_numpy()
    (terms, sizes), (tfs, _) = _lists(b.column(b.num_columns - 2)), _lists(b.column(b.num_columns - 1))
    order = np.argsort(m, kind="stable")
    starts = np.concatenate(([0], np.cumsum(sizes)))
    for rows in np.split(order, np.flatnonzero(np.diff(m[order])) + 1):
        if not len(rows):
            continue
        n = sizes[rows]
        at = np.repeat(starts[rows] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        yield int(m[rows[0]]), rows, Segment(int(m[rows[0]]), terms[at].astype(np.int64), tfs[at], np.repeat(np.arange(len(rows)), n), len(rows), weights)


def postings(docs: DataFrame, query: Query) -> DataFrame:
    """``doc_id, n, terms, tfs`` of every row: its number of terms, and of the items' terms in it their numbers and counts."""
    sent = docs.sparkSession.sparkContext.broadcast(query.number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = sent.value
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                n, flat_t, flat_f, ends = [], [], [], [0]
                for x in part.column(1):
                    found = terms_of(x.as_py())
                    n.append(len(found))
                    for term, tf in Counter(found).items():
                        if (k := number.get(term)) is not None:
                            flat_t.append(k)
                            flat_f.append(tf)
                    ends.append(len(flat_t))
                ends = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(flat_t, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(flat_f, pa.int64()))], names=["doc_id", "n", "terms", "tfs"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


def document_frequencies(held: DataFrame) -> DataFrame:
    """``term, df`` by number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            term, df = np.unique(b.column(0).flatten().to_numpy(), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(term, pa.int32()), pa.array(df, pa.int64())], names=["term", "df"])

    return held.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))


def stratum_bounds(index: DataFrame, query: Query) -> DataFrame:
    """``m, item, bound`` (``item`` a number) of every stratum and item that share a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for m, _, segment in _segments(b, query.weights):
                bounds = segment.bounds(query)
                item = np.flatnonzero(bounds)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(item), m, np.int64)), pa.array(item, pa.int32()), pa.array(bounds[item])], names=["m", "item", "bound"])

    return index.select("m", "terms", "tfs").mapInArrow(run, "m long, item int, bound long").groupBy("m", "item").agg(F.max("bound").alias("bound"))


def visit(index: DataFrame, visits: DataFrame, query: Query, least: dict[int, int], k: int, sent: bool) -> DataFrame:
    """``item, doc_id, score`` of the ``k`` best of each task for each item, of documents in the strata of ``visits (m, item)`` that score
    ``least`` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, best = dict(least), {}
        for b in batches:
            wanted = b.column(2)
            for _, rows, segment in _segments(b, query.weights):
                bounds, ids = segment.bounds(query), b.column(1).take(pa.array(rows))
                keys = ids.fill_null((1 << 63) - 1).to_numpy()
                for item in wanted[int(rows[0])].as_py():
                    if not bounds[item] or bounds[item] < low.get(item, 1):
                        continue
                    scores = segment.scores(query.of[item])
                    at = np.flatnonzero(scores >= low.get(item, 1))
                    if len(at):
                        at = at[np.lexsort((keys[at], -scores[at]))[:k]]
                        # Null ids come last among equal scores.
                        found = sorted(best.get(item, []) + [(-int(scores[i]), d is None, d or 0) for i, d in zip(at.tolist(), ids.take(pa.array(at)).to_pylist(), strict=True)])[:k]
                        best[item] = found
                        if len(found) == k:
                            low[item] = max(low.get(item, 1), -found[-1][0])
        rows = [(item, None if null else d, -s) for item, found in best.items() for s, null, d in found]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in ((0, pa.int32()), (1, pa.int64()), (2, pa.int64()))], names=["item", "doc_id", "score"])

    by_stratum = visits.groupBy("m").agg(F.collect_list("item").alias("items"))
    return index.join(F.broadcast(by_stratum) if sent else by_stratum, "m").select("m", "doc_id", "items", "terms", "tfs").mapInArrow(run, "item int, doc_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _search(docs: DataFrame, items: list[tuple[int | None, str | None]], k: int) -> DataFrame | None:
    query = Query(items)
    held = stored(postings(docs, query), "postings")
    n_docs, length = held.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    if not n_docs or not query.number:
        return None
    for r in document_frequencies(held).collect():
        query.weights[r.term] = weight(n_docs, r.df)
    # Strata are contiguous, and one with a large share of all documents is spread over several ranges.
    rows = held.where("size(terms) > 0").selectExpr(f"10 + (90 * n * {n_docs}L) div {length}L as m", "doc_id", "terms", "tfs")
    index = stored(rows.repartitionByRange("m", "doc_id").sortWithinPartitions("m", "doc_id"), "strata")
    bounds = stored(stratum_bounds(index, query), "stratum-bounds")
    order = Window.partitionBy("item").orderBy(F.desc("bound"), "m")
    ranked = stored(bounds.withColumn("place", F.row_number().over(order)), "visits")
    sent = ranked.count() <= SENT_VISITS
    seen = stored(visit(index, ranked.where(F.col("place") <= FIRST), query, {}, k, sent), "first-visits")
    least = {r["item"]: r.score for r in _best(seen, k).where(F.col("rank") == k).select("item", "score").collect()}
    reached = docs.sparkSession.createDataFrame([*least.items()] or [(-1, 0)], "item int, least long")
    more = ranked.where(F.col("place") > FIRST).join(F.broadcast(reached), "item", "left").where("least is null or bound >= least")
    found = _best(seen.unionByName(visit(index, more, query, least, k, sent)), k)
    named = docs.sparkSession.createDataFrame([*enumerate(query.ids)], "item int, item_id long")
    return found.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of the greatest score above 0 for each row of ``items (item_id, text)``.

    Items and documents are taken whole; null texts have no terms, and items without any get no rows. Each row of ``docs (doc_id, text)`` is
    a document, repeated ones too; of equal scores the lesser doc_id comes first, null ones last. Rows of ``items`` that repeat id and
    text are one item, other texts of a repeated id items of their own. An empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    named = stored(items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct(), "items")
    parts = max(1, -(-(named.agg(F.sum(F.length("text"))).first()[0] or 0) // ITEM_CHARS))
    found = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for i in range(parts):  # so many items are searched for together as one task's memory can hold
        some = named.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == i).orderBy("item_id").collect()
        one = _search(docs, [(r.item_id, r.text) for r in some], k)
        if one is not None:
            found = found.unionByName(one)
    return found
