"""SimHash near-duplicates: vantage-point trees over Hamming distance in shards that overlap.

``near_duplicates`` groups fingerprints exactly. 64 bits are cut into blocks, more than ``radius`` of them: two fingerprints
within ``radius`` bits agree wholly on the other blocks, so each goes to one shard for every choice of that many blocks, and
no pair is lost. Blocks are as many as give shards of about ``SHARD`` fingerprints, and shards of several choices' values are
put together up to that size. (Rings of distance alone would copy each fingerprint into most shards: distances of unlike
texts lie within 32 +- 4.) A shard that is still much larger is cut by rings of distance to two vantage points, and a
fingerprint nearer than ``radius`` to a ring's edge goes to both rings. Equal fingerprints are one row before any of this.

In a shard a tree is built: each node has a vantage point and the median distance to it, near ones inside, far ones
outside. All fingerprints of the shard are looked up at once; by the triangle inequality a branch is left out where its
distances and the query's differ by more than the bound. A shard returns a star a group, so k fingerprints cost k rows.

``keep_one`` finds texts of similar shingles, see there. Nodes are structs ``(lone, id, key)``: ``id`` the least doc_id of
rows with one fingerprint or text, ``lone`` where all of these have null ids, so that null ids come last; ``key`` tells
apart what shares an id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected_components, stored, unused

#: Fingerprints a shard holds, about; leaves of a tree; width of a ring. They change no result.
SHARD, LEAF, RING = 8192, 64, 16
NODE = "struct<lone:boolean,id:bigint,key:bigint>"


def shingle_hashes(text: str | None, words: int, seed: int = 42) -> np.ndarray:
    """XXH64 of all runs of ``words`` words, lower-cased in A-Z; the whole sequence where there are fewer; none without words."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens])
    starts = np.concatenate(([0], ends[:-1]))[: max(1, len(tokens) - words + 1)].tolist()
    ends = (ends[min(words, len(tokens)) - 1 :] - 1).tolist()
    h = xxhash.xxh64_intdigest
    return np.fromiter((h(joined[a:b], seed) for a, b in zip(starts, ends, strict=True)), np.uint64, len(starts))


def fingerprint_of(hashes: np.ndarray) -> int:
    """Signed 64-bit fingerprint; bit i is set if it is in over half of the hashes."""
    total = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 15):
        bits = np.unpackbits(hashes[i : i + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int32)
    packed = np.packbits((2 * total > len(hashes)).astype(np.uint8), bitorder="little")
    return int(packed.view("<i8")[0])


def simhash64(text: str | None, words: int = 4, seed: int = 42) -> int:
    return fingerprint_of(shingle_hashes(text, words, seed))


def fingerprints(docs: DataFrame, words: int = 4, seed: int = 42) -> DataFrame:
    """``doc_id, fp`` (signed long) for every row; null or wordless texts have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([simhash64(t.as_py(), words, seed) for t in b.column(1)], pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


def _distances(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int16)


class VantageTree:
    """A tree over unsigned 64-bit fingerprints. A node is (vantage point, greatest distance inside, inside, outside), a leaf
    an array of rows. ``nodes`` and ``compared`` count inner nodes and the pairs that reached a leaf."""

    def __init__(self, fp: np.ndarray):
        self.fp, self.nodes, self.compared = fp, 0, 0
        self.root = self._build(np.arange(len(fp)))

    def _build(self, rows: np.ndarray):
        if len(rows) <= LEAF:
            return rows
        for k in (0, len(rows) // 2, len(rows) - 1):  # where all are at one distance, another vantage point may tell them apart
            d = _distances(self.fp[rows], self.fp[rows[k]])
            cut = int(np.partition(d, len(d) // 2)[len(d) // 2])
            if (d > cut).sum() == 0:
                cut -= 1
            inside = d <= cut
            if 0 < inside.sum() < len(rows):
                self.nodes += 1
                return rows[k], cut, self._build(rows[inside]), self._build(rows[~inside])
        return rows

    def lookup(self, bound: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Each leaf with the rows that may be within their ``bound`` of it; bounds may be lowered on the way."""
        stack = [(self.root, np.arange(len(self.fp)))]
        while stack:
            node, rows = stack.pop()
            if not len(rows):
                continue
            if isinstance(node, np.ndarray):
                self.compared += len(rows) * len(node)
                yield rows, node
                continue
            vantage, cut, inside, outside = node
            d, b = _distances(self.fp[rows], self.fp[vantage]), bound[rows]
            stack.append((outside, rows[d + b > cut]))
            stack.append((inside, rows[d - b <= cut]))


class Groups:
    """Union-find over the rows of a shard, kept flat."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = self.of[a], self.of[b]
        differ = a != b
        if not differ.any():
            return
        pairs = np.unique(np.stack((np.minimum(a[differ], b[differ]), np.maximum(a[differ], b[differ]))), axis=1)
        to: dict[int, int] = {}

        def find(x: int) -> int:
            while (y := to.get(x, x)) != x:
                x = y
            return x

        for x, y in pairs.T.tolist():
            x, y = find(x), find(y)
            if x != y:
                to[max(x, y)] = min(x, y)
        lookup = np.arange(len(self.of))
        for x in to:
            lookup[x] = find(x)
        self.of = lookup[self.of]


def near_groups(fp: np.ndarray, radius: int) -> tuple[np.ndarray, VantageTree]:
    """For distinct fingerprints: each one's group, as the position of the group's first; and the tree."""
    fp = np.ascontiguousarray(fp).view(np.uint64)  # numpy counts the bits of a signed number's absolute value
    groups, tree = Groups(len(fp)), VantageTree(fp)
    for rows, leaf in tree.lookup(np.full(len(fp), radius, np.int16)):
        for i in range(0, len(rows), 4096):
            for j in range(0, len(leaf), 1024):
                x, y = np.nonzero(np.bitwise_count(fp[rows[i : i + 4096], None] ^ fp[None, leaf[j : j + 1024]]) <= radius)
                groups.join(rows[i : i + 4096][x], leaf[j : j + 1024][y])
    return groups.of, tree


def nearest_before(fp: np.ndarray, radius: int, most: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row, a row before it within ``radius``): for each row the ``most`` nearest ones, of equals the first."""
    fp = np.ascontiguousarray(fp).view(np.uint64)
    tree = VantageTree(fp)
    # Best so far, as distance above and row below, so that the order is that of one number.
    best = np.full((len(fp), most), (radius + 1) << 32, np.int64)
    bound = np.full(len(fp), radius, np.int16)
    for rows, leaf in tree.lookup(bound):
        for i in range(0, len(rows), 1024):
            r = rows[i : i + 1024]
            for j in range(0, len(leaf), 4096):
                c = leaf[j : j + 4096]
                d = _distances(fp[r, None], fp[None, c])
                d[c[None, :] >= r[:, None]] = 99
                hit = np.flatnonzero((d <= bound[r, None]).any(axis=1))
                if len(hit):
                    both = np.concatenate((best[r[hit]], (d[hit].astype(np.int64) << 32) + c), axis=1)
                    best[r[hit]] = np.partition(both, most - 1, axis=1)[:, :most]
                    bound[r[hit]] = np.minimum(best[r[hit]].max(axis=1) >> 32, radius)
    found = best >> 32 <= radius
    return np.nonzero(found)[0], best[found] & 0xFFFFFFFF


def _by_shard(batches: Iterator[pa.RecordBatch], n_keys: int, most: int = 1 << 17) -> Iterator[pa.Table]:
    """Rows sorted by their first ``n_keys`` columns, as tables of whole shards, some small ones at a time."""
    held: list[pa.RecordBatch] = []
    n = 0

    def starts(t: pa.Table) -> np.ndarray:
        differ = np.zeros(max(0, t.num_rows - 1), bool)
        for i in range(n_keys):
            x = t.column(i).to_numpy()
            differ |= x[1:] != x[:-1]
        return np.flatnonzero(differ) + 1

    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= most:
            t = pa.Table.from_batches(held)
            at = starts(t)
            if not len(at):
                most = 2 * n  # a shard goes on
                continue
            yield t.slice(0, int(at[-1]))
            held = t.slice(int(at[-1])).to_batches()
            n = t.num_rows - int(at[-1])
    if n:
        yield pa.Table.from_batches(held)


def _bounds(t: pa.Table, n_keys: int) -> np.ndarray:
    """Where shards of two rows or more begin and end."""
    differ = np.zeros(t.num_rows + 1, bool)
    differ[[0, -1]] = True
    for i in range(n_keys):
        x = t.column(i).to_numpy()
        differ[1:-1] |= x[1:] != x[:-1]
    at = np.flatnonzero(differ)
    return np.stack((at[:-1], at[1:]), axis=1)[np.diff(at) > 1]


def block_choices(n: int, radius: int, shard: int) -> list[list[tuple[int, int]]]:
    """For each shard key, the blocks (first bit, bits) two fingerprints within ``radius`` may agree on: the fewest that give
    ``n`` distinct fingerprints shards of about ``shard``. One empty choice, all in one shard, where ``n`` is below it."""
    from itertools import combinations

    if n <= shard:
        return [[]]
    for blocks in range(radius + 1, radius + 6):
        cuts = [64 * i // blocks for i in range(blocks + 1)]
        agree = blocks - radius
        if n >> (64 * agree // blocks) <= shard:
            break
    return [[(cuts[i], cuts[i + 1] - cuts[i]) for i in chosen] for chosen in combinations(range(blocks), agree)]


def links(distinct: DataFrame, radius: int = 4) -> DataFrame:
    """Stars ``(u, v)`` of nodes that connect exactly the fingerprints a chain of steps of ``radius`` bits or fewer connects.

    ``distinct`` has distinct longs ``fp`` with their ``node``. Rows without ``u`` report a shard's ``nodes`` and ``compared``.
    """
    n = distinct.count()
    choices, shards = block_choices(n, radius, SHARD), max(1, -(-n // SHARD))
    part = lambda lo, bits: F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << bits) - 1))
    of = lambda k, blocks: F.pmod(F.xxhash64(F.lit(k), *[part(*b) for b in blocks]), F.lit(shards)) + F.lit(k * shards)
    keyed = distinct.select("fp", "node", F.explode(F.array(*[of(k, blocks) for k, blocks in enumerate(choices)])).alias("shard"))
    sizes = keyed.groupBy("shard").agg(F.count("*").alias("n"), F.min("fp").alias("low"), F.max("fp").alias("high")).where(F.col("n") > 4 * SHARD).drop("n")
    rings = lambda v: F.expr(f"sequence(greatest(0, bit_count(fp ^ {v}) - {radius}) div {RING}, (bit_count(fp ^ {v}) + {radius}) div {RING})")
    cut = keyed.join(sizes, "shard", "left").withColumn("r", F.explode(F.when(F.col("low").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.flatten(F.transform(rings("low"), lambda x: F.transform(rings("high"), lambda y: x * 8 + y))))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _by_shard(batches, 2):
            fps, us, vs, nodes, compared = t.column(2).to_numpy(), [], [], 0, 0
            for lo, hi in _bounds(t, 2).tolist():
                group, tree = near_groups(fps[lo:hi], radius)
                moved = np.flatnonzero(group != np.arange(hi - lo))
                us.append(moved + lo)
                vs.append(group[moved] + lo)
                nodes, compared = nodes + tree.nodes, compared + tree.compared
            if not us:
                continue
            node = t.column(3).combine_chunks()
            u, v = (node.take(pa.array(np.concatenate(x))) for x in (us, vs))
            n = len(u)
            yield pa.RecordBatch.from_arrays([u, v, pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], names=["u", "v", "nodes", "compared"])
            yield pa.RecordBatch.from_arrays([pa.nulls(1, node.type), pa.nulls(1, node.type), pa.array([nodes]), pa.array([compared])], names=["u", "v", "nodes", "compared"])

    placed = cut.select("shard", F.col("r").cast("long").alias("r"), "fp", "node").repartition("shard", "r").sortWithinPartitions("shard", "r", "fp")
    return stored(placed.mapInArrow(run, f"u {NODE}, v {NODE}, nodes long, compared long"), "simhash-trees")


def _node(id_col: str, key: Column) -> Column:
    return F.struct(F.col(id_col).isNull().alias("lone"), F.coalesce(F.col(id_col), F.lit(0).cast("long")).alias("id"), key.alias("key"))


def near_duplicates(docs: DataFrame, radius: int = 4, words: int = 4, seed: int = 42) -> DataFrame:
    """``doc_id, fp, fingerprint, component_id`` for every row of ``docs (doc_id, text)``; other columns are ignored.

    Null and wordless texts have fingerprint zero and link like any other; rows with a null doc_id keep it and count
    for links, but no component is named after them. Repeated rows stay, each with its own row. An empty table gives none.
    Components settle in rounds; more than 60 of them (``max_rounds`` of ``connected_components``) raise rather than lose a link.
    """
    rows = stored(fingerprints(docs, words, seed), "simhash")
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")).select("fp", _node("first", F.col("fp")).alias("node")), "simhash-distinct")
    roots = connected_components(links(distinct, radius).where("u is not null"), "simhash-links")
    # Both sides of the last join are plain exchanges, so a fingerprint with a large share of all rows is split.
    of = stored(distinct.withColumnRenamed("node", "own").join(roots, F.col("own") == F.col("node"), "left").select("fp", F.coalesce("root", "own").alias("root")), "simhash-named")
    component = F.when(~F.col("root.lone"), F.col("root.id"))
    return rows.join(of, "fp").select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), component.alias("component_id"))


# -- Near-duplicates by similarity of shingles, for filtering --

#: A text stands in this many shards, each named by two of its least shingles: texts with 0.8 of their shingles in common
#: miss one with probability 1 - 0.8 ** 2, all six with 0.002. Their fingerprints differ in about 10 bits (0.002 over RADIUS).
SHARDS, RADIUS = 6, 18
_ORDERS = np.random.default_rng(7).integers(1, 1 << 63, 2 * SHARDS, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
#: Texts of which shingles are counted, about, and shingles that count as common, at most. They change no result.
COUNTED, COMMON = 20_000, 400_000
#: Buckets of a text's shingles, by which texts that can't be similar are told apart. They change no result.
BUCKETS = 64
#: Pairs that a task gives back at a time.
PAIRS = 10_000
#: Rows sent to all tasks (about 50 bytes each), beyond which texts are shuffled to them.
SENT_ROWS = 300_000


def shard_names(hashes: np.ndarray) -> list[int]:
    """Names of a text's shards, by shingles alone; all texts without words share one."""
    if not len(hashes):
        return [0]
    least = np.array([(hashes * a).min() for a in _ORDERS])
    mixed = (least[0::2] ^ (least[1::2] >> np.uint64(29))) * _ORDERS[:SHARDS] + least[1::2]
    return mixed.view(np.int64).tolist()


def _common(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that many texts hold, in order, and how many of ``COUNTED`` texts do. They only say which shingles ``prefix`` takes last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [np.unique(shingle_hashes(t.as_py(), words)) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], names=["s"])

    texts = docs.select(_text_hash().alias("h"), F.col("text").cast("string"))
    one_of = max(1, docs.count() // COUNTED)
    counts = stored(texts.where(F.pmod(F.xxhash64("h"), F.lit(one_of)) == 0).dropDuplicates(["h"]).mapInArrow(run, "s long").groupBy("s").agg(F.count("*").alias("n")).where("n > 1"), "similar-common")
    # The least count with which those of it and more are COMMON at most.
    least, held = 1 << 62, 0
    for r in counts.groupBy("n").agg(F.count("*").alias("shingles")).orderBy(F.desc("n")).collect():
        if (held := held + r.shingles) > COMMON:
            break
        least = r.n
    top = counts.where(F.col("n") >= F.lit(least)).toArrow()
    values = top.column("s").to_numpy().view(np.uint64)
    order = np.argsort(values)
    return values[order], top.column("n").to_numpy().astype(np.int32)[order]


def bucket_counts(distinct: np.ndarray) -> bytes:
    """How many of a text's distinct shingles fall into each bucket, 255 at most: sums of the differences of two texts are at most the shingles of one alone."""
    return np.minimum(np.bincount((distinct % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS), 255).astype(np.uint8).tobytes()


def prefix(hashes: np.ndarray, similarity: float, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The first distinct shingles in an order that all texts share, rare ones first: as many as a similar text can't miss altogether.

    Similar texts share at least ``similarity`` of each one's shingles, so the first shingle they share is among these of both."""
    if not len(hashes):
        return np.zeros(1, np.uint64)  # texts without words are similar to one another alone
    distinct = np.unique(hashes)
    often = np.zeros(len(distinct), np.int64)
    if len(common[0]):
        at = np.minimum(np.searchsorted(common[0], distinct), len(common[0]) - 1)
        often = np.where(common[0][at] == distinct, common[1][at], 0)
    most = len(distinct) - int(np.ceil(similarity * len(distinct) - 1e-6)) + 1
    return distinct[np.argsort(often, kind="stable")][:most]


def _sketches(docs: DataFrame, words: int, similarity: float) -> DataFrame:
    """``doc_id, h, fp, shards, size, buckets, prefix`` of every row; ``h`` tells texts apart, ``size`` counts distinct shingles."""
    common = _common(docs, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                fps, names, sizes, buckets, prefixes = [], [], [], [], []
                for t in part.column(2):
                    x = shingle_hashes(t.as_py(), words)
                    fps.append(fingerprint_of(x))
                    names.append(shard_names(x))
                    distinct = np.unique(x)
                    sizes.append(len(distinct))
                    buckets.append(bucket_counts(distinct))
                    prefixes.append(prefix(x, similarity, common).view(np.int64))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(fps, pa.int64()), pa.array(names, pa.list_(pa.int64())), pa.array(sizes, pa.int32()), pa.array(buckets, pa.binary()), pa.array(prefixes, pa.list_(pa.int64()))], names=["doc_id", "h", "fp", "shards", "size", "buckets", "prefix"])

    return docs.select(F.col("doc_id").cast("long"), _text_hash().alias("h"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, h long, fp long, shards array<long>, size int, buckets binary, prefix array<long>")


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _pick(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """``docs`` joined with ``ids (_doc_id, _h, ...)`` by id and text."""
    of, h = unused(docs, "_doc_id"), unused(docs, "_h")
    ids = ids.withColumnsRenamed({"_doc_id": of, "_h": h})
    on = F.col("doc_id").cast("long").eqNullSafe(F.col(of)) & (_text_hash() == F.col(h))
    return docs.join(F.broadcast(ids) if ids.count() <= SENT_ROWS else ids, on, how)


def near_pairs(texts: DataFrame, radius: int = RADIUS, nearest: int = 8) -> DataFrame:
    """Pairs ``(u, v)`` of nodes that are likely similar: in each shard, a text and the ``nearest`` ones before it, in the order of nodes."""
    keyed = texts.select(F.explode(F.array_distinct("shards")).alias("shard"), "node", "fp")
    # A large shard is cut into pieces, and each two of them (a piece with itself too) are one shard.
    pieces = keyed.groupBy("shard").agg(F.ceil(F.count("*") / (2 * SHARD)).alias("n")).where("n > 2")
    keyed = keyed.join(pieces, "shard", "left").select("shard", F.explode(_parts(F.col("n"), F.xxhash64("node"))).alias("part"), "node", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _by_shard(batches, 2):
            fps, us, vs = t.column(3).to_numpy(), [], []
            for lo, hi in _bounds(t, 2).tolist():
                u, v = nearest_before(fps[lo:hi], radius, nearest)
                us.append(u + lo)
                vs.append(v + lo)
            if us:
                node = t.column(2).combine_chunks()
                yield pa.RecordBatch.from_arrays([node.take(pa.array(np.concatenate(x))) for x in (us, vs)], names=["u", "v"])

    return keyed.repartition("shard", "part").sortWithinPartitions("shard", "part", "node").mapInArrow(run, f"u {NODE}, v {NODE}").distinct()


def _parts(n: Column, of: Column) -> Column:
    """The parts a row goes to where its group is cut into ``n`` pieces, each two of which meet in one; one part where ``n`` is null."""
    piece = F.pmod(of, n)
    return F.when(n.isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda k: F.least(piece, k) * n + F.greatest(piece, k)))


def pairs_in_groups(ends: np.ndarray, group: np.ndarray, size: np.ndarray, place: np.ndarray, before: np.ndarray, buckets: np.ndarray, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one shingle (rows up to ``ends``, by size) of different ``group`` that sizes, places in the prefixes and ``buckets`` let be similar.

    Texts whose shingles ``before`` this one are one and the same meet by that, too, and are left to it."""
    u, d = np.arange(len(ends)), 0
    slack = 1e-6
    while len(u):
        d += 1
        u = u[u + d < ends[u]]
        u = u[size[u] + slack >= similarity * size[u + d]]  # later rows are no smaller
        v = u + d
        # From the first shared shingle on, the rest of both must hold all they share.
        least = similarity / (1 + similarity) * (size[u] + size[v]) - slack
        fits = (group[u] != group[v]) & (np.minimum(size[u] - place[u], size[v] - place[v]) >= least)
        fits &= (before[u] != before[v]) | (place[u] == 0) | (place[v] == 0)
        for at in range(0, len(u), 1 << 16):
            some = np.flatnonzero(fits[at : at + (1 << 16)]) + at
            x, y = u[some], v[some]
            alone = np.abs(buckets[x].astype(np.int16) - buckets[y]).sum(axis=1, dtype=np.int64)
            may = alone <= size[x] + size[y] - 2 * least[some]
            if may.any():
                yield x[may], y[may]


def other_pairs(texts: DataFrame, similarity: float) -> DataFrame:
    """All pairs ``(u, v)`` of nodes of different ``root`` that may be similar: none that is similar is left out.

    Texts meet by the shingles of their prefixes. A shingle of one group alone has nothing to compare; groups of one shingle
    of any length are compared, in pieces of which each two meet."""
    entry = lambda x, i: F.struct(x.alias("key"), i.alias("place"), F.coalesce(F.get("prefix", i - 1), F.lit(0).cast("long")).alias("before"))
    keys = texts.select(F.explode(F.transform("prefix", entry)).alias("_e"), "node", "root", "size").select("_e.*", "node", "root", "size")
    live = stored(keys.groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key", F.when(F.col("n") > 4 * SHARD, F.ceil(F.col("n") / (2 * SHARD))).alias("n")), "similar-keys")
    met = keys.join(F.broadcast(live) if live.count() <= SENT_ROWS else live, "key").join(texts.select("node", "buckets"), "node")
    met = met.select("key", F.explode(_parts(F.col("n"), F.xxhash64("node"))).alias("part"), "size", "place", "root", "node", "before", "buckets")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _by_shard(batches, 2):
            bounds = _bounds(t, 2)
            ends = np.zeros(t.num_rows, np.int64)
            for lo, hi in bounds.tolist():
                ends[lo:hi] = hi
            node = t.column(5).combine_chunks()
            buckets = np.frombuffer(b"".join(t.column(7).to_pylist()), np.uint8).reshape(-1, BUCKETS)
            size, place, root, before = (t.column(i).to_numpy() for i in (2, 3, 4, 6))
            held, n = [], 0
            batch = lambda held: pa.RecordBatch.from_arrays([node.take(pa.array(np.concatenate(x))) for x in zip(*held, strict=True)], names=["u", "v"])  # noqa: B023, E731
            for u, v in pairs_in_groups(ends, root, size, place, before, buckets, similarity):
                for i in range(0, len(u), PAIRS):
                    held.append((u[i : i + PAIRS], v[i : i + PAIRS]))
                    n += len(held[-1][0])
                    if n >= PAIRS:
                        yield batch(held)
                        held, n = [], 0
            if n:
                yield batch(held)

    found = met.repartition("key", "part").sortWithinPartitions("key", "part", "size", "node").mapInArrow(run, f"u {NODE}, v {NODE}")
    return found.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def checked(docs: DataFrame, pairs: DataFrame, repeated: bool, words: int, similarity: float) -> DataFrame:
    """Those of ``pairs (u, v)`` of which the shared shingles are ``similarity`` of all."""
    wanted = stored(pairs.select("u").union(pairs.select("v")).distinct().select(F.col("u").alias("node"), F.when(~F.col("u.lone"), F.col("u.id")).alias("_doc_id"), F.col("u.key").alias("_h")), "similar-texts")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # 32 bits tell the shingles of two texts apart.
            found = [np.unique(shingle_hashes(t.as_py(), words).astype(np.uint32)).view(np.int32) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.int32()))], names=["node", "shingles"])

    picked = _pick(docs.select("doc_id", "text"), wanted, "inner").select("node", F.col("text").cast("string")).mapInArrow(sets, f"node {NODE}, shingles array<int>")
    # Only where rows repeat id and text a node has several.
    held = stored(picked.dropDuplicates(["node"]) if repeated else picked, "similar-shingles")
    both = pairs.join(held.select(F.col("node").alias("u"), F.col("shingles").alias("a")), "u").join(held.select(F.col("node").alias("v"), F.col("shingles").alias("b")), "v")
    shared = F.size(F.array_intersect("a", "b"))
    alike = shared >= similarity * (F.size("a") + F.size("b") - shared)  # two texts without words are alike
    return both.where(alike).select("u", "v")


def similar_groups(docs: DataFrame, rows: DataFrame, words: int = 5, similarity: float = 0.8, radius: int = RADIUS, nearest: int = 8) -> DataFrame:
    """``node, root`` of texts that links of ``similarity`` connect with another text, root the least node reachable.

    Near fingerprints come first, so that copies are together; then all texts of different groups that may be similar are compared."""
    repeated = not rows.groupBy("doc_id", "h").count().where("count > 1").isEmpty()
    texts = stored(rows.groupBy("h").agg(F.min("doc_id").alias("doc_id"), *[F.first(c).alias(c) for c in ("fp", "shards", "size", "buckets", "prefix")]).withColumn("node", _node("doc_id", F.col("h"))), "similar-distinct")
    pairs = stored(near_pairs(texts, radius, nearest), "similar-pairs")
    first = connected_components(checked(docs, pairs, repeated, words, similarity), "similar-links")
    # Of a root its hash is enough to tell it from others.
    of = first.select(F.col("node").alias("_n"), F.col("root.key").alias("root"))
    grouped = texts.join(of, F.col("node") == F.col("_n"), "left").select("node", F.coalesce("root", "h").alias("root"), "size", "buckets", "prefix")
    others = stored(other_pairs(grouped, similarity), "similar-others")
    more = stored(checked(docs, others, repeated, words, similarity), "similar-more")
    if more.isEmpty():
        return first
    return connected_components(more.unionByName(first.select(F.col("node").alias("u"), F.col("root").alias("v"))), "similar-all")


def keep_one(docs: DataFrame, words: int = 5, similarity: float = 0.8, radius: int = RADIUS, nearest: int = 8) -> DataFrame:
    """One row of each group of rows of ``docs`` with similar texts, that of the least doc_id; all columns as they are.

    Texts link where shared distinct ``words``-word shingles are ``similarity`` of all their shingles, checked on 32-bit hashes of
    them. Every such link counts: trees in the shards that least shingles name bring most of them together, of those before a text in a
    shard the ``nearest`` ones within ``radius`` bits; then all texts of different groups that share a shingle of their prefixes, as
    all similar texts do, are compared. ``nearest`` and ``radius`` change what is left for this, but no result.
    Components that need more than 60 rounds raise. Equal
    texts always link, and texts without words, null or not, are equal. Rows that repeat id and text are one; other texts
    of a repeated id stand for themselves. Null ids come last: one such row stays only where no row of its group has an id.
    """
    rows = stored(_sketches(docs, words, similarity), "similar-sketches")
    roots = similar_groups(docs, rows, words, similarity, radius, nearest)
    first = rows.groupBy("h").agg(F.min("doc_id").alias("first")).select("h", _node("first", F.col("h")).alias("own"))
    root = first.join(roots, F.col("own") == F.col("node"), "left").select("h", F.coalesce("root", "own").alias("root"))
    mine = rows.select("doc_id", "h").join(root, "h").select(F.col("doc_id").alias("_doc_id"), F.col("h").alias("_h"), (_node("doc_id", F.col("h")) == F.col("root")).alias("stays"))
    seen = stored(mine.groupBy("_doc_id", "_h", "stays").agg(F.count("*").alias("n")).where("not stays or n > 1"), "similar-others")
    kept = _pick(docs, seen.where("not stays").select("_doc_id", "_h"), "left_anti")
    again = seen.where("stays").select("_doc_id", "_h")
    if again.isEmpty():
        return kept
    # Rows that repeat id and text: one of each.
    h = unused(docs, "_h")
    repeated = _pick(docs, again, "left_semi").withColumn(h, _text_hash()).dropDuplicates(["doc_id", h]).drop(h)
    return _pick(kept, again, "left_anti").unionByName(repeated)
