"""Near-duplicate vectors: a pigeonhole join over low-dimensional blocks of rotated vectors.

Unit vectors of cosine ``c`` or more are within the squared distance ``2 - 2c``. They are rotated (signs, permutation, Hadamard, so
that no block holds more than its part of what differs) and cut into blocks; a pair within the whole budget is within a block's
proportional part of it in one block at least. So each block is range-joined alone, and the union of what the blocks find is
checked on whole vectors. A pair counts in the first block that finds it, which a task knows, as it has both vectors; so no pair is
written down anywhere, only a vector's number of links in a task and a star of its group there.

The range join of a block: some vectors are pivots, a vector's home is its nearest pivot, and it is a guest at each later pivot whose
cell can hold a vector within reach (by the distance to the plane between the two pivots). Homes meet homes and guests. Cells
of more than ``PIECE`` vectors, as a large group of near copies makes, are cut into pieces, each two of which meet in a task of their own.
Equal vectors are one row before any of this, with their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from .common import connected_components, stored
from .simhash import NODE, Groups, _bounds, _by_shard, _node

#: Vectors a pivot, and pivots at most (a sample, which the driver and all tasks hold); vectors of a piece. They change no result.
CELL, PIVOTS, PIECE = 16384, 1024, 16384
#: Rounding: what is nearer than SLACK to a bound is decided anew, in one fixed order of additions. COARSE is that of single precision,
#: in which a block's distances are first computed.
SLACK, MORE, COARSE = 1e-9, 1e-10, 2e-5
ROWS, COLUMNS = 1024, 4096


def unit(x: np.ndarray) -> np.ndarray:
    """Rows divided by their lengths, summed in a fixed order; rows may be of any scale."""
    y = x / np.abs(x).max(axis=1, keepdims=True)
    total = np.zeros(len(y))
    for j in range(y.shape[1]):
        total += y[:, j] * y[:, j]
    return y / np.sqrt(total)[:, None]


def rotate(u: np.ndarray) -> np.ndarray:
    """Signs and order by a fixed seed, then a Hadamard transform over the next power of two: lengths and angles stay.

    Each row's result is the same whatever other rows are there."""
    n, dim = u.shape
    wide = max(1, 1 << (dim - 1).bit_length())
    rng = np.random.default_rng(dim)
    x = np.zeros((n, wide))
    x[:, rng.permutation(wide)[:dim]] = u * rng.choice([-1.0, 1.0], dim)
    h = 1
    while h < wide:
        x = x.reshape(n, wide // (2 * h), 2, h)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2)
        h *= 2
    return x.reshape(n, wide) / np.sqrt(wide)


def cuts(wide: int, blocks: int) -> list[tuple[int, int]]:
    blocks = min(blocks, wide)
    at = [wide * i // blocks for i in range(blocks + 1)]
    return list(zip(at, at[1:], strict=False))


class Near:
    """Which vectors of two sets are linked, and found first by one block."""

    def __init__(self, cosine: float, blocks: int):
        self.cosine, self.blocks, self.budget = cosine, blocks, 2 - 2 * cosine

    def limits(self, wide: int) -> list[float]:
        return [self.budget * (b - a) / wide + MORE for a, b in cuts(wide, self.blocks)]

    def sides(self, x: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Two matrices in single precision: the product of the first and the second, turned, is a block's squared distances."""
        x = x[:, slice(*cuts(x.shape[1], self.blocks)[block])].astype(np.float32)
        square, one = (x * x).sum(axis=1, keepdims=True), np.ones((len(x), 1), np.float32)
        return np.hstack((-2 * x, square, one)), np.hstack((x, one, square))

    def tile(self, x: np.ndarray, y: np.ndarray, raw_x: np.ndarray, raw_y: np.ndarray, block: int) -> np.ndarray:
        """The matrix of pairs that are linked and that no earlier block finds."""
        places, limits = cuts(x.shape[1], self.blocks), self.limits(x.shape[1])
        cos = x @ y.T
        ok, unsure = cos >= self.cosine - SLACK, np.abs(cos - self.cosine) <= SLACK
        for k in range(block + 1):
            a, b = x[:, slice(*places[k])], y[:, slice(*places[k])]
            d = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T) - limits[k]
            unsure |= np.abs(d) <= SLACK
            ok &= d > -SLACK if k < block else d <= SLACK
        i, j = np.nonzero(ok & unsure)
        for at in range(0, len(i), 10_000):
            p, q = i[at : at + 10_000], j[at : at + 10_000]
            within = np.array([self.in_order(x[p], y[q], a, b) <= limit for (a, b), limit in zip(places[: block + 1], limits, strict=False)])
            ok[p, q] = (within.argmax(axis=0) == block) & within[block] & self.linked(raw_x[p], raw_y[q])
        return ok

    @staticmethod
    def in_order(x: np.ndarray, y: np.ndarray, a: int, b: int) -> np.ndarray:
        total = np.zeros(len(x))
        for j in range(a, b):
            total += (x[:, j] - y[:, j]) ** 2
        return total

    def linked(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Cosine of pairs of vectors as they came, in double precision."""
        x, y = x / np.abs(x).max(axis=1, keepdims=True), y / np.abs(y).max(axis=1, keepdims=True)
        dot, xx, yy = np.zeros(len(x)), np.zeros(len(x)), np.zeros(len(x))
        for j in range(x.shape[1]):
            dot, xx, yy = dot + x[:, j] * y[:, j], xx + x[:, j] ** 2, yy + y[:, j] ** 2
        return dot / np.sqrt(xx * yy) >= self.cosine

    def shard(self, raw: np.ndarray, weight: np.ndarray, left: np.ndarray, right: np.ndarray | None, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Of a task's vectors: each one's weight of linked ones, and its group's place. ``right`` None: ``left`` with itself."""
        x, count, groups = rotate(unit(raw)), np.zeros(len(raw), np.int64), Groups(len(raw))
        first, second = self.sides(x, block)
        other, limit = left if right is None else right, np.float32(self.limits(x.shape[1])[block] + COARSE)
        for i in range(0, len(left), ROWS):
            for j in range(i if right is None else 0, len(other), COLUMNS):
                a, b = left[i : i + ROWS], other[j : j + COLUMNS]
                near = first[a] @ second[b].T <= limit
                if right is None and j < i + ROWS:  # of a set with itself each pair once
                    near &= np.arange(j, j + len(b))[None, :] > np.arange(i, i + len(a))[:, None]
                rows = np.flatnonzero(near.any(axis=1))
                cols = np.flatnonzero(near[rows].any(axis=0))
                r, c = a[rows], b[cols]
                ok = near[np.ix_(rows, cols)]
                if len(rows):
                    ok &= self.tile(x[r], x[c], raw[r], raw[c], block)
                if not ok.any():
                    continue
                count[r] += ok @ weight[c]
                count[c] += weight[r] @ ok
                # Most of a dense group is joined by each one's first partner; what still differs then is little.
                here, there = np.flatnonzero(ok.any(axis=1)), np.flatnonzero(ok.any(axis=0))
                groups.join(r[here], c[ok[here].argmax(axis=1)])
                groups.join(r[ok[:, there].argmax(axis=0)], c[there])
                p, q = np.nonzero(ok & (groups.of[r][:, None] != groups.of[c][None, :]))
                groups.join(r[p], c[q])
        return count, groups.of


class Cells:
    """Homes and guests of vectors in each block, by pivots of their number of dimensions."""

    def __init__(self, pivots: list[np.ndarray], near: Near):
        self.near, self.of = near, {}
        for dim in {len(p) for p in pivots}:
            self.of[dim] = rotate(unit(np.stack([p for p in pivots if len(p) == dim])))

    def place(self, raw: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each block: rows, cells and whether at home."""
        x, rows = rotate(unit(raw)), np.arange(len(raw))
        pivots = self.of.get(raw.shape[1])
        for k, ((a, b), limit) in enumerate(zip(cuts(x.shape[1], self.near.blocks), self.near.limits(x.shape[1]), strict=True)):
            if pivots is None or len(pivots) == 1:
                yield k, rows, np.zeros(len(raw), np.int64), np.ones(len(raw), bool)
                continue
            p, reach = pivots[:, a:b], np.sqrt(limit) + SLACK
            square = (x[:, a:b] ** 2).sum(axis=1)[:, None] + (p**2).sum(axis=1)[None, :] - 2 * (x[:, a:b] @ p.T)
            home = square.argmin(axis=1)
            between = np.sqrt(np.maximum(0, (p**2).sum(axis=1)[:, None] + (p**2).sum(axis=1)[None, :] - 2 * (p @ p.T)))
            # Twice the distance between two pivots, times that from the plane half-way between them.
            over = square - square[rows, home][:, None] <= 2 * reach * between[home] + SLACK
            guest, cell = np.nonzero(over & (np.arange(len(p))[None, :] > home[:, None]))
            yield k, np.concatenate((rows, guest)), np.concatenate((home, cell)), np.arange(len(rows) + len(guest)) < len(rows)


def _vectors(column: pa.Array, kind: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of one length, and their values as doubles."""
    sizes = np.array([len(x.as_buffer()) for x in column], np.int64)
    for n in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == n)
        yield at, np.frombuffer(b"".join(column[int(i)].as_py() for i in at), kind).reshape(len(at), -1).astype(np.float64)


def _keyed(vectors: DataFrame, id_col: str, vector_col: str, kind: str) -> DataFrame:
    """``vec_id, v, k`` of every row: the components' bytes and a digest of them, null where a vector links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for x in b.column(1):
                v = None if x.values is None or x.values.null_count or not len(x.values) else x.values.to_numpy().astype(kind) + 0.0  # no negative zero
                out.append(v.astype(kind).tobytes() if v is not None and np.isfinite(v).all() and v.any() else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["vec_id", "v"])

    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<float>" if kind == "<f4" else "array<double>").alias("e"))
    return rows.mapInArrow(run, "vec_id long, v binary").withColumn("k", F.unhex(F.md5("v")))


def near_duplicates(vectors: DataFrame, cosine: float = 0.9, blocks: int = 4, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row: other vectors at ``cosine`` or more (above 0), the least id reachable by such links,
    and whether that is the row's own.

    Vectors that are null, empty or zero, or hold a null or a component that isn't finite, link with nothing, and so do vectors of
    different lengths. Repeated rows stay and link with each other. Rows with a null id keep it, count as links, and no
    component is named after them; ``kept`` is false there. An empty table gives none; other columns are ignored.
    """
    kind = "<f4" if isinstance(t := vectors.schema[vector_col].dataType, ArrayType) and isinstance(t.elementType, FloatType) else "<f8"
    near = Near(cosine, blocks)
    rows = stored(_keyed(vectors, id_col, vector_col, kind), "vectors")
    grouped = rows.where("k is not null").groupBy("k").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"), F.first("v").alias("v"))
    classes = stored(grouped.select("k", _node("first", F.xxhash64("k")).alias("node"), "n", "v"), "vector-classes")
    wanted = min(PIVOTS, -(-classes.count() // CELL))
    pivots = [np.frombuffer(r.v, kind).astype(np.float64) for r in classes.select("v", "k").orderBy(F.xxhash64("k"), "k").limit(wanted).collect()]

    def placed(whole: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cells = Cells(pivots, near)
            for b in batches:
                for start in range(0, b.num_rows, 1000):
                    part = b.slice(start, 1000)
                    for at, raw in _vectors(part.column(2), kind):
                        for block, r, cell, home in cells.place(raw):
                            for i in range(0, len(r), 20_000):
                                s = slice(i, i + 20_000)
                                n = len(r[s])
                                keys = [pa.array(np.full(n, raw.shape[1], np.int64)), pa.array(np.full(n, block, np.int64)), pa.array(cell[s].astype(np.int64)), pa.array(home[s])]
                                names = ["dim", "block", "cell", "home"]
                                if whole:
                                    yield pa.RecordBatch.from_arrays(keys + [c.take(pa.array(at[r[s]])) for c in part.columns], names=names + ["node", "n", "v"])
                                else:
                                    yield pa.RecordBatch.from_arrays(keys, names=names)

        schema = "dim long, block long, cell long, home boolean"
        return classes.select("node", "n", "v").mapInArrow(run, schema + (f", node {NODE}, n long, v binary" if whole else ""))

    zero = F.lit(0).cast("long")
    sizes = placed(False).groupBy("dim", "block", "cell").agg(F.ceil(F.count_if(F.col("home")) / PIECE).alias("homes"), F.ceil(F.count_if(~F.col("home")) / PIECE).alias("guests"))
    large = stored(sizes.where("homes > 1 or guests > 0").select("dim", "block", "cell", F.greatest("homes", F.lit(1).cast("long")).alias("homes"), "guests"), "vector-cells")
    # Pieces are numbered, homes before guests; a pair of pieces is one shard unless both are guests.
    homes, guests = F.coalesce("homes", F.lit(1).cast("long")), F.coalesce("guests", zero)
    own = F.when(F.col("home"), F.pmod(F.xxhash64("node"), homes)).otherwise(homes + F.pmod(F.xxhash64("node"), F.greatest(guests, F.lit(1).cast("long"))))
    others = F.sequence(zero, F.when(F.col("home"), homes + guests - 1).otherwise(homes - 1))
    dealt = placed(True).join(F.broadcast(large) if large.count() <= 4 * PIVOTS * blocks else large, ["dim", "block", "cell"], "left").select("dim", "block", "cell", own.alias("own"), F.explode(others).alias("other"), "node", "n", "v")
    dealt = dealt.select("dim", "block", "cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "n", "v")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _by_shard(batches, 5, 1 << 15):
            block, i, j, own = (t.column(k).to_numpy() for k in (1, 3, 4, 5))
            weight, us, vs, links = t.column(7).to_numpy(), [], [], []
            v = t.column(8).combine_chunks()
            for lo, hi in _bounds(t, 5).tolist():
                raw = np.frombuffer(b"".join(x.as_py() for x in v.slice(lo, hi - lo)), kind).reshape(hi - lo, -1).astype(np.float64)
                here = np.arange(hi - lo)
                left, right = (here, None) if i[lo] == j[lo] else (here[own[lo:hi] == i[lo]], here[own[lo:hi] != i[lo]])
                count, group = near.shard(raw, weight[lo:hi], left, right, int(block[lo]))
                at = np.flatnonzero(count)
                us, vs, links = us + [at + lo], vs + [group[at] + lo], links + [count[at]]
            if us:
                node = t.column(6).combine_chunks()
                yield pa.RecordBatch.from_arrays([node.take(pa.array(np.concatenate(us))), node.take(pa.array(np.concatenate(vs))), pa.array(np.concatenate(links))], names=["u", "v", "links"])

    keys = ["dim", "block", "cell", "i", "j"]
    found = stored(dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare, f"u {NODE}, v {NODE}, links long"), "vector-links")
    roots = connected_components(found.where("u <> v").select("u", "v"), "vector-groups")
    counts = found.groupBy("u").agg(F.sum("links").alias("links"))
    named = classes.select("k", F.col("node").alias("own"), "n").join(roots, F.col("own") == F.col("node"), "left")
    named = stored(named.join(counts, F.col("own") == F.col("u"), "left").select("k", F.coalesce("root", "own").alias("root"), (F.col("n") - 1 + F.coalesce("links", zero)).alias("n_links")), "vector-named")
    out = rows.select("vec_id", "k").join(named, "k", "left")
    component = F.when(F.col("root").isNull(), F.col("vec_id")).when(~F.col("root.lone"), F.col("root.id"))
    return out.select("vec_id", F.coalesce("n_links", zero).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
