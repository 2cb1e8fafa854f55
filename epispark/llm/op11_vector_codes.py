"""Vector code compression: product codes found by a GNAT over each codebook.

Components become integers floor(scale * x); a vector is cut into equal parts
and every part is named by the nearest entry of its position's codebook
(squared Euclidean distance, ties to the lower index).  Codebooks start as the
parts of the smallest ids and take the componentwise floor of their parts'
means in each round.

Search.  The entries of a codebook form a GNAT (geometric near-neighbour
access tree): a node's split points are far apart, every other entry goes to
its nearest split point, and for each pair (split point, child) the range of
distances between them is kept.  A query that stands d away from a split point
and has an entry at distance r needs a child only if the child's range meets
[d - r, d + r].  Distances are square roots of integers; the comparison leaves
a margin of 1e-12 on both sides, so a subtree goes only if all its entries are
strictly farther, and whatever is visited is compared by integers.

Scale.  Each round is one scan: tasks add up parts per entry and send one row
per sum, in limbs of 30 bits, which Spark adds up; the driver holds codebooks
alone (``entries`` vectors).  Searching keeps the batch's integers in memory.
Sums per label meet their rows by broadcast for the most frequent labels.

Defined cases: rows whose vector is null or holds a null, a NaN or an infinity
are dropped.  The width is that of the first row (by id, null last, then by
vector) whose length is a positive multiple of ``parts``; rows of any other
length stay with null code and error and shape no codebook.  Fewer rows than
entries give smaller codebooks.  Repeated rows count as often as they come; a
null id sorts last; null labels are one label.  Components of any finite size
are exact (Python integers where 64 bits are too few); an error beyond a long
is returned as the largest long.  An empty table gives no rows.  Other columns
are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, saved

NARROW = 1 << 24            # integers below it stay in 64 bits, squares and sums included
MARGIN = 1e-12
LONGEST = (1 << 63) - 1
BATCH = 4096
DEGREE = 8


def floored(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), exactly; Python integers where 64 bits may not do."""
    with np.errstate(over="ignore"):
        y = np.floor(x * scale)
    if not y.size or np.abs(y).max() < NARROW:
        return y.astype(np.int64)
    return np.array([math.floor(Fraction(v) * scale) for v in x.ravel().tolist()], dtype=object).reshape(x.shape)


def entry_array(entries: list[list[int]]) -> np.ndarray:
    """A codebook as an array, of 64-bit integers if they fit."""
    small = all(abs(v) < NARROW for e in entries for v in e)
    return np.array(entries, dtype=np.int64 if small else object).reshape(len(entries), -1)


def squared(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    diff = q - p
    return (diff * diff).sum(axis=1)


def _real(d2: np.ndarray) -> np.ndarray:
    """Distances from squared ones; beyond the range of floats: infinite."""
    if d2.dtype == object:
        d2 = np.array([float(v) if v < 1 << 1000 else math.inf for v in d2.tolist()])
    return np.sqrt(d2.astype(np.float64))


class Gnat:
    """Nearest-entry search over the rows of a codebook."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.root = self._node(np.arange(len(points)))

    def _node(self, ids: np.ndarray) -> tuple:
        """(split points, children, nearest and farthest member of child j from split point i)"""
        if len(ids) <= DEGREE:
            return ids, [], None, None
        picked, far = [0], None
        while len(picked) < DEGREE:             # each split point is the entry farthest from those before
            d = _real(squared(self.points[ids], self.points[ids[picked[-1]]]))
            d[picked] = -1
            far = d if far is None else np.minimum(far, d)
            picked.append(int(np.argmax(far)))
        splits, rest = ids[picked], np.delete(ids, picked)
        dist = np.stack([_real(squared(self.points[rest], self.points[s])) for s in splits])
        home = dist.argmin(axis=0)
        groups = [np.flatnonzero(home == j) for j in range(DEGREE)]
        groups = [g for g in groups if len(g)]
        low = np.stack([dist[:, g].min(axis=1) for g in groups], axis=1)
        high = np.stack([dist[:, g].max(axis=1) for g in groups], axis=1)
        near = [int(home[g[0]]) for g in groups]
        return splits, [(near[k], self._node(rest[g])) for k, g in enumerate(groups)], low, high

    def nearest(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of every row of ``q``."""
        index = np.zeros(len(q), dtype=np.int64)
        best = squared(q, self.points[0])
        self._visit(self.root, q, np.arange(len(q)), index, best)
        return index, best

    def _visit(self, node: tuple, q: np.ndarray, rows: np.ndarray, index: np.ndarray, best: np.ndarray) -> None:
        splits, children, low, high = node
        if not len(rows):
            return
        own = q[rows]
        dist = []
        for s in splits.tolist():
            d2 = squared(own, self.points[s])
            closer = (d2 < best[rows]) | ((d2 == best[rows]) & (s < index[rows]))
            at = rows[closer.astype(bool)]
            best[at], index[at] = d2[closer.astype(bool)], s
            if children:
                dist.append(_real(d2))
        if not children:
            return
        dist = np.stack(dist)
        home = dist.argmin(axis=0)
        for k, (split, child) in enumerate(children):       # first where the nearest entry is likely
            self._visit(child, q, rows[home == split], index, best)
        for k, (split, child) in enumerate(children):
            radius = _real(best[rows])
            with np.errstate(invalid="ignore"):
                beyond = dist * (1 - MARGIN) > (high[:, k, None] + radius) * (1 + MARGIN)
                within = (dist + radius) * (1 + MARGIN) < low[:, k, None] * (1 - MARGIN)
            self._visit(child, q, rows[(home != split) & ~(beyond | within).any(axis=0)], index, best)


def limbs(value: int) -> list[tuple[int, int]]:
    """(limb number, signed limb of 30 bits) of an integer, zeros left out."""
    sign, rest, out, k = (1 if value >= 0 else -1), abs(value), [], 0
    while rest:
        if rest & 0x3FFFFFFF:
            out.append((k, sign * (rest & 0x3FFFFFFF)))
        rest >>= 30
        k += 1
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    """The vectors, all of one length, as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _assign(trees: list[Gnat], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, part) arrays: entry of each part and squared distance to it."""
    found = [tree.nearest(part) for tree, part in zip(trees, np.split(x, len(trees), axis=1))]
    return np.stack([i for i, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def _sums(vectors: DataFrame, books: list[np.ndarray], scale: int) -> DataFrame:
    """(part, entry, place, limb, value): sums of the parts that each entry
    takes; place -1 holds their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(b) for b in books]
        width = books[0].shape[1]
        total: dict[tuple[int, int], list[int]] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH):
                x = floored(_matrix(batch.column("vec").slice(start, BATCH)), scale)
                index, _ = _assign(trees, x)
                for p in range(len(trees)):
                    part = x[:, p * width:(p + 1) * width]
                    order = np.argsort(index[:, p], kind="stable")
                    entries, heads, counts = np.unique(index[order, p], return_index=True, return_counts=True)
                    sums = np.add.reduceat(part[order], heads, axis=0)
                    for e, n, s in zip(entries.tolist(), counts.tolist(), sums.tolist()):
                        old = total.get((p, e))
                        total[p, e] = [n, *s] if old is None else [a + b for a, b in zip(old, [n, *s])]
        rows = [(p, e, place - 1, k, v) for (p, e), values in total.items()
                for place, value in enumerate(values) for k, v in limbs(value)]
        if rows:
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int32()) for c in cols[:4]), pa.array(cols[4], pa.int64())],
                                             ["part", "entry", "place", "limb", "value"])

    return vectors.select("vec").mapInArrow(run, "part int, entry int, place int, limb int, value long")


def _better(vectors: DataFrame, books: list[np.ndarray], scale: int) -> list[np.ndarray]:
    """Codebooks of the means; at most one row per limb of a codebook's numbers comes back."""
    width = books[0].shape[1]
    total = [[[0] * (width + 1) for _ in book] for book in books]
    for r in _sums(vectors, books, scale).groupBy("part", "entry", "place", "limb").agg(F.sum("value").alias("value")).collect():
        total[r.part][r.entry][r.place + 1] += r.value << (30 * r.limb)
    return [entry_array([[s // t[0] for s in t[1:]] if t[0] else old for t, old in zip(sums, book.tolist())])
            for sums, book in zip(total, books)]


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()


def codebooks(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> list[np.ndarray]:
    """Final codebooks, one array (entry, place) per part, of ``vectors`` (vec_id, vec)
    with vectors of one length; [] if there are none."""
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vec").limit(entries).collect()
    if not first:
        return []
    start = floored(np.array([r.vec for r in first], dtype=np.float64), scale)
    books = [entry_array(p.tolist()) for p in np.split(start, parts, axis=1)]
    for _ in range(rounds):
        books = _better(vectors, books, scale)
    return books


def compress(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256,
             id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Per kept row: vec_id, code (two hex digits a part), error, label_error
    (error summed over the rows of the label) and codebooks_sha256.  ``entries``
    is 256 at most, ``scale`` a power of two."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"),
                           F.col(label_col).cast("string").alias("label"))
            .where(F.col("vec").isNotNull()).where(finite))
    fits = kept.where((F.size("vec") > 0) & (F.size("vec") % parts == 0))
    lead = fits.orderBy(F.col("vec_id").asc_nulls_last(), "vec").select(F.size("vec").alias("n")).limit(1).collect()
    width = lead[0].n if lead else -1
    even = kept.where(F.size("vec") == width)
    books = codebooks(even, parts, entries, rounds, scale)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(b) for b in books]
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH):
                part = batch.slice(start, BATCH)
                index, d2 = _assign(trees, floored(_matrix(part.column("vec")), scale))
                digits = index.astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), part.column("label"), pa.array([row.tobytes().hex() for row in digits], pa.string()),
                     pa.array([min(int(v), LONGEST) for v in d2.sum(axis=1).tolist()], pa.int64())],
                    ["vec_id", "label", "code", "error"])

    schema = "vec_id long, label string, code string, error long"
    none = F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")
    coded = even.mapInArrow(run, schema) if books else kept.limit(0).select("vec_id", "label", *none)
    rest = kept.where(F.size("vec") != width).select("vec_id", "label", *none)
    rows = saved(coded.unionByName(rest).withColumn("no_label", F.col("label").isNull())
                 .withColumn("label", F.coalesce("label", F.lit(""))), "vector-codes")
    summed = F.sum(F.col("error").cast("decimal(20,0)"))
    total = rows.groupBy("label", "no_label").agg(
        F.when(summed > LONGEST, F.lit(LONGEST)).otherwise(summed.cast("long")).alias("label_error"), F.count("*").alias("n"))
    return attach(rows, saved(total, "vector-labels"), ["label", "no_label"]).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
