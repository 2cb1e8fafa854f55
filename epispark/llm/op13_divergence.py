"""Source divergence audit: a k2-quadtree over the group-term count matrix.

A group is a (lang, source).  Each lang keeps the terms found in at least
``min_docs`` of its documents (V of them).  A group, and each lang, gives a
kept term the share p = 1 + floor(10**9 (count + 2) / (N + 2 V)), where N is
the sum of its counts; two shares are f = floor((p - q)**2 / (p + q)) apart.
Part ``pair`` has, for each group, every other source of its lang with f summed
over all kept terms; part ``term`` the kept terms that a group uses more than
its lang does, by f, ``top`` of them.

The matrix of a lang (a row per source, a column per kept term) is held as a
k2-quadtree with k = 2: leaves of 4 rows and 32 columns, and for each level the
sorted Morton codes of the quadrants that have a count.  A pair of groups
without a count for a term differs there by the same base f(p0, q0), so the
base times V is the price of an all-zero matrix, and uniform all-zero
quadrants add nothing to it.  Two blocks of rows are traversed jointly from the
root: quadrants empty on both sides are left at once; a leaf empty on one side
is priced from the counts of the other; leaves with counts on both sides are
compared cell by cell.  All of it in integers.

Plan.  Terms are counted in each task before the shuffle, so a frequent term
or a hot source travels as sums.  A lang's matrix is dealt into units: a pair
of row blocks (256 sources) and a share of the terms by hash, about 65,000
counts each; a unit returns one partial sum per pair of its sources and at most
``top`` terms per source.  Ranks are windows over one group's partners.

Defined cases: null text, lang and source are empty strings (a group of their
own); documents without terms, and langs without kept terms, still give their
groups, with value 0; repeated rows are documents of their own; equal values
rank by the item's UTF-8 bytes; a lang with one source has no pair row; an
empty table gives no rows.  Columns other than the three are not read.
Distinct terms of one task are told apart by 64-bit hashes before they are
counted (a chance of about n**2 / 2**65 for n terms), by themselves after.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, buffer, partitions, saved, slices, span_hashes, spans

ROWS, COLS = 4, 32              # cells of a leaf
ROW_BLOCK = 256                 # sources of a unit's side
UNIT_CELLS = 1 << 16
HELD = 1 << 20                  # counts a task holds before it sends them on
BREAKS = np.zeros(256, dtype=bool)
BREAKS[[*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True


def _texts(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The spans as strings."""
    size = end - start
    off = np.zeros(len(size) + 1, dtype=np.int32)
    np.cumsum(size, out=off[1:])
    at = np.repeat(start - off[:-1], size) + np.arange(off[-1])
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(off), pa.py_buffer(data[at]))


def _slice_counts(part: pa.RecordBatch, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(hash, group, count, documents) of a batch's terms, and its distinct hashes and terms."""
    data, off = buffer(part.column("text"))
    data = LOWER[data]
    s, e, at = spans(data, off, BREAKS)
    h = span_hashes(data, s, e, seed=13)
    doc = np.repeat(np.arange(part.num_rows), np.diff(at))
    order = np.argsort(h, kind="stable")            # by hash, then by document
    h, doc = h[order], doc[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    heads = np.flatnonzero(new)
    n = np.diff(np.append(heads, len(h)))
    h1, g1 = h[heads], codes[doc[heads]]
    first = np.ones(len(h), dtype=bool)
    first[1:] = h[1:] != h[:-1]
    pick = order[first]
    return (*_summed(h1, g1, n, np.ones(len(h1), dtype=np.int64)), h[first], _texts(data, s[pick], e[pick]))


def _summed(h: np.ndarray, g: np.ndarray, n: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Counts added up by (hash, group)."""
    if not len(h):
        return h, g, n, docs
    order = np.lexsort((g, h))
    h, g, n, docs = h[order], g[order], n[order], docs[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
    heads = np.flatnonzero(new)
    return h[heads], g[heads], np.add.reduceat(n, heads), np.add.reduceat(docs, heads)


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each group of ``docs`` (lang, source, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], int] = {}
        held, names, size = [], [], 0

        def flush() -> pa.RecordBatch:
            h, g, n, d = _summed(*(np.concatenate(c) for c in zip(*held)))
            known, first = np.unique(np.concatenate([k for k, _ in names]), return_index=True)
            terms = pa.concat_arrays([t for _, t in names]).take(pa.array(first))
            lang, source = (pa.array(c, pa.string()).take(pa.array(g)) for c in zip(*groups))
            return pa.RecordBatch.from_arrays([lang, source, terms.take(pa.array(np.searchsorted(known, h))), pa.array(n), pa.array(d)],
                                              ["lang", "source", "term", "n", "docs"])

        for part in slices(batches):
            pairs = list(zip(part.column("lang").to_pylist(), part.column("source").to_pylist()))
            codes = np.array([groups.setdefault(x, len(groups)) for x in pairs], dtype=np.int64)
            h, g, n, d, known, terms = _slice_counts(part, codes)
            if not len(h):
                continue
            held.append((h, g, n, d))
            names.append((known, terms))
            size += len(h)
            if size >= HELD:
                yield flush()
                groups, held, names, size = {}, [], [], 0
        if held:
            yield flush()

    return (docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term string, n long, docs long")
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def share(count: np.ndarray, total: np.ndarray, kept: int) -> np.ndarray:
    """1 + floor(10**9 (count + 2) / (total + 2 kept)), by long division in base 1000."""
    whole = np.asarray(total + 2 * kept)
    quotient, rest = np.divmod(np.asarray(count) + 2, whole)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, whole)
        quotient = quotient * 1000 + digit
    return quotient + 1


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _spread(x: np.ndarray) -> np.ndarray:
    """Bits of 32-bit numbers moved to the even places."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def morton(row: np.ndarray, col: np.ndarray) -> np.ndarray:
    return (_spread(row) << np.uint64(1)) | _spread(col)


class QuadTree:
    """The quadtree of one block of rows: ``p`` holds the shares of the cells
    (row, col), ``p0`` each row's share of a term without a count."""

    def __init__(self, row: np.ndarray, col: np.ndarray, p: np.ndarray, p0: np.ndarray, height: int):
        self.rows = -(-len(p0) // ROWS)
        self.p0 = np.ones((self.rows, ROWS), dtype=np.int64)
        self.p0.ravel()[:len(p0)] = p0
        code = morton(row // ROWS, col // COLS)
        order = np.argsort(code, kind="stable")
        self.row, self.p = row[order], p[order]
        leaves, self.first, at = np.unique(code[order], return_index=True, return_inverse=True)
        self.first = np.append(self.first, len(row))
        self.levels = [leaves]                      # codes of the quadrants with a count, leaves first
        for _ in range(height):
            self.levels.append(np.unique(self.levels[-1] >> np.uint64(2)))
        lead = np.zeros(len(leaves), dtype=np.int64)
        lead[at] = self.row // ROWS
        self.cells = np.repeat(self.p0[lead][:, :, None], COLS, axis=2)
        self.cells[at, self.row % ROWS, col[order] % COLS] = self.p

    def find(self, level: int, code: np.ndarray) -> np.ndarray:
        """Place of each quadrant in the level's list, -1 for all-zero ones."""
        codes = self.levels[level]
        if not len(codes):
            return np.full(len(code), -1)
        at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
        return np.where(codes[at] == code, at, -1)


def joint(a: QuadTree, b: QuadTree, same: bool, chunk: int = 2048) -> np.ndarray:
    """By leaf row of ``a``, of ``b`` and the rows in them: f summed over the
    columns, less the base of that pair of rows in each.  ``same``: one tree
    with itself, of which only the pairs of leaf rows (i, j) with i <= j are walked."""
    out = np.zeros((a.rows, b.rows, ROWS, ROWS), dtype=np.int64)
    base = apart(a.p0[:, None, :, None], b.p0[None, :, None, :])
    ra = rb = c = np.zeros(1, dtype=np.int64)
    at_a = at_b = np.zeros(0, dtype=np.int64)
    for level in range(len(a.levels) - 1, -1, -1):
        if level < len(a.levels) - 1:               # the eight children of a pair of quadrants
            ra, rb, c = (np.repeat(2 * x, 8) + np.tile(bit, len(x)) for x, bit in (
                (ra, [0, 0, 0, 0, 1, 1, 1, 1]), (rb, [0, 0, 1, 1, 0, 0, 1, 1]), (c, [0, 1, 0, 1, 0, 1, 0, 1])))
            real = (ra << level < a.rows) & (rb << level < b.rows)
            if same:
                real &= ra <= rb
            ra, rb, c = ra[real], rb[real], c[real]
        at_a, at_b = a.find(level, morton(ra, c)), b.find(level, morton(rb, c))
        some = (at_a >= 0) | (at_b >= 0)            # uniform all-zero quadrants are in the base
        ra, rb, c, at_a, at_b = ra[some], rb[some], c[some], at_a[some], at_b[some]
    both = np.flatnonzero((at_a >= 0) & (at_b >= 0))
    for i in range(0, len(both), chunk):
        k = both[i:i + chunk]
        f = apart(a.cells[at_a[k]][:, :, None, :], b.cells[at_b[k]][:, None, :, :]).sum(axis=3)
        np.add.at(out, (ra[k], rb[k]), f - COLS * base[ra[k], rb[k]])
    _one_sided(out, base, a, b, ra, rb, at_a, np.flatnonzero(at_b < 0), False)
    _one_sided(out, base, b, a, rb, ra, at_b, np.flatnonzero(at_a < 0), True)
    return out


def _one_sided(out: np.ndarray, base: np.ndarray, full: QuadTree, empty: QuadTree, own: np.ndarray, other: np.ndarray,
               at: np.ndarray, pairs: np.ndarray, turned: bool, chunk: int = 1 << 18) -> None:
    """Leaves with counts against rows without any there: the counts alone are priced."""
    size = full.first[at[pairs] + 1] - full.first[at[pairs]]
    ends = np.cumsum(size)
    start = 0
    while start < len(pairs):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + chunk, side="right")))
        k, n = pairs[start:stop], size[start:stop]
        cell = np.repeat(full.first[at[k]] - (ends[start:stop] - n - done), n) + np.arange(int(n.sum()))
        i, j, r = np.repeat(own[k], n), np.repeat(other[k], n), full.row[cell] % ROWS
        f = apart(full.p[cell][:, None], empty.p0[j])
        if turned:
            np.add.at(out.transpose(1, 0, 3, 2), (i, j, r), f - base.transpose(1, 0, 3, 2)[i, j, r])
        else:
            np.add.at(out, (i, j, r), f - base[i, j, r])
        start = stop


def _unit(rows: pa.Table, top: int) -> list[tuple]:
    """(lang, source, other, term, value) of one unit: partial sums of its
    pairs of sources (term null) and the first terms of its sources (other null)."""
    lang, i, j, g = (rows.column(c)[0].as_py() for c in ("lang", "i", "j", "g"))
    term = rows.column("term").combine_chunks()
    cell = term.is_valid().to_numpy(zero_copy_only=False)
    source = np.array(rows.column("source").to_pylist(), dtype=object)
    block, n, total, kept, lang_n, lang_total = (rows.column(c).combine_chunks().fill_null(0).to_numpy(zero_copy_only=False)
                                                 for c in ("block", "n", "total", "kept", "lang_n", "lang_total"))
    names = [sorted(source[~cell & (block == b)].tolist()) for b in (i, j)]
    totals = dict(zip(source[~cell].tolist(), total[~cell].tolist()))
    v = int(kept[0])
    words, column = np.unique(np.array(term.to_pylist(), dtype=object)[cell], return_inverse=True)
    # columns used by as many sources, and by the same first one, stand together: fuller and emptier quadrants
    place = {s: k for b in names for k, s in enumerate(b)}
    row = np.array([place[s] for s in source[cell].tolist()], dtype=np.int64)
    users = np.bincount(column, minlength=len(words))
    lead = np.full(len(words), len(source))
    np.minimum.at(lead, column, row + len(place) * (block[cell] == j))
    rank = np.empty(len(words), dtype=np.int64)
    rank[np.lexsort((lead, -users))] = np.arange(len(words))
    leaves = max(-(-len(words) // COLS), *(-(-len(b) // ROWS) for b in names), 1)
    height = (leaves - 1).bit_length()
    trees, p0s = [], []
    if v:
        p = share(n[cell], np.array([totals[s] for s in source[cell].tolist()], dtype=np.int64), v)
        for b, own in zip((i, j), names):
            mine = block[cell] == b
            p0 = share(np.zeros(len(own), dtype=np.int64), np.array([totals[s] for s in own], dtype=np.int64), v)
            trees.append(QuadTree(row[mine], rank[column[mine]], p[mine], p0, height))
            p0s.append(p0)
    out = []
    if v and names[0] and names[1]:
        sums = joint(trees[0], trees[1], i == j).transpose(0, 2, 1, 3).reshape(trees[0].rows * ROWS, -1)[:len(names[0]), :len(names[1])]
        if g == 0:
            sums = sums + v * apart(p0s[0][:, None], p0s[1][None, :])
    else:
        sums = np.zeros((len(names[0]), len(names[1])), dtype=np.int64)
    for x, a in enumerate(names[0]):
        for y in range(x + 1 if i == j else 0, len(names[1])):
            out.append((lang, a, names[1][y], None, int(sums[x, y])))
    if i == j and v and len(words):
        q = share(lang_n[cell], lang_total[cell], v)
        more = np.flatnonzero(p > q)
        value = apart(p, q)[more]
        order = np.lexsort((column[more], -value, row[more]))
        at = more[order]
        nth = np.arange(len(at)) - np.searchsorted(row[at], row[at])
        for k, f in zip(at[nth < top].tolist(), value[order][nth < top].tolist()):
            out.append((lang, names[0][row[k]], None, words[column[k]], f))
    return out


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10, text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank) of every group of ``docs``."""
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
                         for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    counts = saved(term_counts(rows), "divergence-counts")
    kept = saved(counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
                 .where(F.col("docs") >= min_docs).drop("docs"), "divergence-kept")
    cells = saved(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "divergence-cells")
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    groups = saved(rows.select("lang", "source").distinct()
                   .join(cells.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("cells")),
                         ["lang", "source"], "left").na.fill(0, ["total", "cells"]), "divergence-groups")
    blocks = F.ceil(F.count("*") / F.lit(ROW_BLOCK))
    shape = (groups.groupBy("lang").agg(blocks.cast("int").alias("blocks"), F.sum("cells").alias("cells"))
             .withColumn("shares", F.greatest(F.lit(1), F.ceil(F.col("cells") * F.least(F.lit(2), F.col("blocks"))
                                                              / F.col("blocks") / F.lit(UNIT_CELLS))).cast("int"))
             .drop("cells").join(langs, "lang", "left").na.fill(0, ["kept", "lang_total"]))
    shape = saved(shape, "divergence-shape")
    block = F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    every = ["lang", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "g", "source", "block", "term",
             "n", "total", "kept", "lang_n", "lang_total"]
    lone = F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("lang_n")
    heads = (groups.join(shape, "lang").withColumn("block", block).withColumn("other", others)
             .withColumn("g", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
             .select("*", *lone).select(*every))
    body = (cells.join(shape, "lang").withColumn("block", block).withColumn("other", others)
            .withColumn("g", F.pmod(F.xxhash64("term"), F.col("shares")).cast("int"))
            .withColumn("total", F.lit(0).cast("long")).select(*every))
    unit = ["lang", "i", "j", "g"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts = None, []

        def out() -> pa.RecordBatch:
            found = list(zip(*_unit(pa.Table.from_batches(parts), top))) or [[]] * 5
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in found[:4]), pa.array(found[4], pa.int64())],
                                              ["lang", "source", "other", "term", "value"])

        for batch in batches:
            tags = list(zip(*(batch.column(c).to_pylist() for c in unit)))
            start = 0
            for k in range(1, len(tags) + 1):
                if k == len(tags) or tags[k] != tags[start]:
                    if parts and tags[start] != key:
                        yield out()
                        parts = []
                    key = tags[start]
                    parts.append(batch.slice(start, k - start))
                    start = k
        if parts:
            yield out()

    found = saved(heads.unionByName(body).repartition(partitions(docs), *unit).sortWithinPartitions(*unit)
                  .mapInArrow(run, "lang string, source string, other string, term string, value long"), "divergence-parts")
    sums = found.where("term is null").groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    pairs = sums.select("lang", F.explode(F.array(
        F.struct("source", F.col("other").alias("item")), F.struct(F.col("other").alias("source"), F.col("source").alias("item"))
    )).alias("p"), "value").select("lang", "p.source", F.lit("pair").alias("part"), "p.item", "value")
    terms = found.where("term is not null").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    return pairs.withColumn("rank", rank).unionByName(terms.withColumn("rank", rank).where(F.col("rank") <= top))
