"""Line dedup with two Bloom filters, for keys seen once and seen twice.

A line's key is the line stripped of ASCII white space and lower-cased (A-Z).
Keys of at least ``min_chars`` code points that occur in two or more
documents lose all their lines except those of the smallest doc_id.

Pass 1: every task hashes its distinct (document, key) pairs into filters of
``m`` bits, as sorted bit positions by segment of 65,536 bits; the segments
meet in a shuffle, where a bit that two insertions set passes into the
"twice" filter.  The twice filter has at most ``max_filter_bits / 8`` bytes
whatever the input, so it may be broadcast; a fuller filter only lets more
unique lines through to the exact step.  Pass 2: only keys whose bits are all
set in the twice filter are shuffled, as 128-bit BLAKE2b digests with their
document, for exact confirmation and the choice of the first document.
Pass 3 drops the confirmed lines.  A key that two documents hold always sets
its bits twice, so none is missed.

Defined cases: a null or empty text is one empty line; rows with the same id
are one document; a null id is a document that sorts after all others;
an empty table gives no rows; columns other than the id and the text are not
read by ``dedup_lines`` and are carried along by ``drop_lines``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SPACE, buffer, partitions, saved, slices, span_hashes, text_rows

SEGMENT = 1 << 16
BITS_PER_LINE, LINES_PER_DOC = 8, 16
MAX_HOT = 10_000            # keys whose verdicts are broadcast (under 1 MB), the most frequent ones
LAST = 2**63 - 1            # stands for a null id: after all others
_NEWLINE = np.zeros(256, dtype=bool)
_NEWLINE[10] = True


class Lines:
    """The lines of a run of texts: where they begin and end, their keys'
    spans in the lower-cased bytes, and which keys are long enough."""

    def __init__(self, column: pa.Array, min_chars: int):
        raw, off = buffer(column)
        self.data = LOWER[raw]
        self.off = off
        cuts = np.flatnonzero(_NEWLINE[raw])
        # line starts, ends and rows ascend together, so each is sorted on its own
        self.start = np.sort(np.concatenate([off[:-1], cuts + 1]))
        self.end = np.sort(np.concatenate([off[1:], cuts]))
        self.row = np.sort(np.concatenate([np.arange(len(off) - 1), np.searchsorted(off[1:], cuts, side="right")]))
        solid = np.flatnonzero(~SPACE[raw])
        lo, hi = np.searchsorted(solid, self.start), np.searchsorted(solid, self.end)
        some = lo < hi
        self.key_start = np.where(some, solid[np.minimum(lo, max(len(solid) - 1, 0))] if len(solid) else 0, self.start)
        self.key_end = np.where(some, (solid[np.maximum(hi - 1, 0)] + 1) if len(solid) else 0, self.key_start)
        points = np.zeros(len(raw) + 1, dtype=np.int64)
        np.cumsum((raw & 0xC0) != 0x80, out=points[1:])
        self.long = np.flatnonzero(points[self.key_end] - points[self.key_start] >= min_chars)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.key_start[self.long], self.key_end[self.long], seed=7)

    def digest(self, line: int) -> bytes:
        return hashlib.blake2b(self.data[self.key_start[line]:self.key_end[line]].tobytes(), digest_size=16).digest()


def _positions(h: np.ndarray, bits: int) -> np.ndarray:
    """Two bit positions of each hash."""
    mask = np.uint64(bits - 1)
    return np.concatenate([h & mask, (h >> np.uint64(32)) & mask]).astype(np.int64)


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(LAST).to_numpy(zero_copy_only=False)


def filter_bits(n_docs: int, max_filter_bits: int) -> int:
    """A power of two, for about eight bits per line up to the bound."""
    wanted = max(SEGMENT, n_docs * BITS_PER_LINE * LINES_PER_DOC)
    return min(max_filter_bits, 1 << (wanted - 1).bit_length())


def twice_filter(rows: DataFrame, bits: int, min_chars: int) -> np.ndarray:
    """The packed filter of bits that at least two (document, key) pairs set."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, held = [], 0

        def flush():
            pos = np.sort(np.concatenate(once))
            seg = pos // SEGMENT
            cut = np.flatnonzero(np.diff(seg)) + 1
            parts = np.split((pos % SEGMENT).astype(np.uint16), cut)
            heads = seg[np.concatenate([[0], cut])]
            return pa.RecordBatch.from_arrays(
                [pa.array(heads.astype(np.int32)), pa.array([p.tobytes() for p in parts], pa.binary())], ["seg", "bits"])

        for part in slices(batches):
            lines = Lines(part.column("text"), min_chars)
            h, doc = lines.hashes(), _ids(part.column("doc_id"))[lines.row[lines.long]]
            if not len(h):
                continue
            order = np.lexsort((h, doc))
            h, doc = h[order], doc[order]
            new = np.ones(len(h), dtype=bool)
            new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
            once.append(_positions(h[new], bits))
            held += len(once[-1])
            if held > 1 << 21:
                yield flush()
                once, held = [], 0
        if held:
            yield flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg, count = None, None
        for batch in batches:
            for s, b in zip(batch.column("seg").to_pylist(), batch.column("bits").to_pylist()):
                if s != seg:
                    if seg is not None:
                        yield packed(seg, count)
                    seg, count = s, np.zeros(SEGMENT, dtype=np.uint8)
                count = np.minimum(count + np.minimum(np.bincount(np.frombuffer(b, np.uint16), minlength=SEGMENT), 2)
                                   .astype(np.uint8), 2)
        if seg is not None:
            yield packed(seg, count)

    def packed(seg, count):
        return pa.RecordBatch.from_arrays(
            [pa.array([seg], pa.int32()), pa.array([np.packbits(count > 1).tobytes()], pa.binary())], ["seg", "bits"])

    schema = "seg int, bits binary"
    met = (rows.mapInArrow(scan, schema).repartition(partitions(rows), "seg").sortWithinPartitions("seg")
           .mapInArrow(merge, schema))
    out = np.zeros(bits // 8, dtype=np.uint8)
    for r in met.collect():         # the filter's own size, at most
        out[r.seg * SEGMENT // 8:(r.seg + 1) * SEGMENT // 8] = np.frombuffer(r.bits, dtype=np.uint8)
    return out


def repeated_keys(rows: DataFrame, min_chars: int = 10, max_filter_bits: int = 1 << 28) -> DataFrame:
    """(doc_id, drops): for each document (a null id as the largest long) the
    digests of the keys whose lines it loses."""
    spark = rows.sparkSession
    bits = filter_bits(rows.count(), max_filter_bits)
    shared = spark.sparkContext.broadcast(twice_filter(rows, bits, min_chars))

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for part in slices(batches):
            lines = Lines(part.column("text"), min_chars)
            h = lines.hashes()
            pos = _positions(h, bits)
            hit = (table[pos >> 3] >> (7 - (pos & 7)).astype(np.uint8)) & 1
            at = lines.long[(hit[:len(h)] & hit[len(h):]).astype(bool)]
            if not len(at):
                continue
            doc = _ids(part.column("doc_id"))[lines.row[at]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc), pa.array([lines.digest(i) for i in at.tolist()], pa.binary())], ["doc_id", "digest"])

    seen = saved(rows.mapInArrow(suspects, "doc_id long, digest binary"), "line-suspects")
    first = saved(seen.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"),
                                             F.count("*").alias("n"))
                  .where("first < last").select("digest", "first", "n"), "line-first")
    # the most frequent keys meet their lines without a shuffle; any other key has at most 1 / MAX_HOT of all lines
    hot = F.broadcast(first.orderBy(F.col("n").desc(), "digest").limit(MAX_HOT).select("digest", "first"))
    rest = seen.join(hot, "digest", "left_anti").join(first.select("digest", "first"), "digest")
    return (seen.join(hot, "digest").unionByName(rest).where("doc_id > first")
            .groupBy("doc_id").agg(F.collect_set("digest").alias("drops")))


def _dropped(docs: DataFrame, min_chars: int, max_filter_bits: int, id_col: str, text_col: str) -> DataFrame:
    """(row, kept, n_lines, n_dropped): ``row`` holds all columns but the text."""
    drops = saved(repeated_keys(text_rows(docs, id_col, text_col), min_chars, max_filter_bits), "line-drops")
    others = [c for c in docs.columns if c != text_col]
    marked = (docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc_id"),
                          F.col(text_col).cast("string").alias("text"), F.struct(*others).alias("row"))
              .join(drops, "doc_id", "left").select("row", "text", "drops"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            text, n_lines, n_dropped = kept_lines(part.column("text"), part.column("drops"), min_chars)
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), text, n_lines, n_dropped], ["row", "kept", "n_lines", "n_dropped"])

    kind = marked.schema["row"].dataType.simpleString()
    return marked.mapInArrow(run, f"row {kind}, kept string, n_lines long, n_dropped long")


def drop_lines(docs: DataFrame, min_chars: int = 10, max_filter_bits: int = 1 << 28,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated lines gone from its text; other columns as
    they were.  A null text stays null."""
    done = _dropped(docs, min_chars, max_filter_bits, id_col, text_col)
    return done.select(*[F.col("kept").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])


def kept_lines(texts: pa.Array, drops: pa.Array, min_chars: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Texts without the lines whose digests are in ``drops``, with counts."""
    lines = Lines(texts, min_chars)
    total = np.bincount(lines.row, minlength=len(texts))
    gone = np.zeros(len(texts), dtype=np.int64)
    out = texts
    marked = np.flatnonzero(drops.is_valid().to_numpy(zero_copy_only=False))
    if len(marked):
        sets = {int(r): set(drops[int(r)].as_py()) for r in marked}
        dead = np.zeros(len(lines.row), dtype=bool)
        for line in lines.long[np.isin(lines.row[lines.long], marked)].tolist():
            dead[line] = lines.digest(line) in sets[int(lines.row[line])]
        gone = np.bincount(lines.row[dead], minlength=len(texts))
        raw, _ = buffer(texts)
        first = np.searchsorted(lines.row, np.arange(len(texts) + 1))
        values = texts.to_pylist()
        for r in np.flatnonzero(gone).tolist():
            live = [i for i in range(int(first[r]), int(first[r + 1])) if not dead[i]]
            values[r] = b"\n".join(raw[lines.start[i]:lines.end[i]].tobytes() for i in live).decode()
        out = pa.array(values, pa.string())
    return out, pa.array(total.astype(np.int64)), pa.array(gone.astype(np.int64))


def dedup_lines(docs: DataFrame, min_chars: int = 10, max_filter_bits: int = 1 << 28,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_lines, n_dropped and kept_sha256 of the kept text."""
    done = _dropped(text_rows(docs, id_col, text_col), min_chars, max_filter_bits, "doc_id", "text")
    return done.select("row.doc_id", "n_lines", "n_dropped",
                       F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))
