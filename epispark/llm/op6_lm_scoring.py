"""Language-model scores by deleted interpolation.

The model mixes two estimates of a token w after the token v before it:

    P(w | v) = (1 - l) p0(w) + l c(v w) / c(v)

with the smoothed unigram p0(w) = (c(w) + 1/2) / (N + (V + 1) / 2) and the
bigram's maximum-likelihood estimate.  The weight l belongs to the bucket of
the context's frequency, floor(log2 c(v)), and is learnt by expectation-
maximisation on deleted counts: each training token is held out of the counts
that predict it (one is taken off its own numerators and denominators).  As
only the ratio of the two estimates enters, all training tokens are gathered
into a histogram of that ratio by bucket (in 16ths of an octave, each with its tokens' mean place), which has a
fixed size, and EM runs on the histogram.

Counting.  Tasks gather documents into chunks of about ``chunk_tokens``
tokens and reduce each chunk to its distinct words and word pairs, as 56-bit
hashes with counts, so a frequent word or pair is one entry per chunk however
hot it is.  The entries are dealt by hash range to buckets (shuffle 1), where
they are added up; the totals go back to their chunks in the order in which
the entries came (shuffle 2), and each chunk gives every document the counts
of its tokens.  Tokens themselves are not shuffled one by one, and no count
table is broadcast or collected.  A chunk has one row of entries for each bucket
and kind, two buckets a shuffle partition; with many partitions these rows are
small, so they travel many to a batch, short ones uncompressed.

Defined cases: a null or empty text is the end token alone; rows with one id
are documents of their own, learnt from or held out together; a null id is
learnt from; with no training token every score is the uniform base over one
unknown; an empty table gives no rows; columns other than the id and the text
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SPACE, buffer, mix, partitions, saved, slices, span_hashes, spans, text_rows

END, START = np.uint64(0x656E64), np.uint64(0x7374617274)
HASH_BITS = 56
WORDS, PAIRS, HOME, TOTALS = 0, 1, 2, 3
BUCKETS, FINE, LOW = 40, 16, -64            # buckets of contexts; bins per octave; lowest octave of a ratio
BINS = FINE * 128 + 1                       # the first bin: ratio zero
WITHIN = 1 << 20                            # places within a bin
BATCH_BYTES, BATCH_ROWS = 4 << 20, 1024     # rows that travel together
SMALL = 64                                  # planes not worth compressing
WIRE = "dest int, kind int, chunk long, n long, keys binary, counts binary, extra binary"
NAMES = ["dest", "kind", "chunk", "n", "keys", "counts", "extra"]


def learnt(id_col: Column) -> Column:
    """Documents that the model learns from."""
    return ~held_out(id_col)


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(5)) == 1, F.lit(False))


def pack(x: np.ndarray) -> bytes:
    """Non-negative integers as byte planes, the lowest first."""
    x = np.ascontiguousarray(x, dtype="<u8")
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    return bytes([width]) + x.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def squeeze(x: np.ndarray) -> bytes:
    """``pack`` for what is shuffled: compressed, where that makes it shorter."""
    planes = pack(x)
    if len(planes) > SMALL:
        less = zstd.ZstdCompressor(level=1).compress(planes)
        if len(less) < len(planes):
            return b"z" + less
    return b"p" + planes


def expand(data: bytes) -> np.ndarray:
    return unpack(zstd.ZstdDecompressor().decompress(data[1:]) if data[:1] == b"z" else data[1:])


def unpack(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(data, dtype=np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").reshape(-1).astype(np.int64)


@dataclass
class Chunk:
    """Documents whose tokens lie end to end, as numbers of distinct words."""
    words: np.ndarray           # hash of each distinct word
    token: np.ndarray           # its number, token by token
    sizes: np.ndarray           # tokens of each document

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hash, first word, second word) of the distinct pairs, and each
        token's pair; the word before a text has the number len(words)."""
        before = np.empty_like(self.token)
        before[1:] = self.token[:-1]
        before[np.cumsum(self.sizes) - self.sizes] = len(self.words)
        code, which = np.unique(before * (len(self.words) + 1) + self.token, return_inverse=True)
        one, two = code // (len(self.words) + 1), code % (len(self.words) + 1)
        known = np.append(self.words, START)
        return mix(known[one] * np.uint64(0x9FB21C651E98DF25) + known[two]), one, two, which


def _order(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes cut to 56 bits, ascending, and the order that makes them so."""
    h = h >> np.uint64(64 - HASH_BITS)
    order = np.argsort(h, kind="stable")
    return h[order], order


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows (dest, kind, chunk, n, keys, counts, extra) as batches of bounded size."""
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], NAMES)

    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(map(len, row[4:]))
        if size >= BATCH_BYTES or len(held) >= BATCH_ROWS:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _entries(kind: int, chunk: int, h: np.ndarray, counts: np.ndarray, buckets: int) -> Iterator[tuple]:
    """The chunk's entries by bucket: ascending hashes as differences, and counts."""
    h, order = _order(h)
    counts = counts[order]
    dest = ((h >> np.uint64(HASH_BITS - 32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    cut = np.searchsorted(dest, np.arange(buckets + 1))
    for b in range(buckets):
        i, j = int(cut[b]), int(cut[b + 1])
        if i < j:
            yield b, kind, chunk, j - i, int(h[i]).to_bytes(8, "little") + squeeze(np.diff(h[i:j])), squeeze(counts[i:j]), b""


def _hashes(keys: bytes) -> np.ndarray:
    steps = np.concatenate([[int.from_bytes(keys[:8], "little")], expand(keys[8:])])
    return np.cumsum(steps)


def _chunks(chunk_tokens: int, buckets: int):
    """Tasks of the first kind: documents to chunks, chunks to entries."""

    def flush(number: int, ids: list, learn: list, sizes: list, hashes: list) -> Iterator[tuple]:
        size = np.concatenate(sizes)
        words, token, count = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
        hashes.clear()
        rank = np.argsort(-count, kind="stable")            # frequent words get small numbers
        place = np.empty_like(rank)
        place[rank] = np.arange(len(rank))
        c = Chunk(words[rank], place[token], size)
        del token
        train = np.repeat(np.concatenate(learn), size)
        yield from _entries(WORDS, number, c.words, np.bincount(c.token[train], minlength=len(words)), buckets)
        h, _, _, which = c.pairs()
        yield from _entries(PAIRS, number, h, np.bincount(which[train], minlength=len(h)), buckets)
        doc = np.concatenate(ids)
        yield (number % buckets, HOME, number, len(doc), c.words.tobytes(), squeeze(c.token),
               doc.tobytes() + size.astype(np.int64).tobytes() + np.concatenate(learn).tobytes())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        number, held = TaskContext.get().partitionId() << 24, 0
        ids, learn, sizes, hashes = [], [], [], []
        for part in slices(batches):
            raw, off = buffer(part.column("text"))
            data = LOWER[raw]
            s, e, at = spans(data, off, SPACE)
            h = span_hashes(data, s, e, seed=6)
            hashes.append(np.insert(h, at[1:], END))
            sizes.append(np.diff(at) + 1)
            ids.append(part.column("key").to_numpy(zero_copy_only=False))
            learn.append(part.column("learn").to_numpy(zero_copy_only=False))
            held += len(hashes[-1])
            if held >= chunk_tokens:
                yield from flush(number, ids, learn, sizes, hashes)
                number, held = number + 1, 0
                ids, learn, sizes, hashes = [], [], [], []
        if held:
            yield from flush(number, ids, learn, sizes, hashes)

    return lambda batches: _batches(rows(batches))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        columns = [batch.column(c) for c in NAMES]
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in columns)


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tasks of the second kind: the entries of a bucket to totals, given back
    in the order of each chunk's entries; homes pass."""
    return _batches(_added(batches))


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    group, held = None, []

    def flush() -> Iterator[tuple]:
        dest, kind = group
        h = np.concatenate([_hashes(k) for _, k, _ in held])
        parts = [expand(c) for _, _, c in held]
        own = np.concatenate(parts)
        distinct, which = np.unique(h, return_inverse=True)
        total = np.bincount(which, weights=own, minlength=len(distinct)).astype(np.int64)
        if kind == WORDS:
            yield dest, TOTALS, -1 - dest, int((total > 0).sum()), int(total.sum()).to_bytes(8, "little"), b"", b""
        start = 0
        for (chunk, _, _), part in zip(held, parts):
            n = len(part)
            yield dest, kind, chunk, n, b"", squeeze(total[which[start:start + n]]), b""
            start += n

    for dest, kind, chunk, n, keys, counts, extra in _rows(batches):
        if kind == HOME:
            yield dest, kind, chunk, n, keys, counts, extra
            continue
        if group != (dest, kind):
            if held:
                yield from flush()
            group, held = (dest, kind), []
        held.append((chunk, keys, counts))
    if held:
        yield from flush()


COUNTED = "doc_id long, learn boolean, n_tokens long, words binary, pairs binary, v long, n long"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tasks of the third kind: a chunk's totals to its documents."""
    names = ["doc_id", "learn", "n_tokens", "words", "pairs", "v", "n"]
    found = {WORDS: [], PAIRS: []}
    for _, kind, chunk, n, keys, counts, extra in _rows(batches):
        if kind == TOTALS:
            yield pa.RecordBatch.from_arrays(
                [pa.array([None], pa.int64()), pa.array([None], pa.bool_()), pa.array([None], pa.int64()),
                 pa.array([None], pa.binary()), pa.array([None], pa.binary()), pa.array([n], pa.int64()),
                 pa.array([int.from_bytes(keys, "little")], pa.int64())], names)
            continue
        if kind != HOME:
            found[kind].append(expand(counts))
            continue
        doc = np.frombuffer(extra, dtype=np.int64, count=n)
        sizes = np.frombuffer(extra, dtype=np.int64, count=n, offset=8 * n)
        learn = np.frombuffer(extra, dtype=bool, count=n, offset=16 * n)
        c = Chunk(np.frombuffer(keys, dtype=np.uint64), expand(counts), sizes)
        per_word = np.empty(len(c.words), dtype=np.int64)
        per_word[_order(c.words)[1]] = np.concatenate(found[WORDS])
        h, _, _, which = c.pairs()
        per_pair = np.empty(len(h), dtype=np.int64)
        per_pair[_order(h)[1]] = np.concatenate(found[PAIRS])
        found = {WORDS: [], PAIRS: []}
        one, two = per_word[c.token], per_pair[which]
        ends = np.cumsum(sizes)
        for i in range(0, n, 2000):
            js = range(i, min(n, i + 2000))
            cut = [(int(ends[j] - sizes[j]), int(ends[j])) for j in js]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[i:i + 2000]), pa.array(learn[i:i + 2000]), pa.array(sizes[i:i + 2000]),
                 pa.array([pack(one[a:b]) for a, b in cut], pa.binary()), pa.array([pack(two[a:b]) for a, b in cut], pa.binary()),
                 pa.nulls(len(js), pa.int64()), pa.nulls(len(js), pa.int64())], names)


def counted(docs: DataFrame, chunk_tokens: int = 2_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with the training counts of its tokens and token
    pairs, and rows (v, n) whose sums are V and N; written and read again."""
    n = partitions(docs)
    rows = text_rows(docs, id_col, text_col).select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("key"), learnt(F.col("doc_id")).alias("learn"), "text")
    entries = rows.mapInArrow(_chunks(chunk_tokens, 2 * n), WIRE)
    totals = entries.repartition(n, "dest").sortWithinPartitions("dest", "kind").mapInArrow(_add_up, WIRE)
    homes = totals.repartition(n, "chunk").sortWithinPartitions("chunk", F.expr("kind = 2"), "kind", "dest")
    return saved(homes.mapInArrow(_counted, COUNTED), "lm-counts", compression="zstd")


NO_ID = -2**63


def _estimates(one: np.ndarray, two: np.ndarray, deleted: int, n: int, v: int, docs: int):
    """(p0, bigram estimate, context bucket) of a document's tokens; the end
    token's count is that of the contexts before a text, ``docs``."""
    before = np.concatenate([[docs], one[:-1]]) - deleted
    p0 = (one - deleted + 0.5) / (n - deleted + 0.5 * (v + 1))
    ml = np.where(before > 0, (two - deleted) / np.maximum(before, 1), 0.0)
    bucket = np.where(before > 0, np.log2(np.maximum(before, 1)).astype(np.int64) + 1, 0)
    return p0, ml, bucket


def _histogram(n: int, v: int, docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, place = np.zeros((2, BUCKETS * BINS), dtype=np.int64)
        for batch in batches:
            for one, two in zip(batch.column("words").to_pylist(), batch.column("pairs").to_pylist()):
                p0, ml, bucket = _estimates(unpack(one), unpack(two), 1, n, v, docs)
                with np.errstate(divide="ignore"):
                    at = np.clip((np.log2(ml / p0) - LOW) * FINE, 0, BINS - 1.001)
                whole = np.floor(at)
                cell = bucket * BINS + np.where(ml > 0, whole + 1, 0).astype(np.int64)
                np.add.at(total, cell, 1)
                np.add.at(place, cell, ((at - whole) * WITHIN).astype(np.int64))
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells]), pa.array(place[cells])], ["cell", "tokens", "place"])
    return run


def mixture_weights(histogram: np.ndarray, place: np.ndarray | None = None, rounds: int = 200) -> np.ndarray:
    """Weight of the bigram estimate by context bucket, by EM on the counts of
    the ratio (bigram / unigram estimate) of deleted tokens; a bin stands for
    the ratio at the mean ``place`` (0 to 1) of its tokens, or at its middle."""
    place = np.full(histogram.shape, 0.5) if place is None else place
    ratios = 2.0 ** (LOW + (np.arange(BINS) - 1 + place) / FINE)
    ratios[:, 0] = 0.0
    out = np.zeros(BUCKETS)
    for b in range(1, BUCKETS):
        tokens = histogram[b]
        if not tokens.sum():
            continue
        weight, ratio = 0.5, ratios[b]
        for _ in range(rounds):
            share = weight * ratio / (1 - weight + weight * ratio)
            new = min(float((tokens * share).sum() / tokens.sum()), 1 - 1e-6)
            if abs(new - weight) < 1e-9:
                break
            weight = new
        out[b] = weight
    return out


def scores(docs: DataFrame, chunk_tokens: int = 2_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score
    and score (log10 probabilities)."""
    table = counted(docs, chunk_tokens, id_col, text_col)
    sums = table.where("v is not null").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    n, v = sums.n or 0, sums.v or 0
    rows = table.where("v is null")
    n_docs = rows.where("learn").count()
    found = (rows.where("learn").select("words", "pairs").mapInArrow(_histogram(n, v, n_docs), "cell long, tokens long, place long")
             .groupBy("cell").agg(F.sum("tokens").alias("tokens"), F.sum("place").alias("place")).collect())       # at most BUCKETS x BINS cells
    histogram, place = np.zeros((2, BUCKETS * BINS))
    for r in found:
        histogram[r.cell], place[r.cell] = r.tokens, r.place / r.tokens / WITHIN
    weights = mixture_weights(histogram.reshape(BUCKETS, BINS), place.reshape(BUCKETS, BINS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known, base, score = [], [], []
            for one, two in zip(batch.column("words").to_pylist(), batch.column("pairs").to_pylist()):
                one = unpack(one)
                p0, ml, bucket = _estimates(one, unpack(two), 0, n, v, n_docs)
                w = weights[np.minimum(bucket, BUCKETS - 1)]
                known.append(int((one > 0).sum()))
                base.append(float(np.log10(p0).sum()))
                score.append(float(np.log10((1 - w) * p0 + w * ml).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("learn"), batch.column("n_tokens"), pa.array(known, pa.int64()),
                 pa.array(base, pa.float64()), pa.array(score, pa.float64())],
                ["doc_id", "learn", "n_tokens", "n_known", "base_score", "score"])

    done = rows.select("doc_id", "learn", "n_tokens", "words", "pairs").mapInArrow(
        run, "doc_id long, learn boolean, n_tokens long, n_known long, base_score double, score double")
    return done.select(F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), (~F.col("learn")).alias("held_out"),
                       "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
