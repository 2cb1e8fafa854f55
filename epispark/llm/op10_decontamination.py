"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Words are runs of ASCII letters and digits and of non-ASCII bytes, A-Z
lower-cased.  Patterns are the windows of ``window`` consecutive words of the
benchmark items; an item of fewer words is one pattern.  Patterns of one
length m form a matcher: a shift table by the hash of a block of two words
(one, if m is 1) says how far the search may move on; where it says zero, the
suffix-hash bucket of that block selects the patterns to test, by the hash of
all m words first and then by direct comparison of the words' bytes.

A task runs many searches side by side: the words of its texts are cut into
lanes, and each step moves all lanes by their own shifts.

The benchmark is read in blocks of items of at most ``block_bytes`` of text,
each broadcast by itself; a Python worker builds a block's tables once, as flat
arrays over the block's bytes (about eight bytes for each of its own).  With one block the
documents pass the search once.  With more, each block's search writes the
hits alone, by digest of the text, and the documents are joined to them at the
end: they are never written.  The driver reads the blocks one by one and holds
two.

Defined cases: a null or empty text has no words and no hits; items without
words have no pattern; items without an id are searched and count as one item
together, which the list of ids leaves out; items with equal windows are all named; repeated rows
are returned as often as they come; an empty table gives no rows, an empty
benchmark no hits; columns other than ids and texts are not read by
``contamination`` and are carried along by ``clean_documents``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, buffer, joined, mix, saved, slices, span_hashes, spans

#: Bytes that no word holds, after lower-casing.
GAP = np.zeros(256, dtype=bool)
for _a, _b in ((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)):
    GAP[_a:_b + 1] = True
TABLE_BITS = 20
LANE = 256


def _block_hash(w: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    h = w[at] if size == 1 else w[at - 1] * np.uint64(0x9FB21C651E98DF25) + w[at]
    return (mix(h) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def _fold(w: np.ndarray, at: np.ndarray, m: int) -> np.ndarray:
    """Hash of the m words that end at each position."""
    h = np.zeros(len(at), dtype=np.uint64)
    for k in range(m - 1, -1, -1):
        h = h * np.uint64(0xC2B2AE3D27D4EB4F) + w[at - k]
    return h


class Words:
    """The words of some texts, as spans of one buffer of lower-cased bytes."""

    def __init__(self, texts: list[bytes]):
        data, off = joined(texts)
        self.data = LOWER[data]
        start, end, self.at = spans(self.data, off, GAP)
        self.hash = span_hashes(self.data, start, end)
        self.start, self.end = start.astype(np.int32), end.astype(np.int32)

    def __getitem__(self, k: int) -> bytes:
        return self.data[self.start[k]:self.end[k]].tobytes()


class Matcher:
    """Wu-Manber tables for patterns of ``m`` words each, given by their first
    words in ``words`` and their items."""

    def __init__(self, m: int, words: Words, first: np.ndarray, item: np.ndarray):
        self.m, self.size, self.words = m, min(2, m), words
        h = words.hash
        self.shift = np.full(1 << TABLE_BITS, m - self.size + 1, dtype=np.int32)
        for end in range(self.size - 1, m):
            np.minimum.at(self.shift, _block_hash(h, first + end, self.size), m - 1 - end)
        # the buckets of suffix blocks, told apart by the hash of all words: one sorted array
        full = _fold(h, first + m - 1, m)
        order = np.argsort(full, kind="stable")
        full, first, item = full[order], first[order], item[order]
        new = np.ones(len(full), dtype=bool)        # equal patterns stand together: one of them is compared
        same = np.flatnonzero(full[1:] == full[:-1]) + 1
        new[same] = [not self._equal(int(first[i]), int(first[i - 1])) for i in same.tolist()]
        heads = np.flatnonzero(new)
        self.full, self.first = full[heads], first[heads].astype(np.int32)
        self.item, self.item_at = item.astype(np.int32), np.append(heads, len(full)).astype(np.int32)

    def _equal(self, a: int, b: int) -> bool:
        w = self.words
        return all(w[a + k] == w[b + k] for k in range(self.m))

    def items_of(self, i: int) -> set[int]:
        return set(self.item[self.item_at[i]:self.item_at[i + 1]].tolist())

    def search(self, h: np.ndarray, at: np.ndarray, word) -> list[tuple[int, int]]:
        """(last word, pattern) of every occurrence.  ``h``: word hashes of
        texts end to end; ``at``: where each text begins; ``word(i)``: bytes."""
        m, found = self.m, []
        counts = np.diff(at)
        lanes = -(-np.maximum(counts - m + 1, 0) // LANE)
        text = np.repeat(np.arange(len(counts)), lanes)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        pos = at[:-1][text] + nth * LANE + m - 1
        stop = np.minimum(pos + LANE, at[1:][text])
        while len(pos):
            step = self.shift[_block_hash(h, pos, self.size)]
            zero = np.flatnonzero(step == 0)
            if len(zero):
                ends = pos[zero]
                f = _fold(h, ends, m)
                low, high = (np.searchsorted(self.full, f, side=side) for side in ("left", "right"))
                for k in np.flatnonzero(low < high).tolist():
                    end = int(ends[k])
                    for i in range(int(low[k]), int(high[k])):
                        first = int(self.first[i])
                        if all(word(end - m + 1 + j) == self.words[first + j] for j in range(m)):
                            found.append((end, i))
            pos = pos + np.maximum(step, 1)
            live = pos < stop
            pos, stop = pos[live], stop[live]
        return found


class Block:
    """The matchers, by pattern length, for (item_id, text) pairs."""

    def __init__(self, items: list[tuple[str | None, str]], window: int = 10):
        self.names = [name for name, _ in items]
        words = Words([(t or "").encode() for _, t in items])
        counts = np.diff(words.at)
        m = np.minimum(counts, window)
        self.matchers = []
        for length in np.unique(m[m > 0]).tolist():
            own = np.flatnonzero(m == length)
            n = counts[own] - length + 1
            first = np.repeat(words.at[own] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum()))
            self.matchers.append(Matcher(length, words, first, np.repeat(own, n)))
        words.hash = None           # of no use once the tables are built

    def find(self, texts: pa.Array) -> tuple[np.ndarray, list[list[int]], list[set]]:
        return find_hits(texts, self.matchers, self.names)


def find_hits(texts: pa.Array, found_by: list[Matcher], names: list) -> tuple[np.ndarray, list[list[int]], list[set]]:
    """Words per text; flat (first, last) word spans of the occurrences, in
    the text; ids of the items with occurrences."""
    raw, off = buffer(texts)
    data = LOWER[raw]
    s, e, at = spans(data, off, GAP)
    h = span_hashes(data, s, e)
    hits, items = [[] for _ in range(len(texts))], [set() for _ in range(len(texts))]
    for matcher in found_by:
        known: dict[int, set] = {}
        for end, i in matcher.search(h, at, lambda k: data[s[k]:e[k]].tobytes()):
            t = int(np.searchsorted(at, end, side="right")) - 1
            hits[t] += [end - matcher.m + 1 - int(at[t]), end - int(at[t])]
            if i not in known:
                known[i] = {names[k] for k in matcher.items_of(i)}
            items[t].update(known[i])
    return np.diff(at), hits, items


def covered(spans_: list[int]) -> int:
    """Words inside any of the flat (first, last) spans."""
    total, reach = 0, -1
    for a, b in sorted(zip(spans_[::2], spans_[1::2])):
        total += max(0, b - max(a, reach + 1) + 1)
        reach = max(reach, b)
    return total


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[str | None, str]]]:
    """The items in blocks of at most ``block_bytes`` of text (a longer item alone)."""
    block, size = [], 0
    for r in benchmark.select(F.col(item_col).cast("string").alias("item"),
                              F.col(text_col).cast("string").alias("text")).toLocalIterator():
        n = len((r.text or "").encode())
        if block and size + n > block_bytes:
            yield block
            block, size = [], 0
        block.append((r.item, r.text or ""))
        size += n
    if block:
        yield block


def _search(shared, window: int, hits_only: bool, keep_text: bool = False):
    """The search of one block: every row, or the digests of the texts with hits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value                # one object for all tasks of a Python worker
        if "tables" not in block:
            block["tables"] = Block(block.pop("items"), window)
        for part in slices(batches):
            n, hits, items = block["tables"].find(part.column("text"))
            some = pa.array([i for i, x in enumerate(hits) if x] if hits_only else range(len(hits)), pa.int64())
            found = [pa.array(hits, pa.list_(pa.int32())).take(some), pa.array([list(x) for x in items], pa.list_(pa.string())).take(some)]
            if hits_only:
                yield pa.RecordBatch.from_arrays([part.column("digest").take(some), *found], ["digest", "hits", "items"])
            else:
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("text") if keep_text else pa.nulls(part.num_rows, pa.string()),
                     pa.array(n, pa.int64()), *found], ["row", "text", "n_words", "hits", "items"])
    return run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number of words of every text."""
    for part in slices(batches):
        data, off = buffer(part.column("text"))
        _, _, at = spans(LOWER[data], off, GAP)
        yield pa.RecordBatch.from_arrays([part.column("row"), part.column("digest"), pa.array(np.diff(at), pa.int64())],
                                         ["row", "digest", "n_words"])


def _searched(docs: DataFrame, benchmark: DataFrame, window: int, block_bytes: int, text_col: str,
              item_col: str, item_text_col: str, clean_only: bool) -> DataFrame:
    """(row, text, n_words, hits, items) with ``row`` all columns but the text;
    ``clean_only``: (row, text) of the rows without hits."""
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*others).alias("row") if others else F.struct(F.lit(1)).alias("row"),
                       F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    share = docs.sparkSession.sparkContext.broadcast
    blocks = item_blocks(benchmark, item_col, item_text_col, block_bytes)
    block, following = next(blocks, []), next(blocks, None)
    if following is None:
        out = rows.mapInArrow(_search(share({"items": block}), window, False, clean_only),
                              f"row {kind}, text string, n_words long, hits array<int>, items array<string>")
        return out.where("size(hits) = 0").select("row", "text") if clean_only else out
    keyed = rows.withColumn("digest", F.sha2(F.coalesce("text", F.lit("")), 256))
    found = None
    while block is not None:
        some = (keyed.select("digest", "text").mapInArrow(_search(share({"items": block}), window, True),
                                                         "digest string, hits array<int>, items array<string>")
                .groupBy("digest").agg(F.any_value("hits").alias("hits"), F.any_value("items").alias("items")))
        some = saved(some, "decontamination")
        found = some if found is None else found.unionByName(some)
        block, following = following, next(blocks, None)
    if clean_only:
        return keyed.join(found.select("digest").distinct(), "digest", "left_anti").select("row", "text")
    merged = found.groupBy("digest").agg(F.flatten(F.collect_list("hits")).alias("hits"),
                                         F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    counted = keyed.mapInArrow(_count, f"row {kind}, digest string, n_words long")
    none = F.expr("cast(array() as array<int>)"), F.expr("cast(array() as array<string>)")
    return counted.join(merged, "digest", "left").select(
        "row", F.lit(None).cast("string").alias("text"), "n_words",
        *[F.coalesce(c, empty).alias(c) for c, empty in zip(("hits", "items"), none)])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = 16 << 20,
                  id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_hit (words inside an occurrence), n_items,
    items_sha256 (of the sorted ids, comma-joined), contaminated."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = (_searched(rows, benchmark, window, block_bytes, "text", item_col, item_text_col, False)
             .select("row.doc_id", "n_words", "hits", "items"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hit = [covered(x) for x in b.column("hits").to_pylist()]
            items = b.column("items").to_pylist()
            sha = [hashlib.sha256(",".join(sorted(y for y in x if y is not None)).encode()).hexdigest() for x in items]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("n_words"), pa.array(hit, pa.int64()),
                 pa.array([len(x) for x in items], pa.int64()), pa.array(sha), pa.array([x > 0 for x in hit], pa.bool_())],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(digest, f"doc_id {kind}, n_words long, n_hit long, n_items long, "
                                    "items_sha256 string, contaminated boolean")


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = 16 << 20,
                    text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without any occurrence, all columns as they were."""
    found = _searched(docs, benchmark, window, block_bytes, text_col, item_col, item_text_col, True)
    return found.select(*[F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
