"""Edit-aware token counts.

A text is split into pre-tokens, and a byte-level BPE encodes each on its
own, so a document's tokens are the sum over its pre-tokens.  Each document
keeps a segment tree whose leaves are its pre-tokens and whose nodes hold sums
of characters and tokens.  An edit finds the touched leaves by the character
sums, splits the region again from a boundary that the edit cannot reach,
goes on until a boundary of the new split meets an old one behind the edit,
encodes the new pre-tokens alone, and adds the differences on the way from
the changed leaves to the root.  (A match of the split pattern depends on its
own characters and at most two behind it, and on nothing before it; so old
boundaries two or more characters before an edit hold, and behind the edit
one common boundary makes all later ones common.)

Documents and their edits meet in one shuffle by id, the document first and
its edits after it in order, so a task holds one document at a time and any
number of edits passes by.  Rows that share an id are counted by text first
(copies have one tree) and dealt by the hash of their text; the edits of such
an id go to each of its texts, so these too are held one at a time.

Defined cases: a null text is an empty one; an edit's start and length are
clipped to the text as it is then; null starts and lengths are 0, a null
replacement is empty; edits with one number apply in the order of their other
columns; edits of unknown or null ids change nothing; rows with one id each
get all its edits; an empty table gives no rows; columns other than the named
ones are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, saved, slices, text_rows

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the split pattern of the published vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
REACH = 2                   # characters behind a match that it can depend on
CACHE = 500_000


class Counter:
    """Pre-tokens of a text, and tokens of a pre-token."""

    def __init__(self, ranks: bytes, pattern: str = PATTERN):
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self._one = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})._core_bpe.encode_single_piece
        self._split = regex.compile(pattern)
        self._known: dict[str, int] = {}

    def split(self, text: str) -> list[str]:
        return self._split.findall(text)

    def tokens(self, pieces: list[str]) -> list[int]:
        known = self._known
        try:
            return list(map(known.__getitem__, pieces))
        except KeyError:
            if len(known) > CACHE:
                known.clear()
            for p in pieces:
                if p not in known:
                    known[p] = len(self._one(p.encode()))
            return [known[p] for p in pieces]


class Tree:
    """Segment tree over the pre-tokens of one document.  A leaf slot holds a
    list of pre-tokens: one at first, any number after an edit."""

    def __init__(self, text: str, counter: Counter):
        self.counter = counter
        pieces = counter.split(text)
        self.first, self.changed = pieces, {}                               # pre-tokens by slot, and what edits made of slots
        self.slots = max(1, len(pieces))
        self.half = 1 << max(0, (len(pieces) - 1).bit_length())
        self.sums = np.zeros((2 * self.half, 2), dtype=np.int64)            # characters, tokens
        if pieces:
            self.sums[self.half:self.half + len(pieces), 0] = list(map(len, pieces))
            self.sums[self.half:self.half + len(pieces), 1] = counter.tokens(pieces)
        level = self.half
        while level > 1:
            self.sums[level // 2:level] = self.sums[level:2 * level:2] + self.sums[level + 1:2 * level:2]
            level //= 2
        self.encoded = 0                                                    # pre-tokens encoded again

    @property
    def n_tokens(self) -> int:
        return int(self.sums[1, 1])

    @property
    def n_chars(self) -> int:
        return int(self.sums[1, 0])

    def leaf(self, slot: int) -> list[str]:
        return self.changed[slot] if slot in self.changed else self.first[slot:slot + 1]

    def pieces(self) -> list[str]:
        out, at = [], 0
        for slot in sorted(self.changed):
            out += self.first[at:slot]
            out += self.changed[slot]
            at = slot + 1
        return out + self.first[at:] if out or self.changed else self.first

    def text(self) -> str:
        return "".join(self.pieces())

    def find(self, at: int) -> tuple[int, int]:
        """The slot that holds character ``at`` (the last, at the end), and where it begins."""
        node, begin = 1, 0
        while node < self.half:
            node *= 2
            left = int(self.sums[node, 0])
            if at >= begin + left and int(self.sums[node + 1, 0]):
                begin += left
                node += 1
        return node - self.half, begin

    def put(self, first: int, stop: int, pieces: list[str], counts: list[int]) -> None:
        """Pre-tokens for the slots from ``first`` up to ``stop``, all in the
        first of them, and the sums of every node above."""
        self.changed[first] = pieces
        for slot in range(first + 1, stop):
            self.changed[slot] = []
        low, high = self.half + first, self.half + stop - 1
        self.sums[low:high + 1] = 0
        self.sums[low] = sum(map(len, pieces)), sum(counts)
        while low > 1:
            low, high = low // 2, high // 2
            self.sums[low:high + 1] = self.sums[2 * low:2 * high + 2:2] + self.sums[2 * low + 1:2 * high + 2:2]

    def edit(self, start: int, length: int, replacement: str) -> None:
        """Replace ``length`` characters from ``start`` on."""
        start = min(max(start, 0), self.n_chars)
        stop = min(start + max(length, 0), self.n_chars)
        if start == stop and not replacement:
            return
        # to the left: slots until one ends REACH characters before the edit
        first, begin = self.find(max(0, start - REACH - 1))
        if begin + self._size(first) + REACH <= start and first + 1 < self.slots:
            begin += self._size(first)
            first += 1
        last, at = self.find(stop)
        end = at + self._size(last)
        old = [(begin, first)]                                              # where old slots begin
        pos = begin
        for slot in range(first, last + 1):
            pos += self._size(slot)
            old.append((pos, slot + 1))
        region = "".join(p for slot in range(first, last + 1) for p in self.leaf(slot))
        new = region[:start - begin] + replacement + region[stop - begin:]
        shift = len(replacement) - (stop - start)
        more = 1
        while True:
            # boundaries of slots behind the edit, in the new text
            meet = {p + shift - begin: slot for p, slot in old if p >= stop and p > begin}
            pieces, size, done = [], 0, None
            whole = last + 1 == self.slots
            for p in self.counter.split(new):
                pieces.append(p)
                size += len(p)
                if size in meet and size >= stop + shift - begin and (whole or size + REACH <= len(new)):
                    done = meet[size]
                    break
            if done is not None or whole:
                break
            upto = min(self.slots, last + 1 + more)
            for slot in range(last + 1, upto):
                new += "".join(self.leaf(slot))
                pos += self._size(slot)
                old.append((pos, slot + 1))
            last, more = upto - 1, 2 * more
        stop_slot = self.slots if done is None else done
        self.encoded += len(pieces)
        self.put(first, max(stop_slot, first + 1), pieces, self.counter.tokens(pieces))

    def _size(self, slot: int) -> int:
        return int(self.sums[slot + self.half, 0])


def count_with_edits(docs: DataFrame, edits: DataFrame, ranks: str = RANKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_pretokens and n_tokens before, n_edits,
    edited_tokens after its edits, n_reencoded (pre-tokens encoded again) and
    edited_sha256.  ``edits`` has doc_id, seq, start, length (in code points
    of the text as it is then) and replacement."""
    with open(ranks, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = text_rows(docs, id_col, text_col)
    repeated = saved(rows.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated-ids")
    changes = edits.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.lit(0).cast("long").alias("spread"),
        F.greatest(F.coalesce(F.col("seq").cast("long"), F.lit(0)), F.lit(0)).alias("seq"),
        F.col("start").cast("long").alias("start"), F.col("length").cast("long").alias("length"),
        F.col("replacement").cast("string").alias("text"))
    once = rows.select("doc_id", F.lit(0).cast("long").alias("spread"), "text", F.lit(1).cast("long").alias("copies"))
    if not repeated.isEmpty():
        of = repeated.select(F.col("doc_id").alias("_id"))
        shared_id = F.col("doc_id").eqNullSafe(F.col("_id"))
        texts = (rows.join(of, shared_id, "left_semi").groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("copies"))
                 .select("doc_id", F.xxhash64("text").alias("spread"), "text", "copies"))
        places = saved(texts.select("doc_id", "spread").where("doc_id is not null").distinct(), "repeated-places")
        once = once.join(of, shared_id, "left_anti").unionByName(texts)
        changes = changes.join(of, shared_id, "left_anti").unionByName(changes.drop("spread").join(places, "doc_id"))
    none = F.lit(None).cast("long")
    left = once.select("*", F.lit(-1).cast("long").alias("seq"), none.alias("start"), none.alias("length"))
    met = (left.unionByName(changes.withColumn("copies", none)).repartition(partitions(docs), "doc_id", "spread")
           .sortWithinPartitions("doc_id", "spread", "seq", "start", "length", "text"))
    return met.mapInArrow(_counted(shared), COUNTED)


COUNTED = ("doc_id long, n_pretokens long, n_tokens long, n_edits long, edited_tokens long, n_reencoded long, "
           "edited_sha256 string")
_NAMES = ["doc_id", "n_pretokens", "n_tokens", "n_edits", "edited_tokens", "n_reencoded", "edited_sha256"]
_COLUMNS = ("doc_id", "spread", "seq", "start", "length", "text", "copies")
ROWS_OUT = 10_000


def _counted(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        at, open_ = None, []                # the place, and its trees (one, but for equal hashes) as [tree, copies, pre-tokens, tokens, edits]
        for part in slices(batches):
            out = []
            for i, spread, seq, start, length, text, copies in zip(*(part.column(c).to_pylist() for c in _COLUMNS)):
                if seq < 0:
                    if at != (i, spread):
                        out += [_result(at[0], *x) for x in open_]
                        at, open_ = (i, spread), []
                    tree = Tree(text or "", counter)
                    open_.append([tree, copies, len(tree.first), tree.n_tokens, 0])
                elif at == (i, spread):
                    for x in open_:
                        x[0].edit(start or 0, length or 0, text or "")
                        x[4] += 1
            yield from _written(out)
        yield from _written([_result(at[0], *x) for x in open_])
    return run


def _result(doc, tree: Tree, copies: int, *before: int) -> tuple:
    return copies, (doc, *before, tree.n_tokens, tree.encoded, hashlib.sha256(tree.text().encode()).hexdigest())


def _written(results: list[tuple]) -> Iterator[pa.RecordBatch]:
    """The rows of the results, each as often as it has copies, in batches of a bounded size."""
    kinds, held = [pa.int64()] * 6 + [pa.string()], []
    for n, row in results:
        while n:
            take = min(n, ROWS_OUT - len(held))
            held += [row] * take
            n -= take
            if len(held) == ROWS_OUT:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*held), kinds)], _NAMES)
                held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*held), kinds)], _NAMES)
