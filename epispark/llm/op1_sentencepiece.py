"""SentencePiece encoding by forward filtering and backward sampling.

A text, with one space put before it, is cut before every run of spaces; no
piece of the model crosses such a cut, so the piece lattice of the text is
the chain of the lattices of these units.  Forward filtering gives every
lattice node the log of the summed weight of all ways to reach it; backward
sampling walks from the end of a unit and takes each arriving piece with its
share of that sum, which draws a segmentation from

    P(segmentation)  proportional to  (product of piece weights) ** alpha.

A model of merges has ranks, not probabilities: the weight of the piece of
rank r is taken as 1 / (Z (r + 2)), a Zipf law normalised over the vocabulary.

The random numbers are a hash of the row key, the unit's place in the text
and the step, so a row's segmentation is the same in any batch, partition
order or cluster.  Lattices are built once per batch for each distinct unit,
all units side by side in numpy, and all occurrences are sampled in step.

Characters without a piece, and the character that stands for a space inside
the model's pieces, become UTF-8 byte pieces, so decoding gives every text
back exactly.

Defined cases: a null text gives null ids, an empty one no ids; rows with one
key get the same random numbers (equal texts then get equal ids); a null key
is a key like any other; an empty table gives no rows; columns other than the
key and the text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buffer, mix, slices, strings

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE_MARK = "▁"
UNIT = re.compile(r" +[^ ]*")
BATCH_BYTES = 1 << 20


@dataclass
class Vocabulary:
    """Pieces by id (None for those that text never gives), their log weights, byte pieces by value."""
    pieces: list[str | None]
    weights: np.ndarray
    byte_ids: list[int]


def vocabulary(model: str = MODEL) -> Vocabulary:
    """The pieces of a SentencePiece model file with byte fallback."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    n = sp.get_piece_size()
    pieces: list[str | None] = [None] * n
    byte_ids = [-1] * 256
    rank = np.full(n, np.inf)
    for i in range(n):
        if sp.is_byte(i):
            byte_ids[int(sp.id_to_piece(i)[3:5], 16)] = i
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            pieces[i] = sp.id_to_piece(i).replace(SPACE_MARK, " ")
            rank[i] = -sp.get_score(i)
    if min(byte_ids) < 0:
        raise ValueError("the model has no byte fallback")
    if any(" " in p.lstrip(" ") for p in pieces if p):
        raise ValueError("a piece holds a space after another character")
    weight = 1 / (np.maximum(rank, 0) + 2)
    return Vocabulary(pieces, np.log(np.maximum(weight / weight.sum(), 1e-300)), byte_ids)


class Codec:
    """Tables for encoding and decoding with one vocabulary."""

    def __init__(self, vocab: Vocabulary, alpha: float = 1.0):
        self.byte_ids = np.array(vocab.byte_ids, dtype=np.int32)
        chars = sorted({c for p in vocab.pieces if p for c in p})
        # the mark itself is an ordinary character of a text, and has no piece
        self.code = np.zeros(0x110000, dtype=np.int32)
        for k, c in enumerate(chars, 1):
            self.code[ord(c)] = k
        self.n_chars = len(chars) + 1
        trie: dict[tuple[int, int], int] = {}
        ends = [-1]
        for i, p in enumerate(vocab.pieces):
            if not p:
                continue
            state = 0
            for c in p:
                step = (state, int(self.code[ord(c)]))
                if step not in trie:
                    trie[step] = len(ends)
                    ends.append(-1)
                state = trie[step]
            ends[state] = i
        self.piece_at = np.array(ends, dtype=np.int32)
        keys = np.array([s * self.n_chars + c for s, c in trie], dtype=np.int64)
        order = np.argsort(keys)
        bits = max(10, int(len(keys) * 4).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slot_key = np.full((1 << bits) + 64, -1, dtype=np.int64)
        self.slot_state = np.zeros((1 << bits) + 64, dtype=np.int32)
        values = np.array(list(trie.values()), dtype=np.int32)
        for k, v, h in zip(keys[order].tolist(), values[order].tolist(), self._slots(keys[order]).tolist()):
            while self.slot_key[h] >= 0:
                h += 1
            self.slot_key[h], self.slot_state[h] = k, v
        self.weight = alpha * vocab.weights
        self.fallback = alpha * float(vocab.weights.min())
        text = [(p or "").encode() for p in vocab.pieces]
        for b, i in enumerate(vocab.byte_ids):
            text[i] = bytes([b])
        self.piece_size = np.array([len(t) for t in text], dtype=np.int64)
        self.piece_start = np.concatenate([[0], np.cumsum(self.piece_size)[:-1]])
        self.piece_bytes = np.frombuffer(b"".join(text), dtype=np.uint8)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _step(self, state: np.ndarray, char: np.ndarray) -> np.ndarray:
        """Next trie states, or -1."""
        key = state.astype(np.int64) * self.n_chars + char
        slot = self._slots(key)
        out = np.full(len(key), -1, dtype=np.int32)
        todo = np.arange(len(key))
        while len(todo):
            found = self.slot_key[slot[todo]]
            hit = found == key[todo]
            out[todo[hit]] = self.slot_state[slot[todo[hit]]]
            todo = todo[~hit & (found >= 0)]
            slot[todo] += 1
        return out

    def lattice(self, units: list[str]) -> "Lattice":
        """The filtered lattice of the given units, which must not get longer."""
        sizes = np.fromiter(map(len, units), dtype=np.int64, count=len(units))
        points = np.frombuffer("".join(units).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        code = self.code[points]
        begin = np.cumsum(sizes) - sizes
        unit = np.repeat(np.arange(len(units)), sizes)
        place = np.arange(len(points)) - begin[unit]
        left = sizes[unit] - place                               # characters up to the unit's end
        # nodes by place, then by unit: the node after k characters of unit u is base[k] + u
        longest = int(sizes[0])
        base = np.concatenate([[0], np.cumsum(np.searchsorted(-sizes, -np.arange(longest + 1), side="right"))])
        found = []                                               # (characters where pieces begin, nodes they lead to, pieces)
        start, state, depth = np.arange(len(points)), np.zeros(len(points), dtype=np.int32), 0
        single = np.zeros(len(points), dtype=bool)
        while len(start):
            state = self._step(state, code[start + depth])
            alive = state >= 0
            start, state = start[alive], state[alive]
            depth += 1
            piece = self.piece_at[state]
            hit = piece >= 0
            src = start[hit]
            found.append((src, base[place[src] + depth] + unit[src], piece[hit]))
            if depth == 1:
                single[src] = True
            more = left[start] > depth
            start, state = start[more], state[more]
        lost = np.flatnonzero(~single)                           # characters that need bytes
        found.append((lost, base[place[lost] + 1] + unit[lost], np.full(len(lost), -1, dtype=np.int32)))
        count = np.zeros(int(base[-1]) + 1, dtype=np.int64)      # edges into each node; each length gives a node one at most
        for _, to, _ in found:
            count[to + 1] += 1
        first = np.cumsum(count)
        fill, n = first[:-1].copy(), int(first[-1])
        small = np.int32 if max(n, len(points), int(base[-1])) < 2**31 else np.int64
        src, piece = np.empty(n, dtype=small), np.empty(n, dtype=np.int32)
        for s, t, p in found:
            at = fill[t]
            fill[t] += 1
            src[at], piece[at] = s, p
        node = (base[place[src]] + unit[src]).astype(small)
        cost = np.where(piece >= 0, self.weight[piece], self.fallback)
        return Lattice(node, piece, src, cost, first, base, sizes, points)

    def ids(self, texts: list[str], keys: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """Sampled ids of the texts end to end, and where each text ends."""
        split = [UNIT.findall(" " + t) if t else [] for t in texts]
        counts = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        known = _Numbers()
        which = np.fromiter(map(known.__getitem__, chain.from_iterable(split)), dtype=np.int64, count=int(counts.sum()))
        if not len(which):
            return np.zeros(0, dtype=np.int32), np.zeros(len(texts), dtype=np.int64)
        units = list(known)
        by_size = sorted(range(len(units)), key=lambda u: -len(units[u]))
        number = np.empty(len(units), dtype=np.int64)
        number[by_size] = np.arange(len(units))
        which = number[which]
        lat = self.lattice([units[u] for u in by_size])
        place = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
        with np.errstate(over="ignore"):
            base = mix(keys.astype(np.int64).view(np.uint64) ^ np.uint64(seed & (2**64 - 1)))
            base = np.repeat(base, counts) + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        steps, width = lat.sample(which, base, self)
        ends = np.cumsum(width)
        out = np.zeros(int(ends[-1]), dtype=np.int32)
        cursor = ends.copy()
        for who, edge in steps:                                   # from the units' ends backwards
            piece = lat.piece[edge]
            plain = piece >= 0
            cursor[who[plain]] -= 1
            out[cursor[who[plain]]] = piece[plain]
            if not plain.all():
                lost = who[~plain]
                raw, n = utf8(lat.points[lat.src[edge[~plain]]])
                cursor[lost] -= n
                for b in range(4):
                    has = n > b
                    out[cursor[lost[has]] + b] = self.byte_ids[raw[has, b]]
        return out, np.concatenate([[0], ends])[np.cumsum(counts)]

    def texts(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of the decoded texts end to end, and where each ends:
        the pieces' bytes without the one space put before a text."""
        size = self.piece_size[ids]
        at = np.concatenate([[0], np.cumsum(size)])
        data = self.piece_bytes[np.arange(at[-1]) - np.repeat(at[:-1] - self.piece_start[ids], size)]
        starts = np.concatenate([[0], ends[:-1]])
        some = starts < ends
        keep = np.ones(len(data), dtype=bool)
        keep[at[starts[some]]] = False
        return data[keep], at[ends] - np.cumsum(some)


def utf8(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The up to four UTF-8 bytes of code points, and how many."""
    p = points.astype(np.int64)
    n = 1 + (p > 0x7F) + (p > 0x7FF) + (p > 0xFFFF)
    raw = np.zeros((len(p), 4), dtype=np.int64)
    for k, lead in ((1, 0x00), (2, 0xC0), (3, 0xE0), (4, 0xF0)):
        m = n == k
        raw[m, 0] = lead | (p[m] >> (6 * (k - 1)))
        for b in range(1, k):
            raw[m, b] = 0x80 | ((p[m] >> (6 * (k - 1 - b))) & 0x3F)
    return raw, n


class _Numbers(dict):
    """Numbers of keys, in the order of their first look-up."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


class Lattice:
    """Edges sorted by the node they lead to, and each edge's share among
    those of its node, cumulated: what backward sampling needs."""

    def __init__(self, node, piece, src, cost, first, base, sizes, points):
        self.node, self.piece, self.src, self.first = node, piece, src, first
        self.base, self.sizes, self.points = base, sizes, points
        total = np.zeros(int(base[-1]))
        share = np.zeros(len(node))
        for k in range(1, len(base) - 1):                        # all nodes after k characters
            nodes = first[base[k]:base[k + 1] + 1]
            a, b = int(nodes[0]), int(nodes[-1])
            heads, size = nodes[:-1] - a, np.diff(nodes)
            reach = total[node[a:b]] + cost[a:b]
            top = np.maximum.reduceat(reach, heads)
            part = np.exp(reach - np.repeat(top, size))
            whole = np.add.reduceat(part, heads)
            total[base[k]:base[k + 1]] = top + np.log(whole)
            share[a:b] = part / np.repeat(whole, size)
        run = np.concatenate([[0.0], np.cumsum(share)])
        self.until = run[1:] - np.repeat(run[first[:-1]], np.diff(first))
        self.total = total

    def sample(self, which: np.ndarray, base: np.ndarray, codec: Codec) -> tuple[list, np.ndarray]:
        """For occurrences of units: the edges taken, step by step from the
        end, as (occurrences, edges), and the ids each occurrence gives."""
        who = np.arange(len(which))
        at = self.base[self.sizes[which]] + which
        starts = int(self.base[1])                               # nodes before the first character come first
        width = np.zeros(len(which), dtype=np.int64)
        steps = []
        k = 0
        while len(who):
            with np.errstate(over="ignore"):
                draw = mix(base[who] + np.uint64((0xD1B54A32D192ED03 * (k + 1)) & (2**64 - 1)))
            u = (draw >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
            edge, last = self.first[at], self.first[at + 1] - 1
            todo = np.flatnonzero((edge < last) & (self.until[edge] <= u))
            while len(todo):
                edge[todo] += 1
                e = edge[todo]
                todo = todo[(e < last[todo]) & (self.until[e] <= u[todo])]
            steps.append((who, edge))
            piece = self.piece[edge]
            width[who] += np.where(piece >= 0, 1, utf8(self.points[self.src[edge]])[1] if (piece < 0).any() else 1)
            at = self.node[edge]
            more = at >= starts
            who, at = who[more], at[more]
            k += 1
        return steps, width


def _keyed(docs: DataFrame, key_col: str, text_col: str, keep: list[str]) -> DataFrame:
    return docs.select(F.struct(*keep).alias("row"), F.xxhash64(key_col).alias("key"),
                       F.col(text_col).cast("string").alias("text"))


def encode(docs: DataFrame, model: str = MODEL, alpha: float = 1.0, seed: int = 0, key_col: str = "doc_id",
           text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (the key alone, by default), then ids (sampled
    piece ids), n_pieces, and lossless: whether decoding the ids gives the
    text back (null for a null text)."""
    keep = keep or [key_col]
    rows = _keyed(docs, key_col, text_col, keep)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value, alpha)
        for part in slices(batches, limit=BATCH_BYTES):
            text = part.column("text")
            ids, ends = codec.ids(strings(text), part.column("key").to_numpy(), seed)
            data, stops = codec.texts(ids, ends)
            raw, off = buffer(text)
            same = np.zeros(len(text), dtype=bool)
            if len(raw) == len(data) and (stops == off[1:]).all():
                wrong = np.searchsorted(off[1:], np.flatnonzero(raw != data), side="right")
                same[:] = True
                same[wrong] = False
            else:
                for i, (a, b) in enumerate(zip(np.concatenate([[0], stops[:-1]]).tolist(), stops.tolist())):
                    same[i] = data[a:b].tobytes() == raw[off[i]:off[i + 1]].tobytes()
            null = ~text.is_valid().to_numpy(zero_copy_only=False)
            begins = np.concatenate([[0], ends]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(begins, mask=np.concatenate([null, [False]])), pa.array(ids))
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), lists, pa.array(np.diff(begins).astype(np.int64), mask=null),
                 pa.array(same, mask=null)], ["row", "ids", "n_pieces", "lossless"])

    kind = rows.schema["row"].dataType.simpleString()
    done = rows.mapInArrow(run, f"row {kind}, ids array<int>, n_pieces long, lossless boolean")
    return done.select(*[F.col("row")[c].alias(c) for c in keep], "ids", "n_pieces", "lossless")


def decode(encoded: DataFrame, model: str = MODEL, ids_col: str = "ids", into: str = "text") -> DataFrame:
    """``encoded`` with the text of its ids in column ``into``, in place of the ids."""
    keep = [c for c in encoded.columns if c not in (ids_col, into)]
    rows = encoded.select(F.struct(*keep).alias("row"), F.col(ids_col).cast("array<int>").alias("ids"))
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for batch in batches:
            ids = batch.column("ids")
            sizes = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            data, ends = codec.texts(ids.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes))
            begins = np.concatenate([[0], ends]).tolist()
            blob = data.tobytes()
            valid = ids.is_valid().to_pylist()
            text = [blob[a:b].decode() if v else None for a, b, v in zip(begins[:-1], begins[1:], valid)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(text, pa.string())], ["row", "text"])

    kind = rows.schema["row"].dataType.simpleString()
    done = rows.mapInArrow(run, f"row {kind}, text string")
    return done.select(*[F.col("row")[c].alias(c) for c in keep], F.col("text").alias(into))
