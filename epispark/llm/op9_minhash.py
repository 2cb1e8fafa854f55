"""Document fingerprints by MinHash.

Words are runs without ASCII white space, A-Z lower-cased; shingles are five
consecutive words (fewer words: the whole sequence).  Each of ``n_perm``
universal hash functions h(x) = (a x + b) mod 2**64, a odd, is applied to all
shingle hashes of a text at once in numpy; the signature keeps the leading 32
bits of each minimum.  The share of equal positions of two signatures
estimates the Jaccard similarity of the shingle sets.

``similar`` cuts signatures into bands, joins equal bands in Spark and
verifies the exact Jaccard similarity of the shingle sets in them.  With 32
bands of 4, a pair of similarity 0.8 is missed with a chance of about 5e-8.
Equal sets are one.  The sets of a band are dealt into shares, which are joined
inside tasks, and blocks of different classes after that (see
``op12_jaccard_join``): no task holds a large band, and links come out as
spanning links, never as pairs of a band.

``edited_fingerprints`` compares each text with an edited form of itself (its
last half replaced by the beginning of the next document) and with the next
document.  Documents are dealt by ranges of their id; each range also gets
the first row of the range after it, so every row meets its successor without
a second shuffle of the texts.

Defined cases: a null or empty text, or one of white space alone, has no
shingle, and is alike (1.0) to texts without shingles and unlike (0.0) all
others; rows with one id are ordered by their texts; a null id sorts first;
a single document is its own successor; an empty table gives no rows;
columns other than the id and the text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SPACE, attach, byte_strings, joined, mix, partitions, saved, shingle_hashes, slices, span_hashes, spans, strings, text_rows

SHINGLE, N_PERM = 5, 128
FIRST = -2**63              # stands for a null id: before all others
EMPTY = 0xFFFFFFFF
_BLOCK = 2048


def permutations(n: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of ``n`` universal hash functions."""
    with np.errstate(over="ignore"):
        x = mix(np.arange(2 * n, dtype=np.uint64) + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15))
    return x[:n] | np.uint64(1), x[n:]


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The leading 32 bits of the smallest value of every hash function."""
    low = np.full(len(a), 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    for i in range(0, len(shingles), _BLOCK):
        h = a[:, None] * shingles[None, i:i + _BLOCK]
        h += b[:, None]
        np.minimum(low, h.min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def shingle_sets(texts: list[bytes], width: int = SHINGLE) -> list[np.ndarray]:
    """Shingle hashes of each text, repeats included."""
    data, off = joined(texts)
    data = LOWER[data]
    s, e, at = spans(data, off, SPACE)
    words = span_hashes(data, s, e, seed=9)
    with np.errstate(over="ignore"):
        return [shingle_hashes(words[at[i]:at[i + 1]], width) for i in range(len(texts))]


def signatures(texts: list[bytes], a: np.ndarray, b: np.ndarray, width: int = SHINGLE) -> list[np.ndarray]:
    with np.errstate(over="ignore"):
        return [signature(x, a, b) for x in shingle_sets(texts, width)]


def likeness(one: np.ndarray, two: np.ndarray) -> float:
    """Share of equal positions; empty signatures are alike only to each other."""
    if (one == EMPTY).all() or (two == EMPTY).all():
        return float((one == two).all())
    return float((one == two).mean())


def hexed(sig: np.ndarray) -> str:
    return sig.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame, n_perm: int = N_PERM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, signature binary) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = permutations(n_perm)
        for part in slices(batches):
            sigs = signatures(byte_strings(part.column("text")), a, b)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([s.tobytes() for s in sigs], pa.binary())], ["doc_id", "signature"])

    return text_rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, signature binary")


def edit(text: str, after: str) -> str:
    """The last half of the code points replaced by the first as many of ``after``."""
    half = len(text) // 2
    return text[:len(text) - half] + after[:half]


def edited_fingerprints(docs: DataFrame, n_perm: int = N_PERM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint and
    edited_fingerprint (hex), near_edited, near_next."""
    rows = text_rows(docs, id_col, text_col)
    n = partitions(docs)
    ids = rows.select(F.coalesce("doc_id", F.lit(FIRST)).alias("key"))
    found = ids.agg(F.min("key").alias("low"), F.percentile_approx(
        "key", [i / (3 * n) for i in range(1, 3 * n)], 30 * n).alias("cuts")).first()
    if found.low is None:
        return docs.sparkSession.createDataFrame([], EDITED)
    # range i begins with an id of the table, or, the first, with the lowest
    heads = np.unique(np.array([found.low, *found.cuts], dtype=np.int64))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("doc_id").fill_null(FIRST).to_numpy(zero_copy_only=False)
            at = np.searchsorted(heads, key, side="right") - 1
            lead = np.flatnonzero(heads[at] == key)         # first rows, copied to the range before
            take = pa.array(np.concatenate([np.arange(len(key)), lead]))
            to = np.concatenate([at, (at[lead] - 1) % len(heads)]).astype(np.int32)
            ahead = np.concatenate([np.zeros(len(key), bool), np.ones(len(lead), bool)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(to), pa.array(ahead), batch.column("doc_id").take(take), batch.column("text").take(take)],
                ["range", "ahead", "doc_id", "text"])

    dealt = (rows.mapInArrow(deal, "range int, ahead boolean, doc_id long, text string")
             .repartition(n, "range").sortWithinPartitions("range", "ahead", F.col("doc_id").asc_nulls_first(), "text"))
    return dealt.mapInArrow(_compare(n_perm), EDITED)


EDITED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _compare(n_perm: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = permutations(n_perm)
        last = None                                         # (range, id, text, signature) that waits for its successor
        done = None                                         # range whose successor row has come
        for part in slices(batches):
            rows = list(zip(part.column("range").to_pylist(), part.column("ahead").to_pylist(),
                            part.column("doc_id").to_pylist(), strings(part.column("text"))))
            sigs = signatures([t.encode() for *_, t in rows], a, b)
            pairs = []
            for (where, ahead, doc, text), sig in zip(rows, sigs):
                if last is not None and last[0] == where and done != where:
                    pairs.append((*last[1:], text, sig))
                if ahead:
                    done = where                            # later copies of the successor's id are not met
                last = (where, doc, text, sig)
            if pairs:
                yield _results(pairs, a, b)
    return run


def _results(pairs: list[tuple], a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    edited = [edit(text, after).encode() for _, text, _, after, _ in pairs]
    marks = signatures(edited, a, b)
    return pa.RecordBatch.from_arrays([
        pa.array([p[0] for p in pairs], pa.int64()),
        pa.array([len(p[1]) for p in pairs], pa.int64()),
        pa.array([hashlib.sha256(x).hexdigest() for x in edited]),
        pa.array([hexed(p[2]) for p in pairs]),
        pa.array([hexed(m) for m in marks]),
        pa.array([likeness(p[2], m) for p, m in zip(pairs, marks)]),
        pa.array([likeness(p[2], p[4]) for p in pairs])],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def similar(docs: DataFrame, threshold: float = 0.8, bands: int = 32, n_perm: int = N_PERM,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id and class_id, the smallest doc_id reachable
    over pairs of texts with a Jaccard similarity of at least ``threshold`` (a
    whole percentage) that share a band."""
    from . import op12_jaccard_join as join         # it uses the shingles of this module
    percent = round(100 * threshold)
    if not 1 <= percent <= 100 or abs(percent - 100 * threshold) > 1e-9:
        raise ValueError("the threshold is a whole percentage from 0.01 to 1")
    rows = text_rows(docs, id_col, text_col).withColumn("row", F.xxhash64("doc_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = permutations(n_perm)
        seen: set[int] = set()              # an entry for each row of the task, at most
        for part in slices(batches):
            sets = [np.unique(x) for x in shingle_sets(byte_strings(part.column("text")))]
            sids, keys = [join.set_digest(x) for x in sets], []
            for sid, own in zip(sids, sets):
                if sid in seen or not len(own):
                    keys.append(None)
                    continue
                seen.add(sid)
                with np.errstate(over="ignore"):
                    parts = np.split(signature(own, a, b), bands)
                keys.append([int.from_bytes(hashlib.blake2b(bytes([k]) + p.tobytes(), digest_size=8).digest(), "little", signed=True)
                             for k, p in enumerate(parts)])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("row"), pa.array(sids, pa.int64()), pa.array([len(x) for x in sets], pa.int64()),
                 pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "row", "sid", "n", "bands"])

    marked = saved(rows.mapInArrow(run, "doc_id long, row long, sid long, n long, bands array<long>"), "minhash-marked")
    banded = marked.where("bands is not null").select(F.explode("bands").alias("gid"), "sid", F.col("n").alias("size"))
    shared = saved(banded.groupBy("gid").agg(F.min("sid").alias("hub"), F.max("sid").alias("last"), F.count("*").alias("n"))
                   .where("hub < last").select("gid", "hub", "n"), "minhash-bands")
    members = saved(attach(banded, shared, ["gid"]).select("gid", "sid", "hub", F.col("size").alias("n"), F.lit(False).alias("spread")).distinct(),
                    "minhash-members")
    order = docs.sparkSession.sparkContext.broadcast(np.zeros(join.BUCKETS, dtype=np.int8))     # hashes alone order the tries
    found = join.links_within(rows, marked, members, SHINGLE, percent, order)
    classes = join.components_of(marked.select("doc_id", "sid", "n"), found)
    return classes.select("doc_id", F.col("component_id").alias("class_id"))
