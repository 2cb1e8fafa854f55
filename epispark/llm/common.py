"""Helpers shared by the text operators: Arrow buffers, word spans and hashes, scratch tables."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_path

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SLICE_BYTES = 2 << 20       # text handled at a time inside a task
LONG_SPAN = 1 << 20         # longer words or lines are hashed by blake2b

_BASE = 0x9E3779B97F4A7C15
_INV = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def saved(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written under the session's checkpoint folder and read again."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, f"llm-{name}")
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, whatever else the table holds."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def attach(rows: DataFrame, facts: DataFrame, key: list[str], most: int = 4096) -> DataFrame:
    """``rows`` with the columns of ``facts`` (one row per ``key``, none of it
    null; column ``n`` says how many rows the key has, and is left out).  The
    ``most`` most frequent keys meet their rows by broadcast, so a key of the
    shuffled rest has at most 1 / ``most`` of all rows."""
    own = facts.drop("n")
    hot = F.broadcast(facts.orderBy(F.col("n").desc(), *key).limit(most).drop("n"))
    return rows.join(hot, key).unionByName(rows.join(hot, key, "left_anti").join(own, key))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``limit`` bytes of ``column`` (a longer row alone)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = offsets(batch.column(column))[1:]
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def offsets(column: pa.Array) -> np.ndarray:
    """Byte offsets of the strings, the first at 0 (nulls are empty)."""
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    if len(column) == 0 or column.buffers()[1] is None:
        return np.zeros(len(column) + 1, dtype=np.int64)
    off = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset:column.offset + len(column) + 1]
    return off.astype(np.int64) - int(off[0])


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all strings, end to end, and their offsets; a null is empty."""
    if column.null_count:
        column = column.fill_null("")
    off = offsets(column)
    if column.buffers()[2] is None or off[-1] == 0:
        return np.zeros(0, dtype=np.uint8), off
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    first = int(np.frombuffer(column.buffers()[1], dtype=kind)[column.offset])
    return np.frombuffer(column.buffers()[2], dtype=np.uint8)[first:first + int(off[-1])], off


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``buffer`` for a list of byte strings."""
    off = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=off[1:])
    return np.frombuffer(b"".join(texts), dtype=np.uint8), off


def spans(data: np.ndarray, off: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs without ``breaks`` (a table over byte values),
    never across two texts, and at which run each text begins."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    word = ~breaks[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    heads = off[:-1][off[:-1] < n]
    first[heads] = word[heads]
    last = word.copy()
    last[:-1] &= ~word[1:]
    tails = off[1:][off[1:] > 0] - 1
    last[tails] = word[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base of the span hash and of its inverse, modulo 2**64."""
    if _powers.get(0) is None or len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for k, base in ((0, _BASE), (1, _INV)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit words."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each of the ascending spans ``data[starts:ends]``: a
    polynomial over the bytes, by prefix sums, mixed with the length."""
    out = np.zeros(len(starts), dtype=np.uint64)
    if not len(starts):
        return out
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, base + LONG_SPAN, side="right")))
        s, e = starts[i:j], ends[i:j]
        if j == i + 1 and e[0] - s[0] > LONG_SPAN:
            word = hashlib.blake2b(data[s[0]:e[0]].tobytes(), digest_size=8).digest()
            out[i] = int.from_bytes(word, "little")
        else:
            part = data[base:int(e[-1])]
            power, inverse = powers(len(part) + 1)
            total = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[:len(part)], out=total[1:])
            s, e = s - base, e - base
            out[i:j] = (total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        i = j
    return mix(out ^ np.uint64(seed & (2**64 - 1)))


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the ``width`` consecutive words; fewer words: of the whole
    sequence; none: none."""
    if not len(words):
        return words
    width = min(width, len(words))
    h = np.zeros(len(words) - width + 1, dtype=np.uint64)
    for k in range(width):
        h = h * np.uint64(0x9FB21C651E98DF25) + words[k:len(words) - width + 1 + k]
        h ^= h >> np.uint64(29)
    return mix(h + np.uint64(width))


def strings(column: pa.Array) -> list[str]:
    return (column.fill_null("") if column.null_count else column).to_pylist()


def byte_strings(column: pa.Array) -> list[bytes]:
    return (column.fill_null("") if column.null_count else column).cast(pa.binary()).to_pylist()
