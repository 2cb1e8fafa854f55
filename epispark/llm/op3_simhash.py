"""SimHash near-duplicates by Golay-code fuzzy hashing.

Fingerprint: 64 bits; a bit is set if more than half of the shingles' XXH64
values have it set.  Documents link when their fingerprints differ in at most
``distance`` (3) bits; components of links are the groups.

Candidates.  The fingerprint is cut into two halves of 32 bits.  Of three
differing bits at most one falls into one of the halves (pigeonhole).

* None there: the halves agree, which is one key of 32 bits each.
* One there, so at most two in the other half: of that half's three parts (11,
  11 and 10 bits) one agrees, and its bits join every key.  The half with one
  differing bit is a segment of 23 bits and a rest of 9.  If the bit falls
  into the segment, the two segments share a codeword of the perfect binary
  Golay code [23,12,7] within distance 4 of both: the codeword nearest to one
  is at most 3 away from it, hence at most 4 from the other.  So every segment
  gets the codewords within distance 4 as keys (six for 86 % of all words, one
  for the rest), each joined with the exact rest.  If the bit falls into the
  rest, the exact segments agree, which is one more key.

Candidates of a key are compared bit by bit, so only true links remain.

Only distinct fingerprints are compared.  Keys shared by more than
``block`` fingerprints are dealt into blocks and every pair of blocks is one
unit of work, so no task needs a whole hot key; a unit returns at most one
link per member (a spanning forest of its links), never all pairs.

Defined cases: null and empty texts have no shingle and fingerprint zero,
linked like any other; fewer words than a shingle give one shingle of the
whole sequence; a null id is a document of its own that sorts after all
others; repeated rows are returned as often as they come; an empty table
gives no rows; columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import byte_strings, partitions, saved, slices, text_rows
from .components import components

#: Fixed value: generator polynomial of the binary Golay code, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GOLAY = 0b101011100011
FINGERPRINT = "doc_id long, fp long"


def simhash_bits(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Fingerprints (uint64) of runs of shingle hashes that end at ``ends``."""
    out = np.zeros(len(ends), dtype=np.uint64)
    start = 0
    for i, end in enumerate(ends):
        n = int(end) - start
        if n:
            counts = np.zeros(64, dtype=np.int64)
            for a in range(start, int(end), 1 << 16):
                part = hashes[a:min(int(end), a + (1 << 16))]
                counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1,
                                        bitorder="little").sum(axis=0, dtype=np.int64)
            out[i] = np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0]
        start = int(end)
    return out


def shingle_spans(text: bytes, width: int) -> list[bytes]:
    """The shingles of one text: A-Z lower-cased words joined by one space."""
    words = text.lower().split()
    if len(words) <= width:
        return [b" ".join(words)] if words else []
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    return [line[s:e] for s, e in zip(starts[:len(words) - width + 1].tolist(), ends[width - 1:].tolist())]


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42,
                 id_col: str = "doc_id", text_col: str = "text", row: Column | None = None) -> DataFrame:
    """(doc_id, fp): the 64-bit fingerprint as a signed long, one row per row;
    with ``row`` (a long) beside the id, if given."""
    texts = text_rows(docs, id_col, text_col)
    if row is not None:
        texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), row.alias("row"), F.col(text_col).cast("string").alias("text"))
    kept = [c for c in texts.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            hashes, ends = [], []
            for text in byte_strings(part.column("text")):
                own = shingle_spans(text, shingle)
                hashes.append(np.fromiter((xxh64_intdigest(x, seed) for x in own), dtype=np.uint64, count=len(own)))
                ends.append(len(own))
            fp = simhash_bits(np.concatenate(hashes), np.cumsum(ends))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in kept), pa.array(fp.view(np.int64), pa.int64())], [*kept, "fp"])

    return texts.mapInArrow(run, FINGERPRINT if row is None else "doc_id long, row long, fp long")


def _syndromes(x: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator polynomial."""
    r = x.astype(np.uint32).copy()
    for bit in range(22, 10, -1):
        r ^= np.where((r >> np.uint32(bit)) & np.uint32(1), np.uint32(GOLAY << (bit - 11)), np.uint32(0))
    return r


def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: the error patterns of weight 4 or less (up to six), and how many."""
    patterns = np.array([sum(1 << b for b in bits) for w in range(5) for bits in combinations(range(23), w)],
                        dtype=np.uint32)
    table, count = np.zeros((2048, 6), dtype=np.uint32), np.zeros(2048, dtype=np.int64)
    for s, p in zip(_syndromes(patterns).tolist(), patterns.tolist()):
        table[s, count[s]] = p
        count[s] += 1
    return table, count


def segment_keys(fp: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) pairs of the fingerprints; a key holds its kind, the exact
    bits and the codeword's index."""
    table, count = tables
    rows, keys = [], []
    every = np.arange(len(fp))
    halves = [((fp >> np.uint64(32 * h)) & np.uint64(0xFFFFFFFF)).astype(np.int64) for h in range(2)]
    for h in range(2):
        word, other = halves[h], halves[1 - h]
        segment, rest = (word & ((1 << 23) - 1)).astype(np.uint32), word >> 23
        syndrome = _syndromes(segment)
        rows.append(every)
        keys.append((h << 40) | word)
        for q, part in enumerate((other & 0x7FF, (other >> 11) & 0x7FF, other >> 22)):
            kind = 2 + 2 * (3 * h + q)
            for k in range(6):
                has = np.flatnonzero(count[syndrome] > k)
                index = ((segment[has] ^ table[syndrome[has], k]) >> np.uint32(11)).astype(np.int64)   # the 12 leading bits
                rows.append(has)
                keys.append((kind << 40) | (part[has] << 21) | (rest[has] << 12) | index)
            rows.append(every)
            keys.append((kind + 1 << 40) | (part << 23) | segment.astype(np.int64))
    return np.concatenate(rows), np.concatenate(keys)


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest member of each of ``n`` nodes' components under links a-b."""
    label = np.arange(n)
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return label
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))    # roots take a smaller root
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def _unit_links(unit: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of whole units that lie end to end: each member is
    compared with the k-th after it, for every k that stays in the unit."""
    n = len(fp)
    label = np.arange(n)
    left = np.arange(n)
    k = 1
    while True:
        left = left[left + k < n]
        left = left[unit[left] == unit[left + k]]
        if not len(left):
            break
        apart = label[left] != label[left + k]
        at = left[apart]
        near = at[_popcount(fp[at] ^ fp[at + k]) <= distance]
        if len(near):
            label = forest(label[near], label[near + k], n)[label]
        k += 1
    child = np.flatnonzero(label != np.arange(n))
    return fp[child], fp[label[child]]


def near_links(distinct: DataFrame, distance: int = 3, block: int = 512) -> DataFrame:
    """Links (u, v) between distinct fingerprints ``fp`` that span the same
    components as all links of at most ``distance`` (0 to 3) bits."""
    if not 0 <= distance <= 3:
        raise ValueError("the keys cover distances from 0 to 3")

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = golay_tables()
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            for i in range(0, len(fp), 50_000):
                row, key = segment_keys(fp[i:i + 50_000], tables)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(fp[i:i + 50_000][row].view(np.int64))], ["key", "fp"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = fp = None
        columns = ["key", "one", "two", "fp"]

        def out(unit, fp):
            u, v = _unit_links(unit, fp.view(np.uint64), distance)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key, one, two, more = (batch.column(c).to_numpy(zero_copy_only=False) for c in columns)
            tag = np.stack([key, one, two])
            if unit is not None:
                tag, more = np.concatenate([unit, tag], axis=1), np.concatenate([fp, more])
            new = np.flatnonzero((tag[:, 1:] != tag[:, :-1]).any(axis=0)) + 1
            cut = int(new[-1]) if len(new) else 0
            if cut:
                number = np.zeros(cut, dtype=np.int64)
                number[new[new < cut]] = 1
                yield out(np.cumsum(number), more[:cut])
            unit, fp = tag[:, cut:], more[cut:]
        if unit is not None:
            yield out(np.zeros(len(fp), dtype=np.int64), fp)

    keyed = saved(distinct.select("fp").mapInArrow(expand, "key long, fp long"), "golay-keys")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("b")).cast("int")
    # a member of block i belongs to the units (i, j) for all j, the smaller number first
    dealt = (keyed.join(sizes, "key").withColumn("b", blocks).withColumn("i", own)
             .withColumn("j", F.explode(F.when(F.col("b") == 1, F.array(F.lit(0)))
                                        .otherwise(F.sequence(F.lit(0), F.col("b") - 1))))
             .select("key", F.least("i", "j").cast("int").alias("one"),
                     F.greatest("i", "j").cast("int").alias("two"), "fp"))
    n = partitions(distinct)
    return (dealt.repartition(n, "key", "one", "two").sortWithinPartitions("key", "one", "two", "fp")
            .mapInArrow(compare, "u long, v long"))


def first_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group, all columns as they were: that with the smallest
    id (null last); of rows with one id, that with the smallest hash of its
    columns; of rows equal in all of them, one."""
    # a column of maps has no hash: rows that differ in it alone count as equal
    hashed = F.xxhash64(*[c for c, kind in docs.dtypes if "map<" not in kind])
    keys = saved(fingerprints(docs, id_col=id_col, text_col=text_col, row=hashed).groupBy("doc_id", "row", "fp")
                 .agg(F.count("*").alias("n")), "simhash-keys")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    distinct = saved(keys.groupBy("fp").agg(F.min(order).alias("low")), "simhash-firsts")
    found = components(near_links(distinct)).withColumnRenamed("u", "fp")
    classes = distinct.join(found, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    by_fp = classes.join(classes.groupBy("root").agg(F.min("low").alias("first")), "root").select("fp", "first")
    judged = saved(keys.join(by_fp, "fp").select(F.col("doc_id").alias("_id2"), F.col("row").alias("_row2"), "n",
                                                 order.eqNullSafe(F.col("first")).alias("_stays"))
                   .where("n > 1 or not _stays").drop("n"), "simhash-judged")
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), hashed.alias("_row"), "*")
    same = rows["_id"].eqNullSafe(judged["_id2"]) & (rows["_row"] == judged["_row2"])
    out = rows.join(judged, same, "left_anti")
    again = judged.where("_stays")
    if not again.isEmpty():
        out = out.unionByName(rows.join(again, same, "left_semi").dropDuplicates(["_id", "_row"]))
    return out.select(*docs.columns)


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3, seed: int = 42,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits) and
    component_id, the smallest doc_id reachable over links."""
    marked = saved(fingerprints(docs, shingle, seed, id_col, text_col), "simhash")
    distinct = saved(marked.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-distinct")
    found = components(near_links(distinct, distance)).withColumnRenamed("u", "fp")
    classes = (distinct.join(found, "fp", "left")
               .select("fp", "low", F.coalesce("root", "fp").alias("root")))
    lowest = classes.groupBy("root").agg(F.min("low").alias("component_id"))
    by_fp = saved(classes.join(lowest, "root").select("fp", "component_id"), "simhash-classes")
    return marked.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
