"""N-gram Jaccard join over a prefix tree.

A document's set holds the distinct shingles of ``width`` words (64-bit
hashes); two documents link when 100 |A and B| >= threshold |A or B|.

Order.  Shingles have one global order, rare before frequent: by the number of
occurrences that their hash bucket has in the whole table (2**20 buckets,
counted in every task and added up), then by hash.  A set of n shingles shares
one of its first n - ceil(threshold n / 100) + 1 with every partner, so these
are its keys; the order leaves what many documents share out of them.

Candidates.  The sets of one key are sorted by size and cut where sizes are too
far apart to link; the first of a run is its hub.  First all sets of one hub
are joined, in shares of ``block`` sets that all hold the hub and about
``LANDMARKS`` more sets; the links' components are classes.  All pairs of a hub with one share have then been
joined.  Runs of a hub with several shares, or of a key that is spread, that
still hold several classes are joined exactly: their sets are dealt into
blocks by class, and every pair of blocks that meets in some run, but for two
of one class, is a unit.  A unit returns spanning links only, never all pairs.

Prefix tree.  A unit's sets, in the global order from the most frequent
shingle down, form a trie: sets with the same frequent shingles share a path,
along which the overlaps with all query sets are added up once.  A query leaves
a subtree when what is left of it, or of the longest set below, cannot reach
the overlap that the sizes ask for, or when links join it to all sets below.

Defined cases: a text of fewer words is one shingle, without words the set is
empty and links with nothing, not even with other empty sets; equal sets link;
null texts are empty; repeated rows are rows of their own; a null id sorts
after all others and is the component of none but itself if it has other
company; an empty table gives no rows; other columns are not read.  Sets are
told apart by a 64-bit digest and their size, shingles by 64-bit hashes: two
different ones of m are taken for equal with a chance of about m**2 / 2**65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import attach, byte_strings, mix, partitions, saved, slices
from .components import components
from .op9_minhash import shingle_sets

BUCKETS, SEGMENT = 1 << 20, 1 << 16     # hash buckets of the global order; sent in segments
HOT = 200_000                           # keys with more occurrences, and over 1 / HOT_KEYS of all, are spread
HOT_KEYS = 1 << 14
BLOCK, WEIGHT = 8192, 1_000_000         # sets and shingles of a block
LANDMARKS = 16
CHUNK = 256                             # shingles of a path between two checks of its bound


def least_overlap(n: np.ndarray, threshold: int) -> np.ndarray:
    """Overlap that a set of n has at least with any partner."""
    return -(-threshold * n // 100)


def set_digest(tokens: np.ndarray) -> int:
    """A 64-bit digest of a sorted set of hashes, as a signed long."""
    with np.errstate(over="ignore"):
        place = mix(np.arange(len(tokens), dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        return int(mix(np.array([(mix(tokens ^ place)).sum(dtype=np.uint64)]) + np.uint64(len(tokens))).view(np.int64)[0])


def sets_of(texts: list[bytes], width: int) -> list[np.ndarray]:
    return [np.unique(x) for x in shingle_sets(texts, width)]


def _bucket(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(40)).astype(np.int64) & (BUCKETS - 1)


def _marked(rows: DataFrame, width: int) -> DataFrame:
    """(doc_id, row, sid, n) of every row, and for each task rows of (seg, counts):
    how often its sets hold a shingle of each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        names = ["doc_id", "row", "sid", "n", "seg", "counts"]
        for part in slices(batches):
            sets = sets_of(byte_strings(part.column("text")), width)
            total += np.bincount(_bucket(np.concatenate(sets)), minlength=BUCKETS)
            none = pa.nulls(part.num_rows, pa.int32()), pa.nulls(part.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("row"), pa.array([set_digest(x) for x in sets], pa.int64()),
                 pa.array([len(x) for x in sets], pa.int64()), *none], names)
        if total.any():
            parts = [p for p in enumerate(np.split(total, BUCKETS // SEGMENT)) if p[1].any()]
            none = pa.nulls(len(parts), pa.int64())
            # small numbers in the low bytes: one plane per byte, so that they compress
            planes = [np.ascontiguousarray(p.view(np.uint8).reshape(-1, 8).T).tobytes() for _, p in parts]
            yield pa.RecordBatch.from_arrays(
                [none, none, none, none, pa.array([s for s, _ in parts], pa.int32()),
                 pa.array([pa.compress(p, "zstd", asbytes=True) for p in planes], pa.binary())], names)

    return rows.mapInArrow(run, "doc_id long, row long, sid long, n long, seg int, counts binary")


def _bucket_counts(marked: DataFrame) -> np.ndarray:
    """Occurrences in each bucket over the whole table (8 MB at any size)."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg, total = None, None
        for batch in batches:
            for s, b in zip(batch.column("seg").to_pylist(), batch.column("counts").to_pylist()):
                planes = np.frombuffer(pa.decompress(b, 8 * SEGMENT, "zstd", asbytes=True), np.uint8).reshape(8, SEGMENT)
                own = np.ascontiguousarray(planes.T).view(np.int64).ravel()
                if s != seg and seg is not None:
                    yield packed(seg, total)
                total = own.copy() if s != seg else total + own
                seg = s
        if seg is not None:
            yield packed(seg, total)

    def packed(seg, total):
        return pa.RecordBatch.from_arrays([pa.array([seg], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["seg", "counts"])

    out = np.zeros(BUCKETS, dtype=np.int64)
    rows = marked.where("seg is not null").select("seg", "counts")
    # tasks' counts are added up in two steps, so that no task gets those of all
    spread = rows.repartition(partitions(marked), "seg", F.pmod(F.xxhash64("counts"), F.lit(64)))
    some = spread.sortWithinPartitions("seg").mapInArrow(merge, "seg int, counts binary")
    packed_again = _repacked(some)
    for r in packed_again.repartition(BUCKETS // SEGMENT, "seg").sortWithinPartitions("seg").mapInArrow(merge, "seg int, counts binary").collect():
        out[r.seg * SEGMENT:(r.seg + 1) * SEGMENT] = np.frombuffer(r.counts, dtype=np.int64)
    return out


def _repacked(some: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            planes = [np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(-1, 8).T).tobytes() for b in batch.column("counts").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("seg"), pa.array([pa.compress(p, "zstd", asbytes=True) for p in planes], pa.binary())],
                                             ["seg", "counts"])
    return some.mapInArrow(run, "seg int, counts binary")


def _keys(rows: DataFrame, width: int, threshold: int, shared: Broadcast, hot: int, usual: int) -> DataFrame:
    """(key, salt, n, sid): the rarest shingles of every set, enough to meet each partner.
    Keys of buckets with over ``hot`` occurrences more than ``usual`` are spread over salts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        seen: set[int] = set()          # one entry per row of the task
        for part in slices(batches):
            keys, salts, sizes, sids = [], [], [], []
            for tokens in sets_of(byte_strings(part.column("text")), width):
                sid, n = set_digest(tokens), len(tokens)
                if not n or sid in seen:
                    continue
                seen.add(sid)
                own = counts[_bucket(tokens)]
                first = np.lexsort((tokens, own))[:n - int(least_overlap(n, threshold)) + 1]
                spread = np.maximum(own[first] - usual, 0) // hot + 1
                keys.append(tokens[first].view(np.int64))
                salts.append(np.where(spread > 1, (sid & 0x7FFFFFFF) % spread, -1))
                sizes.append(np.full(len(first), n))
                sids.append(np.full(len(first), sid))
            if keys:
                key, salt, size, sid = (np.concatenate(x) for x in (keys, salts, sizes, sids))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(salt.astype(np.int32)), pa.array(size.astype(np.int32)), pa.array(sid)],
                                                 ["key", "salt", "n", "sid"])

    return rows.select("text").mapInArrow(run, "key long, salt int, n int, sid long")


def _runs(keyed: DataFrame, threshold: int) -> DataFrame:
    """(gid, sid, hub, n, spread): sets that share a key with another of a size that allows a
    link.  Rows come by (key, salt), sorted by size; only a run's last row is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None                             # (key, salt, n, sid, hub, whether it has been sent)
        for batch in batches:
            if not batch.num_rows:
                continue
            key, salt, n, sid = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("key", "salt", "n", "sid"))
            if last is not None:
                key, salt, n, sid = (np.concatenate([[x], y]) for x, y in zip(last[:4], (key, salt, n, sid)))
            joins = (key[1:] == key[:-1]) & (salt[1:] == salt[:-1]) & (100 * n[:-1] >= threshold * n[1:])
            same = joins & (sid[1:] == sid[:-1])
            start = np.concatenate([[True], ~joins])
            head = np.maximum.accumulate(np.where(start, np.arange(len(key)), 0))
            hub = sid[head]
            if last is not None:
                hub[head == 0] = last[4]
            # a row goes out if its run has another set, or if other salts may have one
            with_next = np.append(joins & ~same, False)
            other = np.bincount(head, weights=with_next, minlength=len(key))[head] > 0
            if last is not None:
                other |= (head == 0) & last[5]
            send = (other | (salt >= 0)) & np.concatenate([[True], ~same])
            if last is not None and last[5]:
                send[0] = False
            with np.errstate(over="ignore"):
                gid = np.where(salt >= 0, key, mix(key.view(np.uint64) ^ mix(hub.view(np.uint64))).view(np.int64))
            sent = bool(other[-1] or salt[-1] >= 0)
            last = (key[-1], salt[-1], n[-1], sid[-1], hub[-1], sent)
            yield pa.RecordBatch.from_arrays([pa.array(x[send]) for x in (gid, sid, hub, n, salt >= 0)], ["gid", "sid", "hub", "n", "spread"])

    return (keyed.repartition(partitions(keyed), "key", "salt").sortWithinPartitions("key", "salt", "n", "sid")
            .mapInArrow(run, "gid long, sid long, hub long, n long, spread boolean"))


class Trie:
    """Prefix tree over ``sets`` (arrays of token numbers, ascending), joined with itself."""

    def __init__(self, sets: list[np.ndarray], labels: np.ndarray, threshold: int):
        self.threshold = threshold
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u4").tobytes())
        self.sets = [sets[i] for i in order]
        self.order = np.array(order)
        self.label = labels[self.order].copy()          # sets known to be linked
        self.size = np.array([len(s) for s in self.sets])
        self.shared = np.array([0, *(self._common(a, b) for a, b in zip(self.sets, self.sets[1:]))])
        flat = np.concatenate(self.sets).astype(np.int64)
        owner = np.repeat(np.arange(len(sets)), self.size)
        self.tokens = int(flat.max()) + 1
        self.start = np.concatenate([[0], np.cumsum(self.size)])
        self.flat = owner * self.tokens + flat          # ascending: how far a query is at a token
        by_token = np.argsort(flat, kind="stable")
        self.holders = owner[by_token]
        self.first = np.searchsorted(flat[by_token], np.arange(self.tokens + 1))

    @staticmethod
    def _common(a: np.ndarray, b: np.ndarray) -> int:
        n = min(len(a), len(b))
        differ = np.flatnonzero(a[:n] != b[:n])
        return int(differ[0]) if len(differ) else n

    def _gain(self, tokens: np.ndarray) -> np.ndarray:
        """How many of the tokens each set holds."""
        size = self.first[tokens + 1] - self.first[tokens]
        at = np.repeat(self.first[tokens] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(int(size.sum()))
        return np.bincount(self.holders[at], minlength=len(self.sets))

    def links(self) -> list[tuple[int, int]]:
        """Spanning links, by place in the list of sets given."""
        out: list[tuple[int, int]] = []
        every = np.arange(len(self.sets))
        # a node: the sets [lo, hi) with one path, its depth so far, the queries that are left and their overlaps
        nodes = [(0, len(self.sets), 0, every, np.zeros(len(every), dtype=np.int64))]
        while nodes:
            lo, hi, depth, query, overlap = nodes.pop()
            keep = self._open(lo, hi, query)
            query, overlap = query[keep], overlap[keep]
            end = int(self.size[lo]) if hi - lo == 1 else int(self.shared[lo + 1:hi].min())
            low, high = int(self.size[lo:hi].min()), int(self.size[lo:hi].max())
            while len(query) and depth < end:
                step = self.sets[lo][depth:min(end, depth + CHUNK)]
                overlap = overlap + self._gain(step)[query]
                depth += len(step)
                left = self.size[query] - (np.searchsorted(self.flat, query * self.tokens + int(step[-1]), side="right") - self.start[query])
                need = self.threshold * self.size[query]
                able = (((100 + self.threshold) * (overlap + left) >= need + self.threshold * low)
                        & (100 * high >= need + (100 + self.threshold) * (depth - overlap)))
                query, overlap = query[able], overlap[able]
            if not len(query):
                continue
            heads = [lo, *(lo + 1 + np.flatnonzero(self.shared[lo + 1:hi] == depth)).tolist(), hi]
            if self.size[lo] == depth:                  # the path is a whole set: the overlaps are final
                near = query[(query != lo) & ((100 + self.threshold) * overlap >= self.threshold * (self.size[query] + depth))]
                out += self._union(lo, near)
                heads = heads[1:]
            for a, b in zip(heads, heads[1:]):
                nodes.append((a, b, depth, query, overlap))
        return out

    def _open(self, lo: int, hi: int, query: np.ndarray) -> np.ndarray:
        """Queries that a link to one of [lo, hi) would tell something new; a pair is met at its first set."""
        own = self.label[lo:hi]
        keep = query > lo
        if (own == own[0]).all():
            keep &= self.label[query] != own[0]
        return keep

    def _union(self, one: int, others: np.ndarray) -> list[tuple[int, int]]:
        out = []
        for label, at in zip(*np.unique(self.label[others], return_index=True)):
            if label != self.label[one]:
                out.append((int(self.order[others[at]]), int(self.order[one])))
                self.label[self.label == label] = self.label[one]
        return out


def unit_links(tokens: list[np.ndarray], labels: np.ndarray, counts: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Spanning links between the sets, in a trie from the most frequent token down."""
    known = np.unique(np.concatenate(tokens))
    rank = np.empty(len(known), dtype=np.int64)
    rank[np.lexsort((known, counts[_bucket(known)]))[::-1]] = np.arange(len(known))
    return Trie([np.sort(rank[np.searchsorted(known, t)]) for t in tokens], labels, threshold).links()


def _joined(units: DataFrame, sets: DataFrame, unit: list[str], width: int, threshold: int, shared: Broadcast) -> DataFrame:
    """Links (u, v) found in the units; ``units`` has ``unit``, sid and root (a class known before)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        key, held = None, {}

        def out() -> pa.RecordBatch:
            sids, (texts, roots) = list(held), zip(*held.values())
            _, labels = np.unique(np.array(roots), return_inverse=True)
            links = unit_links(sets_of(texts, width), labels, counts, threshold) if len(sids) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([sids[a] for a, _ in links], pa.int64()),
                                               pa.array([sids[b] for _, b in links], pa.int64())], ["u", "v"])

        for part in slices(batches):
            tags = zip(*(part.column(c).to_pylist() for c in unit))
            rows = zip(part.column("sid").to_pylist(), byte_strings(part.column("text")), part.column("root").to_pylist())
            for tag, (sid, text, root) in zip(tags, rows):
                if tag != key:
                    if held:
                        yield out()
                    key, held = tag, {}
                held[sid] = (text, root)
        if held:
            yield out()

    return (units.join(sets, "sid").repartition(partitions(units), *unit).sortWithinPartitions(*unit, "sid")
            .select(*unit, "sid", "root", "text").mapInArrow(run, "u long, v long"))


def _hash(*columns) -> Column:
    return F.xxhash64(*[F.lit(c) if isinstance(c, int) else c for c in columns])


def _hubs(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(hub, sid) once each, and (hub, k, n): the number of its shares and sets."""
    star = saved(members.select("hub", "sid", F.col("n").alias("size")).union(
        members.where("sid = hub").select("hub", F.col("hub").alias("sid"), F.col("n").alias("size"))).distinct(), "jaccard-stars")
    shares = F.ceil(F.greatest(F.count("*") / F.lit(BLOCK), F.sum("size") / F.lit(WEIGHT))).cast("int")
    return star.drop("size"), saved(star.groupBy("hub").agg(shares.alias("k"), F.count("*").alias("n")), "jaccard-hubs")


def _hub_units(star: DataFrame, hubs: DataFrame) -> DataFrame:
    """(hub, share, sid, root): the sets of each hub in shares, the hub and landmarks in all of them."""
    many = hubs.where("n > 1").withColumn("m", F.col("n"))
    every = F.greatest(F.lit(1).cast("long"), (F.col("m") / F.lit(LANDMARKS)).cast("long"))
    landmark = (F.col("sid") == F.col("hub")) | (F.pmod(_hash("sid", 7), every) == 0)
    share = F.when(landmark, F.sequence(F.lit(0), F.col("k") - 1)).otherwise(F.array(F.pmod(_hash("sid", 11), F.col("k")).cast("int")))
    return attach(star, many, ["hub"]).select("hub", F.explode(share).alias("share"), "sid", F.col("sid").alias("root"))


def _open_units(members: DataFrame, hubs: DataFrame, classes: DataFrame) -> DataFrame:
    """(one, two, sid, root): pairs of blocks of sets that meet in a run, that no
    one share has held, and are not of one class."""
    shared_out = attach(members.where("not spread"), hubs.where("k > 1").select("hub", "n"), ["hub"])
    members = shared_out.unionByName(members.where("spread"))
    rooted = members.join(classes, "sid", "left").select("gid", "sid", "hub", "n", F.coalesce("root", "sid").alias("root"))
    rooted = saved(rooted, "jaccard-rooted")
    several = rooted.groupBy("gid").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("gid")
    still = saved(rooted.join(several, "gid"), "jaccard-open")
    sets = still.groupBy("sid", "root").agg(F.min("hub").alias("home"), F.max("n").alias("n"))
    by_class = sets.groupBy("home", "root").agg(F.count("*").alias("m"), F.sum("n").alias("w"))
    wanted = lambda m, w: F.ceil(F.greatest(m / F.lit(BLOCK), w / F.lit(WEIGHT))).cast("int")
    by_class = by_class.withColumn("k", wanted(F.col("m"), F.col("w"))).withColumn("large", F.col("k") > 1)
    small = by_class.where("not large").groupBy("home").agg(wanted(F.sum("m"), F.sum("w")).alias("k_home"))
    dealt = by_class.join(small, "home", "left").select("home", "root", "large", F.when(F.col("large"), F.col("k")).otherwise(F.col("k_home")).alias("k"), F.col("m").alias("n"))
    block = F.when(F.col("large"), _hash("home", "root", 1, F.pmod(_hash("sid", 3), "k"))).otherwise(_hash("home", 2, F.pmod(_hash("root", 3), "k")))
    placed = saved(attach(sets.drop("n"), dealt, ["home", "root"]).select("sid", "root", block.alias("block"),
                                                             F.when(F.col("large"), F.col("root")).alias("mono")), "jaccard-placed")
    met = saved(still.select("gid", "sid").join(placed.select("sid", "block", "mono"), "sid").select("gid", "block", "mono").distinct(), "jaccard-met")
    two = met.select("gid", F.col("block").alias("two"), F.col("mono").alias("mono2"))
    pairs = (met.withColumnRenamed("block", "one").join(two, "gid")
             .where("one <= two and not coalesce(mono = mono2, false)").select("one", "two").distinct())
    pairs = saved(pairs, "jaccard-blocks")
    left = pairs.join(placed.withColumnRenamed("block", "one"), "one").select("one", "two", "sid", "root")
    right = pairs.where("one <> two").join(placed.withColumnRenamed("block", "two"), "two").select("one", "two", "sid", "root")
    return left.union(right)


def links(rows: DataFrame, marked: DataFrame, width: int, threshold: int) -> DataFrame:
    """Links (u, v) between set digests that span the components of all links."""
    spark = rows.sparkSession
    counts = _bucket_counts(marked)
    total = int(counts.sum())
    shared = spark.sparkContext.broadcast(counts)
    keyed = _keys(rows, width, threshold, shared, max(HOT, total // HOT_KEYS), total // BUCKETS)
    members = saved(_runs(keyed, threshold), "jaccard-runs")
    return links_within(rows, marked, members, width, threshold, shared)


def links_within(rows: DataFrame, marked: DataFrame, members: DataFrame, width: int, threshold: int, shared: Broadcast) -> DataFrame:
    """Links that span the components of all links between sets of one run:
    ``members`` has (gid, sid, hub, n, spread), ``shared`` the order's counts."""
    # one row of each candidate set: that with the smallest id
    sets = marked.where("sid is not null").groupBy("sid").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("low"))
    wanted = members.select("sid").distinct().join(sets, "sid").select("sid", F.col("low.row").alias("row"))
    candidates = saved(_one_each(rows.select("row", "text").join(wanted, "row"), width), "jaccard-sets")
    star, hubs = _hubs(members)
    first = saved(_joined(_hub_units(star, hubs), candidates, ["hub", "share"], width, threshold, shared), "jaccard-first")
    classes = components(first).withColumnRenamed("u", "sid")
    rest = saved(_joined(_open_units(members, hubs, classes), candidates, ["one", "two"], width, threshold, shared), "jaccard-rest")
    return first.unionByName(rest)


def _one_each(rows: DataFrame, width: int) -> DataFrame:
    """(sid, text): rows whose text has the set that is looked for, one of them per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for part in slices(batches):
            sids = part.column("sid").to_pylist()
            take = []
            for i, tokens in enumerate(sets_of(byte_strings(part.column("text")), width)):
                if sids[i] not in seen and set_digest(tokens) == sids[i]:
                    seen.add(sids[i])
                    take.append(i)
            yield pa.RecordBatch.from_arrays([part.column(c).take(pa.array(take, pa.int64())) for c in ("sid", "text")], ["sid", "text"])

    return rows.select("sid", "text").mapInArrow(run, "sid long, text string")


def jaccard_components(docs: DataFrame, width: int = 5, threshold: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles and component_id, the smallest doc_id that links reach."""
    if not 1 <= threshold <= 100:
        raise ValueError("the threshold is a percentage from 1 to 100")
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .withColumn("row", F.xxhash64("doc_id", "text")))
    marked = saved(_marked(rows, width), "jaccard-marked")
    own = marked.where("sid is not null").select("doc_id", "sid", "n")
    full = components_of(own.where("n > 0"), links(rows, marked, width, threshold))
    empty = own.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.select("doc_id", F.col("size").alias("n_shingles"), "component_id").unionByName(empty)


def components_of(own: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, size, component_id) of the rows (doc_id, sid, n) under the links ``found``."""
    sets = saved(own.groupBy("sid", F.col("n").alias("size")).agg(F.min("doc_id").alias("low"), F.count("*").alias("n")), "jaccard-distinct")
    roots = components(found).withColumnRenamed("u", "sid")
    classes = saved(sets.join(roots, "sid", "left").withColumn("root", F.coalesce("root", "sid")), "jaccard-classes")
    lowest = classes.groupBy("root").agg(F.min("low").alias("component_id"), F.count("*").alias("n"))
    by_set = attach(classes.select("root", "sid", "size", F.col("n").alias("rows")), saved(lowest, "jaccard-lowest"), ["root"])
    by_set = saved(by_set.select("sid", "size", "component_id", F.col("rows").alias("n")), "jaccard-by-set")
    return attach(own.select("doc_id", "sid", F.col("n").alias("size")), by_set, ["sid", "size"]).select("doc_id", "size", "component_id")
