import hashlib
import random
import zlib
from collections import defaultdict

from epispark.llm import op2_sharding as S
from helpers_llm import empty_docs, odd_docs, odd_rows


def test_difference_keeps_every_subset_once():
    rng = random.Random(0)
    for _ in range(50):
        k = rng.randrange(1, 6)
        parts = [[rng.randrange(100) for _ in range(k)] for _ in range(rng.randrange(1, 9))]
        final = S.difference(parts, k)
        assert all(sorted(f) == list(range(k)) for f in final)


def test_difference_on_a_known_case():
    # 8, 7, 6, 5, 4 into two: differencing leaves 16 and 14
    at = S.place([8, 7, 6, 5, 4], 2)
    sums = [sum(x for x, j in zip([8, 7, 6, 5, 4], at) if j == s) for s in range(2)]
    assert sorted(sums) == [14, 16]


def test_small_groups_level_a_given_start():
    start = [1000, 0, 0, 400]
    sizes = [7, 11, 13] * 100 + [1] * 20
    at = S.place(sizes, 4, start)
    sums = list(start)
    for x, j in zip(sizes, at):
        sums[j] += x
    assert max(sums) - min(sums) <= 2 or sums[0] == 1000


def check(rows, got, k):
    texts = dict()
    assert len(got) == len(rows)
    slots, group, size = defaultdict(list), {}, [0] * k
    for r in got:
        slots[r.shard].append(r.slot)
        size[r.shard] += r.size
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    by_id = defaultdict(set)
    for i, t in rows:
        by_id[i].add(t or "")
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None
        match = [t for t in by_id[r.doc_id] if len(t.encode()) + 1 == r.size and zlib.crc32(t.encode()) == r.text_crc32]
        assert match
        assert group.setdefault(match[0], r.shard) == r.shard
    return size


def test_odd_rows(spark):
    size = check(odd_rows(), S.shard(odd_docs(spark), 4).collect(), 4)
    assert len(size) == 4


def test_many_blocks_stay_balanced(spark):
    rng = random.Random(5)
    rows = [(i, "x" * rng.randrange(1, 400)) for i in range(3000)] + [(9000 + i, "y" * 3000) for i in range(40)]
    size = check(rows, S.shard(odd_docs(spark, rows), 8, block_groups=60, slot_rows=100).collect(), 8)
    # one group of 40 rows is larger than a shard should be; all others are level
    assert max(sorted(size)[:-1]) - min(size) <= 0.05 * sum(size) / 8


def test_same_rows_same_shards(spark):
    a = {tuple(r) for r in S.shard(odd_docs(spark), 4).collect()}
    assert a == {tuple(r) for r in S.shard(odd_docs(spark).repartition(5), 4).collect()}


def test_empty(spark):
    assert S.shard(empty_docs(spark)).collect() == []


def plain(sizes, k):
    """Largest differencing by the book: all partial partitions in one list, sorted again at every step."""
    parts = [(n, [(x, [n])] + [(0, [])] * (k - 1)) for n, x in enumerate(sizes)]
    serial = len(parts)
    while len(parts) > 1:
        parts.sort(key=lambda p: (p[1][-1][0] - p[1][0][0], p[0]))
        (_, a), (_, b), *parts = parts
        joined = [(a[i][0] + b[k - 1 - i][0], a[i][1] + b[k - 1 - i][1]) for i in range(k)]
        parts.append((serial, sorted(joined, key=lambda x: -x[0])))
        serial += 1
    return [members for _, members in parts[0][1]]


def test_place_is_a_plain_run():
    rng = random.Random(3)
    for k in (2, 3, 5, 16):
        sizes = [rng.randrange(1, 10**6) for _ in range(120)]
        at = S.place(sizes, k)
        want = sorted(sum(sizes[n] for n in members) for members in plain(sizes, k))
        assert sorted(sum(x for x, j in zip(sizes, at) if j == s) for s in range(k)) == want


def by_text(docs):
    sizes = defaultdict(int)
    for r in docs.select("text").collect():
        sizes[r.text or ""] += len((r.text or "").encode()) + 1
    return [sizes[t] for t in sorted(sizes, key=lambda t: (-sizes[t], hashlib.sha256(t.encode()).digest()))]


def shard_sums(docs, **kw):
    got = [0] * 16
    for r in S.shard(docs, 16, **kw).collect():
        got[r.shard] += r.size
    return got


def test_groups_of_a_size_are_placed_as_a_plain_run_does(spark):
    """Without small groups the operator is one run over all groups."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) > 200")
    sizes = by_text(docs)
    want = sorted(sum(sizes[n] for n in members) for members in plain(sizes, 16))
    assert min(sizes) * S.LARGE >= sum(sizes) and sorted(shard_sums(docs)) == want


def test_whole_table_is_nearly_as_even_as_a_plain_run(spark):
    """Small groups are differenced after the large ones, in blocks: within half
    a percent of a shard of one run over all groups."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    sizes = by_text(docs)
    sums = [sum(sizes[n] for n in members) for members in plain(sizes, 16)]
    for blocks in (20_000, 50):
        got = shard_sums(docs, block_groups=blocks)
        assert sum(got) == sum(sums) and max(got) - min(got) <= max(sums) - min(sums) + 0.005 * sum(sums) / 16
