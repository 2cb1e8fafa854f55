"""Sharding by Karmarkar-Karp differencing.

Rows with equal texts form one indivisible group.  A step of the method takes
the two partial partitions with the largest spread and joins the largest
subset of one with the smallest of the other, and so on in opposite orders.

Groups of at least 1/4096 of all bytes (at most 4096 of them, whatever the
input) are differenced first.  All other groups are dealt by the hash of
their text's digest into blocks of about ``block_groups``, and each block is
differenced in a task of its own, beginning with the block's share of the
large groups' partial partition; so the small groups of every block level
what the large ones leave uneven, and the blocks' subsets add up to shards
whose sizes differ by little more than a few bytes a block.

Defined cases: a null text is an empty one; an empty table gives no rows;
repeated rows are rows of one group, each with its own slot; null ids are
placed like others.  Columns other than the id and the text are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, text_rows

LARGE = 4096                # a group of at least this part of all bytes is large


def difference(parts: list[list[int]], k: int) -> list[list[int]]:
    """For partial partitions, each given by the ``k`` sums of its subsets:
    the final subset (0 to k-1) of every subset, by largest differencing."""
    children: list[tuple] = []
    heap = []
    for p, sums in enumerate(parts):
        order = sorted(range(k), key=lambda i: (-sums[i], i))
        nodes = []
        for i in order:
            nodes.append(len(children))
            children.append((p, i))
        s = [sums[i] for i in order]
        heap.append((s[-1] - s[0], p, s, nodes))
    heapq.heapify(heap)
    serial = len(parts)
    while len(heap) > 1:
        _, _, a, na = heapq.heappop(heap)
        _, _, b, nb = heapq.heappop(heap)
        merged = []
        for i in range(k):
            merged.append((a[i] + b[k - 1 - i], len(children)))
            children.append((-1, na[i], nb[k - 1 - i]))
        merged.sort(key=lambda x: (-x[0], x[1]))
        s = [x[0] for x in merged]
        heapq.heappush(heap, (s[-1] - s[0], serial, s, [x[1] for x in merged]))
        serial += 1
    final = [[0] * k for _ in parts]
    todo = [(node, j) for j, node in enumerate(heap[0][3])] if heap else []
    while todo:
        node, j = todo.pop()
        kids = children[node]
        if kids[0] == -1:
            todo += [(kids[1], j), (kids[2], j)]
        else:
            final[kids[0]][kids[1]] = j
    return final


def place(sizes: list[int], k: int, start: list[int] | None = None) -> list[int]:
    """Subset of each group of the given size; with ``start``, the sums that
    the subsets already have (they keep their numbers)."""
    parts = [[x] + [0] * (k - 1) for x in sizes]
    if start is None:
        return [f[0] for f in difference(parts, k)]
    final = difference([start, *parts], k)
    number = {f: j for j, f in enumerate(final[0])}
    return [number[f[0]] for f in final[1:]]


def balanced_groups(groups: DataFrame, n_shards: int = 16, block_groups: int = 20_000) -> DataFrame:
    """(digest, shard) for groups (digest binary, bytes long)."""
    n, total = groups.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    is_large = F.col("bytes") * LARGE >= F.lit(total)
    large = sorted(((r.bytes, bytes(r.digest)) for r in groups.where(is_large).collect()), key=lambda x: (-x[0], x[1]))
    at = place([x for x, _ in large], n_shards) if large else []
    start = [0] * n_shards
    for (x, _), j in zip(large, at):
        start[j] += x
    rest = total - sum(start)

    def block(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["bytes", "digest"], ascending=[False, True], kind="stable")
        sizes = frame["bytes"].tolist()
        own = sum(sizes)
        frame["shard"] = place(sizes, n_shards, [x * own // rest for x in start])
        return frame[["digest", "shard"]]

    blocks = max(1, math.ceil(n / block_groups))
    small = (groups.where(~is_large).withColumn("block", F.pmod(F.xxhash64("digest"), F.lit(blocks)).cast("int"))
             .groupBy("block").applyInPandas(block, "digest binary, shard int"))
    first = groups.sparkSession.createDataFrame([(bytearray(d), j) for (_, d), j in zip(large, at)],
                                                "digest binary, shard int")
    return small.unionByName(first)


def shard(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
          block_groups: int = 20_000, slot_rows: int = 20_000) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot,
    grown_shard.  Sizes of the shards are as equal as the groups allow; slots
    count from 0 in each shard without gaps, in an order fixed by the rows."""
    base = saved(text_rows(docs, id_col, text_col).select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest")), "shard-rows")
    groups = saved(base.groupBy("digest").agg(F.sum("size").alias("bytes")), "shard-groups")
    shards = balanced_groups(groups, n_shards, block_groups)
    bins = max(1, math.ceil(base.count() / slot_rows))
    rows = saved(base.join(shards, "digest").withColumn(
        "bin", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(bins)).cast("int")), "shard-placed")
    ahead = (rows.groupBy("shard", "bin").agg(F.count("*").alias("n"))
             .select("shard", "bin", (F.sum("n").over(
                 Window.partitionBy("shard").orderBy("bin")) - F.col("n")).alias("before")))
    local = F.row_number().over(Window.partitionBy("shard", "bin").orderBy("doc_id", "digest"))
    return rows.join(ahead, ["shard", "bin"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("before") + local - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, placed: DataFrame, path: str, columns: Iterable[str] = ("doc_id", "text")) -> None:
    """The rows of ``docs`` as Parquet, a folder per shard (``doc_id`` unique)."""
    docs.select(*columns).join(placed.select("doc_id", "shard"), "doc_id").write.partitionBy("shard").parquet(path)
