"""Incremental line-list ingestion, in batch and with Structured Streaming.

The accumulated line list is an append-only *batch table*:

    <root>/batch=0-<unique>/  the seeded base, de-duplicated by case id once
    <root>/batch=n-<unique>/  rows of update n whose id was not stored yet
    <root>/_manifest/n.json   the commit record of batch n, written last
    <root>/_ids/              the stored ids in buckets (``idindex``)

A batch counts once its record exists, whatever markers the committer of the
file system leaves; records must be numbered without gaps, or reading fails.
Each writer fills a folder of its own and claims the next number by creating
its record (``commits``): a writer that comes second has overwritten nothing,
looks again at what is stored and tries the number after.  A batch that comes
again (same number or same tag) is accepted if its input is the same, by a
fingerprint of its rows, and changes nothing; with other rows it is refused.

A *restore* is one more record, which says that from now on the table is what
it was at an earlier version; later updates go on from there.  ``compact``
writes the rows of many small batches once more as one folder; versions inside
the range can still be read.

Because the stored table is unique on the id, an update only de-duplicates
the incoming file, finds which of its ids are stored (from the id index, whose
rows are not shuffled) and appends the rest — the stored rows are not rewritten.

New files dropped in a landing folder are picked up by a file stream; every
micro-batch becomes the next batch, tagged with the stream's checkpoint and
the micro-batch's number, so a replay after a failure finds its own record
and manual updates may come between.  Of rows with one id the first in file
order stays (files by age, then name).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import update as UP
from ..sources.cases import conform, file_order
from . import commits, idindex
from .commits import Conflict, commit, folder_of, records, vacuum  # noqa: F401  (part of this module's surface)


def live(done: list[dict], upto: int | None = None) -> list[dict]:
    """Records of the batches that make up the table at a version."""
    at: dict[int, list[dict]] = {}
    held: list[dict] = []
    for r in done:
        if upto is None or r["version"] <= upto:
            held = at[r["restores"]] if r.get("restores") is not None else [*held, r]
            at[r["version"]] = held
    return held


def committed_batches(spark: SparkSession, root: str, upto: int | None = None) -> list[int]:
    """Numbers of the batches that make up the table, optionally at a version."""
    return [r["version"] for r in live(records(spark, root), upto)]


def _folders(spark: SparkSession, root: str, held: list[dict]) -> list[str]:
    """Folders with the rows of the batches, compacted ones where they fit."""
    left = {r["version"]: folder_of(root, r) for r in held}
    out = []
    for c in sorted(commits.compactions(spark, root), key=lambda c: -len(c["versions"])):
        if set(c["versions"]) <= set(left):
            out.append(c["path"])
            for v in c["versions"]:
                del left[v]
    return out + list(left.values())


def read_table(spark: SparkSession, root: str, upto: int | None = None) -> DataFrame | None:
    """Union of the committed batches (leaf folders, no partition column)."""
    held = live(records(spark, root), upto)
    return spark.read.parquet(*_folders(spark, root, held)) if held else None


def read_batch(spark: SparkSession, root: str, version: int) -> DataFrame:
    """The rows of one committed batch."""
    return spark.read.parquet(folder_of(root, commits.record_of(spark, root, version)))


def latest_version(spark: SparkSession, root: str) -> int | None:
    done = records(spark, root)
    return done[-1]["version"] if done else None


def read_latest(spark: SparkSession, root: str) -> DataFrame | None:
    return read_table(spark, root)


def fingerprint(df: DataFrame) -> dict:
    """Number of rows and the sum of their hashes, whatever their order."""
    cols = sorted(c for c in df.columns if c != UP.ORDINAL_COL)
    r = df.agg(F.count(F.lit(1)).alias("rows"),
               F.sum(F.xxhash64(*cols).cast("decimal(38,0)")).cast("string").alias("hash")).first()
    return {"rows": r["rows"], "hash": r["hash"] or "0"}


def _write(rows: DataFrame, root: str, version: int, key: str) -> tuple[str, int, bool]:
    """Write a batch and its ids; (folder, number of rows, whether one has no id)."""
    spark = rows.sparkSession
    folder = commits.attempt(root, f"batch={version}")
    obs = Observation(folder.rsplit("/", 1)[-1])
    rows.observe(obs, F.count(F.lit(1)).alias("n"), F.count(F.col(key)).alias("ids")).write.parquet(folder)
    n, ids = int(obs.get["n"]), int(obs.get["ids"])
    idindex.add(spark.read.parquet(folder).select(key), root, folder, key)
    return folder, n, ids < n


def _discard(spark: SparkSession, root: str, folder: str) -> None:
    commits.discard(spark, folder)
    commits.discard(spark, f"{root}/_ids/attempt={idindex.attempt_of(folder)}")


def seed(base: DataFrame, root: str, key: str = "case_id") -> None:
    """Write the stored base as batch 0, de-duplicated by id (first row
    stays), which establishes the unique-id invariant.  A table that has a
    batch is left as it is."""
    spark = base.sparkSession
    if records(spark, root):
        return
    folder, n, no_id = _write(UP.first_rows(base.withColumn(UP.SOURCE_COL, F.lit(0)), key), root, 0, key)
    try:
        commit(spark, root, {"version": 0, "tag": "seed", "input": None, "path": folder, "stored": n, "null_id": no_id})
    except Conflict:                        # another writer has seeded it
        _discard(spark, root, folder)


REPORT = ("existing", "incoming", "duplicates", "added", "version")


def _unseen(new: DataFrame, root: str, held: list[dict], key: str) -> tuple[DataFrame, int]:
    """(rows of the file to append, number of stored rows)"""
    spark = new.sparkSession
    if not held:
        return UP.first_rows(new.withColumn(UP.SOURCE_COL, F.lit(1)), key), 0
    index = idindex.stored(spark, root, [folder_of(root, r) for r in held])
    if index is None or any("null_id" not in r for r in held):          # a table from before the index
        base = spark.read.parquet(*[folder_of(root, r) for r in held])
        return UP.new_rows(base, new, key), base.count()
    first = UP.first_rows(new.withColumn(UP.SOURCE_COL, F.lit(1)), key)
    rows = idindex.unseen(first, *index, key)
    if not any(r["null_id"] for r in held):
        rows = rows.unionByName(first.where(F.col(key).isNull()).withColumn(key, F.col(key).cast(index[1]["type"])))
    return rows, held[-1]["stored"]


def append(new: DataFrame, root: str, version: int | None = None, key: str = "case_id",
           tag: str | None = None, tries: int = 10) -> dict:
    """Append the rows of ``new`` whose id is not stored as the next batch;
    returns the update report.  ``version``, if given, must be the next one or
    name a committed batch of the same input, as ``tag`` may.  Where another
    writer takes the number meanwhile, the rows are matched again with what is
    stored then; with ``version`` given, the update is refused."""
    spark = new.sparkSession
    new = new.persist(StorageLevel.MEMORY_AND_DISK)          # read for the fingerprint, then to be matched
    try:
        given = fingerprint(new)
        for _ in range(tries):
            done = records(spark, root)
            for r in done:
                if r.get("restores") is None and ((tag is not None and r.get("tag") == tag) or (version is not None and r["version"] == version)):
                    if r["input"] != given:
                        raise ValueError(f"batch {r['version']} of {root} is committed with other rows")
                    return {k: r[k] for k in REPORT}
            following = done[-1]["version"] + 1 if done else 1
            if version is not None and version != following:
                raise ValueError(f"version {version} is not the next one, {following}")
            rows, existing = _unseen(new, root, live(done), key)
            folder, added, no_id = _write(rows, root, following, key)
            report = {"existing": existing, "incoming": given["rows"],
                      "duplicates": given["rows"] - added, "added": added, "version": following}
            try:
                before = any(r.get("null_id") for r in live(done))
                commit(spark, root, {**report, "tag": tag, "input": given, "path": folder, "stored": existing + added,
                                     "null_id": no_id or before})
                return report
            except Conflict:
                _discard(spark, root, folder)
        raise Conflict(f"{root}: other writers were first {tries} times")
    finally:
        new.unpersist()


def restore(spark: SparkSession, root: str, version: int) -> int:
    """Make the table what it was at ``version``, by one record; returns the
    number of that record.  No stored row is touched, so it can be undone."""
    done = records(spark, root)
    if version not in [r["version"] for r in done]:
        raise ValueError(f"{root} has no version {version}")
    following = done[-1]["version"] + 1
    held = live(done, version)
    commit(spark, root, {"version": following, "restores": version, "tag": None, "input": None,
                         **{k: held[-1][k] for k in ("stored", "null_id") if k in held[-1]}})
    return following


def compact(spark: SparkSession, root: str, upto: int | None = None, file_bytes: int = 256 << 20, arrange=None) -> str | None:
    """Write the rows of the table's batches (at version ``upto``) once more as
    one folder of large files, which readers take in place of theirs.
    ``arrange(rows, n_files)`` may order them (``sources.cases.clustered``) or
    add up what belongs together, as long as readers find the same in it."""
    held = live(records(spark, root), upto)
    if len(held) < 2:
        return None
    size = sum(fs.getContentSummary(p).getLength() for p, fs in (commits._path(spark, folder_of(root, r)) for r in held))
    versions = [r["version"] for r in held]
    folder = commits.attempt(root, f"compact={versions[0]}-{versions[-1]}")
    rows, files = read_table(spark, root, upto), max(1, -(-size // file_bytes))
    (arrange(rows, files) if arrange else rows.repartition(files)).write.parquet(folder)
    try:
        commits.create(spark, root, f"{versions[0]}-{versions[-1]}-{len(versions)}.compact", {"versions": versions, "path": folder})
    except Conflict:
        commits.discard(spark, folder)
        return None
    return folder


def reports(spark: SparkSession, root: str) -> DataFrame:
    """The update reports of all committed updates."""
    rows = [tuple(r[k] for k in REPORT) for r in records(spark, root) if r["version"] and r.get("restores") is None]
    return spark.createDataFrame(rows, "existing bigint, incoming bigint, duplicates bigint, added bigint, version int")


def start(spark: SparkSession, landing_dir: str, table_root: str, checkpoint: str,
          schema: T.StructType, fmt: str = "csv", once: bool = True, key: str = "case_id"):
    """Start the ingestion query; ``once=True`` processes what is there and
    stops (available-now trigger), otherwise it keeps watching the folder."""
    reader = spark.readStream.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", "true")
    place = F.struct("_metadata.file_modification_time", "_metadata.file_path", "_metadata.file_block_start")
    stream = reader.format(fmt).load(landing_dir).select("*", place.alias(UP.ORDINAL_COL))
    w = (stream.writeStream.foreachBatch(
            lambda df, bid: append(file_order(conform(df)), table_root, None, key, f"{checkpoint}#{bid}"))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime="1 minute")
    return w.start()
