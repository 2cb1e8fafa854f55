import os

import pytest
from epispark.streaming import incremental as INC
from helpers import RAW_SCHEMA, raw_df


def test_incremental_merge_versions(spark, tmp_dir):
    from pyspark.sql.types import _parse_datatype_string
    schema = _parse_datatype_string(RAW_SCHEMA)
    landing, table, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/table", f"{tmp_dir}/ckpt"
    raw_df(spark, [{"case_id": i} for i in range(1, 6)]).write.parquet(f"{landing}/f1")
    q = INC.start(spark, landing + "/*", table, ckpt, schema, fmt="parquet", once=True)
    q.awaitTermination(120)
    assert INC.latest_version(spark, table) == 1
    raw_df(spark, [{"case_id": i, "age": 99} for i in range(4, 9)]).write.parquet(f"{landing}/f2")
    q = INC.start(spark, landing + "/*", table, ckpt, schema, fmt="parquet", once=True)
    q.awaitTermination(120)
    assert INC.latest_version(spark, table) == 2
    cur = INC.read_latest(spark, table)
    ages = {r["case_id"]: r["age"] for r in cur.collect()}
    assert sorted(ages) == list(range(1, 9)) and ages[4] == 24 and ages[8] == 99
    rep = INC.reports(spark, table).where("version = 2").first()
    assert rep["added"] == 3 and rep["duplicates"] == 2


def test_batch_table_restore_and_replay(spark, tmp_dir):
    table = f"{tmp_dir}/acc"
    INC.seed(raw_df(spark, [{"case_id": i} for i in range(3)]), table)
    INC.append(raw_df(spark, [{"case_id": i} for i in range(2, 6)]), table, 1)
    INC.append(raw_df(spark, [{"case_id": i} for i in range(5, 9)]), table, 2)
    assert INC.read_table(spark, table).count() == 9
    assert INC.read_table(spark, table, upto=1).count() == 6          # restore version 1
    rep = INC.append(raw_df(spark, [{"case_id": i} for i in range(5, 9)]), table, 2)
    assert rep["added"] == 3 and INC.read_table(spark, table).count() == 9  # replay is idempotent


def test_versions_are_neither_reused_nor_skipped(spark, tmp_dir):
    table = f"{tmp_dir}/acc"
    INC.append(raw_df(spark, [{"case_id": i} for i in range(10)]), table, 1)
    with pytest.raises(ValueError, match="other rows"):
        INC.append(raw_df(spark, [{"case_id": i} for i in range(20, 30)]), table, 1)
    for wrong in (0, 3):
        with pytest.raises(ValueError, match="not the next"):
            INC.append(raw_df(spark, [{"case_id": 77}]), table, wrong)
    INC.append(raw_df(spark, [{"case_id": i} for i in range(5, 15)]), table)
    assert INC.read_table(spark, table).count() == 15 and INC.latest_version(spark, table) == 2


def test_a_missing_commit_record_fails_loudly(spark, tmp_dir):
    table = f"{tmp_dir}/acc"
    INC.seed(raw_df(spark, [{"case_id": 1}]), table)
    INC.append(raw_df(spark, [{"case_id": 2}]), table)
    INC.append(raw_df(spark, [{"case_id": 3}]), table)
    os.remove(f"{table}/_manifest/1.json")
    with pytest.raises(RuntimeError, match="missing"):
        INC.read_table(spark, table)


def test_an_uncommitted_folder_does_not_count(spark, tmp_dir):
    table = f"{tmp_dir}/acc"
    INC.append(raw_df(spark, [{"case_id": 1}]), table)
    raw_df(spark, [{"case_id": 9}]).write.parquet(f"{table}/batch=2")       # a writer that died before its commit
    assert INC.read_table(spark, table).count() == 1
    INC.append(raw_df(spark, [{"case_id": 2}]), table)
    assert sorted(r["case_id"] for r in INC.read_table(spark, table).collect()) == [1, 2]


def test_stream_and_manual_updates_may_alternate(spark, tmp_dir):
    from pyspark.sql.types import _parse_datatype_string
    table, landing = f"{tmp_dir}/table", f"{tmp_dir}/landing"
    INC.append(raw_df(spark, [{"case_id": 1}]), table)
    raw_df(spark, [{"case_id": 2}]).write.parquet(f"{landing}/f1")
    INC.start(spark, landing + "/*", table, f"{tmp_dir}/ckpt", _parse_datatype_string(RAW_SCHEMA), fmt="parquet").awaitTermination(120)
    INC.append(raw_df(spark, [{"case_id": 3}]), table)
    assert INC.committed_batches(spark, table) == [1, 2, 3] and INC.read_table(spark, table).count() == 3


def test_csv_landing_files(spark, tmp_dir):
    from pyspark.sql.types import StringType, StructField, StructType
    from epispark.sources import cases as SRC
    cols = ["case_id", "epi_year", "age", "sex"]
    schema = StructType([StructField(c, StringType()) for c in cols])
    with open(f"{tmp_dir}/base.csv", "w") as f:
        f.write("case_id,epi_year,age,sex\nA1,2024,20,F\nA2,2024,30,M\n")
    os.makedirs(f"{tmp_dir}/landing")
    with open(f"{tmp_dir}/landing/new.csv", "w") as f:
        f.write("case_id,epi_year,age,sex\nA2,2024,99,F\nA3,2024,40,M\nA3,2024,41,M\n")
    table = f"{tmp_dir}/table"
    INC.seed(SRC.read_cases(spark, f"{tmp_dir}/base.csv", "csv", columns=cols), table)
    q = INC.start(spark, f"{tmp_dir}/landing", table, f"{tmp_dir}/ckpt", schema, fmt="csv")
    q.awaitTermination(120)
    got = {r["case_id"]: r["age"] for r in INC.read_table(spark, table).collect()}
    assert got == {"A1": 20, "A2": 30, "A3": 40}


def _ids(spark, table, upto=None):
    return sorted(r["case_id"] for r in INC.read_table(spark, table, upto).collect())


def test_a_writer_that_comes_second_overwrites_nothing(spark, tmp_dir, monkeypatch):
    """Another writer commits between this one's look at the table and its own commit."""
    table = f"{tmp_dir}/acc"
    mk = lambda *ids: raw_df(spark, [{"case_id": i} for i in ids])
    INC.seed(mk(*range(10)), table)
    real, other = INC._write, []

    def between(rows, root, version, key):
        out = real(rows, root, version, key)
        if not other:
            other.append(None)
            other[0] = INC.append(mk(8, 10, 11, 12, 13, 14), table)
        return out
    monkeypatch.setattr(INC, "_write", between)
    late = INC.append(mk(9, 14, 20, 21, 22), table)
    assert other[0]["version"] == 1 and other[0]["added"] == 5
    assert late["version"] == 2 and late["added"] == 3 and late["existing"] == 15      # 14 is stored by now
    assert _ids(spark, table) == [*range(15), 20, 21, 22]
    assert _ids(spark, table, 1) == list(range(15))
    other.clear()
    with pytest.raises(ValueError, match="other rows"):
        INC.append(mk(30), table, 3)                                                    # the other took 3 first
    assert _ids(spark, table) == [*range(15), 20, 21, 22]
    assert len([f for f in os.listdir(table) if f.startswith("batch=")]) == 4           # nothing is left of those that lost


def test_two_threads_both_end_with_their_rows(spark, tmp_dir):
    import threading
    table = f"{tmp_dir}/acc"
    INC.seed(raw_df(spark, [{"case_id": i} for i in range(5)]), table)
    done, errors = [], []

    def write(start):
        try:
            done.append(INC.append(raw_df(spark, [{"case_id": i} for i in range(start, start + 6)]), table))
        except Exception as e:      # shown by the assertion below
            errors.append(e)
    threads = [threading.Thread(target=write, args=(s,)) for s in (3, 6, 20)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and sorted(r["version"] for r in done) == [1, 2, 3]
    assert _ids(spark, table) == [*range(12), *range(20, 26)]


def test_restore_is_one_record(spark, tmp_dir):
    table = f"{tmp_dir}/acc"
    mk = lambda *ids: raw_df(spark, [{"case_id": i} for i in ids])
    INC.seed(mk(1, 2), table)
    INC.append(mk(2, 3, None), table)
    INC.append(mk(4, None), table)
    assert INC.restore(spark, table, 0) == 3
    assert _ids(spark, table) == [1, 2] and INC.read_table(spark, table, 2).count() == 5
    rep = INC.append(mk(3, None, 9), table)                 # what was taken back is new again
    assert rep == {"existing": 2, "incoming": 3, "duplicates": 0, "added": 3, "version": 4}
    assert INC.restore(spark, table, 2) == 5 and INC.read_table(spark, table).count() == 5
    assert INC.reports(spark, table).count() == 3
    with pytest.raises(ValueError, match="no version"):
        INC.restore(spark, table, 77)


def test_compacted_batches_read_alike(spark, tmp_dir):
    table = f"{tmp_dir}/acc"
    INC.seed(raw_df(spark, [{"case_id": 0}]), table)
    for n in range(1, 5):
        INC.append(raw_df(spark, [{"case_id": n}, {"case_id": n - 1}]), table)
    folder = INC.compact(spark, table, upto=3)
    assert INC.compact(spark, table, upto=3) is None        # it is there
    files = INC.read_table(spark, table).inputFiles()
    assert any(folder.rsplit("/", 1)[-1] in f for f in files) and len({f.rsplit("/", 2)[1] for f in files}) == 2
    assert [_ids(spark, table, n) for n in (0, 2, 3, 4)] == [[0], [0, 1, 2], [0, 1, 2, 3], [0, 1, 2, 3, 4]]
    assert INC.append(raw_df(spark, [{"case_id": 1}, {"case_id": 5}]), table)["added"] == 1
    raw_df(spark, [{"case_id": 99}]).write.parquet(f"{table}/batch=9-lost")
    assert INC.vacuum(spark, table) == [] and INC.vacuum(spark, table, -1) == ["batch=9-lost"]
    assert _ids(spark, table) == [0, 1, 2, 3, 4, 5]


def test_stored_ids_are_not_shuffled(spark, tmp_dir):
    from pyspark.sql import functions as F
    from epispark.operators import update as UP
    from epispark.streaming import idindex
    table = f"{tmp_dir}/acc"
    INC.seed(raw_df(spark, [{"case_id": i} for i in range(500)]), table)
    INC.append(raw_df(spark, [{"case_id": i} for i in range(400, 700)]), table)
    folders = [INC.folder_of(table, r) for r in INC.records(spark, table)]
    first = UP.dedup_first(raw_df(spark, [{"case_id": i} for i in range(600, 900)]).withColumn(UP.SOURCE_COL, F.lit(1)))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = idindex.unseen(first, *idindex.stored(spark, table, folders), "case_id")
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert rows.count() == 200
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    scan = plan[plan.index("FileScan") if "FileScan" in plan else 0:]
    stored_side = plan.split("ids_", 1)[0].rsplit("SortMergeJoin", 1)[-1]
    assert "Bucketed: true" in scan and plan.count("Exchange hashpartitioning") == 2        # de-duplication, and into the buckets
    assert "Exchange" not in stored_side.split(":- ")[-1].split("+- ")[-1]


def test_first_row_by_file_order_over_many_splits(spark, tmp_dir):
    """Rows in files of any size: numbers follow path, then place in the file."""
    from epispark.sources import cases as SRC
    os.makedirs(f"{tmp_dir}/in")
    want, n = {}, 0
    for name, count in (("a", 1), ("b", 199), ("c", 40)):
        with open(f"{tmp_dir}/in/{name}.csv", "w") as f:
            f.write("case_id,age\n")
            for i in range(count):
                f.write(f"{i % 50},{1000 - n}\n")
                want.setdefault(str(i % 50), 1000 - n)
                n += 1
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        rows = SRC.read_cases(spark, f"{tmp_dir}/in", columns=["case_id", "age"], ordinal=True)
        assert rows.rdd.getNumPartitions() > 5
        got = {r["_ordinal"]: int(r["age"]) for r in rows.collect()}
        assert got == {k: 1000 - k for k in range(n)}
        from epispark.operators import update as UP
        from pyspark.sql import functions as F
        first = UP.dedup_first(rows.withColumn(UP.SOURCE_COL, F.lit(1)))
        assert {r["case_id"]: int(r["age"]) for r in first.collect()} == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_snapshots_are_never_overwritten(spark, tmp_dir):
    from epispark.sources import cases as SRC
    from epispark.streaming.commits import Conflict
    SRC.write_snapshot(raw_df(spark, [{"case_id": 1}]), tmp_dir, 1)
    with pytest.raises(Conflict):
        SRC.write_snapshot(raw_df(spark, [{"case_id": 2}]), tmp_dir, 1)
    assert SRC.read_snapshot(spark, tmp_dir, 1).first()["case_id"] == 1
