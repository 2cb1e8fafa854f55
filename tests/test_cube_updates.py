"""Counts kept by batch, and the clustered layout of the clean table."""
from pyspark.sql import functions as F

from epispark.config import Config
from epispark.operators import cube as CB
from epispark.operators import describe as DS
from epispark.plans import catalog, workflows
from epispark.sources import cases as SRC
from epispark.streaming import commits as COM
from epispark.streaming import incremental as INC
from conftest import SF_SMALL
from helpers import raw_df


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def files_of(df):
    return {f.rsplit("/", 2)[0].rsplit("/", 1)[-1] for f in df.inputFiles()}


def test_cube_of_updates_is_the_cube_of_all_cases(spark, tmp_dir):
    """Two updates, a restore and a compaction: always the cells of a rebuild,
    read from the batches' cells alone."""
    cfg, pop, none = Config(), SRC.empty_population(spark), None
    base = raw_df(spark, [{"case_id": i, "age": i % 70} for i in range(1, 40)])
    one = raw_df(spark, [{"case_id": i, "age": i % 70, "sex": "M"} for i in range(30, 60)])
    two = raw_df(spark, [{"case_id": i, "age": i % 7, "local_code": f"00{1 + i % 3}"} for i in range(50, 90)])
    for new in (one, two):
        done = workflows.update(spark, base, new, pop, tmp_dir, None, cfg, none)
        assert done["ok"], done

    def rebuilt(version=None):
        return CB.case_cube(INC.read_table(spark, f"{tmp_dir}/clean", version))

    assert sum(r["n"] for r in workflows.cube_at(spark, tmp_dir).collect()) == 89
    for version in (0, 1, 2, None):
        kept = workflows.cube_at(spark, tmp_dir, version)
        assert rows(kept) == rows(rebuilt(version)) and files_of(kept) == {"cube"}
    workflows.restore(spark, tmp_dir, 1, pop, cfg)
    assert rows(workflows.cube_at(spark, tmp_dir)) == rows(rebuilt(1))
    assert rows(workflows.cube_at(spark, tmp_dir, 2)) == rows(rebuilt(2))
    three = raw_df(spark, [{"case_id": i, "age": 30} for i in range(55, 75)])
    workflows.update(spark, None, three, pop, tmp_dir, None, cfg, none)
    before = rows(rebuilt())
    workflows.maintain(spark, tmp_dir)
    kept = workflows.cube_at(spark, tmp_dir)
    assert rows(kept) == before == rows(rebuilt())
    assert len(INC.read_table(spark, f"{tmp_dir}/cube").inputFiles()) == 1
    assert INC.read_table(spark, f"{tmp_dir}/cube").count() == kept.count()          # added up
    again = workflows.update(spark, None, raw_df(spark, [{"case_id": 500}]), pop, tmp_dir, None, cfg, none)
    assert again["report"]["added"] == 1 and rows(workflows.cube_at(spark, tmp_dir)) == rows(rebuilt())


def test_views_of_added_cells(spark):
    """Parts of the cases by any rule: the sum of their cubes answers as the whole does."""
    i = catalog.inputs(spark, SF_SMALL)
    part = F.pmod(F.xxhash64("case_id"), F.lit(3))
    parts = [CB.case_cube(i.clean.where(part == p)) for p in range(3)]
    cells = CB.add_cells(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert rows(CB.kpis(cells)) == rows(CB.kpis(i.cube))
    assert rows(CB.public_cells(cells)) == rows(DS.public_cells(i.clean))
    assert CB.add_cells(parts[0].limit(0)).count() == 0


def test_publish_from_the_cube_reads_no_case(spark, tmp_dir):
    i = catalog.inputs(spark, SF_SMALL)
    for complementary in (False, True):
        plain = workflows.publish(i.clean, i.index, f"{tmp_dir}/a{complementary}", complementary=complementary)
        cells = workflows.publish(None, i.index, f"{tmp_dir}/b{complementary}", complementary=complementary, cube=i.cube)
        assert rows(spark.read.parquet(cells["cells"])) == rows(spark.read.parquet(plain["cells"]))
        assert rows(spark.read.parquet(cells["areas"])) == rows(spark.read.parquet(plain["areas"]))


def test_republish_without_cube_reads_the_clean_table(spark, tmp_dir):
    """Versions from before cells were kept."""
    cfg, pop = Config(), SRC.empty_population(spark)
    base = raw_df(spark, [{"case_id": i} for i in range(1, 20)])
    workflows.update(spark, base, raw_df(spark, [{"case_id": 99}]), pop, tmp_dir, None, cfg)
    first = workflows.republish(spark, tmp_dir, 1, f"{tmp_dir}/one")
    assert COM.record_of(spark, f"{tmp_dir}/cube", 1) is not None
    here = COM.folder_of(tmp_dir, COM.record_of(spark, f"{tmp_dir}/versions", 1), "version")
    second = workflows.publish(INC.read_table(spark, f"{tmp_dir}/clean", 1), spark.read.parquet(f"{here}/areas"), f"{tmp_dir}/two")
    assert rows(spark.read.parquet(first["cells"])) == rows(spark.read.parquet(second["cells"]))


def test_hidden_weeks_do_not_follow_from_the_moving_mean(spark):
    cells = spark.createDataFrame([(w, n) for w, n in enumerate([9, 8, 3, 7, 9, 9, 9, 2], 1)], "epi_week int, n bigint")
    got = {r["epi_week"]: (r["cases"], r["moving_avg"]) for r in CB.weekly_trend(cells, 4, k=5).collect()}
    assert got == {1: (9, 9.0), 2: (8, 8.5), 4: (7, None), 5: (9, None), 6: (9, None), 7: (9, 8.5)}
    assert CB.weekly_trend(cells, 4).where("epi_week = 3").first()["moving_avg"] == 6.7


def _scanned(df):
    """(rows of the result, rows that the scan of its files returned)"""
    n = len(df.collect())
    plan = df._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().head()
    return n, leaf.metrics().apply("numOutputRows").value()


def test_clustered_layout_lets_the_scan_skip_row_groups(spark, tmp_dir):
    i = catalog.inputs(spark, SF_SMALL)
    SRC.write_clean(i.clean, f"{tmp_dir}/plain")
    SRC.write_clustered(i.clean, f"{tmp_dir}/clustered", files=64)     # some nine ranges a year
    plain, clustered = (SRC.read_clean(spark, f"{tmp_dir}/{x}") for x in ("plain", "clustered"))
    want = dict(region="NATION_1", months=[1, 2, 3])
    a, b = DS.filter_cases(plain, **want), DS.filter_cases(clustered, **want)
    assert rows(a) == rows(b) and rows(plain) == rows(clustered)
    (n, all_), (m, few) = _scanned(a), _scanned(b)
    assert n == m > 0 and few < all_ / 4


def test_a_hot_region_is_cut_into_several_files(spark, tmp_dir):
    df = raw_df(spark, [{"case_id": i, "region_name": "A" if i % 3 else f"R{i}"} for i in range(600)])
    sizes = [r["n"] for r in SRC.clustered(df, 6).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 600 and len(sizes) == 6 and max(sizes) < 250
    assert SRC.clustered(df.limit(0), 3).count() == 0 and SRC.clustered(df.drop("epi_year"), 3).count() == 600
