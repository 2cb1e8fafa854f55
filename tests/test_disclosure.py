import random
from collections import defaultdict

import numpy as np
import pytest
from epispark.operators import disclosure as DC
from pyspark.sql import functions as F

KEYS = ["region_name", "local_name", "area_code"]


def areas_of(spark, rng, regions=12):
    rows = []
    for r in range(regions):
        for a in range(rng.randrange(1, 7)):
            rows.append((f"{r}-{a}", f"R{r}", f"L{a}", rng.choice([1, 2, 3, 4, 5, 6, 9, 30])))
    return spark.createDataFrame(rows, "area_code string, region_name string, local_name string, cases bigint")


def determined(lines, hidden, k=5):
    """Hidden rows whose count the published totals fix: unknowns of a linear system."""
    names = sorted({x for line in lines for x in line})
    if not names:
        return set()
    a = np.array([[1.0 if n in line else 0.0 for n in names] for line in lines])
    rank = np.linalg.matrix_rank(a)
    out = set()
    for i, n in enumerate(names):
        unit = np.zeros((1, len(names)))
        unit[0, i] = 1
        if np.linalg.matrix_rank(np.vstack([a, unit])) == rank:
            out.add(n)
    return out


@pytest.mark.parametrize("seed", range(5))
def test_no_hidden_area_follows_from_totals(spark, seed):
    rng = random.Random(seed)
    areas = areas_of(spark, rng)
    marked = DC.protected_areas(areas, 5).collect()
    by_region = defaultdict(list)
    for r in marked:
        by_region[r["region_name"]].append(r)
    assert all(r["hidden"] for r in marked if r["cases"] < 5)
    # unknowns: hidden areas, and the totals of regions that are not published
    regions = DC.protect(areas.groupBy("region_name").agg(F.sum("cases").alias("cases")), ["region_name"]).collect()
    secret = {r["region_name"] for r in regions if r["hidden"]}
    lines = [{("region", n) for n in secret}]
    for name, rows in by_region.items():
        own = {("area", r["area_code"]) for r in rows if r["hidden"]}
        lines.append(own | ({("region", name)} if name in secret else set()))
        if name not in secret and own:
            assert sum(r["cases"] for r in rows if r["hidden"]) >= 5
    lines = [x for x in lines if x]
    total = sum(r["cases"] for r in regions)
    alone = len(secret) == len(regions) == 1            # the nation is one region under k
    assert not determined(lines, None) or alone or total < 5
    audit = DC.audit(DC.protected_areas(areas, 5), DC.REGION, "x").first()
    assert audit["solved"] == 0
    plain = DC.audit(areas.withColumn("hidden", F.when(F.col("cases") < 5, "small")), DC.REGION, "x").first()
    single = sum(1 for rows in by_region.values() if sum(r["cases"] for r in rows) >= 5 and sum(r["cases"] < 5 for r in rows) == 1)
    assert plain["solved"] >= single


def test_second_row_is_the_smallest_published(spark):
    df = spark.createDataFrame([("a", "R", "x", 3), ("b", "R", "x", 9), ("c", "R", "x", 7), ("d", "R", "x", 7), ("e", "S", "x", 2), ("f", "S", "x", 3),
                                ("g", "S", "x", 50), (None, "T", None, 1), ("h", "T", "x", 8), ("i", "T", "x", 6)],
                               "area_code string, region_name string, local_name string, cases bigint")
    got = {r["area_code"]: r["hidden"] for r in DC.protected_areas(df).collect()}
    assert got == {"a": "small", "b": None, "c": "second", "d": None, "e": "small", "f": "small", "g": None, None: "small", "h": None, "i": "second"}


def test_cells_of_hidden_areas_are_hidden(spark):
    from epispark.plans import catalog
    from conftest import SF_SMALL
    i = catalog.inputs(spark, SF_SMALL)
    areas = DC.protected_areas(i.index.select(*DC.AREA, "cases"), 5)
    cells = DC.protected_cells(i.clean, areas, 5)
    hidden = {tuple(r) for r in areas.where("hidden is not null").select(*DC.AREA).collect()}
    for r in cells.collect():
        if tuple(r[c] for c in DC.AREA) in hidden:
            assert r["hidden"] == "parent"
        elif r["cases"] < 5:
            assert r["hidden"] == "small"


def test_complementary_publication(spark, tmp_dir):
    from epispark.plans import catalog, workflows
    from conftest import SF_SMALL
    i = catalog.inputs(spark, SF_SMALL)
    plain = workflows.publish(i.clean, i.index, f"{tmp_dir}/plain")
    safe = workflows.publish(i.clean, i.index, f"{tmp_dir}/safe", complementary=True)
    rows = [{tuple(r) for r in spark.read.parquet(p["areas"]).select(*DC.AREA, "cases").collect()} for p in (plain, safe)]
    want = {tuple(r)[:4] for r in DC.protected_areas(i.index.select(*DC.AREA, "cases"), 5).where("hidden is null").collect()}
    assert rows[1] == want and rows[1] <= rows[0]
