"""Composed workflows: batch index, incremental update, publication.

Each workflow writes its outputs as new versioned folders and returns the
paths; nothing is overwritten in place, so a failure leaves the previous
published version intact (switch happens by reading the newest version).

An update touches the new rows alone: they are appended to the accumulated
table, cleaned and appended to the clean table, and their counts by area and
by the cells of the case cube are kept beside those of earlier batches.
Counts add up, so the index, the descriptive tables and the published cells
are made from the counts of all batches, never from stored cases.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..operators import clean as CL
from ..operators import cube as CB
from ..operators import describe as DS
from ..operators import disclosure as DC
from ..operators import index as IX
from ..operators import privacy as PV
from ..operators import validate as VA
from ..session import materialize
from ..sources import cases as SRC
from ..streaming import commits as COM
from ..streaming import incremental as INC


def batch_index(raw: DataFrame, population: DataFrame, out_root: str,
                cfg: Config | None = None, aliases=None) -> dict:
    """read -> clean (written, partitioned by year) -> area index (written)
    -> ranking extract (CSV)."""
    cfg = cfg or Config()
    spark = raw.sparkSession
    clean_path = f"{out_root}/clean"
    # audit counts gathered while the clean table is written (no extra pass)
    obs = Observation("clean_audit")
    cleaned = CL.clean(raw, cfg, aliases).observe(
        obs, F.count(F.lit(1)).alias("rows_out"),
        F.sum(F.col("onset_corrected").cast("int")).alias("onset_corrected"),
        F.sum(F.col("age_inconsistent").cast("int")).alias("age_inconsistent"))
    SRC.write_clean(cleaned, clean_path)
    clean = spark.read.parquet(clean_path)
    idx = IX.index_flow(clean, population, cfg)
    SRC.write_areas(idx, f"{out_root}/areas", f"{out_root}/ranking_csv")
    return {"clean": clean_path, "areas": f"{out_root}/areas",
            "ranking": f"{out_root}/ranking_csv", "audit": dict(obs.get)}


def publish(clean: DataFrame | None, idx: DataFrame, out_root: str, k: int = 5,
            fmt: str = "parquet", complementary: bool = False, cube: DataFrame | None = None) -> dict:
    """Write only suppressed aggregates (Parquet, or CSV with a header for
    hand-off files); refuse to publish a frame that fails the k-anonymity
    check.  ``complementary`` also hides the second areas and cells without
    which a small one follows from a total (``operators.disclosure``); without
    it small ones alone are left out.  With ``cube`` the cells are those of the
    case cube, and ``clean`` is not read."""
    counted = CB.public_cells(cube) if cube is not None else DS.public_cells(clean)
    if complementary:
        marked = materialize(DC.protected_areas(idx.select(*DC.AREA, "cases"), k))
        shown = DC.published(marked).select(*[F.col(c).alias(f"_{c}") for c in DC.AREA])
        same = [idx[c].eqNullSafe(shown[f"_{c}"]) for c in DC.AREA]
        areas = idx.join(shown, same, "left_semi").drop(*[c for c in idx.columns if c.endswith("_norm")])
        cells = DC.published(DC.protect_cells(counted, marked, k))
    else:
        areas = PV.public_areas(idx, k).drop(*[c for c in idx.columns if c.endswith("_norm")])
        cells = PV.suppress(counted, "cases", k)
    for name, frame in (("areas", areas), ("cells", cells)):
        chk = PV.k_anonymity_check(frame, "cases", k).first()
        if not chk["is_safe"]:
            raise ValueError(f"{name}: not safe to publish ({chk})")
    for name, frame in (("public_areas", areas), ("public_cells", cells)):
        w = frame.write.mode("overwrite")
        if fmt == "csv":
            w.option("header", "true").csv(f"{out_root}/{name}")
        else:
            w.parquet(f"{out_root}/{name}")
    return {"areas": f"{out_root}/public_areas", "cells": f"{out_root}/public_cells"}


def _extend(spark: SparkSession, table: str, out_root: str, cfg: Config, aliases) -> None:
    """Clean every accumulated batch that is not in the clean table yet, and
    count its cases by area and by cell.  Restores of the accumulated table
    are repeated."""
    clean_root = f"{out_root}/clean"
    for root, make in (
            (clean_root, lambda n: CL.clean(INC.read_batch(spark, table, n), cfg, aliases)),
            (f"{out_root}/area_counts", lambda n: IX.area_counts(INC.read_batch(spark, clean_root, n))),
            (f"{out_root}/cube", lambda n: CB.case_cube(INC.read_batch(spark, clean_root, n)))):
        done = {r["version"] for r in INC.records(spark, root)}
        for r in INC.records(spark, table):
            n = r["version"]
            if n not in done and r.get("restores") is not None:
                _claim(spark, root, {"version": n, "restores": r["restores"]})
            elif n not in done:
                path = COM.attempt(root, f"batch={n}")
                make(n).write.parquet(path)
                _claim(spark, root, {"version": n, "path": path})


def _claim(spark: SparkSession, root: str, record: dict) -> dict:
    """Commit a record; where another writer has done the same work, keep its result."""
    try:
        COM.commit(spark, root, record)
        return record
    except COM.Conflict:
        if "path" in record:
            COM.discard(spark, record["path"])
        return COM.record_of(spark, root, record["version"])


def update(spark: SparkSession, base, new: DataFrame, population: DataFrame, out_root: str,
           version: int | None = None, cfg: Config | None = None, aliases=None, models: bool = False) -> dict:
    """validate -> append the new file's unseen case ids to the accumulated
    batch table (stored rows win) -> clean and count the new batch -> index,
    ranking extract and, if asked for, clusters and class metrics of
    ``version=<n>``.

    ``base`` seeds an empty table: a DataFrame, or a list of (path, format)
    candidates of which the first that exists is taken, or None.  Stops before
    writing anything when the new file has a triggered error.  Repeating an
    update gives the same version again (see ``streaming.incremental``)."""
    cfg = cfg or Config()
    found = VA.findings(new, cfg)
    errors = found.where((F.col("severity") == "error") & F.col("triggered")).collect()
    if errors:
        return {"ok": False, "errors": [r["rule_id"] for r in errors]}
    table = f"{out_root}/accumulated"
    if isinstance(base, list):
        base = None if INC.records(spark, table) else SRC.resolve_base(spark, base, cfg)
    if base is not None:
        INC.seed(base, table)
    report = INC.append(new, table, version)
    paths = _outputs(spark, table, out_root, report["version"], population, cfg, aliases, models)
    return {"ok": True, "report": report, "table": table, **paths}


def restore(spark: SparkSession, out_root: str, version: int, population: DataFrame, cfg: Config | None = None,
            aliases=None, models: bool = False) -> dict:
    """Take the accumulated table back to ``version`` in one step, and write
    the index of what it then holds as a version of its own."""
    table = f"{out_root}/accumulated"
    n = INC.restore(spark, table, version)
    return {"version": n, "table": table, **_outputs(spark, table, out_root, n, population, cfg or Config(), aliases, models)}


def cube_at(spark: SparkSession, out_root: str, version: int | None = None) -> DataFrame | None:
    """The case cube of an update's output (at a version): the sum of the
    cells that each batch was counted into.  Tables from before the cube was
    kept get theirs with the next update."""
    cells = INC.read_table(spark, f"{out_root}/cube", version)
    return CB.add_cells(cells) if cells is not None else None


def maintain(spark: SparkSession, out_root: str, upto: int | None = None) -> None:
    """Write the many small batches of past updates once more: accumulated
    rows as they are, clean rows clustered for the reader's filter, area
    counts and cells added up, so that no read grows with the number of updates."""
    for name, arrange in (("accumulated", None), ("clean", SRC.clustered),
                          ("area_counts", lambda rows, n: IX.add_counts(rows).coalesce(n)),
                          ("cube", lambda rows, n: CB.add_cells(rows).coalesce(n))):
        INC.compact(spark, f"{out_root}/{name}", upto, arrange=arrange)


def _outputs(spark: SparkSession, table: str, out_root: str, n: int, population: DataFrame, cfg: Config, aliases,
             models: bool) -> dict:
    """Clean, count and index version ``n``; the folder of the outputs is
    named by a record, so two runs of one version do not mix."""
    _extend(spark, table, out_root, cfg, aliases)
    counts = INC.read_table(spark, f"{out_root}/area_counts", n)
    areas = IX.populated(IX.area_shares(IX.add_counts(counts)), population, cfg)
    here = COM.attempt(out_root, f"version={n}")
    idx = IX.priority_index(areas, cfg)
    SRC.write_areas(idx, f"{here}/areas", f"{here}/ranking_csv")
    paths = {"clean": f"{out_root}/clean", "cube": f"{out_root}/cube", "areas": f"{here}/areas", "ranking": f"{here}/ranking_csv"}
    if models:
        from ..operators import ml as ML
        idx = spark.read.parquet(paths["areas"])
        ML.kmeans(idx, cfg).write.mode("overwrite").parquet(f"{here}/clusters")
        paths["clusters"] = f"{here}/clusters"
        known = idx.where(F.col("cases") >= cfg.min_cases).agg(F.count(F.lit(1)), F.count_distinct("priority")).first()
        if known[0] >= 5 and known[1] >= 2:         # else there is nothing to tell apart
            ML.metrics(ML.forest_predictions(idx, cfg)).write.mode("overwrite").parquet(f"{here}/metrics")
            paths["metrics"] = f"{here}/metrics"
    kept = _claim(spark, f"{out_root}/versions", {"version": n, "path": here})["path"]
    return {k: v.replace(here, kept, 1) for k, v in paths.items()}


def republish(spark: SparkSession, out_root: str, version: int, dest: str, k: int = 5) -> dict:
    """Publish an earlier version again: its areas, and the cells of the
    batches up to it, from the cube where that holds all of them."""
    here = COM.folder_of(out_root, COM.record_of(spark, f"{out_root}/versions", version), "version")
    counted = COM.record_of(spark, f"{out_root}/cube", version) is not None
    clean = None if counted else INC.read_table(spark, f"{out_root}/clean", version)
    return publish(clean, spark.read.parquet(f"{here}/areas"), dest, k,
                   cube=cube_at(spark, out_root, version) if counted else None)


def dashboard_tables(clean: DataFrame | None, idx: DataFrame, cube: DataFrame | None = None, k: int = 5,
                     **filters) -> dict:
    """The parameterised tables behind the interactive views, answered from
    the case cube (built and checkpointed here when not given), so a filter
    change never rescans case rows; index tables are global.  Rows that count
    fewer than ``k`` cases are left out of every table with a count."""
    cube = cube if cube is not None else materialize(CB.case_cube(clean))
    sel = CB.filter_cube(cube, **filters)
    safe = lambda df, c="cases": PV.suppress(df, c, k)
    return {"kpis": safe(CB.kpis_filtered(sel), "total_cases"), "by_sex": safe(CB.by_sex(sel)),
            "by_age_group": safe(CB.by_age_group(sel)),
            "by_region": safe(CB.by_region(sel)).orderBy(F.col("cases").desc(), "region_name")
                           .limit(15),
            "by_area": CB.public_top_areas(sel, k, 20),
            "weekly": CB.weekly_trend(sel, k=k),
            "ranking": IX.top_ranking(safe(idx), 20), "distribution": IX.priority_distribution(idx)}
