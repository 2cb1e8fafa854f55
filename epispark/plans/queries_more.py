"""Registered queries beyond the flagship, one per inventory key.

Every query runs over the whole stand-in tables.  Column names match the
oracle SQL in ``checks/oracle_sql.py``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import derive as D
from ..functions.core import accent_key
from ..operators import charts as CH
from ..operators import clean as CL
from ..operators import crosstab as XT
from ..operators import cube as CB
from ..operators import describe as DS
from ..operators import disclosure as DC
from ..operators import index as IX
from ..operators import joins as J
from ..operators import privacy as PV
from ..operators import profile as PF
from ..operators import recommend as RC
from ..operators import update as UP
from ..operators import validate as VA
from ..operators import windows as WN
from ..sources import cases as SRC
from ..streaming import incremental as INC
from ..session import scratch_path
from .catalog import YEAR_CFG, inputs, portable, query

# --------------------------------------------------------------------------
# 2.1 sources and sinks
# --------------------------------------------------------------------------
CSV_OPTS = {"header": "true", "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false"}


@query("src_cases")
def src_cases(spark, d):
    """Write the raw line list as CSV text, read it back through the typed
    CSV reader (all-text schema + try_cast)."""
    raw = inputs(spark, d).raw
    path = scratch_path(spark, "raw_csv")
    raw.write.options(**CSV_OPTS).csv(path)
    reader = spark.read.options(**CSV_OPTS).schema(
        ", ".join(f"`{c}` string" for c in raw.columns))
    return SRC.conform(reader.csv(path), {"case_id": "bigint"})     # numeric ids


@query("src_population")
def src_population(spark, d):
    pop = inputs(spark, d).population
    path = scratch_path(spark, "population_csv")
    pop.select("area_code", F.lit(None).cast("string").alias("region"),
               F.lit(None).cast("string").alias("local"), "population") \
       .write.option("header", "true").csv(path)
    return SRC.read_population(spark, path)


@query("src_clean")
def src_clean(spark, d):
    """Persist the clean table (Parquet, partitioned by year) and re-read."""
    path = scratch_path(spark, "clean_parquet")
    SRC.write_clean(inputs(spark, d).clean, path)
    return portable(SRC.read_clean(spark, path))


@query("snk_ranking_export")
def snk_ranking_export(spark, d):
    """Rounded ranking extract, small areas suppressed."""
    idx = PV.suppress(inputs(spark, d).index, "cases", 5)
    from ..functions.core import round_half_even as r
    return idx.select("rank", "region_name", "local_name", "cases",
                      r("rate_100k", 1).alias("rate_100k"), r("score", 1).alias("score"),
                      "priority")


@query("snk_clean")
def snk_clean(spark, d):
    """The clean table written partitioned by year, counted from its files."""
    path = scratch_path(spark, "clean_by_year")
    SRC.write_clean(inputs(spark, d).clean, path)
    return SRC.read_clean(spark, path).groupBy("epi_year").agg(F.count(F.lit(1)).cast("bigint").alias("cases"))


@query("snk_area")
def snk_area(spark, d):
    """The ranking extract as its reader finds it (small areas left out)."""
    path = scratch_path(spark, "areas")
    SRC.write_areas(inputs(spark, d).index, path, f"{path}-csv")
    return spark.read.option("header", "true").schema(
        "rank int, region_name string, local_name string, cases bigint, rate_100k double, pct_adolescent double, "
        "trend double, score double, priority string").csv(f"{path}-csv")


@query("snk_public")
def snk_public(spark, d):
    """The published area table (suppressed, checked, written, read again)."""
    from . import workflows
    i = inputs(spark, d)
    done = workflows.publish(i.clean, i.index, scratch_path(spark, "public"))
    return spark.read.parquet(done["areas"]).select(
        "area_code", "region_name", "local_name", "cases", "score", "priority", "rank")


@query("src_resolve_base")
def src_resolve_base(spark, d):
    """The stored base of an update: the first candidate that exists."""
    path = scratch_path(spark, "base")
    inputs(spark, d).raw.write.parquet(path)
    return SRC.resolve_base(spark, [(f"{path}-accumulated", "parquet"), (path, "parquet")]).select(
        "case_id", "event_code", "epi_year", "age")


@query("snk_snapshot")
def snk_snapshot(spark, d):
    root = scratch_path(spark, "snapshots")
    SRC.write_snapshot(inputs(spark, d).clean, root, 1)
    return SRC.read_snapshot(spark, root, 1).select("case_id", "area_code", "epi_year")


# --------------------------------------------------------------------------
# 2.2 profiling (typed raw file)
# --------------------------------------------------------------------------
def _typed(spark, d):
    return inputs(spark, d).typed_raw


@query("prof_shape")
def prof_shape(spark, d):
    return PF.shape(_typed(spark, d))


@query("prof_head")
def prof_head(spark, d):
    return PF.head(_typed(spark, d), 3)


query("prof_dtypes")(lambda s, d: PF.dtypes(_typed(s, d)))
query("prof_column_roles")(lambda s, d: PF.column_role_table(_typed(s, d), 10.0))


@query("prof_describe")
def prof_describe(spark, d):
    return PF.describe(_typed(spark, d), ("age", "epi_week"))


@query("prof_dup_rows")
def prof_dup_rows(spark, d):
    return PF.duplicate_rows(_typed(spark, d))


@query("prof_dup_ids")
def prof_dup_ids(spark, d):
    return PF.duplicate_ids(_typed(spark, d))


@query("prof_null_pct")
def prof_null_pct(spark, d):
    return PF.null_pct(_typed(spark, d))


@query("prof_value_counts")
def prof_value_counts(spark, d):
    return PF.value_counts(_typed(spark, d))


@query("prof_top_regions")
def prof_top_regions(spark, d):
    return PF.top_values(_typed(spark, d), "region_name", 5)


@query("prof_empty_columns")
def prof_empty_columns(spark, d):
    """The raw file with a column that nobody filled in."""
    return PF.empty_columns(_typed(spark, d).withColumn("died_on", F.lit(None).cast("string")))


@query("prof_code_uniqueness")
def prof_code_uniqueness(spark, d):
    return PF.code_uniqueness(inputs(spark, d).clean)


@query("prof_code_names")
def prof_code_names(spark, d):
    """Codes of the raw file, whose names are not yet spelled alike."""
    return PF.codes_with_several_names(CL.area_code(_typed(spark, d), inputs(spark, d).cfg))


@query("prof_code_sample")
def prof_code_sample(spark, d):
    return PF.regions_sharing_code(inputs(spark, d).clean, "001", 8)


# --------------------------------------------------------------------------
# 2.3 validation (raw file: one scan for the counts, one for offending values)
# --------------------------------------------------------------------------
VAL_KEYS = {"not_empty": "val_not_empty", "max_rows": "val_max_rows",
            "required_columns": "val_required_columns", "empty_required": "val_empty_required",
            "empty_other": "val_empty_other", "year": "val_year",
            "date_format": "val_date_format", "date_year": "val_date_year",
            "sex_domain": "val_sex_domain", "area_domain": "val_area_domain",
            "hospital_domain": "val_hospital_domain", "short_region_code": "val_short_codes",
            "short_local_code": "val_short_local_codes", "age_not_numeric": "val_age_text",
            "age_range": "val_age_range", "event_code": "val_event_code",
            "optional_columns": "val_optional_columns"}


def _findings(spark, d, rules=None):
    return VA.findings(inputs(spark, d).raw, YEAR_CFG, rules)


@query("val_findings")
def val_findings(spark, d):
    return portable(_findings(spark, d))


@query("val_offending_values")
def val_offending_values(spark, d):
    """Every offending value of every rule that lists values, with its rows."""
    return VA.offending_values(inputs(spark, d).raw, YEAR_CFG)


def _rule_query(rule):
    def run(spark, d):
        found = portable(_findings(spark, d, [rule]))
        if rule not in VA.VALUE_RULES:
            return found
        return VA.with_values(found, VA.offending_values(inputs(spark, d).raw, YEAR_CFG, [rule]))
    run.__doc__ = (f"Validation rule '{rule}': its finding"
                   + (", one row per offending value." if rule in VA.VALUE_RULES else "."))
    return run


for _rule, _key in VAL_KEYS.items():
    query(_key)(_rule_query(_rule))


query("val_contract_doc")(lambda s, d: VA.contract_table(_typed(s, d)))


@query("val_summary")
def val_summary(spark, d):
    raw = inputs(spark, d).raw
    return VA.summary(raw, _findings(spark, d))


@query("val_preview")
def val_preview(spark, d):
    return VA.preview(inputs(spark, d).raw, 10)


# --------------------------------------------------------------------------
# 2.4 cleaning steps
# --------------------------------------------------------------------------
@query("cln_trim_names")
def cln_trim_names(spark, d):
    """A file whose header is padded."""
    padded = _typed(spark, d).select(*[F.col(c).alias(f" {c}\t") for c in ("case_id", "sex", "age")])
    return CL.trim_column_names(padded)


@query("cln_drop_columns")
def cln_drop_columns(spark, d):
    """Columns that the analysis does not use are left out."""
    cfg = inputs(spark, d).cfg
    wide = _typed(spark, d).select("case_id", "region_name", *[F.col("sex").alias(c) for c in cfg.drop_columns])
    return CL.drop_columns(wide, cfg)


@query("cln_trim_text")
def cln_trim_text(spark, d):
    t = CL.trim_text(_typed(spark, d))
    return t.select("case_id", "sex", "region_name", "local_name", "group_name", "stratum",
                    "onset_text")


@query("cln_region_alias")
def cln_region_alias(spark, d):
    i = inputs(spark, d)
    t = CL.normalize_regions(CL.trim_text(_typed(spark, d)), i.aliases, i.cfg)
    return t.select("case_id", "region_name")


@query("cln_dedup_rows")
def cln_dedup_rows(spark, d):
    """The whole file delivered twice: de-duplicate the combined feed."""
    t = _typed(spark, d)
    dd = CL.dedup_rows(t.unionByName(t))
    return dd.groupBy("epi_year").agg(F.count(F.lit(1)).cast("bigint").alias("rows"))


@query("flt_scope")
def flt_scope(spark, d):
    i = inputs(spark, d)
    prepared = CL.normalize_regions(CL.trim_text(_typed(spark, d)), i.aliases, YEAR_CFG)
    return CL.filter_scope(CL.dedup_rows(prepared), YEAR_CFG) \
             .select("case_id", "epi_year", "region_name")


@query("flt_scope_report")
def flt_scope_report(spark, d):
    i = inputs(spark, d)
    return CL.clean_report(i.raw, YEAR_CFG, i.aliases, i.clean_year).select(
        "excluded_non_territorial", "excluded_year", "excluded_total", "rows_out")


def _clean_cols(*cols):
    def run(spark, d):
        return portable(inputs(spark, d).clean.select(*cols))
    return run


query("cln_area_code")(_clean_cols("case_id", "region_code", "local_code", "area_code"))
query("cln_parse_dates")(_clean_cols("case_id", "notified_on", "born_on"))
query("cln_onset_check")(_clean_cols("case_id", "onset_on", "onset_corrected"))
query("cln_age_check")(_clean_cols("case_id", "age", "age_inconsistent"))
query("cln_group_default")(_clean_cols("case_id", "group_name"))
query("cln_to_int")(_clean_cols("case_id", "stratum"))


@query("cln_area_override")
def cln_area_override(spark, d):
    """Area code with a region forced to a fixed code (parameter)."""
    i = inputs(spark, d)
    cfg = i.cfg.with_(area_code_overrides={"NATION_3": "99999"})
    return CL.clean(i.raw, cfg, i.aliases).select("case_id", "region_name", "area_code")


@query("cln_report")
def cln_report(spark, d):
    i = inputs(spark, d)
    return CL.clean_report(i.raw, YEAR_CFG, i.aliases, i.clean_year)


@query("cln_outliers_iqr")
def cln_outliers_iqr(spark, d):
    return CL.age_outliers(inputs(spark, d).clean)


# --------------------------------------------------------------------------
# 2.5 derived columns
# --------------------------------------------------------------------------
query("drv_month")(_clean_cols("case_id", "month", "month_name", "year_month"))
query("drv_quarter")(_clean_cols("case_id", "epi_week", "quarter"))
query("drv_semester")(_clean_cols("case_id", "epi_week", "semester"))
query("drv_age_group")(_clean_cols("case_id", "age", "age_group", "age_group_ord"))
query("drv_labels")(_clean_cols("case_id", "sex_label", "area_label", "hospital_label"))
query("drv_flags")(_clean_cols("case_id", "is_minor", "is_adolescent", "is_rural"))


@query("drv_index_flags")
def drv_index_flags(spark, d):
    flags = D.index_flags()
    return inputs(spark, d).clean.select("case_id", *[v.alias(k) for k, v in flags.items()])


@query("drv_classify")
def drv_classify(spark, d):
    return inputs(spark, d).index.select("area_code", "region_name", "local_name", "score",
                                         D.classify("score").alias("priority"))


@query("drv_accent_key")
def drv_accent_key(spark, d):
    return inputs(spark, d).clean.select("case_id", accent_key("region_name").alias("region_key"),
                                         accent_key("local_name").alias("local_key"))


@query("drv_gp_labels")
def drv_gp_labels(spark, d):
    return DS.risk_groups(inputs(spark, d).clean).select("group", "label")


@query("drv_trend_text")
def drv_trend_text(spark, d):
    return inputs(spark, d).index.select("area_code", "region_name", "local_name",
                                         D.trend_text("trend").alias("trend_text"))


# --------------------------------------------------------------------------
# 2.6 interactive filter
# --------------------------------------------------------------------------
FILTER_ARGS = dict(region="NATION_1", sex="Femenino", months=[1, 2, 3, 4, 5, 6], area=None)


@query("flt_cases")
def flt_cases(spark, d):
    f = DS.filter_cases(inputs(spark, d).clean, **FILTER_ARGS)
    return f.select("case_id", "region_name", "sex_label", "month", "area_label", "age",
                    "area_code")


@query("flt_cases_clustered")
def flt_cases_clustered(spark, d):
    """The interactive filter over the clean table in its clustered layout."""
    i = inputs(spark, d)

    def build():
        path = scratch_path(spark, "clean_clustered")
        SRC.write_clustered(i.clean, path)
        return spark.read.parquet(path)
    return DS.filter_cases(i._get("clean_clustered", build), **FILTER_ARGS).select(
        "case_id", "region_name", "sex_label", "month", "area_label", "age", "area_code")


@query("lst_regions")
def lst_regions(spark, d):
    return DS.region_list(inputs(spark, d).clean)


# --------------------------------------------------------------------------
# 2.7 aggregations
# --------------------------------------------------------------------------
def _clean(spark, d):
    return inputs(spark, d).clean


query("agg_kpis")(lambda s, d: DS.kpis(_clean(s, d)))
query("agg_kpis_filtered")(lambda s, d: DS.kpis_filtered(
    DS.filter_cases(_clean(s, d), **FILTER_ARGS)))
query("agg_kpis_filtered_empty")(lambda s, d: DS.kpis_filtered(
    DS.filter_cases(_clean(s, d), region="NO SUCH REGION")))
query("agg_by_region")(lambda s, d: DS.by_region(_clean(s, d)))
query("agg_by_region_top")(lambda s, d: DS.by_region(_clean(s, d), top=10))
query("agg_by_area")(lambda s, d: DS.by_area(_clean(s, d), 20))
query("agg_by_sex")(lambda s, d: DS.by_sex(_clean(s, d)))
query("agg_by_age_group")(lambda s, d: DS.by_age_group(_clean(s, d)))
query("agg_by_month")(lambda s, d: DS.by_month(_clean(s, d)))
query("agg_by_area_type")(lambda s, d: DS.by_area_type(_clean(s, d)))
query("agg_by_quarter")(lambda s, d: DS.by_quarter(_clean(s, d)))
query("agg_semester_change")(lambda s, d: DS.semester_change(_clean(s, d)))
query("agg_cumulative_age")(lambda s, d: DS.cumulative_age(_clean(s, d)))
query("agg_risk_groups")(lambda s, d: DS.risk_groups(_clean(s, d)))
query("agg_top_group")(lambda s, d: DS.top_age_group(_clean(s, d)))
query("agg_exec_summary")(lambda s, d: DS.exec_summary(_clean(s, d), inputs(s, d).index))
query("agg_public_cells")(lambda s, d: DS.public_cells(_clean(s, d)))

# --------------------------------------------------------------------------
# 2.8 cross tabulations
# --------------------------------------------------------------------------
query("xtab_age_sex")(lambda s, d: XT.age_by_sex(_clean(s, d)))
query("xtab_region_sex")(lambda s, d: XT.region_by_sex(_clean(s, d), 10))
query("xtab_month_sex")(lambda s, d: XT.month_by_sex(_clean(s, d)))

# --------------------------------------------------------------------------
# 2.9 windows
# --------------------------------------------------------------------------
query("win_weekly_trend")(lambda s, d: WN.weekly_trend(_clean(s, d)))
query("win_peak_week")(lambda s, d: WN.peak_week(_clean(s, d)))


@query("win_national_rank")
def win_national_rank(spark, d):
    return inputs(spark, d).index.select("area_code", "region_name", "local_name", "score",
                                         "rank")


@query("win_region_mean_pop")
def win_region_mean_pop(spark, d):
    i = inputs(spark, d)
    joined = J.join_population(IX.area_table(i.clean), i.population)
    out = WN.region_mean_population(joined)
    from ..functions.core import round_half_even as r
    return out.select("area_code", "region_name", "local_name", "population",
                      r("region_mean_pop", 6).alias("region_mean_pop"))


query("win_top_area_per_region")(lambda s, d: WN.top_area_per_region(inputs(s, d).index))

# --------------------------------------------------------------------------
# 2.10 joins
# --------------------------------------------------------------------------
@query("join_population")
def join_population(spark, d):
    i = inputs(spark, d)
    return J.join_population(IX.area_table(i.clean), i.population).select(
        "area_code", "region_name", "local_name", "cases", "population")


@query("join_impute_population")
def join_impute_population(spark, d):
    return inputs(spark, d).areas.select("area_code", "region_name", "local_name", "population")


@query("join_centroids")
def join_centroids(spark, d):
    i = inputs(spark, d)
    return J.join_centroids(IX.region_table(i.index), i.centroids).select(
        "region_name", "lon", "lat")


@query("join_top_filter")
def join_top_filter(spark, d):
    c = _clean(spark, d)
    return J.semi_join_top(c, XT.top_regions(c, 10), "region_name").select(
        "case_id", "region_name")


def _update_inputs(spark, d):
    """Stored base and incoming file built from the raw line list: the base
    holds ids ending in 3-9, the new file ids ending in 0-4 (3 and 4 are
    re-delivered), so every raw row takes part in the merge."""
    raw = _typed(spark, d)
    last = F.col("case_id") % 10
    return raw.where(last >= 3), raw.where(last <= 4)


@query("join_anti_new")
def join_anti_new(spark, d):
    base, new = _update_inputs(spark, d)
    return J.anti_join_new(new, base).select("case_id", "epi_year", "region_name")


@query("join_anti_new_indexed")
def join_anti_new_indexed(spark, d):
    """The same by the index of stored ids, whose rows are not shuffled."""
    from ..streaming import idindex
    base, new = _update_inputs(spark, d)
    root = scratch_path(spark, "indexed")
    INC.seed(base, root)
    INC.append(base.limit(0), root)
    folders = [INC.folder_of(root, r) for r in INC.records(spark, root)]
    first = UP.dedup_first(new.withColumn(UP.SOURCE_COL, F.lit(1)))
    return idindex.unseen(first, *idindex.stored(spark, root, folders), "case_id").select("case_id", "epi_year", "region_name")


# --------------------------------------------------------------------------
# 2.11 sort / limit / set operations / update
# --------------------------------------------------------------------------
query("top_ranking")(lambda s, d: IX.top_ranking(inputs(s, d).index, 20))
query("top_regions")(lambda s, d: DS.by_region(_clean(s, d), top=15).select(
    "region_name", "cases"))
EMERGING_COLS = ("area_code", "region_name", "local_name", "cases", "trend", "score", "priority")


@query("flt_emerging")
def flt_emerging(spark, d):
    """Areas that grow by more than half.  Over all years the stand-in is level,
    so half of the first-semester cases of one local code are set in the second."""
    i = inputs(spark, d)

    def growing():
        late = (F.col("local_code") == "3") & (F.col("epi_week") <= 26) & (F.col("case_id") % 2 == 0)
        raw = i.raw.withColumn("epi_week", F.when(late, F.col("epi_week") + 26).otherwise(F.col("epi_week")))
        return IX.index_flow(CL.clean(raw, i.cfg, i.aliases), i.population, i.cfg)

    return IX.emerging(i._get("growing", growing), i.cfg, 10).select(*EMERGING_COLS)


# the level stand-in itself, which needs a lower threshold
query("flt_emerging_level")(lambda s, d: IX.emerging(
    inputs(s, d).index, inputs(s, d).cfg.with_(emerging_trend=0.05), 10).select(*EMERGING_COLS))


@query("set_union_update")
def set_union_update(spark, d):
    base, new = _update_inputs(spark, d)
    u = UP.union_update(base, new)
    return u.groupBy(UP.SOURCE_COL, "epi_year").agg(F.count(F.lit(1)).cast("bigint")
                                                    .alias("rows"))


@query("set_dedup_first")
def set_dedup_first(spark, d):
    base, new = _update_inputs(spark, d)
    return UP.merge(base, new).select("case_id", "epi_year", "region_name", "age", "sex")


@query("set_dedup_first_files")
def set_dedup_first_files(spark, d):
    """The first row of an id in file order stays: a file set that holds every
    raw row twice, first in its last file with the larger age, and in each file
    with older rows before younger ones of the same id."""
    raw = _typed(spark, d).where("case_id is not null")
    root = scratch_path(spark, "feed")
    for n, step in ((1, 40), (2, 0)):
        twice = raw.select("case_id", "epi_year", "region_name", "sex", F.explode(F.array(
            F.col("age") + step + 20, F.col("age") + step)).alias("age"))
        twice.repartitionByRange("case_id").sortWithinPartitions("case_id", F.col("age").desc()).write.option(
            "header", "true").csv(f"{root}/f{n}")
    feed = SRC.read_cases(spark, f"{root}/f*", columns=["case_id", "epi_year", "region_name", "sex", "age"],
                          types={"case_id": "bigint"}, ordinal=True)
    return UP.dedup_first(feed.withColumn(UP.SOURCE_COL, F.lit(1))).select("case_id", "epi_year", "age")


@query("upd_report")
def upd_report(spark, d):
    base, new = _update_inputs(spark, d)
    return UP.update_report(base, new)


def _updated(spark, d) -> tuple[str, dict]:
    """The folder and last report of two updates, made once a session."""
    i = inputs(spark, d)
    return i._get("updated", lambda: _two_updates(spark, i))


def _two_updates(spark, i) -> tuple[str, dict]:
    """Two updates of a seeded table: every file is validated, appended,
    cleaned and counted by itself."""
    from . import workflows
    raw = i.raw.withColumns({                                       # files that pass validation
        "sex": F.when(F.col("sex") == "X", "M").otherwise(F.col("sex")), "area_type": 1 + F.col("area_type") % 3})
    last = F.col("case_id") % 10
    root = scratch_path(spark, "update")
    base = raw.where(last >= 5)
    for new in (raw.where(last.between(3, 6)), raw.where(last <= 3)):
        done = workflows.update(spark, base, new, i.population, root, None, i.cfg, i.aliases)
    return root, done


@query("upd_pipeline")
def upd_pipeline(spark, d):
    """The index of the second version after two updates."""
    return spark.read.parquet(_updated(spark, d)[1]["areas"]).select(
        "area_code", "region_name", "local_name", "cases", "cases_h1", "cases_h2", "score", "priority", "rank")


def _updated_cube(spark, d):
    from . import workflows
    return workflows.cube_at(spark, _updated(spark, d)[0])


@query("upd_cube")
def upd_cube(spark, d):
    """The case cube after two updates: the cells of each batch, added up."""
    return _updated_cube(spark, d)


query("upd_kpis")(lambda s, d: CB.kpis(_updated_cube(s, d)))
query("upd_public_cells")(lambda s, d: PV.suppress(CB.public_cells(_updated_cube(s, d)), "cases", 5))


@query("set_distinct_rows")
def set_distinct_rows(spark, d):
    return _clean(spark, d).select("region_code", "region_name").distinct()


# --------------------------------------------------------------------------
# 2.12 privacy
# --------------------------------------------------------------------------
query("prv_suppress")(lambda s, d: PV.suppress(DS.by_area(_clean(s, d), None), "cases", 5))
query("prv_public_top_areas")(lambda s, d: PV.public_top_areas(_clean(s, d), 5, 20))
query("prv_public_areas")(lambda s, d: PV.public_areas(inputs(s, d).index, 5).select(
    "area_code", "region_name", "local_name", "cases", "score", "priority", "rank"))
query("prv_public_areas_report")(lambda s, d: PV.public_areas_report(inputs(s, d).index, 5))
query("prv_public_cells")(lambda s, d: PV.public_case_cells(_clean(s, d), 5))
query("prv_k_anonymity_check")(lambda s, d: PV.k_anonymity_check(
    PV.public_case_cells(_clean(s, d), 5), "cases", 5))



@query("prv_protected_areas")
def prv_protected_areas(spark, d):
    """All areas with what is hidden, so that no small area follows from a regional total."""
    return DC.protected_areas(inputs(spark, d).index.select(*DC.AREA, "cases"), 5)


@query("prv_protected_cells")
def prv_protected_cells(spark, d):
    """The published cells: none that is hidden follows from the total of its area."""
    i = inputs(spark, d)
    areas = DC.protected_areas(i.index.select(*DC.AREA, "cases"), 5)
    return DC.published(DC.protected_cells(i.clean, areas, 5))


@query("prv_disclosure_audit")
def prv_disclosure_audit(spark, d):
    """How many hidden areas and cells can be worked out: with small ones alone
    hidden, and with second ones hidden too."""
    i = inputs(spark, d)
    areas = i.index.select(*DC.AREA, "cases")
    small = F.when(F.col("cases") < 5, F.lit("small")).alias("hidden")
    safe = DC.protected_areas(areas, 5)
    cells = DS.public_cells(i.clean)
    return (DC.audit(areas.select("*", small), DC.REGION, "areas, small hidden")
            .unionByName(DC.audit(safe, DC.REGION, "areas, protected"))
            .unionByName(DC.audit(cells.select("*", small), DC.AREA, "cells, small hidden"))
            .unionByName(DC.audit(DC.protected_cells(i.clean, safe, 5), DC.AREA, "cells, protected")))


# --------------------------------------------------------------------------
# 2.13 priority index stages
# --------------------------------------------------------------------------
AREA_COLS = ("area_code", "region_name", "local_name", "cases", "cases_h1", "cases_h2",
             "pct_adolescent", "pct_young_adult", "pct_hospitalised", "pct_psychiatric",
             "pct_minor", "pct_female", "pct_rural")

query("idx_area_table")(lambda s, d: IX.area_table(_clean(s, d)).select(*AREA_COLS))
query("idx_trend")(lambda s, d: IX.area_table(_clean(s, d)).select(
    "area_code", "region_name", "local_name", "cases_h1", "cases_h2", "trend"))
query("idx_rate")(lambda s, d: inputs(s, d).areas.select(
    "area_code", "region_name", "local_name", "cases", "population", "rate_100k"))


@query("idx_minmax")
def idx_minmax(spark, d):
    i = inputs(spark, d)
    comps = [n for n, _ in i.cfg.weights]
    return IX.min_max(i.areas, comps).select(
        "area_code", "region_name", "local_name", *[f"{c}_norm" for c in comps])


query("idx_score")(lambda s, d: inputs(s, d).index.select(
    "area_code", "region_name", "local_name", "score"))
query("idx_priority_class")(lambda s, d: inputs(s, d).index.select(
    "area_code", "region_name", "local_name", "score", "priority", "rank"))
query("idx_distribution")(lambda s, d: IX.priority_distribution(inputs(s, d).index))
query("idx_region_mean")(lambda s, d: IX.region_mean_index(inputs(s, d).index))
query("idx_region_table")(lambda s, d: IX.region_table(inputs(s, d).index))
query("idx_map_points")(lambda s, d: IX.map_points(IX.region_table(inputs(s, d).index),
                                                   inputs(s, d).centroids))
query("idx_counts")(lambda s, d: IX.priority_counts(inputs(s, d).index))
query("idx_scatter")(lambda s, d: IX.scatter(inputs(s, d).index, 5))


@query("idx_pipeline")
def idx_pipeline(spark, d):
    """raw cases -> clean -> area table -> index, written by the batch workflow."""
    from . import workflows
    i = inputs(spark, d)
    done = workflows.batch_index(i.raw, i.population, scratch_path(spark, "batch"), i.cfg, i.aliases)
    return spark.read.parquet(done["areas"]).select(
        "area_code", "region_name", "local_name", "cases", "score", "priority", "rank")


@query("idx_full_run")
def idx_full_run(spark, d):
    """cases -> area table -> index in one call: rebuilds (and checkpoints)
    its own area table from the clean table instead of the shared one."""
    i = inputs(spark, d)
    return IX.index_flow(i.clean, i.population, i.cfg).select(
        "area_code", "region_name", "local_name", "cases", "score", "priority", "rank")


# --------------------------------------------------------------------------
# 2.14 chart tables
# --------------------------------------------------------------------------
query("cht_histogram")(lambda s, d: CH.histogram(_clean(s, d), "age", 30))
query("cht_center_lines")(lambda s, d: CH.center_lines(_clean(s, d), "age"))
query("cht_boxplot")(lambda s, d: CH.boxplot(_clean(s, d), "age", "sex"))
query("cht_heatmap_month_sex")(lambda s, d: XT.month_by_sex(_clean(s, d)))
query("cht_region_by_sex")(lambda s, d: XT.region_by_sex(_clean(s, d), 10)
                           .where(F.col("grouping_id") == 0))
query("cht_share_sex")(lambda s, d: DS.by_sex(_clean(s, d)))
query("cht_area_share")(lambda s, d: DS.by_area_type(_clean(s, d)))

# --------------------------------------------------------------------------
# 2.16 recommendations
# --------------------------------------------------------------------------
query("rec_rules")(lambda s, d: RC.rules(inputs(s, d).index))
query("rec_top_area")(lambda s, d: RC.area_profile(inputs(s, d).index))
query("rec_findings")(lambda s, d: RC.findings(_clean(s, d), inputs(s, d).index))

# --------------------------------------------------------------------------
# 2.15 machine learning on the area table (rows-only checks, except the
# deterministic preparation and z-scores)
# --------------------------------------------------------------------------
from ..operators import ml as ML  # noqa: E402


@query("ml_prepare")
def ml_prepare(spark, d):
    i = inputs(spark, d)
    return ML.prepare(i.index, i.cfg).select(*ML.KEYS, *i.cfg.model_features, "priority",
                                             "label")


@query("ml_split")
def ml_split(spark, d):
    i = inputs(spark, d)
    return ML.split(ML.prepare(i.index, i.cfg), 0.2, i.cfg.seed).select(
        "area_code", "priority", "is_test")


@query("ml_class_weight")
def ml_class_weight(spark, d):
    i = inputs(spark, d)
    p = ML.prepare(i.index, i.cfg)
    return ML.with_class_weight(p.groupBy("priority", "label").count(), p) \
             .select("priority", "label", F.col("count").cast("bigint").alias("n"), "weight")


query("ml_folds")(lambda s, d: ML.folds(inputs(s, d).index, inputs(s, d).cfg)[0].select("area_code", "priority", "fold"))
query("ml_baseline")(lambda s, d: ML.baseline_predictions(inputs(s, d).index, inputs(s, d).cfg))
query("ml_baseline_metrics")(lambda s, d: ML.metrics(ML.baseline_predictions(inputs(s, d).index, inputs(s, d).cfg)))
query("ml_baseline_confusion")(lambda s, d: ML.confusion(ML.baseline_predictions(inputs(s, d).index, inputs(s, d).cfg)))
query("ml_tree")(lambda s, d: ML.tree_predictions(inputs(s, d).index, inputs(s, d).cfg))
query("ml_tree_rules")(lambda s, d: ML.tree_rules(inputs(s, d).index, inputs(s, d).cfg))
query("ml_forest")(lambda s, d: inputs(s, d).forest)
query("ml_importance")(lambda s, d: ML.importances(inputs(s, d).index, inputs(s, d).cfg))
query("ml_cv")(lambda s, d: ML.cross_validate(inputs(s, d).index, inputs(s, d).cfg))
query("ml_metrics")(lambda s, d: ML.metrics(inputs(s, d).forest))
query("ml_confusion")(lambda s, d: ML.confusion(inputs(s, d).forest))
query("ml_standardize")(lambda s, d: ML.standardize(inputs(s, d).index, inputs(s, d).cfg, 6))
query("ml_elbow")(lambda s, d: ML.elbow(inputs(s, d).index, inputs(s, d).cfg))
query("ml_kmeans")(lambda s, d: inputs(s, d).clusters.select(*ML.KEYS, "cluster", "cluster_label"))
query("ml_cluster_profile")(lambda s, d: ML.cluster_profile(inputs(s, d).clusters, inputs(s, d).cfg))
query("ml_cluster_label")(lambda s, d: inputs(s, d).clusters.select("cluster", "cluster_label").distinct())
query("win_cluster_rank")(lambda s, d: ML.cluster_rank(inputs(s, d).clusters))

# --------------------------------------------------------------------------
# incremental ingestion as Structured Streaming (the update path)
# --------------------------------------------------------------------------
@query("stm_incremental_merge")
def stm_incremental_merge(spark, d):
    """The stored base seeds the append-only batch table (batch 0); the new
    file lands in a watched folder; an available-now file stream appends its
    unseen case ids as batch 1 (stored rows win); the table is returned."""
    base, new = _update_inputs(spark, d)
    root = scratch_path(spark, "stream")
    INC.seed(base, f"{root}/table")
    new.write.parquet(f"{root}/landing/file1")
    q = INC.start(spark, f"{root}/landing/*", f"{root}/table", f"{root}/checkpoint",
                  new.schema, fmt="parquet", once=True)
    q.awaitTermination()
    return INC.read_table(spark, f"{root}/table").select(
        "case_id", "epi_year", "region_name", "age", "sex")


# --------------------------------------------------------------------------
# dashboard views answered from the case cube (same results as the direct
# versions above; checked against the same oracle SQL)
# --------------------------------------------------------------------------
query("agg_kpis_cube")(lambda s, d: CB.kpis(inputs(s, d).cube))
query("agg_by_sex_cube")(lambda s, d: CB.by_sex(inputs(s, d).cube))
query("agg_by_age_group_cube")(lambda s, d: CB.by_age_group(inputs(s, d).cube))
query("agg_by_region_cube")(lambda s, d: CB.by_region(inputs(s, d).cube))
query("win_weekly_trend_cube")(lambda s, d: CB.weekly_trend(inputs(s, d).cube))
query("agg_kpis_filtered_cube")(lambda s, d: CB.kpis_filtered(
    CB.filter_cube(inputs(s, d).cube, **FILTER_ARGS)))
query("agg_by_month_cube")(lambda s, d: CB.by_month(inputs(s, d).cube))
query("agg_by_area_type_cube")(lambda s, d: CB.by_area_type(inputs(s, d).cube))
query("agg_by_quarter_cube")(lambda s, d: CB.by_quarter(inputs(s, d).cube))
query("agg_semester_change_cube")(lambda s, d: CB.semester_change(inputs(s, d).cube))
query("xtab_age_sex_cube")(lambda s, d: CB.age_by_sex(inputs(s, d).cube))
query("agg_cumulative_age_cube")(lambda s, d: CB.cumulative_age(inputs(s, d).cube))
query("xtab_month_sex_cube")(lambda s, d: CB.month_by_sex(inputs(s, d).cube))
