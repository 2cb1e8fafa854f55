"""Cleaning: raw line list -> typed, scoped, derived case table.

Every step is a column expression or a single relational operator: the
cleaning is a pass that counts digests of the rows and one that writes them,
with a full-width shuffle of the copies alone, or of all rows if copies are many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import GROUP_DEFAULT, Config
from ..functions import derive as D
from ..functions.core import (count_if, is_true, round_half_even, row_digest, share,
                              strip_text, zfill)
from ..session import materialize
from ..sources.cases import conform
from .quantiles import quantiles_by

DATE_FORMAT = "yyyy-M-d"


def trim_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def trim_text(df: DataFrame) -> DataFrame:
    """Strip Unicode whitespace from every text column; blank -> null."""
    return df.select(*[
        strip_text(f.name).alias(f.name) if isinstance(f.dataType, T.StringType)
        else F.col(f.name) for f in df.schema.fields])


def normalize_regions(df: DataFrame, aliases=None, cfg: Config | None = None,
                      col: str = "region_name") -> DataFrame:
    """Upper-case + trim the region, then replace exact variant spellings.

    ``aliases`` is either a dict (compiled into a literal map, no join) or a
    DataFrame ``(variant, canonical)``, joined as the planner sees fit."""
    cfg = cfg or Config()
    up = F.upper(strip_text(col))
    if aliases is None:
        aliases = cfg.region_aliases
    if isinstance(aliases, dict):
        if not aliases:
            return df.withColumn(col, up)
        kv = []
        for k, v in aliases.items():
            kv += [F.lit(k), F.lit(v)]
        return df.withColumn(col, F.coalesce(F.element_at(F.create_map(*kv), up), up))
    # one canonical name per variant, deterministically (smallest) if a
    # lookup lists a variant twice
    lk = aliases.groupBy(F.col("variant").alias("_variant")) \
                .agg(F.min("canonical").alias("_canonical"))
    out = df.withColumn(col, up).join(lk,
                                      F.col(col) == F.col("_variant"), "left")
    return out.withColumn(col, F.coalesce("_canonical", col)).drop("_variant", "_canonical")


REPEATED = 100_000          # digests or ids that come more than once, up to which they are broadcast


def dedup_rows(df: DataFrame) -> DataFrame:
    """Drop fully duplicated rows (nulls compare equal).

    Rows are counted by a 128-bit digest first, in a pass of its own; only rows
    whose digest comes more than once are compared in full.  Where there are
    none the rows are unique as they are; where they are few their digests are
    broadcast, and no unique row is shuffled; where they are many, all rows are
    compared, copies collapsing in the tasks before the one shuffle."""
    if any("map<" in kind for _, kind in df.dtypes):
        return df.dropDuplicates()
    digest = ["_digest1", "_digest2"]
    marked = df.select("*", *row_digest(df.columns))
    again = materialize(marked.groupBy(*digest).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"))
    found = again.limit(REPEATED + 1).count()
    if not found:
        return df
    if found > REPEATED:
        return df.dropDuplicates()
    few = F.broadcast(again)
    unique = marked.join(few, digest, "left_anti").select(*df.columns)
    copies = marked.join(few, digest, "left_semi").dropDuplicates().select(*df.columns)
    return unique.unionByName(copies)


def scope_predicate(cfg: Config) -> F.Column:
    """Null-safe keep flag (never null): territorial region (null region
    kept) in the analysis year (null year dropped).  Used where the flag is
    counted."""
    keep = ~is_true(F.col("region_name").isin(*cfg.non_territorial))
    if cfg.year is not None:
        keep = keep & is_true(F.col("epi_year") == F.lit(cfg.year))
    return keep


def scope_filter(cfg: Config) -> F.Column:
    """The same rows as ``scope_predicate`` in a WHERE clause, written in a
    form the Parquet reader can push down (``epi_year = y``; a null year
    fails the equality and is dropped)."""
    region = F.col("region_name")
    keep = region.isNull() | ~region.isin(*cfg.non_territorial)
    if cfg.year is not None:
        keep = (F.col("epi_year") == F.lit(cfg.year)) & keep
    return keep


def filter_scope(df: DataFrame, cfg: Config | None = None) -> DataFrame:
    return df.where(scope_filter(cfg or Config()))


def drop_columns(df: DataFrame, cfg: Config | None = None) -> DataFrame:
    cfg = cfg or Config()
    return df.drop(*[c for c in cfg.drop_columns if c in df.columns])


# ---------------------------------------------------------------------------
# expression builders (each takes columns of the row being cleaned)
# ---------------------------------------------------------------------------
def area_code_expr(cfg: Config) -> F.Column:
    """5-character area code = region code (2) + local code (3), zero padded
    without truncation; configured regions get a fixed code."""
    code = F.concat(zfill("region_code", 2), zfill("local_code", 3))
    for region, fixed in cfg.area_code_overrides.items():
        code = F.when(is_true(F.col("region_name") == region), F.lit(fixed)).otherwise(code)
    return code


def parsed_dates(df: DataFrame, cfg: Config) -> dict:
    """Strict ``yyyy-M-d`` parse of the text dates present; bad text -> null."""
    return {date_col: F.try_to_date(F.col(text_col), DATE_FORMAT)
            for text_col, date_col in cfg.date_columns if text_col in df.columns}


def onset_flag(onset: F.Column, notified: F.Column, cfg: Config) -> F.Column:
    """Onset after notification, or more than ``onset_max_days`` before it."""
    return onset.isNotNull() & is_true(
        (onset > notified) | (F.datediff(notified, onset) > cfg.onset_max_days))


def age_flag(born: F.Column, notified: F.Column, age: F.Column, cfg: Config) -> F.Column:
    """Reported age differs from the birth-date age by more than the gap."""
    computed = F.datediff(notified, born) / F.lit(cfg.year_days)
    return born.isNotNull() & is_true(F.abs(computed - age) > F.lit(cfg.age_gap_years))


def _whole_number(c) -> F.Column:
    d = (F.col(c) if isinstance(c, str) else c).try_cast("double")
    return F.when(d == F.floor(d), d.try_cast("int"))       # out of int range -> null


def derived_columns(df: DataFrame, cfg: Config) -> tuple[dict, list]:
    """The columns the cleaning adds or rewrites after area code and dates, as
    expressions over the incoming columns and the parsed dates, plus the text
    columns it replaces.  The dates are a projection before this one: written
    out here, each text would be parsed once for every column that its date is
    part of."""
    dates = {d: F.col(d) for t, d in cfg.date_columns if t in df.columns}
    nt = dates.get("notified_on", F.lit(None).cast("date"))
    age, week, area = F.col("age"), F.col("epi_week"), F.col("area_type")
    cols = {}
    if "onset_on" in dates:
        bad = onset_flag(dates["onset_on"], nt, cfg)
        cols["onset_corrected"] = bad
        cols["onset_on"] = F.when(~bad, dates["onset_on"])
    else:
        cols["onset_corrected"] = F.lit(False)
    month = F.month(nt)
    cols.update({
        "month": month, "month_name": D.month_name(month),
        "year_month": F.date_format(nt, "yyyy-MM"),     # month alone mixes years
        "quarter": D.quarter(week), "semester": D.semester(week),
        "age_group": D.age_group(age), "age_group_ord": D.age_group_ord(age),
        "sex_label": D.sex_label("sex"), "area_label": D.area_label(area),
        "hospital_label": D.hospital_label("hospital_code"),
        "is_minor": D.is_minor(age), "is_adolescent": D.is_adolescent(age),
        "is_rural": D.is_rural(area),
        "age_inconsistent": age_flag(dates["born_on"], nt, age, cfg)
        if "born_on" in dates else F.lit(False),
    })
    if "group_name" in df.columns:
        cols["group_name"] = F.coalesce("group_name", F.lit(GROUP_DEFAULT))
    for c in ("stratum", "gestation_weeks"):
        if c in df.columns:
            cols[c] = _whole_number(c)
    replaced = [t for t, d in cfg.date_columns if t in df.columns and t != d]
    return cols, replaced


# ---------------------------------------------------------------------------
# single steps (each one projection), for callers that need one of them
# ---------------------------------------------------------------------------
def area_code(df: DataFrame, cfg: Config | None = None) -> DataFrame:
    return df.withColumn("area_code", area_code_expr(cfg or Config()))


def parse_dates(df: DataFrame, cfg: Config | None = None) -> DataFrame:
    cfg = cfg or Config()
    replaced = [t for t, d in cfg.date_columns if t in df.columns and t != d]
    return df.withColumns(parsed_dates(df, cfg)).drop(*replaced)


def onset_check(df: DataFrame, cfg: Config | None = None) -> DataFrame:
    """Flag an implausible onset and null it (expects parsed dates)."""
    cfg = cfg or Config()
    if "onset_on" not in df.columns:
        return df.withColumn("onset_corrected", F.lit(False))
    bad = onset_flag(F.col("onset_on"), F.col("notified_on"), cfg)
    return df.withColumns({"onset_corrected": bad,
                           "onset_on": F.when(~bad, F.col("onset_on"))})


def age_check(df: DataFrame, cfg: Config | None = None) -> DataFrame:
    """Flag an age inconsistent with the birth date (expects parsed dates)."""
    cfg = cfg or Config()
    if "born_on" not in df.columns:
        return df.withColumn("age_inconsistent", F.lit(False))
    return df.withColumn("age_inconsistent", age_flag(
        F.col("born_on"), F.col("notified_on"), F.col("age"), cfg))


def text_fields(df: DataFrame) -> DataFrame:
    """Group name default; stratum / gestation weeks to nullable integers
    (fractional or non-numeric text -> null)."""
    cols = {}
    if "group_name" in df.columns:
        cols["group_name"] = F.coalesce("group_name", F.lit(GROUP_DEFAULT))
    for c in ("stratum", "gestation_weeks"):
        if c in df.columns:
            cols[c] = _whole_number(c)
    return df.withColumns(cols) if cols else df


def _prepare(raw: DataFrame, aliases, cfg: Config) -> DataFrame:
    df = trim_column_names(raw)
    df = conform(df)
    df = trim_text(df)
    return normalize_regions(df, aliases, cfg)


def _derive(df: DataFrame, cfg: Config) -> DataFrame:
    df = drop_columns(df, cfg)
    cols, replaced = derived_columns(df, cfg)
    return df.withColumns({"area_code": area_code_expr(cfg), **parsed_dates(df, cfg)}).withColumns(cols).drop(*replaced)


def clean(raw: DataFrame, cfg: Config | None = None, aliases=None) -> DataFrame:
    """Full cleaning pipeline: trim -> region aliases -> scope filter ->
    de-duplicate -> drop columns -> area code -> dates -> onset check ->
    temporal and demographic variables -> text fields."""
    cfg = cfg or Config()
    df = filter_scope(_prepare(raw, aliases, cfg), cfg)    # equal rows share their scope: none is counted in vain
    if cfg.dedup_full_rows:
        df = dedup_rows(df)
    return _derive(df, cfg)


def clean_report(raw: DataFrame, cfg: Config | None = None, aliases=None,
                 cleaned: DataFrame | None = None) -> DataFrame:
    """One-row audit of the cleaning: rows in, duplicates, exclusions (each
    reason and their union), rows out, distinct regions/areas kept, onset
    corrections and age inconsistencies.

    Exclusion counts come from one pass over the de-duplicated raw rows
    (their digests, which carry their multiplicity, so ``rows_in`` needs no extra scan);
    kept-row statistics come from the clean table (``cleaned``, e.g. the
    written one; rebuilt from ``raw`` when not given)."""
    cfg = cfg or Config()
    prepared = _prepare(raw, aliases, cfg)
    grouped = prepared.select("region_name", "epi_year", *row_digest(prepared.columns)) \
        .groupBy("region_name", "epi_year", "_digest1", "_digest2").agg(F.count(F.lit(1)).alias("_mult"))
    non_terr = is_true(F.col("region_name").isin(*cfg.non_territorial))
    bad_year = ~is_true(F.col("epi_year") == F.lit(cfg.year)) if cfg.year is not None \
        else F.lit(False)
    keep = scope_predicate(cfg)
    rep = grouped.agg(
        F.sum("_mult").cast("bigint").alias("rows_in"),
        F.count(F.lit(1)).cast("bigint").alias("rows_dedup"),
        count_if(non_terr).alias("excluded_non_territorial"),
        count_if(bad_year).alias("excluded_year"),
        count_if(~keep).alias("excluded_total"),
        count_if(keep).alias("rows_out"))
    kept = cleaned if cleaned is not None else clean(raw, cfg, aliases)
    k = kept.select(F.struct(
        F.count_distinct("region_name").cast("bigint").alias("regions"),
        count_if(F.col("onset_corrected")).alias("onset_corrected"),
        count_if(F.col("age_inconsistent")).alias("age_inconsistent"))).scalar()
    areas = kept.select(F.count_distinct("area_code").cast("bigint")).scalar()
    return rep.select(
        "*", k["regions"].alias("regions"), areas.alias("areas"),
        k["onset_corrected"].alias("onset_corrected"),
        k["age_inconsistent"].alias("age_inconsistent"),
        (F.col("rows_in") - F.col("rows_dedup")).alias("duplicates_removed"),
        round_half_even(share(F.col("excluded_total"), F.col("rows_dedup")) * 100, 2)
        .alias("pct_excluded"))


def age_outliers(df: DataFrame, col: str = "age") -> DataFrame:
    """IQR fences on age (linear-interpolated quartiles); rows outside the
    fences are counted, never removed."""
    q = quantiles_by(df, col, (0.25, 0.75)).select("q").scalar()
    q1, q3 = q.getItem(0), q.getItem(1)
    iqr = q3 - q1
    lo, hi = q1 - 1.5 * iqr, q3 + 1.5 * iqr
    x = F.col(col)
    out = df.agg(count_if((x < lo) | (x > hi)).alias("n_outliers"),
                 F.count(F.lit(1)).alias("n_rows"))
    return out.select(
        q1.alias("q1"), q3.alias("q3"), iqr.alias("iqr"),
        lo.alias("lower_fence"), hi.alias("upper_fence"),
        F.col("n_outliers"),
        round_half_even(share(F.col("n_outliers"), F.col("n_rows")) * 100, 2)
         .alias("pct_outliers"))
