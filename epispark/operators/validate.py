"""Input contract validation: ``findings(df, cfg)`` -> one row per rule.

Every row-level count is a conditional aggregate evaluated in ONE ``agg``
over the incoming file, built for the rules asked for alone; schema rules
(required / optional columns) are decided on the driver from ``df.columns``
(case-sensitive, as the contract requires).  Output columns: rule_id,
severity, triggered, n_rows, vals (names of the columns a schema rule is
about), message.  ``offending_values`` is the table of all values that the
value rules object to, one row each, from one scan and one shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import Config
from ..functions.core import count_if, strip_chars

FINDING_FIELDS = ("rule_id", "severity", "triggered", "n_rows", "vals", "message")
# rules that object to values (see ``offending_values``)
VALUE_RULES = ("year", "sex_domain", "area_domain", "hospital_domain", "event_code")

MESSAGES = {
    "not_empty": "the file has no data rows",
    "max_rows": "more than {max_rows} rows: check this is the right file",
    "required_columns": "required columns are missing (names are case-sensitive)",
    "empty_required": "required columns are completely empty",
    "empty_other": "completely empty columns will be dropped",
    "year": "rows from years other than {year}: excluded by cleaning",
    "date_format": "notification dates that are not yyyy-mm-dd",
    "date_year": "notification dates outside {year}",
    "sex_domain": "sex accepts only F or M",
    "area_domain": "area type accepts only 1, 2 or 3",
    "hospital_domain": "hospitalisation accepts only 1 or 2",
    "short_region_code": "region codes shorter than 2 characters (leading zero lost?)",
    "short_local_code": "local codes shorter than 3 characters (leading zeros lost?)",
    "age_not_numeric": "non-numeric ages are treated as missing",
    "age_range": "ages outside {age_min}-{age_max}",
    "event_code": "event codes differ from the expected event",
    "optional_columns": "{found} of {total} optional columns present",
    "psychiatric_flag_missing": "gp_psychiatric is absent: its share enters the index as 0",
}


def message(rule_id: str, cfg: Config | None = None, **kw) -> str:
    cfg = cfg or Config()
    return MESSAGES[rule_id].format(max_rows=cfg.max_rows, year=cfg.year, age_min=cfg.age_min,
                                     age_max=cfg.age_max, **kw)


def _finding(rule_id, severity, triggered: Column, n_rows: Column, vals: Column,
             text: str) -> Column:
    return F.struct(F.lit(rule_id).alias("rule_id"), F.lit(severity).alias("severity"),
                    triggered.alias("triggered"), n_rows.cast("bigint").alias("n_rows"),
                    vals.cast("array<string>").alias("vals"), F.lit(text).alias("message"))


def _names(names) -> Column:
    return F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")


def _num_label(v: Column) -> Column:
    whole = v.try_cast("bigint")                       # out of range -> null -> as double
    return F.when((v == F.floor(v)) & whole.isNotNull(), whole.cast("string")) \
            .otherwise(v.cast("string"))


def _number(name: str) -> Column:
    return F.col(name).cast("string").try_cast("double")


def _checked(cfg: Config) -> dict:
    """rule -> (value as text, condition under which the rule objects to it)."""
    year, sex = _number("epi_year"), F.upper(strip_chars(F.col("sex").cast("string")))
    area, hospital = _number("area_type"), _number("hospital_code")
    event = F.floor(_number("event_code")).cast("double")
    return {
        "year": (_num_label(year), year.isNotNull() & (year != cfg.year) if cfg.year is not None else F.lit(False)),
        "sex_domain": (sex, sex.isNotNull() & ~sex.isin(*C.VALID_SEX)),
        "area_domain": (_num_label(area), area.isNotNull() & ~area.isin(*[float(x) for x in C.VALID_AREA])),
        "hospital_domain": (_num_label(hospital),
                            hospital.isNotNull() & ~hospital.isin(*[float(x) for x in C.VALID_HOSPITAL])),
        # all codes found are listed, so that the reader sees what the file is about
        "event_code": (_num_label(event), event.isNotNull()),
    }


def _counted(cfg: Config) -> dict:
    """rule -> (severity, rows it objects to) of the rules that count rows."""
    checked = _checked(cfg)
    raw = F.col("notified_text").cast("string")
    date = F.try_to_date(raw, "yyyy-M-d")
    age = _number("age")
    event = F.floor(_number("event_code")).cast("double")
    short = lambda c, n: F.length(strip_chars(F.col(c).cast("string"))) < n
    return {
        "year": ("warning", checked["year"][1]),
        "date_format": ("warning", raw.isNotNull() & date.isNull()),
        "date_year": ("warning", date.isNotNull() & (F.year(date) != F.lit(cfg.year))
                      if cfg.year is not None else F.lit(False)),
        "sex_domain": ("error", checked["sex_domain"][1]),
        "area_domain": ("error", checked["area_domain"][1]),
        "hospital_domain": ("error", checked["hospital_domain"][1]),
        "short_region_code": ("warning", short("region_code", 2)),
        "short_local_code": ("warning", short("local_code", 3)),
        "age_not_numeric": ("warning", F.col("age").isNotNull() & age.isNull()),
        "age_range": ("warning", (age < cfg.age_min) | (age > cfg.age_max)),
        "event_code": ("warning", event.isNotNull() & ~event.isin(*[float(e) for e in C.EXPECTED_EVENT_CODES])),
    }


def findings(df: DataFrame, cfg: Config | None = None, rules=None) -> DataFrame:
    """One row per rule (of ``rules``, or all)."""
    cfg = cfg or Config()
    df = df.toDF(*[c.strip() for c in df.columns])
    cols = df.columns
    wanted = lambda r: rules is None or r in rules
    missing = [c for c in C.REQUIRED_COLUMNS if c not in cols]
    optional_found = [c for c in C.OPTIONAL_COLUMNS if c in cols]
    n = F.col("_n")
    aggs, rows = [F.count(F.lit(1)).alias("_n")], []

    def add(rule, severity, triggered, n_rows, names=None, **kw):
        if wanted(rule):
            rows.append(_finding(rule, severity, triggered, n_rows, _names([]) if names is None else names,
                                 message(rule, cfg, **kw)))

    add("not_empty", "error", n == 0, n)
    add("max_rows", "warning", n > cfg.max_rows, n)
    add("required_columns", "error", F.lit(bool(missing)), F.lit(len(missing)), _names(missing))
    if not missing:
        if wanted("empty_required") or wanted("empty_other"):
            aggs += [F.count(F.col(c)).alias(f"_cnt_{i}") for i, c in enumerate(cols)]
            empty = F.filter(F.array(*[F.when(F.col(f"_cnt_{i}") == 0, F.lit(c)) for i, c in enumerate(cols)]),
                             lambda x: x.isNotNull())
            req = set(C.REQUIRED_COLUMNS)
            empty_req = F.filter(empty, lambda x: x.isin(*req))
            empty_other = F.filter(empty, lambda x: ~x.isin(*req))
            add("empty_required", "error", F.size(empty_req) > 0, F.size(empty_req), empty_req)
            add("empty_other", "warning", F.size(empty_other) > 0, F.size(empty_other), empty_other)
        for rule, (severity, bad) in _counted(cfg).items():
            if not wanted(rule):
                continue
            aggs.append(count_if(bad).alias(f"_{rule}"))
            triggered = F.col(f"_{rule}") > 0
            if rule == "event_code":
                aggs.append(F.count(_number("event_code")).alias("_event_rows"))
                triggered = triggered | (F.col("_event_rows") == 0)
            add(rule, severity, triggered, F.col(f"_{rule}"))
    add("psychiatric_flag_missing", "warning", F.lit("gp_psychiatric" not in cols), F.lit(0))
    add("optional_columns", "info", F.lit(True), F.lit(len(optional_found)), _names(optional_found),
        found=len(optional_found), total=len(C.OPTIONAL_COLUMNS))
    if not rows:
        return df.sparkSession.createDataFrame([], FINDING_SCHEMA)
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("f")).select("f.*")


FINDING_SCHEMA = "rule_id string, severity string, triggered boolean, n_rows bigint, vals array<string>, message string"


def offending_values(df: DataFrame, cfg: Config | None = None, rules=VALUE_RULES) -> DataFrame:
    """(rule_id, value, value_rows): every distinct value the rules object to."""
    df = df.toDF(*[c.strip() for c in df.columns])
    pairs = [F.struct(F.lit(r).alias("rule_id"), F.when(bad, value).alias("value"))
             for r, (value, bad) in _checked(cfg or Config()).items() if r in rules]
    return (df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").where("value is not null")
            .groupBy("rule_id", "value").agg(F.count(F.lit(1)).cast("bigint").alias("value_rows")))


def with_values(found: DataFrame, values: DataFrame) -> DataFrame:
    """Findings with a row per offending value (a rule without any: nulls)."""
    return found.join(values, "rule_id", "left")


def summary(df: DataFrame, found: DataFrame) -> DataFrame:
    """Valid flag (no triggered error), row/column totals, estimated valid
    rows (rows minus notification dates outside the year)."""
    return found.agg(
        (F.sum(F.when((F.col("severity") == "error") & F.col("triggered"), 1)
               .otherwise(0)) == 0).alias("is_valid"),
        F.max(F.when(F.col("rule_id") == "not_empty", F.col("n_rows"))).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        (F.max(F.when(F.col("rule_id") == "not_empty", F.col("n_rows")))
         - F.coalesce(F.max(F.when(F.col("rule_id") == "date_year", F.col("n_rows"))),
                      F.lit(0))).cast("bigint").alias("valid_rows_estimate"),
        F.sum(F.when(F.col("triggered") & (F.col("severity") == "error"), 1).otherwise(0))
         .cast("bigint").alias("n_errors"),
        F.sum(F.when(F.col("triggered") & (F.col("severity") == "warning"), 1).otherwise(0))
         .cast("bigint").alias("n_warnings"))


def preview(df: DataFrame, n: int = 10, id_col: str = "case_id") -> DataFrame:
    """First n rows of the key columns, for a human check before merging."""
    keep = [c for c in ("case_id", "epi_year", "epi_week", "notified_text", "age", "sex",
                        "region_name", "local_name") if c in df.columns]
    return df.select(*keep).orderBy(F.col(id_col).asc_nulls_last()).limit(n)


def contract_table(df: DataFrame) -> DataFrame:
    """(place, kind, column, present, n_filled): the contract's columns in
    order, whether the file has them, and how many of its rows fill them."""
    wanted = [("required", c) for c in C.REQUIRED_COLUMNS] + [("optional", c) for c in C.OPTIONAL_COLUMNS]
    have = [c for _, c in wanted if c in df.columns]
    rows = df.sparkSession.createDataFrame([(i + 1, kind, c, c in have) for i, (kind, c) in enumerate(wanted)],
                                           "place int, kind string, column string, present boolean")
    filled = df.agg(*[F.count(F.col(c)).alias(c) for c in have]).unpivot([], have, "column", "n_filled")
    return rows.join(filled, "column", "left").select("place", "kind", "column", "present", F.coalesce("n_filled", F.lit(0)).alias("n_filled"))


def contract_doc() -> str:
    """The required format as Markdown, generated from the contract."""
    req = "\n".join(f"- `{c}`" for c in C.REQUIRED_COLUMNS)
    opt = "\n".join(f"- `{c}`" for c in C.OPTIONAL_COLUMNS)
    return (f"**Required columns** (exact names):\n\n{req}\n\n"
            f"**Optional columns**:\n\n{opt}\n\n**Rules:** dates as yyyy-mm-dd; sex F or M; "
            "area type 1, 2 or 3; hospitalisation 1 or 2; region code 2 characters, local "
            "code 3 characters; no required column completely empty.")
