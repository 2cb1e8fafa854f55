"""Rule-based recommendations per area, vectorised over the area table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.core import count_if, flag01, round_half_even
from .describe import pct1

# FIXED VALUES: rule thresholds on the area table (id, column, op, value)
RULES = (
    ("immediate_intervention", "priority", "==", "Crítica"),
    ("school_prevention", "pct_adolescent", ">", 0.30),
    ("intensified_surveillance", "trend", ">", 0.3),
    ("rural_access", "pct_rural", ">", 0.20),
    ("hospital_capacity", "pct_hospitalised", ">", 0.70),
    ("post_event_follow_up", "pct_psychiatric", ">", 0.05),
)
DEFAULT_RULE = "keep_surveillance"


def default_text(rule_id: str) -> str:
    """What a rule says where the caller gives no advice of their own."""
    for rid, col, op, value in RULES:
        if rid == rule_id:
            return f"{rule_id}: {col} {op} {value}"
    return f"{rule_id}: no other rule applies"


def _cond(col, op, value):
    c = F.col(col)
    return c == F.lit(value) if op == "==" else c > F.lit(value)


def rules(idx: DataFrame, texts: dict[str, str] | None = None) -> DataFrame:
    """Per area: triggered rule ids (in rule order) and their texts (``texts``
    by rule id, else the rule itself); the default rule when none fires."""
    say = lambda rid: F.lit((texts or {}).get(rid, default_text(rid)))
    ids = F.array_compact(F.array(*[F.when(_cond(c, op, v), F.lit(rid)) for rid, c, op, v in RULES]))
    said = F.array_compact(F.array(*[F.when(_cond(c, op, v), say(rid)) for rid, c, op, v in RULES]))
    ids = F.when(F.size(ids) == 0, F.array(F.lit(DEFAULT_RULE))).otherwise(ids)
    said = F.when(F.size(said) == 0, F.array(say(DEFAULT_RULE))).otherwise(said)
    return idx.select("area_code", "region_name", "local_name", "priority",
                      F.concat_ws(",", ids).alias("rule_ids"),
                      F.size(ids).alias("n_rules"),
                      F.concat_ws("\n\n", said).alias("text"))


def area_profile(idx: DataFrame, area_code: str | None = None) -> DataFrame:
    """Profile of one area (default: the first-ranked, ties -> smallest code)."""
    if area_code is None:
        pick = idx.orderBy("rank", "area_code", "region_name", "local_name").limit(1)
    else:
        pick = idx.where(F.col("area_code") == area_code)
    return pick.select(
        "area_code", "region_name", "local_name", "cases",
        round_half_even("rate_100k", 1).alias("rate_100k"),
        round_half_even(F.col("pct_adolescent") * 100, 1).alias("pct_adolescent"),
        round_half_even(F.col("trend") * 100, 1).alias("trend_pct"),
        round_half_even(F.col("pct_hospitalised") * 100, 1).alias("pct_hospitalised"),
        round_half_even(F.col("pct_psychiatric") * 100, 1).alias("pct_psychiatric"),
        round_half_even("score", 1).alias("score"), "priority", "rank")


def findings(cases: DataFrame, idx: DataFrame) -> DataFrame:
    """Four headline findings: % adolescents, % rural, # critical areas and
    the region with most cases (ties -> smallest name)."""
    n = F.count(F.lit(1))
    c = cases.agg(pct1(F.sum(flag01(F.col("is_adolescent"))), n).alias("pct_adolescent"),
                  pct1(F.sum(flag01(F.col("is_rural"))), n).alias("pct_rural"))
    crit = idx.select(count_if(F.col("priority") == "Crítica")).scalar()
    reg = cases.where(F.col("region_name").isNotNull()).groupBy("region_name") \
               .agg(F.count(F.lit(1)).alias("_n"))
    top = reg.select(F.min_by("region_name", F.struct((-F.col("_n")).alias("a"),
                                                      F.col("region_name").alias("b"))))\
             .scalar()
    return c.select("*", crit.alias("n_critical"), top.alias("top_region"))
