"""Derived epidemiological variables as column expressions (no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C
from .core import col, flag01, is_true, label_map, round_half_even


def month_of(date_col) -> Column:
    return F.month(col(date_col))


def month_name(month_col, short: bool = False) -> Column:
    names = C.MONTH_SHORT if short else C.MONTH_NAMES
    arr = F.array(*[F.lit(n) for n in names])
    m = col(month_col)
    return F.when(m.between(1, 12), F.element_at(arr, m))


def binned(c, edges, labels) -> Column:
    """Right-closed bins ``(e0, e1], (e1, e2], ...``; outside -> null."""
    x = col(c)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x > lo) & (x <= hi)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def bin_ordinal(c, edges) -> Column:
    x = col(c)
    expr = None
    for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:]), start=1):
        cond = (x > lo) & (x <= hi)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def quarter(week_col) -> Column:
    return binned(week_col, C.WEEK_EDGES, C.QUARTER_LABELS)


def semester(week_col) -> Column:
    """Week <= 26 -> first half; anything else, null included, -> second."""
    return F.when(is_true(col(week_col) <= 26), F.lit(C.SEMESTER_LABELS[0])) \
            .otherwise(F.lit(C.SEMESTER_LABELS[1]))


def age_group(age_col) -> Column:
    return binned(age_col, C.AGE_EDGES, C.AGE_LABELS)


def age_group_ord(age_col) -> Column:
    return bin_ordinal(age_col, C.AGE_EDGES)


def sex_label(sex_col) -> Column:
    return label_map(sex_col, C.SEX_LABELS, C.SEX_DEFAULT)


def area_label(area_col) -> Column:
    return label_map(area_col, C.AREA_LABELS, C.AREA_DEFAULT)


def hospital_label(hosp_col) -> Column:
    return label_map(hosp_col, C.HOSPITAL_LABELS, C.HOSPITAL_DEFAULT)


def is_minor(age_col) -> Column:
    return is_true(col(age_col) < 18)


def is_adolescent(age_col) -> Column:
    return is_true(col(age_col).between(12, 17))


def is_young_adult(age_col) -> Column:
    return is_true(col(age_col).between(18, 25))


def is_rural(area_col) -> Column:
    return is_true(col(area_col) == 3)


def index_flags() -> dict[str, Column]:
    """0/1 flags feeding the area table (null inputs -> 0)."""
    return {
        "f_adolescent": flag01(col("age").between(12, 17)),
        "f_young_adult": flag01(col("age").between(18, 25)),
        "f_hospitalised": flag01(col("hospital_code") == 1),
        "f_psychiatric": flag01(col("gp_psychiatric") == 1),
        "f_second_half": flag01(col("epi_week") > 26),
    }


def classify(score_col) -> Column:
    """Index -> priority class; null or below every threshold -> default."""
    x = col(score_col)
    expr = None
    for name, thr in C.PRIORITY_CLASSES:
        cond = x >= thr
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(C.PRIORITY_DEFAULT))


def priority_ordinal(priority_col) -> Column:
    """Severity order 1 (most severe) .. 4; 0 when unknown."""
    names = F.array(*[F.lit(n) for n in C.PRIORITY_ORDER])
    return F.array_position(names, col(priority_col)).cast("int")


def gp_label(name_col) -> Column:
    kv = []
    for k, v in C.GP_LABELS.items():
        kv += [F.lit(k), F.lit(v)]
    return F.coalesce(F.element_at(F.create_map(*kv), col(name_col)), col(name_col))


def trend_text(trend_col) -> Column:
    return F.concat(F.format_number(round_half_even(col(trend_col) * 100, 1), 1), F.lit("%"))
