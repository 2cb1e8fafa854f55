"""Null-, rounding- and tie-aware column helpers (all JVM-side expressions).

The analysis being reproduced runs on pandas; these helpers pin down where
its semantics differ from SQL three-valued logic:

* comparisons with null count as *false* (``coalesce(cond, false)``);
* ``round`` is numpy's: scale, round half to even on the double, unscale;
* ``zfill`` pads but never truncates;
* ``str.strip`` removes Unicode whitespace, not just spaces.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_true(cond: Column) -> Column:
    """Null-safe predicate: null counts as false (pandas comparison rule)."""
    return F.coalesce(cond, F.lit(False))


def flag01(cond: Column) -> Column:
    """1 when the condition holds, 0 otherwise (null -> 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def round_half_even(c, digits: int = 0) -> Column:
    """numpy-style rounding: ``rint(x * 10**d) / 10**d`` on doubles."""
    scale = float(10 ** digits)
    x = col(c).cast("double")
    if digits == 0:
        return F.rint(x)
    return F.rint(x * F.lit(scale)) / F.lit(scale)


def mean_2dp(c) -> Column:
    """Mean of a column that holds 2-dp values, summed as exact integer
    hundredths so the result does not depend on summation order (and so
    on partitioning)."""
    x = col(c)
    return F.sum(F.rint(x * F.lit(100.0)).cast("bigint")).cast("double") \
        / F.count(x).cast("double") / F.lit(100.0)


def row_digest(columns, types: dict | None = None) -> list[Column]:
    """Two 64-bit hashes of a row, nulls told apart from values by place.
    Columns of maps have no hash and must not be among ``columns``."""
    cs = [col(c) for c in columns]
    holes = [c.isNull() for c in cs]
    return [F.xxhash64(F.lit(seed), *cs, *holes).alias(f"_digest{seed}") for seed in (1, 2)]


def share(num: Column, den: Column) -> Column:
    """Exact ratio of two counts as a double; null when the denominator is 0."""
    return F.when(den != 0, num.cast("double") / den.cast("double"))


@lru_cache(maxsize=1)
def whitespace() -> str:
    """The characters Python's str.strip() removes (str.isspace), built from
    the rule on first use."""
    return "".join(chr(i) for i in range(0x110000) if chr(i).isspace())


def strip_chars(c) -> Column:
    """Trim whitespace at both ends exactly like ``str.strip()`` (every
    Unicode whitespace character, no regex)."""
    return F.btrim(col(c), F.lit(whitespace()))


def strip_text(c) -> Column:
    """``strip_chars``; blank text becomes null."""
    return F.nullif(strip_chars(c), F.lit(""))         # trims once, where a test of the trimmed text would trim twice


def zfill(c, width: int) -> Column:
    """Left-pad with zeros to ``width`` without ever truncating longer text."""
    s = col(c).cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


def count_if(cond: Column) -> Column:
    return F.sum(flag01(cond)).cast("bigint")


def label_map(c, mapping: dict, default: str) -> Column:
    """Code -> label via a literal map; unknown or null codes get ``default``."""
    if not mapping:
        return F.lit(default)
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    m = F.create_map(*kv)
    return F.coalesce(F.element_at(m, col(c)), F.lit(default))


def accent_key(c) -> Column:
    """Join key without accents, upper-case, trimmed (Latin-1 accent set)."""
    src = "ÁÀÂÄÃÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇáàâäãéèêëíìîïóòôöõúùûüñç"
    dst = "AAAAAEEEEIIIIOOOOOUUUUNCaaaaaeeeeiiiiooooouuuunc"
    return F.upper(F.trim(F.translate(col(c), src, dst)))
