from pyspark.sql import functions as F

from epispark.functions import derive as D
from epispark.functions.core import accent_key, round_half_even, strip_text, zfill


def one(spark, expr, value, schema):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_round_is_numpy_half_even(spark):
    import numpy as np
    vals = [2.25, 2.35, 0.125, 2.675, -1.25, 12.5, 1e-9, 99.995]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(round_half_even("x", 1)).collect()]
    assert got == [float(np.round(v, 1)) for v in vals]
    got2 = [r[0] for r in df.select(round_half_even("x", 2)).collect()]
    assert got2 == [float(np.round(v, 2)) for v in vals]


def test_strip_unicode_and_blank(spark):
    df = spark.createDataFrame([("  ab \t",), ("   ",), (None,)], "s string")
    assert [r[0] for r in df.select(strip_text("s")).collect()] == ["ab", None, None]


def test_zfill_never_truncates(spark):
    df = spark.createDataFrame([("5",), ("1234",), ("05",)], "s string")
    assert [r[0] for r in df.select(zfill("s", 2)).collect()] == ["05", "1234", "05"]


def test_age_bins_right_closed_lowest_excluded(spark):
    df = spark.createDataFrame([(0,), (1,), (11,), (12,), (17,), (18,), (150,), (151,), (None,)],
                               "age int")
    got = [r[0] for r in df.select(D.age_group("age")).collect()]
    assert got == [None, "0–11", "0–11", "12–17", "12–17", "18–25", "60+", None, None]


def test_quarter_and_semester_edges(spark):
    df = spark.createDataFrame([(1,), (13,), (14,), (52,), (53,), (None,)], "w int")
    q = [r[0] for r in df.select(D.quarter("w")).collect()]
    s = [r[0] for r in df.select(D.semester("w")).collect()]
    assert q[:4] == ["T1 (Sem 1–13)", "T1 (Sem 1–13)", "T2 (Sem 14–26)", "T4 (Sem 40–52)"]
    assert q[4] is None and q[5] is None                     # week 53 / null: no quarter
    assert s[4] == "H2 (Sem 27–52)" and s[5] == "H2 (Sem 27–52)"   # null week -> H2


def test_classify_thresholds(spark):
    df = spark.createDataFrame([(39.99,), (40.0,), (59.99,), (60.0,), (80.0,), (None,)],
                               "x double")
    assert [r[0] for r in df.select(D.classify("x")).collect()] == [
        "Baja", "Media", "Media", "Alta", "Crítica", "Baja"]


def test_labels_default(spark):
    df = spark.createDataFrame([("F",), ("f",), (None,)], "s string")
    assert [r[0] for r in df.select(D.sex_label("s")).collect()] == [
        "Femenino", "Otro/Ind.", "Otro/Ind."]


def test_accent_key(spark):
    df = spark.createDataFrame([(" Bogotá d.c. ",), ("NARIÑO",)], "s string")
    assert [r[0] for r in df.select(accent_key("s")).collect()] == ["BOGOTA D.C.", "NARINO"]


def test_flags_null_false(spark):
    df = spark.createDataFrame([(None, None), (15, 3)], "age int, area int")
    rows = df.select(D.is_minor("age"), D.is_adolescent("age"), D.is_rural("area")).collect()
    assert tuple(rows[0]) == (False, False, False) and tuple(rows[1]) == (True, True, True)


def test_month_name(spark):
    df = spark.createDataFrame([(1,), (12,), (None,)], "m int")
    assert [r[0] for r in df.select(D.month_name("m", short=True)).collect()] == [
        "Ene", "Dic", None]
    assert F is not None
