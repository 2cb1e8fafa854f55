from pyspark.sql import functions as F

from epispark.config import Config
from epispark.operators import clean as CL
from epispark.operators import profile as PF
from epispark.plans import workflows
from epispark.sources import adapter
from epispark.sources import cases as SRC
from conftest import SF_SMALL
from helpers import raw_df


def test_read_cases_csv_keeps_codes_and_try_casts(spark, tmp_dir):
    path = f"{tmp_dir}/in.csv"
    with open(path, "w", encoding="utf-8") as f:
        f.write("CONSECUTIVE,COD_DPTO_O,EDAD,ANO\n1,05,24,2024\n2,08,x,2024\n")
    df = SRC.read_cases(spark, path, "csv", mapping={"CONSECUTIVE": "case_id",
                                                     "COD_DPTO_O": "region_code",
                                                     "EDAD": "age", "ANO": "epi_year"})
    rows = {r["case_id"]: r for r in df.collect()}
    assert rows["1"]["region_code"] == "05" and rows["1"]["age"] == 24
    assert rows["2"]["age"] is None
    assert dict(df.dtypes)["epi_year"] == "int" and dict(df.dtypes)["case_id"] == "string"
    typed = SRC.read_cases(spark, path, "csv", mapping={"CONSECUTIVE": "case_id"},
                           types={"case_id": "bigint"})
    assert dict(typed.dtypes)["case_id"] == "bigint"


def test_write_clean_partitioned_and_snapshot(spark, tmp_dir):
    c = CL.clean(raw_df(spark, [{}, {"epi_year": 2024}]), Config(year=2024))
    SRC.write_clean(c, f"{tmp_dir}/clean")
    back = SRC.read_clean(spark, f"{tmp_dir}/clean")
    assert back.where(F.col("epi_year") == 2024).count() == 2
    p = SRC.write_snapshot(back, f"{tmp_dir}/acc", 1)
    assert SRC.read_snapshot(spark, f"{tmp_dir}/acc", 1).count() == 2 and p.endswith("=1")
    try:
        SRC.write_snapshot(back, f"{tmp_dir}/acc", 1)      # never overwrite a version
        raise AssertionError("overwrote a snapshot")
    except Exception as e:  # noqa: BLE001
        assert "already exists" in str(e).lower() or "exists" in str(e).lower()


def test_resolve_base_order_and_defaults(spark, tmp_dir):
    raw_df(spark, [{}]).drop("event_code", "epi_year").write.parquet(f"{tmp_dir}/clean_in")
    base = SRC.resolve_base(spark, [(f"{tmp_dir}/missing", "parquet"),
                                    (f"{tmp_dir}/clean_in", "parquet")])
    r = base.first()
    assert r["event_code"] == 356 and r["epi_year"] == 2024
    assert SRC.resolve_base(spark, [(f"{tmp_dir}/none", "parquet")]) is None


def test_trim_names_and_drop_columns(spark):
    df = raw_df(spark, [{}]).withColumnRenamed("age", " age ").withColumn("GRU_POB", F.lit(1))
    t = CL.drop_columns(CL.trim_column_names(df), Config())
    assert "age" in t.columns and "GRU_POB" not in t.columns


def test_dtypes_and_roles(spark):
    df = raw_df(spark, [{}])
    types = dict((r["column"], r["type"]) for r in PF.dtypes(df).collect())
    assert types["age"] == "int" and types["region_code"] == "string"
    roles = PF.column_roles(df)
    assert "case_id" in roles["id"] and roles["risk"] == ["gp_psychiatric"]
    assert "region_code" in roles["geographic"]


def test_update_workflow_success(spark, tmp_dir):
    cfg = Config(year=1998)
    raw = adapter.raw_cases(spark, SF_SMALL).where(
        F.col("sex").isin("F", "M") & F.col("area_type").isin(1, 2, 3))
    base, new = raw.where(F.col("case_id") % 2 == 0), raw.where(F.col("case_id") % 3 == 0)
    res = workflows.update(spark, base, new, adapter.population(spark, SF_SMALL), tmp_dir, 1,
                           cfg, adapter.region_aliases(spark, SF_SMALL))
    assert res["ok"], res
    from epispark.streaming import incremental as INC
    merged = INC.read_table(spark, res["table"])
    assert merged.count() == raw.where((F.col("case_id") % 2 == 0) |
                                       (F.col("case_id") % 3 == 0)).count()
    assert res["report"]["added"] == merged.count() - base.count()
    assert spark.read.parquet(res["areas"]).count() > 0
    assert workflows.update(spark, None, new, adapter.population(spark, SF_SMALL), tmp_dir, None, cfg,
                            models=True)["report"]["added"] == 0


def test_original_column_names_end_to_end(spark, tmp_dir):
    """A file with the original headers reads, cleans and indexes directly."""
    from epispark.config import SOURCE_NAMES
    from epispark.operators import index as IX
    path = f"{tmp_dir}/orig.csv"
    head = ("CONSECUTIVE,COD_EVE,Nombre_evento,ANO,SEMANA,FEC_NOT,INI_SIN,FECHA_NTO,EDAD,UNI_MED,"
            "SEXO,AREA,PAC_HOS,COD_DPTO_O,COD_MUN_O,Departamento_ocurrencia,"
            "Municipio_ocurrencia,GP_PSIQUIA,nom_grupo,estrato,GRU_POB\n")
    rows = ["1,356,INTENTO,2024,10,2024-03-05,2024-03-01,2000-01-01,24,1,F,1,1,05,001,"
            "ANTIOQUIA,MEDELLIN,1, ,2,",
            "2,356,INTENTO,2024,30,2024-07-05,,2010-01-01,14,1,M,3,2,5,1,antioquia ,"
            "MEDELLIN,2,g,x,",
            "3,356,INTENTO,2024,31,2024-07-06,,2009-01-01,15,1,F,1,1,11,001,BOGOTA DC,"
            "BOGOTA,2,,3,"]
    with open(path, "w", encoding="utf-8") as f:
        f.write(head + "\n".join(rows) + "\n")
    raw = SRC.read_cases(spark, path, "csv", mapping=SOURCE_NAMES)
    clean = CL.clean(raw, Config(year=2024))
    assert "GRU_POB" not in clean.columns
    codes = {r["case_id"]: r["area_code"] for r in clean.collect()}
    assert codes == {"1": "05001", "2": "05001", "3": "11001"}      # ids keep their text
    pop = spark.createDataFrame([("05001", 2700000.0)], "area_code string, population double")
    idx = {r["area_code"]: r for r in IX.index_flow(clean, pop, Config(year=2024),
                                                    checkpoint=False).collect()}
    assert idx["05001"]["cases"] == 2 and idx["11001"]["population"] == 50000.0


def test_cluster_conf_sizes_partitions():
    from epispark.session import cluster_conf
    c = cluster_conf(100 * 1024 ** 4)                       # 100 TB
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert c["spark.sql.adaptive.enabled"] == "true"
    assert int(cluster_conf(1)["spark.sql.shuffle.partitions"]) == 200


def test_raw_files_grow_in_number_not_in_size(spark, monkeypatch):
    from conftest import SF_SMALL
    from epispark.plans import catalog
    monkeypatch.setattr(catalog, "FILE_ROWS", 100)
    raw = catalog.Inputs(spark, SF_SMALL).raw
    assert len(raw.inputFiles()) >= raw.count() // 100 > int(spark.conf.get("spark.sql.shuffle.partitions"))
