"""Tiny hand-made line lists for edge-case tests."""

RAW_SCHEMA = ("case_id bigint, event_code int, event_name string, epi_year int, epi_week int, "
              "notified_text string, onset_text string, born_text string, age int, "
              "age_unit int, sex string, area_type int, hospital_code int, region_code string, "
              "local_code string, region_name string, local_name string, gp_psychiatric int, "
              "group_name string, stratum string")
FIELDS = [f.split()[0] for f in RAW_SCHEMA.split(", ")]

DEFAULT = dict(event_code=356, event_name="case", epi_year=2024, epi_week=10,
               notified_text="2024-03-05", onset_text="2024-03-01", born_text="2000-01-01",
               age=24, age_unit=1, sex="F", area_type=1, hospital_code=1, region_code="05",
               local_code="001", region_name="ANTIOQUIA", local_name="MEDELLIN",
               gp_psychiatric=2, group_name="g", stratum="2")


def raw_df(spark, rows):
    data = []
    for i, r in enumerate(rows):
        d = {**DEFAULT, "case_id": i + 1, **r}
        data.append(tuple(d[f] for f in FIELDS))
    return spark.createDataFrame(data, RAW_SCHEMA)
