"""Randomised properties of the index on small generated line lists."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from epispark.config import Config
from epispark.operators import clean as CL
from epispark.operators import index as IX
from helpers import raw_df

CFG = Config(year=2024)

case = st.fixed_dictionaries({
    "local_code": st.sampled_from(["001", "002", "003", "004"]),
    "age": st.one_of(st.none(), st.integers(0, 99)),
    "epi_week": st.one_of(st.none(), st.integers(1, 53)),
    "hospital_code": st.sampled_from([1, 2, None]),
    "gp_psychiatric": st.sampled_from([1, 2, None]),
    "sex": st.sampled_from(["F", "M", "x", None]),
    "area_type": st.sampled_from([1, 2, 3, None]),
})


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(case, min_size=1, max_size=40))
def test_index_properties(spark, rows):
    raw = raw_df(spark, rows)
    pop = spark.createDataFrame([("05001", 1000.0), ("05003", 250.0)],
                                "area_code string, population double")
    idx = IX.index_flow(CL.clean(raw, CFG), pop, CFG, checkpoint=False).collect()
    assert sum(r["cases"] for r in idx) == len(rows)
    for r in idx:
        for c in IX.SHARE_COLUMNS:
            assert 0.0 <= r[c] <= 1.0
        assert -1.0 <= r["trend"] <= 1.0 and 0.0 <= r["score"] <= 100.0
    ranked = sorted(idx, key=lambda r: r["rank"])
    assert ranked[0]["rank"] == 1
    for a, b in zip(ranked, ranked[1:]):
        assert a["score"] >= b["score"]
        assert (a["rank"] == b["rank"]) == (a["score"] == b["score"])
    order = {"Baja": 0, "Media": 1, "Alta": 2, "Crítica": 3}
    for a, b in zip(ranked, ranked[1:]):
        assert order[a["priority"]] >= order[b["priority"]]
