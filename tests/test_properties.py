"""Property-based checks of the core load semantics against plain-Python models."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tierwise.operators import load

rows_st = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", "hot"]), st.integers(0, 5), st.integers(0, 3), st.text("xyz", max_size=2)),
    min_size=0,
    max_size=25,
)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(rows=rows_st)
def test_latest_per_key_matches_model(spark, rows):
    df = spark.createDataFrame(rows, "key string, ver int, tie int, payload string")
    got = {r["key"]: (r["ver"], r["tie"], r["payload"]) for r in load.latest_per_key(df, ["key"], ["ver", "tie"]).collect()}
    expect = {}
    for k, v, t, p in rows:
        if k not in expect or (v, t, p) > expect[k]:
            expect[k] = (v, t, p)
    assert got == expect


@SETTINGS
@given(existing=rows_st, batch=rows_st)
def test_upsert_is_delete_then_insert(spark, existing, batch):
    schema = "key string, ver int, tie int, payload string"
    e = spark.createDataFrame(existing, schema)
    b = spark.createDataFrame(batch, schema)
    got = sorted(tuple(r) for r in load.upsert_by_key(e, b, "key").collect())
    batch_keys = {r[0] for r in batch}
    expect = sorted([r for r in existing if r[0] not in batch_keys] + list(batch))
    assert got == expect
