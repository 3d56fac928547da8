"""Property: the planner makes the same decisions and output as the column loop."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tripspark.operators import nulls

cell_int = st.one_of(st.none(), st.integers(-20, 20))
cell_dbl = st.one_of(st.none(), st.floats(-1e3, 1e3, allow_nan=False), st.just(float("nan")))
cell_str = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))
rows = st.lists(st.tuples(cell_int, cell_dbl, cell_str, cell_int), min_size=1, max_size=60)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows, threshold=st.sampled_from([5.0, 20.0, 50.0]))
def test_plan_matches_sequential(spark, data, threshold):
    df = spark.createDataFrame(data, "a int, b double, c string, d int")
    fast = nulls.plan_null_policy(df, threshold)
    slow = nulls.plan_null_policy_sequential(df, threshold)
    for x, y in zip(fast.decisions, slow.decisions):
        assert (x.column, x.action, x.null_count) == (y.column, y.action, y.null_count)
        if isinstance(x.fill_value, float):
            assert math.isclose(x.fill_value, y.fill_value, rel_tol=1e-9, abs_tol=1e-9)
        else:
            assert x.fill_value == y.fill_value
    out = fast.apply(df)
    assert out.count() == slow.apply(df).count()
    filled = [d.column for d in fast.decisions if d.action in ("fill_mean", "fill_mode", "drop")]
    for c in filled:
        assert out.filter(out[c].isNull()).count() == 0
