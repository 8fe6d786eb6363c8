"""Property test: the bracketed exact quantile equals Spark's exact percentile."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from civicflow.functions.quantiles import grouped_quantiles

values = st.one_of(
    st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False),
    st.integers(min_value=-5, max_value=5).map(float),   # many ties
)
rows = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), values), min_size=1, max_size=300)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows, p=st.sampled_from([0.0, 0.1, 0.5, 0.75, 0.99, 1.0]))
def test_matches_spark_percentile(spark, data, p):
    df = spark.createDataFrame(data, "g string, v double")
    ours = {r.g: r.q0 for r in grouped_quantiles(df, ["g"], "v", [p], accuracy=20).collect()}
    ref = {r.g: r.q for r in df.groupBy("g").agg(F.percentile("v", p).alias("q")).collect()}
    assert ours.keys() == ref.keys()
    for g, want in ref.items():
        assert math.isclose(ours[g], want, rel_tol=1e-9, abs_tol=1e-9), (g, ours[g], want)
