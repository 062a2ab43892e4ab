"""Property test: first_n (global and per group, with and without the cutoff
pre-filter) equals a pandas brute force on random, tie-heavy, skewed data."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from kestrel.operators.sampling import first_n

rows = st.lists(
    st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b", None]),
              st.integers(min_value=-(2**62), max_value=2**62) | st.integers(-3, 3)),
    min_size=1, max_size=120)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows, n=st.integers(min_value=1, max_value=40), asc=st.booleans(),
       pre=st.booleans(), grouped=st.booleans(), bits=st.sampled_from([(12, 12), (2, 1), (1, None)]))
def test_first_n_matches_brute_force(spark, data, n, asc, pre, grouped, bits):
    pdf = pd.DataFrame([(i, g, k) for i, (g, k) in enumerate(data)], columns=["id", "g", "k"])
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(),
                               "id long, g string, k long")
    got = first_n(df, n, ["k", "id"], ascending=asc, partition_by=["g"] if grouped else (),
                  salt_buckets=3, prefilter=pre, mantissa_bits=bits[0],
                  sub_bits=bits[1]).toPandas()
    srt = pdf.sort_values(["k", "id"], ascending=asc)
    exp = srt.groupby("g", dropna=False, sort=False).head(n) if grouped else srt.head(n)
    assert sorted(got["id"]) == sorted(exp["id"])
