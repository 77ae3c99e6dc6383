"""Property tests: the skew-safe scan equals a pandas reference on random
inputs (random hot key share, random partition counts, duplicate order values)."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.operators.ordered import keyed_scan


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(n=st.integers(1, 400), n_keys=st.integers(1, 6), hot=st.floats(0, 0.9),
       parts=st.integers(1, 9), seed=st.integers(0, 10_000))
def test_keyed_scan_matches_pandas(spark, n, n_keys, hot, parts, seed):
    import random

    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = 0 if rnd.random() < hot else rnd.randrange(n_keys)
        rows.append((i, k, rnd.randrange(20), rnd.randrange(-5, 6)))
    df = spark.createDataFrame(rows, "id long, k int, t int, v long")
    got = keyed_scan(df, ["k"], ["t", "id"], sums=["v"], totals=True, n_parts=parts).toPandas()
    ref = pd.DataFrame(rows, columns=["id", "k", "t", "v"]).sort_values(["k", "t", "id"])
    ref["rn"] = ref.groupby("k").cumcount() + 1
    ref["run_v"] = ref.groupby("k")["v"].cumsum()
    ref["cnt"] = ref.groupby("k")["id"].transform("count")
    ref["tot_v"] = ref.groupby("k")["v"].transform("sum")
    m = got.merge(ref, on="id", suffixes=("", "_ref"))
    assert len(m) == n
    for c in ("rn", "run_v", "cnt", "tot_v"):
        assert (m[c] == m[f"{c}_ref"]).all(), c
