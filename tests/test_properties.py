"""Property tests: lookups on a unique key keep the row count;
latest-per-key equals a brute-force pick; apply_changes is order-free."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quayside.operators.latest import latest_per_key
from quayside.operators.lookup import lookup_join
from quayside.streaming.refresh import Feed, apply_changes
from tests.conftest import rows

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.one_of(st.none(), st.integers(0, 4))


@SETTINGS
@given(st.lists(keys, min_size=0, max_size=30), st.sets(st.integers(0, 6), max_size=6))
def test_unique_lookup_keeps_row_count(spark, spine_keys, lookup_keys):
    spine = spark.createDataFrame([(k, i) for i, k in enumerate(spine_keys)], "k int, i int")
    lk = spark.createDataFrame([(k, f"v{k}") for k in lookup_keys], "k int, v string")
    out = lookup_join(spine, lk, ["k"])
    assert out.count() == len(spine_keys)
    assert all((r["v"] is None) == (r["k"] is None or r["k"] not in lookup_keys) for r in out.collect())


row = st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 1000))


@SETTINGS
@given(st.lists(row, min_size=1, max_size=40, unique_by=lambda r: r[2]))
def test_latest_matches_brute_force(spark, data):
    df = spark.createDataFrame(data, "k int, t int, id int")
    got = rows(latest_per_key(df, ["k"], ["t"], ["t", "id"], ["id"]))
    pdf = pd.DataFrame(data, columns=["k", "t", "id"])
    want = []
    for k, g in pdf.groupby("k"):
        g = g.assign(tn=g["t"].isna(), tv=g["t"].fillna(-1)).sort_values(["tn", "tv", "id"], ascending=[True, False, False])
        top = g.iloc[0]
        want.append((int(k), None if pd.isna(top["t"]) else int(top["t"]), int(top["id"])))
    assert got == sorted(want, key=lambda t: tuple((v is None, v) for v in t))


change = st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 20), st.sampled_from(["U", "D"]))


@SETTINGS
@given(st.lists(change, min_size=1, max_size=25), st.integers(1, 4))
def test_apply_changes_order_free(spark, data, k):
    feed = Feed(pk="pk", payload=("v",))
    recs = [(pk, f"{pk}{i}", ts, i, op) for i, (pk, ts, op) in enumerate(data)]
    ch = spark.createDataFrame(recs, "pk string, v string, change_ts int, seq int, op string")
    one = rows(apply_changes(None, ch, feed))
    state = None
    for j in reversed(range(k)):               # batches in reverse order
        state = apply_changes(state, ch.where(f"seq % {k} = {j}"), feed)
    assert rows(state) == one
