"""What moves or is held must not grow faster than the input."""

import random

from pyspark.sql import functions as F

from quayside import session
from quayside.operators import effective as E
from quayside.operators import sequence
from quayside.operators.sequence import with_sequences
from quayside.plans import proforma
from tests.conftest import rows


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _proforma_inputs(spark, n=60):
    spine = spark.range(n).selectExpr("id AS A_ID", "IF(id % 7 = 0, NULL, id % 5) AS PROFM_STOP_ID", "id % 4 AS PROFORMA_ID")
    stops = spark.range(4).selectExpr("id AS PROFM_STOP_ID", "concat('p', id) AS PORT_ID")
    cut = spark.range(8).selectExpr("id % 4 AS profm_stop_id", "'DG' AS cargo_nature", "'Cutoff' AS type",
                                    *[f"id AS {m}" for m in proforma.PROFM_MEASURES])
    return spine, stops, cut, spark.range(3).selectExpr("id AS PROFORMA_ID", "concat('s', id) AS SVC_CDE")


def test_proforma_rows_get_wide_in_the_last_join(spark):
    out = proforma.proforma_mart(*_proforma_inputs(spark))
    assert out.columns[:5] == ["PROFORMA_ID", "PROFM_STOP_ID", "A_ID", "PORT_ID", "gc_cut_date_day_off"] and out.columns[-2:] == ["SVC_CDE", "REC_CRE_TS"]
    last = next(line for line in _plan(out).splitlines() if "Join LeftOuter" in line)
    assert "PROFM_STOP_ID" in last and "PROFORMA_ID" not in last
    assert rows(out.where("A_ID IN (0, 6, 9)"), "A_ID", "PORT_ID", "dg_cut_date_l_hr", "SVC_CDE") == [(0, None, None, "s0"), (6, "p1", 5, "s2"), (9, None, None, "s1")]


def test_a_large_proforma_mart_is_not_dealt_into_a_fixed_number_of_tasks(spark, monkeypatch):
    tables = _proforma_inputs(spark)
    assert proforma.proforma_mart(*tables, num_files=5).rdd.getNumPartitions() == 5
    monkeypatch.setattr(proforma, "ROWS_PER_FILE", 10)
    large = proforma.proforma_mart(*tables, num_files=5)
    assert "Repartition" not in _plan(large) and large.count() == 60


def test_sequences_send_no_ids_and_cut_large_groups(spark, monkeypatch):
    """No row is joined back by its id, and a large group is counted in slices, also when a sample finds it."""
    base = spark.range(4000).select(F.when(F.col("id") % 2 > 0, F.col("id") % 50).alias("g"), (F.col("id") * 7919 % 13).alias("o"), F.col("id"))
    specs = {"x": (["g"], ["o", "id"]), "y": (["o", "g"], ["id"])}
    want = rows(with_sequences(base, specs, "window"))
    assert "Join" not in _plan(with_sequences(base, specs))
    monkeypatch.setattr(sequence, "SLICE_ROWS", 300)
    monkeypatch.setattr(sequence, "SAMPLE_ROWS", 1000)
    cut = with_sequences(base, specs)
    assert "Join" in _plan(cut) and rows(cut) == want
    spec = sequence._cuts(base, ["g"], ["o", "id"], 300).collect()
    assert [r["__g0"] for r in spec] == [None] and len(spec[0]["__seq_cuts"]) == 6


def test_sequences_of_rows_that_are_dealt_already(spark, monkeypatch):
    """They share that move, but not if one value has more rows than a slice."""
    base = spark.range(3000).select(F.when(F.col("id") % 2 > 0, F.col("id") % 50).alias("g"), (F.col("id") % 40).alias("p"), (F.col("id") * 7919 % 13).alias("o"), F.col("id"))
    specs = {"x": (["g", "p"], ["o", "id"])}
    want = rows(with_sequences(base, specs, "window"))
    shared = with_sequences(base.repartition(4, "g"), specs, basis=base, dealt_by=["g"])
    assert _plan(shared).count("Repartition") == 1
    assert rows(shared) == want
    for most in (300, 60):                                       # many groups of few rows under the value NULL; large groups
        monkeypatch.setattr(sequence, "SLICE_ROWS", most)
        apart = with_sequences(base.repartition(4, "g"), specs, basis=base, dealt_by=["g"])
        assert "RepartitionByExpression [g#" in _plan(apart) and ", p#" in next(x for x in _plan(apart).splitlines() if "Repartition" in x)
        assert rows(apart) == want


def test_chained_cut_offs_leave_wide_rows_where_they_are(spark):
    from quayside.plans.schedule import with_cut_ava
    cut = spark.createDataFrame([(s, c, n, t, f"{s}{c}{n}{t}", "l") for s in ("P1", "P2", None) for c in ("A", "B", None) for n in ("DG", "CFS") for t in ("Cutoff", "Availability") if (s, c, n) != ("P2", "B", "CFS")],
                                "STOP_ID string, CARRIER_ID string, CARGO_NATURE string, TYPE string, DATE_IODT string, DATE_LOC string")
    cut = cut.unionByName(cut.where("STOP_ID = 'P1' AND CARRIER_ID = 'A'"))              # rows that come twice
    df = spark.createDataFrame([("P1", 1), ("P2", 2), ("P3", 3), (None, 4)], "STOP_ID string, n int")
    combos = [("DG", "Cutoff"), ("CFS", "Cutoff"), ("DG", "Availability")]
    for anchor in ("dg_cutoff", "all_carriers"):
        chain = with_cut_ava(df, cut, combos, anchor, "chain")
        outer = next(x for x in _plan(chain).splitlines() if "Join LeftOuter" in x)
        assert "STOP_ID" in outer and "CARRIER_ID" not in outer
        pivot = with_cut_ava(df, cut, combos, anchor, "pivot")
        assert rows(chain, *pivot.columns) == rows(pivot)


def test_departures_are_not_multiplied(spark, monkeypatch):
    """Keys with few validity rows: a departure is dealt out once, not once a unit; many rows give the same."""
    rng = random.Random(3)
    maybe = lambda: None if rng.random() < 0.2 else f"2024{rng.randrange(1, 13):02d}{rng.randrange(1, 29):02d}"
    d = spark.createDataFrame([(i, rng.choice("abc"), maybe()) for i in range(200)], "id long, k string, t string")
    v = spark.createDataFrame([(rng.choice("abd"), rng.choice("xyz"), maybe(), maybe()) for _ in range(40)], "k string, op string, s string, e string")
    got = E.valid_operators(d, v, ["k"], "t", "op", "s", "e")
    assert "__bin" not in _plan(got) and _plan(got).count("Generate") == 1
    few = rows(got.distinct())
    monkeypatch.setattr(E, "MANY", 12)
    both = E.valid_operators(d, v, ["k"], "t", "op", "s", "e")
    assert "__bin" in _plan(both) and rows(both.distinct()) == few


def test_calls_are_dealt_into_tasks_of_bounded_size(spark, monkeypatch):
    calls = spark.range(100).withColumn("k", F.col("id") % 50)
    assert "Repartition" not in _plan(session.dealt(calls, ["k"]))
    monkeypatch.setattr(session, "TASK_ROWS", 5)
    assert session.dealt(calls, ["k"]).rdd.getNumPartitions() == 20
