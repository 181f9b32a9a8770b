"""Lookups whose table is aggregated first: a hot key and NULL keys are dealt out."""

import pytest
from pyspark.sql import functions as F

from quayside.operators.lookup import lookup_join, merged_lookup, with_state_lookups
from quayside.plans.capacity import capacity_mart
from quayside.plans.proforma import proforma_mart
from quayside.sources.landing import scratch_table_path
from tests.conftest import rows

N = 400_000
# small tables stand for large ones: no broadcast, 16 partitions, split what is over 1 MB
CONF = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512k"}


@pytest.fixture
def large(spark):
    before = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def most_rows(df):
    """Rows of the largest file that the last stage's tasks write."""
    path = scratch_table_path(df.sparkSession, "t-skew")
    df.write.parquet(path)
    back = df.sparkSession.read.parquet(path)
    assert back.count() >= N
    return back.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]


def spine(spark, hot, key="k"):
    """Half of the rows have the key ``hot``; a text makes rows as wide as those of a mart."""
    return spark.range(N, numPartitions=8).select(
        F.when(F.col("id") % 2 == 0, F.lit(hot).cast("long")).otherwise(F.col("id") % 9973).alias(key), "id", F.sha2(F.col("id").cast("string"), 256).alias("t"))


def states(spark):
    return spark.range(30_000, numPartitions=4).select((F.col("id") % 10_000).alias("k"), F.element_at(F.array(*map(F.lit, "ABC")), (F.col("id") / 10_000 + 1).cast("int")).alias("s"), F.col("id").alias("v"))


@pytest.mark.parametrize("hot", [7, None])
@pytest.mark.parametrize("strategy", ["chain", "pivot"])
def test_state_lookups(large, hot, strategy):
    out = with_state_lookups(spine(large, hot), states(large), ["k"], "s", {"A": "A", "B": "B", "C": "C"}, ["v"], strategy=strategy)
    assert most_rows(out) < N / 4


@pytest.mark.parametrize("hot", [7, None])
def test_capacity(large, hot):
    ids = large.range(10_000)
    voyages = large.range(N, numPartitions=8).select(F.col("id").alias("EFF_VOY_ID"), F.lit("c").alias("CARRIER_CDE"), F.lit("s").alias("SVC_CDE"),
                                                     F.lit("v").alias("VSL_CDE"), F.col("id").alias("EFF_VOY_NUM"), F.lit("East").alias("DIRECTION"))
    assn = spine(large, hot, "VSL_CAP_ID").select(F.col("id").alias("EFF_VOY_ID"), F.col("t").alias("PORT_ID"), "VSL_CAP_ID")
    header = ids.select(F.col("id").alias("VSL_CAP_ID"), F.lit("c").alias("CARRIER_CDE"), F.lit("s").alias("SVC_CDE"), F.lit("v").alias("VSL_CDE"),
                        F.lit("West").alias("DIRECTION"))
    laden = ids.select(F.col("id").alias("VSL_CAP_ID"), F.lit("BOX_20_MAX").alias("CAT_CDE"), F.lit(5).alias("QTY"))
    default = voyages.select("EFF_VOY_ID", F.lit(1).alias("DEFAULT_VSL_CAP_ID"))
    assert most_rows(capacity_mart(voyages, default, assn, header, laden)) < N / 4


@pytest.mark.parametrize("hot", [7, None])
def test_proforma(large, hot):
    s = spine(large, hot, "PROFM_STOP_ID").withColumn("PROFORMA_ID", F.col("id"))
    ids = large.range(10_000)
    stops = ids.select(F.col("id").alias("PROFM_STOP_ID"), F.lit("p").alias("PORT_ID"))
    cut = ids.select(F.col("id").alias("profm_stop_id"), F.lit("DG").alias("cargo_nature"), F.lit("Cutoff").alias("type"),
                     *[F.lit(1).alias(m) for m in ("date_day_off", "date_l_hr", "date_l_min", "date_l_dow")])
    head = large.range(N).select(F.col("id").alias("PROFORMA_ID"), F.lit("x").alias("SVC_CDE"))
    assert most_rows(proforma_mart(s, stops, cut, head)) < N / 4


def test_merged_lookups_give_what_a_chain_gives(spark):
    a = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c"), (None, "n")], "k long, x string")
    b = spark.createDataFrame([(1, 10), (2, 20), (2, 21), (None, 9)], "k long, y long")
    left = spark.createDataFrame([(k, i) for i, k in enumerate([1, 2, 3, 4, None, None])], "k long, id long")
    chain = lookup_join(lookup_join(left, a, ["k"]), b, ["k"])
    got = lookup_join(left, merged_lookup([a, b], ["k"]), ["K"])
    assert got.columns == ["k", "id", "x", "y"] and rows(got) == rows(chain.select(got.columns))


def test_pivot_reads_its_lookup_once_and_again_only_for_several(spark):
    path = scratch_table_path(spark, "t-pivot")
    lookup = [(1, "A", 1), (1, "B", 2), (2, "A", 3)]
    left = spark.createDataFrame([(1,), (2,), (3,)], "k long")

    def scans(data):
        spark.createDataFrame(data, "k long, s string, v long").write.mode("overwrite").parquet(path)
        out = with_state_lookups(left, spark.read.parquet(path), ["k"], "s", {"A": "A", "B": "B"}, ["v"], strategy="pivot")
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        return rows(out), plan.count("Relation")

    assert scans(lookup) == ([(1, 1, 2), (2, 3, None), (3, None, None)], 1)                 # the written pivot alone
    assert scans([*lookup, (1, "A", 9)]) == ([(1, 1, 2), (1, 9, 2), (2, 3, None), (3, None, None)], 2)
