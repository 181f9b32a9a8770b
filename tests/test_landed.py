"""Pruned reloads and loads published as one commit."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quayside.sources import buckets as B
from quayside.sources.landed import LandedTable
from quayside.sources.landing import incremental_load, read_landed, scratch_table_path
from tests.conftest import rows

SCHEMA = "pk long, cre timestamp_ntz, txt string, u string"


def _rows(spark, *data):
    """(key, time text, update)."""
    def time(x):
        return dt.datetime.strptime(x[:8], "%Y%m%d") if x and x[:8].isdigit() else None
    df = spark.createDataFrame([(k, None if (t := time(x)) is None else t.isoformat(), x, u) for k, x, u in data], "pk long, cre string, txt string, u string")
    return df.withColumn("cre", F.col("cre").cast("timestamp_ntz")).to(spark.createDataFrame([], SCHEMA).schema)


def _stored(spark, df):
    path = scratch_table_path(spark, "t-source")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _pushed(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.split("PushedFilters: ")[1].split(", ReadSchema")[0] for line in plan.splitlines() if "PushedFilters" in line and "pk" in line]


OLD = [(1, "20240105", "a"), (2, "20240210", "a"), (3, "20240330", "a"), (4, None, "a"), (5, "garbage", "a"), (6, "19991231", "a")]
NEW = [(1, "20240105", "a"), (2, "20240210", "b"), (7, "20240229", "a"), (3, "20240330", "a"), (4, None, "b"), (5, "garbage", "b"), (8, "20251101", "a")]
SPECS = [B.TimeBucket("cre"), B.TimeBucket("cre", 10), B.TimeBucket("txt", text=True), B.TimeBucket("txt", 10, True), B.KeyRange("pk", 3)]


@pytest.mark.parametrize("spec", SPECS, ids=str)
def test_second_load_equals_the_source(spark, spec):
    table, target, ledger = LandedTable(spark, scratch_table_path(spark, "t-landed")), scratch_table_path(spark, "t-in"), scratch_table_path(spark, "t-inl")
    for data in (OLD, NEW, NEW, []):
        source = _stored(spark, _rows(spark, *data))
        diff = table.load(source, spec, "u", "pk")
        want = rows(source.withColumn("bucket", spec.column()))
        assert rows(table.read()) == want
        if data:
            incremental_load(spark, source, target, ledger, spec, "u", "pk")
            assert rows(read_landed(spark, target, ledger, schema=source.schema), "pk", "u", "bucket") == [(r[0], r[3], r[4]) for r in want]
    assert diff.where("src_row_count IS NOT NULL").count() == 0


@pytest.mark.parametrize("spec", SPECS, ids=str)
def test_the_scan_gets_the_changed_ranges(spark, spec):
    source = _stored(spark, _rows(spark, *NEW))
    every = source.select(spec.column().alias("bucket")).distinct()
    known = every.where("bucket IS NOT NULL").orderBy("bucket").limit(2)
    got = B.changed_rows(source, spec, known)
    assert [f for f in _pushed(got) if f.count(spec.raw) >= 2]
    want = source.withColumn("bucket", spec.column()).join(known, "bucket", "left_semi")
    assert rows(got, "pk") == rows(want, "pk")
    with_null = known.unionByName(every.where("bucket IS NULL"))
    got = B.changed_rows(source, spec, with_null)
    assert [f for f in _pushed(got) if f.count(spec.raw) >= 2]                # the NULL bucket doesn't undo the pruning
    everything = source.withColumn("bucket", spec.column())
    assert rows(got, "pk") == rows(everything.join(with_null, everything["bucket"].eqNullSafe(with_null["bucket"]), "left_semi"), "pk")
    assert rows(B.changed_rows(source, spec, every.limit(0))) == []


def test_ranges_are_merged_across_the_smallest_gaps(spark):
    spec = B.KeyRange("pk", 10)
    ids = lambda *b: spark.createDataFrame([(x,) for x in b], "bucket long")
    assert B.merged_ranges(ids(1, 2, 3, 7, 100), spec) == [(10, 40), (70, 80), (1000, 1010)]
    assert B.merged_ranges(ids(1, 2, 3, 7, 100), spec, 2) == [(10, 80), (1000, 1010)]
    assert B.merged_ranges(ids(1, 100, None), spec, 1) == [(10, 1010)]
    assert B.merged_ranges(ids(None), spec) == [] == B.merged_ranges(ids(), spec)
    edge = (1 << 63) // 10
    low, high = B.merged_ranges(ids(-edge - 1, edge), spec)
    assert low[0] == -(1 << 63) and high == (edge * 10, (1 << 63) - 1)


def test_keys_at_the_ends_of_a_long(spark):
    big = (1 << 63) - 1
    source = _stored(spark, spark.createDataFrame([(-big - 1, "a"), (-1, "a"), (0, "a"), (big, "a")], "pk long, u string"))
    table = LandedTable(spark, scratch_table_path(spark, "t-landed"))
    table.load(source, B.KeyRange("pk", 1000), "u", "pk")
    assert rows(table.read(), "pk") == rows(source, "pk")


def test_a_load_that_is_cut_off_leaves_the_table(spark):
    path, spec = scratch_table_path(spark, "t-landed"), B.TimeBucket("cre")
    old, new = _stored(spark, _rows(spark, *OLD)), _stored(spark, _rows(spark, *NEW))
    table = LandedTable(spark, path)
    with pytest.raises(ValueError):
        table.read()
    table.load(old, spec, "u", "pk")

    class CutOff(LandedTable):
        def _publish(self, number, content):
            raise ConnectionError

    with pytest.raises(ConnectionError):
        CutOff(spark, path).load(new, spec, "u", "pk")
    assert rows(LandedTable(spark, path).read(), "pk", "u") == rows(old, "pk", "u")
    assert table.load(new, spec, "u", "pk").where("changed").count() == 4        # against the old ledger
    assert rows(table.read(), "pk", "u") == rows(new, "pk", "u")
    assert rows(table.read(1), "pk", "u") == rows(old, "pk", "u")
    table.vacuum(keep=1)
    assert rows(table.read(), "pk", "u") == rows(new, "pk", "u") and table.load(new, spec, "u", "pk").where("changed").count() == 0


def test_text_buckets_stay_text(spark):
    schema = "pk long, b string, u string"
    source = spark.createDataFrame([(1, "007", "a"), (2, "7", "a"), (3, "a/b", "a")], schema)
    target, ledger = scratch_table_path(spark, "t-text"), scratch_table_path(spark, "t-textl")
    incremental_load(spark, source, target, ledger, F.col("b"), "u", "pk")
    assert rows(read_landed(spark, target, ledger), "pk", "bucket") == [(1, "007"), (2, "7"), (3, "a/b")]
