"""Landing: ledger fingerprints, changed buckets, incremental = full load,
file counts, lookback filter."""

import datetime as dt

from pyspark.sql import functions as F

from quayside.functions.scalar import bucket_start
from quayside.sources.landing import (bucket_stats, changed_buckets, incremental_load,
                                      read_landed, scratch_table_path, snapshot_load)
from quayside.streaming.refresh import within_lookback
from tests.conftest import rows

SCHEMA = "pk long, create_iodt string, update_iodt string"


def test_delete_plus_insert_with_same_count_and_max_is_detected(spark):
    old = spark.createDataFrame([(1, "20240105", "20240105"), (2, "20240110", "20240110")], SCHEMA)
    new = spark.createDataFrame([(1, "20240105", "20240105"), (3, "20240107", "20240110")], SCHEMA)
    b = bucket_start("create_iodt", 31, from_string=True)
    diff = changed_buckets(bucket_stats(new, b, "update_iodt", "pk"), bucket_stats(old, b, "update_iodt", "pk"))
    r = diff.collect()[0]
    assert r["src_row_count"] == r["led_row_count"] and r["src_max_update"] == r["led_max_update"]
    assert r["changed"]


def test_incremental_equals_full_and_untouched_buckets_are_not_rewritten(spark):
    old = spark.createDataFrame([(1, "20240105", "a"), (2, "20240210", "b")], SCHEMA)
    new = spark.createDataFrame([(1, "20240105", "a"), (2, "20240210", "c"), (3, "20240301", "d")], SCHEMA)
    b = bucket_start("create_iodt", 31, from_string=True)
    target, ledger = scratch_table_path(spark, "t-target"), scratch_table_path(spark, "t-ledger")
    incremental_load(spark, old, target, ledger, b, "update_iodt", "pk")
    diff = incremental_load(spark, new, target, ledger, b, "update_iodt", "pk")
    assert rows(diff.where("changed"), "bucket") == [("202402",), ("202403",)]
    got = spark.read.parquet(target).select("pk", "update_iodt")
    assert rows(got) == [(1, "a"), (2, "c"), (3, "d")]


def test_snapshot_partitioned_and_file_count(spark):
    df = spark.range(100).select("id", (F.col("id") % 3).cast("string").alias("part"))
    path = scratch_table_path(spark, "t-snap")
    snapshot_load(df, path, partition_by=["part"], num_files=2)
    back = spark.read.parquet(path)
    assert back.count() == 100
    assert back.select(F.input_file_name()).distinct().count() <= 6
    path2 = scratch_table_path(spark, "t-snap2")
    snapshot_load(df, path2, num_files=5)
    assert spark.read.parquet(path2).select(F.input_file_name()).distinct().count() == 5


def test_lookback_window(spark):
    now = dt.datetime(2024, 1, 10)
    df = spark.createDataFrame([(dt.datetime(2024, 1, 6),), (dt.datetime(2024, 1, 8),)], "ts timestamp")
    assert within_lookback(df, "ts", -4320, now).count() == 1     # 3 days


def test_vanished_bucket_leaves_the_target(spark):
    old = spark.createDataFrame([(1, "20240105", "a"), (2, "20240210", "b")], SCHEMA)
    new = spark.createDataFrame([(1, "20240105", "a")], SCHEMA)          # February emptied
    b = bucket_start("create_iodt", 31, from_string=True)
    target, ledger = scratch_table_path(spark, "t-target"), scratch_table_path(spark, "t-ledger")
    incremental_load(spark, old, target, ledger, b, "update_iodt", "pk")
    diff = incremental_load(spark, new, target, ledger, b, "update_iodt", "pk")
    assert rows(diff.where("changed"), "bucket", "src_row_count") == [("202402", None)]
    assert rows(spark.read.parquet(target).select("pk")) == [(1,)]       # a plain read
    assert rows(read_landed(spark, target, ledger).select("pk")) == [(1,)]


def test_reader_helpers(spark):
    from quayside.sources.readers import feed_stream, key_range_partitions
    assert key_range_partitions(0, 3_999_999, 2_000_000) == 2
    assert key_range_partitions(1, 4_000_001, 4_000_000) == 2
    assert key_range_partitions(5, 5, 2_000_000) == 1
    path = scratch_table_path(spark, "t-feed-read")
    spark.range(3).write.parquet(path)
    s = feed_stream(spark, fmt="parquet", schema="id long", path=path)
    assert s.isStreaming


def test_malformed_time_rows_still_land(spark):
    """A NULL bucket (malformed create time) is reloaded like any other."""
    old = spark.createDataFrame([(1, "20240105", "a")], SCHEMA)
    new = spark.createDataFrame([(1, "20240105", "a"), (2, "garbage", "b"), (3, None, "c")], SCHEMA)
    b = bucket_start("create_iodt", 31, from_string=True)
    target, ledger = scratch_table_path(spark, "t-target"), scratch_table_path(spark, "t-ledger")
    incremental_load(spark, old, target, ledger, b, "update_iodt", "pk")
    diff = incremental_load(spark, new, target, ledger, b, "update_iodt", "pk")
    assert rows(diff.where("changed"), "bucket") == [(None,)]
    assert rows(spark.read.parquet(target).select("pk")) == [(1,), (2,), (3,)]
    assert rows(read_landed(spark, target, ledger).select("pk")) == [(1,), (2,), (3,)]
    again = incremental_load(spark, new, target, ledger, b, "update_iodt", "pk")
    assert again.where("changed").count() == 0


def test_second_snapshot_replaces_the_first(spark):
    schema = "id long, part string"
    path = scratch_table_path(spark, "t-snap-again")
    snapshot_load(spark.createDataFrame([(1, "01"), (2, "02")], schema), path, partition_by=["part"])
    snapshot_load(spark.createDataFrame([(1, "01")], schema), path, partition_by=["part"])
    assert rows(spark.read.parquet(path), "id") == [(1,)]


def test_unreadable_ledger_fails_the_load(spark):
    import os
    import pytest
    df = spark.createDataFrame([(1, "20240105", "a")], SCHEMA)
    target, ledger = scratch_table_path(spark, "t-target"), scratch_table_path(spark, "t-ledger")
    b = bucket_start("create_iodt", 31, from_string=True)
    incremental_load(spark, df, target, ledger, b, "update_iodt", "pk")
    folder = ledger.replace("file://", "")
    for n in os.listdir(folder):
        if n.startswith("part-") or n.endswith(".crc"):
            with open(f"{folder}/{n}", "wb") as f:
                f.write(b"broken")
    with pytest.raises(Exception):
        incremental_load(spark, df, target, ledger, b, "update_iodt", "pk")
