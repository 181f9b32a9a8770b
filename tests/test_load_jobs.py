"""Load and refresh jobs over a catalogue, with catalog tables of a named database."""

import json

from quayside.plans import load_jobs as J
from quayside.sinks.state import StateTable
from quayside.sources.landing import scratch_table_path
from quayside.sources.tables import catalog_tables
from quayside.streaming.refresh import live_rows, read_state, start_position, state_schema
from tests.conftest import rows

CATALOGUE = json.dumps({
    "orders": {"source": "ops_orders", "key": "id", "update": "upd", "bucket": {"kind": "time", "column": "cre", "days": 31, "text": True},
               "payload": ["v"], "buckets": 4},
    "items": {"source": "ops_orders", "key": "id", "update": "upd", "bucket": {"kind": "range", "size": 10}},
})
SCHEMA = "id long, cre string, upd timestamp, v string"


def _fill(spark, data):
    import datetime as dt
    made = spark.createDataFrame([(i, c, dt.datetime(2024, 1, d), v) for i, c, d, v in data], SCHEMA)
    spark.sql("CREATE DATABASE IF NOT EXISTS src_db")
    made.createOrReplaceTempView("filled")
    spark.sql("DROP TABLE IF EXISTS src_db.ops_orders")
    spark.sql("CREATE TABLE src_db.ops_orders USING parquet AS SELECT * FROM filled")
    return catalog_tables(spark, "src_db")


def test_jobs_over_a_catalogue(spark):
    path = scratch_table_path(spark, "catalogue")
    spark.createDataFrame([(CATALOGUE,)], "value string").coalesce(1).write.text(path)
    spec = J.read_catalogue(spark, path)
    target, ranges, state = (scratch_table_path(spark, k) for k in ("job-target", "job-ranges", "job-state"))
    tables = _fill(spark, [(1, "20240105", 5, "a"), (12, "20240210", 6, "b"), (-3, "20240310", 7, "c")])
    J.snapshot(spec["orders"], tables, scratch_table_path(spark, "job-snap"), partitioned=True)
    J.load(spec["orders"], tables, target)
    J.load(spec["items"], tables, ranges)
    assert rows(J.landed(spark, target), "id") == [(-3,), (1,), (12,)]
    J.bootstrap(spec["orders"], tables, state, position="p-1")
    assert start_position(spark, state, 4) == "p-1"
    tables = _fill(spark, [(1, "20240105", 9, "a2"), (12, "20240210", 6, "b")])      # March is gone
    J.load(spec["orders"], tables, target)
    diff = J.load(spec["items"], tables, ranges)
    assert rows(J.landed(spark, target), "id", "v") == [(1, "a2"), (12, "b")]
    assert rows(J.landed(spark, ranges), "id", "bucket") == [(1, 0), (12, 1)]
    assert rows(diff.where("changed"), "bucket") == [(-1,), (0,)]

    import datetime as dt
    feed = scratch_table_path(spark, "job-feed")
    changes = spark.createDataFrame([(12, None, "D", dt.datetime(2024, 1, 8), 1), (1, "old", "U", dt.datetime(2024, 1, 1), 2),
                                     (7, "new", "I", dt.datetime(2024, 1, 8), 3)],
                                    "id long, v string, op string, change_ts timestamp, seq long")
    changes.write.parquet(feed)
    stream = spark.readStream.schema(changes.schema).parquet(feed)
    J.refresh(spec["orders"], stream, state, scratch_table_path(spark, "job-ckpt")).awaitTermination()
    f = spec["orders"].feed
    got = live_rows(read_state(spark, state, state_schema(changes, f), 4), f)
    assert rows(got, "id", "v") == [(-3, "c"), (1, "a"), (7, "new")]
    assert StateTable(spark, state, 4).latest().position == "p-1"
    spark.sql("DROP TABLE src_db.ops_orders")


def test_positions_of_a_feed_through_the_jobs(spark):
    """Positions are recorded before the load; the refresh starts there; the state is re-dealt and cleared of old versions."""
    import datetime as dt
    spec = J.parse_catalogue(json.dumps({"orders": {"source": "ops_orders", "key": "id", "update": "upd", "payload": ["v"],
                                                    "bucket": {"kind": "month", "column": "upd"}, "part": "p", "offset": "o"}}))["orders"]
    tables = _fill(spark, [(1, "20240105", 5, "a"), (2, "20240210", 6, "b")])
    state, snap, feed = (scratch_table_path(spark, k) for k in ("job-state", "job-snap", "job-feed"))
    schema = "id long, v string, op string, change_ts timestamp, seq long, p int, o long"
    spark.createDataFrame([(1, "a", "U", dt.datetime(2024, 1, 5), 1, 0, 41)], schema).write.parquet(feed)
    old = spark.read.schema(schema).parquet(feed)
    J.snapshot(spec, tables, snap, feed=old)
    J.bootstrap(spec, tables, state, feed=old)
    assert [tuple(r)[:2] for r in spark.read.parquet(f"{snap}_positions").collect()] == [("0", 42)]
    assert StateTable(spark, state).latest().positions == {"0": 42} and StateTable(spark, state).buckets == 1
    new = [(1, "never", "U", dt.datetime(2024, 3, 1), 2, 0, 41), (2, None, "D", dt.datetime(2024, 3, 1), 3, 0, 42), (3, "c", "I", dt.datetime(2024, 1, 1), 4, 1, 0)]
    spark.createDataFrame(new, schema).write.mode("append").parquet(feed)
    J.refresh(spec, spark.readStream.schema(schema).parquet(feed), state, scratch_table_path(spark, "job-ckpt")).awaitTermination()
    f = spec.feed
    live = lambda: rows(live_rows(read_state(spark, state, state_schema(old, f)), f), "id", "v")
    assert live() == [(1, "a"), (3, "c")] and StateTable(spark, state).latest().positions == {"0": 43, "1": 1}
    J.redeal(spec, spark, state, old)
    assert live() == [(1, "a"), (3, "c")]
    J.vacuum(spark, state, keep=1)
    assert live() == [(1, "a"), (3, "c")] and len(StateTable(spark, state).commits.numbers()) == 1
    path = scratch_table_path(spark, "job-landed")
    for _ in range(2):
        J.load(spec, tables, path)
    J.vacuum(spark, path, keep=1)
    assert rows(J.landed(spark, path), "id", "bucket") == [(1, "202401"), (2, "202401")]
