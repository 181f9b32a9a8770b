"""ST1: keyed change-feed refresh — deletes, late data, replay, batch splits."""

import datetime as dt
import os

import pytest

from quayside.sinks.state import StateTable, buckets_for
from quayside.sources.landing import scratch_table_path
from quayside.streaming.refresh import (Feed, apply_changes, bootstrap_state, feed_positions, from_start, live_rows, read_state,
                                        refresh_state, refresh_stream, start_position, state_schema, stream_start)
from pyspark.sql import functions as F
from tests.conftest import rows

FEED = Feed(pk="pk", payload=("v",))
SCHEMA = "pk string, v string, change_ts timestamp, seq long, op string"


def _t(h):
    return dt.datetime(2024, 1, 1, h)


def _changes(spark):
    return spark.createDataFrame([
        ("k1", "a", _t(1), 1, "I"), ("k1", "b", _t(2), 2, "U"), ("k1", "c", _t(3), 3, "U"),
        ("k1", None, _t(4), 4, "D"), ("k1", "late", _t(2), 5, "U"),        # late, older update
        ("k2", "x", _t(1), 6, "I"), ("k2", "y", _t(5), 7, "U"),
        ("k3", "p", _t(2), 8, "I"), ("k3", None, _t(3), 9, "D"), ("k3", "q", _t(6), 10, "I"),
    ], SCHEMA)


def test_single_batch(spark):
    out = live_rows(apply_changes(None, _changes(spark), FEED), FEED)
    assert rows(out, "pk", "v") == [("k2", "y"), ("k3", "q")]


def test_split_and_replay_give_same_state(spark):
    ch = _changes(spark)
    one = rows(apply_changes(None, ch, FEED))
    # k batches in arbitrary order, one replayed
    parts = [ch.where(F.col("seq") % 3 == i) for i in range(3)]
    state = None
    for p in [parts[2], parts[0], parts[2], parts[1]]:
        state = apply_changes(state, p, FEED)
    assert rows(state) == one


def test_late_update_does_not_resurrect_delete(spark):
    ch = _changes(spark)
    s1 = apply_changes(None, ch.where("seq <= 4"), FEED)
    s2 = apply_changes(s1, ch.where("seq = 5"), FEED)
    assert rows(live_rows(s2, FEED), "pk") == []


def _state(spark, path, changes=None):
    return read_state(spark, path, state_schema(_changes(spark) if changes is None else changes, FEED), 4)


def test_refresh_on_files(spark):
    path = scratch_table_path(spark, "test-state")
    ch = _changes(spark)
    for part in (ch.where("seq <= 5"), ch.where("seq > 5"), ch.where("seq > 5")):
        refresh_state(spark, path, part, FEED, buckets=4)
    assert rows(live_rows(_state(spark, path), FEED), "pk", "v") == [("k2", "y"), ("k3", "q")]


def test_stream_restart_resumes_from_checkpoint(spark):
    """ST5: a second availableNow run with the same checkpoint reads only the
    new feed files; the state equals one batch over everything."""
    from quayside.sinks.tables import write_table
    from quayside.streaming.refresh import refresh_stream
    ch = _changes(spark)
    feed_dir = scratch_table_path(spark, "t-feed")
    state = scratch_table_path(spark, "t-state")
    ckpt = scratch_table_path(spark, "t-ckpt")
    write_table(ch.where("seq <= 5"), feed_dir + "/part1", num_files=2)
    stream = spark.readStream.schema(ch.schema).parquet(feed_dir + "/*")
    refresh_stream(spark, stream, state, ckpt, FEED, buckets=4).awaitTermination()
    write_table(ch.where("seq > 5"), feed_dir + "/part2", num_files=2)
    stream = spark.readStream.schema(ch.schema).parquet(feed_dir + "/*")
    q = refresh_stream(spark, stream, state, ckpt, FEED, buckets=4)
    q.awaitTermination()
    assert sum(p["numInputRows"] for p in q.recentProgress) == ch.where("seq > 5").count()
    assert rows(_state(spark, state)) == rows(apply_changes(None, ch, FEED))


def test_only_touched_buckets_are_rewritten(spark):
    path = scratch_table_path(spark, "t-touched")
    ch = _changes(spark)
    refresh_state(spark, path, ch, FEED, buckets=64)
    first = StateTable(spark, path, 64).latest().where
    refresh_state(spark, path, ch.where("pk = 'k2'"), FEED, buckets=64)
    second = StateTable(spark, path, 64).latest().where
    moved = [b for b in second if second[b] != first.get(b)]
    assert len(moved) == 1 and set(first) == set(second)


def test_null_keys_and_operations(spark):
    schema = "pk string, v string, change_ts timestamp, seq long, op string"
    path = scratch_table_path(spark, "t-null")
    b1 = spark.createDataFrame([(None, "a", _t(1), 1, None), ("x", "c", _t(1), 3, None)], schema)
    b2 = spark.createDataFrame([(None, "a2", _t(2), 4, "U")], schema)
    refresh_state(spark, path, b1, FEED, buckets=4)
    refresh_state(spark, path, b2, FEED, buckets=4)
    assert rows(live_rows(_state(spark, path), FEED), "pk", "v") == [("x", "c"), (None, "a2")]


def test_unreadable_state_fails_the_batch(spark):
    path = scratch_table_path(spark, "t-unreadable")
    ch = _changes(spark)
    refresh_state(spark, path, ch, FEED, buckets=1, batch_id=0)
    version = StateTable(spark, path, 1).latest().where[0]
    folder = f"{path}/data/{version}/bucket=0".replace("file://", "")
    name = next(n for n in os.listdir(folder) if n.startswith("part-"))
    with open(f"{folder}/{name}", "wb") as f:
        f.write(b"no parquet")
    crc = f"{folder}/.{name}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    with pytest.raises(Exception):
        refresh_state(spark, path, ch.where("pk = 'k1'"), FEED, buckets=1, batch_id=1)
    assert StateTable(spark, path, 1).latest().batch_id == 0


def test_bootstrap_again_replaces_the_state(spark):
    path = scratch_table_path(spark, "t-boot")
    schema = "pk string, v string, change_ts timestamp, seq long"
    bootstrap_state(spark, path, spark.createDataFrame([("a1", "x", _t(1), 1), ("b1", "y", _t(1), 2)], schema), FEED,
                    buckets=4, position="offset-7")
    assert start_position(spark, path, 4) == "offset-7"
    bootstrap_state(spark, path, spark.createDataFrame([("a1", "x", _t(1), 1)], schema), FEED, buckets=4)
    assert rows(_state(spark, path), "pk") == [("a1",)]


def test_replayed_batches_are_skipped_and_old_versions_go(spark):
    path = scratch_table_path(spark, "t-replay")
    ch = _changes(spark)
    assert refresh_state(spark, path, ch.where("seq <= 5"), FEED, batch_id=0, buckets=4)
    assert not refresh_state(spark, path, ch.where("seq <= 5"), FEED, batch_id=0, buckets=4)
    assert refresh_state(spark, path, ch.where("seq > 5"), FEED, batch_id=1, buckets=4)
    want = rows(apply_changes(None, ch, FEED))
    assert rows(_state(spark, path)) == want
    StateTable(spark, path, 4).vacuum(keep=1)
    assert rows(_state(spark, path)) == want


def test_old_tombstones_are_purged(spark):
    path = scratch_table_path(spark, "t-purge")
    ch = _changes(spark)
    refresh_state(spark, path, ch, FEED, buckets=1)
    assert rows(_state(spark, path).where("is_deleted"), "pk") == [("k1",)]
    refresh_state(spark, path, ch.where("pk = 'k2'"), FEED, buckets=1, purge_before=_t(5))
    assert rows(_state(spark, path), "pk") == [("k2",), ("k3",)]


def test_text_buckets_land_and_reload(spark):
    """A bucket that looks like a number, then one that doesn't."""
    from quayside.sources.landing import incremental_load
    schema = "pk long, b string, u string"
    target, ledger = scratch_table_path(spark, "t-text"), scratch_table_path(spark, "t-textl")
    old = spark.createDataFrame([(1, "1", "a")], schema)
    new = spark.createDataFrame([(1, "1", "a"), (2, "A/b", "a")], schema)
    incremental_load(spark, old, target, ledger, F.col("b"), "u", "pk")
    incremental_load(spark, new, target, ledger, F.col("b"), "u", "pk")
    assert rows(spark.read.schema(schema + ", bucket string").parquet(target), "pk", "bucket") == [(1, "1"), (2, "A/b")]
    incremental_load(spark, old, target, ledger, F.col("b"), "u", "pk")
    assert rows(spark.read.schema(schema + ", bucket string").parquet(target), "pk", "bucket") == [(1, "1")]


def _drain(spark, folder, schema, state, ckpt, feed=FEED, **kw):
    q = refresh_stream(spark, spark.readStream.schema(schema).parquet(folder), state, ckpt, feed, **kw)
    q.awaitTermination()
    return q


def test_a_new_checkpoint_is_another_stream(spark):
    """Its batch numbers start again at 0 and are applied all the same."""
    ch = _changes(spark)
    state, folder = scratch_table_path(spark, "t-state"), scratch_table_path(spark, "t-feed")
    for part in ("seq <= 5", "seq > 5"):
        ch.where(part).coalesce(1).write.mode("append").parquet(folder)
        q = _drain(spark, folder, ch.schema, state, scratch_table_path(spark, "t-ckpt"), buckets=4)
        assert StateTable(spark, state).latest().batch(str(q.id)) == 0
    assert rows(_state(spark, state)) == rows(apply_changes(None, ch, FEED))
    assert len(StateTable(spark, state).latest().streams) == 2
    assert refresh_state(spark, state, ch, FEED, batch_id=0)            # batches without a stream have numbers of their own
    assert not refresh_state(spark, state, ch, FEED, batch_id=0)


PLACED = Feed(pk="pk", payload=("v",), part="part", offset="at")


def _placed(spark, data):
    return spark.createDataFrame(data, SCHEMA + ", part string, at long")


def test_an_old_backlog_is_applied_whole(spark):
    """The stream stands still longer than the lookback; what came in the
    meantime is applied, though it is years old by the wall clock."""
    schema = "pk string, v string, change_ts timestamp, seq long"
    state, folder, ckpt = (scratch_table_path(spark, f"t-{x}") for x in ("state", "feed", "ckpt"))
    bootstrap_state(spark, state, spark.createDataFrame([("k9", "s", _t(1), 0)], schema), FEED, taken_at=_t(6))
    new = [("old", "x", dt.datetime(2023, 12, 1), 1, "U"), ("k1", "a", _t(5), 2, "U")]
    later = [("k2", "b", _t(5), 3, "U"), ("late", "y", dt.datetime(2023, 12, 31), 4, "U")]
    for data in (new, later):
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        _drain(spark, folder, SCHEMA, state, ckpt, lookback_minutes=-4320)
    # 'old' lies before the start, three days before the snapshot; 'late' doesn't
    assert rows(_state(spark, state), "pk") == [("k1",), ("k2",), ("k9",), ("late",)]
    without = scratch_table_path(spark, "t-state")                      # no snapshot covers anything: the whole feed
    _drain(spark, folder, SCHEMA, without, scratch_table_path(spark, "t-ckpt"), lookback_minutes=-4320)
    assert rows(_state(spark, without), "pk") == [("k1",), ("k2",), ("late",), ("old",)]


def test_a_stream_starts_at_the_stored_positions(spark):
    state, folder = scratch_table_path(spark, "t-state"), scratch_table_path(spark, "t-feed")
    first = _placed(spark, [("a", "1", _t(1), 1, "U", "p", 10), ("b", "1", _t(1), 2, "U", "q", 7)])
    assert feed_positions(first, PLACED) == {"p": 11, "q": 8}
    refresh_state(spark, state, first, PLACED, batch_id=0)
    more = _placed(spark, [("a", "dropped", _t(9), 3, "U", "p", 10),    # before the position: not read again
                           ("a", "2", _t(2), 4, "U", "p", 11), ("c", "1", _t(1), 5, "U", "r", 0), ("d", "1", _t(1), 6, "U", None, None)])
    more.coalesce(1).write.parquet(folder)
    ckpt = scratch_table_path(spark, "t-ckpt")
    q = _drain(spark, folder, more.schema, state, ckpt, PLACED)
    assert rows(read_state(spark, state, state_schema(more, PLACED)), "pk", "v") == [("a", "2"), ("b", "1"), ("c", "1"), ("d", "1")]
    commit = StateTable(spark, state).latest()
    assert commit.positions == {"p": 12, "q": 8, "r": 1}
    assert commit.streams[str(q.id)]["start"]["positions"] == {"p": 11, "q": 8}
    # the same stream goes on from where it began, not from the later positions
    _placed(spark, [("c", "2", _t(3), 7, "U", "r", 0)]).coalesce(1).write.mode("append").parquet(folder)
    _drain(spark, folder, more.schema, state, ckpt, PLACED)
    assert ("c", "2") in rows(read_state(spark, state, state_schema(more, PLACED)), "pk", "v")


def test_starts(spark):
    assert stream_start(None, 60) is None
    df = _placed(spark, [("k", "v", _t(h), h, "U", p, h) for h in (1, 5) for p in ("p", "q", None)])
    count = lambda start: df.where(from_start(PLACED, start)).count()
    assert count(None) == 6
    assert count({"positions": {"p": 5}, "since": None}) == 5
    assert count({"positions": {"p": 5, "q": 5}, "since": None}) == 4
    assert count({"positions": {"p": 9, "q": 9}, "since": _t(5).isoformat()}) == 4
    assert count({"positions": {}, "since": _t(5).isoformat()}) == 3


def test_ledger_of_positions(spark):
    from quayside.sources.positions import kafka_offsets, read_positions, record_positions
    path = scratch_table_path(spark, "t-positions")
    changes = _placed(spark, [("a", "1", _t(1), 1, "U", "10", 41), ("b", "1", _t(1), 2, "U", "2", 7)])
    assert record_positions(spark, path, changes, PLACED) == read_positions(spark, path) == {"10": 42, "2": 8}
    assert kafka_offsets("t", read_positions(spark, path)) == '{"t": {"2": 8, "10": 42}}'
    record_positions(spark, path, changes.where("part = '2'"), PLACED)
    assert read_positions(spark, path) == {"2": 8}


def test_redeal_between_two_batches(spark):
    path, ch = scratch_table_path(spark, "t-redeal"), _changes(spark)
    schema = state_schema(ch, FEED)
    refresh_state(spark, path, ch.where("seq <= 8"), FEED, batch_id=0, stream="s", buckets=1)
    before = rows(_state(spark, path))
    now = StateTable(spark, path).redeal(schema, FEED.pk, 8)
    assert now.buckets == 8 and len(now.where) > 1 and now.batch("s") == 0 and rows(_state(spark, path)) == before
    assert not refresh_state(spark, path, ch.where("seq <= 8"), FEED, batch_id=0, stream="s", buckets=1)
    assert refresh_state(spark, path, ch.where("seq > 8"), FEED, batch_id=1, stream="s", buckets=1)
    assert StateTable(spark, path).latest().buckets == 8
    assert rows(_state(spark, path)) == rows(apply_changes(None, ch, FEED))
    assert StateTable(spark, path).redeal(schema, FEED.pk).buckets == 1               # as many as its size needs
    assert [buckets_for(n) for n in (0, 1, 2_000_000, 2_000_001, 10**11)] == [1, 1, 1, 2, 50_000]
