"""One commit for several tables, also after a crash; records forgotten with time; windows at their deadline."""

import pytest
from pyspark.sql import functions as F

from ticktide.plans.stream_queries import arriving, drained, scratch
from ticktide.streaming import commits, sessions, windows


def test_a_crash_between_writes_leaves_nothing_and_numbers_go_on(spark):
    rows = [(i, i // 2, f"r{i // 2 if i % 20 != 5 else 'other'}", 0 if i < 30 else 1 if i < 60 else 2) for i in range(90)]
    table = spark.createDataFrame(rows, "seq long, record long, content string, _part int")
    store, source, checkpoint = commits.TableSet(spark, scratch(spark)), scratch(spark), scratch(spark)
    crashes = []

    def crash_once(name):
        if name == "identity" and store.last_seq() > 0 and not crashes:
            crashes.append(name)
            raise RuntimeError("between two writes")

    def run():
        stream = spark.readStream.schema("seq long, record long, content string").parquet(source)
        windows.to_tables(stream, lambda b, no: commits.canonical_batch(store, b, no, "record", "content", "seq", ["seq"], crash_once), checkpoint)

    for part in range(3):
        table.where(F.col("_part") == part).drop("_part").write.mode("append").parquet(source)
        before = store.read("facts").count() if part else 0
        if part == 1:
            with pytest.raises(Exception, match="between two writes"):
                run()
            assert store.read("facts").count() == before and store.read("identity").count() == before  # facts of the batch are written, but not seen
        run()
    facts = [tuple(r) for r in store.read("facts").select("canonical_seq", "record", "seq").orderBy("canonical_seq").collect()]
    assert crashes and facts == [(i + 1, i, 2 * i) for i in range(45)]
    verdicts = {r.seq: r.verdict for r in store.read("repeats").collect()}
    assert len(verdicts) == 45 and {s for s, v in verdicts.items() if v == "conflict"} == {5, 25, 45, 65, 85}
    run()  # nothing new
    assert store.read("facts").count() == 45 and store.last_seq() == 45


def test_committed_batches_are_left_alone(spark):
    store = commits.TableSet(spark, scratch(spark))
    batch = spark.createDataFrame([(1, 7, "a"), (2, 7, "b")], "seq long, record long, content string")
    for _ in range(2):
        commits.canonical_batch(store, batch, 0, "record", "content", "seq", ["seq"])
    assert [tuple(r) for r in store.read("facts").select("canonical_seq", "record").collect()] == [(1, 7)] and store.last_seq() == 1
    commits.canonical_batch(store, batch.limit(0), 1, "record", "content", "seq", ["seq"])
    assert store.last_seq() == 1 and store.commits().count() == 2


def day(n, hour=0):
    return f"2024-01-{n:02d} {hour:02d}:00:00"


def test_records_are_forgotten_after_their_time(spark):
    windows.use_rocksdb(spark)
    rows = [
        (1, 1, day(1), 5, "x", 1, 0), (1, 2, day(1, 1), 6, "y", 2, 0),
        (1, 3, day(2), 5, "x", 3, 1), (1, 4, day(2, 1), 6, "z", 3, 1), (1, 5, day(4), 7, "w", 3, 1),
        (1, 6, day(9), 8, "v", 4, 2), (1, 7, day(9, 1), 9, "v", 5, 3), (1, 8, day(9, 2), 5, "x", 6, 3),
    ]
    table = spark.createDataFrame(rows, "epoch long, seq long, at string, record long, content string, counter long, _part int")
    table = table.withColumns({"at": F.to_timestamp("at"), "kind": F.lit("range"), "first": F.col("counter"), "last": F.col("counter"), "previous": F.col("counter") - 1})
    out = []
    arriving(table, 4, lambda s, path: out.append(drained(sessions.deliveries(s, "1 hour", 3 * 86_400_000), path=path)))
    got = {r.seq: (r.verdict, r.cause, r.health) for r in out[-1].collect()}
    assert [got[i][0] for i in range(1, 9)] == ["unseen", "unseen", "duplicate", "conflict", "unseen", "unseen", "unseen", "unseen"]
    assert got[1][1] == "bootstrap" and got[3][1] is None and got[5][1] == "continuous" and got[8][2] == "healthy"


def test_a_window_without_a_lane_closes_at_its_deadline_and_holds_up_later_ones(spark):
    windows.use_rocksdb(spark)
    minute = 60_000_000
    rows = [("t", "a", 0, 0), ("t", "b", 0, 0), ("t", "a", 1, 0), ("t", "a", 2, 1), ("t", "b", 2, 1), ("t", "a", 3, 1), ("t", "b", 3, 1), ("t", "a", 6, 2), ("t", "b", 6, 2)]
    table = spark.createDataFrame(rows, "tape string, lane string, w long, _part int").withColumn("window_start", (F.col("w") + 1000) * minute)
    table = table.withColumn("at", F.timestamp_micros("window_start")).drop("w")
    seen = []
    arriving(table, 3, lambda s, path: seen.append({(r.window_start // minute - 1000, r.valid_lanes, r.state) for r in drained(sessions.committed_windows(s, 2, minute, 3 * minute), path=path).collect()}))
    assert seen[0] == {(0, 2, "complete")} and seen[1] == seen[0]  # window 1 waits for lane b, so 2 and 3 don't commit
    assert seen[2] == {(0, 2, "complete"), (1, 1, "incomplete"), (2, 2, "complete"), (3, 2, "complete")}
