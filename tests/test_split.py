"""Episodes cut at intervals in one scan: no row a bucket of time, no join by range."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ticktide.operators import intervals, scan
from ticktide.operators.scan import Ranges
from ticktide.plans import tape_queries

EPISODES, INTERVALS = "m string, fp long, start long, end long, censored boolean", "m string, start_ns long, end_ns long, verdict string"


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns or df.columns).collect()), key=str)


def brute(episodes, spans):
    out = []
    for m, fp, s, e, censored in episodes:
        met = [(max(s, a), min(e, b), v) for k, a, b, v in spans if k is not None and k == m and max(s, a) < min(e, b)]
        out += [(m, fp, a, b, censored and b == e, v) for a, b, v in met] or [(m, fp, s, e, censored, None)]
    return sorted(out, key=str)


def disjoint(key, seed, n, gap):
    at, out = seed, []
    for i in range(n):
        at += (i * seed) % gap
        out.append((key, at, at := at + 1 + (i * 7 + seed) % 11))
    return out


@pytest.mark.parametrize("few", [scan.FEW, 0])
def test_pieces_are_those_of_a_range_join(spark, monkeypatch, few):
    monkeypatch.setattr(scan, "FEW", few)
    keys = ["hot"] + [f"k{i}" for i in range(8)] + [None]
    episodes = [(k, i % 4, s, e, False) for j, key in enumerate(keys) for i, (k, s, e) in enumerate(disjoint(key, j + 3, 400 if key == "hot" else 12, 5))]
    spans = [(k, s, e, "TRUSTED" if i % 3 else "UNKNOWN") for j, key in enumerate(keys[:-2] + [None]) for i, (k, s, e) in enumerate(disjoint(key, j + 2, 300 if key == "hot" else 6, 9))]
    episodes.append(("hot", 9, max(e for *_, e, _ in episodes), 10**6, True))
    spans.append(("hot", max(e for _, _, e, _ in spans), 10**12, "UNTRUSTED"))  # open to the far end
    ep, iv = spark.createDataFrame(episodes, EPISODES), spark.createDataFrame(spans, INTERVALS)
    assert rows(intervals.split_by_intervals(ep, iv, "m", "verdict", disjoint=True)) == brute(episodes, spans)


def test_overlaps_are_an_error_in_order_and_pieces_by_join(spark):
    ep = spark.createDataFrame([("m", 1, 0, 20, True), ("m", 2, 10, 30, False)], EPISODES)
    iv = spark.createDataFrame([("m", 5, 12, "TRUSTED")], INTERVALS)
    assert rows(intervals.split_by_intervals(ep, iv, "m", "verdict", 4), "fp", "start", "end") == [(1, 5, 12), (2, 10, 12)]
    with pytest.raises(Exception, match="overlap"):
        intervals.split_by_intervals(ep, iv, "m", "verdict", disjoint=True).collect()


def test_the_query_makes_no_rows_a_bucket(spark, sf):
    plan = tape_queries.episode_split(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(" not in plan and "Generate" not in plan


def test_rows_of_one_time_are_in_the_order_of_their_ties(spark):
    t = spark.createDataFrame([("a", 5, i, (i // 3) % 2) for i in (4, 1, 5, 0, 3, 2)] + [("a", 9, 6, None), ("a", 12, 7, None), (None, 1, 8, 0), (None, 4, 9, 0)], "k string, at long, id long, fp int")
    got = rows(intervals.depth_episodes(t, ["k"], "at", "fp", F.max("at") + 10, ["id"]))
    assert got == [("a", 1, 5, 9, False), ("a", None, 12, 22, True), ("a", None, 9, 12, False), (None, 0, 1, 14, True)]


def test_small_keys_are_windows_and_large_ones_are_dealt(spark, monkeypatch):
    df = spark.range(3000).select((F.col("id") % 60).alias("k"), (F.col("id") * 7919 % 3001).alias("at"), F.when(F.col("id") % 5 == 0, F.col("id") % 7).alias("v"))
    scans = {kind: (kind, F.col("v")) for kind in scan.KINDS}
    small = Ranges(df, ["k"], ["at"], partitions=16).add(**scans)
    assert small.whole and "_part" not in small.df.columns
    monkeypatch.setattr(scan, "FEW", 0)
    dealt = Ranges(df.withColumn("k", F.lit(1)), ["k"], ["at"], partitions=16)
    assert not dealt.whole and dealt.df.select("_part").distinct().count() == 16
    assert Ranges(df, ["k"], ["at"], partitions=16).whole  # 50 rows of 3000, a task's share is 187
    w = Window.partitionBy("k").orderBy("at")
    upto, before = (w.rowsBetween(Window.unboundedPreceding, x) for x in (0, -1))
    want = df.withColumns({
        "previous": F.lag("v").over(w), "next": F.lead("v").over(w), "last": F.last("v", True).over(upto), "last_before": F.last("v", True).over(before),
        "first_after": F.first("v", True).over(w.rowsBetween(1, Window.unboundedFollowing)), "max": F.max("v").over(upto), "max_before": F.max("v").over(before), "sum": F.sum("v").over(upto),
    })
    columns = ("k", "at", *scan.KINDS)
    assert rows(small.rows(), *columns) == rows(want, *columns)


def test_edges_of_one_time_begin_no_segment_in_a_hot_market(spark, monkeypatch):
    verdicts = ("TRUSTED", "UNTRUSTED", "UNKNOWN")
    spans = [("hot" if a < 3 else f"m{a}", f"a{a}", t * 4, t * 4 + 4, verdicts[(t // 3 + a) % 3]) for a in range(6) for t in range(80)]
    iv = spark.createDataFrame(spans, "m string, a string, s long, e long, v string")
    whole = rows(intervals.combined_verdict(iv, "m", "a", "s", "e", "v"))
    monkeypatch.setattr(scan, "FEW", 0)
    assert rows(intervals.combined_verdict(iv, "m", "a", "s", "e", "v")) == whole
    worst = {}
    for m, _, s, _, v in spans:
        worst[m, s] = max(worst.get((m, s), 0), intervals.SEVERITY[v])
    at = {(m, t): intervals.SEVERITY[v] for m, v, s, e in whole for t in range(s, e, 4)}
    assert at == worst and all(s < e for *_, s, e in whole)
