"""Operators on literal cases with known answers."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ticktide.functions import columns, text
from ticktide.operators import bars, baskets, intervals, ladder, matching, omega, order
from ticktide.streaming import windows


def rows(df, *by):
    return [tuple(r) for r in (df.orderBy(*by) if by else df).collect()]


def levels(spark, data):
    return spark.createDataFrame(data, "key string, price double, size double")


# ---- ladders


def test_ladder_exact_and_partial(spark):
    lv = levels(spark, [("a", 0.40, 5.0), ("a", 0.50, 5.0), ("b", 0.40, 5.0), ("c", 0.3, 0.0), ("c", 0.4, 20.0)])
    got = {r.key: r for r in ladder.walk(lv, ["key"], "price", "size", 10, ["size"]).collect()}
    assert got["a"].vwap == pytest.approx(0.45) and not got["a"].depth_limited
    assert got["b"].filled == 5 and got["b"].depth_limited
    assert got["c"].vwap == pytest.approx(0.4)


def test_array_walk_agrees_with_rows(spark):
    rng = random.Random(1)
    data = [(f"k{i % 7}", round(rng.random(), 3), float(rng.randint(0, 9))) for i in range(80)]
    lv = levels(spark, data)
    a = {r.key: r for r in ladder.walk(lv, ["key"], "price", "size", 20, ["size"]).collect()}
    arr = lv.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("price", "size"))).alias("l")).select("key", ladder.walk_array(F.col("l"), 20).alias("w")).collect()
    for r in arr:
        assert r.w.filled == pytest.approx(a[r.key].filled) and r.w.vwap == pytest.approx(a[r.key].vwap) and r.w.depth_limited == a[r.key].depth_limited


def test_cover_of_two_legs(spark):
    legs = spark.createDataFrame([("x", "A", 0.49), ("x", "B", 0.49), ("x", "B", 0.60), ("y", "A", 0.3)], "k string, o string, c double")
    got = {r.k: r for r in ladder.cover_cost(legs, ["k"], "o", "c", F.lit(2)).collect()}
    assert got["x"].cover_cost == pytest.approx(0.98) and got["x"].feasible
    assert got["y"].cover_cost is None and not got["y"].feasible


def test_fees(spark):
    df = spark.range(1).select(
        ladder.fee(F.lit(0.5), F.lit(100.0), 0.07).alias("f"), ladder.conservative_fee(F.lit(0.00011)).alias("c"), ladder.conservative_fee(F.lit(0.0002)).alias("e"),
        ladder.normal_fee(F.lit(0.00005), F.lit(False)).alias("half_even"), ladder.normal_fee(F.lit(0.00005), F.lit(True)).alias("up"), ladder.flat_leg_fee(F.lit("v"), F.lit(0.5), "w").alias("none"),
    )
    r = df.first()
    assert (r.f, r.c, r.e, r.half_even, r.up, r.none) == (pytest.approx(1.75), pytest.approx(0.0002), pytest.approx(0.0002), 0.0, pytest.approx(0.0001), 0.0)


def test_issues_and_complement(spark):
    kind = "array<struct<price:double,size:double>>"
    df = spark.createDataFrame([([(0.4, 1.0), (0.3, -1.0), (0.3, 2.0), (1.2, 1.0)],), ([(0.1, 1.0), (0.2, 1.0)],), ([],), ([(None, 1.0)],)], f"l {kind}")
    got = [r[0] for r in df.select(ladder.issues(F.col("l"))).collect()]
    assert got == [["duplicate_price", "negative_size", "price_out_of_bounds", "wrong_order"], [], [], ["invalid_level"]]
    two = spark.createDataFrame([([(0.4, 1.0), (0.7, 2.0)], [(0.3, 2.0), (0.6, 1.0)])], f"a {kind}, b {kind}")
    assert two.select(ladder.levels_match(F.col("a"), F.col("b"), 0.0, complemented=True)).first()[0]
    assert not two.select(ladder.levels_match(F.col("a"), F.col("b"), 0.0)).first()[0]


def test_price_matches(spark):
    df = spark.createDataFrame([(None, None), (0.5, None), (0.5, 0.505), (0.5, 0.52)], "a double, b double")
    assert [r[0] for r in df.select(ladder.price_matches(F.col("a"), F.col("b"), 0.01)).collect()] == [True, False, True, False]


def test_leg_timing_and_bands(spark):
    legs = spark.createDataFrame([("b", 100, 90, 500), ("b", 145, 140, 400)], "k string, rec long, src long, res long")
    r = ladder.leg_timing(legs, ["k"], "rec", "src", "res").first()
    assert (r.observed, r.skew, r.age, r.to_resolution) == (145, 45, 55, 255)
    got = spark.createDataFrame([(4.9,), (5.0,), (45.0,), (60.0,), (60.1,)], "s double").select(columns.skew_band(F.col("s"))).collect()
    assert [x[0] for x in got] == ["lt_5s", "5_to_15s", "15_to_60s", "15_to_60s", "gt_60s"]


# ---- order


def test_clock_choice(spark):
    base = "monotonic_ns long, comparable boolean, scope_id string"
    of = lambda data: order.clock_choice(spark.createDataFrame(data, base)).first()[0]
    assert of([(1, True, "s"), (2, True, "s")]) == "monotonic"
    assert of([(1, True, "s"), (None, True, "s")]) == "visible"
    assert of([(1, True, "s"), (2, True, "t")]) == "visible"


def test_counters_are_per_connection_not_per_stream(spark):
    tape = spark.createDataFrame([("e", "book", 1), ("e", "trade", 2), ("e", "book", 3), ("f", "book", 1), ("f", "book", 3)], "epoch string, stream string, n long")
    assert rows(order.dense_breaks(tape, ["epoch"], "n").select("epoch", "n")) == [("f", 3)]


def test_equal_versions_are_no_regression(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("a", 3, 4), ("a", 4, 6)], "k string, n long, v long")
    assert rows(order.version_regressions(df, ["k"], ["n"], "v").select("n", "v", "highest")) == [(3, 4, 5)]


def test_dense_sequence_does_not_depend_on_partitions(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"))
    a = rows(order.dense_sequence(df.repartition(9), ["x"], partitions=5), "x")
    assert a == rows(order.dense_sequence(df.coalesce(1), ["x"], partitions=3), "x") and [r[1] for r in a] == list(range(1, 1001))


def test_null_digest_resets(spark):
    df = spark.createDataFrame([("e", 1, "d1", True), ("e", 2, None, False), ("e", 3, None, True), ("e", 4, "x", False)], "k string, n long, d string, opened boolean")
    assert [r[-1] for r in rows(order.last_before(df, ["k"], ["n"], "d", F.col("opened"), "active"), "n")] == ["d1", "d1", None, None]


def test_lane_contiguity_passes_over_empty_segments(spark):
    seals = spark.createDataFrame([("l", 1, 1, 10), ("l", 2, None, None), ("l", 3, 11, 20), ("l", 4, 22, 30)], "lane string, n long, first long, last long")
    assert rows(order.lane_contiguity(seals, "lane", "n", "first", "last").select("n", "expected")) == [(4, 21)]


def test_integrity_and_domain_hash(spark):
    import hashlib

    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 4)], "v string, n long").withColumn("h", F.sha2("v", 256))
    assert tuple(order.integrity(df, "v", "h", "n").first()) == (0, False)
    got = df.where("v = 'a'").select(columns.domain_hash("dom", F.col("v"))).first()[0]
    assert got == hashlib.sha256(b"dom" + (1).to_bytes(8, "big") + b"a").hexdigest()


def test_merged_is_ordered(spark):
    a, b = spark.createDataFrame([(3, "a"), (1, "a")], "n long, l string"), spark.createDataFrame([(2, "b")], "n long, l string")
    assert [r[0] for r in order.merged([a, b], ["n"]).collect()] == [1, 2, 3]


# ---- bars, intervals


def test_bars_never_look_ahead(spark):
    df = spark.createDataFrame([("k", 61, 1.0), ("k", 119, 2.0), ("k", 300, 3.0)], "k string, t long, v double")
    got = rows(bars.bar_snapshots(df, ["k"], "t", 60, 90, ["v"], []).select("bar", "t", "v", "age"), "bar")
    assert got == [(120, 119, 2.0, 1), (180, 119, 2.0, 61), (300, 300, 3.0, 0), (360, 300, 3.0, 60)]


def test_exact_or_latest(spark):
    left = spark.createDataFrame([("d1", "a"), ("dX", "a"), ("d1", "z")], "digest string, asset string")
    cat = spark.createDataFrame([("d1", "a", 1), ("d2", "a", 2)], "digest string, asset string, v int")
    assert {(r.digest, r.asset, r.v) for r in bars.exact_or_latest(left, cat, ["asset"], "digest", ["v"]).collect()} == {("d1", "a", 1), ("dX", "a", 2), ("d1", "z", None)}


def test_common_bars(spark):
    legs = spark.createDataFrame([("b", "x"), ("b", "y")], "basket string, leg string")
    b = spark.createDataFrame([("x", 1), ("x", 2), ("y", 2), ("y", 3)], "leg string, bar long")
    assert rows(bars.common_bars(legs, b, "basket", "leg").select("bar").distinct()) == [(2,)]


def test_supporting_evidence_prefers_precedence(spark):
    a = spark.createDataFrame([("k", 100)], "key string, at long")
    e = spark.createDataFrame([("k", 100, 2), ("k", 140, 1), ("k", 900, 0)], "key string, seen long, p int")
    assert bars.supporting_evidence(a, e, ["key"], "at", "seen", "p", 60).select("p", "distance").first() == (1, 40)


def test_books_fold_like_a_loop(spark):
    rng = random.Random(7)
    for _ in range(6):
        data, state, live, want = [], {}, False, {}
        for pos in range(1, 60):
            if rng.random() < 0.15:
                batch = [(rng.randint(1, 5), rng.randint(0, 3)) for _ in range(rng.randint(1, 3))]
                batch = list(dict(batch).items())
                state, live, kind = {}, True, "book"
            else:
                batch, kind = [(rng.randint(1, 5), rng.randint(0, 3))], "delta"
            for price, size in batch:
                data.append(("a", pos, kind, "bid", float(price), float(size)))
                if live:
                    if size:
                        state[price] = size
                    else:
                        state.pop(price, None)
            if live and state:
                want[pos] = (len(state), float(sum(state.values())))
        df = spark.createDataFrame(data, "asset string, pos long, kind string, side string, price double, size double")
        lv = intervals.book_levels(df, "asset", "pos", "kind", "side", "price", "size")
        got = intervals.book_at(lv, df.select("asset", "pos").distinct(), "asset", "pos").groupBy("pos").agg(F.count(F.lit(1)), F.sum("size")).collect()
        assert {r[0]: (r[1], r[2]) for r in got} == want


def test_hash_run_and_anchor(spark):
    ev = spark.createDataFrame([("a", 1, "initial"), ("a", 2, "final"), ("a", 3, "final"), ("a", 4, None), ("a", 5, "final")], "asset string, pos long, h string")
    runs = intervals.hash_runs(ev, "asset", "pos", "h")
    assert [(r.h, r["first"], r["last"]) for r in runs.orderBy("first").collect()] == [("initial", 1, 1), ("final", 2, 3), ("final", 5, 5)]
    ends = runs.withColumn("book", F.when(F.col("last") == 3, "B").otherwise("C")).where("h = 'final'")
    anchors = spark.createDataFrame([("a", "final", "B", 9)], "asset string, h string, book string, seen_at long")
    assert [r.outcome for r in intervals.check_anchors(ends, anchors, "asset", "h", "book").orderBy("first").collect()] == ["match", "differ"]


def test_recovery_resets_the_book(spark):
    ev = [("a", 1, "book", "bid", 1.0, 5.0, "h1"), ("a", 2, "delta", "bid", 2.0, 3.0, "h2"), ("a", 3, "delta", "bid", 3.0, 1.0, "h2"), ("a", 4, "delta", "bid", 4.0, 9.0, "h3"), ("a", 5, "delta", "bid", 4.0, 8.0, "h4")]
    events = spark.createDataFrame(ev, "asset string, pos long, kind string, side string, price double, size double, h string")
    shots = [("a", "h2", "s1", 10, "bid", 7.0, 7.0), ("a", "h3", "s2", 11, "bid", 8.0, 1.0), ("a", "h3", "s3", 12, "bid", 8.0, 2.0)]
    anchors = spark.createDataFrame(shots, "asset string, h string, anchor string, seen_at long, side string, price double, size double")
    lv = intervals.book_levels(intervals.with_recoveries(events, anchors, "asset", "pos", "h"), "asset", "pos", "kind", "side", "price", "size")
    points = spark.createDataFrame([("a", p) for p in (4, 6, 7, 8, 10)], "asset string, pos long")
    got = {}
    for r in intervals.book_at(lv, points, "asset", "pos").collect():
        got.setdefault(r.pos, {})[r.price] = r.size
    assert got == {4: {1.0: 5.0, 2.0: 3.0}, 6: {1.0: 5.0, 2.0: 3.0, 3.0: 1.0}, 7: {7.0: 7.0}, 8: {7.0: 7.0, 4.0: 9.0}, 10: {7.0: 7.0, 4.0: 8.0}}


def test_trust_close_ends_the_interval(spark):
    s = spark.createDataFrame([("a", 10, 1, "open", "UNKNOWN"), ("a", 10, 2, "state", "TRUSTED"), ("a", 20, 1, "close", "TRUSTED"), ("a", 30, 1, "open", "UNKNOWN")], "a string, t long, p int, x string, v string")
    assert rows(intervals.trust_intervals(s, "a", "t", "p", "x", "v", 40), "start_ns") == [("a", 10, 20, "TRUSTED"), ("a", 30, 40, "UNKNOWN")]


def test_market_takes_the_worst_and_joins_neighbours(spark):
    iv = spark.createDataFrame([("m", "x", 0, 10, "TRUSTED"), ("m", "x", 10, 20, "TRUSTED"), ("m", "y", 0, 15, "TRUSTED"), ("m", "y", 15, 20, "UNTRUSTED"), ("m", "y", 20, 25, "TRUSTED")], "m string, a string, s long, e long, v string")
    assert rows(intervals.combined_verdict(iv, "m", "a", "s", "e", "v").select("start_ns", "end_ns", "v"), "start_ns") == [(0, 15, "TRUSTED"), (15, 20, "UNTRUSTED"), (20, 25, "UNKNOWN")]


@pytest.mark.parametrize("bucket", [None, 4, 1000])
def test_split_keeps_only_the_tail_censored(spark, bucket):
    ep = spark.createDataFrame([("m", 0, 20, True), ("m", 50, 60, False)], "m string, start long, end long, censored boolean")
    iv = spark.createDataFrame([("m", 0, 8, "TRUSTED"), ("m", 8, 40, "UNKNOWN")], "m string, start_ns long, end_ns long, verdict string")
    got = rows(intervals.split_by_intervals(ep, iv, "m", "verdict", bucket).select("start", "end", "censored", "verdict"), "start")
    assert got == [(0, 8, False, "TRUSTED"), (8, 20, True, "UNKNOWN"), (50, 60, False, None)]


def test_survival_needs_every_leg(spark):
    c = spark.createDataFrame([(1, 100), (2, 100)], "candidate long, at long")
    legs = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (2, "z")], "candidate long, leg string")
    ep = spark.createDataFrame([("x", 0, 201), ("y", 50, 205), ("z", 0, 100)], "leg string, start long, end long")
    assert rows(intervals.survival(c, legs, ep, 100), "candidate") == [(1, 100, 101, "SURVIVED_MINIMUM"), (2, 100, None, "NOT_HELD")]


def test_clusters_are_relative_to_their_first(spark):
    df = spark.createDataFrame([("k", t) for t in (0, 800, 1600, 2400)], "k string, t long")
    assert [r[0] for r in intervals.time_clusters(df, ["k"], "t", 900).orderBy("t").select("cluster_start").collect()] == [0, 0, 1600, 1600]


def test_nothing_present_is_not_zero(spark):
    df = spark.createDataFrame([("a", 5, 5, "TRUSTED")], "k string, s long, e long, v string")
    r = intervals.trusted_share(df, ["k"], "s", "e", "v").first()
    assert r.share is None and r.status == "NOT_PRESENT"


# ---- baskets, outcome spaces, matching


def test_exclusions_in_order(spark):
    data = [("a", 0.4, 0.01, 5.0), ("a", None, 0.01, 5.0), ("b", 0.4, None, 50.0), ("b", 0.4, 0.01, 5.0), ("c", 0.4, None, 50.0), ("c", 0.4, 0.01, 50.0), ("d", 0.4, 0.01, 50.0), ("d", 0.5, 0.02, 50.0)]
    legs = spark.createDataFrame(data, "k string, cost double, fee double, depth double").withColumn("size", F.lit(10))
    got = {r.k: r for r in baskets.measure(legs, ["k", "size"], F.lit(2), "cost", "fee", "fee", "depth", "size").collect()}
    assert [got[k].exclusion for k in "abcd"] == ["one_sided", "depth_limited", "fee_missing", None]
    assert got["d"].profit == pytest.approx(0.07)


def test_placebo_is_another_market(spark):
    rng = random.Random(3)
    data = [(i, "s", rng.randint(0, 4), rng.randint(0, 40), rng.randint(0, 9)) for i in range(60)]
    df = spark.createDataFrame(data, "id long, s string, m long, t long, v long")
    got = {r.id: (r.placebo_market, r.placebo_at) for r in baskets.placebos(df, ["s"], "m", "t", "v").collect()}
    for i, _, m, t, _ in data:
        best = min(((abs(t - u), n, u) for _, _, n, u, _ in data if n != m))
        assert got[i] == (best[1], best[2])
    alone = baskets.placebos(df.where("m = 1"), ["s"], "m", "t", "v")
    assert alone.where("placebo_market IS NOT NULL").count() == 0


def test_definitions(spark):
    legs = spark.createDataFrame([("e", "m", "t1", "YES", True), ("e", "m", "t2", "NO", True), ("e", "n", "t3", "YES", True), ("e", "n", "t4", "NO", True)], "e string, m string, t string, o string, x boolean")
    got = {r.partition: r.legs for r in baskets.definitions(legs, "e", "m", "t", "o", "x").collect()}
    assert got == {"pair:m": ["t1", "t2"], "pair:n": ["t3", "t4"], "yes:e": ["t1", "t3"], "no:e": ["t2", "t4"]}


def test_frozen_verdict(spark):
    r = spark.createDataFrame([(1.0, True)] * 60, "p double, s boolean")
    policy = spark.createDataFrame([(50, 0.01)], "floor int, rate double")
    assert baskets.frozen_verdict(r, F.col("p") > 0, F.col("s"), policy).first().verdict == "PASS"
    assert baskets.frozen_verdict(r.limit(10), F.col("p") > 0, F.col("s"), policy).first().verdict == "INCONCLUSIVE"
    assert baskets.frozen_verdict(r, F.col("p") > 5, F.col("s"), policy).first().verdict == "NO"


def test_numbers_are_dense_at_size_and_keep_their_payload(spark):
    n = 400_000
    df = spark.range(n).select(F.pmod(F.xxhash64("id"), F.lit(5000)).alias("at"), F.concat(F.lit("lane"), F.col("id") % 3).alias("lane"), F.col("id").alias("event"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    got = order.dense_sequence(df, ["at", "lane", "event"], partitions=13)
    row = got.agg(F.count_distinct("seq").alias("d"), F.min("seq").alias("lo"), F.max("seq").alias("hi"), F.count(F.lit(1)).alias("n")).first()
    assert tuple(row) == (n, 1, n, n)
    w = Window.orderBy("seq")
    before = F.lag(F.struct("at", "lane", "event")).over(w)
    assert got.select((before > F.struct("at", "lane", "event")).alias("bad")).where("bad").count() == 0
    assert got.where(F.col("payload") != F.sha2(F.col("event").cast("string"), 256)).count() == 0
    assert order.dense_sequence(df.limit(0), ["at"]).count() == 0


def test_rows_before_are_handed_over_ranges(spark):
    rng = random.Random(3)
    rows_ = [("k" if i % 3 else None, i, rng.randrange(40) if rng.random() > 0.1 else None) for i in range(600) if rng.random() > 0.2]
    df = spark.createDataFrame(rows_, "k string, n long, v long")
    breaks, back, below = [], [], []
    for k in ("k", None):
        mine = [r for r in rows_ if r[0] == k]
        breaks += [(k, b[1]) for a, b in zip(mine, mine[1:]) if b[1] != a[1] + 1]
        back += [(k, b[1]) for a, b in zip(mine, mine[1:]) if a[2] is not None and b[2] is not None and b[2] < a[2]]
        below += [(k, b[1]) for i, b in enumerate(mine) if b[2] is not None and any(a[2] is not None and a[2] > b[2] for a in mine[:i])]
    key = lambda x: (x[0] is None, x[1])
    for width in (7, 1 << 16):
        for got, want in ((order.dense_breaks(df, ["k"], "n", width), breaks), (order.regressions(df, ["k"], ["n"], "v", width), back), (order.version_regressions(df, ["k"], ["n"], "v", width), below)):
            assert sorted(((r.k, r.n) for r in got.collect()), key=key) == sorted(want, key=key)


def test_series_spaces(spark):
    df = spark.createDataFrame([("a", 3), ("b", 5)], "e string, bo int")
    got = omega.series_space(df, "e", "bo").groupBy("e").count().collect()
    assert {r.e: r["count"] for r in got} == {"a": 6, "b": 20}


def test_relations_and_partition(spark):
    u = spark.createDataFrame([("e", o) for o in "abcd"], "e string, outcome string")
    masks = {1: "ab", 2: "ab", 3: "a", 4: "cd", 5: "bc"}
    m = spark.createDataFrame([("e", k, o) for k, v in masks.items() for o in v], "e string, m long, outcome string")
    got = {(r.market_a, r.market_b): r.relation for r in omega.relationships(m, ["e"], "m").collect()}
    assert got[1, 2] == "IDENTITY" and got[1, 3] == "REVERSE_IMPLICATION" and got[1, 4] == "MUTUAL_EXCLUSION" and got[1, 5] == "OVERLAP"
    assert omega.is_partition(m.where("m IN (1, 4)"), u, ["e"], "m").first().is_partition
    assert omega.equivalence_classes(m, u, ["e"], "m").select("members").first()[0] == "1,2"
    assert sorted(r.outcome for r in omega.complement_mask(m.where("m = 5"), u, ["e"], "m").collect()) == ["a", "d"]


def test_listed_scores_and_settlement(spark):
    t = spark.createDataFrame([("e", "K-E-ESP1ARG0"), ("e", "K-E-ESP1ARG0"), ("e", "K-E-ESP2ARG2"), ("e", "K-E-OTHER")], "e string, ticker string")
    space = omega.listed_scores(t, "e", "ticker", r"[A-Z]+(\d+)[A-Z]+(\d+)$")
    assert sorted(r.outcome for r in space.collect()) == ["1-0", "2-2"]
    res = spark.createDataFrame([("e", "2-2"), ("f", "9-9")], "e string, result string")
    assert {(r.e, r.settled_outcome) for r in omega.settled(space, res, "e").select("e", "settled_outcome").collect()} == {("e", "2-2"), ("f", None)}


def test_bundles_and_orphans(spark):
    e = spark.createDataFrame([("a",), ("b",)], "event_id string")
    m = spark.createDataFrame([("a", 2), ("a", 1), ("zz", 3)], "event_id string, market long")
    bundled, orphans = matching.event_bundles(e, m, "event_id", "market")
    assert rows(bundled, "event_id") == [("a", [1, 2]), ("b", [])] and rows(orphans) == [("zz",)]


def test_greedy_skips_what_does_not_fit(spark):
    c = spark.createDataFrame([("r", "a", 1, 60, False), ("r", "b", 2, 50, False), ("r", "c", 3, 40, False), ("r", "p", 9, 10, True)], "run string, id string, rank int, cost int, keep boolean")
    got = {r.id: (r.selected, r.allocation) for r in matching.greedy_budget(c, "run", "rank", "cost", 110, 9, "keep").collect()}
    assert got == {"p": (True, None), "a": (True, None), "b": (False, "over_budget"), "c": (True, None)}


def test_reasons_and_classes(spark):
    df = spark.createDataFrame([("Team A wins", 1), ("total goals", 9)], "t string, n int")
    got = df.select(matching.first_class(df, [("total", "(?i)total"), ("win", "(?i)wins?")], "t"), matching.reasons(small=F.col("n") < 5, odd=F.col("n") % 2 == 1)).collect()
    assert [tuple(r) for r in got] == [("win", ["small", "odd"]), ("total", ["odd"])]
    mapping = spark.createDataFrame([("x", "A"), ("y", "A"), ("z", "B")], "label string, class string")
    tags = spark.createDataFrame([("k", "x"), ("k", "y"), ("l", "x"), ("l", "z")], "key string, label string")
    assert dict(rows(matching.agreed_class(tags, "key", "label", mapping))) == {"k": "A", "l": None}
    assert df.select(matching.disposition(F.lit(False), F.lit(True))).first()[0] == "all_terminal"


# ---- text


def test_text_keys(spark):
    df = spark.createDataFrame([("Real Madrid C.F.",), ("São Paulo FC",), ("Ｔeam Ω",), ("Й FC",), (None,), ("FK Crvena Zvezda",), ("मुंबई FC",), ("FC",), ("A.C. Ｍilan Club",), ("Kōfu 3é",)], "x string")
    assert [r[0] for r in df.select(text.canonical_participant(F.col("x"))).collect()] == ["real madrid c f", "sao paulo", "team ω", "й", None, "crvena zvezda", "मुंबई", "", "a c milan club", "kofu 3e"]
    t = spark.createDataFrame([("Alpha vs. Beta - Map 2",), ("Gamma @ Delta",), ("solo",)], "x string")
    assert [r[0] for r in t.select(text.participants(F.col("x"))).collect()] == [["Alpha", "Beta"], ["Delta", "Gamma"], None]
    b = spark.createDataFrame([(["BO3 series", "best of 3"],), (["bo3", "bo5"],)], "x array<string>")
    assert [r[0] for r in b.select(text.best_of(F.col("x"))).collect()] == [3, None]
    n = spark.createDataFrame([("3 or more",), ("over 2.5",), ("-1.5",), ("none",)], "x string")
    assert [r[0] for r in n.select(text.line_value(F.col("x"))).collect()] == [2.5, 2.5, -1.5, None]


def test_rules_text(spark):
    df = spark.createDataFrame([("m", "Alpha plays on March 3, 2026 at 5:30 pm ET. If 7 goals")], "m string, t string")
    assert df.select(text.rule_template(F.col("t"), F.lit("Alpha"))).first()[0] == "<name> plays on <date> at <time>. if <n> goals"
    r = spark.createDataFrame([("a", "If the match is cancelled, markets resolve 50-50. If postponed over 48 hours it resolves no. Cancelled games settle normally."), ("b", "If cancelled the fair price is paid."), ("c", "Nothing here.")], "k string, t string")
    got = {(x.k, x.trigger): (x.payoff, x.value, x.window_hours) for x in text.void_policy(r, "k", "t").collect()}
    assert got == {("a", "cancelled"): ("fifty_fifty", 0.5, None), ("a", "postponed"): ("resolves_no", 0.0, 48), ("b", "cancelled"): ("fair_price", None, None)}
    legs = spark.createDataFrame([("x", "a"), ("x", "b"), ("y", "c")], "basket string, k string")
    lock = dict(rows(text.basket_lock(legs, text.void_policy(r, "k", "t"), "basket", "k")))
    assert lock == {"x": "CONDITIONAL", "y": "NO_POLICY"}


def test_small_helpers(spark):
    df = spark.createDataFrame([("seg-20260803T101500Z.ndjson",), ("none",)], "n string")
    assert [r[0] for r in df.select(text.window_start("n")).collect()] == [1785752100000000, None]
    r = spark.range(1).select(columns.canonical_decimal(F.lit("1.500").cast("decimal(9,3)")), columns.ceil_to(F.lit(0.3), 0.1), text.safe_name(F.lit("a b/c")), columns.empty_to_null(F.lit("")), text.pair_key(F.lit("btc "), F.lit("usd"))).first()
    assert r[0] == "1.5" and r[1] == pytest.approx(0.3) and r[2] == "a_b_c" and r[3] is None and r[4] == "BTC/USD"
    t = spark.createDataFrame([("1754216100",), ("1754216100000",), ("2025-08-03T10:15:00Z",), ("x",)], "x string")
    assert [r[0] for r in t.select(columns.instant_micros(F.col("x"))).collect()] == [1754216100000000] * 3 + [None]


# ---- streaming helpers


def test_barrier_blocks_later_windows(spark):
    w = spark.createDataFrame([(0, 2), (10, 1), (20, 2)], "window_start long, valid_lanes int")
    out = windows.commit_barrier(windows.eligibility(w, 2, 10, 30, 100))
    assert [(r.state, r.commits) for r in out.orderBy("window_start").collect()] == [("complete", True), ("waiting", False), ("complete", False)]
    assert windows.eligibility(w, 2, 10, 200, 100).where("state = 'incomplete'").count() == 1


def test_late_rows_are_reported(spark):
    rows_ = spark.createDataFrame([(0, "a"), (10, "b")], "w long, x string")
    open_, late = windows.split_late(rows_, spark.createDataFrame([(0,)], "w long"), "w")
    assert rows(open_) == [(10, "b")] and rows(late) == [(0, "a")]


def test_carry_forward_keeps_stale_but_complete(spark):
    new = spark.createDataFrame([("v", "a", False), ("v", "b", True), ("u", "c", False), ("u", "c", False)], "venue string, asset string, failed boolean")
    prev = spark.createDataFrame([("v", "x"), ("u", "y"), ("t", "z")], "venue string, asset string")
    assert sorted(rows(windows.carry_forward(new, prev, "venue", "asset", "failed"))) == [("t", "z"), ("u", "c"), ("v", "x")]


def test_capture_window_period(spark):
    with pytest.raises(ValueError):
        windows.capture_window(F.lit(1), 7)


def test_crossing_prefers_the_lesser_instrument_and_counts_fees(spark):
    from ticktide.operators import crossing

    q = spark.createDataFrame([("c", 1, "i2", "v", 0.60, 0.64, 1), ("c", 1, "i1", "w", 0.60, 0.61, 2), ("c", 1, "i3", "v", 0.50, 0.55, 9), ("c", 2, "i1", "w", 0.4, 0.45, 1)], "k string, bar long, instrument string, venue string, bid double, ask double, age long")
    bars_ = crossing.crossing_bars(q, ["k"], "bar", ladder.flat_leg_fee(F.col("venue"), F.col("price"), "v"))
    r = bars_.where("bar = 1").first()
    assert (r.sell, r.buy, r.skew, r.same_venue) == ("i1", "i3", 9, False)
    assert r.crossing == pytest.approx(0.05) and r.net_crossing == pytest.approx(0.05 - 0.07 * 0.55 * 0.45)
    rec = crossing.crossing_records(bars_, ["k"]).first()
    assert (rec.bars, rec.bars_crossed, rec.xv_net, rec.xv_net_fresh) == (2, 1, 1, 0)
    assert crossing.survivors(bars_, 5).count() == 0
