"""Steps whose work follows the kinds of things and not their number."""

from pyspark.sql import functions as F

from ticktide.operators import bars, omega
from ticktide.plans import events, market_queries


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_baskets_of_equal_legs_share_their_bars(spark):
    legs = spark.createDataFrame([(b, x) for b in range(60) for x in ("ab" if b % 2 else "abc")] + [(None, "a")], "basket long, leg string")
    b = spark.createDataFrame([("a", 1), ("a", 2), ("a", None), ("b", 2), ("b", 3), ("c", 3), ("b", 4), ("a", 4), ("c", 4)], "leg string, bar long")
    sets, full = bars.leg_sets(legs, b, "basket", "leg")
    assert sorted(map(tuple, full.collect())) == [(["a", "b"], 2), (["a", "b"], 4), (["a", "b", "c"], 4)] and sets.count() == 60
    rows = {tuple(r) for r in bars.common_bars(legs, b, "basket", "leg").select("basket", "leg", "bar").collect()}
    assert rows == {(i, x, n) for i in range(60) for x in ("ab" if i % 2 else "abc") for n in ((2, 4) if i % 2 else (4,))}


def test_masks_are_made_for_shapes_and_not_for_markets(spark):
    rows = [("e", i, 0.5 + i % 2, "total_over" if i % 3 else "draw") for i in range(90)] + [("e", 4, 7.5, "draw")]
    markets = spark.createDataFrame(rows, "event string, market long, line double, kind string")
    held, shapes = omega.shapes(markets, "event", "market", "kind", "line")
    assert held.count() == 90 and shapes.count() == 6 and held.select("shape").distinct().count() == 5
    grid = omega.score_grid(markets, "event", "line")
    mask = omega.masks(markets, grid, "event", "market", "kind", omega.SCORE_TYPES).distinct()
    small = omega.masks(shapes, grid, "event", "shape", "kind", omega.SCORE_TYPES).distinct()
    span = held.groupBy("event", "shape").agg(F.min("market").alias("least"), F.max("market").alias("greatest"))
    whole = omega.is_partition(mask, grid, ["event"], "market").collect()
    assert omega.is_partition(small.join(span, ["event", "shape"]), grid, ["event"], "least", "greatest").collect() == whole
    count = lambda m, by: omega.complement_mask(m, grid, ["event"], by).groupBy("event", by).agg(F.count(F.lit(1)).alias("n"))
    got = held.join(count(small, "shape"), ["event", "shape"]).select("event", "market", "n")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, count(mask, "market").collect()))


def test_a_partition_is_not_found_by_counting_markets(spark):
    mask = spark.createDataFrame([("e", 1, "x"), ("e", 1, "x"), ("e", 1, "y"), ("e", 2, "z"), ("e", 3, "z")], "event string, market long, outcome string")
    space = spark.createDataFrame([("e", o) for o in "wxyz"], "event string, outcome string")
    out = omega.is_partition(mask, space, ["event"], "market")
    assert [tuple(r) for r in out.collect()] == [("e", 1, 1, False)]  # the second x is no second market


def test_a_fee_conflict_keeps_no_row_a_value(spark):
    base = spark.createDataFrame([(1, 1.0)], "k long, m double")
    changes = spark.createDataFrame([(1, 5, 0.1), (1, 5, 0.1), (1, 7, 0.1), (1, 7, 0.2), (1, 9, None)], "k long, effective long, m double")
    out = events.fee_timeline(base, changes, "k", "effective", "m")
    assert "distinct" not in plan(out)  # a distinct count keeps a row a value
    assert [(r.effective, r.m, r.conflict, r.until) for r in out.orderBy("effective").collect()] == [(-1, 1.0, False, 5), (5, 0.1, False, 7), (7, 0.1, True, 9), (9, None, False, None)]


def test_registered_masks_go_by_shape(spark, sf):
    held, mask = market_queries.shape_masks(spark, sf)
    assert mask.select("event", "shape").distinct().count() < held.count()
