"""Scans in ranges against plain windows, with one key that holds nine tenths of the rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ticktide.operators import bars, intervals, order
from ticktide.operators.scan import Ranges


@pytest.fixture(scope="module")
def hot(spark):
    df = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 10 < 9, "hot").when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 700)).alias("k"),
        (F.col("id") * 7919 % 60_013).alias("at"), F.col("id").alias("id"),
        F.when(F.xxhash64("id") % 400 == 0, F.col("id") % 97).alias("v"), (F.floor(F.col("id") * 7919 % 60_013 / 37) % 3).alias("s"),
    )
    return df.cache()


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_every_scan_equals_its_window(spark, hot):
    got = Ranges(hot, ["k"], ["at", "id"], partitions=16).add(
        previous=("previous", F.col("v")), next=("next", F.col("v")), last=("last", F.col("v")), last_before=("last_before", F.col("v")),
        first_after=("first_after", F.col("v")), most=("max", F.col("v")), most_before=("max_before", F.col("v")), total=("sum", F.col("v")),
    ).runs(F.col("s"), "run")
    w = Window.partitionBy("k").orderBy("at", "id")
    upto, before, after = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("k").orderBy(F.desc("at"), F.desc("id")).rowsBetween(Window.unboundedPreceding, -1)
    want = hot.withColumns({
        "previous": F.lag("v").over(w), "next": F.lead("v").over(w), "last": F.last("v", True).over(upto), "last_before": F.last("v", True).over(before),
        "first_after": F.last("v", True).over(after), "most": F.max("v").over(upto), "most_before": F.max("v").over(before), "total": F.sum("v").over(upto),
        "_c": F.when(F.lag("s").over(w).eqNullSafe(F.col("s")), 0).otherwise(1),
    }).withColumn("run", F.sum("_c").over(upto))
    columns = ("k", "at", "id", "previous", "next", "last", "last_before", "first_after", "most", "most_before", "total", "run")
    assert rows(got.rows(), *columns) == rows(want, *columns)
    sizes = [r["count"] for r in got.df.groupBy("_part").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 60_000 / 16 * 1.6  # the hot key lies in many ranges


def test_asof_and_nearest_of_a_hot_key(spark, hot):
    right = hot.where("v IS NOT NULL").select("k", F.col("at").alias("t"), "v")
    got = bars.asof_backward(hot.select("k", "at", "id"), right, ["k"], "at", "t", ["v"])
    w = Window.partitionBy("k").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    want = hot.withColumn("v", F.last("v", True).over(w))
    assert rows(got, "k", "id", "v") == rows(want, "k", "id", "v")
    near = bars.nearest(hot.where("k IS NOT NULL").select("k", "at", "id"), right, ["k"], "at", "t", "v", 5)
    assert near.count() == hot.where("k IS NOT NULL").count() and near.where("abs(nearest_at - at) > 5").isEmpty()


def test_episodes_and_causes_of_a_hot_key(spark, hot):
    w = Window.partitionBy("k").orderBy("at")
    got = intervals.depth_episodes(hot, ["k"], "at", "s", F.lit(70_000))
    marked = hot.withColumn("b", F.struct("s")).withColumn("p", F.lag("b").over(w)).where("p IS NULL OR NOT p <=> b").withColumn("end", F.coalesce(F.lead("at").over(w), F.lit(70_000)))
    assert rows(got.where("k IS NOT NULL"), "k", "s", "start", "end") == rows(marked.where("k IS NOT NULL"), "k", "s", "at", "end")
    tape = hot.select("k", F.col("at").alias("seq"), "at", F.lit("range").alias("kind"), F.col("at").alias("first"), F.col("at").alias("last"), (F.col("at") - 1).alias("prev"))
    causes = {r.cause: r["count"] for r in order.continuity_causes(tape.where("k = 'hot'"), ["k"], "seq", "at", "kind", "first", "last", "prev").groupBy("cause").count().collect()}
    at = sorted(r.at for r in hot.where("k = 'hot'").select("at").collect())
    jumps = sum(b != a + 1 for a, b in zip(at, at[1:]))
    assert causes == {"bootstrap": 1, "local_break": jumps, "continuous": len(at) - 1 - jumps}
