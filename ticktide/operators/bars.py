"""As-of joins and bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scan import Ranges


def bar_snapshots(df: DataFrame, keys: list[str], at: str, bar: int, max_age: int, values: list[str], order: list[str], start: int | None = None, end: int | None = None) -> DataFrame:
    """Per key and bar boundary: the last row at or before it, not older than ``max_age``; never later.

    Each row is offered to the few boundaries it can serve (max_age / bar + 1 at most) and
    the latest offer wins, so a hot key needs no sort of its whole history.
    """
    low = F.ceil(F.col(at) / bar).cast("long")
    high = F.floor((F.col(at) + max_age) / bar).cast("long")
    if start is not None:
        low = F.greatest(low, F.lit(-(-start // bar)))
    if end is not None:
        high = F.least(high, F.lit(end // bar))
    offered = df.where(low <= high).withColumn("bar", F.explode(F.transform(F.sequence(low, high), lambda i: i * bar)))
    best = offered.groupBy(*keys, "bar").agg(F.max(F.struct(at, *order, *(v for v in values if v not in {at, *order}))).alias("_b"))
    return best.select(*keys, "bar", *(F.col(f"_b.{v}").alias(v) for v in dict.fromkeys([at, *values])), (F.col("bar") - F.col(f"_b.{at}")).alias("age"))


def asof_backward(left: DataFrame, right: DataFrame, keys: list[str], left_at: str, right_at: str, values: list[str]) -> DataFrame:
    """Each left row with the values of the last right row at or before it (null if none)."""
    a = left.withColumn("_side", F.lit(1)).withColumn("_at", F.col(left_at)).withColumn("_v", F.lit(None).cast(_packed_type(right, right_at, values)))
    b = right.select(*keys, F.col(right_at).alias("_at"), F.lit(0).alias("_side"), F.struct(F.col(right_at).alias("_t"), *values).alias("_v"))
    both = a.unionByName(b, allowMissingColumns=True)
    both = Ranges(both, keys, ["_at", "_side", "_v"]).add(_found=("last", F.col("_v"))).rows()
    return both.where("_side = 1").drop("_v").withColumnRenamed("_found", "_v").select(*left.columns, F.col("_v._t").alias(f"{right_at}_asof"), *(F.col(f"_v.{v}").alias(v) for v in values))


def _packed_type(df: DataFrame, at: str, values: list[str]) -> str:
    return df.select(F.struct(F.col(at).alias("_t"), *values).alias("v")).schema["v"].dataType.simpleString()


def schedule_at(left: DataFrame, timeline: DataFrame, keys: list[str], at: str, effective: str, values: list[str]) -> DataFrame:
    """The timeline entry of greatest effective time at or before each row; a null effective time is the base."""
    return asof_backward(left, timeline.withColumn(effective, F.coalesce(F.col(effective), F.lit(-1).cast("long"))), keys, at, effective, values)


def nearest(left: DataFrame, right: DataFrame, keys: list[str], left_at: str, right_at: str, value: str, tolerance: int) -> DataFrame:
    """Each left row with the nearest right row of its key, either side, within the tolerance; ties go to the earlier."""
    a = left.withColumn("_side", F.lit(1)).withColumn("_at", F.col(left_at))
    b = right.select(*keys, F.col(right_at).alias("_at"), F.lit(0).alias("_side"), F.struct(F.col(right_at).alias("t"), F.col(value).alias("v")).alias("_r"))
    both = a.withColumn("_r", F.lit(None).cast(b.schema["_r"].dataType)).unionByName(b, allowMissingColumns=True)
    both = Ranges(both, keys, ["_at", "_side"]).add(_p=("last", F.col("_r")), _n=("first_after", F.col("_r"))).rows().where("_side = 1")
    before, after = F.col("_at") - F.col("_p.t"), F.col("_n.t") - F.col("_at")
    chosen = F.when(before.isNotNull() & (after.isNull() | (before <= after)), F.col("_p")).otherwise(F.col("_n"))
    gap = F.least(before, after)
    return both.withColumn("_c", F.when(gap <= tolerance, chosen)).select(*left.columns, F.col("_c.t").alias("nearest_at"), F.col("_c.v").alias("nearest_value"))


def verdict_at(points: DataFrame, intervals: DataFrame, keys: list[str], at: str, start: str, end: str, verdict: str, unknown: str = "UNKNOWN") -> DataFrame:
    """Verdict of the first half-open interval that holds each point; unknown without one.

    Intervals of a key don't overlap, so the last interval that begins at or before the
    point decides: an as-of join, no range join.
    """
    found = asof_backward(points, intervals, keys, at, start, [end, verdict])
    return found.withColumn(verdict, F.when(F.col(at) < F.col(end), F.col(verdict)).otherwise(F.lit(unknown))).drop(end, f"{start}_asof")


def leg_sets(legs: DataFrame, bars: DataFrame, basket: str, leg: str, bar: str = "bar") -> tuple[DataFrame, DataFrame]:
    """(basket, legs) and (legs, bar): each basket's set of legs, and the bars that all legs of a set have.

    Baskets of equal legs share their bars, so bars are found once a set and not once a basket.
    """
    sets = legs.where(F.col(basket).isNotNull()).groupBy(basket).agg(F.array_sort(F.collect_set(leg)).alias("legs"))
    wanted = sets.select("legs").distinct().withColumn(leg, F.explode("legs"))
    have = wanted.join(bars.where(F.col(bar).isNotNull()).select(leg, bar).distinct(), leg).groupBy("legs", bar).agg(F.count(F.lit(1)).alias("_have"))
    return sets, have.where(F.col("_have") == F.size("legs")).select("legs", bar)


def common_bars(legs: DataFrame, bars: DataFrame, basket: str, leg: str, bar: str = "bar") -> DataFrame:
    """Leg rows at the bars that all legs of their basket have."""
    sets, full = leg_sets(legs, bars, basket, leg, bar)
    rows = legs.join(sets, basket).join(full, "legs").drop("legs")
    out = rows.join(bars, [leg, bar])
    return out.select(basket, bar, *(c for c in dict.fromkeys([*legs.columns, *bars.columns]) if c not in {basket, bar}))


def compare_routes(prices: DataFrame, keys: list[str], route: str, price: str, rank: str) -> DataFrame:
    """Per key: cheapest and dearest route and the spread; the lower rank breaks ties."""
    return prices.groupBy(*keys).agg(
        F.min(F.struct(price, rank, route))[route].alias("cheapest"), F.min(price).alias("low"),
        F.max_by(route, F.struct(F.col(price), -F.col(rank))).alias("dearest"), F.max(price).alias("high"),
        (F.max(price) - F.min(price)).alias("spread"), F.count(F.lit(1)).alias("routes"),
    )


def exact_or_latest(left: DataFrame, catalogue: DataFrame, keys: list[str], digest: str, values: list[str]) -> DataFrame:
    """Values of the exact (digest, keys) entry, else of the greatest digest for the keys."""
    exact = catalogue.select(digest, *keys, F.struct(*values).alias("_e"))
    latest = catalogue.groupBy(*keys).agg(F.max_by(F.struct(*values), digest).alias("_l"))
    joined = left.join(exact, [digest, *keys], "left").join(latest, keys, "left")
    return joined.withColumn("_v", F.coalesce("_e", "_l")).select(*left.columns, *(F.col(f"_v.{v}").alias(v) for v in values))


def fulfilment(events: DataFrame, keys: list[str], at: str, is_request: Column, is_answer: Column) -> DataFrame:
    """Each request with the first answer after it and the latency; unanswered requests keep nulls."""
    ordered = Ranges(events.withColumn("_side", F.when(is_request, 0).otherwise(1)), keys, [at, "_side"])
    return ordered.add(answered_at=("first_after", F.when(is_answer, F.col(at)))).rows().where(is_request).drop("_side").withColumn("latency", F.col("answered_at") - F.col(at))


def supporting_evidence(anchors: DataFrame, evidence: DataFrame, keys: list[str], at: str, seen: str, precedence: str, tolerance: int) -> DataFrame:
    """Per anchor: the evidence of least precedence number, then nearest, within the tolerance."""
    joined = anchors.join(evidence, keys).where(F.abs(F.col(at) - F.col(seen)) <= tolerance)
    return joined.groupBy(*anchors.columns).agg(F.min(F.struct(F.col(precedence), F.abs(F.col(at) - F.col(seen)).alias("distance"), F.col(seen))).alias("best")).select(*anchors.columns, "best.*")
