"""Ladders: walking depth, fees, complements, validity.

A ladder is either rows (one level a row, any keys) or an array of struct(price, size).
The row form runs as windows over the keys; the array form as one expression per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ceil_to

#: Ticket sizes, the headline size, the fee increment.
SIZES = (1, 10, 25, 50, 100, 250, 500, 1000)
HEADLINE = 100
FEE_INCREMENT = 0.0001


def fills(levels: DataFrame, keys: list[str], price: str, size: str, contracts: float, order: list[str]) -> DataFrame:
    """Level rows with ``take``: what a ticket of ``contracts`` consumes of each level.

    Levels are walked by price, then by ``order`` (all other columns, so ties are fixed);
    levels of no positive size are skipped. One window over the keys, no join.
    """
    w = Window.partitionBy(*keys).orderBy(price, *order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(size).over(w), F.lit(0.0))
    return levels.where(F.col(size) > 0).withColumn("take", F.greatest(F.lit(0.0), F.least(F.col(size), F.lit(float(contracts)) - before)))


def walk(levels: DataFrame, keys: list[str], price: str, size: str, contracts: float, order: list[str]) -> DataFrame:
    """Per key: filled, notional, vwap (null if nothing fills), depth_limited."""
    taken = fills(levels, keys, price, size, contracts, order)
    out = taken.groupBy(*keys).agg(F.sum("take").alias("filled"), F.sum(F.col("take") * F.col(price)).alias("notional"))
    return out.withColumn("vwap", F.when(F.col("filled") > 0, F.col("notional") / F.col("filled"))).withColumn("depth_limited", F.col("filled") < contracts)


def walk_array(levels: Column, contracts: Column | float) -> Column:
    """struct(filled, notional, vwap, depth_limited, fills) of a sorted array of struct(price, size)."""
    n = F.lit(float(contracts)) if not isinstance(contracts, Column) else contracts.cast("double")
    start = F.struct(F.lit(0.0).alias("filled"), F.lit(0.0).alias("notional"))

    def step(acc: Column, x: Column) -> Column:
        take = F.greatest(F.lit(0.0), F.least(x["size"].cast("double"), n - acc["filled"]))
        return F.struct((acc["filled"] + take).alias("filled"), (acc["notional"] + take * x["price"].cast("double")).alias("notional"))

    total = F.aggregate(F.filter(levels, lambda x: x["size"] > 0), start, step)
    return F.struct(total["filled"].alias("filled"), total["notional"].alias("notional"), F.when(total["filled"] > 0, total["notional"] / total["filled"]).alias("vwap"), (total["filled"] < n).alias("depth_limited"))


def fee(price: Column, quantity: Column, rate: Column | float, exponent: Column | float = 1.0, multiplier: Column | float = 1.0) -> Column:
    """Uncapped fee of one fill: rate * multiplier * quantity * (p * (1 - p)) ^ exponent."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(float(x))
    return lit(rate) * lit(multiplier) * quantity * F.pow(price * (1 - price), lit(exponent))


def conservative_fee(total: Column, fixed: Column | float = 0.0, increment: float = FEE_INCREMENT) -> Column:
    """A summed fee rounded up to the increment."""
    return ceil_to(total + fixed, increment)


def normal_fee(total: Column, up: Column, digits: int = 4) -> Column:
    """A venue's own rounding: up to the increment where ``up``, else half to even."""
    return F.when(up, ceil_to(total, 10.0**-digits)).otherwise(F.bround(total, digits))


def flat_leg_fee(venue: Column, price: Column, charged: str, rate: float = 0.07) -> Column:
    """A flat share of p(1 - p) on one venue only."""
    return F.when(venue == charged, rate * price * (1 - price)).otherwise(F.lit(0.0))


def scaled(levels: Column, decimals: Column) -> Column:
    """Sizes from integer units to contracts."""
    return F.transform(levels, lambda x: F.struct(x["price"].alias("price"), (x["size"] / F.pow(F.lit(10.0), decimals)).alias("size")))


def complement(levels: Column) -> Column:
    """The other outcome's opposite side: price 1 - p, sorted again by price."""
    return F.array_sort(F.transform(levels, lambda x: F.struct((1 - x["price"]).alias("price"), x["size"].alias("size"))))


def issues(levels: Column, descending: bool = False) -> Column:
    """Sorted array of what is wrong with a ladder; empty if nothing is."""
    n = F.size(levels)
    at = lambda i: F.element_at(levels, i)["price"]
    steps = F.when(n > 1, F.sequence(F.lit(2), n)).otherwise(F.array().cast("array<int>"))
    wrong = (lambda i: at(i) > at(i - 1)) if descending else (lambda i: at(i) < at(i - 1))
    some = lambda test: F.exists(levels, test)
    return F.array_sort(F.array_compact(F.array(
        F.when(some(lambda x: x["price"].isNull() | x["size"].isNull()), F.lit("invalid_level")),
        F.when(some(lambda x: (x["price"] <= 0) | (x["price"] >= 1)), F.lit("price_out_of_bounds")),
        F.when(some(lambda x: x["size"] < 0), F.lit("negative_size")),
        F.when(F.size(F.array_distinct(F.transform(levels, lambda x: x["price"]))) < n, F.lit("duplicate_price")),
        F.when(F.exists(steps, wrong), F.lit("wrong_order")),
    )))


def price_matches(a: Column, b: Column, tolerance: float) -> Column:
    """Both null, or both present and within the tolerance."""
    return F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).otherwise(F.abs(a - b) <= tolerance)


def levels_match(a: Column, b: Column, tolerance: float, complemented: bool = False) -> Column:
    """The same set of prices (as 1 - p on request) with sizes within the tolerance."""
    left, right = F.array_sort(complement(a) if complemented else a), F.array_sort(b)
    pairs = F.arrays_zip(left.alias("l"), right.alias("r"))
    return (F.size(left) == F.size(right)) & F.forall(pairs, lambda z: (F.abs(z["l"]["price"] - z["r"]["price"]) <= 1e-9) & (F.abs(z["l"]["size"] - z["r"]["size"]) <= tolerance))


def cover_cost(legs: DataFrame, keys: list[str], outcome: str, cost: str, outcomes: Column) -> DataFrame:
    """Cheapest way to hold one unit of every outcome: the sum of each outcome's least cost.

    ``outcomes`` is the number of outcomes that must be covered; cost is null where one is
    not on offer.
    """
    least = legs.groupBy(*keys, outcome).agg(F.min(cost).alias("_least"), F.max(outcomes).alias("_wanted"))
    out = least.groupBy(*keys).agg(F.sum("_least").alias("cover_cost"), F.count("_least").alias("_covered"), F.max("_wanted").alias("_wanted"))
    return out.withColumn("feasible", F.col("_covered") == F.col("_wanted")).withColumn("cover_cost", F.when(F.col("feasible"), F.col("cover_cost"))).drop("_covered", "_wanted")


def leg_timing(legs: DataFrame, keys: list[str], received: str, source: str, resolves: str) -> DataFrame:
    """Per basket: observation (last receipt), skew and age in the clock's unit, time to resolution."""
    return legs.groupBy(*keys).agg(
        F.max(received).alias("observed"), (F.max(received) - F.min(received)).alias("skew"),
        (F.max(received) - F.min(source)).alias("age"), (F.min(resolves) - F.max(received)).alias("to_resolution"),
    )
