"""Greedy selection under several budgets, in rounds over prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import forget, materialize
from .scan import Ranges


def greedy(candidates: DataFrame, run: str, order: list[str], cost: str, budgets: DataFrame, venue: str, venue_budgets: DataFrame) -> DataFrame:
    """Adds selected and allocation (null, over_count, over_budget or over_venue_budget, the first that applies).

    In ``order`` (total within a run) a candidate is taken if the run's money, its venue's money and the
    number of items allow it; one that doesn't fit is passed over. ``budgets``: run, budget, items;
    ``venue_budgets``: run, venue, budget. Nothing is taken from a venue or in a run
    without a budget. Costs are whole and not negative.

    A round takes the longest prefix that fits, drops the candidate that ended it, and all that can't fit in what
    is left: what is left never grows. Prefix sums are scans in ranges, so no run is a
    group. Rounds are as many as prefixes; a run of equal costs needs one or two.
    """
    rank = F.struct(*order)
    state = materialize(budgets.select(run, F.col("budget").cast("long").alias("_left"), F.col("items").cast("long").alias("_items")), "budgets")
    purse = materialize(venue_budgets.select(run, venue, F.col("budget").cast("long").alias("_purse")), "purses")
    open_ = materialize(candidates.select(run, venue, *order, F.col(cost).cast("long").alias("_cost")), "open")
    taken: list[DataFrame] = []
    while True:
        able = open_.join(state, run).join(purse, [run, venue]).where("_cost <= _left AND _cost <= _purse AND _items > 0")
        whole = Ranges(able, [run], order).add(_sum=("sum", F.col("_cost")), _n=("sum", F.lit(1))).rows()
        summed = materialize(Ranges(whole, [run, venue], order).add(_own=("sum", F.col("_cost"))).rows(), "sums")
        fits = (F.col("_sum") <= F.col("_left")) & (F.col("_own") <= F.col("_purse")) & (F.col("_n") <= F.col("_items"))
        ends = summed.where(~fits).groupBy(run).agg(F.min(rank).alias("_end"))
        judged = materialize(summed.join(ends, run, "left").withColumn("_rank", rank), "judged")
        got = materialize(judged.where("_end IS NULL OR _rank < _end").select(run, venue, *order, "_cost"), "taken")
        if got.isEmpty():
            break
        taken.append(got)
        spent = got.groupBy(run).agg(F.sum("_cost").alias("_s"), F.count(F.lit(1)).alias("_c"))
        each = got.groupBy(run, venue).agg(F.sum("_cost").alias("_s"))
        old = (state, purse, open_)
        state = materialize(state.join(spent, run, "left").select(run, (F.col("_left") - F.coalesce("_s", F.lit(0))).alias("_left"), (F.col("_items") - F.coalesce("_c", F.lit(0))).alias("_items")), "budgets")
        purse = materialize(purse.join(each, [run, venue], "left").select(run, venue, (F.col("_purse") - F.coalesce("_s", F.lit(0))).alias("_purse")), "purses")
        open_ = materialize(judged.where("_rank > _end").select(run, venue, *order, "_cost"), "open")
        forget(*old, summed, judged)
    chosen = candidates.withColumn("selected", F.lit(False))
    if taken:
        every = taken[0]
        for more in taken[1:]:
            every = every.unionByName(more)
        chosen = candidates.join(every.select(run, *order, F.lit(True).alias("selected")), [run, *order], "left").withColumn("selected", F.coalesce("selected", F.lit(False)))
    # why not: by what was spent before it in order
    money, one = F.when(F.col("selected"), F.col(cost)).otherwise(0), F.col("selected").cast("long")
    after = Ranges(chosen, [run], order).add(_spent=("sum", money), _count=("sum", one)).rows()
    after = Ranges(after, [run, venue], order).add(_paid=("sum", money)).rows()
    after = after.join(budgets.select(run, F.col("budget").alias("_budget"), F.col("items").alias("_allowed")), run, "left").join(venue_budgets.select(run, venue, F.col("budget").alias("_venue")), [run, venue], "left")
    why = (
        F.when(F.col("selected"), None).when(F.col("_count") >= F.coalesce("_allowed", F.lit(0)), "over_count")
        .when(F.col("_spent") + F.col(cost) > F.coalesce("_budget", F.lit(0)), "over_budget").otherwise("over_venue_budget")
    )
    return after.withColumn("allocation", why).select(*candidates.columns, "selected", "allocation")
