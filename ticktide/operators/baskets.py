"""Baskets of outcome contracts: measurement, selection, summaries, gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import at_rank, value_ranks

#: Why a row is excluded, the first that applies.
EXCLUSIONS = ("one_sided", "depth_limited", "fee_missing")


def exclusion(one_sided: Column, depth_limited: Column, fee_missing: Column) -> Column:
    return F.when(one_sided, EXCLUSIONS[0]).when(depth_limited, EXCLUSIONS[1]).when(fee_missing, EXCLUSIONS[2])


def measure(legs: DataFrame, keys: list[str], legs_wanted: Column, cost: str, fee: str, conservative: str, filled: str, size: str, payoff: float = 1.0) -> DataFrame:
    """Fold leg rows (one per leg, already walked to ``size``) to one row per key.

    gross is the legs' cost per contract, net adds fees, profit is what the basket pays
    minus net; each for normal and for conservative fees. A leg without a ladder has a
    null cost; a leg without a schedule has a null fee.
    """
    folded = legs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.max(legs_wanted).alias("_wanted"), F.sum(cost).alias("gross"), F.sum(fee).alias("fee"), F.sum(conservative).alias("fee_conservative"),
        F.coalesce(F.bool_or(F.col(cost).isNull()), F.lit(False)).alias("_bare"), F.coalesce(F.bool_or(F.col(filled) < F.col(size)), F.lit(False)).alias("_short"), F.bool_or(F.col(fee).isNull()).alias("_free"),
    )
    reason = exclusion(F.col("_bare") | (F.col("_n") < F.col("_wanted")), F.col("_short"), F.col("_free"))
    out = folded.withColumn("exclusion", reason).withColumn("valid", F.col("exclusion").isNull())
    ok = lambda x: F.when(F.col("valid"), x)
    return (
        out.withColumn("net", ok(F.col("gross") + F.col("fee"))).withColumn("net_conservative", ok(F.col("gross") + F.col("fee_conservative")))
        .withColumn("profit", payoff - F.col("net")).withColumn("profit_conservative", payoff - F.col("net_conservative"))
        .select(*keys, F.col("_n").alias("legs"), "gross", "net", "net_conservative", "profit", "profit_conservative", "exclusion", "valid")
    )


def best_representation(rows: DataFrame, keys: list[str], net: str, representation: str, valid: Column) -> DataFrame:
    """Per key among valid rows: greatest net, then the shorter id, then the greater id."""
    w = Window.partitionBy(*keys).orderBy(F.col(net).desc(), F.length(representation).asc(), F.col(representation).desc())
    return rows.where(valid).withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def summary(rows: DataFrame, keys: list[str], value: str, valid: Column) -> DataFrame:
    """Counts, share of positive values, least, median and greatest of the valid rows per key."""
    v = F.when(valid, F.col(value))
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count(v).alias("n_valid"), F.count_if(v > 0).alias("n_positive"),
        F.when(F.count(v) > 0, F.count_if(v > 0) / F.count(v)).alias("positive_rate"), F.min(v).alias("least"), F.median(v).alias("median"), F.max(v).alias("greatest"),
    )


def gate_rows(rows: DataFrame, category: str, event: str, positive: Column, valid: Column, floor: int, rate: float) -> DataFrame:
    """Per class and event: valid and positive rows, rate, whether it qualifies and passes."""
    out = rows.groupBy(category, event).agg(F.count_if(valid).alias("n_valid"), F.count_if(valid & positive).alias("n_positive"))
    out = out.withColumn("rate", F.when(F.col("n_valid") > 0, F.col("n_positive") / F.col("n_valid"))).withColumn("qualifies", F.col("n_valid") >= floor)
    return out.withColumn("passes", F.col("qualifies") & (F.col("rate") >= rate))


def terminal_status(gates: DataFrame, category: str, event: str, invalid: Column, same_venue: list[str], cross_venue: list[str], events_needed: int) -> DataFrame:
    """One row: invalid data, then a same-venue pass, a conditional cross-venue pass, too little data, no signal."""
    of = lambda names: F.col(category).isin(names)
    count = lambda c: F.count_distinct(F.when(c, F.col(event)))
    row = gates.agg(
        F.coalesce(F.bool_or(invalid), F.lit(False)).alias("_bad"), count(F.col("passes") & of(same_venue)).alias("same_venue_events"),
        count(F.col("passes") & of(cross_venue)).alias("cross_venue_events"), count(F.col("qualifies")).alias("qualified_events"),
    )
    status = (
        F.when(F.col("_bad"), "DATA_INVALID").when(F.col("same_venue_events") >= events_needed, "PASS_SAME_VENUE")
        .when(F.col("cross_venue_events") >= events_needed, "CONDITIONAL_CROSS_VENUE").when(F.col("qualified_events") < events_needed, "INSUFFICIENT_DATA").otherwise("NO_SIGNAL")
    )
    return row.withColumn("status", status).drop("_bad")


def frozen_verdict(rows: DataFrame, positive: Column, survived: Column, policy: DataFrame) -> DataFrame:
    """One row: enough observations, then rate and survivors decide. ``policy`` has one row (floor, rate); more are an error."""
    facts = rows.agg(F.count(F.lit(1)).alias("observations"), F.count_if(positive).alias("positives"), F.count_if(survived).alias("survivors"))
    one = policy.agg(F.count(F.lit(1)).alias("_n"), F.first("floor").alias("floor"), F.first("rate").alias("rate"))
    one = one.withColumn("floor", F.when(F.col("_n") == 1, F.col("floor")).otherwise(F.raise_error(F.lit("a frozen policy is one row")).cast(policy.schema["floor"].dataType)))
    joined = facts.join(F.broadcast(one.drop("_n")))  # two aggregates of one row each
    rate = F.col("positives") / F.greatest(F.col("observations"), F.lit(1))
    return joined.withColumn("verdict", F.when(F.col("observations") < F.col("floor"), "INCONCLUSIVE").when((rate >= F.col("rate")) & (F.col("survivors") > 0), "PASS").otherwise("NO"))


def placebos(rows: DataFrame, strata: list[str], market: str, at: str, value: str) -> DataFrame:
    """Each row with its placebo: the nearest row in time of another market in the same stratum.

    Ties go to the lesser market, then the earlier time. No pairs are formed: in time
    order the nearest other market stands at the edge of the run of equal markets, on
    either side; markets of the very same time are compared by their two least.
    """
    points = rows.groupBy(*strata, at, market).agg(F.min(value).alias("_v"))
    point = F.struct(F.col(at).alias("t"), F.col(market).alias("m"), F.col("_v").alias("v"))
    same = Window.partitionBy(*strata, at)
    points = points.withColumn("_least", F.min(market).over(same))
    here = F.when(F.col(market) == F.col("_least"), F.min(F.when(F.col(market) != F.col("_least"), F.struct(F.col(at).alias("t"), F.col(market).alias("m"), F.col("_v").alias("v")))).over(same)).otherwise(F.min(F.when(F.col(market) == F.col("_least"), point)).over(same))
    points = points.withColumn("_here", here)
    # markets descend within a time, so the run before ends with the least market of its last time
    for out, order in (("_before", (F.col(at).asc(), F.col(market).desc())), ("_after", (F.col(at).desc(), F.col(market).desc()))):
        w = Window.partitionBy(*strata).orderBy(*order)
        points = points.withColumn("_prev", F.lag(point).over(w)).withColumn("_edge", F.when(F.col("_prev.m") != F.col(market), F.col("_prev")))
        points = points.withColumn(out, F.last("_edge", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    offer = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.abs(F.col(f"{c}.t") - F.col(at)).alias("gap"), F.col(f"{c}.m").alias("m"), F.col(f"{c}.t").alias("t"), F.col(f"{c}.v").alias("v")))
    best = points.withColumn("_p", F.array_min(F.array_compact(F.array(offer("_here"), offer("_before"), offer("_after")))))
    best = best.select(*strata, at, market, F.col("_p.m").alias("placebo_market"), F.col("_p.t").alias("placebo_at"), F.col("_p.v").alias("placebo_value"))
    return rows.join(best, [*strata, at, market])


def definitions(legs: DataFrame, event: str, market: str, token: str, outcome: str, exclusive: str) -> DataFrame:
    """Partition definitions: (event, partition, class, legs) from markets' tokens.

    YES and NO of one market; all YES of a mutually exclusive event; all NO of such an
    event if it has two markets.
    """
    own = legs.groupBy(event, market).agg(F.array_sort(F.collect_list(token)).alias("legs"), F.count_distinct(outcome).alias("_o")).where("_o = 2").select(event, F.concat(F.lit("pair:"), F.col(market).cast("string")).alias("partition"), F.lit("complement").alias("class"), "legs")
    group = legs.where(F.col(exclusive)).groupBy(event).agg(F.count_distinct(market).alias("_m"), F.array_sort(F.collect_list(F.when(F.col(outcome) == "YES", F.col(token)))).alias("_yes"), F.array_sort(F.collect_list(F.when(F.col(outcome) == "NO", F.col(token)))).alias("_no")).where("_m > 1")
    yes = group.select(event, F.concat(F.lit("yes:"), F.col(event).cast("string")).alias("partition"), F.lit("all_yes").alias("class"), F.col("_yes").alias("legs"))
    no = group.where("_m = 2").select(event, F.concat(F.lit("no:"), F.col(event).cast("string")).alias("partition"), F.lit("all_no").alias("class"), F.col("_no").alias("legs"))
    return own.unionByName(yes).unionByName(no)


def level_counts(df: DataFrame, keys: list[str], levels: str) -> DataFrame:
    """Per key: most levels seen, distinct counts, share of rows at the most."""
    each = df.groupBy(*keys, levels).agg(F.count(F.lit(1)).alias("_n"))
    return each.groupBy(*keys).agg(F.max(levels).alias("max_levels"), F.count(F.lit(1)).alias("distinct_counts"), (F.max_by("_n", levels) / F.sum("_n")).alias("share_at_max"))


def spread_summary(routes: DataFrame, keys: list[str], spread: str, thresholds: list[float]) -> DataFrame:
    """Median, mean, 90th percentile by index floor(0.9 n), greatest spread, and bars over each threshold.

    Values are counted first, so no key's values are collected.
    """
    ranked = value_ranks(routes.where(F.col(spread).isNotNull()), keys, spread)
    n, v, c = F.col("n"), F.col(spread), F.col("count")
    stats = ranked.groupBy(*keys).agg(
        F.max(n).alias("bars"), ((at_rank(v, F.floor((n - 1) / 2)) + at_rank(v, F.floor(n / 2))) / 2).alias("median_spread"), (F.sum(v * c) / F.sum(c)).alias("mean_spread"),
        at_rank(v, F.least(n - 1, F.floor(n * 0.9))).alias("p90_spread"), F.max(v).alias("max_spread"),
        *(F.coalesce(F.sum(F.when(v > t, c)), F.lit(0)).cast("long").alias(f"over_{i}") for i, t in enumerate(thresholds)),
    )
    return stats
