"""Entity resolution and selection."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .intervals import time_clusters

#: Weights of relationships, of venues, of activity.
RELATION_WEIGHTS = {"IDENTITY": 40, "IMPLICATION": 20, "REVERSE_IMPLICATION": 20, "MUTUAL_EXCLUSION": 10}
VENUE_WEIGHT, PREFERRED_BONUS, CLASS_WEIGHT = 1000, 1000, 10
ACTIVITY_WEIGHTS = (2.0, 1.0, 1.5)


def match_events(events: DataFrame, block: list[str], venue: str, at: str, tolerance: int, min_venues: int = 2, topology: str | None = None) -> DataFrame:
    """Bundles of events of different venues: (block, cluster_start, ..., reason).

    Events are blocked on equal keys (sport, canonical participants); in a block, events
    within the tolerance of a cluster's first belong together. reason is null for an
    accepted bundle, else the first that applies: ambiguous (a venue twice),
    format_conflict (differing ``topology``), too_few_venues.
    """
    clustered = time_clusters(events, block, at, tolerance)
    bundles = clustered.groupBy(*block, "cluster_start").agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct(venue).alias("venues"), F.median(at).alias("median_at"),
        (F.count_distinct(topology) if topology else F.lit(1)).alias("_formats"),
    )
    reason = F.when(F.col("events") > F.col("venues"), "ambiguous").when(F.col("_formats") > 1, "format_conflict").when(F.col("venues") < min_venues, "too_few_venues")
    return bundles.withColumn("reason", reason).drop("_formats")


def unique_match(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """Left rows with the one right value of their key; none or several give null and a reason."""
    known = right.groupBy(key).agg(F.count_distinct(value).alias("_n"), F.min(value).alias("_v"))
    joined = left.join(known, key, "left")
    return joined.withColumn("matched", F.when(F.col("_n") == 1, F.col("_v"))).withColumn("reason", F.when(F.col("_n").isNull(), "no_candidate").when(F.col("_n") > 1, "ambiguous")).drop("_n", "_v")


def event_bundles(events: DataFrame, markets: DataFrame, event: str, market: str) -> tuple[DataFrame, DataFrame]:
    """(events with their sorted child markets, markets' event ids that no event has)."""
    children = markets.groupBy(event).agg(F.array_sort(F.collect_set(market)).alias("markets"))
    bundled = events.join(children, event, "left").withColumn("markets", F.coalesce("markets", F.array().cast(children.schema["markets"].dataType)))
    return bundled, markets.select(event).where(F.col(event).isNotNull()).distinct().join(events.select(event), event, "left_anti")


def first_class(rows: DataFrame, rules: list[tuple[str, str]], *fields: str) -> Column:
    """The first rule (class, pattern) that matches any of the fields; null if none does."""
    text = F.concat_ws("\n", *fields)
    out = None
    for name, pattern in rules:
        out = F.when(text.rlike(pattern), name) if out is None else out.when(text.rlike(pattern), name)
    return out


def agreed_class(rows: DataFrame, key: str, label: str, mapping: DataFrame) -> DataFrame:
    """The class that all of a key's labels map to, if they agree on exactly one."""
    return rows.join(mapping, label).groupBy(key).agg(F.when(F.count_distinct("class") == 1, F.min("class")).alias("class"))


def activity(day: Column, total: Column, liquidity: Column) -> Column:
    """Weighted sum of ln(1 + x); unknown and negative values count as 0."""
    part = lambda w, x: w * F.log1p(F.greatest(F.lit(0.0), F.coalesce(x, F.lit(0.0))))
    return part(ACTIVITY_WEIGHTS[0], day) + part(ACTIVITY_WEIGHTS[1], total) + part(ACTIVITY_WEIGHTS[2], liquidity)


def relation_score(relation: Column) -> Column:
    """Aggregate: the weighted number of relationships."""
    weight = F.lit(0)
    for name, w in RELATION_WEIGHTS.items():
        weight = F.when(relation == name, w).otherwise(weight)
    return F.sum(weight)


def reasons(**tests: Column) -> Column:
    """Array of the names of those tests that hold, in order: exclusion is a label, never a delete."""
    return F.array_compact(F.array(*(F.when(test, F.lit(name)) for name, test in tests.items())))


def ranked(candidates: DataFrame, keys: list[str], order: list[Column], out: str = "rank") -> DataFrame:
    return candidates.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def greedy_budget(candidates: DataFrame, run: str, rank: str, cost: str, budget: int, max_items: int, protected: str | None = None) -> DataFrame:
    """Per run: take candidates in rank order while they fit; one that doesn't fit is skipped.

    Protected candidates come first. Adds selected and allocation (null, over_budget or
    over_count). A run's decision depends on all before it, so a run is one group; runs
    are independent and small next to the archive of runs.
    """
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in candidates.schema) + ", selected boolean, allocation string"

    def decide(pdf: pd.DataFrame) -> pd.DataFrame:
        by = [c for c in (protected, rank) if c]
        pdf = pdf.sort_values(by, ascending=[c != protected for c in by], kind="stable")
        left, taken, chosen, why = budget, 0, [], []
        for c in pdf[cost]:
            fits = taken < max_items and c <= left
            why.append(None if fits else "over_count" if taken >= max_items else "over_budget")
            chosen.append(fits)
            if fits:
                left, taken = left - c, taken + 1
        return pdf.assign(selected=chosen, allocation=why)

    return candidates.groupBy(run).applyInPandas(decide, fields)


def disposition(clamped: Column, all_terminal: Column) -> Column:
    return F.when(clamped, "clamped").when(all_terminal, "all_terminal").otherwise("retained")


def compare_sets(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Full outer comparison by keys: missing_left, missing_right, differs or equal."""
    a = left.select(*keys, F.struct(*columns).alias("_a"))
    b = right.select(*keys, F.struct(*columns).alias("_b"))
    status = F.when(F.col("_a").isNull(), "missing_left").when(F.col("_b").isNull(), "missing_right").when(F.col("_a").eqNullSafe(F.col("_b")), "equal").otherwise("differs")
    return a.join(b, keys, "full").select(*keys, status.alias("status"))


def whole_groups(rows: DataFrame, series: str, group: str, at: str, minimum: int, limit: int) -> DataFrame:
    """Groups kept whole, nearest first: those with ``minimum`` rows while a series' total stays within the limit."""
    sizes = rows.groupBy(series, group).agg(F.count(F.lit(1)).alias("_n"), F.min(at).alias("_at")).where(F.col("_n") >= minimum)
    w = Window.partitionBy(series).orderBy("_at", group)
    kept = sizes.withColumn("_total", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0))).where(F.col("_total") <= limit)
    return rows.join(kept.select(series, group), [series, group], "left_semi")
