"""Check suites and reports: one aggregate per check, one row per check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import at_rank, value_ranks


def check(df: DataFrame, name: str, passed: Column, **evidence: Column) -> DataFrame:
    """One row (name, status, evidence). An empty input is NOT_PRESENT: absence never passes or fails."""
    facts = df.agg(F.count(F.lit(1)).alias("_n"), passed.alias("_ok"), *(e.cast("string").alias(k) for k, e in evidence.items()))
    status = F.when(F.col("_n") == 0, "NOT_PRESENT").when(F.coalesce("_ok", F.lit(False)), "PASS").otherwise("FAIL")
    pairs = [x for k in evidence for x in (F.lit(k), F.col(k))]
    return facts.select(F.lit(name).alias("name"), status.alias("status"), (F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")).alias("evidence"))


def suite(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def verdict(suite: DataFrame, advisory: tuple[str, ...] = ()) -> DataFrame:
    """One row: FAIL if any check fails, INCOMPLETE if any is not present, else PASS. Advisory checks don't count."""
    counted = suite.where(~F.col("name").isin(list(advisory))) if advisory else suite
    out = counted.agg(F.count_if(F.col("status") == "FAIL").alias("failed"), F.count_if(F.col("status") == "NOT_PRESENT").alias("absent"), F.count(F.lit(1)).alias("checks"))
    return out.withColumn("verdict", F.when(F.col("failed") > 0, "FAIL").when(F.col("absent") > 0, "INCOMPLETE").otherwise("PASS"))


def tape_checks(envelopes: DataFrame, breaks: DataFrame, seals: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Fitness of a tape: envelopes valid, order dense, clocks present, segments sealed, subscriptions evidenced."""
    return suite([
        check(envelopes, "byte_and_envelope_integrity", F.count_if(F.col("error").isNotNull()) == 0, rows=F.count(F.lit(1)), errors=F.count_if(F.col("error").isNotNull())),
        check(envelopes.join(breaks.select("lane", "delivery_index", F.lit(1).alias("_b")), ["lane", "delivery_index"], "left"), "deterministic_capture_order", F.count("_b") == 0, breaks=F.count("_b")),
        check(envelopes, "receive_clock_provenance", F.bool_and(F.col("visible_ns").isNotNull()), without_monotonic=F.count_if(F.col("monotonic_ns").isNull())),
        check(seals, "every_segment_is_sealed", F.bool_and(F.col("status").isin("sealed", "empty_but_sealed")), bad=F.count_if(~F.col("status").isin("sealed", "empty_but_sealed"))),
        check(subscriptions, "subscription_provenance", F.bool_and(F.col("captured") | F.col("asserted")), asserted_only=F.count_if(~F.col("captured") & F.col("asserted"))),
    ])


def skew_strata(rows: DataFrame, band: Column, bands: tuple[str, ...]) -> DataFrame:
    """Counts per fixed band, empty bands included."""
    spark = rows.sparkSession
    table = spark.createDataFrame([(i, b) for i, b in enumerate(bands)], "band_no int, band string")
    counted = rows.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n"))
    return F.broadcast(table).join(counted, "band", "left").select("band_no", "band", F.coalesce("n", F.lit(0)).alias("n"))


def coverage_lag(rows: DataFrame, lag: str) -> DataFrame:
    """count, known, and by index: median (n // 2), 90th percentile (floor(0.9 n)), greatest; one row, null without known lags."""
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.count(lag).alias("n_known"))
    known = value_ranks(rows.where(F.col(lag).isNotNull()), [], lag)
    last = F.col("n") - 1
    stats = known.agg(at_rank(F.col(lag), F.floor(F.col("n") / 2)).alias("median"), at_rank(F.col(lag), F.least(last, F.floor(F.col("n") * 0.9))).alias("p90"), F.max(lag).alias("greatest"))
    return facts.join(F.broadcast(stats))  # two aggregates of one row each


def history_report(rows: DataFrame, target: str, at: str, content: str) -> DataFrame:
    """Per target: rows, repeats of a (time, content), first and last time, rows without a time."""
    return rows.groupBy(target).agg(
        F.count(F.lit(1)).alias("n_rows"), (F.count(F.lit(1)) - F.count_distinct(F.struct(F.coalesce(F.col(at).cast("string"), F.lit("")), F.coalesce(F.col(content).cast("string"), F.lit(""))))).alias("repeats"),
        F.min(at).alias("first_at"), F.max(at).alias("last_at"), F.count_if(F.col(at).isNull()).alias("without_time"),
    )


def pull_plan(targets: DataFrame, event: str, minutes: str, density: float, page: int) -> DataFrame:
    """Calls per event and the running total, cheapest first; ties by event."""
    from pyspark.sql import Window

    cost = targets.groupBy(event).agg(F.sum(F.ceil(F.col(minutes) * density / page)).alias("calls"), F.count(F.lit(1)).alias("targets"))
    return cost.withColumn("cumulative", F.sum("calls").over(Window.orderBy("calls", event).rowsBetween(Window.unboundedPreceding, 0)))


def daily_manifest(receipts: DataFrame, at: str, key: str, verified: Column) -> DataFrame:
    """Verified receipts per UTC day, in order of key, with a digest; closed if none is unverified."""
    day = F.date_format(F.col(at), "yyyy-MM-dd")
    return receipts.groupBy(day.alias("day")).agg(
        F.count_if(verified).alias("receipts"), F.sha2(F.array_join(F.array_sort(F.collect_list(F.when(verified, F.col(key).cast("string")))), "\n").cast("binary"), 256).alias("digest"), F.bool_and(verified).alias("closed"),
    )


def retention_verdict(inventory: DataFrame, reasons: list[tuple[str, Column]]) -> DataFrame:
    """The first reason to keep each row, in order; null means it may go. Nothing is deleted."""
    out = None
    for name, test in reasons:
        out = F.when(test, name) if out is None else out.when(test, name)
    return inventory.withColumn("keep_because", out)


def rollup(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def reason_histogram(rows: DataFrame, reasons: Column, selected: Column, fallback: Column) -> DataFrame:
    """Reasons of rows that weren't selected: their own, else the fallback, else eligible_not_selected."""
    own = F.when(F.size(reasons) > 0, reasons).when(fallback.isNotNull(), F.array(fallback)).otherwise(F.array(F.lit("eligible_not_selected")))
    return rows.where(~selected).select(F.explode(own).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
