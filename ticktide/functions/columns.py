"""Column helpers: clocks, canonical text, hashes, exact numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Edges of the skew bands in seconds; the last edge is inclusive.
SKEW_BANDS = ("lt_5s", "5_to_15s", "15_to_60s", "gt_60s")


def epoch_micros(ts: str) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, whatever the session's zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST({ts} AS TIMESTAMP_NTZ))")


def instant_micros(raw: Column) -> Column:
    """Microseconds of ISO text, epoch seconds or epoch milliseconds (split at 1e10); null if neither."""
    number = raw.try_cast("double")
    scaled = F.when(F.abs(number) < 1e10, number * 1e6).otherwise(number * 1e3)
    return F.coalesce(F.round(scaled).cast("long"), F.unix_micros(raw.try_cast("timestamp")))


def skew_band(seconds: Column) -> Column:
    return F.when(seconds < 5, "lt_5s").when(seconds < 15, "5_to_15s").when(seconds <= 60, "15_to_60s").otherwise("gt_60s")


def canonical_decimal(x: Column) -> Column:
    """Fixed-point text without trailing zeros."""
    text = x.cast("string")
    return F.when(text.contains("."), F.regexp_replace(F.regexp_replace(text, "0+$", ""), r"\.$", "")).otherwise(text)


def fingerprint(*columns: Column | str) -> Column:
    """SHA-256 over the columns in the given order; null differs from empty."""
    parts = [F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"), F.lit("\u0001")) for c in columns]
    return F.sha2(F.concat_ws("\u001f", *parts).cast("binary"), 256)


def domain_hash(domain: str, value: Column) -> Column:
    """SHA-256 of domain, 8-byte length, bytes: equal bytes of different domains differ."""
    raw = value.cast("binary")
    return F.sha2(F.concat(F.lit(domain).cast("binary"), F.unhex(F.lpad(F.hex(F.octet_length(raw).cast("long")), 16, "0")), raw), 256)


def set_digest(values: Column) -> Column:
    """Aggregate: hash of a set of strings, whatever their order and repeats."""
    return F.sha2(F.array_join(F.array_sort(F.collect_set(values)), "\n").cast("binary"), 256)


def empty_to_null(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def half_even(x: Column, digits: int) -> Column:
    return F.bround(x, digits)


def ceil_to(x: Column, increment: float) -> Column:
    """Up to the next increment; a value within 1e-12 increments of one stays there."""
    return F.ceil(x / increment - 1e-12) * increment


#: Buckets between a key's least and greatest value in which ranks are found.
VALUE_BUCKETS = 1024


def value_ranks(rows: DataFrame, keys: list[str], value: str, weight: str | None = None) -> DataFrame:
    """(keys, value, count, upto, n): distinct values with their counts and how many rows are at or below each.

    With ``weight`` a row counts that many times.
    Equal values are counted before anything is ordered. Running sums go over buckets of the
    value and then inside a bucket, so a key's values are neither collected nor sorted in one task.
    """
    counted = rows.groupBy(*keys, value).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("count"))
    span = counted.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.sum("count").alias("n"))
    width = F.col("_hi") - F.col("_lo")
    bucket = F.when(width > 0, F.floor((F.col(value) - F.col("_lo")) / width * VALUE_BUCKETS)).otherwise(F.lit(0)).cast("int")
    on = [F.col(f"c.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    joined = counted.alias("c").join(span.alias("s"), on) if keys else counted.join(F.broadcast(span))  # without keys: one row
    bucketed = (joined.select("c.*", "_lo", "_hi", "n") if keys else joined).withColumn("_b", bucket).drop("_lo", "_hi")
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = bucketed.groupBy(*keys, "_b").agg(F.sum("count").alias("_s")).withColumn("_start", F.coalesce(F.sum("_s").over(before), F.lit(0))).drop("_s")
    on = [F.col(f"c.{k}").eqNullSafe(F.col(f"s.{k}")) for k in (*keys, "_b")]
    inside = Window.partitionBy(*keys, "_b").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = bucketed.alias("c").join(starts.alias("s"), on).select("c.*", "_start")
    return ranked.withColumn("upto", F.col("_start") + F.sum("count").over(inside)).drop("_b", "_start")


def at_rank(value: Column, index: Column) -> Column:
    """Over rows of ``value_ranks``: the value at an index from 0 in ascending order."""
    return F.min(F.when(F.col("upto") > index, value))
