"""Crossed quotes between equivalent instruments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Seconds up to which quotes are fresh, width up to which a book is tight.
FRESH_S, TIGHT = 5, 0.05


def crossing_bars(quotes: DataFrame, keys: list[str], bar: str, fee: Column) -> DataFrame:
    """One row per key and bar from quotes (keys, bar, instrument, venue, bid, ask, age).

    The highest bid against the lowest ask, ties to the lesser instrument; ``fee`` is the
    fee of a leg as an expression of (venue, price). gross and net crossing, the age of the
    oldest quote (skew), the width of the book bought from, the spread of mid prices.
    """
    sell = F.max_by(F.struct("instrument", "venue", F.col("bid").alias("price")), F.struct(F.col("bid"), F.col("_order")))
    buy = F.min_by(F.struct("instrument", "venue", F.col("ask").alias("price"), (F.col("ask") - F.col("bid")).alias("width")), F.struct(F.col("ask"), -F.col("_order")))
    mid = (F.col("bid") + F.col("ask")) / 2
    from pyspark.sql import Window

    ordered = quotes.withColumn("_order", -F.row_number().over(Window.partitionBy(*keys, bar).orderBy("instrument")))
    out = ordered.groupBy(*keys, bar).agg(sell.alias("sell"), buy.alias("buy"), F.max("age").alias("skew"), (F.max(mid) - F.min(mid)).alias("mid_spread"), F.max(F.col("ask") - F.col("bid")).alias("widest_book"), F.count(F.lit(1)).alias("routes"))
    legs = out.select("*", F.col("buy.venue").alias("venue"), F.col("buy.price").alias("price")).withColumn("_f1", fee).withColumn("venue", F.col("sell.venue")).withColumn("price", F.col("sell.price")).withColumn("_f2", fee)
    gross = F.col("sell.price") - F.col("buy.price")
    return legs.select(
        *keys, bar, F.col("buy.instrument").alias("buy"), F.col("sell.instrument").alias("sell"), gross.alias("crossing"), (gross - F.col("_f1") - F.col("_f2")).alias("net_crossing"),
        (F.col("buy.venue") == F.col("sell.venue")).alias("same_venue"), F.col("buy.width").alias("buy_leg_width"), "skew", "mid_spread", "widest_book", "routes",
    )


def crossing_records(bars: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: bars, how often they cross gross and net, on fresh quotes, across venues, on tight books."""
    gross, net, fresh, across, tight = F.col("crossing") > 0, F.col("net_crossing") > 0, F.col("skew") <= FRESH_S, ~F.col("same_venue"), F.col("buy_leg_width") <= TIGHT
    return bars.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("bars"), F.median("crossing").alias("crossing_median"), F.max("crossing").alias("crossing_max"), F.count_if(gross).alias("bars_crossed"), F.count_if(net).alias("bars_net_crossed"),
        F.max("net_crossing").alias("net_crossing_max"), F.count_if(fresh).alias("bars_fresh"), F.count_if(fresh & net).alias("bars_fresh_net_crossed"), F.count_if(F.col("crossing") > 0.01).alias("bars_crossed_over_1c"),
        F.count_if(gross & across).alias("cross_venue_crossings"), F.count_if(gross & ~across).alias("same_venue_crossings"), F.count_if(net & across).alias("xv_net"), F.count_if(net & across & fresh).alias("xv_net_fresh"),
        F.count_if(net & across & fresh & tight).alias("xv_net_fresh_tight"), F.median("mid_spread").alias("median_mid_spread"), F.median("widest_book").alias("median_widest_book"), F.max("skew").alias("max_skew"),
    )


def crossing_totals(records: DataFrame) -> DataFrame:
    """One row over all records: sums of the counts, crossing rate, medians of the medians."""
    counts = ("bars", "bars_crossed", "bars_net_crossed", "bars_fresh", "bars_fresh_net_crossed", "xv_net", "xv_net_fresh", "xv_net_fresh_tight", "same_venue_crossings", "bars_crossed_over_1c")
    out = records.agg(F.count(F.lit(1)).alias("classes"), *(F.sum(c).alias(c) for c in counts), F.median("median_mid_spread").alias("median_mid_spread"), F.median("median_widest_book").alias("median_widest_book"))
    return out.withColumn("crossing_rate", F.when(F.col("bars") > 0, F.col("bars_crossed") / F.col("bars")).otherwise(F.lit(0.0)))


def survivors(bars: DataFrame, top: int) -> DataFrame:
    """The best net crossings between venues on fresh quotes and tight books, best first."""
    ok = (F.col("net_crossing") > 0) & ~F.col("same_venue") & (F.col("skew") <= FRESH_S) & (F.col("buy_leg_width") <= TIGHT)
    return bars.where(ok).orderBy(F.desc("net_crossing"), *(c for c in bars.columns if c != "net_crossing")).limit(top)
