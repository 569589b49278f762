"""Venue catalogue records to venue-neutral markets and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import empty_to_null, instant_micros
from .events import settled_outcome

# Where each neutral field stands in a venue's record; "event." paths are in the parent event.
FIELDS = {
    "kalshi": {
        "series_id": "event.series_ticker", "event_id": "event.event_ticker", "event_title": "event.title", "market_id": "ticker", "title": "title", "yes_label": "yes_sub_title", "no_label": "no_sub_title",
        "status": "status", "result": "result", "opens": "open_time", "closes": "close_time", "rules_primary": "rules_primary", "rules_secondary": "rules_secondary", "volume": "volume_fp", "liquidity": "liquidity_dollars",
    },
    "polymarket": {
        "series_id": "event.seriesSlug", "event_id": "event.id", "event_title": "event.title", "market_id": "conditionId", "title": "question", "yes_label": "groupItemTitle", "no_label": "",
        "status": "umaResolutionStatus", "result": "", "opens": "startDate", "closes": "endDate", "rules_primary": "description", "rules_secondary": "", "volume": "volume24hr", "liquidity": "liquidityNum",
    },
    "limitless": {
        "series_id": "event.categoryId", "event_id": "event.slug", "event_title": "event.title", "market_id": "slug", "title": "title", "yes_label": "proxyTitle", "no_label": "",
        "status": "status", "result": "winningOutcomeIndex", "opens": "createdAt", "closes": "expirationTimestamp", "rules_primary": "description", "rules_secondary": "", "volume": "volume", "liquidity": "liquidity",
    },
}


def neutral_markets(records: DataFrame, venue: str) -> DataFrame:
    """One row per raw market of a venue: neutral columns, tokens, rules hash, warnings.

    ``records`` (record, event): JSON texts. Times are microseconds, amounts doubles; what a
    record lacks is null. The rules hash covers the parts of the rules that are present.
    """
    columns = []
    for name, path in FIELDS[venue].items():
        where, _, field = path.rpartition(".")
        value = F.get_json_object(F.col("event" if where == "event" else "record"), f"$.{field}") if field else F.lit(None).cast("string")
        value = empty_to_null(F.trim(value))
        columns.append(instant_micros(value).alias(name) if name in ("opens", "closes") else value.try_cast("double").alias(name) if name in ("volume", "liquidity") else value.alias(name))
    out = records.select(F.lit(venue).alias("venue"), *columns, "record", "event")
    listed = lambda p: F.coalesce(F.from_json(F.get_json_object("record", p), "array<string>"), F.array().cast("array<string>"))
    out = out.withColumn("tokens", listed("$.clobTokenIds")).withColumn("outcomes", listed("$.outcomes"))
    prices = F.transform(listed("$.outcomePrices"), lambda x: x.try_cast("double"))
    rules = F.concat_ws("\n\n", "rules_primary", "rules_secondary")
    warnings = F.array_compact(F.array(
        F.when(F.col("market_id").isNull(), F.lit("missing_market_id")), F.when(F.lit(venue == "polymarket") & (F.size("tokens") == 0), F.lit("missing_token_ids")), F.when(F.size("tokens") != F.size("outcomes"), F.lit("tokens_without_outcomes")),
    ))
    return out.select(
        *(c for c in out.columns if c not in ("record", "event")), F.when(rules != "", F.sha2(rules.cast("binary"), 256)).alias("rules_sha256"),
        F.coalesce(F.when(F.size(prices) == F.size("outcomes"), settled_outcome(prices, F.col("outcomes"))), F.col("result")).alias("settled_outcome"), warnings.alias("warnings"), F.col("record").alias("raw"),
    )


def neutral_events(markets: DataFrame) -> DataFrame:
    """One row per event with its sorted market ids."""
    return markets.groupBy("venue", "event_id").agg(F.first("series_id", ignorenulls=True).alias("series_id"), F.first("event_title", ignorenulls=True).alias("title"), F.array_sort(F.collect_set("market_id")).alias("market_ids"))


def evidence_of(tag: Column, title: Column, family: str, prefix: str) -> Column:
    """struct(family, conflict): both the tag and the title prefix must name the family; one alone is a conflict."""
    by_tag, by_title = F.coalesce(tag == family, F.lit(False)), F.coalesce(F.startswith(F.lower(title), F.lit(prefix.lower())), F.lit(False))
    return F.struct(F.when(by_tag & by_title, F.lit(family)).alias("family"), (by_tag != by_title).alias("conflict"))


#: Market types by title, the first that matches.
TYPE_PATTERNS = (
    ("map_winner", r"(?i)\b(map|game) \d+ winner\b"), ("map_handicap", r"(?i)\bmap handicap\b"), ("total_maps", r"(?i)\btotal (maps|games)\b"), ("both_teams_to_score", r"(?i)both teams to score"), ("correct_score", r"(?i)\b(exact|correct) score\b"),
    ("total_goals", r"(?i)\b(over|under|o/u)\b"), ("spread", r"(?i)\bspread\b|\([+-]\d"), ("series_moneyline", r"(?i)\b(bo\d|best of \d)\b"), ("moneyline_3way", r"(?i)\bvs\.?\b|\bwinner\b|\bdraw\b"),
)


def market_type(title: Column) -> Column:
    out = None
    for name, pattern in TYPE_PATTERNS:
        out = F.when(title.rlike(pattern), name) if out is None else out.when(title.rlike(pattern), name)
    return out


def claims(markets: DataFrame) -> DataFrame:
    """Affirmative claims of each market: one row per label that its type can be read from.

    ``markets`` (market_id, market_type, labels array, side, line, direction). Winner types
    claim every label (or the side); totals claim each over or under label, else the
    direction; spreads need a line and a side; a market whose type isn't known, or that
    lacks what its type needs, makes none.
    """
    labels = F.coalesce("labels", F.array().cast("array<string>"))
    words = F.filter(F.transform(labels, lambda x: F.split(F.lower(x), " ")[0]), lambda w: w.isin("over", "under"))
    direction = F.when(F.col("direction").isin("over", "under"), F.array("direction")).otherwise(F.array().cast("array<string>"))
    some = lambda a, b: F.when(F.size(a) > 0, a).otherwise(b)
    none = F.array().cast("array<string>")
    own = F.when(F.col("side").isNotNull(), F.array("side")).otherwise(none)
    made = (
        F.when(F.col("market_type").isin("moneyline_3way", "series_moneyline", "map_winner"), some(labels, own))
        .when(F.col("market_type").isin("total_goals", "total_maps") & F.col("line").isNotNull(), some(words, direction))
        .when(F.col("market_type").isin("spread", "map_handicap") & F.col("line").isNotNull(), some(own, F.when(F.size(labels) == 2, labels).otherwise(none)))
        .when(F.col("market_type").isin("both_teams_to_score", "correct_score"), F.array(F.lit("yes"))).otherwise(none)
    )
    return markets.select("market_id", "market_type", "line", F.posexplode(made).alias("claim", "label")).withColumn("claim_id", F.concat(F.col("market_id").cast("string"), F.lit("#"), F.col("claim").cast("string")))


def cross_venue_partitions(legs: DataFrame) -> DataFrame:
    """YES of one venue with NO of another for the same canonical market, and YES with the other venue's other outcome.

    ``legs`` (market_key, venue, token, outcome in YES, NO). Pairs are formed inside one
    market key, between venues only: a market has one leg per venue and outcome.
    """
    one = legs.groupBy("market_key", "venue", "outcome").agg(F.min("token").alias("token"))
    a = one.where("outcome = 'YES'").select("market_key", F.col("venue").alias("yes_venue"), F.col("token").alias("yes_token"))
    b = one.where("outcome = 'NO'").select("market_key", F.col("venue").alias("no_venue"), F.col("token").alias("no_token"))
    return a.join(b, "market_key").where("yes_venue <> no_venue").withColumn("partition", F.concat_ws(":", F.lit("cross"), "market_key", "yes_venue", "no_venue"))
