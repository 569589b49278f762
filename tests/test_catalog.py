"""Venue records to neutral markets, literal cases."""

import hashlib
import json

from pyspark.sql import functions as F

from ticktide.plans import catalog


def frame(spark, *pairs):
    return spark.createDataFrame([(json.dumps(r), json.dumps(e)) for r, e in pairs], "record string, event string")


def test_kalshi_market(spark):
    r = {"ticker": "T", "title": "t", "yes_sub_title": "Alpha", "open_time": "2026-08-03T10:00:00Z", "rules_primary": "a", "rules_secondary": "b", "volume_fp": "12.5", "result": ""}
    m = catalog.neutral_markets(frame(spark, (r, {"series_ticker": "S", "event_ticker": "E", "title": "ev"})), "kalshi").first()
    assert (m.venue, m.series_id, m.event_id, m.market_id, m.yes_label, m.volume, m.settled_outcome) == ("kalshi", "S", "E", "T", "Alpha", 12.5, None)
    assert m.rules_sha256 == hashlib.sha256(b"a\n\nb").hexdigest() and m.opens == 1785751200000000


def test_polymarket_market(spark):
    base = {"conditionId": "c", "question": "q", "clobTokenIds": '["1","2"]', "outcomes": '["Yes","No"]'}
    rows = catalog.neutral_markets(frame(spark, ({**base, "outcomePrices": '["0","1"]'}, {"id": 7}), ({**base, "outcomePrices": '["0.5","0.5"]'}, {"id": 7}), ({"conditionId": "", "outcomes": '["Yes"]'}, {})), "polymarket").collect()
    assert [r.settled_outcome for r in rows] == ["No", "FIFTY_FIFTY", None] and rows[0].tokens == ["1", "2"]
    assert rows[2].warnings == ["missing_market_id", "missing_token_ids", "tokens_without_outcomes"] and rows[0].warnings == []
    e = catalog.neutral_events(catalog.neutral_markets(frame(spark, (base, {"id": 7})), "polymarket")).first()
    assert (e.event_id, e.market_ids) == ("7", ["c"])


def test_types_claims_and_evidence(spark):
    t = spark.createDataFrame([("Map 2 Winner",), ("Alpha vs Beta",), ("Over 2.5 goals",), ("zzz",)], "x string")
    assert [r[0] for r in t.select(catalog.market_type(F.col("x"))).collect()] == ["map_winner", "moneyline_3way", "total_goals", None]
    rows = [("a", "moneyline_3way", ["A", "Draw", "B"], None, None, None), ("b", "total_goals", ["Over 2.5", "Under 2.5"], None, 2.5, None), ("c", "total_goals", None, None, 2.5, "over"), ("d", "total_goals", None, None, None, "over"), ("e", "spread", None, "A", 1.5, None), ("f", "other", ["x"], None, None, None)]
    m = spark.createDataFrame(rows, "market_id string, market_type string, labels array<string>, side string, line double, direction string")
    assert sorted((r.claim_id, r.label) for r in catalog.claims(m).collect()) == [("a#0", "A"), ("a#1", "Draw"), ("a#2", "B"), ("b#0", "over"), ("b#1", "under"), ("c#0", "over"), ("e#0", "A")]
    ev = spark.createDataFrame([("dota", "Dota 2: x"), ("dota", "other"), (None, "Dota 2: y"), (None, "z")], "tag string, title string")
    assert [(r[0].family, r[0].conflict) for r in ev.select(catalog.evidence_of(F.col("tag"), F.col("title"), "dota", "dota 2")).collect()] == [("dota", False), (None, True), (None, True), (None, False)]


def test_cross_venue_partitions(spark):
    legs = spark.createDataFrame([("m", "k", "k1", "YES"), ("m", "k", "k2", "NO"), ("m", "p", "p1", "YES"), ("m", "p", "p2", "NO"), ("n", "k", "x", "YES")], "market_key string, venue string, token string, outcome string")
    assert sorted((r.yes_token, r.no_token) for r in catalog.cross_venue_partitions(legs).collect()) == [("k1", "p2"), ("p1", "k2")]
