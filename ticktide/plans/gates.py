"""The check suites of gates 1 to 4: one aggregate per named check, one row per check.

A status is PASS, FAIL or ADVISORY (measured, never blocking). Absent evidence fails: a tape
that proves nothing passes nothing. Evidence is a map of counts. The names of checks are fixed values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import order
from ..sources.scratch import materialize

#: Fixed values of the gates: anchors and match rate that a serializer needs, the ticket, the estimator's name.
MIN_ANCHORS, MIN_MATCH_RATE, TICKET = 100, 0.95, 100
ESTIMATOR = "DISPLAYED_DEPTH_SURVIVAL_100MS"


def judged(facts: DataFrame, name: str, passed: Column | None, **evidence: Column) -> DataFrame:
    """One row of a suite from a table of one row; null counts as not passed. ``passed`` None: the check is advisory."""
    status = F.lit("ADVISORY") if passed is None else F.when(F.coalesce(passed, F.lit(False)), "PASS").otherwise("FAIL")
    pairs = [x for k, v in evidence.items() for x in (F.lit(k), v.cast("string"))]
    return facts.select(F.lit(name).alias("name"), status.alias("status"), (F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")).alias("evidence"))


def together(*facts: DataFrame) -> DataFrame:
    """Tables of one row each, side by side."""
    return reduce(lambda a, b: a.join(F.broadcast(b)), facts)  # aggregates without keys: one row by construction


def _suite(rows: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, rows)


def gate1(envelopes: DataFrame, events: DataFrame, segments: DataFrame, records: DataFrame, sightings: DataFrame, snapshots: DataFrame, allow_asserted: bool = False, auxiliary: DataFrame | None = None) -> DataFrame:
    """Fitness of a tape, 17 checks.

    ``envelopes``: parsed lines with lane, torn and error. ``events``: ``plans.events.normalize``
    of the valid ones, with lane. ``segments`` (object_key, status) of ``sources.tape.verify_seals``.
    ``records`` (venue, asset_id, provenance, has_rules, has_fees, valid), ``sightings``
    (venue, asset_id, created_at), ``snapshots`` (metadata_digest, and if it has them n_targets, n_rules
    and n_fees: what the snapshot itself holds) come from the catalogue. ``auxiliary`` (object_key,
    error): objects beside the tape that could not be read.
    """
    c, n = F.col, F.count_if
    kind = lambda k: c("event_kind") == k
    poly, limitless = c("venue") == "polymarket", c("venue") == "limitless"
    lines = envelopes.agg(F.count(F.lit(1)).alias("records"), n(c("error").isNotNull()).alias("errors"), n(c("torn")).alias("torn"), n((c("envelope_version") == 2) & c("monotonic_ns").isNotNull()).alias("v2"), F.count_distinct("lane").alias("lanes"))
    good = envelopes.where("error IS NULL")
    breaks = order.dense_breaks(good, ["lane"], "delivery_index").agg(F.count(F.lit(1)).alias("delivery_breaks"))
    local = order.dense_breaks(good, ["venue", "connection_epoch"], "local_counter").agg(F.count(F.lit(1)).alias("local_breaks"))
    opened = events.where(kind("connection_opened"))
    connections = opened.agg(F.count(F.lit(1)).alias("connections"), n(c("target_digest").isNotNull() & c("opened_assets").isNotNull() & c("delivers_deltas").isNotNull() & c("fsync_interval_seconds").isNotNull()).alias("complete"), n(c("clock_scope_id").isNotNull() & c("clock_comparable").isNotNull()).alias("scoped"))
    subscribed = opened.where(~c("target_digest").eqNullSafe(F.lit("broadcast"))).select("venue", F.explode("opened_assets").alias("asset_id")).distinct()
    admitted = records if allow_asserted else records.where("provenance = 'captured'")
    watched = subscribed.join(admitted.groupBy("venue", "asset_id").agg(F.bool_or("has_rules").alias("rules"), F.bool_or("has_fees").alias("fees")), ["venue", "asset_id"], "left").agg(n(c("rules")).alias("with_rules"), n(c("fees")).alias("with_fees"), F.count(F.lit(1)).alias("subscribed"))
    catalogue = records.agg(F.count(F.lit(1)).alias("target_records"), n(~c("valid")).alias("invalid"))
    # a sighting that only a later assertion backs counts only where assertions are allowed
    backed = records.groupBy("venue", "asset_id").agg(F.bool_or(c("provenance") == "captured").alias("captured"))
    seen = sightings.groupBy("venue", "asset_id").agg(F.min("created_at").alias("created_at")).join(backed, ["venue", "asset_id"], "left").where(F.lit(allow_asserted) | F.coalesce("captured", F.lit(True)))
    cover = subscribed.join(seen.withColumn("hit", F.lit(True)), ["venue", "asset_id"], "left").agg(F.count(F.lit(1)).alias("subscribed"), n(c("hit").isNull()).alias("uncovered"), n(c("created_at").isNotNull()).alias("with_created_at"))
    wanted = events.where(c("metadata_digest").isNotNull()).select("metadata_digest").distinct()
    missing = wanted.join(snapshots.select("metadata_digest"), "metadata_digest", "left_anti").agg(F.count(F.lit(1)).alias("missing"))
    held = lambda x: (F.coalesce(F.sum(x), F.lit(0)) if x in snapshots.columns else F.lit(0)).alias(x)
    digests = together(snapshots.agg(F.count(F.lit(1)).alias("snapshots"), held("n_targets"), held("n_rules"), held("n_fees")), missing)
    beside = auxiliary.agg(F.count(F.lit(1)).alias("auxiliary")) if auxiliary is not None else lines.select(F.lit(0).alias("auxiliary"))
    trade = kind("trade")
    seen_kinds = events.agg(
        n(poly & kind("full_book") & ~c("independent")).alias("books"), n(poly & kind("book_delta")).alias("changes"), n(poly & kind("full_book") & c("independent")).alias("snapshot_books"),
        n(limitless & kind("full_book")).alias("limitless_books"), n(limitless & kind("full_book") & c("source_version").isNotNull() & c("source_time").isNotNull()).alias("limitless_complete"),
        n(limitless & kind("raw") & (c("note") == "orderbookUpdate")).alias("limitless_broken"), n(poly & trade).alias("trades"),
        n(poly & trade & c("asset_id").isNotNull() & c("price").isNotNull() & c("size").isNotNull() & c("side").isNotNull() & c("source_time").isNotNull() & c("transaction_id").isNotNull()).alias("trades_complete"),
        n(kind("reference_tick")).alias("ticks"), n(kind("reference_tick") & c("source_time").isNotNull()).alias("ticks_stamped"), n(kind("game_state")).alias("games"), n(kind("raw") & (c("note") == "game_state_without_identifier")).alias("games_unkeyed"),
        n(c("lifecycle") == "CREATED").alias("created"), n(c("lifecycle") == "RESOLVED").alias("resolved"),
    )
    hashes = events.where(poly & c("state_hash").isNotNull()).groupBy("state_hash").agg(F.bool_or(~F.coalesce("independent", F.lit(False))).alias("stream"), F.bool_or(F.coalesce("independent", F.lit(False))).alias("snapshot"))
    hashes = hashes.agg(n(c("stream")).alias("hashes"), n(c("stream") & c("snapshot")).alias("overlap"))
    sealed = segments.agg(F.count(F.lit(1)).alias("segments"), n(~c("status").isin("sealed", "empty_but_sealed")).alias("bad"), n(c("status") == "empty_but_sealed").alias("empty"))
    ends = events.where(kind("connection_opened") | kind("connection_closed")).groupBy("lane", "connection_epoch").agg(n(kind("connection_opened")).alias("o"), n(kind("connection_closed")).alias("x"))
    closed = ends.agg(F.sum("o").alias("started"), F.sum("x").alias("closed"), n((c("o") > 0) & (c("x") < c("o"))).alias("unclosed"))
    # one row of all facts, written once: checks that shared a table of facts each went through the events again
    f = materialize(together(lines, beside, breaks, local, connections, watched.drop("subscribed"), catalogue, digests, cover, seen_kinds, hashes, sealed, closed), "facts")
    return _suite([
        judged(f, "byte_and_envelope_integrity", (c("records") > 0) & (c("errors") == 0) & (c("torn") == 0) & (c("auxiliary") == 0), records=c("records"), errors=c("errors"), torn=c("torn"), auxiliary=c("auxiliary")),
        judged(f, "deterministic_capture_order", (c("delivery_breaks") == 0) & (c("local_breaks") == 0), lanes=c("lanes"), delivery_breaks=c("delivery_breaks"), local_breaks=c("local_breaks")),
        judged(f, "receive_clock_provenance", (c("connections") > 0) & (c("v2") == c("records")) & (c("scoped") == c("connections")), v2_records=c("v2"), scoped=c("scoped")),
        judged(f, "subscription_provenance", (c("connections") > 0) & (c("complete") == c("connections")), connections=c("connections"), complete=c("complete")),
        judged(f, "market_rules_and_metadata", (c("n_targets") + c("with_rules") > 0) & (c("with_rules") + c("n_rules") > 0) & (c("invalid") == 0), with_rules=c("with_rules"), snapshot_rules=c("n_rules"), target_records=c("target_records"), invalid=c("invalid")),
        f.select(F.lit("metadata_snapshot_references").alias("name"), F.when(c("snapshots") == 0, "ADVISORY").when(c("missing") == 0, "PASS").otherwise("FAIL").alias("status"), F.create_map(F.lit("missing"), c("missing").cast("string")).alias("evidence")),
        judged(f, "discovery_coverage", (c("subscribed") > 0) & (c("uncovered") == 0) & (c("with_created_at") > 0), subscribed=c("subscribed"), uncovered=c("uncovered"), with_created_at=c("with_created_at")),
        judged(f, "polymarket_book_chain", (c("books") > 0) & (c("changes") > 0) & (c("hashes") > 0), books=c("books"), changes=c("changes"), hashes=c("hashes")),
        judged(f, "polymarket_recovery_anchors", (c("snapshot_books") > 0) & (c("overlap") > 0), snapshot_books=c("snapshot_books"), stream_hash_matches=c("overlap")),
        judged(f, "every_segment_is_sealed", (c("segments") > 0) & (c("bad") == 0), segments=c("segments"), bad=c("bad"), empty=c("empty")),
        judged(f, "limitless_full_books", (c("limitless_books") > 0) & (c("limitless_broken") == 0) & (c("limitless_books") == c("limitless_complete")), books=c("limitless_books"), complete=c("limitless_complete"), broken=c("limitless_broken")),
        judged(f, "trade_and_fill_observability", (c("trades") > 0) & (c("trades") == c("trades_complete")), trades=c("trades"), complete=c("trades_complete")),
        judged(f, "reference_price_observability", (c("ticks") > 0) & (c("ticks_stamped") > 0), ticks=c("ticks"), stamped=c("ticks_stamped")),
        judged(f, "game_event_observability", (c("games") > 0) & (c("games_unkeyed") == 0), games=c("games"), unkeyed=c("games_unkeyed")),
        judged(f, "market_lifecycle_observability", None, created=c("created"), resolved=c("resolved")),
        judged(f, "fee_model_evidence", c("with_fees") + c("n_fees") > 0, with_fees=c("with_fees"), snapshot_fees=c("n_fees")),
        judged(f, "closed_capture_fixture", (c("started") > 0) & (c("unclosed") == 0), started=c("started"), closed=c("closed"), unclosed=c("unclosed")),
    ])


def gate2(gate1_passed: DataFrame, anchors: DataFrame, intervals: DataFrame, markets: DataFrame, evidence: DataFrame) -> DataFrame:
    """Trust: ``gate1_passed`` (passed, one row), ``anchors`` (matched, conflicting, stream_ns, snapshot_ns), ``intervals`` (venue, market, start_ns, end_ns, verdict), ``markets`` (venue, market, start_ns, end_ns, model), ``evidence`` (part, n_rows)."""
    c, n = F.col, F.count_if
    bad_recovery = n(~c("matched") & c("stream_ns").isNotNull() & (c("snapshot_ns") <= c("stream_ns")))
    a = anchors.agg(F.count(F.lit(1)).alias("anchors"), n(c("matched")).alias("matches"), n(c("conflicting")).alias("conflicting"), n(~c("matched")).alias("mismatches"), bad_recovery.alias("unbounded"))
    from pyspark.sql import Window

    w = Window.partitionBy("venue", "market").orderBy("start_ns", "end_ns")
    spans = intervals.withColumn("_next", F.lead("start_ns").over(w)).groupBy("venue", "market").agg(
        F.bool_or((c("start_ns") >= c("end_ns")) | (c("_next") != c("end_ns"))).alias("broken"), F.min("start_ns").alias("lo"), F.max("end_ns").alias("hi"), F.sum(c("end_ns") - c("start_ns")).alias("total"),
    )
    whole = markets.withColumnsRenamed({"start_ns": "m_lo", "end_ns": "m_hi"}).join(spans, ["venue", "market"], "left")
    ok = F.coalesce(~c("broken") & (c("lo") == c("m_lo")) & (c("hi") == c("m_hi")) & (c("total") == c("m_hi") - c("m_lo")), F.lit(False))
    p = whole.agg(F.count(F.lit(1)).alias("markets"), n(~ok).alias("malformed"), F.max(F.when(c("venue") == "polymarket", c("model"))).alias("pm"), F.max(F.when(c("venue") == "limitless", c("model"))).alias("lm"))
    untrusted = intervals.agg(n(c("verdict") == "UNTRUSTED").alias("untrusted"))
    return _suite([
        judged(gate1_passed, "gate_1_precondition", c("passed")),
        judged(a, "polymarket_serializer_bootstrap", (c("anchors") >= MIN_ANCHORS) & (c("matches") >= MIN_MATCH_RATE * c("anchors")) & (c("conflicting") == 0), anchors=c("anchors"), matches=c("matches"), conflicting=c("conflicting")),
        judged(p, "complete_interval_partition", (c("markets") > 0) & (c("malformed") == 0), markets=c("markets"), malformed=c("malformed")),
        judged(p, "venue_specific_trust_models", c("pm") != c("lm"), polymarket=c("pm"), limitless=c("lm")),
        judged(together(a, untrusted), "mismatch_recovery_is_bounded", (c("unbounded") == 0) & ((c("mismatches") == 0) | (c("untrusted") > 0)), mismatches=c("mismatches"), untrusted=c("untrusted")),
        _evidence(evidence, "mandatory_analysis_evidence"),
    ])


def _evidence(evidence: DataFrame, name: str) -> DataFrame:
    """A result is whole only with intervals, coverage, hash rate and skew strata, each of a row at least."""
    parts = ("intervals", "coverage", "hash_rate", "skew_strata")
    have = evidence.where((F.col("n_rows") > 0) & F.col("part").isin(*parts)).agg(F.count_distinct("part").alias("have"), F.count(F.lit(1)).alias("all"))
    return judged(have, name, F.col("have") == len(parts), parts=F.col("have"))


def gate3(gate2_passed: DataFrame, walks: DataFrame, baskets: DataFrame, evidence: DataFrame, ticket: int = TICKET) -> DataFrame:
    """Economics: ``walks`` (vwap, depth_limited, filled, expected_vwap, expected_limited, expected_filled) of known ladders, ``baskets`` (market, direction, size, headline, net, fees_complete, depth_limited, exclusion, feasible, cross_venue, placebo_status, placebo_market, placebo_net)."""
    c, n = F.col, F.count_if
    same = c("vwap").eqNullSafe(c("expected_vwap")) & (c("depth_limited") == c("expected_limited")) & (c("filled") == c("expected_filled"))
    w = walks.agg(F.count(F.lit(1)).alias("walks"), n(~same).alias("wrong"))
    headline = (c("direction") == "long") & (c("size") == ticket) & c("headline")
    complete = headline & c("net").isNotNull() & c("fees_complete") & ~c("depth_limited")
    valid_long = (c("direction") == "long") & c("exclusion").isNull()
    matched = c("placebo_status") == "MATCHED"
    b = baskets.agg(
        F.count(F.lit(1)).alias("rows"), n(headline).alias("headline_rows"), n(complete).alias("complete"), n(valid_long).alias("valid_long"), n(valid_long & F.coalesce("feasible", F.lit(False))).alias("feasible"),
        n(matched).alias("placebos"), n(matched & ((c("placebo_market") == c("market")) | c("placebo_net").isNull())).alias("bad_placebos"), n(c("cross_venue")).alias("cross_venue_rows"),
    )
    return _suite([
        judged(gate2_passed, "gate_2_precondition", c("passed")),
        judged(w, "share_matched_vwap_depth", (c("walks") > 0) & (c("wrong") == 0), walks=c("walks"), wrong=c("wrong")),
        judged(b, "deployable_ticket_net_of_conservative_fees", (c("headline_rows") > 0) & (c("complete") == c("headline_rows")), headline=c("headline_rows"), complete=c("complete")),
        judged(b, "symbolic_subset_cover_lp", (c("valid_long") > 0) & (c("feasible") == c("valid_long")), valid_long=c("valid_long"), feasible=c("feasible")),
        judged(b, "matched_leg_placebo_null", (c("placebos") > 0) & (c("bad_placebos") == 0), placebos=c("placebos"), bad=c("bad_placebos")),
        judged(b, "condition_identity_guard", c("cross_venue_rows") == 0, cross_venue=c("cross_venue_rows")),
        _evidence(evidence, "mandatory_economic_evidence"),
    ])


def gate4(gate3_passed: DataFrame, episodes: DataFrame, lifetimes: DataFrame, candidates: DataFrame, estimates: DataFrame, evidence: DataFrame) -> DataFrame:
    """Execution: ``episodes`` (venue), ``lifetimes`` (venue, direction, verdict, uncensored, p50, p90, p99), ``candidates`` (basket, net), ``estimates`` (basket, estimator, not_a_fill_claim)."""
    c, n = F.col, F.count_if
    e = episodes.agg(F.count(F.lit(1)).alias("episodes"), F.bool_or(c("venue") == "polymarket").alias("pm"), F.bool_or(c("venue") == "limitless").alias("lm"))
    t = lifetimes.where("venue = 'polymarket' AND direction = 'long' AND verdict = 'TRUSTED'").agg(F.count(F.lit(1)).alias("rows"), n((c("uncensored") > 0) & c("p50").isNotNull() & c("p90").isNotNull() & c("p99").isNotNull()).alias("full"))
    s = estimates.agg(F.count(F.lit(1)).alias("estimates"), n(c("not_a_fill_claim") & (c("estimator") == ESTIMATOR)).alias("named"))
    positive = candidates.where("net > 0").groupBy("basket").agg(F.count(F.lit(1)).alias("want"))
    each = positive.join(estimates.groupBy("basket").agg(F.count(F.lit(1)).alias("got")), "basket", "full").agg(F.coalesce(F.sum("want"), F.lit(0)).alias("positive"), n(~c("want").eqNullSafe(c("got"))).alias("unequal"))
    return _suite([
        judged(gate3_passed, "gate_3_precondition", c("passed")),
        judged(e, "venue_book_state_replay", c("pm") & c("lm"), episodes=c("episodes")),
        judged(t, "quote_lifetime_distribution", (c("rows") == 1) & (c("full") == 1), rows=c("rows")),
        judged(s, "explicit_non_fill_estimator", c("named") == c("estimates"), estimates=c("estimates"), named=c("named")),
        judged(each, "candidate_accounting", c("unequal") == 0, positive=c("positive"), unequal=c("unequal")),
        _evidence(evidence, "mandatory_execution_evidence"),
    ])
