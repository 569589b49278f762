"""Gates fail where evidence is absent: a thin tape, a tape without lines, no segments."""

import json

import pytest
from pyspark.sql import functions as F

from ticktide.plans import envelope_queries, events, gates
from ticktide.sources import tape

from .test_sources import envelope

ADVISORY = {"market_lifecycle_observability", "metadata_snapshot_references"}


def suite(spark, tmp_path, lines, records=(), snapshots="metadata_digest string", auxiliary=None):
    lane = tmp_path / "spool/lane=polymarket/date=2026-01-01"
    lane.mkdir(parents=True)
    (lane / "a.ndjson").write_text("".join(json.dumps(x) + "\n" for x in lines))
    parsed = tape.parsed(tape.lines(tape.objects(spark, f"file://{tmp_path}/spool"))).withColumn("lane", tape.lane_of(F.col("object_key")))
    segments = spark.createDataFrame([], "object_key string, status string")
    rows = spark.createDataFrame(list(records), "venue string, asset_id string, provenance string, has_rules boolean, has_fees boolean, valid boolean")
    sightings = spark.createDataFrame([], "venue string, asset_id string, created_at long")
    shots = snapshots if not isinstance(snapshots, str) else spark.createDataFrame([], snapshots)
    return {r.name: r.status for r in gates.gate1(parsed, events.normalize(parsed.where("error IS NULL")), segments, rows, sightings, shots, auxiliary=auxiliary).collect()}


def thin():
    opened = {"event": "connection_opened", "target_digest": "x", "target_metadata_digest": "missing", "asset_ids": ["asset"], "delivers_deltas": True, "fsync_interval_seconds": 0.25, "clock_scope": {"scope_id": "boot", "comparable_across_processes": True}}
    book = {"event_type": "book", "market": "m", "asset_id": "asset", "bids": [], "asks": [], "hash": "h"}
    payloads = [(opened, "process"), (book, "public_book"), ({"event": "connection_closed"}, "process")]
    return [envelope(i, stream=s, raw_payload=json.dumps(p)) for i, (p, s) in enumerate(payloads, 1)]


def test_a_thin_tape_fails_and_names_what_is_missing(spark, tmp_path):
    got = suite(spark, tmp_path, thin())
    failed = {n for n, s in got.items() if s == "FAIL"}
    assert {"market_rules_and_metadata", "polymarket_recovery_anchors", "trade_and_fill_observability", "game_event_observability", "every_segment_is_sealed", "discovery_coverage", "fee_model_evidence", "limitless_full_books", "reference_price_observability"} <= failed
    assert {n for n, s in got.items() if s == "ADVISORY"} == ADVISORY and len(got) == 17
    assert {got[n] for n in ("byte_and_envelope_integrity", "receive_clock_provenance", "subscription_provenance", "closed_capture_fixture")} == {"PASS"}


def test_one_line_or_none_proves_nothing(spark, tmp_path):
    for i, lines in enumerate(([envelope(1)], [])):
        got = suite(spark, tmp_path / str(i), lines)
        passed = {n for n, s in got.items() if s == "PASS"}
        assert passed == ({"byte_and_envelope_integrity", "deterministic_capture_order"} if lines else {"deterministic_capture_order"})
        assert {n for n, s in got.items() if s == "ADVISORY"} == ADVISORY


def test_rules_and_fees_may_be_in_snapshots_and_unread_objects_fail(spark, tmp_path):
    shots = spark.createDataFrame([("missing", 1, 1, 1)], "metadata_digest string, n_targets long, n_rules long, n_fees long")
    broken = spark.createDataFrame([("live/coverage.json", "not JSON")], "object_key string, error string")
    got = suite(spark, tmp_path, thin(), snapshots=shots, auxiliary=broken)
    assert {got[n] for n in ("market_rules_and_metadata", "fee_model_evidence", "metadata_snapshot_references")} == {"PASS"} and got["byte_and_envelope_integrity"] == "FAIL"


def test_a_record_for_an_asset_nobody_watched_proves_nothing(spark, tmp_path):
    got = suite(spark, tmp_path, thin(), records=[("polymarket", "never-subscribed", "captured", True, True, True)])
    assert {got[n] for n in ("market_rules_and_metadata", "fee_model_evidence", "discovery_coverage")} == {"FAIL"}


@pytest.mark.parametrize("empty", [True, False])
def test_later_gates_fail_on_absence(spark, empty):
    none = lambda schema: spark.createDataFrame([], schema)
    passed = spark.createDataFrame([(True,)], "passed boolean")
    evidence = none("part string, n_rows long") if empty else spark.createDataFrame([(p, 1) for p in ("intervals", "coverage", "hash_rate", "skew_strata")], "part string, n_rows long")
    two = {r.name: r.status for r in gates.gate2(passed, none("matched boolean, conflicting boolean, stream_ns long, snapshot_ns long"), none("venue string, market long, start_ns long, end_ns long, verdict string"), none("venue string, market long, start_ns long, end_ns long, model string"), evidence).collect()}
    assert {n for n, s in two.items() if s == "PASS"} == {"gate_1_precondition", "mismatch_recovery_is_bounded"} | (set() if empty else {"mandatory_analysis_evidence"})
    four = {r.name: r.status for r in gates.gate4(passed, none("venue string"), none("venue string, direction string, verdict string, uncensored long, p50 long, p90 long, p99 long"), none("basket long, net double"), none("basket long, estimator string, not_a_fill_claim boolean"), evidence).collect()}
    assert {n for n, s in four.items() if s == "FAIL"} == {"venue_book_state_replay", "quote_lifetime_distribution"} | ({"mandatory_execution_evidence"} if empty else set())


def test_facts_are_gathered_once_and_segments_go_to_all_tasks(spark, sf, tmp_path):
    lines = envelope_queries.segments(spark, sf)
    assert lines.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    typed = events.normalize(lines.where("error IS NULL"))
    none = lambda schema: spark.createDataFrame([], schema)
    records = none("venue string, asset_id string, provenance string, has_rules boolean, has_fees boolean, valid boolean")
    suite = gates.gate1(lines, typed, none("object_key string, status string"), records, none("venue string, asset_id string, created_at long"), none("metadata_digest string"))
    assert "raw_payload" not in suite._jdf.queryExecution().optimizedPlan().toString()  # 17 checks read one row
    assert suite.count() == 17
