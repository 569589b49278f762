"""Tape, history and catalogue sources, typed events, suites: literal cases."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from ticktide.plans import events, suites
from ticktide.sources import history, tape
from ticktide.streaming import windows


def envelope(n, **over):
    row = {
        "envelope_version": 2, "delivery_index": n, "record_id": f"pm-a-{n}", "visible_ns": 100 + n, "monotonic_ns": 50 + n, "venue": "polymarket", "stream": "public_book",
        "connection_epoch": "a", "local_counter": n, "source_cursor": {"type": "unsequenced", "counter": n}, "kind": "venue_frame", "raw_payload": "{}",
    }
    row.update(over)
    return {k: v for k, v in row.items() if v is not ...}


@pytest.fixture
def root(tmp_path):
    lane = tmp_path / "spool/lane=polymarket/date=2026-08-03"
    lane.mkdir(parents=True)
    good = "".join(json.dumps(envelope(i)) + "\n" for i in (1, 2, 3))
    (lane / "seg.ndjson").write_text(good)
    (lane / "torn.ndjson").write_text(json.dumps(envelope(4)) + "\n" + json.dumps(envelope(5)))
    (lane / "empty.ndjson").write_text("")
    (lane / "x.ndjson.open").write_text("no")
    seal = {"seal_version": 1, "lane_id": "polymarket", "window_start_ns": 0, "window_end_ns": 1000, "byte_length": len(good), "line_count": 3, "sha256": hashlib.sha256(good.encode()).hexdigest(), "first_delivery_index": 1, "last_delivery_index": 3, "first_visible_ns": 101, "last_visible_ns": 103}
    (lane / "seg.seal.json").write_text(json.dumps(seal))
    (lane / "empty.seal.json").write_text(json.dumps({**seal, "byte_length": 0, "line_count": 0, "sha256": hashlib.sha256(b"").hexdigest(), "first_delivery_index": None, "last_delivery_index": None, "first_visible_ns": None, "last_visible_ns": None}))
    (lane / "gone.seal.json").write_text(json.dumps(seal))
    return f"file://{tmp_path}/spool"


def test_lines_seals_and_manifest(spark, root):
    objects = tape.objects(spark, root)
    got = sorted((r.object_key.split("/")[-1], r.line_number, r.torn) for r in tape.lines(objects).collect())
    assert got == [("seg.ndjson", 1, False), ("seg.ndjson", 2, False), ("seg.ndjson", 3, False), ("torn.ndjson", 1, False), ("torn.ndjson", 2, True)]
    first = {r.line_number: r.byte_offset for r in tape.lines(objects).where(F.col("object_key").endswith("seg.ndjson")).collect()}
    assert first[1] == 0 and first[2] == len(json.dumps(envelope(1))) + 1
    m, s = tape.manifest(objects), tape.seals(spark, root)
    status = {r.object_key.split("/")[-1]: r.status for r in tape.verify_seals(m, s).collect()}
    assert status == {"seg.ndjson": "sealed", "torn.ndjson": "unsealed", "empty.ndjson": "empty_but_sealed", "gone.ndjson": "absent"}
    assert tape.dataset_hash(m).first() == tape.dataset_hash(m.orderBy(F.desc("object_key"))).first()
    assert sorted(r.object_key.split("/")[-1] for r in tape.sealed_segments(m, s).collect()) == ["seg.ndjson"]
    env = tape.parsed(tape.lines(objects))
    valid = {r.object_key.split("/")[-1]: r.faults for r in tape.validated_segments(m, s, env).collect()}
    assert valid["seg.ndjson"] == [] and valid["empty.ndjson"] == [] and "absent" in valid["gone.ndjson"]


def test_lane_and_admission(spark):
    df = spark.createDataFrame([("spool/lane=kalshi/date=x/a.ndjson",), ("spool/venue=b/date=x/a.seal.json",), ("live/metadata/v/d.json",), ("spool/lane=k/a.ndjson.open",), ("spool/lane=k/a.ndjson.zst",)], "p string")
    assert [r[0] for r in df.select(tape.admitted(F.col("p"))).collect()] == [True, True, True, False, False]
    assert [r[0] for r in df.where("p LIKE '%date=x%'").select(tape.lane_of(F.col("p"))).collect()] == ["kalshi", "b"]
    with pytest.raises(Exception, match="no lane"):
        df.where("p LIKE 'live%'").select(tape.lane_of(F.col("p"))).collect()


def test_envelope_contract(spark):
    v1 = {k: v for k, v in envelope(1).items() if k not in ("envelope_version", "monotonic_ns")}
    cases = [
        (envelope(1), None), (v1, None), (envelope(1, extra=1), "field_set"), (envelope(1, venue=...), "field_set"), (envelope(1, delivery_index="1"), "counter_type"), (envelope(1, visible_ns=-5), "counter_type"),
        (envelope(1, local_counter=True), "counter_type"), (envelope(1, record_id="é"), "id_not_ascii"), (envelope(1, kind="other"), "kind"), ([1], "not_an_object"),
    ]
    df = spark.createDataFrame([(i, json.dumps(c)) for i, (c, _) in enumerate(cases)] + [(99, "not json")], "i int, value string")
    got = {r.i: r.error for r in tape.parsed(df).collect()}
    assert got == {**{i: e for i, (_, e) in enumerate(cases)}, 99: "not_an_object"}
    row = tape.parsed(df).where("i = 0").first()
    assert row.source_cursor.counter == 1 and row.raw_line_sha256 == hashlib.sha256(json.dumps(cases[0][0]).encode()).hexdigest()


def test_composite_receipts_late(spark):
    a, b = spark.createDataFrame([("x",), ("y",)], "object_key string"), spark.createDataFrame([("y",)], "object_key string")
    assert {(r.object_key, r.duplicated) for r in tape.composite(a, b).collect()} == {("x", False), ("y", True)}
    seg = spark.createDataFrame([("l", "f", 1, "h"), ("l", "g", 2, "h")], "lane_id string, data_file string, segment_index long, sha256 string")
    assert [r.data_file for r in tape.late_segments(seg, seg.limit(1)).collect()] == ["g"]
    w = spark.createDataFrame([(0, "a", True), (0, "b", False), (0, "z", True), (10, "a", True), (10, "b", True)], "window_start_ns long, lane_id string, valid boolean")
    r = {x.window_start_ns: x for x in tape.window_receipts(w, spark.createDataFrame([("a",), ("b",)], "lane_id string")).collect()}
    assert r[0].invalid == ["b"] and r[0].unexpected == ["z"] and not r[0].complete and r[10].complete


def typed(spark, *frames):
    base = [(i, *f) for i, f in enumerate(frames)]
    return {r.i: r for r in events.normalize(spark.createDataFrame(base, "i int, kind string, stream string, venue string, raw_payload string")).where("event_index % 1000000 = 0").collect()}


def test_typed_events(spark):
    book = {"event_type": "book", "market": "m", "asset_id": "a", "bids": [{"price": "0.4", "size": "5"}], "asks": [{"price": 0.6, "size": "1"}], "hash": "h", "timestamp": "1"}
    frame = lambda p, stream="public_book", venue="polymarket": ("venue_frame", stream, venue, json.dumps(p))
    update = {"event": "orderbookUpdate", "data": {"marketSlug": "s", "version": 4, "orderbook": {"bids": [], "asks": []}}}
    got = typed(
        spark, frame(book), frame({**book, "bids": [{"price": "x", "size": "5"}]}), frame({"event_type": "last_trade_price", "asset_id": "a", "price": "0.5", "size": "2", "side": "buy"}),
        frame({"event": "connection_opened", "target_metadata_digest": "d", "asset_ids": ["a", 7]}, "process"), frame({"event": "target_metadata_changed"}, "process"), frame({"event_type": "last_trade_price", "asset_id": "a", "price": True, "size": "2", "side": "BUY"}),
        frame({"payload": {"symbol": "btc", "value": 1.5, "full_accuracy_value": "1.25"}}, "reference_event"), ("venue_frame", "public_book", "polymarket", "no json"), frame({"event_type": "market_resolved", "condition_id": "m"}), frame(update, venue="limitless"),
        frame({**book, "asset_id": None, "asset": "b"}, "public_snapshot"), frame({"market": "m"}, "public_snapshot"), frame({"payload": {"symbol": "x", "value": "oops"}}, "reference_event"), frame([7]), frame({"event": "hello"}, venue="kalshi"), frame({**book, "bids": None}), frame({}, "process"),
    )
    kinds = ["full_book", "raw", "trade", "connection_opened", "raw", "raw", "reference_tick", "raw", "market_lifecycle", "full_book", "full_book", "raw", "reference_tick", "raw", "raw", "raw", "raw"]
    assert [got[i].event_kind for i in range(17)] == kinds
    assert [got[i].note for i in (1, 4, 5, 7, 11, 13, 14, 16)] == ["book", "target_metadata_changed", "last_trade_price", "text", "snapshot", "not_an_object", "hello", "control"]
    assert str(got[0].bids[0].price) == "0.40000000" and str(got[0].asks[0].price) == "0.60000000" and got[2].side == "BUY" and float(got[6].price) == 1.25 and got[3].metadata_digest == "d"
    assert got[9].asset_id == "s" and got[9].independent and got[9].source_version == "4" and got[10].asset_id == "b" and got[10].independent and not got[0].independent
    assert got[8].market == "m" and got[8].lifecycle == "RESOLVED" and got[12].price is None and got[3].opened_assets == ["a", "7"]


def test_game_frames(spark):
    base = {"gameId": 7, "homeTeam": "x", "awayTeam": "y", "leagueAbbreviation": "l", "status": "live", "score": "0-0", "period": "P1", "live": True, "ended": False}
    frames = [
        base, {**base, "eventState": {"status": "other", "score": "1-0", "period": None, "ended": True, "updatedAt": "u", "createdAt": "c"}}, {"metadataGameId": "g2", "homeTeam": "x"}, {"homeTeam": "x"},
        {"gameId": None, "metadataGameId": 3, "eventState": "no object", "live": "yes"}, {"eventState": {"score": "2"}},
    ]
    got = typed(spark, *(("venue_frame", "reference_event", "polymarket", json.dumps(x)) for x in frames))
    assert [got[i].event_kind for i in range(6)] == ["game_state"] * 3 + ["raw", "game_state", "raw"]
    assert got[3].note == got[5].note == "game_state_without_identifier"
    a, b = got[0].game, got[1].game
    assert (a.game_id, a.game_id_field, a.status, a.score, a.period, a.live, a.ended, a.state_updated_at) == ("7", "gameId", "live", "0-0", "P1", True, False, None)
    assert (b.status, b.score, b.period, b.live, b.ended, b.state_updated_at, b.state_created_at) == ("live", "1-0", None, True, True, "u", "c")
    assert got[2].game.game_id_field == "metadataGameId" and got[4].game.game_id == "3" and got[4].game.live is None


def test_price_changes_are_exploded(spark):
    p = [{"event_type": "price_change", "market": "m", "price_changes": [{"asset_id": "a", "side": "BUY", "price": "0.1", "size": "0", "hash": "h"}, {"asset_id": "b", "side": "sell", "price": "0.2", "size": "3", "hash": "h"}, {"asset_id": "b"}, 5]}] * 2
    df = spark.createDataFrame([("venue_frame", "public_book", "polymarket", json.dumps(p)), ("venue_frame", "public_book", "polymarket", '{"event_type":"price_change","price_changes":[]}')], "kind string, stream string, venue string, raw_payload string")
    got = [(r.event_index, r.event_kind, r.asset_id, r.side, None if r.size is None else float(r.size), r.note) for r in events.normalize(df).orderBy("event_index").collect()]
    one = lambda m: [(m, "book_delta", "a", "BUY", 0.0, None), (m + 1, "book_delta", "b", "SELL", 3.0, None), (m + 2, "raw", None, None, None, "unparseable_price_change"), (m + 3, "raw", None, None, None, "unparseable_price_change")]
    assert got == one(0) + one(1000000)


def test_projection_and_instruments(spark):
    rec = {"clobTokenIds": '["t0","t1"]', "outcomes": '["Yes","No"]', "orderMinSize": "5", "feesEnabled": False, "note": None, "volume": 1}
    df = spark.createDataFrame([("v", "t1", json.dumps(rec)), ("v", "zz", json.dumps({**rec, "volume": 2, "feesEnabled": True, "feeSchedule": {"rate": 0.1}}))], "venue string, asset_id string, record string")
    got = events.instruments(df).orderBy("asset_id").collect()
    assert (got[0].outcome_index, got[0].outcome, got[0].minimum, got[0].fee_rate, got[0].fee_complete) == (1, "No", 5.0, 0.0, True)
    assert got[1].outcome_index is None and not got[1].fee_complete
    h = [r[0] for r in df.select(events.projection_hash(F.col("record"), ["outcomes", "note", "absent"])).collect()]
    assert h[0] == h[1]
    assert df.select(events.projected(F.col("record"), ["note", "absent"])).first()[0] == {"note": "null"}


def test_votes_fees_and_instants(spark):
    v = spark.createDataFrame([("k", "b"), ("k", "a"), ("l", "c"), ("l", "c")], "k string, p string")
    assert {tuple(r) for r in events.pair_by_vote(v, "k", "p").collect()} == {("k", "a", True), ("l", "c", False)}
    t = events.fee_timeline(spark.createDataFrame([("k", 1.0)], "k string, m double"), spark.createDataFrame([("k", 10, 2.0)], "k string, at long, m double"), "k", "at", "m")
    assert [(r["at"], r.m, r.until) for r in t.orderBy("at").collect()] == [(-1, 1.0, 10), (10, 2.0, None)]
    s = spark.createDataFrame([([1.0, 0.0],), ([0.5, 0.5],), ([0.2, 0.8],)], "p array<double>")
    assert [r[0] for r in s.select(events.settled_outcome(F.col("p"), F.array(F.lit("Y"), F.lit("N")))).collect()] == ["Y", "FIFTY_FIFTY", None]
    i = spark.createDataFrame([([1, 2], [5, 5])], "a array<long>, b array<long>").select(events.first_agreed_instant({"a": F.col("a"), "b": F.col("b")}).alias("r")).first().r
    assert (i.instant, i.field, i.disagreeing) == (5, "b", ["a"])
    c = spark.createDataFrame([("kalshi", '{"seq":4}'), ("x", '{"data":{"version":9}}'), ("x", "{}")], "v string, p string")
    assert [r[0].type for r in c.select(events.derived_cursor(F.col("p"), F.col("v")).alias("c")).collect()] == ["update_range", "snapshot", "unsequenced"]


def test_nested_fee_records(spark):
    rec = lambda c, **k: {"conditionId": c, "feesEnabled": True, "feeType": "t", "feeSchedule": {"rate": 0.1, "exponent": 2}, **k}
    docs = [
        {"markets": [rec("a", createdAt="2024-02-02"), {"deep": {"er": [[rec("a", createdAt="2024-01-01", updatedAt="2024-03-03")]]}}]}, [rec("b"), rec("b", feeSchedule={"rate": 0.2})],
        {"conditionId": "c", "feesEnabled": False}, {"conditionId": "d", "question": "no fees here"}, rec("e", feeSchedule=None), {**rec("f"), "child": {"conditionId": "g", "feesEnabled": False, "createdAt": ""}},
    ]
    df = spark.createDataFrame([(json.dumps(d),) for d in docs] + [("not json",)], "p string")
    wanted = spark.createDataFrame([(c,) for c in "abcdefgh"], "condition_id string")
    got = {r.condition_id: r for r in events.fee_records(wanted, events.nested_fee_records(df, "p")).collect()}
    assert {k: r.status for k, r in got.items()} == {"a": "found", "b": "conflict", "c": "found", "d": "missing", "e": "missing_schedule", "f": "found", "g": "found", "h": "missing"}
    assert (got["a"].rate, got["a"].exponent, got["a"].created_at, got["a"].updated_at, got["a"].fee_type) == (0.1, 2.0, "2024-01-01", "2024-03-03", "t")
    assert (got["c"].rate, got["c"].exponent, got["c"].fee_type, got["g"].created_at) == (0.0, 1.0, "no_fee", None)


def test_catalogue_integrity(spark):
    e = spark.createDataFrame([("a",), ("a",), ("b",)], "event_id string")
    m = spark.createDataFrame([(1, "a", 1.0, ["t"]), (1, "zz", float("nan"), []), (2, "b", 1.0, ["t", "t"])], "market_id long, event_id string, volume double, subscription_ids array<string>")
    assert sorted(tuple(r) for r in events.integrity_violations(e, m).collect()) == [("dangling_event", "1"), ("event_repeated", "a"), ("market_repeated", "1"), ("subscriptions", "1"), ("subscriptions", "2"), ("volume_not_finite", "1")]


def test_history(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"ticker":"t","end_period_ts":60,"yes_bid":{"close_dollars":"0.4"},"yes_ask":{"close_dollars":"x"}}\n\n')
    assert [tuple(r) for r in history.candles(spark, f"file://{tmp_path}/c.json").collect()] == [("t", 60, 0.4, None)]
    runs = spark.createDataFrame([(1, "a"), (5, "b"), (7, "c"), (20, "d")], "at long, run string")
    assert sorted((r.run, r.predecessor) for r in history.selected_runs(runs, 6, 10).collect()) == [("b", True), ("c", False)]
    with pytest.raises(ValueError, match="no evidence: trust"):
        history.write_result(runs, {"trust": runs.limit(0), "coverage": runs}, f"file://{tmp_path}/out")
    history.write_result(runs, {"coverage": runs}, f"file://{tmp_path}/out")
    assert spark.read.parquet(f"file://{tmp_path}/out/result").count() == 4


def test_suites(spark):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    s = suites.suite([suites.check(df, "a", F.max("x") > 1, most=F.max("x")), suites.check(df.limit(0), "b", F.lit(True)), suites.check(df, "c", F.max("x") > 5)])
    assert {r.name: r.status for r in s.collect()} == {"a": "PASS", "b": "NOT_PRESENT", "c": "FAIL"}
    assert suites.verdict(s).first().verdict == "FAIL" and suites.verdict(s, advisory=("c",)).first().verdict == "INCOMPLETE" and suites.verdict(s.where("name = 'a'")).first().verdict == "PASS"
    lag = suites.coverage_lag(spark.createDataFrame([(i,) for i in range(10)] + [(None,)], "l int"), "l").first()
    assert tuple(lag) == (11, 10, 5, 9, 9)
    kept = suites.retention_verdict(df, [("first", F.col("x") == 1), ("second", F.col("x") < 2)])
    assert [r.keep_because for r in kept.orderBy("x").collect()] == ["first", None]


def test_stateful_processors_are_used_by_queries():
    assert windows.CONTINUITY.startswith("user_id") and windows.BOOKS.startswith("asset")


def test_lines_do_not_carry_their_segment(spark, tmp_path):
    (tmp_path / "lane=a").mkdir()
    (tmp_path / "lane=a" / "seg.ndjson").write_bytes("é1\n\n33\n4".encode())
    out = tape.lines(tape.objects(spark, f"file://{tmp_path}"))
    above, below = out._jdf.queryExecution().optimizedPlan().toString().split("Generate", 1)
    assert "content" in below and "content" not in above  # else each line holds a copy of its segment, which grows with the square
    assert [tuple(r)[1:] for r in out.orderBy("line_number").collect()] == [(1, 0, "é1", False), (2, 4, "", False), (3, 5, "33", False), (4, 8, "4", True)]


def test_a_line_is_parsed_once(spark):
    plan = tape.parsed(spark.createDataFrame([("{}",)], "value string"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("json_tuple(") == 1 and "get_json_object(" not in plan
