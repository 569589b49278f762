"""Reconciliation, audits and reports on literal cases."""

import hashlib

from pyspark.sql import functions as F

from ticktide.operators import reconcile as R


def test_resolutions(spark):
    got = spark.createDataFrame([("h1", "m", "Yes", 0, 1), ("h1", "m", "Yes", 0, 2), ("h2", "n", "No", 0, 1), ("h3", "zz", "Yes", 0, 1), ("h4", "o", "Maybe", 0, 1)], "semantic_hash string, market string, outcome string, outcome_index int, seq long")
    cat = spark.createDataFrame([("m", ["Yes", "No"]), ("n", ["Yes", "No"]), ("o", ["Yes"])], "market string, outcomes array<string>")
    assert {(r.semantic_hash, r.deliveries, r.status) for r in R.resolutions(got, cat).collect()} == {("h1", 2, "consistent"), ("h2", 1, "index_mismatch"), ("h3", 1, "unknown_market"), ("h4", 1, "outcome_not_listed")}


def test_audited_window(spark):
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    e = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (4, "c", "z")], "seq long, record_id string, line string")
    p = spark.createDataFrame([(1, "a", sha("x"), "s", 1), (2, "B", sha("y"), "s", 9), (3, "d", sha("q"), "s", 2)], "seq long, record_id string, line_sha256 string, source string, source_line long")
    r = R.audited_window(e, p, spark.createDataFrame([("s", 5)], "source string, line_count long")).first()
    assert tuple(r) == (1, 1, 1, 0, 1, True)


def test_watched_and_records(spark):
    s = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "asset string")
    e = spark.createDataFrame([("a", "captured"), ("a", "asserted"), ("b", "asserted")], "asset string, provenance string")
    assert {tuple(r) for r in R.watched(s, e, "asset").collect()} == {("a", True, True), ("b", False, True), ("c", False, False)}
    found, missing = R.target_records(s.distinct(), spark.createDataFrame([("a", "{}")], "asset string, record string"), ["asset"], "record")
    assert found.count() == 1 and missing.count() == 2


def test_attached_and_fixture(spark):
    c = spark.createDataFrame([(1, ["x", "y"], 5), (2, ["x", "z"], 5)], "id int, p array<string>, x long")
    g = spark.createDataFrame([("g", ["y", "x"], 5)], "grp string, p array<string>, x long")
    assert {(r.id, r.grp) for r in R.attached(c, g, "p", "x", "grp").collect()} == {(1, "g"), (2, None)}
    t = spark.createDataFrame([("KX-ALPBET",), ("KX-NONE",)], "t string")
    assert [r[0] for r in t.select(R.fixture_of(t, "t", [("ALPBET", "f1"), ("ALP", "f2")])).collect()] == ["f1", None]


def test_view_and_violations(spark):
    sel = spark.createDataFrame([("a",), ("b",)], "bundle string")
    cand = spark.createDataFrame([("a", 1.0, None, 5.0), ("b", 9.0, 2.0, None)], "bundle string, score_rank double, score_relation double, score_activity double")
    cont = spark.createDataFrame([("a", "retained")], "bundle string, disposition string")
    tg = spark.createDataFrame([("a",), ("a",)], "bundle string")
    assert [tuple(r) for r in R.selection_view(sel, cand, cont, tg).collect()] == [("b", 9.0, None, 0), ("a", 5.0, "retained", 2)]
    x = spark.createDataFrame([(1, "p", 1), (2, "q", 2)], "k int, c string, n int")
    y = spark.createDataFrame([(1, "P", 1), (3, "q", 2)], "k int, c string, n int")
    assert {(r.k, r.column) for r in R.report_violations(x, y, ["k"], ["c", "n"]).collect()} == {(1, "c"), (2, "*missing_in_archive"), (3, "*missing_in_report")}


def test_manifest_signals_counters(spark):
    v = spark.createDataFrame([("t1", "v", "moneyline"), ("t2", "v", "other"), ("t3", "w", "moneyline")], "target_id string, venue string, market_type string")
    rows, counts = R.history_targets([v], spark.createDataFrame([("t3",)], "target_id string"), ["moneyline"])
    assert [r.target_id for r in rows.collect()] == ["t1"] and counts.first()["n"] == 1
    one = lambda c: spark.createDataFrame([("a", 5)], f"asset string, {c} long")
    assert [r.priority for r in R.trust_signals(one("at"), one("at"), one("at"), one("doubt_from")).orderBy("priority").collect()] == [0, 1, 2, 3]
    a = spark.createDataFrame([("m", "h1"), ("m", "h2"), ("m", None)], "m string, h string")
    assert tuple(R.hash_overlap(a, a.where("h = 'h1'"), ["m", "h"]).first()) == (2, 1, 1)
    av = R.availability(spark.createDataFrame([("e", "x"), ("e", "y"), ("f", "x")], "e string, v string"), "e", "v", ["x", "y"])
    assert {tuple(r) for r in av.collect()} == {("e", 1, 1, True), ("f", 1, 0, False)}
    vol = R.volume_admission(spark.createDataFrame([("e", "x", 5.0), ("e", "y", None)], "e string, v string, usd double"), "e", "v", "usd", ["x", "y"], 5.0).first()
    assert (vol.x, vol.y, vol.known_usd, vol.unknown_markets, vol.admitted) == (5.0, None, 5.0, 1, True)


def test_rules_helpers(spark):
    df = spark.createDataFrame([("Starts March 3, 2026 at 5:30 PM ET. Again March 3, 2026 at 5:30 PM.",), ("March 3, 2026 at 5:30 PM or March 4, 2026 at 5:30 PM",), ("none",)], "t string")
    assert [r[0] for r in df.select(R.scheduled_instant(F.col("t"))).collect()] == [1772577000000000, None, None]
    c = spark.createDataFrame([("The winner including overtime, not counting shootouts",)], "t string")
    assert c.select(R.contradictions(c, "t", ["overtime", "shootouts"], ["not counting shootouts"])).first()[0] == ["shootouts"]
    s = spark.createDataFrame([(True, 1, 1, 5, 10), (True, 2, 1, 7, 20), (False, None, 1, None, 30)], "s boolean, prev long, held long, lat long, size long")
    got = {r.s: (r.checked, r.broken, r.fulfilled, r.median_latency) for r in R.solicited_continuity(s, "s", "prev", "held", "lat", "size").collect()}
    assert got == {True: (2, 1, 2, 6.0), False: (0, 0, 0, None)}
