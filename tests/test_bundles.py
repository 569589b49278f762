"""Fixtures of several venues: rejections, formats that siblings set, a block of many times."""

from pyspark.sql import functions as F

from ticktide.operators import bundles, intervals

EVENT = "ref string, venue string, sport string, game string, topology string, fmt string, one string, two string, at long, anchor boolean"


def event(ref, at, anchor=True, fmt=None, game="g", one="Red Team", two="Blue"):
    return (ref, ref.split(":")[0], "s", game, None, fmt, one, two, at, anchor)


def match(spark, rows, evidence=(), aliases=(), tolerance=10):
    ev = spark.createDataFrame(list(evidence), "ref string, instant long, rank int, field string")
    al = spark.createDataFrame(list(aliases), "name string, stands_for string")
    members, rejected = bundles.match_fixtures(spark.createDataFrame(rows, EVENT), ev, al, tolerance)
    return {r.ref: (r.bundle, r.activation, r.role) for r in members.collect()}, {(tuple(r.refs), r.reason) for r in rejected.collect()}


def test_reasons(spark):
    rows = [
        event("a:1", 100), event("b:1", 104), event("a:2", 200), event("a:3", 205), event("b:2", 202), event("c:9", 900),
        event("a:s", 107, anchor=False), event("a:t", 500, anchor=False), event("a:x", 1, one="Red", two="red"), event("a:p", 5, game=None, one="P", two="Q"), event("b:p", 9, game=None, one="Q", two="P"), event("c:p", 90, game=None, one="P", two="Q"),
    ]
    members, rejected = match(spark, rows, aliases=[("blu", "blue")])
    assert members == {"a:1": (204, 102.0, "anchor"), "b:1": (204, 102.0, "anchor"), "a:s": (204, 102.0, "sibling"), "a:p": (5, 7.0, "anchor"), "b:p": (5, 7.0, "anchor")}
    assert rejected == {
        (("a:2", "a:3"), "same_venue_anchor_ambiguous"), (("b:2",), "activation_time_conflict"), (("c:9",), "activation_time_conflict"),
        (("a:t",), "sibling_no_anchor"), (("a:x",), "participant_alias_collision"), (("c:p",), "fewer_than_minimum_venues"),
    }


def test_an_anchor_in_two_clusters_counts_for_none(spark):
    rows = [event("a:1", 100), event("b:1", 100), event("c:1", 100), event("a:2", 300), event("b:2", 300)]
    evidence = [("c:1", 100, 0, "at"), ("c:1", 300, 2, "title")]
    members, rejected = match(spark, rows, evidence)
    assert (("c:1",), "activation_time_ambiguous") in rejected and set(members) == {"a:1", "b:1", "a:2", "b:2"}


def test_siblings_give_a_bundle_its_format_in_order(spark):
    # x fits both bundles until a sibling before it has given the first one another format
    rows = [event("a:1", 100), event("b:1", 100), event("a:2", 115), event("b:2", 115), event("s:a", 95, False, "3"), event("s:b", 96, False, "5"), event("s:x", 107, False, "5"), event("s:y", 120, False, "5"), event("s:z", 108, False)]
    members, rejected = match(spark, rows)
    assert members["s:a"] == (200, 100.0, "sibling") and members["s:x"][0] == 230 and members["s:y"][0] == 230
    assert rejected == {(("s:b",), "sibling_no_anchor"), (("s:z",), "sibling_ambiguous")}


def test_differing_formats_of_anchors(spark):
    members, rejected = match(spark, [event("a:1", 100, fmt="3"), event("b:1", 101, fmt="5"), event("a:s", 100, False)])
    assert members == {} and rejected == {(("a:1", "b:1"), "competition_format_mismatch"), (("a:s",), "sibling_no_anchor")}


def test_clusters_in_a_block_of_many_times(spark):
    df = spark.range(200_000).select(F.lit("b").alias("k"), (F.col("id") * 7919 % 1_000_003).alias("t"))
    got = intervals.time_clusters(df, ["k"], "t", 30_000).select("t", "cluster_start").toPandas().sort_values("t")
    want, anchor = [], None
    for t in got["t"]:
        anchor = t if anchor is None or t - anchor > 30_000 else anchor
        want.append(anchor)
    assert got["cluster_start"].tolist() == want and len(set(want)) > 30
