"""Events of several venues that are one fixture: anchors in clusters of time, siblings attached to one of them.

Every step is a join or a grouping on the identity (sport, game, topology, participants), with
a coarse time beside it where many events may share an identity. No pairs of events are
formed: times are counted by venue first, and pairs of times weigh what they count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import at_rank, value_ranks
from ..functions.text import canonical_participant
from ..sources.scratch import forget, materialize
from .intervals import time_clusters

#: Why an event is in no bundle.
COLLISION, VENUES, FORMATS = "participant_alias_collision", "fewer_than_minimum_venues", "competition_format_mismatch"
AMBIGUOUS, SAME_VENUE, CONFLICT = "activation_time_ambiguous", "same_venue_anchor_ambiguous", "activation_time_conflict"
SIBLING_AMBIGUOUS, SIBLING_ALONE = "sibling_ambiguous", "sibling_no_anchor"
IDENTITY = ["sport", "game", "topology", "first", "second"]


def identified(events: DataFrame, aliases: DataFrame | None, one: str = "one", two: str = "two") -> DataFrame:
    """Adds first and second: the participants' canonical keys, through ``aliases`` (name, stands_for), in order."""
    out = events.withColumns({"_one": canonical_participant(F.col(one)), "_two": canonical_participant(F.col(two))})
    if aliases is not None:
        for c in ("_one", "_two"):
            known = aliases.groupBy(F.col("name").alias(c)).agg(F.min("stands_for").alias(f"{c}_for"))
            out = out.join(known, c, "left").withColumn(c, F.coalesce(f"{c}_for", c)).drop(f"{c}_for")
    return out.withColumns({"first": F.least("_one", "_two"), "second": F.greatest("_one", "_two")}).drop("_one", "_two")


def _refused(rows: DataFrame, reason: str, refs: Column | None = None) -> DataFrame:
    return rows.select(*IDENTITY, (refs if refs is not None else F.array("ref")).alias("refs"), F.lit(reason).alias("reason"))


def _refs() -> Column:
    return F.array_sort(F.collect_set("ref")).alias("refs")


def _near(evidence: DataFrame, points: DataFrame, key: str, at: str, tolerance: int) -> DataFrame:
    """(ref, ..., key, chosen): the best evidence of an event within the tolerance of each of its identity's points.

    Structured and primary before structured before parsed, then by field and instant. The
    join has a coarse time beside the identity, so an identity with many points is many keys.
    """
    cell = F.floor(F.col("instant") / tolerance)
    left = evidence.withColumn("_cell", F.explode(F.array(cell - 1, cell, cell + 1)))
    right = points.withColumn("_cell", F.floor(F.col(at) / tolerance))
    met = left.join(right, [*IDENTITY, "_cell"]).where(F.abs(F.col("instant") - F.col(at)) <= tolerance)
    kept = [c for c in points.columns if c not in (*IDENTITY, key)]
    best = F.min(F.struct("rank", "field", "instant")).alias("chosen")
    return met.groupBy(*IDENTITY, "ref", "venue", "fmt", key).agg(best, *(F.first(c).alias(c) for c in kept))


def _median(rows: DataFrame, keys: list[str], value: str, weight: str | None = None) -> DataFrame:
    """Median of a value per key, each value as often as its weight says, from counted values."""
    ranks = value_ranks(rows, keys, value, weight) if weight else value_ranks(rows, keys, value)
    n = F.col("n")
    return ranks.groupBy(*keys).agg(((at_rank(F.col(value), F.floor((n - 1) / 2)) + at_rank(F.col(value), F.floor(n / 2))) / 2).alias("median"))


def _proposed(evidence: DataFrame, tolerance: int) -> DataFrame:
    """(identity, cluster, instant): clusters of the midpoints of evidence of different venues within the tolerance.

    Evidence is counted by venue and instant first; a pair of instants stands for as many
    proposals as there are pairs of events. Midpoints are doubled, so they are whole.
    """
    counted = evidence.groupBy(*IDENTITY, "venue", "instant").agg(F.count(F.lit(1)).alias("c"))
    cell = F.floor(F.col("instant") / tolerance)
    a = counted.select(*IDENTITY, F.col("venue").alias("va"), F.col("instant").alias("ia"), F.col("c").alias("ca"), F.explode(F.array(cell - 1, cell, cell + 1)).alias("_cell"))
    b = counted.select(*IDENTITY, F.col("venue").alias("vb"), F.col("instant").alias("ib"), F.col("c").alias("cb"), cell.alias("_cell"))
    pairs = a.join(b, [*IDENTITY, "_cell"]).where((F.col("va") < F.col("vb")) & (F.abs(F.col("ia") - F.col("ib")) <= tolerance))
    middles = pairs.groupBy(*IDENTITY, (F.col("ia") + F.col("ib")).alias("twice")).agg(F.sum(F.col("ca") * F.col("cb")).alias("proposals"))
    middles = materialize(middles, "middles")
    clustered = time_clusters(middles, IDENTITY, "twice", 2 * tolerance)
    out = _median(clustered, [*IDENTITY, "cluster_start"], "twice", "proposals")
    return materialize(out.select(*IDENTITY, F.col("cluster_start").alias("cluster"), (F.col("median") / 2).alias("instant_at")), "clusters")


def match_fixtures(events: DataFrame, evidence: DataFrame, aliases: DataFrame | None, tolerance: int, min_venues: int = 2) -> tuple[DataFrame, DataFrame]:
    """(members, rejections) of the events of all venues.

    ``events``: ref, venue, sport, game, topology, fmt, one, two, at, anchor. ``evidence``: ref,
    instant, rank (0 structured and primary, 1 structured, 2 parsed), field; an event without
    any has its own time, primary. Members: identity, bundle (its cluster), activation, ref,
    venue, role (anchor or sibling), instant. Rejections: identity, refs, reason.

    Without a game, events within the tolerance of a cluster's first belong together. With one,
    anchors are matched where evidence of two venues agrees; an anchor that supports two
    clusters, or two anchors of a venue in one, count for none. Siblings join the one bundle
    whose time and format they fit, and change neither its time nor its venues. Null sport,
    game and topology read as empty.
    """
    empty = F.lit("")
    events = events.withColumns({c: F.coalesce(c, empty) for c in ("sport", "game", "topology")})
    known = materialize(identified(events, aliases).select(*IDENTITY, "ref", "venue", "fmt", "at", "anchor"), "events")
    rejected = [_refused(known.where("first = second"), COLLISION)]
    known = known.where("first <> second")

    # without a game: clusters of the events' own times
    plain = time_clusters(known.where(F.col("game") == ""), IDENTITY, "at", tolerance)
    plain = materialize(plain, "plain")
    groups = plain.groupBy(*IDENTITY, "cluster_start").agg(F.count_distinct("venue").alias("venues"), F.count_distinct("fmt").alias("formats"), _refs())
    few, mixed = F.col("venues") < min_venues, F.col("formats") > 1
    rejected += [_refused(groups.where(few), VENUES, F.col("refs")), _refused(groups.where(~few & mixed), FORMATS, F.col("refs"))]
    medians = _median(plain, [*IDENTITY, "cluster_start"], "at").withColumnRenamed("median", "activation")
    fine = groups.where(~few & ~mixed).drop("refs", "venues", "formats").join(medians, [*IDENTITY, "cluster_start"])
    members = [plain.join(fine, [*IDENTITY, "cluster_start"]).select(*IDENTITY, F.col("cluster_start").alias("bundle"), "activation", "ref", "venue", F.lit("anchor").alias("role"), F.col("at").alias("instant"))]

    # with a game: evidence of anchors, proposals of two venues, and the clusters that they make
    own = known.where(F.col("game") != "")
    stated = own.join(evidence.select("ref", "instant", "rank", "field"), "ref", "left")
    stated = stated.withColumns({"rank": F.when(F.col("instant").isNull(), 0).otherwise(F.col("rank")), "field": F.when(F.col("instant").isNull(), "activation_at").otherwise(F.col("field")), "instant": F.coalesce("instant", "at")})
    stated = materialize(stated.select(*IDENTITY, "ref", "venue", "fmt", "anchor", "instant", "rank", "field"), "evidence")
    anchors = own.where("anchor").select(*IDENTITY, "ref", "venue", "fmt")
    clusters = _proposed(stated.where("anchor"), tolerance)
    supported = materialize(_near(stated.where("anchor"), clusters, "cluster", "instant_at", tolerance), "supported")
    double = materialize(supported.groupBy("ref").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("ref"), "ambiguous")
    rejected.append(_refused(anchors.join(double, "ref", "left_semi"), AMBIGUOUS))
    chosen = supported.join(double, "ref", "left_anti")
    venues = chosen.groupBy(*IDENTITY, "cluster", "venue").agg(F.count(F.lit(1)).alias("c"), _refs()).where("c > 1")
    rejected.append(_refused(venues, SAME_VENUE, F.col("refs")))
    chosen = materialize(chosen.join(venues.select(*IDENTITY, "cluster", "venue"), [*IDENTITY, "cluster", "venue"], "left_anti"), "chosen")
    sets = chosen.groupBy(*IDENTITY, "cluster").agg(F.count_distinct("venue").alias("venues"), F.count_distinct("fmt").alias("formats"), F.min("fmt").alias("bundle_fmt"), _refs()).where(~few)
    rejected.append(_refused(sets.where(mixed), FORMATS, F.col("refs")))
    times = _median(chosen.select(*IDENTITY, "cluster", F.col("chosen.instant").alias("t")), [*IDENTITY, "cluster"], "t").withColumnRenamed("median", "activation")
    bundles = materialize(sets.where(~mixed).select(*IDENTITY, "cluster", "bundle_fmt").join(times, [*IDENTITY, "cluster"]), "bundles")
    used = chosen.join(bundles.drop("bundle_fmt"), [*IDENTITY, "cluster"])
    members.append(used.select(*IDENTITY, F.col("cluster").alias("bundle"), "activation", "ref", "venue", F.lit("anchor").alias("role"), F.col("chosen.instant").alias("instant")))
    told = rejected[3:]
    spoken_for = materialize(used.select("ref").unionByName(told[0].unionByName(told[1]).unionByName(told[2]).select(F.explode("refs").alias("ref"))).distinct(), "told")
    left = anchors.join(spoken_for, "ref", "left_anti").join(bundles.select(*IDENTITY).distinct().withColumn("has", F.lit(True)), IDENTITY, "left")
    rejected += [_refused(left.where("has"), CONFLICT), _refused(left.where("has IS NULL"), VENUES)]

    siblings = own.where("NOT anchor").select(*IDENTITY, "ref", "venue", "fmt")
    joined, refused = _attached(stated.where("NOT anchor"), siblings, bundles, tolerance)
    members.append(joined)
    rejected += refused
    union = lambda parts: parts[0] if len(parts) == 1 else parts[0].unionByName(union(parts[1:]))
    return union(members), union(rejected)


def _attached(stated: DataFrame, siblings: DataFrame, bundles: DataFrame, tolerance: int) -> tuple[DataFrame, list[DataFrame]]:
    """Siblings with the one bundle that they fit, and those that fit none or several.

    A bundle without a format takes that of its first sibling by ref that has one, and refuses
    other formats from then on; that may free later siblings for another bundle. So bundles'
    formats are found in rounds, each over all siblings, until none changes.
    """
    near = materialize(_near(stated, bundles, "cluster", "activation", tolerance), "near")
    fits = F.col("fmt").isNull() | F.col("bundle_fmt").isNull() | (F.col("fmt") == F.col("bundle_fmt"))
    near_fit = near.where(fits)
    setters = materialize(bundles.select(*IDENTITY, "cluster", F.lit(None).cast("string").alias("set_fmt"), F.lit(None).cast("string").alias("set_by")).where("false"), "formats")
    count = Window.partitionBy("ref")  # a sibling fits few bundles: those of one identity within the tolerance
    while True:
        offered = near_fit.join(setters, [*IDENTITY, "cluster"], "left")
        open_ = F.col("bundle_fmt").isNotNull() | F.col("fmt").isNull() | F.col("set_by").isNull() | (F.col("ref") <= F.col("set_by")) | (F.col("fmt") == F.col("set_fmt"))
        eligible = offered.where(open_).withColumn("fitting", F.count(F.lit(1)).over(count))
        settled = materialize(eligible.drop("set_fmt", "set_by"), "eligible")
        new = settled.where("fitting = 1 AND bundle_fmt IS NULL AND fmt IS NOT NULL").groupBy(*IDENTITY, "cluster").agg(F.min("ref").alias("set_by"), F.min_by("fmt", "ref").alias("set_fmt"))
        new = materialize(new.select(*IDENTITY, "cluster", "set_fmt", "set_by"), "formats")
        same = [F.sum(F.xxhash64(*IDENTITY, "cluster", "set_fmt", "set_by").cast("decimal(38,0)")), F.count(F.lit(1))]
        moved = new.agg(*same).first() != setters.agg(*same).first()  # one row
        forget(setters)
        setters = new
        if not moved:
            break
        forget(settled)
    one = settled.where("fitting = 1")
    joined = one.select(*IDENTITY, F.col("cluster").alias("bundle"), "activation", "ref", "venue", F.lit("sibling").alias("role"), F.col("chosen.instant").alias("instant"))
    many = settled.where("fitting > 1").select("ref").distinct()
    none = siblings.join(settled.select("ref").distinct(), "ref", "left_anti")
    return joined, [_refused(siblings.join(many, "ref", "left_semi"), SIBLING_AMBIGUOUS), _refused(none, SIBLING_ALONE)]
