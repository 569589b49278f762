"""Reconciliation joins, audits and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def resolutions(received: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Distinct resolutions against the catalogue.

    ``received`` (semantic_hash, market, outcome, outcome_index, seq), ``catalogue``
    (market, outcomes array). Deliveries of one hash count once, the first stays. status:
    unknown_market, outcome_not_listed, index_mismatch, conflicting or consistent.
    """
    first = received.groupBy("semantic_hash").agg(F.min_by(F.struct("market", "outcome", "outcome_index"), "seq").alias("r"), F.count(F.lit(1)).alias("deliveries")).select("semantic_hash", "r.*", "deliveries")
    several = F.size(F.collect_set("outcome").over(Window.partitionBy("market"))) > 1
    joined = first.withColumn("_several", several).join(catalogue, "market", "left")
    at = F.array_position("outcomes", F.col("outcome"))
    status = (
        F.when(F.col("outcomes").isNull(), "unknown_market").when(at == 0, "outcome_not_listed").when(at - 1 != F.col("outcome_index"), "index_mismatch")
        .when(F.col("_several"), "conflicting").otherwise("consistent")
    )
    return joined.withColumn("status", status).drop("_several")


def audited_window(evidence: DataFrame, provenance: DataFrame, sources: DataFrame) -> DataFrame:
    """One row of counts: evidence and provenance by sequence, ids and hashes, source lines in range, density.

    ``evidence`` (seq, record_id, line), ``provenance`` (seq, record_id, line_sha256,
    source, source_line), ``sources`` (source, line_count).
    """
    e = evidence.select("seq", F.col("record_id").alias("_id"), F.sha2(F.col("line").cast("binary"), 256).alias("_sha"))
    both = e.join(provenance, "seq", "full").join(sources, "source", "left")
    no = lambda test: F.count_if(F.coalesce(test, F.lit(False)))
    return both.agg(
        F.count_if(F.col("_id").isNull()).alias("without_evidence"), F.count_if(F.col("record_id").isNull()).alias("without_provenance"), no(F.col("_id") != F.col("record_id")).alias("id_mismatches"), no(F.col("_sha") != F.col("line_sha256")).alias("hash_mismatches"),
        no((F.col("source_line") < 1) | (F.col("source_line") > F.col("line_count")) | F.col("line_count").isNull() & F.col("source").isNotNull()).alias("lines_out_of_range"),
        (F.max("seq") - F.min("seq") + 1 == F.count_distinct("seq")).alias("dense"),
    )


def watched(subscriptions: DataFrame, evidence: DataFrame, asset: str) -> DataFrame:
    """Each subscribed asset with captured, asserted flags (both false if there is no evidence)."""
    facts = evidence.groupBy(asset).agg(F.bool_or(F.col("provenance") == "captured").alias("captured"), F.bool_or(F.col("provenance") == "asserted").alias("asserted"))
    out = subscriptions.select(asset).distinct().join(facts, asset, "left")
    return out.withColumn("captured", F.coalesce("captured", F.lit(False))).withColumn("asserted", F.coalesce("asserted", F.lit(False)))


def target_records(targets: DataFrame, catalogue: DataFrame, keys: list[str], record: str) -> tuple[DataFrame, DataFrame]:
    """(selected targets with their raw record, targets without one)."""
    joined = targets.join(catalogue.select(*keys, record), keys, "left")
    return joined.where(F.col(record).isNotNull()), joined.where(F.col(record).isNull()).drop(record)


def attached(children: DataFrame, groups: DataFrame, participants: str, expiry: str, group: str) -> DataFrame:
    """Loose children with the one group of the same participants (in any order) and expiry, else null."""
    key = lambda c: F.array_join(F.array_sort(F.col(c)), "\u001f")
    known = groups.groupBy(key(participants).alias("_p"), F.col(expiry).alias("_x")).agg(F.when(F.count_distinct(group) == 1, F.min(group)).alias(group))
    return children.withColumn("_p", key(participants)).withColumn("_x", F.col(expiry)).join(known, ["_p", "_x"], "left").drop("_p", "_x")


def selection_view(selected: DataFrame, candidates: DataFrame, continuity: DataFrame, targets: DataFrame, bundle: str = "bundle") -> DataFrame:
    """Selected bundles with score (greatest known), disposition and number of targets, best first."""
    counted = targets.groupBy(bundle).agg(F.count(F.lit(1)).alias("targets"))
    out = selected.join(candidates, bundle, "left").join(continuity, bundle, "left").join(counted, bundle, "left")
    score = F.greatest("score_rank", "score_relation", "score_activity")
    return out.select(bundle, score.alias("score"), "disposition", F.coalesce("targets", F.lit(0)).alias("targets")).orderBy(F.desc_nulls_last("score"), bundle)


def report_violations(report: DataFrame, archive: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, column, reported, archived): one row per column that disagrees, or per row that one side lacks."""
    a = report.select(*keys, F.lit(True).alias("_a"), *(F.col(c).cast("string").alias(f"_a_{c}") for c in columns))
    b = archive.select(*keys, F.lit(True).alias("_b"), *(F.col(c).cast("string").alias(f"_b_{c}") for c in columns))
    both = a.join(b, keys, "full")
    row = lambda name, x, y: F.struct(F.lit(name).alias("column"), x.alias("reported"), y.alias("archived"))
    none = F.lit(None).cast("string")
    found = F.array_compact(F.array(
        F.when(F.col("_a").isNull(), row("*missing_in_report", none, none)), F.when(F.col("_b").isNull(), row("*missing_in_archive", none, none)),
        *(F.when(F.col("_a") & F.col("_b") & ~F.col(f"_a_{c}").eqNullSafe(F.col(f"_b_{c}")), row(c, F.col(f"_a_{c}"), F.col(f"_b_{c}"))) for c in columns),
    ))
    return both.select(*keys, F.explode(found).alias("v")).select(*keys, "v.*")


def fixture_of(events: DataFrame, ticker: str, codes: list[tuple[str, str]]) -> Column:
    """The first fixture, in mapping order, whose code the ticker contains; null if none."""
    out = None
    for code, fixture in codes:
        hit = F.col(ticker).contains(code)
        out = F.when(hit, fixture) if out is None else out.when(hit, fixture)
    return out if out is not None else F.lit(None).cast("string")


def history_targets(venues: list[DataFrame], held: DataFrame, kinds: list[str]) -> tuple[DataFrame, DataFrame]:
    """(targets of the wanted types that aren't held yet, their counts per venue and type)."""
    every = venues[0]
    for more in venues[1:]:
        every = every.unionByName(more)
    wanted = every.where(F.col("market_type").isin(kinds)).join(held.select("target_id"), "target_id", "left_anti")
    return wanted, wanted.groupBy("venue", "market_type").agg(F.count(F.lit(1)).alias("n"))


def trust_signals(opened: DataFrame, states: DataFrame, closed: DataFrame, mismatches: DataFrame) -> DataFrame:
    """(asset, at, priority, action, verdict, reason): the union that trust intervals are built from.

    An opening leaves an asset unknown, a proven state trusts it, a mismatch distrusts it
    from where its doubt begins, a closing ends it. At one instant openings come first.
    """
    make = lambda df, at, p, action, verdict, reason: df.select("asset", F.col(at).alias("at"), F.lit(p).alias("priority"), F.lit(action).alias("action"), F.lit(verdict).alias("verdict"), F.lit(reason).alias("reason"))
    parts = [make(opened, "at", 0, "open", "UNKNOWN", "connection_opened"), make(mismatches, "doubt_from", 1, "state", "UNTRUSTED", "anchor_mismatch"), make(states, "at", 2, "state", "TRUSTED", "state_proven"), make(closed, "at", 3, "close", "UNKNOWN", "connection_closed")]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def observation_counters(events: DataFrame) -> DataFrame:
    """Per venue and kind: rows and how complete the fields of trades and books are."""
    full = lambda *c: F.count_if(sum(((F.col(x).isNull()).cast("int") for x in c), F.lit(0)) == 0)
    return events.groupBy("venue", "event_kind").agg(F.count(F.lit(1)).alias("n"), full("price", "size", "side").alias("complete_trades"), full("bids", "asks").alias("two_sided_books"), F.count_distinct("state_hash").alias("hashes"))


def hash_overlap(stream: DataFrame, snapshots: DataFrame, keys: list[str]) -> DataFrame:
    """One row: distinct keys of either side and of both."""
    a, b = stream.select(*keys).where(F.col(keys[-1]).isNotNull()).distinct(), snapshots.select(*keys).where(F.col(keys[-1]).isNotNull()).distinct()
    both = a.withColumn("_s", F.lit(1)).unionByName(b.withColumn("_s", F.lit(2))).groupBy(*keys).agg(F.sum("_s").alias("_s"))
    return both.agg(F.count_if(F.col("_s") != 2).alias("in_stream"), F.count_if(F.col("_s") != 1).alias("in_snapshots"), F.count_if(F.col("_s") == 3).alias("in_both"))


def availability(history: DataFrame, event: str, venue: str, venues: list[str]) -> DataFrame:
    """Rows per event and venue, and whether every venue has some."""
    out = history.groupBy(event).pivot(venue, venues).count()
    has = [F.coalesce(F.col(v), F.lit(0)) for v in venues]
    ok = F.lit(True)
    for h in has:
        ok = ok & (h > 0)
    return out.select(event, *(h.alias(v) for h, v in zip(has, venues, strict=True)), ok.alias("both_venues"))


def solicited_continuity(snapshots: DataFrame, solicited: str, previous: str, held: str, latency: str, size: str) -> DataFrame:
    """Per solicited flag: checked and broken cursors, fulfilled requests, median and longest latency, mean size."""
    checked = F.col(held).isNotNull() & F.col(previous).isNotNull()
    return snapshots.groupBy(solicited).agg(
        F.count_if(checked).alias("checked"), F.count_if(checked & (F.col(held) != F.col(previous))).alias("broken"), F.count(latency).alias("fulfilled"),
        F.median(latency).alias("median_latency"), F.max(latency).alias("longest_latency"), F.avg(size).alias("mean_size"),
    )


def volume_admission(markets: DataFrame, event: str, venue: str, volume: str, venues: list[str], least: float) -> DataFrame:
    """Per event: known volume by venue, markets without one, and whether the sum is enough."""
    out = markets.groupBy(event).agg(*(F.sum(F.when(F.col(venue) == v, F.col(volume))).alias(v) for v in venues), F.sum(volume).alias("known_usd"), F.count_if(F.col(volume).isNull()).alias("unknown_markets"))
    return out.withColumn("admitted", F.coalesce(F.col("known_usd") >= least, F.lit(False)))


def contradictions(rules: DataFrame, text: str, expected: list[str], scrub: list[str]) -> Column:
    """Array of the phrases that the text lacks once all excluded phrases are taken out of it."""
    out = F.lower(F.col(text))
    for phrase in scrub:
        out = F.replace(out, F.lit(phrase.lower()), F.lit(" "))
    return F.array_compact(F.array(*(F.when(~out.contains(p.lower()), F.lit(p)) for p in expected)))


def scheduled_instant(text: Column, zone: str = "America/New_York") -> Column:
    """Microseconds of the one "March 3, 2026 at 5:30 PM" that a text names, all mentions agreeing; else null."""
    pattern = r"((?:January|February|March|April|May|June|July|August|September|October|November|December) \d{1,2}, \d{4}),? at (\d{1,2}:\d{2} ?[AP]M)"
    at = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("d"), F.regexp_extract_all(text, F.lit(pattern), F.lit(2)).alias("t"))
    stamps = F.array_distinct(F.transform(at, lambda z: F.concat_ws(" ", z["d"], F.replace(z["t"], F.lit(" "), F.lit("")))))
    one = F.when(F.size(stamps) == 1, F.element_at(stamps, 1))
    return F.unix_micros(F.to_utc_timestamp(F.try_to_timestamp(one, F.lit("MMMM d, yyyy h:mma")), zone))


def retention_decisions(receipts: DataFrame, archived: DataFrame, canonical: DataFrame, local: DataFrame, independent: bool = True) -> DataFrame:
    """One decision per archive receipt, its first reason in order; an audit, nothing is deleted.

    ``receipts`` (receipt, lane, source_file, segment_index, sha256, length, valid, conformance, lane_dir),
    ``archived`` (receipt, sha256, length), ``canonical`` (lane, sha256, source_file, segment_index),
    ``local`` (lane, source_file, kind source or seal, sha256). A receipt authorises a removal only
    if the archived object is verified, a committed window names lane, digest, file and
    index, and the local bytes are those of the receipt.
    """
    c = F.col
    stored = archived.groupBy("receipt").agg(F.max(F.struct("sha256", "length")).alias("_stored"))
    exact = canonical.select("lane", "sha256", "source_file", "segment_index").distinct().withColumn("_named", F.lit(True))
    digest = canonical.select("lane", "sha256").distinct().withColumn("_digest", F.lit(True))
    files = local.groupBy("lane", "source_file").agg(F.max(F.when(c("kind") == "source", c("sha256"))).alias("_source"), F.bool_or(c("kind") == "seal").alias("_seal"))
    rows = receipts.join(stored, "receipt", "left").join(exact, ["lane", "sha256", "source_file", "segment_index"], "left").join(digest, ["lane", "sha256"], "left").join(files, ["lane", "source_file"], "left")
    seal, source = F.coalesce("_seal", F.lit(False)), c("_source").isNotNull()
    verified = (c("_stored.sha256") == c("sha256")) & (c("_stored.length") == c("length"))
    reason = (
        F.when(c("conformance") | ~F.lit(independent), "durability_gate").when(~c("valid") | (c("lane_dir") != F.concat(F.lit("lane="), "lane")), "archive_receipt_invalid")
        .when(~F.coalesce(verified, F.lit(False)), "archive_object_unverified").when(c("_named").isNull(), F.when(c("_digest"), "canonical_mismatch").otherwise("canonical_missing"))
        .when(~source & ~seal, "already_removed").when(~source, "partial_cleanup_pending").when(~seal | (c("_source") != c("sha256")), "local_source_changed").otherwise("all_conditions_hold")
    )
    return rows.select("receipt", "lane", "source_file", reason.alias("reason"), reason.isin("all_conditions_hold", "partial_cleanup_pending").alias("removable"))


def first_examples(rows: DataFrame, keys: list[str], order: list[str], value: str, k: int) -> DataFrame:
    """Per key the first ``k`` values in order, as evidence, and how many rows there are."""
    w = Window.partitionBy(*keys).orderBy(*order)
    first = rows.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= k)  # no more than k rows of a key leave a task
    picked = first.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", F.col(value).alias("v")))), lambda x: x["v"]).alias("examples"))
    return picked.join(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), keys)
