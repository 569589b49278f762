"""Registered queries over envelopes: ``events`` are written as newline-framed segments and read back."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import baskets, intervals, ladder
from ..sources import tape as source
from ..sources.scratch import materialize, shared_dir
from . import events, gates, market_queries, tape_queries
from .market_queries import LEG_SQL
from .tape_queries import EXACT_SQL, TAPE_SQL, exact_levels, tape

QUERIES, ORACLES = {}, {}

#: The payload of each event, the same text in both engines; what it holds goes by event_id % 8.
PAYLOAD = """CASE event_id % 8
WHEN 0 THEN concat('{"event_type":"book","market":"m', user_id, '","asset_id":"a', user_id, '","bids":[{"price":"0.', 10 + k % 90, '","size":"', k, '"}],"asks":[{"price":"0.99","size":"', CASE WHEN k >= 90 THEN 'x' ELSE '1' END, '"}],"hash":"h', k, '","timestamp":"', event_id, '"}')
WHEN 1 THEN concat('[{"event_type":"price_change","market":"m', user_id, '","timestamp":"1","price_changes":[{"asset_id":"a', user_id, '","side":"buy","price":"0.5","size":"', k, '","hash":"h"},{"asset_id":"b","side":"sell","price":"', CASE WHEN k < 50 THEN '0.6' ELSE '-1' END, '","size":1}]}]')
WHEN 2 THEN concat('{"event_type":"last_trade_price","market":"m', user_id, '","asset_id":"a', user_id, '","price":0.25,"size":"', k, '","side":"buy","timestamp":"', event_id, '","transaction_hash":"t"}')
WHEN 3 THEN concat('{"gameId":', user_id, ',"homeTeam":"h","awayTeam":"w","status":"playing","score":"0-0","period":"P1","live":true', CASE WHEN k < 50 THEN ',"eventState":{"score":"1-0","period":null,"updatedAt":"u"}' ELSE '' END, '}')
WHEN 4 THEN concat('{"topic":"t","payload":{"symbol":"s', user_id, '","value":', k, CASE WHEN k < 50 THEN concat(',"full_accuracy_value":"', k, '.25"') ELSE '' END, ',"timestamp":7}}')
WHEN 5 THEN concat('{"event":"orderbookUpdate","data":{"marketSlug":"x', user_id, '","version":', k, ',"timestamp":"9","orderbook":{"bids":[],"asks":[{"price":"0.', 10 + k % 90, '","size":"2"}]}}}')
WHEN 6 THEN concat('{"event_type":"market_resolved","condition_id":"m', user_id, '"}')
ELSE CASE WHEN k < 50 THEN concat('{"event":"connection_opened","target_digest":"d","asset_ids":["a', user_id, '"],"delivers_deltas":true,"fsync_interval_seconds":1,"target_metadata_digest":"g', user_id % 3, '","clock_scope":{"scope_id":"s","comparable_across_processes":true}}')
WHEN k >= 90 THEN '{"event":"connection_closed"}' ELSE concat('not json ', k) END END"""
#: Lines of a segment at most.
ROTATION = 100_000
DAY = "CAST(CAST(at_us // 86400000000 AS BIGINT) AS STRING)"


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The valid and invalid lines of a tape that is written by lane and day, with lane and day from their paths."""
    t = tape(spark, sf_dir).withColumn("c", F.col("event_id") % 8)
    envelope = F.struct(
        F.lit(2).alias("envelope_version"), F.when(F.col("k") == 98, F.lit(-1)).otherwise(F.col("event_id")).alias("delivery_index"), F.concat_ws("-", "lane", "event_id").alias("record_id"), (F.col("at_us") * 1000).alias("visible_ns"),
        F.col("event_id").alias("monotonic_ns"), F.when(F.col("c") == 5, "limitless").otherwise("polymarket").alias("venue"), F.when(F.col("c").isin(3, 4), "reference_event").when((F.col("c") == 7) & ((F.col("k") < 50) | (F.col("k") >= 90)), "process").otherwise("public_book").alias("stream"),
        F.col("user_id").cast("string").alias("connection_epoch"), F.col("event_id").alias("local_counter"), F.struct(F.lit("unsequenced").alias("type"), F.col("event_id").alias("counter")).alias("source_cursor"),
        F.when(F.col("k") == 97, "other").otherwise("venue_frame").alias("kind"), F.expr(PAYLOAD).alias("raw_payload"),
    )
    root = f"{shared_dir(spark)}/tape-{uuid.uuid4().hex}"
    day = F.floor(F.col("at_us") / 86400000000).cast("string")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a segment ends with its block of ids at the latest; blocks go to all tasks
    rows = t.withColumn("date", day).repartition(n, "lane", "date", F.floor(F.col("event_id") / ROTATION))
    rows.select(F.to_json(envelope).alias("value"), "lane", "date").write.partitionBy("lane", "date").option("maxRecordsPerFile", ROTATION).text(root)
    # lines are read by all tasks: else as many read as the segments' bytes make partitions
    lines = source.lines(source.objects(spark, root, "*.txt")).repartition(n)
    read = source.parsed(lines)
    return read.withColumn("lane", source.lane_of(F.col("object_key"))).withColumn("day", F.regexp_extract("object_key", "date=([^/]+)/", 1))


@query(f"""WITH {TAPE_SQL} SELECT lane, {DAY} AS day, lane || '-' || event_id AS record_id, CASE WHEN k = 98 THEN 'counter_type' WHEN k = 97 THEN 'kind' END AS error, sha256({PAYLOAD}) AS content_sha256 FROM tape""")
def envelopes(spark, sf_dir):
    return segments(spark, sf_dir).select("lane", "day", "record_id", "error", "content_sha256")


@query(f"""WITH {TAPE_SQL}, e AS (SELECT event_id, lane, user_id AS u, k, event_id % 8 AS c FROM tape WHERE k NOT IN (97, 98))
SELECT event_id, lane, 0 AS event_index, CASE WHEN k < 90 THEN 'full_book' ELSE 'raw' END AS event_kind, CASE WHEN k < 90 THEN 'a' || u END AS asset_id, CASE WHEN k < 90 THEN 'm' || u END AS market, NULL AS side, CAST(NULL AS DOUBLE) AS price, CAST(NULL AS DOUBLE) AS size, CASE WHEN k < 90 THEN 2 END AS levels, NULL AS score, NULL AS period, CASE WHEN k >= 90 THEN 'book' END AS note FROM e WHERE c = 0
UNION ALL SELECT event_id, lane, 0, 'book_delta', 'a' || u, 'm' || u, 'BUY', 0.5, k, NULL, NULL, NULL, NULL FROM e WHERE c = 1
UNION ALL SELECT event_id, lane, 1, CASE WHEN k < 50 THEN 'book_delta' ELSE 'raw' END, CASE WHEN k < 50 THEN 'b' END, CASE WHEN k < 50 THEN 'm' || u END, CASE WHEN k < 50 THEN 'SELL' END, CASE WHEN k < 50 THEN 0.6 END, CASE WHEN k < 50 THEN 1 END, NULL, NULL, NULL, CASE WHEN k >= 50 THEN 'unparseable_price_change' END FROM e WHERE c = 1
UNION ALL SELECT event_id, lane, 0, 'trade', 'a' || u, 'm' || u, 'BUY', 0.25, k, NULL, NULL, NULL, NULL FROM e WHERE c = 2
UNION ALL SELECT event_id, lane, 0, 'game_state', NULL, NULL, NULL, NULL, NULL, NULL, CASE WHEN k < 50 THEN '1-0' ELSE '0-0' END, CASE WHEN k >= 50 THEN 'P1' END, NULL FROM e WHERE c = 3
UNION ALL SELECT event_id, lane, 0, 'reference_tick', 's' || u, NULL, NULL, CASE WHEN k < 50 THEN k + 0.25 ELSE k END, NULL, NULL, NULL, NULL, NULL FROM e WHERE c = 4
UNION ALL SELECT event_id, lane, 0, 'full_book', 'x' || u, 'x' || u, NULL, NULL, NULL, 1, NULL, NULL, NULL FROM e WHERE c = 5
UNION ALL SELECT event_id, lane, 0, 'market_lifecycle', NULL, 'm' || u, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM e WHERE c = 6
UNION ALL SELECT event_id, lane, 0, CASE WHEN k < 50 THEN 'connection_opened' WHEN k >= 90 THEN 'connection_closed' ELSE 'raw' END, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, CASE WHEN k BETWEEN 50 AND 89 THEN 'text' END FROM e WHERE c = 7""")
def events_normalized(spark, sf_dir):
    out = events.normalize(segments(spark, sf_dir).where("error IS NULL"))
    return out.select(
        F.col("delivery_index").alias("event_id"), "lane", "event_index", "event_kind", "asset_id", "market", "side", F.col("price").cast("double").alias("price"), F.col("size").cast("double").alias("size"),
        F.nullif(F.coalesce(F.size("bids") + F.size("asks"), F.lit(0)), F.lit(0)).alias("levels"), "game.score", "game.period", "note",
    )


#: SQL of the queries whose operators feed the later gates.
ORACLES_OF = {**tape_queries.ORACLES, **market_queries.ORACLES}

GATE_SQL = f"""WITH {TAPE_SQL}, e AS (SELECT *, event_id % 8 AS c, at_us // 86400000000 AS day FROM tape), v AS (SELECT * FROM e WHERE k NOT IN (97, 98)),
b AS (SELECT event_id - lag(event_id) OVER (PARTITION BY lane ORDER BY event_id) AS d, event_id - lag(event_id) OVER (PARTITION BY CASE WHEN c = 5 THEN 'l' ELSE 'p' END, user_id ORDER BY event_id) AS l FROM v),
o AS (SELECT * FROM v WHERE c = 7 AND k < 50), ends AS (SELECT lane, user_id, count(*) FILTER (k < 50) AS o, count(*) FILTER (k >= 90) AS x FROM v WHERE c = 7 GROUP BY 1, 2),
an AS ({ORACLES_OF["anchor_check"]}), ac AS (SELECT count(*) AS n, count(*) FILTER (outcome = 'match') AS m, count(*) FILTER (outcome = 'conflict') AS x, count(*) FILTER (outcome <> 'match') AS bad FROM an WHERE outcome <> 'unobserved'),
mv2 AS ({ORACLES_OF["market_verdict"]}), cu AS (SELECT user_id, bool_or(start_ns >= end_ns OR nxt <> end_ns) AS broken FROM (SELECT *, lead(start_ns) OVER (PARTITION BY user_id ORDER BY start_ns) AS nxt FROM mv2) GROUP BY user_id),
{LEG_SQL}, {EXACT_SQL}, cc AS ({ORACLES_OF["cover_cost"]}), ba AS (SELECT me.*, coalesce(feasible, false) AS feasible FROM me LEFT JOIN cc ON basket = l_orderkey), es AS ({ORACLES_OF["episode_split"]}), su AS ({ORACLES_OF["survival"]}),
g1 AS (SELECT 1 AS gate, 'byte_and_envelope_integrity' AS name, CASE WHEN (SELECT count(*) FROM e WHERE k IN (97, 98)) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
UNION ALL SELECT 1, 'deterministic_capture_order', CASE WHEN (SELECT count(*) FROM b WHERE d <> 1 OR l <> 1) = 0 THEN 'PASS' ELSE 'FAIL' END
UNION ALL SELECT 1, name, CASE WHEN (SELECT count(*) FROM o) > 0 THEN 'PASS' ELSE 'FAIL' END FROM (VALUES ('receive_clock_provenance'), ('subscription_provenance')) t(name)
UNION ALL SELECT 1, 'market_rules_and_metadata', CASE WHEN (SELECT count(*) FROM o WHERE user_id % 2 = 0) > 0 THEN 'PASS' ELSE 'FAIL' END
UNION ALL SELECT 1, 'metadata_snapshot_references', CASE WHEN (SELECT count(*) FROM o WHERE user_id % 3 = 2) = 0 THEN 'PASS' ELSE 'FAIL' END
UNION ALL SELECT 1, 'discovery_coverage', CASE WHEN (SELECT count(*) FROM o) = 0 THEN 'FAIL' WHEN (SELECT count(*) FROM o WHERE user_id % 10 = 0) = 0 THEN 'PASS' ELSE 'FAIL' END
UNION ALL SELECT 1, 'polymarket_book_chain', CASE WHEN (SELECT count(*) FROM v WHERE c = 0 AND k < 90) > 0 AND (SELECT count(*) FROM v WHERE c = 1) > 0 THEN 'PASS' ELSE 'FAIL' END
UNION ALL SELECT 1, 'polymarket_recovery_anchors', 'FAIL'
UNION ALL SELECT 1, 'every_segment_is_sealed', CASE WHEN (SELECT count(*) FROM e WHERE day % 7 = 0) = 0 THEN 'PASS' ELSE 'FAIL' END
UNION ALL SELECT 1, 'limitless_full_books', CASE WHEN (SELECT count(*) FROM v WHERE c = 5) > 0 THEN 'PASS' ELSE 'FAIL' END
UNION ALL SELECT 1, 'trade_and_fill_observability', CASE WHEN (SELECT count(*) FROM v WHERE c = 2) > 0 THEN 'PASS' ELSE 'FAIL' END
UNION ALL SELECT 1, 'reference_price_observability', CASE WHEN (SELECT count(*) FROM v WHERE c = 4) > 0 THEN 'PASS' ELSE 'FAIL' END
UNION ALL SELECT 1, 'game_event_observability', CASE WHEN (SELECT count(*) FROM v WHERE c = 3) > 0 THEN 'PASS' ELSE 'FAIL' END
UNION ALL SELECT 1, 'market_lifecycle_observability', 'ADVISORY'
UNION ALL SELECT 1, 'fee_model_evidence', CASE WHEN (SELECT count(*) FROM o WHERE user_id % 3 = 0) > 0 THEN 'PASS' ELSE 'FAIL' END
UNION ALL SELECT 1, 'closed_capture_fixture', CASE WHEN (SELECT count(*) FROM ends WHERE o > 0 AND x < o) = 0 THEN 'PASS' ELSE 'FAIL' END),
g2 AS (SELECT 2 AS gate, 'gate_1_precondition' AS name, CASE WHEN (SELECT count(*) FROM g1 WHERE status = 'FAIL') = 0 THEN 'PASS' ELSE 'FAIL' END AS status
UNION ALL SELECT 2, 'polymarket_serializer_bootstrap', CASE WHEN (SELECT n >= 100 AND m >= 0.95 * n AND x = 0 FROM ac) THEN 'PASS' ELSE 'FAIL' END
UNION ALL SELECT 2, 'complete_interval_partition', CASE WHEN (SELECT count(*) FROM cu) > 0 AND (SELECT count(*) FROM cu WHERE broken) = 0 THEN 'PASS' ELSE 'FAIL' END
UNION ALL SELECT 2, 'venue_specific_trust_models', CASE WHEN (SELECT count(DISTINCT user_id % 2) FROM cu) = 2 THEN 'PASS' ELSE 'FAIL' END
UNION ALL SELECT 2, 'mismatch_recovery_is_bounded', CASE WHEN (SELECT bad FROM ac) = 0 OR (SELECT count(*) FROM mv2 WHERE verdict = 'UNTRUSTED') > 0 THEN 'PASS' ELSE 'FAIL' END
UNION ALL SELECT 2, 'mandatory_analysis_evidence', CASE WHEN (SELECT count(*) FROM mv2) > 0 AND (SELECT n FROM ac) > 0 AND (SELECT count(*) FROM tape) > 0 THEN 'PASS' ELSE 'FAIL' END),
g3 AS (SELECT 3 AS gate, 'gate_2_precondition' AS name, CASE WHEN (SELECT count(*) FROM g2 WHERE status = 'FAIL') = 0 THEN 'PASS' ELSE 'FAIL' END AS status
UNION ALL SELECT 3, 'share_matched_vwap_depth', CASE WHEN (SELECT count(*) FROM xe) > 0 AND (SELECT count(*) FROM xe WHERE abs(CAST(vwap AS DOUBLE) / 1e12 - CAST(n AS DOUBLE) / CAST(f AS DOUBLE) / 1e4) > 1e-9) = 0 THEN 'PASS' ELSE 'FAIL' END
UNION ALL SELECT 3, 'deployable_ticket_net_of_conservative_fees', CASE WHEN (SELECT count(*) FROM ba WHERE size = 50 AND priority = '1-URGENT') > 0 AND (SELECT count(*) FROM ba WHERE size = 50 AND priority = '1-URGENT' AND net IS NULL) = 0 THEN 'PASS' ELSE 'FAIL' END
UNION ALL SELECT 3, 'symbolic_subset_cover_lp', CASE WHEN (SELECT count(*) FROM ba WHERE exclusion IS NULL) > 0 AND (SELECT count(*) FROM ba WHERE exclusion IS NULL AND NOT feasible) = 0 THEN 'PASS' ELSE 'FAIL' END
UNION ALL SELECT 3, 'matched_leg_placebo_null', CASE WHEN (SELECT count(*) FROM (SELECT size FROM ba WHERE exclusion IS NULL GROUP BY size HAVING count(DISTINCT event) > 1)) > 0 THEN 'PASS' ELSE 'FAIL' END
UNION ALL SELECT 3, 'condition_identity_guard', CASE WHEN (SELECT count(*) FROM (SELECT basket FROM ba GROUP BY basket HAVING count(DISTINCT event % 2) > 1)) = 0 THEN 'PASS' ELSE 'FAIL' END
UNION ALL SELECT 3, 'mandatory_economic_evidence', CASE WHEN (SELECT count(*) FROM mv2) > 0 AND (SELECT n FROM ac) > 0 AND (SELECT count(*) FROM ba WHERE exclusion IS NULL) > 0 THEN 'PASS' ELSE 'FAIL' END),
g4 AS (SELECT 4 AS gate, 'gate_3_precondition' AS name, CASE WHEN (SELECT count(*) FROM g3 WHERE status = 'FAIL') = 0 THEN 'PASS' ELSE 'FAIL' END AS status
UNION ALL SELECT 4, 'venue_book_state_replay', CASE WHEN (SELECT count(DISTINCT user_id % 2) FROM es) = 2 THEN 'PASS' ELSE 'FAIL' END
UNION ALL SELECT 4, 'quote_lifetime_distribution', CASE WHEN (SELECT count(*) FROM es WHERE user_id % 2 = 0 AND verdict = 'TRUSTED' AND NOT censored) > 0 THEN 'PASS' ELSE 'FAIL' END
UNION ALL SELECT 4, 'explicit_non_fill_estimator', CASE WHEN (SELECT count(*) FROM su WHERE status IS NULL) = 0 THEN 'PASS' ELSE 'FAIL' END
UNION ALL SELECT 4, 'candidate_accounting', CASE WHEN (SELECT count(*) FROM tape WHERE lane = 'purchase' AND k > 50) = (SELECT count(*) FROM su JOIN tape ON candidate = event_id WHERE k > 50 AND event_id % 300 <> 5) THEN 'PASS' ELSE 'FAIL' END
UNION ALL SELECT 4, 'mandatory_execution_evidence', CASE WHEN (SELECT count(*) FROM mv2) > 0 AND (SELECT n FROM ac) > 0 AND (SELECT count(*) FROM es) > 0 THEN 'PASS' ELSE 'FAIL' END)
SELECT * FROM g1 UNION ALL SELECT * FROM g2 UNION ALL SELECT * FROM g3 UNION ALL SELECT * FROM g4"""


@query(GATE_SQL)
def gate_suites(spark, sf_dir):
    c = F.col
    lines = materialize(segments(spark, sf_dir), "lines")
    typed = materialize(events.normalize(lines.where("error IS NULL")), "typed")
    base = tape(spark, sf_dir)
    users = base.select("user_id").distinct()
    asset = F.concat(F.lit("a"), "user_id").alias("asset_id")
    days = base.select(F.concat_ws("/", "lane", F.floor(c("at_us") / 86400000000)).alias("object_key"), F.when(F.floor(c("at_us") / 86400000000) % 7 == 0, "unsealed").otherwise("sealed").alias("status")).distinct()
    records = users.select(F.lit("polymarket").alias("venue"), asset, F.lit("captured").alias("provenance"), (c("user_id") % 2 == 0).alias("has_rules"), (c("user_id") % 3 == 0).alias("has_fees"), F.lit(True).alias("valid"))
    sightings = base.where("user_id % 10 <> 0").groupBy("user_id").agg(F.min("at_us").alias("created_at")).select(F.lit("polymarket").alias("venue"), asset, "created_at")
    snapshots = users.where("user_id % 3 <> 2").select(F.concat(F.lit("g"), c("user_id") % 3).alias("metadata_digest")).distinct()
    one = materialize(gates.gate1(lines, typed, days, records, sightings, snapshots), "gate1")
    passed = lambda g: g.agg((F.count_if(c("status") == "FAIL") == 0).alias("passed"))
    venue = lambda x: F.when(x % 2 == 0, "polymarket").otherwise("limitless").alias("venue")
    checked = tape_queries.anchor_check(spark, sf_dir).where("outcome <> 'unobserved'")
    anchors = materialize(checked.select((c("outcome") == "match").alias("matched"), (c("outcome") == "conflict").alias("conflicting"), c("last").alias("stream_ns"), (c("last") + 1).alias("snapshot_ns")), "anchors")
    spans = materialize(tape_queries.market_verdict(spark, sf_dir).select(venue(c("user_id")), c("user_id").alias("market"), "start_ns", "end_ns", "verdict"), "spans")
    market = spans.groupBy("venue", "market").agg(F.min("start_ns").alias("start_ns"), F.max("end_ns").alias("end_ns")).withColumn("model", F.when(c("venue") == "polymarket", "hash_chain").otherwise("full_books"))
    measured = materialize(market_queries.measured(spark, sf_dir), "measured")
    valid = measured.where("valid").select("basket", "size", "event", "day", "net")
    null = materialize(baskets.placebos(valid, ["size"], "event", "day", "net"), "placebos")
    parts = lambda strata: _parts({"intervals": spans, "coverage": intervals.trusted_share(spans, ["venue"], "start_ns", "end_ns", "verdict"), "hash_rate": anchors, "skew_strata": strata})
    two = materialize(gates.gate2(passed(one), anchors, spans, market, parts(base.select("lane").distinct())), "gate2")

    exactly = tape_queries.exact_walks(spark, sf_dir)
    plain = ladder.walk(exact_levels(spark, sf_dir), ["l_partkey"], "price", "size", ladder.HEADLINE, ["l_orderkey", "l_linenumber"])
    walks = exactly.select("l_partkey", c("filled").cast("double").alias("filled"), c("vwap").cast("double").alias("vwap"), "depth_limited").join(plain.select("l_partkey", c("filled").alias("expected_filled"), c("vwap").alias("_v"), c("depth_limited").alias("expected_limited")), "l_partkey")
    walks = walks.withColumn("expected_vwap", F.when(F.abs(c("vwap") - c("_v")) <= 1e-9, c("vwap")).otherwise(c("_v")))  # the other walk is in doubles
    cover = market_queries.cover_cost(spark, sf_dir).select(c("l_orderkey").alias("basket"), "feasible")
    matched = null.where("placebo_market IS NOT NULL").groupBy("basket", "size").agg(F.min("placebo_market").alias("placebo_market"), F.min("placebo_value").alias("placebo_net"))
    legs_of = measured.groupBy("basket").agg((F.count_distinct(c("event") % 2) > 1).alias("cross_venue"))
    rows = measured.join(cover, "basket", "left").join(matched, ["basket", "size"], "left").join(legs_of, "basket").select(
        c("event").alias("market"), F.lit("long").alias("direction"), "size", (c("priority") == "1-URGENT").alias("headline"), "net", (F.coalesce("exclusion", F.lit("")) != "fee_missing").alias("fees_complete"),
        (F.coalesce("exclusion", F.lit("")) == "depth_limited").alias("depth_limited"), "exclusion", "feasible", "cross_venue", F.when(c("placebo_market").isNotNull(), "MATCHED").alias("placebo_status"), "placebo_market", "placebo_net",
    )
    three = materialize(gates.gate3(passed(two), walks, rows, parts(null), ticket=50), "gate3")

    split = materialize(tape_queries.episode_split(spark, sf_dir).withColumn("venue", venue(c("user_id"))), "split")
    lived = intervals.lifetimes(split.withColumn("direction", F.lit("long")), ["venue", "direction", "verdict"])
    lived = lived.withColumn("uncensored", c("episodes") - c("censored_n"))
    bought = base.where("lane = 'purchase'").select(c("event_id").alias("basket"), (c("k") - 50).alias("net"))
    survived = tape_queries.survival(spark, sf_dir).select(c("candidate").alias("basket"), F.lit(gates.ESTIMATOR).alias("estimator"), c("status").isNotNull().alias("not_a_fill_claim"))
    estimates = survived.join(bought.where("net > 0").select("basket"), "basket", "left_semi").where("basket % 300 <> 5")
    four = gates.gate4(passed(three), split.select("venue"), lived, bought, estimates, parts(split))
    suites = [g.select(F.lit(i).alias("gate"), "name", "status") for i, g in enumerate((one, two, three, four), 1)]
    return suites[0].unionByName(suites[1]).unionByName(suites[2]).unionByName(suites[3])


def _parts(tables: dict[str, DataFrame]) -> DataFrame:
    """(part, n_rows): the rows of each part of the evidence, counted."""
    counted = [t.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("part"), "n_rows") for name, t in tables.items()]
    return reduce(DataFrame.unionByName, counted)
