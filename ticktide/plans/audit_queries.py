"""Registered queries of reconciliation and audit operators over the given tables, with oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import epoch_micros
from ..operators import bars, matching, order, reconcile
from ..sources import tape as source
from ..streaming import windows
from . import events, suites
from .tape_queries import TAPE_SQL, table, tape

QUERIES, ORACLES = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


@query("""WITH p AS (SELECT o_custkey, count(*) FILTER (o_orderstatus = 'O') AS O, count(*) FILTER (o_orderstatus = 'F') AS F FROM orders WHERE o_orderstatus IN ('O', 'F') GROUP BY 1) SELECT o_custkey, O, F, O > 0 AND F > 0 AS both_venues FROM p""")
def venue_availability(spark, sf_dir):
    return reconcile.availability(table(spark, sf_dir, "orders").where("o_orderstatus IN ('O', 'F')"), "o_custkey", "o_orderstatus", ["O", "F"])


@query("""WITH v AS (SELECT o_custkey, o_orderstatus AS s, CASE WHEN o_totalprice > 20000 THEN floor(o_totalprice) END AS usd FROM orders), g AS (SELECT o_custkey, sum(CASE WHEN s = 'O' THEN usd END) AS O, sum(CASE WHEN s = 'F' THEN usd END) AS F, sum(usd) AS known_usd, count(*) - count(usd) AS unknown_markets FROM v GROUP BY 1)
SELECT *, coalesce(known_usd >= 1000000, false) AS admitted FROM g""")
def volume_admission(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("usd", F.when(F.col("o_totalprice") > 20000, F.floor("o_totalprice").cast("double")))
    return reconcile.volume_admission(o, "o_custkey", "o_orderstatus", "usd", ["O", "F"], 1000000)


@query(f"""WITH {TAPE_SQL}, r AS (SELECT lane || ':' || k AS semantic_hash, 'm' || (k % 30) AS market, CASE k % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'Maybe' END AS outcome, k % 2 AS outcome_index, event_id FROM tape), f AS (SELECT *, row_number() OVER (PARTITION BY semantic_hash ORDER BY event_id) AS n, count(*) OVER (PARTITION BY semantic_hash) AS deliveries FROM r), o AS (SELECT * FROM f WHERE n = 1), c AS (SELECT market, count(DISTINCT outcome) > 1 AS several FROM o GROUP BY market)
SELECT semantic_hash, o.market, deliveries, CASE WHEN CAST(substr(o.market, 2) AS INTEGER) >= 25 THEN 'unknown_market' WHEN outcome = 'Maybe' THEN 'outcome_not_listed' WHEN (CASE outcome WHEN 'Yes' THEN 0 ELSE 1 END) <> outcome_index THEN 'index_mismatch' WHEN several THEN 'conflicting' ELSE 'consistent' END AS status FROM o JOIN c ON o.market = c.market""")
def resolution_audit(spark, sf_dir):
    k = F.col("k")
    t = tape(spark, sf_dir).select(F.concat_ws(":", "lane", "k").alias("semantic_hash"), F.concat(F.lit("m"), (k % 30).cast("string")).alias("market"), F.when(k % 3 == 0, "Yes").when(k % 3 == 1, "No").otherwise("Maybe").alias("outcome"), (k % 2).alias("outcome_index"), F.col("event_id").alias("seq"))
    catalogue = t.select("market").distinct().where(F.substr("market", F.lit(2)).cast("int") < 25).withColumn("outcomes", F.array(F.lit("Yes"), F.lit("No")))
    return reconcile.resolutions(t, catalogue).select("semantic_hash", "market", "deliveries", "status")


@query(f"""WITH {TAPE_SQL}, a AS (SELECT DISTINCT user_id, k FROM tape WHERE lane = 'click'), b AS (SELECT DISTINCT user_id, k FROM tape WHERE lane = 'view') SELECT (SELECT count(*) FROM a) AS in_stream, (SELECT count(*) FROM b) AS in_snapshots, (SELECT count(*) FROM a JOIN b ON a.user_id = b.user_id AND a.k = b.k) AS in_both""")
def hash_overlap(spark, sf_dir):
    t = tape(spark, sf_dir)
    return reconcile.hash_overlap(t.where("lane = 'click'"), t.where("lane = 'view'"), ["user_id", "k"])


@query("""WITH a AS (SELECT l_orderkey AS k, count(*) AS n, sum(l_quantity) AS q FROM lineitem WHERE l_linenumber <= 4 GROUP BY 1), b AS (SELECT l_orderkey AS k, count(*) AS n, max(l_quantity) AS q FROM lineitem WHERE l_orderkey % 5 <> 0 GROUP BY 1), j AS (SELECT coalesce(a.k, b.k) AS k, a.k AS ak, b.k AS bk, a.n AS an, b.n AS bn, a.q AS aq, b.q AS bq FROM a FULL JOIN b ON a.k = b.k)
SELECT k, "column" FROM (SELECT k, '*missing_in_report' AS "column" FROM j WHERE ak IS NULL UNION ALL SELECT k, '*missing_in_archive' FROM j WHERE bk IS NULL UNION ALL SELECT k, 'n' FROM j WHERE ak IS NOT NULL AND bk IS NOT NULL AND an <> bn UNION ALL SELECT k, 'q' FROM j WHERE ak IS NOT NULL AND bk IS NOT NULL AND aq <> bq)""")
def report_violations(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    a = li.where("l_linenumber <= 4").groupBy(F.col("l_orderkey").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"))
    b = li.where("l_orderkey % 5 <> 0").groupBy(F.col("l_orderkey").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.max("l_quantity").alias("q"))
    return reconcile.report_violations(a, b, ["k"], ["n", "q"]).select("k", "column")


@query("""WITH s AS (SELECT o_orderkey AS k, o_custkey AS sha, CAST(floor(o_totalprice) AS BIGINT) AS len FROM orders WHERE o_orderkey % 7 <> 0), x AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 = 0 THEN o_custkey + 1 ELSE o_custkey END AS sha, CAST(floor(o_totalprice) AS BIGINT) + CASE WHEN o_orderkey % 13 = 0 THEN 1 ELSE 0 END AS len FROM orders WHERE o_orderkey % 9 <> 0)
SELECT concat('o', coalesce(s.k, x.k)) AS object_key, CASE WHEN x.k IS NULL THEN 'unsealed' WHEN s.k IS NULL THEN 'absent' WHEN s.len <> x.len THEN 'length_mismatch' WHEN s.sha <> x.sha THEN 'digest_mismatch' ELSE 'sealed' END AS status FROM s FULL JOIN x ON s.k = x.k""")
def seal_verification(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("object_key"), "o_orderkey", "o_custkey", F.floor("o_totalprice").cast("long").alias("length"))
    segments = o.where("o_orderkey % 7 <> 0").select("object_key", F.col("o_custkey").cast("string").alias("sha256"), "length")
    seals = o.where("o_orderkey % 9 <> 0").select(
        "object_key", F.when(F.col("o_orderkey") % 11 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")).cast("string").alias("sha256"),
        (F.col("length") + F.when(F.col("o_orderkey") % 13 == 0, 1).otherwise(0)).alias("byte_length"), F.lit(1).alias("line_count"),
    )
    return source.verify_seals(segments, seals)


@query("""SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM lineitem r WHERE r.l_orderkey % 4 <> 0 AND r.l_orderkey = lineitem.l_orderkey AND r.l_linenumber = lineitem.l_linenumber AND r.l_partkey = lineitem.l_partkey)""")
def late_segments(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return source.late_segments(li, li.where("l_orderkey % 4 <> 0"), ("l_orderkey", "l_linenumber", "l_partkey"))


@query(f"""WITH {TAPE_SQL}, l AS (SELECT (at_us // 86400000000) AS window_start_ns, lane AS lane_id, bool_and(k <> 50) AS valid FROM tape GROUP BY 1, 2), e AS (SELECT unnest(['click', 'view', 'purchase']) AS lane_id)
SELECT window_start_ns, coalesce(string_agg(CASE WHEN valid AND e.lane_id IS NOT NULL THEN l.lane_id END, ',' ORDER BY l.lane_id), '') AS present, coalesce(string_agg(CASE WHEN NOT valid THEN l.lane_id END, ',' ORDER BY l.lane_id), '') AS invalid, count(*) FILTER (valid AND e.lane_id IS NOT NULL) = 3 AS complete FROM l LEFT JOIN e ON l.lane_id = e.lane_id GROUP BY 1""")
def window_receipts(spark, sf_dir):
    w = tape(spark, sf_dir).select(F.floor(F.col("at_us") / 86400000000).alias("window_start_ns"), F.col("lane").alias("lane_id"), (F.col("k") != 50).alias("valid"))
    expected = spark.createDataFrame([("click",), ("view",), ("purchase",)], "lane_id string")
    out = source.window_receipts(w, expected)
    return out.select("window_start_ns", F.array_join("present", ",").alias("present"), F.array_join("invalid", ",").alias("invalid"), "complete")


@query("""WITH v AS (SELECT p_brand AS k, p_type AS p, count(*) AS n FROM part GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n DESC, p) AS o, count(*) OVER (PARTITION BY k) AS c FROM v) SELECT k, p, c > 1 AS disputed FROM r WHERE o = 1""")
def pair_votes(spark, sf_dir):
    return events.pair_by_vote(table(spark, sf_dir, "part").select(F.col("p_brand").alias("k"), F.col("p_type").alias("p")), "k", "p")


@query("""WITH b AS (SELECT s_suppkey AS k, -1 AS tt, 1.0 AS m FROM supplier UNION ALL SELECT l_suppkey, CAST(epoch_us(l_shipdate) // 86400000000 AS BIGINT), l_tax FROM lineitem), o AS (SELECT k, tt, min(m) AS m, count(DISTINCT m) > 1 AS conflict FROM b GROUP BY 1, 2)
SELECT k, tt AS effective, m AS multiplier, conflict, lead(tt) OVER (PARTITION BY k ORDER BY tt) AS until FROM o""")
def fee_timeline(spark, sf_dir):
    base = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.lit(1.0).alias("multiplier"))
    changes = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("k"), F.floor(epoch_micros("l_shipdate") / 86400000000).alias("effective"), F.col("l_tax").alias("multiplier"))
    return events.fee_timeline(base, changes, "k", "effective", "multiplier")


@query(f"""WITH {TAPE_SQL}, n AS (SELECT lane AS venue, user_id AS asset, k = 99 AND user_id % 5 = 0 AS failed FROM tape WHERE event_id % 2 = 0), p AS (SELECT DISTINCT lane AS venue, user_id AS asset FROM tape WHERE event_id % 2 = 1), b AS (SELECT venue, bool_or(failed) AS bad FROM n GROUP BY venue)
SELECT DISTINCT n.venue, n.asset FROM n JOIN b ON n.venue = b.venue WHERE NOT bad UNION SELECT p.venue, p.asset FROM p LEFT JOIN b ON p.venue = b.venue WHERE bad IS NULL OR bad""")
def carry_forward(spark, sf_dir):
    t = tape(spark, sf_dir).select("event_id", F.col("lane").alias("venue"), F.col("user_id").alias("asset"), ((F.col("k") == 99) & (F.col("user_id") % 5 == 0)).alias("failed"))
    return windows.carry_forward(t.where("event_id % 2 = 0").drop("event_id"), t.where("event_id % 2 = 1").drop("event_id"), "venue", "asset", "failed")


@query("""WITH l AS (SELECT DISTINCT o_custkey AS basket, o_orderstatus AS leg FROM orders), b AS (SELECT DISTINCT o_orderstatus AS leg, epoch_us(o_orderdate) // 2592000000000 AS bar FROM orders), n AS (SELECT basket, count(*) AS n FROM l GROUP BY 1), h AS (SELECT basket, bar, count(*) AS h FROM l JOIN b ON l.leg = b.leg GROUP BY 1, 2)
SELECT h.basket, count(*) AS bars, min(bar) AS first_bar, max(bar) AS last_bar FROM h JOIN n ON h.basket = n.basket WHERE h = n GROUP BY 1""")
def common_bars(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    legs = o.select(F.col("o_custkey").alias("basket"), F.col("o_orderstatus").alias("leg")).distinct()
    b = o.select(F.col("o_orderstatus").alias("leg"), F.floor(epoch_micros("o_orderdate") / 2592000000000).alias("bar")).distinct()
    sets, full = bars.leg_sets(legs, b, "basket", "leg")
    spans = full.groupBy("legs").agg(F.count(F.lit(1)).alias("bars"), F.min("bar").alias("first_bar"), F.max("bar").alias("last_bar"))
    return sets.join(spans, "legs").select("basket", "bars", "first_bar", "last_bar")


@query("""SELECT o_orderkey, CASE WHEN o_totalprice < 10000 THEN 'not_archived' WHEN o_orderstatus = 'P' THEN 'receipt_invalid' WHEN o_orderpriority = '1-URGENT' THEN 'published' WHEN o_custkey % 10 = 0 THEN 'retention_floor' END AS keep_because FROM orders""")
def retention_audit(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    rules = [("not_archived", F.col("o_totalprice") < 10000), ("receipt_invalid", F.col("o_orderstatus") == "P"), ("published", F.col("o_orderpriority") == "1-URGENT"), ("retention_floor", F.col("o_custkey") % 10 == 0)]
    return suites.retention_verdict(o, rules).select("o_orderkey", "keep_because")


@query("""WITH s AS (SELECT o_custkey AS lane, o_orderkey AS no, CASE WHEN o_orderkey % 6 <> 0 THEN o_orderkey * 10 END AS f, CASE WHEN o_orderkey % 6 <> 0 THEN o_orderkey * 10 + CASE WHEN o_orderkey % 4 = 0 THEN 9 ELSE 5 END END AS l FROM orders), w AS (SELECT *, last_value(l IGNORE NULLS) OVER (PARTITION BY lane ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 AS expected FROM s)
SELECT lane, no, f, expected FROM w WHERE f IS NOT NULL AND f <> expected""")
def lane_contiguity(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    full = F.col("o_orderkey") % 6 != 0
    s = o.select(F.col("o_custkey").alias("lane"), F.col("o_orderkey").alias("no"), F.when(full, F.col("o_orderkey") * 10).alias("f"), F.when(full, F.col("o_orderkey") * 10 + F.when(F.col("o_orderkey") % 4 == 0, 9).otherwise(5)).alias("l"))
    return order.lane_contiguity(s, "lane", "no", "f", "l").select("lane", "no", "f", "expected")


@query("""WITH m AS (SELECT o_custkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'fast' WHEN o_orderpriority = '3-MEDIUM' THEN 'mid' ELSE 'slow' END AS class FROM orders) SELECT o_custkey AS key, CASE WHEN count(DISTINCT class) = 1 THEN min(class) END AS class FROM m GROUP BY 1""")
def agreed_class(spark, sf_dir):
    mapping = spark.createDataFrame([("1-URGENT", "fast"), ("2-HIGH", "fast"), ("3-MEDIUM", "mid"), ("4-LOW", "slow"), ("4-NOT SPECIFIED", "slow"), ("5-LOW", "slow")], "label string, class string")
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), F.col("o_orderpriority").alias("label"))
    return matching.agreed_class(o, "key", "label", mapping)


@query("""WITH r AS (SELECT o_orderkey AS receipt, o_orderstatus AS lane, o_custkey AS f, o_orderkey % 10 AS i, 'h' || o_orderkey AS sha, o_orderkey AS k FROM orders)
SELECT receipt, lane, CAST(f AS VARCHAR) AS source_file, CASE WHEN k % 23 = 0 THEN 'durability_gate' WHEN k % 29 = 0 OR k % 31 = 0 THEN 'archive_receipt_invalid' WHEN k % 7 = 0 OR k % 11 = 0 THEN 'archive_object_unverified'
WHEN k % 13 = 0 THEN 'canonical_missing' WHEN k % 17 = 0 THEN 'canonical_mismatch' WHEN k % 5 = 0 AND k % 3 = 0 THEN 'already_removed' WHEN k % 5 = 0 THEN 'partial_cleanup_pending' WHEN k % 3 = 0 OR k % 19 = 0 THEN 'local_source_changed' ELSE 'all_conditions_hold' END AS reason,
reason IN ('all_conditions_hold', 'partial_cleanup_pending') AS removable FROM r""")
def retention_decisions(spark, sf_dir):
    c, k = F.col, F.col("o_orderkey")
    o = table(spark, sf_dir, "orders")
    sha = F.concat(F.lit("h"), k.cast("string"))
    lane, file = c("o_orderstatus").alias("lane"), c("o_custkey").cast("string")
    receipts = o.select(k.alias("receipt"), lane, file.alias("source_file"), (k % 10).alias("segment_index"), sha.alias("sha256"), k.alias("length"), (k % 29 != 0).alias("valid"), (k % 23 == 0).alias("conformance"), F.concat(F.lit("lane="), F.when(k % 31 == 0, "x").otherwise(c("o_orderstatus"))).alias("lane_dir"))
    archived = o.where(k % 7 != 0).select(k.alias("receipt"), sha.alias("sha256"), F.when(k % 11 == 0, k + 1).otherwise(k).alias("length"))
    canonical = o.where(k % 13 != 0).select(lane, sha.alias("sha256"), F.when(k % 17 == 0, "other").otherwise(file).alias("source_file"), (k % 10).alias("segment_index"))
    # a customer has many orders: the local file of a receipt is told apart by its receipt's number
    own = F.concat_ws("#", file, k.cast("string"))
    local = o.where(k % 5 != 0).select(lane, own.alias("source_file"), F.lit("source").alias("kind"), F.when(k % 19 == 0, "changed").otherwise(sha).alias("sha256")).unionByName(o.where(k % 3 != 0).select(lane, own.alias("source_file"), F.lit("seal").alias("kind"), F.lit(None).cast("string").alias("sha256")))
    mine = lambda df: df.withColumn("source_file", F.concat_ws("#", "source_file", F.substring("sha256", 2, 20)))
    out = reconcile.retention_decisions(mine(receipts), archived, mine(canonical), local)
    return out.withColumn("source_file", F.substring_index("source_file", "#", 1))


@query("""WITH n AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS i, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders) SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY i) AS examples, max(n) AS n FROM n WHERE i <= 3 GROUP BY 1""")
def first_examples(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("by_price", -F.col("o_totalprice"))
    return reconcile.first_examples(o, ["o_custkey"], ["by_price", "o_orderkey"], "o_orderkey", 3).select("o_custkey", F.array_join(F.transform("examples", lambda x: x.cast("string")), ",").alias("examples"), "n")
