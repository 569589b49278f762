"""Registered queries over ``events`` as a tape and ``lineitem`` as ladders, with oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import epoch_micros, fingerprint, set_digest, skew_band
from ..operators import bars, exact, intervals, ladder, order
from ..sources.scratch import materialize
from ..streaming import windows

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    """Register a query under its name, with its oracle."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as ladders: one level a row, keyed by part."""
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_discount", (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), F.col("l_quantity").alias("size"))


LEVEL_SQL = "lv AS (SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, l_discount, l_extendedprice / l_quantity AS price, l_quantity AS size FROM lineitem)"
LEVEL_ORDER = ["l_orderkey", "l_linenumber", "l_suppkey", "size", "l_discount"]


def tape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a tape: lane = type, epoch = user, delivery index = id, clock in microseconds."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", "user_id", F.col("event_type").alias("lane"), "value", "props", epoch_micros("ts").alias("at_us"), F.get_json_object("props", "$.k").cast("int").alias("k"))


TAPE_SQL = "tape AS (SELECT event_id, user_id, event_type AS lane, value, props, epoch_us(ts) AS at_us, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"


# ---- ladders


@query(f"""WITH {LEVEL_SQL}, w AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY l_partkey ORDER BY price, l_orderkey, l_linenumber, l_suppkey, size, l_discount ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM lv WHERE size > 0),
t AS (SELECT l_partkey, price, greatest(0, least(size, 100 - before)) AS take FROM w)
SELECT l_partkey, sum(take) AS filled, round(sum(take * price) + 1e-6, 2) AS notional, round(sum(take * price) / sum(take) + 1e-7, 4) AS vwap, sum(take) < 100 AS depth_limited FROM t GROUP BY l_partkey""")
def ladder_vwap(spark, sf_dir):
    # a nudge before rounding: engines add in different orders, and many sums end on a half
    out = ladder.walk(levels(spark, sf_dir), ["l_partkey"], "price", "size", ladder.HEADLINE, LEVEL_ORDER)
    return out.select("l_partkey", "filled", F.round(F.col("notional") + 1e-6, 2).alias("notional"), F.round(F.col("vwap") + 1e-7, 4).alias("vwap"), "depth_limited")


#: lineitem as ladders of exact ticks: prices and sizes in ten-thousandths, whole numbers in SQL.
EXACT_SQL = """xl AS (SELECT l_partkey, l_orderkey, l_linenumber, CAST(CAST(round(l_extendedprice * 100) AS BIGINT) % 9999 + 1 AS HUGEINT) AS p, CAST(l_quantity * 10000 + l_linenumber * 625 AS HUGEINT) AS s, CAST(200 + l_suppkey % 7 * 100 AS HUGEINT) AS rate FROM lineitem),
xw AS (SELECT *, coalesce(sum(s) OVER (PARTITION BY l_partkey ORDER BY p, l_orderkey, l_linenumber ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM xl), xt AS (SELECT *, CAST(greatest(0, least(s, 1000000 - b)) AS HUGEINT) AS take FROM xw),
xg AS (SELECT l_partkey, CAST(sum(take) AS HUGEINT) AS f, CAST(sum(take * p) AS HUGEINT) AS n, CAST(sum(rate * take * (p * (10000 - p)) * (p * (10000 - p))) AS HUGEINT) AS fee FROM xt GROUP BY l_partkey),
xe AS (SELECT *, f < 1000000 AS short, (2 * n * 100000000 + f) // (2 * f) AS vwap, (fee + 99999999999999999999) // 100000000000000000000 AS up FROM xg)"""


def exact_levels(spark, sf_dir):
    c = F.col
    return table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", ((F.round(c("l_extendedprice") * 100).cast("long") % 9999 + 1) / 10000).alias("price"), (c("l_quantity") + c("l_linenumber") * 0.0625).alias("size"), ((2 + c("l_suppkey") % 7) / 100).alias("rate"))


def exact_walks(spark, sf_dir):
    return exact.walk(exact_levels(spark, sf_dir), ["l_partkey"], "price", "size", ladder.HEADLINE, ["l_orderkey", "l_linenumber"], exact.decimal(F.col("rate")), exponent=2)


def _units(column: str, digits: int):
    return (F.col(column) * F.lit(10**digits).cast(f"decimal({digits + 1},0)")).cast("decimal(38,0)").cast("string").alias(f"{column}_e{digits}")


@query(f"WITH {EXACT_SQL} SELECT l_partkey, CAST(f AS VARCHAR) AS filled_e4, CAST(n AS VARCHAR) AS notional_e8, CAST(vwap AS VARCHAR) AS vwap_e12, CAST(fee AS VARCHAR) AS fee_e24, CAST(up AS VARCHAR) AS fee_conservative_e4, short AS depth_limited FROM xe")
def ladder_vwap_exact(spark, sf_dir):
    w = exact_walks(spark, sf_dir).withColumn("fee_e24", F.regexp_replace(F.regexp_replace(F.col("fee").cast("decimal(38,24)").cast("string"), r"[.]", ""), "^0+(?=.)", ""))
    return w.select("l_partkey", _units("filled", 4), _units("notional", 8), _units("vwap", 12), "fee_e24", _units("fee_conservative", 4), "depth_limited")


@query(f"""WITH {EXACT_SQL}, g AS (SELECT l_partkey // 3 AS basket, count(*) AS legs, sum(n) AS gross, sum(up) AS fee, bool_or(short) AS thin FROM xe GROUP BY 1), m AS (SELECT *, CASE WHEN legs < 3 THEN 'one_sided' WHEN thin THEN 'depth_limited' END AS exclusion FROM g), o AS (SELECT *, CASE WHEN exclusion IS NULL THEN CAST(gross + fee * 10000 AS HUGEINT) END AS net FROM m)
SELECT basket, legs, CAST(CAST(gross AS HUGEINT) AS VARCHAR) AS gross_e8, CAST(net AS VARCHAR) AS net_e8, CAST(10000000000 - net AS VARCHAR) AS profit_e8, exclusion FROM o""")
def basket_exact(spark, sf_dir):
    legs = exact_walks(spark, sf_dir).withColumn("basket", F.floor(F.col("l_partkey") / 3))
    m = exact.measure(legs, ["basket"], F.lit(3), ladder.HEADLINE)
    return m.select("basket", "legs", _units("gross", 8), _units("net", 8), _units("profit", 8), "exclusion")


@query(f"""WITH {LEVEL_SQL}, p AS (SELECT *, price / 100000.0 AS q FROM lv), w AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY l_partkey ORDER BY price, l_orderkey, l_linenumber, l_suppkey, size, l_discount ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM p),
t AS (SELECT l_partkey, q, greatest(0, least(size, 250 - before)) AS take FROM w), f AS (SELECT l_partkey, sum(0.07 * take * q * (1 - q)) AS raw FROM t GROUP BY l_partkey)
SELECT l_partkey, round(raw, 6) AS raw_fee, round(ceil(round(raw, 8) / 0.0001 - 1e-9) * 0.0001, 4) AS conservative FROM f""")
def ladder_fee(spark, sf_dir):
    lv = ladder.fills(levels(spark, sf_dir), ["l_partkey"], "price", "size", 250, LEVEL_ORDER)
    q = F.col("price") / 100000.0
    out = lv.groupBy("l_partkey").agg(F.sum(ladder.fee(q, F.col("take"), 0.07)).alias("raw"))
    return out.select("l_partkey", F.round("raw", 6).alias("raw_fee"), F.round(F.ceil(F.round("raw", 8) / ladder.FEE_INCREMENT - 1e-9) * ladder.FEE_INCREMENT, 4).alias("conservative"))


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, l_extendedprice / l_quantity / 2100.0 - 0.2 AS price, l_quantity - 2 AS size, lag(l_extendedprice / l_quantity / 2100.0 - 0.2) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS prev FROM lineitem),
g AS (SELECT l_orderkey, count(*) AS n, bool_or(price <= 0 OR price >= 1) AS a, bool_or(size < 0) AS b, count(DISTINCT price) < count(*) AS c, coalesce(bool_or(price < prev), false) AS d FROM l GROUP BY l_orderkey)
SELECT l_orderkey, n AS levels, concat_ws(',', CASE WHEN c THEN 'duplicate_price' END, CASE WHEN b THEN 'negative_size' END, CASE WHEN a THEN 'price_out_of_bounds' END, CASE WHEN d THEN 'wrong_order' END) AS issues FROM g""")
def ladder_issues(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice") / F.col("l_quantity") / 2100.0 - 0.2
    order_ = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", price.alias("price"), (F.col("l_quantity") - 2).alias("size"))
    arr = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(order_)).alias("x")).withColumn("lv", F.transform("x", lambda s: F.struct(s["price"].alias("price"), s["size"].alias("size"))))
    return arr.select("l_orderkey", F.size("lv").cast("long").alias("levels"), F.array_join(ladder.issues(F.col("lv")), ",").alias("issues"))


@query("""WITH l AS (SELECT l_partkey, 1 - l_extendedprice / l_quantity / 2100.0 AS price, l_quantity AS size FROM lineitem)
SELECT l_partkey, count(*) AS levels, round(min(price), 9) AS best, round(max(price), 9) AS worst, sum(size) AS depth FROM l GROUP BY l_partkey""")
def ladder_complement(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_partkey", F.struct((F.col("l_extendedprice") / F.col("l_quantity") / 2100.0).alias("price"), F.col("l_quantity").alias("size")).alias("s"))
    arr = li.groupBy("l_partkey").agg(ladder.complement(F.collect_list("s")).alias("c"))
    return arr.select("l_partkey", F.size("c").cast("long").alias("levels"), F.round(F.element_at("c", 1)["price"], 9).alias("best"), F.round(F.element_at("c", -1)["price"], 9).alias("worst"), F.aggregate("c", F.lit(0.0), lambda a, x: a + x["size"]).alias("depth"))


@query("""WITH c AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey), o AS (SELECT o_orderpriority AS priority, n, count(*) AS k FROM c JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
s AS (SELECT priority, max(n) AS max_levels, count(*) AS distinct_counts, sum(k) AS total FROM o GROUP BY 1)
SELECT s.priority, max_levels, distinct_counts, round(k * 1.0 / total, 9) AS share_at_max FROM s JOIN o ON s.priority = o.priority AND n = max_levels""")
def level_counts(spark, sf_dir):
    from ..operators.baskets import level_counts as op

    counts = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    rows = counts.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_orderpriority").alias("priority"), "n")
    return op(rows, ["priority"], "n").withColumn("share_at_max", F.round("share_at_max", 9))


# ---- order, continuity, identity


@query(f"""WITH {TAPE_SQL}, r AS (SELECT *, (at_us // 3600000000) AS hour, CASE lane WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'purchase' THEN 2 ELSE 1000 END AS lane_rank FROM tape)
SELECT event_id, lane_rank, row_number() OVER (ORDER BY hour, lane_rank, lane, event_id) AS seq FROM r""")
def tape_order(spark, sf_dir):
    ranks = spark.createDataFrame([("click", 0), ("view", 1), ("purchase", 2)], "lane string, lane_rank int")
    t = order.ranked(tape(spark, sf_dir).withColumn("hour", F.floor(F.col("at_us") / 3600000000)), F.broadcast(ranks))
    return order.dense_sequence(t, ["hour", "lane_rank", "lane", "event_id"]).select("event_id", "lane_rank", "seq")


@query(f"""WITH {TAPE_SQL}, k AS (SELECT * FROM tape WHERE event_id % 97 <> 0), w AS (SELECT event_id, lane, at_us, row_number() OVER (PARTITION BY lane ORDER BY event_id) AS n FROM tape), d AS (SELECT w.* FROM w WHERE event_id % 97 <> 0),
x AS (SELECT lane, event_id, n AS counter, lag(n) OVER (PARTITION BY lane ORDER BY n) + 1 AS expected FROM d) SELECT lane, event_id, counter, expected FROM x WHERE expected IS NOT NULL AND counter <> expected""")
def dense_breaks(spark, sf_dir):
    t = tape(spark, sf_dir).withColumn("counter", F.row_number().over(Window.partitionBy("lane").orderBy("event_id")))
    return order.dense_breaks(t.where("event_id % 97 <> 0"), ["lane"], "counter").select("lane", "event_id", "counter", "expected")


DELIVERED_SQL = "del AS (SELECT event_id, user_id, lane, at_us, k, value, props, event_id * 2 AS seq FROM tape UNION ALL SELECT event_id, user_id, lane, at_us, k, value, CASE WHEN event_id % 202 = 0 THEN props || '!' ELSE props END, event_id * 2 + 1 FROM tape WHERE event_id % 101 = 0)"


def delivered(spark, sf_dir):
    t = tape(spark, sf_dir)
    again = t.where("event_id % 101 = 0").withColumn("props", F.when(F.col("event_id") % 202 == 0, F.concat("props", F.lit("!"))).otherwise(F.col("props"))).withColumn("seq", F.col("event_id") * 2 + 1)
    return t.withColumn("seq", F.col("event_id") * 2).unionByName(again)


@query(f"""WITH {TAPE_SQL}, {DELIVERED_SQL}, v AS (SELECT seq, event_id, CASE WHEN row_number() OVER w = 1 THEN 'unseen' WHEN props = first_value(props) OVER w THEN 'duplicate' ELSE 'conflict' END AS verdict FROM del WINDOW w AS (PARTITION BY event_id ORDER BY seq))
SELECT seq, event_id, verdict FROM v WHERE verdict <> 'unseen'""")
def identity_verdict(spark, sf_dir):
    return order.identity_verdict(delivered(spark, sf_dir), [], "event_id", "props", "seq").where("verdict <> 'unseen'").select("seq", "event_id", "verdict")


@query(f"""WITH {TAPE_SQL}, h AS (SELECT event_id, lane, at_us // 3600000000 AS hour FROM tape), g AS (SELECT hour, min(lane) <> max(lane) AS tied FROM h GROUP BY hour)
SELECT event_id, CASE WHEN tied THEN h.hour END AS tie FROM h JOIN g ON h.hour = g.hour""")
def tie_groups(spark, sf_dir):
    t = tape(spark, sf_dir).withColumn("hour", F.floor(F.col("at_us") / 3600000000))
    return order.tie_groups(t, "hour", "lane").select("event_id", "tie")


CURSOR_SQL = """cur AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n0, k FROM tape),
cu AS (SELECT event_id, user_id, CASE WHEN event_id % 97 = 1 THEN n0 + 1000000 ELSE n0 END AS counter, CASE WHEN k < 3 THEN 'lifecycle' WHEN k < 10 THEN 'snapshot' WHEN k < 14 THEN 'unsequenced' ELSE 'range' END AS kind, CASE WHEN event_id % 53 = 0 THEN n0 - 5 ELSE n0 END AS fst FROM cur WHERE event_id % 89 <> 0),
ca AS (SELECT *, lag(counter) OVER w AS b, max(CASE WHEN kind <> 'lifecycle' THEN fst END) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM cu WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
causes AS (SELECT event_id, user_id, CASE WHEN b IS NOT NULL AND counter <> b + 1 THEN 'local_break' WHEN kind = 'lifecycle' THEN 'lifecycle' WHEN kind = 'unsequenced' THEN 'unsequenced' WHEN seen IS NULL OR kind = 'snapshot' THEN 'bootstrap' WHEN fst <= seen THEN 'backwards' WHEN fst - 1 > seen THEN 'gap_proven' ELSE 'continuous' END AS cause FROM ca)"""


def cursors(spark, sf_dir):
    t = tape(spark, sf_dir).withColumn("n0", F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))).where("event_id % 89 <> 0")
    first = F.when(F.col("event_id") % 53 == 0, F.col("n0") - 5).otherwise(F.col("n0")).cast("long")
    kind = F.when(F.col("k") < 3, "lifecycle").when(F.col("k") < 10, "snapshot").when(F.col("k") < 14, "unsequenced").otherwise("range")
    return t.select("event_id", "user_id", F.when(F.col("event_id") % 97 == 1, F.col("n0") + 1000000).otherwise(F.col("n0")).cast("long").alias("counter"), kind.alias("kind"), first.alias("first"), first.alias("last"), (first - 1).alias("previous"))


@query(f"WITH {TAPE_SQL}, {CURSOR_SQL} SELECT event_id, user_id, cause FROM causes")
def continuity_causes(spark, sf_dir):
    return order.continuity_causes(cursors(spark, sf_dir), ["user_id"], "event_id", "counter", "kind", "first", "last", "previous").select("event_id", "user_id", "cause")


@query(f"""WITH {TAPE_SQL}, {CURSOR_SQL}, g AS (SELECT user_id, count(*) FILTER (cause <> 'lifecycle') AS frames, count(*) FILTER (cause = 'gap_proven') AS gaps, count(*) FILTER (cause = 'backwards') AS backwards, count(*) FILTER (cause = 'local_break') AS breaks FROM causes GROUP BY user_id)
SELECT *, CASE WHEN gaps + backwards + breaks > 0 THEN 'stale' WHEN frames > 0 THEN 'healthy' ELSE 'awaiting_bootstrap' END AS health FROM g""")
def epoch_health(spark, sf_dir):
    return order.epoch_health(continuity_causes(spark, sf_dir), ["user_id"])


@query(f"""WITH {TAPE_SQL}, m AS (SELECT lane, event_id, at_us - CASE WHEN event_id % 61 = 0 THEN 36000000000 ELSE 0 END AS clock FROM tape), w AS (SELECT *, lag(clock) OVER (PARTITION BY lane ORDER BY event_id) AS previous FROM m) SELECT lane, event_id, clock, previous FROM w WHERE clock < previous""")
def clock_regressions(spark, sf_dir):
    t = tape(spark, sf_dir).withColumn("clock", F.col("at_us") - F.when(F.col("event_id") % 61 == 0, 36000000000).otherwise(0))
    return order.regressions(t, ["lane"], ["event_id"], "clock").select("lane", "event_id", "clock", "previous")


@query(f"""WITH {TAPE_SQL}, m AS (SELECT lane, user_id AS epoch, event_id, lag(user_id) OVER (PARTITION BY lane ORDER BY event_id) AS b FROM tape), c AS (SELECT * FROM m WHERE b IS NULL OR b <> epoch) SELECT lane, arg_max(epoch, event_id) AS owner, max(event_id) AS since FROM c GROUP BY lane""")
def lane_authority(spark, sf_dir):
    return order.lane_authority(tape(spark, sf_dir).withColumnRenamed("user_id", "epoch"), ["lane"], "epoch", "event_id")


@query(f"""WITH {TAPE_SQL}, w AS (SELECT user_id, event_id, k, max(k) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS highest FROM tape) SELECT * FROM w WHERE k < highest""")
def version_regressions(spark, sf_dir):
    return order.version_regressions(tape(spark, sf_dir), ["user_id"], ["event_id"], "k").select("user_id", "event_id", "k", "highest")


@query(f"""WITH {TAPE_SQL}, s AS (SELECT *, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS nxt FROM tape), w AS (SELECT user_id, event_id, CASE WHEN k % 7 = 0 THEN event_id - 1 ELSE lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) END AS prev, last_value(CASE WHEN k % 5 <> 0 THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS held FROM s)
SELECT user_id, event_id, prev, held FROM w WHERE held IS NOT NULL AND prev IS NOT NULL AND prev <> held""")
def cursor_breaks(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("event_id")
    t = tape(spark, sf_dir).withColumn("prev", F.when(F.col("k") % 7 == 0, F.col("event_id") - 1).otherwise(F.lag("event_id").over(w)))
    return order.cursor_breaks(t, ["user_id"], ["event_id"], "event_id", "prev", F.col("k") % 5 != 0).select("user_id", "event_id", "prev", "held")


@query(f"""WITH {TAPE_SQL}, n AS (SELECT *, at_us // 86400000000 AS day, row_number() OVER (PARTITION BY user_id, at_us // 86400000000, lane ORDER BY event_id) AS pair_no FROM tape WHERE lane IN ('click', 'view'))
SELECT a.user_id, a.day, a.pair_no, a.event_id AS event_id_a, b.event_id AS event_id_b FROM n a JOIN n b ON a.user_id = b.user_id AND a.day = b.day AND a.pair_no = b.pair_no AND a.lane = 'click' AND b.lane = 'view'""")
def leg_pairs(spark, sf_dir):
    t = tape(spark, sf_dir).where("lane IN ('click', 'view')").select("user_id", F.floor(F.col("at_us") / 86400000000).alias("day"), "lane", "event_id")
    return order.fifo_pairs(t, ["user_id", "day"], "lane", ("click", "view"), ["event_id"])


@query(f"""WITH {TAPE_SQL}, o AS (SELECT *, count(*) FILTER (lane = 'view') OVER (PARTITION BY user_id ORDER BY event_id) AS g FROM tape), v AS (SELECT *, max(CASE WHEN lane = 'view' THEN event_id END) OVER (PARTITION BY user_id, g) AS at FROM o)
SELECT v.event_id, CASE WHEN b.k < 20 THEN NULL ELSE b.props END AS digest FROM v LEFT JOIN tape b ON v.at = b.event_id""")
def active_digest(spark, sf_dir):
    t = tape(spark, sf_dir).withColumn("d", F.when(F.col("k") >= 20, F.col("props")))
    return order.last_before(t, ["user_id"], ["event_id"], "d", F.col("lane") == "view", "digest").select("event_id", "digest")


@query("SELECT event_id, sha256(concat('k=', json_extract_string(props, '$.k'), chr(10), 'user=', CAST(user_id AS VARCHAR))) AS projection FROM events")
def projection_hash(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    text = F.concat(F.lit("k="), F.get_json_object("props", "$.k"), F.lit("\nuser="), F.col("user_id").cast("string"))
    return e.select("event_id", F.sha2(text.cast("binary"), 256).alias("projection"))


@query(f"""WITH {TAPE_SQL}, {DELIVERED_SQL}, f AS (SELECT min(seq) AS seq, event_id, props FROM del WHERE event_id % 3 <> 0 GROUP BY event_id, props) SELECT event_id, props, sha256(concat(CAST(event_id AS VARCHAR), chr(31), props)) AS fp FROM f""")
def row_dedup(spark, sf_dir):
    rows = delivered(spark, sf_dir).withColumn("fp", fingerprint("event_id", "props"))
    return order.new_rows(rows.select("event_id", "props", "fp"), rows.where("event_id % 3 = 0").select("fp"), "fp").select("event_id", "props", "fp")


@query(f"""WITH {TAPE_SQL}, {DELIVERED_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY seq) AS n, count(*) OVER (PARTITION BY event_id) AS deliveries FROM del) SELECT event_id, seq, props, deliveries FROM r WHERE n = 1""")
def first_deliveries(spark, sf_dir):
    return order.first_of_each(delivered(spark, sf_dir).select("event_id", "seq", "props"), "event_id", ["seq"]).select("event_id", "seq", "props", "deliveries")


@query("""SELECT user_id, sha256(string_agg(k, chr(10) ORDER BY k)) AS digest FROM (SELECT DISTINCT user_id, json_extract_string(props, '$.k') AS k FROM events) GROUP BY user_id""")
def target_digest(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(set_digest(F.get_json_object("props", "$.k")).alias("digest"))


# ---- bars and as-of


@query(f"""WITH {TAPE_SQL}, b AS (SELECT user_id, unnest(generate_series(CAST(ceil(at_us / 3600000000.0) AS BIGINT), (at_us + 21600000000) // 3600000000)) * 3600000000 AS bar, at_us, event_id, value FROM tape), r AS (SELECT *, row_number() OVER (PARTITION BY user_id, bar ORDER BY at_us DESC, event_id DESC) AS n FROM b)
SELECT user_id, bar, at_us, event_id, round(value, 6) AS value, bar - at_us AS age FROM r WHERE n = 1""")
def bars_asof(spark, sf_dir):
    out = bars.bar_snapshots(tape(spark, sf_dir), ["user_id"], "at_us", 3600000000, 21600000000, ["event_id", "value"], ["event_id"])
    return out.withColumn("value", F.round("value", 6))


@query(f"""WITH {TAPE_SQL}, s AS (SELECT user_id, at_us AS eff, k AS rate FROM tape WHERE lane = 'purchase'), u AS (SELECT user_id, at_us, event_id FROM tape WHERE lane = 'click')
SELECT u.event_id, s.rate FROM u ASOF LEFT JOIN s ON u.user_id = s.user_id AND u.at_us >= s.eff""")
def fee_asof(spark, sf_dir):
    t = tape(spark, sf_dir)
    timeline = t.where("lane = 'purchase'").select("user_id", F.col("at_us").alias("eff"), F.col("k").alias("rate"))
    return bars.schedule_at(t.where("lane = 'click'").select("user_id", "at_us", "event_id"), timeline, ["user_id"], "at_us", "eff", ["rate"]).select("event_id", "rate")


@query(f"""WITH {TAPE_SQL}, a AS (SELECT * FROM tape WHERE lane = 'purchase'), b AS (SELECT * FROM tape WHERE lane = 'view'), p AS (SELECT a.event_id, b.event_id AS partner, abs(a.at_us - b.at_us) AS gap, b.at_us AS t FROM a JOIN b ON a.user_id = b.user_id AND abs(a.at_us - b.at_us) <= 43200000000),
r AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY gap, t) AS n FROM p) SELECT a.event_id, r.partner, r.gap FROM a LEFT JOIN r ON a.event_id = r.event_id AND r.n = 1""")
def nearest_pair(spark, sf_dir):
    t = tape(spark, sf_dir)
    left, right = t.where("lane = 'purchase'").select("event_id", "user_id", "at_us"), t.where("lane = 'view'").select("user_id", "at_us", F.col("event_id").alias("partner"))
    out = bars.nearest(left, right, ["user_id"], "at_us", "at_us", "partner", 43200000000)
    return out.select("event_id", F.col("nearest_value").alias("partner"), F.abs(F.col("nearest_at") - F.col("at_us")).alias("gap"))


@query(f"""WITH {TAPE_SQL}, q AS (SELECT event_id, user_id, at_us FROM tape WHERE lane = 'click'), a AS (SELECT user_id, at_us FROM tape WHERE lane = 'view') SELECT q.event_id, min(a.at_us) AS answered_at, min(a.at_us) - q.at_us AS latency FROM q LEFT JOIN a ON q.user_id = a.user_id AND a.at_us > q.at_us GROUP BY q.event_id, q.at_us""")
def fulfilment(spark, sf_dir):
    return bars.fulfilment(tape(spark, sf_dir), ["user_id"], "at_us", F.col("lane") == "click", F.col("lane") == "view").select("event_id", "answered_at", "latency")


# ---- books, intervals


def book_events(spark, sf_dir):
    """events as deltas: asset = user, price = k, size = value, position = id; every 40th of a lane is a book."""
    kind = F.when(F.col("event_id") % 40 == 7, "book").otherwise("delta")
    return tape(spark, sf_dir).select("user_id", F.col("event_id").alias("pos"), kind.alias("kind"), F.lit("bid").alias("side"), F.col("k").cast("double").alias("price"), F.when(F.col("event_id") % 9 == 0, 0.0).otherwise(F.col("value")).alias("size"))


BOOK_SQL = """be AS (SELECT user_id, event_id AS pos, event_id % 40 = 7 AS is_book, k AS price, CASE WHEN event_id % 9 = 0 THEN 0.0 ELSE value END AS size FROM tape),
br AS (SELECT *, max(CASE WHEN is_book THEN pos END) OVER (PARTITION BY user_id ORDER BY pos) AS reset FROM be), bl AS (SELECT *, lead(pos) OVER (PARTITION BY user_id, reset, price ORDER BY pos) AS nxt FROM br WHERE reset IS NOT NULL),
bx AS (SELECT DISTINCT user_id, reset FROM br WHERE reset IS NOT NULL), bn AS (SELECT *, lead(reset) OVER (PARTITION BY user_id ORDER BY reset) AS nreset FROM bx),
lvl AS (SELECT bl.user_id, bl.price, bl.size, bl.pos AS f, coalesce(bl.nxt, bn.nreset) AS t FROM bl JOIN bn ON bl.user_id = bn.user_id AND bl.reset = bn.reset WHERE bl.size > 0)"""


@query(f"""WITH {TAPE_SQL}, {BOOK_SQL} SELECT p.user_id, p.pos, count(*) AS levels, round(sum(lvl.size), 4) AS depth, CAST(min(lvl.price) AS DOUBLE) AS best FROM be p JOIN lvl ON p.user_id = lvl.user_id AND lvl.f <= p.pos AND (lvl.t IS NULL OR p.pos < lvl.t) GROUP BY p.user_id, p.pos""")
def book_states(spark, sf_dir):
    e = book_events(spark, sf_dir)
    lv = intervals.book_levels(e, "user_id", "pos", "kind", "side", "price", "size")
    at = intervals.book_at(lv, e.select("user_id", "pos"), "user_id", "pos")
    return at.groupBy("user_id", "pos").agg(F.count(F.lit(1)).alias("levels"), F.round(F.sum("size"), 4).alias("depth"), F.min("price").alias("best"))


RUN_SQL = "hr AS (SELECT *, sum(CASE WHEN b IS NULL OR b <> lane THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM (SELECT *, lag(lane) OVER (PARTITION BY user_id ORDER BY event_id) AS b FROM tape))"


@query(f"""WITH {TAPE_SQL}, {RUN_SQL}, e AS (SELECT user_id, lane AS state_hash, run, max(event_id) AS last, arg_max(k, event_id) % 10 AS book FROM hr GROUP BY user_id, lane, run),
a AS (SELECT user_id, lane AS state_hash, arg_min(k, event_id) % 10 AS anchor, count(DISTINCT k % 10) > 1 AS conflict FROM tape WHERE event_id % 50 = 3 GROUP BY user_id, lane)
SELECT e.user_id, e.state_hash, e.run, e.last, CASE WHEN anchor IS NULL THEN 'unobserved' WHEN conflict THEN 'conflict' WHEN book = anchor THEN 'match' ELSE 'differ' END AS outcome FROM e LEFT JOIN a ON e.user_id = a.user_id AND e.state_hash = a.state_hash""")
def anchor_check(spark, sf_dir):
    t = tape(spark, sf_dir).select("user_id", F.col("event_id").alias("pos"), F.col("lane").alias("state_hash"), (F.col("k") % 10).alias("book"))
    runs = intervals.hash_runs(t, "user_id", "pos", "state_hash")
    ends = runs.join(t.select("user_id", F.col("pos").alias("last"), "book"), ["user_id", "last"])
    anchors = t.where("pos % 50 = 3").select("user_id", "state_hash", "book", F.col("pos").alias("seen_at"))
    return intervals.check_anchors(ends, anchors, "user_id", "state_hash", "book").select("user_id", "state_hash", "run", "last", "outcome")


SIGNAL_SQL = """sg AS (SELECT user_id, k % 3 AS member, at_us, CASE WHEN lane = 'purchase' THEN 'close' WHEN k % 4 = 0 THEN 'open' ELSE 'state' END AS action, CASE WHEN lane = 'click' THEN 'TRUSTED' WHEN lane = 'view' THEN 'UNTRUSTED' ELSE 'UNKNOWN' END AS verdict, event_id FROM tape),
iv AS (SELECT user_id, member, at_us AS start_ns, coalesce(lead(at_us) OVER (PARTITION BY user_id, member ORDER BY at_us, event_id), 1893456000000000) AS end_ns, action, verdict FROM sg), ti AS (SELECT user_id, member, start_ns, end_ns, verdict FROM iv WHERE action <> 'close' AND start_ns < end_ns)"""


def trust(t, written=False):
    """A tape's trust: asset = user and member."""
    v = F.when(F.col("lane") == "click", "TRUSTED").when(F.col("lane") == "view", "UNTRUSTED").otherwise("UNKNOWN")
    action = F.when(F.col("lane") == "purchase", "close").when(F.col("k") % 4 == 0, "open").otherwise("state")
    t = t.select("user_id", (F.col("k") % 3).alias("member"), "at_us", "event_id", action.alias("action"), v.alias("verdict"))
    return intervals.trust_intervals(t, ["user_id", "member"], "at_us", "event_id", "action", "verdict", 1893456000000000, written)


@query(f"WITH {TAPE_SQL}, {SIGNAL_SQL} SELECT user_id, member, start_ns, end_ns, verdict FROM ti")
def trust_intervals(spark, sf_dir):
    return trust(tape(spark, sf_dir)).select("user_id", "member", "start_ns", "end_ns", "verdict")


MARKET_SQL = """ed AS (SELECT DISTINCT user_id, tt FROM (SELECT user_id, start_ns AS tt FROM ti UNION ALL SELECT user_id, end_ns FROM ti)), se AS (SELECT user_id, tt AS s, lead(tt) OVER (PARTITION BY user_id ORDER BY tt) AS e FROM ed), nm AS (SELECT user_id, count(DISTINCT member) AS members FROM ti GROUP BY user_id),
wv AS (SELECT se.user_id, s, e, count(*) AS held, max(CASE verdict WHEN 'UNTRUSTED' THEN 2 WHEN 'UNKNOWN' THEN 1 ELSE 0 END) AS worst FROM se JOIN ti ON se.user_id = ti.user_id AND ti.start_ns <= s AND s < ti.end_ns WHERE e IS NOT NULL GROUP BY se.user_id, s, e),
vv AS (SELECT wv.user_id, s, e, CASE WHEN worst = 2 THEN 'UNTRUSTED' WHEN worst = 1 OR held < members THEN 'UNKNOWN' ELSE 'TRUSTED' END AS verdict FROM wv JOIN nm ON wv.user_id = nm.user_id),
vi AS (SELECT *, sum(CASE WHEN pe = s AND pv = verdict THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY s) AS i FROM (SELECT *, lag(e) OVER (PARTITION BY user_id ORDER BY s) AS pe, lag(verdict) OVER (PARTITION BY user_id ORDER BY s) AS pv FROM vv)),
mv AS (SELECT user_id, verdict, min(s) AS start_ns, max(e) AS end_ns FROM vi GROUP BY user_id, verdict, i)"""


def verdicts(t, written=False):
    return intervals.combined_verdict(trust(t, written), "user_id", "member", "start_ns", "end_ns", "verdict").select("user_id", "verdict", "start_ns", "end_ns")


@query(f"WITH {TAPE_SQL}, {SIGNAL_SQL}, {MARKET_SQL} SELECT user_id, verdict, start_ns, end_ns FROM mv")
def market_verdict(spark, sf_dir):
    return verdicts(tape(spark, sf_dir))


@query(f"WITH {TAPE_SQL}, {SIGNAL_SQL}, {MARKET_SQL} SELECT t.event_id, coalesce(m.verdict, 'UNKNOWN') AS verdict FROM tape t LEFT JOIN mv m ON t.user_id = m.user_id AND m.start_ns <= t.at_us AND t.at_us < m.end_ns")
def verdict_at(spark, sf_dir):
    points = tape(spark, sf_dir).select("event_id", "user_id", "at_us")
    return bars.verdict_at(points, market_verdict(spark, sf_dir), ["user_id"], "at_us", "start_ns", "end_ns", "verdict").select("event_id", "verdict")


@query(f"""WITH {TAPE_SQL}, {SIGNAL_SQL} SELECT user_id, sum(end_ns - start_ns) AS total_ns, sum(CASE WHEN verdict = 'TRUSTED' THEN end_ns - start_ns ELSE 0 END) AS trusted_ns, round(sum(CASE WHEN verdict = 'TRUSTED' THEN end_ns - start_ns ELSE 0 END) / sum(end_ns - start_ns), 9) AS share, 'PRESENT' AS status FROM ti GROUP BY user_id""")
def trusted_share(spark, sf_dir):
    return intervals.trusted_share(trust(tape(spark, sf_dir)), ["user_id"], "start_ns", "end_ns", "verdict").withColumn("share", F.round("share", 9))


EPISODE_SQL = """ep0 AS (SELECT user_id, at_us, event_id, k // 25 AS fp FROM tape), ep1 AS (SELECT *, sum(CASE WHEN b = fp THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY at_us, event_id) AS i FROM (SELECT *, lag(fp) OVER (PARTITION BY user_id ORDER BY at_us, event_id) AS b FROM ep0)),
ep2 AS (SELECT user_id, i, fp, min(at_us) AS s, (SELECT max(at_us) + 1000000 FROM tape x WHERE x.user_id = ep1.user_id) AS en FROM ep1 GROUP BY user_id, i, fp), ep AS (SELECT user_id, fp, s, coalesce(lead(s) OVER (PARTITION BY user_id ORDER BY i), en) AS e, lead(s) OVER (PARTITION BY user_id ORDER BY i) IS NULL AS censored FROM ep2)"""
EPISODE_SQL = EPISODE_SQL.replace("(SELECT max(at_us) + 1000000 FROM tape x WHERE x.user_id = ep1.user_id) AS en FROM ep1 GROUP BY user_id, i, fp", "max(mx) AS en FROM (SELECT *, max(at_us) OVER (PARTITION BY user_id) + 1000000 AS mx FROM ep1) GROUP BY user_id, i, fp")


def episodes(t, written=False):
    t = t.select("user_id", "at_us", "event_id", F.floor(F.col("k") / 25).cast("int").alias("fp"))
    return intervals.depth_episodes(t, ["user_id"], "at_us", "fp", F.max("at_us") + 1000000, ["event_id"], written)


@query(f'WITH {TAPE_SQL}, {EPISODE_SQL} SELECT user_id, fp, s AS "start", e AS "end", censored FROM ep WHERE s < e')
def depth_episodes(spark, sf_dir):
    return episodes(tape(spark, sf_dir))


@query(f"""WITH {TAPE_SQL}, {SIGNAL_SQL}, {MARKET_SQL}, {EPISODE_SQL}, x AS (SELECT ep.*, mv.verdict, mv.start_ns, mv.end_ns FROM ep LEFT JOIN mv ON ep.user_id = mv.user_id AND mv.start_ns < ep.e AND ep.s < mv.end_ns WHERE ep.s < ep.e)
SELECT user_id, fp, coalesce(greatest(s, start_ns), s) AS "start", coalesce(least(e, end_ns), e) AS "end", censored AND coalesce(least(e, end_ns), e) = e AS censored, verdict FROM x""")
def episode_split(spark, sf_dir):
    t = materialize(tape(spark, sf_dir).select("event_id", "user_id", "lane", "at_us", "k"), "tape")  # parsed once
    return intervals.split_by_intervals(episodes(t, True), verdicts(t, True), "user_id", "verdict", disjoint=True).select("user_id", "fp", "start", "end", "censored", "verdict")


@query(f"""WITH {TAPE_SQL}, {EPISODE_SQL} SELECT fp, count(*) AS episodes, count(*) FILTER (censored) AS censored_n, quantile_disc(e - s, 0.5) FILTER (NOT censored) AS p50, quantile_disc(e - s, 0.9) FILTER (NOT censored) AS p90, quantile_disc(e - s, 0.99) FILTER (NOT censored) AS p99 FROM ep WHERE s < e GROUP BY fp""")
def lifetime_quantiles(spark, sf_dir):
    return intervals.lifetimes(episodes(tape(spark, sf_dir)), ["fp"])


@query(f"""WITH {TAPE_SQL}, {EPISODE_SQL}, c AS (SELECT event_id AS candidate, at_us AS tt, user_id FROM tape WHERE lane = 'purchase'), l AS (SELECT candidate, tt, user_id AS leg FROM c UNION ALL SELECT candidate, tt, user_id % 7 FROM c), u AS (SELECT * FROM ep WHERE s < e AND fp > 0),
h AS (SELECT DISTINCT l.candidate, l.tt, l.leg, u.e FROM l JOIN u ON l.leg = u.user_id AND u.s <= l.tt AND l.tt < u.e), n AS (SELECT candidate, count(DISTINCT leg) AS legs FROM l GROUP BY candidate), g AS (SELECT candidate, count(DISTINCT leg) AS held, min(e - tt) AS remaining FROM h GROUP BY candidate)
SELECT c.candidate, CASE WHEN held = legs THEN remaining END AS remaining, CASE WHEN coalesce(held, 0) <> legs THEN 'NOT_HELD' WHEN remaining > 100000 THEN 'SURVIVED_MINIMUM' ELSE 'TOO_SHORT' END AS status FROM c JOIN n ON c.candidate = n.candidate LEFT JOIN g ON c.candidate = g.candidate""")
def survival(spark, sf_dir):
    c = tape(spark, sf_dir).where("lane = 'purchase'").select(F.col("event_id").alias("candidate"), F.col("at_us").alias("at"), "user_id")
    legs = c.select("candidate", F.explode(F.array("user_id", F.col("user_id") % 7)).alias("leg")).distinct()
    usable = episodes(tape(spark, sf_dir)).where("fp > 0").select(F.col("user_id").alias("leg"), "start", "end")
    return intervals.survival(c.select("candidate", "at"), legs, usable, 100000).select("candidate", "remaining", "status")


@query(f"""WITH RECURSIVE {TAPE_SQL}, d AS (SELECT DISTINCT user_id, at_us FROM tape), f AS (SELECT user_id, min(at_us) AS anchor FROM d GROUP BY user_id), c AS (SELECT user_id, anchor FROM f UNION ALL SELECT c.user_id, (SELECT min(d.at_us) FROM d WHERE d.user_id = c.user_id AND d.at_us > c.anchor + 14400000000) FROM c WHERE c.anchor IS NOT NULL)
SELECT t.event_id, max(c.anchor) AS cluster_start FROM tape t JOIN c ON c.user_id = t.user_id AND c.anchor <= t.at_us GROUP BY t.event_id""")
def time_clusters(spark, sf_dir):
    return intervals.time_clusters(tape(spark, sf_dir).select("event_id", "user_id", "at_us"), ["user_id"], "at_us", 14400000000).select("event_id", "cluster_start")


@query("""WITH w AS (SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'H' ELSE 'A' END AS x FROM conversations) SELECT conv_id, string_agg(x, '') OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS prefix, turn AS "start", lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS "end" FROM w""")
def state_intervals(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.col("role") == "user", "H").otherwise("A").alias("x"))
    return intervals.state_intervals(c.withColumn("number", F.col("turn")), "conv_id", "turn", "number", "x")


@query(f"""WITH {TAPE_SQL}, {SIGNAL_SQL}, n AS (SELECT *, lead(start_ns) OVER (PARTITION BY user_id, member ORDER BY start_ns) AS nx FROM ti) SELECT concat(CAST(user_id AS VARCHAR), ':', CAST(member AS VARCHAR)) AS asset, bool_and(start_ns < end_ns) AS non_empty, bool_and(nx IS NULL OR nx = end_ns) AS contiguous, sum(end_ns - start_ns) = max(end_ns) - min(start_ns) AS complete FROM n GROUP BY user_id, member""")
def interval_partition(spark, sf_dir):
    text = lambda x: F.coalesce(F.col(x).cast("string"), F.lit(""))
    asset = F.concat(text("user_id"), F.lit(":"), text("member"))
    return intervals.partition_check(trust(tape(spark, sf_dir)).withColumn("asset", asset), "asset", "start_ns", "end_ns")


# ---- windows, ledgers


@query(f"""WITH {TAPE_SQL} SELECT (at_us // 1800000000) * 1800000000 AS window_start, lane, count(*) AS n, round(sum(value), 4) AS total FROM tape GROUP BY 1, 2""")
def capture_windows(spark, sf_dir):
    t = tape(spark, sf_dir).withColumn("window_start", windows.capture_window(F.col("at_us")))
    return t.groupBy("window_start", "lane").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query(f"""WITH {TAPE_SQL}, w AS (SELECT (at_us // 1800000000) * 1800000000 AS window_start, count(DISTINCT lane) AS valid_lanes FROM tape GROUP BY 1), m AS (SELECT max(window_start) AS mx FROM w), s AS (SELECT window_start, valid_lanes, CASE WHEN mx < window_start + 1800000000 THEN 'open' WHEN valid_lanes >= 3 THEN 'complete' WHEN mx < window_start + 2100000000 + 86400000000 THEN 'waiting' ELSE 'incomplete' END AS state FROM w, m)
SELECT window_start, valid_lanes, state, bool_and(state IN ('complete', 'incomplete')) OVER (ORDER BY window_start) AS commits FROM s""")
def commit_barrier(spark, sf_dir):
    w = capture_windows(spark, sf_dir).groupBy("window_start").agg(F.count_distinct("lane").alias("valid_lanes"))
    now = w.agg(F.max("window_start")).first()[0] or 0
    return windows.commit_barrier(windows.eligibility(w, 3, 1800000000, now, 300000000 + 86400000000))


@query(f"""WITH {TAPE_SQL}, w AS (SELECT DISTINCT (at_us // 1800000000) * 1800000000 AS window_start FROM tape WHERE k < 30), a AS (SELECT unnest(generate_series((SELECT min(window_start) FROM w), (SELECT max(window_start) FROM w) - 1800000000, 1800000000)) AS window_start) SELECT window_start FROM a WHERE window_start NOT IN (SELECT window_start FROM w)""")
def absent_windows(spark, sf_dir):
    w = tape(spark, sf_dir).where("k < 30").select(windows.capture_window(F.col("at_us")).alias("window_start")).distinct()
    last = w.agg(F.max("window_start")).first()[0] or 0
    return windows.absent_windows(w, "window_start", 1800000000, last)


@query(f"""WITH {TAPE_SQL} SELECT user_id, lane, min(at_us) AS first_seen, min(CASE WHEN k > 50 THEN at_us - 1000 END) AS created_at FROM tape GROUP BY user_id, lane""")
def first_sighting(spark, sf_dir):
    t = tape(spark, sf_dir).withColumn("created", F.when(F.col("k") > 50, F.col("at_us") - 1000))
    halves = [windows.first_sightings(t.where(c), ["user_id", "lane"], "at_us", "created") for c in ("event_id % 2 = 0", "event_id % 2 = 1")]
    return windows.merge_sightings(*halves, ["user_id", "lane"])


@query(f"""WITH {TAPE_SQL}, g AS (SELECT user_id, lane, min(at_us) AS a, max(at_us) AS b FROM tape GROUP BY user_id, lane), s AS (SELECT (b - a) / 60000000.0 % 100 AS gap FROM g), t AS (SELECT CASE WHEN gap < 5 THEN 'lt_5s' WHEN gap < 15 THEN '5_to_15s' WHEN gap <= 60 THEN '15_to_60s' ELSE 'gt_60s' END AS band FROM s), b AS (SELECT * FROM (VALUES (0, 'lt_5s'), (1, '5_to_15s'), (2, '15_to_60s'), (3, 'gt_60s')) v(band_no, band))
SELECT b.band_no, b.band, count(t.band) AS n FROM b LEFT JOIN t ON b.band = t.band GROUP BY b.band_no, b.band""")
def skew_strata(spark, sf_dir):
    from ..functions.columns import SKEW_BANDS
    from .suites import skew_strata as op

    g = tape(spark, sf_dir).groupBy("user_id", "lane").agg(((F.max("at_us") - F.min("at_us")) / 60000000.0 % 100).alias("gap"))
    return op(g, skew_band(F.col("gap")), SKEW_BANDS)
