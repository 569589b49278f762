"""Registered queries over orders, lineitem, part and documents as markets, with oracle SQL."""

from __future__ import annotations

import string

from pyspark.sql import functions as F

from ..functions import text, titles
from ..functions.columns import epoch_micros
from ..operators import bars, baskets, budget, bundles, digests, ladder, matching, omega
from . import suites
from .tape_queries import TAPE_SQL, table, tape

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    """Register a query under its name, with its oracle."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# ---- baskets: an order is a basket, its lines are legs, its day is the bar

LEG_SQL = """sz AS (SELECT unnest([10, 25, 50]) AS size), lg AS (SELECT l_orderkey AS basket, l_linenumber AS leg, CASE WHEN l_discount > 0.085 THEN NULL ELSE l_extendedprice / l_quantity / 2100.0 / 8 END AS px, l_quantity AS depth, CASE WHEN l_tax < 0.005 THEN NULL ELSE 0.02 + l_tax END AS rate, l_partkey, l_suppkey FROM lineitem),
nl AS (SELECT basket, count(*) AS wanted FROM lg GROUP BY basket), ms AS (SELECT lg.basket, size, count(*) AS legs, sum(px) AS gross, sum(rate * px * (1 - px)) AS fee, bool_or(px IS NULL) AS bare, coalesce(bool_or(depth < size), false) AS short, bool_or(rate * px IS NULL) AS free FROM lg CROSS JOIN sz GROUP BY lg.basket, size),
mr AS (SELECT ms.*, o_orderpriority AS priority, o_custkey AS event, epoch_us(o_orderdate) // 86400000000 AS day, CASE WHEN bare OR legs < wanted THEN 'one_sided' WHEN short THEN 'depth_limited' WHEN free THEN 'fee_missing' END AS exclusion FROM ms JOIN nl ON ms.basket = nl.basket JOIN orders ON ms.basket = o_orderkey),
me AS (SELECT basket, size, priority, event, day, legs, gross, CASE WHEN exclusion IS NULL THEN gross + fee END AS net, exclusion FROM mr)"""


def measured(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    px = F.when(F.col("l_discount") > 0.085, None).otherwise(F.col("l_extendedprice") / F.col("l_quantity") / 2100.0 / 8)
    rate = F.when(F.col("l_tax") < 0.005, None).otherwise(0.02 + F.col("l_tax"))
    legs = li.select(F.col("l_orderkey").alias("basket"), px.alias("px"), F.col("l_quantity").alias("depth"), (rate * px * (1 - px)).alias("fee"))
    sizes = F.array(F.lit(10), F.lit(25), F.lit(50))
    wanted = legs.groupBy("basket").agg(F.count(F.lit(1)).alias("wanted"))
    rows = legs.join(wanted, "basket").withColumn("size", F.explode(sizes))
    m = baskets.measure(rows, ["basket", "size"], F.col("wanted"), "px", "fee", "fee", "depth", "size")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("basket"), F.col("o_orderpriority").alias("priority"), F.col("o_custkey").alias("event"), F.floor(epoch_micros("o_orderdate") / 86400000000).alias("day"))
    return m.join(o, "basket")


@query(f"WITH {LEG_SQL} SELECT basket, size, legs, round(gross, 6) AS gross, round(net, 6) AS net, round(1 - net, 6) AS profit, exclusion FROM me")
def partition_measure(spark, sf_dir):
    r = lambda c: F.round(c, 6).alias(c)
    return measured(spark, sf_dir).select("basket", "size", "legs", r("gross"), r("net"), r("profit"), "exclusion")


@query(f"""WITH {LEG_SQL}, r AS (SELECT event, size, priority, CAST(basket AS VARCHAR) AS representation, round(net, 6) AS net, row_number() OVER (PARTITION BY event, size ORDER BY round(net, 6) DESC, length(CAST(basket AS VARCHAR)), CAST(basket AS VARCHAR) DESC) AS n FROM me WHERE exclusion IS NULL) SELECT event, size, representation, net FROM r WHERE n = 1""")
def best_rep(spark, sf_dir):
    m = measured(spark, sf_dir).withColumn("representation", F.col("basket").cast("string")).withColumn("net", F.round("net", 6))
    return baskets.best_representation(m, ["event", "size"], "net", "representation", F.col("valid")).select("event", "size", "representation", "net")


@query(f"""WITH {LEG_SQL}, d AS (SELECT DISTINCT priority, size, day FROM me WHERE exclusion IS NULL AND net < 0.55), i AS (SELECT *, day - row_number() OVER (PARTITION BY priority, size ORDER BY day) AS g FROM d), c AS (SELECT priority, size, g, count(*) AS n FROM i GROUP BY priority, size, g)
SELECT priority, size, count(*) AS runs, median(n) AS median_run, max(n) AS longest_run FROM c GROUP BY priority, size""")
def positive_runs(spark, sf_dir):
    from ..operators.intervals import positive_runs as op

    return op(measured(spark, sf_dir), ["priority", "size"], "day", 1, F.col("valid") & (F.col("net") < 0.55))


@query(f"""WITH {LEG_SQL}, v AS (SELECT priority, size, CASE WHEN exclusion IS NULL THEN round(0.6 - net, 6) END AS v FROM me) SELECT priority, size, count(*) AS n, count(v) AS n_valid, count(*) FILTER (v > 0) AS n_positive, round(count(*) FILTER (v > 0) * 1.0 / count(v), 9) AS positive_rate, min(v) AS least, round(median(v), 6) AS median, max(v) AS greatest FROM v GROUP BY priority, size""")
def basket_summary(spark, sf_dir):
    m = measured(spark, sf_dir).withColumn("v", F.round(0.6 - F.col("net"), 6))
    return baskets.summary(m, ["priority", "size"], "v", F.col("valid")).withColumn("positive_rate", F.round("positive_rate", 9)).withColumn("median", F.round("median", 6))


GATE_SQL = "ga AS (SELECT priority AS class, event, count(*) FILTER (exclusion IS NULL) AS n_valid, count(*) FILTER (exclusion IS NULL AND net < 0.55) AS n_positive FROM me GROUP BY 1, 2), gt AS (SELECT *, CASE WHEN n_valid > 0 THEN n_positive * 1.0 / n_valid END AS rate, n_valid >= 2 AS qualifies FROM ga)"


def gates(spark, sf_dir):
    m = measured(spark, sf_dir).withColumnRenamed("priority", "class")
    return baskets.gate_rows(m, "class", "event", F.col("net") < 0.55, F.col("valid"), 2, 0.5)


@query(f"WITH {LEG_SQL}, {GATE_SQL} SELECT class, event, n_valid, n_positive, round(rate, 9) AS rate, qualifies, qualifies AND rate >= 0.5 AS passes FROM gt")
def gate_rows(spark, sf_dir):
    return gates(spark, sf_dir).withColumn("rate", F.round("rate", 9))


@query(f"""WITH {LEG_SQL}, {GATE_SQL}, f AS (SELECT count(DISTINCT CASE WHEN qualifies AND rate >= 0.5 AND class IN ('1-URGENT', '2-HIGH') THEN event END) AS same_venue_events, count(DISTINCT CASE WHEN qualifies AND rate >= 0.5 AND class IN ('3-MEDIUM') THEN event END) AS cross_venue_events, count(DISTINCT CASE WHEN qualifies THEN event END) AS qualified_events FROM gt)
SELECT *, CASE WHEN (SELECT coalesce(bool_or(n_valid < 0), false) FROM gt) THEN 'DATA_INVALID' WHEN same_venue_events >= 2 THEN 'PASS_SAME_VENUE' WHEN cross_venue_events >= 2 THEN 'CONDITIONAL_CROSS_VENUE' WHEN qualified_events < 2 THEN 'INSUFFICIENT_DATA' ELSE 'NO_SIGNAL' END AS status FROM f""")
def terminal_facts(spark, sf_dir):
    return baskets.terminal_status(gates(spark, sf_dir), "class", "event", F.col("n_valid") < 0, ["1-URGENT", "2-HIGH"], ["3-MEDIUM"], 2)


@query(f"""WITH {TAPE_SQL}, r AS (SELECT event_id, lane, k // 10 AS market, at_us // 60000000 AS tt, k AS v FROM tape), d AS (SELECT lane, tt, market, min(v) AS v FROM r GROUP BY 1, 2, 3),
p AS (SELECT a.lane, a.tt, a.market, b.market AS pm, b.tt AS pa, b.v AS pv, row_number() OVER (PARTITION BY a.lane, a.tt, a.market ORDER BY abs(a.tt - b.tt), b.market, b.tt) AS n FROM d a JOIN d b ON a.lane = b.lane AND a.market <> b.market AND abs(a.tt - b.tt) <= 20000)
SELECT r.event_id, p.pm AS placebo_market, p.pa AS placebo_at, p.pv AS placebo_value FROM r LEFT JOIN p ON r.lane = p.lane AND r.tt = p.tt AND r.market = p.market AND p.n = 1""")
def placebo_null(spark, sf_dir):
    t = tape(spark, sf_dir).select("event_id", "lane", F.floor(F.col("k") / 10).cast("int").alias("market"), F.floor(F.col("at_us") / 60000000).alias("at"), F.col("k").alias("v"))
    return baskets.placebos(t, ["lane"], "market", "at", "v").select("event_id", "placebo_market", "placebo_at", "placebo_value")


@query("""WITH c AS (SELECT o_orderpriority AS priority, l_suppkey % 4 AS outcome, l_orderkey, min(l_extendedprice / l_quantity) AS cost FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3), g AS (SELECT l_orderkey, count(*) AS n, sum(cost) AS s FROM c GROUP BY l_orderkey)
SELECT l_orderkey, n = 4 AS feasible, CASE WHEN n = 4 THEN round(s, 1) END AS cover_cost FROM g""")
def cover_cost(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_suppkey") % 4).alias("outcome"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("cost"))
    return ladder.cover_cost(li, ["l_orderkey"], "outcome", "cost", F.lit(4)).withColumn("cover_cost", F.round("cover_cost", 1)).select("l_orderkey", "feasible", "cover_cost")


ROUTE_SQL = "rc AS (SELECT l_partkey, l_returnflag, date_trunc('quarter', l_shipdate) AS q, round(min(l_extendedprice / l_quantity * (1 - l_discount)) + 1e-7, 3) AS price FROM lineitem GROUP BY 1, 2, 3), rw AS (SELECT l_partkey, q, l_returnflag AS route, price, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS rank FROM rc), ra AS (SELECT *, row_number() OVER (PARTITION BY l_partkey, q ORDER BY price, rank) AS lo, row_number() OVER (PARTITION BY l_partkey, q ORDER BY price DESC, rank) AS hi FROM rw), rr AS (SELECT l_partkey, q, max(CASE WHEN lo = 1 THEN route END) AS cheapest, min(price) AS low, max(CASE WHEN hi = 1 THEN route END) AS dearest, max(price) AS high, round(max(price) - min(price), 6) AS spread, count(*) AS routes FROM ra GROUP BY l_partkey, q)"


def routes(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    q = F.trunc(F.col("l_shipdate").cast("date"), "quarter").cast("string")
    price = F.round(F.min(F.col("l_extendedprice") / F.col("l_quantity") * (1 - F.col("l_discount"))) + 1e-7, 3)
    p = li.groupBy("l_partkey", q.alias("q"), F.col("l_returnflag").alias("route")).agg(price.alias("price"))
    p = p.withColumn("rank", F.when(F.col("route") == "A", 0).when(F.col("route") == "N", 1).otherwise(2))
    return bars.compare_routes(p, ["l_partkey", "q"], "route", "price", "rank").withColumn("spread", F.round("spread", 6))


@query(f"WITH {ROUTE_SQL} SELECT l_partkey, strftime(q, '%Y-%m-%d') AS q, cheapest, low, dearest, high, spread, routes FROM rr")
def route_compare(spark, sf_dir):
    return routes(spark, sf_dir)


@query(f"""WITH {ROUTE_SQL}, o AS (SELECT cheapest, spread, row_number() OVER (PARTITION BY cheapest ORDER BY spread) - 1 AS i, count(*) OVER (PARTITION BY cheapest) AS n FROM rr WHERE routes > 1)
SELECT cheapest, count(*) AS bars, round(median(spread), 6) AS median_spread, round(avg(spread), 4) AS mean_spread, max(CASE WHEN i = least(n - 1, CAST(floor(n * 0.9) AS BIGINT)) THEN spread END) AS p90_spread, max(spread) AS max_spread, count(*) FILTER (spread > 50) AS over_0, count(*) FILTER (spread > 100) AS over_1 FROM o GROUP BY cheapest""")
def spread_summary(spark, sf_dir):
    out = baskets.spread_summary(routes(spark, sf_dir).where("routes > 1"), ["cheapest"], "spread", [50.0, 100.0])
    return out.withColumn("median_spread", F.round("median_spread", 6)).withColumn("mean_spread", F.round("mean_spread", 4))


# ---- outcome spaces: a brand is an event, its parts are markets, p_size is the line

KINDS = tuple(omega.SCORE_TYPES)
GRID_SQL = "mk AS (SELECT p_brand AS event, p_partkey AS market, (p_size % 6) + 0.5 AS line, p_partkey % 11 AS kind FROM part), cp AS (SELECT event, least(20, greatest(8, CAST(floor(max(line)) AS INTEGER) + 5)) AS cap FROM mk GROUP BY event), sp AS (SELECT event, h.home, a.away, concat(h.home, '-', a.away) AS outcome FROM cp, LATERAL (SELECT unnest(generate_series(0, cap)) AS home) h, LATERAL (SELECT unnest(generate_series(0, cap)) AS away) a)"
MASK_SQL = """ms AS (SELECT sp.event, market, outcome FROM mk JOIN sp ON mk.event = sp.event WHERE CASE kind WHEN 0 THEN home > away WHEN 1 THEN home < away WHEN 2 THEN home = away WHEN 3 THEN home + away > line WHEN 4 THEN home + away < line WHEN 5 THEN home >= 1 AND away >= 1 WHEN 6 THEN home > line WHEN 7 THEN away > line WHEN 8 THEN home - away > line WHEN 9 THEN away - home > line ELSE home - away + line > 0 END)"""


def markets(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    kind = F.element_at(F.array(*map(F.lit, KINDS)), (F.col("p_partkey") % 11 + 1).cast("int"))
    return p.select(F.col("p_brand").alias("event"), F.col("p_partkey").alias("market"), (F.col("p_size") % 6 + 0.5).alias("line"), kind.alias("kind"))


def grid(spark, sf_dir):
    return omega.score_grid(markets(spark, sf_dir), "event", "line")


def mask(spark, sf_dir):
    return omega.masks(markets(spark, sf_dir), grid(spark, sf_dir), "event", "market", "kind", omega.SCORE_TYPES)


def shape_masks(spark, sf_dir):
    """Markets with their shapes, and the masks of the shapes."""
    held, shapes = omega.shapes(markets(spark, sf_dir), "event", "market", "kind", "line")
    return held, omega.masks(shapes, grid(spark, sf_dir), "event", "shape", "kind", omega.SCORE_TYPES).distinct()


@query(f"WITH {GRID_SQL} SELECT event, outcome FROM sp")
def score_space(spark, sf_dir):
    return grid(spark, sf_dir).select("event", "outcome")


@query(f"WITH {GRID_SQL}, {MASK_SQL} SELECT event, market, count(*) AS outcomes FROM ms GROUP BY event, market")
def masks(spark, sf_dir):
    return mask(spark, sf_dir).groupBy("event", "market").agg(F.count(F.lit(1)).alias("outcomes"))


CLASS_SQL = "sm AS (SELECT event, market, string_agg(outcome, ',' ORDER BY outcome) AS mask, count(*) AS n FROM ms GROUP BY event, market), kl AS (SELECT *, min(market) OVER (PARTITION BY event, mask) AS rep FROM sm)"


@query(f"WITH {GRID_SQL}, {MASK_SQL}, {CLASS_SQL} SELECT event, market, rep AS class_market FROM kl")
def mask_classes(spark, sf_dir):
    return omega.mask_classes(mask(spark, sf_dir), ["event"], "market").select("event", "market", "class_market")


@query(f"""WITH {GRID_SQL}, {MASK_SQL}, {CLASS_SQL}, n AS (SELECT event, market, n FROM kl WHERE market = rep), mr AS (SELECT ms.* FROM ms JOIN n ON ms.event = n.event AND ms.market = n.market), c AS (SELECT a.event, a.market AS market_a, b.market AS market_b, count(*) AS common FROM mr a JOIN mr b ON a.event = b.event AND a.outcome = b.outcome AND a.market < b.market GROUP BY 1, 2, 3),
p AS (SELECT a.event, a.market AS market_a, b.market AS market_b, a.n AS na, b.n AS nb FROM n a JOIN n b ON a.event = b.event AND a.market < b.market)
SELECT p.event, p.market_a, p.market_b, CASE WHEN common = na THEN 'IMPLICATION' WHEN common = nb THEN 'REVERSE_IMPLICATION' WHEN common IS NULL THEN 'MUTUAL_EXCLUSION' ELSE 'OVERLAP' END AS relation, CAST(coalesce(common, 0) AS INTEGER) AS common FROM p LEFT JOIN c ON p.event = c.event AND p.market_a = c.market_a AND p.market_b = c.market_b
UNION ALL SELECT event, rep, market, 'IDENTITY', CAST(n AS INTEGER) FROM kl WHERE market <> rep""")
def relationships(spark, sf_dir):
    return omega.relationships(mask(spark, sf_dir), ["event"], "market")


@query(f"""WITH {GRID_SQL}, {MASK_SQL}, h AS (SELECT sp.event, sp.outcome, count(DISTINCT ms.market) AS n FROM sp LEFT JOIN ms ON sp.event = ms.event AND sp.outcome = ms.outcome GROUP BY sp.event, sp.outcome) SELECT event, count(*) FILTER (n = 0) AS missing, count(*) FILTER (n > 1) AS overlapping, bool_and(n = 1) AS is_partition FROM h GROUP BY event""")
def is_partition(spark, sf_dir):
    held, mask = shape_masks(spark, sf_dir)
    span = held.groupBy("event", "shape").agg(F.min("market").alias("least"), F.max("market").alias("greatest"))
    return omega.is_partition(mask.join(span, ["event", "shape"]), grid(spark, sf_dir), ["event"], "least", "greatest")


@query(f"""WITH {GRID_SQL}, {MASK_SQL}, s AS (SELECT event, market, string_agg(outcome, ',' ORDER BY outcome) AS mask, count(*) AS n FROM ms GROUP BY event, market), u AS (SELECT event, count(*) AS u FROM sp GROUP BY event), g AS (SELECT s.event, mask, count(*) AS markets, string_agg(CAST(market AS VARCHAR), ',' ORDER BY CAST(market AS VARCHAR)) AS members FROM s JOIN u ON s.event = u.event WHERE n < u GROUP BY s.event, mask)
SELECT event, mask, markets, members FROM g WHERE markets >= 2""")
def equivalence(spark, sf_dir):
    return omega.equivalence_classes(mask(spark, sf_dir), grid(spark, sf_dir), ["event"], "market")


@query(f"""WITH {GRID_SQL}, {MASK_SQL}, m AS (SELECT DISTINCT event, market FROM ms) SELECT m.event, m.market, count(*) AS outcomes FROM m JOIN sp ON m.event = sp.event LEFT JOIN ms ON ms.event = m.event AND ms.market = m.market AND ms.outcome = sp.outcome WHERE ms.outcome IS NULL GROUP BY 1, 2""")
def complement_masks(spark, sf_dir):
    held, mask = shape_masks(spark, sf_dir)
    left = omega.complement_mask(mask, grid(spark, sf_dir), ["event"], "shape").groupBy("event", "shape").agg(F.count(F.lit(1)).alias("outcomes"))
    return held.join(left, ["event", "shape"]).select("event", "market", "outcomes")


@query("""WITH RECURSIVE e AS (SELECT n_nationkey AS event, CASE WHEN n_nationkey % 3 = 0 THEN 1 WHEN n_nationkey % 3 = 1 THEN 3 ELSE 5 END AS best_of FROM nation), s AS (SELECT event, best_of // 2 + 1 AS need, '' AS outcome, 0 AS h, 0 AS a FROM e UNION ALL SELECT event, need, outcome || x, h + CASE WHEN x = 'H' THEN 1 ELSE 0 END, a + CASE WHEN x = 'A' THEN 1 ELSE 0 END FROM s, (VALUES ('H'), ('A')) v(x) WHERE h < need AND a < need)
SELECT event, outcome, CASE WHEN h = need THEN 'H' ELSE 'A' END AS winner, length(outcome) AS maps, abs(h - a) AS margin FROM s WHERE h = need OR a = need""")
def series_space(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("event"), F.when(F.col("n_nationkey") % 3 == 0, 1).when(F.col("n_nationkey") % 3 == 1, 3).otherwise(5).alias("best_of"))
    return omega.series_space(n, "event", "best_of")


# ---- matching, selection

MATCH_SQL = "ev AS (SELECT o_orderkey, o_custkey, o_orderpriority AS venue, epoch_us(o_orderdate) // 1000000 AS tt, o_orderstatus AS fmt FROM orders), dv AS (SELECT DISTINCT o_custkey, tt FROM ev), cl AS (SELECT o_custkey, min(tt) AS anchor FROM dv GROUP BY o_custkey UNION ALL SELECT c.o_custkey, (SELECT min(d.tt) FROM dv d WHERE d.o_custkey = c.o_custkey AND d.tt > c.anchor + 5184000) FROM cl c WHERE c.anchor IS NOT NULL), me AS (SELECT ev.*, (SELECT max(anchor) FROM cl WHERE cl.o_custkey = ev.o_custkey AND anchor <= ev.tt) AS cluster_start FROM ev)"


@query(f"""WITH RECURSIVE {MATCH_SQL}, g AS (SELECT o_custkey, cluster_start, count(*) AS events, count(DISTINCT venue) AS venues, median(tt) AS median_at, count(DISTINCT fmt) AS formats FROM me GROUP BY o_custkey, cluster_start)
SELECT o_custkey, cluster_start, events, venues, median_at, CASE WHEN events > venues THEN 'ambiguous' WHEN formats > 1 THEN 'format_conflict' WHEN venues < 2 THEN 'too_few_venues' END AS reason FROM g""")
def event_match(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderpriority").alias("venue"), F.floor(epoch_micros("o_orderdate") / 1000000).alias("at"), F.col("o_orderstatus").alias("fmt"))
    return matching.match_events(o, ["o_custkey"], "venue", "at", 5184000, topology="fmt")


#: Fixtures of orders: the two sides, aliases, anchors and formats go by keys; evidence is the date, a later one or none.
FIXTURE_SQL = """ev AS (SELECT CAST(o_orderkey AS VARCHAR) AS ref, o_orderpriority AS venue, o_custkey AS k, o_custkey % 3 <> 0 AS game, o_custkey % 40 = 7 AS same, CASE WHEN o_orderkey % 8 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN '3' ELSE '5' END AS fmt, o_orderkey % 4 <> 0 AS anchor, o_orderkey AS n, CAST(epoch(o_orderdate) AS BIGINT) AS tt FROM orders),
ok AS (SELECT * FROM ev WHERE NOT same), pd AS (SELECT DISTINCT k, tt FROM ok WHERE NOT game), pc AS (SELECT k, min(tt) AS c FROM pd GROUP BY k UNION ALL SELECT pc.k, (SELECT min(tt) FROM pd WHERE pd.k = pc.k AND pd.tt > pc.c + 5184000) FROM pc WHERE pc.c IS NOT NULL),
pm AS (SELECT ok.*, (SELECT max(c) FROM pc WHERE pc.k = ok.k AND c <= ok.tt) AS c FROM ok WHERE NOT game), pg AS (SELECT k, c, count(DISTINCT venue) AS v, count(DISTINCT fmt) AS f, string_agg(ref, ',' ORDER BY ref) AS refs, median(tt) AS activation FROM pm GROUP BY k, c),
es AS (SELECT ok.*, tt AS i, 0 AS rank, 'activation_at' AS field FROM ok WHERE game AND (n % 5 <> 0 OR n % 3 <> 0) UNION ALL SELECT ok.*, tt + 3456000, 2, 'title' FROM ok WHERE game AND n % 3 = 0),
pr AS (SELECT a.k, a.i + b.i AS twice FROM es a JOIN es b ON a.k = b.k AND a.venue < b.venue AND abs(a.i - b.i) <= 5184000 WHERE a.anchor AND b.anchor), gd AS (SELECT DISTINCT k, twice FROM pr), gc AS (SELECT k, min(twice) AS c FROM gd GROUP BY k UNION ALL SELECT gc.k, (SELECT min(twice) FROM gd WHERE gd.k = gc.k AND gd.twice > gc.c + 10368000) FROM gc WHERE gc.c IS NOT NULL),
cl AS (SELECT k, c, median(twice) / 2 AS m FROM (SELECT pr.*, (SELECT max(c) FROM gc WHERE gc.k = pr.k AND c <= pr.twice) AS c FROM pr) GROUP BY k, c),
su AS (SELECT es.k, ref, venue, fmt, c, min(struct_pack(r := rank, f := field, i := i)) AS b FROM es JOIN cl ON es.k = cl.k AND abs(i - m) <= 5184000 WHERE anchor GROUP BY ALL), am AS (SELECT ref FROM su GROUP BY ref HAVING count(*) > 1),
c1 AS (SELECT * FROM su WHERE ref NOT IN (SELECT ref FROM am)), sv AS (SELECT k, c, venue, string_agg(ref, ',' ORDER BY ref) AS refs FROM c1 GROUP BY ALL HAVING count(*) > 1), c2 AS (SELECT * FROM c1 WHERE NOT EXISTS (SELECT 1 FROM sv WHERE sv.k = c1.k AND sv.c = c1.c AND sv.venue = c1.venue)),
se AS (SELECT k, c, count(DISTINCT fmt) AS f, min(fmt) AS fmt, string_agg(ref, ',' ORDER BY ref) AS refs, median(b.i) AS activation FROM c2 GROUP BY k, c HAVING count(DISTINCT venue) >= 2), bu AS (SELECT * FROM se WHERE f <= 1),
us AS (SELECT c2.*, activation FROM c2 JOIN bu ON c2.k = bu.k AND c2.c = bu.c), to_ AS (SELECT ref FROM us UNION SELECT ref FROM am UNION SELECT unnest(string_split(refs, ',')) FROM sv UNION SELECT unnest(string_split(refs, ',')) FROM se WHERE f > 1), le AS (SELECT * FROM ok WHERE game AND anchor AND ref NOT IN (SELECT ref FROM to_)),
si AS (SELECT es.k, es.ref, es.venue, bu.c, bu.activation, min(struct_pack(r := rank, f := field, i := i)) AS b FROM es JOIN bu ON es.k = bu.k AND abs(i - activation) <= 5184000 AND (es.fmt IS NULL OR es.fmt = bu.fmt) WHERE NOT anchor GROUP BY ALL), sn AS (SELECT ref, count(*) AS n FROM si GROUP BY ref)"""


def fixtures(spark, sf_dir):
    """Members and rejections of fixtures that are made of all orders."""
    c = F.col
    o = table(spark, sf_dir, "orders").withColumn("at", F.floor(epoch_micros("o_orderdate") / 1000000).cast("long")).withColumn("ref", c("o_orderkey").cast("string"))
    fmt = F.when(c("o_orderkey") % 8 == 0, None).when(c("o_orderstatus") == "F", "3").otherwise("5")
    ev = o.select("ref", c("o_orderpriority").alias("venue"), F.lit("s").alias("sport"), F.when(c("o_custkey") % 3 != 0, "g").alias("game"), F.lit(None).cast("string").alias("topology"), fmt.alias("fmt"), F.concat(F.lit("Alpha "), "o_custkey").alias("one"), F.concat(F.lit("BETA "), c("o_custkey") % 50).alias("two"), "at", (c("o_orderkey") % 4 != 0).alias("anchor"))
    aliases = o.where("o_custkey % 40 = 7").select(F.concat(F.lit("alpha "), "o_custkey").alias("name"), F.concat(F.lit("beta "), c("o_custkey") % 50).alias("stands_for")).distinct()
    stated = o.where("o_orderkey % 5 <> 0").select("ref", c("at").alias("instant"), F.lit(0).alias("rank"), F.lit("activation_at").alias("field"))
    stated = stated.unionByName(o.where("o_orderkey % 3 = 0").select("ref", (c("at") + 3456000).alias("instant"), F.lit(2).alias("rank"), F.lit("title").alias("field")))
    return bundles.match_fixtures(ev, stated, aliases, 5184000)


@query(f"""WITH RECURSIVE {FIXTURE_SQL}
SELECT k AS fixture, refs, reason FROM (SELECT k, ref AS refs, 'participant_alias_collision' AS reason FROM ev WHERE same UNION ALL SELECT k, refs, CASE WHEN v < 2 THEN 'fewer_than_minimum_venues' ELSE 'competition_format_mismatch' END FROM pg WHERE v < 2 OR f > 1
UNION ALL SELECT k, ref, 'activation_time_ambiguous' FROM ok WHERE ref IN (SELECT ref FROM am) UNION ALL SELECT k, refs, 'same_venue_anchor_ambiguous' FROM sv UNION ALL SELECT k, refs, 'competition_format_mismatch' FROM se WHERE f > 1
UNION ALL SELECT k, ref, CASE WHEN k IN (SELECT k FROM bu) THEN 'activation_time_conflict' ELSE 'fewer_than_minimum_venues' END FROM le UNION ALL SELECT k, ok.ref, CASE WHEN sn.n > 1 THEN 'sibling_ambiguous' ELSE 'sibling_no_anchor' END FROM ok LEFT JOIN sn ON ok.ref = sn.ref WHERE game AND NOT anchor AND coalesce(sn.n, 0) <> 1)""")
def match_rejections(spark, sf_dir):
    _, rejected = fixtures(spark, sf_dir)
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("_ref"), F.col("o_custkey").alias("fixture"))
    return rejected.join(o, F.element_at("refs", 1) == F.col("_ref")).select("fixture", F.array_join("refs", ",").alias("refs"), "reason")


@query(f"""WITH RECURSIVE {FIXTURE_SQL}
SELECT ref, venue, 'anchor' AS role, c AS bundle, pg.activation, tt AS instant FROM pm JOIN pg USING (k, c) WHERE pg.v >= 2 AND pg.f <= 1 UNION ALL SELECT ref, venue, 'anchor', c, activation, b.i FROM us
UNION ALL SELECT si.ref, venue, 'sibling', c, activation, b.i FROM si JOIN sn ON si.ref = sn.ref WHERE sn.n = 1""")
def fixture_members(spark, sf_dir):
    members, _ = fixtures(spark, sf_dir)
    return members.select("ref", "venue", "role", "bundle", "activation", "instant")


@query("""WITH k AS (SELECT p_brand, p_size, count(DISTINCT p_partkey) AS n, min(p_partkey) AS v FROM part GROUP BY 1, 2), l AS (SELECT s_suppkey, concat('Brand#', CAST(1 + s_suppkey % 5 AS VARCHAR), CAST(1 + s_suppkey % 4 AS VARCHAR)) AS p_brand FROM supplier), u AS (SELECT p_brand, count(*) AS n, min(p_partkey) AS v FROM part GROUP BY 1)
SELECT s_suppkey, CASE WHEN u.n = 1 THEN v END AS matched, CASE WHEN u.n IS NULL THEN 'no_candidate' WHEN u.n > 1 THEN 'ambiguous' END AS reason FROM l LEFT JOIN u ON l.p_brand = u.p_brand""")
def unique_match(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("Brand#"), (1 + F.col("s_suppkey") % 5).cast("string"), (1 + F.col("s_suppkey") % 4).cast("string")).alias("p_brand"))
    return matching.unique_match(s, table(spark, sf_dir, "part").select("p_brand", "p_partkey"), "p_brand", "p_partkey").select("s_suppkey", "matched", "reason")


@query("""SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderpriority WHEN '1-URGENT' THEN 0 ELSE 1 END, round(2 * ln(1 + o_totalprice) + ln(1 + o_custkey), 6) DESC, o_orderkey) AS rank, round(2 * ln(1 + o_totalprice) + ln(1 + o_custkey), 6) AS activity FROM orders""")
def ranking(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("activity", F.round(matching.activity(F.col("o_totalprice"), F.col("o_custkey").cast("double"), F.lit(None).cast("double")), 6))
    order = [F.when(F.col("o_orderpriority") == "1-URGENT", 0).otherwise(1), F.desc("activity"), F.col("o_orderkey")]
    return matching.ranked(o, ["o_custkey"], order).select("o_orderkey", "o_custkey", "rank", "activity")


@query("""WITH RECURSIVE r AS (SELECT c_nationkey AS run, c_custkey, c_custkey % 13 + 1 AS cost, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey % 13 + 1 DESC, c_custkey) AS rank FROM customer),
g AS (SELECT run, c_custkey, cost, rank, cost <= 100 AS selected, CASE WHEN cost > 100 THEN 'over_budget' END AS allocation, CASE WHEN cost <= 100 THEN 100 - cost ELSE 100 END AS money, CASE WHEN cost <= 100 THEN 1 ELSE 0 END AS taken FROM r WHERE rank = 1
UNION ALL SELECT r.run, r.c_custkey, r.cost, r.rank, taken < 25 AND r.cost <= money, CASE WHEN taken >= 25 THEN 'over_count' WHEN r.cost > money THEN 'over_budget' END, CASE WHEN taken < 25 AND r.cost <= money THEN money - r.cost ELSE money END, CASE WHEN taken < 25 AND r.cost <= money THEN taken + 1 ELSE taken END FROM g JOIN r ON r.run = g.run AND r.rank = g.rank + 1)
SELECT run, c_custkey, CAST(cost AS INTEGER) AS cost, CAST(rank AS INTEGER) AS rank, selected, allocation FROM g""")
def selection_greedy(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("run"), "c_custkey", (F.col("c_custkey") % 13 + 1).cast("int").alias("cost"))
    c = matching.ranked(c, ["run"], [F.col("cost").desc(), F.col("c_custkey")])
    return matching.greedy_budget(c, "run", "rank", "cost", 100, 25)


@query("""WITH e AS (SELECT DISTINCT event_type AS lane, CAST(event_id AS VARCHAR) AS v FROM events), n AS (SELECT lane, count(*) AS members, CASE WHEN count(*) > 64 THEN length(bin((count(*) - 1) // 64)) ELSE 0 END AS bits FROM e GROUP BY lane),
h AS (SELECT e.lane, v, members, bits, CASE WHEN bits > 0 THEN CAST('0x' || substr(sha256(v), 1, 15) AS BIGINT) >> (60 - bits) ELSE 0 END AS leaf FROM e JOIN n ON e.lane = n.lane), l AS (SELECT lane, members, bits, leaf, sha256(string_agg(v, chr(10) ORDER BY v)) AS h FROM h GROUP BY ALL),
i AS (SELECT lane, members, bits, leaf >> 3 AS node, CASE WHEN bits > 0 THEN sha256(string_agg(h, chr(10) ORDER BY leaf)) ELSE min(h) END AS h FROM l GROUP BY lane, members, bits, leaf >> 3) SELECT lane, members, CASE WHEN bits > 3 THEN sha256(string_agg(h, chr(10) ORDER BY node)) ELSE min(h) END AS digest FROM i GROUP BY lane, members, bits""")
def digest_tiers(spark, sf_dir):
    return digests.tiered_digest(table(spark, sf_dir, "events").withColumnRenamed("event_type", "lane"), ["lane"], "event_id", leaf=64, fan=3)


@query("""WITH RECURSIVE r AS (SELECT c_nationkey AS run, c_custkey, c_custkey % 2 AS venue, c_custkey % 13 + 1 AS cost, row_number() OVER (PARTITION BY c_nationkey ORDER BY (c_custkey * 7919) % 1009, c_custkey) AS rank FROM customer),
g AS (SELECT run, CAST(0 AS BIGINT) AS rank, CAST(NULL AS BIGINT) AS c_custkey, false AS selected, CAST(NULL AS VARCHAR) AS allocation, CAST(150 AS BIGINT) AS money, CAST(90 AS BIGINT) AS m0, CAST(80 AS BIGINT) AS m1, 25 AS items FROM (SELECT DISTINCT run FROM r)
UNION ALL SELECT r.run, r.rank, r.c_custkey, items > 0 AND cost <= money AND cost <= CASE WHEN venue = 0 THEN m0 ELSE m1 END, CASE WHEN items <= 0 THEN 'over_count' WHEN cost > money THEN 'over_budget' WHEN cost > CASE WHEN venue = 0 THEN m0 ELSE m1 END THEN 'over_venue_budget' END,
money - CASE WHEN items > 0 AND cost <= money AND cost <= CASE WHEN venue = 0 THEN m0 ELSE m1 END THEN cost ELSE 0 END, m0 - CASE WHEN venue = 0 AND items > 0 AND cost <= money AND cost <= m0 THEN cost ELSE 0 END, m1 - CASE WHEN venue = 1 AND items > 0 AND cost <= money AND cost <= m1 THEN cost ELSE 0 END, items - CASE WHEN items > 0 AND cost <= money AND cost <= CASE WHEN venue = 0 THEN m0 ELSE m1 END THEN 1 ELSE 0 END FROM g JOIN r ON r.run = g.run AND r.rank = g.rank + 1)
SELECT run, c_custkey, selected, allocation FROM g WHERE rank > 0""")
def selection_budgets(spark, sf_dir):
    c = F.col
    people = table(spark, sf_dir, "customer").select(c("c_nationkey").alias("run"), "c_custkey", (c("c_custkey") % 2).alias("venue"), (c("c_custkey") % 13 + 1).alias("cost"), (c("c_custkey") * 7919 % 1009).alias("place"))
    runs = people.select("run").distinct().select("run", F.lit(150).alias("budget"), F.lit(25).alias("items"))
    purses = people.select("run", "venue").distinct().withColumn("budget", F.when(c("venue") == 0, 90).otherwise(80))
    return budget.greedy(people, "run", ["place", "c_custkey"], "cost", runs, "venue", purses).select("run", "c_custkey", "selected", "allocation")


#: Titles of orders: which form goes by key; SQL knows the parts that a title is made of.
TITLE_SQL = """tt AS (SELECT o_orderkey AS n, o_orderkey % 9 AS form, 'Alpha ' || o_custkey AS a, 'Be-ta ' || (o_custkey % 77) AS b, o_custkey % 5 + 1 AS m FROM orders)"""


def titles_of(spark, sf_dir):
    c, lit = F.col, F.lit
    o = table(spark, sf_dir, "orders").select(c("o_orderkey").alias("n"), (c("o_orderkey") % 9).alias("form"), F.concat(lit("Alpha "), "o_custkey").alias("a"), F.concat(lit("Be-ta "), c("o_custkey") % 77).alias("b"), (c("o_custkey") % 5 + 1).alias("m"))
    forms = [
        F.concat(lit("Dota 2: "), "a", lit(" vs. "), "b", lit(" (BO3) - Group D: Map "), "m"), F.concat("a", lit("  VERSUS "), "b", lit(": Match Winner - More Markets")), F.concat(lit("Other: "), "a", lit(" vs "), "b"),
        F.concat("a", lit(" v "), "b", lit(" - Exact Score")), F.concat(lit("UEL, "), "a", lit(" @ "), "b", lit(" - Final: Total Goals")), F.concat("a", lit(" vs "), "b", lit(" vs "), "m"),
        F.concat("a", lit(" and "), "b", lit(" both to score")), F.concat("a", lit(" and "), "b", lit(" have "), "m", lit(" or more total goals")), F.concat("a", lit(" &amp; Sons vs "), "b"),
    ]
    title = forms[8]
    for i, f in enumerate(forms[:8]):
        title = F.when(c("form") == i, f).otherwise(title)
    return o.withColumn("title", title)


@query(f"""WITH {TITLE_SQL} SELECT n, CASE WHEN form IN (0, 1) THEN a || '|' || b WHEN form = 8 THEN a || ' & Sons|' || b WHEN form = 3 THEN NULL WHEN form = 4 THEN 'UEL, ' || a || '|' || b || ' - Final: Total Goals' END AS series,
CASE form WHEN 0 THEN 'Dota 2: ' || a || '|' || b || ' (BO3)' WHEN 1 THEN a || '|' || b WHEN 2 THEN 'Other: ' || a || '|' || b WHEN 3 THEN a || '|' || b WHEN 4 THEN a || '|' || b WHEN 8 THEN a || ' & Sons|' || b END AS fixture,
CASE WHEN form IN (6, 7) THEN a || '|' || b END AS prop, CASE WHEN form = 7 THEN m - 0.5 END AS line, CASE WHEN form = 7 THEN 'over' END AS direction, CASE WHEN form = 7 THEN CAST(m AS INTEGER) END AS published_line, CASE WHEN form = 0 THEN CAST(m AS INTEGER) END AS map_index FROM tt""")
def title_parts(spark, sf_dir):
    t, c = titles_of(spark, sf_dir), F.col
    kind = F.when(c("form") == 7, "total_goals").when(c("form") == 0, "map_winner").otherwise("moneyline_3way")
    tail = F.when(c("form") == 7, F.concat("m", F.lit(" or more"))).otherwise(c("title"))
    p = titles.parameters(kind, tail, c("a"), c("b"), F.lit(""))
    joined = lambda x: F.array_join(x, "|")
    out = t.select("n", joined(titles.series_sides(c("title"), ("dota 2", "dota2"))).alias("series"), joined(titles.fixture_sides(c("title"))).alias("fixture"), joined(titles.prop_sides(c("title"))).alias("prop"), p.alias("p"))
    return out.select("n", "series", "fixture", "prop", "p.line", "p.direction", "p.published_line", "p.map_index")


@query("""SELECT o_custkey, relation_score FROM (SELECT o_custkey, sum(CASE o_orderpriority WHEN '1-URGENT' THEN 40 WHEN '2-HIGH' THEN 20 WHEN '3-MEDIUM' THEN 10 ELSE 0 END) AS relation_score FROM orders GROUP BY o_custkey)""")
def relation_score(spark, sf_dir):
    names = F.when(F.col("o_orderpriority") == "1-URGENT", "IDENTITY").when(F.col("o_orderpriority") == "2-HIGH", "IMPLICATION").when(F.col("o_orderpriority") == "3-MEDIUM", "MUTUAL_EXCLUSION").otherwise("OVERLAP")
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(matching.relation_score(names).cast("long").alias("relation_score"))


@query("""WITH a AS (SELECT o_custkey AS k, max(o_totalprice) AS v FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1), b AS (SELECT o_custkey AS k, max(o_totalprice) AS v FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1) SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'missing_left' WHEN b.k IS NULL THEN 'missing_right' WHEN a.v = b.v THEN 'equal' ELSE 'differs' END AS status FROM a FULL JOIN b ON a.k = b.k""")
def continuity_match(spark, sf_dir):
    side = lambda m: table(spark, sf_dir, "orders").where(F.col("o_orderkey") % m == 0).groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_totalprice").alias("v"))
    return matching.compare_sets(side(2), side(3), ["k"], ["v"])


@query("""WITH k AS (SELECT l_suppkey % 20 AS s, l_orderkey AS g, count(*) AS n, min(epoch_us(l_shipdate)) AS tt FROM lineitem GROUP BY 1, 2 HAVING count(*) >= 2), t AS (SELECT *, sum(n) OVER (PARTITION BY s ORDER BY tt, g) AS total FROM k)
SELECT s, g, n FROM t WHERE total <= 40""")
def whole_ladders(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 20).alias("s"), F.col("l_orderkey").alias("g"), epoch_micros("l_shipdate").alias("at"))
    return matching.whole_groups(li, "s", "g", "at", 2, 40).groupBy("s", "g").agg(F.count(F.lit(1)).alias("n"))


# ---- rules, reports


@query("""WITH t AS (SELECT doc_id, lang, trim(regexp_replace(regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]+(\\.[0-9]+)?', '<n>', 'g'), '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g')) AS template FROM documents) SELECT lang, count(DISTINCT sha256(template)) AS templates FROM t GROUP BY lang HAVING count(DISTINCT sha256(template)) > 1""")
def template_drift(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)  # A-Z only: engines lower other letters differently
    t = F.trim(F.regexp_replace(F.regexp_replace(lowered, r"[0-9]+(\.[0-9]+)?", "<n>"), r"[ \t\n\x0B\f\r]+", " "))
    return text.template_drift(d.select("lang", F.sha2(t.cast("binary"), 256).alias("template")), "lang", "template")


@query("""SELECT o_orderpriority, count(*) AS n_rows, count(*) - count(DISTINCT concat(CAST(epoch_us(o_orderdate) AS VARCHAR), '|', o_orderstatus)) AS repeats, min(epoch_us(o_orderdate)) AS first_at, max(epoch_us(o_orderdate)) AS last_at, 0 AS without_time FROM orders GROUP BY 1""")
def history_report(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderpriority", epoch_micros("o_orderdate").alias("at"), "o_orderstatus")
    return suites.history_report(o, "o_orderpriority", "at", "o_orderstatus")


@query("""WITH c AS (SELECT c_nationkey AS event, sum(ceil(greatest(c_acctbal, 0) * 0.7 / 100)) AS calls, count(*) AS targets FROM customer GROUP BY 1) SELECT event, CAST(calls AS BIGINT) AS calls, targets, CAST(sum(calls) OVER (ORDER BY calls, event) AS BIGINT) AS cumulative FROM c""")
def pull_plan(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("event"), F.greatest("c_acctbal", F.lit(0.0)).alias("minutes"))
    return suites.pull_plan(c, "event", "minutes", 0.7, 100).select("event", F.col("calls").cast("long").alias("calls"), "targets", F.col("cumulative").cast("long").alias("cumulative"))


@query("""WITH l AS (SELECT (epoch_us(l_shipdate) - epoch_us(o_orderdate)) // 86400000000 AS lag FROM lineitem JOIN orders ON l_orderkey = o_orderkey), k AS (SELECT CASE WHEN lag >= 0 THEN lag END AS lag FROM l), o AS (SELECT lag, row_number() OVER (ORDER BY lag) - 1 AS i, count(*) OVER () AS n FROM k WHERE lag IS NOT NULL)
SELECT (SELECT count(*) FROM k) AS n, max(n) AS n_known, max(CASE WHEN i = n // 2 THEN lag END) AS median, max(CASE WHEN i = CAST(floor(n * 0.9) AS BIGINT) THEN lag END) AS p90, max(lag) AS greatest FROM o""")
def coverage_lag(spark, sf_dir):
    days = F.floor((epoch_micros("l_shipdate") - epoch_micros("o_orderdate")) / 86400000000)
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(F.when(days >= 0, days).alias("lag"))
    return suites.coverage_lag(rows, "lag")


@query("""SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) FILTER (event_id % 500 <> 3) AS receipts, sha256(coalesce(string_agg(CASE WHEN event_id % 500 <> 3 THEN CAST(event_id AS VARCHAR) END, chr(10) ORDER BY CAST(event_id AS VARCHAR)), '')) AS digest, bool_and(event_id % 500 <> 3) AS closed FROM events GROUP BY 1""")
def daily_manifest(spark, sf_dir):
    return suites.daily_manifest(table(spark, sf_dir, "events"), "ts", "event_id", F.col("event_id") % 500 != 3)


@query("""SELECT * FROM (VALUES ('customers_have_nations', (SELECT CASE WHEN count(*) FILTER (n_nationkey IS NULL) = 0 THEN 'PASS' ELSE 'FAIL' END FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)), ('discounts_in_bounds', (SELECT CASE WHEN bool_and(l_discount BETWEEN 0 AND 0.05) THEN 'PASS' ELSE 'FAIL' END FROM lineitem)), ('toxic_present', (SELECT CASE WHEN count(*) = 0 THEN 'NOT_PRESENT' WHEN bool_and(toxic = 7) THEN 'PASS' ELSE 'FAIL' END FROM labels WHERE toxic = 7)), ('orders_dense', (SELECT CASE WHEN max(o_orderkey) - min(o_orderkey) + 1 = count(*) THEN 'PASS' ELSE 'FAIL' END FROM orders))) v(name, status)""")
def check_suite(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    customers = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return suites.suite([
        suites.check(customers, "customers_have_nations", F.count_if(F.col("n_nationkey").isNull()) == 0, rows=F.count(F.lit(1))),
        suites.check(t("lineitem"), "discounts_in_bounds", F.bool_and(F.col("l_discount").between(0, 0.05)), most=F.max("l_discount")),
        suites.check(t("labels").where("toxic = 7"), "toxic_present", F.bool_and(F.col("toxic") == 7)),
        suites.check(t("orders"), "orders_dense", F.max("o_orderkey") - F.min("o_orderkey") + 1 == F.count(F.lit(1))),
    ]).select("name", "status")


@query("""WITH t AS (SELECT c_custkey, c_custkey * 10 AS a, c_custkey * 10 + 1 + c_custkey % 70 AS b FROM customer), s AS (SELECT c_custkey, unnest(generate_series(a, b - 1, 20)) AS tile_start, b FROM t) SELECT c_custkey, tile_start, least(b, tile_start + 20) AS tile_end FROM s""")
def candle_tiles(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") * 10).alias("a"), (F.col("c_custkey") * 10 + 1 + F.col("c_custkey") % 70).alias("b"))
    return text.tiles(c, "a", "b", 2, 10).select("c_custkey", "tile_start", "tile_end")


@query("""SELECT c_custkey, trim(regexp_replace(lower(c_name), '[^a-z0-9]+', ' ', 'g')) AS canonical FROM customer""")
def canonical_names(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", text.canonical_text(F.col("c_name")).alias("canonical"))


@query("""WITH r AS (SELECT o_custkey, o_orderpriority AS reason FROM orders WHERE o_orderstatus <> 'O') SELECT reason, count(*) AS n FROM r GROUP BY reason""")
def reason_histogram(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return suites.reason_histogram(o, F.array(F.col("o_orderpriority")), F.col("o_orderstatus") == "O", F.lit(None).cast("string"))


# ---- crossed quotes: a part is a class, its quarter a bar, its suppliers are instruments of three venues

QUOTE_SQL = """qa AS (SELECT l_partkey AS class, date_trunc('year', l_shipdate) AS bar, l_suppkey AS instrument, round(min(l_extendedprice / l_quantity * (1 - l_discount)) / 2100.0, 6) AS bid, max(l_tax) AS t, max(l_linenumber) AS age FROM lineitem GROUP BY 1, 2, 3),
qu AS (SELECT class, epoch_us(bar) // 86400000000 AS bar, instrument, CASE instrument % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS venue, bid, round(bid + 0.004 + t / 4, 6) AS ask, age FROM qa),
qb AS (SELECT *, row_number() OVER (PARTITION BY class, bar ORDER BY bid DESC, instrument) AS rb, row_number() OVER (PARTITION BY class, bar ORDER BY ask, instrument) AS ra FROM qu),
cb AS (SELECT class, bar, max(CASE WHEN ra = 1 THEN instrument END) AS buy, max(CASE WHEN rb = 1 THEN instrument END) AS sell, max(CASE WHEN ra = 1 THEN venue END) AS bv, max(CASE WHEN rb = 1 THEN venue END) AS sv, max(CASE WHEN ra = 1 THEN ask END) AS ap, max(CASE WHEN rb = 1 THEN bid END) AS bp, max(CASE WHEN ra = 1 THEN ask - bid END) AS width, max(age) AS skew, max((bid + ask) / 2) - min((bid + ask) / 2) AS mid_spread, max(ask - bid) AS widest_book, count(*) AS routes FROM qb GROUP BY class, bar),
cx AS (SELECT class, bar, buy, sell, bp - ap AS crossing, bp - ap - CASE WHEN bv = 'a' THEN 0.07 * ap * (1 - ap) ELSE 0 END - CASE WHEN sv = 'a' THEN 0.07 * bp * (1 - bp) ELSE 0 END AS net_crossing, bv = sv AS same_venue, width, skew, mid_spread, widest_book, routes FROM cb WHERE routes > 1)"""


def crossed(spark, sf_dir):
    from ..operators import crossing

    li = table(spark, sf_dir, "lineitem")
    bar = F.floor(F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(date_trunc('YEAR', CAST(l_shipdate AS DATE)) AS TIMESTAMP_NTZ))") / 86400000000)
    q = li.groupBy(F.col("l_partkey").alias("class"), bar.alias("bar"), F.col("l_suppkey").alias("instrument")).agg(F.round(F.min(F.col("l_extendedprice") / F.col("l_quantity") * (1 - F.col("l_discount"))) / 2100.0, 6).alias("bid"), F.max("l_tax").alias("t"), F.max("l_linenumber").alias("age"))
    q = q.withColumn("venue", F.when(F.col("instrument") % 3 == 0, "a").when(F.col("instrument") % 3 == 1, "b").otherwise("c")).withColumn("ask", F.round(F.col("bid") + 0.004 + F.col("t") / 4, 6))
    return crossing.crossing_bars(q, ["class"], "bar", ladder.flat_leg_fee(F.col("venue"), F.col("price"), "a")).where("routes > 1")


@query(f"WITH {QUOTE_SQL} SELECT class, bar, buy, sell, round(crossing + 1e-9, 5) AS crossing, round(net_crossing + 1e-9, 5) AS net_crossing, same_venue, round(width + 1e-9, 5) AS buy_leg_width, skew, round(mid_spread + 1e-9, 5) AS mid_spread, round(widest_book + 1e-9, 5) AS widest_book, routes FROM cx")
def crossing_bars(spark, sf_dir):
    r = lambda c: F.round(F.col(c) + 1e-9, 5).alias(c)
    return crossed(spark, sf_dir).select("class", "bar", "buy", "sell", r("crossing"), r("net_crossing"), "same_venue", r("buy_leg_width"), "skew", r("mid_spread"), r("widest_book"), "routes")


@query(f"""WITH {QUOTE_SQL}, r AS (SELECT class, round(median(crossing), 5) AS crossing_median, count(*) AS bars, count(*) FILTER (crossing > 0) AS bars_crossed, count(*) FILTER (net_crossing > 0) AS bars_net_crossed, count(*) FILTER (skew <= 5) AS bars_fresh, count(*) FILTER (net_crossing > 0 AND NOT same_venue AND skew <= 5) AS xv_net_fresh FROM cx GROUP BY class)
SELECT count(*) AS classes, CAST(sum(bars) AS BIGINT) AS bars, CAST(sum(bars_crossed) AS BIGINT) AS bars_crossed, CAST(sum(bars_net_crossed) AS BIGINT) AS bars_net_crossed, CAST(sum(bars_fresh) AS BIGINT) AS bars_fresh, CAST(sum(xv_net_fresh) AS BIGINT) AS xv_net_fresh, round(sum(bars_crossed) * 1.0 / sum(bars), 6) AS crossing_rate FROM r""")
def crossing_totals(spark, sf_dir):
    from ..operators import crossing

    out = crossing.crossing_totals(crossing.crossing_records(crossed(spark, sf_dir), ["class"]))
    return out.select("classes", "bars", "bars_crossed", "bars_net_crossed", "bars_fresh", "xv_net_fresh", F.round("crossing_rate", 6).alias("crossing_rate"))
