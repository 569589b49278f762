"""Outcome spaces and masks as exploded tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize


def score_grid(markets: DataFrame, event: str, line: str) -> DataFrame:
    """(event, home, away, outcome): scores from 0 to a cap that the event's greatest line sets."""
    cap = F.least(F.lit(20), F.greatest(F.lit(8), F.floor(F.max(line)).cast("int") + 5))
    grid = markets.groupBy(event).agg(cap.alias("cap"))
    grid = grid.withColumn("home", F.explode(F.sequence(F.lit(0), F.col("cap")))).withColumn("away", F.explode(F.sequence(F.lit(0), F.col("cap"))))
    return grid.select(event, "home", "away", F.concat_ws("-", "home", "away").alias("outcome"))


def listed_scores(tickers: DataFrame, event: str, ticker: str, pattern: str) -> DataFrame:
    """The outcome space that listed score tickers span; never known to be complete."""
    home, away = F.regexp_extract(ticker, pattern, 1), F.regexp_extract(ticker, pattern, 2)
    hit = tickers.where(home != "").select(event, home.cast("int").alias("home"), away.cast("int").alias("away")).dropDuplicates()
    return hit.withColumn("outcome", F.concat_ws("-", "home", "away")).withColumn("coverage", F.lit("INCOMPLETE_COVERAGE"))


def series_space(events: DataFrame, event: str, best_of: str) -> DataFrame:
    """All sequences of map winners (H, A) of a series that ends when it is clinched: exhaustive."""
    need = F.floor(F.col(best_of) / 2) + 1
    codes = events.select(event, best_of, F.explode(F.sequence(need, F.col(best_of))).alias("n")).withColumn("code", F.explode(F.sequence(F.lit(0), F.pow(F.lit(2), F.col("n")).cast("int") - 1)))
    seq = F.translate(F.lpad(F.bin("code"), F.col("n").cast("int"), F.lit("0")), "01", "HA")
    made = codes.withColumn("outcome", seq)
    count = lambda c: F.length("outcome") - F.length(F.replace(F.col("outcome"), F.lit(c), F.lit("")))
    last = F.substr(F.col("outcome"), F.length("outcome"), F.lit(1))
    wins = F.when(last == "H", count("H")).otherwise(count("A"))
    lost = F.length("outcome") - wins
    return made.where((wins == need) & (lost < need)).select(event, "outcome", last.alias("winner"), F.col("n").cast("int").alias("maps"), (wins - lost).alias("margin"))


def reachable(space: DataFrame, prefix: Column) -> DataFrame:
    return space.where(F.startswith(F.col("outcome"), prefix))


#: Predicates of market types over a score row (home, away) with a line; all lines strict.
SCORE_TYPES = {
    "home_wins": lambda: F.col("home") > F.col("away"),
    "away_wins": lambda: F.col("home") < F.col("away"),
    "draw": lambda: F.col("home") == F.col("away"),
    "total_over": lambda: F.col("home") + F.col("away") > F.col("line"),
    "total_under": lambda: F.col("home") + F.col("away") < F.col("line"),
    "both_score": lambda: (F.col("home") >= 1) & (F.col("away") >= 1),
    "home_total_over": lambda: F.col("home") > F.col("line"),
    "away_total_over": lambda: F.col("away") > F.col("line"),
    "home_spread": lambda: F.col("home") - F.col("away") > F.col("line"),
    "away_spread": lambda: F.col("away") - F.col("home") > F.col("line"),
    "home_handicap": lambda: F.col("home") - F.col("away") + F.col("line") > 0,
}
#: The same over a series row (outcome, winner, maps, margin).
SERIES_TYPES = {
    "series_home": lambda: F.col("winner") == "H",
    "series_away": lambda: F.col("winner") == "A",
    "map_home": lambda: F.substr(F.col("outcome"), F.col("line").cast("int"), F.lit(1)) == "H",
    "maps_over": lambda: F.col("maps") > F.col("line"),
    "maps_under": lambda: F.col("maps") < F.col("line"),
    "map_handicap": lambda: (F.col("winner") == "H") & (F.col("margin") > F.col("line")),
}


def masks(markets: DataFrame, space: DataFrame, event: str, market: str, kind: str, types: dict) -> DataFrame:
    """(event, market, outcome): the outcomes in which a market pays. Unknown kinds give no rows."""
    test = F.lit(False)
    for name, predicate in types.items():
        test = F.when(F.col(kind) == name, predicate()).otherwise(test)
    return markets.join(space, event).where(test).select(event, market, "outcome")


def shapes(markets: DataFrame, event: str, market: str, *terms: str) -> tuple[DataFrame, DataFrame]:
    """(event, market, shape) and (event, shape, terms): markets of equal terms have equal masks.

    A shape is the set of all terms under which an event lists a market, so masks of shapes
    are as many as terms differ, whatever the number of markets. ``masks`` takes shapes as markets.
    """
    shape = F.array_sort(F.collect_set(F.struct(*terms))).alias("shape")
    held = markets.groupBy(event, market).agg(shape)
    return held, held.select(event, "shape").distinct().select(event, "shape", F.inline("shape"))


def mask_status(markets: DataFrame, kind: str, scope: str, space_scope: str, types: dict, never: list[str]) -> DataFrame:
    status = F.when(F.col(kind).isin(never), "NOT_A_FUNCTION").when(~F.col(kind).isin(list(types)), "UNSUPPORTED").when(F.col(scope) != space_scope, "DIFFERENT_SCOPE").otherwise("DERIVABLE")
    return markets.withColumn("status", status)


def mask_classes(mask: DataFrame, keys: list[str], market: str) -> DataFrame:
    """(keys, market, class_market, mask): markets of equal masks are one class, named by its least market.

    A mask is bounded by the universe, a class may have any number of members.
    """
    sets = mask.groupBy(*keys, market).agg(F.array_sort(F.collect_set("outcome")).alias("mask"))
    named = sets.groupBy(*keys, "mask").agg(F.min(market).alias("class_market"))
    return sets.join(named, [*keys, "mask"])


def relationships(mask: DataFrame, keys: list[str], market: str) -> DataFrame:
    """How the masks of one key's markets relate: (keys, market_a, market_b, relation, common).

    Markets of equal masks are a class, so copies don't multiply: pairs are formed between
    the classes' least markets only, and each other member gives one IDENTITY row with its class's
    least market. Empty masks relate to nothing. Keys may hold the state that
    a space is conditioned on.
    """
    classes = materialize(mask_classes(mask, keys, market), "classes")
    heads = classes.where(F.col(market) == F.col("class_market"))
    a = heads.select(*keys, F.col(market).alias("market_a"), F.col("mask").alias("_a"))
    b = heads.select(*keys, F.col(market).alias("market_b"), F.col("mask").alias("_b"))
    both = F.size(F.array_intersect("_a", "_b"))
    relation = F.when(both == F.size("_a"), "IMPLICATION").when(both == F.size("_b"), "REVERSE_IMPLICATION").when(both == 0, "MUTUAL_EXCLUSION").otherwise("OVERLAP")
    pairs = a.join(b, keys).where(F.col("market_a") < F.col("market_b")).select(*keys, "market_a", "market_b", relation.alias("relation"), both.alias("common"))
    same = classes.where(F.col(market) != F.col("class_market")).select(*keys, F.col("class_market").alias("market_a"), F.col(market).alias("market_b"), F.lit("IDENTITY").alias("relation"), F.size("mask").alias("common"))
    return pairs.unionByName(same)


def is_partition(mask: DataFrame, universe: DataFrame, keys: list[str], market: str, upto: str | None = None) -> DataFrame:
    """Per key: outcomes in no mask, outcomes in several, and whether there are neither.

    Two markets differ if the least and the greatest do, so none are counted. A row may stand for
    several markets: ``market`` is the least of them, ``upto`` the greatest.
    """
    held = mask.groupBy(*keys, "outcome").agg(F.min(market).alias("_lo"), F.max(upto or market).alias("_hi"))
    joined = universe.select(*keys, "outcome").distinct().join(held, [*keys, "outcome"], "left")
    none, several = F.col("_lo").isNull(), F.coalesce(F.col("_lo") < F.col("_hi"), F.lit(False))
    return joined.groupBy(*keys).agg(F.count_if(none).alias("missing"), F.count_if(several).alias("overlapping"), F.bool_and(~none & ~several).alias("is_partition"))


def equivalence_classes(mask: DataFrame, universe: DataFrame, keys: list[str], market: str) -> DataFrame:
    """Groups of two or more markets whose masks are equal; empty and full masks are left out."""
    sets = mask.groupBy(*keys, market).agg(F.array_sort(F.collect_set("outcome")).alias("_s"))
    total = universe.groupBy(*keys).agg(F.count_distinct("outcome").alias("_u"))
    proper = sets.join(total, keys).where(F.size("_s") < F.col("_u"))
    return proper.groupBy(*keys, F.array_join("_s", ",").alias("mask")).agg(F.count_distinct(market).alias("markets"), F.array_join(F.array_sort(F.collect_set(F.col(market).cast("string"))), ",").alias("members")).where("markets >= 2")


def complement_mask(mask: DataFrame, universe: DataFrame, keys: list[str], market: str) -> DataFrame:
    """The outcomes of each market's universe that its mask leaves out."""
    return mask.select(*keys, market).distinct().join(universe.select(*keys, "outcome"), keys).join(mask, [*keys, market, "outcome"], "left_anti")


def settled(space: DataFrame, results: DataFrame, event: str) -> DataFrame:
    """Each event's settled outcome if it lies inside the space, else null."""
    return results.join(space.select(event, F.col("outcome").alias("settled_outcome"), F.col("outcome").alias("_s")), (results[event] == space[event]) & (results["result"] == F.col("_s")), "left").drop(space[event]).drop("_s")


def mask_check(mask: DataFrame, markets: DataFrame, settlements: DataFrame, event: str, market: str, kind: str) -> DataFrame:
    """Per market type: markets whose settlement the mask predicts, and those it doesn't."""
    hit = markets.join(settlements, event).join(mask.withColumnRenamed("outcome", "_o"), [event, market], "left").groupBy(event, market, kind, "paid").agg(F.bool_or(F.coalesce(F.col("_o") == F.col("settled_outcome"), F.lit(False))).alias("_p"))
    return hit.groupBy(kind).agg(F.count(F.lit(1)).alias("markets"), F.count_if(F.col("_p") == F.col("paid")).alias("agree"), F.count_if(F.col("_p") != F.col("paid")).alias("differ"))
