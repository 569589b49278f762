"""Text normalisation and rules text."""

from __future__ import annotations

import unicodedata

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words that carry no identity in a participant's name.
NOISE = ("afc", "cf", "fc", "fk", "sc")

_LATIN_MARKS = regex.compile(r"(?<=\p{Script=Latin})\p{M}+")
_TOKEN = regex.compile(r"[\p{L}\p{N}][\p{L}\p{N}\p{M}]*")


@F.pandas_udf(T.StringType())
def _canonical(text: pd.Series) -> pd.Series:
    def one(x: str) -> str:
        plain = _LATIN_MARKS.sub("", unicodedata.normalize("NFKD", x.casefold()))
        return " ".join(unicodedata.normalize("NFC", t) for t in _TOKEN.findall(plain))

    return text.map(one, na_action="ignore")


def canonical_text(x: Column) -> Column:
    """Case-folded, compatibility forms, accents off Latin letters only, blanks squeezed.

    ASCII text stays in the JVM; only other text goes through Arrow.
    """
    plain = F.trim(F.regexp_replace(F.lower(x), "[^a-z0-9]+", " "))
    return F.when(x.isNull() | x.rlike(r"^[\x00-\x7F]*$"), plain).otherwise(_canonical(x))


def canonical_participant(x: Column) -> Column:
    """The canonical text without noise words; empty if nothing else is left."""
    return F.array_join(F.filter(F.split(canonical_text(x), " "), lambda w: ~w.isin(list(NOISE))), " ")


def participants(title: Column) -> Column:
    """The two sides of "A vs B" or "A @ B", sorted; null unless there are exactly two."""
    peeled = F.regexp_replace(title, r"(?i)\s*[-:(]\s*(game|map|match|winner|moneyline|total|spread).*$", "")
    sides = F.filter(F.transform(F.split(peeled, r"(?i)\s+(?:vs\.?|v|@)\s+"), lambda p: F.trim(p)), lambda p: p != "")
    return F.when(F.size(sides) == 2, F.array_sort(sides))


def best_of(texts: Column) -> Column:
    """The one series length that an array of texts names, else null."""
    found = F.array_distinct(F.flatten(F.transform(texts, lambda t: F.regexp_extract_all(F.lower(t), F.lit(r"\b(?:bo|best of )(\d)\b"), F.lit(1)))))
    return F.when(F.size(found) == 1, F.element_at(found, 1).cast("int"))


def line_value(text: Column) -> Column:
    """The line of a product: a decimal, or n - 0.5 for "n or more"."""
    more = F.regexp_extract(F.lower(text), r"(\d+)\s*(?:\+|or more)", 1)
    plain = F.regexp_extract(text, r"([+-]?\d+(?:\.\d+)?)", 1)
    return F.when(more != "", more.cast("double") - 0.5).when(plain != "", plain.try_cast("double"))


def rule_template(text: Column, *names: Column) -> Column:
    """Rules text with names, dates, times and numbers replaced by placeholders."""
    out = F.lower(text)
    for name in names:
        out = F.when(name.isNotNull() & (name != ""), F.replace(out, F.lower(name), F.lit("<name>"))).otherwise(out)
    out = F.regexp_replace(out, r"\b(january|february|march|april|may|june|july|august|september|october|november|december) [0-9]{1,2}(, [0-9]{4})?\b", "<date>")
    out = F.regexp_replace(out, r"\b[0-9]{4}-[0-9]{2}-[0-9]{2}\b", "<date>")
    out = F.regexp_replace(out, r"\b[0-9]{1,2}:[0-9]{2}( ?[ap]m)?( ?[ecmp]t)?\b", "<time>")
    out = F.regexp_replace(out, r"[0-9]+(\.[0-9]+)?", "<n>")
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def template_drift(rules: DataFrame, product: str, template: str) -> DataFrame:
    """Products with more than one template: a finding, not an error."""
    return rules.groupBy(product).agg(F.count_distinct(template).alias("templates")).where("templates > 1")


# Triggers and payoffs of void clauses, in order of precedence.
TRIGGERS = {"cancelled": r"cancel", "postponed": r"postpone|reschedul", "forfeit": r"forfeit|walkover", "draw": r"\bdraw\b|\btie\b", "no_contest": r"no contest|abandon"}
PAYOFFS = {"fair_price": r"fair (market )?(price|value)", "fifty_fifty": r"50[-/ ]50|split evenly", "resolves_no": r"resolve[s]? (to )?\"?no\b", "resolves_yes": r"resolve[s]? (to )?\"?yes\b", "as_usual": r"settle[s]? normally|as usual"}
PAYOFF_VALUES = {"fair_price": None, "fifty_fifty": 0.5, "resolves_no": 0.0, "resolves_yes": 1.0, "as_usual": 1.0}


def void_policy(rules: DataFrame, key: str, text: str) -> DataFrame:
    """(key, trigger, payoff, value, window_hours, sentence): the first sentence of each trigger wins."""
    sentences = rules.select(key, F.posexplode(F.split(F.lower(text), r"(?<=[.!?])\s+")).alias("sentence", "s"))
    payoff = F.coalesce(*(F.when(F.col("s").rlike(p), F.lit(n)) for n, p in PAYOFFS.items()))
    sentences = sentences.withColumn("payoff", payoff).where("payoff IS NOT NULL")
    hours = F.when(F.col("s").rlike("two weeks"), 336).when(F.regexp_extract("s", r"(\d+) hours?", 1) != "", F.regexp_extract("s", r"(\d+) hours?", 1).try_cast("int")).when(F.regexp_extract("s", r"(\d+) days?", 1) != "", F.regexp_extract("s", r"(\d+) days?", 1).try_cast("int") * 24)
    hit = F.array_compact(F.array(*(F.when(F.col("s").rlike(p), F.lit(n)) for n, p in TRIGGERS.items())))
    found = sentences.withColumn("window_hours", hours).withColumn("trigger", F.explode(hit))
    value = F.lit(None).cast("double")
    for name, v in PAYOFF_VALUES.items():
        value = F.when(F.col("payoff") == name, F.lit(v).cast("double")).otherwise(value)
    first = found.groupBy(key, "trigger").agg(F.min(F.struct("sentence", "payoff", "window_hours")).alias("f")).select(key, "trigger", "f.*")
    return first.withColumn("value", value)


def basket_lock(legs: DataFrame, policies: DataFrame, basket: str, market: str, contracts: float = 1.0) -> DataFrame:
    """LOCKED if every trigger pays at least ``contracts``, CONDITIONAL if one may not, NO_POLICY without clauses."""
    wanted = legs.groupBy(basket).agg(F.count_distinct(market).alias("_n"))
    sums = legs.join(policies, market).groupBy(basket, "trigger").agg(F.count_distinct(market).alias("_have"), F.sum("value").alias("_sum"), F.count("value").alias("_known"))
    sums = sums.join(wanted, basket).withColumn("payoff", F.when((F.col("_have") == F.col("_n")) & (F.col("_known") == F.col("_n")), F.col("_sum")))
    per = sums.groupBy(basket).agg(F.bool_and(F.coalesce(F.col("payoff") >= contracts, F.lit(False))).alias("_all"))
    return wanted.join(per, basket, "left").select(basket, F.when(F.col("_all").isNull(), "NO_POLICY").when(F.col("_all"), "LOCKED").otherwise("CONDITIONAL").alias("lock"))


def tiles(df: DataFrame, start: str, end: str, period: int, most: int) -> DataFrame:
    """Spans split into tiles of at most ``most`` periods: one row a tile (tile_start, tile_end)."""
    width = period * most
    out = df.withColumn("tile_start", F.explode(F.sequence(F.col(start), F.col(end) - 1, F.lit(width).cast("long"))))
    return out.withColumn("tile_end", F.least(F.col(end), F.col("tile_start") + width))


def window_start(name: str) -> Column:
    """Microseconds of the UTC stamp in a segment's file name (YYYYMMDDTHHMMSSZ), else null."""
    stamp = F.nullif(F.regexp_extract(name, r"(\d{8}T\d{6})Z", 1), F.lit(""))
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.to_timestamp_ntz(stamp, F.lit("yyyyMMdd'T'HHmmss")))


def safe_name(x: Column) -> Column:
    return F.regexp_replace(x, r"[^A-Za-z0-9._-]+", "_")


def pair_key(base: Column, quote: Column) -> Column:
    return F.concat_ws("/", F.upper(F.trim(base)), F.upper(F.trim(quote)))
