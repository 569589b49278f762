"""Titles of fixtures: three grammars for the two sides, and what a product's labels say (K2, K3, K6). Column expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import canonical_participant

# Reviewed separators and suffixes. Only whole suffixes at the end are peeled; a dash inside a name stays.
SERIES_VERSUS = r"(?i)\s+(?:vs\.?|versus|v\.|@)\s+"
FIXTURE_VERSUS = r"(?i)\s+(?:vs\.?|versus|v\.?|@)\s+"
PAIR_VERSUS = r"(?i)\s+vs\.?\s+"
SERIES_SUFFIXES = (
    r"\s*:\s*(?:(?:map|game)\s+[1-9][0-9]*|total\s+(?:maps|games)|(?:map|game)\s+handicap|match\s+winner)\s*",
    r"\s*\((?:bo|best\s+of)\s*[1-9][0-9]?\)(?:\s+-\s+.*)?",
    r"\s+-\s+more\s+markets\s*",
)
FIXTURE_TAIL = r"(?i)\s+-\s+(?:more markets|exact score|correct score|halftime result|first half result|second half result|first team to score|total corners)\s*$"
FIXTURE_PRODUCT = r"(?i)\s*:\s*(?:spread|match winner|game winner|winner|total(?: goals)?|both teams to score|correct score|exact score)\s*$"
PROP = r"(?i)^(.+?)\s+and\s+(.+?)\s+(?:both\s+to\s+score|have\s+\d+\s+or\s+more\s+total\s+goals)"
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#34;": '"', "&#39;": "'", "&#x27;": "'", "&apos;": "'", "&nbsp;": " ", "&#64;": "@", "&ndash;": "–", "&amp;": "&"}
LINED = ("spread", "total_goals", "team_total_goals", "total_maps", "map_handicap")
SIDED = ("moneyline_3way", "spread", "team_total_goals", "series_moneyline", "map_winner")


def unescaped(x: Column) -> Column:
    """The named and numbered entities that titles hold, as characters; an ampersand last, so nothing is read twice."""
    for entity, char in ENTITIES.items():
        x = F.replace(x, F.lit(entity), F.lit(char))
    return x


def _squeezed(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.replace(unescaped(x), F.lit(" "), F.lit(" ")), r"\s+", " "))


def _two(text: Column, versus: str) -> Column:
    """The two sides that a separator leaves, trimmed; null unless there are exactly two that aren't empty."""
    sides = F.transform(F.split(text, versus), lambda s: F.trim(s))
    return F.when((F.size(sides) == 2) & F.forall(sides, lambda s: s != ""), sides)


def series_sides(title: Column, aliases: tuple[str, ...]) -> Column:
    """Sides of a best-of series: "<game>: A vs B", any reviewed suffixes peeled until none is left.

    A colon before the separator that no alias of the game explains makes the title unreadable: null.
    """
    text = _squeezed(title)
    names = "|".join(r"\s+".join(rf"\Q{w}\E" for w in a.split()) for a in sorted(aliases, key=len, reverse=True))
    prefix = rf"(?i)^(?:{names})\s*:\s*" if names else r"(?!)"
    # all suffixes at the end in one match: the leftmost is the longest chain, as peeling one by one would leave
    peeled = F.trim(F.regexp_replace(F.regexp_replace(text, prefix, ""), rf"(?i)(?:{'|'.join(SERIES_SUFFIXES)})+$", ""))
    strange = ~text.rlike(prefix) & F.split(text, SERIES_VERSUS)[0].contains(":") & text.rlike(SERIES_VERSUS)
    return F.when(~strange, _two(peeled, SERIES_VERSUS))


def fixture_sides(title: Column) -> Column:
    """Sides of a single contest: a league before a comma and a spaced dash after the right side are no names."""
    text = F.trim(F.regexp_replace(F.regexp_replace(unescaped(title), FIXTURE_TAIL, ""), FIXTURE_PRODUCT, ""))
    rest = F.regexp_extract(text, r"(?s)^[^,]*,(.*)$", 1)
    text = F.when(rest.rlike(FIXTURE_VERSUS), F.trim(rest)).otherwise(text)
    sides = F.transform(F.split(text, FIXTURE_VERSUS), lambda s: F.regexp_replace(s, r"^[ -]+|[ -]+$", ""))
    right = F.trim(F.split(sides[1], " - ")[0])
    return F.when((F.size(sides) == 2) & (sides[0] != "") & (right != ""), F.array(sides[0], right))


def prop_sides(title: Column) -> Column:
    """Sides of "A and B both to score" and "A and B have n or more total goals"."""
    text = unescaped(title)
    return F.when(text.rlike(PROP), F.array(F.trim(F.regexp_extract(text, PROP, 1)), F.trim(F.regexp_extract(text, PROP, 2))))


def pair_keys(title: Column, game: str) -> Column:
    """Sorted keys (ASCII letters and digits only) of a playoff title; null without a separator."""
    text = F.when(F.lower(title).startswith(f"{game.lower()}:"), F.regexp_replace(title, r"(?s)^[^:]*:", "")).otherwise(title)
    text = F.trim(F.split(F.split(text, r"(?i)\(BO\d+\)")[0], " - ")[0])
    sides = F.split(text, PAIR_VERSUS, 2)
    return F.when(F.size(sides) == 2, F.array_sort(F.transform(sides, lambda s: F.regexp_replace(F.lower(s), "[^a-z0-9]+", ""))))


def _first(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def parameters(market_type: Column, text: Column, one: Column, two: Column, labels: Column, strike: Column | None = None) -> Column:
    """struct(line, line_style, side, home_goals, away_goals, map_index, direction, published_line) of a product.

    ``text``: title and subtitles joined; ``labels``: outcome labels joined, read where the text
    names no side. "n or more" is the open line n - 0.5, with n as the published one. ``strike`` is the line where
    the text has none.
    """
    over_under, in_brackets = _first(text, r"(?i)\bo\s*/\s*u\s*([-+]?\d+(?:\.\d+)?)"), _first(text, r"\(\s*([-+]?\d+(?:\.\d+)?)\s*\)")
    found = F.coalesce(over_under, in_brackets, _first(text, r"(?<!\d)([-+]?\d+(?:\.\d+)?)(?!\d)"))
    lower = F.lower(text)
    more = market_type.isin("total_goals", "total_maps") & lower.contains("or more")
    raw = F.when(market_type.isin(*LINED), found.try_cast("double"))
    whole = more & (raw == F.floor(raw))
    line = F.when(whole, raw - 0.5).otherwise(raw)
    keys = [canonical_participant(one), canonical_participant(two)]

    def named(x: Column) -> Column:
        """The side that alone is named, or a draw; null if neither or both are."""
        plain = canonical_participant(x)
        home, away = ((k != "") & plain.contains(k) for k in keys)
        return F.struct((home | away).alias("any"), F.when(home & ~away, "home").when(away & ~home, "away").when(plain.contains("draw") | plain.contains("tie"), "draw").alias("side"))

    by_text, by_labels = named(text), named(labels)
    side = F.when(market_type.isin(*SIDED), F.when(by_text["any"], by_text["side"]).otherwise(by_labels["side"]))
    score = market_type == "correct_score"
    return F.struct(
        F.coalesce(line, strike if strike is not None else F.lit(None).cast("double")).alias("line"),
        F.when(raw.isNotNull() & in_brackets.isNotNull() & market_type.isin("spread", "map_handicap"), "handicap").alias("line_style"),
        side.alias("side"),
        F.when(score, _first(text, r"(?<!\d)(\d+)\s*[-:]\s*\d+(?!\d)").try_cast("int")).alias("home_goals"),
        F.when(score, _first(text, r"(?<!\d)\d+\s*[-:]\s*(\d+)(?!\d)").try_cast("int")).alias("away_goals"),
        F.when(market_type == "map_winner", _first(text, r"(?i)\b(?:game|map)\s*(\d+)\b").try_cast("int")).alias("map_index"),
        F.when(market_type.isin("total_goals", "total_maps"), F.when(lower.contains("under"), "under").when(lower.contains("over") | lower.contains("or more"), "over")).alias("direction"),
        F.when(whole, raw.cast("int")).alias("published_line"),
    )
