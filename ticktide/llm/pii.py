"""Personal data: patterns propose spans, checksums confirm them, context words score them.

Built-in functions only; one pass over the rows, no shuffle, nothing broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import joined_spans, located, text_of

#: Kinds whose matches always stay, in the order in which equal starts are listed.
BASE = ("email", "ip", "card", "phone")
#: Kinds that the method adds, after them.
ADDED = ("iban", "national_id")

#: Length of an account number by country, from the public registry.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_KNOWN = "|".join(c for codes in IBAN_LENGTHS.values() for c in codes.split())
#: A code of a known country has that country's length; others as long as they go on.
_IBAN = "|".join(
    [rf"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}(?![A-Za-z0-9])" for n, codes in IBAN_LENGTHS.items()]
    + [rf"(?!{_KNOWN})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}}(?![A-Za-z0-9])"]
)

# What each kind looks like. The lookarounds leave the matches of the plain
# patterns as they are; they keep the scan linear and the matcher's stack flat on long runs.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{_IBAN})",  # the codes are only tried where one can stand
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: Words that make a kind more likely when they stand nearby.
CONTEXT = {
    "email": "mail|email|e-mail|contact|write|reply",
    "ip": "ip|address|host|server|login|subnet",
    "card": "card|visa|mastercard|credit|payment|debit",
    "phone": "phone|call|tel|mobile|fax|dial",
    "iban": "iban|account|bank|transfer|swift",
    "national_id": "ssn|social|security|identity|passport|tax",
}
#: Score of a span before its context counts, and what a context word adds.
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.8, "national_id": 0.3}
CONTEXT_BONUS = 0.25
MARGIN = 48


def luhn(digits: Column) -> Column:
    """True where a string of digits passes the Luhn checksum."""

    def term(total: Column, i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), term) % 10 == 0


def mod97(code: Column) -> Column:
    """True where an account number (letters as 10 to 35, first four last) is 1 modulo 97."""
    moved = F.concat(F.substr(code, F.lit(5)), F.left(code, F.lit(4)))

    def term(rest: Column, c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), (rest * 10 + F.ascii(c) - 48) % 97).otherwise((rest * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.split(moved, ""), F.lit(0), lambda rest, c: F.when(c == "", rest).otherwise(term(rest, c))) == 1


def _confirmed(kind: str, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(found, r"\."), lambda p: p.rlike("^0*(?:[0-9]|[1-9][0-9]|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "iban":
        return mod97(F.replace(found, F.lit(" "), F.lit("")))
    return F.lit(True)


def _scored(kind: str, no: int) -> Column:
    """The confirmed spans of a kind, with their scores."""
    near = rf"(?i)(?<![a-z])(?:{CONTEXT[kind]})(?![a-z])"

    def scored(s: Column) -> Column:
        hit = F.concat(s["before"], F.lit(" | "), s["after"]).rlike(near)
        score = F.least(F.lit(1.0), F.lit(PRIOR[kind]) + F.when(hit, F.lit(CONTEXT_BONUS)).otherwise(F.lit(0.0)))
        return F.struct(s["start"].alias("start"), F.lit(no).alias("kind_no"), s["end"].alias("end"), F.lit(kind).alias("kind"), score.alias("score"))

    return F.transform(F.filter(F.col(f"_pii_{kind}"), lambda s: _confirmed(kind, s["found"])), scored)


def find_pii(docs: DataFrame, text: str = "text", spans: str = "pii", min_score: float = 0.5) -> DataFrame:
    """Add ``spans``: array of struct(start, kind_no, end, kind, score), sorted.

    Positions are code points, end exclusive. Spans of the base kinds always stay; those
    of the added kinds stay from ``min_score``. Null text counts as empty; a text without
    personal data gets an empty array. All other columns are kept; working columns have
    names that begin with an underscore and ``_pii``. Kinds may overlap each other.
    """
    df = docs.withColumn("_pii_text", text_of(text))
    parts = []
    for no, kind in enumerate((*BASE, *ADDED)):
        df = located(df, "_pii_text", f"_pii_{kind}", PATTERNS[kind], margin=MARGIN)
        kept = _scored(kind, no)
        parts.append(kept if kind in BASE else F.filter(kept, lambda s: s["score"] >= min_score))
    df = df.withColumn(spans, F.array_sort(F.concat(*parts)))
    return df.drop("_pii_text", *(f"_pii_{k}" for k in (*BASE, *ADDED)))


def redact(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets; an overlap goes to the first."""
    step = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(s["start"] < acc["at"], acc).otherwise(F.struct(s["end"].alias("at"), F.concat(acc["out"], F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("<"), s["kind"], F.lit(">")).alias("out"))),
    )
    return F.concat(step["out"], F.substr(text, step["at"] + 1))


def digest(docs: DataFrame) -> DataFrame:
    """One row per document with the counts and hashes of what ``find_pii`` found."""
    df = find_pii(docs.select("doc_id", "text")).drop("text")
    base = F.filter(F.col("pii"), lambda s: s["kind_no"] < len(BASE))
    count = lambda k: F.size(F.filter(F.col("pii"), lambda s: s["kind"] == k)).cast("long")
    return df.select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in (*BASE, *ADDED)),
        F.sha2(joined_spans(base).cast("binary"), 256).alias("base_sha256"),
        joined_spans(F.col("pii")).alias("spans"),
        F.coalesce(F.array_max(F.transform(F.col("pii"), lambda s: s["score"])), F.lit(0.0)).alias("max_score"),
    )
