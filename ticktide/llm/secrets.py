"""Secrets: fixed patterns, and character Markov models of random strings and identifiers.

Two first-order character models, one of random strings and one of ordinary identifiers,
are trained from labelled samples by counting character pairs. A long token is reported
when its log-likelihood ratio says random. Built-in functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import joined_spans, located, text_of

BASE = ("assign", "access", "hex")
ADDED = ("random",)
# What each kind looks like (letters of the keywords in either case).
ASSIGN_KEYS = "password|passwd|secret|token|api_?key"
PATTERNS = {
    "assign": rf"(?i:{ASSIGN_KEYS})[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]++",
    "access": r"AKIA[A-Z0-9]{14,}+",
    "hex": r"[0-9a-f]{16,}+",
    "random": r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+",
}
ASSIGN_VALUE = rf"^(?i:{ASSIGN_KEYS})[\"']?\x20*[:=]\x20*[\"']?"
MIN_ASSIGN = 12
#: The models' alphabet; every other character falls into one more class.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
CLASSES = len(ALPHABET) + 1
#: Labelled documents that the models are trained on at most, those of smallest hash.
SAMPLE_DOCS = 4000
#: A token is random from this mean log-likelihood ratio per pair (nats).
MIN_RATIO = 0.5


def _class(c: Column) -> Column:
    """0-based class of a one-character string."""
    at = F.instr(F.lit(ALPHABET), c)
    return F.when((at > 0) & (c != ""), at - 1).otherwise(F.lit(CLASSES - 1))


def _locate_base(df: DataFrame, text: str, prefix: str) -> DataFrame:
    for kind in BASE:
        df = located(df, text, f"{prefix}{kind}", PATTERNS[kind])
    value = lambda s: F.regexp_replace(s["found"], ASSIGN_VALUE, "")
    return df.withColumn(f"{prefix}assign", F.filter(F.col(f"{prefix}assign"), lambda s: F.length(value(s)) >= MIN_ASSIGN))


def labelled_samples(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE_DOCS) -> DataFrame:
    """(token, random): strings labelled by the base patterns, from at most ``limit`` labelled documents.

    Values that a base pattern finds are labelled random, words of letters in the same
    documents ordinary. Fewer labelled documents give fewer samples; none give no rows.
    """
    chosen = labels.select("doc_id").where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    df = docs.select("doc_id", text_of("text").alias("text")).join(F.broadcast(chosen), "doc_id", "left_semi")
    df = _locate_base(df.withColumn("_t", F.col("text")), "_t", "_s_")
    found = F.concat(
        F.transform(F.col("_s_assign"), lambda s: F.regexp_replace(s["found"], ASSIGN_VALUE, "")),
        F.transform(F.col("_s_access"), lambda s: s["found"]), F.transform(F.col("_s_hex"), lambda s: s["found"]),
    )
    words = F.regexp_extract_all(F.col("text"), F.lit(r"(?<![A-Za-z0-9+/_=-])[A-Za-z_]{3,40}(?![A-Za-z0-9+/_=-])"), F.lit(0))
    random = df.select(F.explode(found).alias("token"), F.lit(True).alias("random"))
    return random.unionByName(df.select(F.explode(words).alias("token"), F.lit(False).alias("random")))


def train(samples: DataFrame, smoothing: float = 0.5, prior: float = 4.0) -> list[float]:
    """Log-likelihood ratio of every pair of character classes, random against ordinary.

    Returns CLASSES * CLASSES numbers, row by row: a model of fixed size whatever the
    samples. Pairs are counted in Spark; only the counts reach the driver. Without
    samples every ratio is 0, and nothing is found.
    """
    tokens = samples.groupBy("token", "random").count().where(F.length("token") > 1)
    pairs = tokens.select("random", "count", F.explode(F.sequence(F.lit(1), F.length("token") - 1)).alias("i"), "token")
    a, b = F.substr("token", F.col("i"), F.lit(1)), F.substr("token", F.col("i") + 1, F.lit(1))
    counted = pairs.groupBy("random", (_class(a) * CLASSES + _class(b)).alias("pair")).agg(F.sum("count").alias("n"))
    counts = {kind: [0.0] * (CLASSES * CLASSES) for kind in (True, False)}
    for row in counted.collect():  # at most 2 * CLASSES^2 rows
        counts[row["random"]][row["pair"]] = float(row["n"])
    if not any(counts[True]) or not any(counts[False]):
        return [0.0] * (CLASSES * CLASSES)

    def logs(n: list[float]) -> list[float]:
        """log P(b | a), each row drawn towards how often b occurs at all."""
        column = [sum(n[b::CLASSES]) + smoothing for b in range(CLASSES)]
        overall = [x / sum(column) for x in column]
        out = []
        for r in range(CLASSES):
            row = n[r * CLASSES : (r + 1) * CLASSES]
            out += [math.log((x + prior * o) / (sum(row) + prior)) for x, o in zip(row, overall, strict=True)]
        return out

    return [x - y for x, y in zip(logs(counts[True]), logs(counts[False]), strict=True)]


def find_secrets(docs: DataFrame, model: list[float], text: str = "text", spans: str = "secrets", min_ratio: float = MIN_RATIO) -> DataFrame:
    """Add ``spans``: array of struct(start, kind_no, end, kind, score), sorted.

    Positions are code points, end exclusive. Base spans always stay, with score null
    unless the models rate them; ``random`` spans are maximal runs of 20 or more token
    characters, holding a digit, whose mean ratio reaches ``min_ratio``. Null text counts
    as empty. Other columns are kept; kinds may overlap each other.
    """
    df = _locate_base(docs.withColumn("_sec_text", text_of(text)), "_sec_text", "_sec_")
    df = located(df, "_sec_text", "_sec_random", PATTERNS["random"])
    df = df.withColumn("_sec_model", F.split(F.lit(",".join(repr(round(x, 6)) for x in model)), ",").cast("array<double>"))

    def ratio(found: Column) -> Column:
        steps = F.sequence(F.lit(1), F.length(found) - 1)
        term = lambda i: F.element_at(F.col("_sec_model"), _class(F.substr(found, i, F.lit(1))) * CLASSES + _class(F.substr(found, i + 1, F.lit(1))) + 1)
        return F.aggregate(steps, F.lit(0.0), lambda acc, i: acc + term(i)) / (F.length(found) - 1)

    def spans_of(kind: str, no: int) -> Column:
        score = (lambda s: ratio(s["found"])) if kind == "random" else (lambda s: F.lit(None).cast("double"))
        part = F.col(f"_sec_{kind}")
        if kind == "random":
            part = F.filter(part, lambda s: s["found"].rlike("[0-9]"))
        part = F.transform(part, lambda s: F.struct(s["start"].alias("start"), F.lit(no).alias("kind_no"), s["end"].alias("end"), F.lit(kind).alias("kind"), score(s).alias("score")))
        return part if kind in BASE else F.filter(part, lambda s: s["score"] >= min_ratio)

    parts = [spans_of(kind, no) for no, kind in enumerate((*BASE, *ADDED))]
    df = df.withColumn(spans, F.array_sort(F.concat(*parts)))
    return df.drop("_sec_text", "_sec_model", *(f"_sec_{k}" for k in (*BASE, *ADDED)))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document with the counts and hashes of what ``find_secrets`` found."""
    model = train(labelled_samples(docs, labels))
    df = find_secrets(docs.select("doc_id", "text"), model).drop("text")
    base = F.filter(F.col("secrets"), lambda s: s["kind_no"] < len(BASE))
    count = lambda k: F.size(F.filter(F.col("secrets"), lambda s: s["kind"] == k)).cast("long")
    return df.select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in (*BASE, *ADDED)),
        F.sha2(joined_spans(base).cast("binary"), 256).alias("base_sha256"),
        joined_spans(F.col("secrets")).alias("spans"),
    )
