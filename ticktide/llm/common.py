"""Helpers that every operator of this subpackage shares."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import forget, materialize, shared_dir

__all__ = ["forget", "materialize", "shared_dir"]

#: Fixed pattern of a word: a maximal run of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table, through Spark's reader only."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def text_of(column: str | Column = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def set_aside(docs: DataFrame, *needed: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with all other columns under neutral names, and what gives the names back.

    So a column of the input may have any name, also one that an operator works with.
    """
    names = {c: f"_{i}_aside" for i, c in enumerate(docs.columns) if c not in needed}
    back = {v: k for k, v in names.items()}
    return docs.withColumnsRenamed(names), lambda out: out.withColumnsRenamed(back)


def free_name(taken: tuple[str, ...], base: str = "_text") -> str:
    """A column name that none of ``taken`` is."""
    lowered = {c.lower() for c in taken}
    while base in lowered:
        base += "_"
    return base


def count_words(text: Column) -> Column:
    """Number of words (``WORD``) as a long; built-in functions only."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def prefix_sums(lengths: Column, block: int = 64) -> Column:
    """Exclusive prefix sums of an integer array, in one row and without a UDF.

    Two levels: sums inside blocks of ``block`` entries, then over the blocks. Both grow an
    array inside an aggregate, so the work is about n * block + (n / block) ** 2: made for
    thousands of entries in a row, slow from about a million.
    """
    whole = F.when(F.size(lengths) > 0, F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / F.lit(block)).cast("int"))).otherwise(F.array().cast("array<int>"))
    blocks = F.transform(whole, lambda b: F.slice(lengths, b * block + 1, F.lit(block)))

    def running(values: Column) -> Column:
        """Array of [0, v1, v1+v2, ...], one entry longer than the input."""
        return F.aggregate(values, F.array(F.lit(0)), lambda acc, v: F.array_append(acc, F.element_at(acc, -1) + v))

    bases = running(F.transform(blocks, lambda x: F.aggregate(x, F.lit(0), lambda a, v: a + v)))
    inner = F.transform(blocks, lambda x, i: F.transform(F.slice(running(x), F.lit(1), F.size(x)), lambda v: v + F.element_at(bases, i + 1)))
    return F.flatten(inner)


def located(df: DataFrame, text: str, out: str, pattern: str, extras: dict | None = None, margin: int = 0) -> DataFrame:
    """Add ``out``: the leftmost non-overlapping matches of ``pattern`` with positions.

    Each entry is struct(start, end, found, before, after): code points, end exclusive,
    with up to ``margin`` code points of the text on either side, other matches included. Splitting a text by a pattern gives
    the pieces between its matches, so positions are sums of lengths: no UDF is needed.
    ``pattern`` must not match the empty string. Rows without a match get an empty array.
    """
    found, pieces, starts = f"_{out}_found", f"_{out}_pieces", f"_{out}_starts"
    df = df.withColumn(found, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)))
    df = df.withColumn(pieces, F.when(F.size(found) > 0, F.split(F.col(text), pattern, -1)))
    lengths = F.transform(F.col(found), lambda m, i: F.length(m) + F.length(F.element_at(F.col(pieces), i + 1)))
    df = df.withColumn(f"{starts}_len", F.when(F.size(found) > 0, lengths).otherwise(F.array().cast("array<int>")))
    df = df.withColumn(starts, prefix_sums(F.col(f"{starts}_len")))

    def entry(m: Column, i: Column) -> Column:
        before = F.element_at(F.col(pieces), i + 1)
        start = F.element_at(F.col(starts), i + 1) + F.length(before)
        return F.struct(
            start.alias("start"), (start + F.length(m)).alias("end"), m.alias("found"),
            (F.when((i == 0) | (F.length(before) >= margin), F.right(before, F.lit(margin))).otherwise(F.substr(F.col(text), F.greatest(start - margin, F.lit(0)) + 1, F.least(start, F.lit(margin)))) if margin else F.lit("")).alias("before"),
            (F.when((i + 1 == F.size(found)) | (F.length(after := F.element_at(F.col(pieces), i + 2)) >= margin), F.left(after, F.lit(margin))).otherwise(F.substr(F.col(text), start + F.length(m) + 1, F.lit(margin))) if margin else F.lit("")).alias("after"),
        )

    empty = F.array().cast("array<struct<start:int,end:int,found:string,before:string,after:string>>")
    df = df.withColumn(out, F.when(F.size(found) > 0, F.transform(F.col(found), entry)).otherwise(empty))
    return df.drop(found, pieces, starts, f"{starts}_len")


def joined_spans(spans: Column) -> Column:
    """``kind:start:end`` of sorted struct(start, kind_no, end, kind, ...), comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
