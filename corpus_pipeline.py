"""A training corpus from raw documents: five stages, each written and read by the next.

Quality rules, line dedup, SimHash near-dedup, mixing to target weights, BPE encoding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticktide.llm import bpe, linededup, mixing, quality, simhash
from ticktide.llm.common import materialize, read, set_aside


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Null and empty texts have no words and go; equal rows are judged alike; texts of any
    length are judged whole. An empty table gives no rows; other columns may have any names.
    """
    columns = docs.columns
    docs, named = set_aside(docs, "doc_id", "text")
    judged = quality.apply(docs, carry=tuple(docs.columns)).where("kept")
    return named(judged.drop(*(f.name for f in quality.FIELDS))).select(*columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are cut out; a document that lost all its words goes.

    The first copy is that of the least doc_id, null first; of equal rows the first stays.
    Null text stays null, an empty one empty. n_chars counts what is left. An empty table
    gives no rows; other columns may have any names.
    """
    columns = docs.columns
    out = linededup.apply(docs, drop_emptied=True)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of the least doc_id; five-word shingles, similarity 0.8 or more.

    A null doc_id is never the least beside another. Null, empty and blank texts are one
    group, equal rows too; long texts are compared whole. An empty table gives no rows;
    other columns may have any names.
    """
    return simhash.keep_one(docs, words=5, similarity=0.8)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source's share of the words by weight: a document appears as often as it is taken.

    Null sources are one source, the last. Texts without a word, null ones too, are never
    taken; equal rows are interchangeable; a document of any length is taken whole or not.
    An empty table gives no rows; other columns may have any names.
    """
    return mixing.resample(docs, read(spark, sf_dir, "labels"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document of the mix, and the hash of what they decode to.

    Of the columns doc_id and source those that there are are carried on; all others go. Null text
    counts as empty and gives no ids; repeated rows give repeated rows; an empty table none.
    """
    import public_tokenizers

    return bpe.apply(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), ("ids", "n_tokens", "decoded_sha256"), carry=tuple(c for c in ("doc_id", "source") if c in docs.columns))


STAGES = [("quality rules", rules), ("line dedup", lines), ("near duplicates", near_duplicates), ("mixing", mixed), ("encoding", encoded)]

#: SQL can't express the fingerprints' components or the merges of a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written before the next reads it."""
    docs = read(spark, sf_dir, "documents")
    for no, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if no < len(STAGES) - 1:
            docs = materialize(docs, f"stage{no}")
    return docs
