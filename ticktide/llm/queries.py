"""The registered queries of this subpackage: thin, whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, chat, embdedup, linededup, mixing, pii, quality, secrets, simhash, spelling, tokenfile, turnrepair
from .common import read, shared_dir


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(read(spark, sf_dir, "documents"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(chat.planted(read(spark, sf_dir, "conversations")))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.apply(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), ("n_tokens", "ids_sha256", "decoded_sha256"))


def op5_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid

    import public_tokenizers

    path = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    tokenfile.write(read(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, base=50257)
    return tokenfile.read(spark, path)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(read(spark, sf_dir, "documents"))


def op7_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.digest(read(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.digest(read(spark, sf_dir, "embeddings"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.apply(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.drop("longest_repeat").withColumn("covered", F.round("covered", 9))


def op11_embdedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embdedup.digest(read(spark, sf_dir, "embeddings"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.digest(read(spark, sf_dir, "documents"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turnrepair.digest(read(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_pii, op2_secrets, op3_chat, op4_bpe, op5_repair, op6_simhash, op7_linededup, op8_mixing, op9_ann, op10_quality, op11_embdedup, op12_spelling, op13_repair, pipeline)
}
