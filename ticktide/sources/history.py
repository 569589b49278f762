"""History and catalogue sources, evidence-gated sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed shapes of the history inputs.
DEPTH = "market_id string, asset_id string, timestamp bigint, yes_bids array<struct<price:string,size:double>>, no_bids array<struct<price:string,size:double>>, bids array<struct<price:string,size:double>>, asks array<struct<price:string,size:double>>, best_yes_bid double, best_yes_ask double, best_bid double, best_ask double, _provenance struct<source:string,target_id:string>"
CANDLE = "ticker string, end_period_ts bigint, yes_bid struct<close_dollars:string>, yes_ask struct<close_dollars:string>"
POINT = "condition_id string, asset_id string, timestamp_seconds bigint, price double"


def ndjson(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of an NDJSON file; blank lines are passed over, anything but an object fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def candles(spark: SparkSession, path: str) -> DataFrame:
    raw = ndjson(spark, path, CANDLE)
    return raw.select("ticker", F.col("end_period_ts").alias("at"), F.col("yes_bid.close_dollars").try_cast("double").alias("bid"), F.col("yes_ask.close_dollars").try_cast("double").alias("ask"))


def price_points(spark: SparkSession, path: str) -> DataFrame:
    return ndjson(spark, path, POINT).orderBy("asset_id", "timestamp_seconds")


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """(digest, venue, target...) of metadata snapshots; a snapshot without venue or targets is marked."""
    raw = spark.read.option("multiLine", "true").schema("metadata_digest string, venue string, targets array<struct<asset_id:string,condition_id:string,market_id:string>>").json(path)
    return raw.select(F.col("metadata_digest").alias("digest"), "venue", (F.col("venue").isNull() | F.col("targets").isNull()).alias("invalid"), F.explode_outer("targets").alias("t")).select("digest", "venue", "invalid", "t.*")


def selected_runs(runs: DataFrame, start: int, end: int, at: str = "at") -> DataFrame:
    """Runs inside the span and the last one before it; ``predecessor`` marks that one.

    The span has no defined state without a predecessor: then no row is marked.
    """
    before = runs.where(F.col(at) < start).agg(F.max(at).alias("_m"))
    marked = runs.join(F.broadcast(before)).withColumn("predecessor", F.col(at).eqNullSafe(F.col("_m"))).drop("_m")
    return marked.where(F.col("predecessor") | ((F.col(at) >= start) & (F.col(at) <= end)))


def write_books(books: DataFrame, path: str) -> None:
    """Normalised books as zstd Parquet."""
    books.write.mode("errorifexists").option("compression", "zstd").parquet(path)


def write_observations(rows: DataFrame, path: str, by: str = "partition_class") -> None:
    rows.write.mode("errorifexists").option("compression", "zstd").partitionBy(by).parquet(path)


def write_result(result: DataFrame, evidence: dict[str, DataFrame], path: str) -> None:
    """Write a result with its evidence beside it; refuse if any evidence is empty."""
    empty = [name for name, df in evidence.items() if df.isEmpty()]
    if empty:
        raise ValueError(f"no evidence: {', '.join(sorted(empty))}")
    for name, df in {**evidence, "result": result}.items():
        df.write.mode("errorifexists").option("compression", "zstd").parquet(f"{path}/{name}")
