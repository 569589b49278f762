"""Mixing sources to target weights: weighted sampling by exponential keys.

Targets in words are filled source by source: complete epochs first, then a fraction drawn
by Efraimidis-Spirakis keys, -ln(u) / weight, smallest first, up to the budget. Built-in
functions only. A source may hold most rows: its order is found over buckets of the key,
and only the bucket in which the budget ends is ever sorted row by row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import count_words, materialize, set_aside, text_of

#: Weights of the sources in code-point order, repeating; a target's limit in source sizes.
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: Buckets of the key for each source. The rows of one bucket are sorted in one task.
BUCKETS = 4096
SEED = 11


def quality_weight(quality: Column) -> Column:
    """Sampling weight of a document from its 0/1 quality label; unlabelled lies between."""
    return F.when(quality == 1, 2.0).when(quality == 0, 0.5).otherwise(1.0)


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, limit: float = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> also ``target``: shares of the total by weight, capped.

    A target stops at ``limit`` times its source's size; the excess goes to the others by
    weight until none is above. That is a water level: sources ordered by cap per weight
    are capped as long as the level of the remainder reaches their cap. One row a source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    df = sizes.withColumn("_no", F.row_number().over(by_name) - 1)
    df = df.withColumn("_w", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("_no") % len(weights) + 1).cast("int")))
    df = df.withColumn("_cap", F.col("source_size") * float(limit))
    level = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("_no"))
    before, everything = level.rowsBetween(Window.unboundedPreceding, -1), level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum(F.col("source_size").cast("double")).over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    rest = F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    df = df.withColumn("_level", left / rest).withColumn("_capped", F.col("_level") * F.col("_w") >= F.col("_cap"))
    # the first source that isn't capped sets the level of all after it
    free = F.first(F.when(~F.col("_capped"), F.col("_level")), ignorenulls=True).over(everything)
    return df.select("source", "source_size", F.when(F.col("_capped"), F.col("_cap")).otherwise(free * F.col("_w")).alias("target"))


def keyed(docs: DataFrame, labels: DataFrame | None, seed: int = SEED, extra: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, source, size, key, bucket, tie, *extra): the slim table that the sampling works on.

    ``key`` depends on doc_id, source and text alone, so reruns agree; equal rows have
    equal keys and are interchangeable.
    """
    text = text_of("text")
    h = F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("source", F.lit("")), text)
    df = docs.select("doc_id", "source", count_words(text).alias("size"), h.alias("tie"), *extra)
    if labels is None:
        df = df.withColumn("_quality", F.lit(None).cast("int"))
    else:
        # only labels of one answer count; the join key is spread by nature, labels are one row a document
        one = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.max("quality").alias("_quality"))
        df = df.join(one, df["doc_id"] == one["_id"], "left").drop("_id")
    uniform = (F.shiftrightunsigned("tie", 11).cast("double") + 0.5) / float(2**53)
    df = df.withColumn("key", -F.log(uniform) / quality_weight(F.col("_quality")))
    # 1 - exp(-key) spreads the keys of weight-1 rows evenly over the buckets and keeps their order
    bucket = F.least(F.floor((1 - F.exp(-F.col("key"))) * BUCKETS), F.lit(BUCKETS - 1)).cast("int")
    return df.select("doc_id", "source", "size", "key", bucket.alias("bucket"), "tie", *extra)


def mix(slim: DataFrame, weights: tuple = WEIGHTS, limit: float = MAX_EPOCHS, split_last: bool = True, extra: tuple[str, ...] = ()) -> DataFrame:
    """Rows of ``keyed`` with source_size, target and ``taken``: words the mix takes.

    Null sources form one source, the last. With ``split_last`` the document in which the
    budget ends gives only the words still missing, so a source's words meet its target
    to the word; else it is taken whole where at least half of it fits. Rows of size 0
    take 0. An empty table gives no rows.
    """
    per_bucket = slim.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    in_order = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per_bucket = per_bucket.withColumn("before", F.coalesce(F.sum("bucket_size").over(in_order), F.lit(0))).withColumn("source_size", F.sum("bucket_size").over(whole))
    sizes = per_bucket.groupBy("source").agg(F.max("source_size").alias("source_size"))
    wanted = targets(sizes, weights, limit).withColumnRenamed("source", "_s")
    total = F.col("source_size")
    plan = per_bucket.join(wanted.drop("source_size"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    plan = plan.withColumn("epochs", F.when(total > 0, F.least(F.floor(F.col("target") / total), F.lit(math.floor(limit)))).otherwise(F.lit(0)).cast("long"))
    plan = plan.withColumn("budget", F.round(F.col("target") - F.col("epochs") * total).cast("long"))
    plan = plan.withColumn("edge", (F.col("before") < F.col("budget")) & (F.col("before") + F.col("bucket_size") > F.col("budget")))
    plan = plan.select(F.col("source").alias("_s"), F.col("bucket").alias("_b"), "source_size", "target", "epochs", "budget", "before", "edge", "bucket_size")
    rows = slim.join(plan, slim["source"].eqNullSafe(plan["_s"]) & (slim["bucket"] == plan["_b"])).drop("_s", "_b")

    kept = ("doc_id", "source", "size", "source_size", "target", *extra)
    taken = lambda part: (F.col("epochs") * F.col("size") + part).alias("taken")
    inside = rows.where(~F.col("edge")).select(*kept, taken(F.when(F.col("before") < F.col("budget"), F.col("size")).otherwise(F.lit(0))))
    by_key = Window.partitionBy("source", "bucket").orderBy("key", "tie", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("before") + F.coalesce(F.sum("size").over(by_key), F.lit(0))
    left = F.greatest(F.lit(0), F.least(F.col("size"), F.col("budget") - F.col("_at")))
    part = left if split_last else F.when(2 * left >= F.col("size"), F.col("size")).otherwise(F.lit(0))
    edge = rows.where("edge").withColumn("_at", at).select(*kept, taken(part))
    return inside.unionByName(edge)


def digest(docs: DataFrame, labels: DataFrame | None) -> DataFrame:
    """One row per document: its size, its source's size and target, and the words taken."""
    slim = materialize(keyed(docs, labels), "mix")
    return mix(slim).select("doc_id", "source", "size", "source_size", "target", "taken")


def resample(docs: DataFrame, labels: DataFrame | None, weights: tuple = WEIGHTS, limit: float = MAX_EPOCHS) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as its words are taken, whole rows only.

    Columns and texts stay as they are, whatever their names. Rows without a word are
    never taken; an empty table gives no rows. The text is hashed and counted once; texts meet
    the decisions through the row numbers of a written table.
    """
    columns = docs.columns
    docs, named = set_aside(docs, "doc_id", "source", "text")
    rows = materialize(docs.withColumn("_row", F.monotonically_increasing_id()), "docs")
    slim = materialize(keyed(rows, labels, extra=("_row",)), "mix")
    taken = mix(slim, weights, limit, split_last=False, extra=("_row",)).where("taken > 0").select("_row", F.floor(F.col("taken") / F.col("size")).cast("int").alias("_times"))
    repeated = rows.join(taken, "_row").withColumn("_times", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    return named(repeated.select(*docs.columns)).select(*columns)
