"""Digests of sets of any size: leaves by hash, hashes of hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Members that a leaf holds at most on average, and leading bits that the leaves under one node differ in.
LEAF, FAN = 4_096, 12
#: Leading bits of a member's SHA-256 that can name a leaf.
HEAD = 60


def _hash(x: Column) -> Column:
    return F.sha2(F.array_join(x, "\n").cast("binary"), 256)


def tiered_digest(rows: DataFrame, keys: list[str], value: str, leaf: int = LEAF, fan: int = FAN) -> DataFrame:
    """(keys, members, digest): a digest of each key's set of strings, whatever their order and repeats.

    A member's leaf is the start of its SHA-256, as many bits as the set's size asks for, so the
    leaves are a property of the set and of nothing else. A leaf's hash is that of its sorted
    members, joined by newlines; then leaves that share all but their last ``fan`` bits are one node, and
    the nodes are the root, in order. What is alone keeps its hash, so a set within ``leaf`` has the plain hash of
    its sorted members. Null members don't count; a key of null members only has the hash of
    nothing. A million members are arrays of 4,096 and 256, 10^12 of 4,096 and 65,536.
    """
    members = rows.select(*keys, F.col(value).cast("string").alias("_v")).distinct()
    sizes = members.groupBy(*keys).agg(F.count("_v").alias("members"))
    over = F.floor((F.col("members") - 1) / leaf).cast("long")
    sizes = sizes.withColumn("_bits", F.when(F.col("members") > leaf, F.length(F.bin(over))).otherwise(0))
    on = [F.col(f"m.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    named = members.alias("m").join(sizes.alias("s"), on).select("m.*", "members", "_bits").where("_v IS NOT NULL OR members = 0")
    named = named.withColumn("_head", F.conv(F.substring(F.sha2(F.col("_v").cast("binary"), 256), 1, HEAD // 4), 16, 10).cast("long"))
    named = named.withColumn("_leaf", F.when(F.col("_bits") > 0, F.expr(f"shiftright(_head, {HEAD} - _bits)")).otherwise(0))
    leaves = named.groupBy(*keys, "members", "_bits", "_leaf").agg(_hash(F.array_sort(F.collect_list("_v"))).alias("_h"))
    inner = leaves.withColumn("_node", F.shiftright("_leaf", fan)).groupBy(*keys, "members", "_bits", "_node").agg(F.array_sort(F.collect_list(F.struct("_leaf", "_h"))).alias("_l"))
    inner = inner.withColumn("_h", F.when(F.col("_bits") > 0, _hash(F.transform("_l", lambda x: x["_h"]))).otherwise(F.element_at("_l", 1)["_h"]))
    root = inner.groupBy(*keys, "members", "_bits").agg(F.array_sort(F.collect_list(F.struct("_node", "_h"))).alias("_l"))
    digest = F.when(F.col("_bits") > fan, _hash(F.transform("_l", lambda x: x["_h"]))).otherwise(F.element_at("_l", 1)["_h"])
    return root.select(*keys, "members", digest.alias("digest"))
