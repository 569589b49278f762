"""Total order, continuity and identity of a tape."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialize
from .scan import Ranges

UNKNOWN_RANK = 1000


def ranked(tape: DataFrame, ranks: DataFrame, lane: str = "lane") -> DataFrame:
    """Add lane_rank from a small table (lane, lane_rank); unknown lanes rank last."""
    return tape.join(ranks, lane, "left").withColumn("lane_rank", F.coalesce("lane_rank", F.lit(UNKNOWN_RANK)))


def dense_sequence(df: DataFrame, order: list[str], out: str = "seq", start: int = 1, partitions: int | None = None) -> DataFrame:
    """Number all rows densely in a total order, without one task seeing them all.

    Rows are dealt by ranges of ``order``, sorted, and written once with their range and their place
    in it; all that follows reads that table, so the ranges can't be drawn anew. The
    sizes of the ranges before (one row a range) are added. Rows of equal order are
    numbered in any order.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the id of a row is its partition's number, shifted by 33 bits, plus its place in the partition
    dealt = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    dealt = materialize(dealt.withColumn("_part", F.shiftright("_id", 33)).withColumn("_n", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).drop("_id"), "dealt")
    sizes = dealt.groupBy("_part").agg((F.max("_n") + 1).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    return dealt.join(F.broadcast(sizes), "_part").withColumn(out, (F.col("_before") + F.col("_n") + start).cast("long")).drop("_part", "_n", "_before")


#: Width of the ranges of a counter in which rows are compared; a key's ranges lie in many tasks.
RANGE = 65_536


def _before(df: DataFrame, keys: list[str], order: list[str], value: Column, out: str, width: int, running: bool = False) -> DataFrame:
    """Add ``out``: the value of the row before per key, or with ``running`` the greatest of all before.

    The first of ``order`` is a number; its ranges of ``width`` are windows of their own, so
    a key with a third of all rows is no single task. Each range hands one row on to
    those after it.
    """
    df = df.withColumn("_range", F.floor(F.col(order[0]) / width)).withColumn("_value", F.struct(value.alias("v")))
    inside = Window.partitionBy(*keys, "_range").orderBy(*order)
    if running:
        own = F.max("_value").over(inside.rowsBetween(Window.unboundedPreceding, -1))
        edge = F.max("_value")
    else:
        own, edge = F.lag("_value").over(inside), F.max_by("_value", F.struct(*order))
    edges = df.groupBy(*keys, "_range").agg(edge.alias("_edge"))
    ranges = Window.partitionBy(*keys).orderBy("_range")
    handed = F.max("_edge").over(ranges.rowsBetween(Window.unboundedPreceding, -1)) if running else F.lag("_edge").over(ranges)
    edges = edges.withColumn("_handed", handed).drop("_edge")
    on = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in (*keys, "_range")]
    joined = df.withColumn("_own", own).alias("l").join(edges.alias("r"), on, "left").select("l.*", "_handed")
    both = F.greatest("_own", "_handed") if running else F.coalesce("_own", "_handed")
    return joined.withColumn(out, both["v"]).drop("_range", "_value", "_own", "_handed")


def dense_breaks(df: DataFrame, keys: list[str], counter: str, width: int = RANGE) -> DataFrame:
    """Rows whose counter isn't the one before plus one, per key: expected and found."""
    out = _before(df, keys, [counter], F.col(counter), "expected", width).withColumn("expected", F.col("expected") + 1)
    return out.where(F.col("expected").isNotNull() & (F.col(counter) != F.col("expected")))


def regressions(df: DataFrame, keys: list[str], order: list[str], clock: str, width: int = RANGE) -> DataFrame:
    """Rows whose clock is before that of the row before, per key; the first of ``order`` is a counter."""
    return _before(df, keys, order, F.col(clock), "previous", width).where(F.col(clock) < F.col("previous"))


def version_regressions(df: DataFrame, keys: list[str], order: list[str], version: str, width: int = RANGE) -> DataFrame:
    """Rows whose version is below the greatest before; equal is fine. The first of ``order`` is a counter."""
    return _before(df, keys, order, F.col(version), "highest", width, running=True).where(F.col(version) < F.col("highest"))


def identity_verdict(df: DataFrame, scope: list[str], record: str, content: str, seq: str) -> DataFrame:
    """Add verdict: unseen, duplicate or conflict with the first observation of the record."""
    w = Window.partitionBy(*scope, record).orderBy(seq)
    return df.withColumn("verdict", F.when(F.row_number().over(w) == 1, "unseen").when(F.col(content) == F.first(content).over(w), "duplicate").otherwise("conflict"))


def continuity_causes(df: DataFrame, keys: list[str], seq: str, counter: str, kind: str, first: str, last: str, previous: str) -> DataFrame:
    """Add cause, tests in this order: local break, lifecycle, bootstrap, unsequenced, backwards, gap, continuous.

    Duplicates must be gone before. ``kind`` is lifecycle, snapshot, unsequenced or range;
    a range is continuous if its ``previous`` is the greatest last seen before this row.
    """
    seen = F.when(F.col(kind) == "lifecycle", None).otherwise(F.col(last))
    df = Ranges(df, keys, [seq]).add(_seen=("max_before", seen), _before=("previous", F.col(counter))).rows()
    cause = (
        F.when(F.col("_before").isNotNull() & (F.col(counter) != F.col("_before") + 1), "local_break")
        .when(F.col(kind) == "lifecycle", "lifecycle")
        .when(F.col(kind) == "unsequenced", "unsequenced")
        .when(F.col("_seen").isNull() | (F.col(kind) == "snapshot"), "bootstrap")
        .when(F.col(last) <= F.col("_seen"), "backwards")
        .when(F.coalesce(F.col(previous), F.col(first) - 1) > F.col("_seen"), "gap_proven")
        .otherwise("continuous")
    )
    return df.withColumn("cause", cause).drop("_seen", "_before")


def epoch_health(causes: DataFrame, keys: list[str]) -> DataFrame:
    """Per epoch: counts of causes and health. Stale absorbs; a frame beyond lifecycle makes it healthy."""
    count = lambda c: F.count_if(F.col("cause") == c)
    out = causes.groupBy(*keys).agg(
        F.count_if(F.col("cause") != "lifecycle").alias("frames"), count("gap_proven").alias("gaps"),
        count("backwards").alias("backwards"), count("local_break").alias("breaks"),
    )
    stale = (F.col("gaps") > 0) | (F.col("backwards") > 0) | (F.col("breaks") > 0)
    return out.withColumn("health", F.when(stale, "stale").when(F.col("frames") > 0, "healthy").otherwise("awaiting_bootstrap"))


def lane_authority(df: DataFrame, keys: list[str], epoch: str, seq: str) -> DataFrame:
    """Per key: the epoch of the last row, and the sequence from which it has owned the key."""
    w = Window.partitionBy(*keys).orderBy(seq)
    marked = df.withColumn("_new", F.lag(epoch).over(w).isNull() | (F.lag(epoch).over(w) != F.col(epoch)))
    return marked.where("_new").groupBy(*keys).agg(F.max_by(epoch, seq).alias("owner"), F.max(seq).alias("since"))


def tie_groups(df: DataFrame, clock: str, lane: str) -> DataFrame:
    """Add tie: the clock value shared by two lanes or more, else null."""
    w = Window.partitionBy(clock)
    return df.withColumn("tie", F.when(F.min(lane).over(w) != F.max(lane).over(w), F.col(clock)))


def clock_choice(tape: DataFrame) -> DataFrame:
    """One row: monotonic if all rows have it and one comparable scope, else visible."""
    return tape.agg(F.when(F.bool_and(F.col("monotonic_ns").isNotNull()) & F.bool_and("comparable") & (F.count_distinct("scope_id") == 1), "monotonic").otherwise("visible").alias("clock"))


def last_before(df: DataFrame, keys: list[str], order: list[str], value: str, present: Column, out: str) -> DataFrame:
    """Add the value of the last row before or at this one where ``present``; a null there resets it."""
    found = Ranges(df, keys, order).add(_found=("last", F.when(present, F.struct(F.col(value).alias("v"))))).rows()
    return found.withColumn(out, F.col("_found.v")).drop("_found")


def cursor_breaks(df: DataFrame, keys: list[str], order: list[str], last: str, previous: str, moves: Column) -> DataFrame:
    """Rows whose ``previous`` isn't the ``last`` of the row before that moves the cursor."""
    return Ranges(df, keys, order).add(held=("last_before", F.when(moves, F.col(last)))).rows().where(F.col("held").isNotNull() & F.col(previous).isNotNull() & (F.col(previous) != F.col("held")))


def fifo_pairs(df: DataFrame, keys: list[str], side: str, sides: tuple[str, str], order: list[str]) -> DataFrame:
    """k-th row of one side with the k-th of the other, per key. Columns get suffixes _a and _b."""
    w = Window.partitionBy(*keys, side).orderBy(*order)
    numbered = df.withColumn("_k", F.row_number().over(w))
    part = lambda s, x: numbered.where(F.col(side) == s).drop(side).select(*keys, "_k", *(F.col(c).alias(f"{c}_{x}") for c in df.columns if c not in {*keys, side}))
    return part(sides[0], "a").join(part(sides[1], "b"), [*keys, "_k"]).withColumnRenamed("_k", "pair_no")


def first_of_each(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row a key, the first, with the number of deliveries."""
    packed = F.struct(*order, *(c for c in df.columns if c not in {key, *order}))
    out = df.groupBy(key).agg(F.min(packed).alias("_f"), F.count(F.lit(1)).alias("deliveries"))
    return out.select(key, "_f.*", "deliveries")


def new_rows(incoming: DataFrame, stored: DataFrame, fingerprint: str) -> DataFrame:
    """Incoming rows not stored yet, each fingerprint once."""
    return incoming.join(stored.select(fingerprint), fingerprint, "left_anti").dropDuplicates([fingerprint])


def lane_contiguity(seals: DataFrame, lane: str, order: str, first: str, last: str) -> DataFrame:
    """Segments whose first index isn't the previous segment's last plus one; empty segments are passed over."""
    w = Window.partitionBy(lane).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return seals.withColumn("expected", F.last(last, ignorenulls=True).over(w) + 1).where(F.col(first).isNotNull() & (F.col(first) != F.col("expected")))


def merged(lanes: list[DataFrame], order: list[str]) -> DataFrame:
    """Ordered union of lanes: ranges of the order, each sorted."""
    everything = reduce(DataFrame.unionByName, lanes)
    return everything.repartitionByRange(*order).sortWithinPartitions(*order)


def integrity(df: DataFrame, content: str, stored_hash: str, seq: str) -> DataFrame:
    """One row: stored hashes that don't recompute, and whether the sequence is dense from its first."""
    return df.agg(
        F.count_if(F.sha2(F.col(content).cast("binary"), 256) != F.col(stored_hash)).alias("hash_mismatches"),
        ((F.max(seq) - F.min(seq) + 1 == F.count(F.lit(1))) & (F.count_distinct(seq) == F.count(F.lit(1)))).alias("dense"),
    )
