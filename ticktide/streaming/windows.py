"""Streaming: capture windows, late data, first sightings, stateful continuity and books."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def capture_window(at_us: Column, period_s: int = 1800) -> Column:
    """Start (microseconds) of the UTC-aligned window; the period must divide a day."""
    if 86400 % period_s:
        raise ValueError("the period must divide a day")
    width = period_s * 1_000_000
    return F.floor(at_us / width) * width


def window_counts(events: DataFrame, at: str, keys: list[str], width: str, delay: str) -> DataFrame:
    """Rows per tumbling window and key, batch or stream. Late rows are for ``split_late`` to report first."""
    source = events.withWatermark(at, delay) if events.isStreaming else events
    return source.groupBy(F.window(at, width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), *keys, "n", "total")


def eligibility(windows: DataFrame, expected: int, period_us: int, now_us: int, deadline_us: int = 300_000_000) -> DataFrame:
    """state of each window: open, complete, waiting (before its deadline) or incomplete."""
    end = F.col("window_start") + period_us
    state = F.when(F.lit(now_us) < end, "open").when(F.col("valid_lanes") >= expected, "complete").when(F.lit(now_us) < end + deadline_us, "waiting").otherwise("incomplete")
    return windows.withColumn("state", state)


def commit_barrier(windows: DataFrame, order: str = "window_start") -> DataFrame:
    """A window may commit only if it and all before it are ready: one row a window."""
    ready = F.col("state").isin("complete", "incomplete")
    return windows.withColumn("commits", F.bool_and(ready).over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))


def absent_windows(present: DataFrame, start: str, period: int, upto: int, most: int = 10_000) -> DataFrame:
    """Windows between the first present one and ``upto`` that have no row; more than ``most`` is an error."""
    span = present.agg(F.min(start).alias("a"))
    n = F.floor((F.lit(upto) - F.col("a")) / period)
    checked = F.when(n > most, F.raise_error(F.lit("too many absent windows")).cast("bigint")).otherwise(n)
    every = span.where("a IS NOT NULL").select(F.explode(F.sequence(F.lit(0).cast("bigint"), checked - 1)).alias("i"), "a").select((F.col("a") + F.col("i") * period).alias(start))
    return every.join(present.select(start), start, "left_anti")


def split_late(batch: DataFrame, committed: DataFrame, window: str) -> tuple[DataFrame, DataFrame]:
    """(rows of open windows, rows of committed windows). The second are reported, never merged."""
    return batch.join(committed.select(window), window, "left_anti"), batch.join(committed.select(window), window, "left_semi")


def first_sightings(rows: DataFrame, keys: list[str], seen: str, created: str) -> DataFrame:
    """Per key: earliest sighting and earliest known creation. Runs as a batch or in update mode."""
    return rows.groupBy(*keys).agg(F.min(seen).alias("first_seen"), F.min(created).alias("created_at"))


def merge_sightings(ledger: DataFrame, more: DataFrame, keys: list[str]) -> DataFrame:
    """Ledger and new sightings: times can only get earlier, unknown creation is filled in."""
    return ledger.unionByName(more).groupBy(*keys).agg(F.min("first_seen").alias("first_seen"), F.min("created_at").alias("created_at"))


def carry_forward(new: DataFrame, previous: DataFrame, venue: str, asset: str, failed: str) -> DataFrame:
    """Targets per venue: the new ones, or all previous ones if any entry of the venue failed."""
    bad = new.groupBy(venue).agg(F.bool_or(failed).alias("_bad"))
    fresh = new.join(bad, venue).where("NOT _bad").select(venue, asset)
    kept = previous.join(bad.where("NOT _bad").select(venue), venue, "left_anti").select(venue, asset)
    return fresh.unionByName(kept).where(F.col(asset).isNotNull()).dropDuplicates([venue, asset])


def to_tables(stream: DataFrame, on_batch: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> Any:
    """Run a stream to its present end; each batch goes to ``on_batch``, the checkpoint makes it resumable."""
    query = stream.writeStream.outputMode(mode).foreachBatch(on_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


CONTINUITY = "user_id long, event_id long, cause string"


class Continuity(StatefulProcessor):
    """Cause of every delivery of one epoch, given in order of event_id (the batch form is continuity_causes).

    State per key: last counter and greatest cursor seen, a row of fixed size, read and written once a trigger.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("seen", "counter long, last long")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        counter, last = self.state.get() or (None, None)
        out = Row("user_id", "event_id", "cause")
        for r in sorted(rows, key=lambda r: r.event_id):
            c, kind, end = r.counter, r.kind, r.last
            if counter is not None and c != counter + 1:
                cause = "local_break"
            elif kind in ("lifecycle", "unsequenced"):
                cause = kind
            elif last is None or kind == "snapshot":
                cause = "bootstrap"
            elif end <= last:
                cause = "backwards"
            else:
                cause = "gap_proven" if (r.first - 1 if r.previous is None else r.previous) > last else "continuous"
            if kind != "lifecycle" and end is not None:
                last = end if last is None else max(last, end)
            counter = c
            yield out(key[0], r.event_id, cause)
        self.state.update((counter, last))

    def close(self) -> None:
        pass


class Books(StatefulProcessor):
    """Book of one asset folded delta by delta: emits best price and depth after each position.

    State: prices and sizes, as long as the ladder, in one value that is read and written once a
    trigger; a map would be a message to the JVM a level. Nothing is kept before the first book.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ladder = handle.getValueState("ladder", "prices array<double>, sizes array<double>")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        held = self.ladder.get()
        live, book = held is not None, dict(zip(*held, strict=True)) if held else {}
        out = Row("asset", "pos", "levels", "depth", "best")
        for pos, group in groupby(sorted(rows, key=lambda r: (r.pos, r.price is None, r.price or 0.0)), key=lambda r: r.pos):
            levels = list(group)
            if any(r.kind == "book" for r in levels):
                book, live = {}, True
            if not live:
                continue
            for r in levels:
                if r.size is not None and r.size > 0:
                    book[r.price] = r.size
                else:
                    book.pop(r.price, None)
            yield out(key[0], pos, len(book), sum(book.values(), 0.0), min((p for p in book if p is not None), default=None))
        if live:
            self.ladder.update((list(book), list(book.values())))

    def close(self) -> None:
        pass


BOOKS = "asset long, pos long, levels long, depth double, best double"


def stateful(stream: DataFrame, key: str, processor: StatefulProcessor, schema: str) -> DataFrame:
    """One of the processors over a stream, keyed; needs the RocksDB state store.

    A key has few rows a trigger, so they are rows and not frames: two frames a key cost more than its work.
    """
    return stream.groupBy(key).transformWithState(processor, outputStructType=schema, outputMode="append", timeMode="none")


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
