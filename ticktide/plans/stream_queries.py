"""Registered streaming queries: each runs a stream over the given table to its end; the oracle is the batch SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import epoch_micros
from ..sources.scratch import materialize, shared_dir
from ..streaming import commits, sessions, windows
from . import tape_queries
from .tape_queries import TAPE_SQL

QUERIES, ORACLES = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that all machines share."""
    return f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    # a file source reads folders: the table's file is found by its name in its folder
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").option("maxFilesPerTrigger", 1).parquet(sf_dir) if not _is_folder(spark, path) else spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).parquet(path)


def _is_folder(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def drained(df: DataFrame, mode: str = "append", keys: list[str] | None = None, path: str | None = None) -> DataFrame:
    """Run the stream to its present end into a table and read it; in update mode the last row of a key counts.

    With the ``path`` of an earlier run the stream goes on from that run's checkpoint; each batch
    has a folder of its own, so a batch that is run again replaces its own rows.
    """
    spark, path = df.sparkSession, path or scratch(df.sparkSession)

    def write(batch: DataFrame, no: int) -> None:
        batch.withColumn("_batch", F.lit(no)).write.mode("overwrite").parquet(f"{path}/out/batch={no}")

    windows.to_tables(df, write, f"{path}/checkpoint", mode)
    out = spark.read.parquet(f"{path}/out").drop("batch")
    if mode == "update":
        best = out.groupBy(*keys).agg(F.max(F.struct("_batch", *(c for c in df.columns if c not in keys))).alias("_v"))
        return best.select(*keys, *(F.col(f"_v.{c}").alias(c) for c in df.columns if c not in keys))
    return out.select(*df.columns)


def in_parts(table: DataFrame, order: str, parts: int, step: int = 1, offset: int = 0) -> DataFrame:
    """The table with ``_part``: equal spans of ``order``, cut at multiples of ``step`` plus ``offset``."""
    span = table.agg(F.min(order).alias("_lo"), F.max(order).alias("_hi"))
    cell = F.floor((F.col(order) - offset) / step)
    low, high = (F.floor((F.col(c) - offset) / step) for c in ("_lo", "_hi"))
    return table.crossJoin(F.broadcast(span)).withColumn("_part", F.floor((cell - low) * parts / (high - low + 1)).cast("int")).drop("_lo", "_hi")  # one row


def arriving(table: DataFrame, parts: int, run: Callable[[DataFrame, str], None]) -> None:
    """``run`` a stream to its end, and anew on its checkpoint, after each part of a table with ``_part`` arrived."""
    spark = table.sparkSession
    source, path = scratch(spark), scratch(spark)
    table = materialize(table, "arriving")
    rows = table.drop("_part")
    for i in range(parts):
        table.where(F.col("_part") == i).drop("_part").write.mode("append").parquet(source)
        run(spark.readStream.schema(rows.schema).parquet(source), path)


def resumed(table: DataFrame, order: str, transform: Callable[[DataFrame], DataFrame], parts: int = 3, step: int = 1, offset: int = 0) -> DataFrame:
    """A table as a stream that arrives in ``parts``, in order: after each the query ends, and is started anew on its checkpoint."""
    out = []
    arriving(in_parts(table, order, parts, step, offset), parts, lambda source, path: out.append(drained(transform(source), path=path)))
    return out[-1]


@query(f"WITH {TAPE_SQL} SELECT user_id, lane, min(at_us) AS first_seen, min(CASE WHEN k > 50 THEN at_us - 1000 END) AS created_at FROM tape GROUP BY user_id, lane")
def stream_first_sighting(spark, sf_dir):
    e = stream(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("lane"), epoch_micros("ts").alias("at_us"), F.get_json_object("props", "$.k").cast("int").alias("k"))
    e = e.withColumn("created", F.when(F.col("k") > 50, F.col("at_us") - 1000))
    return drained(windows.first_sightings(e, ["user_id", "lane"], "at_us", "created"), "update", ["user_id", "lane"])


#: How far out of order a source may be. Later rows belong to ``windows.split_late``.
DISORDER = "31 days"


@query("SELECT epoch_us(time_bucket(INTERVAL 30 MINUTE, ts)) AS window_start, event_type AS lane, count(*) AS n FROM events GROUP BY 1, 2")
def stream_windows(spark, sf_dir):
    e = stream(spark, sf_dir, "events").select(F.timestamp_micros(epoch_micros("ts")).alias("ts"), F.col("event_type").alias("lane"), "value")
    counted = windows.window_counts(e, "ts", ["lane"], "30 minutes", DISORDER).select(F.unix_micros("window_start").alias("window_start"), "lane", "n")
    return drained(counted, "update", ["window_start", "lane"])


@query(tape_queries.ORACLES["continuity_causes"])
def stream_continuity(spark, sf_dir):
    windows.use_rocksdb(spark)
    causes = lambda source: windows.stateful(source, "user_id", windows.Continuity(), windows.CONTINUITY)
    return resumed(tape_queries.cursors(spark, sf_dir), "event_id", causes).select("event_id", "user_id", "cause")


@query(tape_queries.ORACLES["book_states"])
def stream_books(spark, sf_dir):
    windows.use_rocksdb(spark)
    books = lambda source: windows.stateful(source, "asset", windows.Books(), windows.BOOKS)
    out = resumed(tape_queries.book_events(spark, sf_dir).withColumnRenamed("user_id", "asset"), "pos", books).where("levels > 0")
    return out.select(F.col("asset").alias("user_id"), "pos", "levels", F.round("depth", 4).alias("depth"), "best")


def delivered_cursors(spark, sf_dir):
    """Cursors with the props of their event, some delivered again right after, some of those changed; seq is dense but for what the tape lacks."""
    c = F.col
    cursors = tape_queries.cursors(spark, sf_dir).join(tape_queries.tape(spark, sf_dir).select("event_id", "props", F.timestamp_micros("at_us").alias("at")), "event_id")
    again = cursors.where("event_id % 101 = 0").withColumn("props", F.when(c("event_id") % 202 == 0, F.concat("props", F.lit("!"))).otherwise(c("props"))).withColumn("seq", c("event_id") * 2 + 1)
    both = cursors.withColumn("seq", c("event_id") * 2).unionByName(again)
    return both.select(c("user_id").alias("epoch"), "seq", "at", c("event_id").alias("record"), F.sha2("props", 256).alias("content"), "counter", "kind", "first", "last", "previous")


def judged_deliveries(spark, sf_dir):
    """Four parts, so three restarts; cuts fall between the two deliveries of a record."""
    windows.use_rocksdb(spark)
    return resumed(delivered_cursors(spark, sf_dir), "seq", lambda source: sessions.deliveries(source, DISORDER), parts=4, step=202, offset=1)


@query(f"""WITH {TAPE_SQL}, d AS (SELECT event_id, props, event_id * 2 AS seq FROM tape WHERE event_id % 89 <> 0 UNION ALL SELECT event_id, CASE WHEN event_id % 202 = 0 THEN concat(props, '!') ELSE props END, event_id * 2 + 1 FROM tape WHERE event_id % 89 <> 0 AND event_id % 101 = 0)
SELECT seq, event_id AS record, CASE WHEN row_number() OVER w = 1 THEN 'unseen' WHEN props = first_value(props) OVER w THEN 'duplicate' ELSE 'conflict' END AS verdict FROM d WINDOW w AS (PARTITION BY event_id ORDER BY seq)""")
def stream_identity(spark, sf_dir):
    return judged_deliveries(spark, sf_dir).select("seq", "record", "verdict")


@query(tape_queries.ORACLES["epoch_health"])
def stream_health(spark, sf_dir):
    last = judged_deliveries(spark, sf_dir).groupBy(F.col("epoch").alias("user_id")).agg(F.max_by(F.struct("frames", "gaps", "backwards", "breaks", "health"), "seq").alias("v"))
    return last.select("user_id", "v.*")


@query(f"""WITH {TAPE_SQL}, w AS (SELECT (at_us // 1800000000) * 1800000000 AS window_start, count(DISTINCT lane) AS valid_lanes FROM tape GROUP BY 1), m AS (SELECT max(window_start) AS mx FROM w), s AS (SELECT window_start, valid_lanes, CASE WHEN mx < window_start + 1800000000 THEN 'open' WHEN valid_lanes >= 3 THEN 'complete' WHEN mx < window_start + 2100000000 + 86400000000 THEN 'waiting' ELSE 'incomplete' END AS state FROM w, m),
b AS (SELECT *, bool_and(state IN ('complete', 'incomplete')) OVER (ORDER BY window_start) AS commits FROM s) SELECT window_start, valid_lanes, state FROM b WHERE commits""")
def stream_commit_barrier(spark, sf_dir):
    windows.use_rocksdb(spark)
    t = tape_queries.tape(spark, sf_dir).select(windows.capture_window(F.col("at_us")).alias("window_start"), "lane").distinct()
    receipts = t.select(F.lit("tape").alias("tape"), "lane", "window_start", F.timestamp_micros("window_start").alias("at"))
    barrier = lambda source: sessions.committed_windows(source, 3, 1_800_000_000, 300_000_000 + 86_400_000_000)
    return resumed(receipts, "window_start", barrier, step=1_800_000_000).select("window_start", "valid_lanes", "state")


@query(f"""WITH {TAPE_SQL}, d AS (SELECT event_id, lane, at_us, props, event_id * 2 AS seq FROM tape UNION ALL SELECT event_id, lane, at_us, CASE WHEN event_id % 202 = 0 THEN concat(props, '!') ELSE props END, event_id * 2 + 1 FROM tape WHERE event_id % 101 = 0),
v AS (SELECT *, row_number() OVER w AS r, props = first_value(props) OVER w AS same FROM d WINDOW w AS (PARTITION BY event_id ORDER BY seq))
SELECT event_id, seq, 'fact' AS kind, row_number() OVER (ORDER BY at_us, lane, event_id) AS canonical_seq FROM v WHERE r = 1 UNION ALL SELECT event_id, seq, CASE WHEN same THEN 'duplicate' ELSE 'conflict' END, NULL FROM v WHERE r > 1""")
def stream_canonical(spark, sf_dir):
    t = tape_queries.delivered(spark, sf_dir).select("event_id", "lane", "at_us", "props", "seq")
    store = commits.TableSet(spark, scratch(spark))

    def run(source: DataFrame, path: str) -> None:
        windows.to_tables(source, lambda batch, no: commits.canonical_batch(store, batch, no, "event_id", "props", "seq", ["at_us", "lane", "event_id"]), f"{path}/checkpoint")

    arriving(in_parts(t, "at_us", 3), 3, run)
    facts = store.read("facts").select("event_id", "seq", F.lit("fact").alias("kind"), "canonical_seq")
    return facts.unionByName(store.read("repeats").select("event_id", "seq", F.col("verdict").alias("kind"), F.lit(None).cast("long").alias("canonical_seq")))
