"""Tape source: newline-framed envelopes, seals, manifests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The closed field sets of the two envelope versions and the allowed values.
FIELDS_V1 = ("connection_epoch", "delivery_index", "kind", "local_counter", "raw_payload", "record_id", "source_cursor", "stream", "venue", "visible_ns")
FIELDS_V2 = (*FIELDS_V1, "envelope_version", "monotonic_ns")
KINDS = ("venue_frame", "control", "fault")
COUNTS = ("delivery_index", "visible_ns", "local_counter")
CHECKED = ("envelope_version", *COUNTS, "monotonic_ns", "record_id", "connection_epoch", "kind", "raw_payload")

CURSOR = "struct<type:string,counter:bigint,last_update_id:bigint,source_time_ms:bigint,first:bigint,last:bigint,previous_last:bigint>"
ENVELOPE = f"""envelope_version int, delivery_index bigint, record_id string, visible_ns bigint, monotonic_ns bigint, venue string, stream string,
  connection_epoch string, local_counter bigint, source_cursor {CURSOR}, kind string, raw_payload string"""
SEAL = """seal_version int, lane_id string, window_start_ns bigint, window_end_ns bigint, data_file string, byte_length bigint, line_count bigint, sha256 string,
  first_delivery_index bigint, last_delivery_index bigint, first_visible_ns bigint, last_visible_ns bigint, visible_non_decreasing boolean,
  delivery_index_dense boolean, segment_id string, segment_index bigint, seal_reason string, ordering_status string, epochs array<string>,
  repaired_bytes bigint, created_ns bigint, writer_version bigint"""


def lane_of(path: Column) -> Column:
    """Lane from a ``lane=`` or ``venue=`` part of the path; anything else is an error."""
    lane = F.regexp_extract(path, r"(?:lane|venue)=([^/]+)/", 1)
    return F.when(lane != "", lane).otherwise(F.raise_error(F.concat(F.lit("no lane in object key "), path)))


def admitted(path: Column) -> Column:
    """Objects that are evidence: sealed segments, seals, metadata, target records; never open or compressed ones."""
    return path.rlike(r"(/|^)(lane|venue)=[^/]+/.*\.(ndjson|seal\.json)$|/metadata/[^/]+/[^/]+\.json$|/target_records_[^/]+\.ndjson$") & ~path.rlike(r"\.(open|zst)$")


def objects(spark: SparkSession, root: str, pattern: str = "*.ndjson") -> DataFrame:
    """(object_key, content, length) of every object under a folder whose name matches."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    base = root.rstrip("/").split("://")[-1].lstrip("/")
    return files.select(F.regexp_replace("path", rf"^[a-z]+:/*{base}/", "").alias("object_key"), "content", "length")


def lines(objects: DataFrame) -> DataFrame:
    """(object_key, line_number, byte_offset, value, torn): lines of each segment, in order.

    A segment is bounded by its writer's rotation, so one row holds it. The last line is
    torn if no newline ends it; it is marked, not dropped. A line is cut off with its newline, so
    nothing but the line itself tells whether it is torn: else every line would carry its segment.
    """
    pieces = F.split(F.decode("content", "UTF-8"), r"(?<=\n)", -1)
    out = objects.select("object_key", F.posexplode(pieces).alias("_i", "_line")).where("_line <> ''")
    from pyspark.sql import Window

    before = Window.partitionBy("object_key").orderBy("_i").rowsBetween(Window.unboundedPreceding, -1)
    torn = ~F.endswith(F.col("_line"), F.lit("\n"))
    return out.select(
        "object_key", (F.col("_i") + 1).cast("long").alias("line_number"), F.coalesce(F.sum(F.octet_length("_line")).over(before), F.lit(0)).alias("byte_offset"),
        F.when(torn, F.col("_line")).otherwise(F.expr("left(_line, length(_line) - 1)")).alias("value"), torn.alias("torn"),
    )


def parsed(lines: DataFrame, value: str = "value") -> DataFrame:
    """Envelope columns, raw_line_sha256 and ``error``: null for a valid line, else what is wrong.

    The field set is closed for each version; counters are non-negative integers and
    never booleans; ids are plain ASCII. A bad line stays as a row with its error.
    """
    v = F.col(value)
    keep = [c for c in lines.columns if c != value]
    # one pass takes every field's text, one the keys and one the typed columns
    read = lines.select("*", F.json_tuple(v, *CHECKED).alias(*(f"_{c}" for c in CHECKED))).withColumn("_keys", F.array_sort(F.json_object_keys(v)))
    keys, text = F.col("_keys"), lambda f: F.col(f"_{f}")
    version = F.coalesce(text("envelope_version").try_cast("int"), F.lit(1))
    wanted = F.when(version == 2, F.array(*map(F.lit, sorted(FIELDS_V2)))).otherwise(F.array(*map(F.lit, sorted(FIELDS_V1))))
    count = lambda f: F.coalesce(text(f).rlike(r"^[0-9]+$") & ~v.rlike(rf'"{f}"\s*:\s*"'), F.lit(False))
    ascii_id = lambda f: F.coalesce(text(f).rlike(r"^[\x21-\x7E]+$"), F.lit(False))
    counts = reduce(lambda a, b: a & b, map(count, COUNTS))
    error = (
        F.when(keys.isNull(), "not_an_object").when(F.size(F.array_distinct(keys)) < F.size(keys), "duplicate_field").when(keys != wanted, "field_set")
        .when(~counts | ((version == 2) & ~count("monotonic_ns")), "counter_type").when(~(ascii_id("record_id") & ascii_id("connection_epoch")), "id_not_ascii")
        .when(~text("kind").isin(*KINDS), "kind")
    )
    out = read.withColumn("error", error).withColumn("_e", F.from_json(v, ENVELOPE, {"mode": "PERMISSIVE"}))
    return out.select(*keep, "_e.*", F.sha2(v.cast("binary"), 256).alias("raw_line_sha256"), F.sha2(text("raw_payload").cast("binary"), 256).alias("content_sha256"), "error")


def manifest(objects: DataFrame) -> DataFrame:
    """(object_key, sha256, length) of every object."""
    return objects.select("object_key", F.sha2("content", 256).alias("sha256"), F.col("length").cast("long").alias("length"))


def dataset_hash(manifest: DataFrame) -> DataFrame:
    """One row: the hash of the sorted manifest, whatever order it was read in."""
    entry = F.concat_ws(" ", "object_key", "sha256", "length")
    return manifest.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(entry)), "\n").cast("binary"), 256).alias("dataset_sha256"), F.count(F.lit(1)).alias("objects"), F.sum("length").alias("bytes"))


def composite(*sources: DataFrame, key: str = "object_key") -> DataFrame:
    """Union of disjoint sources; ``duplicated`` marks keys that two of them hold."""
    from pyspark.sql import Window

    everything = reduce(DataFrame.unionByName, sources)
    return everything.withColumn("duplicated", F.count(F.lit(1)).over(Window.partitionBy(key)) > 1)


def seals(spark: SparkSession, root: str) -> DataFrame:
    files = spark.read.schema(SEAL).option("multiLine", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.seal.json").json(root)
    base = root.rstrip("/").split("://")[-1].lstrip("/")
    return files.withColumn("object_key", F.regexp_replace(F.regexp_replace("_metadata.file_path", rf"^[a-z]+:/*{base}/", ""), r"\.seal\.json$", ".ndjson"))


def sealed_segments(segments: DataFrame, seals: DataFrame) -> DataFrame:
    """Segments whose seal exists."""
    return segments.join(seals.select("object_key"), "object_key", "left_semi")


def verify_seals(segments: DataFrame, seals: DataFrame) -> DataFrame:
    """Every segment and every seal with a status: the first check that fails, or sealed.

    Spark's file sources pass over empty objects, so a seal of no bytes stands for its own.
    """
    s = seals.select("object_key", F.col("sha256").alias("_sha"), F.col("byte_length").alias("_len"), F.col("line_count").alias("_lines"), F.lit(True).alias("_seal"))
    status = (
        F.when(F.col("_seal").isNull(), "unsealed").when(F.col("sha256").isNull(), F.when(F.col("_len") == 0, "empty_but_sealed").otherwise("absent")).when(F.col("length") != F.col("_len"), "length_mismatch")
        .when(F.col("sha256") != F.col("_sha"), "digest_mismatch").when(F.col("_lines") == 0, "empty_but_sealed").otherwise("sealed")
    )
    return segments.join(s, "object_key", "full").select("object_key", status.alias("status"))


def validated_segments(manifest: DataFrame, seals: DataFrame, envelopes: DataFrame) -> DataFrame:
    """Each sealed segment with all faults that its bytes and records show against its seal."""
    facts = envelopes.groupBy("object_key").agg(
        F.count(F.lit(1)).alias("_lines"), F.min("delivery_index").alias("_d0"), F.max("delivery_index").alias("_d1"), F.min("visible_ns").alias("_v0"), F.max("visible_ns").alias("_v1"), F.bool_or("torn").alias("_torn"),
    )
    joined = seals.join(manifest.select("object_key", F.col("sha256").alias("_sha"), "length"), "object_key", "left").join(facts, "object_key", "left")
    n = F.coalesce("_lines", F.lit(0))
    fault = lambda test, name: F.when(F.coalesce(test, F.lit(False)), F.lit(name))
    faults = F.array_compact(F.array(
        fault(F.col("_sha").isNull() & (F.col("byte_length") > 0), "absent"), fault(F.col("length") != F.col("byte_length"), "length"), fault(F.col("_sha") != F.col("sha256"), "sha256"), fault(n != F.col("line_count"), "line_count"), fault(F.col("_torn"), "torn_tail"),
        fault(~F.col("first_delivery_index").eqNullSafe(F.col("_d0")) | ~F.col("last_delivery_index").eqNullSafe(F.col("_d1")), "delivery_bounds"),
        fault(~F.col("first_visible_ns").eqNullSafe(F.col("_v0")) | ~F.col("last_visible_ns").eqNullSafe(F.col("_v1")), "visible_bounds"),
        fault((F.col("_v0") < F.col("window_start_ns")) | (F.col("_v1") >= F.col("window_end_ns")), "outside_window"),
    ))
    return joined.select("object_key", "lane_id", "window_start_ns", faults.alias("faults"), (F.size(faults) == 0).alias("valid"))


def late_segments(segments: DataFrame, receipts: DataFrame, keys: tuple[str, ...] = ("lane_id", "data_file", "segment_index", "sha256")) -> DataFrame:
    """Segments that no committed receipt names: reported apart, never merged."""
    return segments.join(receipts.select(*keys), list(keys), "left_anti")


def window_receipts(windows: DataFrame, expected: DataFrame) -> DataFrame:
    """Per window: expected lanes that are present and valid, missing, invalid, and lanes not expected.

    ``windows`` (window_start_ns, lane_id, valid), ``expected`` (lane_id). Complete means
    all expected lanes are valid.
    """
    known = expected.select("lane_id", F.lit(True).alias("_expected"))
    lanes = windows.groupBy("window_start_ns", "lane_id").agg(F.bool_and("valid").alias("valid")).join(known, "lane_id", "left")
    total = expected.agg(F.count(F.lit(1)).alias("_total"))
    names = lambda test: F.array_sort(F.collect_set(F.when(test, F.col("lane_id"))))
    exp = F.coalesce("_expected", F.lit(False))
    out = lanes.groupBy("window_start_ns").agg(names(exp & F.col("valid")).alias("present"), names(~F.col("valid")).alias("invalid"), names(~exp).alias("unexpected"))
    return out.join(F.broadcast(total)).withColumn("complete", F.size("present") == F.col("_total")).drop("_total")
