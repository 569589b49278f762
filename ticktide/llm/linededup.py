"""Line dedup: repeated runs of lines, found by distributed prefix doubling.

The corpus is a sequence of line ids, document after document. The suffix array over it is
built by doubling: level k names the blocks of 2^k lines from the names of two blocks of
half that length. A block whose name is unique is left out of all further levels, and no
level goes deeper than the runs asked for. The suffixes that share a name form the
longest-common-prefix intervals; in each, all copies but the first are deleted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import forget, materialize, set_aside

#: Words of a repeated run from which on its later copies are deleted.
MIN_WORDS = 50
_LINES = "_row long, _pos struct<doc:{kind}, row:long, n:int>, n int, hi long, lo long, top int, starts array<int>, lengths array<int>"


def windows(words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, length) of the shortest runs of ``least`` words or more that begin or end at each line.

    Every run of that many words is the union of such windows, so a run is repeated where
    its windows are: longer runs need no deeper level.
    """
    n = len(words)
    total = np.concatenate(([0], np.cumsum(words)))
    line = np.arange(n)
    end = np.searchsorted(total, total[:-1] + least, "left")  # first end that reaches it
    right = np.stack((line, end - line), 1)[end <= n]
    begin = np.searchsorted(total, total[1:] - least, "right") - 1  # last begin that reaches it
    left = np.stack((begin, line + 1 - begin), 1)[(begin >= 0) & (total[1:] >= least)]
    both = np.unique(np.concatenate((right, left)), axis=0) if len(right) or len(left) else np.zeros((0, 2), np.int64)
    return both[:, 0], both[:, 1]


def _lines(docs: DataFrame, key: str, text: str, least: int) -> DataFrame:
    """One row per line that some window holds: its id, its deepest level, its windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            for k, row, t in zip(batch.column("_k").to_pylist(), batch.column("_row").to_pylist(), batch.column("_t").to_pylist(), strict=True):
                lines = (t or "").encode().split(b"\n")
                words = np.fromiter((len(x.split()) for x in lines), np.int64, len(lines))
                start, length = windows(words, least)
                if not len(start):
                    continue
                reach = np.zeros(len(lines), np.int64)
                np.maximum.at(reach, start, start + length)
                reach = np.maximum.accumulate(reach) - np.arange(len(lines))
                first = np.searchsorted(start, np.arange(len(lines) + 1))
                for n in np.flatnonzero(reach > 0).tolist():
                    h = xxhash.xxh3_128_intdigest(lines[n])
                    hi, lo = h >> 64, h & (2**64 - 1)
                    a, b = first[n], first[n + 1]
                    for c, v in zip(out, (row, {"doc": k, "row": row, "n": n}, n, hi - (hi >> 63 << 64), lo - (lo >> 63 << 64), int(reach[n]).bit_length() - 1, start[a:b].tolist(), length[a:b].tolist()), strict=True):
                        c.append(v)
            kinds = [pa.int64(), pa.struct([("doc", batch.schema.field("_k").type), ("row", pa.int64()), ("n", pa.int32())]), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=["_row", "_pos", "n", "hi", "lo", "top", "starts", "lengths"])

    src = docs.select("_row", docs[key].alias("_k"), docs[text].alias("_t"))
    return src.mapInArrow(run, _LINES.format(kind=docs.schema[key].dataType.simpleString()))


def _name(*parts: Column) -> tuple[Column, Column]:
    return F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts)


def _shared(named: DataFrame, *columns: str) -> DataFrame:
    """The ``columns`` and ``first`` of rows whose name (hi, lo) occurs twice or more: a level's intervals.

    An interval is counted and its first position found by partial aggregation; that table is written, so
    the join back meets two plain tables, of which adaptive execution can split the rows of a hot name.
    """
    groups = named.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("copies"), F.min("_pos").alias("first")).where("copies > 1").select("hi", "lo", "first")
    groups = materialize(groups, "groups")
    out = materialize(named.join(groups.hint("merge"), ["hi", "lo"]).select(*columns, "hi", "lo", "first"), "level")
    forget(groups)
    return out


def later_copies(docs: DataFrame, key: str, text: str, min_words: int) -> DataFrame:
    """(_row, start, length): windows of lines of which an earlier copy exists.

    Earlier means: a smaller key (null first), then a smaller row number, then a smaller
    line number. ``docs`` is a materialised table with the row number ``_row``. In each level
    the blocks to be doubled and the windows of about their length are named together, from
    the names of the two blocks that begin and end them.
    """
    lines = materialize(_lines(docs, key, text, min_words), "lines")
    wanted = lines.select("_row", "_pos", F.explode(F.arrays_zip("starts", "lengths")).alias("w")).select("_row", "_pos", F.col("w.starts").alias("a"), F.col("w.lengths").alias("length"))
    wanted = wanted.withColumn("level", F.floor(F.log2(F.col("length") + F.lit(0.5))).cast("int"))
    blocks = _shared(lines.select("_row", "n", "top", "hi", "lo", F.lit(None).cast(lines.schema["_pos"].dataType).alias("_pos")), "_row", "n", "top")
    level, found = 0, None
    while True:
        half = 1 << level
        doubled = blocks.where(F.col("top") > level).select("_row", F.lit(None).cast(lines.schema["_pos"].dataType).alias("_pos"), F.col("n").alias("a"), (F.col("n") + half).alias("b"), F.lit(2 * half).alias("length"), "top")
        here = wanted.where(F.col("level") == level).select("_row", "_pos", "a", (F.col("a") + F.col("length") - half).alias("b"), "length", F.lit(-1).alias("top"))
        head = blocks.select("_row", F.col("n").alias("a"), F.col("hi").alias("h1"), F.col("lo").alias("l1"))
        tail = blocks.select("_row", F.col("n").alias("b"), F.col("hi").alias("h2"), F.col("lo").alias("l2"))
        hi, lo = _name(*map(F.col, ("h1", "l1", "h2", "l2", "length")))
        named = doubled.unionByName(here).join(head, ["_row", "a"]).join(tail, ["_row", "b"])
        named = materialize(named.select("_row", "_pos", F.col("a").alias("n"), "length", "top", hi.alias("hi"), lo.alias("lo")), "named")
        shared = _shared(named, "_row", "_pos", "n", "length", "top")
        forget(named)
        later = shared.where("top < 0 AND _pos > first").select("_row", F.col("n").alias("start"), "length")
        found = later if found is None else found.unionByName(later)
        blocks = shared.where("top >= 0").select("_row", "n", "top", "hi", "lo")
        level += 1
        if blocks.isEmpty():
            return found


def apply(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, counts: bool = False, drop_emptied: bool = False) -> DataFrame:
    """``docs`` with the later copies of repeated line runs taken out of ``text``.

    A run is a sequence of whole lines of ``min_words`` or more words that occurs twice or
    more, in one document or in several. Lines are split at newlines and compared exactly.
    The first copy (least key, null first) stays. Null text stays null, other columns stay
    as they are, repeated rows count as copies. A copy may overlap the first one: of a line
    that repeats itself often enough in a row, one is left. With ``counts`` the columns n_lines and
    n_removed are added; with ``drop_emptied`` rows that lost all their words go. An empty
    table gives no rows. Other columns may have any names; those of ``counts`` replace
    columns of the same name.
    """
    docs, named = set_aside(docs.drop("n_lines", "n_removed") if counts else docs, key, text)
    rows = materialize(docs.withColumn("_row", F.monotonically_increasing_id()), "docs")
    gone = later_copies(rows, key, text, min_words).groupBy("_row").agg(F.collect_set(F.struct("start", "length")).alias("_gone"))
    joined = rows.join(gone, "_row", "left").drop("_row")
    kept = [f for f in joined.schema if f.name != "_gone"]
    extra = [T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType())] if counts else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, cuts = batch.column(text).to_pylist(), batch.column("_gone").to_pylist()
            n_lines, n_removed, stay = [], [], []
            for i, (t, cut) in enumerate(zip(texts, cuts, strict=True)):
                n_lines.append((t or "").count("\n") + 1 if t is not None else 0)
                n_removed.append(0)
                stay.append(True)
                if cut:
                    lines = t.split("\n")
                    edge = np.zeros(len(lines) + 1, np.int64)
                    for c in cut:
                        edge[c["start"]] += 1
                        edge[c["start"] + c["length"]] -= 1
                    out = np.cumsum(edge)[:-1] > 0
                    left = [x for x, o in zip(lines, out.tolist(), strict=True) if not o]
                    texts[i], n_removed[i] = "\n".join(left), int(out.sum())
                    stay[i] = not drop_emptied or bool(texts[i].encode().split())
            cols = [pa.array(texts, batch.schema.field(f.name).type) if f.name == text else batch.column(f.name) for f in kept]
            cols += [pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64())] if counts else []
            made = pa.RecordBatch.from_arrays(cols, names=[f.name for f in [*kept, *extra]])
            yield made if all(stay) else made.filter(pa.array(stay))

    return named(joined.mapInArrow(run, T.StructType([*kept, *extra])))


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: what is left of its text, its lines and those taken out."""
    return apply(docs.select("doc_id", "text"), counts=True)
