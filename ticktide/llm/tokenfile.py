"""Token-ID files: Re-Pair compressed shards with random access.

File format: a Parquet table, one row per shard. A shard holds whole documents in
ascending order: the rules of its grammar (pairs of symbols), the length of every rule's
expansion, the compressed symbols, the ids that each stretch of STRIDE symbols expands to,
the documents' keys and sizes, and the least and greatest key. A document is found by its sizes' sums, and
decoded from the nearest stretch before it without touching the rest of the shard.
"""

from __future__ import annotations

import functools
import hashlib
import os
import zlib
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .chunks import ChunkEncoder, Ids, gather, in_slices, starts_of

#: Ids in a shard, from which on it ends with the document at hand. Bounds a task's memory.
SHARD_IDS = 1_000_000
#: A pair is frequent, and becomes a rule, from this many occurrences in its shard.
MIN_PAIRS = 32
#: Pieces given to the library at once.
TOGETHER = 1024
#: Symbols between two entries of the random-access index.
STRIDE = 1024
SHARD = "part int, shard int, base int, least long, greatest long, doc_key binary, sizes binary, rules binary, expansion binary, symbols binary, stretch binary, n_ids long, n_docs long"


def _told_apart(pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of an array of pairs: (the number of each entry's pair, pairs by number, occurrences by number).

    The number is a bucket of a hash; what finds its bucket held by another pair is sorted.
    """
    bits = max(10, len(pair).bit_length())
    which = (pair * -7046029254386353131).view(np.uint64) >> np.uint64(64 - bits)
    which = which.view(np.int64)
    held = np.zeros(1 << bits, np.int64)
    held[which] = pair
    other = np.flatnonzero(held[which] != pair)
    if not len(other):
        return which, held, np.bincount(which, minlength=len(held))
    rest, inverse = np.unique(pair[other], return_inverse=True)
    which[other] = len(held) + inverse
    held = np.concatenate((held, rest))
    return which, held, np.bincount(which, minlength=len(held))


def compress(ids: np.ndarray, sizes: np.ndarray, base: int) -> dict[str, np.ndarray]:
    """Re-Pair over one shard: frequent pairs are replaced by nonterminals until none is left.

    Many pairs are replaced at once. Of occurrences that overlap the more frequent pair
    goes first, of equal ones the leftmost; what had to wait is counted again. A pair can only
    become frequent where a neighbour was just replaced, so later rounds look at those
    places alone. A rule never crosses the end of a document. Ids of ``base`` or more are
    an error.
    """
    if len(ids) and int(ids.max()) >= base:
        raise ValueError(f"id {int(ids.max())} is not below the base {base}")
    seq = ids.astype(np.int64)
    last = np.zeros(len(seq), bool)
    last[np.cumsum(sizes[sizes > 0]) - 1] = True
    rules, expansion = [np.zeros((0, 2), np.int64)], np.ones(base, np.int64)
    active = np.flatnonzero(~last)
    while len(active):
        which, pairs, n = _told_apart(seq[active] << 32 | seq[active + 1])
        hit = np.flatnonzero(n[which] >= MIN_PAIRS)
        at, which = active[hit], which[hit]
        count = n[which]
        if not len(at):
            break
        beside = at[1:] == at[:-1] + 1
        weaker = np.zeros(len(at), bool)
        weaker[1:] |= beside & (count[1:] < count[:-1])
        weaker[:-1] |= beside & (count[:-1] < count[1:])
        best = np.flatnonzero(~weaker)
        # in a run of equals that overlap, every other one is taken, from the left
        begins = np.concatenate(([True], np.diff(at[best]) != 1))
        index = np.arange(len(best))
        best = best[(index - np.maximum.accumulate(np.where(begins, index, 0))) % 2 == 0]
        useful = np.bincount(which[best], minlength=len(n)) > 1
        best = best[useful[which[best]]]
        new = (np.cumsum(useful) - 1)[which[best]]
        a, b = pairs[useful] >> 32, pairs[useful] & 0xFFFFFFFF
        place = at[best]
        seq[place] = len(expansion) + new
        rules.append(np.stack((a, b), 1))
        expansion = np.append(expansion, expansion[a] + expansion[b])
        last[place] = last[place + 1]
        stay = np.ones(len(seq), bool)
        stay[place + 1] = False
        before = np.maximum(place - 1, 0)
        before = np.where(stay[before], before, before - 1)  # it may be a replaced pair itself
        look = np.zeros(len(seq), bool)
        look[at] = look[place] = look[before] = True
        seq, last, look = seq[stay], last[stay], look[stay]
        active = np.flatnonzero(look & ~last)
    ends = np.cumsum(expansion[seq])
    return {
        "rules": np.concatenate(rules).astype(np.uint32), "expansion": expansion[base:].astype(np.uint32), "symbols": seq.astype(np.uint32),
        "stretch": np.concatenate(([0], ends[STRIDE - 1 :: STRIDE])).astype(np.uint32),
    }


class Reader:
    """Decodes one shard, whole or in part."""

    def __init__(self, base: int, rules: bytes, expansion: bytes, symbols: bytes, stretch: bytes):
        self.symbols = np.frombuffer(symbols, np.uint32).astype(np.int64)
        self.stretch = np.frombuffer(stretch, np.uint32).astype(np.int64)
        pairs = np.frombuffer(rules, np.uint32).reshape(-1, 2).astype(np.int64)
        lengths = np.concatenate((np.ones(base, np.int64), np.frombuffer(expansion, np.uint32).astype(np.int64)))
        # every symbol's expansion, one after the other; a rule's parts come before it
        self.lengths, self.starts = lengths, starts_of(lengths)
        flat = np.empty(int(lengths.sum()), np.uint32)
        flat[:base] = np.arange(base)
        for i, (a, b) in enumerate(pairs.tolist(), base):
            at, n = self.starts[i], lengths[a]
            flat[at : at + n] = flat[self.starts[a] : self.starts[a] + n]
            flat[at + n : at + lengths[i]] = flat[self.starts[b] : self.starts[b] + lengths[b]]
        self.flat = flat

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        return gather(self.flat, self.starts[symbols], self.lengths[symbols])

    def all(self) -> np.ndarray:
        return self._expand(self.symbols)

    def part(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the shard, from the stretches that hold them."""
        first = int(np.searchsorted(self.stretch, start, "right")) - 1
        upto = int(np.searchsorted(self.stretch, stop, "left"))
        got = self._expand(self.symbols[first * STRIDE : upto * STRIDE])
        return got[start - self.stretch[first] : stop - self.stretch[first]]


class Library:
    """Ids of pieces by the tokenizers library."""

    def __init__(self, tokenizer: Any):
        self.tokenizer = tokenizer
        vocabulary = tokenizer.get_vocab()
        self.n_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.n_bytes[[*vocabulary.values()]] = [len(token) for token in vocabulary]

    def __call__(self, pieces: pa.Array, _: np.ndarray) -> Ids:
        """A byte-level token has a character for each byte, so ids are told apart by their pieces' bytes."""
        texts = pieces.to_pylist()
        groups = [texts[lo : lo + TOGETHER] for lo in range(0, len(texts), TOGETHER)]
        coded = self.tokenizer.encode_batch_fast(groups, is_pretokenized=True, add_special_tokens=False)
        ids = np.concatenate([np.zeros(0, np.int32), *(np.array(e.ids, np.int32) for e in coded)])
        ends = np.cumsum(pc.binary_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64))
        upto = np.searchsorted(np.cumsum(self.n_bytes[ids]), ends) + 1
        return ids, np.diff(upto, prepend=0)


_TOKENIZERS: dict[str, Callable[[pa.Array], Ids]] = {}


def _library(content: str) -> Callable[[pa.Array], Ids]:
    """Whole texts by the tokenizers library, each distinct match of the pattern once.

    The string of an added token becomes that token's id, as the library does it: a text
    that holds one is encoded by the library as it stands.
    """
    key = hashlib.sha256(content.encode()).hexdigest()
    if key not in _TOKENIZERS:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(content)
        added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        chunks = ChunkEncoder(Library(tokenizer))

        def encode(texts: pa.Array) -> Ids:
            special = np.zeros(len(texts), bool)
            for a in added:
                special |= pc.match_substring(texts, a).to_numpy(zero_copy_only=False)
            at = np.flatnonzero(special).tolist()
            if not at:
                return chunks(texts)
            ids, lengths = chunks(pc.if_else(pa.array(special), "", texts))
            parts, whole = np.split(ids, np.cumsum(lengths)[:-1]), lengths.copy()
            for i in at:
                parts[i] = np.array(tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids, np.int32)
                whole[i] = len(parts[i])
            return np.concatenate(parts), whole

        _TOKENIZERS.clear()
        _TOKENIZERS[key] = encode
    return _TOKENIZERS[key]


def write(docs: DataFrame, path: str, tokenizer_file: str, end_id: int, base: int, key: str = "doc_id", text: str = "text", parts: int | None = None) -> None:
    """Encode whole texts and write the shards of ``path`` in ascending ``key`` order.

    The tokenizer must split by the byte-level pattern of ``chunks``; ids must be below
    ``base``, which is checked. Null text counts as empty (only the end id), a text of any
    length is one document. A null key sorts first. Rows that share a key are ordered by
    their texts' hash; equal rows are interchangeable. Rows are dealt to tasks by ranges of
    (key, hash, row number), so one key with very many rows is split over tasks. An empty
    table writes an empty table. Other columns, of any name, are not read.
    """
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as f:
        content = spark.sparkContext.broadcast(f.read())
    df = docs.select(F.col(key).cast("long").alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    df = df.withColumn("_hash", F.xxhash64("_text")).withColumn("_row", F.monotonically_increasing_id())
    order = [F.col("_key").asc_nulls_first(), F.col("_hash"), F.col("_row")]
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = df.repartitionByRange(n, *order).sortWithinPartitions(*order).select("_key", "_text")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode = _library(content.value)
        part, no = TaskContext.get().partitionId(), 0
        keys, ids, sizes, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal keys, ids, sizes, held, no
            size = np.concatenate(sizes)
            packed = compress(np.concatenate(ids), size, base)
            by_key = np.concatenate([np.frombuffer(k, np.uint8) for k in keys]).reshape(-1, 9)
            known = np.ascontiguousarray(by_key[by_key[:, 0] == 1][:, 1:]).view("<i8").ravel()
            row = {
                "part": part, "shard": no, "base": base, "least": int(known[0]) if len(known) else None, "greatest": int(known[-1]) if len(known) else None, "doc_key": b"".join(keys), "sizes": size.astype(np.uint32).tobytes(),
                "rules": packed["rules"].tobytes(), "expansion": packed["expansion"].tobytes(), "symbols": packed["symbols"].tobytes(), "stretch": packed["stretch"].tobytes(),
                "n_ids": int(size.sum()), "n_docs": len(size),
            }
            keys, ids, sizes, held, no = [], [], [], 0, no + 1
            kinds = {"part": pa.int32(), "shard": pa.int32(), "base": pa.int32(), "least": pa.int64(), "greatest": pa.int64(), "n_ids": pa.int64(), "n_docs": pa.int64()}
            return pa.RecordBatch.from_arrays([pa.array([v], kinds.get(k, pa.binary())) for k, v in row.items()], names=[*row])

        for batch in batches:
            texts = batch.column("_text").cast(pa.large_string())
            for lo, hi in in_slices(pc.binary_length(texts).to_numpy(), 8_000_000):
                flat, lengths = encode(texts.slice(lo, hi - lo))
                ends = starts_of(lengths) + lengths
                flat = np.insert(flat, ends, end_id)
                lengths = lengths + 1
                doc = batch.column("_key").slice(lo, hi - lo)
                # a null key is kept apart from every number by its flag
                key_rows = np.zeros((hi - lo, 9), np.uint8)
                key_rows[:, 0] = doc.is_valid().to_numpy(zero_copy_only=False)
                key_rows[:, 1:] = doc.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").view(np.uint8).reshape(-1, 8)
                at = 0
                bounds = starts_of(lengths) + lengths
                while at < len(lengths):
                    begin = int(bounds[at - 1]) if at else 0
                    upto = max(at + 1, int(np.searchsorted(bounds, begin + SHARD_IDS - held, "left")) + 1)
                    upto = min(upto, len(lengths))
                    keys.append(key_rows[at:upto].tobytes())
                    ids.append(flat[begin : int(bounds[upto - 1])])
                    sizes.append(lengths[at:upto])
                    held += int(bounds[upto - 1]) - begin
                    at = upto
                    if held >= SHARD_IDS:
                        yield flush()
        if held:
            yield flush()

    df.mapInArrow(shards, SHARD).write.option("compression", "zstd").parquet(path)


def shard_starts(shards: DataFrame) -> DataFrame:
    """(part, shard, start): ids in all shards before. One window over parts' sums, one inside parts."""
    per_part = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per_part = per_part.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.select("part", "shard", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("in_part")).join(per_part, "part").select("part", "shard", (F.col("part_start") + F.col("in_part")).alias("start"))


def read(spark: SparkSession, path: str, with_ids: bool = False, keys: tuple[int, ...] | None = None) -> DataFrame:
    """Documents of a written table: doc_id, start, n_tokens, ids_crc32 and, on request, ids.

    ``start`` counts the ids of all documents before; a shard is decoded in one task. With
    ``keys`` only those documents are returned: shards that can't hold one are not read, of
    the others no more is decoded than the stretches in which the documents lie.
    """
    table = spark.read.parquet(path)
    starts = shard_starts(table.select("part", "shard", "n_ids"))
    if keys is not None:
        near = [(F.col("least") <= k) & (F.col("greatest") >= k) for k in keys]
        table = table.where(functools.reduce(lambda a, b: a | b, near, F.lit(False)))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                reader = Reader(row["base"], row["rules"], row["expansion"], row["symbols"], row["stretch"])
                sizes = np.frombuffer(row["sizes"], np.uint32).astype(np.int64)
                flagged = np.frombuffer(row["doc_key"], np.uint8).reshape(-1, 9)
                key, null = np.ascontiguousarray(flagged[:, 1:]).view("<i8").ravel(), flagged[:, 0] == 0
                at = starts_of(sizes)
                if keys is None:
                    ids = reader.all().astype("<u4")
                    found = [ids[a : a + n] for a, n in zip(at.tolist(), sizes.tolist(), strict=True)]
                else:
                    mine = np.flatnonzero(np.isin(key, keys) & ~null)
                    key, null, at, sizes = key[mine], null[mine], at[mine], sizes[mine]
                    found = [reader.part(a, a + n).astype("<u4") for a, n in zip(at.tolist(), sizes.tolist(), strict=True)]
                n = len(sizes)
                cols = [
                    pa.array(np.full(n, row["part"], np.int32)), pa.array(np.full(n, row["shard"], np.int32)), pa.array(at), pa.array(sizes),
                    pa.array(key, mask=null), pa.array([zlib.crc32(p.tobytes()) for p in found], pa.int64()),
                ]
                names = ["part", "shard", "at", "n_tokens", "doc_id", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array([p.astype(np.int32) for p in found], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "part int, shard int, at long, n_tokens long, doc_id long, ids_crc32 long" + ", ids array<int>" * with_ids
    docs = table.drop("n_ids", "n_docs", "least", "greatest").mapInArrow(documents, schema)
    docs = docs.join(starts, ["part", "shard"])
    return docs.select("doc_id", (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))
