"""Byte-level BPE: encoding by padded matrices of merges, and decoding.

The merges of many pieces run at once: pieces of about one length are the rows of a
padded matrix; in every round each row merges its leftmost pair of least rank, finished
rows leave and the matrix loses a column. Ranks of pairs come from a hashed table.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .chunks import ChunkEncoder, Ids, gather, in_slices, starts_of
from .common import free_name

NO_RANK = np.int32(2**31 - 1)
#: Rows of more bytes than this find their least rank by the minima of tiles, others at once.
NARROW = 256
#: Cells of one matrix at most.
MATRIX_CELLS = 2_000_000


def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a file of lines ``base64 rank``."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class PairTable:
    """Hashed lookup from a pair of ids to the rank (and id) of the merged token."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self.bits = max(10, (4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NO_RANK, np.int32)
        keys, values = np.array([*pairs], np.int64), np.array([*pairs.values()], np.int32)
        slot = self._slot(keys)
        while len(keys):  # linear probing, all pairs at once
            free = np.flatnonzero(self.keys[slot] < 0)
            places, who = np.unique(slot[free], return_index=True)
            self.keys[places], self.ranks[places] = keys[free[who]], values[free[who]]
            left = np.ones(len(keys), bool)
            left[free[who]] = False
            keys, values, slot = keys[left], values[left], (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair; NO_RANK where either id is negative (padding) or no token results."""
        keys = a.astype(np.int64) << 32 | b
        slot = self._slot(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.ranks[slot], NO_RANK)
        todo = np.flatnonzero((held != keys) & (held >= 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            held = self.keys[slot[todo]]
            hit = held == keys[todo]
            out[todo[hit]] = self.ranks[slot[todo[hit]]]
            todo = todo[~hit & (held >= 0)]
        out[(a < 0) | (b < 0)] = NO_RANK
        return out


class ByteBPE:
    """Encoder and decoder for one vocabulary of ranks; ids are ranks, no special tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self.table = PairTable(ranks)
        self.of_byte = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.decimals = [str(i) for i in range(len(self.tokens))]
        self.chunks = ChunkEncoder(self.merge)

    def _matrix(self, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rows as they finish, their numbers of ids, their ids one after the other)."""
        width = int(lengths.max())
        column = np.arange(width)
        inside = column < lengths[:, None]
        ids = self.of_byte[flat[np.where(inside, starts[:, None] + column, 0)]]
        ids[~inside] = -1
        rank = np.full(ids.shape, NO_RANK, np.int32)
        if width > 1:
            rank[:, :-1] = self.table(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(-1, width - 1)
        who, out = np.arange(len(ids)), []
        while True:
            at = rank.argmin(1)  # the leftmost of the least
            row = np.arange(len(ids))
            best = rank[row, at]
            done = best == NO_RANK
            if done.any():
                left = ids[done]
                out.append((who[done], (left >= 0).sum(1), left[left >= 0]))
                if done.all():
                    return tuple(np.concatenate(x) for x in zip(*out, strict=True))
                on = ~done
                ids, rank, who, at, best, row = ids[on], rank[on], who[on], at[on], best[on], np.arange(int(on.sum()))
            width = ids.shape[1] - 1
            ids[row, at] = best
            stay = np.ones(ids.shape, bool)
            stay[row, at + 1] = False
            ids = ids[stay].reshape(-1, width)  # compaction: a column less
            stay[row, at + 1], stay[row, at] = True, False
            rank = rank[stay].reshape(-1, width)
            last = at == width - 1  # nothing follows the merged token
            follow = np.where(last, -1, ids[row, np.minimum(at + 1, width - 1)])
            rank[row, at] = self.table(best, follow)
            has = np.flatnonzero(at > 0)
            rank[has, at[has] - 1] = self.table(ids[has, at[has] - 1], best[has])

    def _tiled(self, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``_matrix``, for wide rows: the least rank is found by the minima of tiles.

        A round looks at one number a tile and at the tiles that a merge touches, not at
        the whole row. Merged columns are linked over and compacted at the end.
        """
        tile = 1 << (int(lengths.max()).bit_length() + 1) // 2
        width = -(-(int(lengths.max()) + 1) // tile) * tile  # one column at least that holds nothing
        column = np.arange(width)
        inside = column < lengths[:, None]
        ids = self.of_byte[flat[np.where(inside, starts[:, None] + column, 0)]]
        ids[~inside] = -1
        rank = np.full(ids.shape, NO_RANK, np.int32)
        rank[:, :-1] = self.table(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(-1, width - 1)
        rank = rank.reshape(len(ids), -1, tile)
        least = rank.min(2)
        after, before = np.tile(column + 1, (len(ids), 1)), np.tile(column - 1, (len(ids), 1))
        row = np.arange(len(ids))
        while len(row):
            t = least[row].argmin(1)  # the leftmost of the least
            best = least[row, t]
            on = best != NO_RANK
            row, t, best = row[on], t[on], best[on]
            at = t * tile + rank[row, t].argmin(1)
            gone = after[row, at]
            follow, previous = after[row, gone], before[row, at]
            ids[row, at], ids[row, gone] = best, -1
            after[row, at], before[row, follow] = follow, at
            rank[row, gone // tile, gone % tile] = NO_RANK
            rank[row, t, at % tile] = self.table(best, ids[row, follow])
            first = previous < 0
            old = np.maximum(previous, 0)
            made = self.table(ids[row, old], best)
            rank[row, old // tile, old % tile] = np.where(first, rank[row, old // tile, old % tile], made)
            for touched in (t, gone // tile, old // tile):
                least[row, touched] = rank[row, touched].min(1)
        return np.arange(len(ids)), (ids >= 0).sum(1), ids[ids >= 0]

    def merge(self, pieces: pa.Array, uses: np.ndarray | None = None) -> Ids:
        """Ids of distinct pieces, by matrices of rows of about one length."""
        offsets = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
        flat = np.frombuffer(pieces.buffers()[2] or b"\0", np.uint8)
        starts, lengths = offsets[:-1], np.diff(offsets)
        order = np.argsort(lengths, kind="stable")
        in_order = lengths[order]
        found = []
        at = int(np.searchsorted(in_order, 1))
        while at < len(order):
            wide = in_order[at] > NARROW
            limit = int(in_order[at]) + max(1, int(in_order[at]) // 8)
            limit = limit if wide else min(NARROW, limit)
            end = min(int(np.searchsorted(in_order, limit, "right")), at + max(1, MATRIX_CELLS // (4 * limit if wide else limit)))
            rows = order[at:end]
            who, counts, ids = (self._tiled if wide else self._matrix)(flat, starts[rows], lengths[rows])
            found.append((rows[who], counts, ids))
            at = end
        if not found:
            return np.zeros(0, np.int32), np.zeros(len(pieces), np.int64)
        who, counts, ids = (np.concatenate(x) for x in zip(*found, strict=True))
        out = np.zeros(len(pieces), np.int64)
        out[who] = counts
        place = np.zeros(len(pieces), np.int64)
        place[who] = starts_of(counts)
        return gather(ids, place, out), out

    def encode_batch(self, texts: pa.Array | list[str]) -> list[np.ndarray]:
        """Ids of each whole text, as int32."""
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts
        flat, lengths = self.chunks(texts)
        return np.split(flat, np.cumsum(lengths)[:-1]) if len(texts) else []

    def decode_batch(self, ids: list[np.ndarray]) -> list[bytes]:
        """The bytes that each list of ids stands for."""
        tokens = self.tokens
        return [b"".join([tokens[i] for i in x.tolist()]) for x in ids]

    def decimal(self, ids: np.ndarray) -> str:
        d = self.decimals
        return " ".join([d[i] for i in ids.tolist()])


_LOADED: dict[str, ByteBPE] = {}


def encoder(raw: bytes) -> ByteBPE:
    """The encoder of a ranks file's content; each worker builds it once."""
    key = hashlib.sha256(raw).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = ByteBPE({base64.b64decode(a): int(b) for a, b in (x.split() for x in raw.splitlines() if x.strip())})
    return _LOADED[key]


#: What ``apply`` can return of each text.
OUTPUTS = {
    "ids": (T.ArrayType(T.IntegerType()), pa.list_(pa.int32())),
    "n_tokens": (T.LongType(), pa.int64()),
    "ids_sha256": (T.StringType(), pa.string()),
    "decoded": (T.BinaryType(), pa.binary()),
    "decoded_sha256": (T.StringType(), pa.string()),
}


def apply(docs: DataFrame, ranks_file: str, outputs: tuple[str, ...] = ("ids",), text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``carry`` and the named OUTPUTS of each whole text, one row per row.

    ``decoded`` is decoded from the ids. Null text counts as empty and gives no ids;
    special tokens' strings are ordinary text. A carried column that has the name of an output gives way to it. The ranks file is read once, on the
    driver; its content (one vocabulary, of fixed size) goes to the workers.
    """
    with open(ranks_file, "rb") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())
    kinds = [OUTPUTS[o][1] for o in outputs]
    carry = tuple(c for c in carry if c not in outputs)
    work = free_name(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(content.value)
        for batch in batches:
            texts = batch.column(work).cast(pa.large_string()).fill_null("")
            for lo, hi in in_slices(pc.binary_length(texts).to_numpy()):
                ids = bpe.encode_batch(texts.slice(lo, hi - lo))
                back = bpe.decode_batch(ids) if any(o.startswith("decoded") for o in outputs) else []
                made = {
                    "ids": lambda: ids, "n_tokens": lambda: [len(x) for x in ids],
                    "ids_sha256": lambda: [hashlib.sha256(bpe.decimal(x).encode()).hexdigest() for x in ids],
                    "decoded": lambda: back, "decoded_sha256": lambda: [hashlib.sha256(x).hexdigest() for x in back],
                }
                cols = [pa.array(made[o](), k) for o, k in zip(outputs, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(lo, hi - lo) for c in carry), *cols], names=[*carry, *outputs])

    df = docs.select(*carry, docs[text].alias(work))
    return df.mapInArrow(run, T.StructType([*(f for f in df.schema if f.name != work), *(T.StructField(o, OUTPUTS[o][0]) for o in outputs)]))
