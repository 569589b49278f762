"""SimHash near-duplicates: candidates by pigeonring, links by the full Hamming check.

The fingerprint's bits form a ring of SEGMENTS segments. If two fingerprints differ in at
most ``t`` bits, some segment begins a chain in which the first l segments differ in at
most l * t / SEGMENTS bits, for every l. Chains of one and of two segments decide which
fingerprints have a candidate at all, chains of three which meet; then the full check follows.

``keep_one`` links by the exact Jaccard similarity of shingle sets. Bits of a SimHash can't
lead to them: at a similarity of 0.8 a seventh of the bits differ, so no segment worth
keeping is equal. Its ring holds minima of the shingles' hashes instead, at POSITIONS
places: candidates by chains of the same pigeonring, then the distance, then the sets themselves.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import forget, free_name, materialize, set_aside
from .components import connected_components

BITS = 64
#: Bits in which linked fingerprints may differ. The chains below are written for two.
MAX_BITS = 2
#: Ring of three segments: (first bit, number of bits). Budgets 0, 1, 2 for chains of 1, 2, 3.
RING = ((0, 22), (22, 21), (43, 21))
#: Values of the lower half of a segment.
HALF = 1 << 10


def fingerprint(text: str | None, words: int = 3) -> int:
    """SimHash of the lower-cased text's word shingles, repeats included; 0 without words."""
    parts = (text or "").encode().lower().split()  # bytes: A-Z only, six ASCII blanks only
    if not parts:
        return 0
    joined = b" ".join(parts)
    n = len(parts) - words + 1
    if n <= 1:
        return xxhash.xxh64_intdigest(joined, 42)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    ends = np.cumsum(lengths)
    start, stop = (ends - lengths)[:n].tolist(), (ends[words - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], 42) for a, b in zip(start, stop, strict=True)], np.uint64)
    set_bits = np.zeros(BITS, np.int64)
    for lo in range(0, n, 65536):  # whole text, in stretches of bounded memory
        set_bits += np.unpackbits(h[lo : lo + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = 3, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``carry`` and ``fp``, the fingerprint as a signed long, one row per row."""

    carry = tuple(c for c in carry if c != "fp")
    work = free_name(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(t.as_py(), words) for t in batch.column(work)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carry), pa.array(made)], names=[*carry, "fp"])

    df = docs.select(*carry, docs[text].alias(work))
    return df.mapInArrow(run, T.StructType([*(f for f in df.schema if f.name != work), T.StructField("fp", T.LongType())]))


def _segment(fp: Column, i: int) -> Column:
    first, bits = RING[i % len(RING)]
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << bits) - 1))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _flips(start: Column) -> Column:
    """Masks that flip no bit, or one bit outside the segment ``start``."""
    whole = [F.lit(0).cast("long")]
    choice = F.when(start == 0, F.array(*whole, *_masks(1), *_masks(2))).when(start == 1, F.array(*whole, *_masks(0), *_masks(2)))
    return choice.otherwise(F.array(*whole, *_masks(0), *_masks(1)))


def _masks(i: int) -> list[Column]:
    first, bits = RING[i]
    return [F.lit(_signed(1 << (first + b))).cast("long") for b in range(bits)]


def chains(distinct: DataFrame) -> DataFrame:
    """(fp, i): fingerprints with the starts i of which a chain of two has a partner.

    Chain of one: segment i equals another fingerprint's, as far as a half of the next does
    too, without which there is no chain of two. Chain of two: besides, the next
    segment differs in at most one bit. Groups are only counted, never listed.
    """
    ring = F.array(*(F.struct(F.lit(i).alias("i"), _segment(F.col("fp"), i).alias("a"), _segment(F.col("fp"), i + 1).alias("b"), F.lit(RING[(i + 1) % len(RING)][1]).alias("w")) for i in range(len(RING))))
    one = distinct.select("fp", F.explode(ring).alias("c")).select("fp", "c.*")
    # a second segment within one bit has an equal half: so short a first segment's chance partners go
    halves = F.array(F.struct(F.lit(0).alias("j"), F.col("b").bitwiseAND(F.lit(HALF - 1)).alias("h")), F.struct(F.lit(1).alias("j"), F.floor(F.col("b") / HALF).alias("h")))
    parts = one.select("*", F.explode(halves).alias("p")).select("fp", "i", "a", "b", "w", "p.*")
    shared = parts.groupBy("i", "a", "j", "h").count().where("count > 1").select("i", "a", "j", "h")
    one = parts.join(shared.hint("merge"), ["i", "a", "j", "h"], "left_semi").select("fp", "i", "a", "b", "w").distinct()
    # the second segment: as it is, and with each bit flipped; equal to an unflipped one within a bit
    probe = F.concat(F.array(F.struct(F.col("b").alias("b"), F.lit(True).alias("own"))), F.transform(F.sequence(F.lit(0), F.col("w") - 1), lambda k: F.struct(F.col("b").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), k)).alias("b"), F.lit(False).alias("own"))))
    probes = one.select("fp", "i", "a", F.explode(probe).alias("p")).select("fp", "i", "a", "p.*")
    owners = probes.groupBy("i", "a", "b").agg(F.count(F.when(F.col("own"), 1)).alias("owners"), F.count(F.lit(1)).alias("n")).where("owners > 0 AND n > 1")
    two = probes.join(owners.hint("merge"), ["i", "a", "b"]).where("NOT own OR owners > 1 OR n > owners")
    return two.select("fp", "i").distinct()


def links(distinct: DataFrame) -> DataFrame:
    """(fp, rep): edges whose connected components are those of all pairs within MAX_BITS.

    A pair within two bits has a start i whose segment is equal, the next within a bit and
    the third within what is left. Such two share a value that differs from each in at most
    one bit, none of it in segment i: chains of three meet by start and value. All that
    share one are linked to the least of them: a group of any size gives one edge a member,
    never all its pairs, and no link is lost. The full Hamming check is made on every edge.
    """
    ready = chains(distinct)
    three = ready.select("fp", "i", F.explode(_flips(F.col("i"))).alias("mask")).select("fp", "i", F.col("fp").bitwiseXOR(F.col("mask")).alias("middle"))
    least = three.groupBy("i", "middle").agg(F.min("fp").alias("rep"), F.count(F.lit(1)).alias("n")).where("n > 1").select("i", "middle", "rep")
    edges = three.join(least.hint("merge"), ["i", "middle"]).where("fp <> rep").select("fp", "rep").distinct()
    return edges.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("rep"))) <= MAX_BITS)


def components(fps: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows (key, fp) with ``component``: the smallest key of all rows that links reach.

    Rows of equal fingerprint are linked. Null keys are never the smallest; a component
    of null keys only has component null. Written rows of ``fps`` are read several times:
    pass a materialised table.
    """
    distinct = materialize(fps.groupBy("fp").agg(F.min(key).alias("least")), "fps")
    roots = connected_components(links(distinct.select("fp")), "fp", "rep")
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    best = named.groupBy("root").agg(F.min("least").alias("component"))
    found = named.join(best, "root").select("fp", "component")
    return fps.join(found, "fp")


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint and the smallest doc_id of its component."""
    fps = materialize(fingerprints(docs), "simhash")
    return components(fps).select("doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id"))


def shingles(text: str | None, words: int) -> np.ndarray:
    """The distinct hashes of the lower-cased text's word shingles, sorted; none without words."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    n = max(1, len(parts) - words + 1)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    ends = np.cumsum(lengths)
    start, stop = (ends - lengths)[:n].tolist(), (ends[min(words, len(parts)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[a:b], 42) for a, b in zip(start, stop, strict=True)], np.uint64))


#: Positions of the stage's ring, and in how many of them linked documents may differ.
POSITIONS, APART = 20, 9
#: Classes of the finer sketch that is compared once two rings have met, and standard deviations that it allows.
SKETCH, DEVIATIONS = 256, 3.0
#: Rows of a chain's group that are compared in one cell; rows of it at once.
CELL, AT_ONCE = 2048, 64
#: Rounds in which a row is checked with its nearest alone, before it is with all that are left. Sets the cost, no result.
ROUNDS = 2


def _multipliers() -> np.ndarray:
    return np.random.default_rng(20).integers(1, 2**63, POSITIONS, np.uint64) * np.uint64(2) + np.uint64(1)


def ring(h: np.ndarray) -> np.ndarray:
    """POSITIONS values of a set of hashes: the least of it in as many random orders.

    Two sets have the same value at a position with a chance of their Jaccard similarity.
    """
    by, least = _multipliers(), np.full(POSITIONS, 2**64 - 1, np.uint64)
    for lo in range(0, len(h), 16384):
        part = h[lo : lo + 16384, None] * by
        least = np.minimum(least, (part ^ (part >> np.uint64(31))).min(0))
    return (least >> np.uint64(32)).astype(np.uint32)


def sketch(h: np.ndarray) -> np.ndarray:
    """The set dealt into SKETCH classes by a hash: a byte of the least of each class, 0 for an empty one."""
    g = np.sort((h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD))
    kind = (g >> np.uint64(56)).astype(np.int64)
    first = np.flatnonzero(np.diff(kind, prepend=-1))
    out = np.zeros(SKETCH, np.uint8)
    out[kind[first]] = 1 + (g[first] >> np.uint64(24)).astype(np.int64) % 255
    return out


def estimated(x: np.ndarray, y: np.ndarray, similarity: float) -> np.ndarray:
    """Estimates of the similarity of paired rows of sketches; -1 where it lies beyond what chance allows at ``similarity``."""
    out = np.empty(len(x))
    for lo in range(0, len(x), 32768):
        a, b = x[lo : lo + 32768], y[lo : lo + 32768]
        both = ((a == b) & (a > 0)).sum(1)
        held = np.maximum(1, ((a > 0) | (b > 0)).sum(1))
        share = both / held
        out[lo : lo + 32768] = np.where(share >= similarity - DEVIATIONS * np.sqrt(similarity * (1 - similarity) / held), share, -1)
    return out


def _described(src: DataFrame, words: int) -> DataFrame:
    """_key and _row with the hash of the text's words in order, the size of its shingle set, its ring and its sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same, size, rings = [], [], []
            for t in batch.column("_text"):
                text = t.as_py() or ""
                same.append(hashlib.sha256(b" ".join(text.encode().lower().split())).digest())
                h = shingles(text, words)
                size.append(len(h))
                rings.append(ring(h).tobytes() + sketch(h).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("_key"), batch.column("_row"), pa.array(same, pa.binary()), pa.array(size, pa.int64()), pa.array(rings, pa.binary())], names=["_key", "_row", "same", "size", "ring"])

    kept = [f for f in src.schema if f.name != "_text"]
    return src.mapInArrow(run, T.StructType([*kept, T.StructField("same", T.BinaryType()), T.StructField("size", T.LongType()), T.StructField("ring", T.BinaryType())]))


def _rings(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The rings and the sketches of a batch's rows."""
    raw = np.frombuffer(b"".join(batch.column("ring").to_pylist()), np.uint8).reshape(-1, 4 * POSITIONS + SKETCH)
    return np.ascontiguousarray(raw[:, : 4 * POSITIONS]).view(np.uint32), raw[:, 4 * POSITIONS :]


def ring_chains(reps: DataFrame) -> DataFrame:
    """(token, start, node, size): a row for each start of a chain of two positions.

    APART differing positions of POSITIONS leave a chain of two none, so any pair within
    that distance has a start at which both positions are equal.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            r = _rings(batch)[0].astype(np.uint64)
            token = (r << np.uint64(32)) | np.roll(r, -1, 1)
            token = (token * np.uint64(0x9E3779B97F4A7C15)) ^ (np.arange(POSITIONS, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
            rep = lambda c: pa.array(np.repeat(batch.column(c).to_numpy(), POSITIONS))
            start = pa.array(np.tile(np.arange(POSITIONS, dtype=np.int32), len(r)))
            yield pa.RecordBatch.from_arrays([pa.array(token.ravel().view(np.int64)), start, rep("node"), rep("size")], names=["token", "start", "node", "size"])

    return reps.where("size > 0").select("node", "size", "ring").mapInArrow(run, "token long, start int, node long, size long")


def _within(similarity: float, a: str, b: str) -> Column:
    """Sizes that sets of this similarity can have."""
    return (F.least(a, b) >= F.greatest(a, b) * similarity - 1e-9).alias("within")


def _equal_positions(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many positions each row of x shares with each of y."""
    n = np.zeros((len(x), len(y)), np.int8)
    for p in range(POSITIONS):
        n += x[:, p, None] == y[None, :, p]
    return n


def _first_start(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The first start of a chain of two that each row of x shares with its row of y."""
    equal = x == y
    return (equal & np.roll(equal, -1, 1)).argmax(1)


def _cell(start: int, node: np.ndarray, size: np.ndarray, comp: np.ndarray, block: np.ndarray, rings: np.ndarray, sketches: np.ndarray, similarity: float, best_only: bool) -> Iterator[pa.RecordBatch]:
    """Pairs of a cell's rows that may be linked: other components, sizes, full distance, sketches.

    A pair is given where its rows' first common chain starts, so by one group only.
    A cell of two blocks leaves the pairs inside a block to other cells. With
    ``best_only`` each row gives one pair, that with its nearest.
    """

    def made(p: np.ndarray, q: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
        p, q = node[p], node[q]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(p, q)), pa.array(np.maximum(p, q)), pa.array(p), pa.array(score)], names=["a", "b", "of", "score"])

    side = block == block.max()
    left = np.flatnonzero(side)
    right = left if side.all() else np.flatnonzero(~side)
    most, nearest = np.full(len(node), -1.0), np.zeros(len(node), np.int64)
    for lo in range(0, len(left), AT_ONCE):
        i = left[lo : lo + AT_ONCE]
        small, large = np.minimum(size[i, None], size[None, right]), np.maximum(size[i, None], size[None, right])
        ok = (comp[i, None] != comp[None, right]) & (small >= large * similarity - 1e-9)
        if right is left:
            ok &= i[:, None] < right[None]
        x, y = np.nonzero(ok & (_equal_positions(rings[i], rings[right]) >= POSITIONS - APART))
        x, y = i[x], right[y]
        here = _first_start(rings[x], rings[y]) == start
        x, y = x[here], y[here]
        score = estimated(sketches[x], sketches[y], similarity)
        x, y, score = x[score >= 0], y[score >= 0], score[score >= 0]
        if not best_only:
            if len(x):
                yield made(x, y, score)
            continue
        for p, q in ((x, y), (y, x)):
            order = np.argsort(score, kind="stable")
            order = order[score[order] > most[p[order]]]
            most[p[order]], nearest[p[order]] = score[order], q[order]  # the last, so the greatest, of a row stays
    found = np.flatnonzero(most >= 0)
    if len(found):
        yield made(found, nearest[found], most[found])


def _cell_pairs(tokens: DataFrame, reps: DataFrame, comps: DataFrame, similarity: float, best_only: bool) -> DataFrame:
    """(a, b, of, score): candidates among the rows of each token that are not yet in one component.

    ``of`` is the row that gives the pair, ``score`` the estimated similarity. A large group is dealt over the cells of pairs of its blocks, so no task holds a group.
    """
    mine = tokens.join(comps.hint("merge"), "node", "left").select("token", "start", "node", F.coalesce("root", "node").alias("comp"))
    groups = mine.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    blocks = F.floor(F.col("n") / CELL) + 1
    cells = mine.join(groups.select("token", blocks.alias("blocks")), "token").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    cells = cells.join(reps.select("node", "size", "ring").hint("merge"), "node")
    cells = cells.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cells = cells.select("token", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "start", "node", "size", "comp", "block", "ring")
    n = int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list | None = None

        def pairs(x: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            edge = np.flatnonzero(np.concatenate(([True], (x[0][1:] != x[0][:-1]) | (x[1][1:] != x[1][:-1]) | (x[2][1:] != x[2][:-1]))))
            for lo, hi in zip(edge.tolist(), [*edge[1:].tolist(), len(x[0])], strict=True):
                start, node, size, comp, block, rings, sketches = (y[lo:hi] for y in x[3:])
                if x[1][lo] == x[2][lo] or len(np.unique(block)) > 1:
                    yield from _cell(int(start[0]), node, size, comp, block, rings, sketches, similarity, best_only)

        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(c).to_numpy() for c in ("token", "p", "q", "start", "node", "size", "comp", "block")]
            now += _rings(batch)
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now, strict=True)]
            last = (now[0] == now[0][-1]) & (now[1] == now[1][-1]) & (now[2] == now[2][-1])
            cut = len(last) - int(last.sum())  # the last cell may go on in the next batch
            held = [x[cut:] for x in now]
            if cut:
                yield from pairs([x[:cut] for x in now])
        if held is not None:
            yield from pairs(held)

    return cells.repartition(n, "token", "p", "q").sortWithinPartitions("token", "p", "q").mapInArrow(compared, "a long, b long, of long, score double")


def _alike(pairs: DataFrame, rows: DataFrame, text: str, words: int, similarity: float) -> DataFrame:
    """The pairs (a, b) of rows whose shingle sets have the Jaccard similarity: the exact check, on whole texts."""

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no, left = None, np.zeros(0, np.uint64)
        for batch in batches:
            stay = []
            for a, x, y in zip(batch.column("a").to_pylist(), batch.column("x"), batch.column("y"), strict=True):
                if a != no:
                    no, left = a, shingles(x.as_py(), words)
                right = shingles(y.as_py(), words)
                both = len(left) + len(right) - len(np.union1d(left, right))
                stay.append(both >= similarity * (len(left) + len(right) - both) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(stay, pa.bool_()))

    # a row with many partners is dealt out in copies, one for 256 of them
    copies = pairs.groupBy("a").agg(F.floor(F.count(F.lit(1)) / 256).alias("copies"))
    needed = materialize(pairs.select("b").distinct().withColumnRenamed("b", "node").withColumn("copies", F.lit(-1).cast("long")).unionByName(copies.withColumnRenamed("a", "node")), "needed")
    own = pairs.join(copies, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("copies") + 1).alias("copy"))
    found = materialize(rows.select(F.col("_row").alias("node"), F.col(text).alias("text")).join(needed, "node"), "texts")
    right = own.join(found.where("copies < 0").select(F.col("node").alias("b"), F.col("text").alias("y")), "b")
    left = found.where("copies >= 0").select(F.col("node").alias("a"), F.col("text").alias("x"), F.explode(F.sequence(F.lit(0).cast("long"), "copies")).alias("copy"))
    met = right.join(left, ["a", "copy"]).select("a", "b", "x", "y")
    out = materialize(met.mapInArrow(checked, "a long, b long"), "links")
    forget(needed, found)
    return out


def near_links(reps: DataFrame, rows: DataFrame, similarity: float, words: int, text: str) -> DataFrame:
    """(a, b): links of ``similarity`` or more; components are those of all such pairs within APART.

    ``reps`` (node, size, ring) are rows of different words. Rows meet by chains of their rings. First
    each is checked with one leader, the least of those it shares most chains with, so a group of near
    copies falls into one component with one check a member. Then, ROUNDS times, each row of a group that is
    not one component is checked with its nearest in another component; last with all that
    are still in other components. One rule holds for groups of every size.
    """
    tokens = materialize(ring_chains(reps), "chains")
    kind = F.floor(F.log("size") / -math.log(similarity))  # sets of about one size have one leader
    leaders = tokens.groupBy("token", kind.alias("kind")).agg(F.min(F.struct("node", "size")).alias("l"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = tokens.withColumn("kind", kind).join(leaders.hint("merge"), ["token", "kind"]).select("node", "size", F.col("l.node").alias("lead"), F.col("l.size").alias("lead_size"))
    shared = shared.where("node <> lead").where(_within(similarity, "size", "lead_size"))
    one = shared.groupBy("node", "lead").count().groupBy("node").agg(F.max_by("lead", F.struct("count", -F.col("lead"))).alias("lead"))
    tried = materialize(one.select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")).distinct(), "tried")
    sure = _alike(tried, rows, text, words, similarity)
    several = lambda t: t.join(t.groupBy("token").count().where("count > 1").select("token").hint("merge"), "token", "left_semi")
    tokens, old = materialize(several(tokens.select("token", "start", "node")), "chains"), tokens
    forget(old)
    for no in range(ROUNDS + 1):
        comps = connected_components(sure, "a", "b", most=2 if no < ROUNDS else None)  # unfinished ones only cost further checks
        offers = materialize(_cell_pairs(tokens, reps, comps, similarity, no < ROUNDS), "offers")
        more = offers.join(tried, ["a", "b"], "left_anti")
        if no < ROUNDS:
            # every row with a partner outside its component has made an offer: only such rows go on
            tokens, old = materialize(several(tokens.join(offers.select(F.col("of").alias("node")).distinct(), "node", "left_semi")), "chains"), tokens
            forget(old)
            more = more.groupBy("of").agg(F.min_by(F.struct("a", "b"), F.struct(-F.col("score"), "a", "b")).alias("p")).select("p.*")
        more, old = materialize(more.select("a", "b").distinct(), "pairs"), offers
        forget(old)
        if more.isEmpty() and tokens.isEmpty():
            break
        sure, tried = sure.unionByName(_alike(more, rows, text, words, similarity)), tried.unionByName(more)
    return sure


def keep_one(docs: DataFrame, words: int = 5, similarity: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of near copies: that of the least key (null last), then of the least row number.

    Groups are the components of the pairs whose word-shingle sets have a Jaccard
    similarity of ``similarity`` or more, as far as their rings differ in no more than
    APART positions (at 0.8, 997 of 1000 such pairs; more above it). Null text counts as empty; texts without a word are one
    group; texts of any length are read whole; repeated rows are one group; an empty
    table gives no rows. All columns are kept as they are and may have any names and
    types. Only keys, rings and the texts of candidates are shuffled for the links; rows
    meet the decision through the row numbers of a written table.
    """
    columns = docs.columns
    docs, named = set_aside(docs, key, text)
    rows = materialize(docs.withColumn("_row", F.monotonically_increasing_id()), "docs")
    first = F.struct(F.col("_key").isNull().alias("no_key"), F.col("_key").alias("k"), F.col("_row").alias("row"))
    described = _described(rows.select(rows[key].alias("_key"), "_row", rows[text].alias("_text")), words)
    # rows of equal words in equal order have equal sets: one of them stands for all
    reps = described.groupBy("same").agg(F.min(first).alias("first"), F.first("size").alias("size"), F.first("ring").alias("ring"))
    reps = materialize(reps.select("first", F.col("first.row").alias("node"), "size", "ring"), "reps")
    roots = connected_components(near_links(reps.drop("first"), rows, similarity, words, text), "a", "b")
    grouped = reps.select("first", "node").join(roots, "node", "left").select("first", F.coalesce("root", "node").alias("root"))
    stay = grouped.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias("_row"))
    return named(rows.join(stay, "_row", "left_semi").select(*docs.columns)).select(*columns)
