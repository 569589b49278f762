"""Embedding near-dedup: cross-polytope hashing after fast Hadamard rotations, several probes, checked pairs.

Equal vectors are one class. A rotated vector's bucket is its largest coordinate with its
sign, some of them joined to a code; each vector is stored in its bucket of every table and
also visits the next likeliest ones. Classes within ``TIGHT`` of a leader are its ball: all
links inside a ball hold by the triangle inequality and are counted, not listed, so a group
of copies costs its size and not its square. Balls that meet in a bucket are compared: by
their leaders where that decides, else vector by vector.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, materialize, set_aside
from .components import connected_components

#: Least cosine of a link.
COSINE = 0.9
#: Buckets of a table that each vector visits, its own first; tables for each function of a code.
PROBES, TABLES = 4, 4
#: Options of a function that probes choose from.
OPTIONS = 4
#: Bits of the sketch, and the most that differ in candidates of two single vectors: five deviations over the mean at a cosine of 0.9.
BITS, APART = 128, 40
#: The same for a class and its leader; one more only makes a ball smaller.
APART_TIGHT = 26
#: Slack of angles against rounding.
SLACK = 1e-9
_FOUND = "cid long, base array<long>, visits array<long>, s1 long, s2 long"


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of rows whose length is a power of two, norms kept."""
    x, h = x / math.sqrt(x.shape[1]), 1
    while h < x.shape[1]:
        y = x.reshape(len(x), -1, 2, h)
        left = y[:, :, 0].copy()
        y[:, :, 0] += y[:, :, 1]
        np.subtract(left, y[:, :, 1], out=y[:, :, 1])
        h *= 2
    return x


def rotated(x: np.ndarray, *seed: int) -> np.ndarray:
    """Three rounds of random signs and the transform: close to a random rotation."""
    rng = np.random.RandomState(np.array(seed, np.uint32))
    for _ in range(3):
        x = hadamard(x * rng.choice((-1.0, 1.0), x.shape[1]))
    return x


def widths(n: int, dim: int) -> list[int]:
    """Coordinates that each function of a code looks at: codes number about ``n``, the last function makes up the rest."""
    out, left = [], max(n, 2)
    while left > 1 and len(out) < 8:
        w = min(dim, 1 << max(0, math.ceil(math.log2(left)) - 1))
        out.append(w)
        left /= 2 * w
    return out


def probes(x: np.ndarray, table: int, looks: list[int], count: int) -> np.ndarray:
    """Codes of the ``count`` likeliest buckets of each row in a table, its own first."""
    code, cost = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
    for j, w in enumerate(looks):
        r = rotated(x, 1, table, j)[:, :w]
        both = np.concatenate((r, -r), 1)
        m = min(OPTIONS, 2 * w)
        top = np.argpartition(-both, m - 1, axis=1)[:, :m]
        value = np.take_along_axis(both, top, 1)
        order = np.argsort(-value, axis=1, kind="stable")
        top, value = np.take_along_axis(top, order, 1), np.take_along_axis(value, order, 1)
        code = (code[:, :, None] * (2 * w) + top[:, None, :]).reshape(len(x), -1)
        cost = (cost[:, :, None] + ((value[:, :1] - value) ** 2)[:, None, :]).reshape(len(x), -1)
        if code.shape[1] > count:
            best = np.argsort(cost, axis=1, kind="stable")[:, :count]
            code, cost = np.take_along_axis(code, best, 1), np.take_along_axis(cost, best, 1)
    return code


def sketch(x: np.ndarray) -> np.ndarray:
    """Signs of ``BITS`` rotated coordinates of each row, as two 64-bit integers."""
    bits = np.concatenate([rotated(x, 2, i) for i in range(-(-BITS // x.shape[1]))], 1)[:, :BITS] > 0
    return np.packbits(bits, axis=1).view(np.int64).reshape(len(x), 2)


def _hashed(classes: DataFrame, n: int) -> DataFrame:
    """Buckets and sketch of each class; vectors of other lengths never share a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cid, u = batch.column("cid").to_numpy(), batch.column("u")
            size = u.value_lengths().to_numpy()
            for dim in np.unique(size).tolist():
                pick = np.flatnonzero(size == dim)
                flat = u.take(pa.array(pick)).flatten().to_numpy(zero_copy_only=False).reshape(len(pick), dim)
                padded = np.zeros((len(pick), max(64, 1 << (dim - 1).bit_length())))
                padded[:, :dim] = flat
                looks = widths(n, padded.shape[1])
                tables = TABLES * len(looks)
                with np.errstate(over="ignore"):
                    found = np.stack([(probes(padded, t, looks, PROBES) * 64 + t) * 65_537 + dim for t in range(tables)], 1)
                marks = sketch(padded)
                base, visits = found[:, :, 0], found[:, :, 1:].reshape(len(pick), -1)
                yield pa.RecordBatch.from_arrays([pa.array(cid[pick]), pa.array(list(base), pa.list_(pa.int64())), pa.array(list(visits), pa.list_(pa.int64())), pa.array(marks[:, 0]), pa.array(marks[:, 1])], names=["cid", "base", "visits", "s1", "s2"])

    return classes.select("cid", "u").mapInArrow(run, _FOUND)


def _dot(a: str | Column, b: str | Column) -> Column:
    """Cosine of two unit vectors in double precision; below all others where lengths differ."""
    total = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return F.when(F.size(a) == F.size(b), total).otherwise(-2.0)


def _differing(a: str, b: str, c: str, d: str) -> Column:
    """Bits in which two sketches differ."""
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) + F.bit_count(F.col(c).bitwiseXOR(F.col(d)))


def _angle(cosine: str) -> Column:
    return F.acos(F.least(F.greatest(F.col(cosine), F.lit(-1.0)), F.lit(1.0)))


def unit_vectors(df: DataFrame, vector: str) -> DataFrame:
    """``df`` with ``u``: the vector over its norm in double precision; null where it is null, zero or not finite throughout."""
    x = F.col(vector)
    fine = x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    def once(value: Column, use: Callable[[Column], Column]) -> Column:
        """``use`` of a value that is computed once, and not anew for each entry of an array."""
        return F.transform(F.array(value), use)[0]

    most = F.array_max(F.transform(x, lambda v: F.abs(v.cast("double"))))
    norm = lambda s: F.sqrt(F.aggregate(s, F.lit(0.0), lambda a, v: a + v * v))
    # over the largest component first, so squares neither overflow nor vanish
    unit = once(most, lambda m: once(F.transform(x, lambda v: v.cast("double") / m), lambda s: once(norm(s), lambda n: F.transform(s, lambda v: v / n))))
    return df.withColumn("u", F.when(fine & (most > 0), unit))


def _balls(classes: DataFrame, hashed: DataFrame, tight: float) -> DataFrame:
    """(cid, ball, near): the leader of each class and the cosine to it; leaders lead themselves.

    Each bucket offers its least class; an offer counts from a cosine of ``tight`` on, and only
    from classes that take no offer themselves.
    """
    stored = hashed.select("cid", "s1", "s2", F.explode("base").alias("bucket"))
    least = stored.groupBy("bucket").agg(F.min(F.struct("cid", "s1", "s2")).alias("l"), F.count(F.lit(1)).alias("c")).where("c > 1").select(F.col("bucket").alias("_b"), F.col("l.cid").alias("lead"), F.col("l.s1").alias("t1"), F.col("l.s2").alias("t2"))
    close = _differing("s1", "t1", "s2", "t2") <= APART_TIGHT
    offers = stored.join(least.hint("merge"), (F.col("bucket") == F.col("_b")) & (F.col("lead") < F.col("cid")) & close).select("cid", "lead").distinct()
    own, led = classes.select("cid", "u"), classes.select(F.col("cid").alias("lead"), F.col("u").alias("v"))
    taken = offers.join(own.hint("merge"), "cid").join(led.hint("merge"), "lead").select("cid", "lead", _dot("u", "v").alias("near")).where(F.col("near") >= tight)
    taken = materialize(taken, "offers")
    led = taken.select(F.col("cid").alias("lead")).distinct()
    best = taken.join(led.hint("merge"), "lead", "left_anti").groupBy("cid").agg(F.min(F.struct("lead", "near")).alias("b"))
    return classes.select("cid").join(best.hint("merge"), "cid", "left").select("cid", F.coalesce("b.lead", "cid").alias("ball"), F.coalesce("b.near", F.lit(1.0)).alias("near"))


def _meeting(hashed: DataFrame, members: DataFrame, balls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(p, q), p < q: balls that meet in a bucket of one; those of two single vectors only with sketches close enough."""
    # only a leader can be alone in its ball, so the balls are joined to classes, one row each, and not to all members
    alone = balls.where("classes = 1").select(F.col("ball").alias("cid"), F.lit(True).alias("single"))
    rows = hashed.join(members.select("cid", "ball").hint("merge"), "cid").join(alone.hint("merge"), "cid", "left").withColumn("single", F.coalesce("single", F.lit(False)))
    stored = rows.select("ball", "single", "s1", "s2", F.explode("base").alias("bucket"), F.lit(True).alias("own"))
    visiting = rows.select("ball", "single", "s1", "s2", F.explode("visits").alias("bucket"), F.lit(False).alias("own"))
    seen = stored.unionByName(visiting).groupBy("bucket", "ball").agg(F.max("own").alias("own"), F.first("single").alias("single"), F.min("s1").alias("s1"), F.min("s2").alias("s2"))
    seen = materialize(seen, "buckets")
    a, b = seen.where("own").alias("a"), seen.alias("b")
    close = _differing("a.s1", "b.s1", "a.s2", "b.s2") <= APART
    met = a.join(b.hint("merge"), (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.ball") != F.col("b.ball")) & (close | ~F.col("a.single") | ~F.col("b.single")))
    return materialize(met.select(F.least("a.ball", "b.ball").alias("p"), F.greatest("a.ball", "b.ball").alias("q")).distinct(), "met"), seen


def links(df: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """``df`` with n_links, component_id and kept: links of cosine ``cosine`` or more, found by hashing, all of them checked.

    Each row is a vector of its own, also where keys or vectors are repeated; equal vectors
    are linked. component_id is the least key that links reach, null only if all keys there are
    null; kept tells whether it is the row's own. Vectors that are null, empty or zero, or hold null
    or non-finite components, and those of another length, link with nothing. A vector of any
    length is held once. An empty table gives no rows; other columns may have any names.
    """
    df, named = set_aside(df.drop("n_links", "component_id", "kept"), key, vector)
    rows = materialize(unit_vectors(df.withColumnsRenamed({key: "_key", vector: "_vector"}), "_vector"), "vectors")
    classes = rows.where("u IS NOT NULL").groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.min("_key").alias("least"))
    classes = materialize(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    hashed = materialize(_hashed(classes, classes.count()), "hashes")

    limit = math.acos(cosine)
    # two members are within twice a ball's radius of each other
    members = materialize(_balls(classes, hashed, math.cos(limit / 2 - SLACK)).join(classes.hint("merge"), "cid"), "members")
    balls = members.groupBy("ball").agg(F.sum("n").alias("size"), F.count(F.lit(1)).alias("classes"), F.min("near").alias("near"), F.min("least").alias("least"))
    balls = balls.withColumn("radius", F.when(F.col("classes") == 1, 0.0).otherwise(_angle("near") + SLACK)).join(classes.select(F.col("cid").alias("ball"), "u").hint("merge"), "ball")
    balls = materialize(balls.select("ball", "size", "classes", "radius", "least", "u"), "balls")
    met, seen = _meeting(hashed, members, balls)
    forget(hashed, seen)

    left = balls.select(F.col("ball").alias("p"), F.col("u").alias("u"), F.col("radius").alias("rp"), F.col("size").alias("np"))
    right = balls.select(F.col("ball").alias("q"), F.col("u").alias("v"), F.col("radius").alias("rq"), F.col("size").alias("nq"))
    pairs = met.join(left.hint("merge"), "p").join(right.hint("merge"), "q").select("p", "q", "rp", "rq", "np", "nq", _dot("u", "v").alias("cos"))
    both, apart = F.col("rp") + F.col("rq"), _angle("cos")
    verdict = (
        F.when(both == 0, F.when(F.col("cos") >= cosine, "all")).when(apart + both <= limit - SLACK, "all").when(apart <= limit + both + SLACK, "some")
    )
    pairs = materialize(pairs.withColumn("verdict", verdict).where("verdict IS NOT NULL"), "pairs")
    forget(met)

    def directed(kind: str) -> DataFrame:
        one = pairs.where(F.col("verdict") == kind)
        return one.select("p", "q", "rq", "nq").unionByName(one.select(F.col("q").alias("p"), F.col("p").alias("q"), F.col("rp").alias("rq"), F.col("np").alias("nq")))

    more = directed("all").groupBy(F.col("p").alias("ball")).agg(F.sum("nq").alias("more"))
    # where leaders don't decide: each vector of the one with the leader of the other, then with its vectors
    some = directed("some").join(members.select(F.col("ball").alias("p"), "cid", F.col("u").alias("x")), "p").join(right.select("q", "v"), "q")
    some = some.select("p", "q", "cid", "x", "rq", "nq", _dot("x", "v").alias("cos"))
    some = materialize(some.where(_angle("cos") <= limit + F.col("rq") + SLACK), "some")
    whole = (F.col("rq") > 0) & (_angle("cos") + F.col("rq") <= limit - SLACK)
    there = members.select(F.col("ball").alias("q"), F.col("u").alias("y"), "n")
    each = some.where(~whole).join(there, "q").where(_dot("x", "y") >= cosine).groupBy("cid", "p", "q").agg(F.sum("n").alias("n"))
    further = materialize(some.where(whole).select("cid", "p", "q", F.col("nq").alias("n")).unionByName(each), "further")
    forget(some)

    edges = pairs.where("verdict = 'all'").select("p", "q").unionByName(further.select("p", "q").distinct())
    roots = connected_components(edges, "p", "q").select(F.col("node").alias("ball"), "root")
    rooted = materialize(balls.select("ball", "size", "least").join(roots.hint("merge"), "ball", "left").withColumn("root", F.coalesce("root", "ball")), "rooted")
    reached = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_ball = rooted.join(reached.hint("merge"), "root").join(more.hint("merge"), "ball", "left").select("ball", "component_id", (F.col("size") - 1 + F.coalesce("more", F.lit(0))).alias("inside"))
    of_class = members.select("cid", "ball", "u").join(of_ball.hint("merge"), "ball").join(further.groupBy("cid").agg(F.sum("n").alias("beyond")).hint("merge"), "cid", "left")
    of_class = of_class.select("u", "component_id", (F.col("inside") + F.coalesce("beyond", F.lit(0))).alias("n_links"))
    of_class = materialize(of_class, "linked")
    out = rows.join(of_class.hint("merge"), "u", "left").drop("u")
    out = out.withColumns({"component_id": F.when(F.col("n_links").isNull(), F.col("_key")).otherwise(F.col("component_id")), "n_links": F.coalesce("n_links", F.lit(0)).cast("long")})
    out = out.withColumn("kept", F.col("_key").eqNullSafe(F.col("component_id")))
    return named(out.withColumnsRenamed({"_key": key, "_vector": vector}))


def digest(embeddings: DataFrame) -> DataFrame:
    """One row per vector of ``embeddings``: its links and its component; nulls, repeats, ties and other columns as in ``links``."""
    return links(embeddings.select("vec_id", "embedding")).select("vec_id", "n_links", "component_id", "kept")
