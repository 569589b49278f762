"""Approximate nearest neighbours by learned partitions.

A neighbour graph over a bounded sample is cut into balanced parts; a small classifier
learns to tell a vector's part. It places every vector of the table, and sends each query
to its several most probable parts, where distances are computed exactly.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Vectors that the graph and the classifier are fitted on at most, those of smallest hash.
SAMPLE = 8192
#: Parts of the graph at least (powers of two), vectors that a part should hold, vectors of the sample that a part needs; neighbours in the graph.
PARTS, PER_PART, FITTED, DEGREE = 16, 100_000, 128, 10
#: Recall on held-out vectors of the sample that the number of visited parts must give.
TARGET = 0.96
#: Numbers in the vectors and in the queries that meet in one task, about; queries whose distances are held at once.
BLOCK, QUERY_BLOCK, AT_ONCE = 6_400_000, 1_048_576, 32
HIDDEN, EPOCHS, SEED = 128, 40, 7


def usable(v: Column) -> Column:
    """Vectors that take part: not null, not zero, every component finite."""
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def neighbour_graph(x: np.ndarray, degree: int) -> np.ndarray:
    """Indices of each vector's nearest others, by blocks of rows."""
    square, out = (x * x).sum(1), []
    degree = min(degree, len(x) - 1)
    for lo in range(0, len(x), 1024):
        d = square[lo : lo + 1024, None] + square - 2 * x[lo : lo + 1024] @ x.T
        d[np.arange(len(d)), np.arange(lo, lo + len(d))] = np.inf
        out.append(np.argpartition(d, degree - 1, 1)[:, :degree])
    return np.concatenate(out)


def balanced_parts(graph: np.ndarray, parts: int, rng: np.random.Generator, slack: float = 1.05, rounds: int = 12) -> np.ndarray:
    """Cut the graph into ``parts`` (a power of two) of about equal size.

    Recursive bisection at the median of the slowest-mixing vector of the walk on the
    graph, then refinement: a node moves to the part that holds most of its neighbours
    as long as that part has room.
    """
    n, degree = graph.shape
    source, target = np.repeat(np.arange(n), degree), graph.ravel()
    label = np.zeros(n, np.int64)
    groups = 1
    while groups < parts:
        same = label[source] == label[target]
        a, b = source[same], target[same]
        size = np.bincount(a, minlength=n) + np.bincount(b, minlength=n) + 1.0
        v = rng.standard_normal(n)
        for _ in range(60):
            v -= (np.bincount(label, v * size, groups) / np.bincount(label, size, groups))[label]
            v = 0.5 * v + 0.5 * (v + np.bincount(a, v[b], n) + np.bincount(b, v[a], n)) / size
            v /= np.sqrt(np.bincount(label, v * v, groups))[label] + 1e-12
        order = np.lexsort((v, label))
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        count = np.bincount(label, minlength=groups)
        upper = place - (np.cumsum(count) - count)[label] >= (count[label] + 1) // 2
        label, groups = 2 * label + upper, 2 * groups
    room = int(np.ceil(slack * n / parts))
    for _ in range(rounds):
        votes = np.zeros((n, parts))
        np.add.at(votes, (source, label[target]), 1)
        np.add.at(votes, (target, label[source]), 1)
        best = votes.argmax(1)
        gain = votes[np.arange(n), best] - votes[np.arange(n), label]
        size, moved = np.bincount(label, minlength=parts), 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[best[i]] < room:
                size[label[i]] -= 1
                size[best[i]] += 1
                label[i] = best[i]
                moved += 1
        if not moved:
            break
    return label


class Router:
    """A classifier with one hidden layer: probabilities of the parts."""

    def __init__(self, x: np.ndarray, wanted: np.ndarray, rng: np.random.Generator):
        self.mean, self.scale = x.mean(0), x.std(0).mean() + 1e-12
        z = (x - self.mean) / self.scale
        shapes = ((x.shape[1], HIDDEN), (HIDDEN,), (HIDDEN, wanted.shape[1]), (wanted.shape[1],))
        self.w = [rng.standard_normal(s) / np.sqrt(s[0]) if len(s) == 2 else np.zeros(s) for s in shapes]
        m, v, step = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes], 0
        for epoch in range(EPOCHS):
            order = rng.permutation(len(z))
            rate = 2e-3 * (1 - epoch / EPOCHS) + 1e-4
            for lo in range(0, len(z), 256):
                rows = order[lo : lo + 256]
                h = np.maximum(0, z[rows] @ self.w[0] + self.w[1])
                g = (self._softmax(h @ self.w[2] + self.w[3]) - wanted[rows]) / len(rows)
                gh = (g @ self.w[2].T) * (h > 0)
                step += 1
                for i, grad in enumerate((z[rows].T @ gh, gh.sum(0), h.T @ g, g.sum(0))):
                    m[i] = 0.9 * m[i] + 0.1 * grad
                    v[i] = 0.999 * v[i] + 0.001 * grad * grad
                    self.w[i] -= rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)

    @staticmethod
    def _softmax(s: np.ndarray) -> np.ndarray:
        e = np.exp(s - s.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.scale
        return self._softmax(np.maximum(0, z @ self.w[0] + self.w[1]) @ self.w[2] + self.w[3])


def fit(x: np.ndarray, parts: int = PARTS, target: float = TARGET, seed: int = SEED) -> tuple[Router, int]:
    """(router, probes): trained on a sample; targets are a neighbourhood's shares in the parts.

    An eighth of the sample is held out of the training. Its neighbours in the sample tell
    how many parts a query must visit for ``target`` recall: few where the vectors have
    structure, most of them where they are as good as random.
    """
    rng = np.random.default_rng(seed)
    if len(x) < 8 * parts:  # too few to cut: one part
        return Router(x, np.ones((len(x), 1)), rng), 1
    held = rng.permutation(len(x)) < len(x) // 8
    seen = x[~held]
    graph = neighbour_graph(seen, DEGREE)
    label = balanced_parts(graph, parts, rng)
    wanted = np.zeros((len(seen), parts))
    np.add.at(wanted, (np.repeat(np.arange(len(seen)), graph.shape[1]), label[graph].ravel()), 0.5 / graph.shape[1])
    wanted[np.arange(len(seen)), label] += 0.5
    router = Router(seen, wanted, rng)
    p = router(x)
    near = neighbour_graph(x, DEGREE)[held]
    place = np.argsort(np.argsort(-p[held], 1, kind="stable"), 1)  # of each part among those visited
    visited = np.take_along_axis(place, p.argmax(1)[near], 1)
    reached = [(visited < n).mean() for n in range(1, parts + 1)]
    return router, 1 + int(np.argmax(np.array(reached) >= target))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def _routed(vectors: DataFrame, router: Router, probes: int, width: int) -> DataFrame:
    """(vec_id, embedding, parts): the most probable parts of each vector, best first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                p = router(_matrix(batch.column("embedding"), width))
                best = np.argsort(-p, 1, kind="stable")[:, :probes].astype(np.int32)
                offsets = pa.array(np.arange(0, best.size + 1, best.shape[1]), pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("embedding"), pa.ListArray.from_arrays(offsets, pa.array(best.ravel()))], names=["vec_id", "embedding", "parts"])

    return vectors.mapInArrow(run, "vec_id long, embedding array<double>, parts array<int>")


def nearest(queries: np.ndarray, ids: np.ndarray, candidates: np.ndarray, own: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(ids, distances) of each query's k nearest candidates, ties to the smaller id, its own id left out.

    Products of matrices find who may be among them, with a margin for their rounding;
    the distances themselves are sums of squared differences.
    """
    square, out = (candidates * candidates).sum(1), []
    for lo in range(0, len(queries), AT_ONCE):
        q = queries[lo : lo + AT_ONCE]
        size = (q * q).sum(1)
        rough = size[:, None] + square - 2 * q @ candidates.T
        margin = 1e-9 * (size + square.max(initial=0.0))
        for i in range(len(q)):
            others = ids != own[lo + i]
            n = int(others.sum())
            if not n:
                out.append((ids[:0], square[:0]))
                continue
            row = np.where(others, rough[i], np.inf)
            kth = np.partition(row, k - 1)[k - 1] if n > k else np.inf
            near = np.flatnonzero(others & (row <= kth + 2 * margin[i]))
            d = np.sqrt(((candidates[near] - q[i]) ** 2).sum(1))
            best = np.lexsort((ids[near], d))[:k]
            out.append((ids[near][best], d[best]))
    return out


def _fitted(sample: DataFrame, width: int, parts: int, target: float) -> tuple[Router, int]:
    """``fit`` in one task on an executor; only the small model comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = np.concatenate([np.zeros((0, width)), *(_matrix(b.column("embedding"), width) for b in batches)])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(x, parts, target))], pa.binary())], names=["model"])

    return pickle.loads(sample.coalesce(1).mapInArrow(run, "model binary").first()["model"])


def parts_for(n: int, sample: int = SAMPLE) -> int:
    """How many parts a table of ``n`` vectors has: they grow with it, as far as the sample can tell them apart."""
    wanted = max(PARTS, n // PER_PART, 1)
    return 1 << max(0, min(wanted, max(PARTS, sample // FITTED)).bit_length() - 1)


def search(table: DataFrame, is_query: Column, k: int = 10, parts: int | None = None, target: float = TARGET, sample: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's nearest vectors found, nearest first.

    ``table`` has vec_id and embedding. Candidates are all usable vectors but those of the
    query's own id; score is the Euclidean distance in double precision, ties go to the
    smaller vec_id. Rows without an id, unusable vectors and vectors of another dimension
    than the most frequent one take no part; rows that repeat a query's id make one query
    (the least vector). Fewer candidates than ``k`` in the visited parts give fewer rows.
    The fit uses at most ``sample`` vectors; all are indexed. The parts' number grows with the
    table. A part is met block by block: a block of its vectors by a block of the
    queries that visit it, so no task holds a whole part.
    """
    clean = table.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    sizes = clean.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    spark = table.sparkSession
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = sizes[0]["d"]
    clean = clean.where(F.size("embedding") == width)
    chosen = clean.orderBy(F.xxhash64("vec_id", "embedding"), "vec_id").limit(sample).select("embedding")
    router, probes = _fitted(chosen, width, parts or parts_for(sizes[0]["count"], sample), target)
    routed = materialize(_routed(clean, router, probes, width), "routed")
    index = routed.select("vec_id", "embedding", F.element_at("parts", 1).alias("part"))
    queries = materialize(routed.where(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(F.min(F.struct("embedding", "parts")).alias("q")), "queries")
    sent = queries.select("query_id", F.col("q.embedding").alias("embedding"), F.explode("q.parts").alias("part"))
    # a row a part
    blocks = index.groupBy("part").agg(F.ceil(F.count(F.lit(1)) * width / BLOCK).cast("int").alias("blocks")).join(sent.groupBy("part").agg(F.ceil(F.count(F.lit(1)) * width / QUERY_BLOCK).cast("int").alias("query_blocks")), "part")
    blocks = F.broadcast(materialize(blocks, "blocks"))
    deal = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    sent = sent.join(blocks, "part").select("query_id", "embedding", "part", each("blocks").alias("block"), deal("query_id", "query_blocks").alias("query_block"))
    held = index.join(blocks, "part").select("vec_id", "embedding", "part", deal("vec_id", "blocks").alias("block"), each("query_blocks").alias("query_block"))

    def met(left: pa.Table, right: pa.Table) -> pa.Table:
        found, own = [], np.zeros(0, np.int64)
        if left.num_rows and right.num_rows:
            own = left.column("query_id").to_numpy()
            q, c = (_matrix(t.column("embedding").combine_chunks(), width) for t in (left, right))
            found = nearest(q, right.column("vec_id").to_numpy(), c, own, k)
        ids, far = (np.concatenate([np.zeros(0, t), *(f[i] for f in found)]) for i, t in ((0, np.int64), (1, np.float64)))
        return pa.table({"query_id": pa.array(np.repeat(own, [len(i) for i, _ in found]), pa.int64()), "vec_id": pa.array(ids, pa.int64()), "score": pa.array(far, pa.float64())})

    keys = ("part", "block", "query_block")
    pairs = sent.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(met, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def digest(table: DataFrame) -> DataFrame:
    """The queries are the rows whose vec_id is divisible by 100."""
    return search(table, F.col("vec_id") % 100 == 0)
