"""Links of embeddings against all pairs: clusters tight and loose, odd vectors."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticktide.llm import embdedup

KIND = "vec_id long, embedding array<double>"


def brute(rows, cosine=0.9):
    """(n_links, least key reached) of each row by comparing every pair."""
    fine = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = {i: set() for i in range(len(rows))}
    for d in {len(rows[i][1]) for i in fine}:
        of = [i for i in fine if len(rows[i][1]) == d]
        u = np.array([np.array(rows[i][1]) / max(map(abs, rows[i][1])) for i in of])
        u /= np.linalg.norm(u, axis=1)[:, None]
        for a, b in zip(*np.nonzero(u @ u.T >= cosine), strict=True):
            if a != b:
                links[of[a]].add(of[b])
    out = []
    for i in range(len(rows)):
        reach, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - reach:
                reach.add(j)
                todo.append(j)
        keys = [rows[j][0] for j in reach if rows[j][0] is not None]
        out.append((len(links[i]), min(keys) if keys else None))
    return out


def clustered(seed, dim, spreads):
    rng, rows = np.random.RandomState(seed), []
    for spread in spreads:
        centre = rng.randn(dim)
        rows += [centre / np.linalg.norm(centre) + spread * rng.randn(dim) / math.sqrt(dim) for _ in range(40)]
    return [(i, v.tolist()) for i, v in enumerate(rows)]


@pytest.mark.parametrize(("seed", "dim"), [(1, 64), (2, 24), (3, 200)])
def test_links_against_all_pairs(spark, seed, dim):
    rows = clustered(seed, dim, [0.05, 0.15, 0.22, 0.28, 0.3, 0.33, 0.36, 0.4, 0.6, 3.0])
    got = {r.vec_id: (r.n_links, r.component_id) for r in embdedup.digest(spark.createDataFrame(rows, KIND)).collect()}
    want = {k: w for (k, _), w in zip(rows, brute(rows), strict=True)}
    assert all(got[k][0] <= want[k][0] for k in want)  # nothing below the cosine
    found, there = sum(x[0] for x in got.values()), sum(x[0] for x in want.values())
    assert there > 4_000 and found >= 0.99 * there


def test_pairs_at_the_cosine_are_found(spark):
    rng, rows = np.random.RandomState(9), []
    for i in range(600):
        x, g = rng.randn(64), rng.randn(64)
        x /= np.linalg.norm(x)
        g -= (g @ x) * x
        rows += [(2 * i, x.tolist()), (2 * i + 1, (0.905 * x + math.sqrt(1 - 0.905**2) * g / np.linalg.norm(g)).tolist())]
    got = embdedup.digest(spark.createDataFrame(rows, KIND)).where("n_links = 1 AND component_id = vec_id - vec_id % 2").count()
    assert got >= 0.95 * len(rows)


def test_odd_vectors(spark):
    rows = [(5, [1.0, 0.0]), (5, [1.0, 0.0]), (4, [1e200, 1e199]), (3, [1e-200, 0.0]), (2, None), (1, []), (0, [0.0, 0.0]), (7, [1.0, None]), (8, [math.nan, 1.0]), (9, [math.inf, 1.0]), (None, [0.0, 1.0]), (None, [0.1, 1.0]), (10, [1.0]), (11, [2.0]), (12, [0.01 * i for i in range(5_000)]), (13, [0.01 * i + 0.001 for i in range(5_000)])]
    df = spark.createDataFrame(rows, KIND).select("vec_id", "embedding", *(F.lit(1).alias(c) for c in ("u", "n", "cid", "ball", "_key", "kept", "n_links")))
    out = embdedup.links(df)
    assert out.columns == [*(c for c in df.columns if c not in ("kept", "n_links")), "component_id", "n_links", "kept"]
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in out.collect()), key=str)
    assert got == sorted(((k, n, c, k == c) for (k, _), (n, c) in zip(rows, brute(rows), strict=True)), key=str)
    assert embdedup.digest(df.limit(0)).count() == 0
