"""Selection under several budgets against a walk in order; digests of sets of any size."""

import hashlib
import random

from pyspark.sql import functions as F

from ticktide.operators import budget, digests


def walk(rows, money, items, purses):
    out = {}
    for place, venue, cost in sorted(rows):
        why = "over_count" if items <= 0 else "over_budget" if cost > money else "over_venue_budget" if cost > purses.get(venue, -1) else None
        if why is None:
            money, items, purses[venue] = money - cost, items - 1, purses[venue] - cost
        out[place] = (why is None, why)
    return out


def test_rounds_equal_a_walk_in_order(spark):
    rng, rows, runs, purses, want = random.Random(8), [], [], [], {}
    for run in range(6):
        mine = [(i, rng.choice("ab" if run else "abc"), rng.randint(0, 40 if run % 2 else 9)) for i in range(120)]
        money, items, own = rng.randint(0, 400), rng.choice((5, 40, 500)), {v: rng.randint(0, 250) for v in "ab"}
        rows += [(run, *r) for r in mine]
        runs.append((run, money, items))
        purses += [(run, v, b) for v, b in own.items()]
        want[run] = walk(mine, money, items, own)
    df = spark.createDataFrame(rows, "run long, place long, venue string, cost long")
    out = budget.greedy(df, "run", ["place"], "cost", spark.createDataFrame(runs, "run long, budget long, items long"), "venue", spark.createDataFrame(purses, "run long, venue string, budget long"))
    got = {}
    for r in out.collect():
        got.setdefault(r.run, {})[r.place] = (r.selected, r.allocation)
    assert got == want


def test_a_million_keys_in_one_group(spark):
    df = spark.range(1_000_000, numPartitions=8).select(F.lit("all").alias("k"), F.col("id").cast("string").alias("v"))
    one = digests.tiered_digest(df, ["k"], "v").first()
    again = digests.tiered_digest(df.unionByName(df.limit(1000)).repartition(13, "v"), ["k"], "v").first()
    assert one.members == again.members == 1_000_000 and one.digest == again.digest
    assert digests.tiered_digest(df.where("v <> '77'"), ["k"], "v").first().digest != one.digest


def by_hand(values, leaf, fan):
    sha = lambda xs: hashlib.sha256("\n".join(xs).encode()).hexdigest()
    values = sorted(set(values))
    bits = ((len(values) - 1) // leaf).bit_length() if len(values) > leaf else 0
    leaves = {}
    for v in values:
        leaves.setdefault(int(hashlib.sha256(v.encode()).hexdigest()[:15], 16) >> (60 - bits), []).append(v)
    hashes = {k: sha(v) for k, v in leaves.items()}
    if bits == 0:
        return hashes.get(0, sha([]))
    nodes = {}
    for k in sorted(hashes):
        nodes.setdefault(k >> fan, []).append(hashes[k])
    up = [sha(nodes[k]) for k in sorted(nodes)]
    return sha(up) if bits > fan else up[0]


def test_tiers(spark):
    for n, leaf, fan in ((0, 4, 2), (3, 4, 2), (4, 4, 2), (5, 4, 2), (16, 4, 2), (17, 4, 2), (900, 4, 2), (900, 4, 12)):
        values = [f"v{i}" for i in range(n)]
        df = spark.createDataFrame([("k", v) for v in [*values, *values[:3], None]], "k string, v string")
        assert digests.tiered_digest(df, ["k"], "v", leaf, fan).first().digest == by_hand(values, leaf, fan), n
