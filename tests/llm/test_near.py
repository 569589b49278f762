"""The pipeline's near-duplicate stage against brute force over all pairs."""

import random

import numpy as np
import pytest

from ticktide.llm import simhash
from ticktide.llm.components import connected_components

from .test_dedup import groups


def corpus():
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    passage = [word() for _ in range(40)]  # stands in very many texts
    texts = []
    for i in range(70):
        base = [word() for _ in range(rng.randint(6, 220))]
        if i % 2:
            base[3:3] = passage
        texts.append(base)
        for _ in range(i % 7):  # copies on both sides of the threshold
            changed = list(base)
            for _ in range(rng.randint(1, max(1, len(base) // 30))):
                changed[rng.randrange(len(changed))] = word()
            texts.append(changed)
    hot = [word() for _ in range(120)]
    for _ in range(150):
        changed = list(hot)
        for _ in range(rng.randint(1, 3)):
            changed[rng.randrange(len(hot))] = word()
        texts.append(changed)
    texts = [" ".join(t) for t in texts]
    rng.shuffle(texts)
    return texts


def brute(texts, similarity=0.8):
    sets = []
    for t in texts:
        p = t.lower().split()
        sets.append({" ".join(p[i : i + 5]) for i in range(max(1, len(p) - 4))})
    return [(i, j) for i in range(len(sets)) for j in range(i) if len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]) - 1e-9]


def described(spark, texts):
    rows = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "_key long, _row long, _text string")
    made = simhash._described(rows, 5).withColumnRenamed("_row", "node").select("node", "size", "ring")
    return made, rows.select("_row", rows["_text"].alias("text"))


@pytest.mark.parametrize("cell", [8, 2048])
def test_near_copies_are_the_pairs_of_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(simhash, "CELL", cell)  # one rule, whatever a group's size
    texts = corpus()
    pairs = brute(texts)
    want = groups(len(texts), pairs)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r.doc_id for r in simhash.keep_one(df).collect()}
    assert kept == set(want) and len(kept) < len(texts) - 100
    reps, rows = described(spark, texts)
    links = simhash.near_links(reps, rows, 0.8, 5, "text")
    assert {(max(r.a, r.b), min(r.a, r.b)) for r in links.collect()} <= set(pairs)  # nothing but what the exact check passes
    found = dict(connected_components(links, "a", "b").collect())
    assert [found.get(i, i) for i in range(len(texts))] == want


def test_recall_from_the_threshold_on(spark):
    rng = random.Random(4)
    texts = []
    for i in range(700):
        base = [rng.choice("abcdefghijklmnop") + str(rng.randrange(5000)) for _ in range(rng.choice((60, 150, 400)))]
        changed = list(base)
        for at in rng.sample(range(len(base)), max(1, round(len(base) * rng.uniform(0.008, 0.026)))):
            changed[at] = f"x{i}-{at}"
        texts += [" ".join(base), " ".join(changed)]
    sets = [{tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for t in texts]
    truth = {}
    for i in range(0, len(texts), 2):
        both = len(sets[i] & sets[i + 1])
        truth[i] = both / (len(sets[i]) + len(sets[i + 1]) - both)
    reps, rows = described(spark, texts)
    links = {(r.a, r.b) for r in simhash.near_links(reps, rows, 0.8, 5, "text").collect()}
    for lo, hi in ((0.8, 0.82), (0.82, 0.85), (0.85, 0.9)):
        some = [i for i, j in truth.items() if lo <= j < hi]
        assert len(some) > 40 and sum((i, i + 1) in links for i in some) / len(some) >= 0.97, (lo, len(some))
    assert not any((i, i + 1) in links for i, j in truth.items() if j < 0.8 - 1e-9)


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(12)
    for n in (6, 40, 150, 3000):
        off, kept = [], 0
        for _ in range(300):
            h = rng.integers(0, 2**64, 2 * n, np.uint64)
            both = round(n * 16 / 18)
            a, b = h[:n], np.concatenate((h[:both], h[n : 2 * n - both]))
            true = both / (2 * n - both)
            got = simhash.estimated(simhash.sketch(a)[None], simhash.sketch(b)[None], 0.8)[0]
            kept += got >= 0
            off.append(max(got, 0) - true)
        assert kept >= (299 if true >= 0.8 else 280) and abs(np.mean(off)) < 0.03, n
    h = rng.integers(0, 2**64, 800, np.uint64)
    assert simhash.estimated(simhash.sketch(h[:400])[None], simhash.sketch(h[200:600])[None], 0.8)[0] == -1
    assert not simhash.sketch(h[:0]).any()


def test_ring_positions_are_equal_as_often_as_sets_are_similar():
    rng = np.random.default_rng(9)
    for similarity in (0.5, 0.8):
        n = 400
        shared = round(n * 2 * similarity / (1 + similarity))
        equal = []
        for _ in range(300):
            h = rng.integers(0, 2**64, 2 * n, np.uint64)
            equal.append((simhash.ring(h[:n]) == simhash.ring(np.concatenate((h[:shared], h[n : 2 * n - shared])))).mean())
        assert abs(np.mean(equal) - similarity) < 0.02 and abs(np.var(equal) * simhash.POSITIONS - similarity * (1 - similarity)) < 0.05
    assert (simhash.ring(np.zeros(0, np.uint64)) == 2**32 - 1).all()
    h = rng.integers(0, 2**64, 40000, np.uint64)
    assert (simhash.ring(h) == np.minimum(simhash.ring(h[:123]), simhash.ring(h[123:]))).all()
