"""Words one edit apart: the walk over sorted lists against all pairs, dealt lists, odd texts."""

import random

import numpy as np
from pyspark.sql import functions as F

from ticktide.llm import spelling
from ticktide.llm.spelling import Words, near_pairs


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def test_near_pairs_are_all_pairs_one_edit_apart():
    rng = random.Random(2)
    for _ in range(40):
        words, group, first = [], [], []
        for g in range(rng.randint(1, 8)):
            f, most = rng.randint(0, 3), rng.randint(5, 9)
            some = sorted({"abc"[:f] + "".join(rng.choice("abé"[: rng.randint(2, 3)]) for _ in range(rng.choice((most, most - 1)) - f)) for _ in range(rng.randint(1, 60))})
            words, group, first = words + some, group + [g] * len(some), first + [f] * len(some)
        a, b = near_pairs(Words(words), np.array(group), np.array(first))
        want = [(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if group[i] == group[j] and one_edit(words[i], words[j])]
        assert sorted(zip(a.tolist(), b.tolist(), strict=True)) == want


def brute(counts):
    near = {w: sorted((-m, v) for v, m in counts.items() if one_edit(w, v)) for w in counts}
    form = {w: x[0][1] if x and -x[0][0] >= 10 * counts[w] else None for w, x in near.items()}
    out = {}
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None)
    return out


def test_lists_dealt_over_blocks_give_the_same(spark):
    rng = random.Random(4)
    words = {"same" + "".join(rng.choice("ab") for _ in range(6)) + e for e in ("", "x", "xy") for _ in range(60)} | {"abcdefg", "abcdefgh", "bcdefgh", "ab" * 4_000, "ab" * 4_000 + "c"}
    counts = {w: rng.choice((2, 3, 30, 400, 5000)) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    want = brute(counts)
    for size in (spelling.LIST, 8):
        got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.group(df, size).collect()}
        assert got == want


def test_odd_texts(spark):
    rows = [(1, "Straßen straßen STRAßEN Straszen"), (1, "Straßen straßen STRAßEN Straszen"), (None, "naïveté naïveté éÉéÉéÉé éÉéÉéÉé"), (3, None), (4, ""), (5, "short words of no use 123"), (6, "Zzzzzzzzz " * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit(2))
    got = {r.word: r.n for r in spelling.vocabulary(df).collect()}
    assert got == {"straßen": 6, "straszen": 2, "naïveté": 2, "éÉéÉéÉé": 2, "zzzzzzzzz": 100_000}
    assert spelling.digest(df).count() > 0 and spelling.digest(df.limit(0)).count() == 0
