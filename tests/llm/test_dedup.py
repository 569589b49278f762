"""Near-duplicates, line dedup, components, and the pipeline: brute force and edge cases."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from ticktide.llm import linededup, simhash
from ticktide.llm.common import read
from ticktide.llm.components import connected_components


def groups(n, linked):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, j in linked:
        a, b = find(i), find(j)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def brute_fingerprint(text, words=3):
    parts = [p for p in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    if not parts:
        return 0
    shingles = [b" ".join(parts[i : i + words]) for i in range(len(parts) - words + 1)] or [b" ".join(parts)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(1, 40)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in connected_components(df, "a", "b").collect()}
    nodes = sorted({x for e in edges for x in e if e[0] != e[1]})
    place = {x: i for i, x in enumerate(nodes)}
    want = groups(len(nodes), [(place[a], place[b]) for a, b in edges if a != b])
    assert got == {x: nodes[want[i]] for i, x in enumerate(nodes)}
    assert connected_components(df.limit(0), "a", "b").count() == 0


def test_simhash_query(spark, sf):
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "one"), (-4, "ONE"), (-5, "one two"), (-6, "x " * 3000), (-7, "é z A\tB"), (-8, "One")], "doc_id long, text string")
    docs = read(spark, sf, "documents").select("doc_id", "text").unionByName(odd)
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    fps = [brute_fingerprint(t) for _, t in rows]
    want = groups(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 2])
    got = {r.doc_id: r for r in simhash.digest(docs).collect()}
    for i, (k, _) in enumerate(rows):
        assert got[k].fingerprint == f"{fps[i]:016x}" and got[k].component_id == rows[want[i]][0]


def test_simhash_links_lose_nothing(spark):
    rng = random.Random(5)
    fps = []
    for _ in range(60):
        fps.append(rng.getrandbits(64))
        for _ in range(rng.randint(0, 6)):
            x = fps[-1]
            for _ in range(rng.randint(0, 3)):
                x ^= 1 << rng.randrange(64)
            fps.append(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    got = dict(simhash.components(spark.createDataFrame(list(enumerate(signed)), "doc_id long, fp long")).select("doc_id", "component").collect())
    want = groups(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 2])
    assert [got[i] for i in range(len(fps))] == want


def test_keep_one_catches_near_copies_and_leaves_others(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    data, copies = [], 0
    for i in range(60):
        words = [word() for _ in range(rng.randint(150, 300))]
        data.append((10 * i, " ".join(words)))
        if i % 2 == 0:
            changed = list(words)
            changed[rng.randrange(len(words))] = "changed"
            data.append((10 * i + 1, " ".join(changed)))
            data.append((10 * i + 2, " ".join(words)))
            copies += 2
    data += [(None, data[0][1]), (5001, None), (5002, ""), (5000, " ")]
    df = spark.createDataFrame(data, "doc_id long, text string").withColumn("fp", F.lit("other"))
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [10 * i for i in range(60)] + [5000]
    assert simhash.keep_one(df.limit(0)).count() == 0


def brute_lines(docs, least):
    seen, out = set(), {}
    for k, t in docs:
        lines = t.split("\n")
        gone = set()
        for s in range(len(lines)):
            total = 0
            for e in range(s + 1, len(lines) + 1):
                total += len(lines[e - 1].encode().split())
                if total >= least:
                    run = tuple(lines[s:e])
                    if run in seen:
                        gone |= set(range(s, e))
                    seen.add(run)
        out[k] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


@pytest.mark.parametrize("least", [3, 12])
def test_line_dedup(spark, least):
    rng = random.Random(least)
    pool = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 4))) for _ in range(5)]
    docs = [(d, "\n".join(rng.choice(pool) if rng.random() < 0.8 else " ".join(rng.choice("abcdefghijk") for _ in range(5)) for _ in range(rng.randint(1, 20)))) for d in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.text for r in linededup.apply(df, min_words=least).collect()}
    assert got == brute_lines(docs, least)


def test_line_dedup_edges(spark):
    long = "\n".join(" ".join(f"w{i}{j}" for j in range(20)) for i in range(3))
    rows = [(None, long, 1), (1, None, 2), (2, "", 3), (3, long, 4), (3, long, 4), (4, "a b\n" * 40, 5), (5, long + "\nown line", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int")
    got = sorted(((r.doc_id, r.text, r.n) for r in linededup.apply(df).collect()), key=str)
    want = [(None, long, 1), (1, None, 2), (2, "", 3), (3, "", 4), (3, "", 4), (5, "own line", 6)]
    assert [g for g in got if g[0] != 4] == sorted(want, key=str)
    assert next(g for g in got if g[0] == 4)[1] == "a b\n"  # a run may overlap its own first copy
    dropped = linededup.apply(df, drop_emptied=True, counts=True).collect()
    assert sorted(str(r.doc_id) for r in dropped) == ["1", "2", "4", "5", "None"] and {r.doc_id: r.n_removed for r in dropped}[5] == 3
    assert linededup.apply(df.limit(0)).count() == 0


def test_windows_cover_runs():
    rng = np.random.default_rng(0)
    for _ in range(200):
        words = rng.integers(0, 6, int(rng.integers(1, 15)))
        start, length = linededup.windows(words, 7)
        total = np.concatenate(([0], np.cumsum(words)))
        assert all(total[s + n] - total[s] >= 7 for s, n in zip(start, length, strict=True))
        for s in range(len(words)):
            for e in range(s + 1, len(words) + 1):
                if total[e] - total[s] >= 7:
                    inside = [(a, a + n) for a, n in zip(start, length, strict=True) if s <= a and a + n <= e]
                    assert set(range(s, e)) == {i for a, b in inside for i in range(a, b)}


def test_pipeline_stages(spark, sf):
    docs = read(spark, sf, "documents")
    columns = docs.columns
    sizes = []
    for no, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        if no < 4:
            assert out.columns == columns
            docs = out.cache()
            sizes.append(docs.count())
    assert sizes[0] >= sizes[1] >= sizes[2] > 0
    rows = out.collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == sizes[3] and all(len(r.ids) == r.n_tokens for r in rows)
    import hashlib

    assert all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in rows)


def test_pipeline_keeps_clean_documents_and_drops_junk(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8)))
    clean = [(i, "\n".join(" ".join(word() for _ in range(30)) for _ in range(5)), "en", "s", 0) for i in range(30)]
    junk = [(100, "same words here again now " * 30, "en", "s", 0), (101, "short", "en", "s", 0), (102, None, "en", "s", 0)]
    df = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline.rules(spark, df, "").collect()}
    assert kept == set(range(30))
    lines = corpus_pipeline.lines(spark, df.where("doc_id < 100"), "")
    assert {r.doc_id: r.text for r in lines.collect()} == {r[0]: r[1] for r in clean}
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, lines, "").collect()} == set(range(30))
