"""Conversation repair: the survivors against all paths, the stream against ranges, odd rows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ticktide.llm import turnrepair
from ticktide.llm.turnrepair import CLOSING, STATES, STEPS, Survivors

KIND = "conv_id long, turn long, role string, text string"


def all_paths(kinds):
    """Least (cost, letters) over every path, none dropped on the way."""
    paths = {(0, 0, "")}
    for k in kinds:
        paths = {(t, c + d, w + x) for s, c, w in paths for t in STATES for s0, d, x in STEPS[k][t] if s0 == s}
    return min((c + CLOSING[s][0], w + CLOSING[s][1]) for s, c, w in paths)


def test_survivors_give_the_least_of_all_paths():
    rng = random.Random(5)
    for _ in range(400):
        kinds = []
        for _ in range(rng.randint(0, 6)):
            must = rng.random() < 0.3
            kinds.append((rng.choice("sua?"), must, not must and rng.random() < 0.3))
        paths, given = Survivors(0), ""
        for k in kinds:
            paths.push(STEPS[k])
            given += paths.settled()
        cost, rest = paths.close()
        assert (cost, given + rest) == all_paths(kinds), kinds


def test_settled_nodes_are_forgotten():
    paths, given = Survivors(0), 0
    for i in range(20_000):
        paths.push(STEPS["ua"[i % 2], False, False])
        given += len(paths.settled())
        if i % 1000 == 999:
            assert all(len(paths._open(node)) < 50 for _, node in paths.live.values())
    assert given > 19_900


@pytest.fixture(scope="module")
def talks(spark):
    rng = random.Random(3)
    rows = [(-100 - i, t if rng.random() < 0.9 else None, rng.choice(["system", "user", "assistant", "tool", "", None]), rng.choice(["a.", "b.", "c", "", "d!", " e? ", None])) for i in range(60) for t in range(rng.randint(1, 14))]
    rows += [(None, None, None, None), (None, None, None, None), (-7, 0, "assistant", "Hi."), (-7, 0, "assistant", "Hi."), (-8, 0, "user", "long " * 200_000 + "."), (-8, 1, "assistant", "x." * 300_000)]
    df = spark.createDataFrame(rows, KIND)
    for c in ("seg", "kind", "_first", "times", "size", "n"):
        df = df.withColumn(c, F.lit(1))
    return df.cache()


def test_ranges_give_what_the_stream_gives(spark, talks):
    whole = {r.conv_id: tuple(r) for r in turnrepair.digest(talks).collect()}
    parts = {r.conv_id: tuple(r) for r in turnrepair.digest(talks, split=3).collect()}
    assert whole == parts and len(whole) == 63


def test_repaired_conversations_alternate(spark, talks):
    for split in (turnrepair.SPLIT, 4):
        rows = turnrepair.repair(talks, split=split).orderBy("conv_id", "seg", "n").collect()
        by = {}
        for r in rows:
            by.setdefault(r.conv_id, []).append(r)
        for c, edits in by.items():
            roles = "".join(e.role[0] for e in edits if e.edit != "D")
            body = roles[1:] if roles.startswith("s") else roles
            assert body == "ua" * (len(body) // 2) and (roles in ("", body) or body), c
            assert all(e.edit != "K" or e.fault not in ("blank", "duplicate") for e in edits)
        assert {e.edit for e in by[None]} == {"D"} and "".join(e.edit for e in by[-8]) == "KK"
        assert "".join(e.edit for e in by[-7]) in ("DD",)


def test_no_rows(spark, talks):
    assert turnrepair.digest(talks.limit(0)).count() == 0 and turnrepair.repair(talks.limit(0)).count() == 0
    gone = turnrepair.digest(spark.createDataFrame([(0, t, "user", "x.") for t in range(400)], KIND).where((F.crc32(F.concat_ws(":", "conv_id", "turn")) % 20) == 0)).collect()
    assert [tuple(r) for r in gone] == [(0, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
