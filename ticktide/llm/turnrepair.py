"""Conversation structure repair: the cheapest edits that give alternating turns, by Viterbi.

Four states tell what a repaired conversation may go on with. Each row takes every state to
every other by inserts, then a keep, a new role or a deletion; of equally cheap paths the
one whose letters are least in ASCII survives. Survivors are leaves of a tree of back
pointers whose nodes count their children: once all survivors share an ancestor, the edits
up to it are settled, given out and forgotten, so a conversation is read as a stream. Ties
compare the whole letters that are not yet settled.

Conversations of over ``SPLIT`` rows are cut into ranges of rows. A range is solved for each
state it may begin in; the costs, and the ranks of the letters, of a conversation's ranges
are put together by the same rule, and then each range is read once more with its states.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, materialize, set_aside

#: Rows of a conversation beyond which it is cut into ranges.
SPLIT = 20_000
#: Costs of the edits, and of a row without an end that stays.
REROLE, DELETE, INSERT, CUT = 1, 2, 5, 5
#: States: nothing yet, after system, after user, after assistant; the first and the last may end.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
_BLANKS = "\x20\t\n\x0b\x0c\r"
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _next(state: int) -> tuple[int, str]:
    """The state and the role of a row that is inserted or gets a new role in ``state``."""
    return (ASSISTANT, "assistant") if state == USER else (USER, "user")


def _kept(state: int, initial: str) -> int | None:
    if initial == "s":
        return SYSTEM if state == START else None
    after, role = _next(state)
    return after if role[0] == initial else None


def _steps(initial: str, must: bool, cut: bool) -> dict[int, list[tuple[int, int, str]]]:
    """By state reached: (state before, cost, letters), the least of each pair of states."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for s in STATES:
        at, cost, letters = s, 0, ""
        for _ in range(4):  # three inserts lead anywhere that inserts lead
            ways = [(at, DELETE, "D")]
            if not must:
                k = _kept(at, initial)
                ways += [(k, CUT * cut, "K")] if k is not None else []
                ways.append((_next(at)[0], REROLE + CUT * cut, "R"))
            for t, c, x in ways:
                best[s, t] = min(best.get((s, t), (1 << 60, "")), (cost + c, letters + x))
            at, cost, letters = _next(at)[0], cost + INSERT, letters + "I"
    return {t: [(s, *best[s, t]) for s in STATES if (s, t) in best] for t in STATES}


STEPS = {(i, m, c): _steps(i, m, c) for i in "sua?" for m in (False, True) for c in (False, True)}
#: What closes a conversation that ends in a state: cost and letters.
CLOSING = {START: (0, ""), SYSTEM: (2 * INSERT, "II"), USER: (INSERT, "I"), ASSISTANT: (0, "")}
#: (b, a): what b pays at most to do as a does with whatever rows come: inserts, and the deletion of a system row that only a may keep.
DETOURS = {
    (ASSISTANT, START): DELETE, (USER, START): INSERT + DELETE, (SYSTEM, START): 2 * INSERT + DELETE,
    (START, SYSTEM): 0, (ASSISTANT, SYSTEM): 0, (USER, SYSTEM): INSERT,
    (START, USER): INSERT, (ASSISTANT, USER): INSERT, (SYSTEM, USER): INSERT,
    (START, ASSISTANT): 0, (USER, ASSISTANT): INSERT, (SYSTEM, ASSISTANT): 2 * INSERT,
}


class Survivors:
    """The best path to each state, as leaves of a tree of back pointers with counted references.

    A state whose cost exceeds another's by more than the other's detour can't be on a cheapest
    path whatever follows, and goes; else the path that deletes every row would stay for ever.
    """

    def __init__(self, start: int):
        self.base = [None, "", 1]  # parent, letters, children or survivors that refer to it
        self.live = {start: (0, self.base)}

    def _open(self, node: list) -> str:
        """The letters from the last settled node to this one."""
        out = []
        while node is not self.base:
            out.append(node[1])
            node = node[0]
        return "".join(reversed(out))

    def best(self, ways: list[tuple[int, int, str]]) -> tuple[int, list, str] | None:
        """The cheapest of (state, cost, letters) after a survivor; of ties the least letters from the last settled node on."""
        found, word = None, None
        for s, c, x in ways:
            if s not in self.live:
                continue
            cost, node = self.live[s]
            cost += c
            if found is None or cost < found[0]:
                found, word = (cost, node, x), None
            elif cost == found[0]:
                word = self._open(found[1]) + found[2] if word is None else word
                other = self._open(node) + x
                if other < word:
                    found, word = (cost, node, x), other
        return found

    def push(self, steps: dict[int, list[tuple[int, int, str]]]) -> None:
        reached = {t: found for t in STATES if (found := self.best(steps[t]))}
        after = {}
        for t, (cost, node, letters) in reached.items():
            if all(cost <= reached[b][0] + DETOURS[b, t] for b in reached if b != t):
                node[2] += 1
                after[t] = (cost, [node, letters, 1])
        for _, node in self.live.values():
            self._release(node)
        self.live = after

    def _release(self, node: list) -> None:
        while node is not None:
            node[2] -= 1
            if node[2] or node is self.base:
                return
            node = node[0]

    def settled(self) -> str:
        """Letters that all survivors share, given out once; their nodes are forgotten."""
        if self.base[2] != 1:
            return ""
        node, path = next(iter(self.live.values()))[1], []
        while node is not self.base:
            path.append(node)
            node = node[0]
        out = []
        while path and self.base[2] == 1:
            self.base = path.pop()
            self.base[0] = None
            out.append(self.base[1])
        return "".join(out)

    def close(self, end: int | None = None) -> tuple[int, str]:
        """Cost of the whole path and the letters not given out yet; ``end``: the state it ends in, with nothing to close."""
        cost, node, letters = self.best([(end, 0, "")] if end is not None else [(s, *CLOSING[s]) for s in STATES])
        return cost, self._open(node) + letters


class Repair:
    """Edits of a row stream, given out as they settle: (letter, row or None, role or None)."""

    def __init__(self, start: int = START):
        self.paths, self.state, self.rows = Survivors(start), start, deque()

    def _edits(self, letters: str) -> Iterator[tuple[str, dict | None, str | None]]:
        for x in letters:
            row = None if x == "I" else self.rows.popleft()
            if x == "D":
                yield x, row, None
                continue
            if x == "K":
                role, self.state = row["role"], _kept(self.state, row["role"][:1])
            else:
                self.state, role = _next(self.state)
            yield x, row, role

    def push(self, row: dict) -> Iterator[tuple[str, dict | None, str | None]]:
        self.rows.append(row)
        self.paths.push(STEPS[row["kind"]])
        return self._edits(self.paths.settled())

    def close(self, end: int | None = None) -> tuple[int, list[tuple[str, dict | None, str | None]]]:
        cost, letters = self.paths.close(end)
        return cost, list(self._edits(letters))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after the damage of the contract: by crc32 of ``conv_id:turn``, nulls read as one space."""
    none = F.lit(" ")
    rows = conversations.select("conv_id", "turn", F.coalesce("role", none).alias("role"), F.coalesce("text", none).alias("text"))
    fault = F.crc32(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), none), F.coalesce(F.col("turn").cast("string"), none))) % 20
    rows = rows.withColumn("_fault", fault).where("_fault <> 0")
    text = F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.withColumns({"text": text, "role": F.when(F.col("_fault") == 4, "user").otherwise(F.col("role"))})
    return rows.withColumn("_n", F.explode(F.when(F.col("_fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("_fault", "_n")


def _judged(rows: DataFrame) -> DataFrame:
    """Equal rows as one with their number, whether the same was said in an earlier turn, rows of the conversation.

    Both are found by sums and least turns of groups that are made before the shuffle, and plain joins.
    """
    none = F.lit(" ")
    rows = rows.select("conv_id", "turn", F.coalesce("role", none).alias("role"), F.coalesce("text", none).alias("text"))
    merged = materialize(rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("times")), "turns")
    firsts = merged.groupBy(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("text").alias("_t")).agg(F.min(F.struct("turn")).alias("_first"), F.count(F.lit(1)).alias("_turns")).where("_turns > 1")
    out = merged.join(firsts, merged.conv_id.eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("text") == F.col("_t")), "left")
    out = out.withColumn("later", F.col("_first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("_first.turn")))
    sizes = merged.groupBy(F.col("conv_id").alias("_s")).agg(F.sum("times").alias("size"))
    return out.join(sizes, merged.conv_id.eqNullSafe(F.col("_s"))).select("conv_id", "turn", "role", "text", "times", "later", "size")


_ORDER = ("turn", "role", "text")


def _stream(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """(key, rows) of each run of equal keys: rows one by one with their fault and kind; nothing else is held."""

    def rows() -> Iterator[tuple[tuple, dict]]:
        for batch in batches:
            for r in batch.to_pylist():
                bare = r["text"].strip(_BLANKS)
                cut = bool(bare) and bare[-1] not in ".!?"
                for i in range(r["times"]):
                    fault = "blank" if not bare else "duplicate" if r["later"] or i else "truncated" if cut else None
                    initial = r["role"][:1]
                    yield tuple(r[k] for k in keys), {**r, "fault": fault, "initial": initial, "kind": (initial if initial in ("s", "u", "a") else "?", fault in ("blank", "duplicate"), fault == "truncated")}

    source = rows()
    ahead = next(source, None)
    while ahead is not None:
        key = ahead[0]

        def run() -> Iterator[dict]:
            nonlocal ahead
            while ahead is not None and ahead[0] == key:
                yield ahead[1]
                ahead = next(source, None)

        yield key, run()


class Facts:
    """Counts over a run of rows in order of turn, that can be added to those of the next run."""

    def __init__(self):
        self.n = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.low = self.high = None
        self.distinct, self.first, self.last = 0, None, None

    def add(self, row: dict) -> None:
        if row["fault"]:
            self.n[row["fault"]] += 1
        if self.last is None:
            self.first = row["initial"]
        elif self.last + row["initial"] not in ("su", "ua", "au"):
            self.n["illegal"] += 1
        self.last = row["initial"]
        if row["turn"] is not None:
            self.low = row["turn"] if self.low is None else self.low
            self.distinct += row["turn"] != self.high
            self.high = row["turn"]

    def join(self, other: Facts) -> None:
        for k, v in other.n.items():
            self.n[k] += v
        if self.last is not None and other.first is not None and self.last + other.first not in ("su", "ua", "au"):
            self.n["illegal"] += 1
        self.first = other.first if self.last is None else self.first
        self.last = other.last if other.last is not None else self.last
        if other.low is not None:
            self.distinct += other.distinct - (other.low == self.high)
            self.low = other.low if self.low is None else self.low
            self.high = other.high

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.distinct


def _edit_row(conv, seg: int, n: int, letter: str, row: dict | None, role: str | None) -> dict:
    return {"conv_id": conv, "seg": seg, "n": n, "edit": letter, "turn": row and row["turn"], "role": role if letter != "D" else row["role"], "text": row["text"] if row else "", "fault": row and row["fault"]}


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int = 2_000) -> Iterator[pa.RecordBatch]:
    held = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _edit_schema(kind: pa.DataType, turn: pa.DataType) -> pa.Schema:
    return pa.schema([("conv_id", kind), ("seg", pa.int32()), ("n", pa.int64()), ("edit", pa.string()), ("turn", turn), ("role", pa.string()), ("text", pa.string()), ("fault", pa.string())])


def _ddl(rows: DataFrame) -> str:
    return "conv_id {}, seg int, n long, edit string, turn {}, role string, text string, fault string".format(*(rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn")))


def _ranges(long: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of long conversations with their range, the facts of each range, and the states it begins and ends in."""
    t = materialize(long.repartitionByRange("conv_id", *_ORDER).withColumn("seg", F.spark_partition_id()), "ranges")
    kinds = [t.schema[c].dataType.simpleString() for c in ("conv_id", "turn")]

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None

        def rows() -> Iterator[dict]:
            for (seg, conv), run in _stream(source(), "seg", "conv_id"):
                facts, whole = Facts(), [Survivors(s) for s in STATES]
                given = ["" for _ in STATES]
                for r in run:
                    facts.add(r)
                    for s in STATES:
                        whole[s].push(STEPS[r["kind"]])
                        given[s] += whole[s].settled()
                ways = {(s, t): whole[s].close(t) for s in STATES for t in STATES if t in whole[s].live}
                ranks = {w: i for i, w in enumerate(sorted({given[s] + x for (s, _), (_, x) in ways.items()}))}
                yield {"conv_id": conv, "seg": seg, "ways": [{"s": s, "t": t, "cost": c, "rank": ranks[given[s] + x]} for (s, t), (c, x) in ways.items()], **facts.n, "low": facts.low, "high": facts.high, "distinct": facts.distinct, "first": facts.first, "last": facts.last}

        def source() -> Iterator[pa.RecordBatch]:
            nonlocal schema
            for batch in batches:
                kind, turn = batch.schema.field("conv_id").type, batch.schema.field("turn").type
                ways = pa.list_(pa.struct([("s", pa.int32()), ("t", pa.int32()), ("cost", pa.int64()), ("rank", pa.int32())]))
                schema = pa.schema([("conv_id", kind), ("seg", pa.int32()), ("ways", ways), *((k, pa.int64()) for k in ("blank", "duplicate", "truncated", "illegal")), ("low", turn), ("high", turn), ("distinct", pa.int64()), ("first", pa.string()), ("last", pa.string())])
                yield batch

        made = rows()
        first = next(made, None)
        if first is not None:
            yield pa.RecordBatch.from_pylist([first], schema)
            yield from _batches(made, schema, 100)

    ddl = f"conv_id {kinds[0]}, seg int, ways array<struct<s:int,t:int,cost:long,rank:int>>, blank long, duplicate long, truncated long, illegal long, low {kinds[1]}, high {kinds[1]}, distinct long, first string, last string"
    facts = materialize(t.repartition("seg").sortWithinPartitions("seg", "conv_id", *_ORDER).mapInArrow(solve, ddl), "facts")

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("seg")
        live = {START: (0, (), ())}
        for ways in group["ways"]:
            after: dict[int, tuple] = {}
            for w in ways:
                if w["s"] in live:
                    cost, ranks, states = live[w["s"]]
                    new = (cost + w["cost"], (*ranks, w["rank"]), (*states, (w["s"], w["t"])))
                    after[w["t"]] = min(after.get(w["t"], new), new)
            live = after
        cost, _, states = min((c + CLOSING[s][0], (*ranks, CLOSING[s][1]), states) for s, (c, ranks, states) in live.items())
        last = group["seg"].iloc[-1]
        return pd.DataFrame({"conv_id": group["conv_id"], "seg": group["seg"], "start": [s for s, _ in states], "end": [e for _, e in states], "closes": group["seg"] == last, "cost": cost})

    # a conversation has no more ranges than there are partitions, so a group holds few short rows
    chosen = facts.select("conv_id", "seg", "ways").groupBy("conv_id").applyInPandas(choose, f"conv_id {kinds[0]}, seg int, start int, end int, closes boolean, cost long")
    return t, facts, materialize(chosen, "states")


def _long_edits(t: DataFrame, chosen: DataFrame) -> DataFrame:
    """All edits of long conversations, range by range."""
    c = chosen.select(F.col("conv_id").alias("_c"), F.col("seg").alias("_g"), "start", "end", "closes")
    rows = t.join(c, t.conv_id.eqNullSafe(F.col("_c")) & (t.seg == F.col("_g"))).drop("_c", "_g")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None

        def source() -> Iterator[pa.RecordBatch]:
            nonlocal schema
            for batch in batches:
                schema = _edit_schema(batch.schema.field("conv_id").type, batch.schema.field("turn").type)
                yield batch

        def edits() -> Iterator[dict]:
            for (seg, conv), rows in _stream(source(), "seg", "conv_id"):
                work, n, row = None, 0, None
                for row in rows:
                    work = work or Repair(row["start"])
                    for e in work.push(row):
                        n += 1
                        yield _edit_row(conv, seg, n, *e)
                rest = work.close(row["end"])[1]
                if row["closes"]:
                    rest += list(work._edits(CLOSING[row["end"]][1]))
                for e in rest:
                    n += 1
                    yield _edit_row(conv, seg, n, *e)

        made = edits()
        first = next(made, None)
        if first is not None:
            yield pa.RecordBatch.from_pylist([first], schema)
            yield from _batches(made, schema)

    return rows.repartition("seg").sortWithinPartitions("seg", "conv_id", *_ORDER).mapInArrow(run, _ddl(t))


def _parts(rows: DataFrame, split: int) -> tuple[DataFrame, DataFrame | None]:
    judged = materialize(_judged(rows), "judged")
    long = judged.where(F.col("size") > split)
    short = judged.where(F.col("size") <= split).repartition("conv_id").sortWithinPartitions("conv_id", *_ORDER)
    return short, (None if long.isEmpty() else long)


def repair(conversations: DataFrame, split: int = SPLIT) -> DataFrame:
    """Every edit in order: (conv_id, seg, n, edit, turn, role, text, fault).

    Edits are K (kept), R (new role), D (deleted: not part of the result) and I (inserted, empty
    text, null turn); by conv_id, seg and n they are in order, and without D they are the repaired
    conversation, whose role initials are ``(s?(ua)+)?``. Of the cheapest edits those whose letters
    are least in ASCII. Rows are read by turn (null first), then role and text; null roles and texts
    read as one space, so a null text is blank; a null conv_id is a conversation; repeated rows are
    duplicates and all but the first are deleted. An empty table gives no rows; columns beyond
    conv_id, turn, role and text are not read.
    """
    short, long = _parts(conversations, split)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None

        def source() -> Iterator[pa.RecordBatch]:
            nonlocal schema
            for batch in batches:
                schema = _edit_schema(batch.schema.field("conv_id").type, batch.schema.field("turn").type)
                yield batch

        def edits() -> Iterator[dict]:
            for (conv,), rows in _stream(source(), "conv_id"):
                work, n = Repair(), 0
                for row in rows:
                    for e in work.push(row):
                        n += 1
                        yield _edit_row(conv, 0, n, *e)
                for e in work.close()[1]:
                    n += 1
                    yield _edit_row(conv, 0, n, *e)

        made = edits()
        first = next(made, None)
        if first is not None:
            yield pa.RecordBatch.from_pylist([first], schema)
            yield from _batches(made, schema)

    out = short.mapInArrow(run, _ddl(short))
    if long is not None:
        t, facts, chosen = _ranges(long)
        forget(facts)
        out = out.unionByName(_long_edits(t, chosen))
    return out


class _Sum:
    """Letters, and the hash of ``role:text`` lines, of edits as they come."""

    def __init__(self):
        self.sha, self.letters, self.some = hashlib.sha256(), [], False

    def add(self, letter: str, role: str | None, text: str) -> None:
        self.letters.append(letter)
        if letter != "D":
            self.sha.update(f"{chr(10) if self.some else ''}{role}:{text}".encode())
            self.some = True


def digest(conversations: DataFrame, split: int = SPLIT) -> DataFrame:
    """One row per conv_id of the undamaged table: faults, cost, letters of the edits, hash of the result.

    Nulls, ties, repeated rows and other columns as in ``repair``; a null conv_id is a conversation; one that lost all its rows has
    zeros, no letters and the hash of nothing. A text of any length is held once. An empty table gives no rows.
    """
    conversations, _ = set_aside(conversations, "conv_id", "turn", "role", "text")
    short, long = _parts(damaged(conversations), split)
    kind = short.schema["conv_id"].dataType.simpleString()
    ddl = f"conv_id {kind}, " + ", ".join(f"{c} long" for c in _COUNTS) + ", audit string, repaired_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None

        def source() -> Iterator[pa.RecordBatch]:
            nonlocal schema
            for batch in batches:
                schema = pa.schema([("conv_id", batch.schema.field("conv_id").type), *((c, pa.int64()) for c in _COUNTS), ("audit", pa.string()), ("repaired_sha256", pa.string())])
                yield batch

        def results() -> Iterator[dict]:
            for (conv,), rows in _stream(source(), "conv_id"):
                work, facts, total = Repair(), Facts(), _Sum()
                for row in rows:
                    facts.add(row)
                    for x, r, role in work.push(row):
                        total.add(x, role, r["text"] if r else "")
                cost, rest = work.close()
                for x, r, role in rest:
                    total.add(x, role, r["text"] if r else "")
                yield {"conv_id": conv, "gaps": facts.gaps, **facts.n, "cost": cost, "audit": "".join(total.letters), "repaired_sha256": total.sha.hexdigest()}

        made = results()
        first = next(made, None)
        if first is not None:
            yield pa.RecordBatch.from_pylist([first], schema)
            yield from _batches(made, schema, 500)

    out = short.mapInArrow(run, ddl)
    if long is not None:
        out = out.unionByName(_long_digest(long, ddl))
    ids = conversations.select(F.col("conv_id").alias("_id")).distinct()
    out = ids.join(out, F.col("_id").eqNullSafe(out.conv_id), "left")
    empty = hashlib.sha256(b"").hexdigest()
    return out.select(F.col("_id").alias("conv_id"), *(F.coalesce(c, F.lit(0)).alias(c) for c in _COUNTS), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))


def _long_digest(long: DataFrame, ddl: str) -> DataFrame:
    """The digests of long conversations: facts of their ranges added up, edits hashed in order."""
    t, facts, chosen = _ranges(long)
    edits = materialize(_long_edits(t, chosen), "edits")
    kind = t.schema["conv_id"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total, started, kinds = None, _Sum(), False, None
        for batch in batches:
            kinds = batch.schema.field("conv_id").type
            for r in batch.select(["conv_id", "edit", "role", "text"]).to_pylist():
                if started and r["conv_id"] != held:
                    yield pa.RecordBatch.from_arrays([pa.array([held], kinds), pa.array(["".join(total.letters)]), pa.array([total.sha.hexdigest()])], names=["conv_id", "audit", "repaired_sha256"])
                    total = _Sum()
                held, started = r["conv_id"], True
                total.add(r["edit"], r["role"], r["text"])
        if started:
            yield pa.RecordBatch.from_arrays([pa.array([held], kinds), pa.array(["".join(total.letters)]), pa.array([total.sha.hexdigest()])], names=["conv_id", "audit", "repaired_sha256"])

    sums = edits.repartition("conv_id").sortWithinPartitions("conv_id", "seg", "n").mapInArrow(hashed, f"conv_id {kind}, audit string, repaired_sha256 string")

    def added(group: pd.DataFrame) -> pd.DataFrame:
        group = group.astype(object).where(group.notna(), None).sort_values("seg")
        whole = Facts()
        for r in group.to_dict("records"):
            f = Facts()
            f.n = {k: r[k] for k in f.n}
            f.low, f.high, f.distinct, f.first, f.last = (int(r["low"]) if r["low"] is not None else None), (int(r["high"]) if r["high"] is not None else None), r["distinct"], r["first"], r["last"]
            whole.join(f)
        return pd.DataFrame([{"conv_id": group["conv_id"].iloc[0], "gaps": whole.gaps, **whole.n}])

    names = ("gaps", "blank", "duplicate", "truncated", "illegal")
    counts = facts.drop("ways").groupBy("conv_id").applyInPandas(added, f"conv_id {kind}, " + ", ".join(f"{c} long" for c in names))
    costs = chosen.where("closes").select(F.col("conv_id").alias("_b"), "cost")
    out = counts.join(costs, counts.conv_id.eqNullSafe(F.col("_b")))
    sums = sums.withColumnRenamed("conv_id", "_a")
    return out.join(sums, out.conv_id.eqNullSafe(F.col("_a"))).select("conv_id", *_COUNTS, "audit", "repaired_sha256")
