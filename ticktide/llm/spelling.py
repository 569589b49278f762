"""Spelling variant grouping: words one edit apart, by dynamic programming over sorted lists.

A list of words is sorted; a query walks it with the rows of its edit matrix, three cells
wide. The next word keeps the rows of the prefix that it shares with the word before, and
where all three cells of a row exceed one edit all words with that prefix are skipped. Many
queries walk at once, each with a cursor of its own.

Two words one edit apart share at least their first or their last half, so lists hold the
words of a length and of that less one with an equal first half, or, spelt backwards, an
equal last half. A list of more than ``LIST`` words is dealt over pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, materialize

#: Fixed pattern of a run of letters.
RUN = r"[A-Za-zÀ-ÿ]+"
#: Least code points and occurrences of a word; how many times more often a form occurs.
SHORTEST, SEEN, TIMES = 7, 2, 10
#: Words of a list beyond which it is dealt over pairs of blocks.
LIST = 4_096
#: Cells of edit-matrix rows that are held at once.
CELLS = 4_000_000
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def vocabulary(docs: DataFrame, damage: bool = False, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): distinct words of ``SHORTEST`` code points or more that occur ``SEEN`` times or more.

    Words are maximal runs of ``RUN`` with A to Z in lower case. ``damage`` deletes the code point
    h % length of a run if 31 divides h, the checksum of ``key:run`` (a null key reads as empty).
    Null text has no words; repeated rows count each. Counts are summed before they are shuffled.
    """
    runs = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"), F.explode(F.regexp_extract_all(F.col(text), F.lit(RUN), F.lit(0))).alias("word"))
    runs = runs.where(F.length("word") >= SHORTEST).select("k", F.translate("word", _UPPER, _UPPER.lower()).alias("word"))
    if damage:
        h = F.crc32(F.concat_ws(":", "k", "word"))
        runs = runs.select("word", h.alias("h")).where((F.length("word") > SHORTEST) | (F.col("h") % 31 != 0))  # a damaged run is one shorter
        at = (F.col("h") % F.length("word")).cast("int")
        runs = runs.select(F.when(F.col("h") % 31 == 0, F.concat(F.substring("word", F.lit(1), at), F.substr("word", at + 2))).otherwise(F.col("word")).alias("word"))
    return runs.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= SEEN)


class Words:
    """Words as code points in one array, with the prefix that each shares with the one before."""

    def __init__(self, words: list[str]):
        self.length = np.fromiter(map(len, words), np.int64, len(words))
        self.at = np.concatenate(([0], np.cumsum(self.length)[:-1])).astype(np.int64)
        self.flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)

    def char(self, word: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Code point i of each word; 0 outside of it."""
        ok = (i >= 0) & (i < self.length[word])
        out = np.zeros(len(word), np.uint32)
        out[ok] = self.flat[self.at[word[ok]] + i[ok]]
        return out

    def shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of each pair of words."""
        out, open_ = np.zeros(len(a), np.int64), np.arange(len(a))
        i = 0
        while len(open_):
            left = self.char(a[open_], np.full(len(open_), i))
            open_ = open_[(left == self.char(b[open_], np.full(len(open_), i))) & (left > 0)]
            i += 1
            out[open_] = i
        return out


def near_pairs(words: Words, group: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a, b), a before b: words of the same group exactly one edit apart.

    ``group`` numbers sorted lists that follow one another, ``first`` is the length of the prefix
    that all words of a list share. Every word walks the rest of its list.
    """
    n = len(group)
    if n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lcp = np.zeros(n + 1, np.int64)
    same = np.flatnonzero(group[1:] == group[:-1]) + 1
    lcp[same] = words.shared(same - 1, same)
    end = np.searchsorted(group, group, "right")
    # the next entry with a shorter shared prefix: how a cursor leaves all words below a prefix
    leap = np.full(n + 1, n, np.int64)
    stack: list[int] = []
    for i, v in enumerate(lcp[:n].tolist()):
        while stack and lcp[stack[-1]] > v:
            leap[stack.pop()] = i
        stack.append(i)

    found_a, found_b = [], []
    ahead = np.flatnonzero(end - np.arange(n) > 1)
    bits = np.array([int(x).bit_length() for x in (words.length[ahead] - first[ahead] + 3).tolist()], np.int64)
    parts = [x[i : i + max(1, CELLS >> b)] for b in np.unique(bits).tolist() for x in [ahead[bits == b]] for i in range(0, len(x), max(1, CELLS >> b))]
    for q in parts:
        low = first[q]
        rows = np.full((len(q), int((words.length[q] - low).max()) + 3, 3), 2, np.int8)
        lane = np.arange(len(q))
        # the shared prefix is matched: one left behind, the diagonal, one ahead
        rows[:, 0] = np.where((low > 0)[:, None], np.array([1, 0, 1], np.int8), np.array([2, 0, 1], np.int8))
        p, d = q.copy(), words.length[q].copy()
        # the query itself comes first: its rows are those of a word at no distance, up to the prefix it shares with the next
        for i in range(1, rows.shape[1]):
            rows[:, i] = (1, 0, 1)
        p = p + 1
        d = np.minimum(lcp[p], d)
        skip = np.zeros(len(q), bool)
        while len(q):
            # leave the words below a prefix that is two edits away: the cursor leaps while it shares more than d
            far = skip & (p < end[q]) & (lcp[p] > d)
            while far.any():
                p = np.where(far, leap[p], p)
                far = skip & (p < end[q]) & (lcp[np.minimum(p, n)] > d)
            d = np.where(skip & (p < end[q]), np.minimum(d, lcp[np.minimum(p, n)]), d)
            alive = p < end[q]
            if not alive.all():
                q, low, lane, p, d = q[alive], low[alive], lane[alive], p[alive], d[alive]
                if not len(q):
                    break
            size = words.length[p]
            done = d >= size
            i = np.where(done, size, d)
            cell = rows[lane, i - low]
            # a word that is read to its end: the cell of the query's end is the distance
            off = words.length[q] - size + 1
            hit = done & (off >= 0) & (off <= 2)
            hit[hit] = cell[hit, off[hit]] == 1
            found_a.append(q[hit])
            found_b.append(p[hit])
            # else one more row
            c = words.char(p, i)
            x, y, z = cell[:, 0], cell[:, 1], cell[:, 2]
            x1 = np.minimum(x + (words.char(q, i - 1) != c), y + 1)
            y1 = np.minimum(np.minimum(y + (words.char(q, i) != c), z + 1), x1 + 1)
            z1 = np.minimum(z + (words.char(q, i + 1) != c), y1 + 1)
            new = np.minimum(np.stack((x1, y1, z1), 1), 2).astype(np.int8)
            go = ~done
            keep = go & (new.min(1) <= 1)
            rows[lane[keep], d[keep] + 1 - low[keep]] = new[keep]
            skip = go & ~keep
            # next: deeper in this word, the next word, or the first that lacks this prefix
            after = lcp[p + 1]
            p = np.where(keep, p, p + 1)
            d = np.where(keep, d + 1, np.where(done, np.minimum(after, size), d))
    return (np.concatenate(found_a), np.concatenate(found_b)) if found_a else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _lists(words: DataFrame) -> DataFrame:
    """Each word in its four lists: (back, most, word), spelt backwards where ``back``, and the list's key."""
    length = F.length("word")
    most = F.explode(F.array(length, length + 1))
    out = words.select("word", "n", most.alias("most"))
    forward = out.select(F.lit(False).alias("back"), "most", "word", "n", F.ceil(F.col("most") / 2).cast("int").alias("first"))
    back = out.select(F.lit(True).alias("back"), "most", F.reverse("word").alias("word"), "n", F.floor(F.col("most") / 2).cast("int").alias("first"))
    both = forward.unionByName(back)
    return both.withColumn("key", F.xxhash64("back", "most", F.substring("word", F.lit(1), F.col("first"))))


def _dealt(lists: DataFrame, size: int) -> DataFrame:
    """The lists, those of over ``size`` words over the cells of pairs of their blocks: (key, p, q, block)."""
    sizes = lists.groupBy("key").agg(F.count(F.lit(1)).alias("words")).where("words > 1")
    blocks = F.when(F.col("words") <= size, 1).otherwise(F.ceil(2 * F.col("words") / F.lit(size))).cast("int")
    out = lists.join(sizes.select("key", blocks.alias("blocks")), "key").withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    out = out.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return out.select("key", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "block", "back", "most", "first", "word", "n")


def _near_in(batch: pa.Table) -> pa.RecordBatch:
    """For each word of the batch's lists with a near one: how many, and the best of them."""
    names = batch.column("word").to_pylist()
    cols = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "p", "q", "block", "back", "most", "first", "n")}
    words = Words(names)
    edge = np.zeros(len(names), bool)
    edge[0] = True
    for c in ("key", "p", "q", "back", "most"):
        edge[1:] |= cols[c][1:] != cols[c][:-1]
    same_prefix = words.shared(np.arange(len(names) - 1), np.arange(1, len(names))) if len(names) > 1 else np.zeros(0, np.int64)
    edge[1:] |= same_prefix < cols["first"][1:]  # two keys of one hash
    a, b = near_pairs(words, np.cumsum(edge), cols["first"].astype(np.int64))
    # a pair belongs to the list of its longer word, to the cell of its blocks, and to a list of first halves if they are equal
    ok = np.maximum(words.length[a], words.length[b]) == cols["most"][a]
    ok &= (cols["p"][a] == cols["q"][a]) | (cols["block"][a] != cols["block"][b])
    a, b = a[ok], b[ok]
    back = np.flatnonzero(cols["back"][a])
    half = (cols["most"][a[back]] + 1) // 2
    equal = np.ones(len(back), bool)
    for i in range(int(half.max()) if len(half) else 0):
        left, right = (words.char(w, words.length[w] - 1 - i) for w in (a[back], b[back]))
        equal &= (left == right) | (i >= half)
    stay = np.ones(len(a), bool)
    stay[back[equal]] = False
    a, b = a[stay], b[stay]
    word, other = np.concatenate((a, b)), np.concatenate((b, a))
    spelt = [w[::-1] if r else w for w, r in zip(names, cols["back"].tolist(), strict=True)]
    best: dict[int, tuple] = {}
    count: dict[int, int] = {}
    for w, o, n in zip(word.tolist(), other.tolist(), cols["n"][other].tolist(), strict=True):
        count[w] = count.get(w, 0) + 1
        new = (-n, spelt[o])
        if w not in best or new < best[w]:
            best[w] = new
    rows = list(count)
    return pa.RecordBatch.from_arrays(
        [pa.array([spelt[w] for w in rows], pa.string()), pa.array([count[w] for w in rows], pa.int64()), pa.array([best[w][1] for w in rows], pa.string()), pa.array([-best[w][0] for w in rows], pa.int64())],
        names=["word", "n_near", "near", "near_n"],
    )


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted lists from a sorted stream: whole lists at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key, p, q = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "p", "q"))
        edge = np.flatnonzero((key[1:] != key[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1]))
        if held:
            last = held[-1]
            if any(last.column(c)[-1].as_py() != batch.column(c)[0].as_py() for c in ("key", "p", "q")):
                yield _near_in(pa.Table.from_batches(held).combine_chunks())
                held = []
        cut = int(edge[-1]) + 1 if len(edge) else 0
        if cut:
            yield _near_in(pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks())
            held = []
        held.append(batch.slice(cut))
    if held:
        yield _near_in(pa.Table.from_batches(held).combine_chunks())


def near_words(words: DataFrame, size: int = LIST) -> DataFrame:
    """(word, n_near, near): of each word with a near one their number and the best, (-n, word) least.

    A list gives a row for a word, however many are near it.
    """
    cells = _dealt(_lists(words), size)
    n = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = cells.repartition(n, "key", "p", "q").sortWithinPartitions("key", "p", "q", "back", "most", "word")
    found = cells.mapInArrow(_scan, "word string, n_near long, near string, near_n long")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near"))).alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): from each word along ``form`` to the last, by doubling pointers over written tables."""
    current = materialize(forms.select("word", F.col("form").alias("to")), "forms")
    while True:
        ahead = current.select(F.col("word").alias("to"), F.col("to").alias("further"))
        after = materialize(current.join(ahead, "to", "left").select("word", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")), "forms")
        forget(current)
        current = after.drop("moved")
        current.scratch_path = after.scratch_path
        if after.where("moved").isEmpty():
            return current.withColumnRenamed("to", "root")


def group(words: DataFrame, size: int = LIST) -> DataFrame:
    """``words`` (word, n) with n_near, form, form_n and root.

    Near: exactly one code point inserted, deleted or replaced. The form is the near word of
    largest n (of ties the least in code-point order) if that is ``TIMES`` times the word's n or
    more, else null; the root is where forms lead, the word itself without one. Words are distinct
    and not null; an empty table gives no rows.
    """
    words = materialize(words, "words")
    near = words.join(near_words(words, size), "word", "left")
    near = near.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(-F.col("best.minus") >= TIMES * F.col("n"), F.col("best")).alias("best"))
    near = materialize(near.select("word", "n", "n_near", F.col("best.near").alias("form"), (-F.col("best.minus")).alias("form_n")), "near")
    ends = roots(near.where("form IS NOT NULL"))
    return near.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def digest(docs: DataFrame) -> DataFrame:
    """One row per word of the damaged texts; a null doc_id reads as empty, null text has no words, repeated rows count each, other columns are not read, an empty table gives no rows."""
    return group(vocabulary(docs.select("doc_id", "text"), damage=True)).select("word", "form", "root", "n", "n_near", "form_n")
