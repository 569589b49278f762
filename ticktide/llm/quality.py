"""Quality rules: counts over words and lines, and repetition from a suffix array.

Each text is one row and is judged alone, so the work is a map over Arrow batches: no
shuffle. The suffix array is over words. It is built by prefix doubling from five-word
windows; a suffix whose prefix is already unique takes no part in further rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import free_name

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: The method's own limits: share of words in repeats of LONG or more words, longest repeat.
LONG = 12
MAX_COVERED = 0.15
MAX_LONGEST = 200
_SYMBOLS = b"#*$%&|<>"
_BLANKS = " \t\n\r\x0b\x0c"

FIELDS = T.StructType([T.StructField(n, t) for n, t in (
    ("n_words", T.LongType()), ("word_chars", T.LongType()), ("n_symbols", T.LongType()), ("n_dup_lines", T.LongType()), ("n_repeat_words", T.LongType()),
    ("covered", T.DoubleType()), ("longest_repeat", T.LongType()), ("base_failed", T.BooleanType()), ("kept", T.BooleanType()),
)])


def _named(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


def _windows(ids: np.ndarray, distinct: int) -> np.ndarray:
    """For each position a number that orders and identifies its five-word window.

    Windows over the end are filled with 0, below every word, so they are unique.
    """
    n = len(ids)
    padded = np.concatenate((ids + 1, np.zeros(WINDOW - 1, np.int64)))
    base = distinct + 1
    if base <= 4096:
        key = padded[:n].copy()
        for j in range(1, WINDOW):
            key = (key << 12) | padded[j : n + j]
        return key
    two = _named(padded[:-1] * base + padded[1:])
    four = _named(two[:-2] * (int(two.max()) + 1) + two[2:])
    return four[:n] * base + padded[WINDOW - 1 :]


def repeats(ids: np.ndarray, distinct: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, length): neighbours in the suffix array and their longest common prefix, from WINDOW words.

    Every longest-common-prefix interval of that depth, and so every maximal repeated run
    of words, is among them at all of its places.
    """
    none = np.zeros(0, np.int64)
    n = len(ids)
    if n <= WINDOW:
        return none, none, none
    keys = _windows(ids, distinct)
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    new = np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1]))
    if new.all():
        return none, none, none
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))  # a group's first place
    open_ = ~(new & np.concatenate((new[1:], [True])))  # places of suffixes not yet alone
    first = places = np.flatnonzero(open_)
    levels, depth = [], WINDOW
    while len(places):
        levels.append((depth, rank.copy()))
        at = order[places]
        ahead = np.where(at + depth < n, rank[np.minimum(at + depth, n - 1)], -1)
        mine = rank[at]
        by = np.lexsort((ahead, mine))
        order[places] = at = at[by]
        mine, ahead = mine[by], ahead[by]
        new = np.concatenate(([True], (mine[1:] != mine[:-1]) | (ahead[1:] != ahead[:-1])))
        rank[at] = np.maximum.accumulate(np.where(new, places, 0))
        places = places[~(new & np.concatenate((new[1:], [True])))]
        depth *= 2
    a, b = order[first[:-1]], order[first[1:]]
    near = (first[1:] == first[:-1] + 1) & (levels[0][1][a] == levels[0][1][b])
    a, b = a[near], b[near]
    length = np.zeros(len(a), np.int64)
    for h, at_level in reversed(levels):
        fits = np.maximum(a, b) + length < n
        i, j = np.where(fits, a + length, 0), np.where(fits, b + length, 0)
        length += np.where(fits & (at_level[i] == at_level[j]), h, 0)
    for _ in range(WINDOW - 1):
        fits = np.maximum(a, b) + length < n
        i, j = np.where(fits, a + length, 0), np.where(fits, b + length, 0)
        length += fits & (ids[i] == ids[j])
    return a, b, length


def _covered(n: int, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> int:
    """Words in the union of the repeats' spans."""
    if not len(a):
        return 0
    edge = np.zeros(n + 1, np.int64)
    for start in (a, b):
        np.add.at(edge, start, 1)
        np.add.at(edge, start + length, -1)
    return int((np.cumsum(edge)[:n] > 0).sum())


def judge(text: str | None, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> tuple:
    """The values of FIELDS for one whole text; null counts as empty, and an empty text fails."""
    text = text or ""
    raw = text.encode()
    words = raw.split()  # bytes split at the six ASCII blanks only
    n = len(words)
    chars = len(text) - (len(raw) - len(b"".join(words)))
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    seen: set[str] = set()
    dup_lines = 0
    for line in text.split("\n"):
        if line.strip(_BLANKS):
            if line in seen:
                dup_lines += 1
            else:
                seen.add(line)
    names: dict[bytes, int] = {}
    ids = np.array([names.setdefault(w, len(names)) for w in words], dtype=np.int64)
    a, b, length = repeats(ids, len(names))
    repeated = _covered(n, a, b, length)
    long = length >= LONG
    covered = _covered(n, a[long], b[long], length[long]) / n if n else 0.0
    longest = int(length.max()) if len(length) else 0
    failed = n < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * n
    return n, chars, symbols, dup_lines, repeated, covered, longest, failed, not failed and covered <= max_covered and longest <= max_longest


def apply(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",), max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    """The columns ``carry`` and FIELDS, one row per row of ``docs``.

    ``kept`` is false for a text with under ten words, with over a fifth of its words in
    repeated five-word windows, with more than ``max_covered`` of its words in repeats of
    LONG or more words, or with a repeat longer than ``max_longest`` words. Repeated rows
    are judged alike; an empty table gives no rows. A carried column that has the name of a
    result gives way to it.
    """
    names = [f.name for f in FIELDS]
    carry = tuple(c for c in carry if c not in names)
    work = free_name(carry)
    kinds = [pa.int64()] * 5 + [pa.float64(), pa.int64(), pa.bool_(), pa.bool_()]

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [judge(x.as_py(), max_covered, max_longest) for x in batch.column(work)]
            cols = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carry), *cols], names=[*carry, *names])

    df = docs.select(*carry, docs[text].alias(work))
    return df.mapInArrow(judged, T.StructType([*(f for f in df.schema if f.name != work), *FIELDS]))
