"""Encoding many whole texts through their distinct words.

A byte-level tokenizer splits a text by a pattern before it merges. No match of that
pattern crosses a single space between two other characters (a space belongs to what
follows), so a text may be cut there and each distinct word be encoded once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Fixed pattern by which the byte-level tokenizers split. The cuts below hold for it alone.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

Ids = tuple[np.ndarray, np.ndarray]  # (ids of all entries, one after the other; number of ids of each)

#: Words, and pieces of the library, that a worker remembers.
REMEMBERED = 450_000
#: Characters that end a word and are a match of their own there.
_STOPS = ".,;:!?"


def starts_of(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths) - lengths


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(starts - (ends - lengths), lengths)]


def picked(ids: Ids, which: np.ndarray, counts: np.ndarray) -> Ids:
    """Entries that consist of other entries: ``counts`` of ``which`` each, in order."""
    flat, lengths = ids
    each = lengths[which]
    ends = np.concatenate(([0], np.cumsum(each)))
    bounds = np.concatenate(([0], np.cumsum(counts)))
    return gather(flat, starts_of(lengths)[which], each), np.diff(ends[bounds])


class Remembering:
    """Encodes distinct strings; those that recur are remembered from batch to batch, at most ``REMEMBERED``."""

    def __init__(self, encode: Callable[[pa.Array, np.ndarray], Ids]):
        self.encode = encode
        self.known = pa.array([], pa.large_string())
        self.ids, self.lengths = np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.seen, self.batch = np.zeros(0, np.int64), 0

    def __call__(self, strings: pa.Array, uses: np.ndarray) -> Ids:
        """``uses``: how often each string occurs in the batch."""
        n = len(self.known)
        at = pc.index_in(strings, self.known)
        gap = at.is_null().to_numpy(zero_copy_only=False)
        fresh = strings.filter(at.is_null())
        which = at.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        which[gap] = n + np.arange(len(fresh))
        ids, lengths = self.encode(fresh, uses[gap])
        ids, lengths = np.concatenate((self.ids, ids)), np.concatenate((self.lengths, lengths))
        starts = starts_of(lengths)
        # the strings seen last, those of early batches first to go; no very long ones
        self.batch += 1
        seen = np.concatenate((self.seen, np.full(len(fresh), self.batch)))
        seen[which] = self.batch
        keep = np.concatenate((np.ones(n, bool), pc.binary_length(fresh).to_numpy(zero_copy_only=False) <= 48))
        since = self.batch
        while keep.sum() > REMEMBERED:
            drop = np.flatnonzero(keep & (seen <= seen[keep].min()))
            keep[drop[: int(keep.sum()) - REMEMBERED] if seen[drop[0]] == since else drop] = False
        self.seen = seen[keep]
        self.known = pa.chunked_array([self.known, fresh]).combine_chunks().filter(pa.array(keep))
        self.ids, self.lengths = gather(ids, starts[keep], lengths[keep]), lengths[keep]
        return gather(ids, starts[which], lengths[which]), lengths[which]


class ChunkEncoder:
    """Encodes whole texts. ``encode_pieces`` gives the ids of distinct matches of the pattern."""

    def __init__(self, encode_pieces: Callable[[pa.Array, np.ndarray], Ids]):
        self.find, self.encode_pieces = regex.compile(PATTERN).findall, encode_pieces
        self.pieces, self.words = Remembering(encode_pieces), Remembering(self._words)

    def _loose(self, texts: list[str]) -> Ids:
        """Ids of texts that the pattern alone splits."""
        cut = [self.find(t) for t in texts]
        coded = pc.dictionary_encode(pa.array([p for ps in cut for p in ps], pa.large_string()))
        which = coded.indices.to_numpy().astype(np.int64)
        return picked(self.encode_pieces(coded.dictionary, np.bincount(which, minlength=len(coded.dictionary))), which, np.array([len(ps) for ps in cut], np.int64))

    def _words(self, words: pa.Array, uses: np.ndarray) -> Ids:
        """Ids of distinct words that follow a space."""
        stem = pc.utf8_slice_codeunits(words, 0, -1)
        plain = pc.utf8_is_alpha(words).to_numpy(zero_copy_only=False)
        stop = pc.index_in(pc.utf8_slice_codeunits(words, -1), pa.array(list(_STOPS), words.type)).fill_null(-1).to_numpy(zero_copy_only=False)
        stopped = (stop >= 0) & pc.utf8_is_alpha(stem).to_numpy(zero_copy_only=False)
        at_plain, at_stop, other = np.flatnonzero(plain), np.flatnonzero(stopped), np.flatnonzero(~plain & ~stopped)
        spaced = lambda x: pc.binary_join_element_wise(pa.scalar(" ", words.type), x, pa.scalar("", words.type))
        cut = [self.find(w) for w in spaced(words.take(pa.array(other))).to_pylist()]
        loose = pa.array([p for ps in cut for p in ps], words.type)
        parts = [spaced(words.take(pa.array(at_plain))), spaced(stem.take(pa.array(at_stop))), loose, pa.array(list(_STOPS), words.type)]
        coded = pc.dictionary_encode(pa.concat_arrays(parts))
        ref = coded.indices.to_numpy().astype(np.int64)
        sizes = [len(p) for p in parts]
        a, b, c = sizes[0], sizes[0] + sizes[1], sizes[0] + sizes[1] + sizes[2]
        # how often each piece occurs in the batch, as far as the words tell
        weight = np.concatenate((uses[at_plain], uses[at_stop], np.ones(sizes[2] + sizes[3], np.int64)))
        ids = self.pieces(coded.dictionary, np.bincount(ref, weights=weight, minlength=len(coded.dictionary)))
        counts = np.ones(len(words), np.int64)
        counts[at_stop] = 2
        counts[other] = [len(ps) for ps in cut]
        at = starts_of(counts)
        which = np.empty(int(counts.sum()), np.int64)
        which[at[at_plain]] = ref[:a]
        which[at[at_stop]] = ref[a:b]
        which[at[at_stop] + 1] = ref[c:][stop[at_stop]]
        irregular = np.ones(len(which), bool)
        irregular[at[at_plain]] = irregular[at[at_stop]] = irregular[at[at_stop] + 1] = False
        which[irregular] = ref[b:c]
        return picked(ids, which, counts)

    def __call__(self, texts: pa.Array) -> Ids:
        """(ids of all texts, one after the other; number of ids of each text); no nulls."""
        if not len(texts):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        split = pc.split_pattern(texts, " ")
        offsets = split.offsets.to_numpy().astype(np.int64)
        coded = pc.dictionary_encode(split.values)
        words, index = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        # a blank beside the space: there the pattern looks across it
        blank = r"^$|^[\s\p{Z}\x1c-\x1f\x0b\x85]|[\s\p{Z}\x1c-\x1f\x0b\x85]$"
        beside = pc.match_substring_regex(words, blank).to_numpy(zero_copy_only=False)
        whole = np.add.reduceat(beside[index].astype(np.int64), offsets[:-1]) > 0
        at_head = offsets[:-1]
        first = words.take(pa.array(index[at_head])).to_pylist()
        heads = self._loose([texts[i].as_py() if bad else w for i, (w, bad) in enumerate(zip(first, whole.tolist(), strict=True))])
        ids = self.words(words, np.bincount(index, minlength=len(words)))
        which = index
        which[at_head] = len(words) + np.arange(len(texts))
        keep = ~np.repeat(whole, np.diff(offsets))
        keep[at_head] = True
        counts = np.where(whole, 1, np.diff(offsets))
        both = tuple(np.concatenate(x) for x in zip(ids, heads, strict=True))
        return picked(both, which[keep], counts)


def in_slices(sizes: np.ndarray, most: int = 12_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of a batch of about ``most`` bytes each, so memory stays bounded."""
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(ends):
        before = int(ends[start - 1]) if start else 0
        stop = min(len(ends), int(np.searchsorted(ends, before + most, "left")) + 1)
        yield start, stop
        start = stop
