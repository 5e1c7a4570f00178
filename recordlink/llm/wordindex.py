"""Words of many texts as arrays, and a set of known words that is looked up exactly, inside Spark tasks.

Words are maximal runs of ASCII letters and digits and of all bytes from 128 on; only A-Z are lower-cased.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from recordlink.llm.textblock import fold_table, hash_ranges, runs

FOLD, WORD = fold_table(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


@dataclass
class Words:
    """Words of some rows: their byte ranges in `folded`, fingerprints, and the n + 1 row offsets among them."""

    folded: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    rows: np.ndarray

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows) - 1), np.diff(self.rows))

    def text(self, i: int) -> bytes:
        return self.folded[self.starts[i] : self.ends[i]].tobytes()


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    starts, ends = runs(WORD[data], offsets)
    folded = FOLD[data]
    return Words(folded, starts, ends, hash_ranges(folded, starts, ends), np.searchsorted(starts, offsets))


def flat_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of all ranges, one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


class Known:
    """Sorted 64-bit keys with a bitmap before them, so that most unknown keys cost one look-up."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        bits = max(12, int(len(keys) * 16).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.seen = np.zeros(1 << bits, bool)
        self.seen[(keys & self.mask).astype(np.int64)] = True

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in `keys` that are known, and where each is found."""
        maybe = np.flatnonzero(self.seen[(keys & self.mask).astype(np.int64)])
        if not len(maybe):
            return maybe, maybe
        at = np.minimum(np.searchsorted(self.keys, keys[maybe]), len(self.keys) - 1)
        same = self.keys[at] == keys[maybe]
        return maybe[same], at[same]


class Vocabulary:
    """Known words in order of fingerprint; equal fingerprints are told apart by their bytes."""

    def __init__(self, found: set[bytes]):
        listed = sorted(found)
        lengths = np.array([len(w) for w in listed], np.int64)
        data = np.frombuffer(b"".join(listed), np.uint8)
        ends = np.cumsum(lengths)
        hashes = hash_ranges(data, ends - lengths, ends)
        order = np.argsort(hashes, kind="stable")
        self.data, self.starts, self.lengths, self.hashes = data, (ends - lengths)[order], lengths[order], hashes[order]
        self.known = Known(self.hashes)
        same = self.hashes[1:] == self.hashes[:-1]
        self.repeats = 1
        while same.any():  # the most words that share a fingerprint
            self.repeats += 1
            same = same[1:] & same[:-1]

    def __len__(self) -> int:
        return len(self.hashes)

    def same(self, w: Words, word: np.ndarray, entry: np.ndarray) -> np.ndarray:
        """Whether each word has exactly the bytes of its entry."""
        equal = (w.ends[word] - w.starts[word]) == self.lengths[entry]
        i = np.flatnonzero(equal)
        step = 1 << 18
        for at in range(0, len(i), step):
            part = i[at : at + step]
            lengths = self.lengths[entry[part]]
            differ = w.folded[flat_ranges(w.starts[word[part]], lengths)] != self.data[flat_ranges(self.starts[entry[part]], lengths)]
            wrong = np.add.reduceat(differ, np.cumsum(lengths) - lengths) if len(part) else differ
            equal[part] = wrong == 0
        return equal

    def find(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the words that are known, in order, and their entries."""
        word, entry = self.known.find(w.hashes)
        if self.repeats == 1:
            right = self.same(w, word, entry)
            return word[right], entry[right]
        words_, entries = [], []
        for more in range(self.repeats):
            there = entry + more < len(self)
            i, e = word[there], entry[there] + more
            there = self.hashes[e] == w.hashes[i]
            i, e = i[there], e[there]
            right = self.same(w, i, e)
            words_.append(i[right])
            entries.append(e[right])
        word, entry = np.concatenate(words_), np.concatenate(entries)
        order = np.argsort(word, kind="stable")
        return word[order], entry[order]
