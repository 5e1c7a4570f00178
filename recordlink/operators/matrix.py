"""Shared words of many token sets at once, as products of small matrices.

Sets come as Arrow lists of words, or as texts of words joined by blanks. Rows are compared `STEP` at a time and only through
the words that they hold, so memory follows the rows of a side and not its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

STEP = 256  # rows compared at once
WORDS = 1024  # words in one product


class Sets:
    """Token sets as numbers of words: `word[start[i]:start[i + 1]]` are those of set i."""

    def __init__(self, size: np.ndarray, word: np.ndarray):
        self.size, self.word = size, word
        self.start = np.concatenate([[0], np.cumsum(size)])

    def take(self, rows: np.ndarray) -> Sets:
        size = self.size[rows]
        first = np.cumsum(size) - size
        return Sets(size, self.word[np.repeat(self.start[rows] - first, size) + np.arange(int(size.sum()))])


def read_sets(*columns: pa.ChunkedArray) -> list[Sets]:
    """The sets of each column; equal words have equal numbers in all of them."""
    lists = [pc.split_pattern(c, " ") if pa.types.is_string(c.type) or pa.types.is_large_string(c.type) else c for c in columns]
    flat = [pc.list_flatten(c) for c in lists]
    joined = pa.chunked_array([x for f in flat for x in (f.chunks if isinstance(f, pa.ChunkedArray) else [f])], flat[0].type)
    word = joined.combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    found, at = [], 0
    for c, f in zip(lists, flat):
        found.append(Sets(pc.list_value_length(c).to_numpy().astype(np.int64), word[at : at + len(f)]))
        at += len(f)
    return found


def shared_words(a: Sets, b: Sets) -> np.ndarray:
    """Numbers of shared words, one row for each set of a (a few) and one column for each set of b."""
    total = np.zeros((len(a.size), len(b.size)), np.float32)
    held = np.unique(a.word)
    own_a, own_b = np.repeat(np.arange(len(a.size)), a.size), np.repeat(np.arange(len(b.size)), b.size)
    at_a, at_b = np.searchsorted(held, a.word), np.searchsorted(held, b.word)
    known = held[np.minimum(at_b, max(len(held) - 1, 0))] == b.word if len(held) else np.zeros(len(b.word), bool)
    own_b, at_b = own_b[known], at_b[known]
    for first in range(0, len(held), WORDS):
        sides = []
        for n, own, at in ((len(a.size), own_a, at_a), (len(b.size), own_b, at_b)):
            here = (at >= first) & (at < first + WORDS)
            holds = np.zeros((n, min(WORDS, len(held) - first)), np.float32)
            holds[own[here], at[here] - first] = 1
            sides.append(holds)
        total += sides[0] @ sides[1].T
    return total


def jaccard(shared: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return shared / (a[:, None] + b[None, :] - shared).astype(np.float64)


def compared(a: Sets, b: Sets) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of a, their shared words with each set of b)."""
    for first in range(0, len(a.size), STEP):
        rows = np.arange(first, min(first + STEP, len(a.size)))
        yield rows, shared_words(a.take(rows), b)
