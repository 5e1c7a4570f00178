"""Suffix-array dedup: remove bytes that repeat a window of an earlier document.

A full suffix array would move every suffix. Here suffixes are ordered only through the window length, and only where
a repeat is possible, by most-significant-digit passes. The digits of a window are, from the most significant:
1. the smallest fingerprint among its `GRAM`-byte substrings (equal windows have equal ones); neighbouring windows that
   share it form a run;
2. the fingerprint of the run: all bytes its windows cover;
3. the fingerprint of the window itself.
The first pass sends digits 1 and 2 of every run, about one for 14 bytes. Where all of a run stands in an earlier
cell, all its windows repeat; where its first digit is alone, none does. Only first occurrences of runs whose first digit
has other continuations go into the second pass, window by window. Cells are ranges of doc_id, so an earlier cell is an
earlier document; inside a cell the same passes run on sorted arrays. Together the digits have over 96 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlink.llm.cells import PACKED, answered, ask, bucket_count, cell_count, dealt, pack, range_cell
from recordlink.llm.scratch import keep
from recordlink.llm.textblock import group_starts, mix, powers, prefix_sums, range_hash, runs, text_bytes

SLICE = 1 << 19
RUNS, WINDOWS = 1, 2
NONE, SEEN, OPEN = 0, 1, 2


def slices(offsets: np.ndarray, window: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(low, high, row edges): byte ranges that hold every window once. Rows beyond SLICE bytes are cut with an overlap."""
    row, last = 0, len(offsets) - 1
    while row < last:
        end = int(np.searchsorted(offsets, offsets[row] + SLICE, "right")) - 1
        if end > row:
            yield int(offsets[row]), int(offsets[end]), offsets[row : end + 1] - offsets[row]
            row = end
            continue
        low, high = int(offsets[row]), int(offsets[row + 1])
        while low < high:
            stop = min(high, low + SLICE + window - 1)
            yield low, stop, np.array([0, stop - low])
            low = high if stop == high else low + SLICE
        row += 1


def _window_runs(data: np.ndarray, edges: np.ndarray, window: int, gram: int):
    """First and last window of each run, its digit and the run's fingerprint."""
    empty = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    n = len(data) - window + 1
    if n <= 0:
        return empty
    change = np.zeros(len(data) + 1, np.int32)
    long_rows = np.flatnonzero(np.diff(edges) >= window)
    change[edges[long_rows]] += 1
    change[edges[long_rows + 1] - window + 1] -= 1
    valid = np.cumsum(change[:n]) > 0
    sums = prefix_sums(data)
    least = mix((sums[gram:] - sums[:-gram]) * powers(len(sums) - gram, 0, True))
    width, have = window - gram + 1, 1
    while have * 2 <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < width:
        least = np.minimum(least[: len(least) - (width - have)], least[width - have :])
    differs = least[1:] != least[:-1]
    starts, ends = valid.copy(), valid.copy()
    starts[1:] &= differs | ~valid[:-1]
    ends[:-1] &= differs | ~valid[1:]
    first, last = np.flatnonzero(starts), np.flatnonzero(ends)
    whole = mix(range_hash(prefix_sums(data, 1), first, last + window, 1) + (last - first).astype(np.uint64))
    return first, last, least[first], whole


def all_runs(data: np.ndarray, offsets: np.ndarray, window: int, gram: int):
    parts = []
    for low, high, edges in slices(offsets, window):
        first, last, digit, whole = _window_runs(data[low:high], edges, window, gram)
        parts.append((first + low, last + low, digit, whole))
    if not parts:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
    return tuple(np.concatenate(x) for x in zip(*parts))


def window_hashes(data: np.ndarray, positions: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent fingerprints of the windows at sorted positions."""
    h1, h2 = np.empty(len(positions), np.uint64), np.empty(len(positions), np.uint64)
    at = 0
    while at < len(positions):
        low = int(positions[at])
        stop = int(np.searchsorted(positions, low + SLICE))
        piece = data[low : int(positions[stop - 1]) + window]
        p = positions[at:stop] - low
        h1[at:stop] = range_hash(prefix_sums(piece), p, p + window)
        h2[at:stop] = range_hash(prefix_sums(piece, 1), p, p + window, 1)
        at = stop
    return mix(h1), mix(h2)


def expand(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All window positions of runs that stand in order."""
    counts = last - first + 1
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    return np.repeat(first - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(total)


def _bucket(digit: np.ndarray, n_buckets: int) -> np.ndarray:
    return ((digit >> np.uint64(32)) % np.uint64(n_buckets)).astype(np.int64)


def _low(digit: np.ndarray) -> np.ndarray:
    return digit.astype(np.uint32)


def merge_runs(digit: np.ndarray, whole: np.ndarray, cell: np.ndarray) -> np.ndarray:
    order = np.lexsort((cell, whole, digit))
    d, w, c = digit[order], whole[order], cell[order]
    out = np.zeros(len(d), np.uint8)
    if not len(d):
        return out
    groups, kinds = group_starts(d), group_starts(d, w)
    size, kind_size = np.diff(np.append(groups, len(d))), np.diff(np.append(kinds, len(d)))
    several_cells = np.maximum.reduceat(c, groups) > np.minimum.reduceat(c, groups)
    several_kinds = np.diff(np.append(np.searchsorted(kinds, groups), len(kinds))) > 1
    open_group = np.repeat(several_cells & several_kinds, size)
    answer = np.where(c > np.repeat(c[kinds], kind_size), SEEN, np.where(open_group, OPEN, NONE))
    out[order] = answer
    return out


def merge_windows(low: np.ndarray, high: np.ndarray, cell: np.ndarray) -> np.ndarray:
    order = np.lexsort((cell, high, low))
    l, h, c = low[order], high[order], cell[order]
    out = np.zeros(len(l), np.uint8)
    if len(l):
        kinds = group_starts(l, h)
        out[order] = c > np.repeat(c[kinds], np.diff(np.append(kinds, len(l))))
    return out


def _in_order(group: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]:
    """The rows of a cell by id, bytes, offsets and rank of the id; rows without an id get rank -1 and no bytes."""
    group = group.sort_by([("doc_id", "ascending")])
    data, offsets = text_bytes(group["text"])
    ids, missing = np.asarray(group["doc_id"].fill_null(0)), np.asarray(group["doc_id"].is_null())
    rank = np.zeros(len(ids), np.int64)
    if len(ids):
        rank[1:] = np.cumsum(ids[1:] != ids[:-1])
    rank[missing] = -1
    return group, data, offsets, rank


def _usable(first, last, digit, whole, offsets, rank):
    row = np.searchsorted(offsets, first, "right") - 1
    keep = rank[row] >= 0
    return first[keep], last[keep], digit[keep], whole[keep], rank[row[keep]]


def local_repeats(data, first, last, digit, rank, done: np.ndarray, window: int) -> np.ndarray:
    """Window positions, not `done` yet, that also stand in a row of the cell with a smaller id."""
    order = np.argsort(digit, kind="stable")
    groups = group_starts(digit[order])
    if not len(groups):
        return np.zeros(0, np.int64)
    r = rank[order]
    several = np.maximum.reduceat(r, groups) > np.minimum.reduceat(r, groups)
    chosen = np.sort(order[np.repeat(several, np.diff(np.append(groups, len(r))))])
    positions = expand(first[chosen], last[chosen])
    owner = np.repeat(rank[chosen], last[chosen] - first[chosen] + 1)
    left = ~done[positions]
    positions, owner = positions[left], owner[left]
    if not len(positions):
        return positions
    h1, h2 = window_hashes(data, positions, window)
    order = np.lexsort((owner, h2, h1))
    o = owner[order]
    kinds = group_starts(h1[order], h2[order])
    return positions[order[o > np.repeat(o[kinds], np.diff(np.append(kinds, len(o))))]]


def substring_dedup(docs: DataFrame, window: int = 50, gram: int = 24) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans), one row per row of `docs`.

    A byte goes if it is covered by a `window`-byte string that also starts in a document with a smaller id; all is
    judged on the input. `spans` holds the removed ranges (start, end in bytes).

    Defined cases: a null text is empty; texts shorter than the window lose nothing; rows without an id neither lose
    bytes nor take any; rows that repeat an id are one document and don't take from each other; a text of any length is
    worked on in slices; other columns are ignored; an empty table gives an empty result.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    n_cells = cell_count(docs)
    n_buckets = bucket_count(n_cells)
    cells = dealt(narrow, range_cell(docs, n_cells), n_cells)

    def cell_of(group: pa.Table) -> int:
        return group["cell"][0].as_py()

    def first_pass(group: pa.Table) -> pa.Table:
        cell = cell_of(group)
        _, data, offsets, rank = _in_order(group)
        _, _, digit, whole, _ = _usable(*all_runs(data, offsets, window, gram), offsets, rank)
        return pack(cell, _bucket(digit, n_buckets), n_buckets, _low(digit), whole)[1]

    def codes_of(digit: np.ndarray, answers: pa.Table) -> np.ndarray:
        codes = np.empty(len(digit), np.uint8)
        codes[np.argsort(_bucket(digit, n_buckets).astype(np.uint16 if n_buckets <= 1 << 16 else np.uint32), kind="stable")] = answered(answers, RUNS, "u1", len(digit))
        return codes

    def second_pass(group: pa.Table, answers: pa.Table) -> pa.Table:
        if not group.num_rows:
            return pa.table({"bucket": pa.array([], pa.int32()), "cell": pa.array([], pa.int32()), "a": pa.array([], pa.binary()), "b": pa.array([], pa.binary())})
        cell = cell_of(group)
        _, data, offsets, rank = _in_order(group)
        first, last, digit, _, _ = _usable(*all_runs(data, offsets, window, gram), offsets, rank)
        open_runs = codes_of(digit, answers) == OPEN
        h1, h2 = window_hashes(data, expand(first[open_runs], last[open_runs]), window)
        return pack(cell, _bucket(h1, n_buckets), n_buckets, _low(h1), h2)[1]

    def last_pass(group: pa.Table, answers: pa.Table) -> pa.Table:
        if not group.num_rows:
            return pa.table({"doc_id": group["doc_id"].cast(pa.int64()), **{c: pa.array([], t) for c, t in OUT}})
        group, data, offsets, rank = _in_order(group)
        first, last, digit, _, owner = _usable(*all_runs(data, offsets, window, gram), offsets, rank)
        codes = codes_of(digit, answers)
        done = np.zeros(len(data) + 1, bool)
        seen = codes == SEEN
        done[expand(first[seen], last[seen])] = True
        open_runs = codes == OPEN
        positions = expand(first[open_runs], last[open_runs])
        h1, _ = window_hashes(data, positions, window)
        order = np.argsort(_bucket(h1, n_buckets).astype(np.uint16 if n_buckets <= 1 << 16 else np.uint32), kind="stable")
        done[positions[order[answered(answers, WINDOWS, "u1", len(positions)) == 1]]] = True
        done[local_repeats(data, first, last, digit, owner, done, window)] = True
        removed = np.flatnonzero(done)
        change = np.zeros(len(data) + window + 1, np.int32)
        change[removed] += 1
        change[removed + window] -= 1
        gone = np.cumsum(change)[: len(data)] > 0
        s, e = runs(gone, offsets)
        edge = np.searchsorted(s, offsets)
        total = np.concatenate([[0], np.cumsum(gone)])
        n_removed = total[offsets[1:]] - total[offsets[:-1]]
        digests = []
        for i in range(group.num_rows):
            text = data[offsets[i] : offsets[i + 1]]
            digests.append(hashlib.sha256(text[~gone[offsets[i] : offsets[i + 1]]] if n_removed[i] else text).hexdigest())
        base = np.repeat(offsets[:-1], np.diff(edge))
        spans = pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.StructArray.from_arrays([pa.array(s - base), pa.array(e - base)], ["start", "end"]))
        return pa.table(
            {
                "doc_id": group["doc_id"],
                "n_bytes": pa.array(np.diff(offsets)),
                "n_removed": pa.array(n_removed.astype(np.int64)),
                "n_spans": pa.array(np.diff(edge).astype(np.int64)),
                "kept_sha256": pa.array(digests, pa.string()),
                "spans": spans,
            }
        )

    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    OUT = [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", span)]
    runs_asked = cells.groupBy("cell").applyInArrow(first_pass, PACKED)
    run_answers = keep(ask(runs_asked, merge_runs, "u4", "u8", RUNS), "run-answers")
    windows_asked = cells.groupBy("cell").cogroup(run_answers.groupBy("cell")).applyInArrow(second_pass, PACKED)
    window_answers = ask(windows_asked, merge_windows, "u4", "u8", WINDOWS)
    answers = run_answers.unionByName(window_answers)
    return cells.groupBy("cell").cogroup(answers.groupBy("cell")).applyInArrow(
        last_pass,
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:bigint,end:bigint>>",
    )

