"""Best-fit packing of token sequences by the linear grouping scheme.

Pieces of equal length are interchangeable, so the whole packing is decided on the histogram of lengths, at most
`capacity` counts whatever the number of documents:
1. large lengths are sorted and cut into groups of about equal cardinality, and each is rounded up to its group's largest;
2. the few rounded sizes are packed by configurations (how many of each size in one sequence): a linear programme over
   the configurations is solved by column generation and its solution rounded down;
3. actual pieces take the slots of their group, longest first, which frees the rounding again;
4. what is left, and all small pieces, go best-fit: longest first, into the fullest sequences that can take them.
The result is a table of patterns with multiplicities. Each piece finds its slot by its rank among the pieces of its
length; ranks come from counts of (length, shard) and row numbers within them, so no length is one task.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from recordlink.llm.scratch import keep

SHARDS = 64
CACHE = 400_000
TRIED = ((5, 16), (4, 16), (3, 32), (2, 16))  # most large pieces in a sequence, groups


# ---------------------------------------------------------------- the plan over the histogram


def configurations(sizes: list[int], capacity: int) -> np.ndarray:
    """All ways to put pieces of the given sizes into one sequence, maximal ones only."""
    found: list[tuple[int, ...]] = []

    def grow(at: int, left: int, counts: tuple[int, ...]) -> None:
        if at == len(sizes):
            if all(left < s for s in sizes):
                found.append(counts)
            return
        for n in range(left // sizes[at], -1, -1):
            grow(at + 1, left - n * sizes[at], (*counts, n))

    grow(0, capacity, ())
    return np.array(found, np.int64).reshape(-1, len(sizes))


def fractional(configs: np.ndarray, demand: np.ndarray) -> dict[int, float]:
    """Configuration -> how often, covering the demand with the fewest sequences: revised simplex from one-size columns."""
    k = len(demand)
    basis = [int(np.argmax(configs[:, i])) for i in range(k)]
    columns = np.array([np.where(np.arange(k) == i, configs[b, i], 0) for i, b in enumerate(basis)], float).T
    owner: list[int | None] = [None] * k  # None: a one-size column
    for _ in range(200):
        inverse = np.linalg.inv(columns)
        prices = inverse.sum(0)  # every column costs one sequence
        gain = configs @ prices
        best = int(np.argmax(gain))
        if gain[best] <= 1 + 1e-9:
            break
        level, direction = inverse @ demand, inverse @ configs[best]
        ratio = np.where(direction > 1e-9, level / np.maximum(direction, 1e-9), np.inf)
        out = int(np.argmin(ratio))
        columns[:, out], owner[out] = configs[best], best
    level = np.linalg.inv(columns) @ demand
    result: dict[int, float] = {}
    for i in range(k):
        if level[i] > 1e-9:
            at = owner[i] if owner[i] is not None else basis[i]
            result[at] = result.get(at, 0.0) + float(level[i])
    return result


@dataclass
class Pattern:
    """`times` sequences that hold `pieces`: (length, how many) in order of offset."""

    times: int
    pieces: list[tuple[int, int]]

    @property
    def used(self) -> int:
        return sum(length * n for length, n in self.pieces)


class Bins:
    """Patterns by free room: the fullest that can take a length is found first."""

    def __init__(self, capacity: int, patterns: list[Pattern]):
        self.capacity, self.by_room = capacity, {}
        for p in patterns:
            self.add(p)

    def add(self, p: Pattern) -> None:
        self.by_room.setdefault(self.capacity - p.used, []).append(p)

    def take(self, length: int) -> Pattern | None:
        for room in range(length, self.capacity + 1):
            if self.by_room.get(room):
                return self.by_room[room].pop()
        return None

    def all(self) -> list[Pattern]:
        return [p for those in self.by_room.values() for p in those]


def large_patterns(left: np.ndarray, capacity: int, per_bin: int, groups: int) -> list[Pattern]:
    """Steps 1 to 3; takes the placed pieces out of `left` (a count for each length)."""
    large = np.array([s for s in range(capacity // per_bin + 1, capacity) if left[s]], np.int64)
    if not len(large):
        return []
    counts = left[large]
    group = np.minimum((np.cumsum(counts) - 1) * groups // counts.sum(), groups - 1)
    tops = [int(large[group == g].max()) for g in np.unique(group)]
    demand = np.array([int(counts[group == g].sum()) for g in np.unique(group)], float)
    configs = configurations(tops, capacity)
    plan = sorted(fractional(configs, demand).items())
    members = [[int(s) for s in large[group == g][::-1]] for g in np.unique(group)]
    patterns: list[Pattern] = []
    for at, level in plan:
        times = int(level + 1e-9)
        slots = [g for g in range(len(tops)) for _ in range(int(configs[at][g]))]
        while times > 0:
            # the longest pieces left in each slot's group, for as many sequences as they last alike
            chosen: dict[int, int] = {}
            for g in slots:
                s = next((s for s in members[g] if left[s] - chosen.get(s, 0) > 0), None)
                if s is None:
                    continue
                chosen[s] = chosen.get(s, 0) + 1
            if not chosen:
                break
            same = max(1, min([times, *(int(left[s]) // n for s, n in chosen.items())]))
            for s, n in chosen.items():
                left[s] -= n * same
            patterns.append(Pattern(same, sorted(chosen.items(), reverse=True)))
            times -= same
    return patterns


def plan_packing(histogram: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns that place every piece of the histogram (lengths 1 to capacity): the best of a few bounds between
    large and small pieces."""
    plans = [_plan(histogram, capacity, per_bin, groups) for per_bin, groups in TRIED]
    return min(plans, key=lambda patterns: sum(p.times for p in patterns))


def _plan(histogram: dict[int, int], capacity: int, per_bin: int, groups: int) -> list[Pattern]:
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    patterns = [Pattern(int(left[capacity]), [(capacity, 1)])] if left[capacity] else []
    left[capacity] = 0
    bins = Bins(capacity, large_patterns(left, capacity, per_bin, groups))
    queue = [-s for s in range(1, capacity) if left[s]]
    heapq.heapify(queue)
    while queue:
        length = -heapq.heappop(queue)
        while left[length]:
            p = bins.take(length)
            if p is None:
                p = Pattern(int(left[length]), [])
                per_bin = capacity // length
                p.times = max(1, int(left[length]) // per_bin)
            fits = (capacity - p.used) // length
            n = min(fits, int(left[length]))
            times = min(p.times, int(left[length]) // n)
            if times < p.times and p.pieces:
                bins.add(Pattern(p.times - times, p.pieces))
            bins.add(Pattern(times, [*p.pieces, (length, n)]))
            left[length] -= n * times
    return patterns + bins.all()


def slot_table(patterns: list[Pattern]) -> dict[int, np.ndarray]:
    """length -> rows (first rank, pieces per sequence, first sequence, offset), by first rank."""
    rows: dict[int, list] = {}
    placed: dict[int, int] = {}
    sequence = 0
    for p in patterns:
        offset = 0
        for length, n in p.pieces:
            rank = placed.get(length, 0)
            rows.setdefault(length, []).append((rank, n, sequence, offset))
            placed[length] = rank + n * p.times
            offset += n * length
        sequence += p.times
    return {length: np.array(r, np.int64) for length, r in rows.items()}


# ---------------------------------------------------------------- tokens


SPACED = [chr(c) + " " for c in range(0x3001) if chr(c).isspace()]


class Tokens:
    """Ids of whole texts, with a bounded cache of the ids of single words.

    The tokenizer never joins bytes across a space that follows a non-space, or is the last of a run of white space,
    so a text may be cut before such spaces and each word looked up. Texts with other spaces are encoded whole.
    """

    def __init__(self, path: str):
        model = Tokenizer.from_file(path)
        specials = {t.content: i for i, t in model.get_added_tokens_decoder().items()}
        ranks = _byte_ranks(model, specials)
        self.encoding = tiktoken.Encoding("from-file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=specials)
        self.specials = list(specials)
        self.whole = re.compile(r"\s \s|\s \Z")
        self.words = _Words(self._ids)

    def _ids(self, text: str) -> bytes:
        return array("I", self.encoding.encode_ordinary(text)).tobytes()

    def __call__(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if any(s in text for s in self.specials):
            return array("I", self.encoding.encode(text, allowed_special="all")).tobytes()
        if any(pair in text for pair in SPACED) and self.whole.search(text):
            return self._ids(text)
        if len(self.words) > CACHE:
            self.words.clear()
        head, *rest = text.split(" ")
        return self._ids(head) + b"".join(map(self.words.__getitem__, rest))


class _Words(dict):
    """Word -> ids of the word after a space; long words are not kept."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(" " + word)
        if len(word) < 64:
            self[word] = ids
        return ids


# Fixed value: how the tokenizer file's byte-level splitter cuts a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_ranks(model, specials: dict[str, int]) -> dict[bytes, int]:
    """Vocabulary by bytes. Printable bytes stand for themselves, the others for characters from 256 on, in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
    return {bytes(byte_of[c] for c in token): i for token, i in model.get_vocab(with_added_tokens=False).items() if token not in specials}


_LOADED: dict[str, Tokens] = {}


def tokenise(docs: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids), a row per piece of at most `capacity` ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _LOADED.get(path) or _LOADED.setdefault(path, Tokens(path))
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                ids = tokens(text.as_py() or "") + end
                n = len(ids) // 4
                first = n % capacity or capacity
                for piece, start in enumerate([0, *range(first, n, capacity)]):
                    stop = first if piece == 0 else start + capacity
                    part = ids[4 * start : 4 * stop]
                    rows.append((doc_id, piece, start, stop - start, zlib.crc32(part)))
                if len(rows) >= 20_000:
                    yield _piece_rows(rows)
                    rows = []
            if rows:
                yield _piece_rows(rows)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def _piece_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece.

    Ids of a document are those of the tokenizer file, then `end_id`. Documents of more than `capacity` ids are cut into
    pieces of `capacity`, the first of which may be shorter.

    Defined cases: a null text is empty and is the end id alone; rows that repeat an id are packed each on its own; a
    null id is kept; a text of any length is tokenised whole; other columns are ignored; an empty table gives an empty
    result.
    """
    pieces = tokenise(docs, tokenizer, capacity, end_id)
    shard = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SHARDS)).cast("int")
    pieces = keep(pieces.withColumn("shard", shard), "pieces")
    counts = pieces.groupBy("length", "shard").agg(F.count("*").alias("n"))
    table = counts.orderBy("length", "shard").collect()  # at most capacity * SHARDS numbers
    histogram: dict[int, int] = {}
    base: dict[int, list[int]] = {}
    for r in table:
        shards = base.setdefault(r["length"], [0] * SHARDS)
        shards[r["shard"]] = histogram.get(r["length"], 0)
        histogram[r["length"]] = histogram.get(r["length"], 0) + r["n"]
    slots = slot_table(plan_packing(histogram, capacity))
    starts = {length: np.array(x, np.int64) for length, x in base.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, shard, number = (np.asarray(batch[c]) for c in ("length", "shard", "number"))
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for value in np.unique(length):
                at = np.flatnonzero(length == value)
                rank = starts[value][shard[at]] + number[at] - 1
                rows = slots[value]
                row = rows[np.searchsorted(rows[:, 0], rank, "right") - 1]
                sequence[at] = row[:, 2] + (rank - row[:, 0]) // row[:, 1]
                offset[at] = row[:, 3] + (rank - row[:, 0]) % row[:, 1] * value
            kept = [batch[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    order = Window.partitionBy("length", "shard").orderBy("doc_id", "piece", "ids_crc32")
    numbered = pieces.withColumn("number", F.row_number().over(order).cast("long"))
    return numbered.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
