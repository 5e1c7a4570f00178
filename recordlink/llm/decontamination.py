"""Benchmark decontamination: a prefix-filtered set join of item windows with documents.

A window is `window` consecutive words of an item, or all words of a shorter item. It stands for the set of its word
shingles, and a document contains it if it has the same words in a row. Containment asks for every shingle of the set,
so the necessary prefix is one token: the shingle that is rarest among all documents (ties: rarest among the windows).
1. Count, over all documents, in how many each shingle of the benchmark occurs.
2. Join the rarest shingle of every window with the shingles of the documents. A match fixes where the window would
   start; the positional bound drops starts before the document's first word, the length bound those that end after its
   last one.
3. Verify the words of the window there, first by fingerprint, then byte for byte, and mark them as hit.

The documents stay where they are read; the benchmark goes to them. It is cut into pieces and these into blocks of at
most `BLOCK` bytes; a block's index is broadcast, and further blocks are further passes over the documents, whose
findings are merged per text. Windows of equal words are one window with many items.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlink.llm.scratch import keep
from recordlink.llm.textblock import group_starts, mix, row_slices, runs, text_bytes
from recordlink.llm.wordindex import Known, Vocabulary, Words, flat_ranges, words

BLOCK = 8 << 20
PIECE = 4096  # words of an item in one piece
AT_ONCE = 1 << 18  # windows verified at once
SPANS = "array<struct<start:int,end:int>>"


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints of `size` words in a row, by first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total += mix(hashes[i : i + n] + np.uint64(0x9E3779B97F4A7C15 * (i + 1 + 16 * size) & (1 << 64) - 1))
    return total


class Index:
    """Windows of one block of the benchmark: a word sequence with starts and lengths, and the items of each window."""

    def __init__(self, pieces: list[tuple[str, bytes]], window: int, shingle: int):
        self.window, self.shingle = window, shingle
        split = [(item, text.split(b" ")) for item, text in pieces]
        self.vocabulary = Vocabulary({w for _, ws in split for w in ws})
        number = {self._entry(e): e for e in range(len(self.vocabulary))}
        self.sequence = np.array([number[w] for _, ws in split for w in ws], np.int32)
        self.items = sorted({item for item, _ in split})
        of_item = {item: i for i, item in enumerate(self.items)}
        starts, lengths, owners, at = [], [], [], 0
        for item, ws in split:
            m = min(window, len(ws))
            n = len(ws) - m + 1
            starts.append(at + np.arange(n))
            lengths.append(np.full(n, m))
            owners.append(np.full(n, of_item[item]))
            at += len(ws)
        self._distinct(*(np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (starts, lengths, owners)))

    def _entry(self, e: int) -> bytes:
        v = self.vocabulary
        return v.data[v.starts[e] : v.starts[e] + v.lengths[e]].tobytes()

    def _distinct(self, starts: np.ndarray, lengths: np.ndarray, owners: np.ndarray) -> None:
        """Windows of the same words become one."""
        hashes = self.vocabulary.hashes[self.sequence]
        whole = np.zeros(len(starts), np.uint64)
        for m in np.unique(lengths):
            mine = lengths == m
            whole[mine] = shingles(hashes, int(m))[starts[mine]]
        order = np.lexsort((starts, whole, lengths))
        starts, lengths, owners, whole = starts[order], lengths[order], owners[order], whole[order]
        first = np.zeros(len(starts), bool)
        first[group_starts(lengths, whole)] = True
        head = np.maximum.accumulate(np.where(first, np.arange(len(starts)), 0))
        differ = np.zeros(len(starts), bool)  # equal fingerprints, other words: a window of its own
        for i in range(int(lengths.max()) if len(lengths) else 0):
            part = np.flatnonzero(lengths > i)
            differ[part] |= self.sequence[starts[part] + i] != self.sequence[starts[head[part]] + i]
        first |= differ
        window = np.where(differ, np.cumsum(first) - 1, (np.cumsum(first) - 1)[head])
        self.starts, self.lengths = starts[first], lengths[first]
        by_window = np.lexsort((owners, window))
        window, owners = window[by_window], owners[by_window]
        once = np.zeros(len(window), bool)
        once[group_starts(window, owners)] = True
        self.item_of, self.item_from = owners[once], np.searchsorted(window[once], np.arange(len(self.starts) + 1))
        self.hashes = hashes

    def tokens(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Shingle size, windows, place in the window, fingerprint: of every shingle of every window."""
        for m in np.unique(self.lengths):
            mine = np.flatnonzero(self.lengths == m)
            size = int(min(self.shingle, m))
            values = shingles(self.hashes, size)
            for place in range(int(m) - size + 1):
                yield size, mine, np.full(len(mine), place), values[self.starts[mine] + place]

    def all_keys(self) -> dict[int, np.ndarray]:
        found: dict[int, list[np.ndarray]] = {}
        for size, _, _, key in self.tokens():
            found.setdefault(size, []).append(key)
        return {size: np.unique(np.concatenate(keys)) for size, keys in found.items()}

    def choose(self, documents_with: dict[tuple[int, int], int]) -> None:
        """Take the rarest shingle of each window as its prefix; windows with one that no document has are dropped."""
        keys = self.all_keys()
        in_windows = {s: np.zeros(len(k), np.int64) for s, k in keys.items()}
        for size, _, _, key in self.tokens():
            in_windows[size] += np.bincount(np.searchsorted(keys[size], key), minlength=len(keys[size]))
        often = {s: np.zeros(len(k), np.int64) for s, k in keys.items()}
        for (size, entry), n in documents_with.items():
            often[size][entry] = n
        best = np.full(len(self.starts), np.iinfo(np.int64).max)
        second, place_of, key_of = best.copy(), np.zeros(len(best), np.int64), np.zeros(len(best), np.uint64)
        size_of = np.zeros(len(best), np.int64)
        for size, mine, place, key in self.tokens():
            at = np.searchsorted(keys[size], key)
            n, k = often[size][at], in_windows[size][at]
            better = (n < best[mine]) | ((n == best[mine]) & (k < second[mine]))
            to = mine[better]
            best[to], second[to], place_of[to], key_of[to], size_of[to] = n[better], k[better], place[better], key[better], size
        self.prefix = {}
        for size in np.unique(size_of[best > 0]) if len(best) else []:
            mine = np.flatnonzero((size_of == size) & (best > 0))
            mine = mine[np.argsort(key_of[mine], kind="stable")]
            edges = group_starts(key_of[mine])
            self.prefix[int(size)] = (Known(key_of[mine][edges]), mine, place_of[mine], np.append(edges, len(mine)))

    def hits(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """Starts (words) and windows of all occurrences in the rows."""
        row_from = w.rows[:-1]
        row_to = w.rows[1:]
        row = w.row_of()
        starts, found = [], []
        for size, (known, windows, places, edges) in self.prefix.items():
            key = shingles(w.hashes, size)
            position, at = known.find(key)
            many = edges[at + 1] - edges[at]
            for lo, hi in row_slices(np.concatenate([[0], np.cumsum(many)]), AT_ONCE):
                which = flat_ranges(edges[at[lo:hi]], many[lo:hi])
                p = np.repeat(position[lo:hi], many[lo:hi])
                start, window = p - places[which], windows[which]
                fits = (start >= row_from[row[p]]) & (start + self.lengths[window] <= row_to[row[p]])
                start, window = self._verified(w, start[fits], window[fits])
                starts.append(start)
                found.append(window)
        empty = np.zeros(0, np.int64)
        return (np.concatenate(starts), np.concatenate(found)) if starts else (empty, empty)

    def _verified(self, w: Words, start: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for i in range(self.window):
            there = self.lengths[window] > i
            entry = self.sequence[self.starts[window[there]] + i]
            there[there] = w.hashes[start[there] + i] != self.vocabulary.hashes[entry]
            start, window = start[~there], window[~there]
        size = self.lengths[window]
        word, entry = flat_ranges(start, size), self.sequence[flat_ranges(self.starts[window], size)].astype(np.int64)
        pairs, back = np.unique(word * len(self.vocabulary) + entry, return_inverse=True)
        right = self.vocabulary.same(w, pairs // len(self.vocabulary), pairs % len(self.vocabulary))[back]
        wrong = np.add.reduceat(~right, np.cumsum(size) - size) if len(size) else np.zeros(0, int)
        return start[wrong == 0], window[wrong == 0]


def item_pieces(benchmark: DataFrame, window: int) -> DataFrame:
    """(item string, piece binary): the words of every item, one space between them, in overlapping pieces."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch["text"])
            w = words(data, offsets)
            items, pieces = [], []
            for i, item in enumerate(batch["item"].to_pylist()):
                lo, hi = int(w.rows[i]), int(w.rows[i + 1])
                for at in range(lo, max(lo + 1, hi - window + 1), PIECE) if hi > lo else []:
                    items.append(item)
                    pieces.append(b" ".join(w.text(j) for j in range(at, min(hi, at + PIECE + window - 1))))
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(pieces, pa.binary())], ["item", "piece"])

    item = F.coalesce(F.col("item_id").cast("string"), F.lit(""))
    return benchmark.select(item.alias("item"), "text").mapInArrow(cut, "item string, piece binary").distinct()


def _document_counts(docs: DataFrame, keys: dict[int, np.ndarray]) -> dict[tuple[int, int], int]:
    """(shingle size, entry) -> in how many documents the shingle occurs, over all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(keys)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {size: Known(k) for size, k in shared.value.items()}
        totals = {size: np.zeros(len(k), np.int64) for size, k in shared.value.items()}
        for batch in batches:
            data, offsets = text_bytes(batch["text"])
            for lo, hi in row_slices(offsets):
                w = words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                row = w.row_of()
                for size, k in known.items():
                    position, at = k.find(shingles(w.hashes, size))
                    whole = row[position] == row[position + size - 1]
                    in_row = np.unique(row[position[whole]] * len(k.keys) + at[whole])
                    totals[size] += np.bincount(in_row % len(k.keys), minlength=len(k.keys))
        for size, n in totals.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), size, np.int32)), pa.array(some), pa.array(n[some])], ["size", "entry", "n"])

    rows = docs.select("text").mapInArrow(count, "size int, entry long, n long").groupBy("size", "entry").agg(F.sum("n").alias("n")).collect()
    shared.destroy()
    return {(r["size"], r["entry"]): r["n"] for r in rows}


def _scan(docs: DataFrame, index: Index) -> DataFrame:
    """The documents with `n_words`, `spans` (runs of hit words) and `items` (those with a window in the document)."""
    shared = docs.sparkSession.sparkContext.broadcast(index)
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = shared.value
        names = pa.array(ix.items, pa.string())
        for batch in batches:
            data, offsets = text_bytes(batch["text"])
            for lo, hi in row_slices(offsets):
                w = words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                start, window = ix.hits(w)
                edge = np.zeros(len(w.hashes) + 1, np.int64)
                np.add.at(edge, start, 1)
                np.add.at(edge, start + ix.lengths[window], -1)
                first, last = runs(np.cumsum(edge[:-1]) > 0, w.rows)
                row = np.searchsorted(w.rows, first, "right") - 1
                many = ix.item_from[window + 1] - ix.item_from[window]
                item = ix.item_of[flat_ranges(ix.item_from[window], many)]
                pair = np.unique(np.repeat(np.searchsorted(w.rows, start, "right") - 1, many) * max(1, len(names)) + item)
                n = hi - lo
                span_at = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
                item_at = np.searchsorted(pair // max(1, len(names)), np.arange(n + 1)).astype(np.int32)
                spans = pa.StructArray.from_arrays([pa.array((x - w.rows[row]).astype(np.int32)) for x in (first, last)], fields=list(span))
                part = batch.slice(lo, n)
                arrays = [part["doc_id"], part["text_key"], pa.array(np.diff(w.rows)), pa.ListArray.from_arrays(span_at, spans)]
                arrays.append(pa.ListArray.from_arrays(item_at, names.take(pa.array(pair % max(1, len(names))))))
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "text_key", "n_words", "spans", "items"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(mark, f"doc_id {kind}, text_key string, n_words long, spans {SPANS}, items array<string>")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 3, block_bytes: int = BLOCK) -> DataFrame:
    """(doc_id, n_words, spans, items), one row per document.

    `spans` are the maximal runs [start, end) of words that lie in an occurrence of a window, counted in words from 0;
    `items` are the ids of the items with a window in the document, as sorted strings.

    Defined cases: a null text has no words, nor has an empty one; an item without words has no window; rows that repeat
    an item's id count as one item; a null item id is the id ''; a null or repeated doc_id is returned once per row;
    texts of any length are read whole, and long items are cut into overlapping pieces; windows never cross documents or
    items; other columns are ignored; an empty table of documents gives an empty result, an empty benchmark no spans.
    """
    pieces = keep(item_pieces(benchmark, window), "item-pieces")
    total = pieces.agg(F.sum(F.octet_length("piece"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    block = F.pmod(F.xxhash64("piece"), F.lit(blocks)) if blocks > 1 else F.lit(0)
    key = F.md5(F.coalesce("text", F.lit(""))) if blocks > 1 else F.lit(None).cast("string")
    rows = docs.select("doc_id", "text", key.alias("text_key"))
    found = []
    for b in range(blocks):
        index = Index(sorted((r["item"], bytes(r["piece"])) for r in pieces.filter(block == b).collect()), window, shingle)
        keys = index.all_keys()
        index.choose(_document_counts(rows, keys) if keys else {})
        found.append(_scan(rows, index).withColumn("block", F.lit(b)))
    if blocks == 1:
        return found[0].select("doc_id", "n_words", "spans", F.array_sort("items").alias("items"))
    return _merged(found)


def _merged(found: list[DataFrame]) -> DataFrame:
    """Findings of several blocks as one; rows of the same id and text have the same ones and are counted."""
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    same = ["doc_id", "text_key"]
    once = every.groupBy(*same, "block").agg(F.first("n_words").alias("n_words"), F.first("spans").alias("spans"), F.first("items").alias("items"), F.count("*").alias("n"))
    items = F.array_sort(F.array_distinct(F.flatten(F.collect_list("items"))))
    spans = F.array_sort(F.flatten(F.collect_list("spans")))
    together = once.groupBy(*same).agg(F.first("n_words").alias("n_words"), F.max("n").alias("n"), spans.alias("spans"), items.alias("items"))
    copies = together.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for spans in batch["spans"].to_pylist():
                joined: list[dict] = []
                for s in spans:
                    if joined and s["start"] <= joined[-1]["end"]:
                        joined[-1]["end"] = max(joined[-1]["end"], s["end"])
                    else:
                        joined.append(s)
                rows.append(joined)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["n_words"], pa.array(rows, batch["spans"].type), batch["items"]], ["doc_id", "n_words", "spans", "items"])

    out = copies.select("doc_id", "n_words", "spans", "items")
    return out.mapInArrow(join, out.schema)
