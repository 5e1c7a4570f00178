"""Ranked lexical search: every item of a query table against all documents, through tries of frequency-ordered terms.

A document's vector is restricted to the terms that some item asks for, ordered by document frequency, most frequent
first. Documents in the order of their vectors are the leaves of a trie: a subtree is a run of documents whose vectors
begin alike, and is split where they part. Each subtree keeps the largest tf of each of its terms, the smallest m and
the smallest id. As a score rises with tf and falls with m, these bound every score below. An item goes through a trie
depth first, the best bound first, and leaves out subtrees that cannot reach its k-th best score so far, or only tie it
with larger ids. All arithmetic is in 64-bit integers.

1. The items' terms are broadcast, and each document gives its restricted vector and its number of terms.
2. N, L and the document frequencies are aggregated from these vectors.
3. Vectors are range-partitioned and sorted by the head of their path, then by id, so that a partition holds a part of
   the trie and equal vectors can be parted. A task builds a trie for every `TRIE` entries and carries the k best of
   each item on from trie to trie.
4. The k best of each task are merged in two steps.
Items are dealt into blocks of at most `BLOCK` bytes of text; each block is one search over all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordlink.llm.scratch import keep
from recordlink.llm.textblock import group_starts, row_slices, text_bytes
from recordlink.llm.wordindex import Vocabulary, flat_ranges, words

BLOCK = 8 << 20
HEAD = 16  # terms of a path that partitions and splits look at
LEAF = 32
TRIE = 2_000_000  # entries of vectors in one trie
LARGEST = np.iinfo(np.int64).max


def _binary(parts: list[np.ndarray], kind: str) -> pa.Array:
    return pa.array([x.astype(kind).tobytes() for x in parts], pa.binary())


def _unpacked(column: pa.ChunkedArray | pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_bytes(column)
    return data.view(kind), offsets // np.dtype(kind).itemsize


# ---------------------------------------------------------------- vectors


def restricted_vectors(docs: DataFrame, terms: Vocabulary) -> DataFrame:
    """(doc_id, n, terms, tfs): the number of all terms of a document; known terms and how often it has them, packed."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            data, offsets = text_bytes(batch["text"])
            for lo, hi in row_slices(offsets):
                w = words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                word, term = known.find(w)
                row = np.searchsorted(w.rows, word, "right") - 1
                pair, tf = np.unique(row * max(1, len(known)) + term, return_counts=True)
                edges = np.searchsorted(pair // max(1, len(known)), np.arange(hi - lo + 1))
                term = pair % max(1, len(known))
                cut = list(zip(edges[:-1], edges[1:]))
                packed = [_binary([x[s:e] for s, e in cut], "<u4") for x in (term, tf)]
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(lo, hi - lo), pa.array(np.diff(w.rows)), *packed], ["doc_id", "n", "terms", "tfs"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n long, terms binary, tfs binary")


def document_frequencies(vectors: DataFrame, n_terms: int) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(_unpacked(batch["terms"], "<u4")[0], minlength=n_terms)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "n"])

    found = vectors.select("terms").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(n_terms, np.int64)
    for r in found:
        out[r["term"]] = r["n"]
    return out


def paths(vectors: DataFrame, rank: np.ndarray, documents: int, total: int) -> DataFrame:
    """(doc_id, m, head, path, tfs): terms as their places in order of frequency, ascending; documents without are left out."""
    shared = vectors.sparkSession.sparkContext.broadcast(rank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, offsets = _unpacked(batch["terms"], "<u4")
            tfs, _ = _unpacked(batch["tfs"], "<u4")
            place = shared.value[terms]
            order = np.lexsort((place, np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))))
            place, tfs = place[order], tfs[order]
            cut = list(zip(offsets[:-1], offsets[1:]))
            head = _binary([place[s : min(e, s + HEAD)] for s, e in cut], ">u4")
            n = np.asarray(batch["n"])
            m = pa.array([10 + (90 * int(x) * documents) // max(1, total) for x in n], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], m, head, _binary([place[s:e] for s, e in cut], "<u4"), _binary([tfs[s:e] for s, e in cut], "<u4")], ["doc_id", "m", "head", "path", "tfs"]
            )

    some = vectors.filter(F.octet_length("terms") > 0)
    return some.mapInArrow(run, "doc_id long, m long, head binary, path binary, tfs binary")


# ---------------------------------------------------------------- the trie


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


class Trie:
    """Documents in the order of their paths, and the subtrees over them."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, path: np.ndarray, tf: np.ndarray, offsets: np.ndarray):
        n, length = len(ids), np.diff(offsets)
        head = np.full((n, HEAD), -1, np.int64)  # a path that ends comes first
        for i in range(HEAD):
            longer = np.flatnonzero(length > i)
            head[longer, i] = path[offsets[longer] + i]
        order = np.lexsort((ids, m, *head.T[::-1]))
        head = head[order]
        at = flat_ranges(offsets[order], length[order])
        self.ids, self.m, self.path, self.tf = ids[order], m[order], path[at], tf[at].astype(np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(length[order])])
        same = head[1:] == head[:-1]
        self.common = np.concatenate([[0], np.where(same.all(1), HEAD, np.argmin(same, 1)) if n > 1 else []]).astype(np.int64)
        self._grow(n)
        self._bounds()

    def _grow(self, n: int) -> None:
        """Subtrees as ranges of documents, parents before children, children side by side."""
        self.low, self.high, self.first, self.last = [0], [n], [0], [0]
        at = 0
        while at < len(self.low):
            low, high = self.low[at], self.high[at]
            if high - low > LEAF:
                inner = self.common[low + 1 : high]
                shared = int(inner.min())
                edges = [low, *(np.flatnonzero(inner == shared) + low + 1).tolist(), high] if shared < HEAD else [*range(low, high, LEAF), high]
                self.first[at] = len(self.low)
                start = low
                for i, edge in enumerate(edges[1:], 1):  # small neighbours share a leaf
                    if edge == high or edges[i + 1] - start > LEAF:
                        self.low.append(start)
                        self.high.append(edge)
                        self.first.append(0)
                        self.last.append(0)
                        start = edge
                self.last[at] = len(self.low)
            at += 1

    def _bounds(self) -> None:
        """Largest tf of each term in each subtree, listed by term; smallest m and id."""
        count = len(self.low)
        self.least_m, self.least_id = np.empty(count, np.int64), np.empty(count, np.int64)
        leaves = [i for i in range(count) if not self.last[i]]
        leaf_of = np.repeat(leaves, [self.high[i] - self.low[i] for i in leaves])[np.argsort(np.concatenate([np.arange(self.low[i], self.high[i]) for i in leaves]))]
        node = np.repeat(leaf_of, np.diff(self.offsets))
        for i in leaves:
            self.least_m[i] = self.m[self.low[i] : self.high[i]].min()
            self.least_id[i] = self.ids[self.low[i] : self.high[i]].min()
        parent = np.zeros(count, np.int64)
        depth = np.zeros(count, np.int64)
        for i in range(count):
            parent[self.first[i] : self.last[i]] = i
            depth[self.first[i] : self.last[i]] = depth[i] + 1
        for i in range(count - 1, -1, -1):
            if self.last[i]:
                self.least_m[i] = self.least_m[self.first[i] : self.last[i]].min()
                self.least_id[i] = self.least_id[self.first[i] : self.last[i]].min()
        nodes, terms, most = _largest(node, self.path.astype(np.int64), self.tf)
        found = [(nodes, terms, most)]
        for d in range(int(depth.max()), 0, -1):  # level by level upwards, each with what its children gave
            mine = depth[nodes] == d
            up = _largest(parent[nodes[mine]], terms[mine], most[mine])
            found.append(up)
            nodes, terms, most = (np.concatenate([a[~mine], b]) for a, b in zip((nodes, terms, most), up))
        nodes, terms, most = _largest(*(np.concatenate(x) for x in zip(*found)))
        by_term = np.argsort(terms, kind="stable")
        self.nodes, terms, self.most = nodes[by_term], terms[by_term], most[by_term]
        self.term_from = group_starts(terms)
        self.terms = terms[self.term_from]
        self.term_from = np.append(self.term_from, len(terms))

    def maxima(self, terms: np.ndarray) -> np.ndarray:
        """Largest tf by subtree and given term."""
        out = np.zeros((len(self.low), len(terms)), np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        for j in np.flatnonzero(self.terms[at] == terms):
            part = slice(self.term_from[at[j]], self.term_from[at[j] + 1])
            out[self.nodes[part], j] = self.most[part]
        return out

    def search(self, terms: np.ndarray, weights: np.ndarray, slot: np.ndarray, best: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best (score, id) of `best` and the documents. `slot` is -1 for all terms, and is left so."""
        most = self.maxima(terms)
        if not most[0].any():
            return best
        slot[terms] = np.arange(len(terms))
        bound = lambda a, b: (weights * gain(most[a:b], self.least_m[a:b, None])).sum(1)
        scores, ids = best
        stack = [(int(bound(0, 1)[0]), 0)]
        while stack:
            top, node = stack.pop()
            if top <= 0 or len(scores) == k and (top < scores[-1] or top == scores[-1] and self.least_id[node] > ids[-1]):
                continue
            first, last = self.first[node], self.last[node]
            if last:
                below = bound(first, last)
                stack += [(int(below[i]), first + int(i)) for i in np.argsort(below, kind="stable")]
                continue
            low, high = self.low[node], self.high[node]
            lo, hi = self.offsets[low], self.offsets[high]
            wanted = slot[self.path[lo:hi]]
            doc = np.repeat(np.arange(high - low), np.diff(self.offsets[low : high + 1]))
            use = np.flatnonzero(wanted >= 0)
            part = weights[wanted[use]] * gain(self.tf[lo:hi][use], self.m[low + doc[use]])
            found = np.zeros(high - low, np.int64)
            np.add.at(found, doc[use], part)
            scores, ids = k_best(np.concatenate([scores, found]), np.concatenate([ids, self.ids[low:high]]), k)
        slot[terms] = -1
        return scores, ids


def _largest(node: np.ndarray, term: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((term, node))
    node, term, value = node[order], term[order], value[order]
    edges = group_starts(node, term)
    return node[edges], term[edges], np.maximum.reduceat(value, edges) if len(value) else value


def k_best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    some = np.flatnonzero(scores > 0)
    order = some[np.lexsort((ids[some], -scores[some]))][:k]
    return scores[order], ids[order]


# ---------------------------------------------------------------- the search


def search_block(docs: DataFrame, items: list[tuple[str | None, set[bytes]]], k: int) -> DataFrame:
    """(item string, doc_id, score): the k best documents of each item, by task."""
    spark = docs.sparkSession
    terms = Vocabulary(set().union(*(t for _, t in items)) if items else set())
    vectors = keep(restricted_vectors(docs, terms), "term-vectors")
    N, L = vectors.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = document_frequencies(vectors, len(terms))
    order = np.argsort(-df, kind="stable")
    rank = np.empty(len(terms), np.int64)
    rank[order] = np.arange(len(terms))
    weight = np.array([math.floor(1000 * math.log((2 * N + 2) / (2 * int(d) + 1))) for d in df[order]], np.int64)
    entry = {terms.data[s : s + n].tobytes(): e for e, (s, n) in enumerate(zip(terms.starts.tolist(), terms.lengths.tolist()))}
    asked = [(item, np.sort(rank[[entry[t] for t in found]]) if found else np.zeros(0, np.int64)) for item, found in items]
    shared = spark.sparkContext.broadcast((weight, asked))
    width = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = paths(vectors, rank, N, L).repartitionByRange(width, "head", "doc_id").sortWithinPartitions("head", "doc_id")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, asked = shared.value
        slot = np.full(len(weight), -1, np.int64)
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in asked]
        for ids, m, path, tf, offsets in _tries(batches):
            trie = Trie(ids, m, path, tf, offsets)
            for i, (_, wanted) in enumerate(asked):
                if len(wanted):
                    best[i] = trie.search(wanted, weight[wanted], slot, best[i], k)
        for (item, _), (scores, ids) in zip(asked, best):
            if len(scores):
                columns = [pa.array([item] * len(ids), pa.string()), pa.array(ids, pa.int64(), mask=ids == LARGEST), pa.array(scores)]
                yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    return dealt.mapInArrow(search, "item string, doc_id long, score long")


def _tries(batches: Iterator[pa.RecordBatch]):
    """Arrays of the documents of one trie after the other."""
    held: list[tuple] = []
    size = 0
    for batch in batches:
        path, offsets = _unpacked(batch["path"], "<u4")
        tfs, _ = _unpacked(batch["tfs"], "<u4")
        ids = np.asarray(batch["doc_id"].fill_null(LARGEST))
        m = np.asarray(batch["m"])
        for lo, hi in row_slices(offsets, TRIE // 4):
            held.append((ids[lo:hi], m[lo:hi], path[offsets[lo] : offsets[hi]], tfs[offsets[lo] : offsets[hi]], np.diff(offsets[lo : hi + 1])))
            size += offsets[hi] - offsets[lo]
            if size >= TRIE:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held: list[tuple]) -> tuple:
    ids, m, path, tf, lengths = (np.concatenate(x) for x in zip(*held))
    return ids, m, path, tf, np.concatenate([[0], np.cumsum(lengths)])


def item_terms(items: DataFrame) -> DataFrame:
    """(item string, term binary), distinct. Rows that repeat an id add their terms; a null id is the id null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch["text"])
            w = words(data, offsets)
            row = w.row_of()
            found = pa.array([w.text(i) for i in range(len(w.hashes))], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["item"].take(pa.array(row)), found], ["item", "term"])

    return items.select(F.col("item_id").cast("string").alias("item"), "text").mapInArrow(run, "item string, term binary").distinct()


def lexical_search(docs: DataFrame, items: DataFrame, k: int = 10, block_bytes: int = BLOCK) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of each item with the highest scores above 0, ties to smaller ids.

    Defined cases: a null or empty text has no terms and is no result; rows that repeat an id are documents of their own,
    each with its rank; a null doc_id ranks after all others of its score; rows that repeat an item's id are one item
    with the terms of all; a null item id is an item; an item without known terms has no rows; texts of any length are
    read whole; other columns are ignored; an empty table on either side gives an empty result.
    """
    terms = keep(item_terms(items), "item-terms")
    total = terms.agg(F.sum(F.octet_length("term") + 32)).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    block = F.pmod(F.xxhash64("item"), F.lit(blocks))
    found = None
    for b in range(blocks):
        listed: dict[str | None, set[bytes]] = {}
        for r in terms.filter(block == b).collect():
            listed.setdefault(r["item"], set()).add(bytes(r["term"]))
        part = search_block(docs, sorted(listed.items(), key=lambda x: (x[0] is not None, x[0] or "")), k)
        found = part if found is None else found.unionByName(part)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    task = F.pmod(F.xxhash64(F.spark_partition_id()), F.lit(256))
    first = found.withColumn("task", task).withColumn("rank", F.row_number().over(Window.partitionBy("item", "task").orderBy(*order))).filter(F.col("rank") <= k)
    last = first.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)
    kind = items.schema["item_id"].dataType.simpleString()
    return last.select(F.col("item").cast(kind).alias("item_id"), F.col("rank").cast("int").alias("rank"), "doc_id", "score")
