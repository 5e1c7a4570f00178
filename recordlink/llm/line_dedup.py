"""Line dedup by an exact set-similarity join.

A line is the set of its words. Words are ordered by rarity over the whole table (ties by fingerprint); two sets whose
Jaccard similarity reaches the threshold share a word among the rarest few of each (prefix filter), have similar sizes
(length filter), and enough words must be left behind the shared one (positional filter). What passes is verified on the
full sets, and a line goes if any earlier line, in (doc_id, line number) order, matches it.

Lines with equal sets are one class, known by its first position. Three steps keep the join small:
- rarity comes from a table of word counts over all lines, hashed to a fixed number of counters; two words that share
  a counter only share a place in the order, which stays one and the same for all lines;
- the cells send each class's prefix words with its size and a bitmap of its words, and learn per word whether any
  other class in that list can match (length filter, bitmap bound of the difference of two sets). Only classes with such
  a word, and copies, become rows;
- the lists of these rows are not paired out: first each member is held against the earliest of its list; only members
  that this leaves without an earlier match are then held against all earlier ones, in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlink.llm.cells import PACKED, answered, ask, bucket_count, cells_for, pack
from recordlink.llm.scratch import discard, keep
from recordlink.llm.textblock import group_starts, mix, row_slices, signed, text_bytes, white_words

ALIVE = 1
BITMAP = 64  # bytes
COUNTERS, PART = 1 << 20, 1 << 14
LONG = 1 << 13
BLOCK = 2048


class Lines:
    """Lines of the rows of a cell and the word sets of those that have words."""

    def __init__(self, texts: pa.ChunkedArray):
        self.data, self.offsets = data, offsets = text_bytes(texts)
        cut = np.flatnonzero(data == 10) + 1
        row = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, cut - 1, "right") - 1])
        start = np.concatenate([offsets[:-1], cut])
        order = np.lexsort((start, row))
        self.row, self.start = row[order], start[order]
        self.first_line = np.searchsorted(self.row, np.arange(len(offsets)))
        self.number = np.arange(len(self.row)) - self.first_line[self.row] if len(self.row) else self.row
        self.end = np.empty(len(self.row), np.int64)
        if len(self.row):
            self.end[:-1] = self.start[1:] - 1
            self.end[self.first_line[1:] - 1] = offsets[1:]
        lines, words = [], []
        for a, b in row_slices(offsets):
            s, _, w = white_words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            lines.append(np.searchsorted(self.start, s + offsets[a], "right") - 1)
            words.append(w)
        line = np.concatenate(lines) if lines else np.zeros(0, np.int64)
        word = np.concatenate(words) if words else np.zeros(0, np.uint64)
        order = np.argsort((line.astype(np.uint64) << np.uint64(40)) | (word >> np.uint64(24)))
        line, word = line[order], word[order]
        new = group_starts(line, word)
        line, self.word = line[new], word[new]
        heads = group_starts(line)
        self.line = line[heads]  # lines that have words
        self.edges = np.append(heads, len(line))
        self.size = np.diff(self.edges)
        if len(heads):
            self.h1 = mix(np.add.reduceat(mix(self.word), heads) + self.size.astype(np.uint64))
            self.h2 = np.add.reduceat(mix(self.word ^ np.uint64(0xA5A5A5A55A5A5A5A)), heads)
        else:
            self.h1 = self.h2 = np.zeros(0, np.uint64)

    def classes(self, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First line of each class by (rank of the id, line number), in a fixed order, and the lines in each."""
        order = np.lexsort((self.number[self.line], rank[self.row[self.line]], self.h2, self.h1))
        first = group_starts(self.h1[order], self.h2[order])
        return order[first], np.diff(np.append(first, len(order)))


def _ranks(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Place of each row by id (nulls last) and text fingerprint, and whether it is the first of rows that agree in both."""
    keyed = group.select(["doc_id", "__sub"]).append_column("__i", pa.array(np.arange(group.num_rows)))
    ordered = keyed.sort_by([("doc_id", "ascending"), ("__sub", "ascending"), ("__i", "ascending")])
    order, rank, fresh = np.asarray(ordered["__i"]), np.empty(group.num_rows, np.int64), np.zeros(group.num_rows, bool)
    rank[order] = np.arange(group.num_rows)
    ids, null, sub = np.asarray(ordered["doc_id"].fill_null(0)), np.asarray(ordered["doc_id"].is_null()), np.asarray(ordered["__sub"])
    fresh[order[group_starts(ids, null, sub)]] = True
    return rank, fresh


def _bucket(key: np.ndarray, n_buckets: int) -> np.ndarray:
    return ((key >> np.uint64(32)) % np.uint64(n_buckets)).astype(np.int64)


def _prefix(size: np.ndarray, percent: int) -> np.ndarray:
    return size - -(-size * percent // 100) + 1


def _bitmap(words: np.ndarray) -> np.ndarray:
    bits = np.zeros(BITMAP * 8, np.uint8)
    bits[(words & np.uint64(BITMAP * 8 - 1)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


CLASS_ROWS = "cell int, h1 long, h2 long, doc_id long, sub long, line int, n int, words binary, postings array<bigint>, places array<int>, bits array<bigint>"
FIELDS = [
    ("cell", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()), ("sub", pa.int64()), ("line", pa.int32()), ("n", pa.int32()),
    ("words", pa.binary()), ("postings", pa.list_(pa.int64())), ("places", pa.list_(pa.int32())), ("bits", pa.list_(pa.int64())),
]


ENTRY = np.dtype([("h", "u4"), ("h_more", "u2"), ("low", "u8"), ("high", "u4"), ("n", "u2")])  # a class: fingerprint, bitmap, size


def word_counts(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Rank of each counter by how often its words occur, over all rows, and the bytes of all texts.

    `COUNTERS` numbers, whatever the size of the table.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS + 1, np.int64)
        for batch in batches:
            data, offsets = text_bytes(batch["text"])
            total[COUNTERS] += len(data)
            for a, b in row_slices(offsets):
                _, _, words = white_words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                np.add.at(total, (words & np.uint64(COUNTERS - 1)).astype(np.int64), 1)
        parts = [total[at : at + PART] for at in range(0, len(total), PART)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(parts), dtype=np.int32)), pa.array([x.tobytes() for x in parts], pa.binary())], ["part", "n"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_buffer(), np.int64) for x in group["n"])
        return pa.table({"part": group["part"].slice(0, 1), "run": group["run"].slice(0, 1), "n": pa.array([total.tobytes()], pa.binary())})

    found = docs.select("text").mapInArrow(count, "part int, n binary").withColumn("run", F.spark_partition_id())
    for _ in range(3):  # 64 counts at a time, so that no group grows with the number of tasks
        fewer = F.floor(F.col("run") / 64).cast("int").alias("run")
        found = found.select("part", fewer, "n").groupBy("part", "run").applyInArrow(add, "part int, run int, n binary")
    found = found.groupBy("part").agg(F.collect_list("n").alias("n")).collect()  # COUNTERS numbers
    total = np.zeros(COUNTERS + 1, np.int64)
    for r in found:
        part = sum(np.frombuffer(bytes(x), np.int64) for x in r["n"])
        total[r["part"] * PART : r["part"] * PART + len(part)] = part
    total, size = total[:COUNTERS], int(total[COUNTERS])
    # only the order matters: the rank of the count, in 16 bits
    return (np.searchsorted(np.sort(total), total) >> max(0, COUNTERS.bit_length() - 17)).astype(np.uint16), size


class Ordered:
    """The classes of a cell with their words by rarity, and the words of their prefixes."""

    def __init__(self, group: pa.Table, rarity: np.ndarray, percent: int):
        self.lines = lines = Lines(group["text"])
        self.picked, self.copies = lines.classes(_ranks(group)[0])
        size = lines.size[self.picked]
        at = np.repeat(lines.edges[self.picked] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum()) if len(size) else np.zeros(0, np.int64)
        word, owner = lines.word[at], np.repeat(np.arange(len(size)), size)
        heads = self.edges_of(size)[:-1]
        place = (word >> np.uint64(32)) % np.uint64(96)
        bit = np.uint64(1) << (place % np.uint64(64))
        low, high = (np.bitwise_or.reduceat(np.where(place // np.uint64(64) == half, bit, np.uint64(0)), heads) if len(size) else bit for half in (0, 1))
        # lines are in the order of their words' fingerprints: a stable sort by rarity within the line breaks ties alike everywhere
        order = np.argsort((owner.astype(np.uint64) << np.uint64(16)) | rarity[(word & np.uint64(COUNTERS - 1)).astype(np.int64)], kind="stable")
        self.word, self.owner = word[order], owner
        self.edges = self.edges_of(size)
        place = np.arange(len(word)) - self.edges[owner]
        self.posted = np.flatnonzero((place < _prefix(size, percent)[owner]) & (size[owner] > 3))
        self.place = place
        # entries: the words of the prefixes, then the classes themselves (to learn of copies)
        of = np.concatenate([owner[self.posted], np.arange(len(size))])
        self.keys = np.concatenate([mix(self.word[self.posted]), mix(lines.h1[self.picked] ^ np.uint64(0x5555AAAA5555AAAA))])
        self.entries = np.empty(len(of), ENTRY)
        h = lines.h1[self.picked]
        self.entries["h"], self.entries["h_more"] = h.astype(np.uint32)[of], (h >> np.uint64(32)).astype(np.uint16)[of]
        self.entries["low"], self.entries["high"], self.entries["n"] = low[of], high.astype(np.uint32)[of], np.minimum(size, 65535)[of]
        own = self.entries[len(self.posted) :]
        own["low"] = own["high"] = 0  # the mark of a class entry
        own["n"] = np.minimum(self.copies, 2)

    @staticmethod
    def edges_of(size: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(size)]).astype(np.int64)


def merge_lists(percent: int):
    """Whether an entry has another class in its list that passes the filters; for a class entry, whether it has copies."""

    def merge(key: np.ndarray, entry: np.ndarray, cell: np.ndarray) -> np.ndarray:
        order = np.argsort((key.astype(np.uint64) << np.uint64(32)) | entry["n"])
        k, low, high = key[order], entry["low"][order], entry["high"][order]
        h = entry["h"][order].astype(np.uint64) | (entry["h_more"][order].astype(np.uint64) << np.uint64(32))
        n, alive = entry["n"][order].astype(np.int64), np.zeros(len(k), bool)
        is_class = (low == 0) & (high == 0)
        heads = group_starts(k)
        if not len(heads):
            return np.zeros(0, np.uint8)
        count = np.diff(np.append(heads, len(k)))
        copies = np.add.reduceat(np.where(is_class, n, 0), heads)
        alive |= is_class & np.repeat(copies > 1, count)
        # long lists go on unfiltered: the blocks of the next step are made for them
        long_list = np.repeat(count > LONG, count)
        alive |= long_list & ~is_class
        left = np.repeat(heads + count, count) - np.arange(len(k)) - 1  # entries that follow in the list
        shift, at = 1, np.flatnonzero((left > 0) & ~long_list & ~is_class)
        while len(at):
            to = at + shift
            near = n[at] * 100 >= n[to] * percent  # sizes ascend: once too far apart, for good
            at, to = at[near], to[near]
            far = (np.bitwise_count(low[at] ^ low[to]) + np.bitwise_count(high[at] ^ high[to])).astype(np.int64)
            fits = (h[at] != h[to]) & (far * (100 + percent) <= (100 - percent) * (n[at] + n[to]))
            alive[at[fits]] = True
            alive[to[fits]] = True
            shift += 1
            at = at[left[at] >= shift]
        out = np.zeros(len(k), np.uint8)
        out[order] = alive
        return out

    return merge


def shared_lines(cells: DataFrame, n_buckets: int, percent: int, rarity: np.ndarray) -> DataFrame:
    """One row per (cell, class) that has copies or may match another class: its first position and its set by rarity."""

    def first_pass(group: pa.Table) -> pa.Table:
        o = Ordered(group, rarity, percent)
        return pack(group["__cell"][0].as_py(), _bucket(o.keys, n_buckets), n_buckets, o.keys.astype(np.uint32), o.entries)[1]

    def second_pass(group: pa.Table, answers: pa.Table) -> pa.Table:
        if not group.num_rows:
            return pa.table({n: pa.array([], t) for n, t in FIELDS})
        o = Ordered(group, rarity, percent)
        lines, picked = o.lines, o.picked
        alive = np.empty(len(o.keys), bool)
        order = np.argsort(_bucket(o.keys, n_buckets).astype(np.uint16 if n_buckets <= 1 << 16 else np.uint32), kind="stable")
        alive[order] = answered(answers, ALIVE, "u1", len(o.keys)) == 1
        copied, posted = alive[len(o.posted) :], o.posted[alive[: len(o.posted)]]
        n_posted = np.bincount(o.owner[posted], minlength=len(picked))
        chosen = np.flatnonzero((n_posted > 0) | copied)
        active = n_posted[chosen] > 0
        pick = picked[chosen]
        line = lines.line[pick]
        p_edges = np.concatenate([[0], np.cumsum(n_posted)])
        p_words, p_places = signed(o.word[posted]), o.place[posted]
        ids = group["doc_id"].cast(pa.int64()).take(pa.array(lines.row[line]))
        sets = [o.word[o.edges[c] : o.edges[c + 1]] if a else None for c, a in zip(chosen, active)]
        return pa.table(
            {
                "cell": pa.array(np.full(len(chosen), group["__cell"][0].as_py(), np.int32)),
                "h1": pa.array(signed(lines.h1[pick])),
                "h2": pa.array(signed(lines.h2[pick])),
                "doc_id": ids,
                "sub": group["__sub"].take(pa.array(lines.row[line])),
                "line": pa.array(lines.number[line].astype(np.int32)),
                "n": pa.array(lines.size[pick].astype(np.int32)),
                "words": pa.array([None if s is None else s.tobytes() for s in sets], pa.binary()),
                "postings": pa.array([p_words[p_edges[c] : p_edges[c + 1]] if a else None for c, a in zip(chosen, active)], pa.list_(pa.int64())),
                "places": pa.array([p_places[p_edges[c] : p_edges[c + 1]] if a else None for c, a in zip(chosen, active)], pa.list_(pa.int32())),
                "bits": pa.array([None if s is None else _bitmap(s) for s in sets], pa.list_(pa.int64())),
            }
        )

    asked = cells.groupBy("__cell").applyInArrow(first_pass, PACKED)
    answers = ask(asked, merge_lists(percent), "u4", ENTRY, ALIVE)
    return cells.groupBy("__cell").cogroup(answers.groupBy("cell")).applyInArrow(second_pass, CLASS_ROWS)


def _overlap_bound(percent: int, nx, ny):
    """Words that two sets must share: percent * (nx + ny) / (100 + percent), rounded up."""
    return F.ceil((nx + ny) * percent / F.lit(100.0 + percent) - F.lit(1e-9))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Keys (x1, x2) of classes `x` for which an earlier class `y` matches on the full sets."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch["wx"], batch["wy"]):
                both = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                good.append(100 * common >= percent * (len(both) - common))
            yield pa.RecordBatch.from_arrays([batch["x1"], batch["x2"]], ["x1", "x2"]).filter(pa.array(good, pa.bool_()))

    side = lambda s: sets.select(F.col("h1").alias(f"{s}1"), F.col("h2").alias(f"{s}2"), F.col("words").alias(f"w{s}"))
    full = pairs.join(side("x"), ["x1", "x2"]).join(side("y"), ["y1", "y2"])
    return full.select("x1", "x2", "wx", "wy").mapInArrow(check, "x1 long, x2 long").distinct()


def earlier_matches(sets: DataFrame, percent: int) -> DataFrame:
    """(h1, h2) of the classes that match a class with an earlier first position."""
    members = sets.select("h1", "h2", "first", "n", "bits", F.explode(F.arrays_zip("postings", "places")).alias("p"))
    members = members.select("h1", "h2", "first", "n", "bits", F.col("p.postings").alias("key"), F.col("p.places").alias("place"))
    head = F.min_by(F.struct("h1", "h2", "n", "place", "bits"), F.struct("first", "h1", "h2")).alias("head")
    lists = members.groupBy("key").agg(F.count("*").alias("members"), head).filter("members > 1")
    joined = members.join(lists, "key").filter((F.col("h1") != F.col("head.h1")) | (F.col("h2") != F.col("head.h2")))
    need = _overlap_bound(percent, F.col("n"), F.col("head.n"))
    rest = F.least(F.col("n") - F.col("place"), F.col("head.n") - F.col("head.place")) + F.least("place", F.col("head.place"))
    stars = joined.filter((rest >= need) & (F.least("n", "head.n") * 100 >= F.greatest("n", "head.n") * percent))
    apart = F.aggregate(F.zip_with("bits", "head.bits", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda a, b: a + b)
    stars = stars.filter(apart * (100 + percent) <= (F.col("n") + F.col("head.n")) * (100 - percent))
    pairs = stars.select(F.col("h1").alias("x1"), F.col("h2").alias("x2"), F.col("head.h1").alias("y1"), F.col("head.h2").alias("y2")).distinct()
    settled = keep(verified(pairs, sets, percent), "line-matches")
    marked = members.join(settled.select(F.col("x1").alias("h1"), F.col("x2").alias("h2"), F.lit(True).alias("settled")), ["h1", "h2"], "left")
    # lists in which somebody other than the head is still without an earlier match
    is_open = F.col("settled").isNull()
    head_open = F.min_by(is_open.cast("int"), F.struct("first", "h1", "h2"))  # the head may be settled through another list
    lists = marked.groupBy("key").agg(F.count("*").alias("members"), (F.count_if(is_open) - head_open).alias("others"))
    lists = lists.filter("members > 2 AND others > 0").select("key", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("h1", "h2"), F.col("blocks")).cast("int")
    blocks = marked.join(lists, "key").withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    unit = ["key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")]
    width = 8 * int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grp = F.pmod(F.xxhash64("key", "lo", "hi"), F.lit(width)).alias("grp")
    names = ["key", "lo", "hi", "block", "h1", "h2", "late", "doc_id", "sub", "line", "n", "place", "bits", "settled"]
    flat = blocks.select(*unit, "block", "h1", "h2", "first.*", "n", "place", "bits", F.col("settled").isNotNull().alias("settled"))

    def who(group: pa.Table) -> pa.Table:
        taken = np.zeros(group.num_rows, bool)
        for x, y in later_and_earlier(group, percent):
            taken[x] = True
            taken[y] = True
        return group.select(names).filter(pa.array(taken))

    def match(group: pa.Table) -> pa.Table:
        raw, edges = text_bytes(group["words"])
        words, edges = raw.view(np.uint64), edges // 8
        h1, h2 = np.asarray(group["h1"]), np.asarray(group["h2"])
        found: set[tuple[int, int]] = set()
        for xs, ys in later_and_earlier(group, percent):
            for x, y in zip(xs, ys):
                if (h1[x], h2[x]) in found:
                    continue
                both = np.concatenate([words[edges[x] : edges[x + 1]], words[edges[y] : edges[y + 1]]])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                if 100 * common >= percent * (len(both) - common):
                    found.add((h1[x], h2[x]))
        return pa.table({"x1": pa.array([int(a) for a, _ in found], pa.int64()), "x2": pa.array([int(b) for _, b in found], pa.int64())})

    schema = flat.select(*names).schema
    needed = keep(flat.select("*", grp).groupBy("grp").applyInArrow(who, schema), "line-pairs")
    full = needed.join(sets.select("h1", "h2", "words"), ["h1", "h2"]).select("*", grp)
    late = full.groupBy("grp").applyInArrow(match, "x1 long, x2 long")
    return settled.unionByName(late).distinct().select(F.col("x1").alias("h1"), F.col("x2").alias("h2"))


def later_and_earlier(group: pa.Table, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one unit that pass all filters: a class without an earlier match yet, and an earlier class."""
    key, lo, hi, block, n, place, late, line, sub = (np.asarray(group[c]) for c in ("key", "lo", "hi", "block", "n", "place", "late", "line", "sub"))
    settled, doc_id = np.asarray(group["settled"]), np.asarray(group["doc_id"].fill_null(0))
    position = np.empty(len(key), np.int64)
    position[np.lexsort((line, sub, doc_id, late))] = np.arange(len(key))
    h1, h2 = np.asarray(group["h1"]), np.asarray(group["h2"])
    bits = np.asarray(pc.list_flatten(group["bits"])).reshape(-1, BITMAP // 8)
    order = np.lexsort((n, hi, lo, key))
    heads = group_starts(key[order], lo[order], hi[order])
    count = np.diff(np.append(heads, len(order)))
    left = np.repeat(heads + count, count) - np.arange(len(order)) - 1
    shift, at = 1, np.flatnonzero(left > 0)
    n = n.astype(np.int64)
    while len(at):
        i, j = order[at], order[at + shift]
        near = n[i] * 100 >= n[j] * percent  # sizes ascend
        at, i, j = at[near], i[near], j[near]
        x, y = np.where(position[i] > position[j], i, j), np.where(position[i] > position[j], j, i)
        fits = ~settled[x] & ((h1[x] != h1[y]) | (h2[x] != h2[y])) & ((lo[x] == hi[x]) | (block[x] != block[y]))
        x, y = x[fits], y[fits]
        least = -(-(n[x] + n[y]) * percent // (100 + percent))
        fits = np.minimum(n[x] - place[x], n[y] - place[y]) + np.minimum(place[x], place[y]) >= least
        x, y = x[fits], y[fits]
        fits = np.bitwise_count(bits[x] ^ bits[y]).sum(1) * (100 + percent) <= (100 - percent) * (n[x] + n[y])
        if fits.any():
            yield x[fits], y[fits]
        shift += 1
        at = at[left[at] >= shift]


def line_dedup(docs: DataFrame, percent: int = 80) -> DataFrame:
    """`docs` with the repeated lines taken out of `text`, `n_chars` (if there) counted anew, and `n_lines`, `n_removed_lines`.

    A line (between line feeds) is the set of its words between ASCII white space, A-Z lower-cased. It goes if an
    earlier line, in the order of doc_id and line number, has a word set with 100 * common >= percent * union. All is
    judged on the input, so a removed line still counts as an earlier one.

    Defined cases: lines without words stay; a null text stays null with no line; texts and lines of any length are read whole; a null id is later than all others;
    rows that repeat an id stand in an order fixed by their texts, and all but one of rows that repeat both lose their lines;
    a document may end up empty but its row stays; columns named like the added ones are replaced; an empty table gives
    an empty result.
    """
    docs = docs.drop("n_lines", "n_removed_lines")
    rarity, size = word_counts(docs)
    n_cells = cells_for(docs.sparkSession, size)
    n_buckets = bucket_count(n_cells)
    sub = F.xxhash64("text")
    cell = F.pmod(F.xxhash64(F.coalesce("doc_id", sub)), F.lit(n_cells)).cast("int")
    cells = docs.withColumns({"__cell": cell, "__sub": sub}).repartition(n_cells, "__cell")
    shared = keep(shared_lines(cells, n_buckets, percent, rarity), "line-classes")
    first = F.min(F.struct(F.col("doc_id").isNull().cast("int").alias("late"), "doc_id", "sub", "line")).alias("first")
    held = keep(shared.select("cell", "h1", "h2"), "line-cells")
    classes = keep(shared.groupBy("h1", "h2").agg(first, F.max("words").alias("words"), F.max("n").alias("n"), F.max("bits").alias("bits"), F.max("postings").alias("postings"), F.max("places").alias("places")), "line-sets")
    discard(shared)
    sets = classes.filter("words IS NOT NULL")
    matched_kept = keep(earlier_matches(sets, percent), "line-matched")
    matched = matched_kept.withColumn("matched", F.lit(True))
    verdict = held.join(classes.select("h1", "h2", "first"), ["h1", "h2"]).join(matched, ["h1", "h2"], "left")
    verdict = verdict.select("cell", "h1", "h2", F.col("first.doc_id").alias("first_doc"), F.col("first.sub").alias("first_sub"), F.col("first.line").alias("first_line"), F.coalesce("matched", F.lit(False)).alias("matched"))
    verdict = keep(verdict, "line-verdict")
    discard(held, classes, matched_kept)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    names = docs.columns

    def last_pass(group: pa.Table, verdicts: pa.Table) -> pa.Table:
        lines = Lines(group["text"])
        gone = np.zeros(len(lines.row), bool)
        if verdicts.num_rows and len(lines.line):
            v1, v2 = (np.asarray(verdicts[c]).view(np.uint64) for c in ("h1", "h2"))
            order = np.lexsort((v2, v1))
            mine = np.lexsort((lines.h2, lines.h1))
            both1, both2 = np.concatenate([v1[order], lines.h1[mine]]), np.concatenate([v2[order], lines.h2[mine]])
            together = np.lexsort((np.arange(len(both1)), both2, both1))
            starts = group_starts(both1[together], both2[together])
            group_of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(together))))
            head = together[starts][group_of]
            is_line = together >= len(order)
            has = is_line & (head < len(order))
            at, of = mine[together[has] - len(order)], order[head[has]]
            line = lines.line[at]
            ids = group["doc_id"].cast(pa.int64()).combine_chunks() if isinstance(group["doc_id"], pa.ChunkedArray) else group["doc_id"].cast(pa.int64())
            firsts = verdicts["first_doc"].combine_chunks()
            same_doc = (np.asarray(ids.fill_null(0))[lines.row[line]] == np.asarray(firsts.fill_null(0))[of]) & (np.asarray(ids.is_null())[lines.row[line]] == np.asarray(firsts.is_null())[of])
            sub, fresh = np.asarray(group["__sub"]), _ranks(group)[1]
            is_first = same_doc & fresh[lines.row[line]] & (sub[lines.row[line]] == np.asarray(verdicts["first_sub"])[of]) & (lines.number[line] == np.asarray(verdicts["first_line"])[of])
            gone[line] = ~is_first | np.asarray(verdicts["matched"])[of]
        removed = np.concatenate([[0], np.cumsum(gone)])[lines.first_line]
        n_removed, n_lines = np.diff(removed), np.diff(lines.first_line)
        missing = np.asarray(group["text"].is_null())
        block, texts = lines.data.tobytes(), group["text"].to_pylist()
        for i in np.flatnonzero(n_removed):
            those = np.arange(lines.first_line[i], lines.first_line[i + 1])
            texts[i] = b"\n".join(block[lines.start[k] : lines.end[k]] for k in those[~gone[those]]).decode()
        out = {n: group[n] for n in names} | {"text": pa.array(texts, pa.string())}
        if "n_chars" in out:
            counted = pa.array([None if t is None else len(t) for t in texts], pa.int64())
            changed = pa.array(n_removed > 0)
            out["n_chars"] = pc.if_else(changed, counted.cast(group["n_chars"].type), group["n_chars"].combine_chunks())
        out["n_lines"] = pa.array(np.where(missing, 0, n_lines).astype(np.int64))
        out["n_removed_lines"] = pa.array(n_removed.astype(np.int64))
        return pa.table(out)

    return cells.groupBy("__cell").cogroup(verdict.groupBy("cell")).applyInArrow(last_pass, f"{schema}, n_lines long, n_removed_lines long")

