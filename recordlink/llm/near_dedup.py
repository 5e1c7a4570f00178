"""MinHash near-dedup by an inverted join over signature coordinates.

Equal shingle sets collapse to one class first. A class is posted under each (coordinate, value) pair of its signature.
Two classes are candidates if at least `matches` of the `coordinates` agree; by the prefix principle they then share
one of their `coordinates - matches + 1` rarest pairs, so only those are posted (hot pairs are skipped by everyone who
has enough rarer ones), and collisions are counted on the whole signatures. Links are confirmed on the full sets.

No posting list is paired out. Round one links every member to the first of its list. Components of the confirmed links
are then known, and in round two a list is looked at again only if it spans several components: members of different
components are counted against each other in blocks of bounded size, and only pairs above the match threshold are
confirmed. Links inside a component cannot change it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlink.llm.cells import PACKED, answered, ask, bucket_count, cell_count, dealt, pack
from recordlink.llm.scratch import keep
from recordlink.llm.textblock import group_starts, mix, row_slices, text_bytes, white_words
from recordlink.operators.resolve import connected_clusters

COUNTS = 1
BLOCK, BLOCK_BYTES = 2048, 8 << 20
MULT = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and fingerprint of every distinct shingle, sorted by row and fingerprint."""
    starts, _, words = white_words(data, offsets)
    rows = np.searchsorted(offsets, starts, "right") - 1
    counts = np.bincount(rows, minlength=len(offsets) - 1)
    gram, length = words, np.minimum(counts, size)
    edges = np.concatenate([[0], np.cumsum(counts)])
    gram = mix(words + np.uint64(1))
    for k in range(1, size):
        grown = mix(gram[: max(0, len(words) - k)] * MULT + words[k:])
        gram = np.concatenate([grown, gram[max(0, len(words) - k) :]])
        # rows with fewer words keep the whole sequence
        short = np.flatnonzero((length <= k) & (counts > 0))
        if len(short):
            whole = np.zeros(len(short), np.uint64)
            for j, r in enumerate(short):
                value = mix(words[edges[r] : edges[r] + 1] + np.uint64(1))
                for w in words[edges[r] + 1 : edges[r + 1]]:
                    value = mix(value * MULT + w)
                whole[j] = value[0]
            gram[edges[short]] = whole
    begins = np.arange(len(words)) - edges[rows] <= (counts - length)[rows]
    row, value = rows[begins], gram[begins]
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    first = group_starts(row, value)
    return row[first], value[first]


def signatures(value: np.ndarray, edges: np.ndarray, coordinates: int) -> np.ndarray:
    """Least permuted fingerprint of each set for each coordinate, as 32 bits. Sets must not be empty."""
    out = np.empty((len(edges) - 1, coordinates), np.uint32)
    seeds = mix(np.arange(1, 2 * coordinates + 1, dtype=np.uint64))
    step = 1 << 16
    for low in range(0, len(edges) - 1, 256):
        high = min(low + 256, len(edges) - 1)
        part, cut = value[edges[low] : edges[high]], edges[low:high] - edges[low]
        if len(part) > 64 * step and high - low > 1:
            for r in range(low, high):
                out[r] = signatures(value[edges[r] : edges[r + 1]], np.array([0, edges[r + 1] - edges[r]]), coordinates)
            continue
        for c in range(coordinates):
            x = (part ^ seeds[2 * c]) * (seeds[2 * c + 1] | np.uint64(1))
            out[low:high, c] = np.minimum.reduceat(x ^ (x >> np.uint64(32)), cut) >> np.uint64(32)
    return out


def _posted(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key per (coordinate, value)."""
    return mix(sig.astype(np.uint64) | (np.arange(sig.shape[1], dtype=np.uint64) << np.uint64(32)))


def _digests(value: np.ndarray, edges: np.ndarray) -> list[str]:
    return [hashlib.blake2b(value[s:e], digest_size=16).hexdigest() for s, e in zip(edges[:-1], edges[1:])]


def merge_counts(low: np.ndarray, times: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """How many entries hold each key, over all cells."""
    order = np.argsort(low, kind="stable")
    first = group_starts(low[order])
    out = np.zeros(len(low), np.uint32)
    if len(low):
        total = np.add.reduceat(times[order].astype(np.int64), first)
        out[order] = np.repeat(np.minimum(total, 2**32 - 1), np.diff(np.append(first, len(low))))
    return out


def _bucket(key: np.ndarray, n_buckets: int) -> np.ndarray:
    return ((key >> np.uint64(32)) % np.uint64(n_buckets)).astype(np.int64)


def _classes(group: pa.Table, size: int, coordinates: int):
    """Digest of each row of a cell ('' if the set is empty), and the distinct classes: first row, edges, sets, signatures."""
    data, offsets = text_bytes(group["text"])
    row_of, values = [], []
    for a, b in row_slices(offsets):
        row, value = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], size)
        row_of.append(row + a)
        values.append(value)
    row = np.concatenate(row_of) if row_of else np.zeros(0, np.int64)
    value = np.concatenate(values) if values else np.zeros(0, np.uint64)
    edges = np.searchsorted(row, np.arange(group.num_rows + 1))
    digests = _digests(value, edges)
    sizes = np.diff(edges)
    firsts: dict[str, int] = {}
    for i, d in enumerate(digests):
        if sizes[i]:
            firsts.setdefault(d, i)
    # a fixed order, so that every pass packs the same entries
    reps = np.array([firsts[d] for d in sorted(firsts)], np.int64)
    cut = np.concatenate([[0], np.cumsum(sizes[reps])]) if len(reps) else np.zeros(1, np.int64)
    sets = np.concatenate([value[edges[r] : edges[r + 1]] for r in reps]) if len(reps) else value[:0]
    return [d if s else "" for d, s in zip(digests, sizes)], sizes, reps, cut, sets, signatures(sets, cut, coordinates)


def near_classes(docs: DataFrame, size: int, coordinates: int, matches: int) -> DataFrame:
    """One row per document (part 'row': doc_id, digest, n), and per class of a cell that may match another (part 'set': signature, postings, set)."""
    n_cells = cell_count(docs)
    n_buckets = bucket_count(n_cells)
    narrow = docs.select("doc_id", F.col("text").cast("binary").alias("text"), F.xxhash64("text").alias("text_key"))
    cells = dealt(narrow, F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(n_cells)), n_cells)

    def first_pass(group: pa.Table) -> pa.Table:
        *_, sig = _classes(group, size, coordinates)
        keys = _posted(sig).ravel()
        return pack(group["cell"][0].as_py(), _bucket(keys, n_buckets), n_buckets, keys.astype(np.uint32), np.ones(len(keys), np.uint8))[1]

    def second_pass(group: pa.Table, answers: pa.Table) -> pa.Table:
        if not group.num_rows:
            return pa.table({f.name: pa.array([], f.type) for f in out_schema})
        digests, sizes, reps, cut, sets, sig = _classes(group, size, coordinates)
        keys = _posted(sig)
        counts = np.empty(keys.size, np.uint32)
        order = np.argsort(_bucket(keys.ravel(), n_buckets).astype(np.uint16 if n_buckets <= 1 << 16 else np.uint32), kind="stable")
        counts[order] = answered(answers, COUNTS, "u4", keys.size)
        counts = counts.reshape(keys.shape)
        rare = np.lexsort((keys, counts))[:, : coordinates - matches + 1] if len(reps) else np.zeros((0, 0), np.int64)
        postings, kept = [], []
        for i in range(len(reps)):
            those = rare[i][counts[i, rare[i]] > 1]
            if len(those):
                kept.append(i)
                postings.append(((those << 32) | sig[i, those].astype(np.int64)).tolist())
        n_rows, n_sets = group.num_rows, len(kept)
        rows = pa.table(
            {
                "doc_id": group["doc_id"].cast(pa.int64()),
                "digest": pa.array(digests, pa.string()),
                "n": pa.array(sizes.astype(np.int64)),
                "text_key": group["text_key"],
                "sig": pa.nulls(n_rows, pa.binary()),
                "posted": pa.nulls(n_rows, pa.list_(pa.int64())),
                "shingles": pa.nulls(n_rows, pa.binary()),
            }
        )
        active = pa.table(
            {
                "doc_id": pa.nulls(n_sets, pa.int64()),
                "digest": pa.array([digests[reps[i]] for i in kept], pa.string()),
                "n": pa.array([int(sizes[reps[i]]) for i in kept], pa.int64()),
                "text_key": pa.nulls(n_sets, pa.int64()),
                "sig": pa.array([sig[i].tobytes() for i in kept], pa.binary()),
                "posted": pa.array(postings, pa.list_(pa.int64())),
                "shingles": pa.array([sets[cut[i] : cut[i + 1]].tobytes() for i in kept], pa.binary()),
            }
        )
        return pa.concat_tables([rows, active])

    out_schema = pa.schema(
        [("doc_id", pa.int64()), ("digest", pa.string()), ("n", pa.int64()), ("text_key", pa.int64()), ("sig", pa.binary()), ("posted", pa.list_(pa.int64())), ("shingles", pa.binary())]
    )
    asked = cells.groupBy("cell").applyInArrow(first_pass, PACKED)
    answers = ask(asked, merge_counts, "u4", "u1", COUNTS)
    return cells.groupBy("cell").cogroup(answers.groupBy("cell")).applyInArrow(
        second_pass, "doc_id long, digest string, n long, text_key long, sig binary, posted array<bigint>, shingles binary"
    )


def _agreeing(a: pa.Array, b: pa.Array) -> np.ndarray:
    x, _ = text_bytes(a)
    y, _ = text_bytes(b)
    return (x.view(np.uint32).reshape(len(a), -1) == y.view(np.uint32).reshape(len(b), -1)).sum(1)


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets have 100 * intersection >= percent * union."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch["sa"], batch["sb"]):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                good.append(100 * common >= percent * (len(both) - common))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    # sizes far apart cannot reach the threshold
    left = sets.select(F.col("digest").alias("a"), F.col("shingles").alias("sa"), F.col("n").alias("na"))
    right = sets.select(F.col("digest").alias("b"), F.col("shingles").alias("sb"), F.col("n").alias("nb"))
    near = (F.col("na") * 100 >= F.col("nb") * percent) & (F.col("nb") * 100 >= F.col("na") * percent)
    return pairs.join(left, "a").join(right, "b").filter(near).select("a", "b", "sa", "sb").mapInArrow(check, "a string, b string")


def _units(group: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """The rows of each pair of blocks in a group: coordinate of its list, rows in order."""
    key, lo, hi = (np.asarray(group[c]) for c in ("key", "lo", "hi"))
    order = np.lexsort((hi, lo, key))
    heads = np.append(group_starts(key[order], lo[order], hi[order]), len(order))
    coord = np.asarray(group["coord"])
    for s, e in zip(heads[:-1], heads[1:]):
        yield int(coord[order[s]]), order[s:e]


class Members:
    """Signatures, posted coordinates, blocks and clusters of the rows of a group."""

    def __init__(self, group: pa.Table, coordinates: int, matches: int):
        self.matches = matches
        self.sig = text_bytes(group["sig"])[0].view(np.uint32).reshape(-1, coordinates)
        mask = group["mask"].combine_chunks() if isinstance(group["mask"], pa.ChunkedArray) else group["mask"]
        bits = np.asarray(mask).astype(np.int64)
        self.posted = (bits[:, None] >> np.arange(coordinates)) & 1 == 1
        self.block = np.asarray(group["block"])
        self.cluster = np.unique(np.array(group["cluster"].to_pylist(), object), return_inverse=True)[1]

    def partners(self, coord: int, rows: np.ndarray, k: int, cluster: np.ndarray) -> np.ndarray:
        """Later rows of the unit that belong to row number k here: another cluster, enough equal coordinates, and this
        list is the first that both are posted in."""
        i, later = rows[k], rows[k + 1 :]
        lo, hi = self.block[rows].min(), self.block[rows].max()
        later = later[cluster[later] != cluster[i]]
        if lo != hi:
            later = later[self.block[later] != self.block[i]]
        equal = self.sig[later] == self.sig[i]
        enough = equal.sum(1) >= self.matches
        later, equal = later[enough], equal[enough]
        first = (equal & self.posted[later] & self.posted[i]).argmax(1) if len(later) else np.zeros(0, np.int64)
        return later[first == coord]


def across(posted: DataFrame, sets: DataFrame, coordinates: int, matches: int, percent: int) -> DataFrame:
    """Links (a, b) between different clusters: enough to connect all that are linked.

    A list is cut into blocks of bounded number and bytes; each pair of blocks is a unit, and units are dealt to groups.
    First the signatures tell which members have a partner to check in a unit; then only their sets go there, and are
    compared in place. A pair is checked in one list only, and not at all once its members are connected there.
    """
    spark = posted.sparkSession
    weight = F.col("n") * 8
    lists = posted.groupBy("key").agg(F.count("*").alias("members"), F.sum(weight).alias("bytes"), F.min("cluster").alias("c0"), F.max("cluster").alias("c1"))
    size = F.greatest(F.ceil(F.col("members") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int")
    lists = lists.filter("c0 <> c1").select("key", size.alias("blocks"))
    block = F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int")
    members = posted.join(lists, "key").withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    unit = ["key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")]
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt_rows = members.select(*unit, F.shiftright("key", 32).cast("int").alias("coord"), "block", "digest", "cluster", "sig", "mask").withColumn("grp", F.pmod(F.xxhash64("key", "lo", "hi"), F.lit(8 * width)))

    def who(group: pa.Table) -> pa.Table:
        m, taken = Members(group, coordinates, matches), np.zeros(group.num_rows, bool)
        for coord, rows in _units(group):
            for k in range(len(rows) - 1):
                those = m.partners(coord, rows, k, m.cluster)
                if len(those):
                    taken[rows[k]] = True
                    taken[those] = True
        return group.select(["key", "lo", "hi", "coord", "block", "digest", "cluster"]).filter(pa.array(taken))

    needed = dealt_rows.groupBy("grp").applyInArrow(who, "key long, lo int, hi int, coord int, block int, digest string, cluster string")
    needed = keep(needed, "near-members")
    full = needed.join(sets.select("digest", "sig", "mask", "shingles"), "digest").withColumn("grp", F.pmod(F.xxhash64("key", "lo", "hi"), F.lit(8 * width)))

    def link(group: pa.Table) -> pa.Table:
        m = Members(group, coordinates, matches)
        raw, edges = text_bytes(group["shingles"])
        values, edges = raw.view(np.uint64), edges // 8
        sizes, digest = np.diff(edges), group["digest"].to_pylist()
        found_a, found_b = [], []
        for coord, rows in _units(group):
            cluster = m.cluster.copy()
            at = np.concatenate([np.arange(edges[r], edges[r + 1]) for r in rows])
            codes = np.unique(values[at], return_inverse=True)[1]
            cut = np.concatenate([[0], np.cumsum(sizes[rows])])
            where = {int(r): k for k, r in enumerate(rows)}
            mark = np.zeros(codes.max(initial=0) + 1, bool)
            for k in range(len(rows) - 1):
                those = m.partners(coord, rows, k, cluster)
                if not len(those):
                    continue
                mark[codes[cut[k] : cut[k + 1]]] = True
                for r in those:
                    if cluster[r] == cluster[rows[k]]:
                        continue
                    small, large = sorted((int(sizes[r]), int(sizes[rows[k]])))
                    if small * 100 < large * percent:
                        continue
                    j = where[int(r)]
                    common = int(mark[codes[cut[j] : cut[j + 1]]].sum())
                    if 100 * common >= percent * (small + large - common):
                        cluster[cluster == cluster[r]] = cluster[rows[k]]
                        found_a.append(digest[rows[k]])
                        found_b.append(digest[r])
                mark[codes[cut[k] : cut[k + 1]]] = False
        return pa.table({"a": pa.array(found_a, pa.string()), "b": pa.array(found_b, pa.string())})

    return full.groupBy("grp").applyInArrow(link, "a string, b string")


def near_dedup(docs: DataFrame, size: int = 5, percent: int = 80, coordinates: int = 32, matches: int = 15) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_key), one row per row of `docs`; `text_key` is xxhash64 of the text.

    Documents are linked if 100 * |A and B| >= percent * |A or B| for their sets of `size`-word shingles (words between
    ASCII white space, A-Z lower-cased; fewer words: the whole sequence). A linked pair at 80 per cent misses the
    match threshold of 15 of 32 with probability 3e-5, at 85 per cent less than 1e-6.

    Defined cases: a null text, or one without words, has no shingle and is linked with nothing; a null id is larger
    than all others within its component and kept only if alone; rows that repeat an id are documents of their own and
    share its component if they share text; texts of any length are read whole; other columns are ignored; an empty table gives an empty result.
    """
    parts = keep(near_classes(docs, size, coordinates, matches), "near-classes")
    rows = parts.filter("sig IS NULL").select("doc_id", "text_key", "digest", "n")
    # one set per class: cells may have met the same one
    sets = keep(parts.filter("sig IS NOT NULL").drop("doc_id", "text_key").dropDuplicates(["digest"]), "near-sets")
    mask = F.aggregate("posted", F.lit(0).cast("long"), lambda a, key: a + F.pow(F.lit(2.0), F.shiftright(key, 32)).cast("long"))
    sets = sets.withColumn("mask", mask)
    # a key is coordinate * 2**32 + value
    posted = sets.select("digest", "n", "sig", "mask", F.explode("posted").alias("key"))
    heads = posted.groupBy("key").agg(F.min("digest").alias("head"), F.count("*").alias("members")).filter("members > 1").select("key", "head")
    stars = posted.join(heads, "key").filter("digest <> head").select(F.col("head").alias("a"), F.col("digest").alias("b")).distinct()
    sig_a, sig_b = sets.select(F.col("digest").alias("a"), F.col("sig").alias("ga")), sets.select(F.col("digest").alias("b"), F.col("sig").alias("gb"))

    def enough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = _agreeing(batch["ga"], batch["gb"]) >= matches
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(good))

    counted = stars.join(sig_a, "a").join(sig_b, "b").select("a", "b", "ga", "gb").mapInArrow(enough, "a string, b string")
    links = keep(confirm(counted, sets, percent), "near-links")
    clusters = connected_clusters(sets, links, "digest")
    second = keep(across(posted.join(clusters, "digest"), sets, coordinates, matches, percent), "near-links")
    clusters = keep(connected_clusters(sets, links.unionByName(second), "digest"), "near-clusters")
    labelled = rows.join(clusters, "digest", "left").withColumn("cluster", F.coalesce("cluster", "digest"))
    lowest = labelled.filter("n > 0").groupBy("cluster").agg(F.min("doc_id").alias("component"), F.count("*").alias("component_size"))
    found = labelled.join(lowest, "cluster", "left").withColumn("component_id", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")))
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        "text_key",
    )


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """`docs` with one document of each near-duplicate group: the smallest id, and one of rows that repeat it and its text."""
    found = near_dedup(docs, size, percent)
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__id")
    kept = found.filter("kept").select(key, F.col("text_key").alias("__text_key")).distinct()
    keyed = docs.select("*", key, F.xxhash64("text").alias("__text_key"))
    return keyed.join(kept, ["__id", "__text_key"]).dropDuplicates(["__id", "__text_key"]).select(*docs.columns)
