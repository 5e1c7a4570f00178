"""Entity resolution: many overlapping records in, one merged row per event out."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from recordlink import fixed_values as fv
from recordlink.functions import keys, text
from recordlink.operators import attach, filters, matrix
from recordlink.operators.enrich import Supplier, precedence_merge
from recordlink.operators.similarity import similar_pairs
from recordlink.session import materialize

# Records have: rec (unique order and id), block_key, title, event_date, authority, sources (map), has_video.


def priority(authority: str = "authority", ord_col: str = "rec", more: tuple[str, ...] = ()) -> Column:
    """Sort value of a record: highest authority first, then the most of each number in `more`, then its unique order."""
    return F.struct((-F.col(authority)).alias("a"), *[(-F.col(c)).alias(c) for c in more], F.col(ord_col).alias("o"))


def best_title(title: str = "title", authority: str = "authority", ord_col: str = "rec", more: tuple[str, ...] = ()) -> Column:
    """Aggregate: title of the highest authority, then the longest, then the first in priority."""
    return F.min_by(title, F.struct((-F.col(authority)).alias("a"), (-F.length(title)).alias("l"), priority(authority, ord_col, more).alias("p")))


def is_specific(df: DataFrame) -> Column:
    """Does a record's key name a known block? With a column `registered` the registry decides, and a fallback key never does."""
    own = ~F.col("block_key").startswith(keys.FALLBACK_PREFIX + ".")
    return own & F.col("registered") if "registered" in df.columns else own


def merge_records(df: DataFrame, cluster: str, prefer: str = "last", more: tuple[str, ...] = ()) -> DataFrame:
    """One row per cluster: best title, highest authority, earliest date, merged source map, preferred key.

    Maps merge entry by entry: the entry of the last row in priority order wins (`prefer="last"`), or of
    the first (`prefer="authority"`). Of keys that name a known block (`is_specific`) the first in priority order
    stays; where none does, the last one. `more` names numbers that decide between rows of one authority.
    """
    chosen = [c for c in ("block_key", "registered") if c in df.columns]
    order, key, specific = F.col("__p"), F.struct(*chosen), is_specific(df)
    length = F.struct((-F.col("authority")).alias("a"), (-F.length("title")).alias("l"), order.alias("p"), "title")
    rows = df.select(
        cluster, priority(more=more).alias("__p"), "event_date", "authority", "has_video", "title", key.alias("__key"),
        specific.alias("__own"), F.posexplode_outer("sources").alias("__i", "k", "v"),
    )
    # per cluster and source first: one exchange of the rows for both, and copies shrink before the next one
    last = F.max if prefer == "last" else F.min
    picked = F.struct(order.alias("p"), F.col("__key").alias("k"))
    best = {
        "__first": (F.min, order), "__known": (F.min, F.when(F.col("__own"), picked)), "__any": (F.max, picked), "__title": (F.min, length),
        "event_date": (F.min, F.col("event_date")), "authority": (F.max, F.col("authority")), "has_video": (F.max, F.col("has_video")),
    }
    n = F.count(F.when(F.coalesce("__i", F.lit(0)) == 0, 1))
    parts = rows.groupBy(cluster, "k").agg(
        last(F.struct(order.alias("p"), "v")).alias("__v"), *[f(c).alias(name) for name, (f, c) in best.items()], n.alias("n_merged")
    )
    entries = F.array_sort(F.collect_list(F.when(F.col("k").isNotNull(), F.struct("k", F.col("__v.v").alias("v")))))
    one = parts.groupBy(cluster).agg(*[f(name).alias(name) for name, (f, _) in best.items()], F.sum("n_merged").alias("n_merged"), entries.alias("__e"))
    named = one.withColumn("__k", F.coalesce("__known.k", "__any.k"))
    return named.select(
        cluster, F.col("__first.o").alias("rec"), "__k.*", F.col("__title.title").alias("title"), "event_date", "authority", "has_video", "n_merged",
        F.when(F.size("__e") > 0, F.map_from_entries("__e")).alias("sources"),
    )


def dedup_exact(df: DataFrame) -> DataFrame:
    """Merge records with equal key, date and normalized title."""
    normal = df.select("title").distinct().withColumn("__t", text.normalize_title(F.col("title")))  # costs more than all else
    grouped = df.join(normal, "title", "left").withColumn("__c", F.struct("block_key", "event_date", F.col("__t").alias("t")))
    return merge_records(grouped, "__c").drop("__c")


def _titles(df: DataFrame, block: list[str]) -> DataFrame:
    """(block, tokens, p, rec, has_video): one row per title of a block, with its first record in priority order and any video.

    Copies of a title are gone before its words are taken, which costs most.
    """
    titles = df.select(*block, "title", priority().alias("p"), "rec", "has_video").groupBy(*block, "title").agg(
        F.min("p").alias("p"), F.min_by("rec", "p").alias("rec"), F.max("has_video").alias("has_video")
    )
    return titles.select(*block, text.joined(text.token_set(F.col("title"))).alias("tokens"), "p", "rec", "has_video")


def _title_nodes(df: DataFrame) -> DataFrame:
    """One node per (key, date, token set): first record in priority order, any video."""
    return (
        _titles(df, ["block_key", "event_date"])
        .groupBy("block_key", "event_date", "tokens")
        .agg(F.min("p").alias("prio"), F.min_by("rec", "p").alias("node"), F.max("has_video").alias("video"))
    )


SEGMENT, HALO = 8, 2  # days of a key that are read together, and those read along before and after them


def fuzzy_representatives(
    df: DataFrame, same_thr: float = fv.SAME_DAY_SIMILARITY, near_thr: float = fv.ADJACENT_DAY_SIMILARITY
) -> DataFrame:
    """(rec, cluster): in priority order a title joins the first earlier representative it resembles.

    Same day needs `same_thr`; one day apart needs `near_thr` and a video on a side. A record without key, date or title is left out.
    Some days of a key are read in one task together with the days around them (`_join_in_order`), so similar pairs are
    never written. What depends on days out of sight stays open for the next round, which reads the open segments only.
    """
    day = F.datediff("event_date", F.lit("1970-01-01"))
    rows = df.select(
        "rec", "block_key", day.alias("day"), text.joined(text.token_set(F.col("title"))).alias("tokens"), "authority", F.col("has_video").alias("video"),
        F.lit(None).cast(df.schema["rec"].dataType).alias("cluster"),
    ).filter(F.col("block_key").isNotNull() & F.col("day").isNotNull() & F.col("tokens").isNotNull())
    at = F.floor(F.col("day") / SEGMENT).cast("int")

    def in_sight(table: DataFrame) -> DataFrame:
        around = F.sequence(F.floor((F.col("day") - HALO) / SEGMENT).cast("int"), F.floor((F.col("day") + HALO) / SEGMENT).cast("int"))
        return table.withColumn("seg", F.explode(around))

    names = rows.columns

    def read(group: pa.Table) -> pa.Table:
        return _join_in_order(group, same_thr, near_thr, SEGMENT, HALO).select(names)

    def decided(table: DataFrame) -> DataFrame:
        return table.groupBy("block_key", "seg").applyInArrow(read, rows.schema)

    state = materialize(decided(in_sight(rows)))
    touched = materialize(state.filter("cluster IS NULL").select("block_key", at.alias("seg")).distinct())
    if touched.isEmpty():
        return state.select("rec", "cluster")
    settled = state.withColumn("seg", at).join(touched, ["block_key", "seg"], "left_anti").select("rec", "cluster")
    near = materialize(in_sight(state).join(touched, ["block_key", "seg"], "left_semi").drop("seg").distinct())
    halo = near.withColumn("seg", at).join(touched, ["block_key", "seg"], "left_anti").select(rows.columns)
    while True:
        state = materialize(decided(in_sight(near).join(touched, ["block_key", "seg"], "left_semi")))
        if state.filter("cluster IS NULL").isEmpty():
            return settled.unionByName(state.select("rec", "cluster"))
        near = halo.unionByName(state)


def _join_in_order(group: pa.Table, same_thr: float, near_thr: float, length: int, halo: int) -> pa.Table:
    """The rows of a segment with their `cluster`, as far as the rows in sight decide it.

    Rows of a segment and its halo: rec, day, tokens, authority, video, seg and the `cluster` known before. Titles are taken in order, some at
    a time, and compared with the earlier ones that are representatives or still open; absorbed ones matter to nobody.
    """
    seg = group["seg"][0].as_py()
    rec, authority, day = (group[c].to_numpy() for c in ("rec", "authority", "day"))
    code = group["tokens"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    order = np.lexsort((rec, -authority.astype(np.int64)))
    # a title of a day: its first record in order, any video
    _, first, of = np.unique(np.stack([day[order], code[order]]), axis=1, return_index=True, return_inverse=True)
    by_first = np.argsort(first)
    place = np.empty(len(by_first), np.int64)
    place[by_first] = np.arange(len(by_first))
    title = np.empty(len(rec), np.int64)  # of each row, in order of priority
    title[order] = place[of.ravel()]
    head = order[first[by_first]]
    days, ids = day[head].astype(np.int64), rec[head]
    video = np.zeros(len(head), bool)
    np.logical_or.at(video, title, group["video"].to_numpy(zero_copy_only=False).astype(bool))
    known = group["cluster"].is_valid().to_numpy(zero_copy_only=False)[head]
    cluster = group["cluster"].take(pa.array(head)).to_pylist()
    sets = matrix.read_sets(group["tokens"].take(pa.array(head)))[0]
    sets.size[(group["tokens"].take(pa.array(head)).to_numpy(zero_copy_only=False) == "")] = 0
    unseen = (days == seg * length - halo) | (days == (seg + 1) * length - 1 + halo)
    live, sure = np.zeros(0, np.int64), np.zeros(0, bool)  # titles that may take others in, and those that do

    def alike(rows: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of these titles resemble which others, and by the day of the other: 0 same, 1 before, 2 after."""
        a, b = sets.take(rows), sets.take(others)
        gap = days[others][None, :] - days[rows][:, None]
        need = np.where(gap == 0, same_thr, np.where((np.abs(gap) == 1) & (video[rows][:, None] | video[others][None, :]), near_thr, 2.0))
        union = a.size[:, None] + b.size[None, :]
        shared = matrix.shared_words(a, b)
        return (shared / np.maximum(union - shared, 1).astype(np.float64) >= need - 1e-12) & (shared > 0), np.where(gap < 0, 1, 2 * gap)

    for start in range(0, len(head), matrix.STEP):
        rows = np.arange(start, min(start + matrix.STEP, len(head)))
        match, kind = alike(rows, live)
        doubt = (match & ~sure).any(axis=1) | unseen[rows]
        kind = np.where(match & sure, kind, 3)
        best = kind.min(axis=1, initial=3)
        at = kind.argmin(axis=1) if len(live) else np.zeros(len(rows), np.int64)
        own, own_kind = alike(rows, rows)
        status = np.zeros(len(rows), np.int8)  # 1 representative, 0 open, -1 absorbed
        for i, row in enumerate(rows):
            if known[row]:
                status[i] = 1 if cluster[row] == ids[row] else -1
                continue
            earlier = np.flatnonzero(own[i, :i] & (status[:i] >= 0))
            open_ = bool(doubt[i]) or bool((status[earlier] == 0).any())
            k, to = int(best[i]), live[at[i]] if best[i] < 3 else -1
            for j in earlier[status[earlier] == 1]:
                if own_kind[i, j] < k:
                    k, to = int(own_kind[i, j]), rows[j]
            status[i] = -1 if k < 3 else 0 if open_ else 1
            if not open_:
                cluster[row] = ids[row] if k == 3 else ids[to]
        left = status >= 0
        live, sure = np.concatenate([live, rows[left]]), np.concatenate([sure, status[left] == 1])
    here = np.flatnonzero(day // length == seg)
    values = pa.array(cluster, group.schema.field("cluster").type).take(pa.array(title[here]))
    return group.take(pa.array(here)).set_column(group.schema.get_field_index("cluster"), "cluster", values)


def dedup_fuzzy(df: DataFrame, same_thr: float = fv.SAME_DAY_SIMILARITY, near_thr: float = fv.ADJACENT_DAY_SIMILARITY) -> DataFrame:
    """Merge exact duplicates, then near duplicates of the same key on the same or a neighbouring day."""
    exact = materialize(dedup_exact(df).drop("n_merged"))
    clusters = fuzzy_representatives(exact, same_thr, near_thr)
    return merge_records(exact.join(clusters, "rec"), "cluster").drop("cluster")


def adjacent_day_pairs(df: DataFrame, thr: float = fv.ADJACENT_DAY_SIMILARITY) -> DataFrame:
    """(a, b, sim): title nodes of one key, a exactly one day before b, a video on a side.

    The date band becomes an equi-join: the left side goes to the next day.
    """
    nodes = materialize(_title_nodes(df).drop("prio"))
    block = ["block_key", "event_date"]
    left = nodes.select("block_key", F.date_add("event_date", 1).alias("event_date"), "tokens", F.col("node").alias("a"), F.col("video").alias("va"))
    right = nodes.select(*block, "tokens", F.col("node").alias("b"), F.col("video").alias("vb"))
    return similar_pairs(left, right, block, thr, ["a", "va"], ["b", "vb"], residual=F.col("va") | F.col("vb")).select("a", "b", "sim")


def _cross_nodes(df: DataFrame) -> DataFrame:
    """(event_date, grp, tokens, node, key, h1, h2), kept: the nodes of the token sets of a date and group.

    A set has a hub `h1` (its first record), and the hub `h2` of its second key, which a set of one key has not.
    """
    group = keys.group_of_key(F.col("block_key"))
    nodes = (
        _titles(df, ["event_date", "block_key"]).withColumn("grp", group)
        .filter((F.col("tokens") != "") & F.col("event_date").isNotNull() & F.col("grp").isNotNull())
        .repartition("event_date", "grp", "tokens")  # one exchange for the nodes and for their sets
        .groupBy("event_date", "grp", "tokens", F.col("block_key").alias("key"))
        .agg(F.min("p").alias("p"), F.min_by("rec", "p").alias("node"))
    )
    alike = Window.partitionBy("event_date", "grp", "tokens")
    hub = F.struct("p", "node", "key")
    nodes = nodes.withColumn("__h", F.min(hub).over(alike))
    nodes = nodes.withColumn("__o", F.min(F.when(F.col("key") != F.col("__h.key"), hub)).over(alike))
    h1, h2 = (F.struct(F.col(f"{h}.node").alias("node"), F.col(f"{h}.key").alias("key")) for h in ("__h", "__o"))
    return materialize(nodes.select("event_date", "grp", "tokens", "node", "key", h1.alias("h1"), F.when(F.col("__o").isNotNull(), h2).alias("h2")))


def _star(nodes: DataFrame) -> DataFrame:
    """(a, b): a set's members of other keys hang on its hub."""
    others = nodes.filter(F.col("key") != F.col("h1.key"))
    return others.select(F.least("node", F.col("h1.node")).alias("a"), F.greatest("node", F.col("h1.node")).alias("b"))


TILE = 4096  # sets of a block in one part; a task compares two parts at once


def _tiles(nodes: DataFrame) -> DataFrame:
    """Token sets by (event_date, grp, __p, __q): those of a block are dealt into parts of about `TILE` (`__part`), two of which make a tile."""
    block = ["event_date", "grp"]
    sets = nodes.filter((F.col("node") == F.col("h1.node")) & (F.col("key") == F.col("h1.key"))).select(
        *block, "tokens", F.col("node").alias("n1"), F.col("key").alias("k1"), F.col("h2.node").alias("n2"), F.col("h2.key").alias("k2")
    )
    large = materialize(sets.groupBy(*block).agg(F.count("*").alias("__n")).filter(F.col("__n") > TILE))
    one = sets.withColumns({"__part": F.lit(0), "__p": F.lit(0), "__q": F.lit(0)})
    if large.isEmpty():
        return one
    parts = large.select(*block, F.ceil(F.col("__n") / TILE).cast("int").alias("__n"))
    dealt = sets.join(parts, block).withColumn("__part", F.pmod(F.xxhash64("n1"), F.col("__n")).cast("int"))
    dealt = dealt.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__n") - 1))).drop("__n")
    dealt = dealt.withColumns({"__p": F.least("__part", "__other"), "__q": F.greatest("__part", "__other")}).drop("__other")
    return one.join(parts, block, "left_anti").unionByName(dealt.select(one.columns))


def cross_key_pairs(df: DataFrame, thr: float = fv.CROSS_KEY_SIMILARITY, strict: bool = True) -> DataFrame:
    """(a, b, sim): edges that connect similar titles of one date and group under different keys.

    Titles with one token set form a set with a hub (its first record) and the hub of its second key.
    Members of a set hang on a hub of another key; similar sets are linked hub to hub. The edges have the
    same connected components as all pairs with different keys, without writing the pairs out. Two parts of a block are compared in one task
    as a matrix, of which the linked sets come out some rows at a time.
    """
    nodes = _cross_nodes(df)
    kind = nodes.schema["node"].dataType.simpleString()

    def read(tile: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = pa.Table.from_batches(list(tile))
        n1, n2 = sets["n1"].combine_chunks(), sets["n2"].combine_chunks()
        key = pa.chunked_array([*sets["k1"].chunks, *sets["k2"].chunks]).combine_chunks().dictionary_encode().indices
        k1 = key[: len(sets)].to_numpy(zero_copy_only=False)
        more, part, number = n2.is_valid().to_numpy(zero_copy_only=False), sets["__part"].to_numpy(), n1.to_numpy(zero_copy_only=False)
        two = part.min() != part.max()
        all_sets = matrix.read_sets(sets["tokens"])[0]
        for rows, shared in matrix.compared(all_sets, all_sets):
            sim = matrix.jaccard(shared, all_sets.size[rows], all_sets.size)
            link = (sim > thr + 1e-12 if strict else sim >= thr - 1e-12) & (number[rows][:, None] < number)
            link &= (k1[rows][:, None] != k1) | more[rows][:, None] | more
            if two:
                link &= part[rows][:, None] != part
            x, y = np.nonzero(link)
            sim, x = sim[x, y], rows[x]
            apart, first = k1[x] != k1[y], more[x]
            a = pc.if_else(pa.array(~apart & first), n2.take(pa.array(x)), n1.take(pa.array(x)))
            b = pc.if_else(pa.array(~apart & ~first), n2.take(pa.array(y)), n1.take(pa.array(y)))
            swap = pc.less(a, b)
            yield pa.RecordBatch.from_arrays([pc.if_else(swap, a, b), pc.if_else(swap, b, a), pa.array(sim)], ["a", "b", "sim"])

    linked = _tiles(nodes).groupBy("event_date", "grp", "__p", "__q").applyInArrow(read, f"a {kind}, b {kind}, sim double")
    return _star(nodes).withColumn("sim", F.lit(1.0)).unionByName(linked)


def cross_key_links(df: DataFrame, thr: float = fv.CROSS_KEY_SIMILARITY, strict: bool = True) -> DataFrame:
    """(a, b): edges with the connected components of `cross_key_pairs`, without its pairs.

    A tile gives at most one edge for each of its sets (`_linked_sets`). A set with a second key is connected to its `h2` by
    its star, so a link to any of its keys is a link to its hub.
    """
    nodes = _cross_nodes(df)
    kind = nodes.schema["node"].dataType.simpleString()

    def read(tile: pa.Table) -> pa.Table:
        node = tile["n1"].combine_chunks()
        a, b = _linked_sets(matrix.read_sets(tile["tokens"])[0], tile["k1"].combine_chunks(), tile["n2"].is_valid().to_numpy(), tile["__part"].to_numpy(), thr, strict)
        x, y = node.take(pa.array(a)), node.take(pa.array(b))
        swap = pc.less(x, y)
        return pa.table({"a": pc.if_else(swap, x, y), "b": pc.if_else(swap, y, x)})

    linked = _tiles(nodes).groupBy("event_date", "grp", "__p", "__q").applyInArrow(read, f"a {kind}, b {kind}")
    return _star(nodes).unionByName(linked)


def _linked_sets(sets: matrix.Sets, key: pa.Array, more: np.ndarray, part: np.ndarray, thr: float, strict: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places (a, b) of sets: each one that similar sets under different keys connect with others, and the first one of these.

    Rows of two parts are compared with the other part only.
    """
    n = len(sets.size)
    code = key.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    two = part.min() != part.max()
    link = np.zeros((n, n), bool)
    for rows, shared in matrix.compared(sets, sets):
        sim = matrix.jaccard(shared, sets.size[rows], sets.size)
        link[rows] = (sim > thr + 1e-12 if strict else sim >= thr - 1e-12) & ((code[rows][:, None] != code) | more[rows][:, None] | more)
        if two:
            link[rows] &= part[rows][:, None] != part
    left = np.ones(n, bool)
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for start in range(n):
        front = np.array([start]) if left[start] else np.zeros(0, np.int64)
        left[start] = False
        while len(front):
            front = np.flatnonzero(link[front].any(axis=0) & left)
            left[front] = False
            a.append(front)
            b.append(np.full(len(front), start))
    return np.concatenate(a), np.concatenate(b)


HUB = 100_000  # edges of a node above which its star is not joined as one key


def with_least(edges: DataFrame, n_edges: int, own: bool) -> DataFrame:
    """Edges (u, v) with `m`, the least v of their u (`own`: or u itself).

    The stars of hubs are taken out first: there are at most n_edges / HUB hubs, a table that Spark broadcasts by its
    size, so the edges of a hub stay where they are. Only a table of more than `HUB` edges can have one.
    """
    least = F.min("v") if not own else F.least(F.min("v"), F.col("u"))
    low = edges.groupBy("u").agg(least.alias("m"), F.count("*").alias("__c"))
    if n_edges <= HUB:
        return edges.join(low.drop("__c"), "u")
    hubs = materialize(low.filter(F.col("__c") > HUB).drop("__c"))
    if hubs.isEmpty():
        return edges.join(low.drop("__c"), "u")
    rest = edges.join(hubs.select("u"), "u", "left_anti").join(low.filter(F.col("__c") <= HUB).drop("__c"), "u")
    return rest.unionByName(edges.join(hubs, "u"))


FOREST = 1 << 20  # edges that a task reduces at once


def _stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node to the smallest one that these edges connect it with."""
    ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(ids))
    while len(a):
        np.minimum.at(root, np.maximum(root[a], root[b]), np.minimum(root[a], root[b]))
        while not np.array_equal(root, above := root[root]):
            root = above
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    leaf = root != np.arange(len(ids))
    return ids[leaf], ids[root[leaf]]


def spanning_stars(edges: DataFrame) -> DataFrame:
    """Edges (u, v) of long ids, u > v, with the same components: at most one for each node that a task has seen.

    Similar titles of a block are linked all to all; so many edges are reduced where they are found, before any shuffle.
    A task holds `FOREST` edges at a time.
    """

    def reduce_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0
        for batch in batches:
            held.append((batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)))
            n += batch.num_rows
            if n >= FOREST:
                u, v = _stars(*(np.concatenate(x) for x in zip(*held)))
                held, n = [(u, v)], len(u)
                if n > FOREST // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])
                    held, n = [], 0
        if n:
            u, v = _stars(*(np.concatenate(x) for x in zip(*held)))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return edges.select("u", "v").mapInArrow(reduce_edges, "u bigint, v bigint")


def connected_clusters(nodes: DataFrame, edges: DataFrame, node: str, a: str = "a", b: str = "b") -> DataFrame:
    """(node, cluster): smallest id reachable over the edges.

    Edges of long ids are first reduced inside each task (`spanning_stars`), so what is shuffled follows the nodes and not the
    pairs; each node then waits at its least root, and only the roots are connected. Alternating large-star and small-star steps; each is a min-aggregate and a join, and the number of
    rounds grows with the logarithm of the component size. A component ends as one star; `with_least` splits large ones.
    """

    def fingerprint(df: DataFrame):
        return df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()

    start = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v")
    leaves = None
    if start.schema["u"].dataType == LongType():
        stars = materialize(spanning_stars(start).distinct())
        leaves = materialize(stars.groupBy("u").agg(F.min("v").alias("m")))
        between = stars.join(leaves, "u").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        own = leaves.join(stars.select(F.col("v").alias("u")).distinct(), "u", "left_semi").select("u", F.col("m").alias("v"))
        start = between.unionByName(own).filter("u <> v")
    current = materialize(start.distinct())
    seen = fingerprint(current)
    while seen[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = with_least(both, 2 * seen[0], own=True).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        both_ends = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))))
        small = with_least(large, seen[0], own=False).select(both_ends.alias("e")).select("e.*")
        current = materialize(small.filter("u <> v").distinct())
        before, seen = seen, fingerprint(current)
        if before == seen:
            break
    labels = current.groupBy(F.col("u").alias(node)).agg(F.min("v").alias("__m"))
    if leaves is not None:
        hung = leaves.join(labels.select(F.col(node).alias("m"), "__m"), "m", "left").select(F.col("u").alias(node), F.coalesce("__m", "m").alias("__m"))
        labels = hung.unionByName(labels.join(leaves.select(F.col("u").alias(node)), node, "left_anti"))
    return nodes.select(node).distinct().join(labels, node, "left").select(node, F.coalesce("__m", node).alias("cluster"))


def merge_pairs(df: DataFrame, pairs: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """Merge records connected by pairs of record ids."""
    clusters = connected_clusters(df, pairs, "rec")
    return merge_records(df.drop("n_merged").join(clusters, "rec"), "cluster", more=more).drop("cluster")


def merge_adjacent(df: DataFrame) -> DataFrame:
    """Merge similar records of one key on neighbouring days: of equal authorities the one with more sources leads."""
    counted = df.withColumn("n_sources", F.coalesce(F.size("sources"), F.lit(0)))
    return merge_pairs(counted, adjacent_day_pairs(df), more=("n_sources",))


def resolve_records(sources: DataFrame, dim: DataFrame, dim_key: str, as_of: str, days: int | None = None) -> DataFrame:
    """Filter and merge all source records to one row per event. The keys of `dim` are the registered ones."""
    kept = filters.procedural_filter(sources, "title", F.col("has_video"))
    if days is not None:
        kept = filters.lookback_window(kept, "event_date", as_of, days)
    known = dim.select(F.col(dim_key).alias("block_key"), F.lit(True).alias("registered")).distinct()
    kept = kept.join(known, "block_key", "left").withColumn("registered", F.coalesce("registered", F.lit(False)))
    merged = materialize(dedup_fuzzy(kept))
    merged = materialize(merge_pairs(merged, cross_key_links(merged)))
    return materialize(merge_adjacent(merged))


def resolve_all(
    sources: DataFrame, dim: DataFrame, dim_key: str, dim_name: str, dim_code: str, as_of: str, days: int | None = None,
    clips: DataFrame | None = None, streams: DataFrame | None = None, found: DataFrame | None = None,
    broadcasts: DataFrame | None = None, details: DataFrame | None = None, dim_scrape: str | None = None,
) -> DataFrame:
    """Filter, merge and enrich all source records to one row per event.

    `dim` registers the blocks: name, code used for stream names, and with `dim_scrape` whether their pages are read.
    Suppliers, in order; each only fills a gap unless stated:
    - `clips` (clip, block_key, event_date, title, url, duration): the first matched clip gives the video;
    - `streams` (stream, event_date, title, url, duration): a full stream overwrites the video of its one record;
    - `found` (record_id, url): looked-up broadcast pages of records not after `as_of`;
    - `broadcasts` (video, block_key, event_date, title, url): matched in two tiers, the first gives the broadcast page;
    - `details` (url, pdf_urls, embed_id, stream_comm, stream_file): what the record's own page holds, read for the
      blocks to scrape and all of the senate: its stream parameters override derived ones, a video only fills a gap.
    """
    out = enriched(resolve_records(sources, dim, dim_key, as_of, days), dim, dim_key, dim_name, dim_code, as_of, clips, streams, found, broadcasts, details, dim_scrape)
    return out.withColumn("slug", text.slug(F.col("block_key"), F.col("title")))


def enriched(
    merged: DataFrame, dim: DataFrame, dim_key: str, dim_name: str, dim_code: str, as_of: str, clips: DataFrame | None, streams: DataFrame | None,
    found: DataFrame | None, broadcasts: DataFrame | None, details: DataFrame | None, dim_scrape: str | None,
) -> DataFrame:
    """Merged records with names, videos, broadcast pages and page details: two aggregates, before and after the streams."""
    scrape = F.lit(False) if dim_scrape is None else F.coalesce(dim_scrape, F.lit(False))
    names = dim.select(F.col(dim_key).alias("block_key"), F.col(dim_name).alias("block_name"), F.col(dim_code).alias("__code"), scrape.alias("__scrape"))
    out = merged.drop("registered").join(names, "block_key", "left").withColumn("block_name", F.coalesce("block_name", "block_key"))
    out = out.withColumn("__group", keys.group_of_key(F.col("block_key"))).withColumn("__old", F.try_element_at("sources", F.lit("stream_comm")))
    old_file = F.try_element_at("sources", F.lit("stream_file"))
    out = keys.stream_name(out, "__code", "__group", "event_date", "__old").withColumn("stream_file", F.coalesce("stream_file", old_file)).drop("__code", "__old")
    out = out.withColumns({
        "record_id": text.record_id(F.col("block_key"), F.col("event_date"), F.col("title")),
        "video_url": F.nullif(F.try_element_at("sources", F.lit("video_id")), F.lit("")),
        "video_duration": F.try_element_at("sources", F.lit("video_duration")).try_cast("int"),
        "broadcast_url": F.nullif(F.try_element_at("sources", F.lit("broadcast_url")), F.lit("")),
    })
    if clips is not None:
        hit = attach.best_similar(out, clips, ["block_key", "event_date"], "title", "rec", "title", "clip", fv.CLIP_SIMILARITY)
        length = F.col("duration") if "duration" in clips.columns else F.lit(None).cast("int")
        video = clips.select(F.col("clip").alias("video"), F.col("url").alias("video_url"), length.alias("clip_s"))
        given = hit.join(video, "video").select(F.col("record").alias("rec"), "video", "video_url", "clip_s")
        own = F.col("video_url")
        out = precedence_merge(out.withColumn("__own", own), "rec", [Supplier(given, order="video", count_as="n_clips")])
        out = out.withColumn("video_duration", F.when(F.col("__own").isNull(), F.col("clip_s")).otherwise(F.col("video_duration"))).drop("__own", "clip_s")
    out = materialize(out)
    suppliers: list[Supplier] = []
    if streams is not None:
        held = attach.assign_streams(out, streams, "event_date", "title", "rec", "video_url", "video_duration", "title", "stream", "duration")
        video = streams.select(F.col("stream").alias("video"), F.col("url").alias("video_url"), F.col("duration").alias("video_duration"))
        given = held.join(video, "video").select(F.col("record").alias("rec"), "video_url", "video_duration")
        suppliers.append(Supplier(given, frozenset({"video_url", "video_duration"})))
    if found is not None:
        past = out.filter(F.col("broadcast_url").isNull() & (F.col("event_date") <= F.lit(as_of).cast("date")))
        last = found.filter(F.col("url") != "").groupBy("record_id").agg(F.max("url").alias("broadcast_url"))
        suppliers.append(Supplier(past.select("rec", "record_id").join(last, "record_id").select("rec", "broadcast_url")))
    if broadcasts is not None:
        videos = attach.usable_videos(broadcasts, "url", "event_date")
        hit = attach.two_tier_matches(out, videos, "block_key", "event_date", "title", "rec", "title", "video")
        given = hit.join(videos.select("video", F.col("url").alias("broadcast_url")), "video").select(F.col("record").alias("rec"), "video", "broadcast_url")
        suppliers.append(Supplier(given, order="video"))
    if details is not None:
        own_page = out.filter(F.coalesce("__scrape", F.lit(False)) | (F.col("__group") == "senate"))
        own_page = own_page.select("rec", F.try_element_at("sources", F.lit("web_url")).alias("url")).filter("url <> ''")
        page = details.select(
            "url", F.when(F.size("pdf_urls") > 0, F.col("pdf_urls")).alias("pdf_urls"), F.concat(F.lit(fv.VIDEO_PAGE), "embed_id").alias("video_url"),
            "stream_comm", F.when(F.col("stream_comm").isNotNull(), F.col("stream_file")).alias("stream_file"),
        )
        suppliers.append(Supplier(own_page.join(page, "url").drop("url"), frozenset({"stream_comm", "stream_file", "pdf_urls"})))
    if suppliers:
        out = precedence_merge(out, "rec", suppliers)
    return out.drop("__group", "__scrape")
