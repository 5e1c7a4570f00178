import itertools
import random

import pytest
from pyspark.sql import functions as F

from recordlink.operators import attach, lookup, resolve
from recordlink.operators.similarity import similar_pairs
from recordlink.session import materialize

SCHEMA = "rec bigint, block_key string, title string, event_date string, authority int, sources map<string,string>, has_video boolean"


def frame(spark, rows):
    full = [(i, k, t, d, a, s, "video_id" in s) for i, (k, t, d, a, s) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).withColumn("event_date", F.col("event_date").cast("date"))


def test_same_record_of_two_sources_merges(spark):
    out = resolve.dedup_fuzzy(frame(spark, [
        ("house.j", "River Gauge Session", "2026-03-17", 1, {"video_id": "abc"}),
        ("house.j", "River Gauge Session", "2026-03-17", 2, {"web_url": "w"}),
    ])).collect()
    assert len(out) == 1 and out[0]["sources"] == {"video_id": "abc", "web_url": "w"}


def test_other_day_without_video_and_other_topic_stay(spark):
    rows = [
        ("house.j", "River Gauge Session", "2026-03-17", 1, {"web_url": "a"}),
        ("house.j", "River Gauge Session", "2026-03-18", 1, {"web_url": "b"}),
        ("house.j", "Orchard Pruning Calendar", "2026-03-17", 1, {"web_url": "c"}),
    ]
    assert resolve.dedup_fuzzy(frame(spark, rows)).count() == 3
    rows[1] = (*rows[1][:4], {"video_id": "v"})
    merged = resolve.dedup_fuzzy(frame(spark, rows)).collect()
    assert len(merged) == 2
    assert str([r for r in merged if "video_id" in r["sources"]][0]["event_date"]) == "2026-03-17"


def test_titles_by_authority_then_length(spark):
    long_tail = "Hearing: Maintenance of Nineteenth Century Stone Aqueducts and Their Locks on the Eastern Canal"
    rows = [
        ("house.j", "Hearing: Maintenance of Nineteenth Century Stone Aqueducts and Their Locks", "2026-03-17", 2, {"web_url": "a"}),
        ("house.j", long_tail, "2026-03-17", 2, {"web_url": "b"}),
    ]
    assert resolve.dedup_exact(frame(spark, rows)).first()["title"] == long_tail
    rows[0] = (*rows[0][:3], 4, {"event_id": "e"})
    out = resolve.dedup_exact(frame(spark, rows)).first()
    assert out["title"] == rows[0][1] and out["authority"] == 4


def test_cross_key_prefers_specific_key_in_either_order(spark):
    gov = ("govinfo.house", "STATE OF THE HARBOUR DREDGING FUND", "2026-04-08", 3, {"package_id": "p"})
    own = ("house.wm", "Full Committee Hearing: State of the Harbour Dredging Fund", "2026-04-08", 1, {"video_id": "v"})
    for rows in ([gov, own], [own, gov]):
        df = frame(spark, rows)
        out = resolve.merge_pairs(df, resolve.cross_key_pairs(df)).collect()
        assert len(out) == 1 and out[0]["block_key"] == "house.wm" and set(out[0]["sources"]) == {"package_id", "video_id"}


def test_cross_key_follows_the_registry(spark):
    """A key that the registry does not hold is no better than a fallback key; of several such the last stays."""
    title = "State of the Harbour Dredging Fund"
    rows = [("house.gone", title, "2026-04-08", 4, {"a": "1"}), ("govinfo.house", title, "2026-04-08", 3, {"b": "2"}), ("house.wm", title, "2026-04-08", 1, {"c": "3"})]
    for known, want in ((["house.wm"], "house.wm"), ([], "house.wm"), (["house.wm", "house.gone"], "house.gone"), (["govinfo.house"], "house.wm")):
        df = frame(spark, rows).withColumn("registered", F.col("block_key").isin(known) if known else F.lit(False))
        out = resolve.merge_pairs(df, resolve.cross_key_pairs(df)).collect()
        assert [(r["block_key"], r["title"], r["authority"]) for r in out] == [(want, title, 4)]
    df = frame(spark, rows[:2]).withColumn("registered", F.lit(False))
    assert resolve.merge_pairs(df, resolve.cross_key_pairs(df)).first()["block_key"] == "govinfo.house"


def test_adjacent_day_merge_counts_sources(spark):
    """Of equal authorities the record with more sources leads, whatever the order; the other's entries override."""
    few = ("house.j", "Upkeep of Canal Towpaths and Lamps", "2026-03-17", 2, {"web_url": "w1"})
    many = ("house.j", "Upkeep of Canal Towpaths or Lamps!", "2026-03-18", 2, {"video_id": "v", "web_url": "w2"})
    for rows in ([few, many], [many, few]):
        out = resolve.merge_adjacent(frame(spark, rows)).collect()
        assert len(out) == 1 and out[0]["rec"] == rows.index(many) and str(out[0]["event_date"]) == "2026-03-17"
        assert out[0]["sources"] == {"video_id": "v", "web_url": "w1"}


def test_precedence_merge(spark):
    from recordlink.operators.enrich import Supplier, precedence_merge

    base = spark.createDataFrame([(1, "own", None, "x"), (2, None, None, "y"), (3, None, "b", "z")], "k int, a string, b string, other string")
    one = spark.createDataFrame([(1, "s1", 5), (2, "late", 9), (2, "early", 4), (2, None, 1), (7, "nobody", 1)], "k int, a string, o int")
    two = spark.createDataFrame([(1, "t1", None), (3, None, "tb")], "k int, a string, b string")
    three = spark.createDataFrame([(2, "u2", "ub"), (3, "u3", "ub")], "k int, a string, b string")
    out = precedence_merge(base, "k", [Supplier(one, order="o", count_as="n"), Supplier(two, frozenset({"a", "b"})), Supplier(three)])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert sorted((r["k"], r["a"], r["b"], r["other"], r["n"]) for r in out.collect()) == [(1, "t1", None, "x", 1), (2, "early", "ub", "y", 3), (3, "u3", "tb", "z", 0)]


def test_page_details_override_and_fill(spark):
    rows = [
        ("senate.a", "Upkeep of Canal Towpaths", "2026-03-17", 2, {"web_url": "u1"}), ("senate.a", "Ferries in Winter Ice", "2026-03-18", 2, {"web_url": "u2", "video_id": "own"}),
        ("house.b", "Lamps Along the Quay", "2026-03-17", 2, {"web_url": "u3"}), ("house.c", "Ropes and Anchors", "2026-03-17", 2, {"web_url": "u4"}),
    ]
    dim = spark.createDataFrame([("senate.a", "A", "aa", False), ("house.b", "B", "bb", True)], "k string, n string, c string, s boolean")
    details = spark.createDataFrame(
        [("u1", ["p1"], "e1", "pc", "pf"), ("u2", [], "e2", None, "lone"), ("u3", ["p3", "q3"], None, "hc", "hf"), ("u4", ["p4"], "e4", "xc", "xf")],
        "url string, pdf_urls array<string>, embed_id string, stream_comm string, stream_file string",
    )
    found = spark.createDataFrame([], "record_id string, url string")
    casts = spark.createDataFrame([(1, "house.zz", "2026-03-17", "Anchors", "cast1"), (2, "house.c", "2026-03-17", "Quay", "cast2")], "video int, block_key string, event_date string, title string, url string")
    casts = casts.withColumn("event_date", F.col("event_date").cast("date"))
    out = resolve.resolve_all(frame(spark, rows), dim, "k", "n", "c", "2026-03-17", found=found, broadcasts=casts, details=details, dim_scrape="s")
    got = {r["title"]: (r["pdf_urls"], r["video_url"], r["stream_comm"], r["stream_file"], r["broadcast_url"]) for r in out.collect()}
    page = "https://www.youtube.com/watch?v="
    assert got == {
        "Upkeep of Canal Towpaths": (["p1"], page + "e1", "pc", "pf", None), "Ferries in Winter Ice": (None, "own", "aa", "aa031826", None),
        "Lamps Along the Quay": (["p3", "q3"], None, "hc", "hf", None), "Ropes and Anchors": (None, None, None, None, "cast1"),
    }


def test_looked_up_pages_are_for_past_records(spark):
    rows = [("house.a", f"Session number {w} of the year", d, 2, {"web_url": "u", **more}) for w, d, more in (
        ("one", "2026-03-17", {}), ("two", "2026-03-19", {}), ("three", "2026-03-01", {"broadcast_url": "kept"}))]
    dim = spark.createDataFrame([("house.a", "A", "aa")], "k string, n string, c string")
    first = resolve.resolve_all(frame(spark, rows), dim, "k", "n", "c", "2026-03-18")
    found = first.select("record_id", F.concat(F.lit("for "), "title").alias("url"))
    out = resolve.resolve_all(frame(spark, rows), dim, "k", "n", "c", "2026-03-18", found=found)
    assert {r["title"].split()[2]: r["broadcast_url"] for r in out.collect()} == {"one": "for Session number one of the year", "two": None, "three": "kept"}


def test_cross_key_leaves_other_groups_and_same_key(spark):
    budget = "Lighthouse Staffing and Fuel Review"
    df = frame(spark, [
        ("house.budget", budget, "2026-04-08", 1, {"a": "1"}), ("senate.budget", budget, "2026-04-08", 1, {"a": "2"}),
        ("house.j", "River Gauge Session Part 1", "2026-03-17", 1, {"a": "3"}), ("house.j", "River Gauge Session Part 2", "2026-03-17", 1, {"a": "4"}),
    ])
    assert resolve.cross_key_pairs(df).count() == 0


def test_cross_key_threshold_is_strict(spark):
    # 2 shared of 5 words: exactly 0.4
    df = frame(spark, [("house.a", "one two three four", "2026-04-08", 1, {"a": "1"}), ("house.b", "one two five", "2026-04-08", 1, {"a": "2"})])
    assert resolve.cross_key_pairs(df).count() == 0
    assert resolve.cross_key_pairs(df, strict=False).count() == 1


def test_adjacent_day_merge_prefers_authority(spark):
    df = frame(spark, [
        ("house.j", "Upkeep of Canal Towpaths and Lamps", "2026-03-17", 4, {"event_id": "e"}),
        ("house.j", "Hearing: Upkeep of Canal Towpaths and Lamps Review", "2026-03-18", 1, {"video_id": "v"}),
    ])
    out = resolve.merge_pairs(df, resolve.adjacent_day_pairs(df)).collect()
    assert len(out) == 1 and out[0]["authority"] == 4 and out[0]["title"].startswith("Upkeep") and "video_id" in out[0]["sources"]


def test_merge_order_of_source_entries(spark):
    df = frame(spark, [("k", "same title", "2026-01-01", 4, {"url": "high"}), ("k", "same title", "2026-01-01", 1, {"url": "low"})])
    df = df.withColumn("c", F.lit(1))
    assert resolve.merge_records(df, "c").first()["sources"] == {"url": "low"}
    assert resolve.merge_records(df, "c", prefer="authority").first()["sources"] == {"url": "high"}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a and b else 0.0


@pytest.mark.parametrize("limits", [(256, 4096), (8, 4), (0, 1)])
def test_similarity_join_equals_all_pairs(spark, monkeypatch, limits):
    from recordlink.operators import similarity

    monkeypatch.setattr(similarity, "DIRECT", limits[0])
    monkeypatch.setattr(similarity, "PART", limits[1])
    rng = random.Random(7)
    words = [f"w{i}" for i in range(12)]
    sets = [(i, rng.choice("xy"), sorted(set(rng.choices(words, weights=range(12, 0, -1), k=rng.randint(1, 6))))) for i in range(120)]
    df = spark.createDataFrame(sets, "id bigint, blk string, tokens array<string>")
    left, right = df.withColumnRenamed("id", "a"), df.withColumnRenamed("id", "b")
    for t, strict in [(0.1, False), (0.3, False), (0.5, True), (1.0, False)]:
        got = {(r["a"], r["b"]) for r in similar_pairs(left, right, ["blk"], t, ["a"], ["b"], F.col("a") < F.col("b"), strict).collect()}
        want = {
            (x[0], y[0])
            for x, y in itertools.combinations(sets, 2)
            if x[1] == y[1] and (jaccard(set(x[2]), set(y[2])) > t if strict else jaccard(set(x[2]), set(y[2])) >= t)
        }
        assert got == want, t


def test_fuzzy_representatives_equal_sequential_rule(spark):
    """Rounds against the one-by-one rule, with one block holding most rows."""
    import datetime

    rng = random.Random(3)
    vocab = "tax farm bill water trade health energy border".split()
    rows = []
    for _ in range(90):
        title = " ".join(rng.sample(vocab, rng.randint(2, 4)))
        day = f"2026-03-{rng.choice([1, 1, 1, 2, 3]):02d}"
        rows.append(("k1" if rng.random() < 0.8 else "k2", title, day, rng.randint(0, 4), {"video_id": "v"} if rng.random() < 0.4 else {"web_url": "w"}))
    exact = resolve.dedup_exact(frame(spark, rows)).drop("n_merged")
    got = {r["rec"]: r["cluster"] for r in resolve.fuzzy_representatives(exact).collect()}

    records = sorted(exact.collect(), key=lambda r: (-r["authority"], r["rec"]))
    nodes: dict = {}
    for r in records:
        key = (r["block_key"], r["event_date"], frozenset(r["title"].lower().split()))
        node = nodes.setdefault(key, {"rec": r["rec"], "video": False, "members": []})
        node["video"] |= r["has_video"]
        node["members"].append(r["rec"])
    reps, want = [], {}
    for key, node in nodes.items():
        chosen = None
        for shift in (0, -1, 1):
            for rkey, rep in reps:
                if rkey[0] != key[0] or rkey[1] != key[1] + datetime.timedelta(days=shift):
                    continue
                if shift and not (rep["video"] or node["video"]):
                    continue
                if jaccard(rkey[2], key[2]) >= (0.45 if shift else 0.30):
                    chosen = rep
                    break
            if chosen:
                break
        if chosen is None:
            reps.append((key, node))
            chosen = node
        for member in node["members"]:
            want[member] = chosen["rec"]
    assert got == want


def test_resolution_does_not_depend_on_partitioning(spark):
    rng = random.Random(11)
    rows = [("k", " ".join(rng.sample("a1 b2 c3 d4 e5 f6".split(), 3)), f"2026-03-0{rng.randint(1, 3)}", rng.randint(0, 4), {"video_id": str(i)}) for i in range(60)]
    df = frame(spark, rows)
    once = {tuple(r[c] for c in ("rec", "title", "n_merged")) for r in resolve.dedup_fuzzy(df.repartition(1)).collect()}
    again = {tuple(r[c] for c in ("rec", "title", "n_merged")) for r in resolve.dedup_fuzzy(df.repartition(7, "title")).collect()}
    assert once == again


def test_stars_of_hubs_are_joined_without_a_hot_key(spark, monkeypatch):
    """With a hub, the other edges are joined by key and the hub's stay in their partitions."""
    monkeypatch.setattr(resolve, "HUB", 1000)
    edges = spark.range(1, 40_001).select(F.col("id").alias("u"), F.lit(0).cast("bigint").alias("v"))
    edges = edges.unionByName(spark.range(50_000, 50_500).select((F.col("id") + 1).alias("u"), F.col("id").alias("v")))
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    out = resolve.with_least(both, 81_000, own=True)
    rows = out.withColumn("part", F.spark_partition_id()).filter("u = 0").groupBy("part").count().collect()
    assert sum(r["count"] for r in rows) == 40_000 and len(rows) > 1
    assert out.filter("u = 0 AND m <> 0").isEmpty() and out.count() == both.count()
    clusters = resolve.connected_clusters(both.select(F.col("u").alias("id")), edges, "id", "u", "v")
    assert clusters.groupBy("cluster").count().count() == 2 and clusters.filter("cluster = 0").count() == 40_001


@pytest.mark.parametrize("hub", [100_000, 2])
def test_connected_clusters(spark, monkeypatch, hub):
    monkeypatch.setattr(resolve, "HUB", hub)
    rng = random.Random(5)
    n = 60
    edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(35)] + [(i, i + 1) for i in range(100, 130)]
    parent = {i: i for i in [*range(n), *range(100, 131)]}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    nodes = spark.createDataFrame([(i,) for i in parent], "id bigint")
    got = {r["id"]: r["cluster"] for r in resolve.connected_clusters(nodes, spark.createDataFrame(edges, "a bigint, b bigint"), "id").collect()}
    assert got == {i: find(i) for i in parent}
    lone = resolve.connected_clusters(nodes, spark.createDataFrame([], "a bigint, b bigint"), "id")
    assert lone.filter("id = cluster").count() == len(parent)


def test_reconcile_takes_words_of_distinct_titles_only(spark, monkeypatch):
    count = spark.sparkContext.accumulator(0)
    words = F.udf(lambda t: count.add(1) or sorted(set(t.lower().split())), "array<string>").asNondeterministic()
    monkeypatch.setattr(attach.text, "token_set", words)
    rows = [(i, "k", "2026-03-17", ("River Gauge Session", "Gauge River Session")[i % 2], "") for i in range(600)]
    schema = "id bigint, k string, d string, t string, ev string"
    new, old = (spark.createDataFrame(x, schema) for x in (rows[:500], rows[4:]))
    got = {(r["old_id"], r["new_id"]) for r in attach.reconcile_ids(new, old, "id", "k", "d", "t", "ev").collect()}
    assert got == {(5 if i == 4 else 4, i) for i in range(500)}
    assert count.value < 40


def test_edges_are_reduced_before_they_are_shuffled(spark, monkeypatch):
    """Of a block linked all to all no more edges than nodes are kept, also when a task reduces them in parts."""
    kept = []
    monkeypatch.setattr(resolve, "materialize", lambda df: kept.append(materialize(df)) or kept[-1])
    monkeypatch.setattr(resolve, "FOREST", 700, raising=False)
    ids = spark.range(120).filter("id <> 7").coalesce(1)
    edges = ids.select(F.col("id").alias("a")).crossJoin(ids.select(F.col("id").alias("b"))).filter("a < b AND a % 3 = b % 3").coalesce(1)
    got = {(r["id"], r["cluster"]) for r in resolve.connected_clusters(spark.range(120), edges, "id").collect()}
    assert got == {(i, 7 if i == 7 else i % 3) for i in range(120)}
    assert kept[0].count() <= 119


def test_clips(spark):
    recs = spark.createDataFrame(
        [(1, "k", "2026-03-17", "River Gauge Session", ""), (2, "k", "2026-03-18", "River Gauge Session", ""), (3, "other", "2026-03-17", "River Gauge", ""),
         (4, "k", "2026-02-12", "Ferry Toll", "own")],
        "rec bigint, k string, d string, t string, url string",
    )
    clips = spark.createDataFrame(
        [(10, "k", "2026-03-17", "Warden on River Gauge", "u10"), (11, "k", "2026-03-17", "River gauge question", "u11"), (12, "k", "2026-03-17", "Unrelated words only", "u12"),
         (13, "k", "2026-02-12", "Ferry toll debate", "u13")],
        "clip bigint, k string, d string, ct string, u string",
    )
    out, listed = attach.attach_best_similar(recs, clips, "k", "d", "t", "rec", "url", "ct", "clip", "u")
    got = {r["rec"]: (r["url"], r["n_clips"]) for r in out.collect()}
    assert got == {1: ("u10", 2), 2: (None, 0), 3: (None, 0), 4: ("own", 1)}
    assert {(r["record"], r["video"]) for r in listed.collect()} == {(1, 10), (1, 11), (4, 13)}
    none, _ = attach.attach_best_similar(recs, clips.limit(0), "k", "d", "t", "rec", "url", "ct", "clip", "u")
    assert none.filter("n_clips > 0").count() == 0


def test_two_tier_takes_single_candidate_without_shared_words(spark):
    recs = spark.createDataFrame([(1, "a", "d1", "Ferry Toll", ""), (2, "b", "d1", "Mill Race Outlook", ""), (3, "b", "d1", "Slate Roofs", "")], "rec bigint, k string, d string, t string, url string")
    vids = spark.createDataFrame([(1, "a", "d1", "zzz", "u1"), (2, "b", "d1", "slate roofs today", "u2"), (3, "x", "d1", "mill race", "u3"), (4, "x", "d9", "none", "u4")], "v bigint, k string, d string, vt string, u string")
    out, rest = attach.attach_two_tier(recs, vids, "k", "d", "t", "rec", "url", "vt", "v", "u")
    assert {r["rec"]: r["url"] for r in out.collect()} == {1: "u1", 2: "u3", 3: "u2"}
    assert [r["v"] for r in rest.collect()] == [4]


PACKAGES = [
    ("HEARING BEFORE THE COMMITTEE ON WAYS AND MEANS", "house", "house.ways_and_means"),
    ("COMMITTEE ON FINANCE--UNITED STATES SENATE", "senate", "senate.finance"),
    ("HEARING BEFORE COMMITTEE ON BANKING, HOUSING, AND URBAN AFFAIRS", "senate", "senate.banking"),
    ("NOMINATIONS", "senate", None),
    ("DEPARTMENT OF DEFENSE APPROPRIATIONS FOR FISCAL YEAR 2026", "senate", "senate.appropriations"),
    ("hearing before the committee on ways and means", "house", "house.ways_and_means"),
    ("HEARING BEFORE THE COMMITTEE ON THE JUDICIARY", "house", "house.judiciary"),
    ("HEARING BEFORE THE COMMITTEE ON THE JUDICIARY", "senate", "senate.judiciary"),
    ("AUTHORIZATION FOR APPROPRIATIONS BEFORE THE COMMITTEE ON ARMED SERVICES", "senate", "senate.armed_services"),
    ("HEARING BEFORE THE COMMITTEE ON FINANCE", "house", None),
    ("HEARING BEFORE THE COMMITTEE ON WAYS AND MEANS", "unknown", "house.ways_and_means"),
    ("", "house", None),
]


def test_fragment_match(spark):
    dim = spark.createDataFrame(
        [("ways and means", "house.ways_and_means"), ("finance", "senate.finance"), ("banking", "senate.banking"), ("appropriations", "senate.appropriations"),
         ("appropriations", "house.appropriations"), ("judiciary", "house.judiciary"), ("judiciary", "senate.judiciary"), ("armed services", "senate.armed_services"),
         ("financial services", "house.financial_services")],
        "f string, k string",
    )
    items = spark.createDataFrame([(i, t, g) for i, (t, g, _) in enumerate(PACKAGES)], "i int, t string, g string")
    out = {r["i"]: (r["matched_key"], r["key"]) for r in lookup.fragment_match(items, "i", "t", "g", dim, "f", "k").collect()}
    for i, (_, g, want) in enumerate(PACKAGES):
        assert out[i] == (want, want or f"govinfo.{g}")


def test_code_lookup_order_and_allowed(spark):
    items = spark.createDataFrame([(1, ["zz00", "hsif16", "hswm00"]), (2, ["hswm00"]), (3, [""]), (4, ["none"])], "i int, codes array<string>")
    dim = spark.createDataFrame([("hsif00", "house.energy"), ("hswm00", "house.wm"), ("hsif16", "house.sub")], "code string, k string")
    got = {r["i"]: r["key"] for r in lookup.code_lookup(items, "i", "codes", dim, "code", "k").collect()}
    assert got == {1: "house.sub", 2: "house.wm"}
    allowed = spark.createDataFrame([("house.wm",)], "k string")
    assert [r["i"] for r in lookup.code_lookup(items, "i", "codes", dim, "code", "k", allowed).collect()] == [2]


def test_reconcile(spark):
    cols = "id string, k string, d string, t string, ev string"
    new = spark.createDataFrame([("n1", "k", "d", "Weir Upkeep Outlook", "e1"), ("n2", "k", "d", "Ferry Toll Review", ""), ("n3", "k", "d", "Unseen", ""), ("n4", "k", "d", "Same Row", "e4")], cols)
    old = spark.createDataFrame([("o1", "k", "d", "Other", "e1"), ("o2", "k", "d", "Ferry Toll", ""), ("n4", "k", "d", "Same Row", "e4")], cols)
    got = {(r["old_id"], r["new_id"], r["rule"]) for r in attach.reconcile_ids(new, old, "id", "k", "d", "t", "ev").collect()}
    assert got == {("o1", "n1", "event_id"), ("o2", "n2", "title")}


@pytest.mark.parametrize("limits", [(256, 4096), (3, 4), (0, 1)])  # all direct; a few; every block large and every token frequent
def test_best_partner_equals_all_pairs(spark, monkeypatch, limits):
    from recordlink.operators import similarity

    monkeypatch.setattr(similarity, "DIRECT", limits[0])
    monkeypatch.setattr(similarity, "PART", limits[1])
    rng = random.Random(9)
    words = [f"w{i}" for i in range(15)]

    def some(n, low):
        return [(i, rng.choice("xxy"), sorted(set(rng.choices(words, weights=range(15, 0, -1), k=rng.randint(low, 6))))) for i in range(n)]

    vids, recs = some(60, 0), some(80, 0)
    left = spark.createDataFrame(vids, "v bigint, blk string, tokens array<string>").select("blk", "tokens").distinct()
    right = spark.createDataFrame(recs, "r bigint, blk string, tokens array<string>").groupBy("blk", "tokens").agg(F.min("r").alias("r"))
    for threshold in (None, 0.15, 0.5):
        want = {}
        for _, blk, ws in vids:
            scored = []
            for r, b, rw in recs:
                shared = len(set(ws) & set(rw))
                score = shared if threshold is None else jaccard(set(ws), set(rw))
                if b == blk and shared and score >= (threshold or 1):
                    scored.append((-score, r))
            if scored:
                want[(blk, tuple(ws))] = (min(scored)[1], round(-min(scored)[0], 9))
        rows = similarity.best_partner(left, right, ["blk"], "r", threshold).collect()
        assert {(r["blk"], tuple(r["tokens"])): (r["best"], round(r["score"], 9)) for r in rows} == want


def test_candidates_grow_with_the_rows_of_a_block(spark):
    """Like titles of one block: twice the titles give at most about twice the candidates."""
    from recordlink.operators import similarity

    def candidates(n):
        title = lambda i: ["annual", f"n{i:05d}", "on", "session"] + (["spring"] if i % 3 == 0 else [])
        left = spark.createDataFrame([("b", sorted(title(i)), 2) for i in range(0, 2 * n, 2)], "blk string, __ta array<string>, __need int")
        right = spark.createDataFrame([("b", sorted(title(i)), i) for i in range(n)], "blk string, __tb array<string>, __o bigint")
        a, b = similarity.large_sides(left, right, ["blk"])
        return similarity.rare_candidates(a, b, ["blk"]).count() + similarity.class_candidates(a, b, ["blk"]).count()

    small, large = candidates(2000), candidates(4000)
    assert 0 < small < 4 * 2000 and large < 2.2 * small


def by_turns(recs, streams):
    """One stream after the other takes the most similar record of its day that is still free."""
    words = lambda t: {w for w in t.lower().split() if len(w) > 2}
    gone, won = {r for r, _, _, url, dur in recs if url and (dur or 0) >= 1800}, {}
    for v, d, title, _, dur in sorted(streams):
        if dur < 1800:
            continue
        found = [(-jaccard(words(t), words(title)), r) for r, day, t, _, _ in recs if day == d and r not in gone]
        found = sorted(x for x in found if -x[0] >= 0.10)
        if found:
            gone.add(found[0][1])
            won[found[0][1]] = f"u{v}"
    return won


def test_streams_take_records_in_turn(spark):
    rng = random.Random(11)
    vocab = "otter heron peat moss weir canal lamp stone mill ferry".split()
    title = lambda: " ".join(rng.sample(vocab, rng.randint(1, 4)))
    recs = [(i, f"d{i % 3}", title(), rng.choice(["", "own"]), rng.choice([None, 900, 2400])) for i in range(40)]
    recs += [(100, "d9", "peat moss", "", None), (101, "d9", "peat moss weir", "", None)]
    streams = [(i, f"d{i % 3}", title(), f"u{i}", rng.choice([600, 1800, 4000])) for i in range(30)]
    streams += [(200, "d9", "peat moss", "u200", 2000), (201, "d9", "peat moss", "u201", 2000), (202, "d9", "peat moss", "u202", 2000)]
    r = spark.createDataFrame(recs, "rec bigint, d string, t string, url string, dur int")
    v = spark.createDataFrame(streams, "clip bigint, d string, ct string, u string, ud int")
    out = attach.attach_date_similar(r, v, "d", "t", "rec", "url", "dur", "ct", "clip", "u", "ud").collect()
    won = by_turns(recs, streams)
    assert {x["rec"]: x["url"] for x in out} == {i: won.get(i, url) for i, _, _, url, _ in recs}
    assert won[100] == "u200" and won[101] == "u201"


def test_authority_order_reads_the_records_of_the_tables(spark, sf_dir):
    from recordlink.plans import QUERIES

    rows = [(-r["authority"], r["rec"]) for r in QUERIES["authority_order"](spark, sf_dir).collect()]
    assert rows and rows == sorted(rows) and len({a for a, _ in rows}) == 3


def test_fragment_match_gathers_no_exploded_titles(spark, sf_dir):
    from recordlink.plans import QUERIES

    lines = QUERIES["fragment_match"](spark, sf_dir)._jdf.queryExecution().sparkPlan().toString().splitlines()
    depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    joins = [i for i, x in enumerate(lines) if "BroadcastHashJoin" in x]
    assert any("Generate" in x for x in lines)
    for i in joins:
        child = depth[i] + 3
        starts = [j for j in range(i + 1, len(lines)) if depth[j] == child and all(d > depth[i] for d in depth[i + 1:j])]
        gathered = starts[-1] if "BuildRight" in lines[i] else starts[0]
        for line in lines[gathered:]:
            if "Aggregate" in line or "Scan" in line:  # up to here the gathered side is as long as its exploded rows
                break
            assert "Generate" not in line, lines[i]


def test_fragment_match_reads_equal_titles_and_nulls(spark):
    dim = spark.createDataFrame([("toads", "house.b"), ("toads", "house.a"), ("toads", "senate.a")], "f string, k string")
    items = spark.createDataFrame([(1, "On Toads", "house"), (2, "On Toads", "house"), (3, "On Toads", None), (4, None, "senate"), (5, "On Toads", "senate")], "i int, t string, g string")
    got = {r["i"]: r["key"] for r in lookup.fragment_match(items, "i", "t", "g", dim, "f", "k").collect()}
    assert got == {1: "house.a", 2: "house.a", 3: "house.a", 4: "govinfo.senate", 5: "senate.a"}


def test_code_lookup_meets_a_code_once(spark):
    items = spark.createDataFrame([(1, ["aaaa00"]), (2, ["bbbb07"]), (3, ["cccc00"])], "i int, codes array<string>")
    dim = spark.createDataFrame([("aaaa00", None), ("aaaa00", "k2"), ("aaaa00", "k1"), ("bbbb00", "k4"), ("bbbb00", "k3"), ("cccc00", None)], "code string, k string")
    out = lookup.code_lookup(items, "i", "codes", dim, "code", "k")
    assert {r["i"]: r["key"] for r in out.collect()} == {1: "k1", 2: "k3"}


def test_copies_of_a_title_are_gone_before_its_words_are_taken(spark):
    rows = [(i, "house.a", "Toad Tunnels", "2026-01-02", 1 + i % 2, i == 5) for i in range(8)]
    df = spark.createDataFrame(rows, "rec int, block_key string, title string, event_date string, authority int, has_video boolean")
    nodes = resolve._title_nodes(df)
    plan = nodes._jdf.queryExecution().optimizedPlan().toString().splitlines()
    taken = [x for x in plan if "array_sort" in x]
    assert taken and all("Aggregate [" in x and "array_sort" not in x.split("]")[0] for x in taken)  # in the output of the aggregate, not in its rows
    assert [(r["node"], r["video"]) for r in nodes.collect()] == [(1, True)]


def test_streams_of_one_title_are_compared_once(spark, monkeypatch):
    sizes = []

    def counted(left, right, *args, **kwargs):
        sizes.append((left.count(), right.count()))
        return similar_pairs(left, right, *args, **kwargs)

    monkeypatch.setattr(attach, "similar_pairs", counted)
    rng = random.Random(5)
    titles = ["peat moss", "moss peat weir", "weir canal", "lamp stone", "stone mill weir"]
    recs = [(i, f"d{i % 2}", rng.choice(titles), "", None) for i in range(60)]
    streams = [(i, f"d{i % 2}", rng.choice(titles[1:]), f"u{i}", 2000) for i in range(50)]
    r = spark.createDataFrame(recs, "rec bigint, d string, t string, url string, dur int")
    v = spark.createDataFrame(streams, "clip bigint, d string, ct string, u string, ud int")
    out = attach.attach_date_similar(r, v, "d", "t", "rec", "url", "dur", "ct", "clip", "u", "ud").collect()
    won = by_turns(recs, streams)
    assert {x["rec"]: x["url"] for x in out} == {i: won.get(i, url) for i, _, _, url, _ in recs}
    assert sizes and all(a <= 8 and b <= 10 for a, b in sizes)  # token sets of two days, not streams and records


def test_titles_are_normalized_once(spark):
    rows = [(i, "house.a", t, "2026-01-02", i % 3, False, {"web_url": f"u{i}"} if i else {}) for i, t in enumerate(["Hearing: Toad Tunnels", "Toad Tunnels"] * 4)]
    rows += [(90, "house.a", "Newts", "2026-01-02", 1, True, {}), (91, "house.a", None, "2026-01-02", 1, True, None)]
    df = spark.createDataFrame(rows, "rec bigint, block_key string, title string, event_date string, authority int, has_video boolean, sources map<string, string>")
    out = resolve.dedup_exact(df)
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    made = [x for x in plan if "regexp_replace" in x]
    assert made and all("Aggregate [title" in x for x in made)  # in the output of the distinct titles, not in the rows
    got = {r["rec"]: (r["title"], r["n_merged"], r["sources"]) for r in out.collect()}
    assert got == {2: ("Hearing: Toad Tunnels", 8, {"web_url": "u6"}), 90: ("Newts", 1, None), 91: (None, 1, None)}


def test_rows_of_videos_carry_no_words(spark, monkeypatch):
    recs = spark.createDataFrame([(1, "a", "d1", "peat moss"), (2, "a", "d1", "weir canal"), (3, "a", "d1", "peat moss")], "rec bigint, k string, d string, t string")
    vids = spark.createDataFrame([(i, "a", "d1", "on peat moss" if i % 2 else "the canal") for i in range(6)], "v bigint, k string, d string, vt string")
    kept, materialize = [], attach.materialize
    monkeypatch.setattr(attach, "materialize", lambda df: kept.append(df) or materialize(df))
    near = attach.best_similar(recs, vids, ["k", "d"], "t", "rec", "vt", "v", 0.15)
    tiers = attach.two_tier_matches(recs, vids, "k", "d", "t", "rec", "vt", "v")
    for out in (near, tiers):
        assert "regexp_replace" not in out._jdf.queryExecution().optimizedPlan().toString()
        assert {r["video"]: r["record"] for r in out.collect()} == {i: 1 if i % 2 else 2 for i in range(6)}
    lines = [x for df in kept for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "regexp_replace" in x]
    assert len(lines) >= 4 and all("Aggregate [" in x for x in lines)  # words of distinct titles only


@pytest.mark.parametrize("tile", [2, 7, 1024])
def test_links_across_keys_have_the_components_of_all_pairs(spark, monkeypatch, tile):
    monkeypatch.setattr(resolve, "TILE", tile)
    dice = random.Random(tile)
    words = ["river", "lake", "budget", "review", "coast", "harvest", "energy", "report"]
    keys = ["house.a", "house.b", "house.c", "senate.a", "govinfo.house"]
    rows = [
        (dice.choice(keys), " ".join(dice.sample(words, dice.randint(1, 4))), dice.choice(["2026-03-01", "2026-03-02", None]), dice.randint(1, 3), {"w": str(i)})
        for i in range(90)
    ]
    df = frame(spark, rows)
    for strict in (True, False):
        found = [
            {(r["rec"], r["cluster"]) for r in resolve.connected_clusters(df, edges(df, 0.5, strict), "rec").collect()}
            for edges in (resolve.cross_key_pairs, resolve.cross_key_links)
        ]
        assert found[0] == found[1] and len({c for _, c in found[0]}) < 90


def test_resolution_writes_no_pairs_across_keys(spark, monkeypatch):
    monkeypatch.setattr(resolve, "cross_key_pairs", lambda *_: pytest.fail("pairs of a day were written out"))
    rows = [("house.a", "River Budget Review", "2026-03-01", 1, {"w": "x"}), ("house.b", "River Budget Review", "2026-03-01", 2, {"w": "y"})]
    dim = spark.createDataFrame([("house.a",), ("house.b",)], "k string")
    assert resolve.resolve_records(frame(spark, rows), dim, "k", "2026-03-02").count() == 1


def test_kept_tables_are_packed_and_leave_no_shuffle_files(spark):
    """A kept table is Parquet, and the shuffle files of the job that made it go at its end."""
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffle_files():
        return {str(manager.getAllFiles().apply(i)) for i in range(manager.getAllFiles().size()) if "shuffle_" in str(manager.getAllFiles().apply(i))}

    before = shuffle_files()
    kept = materialize(spark.range(2000).groupBy((F.col("id") % 50).alias("k")).agg(F.max("id").alias("m")))
    assert "parquet" in kept._jdf.queryExecution().executedPlan().toString()
    assert shuffle_files() <= before and kept.count() == 50


def test_streams_write_no_pairs_of_titles(spark, monkeypatch):
    """All titles of a day resemble each other: what comes out of their comparison are the choices, not the pairs."""
    made = []
    monkeypatch.setattr(attach, "similar_pairs", lambda *a, **k: made.append(similar_pairs(*a, **k)) or made[-1])
    recs = [(i, "d", f"common word n{i}", "", None) for i in range(60)]
    streams = [(i, "d", f"common word m{i}", f"u{i}", 2000) for i in range(50)]
    r = spark.createDataFrame(recs, "rec bigint, d string, t string, url string, dur int")
    v = spark.createDataFrame(streams, "clip bigint, d string, ct string, u string, ud int")
    out = attach.attach_date_similar(r, v, "d", "t", "rec", "url", "dur", "ct", "clip", "u", "ud").collect()
    assert {x["rec"]: x["url"] for x in out} == {i: f"u{i}" if i < 50 else "" for i in range(60)}
    assert made[0].count() == 50


def test_unmatched_videos_read_no_titles(spark):
    recs = spark.createDataFrame([(1, "d1", "a b"), (2, None, "c")], "rec bigint, d string, t string")
    vids = spark.createDataFrame([(1, "d1", "zzz", "u1"), (2, "d9", "a b", "u2")], "v bigint, d string, vt string, u string")
    assert [r["v"] for r in attach.unmatched_videos(recs, vids, "d").collect()] == [2]


@pytest.mark.parametrize("length, halo", [(1, 1), (8, 2)])
def test_fuzzy_rounds_across_days_write_no_pairs(spark, monkeypatch, length, halo):
    """Chains over many days, read in short segments, give what the one-by-one rule gives."""
    monkeypatch.setattr(resolve, "similar_pairs", lambda *a, **k: pytest.fail("pairs were written out"))
    monkeypatch.setattr(resolve, "SEGMENT", length, raising=False)
    monkeypatch.setattr(resolve, "HALO", halo, raising=False)
    dice = random.Random(4)
    vocab = "otter heron peat moss weir canal lamp".split()
    rows = [("k", " ".join(dice.sample(vocab, 3)), f"2026-03-{dice.randint(1, 12):02d}", dice.randint(0, 1), {"video_id": "v"}) for _ in range(60)]
    got = {r["rec"]: r["cluster"] for r in resolve.fuzzy_representatives(frame(spark, rows)).collect()}
    firsts, reps, want = {}, [], {}
    for i in sorted(range(60), key=lambda i: (-rows[i][3], i)):
        title, day = frozenset(rows[i][1].split()), int(rows[i][2][-2:])
        if (title, day) not in firsts:
            near = [(k, n) for k, shift in enumerate((0, -1, 1)) for n, (t, d, _) in enumerate(reps) if d == day + shift and jaccard(t, title) >= (0.45 if shift else 0.30)]
            if not near:
                reps.append((title, day, i))
            firsts[title, day] = reps[min(near)[1]][2] if near else i
        want[i] = firsts[title, day]
    assert got == want


def test_pairs_across_keys_come_out_of_tiles(spark, monkeypatch):
    """No join of the sets of a day: only linked ones leave the task that compares them."""
    monkeypatch.setattr(resolve, "similar_pairs", lambda *a, **k: pytest.fail("sets of a day were joined"))
    rows = [("house.a", "River Budget Review", "2026-03-01", 1, {"w": "x"}), ("house.b", "River Budget", "2026-03-01", 2, {"w": "y"}), ("house.b", "Lamps", "2026-03-01", 2, {"w": "z"})]
    assert [(r["a"], r["b"], round(r["sim"], 3)) for r in resolve.cross_key_pairs(frame(spark, rows)).collect()] == [(0, 1, 0.667)]


def test_day_pairs_keep_short_texts_of_words(spark, monkeypatch):
    """Title nodes are kept with one text of their words, not with an array."""
    kept = []
    monkeypatch.setattr(resolve, "materialize", lambda df: kept.append(materialize(df)) or kept[-1])
    rows = [("k", "Peat Moss", "2026-03-01", 1, {"video_id": "x"}), ("k", "Moss, Peat!", "2026-03-02", 1, {"w": "y"})]
    assert [tuple(r) for r in resolve.adjacent_day_pairs(frame(spark, rows)).collect()] == [(0, 1, 1.0)]
    assert kept[0].schema["tokens"].dataType.simpleString() == "string"
