import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from recordlink.operators import captions, chunks, folds, ordered, rank, report


def test_segmented_scan_equals_plain_window(spark):
    """One key holds most rows; any segment width gives the plain window's result."""
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.7 else rng.choice("ab"), i, rng.choice([None, 1, 2, 3])) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, pos bigint, v bigint")
    w = Window.partitionBy("k").orderBy("pos")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumnRenamed("pos", "at")
    w = Window.partitionBy("k").orderBy("at")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = df.withColumn("n", F.row_number().over(w))
    hit = F.max(F.when(F.col("v") == 2, F.col("n"))).over(run)
    flagged = numbered.withColumn("f", (~F.col("v").eqNullSafe(F.lag("v").over(w))).cast("int"))
    want = flagged.select(
        "k", "at", F.coalesce(F.sum("v").over(run), F.lit(0)).alias("s"), F.lag("v").over(w).alias("g"), F.col("n").alias("pos"), hit.alias("m"), F.sum("f").over(run).alias("c")
    )
    want = sorted(map(tuple, want.collect()), key=str)
    for width in (1, 7, 64, 100000):
        seg = ordered.position_segment("at", width)
        out = ordered.ordered_scan(df, ["k"], ["at"], seg, {"s": F.col("v")}, {"g": F.col("v")}, {"m": F.col("v") == 2})
        out = ordered.number_changes(out, ["k"], ["at"], seg, F.col("v"), lambda p, c: ~c.eqNullSafe(p["v"]), "c")
        out = out.select("k", "at", "s", "g", "pos", "m", "c")
        assert sorted(map(tuple, out.collect()), key=str) == want, width


def test_scan_without_keys(spark):
    df = spark.range(50).withColumnRenamed("id", "pos")
    out = ordered.ordered_scan(df, [], ["pos"], ordered.position_segment("pos", 8), {"s": F.lit(1)})
    assert [r["s"] for r in out.orderBy("pos").collect()] == list(range(1, 51))


@pytest.mark.parametrize("levels", [0, 1, 2])
def test_levels_of_segments_equal_a_plain_window(spark, monkeypatch, levels):
    monkeypatch.setattr(ordered, "FAN", 3)
    rng = random.Random(8)
    rows = [(k, i, rng.randrange(-3, 4), rng.choice(["a", None, "b"])) for k in "xy" for i in sorted(rng.sample(range(400), 150))]
    df = spark.createDataFrame(rows, "k string, at int, v int, t string")
    for keys in (["k"], []):
        own = df if keys else df.filter("k = 'x'")
        out = ordered.ordered_scan(own, keys, ["at"], ordered.position_segment("at", 8), {"s": F.col("v")}, {"g": F.col("t")}, {"m": F.col("v") == 2}, levels=levels)
        got = {(r["k"], r["at"]): (r["s"], r["g"], r["m"], r["pos"]) for r in out.collect()}
        want, state = {}, {}
        for k, at, v, t in rows:
            if keys or k == "x":
                total, last, mark, n = state.get(k, (0, None, None, 0))
                n, total, mark = n + 1, total + v, n + 1 if v == 2 else mark
                want[(k, at)] = (total, last, mark, n)
                state[k] = (total, t, mark, n)
        assert got == want


def test_budget_scan_reads_once_and_never_in_one_partition(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_totalprice")
    out = ordered.budget_cutoff(orders, "o_orderkey", "o_totalprice", 1e6).select("o_orderkey", "spent_before")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "SinglePartition" not in plan and plan.count("FileScan parquet") == 1 and "ReusedExchange" in plan


def test_collapse_repeats(spark):
    body = "WEBVTT\nKind: captions\n\n00:00:01.000 --> 00:00:02.000\n<c>Hello</c> there\nHello there\nYes\nNo\nYes\n  \nYes"
    out = ordered.collapse_repeats(spark.createDataFrame([(1, body)], "d int, t string"), "d", "t").first()["lines"]
    assert out == ["Hello there", "Yes", "No", "Yes"]


def test_gap_paragraphs_boundary(spark):
    rows = [(1, i, f"2026-01-01 00:00:{s:02d}") for i, s in enumerate([0, 8, 17, 18])]
    df = spark.createDataFrame(rows, "d int, i int, t string").withColumn("ts", F.col("t").cast("timestamp"))
    for width in ("1 minute", "1 hour"):
        out = ordered.gap_paragraphs(df, ["d"], "ts", "i", ordered.time_segment("ts", width), 8.0)
        assert [r["paragraph"] for r in out.orderBy("i").collect()] == [0, 0, 1, 1]


def test_speaker_turns(spark):
    rows = [(1, 0, "CHAIR", "HELLO."), (1, 1, "CHAIR", "more"), (1, 2, ">>", "who"), (1, 3, "", "again"), (1, 4, "SMITH", " "), (1, 5, "SMITH", "a\nb   c")]
    out = ordered.speaker_turns(spark.createDataFrame(rows, "d int, i int, s string, t string"), "d", "i", "s", "t", width=2).orderBy("i").collect()
    assert [(r["i"], r["turn_no"], r["header"], r["line"]) for r in out] == [
        (0, 1, "CHAIR", "Hello."), (1, 1, None, "more"), (2, 2, "[SPEAKER]", "who"), (3, 2, None, "again"), (5, 3, "SMITH", "a b c"),
    ]
    first = ordered.speaker_turns(spark.createDataFrame([(1, 0, ">>", "x")], "d int, i int, s string, t string"), "d", "i", "s", "t").first()
    assert first["turn_no"] == 0 and first["header"] is None


def test_streak_and_failing(spark):
    rows = [("a", 1, True), ("a", 2, False), ("a", 3, False), ("b", 1, False), ("b", 2, True), ("c", 1, False), ("c", 2, False), ("c", 3, False)]
    df = spark.createDataFrame(rows, "k string, ts int, ok boolean")
    out = ordered.failure_streak(df, ["k"], "ts", "ts", F.col("ok"), F.col("ts"))
    got = {r["k"]: (r["streak"], r["last_success"], r["last_failure"], r["last_count"]) for r in out.collect()}
    assert got == {"a": (2, 1, 3, 1), "b": (0, 2, 1, 2), "c": (3, None, 3, None)}
    assert [r["k"] for r in rank.failing_list(out, 2).collect()] == ["c", "a"]


def test_budget_zero_keeps_nothing(spark):
    df = spark.createDataFrame([(i, 1.0) for i in range(10)], "i bigint, c double")
    assert ordered.budget_cutoff(df, "i", "c", 0).count() == 0
    assert ordered.budget_cutoff(df, "i", "c", 2.5, width=2).count() == 3


def test_stop_after_empty(spark):
    rows = [(1, i, hit, links) for i, (hit, links) in enumerate([(1, 5), (0, 1), (0, 1), (0, 1), (0, 1), (0, 0), (1, 1)])]
    df = spark.createDataFrame(rows, "q int, i bigint, hit int, links int")
    out = ordered.stop_after_empty(df, ["q"], ["i"], ordered.position_segment("i", 3), F.col("hit") == 1, F.col("links"))
    assert [r["i"] for r in out.orderBy("i").collect()] == [0, 1, 2, 3, 4, 5]


def test_next_stage(many):
    assert many(ordered.next_stage(F.col("x")), ["captions", "govinfo", "publish", "nope", None]) == ["isvp", "publish", None, None, None]


# ---------------------------------------------------------------- captions


def test_parse_cues(spark):
    body = "WEBVTT\r\n\r\n1\n00:00:01.000 --> 00:00:02.500 align:start\nHello\n world \n\nstray\n00:01:00.000 --> 00:01:01.000\nA\n01:00:00.250 --> 01:00:02.000\n\n00:00:05.000 --> 00:00:06.000\nlast"
    out = captions.parse_cues(spark.createDataFrame([(1, body)], "d int, t string"), ["d"], "t").orderBy("seq").collect()
    assert [(r["start_s"], r["end_s"], r["text"]) for r in out] == [(1.0, 2.5, "Hello world"), (60.0, 61.0, "A"), (5.0, 6.0, "last")]


SCREENS = [
    ("A B C", "B C D", "D"), ("IS NOT MUC", "IS NOT MUCH BETTER", "BETTER"), ("A B", "C D", "C D"), ("A B C", "A B C", ""), ("X", "X Y X", "Y X"),
    ("ONE TWO THREE", "TWO THREE FOUR FIVE", "FOUR FIVE"), ("A", "AB CD", "CD"), ("P Q R", "PX QX R", "PX QX R"),
]


def test_overlap(spark):
    df = spark.createDataFrame(SCREENS, "a string, b string, want string")
    k = captions.overlap_length(F.split("a", " "), F.split("b", " "))
    for r in df.withColumn("k", k).collect():
        assert " ".join(r["b"].split(" ")[r["k"]:]) == r["want"], r


def test_rolling_diff_rebuilds_text(spark):
    words = [f"{chr(97 + i % 26)}{i:03d}" for i in range(200)]
    cues = [(1, i, float(i), i + 1.0, " ".join(words[i * 3 : i * 3 + 8])) for i in range(67)]
    cues += [(1, 100 + i, float(i), i + 1.0, " ".join(words[i * 3 : i * 3 + 8])) for i in range(5)]
    df = spark.createDataFrame(cues, "d int, seq int, start_s double, end_s double, text string")
    for width in (3.0, 600.0):
        out = captions.rolling_diff(df, "d", width).orderBy("end_s", "seq").collect()
        assert " ".join(r["new_text"] for r in out).split() == words


def test_rolling_diff_equals_the_scan_in_order_and_reads_screens_once(spark):
    rng = random.Random(3)
    texts = [None, "", " a ", "a b", "a b c", "b c d", "b\tc de", "é f", "é fg h", "c d e f", "f"]
    rows = [(d, i, float(i // 2), float(i // 2) + 1, rng.choice(texts)) for d in range(4) for i in range(150)]

    def words(t):
        return [w for w in re.split(r"[ \t\n\x0b\f\r]+", t) if w]

    def overlap(a, b):
        def fits(k):
            apart = [(x, y) for x, y in zip(a[len(a) - k :], b[:k]) if x != y]
            return not apart or (len(apart) == 1 and (apart[0][0].startswith(apart[0][1]) or apart[0][1].startswith(apart[0][0])))
        return max([k for k in range(1, min(len(a), len(b)) + 1) if fits(k)], default=0)

    want, seen = set(), {}
    for d, seq, _, end, now in rows:
        text, last = seen.get(d, (None, None))
        if now is not None and now != text:
            new = now.strip(" ") if text is None else " ".join(words(now)[overlap(words(text), words(now)) :])
            if new and new != last:
                want.add((d, seq, end, new))
            last = new or last
        seen[d] = (now, last)
    count = spark.sparkContext.accumulator(0)
    read = F.udf(lambda t: count.add(1) or t, "string")
    df = spark.createDataFrame(rows, "d bigint, seq int, start_s double, end_s double, text string").repartition(5)
    for width in (1.0, 2.0, 7.0, 600.0):
        out = captions.rolling_diff(df, "d", width).collect()
        assert len(out) == len(want) and {(r["d"], r["seq"], r["end_s"], r["new_text"]) for r in out} == want
    captions.rolling_diff(df.withColumn("text", read("text")), "d").collect()
    assert count.value == len(rows)


def test_caption_paragraphs(spark):
    cues = [(1, 0, 0.0, 1.0, "A B"), (1, 1, 1.0, 9.0, "B C"), (1, 2, 9.0, 17.5, "C D")]
    df = spark.createDataFrame(cues, "d int, seq int, start_s double, end_s double, text string")
    assert [r["paragraph"] for r in captions.caption_paragraphs(df, "d").orderBy("seq").collect()] == [0, 0, 1]


# ---------------------------------------------------------------- chunks


def pack(paras, size, overlap):
    """The packing rule, one paragraph at a time."""
    out, cur, n = [], [], 0
    for p in paras:
        k = len(p) // 4
        if n + k > size and cur:
            out.append(cur)
            tail, m = [], 0
            for q in reversed(cur):
                if m + len(q) // 4 > overlap:
                    break
                tail.insert(0, q)
                m += len(q) // 4
            cur, n = tail, m
        cur = [*cur, p]
        n += k
    return [*out, cur]


def test_chunks_equal_the_packing_rule(spark):
    rng = random.Random(2)
    texts = ["\n\n".join("x" * rng.choice([0, 3, 8, 40, 90, 500]) for _ in range(rng.randint(1, 40))) for _ in range(40)] + ["", "one"]
    df = spark.createDataFrame(list(enumerate(texts)), "d int, t string")
    for size, overlap in [(50, 20), (100, 0), (10, 1000), (3000, 200)]:
        got: dict = {}
        for r in chunks.chunk_paragraphs(df, ["d"], "t", size, overlap).orderBy("d", "chunk_no").collect():
            got.setdefault(r["d"], []).append(r["chunk"])
        for d, t in enumerate(texts):
            assert got[d] == ["\n\n".join(c) for c in pack(t.split("\n\n"), size, overlap)], (d, size, overlap)


def test_chunk_requests(spark):
    long = "\n\n".join(["w" * 8000, "v" * 8000])
    df = spark.createDataFrame([(1, "short", "T", "G"), (2, long, "", None)], "d int, t string, ti string, g string")
    rows = chunks.chunk_requests(df, "d", "t", "ti", "g").orderBy("d", "chunk_no").collect()
    assert rows[0]["request"] == "Title: T\nGroup: G\n\nshort" and rows[0]["n_chunks"] == 1
    assert [r["n_chunks"] for r in rows[1:]] == [2, 2] and "This is chunk 2 of 2." in rows[2]["request"] and rows[1]["request"].startswith("Recorded session")


def test_json_answers(spark):
    raws = ['```json\n[{"quote": "q1"}, 5, {"speaker": "x"}]\n```', '{"quote": "lone"}', "[broken", '[{"quote": "q2", "speaker": "S", "context": "c"}]', ""]
    df = spark.createDataFrame(list(enumerate(raws)), "i int, raw string")
    out = chunks.parse_json_answer(df, ["i"], "raw", ["quote", "speaker", "context"], "quote", {"speaker": "Unknown", "context": ""}).collect()
    assert sorted((r["i"], r["quote"], r["speaker"], r["context"]) for r in out) == [(0, "q1", "Unknown", ""), (3, "q2", "S", "c")]


# ---------------------------------------------------------------- folds


def log(spark, rows):
    full = [("h", s, 1, st, i, i, e, p) for i, (s, st, e, p) in enumerate(rows)]
    df = spark.createDataFrame(full, "id string, step string, version int, status string, ts int, event_id int, error string, payload string")
    return df.withColumn("ts", F.timestamp_seconds("ts"))


def test_step_life_cycle_in_any_order(spark):
    df = log(spark, [("c", "pending", None, None), ("c", "running", None, None), ("c", "failed", "boom", None), ("c", "running", None, None)])
    for n in (1, 5):
        r = folds.step_state_fold(df.repartition(n, F.rand(n))).first()
        assert (r["status"], r["error"], r["started_at"].second, r["completed_at"].second) == ("running", None, 3, 2)


def test_attempts_and_dead_letter(spark):
    rows = [("c", "failed", "e0", "p")] + [("c", x, "e" if x == "failed" else None, None) for _ in range(4) for x in ("running", "failed")]
    r = folds.task_state_fold(log(spark, rows)).first()
    assert (r["status"], r["attempts"], r["payload"], r["last_error"]) == ("dead_letter", 5, "p", "e")
    r = folds.task_state_fold(log(spark, rows[:-1])).first()
    assert (r["status"], r["attempts"], r["completed_at"], r["last_error"]) == ("running", 5, None, None)
    r = folds.task_state_fold(log(spark, [("c", "pending", None, None)])).first()
    assert (r["status"], r["attempts"]) == ("pending", 0)


def test_dead_letter_islands(spark):
    rows = [("t", "k", None, "fail", 1, "a"), ("t", "k", None, "fail", 2, "b"), ("t", "k", None, "requeue", 3, None), ("t", "k", None, "fail", 4, "c"), ("t", "k", "s", "fail", 5, "d")]
    df = spark.createDataFrame([(*r, r[4]) for r in rows], "ty string, k string, st string, kind string, event_id int, error string, attempts int")
    df = df.withColumn("ts", F.timestamp_seconds("event_id")).withColumn("payload", F.lit(None).cast("string"))
    out = folds.dead_letter_fold(df, ["ty", "k", "st"], "1 minute").collect()
    got = sorted((r["st"] or "", r["first_failed_at"].second, r["last_failed_at"].second, r["error"], r["resolved_at"] is not None) for r in out)
    assert got == [("", 1, 2, "b", True), ("", 4, 4, "c", False), ("s", 5, 5, "d", False)]


def test_events_to_inputs(spark):
    rows = [("e1", "published", '{"id": "h1", "path": "p"}'), ("e2", "published", '{"id": "h1", "path": "p2"}'), ("e3", "other", '{"id": "h2", "path": "p"}'), ("e4", "published", '{"id": "h3"}')]
    good, bad = folds.events_to_inputs(spark.createDataFrame(rows, "event_id string, event_type string, payload string"), "published", "payload", "id string, path string", ["id", "path"], "id")
    assert [r["event_id"] for r in good.collect()] == ["e1"] and sorted(r["event_id"] for r in bad.collect()) == ["e2", "e3", "e4"]


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a", "t0", "e1", 1), (2, "b", "t0", None, 1)], "id int, title string, found string, ev string, n int")
    new = spark.createDataFrame([(1, "A", "t9", None, 1), (3, "C", "t9", "e3", 1)], "id int, title string, found string, ev string, n int")
    out = {r["id"]: tuple(r)[1:] for r in folds.record_upsert(old, new, "id", ["found"], ["ev"], ["n"]).collect()}
    assert out == {1: ("A", "t0", "e1", 2), 2: ("b", "t0", None, 1), 3: ("C", "t9", "e3", 1)}


def test_coverage_empty_share(spark):
    df = spark.createDataFrame([], "k string, v boolean")
    m = report.coverage_matrix(df, "k", {"video": F.col("v")}, ["video"])
    assert report.coverage_share(m, "k").filter("percent <> 0").count() == 0


def test_top_quotes_without_score(spark):
    df = spark.range(50)
    assert [r["id"] for r in rank.top_quotes(df, None, ["id"]).collect()] == list(range(30))
