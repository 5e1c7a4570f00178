"""The stages of the corpus pipeline, each on the output of the one before."""

from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import check_packing, poisson, shingles, words_of

from recordlink.llm.scratch import keep
from recordlink.llm.toxicity import score_toxicity


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "minhash_near_dedup", "mixing", "best_fit_packing"]


def test_all_but_the_last_return_the_columns_of_documents(spark, sf_dir, nasty):
    docs = nasty
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = keep(stage(spark, docs, sf_dir), "test")
        assert out.columns == nasty.columns and out.schema.simpleString() == nasty.schema.simpleString()
        assert {r["score"] for r in out.select("score").distinct().collect()} <= {r["score"] for r in nasty.select("score").distinct().collect()}
        docs = out
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() >= docs.count()


def test_stages_on_nothing(spark, sf_dir, nothing):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, sf_dir).count() == 0


def test_repeated_rows_leave_one(spark, sf_dir, nasty):
    left = Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, nasty, sf_dir).select("doc_id", "text").collect())
    assert max(left.values()) == 1
    assert (2, None) in left and (23, None) in left and (None, "alone without an id") in left


def test_clean_documents_stay(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    kept = corpus_pipeline.toxicity(spark, docs, sf_dir).select("doc_id")
    clean = docs.join(labels.filter("toxic = 0"), "doc_id", "left_semi").select("doc_id")
    assert clean.join(kept, "doc_id", "left_anti").count() <= 0.02 * clean.count()


def test_run_packs_what_the_stages_leave(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    total = out.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert total.filter("n <> end OR n > 2048").count() == 0
    assert out.count() > 0


def test_run_equals_plain_python_behind_the_fitted_decision(spark, tmp_path):
    rng = np.random.default_rng(11)
    words = [f"word{i}" for i in range(3000)]
    text = lambda n: " ".join(rng.choice(words, n))
    rows = [[i, f"{text(14)}.\n{text(12)}."] for i in range(240)]
    for i in range(60):  # toxic
        rows.append([300 + i, f"{text(12)}.\nYou are a nitwit really {text(6)}."])
    for i in range(30):  # later copies of a line, with one word more
        rows.append([400 + i, f"{rows[i][1].splitlines()[0][:-1]} more{i}.\n{text(12)}."])
    for i in range(20):  # the words of an earlier document in other lines
        whole = rows[100 + i][1].split()
        rows.append([500 + i, "\n".join(" ".join(whole[a : a + 4]) for a in range(0, len(whole), 4))])
    rows += [[600, text(3000)], [601, rows[5][1]], [602, ""], [603, None]]
    table = spark.createDataFrame([(i, t, "en", ["s1", "s1", "s1", "s2", None][i % 5], None if t is None else len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int(300 <= i < 360)) for i, _ in rows], "doc_id long, toxic int")
    table.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")

    clean = {r["doc_id"] for r in score_toxicity(table, labels).filter("predicted = 0").select("doc_id").collect()}
    docs = sorted((i, t) for i, t in rows if i in clean)
    assert 30 < len(rows) - len(docs) < 120

    seen, left = [], []
    for i, t in docs:
        kept = []
        for line in (t or "").split("\n"):
            w = words_of(line)
            if not any(w and 100 * len(w & s) >= 80 * len(w | s) for s in seen):
                kept.append(line)
            if w:
                seen.append(w)
        left.append((i, None if t is None else "\n".join(kept)))
    assert sum(a != b for a, b in zip(docs, left)) >= 20

    one, sets = [], []
    for i, t in left:  # near copies here are whole groups: each is near the first of its group
        s = shingles(t, 5)
        if not any(s and 100 * len(s & o) >= 80 * len(s | o) for o in sets):
            one.append((i, t))
        sets.append(s)
    assert len(left) - len(one) >= 15

    source = {i: ["s1", "s1", "s1", "s2", ""][i % 5] for i, _ in one}
    counts = Counter(source.values())
    share = sum(n**0.5 for n in counts.values())
    copies = {i: poisson(len(one) / share * counts[s] ** 0.5 / counts[s], 17, i) for i, s in source.items()}
    assert {0, 1, 2} <= set(copies.values())
    mixed = [(i, t) for i, t in one for _ in range(copies[i])]

    out = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset").collect()
    check_packing([tuple(r) for r in out], mixed, corpus_pipeline.SEQUENCE)
