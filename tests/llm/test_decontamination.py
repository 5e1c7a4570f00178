"""Decontamination against a plain scan of every window of every item."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from recordlink.llm.decontamination import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_list(text):
    return WORD.findall((text or "").translate(UPPER))


def plain(docs, items, window):
    out = []
    for doc_id, text in docs:
        w, hit, found = word_list(text), set(), set()
        for item_id, item in items:
            x = word_list(item)
            m = min(window, len(x))
            if not m:
                continue
            windows = {tuple(x[i : i + m]) for i in range(len(x) - m + 1)}
            for p in range(len(w) - m + 1):
                if tuple(w[p : p + m]) in windows:
                    hit.update(range(p, p + m))
                    found.add("" if item_id is None else str(item_id))
        out.append((doc_id, len(w), tuple(sorted(hit)), tuple(sorted(found))))
    return sorted(out, key=repr)


def operator(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"items": F.lit("x"), "spans": F.lit(1), "text_key": F.lit("k")}).repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate(d, b, **options).collect()
    return sorted(((r[0], r[1], tuple(p for s in r["spans"] for p in range(s["start"], s["end"])), tuple(r["items"])) for r in rows), key=repr)


@pytest.mark.parametrize("options", [{"window": 10}, {"window": 4, "shingle": 2}, {"window": 5, "block_bytes": 90}])
def test_random_texts_equal_a_plain_scan(spark, options):
    rng = random.Random(str(options))
    text = lambda n, k: " ".join(rng.choice("ab Xé 9 long-er Word".split()[:k]) + rng.choice([" ", ".", "\n"]) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 2, 5, 12, 30]), 5)) for i in range(12)] + [(3, text(14, 4)), (None, text(9, 5)), (99, None), (100, " , ")]
    docs = [(i, text(rng.choice([0, 3, 40, 200]), 5)) for i in range(25)] + [(1, None), (None, ""), (7, items[5][1] or "x")] * 2
    assert operator(spark, docs, items, **options) == plain(docs, items, options["window"])


def test_defined_cases(spark, nasty, nothing):
    items = [(1, "this very passage of more than fifty bytes stands in several documents of the table"), (2, "SAME same same"), (3, "x100 y3 x101 y4 x102 y5 x103 y6 x104 y7 x105"), (4, None)]
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    rows = decontaminate(nasty, benchmark).collect()
    docs = [(r["doc_id"], r["text"]) for r in nasty.select("doc_id", "text").collect()]
    got = sorted(((r[0], r[1], tuple(p for s in r["spans"] for p in range(s["start"], s["end"])), tuple(r["items"])) for r in rows), key=repr)
    assert got == plain(docs, items, 10)
    assert decontaminate(nothing, benchmark).count() == 0
    assert decontaminate(nasty, benchmark.limit(0)).filter("size(spans) > 0").count() == 0


def test_items_longer_than_a_piece(spark):
    words = [f"v{i}" for i in range(9000)]
    docs = [(1, " ".join(words[4090:4110])), (2, " ".join(words[8190:8199])), (3, " ".join(words))]
    assert operator(spark, docs, [(5, " ".join(words))]) == plain(docs, [(5, " ".join(words))], 10)


def test_query_digest(spark, sf_dir):
    from recordlink.llm.ops import op11

    rows = op11(spark, sf_dir).collect()
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = {d: (n, len(h), len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), bool(h)) for d, n, h, i in plain(docs, items, 10)}
    assert {r["doc_id"]: tuple(r)[1:] for r in rows} == want
    assert any(r["contaminated"] for r in rows)
