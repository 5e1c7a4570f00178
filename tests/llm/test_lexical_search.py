"""Ranked search against scores of every document for every item."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordlink.llm import lexical_search as ls

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_list(text):
    return WORD.findall((text or "").translate(UPPER))


def plain(docs, items, k):
    listed = [(d, Counter(word_list(t))) for d, t in docs]
    N, L = sum(1 for _, c in listed if c), sum(sum(c.values()) for _, c in listed)
    df = Counter(t for _, c in listed for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(word_list(text))
    out = []
    for item, terms in asked.items():
        scores = []
        for d, c in listed:
            m = 10 + (90 * sum(c.values()) * N) // max(1, L)
            s = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if c[t])
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def operator(docs, items, **options):
    return sorted((tuple(r) for r in ls.lexical_search(docs, items, **options).collect()), key=repr)


@pytest.mark.parametrize("options", [{"k": 10}, {"k": 3, "block_bytes": 300}])
def test_random_texts_equal_plain_scores(spark, monkeypatch, options):
    rng = random.Random(5)
    vocabulary = [f"t{i}" for i in range(60)] + ["é", "B", "c9"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    text = lambda n: " ".join(rng.choices(vocabulary, weights, k=n))
    docs = [(i, text(rng.choice([0, 1, 5, 30, 200]))) for i in range(400)]
    docs += [(1000 + i, docs[7][1] or "t1 t2") for i in range(150)] + [(None, "t1 t2 t3"), (3, None), (3, "t5 t5"), (3, "t5 t5")]
    items = [(i, text(rng.choice([0, 1, 3, 12]))) for i in range(20)] + [(2, "t40 t41"), (None, "t3 b"), (50, None), (51, "unknown"), (52, "C9 é")]
    d = spark.createDataFrame(docs, "doc_id int, text string").withColumns({c: F.lit("x") for c in ("rank", "score", "item", "m", "n", "head", "task")}).repartition(5)
    q = spark.createDataFrame(items, "item_id int, text string").withColumn("term", F.lit(1))
    assert operator(d, q, **options) == plain(docs, items, options["k"])


def test_defined_cases(spark, nasty, nothing):
    items = [(1, "w1 w2 w3 zz same"), (2, "naïve x100 one"), (3, "")]
    q = spark.createDataFrame(items, "item_id long, text string")
    docs = [(r["doc_id"], r["text"]) for r in nasty.select("doc_id", "text").collect()]
    assert operator(nasty, q) == plain(docs, items, 10)
    assert ls.lexical_search(nothing, q).count() == 0
    assert ls.lexical_search(nasty, q.limit(0)).count() == 0


def test_bounds_hold_and_prune():
    """Each subtree's bound is at least every score below it, and most leaves of a large trie are never scored."""
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 30, 5000)
    path = np.concatenate([np.sort(rng.choice(300, n, False, np.r_[np.full(20, 0.02), np.full(280, 0.6 / 280)])) for n in lengths])
    tf, m = rng.geometric(0.6, len(path)), rng.integers(20, 300, 5000)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    trie = ls.Trie(np.arange(5000), m, path.astype(np.uint32), tf.astype(np.uint32), offsets)
    terms, weights = np.array([2, 5, 100, 150, 299]), np.array([10, 20, 3000, 3500, 4000])
    scores = np.zeros(5000, np.int64)
    for d in range(5000):
        for j, t in enumerate(terms):
            at = trie.offsets[d] + np.flatnonzero(trie.path[trie.offsets[d] : trie.offsets[d + 1]] == t)
            scores[d] += sum(weights[j] * ls.gain(trie.tf[at], trie.m[d]))
    most = trie.maxima(terms)
    for node, (low, high) in enumerate(zip(trie.low, trie.high)):
        assert (weights * ls.gain(most[node], trie.least_m[node])).sum() >= scores[low:high].max()
    slot = np.full(300, -1, np.int64)
    calls = []
    plain_k_best = ls.k_best
    ls.k_best = lambda *a: calls.append(1) or plain_k_best(*a)
    try:
        got = trie.search(terms, weights, slot, (np.zeros(0, np.int64), np.zeros(0, np.int64)), 10)
    finally:
        ls.k_best = plain_k_best
    want = plain_k_best(scores, trie.ids, 10)
    assert [x.tolist() for x in got] == [x.tolist() for x in want] and (slot == -1).all()
    assert len(calls) < sum(1 for x in trie.last if not x) * 2 / 3
