"""Alignment against whole texts encoded by the tokenizers' own libraries, and counts taken link by link."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from recordlink.llm import alignment

A_FILE, B_FILE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def token_bytes(a, b):
    plain = [x for x in range(256) if 33 <= x <= 126 or 161 <= x <= 172 or 174 <= x <= 255]
    byte = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in plain)}

    def of_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    return (lambda i: bytes(byte[c] for c in a.id_to_token(i))), of_b


def plain(docs):
    a, b = Tokenizer.from_file(A_FILE), sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    a.encode_special_tokens = True
    a_of, b_of = token_bytes(a, b)
    found, counts = [], Counter()
    for doc_id, text in docs:
        if not text:
            found.append((doc_id, 0, 0, [], []))
            continue
        ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        parts = [a_of(i) for i in ids[0]], [b_of(i) for i in ids[1]]
        if not b"".join(parts[0]) == b"".join(parts[1]) == (" " + text).encode():
            found.append((doc_id, 0, 0, [], []))
            continue
        ends = []
        for side in parts:
            at, those = 0, []
            for x in side:
                at += len(x)
                those.append(at)
            ends.append(those)
        both = sorted(set(ends[0]) & set(ends[1]))
        groups, links, i, j = [], [], 0, 0
        for e in both:
            k, m = ends[0].index(e, i) + 1, ends[1].index(e, j) + 1
            groups.append(",".join(map(str, ids[0][i:k])) + "|" + ",".join(map(str, ids[1][j:m])))
            links.append((ids[0][k - 1], ids[1][m - 1]))
            i, j = k, m
        counts.update(links)
        found.append((doc_id, len(ids[0]), len(ids[1]), groups, links))
    best = Counter()
    for (x, y), n in counts.items():
        best[y] = max(best[y], n)
    rows = []
    for doc_id, n_a, n_b, groups, links in found:
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        rows.append((doc_id, n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), digest))
    return sorted(rows, key=repr), sorted(((d, ";".join(g)) for d, _, _, g, _ in found), key=repr)


def check(docs):
    rows, groups = plain([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert sorted((tuple(r) for r in alignment.align_tokens(docs, A_FILE, B_FILE).collect()), key=repr) == rows
    assert sorted((tuple(r) for r in alignment.token_groups(docs, A_FILE, B_FILE).collect()), key=repr) == groups


def test_hard_texts(spark, nothing):
    rng = random.Random(2)
    bits = [" ", "  ", "   ", "\n", "\t ", " ", "　 ", "a", "The", "ing", "é", "é", "日本", "🙂", "'s", "12345", "...", "<|endoftext|>", "<s>", "</s>", "<0x41>", "\x00", "\x1c ", " ", "ﬁ", "naïve"]
    docs = [(i, "".join(rng.choices(bits, k=rng.choice([1, 2, 3, 8, 40])))) for i in range(700)]
    docs += [(1000 + i, t) for i, t in enumerate([" ", "  ", "a ", " a", "a  ", "\n", "\n ", " \n a", "a \n b ", "a▁b", "▁", " ▁", "x" * 5000, "日" * 3000])]
    docs += [(None, "a b c"), (3, None), (3, ""), (3, "a b"), (3, "a b")]
    d = spark.createDataFrame(docs, "doc_id int, text string").withColumns({c: F.lit("x") for c in ("a", "b", "cell", "pieces", "links", "count", "best")})
    check(d.repartition(3))
    assert alignment.align_tokens(nothing, A_FILE, B_FILE).count() == 0


def test_many_cells(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(alignment, "CELL", 4000)
    monkeypatch.setattr(alignment, "CACHE", 50)
    check(spark.read.parquet(f"{sf_dir}/documents.parquet").filter("n_chars < 4000").repartition(2))


def test_nasty(nasty):
    check(nasty.filter("text is null or length(text) < 100000"))
    long = alignment.align_tokens(nasty, A_FILE, B_FILE).filter("doc_id in (5, 19, 21)")
    assert {r["doc_id"]: r["n_links"] > 1000 for r in long.collect()} == {5: True, 19: True, 21: True}
