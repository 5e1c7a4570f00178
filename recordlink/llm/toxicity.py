"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence has a logistic score over hashed features (its words and their first four,
five and six bytes, so that inflected forms share weight); a document is toxic if any sentence is, so sentence scores
combine by noisy-or: p = 1 - prod(1 - p_s). Only document labels are needed: the gradient of the noisy-or gives each
sentence its share of the blame. The same sentence scores then locate the offending sentences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlink.llm.labelled import held_out, train
from recordlink.llm.textblock import fold_table, hash_ranges, row_slices, runs, text_bytes

BITS = 21
PREFIXES = (4, 5, 6)
STEPS, RATE, SHRINK, RARE, DROP = 20, 0.5, 1e-4, 5, 0.5
_NOT_LETTERS = bytes(b for b in range(128) if not chr(b).isalpha())
FOLD, LETTER = fold_table(_NOT_LETTERS)
BREAK = np.zeros(256, bool)
BREAK[np.frombuffer(b".!?\n", np.uint8)] = True


def sentence_features(data: np.ndarray, offsets: np.ndarray):
    """Feature ids (words x kinds), sentence of each word, and rows, starts and ends of the sentences (bytes).

    Every row has at least one sentence, an empty one if need be.
    """
    starts, ends = runs(~BREAK[data], offsets)
    rows = np.searchsorted(offsets, starts, "right") - 1
    lonely = np.setdiff1d(np.arange(len(offsets) - 1), rows)
    starts, ends, rows = (np.concatenate(x) for x in ((starts, offsets[lonely]), (ends, offsets[lonely]), (rows, lonely)))
    order = np.lexsort((starts, rows))
    starts, ends, rows = starts[order], ends[order], rows[order]
    w_start, w_end = runs(LETTER[data], offsets)
    folded = FOLD[data]
    real = np.flatnonzero(ends > starts)
    sentence = real[np.searchsorted(starts[real], w_start, "right") - 1] if len(w_start) else np.zeros(0, np.int64)
    kinds = [hash_ranges(folded, w_start, w_end)]
    for k in PREFIXES:
        long_enough = w_end - w_start >= k
        value = hash_ranges(folded, w_start, np.minimum(w_end, w_start + k)) * np.uint64(2 * k + 1)
        kinds.append(np.where(long_enough, value, kinds[0]))
    ids = (np.stack(kinds, 1) >> np.uint64(64 - BITS)).astype(np.int32) if len(w_start) else np.zeros((0, 1 + len(PREFIXES)), np.int32)
    return ids, sentence, rows, starts, ends


def featurise(texts: pa.Array) -> tuple[list[bytes], list[bytes]]:
    """Per document: feature ids, and the number of words of each sentence."""
    data, offsets = text_bytes(texts)
    ids_of, counts_of = [], []
    for a, b in row_slices(offsets):
        ids, sentence, rows, *_ = sentence_features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        counts = np.bincount(sentence, minlength=len(rows)).astype(np.int32)
        first = np.searchsorted(rows, np.arange(b - a + 1))
        words = np.concatenate([[0], np.cumsum(counts)])[first]
        for i in range(b - a):
            ids_of.append(ids[words[i] : words[i + 1]].tobytes())
            counts_of.append(counts[first[i] : first[i + 1]].tobytes())
    return ids_of, counts_of


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    edges = np.concatenate([[0], np.cumsum(counts)])
    total = np.concatenate([[0.0], np.cumsum(values)])
    return total[edges[1:]] - total[edges[:-1]]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(y: np.ndarray, ids_of: list[bytes], counts_of: list[bytes]) -> np.ndarray:
    """Weights, the bias last. Small batches in the given order, per-weight step sizes.

    Each pass hides a share of the words (seeded, so every run fits the same weights): otherwise the first telling word
    of a document takes all the blame and the others stay weak.
    """
    kinds = 1 + len(PREFIXES)
    weights = np.zeros((1 << BITS) + 1)
    weights[-1] = -5.0
    if not len(y):
        return weights
    seen = np.zeros(1 << BITS, np.int32)
    bags = [np.frombuffer(x, np.int32) for x in ids_of]
    sizes = [np.frombuffer(x, np.int32) for x in counts_of]
    for bag in bags:
        seen[np.unique(bag)] += 1
    known = np.append(seen >= RARE, True)  # a feature of one or two documents tells nothing
    grads = np.full(len(weights), 1e-3)
    chance = np.random.default_rng(1)
    for _ in range(STEPS):
        for at in range(0, len(y), 256):
            part = range(at, min(at + 256, len(y)))
            ids, words = np.concatenate([bags[i] for i in part]), np.concatenate([sizes[i] for i in part])
            per_doc = np.array([len(sizes[i]) for i in part])
            shown = np.repeat(chance.random(len(ids) // kinds) >= DROP, kinds)
            z = _sums(weights[ids] * shown, words * kinds) + weights[-1]
            p_s = _sigmoid(z)
            p = 1 - np.exp(_sums(np.log1p(-np.minimum(p_s, 1 - 1e-9)), per_doc))
            blame = np.where(y[at : at + 256] == 1, (1 - p) / np.maximum(p, 1e-9), -1.0)
            g_s = p_s * np.repeat(blame, per_doc)
            g = np.append(np.bincount(ids, np.repeat(g_s, words * kinds) * shown, minlength=1 << BITS), g_s.sum())
            touched = np.flatnonzero((g != 0) & known)
            step = g[touched] / len(part) - SHRINK * weights[touched] * (touched < (1 << BITS))
            grads[touched] += step**2
            weights[touched] += RATE * step / np.sqrt(grads[touched])
    return weights


def score_toxicity(docs: DataFrame, labels: DataFrame, bound: int = 12_000, threshold: float = 0.5, target: str = "toxic") -> DataFrame:
    """`docs` with `held_out`, `score`, `predicted` and `offending`, the sentences that score at least `threshold`
    alone (start and end in UTF-8 bytes, score).

    Only the text is an input of the score. Defined cases: a null or empty text is one empty sentence and gets the
    score of the bias; without any usable label the score is that of the start bias; a null id is not held out; rows
    that repeat an id are scored each on its own; columns named like the added ones are replaced; an empty table gives
    an empty result. A text without sentence ends is one sentence.
    """
    weights = train(docs, labels, target, bound, featurise, fit).astype(np.float64)
    docs = docs.drop("held_out", "score", "predicted", "offending")
    names = docs.columns
    spans = "array<struct<start:bigint,end:bigint,score:double>>"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch["text"])
            for a, b in row_slices(offsets):
                ids, sentence, rows, starts, ends = sentence_features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                z = np.bincount(sentence, weights[ids].sum(1), minlength=len(rows)) + weights[-1]
                p_s = _sigmoid(z)
                log_clean = np.bincount(rows, np.log1p(-np.minimum(p_s, 1 - 1e-12)), minlength=b - a)
                p = np.clip(1 - np.exp(log_clean), 0, 1)
                hit = np.flatnonzero((p_s >= threshold) & (ends > starts))
                where = np.searchsorted(rows[hit], np.arange(b - a + 1)).astype(np.int32)
                base = (offsets[a:b] - offsets[a])[rows[hit]]
                found = pa.StructArray.from_arrays([pa.array(starts[hit] - base), pa.array(ends[hit] - base), pa.array(p_s[hit])], ["start", "end", "score"])
                own = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array(p), pa.array((p >= threshold).astype(np.int32)), pa.ListArray.from_arrays(pa.array(where), found)],
                    [*names, "score", "predicted", "offending"],
                )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    scored = docs.mapInArrow(score, f"{kinds}, score double, predicted int, offending {spans}")
    return scored.withColumn("held_out", held_out(F.col("doc_id")))
