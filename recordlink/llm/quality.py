"""Quality: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader.

Tokens are runs of letters or digits and runs of other marks, in their own case. A document's features are the hashed
one- and two-grams of its tokens, and one- to three-grams of their shapes (lower, upper or capitalised word, number,
the marks themselves, a repeat of the word before), each weighted by log(1 + count) and scaled to length 1. A score is
the logistic of a sparse dot product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlink.llm.labelled import held_out, train
from recordlink.llm.textblock import group_starts, hash_ranges, mix, row_slices, runs, text_bytes

BITS = 18
ALPHA, BETA, L1, L2, PASSES = 0.3, 1.0, 0.02, 0.1, 4
CLASS = np.full(256, 2, np.uint8)  # 0 white space, 1 word, 2 mark
CLASS[[9, 10, 11, 12, 13, 32]] = 0
for _low, _high in ((48, 57), (65, 90), (97, 122), (128, 255)):
    CLASS[_low : _high + 1] = 1
IS_UPPER = np.zeros(256, bool)
IS_UPPER[65:91] = True
IS_DIGIT = np.zeros(256, bool)
IS_DIGIT[48:58] = True


def tokens(data: np.ndarray, offsets: np.ndarray):
    """Row, fingerprint and shape of every token, in order."""
    kind = CLASS[data]
    word, mark = runs(kind == 1, offsets), runs(kind == 2, offsets)
    starts, ends = np.concatenate([word[0], mark[0]]), np.concatenate([word[1], mark[1]])
    is_word = np.concatenate([np.ones(len(word[0]), bool), np.zeros(len(mark[0]), bool)])
    order = np.argsort(starts, kind="stable")
    starts, ends, is_word = starts[order], ends[order], is_word[order]
    value = hash_ranges(data, starts, ends)
    rows = np.searchsorted(offsets, starts, "right") - 1
    if not len(starts):
        return rows, value, value
    upper = np.concatenate([[0], np.cumsum(IS_UPPER[data])])
    n_upper = upper[ends] - upper[starts]
    shape = np.full(len(starts), 1, np.uint64)
    shape[n_upper > 0] = 2
    shape[(n_upper == 1) & IS_UPPER[data[starts]]] = 3
    shape[(n_upper > 1) & (n_upper * 2 > ends - starts)] = 4
    shape[IS_DIGIT[data[starts]]] = 5
    shape = np.where(is_word, mix(shape), value)
    shape[1:][(value[1:] == value[:-1]) & (rows[1:] == rows[:-1])] = 6
    return rows, value, shape


def features(data: np.ndarray, offsets: np.ndarray):
    """Row, feature id and value of every distinct feature, by row and feature."""
    rows, value, shape = tokens(data, offsets)
    parts = []
    for base, length, salt in ((value, 2, 11), (shape, 3, 29)):
        gram = mix(base + np.uint64(salt))
        parts.append((rows, gram))
        for k in range(1, length):
            gram = mix(gram[:-1] * np.uint64(0x9E3779B97F4A7C15) + base[k:] + np.uint64(salt * (k + 1)))
            inside = rows[k:] == rows[: len(rows) - k]
            parts.append((rows[k:][inside], gram[inside]))
    row = np.concatenate([p[0] for p in parts])
    feature = (np.concatenate([p[1] for p in parts]) >> np.uint64(64 - BITS)).astype(np.int64)
    key = np.sort((row << BITS) | feature)
    first = group_starts(key)
    counts = np.diff(np.append(first, len(key)))
    key = key[first]
    row, feature, weight = key >> BITS, key & ((1 << BITS) - 1), np.log1p(counts)
    length = np.sqrt(np.bincount(row, weight**2, minlength=len(offsets) - 1))
    return row, feature, weight / length[row]


def featurise(texts: pa.Array) -> tuple[list[bytes], list[bytes]]:
    data, offsets = text_bytes(texts)
    ids, values = [], []
    for a, b in row_slices(offsets):
        row, feature, weight = features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        edges = np.searchsorted(row, np.arange(b - a + 1))
        for i in range(b - a):
            ids.append(feature[edges[i] : edges[i + 1]].astype(np.int32).tobytes())
            values.append(weight[edges[i] : edges[i + 1]].astype(np.float32).tobytes())
    return ids, values


def fit(y: np.ndarray, ids_of: list[bytes], values_of: list[bytes]) -> np.ndarray:
    """FTRL-proximal, one document at a time in the given order; the bias is the last weight."""
    n_weights = (1 << BITS) + 1
    z, n, w = np.zeros(n_weights), np.zeros(n_weights), np.zeros(n_weights)
    ids = [np.append(np.frombuffer(x, np.int32), 1 << BITS) for x in ids_of]
    values = [np.append(np.frombuffer(x, np.float32), 1.0).astype(np.float64) for x in values_of]
    for _ in range(PASSES):
        for i in range(len(y)):
            at, x = ids[i], values[i]
            zi, ni = z[at], n[at]
            wi = np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))
            p = 1 / (1 + np.exp(-np.clip(wi @ x, -30, 30)))
            g = (p - y[i]) * x
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA
            z[at] += g - sigma * wi
            n[at] += g * g
    w = np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    return w


def score_quality(docs: DataFrame, labels: DataFrame, bound: int = 12_000, threshold: float = 0.3, target: str = "quality") -> DataFrame:
    """`docs` with `held_out`, `score` and `predicted` (score >= threshold).

    Only the text is an input of the score. Defined cases: a null or empty text has no feature and gets the score of
    the bias; a text of any length is scored whole; without any usable label every score is 0.5; a null id is not held out; rows that repeat an id are scored
    each on its own; columns named like the added ones are replaced; an empty table gives an empty result.
    """
    weights = train(docs, labels, target, bound, featurise, fit).astype(np.float64)
    docs = docs.drop("held_out", "score", "predicted")
    names = docs.columns

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch["text"])
            for a, b in row_slices(offsets):
                row, feature, value = features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                z = np.bincount(row, weights[feature] * value, minlength=b - a) + weights[-1]
                p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                own = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(p), pa.array((p >= threshold).astype(np.int32))], [*names, "score", "predicted"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    scored = docs.mapInArrow(score, f"{kinds}, score double, predicted int")
    return scored.withColumn("held_out", held_out(F.col("doc_id")))
