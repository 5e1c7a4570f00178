"""Secret scans with multipart credential linking.

Strong kinds are reported wherever they stand. A credential often comes in parts, an access identifier, a secret and an
endpoint, that are weak evidence alone: an interval join inside each document links parts whose spans, widened by the
reach of a scope, meet, and a weak part is reported only when its complements are linked to it: an identifier needs a
secret; a secret needs an identifier or an endpoint; an endpoint needs a secret. A secret that lies in a URL, which
would be its own endpoint, is linked through identifiers only. Parts have no greatest length. A scope is a paragraph
(between blank lines), and at most `reach` bytes wide. The join works on sorted span ends, so its cost follows the
number of spans, and a document needs no shuffle.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from recordlink.llm.textblock import row_slices, runs, text_bytes

# The strong patterns, their least lengths and the order of kinds.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 8, 16, 32
KINDS = ("assign", "access", "hex", "id", "key", "endpoint")

ASSIGN_HINTS = (b"passw", b"secret", b"token", b"api")
ID_HINTS = (b"access", b"client", b"account", b"user", b"login")
WEAK_ID = re.compile(rb"""(?:access_?key(?:_?id)?|client_?id|account_?(?:id|name)|user_?name|user|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{3,})""", re.I)
WEAK_KEY = re.compile(rb"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/]{24,}={0,2}(?![A-Za-z0-9+/=_-])")
ENDPOINT = re.compile(rb"https?://[A-Za-z0-9.-]+(?::[0-9]{1,5})?(?:/[^\s\"'<>]*)?")
BLANK = re.compile(rb"\n[ \t\r]*\n")
IS_HEX = np.zeros(256, bool)
IS_HEX[48:58] = IS_HEX[97:103] = True


def _varied(word: bytes) -> bool:
    """Looks like a random key: digits and both cases."""
    return any(48 <= b < 58 for b in word) and any(65 <= b < 91 for b in word) and any(97 <= b < 123 for b in word)


def linked(a: list[tuple[int, int]], b: list[tuple[int, int]], reach: int, breaks: list[int]) -> np.ndarray:
    """Interval join: whether each span of `a` has a span of `b` within reach in the same paragraph."""
    if not a or not b:
        return np.zeros(len(a), bool)
    left, right = np.array(a), np.sort(np.array(b), axis=0)  # starts and ends each in order, as spans of two kinds may overlap
    scope_end = np.append(breaks, np.iinfo(np.int64).max)
    scope_start = np.concatenate([[0], breaks])
    scope = np.searchsorted(np.array(breaks, np.int64), left[:, 0], "right")
    low = np.maximum(left[:, 0] - reach, scope_start[scope])
    high = np.minimum(left[:, 1] + reach, scope_end[scope])
    return np.searchsorted(right[:, 0], high, "left") > np.searchsorted(right[:, 1], low, "right")


def _clear_of(taken: list[tuple[int, int]]):
    """Whether a span meets none of the spans in `taken`."""
    taken = sorted(taken)
    starts, ends = [s for s, _ in taken], np.maximum.accumulate([e for _, e in taken]) if taken else []

    def free(span: tuple[int, int]) -> bool:
        at = int(np.searchsorted(starts, span[1], "left"))
        return at == 0 or ends[at - 1] <= span[0]

    return free


def scan(text: bytes, hexes: list[tuple[int, int]], reach: int) -> dict[str, list[tuple[int, int]]]:
    """Spans of each kind in one text, in bytes."""
    low = text.lower()
    found: dict[str, list[tuple[int, int]]] = {"hex": hexes}
    if any(h in low for h in ASSIGN_HINTS):
        found["assign"] = [m.span() for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if b"AKIA" in text:
        found["access"] = [m.span() for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    weak_ids = [m.span(1) for m in WEAK_ID.finditer(text)] if any(h in low for h in ID_HINTS) else []
    strong_ids, strong_keys = found.get("access", []), found.get("assign", []) + hexes
    endpoints = [m.span() for m in ENDPOINT.finditer(text)] if b"://" in text else []
    if not weak_ids and not strong_ids and not endpoints:
        return found
    free = _clear_of(strong_ids + strong_keys)
    breaks = [m.start() for m in BLANK.finditer(text)]
    weak_ids = [s for s in weak_ids if free(s)]
    weak_keys = [m.span() for m in WEAK_KEY.finditer(text) if _varied(m[0]) and free(m.span())]
    ids, keys = strong_ids + weak_ids, strong_keys + weak_keys
    outside = _clear_of(endpoints)
    apart = [s for s in keys if outside(s)]
    beside = {s for s, ok in zip(apart, linked(apart, endpoints, reach, breaks)) if ok}
    found["id"] = [s for s, ok in zip(weak_ids, linked(weak_ids, keys, reach, breaks)) if ok]
    found["key"] = [s for s, ok in zip(weak_keys, linked(weak_keys, ids, reach, breaks)) if ok or s in beside]
    both = linked(endpoints, ids, reach, breaks) & linked(endpoints, keys, reach, breaks)
    found["endpoint"] = [s for s, ok in zip(endpoints, both | linked(endpoints, apart, reach, breaks)) if ok]
    return found


def _text_of(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def scan_secrets(docs: DataFrame, reach: int = 400) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked), one row per row of `docs`.

    Spans are kind:start:end in code points, end exclusive, by start and then kind. Strong kinds: assign, access, hex;
    linked weak ones: id, key, endpoint (never overlapping strong ids or keys in the case of id and key).

    Defined cases: a null text is empty and has no span; a null id is returned as it is; rows that repeat an id are
    scanned each on its own; texts and spans of any length are read whole; other columns are ignored; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch["text"])
            counts, digests, all_spans, weak = np.zeros((batch.num_rows, 3), np.int64), [], [], []
            for a, b in row_slices(offsets):
                part, edges = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                h_start, h_end = runs(IS_HEX[part], edges)
                long_runs = h_end - h_start >= MIN_HEX
                h_start, h_end = h_start[long_runs], h_end[long_runs]
                where = np.searchsorted(h_start, edges)
                block = part.tobytes()
                for i in range(b - a):
                    text = block[edges[i] : edges[i + 1]]
                    hexes = [(int(s - edges[i]), int(e - edges[i])) for s, e in zip(h_start[where[i] : where[i + 1]], h_end[where[i] : where[i + 1]])]
                    found = scan(text, hexes, reach)
                    spans = [(s, KINDS.index(kind), e) for kind, those in found.items() for s, e in those]
                    if spans and not text.isascii():
                        points = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
                        spans = [(int(points[s]), k, int(points[e])) for s, k, e in spans]
                    base = [s for s in spans if s[1] < 3]
                    counts[a + i] = [len(found.get(kind, ())) for kind in KINDS[:3]]
                    digests.append(hashlib.sha256(_text_of(base).encode()).hexdigest())
                    all_spans.append(_text_of(spans))
                    weak.append(len(spans) - len(base))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *(pa.array(counts[:, k]) for k in range(3)), pa.array(digests, pa.string()), pa.array(all_spans, pa.string()), pa.array(weak, pa.int64())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_linked"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_linked long"
    )
