"""Cross-tokenizer alignment by interval coalescing, and which id of one tokenizer most often ends where another's does.

Tokens of A (a byte-level BPE file) and B (a piece model) are intervals of the bytes of a blank and the text. All
intervals of both are sorted together by start, ends are accumulated as a running maximum, and a group breaks where a
start reaches it: there, and only there, tokens of both end together. Within a group the overlaps of A and B tokens are
expanded; those that also end together are the links.

Neither tokenizer joins anything across a blank that follows a non-blank, so a text is cut there, and each distinct
piece of a cell (about `CELL` characters of whole texts of one task) is encoded and aligned once. For a piece model with
pieces that run over such a blank, texts are not cut.
1. Cells give a row per document (its counts, the digest of its groups, its pieces by number) and one row with the
   pieces' links: id pairs and how many links of the cell hold them. These are written to the shared folder.
2. Pairs are counted over the corpus, and compared with the highest count of their B id.
3. The counts go back to the cells that hold the pairs, and are summed up per document there.
A pair that occurs everywhere is one row per cell, so no link of a single document is ever shuffled alone.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from recordlink.llm.packing import PATTERN, _byte_ranks
from recordlink.llm.scratch import keep
from recordlink.llm.textblock import group_starts
from recordlink.llm.wordindex import flat_ranges

CELL = 4 << 20
CACHE = 150_000
BLANK = "▁"
CUT = re.compile(r"(?<=\S)(?= )")
ROWS = "cell long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pieces binary, links binary"
PAIRS = "pairs array<struct<a:int,b:int,n:long>>"


def coalesce(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the intervals by start, and the positions in it at which a group begins."""
    order = np.lexsort((end, start))
    reach = np.maximum.accumulate(end[order]) if len(order) else end
    new = np.ones(len(order), bool)
    new[1:] = start[order][1:] >= reach[:-1]
    return order, np.flatnonzero(new)


class _Pieces(dict):
    """Piece of text -> its number, in order of appearance."""

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        return number


class Aligner:
    """Both tokenizers, with a bounded cache of the ids of short pieces."""

    def __init__(self, a_file: str, b_file: str):
        model = Tokenizer.from_file(a_file)
        specials = {t.content: i for i, t in model.get_added_tokens_decoder().items()}
        ranks = _byte_ranks(model, specials)
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]
        self.cuts = not any(BLANK in p.lstrip(BLANK) for p in pieces)
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        self.blank = array("I", [self.b.piece_to_id(BLANK)]).tobytes()
        self.cache: dict[str, tuple[bytes, bytes] | None] = {}
        text = {",": [f"{i}," for i in range(max(len(self.a_bytes), len(self.b_bytes)))]}
        text |= {c: [s[:-1] + c for s in text[","]] for c in "|;"}
        self.written = [*text[","], *text["|"], *text[";"]]
        self.width = len(text[","])

    def cut(self, text: str) -> list[str]:
        return CUT.split(" " + text) if self.cuts else [" " + text]

    def encode(self, pieces: list[str], times: np.ndarray | None = None) -> list[tuple[bytes, bytes] | None]:
        """Ids of each piece by A and by B as unsigned 32-bit numbers; None where their bytes are not those of the piece.

        Short pieces that stand `times` >= 3 are kept for the next cell.
        """
        if len(self.cache) > CACHE:
            self.cache.clear()
        cache = self.cache
        new = [p for p in pieces if p not in cache]
        kept = set() if times is None else {p for p, n in zip(pieces, times.tolist()) if n >= 3 and len(p) < 64}
        found: dict[str, tuple[bytes, bytes] | None] = {}
        for piece, b_ids in zip(new, self.b.encode([p[1:] for p in new], num_threads=1) if new else []):
            raw = piece.encode()
            a_ids = self.a.encode_ordinary(piece)
            b = self.blank if piece == " " else array("I", b_ids).tobytes()
            right = b"".join(map(self.a_bytes.__getitem__, a_ids)) == raw == b"".join(map(self.b_bytes.__getitem__, array("I", b)))
            found[piece] = (array("I", a_ids).tobytes(), b) if right else None
            if piece in kept:
                cache[piece] = found[piece]
        return [found[p] if p in found else cache[p] for p in pieces]

    def align(self, pieces: list[str], times: np.ndarray | None = None) -> Aligned:
        return Aligned(self, self.encode(pieces, times))


class Aligned:
    """Groups and links of a list of pieces, one after the other on one line of bytes."""

    def __init__(self, by: Aligner, ids: list[tuple[bytes, bytes] | None]):
        n = len(ids)
        self.valid = np.array([x is not None for x in ids], bool)
        a, b = (np.frombuffer(b"".join(x[side] for x in ids if x), "<u4").astype(np.int64) for side in (0, 1))
        self.n_a, self.n_b = (np.array([len(x[side]) // 4 if x else 0 for x in ids], np.int64) for side in (0, 1))
        a_end, b_end = np.cumsum(by.a_sizes[a]), np.cumsum(by.b_sizes[b])
        start, end = np.concatenate([a_end - by.a_sizes[a], b_end - by.b_sizes[b]]), np.concatenate([a_end, b_end])
        is_b = np.concatenate([np.zeros(len(a), bool), np.ones(len(b), bool)])
        token = np.concatenate([a, b])
        piece = np.concatenate([np.repeat(np.arange(n), self.n_a), np.repeat(np.arange(n), self.n_b)])
        order, first = coalesce(start, end)
        group = np.zeros(len(order), np.int64)
        group[first[1:]] = 1
        group = np.cumsum(group)
        self.n_groups = np.bincount(piece[order[first]], minlength=n) if len(first) else np.zeros(n, np.int64)
        # overlaps of the A and B tokens of a group, of which links end together
        group_of = np.empty(len(order), np.int64)
        group_of[order] = group
        a_group, b_group = group_of[: len(a)], group_of[len(a) :]
        low = np.maximum(np.searchsorted(b_end, a_end - by.a_sizes[a], "right"), np.searchsorted(b_group, a_group))
        high = np.minimum(np.searchsorted(b_end - by.b_sizes[b], a_end), np.searchsorted(b_group, a_group, "right"))
        left, right = np.repeat(np.arange(len(a)), high - low), flat_ranges(low, high - low)
        together = a_end[left] == b_end[right]
        left, right = left[together], right[together]
        self.link_a, self.link_b = a[left], b[right]
        self.n_links = np.bincount(piece[: len(a)][left], minlength=n)
        # the groups in writing: A ids, then B ids, in each group
        by_side = np.lexsort((is_b[order], group))
        token, side, group = token[order][by_side], is_b[order][by_side], group[by_side]
        mark = np.zeros(len(token), np.int64)
        if len(token):
            last = np.append(group[1:] != group[:-1], True)
            mark[np.append((side[1:] != side[:-1]) & ~last[:-1], False)] = 1
            mark[last] = 2
        words = list(map(by.written.__getitem__, (token + mark * by.width).tolist()))
        edges = np.cumsum(self.n_a + self.n_b).tolist()
        self.groups = ["".join(words[s:e]) for s, e in zip([0, *edges[:-1]], edges)]


_LOADED: dict[tuple[str, str], Aligner] = {}


def _aligner(a_file: str, b_file: str) -> Aligner:
    key = (a_file, b_file)
    return _LOADED.get(key) or _LOADED.setdefault(key, Aligner(*key))


def token_groups(docs: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """(doc_id, groups): the groups of each text as `a1,a2|b1;a3|b2,b3`, '' for a text without tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = _aligner(a_file, b_file)
        for batch in batches:
            out = []
            for text in batch["text"].to_pylist():
                made = by.align(by.cut(text)) if text else None
                out.append("".join(made.groups)[:-1] if made and made.valid.all() else "")
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(out, pa.string())], ["doc_id", "groups"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, groups string")


def _cell_rows(docs: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """Rows of documents and, for each cell, one row with `pairs` and `links`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = _aligner(a_file, b_file)
        cell = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                text = text.as_py() or ""
                held.append((doc_id, text))
                size += len(text)
                if size >= CELL:
                    yield from _cell(by, cell, held)
                    cell, held, size = cell + 1, [], 0
        if held:
            yield from _cell(by, cell, held)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, f"{ROWS}, {PAIRS}")


def _cell(by: Aligner, cell: int, held: list[tuple[int | None, str]]) -> Iterator[pa.RecordBatch]:
    number = _Pieces()
    listed = [np.fromiter(map(number.__getitem__, by.cut(text)), np.int64) if text else np.zeros(0, np.int64) for _, text in held]
    made = by.align(list(number), np.bincount(np.concatenate([*listed, np.zeros(0, np.int64)]), minlength=len(number)))
    good = [bool(made.valid[x].all()) and len(x) > 0 for x in listed]
    listed = [x if ok else x[:0] for x, ok in zip(listed, good)]
    flat = np.concatenate([*listed, np.zeros(0, np.int64)])
    times = np.bincount(flat, minlength=len(number))
    pair_key = made.link_a << 32 | made.link_b
    keys, pair = np.unique(pair_key, return_inverse=True)
    link_from = np.cumsum(made.n_links) - made.n_links
    counted = np.bincount(pair, weights=np.repeat(times, made.n_links), minlength=len(keys)).astype(np.int64)
    digests = []
    for x, ok in zip(listed, good):
        text = "".join(map(made.groups.__getitem__, x.tolist()))[:-1]
        digests.append(hashlib.sha256(text.encode()).hexdigest() if ok else "")
    sums = [np.array([int(c[x].sum()) for x in listed], np.int64) for c in (made.n_a, made.n_b, made.n_groups, made.n_links)]
    kinds = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())]))
    n = len(held)
    names = ["cell", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pieces", "links", "pairs"]
    rows = [pa.array(np.full(n, cell)), pa.array([d for d, _ in held], pa.int64()), *map(pa.array, sums), pa.array(digests, pa.string())]
    rows += [pa.array(list(map(_packed, listed)), pa.binary()), pa.nulls(n, pa.binary()), pa.nulls(n, kinds)]
    yield pa.RecordBatch.from_arrays(rows, names)
    edges = np.append(link_from, len(pair)).astype("<u4").tobytes()
    found = pa.StructArray.from_arrays([pa.array((keys >> 32).astype(np.int32)), pa.array((keys & 0xFFFFFFFF).astype(np.int32)), pa.array(counted)], fields=list(kinds.value_type))
    pairs = pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), found)
    none = pa.nulls(1, pa.int64())
    one = [pa.array([cell]), none, none, none, none, none, pa.nulls(1, pa.string()), pa.array([edges], pa.binary()), pa.array([pair.astype("<u4").tobytes()], pa.binary()), pairs.cast(kinds)]
    yield pa.RecordBatch.from_arrays(one, names)


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers in any order: steps of the sorted numbers in two bytes each where all fit, else in four."""
    steps = np.diff(np.sort(numbers), prepend=0)
    kind = "<u2" if not len(steps) or steps.max() < 1 << 16 else "<u4"
    return kind[2].encode() + steps.astype(kind).tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(packed, f"<u{packed[:1].decode()}", offset=1), dtype=np.int64)


def _answered(rows: pa.Table, answers: pa.Table) -> pa.Table:
    """Sums per document of one cell: its pieces' links, looked up in the corpus counts of the cell's pairs."""
    is_doc = np.asarray(rows["links"].is_null())
    docs = rows.filter(pa.array(is_doc))
    if docs.num_rows < rows.num_rows:
        held = rows.filter(pa.array(~is_doc))
        edges, pair = (np.frombuffer(held[c][0].as_py(), "<u4").astype(np.int64) for c in ("pieces", "links"))
    else:
        edges, pair = np.zeros(1, np.int64), np.zeros(0, np.int64)
    key = np.asarray(answers["a"]).astype(np.int64) << 32 | np.asarray(answers["b"])
    order = np.argsort(key, kind="stable")
    listed = list(map(_unpacked, docs["pieces"].to_pylist()))
    totals = []
    for column in ("best", "count"):
        per_link = np.asarray(answers[column]).astype(np.int64)[order][pair]
        before = np.concatenate([[0], np.cumsum(per_link)])
        per_piece = np.diff(before[edges])
        totals.append(pa.array([int(per_piece[x].sum()) for x in listed], pa.int64()))
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    return pa.table([*(docs[c] for c in kept), *totals, docs["groups_sha256"]], [*kept, "n_best", "count_sum", "groups_sha256"])


def align_tokens(docs: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per document.

    A link is a pair of an A and a B token that end at the same byte; no token is empty, so there is one per group. The
    count of an id pair is the number of links of the corpus that hold it: `count_sum` adds it up over the document's
    links, `n_best` counts the links whose count is the highest of their B id. `token_groups` gives the groups themselves.

    Defined cases: a null or empty text, and one whose tokens do not give its bytes back, has no tokens: zeros and ''.
    Rows that repeat an id or a text are counted each; a null id is kept; special tokens are ordinary text; a text of any
    length is encoded whole; other columns are ignored; an empty table gives an empty result.
    """
    kept = keep(_cell_rows(docs, a_file, b_file), "alignment")
    asked = kept.filter(F.col("links").isNotNull()).select(F.col("cell").alias("at"), F.inline("pairs"))
    counts = asked.groupBy("a", "b").agg(F.sum("n").alias("count"))
    top = F.max("count").over(Window.partitionBy("b"))
    scored = counts.withColumn("best", (F.col("count") == top).cast("long"))
    answers = asked.select("at", "a", "b").join(scored, ["a", "b"]).select("at", "a", "b", "count", "best")
    rows = kept.select("cell", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pieces", "links")
    out = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return rows.groupBy("cell").cogroup(answers.groupBy("at")).applyInArrow(_answered, out)
