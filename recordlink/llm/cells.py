"""Cells: pieces of a document table that one task can hold, and questions between them.

Documents are dealt once into cells of about `CELL_BYTES` of text. A pass over the cells turns each into packed rows of
fingerprints, one row per (cell, bucket); buckets are merged where all cells meet, and the answers go back to the cells
as packed rows in the same order. Equal values of a cell are one entry where a pass merges them before packing, and a
bucket takes all entries of its values: a hot value costs its bucket an entry for each cell that holds it. All passes of one job read the same exchange of the text.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CELL_BYTES = 8 << 20
PACKED = "bucket int, cell int, a binary, b binary"
ANSWERS = "cell int, bucket int, kind int, answer binary"


def cell_count(docs: DataFrame, cell_bytes: int = CELL_BYTES) -> int:
    """Cells for all the text there is; small tables still give every core some."""
    return cells_for(docs.sparkSession, docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0, cell_bytes)


def cells_for(spark: SparkSession, total: int, cell_bytes: int = CELL_BYTES) -> int:
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, math.ceil(total / cell_bytes), min(width, math.ceil(total / (256 << 10))))


def bucket_count(n_cells: int) -> int:
    return max(1, math.ceil(n_cells / 2))


def dealt(docs: DataFrame, cell: Column, n_cells: int) -> DataFrame:
    """The documents with their `cell`, each cell whole in one partition; every pass reuses this exchange."""
    return docs.withColumn("cell", cell.cast("int")).repartition(n_cells, "cell")


def range_cell(docs: DataFrame, n_cells: int) -> Column:
    """Cells that are ranges of doc_id: all rows of a smaller cell have smaller ids. Null ids go to cell 0."""
    steps = [i / n_cells for i in range(1, n_cells)]
    found = docs.agg(F.percentile_approx("doc_id", steps, max(10_000, 20 * n_cells)).alias("b")).first()["b"] if steps else None
    bounds = sorted(set(found or []))
    if not bounds:
        return F.lit(0)
    n, array = len(bounds), F.lit(bounds).cast("array<bigint>")
    halves = [1 << i for i in range(n.bit_length() - 1, -1, -1)]

    def step(at: Column, s: Column) -> Column:
        return F.when((at + s <= n) & (F.element_at(array, F.least(at + s, F.lit(n))) <= F.col("doc_id")), at + s).otherwise(at)

    return F.aggregate(F.lit(halves).cast("array<int>"), F.lit(0), step)


def pack(cell: int, bucket: np.ndarray, n_buckets: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, pa.Table]:
    """Order of the entries by bucket, and one packed row per bucket that has any."""
    order = np.argsort(bucket.astype(np.uint16 if n_buckets <= 1 << 16 else np.uint32), kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
    full = np.flatnonzero(np.diff(edges))
    a, b = a[order], b[order]
    return order, pa.table(
        {
            "bucket": pa.array(full.astype(np.int32)),
            "cell": pa.array(np.full(len(full), cell, np.int32)),
            "a": pa.array([a[edges[i] : edges[i + 1]].tobytes() for i in full], pa.binary()),
            "b": pa.array([b[edges[i] : edges[i + 1]].tobytes() for i in full], pa.binary()),
        }
    )


def ask(packed: DataFrame, merge: Callable, a_type: str, b_type: str, kind: int) -> DataFrame:
    """Answers of `merge(a, b, cell of each entry)`, one byte or number per entry, packed as the questions were."""

    def run(group: pa.Table) -> pa.Table:
        blobs_a, blobs_b = group["a"].to_pylist(), group["b"].to_pylist()
        cells = np.asarray(group["cell"])
        a, b = np.frombuffer(b"".join(blobs_a), a_type), np.frombuffer(b"".join(blobs_b), b_type)
        sizes = np.array([len(x) for x in blobs_a], np.int64) // np.dtype(a_type).itemsize
        answer = merge(a, b, np.repeat(cells, sizes))
        edges = np.concatenate([[0], np.cumsum(sizes)])
        return pa.table(
            {
                "cell": group["cell"],
                "bucket": group["bucket"],
                "kind": pa.array(np.full(len(cells), kind, np.int32)),
                "answer": pa.array([answer[s:e].tobytes() for s, e in zip(edges[:-1], edges[1:])], pa.binary()),
            }
        )

    return packed.groupBy("bucket").applyInArrow(run, ANSWERS)


def answered(answers: pa.Table, kind: int, dtype: str, n: int) -> np.ndarray:
    """The answers of one cell, in the order in which `pack` left its entries."""
    mine = [(b, x) for k, b, x in zip(answers["kind"].to_pylist(), answers["bucket"].to_pylist(), answers["answer"].to_pylist()) if k == kind]
    out = np.frombuffer(b"".join(x for _, x in sorted(mine)), dtype)
    assert len(out) == n, (len(out), n)
    return out
