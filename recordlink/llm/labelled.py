"""Training rows for the classifiers, and the learned weights on their way back.

Labels are learned only from rows whose crc32(doc_id as text) mod 5 is not 0. The training sample is bounded: at most
`bound` labelled documents, chosen by a hash of the id, so that classes keep their shares. Of rows that repeat an id, the
text with the smallest fingerprint is learned from. Scoring, thresholds and every other step cover all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False))


def label_sample(labels: DataFrame, target: str, bound: int) -> DataFrame:
    """(doc_id, y) of at most `bound` ids. Contradictory labels of one id count as 1; null ids and labels are left out."""
    usable = labels.withColumn("doc_id", F.col("doc_id").cast("long")).filter(F.col("doc_id").isNotNull() & F.col(target).isin(0, 1) & ~held_out(F.col("doc_id")))
    one = usable.groupBy("doc_id").agg(F.max(F.col(target).cast("int")).alias("y"))
    # a top-N per task, then over the tasks; classes keep their natural shares at every size of the table
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def train(docs: DataFrame, labels: DataFrame, target: str, bound: int, featurise: Callable, fit: Callable) -> np.ndarray:
    """Weights fitted in one task on the bounded sample; features are made where the documents are read."""
    sample = F.broadcast(label_sample(labels, target, bound))  # at most `bound` pairs of numbers
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(sample, "doc_id")
    # one text per id, found where the rows are read: a hot id is one row per task before the exchange
    text = F.min(F.struct(F.xxhash64("text").alias("h"), F.col("text").alias("text"))).alias("t")
    rows = rows.groupBy("doc_id", "y").agg(text).select("doc_id", "t.text", "y")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = [pa.array(x, pa.binary()) for x in featurise(batch["text"])]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["y"], *blobs], ["doc_id", "y", "a", "b"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        y = np.concatenate([np.asarray(b["y"]) for b in parts]) if parts else np.zeros(0, np.int32)
        a, b = ([bytes(v) for p in parts for v in p[c].to_pylist()] for c in ("a", "b"))
        yield pa.RecordBatch.from_arrays([pa.array([fit(y, a, b).astype(np.float32).tobytes()], pa.binary())], ["weights"])

    made = rows.mapInArrow(make, "doc_id long, y int, a binary, b binary")
    one_task = made.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "a")
    fitted = one_task.select("y", "a", "b").mapInArrow(learn, "weights binary").first()
    if fitted is None:  # an empty relation has no task at all
        return fit(np.zeros(0, np.int32), [], []).astype(np.float32)
    return np.frombuffer(bytes(fitted["weights"]), np.float32)
