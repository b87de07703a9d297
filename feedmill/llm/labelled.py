"""Folds, bounded training samples and sparse linear scores shared by the two text classifiers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmill.llm.scratch import written
from feedmill.llm.textarrays import pieces

#: A text's features: bucket numbers, values and each text's offsets among them.
Features = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def fold(modulus: int) -> Column:
    """crc32 of doc_id as text, modulo a number; null for a null doc_id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


#: Bytes of text that a fit uses at most in all, and of one text.
FIT_BYTES, MOST_TEXT_BYTES = 64 << 20, 1 << 20


def training_sample(docs: DataFrame, labels: DataFrame, label: str, held_out: Column, fit_rows: int, fit_bytes: int = FIT_BYTES) -> tuple[pa.Array, np.ndarray]:
    """Texts and 0/1 labels of at most fit_rows labelled documents outside the fold held out, of fit_bytes at most together.

    Rows without doc_id or label are left out; of several labels of a document the largest counts, of
    several texts the least. The sample is the fit_rows ids with the least hashes, in that order, the same
    in every run, without texts of over a megabyte; it ends before fit_bytes are passed.
    """
    ids = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).where(~held_out)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id")
    found = written(rows.where(F.octet_length("text") <= MOST_TEXT_BYTES).groupBy("doc_id", "label").agg(F.min("text").alias("text")).withColumn("h", F.xxhash64("doc_id")))
    sized = found.select("doc_id", F.sum(F.octet_length("text")).over(Window.orderBy("h", "doc_id")).alias("upto"))  # at most fit_rows rows
    taken = found.join(F.broadcast(sized.where(F.col("upto") <= fit_bytes)), "doc_id").select("h", "doc_id", "text", "label").toArrow()
    taken = taken.sort_by([("h", "ascending"), ("doc_id", "ascending")])
    return taken["text"].combine_chunks(), taken["label"].to_numpy().astype(np.float64)


def as_texts(texts) -> pa.Array:
    """A list of texts or an Arrow array as an Arrow array."""
    if isinstance(texts, pa.ChunkedArray):
        return texts.combine_chunks()
    return texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())


def feature_rows(column: pa.Array, features: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    index, value, counts = [], [], []
    for _, _, data, off in pieces(column):
        i, v, at = features(data, off)
        index.append(i)
        value.append(v)
        counts.append(np.diff(at))
    if not index:
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(1, np.int64)
    return np.concatenate(index), np.concatenate(value), np.concatenate(([0], np.cumsum(np.concatenate(counts))))


def row_sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = np.zeros(len(at) - 1)
    full = np.flatnonzero(np.diff(at))
    if len(full):
        out[full] = np.add.reduceat(values, at[full])
    return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def batch_scores(column: pa.Array, model: tuple[np.ndarray, float], prepare: Callable[[pa.Array], pa.Array], features: Features) -> np.ndarray:
    """Scores of the texts of a column under (weights, intercept)."""
    weights, intercept = model
    parts = [np.zeros(0)]
    for _, _, data, off in pieces(prepare(column)):
        index, value, at = features(data, off)
        parts.append(sigmoid(row_sums(weights[index] * value, at) + intercept))
    return np.concatenate(parts)


def score_task(model, prepare: Callable[[pa.Array], pa.Array], features: Features, threshold: float):
    """mapInArrow function from (doc_id, text, held_out) to scores; model: broadcast (weights, intercept)."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = batch_scores(batch.column(1), model.value, prepare, features)
            yield pa.record_batch(
                [batch.column(0), batch.column(2), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return score


SCORED = "doc_id long, held_out boolean, score double, predicted int"


def score_rows(docs: DataFrame, held_out: Column | None, model, prepare, features: Features, threshold: float) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), (F.lit(False) if held_out is None else held_out).alias("held_out"))
    return rows.mapInArrow(score_task(model, prepare, features, threshold), SCORED)
