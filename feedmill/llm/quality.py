"""Quality: logistic regression on hashed word n-grams, fitted with follow-the-regularised-leader updates.

A text is two streams of tokens: its words, and the shape of each word (letter case, digits, symbols,
length, whether it repeats the word before). Runs of one to three tokens of either stream are hashed into
2^18 buckets; a feature's value is its share of the text's n-grams. FTRL-Proximal keeps a learning rate
for each weight and sets weights of rare features to zero (McMahan et al., "Ad Click Prediction", 2013).
Scores are sparse dot products.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.llm.labelled import as_texts, feature_rows, fold, score_rows, sigmoid, training_sample
from feedmill.llm.textarrays import U64, gram_hashes, gram_prefix, hash_ranges, mix, ramp, word_bounds

BITS = 18
THRESHOLD = 0.7
#: Labelled documents that the fit uses at most.
FIT_ROWS = 8_000
WORD_ORDERS, SHAPE_ORDERS = (1, 2), (1, 2, 3)
#: Scale of the values, which are shares.
SCALE = 8.0
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02
BATCH, EPOCHS = 16, 3


def _classes() -> np.ndarray:
    out = np.zeros(256, dtype=np.uint8)
    for b in range(256):
        c = chr(b)
        out[b] = 1 if "a" <= c <= "z" else 2 if "A" <= c <= "Z" else 4 if "0" <= c <= "9" else 8 if b >= 128 else 16 if c in ".,;:'-" else 32
    return out


_CLASS = _classes()


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams of each text, one after another, with values that are constant in a text."""
    starts, ends, at = word_bounds(data, off)
    n = np.diff(at)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(len(at), np.int64)
    words = hash_ranges(data, starts, ends)
    kinds = np.bitwise_or.reduceat(_CLASS[data], np.stack([starts, np.minimum(ends, len(data) - 1)], axis=1).reshape(-1))[::2] if len(data) > 1 else _CLASS[data]
    tail = ends == len(data)
    if tail.any():  # the last word ends with the bytes
        kinds[-1] |= np.bitwise_or.reduce(_CLASS[data[starts[-1] :]])
    again = np.zeros(len(words), dtype=np.int64)
    again[1:] = words[1:] == words[:-1]
    again[at[:-1][n > 0]] = 0
    size = np.digitize(ends - starts, [2, 4, 8, 16, 32])
    shapes = mix(kinds.astype(U64) | (size.astype(U64) << U64(8)) | (again.astype(U64) << U64(16)) | (_CLASS[data[starts]].astype(U64) << U64(20)) | (_CLASS[data[ends - 1]].astype(U64) << U64(28)))
    grams, counts = [], np.zeros(len(n), dtype=np.int64)
    for stream, orders in ((words, WORD_ORDERS), (shapes, SHAPE_ORDERS)):
        prefix = gram_prefix(stream)
        for k in orders:
            m = np.maximum(n - k + 1, 0)
            first = np.repeat(at[:-1], m) + ramp(m)
            grams.append((gram_hashes(prefix, first, k) >> U64(64 - BITS)).astype(np.int64) if len(first) else np.zeros(0, np.int64))
            counts += m
    # the streams stand one after another for all texts; put each text's n-grams together
    row = np.concatenate([np.repeat(np.arange(len(n), dtype=np.int32), np.maximum(n - k + 1, 0)) for orders in (WORD_ORDERS, SHAPE_ORDERS) for k in orders])
    index = np.concatenate(grams)[np.argsort(row, kind="stable")]
    ends_at = np.concatenate(([0], np.cumsum(counts)))
    return index, np.repeat(SCALE / np.maximum(n, 1), counts), ends_at


def filled(column: pa.Array) -> pa.Array:
    return pc.fill_null(column, "")


def fit(texts, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and intercept after EPOCHS passes of FTRL-Proximal over batches of BATCH texts in the given order."""
    good = labels.mean() if len(labels) else 1.0
    if not 0 < good < 1:
        return np.zeros(1 << BITS), 5.0 if good else -5.0
    texts = filled(as_texts(texts))
    z = np.zeros((1 << BITS) + 1)
    n = np.zeros((1 << BITS) + 1)
    bias = 1 << BITS
    start = float(np.log(good / (1 - good)))

    def weights(i: np.ndarray) -> np.ndarray:
        l1 = np.where(i == bias, 0, L1)
        return np.where(np.abs(z[i]) <= l1, 0, -(z[i] - np.sign(z[i]) * l1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))

    for _ in range(EPOCHS):
        for lo in range(0, len(labels), BATCH):
            hi = min(lo + BATCH, len(labels))
            index, value, at = feature_rows(texts.slice(lo, hi - lo), features)
            row = np.repeat(np.arange(hi - lo), np.diff(at))
            used, code = np.unique(np.append(index, bias), return_inverse=True)
            w = weights(used)
            score = np.bincount(row, weights=w[code[:-1]] * value, minlength=hi - lo) + w[-1] + start
            error = sigmoid(score) - labels[lo:hi]
            slope = np.bincount(code[:-1], weights=error[row] * value, minlength=len(used))
            slope[-1] = error.sum()
            sigma = (np.sqrt(n[used] + slope**2) - np.sqrt(n[used])) / ALPHA
            z[used] += slope - sigma * w
            n[used] += slope**2
    final = weights(np.arange((1 << BITS) + 1))
    return final[:-1], float(final[-1] + start)


def score_quality(docs: DataFrame, labelled: DataFrame, labels: DataFrame, held_out: Column | None = None, threshold: float = THRESHOLD, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Score every whole text of docs with a model fitted on labelled texts.

    labelled: documents with text; labels: doc_id, quality. The fit takes at most fit_rows of the labelled
    rows outside held_out. Returns doc_id, held_out, score and predicted (1 from the threshold on).

    Null and empty texts get the score of the intercept; so do all texts if the labels hold one class
    only (then near 0 or 1, and near 1 without any). A null doc_id counts as held out. Labels, language,
    source and doc_id are not inputs of a score. Equal texts have equal scores. A very long text is scored whole,
    as one step of a task (see textarrays); texts of over a megabyte are no samples of the fit. Other columns are
    ignored; an empty table gives an empty one.
    """
    out = F.lit(False) if held_out is None else held_out
    model = docs.sparkSession.sparkContext.broadcast(fit(*training_sample(labelled, labels, "quality", out, fit_rows)))
    return score_rows(docs, out, model, filled, features, threshold)


def score_held_out(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from labels whose fold of 4 is not 2."""
    return score_quality(docs, docs, labels, F.coalesce(fold(4) == 2, F.lit(True)))
