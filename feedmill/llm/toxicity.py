"""Toxicity: a sparse logistic classifier with counterfactual regularisation.

The features of a text are its distinct lower-case words and the first four bytes of each, hashed.
Every labelled text has a counterfactual: where it names a group of people, each identity term is swapped
for the next one of its list; where it names none, a mention is added, of each term in turn. The fit
penalises the squared change of the score between the two (Garg et al., "Counterfactual Fairness in Text
Classification through Robustness", 2019), so a term on which the label does not depend gets no weight,
and neutral mentions of a group are not flagged. An L1 term keeps the weights of ordinary words at zero.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.llm.labelled import as_texts, batch_scores, fold, row_sums, score_rows, sigmoid, training_sample
from feedmill.llm.textarrays import NOT_ALNUM, U64, hash_ranges, pieces, word_bounds

BITS = 18
PREFIX = 4
THRESHOLD = 0.7
#: Labelled documents that the fit uses at most.
FIT_ROWS = 8_000
L1, L2 = 1e-4, 1e-5
COUNTERFACTUAL = 1.0
STEPS = 120

#: Terms that can stand for each other in a sentence; the swap goes round each list.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("black", "white", "asian", "latino", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"), ("immigrants", "refugees", "citizens", "foreigners"),
    ("old", "young"), ("disabled", "deaf", "blind", "autistic"),
)


def swap_terms(text: str, groups=IDENTITY_TERMS) -> str:
    """The lower-case text with each identity term replaced by the next of its list."""
    following = {t: g[(k + 1) % len(g)] for g in groups for k, t in enumerate(g)}
    return re.sub(r"\b(?:" + "|".join(sorted(map(re.escape, following), key=len, reverse=True)) + r")\b", lambda m: following[m[0]], text)


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct buckets of the words and word beginnings of each lower-case text."""
    starts, ends, at = word_bounds(data, off, NOT_ALNUM)
    whole = hash_ranges(data, starts, ends)
    begin = hash_ranges(data, starts, np.minimum(ends, starts + PREFIX)) ^ U64(0x2545F4914F6CDD1D)
    long = ends - starts > PREFIX
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    codes = np.concatenate([(row.astype(np.int64) << BITS) | (whole >> U64(64 - BITS)).astype(np.int64), (row[long].astype(np.int64) << BITS) | (begin[long] >> U64(64 - BITS)).astype(np.int64)])
    codes = np.unique(codes)
    return codes & ((1 << BITS) - 1), np.ones(len(codes)), np.searchsorted(codes, np.arange(len(at), dtype=np.int64) << BITS)


def lowered(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(column, ""))


def _buckets(lower: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets as 32-bit numbers and how many each text has."""
    parts = [features(data, off) for _, _, data, off in pieces(lower)]
    index = np.concatenate([np.zeros(0, np.int32), *[i.astype(np.int32) for i, _, _ in parts]])
    return index, np.concatenate([np.zeros(0, np.int64), *[np.diff(at) for _, _, at in parts]])


def counterfactuals(lower: pa.Array, groups=IDENTITY_TERMS) -> tuple[np.ndarray, pa.Array]:
    """Numbers of the texts that name a group, and those texts with the terms swapped."""
    named = np.flatnonzero(pc.match_substring_regex(lower, r"\b(?:" + "|".join(re.escape(t) for g in groups for t in g) + r")\b").to_numpy(zero_copy_only=False))
    return named, pa.array([swap_terms(t, groups) for t in lower.take(pa.array(named)).to_pylist()], pa.string())


def _rows(lower: pa.Array, groups) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all rows of the fit and how many each has, and the pairs of rows whose scores should be alike.

    First the texts, then each text that names no group with a mention added, in turn of every term, then the
    texts that name one with the terms swapped.
    """
    terms = [t for g in groups for t in g]
    index, counts = _buckets(lower)
    ends = np.cumsum(counts)
    named, swapped = counterfactuals(lower, groups)
    plain = np.setdiff1d(np.arange(len(lower)), named)
    of_terms, sizes = _buckets(pa.array(terms, pa.string()))
    own = np.split(of_terms, np.cumsum(sizes)[:-1])
    added = [np.concatenate([index[ends[k] - counts[k] : ends[k]], own[j % len(terms)]]) for j, k in enumerate(plain.tolist())] if terms else []
    more, more_counts = _buckets(swapped)
    first = len(lower)
    index = np.concatenate([index, *added, more])
    counts = np.concatenate([counts, np.array([len(x) for x in added], dtype=np.int64), more_counts])
    pairs = np.concatenate([np.stack([plain[: len(added)], first + np.arange(len(added))], axis=1), np.stack([named, first + len(added) + np.arange(len(named))], axis=1)])
    return index, counts, pairs, plain[: len(added)]


def _differs(pairs: np.ndarray, index: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Whether a bucket ever stands in one row of a pair alone."""
    out = np.zeros(width, dtype=bool)
    for a, b in pairs.tolist():
        out[np.setxor1d(index[at[a] : at[a + 1]], index[at[b] : at[b + 1]])] = True
    return out


def fit(texts, labels: np.ndarray, groups=IDENTITY_TERMS, counterfactual: float = COUNTERFACTUAL, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and intercept by accelerated proximal gradient steps on the whole sample.

    A text with a mention added is a sample too, with the text's label; one with swapped terms is not.
    """
    rare = labels.mean() if len(labels) else 0.0
    if not 0 < rare < 1:
        return np.zeros(1 << BITS), -5.0 if rare == 0 else 5.0
    index, counts, pairs, added = _rows(lowered(as_texts(texts)), groups)
    labels = np.concatenate([labels, labels[added]])
    # number the buckets that occur
    seen = np.zeros(1 << BITS, dtype=bool)
    seen[index] = True
    used = np.flatnonzero(seen)
    index = (np.cumsum(seen, dtype=np.int32) - np.int32(1))[index]
    at = np.concatenate(([0], np.cumsum(counts)))
    row = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
    n, width = len(labels), len(used)
    # a diagonal bound of the curvature gives each weight its own step; the mean text size makes it safe
    trained = (np.arange(len(counts)) < n).astype(np.float64)
    paired = np.bincount(pairs.reshape(-1), minlength=len(counts))
    seen = np.bincount(index, weights=trained[row], minlength=width) + 2 * counterfactual * np.bincount(index, weights=paired[row], minlength=width) * _differs(pairs, index, at, width)
    size = max(1.0, float(counts.mean()))
    rate = 1.0 / (0.25 * np.maximum(seen, 1) / n * min(size, 24.0) + L2)
    w, b = np.zeros(width), float(np.log(rare / (1 - rare)))
    ahead, ahead_b, momentum = w.copy(), b, 1.0
    last = np.inf
    for _ in range(steps):
        z = row_sums(ahead[index], at) + ahead_b
        error = (sigmoid(z[:n]) - labels) / n
        gap = z[pairs[:, 0]] - z[pairs[:, 1]]
        push = np.concatenate([error, np.zeros(len(counts) - n)])
        np.add.at(push, pairs[:, 0], 2 * counterfactual * gap / n)
        np.add.at(push, pairs[:, 1], -2 * counterfactual * gap / n)
        slope = np.bincount(index, weights=push[row], minlength=width) + L2 * ahead
        loss = np.mean(np.logaddexp(0, z[:n]) - labels * z[:n]) + L1 * np.abs(ahead).sum() + counterfactual * np.sum(gap**2) / n
        new = ahead - rate * slope
        new = np.sign(new) * np.maximum(np.abs(new) - rate * L1, 0)
        new_b = ahead_b - 2.0 * float(error.sum())
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        if loss > last:  # restart the momentum, with smaller steps
            following, momentum, rate = 1.0, 1.0, rate * 0.7
        ahead, ahead_b = new + (momentum - 1) / following * (new - w), new_b + (momentum - 1) / following * (new_b - b)
        w, b, momentum, last = new, new_b, following, loss
    weights = np.zeros(1 << BITS)
    weights[used] = w
    return weights, b


def score_toxicity(docs: DataFrame, labelled: DataFrame, labels: DataFrame, held_out: Column | None = None, threshold: float = THRESHOLD, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Score every whole text of docs with a model fitted on labelled texts.

    labelled: documents with text; labels: doc_id, toxic. The fit takes at most fit_rows of the labelled
    rows outside held_out. Returns doc_id, held_out, score and predicted (1 from the threshold on).

    Null and empty texts get the score of the intercept; so do all texts if the labels hold one class
    only (then near 0 or 1, and near 0 without any). A null doc_id counts as held out. Labels, language,
    source and doc_id are not inputs of a score. Equal texts have equal scores. A very long text is scored whole,
    as one step of a task (see textarrays); texts of over a megabyte are no samples of the fit. Other columns are
    ignored; an empty table gives an empty one.
    """
    out = F.lit(False) if held_out is None else held_out
    model = docs.sparkSession.sparkContext.broadcast(fit(*training_sample(labelled, labels, "toxic", out, fit_rows)))
    return score_rows(docs, out, model, lowered, features, threshold)


def score_held_out(docs: DataFrame, labels: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """Learn from labels whose fold of 3 is not 1."""
    return score_toxicity(docs, docs if labelled is None else labelled, labels, F.coalesce(fold(3) == 1, F.lit(True)))


def reject_toxic(docs: DataFrame, labels: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """The rows of docs whose text the classifier does not call toxic, unchanged, whatever their other columns are called.

    The classifier is that of score_held_out. Null and empty texts stay unless toxic texts are the rule among the
    labels; rows with null doc_id are judged by their text. Equal rows stay or go together. Without labels of
    both kinds all rows stay, or none if all labels are toxic. An empty table gives an empty one.
    """
    out = F.coalesce(fold(3) == 1, F.lit(True))
    model = docs.sparkSession.sparkContext.broadcast(fit(*training_sample(docs if labelled is None else labelled, labels, "toxic", out, FIT_ROWS)))
    place = docs.columns.index("text")

    def keep(batches):
        for batch in batches:
            yield batch.filter(pa.array(batch_scores(batch.column(place), model.value, lowered, features) < THRESHOLD))

    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    return plain.mapInArrow(keep, plain.schema).toDF(*docs.columns)
