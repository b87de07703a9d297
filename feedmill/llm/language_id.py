"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts come from one pass over all training texts (partial sums in the tasks, then a sum in Spark). The
model is a matrix of log probabilities, a row for each of 2^15 hash buckets and a column for each
language. A broadcast matrix has at most MAX_LANGS columns; further languages have matrices of their own,
and a text goes through them one after another.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.llm.textarrays import pieces

BITS = 15
ORDERS = (1, 2, 3)
SMOOTHING = 0.1
#: Languages in one matrix, which so stays under 70 MB; more languages are several matrices, one after another.
MAX_LANGS = 512
#: Code points in one vectorised step.
STEP = 1 << 19


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 texts, and each text's offsets among them."""
    wide = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
    heads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    return wide, heads[offsets]


def is_letter(points: np.ndarray) -> np.ndarray:
    return _letters()[points]


def grams(points: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bucket of each character n-gram and the code point at which it starts, for each order.

    Runs of anything but letters count as one space; n-grams don't cross from one text into the next.
    """
    letters = is_letter(points)
    folded = np.where(letters, points, np.uint32(32))
    left = np.repeat(at[1:], np.diff(at)) - np.arange(len(points))  # code points from each one to the end of its text
    key = np.zeros(len(points), dtype=np.uint32)
    for n in range(1, max(ORDERS) + 1):
        shifted = np.zeros(len(points), dtype=np.uint32)
        if len(points) >= n:
            shifted[: len(points) - n + 1] = folded[n - 1 :]
        key = (key ^ shifted) * np.uint32(0x9E3779B1) + np.uint32(n)
        if n in ORDERS:
            ok = left >= n
            if n == 1:
                ok &= letters
            where = np.flatnonzero(ok)
            k = key[where]
            yield ((k ^ (k >> np.uint32(15))) * np.uint32(0x85EBCA77)) >> np.uint32(32 - BITS), where


def _lowered(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(column, ""))


def _count_task(langs: list[str]):
    index = pa.array(langs, pa.string())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(langs) << BITS, dtype=np.int64)
        for batch in batches:
            lang = pc.index_in(batch.column(1), index).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi, data, off in pieces(_lowered(batch.column(0)), STEP):
                points, at = code_points(data, off)
                owner = np.repeat(lang[lo:hi] << BITS, np.diff(at))
                for bucket, where in grams(points, at):
                    total += np.bincount(owner[where] + bucket, minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used), pa.array(total[used])], ["cell", "n"])

    return count


def fit(docs: DataFrame, lang: str = "lang") -> list[tuple[list[str], np.ndarray]]:
    """Languages in order with their matrix of log probabilities, MAX_LANGS at a time, from all rows with text and language.

    The counts come to the driver summed: at most 2^15 cells for each language, one matrix at a time.
    """
    known = docs.where(F.col("text").isNotNull() & F.col(lang).isNotNull()).select("text", F.col(lang).cast("string").alias("lang"))
    every = sorted(r[0] for r in known.select("lang").distinct().collect())
    model = []
    for first in range(0, len(every), MAX_LANGS):
        langs = every[first : first + MAX_LANGS]
        own = known.where(F.col("lang").between(langs[0], langs[-1])) if len(every) > MAX_LANGS else known
        cells = own.mapInArrow(_count_task(langs), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
        counts = np.zeros(len(langs) << BITS)
        counts[cells["cell"].to_numpy()] = cells["n"].to_numpy()
        counts = counts.reshape(len(langs), -1) + SMOOTHING
        model.append((langs, np.log(counts / counts.sum(axis=1, keepdims=True)).T.astype(np.float32).copy()))
    return model


def totals(column: pa.Array, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Best language of each text, its log probability, the sum of all probabilities as a multiple of it, and whether the text has a letter.

    The priors are equal: what share of the training texts a language has says nothing about a new text.
    """
    parts = []
    for lo, hi, data, off in pieces(_lowered(column), STEP):
        points, at = code_points(data, off)
        total = np.zeros((hi - lo, matrix.shape[1]))
        for bucket, where in grams(points, at):
            cut = np.searchsorted(where, at)
            full = np.flatnonzero(np.diff(cut))
            for s in range(0, len(full), 256):
                some = full[s : s + 256]
                a, b = cut[some[0]], cut[some[-1] + 1]
                total[some] += np.add.reduceat(np.take(matrix, bucket[a:b], axis=0), cut[some] - a, axis=0)
        letters = np.concatenate(([0], np.cumsum(is_letter(points))))
        top = total.max(axis=1)
        parts.append((total.argmax(axis=1), top, np.exp(np.minimum(total - top[:, None], 0)).sum(axis=1), letters[at[1:]] > letters[at[:-1]]))
    if not parts:
        return np.zeros(0, int), np.zeros(0), np.zeros(0), np.zeros(0, bool)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def score_texts(column: pa.Array, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best language of each text, its posterior probability, and whether the text has a letter."""
    best, _, mass, lettered = totals(column, matrix)
    return best, 1 / mass, lettered


def _predict_task(block, last: bool):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best language so far, its log probability and the sum of all as a multiple of it."""
        langs, matrix = block.value
        names = np.array(langs, dtype=object)
        for batch in batches:
            before, top, mass = (batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 4, 5))
            best, new_top, new_mass, lettered = totals(batch.column(1), matrix)
            most = np.maximum(top, new_top)
            mass = mass * np.exp(top - most) + new_mass * np.exp(new_top - most)
            name = np.where(lettered, np.where(new_top > top, names[best], before), None)
            text = pa.nulls(batch.num_rows, pa.string()) if last else batch.column(1)
            yield pa.record_batch([batch.column(0), text, batch.column(2), pa.array(name, pa.string()), pa.array(most), pa.array(mass)], ["doc_id", "text", "held_out", "best", "top", "mass"])

    return predict


def identify(docs: DataFrame, train: DataFrame, held_out: Column | None = None) -> DataFrame:
    """Predict the language of every whole text of docs with a model fitted on train (text, lang).

    Returns doc_id, held_out (the given column, false by default), lang_pred and score, the posterior
    probability. Null text or text without a letter: 'und' with score 0; so are all texts if train has no
    row with text and language. Equal texts have equal results; of languages that are equally likely the
    first in order counts. Only text is an input of a prediction; other columns are ignored. A very long text
    is one step of a task and needs some 100 bytes of memory for each of its code points. An empty table gives
    an empty one.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), (F.lit(False) if held_out is None else held_out).alias("held_out"),
        F.lit(None).cast("string").alias("best"), F.lit(float("-inf")).alias("top"), F.lit(0.0).alias("mass"),
    )
    model = fit(train)
    for k, block in enumerate(model):
        matrix = docs.sparkSession.sparkContext.broadcast(block)
        rows = rows.mapInArrow(_predict_task(matrix, k == len(model) - 1), "doc_id long, text string, held_out boolean, best string, top double, mass double")
    return rows.select("doc_id", "held_out", F.coalesce("best", F.lit("und")).alias("lang_pred"), F.when(F.col("best").isNotNull(), 1 / F.col("mass")).otherwise(0.0).alias("score"))


def fold(modulus: int) -> Column:
    """crc32 of doc_id as text, modulo a number."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


def identify_held_out(docs: DataFrame) -> DataFrame:
    """Learn from the rows whose fold of 5 is not 0 and predict all rows; a null doc_id counts as held out."""
    out = F.coalesce(fold(5) == 0, F.lit(True))
    return identify(docs, docs.where(~out), out)
