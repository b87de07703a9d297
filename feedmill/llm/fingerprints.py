"""Document fingerprints: MinHash values of five-word shingles under many universal hash permutations.

Bands of the values find near copies: texts that meet in a band are linked in Spark, and links are verified by
the Jaccard index of the shingle sets, with the blocks of the similarity join.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.llm.jaccard_join import Bands, classed
from feedmill.llm.scratch import outside, tables
from feedmill.llm.textarrays import minhashes, pieces, shingles

SHINGLE, PERMUTATIONS, SEED = 5, 128, 11
#: Values in a band.
BAND = 4


def signatures(column: pa.Array, k: int = PERMUTATIONS) -> np.ndarray:
    """MinHash values of each text of an Arrow column, a row of k for each."""
    parts = [minhashes(*shingles(data, off, SHINGLE), k, SEED) for _, _, data, off in pieces(column)]
    return np.concatenate(parts) if parts else np.zeros((0, k), np.uint32)


def _hex(values: np.ndarray) -> pa.Array:
    raw = values.astype(">u4").tobytes().hex()
    width = values.shape[1] * 8
    return pa.array([raw[i * width : (i + 1) * width] for i in range(len(values))], pa.string())


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.record_batch([batch.column(0), _hex(signatures(batch.column(1)))], ["doc_id", "fingerprint"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint (hex of 128 MinHash values) of each row.

    Null and empty texts have the fingerprint of all ones; a text of one to four words has one shingle.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_fingerprints, "doc_id long, fingerprint string")


def likeness(a, b):
    """Share of equal MinHash values of two fingerprint columns."""
    same = F.filter(F.sequence(F.lit(0), F.lit(PERMUTATIONS - 1)), lambda i: F.substr(a, i * 8 + 1, F.lit(8)) == F.substr(b, i * 8 + 1, F.lit(8)))
    return F.size(same) / F.lit(float(PERMUTATIONS))


def near_classes(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Classes of near copies: the fingerprints' values in bands, joined in Spark, and the Jaccard index of the shingles verified.

    Returns for each row of docs: doc_id, mark (a hash of its text) and class_id, the least doc_id that links
    of texts lead to which share a band of 4 values and have a Jaccard index of at least threshold. A pair at
    0.8 shares none of the 32 bands with a chance of 5e-8. Null and empty texts are classes of their own, and
    rows with null doc_id have none. An empty table gives an empty one.
    """
    return classed(docs, threshold, Bands(PERMUTATIONS // BAND, BAND, SEED, None)).select("doc_id", "mark", "class_id")


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order within each part, the next part's first row after each part's last; a row of a class stands before the texts it is of."""
    carry: list[tuple] = []
    own: tuple = ()
    for batch in batches:
        rows = carry
        for doc_id, mark, text, extra, class_id in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
            if text is None:
                own = doc_id, mark, class_id
            else:
                rows.append((doc_id, text, extra, own[2] if own[:2] == (doc_id, mark) else doc_id))
        carry = []
        at = 0
        while at < len(rows):
            end, size = at, 0
            while end < len(rows) - 1 and size < 1 << 20:
                size += len(rows[end][1])
                end += 1
            if end == at:  # the last row waits for its next one
                carry = rows[at:]
                break
            yield _compare(rows[at : end + 1])
            at = end
    if carry and not carry[0][2]:
        yield _compare([*carry, (None, "", True, None)])


def _compare(rows: list[tuple]) -> pa.RecordBatch:
    """Results of all rows but the last, each with the row after it."""
    edited = [row[1][: len(row[1]) - len(row[1]) // 2] + after[1][: len(row[1]) // 2] for row, after in zip(rows, rows[1:], strict=False)]
    own = signatures(pa.array([r[1] for r in rows], pa.string()))
    new = signatures(pa.array(edited, pa.string()))
    keep = np.array([not r[2] for r in rows[:-1]], dtype=bool)
    same = lambda a, b: (a == b).sum(axis=1) / a.shape[1]
    out = pa.record_batch(
        [
            pa.array([r[0] for r in rows[:-1]], pa.int64()), pa.array([len(r[1]) for r in rows[:-1]], pa.int64()), pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
            _hex(own[:-1]), _hex(new), pa.array(same(own[:-1], new)), pa.array(same(own[:-1], own[1:])), pa.array([r[3] for r in rows[:-1]], pa.int64()),
        ],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "class_id"],
    )
    return out.filter(pa.array(keep))


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Each text's fingerprint beside that of an edited text and of the next text, and the class of its near copies.

    The next text is the one with the next smaller doc_id, after the last the one with the largest; rows
    with one doc_id follow each other by a hash of their text. The edited text has its last floor(n_chars / 2)
    code points replaced by as many first ones of the next text, or by all of it. class_id: see near_classes.

    Null text is empty; empty texts have fingerprints of all ones, which are alike. Null doc_id comes
    last. One row alone is its own next. Equal rows follow each other. A very long text is one step of a task (see
    textarrays). Other columns are ignored; an empty table gives an empty one.

    The rows are dealt out by ranges of doc_id with the same number of rows, and those of a doc_id with many rows by
    ranges of the text's hash, so no task has all; each range gets a copy of the first row of the range after it.
    """
    spark = docs.sparkSession
    with tables(spark):
        near = near_classes(docs).where("class_id <> doc_id").distinct()
        near = outside(near)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), F.coalesce("text", F.lit("")).alias("text"))
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = 4 * tasks  # several to a task, so that tasks are of one size
    cuts = base.select(key.alias("k")).select(F.percentile_approx("k", F.array(*[F.lit((i + 1) / parts) for i in range(parts - 1)]) if parts > 1 else F.array(F.lit(0.5)), 20000)).first()[0]
    if not cuts:
        return base.limit(0).mapInArrow(lambda batches: (b for b in batches if False), _COMPARED)
    # part p holds the ids above its cut; parts are numbered from the largest ids on, ids with many rows in pieces first
    times = Counter(cuts)
    hot = {c: n for c, n in times.items() if n > 1}
    pieces_of = F.element_at(F.create_map(*[F.lit(x).cast("long") for pair in hot.items() for x in pair]), key) if hot else F.lit(None).cast("long")
    piece = F.coalesce(F.floor((F.shiftright("mark", 32) + F.lit(1 << 31)) * pieces_of / F.lit(1 << 32)), F.lit(parts))
    part = (_part(key, sorted(times)) * (parts + 1) + piece).cast("int")
    placed = base.withColumn("part", part)
    tops = placed.groupBy("part").agg(F.max(F.struct(key.alias("key"), F.bitwise_not("mark").alias("back"))).alias("top")).collect()  # a row for each part
    order = sorted(r.part for r in tops)
    before = {p: order[i - 1] for i, p in enumerate(order)}
    heads = spark.createDataFrame([(r.part, r.top.key, ~r.top.back, before[r.part]) for r in tops], "part int, key long, mark long, goes_to int")
    first = placed.withColumn("key", key).join(F.broadcast(heads), ["part", "key", "mark"]).groupBy("goes_to").agg(F.first(F.struct("doc_id", "mark", "text")).alias("r"))
    rows = placed.select("doc_id", "mark", "text", "part", F.lit(False).alias("extra"), F.lit(None).cast("long").alias("class_id"))
    rows = rows.union(first.select("r.*", F.col("goes_to").alias("part"), F.lit(True).alias("extra"), F.lit(None).cast("long").alias("class_id")))
    rows = rows.union(near.withColumn("part", part).select("doc_id", "mark", F.lit(None).cast("string").alias("text"), "part", F.lit(False).alias("extra"), "class_id"))
    dealt = rows.repartition(tasks, "part").sortWithinPartitions("part", "extra", F.desc_nulls_last("doc_id"), "mark", F.col("text").isNotNull())
    return dealt.select("doc_id", "mark", "text", "extra", "class_id").mapInArrow(_compared, _COMPARED)


def _part(key: Column, cuts: list[int]) -> Column:
    """How many of the ascending cuts are not below key, looked up in blocks of about their square root."""
    wide = max(1, math.isqrt(len(cuts)))
    below = lambda values: F.aggregate(values, F.lit(0), lambda n, c: n + F.when(c < key, 1).otherwise(0))
    array = lambda values: F.array(*[F.lit(c) for c in values]).cast("array<bigint>")
    blocks = below(array(cuts[wide - 1 :: wide]))
    return F.lit(len(cuts)) - blocks * wide - below(F.slice(array(cuts), blocks * wide + 1, wide))


_COMPARED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, class_id long"
