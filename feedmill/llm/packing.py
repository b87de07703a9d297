"""Packing: optimal length buckets and token-budget batches.

A text of n tokens in a bucket with upper bound u is padded by u - n. One aggregate counts the texts of
each length; dynamic programming over that histogram finds the bounds with the least padding in all. The
histogram has a row for each length that occurs, never one for each text, and is what the driver sees.
Inside a bucket, texts stand in order of length and fill batches of floor(budget / u) texts. The order is
one sort by ranges over all tasks, whatever the lengths; a text's place in its bucket is its place in its
task and the number of the bucket's texts in the tasks before.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmill.llm.scratch import outside, tables, written

BUCKETS = 16
BUDGET = 32_768


def word_count(text: Column) -> Column:
    """Number of runs of other characters than 09-0D and 20; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def bucket_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most so many buckets that pad least; lengths ascend.

    cost(i, j) of the lengths i..j in one bucket has monotone best splits, so each layer of the dynamic
    programme is filled by divide and conquer.
    """
    m = len(lengths)
    if not m:
        return []
    number = np.concatenate(([0], np.cumsum(counts, dtype=np.float64)))
    tokens = np.concatenate(([0], np.cumsum(lengths.astype(np.float64) * counts)))
    cost = (number[1:] * lengths) - tokens[1:]  # the first j + 1 lengths in one bucket
    choice = []
    for _ in range(min(buckets, m) - 1):
        new, at = np.empty(m), np.zeros(m, dtype=np.int64)
        before = np.concatenate(([0.0], cost))  # before[i]: the first i lengths
        level = [(0, m - 1, 0, m - 1)]
        while level:
            following = []
            for lo, hi, first, last in level:
                j = (lo + hi) // 2
                i = np.arange(first, min(last, j) + 1)
                total = before[i] + (number[j + 1] - number[i]) * lengths[j] - (tokens[j + 1] - tokens[i])
                k = int(total.argmin())
                new[j], at[j] = total[k], i[k]
                if lo < j:
                    following.append((lo, j - 1, first, int(i[k])))
                if j < hi:
                    following.append((j + 1, hi, int(i[k]), last))
            level = following
        cost = new
        choice.append(at)
    ends, j = [], m - 1
    for at in reversed(choice):
        ends.append(int(lengths[j]))
        j = int(at[j]) - 1
        if j < 0:
            break
    else:
        ends.append(int(lengths[j]))
    return sorted(set(ends))


def pack(docs: DataFrame, n_tokens: Column | None = None, buckets: int = BUCKETS, budget: int = BUDGET, carry: tuple[str, ...] = ()) -> DataFrame:
    """Place every text in a length bucket and a batch.

    n_tokens: the length of a text, its number of words by default. Returns doc_id, n_tokens, bucket (from 0
    on, ascending), padded_to (its upper bound), batch (from 0 on inside a bucket), slot (place in the
    batch), and the columns of docs named by carry. Each batch but the last of a bucket holds
    floor(budget / padded_to) texts, or one where that is 0: a text longer than the budget is a batch of its
    own and stays whole.

    Null and empty texts have length 0 and are packed like others (a bucket of length 0 holds budget texts
    a batch). Null doc_ids come first and keep a row each, as do equal rows. Ties of length go by doc_id, then
    by a hash of the text; equal rows are alike. Columns of docs that are not carried are ignored. An empty
    table gives an empty one.
    """
    part = F.shiftrightunsigned("at", 33).alias("part")
    with tables(docs.sparkSession):
        sized = docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(word_count(F.col("text")) if n_tokens is None else n_tokens.cast("long"), F.lit(0)).alias("n_tokens"),
            F.xxhash64("text").alias("mark"), F.monotonically_increasing_id().alias("spread"), F.struct(F.lit(0), *carry).alias("carried"),
        )
        if not carry:  # else texts would be written once more than they have to be
            sized = written(sized)
        histogram = sized.groupBy("n_tokens").count().orderBy("n_tokens").toPandas()
        bounds = bucket_bounds(histogram["n_tokens"].to_numpy(dtype=np.int64), histogram["count"].to_numpy(dtype=np.int64), buckets) or [0]
        edges = F.array(*[F.lit(b) for b in bounds])
        bucket = F.aggregate(edges, F.lit(0), lambda n, b: n + F.when(F.col("n_tokens") > b, 1).otherwise(0))
        # in order over all tasks; spread deals out rows that are alike
        order = ("n_tokens", "doc_id", "mark", "spread")
        placed = outside(sized.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "n_tokens", "carried", bucket.alias("bucket"), F.monotonically_increasing_id().alias("at")))
        sizes = placed.groupBy("bucket", part).agg(F.count("*").alias("n"), F.min("at").alias("first"))  # at most a row for each task and bucket
        before = F.coalesce(F.sum("n").over(Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        starts = outside(sizes.select("bucket", "part", (before - F.col("first")).alias("shift")))
    rank = F.col("at") + F.col("shift")
    upper = F.element_at(edges, F.col("bucket") + 1).cast("long")
    fit = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(upper, F.lit(1)))).cast("long")
    return placed.withColumn("part", part).join(F.broadcast(starts), ["bucket", "part"]).select(
        "doc_id", "n_tokens", "bucket", upper.alias("padded_to"), F.floor(rank / fit).cast("long").alias("batch"), (rank % fit).alias("slot"), *[F.col("carried")[c].alias(c) for c in carry]
    )


#: The same in DuckDB: every split of every prefix of the lengths is tried.
SQL = rf"""
WITH RECURSIVE sized AS (SELECT doc_id, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS n FROM documents),
hist AS (SELECT row_number() OVER (ORDER BY n) AS j, n, sum(count(*)) OVER (ORDER BY n) AS texts, sum(count(*) * n) OVER (ORDER BY n) AS tokens FROM sized GROUP BY n),
best AS (
  SELECT 1 AS k, j, CAST(texts * n - tokens AS BIGINT) AS cost, CAST(0 AS BIGINT) AS split FROM hist
  UNION ALL
  SELECT k, j, c.cost, c.split FROM (
    SELECT b.k + 1 AS k, h.j, min({{'cost': CAST(CASE WHEN b.j = h.j THEN b.cost ELSE b.cost + (h.texts - i.texts) * h.n - (h.tokens - i.tokens) END AS BIGINT), 'split': b.j}}) AS c
    FROM best b JOIN hist i ON i.j = b.j JOIN hist h ON h.j >= b.j
    WHERE b.k < least({BUCKETS}, (SELECT count(*) FROM hist)) GROUP BY b.k, h.j)),
choice AS (
  SELECT k, j, split FROM best WHERE (k, j) = (SELECT (max(k), max(j)) FROM best)
  UNION ALL SELECT b.k, b.j, b.split FROM choice c JOIN best b ON b.k = c.k - 1 AND b.j = c.split),
bounds AS (SELECT CAST(row_number() OVER (ORDER BY n) - 1 AS INTEGER) AS bucket, n AS padded_to FROM (SELECT DISTINCT n FROM choice JOIN hist USING (j))),
ranked AS (
  SELECT doc_id, n, bucket, padded_to, row_number() OVER (PARTITION BY bucket ORDER BY n, doc_id NULLS FIRST) - 1 AS place, greatest(1, {BUDGET} // greatest(padded_to, 1)) AS fit
  FROM sized ASOF JOIN bounds ON sized.n <= bounds.padded_to)
SELECT doc_id, CAST(n AS BIGINT) AS n_tokens, bucket, CAST(padded_to AS BIGINT) AS padded_to, CAST(place // fit AS BIGINT) AS batch, CAST(place % fit AS BIGINT) AS slot FROM ranked
"""
