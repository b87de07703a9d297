"""Similarity join on the Jaccard index of five-word shingle sets, with Bayesian candidate pruning.

1. Texts with one shingle set are copies; the set stands for them from here on. Its number is a hash of two
   sums over its shingles; where two sets would share a number, both get another.
2. Bands of MinHash values find which sets may be similar. Sets that meet in a band are linked in a
   star, never pairwise, and connected into candidate groups. A group of over GIANT sets, which chance
   meetings can chain together, is taken apart again: each of its bands is then a group of its own, and
   a pair counts in the first band that it shares.
3. A group is cut into chunks; Spark deals out pairs of chunks, so no task holds a group. In a pair of
   chunks, MinHash values are compared a few at a time, and a pair is dropped as soon as the posterior
   probability that its Jaccard index reaches the threshold falls below a tolerance (Satuluri and
   Parthasarathy, "Bayesian Locality Sensitive Hashing for Fast Similarity Search", 2012).
4. The rest is verified exactly from the whole shingle sets. A task returns each set's number of links
   and a star for each of its components, never the pairs.

Bands of 5 in 40 lose a pair at the threshold 0.8 with a chance of 1.3e-7; the pruning at most 1e-6.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.llm.components import components
from feedmill.llm.scratch import columns_of, outside, tables, written
from feedmill.llm.textarrays import U64, int64, minhashes, mix, pieces, shingles

THRESHOLD, SHINGLE = 0.8, 5
TOLERANCE = 1e-6
#: MinHash values that are compared before each decision.
STEPS = (16, 32, 64, 128, 200)
#: Shingle sets in a chunk of a candidate group, by its size: a 32nd of it within these bounds.
LEAST_CHUNK, MOST_CHUNK, CHUNKS = 64, 512, 32
#: Sets of a candidate group above which its bands are groups of their own.
GIANT = 16_384


#: Keys of candidates that are broadcast to the texts at most, some 50 MB; more are joined by a shuffle of the texts.
BROADCAST_ROWS = 500_000


class Bands(NamedTuple):
    """How candidates are found: bands of rows MinHash values each, and whether pairs are pruned by them before they are verified."""

    bands: int = 40
    rows: int = 5
    seed: int = 7
    tolerance: float | None = TOLERANCE

    def values(self, hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
        return minhashes(hashes, at, self.bands * self.rows, self.seed)

    def keys(self, values: np.ndarray) -> np.ndarray:
        """A key of each band of each row of MinHash values."""
        parts = values.astype(U64).reshape(len(values), self.bands, self.rows)
        keys = np.broadcast_to(np.arange(1, self.bands + 1, dtype=U64), parts.shape[:2])
        for k in range(self.rows):
            keys = mix(keys * U64(0x9E3779B97F4A7C15) + parts[:, :, k])
        return keys


PRUNED = Bands()


@lru_cache(maxsize=64)
def least_matches(n: int, threshold: float, tolerance: float) -> int:
    """Fewest matches of n MinHash values with which a pair is kept.

    With a uniform prior the posterior of the Jaccard index after m matches is Beta(m + 1, n - m + 1),
    and its mass above the threshold is the chance of at most m successes in n + 1 trials.
    """
    mass = 0.0
    for m in range(n + 1):
        mass += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if mass >= tolerance:
            return m
    return n + 1


def _distinct(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of each text in order, and each text's offsets among them."""
    sets = [np.unique(hashes[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
    return np.concatenate(sets) if sets else hashes[:0], np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int64)


def _features_task(scheme: Bands):
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """doc_id, mark, size and two sums of each shingle set, keys of its bands."""
        for batch in batches:
            for lo, hi, data, off in pieces(batch.column(2)):
                hashes, at = shingles(data, off, SHINGLE)
                sums = np.zeros((2, hi - lo), dtype=U64)
                sizes = np.zeros(hi - lo, dtype=np.int64)
                for r in np.flatnonzero(np.diff(at)):
                    s = np.unique(hashes[at[r] : at[r + 1]])
                    sizes[r], sums[0, r], sums[1, r] = len(s), np.add.reduce(mix(s)), np.add.reduce(mix(s ^ U64(0x632BE59BD9B4E019)))
                keys = scheme.keys(scheme.values(hashes, at))
                bands = pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1, dtype=np.int32) * scheme.bands), int64(keys.reshape(-1)))
                yield pa.record_batch(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(sizes), int64(sums[0]), int64(sums[1]), bands],
                    ["doc_id", "mark", "n_shingles", "sum1", "sum2", "bands"],
                )

    return features


_BLOCKS = "array<struct<grp: long, banded: boolean, chunk: int, chunks: int>>"


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, off in pieces(batch.column(2)):
            values, at = _distinct(*shingles(data, off, SHINGLE))
            raw = values.astype("<u8").tobytes()
            sets = pa.array([raw[a * 8 : b * 8] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.binary())
            yield pa.record_batch([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), sets], ["set_id", "blocks", "shingles"])


def candidate_pairs(signatures: np.ndarray, side: np.ndarray, threshold: float, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs i < j that survive the pruning; if side has two values, only pairs across."""
    n, done = len(signatures), STEPS[0]
    count = np.zeros((n, n), dtype=np.int16)
    for k in range(done):
        count += signatures[:, k, None] == signatures[None, :, k]
    i, j = _wanted(count >= least_matches(done, threshold, tolerance), side)
    matches = count[i, j].astype(np.int64)
    for upto in STEPS[1:]:
        for s in range(0, len(i), 1 << 16):
            part = slice(s, s + (1 << 16))
            matches[part] += (signatures[i[part], done:upto] == signatures[j[part], done:upto]).sum(axis=1)
        keep = matches >= least_matches(upto, threshold, tolerance)
        i, j, matches, done = i[keep], j[keep], matches[keep], upto
    return i, j


def _wanted(alive: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    alive = np.triu(alive, 1)
    if side.min() != side.max():
        alive &= side[:, None] != side[None, :]
    return np.nonzero(alive)


def pairs_in_bands(keys: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs i < j that share a band; if side has two values, only pairs across."""
    met = np.zeros((len(keys), len(keys)), dtype=bool)
    for k in range(keys.shape[1]):
        met |= keys[:, k, None] == keys[None, :, k]
    return _wanted(met, side)


def first_shared(keys: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Key of the first band that each pair shares, 0 where there is none."""
    out = np.zeros(len(i), dtype=keys.dtype)
    for s in range(0, len(i), 1 << 16):
        part = slice(s, s + (1 << 16))
        same = keys[i[part]] == keys[j[part]]
        out[part] = np.where(same.any(axis=1), keys[i[part], same.argmax(axis=1)], 0)
    return out


def jaccard(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact Jaccard indexes of the pairs (i, j), by products of 0/1 matrices over the shingles that two sets share."""
    sizes = np.array([len(s) for s in sets])
    used = np.unique(np.concatenate([i, j]))
    row = np.full(len(sets), -1)
    row[used] = np.arange(len(used))
    vocab, code, seen = np.unique(np.concatenate([sets[u] for u in used]), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(used)), sizes[used])
    common = np.cumsum(seen > 1) - 1
    keep = (seen > 1)[code]
    code, owner = common[code[keep]], owner[keep]
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    both = np.zeros((len(used), len(used)), dtype=np.float32)
    width = 4096
    for lo in range(0, int(common[-1]) + 1 if len(common) else 0, width):
        a, b = np.searchsorted(code, [lo, lo + width])
        part = np.zeros((len(used), width), dtype=np.float32)
        part[owner[a:b], code[a:b] - lo] = 1
        both += part @ part.T
    met = both[row[i], row[j]].astype(np.float64)
    return met / (sizes[i] + sizes[j] - met)


def _stars(n: int, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """Each linked row with the first row of its component, but for that row itself."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return [(x, find(x)) for x in range(n) if find(x) != x]


def _link_task(threshold: float, scheme: Bands):
    def links(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("set_id", ignore_index=True)
        ids, side = block["set_id"].to_numpy(), block["chunk"].to_numpy()
        sets = [np.frombuffer(x, dtype="<u8").astype(U64) for x in block["shingles"]]
        at = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int64)
        values = scheme.values(np.concatenate(sets), at)
        if scheme.tolerance is None:
            i, j = pairs_in_bands(scheme.keys(values), side)
        else:
            i, j = candidate_pairs(values, side, threshold, scheme.tolerance)
        if block["banded"][0]:
            own = first_shared(scheme.keys(values), i, j) == np.int64(block["grp"][0]).view(U64)
            i, j = i[own], j[own]
        if len(i):
            keep = jaccard(sets, i, j) >= threshold - 1e-12
            i, j = i[keep], j[keep]
        n = np.bincount(np.concatenate([i, j]), minlength=len(ids))
        tree = _stars(len(ids), i, j)
        linked = np.flatnonzero(n)
        return pd.DataFrame(
            {
                "a": np.concatenate([ids[linked], [ids[a] for a, _ in tree]]).astype(np.int64),
                "b": np.concatenate([ids[linked], [ids[b] for _, b in tree]]).astype(np.int64),
                "n": np.concatenate([n[linked], np.zeros(len(tree))]).astype(np.int64),
            }
        )

    return links


def _chunked(members: DataFrame, banded: bool) -> DataFrame:
    """members (set_id, grp) with a chunk of its group for each."""
    per = F.least(F.greatest(F.ceil(F.col("n") / CHUNKS), F.lit(LEAST_CHUNK)), F.lit(MOST_CHUNK))
    sizes = members.groupBy("grp").agg(F.count("*").alias("n")).select("grp", F.ceil(F.col("n") / per).cast("int").alias("chunks"))
    return members.join(sizes, "grp").select(
        "set_id", F.struct("grp", F.lit(banded).alias("banded"), F.expr("cast(pmod(xxhash64(set_id), chunks) as int)").alias("chunk"), "chunks").alias("block")
    )


def similar_sets(texts: DataFrame, reps: DataFrame, threshold: float, scheme: Bands, giant: int = GIANT) -> DataFrame:
    """Links among candidate sets.

    texts: doc_id, mark, text; reps: a written table of set_id, doc_id, mark, bands. Returns rows (a, a, number
    of links) and (a, b, 0), the latter a star for each component of a block.
    """
    met = reps.select("set_id", F.explode("bands").alias("band"))
    bands = written(met.groupBy("band").agg(F.min("set_id").alias("least"), F.max("set_id").alias("most")).where("least < most").select("band", "least"))
    stars = written(met.join(bands, "band").where("set_id > least").select(F.col("set_id").alias("a"), F.col("least").alias("b")).distinct())
    groups = written(components(stars).select(F.col("node").alias("set_id"), F.col("component").alias("grp")))
    sizes = written(groups.groupBy("grp").agg(F.count("*").alias("n")).where(F.col("n") > giant).select("grp"))
    blocks = _chunked(groups.join(sizes, "grp", "left_anti"), False)
    if sizes.limit(1).count():
        apart = written(met.join(groups.join(sizes, "grp", "left_semi"), "set_id").join(bands, "band").select("set_id", F.col("band").alias("grp")))
        blocks = blocks.union(_chunked(apart, True))
    members = written(blocks.groupBy("set_id").agg(F.collect_list("block").alias("blocks")))  # a set's blocks, at most one for each band
    asked = written(reps.select("set_id", "doc_id", "mark").join(members.select("set_id"), "set_id", "left_semi"))
    if asked.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        asked = F.broadcast(asked)
    sets = (
        texts.join(asked, ["doc_id", "mark"]).select("set_id", "text").join(members, "set_id").select("set_id", "blocks", "text").dropDuplicates(["set_id"])
        .mapInArrow(_shingle_sets, f"set_id long, blocks {_BLOCKS}, shingles binary")
    )
    dealt = sets.select("set_id", "shingles", F.explode("blocks").alias("b")).select("set_id", "shingles", "b.*")
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return dealt.groupBy("grp", "banded", F.least("chunk", "other").alias("c1"), F.greatest("chunk", "other").alias("c2")).applyInPandas(_link_task(threshold, scheme), "a long, b long, n long")


def _numbered_sets(feats: DataFrame) -> tuple[Column, DataFrame]:
    """The number of a row's shingle set, and the written sets: set_id, row (one that has it), doc_id (the least) and n_copies.

    Of n sets about n^2 / 2^65 numbers would be shared; these come to the driver and give way to others.
    """
    number, tries = F.xxhash64("n_shingles", "sum1", "sum2"), 0
    parts = ("n_shingles", "sum1", "sum2")
    while True:
        same = feats.where("doc_id is not null and n_shingles > 0").groupBy(number.alias("set_id"))
        ends = [f(c).alias(f"{c}_{k}") for c in parts for k, f in ((0, F.min), (1, F.max))]
        sets = written(same.agg(F.min("row").alias("row"), F.min("doc_id").alias("doc_id"), F.count("*").alias("n_copies"), *ends))
        shared = [r[0] for r in sets.where(" or ".join(f"{c}_0 <> {c}_1" for c in parts)).select("set_id").collect()]
        if not shared:
            return number, sets.select("set_id", "row", "doc_id", "n_copies")
        tries += 1
        number = F.when(number.isin(shared), F.xxhash64(F.lit(tries), "sum2", "sum1", "n_shingles")).otherwise(number)


def classed(docs: DataFrame, threshold: float = THRESHOLD, scheme: Bands = PRUNED, giant: int = GIANT) -> DataFrame:
    """near_duplicates with mark, the hash of a row's text, and grp, a number of its class (null without shingles or doc_id)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    feats = written(
        texts.mapInArrow(_features_task(scheme), "doc_id long, mark long, n_shingles long, sum1 long, sum2 long, bands array<long>").withColumn("row", F.monotonically_increasing_id())
    )
    number, sets = _numbered_sets(feats)
    reps = written(feats.join(sets.select("row", "set_id"), "row").select("set_id", "doc_id", "mark", "bands"))
    links = written(similar_sets(texts, reps, threshold, scheme, giant))
    counts = links.where("n > 0").groupBy(F.col("a").alias("set_id")).agg(F.sum("n").alias("n_links"))
    linked = written(components(links.where("n = 0").select("a", "b")).select(F.col("node").alias("set_id"), F.col("component").alias("grp")))
    least = linked.join(sets, "set_id").groupBy("grp").agg(F.min("doc_id").alias("class_id"))
    classes = written(linked.join(least, "grp"))
    labelled = written(
        sets.join(counts, "set_id", "left").join(classes, "set_id", "left")
        .select("set_id", F.coalesce("grp", "set_id").alias("grp"), F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_copies")
    )
    own = F.when(F.expr("doc_id is not null and n_shingles > 0"), number)
    return feats.select("doc_id", "mark", own.alias("set_id")).join(labelled, "set_id", "left").select(
        "doc_id", "mark", "grp", F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
    )


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, giant: int = GIANT) -> DataFrame:
    """Classes of texts linked by a Jaccard index of their five-word shingle sets of at least threshold.

    Returns for each row of docs: doc_id, class_id (the least doc_id of its class), n_links (links of its
    shingle set to other sets) and n_copies (rows with the same set, itself included).

    A text of one to four words has one shingle, all of them. Null and empty texts have none: each is a
    class of its own with n_links 0, n_copies 1. Rows with null doc_id: null class_id, n_links 0, n_copies
    1. Equal rows are copies of each other; rows of one doc_id with different texts are judged each by its
    text. A very long text is one step of a task (see textarrays), its set one row of a block. Other columns
    are ignored; an empty table gives an empty one.
    """
    return classed(docs, threshold, PRUNED, giant).select("doc_id", "class_id", "n_links", "n_copies")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs without all but one of each class, the one with the least doc_id, then the least hash of its text.

    Rows with null doc_id, null or empty text stay; of rows with one doc_id and text one stays.
    """
    with tables(docs.sparkSession):
        rows = written(classed(docs, threshold).where("grp is not null").groupBy("grp", "doc_id", "mark").count())
        kept = rows.groupBy("grp").agg(F.min(F.struct("doc_id", "mark")).alias("kept")).select("grp", "kept.*")
        gone = outside(rows.join(kept, ["grp", "doc_id", "mark"], "left_anti").select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")))  # the smaller side by far
        again = outside(rows.where("count > 1").join(kept, ["grp", "doc_id", "mark"], "left_semi").select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")))
    named = docs.select(F.struct(*columns_of(docs)).alias("_row"), F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_mark"))
    out = named.join(gone, ["_id", "_mark"], "left_anti")
    if again.limit(1).count():
        one = out.join(again, ["_id", "_mark"], "left_semi").dropDuplicates(["_id", "_mark"])
        out = out.join(again, ["_id", "_mark"], "left_anti").unionByName(one)
    return out.select("_row.*")


#: The definition in DuckDB: Jaccard indexes of all sets that share a shingle.
SQL = r"""
WITH RECURSIVE doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^ 	-
]+'), []) AS w FROM documents),
shingled AS (SELECT r, doc_id, list_sort(list_distinct([array_to_string(w[k:k + 4], ' ') FOR k IN range(1, greatest(len(w) - 3, 2))])) AS s FROM doc WHERE len(w) > 0 AND doc_id IS NOT NULL),
named AS (SELECT *, md5(array_to_string(s, chr(10))) AS k FROM shingled),
sets AS (SELECT k, len(any_value(s)) AS n, any_value(s) AS s, min(doc_id) AS least, count(*) AS n_copies FROM named GROUP BY k),
piece AS (SELECT k, n, md5(unnest(s)) AS x FROM sets),
pairs AS (SELECT a.k AS k1, b.k AS k2, count(*) AS met, any_value(a.n + b.n) AS total FROM piece a JOIN piece b ON a.x = b.x AND a.k <> b.k GROUP BY a.k, b.k),
links AS (SELECT k1, k2 FROM pairs WHERE met / (total - met) >= 0.8 - 1e-12),
reach AS (SELECT k AS k1, k AS k2 FROM sets UNION SELECT reach.k1, links.k2 FROM reach JOIN links ON links.k1 = reach.k2),
classes AS (SELECT k1 AS k, min(least) AS class_id FROM reach JOIN sets ON sets.k = reach.k2 GROUP BY k1),
counts AS (SELECT k1 AS k, count(*) AS n_links FROM links GROUP BY k1)
SELECT doc.doc_id, coalesce(class_id, doc.doc_id) AS class_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, CAST(coalesce(n_copies, 1) AS BIGINT) AS n_copies
FROM doc LEFT JOIN named USING (r) LEFT JOIN sets USING (k) LEFT JOIN classes USING (k) LEFT JOIN counts USING (k)
"""
