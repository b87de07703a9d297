"""Benchmark decontamination by spaced seeds.

A mask looks at some of the words of a span and ignores the others, so a seed still hits where ignored
words were replaced (Ma et al., "PatternHunter", 2002). Hashes of all masks at all words of the texts
are first held against a bit array of the benchmark's hashes, whose size follows their number (32 MB at
most). What passes is joined with the benchmark's hashes in Spark and the hits of a text and an item are
verified together: the text and the item are laid over each other at all hits, and the words that agree
on nearby diagonals are chained in order. They must be half of the item's words or hold a long passage of
it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.llm.scratch import columns_of, outside, tables, written
from feedmill.llm.textarrays import NOT_ALNUM, U64, int64, mix, pieces, word_hashes

#: Words that a mask looks at. Items of LONG_WORDS words or more have masks of 4 of at most 8 words, shorter ones of 3 of at most 7.
MASKS = (
    (0, 1, 2, 3), (0, 1, 2, 4), (0, 2, 3, 5), (0, 1, 4, 5), (0, 2, 4, 5),
    (0, 1, 6, 7), (0, 3, 4, 7), (0, 2, 5, 7), (0, 3, 5, 7), (0, 1, 5, 7), (0, 3, 6, 7), (0, 2, 6, 7),
)
SHORT_MASKS = ((0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 1, 4), (0, 2, 4), (0, 3, 4), (0, 1, 5), (0, 2, 5), (0, 3, 5), (0, 4, 5), (0, 1, 6))
LONG_WORDS = 15
#: Items with fewer words are found where all of their words stand in a row.
LEAST_WORDS = 8
#: Share of an item's words that a text must hold in order.
OVERLAP = 0.5
#: A passage of an item also counts if so many more of its words are held in order than not.
PASSAGE = 20
#: Bits of the filter for each seed, and the size that it has at most, as a power of 2: 32 MB.
BITS_A_SEED, MOST_FILTER_BITS = 128, 28


def masks_of(n: int) -> tuple[tuple[int, ...], ...]:
    """The masks of an item of n words."""
    if n < LEAST_WORDS:
        return (tuple(range(n)),)
    return MASKS if n >= LONG_WORDS else SHORT_MASKS


def seed_hashes(words: np.ndarray, at: np.ndarray, masks: Iterable[tuple[int, ...]]) -> Iterator[tuple[tuple[int, ...], np.ndarray, np.ndarray]]:
    """For each mask the words at which it fits into a text, and its hashes there."""
    n = len(words)
    end = np.repeat(at[1:], np.diff(at))
    for mask in masks:
        where = np.flatnonzero(np.arange(n) + mask[-1] < end)
        if not len(where):
            continue
        total = np.full(n - mask[-1], U64(sum(1 << j for j in mask)))
        for j in mask:
            total *= U64(0xC6A4A7935BD1E995)
            total ^= words[j : n - mask[-1] + j]
        yield mask, where, mix(total[where])


def _lower_words(column: pa.Array):
    import pyarrow.compute as pc

    for lo, hi, data, off in pieces(pc.utf8_lower(pc.fill_null(column, ""))):
        yield lo, hi, *word_hashes(data, off, NOT_ALNUM)


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(seed, item_id, place) of every seed of the items."""
    every = sorted({*MASKS, *SHORT_MASKS, *(masks_of(n)[0] for n in range(1, LEAST_WORDS))})
    for batch in batches:
        ids = batch.column(0)
        for lo, _, words, at in _lower_words(batch.column(1)):
            n = np.diff(at)
            row = np.repeat(np.arange(len(n)), n)
            for mask, where, hashes in seed_hashes(words, at, every):
                fits = np.array([mask in masks_of(k) for k in n.tolist()], dtype=bool)[row[where]]
                where, hashes = where[fits], hashes[fits]
                r = row[where]
                yield pa.record_batch([int64(hashes), ids.take(pa.array(r + lo)), pa.array(where - at[r])], ["seed", "item_id", "place"])


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, words, at in _lower_words(batch.column(1)):
            yield pa.record_batch([batch.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), int64(words))], ["item_id", "item"])


def _text_hits_task(table, masks: list[tuple[int, ...]], reach: int):
    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each text with hits: its word hashes around them (from first on) and the hits (seed, word)."""
        known = table.value
        bits = int(known.size * 8).bit_length() - 1
        for batch in batches:
            ids = batch.column(0)
            for lo, _, words, at in _lower_words(batch.column(1)):
                seeds, places = [], []
                for _, where, hashes in seed_hashes(words, at, masks):
                    for shift in _shifts(bits):
                        slot = (hashes >> U64(shift)) & U64((1 << bits) - 1)
                        ok = (known[slot >> U64(3)] >> (slot & U64(7)).astype(np.uint8)) & np.uint8(1) > 0
                        where, hashes = where[ok], hashes[ok]
                    seeds.append(hashes)
                    places.append(where)
                if not seeds or not sum(map(len, seeds)):
                    continue
                seed, place = np.concatenate(seeds), np.concatenate(places)
                order = np.argsort(place, kind="stable")
                seed, place = seed[order], place[order]
                doc = np.searchsorted(at, place, "right") - 1
                # hits of one text at most reach words apart are one region
                new = np.ones(len(place), dtype=bool)
                new[1:] = (doc[1:] != doc[:-1]) | (place[1:] - place[:-1] > reach)
                head = np.flatnonzero(new)
                tail = np.append(head[1:], len(place)) - 1
                first = np.maximum(place[head] - reach, at[doc[head]])
                stop = np.minimum(place[tail] + reach, at[doc[head] + 1])
                spans = np.concatenate(([0], np.cumsum(stop - first)))
                around = np.concatenate([words[a:b] for a, b in zip(first, stop, strict=True)])
                cuts = pa.array(np.append(head, len(place)).astype(np.int32))
                yield pa.record_batch(
                    [
                        ids.take(pa.array(doc[head] + lo)), pa.array(first - at[doc[head]]),
                        pa.ListArray.from_arrays(pa.array(spans.astype(np.int32)), int64(around)),
                        pa.ListArray.from_arrays(cuts, pa.StructArray.from_arrays([int64(seed), pa.array(place - at[doc])], ["seed", "word"])),
                    ],
                    ["doc_id", "first", "around", "hits"],
                )

    return hits


def _shifts(bits: int) -> tuple[int, int, int]:
    """Where the three numbers of a hash stand whose bits must all be set."""
    return 64 - bits, max(64 - 2 * bits, 0), 0


def _filter_of(seeds: DataFrame) -> np.ndarray:
    """Bit array with three bits for each seed, of BITS_A_SEED bits for each but 2^MOST_FILTER_BITS at most.

    The tasks put the bits of 64 neighbours together, so the driver sees at most 2^22 rows.
    """
    bits = min(MOST_FILTER_BITS, max(16, (BITS_A_SEED * seeds.count()).bit_length()))
    slots = F.array(*[F.shiftrightunsigned("seed", s).bitwiseAND(F.lit((1 << bits) - 1)).cast("int") for s in _shifts(bits)])
    slot = seeds.select(F.explode(slots).alias("slot"))
    cells = slot.groupBy(F.shiftright("slot", 6).alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, slot & 63)")).alias("bits")).toPandas()
    out = np.zeros(1 << (bits - 6), dtype="<u8")
    out[cells["cell"].to_numpy()] = cells["bits"].to_numpy(dtype=np.int64).view(np.uint64)
    return out.view(np.uint8)


def _same(item: np.ndarray, around: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each offset of the item in the text, which of the item's words lie on the same words."""
    n = len(item)
    known = np.zeros(len(around) + 2 * n, dtype=bool)
    known[n : n + len(around)] = True
    padded = np.zeros(len(known), dtype=around.dtype)
    padded[n : n + len(around)] = around
    out = np.empty((len(offsets), n), dtype=bool)
    step = max(1, (1 << 20) // n)
    for k in range(0, len(offsets), step):
        at = offsets[k : k + step] + n
        out[k : k + step] = (np.lib.stride_tricks.sliding_window_view(padded, n)[at] == item) & np.lib.stride_tricks.sliding_window_view(known, n)[at]
    return out


def chained(same: np.ndarray, offsets: np.ndarray) -> tuple[int, int]:
    """The most item words that lie in order on the text's words, and the most that a passage of the item has of them less its others.

    same has a row for each offset (ascending). A word of the text counts once.
    """
    n = same.shape[1]
    if len(offsets) == 1:
        steps = np.concatenate(([0], np.cumsum(np.where(same[0], 1, -1))))
        return int(same.sum()), int((steps - np.minimum.accumulate(steps)).max())
    # at t: the best chain over the words of the text before t and the words of the item so far
    whole = np.zeros(offsets[-1] - offsets[0] + n + 1, dtype=np.int64)
    passage, top = whole.copy(), 0
    for i in range(n):
        at = (offsets - offsets[0] + i)[same[:, i]]
        more, longer = whole[at] + 1, passage[at] + 1
        passage = np.maximum(passage - 1, 0)
        if len(at):
            whole[at + 1] = np.maximum(whole[at + 1], more)
            passage[at + 1] = np.maximum(passage[at + 1], longer)
            np.maximum.accumulate(whole, out=whole)
            np.maximum.accumulate(passage, out=passage)
            top = max(top, int(passage[-1]))
    return int(whole[-1]), top


def _verify_task(overlap: float, least: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(doc_id, item_id, first_word, n_match, share) of the groups of nearby diagonals that have enough words."""
        for batch in batches:
            doc, item_id, firsts, around, starts, items = batch.columns
            rows = []
            for r in range(batch.num_rows):
                first, item, text, start = firsts[r].as_py(), *(c[r].values.to_numpy() for c in (items, around, starts))
                n = len(item)
                if n < LEAST_WORDS:  # the seed was the whole item
                    rows.append((r, int(start[0]), n, 1.0))
                    continue
                # diagonals at most the item's length apart are one group
                for group in np.split(start, np.flatnonzero(np.diff(start) > n) + 1):
                    same = _same(item, text, group - first)
                    if same.any(0).sum() < min(overlap * n, least):
                        continue
                    n_match, top = chained(same, group)
                    if n_match / n >= overlap or top >= least:
                        rows.append((r, int(group[same.sum(1).argmax()]), n_match, n_match / n))
            r, first_word, n_match, share = zip(*rows, strict=True) if rows else ((),) * 4
            r = pa.array(r, pa.int64())
            yield pa.record_batch(
                [doc.take(r), item_id.take(r), pa.array(first_word, pa.int64()), pa.array(n_match, pa.int64()), pa.array(share, pa.float64())],
                ["doc_id", "item_id", "first_word", "n_match", "share"],
            )

    return verify


def contamination(docs: DataFrame, benchmark: DataFrame, overlap: float = OVERLAP, passage: int = PASSAGE) -> DataFrame:
    """Texts that hold a benchmark item, up to replaced, added and dropped words: one row for each text and item.

    Returns doc_id, item_id, first_word (where the item's first word lies or would lie in the text, by the
    diagonal with most words, then the first), n_match (words in order) and share (of the item's words).
    Diagonals with a seed that are at most the item's length apart are added up; each word of the text counts
    once. The share is at least overlap, or a passage of the item has at least passage more words in order
    than others. Words are runs of letters and digits in lower case. Where an item is found more than once in a
    text, the best place counts, then the first.

    A text and an item must agree in the words of one mask. Items of 8 to 14 words do wherever half of their
    words stand in place; of longer ones with half of their words replaced, 0.97 do. Items of fewer than 8
    words are found where all of their words stand in a row. Left out are null and empty texts, items without
    a word and rows with null ids. Equal rows are one text. A very long text is one step of a task (see
    textarrays). Other columns are ignored. Empty tables give an empty one. A passage that many items share is
    found with each of them.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null").distinct()
    seeds = written(items.mapInArrow(_item_seeds, "seed long, item_id long, place long"))
    item_words = written(items.mapInArrow(_item_words, "item_id long, item array<long>"))
    reach = 2 * (item_words.agg(F.max(F.size("item"))).first()[0] or 0)  # words on either side of a hit that a verification can need
    table = spark.sparkContext.broadcast(_filter_of(seeds))
    sizes = [r[0] for r in item_words.select(F.least(F.size("item"), F.lit(LONG_WORDS)).alias("n")).where("n > 0").distinct().collect()]
    masks = sorted({m for n in sizes for m in masks_of(n)})
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    regions = written(texts.mapInArrow(_text_hits_task(table, masks, reach), "doc_id long, first long, around array<long>, hits array<struct<seed: long, word: long>>").withColumn("region", F.xxhash64("doc_id", "first", "around")))
    hits = regions.select("doc_id", "region", F.explode("hits").alias("h")).select("doc_id", "region", "h.seed", "h.word")
    laid = written(hits.join(seeds, "seed").groupBy("doc_id", "region", "item_id").agg(F.sort_array(F.collect_set(F.col("word") - F.col("place"))).alias("starts")))
    met = laid.join(regions.select("doc_id", "region", "first", "around").dropDuplicates(["doc_id", "region"]), ["doc_id", "region"]).join(item_words, "item_id")
    # the text's words at the places of the item's, from the first diagonal to the last
    skip = F.greatest(F.col("starts")[0] - F.col("first"), F.lit(0))
    length = F.element_at("starts", -1) + F.size("item") - F.col("first") - skip
    cut = met.select("doc_id", "item_id", (F.col("first") + skip).alias("first"), F.slice("around", (skip + 1).cast("int"), length.cast("int")).alias("around"), "starts", "item")
    scored = cut.mapInArrow(_verify_task(overlap, passage), "doc_id long, item_id long, first_word long, n_match long, share double")
    best = scored.groupBy("doc_id", "item_id").agg(F.max(F.struct("n_match", (-F.col("first_word")).alias("back"), "share")).alias("b"))
    return best.select("doc_id", "item_id", (-F.col("b.back")).alias("first_word"), "b.n_match", "b.share")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, overlap: float = OVERLAP) -> DataFrame:
    """The rows of docs whose text holds no benchmark item, unchanged, whatever their other columns are called.

    Rows with null doc_id or text stay, empty texts too. Of rows with one doc_id all go if one text of them
    holds an item; equal rows go or stay together. An empty benchmark drops nothing.
    """
    with tables(docs.sparkSession):
        found = outside(contamination(docs, benchmark, overlap).select("doc_id").distinct())
    return docs.join(found, "doc_id", "left_anti").select(*columns_of(docs))
