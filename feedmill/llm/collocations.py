"""Phrase collocations from count streams in prefix and suffix order, merged in lockstep.

Counting goes by length. Every part of a phrase is at least as frequent as the phrase, so texts are read once for words,
once for pairs of words that are frequent enough, and once for longer phrases of such pairs; a bit array of
bounded size says which may be (what it lets through by chance is counted and dropped). A task counts by sorting
numbers of words of its own, Spark adds up.

The frequent phrases are then a stream of counts, kept in two orders. In prefix order a phrase stands after the
phrases that it begins with and before no other, so one pass with the last count of each length in hand gives the
counts of all its first parts, and each phrase's most frequent extension to the right. In suffix order, of the words in
reverse, the same pass gives the counts of last parts and the extensions to the left. Both streams, sorted by phrase,
merge in lockstep. The passes are sorts by ranges over all tasks and folds over sorted batches: nothing is looked up by
a hash, and a word that begins a third of all phrases is spread over tasks. Where a task begins in the middle of such
a run, the first parts it doesn't see, one of each length at most, are put in afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.llm.ordinals import shifts, sorted_table, task
from feedmill.llm.scratch import written
from feedmill.llm.textarrays import U64, hash_ranges, int64, mix, pieces, word_bounds

LEAST, LONGEST, TOP, ABSORBED = 30, 4, 2000, 80
#: Score of a phrase whose parts never occur without it.
SCALE = 2_000_000
NO_LANG = "und"
#: Bytes of text that one step of a task counts.
STEP_BYTES = 8 << 20
#: Bits of the filter for each frequent phrase, and the size that it has at most, as a power of 2: 32 MB.
BITS_A_PHRASE, MOST_FILTER_BITS = 32, 28
_OUT_ROWS = 1 << 16

#: Marks that end a piece, and white space inside one.
_BREAKS = np.zeros(256, dtype=bool)
_BREAKS[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
_SEPARATORS = _BREAKS.copy()
_SEPARATORS[[9, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def _mixed(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(h * U64(0x9E3779B97F4A7C15) + word)


def _hashes(strings: pa.Array) -> np.ndarray:
    """A hash of each string of an array, whatever bytes it holds."""
    strings = strings.cast(pa.large_string())
    offsets = np.frombuffer(strings.buffers()[1], dtype=np.int64)[strings.offset : strings.offset + len(strings) + 1]
    data = np.frombuffer(strings.buffers()[2], dtype=np.uint8) if strings.buffers()[2] is not None else np.zeros(0, np.uint8)
    return hash_ranges(data, offsets[:-1], offsets[1:])


class _Step:
    """The words of some texts: code (in words), lang (in langs), and whether the next word stands in the same piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: pa.DictionaryArray) -> None:
        data = _LOWER[data]
        starts, ends, at = word_bounds(data, offsets, _SEPARATORS)
        size = np.concatenate(([0], np.cumsum(ends - starts)))
        words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(size.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[~_SEPARATORS[data]]))])
        coded = words.dictionary_encode()
        self.words, self.code = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        self.langs = langs.dictionary
        counts = np.diff(at)
        self.lang = np.repeat(langs.indices.to_numpy().astype(np.int64), counts)
        piece = np.cumsum(_BREAKS[data], dtype=np.int32)[starts] if len(starts) else np.zeros(0, np.int32)
        text = np.repeat(np.arange(len(counts)), counts)
        self.joined = np.zeros(len(starts), dtype=bool)
        self.joined[:-1] = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])

    def frequent(self, size: int, bits: np.ndarray) -> np.ndarray:
        """Whether a phrase of so many words begins at each word that the filter knows."""
        words = _hashes(self.words)[self.code]
        h, whole = _hashes(self.langs)[self.lang], np.ones(len(words), dtype=bool)
        for k in range(size):
            if k:
                whole[len(words) - k :] = False
                whole[: len(words) - k] &= self.joined[k - 1 : len(words) - 1]
            h = _mixed(h, np.roll(words, -k))
        at = np.flatnonzero(whole)
        known = np.ones(len(at), dtype=bool)
        for slot in _slots(h[at], int(bits.size * 8).bit_length() - 1):
            known &= (bits[slot >> U64(3)] >> (slot & U64(7)).astype(np.uint8)) & 1 == 1
        whole[at] = known
        return whole

    def counts(self, low: int, high: int, bits: np.ndarray | None) -> Iterator[tuple[pa.Array, pa.Array, np.ndarray]]:
        """(lang, phrase, count) of the phrases of low to high words whose parts of low - 1 words the filter knows."""
        n, wide = len(self.code), len(self.words)
        if not n:
            return
        valid = self.frequent(low - 1, bits) if bits is not None else np.ones(n, dtype=bool)
        key = self.lang
        for k in range(1, high + 1):
            # the number of the phrase of k words that begins at each word
            if k > 2 or wide * wide * len(self.langs) >= 1 << 62:
                key = np.unique(key, return_inverse=True)[1]
            key = key * wide + np.roll(self.code, 1 - k)
            if k < low:
                continue
            if k > 1:
                valid = valid & np.concatenate((valid[1:], [False])) if low > 2 or k > 2 else valid & self.joined & np.concatenate((valid[1:], [False]))
            at = np.flatnonzero(valid)
            _, first, count = np.unique(key[at], return_index=True, return_counts=True)
            first = at[first]
            for lo in range(0, len(first), _OUT_ROWS):
                here = first[lo : lo + _OUT_ROWS]
                parts = [self.words.take(pa.array(self.code[here + j])) for j in range(k)]
                yield self.langs.take(pa.array(self.lang[here])), pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())).cast(pa.string()), count[lo : lo + _OUT_ROWS]


def _count_task(low: int, high: int, table):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = table.value if table else None
        for batch in batches:
            langs = batch.column(1).dictionary_encode()
            for lo, hi, data, offsets in pieces(batch.column(0), STEP_BYTES):
                step = _Step(data, offsets, langs.slice(lo, hi - lo))
                for lang, phrase, n in step.counts(low, high, bits):
                    yield pa.record_batch([lang, phrase, pa.array(n, pa.int64())], ["lang", "phrase", "n"])
                if low == 1 and len(step.lang):
                    n = np.bincount(step.lang, minlength=len(step.langs))
                    yield pa.record_batch([step.langs, pa.nulls(len(n), pa.string()), pa.array(n, pa.int64())], ["lang", "phrase", "n"])

    return count


def _slots(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return h >> U64(64 - bits), h & U64((1 << bits) - 1)


def _filter_of(phrases: DataFrame) -> np.ndarray:
    """Bit array with two bits for each phrase (lang, phrase). The tasks put 64 neighbours together, so the driver sees at most 2^22 rows."""
    bits = min(MOST_FILTER_BITS, max(16, (BITS_A_PHRASE * phrases.count()).bit_length()))

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = pc.split_pattern(batch.column(1), " ")
            h = _hashes(batch.column(0))
            for k in range(len(words[0]) if len(words) else 0):  # phrases of a table are equally long
                h = _mixed(h, _hashes(pc.list_element(words, k)))
            yield pa.record_batch([int64(np.concatenate(_slots(h, bits)))], ["slot"])

    flat = phrases.select("lang", "phrase").mapInArrow(slots, "slot long")
    cells = flat.groupBy(F.shiftright("slot", 6).alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits")).toPandas()
    out = np.zeros(1 << (bits - 6), dtype="<u8")
    out[cells["cell"].to_numpy()] = cells["bits"].to_numpy(dtype=np.int64).view(np.uint64)
    return out.view(np.uint8)


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, a) of all phrases of 1 to longest words that occur least times, and (lang, n), all words of a language."""
    texts = docs.select("text", F.coalesce("lang", F.lit(NO_LANG)).alias("lang"))
    found, table = [], None
    for low, high in ((1, 1), (2, 2), (3, longest)):
        if low > longest:
            break
        if found:
            table = docs.sparkSession.sparkContext.broadcast(_filter_of(found[-1]))
        parts = texts.mapInArrow(_count_task(low, high, table), "lang string, phrase string, n long")
        counted = written(parts.groupBy("lang", "phrase").agg(F.sum("n").alias("a")).where(F.col("phrase").isNull() | (F.col("a") >= least)))
        if low == 1:
            totals = counted.where("phrase is null").select("lang", F.col("a").alias("n"))
        found.append(counted.where("phrase is not null"))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every, totals


def _walk_task(longest: int):
    """Fold over phrases (lang, w, a) in order: the counts of the phrases that each begins with, and of each one's most frequent extension."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.full(longest, -1, dtype=np.int64)  # the last count of each length
        for batch in batches:
            lang, w, a = batch.columns
            size, f, every = pc.list_value_length(w).to_numpy(), a.to_numpy(), np.arange(batch.num_rows)
            last = [np.maximum.accumulate(np.where(size == k, every, -1)) if len(every) else every for k in range(1, longest)]
            parts = [np.where(at >= 0, f[at], held[k]) for k, at in enumerate(last)]
            whole = np.flatnonzero(size > 1)
            columns = [lang.take(pa.array(whole)), w.take(pa.array(whole)), a.take(pa.array(whole))]
            columns += [pa.array(p[whole], mask=(p[whole] < 0) | (size[whole] <= k + 1)) for k, p in enumerate(parts)]
            yield pa.record_batch([*columns, pa.nulls(len(whole), pa.int64())], names)
            for m in range(3, longest + 1):
                rows = np.flatnonzero(size == m)
                if len(rows):
                    of = last[m - 2][rows]
                    first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
                    one = pa.array(rows[first])
                    none = pa.nulls(len(first), pa.int64())
                    yield pa.record_batch([lang.take(one), pc.list_slice(w.take(one), 0, m - 1), *[none] * longest, pa.array(np.maximum.reduceat(f[rows], first))], names)
            for k, at in enumerate(last):
                if len(at) and at[-1] >= 0:
                    held[k] = f[at[-1]]

    names = ["lang", "w", "a", *[f"l{k}" for k in range(1, longest)], "extended"]
    return walk


def _walked(phrases: DataFrame, longest: int) -> DataFrame:
    """phrases (lang, w, a) with l1, l2 ...: the counts of their first words; and rows of (lang, w, extended)."""
    schema = "lang string, w array<string>, a long, " + "".join(f"l{k} long, " for k in range(1, longest)) + "extended long"
    out = written(phrases.repartitionByRange("lang", "w").sortWithinPartitions("lang", "w").mapInArrow(_walk_task(longest), schema))
    for k in range(1, longest):
        # parts that stand in an earlier task: at most one of this length for each task
        unseen = F.col("a").isNotNull() & (F.size("w") > k) & F.col(f"l{k}").isNull()
        lost = out.where(unseen).select("lang", F.slice("w", 1, k).alias("w")).distinct()
        found = phrases.join(F.broadcast(lost), ["lang", "w"]).select(F.col("lang").alias("_lang"), F.col("w").alias("_w"), F.col("a").alias("_a"))
        out = out.join(F.broadcast(found), unseen & (F.col("lang") == F.col("_lang")) & (F.slice("w", 1, k) == F.col("_w")), "left")
        out = out.withColumn(f"l{k}", F.coalesce(f"l{k}", "_a")).drop("_lang", "_w", "_a")
    return out


def _merge_task(names: list[str]):
    """Fold over rows (lang, phrase, numbers) in order: one row for each phrase, with the largest of each number."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if rest is not None:
                batch = pa.concat_batches([rest, batch])
            lang, phrase = batch.column(0), batch.column(1)
            other = pc.or_(pc.not_equal(lang[1:], lang[:-1]), pc.not_equal(phrase[1:], phrase[:-1])).to_numpy(zero_copy_only=False)
            first = np.flatnonzero(np.concatenate(([True], other)))
            values = [np.maximum.reduceat(pc.fill_null(c, -1).to_numpy(), first) for c in batch.columns[2:]]
            whole = pa.record_batch([lang.take(pa.array(first)), phrase.take(pa.array(first)), *[pa.array(v, mask=v < 0) for v in values]], names)
            rest = whole.slice(whole.num_rows - 1)
            yield whole.slice(0, whole.num_rows - 1)
        if rest is not None:
            yield rest

    return merge


def measured(phrases: DataFrame, longest: int = LONGEST) -> DataFrame:
    """Phrases of two words or more (lang, phrase, a) with the counts of their parts: l1, l2 ... of the first words, r1, r2 ... of the last, and extended.

    extended is the count of the most frequent phrase that is one word longer. phrases must hold every part of its phrases.
    """
    w = F.split("phrase", " ")
    lefts, rights = [f"l{k}" for k in range(1, longest)], [f"r{k}" for k in range(1, longest)]
    none = F.lit(None).cast("long")
    prefix = _walked(phrases.select("lang", w.alias("w"), "a"), longest).select("lang", F.array_join("w", " ").alias("phrase"), "a", *lefts, *[none.alias(r) for r in rights], "extended")
    suffix = _walked(phrases.select("lang", F.reverse(w).alias("w"), "a"), longest)
    suffix = suffix.select("lang", F.array_join(F.reverse("w"), " ").alias("phrase"), "a", *[none.alias(x) for x in lefts], *[F.col(x).alias(r) for x, r in zip(lefts, rights, strict=True)], "extended")
    names = ["lang", "phrase", "a", *lefts, *rights, "extended"]
    both = prefix.unionByName(suffix).repartitionByRange("lang", "phrase").sortWithinPartitions("lang", "phrase")
    return both.mapInArrow(_merge_task(names), "lang string, phrase string, " + ", ".join(f"{c} long" for c in names[2:]))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, absorbed: int = ABSORBED) -> DataFrame:
    """The best phrases of each language: lang, rank (from 1), phrase, a, l, r, n, score.

    Texts (text, lang) are lower-cased (A to Z) and fall into pieces at . , ; : ! ? and line ends, pieces into words at
    spaces and tabs. A phrase of 2 to longest words counts if it occurs least times (a). Its score is floor(2000000 a /
    (l + r)), l and r being the counts of its two parts, at the cut that scores lowest, the first of those. n is the number of
    all words of the language. A phrase goes if a longer one that holds it has absorbed percent of its count. Ranks go by
    score, then a, both descending, then phrase.

    A null lang is 'und', also beside texts that say so; null and empty texts have no words. Equal rows count as
    often as they occur. A long text is counted as one step of a task, which needs some 60 bytes for each of its
    bytes. Other columns are ignored; an empty table gives an empty one. All counts are exact, at any size.
    """
    phrases, totals = frequent_phrases(docs, least, longest)
    best = ranked(measured(phrases, longest), longest, top, absorbed)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def ranked(rows: DataFrame, longest: int, top: int, absorbed: int) -> DataFrame:
    """lang, rank, phrase, a, l, r, score of the best phrases among measured ones."""
    m, big = F.size(F.split("phrase", " ")), "decimal(20,0)"
    cuts = []
    for k in range(1, longest):
        rest = F.element_at(F.array(*[F.col(f"r{j}") for j in range(1, longest)]), F.greatest(m - k, F.lit(1)))
        score = F.call_function("div", F.col("a").cast(big) * F.lit(SCALE).cast("decimal(7,0)"), F.col(f"l{k}").cast(big) + rest.cast(big))
        cuts.append(F.when(m > k, F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), rest.alias("r"))))
    best = rows.withColumn("best", F.array_min(F.array(*cuts)))
    kept = best.where(F.col("extended").isNull() | (F.col("extended").cast(big) * 100 < F.col("a").cast(big) * absorbed))
    kept = kept.select("lang", "phrase", "a", "best.l", "best.r", "best.score", (-F.col("best.score")).alias("below"), (-F.col("a")).alias("rarer"))
    placed = sorted_table(kept, "lang", "below", "rarer", "phrase")
    starts = F.broadcast(written(shifts(placed, "lang").drop("total")))  # a row for each language and task at most
    out = placed.withColumn("task", task()).join(starts, ["lang", "task"]).withColumn("rank", F.col("at") + F.col("shift") + 1)
    return out.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "score")


_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: The same in DuckDB: all phrases are counted.
SQL = rf"""
WITH p AS (SELECT coalesce(lang, '{NO_LANG}') AS lang, regexp_extract_all(unnest(string_split_regex({_FOLD}, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM documents),
tot AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
g AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM p, range(1, {LONGEST + 1}) s(m) WHERE len(w) >= m)),
f AS (SELECT lang, phrase, any_value(m) AS m, count(*) AS a FROM g GROUP BY lang, phrase HAVING count(*) >= {LEAST}),
c AS (SELECT lang, phrase, m, a, string_split(phrase, ' ') AS w, k FROM f, range(1, {LONGEST}) s(k) WHERE m > k),
s AS (SELECT c.*, x.a AS l, y.a AS r, CAST(CAST(c.a AS HUGEINT) * {SCALE} // (x.a + y.a) AS BIGINT) AS score FROM c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
u AS (SELECT DISTINCT b.lang, array_to_string(b.w[i:i + m2 - 1], ' ') AS phrase, b.a FROM b, range(2, {LONGEST}) s(m2), range(1, {LONGEST}) t(i) WHERE m2 < b.m AND i + m2 - 1 <= b.m),
kept AS (SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.lang = b.lang AND u.phrase = b.phrase AND 100 * u.a >= {ABSORBED} * b.a)),
o AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, score FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM o JOIN tot USING (lang) WHERE rank <= {TOP}
"""
