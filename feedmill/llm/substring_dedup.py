"""Exact substring deduplication by recompression.

Every text is a sequence of words. Rounds of recompression name the words, replace short runs of one
symbol and then pairs of neighbours by new symbols. A name is a hash of what it stands for, and each
round's names are agreed on in Spark over all texts: where two different things would share one, both get
another (``agree_on_names``). So a symbol stands for one run of words everywhere. Which pairs merge
depends on their names alone (a left symbol has name bit 0, a right one bit 1), so equal substrings get
the same symbols but for a bounded margin at either end (Jez, "Recompression: a simple and powerful
technique").

The rounds are kept few enough that the margin is a proven ``MARGIN`` words and a symbol covers at
most ``SYMBOL`` words: every window of 50 words holds whole symbols that any equal window holds too.
The least of those symbols anchors the window. Windows with one anchor are a block. Spark groups the
blocks by their anchor's symbol and the words that all windows of an anchor share; groups in one document
alone are no repeats. In the others the sequences of names are compared, by a 64-bit BLAKE2b digest within
a group: where all blocks of a group are equal, their windows are; else its windows are compared by
themselves. Only anchors are shuffled, about one for 11 words, and texts by doc_id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.llm.scratch import outside, tables, written
from feedmill.llm.textarrays import SPACES, U64, gram_hashes, gram_prefix, hash_ranges, int64, mix, pieces, ramp, word_bounds

WINDOW = 50
#: Most words of a run that gets a name of its own; longer runs of a word stay as they are, since their ends may lie outside a window.
RUN = 2
#: Rounds of pairs; each doubles the words that a symbol can cover.
PAIR_ROUNDS = 2
SYMBOL = RUN << PAIR_ROUNDS
MARGIN = SYMBOL  # RUN, then RUN, 2 RUN, ... for the rounds of pairs: RUN * 2 ** PAIR_ROUNDS in all
#: Offsets in a window at which its anchor can start.
FIRST, LAST = MARGIN, WINDOW - MARGIN - SYMBOL
#: Words around an anchor that are part of each of its windows: so many before it, so many from it on.
BEFORE, AFTER = FIRST, WINDOW - LAST

#: Levels that one round over the texts names: words, then runs, pairs and pairs of pairs.
ROUNDS = ((0,), tuple(range(1, 2 + PAIR_ROUNDS)))
#: Seed of the second hashes of words.
OTHER = 0x2C1B3C6D
#: Symbols that a task remembers as told, and windows in one step.
TOLD, STEP = 1 << 20, 1 << 18


class Names(NamedTuple):
    """Which names two symbols of the corpus would share, by level: words, runs, then each round of pairs."""

    shared: tuple[np.ndarray, ...] = (np.zeros(0, dtype=U64),) * (2 + PAIR_ROUNDS)

    def settle(self, level: int, names: np.ndarray, other: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The names with those that two symbols would share replaced by other names of the symbols at these places."""
        for name in self.shared[level]:
            at = np.flatnonzero(names == name)
            if len(at):
                names = names.copy()
                names[at] = other(at)
        return names


Made = Callable[[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray], None]


def named_words(data: np.ndarray, off: np.ndarray, names: Names) -> tuple[np.ndarray, np.ndarray]:
    """The name of every word, and each text's offsets among them."""
    starts, ends, at = word_bounds(data, off, SPACES)
    return _named(data, starts, ends, names), at


def _named(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, names: Names) -> np.ndarray:
    return names.settle(0, hash_ranges(data, starts, ends), lambda k: hash_ranges(data, starts[k], ends[k], OTHER))


def recompress(words: np.ndarray, at: np.ndarray, names: Names = Names(), made: Made | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Names of the symbols after all rounds and the word at which each starts. at: each text's offsets among the words.

    made is told of the symbols that each level makes: level, places, names, and the two things that each name stands for.
    """
    n = len(words)
    first = np.zeros(n + 1, dtype=bool)
    first[at] = True  # no symbol crosses into another text
    starts, symbols = np.arange(n), words
    # runs of one word, as long as RUN in all
    same = np.zeros(n + 1, dtype=bool)
    same[1:n] = (symbols[1:] == symbols[:-1]) & ~first[1:n]
    head = np.flatnonzero(~same[:n])
    length = np.diff(np.append(head, n))
    short = head[(length > 1) & (length <= RUN)]
    if len(short):
        runs = length[(length > 1) & (length <= RUN)]
        keep = np.ones(n, dtype=bool)
        for k in range(1, RUN):
            keep[short[runs > k] + k] = False
        one, many = words[short], runs.astype(U64)
        fresh = names.settle(1, mix(one + many * U64(0x8CB92BA72F3D8DD7)), lambda k: mix(mix(one[k]) ^ many[k]))
        if made:
            made(1, starts[short], fresh, one, many)
        symbols = symbols.copy()
        symbols[short] = fresh
        starts, symbols = starts[keep], symbols[keep]
    for r in range(PAIR_ROUNDS):
        side = (mix(symbols + U64(r + 1)) >> U64(63)).astype(bool)
        left = np.flatnonzero(~side[:-1] & side[1:] & ~first[starts[1:]])
        keep = np.ones(len(symbols), dtype=bool)
        keep[left + 1] = False
        one, two = symbols[left], symbols[left + 1]
        fresh = names.settle(2 + r, mix(one * U64(0xAEF17502108EF2D9) + two + U64(r + 1)), lambda k, a=one, b=two: mix(mix(a[k]) + b[k]))
        if made:
            made(2 + r, starts[left], fresh, one, two)
        symbols = symbols.copy()
        symbols[left] = fresh
        starts, symbols = starts[keep], symbols[keep]
    return starts, symbols


def _made_task(names: Names, levels: tuple[int, ...]):
    """The symbols that some levels make, each at least once in a task: name, and a hash of what it stands for with the level in its last bits.

    Words of up to seven bytes have names of their own by construction. What a longer word's name stands for is
    told by a second hash and the word's length. Runs and pairs are told of where they are part of an anchor.
    """

    def symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = np.zeros((2, TOLD), dtype=U64)  # symbols that this task told of lately

        def fresh(level: int, name: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            stands_for = (mix(mix(a) * U64(0xD6E8FEB86659FD93) + b) << U64(2)) | U64(level)
            slot = (name & U64(TOLD - 1)).astype(np.int64)
            new = (told[0, slot] != name) | (told[1, slot] != stands_for)
            told[0, slot], told[1, slot] = name, stands_for
            return pa.record_batch([int64(name[new]), int64(stands_for[new])], ["name", "stands_for"])

        for batch in batches:
            for _, _, data, off in pieces(batch.column(0)):
                starts, ends, at = word_bounds(data, off, SPACES)
                words = _named(data, starts, ends, names)
                if 0 in levels:
                    long = np.flatnonzero(ends - starts > 7)
                    yield fresh(0, words[long], hash_ranges(data, starts[long], ends[long], OTHER), (ends - starts)[long].astype(U64))
                    continue
                out: list[tuple] = []
                _, _, anchor, _ = anchors(words, at, names, lambda *made, o=out: o.append(made))
                part = np.zeros(len(words) + SYMBOL, dtype=bool)
                for k in range(SYMBOL):  # symbols that start in the next SYMBOL words are told of with the anchor
                    part[anchor + k] = True
                for level, place, *made in out:
                    yield fresh(level, *(x[part[place]] for x in made))

    return symbols


def agree_on_names(texts: DataFrame) -> Names:
    """Name the words, runs and pairs of all texts so that no two different ones share a name.

    A name is a hash of what it stands for, which makes it the same in every task. A round gathers what every
    name of a level stands for, from all texts; where two things share one, both take another name, and the
    round is repeated. Of n symbols about n^2 / 2^63 names are shared, which is what comes to the driver.
    """
    names = Names()
    for levels in ROUNDS:
        while True:
            made = texts.select("text").mapInArrow(_made_task(names, levels), "name long, stands_for long")
            kinds = made.groupBy("name").agg(F.min("stands_for").alias("one"), F.max("stands_for").alias("other"))
            with tables(texts.sparkSession):  # the shuffle of a round is dropped before the next
                clashes = [(max(r.one & 3, r.other & 3), r.name) for r in kinds.where("one <> other").collect()]
            del made, kinds
            if not clashes:
                break
            lowest = min(level for level, _ in clashes)  # the levels above it get new names with it
            more = np.array([name for level, name in clashes if level == lowest], dtype=np.int64).view(U64)
            names = Names(tuple(np.union1d(s, more) if k == lowest else s for k, s in enumerate(names.shared)))
    return names


def anchors(words: np.ndarray, at: np.ndarray, names: Names = Names(), made: Made | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The first window of each block, its number of windows, its anchor's first word and the anchor's name."""
    n = len(words)
    starts, symbols = recompress(words, at, names, made)
    value = np.full(n + WINDOW, np.iinfo(np.uint64).max, dtype=U64)
    value[starts] = mix(symbols ^ U64(0x5851F42D4C957F2D)) >> U64(1)
    # the leftmost least value among the offsets FIRST..LAST of every window, by doubling
    span, width, best = LAST - FIRST + 1, 1, np.arange(n + WINDOW)
    while width < span:
        step = min(width, span - width)
        ahead = best[step:]
        best = np.where(value[best[: len(ahead)]] <= value[ahead], best[: len(ahead)], ahead)
        width += step
    counts = np.maximum(np.diff(at) - WINDOW + 1, 0)
    windows = np.repeat(at[:-1], counts) + ramp(counts)
    if not len(windows):
        return windows, windows, windows, symbols[:0]
    chosen = best[windows + FIRST]
    new = np.ones(len(windows), dtype=bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (windows[1:] != windows[:-1] + 1)
    head = np.flatnonzero(new)
    anchor = chosen[head]
    return windows[head], np.diff(np.append(head, len(windows))), anchor, symbols[np.searchsorted(starts, anchor)]


def _words_digests(words: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A digest of the names of n words from each first one on: equal for equal words alone, as no two words share a name."""
    raw = memoryview(np.ascontiguousarray(words)).cast("B")
    return np.frombuffer(b"".join([blake2b(raw[a:b], digest_size=8).digest() for a, b in zip((first * 8).tolist(), ((first + n) * 8).tolist(), strict=True)]), dtype=U64)


def _anchor_task(names: Names):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = batch.column(0), batch.column(1)
            for lo, _, data, off in pieces(batch.column(2)):
                words, at = named_words(data, off, names)
                first, n, anchor, symbol = anchors(words, at, names)
                if not len(first):
                    continue
                doc = np.searchsorted(at, first, "right") - 1
                key = mix(gram_hashes(gram_prefix(words), anchor - BEFORE, BEFORE + AFTER) ^ symbol)
                block = mix(_words_digests(words, first, n + (WINDOW - 1)) + (anchor - first).astype(U64))
                row = pa.array(doc + lo)
                yield pa.record_batch([int64(key), int64(block), ids.take(row), marks.take(row), pa.array(((first - at[doc]) << 5) | (n - 1))], ["key", "block", "doc_id", "mark", "place"])

    return rows


def _window_task(names: Names):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The windows asked for: doc_id, mark, text and a list of (key, place) for each text."""
        for batch in batches:
            ids, marks = batch.column(0), batch.column(1)
            asked = batch.column(3)
            lists, flat = asked.offsets.to_numpy(), asked.values
            keys, places = (flat.field(i).to_numpy() for i in range(2))
            for lo, hi, data, off in pieces(batch.column(2)):
                words, at = named_words(data, off, names)
                span = slice(lists[lo], lists[hi])
                n = (places[span] & 31) + 1
                doc = np.repeat(np.repeat(np.arange(hi - lo), np.diff(lists[lo : hi + 1])), n)
                first = np.repeat(places[span] >> 5, n) + ramp(n)
                for s in range(0, len(first), STEP):
                    part = slice(s, s + STEP)
                    window = _words_digests(words, at[doc[part]] + first[part], np.int64(WINDOW))
                    row = pa.array(doc[part] + lo)
                    yield pa.record_batch([pa.array(np.repeat(keys[span], n)[part]), int64(window), ids.take(row), marks.take(row), pa.array(first[part] << 5)], ["key", "window", "doc_id", "mark", "place"])

    return rows


def _kept_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drop the word ranges listed with each text: (first window << 5 | windows - 1) each."""
    for batch in batches:
        lost = batch.column(2)
        lists, flat = lost.offsets.to_numpy(), lost.values.to_numpy(zero_copy_only=False)
        has = ~np.asarray(lost.is_null())
        n_words, n_removed, kept = [], [], []
        for lo, hi, data, off in pieces(batch.column(1)):
            starts, ends, at = word_bounds(data, off, SPACES)
            drop = np.zeros(len(starts) + 1, dtype=np.int64)
            for r in np.flatnonzero(has[lo:hi]):
                codes = flat[lists[lo + r] : lists[lo + r + 1]]
                first = at[r] + (codes >> 5)
                np.add.at(drop, first, 1)
                np.add.at(drop, np.minimum(first + (codes & 31) + WINDOW, at[r + 1]), -1)
            gone = np.cumsum(drop)[: len(starts)] > 0
            removed = np.concatenate(([0], np.cumsum(gone)))
            raw = data.tobytes()
            for r in range(hi - lo):
                a, b = int(at[r]), int(at[r + 1])
                k = int(removed[b] - removed[a])
                if not k:
                    text = b" ".join(raw[off[r] : off[r + 1]].split())
                elif k == b - a:
                    text = b""
                else:
                    text = b" ".join([raw[x:y] for x, y, z in zip(starts[a:b].tolist(), ends[a:b].tolist(), gone[a:b].tolist(), strict=True) if not z])
                n_words.append(b - a)
                n_removed.append(k)
                kept.append(text.decode())
        yield pa.record_batch([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept"])


def repeated_windows(docs: DataFrame) -> DataFrame:
    """Runs of windows of 50 words that also start in a text with a smaller doc_id: (doc_id, mark, place), place being first window * 32 + windows - 1."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text").where("doc_id is not null and text is not null")
    with tables(docs.sparkSession):
        names = agree_on_names(texts)
    with tables(docs.sparkSession):
        found = written(texts.mapInArrow(_anchor_task(names), "key long, block long, doc_id long, mark long, place long"))
        with tables(docs.sparkSession):
            shared = outside(
                found.groupBy("key").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.min("block").alias("b1"), F.max("block").alias("b2")).where("least < most").select("key", "least", F.expr("b1 = b2").alias("one_block"))
            )
        met = outside(found.join(shared, "key").where("doc_id > least or not one_block").select("key", "doc_id", "mark", "one_block", "place"))
    asked = met.where("not one_block").groupBy("doc_id", "mark").agg(F.collect_set(F.struct("key", "place")).alias("asked"))
    windows = written(
        texts.join(asked, ["doc_id", "mark"]).select("doc_id", "mark", "text", "asked").mapInArrow(_window_task(names), "key long, window long, doc_id long, mark long, place long")
    )
    least = written(windows.groupBy("key", "window").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("key", "window", "least"))
    alone = windows.join(least, ["key", "window"]).where("doc_id > least").select("doc_id", "mark", "place")
    return met.where("one_block").select("doc_id", "mark", "place").union(alone)


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """Remove every word covered by a window of 50 words that also starts in a text with a smaller doc_id.

    Words are runs of other bytes than 09-0D and 20, of any length. Windows are judged on the input. Returns
    doc_id, n_words, n_removed and kept, the kept words joined by one space; a row for each row of docs.

    Null or empty text: no words, kept is ''. Null doc_id: nothing is removed and nothing is removed
    because of it. Rows that share a doc_id never remove each other's words; equal rows have equal results, and
    work in proportion to their number.
    There are no ties: only smaller doc_ids count, however many. Texts shorter than a window stay whole. A
    text of any length that Spark can hold is one step of a task (see textarrays). Other columns are ignored.
    An empty table gives an empty one.
    """
    lost = repeated_windows(docs).groupBy("doc_id", "mark").agg(F.collect_set("place").alias("lost"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("mark"))
    return texts.join(lost, ["doc_id", "mark"], "left").select("doc_id", "text", "lost").mapInArrow(_kept_rows, "doc_id long, n_words long, n_removed long, kept string")


def digest(kept: DataFrame) -> DataFrame:
    """The rows of dedup_substrings with a SHA-256 of the kept words in place of them."""
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


#: The definition in DuckDB: windows by their words, none of the method's steps.
SQL = r"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
win AS (SELECT r, doc_id, k, md5(array_to_string(w[k:k + 49], ' ')) AS g FROM (SELECT *, unnest(range(1, len(w) - 48)) AS k FROM doc)),
first AS (SELECT g, min(doc_id) AS least FROM win GROUP BY g),
hit AS (SELECT r, k FROM win JOIN first USING (g) WHERE doc_id > least),
gone AS (SELECT DISTINCT r, k + j AS i FROM hit, unnest(range(0, 50)) AS u(j)),
words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM doc),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (r)
"""
