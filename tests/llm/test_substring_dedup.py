import hashlib
import random

import numpy as np
import pytest

from feedmill.llm import substring_dedup as S


def brute_force(rows: list[tuple[int, str | None]]) -> list[tuple[int, int, int, str]]:
    """The definition, row by row; for tests."""
    split = [(i, (t or "").encode().split()) for i, t in rows]
    least: dict[tuple, int] = {}
    for i, w in split:
        for k in range(len(w) - S.WINDOW + 1):
            g = tuple(w[k : k + S.WINDOW])
            least[g] = min(least.get(g, i), i)
    out = []
    for i, w in split:
        gone = np.zeros(len(w), dtype=bool)
        for k in range(len(w) - S.WINDOW + 1):
            if least[tuple(w[k : k + S.WINDOW])] < i:
                gone[k : k + S.WINDOW] = True
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    return out


def made(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") * rng.randint(1, 3)
    passages = [[word() for _ in range(n)] for n in (49, 50, 51, 80, 200)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts += rng.choice([rng.choice(passages), [word() for _ in range(rng.randint(1, 70))], [word()] * rng.randint(1, 120)])
        p = rng.choice(passages)
        if rng.random() < 0.3:
            parts += p[: rng.randint(1, len(p))]
        rows.append((i, rng.choice([" ", "\n", "  ", "\t"]).join(parts)))
    rows += [(60, None), (61, ""), (62, " \n "), (63, rows[3][1]), (3, rows[3][1]), (64, "é ü  x"), (65, "x " * 30000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = made(seed)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, key string").repartition(5)
    got = sorted(map(tuple, S.digest(S.dedup_substrings(docs)).collect()))
    assert got == sorted(brute_force(rows))


def test_null_ids_and_empty_table(spark):
    long = " ".join(map(str, range(60)))
    docs = spark.createDataFrame([(None, long), (1, long), (2, long)], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed) for r in S.dedup_substrings(docs).collect()}
    assert got == {None: (60, 0), 1: (60, 0), 2: (60, 60)}
    assert S.dedup_substrings(docs.where("doc_id > 5")).count() == 0


def test_words_that_a_polynomial_modulo_2_64_confuses(spark):
    """The Thue-Morse word of 1,024 letters and its complement are different words."""
    turn = [bin(k).count("1") & 1 for k in range(1024)]
    one, two = ("".join("ab"[t ^ x] for t in turn) for x in (0, 1))
    tail = " ".join(f"w{k}" for k in range(59))
    rows = [(1, f"{one} {tail}"), (2, f"{two} {tail}"), (3, f"{one} {tail}")]
    got = sorted(map(tuple, S.digest(S.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string"))).collect()))
    assert got == sorted(brute_force(rows)) and [r[2] for r in got] == [0, 59, 60]


def test_shared_names_are_replaced():
    """A name on the list of shared ones gives way at every level, and all others stay."""
    text = np.frombuffer(b"a b b c a b d d e a c b", dtype=np.uint8)
    off = np.array([0, len(text)])
    words, at = S.named_words(text, off, S.Names())
    made = []
    S.recompress(words, at, S.Names(), lambda *m: made.append(m))
    assert [m[0] for m in made] == [1, 2, 3]
    for level, name in [(0, words[0]), *((m[0], m[2][0]) for m in made if len(m[2]))]:
        names = S.Names(tuple(np.array([name] if k == level else [], dtype=np.uint64) for k in range(4)))
        again, _ = S.named_words(text, off, names)
        if level == 0:
            assert ((again != words) == (words == name)).all() and len({*again[words == name]}) == 1
            continue
        anew = []
        S.recompress(words, at, names, lambda *m: anew.append(m))
        old, new = (next(m for m in x if m[0] == level) for x in (made, anew))
        assert (old[3] == new[3]).all() and (old[4] == new[4]).all()
        assert ((old[2] != new[2]) == (old[2] == name)).all()


def test_rounds_find_shared_names(spark):
    texts = spark.createDataFrame([("a b c d e f a b",), ("x " * 5000,), ("x x y",)], "text string")
    assert all(len(s) == 0 for s in S.agree_on_names(texts).shared)
    import pyarrow as pa

    words = " ".join(f"word{k % 7}long" for k in range(60))
    batch = pa.record_batch([pa.array([f"x x y {words}", "b b y", None, ""])], ["text"])
    told = [pa.Table.from_batches(list(S._made_task(S.Names(), levels)(iter([batch])))).to_pydict() for levels in S.ROUNDS]
    assert len(set(told[0]["name"])) == len(set(told[0]["stands_for"])) == 7 and {x & 3 for x in told[0]["stands_for"]} == {0}
    assert {x & 3 for x in told[1]["stands_for"]} <= {1, 2, 3} and len(told[1]["name"]) > 3


def test_sql_equals_brute_force():
    import duckdb

    rows = made(3)
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    assert sorted(con.sql(S.SQL).fetchall()) == sorted(brute_force(rows))


def test_tables_of_done_steps_are_deleted(spark):
    from pathlib import Path

    from feedmill.llm.scratch import shared_folder
    from feedmill.llm.substring_dedup import repeated_windows

    there = lambda: set(Path(shared_folder(spark).removeprefix("file://")).glob("**/feedmill-*"))
    before, text = there(), " ".join(f"w{i}" for i in range(80))
    rows = repeated_windows(spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string"))
    assert {r.doc_id for r in rows.collect()} == {2}
    assert len(there() - before) == 3  # met, windows and least; not the anchors of all texts
