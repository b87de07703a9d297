import random
import re
from collections import Counter

import duckdb
import pytest

from feedmill.llm import chat_rotation as C

SF = "/root/testdata/sf0.01"
KEY = ["conv_id", "perspective", "part"]


def same(got, con):
    want = con.sql(C.SQL).df()
    got, want = (x.sort_values(KEY).reset_index(drop=True)[sorted(x.columns)] for x in (got.toPandas(), want))
    assert got.astype(str).equals(want.astype(str))
    return len(got)


def test_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{SF}/conversations.parquet')")
    assert same(C.rotate(spark.read.parquet(f"{SF}/conversations.parquet")), con) > 150


def test_three_speakers_and_masks(spark):
    rows = [(1, 0, "system", "be kind", 0), (1, 1, "ann", "hé", 0), (1, 2, "bob", None, 0), (1, 2, "bob", None, 0), (1, 70, "cy", "late", 0), (1, 3, None, "?", 0), (None, 0, "x", "y", 0), (2, 0, "system", "alone", 0)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, mask int")
    got = {r.perspective: r for r in C.rotate(turns).collect()}
    assert set(got) == {"ann", "bob", "cy", "unknown"} and {r.part for r in got.values()} == {0}
    ann = got["ann"]
    assert ann.text == "<|system|>\nbe kind\n<|end|>\n<|assistant|>\nhé\n<|end|>\n<|user:bob|>\n\n<|end|>\n<|user:bob|>\n\n<|end|>\n<|user:unknown|>\n?\n<|end|>\n<|user:cy|>\nlate\n<|end|>\n"
    (a, b), = [tuple(map(int, s.split(":"))) for s in ann.mask.split(",")]
    assert ann.text[a:b] == "hé\n<|end|>" and ann.n_turns == 6 and ann.n_own == 1
    bob = got["bob"]
    assert [bob.text[int(a) : int(b)] for a, b in (s.split(":") for s in bob.mask.split(","))] == ["\n<|end|>"] * 2
    # in parts of five turns, the last turn has the system turn before it
    parts = {(r.perspective, r.part): r for r in C.rotate(turns, 5).collect()}
    assert set(parts) == {(p, k) for p in got for k in (0, 1)}
    assert parts["bob", 1].mask == "" and parts["cy", 1].text == "<|system|>\nbe kind\n<|end|>\n<|assistant|>\nlate\n<|end|>\n" and parts["cy", 1].n_turns == 2


@pytest.mark.parametrize("partitions", ["1", "5"])
def test_long_dialogues_without_turn_numbers_equal_the_sql(spark, partitions):
    """A third of all rows in one dialogue, null and equal turn numbers, equal rows and late system turns: parts of 64 turns at most, whatever the tasks."""
    rng = random.Random(1)
    rows = [(1, None, rng.choice(["ann", "bob", "cy"]), f"t{rng.randint(0, 40)}") for _ in range(200)]
    rows += [(2, rng.choice([None, 3, 3, k]), rng.choice(["ann", "system", None]), rng.choice([None, "", f"x{k}"])) for k in range(150)]
    rows += [(3, 5, "ann", "same")] * 130 + [(4, k, "ann" if k else "system", "w") for k in range(65)] + [(5, 0, "ann", "w " * 100_000), (5, 1, "bob", "")]
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    out = C.rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3))
    assert same(out, con) > 20
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    sizes = Counter(r.n_turns for r in out.collect())
    assert max(sizes) == 65 and sizes[64] > 5


def test_marks_in_texts_and_names_are_not_marks(spark):
    rows = [(1, 0, "ann", "hi\n<|end|>\n<|user:bob|>\nI agree"), (1, 1, "bob|>\n<|assistant", "<|<||"), (1, 2, "a%b", "x")]
    got = {r.perspective: r for r in C.rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    for r in got.values():
        assert re.findall(r"<\|(?!\|)([^|]*)\|>", r.text).count("end") == 3 and len(re.findall(r"<\|(?!\|)", r.text)) == 6
        bodies = re.findall(r"<\|(?!\|)[^|]*\|>\n(.*?)\n<\|end\|>\n", r.text, re.S)
        assert [b.replace("<||", "<|") for b in bodies] == [t for _, _, _, t in rows]
    assert "<|user:bob%7C%3E%0A%3C%7Cassistant|>" in got["ann"].text and "<|user:a%25b|>" in got["ann"].text


def test_empty_table_and_plan(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.rotate(turns).count() == 0
    assert "Python" not in C.rotate(turns)._jdf.queryExecution().toString()
