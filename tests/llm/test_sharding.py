import random
import zlib
from collections import Counter, defaultdict
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from feedmill.llm import sharding as S


def jump(key, shards):
    """The published loop on unsigned 64-bit numbers."""
    state, b, j = int(md5(("" if key is None else str(key)).encode()).hexdigest()[:16], 16), -1, 0
    while j < shards:
        b = j
        state = (state * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((state >> 33) + 1)))
    return b


ROWS = [(i, f"text {i % 50} é") for i in range(-50, 1500)] + [(7, "other"), (7, "other"), (None, "x"), (None, None), (3, ""), (4, None), (2**62, "語" * 70_000)]


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_shards_equal_the_published_loop(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    rows = ROWS + [(5, "copy")] * 900
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, shard int, `a.b` string").repartition(5)
    got = S.shard(docs).collect()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), jump(i, 24), jump(i, 25)) for i, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.shard, r.grown_shard) for r in got) == want
    assert {r.law for r in got} == {"key"}
    slots = defaultdict(list)
    for r in got:
        assert r.grown_shard in (r.shard, 24)
        slots[r.shard].append((r.slot, (r.doc_id is not None, r.doc_id or 0, r["size"], r.text_crc32)))
    for rs in slots.values():
        rs.sort()
        assert [s for s, _ in rs] == list(range(len(rs))) and [k for _, k in rs] == sorted(k for _, k in rs)


@pytest.mark.parametrize("shards", [1, 2, 24, 1000])
def test_any_number_of_shards(spark, shards):
    keys = [random.Random(shards).randint(-(2**63), 2**63 - 1) for _ in range(400)]
    got = spark.createDataFrame([(k,) for k in keys], "k long").select("k", S.shard_of("k", shards).alias("s")).collect()
    assert all(r.s == jump(r.k, shards) for r in got)


def test_only_the_necessary_part_moves(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit(1).alias("a.b"))
    rows = S.moved(docs, 24, 32).collect()
    assert all(r.grown_shard >= 24 and r.shard < 24 for r in rows) and 0.23 < len(rows) / 20_000 < 0.27
    back = S.moved(docs, 32, 24).collect()
    assert {(r.doc_id, r.shard, r.grown_shard) for r in back} == {(r.doc_id, r.grown_shard, r.shard) for r in rows}
    counts = Counter(r.s for r in docs.select(S.shard_of("doc_id").alias("s")).collect())
    assert len(counts) == 24 and max(counts.values()) < 1.2 * 20_000 / 24


def test_no_python_worker_and_no_text_in_the_shuffle(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    plan = docs.select(S.jumps(F.col("doc_id"), 24, 25))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_written_shards(spark, tmp_path):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    S.write_shards(docs, f"file://{tmp_path}/out", 4, files=2)
    got = spark.read.parquet(f"file://{tmp_path}/out")
    assert Counter((r.doc_id, r.text, r.shard) for r in got.collect()) == Counter((i, t, jump(i, 4)) for i, t in ROWS)


def test_empty_table(spark):
    assert S.shard(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_sql_equals_sharding(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    rows = [r for r in ROWS if not r[1] or len(r[1]) < 100_000]
    con.executemany("insert into documents values (?, ?)", rows)
    got = S.shard(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, con.sql(S.SQL).select(*got.columns).fetchall()))
