import itertools
import random
from collections import defaultdict

import numpy as np
import pytest

from feedmill.llm import packing as P


def padding(lengths, counts, bounds):
    return sum(c * (min(b for b in bounds if b >= x) - x) for x, c in zip(lengths, counts, strict=True))


@pytest.mark.parametrize("seed", range(8))
def test_bounds_are_optimal(seed):
    rng = random.Random(seed)
    lengths = sorted(rng.sample(range(200), rng.randint(1, 11)))
    counts = [rng.randint(1, 50) for _ in lengths]
    for k in (1, 2, 3, 4, 20):
        got = P.bucket_bounds(np.array(lengths), np.array(counts), k)
        best = min(padding(lengths, counts, [*c, lengths[-1]]) for r in range(min(k, len(lengths))) for c in itertools.combinations(lengths[:-1], r))
        assert len(got) <= k and padding(lengths, counts, got) == best


@pytest.mark.parametrize("partitions", ["1", "9"])
def test_batches(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    rng = random.Random(1)
    rows = [(i, " ".join("x" * rng.choice([0, 1, 5, 5, 5, 30, 31, rng.randint(1, 300)]))) for i in range(400)]
    rows += [(None, "a b"), (7, None), (7, None), (900, "y " * 5000), (901, "")]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, batch int")
    got = [r.asDict() for r in P.pack(docs, buckets=5, budget=1000).collect()]
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in got) == sorted((str(i), len((t or "").split())) for i, t in rows)
    buckets = defaultdict(list)
    for r in got:
        assert r["n_tokens"] <= r["padded_to"]
        buckets[r["bucket"], r["padded_to"]].append(r)
    assert sorted(b for b, _ in buckets) == list(range(len(buckets)))
    for (_, upper), rs in buckets.items():
        fit = max(1, 1000 // max(upper, 1))
        assert sorted((r["batch"], r["slot"]) for r in rs) == [(k // fit, k % fit) for k in range(len(rs))]
        rs.sort(key=lambda r: (r["batch"], r["slot"]))
        assert [r["n_tokens"] for r in rs] == sorted(r["n_tokens"] for r in rs)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert P.pack(docs).count() == 0


def test_one_length_and_no_ids_are_spread_over_tasks(spark):
    """Rows of one length without ids, all alike: they fill batches in order, dealt out to many tasks."""
    docs = spark.range(3000).selectExpr("cast(null as long) as doc_id", "'a b c' as text", "id as slot").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    out = P.pack(docs, budget=30, carry=("text",))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = out.collect()
    assert sorted((r.batch, r.slot) for r in rows) == [(k // 10, k % 10) for k in range(3000)] and {r.text for r in rows} == {"a b c"}
    tables = [spark.read.parquet(folder) for folder in {f.rsplit("/", 1)[0] for f in out.inputFiles()}]
    placed = next(t for t in tables if "at" in t.columns)
    assert placed.selectExpr("shiftrightunsigned(at, 33) as task").distinct().count() > 1


def test_sql_equals_packing(spark):
    import duckdb

    rng = random.Random(4)
    rows = [(i, " ".join("x" * rng.choice([0, 1, 5, 30, 31, rng.randint(1, 300)]))) for i in range(400)] + [(None, "a b"), (900, None), (901, "y " * 40_000)]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    got = P.pack(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, con.sql(P.SQL).select(*got.columns).fetchall()))
