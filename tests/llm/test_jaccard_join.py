import random

import numpy as np
from pyspark.sql import functions as F

from feedmill.llm import jaccard_join as J
from feedmill.llm.components import components


def shingle_set(text):
    w = (text or "").encode().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_force(rows, t=0.8):
    sets = {i: shingle_set(x) for i, x in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = {i: set() for i in sets}
    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= t - 1e-12:
                if sets[i] != sets[j]:
                    links[i].add(frozenset(sets[j]))
                    links[j].add(frozenset(sets[i]))
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return sorted((i, find(i), len(links[i])) for i in sets)


def made(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(3))
    rows = []
    for _ in range(40):
        base = [word() for _ in range(rng.choice([2, 4, 6, 40, 120]))]
        for _ in range(rng.choice([1, 1, 2, 5])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                w[rng.randrange(len(w))] = word()
            rows.append(" ".join(w))
    hot = [word() for _ in range(150)]
    for _ in range(40):
        w = list(hot)
        w[rng.randrange(150)] = word()
        rows.append(" ".join(w))
    rows += [None, "", "  ", "x", "x", "one two"]
    ids = rng.sample(range(1000), len(rows))
    return list(zip(ids, rows, strict=True))


def test_equals_brute_force(spark, monkeypatch):
    rows = made(3)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, class_id string")
    want = brute_force(rows)
    got = sorted(tuple(r)[:3] for r in J.near_duplicates(docs).collect())
    assert got == want
    kept = sorted(r.doc_id for r in J.keep_one(docs).collect())
    assert kept == sorted(i for i, c, _ in want if i == c)
    assert J.keep_one(docs).columns == docs.columns


def test_chunks_of_a_large_group(monkeypatch):
    rng = np.random.default_rng(1)
    core = rng.integers(0, 1 << 62, 200, dtype=np.uint64)
    sets = [np.unique(np.concatenate([core[5 * (k % 8) :], rng.integers(0, 1 << 62, 4 * (k % 5), dtype=np.uint64)])) for k in range(60)]
    import pandas as pd

    frame = lambda rows, chunk: pd.DataFrame({"set_id": rows, "grp": 0, "banded": False, "chunk": chunk, "shingles": [sets[r].tobytes() for r in rows]})
    task = J._link_task(0.8, J.PRUNED)
    whole = task(frame(list(range(60)), [0] * 60))
    parts = [task(frame(list(range(30)), [0] * 30)), task(frame(list(range(30, 60)), [1] * 30)), task(frame(list(range(60)), [0] * 30 + [1] * 30))]
    total = lambda x: x[x.n > 0].groupby("a").n.sum().to_dict()
    assert total(pd.concat(parts)) == total(whole)
    exact = {i: sum(len(np.intersect1d(sets[i], sets[j])) / len(np.union1d(sets[i], sets[j])) >= 0.8 - 1e-12 for j in range(60) if j != i) for i in range(60)}
    assert total(whole) == {i: n for i, n in exact.items() if n}


def test_edge_rows(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, None)], "doc_id long, text string")
    got = sorted((tuple(r) for r in J.near_duplicates(docs).collect()), key=str)
    assert got == [(1, 1, 0, 2), (1, 1, 0, 2), (2, 2, 0, 1), (None, None, 0, 1)]
    assert sorted(str(r.doc_id) for r in J.keep_one(docs).collect()) == ["1", "2", "None"]
    assert J.near_duplicates(docs.where("doc_id > 9")).count() == 0
    assert J.keep_one(docs.where("doc_id > 9")).count() == 0


def test_components_of_a_path_and_a_star(spark):
    links = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).union(spark.range(200, 260).select(F.lit(150).cast("long"), "id"))
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(61)}, 150: 150, **{i: 150 for i in range(200, 260)}}


def by_rows(rows, t=0.8):
    """Classes of rows, each with its own text, whatever the doc_ids: (doc_id, class_id, n_links) of each row, and the rows to keep."""
    want = {i: (c, n) for i, c, n in brute_force([(k, x) for k, (_, x) in enumerate(rows)], t)}
    groups = {}
    for k, (i, x) in enumerate(rows):
        if shingle_set(x):
            groups.setdefault(want[k][0], []).append(i)
    return sorted((i, min(groups[want[k][0]]) if shingle_set(x) else i, want[k][1]) for k, (i, x) in enumerate(rows)), len(groups) + sum(not shingle_set(x) for _, x in rows)


def test_one_doc_id_with_different_texts(spark):
    word = lambda seed: " ".join(f"w{seed}x{k}" for k in range(40))
    near = lambda text: text + " more"
    p, q, r = map(word, range(3))
    cases = [(1, [(1, p), (1, q), (5, near(p)), (6, near(q))]), (64, [(1, p), (1, q), (2, r)]), (4, [(3, p), (3, near(p)), (3, q), (4, near(near(p))), (4, q)])]
    for parts, rows in cases:
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        want, kept = by_rows(rows)
        assert sorted(tuple(x)[:3] for x in J.near_duplicates(docs).collect()) == want
        left = J.keep_one(docs).collect()
        assert len(left) == kept and len({tuple(x) for x in left}) == kept


def test_a_giant_group_by_its_bands(spark):
    """Groups of over 4 sets go through the bands of their own: the result stays."""
    rows = made(5)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r)[:3] for r in J.near_duplicates(docs, giant=4).collect())
    assert got == brute_force(rows)


def test_a_very_long_text(spark):
    long = " ".join(str(k * 7919 % 100_003) for k in range(300_000))
    docs = spark.createDataFrame([(1, long), (2, long + " end"), (3, "short text here")], "doc_id long, text string")
    assert sorted(tuple(r)[:3] for r in J.near_duplicates(docs).collect()) == [(1, 1, 1), (2, 1, 1), (3, 3, 0)]


def test_sql_equals_brute_force():
    import duckdb

    rows = made(6)
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    assert sorted(r[:3] for r in con.sql(J.SQL).fetchall()) == brute_force(rows)
