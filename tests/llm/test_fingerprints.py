import hashlib
import random

import numpy as np
import pyarrow as pa

from feedmill.llm import fingerprints as P


def test_edits_and_next(spark):
    rng = random.Random(5)
    rows = [(i * 3, " ".join(rng.choice(["aé", "b", "😀c", "dd", "\n"]) for _ in range(rng.choice([0, 1, 3, 40, 400])))) for i in range(97)]
    rows += [(None, "last one"), (5, None), (12, rows[4][1])]
    docs = spark.createDataFrame([(i, t, "q") for i, t in rows], "doc_id long, text string, part string").repartition(6)
    texts = list({t for _, t in rows})
    marks = spark.createDataFrame([(t,) for t in texts], "text string").selectExpr("text", "xxhash64(text) as mark").collect()
    mark = {r.text: r.mark for r in marks}
    for parts in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = sorted((tuple(r)[:7] for r in P.compare_with_edits(docs).collect()), key=str)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        order = [(i, t or "") for i, t in sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), mark[r[1]]))]
        want = []
        sig = lambda t: P.signatures(pa.array([t]))[0]
        for k, (i, t) in enumerate(order):
            after = order[(k + 1) % len(order)][1]
            e = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
            a, b, c = sig(t), sig(e), sig(after)
            want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), a.astype(">u4").tobytes().hex(), b.astype(">u4").tobytes().hex(), float((a == b).mean()), float((a == c).mean())))
        assert got == sorted(want, key=str)


def test_estimates_the_jaccard_index():
    words = [str(i) for i in range(1000)]
    a, b = " ".join(words[:800]), " ".join(words[200:])
    s = P.signatures(pa.array([a, b, a, None, ""]))
    assert abs((s[0] == s[1]).mean() - 596 / 996) < 0.15
    assert np.array_equal(s[0], s[2]) and np.array_equal(s[3], s[4])


def test_few_rows(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    r = P.compare_with_edits(docs).collect()
    assert len(r) == 1 and r[0].near_next == 1.0
    assert P.compare_with_edits(docs.where("doc_id > 1")).count() == 0
    f = P.fingerprints(docs.union(docs))
    assert f.select("fingerprint").distinct().count() == 1
    assert f.select(P.likeness(f.fingerprint, f.fingerprint).alias("x")).first().x == 1.0


def minhash_values(text):
    """The values of a text's fingerprint from its shingles, one at a time."""
    from feedmill.llm import textarrays as A

    words = (text or "").encode().split()
    if not words:
        return [0xFFFFFFFF] * P.PERMUTATIONS
    shingle_hashes = []
    for i in range(max(1, len(words) - 4)):
        part = b" ".join(words[i : i + 5])
        data = np.frombuffer(part, dtype=np.uint8)
        shingle_hashes.append(int(A.shingles(data, np.array([0, len(data)]))[0][0]) >> 32)
    a, b = A.permutations(P.PERMUTATIONS, P.SEED)
    return [min((h * int(x) + int(y)) % 2**32 for h in shingle_hashes) for x, y in zip(a, b, strict=True)]


def test_values_equal_a_loop_over_the_shingles():
    texts = ["a b c d e f g a b c d e", "one two", "", None, "é ü\tß  x y z w", "same same same same same same same"]
    assert P.signatures(pa.array(texts)).tolist() == [minhash_values(t) for t in texts]


def test_near_classes_equal_brute_force(spark):
    from test_jaccard_join import brute_force, made

    rows = made(8)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {i: c for i, c, _ in brute_force(rows)}
    assert {r.doc_id: r.class_id for r in P.near_classes(docs).collect()} == want
    assert {r.doc_id: r.class_id for r in P.compare_with_edits(docs).collect()} == want


def test_an_id_of_a_third_of_the_rows_and_a_very_long_text(spark):
    """Rows of one doc_id are split over tasks by a hash of their text, and each still finds its next one."""
    rows = [(50, f"text {k} of one id") for k in range(120)] + [(None, f"without id {k}") for k in range(60)] + [(k, f"other {k}") for k in range(100, 160)] + [(7, "é " * 300_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    marked = docs.selectExpr("doc_id", "text", "xxhash64(text) as mark").collect()
    order = sorted(((r.doc_id, r.mark, r.text) for r in marked), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = []
    for k, (i, _, t) in enumerate(order):
        after = order[(k + 1) % len(order)][2]
        want.append((i, len(t), hashlib.sha256((t[: len(t) - len(t) // 2] + after[: len(t) // 2]).encode()).hexdigest()))
    assert sorted((tuple(r)[:3] for r in P.compare_with_edits(docs).collect()), key=str) == sorted(want, key=str)
