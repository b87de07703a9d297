import random

from feedmill.llm import decontamination as D


def in_order(a, b):
    """The most words of a that lie in b in order."""
    row = [0] * (len(b) + 1)
    for x in a:
        row, old = [0], row
        for j, y in enumerate(b):
            row.append(old[j] + 1 if x == y else max(row[j], old[j + 1]))
    return row[-1]


def test_replaced_cut_and_put_in_words(spark):
    rng = random.Random(7)
    items = {n: [f"w{n}x{j}" for j in range(n)] for n in (8, 12, 14, 15, 40, 59, 60)}
    docs = {}
    for n, v in items.items():
        cases = [(2, 0, 0), (0, 2, 0), (0, 0, 1)] + [(2, 2, 0), (n // 8, 2, 0)] * (n >= 15) + [(0, 0, 2), (2, 0, 1), (0, 2, 1)] * (n >= 40)
        for replaced, cut, put_in in cases * 4:
            noise = [f"n{len(docs)}x{j}" for j in range(rng.randint(0, 80))]
            w = (v[: n - cut] if rng.random() < 0.5 else v[cut:]).copy()
            for j in rng.sample(range(len(w)), replaced):
                w[j] = "other"
            for _ in range(put_in):
                w.insert(rng.randint(1, len(w) - 1), "put")
            a = rng.randint(0, len(noise))
            docs[len(docs)] = noise[:a] + w + noise[a:]
    want = {(i, n) for i, w in docs.items() for n, v in items.items() if in_order(v, w) >= D.OVERLAP * n}
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")
    b = spark.createDataFrame([(n, " ".join(v)) for n, v in items.items()], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in D.contamination(d, b).collect()} == want and len(want) == len(docs)
