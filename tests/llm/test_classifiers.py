import zlib

import numpy as np
import pyarrow as pa

from feedmill.llm import labelled as L
from feedmill.llm import quality as Q
from feedmill.llm import toxicity as T

SF = "/root/testdata/sf0.1"


def test_counterfactuals_take_weight_from_identity_terms():
    rng = np.random.default_rng(0)
    filler = [f"word{k}" for k in range(50)]
    texts, labels = [], []
    for k in range(600):
        bad = k % 3 == 0
        group = "muslim" if bad and k % 2 == 0 or k % 20 == 1 else "christian" if k % 5 == 0 else ""
        texts.append(" ".join([*rng.choice(filler, 8), group, rng.choice(["scum", "idiot"]) if bad and k % 4 else ""]))
        labels.append(float(bad))
    neutral = pa.array(["muslim word1 word2 word3", "christian word1 word2 word3"])

    def gap(strength):
        w, b = T.fit(texts, np.array(labels), counterfactual=strength)
        i, v, at = L.feature_rows(neutral, T.features)
        z = L.row_sums(w[i] * v, at) + b
        return z[0] - z[1]

    assert gap(0.0) > 0.5 and abs(gap(5.0)) < 0.4 * gap(0.0)
    assert T.swap_terms("a black muslims' woman") == "a white christians' man"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    tox = T.score_held_out(docs, labels).join(labels, "doc_id").toPandas()
    assert (tox.held_out == tox.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)).all()
    held = tox[tox.held_out]
    assert (held.predicted == held.toxic).mean() > 0.97
    assert held[held.toxic == 0].predicted.mean() < 0.02
    good = Q.score_held_out(docs, labels).join(labels, "doc_id").toPandas()
    assert (good.held_out == good.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    held = good[good.held_out]
    assert (held.predicted == held.quality).mean() > 0.95
    assert good.score.between(0, 1).all() and (good.predicted == (good.score >= 0.7)).all()


def test_quality_features_count_every_gram():
    texts = ["One two, THREE three", "", "x", None, "é 1 2 2 2"]
    i, v, at = L.feature_rows(Q.filled(pa.array(texts)), Q.features)
    n = [len((t or "").split()) for t in texts]
    assert np.diff(at).tolist() == [sum(max(k - o + 1, 0) for o in (*Q.WORD_ORDERS, *Q.SHAPE_ORDERS)) for k in n]
    alone, _, _ = L.feature_rows(Q.filled(pa.array([texts[4]])), Q.features)
    assert i[at[4] :].tolist() == alone.tolist()
    assert len(L.feature_rows(Q.filled(pa.array([""])), Q.features)[0]) == 0


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, "good text", 0.5), (2, None, 0.5), (3, "", 0.5), (None, "x", 0.5), (1, "good text", 0.5)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1, 0), (2, None, None), (None, 1, 1), (1, 0, 0)], "doc_id long, quality int, toxic int")
    for f in (T.score_held_out, Q.score_held_out):
        rows = f(docs, labels).collect()
        assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
        assert f(docs, labels.limit(0)).count() == 5
        assert f(docs.where("doc_id > 5"), labels).count() == 0
    assert T.reject_toxic(docs, labels).schema == docs.schema and T.reject_toxic(docs, labels).count() == 5


def test_neutral_mentions_are_not_flagged():
    """On the corpus, which names no group: a mention changes no neutral text's score by much, with the penalty less than without."""
    import pyarrow.parquet as pq

    docs, labels = (pq.read_table(f"{SF}/{t}.parquet").to_pandas() for t in ("documents", "labels"))
    rows = docs.merge(labels, on="doc_id")
    rows = rows[rows.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 != 1)].head(1500)
    terms = [t for g in T.IDENTITY_TERMS for t in g]
    neutral = rows[rows.toxic == 0].text.head(200).tolist()
    mentions = [f"{t} the {terms[k % len(terms)]} people" for k, t in enumerate(neutral)] + [f"the {t} family lives here" for t in terms]

    def weights(strength):
        w, b = T.fit(rows.text.tolist(), rows.toxic.to_numpy().astype(float), counterfactual=strength, steps=60)
        scores = L.batch_scores(pa.array(mentions), (w, b), T.lowered, T.features)
        return np.abs(w[T._buckets(pa.array(terms))[0]]).max(), (scores >= T.THRESHOLD).mean()

    (bare, _), (held, flagged) = weights(0.0), weights(T.COUNTERFACTUAL)
    assert flagged == 0 and held < 0.05 and held <= bare


def test_the_gradient_equals_differences():
    """A fit's loss does not grow under further steps: the weights are those of a plain proximal loop on the same loss."""
    texts = ["bad idiot here", "good day all", "idiot muslim man", "a nice woman", "scum and idiot", "the old house"] * 5
    y = np.array([1, 0, 1, 0, 1, 0] * 5, dtype=float)
    index, counts, pairs, added = T._rows(T.lowered(L.as_texts(texts)), T.IDENTITY_TERMS)
    at = np.concatenate(([0], np.cumsum(counts)))
    labels = np.concatenate([y, y[added]])

    def loss(w, b):
        z = L.row_sums(w[index], at) + b
        n = len(labels)
        return np.mean(np.logaddexp(0, z[:n]) - labels * z[:n]) + T.L1 * np.abs(w).sum() + T.L2 / 2 * (w**2).sum() + T.COUNTERFACTUAL * np.sum((z[pairs[:, 0]] - z[pairs[:, 1]]) ** 2) / n

    w, b = T.fit(texts, y, steps=1500)
    found, rng = loss(w, b), np.random.default_rng(0)
    for k in rng.choice(np.unique(index), 12, replace=False):
        for step in (1e-2, -1e-2):
            moved = w.copy()
            moved[k] += step
            assert loss(moved, b) > found - 1e-5
    assert len(pairs) == len(texts) and len(added) == 15


def test_quality_scores_equal_a_loop_over_the_grams(spark):
    """FTRL-Proximal and the scores, one weight and one text at a time."""
    from math import exp, log, sqrt

    texts = ["Good plain words here", "BAD!!! $$$ $$$ 11", "Good words again here", "x9 $$ BAD!!!", "plain words", "", None, "11 $$$"] * 5
    y = np.array([1, 0, 1, 0, 1, 0, 1, 0] * 5, dtype=float)
    w, b = Q.fit(texts, y)
    rows = []
    for t in texts:
        i, v, _ = L.feature_rows(Q.filled(pa.array([t], pa.string())), Q.features)
        own = {}
        for k, x in zip(i.tolist(), v.tolist(), strict=True):
            own[k] = own.get(k, 0.0) + x
        rows.append(own | {"bias": 1.0})
    z, n, start = {}, {}, log(y.mean() / (1 - y.mean()))

    def weight(k):
        l1 = 0 if k == "bias" else Q.L1
        a = z.get(k, 0.0)
        return 0.0 if abs(a) <= l1 else -(a - (l1 if a > 0 else -l1)) / ((Q.BETA + sqrt(n.get(k, 0.0))) / Q.ALPHA + Q.L2)

    for _ in range(Q.EPOCHS):
        for lo in range(0, len(rows), Q.BATCH):
            slope, used = {}, {}
            for own, label in zip(rows[lo : lo + Q.BATCH], y[lo : lo + Q.BATCH], strict=True):
                used |= {k: weight(k) for k in own if k not in used}
                error = 1 / (1 + exp(-(sum(used[k] * x for k, x in own.items()) + start))) - label
                for k, x in own.items():
                    slope[k] = slope.get(k, 0.0) + error * x
            for k, g in slope.items():
                sigma = (sqrt(n.get(k, 0.0) + g * g) - sqrt(n.get(k, 0.0))) / Q.ALPHA
                z[k] = z.get(k, 0.0) + g - sigma * used[k]
                n[k] = n.get(k, 0.0) + g * g
    want = [1 / (1 + exp(-(sum(weight(k) * x for k, x in own.items()) + start))) for own in rows]
    got = L.batch_scores(pa.array(texts, pa.string()), (w, b), Q.filled, Q.features)
    assert np.allclose(got, want, atol=1e-9) and np.ptp(got) > 0.3


def test_samples_are_bounded_in_bytes(spark):
    docs = spark.createDataFrame([(k, "x " * 500) for k in range(50)] + [(99, "y" * (L.MOST_TEXT_BYTES + 1))], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(50)] + [(99, 1)], "doc_id long, toxic int")
    from pyspark.sql import functions as F

    texts, y = L.training_sample(docs, labels, "toxic", F.lit(False), 40, 10_500)
    assert len(texts) == len(y) == 10
    assert len(L.training_sample(docs, labels, "toxic", F.lit(False), 1000)[1]) == 50
    assert T.score_held_out(docs, labels).count() == Q.score_held_out(docs, labels.withColumnRenamed("toxic", "quality")).count() == 51
