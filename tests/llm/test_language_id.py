import zlib

import numpy as np
import pyarrow as pa
import pytest

from feedmill.llm import language_id as L

SF = "/root/testdata/sf0.01"


def slow_grams(text):
    folded = "".join(c if c.isalpha() else " " for c in text.lower())
    return [folded[i : i + n] for n in L.ORDERS for i in range(len(folded) - n + 1) if n > 1 or folded[i] != " "]


def test_buckets_follow_the_grams():
    texts = ["Abc, d", "É1ß abc", "", None, "x"]
    seen = {}
    for lo, hi, data, off in L.pieces(L._lowered(pa.array(texts))):
        points, at = L.code_points(data, off)
        got = [[] for _ in texts]
        for bucket, where in L.grams(points, at):
            for b, w in zip(bucket, where, strict=True):
                got[int(np.searchsorted(at, w, "right")) - 1].append(int(b))
    for t, g in zip(texts, got, strict=True):
        want = slow_grams(t or "")
        assert len(want) == len(g)
        for a, b in zip(want, g, strict=True):
            assert seen.setdefault(a, b) == b


def test_scores_equal_a_plain_sum():
    rng = np.random.default_rng(0)
    matrix = rng.normal(size=(1 << L.BITS, 3)).astype(np.float32)
    texts = ["ab cd", "", "1 2", "zzz é"] * 100
    best, score, lettered = L.score_texts(pa.array(texts), matrix)
    for k, t in enumerate(texts[:4]):
        total = np.zeros(3)
        for lo, hi, data, off in L.pieces(L._lowered(pa.array([t]))):
            points, at = L.code_points(data, off)
            for bucket, _ in L.grams(points, at):
                total += matrix[bucket].sum(axis=0)
        assert best[k] == total.argmax() and score[k] == pytest.approx(1 / np.exp(total - total.max()).sum(), abs=1e-3)
    assert lettered[:4].tolist() == [True, False, False, True]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = L.identify_held_out(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) == docs.count()
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    held = got[got.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, "hello there", "en", "u"), (2, None, "en", "u"), (3, "12 .,", None, "u"), (None, "bonjour", None, "u"), (4, "", "fr", "u"), (5, "bonjour à", "fr", "u")], "doc_id long, text string, lang string, lang_pred string")
    got = {r.doc_id: r.lang_pred for r in L.identify(docs, docs).collect()}
    assert got == {1: "en", 2: "und", 3: "und", None: "fr", 4: "und", 5: "fr"}
    empty = docs.where("doc_id > 9")
    assert L.identify(empty, docs).count() == 0
    assert {r.lang_pred for r in L.identify(docs, empty).collect()} == {"und"}


def brute_force(train, texts):
    """Multinomial naive Bayes over the buckets of the grams, one at a time: (language, posterior) of each text."""
    from math import exp, log

    def buckets(text):
        out = []
        for lo, hi, data, off in L.pieces(L._lowered(pa.array([text]))):
            points, at = L.code_points(data, off)
            out += [int(b) for bucket, _ in L.grams(points, at) for b in bucket]
        assert len(out) == len(slow_grams(text))
        return out

    counts = {}
    for text, lang in train:
        own = counts.setdefault(lang, {})
        for b in buckets(text):
            own[b] = own.get(b, 0) + 1
    out = []
    for text in texts:
        if text is None or not any(c.isalpha() for c in text):
            out.append(("und", 0.0))
            continue
        total = {x: sum(log((n.get(b, 0) + L.SMOOTHING) / (sum(n.values()) + L.SMOOTHING * 2**L.BITS)) for b in buckets(text)) for x, n in counts.items()}
        best = min(total, key=lambda x: (-total[x], x))
        out.append((best, 1 / sum(exp(v - total[best]) for v in total.values())))
    return out


@pytest.mark.parametrize("most", [512, 2])
def test_equals_brute_force(spark, monkeypatch, most):
    """With one matrix and with a matrix for every two languages; ties, repeated rows and letters beyond U+2FFFF among the texts."""
    monkeypatch.setattr(L, "MAX_LANGS", most)
    train = [("the house and the tree", "en"), ("das haus und der baum", "de"), ("la maison et les arbres", "fr"), ("la casa y los árboles", "es"), ("a casa e as árvores", "pt"), ("das haus", "de"), ("\U00030000\U00030001 \U00030002", "zz")]
    texts = ["the tree", "der baum und das haus", "les arbres", "los", "árvores as", "la", "12 .", "", None, "\U00030001", "\U00030000\U00030002", "the tree", "q"]
    docs = spark.createDataFrame([(k, t, "en", 1) for k, t in enumerate(texts)], "doc_id long, text string, lang string, top int")
    got = {r.doc_id: r for r in L.identify(docs, spark.createDataFrame(train, "text string, lang string")).collect()}
    for k, (lang, score) in enumerate(brute_force(train, texts)):
        assert got[k].lang_pred == lang and got[k].score == pytest.approx(score, abs=1e-4), texts[k]


def test_a_very_long_text(spark):
    docs = spark.createDataFrame([(1, "the house and the tree " * 100_000, "en"), (2, "das haus und der baum", "de")], "doc_id long, text string, lang string")
    assert {r.doc_id: r.lang_pred for r in L.identify(docs, docs).collect()} == {1: "en", 2: "de"}
