import os
import re
import sys

import numpy as np
from pyspark.sql import functions as F
from test_decontamination import brute_force as leaks
from test_jaccard_join import brute_force as near
from test_secret_scan import base

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import corpus_pipeline as P  # noqa: E402
from feedmill.llm import labelled, packing, scratch, secret_scan, toxicity  # noqa: E402

SF = "/root/testdata/sf0.001"


def packed_by_hand(rows, buckets, budget):
    """(doc_id, n_tokens, bucket, padded_to, batch, slot) of rows (doc_id, text): every choice of bounds by a plain dynamic programme."""
    sized = sorted((len(t.encode().split()), i) for i, t in rows)
    lengths = sorted({n for n, _ in sized})
    count = {n: sum(m == n for m, _ in sized) for n in lengths}
    best = {(0, -1): (0, ())}
    for k in range(1, min(buckets, len(lengths)) + 1):
        for j in range(len(lengths)):
            options = []
            for i in range(-1, j):
                if (k - 1, i) in best:
                    pad, ends = best[k - 1, i]
                    options.append((pad + sum(count[n] * (lengths[j] - n) for n in lengths[i + 1 : j + 1]), (*ends, lengths[j])))
            if options:
                best[k, j] = min(options, key=lambda o: o[0])
    pad, _ = min((v for (k, j), v in best.items() if j == len(lengths) - 1), key=lambda v: v[0])
    return sized, pad


def plain_run(spark, sf):
    """The stages by definition, row by row: documents left (doc_id, text), and the texts that were masked."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    # toxicity: the sum of a text's weights
    out = F.coalesce(labelled.fold(3) == 1, F.lit(True))
    w, b = toxicity.fit(*labelled.training_sample(docs, spark.read.parquet(f"{sf}/labels.parquet"), "toxic", out, toxicity.FIT_ROWS))
    left = []
    for i, t in rows:
        words = re.findall(rb"[a-z0-9\x80-\xff]+", t.lower().encode())
        parts = {x for x in words} | {x[: toxicity.PREFIX] for x in words if len(x) > toxicity.PREFIX}
        found = {int(k) for x in parts for k in toxicity.features(np.frombuffer(x, dtype=np.uint8), np.array([0, len(x)]))[0] if x in words}
        own, _, _ = toxicity.features(np.frombuffer(t.lower().encode(), dtype=np.uint8), np.array([0, len(t.lower().encode())]))
        assert found >= set(own.tolist()) or not words
        if 1 / (1 + np.exp(-(sum(w[k] for k in own.tolist()) + b))) < toxicity.THRESHOLD:
            left.append((i, t))
    # near copies: all pairs
    classes = {i: c for i, c, _ in near(left)}
    left = [(i, t) for i, t in left if classes[i] == i]
    # benchmark: every item laid over every text at every place
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    bad = {i for i, *_ in leaks(left, items)}
    left = [(i, t) for i, t in left if i not in bad]
    # secrets: fixed patterns, and runs of characters under two models
    model = secret_scan.fit(secret_scan.corpus_samples(spark.createDataFrame(left, "doc_id long, text string")))
    clean = []
    for i, t in left:
        held = base(t)
        spans = list(held)
        for m in re.finditer(r"[A-Za-z0-9+/_-]{16,}", t) if model else ():
            x = m[0]
            r = sum(float(f"{model[ord(p) * 128 + ord(q)]:.6g}") for p, q in zip(x, x[1:], strict=False))
            each = secret_scan.LEAST_RATIO_PER_CHAR if re.search("[0-9]", x) else secret_scan.LEAST_RATIO_PER_LETTER
            if r >= max(secret_scan.LEAST_RATIO, each * len(x)) and not any(s <= m.start() and m.end() <= e for s, _, e, _ in held):
                spans.append((m.start(), 3, m.end(), "random"))
        at, new = 0, ""
        for s, _, e, _ in sorted(spans):
            if s >= at:
                new += t[at:s] + secret_scan.MASK
            at = max(at, e)
        clean.append((i, new + t[at:]))
    return clean, [i for (i, t), (_, u) in zip(left, clean, strict=True) if t != u]


def test_run_equals_brute_force(spark):
    got = P.run(spark, SF).collect()
    clean, masked = plain_run(spark, SF)
    assert sorted((r.doc_id, r.text) for r in got) == sorted(clean) and 50 < len(clean) < 200 and set(masked) <= {i for i, _ in clean}
    sized, pad = packed_by_hand(clean, packing.BUCKETS, packing.BUDGET)
    assert sum(r.padded_to - r.n_tokens for r in got) == pad
    order = sorted(got, key=lambda r: (r.bucket, r.batch, r.slot))
    assert [(r.n_tokens, r.doc_id) for r in order] == sized
    for r, before in zip(order[1:], order, strict=False):
        fit = max(1, packing.BUDGET // max(r.padded_to, 1))
        assert (r.batch, r.slot) == ((0, 0) if r.bucket != before.bucket else divmod(before.batch * fit + before.slot + 1, fit))


def test_stages_chain_before_they_are_written(spark):
    """Any stage takes the result of another that is not written yet; tables of a run are deleted with it, and no others."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = P.drop_near_copies(spark, docs, SF)
    chained = P.pack(spark, P.mask_secrets(spark, P.drop_contaminated(spark, kept, SF), SF), SF)
    with scratch.tables(spark):
        inside = scratch.written(docs.select("doc_id"))
        path = inside.inputFiles()[0].removeprefix("file:")
        assert inside.count() == docs.count() and os.path.exists("/" + path.lstrip("/"))
    assert not os.path.exists("/" + path.lstrip("/"))
    ids = {r.doc_id for r in chained.collect()}
    assert ids < {r.doc_id for r in kept.collect()} and len(ids) > 50


def test_five_stages():
    assert [n for n, _ in P.STAGES] == ["toxicity", "ngram_jaccard_join", "benchmark_decontamination", "secret_scans", "packing"]
    assert P.ORACLE_SQL is None


def _tables(spark, path, rows, labels, items):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, spans string, n_rows long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")


def test_odd_rows_and_empty_tables(spark, tmp_path):
    item = " ".join(f"bench{k}" for k in range(30))
    story = lambda seed, n=60: " ".join(f"w{seed}x{k}" for k in range(n))
    rows = [(None, None, None, None, None, None, None), (1, None, "en", "s", 0, "x", 1), (2, "", None, "s", 0, "x", 1), (None, story(1), "en", None, 1, "x", 1)]
    rows += [(3, story(2), "en", "s", 1, "x", 1)] * 2 + [(4, story(2), "en", "s", 1, "x", 1), (5, f"{story(3)} {item}", "en", "s", 1, "x", 1), (6, "token=" + "ab12" * 8 + " " + story(4), "en", "s", 1, "x", 1)]
    rows += [(7, story(5, 40_000), "en", "s", 1, "x", 1)] + [(100 + k, f"{story(200 + k)} idiot scum" if k % 2 else story(200 + k), "en", "s", 1, "x", 1) for k in range(120)]
    labels = [(100 + k, 1, k % 2) for k in range(120)] + [(None, 1, 1), (1, None, None)]
    _tables(spark, tmp_path / "a", rows, labels, [(0, item), (None, None), (1, "short one")])
    out = P.run(spark, str(tmp_path / "a")).collect()
    ids = sorted(r.doc_id for r in out if r.doc_id is not None)
    assert [i for i in ids if i < 100] == [1, 2, 3, 6, 7] and not [i for i in ids if i >= 100 and i % 2] and len([i for i in ids if i >= 100]) == 60
    assert sum(r.doc_id is None for r in out) == 2
    docs = spark.read.parquet(f"{tmp_path}/a/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path / "a")).schema == docs.schema
    masked = {r.doc_id: r.text for r in P.mask_secrets(spark, docs, str(tmp_path / "a")).collect()}
    assert masked[6].startswith("[SECRET] w4x0") and masked[7] == story(5, 40_000)
    _tables(spark, tmp_path / "b", [], [], [])
    assert P.run(spark, str(tmp_path / "b")).count() == 0
