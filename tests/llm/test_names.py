"""Columns of any names, and very many equal rows."""

import time

import pytest
from pyspark.sql import functions as F

from feedmill.llm import decontamination, jaccard_join, packing, secret_scan, substring_dedup, toxicity

ODD = ("a.b", "x`y", "c0", "_row", "row")


@pytest.fixture()
def docs(spark):
    rows = [(k, f"Some plain words of text number {k} that nobody minds at all", "en") for k in range(30)] + [(40, "the password: hunter2hunter2 is here", "en"), (41, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for name in ODD:
        df = df.withColumn(name, F.concat(F.lit(name), F.col("doc_id").cast("string")))
    return df


def test_odd_names_stay_as_they_are(spark, docs):
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(30)], "doc_id long, toxic int")
    benchmark = spark.createDataFrame([(1, "a question that no text holds in any way")], "item_id long, text string")
    kept = {
        "redact": secret_scan.redact(docs, None), "keep_one": jaccard_join.keep_one(docs),
        "drop_contaminated": decontamination.drop_contaminated(docs, benchmark), "reject_toxic": toxicity.reject_toxic(docs, labels),
    }
    for name, out in kept.items():
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows and all(r[c] == f"{c}{r.doc_id}" for r in rows for c in ODD), name
    assert [r.text for r in kept["redact"].where("doc_id = 40").collect()] == ["the [SECRET] is here"]
    assert kept["drop_contaminated"].count() == docs.count() and packing.pack(docs, carry=("text",)).count() == docs.count()


def test_very_many_equal_rows_are_no_square(spark):
    text = " ".join(f"w{i}" for i in range(400))
    took = {}
    for n in (30, 3000):
        rows = spark.range(n).select(F.lit(7).cast("long").alias("doc_id"), F.lit(text).alias("text")).unionByName(spark.createDataFrame([(1, text)], "doc_id long, text string"))
        began = time.time()
        out = substring_dedup.dedup_substrings(rows).groupBy("doc_id", "n_removed").count().collect()
        took[n] = time.time() - began
        assert sorted(map(tuple, out)) == [(1, 0, 1), (7, 400, n)]
    assert took[3000] < took[30] + 15
