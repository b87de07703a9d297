import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from feedmill.llm import collocations as C


def brute(rows, least, longest, top, absorbed):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n\v\f\r]", low):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        gone = set()
        for p, a in cand.items():
            for m in range(2, len(p)):
                gone |= {p[i : i + m] for i in range(len(p) - m + 1) if 100 * a >= absorbed * counts[p[i : i + m]]}
        found = []
        for p, a in cand.items():
            if p not in gone:
                score, k = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        found.sort()
        out += [(lang, rank, p.decode(), -a, l, r, n[lang], -s) for rank, (s, a, p, l, r) in enumerate(found[:top], 1)]
    return sorted(out)


def texts(seed, n=300):
    rng = random.Random(seed)
    words = ["the", "The", "of", "a", "b\x01", "b", "c", "\x00", "é", "语言", "x" * 30, "nbsp w", "-"] + [f"w{i}" for i in range(12)]
    weights = [20] + [3] * (len(words) - 1)
    out = []
    for _ in range(n):
        said = rng.choices(words, weights, k=rng.randint(0, 60))
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "\r\n"]) for w in said)
        out.append((rng.choice([text, text + " common phrase here today"]), rng.choice(["en", "en", "en", "de", None, "und", ""])))
    return out + [(None, "en"), ("", None), ("   ", "de"), (".", "xx"), ("one word in a new one", "yy")] + [("copy of the same row", "en")] * 40


@pytest.mark.parametrize(("seed", "partitions", "least", "longest"), [(1, "1", 4, 4), (2, "13", 4, 4), (3, "50", 3, 3), (4, "3", 2, 5), (5, "4", 30, 4), (6, "4", 2, 2)])
def test_equals_brute_force(spark, seed, partitions, least, longest):
    rows = texts(seed)
    docs = spark.createDataFrame([(i, t, x, 1) for i, (t, x) in enumerate(rows)], "doc_id long, text string, lang string, `a.b` int").repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = sorted(map(tuple, C.collocations(docs, least, longest, 40, 80).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == brute(rows, least, longest, 40, 80)


def test_small_steps_and_a_long_text(spark, monkeypatch):
    rows = [("Big data, big Data big data. " * 20_000, "en"), ("x " * 100 + "big data", "en")]
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert sorted(map(tuple, C.collocations(docs).collect())) == brute(rows, 30, 4, 2000, 80)


def test_scores_beyond_64_bits(spark):
    """Counts near 2^62: the streams' numbers are put in by hand."""
    a = 3 * 2**60
    phrases = spark.createDataFrame([("en", "x", a + 2**60), ("en", "y", a), ("en", "x y", a)], "lang string, phrase string, a long")
    row = C.measured(phrases).first()
    assert (row.l1, row.r1, row.a, row.extended) == (a + 2**60, a, a, None)
    assert C.ranked(C.measured(phrases), 4, 5, 80).first().score == 2_000_000 * a // (2 * a + 2**60)


def test_a_word_that_begins_most_phrases_is_spread_over_tasks(spark):
    rows = [("en", "the", 10**6)] + [("en", f"{w}{i}", 500) for i in range(900) for w in ("a",)] + [("en", f"the a{i}", 100 + i) for i in range(900)]
    phrases = spark.createDataFrame(rows, "lang string, phrase string, a long")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = C.measured(phrases).collect()
    spread = phrases.select("lang", F.split("phrase", " ").alias("w")).repartitionByRange("lang", "w").where("w[0] = 'the'").select(F.spark_partition_id().alias("p")).distinct().count()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spread > 2 and len(got) == 900 and all((r.l1, r.r1) == (10**6, 500) for r in got)


def test_empty_table(spark):
    assert C.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0


def test_sql_equals_the_query(spark):
    duckdb = pytest.importorskip("duckdb")
    rows = [(t and t.replace("\x00", "0"), x) for t, x in texts(7, 500)]
    con = duckdb.connect()
    con.execute("create table documents (text varchar, lang varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    got = C.collocations(spark.createDataFrame(rows, "text string, lang string"))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, con.sql(C.SQL).select(*got.columns).fetchall()))
