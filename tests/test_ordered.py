"""Places of lines and rows in files of many parts and splits."""

import csv
import os

import pytest
from pyspark.sql import functions as F

from feedmill.operators.discovery import known_blogs
from feedmill.sources import tables as T
from feedmill.sources.ordered import ordered


def parts(tmp_path, name, texts):
    os.makedirs(tmp_path / name)
    for k, text in texts:
        (tmp_path / name / f"part-{k:05d}-x.txt").write_text(text, encoding="utf-8", newline="")
    return f"file://{tmp_path}/{name}"


@pytest.fixture()
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_lines_of_unequal_parts_in_small_splits(spark, tmp_path, small_splits):
    lines = [f"https://blog{i}.dev/{'x' * (i % 40)}" if i % 5 else ("", "# note", "  ")[i % 3] for i in range(700)]
    cuts = [0, 1, 3, 7, 40, 41, 300, 650, 700]
    path = parts(tmp_path, "list", [(k, "".join(x + ("\r\n" if i % 2 else "\n") for i, x in enumerate(lines[a:b]))) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))])
    rows = T.read_feed_list(spark, path)
    assert sorted(map(tuple, rows.collect())) == [(i, x) for i, x in enumerate(lines) if i % 5]
    assert rows.rdd.getNumPartitions() >= 1 and spark.read.text(path).rdd.getNumPartitions() > 8


def test_parts_go_by_number_and_other_files_by_path(spark, tmp_path):
    path = parts(tmp_path, "many", [(k, f"line{k}\n") for k in (99_999, 100_000, 2, 10)])
    assert [r.value for r in ordered(spark.read.text(path), "n").orderBy("n").collect()] == ["line2", "line10", "line99999", "line100000"]
    os.makedirs(tmp_path / "other")
    for name in ("b.txt", "a.txt"):
        (tmp_path / "other" / name).write_text(name)
    assert [r.value for r in ordered(spark.read.text(f"file://{tmp_path}/other"), "n").orderBy("n").collect()] == ["a.txt", "b.txt"]


@pytest.mark.parametrize("n", [1, 4, 64])
def test_written_and_read_back(spark, tmp_path, n):
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.range(200, numPartitions=n).select((199 - F.col("id")).alias("row_no"), *[F.concat(F.lit(f'{c} "1",\n'), F.col("id").cast("string")).alias(c) for c in ("weekly_name", "blog_name")], *[F.concat(F.lit("https://x.dev/"), (F.col("id") % 7).cast("string")).alias(c) for c in ("weekly_url", "blog_url")], F.when(F.col("id") % 3 == 0, "").otherwise(F.col("id").cast("string")).alias("rss"))
    T.write_blogs_csv(rows, f"file://{tmp_path}/blogs")
    back = T.read_blogs_csv(spark, f"file://{tmp_path}/blogs")
    assert [r.row_no for r in back.orderBy("row_no").collect()] == list(range(200))
    assert sorted(map(str, back.select(*rows.columns).collect())) == sorted(map(str, rows.collect()))
    assert sorted(map(tuple, known_blogs(back).collect())) == sorted(map(tuple, known_blogs(rows).collect()))
    T.write_feed_list(rows.select(F.col("row_no").alias("line_no"), F.concat(F.lit("u"), F.col("row_no").cast("string")).alias("url")), f"file://{tmp_path}/list")
    assert sorted(map(tuple, T.read_feed_list(spark, f"file://{tmp_path}/list").collect())) == [(i, f"u{i}") for i in range(200)]
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_first_rss_by_row_order_over_files(spark, tmp_path):
    os.makedirs(tmp_path / "blogs")
    for k, rss in enumerate(["", "first", "second", ""]):
        with open(tmp_path / "blogs" / f"part-{k:05d}.csv", "w", encoding="utf-8-sig", newline="") as f:
            csv.writer(f).writerows([T.BLOG_HEADERS, *[("w", "u", f"b{k} {j}\nline", "https://one.dev", rss) for j in range(10 * (4 - k))]])
    assert known_blogs(T.read_blogs_csv(spark, f"file://{tmp_path}/blogs")).collect()[0].rss == "first"


def test_empty_files(spark, tmp_path):
    assert T.read_feed_list(spark, parts(tmp_path, "none", [(0, ""), (1, "")])).count() == 0
