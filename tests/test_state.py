"""Versions of the state: failed runs, two writers, pinned readers."""

import os

import pytest
from pyspark.sql import functions as F

from feedmill.schemas import BLOGS, ISSUES
from feedmill.sources import state as S


def tables(spark, n, start=0):
    blogs = spark.range(start, n, numPartitions=3).select(F.col("id").alias("row_no"), F.lit("w").alias("weekly_name"), F.lit("u").alias("weekly_url"), F.lit("b").alias("blog_name"), F.concat(F.lit("https://b.dev/"), F.col("id").cast("string")).alias("blog_url"), F.lit("").alias("rss"))
    issues = spark.createDataFrame([(1, "One", "https://s/1")], ISSUES)
    listed = spark.range(n).select(F.col("id").alias("line_no"), F.concat(F.lit("https://f.dev/"), F.col("id").cast("string")).alias("url"))
    return S.State(blogs, issues, listed, {"seen": spark.range(n)})


def held(spark, path):
    version = S.latest(spark, path)
    state = S.read_state(spark, version)
    return version.number, sorted(r.blog_url for r in state.blogs.collect()), [r.line_no for r in state.feed_list.orderBy("line_no").collect()], state.others["seen"].count(), state.issues.count()


@pytest.fixture()
def path(tmp_path):
    return f"file://{tmp_path}/state"


def test_a_version_is_read_changed_and_written_again(spark, path):
    assert S.latest(spark, path) is None
    one = S.write_state(spark, path, None, tables(spark, 5), {"run": 1})
    state = S.read_state(spark, one)
    old = state.blogs.where("row_no < 3")
    more = S.State(state.blogs.unionByName(state.blogs.withColumns({"row_no": F.col("row_no") + 5, "blog_url": F.concat("blog_url", F.lit("/x"))})), state.issues, state.feed_list, state.others)
    two = S.write_state(spark, path, one, more)
    assert held(spark, path)[:3] == (2, sorted([f"https://b.dev/{i}" for i in range(5)] + [f"https://b.dev/{i}/x" for i in range(5)]), list(range(5)))
    assert sorted(r.row_no for r in old.collect()) == [0, 1, 2]  # read from the version that it was made from
    assert [r.row_no for r in S.read_state(spark, two).blogs.orderBy("row_no").collect()] == list(range(10))
    assert S.latest(spark, path).note == {} and one.note == {"run": 1}


def test_a_run_that_fails_half_way_changes_nothing(spark, path, tmp_path):
    one = S.write_state(spark, path, None, tables(spark, 6))
    before = held(spark, path)

    @F.udf("string")
    def broken(i):
        if i > 3:
            raise ValueError("no more")
        return "x"

    state = tables(spark, 6)
    for bad in (S.State(state.blogs.withColumn("rss", broken("row_no")), state.issues, state.feed_list, {}), S.State(state.blogs, state.issues, state.feed_list, {"seen": state.feed_list.withColumn("x", broken("line_no"))})):
        with pytest.raises(Exception, match="no more"):
            S.write_state(spark, path, one, bad)
        assert held(spark, path) == before
    # tasks that were killed late may have left files, which no manifest names
    assert os.listdir(tmp_path / "state" / "manifests") and S.write_state(spark, path, one, state).number == 2


def test_of_two_writers_the_second_has_to_start_again(spark, path):
    one = S.write_state(spark, path, None, tables(spark, 2))
    S.write_state(spark, path, one, tables(spark, 3))
    with pytest.raises(S.Outdated):
        S.write_state(spark, path, one, tables(spark, 9))
    assert held(spark, path)[0] == 2 and len(held(spark, path)[1]) == 3
    S.write_state(spark, path, S.latest(spark, path), tables(spark, 9))
    assert len(held(spark, path)[1]) == 9


def test_old_versions_and_left_folders_go(spark, path, tmp_path):
    version = None
    for n in range(1, 5):
        version = S.write_state(spark, path, version, tables(spark, n))
    os.makedirs(tmp_path / "state" / "version-left")
    assert S.expire(spark, path, keep=2) == 3
    assert held(spark, path)[0] == 4 and len(os.listdir(tmp_path / "state")) == 3
    assert S.write_state(spark, path, S.latest(spark, path), tables(spark, 1)).number == 5


def test_empty_tables(spark, path):
    S.write_state(spark, path, None, S.State(spark.createDataFrame([], BLOGS), spark.createDataFrame([], ISSUES), spark.createDataFrame([], "line_no long, url string"), {"seen": spark.range(0)}))
    assert held(spark, path) == (1, [], [], 0, 0)
