"""Discovery as a stream: listings, issue pages and feed responses land in any number of files, and the state follows.

One run of plans.sync needs all responses at hand. Here a landing is merged into the versioned state, and what
can't be decided yet waits in it: listed issues for their pages, new blogs for the responses of their candidate
feeds, feeds for the response that shows whether they are valid. A wait ends with the response, or when patience has
passed, by the time of landing; then what is missing counts as failed, as in a single run. Each landing is one version
that names it, so one that the engine runs again after a failure is merged once.

Bodies are reduced to two flags for each URL when they land; only the flags are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.functions.markup import is_valid_feed, looks_like_feed_head
from feedmill.functions.text import strip
from feedmill.functions.urls import candidate_feed_urls, normalize_url
from feedmill.operators import discovery as D
from feedmill.sources.shared import written
from feedmill.sources.state import State, Version, latest, read_state, write_state

#: What lands: kind is listing, issue or feed.
LANDED = "kind string, url string, http_status int, body string, landed_at timestamp"
_OPEN = "issue int, title string, url string, since timestamp"
_WAITING = "issue int, pos int, weekly_name string, weekly_url string, blog_name string, blog_url string, rss string, since timestamp"
_PROBES = "url string, head boolean, valid boolean"
_CHECKS = "url string, since timestamp, valid boolean"
PATIENCE = "3 days"


def begin(spark: SparkSession, path: str, blogs: DataFrame, issues: DataFrame, feed_list: DataFrame) -> Version:
    """The first version of a state: blogs, issues, and the feed list (line_no, url), of which nothing is checked yet."""
    others = {"open": _OPEN, "waiting": _WAITING, "probes": _PROBES, "checks": _CHECKS}
    return write_state(spark, path, None, State(blogs, issues, feed_list, {n: spark.createDataFrame([], s) for n, s in others.items()}), {"landing": -1, "now": None})


def _probed(blogs: DataFrame, probes: DataFrame, over: Column) -> DataFrame:
    """blogs with rss and done: whether their first working feed is known, or that there is none."""
    tries = blogs.select("blog_url", F.posexplode(candidate_feed_urls("blog_url")).alias("path", "url")).join(probes.select("url", "head"), "url", "left")
    found = tries.groupBy("blog_url").agg(F.min(F.when(F.col("head"), F.struct("path", "url"))).alias("good"), F.min(F.when(F.col("head").isNull(), F.col("path"))).alias("missing"))
    known = F.col("missing").isNull() | F.coalesce(F.col("good.path") < F.col("missing"), F.lit(False))
    rest = [c for c in blogs.columns if c not in ("rss", "blog_url")]
    return blogs.join(found, "blog_url").select(*rest, "blog_url", F.coalesce("good.url", F.lit("")).alias("rss"), (known | over).alias("done"))


def merge_landing(landed: DataFrame, path: str, landing: int, patience: str = PATIENCE, finish: bool = False) -> Version:
    """Merge rows (LANDED) into the last version of the state and write the next; a landing that is in it already is left out.

    finish: all waits are over.
    """
    spark = landed.sparkSession
    base = latest(spark, path)
    if landing <= base.note["landing"]:
        return base
    held = read_state(spark, base)
    # numbered once, not by each step that reads them
    held.blogs, held.feed_list = written(held.blogs), written(held.feed_list)
    now = landed.agg(F.max("landed_at").cast("string")).first()[0]
    now = max(t for t in (now, base.note["now"], "1970-01-01 00:00:00") if t)
    at = F.lit(now).cast("timestamp")
    over = F.lit(finish) | (F.col("since") + F.expr(f"interval {patience}") <= at)

    feeds = landed.where("kind = 'feed'").select("url", ((F.col("http_status") == 200) & looks_like_feed_head("body")).alias("head"), is_valid_feed("http_status", "body").alias("valid"))
    probes = written(held.others["probes"].unionByName(feeds).groupBy("url").agg(F.max(F.coalesce("head", F.lit(False))).alias("head"), F.max("valid").alias("valid")))

    listed = D.list_issues(landed.where("kind = 'listing'").select("url", "body")).select("issue", "title", F.col("issue_url").alias("url"))
    # a listing that lands twice in one landing names its issues twice
    fresh = D.new_issues(listed, held.issues).groupBy("url").agg(F.min(F.struct("issue", "title")).alias("f")).select("f.issue", "f.title", "url")
    fresh = written(fresh)
    unread = written(held.others["open"].unionByName(fresh.withColumn("since", at)))
    pages = landed.where("kind = 'issue' and http_status = 200").select(normalize_url("url").alias("url"), "body")
    read = unread.select("issue", "title", "url").join(pages, "url")

    known = D.known_blogs(held.blogs)
    linked = D.blogs_to_probe(D.extract_blogs(read, known), known).withColumn("since", at)
    columns = [c for c in linked.columns if c not in ("blog_url", "since")]
    first = held.others["waiting"].unionByName(linked).groupBy("blog_url").agg(F.min(F.struct(*columns)).alias("f"), F.min("since").alias("since"))
    tried = written(_probed(first.select("blog_url", "f.*", "since"), probes, over))
    blogs = written(D.append_blogs(held.blogs, tried.where("done").drop("done", "since")))

    wanted = held.feed_list.select("url").union(blogs.select(strip("rss").alias("url")).where("url <> ''")).distinct()
    checks = wanted.join(held.others["checks"].withColumnRenamed("valid", "known"), "url", "left").join(probes.select("url", F.col("valid").alias("found")), "url", "left")
    checks = checks.select("url", F.coalesce("since", at).alias("since"), "known", "found")
    checks = written(checks.select("url", "since", F.coalesce("known", "found", F.when(over, False)).alias("valid")))
    invalid = checks.where("not valid").select("url")
    good = blogs.select(strip("rss").alias("url"), "row_no").join(checks.where("valid").select("url"), "url").groupBy("url").agg(F.min("row_no").alias("row_no"))
    last = held.feed_list.agg(F.coalesce(F.max("line_no"), F.lit(-1))).first()[0]
    kept = held.feed_list.join(invalid, "url", "left_anti").select("line_no", "url")
    added = good.join(held.feed_list.select("url").distinct(), "url", "left_anti").select((F.col("row_no") + last + 1).alias("line_no"), "url")

    others = {
        "open": unread.join(pages.select("url").distinct(), "url", "left_anti").where(~over).select("issue", "title", "url", "since"),
        "waiting": tried.where("not done").drop("done").select("issue", "pos", "weekly_name", "weekly_url", "blog_name", "blog_url", "rss", "since"),
        "probes": probes, "checks": checks,
    }
    state = State(D.purge_invalid_rss(blogs, invalid).drop("purged"), held.issues.unionByName(fresh), kept.unionByName(added), others)
    return write_state(spark, path, base, state, {"landing": landing, "now": now})


def landings(spark: SparkSession, folder: str) -> DataFrame:
    """What lands in a folder of Parquet files."""
    return spark.readStream.schema(LANDED).parquet(folder)


def follow(landed: DataFrame, path: str, checkpoint: str, patience: str = PATIENCE):
    """Merge what has landed into the state and stop; started again with its checkpoint, it goes on from there."""
    return landed.writeStream.foreachBatch(lambda rows, n: merge_landing(rows, path, n, patience)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def close(spark: SparkSession, path: str) -> Version:
    """End all waits: what has not landed by now counts as failed."""
    return merge_landing(spark.createDataFrame([], LANDED), path, latest(spark, path).note["landing"] + 1, finish=True)
