"""The discovery workload: one incremental run over landed pages and responses."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.operators import discovery as D
from feedmill.sources.shared import written


@dataclass
class Synced:
    issues: DataFrame
    blogs: DataFrame
    feed_list: DataFrame
    stats: DataFrame


def sync(listing: DataFrame, issue_pages: DataFrame, issues: DataFrame, blogs: DataFrame, listed: DataFrame, responses: DataFrame) -> Synced:
    """Prune the feed list, read new issues, probe new blogs, and merge their feeds.

    listing: url, body of the listing page; issue_pages and responses: url, http_status, body. The known
    blogs are taken before the pruning, so a blog whose feed was purged isn't probed again. The result holds
    the whole new state; a second run on it adds nothing. Each step's table, small beside the bodies, is written.
    """
    known = D.known_blogs(blogs)
    pruned, kept = map(written, D.prune_feed_list(listed, blogs, responses))
    fetched = D.list_issues(listing).select("issue", "title", F.col("issue_url").alias("url"))
    fresh = written(D.new_issues(fetched, issues))
    pages = fresh.join(issue_pages.where("http_status = 200").select("url", "body"), "url")
    found = D.first_working_feed(written(D.blogs_to_probe(D.extract_blogs(pages, known), known)), responses)
    grown = written(D.append_blogs(kept, found))
    merged, final = map(written, D.merge_feed_list(pruned, grown, responses))
    return Synced(fetched, final, merged, D.sync_stats(issues, fresh, blogs, final, listed, merged))
