"""Batches of prompts out, JSON answers of a text model in."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.functions.text import or_else, strip
from feedmill.schemas import CATEGORY_IDS, MODEL_RESPONSES
from feedmill.sources.shared import written

BATCH = 15
#: Prompts of an Arrow batch that a task turns into Python texts at a time.
PROMPTS = 256
ANSWERS = "key string, response string, error string"
DEFAULT_SCORE = 5
SEPARATOR = "\n\n---\n\n"
SCORING_GUIDE = (
    "Rate each article from 1 to 10 for relevance to people who build software, quality of the writing and timeliness. "
    f"Pick one category of {', '.join(CATEGORY_IDS)}, two to four short English keywords, and a topic slug of two to four "
    "English words that all articles on one event share."
)
SCORING_ANSWER = 'Answer with JSON only: {"results":[{"index":0,"relevance":8,"quality":7,"timeliness":9,"category":"engineering","keywords":["Rust"],"topic":"rust-release"}]}'
SUMMARY_GUIDE = (
    "For each article give a title in the asked language, a summary of three to five sentences on the problem, the method "
    "and what a reader can do with it this week, and one sentence on why it is worth reading."
)
SUMMARY_LANG = {"zh": "Write everything in Chinese.", "en": "Write everything in English."}
SUMMARY_ANSWER = 'Answer with JSON only: {"results":[{"index":0,"titleZh":"...","summary":"...","reason":"..."}]}'
HIGHLIGHT_GUIDE = "From these articles, write three to five sentences on what a reader can do today or this week. Plain text only."


def assign_batches(df: DataFrame, order: list[str], size: int = BATCH, edition: str | None = None) -> DataFrame:
    """Dense idx from 0 on in the given order, and batch_id = idx div size.

    With an edition column, numbers start anew in each edition. Rows are sorted by range and numbered by the
    offset of their partition, so neither all rows nor a large edition are in one task.
    """
    keys = [edition, *order] if edition else order
    ids = written(df.orderBy(*keys).select("*", F.spark_partition_id().alias("_part"), (F.monotonically_increasing_id() % (1 << 33)).alias("_row")))
    before, starts = 0, []
    for part, n in sorted(ids.groupBy("_part").count().collect()):  # a row for each partition
        starts.append((part, before))
        before += n
    offsets = df.sparkSession.createDataFrame(starts, "_part int, _before long")
    numbered = ids.join(F.broadcast(offsets), "_part").withColumn("idx", F.col("_row") + F.col("_before")).drop("_part", "_row", "_before")
    if edition:
        first = numbered.groupBy(edition).agg(F.min("idx").alias("_first"))
        numbered = numbered.join(first, edition).withColumn("idx", F.col("idx") - F.col("_first")).drop("_first")
    return numbered.select(*df.columns, "idx", F.expr(f"idx div {size}").alias("batch_id"))


def _prompts(batches: DataFrame, line: Column, keys: list[str], frame: Callable[[Column], Column]) -> DataFrame:
    lines = batches.select(*keys, F.struct("idx", line.alias("line")).alias("l")).groupBy(*keys).agg(F.array_sort(F.collect_list("l")).alias("ls"))
    return lines.select(*keys, frame(F.array_join(F.transform("ls", lambda x: x["line"]), SEPARATOR)).alias("prompt"))


def scoring_prompts(batches: DataFrame, keys: tuple[str, ...] = ("batch_id",)) -> DataFrame:
    """One scoring prompt for each batch of (idx, source_name, title, description)."""
    line = F.concat(F.lit("Index "), F.col("idx").cast("string"), F.lit(": ["), "source_name", F.lit("] "), "title", F.lit("\n"), F.substring("description", 1, 300))
    return _prompts(batches, line, list(keys), lambda articles: F.concat(F.lit(SCORING_GUIDE + "\n\n"), articles, F.lit("\n\n" + SCORING_ANSWER)))


def summary_prompts(batches: DataFrame, lang: str = "zh", keys: tuple[str, ...] = ("batch_id",)) -> DataFrame:
    """One summary prompt for each batch of (idx, source_name, title, link, description)."""
    line = F.concat(F.lit("Index "), F.col("idx").cast("string"), F.lit(": ["), "source_name", F.lit("] "), "title", F.lit("\nURL: "), "link", F.lit("\n"), F.substring("description", 1, 800))
    return _prompts(batches, line, list(keys), lambda articles: F.concat(F.lit(f"{SUMMARY_GUIDE} {SUMMARY_LANG[lang]}\n\n"), articles, F.lit("\n\n" + SUMMARY_ANSWER)))


def highlight_prompt(digest: DataFrame, lang: str = "zh") -> DataFrame:
    """One prompt for each edition from its first ten articles."""
    line = F.concat(F.col("rank").cast("string"), F.lit(". ["), "category", F.lit("] "), or_else(F.col("title_zh"), F.col("title")), F.lit(" — "), F.substring("summary", 1, 100))
    top = digest.where("rank <= 10").select("edition", F.struct("rank", line.alias("line")).alias("l")).groupBy("edition").agg(F.array_sort(F.collect_list("l")).alias("ls"))
    articles = F.array_join(F.transform("ls", lambda x: x["line"]), "\n")
    return top.select("edition", F.concat(F.lit(f"{HIGHLIGHT_GUIDE} {SUMMARY_LANG[lang]}\n\n"), articles).alias("prompt"))


def strip_code_fence(text: Column | str) -> Column:
    """Without the Markdown fence around it, if it has one."""
    bare = strip(text)
    return F.when(bare.startswith("```"), F.regexp_replace(F.regexp_replace(bare, r"^```(?:json)?\n?", ""), r"\n?```\z", "")).otherwise(bare)


def parsed_json(text: Column | str) -> Column:
    """Variant of a whole JSON object, fenced or not; null if it isn't one (also with text after it or a key twice)."""
    bare = strip(strip_code_fence(text))
    return F.try_parse_json(F.when(bare.endswith("}"), bare))


def coerce_score(v: Column) -> Column:
    """A variant as a score: rounded half up, 1 to 10; JSON null and false are 1; absent or not a number is 5."""
    number = F.try_variant_get(v, "$", "double")
    flag = F.try_variant_get(v, "$", "boolean")
    text = F.try_variant_get(v, "$", "string")
    empty = F.is_variant_null(v) | (F.schema_of_variant(v) == "BOOLEAN") | ((F.schema_of_variant(v) == "STRING") & (strip(text) == ""))
    clamped = F.greatest(F.lit(1), F.least(F.lit(10), F.floor(F.least(F.greatest(number, F.lit(-1e6)), F.lit(1e6)) + 0.5))).cast("int")
    return F.when(v.isNull(), DEFAULT_SCORE).when(empty, F.lit(1)).when(number.isNull() | F.isnan(number) & flag.isNull(), DEFAULT_SCORE).otherwise(clamped)


def coerce_category(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.when(c.isin(*CATEGORY_IDS), c), F.lit("other"))


def topic_slug(topic: Column | str) -> Column:
    """Lower-case letters and digits joined by single dashes; misc if nothing is left."""
    topic = F.col(topic) if isinstance(topic, str) else topic
    dashed = F.regexp_replace(F.lower(topic), "[^a-z0-9]+", "-")
    return or_else(F.regexp_replace(dashed, r"^-+|-+\z", ""), F.lit("misc"))


def answer_rows(responses: DataFrame) -> DataFrame:
    """(batch_id, ok, pos, item): a row for each element of results, or one with null pos where there is none.

    ok is false if the call failed, the answer is not a JSON object, or an element is null: then the whole
    batch counts as failed.
    """
    read = responses.select("batch_id", F.when(F.col("error").isNull(), parsed_json("response")).alias("v"))
    listed = read.select("batch_id", F.col("v").isNotNull().alias("read"), F.try_variant_get("v", "$.results", "array<variant>").alias("items"))
    ok = listed.withColumn("ok", F.col("read") & ~F.coalesce(F.exists("items", lambda i: F.is_variant_null(i)), F.lit(False)))
    return ok.select("batch_id", "ok", F.posexplode_outer("items").alias("pos", "item"))


def _index(item: Column) -> Column:
    """The index of an element, if it is a JSON number."""
    raw = F.try_variant_get(item, "$.index", "variant")
    return F.when(F.schema_of_variant(raw).rlike("^(?:BIGINT|DECIMAL|DOUBLE)"), F.try_variant_get(item, "$.index", "double")).try_cast("long")


def parse_score_responses(responses: DataFrame) -> DataFrame:
    """(batch_id, idx, relevance, quality, timeliness, category, keywords, topic) from model answers.

    An element whose topic is neither text nor empty fails its batch, as a null element does. Of several
    elements with one index the last by (batch_id, position) counts. Failed batches have no rows here:
    attach_scores gives their articles the defaults.
    """
    rows = answer_rows(responses)
    field = lambda name: F.try_variant_get("item", f"$.{name}", "variant")
    topic = field("topic")
    odd = topic.isNotNull() & ~F.is_variant_null(topic) & (F.schema_of_variant(topic) != "STRING") & ~F.coalesce((F.try_variant_get("item", "$.topic", "double") == 0) | ~F.try_variant_get("item", "$.topic", "boolean"), F.lit(False))
    rows = rows.withColumn("odd", F.coalesce(odd, F.lit(False)))
    failed = rows.groupBy("batch_id").agg(F.max(F.col("odd") | ~F.col("ok")).alias("failed")).where("not failed").select("batch_id")
    fields = rows.where("pos is not null").join(failed, "batch_id", "left_semi").select(
        "batch_id", "pos", _index(F.col("item")).alias("idx"),
        *[coerce_score(field(c)).alias(c) for c in ("relevance", "quality", "timeliness")],
        coerce_category(F.try_variant_get("item", "$.category", "string")).alias("category"),
        F.coalesce(F.slice(F.try_variant_get("item", "$.keywords", "array<string>"), 1, 4), F.array().cast("array<string>")).alias("keywords"),
        topic_slug(F.try_variant_get("item", "$.topic", "string")).alias("topic"),
    )
    last = fields.where("idx is not null").groupBy("idx").agg(F.max_by(F.struct("batch_id", "relevance", "quality", "timeliness", "category", "keywords", "topic"), F.struct("batch_id", "pos")).alias("s"))
    return last.select("s.batch_id", "idx", "s.relevance", "s.quality", "s.timeliness", "s.category", "s.keywords", "s.topic")


def attach_scores(articles: DataFrame, scores: DataFrame, key: str = "idx") -> DataFrame:
    """Articles with their scores, defaults where there are none, and total_score."""
    s = scores.select(key, *[F.col(c).alias(f"_{c}") for c in ("relevance", "quality", "timeliness", "category", "keywords", "topic")])
    out = articles.join(s, key, "left")
    for c in ("relevance", "quality", "timeliness"):
        out = out.withColumn(c, F.coalesce(f"_{c}", F.lit(DEFAULT_SCORE)))
    out = out.withColumn("category", F.coalesce("_category", F.lit("other"))).withColumn("keywords", F.coalesce("_keywords", F.array().cast("array<string>"))).withColumn("topic", F.coalesce("_topic", F.lit("misc")))
    return out.drop(*[f"_{c}" for c in ("relevance", "quality", "timeliness", "category", "keywords", "topic")]).withColumn("total_score", F.col("relevance") + F.col("quality") + F.col("timeliness"))


def parse_summary_responses(responses: DataFrame) -> DataFrame:
    """(idx, title_zh, summary, reason) from model answers, the last of each index; failed batches have no rows."""
    text = lambda name: F.coalesce(F.try_variant_get("item", f"$.{name}", "string"), F.lit(""))
    rows = answer_rows(responses).where("ok and pos is not null").select("batch_id", "pos", _index(F.col("item")).alias("idx"), text("titleZh").alias("title_zh"), text("summary").alias("summary"), text("reason").alias("reason"))
    last = rows.where("idx is not null").groupBy("idx").agg(F.max_by(F.struct("title_zh", "summary", "reason"), F.struct("batch_id", "pos")).alias("s"))
    return last.select("idx", "s.title_zh", "s.summary", "s.reason")


def attach_summaries(articles: DataFrame, responses: DataFrame) -> DataFrame:
    """Articles (idx, batch_id, title, description) with title_zh, summary and reason.

    Without an answer for the index: (title, title, '') if its batch failed, else (title, the first 200
    characters of the description, '').
    """
    found = parse_summary_responses(responses).withColumn("found", F.lit(True))
    status = answer_rows(responses).groupBy("batch_id").agg(F.min("ok").alias("batch_ok"))
    out = articles.join(found, "idx", "left").join(status, "batch_id", "left")
    failed = ~F.coalesce("batch_ok", F.lit(True))
    return out.select(
        *articles.columns, F.when(F.col("found"), F.col("title_zh")).otherwise(F.col("title")).alias("title_zh"),
        F.when(F.col("found"), F.col("summary")).when(failed, F.col("title")).otherwise(F.substring("description", 1, 200)).alias("summary"),
        F.coalesce("reason", F.lit("")).alias("reason"),
    )


def apply_model(prompts: DataFrame, model: Callable[[str], str], fallback: Callable[[str], str] | None = None) -> DataFrame:
    """Answers (batch_id, response, error) of a given text-to-text function.

    Once model has failed in a partition, fallback answers there from then on. A failure of the last choice
    is recorded with the batch and stops nothing.
    """

    return prompts.select(F.col("batch_id").cast("long").alias("batch_id"), "prompt").mapInArrow(_answer_task(model, fallback, "batch_id", 1), MODEL_RESPONSES)


def _answer_task(model: Callable[[str], str], fallback: Callable[[str], str] | None, key: str, at_once: int):
    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        choices = [f for f in (model, fallback) if f is not None]

        def ask(prompt: str) -> tuple[str | None, str | None]:
            error = None
            for f in list(choices):
                try:
                    return f(prompt), None
                except Exception as e:  # noqa: BLE001 - whatever the client raises belongs to the batch
                    error = f"{type(e).__name__}: {e}"
                    if len(choices) > 1 and choices[0] is f:
                        choices.pop(0)
            return None, error

        with ThreadPoolExecutor(at_once) as calls:
            for part in (batch.slice(at, PROMPTS) for batch in batches for at in range(0, batch.num_rows, PROMPTS)):
                asked = (p.as_py() for p in part.column("prompt"))
                rows = list(map(ask, asked) if at_once == 1 else calls.map(ask, asked))
                yield pa.record_batch([part.column(key), pa.array([r for r, _ in rows], pa.string()), pa.array([e for _, e in rows], pa.string())], [key, "response", "error"])

    return answer


def land_answers(prompts: DataFrame, path: str, model: Callable[[str], str], fallback: Callable[[str], str] | None = None, at_once: int = 4, round_size: int = 10_000) -> DataFrame:
    """Answers (batch_id, response, error) to prompts (batch_id, prompt), of which only those that have not landed under path are asked for.

    An answer is kept by the SHA-256 of its prompt, so equal prompts are asked once, whichever run or batch they stand
    in. Prompts without one are asked in rounds of about round_size, and each round's answers land before the next
    begins: a run that is stopped, and started again, asks for the rest. A task has at most at_once calls open; when
    Spark runs a task of a round again, it asks again for that task's prompts alone. Failed calls land with their
    error and are asked again by the next run; a batch has the error of its last call, if none succeeded.
    """
    spark = prompts.sparkSession
    asked = written(prompts.select(F.col("batch_id").cast("long").alias("batch_id"), F.sha2("prompt", 256).alias("key"), "prompt"))
    open_ = asked.join(_landed(spark, path).where("error is null").select("key").distinct(), "key", "left_anti").groupBy("key").agg(F.first("prompt").alias("prompt"))
    todo = written(open_.repartitionByRange("key").sortWithinPartitions("key"))
    rounds = -(-todo.count() // round_size)
    edges = ["", *[f"{k * 2**32 // rounds:08x}" for k in range(1, rounds)], "g"]
    for low, high in zip(edges[:rounds], edges[1:], strict=False):
        # keys are spread evenly, and a range of them is a few row groups of the sorted table
        part = todo.where((F.col("key") >= low) & (F.col("key") < high))
        part.mapInArrow(_answer_task(model, fallback, "key", at_once), ANSWERS).withColumn("run", F.current_timestamp()).write.mode("append").parquet(path)
    best = _landed(spark, path).groupBy("key").agg(F.min_by(F.struct("response", "error"), F.struct(F.col("error").isNotNull(), -F.unix_micros("run"))).alias("a"))
    return asked.join(best, "key", "left").select("batch_id", "a.response", "a.error")


def _landed(spark: SparkSession, path: str) -> DataFrame:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
    schema = f"{ANSWERS}, run timestamp"
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)
