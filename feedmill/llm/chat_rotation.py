"""Chat formatting by perspective rotation, in DataFrame functions only.

A dialogue of several speakers is rendered once for each of them: that speaker is the assistant, every
other one a user with a name, and only the assistant's words carry loss. Context roles (system) are
nobody's perspective and stay as they are. A dialogue is cut into parts of a fixed number of turns, so a
very long one is many rows in many tasks; the dialogue's first context turn stands at the head of each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.llm.scratch import written

#: Turns of a part.
PART_TURNS = 64
CONTEXT_ROLES = ("system",)
#: What a name may not hold, as it would end a mark, and what stands for it.
NAME_MARKS = (("%", "%25"), ("|", "%7C"), ("<", "%3C"), (">", "%3E"), ("\n", "%0A"))


def _name(role: Column) -> Column:
    for mark, sign in NAME_MARKS:
        role = F.replace(role, F.lit(mark), F.lit(sign))
    return role


def _numbered(base: DataFrame) -> DataFrame:
    """base with place, the number of a turn in its dialogue from 0 on.

    One sort by ranges over all tasks, and the number of the dialogue's turns in the tasks before: a dialogue
    of any size is spread over them, whatever its turn numbers.
    """
    order = ("conv_id", "turn", "role", "text", "spread")
    dealt = base.withColumn("spread", F.monotonically_increasing_id())
    placed = written(dealt.repartitionByRange(*order).sortWithinPartitions(*order).drop("spread").withColumn("at", F.monotonically_increasing_id()))
    task = F.shiftrightunsigned("at", 33).alias("task")
    sizes = placed.groupBy("conv_id", task).agg(F.count("*").alias("n"), F.min("at").alias("first"))
    earlier = lambda own, all_: F.aggregate(F.filter(all_, lambda t: t["task"] < own["task"]), F.lit(0).cast("long"), lambda n, t: n + t["n"])
    # a dialogue has a row for each task that holds turns of it
    tasks = sizes.groupBy("conv_id").agg(F.collect_list(F.struct("task", "n", "first")).alias("tasks"))
    shift = tasks.select("conv_id", F.explode(F.transform("tasks", lambda t: F.struct(t["task"].alias("task"), (earlier(t, F.col("tasks")) - t["first"]).alias("shift")))).alias("s"))
    return placed.withColumn("task", task).join(shift.select("conv_id", "s.*"), ["conv_id", "task"]).withColumn("place", F.col("at") + F.col("shift")).drop("task", "at", "shift")


def _parts(base: DataFrame, part_turns: int, context_roles: tuple[str, ...]) -> DataFrame:
    """Dialogues of more turns than a part holds: conv_id, part, turns (role, text)."""
    placed = written(_numbered(base).withColumn("part", F.floor(F.col("place") / part_turns).cast("long")))
    turn = F.struct("place", "role", "text")
    context = placed.where(F.col("role").isin(*context_roles)).groupBy("conv_id").agg(F.min(turn).alias("context"))
    parts = placed.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(turn)).alias("turns")).join(context, "conv_id", "left")
    ahead = F.col("context").isNotNull() & (F.col("context.place") < F.col("turns")[0]["place"])
    turns = F.when(ahead, F.concat(F.array("context"), "turns")).otherwise(F.col("turns"))
    return parts.select("conv_id", "part", F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def rotate(turns: DataFrame, part_turns: int = PART_TURNS, context_roles: tuple[str, ...] = CONTEXT_ROLES) -> DataFrame:
    """Render each dialogue (conv_id, turn, role, text) from the perspective of each of its speakers.

    A message is <|system|>, <|assistant|> or <|user:name|> on a line, the text, and <|end|> on a line of its
    own. A text's own "<|" becomes "<||", and in names the characters of NAME_MARKS are percent-encoded, so
    nobody can write a mark. Returns for each conv_id, perspective (the speaker) and part (part_turns turns
    each, from 0 on): n_turns, n_own (messages of the speaker), text, and mask: the spans start:end of text
    that carry loss, in code points with the end exclusive, comma-joined: the speaker's words and the <|end|>
    after them. Parts after the first begin with the dialogue's first context turn, where there is one.

    Turns stand in order of turn, then role, then text; a null turn counts as 0. Null roles are the speaker
    'unknown', null texts are empty. Rows with null conv_id are left out. Equal rows are rendered as often as
    they occur. A speaker without words in a part still gets it, with an empty mask. A dialogue of context
    roles alone has no perspective and no row. A part is one row, however long its texts. Other columns are
    ignored; an empty table gives an empty one.
    """
    base = turns.where(F.col("conv_id").isNotNull()).select(
        "conv_id", F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"), F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    many = written(base.groupBy("conv_id").count().where(F.col("count") > part_turns).select("conv_id"))
    short = base.join(many, "conv_id", "left_anti").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    short = short.select("conv_id", F.lit(0).cast("long").alias("part"), F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    parts = short.unionByName(_parts(base.join(many, "conv_id", "left_semi"), part_turns, context_roles))
    speakers = base.where(~F.col("role").isin(*context_roles)).select("conv_id", F.col("role").alias("perspective")).distinct()
    whole = parts.join(speakers, "conv_id")
    me = F.col("perspective")
    head = lambda r: F.when(r.isin(*context_roles), F.concat(F.lit("<|"), r, F.lit("|>\n"))).when(r == me, F.lit("<|assistant|>\n")).otherwise(F.concat(F.lit("<|user:"), _name(r), F.lit("|>\n")))
    message = lambda t: F.struct((t["role"] == me).alias("own"), head(t["role"]).alias("head"), F.concat(F.replace(t["text"], F.lit("<|"), F.lit("<||")), F.lit("\n<|end|>")).alias("body"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("mask"))
    step = lambda acc, m: F.struct(
        (acc["at"] + F.length(m["head"]) + F.length(m["body"]) + 1).alias("at"),
        F.when(m["own"], F.concat(acc["mask"], F.array(F.concat_ws(":", (acc["at"] + F.length(m["head"])).cast("string"), (acc["at"] + F.length(m["head"]) + F.length(m["body"])).cast("string"))))).otherwise(acc["mask"]).alias("mask"),
    )
    messages = whole.select("conv_id", "perspective", "part", F.transform("turns", message).alias("m"))
    return messages.select(
        "conv_id", "perspective", "part", F.size("m").alias("n_turns"), F.size(F.filter("m", lambda m: m["own"])).alias("n_own"),
        F.concat(F.array_join(F.transform("m", lambda m: F.concat(m["head"], m["body"])), "\n"), F.lit("\n")).alias("text"),
        F.array_join(F.aggregate("m", zero, step)["mask"], ",").alias("mask"),
    )


SQL = r"""
WITH base AS (
  SELECT conv_id, coalesce(turn, 0) AS turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS place FROM base),
speakers AS (SELECT DISTINCT conv_id, role AS perspective FROM base WHERE role <> 'system'),
parted AS (
  SELECT conv_id, place // 64 AS part, place, role, text FROM numbered
  UNION ALL
  SELECT conv_id, part, c.place, role, text FROM (SELECT conv_id, min(place) AS place FROM numbered WHERE role = 'system' GROUP BY conv_id) c
  JOIN numbered USING (conv_id, place) JOIN (SELECT DISTINCT conv_id, place // 64 AS part FROM numbered) p USING (conv_id) WHERE c.place < part * 64),
said AS (
  SELECT b.conv_id, s.perspective, b.part, b.place, b.role = s.perspective AS own,
         CASE WHEN b.role = 'system' THEN '<|system|>' || chr(10) WHEN b.role = s.perspective THEN '<|assistant|>' || chr(10)
              ELSE '<|user:' || replace(replace(replace(replace(replace(b.role, '%', '%25'), '|', '%7C'), '<', '%3C'), '>', '%3E'), chr(10), '%0A') || '|>' || chr(10) END AS head,
         replace(b.text, '<|', '<||') || chr(10) || '<|end|>' AS body
  FROM parted b JOIN speakers s ON b.conv_id = s.conv_id),
placed AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, perspective, part ORDER BY place
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins
  FROM said)
SELECT conv_id, perspective, CAST(part AS BIGINT) AS part, CAST(count(*) AS INTEGER) AS n_turns, CAST(count(*) FILTER (WHERE own) AS INTEGER) AS n_own,
       string_agg(head || body, chr(10) ORDER BY place) || chr(10) AS text,
       coalesce(string_agg(CAST(CAST(begins + length(head) AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(begins + length(head) + length(body) AS BIGINT) AS VARCHAR), ',' ORDER BY place) FILTER (WHERE own), '') AS mask
FROM placed GROUP BY conv_id, perspective, part
"""
