"""Sharding by jump consistent hashing, in DataFrame functions only.

A key's hash starts a random sequence of ascending shard numbers (jumps); its shard is the last one below the number
of shards. There is no ring or table to keep, and with more shards the same sequence only goes on: a key stays or
moves to an added shard, and the expected share that moves is added / all.

The jumps follow the published generator, a 64-bit linear congruence, which is kept in two halves since
arithmetic on longs must not overflow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.functions.text import let
from feedmill.llm.ordinals import shifts, sorted_table, task
from feedmill.llm.scratch import written

SHARDS = 24
#: Fixed value: the generator's factor.
FACTOR = 2862933555777941757
_LOW = (1 << 32) - 1
#: Steps that nearly all keys need; the others walk on.
_FIRST_STEPS = 7


def _times(x: Column, factor: int) -> Column:
    """x * factor modulo 2^32, both below 2^32."""
    return x * (factor & 0xFFFF) + F.shiftleft((x * (factor >> 16)).bitwiseAND(F.lit(0xFFFF)), 16)


def _next(high: Column, low: Column) -> tuple[Column, Column]:
    """The generator's next state."""
    upper = low * (FACTOR >> 16 & 0xFFFF)
    lower = low * (FACTOR & 0xFFFF) + F.shiftleft(upper.bitwiseAND(F.lit(0xFFFF)), 16) + 1
    carry = F.shiftright(lower, 32) + F.shiftright(upper, 16)
    return (carry + _times(high, FACTOR & _LOW) + _times(low, FACTOR >> 32)).bitwiseAND(F.lit(_LOW)), lower.bitwiseAND(F.lit(_LOW))


def jumps(key: Column, shards: int, grown: int) -> Column:
    """(shard, grown): the shards of a key among so many and among grown, which is no less.

    The key is taken as text, hashed by MD5; null is the empty text.
    """
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    half = lambda at: F.conv(F.substring(digest, at, 8), 16, 10).cast("long")
    zero = F.lit(0).cast("long")
    start = F.struct(zero.alias("jump"), zero.alias("shard"), zero.alias("grown"), half(1).alias("high"), half(9).alias("low"))

    def step(s: Column, _: Column) -> Column:
        high, low = _next(s["high"], s["low"])
        jump = ((s["jump"] + 1) * (F.lit(float(1 << 31)) / (F.shiftright(high, 1) + 1).cast("double"))).cast("long")
        shard = F.when(s["jump"] < shards, s["jump"]).otherwise(s["shard"])
        return F.when(s["jump"] < grown, F.struct(jump.alias("jump"), shard.alias("shard"), s["jump"].alias("grown"), high.alias("high"), low.alias("low"))).otherwise(s)

    walk = lambda s, steps: F.aggregate(F.sequence(F.lit(1), F.lit(steps)), s, step)
    # every jump is at least one shard further, so grown steps always do
    return let(walk(start, min(grown, _FIRST_STEPS)), lambda s: F.when(s["jump"] < grown, walk(s, grown)).otherwise(s))


def shard_of(key: Column | str, shards: int = SHARDS) -> Column:
    """The shard of a key, from 0 on."""
    return jumps(F.col(key) if isinstance(key, str) else key, shards, shards)["shard"].cast("int")


def byte_size(text: Column | str) -> Column:
    """UTF-8 bytes of a text, none for null, and 8 for its id."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def shard(docs: DataFrame, shards: int = SHARDS, added: int = 1) -> DataFrame:
    """Deal out documents (doc_id, text) by doc_id to shards, and say where they are with added more.

    Returns a row for each row of docs: doc_id, size (UTF-8 bytes of the text and 8), text_crc32 (of the UTF-8
    bytes), law ('key': doc_id and the number of shards alone decide), shard, slot (its place in the shard, from 0
    on without gaps), and grown_shard, which is either the same or one of the added shards.

    Slots go by doc_id, then size, then text_crc32; rows alike in all of them are in any order. Null doc_ids are one
    key and come first; rows of one doc_id share a shard, whatever their texts. Null and empty texts have size 8 and
    checksum 0. A shard's slots are counted by all tasks that hold rows of it, and texts are read once and not
    shuffled, so a shard of any size and a key of any number of rows is spread over tasks. Other columns are ignored; an
    empty table gives an empty one.
    """
    j = jumps(F.col("doc_id"), shards, shards + added)
    slim = docs.select("doc_id", byte_size("text").alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), j.alias("j"))
    slim = slim.select("doc_id", "size", "text_crc32", F.col("j.shard").cast("int").alias("shard"), F.col("j.grown").cast("int").alias("grown_shard"), F.monotonically_increasing_id().alias("spread"))
    placed = sorted_table(slim, "shard", "doc_id", "size", "text_crc32", "spread")
    starts = F.broadcast(written(shifts(placed, "shard").drop("total")))  # a row for each shard and task at most
    return placed.withColumn("task", task()).join(starts, ["shard", "task"]).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("at") + F.col("shift")).alias("slot"), "grown_shard")


def moved(docs: DataFrame, shards: int, grown: int) -> DataFrame:
    """The rows of docs that another number of shards moves, with their shard before (shard) and after (grown_shard).

    Where grown is larger, all go to the shards added; where it is smaller, all come from those that go.
    """
    few, many = sorted((shards, grown))
    j = jumps(F.col("doc_id"), few, many)
    names = ("shard", "grown") if grown >= shards else ("grown", "shard")
    rows = docs.withColumn("_j", j).where("_j.shard <> _j.grown")
    return rows.withColumns({"shard": F.col(f"_j.{names[0]}").cast("int"), "grown_shard": F.col(f"_j.{names[1]}").cast("int")}).drop("_j")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, files: int = 1) -> None:
    """docs as Parquet in a folder for each shard, of so many files at most, dealt by row and not by key."""
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns if c != "text"], F.monotonically_increasing_id()), F.lit(files))
    docs.withColumn("shard", shard_of("doc_id", shards)).repartition(shards * files, "shard", part).write.partitionBy("shard").parquet(path)


#: CRC-32 by half bytes: its table is four steps of the polynomial for each.
_NIBBLES = []
for _n in range(16):
    for _ in range(4):
        _n = (_n >> 1) ^ (0xEDB88320 if _n & 1 else 0)
    _NIBBLES.append(_n)


def crc32_sql(text: str) -> str:
    """CRC-32 of a text in DuckDB."""
    digits = f"regexp_extract_all(regexp_replace(hex(encode({text})), '(.)(.)', '\\2\\1', 'g'), '.')"
    values = f"list_transform({digits}, lambda d: CAST(strpos('0123456789ABCDEF', d) - 1 AS BIGINT))"
    fold = f"list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {values}), lambda c, d: xor({_NIBBLES}[(xor(c, d) & 15) + 1], c >> 4))"
    return f"xor({fold}, 4294967295)"


SQL = f"""
WITH RECURSIVE k AS (
  SELECT DISTINCT doc_id, CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 16)) AS UBIGINT)::HUGEINT AS seed FROM documents),
walk AS (
  SELECT doc_id, seed AS state, CAST(0 AS BIGINT) AS jump, CAST(0 AS BIGINT) AS shard, CAST(0 AS BIGINT) AS grown FROM k
  UNION ALL
  SELECT doc_id, state, CAST(trunc((jump + 1) * (CAST(2147483648 AS DOUBLE) / CAST((state >> 33) + 1 AS DOUBLE))) AS BIGINT), CASE WHEN jump < {SHARDS} THEN jump ELSE shard END, jump
  FROM (SELECT doc_id, (state * {FACTOR} + 1) % 18446744073709551616 AS state, jump, shard FROM walk WHERE jump < {SHARDS + 1})),
fin AS (SELECT doc_id, shard, grown FROM walk WHERE jump >= {SHARDS + 1}),
d AS (SELECT doc_id, CAST(strlen(coalesce(text, '')) + 8 AS BIGINT) AS size, CAST({crc32_sql("coalesce(text, '')")} AS BIGINT) AS text_crc32 FROM documents)
SELECT d.doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY d.doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, CAST(grown AS INTEGER) AS grown_shard
FROM d JOIN fin ON d.doc_id IS NOT DISTINCT FROM fin.doc_id
"""
