"""Repair of conversation structure by Knuth's lightest derivations.

A conversation is well formed if the initials of its roles read (s?(ua)+)?. Items [k, state] say that the first k rows
have been repaired into roles that end in a state of that pattern. Edits are weighted deductions over items:

    [k, s], row k kept       |- [k + 1, s']   K, 0 (1 if the row is cut off)
    [k, s], row k re-roled   |- [k + 1, s']   R, 2 (3 if cut off)
    [k, s], row k deleted    |- [k + 1, s]    D, 3
    [k, s], a turn put in    |- [k, s']       I, 2
    [n, s], s may be the end |- goal

A value is (cost, audit), the audit being the edits' initials. Each deduction adds its cost and appends its letter, so
it is monotone and superior: values never fall, and of two values of an item the lighter stays lighter (at equal
cost neither audit begins with the other, as they hold the same number of rows' letters). So an agenda that pops
the lightest value settles an item when it first pops it, and ends with the goal.

A conversation of any length is cut into blocks of a bounded number of rows, and spans [block, state, state'] of several
blocks are items too: [p..q, s, t] and [q..r, t, u] give [p..r, s, u]. Costs add up; of equally cheap
derivations the one with the least audit is known by the order of the children's audits, so no audit travels
upwards. Spans join in rounds over all conversations, a bounded number of children at a time, up to the
whole; then the chosen states go down to the blocks. No task holds a whole conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce
from heapq import heappop, heappush

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.llm.ordinals import shifts, sorted_table, task
from feedmill.llm.scratch import written
from feedmill.llm.sharding import crc32_sql

#: Rows of a block, and children of a span.
BLOCK, FANOUT = 256, 64
#: States: nothing yet, after a system turn, after a user turn, after an assistant turn; and the goal.
NOTHING, SYSTEM, USER, ASSISTANT, GOAL = range(5)
_STATES, _EXITS = 4, 5
#: What follows a state: the role that must come, by its initial, and the state after it.
_NEXT = {NOTHING: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
_SPANS = "struct<cost: array<long>, place: array<int>, path: array<string>>"

KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, CUT_OFF_COST = 0, 2, 3, 2, 1


def _row_steps(codes: str, k: int, state: int, last: bool) -> Iterator[tuple[int, int, int, str]]:
    """Deductions from [k, state]: k, state, cost and letter after each.

    A code is the row's initial (s, u, a, or x for others), in upper case if the row is cut off, or - if it must go.
    Turns are put in before a row, so after the last row only at the conversation's end.
    """
    role, after = _NEXT[state]
    if k < len(codes):
        code = codes[k]
        yield k + 1, state, DELETE_COST, "D"
        if code != "-":
            extra = CUT_OFF_COST if code.isupper() else 0
            own = code.lower()
            if own == role:
                yield k + 1, after, KEEP_COST + extra, "K"
            elif own == "s" and state == NOTHING:
                yield k + 1, SYSTEM, KEEP_COST + extra, "K"
            yield k + 1, after, REROLE_COST + extra, "R"
        yield k, after, INSERT_COST, "I"
    elif last:
        if state in (NOTHING, ASSISTANT):
            yield k + 1, GOAL, 0, ""
        yield k, after, INSERT_COST, "I"


def lightest(n: int, steps, entry: int, wanted: set[int]) -> dict[int, tuple[int, str]]:
    """(cost, audit) of the wanted states after n steps, from [0, entry]: the agenda pops values in their order until they are settled.

    steps(k, state) gives the deductions from an item.
    """
    agenda, settled, found = [(0, "", 0, entry)], set(), {}
    while agenda and len(found) < len(wanted):
        cost, audit, k, state = heappop(agenda)
        if (k, state) in settled:
            continue
        settled.add((k, state))
        if k == n and state in wanted:
            found[state] = (cost, audit)
        if state == GOAL:
            continue
        for k2, state2, more, letter in steps(k, state):
            if (k2, state2) not in settled:
                heappush(agenda, (cost + more, audit + letter, k2, state2))
    return found


def _script(codes: str, state: int, audit: str) -> str:
    """The audit with the roles that it gives: u and a for turns put in, U and A for re-roled ones."""
    out, k = [], 0
    for letter in audit:
        role, after = _NEXT[state]
        if letter == "K" and codes[k] in "sS":
            after = SYSTEM
        if letter != "D":
            state = after
        out.append(role if letter == "I" else role.upper() if letter == "R" else letter)
        k += letter != "I"
    return "".join(out)


def _table(found_by_entry: dict[int, dict[int, tuple[int, str]]], path) -> dict:
    """Costs, places in the order of audits, and paths, by entry and exit."""
    cost, place, paths = ([None] * (_STATES * _EXITS) for _ in range(3))
    for entry, found in found_by_entry.items():
        for rank, (audit, exit_) in enumerate(sorted((audit, e) for e, (_, audit) in found.items())):
            at = entry * _EXITS + exit_
            cost[at], place[at], paths[at] = found[exit_][0], rank, path(entry, audit)
    return {"cost": cost, "place": place, "path": paths}


@lru_cache(maxsize=1 << 14)
def block_spans(codes: str, first: bool, last: bool) -> dict:
    """The lightest derivations of a block between all states; a first block begins with nothing, a last one ends in the goal."""
    entries = (NOTHING,) if first else range(_STATES)
    n, wanted = len(codes) + last, {GOAL} if last else set(range(_STATES))
    found = {e: lightest(n, lambda k, s: _row_steps(codes, k, s, last), e, wanted) for e in entries}
    return _table(found, lambda entry, audit: _script(codes, entry, audit))


def joined_spans(costs: list, places: list, first: bool, last: bool) -> dict:
    """The lightest derivations of children one after another, from theirs; a path is the states at their borders."""
    n = len(costs)

    def steps(k: int, state: int) -> Iterator[tuple[int, int, int, str]]:
        if k < n:
            for exit_ in range(_EXITS):
                at = state * _EXITS + exit_
                if costs[k][at] is not None:
                    yield k + 1, exit_, int(costs[k][at]), chr(int(places[k][at]))

    def path(entry: int, audit: str) -> str:
        states = [entry]
        for k, letter in enumerate(audit):
            here = range(states[-1] * _EXITS, (states[-1] + 1) * _EXITS)
            states.append(next(at % _EXITS for at in here if costs[k][at] is not None and int(places[k][at]) == ord(letter)))
        return "".join(map(str, states))

    entries = (NOTHING,) if first else range(_STATES)
    return _table({e: lightest(n, steps, e, {GOAL} if last else set(range(_STATES))) for e in entries}, path)


def _block_column(codes: Column, first: Column, last: Column) -> Column:
    def of(c: pd.Series, f: pd.Series, z: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([block_spans(*x) for x in zip(c, map(bool, f), map(bool, z), strict=True)], columns=["cost", "place", "path"])

    return F.pandas_udf(of, _SPANS)(codes, first, last)


def _whole(x) -> list:
    """A list whose missing numbers, which pandas turns into NaN, are None again."""
    return [None if v is None or v != v else int(v) for v in x]


def _span_column(costs: Column, places: Column, first: Column, last: Column) -> Column:
    def of(c: pd.Series, p: pd.Series, f: pd.Series, z: pd.Series) -> pd.DataFrame:
        rows = [joined_spans([_whole(x) for x in cs], [_whole(x) for x in ps], bool(a), bool(b)) for cs, ps, a, b in zip(c, p, f, z, strict=True)]
        return pd.DataFrame(rows, columns=["cost", "place", "path"])

    return F.pandas_udf(of, _SPANS)(costs, places, first, last)


def _same(a: DataFrame, b: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """A join on conv_id, where null is a value too, and further keys."""
    other = b.select(*[F.col(c).alias(f"_{c}") if c in ("conv_id", *keys) else F.col(c) for c in b.columns])
    on = reduce(lambda x, y: x & y, [F.col(k) == F.col(f"_{k}") for k in keys], F.col("conv_id").eqNullSafe(F.col("_conv_id")))
    return a.join(other, on, how).drop(*[f"_{c}" for c in ("conv_id", *keys)])


#: Fixed value: what counts as white space.
_SPACES = r"\x20\x09-\x0D"


def _placed(turns: DataFrame) -> DataFrame:
    """All rows in order, with at."""
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), F.monotonically_increasing_id().alias("spread"))
    return sorted_table(rows, "conv_id", "turn", "role", "text", "spread").drop("spread")


def _coded(placed: DataFrame, block: int) -> DataFrame:
    """conv_id, turn, at, block, place, total, initial, fault and code of each row."""
    first = placed.groupBy("conv_id", "role", F.sha2("text", 256).alias("mark")).agg(F.min("at").alias("at")).select("at", F.lit(True).alias("new"))
    blank = ~F.col("text").rlike(f"[^{_SPACES}]")
    cut = ~F.col("text").rlike(rf"[.!?][{_SPACES}]*\z")
    slim = placed.select("conv_id", "turn", "at", F.substring("role", 1, 1).alias("initial"), blank.alias("blank"), cut.alias("cut")).join(first, "at", "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("new").isNull(), "duplicate").when(F.col("cut"), "truncated").otherwise("")
    known = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("x")
    code = F.when(F.col("fault").isin("blank", "duplicate"), "-").when(F.col("fault") == "truncated", F.upper("initial")).otherwise(F.col("initial"))
    slim = slim.select("conv_id", "turn", "at", known.alias("initial"), fault.alias("fault")).withColumn("code", code)
    numbered = _same(slim.withColumn("task", task()), shifts(placed, "conv_id"), "task")
    place = F.col("at") + F.col("shift")
    return numbered.select("conv_id", "turn", "at", "initial", "fault", "code", place.alias("place"), F.floor(place / block).alias("block"), "total")


def _blocks(coded: DataFrame, block: int) -> DataFrame:
    """A row for each block: its codes and initials in order, the rows' at, and counts of faults."""
    count = lambda kind: F.count_if(F.col("fault") == kind).alias(kind)
    rows = coded.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list(F.struct("place", "code", "initial", "at"))).alias("r"), F.max("total").alias("total"), count("blank"), count("duplicate"), count("truncated"))
    text = lambda field: F.array_join(F.transform("r", lambda x: x[field]), "").alias(f"{field}s")
    return rows.select("conv_id", "block", text("code"), text("initial"), F.transform("r", lambda x: x["at"]).alias("ats"), (F.col("total") <= (F.col("block") + 1) * block).alias("last"), "blank", "duplicate", "truncated")


def _derived(blocks: DataFrame, fanout: int) -> tuple[DataFrame, DataFrame]:
    """(conv_id, cost) of the lightest derivations and (conv_id, block, script) of their parts."""
    spans = _block_column(F.col("codes"), F.col("block") == 0, F.col("last"))
    level = written(blocks.select("conv_id", F.col("block").alias("node"), "last", spans.alias("s")).select("conv_id", "node", "last", "s.*"))
    levels = [level]
    while level.where("node > 0").limit(1).count():
        child = F.struct("node", "cost", "place", "last")
        groups = level.groupBy("conv_id", F.floor(F.col("node") / fanout).alias("node")).agg(F.array_sort(F.collect_list(child)).alias("c"), F.max("last").alias("last"))
        spans = _span_column(F.transform("c", lambda x: x["cost"]), F.transform("c", lambda x: x["place"]), F.col("node") == 0, F.col("last"))
        level = written(groups.select("conv_id", "node", "last", spans.alias("s")).select("conv_id", "node", "last", "s.*"))
        levels.append(level)
    top = F.element_at("cost", GOAL + 1)
    costs = level.select("conv_id", top.alias("total_cost"))
    chosen = level.select("conv_id", "node", F.lit(NOTHING).alias("entry"), F.lit(GOAL).alias("exit"))
    for level in reversed(levels):
        picked = _same(level.select("conv_id", "node", "path"), chosen, "node").select("conv_id", "node", F.element_at("path", F.col("entry") * _EXITS + F.col("exit") + 1).alias("path"))
        if level is levels[0]:
            break
        pairs = F.transform(F.sequence(F.lit(1), F.length("path") - 1), lambda i: F.struct((i - 1).alias("k"), F.substring("path", i, F.lit(1)).cast("int").alias("entry"), F.substring("path", i + 1, F.lit(1)).cast("int").alias("exit")))
        chosen = picked.select("conv_id", "node", F.explode(pairs).alias("p")).select("conv_id", (F.col("node") * fanout + F.col("p.k")).alias("node"), "p.entry", "p.exit")
    return costs, picked.select("conv_id", F.col("node").alias("block"), F.col("path").alias("script"))


def _in_order(placed: DataFrame, blocks: DataFrame, scripts: DataFrame, fold, schema: str) -> DataFrame:
    """fold over the rows of each conversation in order, each with what its script does there.

    A row's part of the script and the row itself meet in one sort by (conv_id, at), and a task reads its
    conversations row by row: it holds one row at a time, however long a conversation is.
    """
    parts = F.regexp_extract_all("script", F.lit("([ua]*[UAKD](?:[ua]*$)?)"), F.lit(1))
    met = _same(blocks.select("conv_id", "block", "ats"), scripts, "block").select("conv_id", F.explode(F.arrays_zip(parts.alias("part"), F.col("ats").alias("at"))).alias("x"))
    none = F.lit(None).cast("string")
    both = met.select("conv_id", "x.at", F.col("x.part").alias("part"), none.alias("role"), none.alias("text")).unionByName(placed.select("conv_id", "at", none.alias("part"), "role", "text"))
    dealt = both.repartition("conv_id").sortWithinPartitions("conv_id", "at", F.col("part").isNull())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return fold(_pairs(batches))

    return dealt.mapInArrow(read, schema)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    part = None
    for batch in batches:
        for conv, p, role, text in zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("conv_id", "part", "role", "text")], strict=True):
            if p is not None:
                part = p
            else:
                yield conv, part, role, text


def _turns(part: str, role: str, text: str) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the turns that a row's part of the script gives."""
    for letter in part:
        if letter == "K":
            yield "K", role, text
        elif letter in "ua":
            yield "I", "user" if letter == "u" else "assistant", ""
        elif letter in "UA":
            yield "R", "user" if letter == "U" else "assistant", text


def _solve(turns: DataFrame, block: int, fanout: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    placed = _placed(turns)
    coded = _coded(placed, block)
    blocks = written(_blocks(coded, block))
    costs, scripts = _derived(blocks, fanout)
    return placed, coded, blocks, costs, written(scripts)


def repair(turns: DataFrame, block: int = BLOCK, fanout: int = FANOUT) -> DataFrame:
    """The turns of every conversation after its cheapest repair: conv_id, position (from 0 on), edit (K, R or I), role, text.

    turns: conv_id, turn, role, text. Rows go by turn, nulls first, then role, then text; null roles and texts are
    one space, and null conv_ids one conversation. A row without any other characters than white space (blank), or
    with the role and text of an earlier one (duplicate), is deleted; one that does not end with . ! or ?
    (truncated) may stay at a cost of 1. A role counts by its first character. Of equally cheap repairs the one whose
    edits' letters are least is taken. A conversation whose cheapest repair deletes all has no row. Other
    columns are ignored; an empty table gives an empty one. Very long texts and conversations of any number of rows
    are whole; a conversation's rows pass one task at the end, one at a time.
    """
    placed, _, blocks, _, scripts = _solve(turns, block, fanout)
    kind = turns.schema["conv_id"].dataType.simpleString()
    to_arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]

    def rows(pairs: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        names = ("conv_id", "position", "edit", "role", "text")
        types = (to_arrow, pa.int64(), pa.string(), pa.string(), pa.string())
        out, size, position, last = [[] for _ in names], 0, 0, object()
        for conv, part, role, text in pairs:
            position, last = (position, last) if conv == last else (0, conv)
            for edit, r, t in _turns(part, role, text):
                for column, v in zip(out, (conv, position, edit, r, t), strict=True):
                    column.append(v)
                position, size = position + 1, size + len(t) + 64
            if size > 1 << 22:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)
                out, size = [[] for _ in names], 0
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)

    return _in_order(placed, blocks, scripts, rows, f"conv_id {kind}, position long, edit string, role string, text string")


def report(turns: DataFrame, all_ids: DataFrame | None = None, block: int = BLOCK, fanout: int = FANOUT) -> DataFrame:
    """One row for each conversation of turns, or of all_ids: its faults, the cheapest repair and a digest of the result.

    Returns conv_id, gaps (turn numbers missing between the least and the largest), blank, duplicate, truncated
    (rows by their first fault), illegal (neighbours whose roles may not follow each other), cost, audit (the
    edits' letters in order), repaired_sha256 (of the repaired turns as role:text, one on a line). A conversation of
    all_ids without rows has zeros, an empty audit and the digest of an empty text. Else as repair().
    """
    placed, coded, blocks, costs, scripts = _solve(turns, block, fanout)
    kind = turns.schema["conv_id"].dataType.simpleString()
    to_arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]

    def digests(pairs: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        ids, found, last, digest, begun = [], [], object(), None, False
        for conv, part, role, text in pairs:
            if conv != last:
                if digest:
                    ids.append(last)
                    found.append(digest.hexdigest())
                    if len(ids) >= 1 << 14:
                        yield pa.RecordBatch.from_arrays([pa.array(ids, to_arrow), pa.array(found, pa.string())], ["conv_id", "sha"])
                        ids, found = [], []
                last, digest, begun = conv, hashlib.sha256(), False
            for _, r, t in _turns(part, role, text):
                digest.update((("\n" if begun else "") + r + ":" + t).encode())
                begun = True
        if digest:
            ids.append(last)
            found.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([pa.array(ids, to_arrow), pa.array(found, pa.string())], ["conv_id", "sha"])

    shas = _in_order(placed, blocks, scripts, digests, f"conv_id {kind}, sha string")
    numbers = coded.groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    pair = lambda at: ~F.substring("initials", at, F.lit(2)).isin("su", "ua", "au")
    inside = F.size(F.filter(F.sequence(F.lit(0), F.length("initials") - 1), lambda i: (i > 0) & pair(i)))
    edges = blocks.select("conv_id", (F.col("block") + 1).alias("block"), F.right("initials", F.lit(1)).alias("before"))
    border = F.col("before").isNotNull() & ~F.concat("before", F.left("initials", F.lit(1))).isin("su", "ua", "au")
    met = _same_left(blocks, edges)
    faults = met.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")], F.sum(inside + border.cast("int")).alias("illegal"))
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "script"))), lambda x: x["script"]), "")
    audits = scripts.groupBy("conv_id").agg(F.translate(audit, "uaUA", "IIRR").alias("audit"))
    out = (all_ids or turns).select("conv_id").distinct()
    for part in (numbers, faults, costs, audits, shas):
        out = _same(out, part, how="left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return out.select("conv_id", *[zero(c).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal")], zero("total_cost").alias("cost"), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def _same_left(blocks: DataFrame, edges: DataFrame) -> DataFrame:
    return _same(blocks, edges, "block", how="left")


def damage(turns: DataFrame) -> DataFrame:
    """turns with faults put in by the CRC-32 of conv_id:turn modulo 20 (a null is one space, as are null roles and texts).

    0 drops a row, 1 empties its text, 2 takes out its . ! and ?, 3 repeats it, 4 makes its role user.
    """
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key) % 20
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), kind.alias("kind")).where("kind <> 0")
    k = F.col("kind")
    return rows.select(
        "conv_id", "turn", F.when(k == 4, "user").otherwise(F.col("role")).alias("role"), F.when(k == 1, "").when(k == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(k == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _plus(value: str, cost: str, letter: str) -> str:
    """A value, its cost in nine digits and its audit in one text, so that texts compare like values."""
    return f"(lpad(CAST(CAST({value}[1:9] AS BIGINT) + {cost} AS VARCHAR), 9, '0') || {value}[10:] || '{letter}')"


_KEY = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
#: The same in DuckDB: the best value of each state, row after row.
SQL = rf"""
WITH RECURSIVE src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32_sql(_KEY)} % 20 AS kind FROM conversations),
dam AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM src, range(0, 2) r(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
ord AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM dam),
num AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) AS seen FROM ord),
flt AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^{_SPACES}]') THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?][{_SPACES}]*\z') THEN 'truncated' ELSE '' END AS fault,
  role[1:1] AS i, lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY k) AS before FROM num),
cod AS (SELECT *, fault IN ('blank', 'duplicate') AS gone, CAST(fault = 'truncated' AS INTEGER) AS cut FROM flt),
ids AS (SELECT DISTINCT conv_id FROM conversations),
w AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS k, '000000000' AS v0, CAST(NULL AS VARCHAR) AS v1, CAST(NULL AS VARCHAR) AS v2, CAST(NULL AS VARCHAR) AS v3 FROM ids
  UNION ALL
  SELECT f.conv_id, c.k, {_plus("v0", "3", "D")}, least({_plus("v1", "3", "D")}, CASE WHEN NOT gone AND i = 's' THEN {_plus("v0", "cut", "K")} END),
    least({_plus("v2", "3", "D")}, CASE WHEN NOT gone THEN {_plus("least(v0, v1, v3)", "2 + cut", "R")} END, CASE WHEN NOT gone AND i = 'u' THEN {_plus("least(v0, v1, v3)", "cut", "K")} END),
    least({_plus("v3", "3", "D")}, CASE WHEN NOT gone THEN {_plus("v2", "2 + cut", "R")} END, CASE WHEN NOT gone AND i = 'a' THEN {_plus("v2", "cut", "K")} END)
  FROM (SELECT conv_id, k, v0, v1, v2, least(v3, {_plus("v2", "2", "I")}) AS v3 FROM (SELECT conv_id, k, v0, v1, v3, least(v2, {_plus("least(v0, v1, v3)", "2", "I")}) AS v2 FROM w) e) f
  JOIN cod c ON c.conv_id IS NOT DISTINCT FROM f.conv_id AND c.k = f.k + 1),
fin AS (SELECT conv_id, least(v0, v3, {_plus("v2", "2", "I")}, {_plus("v1", "4", "II")}, {_plus("v0", "4", "II")}) AS v FROM w QUALIFY k = max(k) OVER (PARTITION BY conv_id)),
let AS (SELECT conv_id, p, v[9 + p] AS edit, count(*) FILTER (WHERE v[9 + p] <> 'I') OVER o AS k, count(*) FILTER (WHERE v[9 + p] <> 'D') OVER o AS e
  FROM (SELECT conv_id, v, unnest(range(1, length(v) - 8)) AS p FROM fin) WINDOW o AS (PARTITION BY conv_id ORDER BY p)),
giv AS (SELECT l.conv_id, l.p, l.e, l.edit, c.role, c.text, CAST(bool_or(l.edit = 'K' AND l.e = 1 AND c.i = 's') OVER (PARTITION BY l.conv_id) AS INTEGER) AS head
  FROM let l LEFT JOIN cod c ON c.conv_id IS NOT DISTINCT FROM l.conv_id AND c.k = l.k AND l.edit <> 'I' WHERE l.edit <> 'D'),
rep AS (SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (e - head) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY p)) AS sha FROM giv GROUP BY conv_id),
cnt AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
  count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal FROM cod GROUP BY conv_id)
SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(v[1:9] AS BIGINT) AS cost, v[10:] AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM ids d JOIN fin ON fin.conv_id IS NOT DISTINCT FROM d.conv_id LEFT JOIN cnt ON cnt.conv_id IS NOT DISTINCT FROM d.conv_id LEFT JOIN rep ON rep.conv_id IS NOT DISTINCT FROM d.conv_id
"""
