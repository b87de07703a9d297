import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from feedmill.llm import conversation_repair as R

FORM = re.compile(r"(s?(ua)+)?\Z")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind != 0:
            row = (conv, turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
            out += [row] * (2 if kind == 3 else 1)
    return out


def cheapest(codes):
    """(cost, audit, roles given) by trying all edits, row by row, of each state's best."""
    step = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", ())}

    def fill(values):
        for state in list(values):
            cost, audit, plan = values[state]
            for _ in range(3):
                state = step[state]
                cost, audit, plan = cost + 2, audit + "I", plan + (("I", state),)
                if state not in values or (cost, audit) < values[state][:2]:
                    values[state] = (cost, audit, plan)
        return values

    for code in codes:
        new = {}

        def offer(state, value):
            if state not in new or value[:2] < new[state][:2]:
                new[state] = value

        for state, (cost, audit, plan) in fill(best).items():
            offer(state, (cost + 3, audit + "D", plan + (("D", ""),)))
            if code != "-":
                extra, after = int(code.isupper()), step[state]
                if code.lower() == after:
                    offer(after, (cost + extra, audit + "K", plan + (("K", ""),)))
                if code.lower() == "s" and state == "":
                    offer("s", (cost + extra, audit + "K", plan + (("K", ""),)))
                offer(after, (cost + 2 + extra, audit + "R", plan + (("R", after),)))
        best = new
    return min((v for s, v in fill(best).items() if s in ("", "a")), key=lambda v: v[:2])


def expected(rows, ids):
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    out = {}
    for conv in ids:
        rs = sorted(groups[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        turns = [r[1] for r in rs if r[1] is not None]
        seen, faults, codes = set(), [], ""
        for _, _, role, text in rs:
            fault = "blank" if not re.search(r"[^\x20\x09-\x0D]", text) else "duplicate" if (role, text) in seen else "truncated" if text.strip(" \t\n\v\f\r")[-1] not in ".!?" else ""
            seen.add((role, text))
            initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
            faults.append(fault)
            codes += "-" if fault in ("blank", "duplicate") else initial.upper() if fault else initial
        cost, audit, plan = cheapest(codes)
        made, initials, k = [], "", 0
        for edit, role in plan:
            name = {"u": "user", "a": "assistant"}.get(role)
            row = rs[k] if edit != "I" else None
            if edit != "D":
                made.append((name or row[2]) + ":" + (row[3] if row else ""))
                initials += made[-1][0]
            k += edit != "I"
        assert FORM.match(initials)
        illegal = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in zip(rs, rs[1:], strict=False))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest())
    return out


def conversations(seed, n=60, longest=12):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "User", None]) if rng.random() < 0.4 else ("user", "assistant")[turn % 2]
            text = rng.choice(["Yes.", "No!", "Why?  ", "cut off", " \t", "", None, "é語.", "a\nb. "]) if rng.random() < 0.5 else f"Text {rng.random()}."
            rows.append((conv, rng.choice([turn, turn, turn, turn * 3, None]), role, text))
    return rows + [(None, 1, "user", "Hi."), (None, None, "assistant", "Yo."), (10_000, None, None, None)]


@pytest.mark.parametrize(("seed", "block", "fanout"), [(1, 256, 64), (2, 1, 2), (3, 3, 2), (4, 2, 3)])
def test_equals_brute_force(spark, seed, block, fanout):
    rows = conversations(seed)
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, `a.b` string").repartition(7)
    got = {r.conv_id: tuple(r)[1:] for r in R.report(R.damage(df), df, block=block, fanout=fanout).collect()}
    assert got == expected(damaged(rows), {r[0] for r in rows})


@pytest.mark.parametrize("block", [256, 8])
def test_the_repaired_turns(spark, block):
    rows = conversations(9, 30, 30)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = defaultdict(list)
    for r in R.repair(df, block=block, fanout=2).collect():
        turns[r.conv_id].append(r)
    want = expected([(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows], {r[0] for r in rows})
    for conv, w in want.items():
        rs = sorted(turns[conv], key=lambda r: r.position)
        assert [r.position for r in rs] == list(range(len(rs))) and FORM.match("".join(r.role[0] for r in rs))
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in rs).encode()).hexdigest() == w[-1]
        assert "".join(r.edit for r in rs) == w[-2].replace("D", "")


def test_a_conversation_with_most_rows_is_cut_into_blocks(spark):
    rng = random.Random(5)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"T{rng.randint(0, 4000)}" + rng.choice([".", ""])) for t in range(3000)] + [(c, 0, "user", "Hm.") for c in range(2, 40)] + [(1, 7, "user", "Same.")] * 500
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    got = {r.conv_id: tuple(r)[1:] for r in R.report(df, block=64, fanout=4).collect()}
    assert got == expected(rows, {r[0] for r in rows})


def test_long_texts_and_empty_tables(spark):
    rows = [(1, 0, "user", "w " * 600_000 + "."), (1, 1, "assistant", "x" * 1_000_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert {r.conv_id: tuple(r)[1:] for r in R.report(df).collect()} == expected(rows, {1})
    assert R.report(df.limit(0)).count() == 0 and R.repair(df.limit(0)).count() == 0
    only_dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    gone = spark.createDataFrame([(only_dropped, 0, "user", "a.")], df.schema)
    assert tuple(R.report(R.damage(gone), gone).first()) == (only_dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())


def test_the_agenda_settles_the_lightest_of_equals():
    found = R.block_spans("uu", True, True)
    at = R.NOTHING * 5 + R.GOAL
    assert (found["cost"][at], found["path"][at]) == (2, "KA") and cheapest("uu")[:2] == (2, "KR")
    for seed in range(300):
        codes = "".join(random.Random(seed).choices("suaxSUAX-", k=random.Random(seed).randint(0, 14)))
        found = R.block_spans(codes, True, True)
        assert (found["cost"][at], found["path"][at].translate(str.maketrans("uaUA", "IIRR"))) == cheapest(codes)[:2]


@pytest.mark.parametrize("seed", [11, 12])
def test_sql_equals_the_report(spark, seed):
    duckdb = pytest.importorskip("duckdb")
    rows = [(c, t, r, x) for c, t, r, x in conversations(seed)]
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = R.report(R.damage(df), df, block=4, fanout=2)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, con.sql(R.SQL).select(*got.columns).fetchall()))
