"""Conversation repair against brute force: every edit sequence's cost by recursion from the end."""

import hashlib
import random
import zlib
from functools import cache

import duckdb
import pytest

from seatloom.llm import conversation_repair as repair

SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, fault string, lines string"


def name(x):
    return " " if x is None else str(x)


def damaged(rows):
    out = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{name(c)}:{name(t)}".encode()) % 20
        role, text = "user" if kind == 4 else name(role), name(text)
        text = "" if kind == 1 else "".join(x for x in text if x not in ".!?") if kind == 2 else text
        out += [(c, t, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def edits(turns):
    """(role, text, fault) -> least (cost, audit, repaired lines)."""

    @cache
    def best(i, state, inserted):
        found = [(0, "", ())] if i == len(turns) and state in "-a" else []
        following = {"-": "u", "s": "u", "u": "a", "a": "u"}[state]
        role = {"u": "user", "a": "assistant"}[following]

        def go(cost, letter, lines, *rest):
            c, a, more = best(*rest)
            found.append((c + cost, letter + a, lines + more))

        if inserted < 3:
            go(2, "I", (f"{role}:",), i, following, inserted + 1)
        if i < len(turns):
            own, text, fault = turns[i]
            go(3, "D", (), i + 1, state, 0)
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                go(2 + more, "R", (f"{role}:{text}",), i + 1, following, 0)
                if own[:1] == following or (own[:1] == "s" and state == "-"):
                    go(more, "K", (f"{own}:{text}",), i + 1, own[:1], 0)
        return min(found, default=(1 << 60, "", ()))

    return best(0, "-", 0)


def brute(ids, rows):
    out = []
    for conv in ids:
        own = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, turns = set(), []
        for _, role, text in own:
            end = text.rstrip(SPACE)[-1:]
            turns.append((role, text, "blank" if not end else "duplicate" if (role, text) in seen else None if end in ".!?" else "truncated"))
            seen.add((role, text))
        known = {t for t, *_ in own if t is not None}
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        counts = [sum(f == x for *_, f in turns) for x in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
        cost, audit, lines = edits(tuple(turns))
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def result(rows, **more):
    return sorted((tuple(r) for r in repair.digest(repair.repair(rows, **more)).collect()), key=str)


@pytest.fixture(scope="module")
def made():
    """Random conversations: nulls, odd roles, repeats, ties, ids that drop whole conversations."""
    rng = random.Random(3)
    roles = ["user"] * 6 + ["assistant"] * 5 + ["system", "system", "User", "tool", "", None]
    texts = ["Yes.", "No!", "so", "", " \t", "Why?\n ", None, "é.", "x.  ", "a.b", "\x85?"]
    rows = [(rng.choice([None, *range(60)]), rng.choice([None, *range(8)]), rng.choice(roles), rng.choice(texts)) for _ in range(420)]
    return rows + [(1000 + i, i % 3, "user", "Only.") for i in range(60)] + [(99, i, rng.choice(["user", "assistant"]), f"{rng.choice('ab')}{i // 2}{rng.choice('. ')}") for i in range(90)]


@pytest.mark.parametrize("chunk", [256, 3])
def test_repair(spark, made, chunk):
    rows = [(*r, "x", "y") for r in made]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert result(repair.damage(frame), chunk=chunk) == brute({r[0] for r in made}, damaged(made))
    if chunk == 3:
        whole = [(c, t, name(r), name(x)) for c, t, r, x in made]
        assert result(frame, chunk=chunk) == brute({r[0] for r in made}, whole)


def test_sql(made):
    con = duckdb.connect()
    con.sql("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", made)
    assert sorted((tuple(r) for r in con.sql(repair.ORACLE_SQL).fetchall()), key=str) == brute({r[0] for r in made}, damaged(made))


def test_tables(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()]
    assert result(repair.damage(frame)) == brute({r[0] for r in rows}, damaged(rows))
    assert result(repair.damage(frame.limit(0))) == []


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "assistant", "Hello."), (1, 3, "user", "Go on."), (2, 0, "tool", " ")]
    got = repair.repaired(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy("conv_id", "turn").collect()
    assert [tuple(r) for r in got] == [
        (1, 0, "system", "Be kind.", "K"), (1, 1, "user", "", "I"), (1, 2, "assistant", "Hello.", "K"),
        (1, 3, "user", "Go on.", "K"), (1, 4, "assistant", "", "I"),
    ]


def test_long_conversation(spark):
    rows = [(5, i, "user" if i % 2 == 0 else "assistant", f"Turn {i}.") for i in range(20_000)]
    got = repair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    assert (got.cost, got.audit, len(got.lines), got.gaps) == (0, "K" * 20_000, 20_000, 0)
