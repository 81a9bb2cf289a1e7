"""Conversation repair against cheapest edits found by trying all, and against its SQL."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orderlens.llm import conversations as C
from orderlens.llm.oracle import conversation_repair
from orderlens.llm.queries import op12_conversation_repair
from tests.conftest import SMALL

NAMES = "gaps blank duplicate truncated illegal cost audit repaired_sha256".split()


def brute_edits(shape: str) -> tuple[int, str]:
    """The least (cost, edits) by state, row after row."""
    best = {0: (0, "")}

    def close(best):
        for _ in range(2):
            for s, (c, e) in list(best.items()):
                t = C.NEXT[s][C.GIVEN[s][0]]
                best[t] = min(best.get(t, (10**9, "")), (c + 3, e + "I"))
        return best

    best = close(best)
    for letter in shape:
        more = {}

        def put(state, cost, edits):
            more[state] = min(more.get(state, (10**9, "")), (cost, edits))

        for s, (c, e) in best.items():
            put(s, c + 4, e + "D")
            if letter != "x":
                extra = 3 if letter.isupper() else 0
                put(C.NEXT[s][C.GIVEN[s][0]], c + 3 + extra, e + "R")
                if letter.lower() in C.NEXT[s]:
                    put(C.NEXT[s][letter.lower()], c + extra, e + "K")
        best = close(more)
    return min(best[s] for s in (0, 3) if s in best)


def brute(rows: list[tuple]) -> dict:
    """The contract over (conv_id, turn, role, text), word for word."""
    given = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        out = given[conv]
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        row = ((turn is not None, turn or 0), "user" if fault == 4 else role, hashlib.sha256(text.encode()).digest(), turn, text)
        out += [row] * (2 if fault == 3 else 1)
    result = {}
    for conv, out in given.items():
        out.sort(key=lambda r: r[:3])
        seen, shape, counts, lines = set(), "", [0, 0, 0], []
        for _, role, _, _, text in out:
            blank, again = not re.search(r"[^\x20\x09-\x0D]", text), (role, text) in seen
            cut = not re.search(r"[.!?][\x20\x09-\x0D]*\Z", text)
            seen.add((role, text))
            letter = role[0] if role[:1] in ("s", "u", "a") else "o"
            if blank or again:
                counts[0 if blank else 1] += 1
                letter = "x"
            elif cut:
                counts[2] += 1
                letter = letter.upper()
            shape += letter
        initials = [r[1][:1] for r in out]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = brute_edits(shape)
        state, left = 0, list(out)
        for edit in audit:
            role = C.GIVEN[state]
            text = ""
            if edit != "I":
                _, own, _, _, text = left.pop(0)
                role = own if edit == "K" else role
            if edit != "D":
                lines.append(f"{role}:{text}")
                state = C.NEXT[state][role[0]]
        turns = [r[3] for r in out if r[3] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        result[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return result


def results(df):
    return {r.conv_id: tuple(r[n] for n in NAMES) for r in df.collect()}


@settings(max_examples=300, deadline=None)
@given(st.text("suaoSUAOx", min_size=1, max_size=24), st.integers(1, 9))
def test_auction_finds_the_least_of_the_cheapest_edits(shape, size):
    """In one segment, or in several that know only the costs behind them."""
    parts = [shape[k : k + size] for k in range(0, len(shape), size)]
    after, behind = C.TAIL_COST, []
    for part in reversed(parts):
        behind.append(after)
        table = C.crossing(part)
        after = [min(table[s * 4 + t] + after[t] for t in range(4) if table[s * 4 + t] >= 0) for s in range(4)]
    state, edits = 0, ""
    for part, tail in zip(parts, reversed(behind)):
        ways, exits, costs = C.traced(part, tail)
        if not edits:
            assert costs[0] == after[0] == brute_edits(shape)[0]
        edits += ways[state]
        state = exits[state]
    assert edits + C.TAIL[state] == brute_edits(shape)[1]


def test_prices_stay_within_the_costs_of_arcs():
    arcs, price, alive = C.priced("uaSxoUa", C.TAIL_COST)
    assert all(price[i] <= c + price[j] for i, out in enumerate(arcs) if alive[i] for _, c, j in out)


def test_registered_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert results(op12_conversation_repair(spark, SMALL)) == brute(rows)


SCHEMA = "conv_id long, turn long, role string, text string"


def awkward_rows():
    rows = [(1, k, "user" if k % 2 else "assistant", f"line {k}." if k % 7 else "line without end") for k in range(700)]
    rows += [(2, None, "user", "Hm."), (2, None, "user", "Hm."), (2, 3, None, None), (2, 3, "assistant", "So."), (2, 3, "assistant", "So.")]
    rows += [(None, 0, "user", "Hi?"), (None, None, "assistant", "Yes.\n\n"), (None, 5, "tool", "x" * 50_000)]
    rows += [(k, 0, "system", "Be good.") for k in range(10, 60)] + [(k, 1, "", "What?") for k in range(20, 30)]
    rows += [(70, k // 3, "user", "Same.") for k in range(300)] + [(71, 0, "user", " \t\n"), (72, 2, "assistant", "é日本。")]
    return rows


def test_awkward_conversations(spark):
    rows = awkward_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    df = df.selectExpr("*", "'x' as segment", "'x' as shape", "'y' as audit", "1 as copy")
    assert results(C.with_empty(df, C.repair(C.damage(df)))) == brute(rows)
    nothing = spark.createDataFrame([], SCHEMA)
    assert C.with_empty(nothing, C.repair(C.damage(nothing))).collect() == []


def test_repaired_turns_follow_the_pattern(spark):
    df = C.damage(spark.createDataFrame(awkward_rows(), SCHEMA))
    digests = {r.conv_id: r.repaired_sha256 for r in C.repair(df).collect()}
    turns = defaultdict(list)
    for r in C.repaired_turns(df).orderBy("conv_id", "turn").collect():
        assert r.turn == len(turns[r.conv_id])
        turns[r.conv_id].append((r.role, r.text))
    for conv, said in turns.items():
        assert re.fullmatch("s?(ua)+", "".join(role[0] for role, _ in said))
        assert digests[conv] == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in said).encode()).hexdigest()


@pytest.mark.parametrize("source", ["table", "awkward"])
def test_sql_of_conversations(source):
    con = duckdb.connect()
    if source == "table":
        con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SMALL}/conversations.parquet'")
    else:
        con.sql("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
        con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", awkward_rows()[680:])
    rows = con.sql("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    found = con.sql(conversation_repair())
    names = [d[0] for d in found.description]
    got = {r[0]: tuple(r[names.index(n)] for n in NAMES) for r in found.fetchall()}
    assert got == brute(rows)
