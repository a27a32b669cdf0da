"""Structure repair against an exhaustive dynamic programme."""

import hashlib
import re
import zlib
from functools import cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rosterlift.llm import queries, repair
from rosterlift.llm._store import Scratch

TURN = "conv_id long, turn long, role string, text string, conv string, at string"
FULL = {"u": "user", "a": "assistant"}


def cheapest(rows):
    """(cost, audit, repaired) of (role, text, fault) rows: all edits, least cost, then least audit."""
    @cache
    def best(i, said, inserted):
        out = []
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", said):
            out.append((0, "", ()))

        def go(edit, cost, j, role, text, more=0):
            now = said + role[:1] if role else said
            if not re.fullmatch("(s?(ua)*u?)?", now):
                return
            now = re.sub("^s(ua)+", "ua", re.sub("^(ua)+(?=ua)", "", now)) if now != "s" else now
            c, a, r = best(j, now, more)
            if c < 1 << 30:
                out.append((cost + c, edit + a, ((role, text),) + r if role else r))
        if inserted < 3:
            for role in FULL.values():
                go("I", 3, i, role, "", inserted + 1)
        if i < len(rows):
            role, text, fault = rows[i]
            go("D", 4, i + 1, None, None)
            if fault not in ("blank", "duplicate"):
                short = 3 if fault == "truncated" else 0
                if role:  # without one it has no initial, and cannot stay as it is
                    go("K", short, i + 1, role, text)
                for other in FULL.values():
                    go("R", 3 + short, i + 1, other, text)
        return min(out, default=(1 << 30, "", ()))
    return best(0, "", 0)


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        said = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def want(rows):
    """A conversation's result, from (turn, role, text) rows in order."""
    turns = [t for t, _, _ in rows if t is not None]
    found = faults([(r, x) for _, r, x in rows])
    cost, audit, made = cheapest(tuple(found))
    count = [sum(f == k for _, _, f in found) for k in ("blank", "duplicate", "truncated")]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    text = "\n".join(f"{r}:{x}" for r, x in made)
    return (gaps, *count, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def broken(turns):
    """The contract's damage, on (conv, turn, role, text) rows in order."""
    out = {}
    for conv, turn, role, text in turns:
        rows = out.setdefault(conv, [])
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault:
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            rows += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def order(r):
    role, text = r[2] or " ", r[3] if r[3] is not None else " "
    return r[0] is not None, r[0], r[1] is not None, r[1], role, hashlib.md5(text.encode()).digest()


def rows_of(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


KIND = st.sampled_from([0, 1, 2, 3, 4, 5, 6, 7, 8, 17])
NAMED = {8: "blank", 16: "duplicate", 4: "truncated"}


@pytest.fixture
def many_ranges(spark):
    """Small tables lie in several ranges too."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, "true")


def as_rows(kinds):
    return tuple(("sua "[k & 3], str(i), next((n for bit, n in NAMED.items() if k & bit), None)) for i, k in enumerate(kinds))


@settings(max_examples=300, deadline=None)
@given(st.lists(KIND, max_size=7))
def test_search_finds_the_cheapest_and_least(kinds):
    cost, edits, state = repair.Search(bytes(kinds)).best(repair.START)
    edits += "I" * (repair.AT_END[state] // 3)
    assert (cost, edits) == cheapest(as_rows(kinds))[:2]


@settings(max_examples=100, deadline=None)
@given(st.lists(KIND, min_size=1, max_size=14), st.integers(1, 4))
def test_chunks_give_what_the_whole_gives(kinds, size):
    whole = repair.Search(bytes(kinds)).best(repair.START)
    parts = [bytes(kinds[i:i + size]) for i in range(0, len(kinds), size)]
    exits = [list(repair.AT_END)]
    for p in reversed(parts):
        exits.append(repair.before(repair.costs(p), exits[-1]))
    exits.reverse()
    q, path = repair.START, ""
    for k, p in enumerate(parts):
        _, edits, q = repair.Search(p, tuple(exits[k + 1])).best(q)
        path += edits
    assert (exits[0][0], path, q) == whole


def test_lower_bounds_keep_long_searches_short():
    for kinds in (bytes([1] * 64), bytes([2] * 64), bytes([1, 1, 2, 0, 5, 3, 17, 8] * 8), bytes([0] * 64), bytes([2, 1, 5, 6] * 16)):
        search, steps = repair.Search(kinds), [0]
        moves = search.moves

        def counted(i, q):
            steps[0] += 1
            return moves(i, q)
        search.moves = counted
        search.best(repair.START)
        assert steps[0] < 100_000


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_whole_table(spark, folder):
    turns = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    expected = {c: want(rows) for c, rows in broken(sorted(turns, key=order)).items()}
    assert rows_of(queries.op12_structure_repair(spark, folder)) == expected


EVIL = [(None, 0, "user", "lost."), (None, None, None, None), (1, None, "assistant", "first."), (1, 3, "user", "x"), (1, 3, "user", "x"),
        (2, -5, "system", "s."), (2, 0, "system", "s."), (2, 9, "tool", "t."), (3, 1, "", "no role."), (3, 1, "user", " \t\n"),
        (4, 2, "User", " "), (4, 3, "sus", "é?"), (5, 0, "user", "y" * 200_000), (5, 1, "assistant", "z" * 100_000 + ".")]


def long_ones():
    return [(10 + c, t, ("user", "assistant", "user", "system", "user")[(t * (c + 3) + c) % 5], f"t{t % (40 + c)}" + ".!? "[t % 4])
            for c in range(3) for t in range(70)]


@pytest.mark.parametrize("size", [1, 3, 64])
def test_odd_rows_and_long_conversations(spark, many_ranges, size):
    rows = EVIL + long_ones()
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], TURN).repartition(3)
    expected = {}
    for c, turn, role, text in sorted(rows, key=order):
        expected.setdefault(c, []).append((turn, " " if role is None else role, " " if text is None else text))
    import sys
    limit = sys.getrecursionlimit()
    sys.setrecursionlimit(20_000)
    try:
        expected = {c: want(r) for c, r in expected.items()}
    finally:
        sys.setrecursionlimit(limit)
    assert rows_of(repair.repaired(table, chunk_rows=size)) == expected


def test_repaired_rows_are_what_the_digest_reads(spark):
    rows = EVIL + long_ones()
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], TURN)
    found = repair.structure(table, Scratch(spark), 5)
    said = {}
    for r in sorted(repair.repaired_turns(found).collect(), key=lambda r: (r.at, r.nth)):
        said.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    expected = {r.conv_id: r.repaired_sha256 for r in repair.repaired(table).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    assert {c: hashlib.sha256("\n".join(x).encode()).hexdigest() for c, x in said.items()} == {c: h for c, h in expected.items() if h != nothing}


def test_conversations_without_rows_and_empty_tables(spark):
    table = spark.createDataFrame([(5, 0, "user", "x.", "", "")], TURN)
    row = repair.repaired(table.where("false"), table).first()
    assert row.asDict() == {"conv_id": 5, "gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "",
                            "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    assert repair.repaired(table.where("false")).count() == 0


def test_a_conversation_with_a_third_of_all_rows(spark, many_ranges):
    """It lies in several ranges, and comes out as if searched in one piece."""
    hot = [(0, t, "user" if t % 2 == 0 or t % 17 == 0 else "assistant", f"row {t}" + ("." if t % 5 else "")) for t in range(3000)]
    rows = hot + [(1 + t // 6, t % 6, ("user", "assistant")[t % 2], f"row {t}.") for t in range(6000)]
    table = spark.createDataFrame([(*r, "", "") for r in rows], TURN)
    found = repair.structure(table, Scratch(spark))
    assert found.rows.where("conv = '0'").selectExpr("shiftright(at, 33) AS part").distinct().count() > 1
    got = rows_of(repair.repaired(table))
    import sys
    kinds = bytes((1 if r[2] == "user" else 2) + (0 if r[3].endswith(".") else 4) for r in hot)
    limit = sys.getrecursionlimit()
    sys.setrecursionlimit(50_000)
    try:
        cost, edits, state = repair.Search(kinds).best(repair.START)
    finally:
        sys.setrecursionlimit(limit)
    assert got[0][5:7] == (cost, edits + "I" * (repair.AT_END[state] // 3))
    assert all(got[c][6] == "KKKKKK" for c in range(1, 1001))
