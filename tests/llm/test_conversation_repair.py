import hashlib
import random
import re
import zlib

import duckdb
import pytest

from chronolink.llm import conversation_repair as repairs
from chronolink.llm import oracles, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id LONG, turn LONG, role STRING, text STRING, place LONG, conv STRING, audit STRING, copy INT"
LEGAL = re.compile(r"(s?(ua)+)?")


def by_programme(rows, begin=0, ends=(0, 3)):
    """The least (cost, edits) from the back: every edit at every row in every state, without a search."""

    def inserted(ways):
        ways = dict(ways)
        for _ in range(4):
            for state in range(4):
                cost, edits = ways[repairs.NEXT[state]]
                ways[state] = min(ways[state], (cost + 2, "I" + edits))
        return ways

    ways = inserted({s: (0, "") if s in ends else (1 << 30, "") for s in range(4)})
    for initial, fault in reversed(rows):
        now = {}
        for state in range(4):
            options = [(ways[state][0] + 3, "D" + ways[state][1])]
            if fault not in (1, 2):
                more = fault == 3
                if initial in repairs.KEEPS[state]:
                    cost, edits = ways[repairs.KEEPS[state][initial]]
                    options.append((cost + more, "K" + edits))
                cost, edits = ways[repairs.NEXT[state]]
                options.append((cost + 2 + more, "R" + edits))
            now[state] = min(options)
        ways = inserted(now)
    return ways[begin]


def some_rows(rng, n):
    return [(rng.choice(["s", "u", "a", "a", "x", ""]), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(n)]


def test_search_finds_the_least():
    rng = random.Random(1)
    for _ in range(1500):
        rows = some_rows(rng, rng.randint(0, 12))
        assert repairs.cheapest(rows, 0, (0, 3)) == by_programme(rows)
        begin, end = rng.randrange(4), rng.randrange(4)
        want = by_programme(rows, begin, (end,))
        assert repairs.cheapest(rows, begin, (end,)) == (want if want[0] < 1 << 29 else None)


@pytest.mark.parametrize("window", [1, 2, 7, 64])
def test_windows_chain_to_the_same(monkeypatch, window):
    monkeypatch.setattr(repairs, "WINDOW", window)
    rng = random.Random(window)
    for _ in range(60 if window < 64 else 8):
        rows = some_rows(rng, rng.randint(1, 30 if window < 64 else 400))
        talk = repairs.Conversation("x")
        for i, (initial, fault) in enumerate(rows):
            talk.add(i, initial, fault, bytes([fault]) * 16)
        figures, *kept = talk.result()
        assert figures[-2:] == by_programme(rows)
        assert len(kept) == sum(e != "D" for e in figures[-1])


def plainly(rows):
    """What the contract says, conversation by conversation in plain Python."""
    s = lambda x: " " if x is None else str(x)
    talks = {}
    for conv, turn, role, text in rows:
        role, text, fate = s(role), s(text), zlib.crc32(f"{s(conv)}:{s(turn)}".encode()) % 20
        talk = talks.setdefault(conv, [])
        if fate == 1:
            text = ""
        elif fate == 2:
            text = re.sub("[.!?]", "", text)
        elif fate == 4:
            role = "user"
        talk += [(turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    out = []
    for conv, talk in talks.items():
        digest = lambda r, t: hashlib.sha256(f"{len(r)}:{r}{t}".encode()).hexdigest()[:32]
        talk.sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1].encode(), digest(m[1], m[2])))
        turns = {t for t, _, _ in talk if t is not None}
        seen, faults = set(), []
        for _, role, text in talk:
            bare = text.strip(" \t\n\x0b\f\r")
            faults.append(1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0)
            seen.add((role, text))
        cost, audit = by_programme([(r[:1], f) for (_, r, _), f in zip(talk, faults)])
        told, at, initials = [], iter(talk), ""
        for edit in audit:
            _, role, text = next(at) if edit != "I" else (0, "", "")
            if edit in "IR":
                role = "assistant" if initials[-1:] == "u" else "user"
            if edit != "D":
                told.append(f"{role}:{text}")
                initials += role[:1]
        assert LEGAL.fullmatch(initials)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(talk, talk[1:]))
        sha = hashlib.sha256("\n".join(told).encode()).hexdigest()
        out.append((conv, gaps, *(faults.count(k) for k in (1, 2, 3)), illegal, cost, audit, sha))
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, 7, "x", "y", 9) for r in rows], SCHEMA).repartition(3)


def got(frame):
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert frame.columns == names
    return sorted((tuple(r) for r in frame.collect()), key=str)


def odd_rows():
    rng, rows = random.Random(5), []
    roles, texts = ["system", "user", "assistant", "assistant", "tool", "", None], ["Yes.", "no", "Who? ", " \n\t", "", None, "é日本!", " .", "x" * 50_000]
    for conv in [*range(150), None, -3]:
        for turn in range(rng.randint(1, 9)):
            turn = rng.choice([turn, turn, turn, turn + 3, None])
            rows.append((conv, turn, rng.choice(roles), rng.choice(texts)))
            if rng.random() < 0.1:
                rows.append(rows[-1])
    rows += [(900, t, "user" if t % 2 else "assistant", f"turn {t % 50}.") for t in range(1000)]
    return rows


def test_odd_rows_against_plain_python(spark):
    rows = odd_rows()
    assert got(repairs.repaired(table(spark, rows))) == plainly(rows)


def test_odd_rows_against_sql(spark):
    rows = [r for r in odd_rows() if r[2] != ""]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    found = con.execute(oracles.REPAIR_SQL)
    names = [c[0] for c in found.description]
    want = [tuple(r[names.index(c)] for c in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in found.fetchall()]
    assert got(repairs.repaired(table(spark, rows))) == sorted(want, key=str)


def test_query(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    assert got(queries.queries()["op13_conversation_repair"](spark, SF)) == plainly(rows)


def test_no_rows(spark):
    assert got(repairs.repaired(table(spark, []))) == []
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert got(repairs.repaired(table(spark, [(dropped, 0, "user", "Hi.")]))) == [(dropped, *[0] * 6, "", hashlib.sha256(b"").hexdigest())]


def test_messages(spark):
    """The operator itself: repaired messages in order, roles and texts as they are now."""
    rows = [(1, 1, "assistant", "Hello."), (1, 2, "assistant", "Again."), (1, 3, "user", "Bye."), (2, 1, "user", "   "), (None, 1, "user", "a?"), (None, 2, "assistant", "b")]
    figures, messages = repairs.repair(table(spark, rows))
    assert {r.conv: (r.cost, r.audit) for r in figures.collect()} == {"1": by_programme([("a", 0), ("a", 0), ("u", 0)]), "2": (3, "D"), " ": (1, "KK")}
    told = {}
    for r in sorted(messages.collect(), key=lambda r: (r.conv, r.place)):
        told.setdefault(r.conv, []).append((r.role, r.text))
    assert told[" "] == [("user", "a?"), ("assistant", "b")] and "2" not in told
    assert LEGAL.fullmatch("".join(role[0] for role, _ in told["1"]))
