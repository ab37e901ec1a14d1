import hashlib
import random
import re
import zlib

import duckdb
import pandas as pd
import pytest

from veilspark.llm import conversation_repair as op
from veilspark.llm.registry import QUERIES, SQL

GRAMMAR = re.compile(r"(s?(ua)+)?\Z")
SCHEMA = "conv_id long, turn long, role string, text string, rows string, times_ string, cost long"


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """All edits that cost no more than deleting everything, tried one by one."""
    kinds, best = faults(rows), (2 * len(rows), "D" * len(rows))

    def go(i, cost, audit, initials):
        nonlocal best
        if cost > best[0]:
            return
        if i == len(rows) and GRAMMAR.match(initials):
            best = min(best, (cost, audit))
        for x in "ua":
            go(i, cost + 5, audit + "I", initials + x)
        if i < len(rows):
            go(i + 1, cost + 2, audit + "D", initials)
            if kinds[i] not in ("blank", "duplicate"):
                more = 5 if kinds[i] else 0
                go(i + 1, cost + more, audit + "K", initials + (rows[i][1][:1] or "-"))
                for x in "ua":
                    go(i + 1, cost + more + 1, audit + "R", initials + x)

    go(0, 0, "", "")
    return best


def repaired(rows, audit):
    out, at = [], 0
    for letter in audit:
        want = "assistant" if out and out[-1][0][:1] == "u" else "user"
        if letter == "I":
            out.append((want, ""))
            continue
        _, role, text = rows[at]
        at += 1
        if letter != "D":
            out.append((role if letter == "K" else want, text))
    return out


def expected(rows):
    """The whole answer for one conversation's rows in order."""
    kinds, (cost, audit) = faults(rows), cheapest(rows)
    turns = {t for t, _, _ in rows if t is not None}
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
    said = "\n".join(f"{r}:{t}" for r, t in repaired(rows, audit))
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"),
        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(said.encode()).hexdigest(),
    )


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def by_conversation(rows, ids):
    order = lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode())
    return {i: [r[1:] for r in sorted((r for r in rows if r[0] == i), key=order)] for i in ids}


def random_rows(seed, conversations, most):
    r = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    texts = ["Hello.", "Well", "Yes!", "No?", " \t", "", None, "Go.", "Stop. ", "é…", "Why?\n"]
    return [(c, r.choice([*range(6), None]), r.choice(roles), r.choice(texts)) for c in [*range(conversations), None] for _ in range(r.randint(1, most))]


def answers(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 7) for r in rows], SCHEMA)


def test_brute_force_on_damaged_rows(spark):
    rows = random_rows(3, 120, 6)
    ids = {r[0] for r in rows}
    got = answers(op.audits(op.damage(table(spark, rows))))
    assert got == {i: expected(own) for i, own in by_conversation(damaged(rows), ids).items()}


@pytest.mark.parametrize("block", [1, 2, 5])
def test_blocks_agree_with_brute_force(spark, block):
    rows = random_rows(block, 12, 7)
    ids = {r[0] for r in rows}
    got = answers(op.audits(op.damage(table(spark, rows)), large_rows=1, block=block))
    assert got == {i: expected(own) for i, own in by_conversation(damaged(rows), ids).items()}


def test_a_conversation_that_holds_most_rows(spark):
    r = random.Random(8)
    rows = [(1, t, r.choice(["user", "assistant"]), f"{t}." if t % 7 else f"{t}") for t in range(900)] + [(1, 5000, "user", "again.")] * 200 + random_rows(9, 20, 4)
    small = answers(op.audits(table(spark, rows), large_rows=10**6))
    assert answers(op.audits(table(spark, rows), large_rows=300, block=64)) == small
    assert small[1][2] == 199 and len(small[1][6]) >= 1100
    told = op.repaired_turns(table(spark, rows), large_rows=300, block=64).filter("conv_id = 1").orderBy("at").collect()
    assert hashlib.sha256("\n".join(f"{x.role}:{x.text}" for x in told).encode()).hexdigest() == small[1][7]


def test_cheapest_edits_by_hand():
    rows = lambda *x: [(i, role, text) for i, (role, text) in enumerate(x)]
    ask, say = ("user", "Who?"), ("assistant", "Me.")
    assert op.mended(rows(ask, say))["audit"] == "KK"
    assert op.mended(rows(("system", "Be."), ask, say))["audit"] == "KKK"
    assert op.mended(rows(("system", "Be.")))["audit"] == "D"
    assert op.mended(rows(ask, ("user", "What?")))["audit"] == "KR"
    assert op.mended(rows(ask, say, say))["audit"] == "KKD"
    assert op.mended(rows(("assistant", "A."), ("user", "B.")))["audit"] == "RR"
    assert op.mended([]) == {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "", "repaired": []}


def test_nothing_left_and_empty(spark):
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = answers(op.audits(op.damage(table(spark, [(lost, 0, "user", "Hi.")]))))
    assert got == {lost: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert op.audits(op.damage(table(spark, []))).count() == 0


def test_long_texts(spark):
    long = "wörd " * 400_000
    rows = [(1, 0, "user", long + "?"), (1, 1, "assistant", long), (1, 2, "assistant", "Yes.")]
    assert answers(op.audits(table(spark, rows)))[1][5:7] == (2, "KDK")
    assert answers(op.audits(table(spark, rows), large_bytes=1 << 20, block=1))[1][5:7] == (2, "KDK")


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    assert answers(QUERIES["op13_conversation_repair"](spark, sf)) == {r[0]: tuple(r[1:]) for r in db.execute(SQL["op13_conversation_repair"]).fetchall()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sql_is_brute_force(seed):
    rows = random_rows(seed, 150, 6)
    conversations = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})  # noqa: F841
    got = {r[0]: tuple(r[1:]) for r in duckdb.sql(f"WITH conversations AS (SELECT * FROM conversations) SELECT conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 FROM ({SQL['op13_conversation_repair']})").fetchall()}
    assert got == {i: expected(own) for i, own in by_conversation(damaged(rows), {r[0] for r in rows}).items()}
