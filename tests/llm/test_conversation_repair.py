"""Audits against all edit strings of short conversations, and whole tables against the SQL."""

import hashlib
import itertools
import random
from pathlib import Path

import duckdb
import pytest

from strandwork.llm import conversation_repair as cr
from strandwork.llm.queries import SQL, op13_conversation_repair

ROWS = "conv_id long, turn long, role string, text string"
WORDS = ["Yes.", "No!", "cut", "", " \n", "end? \t", "x."]
ROLES = ["user", "assistant", "system", "tool", "", None]


def brute(rows):
    """Every audit of at most two inserts in a place, by the rules alone: (cost, audit, repaired), the least."""
    seen, faults = set(), []
    for role, text in rows:
        body = text.strip(cr.SPACES)
        faults.append("gone" if not body or (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    best = None
    for letters in itertools.product("KRD", repeat=len(rows)):
        for inserts in itertools.product(range(3), repeat=len(rows) + 1):
            audit = "".join("I" * k + x for k, x in zip(inserts, [*letters, ""], strict=True))
            cost, turns, k, good = 0, [], 0, True
            for x in audit:
                before = turns[-1][0][:1] if turns else ""
                follows = "assistant" if before == "u" else "user"
                if x == "I":
                    cost, turns = cost + 3, [*turns, (follows, "")]
                    continue
                (role, text), fault = rows[k], faults[k]
                k += 1
                if x == "D":
                    cost += 4
                    continue
                good &= fault != "gone"
                cost += (3 if x == "R" else 0) + (3 if fault == "truncated" else 0)
                turns = [*turns, (follows if x == "R" else role, text)]
            initials = "".join(r[:1] or "-" for r, _ in turns)
            body = initials.removeprefix("s")
            if good and (not initials or (body and body == "ua" * (len(body) // 2))) and (best is None or (cost, audit) < best[:2]):
                best = cost, audit, "\n".join(f"{r}:{t}" for r, t in turns)
    return best


def made(spark, rows):
    return spark.createDataFrame(rows, ROWS)


def test_cheapest_edits_of_short_conversations(spark):
    r = random.Random(5)
    rows = [(c, t, r.choice(ROLES), r.choice(WORDS)) for c in range(250) for t in range(r.randint(1, 4))]
    got = {x["conv_id"]: x for x in cr.audits(made(spark, rows)).collect()}
    for c in range(250):
        own = [(" " if role is None else role, text) for conv, _, role, text in rows if conv == c]
        cost, audit, text = brute(own)
        assert (got[c]["cost"], got[c]["audit"], got[c]["repaired_sha256"]) == (cost, audit, hashlib.sha256(text.encode()).hexdigest()), own
    turns = cr.repaired(made(spark, rows)).orderBy("conv_id", "place").collect()
    for c in range(250):
        own = [x for x in turns if x["conv_id"] == c]
        assert "".join(x["edit"] for x in own) == got[c]["audit"] and [x["place"] for x in own] == list(range(len(own)))
        text = "\n".join(f"{x['role']}:{x['text']}" for x in own if x["edit"] != "D")
        assert hashlib.sha256(text.encode()).hexdigest() == got[c]["repaired_sha256"]


def test_long_conversations_keep_the_least_audit_across_chunks(monkeypatch, spark):
    r = random.Random(6)
    rows = [(c, t, r.choice(["user", "user", "assistant", "system"]), r.choice([f"{t}.", f"{t}"])) for c in range(6) for t in range(150)]
    table = made(spark, rows).cache()
    wanted = {}
    for size in (10**9, 2):
        for c in range(6):
            monkeypatch.setattr(cr, "CHUNK", size)
            fold = cr.Repair()
            for k, x in enumerate(x for x in rows if x[0] == c):
                fold.add(x[1], x[2], x[3], x[3][-1], False, (k,))
            assert wanted.setdefault(c, fold.summary()) == fold.summary()
    got = {x["conv_id"]: tuple(x)[1:] for x in cr.audits(table).collect()}
    assert got == wanted


def test_rows_of_every_kind(spark):
    rows = [
        (1, None, "user", "Hi."), (1, None, "user", "Hi."), (1, 3, "user", "Hi."), (1, 7, "assistant", "cut"),
        (None, 1, "system", "S."), (None, 1, None, None), (None, None, "user", "A.  "), (2, 5, "user", ""), (3, 1, "assistant", "é" * 200_000 + "."),
        (4, 1, "user", "Twice."), (4, 2, "assistant", "Once."), (4, 2, "assistant", "Once."), (4, -2, "system", "Far."),
    ]
    table = made(spark, rows).selectExpr("*", "'x' as kind", "7 as content", "8 as note").repartition(5)
    got = {x["conv_id"]: x for x in cr.audits(table).collect()}
    assert set(got) == {1, None, 2, 3, 4}
    assert (got[1]["gaps"], got[1]["duplicate"], got[1]["truncated"], got[1]["illegal"], got[1]["audit"]) == (3, 2, 1, 2, "KDDK")
    assert (got[None]["gaps"], got[None]["blank"], got[None]["illegal"]) == (0, 1, 2)
    assert (got[2]["cost"], got[2]["audit"], got[2]["repaired_sha256"]) == (4, "D", hashlib.sha256(b"").hexdigest())
    assert got[3]["audit"] == "IK" and got[4]["audit"] == "KKKD" and got[4]["gaps"] == 2
    absent = made(spark, [(9, 1, "user", "x")]).selectExpr("*", "false as present")
    assert [tuple(x) for x in cr.audits(absent).collect()] == [(9, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert cr.audits(made(spark, [])).count() == 0 and cr.repaired(made(spark, [])).count() == 0 and cr.damaged(made(spark, [])).count() == 0
    assert cr.repaired(absent).count() == 0


def by_sql(path):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}'")
    return sorted(con.execute(SQL["op13_conversation_repair"]).fetchall(), key=str)


def test_query_against_sql(spark, tmp_path):
    assert sorted(map(tuple, op13_conversation_repair(spark, "/root/testdata/sf0.001").collect()), key=str) == by_sql("/root/testdata/sf0.001/conversations.parquet")
    r = random.Random(7)
    some = lambda values: r.choice(values)
    rows = [(some([*range(40), None]), some([*range(9), None]), some(ROLES), some([*WORDS, None])) for _ in range(500)]
    made(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    got = sorted(map(tuple, op13_conversation_repair(spark, str(tmp_path)).collect()), key=str)
    assert got == by_sql(f"{tmp_path}/conversations.parquet/*.parquet") and len(got) == 41


@pytest.mark.skipif(not Path("/root/testdata/sf0.01").is_dir(), reason="no tables")
def test_query_on_a_larger_table(spark):
    got = sorted(map(tuple, op13_conversation_repair(spark, "/root/testdata/sf0.01").collect()), key=str)
    assert got == by_sql("/root/testdata/sf0.01/conversations.parquet")
