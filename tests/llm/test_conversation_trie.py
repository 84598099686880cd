"""The trie against one built turn by turn in plain Python, and against the SQL."""

import hashlib
import random
import re
import zlib

import duckdb
import pytest

from strandwork.llm import conversation_trie as ct
from strandwork.llm.queries import SQL, op12_conversation_trie

ROWS = "conv_id long, turn long, role string, text string"


def plain(rows):
    """All nodes, from the rebuilt conversations as lists."""
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", hashlib.sha256(f"{len((r[2] or '').encode())}:{r[2] or ''}{r[3] or ''}".encode()).hexdigest())
    own = {}
    for r in sorted((r for r in rows if r[0] is not None), key=key):
        own.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        head = c - abs(c) % 20 * (1 if c >= 0 else -1)  # the remainder has the number's sign
        built[c] = tuple(own.get(head, [])[:h] + turns[h:])
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    out = set()
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        leaf = lambda p: not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in nodes)
        words = lambda p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        ends = ",".join(str(c) for c in sorted(members) if built[c] == path)
        out.add((
            min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), sum(len(q) == len(path) + 1 for q in below), sum(map(leaf, below)),
            sum((len(nodes[p]) - 1) * words(p) for p in below), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def made(spark, rows):
    return spark.createDataFrame(rows, ROWS)


def some_rows(seed, n=400, ids=45):
    r = random.Random(seed)
    return [(r.choice([*range(-3, ids), None]), r.choice([*range(5), None]), r.choice(["user", "assistant", "", None]), r.choice(["a b", "a", "", " ", None, "é\tc\n d"])) for _ in range(n)]


@pytest.mark.parametrize("sizes", [(16, 1 << 16, 1 << 16), (2, 3, 2)])
def test_against_plain_tries(spark, monkeypatch, sizes):
    for name, v in zip(("FAN", "SLICE", "HELD"), sizes, strict=True):
        monkeypatch.setattr(ct, name, v)
    few = [(c, t, "user", f"w{t if c % 7 else 0}") for c in range(80) for t in range(c % 4 + 1)]
    for rows in (some_rows(1), some_rows(2, 60, 90), few):
        got = [tuple(x) for x in ct.conversation_trie(made(spark, rows).selectExpr("*", "1 as place", "'x' as node", "2 as words").repartition(7)).collect()]
        assert len(got) == len(set(got)) and set(got) == plain(rows)


def test_empty_tables_null_ids_and_turnless_conversations(spark):
    assert ct.conversation_trie(made(spark, [])).count() == 0
    assert ct.conversation_trie(made(spark, [(None, 1, "user", "x")])).count() == 0
    lone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    assert [tuple(x)[:7] for x in ct.conversation_trie(made(spark, [(lone, 0, "user", "a"), (lone, 1, "user", None)])).collect()] == [(lone, 0, None, 1, 0, 1, 0)]
    long = [(20, t, "user", f"t{t}") for t in range(2000)] + [(20, 5000, "user", "y" * 300_000)]
    assert set(map(tuple, ct.conversation_trie(made(spark, long)).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children").collect())) == {(20, d, 20 if d else None, 1, int(d < 2001)) for d in range(2002)}


def test_query_against_sql(spark, tmp_path):
    made(spark, some_rows(3)).write.parquet(f"{tmp_path}/conversations.parquet")
    for sf, files in (("/root/testdata/sf0.01", "conversations.parquet"), (str(tmp_path), "conversations.parquet/*.parquet")):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/{files}'")
        assert set(map(tuple, op12_conversation_trie(spark, sf).collect())) == set(con.execute(SQL["op12_conversation_trie"]).fetchall())
