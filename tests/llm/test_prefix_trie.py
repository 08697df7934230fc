"""Conversation prefix trie against brute force."""

import collections
import hashlib
import random
import zlib

import duckdb
import pytest

from panelforge.llm import prefix_trie

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Contract columns of each node; ``rows``: (conv_id, turn, role, text)."""
    own = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            own[c].append(((t is not None, t or 0), r, hashlib.sha256(f"{len(r)}:{r}{x}".encode()).hexdigest(), x))
    own = {c: [(r, x) for _, r, _, x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        rebuilt[c] = own.get(base, [])[:h] + turns[h:]
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[tuple(rebuilt[c][:d])].append(c)
        ends[tuple(rebuilt[c])].append(c)
    children, leaves, saved = collections.Counter(), collections.Counter(), collections.Counter()
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, own_members in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += (len(own_members) - 1) * len(node[-1][1].encode()) if node else 0
    sha = lambda k: hashlib.sha256(",".join(map(str, ends[k])).encode()).hexdigest()
    return sorted((m[0], len(k), -1 if not k else members[k[:-1]][0], len(m), children[k], leaves[k], saved[k], sha(k)) for k, m in members.items())


def listed(frame):
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in frame.collect())


def made(seed, convs, turns, texts):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(rng.choice([1, 2, 3, turns])):
            rows.append((c * rng.choice([1, 1, 1, 2]), None if rng.random() < 0.05 else t, rng.choice(["user", "bot", None]), rng.choice([None, "", "é", "hello", "x" * rng.randint(0, texts)])))
    return rows


@pytest.mark.parametrize("seed, convs, turns, texts, cells", [(1, 60, 5, 2, 15), (2, 200, 9, 1, 40), (3, 30, 150, 1, 100), (4, 400, 3, 0, 30), (5, 50, 4, 3, 10_000)])
def test_made_conversations(spark, seed, convs, turns, texts, cells):
    rows = made(seed, convs, turns, texts)
    assert listed(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), shard_cells=cells)) == brute(rows)


def test_hot_first_turn_and_conversation(spark):
    """Copies of one conversation and turn fill many shards."""
    rows = [(c, t, "user", f"same {t}" if c < 900 or t == 0 else f"{c % 17} {t}") for c in range(1500) for t in range(3)]
    rows += [(2000 + c, 0, None, None) for c in range(10)]
    assert listed(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), shard_cells=64)) == brute(rows)


def test_long_and_prefix_conversations(spark):
    rows = [(c * 5, t, "u", f"t{t}") for c, n in enumerate([1, 64, 65, 128, 129, 200, 200]) for t in range(n)]
    for cells in (50, 100_000):
        assert listed(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), shard_cells=cells)) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, 0, "u", "lost"), (-7, 0, "a", "b"), (-5, 0, "a", "b"), (-5, 0, "a", "b"), (3, None, None, None), (3, 1, "", ""), (3, 1, "z", "y" * 70_000), (3, 1, "z", "a"), (10**15 + 1, 4, "u", "v")]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS path", "1 AS n_convs", "'k' AS key", "2 AS depth")
    assert listed(prefix_trie.prefix_trie(frame)) == brute(rows)


def test_nothing(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert prefix_trie.prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).count() == 0


def test_table_and_sql(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    out = prefix_trie.prefix_trie(table, shard_cells=50)
    want = brute([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])
    assert listed(out) == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    rows = con.execute(prefix_trie.ORACLE_SQL).fetchall()
    assert [c[0] for c in con.description] == out.columns
    assert sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in rows) == want
