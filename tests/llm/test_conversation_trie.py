import hashlib
import random
import re
import zlib

import duckdb
import pytest

from skyflow.llm import conversation_trie

DIR = "/root/testdata/sf0.01"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def plain_trie(rows):
    """The contract by dictionaries: rebuilt conversations, their prefixes, sums over each subtree."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, digest(role or "", text or ""), (role or "", text or "")))
    own = {c: [x[3] for x in sorted(v, key=lambda x: (x[0], x[1], int.from_bytes(x[2][:8], "big", signed=True), int.from_bytes(x[2][8:16], "big", signed=True)))] for c, v in own.items()}
    paths = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = own.get(c - c % 20, [])[:h] + own[c][h:]
    members = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members.setdefault(tuple(p[:d]), []).append(c)
    children = {}
    for k in members:
        if k:
            children.setdefault(k[:-1], []).append(k)
    saved, leaves = {}, {}
    for k in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        saved[k] = (len(members[k]) - 1) * words + sum(saved[x] for x in children.get(k, []))
        leaves[k] = sum(leaves[x] for x in children.get(k, [])) or 1
    out = []
    for k, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(paths[c]) == len(k))))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children.get(k, [])), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def made_up(seed, n):
    r = random.Random(seed)
    texts = ["a b", "c", None, "", " d\te f\n", "word " * 30]
    rows = []
    for c in [*range(n), 1000, 1019, 2**40 + 3]:
        for k in range(r.choice([0, 1, 2, 3, 5, 9])):
            rows.append((c, r.choice([None, k, k, k]), r.choice(["user", None]), r.choice(texts)))
    rows += [(None, 0, "user", "lost"), (None, None, None, None)]
    rows += [(c, k, "user", f"same {k}") for c in range(200, 260) for k in range(6)]  # copies
    rows += rows[:5]  # repeated rows
    return rows


@pytest.mark.parametrize("segment, shard, block", [(16, 1 << 15, 4096), (2, 5, 2), (1, 3, 1)])
def test_against_dictionaries(spark, monkeypatch, segment, shard, block):
    for name, value in (("SEGMENT", segment), ("SHARD_ROWS", shard), ("BLOCK", block)):
        monkeypatch.setattr(conversation_trie, name, value)
    rows = made_up(3, 60)
    rows += [(300, k, "user", "deep " * (k % 3)) for k in range(45)] + [(301, k, "user", "deep " * (k % 3)) for k in range(70)]  # long ones
    df = spark.createDataFrame([(*x, 7) for x in rows], "conv_id long, turn int, role string, text string, depth int").repartition(5)
    assert rows_of(conversation_trie.prefix_trie(df)) == plain_trie(rows)


def test_turnless_and_empty(spark):
    # conversations of an absent base whose own turns all come first are turnless
    ids = [c for c in range(1, 60) if zlib.crc32(str(c).encode()) % 4 == 3][:3]
    rows = [(c, 0, "user", "x y") for c in ids] + [(-7, k, None, "y " * 50_000) for k in range(5)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = rows_of(conversation_trie.prefix_trie(df.filter("conv_id > 0")))
    assert got == plain_trie(rows[:3]) and got[0][1:6] == (0, None, 3, 0, 1)
    assert len(rows_of(conversation_trie.prefix_trie(df))) >= 2
    assert conversation_trie.prefix_trie(df.limit(0)).collect() == []


def test_given_tables(spark):
    want = plain_trie([tuple(r) for r in spark.read.parquet(f"{DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()])
    assert rows_of(conversation_trie.query(spark, DIR)) == want
    db = duckdb.connect()
    db.sql(f"CREATE VIEW conversations AS SELECT * FROM '{DIR}/conversations.parquet'")
    assert sorted(db.sql(f"SELECT {', '.join(COLUMNS)} FROM ({conversation_trie.ORACLE})").fetchall()) == want
