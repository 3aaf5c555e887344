import hashlib
import random

from pyspark.sql import functions as F

from skyflow.llm import exact_dedup as ed


def brute(rows):
    groups = {}
    for k, (i, t) in enumerate(rows):
        h = hashlib.sha256("".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r").encode()).hexdigest()
        groups.setdefault(h, []).append((-len(t or ""), i is None, i or 0, k))
    out = []
    for h, g in groups.items():
        best = min(g)
        for x in g:
            out.append((None if x[1] else x[2], None if best[1] else best[2], len(g), h))
    return sorted(out, key=str)


def test_table_inserts_deletes_and_grows():
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    stored = []
    t = ed.CuckooTable(stored)
    for k in keys:
        assert t.find(k) < 0
        stored.append(k)
        t.insert(len(stored) - 1)
    assert t.grown > 3 and all(stored[t.places[t.find(k)]] == k for k in keys)
    for k in keys[::2]:
        stored[t.delete(k)] = None
    assert all((t.find(k) >= 0) == bool(i % 2) for i, k in enumerate(keys))
    assert t.delete(keys[0]) == -1


def test_against_brute_force(spark):
    r = random.Random(3)
    rows = [(i, r.choice(["a b", "ab", "a  b", "b", "", None, "\t", "x y", "xy", "hot"])) for i in range(300)]
    rows += [(5, "ab"), (None, "ab"), (None, "lone"), (400, "long " * 5000)]
    df = spark.createDataFrame([(i, t, True) for i, t in rows], "doc_id long, text string, kept boolean").repartition(5)
    got = ed.exact_dedup(df).collect()
    assert sorted([(x.doc_id, x.keep_id, x.group_size, x.text_sha256) for x in got], key=str) == brute(rows)
    assert sum(x.kept for x in got) == len({x.text_sha256 for x in got})
    assert all(x.doc_id == x.keep_id for x in got if x.kept)
    assert ed.exact_dedup(df.limit(0)).collect() == []


def test_null_ids_leave_large_ids_whole(spark):
    big = 2**53
    rows = [(big + k, f"t{k // 2}") for k in range(60)] + [(None, "a"), (None, "b")]
    got = ed.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {x.keep_id for x in got} == {big + k for k in range(0, 60, 2)} | {None}
    assert all(x.doc_id == x.keep_id for x in got if x.kept)


def test_index_insert_and_delete(spark):
    def rows(*texts):
        return ed.digests(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id", "text")

    index = ed.insert(ed.build(rows("a", "b", "b"), 3), rows("b", "c"))
    assert sorted(x.group_size for x in index.keys.collect()) == [1, 1, 3]
    index = ed.delete(index, rows("b", "zzz").select("digest"))
    assert index.keys.count() == 2
    index = ed.insert(index, rows("b"))
    assert index.keys.agg(F.count("*"), F.max("group_size")).first()[:] == (3, 1)
