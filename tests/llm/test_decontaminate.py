import random

from skyflow.llm import decontaminate as dc


def test_against_brute_force(spark):
    r = random.Random(5)
    vocab = [f"w{i}" for i in range(60)]
    items = {i: " ".join(r.choice(vocab) for _ in range(r.choice([0, 2, 4, 5, 9, 30, 60]))) for i in range(40)}
    items[40] = None
    docs = {}
    for i in range(200):
        words = [r.choice(vocab) for _ in range(r.choice([0, 3, 50, 900]))]
        if r.random() < 0.6:
            part = (items[r.randrange(40)] or "").upper().split()
            if part and r.random() < 0.5:
                part[r.randrange(len(part))] = "zzz"
            at = r.randrange(len(words) + 1)
            words[at:at] = part
        docs[i] = "\n".join(words)
    docs[200], docs[201] = None, items[1]
    d = spark.createDataFrame([(i, t, "x") for i, t in docs.items()], "doc_id long, text string, item_id string").repartition(4)
    b = spark.createDataFrame(list(items.items()), "item_id long, text string")
    want = []
    for i, t in docs.items():
        have = dc.word_shingles(t or "", 5)
        for k, x in items.items():
            q = dc.word_shingles(x or "", 5)
            if q and 100 * len(q & have) >= 80 * len(q):
                want.append((i, k, len(q), len(q & have)))
    got = [(x.doc_id, x.item_id, x.n_shingles, x.overlap) for x in dc.contained_items(d, b).collect()]
    assert sorted(got) == sorted(want) and len(want) > 30
    assert dc.contained_items(d, b.limit(0)).collect() == [] == dc.contained_items(d.limit(0), b).collect()


def test_ids_of_other_types_and_repeated_rows(spark):
    words = " ".join(f"w{i}" for i in range(30))
    d = spark.createDataFrame([(1, words), (1, words), (None, words + " x" * 50_000), (2, "")], "doc_id int, text string")
    for kind, ids in (("int", [7, 8]), ("string", ["a", "b"]), ("smallint", [7, 8])):
        b = spark.createDataFrame(list(zip(ids, [words, "other"])), f"item_id {kind}, text string")
        got = dc.contained_items(d, b).collect()
        assert sorted((x.doc_id or 0, x.item_id) for x in got) == [(0, ids[0]), (1, ids[0]), (1, ids[0])]
