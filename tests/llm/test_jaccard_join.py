import random

import numpy as np
import pytest

from skyflow.llm import jaccard_join as jj
from skyflow.llm.decontaminate import word_shingles


def brute(docs, percent=80):
    sets = {i: word_shingles(t or "", 5) for i, t in docs.items()}
    root = {i: i for i in docs}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(docs)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            inter = len(sets[a] & sets[b])
            if inter and 100 * inter >= percent * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return sorted((i, len(sets[i]), top(i)) for i in docs)


def corpus(seed, group):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    passage = [r.choice(vocab) for _ in range(30)]
    docs, i = {}, 0
    for size in [1] * 30 + [2, 3, 5, 9, group]:
        base = [r.choice(vocab) for _ in range(r.choice([3, 20, 80, 200]))]
        for _ in range(size):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 4])):
                w[r.randrange(len(w))] = r.choice(vocab)
            if r.random() < 0.3:
                w += passage
            docs[i] = r.choice([" ", "\n"]).join(w)
            i += 1
    return docs | {i: None, i + 1: "", i + 2: " \t", i + 3: "Only three words", i + 4: "only THREE words"}


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    docs = corpus(seed, 70)
    df = spark.createDataFrame([(i, t, 1) for i, t in docs.items()], "doc_id long, text string, n int").repartition(5)
    got = sorted((x.doc_id, x.n_shingles, x.component_id) for x in jj.jaccard_components(df).collect())
    assert got == brute(docs)
    assert len({c for _, _, c in got}) < len(docs)


def test_empty_table(spark):
    assert jj.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_divide_skip_against_brute_force():
    r = np.random.default_rng(1)
    for _ in range(200):
        q = np.unique(r.integers(0, 60, r.integers(1, 40)))
        sets = [np.unique(r.integers(0, 60, r.integers(1, 40))) for _ in range(r.integers(1, 30))]
        least = jj.needed_overlap(len(q), np.array([len(s) for s in sets]), int(r.choice([30, 60, 80])))
        want = [len(np.intersect1d(q, s)) for s in sets]
        got = jj.BlockIndex(sets).search(q, least)
        assert [w if w >= n else -1 for w, n in zip(want, least)] == got.tolist()


def test_sets_are_read_once_for_queries_and_members(spark, tmp_path):
    r = random.Random(3)
    base = [r.getrandbits(60) for _ in range(100)]
    sets = {1: base, 2: base[:95], 3: base[:70], 4: base[5:] + [7]}
    raw = [(c, np.sort(np.array(s, dtype=np.int64)).tobytes()) for c, s in sets.items()]
    spark.createDataFrame([(c, bytearray(b)) for c, b in raw], "cls bigint, items binary").write.parquet(f"{tmp_path}/sets")
    pairs = spark.createDataFrame([(a, b, len(sets[a]), len(sets[b])) for a in sets for b in sets if a < b], "q bigint, m bigint, nq int, nm int")
    out = jj.compare(pairs, spark.read.parquet(f"{tmp_path}/sets"), 80)
    want = {(a, b, o) for a in sets for b in sets if a < b and 100 * (o := len({*sets[a]} & {*sets[b]})) >= 80 * len({*sets[a]} | {*sets[b]})}
    assert {(x["q"], x["m"], x["overlap"]) for x in out.collect()} == want
    assert out._jdf.queryExecution().sparkPlan().toString().count("FileScan parquet") == 1
