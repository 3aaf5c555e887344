import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from skyflow.llm import toxicity as tx


def test_grams_against_brute_force():
    texts = ["Ab1 .é\n x", "", "abcdefg  hi", " "]
    want = Counter()
    for k, t in enumerate(texts):
        for w in t.split():
            s = [tx.START] * 3 + [int(tx._CODE[b]) for b in w.lower().encode()] + [tx.END]
            for i in range(3, len(s)):
                want[k, ((s[i - 3] * 48 + s[i - 2]) * 48 + s[i - 1]) * 48 + s[i]] += 1
    got = Counter()
    for owner, gram in tx.grams(pa.array(texts)):
        got.update(zip(owner.tolist(), gram.tolist()))
    assert got == want


def test_models_are_distributions():
    r = np.random.default_rng(1)
    n = tx.SYMBOLS**4
    a, b = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    a[r.integers(0, n, 5000)] = r.integers(1, 9, 5000)
    ratio = tx.log_ratio(a, b)
    assert np.isfinite(ratio).all() and np.allclose(tx.log_ratio(a, a), 0)


def test_held_out_accuracy(spark):
    r = random.Random(6)
    parts = ["ba", "no", "ti", "re", "la", "su"]
    docs, labels = [], []
    for i in range(600):
        words = ["".join(r.choices(parts, k=r.randint(1, 4))) for _ in range(r.randint(20, 120))]
        toxic = r.random() < 0.3
        if toxic:
            for _ in range(1 + len(words) // 20):
                words.insert(r.randrange(len(words)), r.choice(["zork", "qued", "zorkig"]))
        docs.append((i, " ".join(words), None))
        labels.append((i, int(toxic)))
    docs += [(600, None, None), (601, "", None), (None, "zork", None)]
    d = spark.createDataFrame(docs, "doc_id long, text string, score string")
    out = tx.toxicity(d, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    truth = dict(labels)
    held = [x for x in out if x.doc_id in truth and x.held_out]
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 5 == 0) for x in out if x.doc_id is not None)
    assert len(out) == 603 and sum(x.predicted == truth[x.doc_id] for x in held) > 0.95 * len(held)
    assert {x.predicted for x in out if x.doc_id in (600, 601)} == {0} and all(0 <= x.score <= 1 for x in out)
    bare = tx.toxicity(d, spark.createDataFrame([], "doc_id long, toxic int")).collect()
    assert len(bare) == 603 and {x.predicted for x in bare} == {0}
    assert tx.toxicity(d.limit(0), spark.createDataFrame(labels, "doc_id long, toxic int")).collect() == []


def test_tokens():
    owner, word = tx.tokens(pa.array(["Ab1, é日本 ab1", "", "é.", "x"]))
    assert owner.tolist() == [0] * 6 + [2, 2, 3]
    assert word[0] == word[5] and word[2] == word[6] and len(set(word.tolist())) == 7


def test_every_fold_and_pairs_of_ordinary_words_count(spark):
    """The words of both classes are the same; only their order tells. One neutral table answers at any near bound."""
    r = random.Random(3)
    docs, labels = [], []
    for i in range(500):
        toxic = int(r.random() < 0.4)
        pair = ["red door", "цвет дом"] if toxic else ["door red", "дом цвет"]
        docs.append((i, " ".join(r.choices(["one", "two", "three", "four"], k=12) + [r.choice(pair)] + r.choices(["one", "two", "three"], k=5))))
        labels.append((i, toxic))
    d, y = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    out = {x.doc_id: x for x in tx.toxicity(d, y).collect()}
    held = [i for i in out if out[i].held_out]
    assert sum(out[i].predicted == labels[i][1] for i in held) > 0.95 * len(held)


def test_word_model_is_a_distribution(spark, monkeypatch):
    """What the weights stand for sums to one over the words of the model, whatever the entries."""
    monkeypatch.setattr(tx, "FREQUENT", 0.02)
    r = random.Random(5)
    vocab = [f"w{chr(97 + i)}" for i in range(26)]
    rows = [(i % 2, int(i % 3 == 0), " ".join(r.choices(vocab, [1 / (k + 1) for k in range(26)], k=40))) for i in range(60)]
    train = spark.createDataFrame(rows, "half int, label int, text string")
    for own in (1e-6, 0.01):
        monkeypatch.setattr(tx, "OWN", own)
        model, _, _ = tx.word_model(spark, train)
        bigrams = Counter()
        for _, y, t in rows:
            w = [tx._FIRST]
            _, _, number, _ = tx.pairs(*tx.tokens(pa.array([t])), 1, model.frequent)
            for n in number.tolist():
                bigrams[y, w[-1], n] += 1
                w.append(n)
        pooled = Counter()
        for (_, u, w), n in bigrams.items():
            pooled[u, w] += n
        least = max(2, int(np.ceil(40 * 60 * own)))
        for c in (0, 1):
            assert abs(model.p[0, c].sum() - 1) < 1e-9
            for u in {u for y, u, _ in bigrams if y == c}:
                n = sum(x for (y, v, _), x in bigrams.items() if y == c and v == u)
                explicit = sum(max(bigrams[c, u, w] - tx.DISCOUNT, 0) for (v, w), x in pooled.items() if v == u and x >= least)
                assert n == model.n[0, c][u] and abs(explicit / n + model.back[0, c][u] - 1) < 1e-9


def test_repeated_rows_and_ties_answer_alike(spark):
    docs = [(i, ("bad zork " if i % 3 == 0 else "fine words ") * 8) for i in range(60)]
    docs += [(3, docs[3][1])] * 3 + [(61, "x" * 300_000), (62, "zork " * 60_000)]
    labels = [(i, int(i % 3 == 0)) for i in range(60)] + [(3, 1), (3, 0), (4, None), (None, 1)]
    out = tx.toxicity(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len(out) == len(docs) and len({(x.score, x.predicted) for x in out if x.doc_id == 3}) == 1
