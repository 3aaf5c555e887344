import random

import numpy as np
import pyarrow as pa

from skyflow.llm import common as c
from skyflow.llm.decontaminate import word_shingles


def test_shingle_sets_count_like_brute_force():
    r = random.Random(2)
    parts = ["an", "ha", "tion", "e", "é", "X", "の"]
    texts = ["".join(r.choice(parts) * r.choice([1, 1, 2]) + r.choice(["", " ", "\n", "\t "]) for _ in range(r.choice([0, 1, 8, 400]))) for _ in range(300)]
    texts += ["", " ", "a" * 3_000_000 + " b c", "x " * 400_000]
    for t, s in zip(texts, c.shingle_sets(pa.array(texts), 5)):
        assert len(s) == len(word_shingles(t, 5)) and (s[1:] > s[:-1]).all()
    a, b = c.shingle_sets(pa.array(["Ab c d e f g", "aB c d e f g"]), 5)
    assert a.tolist() == b.tolist()


def test_words_do_not_collide():
    words = sorted({"".join(random.Random(k).choices("abcdefgh", k=random.Random(k).randint(1, 9))) for k in range(20000)})
    raw, offs = c.string_buffers(pa.array([" ".join(words)]))
    assert len(set(c.hash_spans(raw, *c.word_spans(raw, offs)).tolist())) == len(words)


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 120)] + [(7, 7)]
    got = {r.v: r.label for r in c.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 120)}
