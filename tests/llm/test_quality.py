import random

import numpy as np
import pyarrow as pa

from skyflow.llm import quality as ql


def test_statistics_of_small_texts():
    x = ql._statistics(pa.array(["Ab cd ab\nAb cd ab\n| x!", "", "  ", "one"]))
    s = dict(zip(ql.STATISTICS, x[0]))
    assert s["words"] == 8 and s["lines"] == 3 and abs(s["repeated_lines"] - 1 / 3) < 1e-9 and s["bar_share"] == 1 / 22
    assert s["distinct_share"] == 4 / 8 and s["capital_words"] == 2 / 8
    assert not x[1].any() and x[2][ql.STATISTICS.index("words")] == 0 and x[3][ql.STATISTICS.index("words")] == 1


def test_compiled_rules_equal_numpy(spark):
    r = np.random.default_rng(0)
    x = r.random((300, len(ql.STATISTICS)))
    y = ((x[:, 0] > 0.5) & (x[:, 3] < 0.6)).astype(float)
    rules, w, b = ql.fit(x, y)
    want = 1 / (1 + np.exp(-(ql.apply_rules(rules, x) @ w + b)))
    df = spark.createDataFrame([(i, *map(float, row)) for i, row in enumerate(x)], ["id", *ql.STATISTICS])
    got = [v for _, v in sorted(df.select("id", ql.compile_score(rules, w, b).alias("s")).collect())]
    assert np.allclose(got, want) and ((want > 0.5) == (y > 0)).mean() > 0.9
    assert 0 < (w != 0).sum() < len(w)


def test_held_out_accuracy(spark):
    r = random.Random(1)
    docs, labels = [], []
    for i in range(500):
        words = ["".join(r.choices("abcdefg", k=r.randint(1, 8))) for _ in range(r.randint(10, 80))]
        good = r.random() < 0.7
        docs.append((i, " ".join(words) if good else r.choice([" | ", "!! "]).join(words), 0.5))
        labels.append((i, int(good)))
    docs += [(500, None, 0.0), (501, "", 0.0), (None, "x", 0.0)]
    d = spark.createDataFrame(docs, "doc_id long, text string, score double")
    out = ql.quality(d, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    truth = dict(labels)
    held = [x for x in out if x.doc_id in truth and x.held_out]
    assert len(out) == 503 and len(held) > 80 and sum(x.predicted == truth[x.doc_id] for x in held) > 0.95 * len(held)
    assert {x.score for x in ql.quality(d, spark.createDataFrame([], "doc_id long, quality int")).collect()} == {0.5}
    assert ql.quality(d.limit(0), spark.createDataFrame(labels, "doc_id long, quality int")).collect() == []
