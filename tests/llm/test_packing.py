import random
import zlib

import numpy as np
import pytest

from skyflow.llm import packing


@pytest.mark.parametrize("seed", range(30))
def test_patterns_place_every_id_once_without_padding(seed):
    r = random.Random(seed)
    top = r.choice([8, 64, 1024])
    hist = {s: r.choice([1, 2, 5, 1000]) for s in r.sample(range(1, top), min(top - 1, r.choice([1, 2, 7, 300])))}
    got = packing.fill_gaps(packing.shortest_pack_first(dict(hist), top), top)
    total = sum(s * n for s, n in hist.items())
    assert sum(p.count for p in got) == -(-total // top)
    cover = {}
    for p in got:
        assert p.used <= top
        for s in p.slots:
            for rank in range(s.rank, s.rank + s.copies * p.count):
                cover.setdefault((s.size, rank), []).append((s.a, s.b))
    assert len(cover) == sum(hist.values())
    for (size, rank), parts in cover.items():
        parts.sort()
        assert rank < hist[size] and parts[0][0] == 0 and parts[-1][1] == size
        assert all(x[1] == y[0] for x, y in zip(parts, parts[1:]))


def brute_check(rows, texts, seq_len=1024):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_tokenizer())
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for d, text in texts.items():
        ids = np.array(tok.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        at = 0
        for r in sorted(by_doc[d], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    total = 0
    for parts in by_seq.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at <= seq_len
        total += at
    assert len(by_seq) == -(-total // seq_len)


def test_pack_against_brute_force(spark):
    r = random.Random(1)
    words = ["alpha", "beta", "gamma", "é", "12", "x" * 40]
    texts = {i: " ".join(r.choice(words) for _ in range(r.choice([0, 1, 5, 300, 1500]))) for i in range(80)}
    texts[80], texts[81] = None, ""
    df = spark.createDataFrame([(i, t, 0) for i, t in texts.items()], "doc_id long, text string, length int").repartition(3)
    rows = packing.pack(df).collect()
    assert len({(x.sequence_id, x.offset) for x in rows}) == len(rows)
    brute_check(rows, texts)


def test_pack_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    rows = packing.pack(df).collect()
    assert sorted((x.doc_id or 0, x.doc_tokens) for x in rows) == [(0, 2), (1, 3), (1, 3)]
    assert packing.pack(df.limit(0)).collect() == []


def test_places_need_no_python_workers(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "c " * 3000)], "doc_id long, text string")
    assert "ExistingRDD" not in packing.pack(df)._jdf.queryExecution().toString()
