import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from skyflow.llm import tokens


@pytest.fixture(scope="module")
def tok():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.default_tokenizer())


HARD = [
    "", " ", "  ", "\n\n", "a  b \t\n x<|endoftext|>y <|endoftext|>  ", "    x y\x85 z\x1c q!", "don't  'll we're 12ab ß日本 語　a", "x" * 200_000, "ab cd " * 40_000, " \x1d\x1e a\x1f b", "Foo", "BarBaz", "foo.bar,baz's don't'll 's't x'S", "日本。語、", "Привет,мир! ½, x²: é, e\u0301,", "a<|endoftext|>,b<|endof text|>.", "!!??..", "  x    y",
]


def test_chunks_give_the_tokens_of_whole_texts(tok):
    r = random.Random(9)
    alphabet = list("abcXYZ019 .,'!|<>_-\n\t½²。\u0301") + [" ", "  ", "é", "日", " ", " ", "<|endoftext|>", "'s", "\x1c", "\x85"]
    texts = HARD + ["".join(r.choices(alphabet, k=r.randint(1, 300))) for _ in range(400)]
    ids, lens = tokens.ChunkEncoder(tokens.default_tokenizer(), True), tokens.ChunkEncoder(tokens.default_tokenizer(), False)
    for t in texts:
        want = tok.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(ids.encode(t), "<u4").tolist() == want
        assert lens.length(t) == len(want)


def test_cache_is_bounded(monkeypatch, tok):
    monkeypatch.setattr(tokens, "CACHE_BYTES", 2000)
    enc = tokens.ChunkEncoder(tokens.default_tokenizer(), False)
    for k in range(40):
        t = " ".join(f"word{k}{j}, common" for j in range(20))
        assert enc.length(t) == len(tok.encode(t, add_special_tokens=False).ids)
        assert max(len(enc.seen), len(enc.older)) <= 150


@pytest.mark.parametrize("ids", [True, False])
def test_cache_takes_no_more_memory_than_its_bound(monkeypatch, ids):
    monkeypatch.setattr(tokens, "CACHE_BYTES", 1 << 20)
    enc = tokens.ChunkEncoder(tokens.default_tokenizer(), ids)
    tracemalloc.start()
    for k in range(100):
        enc._values(" ".join(f"w{k:x}x{j:x}" for j in range(500)))
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 3 << 20  # two generations, one of them with its last text; a table may be half empty


def test_texts_without_spaces_are_not_kept(tok):
    enc = tokens.ChunkEncoder(tokens.default_tokenizer(), True)
    for k in range(2000):
        t = f"{k}" + "漢字" * 60 + f"a{k}" * 90
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids
    assert sum(map(len, enc.seen)) + sum(map(len, enc.older)) < 5000


def test_counts(spark, tok):
    rows = [(i, t, -1) for i, t in enumerate(HARD)] + [(99, None, 0), (99, None, 0), (None, "b a", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int").repartition(3)
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.token_counts(df).collect()), key=str)
    want = [(i, len((t or "").encode()), n := len(tok.encode(t or "", add_special_tokens=False).ids), n > 1024) for i, t, _ in rows]
    assert got == sorted(want, key=str)
    assert tokens.token_counts(df.limit(0)).collect() == []


def test_column_encoder_gives_the_ids_of_the_library(monkeypatch):
    # tables so small that generations come and go, and segments so small that texts exceed them
    monkeypatch.setattr(tokens, "SLOTS", 1 << 10)
    monkeypatch.setattr(tokens, "MOST_TAKEN", 300)
    monkeypatch.setattr(tokens, "SEGMENT_BYTES", 700)
    rnd = random.Random(5)
    parts = ["a", "Zq", " ", "  ", "\n", "\t", "\r\n", ",", "'s", "'", "<|endoftext|>", "é", "×", "÷", "ß", " ", "　", "\u0085", "漢", "。", "\x00", "\x0b", "\x1c", "7", "_", "😀", "word", "..", "́", "ſ", "łó", "longerwordthansixteenbytes", "\x7f", "ñ,"]
    texts = ["", *("".join(rnd.choices(parts, k=rnd.randint(0, 30))) for _ in range(2000)), " word" * 400]
    enc = tokens.ColumnEncoder(tokens.default_tokenizer())
    for _ in range(2):
        got = [list(memoryview(x).cast("I")) for i in range(0, len(texts), 20) for x in enc.column(pa.array(texts[i : i + 20]))]
        assert got == [x.ids for x in enc.tok.encode_batch_fast(texts, add_special_tokens=False)]
    assert enc.old is not None


def test_a_large_vocabulary_is_learnt_once_within_bounded_memory():
    # the cache of single texts forgot two thirds of so many words and encoded them again in each pass
    text = pa.array([" ".join(f"{a}{b}{c}" for b in range(100, 170) for c in range(100, 170)) for a in (x + y for x in ("ox", "uj", "ky", "wv", "zi", "qa") for y in "abcdefghijk")])
    enc, learnt = tokens.ColumnEncoder(tokens.default_tokenizer()), []
    learn = enc.learn
    enc.learn = lambda chunks: learn(learnt.extend(chunks) or chunks)
    first = list(enc.column(text))
    assert len(learnt) > 300_000
    learnt.clear()
    assert list(enc.column(text)) == first and not learnt
    table = enc.table
    assert sum(x.nbytes for x in (table.keys, table.start, table.n, table.ids)) < 36 << 20
