import base64
import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from skyflow.llm import alignment

DIR = "/root/testdata/sf0.001"
HARD = [
    "", " ", "  ", "\n", "\n\n ", " \n", "a\nb  c\t d　e", "\nfoo", "foo ", "foo  ", "foo\t", "foo\n", "foo \t\n bar", "\tfoo", "</s> <s> x<unk>", "a<|endoftext|> <|endoftext|>", "a\x00b\x85 \r\n q ", "x▁y", "▁", "日本 語。", "é ½ ﬁ",
    "😀😃 😄x", "= " * 50 + "=" * 300, "x" * 5000, " " * 700 + "z" + "\n" * 90, "a\x1c b\x1f", '");\r\n }\r\n', "don't we'll", "  x  y", "퟿￿", "​x﻿",
]


@pytest.fixture(scope="module")
def plain():
    """The contract, token by token: ids and bytes from the libraries, groups by sets of ends."""
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    ranks = {int(i): base64.b64decode(t) for t, i in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))

    def piece(i):
        p = sp.id_to_piece(i)
        return bytes([int(p[1:-1], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()

    def groups(text):
        if not text:
            return None
        raw = (" " + text).encode()
        a, b = tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
        pa_, pb = [ranks[i] for i in a], [piece(i) for i in b]
        if b"".join(pa_) != raw or b"".join(pb) != raw:
            return None
        ends = {0}
        both = set(np.cumsum([len(x) for x in pa_]).tolist()) & set(np.cumsum([len(x) for x in pb]).tolist())
        out, i, j, x, y = [], 0, 0, 0, 0
        for e in sorted(both | ends)[1:]:
            ga, gb = [], []
            while x < e:
                ga.append(a[i])
                x += len(pa_[i])
                i += 1
            while y < e:
                gb.append(b[j])
                y += len(pb[j])
                j += 1
            out.append((ga, gb))
        return out

    return groups


def expected(plain, rows):
    all_groups = [(i, plain(t)) for i, t in rows]
    links = [Counter((x, y) for ga, gb in g or [] for x in ga for y in gb) for _, g in all_groups]
    held = Counter(p for c in links for p in c)
    top = {}
    for (x, _), n in held.items():
        top[x] = max(top.get(x, 0), n)
    out = []
    for (i, g), c in zip(all_groups, links):
        g = g or []
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in g)
        out.append((
            i, sum(len(ga) for ga, _ in g), sum(len(gb) for _, gb in g), len(g), sum(c.values()), sum(n for p, n in c.items() if held[p] == top[p[0]]), sum(n * held[p] for p, n in c.items()),
            hashlib.sha256(text.encode()).hexdigest() if g else "",
        ))
    return sorted(out, key=str)


def test_chunks_are_encoded_as_whole_texts_are(plain):
    r = random.Random(5)
    alphabet = list("abcXY09 .,'!|<>_=-\n\t½。́") + ["  ", "é", "日", " ", " ", "<|endoftext|>", "</s>", "'s", "\x1c", "\x85", "\r", "\r\n", "　", " ", "😀", "\n ", " \n", "the ", "ing"]
    al = alignment.Aligner(alignment.encoders(alignment.default_tokenizer(), alignment.default_pieces()))
    texts = HARD + ["".join(r.choices(alphabet, k=r.randint(1, 120))) for _ in range(1500)]
    for text, (n_a, n_b, n_groups, n_links, digest, codes, times) in zip(texts, al.rows(texts), strict=True):
        g = plain(text) or []
        assert (n_a, n_b, n_groups) == (sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g)), repr(text)
        want = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        assert digest == (hashlib.sha256(want.encode()).hexdigest() if g else ""), repr(text)
        links = Counter(x * al.enc.width + y for ga, gb in g for x in ga for y in gb)
        assert dict(zip(codes.tolist(), times.tolist())) == dict(links) and n_links == sum(links.values())


def test_parts_and_large_groups_change_nothing(monkeypatch):
    al = alignment.Aligner(alignment.encoders(alignment.default_tokenizer(), alignment.default_pieces()))
    texts = HARD * 2 + ["the cat sat\non the mat " * 400]
    want = list(al.rows(texts))
    monkeypatch.setattr(alignment, "ALIGN_BYTES", 37)
    monkeypatch.setattr(alignment, "LISTED_LINKS", 1)
    monkeypatch.setattr(alignment, "CACHE_BYTES", 2000)
    for x, y in zip(want, al.rows(texts), strict=True):
        assert x[:5] == y[:5]
        assert dict(zip(x[5].tolist(), x[6].tolist())) == dict(zip(y[5].tolist(), y[6].tolist()))


def test_a_known_chunk_is_not_aligned_again(monkeypatch):
    al = alignment.Aligner(alignment.encoders(alignment.default_tokenizer(), alignment.default_pieces()))
    lines, calls = [], []
    coalesce, batch = alignment.coalesce, al.enc.a
    monkeypatch.setattr(alignment, "coalesce", lambda a, b: lines.append(len(a)) or coalesce(a, b))

    class Counted:
        def encode_batch_fast(self, group, **options):
            calls.append(len(group))
            return batch.encode_batch_fast(group, **options)

    monkeypatch.setattr(al.enc, "a", Counted())
    texts = [f"the mat{k} of the cat the mat{k}" for k in range(200)] + ["a broken \u2581 text", "the cat", "y" * 3000 + " the cat"] + ["the cat the cat"] * 300
    rows = list(al.rows(texts))
    assert len(calls) <= 4 and sum(calls) < 100  # not once for each text or chunk
    assert sum(lines) < sum(r[0] for r in rows) / 2
    assert rows[200][:5] == (0, 0, 0, 0, "")
    assert len(al.kept.number) == len(al.kept.texts) == al.kept.counts.size and not [c for c in al.kept.number if len(c) > alignment.LONGEST_KEPT]
    before = len(lines)
    assert [r[:5] for r in al.rows(texts[:200])] == [r[:5] for r in rows[:200]] and len(lines) == before


def test_groups_of_random_intervals():
    r = np.random.default_rng(2)
    for _ in range(300):
        n = int(r.integers(1, 40))
        cut = lambda: np.diff(np.unique(np.concatenate(([0, n], r.integers(0, n + 1, r.integers(0, n + 1))))))
        a, b = cut(), cut()
        ga, gb = alignment.coalesce(a, b)
        both = sorted(set(np.cumsum(a)) & set(np.cumsum(b)))
        assert ga.tolist() == [np.searchsorted(both, e) for e in np.cumsum(a)] and gb.tolist() == [np.searchsorted(both, e) for e in np.cumsum(b)]


@pytest.mark.parametrize("frequent", [200_000, 3])
def test_rows_of_any_kind(spark, plain, monkeypatch, frequent):
    monkeypatch.setattr(alignment, "FREQUENT_PAIRS", frequent)
    rows = [(i, t, 1) for i, t in enumerate(HARD)] + [(3, "the same", 1), (3, "the same", 1), (None, None, 1), (None, "the same thing " * 3000, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_a int").repartition(3)
    got = sorted((tuple(r) for r in alignment.alignment(df).collect()), key=str)
    assert got == expected(plain, [(i, t) for i, t, _ in rows])
    assert alignment.alignment(df.limit(0)).collect() == []


def test_every_document(spark, plain):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text").collect()
    got = sorted((tuple(r) for r in alignment.query(spark, DIR).collect()), key=str)
    assert got == expected(plain, [(r.doc_id, r.text) for r in docs])
