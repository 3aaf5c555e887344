import random

from skyflow.llm import line_dedup as ld


def near(a, b):
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]


def brute(docs, near_chars, min_chars=1):
    first = {}
    for d in sorted(docs):
        for k, line in enumerate((docs[d] or "").split("\n")):
            line = line.strip(" \t")
            if len(line) >= min_chars:
                first.setdefault(line, (d, k))
    late = {x for x in first for y in first if first[y] < first[x] and min(len(x), len(y)) >= near_chars and near(x, y)}
    out = {}
    for d, t in docs.items():
        keep = [x for k, x in enumerate((t or "").split("\n")) if len(x.strip(" \t")) < min_chars or first[x.strip(" \t")] == (d, k) and x.strip(" \t") not in late]
        out[d] = None if t is None else "\n".join(keep)
    return out


def test_against_brute_force(spark):
    r = random.Random(4)
    bases = ["".join(r.choices("abcdé ", k=r.randint(18, 40))).strip() for _ in range(6)]
    bases += ["page %d of this very common report" % k for k in range(150)] + ["x" * 30]

    def line():
        s = r.choice(bases)
        for _ in range(r.choice([0, 0, 1, 1, 2])):
            k = r.randrange(len(s) + 1)
            s = r.choice([s[:k] + r.choice("abz") + s[k:], s[:k] + s[k + 1 :], s[:k] + "q" + s[k + 1 :]])
        return r.choice(["", " ", "\t"]) + s

    docs = {i: "\n".join(r.choice([line(), line(), "short", ""]) for _ in range(r.randint(0, 8))) for i in range(250)}
    docs |= {300: None, 301: "", 302: "\n\n"}
    df = spark.createDataFrame([(i, t, 7, "y") for i, t in docs.items()], "doc_id long, text string, n_lines int, key string").repartition(4)
    got = {x.doc_id: x for x in ld.line_dedup(df, near_chars=20).collect()}
    want = brute(docs, 20)
    assert {i: x.text for i, x in got.items()} == want
    assert any(x.n_dropped for x in got.values()) and got[300].n_dropped == 0 and got[1].key == "y"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row, old = [i + 1], row
        for j, y in enumerate(b):
            row.append(min(row[-1] + 1, old[j + 1] + 1, old[j] + (x != y)))
    return row[-1]


def test_bit_parallel_distance(spark):
    r = random.Random(8)
    pairs = [("", ""), ("", "a"), ("a", ""), ("aé😀", "aé😀"), ("aé😀", "aé"), ("abc", "bcd")]
    for _ in range(300):
        a = "".join(r.choices("abé😀", k=r.randint(0, 12)))
        b = list(a)
        for _ in range(r.randint(0, 4)):
            k = r.randrange(len(b) + 1)
            b[k : k + r.randint(0, 1)] = r.choices("abz", k=r.randint(0, 1))
        pairs.append((a, "".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string")
    for k in (1, 2, 3):
        got = df.select("a", "b", ld.within_edits(df["a"], df["b"], k).alias("near")).collect()
        assert all(x.near == (distance(x.a, x.b) <= k) for x in got)


def test_repeated_rows_null_ids_and_empty_table(spark):
    t = "a line that is long enough to count"
    df = spark.createDataFrame([(None, t), (2, t), (2, t), (3, t + "!"), (4, "ab\n\nabc\nab\n"), (5, "x" * 300_000 + "\n" + "x" * 299_999 + "y")], "doc_id long, text string")
    assert sorted((x.doc_id or 0, x.text) for x in ld.line_dedup(df).collect()) == [(0, t), (2, ""), (2, ""), (3, ""), (4, "ab\n\nabc\n"), (5, "x" * 300_000)]
    assert ld.line_dedup(df.limit(0)).collect() == []
