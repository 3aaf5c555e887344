"""Toxicity: class-conditional Kneser-Ney models over words and over the characters of words.

Word model: words are counted in Spark by key, so the table grows with the labelled texts. A word is
frequent when it makes up FREQUENT of their words or more, so there are at most 1 / FREQUENT such words;
all others are one unknown word to the bigrams, which are counted by key too. A frequent word's own
probability comes from continuation counts of its class, over all bigrams, backed off to those of both
classes; a rare word's is that of the unknown word times its share among the rare words of its class,
backed off to its share in both classes. Bigrams and rare words that occur once, or make up less than
OWN of all, have no entry of their own: they are discounted fully and left to the backoff, which keeps
their mass. The log-likelihood ratio of a text is a sum of one weight for each bigram and each word in
it; entries are at most 1 / OWN words and 1 / OWN bigrams, so the workers hold them all.

Character model: characters fall into 48 symbols, so a table over all 4-grams has 48^4 cells whatever the
corpus; it rates words never seen. Orders 4 and 3 have counts of their own for toxic and for ordinary
texts; orders 2 and 1 are Kneser-Ney continuation counts of both classes together.

A few telling expressions drown in the sum over a long text, so the highest log ratio of a word, and of a
bigram beyond its words, count too. Both ratios, divided by the text's length, and these two peaks are
mapped to a score by logistic calibration. It is fitted on
training rows, each rated by counts without its own half of the training folds; the scores themselves use
the counts of all training folds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyflow.llm.common import hash_spans, id_crc_mod, materialize, mix64, string_buffers, text_of, tune, word_spans

SYMBOLS, ORDER, DISCOUNT = 48, 4, 0.75
START, END, DIGIT, OTHER = 0, 1, 28, 31
FOLDS, HELD_OUT, FIRST_HALF = 5, 0, 2
#: Labelled training rows used to fit five numbers; chosen by hash, so independent of order.
CALIBRATION_ROWS = 50_000
BROADCAST_LABELS = 1_000_000
#: Least share of a frequent word among all words.
FREQUENT = 5e-6
#: Least share of a rare word among all words, and of a bigram among all bigrams, for an entry of its own.
OWN = 1e-6
#: Counts of all training folds, and without either half of them.
VARIANTS = ((0, 1), (1,), (0,))
#: Word numbers that stand for a rare word and the ends of a text; frequent words follow.
_RARE, _FIRST, _LAST, _OWN = 0, 1, 2, 3
_SEGMENT = 1 << 18


def _codes() -> np.ndarray:
    code = np.full(256, OTHER, dtype=np.int32)
    for k in range(26):
        code[97 + k] = code[65 + k] = 2 + k
    code[48:58] = DIGIT
    code[[ord(c) for c in ".,;:!?"]] = 29
    code[[ord(c) for c in "'\"-()"]] = 30
    code[128:] = 32 + np.arange(128) % 16
    return code


_CODE = _codes()
_WEIGHTS = ("v0", "v1", "v2")
_COUNTS = ("c00", "c01", "c10", "c11")
#: Bytes that make up words: ASCII letters and digits, and characters of two bytes.
_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(192, 224)]] = True
#: Bytes of the characters that stand alone, at their first byte.
_WIDTH = np.zeros(256, dtype=np.int64)
_WIDTH[33:127] = 1
_WIDTH[_WORD] = 0
_WIDTH[224:240], _WIDTH[240:248] = 3, 4


def grams(col: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, 4-gram index) of every character and word end; whole words, in bounded segments."""
    raw, offsets = string_buffers(col)
    starts, ends = word_spans(raw, offsets)
    lens = ends - starts
    owner = np.searchsorted(offsets, starts, "right") - 1
    cum = np.concatenate(([0], np.cumsum(lens + 1)))
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(cum, cum[lo] + _SEGMENT, "right")) - 1)
        n = (lens[lo:hi] + 1).astype(np.int64)
        begin = cum[lo:hi] - cum[lo]
        total = int(cum[hi] - cum[lo])
        place = np.arange(total) - np.repeat(begin, n)
        sym = np.full(total, END, dtype=np.int32)
        inside = np.ones(total, dtype=bool)
        inside[begin + n - 1] = False
        sym[inside] = _CODE[raw[(place + np.repeat(starts[lo:hi], n))[inside]]]
        gram = sym.copy()
        for back, scale in ((1, SYMBOLS), (2, SYMBOLS**2), (3, SYMBOLS**3)):
            prev = np.zeros(total, dtype=np.int32)
            prev[back:] = sym[:-back] if back < total else prev[back:]
            prev[place < back] = START
            gram += prev * scale
        yield np.repeat(owner[lo:hi], n), gram
        lo = hi


def ratio_parts(used: np.ndarray, ordinary: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Log ratios of order 3, those of backing off to it, and the 4-grams that occur (``used``, with their counts) with theirs."""
    s, d = SYMBOLS, DISCOUNT
    context, suffix = used // s, used % s**3

    def smooth(c: np.ndarray, lower: np.ndarray) -> np.ndarray:
        total = c.sum(axis=-1, keepdims=True)
        share = np.where(total > 0, d * (c > 0).sum(axis=-1, keepdims=True), 1) / np.maximum(total, 1)
        return np.maximum(c - d, 0) / np.maximum(total, 1) + share * lower

    c3 = [np.bincount(suffix, n, s**3).reshape(s, s, s) for n in (ordinary, toxic)]
    cont2 = (sum(c3) > 0).sum(axis=0).astype(float)
    cont1 = (sum(c3).sum(axis=0) > 0).sum(axis=0).astype(float)
    p2 = smooth(cont2, smooth(cont1, np.full(s, 1 / s)))
    p3 = [smooth(c, p2) for c in c3]
    share, p4 = [], []
    for n, p in zip((ordinary, toxic), p3):
        total, kinds = np.bincount(context, n, s**3), np.bincount(context, n > 0, s**3)
        share.append(np.where(total > 0, d * kinds, 1) / np.maximum(total, 1))
        p4.append(np.maximum(n - d, 0) / np.maximum(total, 1)[context] + share[-1][context] * p.reshape(-1)[suffix])
    back = np.log(share[1] / share[0]).reshape(s, s, s)
    return tuple(x.astype(np.float32) for x in (np.log(p3[1] / p3[0]), back)) + (used.astype(np.int32), np.log(p4[1] / p4[0]).astype(np.float32))


def dense_ratio(lower: np.ndarray, back: np.ndarray, used: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The table over all 4-grams; the parts are far smaller to send."""
    out = (back[..., None] + lower[None]).reshape(-1)
    out[used] = values
    return out


def log_ratio(ordinary: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """log p(last symbol | context, toxic) - the same for ordinary, for every 4-gram."""
    used = np.flatnonzero(ordinary + toxic)
    return dense_ratio(*ratio_parts(used, ordinary[used], toxic[used]))


def tokens(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text number, 64-bit hash) of every token: words, single ASCII signs, and single characters from U+0800 on."""
    raw, offsets = string_buffers(col)
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    border = np.zeros(len(raw) + 1, dtype=bool)
    border[offsets] = True
    word = _WORD[raw]
    word[1:] |= (raw[1:] >= 128) & (raw[1:] < 192) & (raw[:-1] >= 192) & (raw[:-1] < 224)
    before = np.concatenate(([False], word[:-1]))
    after = np.concatenate((word[1:], [False]))
    starts = np.flatnonzero(word & (~before | border[:-1]))
    ends = np.flatnonzero(word & (~after | border[1:])) + 1
    one = np.flatnonzero(_WIDTH[raw] > 0)
    begin = np.concatenate((starts, one))
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.concatenate((ends, one + _WIDTH[raw[one]]))[order]
    return np.searchsorted(offsets, begin, "right") - 1, hash_spans(raw, begin, end).view(np.int64)


def pairs(owner: np.ndarray, word: np.ndarray, rows: int, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, hash, number, number before) of every word; a text begins with _FIRST and ends with _LAST, whose hash is 0."""
    n = np.bincount(owner, minlength=rows)
    own = np.repeat(np.arange(rows), n + 1)
    stop = np.cumsum(n + 1) - 1
    inside = np.ones(len(own), dtype=bool)
    inside[stop] = False
    number, hashes = np.full(len(own), _LAST), np.zeros(len(own), dtype=np.int64)
    hashes[inside] = word
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, word), len(frequent) - 1)
        number[inside] = np.where(frequent[at] == word, at + _OWN, _RARE)
    else:
        number[inside] = _RARE
    before = np.concatenate(([_FIRST], number[:-1]))
    before[stop - n] = _FIRST
    return own, hashes, number, before


def pair_key(before: np.ndarray, number: np.ndarray) -> np.ndarray:
    return mix64((before << 32 | number).view(np.uint64)).view(np.int64)


def _counted(rows: DataFrame, keys_of, label: str) -> DataFrame:
    """Counts (``key``, ``c00`` to ``c11`` by half and label) of the keys of rows (``half``, ``label``, ``text``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kind = b.column(0).to_numpy() * 2 + (b.column(1).to_numpy() > 0)
            own, key = keys_of(b.column(2))
            found, number = np.unique(key, return_inverse=True)
            c = np.bincount(number * 4 + kind[own], minlength=4 * len(found)).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (found, *c.T)], ["key", *_COUNTS])

    got = rows.select("half", "label", "text").mapInArrow(run, "key bigint, c00 bigint, c01 bigint, c10 bigint, c11 bigint")
    return materialize(got.groupBy("key").agg(*(F.sum(c).alias(c) for c in _COUNTS)), label)


_CELLS = [(v, c) for v in range(len(VARIANTS)) for c in (0, 1)]


def _of_class(v: int, c: int):
    return sum((F.col(f"c{half}{c}") for half in VARIANTS[v]), F.lit(0))


_ALL = "(c00 + c01 + c10 + c11)"


class WordModel:
    """Kneser-Ney statistics of the frequent words, at most 1 / FREQUENT of them, and weights of words by number."""

    def __init__(self, frequent: np.ndarray, bigrams: DataFrame, least: int):
        self.frequent = frequent
        size = len(frequent) + _OWN
        d = DISCOUNT
        own = {x: _of_class(*x) for x in _CELLS}
        # what a bigram leaves to the backoff: all of it when it has no entry
        left = {(v, c): F.when((F.expr(_ALL) >= least) & (own[v, 0] + own[v, 1] >= 2), F.least(own[v, c], F.lit(d))).otherwise(own[v, c]) for v, c in _CELLS}
        by_u = bigrams.groupBy(F.shiftright("key", 32).alias("w")).agg(*(F.sum(own[v, c]).alias(f"n{v}{c}") for v, c in _CELLS), *(F.sum(left[v, c]).alias(f"t{v}{c}") for v, c in _CELLS)).toArrow()
        by_w = bigrams.groupBy(F.col("key").bitwiseAND(0xFFFFFFFF).alias("w")).agg(
            *(F.sum((own[v, c] > 0).cast("long")).alias(f"k{v}{c}") for v, c in _CELLS), *(F.sum(((own[v, 0] + own[v, 1]) > 0).cast("long")).alias(f"k{v}") for v in range(len(VARIANTS)))
        ).toArrow()

        def column(table: pa.Table, name: str) -> np.ndarray:
            out = np.zeros(size)
            out[table["w"].to_numpy()] = table[name].to_numpy()
            return out

        self.n, self.p, self.back = {}, {}, {}
        for v, c in _CELLS:
            pooled, k = column(by_w, f"k{v}"), column(by_w, f"k{v}{c}")
            base = pooled / max(1, pooled.sum())
            self.p[v, c] = np.maximum(k - d, 0) / k.sum() + np.minimum(k, d).sum() / k.sum() * base if k.sum() else base
            self.n[v, c] = column(by_u, f"n{v}{c}")
            self.back[v, c] = np.where(self.n[v, c] > 0, column(by_u, f"t{v}{c}") / np.maximum(self.n[v, c], 1), 1.0)
        self.ratio = np.zeros((len(VARIANTS), size))
        self.weight = np.zeros((len(VARIANTS), size))
        for v in range(len(VARIANTS)):
            known = (self.p[v, 0] > 0) & (self.p[v, 1] > 0)
            self.ratio[v, known] = np.log(self.p[v, 1][known] / self.p[v, 0][known])
            self.weight[v] = self.ratio[v] + np.log(np.maximum(self.back[v, 1], 1e-9) / np.maximum(self.back[v, 0], 1e-9))

    def gains(self, key: np.ndarray, counts: list[np.ndarray]) -> list[np.ndarray]:
        """For each variant, what a bigram adds to the log ratio beyond the weights of its words."""
        u, w, out = key >> 32, key & 0xFFFFFFFF, []
        for v, halves in enumerate(VARIANTS):
            own = [sum(counts[2 * h + c] for h in halves) for c in (0, 1)]
            seen = own[0] + own[1] >= 2
            u_, w_ = u[seen], w[seen]
            p = [np.maximum(own[c][seen] - DISCOUNT, 0) / np.maximum(self.n[v, c][u_], 1) + np.maximum(self.back[v, c][u_], 1e-9) * self.p[v, c][w_] for c in (0, 1)]
            gain = np.zeros(len(key), dtype=np.float32)
            gain[seen] = np.log(p[1] / p[0]) - np.log(np.maximum(self.back[v, 1][u_], 1e-9) / np.maximum(self.back[v, 0][u_], 1e-9)) - self.ratio[v][w_]
            out.append(gain)
        return out


def _rare_weights(rare: DataFrame, least: int) -> tuple[list[float], DataFrame]:
    """Log ratio of the mass left to rare words without an entry, by variant; and (``key``, weights) of the others beyond it."""
    own = {x: _of_class(*x) for x in _CELLS}
    both = {v: own[v, 0] + own[v, 1] for v in range(len(VARIANTS))}
    entry = {v: (F.expr(_ALL) >= least) & (both[v] >= 2) for v in range(len(VARIANTS))}
    kept = {(v, c): F.when(entry[v], F.greatest(own[v, c] - DISCOUNT, F.lit(0.0))).otherwise(0.0) for v, c in _CELLS}
    sums = rare.agg(*(F.sum(own[x]).alias(f"n{x[0]}{x[1]}") for x in _CELLS), *(F.sum(kept[x]).alias(f"k{x[0]}{x[1]}") for x in _CELLS)).first()
    weights, unseen = [], []
    for v in range(len(VARIANTS)):
        total = [sums[f"n{v}{c}"] or 0 for c in (0, 1)]
        share = both[v] / F.lit(float(max(1, sum(total))))
        mass = [1 - sums[f"k{v}{c}"] / total[c] if total[c] else 1.0 for c in (0, 1)]
        q = [kept[v, c] / F.lit(float(max(1, total[c]))) / max(mass[c], 1e-9) + share for c in (0, 1)]
        weights.append(F.when(entry[v], F.log(q[1] / q[0])).otherwise(0.0).cast("float"))
        unseen.append(float(np.log(max(mass[1], 1e-9) / max(mass[0], 1e-9))))
    return unseen, rare.filter(F.expr(_ALL) >= least).select("key", *(w.alias(f"v{v}") for v, w in enumerate(weights)))


def word_model(spark: SparkSession, train: DataFrame) -> tuple[WordModel, np.ndarray, np.ndarray]:
    """The model of the frequent words; keys and weights (by variant) of the entries of rare words and bigrams."""
    words = _counted(train, tokens, "toxicity-words")
    total = words.agg(F.sum(F.expr(_ALL))).first()[0] or 0
    least, entry = (max(2, int(np.ceil(total * share))) for share in (FREQUENT, OWN))
    frequent = np.sort(words.filter(f"{_ALL} >= {least}").select("key").toArrow()["key"].to_numpy())  # at most 1 / FREQUENT
    shared = spark.sparkContext.broadcast(frequent)

    def bigrams_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        own, _, number, before = pairs(*tokens(col), len(col), shared.value)
        return own, before << 32 | number

    bigrams = _counted(train, bigrams_of, "toxicity-bigrams")
    model = WordModel(frequent, bigrams, entry)
    unseen, rare = _rare_weights(words.filter(f"{_ALL} < {least}"), entry)
    model.weight[:, _RARE] += unseen
    # at most 1 / OWN rows of either
    rare, explicit = rare.toArrow(), bigrams.filter(f"{_ALL} >= {entry}").select("key", *_COUNTS).toArrow()
    pair = explicit["key"].to_numpy()
    gains = model.gains(pair, [explicit[c].to_numpy() for c in _COUNTS])
    key = np.concatenate((rare["key"].to_numpy(), pair_key(pair >> 32, pair & 0xFFFFFFFF)))
    value = np.stack([np.concatenate((rare[c].to_numpy(), g)) for c, g in zip(_WEIGHTS, gains)]).astype(np.float32)
    order = np.argsort(key)
    return model, key[order], value[:, order]


def calibrate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """A slope for each column of ``x`` and the intercept of a ridge logistic fit, by Newton steps."""
    k = x.shape[1]
    if len(set(y.tolist())) < 2:
        return np.array([0.0] * k + [-1.0])
    scale = np.maximum(np.abs(x).max(axis=0), 1e-12)
    z = np.column_stack([x / scale, np.ones(len(x))])
    w = np.zeros(k + 1)
    ridge = np.array([1e-2] * k + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge)
        w = w - np.linalg.solve(h, z.T @ (p - y) + ridge * w)
    return np.append(w[:k] / scale, w[k])


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """(id, label) of the training folds, one row an id (1 wins); and a broadcast of it where its size allows."""
    own = labels.select(labels[id_col].alias("id"), labels[label_col].cast("int").alias("label")).filter(F.col("id").isNotNull() & F.col("label").isNotNull() & (id_crc_mod(F.col("id"), FOLDS) != HELD_OUT))
    own = materialize(own.groupBy("id").agg(F.max("label").alias("label")), "toxicity-labels")
    return own, F.broadcast(own) if own.count() <= BROADCAST_LABELS else own


def _counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(4-grams that occur, their counts by half and class) over all rows (``half``, ``label``, ``text``); at most 4 x 48^4 sums reach the driver."""
    size = SYMBOLS**ORDER

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(4 * size, dtype=np.int32)
        for b in batches:
            kind = b.column(0).to_numpy() * 2 + (b.column(1).to_numpy() > 0)
            for owner, gram in grams(b.column(2)):
                np.add.at(total, gram + size * kind[owner], 1)
        used = np.flatnonzero(total)
        for k in range(0, len(used), 100_000):
            part = used[k : k + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(total[part], pa.int64())], ["gram", "n"])

    sums = rows.select("half", "label", "text").mapInArrow(run, "gram int, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    gram = sums["gram"].to_numpy()
    used, at = np.unique(gram % size, return_inverse=True)
    out = np.zeros((4, len(used)), dtype=np.int64)
    out[gram // size, at] = sums["n"].to_numpy()
    return used, out.reshape(2, 2, -1)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """Score every whole text for toxicity.

    Labels count only from rows whose crc32(id) mod 5 is not 0. Returns one row for each input row: the
    id, ``held_out``, ``score`` (0 to 1), ``predicted`` (score >= 0.5), ``text_hash`` (xxhash64). Null and empty texts score the
    intercept alone; without labels of both classes every score is the same and below 0.5. A null id is
    held out and never labelled. Repeated rows answer each for itself; an empty table gives an empty
    result; other columns are ignored.
    """
    spark = docs.sparkSession
    tune(spark)
    own, small = _labelled(docs, labels, id_col, label_col)
    texts = docs.select(docs[id_col].alias("id"), F.lower(text_of(docs, text_col)).alias("text"), F.xxhash64(text_of(docs, text_col)).alias("text_hash"))
    half = (id_crc_mod(F.col("id"), FOLDS) > FIRST_HALF).cast("int")
    train = texts.join(small, "id").select("id", half.alias("half"), "label", "text")
    used, counts = _counts(train)
    shared = spark.sparkContext.broadcast([ratio_parts(used, *counts[list(v)].sum(axis=0)) for v in VARIANTS])
    model, keys, values = word_model(spark, train)
    table = spark.sparkContext.broadcast((model.frequent, model.weight.astype(np.float32), model.ratio.astype(np.float32), keys, values))
    del model, keys, values

    sums_of, peaks_of = ("words", "words_out"), ("word_peak", "word_peak_out", "pair_peak", "pair_peak_out")

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = [dense_ratio(*x) for x in shared.value]
        (frequent, weight, peak, key, value) = table.value
        for b in batches:
            rows, without = b.num_rows, b.column(2).to_numpy()  # 0, or the variant without the row's own half
            chars, chars_out, n = np.zeros(rows), np.zeros(rows), np.zeros(rows)
            for owner, gram in grams(b.column(1)):
                n += np.bincount(owner, minlength=rows)
                chars += np.bincount(owner, ratio[0][gram], rows)
                for v in (1, 2):
                    use = without[owner] == v
                    chars_out += np.bincount(owner[use], ratio[v][gram[use]], rows)
            own, hashes, number, before = pairs(*tokens(b.column(1)), rows, frequent)
            begin = np.searchsorted(own, np.arange(rows))
            rare = number == _RARE
            sums, peaks = np.zeros((2, rows)), []
            for of_words in (True, False):
                use = rare if of_words else np.ones(len(own), dtype=bool)
                ks = hashes[rare] if of_words else pair_key(before, number)
                at = np.minimum(np.searchsorted(key, ks), max(0, len(key) - 1))
                hit = key[at] == ks if len(key) else np.zeros(len(ks), dtype=bool)
                where = np.flatnonzero(use)[hit]
                for k, v in enumerate((np.zeros_like(own), without[own])):
                    here = np.zeros(len(own))
                    here[where] = value[v[where], at[hit]]
                    best = here
                    if of_words:
                        best = peak[v, number] * ~rare + here
                        here = weight[v, number] + here
                    sums[k] += np.add.reduceat(here, begin) if rows else 0
                    peaks.append(np.maximum(0, np.maximum.reduceat(best, begin)) if rows else np.zeros(0))
            m = np.bincount(own, minlength=rows)
            cols = [pa.array(chars / np.maximum(n, 1)), pa.array(chars_out / np.maximum(n, 1)), *(pa.array(x, pa.float64()) for x in (*sums, *peaks)), pa.array(m)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), b.column(3), b.column(4), *cols], ["id", "without", "label", "text_hash", "chars", "chars_out", *sums_of, *peaks_of, "m"])

    kind = docs.schema[id_col].dataType.simpleString()
    marked = texts.join(small, "id", "left").select("id", "text", F.when(F.col("label").isNull(), 0).otherwise(half + 1).alias("without"), "label", "text_hash")
    rated = materialize(marked.mapInArrow(rate, f"id {kind}, without int, label int, text_hash bigint, chars double, chars_out double, words double, words_out double, word_peak double, word_peak_out double, pair_peak double, pair_peak_out double, m bigint"), "toxicity-ratios")
    rated = rated.withColumns({c: F.col(c) / F.col("m") for c in sums_of})
    used = ("chars", "words", "word_peak", "pair_peak")
    seen = rated.filter("label is not null").orderBy(F.xxhash64("id"), "text_hash").limit(CALIBRATION_ROWS).select(*(f"{c}_out" for c in used), "label").toPandas()
    *slopes, intercept = calibrate(seen.drop(columns="label").to_numpy(dtype=float), (seen["label"].to_numpy() > 0).astype(float)).tolist()
    blank = F.col("m") <= 1
    score = 1 / (1 + F.exp(-(F.when(blank, 0.0).otherwise(sum(F.col(c) * a for c, a in zip(used, slopes))) + intercept)))
    held = F.coalesce(id_crc_mod(F.col("id"), FOLDS) == HELD_OUT, F.lit(True))
    return rated.select(F.col("id").alias(id_col), held.alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), "text_hash")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
