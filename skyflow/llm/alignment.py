"""Cross-tokenizer alignment: byte intervals of two tokenizers coalesced into groups where both end.

Texts are cut into chunks that neither tokenizer can cross, so a chunk's end is a border of both and a text's groups are
those of its chunks. Chunks that a worker does not know yet are encoded many at a time and lie on one line of bytes: numpy
sorts all intervals by start, runs the maximum of their ends and breaks a group where a start reaches it. The groups of
short chunks are kept, and those of a text put together from them. Linked id pairs are counted over the corpus by Spark
and joined back.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyflow.llm.common import materialize, text_of, tune
from skyflow.llm.tokens import _INK, _SPACE, default_tokenizer

#: Bytes of text aligned at once, and of the strings given to a tokenizer at once.
ALIGN_BYTES, BATCH_BYTES = 1 << 18, 1 << 18
#: Bytes of ids that a generation of the chunk cache holds, each chunk with ENTRY_BYTES of its own; longer chunks are never kept.
CACHE_BYTES, ENTRY_BYTES, LONGEST_KEPT = 16 << 20, 64, 64
#: Short chunks that a tokenizer gets as one string.
JOINED_CHUNKS = 64
#: Links of a group up to which they are written out one by one; larger groups go by distinct ids.
LISTED_LINKS = 1024
#: Pairs held by more than a share of 1 / FREQUENT_PAIRS of all (document, pair) rows are fewer than FREQUENT_PAIRS and are broadcast.
FREQUENT_PAIRS = 200_000

# A chunk ends where a visible character stands before a space or a line feed. The byte-level pattern never crosses a visible
# character followed by white space; of the pieces none holds a space after another character, nor a line feed.
_CHUNK = re.compile(rf"{_SPACE}*+{_INK}++(?:(?![ \n]){_SPACE}++{_INK}++)*+(?:(?![ \n]){_SPACE}++\Z)?+|{_SPACE}++")


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _byte_of() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary: itself if printable, else the next from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def _ends_visibly(chunk: str) -> bool:
    """Whether a space or line feed after the chunk starts a new one, as ``_INK`` has it."""
    return not chunk[-1].isspace() or chunk[-1] in "\x1c\x1d\x1e\x1f"


class TwoEncoders:
    """What chunks become under both tokenizers."""

    def __init__(self, byte_level: str, pieces: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        names, of = self.a.get_vocab(with_added_tokens=True), _byte_of()
        self.a_bytes = [b""] * (1 + max(names.values()))
        for token, i in names.items():
            self.a_bytes[i] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
        own = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(own)]
        if bad := [p for i, p in enumerate(own) if not self.b.is_byte(i) and ("▁" in p.lstrip("▁") or "\n" in p)]:
            raise ValueError(f"pieces that cross a chunk's border: {bad[:3]}")
        self.space = self.b.piece_to_id("▁")
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        self.width = max(len(self.a_bytes), len(self.b_bytes))

    def encode(self, chunks: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(chunks in another order, ids of A, how many are each chunk's, ids of B, how many are each chunk's).

        Chunks without ids are those whose joined token bytes differ from them. Short ones that end visibly are encoded
        many in one string, as neither tokenizer crosses their borders.
        """
        short, strings = [], []
        for c in chunks:
            if len(c) <= LONGEST_KEPT and _ends_visibly(c):
                short.append(c)
            else:
                strings.append([c])
        strings += [short[i : i + JOINED_CHUNKS] for i in range(0, len(short), JOINED_CHUNKS)]
        order, a, na, b, nb, at = [], [], [], [], [], 0
        while at < len(strings):
            group, size = [], 0
            while at < len(strings) and size < BATCH_BYTES:
                group.append(strings[at])
                size += 4 * sum(map(len, strings[at]))
                at += 1
            texts = ["".join(own) for own in group]
            first = self.a.encode_batch_fast(texts, add_special_tokens=False)
            second = self.b.encode([t[1:] if t[0] == " " else t for t in texts], num_threads=1)
            good = []
            for own, text, ea, ib in zip(group, texts, first, second):
                if text == " ":
                    ib = [self.space]  # the library gives nothing for an empty text
                elif text[0] != " ":
                    ib = ib[1:] if ib[:1] == [self.space] else None  # drop the space that the library put before
                raw, ia = text.encode(), ea.ids
                if ib is not None and b"".join(map(self.b_bytes.__getitem__, ib)) == raw and b"".join(map(self.a_bytes.__getitem__, ia)) == raw:
                    good.append((own, ia, ib))
                elif len(own) > 1:
                    strings += [[c] for c in own]  # to find the chunks that differ
                else:
                    order += own
                    na.append([0])
                    nb.append([0])
            if good:
                whole = list(chain.from_iterable([x[0] for x in good]))
                ends = np.cumsum([len(c) if c.isascii() else len(c.encode()) for c in whole])
                order += whole
                for k, ids, sizes, lens in ((1, a, na, self.a_len), (2, b, nb, self.b_len)):
                    ids.append(np.array(list(chain.from_iterable([x[k] for x in good])), np.int64))
                    sizes.append(np.diff(np.searchsorted(np.cumsum(lens[ids[-1]]), ends) + 1, prepend=0))
        none = [np.zeros(0, np.int64)]
        return order, np.concatenate(a or none), np.concatenate(na), np.concatenate(b or none), np.concatenate(nb)


_ENCODERS: dict[tuple[str, str], TwoEncoders] = {}


def encoders(byte_level: str, pieces: str) -> TwoEncoders:
    """One pair of encoders for each worker process."""
    if (byte_level, pieces) not in _ENCODERS:
        _ENCODERS[byte_level, pieces] = TwoEncoders(byte_level, pieces)
    return _ENCODERS[byte_level, pieces]


def coalesce(a_len: np.ndarray, b_len: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each A and of each B token; both cover the same bytes without gaps, ``*_len`` are their sizes.

    All intervals are sorted by start; a group breaks where a start reaches the running maximum of the ends.
    """
    lens = np.concatenate((a_len, b_len))
    ends = np.concatenate((np.cumsum(a_len), np.cumsum(b_len)))
    starts = ends - lens
    order = np.lexsort((ends, starts))
    reach = np.maximum.accumulate(ends[order])
    breaks = np.ones(len(order), np.int64)
    breaks[1:] = starts[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks) - 1
    return group[: len(a_len)], group[len(a_len) :]


def expand_links(a_ids: np.ndarray, b_ids: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, n_groups: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, pair code, occurrences) of the links: every A token of a group with every B token of it.

    A pair's code is A id * width + B id. Groups of many links are given by their distinct ids, with products of
    their counts, so memory grows with distinct pairs.
    """
    n_a, n_b = np.bincount(a_group, minlength=n_groups), np.bincount(b_group, minlength=n_groups)
    b_first = np.cumsum(n_b) - n_b
    large = n_a * n_b > LISTED_LINKS
    reps = np.where(large[a_group], 0, n_b[a_group])
    total = int(reps.sum())
    inner = np.arange(total) - np.repeat(np.cumsum(reps) - reps, reps)
    codes = np.repeat(a_ids.astype(np.int64) * width, reps) + b_ids[np.repeat(b_first[a_group], reps) + inner]
    groups, times = np.repeat(a_group, reps), np.ones(total, np.int64)
    for g in np.flatnonzero(large):
        a_first = int(np.searchsorted(a_group, g))
        ua, ca = np.unique(a_ids[a_first : a_first + n_a[g]], return_counts=True)
        ub, cb = np.unique(b_ids[b_first[g] : b_first[g] + n_b[g]], return_counts=True)
        codes = np.concatenate((codes, (ua.astype(np.int64)[:, None] * width + ub[None, :]).ravel()))
        times = np.concatenate((times, (ca[:, None] * cb[None, :]).ravel()))
        groups = np.concatenate((groups, np.full(len(ua) * len(ub), g)))
    return groups, codes, times


class _Columns:
    """Columns of integers that grow and shrink at the end."""

    def __init__(self, n_columns: int):
        self.data, self.size = np.zeros((n_columns, 1024), np.int64), 0

    def add(self, *columns: np.ndarray) -> None:
        end = self.size + len(columns[0])
        if end > self.data.shape[1]:
            self._resize(max(end, 2 * self.data.shape[1]))
        for own, new in zip(self.data, columns):
            own[self.size : end] = new
        self.size = end

    def cut(self, size: int) -> None:
        self.size = size
        if self.data.shape[1] > 4 * max(size, 1024):
            self._resize(2 * max(size, 1024))

    def _resize(self, width: int) -> None:
        data = np.zeros((len(self.data), width), np.int64)
        data[:, : self.size] = self.data[:, : self.size]
        self.data = data


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places first, first + 1, ... of ranges of ``size`` places, one range after another."""
    return np.repeat(first - np.cumsum(size) + size, size) + np.arange(int(size.sum()))


class _Groups:
    """The groups of chunks, by number: their ids as text, counts, and the codes and times of their links."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.texts: list[str] = []
        self.counts, self.links = _Columns(6), _Columns(2)  # n_a, n_b, n_groups, links, rows of links, first row; code, times

    def add(self, chunks: list[str], texts: list[str], counts: np.ndarray, codes: np.ndarray, times: np.ndarray) -> None:
        """Append chunks with the first five rows of their counts and the rows of their links, in order."""
        first = len(self.texts)
        self.number.update(zip(chunks, range(first, first + len(chunks))))
        self.texts += texts
        self.counts.add(*counts, self.links.size + np.cumsum(counts[4]) - counts[4])
        self.links.add(codes, times)

    def take(self, chunks: list[str]) -> tuple[list[str], list[str], np.ndarray, np.ndarray, np.ndarray]:
        """What ``add`` was given for these chunks."""
        numbers = [self.number[c] for c in chunks]
        counts = self.counts.data[:, numbers]
        codes, times = self.links.data[:, _ranges(counts[5], counts[4])]
        return chunks, [self.texts[i] for i in numbers], counts[:5], codes, times

    def forget(self, chunks: list[str], first: int) -> None:
        """Drop the last chunks, those from number ``first`` on."""
        for c in chunks:
            del self.number[c]
        self.links.cut(int(self.counts.data[5, first]))
        self.counts.cut(first)
        del self.texts[first:]


class _Text:
    """What is known of one text after the parts aligned so far."""

    def __init__(self) -> None:
        self.ok, self.n_a, self.n_b, self.n_groups, self.n_links = True, 0, 0, 0, 0
        self.hash, self.codes, self.times = hashlib.sha256(), [], []

    def row(self) -> tuple:
        """(n_a, n_b, n_groups, n_links, digest, pair codes, times); zeros and nothing without tokens."""
        if not self.ok or not self.n_a:
            return 0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64)
        codes, times = self.codes[0], self.times[0]
        if len(self.codes) > 1:
            codes, back = np.unique(np.concatenate(self.codes), return_inverse=True)
            times = np.bincount(back, weights=np.concatenate(self.times)).astype(np.int64)
        return self.n_a, self.n_b, self.n_groups, self.n_links, self.hash.hexdigest(), codes, times


class Aligner:
    """Aligns texts in parts of ALIGN_BYTES: short texts together, long ones over several parts.

    The groups of short chunks are kept in two generations of bounded size, so those in use survive when the older one goes.
    """

    def __init__(self, enc: TwoEncoders):
        self.enc = enc
        self.words = np.array([f"{i}{s}" for s in ",|;\n" for i in range(enc.width)], dtype=object)
        self.code_bits = (enc.width**2).bit_length()
        if self.code_bits + ALIGN_BYTES.bit_length() > 63:
            raise ValueError(f"vocabularies of {enc.width} ids: a text of a part and a pair must fit 63 bits")
        self.kept, self.older, self.held = _Groups(), _Groups(), 0

    def _learn(self, chunks: list[str]) -> tuple[list[str], list[str], np.ndarray, np.ndarray, np.ndarray]:
        """The groups of distinct chunks as ``_Groups.add`` takes them; chunks with other token bytes have no tokens."""
        width = self.enc.width
        chunks, a, na, b, nb = self.enc.encode(chunks)
        counts = np.zeros((5, len(chunks)), np.int64)
        if not len(a):
            return chunks, [""] * len(chunks), counts, np.zeros(0, np.int64), np.zeros(0, np.int64)
        ga, gb = coalesce(self.enc.a_len[a], self.enc.b_len[b])
        n_groups = int(ga[-1]) + 1
        of_group = np.empty(n_groups, np.int64)
        of_group[ga] = np.repeat(np.arange(len(chunks)), na)  # a chunk's end is a border of both, so no group has tokens of two
        # the string of ids in group order, A before B, each id followed by its sign; a chunk ends with a line feed
        place_a, place_b = np.arange(len(a)) + np.searchsorted(gb, ga, "left"), np.arange(len(b)) + np.searchsorted(ga, gb, "right")
        sign_a, sign_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        sign_a[np.append(ga[1:] != ga[:-1], True)] = 1
        sign_b[np.append(gb[1:] != gb[:-1], True)] = 2
        sign_b[np.cumsum(nb)[nb > 0] - 1] = 3
        words = np.empty(len(a) + len(b), dtype=object)
        words[place_a], words[place_b] = self.words[sign_a * width + a], self.words[sign_b * width + b]
        found = iter("".join(words.tolist()).split("\n"))
        texts = [next(found) if n else "" for n in na.tolist()]
        groups, codes, times = expand_links(a, b, ga, gb, n_groups, width)
        of_link = of_group[groups]
        if (of_link[1:] < of_link[:-1]).any():
            order = np.argsort(of_link, kind="stable")
            codes, times, of_link = codes[order], times[order], of_link[order]
        cuts = np.searchsorted(of_link, np.arange(len(chunks) + 1))
        total = np.concatenate(([0], np.cumsum(times)))
        counts[:] = na, nb, np.bincount(of_group, minlength=len(chunks)), np.diff(total[cuts]), np.diff(cuts)
        return chunks, texts, counts, codes, times

    def _flush(self, part: list[tuple[_Text, list[str]]]) -> None:
        if not part:
            return
        if self.held > CACHE_BYTES:
            self.kept, self.older, self.held = _Groups(), self.kept, 0
        kept, older = self.kept, self.older.number
        chunks = list(chain.from_iterable([own for _, own in part]))
        numbers = list(map(kept.number.get, chunks))
        unknown = [k for k, n in enumerate(numbers) if n is None] if None in numbers else []
        new = {chunks[k] for k in unknown}
        again = [c for c in new if c in older]
        long = [c for c in new if len(c) > LONGEST_KEPT]
        short = [c for c in new if len(c) <= LONGEST_KEPT and c not in older]
        first = len(kept.texts)
        if again:
            kept.add(*self.older.take(again))
        if short:
            kept.add(*self._learn(short))
        last = len(kept.texts)
        n_a, n_b = kept.counts.data[:2, first:last]
        self.held += (ENTRY_BYTES * (last - first)) + 2 * sum(map(len, again)) + 2 * sum(map(len, short)) + 4 * int(n_a.sum() + n_b.sum())
        if long:
            kept.add(*self._learn(long))

        for k in unknown:
            numbers[k] = kept.number[chunks[k]]
        texts, at = list(map(kept.texts.__getitem__, numbers)), np.array(numbers, np.int64)
        ends = np.cumsum([len(own) for _, own in part])
        cuts = np.concatenate(([0], ends))
        counts = kept.counts.data[:, at]
        n_a, n_b, n_groups, n_links = (np.diff(np.concatenate(([0], np.cumsum(n)))[cuts]).tolist() for n in counts[:4])
        without = np.diff(np.concatenate(([0], np.cumsum(counts[0] == 0)))[cuts]).tolist()
        # distinct chunks of each text, then its distinct pairs: sort by (text, code) and add up
        own, often = np.unique(np.repeat(np.arange(len(part)) << 32, np.diff(cuts)) | at, return_counts=True)
        size, start = kept.counts.data[4:, own & 0xFFFFFFFF]
        codes, times = kept.links.data[:, _ranges(start, size)]
        keys, times = np.repeat(own >> 32 << self.code_bits, size) | codes, times * np.repeat(often, size)
        order = np.argsort(keys)
        keys, times = keys[order], times[order]
        place = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        codes, times = keys[place] & (1 << self.code_bits) - 1, np.add.reduceat(times, place) if len(place) else times
        borders = np.searchsorted(keys[place], np.arange(len(part) + 1) << self.code_bits)
        for k, (t, _) in enumerate(part):
            t.ok = t.ok and not without[k]
            if not t.ok:
                continue
            t.hash.update(((";" if t.n_a else "") + ";".join(texts[cuts[k] : cuts[k + 1]])).encode())
            t.n_a, t.n_b, t.n_groups, t.n_links = t.n_a + n_a[k], t.n_b + n_b[k], t.n_groups + n_groups[k], t.n_links + n_links[k]
            t.codes.append(codes[borders[k] : borders[k + 1]])
            t.times.append(times[borders[k] : borders[k + 1]])
        if long:
            kept.forget(long, last)

    def rows(self, texts: Iterable[str]) -> Iterator[tuple]:
        """One row (see ``_Text.row``) for each text, in order."""
        waiting: list[_Text] = []
        part: list[tuple[_Text, list[str]]] = []
        size = 0
        for text in texts:
            t = _Text()
            waiting.append(t)
            if not text:
                continue
            for chunks, length in _parts(" " + text):
                part.append((t, chunks))
                size += length
                if size >= ALIGN_BYTES:
                    self._flush(part)
                    part, size = [], 0
                    for done in waiting[:-1]:
                        yield done.row()
                    waiting = waiting[-1:]
                    if not t.ok:
                        break
        self._flush(part)
        for t in waiting:
            yield t.row()


def _parts(text: str) -> Iterator[tuple[list[str], int]]:
    """The chunks of a text with their characters, in lists of at most ALIGN_BYTES characters or one chunk."""
    if len(text) <= ALIGN_BYTES:
        yield _CHUNK.findall(text), len(text)
        return
    out, size = [], 0
    for m in _CHUNK.finditer(text):
        out.append(m.group())
        size += len(out[-1])
        if size >= ALIGN_BYTES:
            yield out, size
            out, size = [], 0
    if out:
        yield out, size


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_level: str | None = None, pieces: str | None = None) -> DataFrame:
    """Align the tokens of every whole text: id, n_a, n_b, n_groups, n_links, groups_sha256, ``pairs`` (codes of the
    distinct linked id pairs, A id * width + B id) and ``times`` (their links).

    One row for each input row. Null and empty texts, and texts that either tokenizer does not give back byte by
    byte, have no tokens: zeros, '' and empty arrays. Repeated rows and null ids stay, other columns are ignored, an
    empty table gives an empty result. Texts of any length are aligned in parts, so a worker holds one
    part and the distinct pairs of one text.
    """
    tune(docs.sparkSession)
    a_path, b_path = byte_level or default_tokenizer(), pieces or default_pieces()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(encoders(a_path, b_path))
        for batch in batches:
            rows = list(aligner.rows(batch.column(1).to_pylist()))
            if not rows:
                continue
            counts = [pa.array([r[k] for r in rows], pa.int64()) for k in range(4)]
            offsets = pa.array(np.concatenate(([0], np.cumsum([len(r[5]) for r in rows]))).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([r[k] for r in rows]), pa.int64())) for k in (5, 6)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, pa.array([r[4] for r in rows], pa.string()), *lists], ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<bigint>"
    return docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text")).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """How many documents hold each linked pair: (pair, n)."""
    return aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))


def alignment(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_level: str | None = None, pieces: str | None = None) -> DataFrame:
    """``align`` with the corpus-wide view: ``n_best`` links whose pair count is the highest of their A id (ties
    included) and ``count_sum``, the sum of the counts over the links.

    Frequent pairs are broadcast, at most FREQUENT_PAIRS by their share, and so are one highest count per A id; the
    rows of all other pairs are shuffled to their counts, so no pair fills a task.
    """
    spark = docs.sparkSession
    width = encoders(byte_level or default_tokenizer(), pieces or default_pieces()).width
    keyed = align(docs, id_col, text_col, byte_level, pieces).withColumn("__row", F.monotonically_increasing_id())
    rows = materialize(keyed, "aligned")
    counts = materialize(pair_counts(rows), "pair-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    best = counts.groupBy(F.floor(F.col("pair") / width).alias("a")).agg(F.max("n").alias("best"))  # at most one row for each id of A
    judged = counts.withColumn("a", F.floor(F.col("pair") / width)).join(F.broadcast(best), "a").select("pair", "n", (F.col("n") == F.col("best")).alias("is_best"))
    bound = total // FREQUENT_PAIRS
    judged = materialize(judged.withColumn("frequent", F.col("n") > bound), "pair-judged")
    frequent, rare = judged.filter("frequent").drop("frequent"), judged.filter("not frequent").drop("frequent")

    links = rows.select("__row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("__row", "x.pairs", "x.times").withColumnRenamed("pairs", "pair")
    sums = [F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum")]
    near = links.join(F.broadcast(frequent), "pair", "left")
    common = near.filter("n is not null").groupBy("__row").agg(*sums)
    other = near.filter("n is null").select("pair", "__row", "times").join(rare, "pair").groupBy("__row").agg(*sums)
    found = common.unionByName(other).groupBy("__row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("long")
    return rows.drop("pairs", "times").join(found, "__row", "left").select(id_col, "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(spark.read.parquet(f"{sf_dir}/documents.parquet"))
