"""Token counts: batch encoding in Arrow functions that return lengths only."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from sys import getsizeof

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyflow.llm.common import mix64, string_buffers, text_of, tune

# White space as the tokenizer's pattern knows it. A cut between a visible character and white space
# never changes the tokens, nor does one between a letter and an ASCII sign: no part of the pattern
# crosses such a place. Letters here are those of old blocks, which every Unicode version agrees on.
_LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u0400-\u045f\u3042-\u3093\u30a2-\u30f3\u4e00-\u9fa5\uac00-\ud7a3"
_SIGN = "!-/:-@\\[-`{-~\u3001\u3002\uff0c\uff01\uff1f"
_SPACE, _INK = r"[^\S\x1c-\x1f]", r"[\S\x1c-\x1f]"
_CHUNK = re.compile(rf"{_SPACE}*(?:[{_LETTER}]++(?:(?=[{_SIGN}])|{_INK}*)|{_INK}+)|{_SPACE}+")
_JOINS = re.compile(rf"{_SPACE}+{_INK}")  # such a chunk may follow any that ends visibly
_CUT = re.compile(r"(?<=\S)(?=[ \t\n\r])|(?<=[\u3042-\u3093\u30a2-\u30f3\u4e00-\u9fa5])(?=[\u3001\u3002\uff0c\uff01\uff1f])")  # never inside a special string
PIECE_CHARS = 1 << 16
#: UTF-8 bytes given to the tokenizer at once, and in one of the strings among them.
BATCH_BYTES, STRING_BYTES = 1 << 18, 4096
#: Bytes that a generation of the cache takes in the worker: its objects, and ENTRY_BYTES of the table for each chunk; longer chunks are never kept.
CACHE_BYTES, ENTRY_BYTES, LONGEST_KEPT = 32 << 20, 72, 64


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_lengths(tok) -> np.ndarray:
    """Bytes of text that each id of a byte-level vocabulary stands for."""
    special = {i for i, t in tok.get_added_tokens_decoder().items()}
    out = np.zeros(tok.get_vocab_size(with_added_tokens=True), dtype=np.int64)
    for token, i in tok.get_vocab(with_added_tokens=True).items():
        out[i] = len(token.encode()) if i in special else len(token)
    return out


def safe_pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """Cut a long text at the first safe place after each ``size`` characters."""
    at = 0
    while len(text) - at > size and (m := _CUT.search(text, at + size)):
        yield text[at : m.start()]
        at = m.start()
    yield text[at:] if at else text


class ChunkEncoder:
    """Encodes byte-balanced batches of the chunks that it has not met yet and keeps what each became.

    ``ids=False`` keeps lengths only. Chunks of more than LONGEST_KEPT characters are encoded each time;
    the others are kept in two generations of CACHE_BYTES each, so a worker's memory is bounded whatever
    the corpus, and chunks in use survive when the older generation goes.
    """

    def __init__(self, path: str, ids: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok, self.ids = Tokenizer.from_file(path), ids
        self.seen, self.older, self.held = {}, {}, 0
        self.tok.no_truncation()
        self.tok.no_padding()
        self.bytes_of = _byte_lengths(self.tok)

    def learn(self, chunks: Iterable[str]) -> dict:
        """What each of the distinct ``chunks`` becomes."""
        strings, own, size = [], [], 0  # a string is some chunks with their lengths
        for c in chunks:
            n = len(c) if c.isascii() else len(c.encode())
            if not _JOINS.match(c) or n > STRING_BYTES:
                strings.append((n, [c], [n]))
                continue
            if not own or size >= STRING_BYTES:
                own, lengths, size = [], [], 0
                strings.append((0, own, lengths))
            own.append(c)
            lengths.append(n)
            size += n
        out, at = {}, 0
        while at < len(strings):
            group, total = [], 0
            while at < len(strings) and total < BATCH_BYTES:
                group.append(strings[at])
                total += strings[at][0] or STRING_BYTES
                at += 1
            for (_, own, lengths), enc in zip(group, self.tok.encode_batch_fast(["".join(x[1]) for x in group], add_special_tokens=False)):
                if len(own) == 1:
                    out[own[0]] = np.array(enc.ids, dtype="<u4").tobytes() if self.ids else len(enc)
                    continue
                ids = np.array(enc.ids, dtype="<u4")
                cuts = np.searchsorted(np.cumsum(self.bytes_of[ids]), np.cumsum(lengths)) + 1
                if self.ids:
                    raw, ends = ids.tobytes(), (cuts * 4).tolist()
                    out.update(zip(own, [raw[i:j] for i, j in zip([0, *ends], ends)]))
                else:
                    out.update(zip(own, np.diff(cuts, prepend=0).tolist()))
        return out

    def _values(self, text: str) -> Iterable:
        """What each chunk of the text becomes, in order."""
        found = _CHUNK.findall(text)
        if self.held > CACHE_BYTES:
            self.seen, self.older, self.held = {}, self.seen, 0
        seen, older = self.seen, self.older
        new = set(found).difference(seen)
        if not new:
            return map(seen.__getitem__, found)
        got = {c: older[c] for c in new if c in older} if older else {}
        got.update(self.learn(new.difference(got)))
        kept = got if max(map(len, got)) <= LONGEST_KEPT else {c: v for c, v in got.items() if len(c) <= LONGEST_KEPT}
        self.held += sum(map(getsizeof, kept)) + ENTRY_BYTES * len(kept)
        if self.ids:
            self.held += sum(map(getsizeof, kept.values()))
        seen.update(kept)
        if kept is got:
            return map(seen.__getitem__, found)
        return [seen[c] if c in seen else got[c] for c in found]

    def length(self, text: str) -> int:
        return sum(sum(self._values(p)) for p in safe_pieces(text))

    def encode(self, text: str) -> bytes:
        return b"".join(b"".join(self._values(p)) for p in safe_pieces(text))


#: Byte classes of the vectorised cuts: visible ASCII, its letters and signs, and control characters that no kept chunk holds.
_BYTE = np.arange(256)
_VISIBLE = (_BYTE > 32) & (_BYTE < 127)
_LETTERS = (_BYTE | 32 >= 97) & (_BYTE | 32 <= 122) & _VISIBLE
_SIGNS = _VISIBLE & ~_LETTERS & ~((_BYTE >= 48) & (_BYTE <= 57))
_BLANK = np.isin(_BYTE, [9, 10, 13, 32])
_CONTROL = ~_BLANK & (_BYTE < 32) | (_BYTE == 127)
_ACCENTED = (_BYTE >= 0x80) & (_BYTE < 0xC0) & (_BYTE != 0x97) & (_BYTE != 0xB7)  # after 0xC3: a letter
#: Bytes of text worked on at once; bytes of a key; slots of a generation's table, and how many of them may be taken; ids that a generation may hold.
SEGMENT_BYTES, KEY_BYTES, SLOTS, MOST_TAKEN, MOST_IDS = 1 << 18, 16, 1 << 20, 600_000, 3_000_000
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


class _Table:
    """Open addressing over exact keys of 16 bytes: where the ids of a chunk begin in ``ids``, and how many there are."""

    def __init__(self):
        self.keys, self.start, self.n = np.zeros((2, SLOTS), dtype=np.uint64), np.zeros(SLOTS, dtype=np.int32), np.zeros(SLOTS, dtype=np.uint8)
        self.ids, self.taken, self.used = np.zeros(1 << 16, dtype="<u4"), 0, 0

    @staticmethod
    def _home(keys: np.ndarray) -> np.ndarray:
        return (mix64(keys[0] ^ mix64(keys[1])) & np.uint64(SLOTS - 1)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, or -1."""
        out, left, at = np.full(keys.shape[1], -1, dtype=np.int64), np.arange(keys.shape[1]), self._home(keys)
        while len(left):
            hit = (self.keys[0][at] == keys[0][left]) & (self.keys[1][at] == keys[1][left])
            out[left[hit]] = at[hit]
            on = ~hit & (self.n[at] > 0)
            left, at = left[on], (at[on] + 1) & (SLOTS - 1)
        return out

    def add(self, keys: np.ndarray, ids: np.ndarray, n: np.ndarray) -> None:
        """Distinct keys that are not there yet, with their ids one after another."""
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(self.used + 2 * len(ids), dtype="<u4")])
        self.ids[self.used : self.used + len(ids)] = ids
        start = self.used + np.cumsum(n) - n
        self.used, self.taken = self.used + len(ids), self.taken + len(n)
        left, at = np.arange(len(n)), self._home(keys)
        while len(left):
            free = np.flatnonzero(self.n[at] == 0)
            first = free[np.unique(at[free], return_index=True)[1]]  # of several for one slot the first
            slot, own = at[first], left[first]
            self.keys[:, slot], self.start[slot], self.n[slot] = keys[:, own], start[own], n[own]
            on = np.ones(len(left), dtype=bool)
            on[first] = False
            left, at = left[on], (at[on] + 1) & (SLOTS - 1)


class ColumnEncoder(ChunkEncoder):
    """Encodes Arrow columns of texts: cuts, look-ups and ids of all chunks of a segment at once.

    Chunks of at most KEY_BYTES are their own keys, so nothing is taken for something else. Two
    generations of tables of fixed size hold what each became (some 30 bytes a chunk in use); other chunks and texts
    longer than a segment go the way of single texts.
    """

    def __init__(self, path: str):
        super().__init__(path, True)
        self.table, self.old = _Table(), None

    def column(self, col: pa.Array) -> Iterator[bytes]:
        """The ids of each text, little-endian and unsigned."""
        raw, offsets = string_buffers(col)
        i = 0
        while i < len(col):
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SEGMENT_BYTES, "right")) - 1)
            if offsets[j] - offsets[i] > SEGMENT_BYTES:
                yield self.encode(raw[offsets[i] : offsets[j]].tobytes().decode())
            else:
                yield from self._segment(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            i = j

    def _segment(self, raw: np.ndarray, offsets: np.ndarray) -> Iterator[bytes]:
        size = len(raw)
        padded = np.concatenate([raw, np.zeros(KEY_BYTES + 8, dtype=np.uint8)])
        accented = np.zeros(size + 1, dtype=bool)
        accented[1:size] = (raw[:-1] == 0xC3) & _ACCENTED[raw[1:]]
        letter = _LETTERS[raw] | accented[:size] | accented[1:]
        closed = _VISIBLE[raw] | accented[:size]  # ends a visible character
        border = np.zeros(size + 1, dtype=bool)
        border[offsets] = True
        first = border[:size].copy()
        first[1:] |= _BLANK[raw[1:]] & closed[:-1]
        begin = np.flatnonzero(first)
        # a chunk's first letters end at a sign
        ink, other = np.append(np.flatnonzero(~_BLANK[raw]), size), np.append(np.flatnonzero(~letter), size)
        from_ = ink[np.searchsorted(ink, begin)]
        to = other[np.searchsorted(other, from_)]
        cut = to[(to > from_) & (to < np.append(begin[1:], size))]
        first[cut[_SIGNS[raw[cut]]]] = True
        begin = np.flatnonzero(first)
        length = np.diff(begin, append=size)
        end = begin + length - 1
        controls = np.concatenate(([0], np.cumsum(_CONTROL[raw])))
        short = (length <= KEY_BYTES) & closed[end] & (controls[end + 1] == controls[begin]) if size else np.zeros(0, dtype=bool)
        words = np.ndarray(buffer=padded.data, dtype="<u8", shape=(size + KEY_BYTES,), strides=(1,))
        s, n = begin[short], length[short]
        keys = np.stack([words[s] & _KEEP[np.minimum(n, 8)], words[s + 8] & _KEEP[np.clip(n - 8, 0, 8)]])
        slot = self._slots(keys, lambda k: raw[s[k] : s[k] + n[k]].tobytes().decode())
        start, count = np.zeros(len(begin), dtype=np.int64), np.zeros(len(begin), dtype=np.int64)
        start[short], count[short] = self.table.start[slot], self.table.n[slot]
        pool, at = [self.table.ids[: self.table.used]], self.table.used
        for k in np.flatnonzero(~short).tolist():
            pool.append(np.frombuffer(self.encode(raw[begin[k] : end[k] + 1].tobytes().decode()), dtype="<u4"))
            start[k], count[k] = at, len(pool[-1])
            at += len(pool[-1])
        ends = np.concatenate(([0], np.cumsum(count)))
        ids = (np.concatenate(pool) if len(pool) > 1 else pool[0])[np.arange(ends[-1]) + np.repeat(start - ends[:-1], count)].tobytes()
        cuts = (ends[np.searchsorted(begin, offsets)] * 4).tolist()
        return (ids[a:b] for a, b in zip(cuts, cuts[1:]))

    def _slots(self, keys: np.ndarray, chunk) -> np.ndarray:
        """Slots in the newer table, where all keys are put that it lacks; ``chunk`` gives the text of a key."""
        if self.table.taken > MOST_TAKEN or self.table.used > MOST_IDS:
            self.table, self.old = _Table(), self.table
        slot = self.table.find(keys)
        lack = np.flatnonzero(slot < 0)
        if not len(lack):
            return slot
        lack = lack[np.lexsort(keys[:, lack])]
        new = np.ones(len(lack), dtype=bool)
        new[1:] = (keys[:, lack[1:]] != keys[:, lack[:-1]]).any(axis=0)
        once = lack[new]
        if self.old is not None:
            there = self.old.find(keys[:, once])
            known, there = once[there >= 0], there[there >= 0]
            n = self.old.n[there].astype(np.int64)
            ends = np.cumsum(n)
            ids = self.old.ids[np.arange(ends[-1] if len(n) else 0) + np.repeat(self.old.start[there] - ends + n, n)]
            self.table.add(keys[:, known], ids, n)
            once = np.setdiff1d(once, known, assume_unique=True)
        texts = [chunk(k) for k in once.tolist()]
        got = self.learn(texts)
        ids = [got[x] for x in texts]
        self.table.add(keys[:, once], np.frombuffer(b"".join(ids), dtype="<u4"), np.array([len(x) // 4 for x in ids], dtype=np.int64))
        slot[lack] = self.table.find(keys[:, lack])
        return slot


_ENCODERS: dict[tuple[str, bool], ChunkEncoder] = {}
_COLUMN_ENCODERS: dict[str, ColumnEncoder] = {}


def encoder(path: str, ids: bool) -> ChunkEncoder:
    """One encoder for each worker process."""
    if (path, ids) not in _ENCODERS:
        _ENCODERS[path, ids] = ChunkEncoder(path, ids)
    return _ENCODERS[path, ids]


def column_encoder(path: str) -> ColumnEncoder:
    """One for each worker process."""
    if path not in _COLUMN_ENCODERS:
        _COLUMN_ENCODERS[path] = ColumnEncoder(path)
    return _COLUMN_ENCODERS[path]


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, limit: int = 1024) -> DataFrame:
    """Count the tokens of each whole text.

    Returns one row for each input row: the id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit``
    (n_tokens > limit). Null and empty texts count 0. Repeated rows stay, other columns are
    ignored, an empty table gives an empty result. Texts of any length are cut at safe places,
    so a worker holds one piece at a time. Special strings of the tokenizer must begin with a sign and
    hold no white space.
    """
    tune(docs.sparkSession)
    path = tokenizer or default_tokenizer()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, False)
        for b in batches:
            n = [enc.length(x) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())], ["id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    text = text_of(docs, text_col)
    out = docs.select(docs[id_col].alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text")).mapInArrow(count, f"id {kind}, n_bytes bigint, n_tokens bigint")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
