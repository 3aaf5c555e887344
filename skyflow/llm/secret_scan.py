"""Secret scans: assignment-aware lexing of source and configuration text.

Every text is lexed for name-literal pairs (code, JSON, YAML, shell, XML, arguments, addresses with a password).
Values may be concatenations, interpolated strings or names; names are resolved to the literals that reach them, so
a literal is judged by every name it flows to. Three fixed patterns are reported besides.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyflow.llm.common import text_of, tune

#: Kinds in the order that ties of a start take; ``literal`` is what the lexing adds.
KINDS = ("assign", "access", "hex", "literal")

_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS, _HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]{24,}")  # a shorter run of hex digits holds no longer one
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the three fixed patterns, leftmost and without overlap within a kind."""
    out: list[Span] = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        out += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return out


# --- scores --------------------------------------------------------------------------

#: Weights of words in a name; what marks a value as a description of a secret, not the secret, is negative.
_NAME_WEIGHTS = {
    "password": 3.0, "passwd": 3.0, "passphrase": 3.0, "passcode": 3.0, "pwd": 3.0, "pw": 2.0, "pass": 2.0, "secret": 3.0, "secrets": 3.0, "token": 3.0, "apikey": 3.0, "credential": 2.5, "credentials": 2.5, "auth": 1.5,
    "authorization": 2.5, "bearer": 2.5, "authtoken": 3.0, "accesskey": 3.0, "secretkey": 3.0, "privatekey": 3.0, "key": 1.0, "api": 1.0, "access": 1.0, "private": 1.5, "encryption": 1.5, "signing": 1.5, "signature": 1.0,
    "client": 0.5, "salt": 1.5, "session": 1.0, "cookie": 1.0, "dsn": 1.0, "kennwort": 3.0, "passwort": 3.0, "contrasena": 3.0,
    "name": -3.0, "path": -3.0, "file": -3.0, "url": -2.5, "uri": -2.5, "field": -3.0, "label": -3.0, "hint": -3.0, "prompt": -3.0, "length": -3.0, "count": -3.0, "type": -3.0, "policy": -3.0, "regex": -3.0, "pattern": -3.0,
    "public": -3.0, "placeholder": -3.0, "example": -3.0, "message": -3.0, "error": -3.0, "header": -2.0, "id": -1.5, "ttl": -3.0, "expiry": -3.0, "expires": -3.0, "enabled": -3.0, "required": -3.0, "primary": -1.0, "foreign": -2.0,
}
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_PLACEHOLDER = re.compile(r"^(?:your|my|the|insert|enter|change|replace|example|sample|dummy|todo|none|null|undefined|true|false|redacted|placeholder|test)(?:[\W_].*|me|ed|this|it|here|\w{0,8}(?:password|secret|token|key)\w*)?$|^[<\[{(%$].*[>\]})%]$|^\W+$", re.ASCII | re.IGNORECASE | re.DOTALL)
_CODE = re.compile(r"^[A-Za-z_][\w.]*\(|^(?:https?|file|ftp)://|^[./~\\][\w./\\ -]*$|^[\w.-]+\.(?:py|js|json|ya?ml|txt|conf|ini|pem|key|log|md|html?)$", re.ASCII)
#: Names that a literal may pass on its way to the name that judges it.
HOPS = 16
#: Least sum of a name's and a literal's score.
LEAST = 4.0


def name_score(name: str) -> float:
    """How much a name asks for a secret: the sum of its words' weights, at most 4."""
    words = [w.lower() for w in _WORD.findall(name.rsplit(".", 1)[-1])]
    return min(sum(_NAME_WEIGHTS.get(w, 0.0) for w in words), 4.0)


def literal_score(value: str, quoted: bool) -> float:
    """How much a literal looks like a secret: length, kinds of characters and entropy, less for placeholders and code."""
    n = len(value)
    if n < 6 or _PLACEHOLDER.match(value) or _CODE.match(value) or len(set(value)) < 4:
        return -10.0
    counts = Counter(value)
    bits = -sum(c / n * math.log2(c / n) for c in counts.values())
    kinds = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", r"[^\sA-Za-z0-9]"))
    score = 0.5 * quoted + (n >= 8) * 0.5 + (n >= 16) * 0.5 + (kinds >= 2) * 1.0 + (kinds >= 3) * 0.5 + (bits >= 3.0) * 0.5
    words = len(value.split())
    return score - (words > 1) * 2.0 - (words > 6) * 3.0 - (kinds < 2 and not quoted) * 2.0


# --- lexing --------------------------------------------------------------------------


@dataclass
class Piece:
    """Part of a value: a literal with its span, or a name to resolve."""

    text: str
    start: int
    end: int
    name: bool = False


@dataclass
class Pair:
    """A name and the pieces of the value assigned to it."""

    name: str
    at: int
    pieces: list[Piece] = field(default_factory=list)
    quoted: bool = False


# Names begin where nothing of a name stands before, and quantifiers are possessive, so that lexing takes linear time.
_NAME = r"(?<![\w$])(?<![\w$][.\-])[A-Za-z_$@][\w$]*+(?:[.\-][A-Za-z_][\w$]*+)*+"
_HEAD = re.compile(
    rf"""(?P<q>["'`]?)(?P<name>{_NAME})(?P=q)\]?[ \t]*(?::[ \t]*[A-Za-z_][\w.\[\]<>?]*+[ \t]*+(?==[^=>]))?(?P<op>:=|=>|\?=|\+=|=(?![=~])|:(?![:/]))[ \t]*""", re.ASCII
)
_STRING = re.compile(r'''[rRbBfFuU@$L]{0,2}(?:"""(?P<a>(?:[^"\\]|\\.|"(?!""))*)"""|\'\'\'(?P<b>(?:[^'\\]|\\.|'(?!\'\'))*)\'\'\'|"(?P<c>(?:[^"\\\n]|\\.)*)"|'(?P<d>(?:[^'\\\n]|\\.)*)'|`(?P<e>(?:[^`\\]|\\.)*)`)''', re.ASCII | re.DOTALL)
_REFERENCE = re.compile(r"\$\{(?P<a>[A-Za-z_]\w*+)\}|\$?(?P<b>[A-Za-z_@][\w$]*+(?:\.[A-Za-z_][\w$]*+)*+)(?![\w(\[/:@])", re.ASCII)
_PLAIN = r"[^\s,;\"'`(){}\[\]<>|&=:]"
_BARE, _GOES_ON = re.compile(rf"{_PLAIN}++(?:[=:]{_PLAIN}++){{0,4}}={{0,2}}"), re.compile(r"[^\s,;\"'`(){}\[\]<>|&]")
_JOIN = re.compile(r"[ \t]*(?:\+(?!=)|\.\.?(?=[ \t]*[\"'$])|&(?!&))[ \t]*\n?[ \t]*|[ \t]+(?=[\"'])")
_INSIDE = re.compile(r"\$\{(\w+)\}|#\{(\w+)\}|%\((\w+)\)s|\{(\w+)\}|\$(\w+)", re.ASCII)
_ELEMENT = re.compile(rf"<(?P<name>{_NAME})>(?P<value>[^<>\n]{{6,}})</(?P=name)>", re.ASCII)
_ATTRIBUTES = re.compile(r"""\b(?:key|name)[ \t]*=[ \t]*["'](?P<name>[^"'\n]+)["'][ \t]+value[ \t]*=[ \t]*["'](?P<value>[^"'\n]+)["']""")
_FLAG = re.compile(rf"(?<!\S)--?(?P<name>{_NAME})[ \t]+(?P<value>[^\s\"'-][^\s\"']*)", re.ASCII)
_USERINFO = re.compile(r"://[^\s:/@\"']{1,256}:(?P<value>[^\s:/@\"']{1,256})@")
#: The lexer reads only texts that hold one of these; every weighted name that can reach LEAST has one.
_ROOTS = ("pass", "pwd", "pw", "secret", "token", "key", "cred", "auth", "bearer", "salt", "session", "cookie", "dsn", "contrasena", "kennwort", "://")
_PAIR_SIGNS = re.compile(r"[=:]|</|--?[A-Za-z]")


def _string_pieces(m: re.Match) -> list[Piece]:
    """The literal of a string, cut at the names interpolated into it."""
    group = next(g for g in "abcde" if m.group(g) is not None)
    start, body, out, at = m.start(group), m.group(group), [], 0
    for i in _INSIDE.finditer(body):
        if i.start() > at:
            out.append(Piece(body[at : i.start()], start + at, start + i.start()))
        out.append(Piece(next(g for g in i.groups() if g), start + i.start(), start + i.end(), True))
        at = i.end()
    if at < len(body):
        out.append(Piece(body[at:], start + at, start + len(body)))
    return out


def _expression(text: str, at: int) -> tuple[list[Piece], bool, int]:
    """The pieces of the value at ``at``, whether it has a quoted one, and where it ends."""
    pieces: list[Piece] = []
    quoted = False
    while True:
        if m := _STRING.match(text, at):
            pieces += _string_pieces(m)
            quoted = True
        elif (m := _REFERENCE.match(text, at)) and (pieces or not _GOES_ON.match(text, m.end())):
            pieces.append(Piece(m.group("a") or m.group("b"), m.start(), m.end(), True))
        elif not pieces and (m := _BARE.match(text, at)):
            return [Piece(m.group(), m.start(), m.end())], False, m.end()
        else:
            return pieces, quoted, at
        at = m.end()
        if not (j := _JOIN.match(text, at)):
            return pieces, quoted, at
        at = j.end()


def pairs_of(text: str) -> Iterator[Pair]:
    """Name-literal pairs of the text in order of their syntax, then of their place."""
    for m in _HEAD.finditer(text):
        pieces, quoted, _ = _expression(text, m.end())
        if pieces:
            yield Pair(m.group("name"), m.start(), pieces, quoted)
    for pattern, quoted in ((_ELEMENT, True), (_ATTRIBUTES, True), (_FLAG, False)):
        for m in pattern.finditer(text):
            yield Pair(m.group("name"), m.start(), [Piece(m.group("value"), m.start("value"), m.end("value"))], quoted)
    for m in _USERINFO.finditer(text):
        yield Pair("password", m.start(), [Piece(m.group("value"), m.start("value"), m.end("value"))], True)


class _Definitions:
    """What each name stood for at a place: its last assignment before it, or else its first."""

    def __init__(self, pairs: list[Pair]):
        self.by_name: dict[str, tuple[list[int], list[Pair]]] = {}
        for p in sorted(pairs, key=lambda p: p.at):
            where, own = self.by_name.setdefault(p.name.lstrip("$@"), ([], []))
            where.append(p.at)
            own.append(p)

    def at(self, name: str, place: int) -> Pair | None:
        where, own = self.by_name.get(name) or self.by_name.get(name.rsplit(".", 1)[-1]) or ((), ())
        if not where:
            return None
        k = bisect_right(where, place - 1) - 1
        return own[max(k, 0)]


def literals_reaching(pair: Pair, defined: _Definitions) -> list[tuple[Piece, bool]]:
    """The literals that a pair's value is made of, with names replaced by their own values, HOPS deep; cycles end."""
    out, level, seen = [], [pair], {id(pair)}
    for _ in range(HOPS + 1):
        deeper = []
        for p in level:
            for piece in p.pieces:
                if not piece.name:
                    out.append((piece, p.quoted))
                elif (source := defined.at(piece.text, p.at)) and id(source) not in seen:
                    seen.add(id(source))
                    deeper.append(source)
        level = deeper
    return sorted(out, key=lambda x: x[0].start)


def literal_spans(text: str) -> list[tuple[int, int]]:
    """Spans of the literals that a sensitive name receives and that look like secrets."""
    low = text.lower()
    if not any(r in low for r in _ROOTS) or not _PAIR_SIGNS.search(text):
        return []
    pairs = list(pairs_of(text))
    defined, found = _Definitions(pairs), set()
    for p in pairs:
        named = name_score(p.name)
        if named < LEAST - 3.5:  # no literal scores more
            continue
        parts = literals_reaching(p, defined)
        whole = "".join(x.text for x, _ in parts)
        quoted = any(q for _, q in parts)
        if parts and named + literal_score(whole, quoted) >= LEAST:
            found.update((x.start, x.end) for x, _ in parts if len(x.text) >= 4 or len(parts) == 1)
    return sorted(found)


def secret_spans(text: str) -> tuple[list[Span], list[Span]]:
    """(fixed patterns' spans, all spans), both by start and kind; a literal that meets a fixed span adds none."""
    rank = KINDS.index
    base = sorted(base_spans(text), key=lambda s: (s[0], rank(s[2])))
    taken, reach = [s[0] for s in base], []
    for s in base:
        reach.append(max(s[1], reach[-1] if reach else 0))

    def free(start: int, end: int) -> bool:
        k = bisect_right(taken, end - 1)
        return k == 0 or reach[k - 1] <= start

    added = [(a, b, "literal") for a, b in literal_spans(text) if free(a, b)]
    return base, sorted(base + added, key=lambda s: (s[0], rank(s[2])))


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Secrets of every whole text: counts of each kind and ``spans`` (kind:start:end in code points, end exclusive).

    One row for each input row; null and empty texts have none (counts 0, spans empty), repeated rows stay,
    null ids stay null, other columns are ignored and an empty table gives an empty result. A text is
    scanned whole by one task whose memory grows with its pairs; there is no shuffle. ``base_spans`` has the fixed
    patterns only; ``spans`` adds ``literal`` spans.
    """
    tune(docs.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [secret_spans(t) for t in b.column(1).to_pylist()]
            kinds = [Counter(s[2] for s in every) for _, every in rows]
            cols = [pa.array([k[name] for k in kinds], pa.int64()) for name in KINDS]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols, pa.array([_joined(x) for x, _ in rows], pa.string()), pa.array([_joined(x) for _, x in rows], pa.string())], ["id", *(f"n_{k}" for k in KINDS), "base_spans", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, " + ", ".join(f"n_{k} bigint" for k in KINDS) + ", base_spans string, spans string"
    out = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text")).mapInArrow(scan, schema)
    return out.withColumnRenamed("id", id_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "n_literal", F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans")
