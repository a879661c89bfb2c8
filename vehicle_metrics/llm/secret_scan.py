"""Secrets found by patterns and by assignment-aware lexing.

Base spans are the matches of three patterns. The method adds literals that
are assigned to sensitive names, whatever they look like:

* a lexer reads the lines that hold an assignment: strings with their quotes
  and escapes, names with dots and dashes, operators, brackets and bare values;
* a parser turns them into pairs of a name and a literal: ``name = "x"``,
  ``name: x``, ``name := x``, ``"name" => "x"``, ``config["name"] = x``, typed
  declarations (``name: str = "x"``), concatenations, and calls that wrap one
  literal;
* a value that is a name is looked up among the pairs of the same text, so
  constants are propagated to the names they reach, over any number of steps;
* a pair is scored by the words of its target's name and by how little its
  literal looks like a placeholder or a common word.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from vehicle_metrics.llm.common import add_columns

#: The base patterns, in the order their kinds are listed, with the group whose length counts and its least length.
KINDS = ("assign", "access", "hex")
BASE = (
    (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
    (re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    (re.compile(r"[0-9a-f]{32,}"), 0, 32),  # a run is taken whole, so shorter ones need not be matched and dropped
)
LITERAL = "literal"  # the kind of the method's spans; sorts after the base kinds
CUTOFF = 0.5

#: How much a word in a name says that its value is a secret.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.7, "secret": 1.0, "secrets": 1.0, "token": 0.9,
    "apikey": 1.0, "accesskey": 1.0, "secretkey": 1.0, "privatekey": 1.0, "signingkey": 1.0, "encryptionkey": 1.0, "credential": 0.9,
    "credentials": 0.9, "auth": 0.6, "authorization": 0.7, "bearer": 0.8, "jwt": 0.8, "pin": 0.5, "salt": 0.6, "dsn": 0.6, "key": 0.4,
}
#: Words that turn a sensitive name into a harmless one when they come last.
HARMLESS = {"id", "name", "names", "file", "path", "url", "uri", "type", "field", "label", "length", "len", "size", "count", "policy",
            "hint", "limit", "limits", "expiry", "ttl", "timeout", "header", "prefix", "suffix", "env", "column", "regex"}
PLACEHOLDER = re.compile(r"(?i)example|sample|placeholder|change_?me|your|dummy|redacted|todo|fixme|undefined|null|none|true|false|\*{3}|x{4}|\.{3}")

#: Every sensitive word holds one of these; a text without them has no sensitive name.
_STEMS = ("pass", "pwd", "secret", "token", "key", "cred", "auth", "bearer", "jwt", "pin", "salt", "dsn")
#: What a text must hold for a base pattern to match: a lower-cased part, a part, a run of hex digits.
_ASSIGNED = ("passw", "secret", "token", "apikey", "api_key")
_HEX_RUN = (bytes(c in b"0123456789abcdef" for c in range(256)), b"\x01" * 32)

_STRING = re.compile(r"""(?<!\w)[bBrRuUfF]{0,2}(?:"{3}[\s\S]*?"{3}|'{3}[\s\S]*?'{3}|"(?:\\.|[^"\\\n])*"|'(?:\\.|[^'\\\n])*'|`(?:\\.|[^`\\\n])*`)""")
_TOKEN = re.compile(rf"""
    (?P<string>{_STRING.pattern.replace("#", "[#]")})
  | (?P<name>[^\W\d]\w*(?:(?:\.|->|::|-)\w+)*)
  | (?P<assign>:=|=>|={{1,3}}|!=|<=|>=|:(?!:))
  | (?P<close>\])
""", re.X)
_COMPARES = {"==", "===", "!=", "<=", ">="}
_TYPED = re.compile(r"\x20*[A-Za-z_][\w.]*(?:\[[\w.,\x20]*\])?\x20*=(?![=>])")
_GAP = re.compile(r"[\x20\t]*(?:\\?\n[\x20\t]*(?=[\"'`+]))?(?:\([\s]*(?=[\"'`]))?")
_JOIN = re.compile(r"\s*\+\s*|\s*(?=[\"'`])")
_BARE = re.compile(r"[^\s\"'`,;(){}\[\]<>]+")
_GOES_ON = re.compile(r"\n[\x20\t]*[\"'`+]")
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


@dataclass(frozen=True)
class Word:
    """A value without quotes: a name, or a bare literal where it is none."""
    text: str
    start: int
    end: int


@dataclass(frozen=True)
class Pair:
    """A name and what is assigned to it, in pieces that are joined: spans of
    literal text, or words."""
    name: str
    parts: tuple


def _regions(text: str) -> Iterator[tuple[int, int]]:
    """The lines with an assignment, each with the lines that go on with a
    string or a plus. A line is looked at once, whatever its length."""
    done = 0
    for m in re.finditer("[:=]", text):
        if m.start() < done:
            continue
        start, end = text.rfind("\n", done, m.start()) + 1 or done, text.find("\n", m.end())
        while end >= 0 and _GOES_ON.match(text, end):
            end = text.find("\n", end + 1)
        done = len(text) if end < 0 else end
        yield start, done


def _inside(text: str, a: int, b: int) -> tuple[int, int]:
    """The span of a string without its prefix and quotes."""
    while text[a] not in "\"'`":
        a += 1
    width = 3 if b - a >= 6 and text[a:a + 3] in ('"""', "'''") else 1
    return a + width, b - width


def _target(text: str, tokens: list[tuple[str, int, int]], i: int) -> str | None:
    """The name that the operator at token ``i`` assigns to."""
    kind, a, b = tokens[i - 1] if i else ("", 0, 0)
    if kind == "close" and i >= 2:  # config["name"]
        kind, a, b = tokens[i - 2]
    if kind == "string":
        a, b = _inside(text, a, b)
        return text[a:b] if re.fullmatch(r"[\w.$ -]{1,80}", text[a:b]) else None
    return text[a:b] if kind == "name" else None


def _value(text: str, at: int, end: int) -> tuple[tuple, int]:
    """(parts of the value that starts at ``at``, where it ends)."""
    parts: list = []
    at = _GAP.match(text, at, end).end()
    while True:
        if m := _STRING.match(text, at, end):
            parts.append(_inside(text, *m.span()))
            at = m.end()
        elif m := _BARE.match(text, at, end):
            at = m.end()
            if text[at:at + 1] != "(":
                parts.append(Word(m.group().rstrip(".:"), m.start(), m.start() + len(m.group().rstrip(".:"))))
            else:  # a call: the literal it wraps, if there is just one
                close = text.find(")", at, end)
                close = end if close < 0 else close
                wrapped = [_inside(text, *s.span()) for s in _STRING.finditer(text, at, close)]
                if len(wrapped) != 1:
                    return (), close
                parts.append(wrapped[0])
                at = min(end, close + 1)
        else:
            return (), at
        m = _JOIN.match(text, at, end)
        if not m or not (_STRING.match(text, m.end(), end) or "+" in m.group()):
            return tuple(parts), at
        at = m.end()


def pairs(text: str) -> Iterator[Pair]:
    """Assignments of a text, in order."""
    for start, end in _regions(text):
        tokens = [(m.lastgroup, m.start(), m.end()) for m in _TOKEN.finditer(text, start, end)]
        upto = start
        for i, (kind, a, b) in enumerate(tokens):
            if kind != "assign" or a < upto or text[a:b] in _COMPARES:
                continue
            name = _target(text, tokens, i)
            typed = _TYPED.match(text, b, end) if text[a:b] == ":" else None
            parts, stop = _value(text, typed.end() if typed else b, end)
            if name and parts:
                upto = stop
                yield Pair(name, parts)


def propagate(found: list[Pair]) -> list[tuple[str, tuple]]:
    """(target, spans) for every pair whose value is literal text once words
    that name a constant are replaced by it. A name's constant is the first
    value that is settled for it; a word that is no target of the text is a
    literal if it holds a digit or changes case, and no value otherwise. A pair
    is looked at again only when a name that it waits for is settled."""
    names = {p.name for p in found}
    constants: dict[str, tuple] = {}
    waiting: dict[str, list[int]] = {}
    settled: dict[int, tuple] = {}
    ready = deque(range(len(found)))
    while ready:
        i = ready.popleft()
        spans, p = [], found[i]
        for part in p.parts:
            if not isinstance(part, Word):
                spans.append(part)
            elif part.text in constants and part.text != p.name:
                spans += constants[part.text]
            elif part.text in names:
                waiting.setdefault(part.text, []).append(i)
                break
            elif re.search(r"\d|[a-z][A-Z]", part.text) and "$" not in part.text:
                spans.append((part.start, part.end))
            else:
                break
        else:
            if 0 < len(spans) <= 64:
                settled[i] = tuple(spans)
                if p.name not in constants:
                    constants[p.name] = settled[i]
                    ready.extend(waiting.pop(p.name, ()))
    return [(p.name, settled[i]) for i, p in enumerate(found) if i in settled]


def name_weight(name: str) -> float:
    """How sensitive a target's name is, 0 to 1."""
    words = [w.lower() for w in _WORDS.findall(name)]
    if not words or words[-1] in HARMLESS:
        return 0.0
    joined = [a + b for a, b in zip(words, words[1:])]
    return max(SENSITIVE.get(w, 0.0) for w in [*words, *joined])


def strength(value: str) -> float:
    """How much a literal looks like a secret, 0 to 1: its length and the
    spread of its characters, nothing for a placeholder, a reference or prose."""
    n = len(value)
    if n < 6 or n > 4096 or PLACEHOLDER.search(value) or value.startswith(("$", "{", "<", "%", "http:", "https:", "/", "./")):
        return 0.0
    if any(c.isspace() for c in value):
        return 0.0
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    kinds = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", r"[^A-Za-z0-9]"))
    return min(1.0, entropy / 4) * min(1.0, n / 12) * (0.5 + 0.25 * min(2, kinds - 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of the base patterns' matches. A
    pattern is tried only where a plain search finds what it needs."""
    low, (is_hex, run) = text.lower(), _HEX_RUN
    needed = (any(x in low for x in _ASSIGNED), "AKIA" in text, run in text.encode("utf-8", "replace").translate(is_hex))
    out = []
    for k, (pattern, group, least) in enumerate(BASE):
        if needed[k]:
            out += [(m.start(), k, m.end()) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return sorted(out)


def literal_spans(text: str, cutoff: float = CUTOFF) -> list[tuple[int, int, str, float]]:
    """(start, end, target, score) of literals assigned to sensitive names,
    each span once, under the target that scores highest."""
    low = text.lower()
    if not any(stem in low for stem in _STEMS) or not (":" in text or "=" in text):
        return []
    best: dict[tuple[int, int], tuple[float, str]] = {}
    for name, spans in propagate(list(pairs(text))):
        weight = name_weight(name)
        looks = strength("".join(text[a:b] for a, b in spans)) if weight else 0.0
        score = weight * (0.3 + 0.7 * looks)
        if looks and score >= cutoff:
            for span in spans:
                if span[0] < span[1]:
                    best[span] = max(best.get(span, (0.0, "")), (score, name))
    return [(a, b, name, score) for (a, b), (score, name) in sorted(best.items())]


def scan(text: str, cutoff: float = CUTOFF) -> list[tuple[str, int, int, str | None, float]]:
    """(kind, start, end, target, score) of every span by start, kind as
    listed, end. A literal that lies within a base span adds nothing."""
    base = base_spans(text)
    found = [(a, k, b, None, 1.0) for a, k, b in base]
    for a, b, name, score in literal_spans(text, cutoff):
        if not any(x <= a and b <= y for x, _, y in base):
            found.append((a, len(KINDS), b, name, score))
    found.sort(key=lambda s: s[:3])
    return [((*KINDS, LITERAL)[k], a, b, name, score) for a, k, b, name, score in found]


FOUND = "array<struct<kind: string, start: bigint, end: bigint, target: string, score: double>>"


def find_secrets(docs: DataFrame, text_col: str = "text", out_col: str = "secrets", cutoff: float = CUTOFF) -> DataFrame:
    """Every row with the array ``out_col`` of its spans (kind, start, end,
    target, score), positions in code points, end exclusive.

    A NULL or empty text has none. Other columns, repeated rows and NULL ids
    pass through; a column named ``out_col`` must not be there. Texts are read
    whole, one at a time."""
    types = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("target", pa.string()),
                                ("score", pa.float64())]))

    def compute():
        names = [f.name for f in types.value_type]
        return lambda texts: [pa.array([[dict(zip(names, s)) for s in scan(t.decode("utf-8", "replace"), cutoff)] for t in texts], types)]

    from pyspark.sql.types import _parse_datatype_string

    return add_columns(docs, text_col, StructType([StructField(out_col, _parse_datatype_string(FOUND))]), compute)


def digest(spans: list[str]) -> str:
    return hashlib.sha256(",".join(spans).encode()).hexdigest()


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cutoff: float = CUTOFF) -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans) for every row: the
    base spans' counts and digest, and all spans as kind:start:end."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("body"))
    found = find_secrets(rows, "body", "found", cutoff)
    line = "concat(s.kind, ':', s.start, ':', s.end)"
    counts = [f"CAST(size(filter(found, s -> s.kind = '{k}')) AS BIGINT) AS n_{k}" for k in KINDS]
    return found.selectExpr(
        f"id AS `{id_col}`", *counts,
        f"sha2(array_join(transform(filter(found, s -> s.kind <> '{LITERAL}'), s -> {line}), ','), 256) AS base_sha256",
        f"array_join(transform(found, s -> {line}), ',') AS spans")
