"""Secret scans by assignment-aware lexing (op 12).

Three fixed patterns give the base spans.  Beside them, source and configuration
syntax is parsed into pairs of a target name and a literal: assignments and
typed declarations, dictionary, JSON, YAML, ini and shell entries, keyword and
name-value arguments, subscripts, setters, command-line options, XML elements,
query strings and connection strings.  Constants are propagated: a name stands
for the literals last assigned to it (or, if there is none yet, first assigned
later), also through concatenation and ``${name}`` in a literal, so a literal has
all the target names that it reaches.  A literal is a secret if the most
sensitive of its names times how random its folded value looks is at least
``THRESHOLD``; its span has kind ``named``.  A span that a base span covers is
not repeated.

Each text is handled by itself inside the scan, so nothing is shuffled.  Lines
without a sign of assignment are not lexed; the others are lexed in one pass.

Defined results: a null text is empty; empty texts have no spans; texts are read
whole, and positions count code points; repeated rows give repeated rows; an
empty table gives an empty result; other columns are ignored, whatever their
names.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.llm.streams import batches_of, rows_of

# The base patterns and their order.
BASE = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                         re.ASCII | re.IGNORECASE),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]{16,}"),  # the runs of at least 16
}
NAMED = "named"
KINDS = (*BASE, NAMED)
THRESHOLD = 0.5

# How much a word of a name points to a secret, and last words that point elsewhere.
SENSITIVE = {"password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "passcode": 0.9, "pass": 0.8, "pw": 0.7,
             "secret": 1.0, "token": 0.9, "apikey": 1.0, "accesskey": 1.0, "credential": 0.9, "credentials": 0.9,
             "jwt": 0.9, "bearer": 0.8, "authorization": 0.9, "auth": 0.6, "key": 0.5, "private": 0.5, "api": 0.4,
             "access": 0.4, "signing": 0.5, "encryption": 0.5, "client": 0.2, "session": 0.4, "cookie": 0.5,
             "salt": 0.5, "pepper": 0.4, "pin": 0.4, "otp": 0.6, "pat": 0.5, "webhook": 0.4, "sas": 0.5}
ELSEWHERE = {"id", "ids", "name", "names", "url", "uri", "path", "file", "dir", "count", "length", "len", "size", "limit",
             "type", "kind", "field", "label", "hint", "placeholder", "prompt", "regex", "pattern", "policy", "expiry",
             "ttl", "timeout", "max", "min", "number", "column", "header", "format", "help", "error", "message"}
PLACEHOLDER = re.compile(r"(?i)x{4,}|\*+|\.{3,}|<.*>|\$\{.*\}|\{\{.*\}\}|%\(?\w*\)?s|(change|replace)[-_ ]?(me|this|it).*|"
                         r"your[-_ ].*|(some|my|the|dummy|fake|example|sample|test)[-_ ]?(password|secret|token|key).*|"
                         r"example.*|todo.*|none|null|nil|undefined|true|false|redacted|placeholder|required")


TARGETS = ("password", "passwd", "secret", "token", "api")  # one is in every ``assign``


def base_spans(text: str) -> list[tuple[str, int, int]]:
    low, out = text.lower(), []
    if any(t in low for t in TARGETS):
        out += [("assign", m.start(), m.end()) for m in BASE["assign"].finditer(text) if m.end(2) - m.start(2) >= 12]
    out += [("access", m.start(), m.end()) for m in BASE["access"].finditer(text) if m.end() - m.start() >= 18]
    return out + [("hex", m.start(), m.end()) for m in BASE["hex"].finditer(text)]


# ---- lexing into name-literal pairs ------------------------------------------------

SIGN = re.compile(r"[=:<(]|--")
NAME = r"[^\W\d][\w$]*(?:(?:[.-]|::|->)[^\W\d][\w$]*)*"
TOKEN = re.compile(rf"""
    (?P<str>(?:\b[rbufRBUF]{{1,2}}(?=["']))?(?:\"\"\"(?:[^\\]|\\.)*?\"\"\"|'''(?:[^\\]|\\.)*?'''
       |"(?:[^"\\\n]|\\.)*"|(?<!\w)'(?:[^'\\\n]|\\.)*'|(?<=[rbufRBUF])'(?:[^'\\\n]|\\.)*'|`[^`\n]*`))
  | (?P<option>(?<![\w-])--[A-Za-z][\w-]*)
  | (?P<element><(?P<tag>[A-Za-z][\w.-]*)>(?P<inside>[^<>\n]+)</(?P=tag)>)
  | (?P<name>\$?{NAME})
  | (?P<compare>[=!<>]==?)
  | (?P<assign>:=|=>|[+]?=|:)
  | (?P<mark>[^\s\w])
  | (?P<other>\w+)
""", re.VERBOSE | re.DOTALL)
SPACE = re.compile(r"[^\S\n]*")
WHITE = re.compile(r"\s*")
OPEN = re.compile(r"""[^\S\n]*\(\s*(?=[rbufRBUF]{0,2}["'])""")
BARE = re.compile(r"""[^\s"'`,;&(){}\[\]<>]+""")
JOIN = re.compile(r"""\s*(?:\+|\.{1,2}(?=\s*["']))\s*|[^\S\n]*\\\n\s*""")
TYPE = re.compile(r"""[^\S\n]*[&*?\w.\[\]<>|]{1,80}(?:[^\S\n]+=(?!=)|=(?=["']))""")  # the rest of `name: Type =`
INNER = re.compile(r"([\w.-]{1,64})[^\S\n]*=[^\S\n]*([^;&\s\"'#]+)")
TEMPLATE = re.compile(r"\$?\{([^\W\d]\w*)\}|\$([^\W\d]\w*)")
SCHEME = re.compile(r"(?i)(?:bearer|basic|token)\s+")
NAMELIKE = re.compile(r"[\w$./ -]{1,80}")
SETTER = re.compile(r"(?:.*[.>:])?(?:set|with)_?([A-Z_]\w*)")

Part = tuple[int, int, str, bool]  # start, end, name or value, whether quoted


def _content(m: re.Match) -> tuple[int, int]:
    """Where the characters of a string token lie."""
    raw = m.group("str")
    body = raw.lstrip("rbufRBUF") if raw[0] not in "\"'`" else raw
    quotes = 3 if body[:3] in ('"""', "'''") and len(body) >= 6 else 1
    return m.end() - len(body) + quotes, m.end() - quotes


def _value(text: str, at: int) -> tuple[list[Part], int]:
    """The parts of the expression at ``at`` and where it ends."""
    parts: list[Part] = []
    opened = OPEN.match(text, at)  # ("one literal" "over lines")
    at = opened.end() if opened else at
    gap = WHITE if opened else SPACE
    while True:
        at = SPACE.match(text, at).end()
        m = TOKEN.match(text, at)
        if m and m.lastgroup == "str":
            start, end = _content(m)
            parts.append((start, end, text[start:end], True))
            at = m.end()
            after = gap.match(text, at).end()
            following = TOKEN.match(text, after)
            if following and following.lastgroup == "str":  # neighbouring strings are one literal
                at = after
                continue
        elif m and m.lastgroup == "name" and text[m.end():m.end() + 1] == "(":
            at = m.end() + 1  # a call: its string arguments
            while (m := TOKEN.match(text, SPACE.match(text, at).end())) and m.lastgroup in ("str", "name"):
                if m.lastgroup == "str":
                    start, end = _content(m)
                    parts.append((start, end, text[start:end], True))
                at = m.end()
                comma = SPACE.match(text, at).end()
                if text[comma:comma + 1] not in (",", ")"):
                    break
                at = comma + 1
        elif bare := BARE.match(text, at):
            value = bare.group().rstrip(".!?") if not bare.group().startswith("$") else bare.group()
            parts.append((at, at + len(value), value, False))
            at = bare.end()
        joined = JOIN.match(text, at)
        if not parts or not joined:
            return parts, at
        at = joined.end()


def pairs(text: str) -> Iterator[tuple[str, list[Part]]]:
    """(target name, literal or name parts) of the text's assignments, in order."""
    at = done = 0
    while sign := SIGN.search(text, at):
        at = max(text.rfind("\n", done, sign.start()) + 1, done)
        line_end = text.find("\n", sign.start())
        line_end = len(text) if line_end < 0 else line_end
        target, call, first = None, None, None  # name before the sign; name before `(`; first string of a call
        while at < line_end:
            at = SPACE.match(text, at).end()
            m = TOKEN.match(text, at)
            if not m:
                at += 1
                continue
            kind, token, at = m.lastgroup, m.group(), m.end()
            if kind == "str":
                start, end = _content(m)
                value = text[start:end]
                if first and text[start - 1:end + 1].strip():  # f("name", "literal")
                    yield first, [(start, end, value, True)]
                elif call and SETTER.fullmatch(call):  # setName("literal")
                    yield SETTER.fullmatch(call)[1], [(start, end, value, True)]
                target = value if NAMELIKE.fullmatch(value) else None
                first, call = None, call
                if call and target and text[at:at + 1] == ",":
                    first, at = target, at + 1
                yield from _inner(start, end, value)
            elif kind == "name":
                target, first = token, None
                call = token if text[at:at + 1] == "(" else None
                if call:
                    at += 1
            elif kind == "option":
                value, after = _value(text, at + 1) if text[at:at + 1] in (" ", "=") else ([], at)
                if value and not value[0][2].startswith("-"):
                    yield token[2:], value
                    at = after
                target = call = first = None
            elif m["element"]:
                yield m["tag"], [(*m.span("inside"), m["inside"], True)]
                target = None
            elif kind == "assign" and target:
                if token == ":" and (typed := TYPE.match(text, at)) and typed.end() <= line_end:
                    at = typed.end()
                parts, after = _value(text, at)
                for start, end, value, _ in parts:
                    yield from _inner(start, end, value)
                if parts:
                    yield target, parts
                at = max(after, at)
                target = call = first = None
            elif token not in ("]", "$"):
                target = first = None
                call = call if token == "," else None
        at = done = max(at, line_end)


def _inner(start: int, end: int, value: str) -> Iterator[tuple[str, list[Part]]]:
    """Pairs inside a literal: query strings and connection strings."""
    if "=" in value:
        for m in INNER.finditer(value):
            yield m[1], [(start + m.start(2), start + m.end(2), m[2], True)]


# ---- constants ----------------------------------------------------------------------

def literals(text: str) -> Iterator[tuple[tuple[tuple[int, int], ...], str, set[str], bool]]:
    """(spans, folded value, target names, whether quoted) of the text's literals
    after constants are propagated."""
    held: list[list] = []       # literal: spans, value, names, quoted
    now: dict[str, int] = {}    # name -> its literal
    first: dict[str, int] = {}
    later: list[tuple[str, str]] = []  # target, name without a value yet
    for target, parts in pairs(text):
        if len(parts) == 1 and not parts[0][3]:
            start, end, name, _ = parts[0]
            known = now.get(name.lstrip("$").strip("{}"))
            if known is not None:
                held[known][2].add(target)
                now[target] = known
                continue
            if re.fullmatch(rf"\$?{NAME}", name):
                later.append((target, name.lstrip("$")))
        spans, value, quoted = [], [], False
        for start, end, piece, is_string in parts:
            known = None if is_string else now.get(piece.lstrip("$"))
            if known is not None:  # a constant inside a concatenation
                held[known][2].add(target)
                spans += held[known][0]
                value.append(held[known][1])
                continue
            for m in TEMPLATE.finditer(piece):
                inside = now.get(m[1] or m[2])
                if inside is not None:
                    held[inside][2].add(target)
            spans.append((start, end))
            value.append(piece)
            quoted |= is_string
        now[target] = len(held)
        first.setdefault(target, len(held))
        held.append([tuple(spans), "".join(value), {target}, quoted])
    for target, name in later:
        if name in first and name != target:
            held[first[name]][2].add(target)
    for spans, value, names, quoted in held:
        yield spans, value, names, quoted


# ---- scores -------------------------------------------------------------------------

WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


def name_score(name: str) -> float:
    """0 to 1: how far a target name points to a secret."""
    words = [w.lower() for w in WORD.findall(name)]
    words = [w for w in words if not w.isdigit()]
    if not words:
        return 0.0
    score = 1 - math.prod(1 - SENSITIVE.get(w, 0.0) for w in words)
    if words[-1] in ELSEWHERE:
        score *= 0.3
    return score * (0.2 if "public" in words or "example" in words else 1.0)


def literal_score(value: str, quoted: bool) -> float:
    """0 to 1: how far a literal looks random and not like words or a stand-in."""
    if len(value) < 6 or PLACEHOLDER.fullmatch(value) or "://" in value:
        return 0.0
    counts = Counter(value)
    bits = -sum(n * math.log2(n / len(value)) for n in counts.values())
    score = min(1.0, bits / 30)
    if (" " in value or "\t" in value) and "-----BEGIN" not in value:
        score *= 0.3
    if value.isdigit():
        score *= 0.5
    elif not any(c.isdigit() for c in value):
        if not quoted or re.fullmatch(r"[A-Z]+(_[A-Z]+)+|[a-z]+([._-][a-z]+)+|[A-Za-z]+(\.\w+)+", value):
            score *= 0.3  # words of prose, names of constants and settings
        elif value.isalpha() and (value.islower() or value.istitle()):
            score *= 0.7
    return score


def named_spans(text: str) -> Iterator[tuple[int, int, str, float]]:
    """(start, end, name, score) of the literals that are secrets."""
    for spans, value, names, quoted in literals(text):
        scheme = SCHEME.match(value)
        skip = scheme.end() if scheme else 0
        name = max(sorted(names), key=name_score)
        score = name_score(name) * literal_score(value[skip:], quoted)
        if score >= THRESHOLD:
            for k, (start, end) in enumerate(spans):
                yield start + (skip if k == 0 and end - start > skip else 0), end, name, score


def secret_spans(text: str) -> list[tuple[str, int, int, str | None, float]]:
    """(kind, start, end, name, score) by start, then kind as listed."""
    base = base_spans(text)
    out = {(k, s, e): (None, 1.0) for k, s, e in base}
    if SIGN.search(text):
        cover = sorted((s, e) for _, s, e in base)
        starts, ends = [s for s, _ in cover], list(accumulate((e for _, e in cover), max))
        for start, end, name, score in named_spans(text):
            at = (NAMED, start, end)
            if start < end and not _covered(starts, ends, start, end) and score > out.get(at, (None, 0.0))[1]:
                out[at] = name, score
    found = [(*span, *why) for span, why in out.items()]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def _covered(starts: list[int], ends: list[int], start: int, end: int) -> bool:
    """Whether one interval holds start..end; ``ends`` are the greatest so far."""
    at = bisect_right(starts, start)
    return at > 0 and ends[at - 1] >= end


# ---- on Spark -------------------------------------------------------------------------

def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, kind, start, end, name (of ``named`` ones), score and value, a row
    per span."""
    def run(key: pa.DataType, batches):
        rows = ((doc, kind, start, end, name, score, (text or "")[start:end]) for doc, text in rows_of(batches)
                for kind, start, end, name, score in secret_spans(text or ""))
        yield from batches_of(rows, ["doc_id", "kind", "start", "end", "name", "score", "value"],
                              [key, pa.string(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.string()], text=6)
    return _mapped(docs, run, "kind string, start long, end long, name string, score double, value string")


def scan_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans per document."""
    def digest(doc, text):
        spans = secret_spans(text or "")
        base = [s for s in spans if s[0] != NAMED]
        write = (lambda found: ",".join(f"{k}:{s}:{e}" for k, s, e, *_ in found))
        return (doc, *(sum(s[0] == k for s in base) for k in BASE),
                hashlib.sha256(write(base).encode()).hexdigest(), write(spans))

    def run(key: pa.DataType, batches):
        yield from batches_of((digest(doc, text) for doc, text in rows_of(batches)),
                              ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
                              [key, *[pa.int64()] * 3, pa.string(), pa.string()], text=5)
    return _mapped(docs, run, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def _mapped(docs: DataFrame, run, columns: str) -> DataFrame:
    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is not None:
            def again():
                yield first
                yield from batches
            yield from run(first.schema.field(0).type, again())
    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(worker, f"doc_id {key}, {columns}")
