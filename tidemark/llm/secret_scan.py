"""Secret scans by assignment-aware lexing.

Source code and configuration are lexed into names, literals and operators, across lines. A name followed by "=", ":" or
"=>" and an expression of literals and names joined by "+" is an assignment, also with a type or subscripts between; names
that were given a literal before are replaced by it (constant propagation), in order, within a text. A line of
configuration that is a name, "=" or ":" and one word gives that word without quotes as a literal. A literal is a secret where the name it reaches is sensitive and the
literal looks like a credential: the sensitivity of the target's words times the literal's own weight passes a
threshold. Three base patterns are searched beside it in every whole text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base patterns, kinds in their order.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "literal")
LEAST_VALUE = 6

#: How sensitive a word in a target's name is.
NAME_WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9,
    "private": 0.5, "access": 0.4, "auth": 0.5, "authorization": 0.6, "bearer": 0.7, "key": 0.5, "api": 0.5, "client": 0.1, "session": 0.3, "signature": 0.4, "salt": 0.4,
}
NAME_LEAST = 0.75
SCORE_LEAST = 0.5

_LEX = re.compile(
    r"""(?P<skip>[^\S\n]+|\\\n)
      | (?P<name>[A-Za-z_$][A-Za-z0-9_$]*(?:[.-][A-Za-z_$][A-Za-z0-9_$]*)*)
      | "(?P<double>(?:[^"\\\n]|\\[^\n])*)"
      | '(?P<single>(?:[^'\\\n]|\\[^\n])*)'
      | (?P<op>=>|:=|==|!=|<=|>=|[=:+])
      | (?P<number>[0-9][A-Za-z0-9_.]*)
      | (?P<end>[\n;,{}\[\]()])""",
    re.VERBOSE,
)
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def name_score(name: str) -> float:
    """The sum of the weights of a name's words, written in snake, kebab, dotted or camel case; 1 at most."""
    words = [w.lower() for w in _WORD.findall(name)]
    return min(1.0, sum(NAME_WEIGHTS.get(w, 0.0) for w in dict.fromkeys(words)))


def literal_score(value: str) -> float:
    """How much a literal looks like a credential: its length and the entropy of its characters, 0 for prose and stubs."""
    if len(value) < LEAST_VALUE or any(c.isspace() for c in value):
        return 0.0
    if re.fullmatch(r"[xX*.\-_]+|<.*>|\$\{.*\}|%.*%|changeme|example|placeholder|none|null|true|false", value, re.IGNORECASE):
        return 0.0
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    return min(1.0, 0.35 + 0.65 * min(1.0, entropy / 3.0)) if entropy > 1.0 else 0.2


def _tokens(line_text: str, base: int) -> Iterator[tuple[str, str, int, int]]:
    at = 0
    while at < len(line_text):
        m = _LEX.match(line_text, at)
        if m is None:
            yield "other", line_text[at], base + at, base + at + 1
            at += 1
            continue
        kind = m.lastgroup
        if kind in ("double", "single"):
            yield "literal", m[kind], base + m.start(kind), base + m.end(kind)
        elif kind != "skip":
            yield kind, m[0], base + m.start(), base + m.end()
        at = m.end()


_ASSIGNS = ("=", ":", ":=", "=>")
#: Tokens between a name and the "=" behind its type.
TYPE_TOKENS = 16


def _regions(text: str) -> Iterator[tuple[str, int]]:
    """Runs of lines that could hold an assignment or a part of one, blank lines within them too, and their places."""
    at, begin, upto = 0, None, 0
    for line in text.split("\n"):
        if '"' in line or "'" in line or "=" in line or ":" in line:
            begin, upto = (at if begin is None else begin), at + len(line)
        elif begin is not None and line.strip(" \t\r()\\"):
            yield text[begin:upto], begin
            begin = None
        at += len(line) + 1
    if begin is not None:
        yield text[begin:upto], begin


def _expression(tokens: list, j: int, known: dict) -> tuple[list[tuple[str, int, int]], int]:
    """The literals of an expression that starts at token j, and the token after it. Lines may end after operators."""
    found: list[tuple[str, int, int]] = []
    while True:
        while j < len(tokens) and tokens[j][0] == "end" and tokens[j][1] in "\n(":
            j += 1
        if j == len(tokens):
            return found, j
        k, v, s, e = tokens[j]
        if k == "literal":
            found.append((v, s, e))
        elif k == "name" and v in known:
            found.extend(known[v])
        else:
            return found, j
        j += 1
        if j == len(tokens) or tokens[j][:2] != ("op", "+"):
            return found, j
        j += 1


def _target(tokens: list, i: int) -> tuple[str, int] | None:
    """The name that token i starts, with its subscripts, and the place of the operator behind it."""
    name, j = tokens[i][1], i + 1
    if tokens[i][0] == "name" and name in ("var", "const") and j + 2 < len(tokens) and tokens[j][0] == tokens[j + 1][0] == "name" and tokens[j + 2][:2] == ("op", "="):
        return tokens[j][1], j + 2
    while tokens[i][0] == "name" and j + 1 < len(tokens) and tokens[j][1] == "[" and tokens[j][0] == "end":
        if tokens[j + 1][:2] == ("end", "]"):
            j += 2
        elif j + 2 < len(tokens) and tokens[j + 2][:2] == ("end", "]"):
            name, j = (f"{name}.{tokens[j + 1][1]}" if tokens[j + 1][0] in ("literal", "name") else name), j + 3
        else:
            return None
    return (name, j) if j < len(tokens) and tokens[j][0] == "op" and tokens[j][1] in _ASSIGNS else None


def _behind_type(tokens: list, j: int) -> int | None:
    """The "=" behind a type that starts at token j, on the same line."""
    for k in range(j, min(j + TYPE_TOKENS, len(tokens))):
        kind, value = tokens[k][:2]
        if kind == "op":
            return k if value == "=" and k > j else None
        if kind == "literal" or kind == "end" and value not in "[],()":
            return None
    return None


def assignments(text: str) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """(name, literals with their places) in order; literals that a name stood for come with their first place."""
    known: dict[str, list[tuple[str, int, int]]] = {}
    out = []
    for region, base in _regions(text):
        tokens = list(_tokens(region, base))
        i = 0
        while i < len(tokens):
            target = _target(tokens, i) if tokens[i][0] in ("name", "literal") else None
            if target:
                name, at = target
                found, j = _expression(tokens, at + 1, known)
                if not found and tokens[at][1] == ":" and (behind := _behind_type(tokens, at + 1)) is not None:
                    found, j = _expression(tokens, behind + 1, known)
                if found:
                    known[name] = found
                    out.append((name, found))
                    i = j
                    continue
                if tokens[at][1] in ("=", ":="):
                    known.pop(name, None)  # it stands for something else from here on
            i += 1
    return out


_CONFIG = re.compile(r"^[ \t]*(?:(?:export|set|env)[ \t]+|-[ \t]+)?([A-Za-z_][A-Za-z0-9_.-]*)([ \t]*)([=:])[ \t]*([^\s\"'`=>|&*][^\s\"'`]*)[ \t\r]*(?:[ \t][#;][^\n]*)?$", re.MULTILINE | re.IGNORECASE | re.ASCII)
_SECTION = re.compile(r"^[ \t]*\[[^\]\n\"']+\][ \t\r]*$", re.MULTILINE)
_REFERENCE = re.compile(r"\$\{?([A-Za-z_][A-Za-z0-9_]*)\}?")
_PATH = re.compile(r"[A-Za-z_$][A-Za-z_$]*(?:\.[A-Za-z_$]+)*")


def unquoted(text: str) -> Iterator[tuple[str, tuple[str, int, int]]]:
    """(name, literal with its place) of configuration lines without quotes: .env and shell, INI and properties, YAML.

    Calls are no literals. Nor are bare names where the line could as well be source code: with blanks around "=" outside
    of a file with sections, or with a comma or semicolon behind.
    """
    known: dict[str, tuple[str, int, int]] = {}
    ini = None
    for m in _CONFIG.finditer(text):
        name, value, at = m[1], m[4], m.start(4)
        if (r := _REFERENCE.fullmatch(value)) is not None:
            if r[1] in known:
                yield name, known[r[1]]
            continue
        whole = value.rstrip(",;")
        if not whole or re.match(r"[A-Za-z_$][\w.$:]*\(", whole) or "{{" in whole:
            continue
        if _PATH.fullmatch(whole) and (whole != value or m[3] == "=" and m[2]):
            if ini is None:
                ini = _SECTION.search(text) is not None
            if whole != value or not ini:
                continue
        if re.fullmatch(r"[0-9.]+", whole) and NAME_WEIGHTS.get(_WORD.findall(name)[-1].lower() if _WORD.findall(name) else "", 0.0) == 0.0:
            continue
        known[name] = (whole, at, at + len(whole))
        yield name, known[name]


def literal_spans(text: str) -> list[tuple[int, int, float]]:
    """Places and scores of the literals that reach a sensitive name."""
    best: dict[tuple[int, int], float] = {}
    for name, found in [*assignments(text), *((name, [x]) for name, x in unquoted(text))]:
        weight = name_score(name)
        if weight < NAME_LEAST:
            continue
        value = "".join(v for v, _, _ in found)
        score = weight * literal_score(value)
        if score >= SCORE_LEAST:
            for v, s, e in found:
                if v:
                    best[s, e] = max(score, best.get((s, e), 0.0))
    return [(s, e, x) for (s, e), x in sorted(best.items())]


_HINTS = (b"passw", b"secret", b"token", b"api")
_NAMES = tuple(w.encode() for w in ("passphrase", "pwd", "credential", "private", "access", "auth", "bearer", "key", "session", "signature", "salt"))


def scan(text: str | None) -> list[tuple[int, str, int]]:
    """All spans as (start, kind, end), by start and then kind."""
    if not text:
        return []
    out = []
    low = text.encode("utf-8", "surrogatepass").lower()
    hinted = any(h in low for h in _HINTS)
    if hinted:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if b"akia" in low:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if (b"=" in low or b":" in low or b'"' in low or b"'" in low) and (hinted or any(h in low for h in _NAMES)):
        out += [(s, 3, e) for s, e, _ in literal_spans(text)]
    return [(s, KINDS[k], e) for s, k, e in sorted(out)]


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, spans (array of start, kind, end; code points, end exclusive) for each row of docs, by start then kind.

    Null texts are empty and have no spans. Rows are scanned one by one, so repeated rows and ties need no rule; spans
    of different kinds may overlap. Other columns are ignored; an empty table gives an empty result.
    """
    kind = docs.schema["doc_id"].dataType
    span = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))

    def run(batches):
        for b in batches:
            found = [[{"start": s, "kind": k, "end": e} for s, k, e in scan(t.as_py())] for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, span)], ["doc_id", "spans"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind.simpleString()}, spans array<struct<start:int,kind:string,end:int>>")


def redact_text(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with every span (overlapping ones as one) replaced by the mark."""
    spans = scan(text)
    if not spans:
        return text
    merged: list[list[int]] = []
    for s, _, e in spans:
        if merged and s < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    out, at = [], 0
    for s, e in merged:
        out += [text[at:s], mark]
        at = e
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame) -> DataFrame:
    """docs with the spans in text replaced by [SECRET]; all rows and columns stay."""
    columns = docs.columns
    at = columns.index("text")

    def run(batches):
        for b in batches:
            column = pa.array([redact_text(t.as_py()) for t in b.column(at)], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[:at], column, *b.columns[at + 1 :]], b.schema.names)

    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(run, docs.withColumn("text", F.col("text").cast("string")).schema)
