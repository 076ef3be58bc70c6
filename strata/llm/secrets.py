"""Secret scans with assignment-aware lexing.

Two passes over a whole text:

* the fixed patterns (``assign``, ``access``, ``hex``), leftmost and
  non-overlapping per kind;
* a lexer for assignments in source and configuration syntax
  (``name = "x"``, ``name: x``, ``"name": "x"``, ``cfg["name"] = 'x'``,
  ``name => "x"``, ``<name>x</name>``, ``--name x``, ``NAME=x``), which yields
  name-literal pairs. A right side that names an earlier constant stands for
  that constant's literals, also through ``+`` and further names. Each literal
  is scored by the most sensitive name it reaches, times how little it looks
  like an ordinary word; those at or over ``threshold`` become ``literal``
  spans, unless they touch a span of the fixed patterns.

Offsets are code points, end exclusive. Null and empty texts have no spans."""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "literal")
SPANS = "array<struct<kind:string,start:int,end:int,name:string,score:double>>"
THRESHOLD = 0.5

# The three base patterns and their least lengths.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_LEAST = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 18
HEX = re.compile(r"[0-9a-f]{16,}")  # a run of [0-9a-f]+ with 16 or more characters
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# How sensitive a part of a name is (pairs are two parts side by side).
PARTS = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 1.0, "pass": 0.8, "secret": 1.0, "token": 1.0,
    "credential": 0.9, "credentials": 0.9, "apikey": 1.0, "bearer": 0.9, "authorization": 0.9, "auth": 0.7,
    "privatekey": 1.0, "secretkey": 1.0, "accesskey": 1.0, "signingkey": 1.0, "encryptionkey": 1.0, "dsn": 0.6, "key": 0.4, "salt": 0.5,
}
PAIRS = {
    ("api", "key"): 1.0, ("private", "key"): 1.0, ("secret", "key"): 1.0, ("access", "key"): 1.0, ("signing", "key"): 1.0,
    ("encryption", "key"): 1.0, ("account", "key"): 0.9, ("public", "key"): 0.0, ("primary", "key"): 0.0, ("foreign", "key"): 0.0,
}
PLACEHOLDERS = ("example", "changeme", "placeholder", "your", "dummy", "xxxx", "todo", "none", "null", "true", "false", "undefined")

_NAME = r"[A-Za-z_][A-Za-z0-9_]*(?:[.\-][A-Za-z_][A-Za-z0-9_]*)*"
_LEXER = re.compile(
    rf"""
    <(?P<tag>{_NAME})>(?P<xml>[^<>\s]+)</(?P=tag)>                               # <name>x</name>
  | (?<![\w-])--(?P<flag>{_NAME})(?:=|[ ]+)(?P<arg>[^\s"'<>|;]+)                  # --name x
  | (?:\[?["'](?P<quoted>[A-Za-z_][\w.\-]*)["']\]?|(?<![\w.$/-])(?P<bare>{_NAME}))
    [ \t]*(?:[:][ \t]*[A-Za-z_][\w.\[\]]*[ \t]*(?==[^=])|)                        # a type: name: str = ...
    (?:=>|:=|=(?!=)|:(?![:/]))[ \t]*
    (?P<right>(?:"[^"\n]*"|'[^'\n]*'|[^\s"'<>|;,(){{}}\[\]]+)
       (?:[ \t]*\+[ \t]*(?:"[^"\n]*"|'[^'\n]*'|{_NAME}))*)
    """,
    re.X | re.A,
)
_TERM = re.compile(rf""""(?P<d>[^"\n]*)"|'(?P<s>[^'\n]*)'|(?P<w>[^\s"'+]+)""")
_SPLIT = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def name_score(name: str) -> float:
    """0 to 1: how likely a value of this name is a secret."""
    parts = [p.lower() for p in _SPLIT.findall(name)]
    score = max([PARTS.get(p, 0.0) for p in parts] + [PARTS.get("".join(parts), 0.0)], default=0.0)
    pairs = [PAIRS[p] for p in zip(parts, parts[1:]) if p in PAIRS]
    return min(pairs) if 0.0 in pairs else max([score, *pairs])


def literal_score(value: str) -> float:
    """0 to 1: length, bits a character and mixture of a literal; 0 for placeholders."""
    low = value.lower()
    if len(value) < 8 or any(c.isspace() for c in value) or any(p in low for p in PLACEHOLDERS) or value[0] in "$<{%":
        return 0.0
    bits = -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())
    kinds = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    if kinds < 2 and not re.fullmatch("[0-9A-Fa-f]{16,}|[A-Za-z0-9+/]{24,}", value):
        return 0.2  # one plain word
    return min(1.0, bits / 3.0) * min(1.0, 0.5 + len(value) / 24)


def assignments(text: str) -> list[tuple[str, float, str, int, int]]:
    """Name-literal pairs (name, its score, literal, start, end) with constants
    propagated: each literal comes with the most sensitive name it reaches.

    Statements are read forwards for the names defined, then worked through
    backwards, so that what a name is used for later is known where it is
    defined; the work is in proportion to the text."""
    statements, first = [], {}
    for m in _LEXER.finditer(text):
        name = m["tag"] or m["flag"] or m["quoted"] or m["bare"]
        first.setdefault(name, len(statements))
        statements.append((name, m))
    used: dict[str, tuple[float, str]] = {}
    out = []
    for at in range(len(statements) - 1, -1, -1):
        name, m = statements[at]
        score, reached = max((name_score(name), name), used.pop(name, (0.0, "")))
        if m["right"] is None:
            group = "xml" if m["xml"] is not None else "arg"
            out.append((reached, score, m[group], *m.span(group)))
            continue
        for t in _TERM.finditer(text, *m.span("right")):
            kind = next(k for k in "dsw" if t[k] is not None)
            word = t[kind].rstrip(".")
            if kind == "w" and first.get(word, at) < at:
                used[word] = max(used.get(word, (0.0, "")), (score, reached))
            elif t[kind]:
                out.append((reached, score, t[kind], *t.span(kind)))
    return out[::-1]


def scan(text: str | None, threshold: float = THRESHOLD) -> list[tuple[str, int, int, str | None, float]]:
    """Spans (kind, start, end, name, score) by start, then kind."""
    if not text:
        return []
    base = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        base += [("assign", *m.span(), m[1], 1.0) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        base += [("access", *m.span(), None, 1.0) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    base += [("hex", *m.span(), None, 1.0) for m in HEX.finditer(text)]
    more: dict[tuple[int, int], tuple[float, str]] = {}
    if "=" in text or ":" in text or "</" in text or "--" in text:
        for name, sensitive, value, s, e in assignments(text):
            if sensitive and (score := sensitive * literal_score(value)) >= threshold:
                more[s, e] = max(more.get((s, e), (0.0, "")), (score, name))
    # base spans as disjoint stretches: each literal meets the one that ends after its start, if any
    starts, ends = [], []
    for s, e in sorted((s, e) for _, s, e, _, _ in base):
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    spans = list(base)
    for (s, e), (score, name) in more.items():
        at = bisect_right(ends, s)
        if at == len(ends) or starts[at] >= e:
            spans.append(("literal", s, e, name, score))
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def secret_spans(text: str | Column, threshold: float = THRESHOLD) -> Column:
    """All spans of a text column, by start, then kind."""

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(("kind", "start", "end", "name", "score"), s)) for s in scan(t, threshold)] for t in texts], index=texts.index, dtype=object)

    return F.pandas_udf(run, SPANS)(text)


def find_secrets(docs: DataFrame, text: str = "text", out: str = "spans", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the column ``out`` (replaced if present): the spans found."""
    return docs.withColumn(out, secret_spans(F.col(text), threshold))


def redact(docs: DataFrame, text: str = "text", mask: str = "[SECRET]", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with every span of ``text`` (touching spans as one) replaced by
    ``mask``. Rows without spans keep their text as it is; null stays null."""

    def clean(t: str | None) -> str | None:
        found = scan(t, threshold)
        if not found:
            return t
        parts, at = [], 0
        for _, s, e, _, _ in found:
            if s >= at:
                parts += [t[at:s], mask]
            at = max(at, e)
        return "".join([*parts, t[at:]])

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([clean(t) for t in texts], index=texts.index, dtype=object)

    return docs.withColumn(text, F.pandas_udf(run, "string")(F.col(text)))
