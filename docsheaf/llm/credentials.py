"""Secrets in whole texts, by patterns and by reading assignments.

Base kinds are patterns. Beyond them, text that assigns anything is lexed as
source or configuration: names, quoted literals, operators and bare words are
parsed into pairs of a target name and a value (``name = "x"``, ``name: x``,
``"name": "x"``, ``name := a + "x"``, ``"name" => "x"``). Names that stand for a literal elsewhere
in the text are replaced by it, over any number of steps, so a secret is found
where it is written even if its own name is harmless. A literal is scored by
how sensitive the names are that it reaches, and by its own shape. Literals
that lie within a base span are not reported again.

Null and empty texts have no secrets. Repeated rows give repeated rows, an
empty table an empty one. Other columns, whatever their names, are not read.
Lexing is linear in the text; only texts that can hold a secret are read in
Python at all, the others are told apart in whole batches.
"""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsheaf.llm.common import batches

# The base kinds in order, their patterns, and the least length
# of the group named.
BASE = {
    "assign": (
        re.compile(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            re.ASCII | re.IGNORECASE,
        ),
        2,
        6,
    ),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 24),
}
KINDS = [*BASE, "literal"]
#: A text without any of these holds no base span and no assignment.
CANDIDATE = "AKIA|[0-9a-f]{24}|[:=]"

LEXEME = re.compile(
    r"""(?P<string>"(?:[^"\\\n]|\\.)*+"|'(?:[^'\\\n]|\\.)*+')
    |(?P<name>[A-Za-z_][A-Za-z0-9_.-]*+)
    |(?P<link>[:=!<>]=|=>|://)
    |(?P<assign>[=:])
    |(?P<plus>\+)
    |(?P<end>[\n,;(){}\[\]])
    |(?P<bare>[^\s"'=:,;(){}\[\]+]++)
    |(?P<other>\S)""",
    re.VERBOSE | re.ASCII,
)
#: Sensitive parts of a name; the highest counts.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.7, "secret": 1.0,
    "token": 0.9, "apikey": 1.0, "credential": 1.0, "credentials": 1.0, "auth": 0.7, "private": 0.6,
    "key": 0.6, "signature": 0.5, "salt": 0.5, "bearer": 0.8, "connection": 0.5, "dsn": 0.6,
}
PLACEHOLDER = re.compile(r"example|change.?me|your|dummy|sample|placeholder|todo|none|null|true|false|[x*.#-]{4}", re.I)
#: Least length and least score of a reported literal.
LEAST_CHARS, LEAST_SCORE = 8, 0.5

SECRETS = "array<struct<kind:string,start:bigint,end:bigint,name:string,score:double>>"


def name_score(name: str) -> float:
    """How sensitive a name is, by its words (``dbPassword``, ``api-key``, ``AUTH_TOKEN``)."""
    words = re.findall(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])", name)
    joined = re.sub("[^a-z]", "", name.lower())
    best = max((SENSITIVE.get(w.lower(), 0.0) for w in words), default=0.0)
    return max([best, *(SENSITIVE[w] for w in ("apikey", "passphrase", "password") if w in joined)])


def literal_score(value: str) -> float:
    """How much a literal looks made by chance: mixed characters, high entropy, no placeholder."""
    if len(value) < LEAST_CHARS or PLACEHOLDER.search(value) or re.search(r"\s", value):
        return 0.0
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    kinds = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(1.0, entropy / 4) * (1.0 if kinds >= 2 else 0.4)


def assignments(text: str) -> list[tuple[str, list[tuple[str, str, int, int]]]]:
    """Pairs of a name and the terms of its value: ``(kind, text, start, end)`` each."""
    tokens = [(m.lastgroup, m[0], m.start(), m.end()) for m in LEXEME.finditer(text)]
    pairs, k = [], 0
    while k + 2 < len(tokens):
        kind, written, _, _ = tokens[k]
        step = 1
        link = tokens[k + 1][1]
        # an arrow also links names to functions and types; it assigns literals
        arrow = link == "=>" and kind in ("name", "string") and tokens[k + 2][0] == "string"
        if tokens[k + 1][0] == "assign" or link == ":=" or arrow:
            name = written.strip("\"'") if kind in ("name", "string") else ""
            terms, at = [], k + 2
            while at < len(tokens) and tokens[at][0] in ("string", "name", "bare"):
                own, value, start, end = tokens[at]
                if own == "string":
                    value, start, end = value[1:-1], start + 1, end - 1
                elif own == "name" and at + 1 < len(tokens) and tokens[at + 1][0] == "assign":
                    break
                terms.append((own, value, start, end))
                if at + 1 < len(tokens) and tokens[at + 1][0] == "plus":
                    at += 2
                else:
                    break
            if name and terms:
                pairs.append((name, terms))
            step = 2
        k += step
    return pairs


def scored_literals(text: str) -> list[tuple[int, int, str, float]]:
    """``(start, end, name, score)``: literals by the most sensitive name they reach."""
    pairs = assignments(text)
    uses: dict[str, list[str]] = {}
    for name, terms in pairs:
        for kind, value, _, _ in terms:
            if kind == "name":
                uses.setdefault(value, []).append(name)
    # names spread backwards along uses: each is visited again only for a higher score
    defined = {name for name, _ in pairs}
    best = {name: (name_score(name), name) for name in defined}
    feeds: dict[str, list[str]] = {}
    for source, targets in uses.items():
        for target in targets:
            feeds.setdefault(target, []).append(source)
    queue = sorted(defined, key=lambda n: best[n])
    while queue:
        target = queue.pop()
        for source in feeds.get(target, ()):
            if source in best and best[target][0] > best[source][0]:
                best[source] = best[target]
                queue.append(source)
    found = []
    for name, terms in pairs:
        sensitive, by = best[name]
        for kind, value, start, end in terms:
            if kind == "name" and value in defined:
                continue
            score = sensitive * literal_score(value)
            if score >= LEAST_SCORE:
                found.append((start, end, by, round(score, 3)))
    return found


def secrets_of(text: str) -> list[dict]:
    """All secrets of a text by start, then kind."""
    found = []
    for kind, (pattern, group, least) in BASE.items():
        for m in pattern.finditer(text):
            if len(m[group]) >= least:
                name = m[1] if kind == "assign" else ""
                found.append((m.start(), KINDS.index(kind), m.end(), name, 1.0))
    base = sorted((start, end) for start, _, end, _, _ in found)
    starts = [start for start, _ in base]
    reach = np.maximum.accumulate([end for _, end in base]) if base else []
    for start, end, name, score in scored_literals(text) if "=" in text or ":" in text else ():
        k = int(np.searchsorted(starts, end)) - 1
        if k < 0 or reach[k] <= start:
            found.append((start, KINDS.index("literal"), end, name, score))
    names = ("start", "kind", "end", "name", "score")
    return [dict(zip(names, row, strict=True)) | {"kind": KINDS[row[1]]} for row in sorted(found)]


def _search(part: pa.RecordBatch):
    texts = part.column("text")
    rows = np.flatnonzero(pc.match_substring_regex(texts, CANDIDATE).to_numpy(zero_copy_only=False))
    found = [[] for _ in range(len(texts))]
    for k in rows.tolist():
        found[k] = secrets_of(texts[k].as_py())
    kind = pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("score", pa.float64())]
    )
    return [part.column("doc_id"), pa.array(found, pa.list_(kind))]


def find_secrets(docs: DataFrame) -> DataFrame:
    """``(doc_id, secrets)``: spans in code points, end exclusive, with name and score."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, secrets {SECRETS}"
    return rows.mapInArrow(batches(_search, ["doc_id", "secrets"]), schema)


def digest(found: DataFrame) -> DataFrame:
    """Counts, the digest of the base spans, and all spans."""

    def spans(kinds: list[str]) -> Column:
        own = F.filter("secrets", lambda s: s["kind"].isin(kinds))
        return F.array_join(F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in BASE],
        F.sha2(spans(list(BASE)), 256).alias("base_sha256"),
        spans(KINDS).alias("spans"),
        count("literal"),
    )
