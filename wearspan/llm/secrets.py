"""Secret scans by assignment-aware lexing.

Three base patterns find plain secrets. On top of them the text is lexed as source or configuration:
names with the literals assigned to them become pairs, constants are followed from name to name, and a
literal is scored by how sensitive the name is that finally receives it.
"""

from __future__ import annotations

import bisect
import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearspan.llm.frames import chunks, fresh, ship

# Fixed values of the base scan: key words, shapes and least lengths.
KEY_WORDS = ("password", "passwd", "secret", "token", "api_?key")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "literal")


def either_case(pattern: str) -> str:
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", pattern)


ASSIGN = re.compile(f"({either_case('|'.join(KEY_WORDS))})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("(?<![0-9a-f])[0-9a-f]{%d,}" % LEAST["hex"])  # whole runs, so short ones need no second look
STEMS = ("passw", "secret", "token", "apikey", "api_key")

# Words of a name and how much each says that its value is a secret.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.7, "secret": 1.0, "token": 0.9,
    "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "bearer": 0.9, "auth": 0.6, "authorization": 0.8,
    "signature": 0.6, "key": 0.3, "private": 0.4, "access": 0.3, "api": 0.3, "client": 0.1, "encryption": 0.4, "signing": 0.4,
}
# A name scores only if it holds one of these; words that hold a shorter one are left to it.
HINTS = tuple(w for w in SENSITIVE if not any(v != w and v in w for v in SENSITIVE))
PLACEHOLDER = re.compile(r"(?i)\A(?:x+|\*+|\.+|none|null|true|false|undefined|changeme|example|placeholder|your[-_ ].*|<.*>|\$\{?.*|%.*%|\{\{.*)\Z")
LEXEME = re.compile(
    r"""(?P<text>(?<!\w)(?:"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`))
    |(?P<name>[A-Za-z_][A-Za-z0-9_]*(?:[.-][A-Za-z0-9_]+)*(?:\[["'][A-Za-z0-9_.-]+["']\])?)
    |(?P<put>:=|=>|=(?!=)|:(?!:))
    |(?P<open><(?=[A-Za-z_]))
    |(?P<close>>)
    |(?P<plus>\+|\.(?=\s*["']))
    |(?P<line>\n)
    |(?P<end>[;,{}()])
    |(?P<bare>[^\s"'`;,{}()<>=:+]+)
    |(?P<other>\S)""",
    re.X,
)
VALUE = re.compile(r"[^\s\"'`;,{}()<>]+")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, leftmost and non-overlapping per kind."""
    found: list[tuple[int, int, str]] = []
    lower = text.lower()
    if any(s in lower for s in STEMS) or len(lower) != len(text):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def sensitivity(name: str) -> float:
    """0 to 1 from the words of a name in snake, kebab, dotted or camel case."""
    words = re.findall(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])", name)
    lower = [w.lower() for w in words]
    joined = "".join(lower)
    score = sum(SENSITIVE.get(w, 0.0) for w in lower)
    if "apikey" in joined:
        score = max(score, SENSITIVE["apikey"])
    return min(1.0, score)


def literal_quality(value: str) -> float:
    """0 to 1: long, varied values count; placeholders, short words and references do not."""
    if len(value) < 6 or PLACEHOLDER.match(value):
        return 0.0
    counts = Counter(value)
    entropy = -sum(c / len(value) * math.log2(c / len(value)) for c in counts.values())
    kinds = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    blanks = value.count(" ")
    return min(1.0, 0.18 * entropy + 0.12 * kinds) if not blanks else min(0.9, 0.1 * entropy + 0.1 * kinds) / (1 + blanks)


Literal = tuple[int, int, str]
Pair = tuple[str, list[Literal], list[Literal]]


def pairs(text: str) -> Iterator[Pair]:
    """(name, literals, names referred to) of each assignment, in the order of the text.

    Known forms: `name = "x"`, `name: x`, `"name": "x"`, `name => 'x'`, `export NAME=x`, `--name=x`,
    `<name>x</name>`, and sums of literals and names.
    """
    target, putting, tag = "", False, False
    literals: list[Literal] = []
    names: list[Literal] = []
    skip_to = 0

    def flush() -> Iterator[Pair]:
        if putting and target and (literals or names):
            yield target, list(literals), list(names)

    joined = True  # the next operand belongs to the value
    for m in LEXEME.finditer(text):
        if m.start() < skip_to:
            continue
        kind = m.lastgroup
        if kind == "put" or (kind == "close" and tag):
            if putting and (literals or names):  # `a: b = "x"`: the last operand is the new target
                last = names[-1][2] if names and not literals else ""
                yield from flush()
                target = last or target
            putting, joined, tag = bool(target), True, False
            literals, names = [], []
            if putting and kind == "put":  # an unquoted value of a configuration line runs to the next blank
                v = VALUE.match(text, m.end() + len(text[m.end() : m.end() + 8]) - len(text[m.end() : m.end() + 8].lstrip(" ")))
                if v and not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_.]*", v[0]):
                    literals, joined, skip_to = [(v.start(), v.end(), v[0])], False, v.end()
        elif kind == "open":
            yield from flush()
            target, putting, tag = "", False, True
            literals, names = [], []
        elif kind == "plus" and putting:
            joined = True
        elif kind in ("text", "name", "bare"):
            if putting and joined:
                if kind == "text":
                    literals.append((m.start() + 1, m.end() - 1, m[0][1:-1]))
                elif kind == "name":
                    names.append((m.start(), m.end(), m[0]))
                else:
                    literals.append((m.start(), m.end(), m[0]))
                joined = False
            else:
                yield from flush()
                target, putting = (m[0][1:-1] if kind == "text" else m[0]) if kind != "bare" else "", False
                literals, names = [], []
        elif kind in ("line", "end"):
            if not (putting and joined and kind == "line" and (literals or names)):
                yield from flush()
                target, putting, tag = "", False, False
                literals, names = [], []
        elif kind == "other" and not putting:
            target = ""
    yield from flush()


def scored_literals(text: str) -> list[tuple[int, int, float]]:
    """(start, end, score) of literals that reach a sensitive name directly or through constants.

    Each assignment is a node that holds its literals and refers to the assignments of the names it uses: the last one before
    it and the last one of the text. The nodes of sensitive names are walked once, the most sensitive first, so a node's
    first visit gives its literals their best weight, and sums that refer to themselves cost no more than their length.
    """
    nodes: list[tuple[list[Literal], list[int], list[str]]] = []
    latest: dict[str, int] = {}
    starts: list[tuple[float, int]] = []
    for name, literals, names in pairs(text):
        own, before, others = list(literals), [], []
        for start, end, other in names:
            if other in latest:
                before.append(latest[other])
            elif re.search("[0-9]", other) and not literals:  # an unquoted word with digits is its own literal
                own.append((start, end, other))
            others.append(other)
        weight = sensitivity(name)
        if weight:
            starts.append((weight, len(nodes)))
        latest[name] = len(nodes)
        nodes.append((own, before, others))
    best: dict[tuple[int, int], float] = {}
    seen: set[int] = set()
    for weight, node in sorted(starts, key=lambda s: -s[0]):
        ahead = [node]
        while ahead:
            at = ahead.pop()
            if at in seen:
                continue
            seen.add(at)
            own, before, others = nodes[at]
            for start, end, value in own:
                score = weight * literal_quality(value)
                if score > best.get((start, end), 0.0):
                    best[start, end] = score
            ahead += before
            ahead += [latest[o] for o in others if o in latest]
    return [(s, e, v) for (s, e), v in best.items()]


def secret_spans(text: str, least_score: float = 0.5) -> list[tuple[int, int, str, float]]:
    """(start, end, kind, score) by start, then kind; base spans score 1. A literal inside a base span
    is not told twice."""
    base = base_spans(text)
    found = [(s, e, k, 1.0) for s, e, k in base]
    lower = text.lower()
    if ("=" in text or ":" in text or "</" in text) and any(h in lower for h in HINTS):
        ordered = sorted((s, e) for s, e, _ in base)
        starts = [s for s, _ in ordered]
        ends = list(itertools.accumulate((e for _, e in ordered), max))  # the furthest end of the spans up to each
        for start, end, score in scored_literals(text):
            i = bisect.bisect_left(starts, end)  # the base spans that start before the literal ends
            if score >= least_score and not (i and ends[i - 1] > start):
                found.append((start, end, "literal", score))
    return sorted(found, key=lambda f: (f[0], KINDS.index(f[2]), f[1]))


SPAN_TYPE = T.ArrayType(
    T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("score", T.DoubleType())])
)
SPAN_ARROW = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("score", pa.float64())]))


def find_secrets(df: DataFrame, column: str = "text", to: str = "secrets", keep: list[str] | None = None, masked: str | None = None) -> DataFrame:
    """`keep` (default: all) columns of `df` and the spans of secrets in `column`, in code points.

    NULL and empty texts have no spans. Repeated rows stay. With `masked` the column also comes back
    with every secret replaced by that word, spans that touch merged first.
    """
    ship(df.sparkSession)
    to = fresh(df, to)
    keep = df.columns if keep is None else keep
    fields = [df.schema[c] for c in keep]
    schema = T.StructType([*fields, T.StructField(to, SPAN_TYPE)])

    def mask(text: str | None, spans: list[dict]) -> str | None:
        if not spans:
            return text
        out, at = [], 0
        for s in spans:
            if s["start"] >= at:
                out += [text[at : s["start"]], masked]
            at = max(at, s["end"])
        return "".join(out) + text[at:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in chunks(batch, column):
                spans = [[dict(zip(("start", "end", "kind", "score"), s, strict=True)) for s in secret_spans(t)] if t else [] for t in texts]
                columns = [part.column(c) for c in keep]
                if masked is not None and column in keep:
                    i = keep.index(column)
                    columns[i] = pa.array([mask(t, s) for t, s in zip(texts, spans, strict=True)], columns[i].type)
                yield pa.record_batch([*columns, pa.array(spans, SPAN_ARROW)], [*keep, to])

    return df.mapInArrow(run, schema)


def span_texts(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def secret_report(docs: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, digest of the base spans, and all spans as text."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spans = F.col("secrets")

    def of_kind(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [of_kind(k) for k in KINDS[:3]]
    base = F.filter(spans, lambda s: s["kind"] != "literal")
    return find_secrets(slim, keep=["doc_id"]).select("doc_id", *counts, F.sha2(span_texts(base), 256).alias("base_sha256"), span_texts(spans).alias("spans"))


def mask_secrets(docs: DataFrame, word: str = "[secret]") -> DataFrame:
    """`docs` with the same columns and rows, secrets in `text` replaced by `word`; n_chars follows."""
    marked = find_secrets(docs, masked=word)
    spans = marked.columns[-1]
    if "n_chars" in docs.columns:
        n_chars = F.when(F.size(spans) > 0, F.length("text")).otherwise(F.col("n_chars"))
        marked = marked.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType))
    return marked.select(*docs.columns)
