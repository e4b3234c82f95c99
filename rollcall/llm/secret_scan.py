"""Secrets in texts: fixed patterns, and literals that flow into names that sound secret.

Texts that assign something are cut into tokens (names, quoted strings, bare words, operators) as most languages and
configuration files write them: `name = "x"`, `name: x`, `"name": "x"`, `name := a + "x"`, `NAME=x`, `{name => 'x'}`. A line's
end ends a value, unless an assignment sign, a plus, an open bracket, a backslash, a block scalar or an open quote goes
on; a quote is open up to an empty line at most, triple quotes and backticks up to their end. That gives pairs of a target name and its parts, literals or other names. A name's value is what it was assigned anywhere in
the text, so a literal is followed through constants to every name it ends up in. The words of the target name and the
look of the literal give a score; a literal at or above the threshold is a span of kind `literal`.

Patterns and syntax are ASCII, so texts are scanned as UTF-8 and the places of spans counted in code points afterwards.
Null texts count as empty. Rows are scanned one by one.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.shared import byte_texts, replaced, single, without

KINDS = ("assign", "access", "hex", "literal")
#: The base patterns. A match counts if the named part is long enough.
ASSIGN = re.compile(rb"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
HINTS = (b"passw", b"secret", b"token", b"api")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{32,}")  # a run is taken whole, so shorter runs need not be met
LEAST = {"assign": 8, "access": 16, "hex": 32}

TOKEN = re.compile(
    rb"""(?P<name>[A-Za-z_$][A-Za-z0-9_$]*(?:[.-][A-Za-z0-9_$]+)*)"""
    rb"""|(?P<equals>==+|!=|<=|>=)"""
    rb"""|(?P<assign>:=|=>|->|=|:(?!//))"""
    rb"""|(?P<plus>\+|\.(?=[^\S\n]))"""
    rb"""|(?P<word>[A-Za-z0-9_/$%@!^*~.+=-]+)"""
    rb"""|(?P<stop>[,;(){}\[\]<>|&#?"'`:\\])|(?P<line>\n)"""
)
#: Quoted strings on one line.
STRING = {b'"': re.compile(rb'"(?:[^"\\\n]|\\.)*+"'), b"'": re.compile(rb"'(?:[^'\\\n]|\\.)*+'"), b"`": re.compile(rb"`[^`\n]*+`")}
ALNUM = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
#: Quoted strings over several lines, where they can't go on, and the head of a block scalar after its colon.
LONG = re.compile(rb"""\"{3}((?:[^\\]|\\.)*?)\"{3}|'{3}((?:[^\\]|\\.)*?)'{3}|`([^`]*)`|"((?:[^"\\\n]|\\.|\n(?![ \t\r]*\n))*+)"|'((?:[^'\\\n]|\\.|\n(?![ \t\r]*\n))*+)'""", re.S)
EMPTY_LINE = re.compile(rb"\n[ \t\r]*\n")
BLOCK = re.compile(rb"[ \t]*[|>][+-]?[0-9]?[+-]?[ \t]*(?:#[^\n]*)?\r?\n")
ROW = re.compile(rb"([ \t]*)([^\n]*)\n?")
#: Words of a target name, and how much they say that its value is secret.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.7, "secret": 1.0, "secrets": 1.0, "token": 0.8,
    "credential": 0.9, "credentials": 0.9, "apikey": 1.0, "auth": 0.6, "authorization": 0.8, "bearer": 0.8, "privatekey": 1.0,
    "accesskey": 1.0, "signature": 0.5, "salt": 0.5, "key": 0.4, "access": 0.4, "private": 0.4, "api": 0.4, "encryption": 0.5, "signing": 0.5,
}
#: Words that say the opposite: the name of something about a secret.
HARMLESS = {"count", "length", "limit", "size", "type", "url", "uri", "path", "file", "name", "id", "hint", "label", "public", "max", "min", "regex", "field", "column"}
#: Without any of these, after taking out what may stand inside, no name is sensitive.
STEMS = (b"pass", b"pwd", b"secret", b"token", b"credential", b"key", b"auth", b"bearer", b"signature", b"salt", b"access", b"private", b"api", b"encryption", b"signing")
#: Names whose values may be phrases, and words that tell a phrase about a password from a password.
PHRASED, ABOUT = {"password", "passwd", "passphrase", "pwd", "pass"}, re.compile(r"(?i)passw|passphrase")
PEM = re.compile(r"-----[A-Z0-9 ]+-----")
PLACEHOLDERS = re.compile(r"(?i)^(x+|\*+|\.+|-+|_+|none|null|true|false|undefined|changeme|example.*|your.*|todo|test|dummy|placeholder|password|passwd|secret|token|string|\$\{.*\}?|\$\(.*|<.*>|%.*%|\{\{.*)$")
THRESHOLD, LEAST_LITERAL = 1.0, 8


@dataclass
class Part:
    """One part of a value: a literal with its place, or another name."""

    literal: bool
    text: str
    start: int = 0
    end: int = 0


@dataclass
class Assigned:
    name: str
    parts: list[Part] = field(default_factory=list)


def name_words(name: str) -> list[str]:
    """userApiKey, user_api_key and user.api-key alike: user, api, key."""
    return [w.lower() for w in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+", name)]


def name_score(name: str) -> float:
    words = name_words(name.rpartition(".")[2] if "." in name else name)
    if not words or words[-1] in HARMLESS:
        return 0.0
    joined = {a + b for a, b in zip(words, words[1:], strict=False)}
    return min(1.0, sum(SENSITIVE.get(w, 0.0) for w in {*words, *joined}))


def phrased(name: str) -> bool:
    words = name_words(name)
    return not PHRASED.isdisjoint({*words, *(a + b for a, b in zip(words, words[1:], strict=False))})


def literal_score(literal: str, phrase: bool = False) -> float:
    """Up to 1: long, of many different characters, of mixed kinds, no placeholder and no prose, unless it may be a phrase."""
    if len(literal) < LEAST_LITERAL or PLACEHOLDERS.match(literal):
        return 0.0
    if PEM.sub("", literal).count(" ") > 2 and (not phrase or ABOUT.search(literal)):
        return 0.0
    counts = Counter(literal)
    entropy = -sum(n / len(literal) * math.log2(n / len(literal)) for n in counts.values())
    kinds = sum(any(test(c) for c in literal) for test in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum() and not c.isspace()))
    return min(1.0, entropy / 6 + 0.2 * (kinds - 1)) if kinds > 1 or len(literal) >= 20 else 0.0


def lexed(text: bytes) -> list[tuple[str, bytes, int]]:
    """The tokens of a text: kind, text, place.

    A quote that isn't closed on its line is tried once: the same quotes after it on that line are escaped, and read from
    any of them the rest of the line is the same.
    """
    tokens: list[tuple[str, bytes, int]] = []
    unclosed = {quote: -1 for quote in STRING}
    at = 0
    while m := TOKEN.search(text, at):
        kind, value, start = m.lastgroup or "", m.group(), m.start()
        at = m.end()
        if value in STRING and start >= unclosed[value] and not (start and text[start - 1] in ALNUM):
            if string := STRING[value].match(text, start):
                kind, value, at = "string", string.group(), string.end()
            else:
                line = text.find(b"\n", start)
                unclosed[value] = len(text) if line < 0 else line
        if kind == "word" and tokens and tokens[-1][0] in ("name", "word") and tokens[-1][2] + len(tokens[-1][1]) == start:
            tokens[-1] = "word", tokens[-1][1] + value, tokens[-1][2]
        else:
            tokens.append((kind, value, start))
    return tokens


class Quoted:
    """Strings over several lines. One that is never closed is tried once up to where it can't go on."""

    def __init__(self, text: bytes):
        self.text = text
        self.unclosed: dict[tuple[bytes, bool], int] = {}

    def match(self, start: int) -> re.Match | None:
        quote = self.text[start : start + 1]
        kind = quote, self.text[start : start + 3] == 3 * quote
        if start < self.unclosed.get(kind, -1):
            return None
        found = LONG.match(self.text, start)
        if not found:
            gap = EMPTY_LINE.search(self.text, start) if quote != b"`" else None
            self.unclosed[kind] = gap.start() if gap else len(self.text)
        return found


def assignments(text: bytes) -> Iterator[Assigned]:
    """What a text assigns, in order."""
    if b"=" not in text and b":" not in text:
        return
    tokens, quoted = lexed(text), Quoted(text)
    for i in range(1, len(tokens) - 1):
        kind, sign, start = tokens[i]
        if kind != "assign":
            continue
        before, target, _ = tokens[i - 1]
        if before == "stop" and target in b")]" and i >= 3:  # conf["name"] = ...
            before, target, _ = tokens[i - 2]
        if before not in ("name", "string", "word"):
            continue
        name = target.strip(b"\"'`").decode("utf-8", "replace")
        block = _block(text, start) if sign == b":" else None
        if parts := [block] if block else _value(text, tokens, i + 1, quoted):
            yield Assigned(name, parts)


def _block(text: bytes, colon: int) -> Part | None:
    """The block scalar that a colon begins: the lines after it that stand further in than the colon's line."""
    head = BLOCK.match(text, colon + 1)
    if not head:
        return None
    least = len(ROW.match(text, text.rfind(b"\n", 0, colon) + 1)[1])
    lines, at, first, end = [], head.end(), -1, -1
    while at < len(text):
        row = ROW.match(text, at)
        if content := row[2].strip():
            if len(row[1]) <= least:
                break
            first, end = row.start(2) if first < 0 else first, row.start(2) + len(row[2].rstrip())
            lines.append(content)
        at = row.end()
    return Part(True, b"\n".join(lines).decode("utf-8", "replace"), first, end) if lines else None


def _value(text: bytes, tokens: list[tuple[str, bytes, int]], j: int, quoted: Quoted) -> list[Part]:
    """The parts of the value from a token on."""
    parts: list[Part] = []
    depth = 0
    kind_at = lambda at: tokens[at][0] if at < len(tokens) else "line"

    def past(at: int, lines: bool) -> int:
        """Past continued ends of lines, and all ends of lines if so said."""
        while at < len(tokens) and (lines and tokens[at][0] == "line" or tokens[at][1] == b"\\" and kind_at(at + 1) == "line"):
            at += 1 if tokens[at][0] == "line" else 2
        return at

    first = j
    j = past(j, False)
    if kind_at(j) == "line":  # a string on a later line, or the only word of the next
        later = past(j, True)
        alone = later == j + 1 and kind_at(later) in ("name", "word") and kind_at(later + 1) == "line"
        opens = later < len(tokens) and (kind_at(later) == "string" and kind_at(later + 1) != "assign" or tokens[later][1] in (b'"', b"'", b"`"))
        if not (alone or opens):
            return parts
        j = later
    while j < len(tokens):
        kind, value, start = tokens[j]
        quote = value[:1] in (b'"', b"'", b"`") and (kind == "stop" or value in (b'""', b"''") and text[start + 2 : start + 3] == value[:1])
        if quote and (m := quoted.match(start)):
            a, b = m.span(m.lastindex)
            parts.append(Part(True, m[m.lastindex].replace(b"\\\n", b"").decode("utf-8", "replace"), a, b))
            kind = "string"
            while j + 1 < len(tokens) and tokens[j + 1][2] < m.end():
                j += 1
        elif kind == "string":
            parts.append(Part(True, value[1:-1].decode("utf-8", "replace"), start + 1, start + len(value) - 1))
        elif kind in ("name", "word"):
            parts.append(Part(kind == "word", value.decode("utf-8", "replace"), start, start + len(value)))
            if value.lower() in (b"bearer", b"basic", b"new", b"const", b"let", b"return") and kind_at(j + 1) != "line":
                parts.pop()
                j += 1
                continue
        elif kind == "stop" and value in (b"(", b"[") and (j == first or depth or not parts):
            depth += 1
            j = past(j + 1, True)
            continue
        else:
            break
        # a sum of parts, or strings side by side; in brackets, lists too
        j = past(j + 1, depth > 0)
        after = past(j, True)
        if depth and j < len(tokens) and tokens[j][1] == b",":
            j = past(j + 1, True)
        elif kind_at(j) == "plus":
            j = past(j + 1, True)
        elif kind_at(after) == "plus" and kind_at(after + 1) == "string":
            j = after + 1
        elif not (kind == "string" and kind_at(j) == "string"):
            break
    return parts


def flows(values: dict[str, list[Part]], phrase: bool) -> dict[str, tuple[str, float]]:
    """For each name the most sensitive name that its value flows into, itself included, and how sensitive that is, among
    the names whose values may be phrases or among the others. Names are walked once, the most sensitive ends first."""
    weights = {name: weight for name in values if phrased(name) == phrase and (weight := name_score(name))}
    ends: dict[str, tuple[str, float]] = {}
    for end in sorted(weights, key=weights.__getitem__, reverse=True):
        waiting = [end]
        while waiting:
            name = waiting.pop()
            if name not in ends:
                ends[name] = end, weights[end]
                waiting.extend(part.text for part in values[name] if not part.literal and part.text in values and part.text not in ends)
    return ends


def secrets_by_flow(text: bytes) -> list[tuple[int, int, str, float]]:
    """Literals that end up in names that sound secret: start, end (in bytes), name, score."""
    plain = text.lower().translate(None, b"_.-$")
    if not any(stem in plain for stem in STEMS):
        return []
    made = list(assignments(text))
    if not any(name_score(a.name) for a in made):
        return []
    values: dict[str, list[Part]] = {}
    for a in made:
        values.setdefault(a.name, []).extend(a.parts)
    best: dict[tuple[int, int], tuple[str, float]] = {}
    for phrase, ends in ((kind, flows(values, kind)) for kind in (True, False)):
        for name, (end, weight) in ends.items():
            for part in values[name]:
                if part.literal or part.text not in values and part.end:  # a bare word of a configuration file counts as well
                    look = literal_score(part.text, phrase)
                    score = weight + look if look else 0.0
                    if score >= THRESHOLD and score > best.get((part.start, part.end), ("", 0.0))[1]:
                        best[part.start, part.end] = end, score
    return [(start, end, name, score) for (start, end), (name, score) in best.items()]


def found(text: bytes) -> list[dict]:
    """All spans of a text, by start and kind, in code points."""
    spans: list[tuple[str, int, int, str | None, float | None]] = []
    lower = text.lower()
    if any(hint in lower for hint in HINTS):
        spans += [("assign", *m.span(), m[1].decode(), None) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if b"AKIA" in text:
        spans += [("access", *m.span(), None, None) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    spans += [("hex", *m.span(), None, None) for m in HEX.finditer(text)]
    spans += [("literal", *rest) for rest in secrets_by_flow(text)]
    spans.sort(key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    if text.isascii() or not spans:
        place = lambda at: at
    else:
        ends = sorted({at for s in spans for at in s[1:3]})
        counted, total, last = {}, 0, 0
        for at in ends:  # one pass over the text, whatever the number of spans
            total += len(text[last:at].decode("utf-8"))
            counted[at], last = total, at
        place = counted.__getitem__
    return [{"kind": kind, "start": place(a), "end": place(b), "name": name, "score": score} for kind, a, b, name, score in spans]


SPANS = T.ArrayType(
    T.StructType(
        [T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
         T.StructField("name", T.StringType()), T.StructField("score", T.DoubleType())]
    )
)
ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("score", pa.float64())]))


def scan(docs: DataFrame, text: str = "text", spans: str = "secrets") -> DataFrame:
    """Adds the spans of every whole text; a given column of that name is replaced, all others stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in single(batches, 1000):
            yield replaced(batch, {spans: pa.array([found(x) if x else [] for x in byte_texts(batch.column(text))], ARROW)})

    return docs.mapInArrow(run, T.StructType([*without(docs, spans).schema.fields, T.StructField(spans, SPANS)]))


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(docs: DataFrame) -> DataFrame:
    """Per document: spans of each base kind, a digest of the base spans, and all spans."""
    rows = scan(docs.select("doc_id", "text")).drop("text")
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("secrets", lambda s: s["kind"] != "literal")
    return rows.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("secrets")).alias("spans"),
    )


def redacted(docs: DataFrame, mark: str = "[SECRET]", text: str = "text", length: str | None = None) -> DataFrame:
    """The documents with each stretch that spans cover replaced by the mark; null texts stay null. Where a text has
    changed, the column `length`, if named, gets its new number of characters."""
    spans = F.array_sort("_secrets", lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(0))
    start = F.struct(F.lit("").alias("made"), F.lit(0).cast("long").alias("end"))

    def add(done: Column, span: Column) -> Column:
        between = F.substring(F.col(text), (done["end"] + 1).cast("int"), (span["start"] - done["end"]).cast("int"))
        piece = F.when(span["start"] >= done["end"], F.concat(between, F.lit(mark))).otherwise(F.lit(""))
        return F.struct(F.concat(done["made"], piece).alias("made"), F.greatest(done["end"], span["end"]).alias("end"))

    rest = lambda done: F.concat(done["made"], F.substring(F.col(text), (done["end"] + 1).cast("int"), F.length(text)))
    new = F.when(F.size("_secrets") > 0, F.aggregate(spans, start, add, rest)).otherwise(F.col(text))
    changed = scan(docs, text, "_secrets").withColumn(text, new)
    if length:
        changed = changed.withColumn(length, F.when(F.size("_secrets") > 0, F.length(text).cast("long")).otherwise(F.col(length)))
    return changed.drop("_secrets")
