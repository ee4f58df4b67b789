"""Secret scan: base patterns plus an assignment-aware lexer.

The base patterns are searched over the whole text. The lexer then reads every
``name = literal``, ``name: literal``, ``"name": literal`` and ``name => literal``
pair, joins literals chained by ``+`` or by mere adjacency, follows constants to
the names they are assigned to later, and scores each literal by how sensitive
its target's name is and how much the literal looks like a credential.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField

from .batches import extend, pick, texts_of, unused

# The base kinds in their order, their patterns and least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "named")
_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# Words of a target's name and what they add to a literal's score.
NAME_WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 1.0, "pass": 0.6, "secret": 1.0, "secrets": 1.0,
    "token": 0.9, "tokens": 0.7, "apikey": 1.0, "credential": 1.0, "credentials": 1.0, "auth": 0.6,
    "authorization": 0.8, "bearer": 0.8, "private": 0.5, "access": 0.4, "api": 0.4, "key": 0.5, "signing": 0.4,
    "encryption": 0.4, "master": 0.3, "client": 0.2, "session": 0.3, "cookie": 0.3, "salt": 0.5, "dsn": 0.6,
    "webhook": 0.4, "jwt": 0.9, "pin": 0.4, "pat": 0.4,
}
# Words of a name or literal that speak against a credential.
NAME_AGAINST = {"public": 0.6, "id": 0.3, "name": 0.5, "count": 0.8, "max": 0.5, "min": 0.5, "length": 0.6, "url": 0.3,
                "file": 0.4, "path": 0.4, "type": 0.6, "primary": 0.6, "foreign": 0.6, "index": 0.6}
PLACEHOLDERS = ("example", "changeme", "placeholder", "your", "dummy", "xxxx", "todo", "none", "null", "true", "false")
THRESHOLD = 1.0
# A value that takes more steps to tell is no credential; it bounds the work for each target.
LONGEST = 4096
# Literals of a value that count as often as they stand in it; it only bounds the text that is scored.
REPEATED = 64

# One pair: a dotted name, perhaps an index, a closing quote, an operator; the value follows. No part gives back what
# it took, and a search goes on behind a whole name, so the time is linear in the text.
_DOTTED = re.compile(r"[A-Za-z_$][\w$]*+(?:[.\-][\w$]++)*+")
_INDEX = re.compile(r"""\[["']([\w.\-]++)["']\]""")
_OPERATOR = re.compile(r"[ \t]*+(=>|:=|==|[:=])[ \t]*+")
_QUOTED = re.compile(r"\"((?:[^\"\\\n]|\\.)*+)\"|'((?:[^'\\\n]|\\.)*+)'|`([^`\n]*+)`")
_BARE = re.compile(r"[^\s,;\"'`(){}\[\]<>#]++")
_NAME = re.compile(r"[A-Za-z_$][\w$]*+(?:\.[\w$]++)*+")
_NAME_START = re.compile(r"[A-Za-z_$]")
_JOIN = re.compile(r"[ \t]*(?:\+|\.\.|&)?[ \t]*(?:\\?\n[ \t]*(?:\+[ \t]*)?)?")
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """``(start, kind, end)`` of the base patterns in code points, leftmost and non-overlapping per kind.

    A maximal hex or access run is found whole or not at all, so asking for the
    least length inside the pattern equals dropping short matches afterwards.
    """
    found = []
    low = text.lower()
    if any(hint in low for hint in _HINTS):
        for match in ASSIGN.finditer(text):
            if len(match[2]) >= LEAST_ASSIGN:
                found.append((match.start(), "assign", match.end()))
    if "AKIA" in text:
        for match in ACCESS.finditer(text):
            if match.end() - match.start() >= LEAST_ACCESS:
                found.append((match.start(), "access", match.end()))
    found += [(match.start(), "hex", match.end()) for match in HEX.finditer(text)]
    return found


def name_score(name: str) -> float:
    """How sensitive a target's name is."""
    words = {word.lower() for word in _WORDS.findall(name)}
    joined = "".join(word.lower() for word in _WORDS.findall(name))
    score = sum(weight for word, weight in NAME_WEIGHTS.items() if word in words)
    if "apikey" in joined and "apikey" not in words:
        score += 0.4
    return score - sum(weight for word, weight in NAME_AGAINST.items() if word in words)


def literal_score(value: str) -> float:
    """How much a literal looks like a credential; prose, paths and placeholders score below zero."""
    low = value.lower()
    if len(value) < 6 or any(word in low for word in PLACEHOLDERS) or re.search(r"\s.*\s|^[$%{<]|[}>%]$|://[^@]*$", value):
        return -2.0
    kinds = sum(bool(re.search(kind, value)) for kind in (r"[a-z]", r"[A-Z]", r"\d", r"[^\w\s]"))
    counts = Counter(value)
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    if kinds == 1 and value.isalpha() and len(value) < 24:
        return -0.4
    return 0.15 * kinds + (0.3 if entropy >= 3 else 0.0) + (0.2 if len(value) >= 16 else 0.0)


def _value(text: str, at: int, constants: dict[str, list], bare: _Bare) -> tuple[list, int]:
    """The parts a value is made of, and where it ends; a part is a literal's span or a constant's own parts."""
    parts: list = []
    end = at
    while True:
        if (match := _QUOTED.match(text, at)) and match.lastindex:
            parts.append(match.span(match.lastindex))
        elif (match := _NAME.match(text, at)) and match[0] in constants:
            parts.append(constants[match[0]])
        else:
            break
        end = match.end()
        joined = _JOIN.match(text, end)
        if "+" not in joined[0] and ".." not in joined[0] and "&" not in joined[0] and not _QUOTED.match(text, joined.end()):
            break
        at = joined.end()
    if not parts and bare.stop(at) > at:
        parts, end = [(at, bare.stop(at))], bare.stop(at)
    return parts, end


def _literals(parts: list, long: dict[int, list]) -> list[tuple[int, int]] | None:
    """Every literal of a value in order; after the first ``REPEATED`` each one is told once.

    None for a value that takes more than ``LONGEST`` steps to tell, a step for
    every code point and every constant entered, and for one made of such a value.
    """
    spans: list[tuple[int, int]] = []
    seen, entered, stack, steps = set(), set(), [iter(parts)], 0
    while stack:
        part = next(stack[-1], None)
        if part is None:
            stack.pop()
            continue
        if isinstance(part, list):
            if len(spans) < REPEATED or id(part) not in entered:
                entered.add(id(part))
                stack.append(iter(part))
                steps += 1
        elif len(spans) < REPEATED or part not in seen:
            seen.add(part)
            spans.append(part)
            steps += max(1, part[1] - part[0])
        if steps > LONGEST or (isinstance(part, list) and id(part) in long):
            long[id(parts)] = parts
            return None
    return spans


def _targets(text: str, at: int) -> tuple[int, int, str, str, str | None, str] | None:
    """The next pair from ``at`` on: where it begins, where its value begins, name, whole name, operator."""
    while match := _DOTTED.search(text, at):
        end, index = match.end(), None
        before = text[match.start() - 1] if match.start() > at else ""
        if found := _INDEX.match(text, end):
            end, index = found.end(), found[1]
        for quote in (before, "") if before in ("'", '"') else ("",):
            operator = _OPERATOR.match(text, end + 1) if quote and text[end : end + 1] == quote else None
            if not quote:
                operator = _OPERATOR.match(text, end)
            if operator:
                name = match[0]
                return match.start() - len(quote), operator.end(), name, f"{name}.{index}" if index else name, operator[1]
        at = match.end()
    return None


class _Bare:
    """Ends of bare values; one run of them is measured once, however many names lie in it."""

    def __init__(self, text: str):
        self.text, self.start, self.end = text, 0, 0

    def stop(self, at: int) -> int:
        """Where the bare value at a place ends; the place itself if there is none."""
        if not self.start <= at < self.end:
            match = _BARE.match(self.text, at)
            self.start, self.end = (at, match.end()) if match else (at, at)
        return max(self.end, at)


def named_spans(text: str, threshold: float = THRESHOLD) -> list[tuple[int, str, int]]:
    """Literals that reach a sensitive target, directly or through constants, however many there are.

    A value of more than ``LONGEST`` code points is no credential. The time is
    linear in the text, but for up to ``LONGEST`` steps at a sensitive target.
    """
    if "=" not in text and ":" not in text:
        return []
    constants: dict[str, list] = {}
    tried: dict[int, tuple[list, float]] = {}
    long: dict[int, list] = {}  # by identity, and held so that it stays theirs
    found = set()
    at, bare = 0, _Bare(text)
    while target := _targets(text, at):
        start, begin, plain, name, operator = target
        at = max(begin, start + 1)
        if operator == "==":
            continue
        parts, end = _value(text, begin, constants, bare)
        if not parts:
            continue
        if len(parts) == 1 and isinstance(parts[0], list):
            parts = parts[0]
        if bare.stop(begin) == begin or len(parts) > 1 or text[begin] in "\"'`":
            at = max(at, end)
        if text[begin : begin + 1] in "\"'`" or _NAME_START.match(text, begin):
            constants[plain] = parts
        weight = name_score(name)
        if weight > 0 and (id(parts) not in tried or weight > tried[id(parts)][1]):
            tried[id(parts)] = parts, weight
            spans = _literals(parts, long)
            if spans is None:
                continue
            if weight + literal_score("".join(text[start:stop] for start, stop in spans)) >= threshold:
                found.update((start, "named", stop) for start, stop in spans if stop > start)
    return list(found)


def _order(span: tuple[int, str, int]) -> tuple[int, int, int]:
    return span[0], KINDS.index(span[1]), span[2]


def joined(spans: list[tuple[int, str, int]]) -> str:
    """``kind:start:end`` by start, then kind as listed."""
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in sorted(spans, key=_order))


def redact(text: str, spans: list[tuple[int, str, int]], mark: str = "[secret]") -> str:
    """The text with every union of overlapping spans replaced by ``mark``."""
    parts, at = [], 0
    for start, _, end in sorted(spans):
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


FIELDS = [
    StructField("n_assign", LongType()),
    StructField("n_access", LongType()),
    StructField("n_hex", LongType()),
    StructField("base_spans", StringType()),
    StructField("base_sha256", StringType()),
    StructField("spans", StringType()),
]


def scan_secrets(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: its id, counts of the base kinds, base spans, their digest, all spans.

    Null text counts as empty and has no spans; repeated rows give repeated
    results; columns other than the two named are ignored. One pass, no shuffle.
    """

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        rows = []
        for value in texts_of(batch, text):
            base = base_spans(value)
            kinds = Counter(kind for _, kind, _ in base)
            told = joined(base)
            rows.append((
                kinds["assign"], kinds["access"], kinds["hex"], told,
                hashlib.sha256(told.encode()).hexdigest(), joined([*base, *named_spans(value)]),
            ))
        columns = zip(*rows, strict=True)
        return [pa.array(column, pa.int64() if k < 3 else pa.string()) for k, column in enumerate(columns)]

    found = extend(pick(docs, id_column, text), FIELDS, compute)
    return found.drop(text)


def redact_secrets(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """The rows of ``docs`` with all secrets replaced, and ``length`` set to the new code points.

    Rows without a secret, null text included, come back unchanged, and so do
    all other columns, whatever their names.
    """
    names, types = docs.columns, dict(zip(docs.columns, docs.schema.fields, strict=True))

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        texts, lengths = batch.column(text).to_pylist(), batch.column(length).to_pylist()
        for k, value in enumerate(texts):
            spans = [*base_spans(value), *named_spans(value)] if value else []
            if spans:
                texts[k] = redact(value, spans)
                lengths[k] = len(texts[k])
        return [pa.array(texts, pa.string()), pa.array(lengths, pa.int64())]

    clean = [unused(docs, "clean_text"), unused(docs, "clean_length")]
    out = extend(docs, [StructField(clean[0], StringType()), StructField(clean[1], LongType())], compute)
    swapped = {text: out[f"`{clean[0]}`"], length: out[f"`{clean[1]}`"].cast(types[length].dataType)}
    return out.select(*[swapped[name].alias(name) if name in swapped else out[f"`{name}`"] for name in names])
