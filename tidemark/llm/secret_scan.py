"""Operator 10: secret scan with assignment-aware lexing.

Three base patterns (assign, access, hex) are always reported. The method then reads source and configuration syntax
as name-value pairs: it finds assignment signs, takes the name before and the expression after (quoted literals,
joined by ``+`` or ``.`` or by mere adjacency, and names bound before). Where that finds no literal and the place has
the shape of configuration (a name that begins its line, or ``name=value`` without spaces), the unquoted text up to the
line's end, a comment or the next setting is the value, and signs inside it are text; calls, references and bare words
are no values. The method propagates constants in text order, and scores the value by how sensitive the target's name is
and how random the value looks. Literals of a value over the threshold are reported as kind ``literal`` unless base spans
cover the whole of them.

A value is a tree whose leaves are literals; a name that is bound to it only refers to it. Lengths, kinds of characters
and their counts are added up along the tree, and a literal is reported once, so time and memory follow the text's
length, whatever is joined or doubled; no literal, name or line is too long.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common

KINDS = ("assign", "access", "hex", "literal")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Parts of names and what each adds to a score.
SENSITIVE = {
    "password": 3.0, "passwd": 3.0, "pwd": 3.0, "passphrase": 3.0, "secret": 3.0, "token": 2.5, "apikey": 3.0, "api key": 3.0,
    "access key": 3.0, "private key": 3.0, "secret key": 3.0, "auth key": 2.5, "encryption key": 3.0, "signing key": 3.0,
    "credential": 2.5, "credentials": 2.5, "bearer": 2.5, "authorization": 2.0, "client secret": 3.0, "webhook": 1.5,
}
#: Values that stand for a secret.
PLACEHOLDERS = re.compile(r"(?i)change.?me|example|placeholder|dummy|your[_-]|xxxx|\*\*\*|<[^<>]*>|\$\{|\{\{")
EMPTY_WORDS = frozenset({"none", "null", "true", "false", "test", "todo"})
THRESHOLD = 4.0

_SIGN = re.compile(r"(:=|=>|=(?![=>])|:(?![:/=]))[ \t]*+(?=[^\s])")
_NAME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.-")
_ITEM = re.compile(r"""[ \t]*+(?:"([^"\\\n]*+(?:\\.[^"\\\n]*+)*+)"|'([^'\\\n]*+(?:\\.[^'\\\n]*+)*+)'|`([^`\n]*+)`|([A-Za-z_][A-Za-z0-9_.]*+))""")
#: What may stand before a name that begins its line.
_LEAD = re.compile(r"[ \t]*+(?:(?:export|set|setx|env|ENV|ARG|-)[ \t]+)?[{\"']?\Z")
#: Where an unquoted value ends: before a comment, or a separator and the next setting.
_END = re.compile(r"(?<![ \t])[ \t]++(?:#|;|//)|[;,&][ \t]*+(?=[A-Za-z_][A-Za-z0-9_.\-]*+[ \t]*+[=:])|[\r\n]")
_TIGHT = re.compile(r"[^\s;,&|\"'`<>]+")
_CODE = re.compile(r"[A-Za-z_][\w.]*[ \t]*[(\[]|[$%@&!*|>({\[]|\d+(\.\d+)?\Z|(?i:null|none|true|false)\Z")
_BARE = re.compile(r"[A-Za-z_.]+\Z")
_JOIN = re.compile(r"[ \t]*(?:\+|\.\.|&)[ \t]*|[ \t]*(?=[\"'])")
_CAMEL = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the three base kinds, by start and kind."""
    out = []
    low = text.lower() if (":" in text or "=" in text) else ""
    if any(w in low for w in _WORDS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def name_score(name: str) -> float:
    parts = [p.lower() for p in _CAMEL.findall(name)]
    flat = " " + " ".join(parts) + " "
    return max([0.0, *(v for k, v in SENSITIVE.items() if f" {k} " in flat)])


class Value:
    """A literal (``span``), or the join of other values; ``sums`` are of the whole tree."""

    __slots__ = ("parts", "reported", "span", "sums")

    def __init__(self, span: tuple[int, int] | None = None, parts: tuple[Value, ...] = ()):
        self.span, self.parts, self.sums, self.reported = span, parts, None, False

    def literals(self, text: str) -> Iterator[str]:
        """The literals in order; a value that doubles itself has very many."""
        stack = [self]
        while stack:
            v = stack.pop()
            if v.span is not None:
                yield text[slice(*v.span)]
            stack += reversed(v.parts)


def _leaf_sums(value: str) -> tuple:
    """Length, whether it can be no secret, kinds of characters as bits, counts of characters (beyond ASCII, of 64 groups)."""
    kinds = sum(bool(re.search(p, value)) << i for i, p in enumerate((r"[a-z]", r"[A-Z]", r"\d", r"[^A-Za-z0-9]")))
    counts: dict[int, int] = {}
    for c, n in Counter(value).items():
        k = ord(c) if ord(c) < 128 else 128 + ord(c) % 64
        counts[k] = counts.get(k, 0) + n
    return len(value), " " in value or PLACEHOLDERS.search(value) is not None, kinds, counts


def sums_of(value: Value, text: str) -> tuple:
    stack = [value]
    while stack:
        v = stack[-1]
        if v.sums is None and (todo := [p for p in v.parts if p.sums is None]):
            stack += todo
            continue
        stack.pop()
        if v.sums is None and v.span is not None:
            v.sums = _leaf_sums(text[slice(*v.span)])
        elif v.sums is None:
            size, plain, kinds, counts = 0, False, 0, {}
            for p in v.parts:
                size, plain, kinds = size + p.sums[0], plain or p.sums[1], kinds | p.sums[2]
                for k, n in p.sums[3].items():
                    counts[k] = counts.get(k, 0) + n
            v.sums = size, plain, kinds, counts
    return value.sums


def entropy(counts: dict[int, int]) -> float:
    """Bits for each character."""
    n = sum(counts.values())
    return -sum(c / n * math.log2(c / n) for c in counts.values()) if n else 0.0


def value_score(value: Value, text: str) -> float:
    """0 for prose, placeholders and short values; else up to 3 by length, kinds of characters and entropy."""
    size, plain, kinds, counts = sums_of(value, text)
    if size < 6 or plain or (value.span is not None and text[slice(*value.span)].lower() in EMPTY_WORDS):
        return 0.0
    return 0.5 * (size >= 12) + 0.5 * min(kinds.bit_count(), 3) + (entropy(counts) >= 3.0) * 1.0


def name_before(text: str, end: int) -> tuple[str, int]:
    """The name that ends at ``end``, quoted or not, and where it begins; '' where there is none."""
    j = end - (text[end - 1 : end] == "]")
    j -= text[j - 1 : j] in ("'", '"')
    i = j
    while i and text[i - 1] in _NAME_CHARS:
        i -= 1
    while i < j and not (text[i].isalpha() or text[i] == "_"):
        i += 1
    return text[i:j], i


def unquoted(text: str, name: str, start: int, sign: int, at: int, line: int | None) -> tuple[int, int] | None:
    """The span of an unquoted value from ``at`` on, where the name, which begins at ``start``, stands as in configuration;
    ``line``: where its line begins, if no other sign is before it there."""
    tight = text[sign:at] == "="
    if line is not None and _LEAD.match(text, line, start):
        end = m.start() if (m := _END.search(text, at)) else len(text)
        end = at + len(text[at:end].rstrip(" \t;,"))
    elif tight and (m := _TIGHT.match(text, at)):
        end = m.end()
    else:
        return None
    if end <= at or text[at] in "\"'`" or _CODE.match(text, at, end):
        return None
    if _BARE.match(text, at, end) and not (tight and name.isupper()):
        return None
    return at, end


def pairs(text: str) -> Iterator[tuple[str, Value]]:
    """(name, value) of each assignment whose value resolves to literals, in text order."""
    known: dict[str, Value] = {}
    line, seen, fresh, taken = 0, 0, True, 0
    for m in _SIGN.finditer(text):
        if m.start() < taken:  # inside an unquoted value
            continue
        sign = m.start()
        while sign and text[sign - 1] in " \t":
            sign -= 1
        name, start = name_before(text, sign)
        feed = text.rfind("\n", seen, m.start())
        if feed >= 0:
            line, fresh = feed + 1, True
        first, fresh, seen = fresh, False, m.start()
        if not name:
            continue
        parts, at = [], m.end()
        while item := _ITEM.match(text, at):
            if item[4] is not None:
                if item[4] not in known:
                    parts = []
                    break
                parts.append(known[item[4]])
            else:
                parts.append(Value(item.span(next(i for i in (1, 2, 3) if item[i] is not None))))
            at = item.end()
            step = _JOIN.match(text, at)
            if not step:
                break
            at = step.end()
        if parts:
            known[name] = value = parts[0] if len(parts) == 1 else Value(parts=tuple(parts))
            yield name, value
        elif name_score(name) and (span := unquoted(text, name, start, m.start(), m.end(), line if first else None)):
            taken = span[1]
            yield name, Value(span)


def united(spans: list[tuple[int, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the union of ``spans``, which come in order of their starts."""
    starts, ends = [], []
    for i, _, j in spans:
        if ends and i <= ends[-1]:
            ends[-1] = max(ends[-1], j)
        else:
            starts.append(i)
            ends.append(j)
    return starts, ends


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and the method's further ones, as (start, kind, end)."""
    base = base_spans(text)
    more = set()
    for name, value in pairs(text):
        if value.reported or not (s := name_score(name)) or s + value_score(value, text) < THRESHOLD:
            continue
        stack = [value]
        while stack:
            v = stack.pop()
            if v.reported:
                continue
            v.reported = True
            stack += v.parts
            if v.span is not None and v.span[1] - v.span[0] >= 3:
                more.add((v.span[0], 3, v.span[1]))
    starts, ends = united(base)

    def covered(lo: int, hi: int) -> bool:
        k = bisect_right(starts, lo) - 1
        return k >= 0 and hi <= ends[k]

    return base, sorted(x for x in more if not covered(x[0], x[2]))


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{i}:{j}" for i, k, j in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in common.steps(batches):
        counts, digest, spans = [[], [], []], [], []
        for t in b.column("text").to_pylist():
            base, more = scan(t)
            for k in range(3):
                counts[k].append(sum(x[1] == k for x in base))
            digest.append(hashlib.sha256(_joined(base).encode()).hexdigest())
            spans.append(_joined(sorted(base + more)))
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digest, pa.string()), pa.array(spans, pa.string())],
            ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
        )


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: counts of base kinds, sha256 of the base spans, and all spans by start and kind.

    Null or empty text: no spans. Rows with one id, or a null one, are scanned each for itself; other columns are not
    read. Positions are code points, ends exclusive.
    """
    return common.texts(docs, id_col, text_col).mapInArrow(
        _scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[REDACTED]") -> DataFrame:
    """``docs`` with every span of its text replaced by ``mark``; spans that overlap or touch a replaced one go with it.

    All rows and columns stay, in their types: null and empty texts as they are, rows with one id or a null id each for
    itself, further columns of whatever name untouched. Empty table: no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            i, out = b.schema.get_field_index(text_col), []
            for t in b.column(i).to_pylist():
                if t:
                    base, more = scan(t)
                    at, done = 0, []
                    for lo, _, hi in sorted(base + more):
                        if lo >= at:
                            done += [t[at:lo], mark]
                        at = max(at, hi)
                    t = "".join([*done, t[at:]]) if done else t
                out.append(t)
            yield b.set_column(i, b.schema.field(i), pa.array(out, b.schema.field(i).type))

    return docs.mapInArrow(run, docs.schema)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
