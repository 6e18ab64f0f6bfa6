"""Basic and word-piece tokenising for encoder models, in Arrow batches."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


_BLANKS = re.compile(r"[ \t\n\r]+")
#: Longest run of characters between blanks whose pieces a task remembers.
MOST_KEPT = 200


def is_space(c: str) -> bool:
    return c in " \t\n\r" or unicodedata.category(c) == "Zs"


def is_control(c: str) -> bool:
    return c not in "\t\n\r" and unicodedata.category(c) in ("Cc", "Cf")


def is_punctuation(c: str) -> bool:
    """Unicode punctuation, and every ASCII sign that is no letter, digit or space."""
    n = ord(c)
    return 33 <= n <= 47 or 58 <= n <= 64 or 91 <= n <= 96 or 123 <= n <= 126 or unicodedata.category(c).startswith("P")


def is_ideograph(c: str) -> bool:
    # The blocks of unified ideographs.
    blocks = ((0x4E00, 0x9FFF), (0x3400, 0x4DBF), (0x20000, 0x2A6DF), (0x2A700, 0x2B73F), (0x2B740, 0x2B81F), (0x2B820, 0x2CEAF), (0xF900, 0xFAFF), (0x2F800, 0x2FA1F))
    return any(a <= ord(c) <= b for a, b in blocks)


def basic(text: str, lower: bool = True) -> list[str]:
    """Words, signs and ideographs; control characters go; lower case also drops accents."""
    spaced = []
    for c in text:
        if ord(c) in (0, 0xFFFD) or is_control(c):
            continue
        spaced.append(" " if is_space(c) else f" {c} " if is_ideograph(c) else c)
    out = []
    for word in "".join(spaced).split():
        if lower:
            word = "".join(c for c in unicodedata.normalize("NFD", word.lower()) if unicodedata.category(c) != "Mn")
        run = ""
        for c in word:
            if is_punctuation(c):
                out += [run, c] if run else [c]
                run = ""
            else:
                run += c
        if run:
            out.append(run)
    return out


def pieces(word: str, vocab: frozenset[str] | dict[str, int], unknown: str = "[UNK]", most: int = 200) -> list[str]:
    """Longest known prefix first; later pieces begin with ``##``; a word with an unknown rest is unknown."""
    if len(word) > most:
        return [unknown]
    out, at = [], 0
    while at < len(word):
        for end in range(len(word), at, -1):
            piece = ("##" if at else "") + word[at:end]
            if piece in vocab:
                out.append(piece)
                at = end
                break
        else:
            return [unknown]
    return out


def tokenize(docs: DataFrame, vocab: list[str], lower: bool = True, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, tokens of each text. The vocabulary is the model's file, of bounded size."""
    known = frozenset(vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, list[str]] = {}
        for b in batches:
            out = []
            for t in b.column("text").to_pylist():
                row: list[str] = []
                for run_ in _BLANKS.split(t or ""):  # what stands between blanks is split by itself, so it is split once
                    got = cache.get(run_)
                    if got is None:
                        got = [p for w in basic(run_, lower) for p in pieces(w, known)]
                        if len(cache) > 200_000:
                            cache.clear()
                        if len(run_) <= MOST_KEPT:
                            cache[run_] = got
                    row += got
                out.append(row)
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(out, pa.list_(pa.string()))], [key, "tokens"])

    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(run, f"{key} long, tokens array<string>")


def features(tokens: list[str], ids: dict[str, int], length: int = 128) -> tuple[list[int], list[int]]:
    """Ids of [CLS] tokens [SEP], cut and padded to ``length``, and the mask of real ones."""
    cut = ["[CLS]", *tokens[: length - 2], "[SEP]"]
    row = [ids.get(t, ids.get("[UNK]", 0)) for t in cut]
    return row + [0] * (length - len(row)), [1] * len(row) + [0] * (length - len(row))
