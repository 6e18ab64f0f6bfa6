"""Exact token ids by the ``tokenizers`` library, with a bounded cache of chunks.

Both kinds of tokenizer file split a text into pieces before they merge, so a text's ids are those of its chunks in a row
wherever chunks end at a border of pieces. Such borders are certain

* before a single space or line feed between visible characters, and behind such a line feed,
* between a letter or digit and ASCII punctuation,
* between ASCII punctuation other than an apostrophe and an ASCII letter or digit.

Chunks are cut and hashed for a whole batch at once; the library sees each chunk that the cache lacks, and the ids of
a batch are gathered from the cache. Where no border is certain (runs of white space, unusual characters, texts with
what may be a special token) the chunk is simply longer, up to the whole text. Long chunks are not cached.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa

from tidemark.llm import common

#: Bytes of a worker's cache, beyond which it starts anew; bytes of a chunk that may enter it; chunks told to the library
#: in one text.
CACHE_BYTES, LONG, JOINED = 32 << 20, 128, 512
_OPEN: dict[tuple[str, bool], Encoder] = {}

# Kinds of bytes: visible, letter or digit, punctuation, inner byte; first bytes of two-byte letters (but C3 97, C3 B7, C4 B0),
# of two-byte and of three-byte characters that are not white; space or line feed.
_SEEN, _ALNUM, _PUNCT, _INNER, _LETTER2, _SEEN2, _SEEN3, _BLANK = (1 << i for i in range(8))


def _kinds() -> bytes:
    b = np.arange(256)
    upper, lower, digit = (b >= 65) & (b <= 90), (b >= 97) & (b <= 122), (b >= 48) & (b <= 57)
    seen, alnum = (b > 32) & (b < 127), upper | lower | digit
    parts = (seen, alnum, seen & ~alnum, (b >= 0x80) & (b < 0xC0), np.isin(b, [0xC3, 0xC4, 0xC5, 0xD0, 0xD1]), (b >= 0xC3) & (b < 0xE0), (b >= 0xE4) & (b < 0xEE), (b == 32) | (b == 10))
    return sum(p.astype(np.uint8) << i for i, p in enumerate(parts)).astype(np.uint8).tobytes()


_KINDS = _kinds()
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Second bytes (after C3) of letters; where case is folded, of small letters only.
_AFTER_C3 = {spaced: np.isin(np.arange(256), [b for b in range(0x80 if spaced else 0x9F, 0xC0) if b not in (0x97, 0xB7)]) for spaced in (True, False)}


def _odd(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """The texts that may hold a special token (``<|``)."""
    at = np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C)) if len(data) > 1 else np.zeros(0, np.int64)
    return np.unique(np.searchsorted(offs, at, "right") - 1)


def cuts(raw: bytes, offs: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """Places, ascending, at which a chunk begins: each text's beginning and every certain border inside it."""
    n = len(raw)
    data = np.frombuffer(raw, np.uint8)
    kind = np.frombuffer(b"\0\0\0" + raw.translate(_KINDS) + b"\0", np.uint8)
    at = lambda k: kind[3 + k : 3 + k + n]
    here, last = at(0), at(-1)
    seen, alnum = last & _SEEN, last & _ALNUM
    if np.bitwise_or.reduce(here) & _INNER:
        inner = (last & _INNER) != 0
        seen = seen | (inner & (((at(-2) & _SEEN2) | (((at(-2) & _INNER) != 0) & ((at(-3) & _SEEN3) != 0))) != 0))
        letter = inner & ((at(-2) & _LETTER2) != 0)
        sign = ((data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))) | ((data[:-1] == 0xC4) & (data[1:] == 0xB0))
        sign = np.flatnonzero(sign) + 2  # neither letters, nor one that folding parts from its dot
        letter[sign[sign < n]] = False
        alnum = alnum | letter
    blank = ((here & _BLANK) != 0) & (seen != 0) & ((at(1) & (_SEEN | _SEEN2 | _SEEN3)) != 0)
    out = blank | ((alnum != 0) & ((here & _PUNCT) != 0)) | (((last & _PUNCT) != 0) & ((here & _ALNUM) != 0))
    quote = np.flatnonzero(data == 0x27) + 1
    quote = quote[quote < n]
    out[quote] &= (here[quote] & _ALNUM) == 0
    feed = np.flatnonzero(blank & (data == 10)) + 1
    out[feed[feed < n]] = True
    # beside another text's end no rule holds; every text begins a chunk
    for k in (-1, 0, 1):
        edge = offs[1:-1] + k
        out[edge[(edge >= 0) & (edge < n)]] = False
    for i in odd.tolist():
        out[offs[i] : offs[i + 1]] = False
    out[offs[:-1][offs[1:] > offs[:-1]]] = True
    return np.flatnonzero(out)


def _letters(raw: bytes, spaced: bool) -> np.ndarray:
    """Running count of the bytes that are no part of a plain letter, from 0."""
    data = np.frombuffer(raw, np.uint8)
    other = (np.frombuffer(raw.translate(_KINDS), np.uint8) & _ALNUM) == 0
    other[(data >= 48) & (data <= 57)] = True
    first = np.flatnonzero(data[:-1] == 0xC3)
    first = first[_AFTER_C3[spaced][data[first + 1]]]
    other[first] = other[first + 1] = False
    return np.concatenate([[0], np.cumsum(other, dtype=np.int32)])


class Encoder:
    """``spaced``: white space is part of tokens (byte-level files); else it only separates words, and case is folded."""

    def __init__(self, path: str, spaced: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tok, self.spaced = Tokenizer.from_file(path), spaced
        self.plain = self.tok if spaced else Tokenizer.from_file(path)
        # chunks of plain letters are told in one text: their tokens show where one begins (a space) or ends
        words = self.tok.get_vocab()
        self.edge = np.zeros(max(words.values()) + 1, bool)
        self.edge[[i for w, i in words.items() if (w.startswith("\u0120") if spaced else w.endswith("</w>"))]] = True
        self.dot = words["."]
        if not spaced:  # neither composition nor folding changes these letters, and blanks part them
            self.plain.normalizer = normalizers.Sequence([])
            self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        for t in (self.tok, self.plain):
            t.model._resize_cache(0)  # no chunk comes twice
        self.clear()

    def clear(self) -> None:
        self.keys, self.row = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.first, self.size, self.ids = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def _told(self, raw: bytes, start: np.ndarray, end: np.ndarray, lead: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain chunks in a row, and the number for each; the library gets many in one text, each after ``lead``."""
        parts, counts = [], [np.zeros(0, np.int64)]
        for i in range(0, len(start), JOINED):
            text = lead + lead.join([raw[x:y] for x, y in zip(start[i : i + JOINED].tolist(), end[i : i + JOINED].tolist(), strict=True)])
            ids = np.array(self.plain.encode_batch_fast([text.decode()], add_special_tokens=False)[0].ids, np.int32)
            edge = np.flatnonzero(ids == self.dot if lead == b"." else self.edge[ids])
            n = np.diff(edge, append=len(ids)) if self.spaced else np.diff(edge, prepend=-1)
            if lead == b".":
                ids, n = np.delete(ids, edge), n - 1
            parts.append(ids)
            counts.append(n)
        return np.concatenate([np.zeros(0, np.int32), *parts]), np.concatenate(counts)

    def _encode(self, raw: bytes, start: np.ndarray, end: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks in a row, and the number for each; ``whole`` ones may hold special tokens."""
        other, byte = _letters(raw, self.spaced), np.frombuffer(raw, np.uint8)
        space = byte[start] == 0x20
        plain = ~whole & (end > start + space) & (other[end] == other[start + space])
        groups = [np.flatnonzero(plain & space), np.flatnonzero(plain & ~space), np.flatnonzero(~plain)]
        got = [self._told(raw, start[groups[0]], end[groups[0]], b""), self._told(raw, start[groups[1]], end[groups[1]], b"." if self.spaced else b" ")]
        rest = [raw[i:j].decode() for i, j in zip(start[groups[2]].tolist(), end[groups[2]].tolist(), strict=True)]
        each = [e.ids for e in self.tok.encode_batch_fast(rest, add_special_tokens=False)]
        got.append((np.fromiter(chain.from_iterable(each), np.int32), np.fromiter(map(len, each), np.int64, len(each))))
        order, size = np.concatenate(groups), np.concatenate([n for _, n in got])
        counts, at = np.empty(len(start), np.int64), np.empty(len(start), np.int64)
        counts[order], at[order] = size, np.cumsum(size) - size
        return np.concatenate([i for i, _ in got])[common.ragged(at, counts)], counts

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a batch in a row, and each text's number of ids. No text is null."""
        data, offs = common.buffer_of(col)
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(offs) - 1, np.int64)
        odd, raw = _odd(data, offs), data.tobytes()
        start = cuts(raw, offs, odd)
        end = np.append(start[1:], len(raw))
        if not self.spaced:
            whole = [raw[offs[i] : offs[i + 1]] for i in odd.tolist()]
            raw = raw.translate(_LOWER)
            for i, t in zip(odd.tolist(), whole, strict=True):
                raw = raw[: offs[i]] + t + raw[offs[i + 1] :]
            data = np.frombuffer(raw, np.uint8)
            blank = (data[start] == 0x20) | (data[start] == 0x0A)  # blanks before and between chunks are dropped
            blank[np.isin(start, offs[odd])] = False
            start = start + blank
            start, end = start[end > start], end[end > start]
        key = common.range_hashes(data, start, end)
        whole = np.isin(start, offs[odd])
        long = whole | (end - start > LONG)
        short = np.flatnonzero(~long)
        coded = pa.array(key[short]).dictionary_encode()
        names, at = coded.dictionary.to_numpy(zero_copy_only=False), coded.indices.to_numpy(zero_copy_only=False)
        lead = np.zeros(len(names), np.int64)
        lead[at[::-1]] = short[::-1]
        order = np.argsort(names)
        names, lead = names[order], lead[order]
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        place = np.searchsorted(self.keys, names)
        known = np.zeros(len(names), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == names[inside]
        new = np.flatnonzero(~known)
        told = np.concatenate([lead[new], np.flatnonzero(long)])
        ids, size = self._encode(raw, start[told], end[told], whole[told])
        rows = np.empty(len(names), np.int64)
        rows[known] = self.row[place[known]]
        have = len(self.size)
        rows[new] = have + np.arange(len(new))
        first = np.concatenate([self.first, len(self.ids) + np.cumsum(size) - size])
        every, sizes = np.concatenate([self.ids, ids]), np.concatenate([self.size, size.astype(np.int32)])
        # each chunk's row, and the ids of all
        row = np.empty(len(start), np.int64)
        row[short] = rows[rank[at]]
        row[long] = have + len(new) + np.arange(int(long.sum()))
        n = sizes[row].astype(np.int64)
        out = every[common.ragged(first[row], n)]
        ends = np.concatenate([[0], np.cumsum(n)])
        text = ends[np.searchsorted(start, offs)]
        self._keep(names[new], place[new], have, first, sizes, every, len(new))
        return out, np.diff(text)

    def _keep(self, keys: np.ndarray, place: np.ndarray, have: int, first: np.ndarray, sizes: np.ndarray, every: np.ndarray, new: int) -> None:
        if not new:
            return
        total = int(first[have + new]) if have + new < len(first) else len(every)
        if 20 * (have + new) + 4 * total > CACHE_BYTES:
            self.clear()
            return
        self.row = np.insert(self.row, place, have + np.arange(new, dtype=np.int32))
        self.keys = np.insert(self.keys, place, keys)
        self.first, self.size, self.ids = first[: have + new].astype(np.int32), sizes[: have + new].copy(), every[:total].copy()


def encoder(path: str, spaced: bool) -> Encoder:
    """One per worker process, kept from task to task; its cache is bounded."""
    if (path, spaced) not in _OPEN:
        _OPEN[path, spaced] = Encoder(path, spaced)
    return _OPEN[path, spaced]
