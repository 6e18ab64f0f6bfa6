"""Raw pages: texts by selectors, in batches."""

from __future__ import annotations

import html as entities
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import html as markup

#: Fields of one text, fields of one text for each element, and the shortest text of a page that is kept.
SIMPLE = ("text", "title", "author", "datetime", "num_views", "num_likes", "num_comments", "num_shares")
LISTS = ("tags", "categories")
LEAST_TEXT = 10


def extract(pages: DataFrame, tag: str = "article", least: int = 10, key: str = "page_id", html: str = "html", decode: Callable[[str], str] = entities.unescape) -> DataFrame:
    """key, text: texts inside ``tag`` and outside scripts and styles, stripped and joined by line feeds; null under
    ``least`` characters. A null page has no text; a page of any length is read once. ``decode``: for the references in texts."""
    wanted = [markup.compile_selector(tag)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for h in b.column("html").to_pylist():
                pieces = markup.select(h or "", wanted, frozenset({"script", "style"}), decode)[0].texts
                text = "\n".join(t.strip() for t in pieces if t.strip())
                out.append(text if len(text) >= least else None)
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(out, pa.string())], [key, "text"])

    return pages.select(F.col(key).cast("long").alias("key"), F.col(html).alias("html")).mapInArrow(run, f"{key} long, text string")


def fields(
    pages: DataFrame, rules: dict[str | None, dict[str, str]], *, source: str = "source", key: str = "page_id", html: str = "html", least: int = LEAST_TEXT,
    decode: Callable[[str], str] = entities.unescape,
) -> DataFrame:
    """key, the simple fields, the list fields, html: what each source's selectors find in its pages.

    ``rules``: source, then field to selector; those of None serve sources without their own, and without either a page has
    no row. A simple field is all text nodes inside the selected elements (scripts too), joined by line feeds and stripped;
    ``num_`` fields are whole numbers, 0 where the text is none. A list field has one such text for each element, empty ones
    left out. A field without a selector is null. A page whose ``text`` has a selector and comes out shorter than ``least``
    goes; ``html`` is the source of the elements of ``text``. Null html: an empty page. Rows with one id are pages of their
    own. Other columns are not read. ``decode``: for the references in texts. The rules go with the tasks; they are a line for each source and field.
    """
    compiled = {s: {f: markup.compile_selector(x) for f, x in r.items()} for s, r in rules.items()}
    unknown = {f for r in rules.values() for f in r} - {*SIMPLE, *LISTS}
    if unknown:
        raise ValueError(f"no such fields: {sorted(unknown)}")
    kinds = {**{f: pa.int64() if f.startswith("num_") else pa.string() for f in SIMPLE}, **{f: pa.list_(pa.string()) for f in LISTS}, "html": pa.string()}

    def one(page: str, own: dict) -> dict | None:
        found = dict(zip(own, markup.select(page, list(own.values()), decode=decode), strict=True))
        out = {}
        for f, got in found.items():
            if f in LISTS:
                out[f] = [t for t in ("\n".join(e).strip() for e in got.elements()) if t]
                continue
            text = "\n".join(got.texts).strip()
            if f == "text":
                if len(text) < least:
                    return None
                out["html"] = "\n".join(page[a:b] for a, b in got.spans)
            out[f] = text if not f.startswith("num_") else number(text)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, ids = [], []
            for i, s, h in zip(b.column("key").to_pylist(), b.column("source").to_pylist(), b.column("html").to_pylist(), strict=True):
                own = compiled.get(s, compiled.get(None))
                if own is not None and (got := one(h or "", own)) is not None:
                    rows.append(got)
                    ids.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *[pa.array([r.get(f) for r in rows], k) for f, k in kinds.items()]], [key, *kinds])

    schema = ", ".join([f"{key} long", *[f"{f} {'long' if f.startswith('num_') else 'string'}" for f in SIMPLE], *[f"{f} array<string>" for f in LISTS], "html string"])
    return pages.select(F.col(key).cast("long").alias("key"), F.col(source).cast("string").alias("source"), F.col(html).alias("html")).mapInArrow(run, schema)


def number(text: str) -> int:
    """A whole number of 18 digits at most, else 0."""
    text = text.strip()
    digits = text[1:] if text[:1] in ("+", "-") else text
    return int(text) if digits.isascii() and digits.isdigit() and len(digits) <= 18 else 0


def title(html: Column) -> Column:
    return F.trim(F.regexp_extract(html, r"(?is)<title[^<>]*+>(.*?)(?:</title>|\z)", 1))


def declared_language(html: Column) -> Column:
    return F.regexp_extract(html, r'<html lang="([a-z]+)"', 1)
