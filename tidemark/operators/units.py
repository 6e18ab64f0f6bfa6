"""Vectors of nested units: pieces to words, words to sentences, sentences to a text; and models applied in batches.

A sentence is an array of units (unit, vector), a text an array of sentences. Pooling works on Arrow batches without a
shuffle, in time linear in the units: as nested column expressions each level is computed anew in the next one's lambda,
and a text of 20,000 pieces took minutes. All vectors of a column have one length, and no unit or vector of the input is
null. Null texts and sentences are as ones without units. A unit pooled from none has the empty string and a null vector.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

#: Marks a piece that goes on with its word. Fixed value: the encoder's vocabulary.
GOES_ON = "##"
POOLINGS = ("Average", "Max", "Average+Max")
UNIT = "struct<unit:string,vector:array<double>>"
_UNIT = pa.struct([("unit", pa.string()), ("vector", pa.list_(pa.float64()))])


def _matrix(vectors: pa.Array) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)
    width = len(flat) // len(vectors) if len(vectors) else 0
    if len(vectors) and not (np.diff(vectors.offsets.to_numpy()) == width).all():
        raise ValueError("vectors must have one length")
    return flat.reshape(len(vectors), width)


def pooled(m: np.ndarray, size: np.ndarray, how: str) -> np.ndarray:
    """Rows of ``m`` in runs of ``size`` (none 0) as one row each: their average, their greatest, or both."""
    if how not in POOLINGS:
        raise ValueError(f"pooling must be one of {POOLINGS}: {how}")
    if not len(size):
        return np.zeros((0, m.shape[1] * (1 + (how == "Average+Max"))))
    at = np.cumsum(size) - size
    mean = np.add.reduceat(m, at) / size[:, None] if how != "Max" else m[:0]
    top = np.maximum.reduceat(m, at) if how != "Average" else m[:0]
    return np.hstack([mean, top]) if how == "Average+Max" else mean if how == "Average" else top


def _units(names: list[str], size: np.ndarray, m: np.ndarray) -> pa.Array:
    """Units of these names; the rows of ``m`` are the vectors of those with a size, the others' are null."""
    ends = np.append(0, np.cumsum(np.where(size > 0, m.shape[1], 0))).astype(np.int32)
    vectors = pa.ListArray.from_arrays(pa.array(ends), pa.array(m.reshape(-1)), mask=pa.array(size == 0))
    return pa.StructArray.from_arrays([pa.array(names, pa.string()), vectors], fields=list(_UNIT))


def _lists(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Where each list ends, from 0 on, and their items; a null list has none."""
    size = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    return np.append(0, np.cumsum(size)), column.flatten()


def _joined(names: list[str], ends: np.ndarray) -> list[str]:
    clean = [n.replace(GOES_ON, "") + " " for n in names]
    return ["".join(clean[a:b]) for a, b in zip(ends, ends[1:])]


def _inner(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the lists' items but the first and last, the encoder's marks, and how many each list has."""
    n = np.diff(ends)
    keep = np.ones(ends[-1], bool)
    keep[ends[:-1][n > 0]] = keep[ends[1:][n > 0] - 1] = False
    return np.flatnonzero(keep), np.maximum(n - 2, 0)


def _words(sentences: pa.Array) -> pa.Array:
    ends, units = _lists(sentences)
    at, n = _inner(ends)
    names = [units.field("unit")[int(i)].as_py() for i in at]
    first = np.array([GOES_ON not in x for x in names], bool)
    first[(np.cumsum(n) - n)[n > 0]] = True
    begin = np.flatnonzero(first)
    size = np.diff(np.append(begin, len(at)))
    words = [names[b] + "".join(x.replace(GOES_ON, "") for x in names[b + 1 : b + s]) for b, s in zip(begin.tolist(), size.tolist(), strict=True)]
    each = np.append(0, np.cumsum(first))[np.append(0, np.cumsum(n))]
    return pa.ListArray.from_arrays(pa.array(each.astype(np.int32)), _units(words, size, pooled(_matrix(units.field("vector"))[at], size, "Average")))


def _sentences(sentences: pa.Array, how: str) -> pa.Array:
    ends, units = _lists(sentences)
    at, n = _inner(ends)
    names = [units.field("unit")[int(i)].as_py() for i in at]
    return _units(_joined(names, np.append(0, np.cumsum(n))), n, pooled(_matrix(units.field("vector"))[at], n[n > 0], how))


def _text(texts: pa.Array, how: str) -> pa.Array:
    ends, units = _lists(texts)
    some = units.field("vector").is_valid().to_numpy(zero_copy_only=False)
    n = np.diff(np.append(0, np.cumsum(some))[ends])
    m = _matrix(units.field("vector").filter(pa.array(some)))
    return _units(_joined(units.field("unit").to_pylist(), ends), n, pooled(m, n[n > 0], how))


def _mapped(rows: DataFrame, column: str, kind: str, f: Callable[[pa.Array], pa.Array]) -> DataFrame:
    """``rows`` with ``column`` replaced by f of it, in its place."""
    fields = ", ".join(f"`{x.name}` {kind if x.name == column else x.dataType.simpleString()}" for x in rows.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([f(c) if n == column else c for n, c in zip(b.schema.names, b.columns, strict=True)], b.schema.names)

    return rows.mapInArrow(run, fields)


def _nested(f: Callable[[pa.Array], pa.Array]) -> Callable[[pa.Array], pa.Array]:
    """f of the lists within each list."""

    def run(column: pa.Array) -> pa.Array:
        ends, inside = _lists(column)
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), f(inside))

    return run


def to_words(rows: DataFrame, column: str) -> DataFrame:
    """Sentences of pieces as sentences of words. A sentence's first and last piece go; one with the mark goes on with the
    word before it, of which there is none at the beginning; a word's vector is the average of its pieces'."""
    return _mapped(rows, column, f"array<array<{UNIT}>>", _nested(_words))


def to_sentences(rows: DataFrame, column: str, how: str = "Average") -> DataFrame:
    """Sentences of units as units, of all units but the first and last: strings without marks, each followed by a blank."""
    return _mapped(rows, column, f"array<{UNIT}>", _nested(lambda c: _sentences(c, how)))


def to_text(rows: DataFrame, column: str, how: str = "Average") -> DataFrame:
    """A text's units as one; units without a vector only give their strings."""
    return _mapped(rows, column, UNIT, lambda c: _text(c, how))


def applied(rows: DataFrame, load: Callable[[], Callable[[list], list]], column: str, out: str, kind: str, size: int = 25) -> DataFrame:
    """``rows`` with column ``out`` of type ``kind``: what the model gives for ``column``. ``load`` makes the model, once for
    each task; it is called with lists of ``size`` values, over batch borders, and the last of a task with those left. Values
    may be null; a model that gives another number of results raises an error. At most ``size`` rows wait beside a batch."""
    kept = [c for c in rows.columns if c != out]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*kept).schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, held, n = None, [], 0

        def done(t: pa.Table, last: bool) -> tuple[list[pa.RecordBatch], pa.Table]:
            ready, got = t.num_rows if last else t.num_rows // size * size, []
            values = t[column].to_pylist()
            for i in range(0, ready, size):
                part = values[i : min(i + size, ready)]
                found = model(part)
                if len(found) != len(part):
                    raise ValueError(f"the model gave {len(found)} results for {len(part)} values")
                got.extend(found)
            x = t.slice(0, ready).append_column("__out", pa.array(got, arrow_kind))
            return x.to_batches(), t.slice(ready)

        for b in batches:
            model = model or load()
            held.append(b)
            n += b.num_rows
            if n >= size:
                ready, rest = done(pa.Table.from_batches(held), False)
                yield from ready
                held, n = rest.to_batches(), rest.num_rows
        if n:
            yield from done(pa.Table.from_batches(held), True)[0]

    arrow_kind = to_arrow_type(rows.sparkSession.createDataFrame([], f"x {kind}").schema[0].dataType)
    return rows.select(*kept).mapInArrow(run, f"{fields}, `__out` {kind}").withColumnRenamed("__out", out)
