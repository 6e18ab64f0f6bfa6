"""The pipeline's stages against brute force, each on its own input."""

import os
import re
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
pipeline = pytest.importorskip("corpus_pipeline")
from test_corpus_operators import WORD, brute_components  # noqa: E402

from tidemark.llm import contamination, quality, secret_scan  # noqa: E402

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before and after each stage."""
    out, docs = {}, spark.read.parquet(f"{DATA}/documents.parquet")
    base = tmp_path_factory.mktemp("stages")
    for name, f in pipeline.STAGES:
        before = docs
        f(spark, docs, DATA).write.parquet(f"file://{base}/{name}")
        docs = spark.read.parquet(f"file://{base}/{name}")
        out[name] = (before, docs)
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns(stages):
    for name, _ in pipeline.STAGES[:-1]:
        assert stages[name][1].dtypes == stages[name][0].dtypes


def test_quality(spark, stages):
    before, after = map(texts, stages["quality_rules"])
    verdict = {r["doc_id"]: r for r in quality.judge(stages["quality_rules"][0], spark.read.parquet(f"{DATA}/labels.parquet")).collect()}
    assert set(after) == {i for i in before if verdict[i]["kept"]}
    for i, t in before.items():
        if len(WORD.findall(t)) < 50:
            assert i not in after


def test_one_of_each(stages):
    before, after = map(texts, stages["ngram_jaccard"])
    assert set(after) == {i for i, _, c in brute_components(sorted(before.items()), 5, 80) if i == c}


def test_leaks(spark, stages):
    before, after = map(texts, stages["decontamination"])
    bench = [contamination.normal(r["text"]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    for i, t in before.items():
        n = contamination.normal(t)
        whole = any(b in n for b in bench)
        part = any(b[k : k + 60] in n for b in bench for k in range(0, len(b) - 60, 20))
        assert not (whole and i in after) and (part or i in after)


def test_secrets(stages):
    before, after = map(texts, stages["secret_scan"])
    assert set(before) == set(after)
    for i, t in after.items():
        base, more = secret_scan.scan(before[i])
        assert (t != before[i]) == bool(base + more) and not re.search("[0-9a-f]{24,}|AKIA[A-Z0-9]{16,}", t)
    assert all(r["n_chars"] == len(r["text"]) for r in stages["secret_scan"][1].collect())


def test_packing(stages):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    tok, pieces = Tokenizer.from_file(path("word_bpe_49k.json")), {}
    for r in stages["packing"][1].collect():
        pieces.setdefault(r["doc_id"], []).append(r)
    docs = texts(stages["packing"][0])
    assert set(pieces) == set(docs)
    for i, t in docs.items():
        ids, at = np.array(tok.encode(t, add_special_tokens=False).ids + [2], "<u4"), 0
        for p in sorted(pieces[i], key=lambda p: p["start"]):
            assert p["start"] == at and zlib.crc32(ids[at : at + p["length"]].tobytes()) == p["ids_crc32"]
            at += p["length"]
        assert at == len(ids)


def test_run(spark, stages):
    assert pipeline.run(spark, DATA).count() == stages["packing"][1].count()


# Awkward rows: each stage by itself ---------------------------------------------------------------------------------------


def stage(spark, tmp_path, number, rows, d=DATA):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("row", F.lit(5)).withColumn("_metadata", F.lit("x"))
    docs.repartition(3).write.parquet(f"file://{tmp_path}/in{number}")
    out = []
    for df in (spark.read.parquet(f"file://{tmp_path}/in{number}"), docs):  # a scan, and a frame that is none
        got = pipeline.STAGES[number][1](spark, df, d)
        assert got.columns == pipeline.COLUMNS or number == 4
        out.append(sorted(map(tuple, got.collect()), key=str))
        assert pipeline.STAGES[number][1](spark, df.limit(0), d).count() == 0
    assert out[0] == out[1] or number == 4
    return out[0]


def words(tag, n=80):
    return " ".join(f"{tag}word{k}" for k in range(n))


def doc(i, text, lang="en"):
    return (i, text, lang, "src", None if text is None else len(text))


def test_quality_stage_judges_rows(spark, tmp_path):
    rows = [doc(1, words("a")), doc(1, "short"), doc(None, words("b")), doc(None, "too short"), doc(2, None), doc(3, ""), doc(4, words("c"), None), doc(4, words("c"), None), doc(5, words("d", 20_000))]
    got = stage(spark, tmp_path, 0, rows)
    assert got == sorted([r for r in rows if r[1] and len(r[1]) > 100], key=str)


def test_duplicate_stage_keeps_one_row(spark, tmp_path):
    near = words("a").replace("aword79", "other")
    rows = [doc(7, words("a")), doc(7, words("a")), doc(9, words("a")), doc(None, words("a")), doc(8, near), doc(None, words("b")), doc(None, words("b")), doc(3, words("c")), doc(3, words("d")), doc(4, None), doc(4, None), doc(5, ""), doc(6, "x" * 100_000)]
    got = stage(spark, tmp_path, 1, rows)
    assert got == sorted([doc(7, words("a")), doc(None, words("b")), doc(3, words("c")), doc(3, words("d")), doc(4, None), doc(4, None), doc(5, ""), doc(6, "x" * 100_000)], key=str)


def test_leak_stage_drops_rows(spark, tmp_path):
    bench = spark.read.parquet(f"{DATA}/benchmark.parquet").first()["text"]
    rows = [doc(1, words("a")), doc(1, "so " + bench), doc(None, bench), doc(None, words("b")), doc(2, None), doc(3, ""), doc(4, words("c", 30_000)), doc(4, words("c", 30_000))]
    assert stage(spark, tmp_path, 2, rows) == sorted([r for r in rows if not r[1] or bench not in r[1]], key=str)


def test_secret_and_packing_stages_keep_rows(spark, tmp_path):
    rows = [doc(1, 'x token = "24be64439e3e49cf46b2d7c90f3602a3" y'), doc(1, "plain"), doc(None, "plain"), doc(None, "plain"), doc(2, None), doc(3, "")]
    got = stage(spark, tmp_path, 3, rows)
    want = [doc(1, 'x [REDACTED]" y')] + rows[1:]
    assert got == sorted(want, key=str)
    pieces = stage(spark, tmp_path, 4, rows + [doc(9, words("a", 3000))])
    assert sorted(str(p[0]) for p in pieces if p[0] != 9) == ["1", "1", "2", "3", "None", "None"] and sum(p[2] for p in pieces if p[0] == 9) == next(p[4] for p in pieces if p[0] == 9)
