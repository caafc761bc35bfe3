"""Stages of the pipeline decide by row: null, shared and repeated ids, clashing columns, empty tables."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import data

DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, carried string, kept boolean, n_words long"


def _text(n: int, start: int = 0) -> str:
    return " ".join(f"word{(i * i + start) % 1009}" for i in range(n))


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 1, 7, "x", False, 3) for i, t in rows], SCHEMA).repartition(3)


def _found(frame) -> Counter:
    return Counter((r["doc_id"], r["text"]) for r in frame.collect())


def _shingles(text: str) -> set:
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def _brute(rows):
    """One row of every group of linked rows, by plain comparison of all pairs."""
    sets, group = [_shingles(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    kept = Counter()
    for g in set(group):
        ids = [rows[i] for i in range(len(rows)) if group[i] == g]
        kept[min(ids, key=lambda r: (r[0] is None, r[0] or 0))[0]] += 1
    return kept


def test_quality_decides_rows_with_null_and_shared_ids(spark):
    good, bad = _text(60), "# $ % & " * 3
    rows = [(1, good), (1, bad), (None, good), (None, bad), (2, bad), (3, good), (3, good), (4, None), (5, "")]
    kept = corpus_pipeline.apply_quality_rules(spark, _frame(spark, rows), DATA)
    assert kept.columns == corpus_pipeline.COLUMNS
    assert _found(kept) == Counter([(1, good), (None, good), (3, good), (3, good)])


def test_near_duplicates_decide_rows_with_null_and_shared_ids(spark):
    near = _text(60).replace("word4 ", "other ")
    rows = [
        (5, _text(60)), (9, near), (None, _text(60)), (None, _text(40, 500)), (None, _text(40, 500)), (7, _text(30, 300)),
        (7, _text(30, 300)), (7, _text(50, 800)), (8, None), (8, None), (6, ""), (4, "two words"), (2, "Two Words"), (3, _text(30_000)),
    ]
    kept = corpus_pipeline.drop_near_duplicates(spark, _frame(spark, rows), DATA)
    assert kept.columns == corpus_pipeline.COLUMNS
    assert Counter(r["doc_id"] for r in kept.collect()) == _brute(rows)


def test_near_duplicates_equal_brute_force_on_given_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, DATA)
    assert Counter(r["doc_id"] for r in kept.collect()) == _brute(rows)


def test_stages_of_empty_tables(spark):
    docs = data.empty(spark).withColumn("row", F.lit(1))
    for _, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, DATA)
        assert docs.columns == corpus_pipeline.COLUMNS and docs.count() == 0
