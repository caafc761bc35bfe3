from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lintlake.llm import infill, queries
from tests.llm import data

UNITS = re.compile(r"[^\n]*\n|[^\n]+")


def plain(doc_id, text):
    """The contract in plain steps over the list of units."""
    text = text or ""
    units = UNITS.findall(text)
    digits = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[i : i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, None)))
    if not text or re.search("<[PSM]>", text):
        return doc_id, len(units), "plain", None, None, text
    if h[3] % 100 < 50:
        return doc_id, len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def odd_texts(n: int = 300):
    rng = random.Random(4)
    parts = ["\n", "a", "é", "日本", "😀", "\r\n", " ", "<", "<P", "S>", "\x00", " ", "words and words"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return [*texts, "x<P>y", "<S>", "\n<M>", "line of text\n" * 20_000, "é" * 100_000, "\n" * 30_000 + "end"]


@pytest.mark.parametrize("block", [1, 2, 7, 64, 4096])
def test_cuts_and_characters(block):
    for text in odd_texts(60)[:63]:
        raw, units = text.encode(), UNITS.findall(text)
        tree = infill.BlockTree(raw, block)
        assert tree.units == len(units)
        for k in range(len(units) + 1):
            assert raw[: tree.cut(k)].decode() == "".join(units[:k])
            assert tree.characters(tree.cut(k)) == sum(map(len, units[:k]))


def test_rows(spark):
    docs = data.documents(spark, [(1000 + i, t, "en", "s", 1, "k", "r", 1, "s") for i, t in enumerate(odd_texts())])
    cut = infill.transform(docs, block=16)
    columns = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert cut.columns == columns
    rows = docs.select("doc_id", "text").collect()
    assert Counter(map(tuple, cut.collect())) == Counter(plain(*r) for r in rows)
    back = cut.select("doc_id", infill.restored(F.col("output"), F.col("form"))).collect()
    assert Counter(map(tuple, back)) == Counter((d, t or "") for d, t in rows)
    assert infill.transform(data.empty(spark)).count() == 0


def test_rates(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("a\nb\nc\n").alias("text"))
    forms = {rate: Counter(r["form"] for r in infill.transform(docs, rate=rate, spm=0).collect()) for rate in (0, 50, 100)}
    assert forms[0] == {"plain": 400} and forms[100] == {"psm": 400} and 120 < forms[50]["psm"] < 280


def test_the_query(spark):
    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    expected = Counter((*plain(d, t)[:5], digest(plain(d, t)[5]), digest(t or "")) for d, t in rows)
    assert Counter(map(tuple, queries.op12_fenwick_infill(spark, sf_dir).collect())) == expected
