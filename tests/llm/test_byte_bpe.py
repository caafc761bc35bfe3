from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken

from lintlake.llm import byte_bpe, queries, tokens
from tests.llm import data

PATH = tokens.vocabulary_path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def table():
    return byte_bpe.Ranks(PATH)


def odd_texts(n: int = 4000):
    rng = random.Random(2)
    parts = ["'", "s", "t", "re", "ve", "ll", "m", "d", "l", "r", "v", "e", " ", "  ", "\n", "\t", " ", "　", "!", "?", "1", "½"]
    parts += ["é", "日", "😀", "\x1c", "\x00", "'S", "''", "<|endoftext|>", "Ǆ", "́", "x" * 70, "ſ"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return [*texts, "a" * 5000, "日本" * 3000, "'s" * 2000, " " * 3000, "ab'" * 900, "!?" * 3000, None, ""]


def test_ids_equal_the_library(library, table):
    texts = odd_texts()
    for _ in range(2):  # the second time from the memo
        ids, counts = table.encode(pa.array(texts))
        end = 0
        for text, count in zip(texts, counts.tolist(), strict=True):
            assert ids[end : end + count].tolist() == library.encode_ordinary(text or "")
            assert table.decode(ids[end : end + count]) == (text or "").encode()
            end += count
        assert end == len(ids)


def test_cuts_equal_the_pattern(table):
    """The scan against the pattern, character by character, with lanes shorter than the texts."""
    pattern = regex.compile(public_tokenizers.PATTERN)
    for text in odd_texts(300):
        if text:
            points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
            starts = table.cutter.starts(points, np.array([0]))
            assert np.flatnonzero(starts).tolist() == [m.start() for m in pattern.finditer(text)]


def test_products_of_transitions_are_associative(table):
    product = table.cutter.product
    a, b, c = np.random.default_rng(1).integers(0, len(product), (3, 2000))
    assert (product[product[a, b], c] == product[a, product[b, c]]).all()
    assert (product[0, a] == a).all() and (product[a, 0] == a).all()


def test_a_full_memo_and_small_calls_change_nothing(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "MEMO_PIECES", 5)
    monkeypatch.setattr(byte_bpe, "CALL_PIECES", 3)
    texts = odd_texts(200)
    ids, _ = byte_bpe.Ranks(PATH).encode(pa.array(texts))
    assert ids.tolist() == [i for t in texts for i in library.encode_ordinary(t or "")]


def test_words_that_defeat_polynomial_hashes(library, table):
    """Thue-Morse words and their complements are different slices with different ids."""
    word = "a"
    for _ in range(11):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    ids, _ = table.encode(pa.array([f"{word} {other}"]))
    assert ids.tolist() == library.encode_ordinary(f"{word} {other}")


def test_bytes_that_are_no_text(table):
    raw = pa.array([b"ab\xff c", b"ok", None], pa.binary())
    ids, counts = table.encode(raw)
    assert table.decode(ids[: counts[0]]).decode() == "ab� c"
    assert table.decode(ids[counts[0] :]) == b"ok"


def test_tables(spark, library):
    docs = data.documents(spark)
    texts = {tuple(r) for r in docs.select("doc_id", "text").collect()}
    text_of = dict(texts)
    encoded = byte_bpe.encode(docs, PATH)
    rows = encoded.collect()
    assert len(rows) == docs.count()
    for row in rows:
        text = text_of[row["doc_id"]] or ""
        assert row["ids"] == library.encode_ordinary(text) and row["n_tokens"] == len(row["ids"])
        sizes = [len(library.decode_single_token_bytes(i)) for i in row["ids"]]
        assert row["offsets"] == [sum(sizes[:i]) for i in range(len(sizes))] if len(sizes) < 500 else row["offsets"][1] == sizes[0]
    for first, last in ((0, None), (3, 11), (5, 6), (7, 7), (100, None), (10**6, None)):
        for row in byte_bpe.decode(encoded, PATH, first, last).collect():
            assert row["data"] == (text_of[row["doc_id"]] or "").encode()[first:last]
    odd = spark.createDataFrame([(1, [72, None, 10**6, -1], [0, 1, 2, 3]), (2, None, None)], "doc_id int, ids array<int>, offsets array<long>")
    assert {r["doc_id"]: len(r["data"]) for r in byte_bpe.decode(odd, PATH).collect()} == {1: 1, 2: 0}
    assert byte_bpe.encode(data.empty(spark), PATH).count() == byte_bpe.digests(data.empty(spark), PATH).count() == 0


def test_the_query(spark, library):
    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    expected = set()
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        written = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        expected.add((doc_id, len(ids), written, hashlib.sha256((text or "").encode()).hexdigest()))
    found = [tuple(r) for r in queries.op13_scanned_byte_bpe(spark, sf_dir).collect()]
    assert set(found) == expected and len(found) == len(rows)
