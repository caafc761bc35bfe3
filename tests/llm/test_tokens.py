from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lintlake.llm import bpe, huffman, packing, tokens
from tests.llm import data

PATH = tokens.vocabulary_path()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def merges():
    return bpe.Merges(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def odd_texts(merges) -> list[str]:
    rng = random.Random(5)
    words = [t.removesuffix("</w>") for t in merges.tokens.values()]
    texts = ["", " ", "it's I'll ''s 's", "a<|endoftext|>b <|startoftext|>", "ΑΣ Σ σς", "İstanbul", "é é", "x\x00y\x1cz q", "12 3½²", "'" * 50]
    texts += ["".join(rng.choice("abcdehinorst") for _ in range(3000)), "ha" * 3000, "!?" * 2500, "日本語" * 900]
    texts += ["".join(rng.choice(words) for _ in range(60)) for _ in range(20)]
    texts += [" ".join(rng.choice(words) + rng.choice(["'s", "", ",", "<|"]) for _ in range(60)) for _ in range(20)]
    return texts


@pytest.mark.parametrize("backend", [tokens.Library, bpe.Transducer])
def test_encoders_agree_with_the_library(library, merges, backend):
    texts = [*odd_texts(merges), None]
    encoder = tokens.Encoder(backend(PATH))
    for _ in range(2):  # the second time from the memo
        ids, ends = encoder.encode(pa.array(texts))
        starts = [0, *ends[:-1]]
        for text, start, end in zip(texts, starts, ends, strict=True):
            assert ids[start:end].tolist() == ids_of(library, text)


def test_a_full_memo_changes_nothing(library, merges):
    encoder = tokens.Encoder(tokens.Library(PATH))
    encoder.memo = tokens.Memo(16)
    texts = odd_texts(merges)
    for _ in range(2):
        ids, ends = encoder.encode(pa.array(texts))
    assert ids.tolist() == [i for t in texts for i in ids_of(library, t)]


@pytest.mark.parametrize("size", [1, 3, 17, 4096])
def test_streamed_text_in_any_parts(library, merges, size):
    for text in odd_texts(merges):
        stream = bpe.StreamEncoder(merges)
        got = [i for at in range(0, len(text), size) for i in stream.feed(text[at : at + size])] + stream.finish()
        assert got == ids_of(library, text)


def test_memory_of_a_single_endless_word_is_bounded(merges):
    stream = bpe.StreamEncoder(merges)
    for _ in range(300):
        stream.feed("thequickbrown" * 20)
        assert len(stream.piece.held) <= 3 * merges.lookahead
        assert len(stream.text) + len(stream.raw) <= 2 * bpe.HOLD


def test_decoders(library, merges):
    for text in odd_texts(merges):
        ids = ids_of(library, text)
        surface, plain = bpe.SurfaceDecoder(merges), bpe.TextDecoder(merges)
        cut = len(ids) // 3
        assert surface.feed(ids[:cut]) + surface.feed(ids[cut:]) + surface.finish() == library.decode(ids, skip_special_tokens=False)
        assert "�" not in "".join(plain.feed([i]) for i in ids) + plain.finish()


def test_digests_and_round_trip(spark, library):
    docs = data.documents(spark)
    for row in bpe.digests(docs, PATH).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        ids = ids_of(library, row["text"])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    decoded = {r["doc_id"]: r["text"] for r in bpe.decode(bpe.encode(docs, PATH), PATH).collect()}
    assert decoded[0].strip() == data.rows()[0][1]
    assert bpe.digests(data.empty(spark), PATH).count() == 0


def test_hilbert_curve_visits_all_cells_by_neighbours():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), axis=-1).reshape(-1, 3)
    order = np.argsort(packing.hilbert(grid, 3))
    assert sorted(packing.hilbert(grid, 3)) == list(range(512))
    assert (np.abs(np.diff(grid[order], axis=0)).sum(axis=1) == 1).all()


def test_packing(spark, library):
    docs = data.documents(spark)
    pieces = packing.pack(docs, PATH).collect()
    sequences, found = {}, {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        found.setdefault((p["doc_id"], p["doc_tokens"]), []).append(p)
        assert p["ids_crc32"] == zlib.crc32(p["ids"]) and len(p["ids"]) == 4 * p["length"]
    for i, parts in sequences.items():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end == packing.SEQUENCE or i == max(sequences)
    assert sorted(sequences) == list(range(len(sequences)))
    for row in data.rows():
        expected = [*ids_of(library, row[1]), packing.END_ID]
        parts = sorted(found[(row[0], len(expected))], key=lambda p: (p["start"], p["sequence_id"], p["offset"]))
        if row[0] != 3:  # that row is there twice
            assert np.frombuffer(b"".join(p["ids"] for p in parts), dtype="<u4").tolist() == expected
    assert sum(p["length"] for p in pieces if p["doc_id"] == 3) == 2 * (len(ids_of(library, data.rows()[3][1])) + 1)
    assert packing.pack(data.empty(spark), PATH).count() == 0


def test_code_lengths_are_the_best_of_their_limit():
    def huffman_cost(counts):
        import heapq

        heap, cost = list(counts), 0
        heapq.heapify(heap)
        while len(heap) > 1:
            a = heapq.heappop(heap) + heapq.heappop(heap)
            cost += a
            heapq.heappush(heap, a)
        return cost

    rng = np.random.default_rng(2)
    for n in (2, 3, 50, 400):
        counts = rng.integers(1, 1000, n)
        lengths = huffman.code_lengths(counts, 16).astype(int)
        assert (lengths * counts).sum() == huffman_cost(counts.tolist())
    skewed = np.array([2**i for i in range(30)])
    lengths = huffman.code_lengths(skewed, 8).astype(int)
    assert lengths.max() <= 8 and sum(2.0**-x for x in lengths) <= 1


@pytest.mark.parametrize("n", [1, 63, 64, 65, 5000])
def test_bits_round_trip_from_any_checkpoint(n):
    rng = np.random.default_rng(n)
    ids = (rng.pareto(0.7, n) % 3000).astype("<u2")
    lengths = huffman.code_lengths(np.bincount(ids, minlength=huffman.VOCABULARY))
    bits, checkpoints = huffman.pack_bits(ids, huffman.canonical_codes(lengths), lengths)
    table = huffman.decoding_table(lengths)
    assert huffman.unpack_bits(bits, n, checkpoints, table, lengths).tolist() == ids.tolist()
    later = huffman.unpack_bits(bits, n - 64 * (len(checkpoints) - 1), checkpoints[-1:], table, lengths)
    assert later.tolist() == ids[64 * (len(checkpoints) - 1) :].tolist()


def test_huffman_store(spark, library, tmp_path):
    huffman.write_store(data.documents(spark), PATH, str(tmp_path / "store"))
    found = sorted(huffman.read_store(spark, str(tmp_path / "store")).collect(), key=lambda r: r["start"])
    by_id = {r[0]: r[1] for r in data.rows()} | {None: "a row without an id that has some words in it"}
    position = 0
    assert [r["doc_id"] for r in found] == [None, *sorted([*range(len(data.rows())), 3])]
    for r in found:
        ids = [*ids_of(library, by_id[r["doc_id"]]), huffman.END_ID]
        assert r["start"] == position and r["n_tokens"] == len(ids)
        assert r["ids"] == np.array(ids, dtype="<u4").tobytes() and r["ids_crc32"] == zlib.crc32(r["ids"])
        position += len(ids)
    huffman.write_store(data.empty(spark), PATH, str(tmp_path / "nothing"))
    assert huffman.read_store(spark, str(tmp_path / "nothing")).count() == 0
