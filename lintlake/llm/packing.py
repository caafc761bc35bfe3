"""Packing documents into sequences along a space-filling curve.

A document's vector is the mean of one random vector per token id, that is, its hashed bag of tokens projected to
``DIMENSIONS`` axes. Each axis is cut into ``2 ** BITS`` steps, and the document's place on the Hilbert curve through
those cells is its key; a hash in the key's low bits puts equal texts in some order and lets any group be split. The table
is range-sorted by key, and the token stream along the curve is cut every 2048 ids: neighbours on the curve share
sequences, and only the very last sequence can be short.

Texts are read and encoded once; the ids move once, to their range. Positions come from the ranges' totals.

Defined results: a null or empty text is one piece, the end id alone; null ids keep their row; repeated rows are packed
each by itself; an empty table gives no pieces; further columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lintlake.llm.tables import Ranges, stage_compressed
from lintlake.llm.tokens import encoder, mixed, slices

SEQUENCE = 2048
END_ID = 1
DIMENSIONS = 4
BITS = 10
#: Low bits of the key that hold a hash.
TIE_BITS = 22
#: Where the means lie on the axes: about +-1 / SPREAD covers most of each.
SPREAD = 4.0


def projection(vocabulary: int) -> np.ndarray:
    """One vector per token id, the same everywhere."""
    return np.random.default_rng(20).standard_normal((vocabulary, DIMENSIONS)).astype(np.float32)


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of integer coordinates: Skilling's transform, all rows at once."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(n):
            upper = (x[i] & bit) != 0
            swap = np.where(upper, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(upper, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    fix = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        fix ^= np.where((x[n - 1] & (1 << level)) != 0, (1 << level) - 1, 0)
    x ^= fix
    place = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            place = (place << 1) | ((x[i] >> level) & 1)
    return place


def curve_keys(ids: np.ndarray, ends: np.ndarray, vectors: np.ndarray, ties: np.ndarray) -> np.ndarray:
    """The sort key of each document; ids lie one after the other, none of a document's are empty."""
    starts = np.concatenate(([0], ends[:-1]))
    sums = np.add.reduceat(vectors[ids], starts, axis=0, dtype=np.float64)
    means = sums / (ends - starts)[:, None]
    steps = 1 << BITS
    cells = np.clip((np.tanh(means * SPREAD) + 1) / 2 * steps, 0, steps - 1)
    return (hilbert(cells, BITS) << TIE_BITS) | (ties >> np.uint64(64 - TIE_BITS)).astype(np.int64)


def encoded(documents: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, key, n_tokens, ids): ids with the end id, as bytes of little-endian 16-bit numbers."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        vectors = projection(1 << 16)
        for batch in slices(batches, "text"):
            plain, ends = encode(batch.column("text"))
            ids = np.insert(plain, ends, END_ID)
            ends = ends + np.arange(1, len(ends) + 1)
            starts = np.concatenate(([0], ends[:-1]))
            data = ids.tobytes()
            parts = [data[2 * s : 2 * e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
            names = batch.column("doc_id").to_pylist()
            ties = np.array([zlib.crc32(f"{n}".encode(), zlib.crc32(p)) for n, p in zip(names, parts, strict=True)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(curve_keys(ids, ends, vectors, mixed(ties))), pa.array(ends - starts), pa.array(parts, pa.binary())],
                ["doc_id", "key", "n_tokens", "ids"],
            )

    return documents.select("doc_id", documents["text"].cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, key long, n_tokens long, ids binary"
    )


def cut(start: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a document at stream position ``start`` is cut: the pieces' starts and ends within the document."""
    first = SEQUENCE - start % SEQUENCE
    edges = np.arange(first, length, SEQUENCE)
    return np.concatenate(([0], edges)), np.concatenate((edges, [length]))


def pack(documents: DataFrame, tokenizer: str) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids (32-bit little-endian).

    The pieces of a sequence, by offset, are its contents.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = stage_compressed(encoded(documents, tokenizer), "packing-ids")
    ranges = Ranges(rows, "key")
    offsets = ranges.offsets(rows, "n_tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        position = None
        for batch in batches:
            columns: list[list] = [[] for _ in range(8)]
            sizes = batch.column("n_tokens").to_pylist()
            for doc_id, part, size, ids in zip(
                batch.column("doc_id").to_pylist(), batch.column("range").to_pylist(), sizes, batch.column("ids"), strict=True
            ):
                if position is None:
                    position = int(offsets[part])
                data = np.frombuffer(ids.as_buffer(), dtype="<u2").astype("<u4").tobytes()
                begins, ends = cut(position, size)
                for begin, end in zip(begins.tolist(), ends.tolist(), strict=True):
                    piece = data[4 * begin : 4 * end]
                    at = position + begin
                    row = (doc_id, begin, end - begin, zlib.crc32(piece), size, at // SEQUENCE, at % SEQUENCE, piece)
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                position += size
            if columns[0]:
                types = [batch.schema.field("doc_id").type, *[pa.int64()] * 6, pa.binary()]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return ranges.sort(rows, "key", "doc_id", "n_tokens").mapInArrow(
        run,
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary",
    )
