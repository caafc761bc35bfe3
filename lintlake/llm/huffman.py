"""Token-id files in a canonical, length-limited Huffman code.

A store is a folder of two tables. ``codebook`` has the code length of every id; the codes follow from the lengths
(canonical: by length, then id). ``blocks`` has one row per block of whole documents: the packed bits (most significant
bit first), the bit offset of every ``CHECKPOINT``-th id, the documents' ids and their numbers of ids. A block needs only
the codebook to be decoded, and a reader can enter it at any checkpoint.

Writing: texts are encoded once and staged with their ids; ids are counted over all of them (at most one number per
vocabulary entry and task is shuffled, and the vocabulary's counts go to the driver, where package-merge finds the best
lengths up to ``MAX_BITS``). The rows are range-sorted by document id, and each range writes its blocks in order. Reading:
every block is decoded by itself, all its checkpoints in step, through one table of ``2 ** MAX_BITS`` entries.

Defined results: a null or empty text is the end id alone; null document ids come first; repeated rows are stored each by
itself; a text with more ids than a block is meant to have makes a longer block; an empty table gives an empty store;
further columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lintlake.llm.tables import Ranges, stage_compressed
from lintlake.llm.tokens import encoder, slices

MAX_BITS = 16
#: Ids between two checkpoints, and ids after which a block ends.
CHECKPOINT = 64
BLOCK_IDS = 1 << 16
END_ID = 2
VOCABULARY = 1 << 16


def code_lengths(counts: np.ndarray, most: int = MAX_BITS) -> np.ndarray:
    """Best code lengths of at most ``most`` bits by package-merge; 0 for ids that don't occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << most:
        raise ValueError("more ids than codes")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.int64)
    n = len(order)
    # Per level: which of the merged, sorted items are packages of two items of the level below.
    merged, kinds = weights, [np.zeros(n, dtype=bool)]
    for _ in range(most - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        everything = np.concatenate((weights, pairs))
        at = np.argsort(everything, kind="stable")
        merged = everything[at]
        kinds.append(at >= n)
    # The cheapest 2n - 2 items of the top level; packages among them open into twice as many of the level below.
    take = 2 * n - 2
    total = np.zeros(n, dtype=np.int64)
    for packages in reversed(kinds):
        opened = int(packages[:take].sum())
        total[: take - opened] += 1
        take = 2 * opened
    lengths[order] = total
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """The code of each id, right-aligned: consecutive numbers by (length, id)."""
    codes = np.zeros(len(lengths), dtype=np.uint64)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    if len(order):
        steps = np.left_shift(np.uint64(1), (MAX_BITS - lengths[order]).astype(np.uint64))
        codes[order] = (np.cumsum(steps) - steps) >> (MAX_BITS - lengths[order]).astype(np.uint64)
    return codes


def decoding_table(lengths: np.ndarray) -> np.ndarray:
    """For the next MAX_BITS bits: the id they begin with."""
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    table = np.zeros(1 << MAX_BITS, dtype=np.uint16)
    filled = np.repeat(order, 1 << (MAX_BITS - lengths[order].astype(np.int64)))
    table[: len(filled)] = filled
    return table


def pack_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The ids' bits, and the bit offset of every CHECKPOINT-th id."""
    sizes = lengths[ids].astype(np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    words = np.zeros((int(ends[-1]) >> 5) + 2 if len(ids) else 1, dtype=np.uint64)
    if len(ids):
        at = starts >> 5
        value = codes[ids] << (64 - (starts & 31) - sizes).astype(np.uint64)
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        # Bits of different ids never overlap, so sums are unions.
        words[at[first]] += np.add.reduceat(value >> np.uint64(32), first)
        words[at[first] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), first)
    data = words.astype(">u4").tobytes()
    return data[: (int(ends[-1]) + 7) // 8 if len(ids) else 0], starts[::CHECKPOINT]


def unpack_bits(data: bytes, n: int, checkpoints: np.ndarray, table: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The n ids of a block: one step decodes the next id after every checkpoint."""
    padded = np.frombuffer(data + bytes(8), dtype=np.uint8).astype(np.uint32)
    # The 24 bits from each byte on; a code ends within them wherever in the byte it starts.
    window = (padded[:-2] << 16) | (padded[1:-1] << 8) | padded[2:]
    lanes = len(checkpoints)
    ids = np.zeros((CHECKPOINT, lanes), dtype=np.uint16)
    position = checkpoints.astype(np.int64)
    last = n - (lanes - 1) * CHECKPOINT
    for step in range(CHECKPOINT):
        live = lanes if step < last else lanes - 1
        at = position[:live]
        bits = (window[at >> 3] >> (8 - (at & 7)).astype(np.uint32)) & np.uint32(0xFFFF)
        found = table[bits]
        ids[step, :live] = found
        position[:live] = at + lengths[found]
    return ids.T.reshape(-1)[:n]


def encoded(documents: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_tokens, ids): ids with the end id, as bytes of little-endian 16-bit numbers."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in slices(batches, "text"):
            plain, ends = encode(batch.column("text"))
            ids = np.insert(plain, ends, END_ID)
            ends = ends + np.arange(1, len(ends) + 1)
            starts = np.concatenate(([0], ends[:-1]))
            data = ids.tobytes()
            parts = [data[2 * s : 2 * e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ends - starts), pa.array(parts, pa.binary())], ["doc_id", "n_tokens", "ids"]
            )

    return documents.select("doc_id", documents["text"].cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids binary"
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(VOCABULARY, dtype=np.int64)
    for batch in batches:
        for ids in batch.column("ids"):
            counts += np.bincount(np.frombuffer(ids.as_buffer(), dtype="<u2"), minlength=VOCABULARY)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], ["id", "n"])


def write_store(documents: DataFrame, tokenizer: str, path: str) -> None:
    """Encode all texts and write them to ``path`` in ascending order of doc_id."""
    spark = documents.sparkSession
    rows = stage_compressed(encoded(documents, tokenizer), "huffman-ids")
    counts = np.zeros(VOCABULARY, dtype=np.int64)
    counted = rows.select("ids").mapInArrow(_count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    for row in counted.collect():  # at most the vocabulary
        counts[row["id"]] = row["n"]
    lengths = code_lengths(counts)
    book = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(book, "id int, length int").coalesce(1).write.parquet(f"{path}/codebook")
    codes = canonical_codes(lengths)
    ranges = Ranges(rows, "doc_id")
    offsets = ranges.offsets(rows, "n_tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {"position": None, "block": 0}
        names: list = []
        sizes: list[int] = []
        parts: list[bytes] = []

        def block() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), dtype="<u2")
            data, checkpoints = pack_bits(ids, codes, lengths)
            columns = [
                pa.array([state["position"]], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([data], pa.binary()),
                pa.array([checkpoints.tolist()], pa.list_(pa.int64())), pa.array([names], pa.list_(pa.int64())),
                pa.array([sizes], pa.list_(pa.int64())),
            ]
            state["position"] += len(ids)
            return pa.RecordBatch.from_arrays(columns, ["start", "n_ids", "bits", "checkpoints", "doc_ids", "doc_sizes"])

        held = 0
        for batch in batches:
            for doc_id, part, size, ids in zip(
                batch.column("doc_id").to_pylist(), batch.column("range").to_pylist(), batch.column("n_tokens").to_pylist(),
                batch.column("ids"), strict=True,
            ):
                if state["position"] is None:
                    state["position"] = int(offsets[part])
                if held and held + size > BLOCK_IDS:
                    yield block()
                    names, sizes, parts, held = [], [], [], 0
                names.append(doc_id)
                sizes.append(size)
                parts.append(ids.as_py())
                held += size
        if held:
            yield block()

    ranges.sort(rows, "doc_id", "n_tokens").mapInArrow(
        run, "start long, n_ids long, bits binary, checkpoints array<long>, doc_ids array<long>, doc_sizes array<long>"
    ).write.option("compression", "none").parquet(f"{path}/blocks")


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """One row per stored document: doc_id, start, n_tokens, ids_crc32, ids (32-bit little-endian)."""
    lengths = np.zeros(VOCABULARY, dtype=np.uint8)
    for row in spark.read.parquet(f"{path}/codebook").collect():  # at most the vocabulary
        lengths[row["id"]] = row["length"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decoding_table(lengths)
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack_bits(row["bits"], row["n_ids"], np.array(row["checkpoints"]), table, lengths)
                data = ids.astype("<u4").tobytes()
                sizes = np.array(row["doc_sizes"], dtype=np.int64)
                starts = np.cumsum(sizes) - sizes
                parts = [data[4 * s : 4 * (s + n)] for s, n in zip(starts.tolist(), sizes.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["start"]), pa.array(sizes),
                        pa.array([zlib.crc32(p) for p in parts], pa.int64()), pa.array(parts, pa.binary()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                )

    return spark.read.parquet(f"{path}/blocks").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"
    )
