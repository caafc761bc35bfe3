"""Fill-in-the-middle: texts cut at borders of lines, found by descents of a Fenwick tree over blocks of the text.

A text is cut into blocks of ``BLOCK`` bytes. A Fenwick tree over the blocks stores two counts, the units (line ends) and
the code points of each block, so the number of units up to any block and the number of characters before any byte are sums
of a logarithmic number of nodes. The block in which the k-th unit ends is found by binary lifting, and only that block is
looked into for the exact byte. The text itself is taken apart at the two bytes found; it is never split into lines.

Two numbers from a hash of the row's id choose the cuts, a third whether the text is transformed, a fourth the form: psm
writes prefix, suffix, middle, spm writes suffix, prefix, middle, each behind its sentinel. ``restored`` turns an output
back into the text; this is exact, because a text that contains a sentinel stays plain and a sentinel can't arise where
two parts meet.

Nothing is shuffled: each row is transformed where it lies.

Defined results: a null text is empty; an empty text and one with a sentinel stay plain, with null counts of characters; a
null id hashes as the empty string; every row of the input is a row of the output, repeated rows included; bytes that are
no UTF-8 are carried along; extra columns are ignored; empty tables give empty tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from lintlake.llm.tokens import slices

#: Bytes of a block of the tree.
BLOCK = 4096
SEED = 7
#: Percent of the texts that are transformed, and of these the percent in the form spm.
RATE = 100
SPM = 50
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_NEWLINE = ord("\n")


class BlockTree:
    """Units and code points of a text in a Fenwick tree over its blocks.

    A unit is a line with its end; what follows the last line end is a unit too.
    """

    def __init__(self, data: bytes, block: int = BLOCK) -> None:
        self.data = np.frombuffer(data, dtype=np.uint8)
        self.block = block
        blocks = max(-(-len(data) // block), 1)
        counts = np.zeros((blocks + 1, 2), dtype=np.int64)
        if len(data):
            begins = np.arange(0, len(data), block)
            counts[1:, 0] = np.add.reduceat(self.data == _NEWLINE, begins, dtype=np.int64)
            counts[1:, 1] = np.add.reduceat((self.data & 0xC0) != 0x80, begins, dtype=np.int64)
        # Node i covers the blocks after i - (lowest bit of i), up to i.
        upto = np.cumsum(counts, axis=0)
        nodes = np.arange(blocks + 1)
        self.tree = upto - upto[nodes - (nodes & -nodes)]
        self.top = 1 << (blocks.bit_length() - 1)
        self.ends = int(upto[-1, 0])
        self.units = self.ends + int(bool(data) and data[-1] != _NEWLINE)

    def cut(self, units: int) -> int:
        """The byte at which the first ``units`` units end."""
        if units <= 0:
            return 0
        if units > self.ends:
            return len(self.data)
        at, left, step = 0, units, self.top
        while step:  # the last block before which fewer than ``units`` units end
            if at + step < len(self.tree) and self.tree[at + step, 0] < left:
                at += step
                left -= int(self.tree[at, 0])
            step >>= 1
        begin = at * self.block
        local = np.flatnonzero(self.data[begin : begin + self.block] == _NEWLINE)
        return begin + int(local[left - 1]) + 1

    def characters(self, byte: int) -> int:
        """How many code points begin before a byte."""
        node = byte // self.block
        found = int(np.count_nonzero((self.data[node * self.block : byte] & 0xC0) != 0x80))
        while node:
            found += int(self.tree[node, 1])
            node &= node - 1
        return found


def numbers(seed: int, doc_id: object) -> list[int]:
    """The first four groups of eight hexadecimal digits of the hash of a row's id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12)]


def transformed(data: bytes, draws: list[int], rate: int = RATE, spm: int = SPM, block: int = BLOCK) -> tuple:
    """(n, form, characters of the prefix, of the middle, output) of one text."""
    tree = BlockTree(data, block)
    n = tree.units
    marks = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    if not data or any(mark in data for mark in marks) or draws[2] % 100 >= rate:
        return n, "plain", None, None, data
    first, last = sorted((draws[0] % (n + 1), draws[1] % (n + 1)))
    a, b = tree.cut(first), tree.cut(last)
    head, tail = marks[0] + data[:a], marks[1] + data[b:]
    before = tree.characters(a)
    form, parts = ("spm", (tail, head)) if draws[3] % 100 < spm else ("psm", (head, tail))
    return n, form, before, tree.characters(b) - before, b"".join((*parts, marks[2], data[a:b]))


def transform(documents: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM, block: int = BLOCK) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of each document."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = pc.fill_null(batch.column("text").cast(pa.binary()), b"").to_pylist()
            ids = batch.column("key").to_pylist()
            rows = [transformed(text, numbers(seed, key), rate, spm, block) for text, key in zip(texts, ids, strict=True)]
            n, form, prefix, middle, output = zip(*rows, strict=True)
            columns = [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64())]
            columns.append(pa.array(output, pa.binary()).view(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
            )

    texts = documents.select("doc_id", F.col("doc_id").cast("string").alias("key"), documents["text"].cast("string").alias("text"))
    return texts.mapInArrow(run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text behind an output and its form."""
    head, middle = F.substring_index(output, MIDDLE, 1), F.substring_index(output, MIDDLE, -1)
    psm = F.concat(F.substring(F.substring_index(head, SUFFIX, 1), len(PREFIX) + 1, 2**31 - 1), middle, F.substring_index(head, SUFFIX, -1))
    spm = F.concat(F.substring_index(head, PREFIX, -1), middle, F.substring(F.substring_index(head, PREFIX, 1), len(SUFFIX) + 1, 2**31 - 1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
