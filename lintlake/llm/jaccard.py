"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix with itself.

A document's set holds the hashes of its distinct word n-grams; two documents link when their sets' Jaccard similarity is
at least ``percent`` / 100. Equal sets are one row of the matrix.

Which rows can link at all follows from their sizes. For strict thresholds (``PARTS_FROM`` percent and more): sets of sizes a and b with similarity t differ in at most
(a + b)(1 - t) / (1 + t) n-grams. Rows are blocked by size into levels, columns by hash into one part more than the largest
difference of the level. Two rows that link agree in a whole part, so only rows with an equal part (same level, same part,
same contents) can meet; no frequent n-gram brings unrelated rows together, since a part holds several. For looser thresholds
parts would hold too few n-grams. There a row of size n meets others by its first n - ceil(tn) + m n-grams in one order for
all rows, m being n / ``SHARE`` but 1 at least; two rows that link must share as many of them as the smaller m, so a row that
shares fewer with all others together is discarded at once, and a row leaves those sets of rows that it meets by so few n-grams
that, whatever a partner leaves, one set that both are in remains. The order is by frequency, counted over all texts in
``BUCKETS`` of hashes, rare n-grams first, so that frequent ones bring rows together only if little else is in them. Counts
decide how much is compared, never what links. Every set of rows that meet, held together by its smallest member, is cut into blocks of ``BLOCK`` rows, and the product is formed block by
block: overlap counts accumulate over slices of the columns that the blocks share; rows whose shared columns are fewer
than their size allows are discarded before. Of the links in a block only a spanning forest leaves the task, which is all
that components need, so copies never become all their pairs.

Defined results: null and blank texts have the empty set and link with nothing; a text of fewer words than n is one n-gram
of all its words; null ids take part in no link and have a null component; rows that share an id are one document with
several sets; letters A-Z are lower-cased, nothing else; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from lintlake.functions.scale import stage
from lintlake.llm.graph import components
from lintlake.llm.tables import stage_compressed
from lintlake.llm.tokens import SpanHash, mixed, slices

BLOCK = 256
#: Thresholds in percent from which rows meet by parts.
PARTS_FROM = 85
#: Buckets in which n-grams are counted, by the leading bits of their hashes, and how many of them make a row of counts.
BUCKETS = 1 << 20
CHUNK = 1 << 10
#: One in so many n-grams of a row must be shared within the prefixes.
SHARE = 20
#: Columns of the incidence matrix that are multiplied at once.
COLUMNS = 4096
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SECOND = np.uint64(0x5851F42D4C957F2D)


def shingle_sets(texts: pa.Array, width: int, hashes: SpanHash) -> list[np.ndarray]:
    """Per text the sorted 64-bit hashes of its distinct n-grams of words."""
    texts = pc.fill_null(texts, "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if offsets[-1] == offsets[0]:
        return [np.zeros(0, dtype=np.uint64)] * len(texts)
    data = _LOWER[np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]]
    offsets = offsets - offsets[0]
    space = _IS_SPACE[data]
    edge = np.empty(len(data) + 1, dtype=bool)
    edge[1:-1] = space[1:] != space[:-1]
    edge[offsets] = True
    cuts = np.flatnonzero(edge)
    starts, ends = cuts[:-1], cuts[1:]
    keep = ~space[starts]
    starts, ends = starts[keep], ends[keep]
    words = hashes(data, starts, ends)
    grams = np.zeros(max(0, len(words) - width + 1), dtype=np.uint64)
    for i in range(width):
        grams = mixed(grams + words[i : i + len(grams)])
    first = np.searchsorted(starts, offsets)
    out = []
    for begin, end in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if end - begin >= width:
            out.append(np.unique(grams[begin : end - width + 1]))
        elif end > begin:
            whole = np.zeros(1, dtype=np.uint64) + np.uint64(end - begin)
            for i in range(begin, end):
                whole = mixed(whole + words[i : i + 1])
            out.append(whole)
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


class Levels:
    """Size levels and their parts for one threshold."""

    def __init__(self, percent: int) -> None:
        if not 0 < percent <= 100:
            raise ValueError("percent must be from 1 to 100")
        self.percent = percent
        # Wider levels need more parts, narrower ones put more sets into two levels; this is about the least of both.
        self.ratio = 1 + 3.3 * (100 - percent) / 100
        self.starts = [1]

    def _until(self, n: int) -> None:
        while self.starts[-1] <= n:
            self.starts.append(max(self.starts[-1] + 1, int(self.starts[-1] * self.ratio)))

    def of(self, n: int) -> list[int]:
        """The levels in which a set of size n can be the larger or the smaller of two that link."""
        self._until(n * 100 // self.percent + 1)
        own = int(np.searchsorted(self.starts, n, side="right")) - 1
        found = [own]
        while self.percent * self.starts[found[-1] + 1] <= 100 * n:
            found.append(found[-1] + 1)
            self._until(self.starts[found[-1]] + 1)
        return found

    def parts(self, level: int) -> int:
        self._until(self.starts[level] + 1)
        largest = self.starts[level + 1] - 1
        return 2 * largest * (100 - self.percent) // (100 + self.percent) + 1

    def keys(self, grams: np.ndarray) -> np.ndarray:
        """One hash per level and part: what must agree in one place for two sets to link."""
        sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(mixed(grams))))
        keys = []
        for level in self.of(len(grams)):
            n = self.parts(level)
            at = np.concatenate(([0], np.searchsorted(grams, _part_starts(n)), [len(grams)]))
            place = (np.uint64(level) << np.uint64(40)) + np.arange(n, dtype=np.uint64)
            keys.append(mixed(mixed(place) + sums[at[1:]] - sums[at[:-1]]))
        return np.concatenate(keys)


def bucket(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(65 - BUCKETS.bit_length())).astype(np.int64)


class Prefixes:
    """The first n-grams of each set, those of frequent buckets last."""

    def __init__(self, percent: int, levels: np.ndarray) -> None:
        self.percent, self.levels = percent, levels

    def keys(self, grams: np.ndarray) -> np.ndarray:
        size = len(grams) - -(-self.percent * len(grams) // 100) + max(1, len(grams) // SHARE)
        return grams[np.argsort(self.levels[bucket(grams)], kind="stable")][:size]


def frequency_levels(documents: DataFrame, width: int) -> np.ndarray:
    """Per bucket 0, or from 1 on how far its n-grams, counted over all texts, exceed what chance puts into one."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = SpanHash(), np.zeros(BUCKETS, dtype=np.int64)
        for batch in slices(batches, "text"):
            counts += np.bincount(bucket(np.concatenate(shingle_sets(batch.column("text"), width, hashes))), minlength=BUCKETS)
        if counts.any():
            # Most counts of a task are small, and zero bytes compress well.
            rows = [row.tobytes() for row in counts.reshape(-1, CHUNK)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int32()), pa.array(rows, pa.binary())], ["chunk", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(row.as_py(), dtype=np.int64) for row in table["counts"])
        return pa.table({"chunk": table["chunk"][:1], "counts": pa.array([total.tobytes()], pa.binary())})

    texts = documents.select(documents["text"].cast("string").alias("text")).filter("text is not null")
    schema = "chunk int, counts binary"
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for row in texts.mapInArrow(count, schema).groupBy("chunk").applyInArrow(add, schema).collect():
        counts[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(row["counts"], dtype=np.int64)
    mean = counts.sum() / BUCKETS
    usual = max(2.0, mean + 4 * mean**0.5)
    above = np.maximum(counts, 1) / usual
    return np.where(above > 1, 1 + 2 * np.log2(above), 0).astype(np.uint8)


@cache
def _part_starts(n: int) -> np.ndarray:
    return np.array([(i << 64) // n for i in range(1, n)], dtype=np.uint64)


def rows_of(documents: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, s1, s2, keys): set size, 128 bits that identify the set, and what it meets others by."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    by_parts = percent >= PARTS_FROM
    frequency = np.zeros(0, dtype=np.uint8) if by_parts else frequency_levels(documents, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, levels = SpanHash(), Levels(percent) if by_parts else Prefixes(percent, frequency)
        for batch in slices(batches, "text"):
            sets = shingle_sets(batch.column("text"), width, hashes)
            keys = [levels.keys(s) if len(s) else s for s in sets]
            ends = np.concatenate(([0], np.cumsum([len(k) for k in keys]))).astype(np.int32)
            ids = [np.array([mixed(s ^ c).sum(dtype=np.uint64) for s in sets], dtype=np.uint64).view(np.int64) for c in (np.uint64(0), _SECOND)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(ids[0]), pa.array(ids[1]),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys).view(np.int64))),
                ],
                ["doc_id", "n_shingles", "s1", "s2", "keys"],
            )

    texts = documents.select("doc_id", documents["text"].cast("string").alias("text"))
    return texts.mapInArrow(run, f"doc_id {kind}, n_shingles long, s1 long, s2 long, keys array<long>")


def product_links(sizes: np.ndarray, grams: list[np.ndarray], left: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between rows with ``left`` and rows without (all rows if all are left)."""
    alive = np.arange(len(grams))
    lengths = np.array([len(g) for g in grams])
    owner = np.repeat(np.arange(len(grams)), lengths)
    columns, inverse, counts = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
    while True:  # a row links only if enough of its columns are shared with other live rows
        shared = np.bincount(owner, weights=counts[inverse] > 1, minlength=len(grams))[alive]
        enough = 100 * shared >= percent * sizes[alive]
        if enough.all():
            break
        gone = np.isin(owner, alive[~enough])
        alive = alive[enough]
        counts = counts - np.bincount(inverse[gone], minlength=len(columns))
        owner, inverse = owner[~gone], inverse[~gone]
    side = left[alive]
    rows, others = alive[side], alive if left.all() else alive[~side]
    if not len(rows) or not len(others):
        return []
    used = np.flatnonzero(counts > 1)
    column = np.full(len(columns), -1)
    column[used] = np.arange(len(used))
    place = np.full(len(grams), -1)
    place[alive] = np.arange(len(alive))
    at, to = place[owner], column[inverse]
    overlap = np.zeros((len(rows), len(others)), dtype=np.float32)
    order = np.argsort(to, kind="stable")
    at, to = at[order], to[order]
    for start in range(0, len(used), COLUMNS):
        begin, end = np.searchsorted(to, [start, start + COLUMNS])
        matrix = np.zeros((len(alive), min(COLUMNS, len(used) - start)), dtype=np.float32)
        matrix[at[begin:end], to[begin:end] - start] = 1
        overlap += matrix[place[rows]] @ matrix[place[others]].T
    union = sizes[rows][:, None] + sizes[others][None, :] - overlap
    linked = np.argwhere((overlap > 0) & (100 * overlap.astype(np.int64) >= percent * union.astype(np.int64)))
    root = {int(i): int(i) for i in alive}

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    forest = []
    for i, j in linked.tolist():
        a, b = find(int(rows[i])), find(int(others[j]))
        if a != b:
            root[a] = b
            forest.append((int(rows[i]), int(others[j])))
    return forest


def join(documents: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id): every document with the smallest id that links lead to, its own included."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = stage_compressed(rows_of(documents, width, percent), "jaccard-rows")
    narrow = rows.select("doc_id", "n_shingles", "s1", "s2")
    sets = narrow.filter("n_shingles > 0 and doc_id is not null")
    classes = stage(sets.groupBy("s1", "s2").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n")), "jaccard-classes")

    parts = rows.filter("n_shingles > 0 and doc_id is not null").select(F.explode("keys").alias("key"), "s1")
    # Parts move once, and are sorted: leaders come from a window, not from a table of keys that the parts would meet again.
    by_key = Window.partitionBy("key")
    led = parts.select("s1", F.min("s1").over(by_key).alias("leader"), F.max("s1").over(by_key).alias("other"))
    met = stage(led.filter("leader != other").groupBy("leader", "s1").agg(F.count("*").alias("met")), "jaccard-met")
    # A partner has at least percent of the row's size, and so needs at least this many common keys; copies of a text only
    # raise the count. A row leaves its smallest sets while they hold less than half of them: of two partners' common
    # keys, some are then left in a set that both stay in.
    need = F.lit(1) if percent >= PARTS_FROM else F.greatest(F.lit(1), F.floor(F.col("n") * percent / (100 * SHARE)))
    of_row = Window.partitionBy("s1", "rep")
    sofar = of_row.orderBy("met", "leader").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    weighed = met.join(classes.select("s1", "rep", "n"), "s1").select(
        "leader", "rep", need.alias("need"), F.sum("met").over(of_row).alias("all"), F.sum("met").over(sofar).alias("sofar")
    )
    members = stage(weighed.filter("all >= need and 2 * sofar >= need").select("leader", "rep"), "jaccard-members")
    counted = members.groupBy("leader").agg(F.count("*").alias("rows")).filter("rows > 1")
    blocks = counted.select("leader", F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    placed = (
        members.join(blocks, "leader")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("leader", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") <= F.col("other")).alias("left"), "rep")
    )

    hashes = SpanHash()

    def multiply(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        reps = table["rep"].to_pylist()
        grams = [g for batch in slices(table.select(["text"]).to_batches(), "text") for g in shingle_sets(batch.column("text"), width, hashes)]
        left = table["left"].to_numpy(zero_copy_only=False).astype(bool)
        sizes = np.array([len(g) for g in grams])
        pairs = product_links(sizes, grams, left, percent)
        return pa.table({"a": pa.array([reps[i] for i, _ in pairs], table["rep"].type), "b": pa.array([reps[j] for _, j in pairs], table["rep"].type)})

    texts = documents.select(F.col("doc_id").alias("rep"), documents["text"].cast("string").alias("text"))
    targets = placed.groupBy("rep").agg(F.collect_list(F.struct("leader", "i", "j", "left")).alias("targets"))
    # The texts meet their blocks' list; an id with several rows has several sets, and each is tried. The lists have no bound
    # either, so this join is merged at every size, too. Texts travel on to the blocks: they are far smaller than their sets.
    meet = texts.join(targets.hint("merge"), "rep").select(F.explode("targets").alias("at"), "rep", "text")
    incidence = meet.select("at.*", "rep", "text")
    links = incidence.groupBy("leader", "i", "j").applyInArrow(multiply, f"a {kind}, b {kind}")
    found = components(links)
    return (
        narrow.join(classes, ["s1", "s2"], "left")
        .join(found, F.col("rep") == F.col("id"), "left")
        .select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("component", "rep")).otherwise(F.col("doc_id")).alias("found"))
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("found")).alias("component_id"))
    )
