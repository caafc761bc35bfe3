"""Near-duplicate vectors by NN-descent.

Equal vectors are one vertex. The neighbour graph starts from ``ORDERS`` random-projection orders of the vectors: in each,
vectors are sorted by the signs of random hyperplanes and a projection, and compared within overlapping runs. Then it is
refined: every vertex compares its neighbours and those it is a neighbour of with each other, and pairs better than the
worst entry of either's list replace it. A list is ``NEIGHBOURS`` long; one that is saturated, full of pairs over the
threshold, doubles in the next round. The orders of an effort grow with the bits of their signs, so that a lone pair at
the threshold's angle shares all signs in one of them with probability ``RECALL``.

Pairs over the threshold link. Lists end, so a link between two vertices whose lists are both saturated may have been
dropped; a link of any other vertex that was met is in its list. Saturated vertices of different components are therefore
compared exactly: in blocks of a component, of which only pairs are left out whose centers and radii prove that no link
joins them. Recall is audited against brute force for a sample of vertices: the share of those with links all of whose links
are within their component. The sample grows until it holds ``LINKED`` vertices with links or all vertices. While recall is
below ``RECALL``, more orders and rounds are added; if it still is after ``EFFORTS`` times, all vectors are compared in
blocks. Recall and the vertices it rests on are logged and are the metadata of the result's column ``component_id``. Within every component found, members are compared in blocks, in double precision, so that each vertex has the exact number of links
to its component however long its list would have to be. Only counts leave those tasks.

Defined results: null, zero and non-finite vectors and vectors with null components have no links and are components of
their own; vectors of different lengths never link; null ids take part in nothing and have a null component; rows of equal
id and vector count as copies; extra columns are ignored.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lintlake.functions.scale import stage
from lintlake.llm.graph import components
from lintlake.llm.tables import Ranges, stage_compressed

THRESHOLD = 0.9
NEIGHBOURS = 8
ORDERS = 8
RUN = 256
ROUNDS = 3
RECALL = 0.95
EFFORTS = 3
#: Vertices that an audit asks at first, and linked ones among them that it needs.
AUDITED = 256
LINKED = 64
BLOCK = 512
_LOG = logging.getLogger(__name__)
_EDGE = "v long, u long, sim double"


def _matrix(column: pa.Array, kind=np.float64) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), dtype="<f8").astype(kind) for x in column]


def _checked(embeddings: DataFrame) -> DataFrame:
    """(vec_id, vector, valid): vectors of finite numbers that are not all zero, in rows with an id, are valid."""
    rows = embeddings.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("vector"))
    finite = F.forall("vector", lambda x: F.coalesce((F.abs(x) < F.lit(float("inf"))) & ~F.isnan(x), F.lit(False)))
    some = F.exists("vector", lambda x: F.coalesce(x != 0, F.lit(False)))
    valid = F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite & some
    return rows.withColumn("valid", F.coalesce(valid, F.lit(False)))


def vertices(embeddings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(vec_id, rep, least) of valid rows, and (rep, copies, unit): the different vectors, scaled to length 1, as bytes.

    ``rep`` is the number of a row of the vector, so that rows may share ids; ``least`` is the vector's smallest id.
    """
    rows = _checked(embeddings).filter("valid").drop("valid")
    # -0.0 and 0.0 are one value.
    rows = rows.withColumn("vector", F.transform("vector", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x)))
    # Staged, so that row numbers stay and the optimizer does not carry the checks through the grouping and the join.
    rows = stage_compressed(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    groups = rows.groupBy("vector").agg(F.min("row").alias("rep"), F.min("vec_id").alias("least"), F.count("*").alias("copies"))

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = []
            for values in batch.column("vector").to_pylist():
                x = np.array(values, dtype=np.float64)
                x = x / np.abs(x).max()  # so that squares neither overflow nor vanish
                units.append((x / np.linalg.norm(x)).astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("copies"), pa.array(units, pa.binary())], ["rep", "copies", "unit"]
            )

    units = stage_compressed(groups.drop("least").mapInArrow(scale, "rep long, copies long, unit binary"), "units")
    classes = rows.join(groups.select("vector", "rep", "least"), "vector").select("vec_id", "rep", "least")
    return stage(classes, "vector-classes"), units


def _top(sims: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of each row's k largest entries, without the diagonal."""
    np.fill_diagonal(sims, -2)
    k = min(k, sims.shape[1] - 1)
    if k < 1:
        return np.zeros(0, int), np.zeros(0, int)
    columns = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    return np.repeat(np.arange(len(sims)), k), columns.reshape(-1)


def sign_bits(n: int) -> int:
    """Signs that deal n vectors to runs of about ``RUN``."""
    return min(30, max(0, int(np.ceil(np.log2(n / RUN))))) if n else 0


def orders_of(n: int) -> int:
    """Random orders of an effort over n vectors."""
    together = (1 - np.arccos(THRESHOLD) / np.pi) ** sign_bits(n)
    return ORDERS if together == 1 else max(ORDERS, int(np.ceil(np.log(1 - RECALL) / np.log(1 - together))))


def projected(units: DataFrame, orders: range, n: int) -> DataFrame:
    """Edges of several random orders, which are laid out one behind the other and walked in one job."""
    bits = sign_bits(n)
    axes_of: dict[tuple[int, int], np.ndarray] = {}

    def axes(order: int, length: int) -> np.ndarray:
        if (order, length) not in axes_of:
            axes_of[order, length] = np.random.default_rng([order, length]).standard_normal((bits + 1, length))
        return axes_of[order, length]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("unit"))
            for order in orders:
                keys = []
                for x in vectors:
                    at = axes(order, len(x)) @ x
                    sign = int("0" + "".join("1" if a > 0 else "0" for a in at[:bits]), 2)
                    keys.append(((order - orders.start) << 54) | (sign << 24) | int((np.tanh(at[bits]) + 1) / 2 * (2**24 - 1)))
                yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("unit"), pa.array(keys, pa.int64())], ["rep", "unit", "key"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reps: list[int] = []
        vectors: list[np.ndarray] = []
        current = None

        def edges() -> Iterator[pa.RecordBatch]:
            ids = np.array(reps)
            for length in {len(x) for x in vectors}:
                of = np.array([i for i, x in enumerate(vectors) if len(x) == length])
                x = np.stack([vectors[i] for i in of])
                sims = x @ x.T
                a, b = _top(sims, NEIGHBOURS)
                yield pa.RecordBatch.from_arrays([pa.array(ids[of[a]]), pa.array(ids[of[b]]), pa.array(sims[a, b])], ["v", "u", "sim"])

        for batch in batches:
            for rep, key, x in zip(batch.column("rep").to_pylist(), batch.column("key").to_pylist(), _matrix(batch.column("unit")), strict=True):
                if key >> 54 != current:
                    if len(reps) > 1:
                        yield from edges()
                    reps.clear()
                    vectors.clear()
                    current = key >> 54
                reps.append(rep)
                vectors.append(x)
                if len(reps) == RUN:
                    yield from edges()
                    del reps[: RUN // 2], vectors[: RUN // 2]
        if len(reps) > 1:
            yield from edges()

    keyed = stage(units.select("rep", "unit").mapInArrow(place, "rep long, unit binary, key long"), "projected")
    return Ranges(keyed, "key").sort(keyed, "key", "rep").mapInArrow(compare, _EDGE)


def best(edges: DataFrame, round_: int) -> DataFrame:
    """Each vertex's list: its most similar partners; a saturated list may be twice as long each round."""
    order = Window.partitionBy("v").orderBy(F.desc("sim"), "u")
    ranked = edges.groupBy("v", "u").agg(F.max("sim").alias("sim")).withColumn("rank", F.row_number().over(order))
    longer = (F.col("sim") >= THRESHOLD) & (F.col("rank") <= NEIGHBOURS << round_)
    return ranked.filter((F.col("rank") <= NEIGHBOURS) | longer).select("v", "u", "sim")


def refined(lists: DataFrame, units: DataFrame, round_: int) -> DataFrame:
    """Edges between neighbours of a common vertex that would improve a list."""
    worst = lists.groupBy("v").agg(F.min("sim").alias("worst"), F.count("*").alias("n"))
    worst = worst.select(F.col("v").alias("u"), F.when(F.col("n") >= NEIGHBOURS, F.col("worst")).otherwise(-2.0).alias("worst"))
    back = best(lists.select(F.col("u").alias("v"), F.col("v").alias("u"), "sim"), 0)
    around = lists.select("v", "u").union(back.select("v", "u")).distinct()
    around = around.join(worst, "u", "left").join(units.select(F.col("rep").alias("u"), "unit"), "u")

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, floor = table["u"].to_numpy(), table["worst"].fill_null(-2.0).to_numpy()
        x = np.stack(_matrix(table["unit"].chunk(0)))
        sims = x @ x.T
        better = sims > np.minimum(floor[:, None], floor[None, :])
        np.fill_diagonal(better, False)
        a, b = np.nonzero(better)
        return pa.table({"v": ids[a], "u": ids[b], "sim": sims[a, b]})

    return around.groupBy("v").applyInArrow(compare, _EDGE)


def _audit(found: DataFrame, units: DataFrame, n: int) -> tuple[float, int]:
    """Share of the asked vertices with links, all of whose links lead into their own component, and how many they are."""
    place = F.pmod(F.xxhash64("rep", F.lit("audit")), F.lit(1 << 30))
    asked, linked = AUDITED, 0
    while True:
        share = min(1.0, asked / max(1, n))
        # Asked vertices are dealt to parts that one task holds beside its own vectors.
        parts = -(-asked // (4 * AUDITED))
        sample = units.filter(place < F.lit(1 << 30) * share).select(
            "rep", "unit", F.pmod(F.xxhash64("rep", F.lit("part")), F.lit(parts)).cast("int").alias("part")
        )
        true = stage(_asked_links(sample, units, parts), "audit")
        linked = true.select("a").distinct().count()
        if linked >= LINKED or share == 1:
            break
        asked *= 4
    side = lambda name: found.select(F.col("id").alias(name), F.col("component").alias(f"of_{name}"))
    whole = F.min(F.coalesce(F.col("of_a") == F.col("of_b"), F.lit(False)).cast("int"))
    row = true.join(side("a"), "a", "left").join(side("b"), "b", "left").groupBy("a").agg(whole.alias("hit")).agg(F.sum("hit").alias("hit")).first()
    return (row["hit"] or 0) / linked if linked else 1.0, linked


def _asked_links(sample: DataFrame, units: DataFrame, parts: int) -> DataFrame:
    """(a, b): links of the sample's vertices to all vertices, by brute force."""
    asking = stage_compressed(sample, "asked")
    count = units.count()
    slots = max(1, -(-count // (8 * BLOCK)))
    slot = F.pmod(F.xxhash64("rep", F.lit("slot")), F.lit(slots)).cast("int")
    both = asking.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))).withColumn("asks", F.lit(True)).union(
        units.select("rep", "unit", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), slot.alias("slot"), F.lit(False).alias("asks"))
    )

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        reps, asks = table["rep"].to_numpy(), table["asks"].to_numpy(zero_copy_only=False).astype(bool)
        vectors = _matrix(table["unit"].combine_chunks())
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for length in {len(x) for x in vectors}:
            of = np.array([len(x) == length for x in vectors])
            one, two = np.flatnonzero(of & asks), np.flatnonzero(of & ~asks)
            if len(one) and len(two):
                q, r = np.nonzero(np.stack([vectors[i] for i in one]) @ np.stack([vectors[i] for i in two]).T >= THRESHOLD)
                other = reps[one[q]] != reps[two[r]]
                a.append(reps[one[q[other]]])
                b.append(reps[two[r[other]]])
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})

    return both.groupBy("part", "slot").applyInArrow(compare, "a long, b long")


def _stars(linked: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each id with the first of those that its links lead to, by a symmetric matrix of links."""
    first, before = np.arange(len(ids)), None
    while before is None or (first != before).any():
        before = first
        first = np.minimum(first, np.where(linked, first[None, :], len(ids)).min(axis=1))
        first = first[first]
    other = first != np.arange(len(ids))
    return ids[other], ids[first[other]]


def block_links(rows: DataFrame, units: DataFrame) -> DataFrame:
    """(a, b): edges that connect what the links between rows (id, component) of different components connect, exactly.

    Rows of a null component are compared with all others. Blocks of at most about ``BLOCK`` rows are compared unless the
    angle between their centers exceeds both radii and the threshold's angle.
    """
    sizes = rows.groupBy(F.col("component").alias("whole")).agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks"))
    members = stage_compressed(
        rows.join(sizes, F.col("component").eqNullSafe(F.col("whole"))).select("id", "component", own.alias("own"))
        .join(units.select(F.col("rep").alias("id"), "unit"), "id")
        .withColumn("length", F.length("unit")).withColumn("block", F.xxhash64("component", "own", "length")),
        "block-members",
    )

    def summarise(table: pa.Table) -> pa.Table:
        x = np.stack(_matrix(table["unit"].combine_chunks()))
        center = x.mean(axis=0)
        norm = np.linalg.norm(center)
        center = center / norm if norm > 1e-9 else x[0]
        radius = float(np.arccos(np.clip(x @ center, -1, 1)).max())
        first = lambda name: table[name].slice(0, 1).combine_chunks()
        return pa.table({"block": first("block"), "component": first("component"), "length": first("length"), "center": pa.array([center.astype("<f8").tobytes()], pa.binary()), "radius": [radius]})

    blocks = stage_compressed(
        members.groupBy("block").applyInArrow(summarise, "block long, component long, length int, center binary, radius double"), "blocks"
    )
    tiles = max(1, -(-blocks.count() // BLOCK))
    tile = F.pmod(F.xxhash64("block"), F.lit(tiles))
    dealt = blocks.withColumn("own", tile).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1).cast("long"))))
    dealt = dealt.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))

    def near(table: pa.Table) -> pa.Table:
        names, own, i, j = (table[c].to_numpy() for c in ("block", "own", "i", "j"))
        component, radius, length = table["component"].to_pylist(), table["radius"].to_numpy(), table["length"].to_numpy()
        alone = np.array([c is None for c in component])
        numbers = np.array([0 if c is None else c for c in component])
        left, right = [], []
        centers = _matrix(table["center"].combine_chunks())
        for size in set(length.tolist()):
            of = np.flatnonzero(length == size)
            x = np.stack([centers[k] for k in of])
            reach = radius[of][:, None] + radius[of][None, :] + np.arccos(THRESHOLD) + 1e-6
            close = np.arccos(np.clip(x @ x.T, -1, 1)) <= reach
            close &= (numbers[of][:, None] != numbers[of][None, :]) | alone[of][:, None] | alone[of][None, :]
            # Each pair of blocks once, from the only tile pair that has them on the right sides.
            close &= names[of][:, None] <= names[of][None, :]
            if i[0] != j[0]:
                close &= own[of][:, None] != own[of][None, :]
            a, b = np.nonzero(close)
            left.append(names[of][a])
            right.append(names[of][b])
        return pa.table({"one": np.concatenate(left), "two": np.concatenate(right)})

    pairs = stage(dealt.groupBy("i", "j").applyInArrow(near, "one long, two long"), "near-blocks")
    vectors = members.select("block", "id", "unit")
    sides = pairs.join(vectors, F.col("one") == F.col("block")).union(
        pairs.filter("one != two").join(vectors, F.col("two") == F.col("block"))
    )

    def compare(table: pa.Table) -> pa.Table:
        ids, block = table["id"].to_numpy(), table["block"].to_numpy()
        x = np.stack(_matrix(table["unit"].combine_chunks()))
        linked = x @ x.T >= THRESHOLD
        if (block != block[0]).any():
            linked &= block[:, None] != block[None, :]
        a, b = _stars(linked, ids)
        return pa.table({"a": a, "b": b})

    return sides.groupBy("one", "two").applyInArrow(compare, "a long, b long")


def groups_of(lists: DataFrame, units: DataFrame) -> DataFrame:
    """(id, component): components of the lists' links and of the links between saturated vertices that lists dropped."""
    links = stage(lists.filter(F.col("sim") >= THRESHOLD).select(F.col("v").alias("a"), F.col("u").alias("b")), "links")
    found = stage(components(links), "vector-components")
    saturated = links.groupBy("a").agg(F.count("*").alias("n")).filter(F.col("n") >= NEIGHBOURS).select(F.col("a").alias("id"))
    dropped = stage(block_links(found.join(saturated, "id"), units), "dropped-links")
    if not dropped.limit(1).count():
        return found
    return stage(components(found.select(F.col("id").alias("a"), F.col("component").alias("b")).union(dropped)), "vector-components")


def descend(units: DataFrame) -> tuple[DataFrame, float, int]:
    """The components of vertices with links, their audited recall, and the linked vertices it rests on."""
    n = units.count()
    orders = orders_of(n)
    lists = None
    for effort in range(EFFORTS):
        edges = projected(units, range(effort * orders, (effort + 1) * orders), n)
        lists = stage(best(edges if lists is None else lists.union(edges), 0), "lists")
        for round_ in range(1, ROUNDS + 1):
            before = lists.agg(F.count("*"), F.sum("sim")).first()
            lists = stage(best(lists.union(refined(lists, units, round_)), round_), "lists")
            after = lists.agg(F.count("*"), F.sum("sim")).first()
            if before[0] == after[0] and (after[1] or 0) - (before[1] or 0) < 1e-4 * max(1, n):
                break
        found = groups_of(lists, units)
        recall, linked = _audit(found, units, n)
        _LOG.info("effort %d: recall %.4f of %d linked vertices", effort + 1, recall, linked)
        if recall >= RECALL:
            return found, recall, linked
    _LOG.warning("recall %.4f of %d linked vertices is below %.2f: all vectors are compared", recall, linked, RECALL)
    every = block_links(units.select(F.col("rep").alias("id"), F.lit(None).cast("long").alias("component")), units)
    return stage(components(every), "vector-components"), 1.0, linked


def link_counts(found: DataFrame, units: DataFrame) -> DataFrame:
    """(rep, links): linked other rows within the component, copies of linked vectors counted each."""
    sizes = found.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    placed = (
        found.join(sizes, "component").withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") <= F.col("other")).alias("left"), F.col("id").alias("rep"))
        .join(units, "rep")
    )

    def count(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        reps, copies = table["rep"].to_numpy(), table["copies"].to_numpy()
        left = table["left"].to_numpy(zero_copy_only=False).astype(bool)
        x = np.stack(_matrix(table["unit"].chunk(0)))
        if left.all():
            linked = x @ x.T >= THRESHOLD
            np.fill_diagonal(linked, False)
            return pa.table({"rep": reps, "links": linked @ copies})
        linked = x[left] @ x[~left].T >= THRESHOLD
        return pa.table({"rep": np.concatenate((reps[left], reps[~left])), "links": np.concatenate((linked @ copies[~left], linked.T @ copies[left]))})

    counted = placed.groupBy("component", "i", "j").applyInArrow(count, "rep long, links long")
    return counted.groupBy("rep").agg(F.sum("links").alias("links"))


def near_duplicates(embeddings: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per input row; kept marks each component's smallest id."""
    classes, units = vertices(embeddings)
    found, recall, linked = descend(units)
    least = found.join(classes.select(F.col("rep").alias("id"), "least").distinct(), "id").groupBy("component").agg(F.min("least").alias("component_id"))
    named = found.join(least, "component").select(F.col("id").alias("rep"), "component_id")
    counts = link_counts(found, units).join(named, "rep")
    known = units.select("rep", "copies").join(counts, "rep", "left").select(
        "rep", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    valid = classes.join(known, "rep").select("vec_id", "n_links", F.coalesce("component_id", "least").alias("component_id"))
    others = _checked(embeddings).filter("not valid").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    rows = valid.union(others).withColumn("kept", F.col("vec_id") == F.col("component_id"))
    return rows.withMetadata("component_id", {"recall": recall, "audited": linked})
