"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``VIRTUAL_NODES`` points of a ring of ``RING_SLOTS`` slots. A row hashes to a slot and belongs to the
shard of the next point clockwise. A shard takes ``floor(n / shards)`` rows, the first ``n mod shards`` shards one more;
rows of a full shard continue clockwise, first in first out, to the next point whose shard has room. The capacities add up
to n, so row counts differ by one at most, and only the excess of the shards that hashing overfills leaves its home, which
is the least movement that can balance them.

Everything that decides the flow is a table over ring slots, whose size is a parameter and not the data's. The rows
themselves (no texts) are shuffled once, by slot, to be numbered within their slot.

Defined results: a null text has size 8 and crc32 0; null ids hash to one slot; rows equal in id, size and crc32 are
interchangeable; an empty table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lintlake.functions.scale import stage

RING_SLOTS = 65_536
VIRTUAL_NODES = 64
ROW_OVERHEAD = 8


def _slot(*parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(RING_SLOTS)).cast("int")


def sized_rows(documents: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32): what sharding needs of a row, without its text."""
    text = F.col("text").cast("string")
    return documents.select(
        F.col("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
        F.coalesce(F.crc32(F.encode(text, "UTF-8")), F.lit(0)).cast("long").alias("text_crc32"),
    )


def ring(spark: SparkSession, shards: int) -> DataFrame:
    """One row per ring slot: the shard that owns it, and its arc, the slot of the owner's point."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    points = (
        spark.range(shards * VIRTUAL_NODES, numPartitions=1)
        .select((F.col("id") % shards).cast("int").alias("shard"), F.expr(f"id div {shards}").alias("replica"))
        .select(_slot(F.lit("point"), F.col("shard"), F.col("replica")).alias("point"), "shard")
        .groupBy("point")
        .agg(F.min_by("shard", F.xxhash64("point", "shard")).alias("shard"))
    )
    ahead = Window.orderBy(F.desc("slot")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy()
    slots = spark.range(RING_SLOTS, numPartitions=1).select(F.col("id").cast("int").alias("slot"))
    owned = slots.join(points, slots["slot"] == points["point"], "left")
    first = F.min_by("shard", "point").over(whole), F.min("point").over(whole)
    return owned.select(
        "slot",
        F.coalesce(F.last("shard", True).over(ahead), first[0]).alias("owner"),
        F.coalesce(F.last("point", True).over(ahead), first[1]).alias("arc"),
    )


def _events(arcs: DataFrame, shards: int) -> DataFrame:
    """One row: which stretch of the overflow queue goes to which shard, found by walking the ring twice."""
    ordered = arcs.agg(F.sort_array(F.collect_list(F.struct("arc", "owner", "overflow", "free"))).alias("arcs"))
    free = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda s: F.coalesce(
            F.element_at(F.filter("arcs", lambda a: a["owner"] == s.cast("int")), 1)["free"], F.lit(0).cast("long")
        ),
    )
    event_type = "array<struct<shard:int,lo:long,hi:long,base:long>>"
    start = F.struct(
        F.lit(0).cast("long").alias("carry"),
        F.lit(0).cast("long").alias("placed"),
        free.alias("free"),
        F.transform(free, lambda x: x * 0).alias("taken"),
        F.array().cast(event_type).alias("events"),
    )
    # The second walk brings no new overflow.
    walk = F.concat("arcs", F.transform("arcs", lambda a: a.withField("overflow", F.lit(0).cast("long"))))

    def visit(state: Column, arc: Column) -> Column:
        carry = state["carry"] + arc["overflow"]
        room = F.element_at(state["free"], arc["owner"] + 1)
        taken = F.least(carry, room)
        add = lambda array, sign: F.transform(
            array, lambda x, i: F.when(i == arc["owner"], x + taken * sign).otherwise(x)
        )
        event = F.struct(
            arc["owner"].cast("int").alias("shard"),
            state["placed"].alias("lo"),
            (state["placed"] + taken).alias("hi"),
            F.element_at(state["taken"], arc["owner"] + 1).alias("base"),
        )
        return F.when(taken > 0, F.struct(
            (carry - taken).alias("carry"),
            (state["placed"] + taken).alias("placed"),
            add(state["free"], -1).alias("free"),
            add(state["taken"], 1).alias("taken"),
            F.concat(state["events"], F.array(event)).cast(event_type).alias("events"),
        )).otherwise(F.struct(
            carry.alias("carry"), state["placed"].alias("placed"), state["free"].alias("free"),
            state["taken"].alias("taken"), state["events"].alias("events"),
        ))

    return ordered.select(F.aggregate(walk, start, visit)["events"].alias("events"))


def flow(rows: DataFrame, shards: int) -> DataFrame:
    """Per ring slot: how many of its rows stay with the owner, and where the others go. Staged; RING_SLOTS rows."""
    spark = rows.sparkSession
    counts = rows.groupBy("slot").agg(F.count("*").alias("n"))
    every = Window.partitionBy()
    before_in_shard = Window.partitionBy("owner").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("n").over(every)
    slots = (
        ring(spark, shards)
        .join(counts, "slot", "left")
        .withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
        .withColumn("capacity", F.floor(total / shards) + F.when(F.col("owner") < total % shards, 1).otherwise(0))
        .withColumn("first", F.least(F.coalesce(F.sum("n").over(before_in_shard), F.lit(0)), F.col("capacity")))
        .withColumn("kept", F.least(F.col("n"), F.col("capacity") - F.col("first")))
        .withColumn("overflow", F.col("n") - F.col("kept"))
        .withColumn("queued", F.coalesce(F.sum("overflow").over(before), F.lit(0)))
        .withColumn("home", F.sum("kept").over(Window.partitionBy("owner")))
    )
    slots = stage(slots, "ring-slots")
    arcs = slots.groupBy("arc", "owner").agg(
        F.sum("overflow").alias("overflow"), F.first(F.col("capacity") - F.col("home")).alias("free")
    )
    homes = slots.groupBy().agg(
        F.map_from_entries(F.collect_set(F.struct(F.col("owner"), F.col("home")))).alias("homes")
    )
    end = F.col("queued") + F.col("overflow")
    mine = F.filter("all_events", lambda e: (e["lo"] < end) & (e["hi"] > F.col("queued")))
    flowing = slots.withColumns({"all_events": _events(arcs, shards).scalar(), "homes": homes.scalar()})
    return flowing.select(
        "slot", "owner", "first", "kept", "queued",
        F.when(F.col("overflow") > 0, mine).alias("events"),
        F.when(F.col("overflow") > 0, F.col("homes")).alias("homes"),
    )


def shard_rows(documents: DataFrame, shards: int) -> DataFrame:
    """Assign every document to a shard.

    Returns doc_id, size, text_crc32, law, shard, slot (the position in the shard, gapless from 0), grown_shard (null: row
    counts decide, so there is no shard by key alone), home_shard (the shard before loads were bounded).
    """
    rows = stage(
        sized_rows(documents)
        .withColumn("hash", F.xxhash64(F.lit("row"), F.col("doc_id")))
        .withColumn("slot", _slot(F.lit("slot"), F.col("hash"))),
        "shard-rows",
    )
    order = Window.partitionBy("slot").orderBy("hash", "doc_id", "text_crc32", "size")
    rank = F.col("rank")
    at = F.col("queued") + rank - F.col("kept")
    moved = F.element_at(F.filter("events", lambda e: (e["lo"] <= at) & (at < e["hi"])), 1)
    stays = rank < F.col("kept")
    return (
        rows.withColumn("rank", F.row_number().over(order) - 1)
        .join(flow(rows, shards), "slot")
        .withColumn("event", F.when(~stays, moved))
        .select(
            "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
            F.when(stays, F.col("owner")).otherwise(F.col("event")["shard"]).cast("int").alias("shard"),
            F.when(stays, F.col("first") + rank)
            .otherwise(F.coalesce(F.element_at("homes", F.col("event")["shard"]), F.lit(0)) + F.col("event")["base"] + at - F.col("event")["lo"])
            .cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            F.col("owner").cast("int").alias("home_shard"),
        )
    )
