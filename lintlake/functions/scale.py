"""Joins and ranks that stay balanced when one key holds a large share of the rows, and staging."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

MAX_SALTS = 16
RANK_BUCKET_DIGITS = 3


def salt_count(spark: SparkSession) -> int:
    """Copies of a lookup row. Sixteen bring a key with a third of all rows down to two percent per task.

    More would be unsafe: where Spark broadcasts a lookup by its own size estimate (at most
    ``spark.sql.autoBroadcastJoinThreshold``), the copies travel along.
    """
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(MAX_SALTS, partitions // 8))


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    spread: Sequence[str],
    how: str = "left",
    salts: int | None = None,
) -> DataFrame:
    """Join many ``rows`` to a much smaller ``lookup``.

    Spark broadcasts the lookup by itself when its measured size allows. Beyond that the rows are
    shuffled, and a key that owns a large share of them is split: each lookup row is copied once per
    salt and each left row takes the salt of its ``spread`` columns. Adaptive execution can split the
    salted partitions further.
    """
    salts = salt_count(rows.sparkSession) if salts is None else salts
    if salts <= 1:
        return rows.join(lookup, list(on), how)
    salted_rows = rows.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    salted_lookup = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_rows.join(salted_lookup, [*on, "_salt"], how).drop("_salt")


def catalog_join(rows: DataFrame, catalog: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join many ``rows`` to a lookup that grows with the data, as catalogs of tools do: merged at every size.

    Spark estimates a lookup by its compressed files and does not count copies, so :func:`lookup_join` has it broadcast
    millions of rows. Nothing is copied here: adaptive execution splits the partitions that a hot key fills.
    """
    return rows.join(catalog.hint("merge"), list(on), how)


def spread_rank(rows: DataFrame, keys: Sequence[str], by: str, name: str) -> DataFrame:
    """0-based position of each row among the rows with the same ``keys``, in the order (md5(by), by).

    For lists whose order carries no meaning but must be fixed. A plain ``row_number`` would send all
    rows of a key to one task. The leading digits of the hash cut each key into 4096 even slices that
    are numbered on their own, and only the slice counts are summed up per key. The slices depend on
    the data alone, so a recomputed task gives the same numbers. ``by`` must be unique within ``keys``.
    """
    keys = list(keys)
    hashed = rows.withColumn("_hash", F.md5(F.col(by)))
    hashed = hashed.withColumn("_slice", F.substring("_hash", 1, RANK_BUCKET_DIGITS))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        hashed.groupBy(*keys, "_slice")
        .agg(F.count("*").alias("_n"))
        .select(*keys, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    within = Window.partitionBy(*keys, "_slice").orderBy("_hash", by)
    return (
        hashed.withColumn("_pos", F.row_number().over(within) - 1)
        .join(offsets, [*keys, "_slice"])
        .withColumn(name, (F.col("_offset") + F.col("_pos")).cast("int" if name.endswith("index") else "bigint"))
        .drop("_hash", "_slice", "_pos", "_offset")
    )


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a temporary one only for a local session."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="lintlake-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Write a result that several later steps read, and read it back.

    Cuts the lineage in storage that outlives executors, computes the input once, and gives the
    optimizer its true size, so that it can tell whether a broadcast is safe. Rows are kept apart ``by``
    columns of few values, so that a reader of one value reads nothing else.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(df.columns)


MAX_HOT_KEYS = 1000
#: Copies of a hot key for each 1/MAX_HOT_KEYS of all rows. With one, tasks differ by whole copies that fall together.
COPIES_PER_SHARE = 4


def weighted_join(
    rows: DataFrame,
    groups: DataFrame,
    on: Sequence[str],
    weight: str,
    spread: Sequence[str],
    how: str = "inner",
    salts: int | None = None,
) -> DataFrame:
    """Join ``rows`` to per-key ``groups`` that know how many rows each key has (column ``weight``).

    For group tables too large to copy as a whole. A key above 1/MAX_HOT_KEYS of the total weight is copied as often as
    its weight needs, COPIES_PER_SHARE times for each such share, whatever the number of partitions; other keys are joined as
    they are. There are fewer than MAX_HOT_KEYS hot keys whatever the data, with a bounded number of copies in all, so that
    list alone is broadcast. ``salts`` limits the copies of a key. ``groups`` is staged, since it is read three times.
    """
    on = list(on)
    groups = stage(groups, "weighted-groups")
    total = groups.agg(F.sum(weight)).first()[0] or 0
    shares = F.col(weight) * MAX_HOT_KEYS
    copies = F.ceil(shares * COPIES_PER_SHARE / F.lit(max(1, total))).cast("int")
    copies = copies if salts is None else F.least(copies, F.lit(max(1, salts)))
    hot = groups.filter(shares > F.lit(total)).select(*on, copies.alias("_copies"))
    salt = F.when(F.col("_copies").isNotNull(), F.pmod(F.xxhash64(*spread), F.col("_copies")).cast("int")).otherwise(F.lit(0))
    salts = F.when(shares > F.lit(total), F.sequence(F.lit(0), copies - 1)).otherwise(F.array(F.lit(0)))
    return (
        rows.join(F.broadcast(hot), on, "left")
        .withColumn("_salt", salt)
        .drop("_copies")
        .join(groups.withColumn("_salt", F.explode(salts)), [*on, "_salt"], how)
        .drop("_salt")
    )
