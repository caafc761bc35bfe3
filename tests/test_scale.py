"""Skewed inputs: the balanced forms give what the plain ones give."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import Window, functions as F

from lintlake.functions import scale
from lintlake.operators import analysers, export, merge, report


def skewed(table, n=600):
    """One key holds a third of the rows."""
    rng = random.Random(7)
    rows = [("hot" if i % 3 == 0 else f"k{rng.randrange(40)}", f"f{i}") for i in range(n)]
    return table(rows, "k string, f string")


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_lookup(table, how):
    rows = skewed(table)
    lookup = table([("hot", 1), ("k1", 2), ("k1", 3), ("none", 4)], "k string, v int")
    plain = rows.join(lookup, "k", how)
    salted = scale.lookup_join(rows, lookup, ["k"], spread=["f"], how=how, salts=7)
    assert sorted(map(tuple, salted.select(*plain.columns).collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_weighted_join(table):
    rows = skewed(table)
    groups = rows.groupBy("k").agg(F.count("*").alias("n")).filter("n > 2")
    plain = rows.join(groups, "k")
    salted = scale.weighted_join(rows, groups, ["k"], "n", spread=["f"], salts=5)
    assert sorted(map(tuple, salted.select(*plain.columns).collect())) == sorted(map(tuple, plain.collect()))


def test_spread_rank_counts_every_key(table):
    rows = skewed(table)
    ranked = scale.spread_rank(rows, ["k"], "f", "at")
    order = Window.partitionBy("k").orderBy(F.md5("f"), "f")
    plain = rows.withColumn("at", F.row_number().over(order) - 1)
    assert sorted(map(tuple, ranked.select("k", "f", "at").collect())) == sorted(map(tuple, plain.collect()))


@pytest.mark.parametrize("size", [-10, 0, 1, 5, 7, 5000])
def test_batches_equal_the_greedy_walk(table, size):
    rng = random.Random(size)
    counts = [0, 0, 0, 1, 1, 2, 3, 4, 5, 6, 8, 30]
    rows = [("p", "t", lang, f"f{i}", rng.choice(counts)) for lang in ("a", "b", "c") for i in range(120)]
    rows += [("p", "t", "zero", f"f{i}", 0) for i in range(5)] + [("p", "t", "big", "f", 99)]
    files = table(rows, "project string, tool string, language string, filename string, n_results long")
    got = {(r.language, r.filename): r.batch for r in export.upload_batches(files, size).collect()}
    limit = size if size > 0 else 50000
    by_run = defaultdict(list)
    for _, _, lang, name, n in rows:
        by_run[lang].append((-min(n, limit), hashlib.md5(name.encode()).hexdigest(), name, n))
    for lang, members in by_run.items():
        batches, current, total = [], [], 0
        for *_, name, n in sorted(members):
            if total + n >= limit:
                batches.append(current)
                current, total = [], 0
            current.append(name)
            total += n
        batches = [b for b in [*batches, current] if b]
        assert {got[lang, name] for b in batches for name in b} == set(range(len(batches)))
        for i, batch in enumerate(batches):
            assert {got[lang, name] for name in batch} == {i}
    if size in (-10, 0, 5000):
        assert set(got.values()) == {0}


def brute_force_clones(files, window=5):
    """Duplicated windows grown as far as all their occurrences agree."""
    norm = {name: [" ".join(line.split()) for line in text.split("\n")] for name, text in files}
    places = defaultdict(list)
    for name, lines in norm.items():
        for i in range(len(lines) - window + 1):
            block = tuple(lines[i : i + window])
            if any(block):
                places[block].append((name, i))
    repeated = {b: at for b, at in places.items() if len(at) >= 2}

    def following(block):
        after = set()
        for name, i in repeated[block]:
            nxt = tuple(norm[name][i + 1 : i + 1 + window])
            after.add(nxt if len(nxt) == window and nxt in repeated else None)
        if len(after) == 1 and None not in after:
            nxt = after.pop()
            if len(repeated[nxt]) == len(repeated[block]):
                return nxt
        return None

    chained = {b: following(b) for b in repeated}
    inner = {n for n in chained.values() if n}
    out = Counter()
    for block in repeated:
        if block in inner:
            continue
        length, last = window, block
        while chained[last]:
            last, length = chained[last], length + 1
        for name, i in repeated[block]:
            out[name, i + 1, i + length] += 1
    return out


@pytest.mark.parametrize("seed", range(4))
def test_clones_equal_brute_force(table, seed):
    rng = random.Random(seed)
    lines = [f"line {i}" for i in range(6)] + ["", "  "]
    block = [f"shared  {i}" for i in range(9)]
    files = []
    for i in range(12):
        body = [rng.choice(lines) for _ in range(rng.randrange(3, 25))]
        if i % 3 == 0:
            at = rng.randrange(len(body))
            body[at:at] = [f"\t{b.replace('  ', ' ')} " if i % 2 else b for b in block]
        files.append((f"f{i}", "\n".join([*body, f"end {i}"])))
    frame = table([("p", "L", n, t) for n, t in files], "project string, language string, filename string, text string")
    found = analysers.detect_clones(frame).cache()
    mine = Counter((r.filename, r.start_line, r.end_line) for r in found.collect())
    assert mine == brute_force_clones(files)
    sizes = found.groupBy("clone_id").agg(F.count("*").alias("n"), F.countDistinct("nr_lines").alias("d")).collect()
    assert all(r.n >= 2 and r.d == 1 for r in sizes)


def test_operators_under_salting(spark, table):
    """With many shuffle partitions the salted joins are on; nothing changes."""
    files = [("p", "L", f"f{i}", "\n".join(["a b", "c", "", "d", "e f", "g"][: 4 + i % 3] + ["same"] * 2 + [str(i % 5)])) for i in range(60)]
    frame = table(files, "project string, language string, filename string, text string")

    def outcome():
        found = analysers.detect_clones(frame)
        kept = merge.filter_clones(found, frame.filter("filename <> 'f3'"), clone=("project", "language", "clone_id"))
        grouped = report.clone_files_grouped(kept)
        return sorted(map(str, kept.collect())), sorted(map(str, grouped.collect()))

    before = outcome()
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        assert scale.salt_count(spark) == 5
        assert outcome() == before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_a_hot_key_is_copied_by_its_weight(spark):
    """A third of all rows in one key: at 200 partitions the largest task stays below twice the median."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    for key, value in zip(before, ("200", "false", "-1")):
        spark.conf.set(key, value)
    try:
        n = 300_000
        rows = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 20_000).alias("k"), "id")
        groups = rows.groupBy("k").agg(F.count("*").alias("n"))
        joined = scale.weighted_join(rows, groups, ["k"], "n", spread=["id"])
        assert joined.count() == n and joined.filter("k = -1").agg(F.min("n"), F.max("n")).first() == (n // 3, n // 3)
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        assert len(sizes) == 200 and sizes[-1] < 2 * sizes[100]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
