"""The order of n-grams comes from counts over all texts, and rows that leave sets lose no link."""

from __future__ import annotations

import random

import numpy as np
import pytest

from lintlake.llm import jaccard
from lintlake.llm.tokens import SpanHash


def grams_of(texts, width):
    import pyarrow as pa

    return jaccard.shingle_sets(pa.array(texts, pa.string()), width, SpanHash())


def test_every_text_is_counted(spark):
    """A passage of three texts out of 30,000 is known as frequent, wherever they are."""
    rows = [(i, f"w{i} x{i} y{i}") for i in range(30_000)]
    for i in (5, 14_999, 29_998):
        rows[i] = (i, "one common passage")
    levels = jaccard.frequency_levels(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), 3)
    (common,) = grams_of(["one common passage"], 3)
    assert levels[jaccard.bucket(common)].min() >= 1
    every = np.concatenate(grams_of([t for _, t in rows], 3))
    counts = np.bincount(jaccard.bucket(every), minlength=jaccard.BUCKETS)
    assert ((levels > 0) == (counts > 2)).all()


def brute_force(docs, width, percent):
    sets = {i: set(s.tolist()) for (i, _), s in zip(docs, grams_of([t for _, t in docs], width))}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("percent", [50, 80, 84, 90])
def test_rows_that_leave_sets_keep_their_links(spark, percent):
    rng = random.Random(percent)
    shared = [f"s{i}" for i in range(60)]
    docs = []
    for i in range(60):
        words = [f"v{rng.randrange(400)}" for _ in range(rng.choice([40, 200, 500]))]
        docs.append(words + shared[: rng.choice([0, 20, 60])])
        for _ in range(rng.randrange(4)):
            near = list(docs[rng.randrange(len(docs))])
            for _ in range(rng.randrange(1, 1 + len(near) // 25)):
                near[rng.randrange(len(near))] = f"u{rng.randrange(10**6)}"
            docs.append(near)
    docs = [(i, " ".join(words)) for i, words in enumerate(docs)]
    found = jaccard.join(spark.createDataFrame(docs, "doc_id long, text string"), width=3, percent=percent)
    expected = brute_force(docs, 3, percent)
    assert len(set(expected.values())) < len(docs)
    assert {r.doc_id: r.component_id for r in found.collect()} == expected
