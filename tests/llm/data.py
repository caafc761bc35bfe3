"""Small tables with everything that must not crash an operator."""

from __future__ import annotations

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, key string, rep string, slot int, score string"
LONG = " ".join(f"w{i % 977}x{i // 7}" for i in range(30_000))


def rows(n: int = 60, seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    english = "the of and to in that was for with this from have not are they which".split()
    german = "der die und das nicht mit sich auf für ist dem eine auch über zwischen straße".split()
    out = []
    for i in range(n):
        lang, words = (("en", english), ("de", german))[i % 2]
        text = " ".join(rng.choice(words) + rng.choice(["", "", "ly", "en"]) for _ in range(rng.randint(25, 80)))
        out.append((text, lang))
    base = out[0][0].split()
    near = [*base[:-1], "other"]
    out += [(" ".join(base), "en"), (" ".join(near), "en"), (out[1][0], "de"), (out[1][0], "de")]
    out += [(None, "en"), ("", "en"), (" \n\t ", None), ("123 456 !!", "en"), ("word", "en"), ("a b", None), (LONG, "en")]
    out += [("x y z " * 40, "en"), ("émigré naïve — “quoted” it's <|endoftext|> 日本", None), ("line\nline\nother\nline", "en")]
    return [(i, text, lang, f"s{i % 3}", None, "k", None, i, "s") for i, (text, lang) in enumerate(out)]


def documents(spark, extra: list[tuple] = ()):
    """All of it, with a repeated row and a null id."""
    data = rows()
    data += [data[3], (None, "a row without an id that has some words in it", "en", None, None, None, None, None, None), *extra]
    return spark.createDataFrame(data, DOCUMENTS).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)
