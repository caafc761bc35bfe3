"""Cases found by review: forced hash collisions, shared ids, inputs that once ended a job."""

from __future__ import annotations

import json
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lintlake.llm import bpe, chat, jaccard, neighbours, tokens

PATH = tokens.vocabulary_path()
CALLS = "conv_id long, call_id string, parent_id string, position long, tool string, arguments string"
RESULTS = "conv_id long, call_id string, position long, content string"


def thue_morse(doublings: int) -> tuple[str, str]:
    swap = str.maketrans("ab", "ba")
    word = "a"
    for _ in range(doublings):
        word += word.translate(swap)
    return word, word.translate(swap)


@pytest.mark.parametrize("backend", [tokens.Library, bpe.Transducer])
def test_words_that_collide_in_polynomials_keep_their_ids(backend):
    library = Tokenizer.from_file(PATH)
    text = " ".join(thue_morse(11))
    ids, _ = tokens.Encoder(backend(PATH)).encode(pa.array([text, "a", text[::-1]]))
    assert ids.tolist() == [i for t in (text, "a", text[::-1]) for i in library.encode(t, add_special_tokens=False).ids]


def test_shingle_sets_of_such_words_differ():
    one, other = thue_morse(12)
    first, second = jaccard.shingle_sets(pa.array([f"x y {one}", f"x y {other}"]), 3, tokens.SpanHash())
    assert len(first) == len(second) == 1 and first[0] != second[0]


def test_span_hashes_depend_on_bytes_and_length_alone():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 3, 5000, dtype=np.uint8)
    cuts = np.unique(np.concatenate(([0, 5000], rng.integers(0, 5000, 900))))
    found = tokens.SpanHash()(data, cuts[:-1], cuts[1:])
    texts = [data[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    by_text = {}
    for text, value in zip(texts, found.tolist(), strict=True):
        assert by_text.setdefault(text, value) == value
        assert tokens.SpanHash()(np.frombuffer(text, np.uint8), np.array([0]), np.array([len(text)]))[0] == value
    assert len(set(by_text.values())) == len(by_text)
    assert len(tokens.SpanHash()(data, cuts[:0], cuts[:0])) == 0


def test_rows_that_share_an_id(spark):
    v0, v1, v2, v3 = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.99, 0.05, 0.0], [0.0, 0.0, 1.0]
    rows = [(1, v0), (1, v1), (2, v2), (2, None), (5, v3), (5, v3), (7, [0.0, 0.0, 0.0]), (None, v0), (4, v1)]
    found = neighbours.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in found.collect())
    assert got == Counter([(1, 1, 1), (1, 1, 1), (2, 1, 1), (2, 0, 2), (5, 1, 5), (5, 1, 5), (7, 0, 7), (None, 0, None), (4, 1, 1)])


SCHEMA = '{"type": "object", "properties": {"q": {"enum": [1]}}}'


@pytest.mark.parametrize(
    ("arguments", "schema", "error"),
    [
        ('{"q":"\\ud800"}', "{}", None), ("[" * 100_000 + "]" * 100_000, "{}", "arguments are not JSON"),
        ('{"q":NaN}', "{}", "arguments are not JSON"), ('{"q":1e999}', "{}", "arguments are not JSON"),
        ('{"q":-Infinity}', "{}", "arguments are not JSON"), ('{"q":true}', SCHEMA, "$.q is not one of the allowed values"),
        ('{"q":1.0}', SCHEMA, None), ("{}", '{"type": "text"}', "schema is not usable"), ("{}", "no", "schema is not a JSON object"),
        ("{}", "[1]", "schema is not a JSON object"), ("{}", '{"required": 5}', "schema is not usable"),
        ("1", '{"minimum": "a"}', "schema is not usable"), ('"' + "x" * 2_000_000 + '"', "{}", None), ("", "{}", "arguments are not JSON"),
    ],
)
def test_any_arguments_and_schemas_give_a_row(spark, arguments, schema, error):
    calls = spark.createDataFrame([(1, "c", None, 1, "t", arguments)], CALLS)
    results = spark.createDataFrame([], RESULTS)
    row = chat.link(calls, results, spark.createDataFrame([("t", schema)], "tool string, schema string")).collect()
    assert [r["error"] for r in row] == [error]
    line = json.loads(row[0]["line"])
    assert error == "arguments are not JSON" or line["arguments"] == json.loads(arguments)
    row[0]["line"].encode()


def test_links_and_depths_against_a_plain_walk(spark):
    rng = random.Random(4)
    calls, results = [], []
    for conv in range(12):
        names = [f"c{i}" for i in range(rng.randint(1, 9))]
        for at, name in enumerate(names):
            parent = rng.choice([None, "gone", *names])
            calls.append((conv, name, parent, at, "t", json.dumps({"b": at, "a": name})))
        results += [(conv, rng.choice([*names, "nobody"]), i, f"r{i}") for i in range(rng.randint(0, 9))]
    tools = spark.createDataFrame([("t", "{}")], "tool string, schema string")
    found = chat.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), tools).collect()
    parents = {(c, n): p for c, n, p, *_ in calls}

    def depth(conv, name):
        seen = []
        while (conv, parents[conv, name]) in parents:
            if name in seen:
                return None
            seen.append(name)
            name = parents[conv, name]
        return len(seen)

    answers: dict = {}
    orphans = Counter((c, n, content) for c, n, _, content in results if (c, n) not in parents)
    for conv, name, position, content in sorted(results, key=lambda r: (r[2], r[3])):
        answers.setdefault((conv, name), content)
    for row in found:
        key = row["conv_id"], row["call_id"]
        line = json.loads(row["line"])
        if row["kind"] == "orphan":
            orphans[(*key, line["result"])] -= 1
            continue
        assert row["depth"] == depth(*key) and (row["error"] == "cycle") == (row["depth"] is None)
        assert row["answered"] == (key in answers) and line.get("result") == answers.get(key)
        assert row["line"] == json.dumps(line, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert Counter((r["conv_id"], r["call_id"]) for r in found if r["kind"] != "orphan") == Counter(parents.keys())
    assert not any(orphans.values())
