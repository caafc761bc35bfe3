from __future__ import annotations

import collections
import json
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lintlake.llm import chat, graph, html, jaccard, language_id, neighbours, quality, sharding
from tests.llm import data

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_codewords_differ_in_many_bits():
    for n in (2, 3, 4, 6, 20):
        code = language_id.codewords(n)
        assert (np.abs(code.sum(axis=0)) < n).all()
        distance = (code[:, None, :] != code[None, :, :]).sum(axis=2) + np.eye(n, dtype=int) * 99
        assert distance.min() >= (1 if n == 2 else 2 ** (n - 2) if n <= 6 else 12)


def test_language_id(spark):
    docs = data.documents(spark)
    model = language_id.train(docs)
    rows = {r["doc_id"]: r for r in language_id.predict(docs.select("doc_id", "text", "score"), model).collect()}
    for r in data.rows()[:60]:
        assert rows[r[0]]["lang_pred"] == r[2] and 0 <= rows[r[0]]["score"] <= 1
    for r in data.rows():
        if r[1] is None or not any(c.isalpha() for c in r[1]):
            assert rows[r[0]]["lang_pred"] == "und" and rows[r[0]]["score"] == 0
    nothing = language_id.predict(docs, language_id.train(data.empty(spark)))
    assert {r["lang_pred"] for r in nothing.select("lang_pred").collect()} == {"und"}
    assert language_id.predict(data.empty(spark), model).count() == 0


def test_shards(spark):
    docs = data.documents(spark)
    for shards in (1, 5, 24):
        rows = sharding.shard_rows(docs, shards).collect()
        assert len(rows) == docs.count()
        counts = collections.Counter(r["shard"] for r in rows)
        assert max(counts.values()) - min(counts[s] for s in range(shards)) <= 1
        for s in range(shards):
            assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))
        # No more leave their home than the shards there can't hold.
        home = collections.Counter(r["home_shard"] for r in rows)
        assert sum(r["shard"] != r["home_shard"] for r in rows) == sum(max(0, home[s] - counts[s]) for s in range(shards))
    texts = {r[0]: (r[1] or "").encode() for r in data.rows()}
    for r in rows:
        if r["doc_id"] is not None:
            assert r["size"] == len(texts[r["doc_id"]]) + 8 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]])
    assert sharding.shard_rows(data.empty(spark), 24).count() == 0


def test_overflow_goes_to_the_next_shard_with_room(spark):
    rows = sharding.shard_rows(spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text")), 4).collect()
    ring = sharding.ring(spark, 4).orderBy("slot").collect()
    points = sorted({(r["arc"], r["owner"]) for r in ring})
    hashed = {r["doc_id"]: r["slot"] for r in spark.range(3000).select(F.col("id").alias("doc_id"), sharding._slot(F.lit("slot"), F.xxhash64(F.lit("row"), "id")).alias("slot")).collect()}
    home = collections.Counter(r["home_shard"] for r in rows)
    free = {s: 750 - min(750, home[s]) for s in range(4)}
    moved = sorted((r for r in rows if r["shard"] != r["home_shard"]), key=lambda r: hashed[r["doc_id"]])
    assert moved and collections.Counter(r["shard"] for r in moved) == {s: n for s, n in free.items() if n}
    for r in moved:
        assert ring[hashed[r["doc_id"]]]["owner"] == r["home_shard"]
    assert len(points) > 200


def brute_measures(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts, covered = collections.Counter(windows), set()
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality_measures_and_base_rules(spark):
    extra = [(900 + i, t, "en", None, None, None, None, None, None) for i, t in enumerate(["a b c d e f g h", "a b c d e f g h a b c d e f g h", "p\x0bq\x1cr # <>", "ä\n\nä\n ä"])]
    docs = data.documents(spark, extra)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = quality.judge(docs, labels).collect()
    texts = {r[0]: r[1] for r in [*data.rows(), *extra]}
    for r in rows:
        if r["doc_id"] is not None:
            got = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
            assert got == brute_measures(texts[r["doc_id"]]), r["doc_id"]
            assert r["base_failed"] == (got[0] < 20 or 100 * got[4] > 30 * got[0]) and r["kept"] == (not r["base_failed"])
    assert quality.judge(data.empty(spark), labels).count() == 0


def test_binomial_tail_is_exact(spark):
    from math import comb

    cases = [(n, k) for n in (1, 10, 200, 1000) for k in (0, 1, 3, 15) if k <= n]
    frame = spark.createDataFrame(cases, "n long, k long")
    for r in frame.withColumn("p", quality.binomial_tail(F.col("n"), F.col("k"), 0.02)).collect():
        exact = sum(comb(r["n"], i) * 0.02**i * 0.98 ** (r["n"] - i) for i in range(r["k"] + 1))
        assert r["p"] == pytest.approx(exact, rel=1e-9) or r["k"] >= 0.02 * r["n"] and r["p"] == 1


def test_quality_cutoffs_are_proven_per_language(spark):
    clean = " ".join(f"word{i}" for i in range(40))
    dirty = " ".join(f"word{i}$$$" for i in range(40))
    rows = [(i, clean if i % 4 else dirty, "aa" if i < 2000 else "bb") for i in range(2200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1 if i % 4 else 0, 0) for i in range(2200)] + [(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(docs, labels).collect()}
    assert all(kept[i] == bool(i % 4) for i in range(2000))
    assert all(kept[i] for i in range(2000, 2200))  # too few labels to prove a cutoff there


PAGE = """<html><head><title>T</title><script>var a="</p>";</script></head><body><header>Site</header><nav><ul><li><a href=x>Home</a></li>
<li><a href=y>News</a></li></ul></nav><div class="cookie-notice">We use cookies</div>{body}<aside>Side</aside><section id="comments"><article class="comment">
<p>Nice</p></article></section><form>Name <input> <button>Go</button></form><footer>&copy; 2024</footer></body></html>"""


def test_html_wrappers(spark):
    main = "<article><h1>A &amp; B</h1><p>One <b>two</b>\n three<p>Four&nbsp;five<br>six</p><div class='ad'>Buy</div><ul><li>x</li><li>y</li></ul></article>"
    plain = "<div class='content{n}'><h2>Head {n}</h2><p>Text number {n}</p><p>More {n}</p></div><div class='legal'><p>Same everywhere</p></div>"
    rows = [(1, "http://a.example/1", PAGE.format(body=main)), (1, "http://a.example/1", PAGE.format(body=main)), (2, None, None), (3, "x", ""), (4, "http://a.example/2", "<p>unclosed <b>bold")]
    rows += [(10 + n, f"https://B.example:80/{n}", PAGE.format(body=plain.format(n=n))) for n in range(5)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, content string")
    found = {r["page_id"]: r for r in html.extract(pages).collect()}
    assert found[1]["text"] == "A & B\n\nOne two three\n\nFour five six\n\nx\n\ny"
    assert found[2]["text"] == "" and found[2]["n_chars"] == 0 and found[3]["text"] == ""
    assert found[4]["text"] == "unclosed bold"
    for n in range(5):
        assert found[10 + n]["text"] == f"Head {n}\n\nText number {n}\n\nMore {n}"
    assert html.extract(pages).count() == len(rows)
    assert html.extract(pages.limit(0)).count() == 0


def test_html_alignment():
    one, other = html.folded(list("abbbc")), html.folded(list("abdcc"))
    assert one == ["a", ["+", ["b"]], "c"] and html.folded(list("xyxyxyz")) == [["+", ["x", "y"]], "z"]
    assert html.expression(html.aligned(one, other)) == "a (b)+ (d)? (c)+"
    assert html.expression(html.aligned(html.aligned(one, other), list("abc"))) == "a (b)+ (d)? (c)+"


def brute_components(sets, percent):
    ids = sorted(i for i in sets if sets[i])
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80), (1, 60)])
@pytest.mark.parametrize("block", [256, 8])
def test_jaccard_join(spark, monkeypatch, width, percent, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    import random

    rng, texts = random.Random(width), [r[1] for r in data.rows()]
    base = [f"t{i}" for i in range(120)]
    for edits in range(40):
        words = list(base)
        for _ in range(edits // 4):
            words[rng.randrange(len(words))] = f"e{rng.random()}"
        texts.append(" ".join(words) if edits % 3 else " ".join(words).upper())
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, rows[2], (None, texts[0], "x", "y")], "doc_id long, text string, rep string, key string")
    sets = {}
    for i, t in enumerate(texts):
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(words[j : j + width]) for j in range(len(words) - width + 1)} or ({tuple(words)} if words else set())
    expected = brute_components(sets, percent)
    found = jaccard.join(docs, width, percent).collect()
    assert len(found) == len(texts) + 2
    for r in found:
        if r["doc_id"] is None:
            assert r["component_id"] is None
        else:
            assert (r["n_shingles"], r["component_id"]) == (len(sets[r["doc_id"]]), expected[r["doc_id"]])
    assert jaccard.join(docs.limit(0), width, percent).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(60) if i % 20 != 19] + [(5, 5), (None, 3), (70, 69)]
    found = {r["id"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: i // 20 * 20 for i in range(60)} | {70: 69, 69: 69}


def test_near_duplicate_vectors(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    rng = np.random.default_rng(4)
    vectors = rng.standard_normal((600, 32))
    vectors[100:160] = vectors[100] + 0.05 * rng.standard_normal((60, 32))
    vectors[200:205] = vectors[200]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    odd = [(900, None), (901, [0.0] * 32), (902, [float("nan")] * 32), (903, [1.0] + [None] * 31), (904, [1.0, 2.0]), (905, [2.0, 4.0]), (906, []), (None, vectors[0].tolist())]
    frame = spark.createDataFrame([(*r, "x") for r in rows + odd], "vec_id long, embedding array<double>, rep string")
    found = {r["vec_id"]: r for r in neighbours.near_duplicates(frame).collect()}
    assert len(found) == 608
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    # Scaling to length 1 may round a copy's cosine either way; copies count as linked.
    linked[200:205, 200:205] = ~np.eye(5, dtype=bool)
    expected = brute_components({i: {i} for i in range(600)}, 200)
    for i in range(600):
        assert found[i]["n_links"] == linked[i].sum()
        expected[i] = min([i, *np.flatnonzero(linked[i]).tolist()])
    for i in range(600):
        assert found[i]["component_id"] == expected[expected[i]] and found[i]["kept"] == (found[i]["component_id"] == i)
    assert all(found[i]["n_links"] == 0 and found[i]["component_id"] == i for i in (900, 901, 902, 903, 906))
    assert found[904]["n_links"] == 1 and found[905]["component_id"] == 904
    assert neighbours.near_duplicates(frame.limit(0)).count() == 0


def test_chat_linking(spark):
    calls = [(1, "a", None, 1, "ask", '{"turn":1,"question":"q"}', "clash"), (1, "b", "a", 2, "ask", '{"question":""}', ""), (1, "c", "b", 3, "ask", "{", ""),
             (1, "a", None, 9, "ask", "{}", ""), (1, "x", "y", 4, "ask", "{}", ""), (1, "y", "x", 5, "ask", "{}", ""), (1, "z", "y", 6, "no", "{}", ""),
             (1, None, None, 7, "ask", "{}", ""), (2, "a", "gone", 1, "nope", '{"b":1,"a":[1, 2]}', "")]
    calls += [(3, f"n{i}", f"n{i - 1}", i, "ask", f'{{"question":"é","turn":{i}}}', "") for i in range(40)]
    results = [(1, "a", 2, "first"), (1, "a", 3, "second"), (1, "lost", 4, "alone"), (2, None, 1, "no id")]
    frames = (
        spark.createDataFrame(calls, "conv_id long, call_id string, parent_id string, position int, tool string, arguments string, line string"),
        spark.createDataFrame(results, "conv_id long, call_id string, position int, content string"),
        spark.createDataFrame([("ask", json.dumps(chat.ASK))], "tool string, schema string"),
    )
    rows = chat.link(*frames).collect()
    assert len(rows) == len(calls) + 2
    found = {(r["conv_id"], r["call_id"], r["kind"]): r for r in rows}
    assert found[1, "a", "call"]["line"] == '{"arguments":{"question":"q","turn":1},"call":"a","parent":null,"result":"first","tool":"ask"}'
    assert found[1, "b", "call"]["error"] == "$.turn is missing" and found[1, "b", "call"]["depth"] == 1
    assert found[1, "c", "call"]["error"] == "arguments are not JSON" and found[1, "c", "call"]["depth"] == 2
    assert all(found[1, n, "call"]["depth"] is None and found[1, n, "call"]["error"] == "cycle" for n in "xyz")
    assert found[1, "a", "duplicate"]["error"] == "duplicate id" and found[1, None, "duplicate"]["error"] == "no id"
    assert found[1, "lost", "orphan"]["error"] == "no such call"
    assert found[2, "a", "call"]["error"] == "unknown tool" and '"arguments":{"a":[1,2],"b":1}' in found[2, "a", "call"]["line"]
    assert [found[3, f"n{i}", "call"]["depth"] for i in range(40)] == list(range(40))
    assert chat.link(frames[0].limit(0), frames[1].limit(0), frames[2].limit(0)).count() == 0


def test_every_turn_is_in_the_output(spark):
    turns = [(1, 0, "system", "prompt"), (1, 1, "user", "q1"), (1, 2, "assistant", "b"), (1, 2, "assistant", "a"), (1, 2, "assistant", "a"),
             (1, 2, "assistant", None), (1, 3, "user", "q3"), (1, 3, "user", "q3"), (1, 4, None, "no role"), (1, 5, "tool", "é"),
             (1, 9, "assistant", "alone"), (1, 9, "assistant", "alone"), (2, 0, "system", None), (None, 0, "system", "no id")]
    frame = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string")
    rows = chat.linked_turns(spark, frame).collect()
    lines = collections.Counter((r["conv_id"], r["kind"], r["position"], r["line"]) for r in rows)
    assert len(rows) + sum(r["answered"] for r in rows) == len(turns)
    assert lines[1, "message", 0, '{"content":"prompt","role":"system"}'] == 1
    assert lines[1, "message", 4, '{"content":"no role","role":null}'] == 1 and lines[1, "message", 5, '{"content":"é","role":"tool"}'] == 1
    assert lines[2, "message", 0, '{"content":null,"role":"system"}'] == 1 and lines[None, "message", 0, '{"content":"no id","role":"system"}'] == 1
    surplus = sorted(json.loads(r["line"])["result"] for r in rows if r["kind"] == "duplicate result")
    assert surplus == ["a", "a", "b"]  # the null text is the first and the answer
    assert [r["kind"] for r in rows if r["position"] == 9] == ["orphan"] * 2
    assert chat.linked_turns(spark, frame.limit(0)).count() == 0


def two_groups(rng, size: int = 30, length: int = 64) -> np.ndarray:
    """Two groups of near copies: about 0.97 within and between 0.9 and 0.95 across."""
    base, away = np.linalg.qr(rng.standard_normal((length, 2)))[0].T
    centers = np.stack([base, 0.945 * base + np.sqrt(1 - 0.945**2) * away])
    noise = rng.standard_normal((2, size, length))
    noise /= np.linalg.norm(noise, axis=2, keepdims=True)
    return (centers[:, None, :] + 0.17 * noise).reshape(2 * size, length)


def test_groups_of_near_copies_are_linked_across(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    rng = np.random.default_rng(7)
    vectors = np.concatenate((two_groups(rng, 100), rng.standard_normal((100, 64))))
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    assert (unit @ unit.T)[:100, 100:200].max() >= 0.9  # the groups are one component
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = {r["vec_id"]: r for r in neighbours.near_duplicates(frame).collect()}
    assert {found[i]["component_id"] for i in range(200)} == {0}
    assert all(found[i]["n_links"] == linked[i].sum() for i in range(300))


def test_exact_blocks_find_all_links(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 8)
    rng = np.random.default_rng(8)
    vectors = np.concatenate((two_groups(rng), rng.standard_normal((60, 64))))
    vectors[70] = vectors[90] + 0.01
    units = spark.createDataFrame(
        [(i, 1, bytearray((v / np.linalg.norm(v)).astype("<f8").tobytes())) for i, v in enumerate(vectors)], "rep long, copies long, unit binary"
    )
    rows = units.select(F.col("rep").alias("id"), F.lit(None).cast("long").alias("component"))
    found = {r["id"]: r["component"] for r in graph.components(neighbours.block_links(rows, units)).collect()}
    assert found == {i: 0 for i in range(60)} | {70: 70, 90: 70}


def test_recall_below_the_target_is_completed(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 64)
    monkeypatch.setattr(neighbours, "EFFORTS", 1)
    monkeypatch.setattr(neighbours, "projected", lambda units, orders, n: spark.createDataFrame([], neighbours._EDGE))
    rng = np.random.default_rng(9)
    vectors = np.repeat(rng.standard_normal((150, 32)), 2, axis=0) + 0.01 * rng.standard_normal((300, 32))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    result = neighbours.near_duplicates(frame)
    told = result.schema["component_id"].metadata
    assert told["recall"] == 1 and told["audited"] >= neighbours.LINKED
    found = {r["vec_id"]: r for r in result.collect()}
    assert all(found[i]["component_id"] == i - i % 2 and found[i]["n_links"] == 1 for i in range(300))


def test_orders_grow_with_the_bits():
    assert [neighbours.orders_of(n) for n in (0, 1, 600, 100_000, 10_000_000)] == [8, 8, 8, 11, 35]


def test_html_of_copies_and_unclosed_elements(spark):
    copy = "<html><body><div class=text><p>The article</p></div></body></html>"
    rows = [(i, "http://copies.example/x", copy) for i in range(4)]
    rows += [(10 + i, "http://two.example/x", f"<div><p>Same</p></div><section><h2>Head {i % 2}</h2></section>") for i in range(4)]
    rows += [(20, "http://a.example/", "<html><head><title>T</title><meta charset=u><body><article>Body one</article></body></html>"),
             (21, "http://b.example/", "<head><title>T</title><p>Body two</p>"),
             (22, "http://c.example/", "<article><p>Before <svg width=1 /> after</p></article>"),
             (23, "http://d.example/", "<article><div><button>Go</div><p>Kept</p></article><button>More</button>"),
             (24, "http://e.example/", "<article><p>x <select><option>1<option>2</select> y</p><noscript><p>n</p></noscript></article>"),
             (25, "http://f.example/", "<head><title>T</title></head><body><svg><path d=x></svg><main>Main</main><iframe src=y></body>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in html.extract(frame).collect()}
    assert [found[i] for i in range(4)] == ["The article"] * 4
    assert [found[10 + i] for i in range(4)] == [f"Same\n\nHead {i % 2}" for i in range(4)]
    assert [found[i] for i in range(20, 26)] == ["Body one", "Body two", "Before after", "Kept", "x y", "Main"]
