"""Wrappers: they describe all streams they come from, and matching is that of a regular expression."""

from __future__ import annotations

import json
import random
import re

from lintlake.llm import html


def pattern(wrapper):
    """The wrapper as a pattern of Python's, one named group per piece."""
    out = []
    for j, item in enumerate(wrapper):
        operators, unit = html._core(item)
        if "*" in operators:
            out.append(f"(?P<g{j}>[{''.join(unit)}]*)")
        else:
            text = f"(?P<g{j}>(?:{''.join(unit)}){'+' * ('+' in operators)})"
            out.append(f"(?:{text})?" if "?" in operators else text)
    return re.compile("".join(out))


def brute(wrapper, stream):
    found = pattern(wrapper).fullmatch("".join(stream))
    places, first = [], 0
    for j, item in enumerate(wrapper):
        operators, unit = html._core(item)
        text = found[f"g{j}"] or ""
        places += [first + (unit.index(x) if "*" in operators else k % len(unit)) for k, x in enumerate(text)]
        first += len(unit)
    return places


def test_matching_equals_a_regular_expression():
    rng = random.Random(7)
    for _ in range(400):
        streams = [[rng.choice("abcd") for _ in range(rng.randrange(9))] for _ in range(4)]
        wrapper = None
        for stream in streams:
            items = json.loads(json.dumps(html.folded(stream)))
            wrapper = items if wrapper is None else html.aligned(wrapper, items)
        for stream in streams:
            assert html.Matcher(wrapper).match(stream) == brute(wrapper, stream), (wrapper, stream)


def test_siblings_in_any_order():
    rng = random.Random(3)
    streams = [["/m/h", *(f"/m/{rng.choice(['p', 'q', 'u/l'])}" for _ in range(n)), "/f"] for n in (90, 120, 150, 9000)]
    wrapper = html.folded(streams[0])
    for stream in streams[1:]:
        wrapper = html.aligned(wrapper, html.folded(stream))
    assert html.expression(wrapper) == "/m/h ((/m/p)? (/m/q)? (/m/u/l)?)* /f"
    places = html.Matcher(wrapper).match(streams[3])
    assert len(places) == 9002 and places[0] == 0 and places[-1] == 4
    long = html.Matcher(html.folded(["/p"] * 200_000 + ["/q"])).match(["/p"] * 200_000 + ["/q"])
    assert long == [0] * 200_000 + [1]


def test_the_place_decides_not_the_path(spark):
    # Head, article and legal line share one path; only the wrapper, with its optional and repeated groups, tells them apart.
    def page(n):
        advert = "<section><a href=x>Buy</a></section>" if n % 2 else ""
        return f"<div>Our site</div>{advert}<hgroup><h1>Title {n}</h1></hgroup>" + f"<div>Text {n}</div>" * (n % 4) + "<pre>End</pre><div>All rights</div>"

    frame = spark.createDataFrame([(n, f"http://h.example/{n}", page(n)) for n in range(24)], "page_id long, url string, html string")
    wrapper = html.wrappers(frame).first()["wrapper"]
    assert html.expression(json.loads(wrapper)) == "/div (/section)? /hgroup/h1 ((/div)+)? /pre /div"
    found = {r["page_id"]: r["text"] for r in html.extract(frame).collect()}
    assert found == {n: "\n\n".join([f"Title {n}"] + [f"Text {n}"] * (n % 4)) for n in range(24)}


def test_many_streams_of_a_host_are_aligned_in_rounds(spark):
    rng = random.Random(5)
    tags = ["p", "pre", "h2", "ul", "section", "blockquote", "figure", "table"]
    rows = []
    for n in range(300):
        body = "".join(f"<{t}>{t} {n} {i}</{t}>" for i, t in enumerate(rng.choices(tags, k=rng.randrange(1, 9))))
        rows.append((n, "http://h.example/", f"<nav>Menu {n}</nav><article>{body}</article>", body))
    frame = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string")
    wrapper = html.Matcher(json.loads(html.wrappers(frame).first()["wrapper"]))
    for _, _, text, _ in rows:
        slots = [slot for slot, _, _ in html.blocks_of(text)]
        assert [wrapper.places[i] for i in wrapper.match(slots)] == slots
    found = {r["page_id"]: r["text"] for r in html.extract(frame).collect()}
    assert found == {r[0]: re.sub(r"(</\w+>)?<\w+>", "\n\n", r[3]).split("</")[0].strip() for r in rows}


def test_tags_and_names(spark):
    pages = ['<article><p title="a > b">x</p></article>', "<article><p title='>' class=y>x</p></article>", '<article><p title="open>x</p></article>',
             '<article><section class="related-work"><p>Others</p></section><div class="comment">No</div></article>',
             "<article>" + "<p>long</p>" * 30_000 + "</article>"]
    frame = spark.createDataFrame([(i, f"http://h{i}.example/", x) for i, x in enumerate(pages)], "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in html.extract(frame).collect()}
    assert [found[i] for i in range(4)] == ["x", "x", "x", "Others"]
    assert found[4] == "\n\n".join(["long"] * 30_000)
