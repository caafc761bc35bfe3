"""Main text of web pages by wrappers inferred per host.

A page becomes a stream of text slots: the path of block elements (with their first class or id) that holds each block of
text. A host's wrapper is a regular expression without unions over slots, inferred by aligning its pages' streams: a
stretch that repeats becomes a repeated group, siblings that come again and again in any order become a repeated group of
optional slots, and a stretch that only one side has becomes an optional group. It describes every page of its host, and
every page is matched against it: each block gets the place in the wrapper that it matched, optional and repeated groups
as long and as early as the rest of the page allows. Two blocks with one path but on either side of another slot have different
places.

Places hold the article, not paths: those in an article or main element and in none that is boilerplate by name; if a
host has none, those of little link text that are text slots. A place is a text slot unless ``TEMPLATE_PAGES`` different
pages or more have one text there, which makes it part of the template. Names of classes decide as parts of words outside
of articles; within, whole names decide, and a name with such a part leaves out its element if it is part of the template.
A page of a host with article elements that has none itself is read by the other rule.

Pages are parsed once for narrow rows (paths, lengths and checksums of blocks, staged), from which wrappers and evidence come, and
once more where they are extracted, because moving their texts would cost more. Equal streams of a host are counted before
any shuffle and aligned ``FAN`` at a time, in as many rounds as that takes, so no task sees all streams of a host; pages of a hot
host are spread over copies of its wrapper. A wrapper grows with the different paths of its host, not with its pages.

Defined results: a null or empty page, and one without a main text, has the empty text; a null URL belongs to the host '';
broken markup is read as far as it goes: unclosed elements end with their parent, a paragraph ends at the next block;
text behind an open head's
first body element is body, and unclosed elements that are dropped end with their parent too; a page that would only have
text of the template keeps it; repeated rows are extracted each by itself; extra columns are ignored.
"""

from __future__ import annotations

import difflib
import hashlib
import html
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lintlake.functions.scale import lookup_join, stage
from lintlake.llm.tokens import slices

#: So many wrappers are aligned with each other in one task.
FAN = 64
LONGEST_UNIT = 6
#: A slot that comes so often among its siblings, in no fixed period, makes them a repeated group of optional slots.
RETURNS = 8
FLUSH = 50_000
MAX_LINK_SHARE = 0.4
#: From so many different pages on, a text that all of them have in a slot is part of the template.
TEMPLATE_PAGES = 3

_DROP = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|textarea|iframe)\b.*?</\1\s*>", re.S | re.I)
#: Elements without text of the page; one that is not closed ends with its parent.
_DROPPED = frozenset("script style noscript template svg iframe textarea select button object head".split())
_HEAD_TAGS = frozenset("title meta link base script style noscript template object".split())
_NEVER_CLOSED = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A tag ends at the first > that is not in a quoted value; a quote that is never closed quotes nothing.
_TAG = re.compile(r"""(</?[a-zA-Z](?>[^>"'=]+|=\s*(?:"[^"]*"|'[^']*')?|["'])*+>|<[!?][^>]*>)""")
_NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9-]*)")
_LABEL = re.compile(r"""\b(?:class|id|role)\s*=\s*["']?([^"'>]*)""", re.I)
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr img picture source input link meta area param track col embed".split()
)
_VOID = frozenset("hr base br".split())
_BOILERPLATE_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
_MAIN_TAGS = frozenset("article main".split())
_BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices "
    "alert sidebar side aside nav navbar navigation menu breadcrumb breadcrumbs footer header masthead topbar comment comments "
    "respond reply replies disqus share sharing social related recommended newsletter subscribe signup login search popup modal "
    "overlay widget toolbar pagination pager skip copyright contentinfo complementary".split()
)
_ENDS_PARAGRAPH = frozenset(("p", "li", "dt", "dd", "tr", "td", "th", "option"))


def _mark(name: str, labels: str, in_main: bool) -> str:
    """"!" for boilerplate, "~" for what is boilerplate if it is part of the template."""
    if name in _BOILERPLATE_TAGS or (name == "header" and not in_main):
        return "!"
    if not labels or _BOILERPLATE_WORDS.isdisjoint(re.split(r"[^a-z]+", labels.lower())):
        return ""
    return "~" if in_main and _BOILERPLATE_WORDS.isdisjoint(labels.lower().split()) else "!"


class _Reader:
    """Blocks of one page: (slot, text, characters of link text)."""

    def __init__(self) -> None:
        self.blocks: list[tuple[str, str, int]] = []
        # Per open element: its name, the slot's path, whether it is in a main element.
        self.open: list[tuple[str, str, bool]] = [("", "", False)]
        self.buffer: list[str] = []
        self.link, self.link_chars = False, 0
        # A dropped element and those opened in it.
        self.dropped: list[str] = []

    def skips(self, name: str, closing: bool, tag: str) -> bool:
        """Whether a tag is part of a dropped element, or opens one."""
        if self.dropped and not closing:
            first = self.dropped[0]
            body = name == "body" or (self.dropped == ["head"] and name not in _HEAD_TAGS)
            if (first == "head" and body) or (first in ("svg", "select", "button") and name in _MAIN_TAGS):
                self.dropped.clear()
        if self.dropped:
            if not closing:
                if name not in _NEVER_CLOSED and not tag.endswith("/>"):
                    self.dropped.append(name)
                return True
            if name in self.dropped:
                while self.dropped.pop() != name:
                    pass
                return True
            if all(name != x for x, _, _ in self.open):
                if name == "a":
                    self.link = False
                return True
            self.dropped.clear()
        elif not closing and name in _DROPPED:
            self.buffer.append(" ")
            if not (name == "svg" and tag.endswith("/>")):
                self.dropped.append(name)
            return True
        return False

    def flush(self) -> None:
        if self.buffer:
            text = "".join(self.buffer)
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            if text:
                self.blocks.append((self.open[-1][1], text, min(self.link_chars, len(text))))
            self.buffer.clear()
        self.link_chars = 0

    def tag(self, tag: str) -> None:
        found = _NAME.match(tag)
        if not found:
            return
        name = found[2].lower()
        closing = bool(found[1])
        if self.skips(name, closing, tag):
            return
        if name in _INLINE:
            if name == "a":
                self.link = not closing
            return
        if name in _VOID:
            self.buffer.append(" ")
            if name == "hr":
                self.flush()
            return
        self.flush()
        if closing:
            if name == "p" and self.open[-1][0] != "p":
                return  # its paragraph ended at an earlier block
            for depth in range(len(self.open) - 1, 0, -1):
                if self.open[depth][0] == name:
                    del self.open[depth:]
                    break
            return
        if self.open[-1][0] == "p" or (name in _ENDS_PARAGRAPH and self.open[-1][0] == name):
            self.open.pop()
        if name in _MAIN_TAGS:  # never inside a menu or page header: that one was not closed
            left = next((i for i, (x, _, _) in enumerate(self.open) if x in ("nav", "header")), None)
            if left and not self.open[left][2]:
                del self.open[left:]
        _, path, in_main = self.open[-1]
        labels = " ".join(_LABEL.findall(tag)) if "=" in tag else ""
        mark = _mark(name, labels, in_main)
        label = re.sub(r"[\d!~]+", "", labels.split()[0]) if labels.split() else ""
        step = f"{mark}{name}.{label}" if label else f"{mark}{name}"
        self.open.append((name, f"{path}/{step}", in_main or name in _MAIN_TAGS))

    def read(self, page: str) -> list[tuple[str, str, int]]:
        for i, part in enumerate(_TAG.split(_DROP.sub(" ", page))):
            if i % 2:
                self.tag(part)
            elif part and self.dropped and not (self.dropped == ["head"] and part.strip()):
                continue
            elif part:
                self.dropped.clear()
                self.buffer.append(part)
                if self.link:
                    self.link_chars += len(part)
        self.flush()
        return self.blocks


def blocks_of(page: str | None) -> list[tuple[str, str, int]]:
    return _Reader().read(page) if page else []


def _named_main(slot: str) -> bool:
    return "!" not in slot and ("/article" in slot or "/main" in slot)


# A wrapper's items: a slot's path, or [operator, unit] with "?" for an optional and "+" for a repeated unit, or
# ["*", slots] for a repeated group of optional slots. In pieces: (operators, unit).


def _repeated(slots: list[str]) -> list[tuple[str, list[str]]]:
    """Neighbouring repetitions of a stretch become one repeated group."""
    out, i = [], 0
    while i < len(slots):
        for size in range(1, LONGEST_UNIT + 1):
            unit, end = slots[i : i + size], i + size
            while slots[end : end + size] == unit:
                end += size
            if end > i + size:
                out.append(("+", unit))
                i = end
                break
        else:
            out.append(("", [slots[i]]))
            i += 1
    return out


def _parent(slot: str) -> str:
    return slot.rpartition("/")[0]


def _mixed(pieces: list[tuple[str, list[str]]]) -> list[tuple[str, list[str]]]:
    """Siblings among which a slot comes ``RETURNS`` times or more become one repeated group of optional slots."""
    places: dict[str, list[int]] = {}
    for i, (_, unit) in enumerate(pieces):
        for slot in dict.fromkeys(unit):
            places.setdefault(slot, []).append(i)
    spans = []
    for slot, found in places.items():
        inside, run = _parent(slot) + "/", [found[0]]
        marks = inside.count("!")
        for last, i in zip(found, [*found[1:], len(pieces)], strict=True):
            between = [x for _, unit in pieces[last + 1 : i] for x in unit]
            if i < len(pieces) and all(x.startswith(inside) and x.count("!") == marks for x in between):
                run.append(i)
                continue
            if len(run) >= RETURNS:
                spans.append((run[0], run[-1] + 1))
            run = [i]
    out, i = [], 0
    spans.sort()
    while spans:
        begin, end = spans.pop(0)
        while spans and spans[0][0] < end:
            end = max(end, spans.pop(0)[1])
        out += pieces[i:begin] + [("*", sorted({x for _, unit in pieces[begin:end] for x in unit}))]
        i = end
    return out + pieces[i:]


def _item(operators: str, unit: list[str]):
    if "*" in operators:
        inner = ["*", unit]
    else:
        inner = ["+", unit] if "+" in operators else unit[0] if len(unit) == 1 else unit
    return ["?", [inner] if isinstance(inner, list) and inner[0] in ("+", "*") else unit] if "?" in operators else inner


def folded(slots: list[str]) -> list:
    """The wrapper of one stream."""
    return [_item(*piece) for piece in _mixed(_repeated(slots))]


def _core(item) -> tuple[str, list]:
    """Operators and unit of an item."""
    operators = ""
    while isinstance(item, list):
        operators += item[0]
        item = item[1][0] if len(item[1]) == 1 and isinstance(item[1][0], list) else item[1]
        if isinstance(item, list) and (not item or item[0] not in ("?", "+", "*")):
            return operators, item
    return operators, [item]


def _joined(one: tuple[str, list[str]], other: tuple[str, list[str]]) -> tuple[str, list[str]] | None:
    """One piece for two neighbours, if they are of one kind."""
    optional = "?" * ("?" in one[0] and "?" in other[0])
    if "*" in one[0] or "*" in other[0]:
        group, rest = (one, other) if "*" in one[0] else (other, one)
        if set(rest[1]) <= set(group[1]) or ("*" in rest[0] and not set(rest[1]).isdisjoint(group[1])):
            return optional + "*", sorted({*one[1], *other[1]})
    elif one[1] == other[1]:
        return optional + "+", one[1]
    return None


def aligned(one: list, other: list) -> list:
    """The wrapper of all streams that either of two wrappers describes."""
    cores = [[_core(item) for item in items] for items in (one, other)]
    # Groups of optional slots meet by their container.
    keys = [[json.dumps(min(map(_parent, unit), key=len) if "*" in x else unit) for x, unit in core] for core in cores]
    pieces = []

    def add(operators: str, unit: list[str]) -> None:
        joined = _joined(pieces[-1], (operators, unit)) if pieces else None
        pieces[-1:] = [joined] if joined else [*pieces[-1:], (operators, unit)]

    for kind, a, b, c, d in difflib.SequenceMatcher(None, *keys, autojunk=False).get_opcodes():
        if kind == "equal":
            for x, y in zip(cores[0][a:b], cores[1][c:d], strict=True):
                add(x[0] + y[0], x[1] if x[1] == y[1] else sorted({*x[1], *y[1]}))
        else:
            for operators, unit in cores[0][a:b] + cores[1][c:d]:
                add("?" + operators, unit)
    return [_item(*piece) for piece in pieces]


class Matcher:
    """Matches streams of slots against a wrapper, from the end for what is possible, then forward for what is chosen."""

    def __init__(self, wrapper: list) -> None:
        self.pieces = [_core(item) for item in wrapper]
        self.first = []  # of each piece, the number of its first place
        self.places: list[str] = []
        for _, unit in self.pieces:
            self.first.append(len(self.places))
            self.places += unit

    def match(self, slots: list[str]) -> list[int]:
        """The place of every slot. Sets of positions are bits of an integer."""
        n, at = len(slots), {}
        for i, slot in enumerate(slots):
            at.setdefault(slot, bytearray((n >> 3) + 1))[i >> 3] |= 1 << (i & 7)
        bits = {slot: int.from_bytes(flags, "little") for slot, flags in at.items()}
        rest = 1 << n  # positions from which the pieces behind match up to the end
        taken = [0] * len(self.pieces)  # positions at which a piece can begin so that all behind match
        for j in range(len(self.pieces) - 1, -1, -1):
            operators, unit = self.pieces[j]
            found = 0
            if "*" in operators:
                members = 0
                for slot in unit:
                    members |= bits.get(slot, 0)
                size = 1
            elif all(slot in bits for slot in unit):
                members, size = -1, len(unit)
                for k, slot in enumerate(unit):
                    members &= bits[slot] >> k
            else:
                members, size = 0, 1
            if members:
                found = members & (rest >> size)
                if "+" in operators or "*" in operators:
                    # All that lead there by repetition, in doubling steps.
                    step, along = size, members
                    while along:
                        more = found | (along & (found >> step))
                        along &= along >> step
                        found, step = more, step * 2
            taken[j] = found
            rest = found | (rest if "?" in operators or "*" in operators else 0)
        if not rest & 1:
            raise ValueError("the wrapper does not describe the page")
        out, i = [], 0
        for j, (operators, unit) in enumerate(self.pieces):
            if not taken[j] >> i & 1:
                continue
            begins = bin(taken[j])[:1:-1]
            while True:
                if "*" in operators:
                    out.append(self.first[j] + unit.index(slots[i]))
                    i += 1
                else:
                    out += range(self.first[j], self.first[j] + len(unit))
                    i += len(unit)
                if not ("+" in operators or "*" in operators) or begins[i : i + 1] != "1":
                    break
        return out


def expression(wrapper: list) -> str:
    """The wrapper as one would write it."""
    def written(item) -> str:
        if isinstance(item, str):
            return item
        if item[0] == "*":
            return "(" + " ".join(f"({slot})?" for slot in item[1]) + ")*"
        return f"({' '.join(map(written, item[1]))}){item[0]}" if item[0] in ("?", "+") else " ".join(map(written, item))

    return " ".join(map(written, wrapper))


def host(url: str):
    return F.coalesce(F.regexp_extract(F.lower(F.col(url)), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


_NARROW = "host string, page long, stream string, names array<string>, codes array<int>, chars array<long>, links array<long>, checks array<long>"
_EVIDENCE = "host string, place int, slot string, pages array<long>, chars long, links long, low long, high long"
_TYPES = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(column.split() for column in schema.split(", ")), strict=True)
    types = [pa.list_(_TYPES[kind[6:-1]]) if kind.startswith("array") else _TYPES[kind] for kind in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], list(names))


def _checksum(page: str | None) -> int:
    return int.from_bytes(hashlib.blake2b((page or "").encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def _observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Narrow rows: every page's stream, and length, link text and checksum of its blocks."""
    for batch in slices(batches, "html"):
        rows = []
        for site, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            blocks = blocks_of(page)
            slots = [slot for slot, _, _ in blocks]
            code = {slot: i for i, slot in enumerate(dict.fromkeys(slots))}
            rows.append((
                site, _checksum(page), json.dumps(folded(slots)), list(code), [code[slot] for slot in slots],
                [len(text) for _, text, _ in blocks], [links for _, _, links in blocks],
                [zlib.crc32(text.encode("utf-8", "replace")) for _, text, _ in blocks],
            ))
        yield _batch(rows, _NARROW)


def _align_all(table: pa.Table) -> pa.Table:
    """One wrapper for all rows of a host (or of a part of it), in a fixed order."""
    wrapper = None
    for stream in sorted(table["value"].to_pylist(), key=lambda s: (len(s), s)):
        items = json.loads(stream)
        wrapper = items if wrapper is None else aligned(wrapper, items)
    return pa.table({"host": pa.array([table["host"][0].as_py()], pa.string()), "value": pa.array([json.dumps(wrapper)], pa.string())})


def _aligned_streams(streams: DataFrame) -> DataFrame:
    """(host, wrapper) of different streams (host, value), aligned ``FAN`` at a time until one is left."""
    while True:
        sizes = streams.groupBy("host").agg(F.count("*").alias("_n"))
        if (sizes.agg(F.max("_n")).first()[0] or 0) <= 1:
            return streams.select("host", F.col("value").alias("wrapper"))
        part = F.pmod(F.xxhash64("value"), F.ceil(F.col("_n") / FAN)).alias("part")
        parted = lookup_join(streams, sizes, ["host"], ["value"], "inner").select("host", "value", part)
        streams = stage(parted.groupBy("host", "part").applyInArrow(_align_all, "host string, value string").distinct(), "wrappers")


def _matchers(most: int = 64):
    """The matcher of a wrapper; those of the last hosts are remembered."""
    known: dict[str, Matcher] = {}

    def matcher(wrapper: str) -> Matcher:
        if wrapper not in known:
            if len(known) >= most:
                known.clear()
            known[wrapper] = Matcher(json.loads(wrapper))
        return known[wrapper]

    return matcher


def _weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per place: the first few different pages, the sums and the bounds."""
    seen: dict[tuple[str, int], list] = {}
    matcher = _matchers()

    def rows() -> pa.RecordBatch:
        return _batch([(*key, *value) for key, value in seen.items()], _EVIDENCE)

    for batch in batches:
        for row in (x for begin in range(0, batch.num_rows, 256) for x in batch.slice(begin, 256).to_pylist()):
            if not row["codes"]:
                continue
            slots = [row["names"][code] for code in row["codes"]]
            of_place: dict[int, list] = {}
            for place, slot, chars, links, check in zip(
                matcher(row["wrapper"]).match(slots), slots, row["chars"], row["links"], row["checks"], strict=True
            ):
                entry = of_place.setdefault(place, [slot, 0, 0, 0])
                entry[1] += chars
                entry[2] += links
                entry[3] = zlib.crc32(check.to_bytes(4, "little"), entry[3])
            for place, (slot, chars, links, check) in of_place.items():
                total = seen.setdefault((row["host"], place), [slot, [], 0, 0, check, check])
                if len(total[1]) < TEMPLATE_PAGES and row["page"] not in total[1]:
                    total[1].append(row["page"])
                total[2] += chars
                total[3] += links
                total[4], total[5] = min(total[4], check), max(total[5], check)
            if len(seen) > FLUSH:
                yield rows()
                seen.clear()
    if seen:
        yield rows()


def _pages_of(rows: DataFrame, *keys: str) -> DataFrame:
    pages = F.slice(F.array_distinct(F.flatten(F.collect_list("pages"))), 1, TEMPLATE_PAGES).alias("pages")
    sums = [F.sum(c).alias(c) for c in ("chars", "links")]
    return rows.groupBy("host", "place", "slot", *keys).agg(pages, *sums, F.min("low").alias("low"), F.max("high").alias("high"))


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper, content, spare): the expression as items in JSON, the places in it that hold the article, and those
    that are only left out because they are part of the template."""
    rows = pages.select(host("url").alias("host"), F.col("html").cast("string").alias("html"))
    narrow = stage(rows.mapInArrow(_observe, _NARROW), "streams")
    whole = _aligned_streams(stage(narrow.select("host", F.col("stream").alias("value")).distinct(), "streams-apart"))
    weighed = lookup_join(narrow.drop("stream"), whole, ["host"], ["page"], "inner")
    parts = weighed.select("host", "page", "names", "codes", "chars", "links", "checks", "wrapper").mapInArrow(_weigh, _EVIDENCE)
    # In two steps, so that no row holds what every task saw of a hot host's place.
    seen = _pages_of(_pages_of(parts.withColumn("_part", F.pmod(F.xxhash64("pages"), F.lit(FAN))), "_part"))
    slot = F.col("slot")
    named = ~slot.rlike("[!~]") & (slot.contains("/article") | slot.contains("/main"))
    template = (F.size("pages") >= TEMPLATE_PAGES) & (F.col("low") == F.col("high"))
    text = ~slot.contains("!") & (F.col("links") <= MAX_LINK_SHARE * F.col("chars"))
    content = seen.filter(named | text).groupBy("host").agg(
        F.collect_set(F.when(named | ~template, F.col("place"))).alias("content"),
        F.collect_set(F.when(~named & template & ~slot.contains("~"), F.col("place"))).alias("spare"),
    )
    known = [F.coalesce(c, F.array().cast("array<int>")).alias(c) for c in ("content", "spare")]
    return whole.join(content, "host", "left").select("host", "wrapper", *known)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    matcher = _matchers()
    for batch in slices(batches, "html"):
        texts = []
        columns = [batch.column(c).to_pylist() for c in ("html", "wrapper", "content", "spare")]
        for page, wrapper, content, spare in zip(*columns, strict=True):
            found = blocks_of(page)
            places = matcher(wrapper).match([slot for slot, _, _ in found]) if found else []
            blocks = []
            for marks in (content, spare):
                marked = set(marks or ())
                blocks = blocks or [(slot, text) for (slot, text, _), place in zip(found, places, strict=True) if place in marked]
            main = [text for slot, text in blocks if _named_main(slot)]
            texts.append("\n\n".join(main or [text for _, text in blocks]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every page by its host's wrapper."""
    kind = pages.schema["page_id"].dataType.simpleString()
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host("url").alias("host"))
    marked = stage(wrappers(pages), "marked-wrappers")
    joined = lookup_join(rows, marked, ["host"], ["page_id", "url"])
    return joined.select("page_id", "url", "html", "wrapper", "content", "spare").mapInArrow(
        _extract, f"page_id {kind}, url string, text string, n_chars long"
    )
