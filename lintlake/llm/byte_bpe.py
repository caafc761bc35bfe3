"""Byte-level byte-pair encoding of whole texts, cut without a regex, and decoding by offsets.

The pattern of the rank files is a small automaton over classes of characters (letter, number, white space, other, an
apostrophe before one of the short endings) once each class says whether white space follows. ``Cutter`` holds the class
of every code point in one array. The transition functions of the classes form a finite monoid under composition, so its
multiplication table is computed once, and texts are scanned associatively: lanes of characters are multiplied side by
side, the lanes' totals are combined in a logarithmic number of steps, and every character then knows the state it is met
in. A table over states and classes says where a match begins. Many texts are scanned together; the first character of
each has a class of its own that forgets the state.

The matches are slices of the texts' bytes. ``Ranks`` merges the pairs of a slice, the lowest rank first, and remembers
the ids of slices by their bytes; the memo starts anew when it has taken ``MEMO_PIECES`` slices or ``MEMO_BYTES`` bytes.
New slices are merged side by side in arrays, long ones with a heap over a linked list.

An encoded text keeps the byte offset at which each token begins, so any range of bytes is decoded from the tokens that
cover it alone (``decode`` with ``first`` and ``last``).

Nothing is shuffled: each row is encoded where it lies, some ``CUT_BYTES`` of text at a time, one text at least.

Defined results: null and empty texts have no ids and decode to no bytes; ids outside the vocabulary and null ids decode
to nothing; bytes that are no UTF-8 count as U+FFFD; strings of special tokens are ordinary text; every row of the input
is a row of the output, repeated ids and null ids included; extra columns are ignored; empty tables give empty tables.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from lintlake.llm.tokens import slices

#: Characters that one lane of the scan holds.
LANE = 256
#: Slices and bytes after which the memo of a worker starts anew.
MEMO_PIECES = 1 << 19
MEMO_BYTES = 1 << 26
#: Slices that are looked up at once.
CALL_PIECES = 1 << 17
#: Longest slice, in bytes, that is merged side by side with others and remembered.
LONGEST_SHORT = 64
#: Ids written at once.
STEP = 1 << 14

# States: what the characters so far have left open.
_START, _LETTERS, _NUMBERS, _OTHERS, _SPACE, _WHITE, _ONE_LEFT, _TWO_LEFT = range(8)
# Classes of characters. The short endings after an apostrophe have one letter or two; white space is split by whether a
# character other than white space follows.
_L, _N, _O, _Q1, _Q2, _SPACE_MID, _SPACE_END, _WHITE_MID, _WHITE_END = range(9)
_CLASSES = 9


def _next(state: int, kind: int) -> int:
    if state == _TWO_LEFT:
        return _ONE_LEFT
    if state == _ONE_LEFT:
        return _START
    if kind in (_Q1, _Q2):
        if state in (_OTHERS, _SPACE):
            return _OTHERS
        return _ONE_LEFT if kind == _Q1 else _TWO_LEFT
    return [_LETTERS, _NUMBERS, _OTHERS, -1, -1, _SPACE, _SPACE, _WHITE, _WHITE][kind]


def _begins(state: int, kind: int) -> bool:
    """Whether a match begins at a character of this class."""
    if state in (_ONE_LEFT, _TWO_LEFT):
        return False
    if state == _START:
        return True
    if kind in (_SPACE_MID, _WHITE_MID, _SPACE_END, _WHITE_END):
        return state not in (_SPACE, _WHITE) or kind in (_SPACE_MID, _WHITE_MID)
    own = {_L: _LETTERS, _N: _NUMBERS}.get(kind, _OTHERS)
    return state not in (own, _SPACE)


class Cutter:
    """Where the matches of the pattern begin, by an associative scan over classes of characters."""

    def __init__(self) -> None:
        self.kinds = self._kinds()
        self._close()
        self.begins = np.array([[_begins(s, k) for k in range(_CLASSES)] for s in range(8)], dtype=bool)

    @staticmethod
    def _kinds() -> np.ndarray:
        """The class of each code point, in the Unicode version of the library whose ids are to be met."""
        import tiktoken

        bytes_ = {bytes([b]): b for b in range(256)}
        kinds = np.full(0x110000, _O, dtype=np.uint8)
        everything = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
        for pattern, kind in ((r"\p{L}", _L), (r"\p{N}", _N), (r"\s", _WHITE_END)):
            probe = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=bytes_, special_tokens={})
            for start in range(0, len(everything), 1 << 16):
                found = bytes(probe.encode_ordinary("".join(everything[start : start + (1 << 16)]))).decode()
                kinds[np.frombuffer(found.encode("utf-32-le"), dtype="<u4")] = kind
        kinds[ord(" ")] = _SPACE_END
        return kinds

    def _close(self) -> None:
        """All products of the classes' transition functions: ``product[a, b]`` is a, then b; 0 is the identity."""
        functions = [tuple(_next(s, k) for s in range(8)) for k in range(_CLASSES)]
        functions += [(_next(_START, k),) * 8 for k in range(_CLASSES)]  # the first character of a text
        elements = {tuple(range(8)): 0}
        queue = list(elements)
        for element in queue:
            for f in functions:
                product = tuple(f[s] for s in element)
                if product not in elements:
                    elements[product] = len(elements)
                    queue.append(product)
        self.of_kind = np.array([elements[f] for f in functions], dtype=np.uint16)
        self.product = np.array([[elements[tuple(b[s] for s in a)] for b in queue] for a in queue], dtype=np.uint16)
        self.apply = np.array(queue, dtype=np.uint8)

    def _states(self, kinds: np.ndarray) -> np.ndarray:
        """The state before each character."""
        n = len(kinds)
        lanes = -(-n // LANE)
        elements = np.zeros(lanes * LANE, dtype=np.uint16)
        elements[:n] = self.of_kind[kinds]
        before = np.ascontiguousarray(elements.reshape(lanes, LANE).T)
        width, product = len(self.product), self.product.ravel()
        running = np.zeros(lanes, dtype=np.uint16)
        for i in range(LANE):
            here = before[i].copy()
            before[i] = running
            running = product[running.astype(np.int32) * width + here]
        step = 1
        while step < lanes:  # totals of all lanes up to each one
            running = np.concatenate((running[:step], product[running[:-step].astype(np.int32) * width + running[step:]]))
            step *= 2
        entry = np.zeros(lanes, dtype=np.uint8)
        entry[1:] = self.apply[running[:-1], _START]
        return self.apply[before, entry[None, :]].T.ravel()[:n]

    def starts(self, points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Whether a match begins at each code point; ``firsts`` are the positions at which texts begin."""
        n = len(points)
        if not n:
            return np.zeros(0, dtype=bool)
        kinds = self.kinds[points]
        first = np.zeros(n + 3, dtype=bool)
        first[firsts] = True
        first[n:] = True
        after = np.concatenate((points, np.zeros(3, dtype=points.dtype)))
        quote = np.flatnonzero((points == ord("'")) & ~first[1 : n + 1])
        if len(quote):
            one, two = after[quote + 1], np.where(first[quote + 2], 0, after[quote + 2])
            single = np.isin(one, [ord(c) for c in "stmd"])
            double = ((one == ord("l")) & (two == ord("l"))) | (np.isin(one, [ord("r"), ord("v")]) & (two == ord("e")))
            kinds[quote[single]] = _Q1
            kinds[quote[double]] = _Q2
        white = kinds >= _SPACE_MID
        goes_on = ~first[1 : n + 1]
        goes_on[:-1] &= ~white[1:]
        kinds[white & goes_on] -= 1  # from END to MID
        first = first[:n]
        states = self._states(kinds + first * np.uint8(_CLASSES))
        return self.begins[states, kinds] | first


class Ranks:
    """A rank file: bytes of each token, pair merging, and the memo of slices."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            self.rank = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        size = max(self.rank.values()) + 1
        tokens = [b""] * size
        for token, rank in self.rank.items():
            tokens[rank] = token
        self.sizes = np.fromiter(map(len, tokens), dtype=np.int64, count=size)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.none = size
        self.of_byte = np.array([self.rank[bytes([b])] for b in range(256)], dtype=np.int64)
        self._pairs()
        self.cutter = Cutter()
        self.memo: dict[bytes, list[int]] = {}
        self.held = 0

    def _pairs(self) -> None:
        """Which token two tokens make, as an open table of hashes of their ids."""
        rank = self.rank
        pairs = [
            (rank[token[:i]] << 32 | rank[token[i:]], merged)
            for token, merged in rank.items()
            for i in range(1, len(token))
            if token[:i] in rank and token[i:] in rank
        ]
        self.bits = (4 * len(pairs) + 16).bit_length()
        keys, merged = (np.array(x, dtype=np.int64) for x in zip(*pairs, strict=True)) if pairs else (np.zeros(0, np.int64),) * 2
        self.pair_keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.pair_ranks = np.zeros(1 << self.bits, dtype=np.int64)
        at = self._slot(keys)
        left = np.arange(len(keys))
        while len(left):
            empty = self.pair_keys[at[left]] < 0
            self.pair_keys[at[left[empty]]] = keys[left[empty]]
            won = self.pair_keys[at[left]] == keys[left]
            self.pair_ranks[at[left[won]]] = merged[left[won]]
            left = left[~won]
            at[left] = (at[left] + 1) & (len(self.pair_keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids, ``none`` if no token has their bytes."""
        keys = left << 32 | right
        at = self._slot(keys)
        out = np.full(len(keys), self.none, dtype=np.int64)
        open_ = np.arange(len(keys))
        while len(open_):
            here = self.pair_keys[at[open_]]
            hit = here == keys[open_]
            out[open_[hit]] = self.pair_ranks[at[open_[hit]]]
            open_ = open_[~hit & (here >= 0)]
            at[open_] = (at[open_] + 1) & (len(self.pair_keys) - 1)
        return out

    def merge(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of each slice."""
        whole = [self.rank.get(piece) for piece in pieces]
        short = iter(self._merge_short([p for p, w in zip(pieces, whole) if w is None and len(p) <= LONGEST_SHORT]))
        return [
            [w] if w is not None else next(short) if len(p) <= LONGEST_SHORT else self._merge_long(p)
            for p, w in zip(pieces, whole, strict=True)
        ]

    def _merge_short(self, pieces: list[bytes]) -> list[list[int]]:
        """Many slices side by side: in each round every slice merges its pair of the lowest rank, the leftmost of equals."""
        out: list[list[int]] = [[]] * len(pieces)
        if not pieces:
            return out
        owner = np.repeat(np.arange(len(pieces)), np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)))
        ids = self.of_byte[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        ranks = np.full(len(ids), self.none, dtype=np.int64)  # of each id with the next one of its slice
        joined = np.flatnonzero(owner[1:] == owner[:-1])
        ranks[joined] = self._pair_ranks(ids[joined], ids[joined + 1])
        while len(ids):
            begins = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            best = np.minimum.reduceat(ranks << 32 | np.arange(len(ids)), begins)
            ready = best >> 32 == self.none
            if ready.any():
                sizes = np.diff(np.concatenate((begins, [len(ids)])))
                done = np.repeat(ready, sizes)
                values, at = ids[done].tolist(), 0
                for piece, size in zip(owner[begins[ready]].tolist(), sizes[ready].tolist(), strict=True):
                    out[piece] = values[at : at + size]
                    at += size
                ids, owner, ranks, shift = ids[~done], owner[~done], ranks[~done], np.cumsum(done)
                best = best[~ready]
                best -= shift[best & 0xFFFFFFFF]
                if not len(ids):
                    break
            at = best & 0xFFFFFFFF
            ids[at] = best >> 32
            keep = np.ones(len(ids), dtype=bool)
            keep[at + 1] = False
            ids, owner, ranks = ids[keep], owner[keep], ranks[keep]
            at = at - np.arange(len(at))
            at = np.unique(np.concatenate((at, at[at > 0] - 1)))
            ranks[at] = self.none
            at = at[at + 1 < len(ids)]
            at = at[owner[at] == owner[at + 1]]
            ranks[at] = self._pair_ranks(ids[at], ids[at + 1])
        return out

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same with a heap of (rank, position); entries whose pair has changed are passed over."""
        rank, n = self.rank, len(piece)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that begins at a position
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        alive = bytearray(b"\x01") * n
        while heap:
            _, i, until = heapq.heappop(heap)
            middle = end[i] if alive[i] else n
            if middle >= n or end[middle] != until:
                continue
            alive[middle] = 0
            end[i] = until
            if until < n:
                before[until] = i
                if (r := rank.get(piece[i : end[until]])) is not None:
                    heapq.heappush(heap, (r, i, end[until]))
            left = before[i]
            if left >= 0 and (r := rank.get(piece[left:until])) is not None:
                heapq.heappush(heap, (r, left, until))
        out, i = [], 0
        while i < n:
            out.append(rank[piece[i : end[i]]])
            i = end[i]
        return out

    def _found(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of each slice, from the memo or merged, each different slice once."""
        found = list(map(self.memo.get, pieces))
        new = list(dict.fromkeys([p for p, f in zip(pieces, found) if f is None]))
        if not new:
            return found
        merged = dict(zip(new, self.merge(new), strict=True))
        if len(self.memo) + len(merged) > MEMO_PIECES or self.held > MEMO_BYTES:
            self.memo, self.held = {}, 0
        for piece, ids in merged.items():
            if len(piece) <= LONGEST_SHORT:
                self.memo[piece] = ids
                self.held += len(piece) + 8 * len(ids)
        return [merged[p] if f is None else f for p, f in zip(pieces, found)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each text has."""
        raw, sizes = _utf8(texts)
        points = np.frombuffer(raw.decode().encode("utf-32-le"), dtype="<u4")
        widths = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        at = np.cumsum(widths) - widths  # byte offset of each character
        begins = np.cumsum(sizes) - sizes  # byte offset of each text
        starts = at[self.cutter.starts(points, np.searchsorted(at, begins[sizes > 0]))]
        parts, counts = [np.zeros(0, dtype=np.int32)], [np.zeros(1, dtype=np.int64)]
        for first in range(0, len(starts), CALL_PIECES):
            cuts = starts[first : first + CALL_PIECES + 1].tolist()
            if first + CALL_PIECES >= len(starts):
                cuts.append(len(raw))
            found = self._found([raw[a:b] for a, b in zip(cuts, cuts[1:])])
            counts.append(np.fromiter(map(len, found), dtype=np.int64, count=len(found)))
            parts.append(np.fromiter(chain.from_iterable(found), dtype=np.int32, count=int(counts[-1].sum())))
        before = np.cumsum(np.concatenate(counts))
        return np.concatenate(parts), np.diff(before[np.searchsorted(starts, np.concatenate((begins, [len(raw)])))])

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """The byte at which each token begins, counted from the first; one more for the end."""
        return np.concatenate(([0], np.cumsum(self.sizes[ids])))

    def decode(self, ids: np.ndarray, offsets: np.ndarray | None = None) -> bytes:
        """The bytes of tokens that lie at the given offsets."""
        offsets = self.offsets(ids) if offsets is None else offsets
        sizes = np.diff(offsets)
        return self.bytes[np.repeat(self.starts[ids] - offsets[:-1] + offsets[0], sizes) + np.arange(sizes.sum())].tobytes()

    def known(self, ids: list[int | None]) -> np.ndarray:
        return np.array([i for i in ids if i is not None and 0 <= i < len(self.sizes)], dtype=np.int64)


def _utf8(texts: pa.Array) -> tuple[bytes, np.ndarray]:
    """The bytes of all texts and the size of each; nulls are empty, what is no UTF-8 is replaced."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = data[int(offsets[0]) : int(offsets[-1])].to_pybytes() if data else b""
    try:
        raw.decode()
        return raw, np.diff(offsets)
    except UnicodeDecodeError:
        parts = [text.decode("utf-8", "replace").encode() for text in texts.to_pylist()]
        return b"".join(parts), np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))


_RANKS: dict[str, Ranks] = {}


def ranks(path: str) -> Ranks:
    """The rank file's tables of this worker, kept from task to task."""
    if path not in _RANKS:
        _RANKS[path] = Ranks(path)
    return _RANKS[path]


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", documents["text"].cast("string").alias("text"))


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum(counts)))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values))


def encode(documents: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids, offsets): ids in the order of the text, and the byte of the text at which each begins."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ranks(path)
        for batch in slices(batches, "text"):
            ids, counts = table.encode(batch.column("text"))
            offsets = table.offsets(ids)[:-1]
            ends = np.cumsum(counts)
            begins = np.zeros(len(counts), dtype=np.int64)
            filled = counts > 0
            begins[filled] = offsets[(ends - counts)[filled]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts), _lists(ids, counts), _lists(offsets - np.repeat(begins, counts), counts)],
                ["doc_id", "n_tokens", "ids", "offsets"],
            )

    return _texts(documents).mapInArrow(run, f"doc_id {kind}, n_tokens long, ids array<int>, offsets array<long>")


def decode(encoded: DataFrame, path: str, first: int = 0, last: int | None = None) -> DataFrame:
    """(doc_id, data): the bytes ``first`` to ``last`` (exclusive) of the text of each (doc_id, ids, offsets)."""
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ranks(path)
        for batch in batches:
            out = []
            rows = zip(batch.column("ids").to_pylist(), batch.column("offsets").to_pylist(), strict=True)
            for ids, offsets in rows:
                if not ids or offsets is None or len(offsets) != len(ids):
                    found = table.known(ids or [])
                    out.append(table.decode(found)[first:last])
                    continue
                a = max(int(np.searchsorted(offsets, first, side="right")) - 1, 0)
                b = len(ids) if last is None else int(np.searchsorted(offsets, last))
                data = table.decode(table.known(ids[a:b]))
                out.append(data[max(first - offsets[a], 0) : None if last is None else max(last - offsets[a], 0)] if a < b else b"")
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "data"])

    return encoded.select("doc_id", "ids", "offsets").mapInArrow(run, f"doc_id {kind}, data binary")


def digests(documents: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encoded, and decoded from the ids, some ids at a time."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ranks(path)
        numbers = [b"%d" % i for i in range(len(table.sizes))]
        for batch in slices(batches, "text"):
            ids, counts = table.encode(batch.column("text"))
            written, decoded, end = [], [], 0
            for count in counts.tolist():
                of_ids, of_text = hashlib.sha256(), hashlib.sha256()
                for start in range(end, end + count, STEP):
                    part = ids[start : min(start + STEP, end + count)]
                    of_ids.update((b"," if start > end else b"") + b",".join([numbers[i] for i in part.tolist()]))
                    of_text.update(table.decode(part))
                written.append(of_ids.hexdigest())
                decoded.append(of_text.hexdigest())
                end += count
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts), pa.array(written, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return _texts(documents).mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
