"""Encoding whole corpora with the tokenizers library, and Arrow helpers.

The vocabulary's pattern never joins characters across white space, nor letters with other characters, so a text's ids are
the concatenation of its pieces' ids. Pieces are cut with array operations on the bytes of many texts at once; a worker
remembers the ids of the pieces it has met by a 64-bit hash of their bytes, and the library encodes the others, many in one
call. What array operations can't cut safely is left to the library: a text with an apostrophe or with characters beyond
ASCII other than letters is cut at ASCII white space only, and a text that is not in NFC, has control characters, a dotted
capital I or ``<|`` (a special token may be in it) is encoded as a whole. Ids fit 16 bits.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

#: Slots of the memo; it takes new pieces until half of them are used.
MEMO_SLOTS = 1 << 21
#: Pieces that one call of the library gets at most, and bytes of text that are cut at once.
CALL_PIECES = 8192
CUT_BYTES = 1 << 19
END_OF_WORD = "</w>"
_WHOLE = r"<\||[\x00-\x08\x0E-\x1F\x7F]|\x{0130}"
_UNSAFE = r"'|[^\x00-\x7F\p{L}]"
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_CLASS = np.full(256, _OTHER, dtype=np.uint8)
_CLASS[128:] = _LETTER
_CLASS[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)]] = _LETTER
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class SpanHash:
    """64-bit hashes of many spans of a byte array, which follow each other and are not empty.

    Eight bytes at a time are mixed with their place in the span and summed, so that no algebra of the sum relates the
    hashes of different spans: two given spans collide with a chance of 2 ** -64.
    """

    PLACE = 0x9E3779B97F4A7C15

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sizes = ends - starts
        if not len(sizes):
            return np.zeros(0, dtype=np.uint64)
        blocks = (sizes + 7) >> 3
        upto = np.cumsum(blocks)
        first = upto - blocks
        place = np.arange(int(upto[-1])) - np.repeat(first, blocks)
        at = np.repeat(starts, blocks) + 8 * place
        until = np.repeat(ends, blocks)
        padded = np.concatenate((data, np.zeros(8, dtype=np.uint8)))
        words = np.zeros(len(at), dtype=np.uint64)
        for i in range(8):
            byte = padded[np.minimum(at + i, len(data))].astype(np.uint64)
            words |= np.where(at + i < until, byte, np.uint64(0)) << np.uint64(8 * i)
        key = mixed((place + 1).astype(np.uint64) * np.uint64(self.PLACE))
        sums = np.add.reduceat(mixed(words ^ key) * key, first)
        return mixed(sums + sizes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)


class Memo:
    """Where the ids of a piece lie, by the piece's hash (never 0): open addressing in arrays."""

    def __init__(self, slots: int = MEMO_SLOTS) -> None:
        self.mask = slots - 1
        self.used = 0
        self.keys = np.zeros(slots, dtype=np.uint64)
        self.starts = np.zeros(slots, dtype=np.int32)
        self.sizes = np.zeros(slots, dtype=np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each hash, -1 if it is not there."""
        at = ((hashes >> np.uint64(20)) & np.uint64(self.mask)).astype(np.int64)
        key = self.keys[at]
        found = np.where(key == hashes, at, -1)
        open_ = np.flatnonzero((key != hashes) & (key != 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.mask
            key = self.keys[at[open_]]
            hit = key == hashes[open_]
            found[open_[hit]] = at[open_[hit]]
            open_ = open_[~hit & (key != 0)]
        return found

    def has_room(self, n: int) -> bool:
        return self.used + n <= len(self.keys) // 2

    def add(self, hashes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
        at = ((hashes >> np.uint64(20)) & np.uint64(self.mask)).astype(np.int64)
        left = np.arange(len(hashes))
        while len(left):
            empty = self.keys[at[left]] == 0
            self.keys[at[left[empty]]] = hashes[left[empty]]
            won = self.keys[at[left]] == hashes[left]
            self.starts[at[left[won]]] = starts[left[won]]
            self.sizes[at[left[won]]] = sizes[left[won]]
            left = left[~won]
            at[left] = (at[left] + 1) & self.mask
        self.used += len(hashes)


class Library:
    """The tokenizers library on whole texts and on ready pieces."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # The same model without normalising and cutting.
        self.ready = Tokenizer(self.tokenizer.model)
        self.ready.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith(END_OF_WORD)]] = True

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u2").tobytes()

    def pieces(self, pieces: list[str]) -> Iterator[bytes]:
        """Many pieces in one call, with a space between them; every piece ends with its only end-of-word token."""
        for start in range(0, len(pieces), CALL_PIECES):
            part = pieces[start : start + CALL_PIECES]
            ids = np.array(self.ready.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, dtype="<u2")
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(part):
                raise ValueError("a piece has no end-of-word token or several")
            data, begin = ids.tobytes(), 0
            for end in (2 * ends).tolist():
                yield data[begin:end]
                begin = end


class Encoder:
    """Ids of texts. ``backend`` encodes whole texts and pieces; the rest is cutting and remembering."""

    def __init__(self, backend) -> None:
        self.backend = backend
        self.hash = SpanHash()
        self.memo = Memo()
        self.pool = np.zeros(1 << 16, dtype="<u2")
        self.pool_used = 0

    def _ids(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, ready: np.ndarray):
        """(start in the pool, size) of the ids of each span."""
        slots = self.memo.find(hashes)
        at, sizes = self.memo.starts[slots], self.memo.sizes[slots]
        missing = np.flatnonzero(slots < 0)
        if len(missing):
            new, first, back = np.unique(hashes[missing], return_index=True, return_inverse=True)
            first = missing[first]
            raw = data.tobytes()
            texts = [raw[s:e].decode() for s, e in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
            is_ready = ready[first].tolist()
            encoded = self.backend.pieces([t for t, r in zip(texts, is_ready, strict=True) if r])
            encoded = iter(list(encoded))
            ids = [next(encoded) if r else self.backend.whole(t) for t, r in zip(texts, is_ready, strict=True)]
            new_sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 2
            new_at = self.pool_used + np.cumsum(new_sizes) - new_sizes
            end = self.pool_used + int(new_sizes.sum())
            if end > len(self.pool):
                self.pool = np.concatenate((self.pool, np.zeros(end, dtype="<u2")))
            self.pool[self.pool_used : end] = np.frombuffer(b"".join(ids), dtype="<u2")
            if self.memo.has_room(len(new)) and end < 2**31:
                self.memo.add(new, new_at, new_sizes)
                self.pool_used = end
            at, sizes = at.astype(np.int64), sizes.astype(np.int64)
            at[missing], sizes[missing] = new_at[back], new_sizes[back]
        return at, sizes

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """encode() for texts that need not be encoded as a whole."""
        safe = pc.invert(pc.match_substring_regex(texts, _UNSAFE)).to_numpy(zero_copy_only=False)
        texts = pc.utf8_lower(texts)
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        if offsets[-1] == offsets[0]:
            return np.zeros(0, dtype="<u2"), np.zeros(len(texts), dtype=np.int64)
        data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        kind = _CLASS[data]
        ready = np.repeat(safe, np.diff(offsets))
        kind = np.where(ready | (kind == _SPACE), kind, _LETTER)
        edge = np.empty(len(data) + 1, dtype=bool)
        edge[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        edge[offsets] = True
        cuts = np.flatnonzero(edge)
        starts, ends = cuts[:-1], cuts[1:]
        keep = kind[starts] != _SPACE
        starts, ends = starts[keep], ends[keep]
        at, sizes = self._ids(self.hash(data, starts, ends), data, starts, ends, ready[starts])
        until = np.cumsum(sizes, dtype=np.int64)
        total = int(until[-1]) if len(until) else 0
        ids = self.pool[np.repeat(at - (until - sizes), sizes) + np.arange(total)]
        return ids, np.concatenate(([0], until))[np.searchsorted(starts, offsets[1:])]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other (null: none), and where each text's ids end."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        whole = pc.match_substring_regex(texts, _WHOLE).to_numpy(zero_copy_only=False).copy()
        for i in np.flatnonzero(~pc.string_is_ascii(texts).to_numpy(zero_copy_only=False)):
            whole[i] |= not unicodedata.is_normalized("NFC", texts[i].as_py())
        if not whole.any():
            return self._cut(texts)
        ids, ends = self._cut(pc.if_else(pa.array(whole), "", texts))
        begins = np.concatenate(([0], ends[:-1]))
        parts = [
            np.frombuffer(self.backend.whole(texts[i].as_py()), dtype="<u2") if whole[i] else ids[begins[i] : ends[i]]
            for i in range(len(texts))
        ]
        return np.concatenate(parts), np.cumsum([len(x) for x in parts])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The library's encoder of this worker, kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(Library(path))
    return _ENCODERS[path]


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int = CUT_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of one text or binary column, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        groups = np.cumsum(sizes, dtype=np.int64) // most
        cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), batch.num_rows]
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            if end > begin:
                yield batch.slice(begin, end - begin)
