"""Byte-pair encoding as a streaming transducer with bounded lookahead, and an incremental decoder.

A merge list has a sufficient lookahead: a number of symbols such that what follows beyond it can't change a token. It is
computed once from the list. What is appended to a text can first undo a merge at the end of what was there; the part this
frees may then take part in a merge of later rank to its left, which undoes a merge of later rank still, and so on. Along
such a chain ranks only grow, so one pass over the rules from the last to the first finds how far left any chain reaches.

The encoder buffers twice that many symbols of an open piece, merges them, and emits the tokens that end before the
lookahead; cutting at a token's end changes nothing to its right. Memory is constant whatever the length of the text or of
a single word. Pieces are cut the same way, holding back only what the pattern may still extend.

Encoding a table puts the same transducer behind the memo of ``tokens.Encoder``: every new piece of text runs through it
once per worker, and texts that can't be cut by arrays run through it as a whole.

Defined results: null and empty texts have no ids and decode to the empty text; ids outside the vocabulary decode to
nothing; bytes that are no UTF-8 decode to the replacement character; extra columns are ignored.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from lintlake.llm.tokens import END_OF_WORD, Encoder, slices

#: Fixed value: the vocabulary file's pattern.
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_LETTERS = regex.compile(r"[\p{L}]*")
_OTHERS = regex.compile(r"[^\s\p{L}\p{N}]*")
#: Characters of an unfinished piece that are kept as text before it is fed on in parts.
HOLD = 1024
#: Characters or ids handled at once.
STEP = 1 << 14
_NO_RULE = 1 << 30


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if it is printable, else the next one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


class Merges:
    """A vocabulary file's tokens and ranked merges."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocabulary = content["model"]["vocab"]
        self.tokens = {i: token for token, i in vocabulary.items()}
        self.special = {token["content"]: token["id"] for token in content["added_tokens"]}
        self.tokens |= {i: token for token, i in self.special.items()}
        rules = [rule if isinstance(rule, list) else rule.split(" ") for rule in content["model"]["merges"]]
        self.left = [vocabulary[a] for a, _ in rules]
        self.right = [vocabulary[b] for _, b in rules]
        self.merged = [vocabulary[a + b] for a, b in rules]
        self.rank = {(a, b): r for r, (a, b) in enumerate(zip(self.left, self.right, strict=True))}
        characters = byte_characters()
        self.symbols = [vocabulary[c] for c in characters]
        self.last_symbols = [vocabulary[c + END_OF_WORD] for c in characters]
        self.size = {i: len(token.removesuffix(END_OF_WORD)) for i, token in self.tokens.items()}
        self.lookahead = self._lookahead()

    def _lookahead(self) -> int:
        """How many symbols from the end of a text the tokens may depend on what is appended."""
        reach_of: dict[int, int] = {}  # by right operand: how far left of it later rules can reach
        behind: dict[int, int] = {}  # by right operand of a later rule: its left operand, and how far left of that
        most = 0
        for rank in range(len(self.merged) - 1, -1, -1):
            left, right, merged = self.left[rank], self.right[rank], self.merged[rank]
            # The rule takes ``left`` away from the token it was part of: the merged token may go on to the left, or the
            # later rule that would have used ``left`` frees its own left operand.
            reach = self.size[left] + max(reach_of.get(merged, 0), behind.get(left, 0))
            reach_of[right] = max(reach_of.get(right, 0), reach)
            behind[right] = max(behind.get(right, 0), self.size[left] + reach_of.get(left, 0))
            most = max(most, reach)
        return most + max(self.size.values())

    def merge(self, symbols: list[int]) -> list[int]:
        """The tokens of a sequence of symbols: the lowest-ranked rule first, from left to right."""
        out, rank_of = list(symbols), self.rank.get
        ranks = [rank_of(pair, _NO_RULE) for pair in zip(out, out[1:])]
        while ranks:
            best = min(ranks)
            if best == _NO_RULE:
                break
            i = ranks.index(best)
            out[i] = self.merged[best]
            del out[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank_of((out[i - 1], out[i]), _NO_RULE)
            if i < len(ranks):
                ranks[i] = rank_of((out[i], out[i + 1]), _NO_RULE)
        return out


class PieceTransducer:
    """Feeds one piece's bytes in and takes stable tokens out; at most 2 * lookahead symbols are held."""

    def __init__(self, merges: Merges) -> None:
        self.merges = merges
        self.held: list[int] = []

    def feed(self, data: bytes) -> list[int]:
        """Symbols other than the piece's last one."""
        out: list[int] = []
        window = 2 * self.merges.lookahead
        symbols = self.merges.symbols
        for start in range(0, len(data), self.merges.lookahead):
            self.held += [symbols[b] for b in data[start : start + self.merges.lookahead]]
            if len(self.held) >= window:
                out += self._emit()
        return out

    def _emit(self) -> list[int]:
        tokens, end = self.merges.merge(self.held), 0
        stable = len(self.held) - self.merges.lookahead
        out = []
        for token in tokens:
            if end + self.merges.size[token] > stable:
                break
            out.append(token)
            end += self.merges.size[token]
        self.held = self.held[end:]
        return out

    def finish(self, last: int) -> list[int]:
        """With the piece's last byte: what is left."""
        out = self.merges.merge([*self.held, self.merges.last_symbols[last]])
        self.held = []
        return out


class StreamEncoder:
    """Ids of a text that comes in parts of any size, as soon as they are certain."""

    def __init__(self, merges: Merges) -> None:
        self.merges = merges
        self.raw = ""  # not yet normalised
        self.text = ""  # normalised, not yet cut
        self.open: regex.Pattern | None = None  # what an unfinished long piece goes on with
        self.pending = b""  # its last bytes so far
        self.piece = PieceTransducer(merges)
        self.special = regex.compile("|".join(map(regex.escape, merges.special)) or r"(?!)")

    def feed(self, part: str) -> list[int]:
        self.raw += part
        out: list[int] = []
        while found := self.special.search(self.raw):
            before, self.raw = self.raw[: found.start()], self.raw[found.end() :]
            out += self._normalised(before, True) + [self.merges.special[found[0]]]
        # The last characters may begin a special token, or compose with what follows.
        keep = max((n for s in self.merges.special for n in range(1, len(s)) if self.raw.endswith(s[:n])), default=0)
        cut = len(self.raw) - keep - 1
        while cut > 0 and (unicodedata.combining(self.raw[cut]) or "ᄀ" <= self.raw[cut] <= "ᇿ"):
            cut -= 1
        before, self.raw = self.raw[: max(cut, 0)], self.raw[max(cut, 0) :]
        return out + self._normalised(before, False)

    def finish(self) -> list[int]:
        before, self.raw = self.raw, ""
        return self._normalised(before, True)

    def _normalised(self, part: str, final: bool) -> list[int]:
        self.text += "".join(c.lower() for c in unicodedata.normalize("NFC", part)) if not part.isascii() else part.lower()
        out: list[int] = []
        if self.open:
            out += self._go_on(final)
        if not self.open:
            out += self._cut(final)
        return out

    def _go_on(self, final: bool) -> list[int]:
        """Feed the unfinished piece with what belongs to it."""
        end = self.open.match(self.text).end()
        data = self.pending + self.text[:end].encode()
        ends_here = final or end < len(self.text)
        self.text = self.text[end:]
        out = self.piece.feed(data[:-1])
        self.pending = data[-1:]
        if ends_here:
            out += self.piece.finish(self.pending[0])
            self.open, self.pending = None, b""
        return out

    def _cut(self, final: bool) -> list[int]:
        out: list[int] = []
        done = 0
        # Two characters behind an apostrophe can decide where it belongs.
        certain = len(self.text) if final else len(self.text) - 3
        for found in PIECE.finditer(self.text):
            if found.end() > certain:
                break
            data = found[0].encode()
            out += self.piece.feed(data[:-1]) + self.piece.finish(data[-1])
            done = found.end()
        self.text = self.text[done:] if not final else ""
        if len(self.text) > HOLD:
            found = PIECE.search(self.text)
            if found is None:
                self.text = ""
            elif len(found[0]) > HOLD // 2:
                self.open = _LETTERS if _LETTERS.match(found[0]).end() else _OTHERS
                self.text = self.text[found.start() :]
                out += self._go_on(False)
        return out

    def all(self, text: str) -> list[int]:
        out: list[int] = []
        for start in range(0, len(text), STEP):
            out += self.feed(text[start : start + STEP])
        return out + self.finish()


class SurfaceDecoder:
    """The vocabulary's own spelling, with one space between tokens: what a file without a decoder decodes to."""

    def __init__(self, merges: Merges) -> None:
        self.tokens = merges.tokens
        self.begun = False

    def feed(self, ids: Iterable[int]) -> str:
        found = [self.tokens[i] for i in ids if i in self.tokens]
        text = " ".join(found)
        if found and self.begun:
            text = " " + text
        self.begun = self.begun or bool(found)
        return text

    def finish(self) -> str:
        return ""


class TextDecoder:
    """The text: tokens to bytes, bytes to characters as they complete, a space after each end of word."""

    def __init__(self, merges: Merges) -> None:
        value = {c: b for b, c in enumerate(byte_characters())}
        special = set(merges.special.values())
        self.bytes = {
            i: token.encode() if i in special
            else bytes(value[c] for c in token.removesuffix(END_OF_WORD)) + (b" " if token.endswith(END_OF_WORD) else b"")
            for i, token in merges.tokens.items()
        }
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.state.decode(b"".join(self.bytes.get(i, b"") for i in ids))

    def finish(self) -> str:
        return self.state.decode(b"", True)


class Transducer:
    """What ``tokens.Encoder`` asks for, answered by the transducer."""

    def __init__(self, path: str) -> None:
        self.merges = Merges(path)

    def whole(self, text: str) -> bytes:
        return np.array(StreamEncoder(self.merges).all(text), dtype="<u2").tobytes()

    def pieces(self, pieces: list[str]) -> Iterator[bytes]:
        piece = PieceTransducer(self.merges)
        for text in pieces:
            data = text.encode()
            yield np.array(piece.feed(data[:-1]) + piece.finish(data[-1]), dtype="<u2").tobytes()


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(Transducer(path))
    return _ENCODERS[path]


def encode(documents: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_tokens, ids): ids as an array of integers, in the order of the text."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in slices(batches, "text"):
            ids, ends = encoder.encode(batch.column("text"))
            offsets = np.concatenate(([0], ends))
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(offsets)), lists], ["doc_id", "n_tokens", "ids"])

    texts = documents.select("doc_id", documents["text"].cast("string").alias("text"))
    return texts.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str, surface: bool = False) -> DataFrame:
    """(doc_id, text) of (doc_id, ids). ``surface``: the vocabulary's spelling instead of the text."""
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = _encoder(tokenizer).backend.merges
        for batch in batches:
            texts = []
            for ids in batch.column("ids").to_pylist():
                decoder = SurfaceDecoder(merges) if surface else TextDecoder(merges)
                texts.append(decoder.feed(ids or []) + decoder.finish())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def digests(documents: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encoded, then decoded step by step, never held as one text."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        merges = encoder.backend.merges
        numbers = [b"%d" % i for i in range(1 << 16)]
        for batch in slices(batches, "text"):
            ids, ends = encoder.encode(batch.column("text"))
            sizes = np.diff(np.concatenate(([0], ends)))
            written, decoded = [], []
            for end, size in zip(ends.tolist(), sizes.tolist(), strict=True):
                of_ids, of_text, decoder = hashlib.sha256(), hashlib.sha256(), SurfaceDecoder(merges)
                for start in range(end - size, end, STEP):
                    part = ids[start : min(start + STEP, end)].tolist()
                    of_ids.update((b" " if start > end - size else b"") + b" ".join([numbers[i] for i in part]))
                    of_text.update(decoder.feed(part).encode())
                of_text.update(decoder.finish().encode())
                written.append(of_ids.hexdigest())
                decoded.append(of_text.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes), pa.array(written, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    texts = documents.select("doc_id", documents["text"].cast("string").alias("text"))
    return texts.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
