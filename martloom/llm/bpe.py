"""Byte-level BPE: an encoder that is exact and linear, and a decoder by an offset table.

The encoder walks over a piece of text from token to token. At each place it takes the longest token that an
Aho-Corasick automaton finds there and keeps it if the pair with the token before is one that merging in
rank order would also leave apart. If not, it tries the next shorter token, and where none is left it goes one
token back. Places that have proved dead are not entered again, so the walk is linear in the text.

Texts are cut before their blanks, and each distinct cut of a batch is looked up once.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from martloom.llm.common import bare, col, map_batches, slices

# Fixed value: how byte-level vocabularies cut a text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Fixed value: the white space of Unicode. No piece runs on from a character outside it to one inside it, so a run
# of white space with what follows it can be encoded, and remembered, on its own.
BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# The same of ASCII bytes, and the bytes that white space ends with.
ASCII_PIECES = rb"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"
BLANK_ENDS = tuple(chr(c).encode() for c in range(0x3001) if re.match(f"[{BLANK}]", chr(c)))
# Runs and pieces a task remembers.
REMEMBERED = 300_000


def byte_alphabet() -> dict[str, int]:
    """The letter that stands for each byte: printable Latin-1 for itself, the rest from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens by id, merges by rank and special tokens, read from a tokenizer file."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        if model["type"] != "BPE" or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec.get("normalizer"):
            raise ValueError("not a byte-level BPE vocabulary")
        if spec["pre_tokenizer"].get("add_prefix_space") or not spec["pre_tokenizer"].get("use_regex", True):
            raise ValueError("a vocabulary with a prefix blank or without pieces is not supported")
        letters = byte_alphabet()
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = 1 + max([*model["vocab"].values(), *self.special.values()])
        self.tokens = [b""] * size
        for token, number in model["vocab"].items():
            self.tokens[number] = bytes(letters[c] for c in token)
        for token, number in self.special.items():
            self.tokens[number] = token.encode()
        # Parts and rank of each merged token. Single bytes have no parts and come before all merges.
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.rank = [-1] * size
        for i, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right, both = model["vocab"][a], model["vocab"][b], model["vocab"][a + b]
            self.merged[left, right] = i
            if both not in self.parts:
                self.parts[both], self.rank[both] = (left, right), i

    def apart(self, left: int, right: int, before: float = float("inf")) -> bool:
        """Whether merging by rank, up to rank ``before``, leaves ``left`` and ``right`` as two tokens.

        Undo the later merge of the two again and again: no pair that ever stood at the border may have had
        a merge that comes sooner than the one that took its neighbour away. Of equal merges the left one comes first.
        """
        merged, rank, parts = self.merged, self.rank, self.parts
        while True:
            across = merged.get((left, right))
            if across is not None and across < before:
                return False
            a, b = rank[left], rank[right]
            if a < 0 and b < 0:
                return True
            if a > b:
                before, left = a, parts[left][1]
            else:
                before, right = b + 1, parts[right][0]


class Memory(dict):
    """Remembers what ``make`` gives for short keys, and forgets all of it when full."""

    def __init__(self, make: Callable[[bytes], bytes]):
        self.make = make

    def __missing__(self, key: bytes) -> bytes:
        value = self.make(key)
        if len(key) < 100:
            if len(self) >= REMEMBERED:
                self.clear()
            self[key] = value
        return value


class Encoder:
    """Encodes text to ids; one per task."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = v = vocabulary
        self.pairs: dict[int, bool] = {}
        # Tokens that merging can reach, each with the longest shorter one that starts it.
        reached: dict[int, bool] = {}
        self.finder = ahocorasick.Automaton()
        for number in sorted(range(len(v.tokens)), key=v.rank.__getitem__):
            if number in v.parts:
                left, right = v.parts[number]
                reached[number] = reached[left] and reached[right] and v.apart(left, right, v.rank[number])
            else:
                reached[number] = len(v.tokens[number]) == 1
            if reached[number]:
                self.finder.add_word(v.tokens[number].decode("latin-1"), (number, len(v.tokens[number])))
        self.finder.make_automaton()
        self.whole = by_bytes = {v.tokens[n]: n for n, ok in reached.items() if ok}
        self.shorter = {n: self._start(by_bytes, token) for token, n in by_bytes.items()}
        self.pieces = regex.compile(PIECES)
        self.runs = re.compile(f"[{BLANK}]*[^{BLANK}]+|[{BLANK}]+")
        marks = sorted(v.special, key=len, reverse=True)
        self.marks = re.compile("(" + "|".join(map(re.escape, marks)) + ")") if marks else None
        self.ascii_pieces = re.compile(ASCII_PIECES)
        self.lengths = [*map(len, v.tokens)]
        self.most = max(map(len, by_bytes))
        self.known_pieces = Memory(lambda p: array("i", self.piece(p)).tobytes())
        self.known_runs = Memory(lambda r: b"".join(map(self.known_pieces.__getitem__, self._pieces(r))))

    def _pieces(self, run: bytes) -> list[bytes]:
        if run.isascii():
            return self.ascii_pieces.findall(run)
        return [p.encode() for p in self.pieces.findall(run.decode("utf-8", "replace"))]

    @staticmethod
    def _start(by_bytes: dict[bytes, int], token: bytes) -> int:
        return next((by_bytes[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in by_bytes), -1)

    def _apart(self, left: int, right: int) -> bool:
        pair = left << 32 | right
        apart = self.pairs.get(pair)
        if apart is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            apart = self.pairs[pair] = self.vocabulary.apart(left, right)
        return apart

    def piece(self, piece: bytes) -> list[int]:
        """The ids of one piece."""
        if piece in self.whole:
            return [self.whole[piece]]
        lengths, text, size = self.lengths, piece.decode("latin-1"), len(piece)
        # The longest token at each place that the walk comes to if it never turns.
        longest = {end + 1 - length: number for end, (number, length) in self.finder.iter_long(text)}
        alive = bytearray(b"\1") * (size + 1)
        ids: list[int] = []
        at, token = 0, longest[0]
        while at < size:
            while token >= 0:
                end = at + lengths[token]
                if alive[end] and (not ids or self._apart(ids[-1], token)):
                    break
                token = self.shorter[token]
            if token >= 0:
                ids.append(token)
                at = end
                if at < size:
                    token = longest.get(at, -1)
                    if token < 0:
                        token = longest[at] = self._longest(piece, text, at)
            else:
                alive[at] = 0
                token = ids.pop()
                at -= lengths[token]
        return ids

    def _longest(self, piece: bytes, text: str, at: int) -> int:
        """The longest token at a place."""
        size = self.finder.longest_prefix(text[at : at + self.most])
        while piece[at : at + size] not in self.whole:
            size -= 1
        return self.whole[piece[at : at + size]]

    def text(self, text: str) -> bytes:
        """The ids of a text as 32-bit integers."""
        out = []
        for i, part in enumerate(self.marks.split(text) if self.marks else [text]):
            if i % 2:
                out.append(array("i", [self.vocabulary.special[part]]).tobytes())
            else:
                out += [self.known_runs[r.encode()] for r in self.runs.findall(part)]
        return b"".join(out)

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of binary texts in a row, and where each text's begin, the end of all at last."""
        # As bytes are only cut at blanks, they need not be valid text.
        parts = pc.split_pattern(texts, b" ")
        bounds = parts.offsets.to_numpy()
        bounds = bounds - bounds[0]
        parts = parts.flatten()
        distinct = pc.dictionary_encode(parts)
        words, which = distinct.dictionary.to_pylist(), distinct.indices.to_numpy().astype(np.int64)
        coded = [self.known_runs[b" " + w] for w in words]
        # A blank after white space does not begin a run, and special tokens come first: such texts are encoded on their own.
        odd = np.array([not w or w.endswith(BLANK_ENDS) for w in words], bool)[which]
        odd[bounds[1:] - 1] = False
        alone = np.add.reduceat(odd, bounds[:-1]) > 0 if len(texts) else np.zeros(0, bool)
        for mark in self.vocabulary.special:
            alone |= pc.match_substring(texts, mark.encode()).to_numpy(zero_copy_only=False)
        # No blank is before the first part.
        first = bounds[:-1]
        which[np.repeat(alone, np.diff(bounds))] = len(coded)
        which[first] = len(coded) + 1 + np.arange(len(texts))
        coded.append(b"")
        for text, part, by_itself in zip(texts.to_pylist() if alone.any() else first, parts.take(pa.array(first)).to_pylist(), alone, strict=True):
            coded.append(self.text(text.decode("utf-8", "replace")) if by_itself else self.known_runs[part])
        lengths = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        starts = np.cumsum(lengths) - lengths
        ends = np.cumsum(lengths[which])
        places = np.repeat(starts[which] - (ends - lengths[which]), lengths[which])
        places += np.arange(len(places))
        return np.frombuffer(b"".join(coded), np.int32)[places], np.concatenate([[0], ends])[bounds]


class Decoder:
    """Texts of ids. All tokens lie in one run of bytes; an id's text is what stands between two neighbouring offsets."""

    def __init__(self, tokens: list[bytes]):
        # One more, empty, token stands for every id that the vocabulary lacks.
        self.size = len(tokens)
        self.run_of_bytes = np.frombuffer(b"".join([*tokens, b""]), np.uint8)
        self.offsets = np.cumsum([0, *map(len, tokens), 0])

    def text(self, ids: np.ndarray) -> str:
        ids = np.where((ids < 0) | (ids >= self.size), self.size, ids)
        starts, lengths = self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]
        ends = np.cumsum(lengths)
        if not len(ids):
            return ""
        places = np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1])
        return self.run_of_bytes[places].tobytes().decode("utf-8", "replace")


def encode(
    docs: DataFrame, vocabulary: str, text_col: str = "text", ids_col: str = "ids", decodes_col: str | None = None, keep_text: bool = True,
) -> DataFrame:
    """``docs`` with the token ids of each text, as the vocabulary file at path ``vocabulary`` encodes it.

    A null or empty text has no ids. The string of a special token stands for that token. A column named
    ``ids_col`` gives way to the result. The file is read by the driver; tasks get its content.
    With ``decodes_col`` the ids are decoded by the same task, and that column says whether this gives the text again.
    """
    with open(vocabulary, encoding="utf-8") as f:
        content = f.read()
    Vocabulary(content)
    made = [ids_col] if decodes_col is None else [ids_col, decodes_col]
    passed = [c for c in bare(docs, *made) if keep_text or c != text_col]
    frame = docs.select(*map(col, passed), col(text_col).cast("binary").alias(" text"))
    schema = T.StructType([*docs.select(*map(col, passed)).schema, T.StructField(ids_col, T.ArrayType(T.IntegerType(), False))])
    if decodes_col is not None:
        schema.add(decodes_col, T.BooleanType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        encoder = Encoder(Vocabulary(content))
        decoder = None if decodes_col is None else Decoder(encoder.vocabulary.tokens)
        for batch in batches:
            for part in slices(batch, " text"):
                texts = part.column(" text").fill_null(b"")
                ids, bounds = encoder.batch(texts)
                out = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))]
                if decoder is not None:
                    ids = np.split(ids, bounds[1:-1])
                    same = [decoder.text(i).encode() == t for i, t in zip(ids, texts.to_pylist(), strict=True)]
                    out.append(pa.array(same, pa.bool_()))
                yield [*part.columns[:-1], *out]

    return map_batches(frame, run, schema)


def decode(df: DataFrame, vocabulary: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``df`` with the text of each array of ids, special tokens included.

    Null ids give a null text; ids outside the vocabulary and null elements give nothing; bytes that are no UTF-8 become
    replacement characters. A column named ``text_col`` gives way to the result.
    """
    with open(vocabulary, encoding="utf-8") as f:
        decoder = Decoder(Vocabulary(f.read()).tokens)
    passed = bare(df, text_col)
    frame = df.select(*map(col, passed), col(ids_col).cast("array<int>").alias(" ids"))
    schema = T.StructType([*df.select(*map(col, passed)).schema, T.StructField(text_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            for part in slices(batch, " ids", 4):
                texts = []
                for value in part.column(" ids"):
                    if not value.is_valid:
                        texts.append(None)
                    else:
                        texts.append(decoder.text(value.values.fill_null(-1).to_numpy(zero_copy_only=False)))
                yield [*part.columns[:-1], pa.array(texts, pa.string())]

    return map_batches(frame, run, schema)
