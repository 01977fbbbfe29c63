"""Token ids as Arrow files of equal-length sequences with masks.

The ids of all texts, in order of their ids, form one stream. Every range of documents gets a file; in it the
stream is cut into sequences of one length, and the last one is filled up under a mask. A batch of a file holds a
fixed number of sequences, so the place of a token gives batch, row and column by division, and a reader that maps the
file into memory touches just these bytes and copies nothing. A table beside the files says where each
document starts.
"""

from __future__ import annotations

import hashlib
import os
import re
import sys
import types
import unicodedata
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.bpe import byte_alphabet
from martloom.llm.common import col, materialize, slices
from martloom.llm.files import AtomicFile, store

SEQUENCE = 2048
SEQUENCES_PER_BATCH = 256
END = 2
# Runs, and parts of runs, that a Python worker remembers from task to task, and bytes of text it encodes at a time.
REMEMBERED_RUNS, REMEMBERED_PARTS = 600_000, 300_000
BYTES_AT_ONCE = 8 << 20
FILE = "tokens-{:06d}.arrow"


class SequenceWriter:
    """Appends ids to one file."""

    def __init__(self, uri: str, attempt: int, width: type, length: int):
        self.length, self.width = length, width
        self.kind = pa.list_(pa.from_numpy_dtype(width), length)
        self.mask = pa.list_(pa.bool_(), length)
        self.schema = pa.schema([pa.field("tokens", self.kind), pa.field("mask", self.mask)])
        self.file = AtomicFile(uri, attempt)
        self.writer = pa.ipc.new_file(self.file.sink, self.schema)
        self.parts: list[np.ndarray] = []
        self.waiting = self.total = 0
        self.batch = length * SEQUENCES_PER_BATCH

    def append(self, ids: np.ndarray) -> None:
        self.parts.append(ids)
        self.waiting += len(ids)
        self.total += len(ids)
        if self.waiting >= self.batch:
            self._write(last=False)

    def _write(self, last: bool) -> None:
        ids = np.concatenate([np.zeros(0, self.width), *self.parts])
        whole = len(ids) if last else len(ids) // self.batch * self.batch
        for start in range(0, whole, self.batch):
            here = ids[start : min(start + self.batch, whole)]
            filled = -(-len(here) // self.length) * self.length
            mask = np.arange(filled) < len(here)
            values = np.zeros(filled, self.width)
            values[: len(here)] = here
            self.writer.write_batch(
                pa.RecordBatch.from_arrays(
                    [pa.FixedSizeListArray.from_arrays(pa.array(values), self.length),
                     pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)],
                    schema=self.schema,
                )
            )
        self.parts, self.waiting = [ids[whole:].copy()], len(ids) - whole

    def close(self) -> None:
        self._write(last=True)
        self.writer.close()
        self.file.close()


class SequenceReader:
    """Reads ids of one file by their place. Local files are mapped into memory."""

    def __init__(self, uri: str):
        fs, path = store(uri)
        self.source = pa.memory_map(path) if fs.type_name == "local" else fs.open_input_file(path)
        self.reader = pa.ipc.open_file(self.source)
        self.length = self.reader.schema.field("tokens").type.list_size

    def sequence(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """One sequence and its mask, which is true for ids and false for filling."""
        batch = self.reader.get_batch(number // SEQUENCES_PER_BATCH)
        row = number % SEQUENCES_PER_BATCH
        values, mask = batch.column("tokens").slice(row, 1).flatten(), batch.column("mask").slice(row, 1).flatten()
        return values.to_numpy(), mask.to_numpy(zero_copy_only=False)

    def ids(self, place: int, n: int) -> np.ndarray:
        """``n`` ids from ``place`` on."""
        size, out = self.length * SEQUENCES_PER_BATCH, []
        while n > 0:
            values = self.reader.get_batch(place // size).column("tokens").flatten()
            here = values[place % size : place % size + n].to_numpy()
            out.append(here)
            place, n = place + len(here), n - len(here)
        return out[0] if len(out) == 1 else np.concatenate([np.zeros(0, np.uint32), *out])


class WordEncoder:
    """Ids of texts by the tokenizers library, which is asked once for each distinct part of a run of non-blanks.

    Its model cuts texts at white space and then into letters, digits and the rest, and normalises each
    character in its place. So runs can be encoded one by one, and a run without apostrophes and marks of special
    tokens in parts: if it is ASCII at each change of class, else before the punctuation at its end. A part that is
    surely one piece of one class in normal form goes to the library's model at once, any other through all its steps.
    """

    CLASSES = re.compile(rb"[a-z]+|[0-9]|[^a-z0-9]+")
    TAIL = re.compile(rb"[.,;:!?%&*#$|]+$")
    # One piece: lower-case letters, a digit, or visible characters but for the apostrophe and the mark of special tokens.
    PIECE = re.compile(rb"[a-z]+|[0-9]|[!-&(-/:;=-@\[-`{-~]+")
    # Letters below U+0180 stand for themselves in the normal form, and all but one stay one letter in lower case.
    LETTERS = re.compile("[A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u017f]+")

    def __init__(self, content: str, width: type):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.kind = Tokenizer.from_str(content), "H" if width is np.uint16 else "I"
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.letters = str.maketrans({byte: letter for letter, byte in byte_alphabet().items()})
        self.known: dict[bytes, bytes] = {}
        self.known_parts: dict[bytes, bytes] = {}

    def _parts(self, run: bytes) -> list[bytes]:
        if run.isalpha():
            return [run.lower()]
        if b"<" in run or b"'" in run:
            return [run]
        if run.isascii():
            return self.CLASSES.findall(run.lower())
        tail = self.TAIL.search(run)
        # What stands before the tail must still end in a letter when the model has normalised it.
        if tail and unicodedata.normalize("NFC", run[: tail.start()].decode("utf-8", "replace")).lower()[-1:].isalpha():
            return [run[: tail.start()], tail.group()]
        return [run]

    def _encode(self, parts: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Each part with its ids."""
        others = []
        for part in parts:
            if self.PIECE.fullmatch(part):
                piece = part.decode()
            else:
                text = part.decode("utf-8", "replace")
                if not self.LETTERS.fullmatch(text):
                    others.append((part, text))
                    continue
                piece = text.lower().encode().decode("latin-1").translate(self.letters)
            yield part, array(self.kind, [t.id for t in self.model.tokenize(piece)]).tobytes()
        encoded = self.tokenizer.encode_batch_fast([t for _, t in others], add_special_tokens=False)
        for (part, _), e in zip(others, encoded, strict=True):
            yield part, array(self.kind, e.ids).tobytes()

    def _ids(self, runs: list[bytes]) -> list[bytes]:
        """The ids of distinct runs."""
        for memory, most in ((self.known, REMEMBERED_RUNS), (self.known_parts, REMEMBERED_PARTS)):
            if len(memory) > most:
                # The older half goes.
                for key in list(islice(memory, len(memory) // 2)):
                    del memory[key]
        new = [(r, self._parts(r)) for r in runs if r not in self.known]
        self.known_parts.update(self._encode(list({p for _, parts in new for p in parts if p not in self.known_parts})))
        of = self.known_parts.__getitem__
        self.known.update((r, of(parts[0]) if len(parts) == 1 else b"".join(map(of, parts))) for r, parts in new)
        return list(map(self.known.__getitem__, runs))

    def batch(self, texts: pa.Array, end: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of binary texts in a row, ``end`` behind each, and where each text's begin, the end of all at last."""
        # As bytes are only cut at ASCII blanks, they need not be valid text.
        wide = texts.cast(pa.large_binary())
        plain = pa.LargeStringArray.from_buffers(len(wide), *wide.buffers()[1:], offset=wide.offset)
        runs = pc.ascii_split_whitespace(plain)
        distinct = pc.dictionary_encode(runs.flatten())
        coded = self._ids(distinct.dictionary.cast(pa.large_binary()).to_pylist())
        tail = np.array(end or [], self.kind)
        lengths = np.fromiter(map(len, coded), np.int64, len(coded)) // tail.itemsize
        starts = np.cumsum(lengths) - lengths
        which = distinct.indices.to_numpy()
        ends = np.cumsum(lengths[which])
        places = np.repeat(starts[which] - (ends - lengths[which]), lengths[which])
        places += np.arange(len(places))
        ids = np.frombuffer(b"".join(coded), self.kind)[places]
        bounds = runs.offsets.to_numpy()
        bounds = np.concatenate([[0], ends])[bounds - bounds[0]]
        ids = np.insert(ids, np.repeat(bounds[1:], len(tail)), np.tile(tail, len(texts)))
        return ids, bounds + np.arange(len(bounds)) * len(tail)


def _kept_encoder(content: str, width: type) -> WordEncoder:
    """This Python worker's encoder with what it remembers, made anew only for another tokenizer.

    Tasks get this module by value, so the encoder is kept under a module name of its own.
    """
    kept = sys.modules.setdefault("_martloom_word_encoder", types.ModuleType("_martloom_word_encoder")).__dict__
    key = (hashlib.sha256(content.encode()).digest(), np.dtype(width).name)
    if kept.get("key") != key:
        kept.update(key=key, encoder=WordEncoder(content, width))
    return kept["encoder"]


def _checked(content: str) -> type:
    """The integer type for the ids of a tokenizer file; raises if its texts can't be encoded run by run."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(content)
    if tokenizer.encode("a  b\n", add_special_tokens=False).ids != [
        *tokenizer.encode("a", add_special_tokens=False).ids, *tokenizer.encode("b", add_special_tokens=False).ids
    ]:
        raise ValueError("a tokenizer that drops white space is needed")
    # Parts that are sent to the model at once must come out as they do through all steps.
    encoder = WordEncoder(content, np.uint32)
    samples = ["hello", "7", "...", "\xc9l\xe8ve", "\xdcber\xdf", "\u0179\u0105b", "\xb5\xba"]
    for (_, direct), text in zip(encoder._encode([t.encode() for t in samples]), samples, strict=True):
        if np.frombuffer(direct, np.uint32).tolist() != encoder.tokenizer.encode(text, add_special_tokens=False).ids:
            raise ValueError("a byte-level model with lower-case letters is needed")
    return np.uint16 if tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else np.uint32


def write_sequences(
    docs: DataFrame, out: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
    end: int = END, length: int = SEQUENCE,
) -> DataFrame:
    """Write the ids of all texts below ``out``; returns the table of documents.

    Per row of ``docs``: its id, ``file`` (number of the file), ``place`` (of its first id in that file), ``start`` (ids
    of all documents before it) and ``n_tokens``, the end id included. The table is stored, the files are complete.

    * A null text is empty and has the end id alone. Null ids come first.
    * Rows that repeat an id follow each other in the order of a hash of their texts.
    * An empty table writes no file.
    * A text of any length is encoded whole; one longer than ``BYTES_AT_ONCE`` is encoded alone.
    * Other columns of ``docs`` are not read, whatever their names.
    """
    with open(tokenizer, encoding="utf-8") as f:
        content = f.read()
    width = _checked(content)
    rows = docs.select(col(id_col).alias("id"), F.coalesce(col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    tie = F.xxhash64("text")
    # The hash spreads rows that share an id, or have none, over several ranges.
    rows = rows.repartitionByRange("id", tie).sortWithinPartitions("id", tie)
    schema = T.StructType([
        rows.schema["id"], T.StructField("file", T.IntegerType()), T.StructField("place", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        writer, encoder = None, _kept_encoder(content, width)
        for batch in batches:
            for part in slices(batch, "text", limit=BYTES_AT_ONCE):
                writer = writer or SequenceWriter(
                    f"{out}/{FILE.format(task.partitionId())}", task.taskAttemptId(), width, length
                )
                ids, bounds = encoder.batch(part.column("text"), [end])
                places = writer.total + bounds
                writer.append(ids)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array([task.partitionId()] * part.num_rows, pa.int32()),
                     pa.array(places[:-1], pa.int64()), pa.array(np.diff(places), pa.int64())],
                    names=schema.names,
                )
        if writer:
            writer.close()

    index = materialize(rows.mapInArrow(run, schema), "token-index")
    files = index.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    # A row per file.
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = materialize(files.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset")), "token-files")
    return index.join(files, "file").select(
        F.col("id").alias(id_col), "file", "place", (F.col("place") + F.col("offset")).alias("start"), "n_tokens",
    )


def read_sequences(index: DataFrame, out: str, id_col: str = "doc_id") -> DataFrame:
    """The documents of ``index`` with ``ids``: their token ids, read from the files below ``out``, as
    unsigned 32-bit integers in little-endian order."""
    rows = index.select(col(id_col).alias("id"), "file", "place", "start", "n_tokens")
    schema = T.StructType([
        rows.schema["id"], T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = reader = None
        for batch in batches:
            file, place, n = (batch.column(c).to_pylist() for c in ("file", "place", "n_tokens"))
            done = 0
            while done < len(file):
                ids, size = [], 0
                while done + len(ids) < len(file) and size < BYTES_AT_ONCE:
                    i = done + len(ids)
                    if file[i] != number:
                        number, reader = file[i], SequenceReader(f"{out}/{FILE.format(file[i])}")
                    ids.append(reader.ids(place[i], n[i]).astype("<u4").tobytes())
                    size += len(ids[-1])
                part = batch.slice(done, len(ids))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("start"), part.column("n_tokens"), pa.array(ids, pa.binary())],
                    names=schema.names,
                )
                done += len(ids)

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
