"""Language-model scores by a bigram trie that no machine holds as a whole.

Texts become batches of word numbers. Each batch asks, once per distinct word, for the word's number and its count in the
training texts: the shards of the vocabulary add up what all batches sent and answer each. Then each batch sends its
pairs of words to the shards of the trie, by context. A shard counts the training pairs, builds its part of the trie, writes
it to the shared folder, maps it into memory and looks up all pairs of all batches in it. What comes back are sums per
document. A context that holds a large part of the corpus is spread over several shards.

Probabilities: words are smoothed by adding 0.1 to each count, one more unseen word included; pairs by
    p(w | v) = (c(v w) + M p(w)) / (c(v) + M),
whose weight for what was not seen needs only the count of v, so a context needs no shard of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import col, map_batches, materialize, scratch_path, slices
from martloom.llm.elias_fano import BigramTrie
from martloom.llm.files import AtomicFile, store
from martloom.llm.shingles import WordHashes, mixed

ADDED = 0.1
# What a context's own counts are weighed against.
M = 1000.0
# Log probabilities are stored in steps of 1 / STEPS, in 16 bits.
STEPS = 4096
HELD_OUT_OF = 10
# Bytes of text in a batch; words and pairs in a shard; pairs of one context in a shard.
BATCH_BYTES = 12 << 20
WORDS_PER_SHARD = 1_000_000
PAIRS_PER_SHARD = 2_000_000
PAIRS_PER_SLICE = 500_000
# Pairs of a shard that are looked up together.
PAIRS_AT_ONCE = 1 << 17
END = np.uint64(xxhash.xxh3_64_intdigest(b"\n"))  # no word has a line end
SHARD_FILE = "trie-{:06d}.ef"


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of integers, byte by byte and compressed; those that never fall as differences."""
    parts = []
    for a in arrays:
        a = np.asarray(a, np.uint64)
        rising = bool((a[1:] >= a[:-1]).all())
        values = np.diff(a, prepend=np.uint64(0)) if rising else a
        data = zlib.compress(values.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)
        parts += [np.array([len(a) if rising else ~len(a), len(data)], np.int64).tobytes(), data]
    return b"".join(parts)


def unpacked(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        n, size = np.frombuffer(data, np.int64, 2, at).tolist()
        raw = np.frombuffer(zlib.decompress(data[at + 16 : at + 16 + size]), np.uint8)
        values = np.ascontiguousarray(raw.reshape(8, n if n >= 0 else ~n).T).view(np.uint64).ravel()
        out.append(np.cumsum(values, dtype=np.uint64) if n >= 0 else values)
        at += 16 + size
    return out


def _batches(docs: DataFrame) -> DataFrame:
    """From ``id, text`` (binary), ``train``: per batch the documents, their lengths, word places, and the distinct words."""
    fields = [("batch", T.LongType()), ("ids", T.ArrayType(docs.schema["id"].dataType)), ("train", T.ArrayType(T.BooleanType())),
              ("lengths", T.BinaryType()), ("places", T.BinaryType()), ("words", T.BinaryType()), ("counts", T.BinaryType()),
              ("distinct", T.LongType()), ("tokens", T.LongType()), ("train_tokens", T.LongType())]
    schema = T.StructType([T.StructField(n, t) for n, t in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        from pyspark import TaskContext

        hashes, number = WordHashes(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "text", limit=BATCH_BYTES):
                tokens, lengths = [], []
                for text in part.column("text").to_pylist():
                    words = text.lower().split()
                    tokens += [np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)), END[None]]
                    lengths.append(len(words) + 1)
                words, places = np.unique(np.concatenate(tokens), return_inverse=True)
                train = np.array(part.column("train").to_pylist(), bool)
                learned = np.repeat(train, lengths)
                counts = np.bincount(places[learned], minlength=len(words))
                yield [
                    pa.array([number]), pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("id")),
                    pa.array([train.tolist()]), pa.array([packed(lengths)]), pa.array([zlib.compress(places.astype(np.uint32).tobytes(), 1)]),
                    pa.array([packed(words)]), pa.array([packed(counts)]),
                    pa.array([len(words)]), pa.array([len(places)]), pa.array([int(learned.sum())]),
                ]
                number += 1

    return map_batches(docs.select("id", "text", "train"), run, schema)


def _vocabulary(batches: DataFrame, shards: int) -> DataFrame:
    """Per batch and shard: numbers and training counts of the batch's words in that shard, in order of their hashes.

    ``fresh`` counts the shard's distinct training words, on one of its rows.
    """
    asked = T.StructType([T.StructField("shard", T.LongType()), T.StructField("batch", T.LongType()), T.StructField("data", T.BinaryType())])

    def ask(rows: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in rows:
            for row in batch.to_pylist():
                (words,), (counts,) = unpacked(row["words"]), unpacked(row["counts"])
                # Hashes are sorted, so each shard's part is one run.
                ends = np.searchsorted(((words >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32), np.arange(shards + 1))
                runs = [(s, slice(a, b)) for s, (a, b) in enumerate(zip(ends, ends[1:], strict=False)) if b > a]
                yield [pa.array([s for s, _ in runs], pa.int64()), pa.array([row["batch"]] * len(runs), pa.int64()),
                       pa.array([packed(words[r], counts[r]) for _, r in runs], pa.binary())]

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        shard = int(rows["shard"].iloc[0])
        sent = [unpacked(d) for d in rows["data"]]
        words, place = np.unique(np.concatenate([w for w, _ in sent]), return_inverse=True)
        counts = np.bincount(place, np.concatenate([c for _, c in sent]).astype(float), len(words)).astype(np.uint64)
        numbers = np.arange(len(words), dtype=np.uint64) * np.uint64(shards) + np.uint64(shard)
        cuts = np.split(place, np.cumsum([len(w) for w, _ in sent])[:-1])
        fresh = [int((counts > 0).sum())] + [0] * (len(sent) - 1)
        return pd.DataFrame({"batch": rows["batch"], "shard": shard, "fresh": fresh, "data": [packed(numbers[c], counts[c]) for c in cuts]})

    requests = map_batches(batches.select("batch", "words", "counts"), ask, asked)
    return requests.groupBy("shard").applyInPandas(answer, "batch long, shard long, fresh long, data binary")


def _pairs(joined: DataFrame, id_type: T.DataType, tokens: int, distinct: int, shards: int) -> DataFrame:
    """Per batch a row of its documents, with a negative shard, and a row of pairs for each shard of the trie."""
    fields = [("batch", T.LongType()), ("shard", T.LongType()), ("data", T.BinaryType()), ("ids", T.ArrayType(id_type)),
              ("held_out", T.ArrayType(T.BooleanType())), ("n_tokens", T.ArrayType(T.LongType())), ("n_known", T.ArrayType(T.LongType())),
              ("base", T.ArrayType(T.DoubleType()))]
    schema = T.StructType([T.StructField(n, t) for n, t in fields])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in rows:
            for i, row in enumerate(batch.drop_columns(["ids"]).to_pylist()):
                answers = [unpacked(a["data"]) for a in sorted(row["answers"], key=lambda a: a["shard"])]
                numbers, counts = (np.concatenate(x) for x in zip(*answers, strict=True))
                place = np.frombuffer(zlib.decompress(row["places"]), np.uint32)
                lengths = unpacked(row["lengths"])[0].astype(np.int64)
                first = np.cumsum(lengths) - lengths
                logs = np.log10((counts + ADDED) / (tokens + ADDED * (distinct + 1)))
                base = np.add.reduceat(logs[place], first)
                known = np.add.reduceat((counts[place] > 0).astype(np.int64), first)
                train = np.array(row["train"], bool)
                yield [
                    pa.array([row["batch"]]), pa.array([~row["batch"]]), pa.array([None], pa.binary()), batch.column("ids").slice(i, 1),
                    *[pa.array([x.tolist()], pa.list_(t)) for x, t in ((~train, pa.bool_()), (lengths, pa.int64()), (known, pa.int64()), (base, pa.float64()))],
                ]
                # The end of a text is also the context of the next one's first word.
                end = np.flatnonzero(np.bincount(place[first + lengths - 1], minlength=len(numbers)))[0]
                before = np.concatenate([[end], place[:-1]])
                before[first] = end
                doc = np.repeat(np.arange(len(lengths)), lengths)
                v, w, seen = numbers[before], numbers[place], counts[before]
                code = np.minimum(np.rint(-logs * STEPS), 65535)[place]
                # Frequent contexts are cut by their followers; everyone knows the count, so everyone cuts alike.
                cut = w % (seen // np.uint64(PAIRS_PER_SLICE) + np.uint64(1))
                shard = mixed(v * np.uint64(0x9E3779B97F4A7C15) + cut) % np.uint64(shards)
                order = np.lexsort((doc, w, v, shard))
                ends = np.searchsorted(shard[order], np.arange(shards + 1, dtype=np.uint64))
                runs = [(s, order[a:b]) for s, (a, b) in enumerate(zip(ends, ends[1:], strict=False)) if b > a]
                for s, r in runs:
                    data = packed(v[r], w[r], code[r], seen[r], doc[r], train[doc[r]])
                    yield [pa.array([row["batch"]]), pa.array([s], pa.int64()), pa.array([data]),
                           pa.array([None], batch.column("ids").type), *[pa.array([None], pa.list_(t)) for t in (pa.bool_(), pa.int64(), pa.int64(), pa.float64())]]

    return map_batches(joined.select("batch", "ids", "train", "lengths", "places", "answers"), run, schema)


def trie_of(v: np.ndarray, w: np.ndarray, code: np.ndarray, seen: np.ndarray, train: np.ndarray) -> BigramTrie:
    """The trie of the training pairs; ``code`` and ``seen`` go with w and v."""
    order = np.lexsort((w[train], v[train]))
    v, w, code, seen = (x[train][order] for x in (v, w, code, seen))
    first = np.flatnonzero(np.concatenate(([len(v) > 0], (v[1:] != v[:-1]) | (w[1:] != w[:-1])))[: len(v)])
    count = np.diff(np.append(first, len(v)))
    p = (count + M * 10.0 ** (-code[first].astype(float) / STEPS)) / (seen[first] + M)
    return BigramTrie.build(v[first], w[first], np.minimum(np.rint(-np.log10(p) * STEPS), 65535))


def pair_logs(trie: BigramTrie, v: np.ndarray, w: np.ndarray, code: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """log10 p(w | v) by the trie; what it lacks has what the context leaves to the word alone."""
    found = trie.find_all(v, w)
    left = np.log10(M / (seen + M)) - code.astype(float) / STEPS
    return np.where(found >= 0, -found / STEPS, left)


def _joined(sent: list[tuple], *columns: int) -> list[np.ndarray]:
    return [np.concatenate([s[i] for s in sent]) for i in columns]


def _runs(sent: list[tuple]) -> Iterator[list[tuple]]:
    """What batches sent, some of them at a time: enough pairs for one lookup, few beside all of the shard."""
    some, pairs = [], 0
    for s in sent:
        some.append(s)
        pairs += len(s[0])
        if pairs >= PAIRS_AT_ONCE:
            yield some
            some, pairs = [], 0
    if some:
        yield some


def _scored(pairs: DataFrame, out: str) -> DataFrame:
    """Per batch and shard: documents and their sums of log probabilities. Rows of documents pass through."""

    others = [c for c in pairs.columns if c not in ("batch", "shard", "data")]

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        shard = int(rows["shard"].iloc[0])
        if shard < 0:
            return rows.assign(sums=None)
        sent = [unpacked(d) for d in rows["data"]]
        # The last attempt to finish takes the name; all write the same bytes.
        uri = f"{out}/{SHARD_FILE.format(shard)}"
        file = AtomicFile(uri, int(np.random.default_rng().integers(1 << 62)))
        trie_of(*_joined(sent, 0, 1, 2, 3), _joined(sent, 5)[0].astype(bool)).write(file.sink)
        file.close()
        fs, path = store(uri)
        source = pa.memory_map(path) if fs.type_name == "local" else fs.open_input_file(path)
        trie = BigramTrie.open(source.read_buffer())
        logs = np.concatenate([pair_logs(trie, *_joined(some, 0, 1, 2, 3)) for some in _runs(sent)])
        at, data, sums = 0, [], []
        for s in sent:
            doc = s[4].astype(np.int64)
            total = np.bincount(doc, logs[at : at + len(doc)])
            docs = np.unique(doc)
            data.append(packed(docs))
            sums.append(total[docs].tobytes())
            at += len(doc)
        return pd.DataFrame({"batch": rows["batch"], "shard": shard, "data": data, "sums": sums, **dict.fromkeys(others)})

    schema = T.StructType([*pairs.schema, T.StructField("sums", T.BinaryType())])
    return pairs.groupBy("shard").applyInPandas(run, schema)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None) -> DataFrame:
    """``<id>, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    A row is held out from training if the CRC-32 of its id as text leaves no remainder by ``HELD_OUT_OF``. Words are
    lower-cased in A-Z and end at ASCII blanks; each text has an end token. The trie stays below ``model``, or in scratch space.

    * A null text is empty and has the end token alone. A null id counts as the empty text. Rows may repeat.
    * Without training rows every word has the same probability. An empty table gives an empty result.
    * Other columns are not read.
    """
    spark: SparkSession = docs.sparkSession
    key = F.coalesce(col(id_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        col(id_col).alias("id"), F.coalesce(col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
        (F.crc32(key) % HELD_OUT_OF != 0).alias("train"),
    )
    batches = materialize(_batches(rows), "lm-batches")
    size = batches.agg(*[F.sum(c).alias(c) for c in ("distinct", "tokens", "train_tokens")]).first()
    kind = docs.schema[id_col].dataType
    if size.tokens is None:
        empty = T.StructType([T.StructField(id_col, kind)])
        return spark.createDataFrame([], empty).selectExpr(
            "*", "false AS held_out", "0L AS n_tokens", "0L AS n_known", "0L AS train_tokens", "0D AS base_score", "0D AS score"
        )
    words = materialize(_vocabulary(batches, size.distinct // WORDS_PER_SHARD + 1), "lm-words")
    known = words.agg(F.sum("fresh")).first()[0]
    answers = words.groupBy("batch").agg(F.collect_list(F.struct("shard", "data")).alias("answers"))
    joined = batches.select("batch", "ids", "train", "lengths", "places").join(answers.hint("merge"), "batch")
    pairs = _pairs(joined, kind, size.train_tokens, known, size.tokens // PAIRS_PER_SHARD + 1)
    out = model or scratch_path(spark, "lm-trie")
    sums = materialize(_scored(pairs, out), "lm-sums")
    whole = sums.filter("shard < 0").drop("shard", "data", "sums")
    parts = sums.filter("shard >= 0").groupBy("batch").agg(F.sort_array(F.collect_list(F.struct("shard", "data", "sums"))).alias("parts"))
    joined = whole.join(parts.hint("merge"), "batch")
    columns = ["held_out", "n_tokens", "n_known", "base"]
    schema = T.StructType([
        T.StructField("id", kind), T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()), T.StructField("base", T.DoubleType()), T.StructField("score", T.DoubleType()),
    ])

    def add(rows: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in rows:
            for i, row in enumerate(batch.column("parts").to_pylist()):
                lists = [batch.column(c).slice(i, 1).flatten() for c in ("ids", *columns)]
                total = np.zeros(len(lists[0]))
                for part in row:
                    total[unpacked(part["data"])[0].astype(np.int64)] += np.frombuffer(part["sums"])
                yield [*lists, pa.array(total)]

    scored = map_batches(joined.select("ids", *columns, "parts"), add, schema)
    return scored.select(
        F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(size.train_tokens).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"), "score",
    )
