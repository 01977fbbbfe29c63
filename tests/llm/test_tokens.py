"""BPE encoding and decoding, and token files, against the tokenizers library."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from martloom.llm import bpe, token_files
from martloom.llm.queries import op3_token_files, op9_bpe

BYTE_BPE, WORD_BPE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = [
    "", " ", "  \n\n  x", "a<|endoftext|>b<|endoftext|>", "<|startoftext|> <|endoftext", "don't we'll", "\x1c\x1d\x85\xa0",
    "　 ﻿", "é é ŉ ΑΣ ΣΑΣ İ", "中文字 😀‍😀", "a" * 30_000, " " * 20_000, "x\x00y", "²Ⅳ½ ١٢٣", "tion" * 9_000, None,
]


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(BYTE_BPE)


def test_encoder_equals_library_on_random_strings(byte_library):
    encoder = bpe.Encoder(bpe.Vocabulary(open(BYTE_BPE, encoding="utf-8").read()))
    draw = random.Random(7)
    parts = [*"abest'!_1 \n\t", "'s", "  ", "\x1c", "\x85", "\xa0", "é", "ñ", "中", "́", "²", "23", "%%%", "<|endoftext|>",
             "😀", "‍", " ", "　", "the", "tion", " ththinger", "aaaaaaaa"]
    for _ in range(3000):
        text = "".join(draw.choices(parts, k=draw.randint(0, 25)))
        assert np.frombuffer(encoder.text(text), np.int32).tolist() == byte_library.encode(text, add_special_tokens=False).ids, text


def test_encoder_cuts_batches_at_blanks(byte_library):
    encoder = bpe.Encoder(bpe.Vocabulary(open(BYTE_BPE, encoding="utf-8").read()))
    draw = random.Random(9)
    parts = [*" " * 30, *"abest'!_1\n\t\x1c\x85\xa0\u3000\u2028", "'s", "\xe9", "\u4e2d", "23", "%%%", "<|endoftext|>", "the", "tion", " ththinger"]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 30))).encode() for _ in range(3000)] + [b"\xff a\xe2 b\xe2\x80 ", b"", b"  "]
    for rows in (texts, [], [b""], [b" ", b"\n "]):
        ids, bounds = encoder.batch(pa.array([b"not read  ", *rows], pa.binary()).slice(1))
        assert len(bounds) == len(rows) + 1 and bounds[-1] == len(ids)
        for text, start, stop in zip(rows, bounds, bounds[1:]):
            want = byte_library.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids
            assert ids[start:stop].tolist() == want, text


def test_encoder_looks_each_cut_up_once_in_a_batch(monkeypatch):
    encoder = bpe.Encoder(bpe.Vocabulary(open(BYTE_BPE, encoding="utf-8").read()))
    asked = []

    class Asked(dict):
        def __missing__(self, key):
            asked.append(key)
            return encoder.text(key.decode())

    monkeypatch.setattr(encoder, "known_runs", Asked())
    monkeypatch.setattr(encoder, "text", lambda text: np.int32([len(text)]).tobytes())
    ids, bounds = encoder.batch(pa.array([b"one two\nthree two " * 50, b"two one", b"a  b"]))
    assert sorted(asked) == sorted([b" two\nthree", b" two", b" one", b" a", b" b", b" ", b"one", b"two"])
    # 150 words and the blank at the end; two words; a text with two blanks in a row, on its own.
    assert (len(ids), bounds.tolist()) == (154, [0, 151, 153, 154])


def test_bpe_query(spark, sf_dir, documents, byte_library):
    rows = {r.doc_id: r for r in op9_bpe(spark, sf_dir).collect()}
    assert len(rows) == len(documents)
    for doc_id, text, _ in documents:
        ids = byte_library.encode(text or "", add_special_tokens=False).ids
        assert rows[doc_id].n_tokens == len(ids)
        assert rows[doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        decoded = byte_library.decode(ids, skip_special_tokens=False)
        assert rows[doc_id].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_bpe_odd_rows(spark, byte_library):
    docs = spark.createDataFrame(list(enumerate(ODD)), "`an id` int, text string").selectExpr("*", "1 AS ids", "2 AS `a.b`")
    back = bpe.decode(bpe.encode(docs, BYTE_BPE), BYTE_BPE, text_col="back")
    assert back.columns == ["an id", "text", "a.b", "ids", "back"]
    for r in back.collect():
        assert r.ids == byte_library.encode(r.text or "", add_special_tokens=False).ids
        assert r.back == (r.text or "")
    assert bpe.encode(docs.limit(0), BYTE_BPE).count() == 0


def test_decode_foreign_ids(spark):
    df = spark.createDataFrame([([64, -3, 70_000, None, 65],), (None,), ([],), ([220, 447],)], "ids array<int>")
    assert [r.text for r in bpe.decode(df, BYTE_BPE).collect()] == ["ab", None, "", " �"]


def test_word_encoder_equals_library_on_random_strings():
    library = Tokenizer.from_file(WORD_BPE)
    encoder = token_files.WordEncoder(open(WORD_BPE, encoding="utf-8").read(), np.uint16)
    draw = random.Random(8)
    parts = [*"abZEst'!_19 \n\t.,%&<>|", "'s", "'S", "\x1c", "\x01", "\x85", "\xa0", "é", "É", "ñ", "中", "́", "̱", "²", "İ", "Σ",
             "<|endoftext|>", "<|ENDOFTEXT|>", "😀", "‍", " ", "the", "Tion", "thinger", "ĳ", "ﬁ", "…", "—"]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 20))) for _ in range(6000)]
    rows = pa.array([b"not read", *(t.encode() for t in texts)]).slice(1)
    ids, bounds = encoder.batch(rows, [2])
    assert len(bounds) == len(texts) + 1 and bounds[-1] == len(ids)
    for text, start, stop in zip(texts, bounds, bounds[1:]):
        assert ids[start:stop].tolist() == [*library.encode(text, add_special_tokens=False).ids, 2], text


def test_word_encoder_forgets_and_goes_on(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED_RUNS", 20)
    monkeypatch.setattr(token_files, "REMEMBERED_PARTS", 10)
    library = Tokenizer.from_file(WORD_BPE)
    content = open(WORD_BPE, encoding="utf-8").read()
    encoder = token_files._kept_encoder(content, np.uint16)
    assert token_files._kept_encoder(content, np.uint16) is encoder
    assert token_files._kept_encoder(content, np.uint32) is not encoder
    for n in range(30):
        text = " ".join(f"Word{i}, {i}! \u00c9l{i}\u00e8ve" for i in range(n, n + 9))
        ids, _ = encoder.batch(pa.array([text.encode()]))
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(encoder.known) < 60
    for nothing in ([], [b""], [b" ", b"\n"]):
        ids, bounds = encoder.batch(pa.array(nothing, pa.binary()), [2])
        assert ids.tolist() == [2] * len(nothing) and bounds.tolist() == list(range(len(nothing) + 1))


def test_token_query(spark, sf_dir, documents):
    library = Tokenizer.from_file(WORD_BPE)
    rows = {r.doc_id: r for r in op3_token_files(spark, sf_dir).collect()}
    assert len(rows) == len(documents)
    start = 0
    for doc_id, text, _ in sorted(documents):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        r = rows[doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_token_files_odd_rows(spark, tmp_path):
    library = Tokenizer.from_file(WORD_BPE)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, ODD[3]), (3, "other"), (None, "no id"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string").selectExpr("*", "1 AS file", "2 AS place")
    index = token_files.write_sequences(docs, str(tmp_path), WORD_BPE, length=16)
    read = token_files.read_sequences(index, str(tmp_path)).collect()
    want = sorted((i, [*library.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in rows if i is not None)
    got = sorted((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in read if r.doc_id is not None)
    assert got == want
    spans = sorted((r.start, r.n_tokens, -1 if r.doc_id is None else r.doc_id) for r in read)
    assert [s for s, _, _ in spans] == [0, *np.cumsum([n for _, n, _ in spans])[:-1].tolist()]
    assert [i for _, _, i in spans] == sorted(i for _, _, i in spans)
    files = sorted(tmp_path.glob("*.arrow"))
    reader = token_files.SequenceReader(str(files[-1]))
    last = reader.reader.num_record_batches - 1
    tokens, mask = reader.sequence(last * token_files.SEQUENCES_PER_BATCH + reader.reader.get_batch(last).num_rows - 1)
    assert len(tokens) == len(mask) == 16 and tokens[mask][-1] == 2 and not tokens[~mask].any()
    empty = token_files.write_sequences(docs.limit(0), str(tmp_path / "none"), WORD_BPE)
    assert empty.count() == 0 and not (tmp_path / "none").exists()
