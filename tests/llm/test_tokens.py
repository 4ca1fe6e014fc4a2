import base64
import hashlib
import json
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from terroir.llm import bpe, pieces, records

SEED = random.Random(7)
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
LETTERS = "ab 'stéß日\n\t  　\x1c\x85\xa0​.,!12٣²re\U0001f600"


def odd(n):
    return "".join(SEED.choice(LETTERS) for _ in range(n))


def texts():
    out = [odd(SEED.randint(0, 50)) for _ in range(400)]
    return out + ["", " ", "  a", "a  ", "\n a", "don't, they're", "x" * 300, "= " * 50, " " * 40 + "a", "<|endoftext|> b"]


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pieces_join_to_the_text():
    for text in texts():
        if text:
            assert " ".join(pieces.pieces(text)) == text


def test_encoding_and_decoding(reference):
    codec = bpe.codec(RANKS, public_tokenizers.PATTERN)
    given = texts()
    ids = codec.encode(given)
    assert [list(x) for x in ids] == [reference.encode_ordinary(t) for t in given]
    assert codec.decode(ids) == [t.encode() for t in given]
    assert codec.encode([]) == [] and codec.decode([]) == []


def test_equal_sequences_are_decoded_once(monkeypatch):
    codec = bpe.codec(RANKS, public_tokenizers.PATTERN)
    given, decode, sizes = [*texts(), "the same words " * 3000, "", "the same words"], codec._decode, []
    monkeypatch.setattr(codec, "_decode", lambda sequences: sizes.append(len(sequences)) or decode(sequences))
    monkeypatch.setattr(bpe, "STRETCH", 7)
    assert codec.decode(codec.encode(given)) == [t.encode() for t in given]
    assert 0 < sum(sizes) < 6000
    assert codec.decode(codec.encode(["", ""])) == [b"", b""]


def test_full_dictionaries_change_nothing(reference, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT", 20)
    monkeypatch.setattr(bpe, "KEPT", 20)
    monkeypatch.setattr(bpe, "CHUNK_BYTES", 30)
    codec = bpe.Bpe(RANKS, public_tokenizers.PATTERN)
    for _ in range(5):
        given = [odd(60) for _ in range(10)]
        assert [list(x) for x in codec.encode(given)] == [reference.encode_ordinary(t) for t in given]


def test_encoded_documents(documents, reference):
    pairs = [*enumerate(texts()), (None, "no id"), (500, None), (3, "same id"), (3, "same id"), (9, "long text, " * 30000)]
    rows = bpe.encode_documents(documents(pairs), RANKS, public_tokenizers.PATTERN).collect()
    expected = []
    for doc, text in pairs:
        ids = reference.encode_ordinary(text or "")
        packed = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        expected.append((doc, ids, len(ids), packed, hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, rows), key=str) == sorted(expected, key=str)
    assert bpe.encode_documents(documents([]), RANKS, public_tokenizers.PATTERN).collect() == []


def test_frames():
    payload = os.urandom(1000)
    frame = records.framed(payload)
    assert len(frame) == len(payload) + 16


@pytest.mark.parametrize("at", [0, 9, 20, -1])
def test_damage_is_found(tmp_path, at):
    frame = bytearray(records.framed(b"some payload here"))
    frame[at] ^= 1
    path = tmp_path / "x.rec"
    path.write_bytes(frame)
    with open(path, "rb") as stream, pytest.raises(ValueError):
        records.unframed(stream, 0)


def test_records_round_trip(spark, documents, tmp_path):
    tokenizer = Tokenizer.from_file(JSON)
    pairs = [(SEED.randint(-50, 10_000), t) for t in texts()] + [(None, "no id"), (-99, None), (7, "twice"), (7, "twice")]
    ordered = sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0, p[1] is not None, (p[1] or "").encode()))
    index = records.write_records(documents(pairs), JSON, 2, f"file://{tmp_path}/r")
    expected, start = [], 0
    for doc, text in ordered:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        expected.append((doc, start, ids, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    rows = sorted(map(tuple, records.read_records(spark, index).collect()), key=lambda r: r[1])
    assert [r[1:] for r in rows] == [e[1:] for e in expected]
    assert sorted(map(str, rows)) == sorted(map(str, expected))
    # Any order of the index reads any order of records.
    shuffled = f"{tmp_path}/shuffled"
    spark.read.parquet(index).orderBy(F.rand(1)).write.parquet(shuffled)
    assert sorted(map(tuple, records.read_records(spark, shuffled).collect()), key=lambda r: r[1]) == rows
    # The files hold the frames one after the other.
    stored = sum(os.path.getsize(f"{tmp_path}/r/records/{f}") for f in os.listdir(f"{tmp_path}/r/records") if f.endswith(".rec"))
    assert stored == 2 * start + 16 * len(pairs)


def test_end_marks_in_a_text_are_what_the_library_makes_of_them():
    given = ["a <|endoftext|> b", "x  <|endoftext|>", "<|endoftext|>", "a<|endoftext|>b c", "no mark", "", " <|endoftext", "\n\n a"]
    plain = Tokenizer.from_file(JSON)
    ids = [list(np.frombuffer(x, "<u2")) for x in records.tokens(JSON).encode_many(given)]
    assert ids == [plain.encode(t, add_special_tokens=False).ids for t in given]
    assert ids[0] == [64, 220, 50256, 275]


def test_pieces_encoded_in_one_go(monkeypatch):
    given = texts() + ["".join(SEED.choice("ab é\n.,!?1 ") for _ in range(3000)) for _ in range(20)]
    plain = Tokenizer.from_file(JSON)
    expected = [plain.encode(t, add_special_tokens=False).ids for t in given]
    assert [list(np.frombuffer(x, "<u2")) for x in records.Tokens(JSON).encode_many(given)] == expected
    monkeypatch.setattr(records, "WORDS", 3)
    small = records.Tokens(JSON)
    for t, ids in zip(given, expected, strict=True):
        assert list(np.frombuffer(small.encode_many([t])[0], "<u2")) == ids


def test_ids_over_two_bytes_are_read_as_written(documents, tmp_path):
    model = json.loads(open(JSON, encoding="utf-8").read())
    model["model"]["vocab"]["a"] = 70_000
    path = tmp_path / "wide.json"
    path.write_text(json.dumps(model), encoding="utf-8")
    rows = records.token_records(documents([(1, "a b"), (2, "a"), (3, None)]), str(path), 2).collect()
    plain = Tokenizer.from_file(str(path))
    expected = {i: [*plain.encode(t, add_special_tokens=False).ids, 2] for i, t in ((1, "a b"), (2, "a"), (3, ""))}
    assert {r.doc_id: r.ids for r in rows} == expected and expected[2][0] == 70_000


def test_no_documents(documents):
    assert records.token_records(documents([]), JSON, 2).collect() == []


@pytest.mark.parametrize("limit", [bpe.LONG_BYTES, 3])
def test_words_of_any_length(reference, monkeypatch, limit):
    """Words of 50,000 bytes, a chunk's worth of words of 100 bytes, and ordinary words as if they were long."""
    monkeypatch.setattr(bpe, "LONG_BYTES", limit)
    codec = bpe.Bpe(RANKS, public_tokenizers.PATTERN)
    given = ["x" * 50_000, " " * 50_000 + "a", "=" * 6_001, "ab" * 20_000, "".join(SEED.choice("aben") for _ in range(2_000))]
    given += texts()[-10:] + texts()[:20]
    if limit > 3:
        given.append(" ".join("".join(SEED.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(97)) for _ in range(4_000)))
    assert [list(x) for x in codec.encode(given)] == [reference.encode_ordinary(t) for t in given]
