"""BPE and token files against the tokenizers library, and codes against simple models."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tributary.llm import bpe, token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")
KINDS = "doc_id long, text string, ids string, part int, key string"
ALPHABET = [
    " ", "  ", "\n", "\n\n", "'s", "'ll", "a", "the", "é", "ß", "1", "23", "½", "٣", "\x1c", "\x85", "\xa0", "　", "​", "!", "...",
    "<|endoftext|>", "漢", "😀", "́", "\t", "\r\n", "ing", "\x00", "ª", "²",
]


def texts():
    rng = random.Random(5)
    some = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 30))) for _ in range(300)]
    return [None, "", " ", "\n", "x" * 3000, "ab" * 2000, "word " * 5000, " " * 500, "thethe" * 300, *some, some[0]]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def docs(spark):
    rows = [(i, t, "x", 1, "y") for i, t in enumerate(texts())]
    return rows + [rows[5], (None, "no id", None, None, None)]


def test_round_trip_equals_library(spark, library):
    rows = docs(spark)
    got = bpe.round_trip_digests(spark.createDataFrame(rows, KINDS).repartition(3), PATH).collect()
    want = []
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_caches_do_not_matter(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 3)
    monkeypatch.setattr(bpe, "CACHED_PIECES", 3)
    monkeypatch.setattr(bpe, "SHORT_PIECE", 4)
    few, many = bpe.Vocabulary(PATH), bpe.vocabulary(PATH)
    for t in texts()[1:80]:
        assert few.encode(t) == many.encode(t)


def test_token_files_equal_library(spark, library, monkeypatch):
    rows = docs(spark)
    got = token_files.token_file_digests(spark.createDataFrame(rows, KINDS).repartition(4), PATH, 2).collect()
    want, start = [], 0
    for i, t, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_empty_tables(spark):
    none = spark.createDataFrame([], KINDS)
    assert bpe.round_trip_digests(none, PATH).collect() == []
    assert token_files.token_file_digests(none, PATH).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_codes_are_complete_and_best(seed):
    rng = np.random.default_rng(seed)
    counts = rng.integers(0, 5, 40) ** 6 * rng.integers(1, 50, 40)
    lengths = token_files.code_lengths(counts, 30)
    used = lengths[counts > 0]
    assert sum(Fraction(1, 1 << int(x)) for x in used) == 1 and not lengths[counts == 0].any()
    heap, cost = sorted(int(c) for c in counts if c), 0
    while len(heap) > 1:
        two = heap.pop(0) + heap.pop(0)
        cost += two
        heap = sorted([*heap, two])
    assert int((counts * lengths).sum()) == cost
    short = token_files.code_lengths(counts, 6)
    assert short.max() <= 6 and sum(Fraction(1, 1 << int(x)) for x in short[counts > 0]) == 1


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 3000])
def test_blocks_decode_alone(n):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % 500).astype(np.int64)
    lengths = token_files.code_lengths(np.bincount(ids, minlength=500))
    offsets, payload = token_files.pack(ids, lengths, token_files.canonical_codes(lengths))
    if n:
        table, width = token_files.decoding_table(lengths)
        assert (token_files.unpack(payload, offsets, n, table, width) == ids).all()
        last = (n - 1) // token_files.BLOCK
        assert (token_files.unpack(payload, offsets[last:], n - last * token_files.BLOCK, table, width) == ids[last * token_files.BLOCK :]).all()


def test_white_space_beside_white_space():
    rng = random.Random(3)
    marks = ["a", "b", " ", "\n", "\t", "\x0b", "\x1c", "\xa0", " ", "é"]
    for _ in range(3000):
        text = "".join(rng.choices(marks, weights=[20, 20, 4, 2, 1, 1, 1, 1, 1, 1], k=rng.randrange(12)))
        assert bpe._spaces_meet(text) == any(x.isspace() and y.isspace() for x, y in zip(text, text[1:], strict=False)), repr(text)
