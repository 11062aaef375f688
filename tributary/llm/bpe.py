"""Byte-level BPE encoding and decoding of documents, equal to the tokenizers library's.

The text is cut into pieces by the vocabulary's pattern. A short piece keeps a contiguous list of part
boundaries beside the rank of every adjacent pair; the least rank is looked for again and again, its
inner boundary is deleted and the two neighbouring ranks are renewed. A long piece, for which that
would take quadratic time, does the same merges from a heap.

Results: a null or empty text has no ids and decodes to the empty text. Repeated rows are each
encoded. The strings of special tokens are found in a text first, as the library does. Other columns
of the input play no part. Texts of any length are handled whole; a worker keeps a bounded number of
encoded words, which changes no result.
"""

from __future__ import annotations

import heapq
import json
import re
import struct
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.memory import given_back, kept

PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SHORT_PIECE = 96
CACHED_WORDS = 300_000
CACHED_PIECES = 50_000
OUTPUT_BYTES = 8 << 20

_NONE = 1 << 60
# Where single spaces and line ends stand between other characters, every space leads a piece and every
# line end is one; only neighbouring white space joins in other ways.
_DOUBLE = re.compile(r"\s\s")
_PAIRS = ("  ", " \n", "\n ", "\n\n")
_OTHER_SPACES = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f"
# Marks that end a piece of letters before them (no apostrophe: it may begin a contraction).
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def byte_letters() -> dict[str, int]:
    """Letter of the vocabulary file for each byte: printable Latin-1 stands for itself, the other
    bytes follow from U+0100 on, in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(0x100 + k): b for k, b in enumerate(other)}


def _spaces_meet(text: str) -> bool:
    """Whether white space stands beside white space."""
    if text.isascii() and not any(c in text for c in _OTHER_SPACES):
        return any(p in text for p in _PAIRS)
    return _DOUBLE.search(text) is not None


class Vocabulary:
    """Ids, merges and special tokens of one tokenizer file, ready to encode and decode."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("a byte-level BPE file without normalizer is needed")
        if spec["pre_tokenizer"]["add_prefix_space"] or model.get("ignore_merges"):
            raise ValueError("add_prefix_space and ignore_merges are not supported")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that strip or need word bounds are not supported")
        letters = byte_letters()

        def raw(token: str) -> bytes:
            return bytes(letters[c] for c in token)

        self.ids = {raw(t): i for t, i in model["vocab"].items()}
        self._merges = model["merges"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        found = "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))
        self._special = regex.compile(f"({found})") if found else None
        self.size = 1 + max([*self.ids.values(), *self.special.values()])
        self.bytes_of: list[bytes] = [b""] * self.size
        for token, i in self.ids.items():
            self.bytes_of[i] = token
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self._pattern = regex.compile(PATTERN)
        self._pieces: dict[bytes, bytes] = {}
        self._led, self._bare = _Words(self, " "), _Words(self, "")
        self._break = self.piece(b"\n")
        self.marks = {m: self.packed(m.encode()) for m in _MARKS}

    @cached_property
    def ranks(self) -> dict[bytes, int]:
        """Rank of the merged bytes of every merge. A rank belongs to the bytes: when it is the least one left, every
        earlier merge inside them is done, so they are in exactly the two parts that the merge names."""
        letters, merges, self._merges = byte_letters(), self._merges, None
        pairs = (m if isinstance(m, list) else m.split(" ") for m in merges)
        return {bytes([letters[c] for c in a + b]): k for k, (a, b) in enumerate(pairs)}

    def _short(self, piece: bytes) -> list[bytes]:
        rank = self.ranks.get
        cut = list(range(len(piece) + 1))
        near = [rank(piece[i : i + 2], _NONE) for i in range(len(piece) - 1)]
        while near and (least := min(near)) != _NONE:
            i = near.index(least)
            del cut[i + 1], near[i]
            if i < len(near):
                near[i] = rank(piece[cut[i] : cut[i + 2]], _NONE)
            if i:
                near[i - 1] = rank(piece[cut[i - 1] : cut[i + 1]], _NONE)
        return [piece[a:b] for a, b in zip(cut, cut[1:], strict=False)]

    def _long(self, piece: bytes) -> list[bytes]:
        rank = self.ranks.get
        n = len(piece)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def pair(i: int) -> int:
            j = end[i]
            return _NONE if j >= n else rank(piece[i : end[j]], _NONE)

        heap = [(r, i) for i in range(n - 1) if (r := pair(i)) != _NONE]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if not end[i] or pair(i) != r:
                continue
            j = end[i]
            end[i], end[j] = end[j], 0
            if end[i] < n:
                before[end[i]] = i
            for k in (before[i], i):
                if k >= 0 and (r := pair(k)) != _NONE:
                    heapq.heappush(heap, (r, k))
        out, i = [], 0
        while i < n:
            out.append(piece[i : end[i]])
            i = end[i]
        return out

    def merged(self, piece: bytes) -> list[int]:
        """Ids of one piece after all merges."""
        parts = self._short(piece) if len(piece) <= SHORT_PIECE else self._long(piece)
        return [self.ids[p] for p in parts]

    def packed(self, piece: bytes) -> bytes:
        """Ids of one piece as little-endian unsigned 32-bit integers."""
        return struct.pack(f"<{len(ids)}I", *ids) if (ids := self.merged(piece)) else b""

    def letters(self, lead: str, word: str) -> bytes:
        """The same for a word of letters and what leads it."""
        return self.packed((lead + word).encode())

    def piece(self, piece: bytes) -> bytes:
        """The same, kept for the next time."""
        packed = self._pieces.get(piece)
        if packed is None:
            packed = self.packed(piece)
            if len(piece) <= SHORT_PIECE:
                if len(self._pieces) >= CACHED_PIECES:
                    self._pieces.clear()
                self._pieces[piece] = packed
        return packed

    def pieces(self, text: str) -> bytes:
        return b"".join([self.piece(p.encode()) for p in self._pattern.findall(text)])

    def _plain(self, text: str) -> bytes:
        if _spaces_meet(text) or text[:1].isspace() or text[-1:].isspace():
            return self.pieces(text)
        lines = []
        for line in text.split("\n"):
            head, *rest = line.split(" ")
            lines.append(self._bare[head] + b"".join(map(self._led.__getitem__, rest)))
        return self._break.join(lines)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if self._special is None or not any(t in text for t in self.special):
            return self._plain(text)
        out = []
        for k, part in enumerate(self._special.split(text)):
            out.append(np.array([self.special[part]], dtype="<u4").tobytes() if k % 2 else self._plain(part))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Text of packed ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
        known = map(self.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())
        return b"".join(known).decode("utf-8", errors="replace")


class _Words(dict):
    """Packed ids by space-separated word, with or without its leading space. A full one starts anew: frequent words
    are back soon, rare ones are not kept for good."""

    def __init__(self, vocabulary: Vocabulary, lead: str):
        super().__init__()
        self._vocabulary, self._lead = vocabulary, lead
        self._most = CACHED_WORDS if lead else CACHED_WORDS // 8

    def __missing__(self, word: str) -> bytes:
        known = self._vocabulary
        if word.isalpha():
            packed = known.letters(self._lead, word)
        elif (mark := known.marks.get(word[-1:])) is not None and word[:-1].isalpha():
            # Letters, and the marks after them, are pieces of their own; the letters are a word to keep.
            return self[word[:-1]] + mark
        elif (stem := word.rstrip(_MARKS)).isalpha():
            return self[stem] + known.piece(word[len(stem) :].encode())
        else:
            packed = known.pieces(self._lead + word)
        if len(word) <= SHORT_PIECE:
            if len(self) >= self._most:
                self.clear()
            self[word] = packed
        return packed


@kept(4)
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary, read once per worker."""
    return Vocabulary(path)


def bounded(rows: Iterator[tuple], schema: pa.Schema, size) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of about OUTPUT_BYTES."""
    held, used = [], 0
    for row in rows:
        held.append(row)
        used += size(row) + 64
        if used >= OUTPUT_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, used = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def encode_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids (binary: little-endian unsigned 32-bit integers) of every row."""
    schema = pa.schema([("key", pa.int64()), ("ids", pa.binary())])

    def encode(batches):
        words = vocabulary(path)
        rows = (
            (k.as_py(), words.encode(t.as_py() or ""))
            for b in batches for k, t in zip(b.column(0), b.column(1), strict=True)
        )
        yield from bounded(rows, schema, lambda r: len(r[1]))

    chosen = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return chosen.mapInArrow(given_back(encode, "vocabulary"), "key long, ids binary").withColumnRenamed("key", key)


def decode_documents(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key, ids, text of every encoded row."""
    schema = pa.schema([("key", pa.int64()), ("ids", pa.binary()), ("text", pa.string())])

    def decode(batches):
        words = vocabulary(path)
        rows = (
            (k.as_py(), i.as_py(), words.decode(i.as_py() or b""))
            for b in batches for k, i in zip(b.column(0), b.column(1), strict=True)
        )
        yield from bounded(rows, schema, lambda r: len(r[1] or b"") + len(r[2]))

    chosen = encoded.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    return chosen.mapInArrow(given_back(decode, "vocabulary"), "key long, ids binary, text string").withColumnsRenamed({"key": key, "ids": ids})


def round_trip_digests(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: every text encoded, then decoded from its ids."""
    back = decode_documents(encode_documents(docs, path), path)
    return back.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"),
        *(["ids"] if with_ids else []),
    )
