"""Token-id files: canonical Huffman codes of limited length from the counts of the whole corpus.

A file holds segments, each with whole documents in ascending key order:

    magic, counts of documents, tokens and payload bytes    5 little-endian 64-bit integers
    code length of every id                                 one byte each
    keys, null marks and token counts of the documents      8, 1 and 8 bytes each
    bit offset of every block of BLOCK ids                  8 bytes each
    the codes, most significant bit first

The code lengths fix the canonical code, so a segment can be read by itself. Blocks are independent:
a reader decodes all of them side by side, one table look-up per id, each from its own offset.

Results: a null or empty text has only the end id. Rows with a null key come first; repeated rows are
written each, side by side. An empty table gives no file and no row. Other columns play no part. A
document is never split over segments, so one segment is as large as the longest document at least.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tributary.llm.bpe import Vocabulary, byte_letters
from tributary.llm.memory import given_back, kept
from tributary.llm.shared_files import input_stream, new_file, output
from tributary.session import scratch_path

MAGIC = int.from_bytes(b"TOKENSEG", "little")
BLOCK = 256
LONGEST_CODE = 18
SEGMENT_TOKENS = 1 << 20
FILE_TOKENS = 64 << 20
OUTPUT_ROWS = 20_000


class LibraryVocabulary(Vocabulary):
    """Words by the tokenizers library: its model encodes every piece that is not kept yet."""

    def __init__(self, path: str):
        library = Tokenizer.from_file(path)
        self._model = library.model
        self._letters = {b: c for c, b in byte_letters().items()}
        self._space = self._letters[0x20]
        self._packed = [struct.pack("<I", i) for i in range(1 + max(library.get_vocab().values()))]
        super().__init__(path)

    def _tokens(self, letters: str) -> bytes:
        packed = self._packed
        return b"".join([packed[t.id] for t in self._model.tokenize(letters)])

    def packed(self, piece: bytes) -> bytes:
        return self._tokens(piece.decode("latin-1").translate(self._letters))

    def letters(self, lead: str, word: str) -> bytes:
        # ASCII letters stand for themselves, a leading space does not.
        return self._tokens(self._space + word if lead else word) if word.isascii() else super().letters(lead, word)


@kept(2)
def library_vocabulary(path: str) -> LibraryVocabulary:
    return LibraryVocabulary(path)


def code_lengths(counts: np.ndarray, longest: int = LONGEST_CODE) -> np.ndarray:
    """Best code length of every id with a count (package-merge); 0 for the others."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << longest:
        raise ValueError(f"{len(used)} ids do not fit codes of {longest} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    levels, items = [], weights
    is_leaf = np.ones(len(weights), dtype=bool)
    for _ in range(longest):
        levels.append(is_leaf)
        packages = items[: len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weights, packages])
        by = np.argsort(both, kind="stable")
        items, is_leaf = both[by], by < len(weights)
    take = 2 * len(order) - 2
    for is_leaf in reversed(levels):
        leaves = int(is_leaf[:take].sum())
        lengths[order[:leaves]] += 1
        take = 2 * (take - leaves)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Code of every id: by length, then by id."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    codes = np.zeros(len(lengths), dtype=np.uint64)
    code, before = 0, 0
    firsts = np.searchsorted(lengths[order], np.arange(1, int(lengths.max(initial=0)) + 2))
    for length in range(1, int(lengths.max(initial=0)) + 1):
        code <<= length - before
        own = order[firsts[length - 1] : firsts[length]]
        codes[own] = code + np.arange(len(own), dtype=np.uint64)
        code, before = code + len(own), length
    return codes


def pack(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Bit offsets of the blocks, and the codes of the ids one after the other."""
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    starts = ends - size
    total = int(ends[-1]) if len(ids) else 0
    out = np.zeros(total // 32 + 2, dtype=np.uint64)
    if len(ids):
        word = starts >> 5
        placed = codes[ids] << (64 - size - (starts & 31)).astype(np.uint64)
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        at = word[first]
        out[at] += np.add.reduceat(placed >> np.uint64(32), first)
        out[at + 1] += np.add.reduceat(placed & np.uint64(0xFFFFFFFF), first)
    return starts[::BLOCK].astype("<u8"), out.astype(">u4").tobytes()[: (total + 7) // 8]


def decoding_table(lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """For every value of the next `width` bits: the id times 32, plus its code length."""
    width = max(1, int(lengths.max(initial=0)))
    codes = canonical_codes(lengths)
    table = np.zeros(1 << width, dtype=np.int64)
    order = np.lexsort((codes, lengths))
    order = order[lengths[order] > 0]
    spans = 1 << (width - lengths[order].astype(np.int64))
    filled = np.repeat(order * 32 + lengths[order], spans)
    table[: len(filled)] = filled
    return table, width


def unpack(payload: bytes, offsets: np.ndarray, n: int, table: np.ndarray, width: int) -> np.ndarray:
    """The n ids of all blocks, decoded side by side."""
    data = np.frombuffer(payload + b"\0" * 8, dtype=np.uint8).astype(np.int64)
    window = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
    out = np.zeros((len(offsets), BLOCK), dtype=np.int64)
    at = offsets.astype(np.int64)
    mask, drop = (1 << width) - 1, 32 - width
    tail = n - (len(offsets) - 1) * BLOCK
    for k in range(BLOCK if len(offsets) > 1 else tail):
        if k == tail and len(offsets) > 1:
            at = at[:-1]
        found = table[(window[at >> 3] >> (drop - (at & 7))) & mask]
        out[: len(at), k] = found >> 5
        at = at + (found & 31)
    return out.ravel()[:n]


def segment(keys: list, counts: np.ndarray, ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> bytes:
    offsets, payload = pack(ids, lengths, codes)
    numbers = np.array([k or 0 for k in keys], dtype="<i8")
    missing = bytes(k is None for k in keys)
    head = np.array([MAGIC, len(keys), len(ids), len(lengths), len(payload)], dtype="<u8")
    parts = [head, lengths.astype(np.uint8), numbers, missing, counts.astype("<u8"), offsets, payload]
    return b"".join(p if isinstance(p, bytes) else p.tobytes() for p in parts)


def read_segments(stream):
    """keys, counts, ids of every segment of a file."""
    last, table, width = None, None, 0
    while head := stream.read(40):
        magic, docs, tokens, letters, size = (int(x) for x in np.frombuffer(head, dtype="<u8"))
        if magic != MAGIC:
            raise ValueError("this is no token file")
        raw = stream.read(letters)
        if raw != last:
            last = raw
            table, width = decoding_table(np.frombuffer(raw, dtype=np.uint8))
        numbers = np.frombuffer(stream.read(8 * docs), dtype="<i8").tolist()
        missing = stream.read(docs)
        counts = np.frombuffer(stream.read(8 * docs), dtype="<u8").astype(np.int64)
        offsets = np.frombuffer(stream.read(8 * -(-tokens // BLOCK)), dtype="<u8")
        payload = stream.read(size)
        if len(payload) != size:
            raise ValueError("the file ends inside a segment")
        yield [None if m else k for k, m in zip(numbers, missing, strict=True)], counts, unpack(payload, offsets, tokens, table, width)


def _arrays(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def ordered_ids(docs: DataFrame, path: str, end_id: int, key: str, text: str) -> DataFrame:
    """part, row, key, ids: encoded documents, written in ascending key order. Rows of a part are
    numbered in that order, and parts follow each other."""
    from pyspark import TaskContext

    schema = pa.schema([("part", pa.int32()), ("row", pa.int64()), ("key", pa.int64()), ("ids", pa.binary())])

    def encode(batches):
        words, part, row = library_vocabulary(path), TaskContext.get().partitionId(), 0
        kind = "<u2" if max(words.size, end_id + 1) <= 1 << 16 else "<u4"
        end = np.array([end_id], dtype=kind).tobytes()
        held, used = [], 0
        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.frombuffer(words.encode(t or ""), dtype="<u4").astype(kind).tobytes() + end
                held.append((part, row, k, ids))
                row, used = row + 1, used + len(ids)
                if used >= 8 << 20:
                    yield _arrays(schema, held)
                    held, used = [], 0
        if held:
            yield _arrays(schema, held)

    spark = docs.sparkSession
    chosen = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    encoded = chosen.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(given_back(encode, "library_vocabulary"), "part int, row long, key long, ids binary")
    place = scratch_path(spark, "ids")
    encoded.write.option("compression", "zstd").parquet(place)
    return spark.read.schema(encoded.schema).parquet(place)


def id_counts(encoded: DataFrame, size: int, kind: str) -> np.ndarray:
    """How often each id occurs in all documents: one row per id and task, then one per id."""
    schema = pa.schema([("id", pa.int32()), ("n", pa.int64())])

    def count(batches):
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            column = batch.column(0)
            _, offsets, data = column.buffers()
            bounds = np.frombuffer(offsets, dtype=np.int32)[column.offset : column.offset + len(column) + 1]
            total += np.bincount(np.frombuffer(data or b"", dtype=np.uint8)[bounds[0] : bounds[-1]].view(kind), minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], schema=schema)

    counts = np.zeros(size, dtype=np.int64)
    # At most one row per id of the vocabulary.
    for r in encoded.select("ids").mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[r.id] = r.n
    return counts


def write_files(encoded: DataFrame, lengths: np.ndarray, kind: str, folder: str) -> DataFrame:
    """path, part, row, tokens of the files written: each holds neighbouring rows of one part."""
    schema = pa.schema([("path", pa.string()), ("part", pa.int32()), ("row", pa.int64()), ("tokens", pa.int64())])
    codes = canonical_codes(lengths)

    def write(batches):
        done, out, last, keys, ids = [], None, None, [], []
        pending = 0

        def flush():
            nonlocal pending
            if keys:
                out.write(segment(keys, np.array([len(x) for x in ids]), np.concatenate(ids), lengths, codes))
                keys.clear(), ids.clear()
            pending = 0

        for batch in batches:
            for part, row, key, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None or last != (part, row - 1) or done[-1][3] >= FILE_TOKENS:
                    if out is not None:
                        flush()
                        out.close()
                    path = new_file(folder, ".tok")
                    out = output(path)
                    done.append([path, part, row, 0])
                last = (part, row)
                keys.append(key)
                ids.append(np.frombuffer(data, dtype=kind))
                pending += len(ids[-1])
                done[-1][3] += len(ids[-1])
                if pending >= SEGMENT_TOKENS:
                    flush()
        if out is not None:
            flush()
            out.close()
            yield _arrays(schema, [tuple(x) for x in done])

    spark = encoded.sparkSession
    files = encoded.select("part", "row", "key", "ids").mapInArrow(write, "path string, part int, row long, tokens long")
    place = scratch_path(spark, "token-files")
    files.write.parquet(place)
    return spark.read.schema(files.schema).parquet(place)


def with_starts(files: DataFrame) -> DataFrame:
    """path, start: ids in all files before. One row per file of FILE_TOKENS ids, so the ordered sum
    over them stays small even where the ids do not."""
    before = Window.orderBy("part", "row").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("path", F.coalesce(F.sum("tokens").over(before), F.lit(0)).cast("long").alias("start"))


def read_files(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids (packed) from the files in the columns path, start."""
    return _read(files, lambda ids: ids.astype("<u4").tobytes(), pa.binary(), "ids binary")


def read_digests(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 from the files in the columns path, start."""
    return _read(files, lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), pa.int64(), "ids_crc32 long")


def _read(files: DataFrame, of, kind: pa.DataType, column: str) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), (column.split()[0], kind)])

    def read(batches):
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with input_stream(path) as stream:
                    for keys, counts, ids in read_segments(stream):
                        ends = np.cumsum(counts)
                        begins = ends - counts
                        for a in range(0, len(keys), OUTPUT_ROWS):
                            b = min(a + OUTPUT_ROWS, len(keys))
                            values = [of(ids[begins[k] : ends[k]]) for k in range(a, b)]
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(keys[a:b], pa.int64()), pa.array(begins[a:b] + start), pa.array(counts[a:b]), pa.array(values, kind)],
                                schema=schema,
                            )
                        start += int(ends[-1]) if len(ends) else 0

    return files.select("path", "start").mapInArrow(read, f"doc_id long, start long, n_tokens long, {column}")


def write_token_files(docs: DataFrame, path: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode all documents and write them; returns path, start of every file."""
    size = max(Vocabulary(path).size, end_id + 1)
    kind = "<u2" if size <= 1 << 16 else "<u4"
    encoded = ordered_ids(docs, path, end_id, key, text)
    lengths = code_lengths(id_counts(encoded, size, kind))
    return with_starts(write_files(encoded, lengths, kind, scratch_path(docs.sparkSession, "tokens")))


def token_file_digests(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 as read back from the files."""
    files = write_token_files(docs, path, end_id)
    return read_digests(files.repartition(max(1, files.count())))
