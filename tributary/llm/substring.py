"""Repeated passages: windows of words that documents share, found level by level.

A window of `length` words can only repeat if the windows of half its length inside it repeat. The
first level looks at half-length windows, and of those only at anchors: the ones with the least hash
inside some full window. Equal full windows have equal anchors, so nothing is lost while most
positions are never shuffled. Anchors that occur in one document alone end there; around the others
windows are extended to twice the length (to `length`, two overlapping halves), and again only those
that repeat survive. That is one doubling: longer windows would remove no further word.

A window is removed from a document if it also starts in a document with a smaller id. Windows are
judged on the input. For each hash, the smallest id is found by a map-side aggregate and written, if several
documents hold it. The join back to the occurrences does not shuffle those of hot hashes: at most `HOT` hashes
can each hold a `HOT`-th of the occurrences or more, so that these are broadcast; the others are joined by hash.

Results: a null or empty text has no words; a null doc_id neither removes words nor loses any. Rows
that share a doc_id do not remove each other's words; each is judged by its own text. Texts are
handled whole. Columns other than doc_id and text play no part, and are kept by deduplicated().
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.memory import given_back
from tributary.llm.steps import Steps
from tributary.llm.words import Chunk, chunks, join_hashes, mix

LENGTH = 13
HOT = 1000
_ROWS = "hash long, doc_id long, at long"
_U = np.uint64


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, tag, text: the tag tells rows with the same doc_id and another text apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    tag = F.xxhash64(text).bitwiseAND((1 << 31) - 1)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), tag.alias("tag"), text.alias("text"))


class Windows:
    """Half and full windows of some documents, at the positions of a chunk's words."""

    def __init__(self, chunk: Chunk, length: int):
        half = (length + 1) // 2
        inside = length - half
        n = len(chunk.words)
        ends = np.repeat(chunk.offsets[1:], np.diff(chunk.offsets))
        self.valid = np.flatnonzero(np.arange(n) + length <= ends)
        halves = join_hashes(chunk.words, half)
        halves[halves == 0] = 1
        self.halves = np.zeros(n, dtype=_U)
        self.halves[: len(halves)] = halves
        # The least half inside each full window; 0 where no full window starts.
        least = np.zeros(n, dtype=_U)
        if len(self.valid):
            running = self.halves.copy()
            for k in range(1, inside + 1):
                np.minimum(running[:-k], self.halves[k:], out=running[:-k])
            least[self.valid] = running[self.valid]
        self.least, self.inside = least, inside

    def anchors(self) -> np.ndarray:
        """Positions of halves that are the least of a full window around them."""
        widest = self.least.copy()
        for k in range(1, self.inside + 1):
            np.maximum(widest[k:], self.least[:-k], out=widest[k:])
        return np.flatnonzero((widest == self.halves) & (widest > 0))

    def around(self, hits: np.ndarray) -> np.ndarray:
        """Starts of the full windows whose least half is at one of the hits."""
        hit = np.zeros(len(self.halves), dtype=bool)
        hit[hits] = True
        found = np.zeros(len(self.halves), dtype=bool)
        for k in range(self.inside + 1):
            there = found[: len(hit) - k] if k else found
            there |= hit[k:] & (self.halves[k:] == self.least[: len(hit) - k])
        return np.flatnonzero(found & (self.least > 0))

    def full(self, starts: np.ndarray) -> np.ndarray:
        """Hashes of the full windows: both overlapping halves together."""
        return mix(self.halves[starts] * _U(0xC2B2AE3D27D4EB4F) + mix(self.halves[starts + self.inside]))


def _rows(hashes: np.ndarray, docs: np.ndarray, at: np.ndarray, kinds: tuple[str, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(docs), pa.array(at)], names=list(kinds))


def _places(chunk: Chunk, positions: np.ndarray, ids: np.ndarray, tags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document ids and places (tag and word number in one long) of positions in a chunk."""
    row = np.searchsorted(chunk.offsets, positions, side="right") - 1
    return ids[chunk.first + row], (tags[chunk.first + row] << 32) | (positions - chunk.offsets[row])


def anchors(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """hash, doc_id, at of the anchors of all documents."""

    def find(batches):
        for batch in batches:
            ids, tags = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for chunk in chunks(batch.column(2), lower=False):
                w = Windows(chunk, length)
                positions = w.anchors()
                yield _rows(w.halves[positions], *_places(chunk, positions, ids, tags), ("hash", "doc_id", "at"))

    return _keyed(docs).where("doc_id IS NOT NULL").mapInArrow(given_back(find), _ROWS)


def _per_document(rows: DataFrame) -> DataFrame:
    """doc_id, tag, places: word numbers of one document, so bounded by its length."""
    split = rows.select("doc_id", F.shiftright("at", 32).alias("tag"), F.col("at").bitwiseAND(0xFFFFFFFF).cast("int").alias("place"))
    return split.groupBy(F.col("doc_id").alias("hit_id"), F.col("tag").alias("hit_tag")).agg(F.collect_list("place").alias("places"))


def _joined(docs: DataFrame, hits: DataFrame, how: str) -> DataFrame:
    same = (F.col("doc_id") == F.col("hit_id")) & (F.col("tag") == F.col("hit_tag"))
    return docs.join(hits, same, how).drop("hit_id", "hit_tag")


def shared_hashes(rows: DataFrame) -> DataFrame:
    """hash, least_id, n of the hashes that occur in several documents: the smallest id, and how many rows."""
    by_hash = rows.groupBy("hash").agg(F.min("doc_id").alias("least_id"), F.max("doc_id").alias("last_id"), F.count("*").alias("n"))
    return by_hash.where("least_id < last_id").select("hash", "least_id", "n")


def repeated(rows: DataFrame, shared: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, at, least_id of the rows whose hash is shared; `shared` is read twice, so it has to be written."""
    total = shared.agg(F.sum("n")).first()[0] or 0
    # No more than `hot` hashes can have so many rows each.
    often = F.col("n") * hot >= total
    few = F.broadcast(shared.where(often).select("hash", "least_id"))
    rest = rows.join(few.select("hash"), "hash", "left_anti").join(shared.where(~often).select("hash", "least_id"), "hash")
    return rows.join(few, "hash").unionByName(rest).select("doc_id", "at", "least_id")


def extended(docs: DataFrame, hits: DataFrame, length: int = LENGTH) -> DataFrame:
    """hash, doc_id, at of the full windows whose least half is a hit."""

    def extend(batches):
        for batch in batches:
            ids, tags = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            places = batch.column(3)
            bounds = places.offsets.to_numpy()
            flat = places.values.to_numpy(zero_copy_only=False)
            for chunk in chunks(batch.column(2), lower=False):
                first, rows = chunk.first, len(chunk.offsets) - 1
                own = flat[bounds[first] : bounds[first + rows]].astype(np.int64)
                own += np.repeat(chunk.offsets[:-1], np.diff(bounds[first : first + rows + 1]))
                w = Windows(chunk, length)
                starts = w.around(own)
                yield _rows(w.full(starts), *_places(chunk, starts, ids, tags), ("hash", "doc_id", "at"))

    keyed = _keyed(docs).where("doc_id IS NOT NULL")
    return _joined(keyed, _per_document(hits), "inner").select("doc_id", "tag", "text", "places").mapInArrow(given_back(extend), _ROWS)


def removed_windows(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """hit_id, hit_tag, places of the windows that also start in a document with a smaller id."""
    if length < 2:
        raise ValueError("a window has at least two words")
    steps = Steps(docs.sparkSession)
    found = steps.keep(anchors(docs, length), "anchors")
    shared = steps.keep(shared_hashes(found), "shared")
    steps.drop()
    hits = steps.keep(repeated(found, shared).select("doc_id", "at"), "hits")
    steps.drop("anchors", "shared")
    windows = steps.keep(extended(docs, hits, length), "windows")
    steps.drop("hits")
    shared = steps.keep(shared_hashes(windows), "shared")
    steps.drop()
    late = steps.keep(repeated(windows, shared).where("doc_id > least_id").select("doc_id", "at"), "late")
    steps.drop("windows", "shared")
    removed = steps.keep(_per_document(late), "removed")
    steps.drop("late")
    return removed


def _cut(text: str, places: list[int] | None, length: int) -> tuple[int, list[bytes]]:
    """Number of words of a text, and the words that no window covers."""
    words = text.encode().split()
    if not places:
        return len(words), words
    depth = np.zeros(len(words) + 1, dtype=np.int64)
    starts = np.unique(np.array(places, dtype=np.int64))
    np.add.at(depth, starts, 1)
    np.add.at(depth, starts + length, -1)
    keep = np.flatnonzero(np.cumsum(depth[:-1]) == 0)
    return len(words), [words[k] for k in keep.tolist()]


def removal_digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row."""

    def digest(batches):
        for batch in batches:
            out = []
            for text, places in zip(batch.column(1), batch.column(2), strict=True):
                n, kept = _cut(text.as_py(), places.as_py(), length)
                out.append((n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            n, removed, digests = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    rows = _joined(_keyed(docs), removed_windows(docs, length), "left").select("doc_id", "text", "places")
    return rows.mapInArrow(given_back(digest), "doc_id long, n_words long, n_removed long, kept_sha256 string")


def deduplicated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents with their repeated words cut out, all columns kept. A text that loses no word
    stays as it is, another becomes its kept words, joined by spaces; n_chars, if there, follows the
    text, and a document that loses every word goes."""

    def cut(batches):
        for batch in batches:
            texts = []
            for text, places in zip(batch.column(1), batch.column(2), strict=True):
                texts.append(None if not places.is_valid else b" ".join(_cut(text.as_py(), places.as_py(), length)[1]).decode())
            arrays = [batch.column(0), batch.column(1), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "text", "cut"])

    names = docs.columns
    row = F.struct(*[F.col(f"`{c}`") for c in names if c != "text"])
    text = F.col("text").cast("string")
    tag = F.xxhash64(F.coalesce(text, F.lit(""))).bitwiseAND((1 << 31) - 1)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), tag.alias("tag"), row.alias("row"), text.alias("text"))
    joined = _joined(keyed, removed_windows(docs, length), "left").select("row", "text", "places")
    kinds = f"row {joined.schema['row'].dataType.simpleString()}, text string, cut string"
    done = joined.mapInArrow(given_back(cut), kinds).where("cut IS NULL OR cut <> ''")
    now = F.coalesce("cut", "text")
    columns = []
    for c in names:
        kept = F.col("row").getField(c) if c != "text" else now
        if c == "n_chars":
            kept = F.when(F.col("cut").isNotNull(), F.length("cut").cast(docs.schema[c].dataType)).otherwise(kept)
        columns.append(kept.alias(c))
    return done.select(*columns)
