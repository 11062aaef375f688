"""Benchmark decontamination by latent semantic retrieval, with checks on the words.

1. Document frequencies of hashed words come from all documents. Benchmark items are cut into passages
   of PASSAGE words, each a TF-IDF vector over the hash buckets.
2. The benchmark is taken in blocks of about BLOCK passages, each with a latent space of its own, so a
   space has one dimension for every PER_DIMENSION passages however many there are. A randomised singular
   value decomposition of the block's matrix gives the space: every step multiplies a block of vectors by
   the matrix and its transpose, a part of the passages in each task; only the block itself meets on the driver.
3. Every document is read as overlapping windows of PASSAGE words. Their vectors are folded into each space
   and compared with its passages in matrix products, by the cosine inside the space.
4. Beside that, runs of words that stand in a document as in an item are looked up: the whole of an item of few
   words, else its pairs of neighbours. An item of n words of which `missing` are changed or left out keeps
   n - 1 - 2 * missing pairs at least; places where half of the pairs kept at MOST_OF_ITEM stand
   within the slack are candidates, so copies are found whatever the spaces hold.
5. Each candidate is checked against the whole item around it: the longest common subsequence of words
   must hold most of the item, or a good part of it together with the item's answer (its last
   sentence). Items of few words must occur as they stand.

The documents are read once for every SPACES blocks, so what travels to the tasks is bounded.

Results: null or empty texts match nothing; an item without words is never found. Words are compared
in lower case (A-Z), with ASCII marks as white space. Rows that share a doc_id give one result; a null doc_id
gives rows of its own. Repeated items are each found. Columns other than the ids and texts play no part.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.memory import given_back
from tributary.llm.words import Chunk, chunks, join_hashes
from tributary.session import write_and_reload

BUCKETS = 1 << 16
RANK = 128
PER_DIMENSION = 4
STEPS = 3
PASSAGE = 32
STRIDE = 16
COSINE = 0.65
MOST_OF_ITEM = 0.7
PART_OF_ITEM = 0.5
ANSWER_SHARE = 0.8
FEW_WORDS = 8
BLOCK = 512
SPACES = 4
SEED = 11
_PIECE = 1024


def frequencies(docs: DataFrame) -> np.ndarray:
    """Number of documents that hold a word of each bucket, and at the end the number of documents."""

    def count(batches):
        total = np.zeros(BUCKETS + 1, dtype=np.int64)
        for batch in batches:
            for c in chunks(batch.column(0), lower=True, plain=True):
                rows = len(c.offsets) - 1
                row = np.repeat(np.arange(rows), np.diff(c.offsets))
                held = np.unique(row * BUCKETS + (c.words % np.uint64(BUCKETS)).astype(np.int64))
                total[:-1] += np.bincount(held % BUCKETS, minlength=BUCKETS)
                total[-1] += rows
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], names=["bucket", "n"])

    out = np.zeros(BUCKETS + 1, dtype=np.int64)
    text = docs.select(F.col("text").cast("string").alias("text"))
    for r in text.mapInArrow(given_back(count), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def weights(found: np.ndarray) -> np.ndarray:
    return np.log((found[-1] + 1.0) / (found[:-1] + 1.0)).astype(np.float32) + np.float32(0.01)


def passages(benchmark: DataFrame) -> DataFrame:
    """item_id, first (word number), words (hashes) of the passage, item (all its words), answer_at."""

    def cut(batches):
        for batch in batches:
            last = [_answer_words(t.as_py() or "") for t in batch.column(1)]
            out = []
            for c in chunks(batch.column(1), lower=True, plain=True):
                for k, (a, b) in enumerate(zip(c.offsets[:-1].tolist(), c.offsets[1:].tolist(), strict=True)):
                    item = c.words[a:b].view(np.int64)
                    n = len(item)
                    answer_at = n - min(n, last[c.first + k])
                    for first in range(0, max(1, n - PASSAGE // 2), PASSAGE // 2):
                        first = max(0, min(first, n - PASSAGE))
                        if n:
                            out.append((batch.column(0)[c.first + k].as_py(), first, item[first : first + PASSAGE], item, answer_at))
            ids, firsts, words, items, answers = zip(*out, strict=True) if out else ((),) * 5
            of = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(firsts, pa.int32()), pa.array(words, of), pa.array(items, of), pa.array(answers, pa.int32())],
                names=["item_id", "first", "words", "item", "answer_at"],
            )

    chosen = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(given_back(cut), "item_id long, first int, words array<long>, item array<long>, answer_at int")


def _answer_words(text: str) -> int:
    """Words of the last sentence or line of an item."""
    sentences = [s for line in text.split("\n") for s in line.split(". ") if s.strip()]
    if not sentences:
        return 0
    return sum(len(c.words) for c in chunks(pa.array([sentences[-1]]), lower=True, plain=True))


def _vectors(words: list[np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and value of the unit TF-IDF vectors of some passages."""
    sizes = [len(w) for w in words]
    row = np.repeat(np.arange(len(words)), sizes)
    bucket = (np.concatenate(words).view(np.uint64) % np.uint64(BUCKETS)).astype(np.int64)
    cell, counts = np.unique(row * BUCKETS + bucket, return_counts=True)
    row, bucket = cell // BUCKETS, cell % BUCKETS
    value = counts * idf[bucket]
    norm = np.sqrt(np.bincount(row, value * value, minlength=len(words)))
    return row, bucket, (value / np.maximum(norm[row], 1e-9)).astype(np.float32)


def latent_space(cut: DataFrame, idf: np.ndarray, rank: int = RANK, steps: int = STEPS) -> np.ndarray:
    """BUCKETS x rank: an orthonormal basis near the leading right singular vectors of the passages.
    Only buckets that the passages use have values; only they travel."""
    context = cut.sparkSession.sparkContext
    used, rows = None, None

    def dense(used, rows) -> np.ndarray:
        if used is None:  # the random block to begin with, the same in every task
            return np.random.default_rng(SEED).standard_normal((BUCKETS, rank), dtype=np.float32)
        out = np.zeros((BUCKETS, rank), dtype=np.float32)
        out[used, : rows.shape[1]] = rows
        return out

    kinds = pa.schema([("piece", pa.int32()), ("buckets", pa.binary()), ("rows", pa.binary())])

    def total(batch: pa.Table) -> pa.Table:
        piece = batch.column("piece")[0].as_py()
        summed, seen = np.zeros((_PIECE, rank)), np.zeros(_PIECE, dtype=bool)
        for b, r in zip(batch.column("buckets"), batch.column("rows"), strict=True):
            own = np.frombuffer(b.as_buffer(), dtype=np.int32) - piece * _PIECE
            summed[own] += np.frombuffer(r.as_buffer(), dtype=np.float32).reshape(-1, rank)
            seen[own] = True
        own = np.flatnonzero(seen)
        packed = (own + piece * _PIECE).astype(np.int32).tobytes(), summed[own].astype(np.float32).tobytes()
        return pa.table({"piece": [piece], "buckets": [packed[0]], "rows": [packed[1]]}, schema=kinds)

    for _ in range(steps):
        shared = context.broadcast((used, rows, idf))

        def product(batches, shared=shared):
            *block, own = shared.value
            block = dense(*block)
            out, touched = np.zeros_like(block), np.zeros(BUCKETS, dtype=bool)
            for batch in batches:
                words = [np.asarray(w.values) for w in batch.column(0)]
                if words:
                    row, bucket, value = _vectors(words, own)
                    left = np.zeros((len(words), rank), dtype=np.float32)
                    np.add.at(left, row, block[bucket] * value[:, None])
                    np.add.at(out, bucket, left[row] * value[:, None])
                    touched[bucket] = True
            held = np.flatnonzero(touched)
            for piece in np.unique(held // _PIECE).tolist():
                part = held[held // _PIECE == piece]
                arrays = [pa.array([piece], pa.int32()), pa.array([part.astype(np.int32).tobytes()], pa.binary()), pa.array([out[part].tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, schema=kinds)

        moved = cut.select("words").mapInArrow(given_back(product), "piece int, buckets binary, rows binary")
        got = moved.groupBy("piece").applyInArrow(total, "piece int, buckets binary, rows binary").orderBy("piece").collect()
        if not got:
            return np.zeros((BUCKETS, rank), dtype=np.float32)
        used = np.concatenate([np.frombuffer(r.buckets, dtype=np.int32) for r in got])
        rows = np.concatenate([np.frombuffer(r.rows, dtype=np.float32).reshape(-1, rank) for r in got])
        rows = np.linalg.qr(rows)[0].astype(np.float32)
    return dense(used, rows)


class Runs(NamedTuple):
    """Hashes of the runs of `size` neighbouring words of items, in order, with the item and the place in it."""

    size: int
    hashes: np.ndarray
    item: np.ndarray
    at: np.ndarray


class Searched(NamedTuple):
    """A block of passages with their items, and their space; bounded by BLOCK, BUCKETS and the rank."""

    row_of: np.ndarray  # row of `fold` for every bucket and for the empty one; 0 where the space has none
    fold: np.ndarray  # basis rows times word weight, after a row of zeros
    latent: np.ndarray  # unit vectors of the passages
    first: np.ndarray
    item_of: np.ndarray  # index into items
    item_ids: list
    items: list[np.ndarray]
    answer_at: list[int]
    runs: list[Runs]  # of the items whose first passage is in the block
    needed: np.ndarray  # runs of an item that make a candidate


def needed_pairs(n: int) -> int:
    """Half of the pairs of neighbours that an item of n words keeps if MOST_OF_ITEM of its words stand; 1 at least."""
    missing = int((1 - MOST_OF_ITEM) * n + 1e-9)
    return max(1, (n - 1 - 2 * missing) // 2)


def _runs(items: list[np.ndarray], chosen: list[int]) -> list[Runs]:
    by_size: dict[int, list[int]] = {}
    for i in chosen:
        n = len(items[i])
        by_size.setdefault(n if n < FEW_WORDS else 2, []).append(i)
    out = []
    for size, own in sorted(by_size.items()):
        hashes = [join_hashes(items[i], size) for i in own]
        item = np.repeat(own, [len(h) for h in hashes])
        at = np.concatenate([np.arange(len(h)) for h in hashes])
        joined = np.concatenate(hashes)
        order = np.argsort(joined, kind="stable")
        out.append(Runs(size, joined[order], item[order], at[order]))
    return out


def searched(rows: list, basis: np.ndarray, idf: np.ndarray) -> Searched:
    row, bucket, value = _vectors([np.array(r.words, dtype=np.int64) for r in rows], idf)
    latent = np.zeros((len(rows), basis.shape[1]), dtype=np.float32)
    np.add.at(latent, row, basis[bucket] * value[:, None])
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
    numbers: dict = {}
    item_of = np.array([numbers.setdefault((r.item_id, tuple(r.item)), len(numbers)) for r in rows])
    answers = {(r.item_id, tuple(r.item)): r.answer_at for r in rows}
    items = [np.array(i, dtype=np.int64).view(np.uint64) for _, i in numbers]
    first = np.array([r.first for r in rows])
    held = np.flatnonzero(basis.any(axis=1))
    row_of = np.zeros(BUCKETS + 1, dtype=np.int32)
    row_of[held] = np.arange(1, len(held) + 1)
    fold = np.vstack([np.zeros((1, basis.shape[1]), dtype=np.float32), basis[held] * idf[held, None]])
    runs = _runs(items, np.unique(item_of[first == 0]).tolist())
    needed = np.array([1 if len(i) < FEW_WORDS else needed_pairs(len(i)) for i in items])
    return Searched(row_of, fold, latent, first, item_of, [i for i, _ in numbers], items, [answers[k] for k in numbers], runs, needed)


def common_subsequence(item: list, text: list) -> int:
    """Length of the longest common subsequence, by bits of one integer."""
    places: dict = {}
    for k, w in enumerate(item):
        places[w] = places.get(w, 0) | 1 << k
    full = (1 << len(item)) - 1
    v = full
    for w in text:
        u = v & places.get(w, 0)
        if u:
            v = ((v + u) | (v - u)) & full
    return len(item) - v.bit_count()


def _contains(item: list, text: list) -> bool:
    return any(text[k : k + len(item)] == item for k in range(len(text) - len(item) + 1))


def judged(item: np.ndarray, answer_at: int, region: np.ndarray) -> tuple[float, float] | None:
    """Shares of the item and of its answer found in a region, if they make it a match."""
    own, text = item.tolist(), region.tolist()
    there = set(text)
    # No common subsequence holds more than the item's words that the region has at all.
    if sum([w in there for w in own]) < PART_OF_ITEM * len(own):
        return None
    if len(own) < FEW_WORDS:
        return (1.0, 1.0) if _contains(own, text) else None
    share = common_subsequence(own, text) / len(own)
    if share < PART_OF_ITEM:
        return None
    answer = own[answer_at:]
    found = common_subsequence(answer, text) / len(answer) if answer else 0.0
    return (share, found) if share >= MOST_OF_ITEM or found >= ANSWER_SHARE else None


def _slack(size):
    """Words by which a copy may begin earlier or later, or be longer, than the item says."""
    return size // 4 + PASSAGE


def _standing(c: Chunk, s: Searched) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, item index and beginning of the places where enough runs of an item stand."""
    n, total = len(c.words), max(1, len(s.items))
    slack = _slack(np.array([len(i) for i in s.items]))
    far = n + max(map(len, s.items))  # an item may seem to begin before its text
    far += -far % STRIDE
    keys = [np.empty(0, dtype=np.int64)]
    for runs in s.runs:
        own = join_hashes(c.words, runs.size)
        low = np.searchsorted(runs.hashes, own)
        place = np.flatnonzero(runs.hashes[np.minimum(low, len(runs.hashes) - 1)] == own)
        row = np.searchsorted(c.offsets, place, side="right") - 1
        inside = place + runs.size <= c.offsets[row + 1]
        place, row = place[inside], row[inside]
        count = np.searchsorted(runs.hashes, own[place], side="right") - low[place]
        k = np.repeat(low[place] - np.cumsum(count) + count, count) + np.arange(count.sum())
        begins = np.repeat(place, count) - runs.at[k] + far - n
        keys.append((np.repeat(row, count) * total + runs.item[k]) * far + begins)
    key = np.sort(np.concatenate(keys))
    pair, begins = key // far, key % far - (far - n)
    item = pair % total
    last = np.arange(len(key)) + s.needed[item] - 1
    fits = last < len(key)
    last[~fits] = 0
    fits &= (pair[last] == pair) & (begins[last] - begins <= slack[item])
    chosen = np.flatnonzero(fits)
    # Beginnings within one stride have the same words around them, up to what the slack adds anyway.
    _, single = np.unique(key[chosen] // STRIDE, return_index=True) if len(chosen) else (None, chosen)
    chosen = chosen[single]
    return pair[chosen] // total, item[chosen], begins[chosen]


def matches(column: pa.Array, spaces: list[Searched]):
    """row, space, item index, share, answer share, cosine of every item found in the texts of a column."""
    for c in chunks(column, lower=True, plain=True):
        n = len(c.words)
        if not n:
            continue
        # Blocks of STRIDE words never span two texts; a window is some neighbouring blocks.
        sizes = np.diff(c.offsets)
        per_row = -(-sizes // STRIDE)
        row = np.repeat(np.arange(len(sizes)), per_row)
        begin = np.cumsum(per_row) - per_row
        start = c.offsets[:-1][row] + (np.arange(len(row)) - begin[row]) * STRIDE
        bucket = np.append((c.words % np.uint64(BUCKETS)).astype(np.int64), BUCKETS)
        place = start[:, None] + np.arange(STRIDE)
        place[place >= c.offsets[1:][row][:, None]] = n  # beyond the text: the empty bucket
        held = bucket[place]
        for number, s in enumerate(spaces):
            blocks = s.fold[s.row_of[held]].sum(axis=1)
            window = blocks.copy()
            for k in range(1, PASSAGE // STRIDE):
                same = row[k:] == row[:-k]
                window[:-k][same] += blocks[k:][same]
            inside = np.linalg.norm(window, axis=1)
            possible = np.flatnonzero(inside > 0)
            near = window[possible] @ s.latent.T
            at, which = np.nonzero(near >= (COSINE * inside[possible])[:, None])
            cosines = near[at, which] / inside[possible[at]]
            at = possible[at]
            seen = set()

            def region(r: int, item: int, begins: int, s=s, c=c) -> tuple[int, int]:
                size = len(s.items[item])
                return max(int(c.offsets[r]), begins - _slack(size)), min(int(c.offsets[r + 1]), begins + max(size, PASSAGE) + _slack(size))

            for k in np.argsort(-cosines, kind="stable").tolist():
                w, p = int(at[k]), int(which[k])
                r, item = int(row[w]), int(s.item_of[p])
                if (r, item) in seen:
                    continue
                a, b = region(r, item, int(start[w]) - int(s.first[p]))
                found = judged(s.items[item], s.answer_at[item], c.words[a:b])
                if found:
                    seen.add((r, item))
                    yield c.first + r, number, item, *found, float(cosines[k])
            for r, item, begins in zip(*(x.tolist() for x in _standing(c, s)), strict=True):
                if (r, item) in seen:
                    continue
                a, b = region(r, item, begins)
                found = judged(s.items[item], s.answer_at[item], c.words[a:b])
                if found:
                    seen.add((r, item))
                    around = np.flatnonzero((row == r) & (start + PASSAGE > a) & (start < b))
                    products = window[around] @ s.latent[s.item_of == item].T
                    cosine = (products / np.maximum(inside[around], 1e-9)[:, None]).max(initial=0.0)
                    yield c.first + r, number, item, *found, float(cosine)


def _blocks(docs: DataFrame, benchmark: DataFrame):
    """Broadcast groups of blocks of the benchmark's passages, each block in a latent space made for it."""
    idf = weights(frequencies(docs))
    cut = write_and_reload(passages(benchmark), "passages")
    parts = -(-cut.count() // BLOCK)
    numbered = cut.withColumn("part", F.pmod(F.xxhash64("item_id", "first", "words"), F.lit(max(1, parts))))
    for group in range(0, parts, SPACES):
        spaces = []
        for part in range(group, min(parts, group + SPACES)):
            own = numbered.where(F.col("part") == part)
            rows = own.orderBy("item_id", "first").collect()
            if rows:
                spaces.append(searched(rows, latent_space(own, idf, max(RANK, -(-len(rows) // PER_DIMENSION))), idf))
        if spaces:
            yield docs.sparkSession.sparkContext.broadcast(spaces)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, item_share, answer_share, cosine: every item found in a document, once."""
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kinds = "doc_id long, item_id long, item_share double, answer_share double, cosine double"
    found = docs.sparkSession.createDataFrame([], kinds)
    for shared in _blocks(docs, benchmark):

        def search(batches, shared=shared):
            for batch in batches:
                spaces = shared.value
                rows = [(batch.column(0)[r].as_py(), spaces[k].item_ids[i], a, b, c) for r, k, i, a, b, c in matches(batch.column(1), spaces)]
                if rows:
                    kind = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
                    arrays = [pa.array(v, t) for v, t in zip(zip(*rows, strict=True), kind, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "item_id", "item_share", "answer_share", "cosine"])

        found = found.union(chosen.mapInArrow(given_back(search), kinds))
    best = F.max(F.struct("item_share", "answer_share", "cosine")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all columns, in which no item is found."""
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").cast("string").alias("text"))
    kinds = held.schema
    for shared in _blocks(docs, benchmark):

        def keep(batches, shared=shared):
            for batch in batches:
                hit = {m[0] for m in matches(batch.column(1), shared.value)}
                yield batch.filter(pa.array([k not in hit for k in range(batch.num_rows)], pa.bool_())) if hit else batch

        held = held.mapInArrow(given_back(keep), kinds)
    return held.select("row.*")
