"""Tokens of two tokenizers over the same texts: the smallest groups of tokens that cover the same bytes, and
how often the ids of a group meet in the corpus.

Where a token of each tokenizer ends at the same byte, a group ends. The ends of both are compared as two
arrays at the present shift of their indices: from a common end on, stretches of doubling length are compared
at once while they agree, then halving ones, so one-to-one stretches are jumped. Where the arrays part, the
smaller end moves on until they meet again; this group changes the shift.

All pairs of ids of a group are links. How many documents hold a pair linked is counted over the whole
corpus: each document's pairs are stored once, counted in their tasks and then by pair. The most frequent
pairs, at most HEAD, go to the tasks that add up each document's links; all other pairs are joined. Which
pairs are looked up which way changes no result.

Results: null and empty texts have no tokens; nor has a text whose tokens, joined, are not a space and the
text (white space that a tokenizer turns into a space, for example). Strings of special tokens inside a text
are text. Repeated rows count as documents of their own. An empty table has no rows. Texts of any length are
handled whole. Other columns play no part, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tributary.llm.bpe import PATTERN, byte_letters
from tributary.llm.steps import Steps

SLICE_BYTES = 1 << 20
# Pairs that travel to the tasks: 17 bytes each.
HEAD = 1 << 18
COUNTED = 1 << 22
EMITTED = 1 << 16
# A group with more pairs than this is counted by its distinct ids.
WIDE_GROUP = 1 << 12

_ITEM = 4
# The quicker library refuses long runs of white space; both give the same ids.
_LONG_SPACE = re.compile(r"\s{256}")


# --- Tokenizers -----------------------------------------------------------------------------------

class ByteLevel:
    """A byte-level BPE file: ids of texts, and the bytes of each id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"]["type"] != "BPE" or spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("a byte-level BPE file without normalizer and prefix space is needed")
        model = spec["model"]
        letters = byte_letters()
        known = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if all(c in letters for c in t)}
        self.bytes_of = [b""] * (1 + max(model["vocab"].values()))
        for token, i in known.items():
            self.bytes_of[i] = token
        self._library = Tokenizer.from_file(path)
        self._library.encode_special_tokens = True
        self._library.no_truncation()
        self._library.no_padding()
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        # Ranks may stand in for the merges if both are in the same order.
        ranks = {t: i for t, i in known.items() if len(t) == 1} | {self.bytes_of[i]: i for i in merged}
        self._quick = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) if merged == sorted(merged) and min(merged) > 255 else None

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self._quick and not any(map(_LONG_SPACE.search, texts)):
            return [self._quick.encode_to_numpy(t) for t in texts]
        return [np.array(self._library.encode(t, add_special_tokens=False).ids, dtype=np.uint32) for t in texts]


class Pieces:
    """A SentencePiece file, which puts a space before each text itself."""

    def __init__(self, path: str):
        self._library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes_of = []
        for i in range(self._library.vocab_size()):
            piece = self._library.id_to_piece(i)
            if self._library.is_byte(i):
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            else:
                self.bytes_of.append(piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._library.encode(texts, num_threads=1)


class Sides:
    """Both tokenizers, with the lengths and decimal forms of their ids."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.length_a, self.length_b = (np.array([len(t) for t in side.bytes_of], dtype="<u4") for side in (self.a, self.b))
        # Decimal ids with what follows them: another token of the side, or the other side (a) or group (b).
        self.shown_a, self.shown_b = (np.array([[f"{i}{mark}" for i in range(len(side.bytes_of))] for mark in marks], dtype=object) for side, marks in ((self.a, ",|"), (self.b, ",;")))
        self.bits = max(1, (len(self.b.bytes_of) - 1).bit_length())

    def tokens(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of both sides; none where either does not cover the space and the text. The byte-level side
        never changes a byte, so its length tells."""
        led = [" " + (t or "") for t in texts]
        for text, a, b in zip(led, self.a.encode(led), self.b.encode([t[1:] for t in led]), strict=True):
            raw = text.encode()
            same = len(text) > 1 and self.length_a[a].sum() == len(raw) and b"".join(map(self.b.bytes_of.__getitem__, b)) == raw
            yield (a, np.array(b, dtype=np.uint32)) if same else (a[:0], a[:0])


@lru_cache(maxsize=2)
def sides(path_a: str, path_b: str) -> Sides:
    """Both tokenizers, read once per worker."""
    return Sides(path_a, path_b)


# --- One text ---------------------------------------------------------------------------------------

def groups_apart(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """The groups that are not one-to-one, in order: a row (from, to) of a, (from, to) of b for each. Both arrays
    of unsigned 32-bit ends ascend to the same last end."""
    raw_a, raw_b = ends_a.tobytes(), ends_b.tobytes()
    list_a, list_b = ends_a.tolist(), ends_b.tolist()
    size_a, size_b, out = len(raw_a), len(raw_b), []
    p = q = 0  # places in the raw arrays
    while p < size_a:
        probe = _ITEM
        while p < size_a and raw_a[p : p + probe] == raw_b[q : q + probe]:
            p, q, probe = p + probe, q + probe, probe * 2
        while probe > _ITEM:
            probe //= 2
            if p + probe <= size_a and q + probe <= size_b and raw_a[p : p + probe] == raw_b[q : q + probe]:
                p, q = p + probe, q + probe
        if p >= size_a:
            break
        i, j = p // _ITEM, q // _ITEM
        out += (i, j)
        x, y = list_a[i], list_b[j]
        while x != y:
            if x < y:
                i += 1
                x = list_a[i]
            else:
                j += 1
                y = list_b[j]
        out += (i + 1, j + 1)
        p, q = (i + 1) * _ITEM, (j + 1) * _ITEM
    return np.array(out, dtype=np.int64).reshape(-1, 4)[:, [0, 2, 1, 3]]


def group_numbers(n: int, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The group of each of n tokens, where the tokens first..end-1 form one group and all others one each."""
    inside = np.zeros(n + 1, dtype=np.int64)
    inside[first] += 1
    inside[end] -= 1
    starts = np.cumsum(inside[:n]) == 0
    starts[first] = True
    return np.cumsum(starts) - 1


class Slice:
    """Texts of a bounded number of bytes, aligned together: a text's last end is common to both sides, so no
    group spans two texts. `rows` has a text's counts and digest, `pairs` its pairs and their links."""

    def __init__(self, both: Sides, texts: list[str | None]):
        found = list(both.tokens(texts))
        self._bits = both.bits
        count_a, count_b = (np.array([len(x[k]) for x in found]) for k in (0, 1))
        ids_a, ids_b = (np.concatenate([x[k] for x in found]).astype(np.int64) for k in (0, 1))
        apart = groups_apart(np.cumsum(both.length_a[ids_a], dtype="<u4"), np.cumsum(both.length_b[ids_b], dtype="<u4"))
        group_a, group_b = group_numbers(len(ids_a), apart[:, 0], apart[:, 1]), group_numbers(len(ids_b), apart[:, 2], apart[:, 3])
        size_a, size_b = np.bincount(group_a), np.bincount(group_b)
        text_a = np.repeat(np.arange(len(found)), count_a)
        owner = text_a[np.cumsum(size_a) - size_a]  # of each group
        n_groups = np.bincount(owner, minlength=len(found))
        n_links = np.bincount(owner, weights=size_a * size_b, minlength=len(found)).astype(np.int64)
        shown = self._shown(both, ids_a, ids_b, group_a, group_b, size_a, size_b)
        ends = np.cumsum(count_a + count_b).tolist()
        digests = [hashlib.sha256("".join(shown[x:y])[:-1].encode()).hexdigest() if y > x else "" for x, y in zip([0, *ends], ends, strict=False)]
        self.rows = list(zip(count_a.tolist(), count_b.tolist(), n_groups.tolist(), n_links.tolist(), digests, strict=True))
        self.pairs = self._pairs(ids_a, ids_b, group_a, group_b, size_a, size_b, owner)

    @staticmethod
    def _shown(both, ids_a, ids_b, group_a, group_b, size_a, size_b) -> list[str]:
        """The decimal ids in the order of the groups, each group's a before its b, with their marks."""
        ends_a, ends_b = np.cumsum(size_a), np.cumsum(size_b)
        last_a, last_b = np.zeros(len(ids_a), dtype=np.int64), np.zeros(len(ids_b), dtype=np.int64)
        last_a[ends_a - 1] = 1
        last_b[ends_b - 1] = 1
        out = np.empty(len(ids_a) + len(ids_b), dtype=object)
        out[np.arange(len(ids_a)) + (ends_b - size_b)[group_a]] = both.shown_a[last_a, ids_a]
        out[np.arange(len(ids_b)) + ends_a[group_b]] = both.shown_b[last_b, ids_b]
        return out.tolist()

    def _pairs(self, a, b, group_a, group_b, m, n, owner) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text its pairs, ascending, and how many links are of each."""
        wide = np.flatnonzero(m * n > WIDE_GROUP)
        first_a, first_b = np.cumsum(m) - m, np.cumsum(n) - n
        times = n.copy()
        times[wide] = 0
        times = times[group_a]  # links of each token of a
        within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        parts = [(np.repeat(owner[group_a], times), np.repeat(a, times) << self._bits | b[np.repeat(first_b[group_a], times) + within], np.ones(len(within), dtype=np.int64))]
        for g in wide.tolist():
            (ua, ca), (ub, cb) = (np.unique(x[f : f + k], return_counts=True) for x, f, k in ((a, first_a[g], m[g]), (b, first_b[g], n[g])))
            parts.append((np.full(len(ua) * len(ub), owner[g]), (ua[:, None] << self._bits | ub).ravel(), (ca[:, None] * cb).ravel()))
        text, pair, links = (np.concatenate(x) for x in zip(*parts, strict=True))
        # A pair has 32 bits, the number of a text in its slice the ones above.
        place = text << 32 | pair
        order = np.argsort(place, kind="stable")
        place = place[order]
        new = np.flatnonzero(np.r_[True, place[1:] != place[:-1]][: len(place)])
        sums = np.add.reduceat(links[order], new) if len(new) else links
        place = place[new]
        bounds = np.searchsorted(place, np.arange(len(self.rows) + 1) << 32)
        place &= (1 << 32) - 1
        return [(place[x:y], sums[x:y]) for x, y in zip(bounds, bounds[1:], strict=False)]


def _slices(both: Sides, batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, Slice]]:
    texts, first, used = [], 0, 0
    for k, text in enumerate(batch.column(column)):
        texts.append(text.as_py())
        used += len(texts[-1] or "")
        if used >= SLICE_BYTES:
            yield first, Slice(both, texts)
            texts, first, used = [], k + 1, 0
    if texts:
        yield first, Slice(both, texts)


# --- The corpus -------------------------------------------------------------------------------------

def _aligned(docs: DataFrame, path_a: str, path_b: str, key: str, text: str) -> DataFrame:
    """row, key, counts, digest of the groups, pairs (differences) and links of each, of every text."""
    schema = pa.schema([
        ("row", pa.int64()), ("key", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
        ("groups_sha256", pa.string()), ("pairs", pa.binary()), ("links", pa.binary()),
    ])

    def align(batches):
        both = sides(path_a, path_b)
        for batch in batches:
            for first, part in _slices(both, batch, 2):
                n = len(part.rows)
                packed = [np.diff(p, prepend=0).astype("<u4").tobytes() for p, _ in part.pairs]
                counted = zip(*part.rows, strict=True)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[first : first + n], batch.column(1)[first : first + n],
                    *(pa.array(c, f.type) for c, f in zip(counted, list(schema)[2:7], strict=True)),
                    pa.array(packed, pa.binary()), pa.array([c.astype("<u4").tobytes() for _, c in part.pairs], pa.binary()),
                ], schema=schema)

    chosen = docs.select(F.monotonically_increasing_id().alias("row"), docs[key].cast("long").alias("key"), docs[text].cast("string").alias("text"))
    return chosen.mapInArrow(align, "row long, key long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, links binary")


def _parts(batches, column: int) -> Iterator[pa.RecordBatch]:
    """Some rows at a time, by the size of their pairs."""
    for batch in batches:
        sizes = np.cumsum([len(p.as_py()) for p in batch.column(column)])
        first = 0
        while first < batch.num_rows:
            before = sizes[first - 1] if first else 0
            end = max(first + 1, int(np.searchsorted(sizes, before + COUNTED)))
            yield batch.slice(first, end - first)
            first = end


def _unpacked(batch: pa.RecordBatch, column: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of the rows of a batch, and where each row's end."""
    rows = [np.cumsum(np.frombuffer(p.as_py(), dtype="<u4"), dtype=np.int64) for p in batch.column(column)]
    return np.concatenate(rows) if rows else np.empty(0, dtype=np.int64), np.cumsum([len(r) for r in rows])


def _pair_counts(stored: DataFrame) -> DataFrame:
    """pair, docs (how many documents hold it), over all documents."""
    schema = pa.schema([("pair", pa.int64()), ("docs", pa.int64())])

    def summed(pairs: list[np.ndarray], docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        values, place = np.unique(np.concatenate(pairs), return_inverse=True)
        return values, np.bincount(place, weights=np.concatenate(docs)).astype(np.int64)

    def out(pairs, docs):
        for k in range(0, len(pairs), EMITTED):
            yield pa.RecordBatch.from_arrays([pa.array(pairs[k : k + EMITTED]), pa.array(docs[k : k + EMITTED])], schema=schema)

    def count(batches):
        pairs, docs, held = [], [], 0
        for batch in _parts(batches, 0):
            found, _ = _unpacked(batch, 0)
            pairs.append(found)
            docs.append(np.ones(len(found), dtype=np.int64))
            held += len(found)
            if held > COUNTED:
                own = summed(pairs, docs)
                if len(own[0]) > COUNTED // 2:
                    yield from out(*own)
                    own = own[0][:0], own[1][:0]
                pairs, docs, held = [own[0]], [own[1]], len(own[0])
        if held:
            yield from out(*summed(pairs, docs))

    return stored.select("pairs").mapInArrow(count, "pair long, docs long").groupBy("pair").agg(F.sum("docs").alias("docs"))


def _head(counts: DataFrame) -> DataFrame:
    """The most frequent pairs, at most HEAD of them: whole classes of like counts from the top."""
    bucket = F.floor(F.log2("docs") * 16).cast("int")
    cut, taken = None, 0
    for kind, n in sorted(((r[0], r[1]) for r in counts.groupBy(bucket).count().collect()), reverse=True):
        if taken + n > HEAD:
            break
        cut, taken = kind, taken + n
    return counts.withColumn("head", F.lit(False) if cut is None else bucket >= cut)


class Alignment:
    """Both tokenizations of a corpus held against each other. `stored` has a row for every document; `counts`
    has pair, docs, best (no other pair of its A id is in more documents) and head."""

    def __init__(self, docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text"):
        steps = self._steps = Steps(docs.sparkSession)
        both = Sides(path_a, path_b)
        self.bits = both.bits
        if (len(both.a.bytes_of) << self.bits) > 1 << 32:
            raise ValueError("the vocabularies need more than 32 bits for a pair")
        self.stored = steps.keep(_aligned(docs, path_a, path_b, key, text), "aligned", compression="zstd")
        counts = steps.keep(_pair_counts(self.stored), "pair-counts")
        # One row for each id of the vocabulary at most.
        most = counts.groupBy(F.shiftright("pair", self.bits).alias("a")).agg(F.max("docs").alias("most"))
        flagged = _head(counts).withColumn("a", F.shiftright("pair", self.bits)).join(F.broadcast(most), "a")
        self.counts = steps.keep(flagged.select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"), "head"), "pair-table")
        steps.drop("pair-counts")

    def pair_table(self) -> DataFrame:
        """a, b (ids), docs, best of every pair."""
        return self.counts.select(
            F.shiftright("pair", self.bits).alias("a"), F.col("pair").bitwiseAND((1 << self.bits) - 1).alias("b"), "docs", "best")

    def sums(self) -> DataFrame:
        """row, n_best, count_sum of every document with links."""
        head = self.counts.where("head").select("pair", "docs", "best").toArrow()  # at most HEAD rows
        pair = head["pair"].to_numpy()
        order = np.argsort(pair)
        known = self.stored.sparkSession.sparkContext.broadcast((pair[order], head["docs"].to_numpy()[order], head["best"].to_numpy()[order]))
        schema, rest = pa.schema([("row", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64())]), pa.schema([("row", pa.int64()), ("pair", pa.int64()), ("links", pa.int64())])

        def looked(batch):
            """Rows, links and pairs of a batch, and their place among the known ones (-1: not there)."""
            pairs, ends = _unpacked(batch, 1)
            links = np.frombuffer(b"".join([x.as_py() for x in batch.column(2)]), dtype="<u4").astype(np.int64)
            own = known.value[0]
            place = np.searchsorted(own, pairs)
            place[place == len(own)] = 0
            place = np.where(own[place] == pairs, place, -1) if len(own) else np.full(len(pairs), -1)
            return pairs, links, place, np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))

        def added(batches):
            for batch in _parts(batches, 1):
                _, links, place, row = looked(batch)
                there = place >= 0
                links, place, row = links[there], place[there], row[there]
                total, best = (np.zeros(batch.num_rows, dtype=np.int64) for _ in range(2))
                np.add.at(total, row, links * known.value[1][place])
                np.add.at(best, row, links * known.value[2][place])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best), pa.array(total)], schema=schema)

        def others(batches):
            for batch in _parts(batches, 1):
                pairs, links, place, row = looked(batch)
                at = np.flatnonzero(place < 0)
                rows = batch.column(0).to_numpy()
                for k in range(0, len(at), EMITTED):
                    x = at[k : k + EMITTED]
                    yield pa.RecordBatch.from_arrays([pa.array(rows[row[x]]), pa.array(pairs[x]), pa.array(links[x])], schema=rest)

        chosen = self.stored.select("row", "pairs", "links")
        by_head = chosen.mapInArrow(added, "row long, n_best long, count_sum long")
        # A pair outside the head is in few documents, so no key of this join is large.
        rare = chosen.mapInArrow(others, "row long, pair long, links long").join(self.counts.where("not head"), "pair").groupBy("row").agg(
            F.sum(F.col("links") * F.col("best").cast("long")).alias("n_best"), F.sum(F.col("links") * F.col("docs")).alias("count_sum"))
        return by_head.union(rare).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))

    def digests(self) -> DataFrame:
        """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
        own = self.stored.select("row", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
        return own.join(self.sums(), "row", "left").select(
            F.col("key").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
            F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")


def group_spans(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, groups of every text in order: from and to index of its tokens on both sides."""
    kind = "array<struct<a_from:int,a_to:int,b_from:int,b_to:int>>"
    item = pa.list_(pa.struct([(n, pa.int32()) for n in ("a_from", "a_to", "b_from", "b_to")]))

    def spans(a: np.ndarray, b: np.ndarray, both: Sides) -> list[dict]:
        apart = groups_apart(np.cumsum(both.length_a[a], dtype="<u4"), np.cumsum(both.length_b[b], dtype="<u4"))
        sizes = [np.bincount(group_numbers(len(x), apart[:, k], apart[:, k + 1])) for x, k in ((a, 0), (b, 2))]
        ends_a, ends_b = map(np.cumsum, sizes)
        bounds = zip(ends_a - sizes[0], ends_a, ends_b - sizes[1], ends_b, strict=True)
        return [dict(zip(("a_from", "a_to", "b_from", "b_to"), map(int, x), strict=True)) for x in bounds]

    def align(batches):
        both = sides(path_a, path_b)
        for batch in batches:
            for k in range(batch.num_rows):
                ((a, b),) = both.tokens([batch.column(1)[k].as_py()])
                found = spans(a, b, both) if len(a) else []
                yield pa.RecordBatch.from_arrays([batch.column(0)[k : k + 1], pa.array([found], item)], names=["key", "groups"])

    chosen = docs.select(docs[key].cast("long").alias("key"), docs[text].cast("string").alias("text"))
    return chosen.mapInArrow(align, f"key long, groups {kind}").withColumnRenamed("key", key)
