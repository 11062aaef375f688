"""Log-bilinear language model: noise-contrastive training in numpy, normalised scores of whole texts.

Units are the most frequent words, each by itself, and for all other words the class of their last two
bytes. A token's context is the unit of the word before it and the ending class of the word before that; its
score is bilinear in the context's and the unit's vectors. Inside a class a word has its add-one
share, so log10 P(word) = log10 P(unit | context) + log10((c + 1) / class total), where every class has
one more word for all the words that training never saw.

Counts are of every training document. Every partition trains on all its training documents, against noise
from the unit counts, and the parameters are averaged by the number of tokens; the size of a model
depends on UNITS, CLASSES and WIDTH alone. Normalisers of all contexts come from batched matrix products.
Counts of the KNOWN most frequent words travel to the tasks; those of all others are joined.

Results: a null or empty text is its end alone. A null doc_id counts as a training document. Rows that
share doc_id and text get the same scores, and each counts in training. Without training documents
every token is unseen. Columns other than doc_id and text play no part.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.words import chunks, mix
from tributary.session import write_and_reload

UNITS = 1024
CLASSES = 256
STATES = 64
WIDTH = 32
KNOWN = 1 << 18
NOISE = 128
BATCH = 8192
RATE = 0.1
SEED = 7
COUNT_TOKENS = 1 << 21

_U = np.uint64
END = 0x454E444F46544558


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _ending_class(endings: np.ndarray, many: int) -> np.ndarray:
    return (mix(endings.astype(_U)) % _U(many)).astype(np.int64)


def _tokens(column: pa.Array):
    """first row, hashes, endings, offsets of some rows, the end of each text added as a word."""
    for c in chunks(column, lower=True):
        at = c.offsets[1:]
        words = np.insert(c.words, at, _U(END))
        endings = np.insert(c.endings, at, np.uint16(0))
        yield c.first, words, endings, c.offsets + np.arange(len(c.offsets))


def word_counts(docs: DataFrame) -> DataFrame:
    """word (hash), class, n of all tokens: summed in every task, then by word."""

    def counted(held):
        words, first, counts = np.unique(np.concatenate([w for w, _ in held]), return_index=True, return_counts=True)
        classes = _ending_class(np.concatenate([e for _, e in held])[first], CLASSES)
        for a in range(0, len(words), 1 << 17):
            b = a + (1 << 17)
            yield pa.RecordBatch.from_arrays(
                [pa.array(words[a:b].view(np.int64)), pa.array(classes[a:b].astype(np.int32)), pa.array(counts[a:b])], names=["word", "class", "n"]
            )

    def count(batches):
        held, size = [], 0
        for batch in batches:
            for _, words, endings, _ in _tokens(batch.column(0)):
                held.append((words, endings))
                size += len(words)
                if size >= COUNT_TOKENS:
                    yield from counted(held)
                    held, size = [], 0
        if held:
            yield from counted(held)

    text = docs.select(F.col("text").cast("string").alias("text"))
    return text.mapInArrow(count, "word long, class int, n long").groupBy("word", "class").agg(F.sum("n").alias("n"))


class Counts(NamedTuple):
    """What every task needs of the counts; bounded by KNOWN, UNITS and CLASSES."""

    words: np.ndarray  # the most frequent words' hashes, ascending
    counts: np.ndarray
    units: np.ndarray  # unit of each of these words, or -1 for its class
    shares: np.ndarray  # probability of every unit in the training documents
    class_totals: np.ndarray
    tokens: int
    distinct: int


def known_words(counts: DataFrame, units: list) -> list:
    """Rows of the most frequent words, KNOWN at most, and of the units: whole classes of like counts from the top, so that
    no other row leaves the executors. Words of the class that goes beyond KNOWN are joined like all rarer ones."""
    like = F.floor(F.log2("n") * 16).cast("int")
    cut, taken = None, 0
    for kind, n in sorted(((r[0], r[1]) for r in counts.groupBy(like).count().collect()), reverse=True):
        if taken + n > KNOWN:
            break
        cut, taken = kind, taken + n
    rows = [] if cut is None else counts.where(like >= cut).select("word", "n").collect()
    there = {r.word for r in rows}
    return rows + [r for r in units if r.word not in there]


def gathered(counts: DataFrame) -> Counts:
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    first = counts.select("word", "n").orderBy(F.desc("n"), "word").limit(UNITS).collect()
    top = known_words(counts, first)
    head = {END: None} | {r.word: None for r in first}
    head = list(head)[:UNITS]
    words = np.array([r.word for r in top], dtype=np.int64)
    number = np.array([r.n for r in top], dtype=np.int64)
    order = np.argsort(words.view(_U))
    words, number = words[order].view(_U), number[order]
    units = np.full(len(words), -1, dtype=np.int64)
    shares = np.ones(UNITS + CLASSES)
    for k, w in enumerate(head):
        at = np.searchsorted(words, _U(w % (1 << 64)))
        if at < len(words) and words[at] == _U(w % (1 << 64)):
            units[at] = k
            shares[k] += number[at]
    by_class = counts.where(~F.col("word").isin(head)).groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    totals = np.ones(CLASSES)
    for r in by_class:
        totals[r["class"]] += r.n + r.v
        shares[UNITS + r["class"]] += r.n
    return Counts(words, number, units, shares / shares.sum(), totals, int(total[0]), int(total[1]))


def _units(words: np.ndarray, endings: np.ndarray, c: Counts) -> tuple[np.ndarray, np.ndarray]:
    """Unit of every token, and its count where it is among the known words, else -1."""
    units = UNITS + _ending_class(endings, CLASSES)
    number = np.full(len(words), -1, dtype=np.int64)
    if len(c.words):
        at = np.minimum(np.searchsorted(c.words, words), len(c.words) - 1)
        known = c.words[at] == words
        number[known] = c.counts[at[known]]
        own = c.units[at]
        units = np.where(known & (own >= 0), own, units)
    return units, number


def _contexts(units: np.ndarray, endings: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The unit before each token, and the ending class before that; a text begins with a mark of its own."""
    n = len(units)
    before, earlier = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    before[1:] = units[:-1]
    earlier[2:] = _ending_class(endings, STATES)[:-2]
    starts = offsets[:-1]
    before[starts] = UNITS + CLASSES
    earlier[starts] = STATES
    second = starts[starts + 1 < offsets[1:]] + 1
    earlier[second] = STATES
    return before, earlier


class Model:
    """Vectors of the two contexts and of the units, with a bias for each unit."""

    def __init__(self, shares: np.ndarray):
        rng = np.random.default_rng(SEED)
        sizes = (UNITS + CLASSES + 1, STATES + 1, UNITS + CLASSES)
        self.parts = [rng.normal(0, 0.1, (n, WIDTH)).astype(np.float32) for n in sizes]
        self.parts.append(np.log(shares).astype(np.float32)[:, None])

    @staticmethod
    def _add(into: np.ndarray, squares: np.ndarray, rows: np.ndarray, gradient: np.ndarray) -> None:
        """One adaptive step on the rows that a batch touched."""
        order = np.argsort(rows, kind="stable")
        first = np.flatnonzero(np.r_[True, np.diff(rows[order]) > 0])
        own = rows[order][first]
        g = np.add.reduceat(gradient[order], first, axis=0)
        squares[own] += g * g
        into[own] -= RATE * g / np.sqrt(squares[own])

    def train(self, batches, shares: np.ndarray) -> int:
        """Noise-contrastive steps on (before, earlier, unit) arrays; returns the number of tokens."""
        rng = np.random.default_rng(SEED)
        before_v, earlier_v, unit_v, bias = self.parts
        squares = [np.ones_like(p) for p in self.parts]
        log_noise = np.log(NOISE * shares).astype(np.float32)
        cumulated = np.cumsum(shares)
        tokens = 0
        for before, earlier, unit in batches:
            tokens += len(unit)
            noise = np.minimum(np.searchsorted(cumulated, rng.random(NOISE)), len(shares) - 1)
            q = before_v[before] + earlier_v[earlier]
            data = np.einsum("ij,ij->i", q, unit_v[unit]) + bias[unit, 0] - log_noise[unit]
            other = q @ unit_v[noise].T + (bias[noise, 0] - log_noise[noise])
            up = -1 / (1 + np.exp(np.clip(data, -30, 30)))
            down = 1 / (1 + np.exp(np.clip(-other, -30, 30)))
            dq = up[:, None] * unit_v[unit] + down @ unit_v[noise]
            d_unit = np.concatenate([up[:, None] * q, down.T @ q])
            d_bias = np.concatenate([up, down.sum(axis=0)])[:, None]
            touched = np.concatenate([unit, noise])
            self._add(before_v, squares[0], before, dq)
            self._add(earlier_v, squares[1], earlier, dq)
            self._add(unit_v, squares[2], touched, d_unit)
            self._add(bias, squares[3], touched, d_bias)
        return tokens

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores by (before, unit) and by (earlier, unit), and the log normaliser of every context."""
        before_v, earlier_v, unit_v, bias = self.parts
        one = before_v @ unit_v.T + bias[:, 0]
        two = earlier_v @ unit_v.T
        norm = np.empty((len(one), len(two)), dtype=np.float64)
        for k in range(len(two)):
            z = one + two[k]
            top = z.max(axis=1)
            norm[:, k] = top + np.log(np.exp(z - top[:, None]).sum(axis=1, dtype=np.float64))
        return one, two, norm


def trained(docs: DataFrame, c: Counts) -> Model:
    """The model averaged over the partitions of the training documents."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(c)

    def train(batches):
        held = shared.value
        model = Model(held.shares)

        def steps():
            for batch in batches:
                for _, words, endings, offsets in _tokens(batch.column(0)):
                    units, _ = _units(words, endings, held)
                    before, earlier = _contexts(units, endings, offsets)
                    for a in range(0, len(units), BATCH):
                        yield before[a : a + BATCH], earlier[a : a + BATCH], units[a : a + BATCH]

        tokens = model.train(steps(), held.shares)
        if tokens:
            weighted = np.concatenate([p.astype(np.float64).ravel() for p in model.parts]) * tokens
            pieces = np.array_split(weighted, 64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(pieces)), pa.int32()), pa.array([float(tokens)] * len(pieces)), pa.array([p.tolist() for p in pieces], pa.list_(pa.float64()))],
                names=["piece", "tokens", "weights"],
            )

    def average(batch: pa.Table) -> pa.Table:
        total = np.zeros(len(batch.column("weights")[0]))
        for w in batch.column("weights"):
            total += w.values.to_numpy()
        mean = total / np.sum(batch.column("tokens").to_numpy())
        return pa.table({"piece": [batch.column("piece")[0].as_py()], "weights": [mean.tolist()]}, schema=pa.schema([("piece", pa.int32()), ("weights", pa.list_(pa.float64()))]))

    text = docs.select(F.col("text").cast("string").alias("text"))
    partial = text.mapInArrow(train, "piece int, tokens double, weights array<double>")
    # A 64th of the parameters of every partition comes together at a time.
    rows = partial.groupBy("piece").applyInArrow(average, "piece int, weights array<double>").orderBy("piece").collect()
    model = Model(c.shares)
    if rows:
        flat, at = np.concatenate([r.weights for r in rows]).astype(np.float32), 0
        for k, p in enumerate(model.parts):
            model.parts[k] = flat[at : at + p.size].reshape(p.shape)
            at += p.size
    return model


def _scored(docs: DataFrame, c: Counts, model: Model) -> DataFrame:
    """doc_id, tag, held_out, n_tokens, n_known, logs, unit_score, rest: rest holds the words whose counts
    a task doesn't know."""
    shared = docs.sparkSession.sparkContext.broadcast((c, model))
    ten = np.log(10)

    def score(batches):
        held, own = shared.value
        one, two, norm = own.tables()
        share = np.log(held.class_totals)
        for batch in batches:
            for first, words, endings, offsets in _tokens(batch.column(3)):
                units, number = _units(words, endings, held)
                before, earlier = _contexts(units, endings, offsets)
                value = (one[before, units] + two[earlier, units]).astype(np.float64) - norm[before, earlier]
                logs = np.where(number >= 0, np.log10(np.maximum(number, 0) + 1.0), 0.0)
                tail = units >= UNITS
                value = (value - np.where(tail, share[np.maximum(units - UNITS, 0)], 0.0)) / ten
                starts = offsets[:-1]
                rest = np.flatnonzero(number < 0)
                bounds = np.searchsorted(rest, offsets)
                rows = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(first, rows) for k in range(3)),
                     pa.array(np.diff(offsets)), pa.array(np.add.reduceat((number >= 0).astype(np.int64), starts)),
                     pa.array(np.add.reduceat(logs, starts)), pa.array(np.add.reduceat(np.where(tail, logs, 0.0), starts)),
                     pa.array(np.add.reduceat(value, starts)),
                     pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(words[rest].view(np.int64)))],
                    names=["doc_id", "tag", "held_out", "n_tokens", "n_known", "logs", "tail_logs", "unit_score", "rest"],
                )

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tag"), held_out(F.col("doc_id")).alias("held_out"), text.alias("text"))
    kinds = "doc_id long, tag long, held_out boolean, n_tokens long, n_known long, logs double, tail_logs double, unit_score double, rest array<long>"
    return keyed.mapInArrow(score, kinds)


def scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    learned_from = docs.where(~held_out(F.col("doc_id")))
    counts = write_and_reload(word_counts(learned_from), "word-counts")
    c = gathered(counts)
    rows = write_and_reload(_scored(docs, c, trained(learned_from, c)), "unit-scores")
    # Words beyond the known ones are rare each, so this join has no hot key.
    words = rows.where(F.size("rest") > 0).dropDuplicates(["doc_id", "tag"]).select("doc_id", "tag", F.explode("rest").alias("word"))
    met = words.join(counts.select("word", "n"), "word").groupBy("doc_id", "tag")
    found = met.agg(F.count("*").alias("more"), F.sum(F.log10(F.col("n") + 1.0)).alias("more_logs")).withColumnRenamed("tag", "found_tag")
    found = found.withColumnRenamed("doc_id", "found_id")
    joined = rows.drop("rest").join(found, F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("tag") == F.col("found_tag")), "left")
    more = F.coalesce("more_logs", F.lit(0.0))
    spread = float(np.log10(c.tokens + c.distinct + 1))
    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(c.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + more - F.col("n_tokens") * spread).alias("base_score"),
        (F.col("unit_score") + F.col("tail_logs") + more).alias("score"),
    )
