"""Jaccard join of documents on sets of word n-grams: a grouped prefix join.

1. Every document becomes a set of hashed n-grams. Documents with equal sets are one class; a class is
   what all later steps work on.
2. In one order of all n-grams (frequent ones last), two sets that are similar enough share an n-gram
   within their prefixes. Classes with the same size and the same prefix are one group; groups that
   share a prefix n-gram are a bucket, and a group with several classes is a bucket of its own.
3. Buckets are expanded to their classes, large ones into blocks, so that no task ever holds more than
   two blocks. Sizes and 512-bit parity sketches (wider ones for long sets) rule pairs out without
   loss: the sketches differ in at most as many bits as the sets differ in n-grams.
4. Of the pairs left, a bucket first proposes a spanning forest only, nearest pairs first. Proposals are
   verified on the whole sets; whatever joins two components then is needed no more. A second look
   at the large buckets proposes all pairs left between different components, so no link that could
   join two components stays unverified.

The order rests on n-grams that are frequent in some part of the corpus; a wrong guess costs time only.

Results: a text without words has an empty set, which is linked with nothing. A text with fewer words
than an n-gram has its whole word sequence as its one element. Rows that share a doc_id are one
document with several texts. A row without doc_id gets the component of an equal text that has
one, else none. Columns other than doc_id and text play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.components import components
from tributary.llm.memory import given_back
from tributary.llm.steps import Steps
from tributary.llm.words import chunks, join_hashes, mix

WORDS = 4
PERCENT = 85
SKETCH_BITS = 512
BLOCK = 2048
SMALL_BUCKET = 8
# Rows of a bucket whose pairs are proposed at once: at most this times two blocks pairs are in memory.
PAIR_ROWS = 64
FREQUENT_KEPT = 20_000
FREQUENT_CHUNK = 1 << 21
FREQUENT_SHARE = 1 / 1024

_U = np.uint64
_FAR = np.iinfo(np.int32).max
_NO_PAIRS = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)


def prefix_size(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def most_difference(n, m, percent: int):
    """How many n-grams two linked sets of these sizes can differ in; negative: they cannot be linked."""
    both = n + m
    shared = (percent * both + 99 + percent) // (100 + percent)
    fits = (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (shared <= np.minimum(n, m))
    return np.where(fits, both - 2 * shared, -1)


def sets_of(column: pa.Array, words: int):
    """Row number and sorted set (63-bit hashes) of every text of a column."""
    for chunk in chunks(column, lower=True):
        grams = join_hashes(chunk.words, words) >> _U(1)
        for k, (a, b) in enumerate(zip(chunk.offsets[:-1].tolist(), chunk.offsets[1:].tolist(), strict=True)):
            if b - a >= words:
                yield chunk.first + k, np.unique(grams[a : b - words + 1])
            elif b > a:
                yield chunk.first + k, join_hashes(chunk.words[a:b], b - a) >> _U(1)
            else:
                yield chunk.first + k, grams[:0]


def set_digest(s: np.ndarray) -> int:
    """A signed 64-bit digest of a set."""
    return int(mix(np.array([np.bitwise_xor.reduce(mix(s)) + _U(len(s))], dtype=_U)).view(np.int64)[0]) if len(s) else 0


def second_digest(s: np.ndarray) -> int:
    return int(np.add.reduce(mix(s ^ _U(0x5851F42D4C957F2D))).view(np.int64)) if len(s) else 0


def sketch(s: np.ndarray, bits: int = SKETCH_BITS) -> bytes:
    """Parity of the number of n-grams at each place."""
    odd = np.bincount((mix(s) % _U(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def wide_sketch(s: np.ndarray) -> bytes | None:
    """A sketch with a place for every second n-gram at least, for sets that fill the usual one."""
    bits = SKETCH_BITS
    while 2 * bits < len(s):
        bits *= 2
    return sketch(s, bits) if bits > SKETCH_BITS else None


def wide_difference(a: bytes, b: bytes) -> int:
    """Differing places of two wide sketches; the halves of a longer one fold onto each other."""
    x, y = np.frombuffer(a, dtype=_U), np.frombuffer(b, dtype=_U)
    while len(x) != len(y):
        if len(x) > len(y):
            x = x[: len(x) // 2] ^ x[len(x) // 2 :]
        else:
            y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def frequent(docs: DataFrame, words: int) -> np.ndarray:
    """N-grams that are frequent in some stretch of the corpus, rarest first; FREQUENT_KEPT at most."""

    def count(batches):
        held, size, texts = [], 0, 0

        def found():
            grams, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= max(4, texts * FREQUENT_SHARE)
            return pa.RecordBatch.from_arrays([pa.array(grams[often].view(np.int64)), pa.array(counts[often])], names=["gram", "n"])

        for batch in batches:
            for _, s in sets_of(batch.column(0), words):
                held.append(s)
                size, texts = size + len(s), texts + 1
                if size >= FREQUENT_CHUNK:
                    yield found()
                    held, size, texts = [], 0, 0
        if held:
            yield found()

    counted = _texts(docs).select("text").mapInArrow(given_back(count), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    rows = counted.orderBy(F.desc("n"), "gram").limit(FREQUENT_KEPT).collect()
    return np.array([r.gram for r in reversed(rows)], dtype=np.int64).view(_U)


def signatures(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, n, d1, d2, prefix, sketch, wide of every row."""
    often = frequent(docs, words)
    order = np.argsort(often)
    sorted_often, rank = often[order], order.astype(_U)

    def sign(batches):
        for batch in batches:
            out = []
            for _, s in sets_of(batch.column(1), words):
                keep = s
                if len(s) and len(sorted_often):
                    at = np.minimum(np.searchsorted(sorted_often, s), len(sorted_often) - 1)
                    last = sorted_often[at] == s
                    if last.any():
                        late = s[last][np.argsort(rank[at[last]])]
                        keep = np.concatenate([s[~last], late])
                prefix = keep[: prefix_size(len(s), percent)].view(np.int64) if len(s) else s.view(np.int64)
                out.append((len(s), set_digest(s), second_digest(s), prefix, sketch(s), wide_sketch(s)))
            n, d1, d2, prefixes, sketches, wide = zip(*out, strict=True) if out else ((),) * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                 pa.array(prefixes, pa.list_(pa.int64())), pa.array(sketches, pa.binary()), pa.array(wide, pa.binary())],
                names=["doc_id", "n", "d1", "d2", "prefix", "sketch", "wide"],
            )

    return _texts(docs).mapInArrow(given_back(sign), "doc_id long, n long, d1 long, d2 long, prefix array<long>, sketch binary, wide binary")


def classes_of(signed: DataFrame) -> DataFrame:
    """gid (smallest doc_id), n, d1, d2, prefix, sketch, wide, grp of every distinct set."""
    own = signed.where("n > 0 AND doc_id IS NOT NULL").groupBy("n", "d1", "d2")
    found = own.agg(F.min("doc_id").alias("gid"), *[F.any_value(c).alias(c) for c in ("prefix", "sketch", "wide")])
    return found.withColumn("grp", F.xxhash64("n", "prefix"))


def buckets_of(classes: DataFrame, steps: Steps) -> DataFrame:
    """key, grp, gid, d1, n, sketch, members: the classes that meet, with the size of their bucket."""
    groups = classes.groupBy("grp").agg(F.count("*").alias("in_group"))
    one_each = classes.select("grp", "prefix").dropDuplicates(["grp"])
    tokens = one_each.select("grp", F.explode("prefix").alias("key"))
    met = tokens.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    shared = steps.keep(tokens.join(met, "key"), "shared")
    steps.drop()
    sized = shared.join(groups, "grp")
    members = sized.groupBy("key").agg(F.sum("in_group").alias("members"))
    between = shared.join(members, "key")
    # A group is told from a token by its key's sign: n-grams are not negative.
    within = groups.where("in_group > 1").select(F.expr("-1 - shiftrightunsigned(grp, 1)").alias("key"), "grp", F.col("in_group").alias("members"))
    return between.unionByName(within).join(classes.select("grp", "gid", "d1", "n", "sketch"), "grp")


def _blocks(buckets: DataFrame) -> DataFrame:
    """Rows of buckets with the pair of blocks (i <= j) they are compared in, and their own block."""
    parts = F.ceil(F.col("members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("gid", "d1"), parts).cast("int")
    cut = buckets.withColumns({"own": own, "parts": parts})
    whole = cut.where("parts = 1").select("*", F.lit(0).alias("i"), F.lit(0).alias("j"))
    split = cut.where("parts > 1").select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    split = split.select("*", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).drop("other")
    return whole.unionByName(split).drop("parts")


def _distances(sketches: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    """Differing sketch bits of all pairs; _FAR where a pair is ruled out."""
    out = np.full((len(n), len(n)), _FAR, dtype=np.int32)
    for a in range(0, len(n), 128):
        bits = np.bitwise_count(sketches[a : a + 128, None, :] ^ sketches[None, :, :]).sum(axis=2, dtype=np.int32)
        fits = bits <= most_difference(n[a : a + 128, None], n[None, :], percent)
        out[a : a + 128][fits] = bits[fits]
    return out


def _forest(d: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that are not _FAR, nearest first (Prim)."""
    m = len(d)
    best, source = np.full(m, _FAR, dtype=np.int64), np.zeros(m, dtype=np.int64)
    done = np.zeros(m, dtype=bool)
    out = []
    for _ in range(m):
        open_best = np.where(done, _FAR + 1, best)
        k = int(open_best.argmin())
        if best[k] < _FAR:
            out.append((int(source[k]), k))
        done[k] = True
        nearer = (d[k] < best) & ~done
        best[nearer], source[nearer] = d[k][nearer], k
    return out


def _sharpened(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs without those of long sets that their wide sketches rule out."""

    def keep(batches):
        for batch in batches:
            na, nb, a, b = (batch.column(k) for k in range(5, 9))
            fits = [
                not (x.is_valid and y.is_valid)
                or wide_difference(x.as_py(), y.as_py()) <= int(most_difference(np.int64(n.as_py()), np.int64(m.as_py()), percent))
                for n, m, x, y in zip(na, nb, a, b, strict=True)
            ]
            yield batch.select(names).filter(pa.array(fits, pa.bool_()))

    names = ["a", "ad", "b", "bd", "bits"]
    wide = classes.where("wide IS NOT NULL")
    one = wide.select(F.col("gid").alias("a"), F.col("d1").alias("ad"), F.col("n").alias("an"), F.col("wide").alias("aw"))
    two = wide.select(F.col("gid").alias("b"), F.col("d1").alias("bd"), F.col("n").alias("bn"), F.col("wide").alias("bw"))
    joined = pairs.join(one, ["a", "ad"], "left").join(two, ["b", "bd"], "left").select(*names, "an", "bn", "aw", "bw")
    return joined.mapInArrow(given_back(keep), "a long, ad long, b long, bd long, bits int")


def _compare(buckets: DataFrame, percent: int, spanning: bool) -> DataFrame:
    """a, ad, b, bd, bits of proposed pairs: per bucket a spanning forest, or all pairs between components."""
    kinds = pa.schema([("a", pa.int64()), ("ad", pa.int64()), ("b", pa.int64()), ("bd", pa.int64()), ("bits", pa.int32())])
    columns = ["key", "i", "j", "grp", "gid", "d1", "n", "own", "comp", "sketch"]

    def pairs(key, i, j, grp, gid, d1, n, own, comp, sketches):
        """Index pairs and distances of one bucket or pair of blocks, some rows of it at a time."""
        d = _distances(sketches, n, percent)
        if i != j:
            d[own[:, None] == own[None, :]] = _FAR
        if key >= 0:
            d[grp[:, None] == grp[None, :]] = _FAR
        d[comp[:, None] == comp[None, :]] = _FAR
        if spanning:
            x, y = (np.array(v, dtype=np.int64) for v in zip(*_forest(d), strict=True)) if (d < _FAR).any() else _NO_PAIRS
            yield x, y, d[x, y]
            return
        for first in range(0, len(d), PAIR_ROWS):
            x, y = np.nonzero(d[first : first + PAIR_ROWS] < _FAR)
            x += first
            x, y = x[x < y], y[x < y]
            yield x, y, d[x, y]

    def small(table, bounds):
        """All pairs of many small buckets at once, by the distance of their rows."""
        size = np.diff(bounds)
        number = np.repeat(np.arange(len(size)), size)
        for shift in range(1, SMALL_BUCKET):
            x = np.flatnonzero(number[:-shift] == number[shift:]) if shift < len(number) else np.empty(0, np.int64)
            if not len(x):
                break
            y = x + shift
            bits = np.bitwise_count(table["sketch"][x] ^ table["sketch"][y]).sum(axis=1, dtype=np.int64)
            fits = bits <= most_difference(table["n"][x], table["n"][y], percent)
            fits &= (table["comp"][x] != table["comp"][y]) & ((table["grp"][x] != table["grp"][y]) | (table["key"][x] < 0))
            yield x[fits], y[fits], bits[fits]

    def batch_of(t, x, y, bits):
        swap = (t["gid"][x] > t["gid"][y]) | ((t["gid"][x] == t["gid"][y]) & (t["d1"][x] > t["d1"][y]))
        x, y = np.where(swap, y, x), np.where(swap, x, y)
        return pa.RecordBatch.from_arrays(
            [pa.array(t["gid"][x]), pa.array(t["d1"][x]), pa.array(t["gid"][y]), pa.array(t["d1"][y]), pa.array(np.asarray(bits, np.int32))], schema=kinds
        )

    def read(batch):
        t = {c: batch.column(k).to_numpy(zero_copy_only=False) for k, c in enumerate(columns[:-1])}
        raw = b"".join(batch.column(len(columns) - 1).to_pylist())
        t["sketch"] = np.frombuffer(raw, dtype=_U).reshape(-1, SKETCH_BITS // 64)
        return t

    def propose(batches):
        held = None
        for batch in _then_none(batches):
            if batch is not None:
                t = read(batch)
                held = t if held is None else {c: np.concatenate([held[c], t[c]]) for c in t}
            if held is None or not len(held["key"]):
                continue
            key, i, j = held["key"], held["i"], held["j"]
            new = np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            bounds = np.concatenate([[0], new, [len(key)]])
            if batch is not None:  # the last bucket may go on in the next batch
                bounds = bounds[:-1]
            sizes = np.diff(bounds)
            end = int(bounds[-1])
            few = np.flatnonzero((sizes > 1) & (sizes <= SMALL_BUCKET))
            if len(few):
                rows = np.concatenate([np.arange(bounds[k], bounds[k + 1]) for k in few.tolist()])
                part = {c: v[rows] for c, v in held.items()}
                for x, y, bits in small(part, np.concatenate([[0], np.cumsum(sizes[few])])):
                    yield batch_of(part, x, y, bits)
            for k in np.flatnonzero(sizes > SMALL_BUCKET).tolist():
                part = {c: v[bounds[k] : bounds[k + 1]] for c, v in held.items()}
                for x, y, bits in pairs(int(part["key"][0]), int(part["i"][0]), int(part["j"][0]), *(part[c] for c in columns[3:])):
                    if len(x):
                        yield batch_of(part, x, y, bits)
            held = {c: v[end:] for c, v in held.items()}

    dealt = _blocks(buckets).select(*columns).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    found = dealt.mapInArrow(given_back(propose), "a long, ad long, b long, bd long, bits int")
    return found.groupBy("a", "ad", "b", "bd").agg(F.min("bits").alias("bits"))


def _then_none(batches):
    yield from batches
    yield None


def _sets(docs: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """gid, d1, grams (sorted, packed) of the documents in the pairs."""
    wanted = pairs.select(F.col("a").alias("wanted")).union(pairs.select("b")).distinct()

    def pack(batches):
        for batch in batches:
            sets = [s for _, s in sets_of(batch.column(1), words)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([set_digest(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["gid", "d1", "grams"],
            )

    chosen = _texts(docs).join(wanted, F.col("doc_id") == F.col("wanted"), "left_semi")
    packed = chosen.mapInArrow(given_back(pack), "gid long, d1 long, grams binary")
    return packed


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b of the pairs that are linked, by their whole sets."""

    def verify(batches):
        for batch in batches:
            a, b, left, right = (batch.column(k) for k in range(4))
            keep = []
            for k in range(len(a)):
                x = np.frombuffer(left[k].as_buffer(), dtype=_U)
                y = np.frombuffer(right[k].as_buffer(), dtype=_U)
                shared = len(x) + len(y) - len(np.union1d(x, y))
                if 100 * shared >= percent * (len(x) + len(y) - shared):
                    keep.append(k)
            yield pa.RecordBatch.from_arrays([a.take(pa.array(keep, pa.int64())), b.take(pa.array(keep, pa.int64()))], names=["a", "b"])

    first = sets.select(F.col("gid").alias("a"), F.col("d1").alias("ad"), F.col("grams").alias("left"))
    second = sets.select(F.col("gid").alias("b"), F.col("d1").alias("bd"), F.col("grams").alias("right"))
    joined = pairs.select("a", "ad", "b", "bd").join(first, ["a", "ad"]).join(second, ["b", "bd"])
    return joined.select("a", "b", "left", "right").mapInArrow(given_back(verify), "a long, b long")


def _apart(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    one = parts.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    two = parts.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    joined = pairs.join(one, "a", "left").join(two, "b", "left")
    return joined.where("coalesce(ca, a) <> coalesce(cb, b)").drop("ca", "cb")


def component_table(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    steps = Steps(docs.sparkSession)
    signed = steps.keep(signatures(docs, words, percent), "signatures")
    classes = steps.keep(classes_of(signed), "classes")
    buckets = steps.keep(buckets_of(classes, steps), "buckets")
    steps.drop("shared")

    met = _compare(buckets.withColumn("comp", F.xxhash64("gid", "d1")), percent, spanning=True)
    proposed = steps.keep(_sharpened(met, classes, percent), "proposed")
    steps.drop()
    sets = steps.keep(_sets(docs, proposed, words), "sets")
    steps.drop()
    # First the nearest proposal of every document, which joins most of what belongs together.
    ends = proposed.select("*", F.col("a").alias("own")).union(proposed.select("*", F.col("b").alias("own")))
    nearest = ends.groupBy("own").agg(F.min(F.struct("bits", "a", "ad", "b", "bd")).alias("p")).select("p.*").distinct()
    nearest = steps.keep(nearest, "nearest")
    first = steps.keep(_verified(nearest, sets, percent), "first-links")
    parts = steps.keep(components(first), "first-parts")
    rest = steps.keep(_apart(proposed.join(nearest, ["a", "ad", "b", "bd"], "left_anti"), parts), "rest")
    steps.drop("nearest", "first-parts")
    links = steps.keep(first.union(_verified(rest, sets, percent)), "links")
    parts = steps.keep(components(links), "parts")
    steps.drop("first-links", "rest", "sets")

    # Small buckets have proposed all their pairs; large ones only a forest.
    large = buckets.where(F.col("members") > SMALL_BUCKET).join(parts, F.col("gid") == F.col("node"), "left")
    large = steps.keep(large.withColumn("comp", F.coalesce("component", "gid")).drop("node", "component"), "large")
    steps.drop("buckets", "parts")
    mixed = large.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("key")
    again = _compare(large.join(mixed, "key", "left_semi"), percent, spanning=False)
    again = steps.keep(_sharpened(again.join(proposed, ["a", "ad", "b", "bd"], "left_anti"), classes, percent), "again")
    steps.drop("large", "proposed")
    more = steps.keep(_verified(again, _sets(docs, again, words), percent), "more-links")
    steps.drop("again")
    links = links.union(more)

    named = classes.select(F.col("n").alias("cn"), F.col("d1").alias("c1"), F.col("d2").alias("c2"), "gid")
    same = (F.col("n") == F.col("cn")) & (F.col("d1") == F.col("c1")) & (F.col("d2") == F.col("c2"))
    rows = steps.keep(signed.select("doc_id", "n", "d1", "d2").join(named, same, "left").select("doc_id", "n", "gid"), "rows")
    steps.drop("signatures", "classes")
    # A document with several texts links their classes.
    several = rows.where("n > 0").groupBy("doc_id").agg(F.min("gid").alias("low"), F.max("gid").alias("high")).where("low < high").select("doc_id")
    links = links.union(rows.where("n > 0").join(several, "doc_id").select(F.col("doc_id").alias("a"), F.col("gid").alias("b")))
    parts = steps.keep(components(links), "all-parts")
    steps.drop("links", "more-links")
    labelled = rows.join(parts, F.col("gid") == F.col("node"), "left")
    component = F.when(F.col("n") > 0, F.coalesce("component", "gid")).otherwise(F.col("doc_id"))
    return labelled.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def _set_keys(docs: DataFrame, words: int) -> DataFrame:
    """text, n, d1, d2 of every distinct text."""

    def digest(batches):
        for batch in batches:
            found = [(len(s), set_digest(s), second_digest(s)) for _, s in sets_of(batch.column(0), words)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in (zip(*found, strict=True) if found else ((),) * 3))], names=["text", "n", "d1", "d2"])

    texts = docs.select(F.col("text").cast("string").alias("text")).distinct()
    return texts.mapInArrow(given_back(digest), "text string, n long, d1 long, d2 long")


def one_of_each(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The documents, all columns, without those that are linked to one with a smaller doc_id. Of rows
    that share a doc_id the least one stays (by all columns in order). Of rows without doc_id those go whose set is that of
    a row with one; of equal sets among them the one with the least text stays, once. Without words, all stay."""
    found = component_table(docs, words, percent)
    name = "kept_id"
    while name in docs.columns:
        name += "_"
    stay = found.where("doc_id = component_id").select(F.col("doc_id").alias(name)).distinct()
    with_id = docs.where("doc_id IS NOT NULL").join(stay, F.col("doc_id").cast("long") == F.col(name), "left_semi")
    repeated = with_id.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias(name))
    single = with_id.join(repeated, F.col("doc_id") == F.col(name), "left_anti")
    least = with_id.join(repeated, F.col("doc_id") == F.col(name), "left_semi").groupBy("doc_id").agg(F.min(F.struct(*docs.columns)).alias(name))
    kept = single.unionByName(least.select(f"{name}.*"))
    without = docs.where("doc_id IS NULL")
    if without.isEmpty():
        return kept
    own = _set_keys(without, words).where("n > 0")
    known = _set_keys(docs.where("doc_id IS NOT NULL"), words).select("n", "d1", "d2")
    first = own.join(known, ["n", "d1", "d2"], "left_anti").groupBy("n", "d1", "d2").agg(F.min("text").alias("text"))
    # Texts with words that do not stay; the same text twice stays once.
    gone = own.select("text").join(first.select("text"), "text", "left_anti").select(F.col("text").alias(name))
    rest = without.join(gone, F.col("text") == F.col(name), "left_anti")
    worded = rest.join(first.select(F.col("text").alias(name)), F.col("text") == F.col(name), "left_semi")
    empty = rest.join(first.select(F.col("text").alias(name)), F.col("text") == F.col(name), "left_anti")
    return kept.unionByName(worded.groupBy("text").agg(F.min(F.struct(*docs.columns)).alias(name)).select(f"{name}.*")).unionByName(empty)
