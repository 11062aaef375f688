"""The prefix join against all pairs of sets, and components against a plain search."""

import random

import numpy as np
import pytest

from tributary.llm import components, ngram_join

KINDS = "doc_id long, text string, component_id string, n int, gid string"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def gram_set(text, words):
    w = lowered(text or "").encode().split()
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < words else frozenset(tuple(w[i : i + words]) for i in range(len(w) - words + 1))


def expected(docs, words, percent):
    sets = [(i, gram_set(t, words)) for i, t, *_ in docs]
    nodes = [(i, s) for i, s in sets if i is not None and s]
    up = {i: i for i, _ in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (i, s) in enumerate(nodes):
        for j, t in nodes[:k]:
            if 100 * len(s & t) >= percent * len(s | t):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    by_set = {s: root(i) for i, s in nodes}
    return sorted(((i, len(s), (root(i) if i is not None else by_set.get(s)) if s else i) for i, s in sets), key=str)


def documents(seed, group):
    rng = random.Random(seed)
    alphabet = [f"W{k}" for k in range(300)] + ["é", "the", "\n"]
    docs = [(0, None), (1, ""), (2, " \t"), (3, "one two"), (4, "One  TWO"), (5, "one"), (None, "ONE two"), (None, "lone words here")]
    base = [rng.choices(alphabet, k=rng.randint(3, 90)) for _ in range(10)]
    passage = rng.choices(alphabet, k=30)
    for i in range(6, 90):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            w[rng.randrange(len(w))] = rng.choice(alphabet)
        if rng.random() < 0.2:
            w = rng.choices(alphabet, k=rng.randint(1, 80)) + passage
        docs.append((i, " ".join(w)))
    hot = rng.choices(alphabet, k=120)
    for i in range(100, 100 + group):
        w = list(hot)
        for _ in range(rng.randint(0, 8)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(1000)}"
        docs.append((i, " ".join(w)))
    long = [f"l{rng.randrange(4000)}" for _ in range(3000)]
    for i in range(90, 96):
        w = list(long) if i % 3 else [f"m{rng.randrange(4000)}" for _ in range(1500 + i)] + long[:1300]
        for _ in range(20 * (i - 89)):
            w[rng.randrange(len(w))] = f"y{rng.randrange(1000)}"
        docs.append((i, " ".join(w)))
    docs += [(7, docs[40][1]), (7, docs[40][1]), (8, "another text of eight")]
    rng.shuffle(docs)
    return [(i, t, "c", 1, "g") for i, t in docs]


@pytest.mark.parametrize("words, percent, seed, block", [(4, 85, 1, 2048), (5, 80, 2, 40), (1, 50, 3, 2048)])
def test_join(spark, monkeypatch, words, percent, seed, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    docs = documents(seed, 150)
    got = ngram_join.component_table(spark.createDataFrame(docs, KINDS).repartition(4), words, percent).collect()
    assert sorted(map(tuple, got), key=str) == expected(docs, words, percent)


def test_one_of_each_group_stays(spark):
    docs = documents(9, 20)
    df = spark.createDataFrame(docs, KINDS)
    got = ngram_join.one_of_each(df, 4, 85)
    assert got.columns == df.columns
    want = {i for i, _, c in expected(docs, 4, 85) if i is not None and i == c}
    rows = got.collect()
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted(want)
    # "ONE two" has the set of a row with an id; the other row without one has a set of its own.
    assert [r.text for r in rows if r.doc_id is None] == ["lone words here"]
    assert [r.text for r in rows if r.doc_id == 8] == ([min(t for i, t, *_ in docs if i == 8)] if 8 in want else [])


def test_rows_without_id(spark):
    docs = [(1, "a b c d e"), (None, "A b c d e"), (None, "x y z w v"), (None, "X y z w v"), (None, "x y z w v"), (None, None), (None, " "), (None, " "), (2, "b"), (2, "a"), (2, "b")]
    got = ngram_join.one_of_each(spark.createDataFrame([(i, t, "c", k, "g") for k, (i, t) in enumerate(docs)], KINDS), 4, 85).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(
        [(1, "a b c d e"), (2, "a"), (None, "X y z w v"), (None, None), (None, " "), (None, " ")], key=str)


def test_many_long_unlinked_sets_in_one_bucket(spark):
    """Sketches of long sets rule no pair out: all pairs of a bucket are proposed, in batches of bounded size."""
    rng = np.random.default_rng(5)
    m, n = 600, 2000
    sets = [np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64)) for _ in range(m)]
    buckets = spark.createDataFrame([(1, k, k + 1, k * 7, len(s), bytearray(ngram_join.sketch(s)), m, k) for k, s in enumerate(sets)],
                                    "key long, grp long, gid long, d1 long, n long, sketch binary, members long, comp long")
    seen = ngram_join._compare(buckets, 80, spanning=False)
    assert seen.count() > 0.9 * m * (m - 1) / 2


def test_empty_table(spark):
    none = spark.createDataFrame([], KINDS)
    assert ngram_join.component_table(none).collect() == [] and ngram_join.one_of_each(none, 4, 85).collect() == []


def test_sketches_never_differ_in_more_places_than_sets():
    rng = np.random.default_rng(3)
    for n, m in ((10, 12), (600, 3000), (2000, 2100), (5000, 9000)):
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[: n // 2], rng.integers(0, 1 << 62, m).astype(np.uint64)]))
        differ = len(np.setxor1d(a, b))
        short = wide = None
        x, y = (np.frombuffer(ngram_join.sketch(s), dtype=np.uint64) for s in (a, b))
        short = int(np.bitwise_count(x ^ y).sum())
        assert short <= differ and (short - differ) % 2 == 0
        if len(a) > 1024 and len(b) > 1024:
            wide = ngram_join.wide_difference(ngram_join.wide_sketch(a), ngram_join.wide_sketch(b))
            assert short <= wide <= differ and (wide - differ) % 2 == 0


def test_most_difference_is_exact():
    for percent in (50, 80, 85, 100):
        for n in range(1, 60):
            for m in range(1, 60):
                best = max((s for s in range(min(n, m) + 1) if 100 * s >= percent * (n + m - s)), default=None, key=lambda s: -s)
                want = -1 if best is None else n + m - 2 * best
                assert int(ngram_join.most_difference(np.int64(n), np.int64(m), percent)) == want, (n, m, percent)


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(150), rng.randrange(150)) for _ in range(110)] + [(k, k + 1) for k in range(1000, 1040)] + [(5, 5)]
    up = {x: x for p in links for x in p}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    linked = {x for a, b in links if a != b for x in (a, b)}
    got = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted((x, root(x)) for x in linked)
