"""Counts and base scores against plain counting; the model's scores by summing them up, and on held-out text."""

import math
import os
import zlib
from collections import Counter

import numpy as np
import pytest

from tributary.llm import lm_score

KINDS = "doc_id long, text string, word string, n int, tag string"
SF = "/root/testdata/sf0.01"


def tokens(text):
    return (text or "").encode().lower().split() + [None]


def out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def base(docs):
    c = Counter(w for i, t in docs if not out(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    for i, t in docs:
        w = tokens(t)
        yield i, out(i), len(w), sum(x in c for x in w), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)


@pytest.mark.parametrize("known, units", [(1 << 18, 1024), (20, 8)])
def test_base_scores(spark, monkeypatch, known, units):
    monkeypatch.setattr(lm_score, "KNOWN", known)
    docs = [(None, None), (0, ""), (1, "a b"), (1, "a b"), (-3, "É É é"), (70, "x" * 3000), (71, "b " * 4000), (None, "q r"), (None, "q r")]
    docs += [(i, " ".join(f"w{(i * k) % 97}" for k in range(i))) for i in range(2, 60)]
    got = lm_score.scores(spark.createDataFrame([(i, t, "w", 1, "t") for i, t in docs], KINDS).repartition(3)).collect()
    order = lambda r: tuple(map(str, r[:5]))
    rows = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=order)
    for g, w in zip(rows, sorted(base(docs), key=order), strict=True):
        assert g[:5] == w[:5] and math.isclose(g[5], w[5], rel_tol=1e-9), (g, w)
    assert all(r.score < 0 for r in got)


def test_a_word_in_capitals_is_the_same_word(spark):
    forms = ["some WORD", "some word", "SOME Word", "somE worD", "Some wORd"]
    docs = [(i, forms[i % 5] + f" W{i % 3}X w{i % 4}x") for i in range(40)]
    got = lm_score.scores(spark.createDataFrame([(i, t, "w", 1, "t") for i, t in docs], KINDS).repartition(5)).collect()
    for g, w in zip(sorted(got, key=lambda r: r.doc_id), base(docs), strict=True):
        assert g[:5] == w[:5] and math.isclose(g.base_score, w[5], rel_tol=1e-9), (g, w)


def test_empty_table(spark):
    assert lm_score.scores(spark.createDataFrame([], KINDS)).collect() == []


def test_every_context_sums_to_one():
    rng = np.random.default_rng(1)
    shares = rng.random(lm_score.UNITS + lm_score.CLASSES)
    model = lm_score.Model(shares / shares.sum())
    units = rng.integers(0, 40, 60_000)
    steps = [(units[a : a + 500], units[a : a + 500] % 9, (units[a : a + 500] * 3 + 1) % 40) for a in range(0, 60_000, 500)]
    assert model.train(iter(steps), shares / shares.sum()) == 60_000
    one, two, norm = model.tables()
    for before, earlier in [(0, 0), (39, 3), (1280, 64), (7, 64)]:
        assert math.isclose(np.exp(one[before].astype(float) + two[earlier] - norm[before, earlier]).sum(), 1, rel_tol=1e-4)
    right = np.exp(one[units] + two[units % 9] - norm[units, units % 9][:, None])[np.arange(60_000), (units * 3 + 1) % 40]
    assert right.mean() > 0.5


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data here")
def test_held_out_text_is_better_predicted(spark):
    got = lm_score.scores(spark.read.parquet(f"{SF}/documents.parquet").repartition(3)).where("held_out").toPandas()
    assert got.score.sum() > got.base_score.sum()
    print("held out, log10 per token:", got.base_score.sum() / got.n_tokens.sum(), got.score.sum() / got.n_tokens.sum())


@pytest.mark.parametrize("known", [1 << 18, 7, 0])
def test_known_words_are_the_most_frequent_and_bounded(spark, monkeypatch, known):
    monkeypatch.setattr(lm_score, "KNOWN", known)
    counts = spark.createDataFrame([(k, 0, 1 + 1000 // (k + 1)) for k in range(300)], "word long, class int, n long")
    first = counts.select("word", "n").orderBy("word").limit(2).collect()
    got = {r.word for r in lm_score.known_words(counts, first)}
    assert got >= {0, 1} and len(got) <= known + 2 and got == set(range(len(got)))
    assert len(got) == 300 if known > 300 else len(got) >= min(known, 2)
