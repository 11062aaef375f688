"""Planted benchmark items, exact and changed, and the pieces of the search against plain versions."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tributary.llm import decontam

KINDS = "doc_id long, text string, item_id string, row int"
ITEMS = "item_id long, text string, first string"


def subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for k, y in enumerate(b):
            new.append(row[k] + 1 if x == y else max(new[-1], row[k + 1]))
        row = new
    return row[-1]


def vocabulary(rng):
    return ["".join(rng.choices(["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"], k=rng.randint(1, 4))) for _ in range(3000)]


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(3)
    words = vocabulary(rng)
    items = [(i, " ".join(rng.choices(words, k=rng.randint(15, 60))).capitalize() + ". " + " ".join(rng.choices(words, k=4)) + ".", "f") for i in range(40)]
    items += [(40, "", "f"), (41, None, "f"), (42, "Only five short rare words", "f"), (None, items[0][1], "f"), (1, items[1][1], "f")]
    docs, planted = [(0, None, "x", 1), (1, "", "x", 1), (2, " .,! ", "x", 1)], set()
    for d in range(3, 300):
        own = rng.choices(words, k=rng.choice([0, 10, 40, 300]))
        if d % 5 == 0:
            i = d // 5 % 40
            item = items[i][1].split()
            if d % 10 == 0:
                item = [rng.choice(words) if rng.random() < 0.12 else w.upper() for w in item]
            at = rng.randint(0, len(own))
            own[at:at] = item
            planted |= {(d, i)} | ({(d, None)} if i == 0 else set())
        docs.append((d, rng.choice([" ", "\n", ", "]).join(own), "x", 1))
    docs += [(300, f"so, ONLY five (short) rare words! {'and ' * 40}", "x", 1), (None, items[7][1], "x", 1), (305, items[9][1], "x", 1), (305, items[9][1], "x", 1)]
    docs.append((301, f"only five short {' '.join(words[:30])} rare words", "x", 1))
    planted |= {(300, 42), (None, 7), (305, 9)}
    return spark.createDataFrame(docs, KINDS).repartition(3), spark.createDataFrame(items, ITEMS), planted, docs


def test_planted_items_are_found_and_nothing_else(spark, tables):
    docs, items, planted, _ = tables
    got = decontam.contaminated(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in got} == planted and len(got) == len(planted)


def test_clean_documents(spark, tables, monkeypatch):
    docs, items, planted, rows = tables
    monkeypatch.setattr(decontam, "BLOCK", 30)
    kept = decontam.clean_documents(docs, items)
    assert kept.columns == docs.columns
    gone = {d for d, _ in planted}
    assert sorted(map(tuple, kept.collect()), key=str) == sorted((r for r in rows if r[0] not in gone), key=str)


def test_empty_tables(spark, tables):
    docs, items, _, rows = tables
    no_docs, no_items = spark.createDataFrame([], KINDS), spark.createDataFrame([], ITEMS)
    assert decontam.contaminated(no_docs, items).collect() == [] and decontam.contaminated(docs, no_items).collect() == []
    assert decontam.clean_documents(docs, no_items).count() == len(rows) and decontam.clean_documents(no_docs, items).count() == 0


def test_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(300):
        a, b = (rng.choices(range(6), k=rng.randint(0, 20)) for _ in range(2))
        assert decontam.common_subsequence(a, b) == subsequence(a, b)


def test_space_holds_the_leading_singular_vectors(spark, tables):
    cut = decontam.passages(tables[1]).cache()
    idf = np.ones(decontam.BUCKETS, dtype=np.float32)
    words = [np.array(r.words) for r in cut.select("words").collect()]
    row, bucket, value = decontam._vectors(words, idf)
    a = np.zeros((len(words), decontam.BUCKETS))
    a[row, bucket] = value
    best = np.linalg.svd(a, compute_uv=False)
    basis = decontam.latent_space(cut, idf, rank=20, steps=6)
    assert np.allclose(basis.T @ basis, np.eye(20), atol=1e-4)
    assert np.linalg.norm(a @ basis) ** 2 > 0.9 * (best[:20] ** 2).sum()


def test_words_are_split_at_marks():
    from tributary.llm.words import chunks

    text = "Ab,c-É éx\x85y 9.z\x00w"
    (c,) = chunks(pa.array([text]), lower=True, plain=True)
    assert len(c.words) == len(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text))


def test_recall_does_not_fall_with_the_size_of_the_benchmark(spark):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(50_000)]
    often = list(itertools.accumulate(1 / (k + 5) for k in range(len(words))))
    texts = [rng.choices(words, cum_weights=often, k=rng.randint(15, 59)) for _ in range(4000)]
    docs, planted = [], set()
    for i in range(0, 4000, 8):
        item = list(texts[i])
        if i % 16:
            for k in rng.sample(range(len(item)), len(item) // 10):
                item[k] = rng.choice(words)
        own = rng.choices(words, cum_weights=often, k=rng.choice([0, 40, 300]))
        at = rng.randint(0, len(own))
        docs.append((i, " ".join(own[:at] + item + own[at:]), "x", 1))
        planted.add((i, i))
    items = spark.createDataFrame([(i, " ".join(t), "f") for i, t in enumerate(texts)], ITEMS)
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(spark.createDataFrame(docs, KINDS).repartition(8), items).collect()}
    exact = {p for p in planted if p[0] % 16 == 0}
    assert exact <= got and len(planted & got) >= 0.98 * len(planted)
    assert len(got - planted) <= 0.01 * len(planted)


def test_copies_are_found_outside_the_space(spark):
    items = spark.createDataFrame([(1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa", "f"), (2, "word", "f"), (3, "two words", "f")], ITEMS)
    rows = items.orderBy("item_id").select("item_id")
    cut = decontam.passages(items.join(rows, "item_id")).orderBy("item_id").collect()
    nothing = np.zeros((decontam.BUCKETS, 4), dtype=np.float32)
    s = decontam.searched(cut, nothing, np.ones(decontam.BUCKETS, dtype=np.float32))
    texts = ["x " * 50 + "alpha beta gamma delta epsilon zeta eta theta iota kappa", "two", "words two", "a two words", "word"]
    got = [(m[0], s.item_ids[m[2]]) for m in decontam.matches(pa.array(texts), [s])]
    assert sorted(got) == [(0, 1), (3, 3), (4, 2)]
