"""Repeated windows against sets of word tuples."""

import hashlib
import random

import pytest

from tributary.llm import substring, words

KINDS = "doc_id long, text string, places string, tag int, row string, n_chars long"


def expected(docs, length):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t, *_ in docs]
    for i, w in split:
        for k in range(len(w) - length + 1):
            if i is not None:
                key = tuple(w[k : k + length])
                first[key] = min(i, first.get(key, i))
    for i, w in split:
        gone = set()
        if i is not None:
            for k in range(len(w) - length + 1):
                if first[tuple(w[k : k + length])] < i:
                    gone.update(range(k, k + length))
        kept = [x for k, x in enumerate(w) if k not in gone]
        yield (i, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()), b" ".join(kept).decode()


def documents(seed):
    rng = random.Random(seed)
    alphabet = [f"w{k}" for k in range(400)] + ["é", "the", "The", "\n", "\x0b", "a\xa0b"]
    passage = rng.choices(alphabet, k=40)
    docs = [(0, None), (1, ""), (2, " \n "), (3, "one"), (None, " ".join(passage)), (None, " ".join(passage))]
    for i in range(4, 60):
        own = rng.choices(alphabet, k=rng.choice([0, 5, 12, 13, 14, 60, 300]))
        if rng.random() < 0.6:
            a = rng.randrange(30)
            at = rng.randint(0, len(own))
            own[at:at] = passage[a : a + rng.randint(1, 40)]
        if docs and rng.random() < 0.2:
            own = (docs[-1][1] or "").split(" ")
        docs.append((i, rng.choice([" ", "  ", "\n"]).join(own)))
    docs += [(60, "a " * 200), (61, "a " * 20), (61, "a " * 20), (61, "b " * 20), (62, "b " * 20), (-5, docs[40][1]), (63, "x" * 700 + " y " * 900)]
    rng.shuffle(docs)
    return [(i, t, "p", 1, "r", 7) for i, t in docs]


@pytest.mark.parametrize("length, seed, slice_bytes", [(13, 1, None), (13, 2, 64), (2, 3, None), (4, 4, 200)])
def test_removal(spark, monkeypatch, length, seed, slice_bytes):
    if slice_bytes:
        monkeypatch.setattr(words, "SLICE_BYTES", slice_bytes)
    docs = documents(seed)
    got = substring.removal_digests(spark.createDataFrame(docs, KINDS).repartition(5), length).collect()
    assert sorted(map(tuple, got), key=str) == sorted((x for x, _ in expected(docs, length)), key=str)


def test_documents_keep_columns(spark):
    docs = documents(5)
    df = spark.createDataFrame(docs, KINDS)
    got = substring.deduplicated(df)
    assert got.columns == df.columns
    want = []
    for d, ((_, n, gone, _), kept) in zip(docs, expected(docs, 13), strict=True):
        if not gone:
            want.append(d)
        elif kept:
            want.append((d[0], kept, *d[2:5], len(kept)))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("hot", [1, 8, 1000])
def test_hot_hashes_are_not_shuffled_and_none_is_lost(spark, hot):
    rng = random.Random(hot)
    rows = [(1, k, 0) for k in range(400)] + [(rng.randrange(2, 60), rng.randrange(30), k) for k in range(300)] + [(99, 5, 0), (99, 5, 1)]
    table = spark.createDataFrame(rows, "hash long, doc_id long, at long")
    shared = substring.shared_hashes(table)
    ids = {}
    for h, d, _ in rows:
        ids.setdefault(h, set()).add(d)
    counts = {h: sum(r[0] == h for r in rows) for h, s in ids.items() if len(s) > 1}
    assert {tuple(r) for r in shared.collect()} == {(h, min(ids[h]), n) for h, n in counts.items()}
    assert sum(n * hot >= sum(counts.values()) for n in counts.values()) <= hot
    got = substring.repeated(table, shared, hot)
    assert sorted(map(tuple, got.collect())) == sorted((d, a, min(ids[h])) for h, d, a in rows if h in counts)


def test_empty_table(spark):
    none = spark.createDataFrame([], KINDS)
    assert substring.removal_digests(none).collect() == [] and substring.deduplicated(none).collect() == []
