"""Manifests against trees built from plain lists, and what tampering does to them."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tributary.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, id string, key string, pos int"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, low=False):
    doc_id, source, lang, n_chars, text = row
    if low and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def climbed(nodes):
    """Root of some digests, and for each its (before, after) on every level."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, place in enumerate(at):
            run = place - place % 8
            ways[k].append(("".join(nodes[run:place]), "".join(nodes[place + 1 : run + 8])))
            at[k] = place // 8
        nodes = [digest("".join(nodes[k : k + 8])) for k in range(0, len(nodes), 8)]
    return nodes[0], ways


def plain(rows):
    groups = {}
    for row in rows:
        groups.setdefault(b"" if row[2] is None else b"=" + row[2].encode(), []).append(row)
    trees, out = {}, []
    for group in sorted(groups):
        own = sorted(groups[group], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[group] = own, *climbed([leaf(r) for r in own])
    root, above = climbed([trees[g][1] for g in sorted(groups)])
    for k, group in enumerate(sorted(groups)):
        own, subroot, ways = trees[group]
        for row, way in zip(own, ways, strict=True):
            way = way + above[k]
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            fold = leaf(row, changed)
            for before, after in way:
                fold = digest(before + fold + after)
            out.append((row[0], leaf(row), subroot, root, digest("".join(b + a for b, a in way)), fold, fold == root))
    return sorted(out, key=str)


def made(spark, rows):
    return spark.createDataFrame([(*r, "x", None, 3) for r in rows], SCHEMA)


def check(spark, rows):
    got = merkle.verified_documents(made(spark, rows))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows)


def test_the_layout_is_a_numbering_split_at_half_height():
    for levels in range(1, 6):
        places = [merkle.address(d, np.arange(8**d), levels) for d in range(levels)]
        assert sorted(np.concatenate(places).tolist()) == list(range(merkle.nodes_of(levels)))
        upper = levels // 2
        if upper:
            top = np.concatenate([p for p in places[:upper]])
            assert sorted(top.tolist()) == list(range(merkle.nodes_of(upper)))
            # Each lower subtree is one stretch, laid out like a tree of its own.
            size = merkle.nodes_of(levels - upper)
            for s in (0, 8**upper - 1):
                for d in range(levels - upper):
                    own = places[upper + d][s * 8**d : (s + 1) * 8**d]
                    assert (own - merkle.nodes_of(upper) - s * size == merkle.address(d, np.arange(8**d), levels - upper)).all()


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 577, 4096])
def test_siblings_fold_to_the_root(n):
    leaves = [hashlib.sha256(bytes([k % 251, k // 251])).digest() for k in range(n)]
    block = merkle.build(leaves, merkle.height_of(n))
    root, ways = climbed([x.hex() for x in leaves])
    assert block.root.hex() == root
    for k in {0, n // 2, n - 1}:
        found = block.siblings(k)
        assert merkle.unpacked(merkle.packed(found)) == found
        assert merkle.folded(leaves[k], found) == block.root
        assert [others.hex() for _, others in found] == [b + a for b, a in ways[k]]


def test_nulls_ties_repeated_rows_and_many_groups(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, *range(90)]), rng.choice([None, "", "s"]), rng.choice([None, "", "=", "é", "z", "日本"]), rng.choice([None, 5]), rng.choice([None, "", "ABC é", "x" * 5000])) for _ in range(300)]
    rows += rows[:40] + [(k, "s", f"lang-{k}", 1, "One") for k in range(80)]
    check(spark, rows)


def test_groups_beyond_one_block(spark):
    """4,097 leaves: a last block of one; a third of all rows alike."""
    rows = [(k, "s", "en", 1, f"Text {k}") for k in range(4097)] + [(7, "s", "de", 1, "Same")] * 4200 + [(9000, None, "fr", None, None)]
    check(spark, rows)


def test_more_groups_than_one_block(spark):
    rows = [(k, "s", str(k), k, "T") for k in range(4200)]
    check(spark, rows)


def test_one_row_and_none(spark):
    check(spark, [(3, None, None, None, None)])
    assert merkle.verified_documents(made(spark, [])).count() == 0


def test_any_change_is_seen(spark):
    rows = [(k, "s", "en", 1, f"text {k}") for k in range(100)]
    docs = made(spark, rows)
    root = merkle.Manifest(docs, merkle.FIELDS, "doc_id", "lang").root().first()[0]
    for changed in (docs.where("doc_id <> 50"), docs.withColumn("text", F.when(F.col("doc_id") == 99, F.lit("")).otherwise(F.col("text"))), docs.union(docs.where("doc_id = 0"))):
        assert merkle.Manifest(changed, merkle.FIELDS, "doc_id", "lang").root().first()[0] != root
    assert merkle.Manifest(docs.repartition(7), merkle.FIELDS, "doc_id", "lang").root().first()[0] == root
