"""The pipeline against a brute-force run of its stages, and odd inputs through every stage."""

import hashlib
import os

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from test_llm_ngram_join import expected as linked
from test_llm_quality import model as judged
from tokenizers import Tokenizer

import corpus_pipeline
from tributary.llm import decontam
from tributary.llm.words import chunks

SF = "/root/testdata/sf0.001"
KINDS = "doc_id long, text string, lang string, source string, n_chars long"


def cut_passages(docs, length):
    first, split = {}, [(i, (t or "").split()) for i, t, *_ in docs]
    for i, w in split:
        for k in range(len(w) - length + 1):
            key = tuple(w[k : k + length])
            first[key] = min(i, first.get(key, i))
    for (i, w), d in zip(split, docs, strict=True):
        gone = {j for k in range(len(w) - length + 1) if first[tuple(w[k : k + length])] < i for j in range(k, k + length)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        if not gone:
            yield d
        elif kept:
            yield (i, kept, *d[2:])


def holds_item(text, items):
    (c,) = chunks(pa.array([text]), lower=True, plain=True) if text else [None]
    if c is None:
        return False
    for item, answer_at in items:
        size = len(item) + 2 * (len(item) // 4 + decontam.PASSAGE)
        if any(decontam.judged(item, answer_at, c.words[a : a + size]) for a in range(0, max(1, len(c.words) - decontam.PASSAGE), 8)):
            return True
    return False


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data here")
def test_pipeline_equals_brute_force(spark):
    read = lambda t: [tuple(r) for r in spark.read.parquet(f"{SF}/{t}.parquet").collect()]
    docs = read("documents")
    keep = {r[0] for r in judged(docs, [(*r, "t") for r in read("labels")]) if r[-1]}
    docs = [d for d in docs if d[0] in keep]
    stay = {i for i, _, c in linked(docs, 5, 80) if i == c}
    docs = list(cut_passages([d for d in docs if d[0] in stay], 50))
    items = []
    for _, text in read("benchmark"):
        (c,) = chunks(pa.array([text]), lower=True, plain=True)
        items.append((c.words, len(c.words) - min(len(c.words), decontam._answer_words(text))))
    docs = [d for d in docs if not holds_item(d[1], items)]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for d in docs:
        ids = np.array(tokenizer.encode(d[1], add_special_tokens=False).ids, "<u4").tobytes()
        want.append((d[0], len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(d[1].encode()).hexdigest(), ids))
    got = [(*r[:4], bytes(r[4])) for r in corpus_pipeline.run(spark, SF).collect()]
    assert len(want) > 50 and sorted(got) == sorted(want)


def test_stages_keep_columns_and_take_odd_rows(spark, tmp_path):
    odd = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "word " * 9000, "en", "s", 45_000), (2, "word " * 9000, "en", "s", 45_000)]
    odd += [(k, " ".join(f"w{j}" for j in range(k, k + 300)), "en", "s", 9) for k in range(10, 13)]
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, KINDS)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.dtypes == docs.dtypes
            assert out.count() <= len(rows)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == len(rows)
