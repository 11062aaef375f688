"""Quality rules against a plain model of the counts, the hashes and the ratio."""

import math
import random
import re

import pytest
import xxhash

from tributary.llm import quality

KINDS = "doc_id long, text string, words string, row int, n string"
LABELS = "doc_id long, quality int, toxic int, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def hashed(*parts):
    seed = 42
    for p in parts:
        seed = xxhash.xxh64_intdigest(p.encode(), seed=seed)
    return seed - (1 << 64) if seed >> 63 else seed


def grams(text):
    w = WORD.findall(text.lower())
    return [hashed(x) % quality.BUCKETS for x in w] + [hashed(a, b) % quality.BUCKETS for a, b in zip(w, w[1:], strict=False)]


def base(text):
    w = WORD.findall(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    covered = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def model(docs, labels):
    good = {i for i, *_ in labels if i is not None and any(x[:2] == (i, 1) for x in labels) and not any(x[0] == i and x[2] for x in labels)}
    every, trusted = [0] * quality.BUCKETS, [0] * quality.BUCKETS
    for i, t, *_ in docs:
        for g in grams(t or ""):
            every[g] += 1
            trusted[g] += i in good
    n, m = sum(every) + quality.BUCKETS, sum(trusted) + quality.BUCKETS
    ratio = [math.log((a + 1) / m / ((b + 1) / n)) for a, b in zip(trusted, every, strict=True)]
    for i, t, *_ in docs:
        g = grams(t or "")
        score = sum(ratio[x] for x in g) / len(g) if g else None
        b = base(t or "")
        yield (i, *b, score, not b[-1] and score is not None and score >= quality.THRESHOLD)


def documents():
    rng = random.Random(4)
    out = [(1, None), (2, ""), (3, " \n\t"), (4, "a b c d e a b c d e"), (5, "x" * 5000), (6, "w " * 3000), (None, "no id " * 4)]
    words = ["Ein", "der", "ünd", "a b", "#x", "<p>", "d|e", "x\n\ny", "A!!", "z", "\x0b", "\n", "漢字", "\x1cq"]
    for i in range(7, 90):
        out.append((i, " ".join(rng.choices(words, k=rng.randint(0, 60)))))
    line = "one two three four five six seven"
    out += [(90, f"{line}\n{line}\n \n{line} "), (91, f"{line} eight nine ten eleven {line}"), (91, f"{line} eight nine ten eleven {line}"), (92, " ".join(map(str, range(900))))]
    return [(i, t, "x", 1, None) for i, t in out]


LABELLED = [(i, int(i % 3 > 0), int(i % 7 == 0), "t") for i in range(1, 60)] + [(8, 1, 1, "t"), (None, 1, 0, "t"), (500, 1, 0, None), (11, None, None, None)]


def same(got, want):
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=str), sorted(want, key=str), strict=True):
        assert g[:7] == w[:7] and g[8] == w[8], (g, w)
        assert g[7] == w[7] or math.isclose(g[7], w[7], abs_tol=1e-9)


COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")


@pytest.mark.parametrize("labels", [LABELLED, []])
def test_model(spark, labels):
    docs = documents()
    got = quality.quality_table(spark.createDataFrame(docs, KINDS).repartition(4), spark.createDataFrame(labels, LABELS))
    same([tuple(r) for r in got.select(*COLUMNS).collect()], list(model(docs, labels)))


def test_kept_documents_keep_their_columns(spark):
    docs = documents()
    df = spark.createDataFrame(docs, KINDS)
    kept = quality.kept_documents(df, spark.createDataFrame(LABELLED, LABELS))
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == sorted(w[0] or 0 for w in model(docs, LABELLED) if w[-1])


def test_empty_tables(spark):
    assert quality.quality_table(spark.createDataFrame([], KINDS), spark.createDataFrame([], LABELS)).collect() == []


def test_trusted_ids_are_bounded(spark):
    labels = spark.createDataFrame([(i, 1, 0, "") for i in range(50)], LABELS)
    some = {r.trusted_id for r in quality.trusted_ids(labels, 10).collect()}
    assert len(some) == 10 and some == {r.trusted_id for r in quality.trusted_ids(labels.repartition(3), 10).collect()}


def test_runs_without_python(spark):
    docs, labels = spark.createDataFrame(documents(), KINDS), spark.createDataFrame(LABELLED, LABELS)
    plan = quality.quality_table(docs, labels)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_threshold_parts_kept_from_rejected(spark):
    rng = random.Random(6)
    docs, labels = [], []
    for i in range(900):
        words = [f"g{rng.randrange(30)}" for _ in range(200)]
        if i >= 600:  # few poor words, so the mean stays above the fixed threshold
            for k in rng.sample(range(200), 2):
                words[k] = f"p{rng.randrange(5)}"
        docs.append((i, " ".join(words), "x", 1, None))
        if i % 2:
            labels.append((i, int(i < 600), 0, "t"))
    frames = spark.createDataFrame(docs, KINDS).repartition(3), spark.createDataFrame(labels, LABELS)
    fixed, kept = ({r.row.doc_id for r in quality.scored(*frames, threshold=t).where("kept").collect()} for t in (quality.THRESHOLD, None))
    assert sum(i >= 600 for i in fixed) >= 0.5 * 300
    assert sum(i >= 600 for i in kept) <= 0.25 * 300 and sum(i < 600 for i in kept) >= 0.95 * 600


def test_few_trusted_documents_leave_the_fixed_threshold(spark):
    docs = [(i, " ".join(f"w{i * 7 % 13 + k}" for k in range(20)), "x", 1, None) for i in range(60)]
    labels = [(i, 1, 0, "t") for i in range(60)]
    frames = spark.createDataFrame(docs, KINDS), spark.createDataFrame(labels, LABELS)
    tables = [quality._table([0.5] * quality.BUCKETS)] * quality.FOLDS
    assert quality.held_out_threshold(*frames, tables) == quality.THRESHOLD


def test_all_trusted_documents_count_beyond_those_whose_ids_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(quality, "TRUSTED", 5)
    docs = documents()
    got = quality.quality_table(spark.createDataFrame(docs, KINDS).repartition(4), spark.createDataFrame(LABELLED, LABELS))
    same([tuple(r) for r in got.select(*COLUMNS).collect()], list(model(docs, LABELLED)))
    many = spark.range(100_003).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    assert quality.trusted_ids(many).count() == 100_003


def test_threshold_is_the_quantile_of_all_scores(spark):
    docs = [(i, " ".join(f"v{i}" if k == 0 else f"w{i * k % 50}" for k in range(30)), "x", 1, None) for i in range(150)]
    frames = spark.createDataFrame(docs, KINDS).repartition(3), spark.createDataFrame([(i, 1, 0, "t") for i in range(150)], LABELS)
    ratios = [math.sin(b) for b in range(quality.BUCKETS)]
    scores = sorted(sum(ratios[g] for g in grams(t)) / len(grams(t)) for _, t, *_ in docs)
    want = scores[1] + 0.49 * (scores[2] - scores[1])
    assert math.isclose(quality.held_out_threshold(*frames, [quality._table(ratios)] * quality.FOLDS), want, rel_tol=1e-9)


def test_scores_cost_one_pass_over_the_words(spark, monkeypatch):
    """No plan that is run finds the words of a text, or their grams, more than once."""
    plans = []
    keep = quality.Steps.keep
    monkeypatch.setattr(quality.Steps, "keep", lambda self, df, *a: plans.append(df) or keep(self, df, *a))
    docs = spark.createDataFrame([(i, f"w{i % 7} x y z " * 5, "x", 1, None) for i in range(130)], KINDS)
    labels = spark.createDataFrame([(i, 1, 0, "t") for i in range(130)], LABELS)
    table = quality._table([0.5] * 4)
    quality.held_out_threshold(docs, labels, [table] * quality.FOLDS)
    plan = plans[-1]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 1 and plan.count("xxhash64(word") == 2


def test_plans_of_the_threshold_hold_one_table_at_most(spark, monkeypatch):
    """The driver keeps and tells of every plan as text, anew with each stage."""
    plans = []
    keep = quality.Steps.keep
    monkeypatch.setattr(quality.Steps, "keep", lambda self, df, *a: plans.append(df) or keep(self, df, *a))
    docs = spark.createDataFrame([(i, f"w{i % 7} x y z " * 5, "x", 1, None) for i in range(130)], KINDS)
    labels = spark.createDataFrame([(i, 1, 0, "t") for i in range(130)], LABELS)
    tables = [quality._table([k + 0.125] * quality.BUCKETS) for k in range(quality.FOLDS)]
    quality.held_out_threshold(docs, labels, tables)
    texts = [df._jdf.queryExecution().executedPlan().toString() for df in plans]
    assert all(sum(f"{k}.125" in text for k in range(quality.FOLDS)) <= 1 for text in texts)
    assert len(texts[-1]) < 20_000


def test_windows_are_equal_where_their_words_are(spark):
    rng = random.Random(9)
    docs = [(i, [rng.choice("abc") for _ in range(i)]) for i in range(40)]
    for r in quality._with_windows(spark.createDataFrame(docs, "id int, words array<string>")).collect():
        want = [tuple(r.words[i : i + 5]) for i in range(len(r.words) - 4)]
        assert len(r.windows) == len(want) and len(set(zip(r.windows, want, strict=True))) == len(set(r.windows)) == len(set(want))
