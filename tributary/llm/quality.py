"""Quality rules on DataFrame functions alone: base rules, and a likelihood ratio of hashed n-grams.

Single words and pairs of neighbouring words, in lower case, are hashed into `BUCKETS` buckets. Two
multinomials with add-one smoothing are counted over them: one of trusted documents (labelled quality
1 and not toxic), one of all documents. A document's score is the mean over its n-grams of
log(trusted / all); it is kept if no base rule rejects it and its score reaches the threshold.

The threshold comes from the data: the trusted documents are dealt into `FOLDS` parts, each is scored with
the trusted counts of the other parts, and the `QUANTILE` of these held-out scores is the threshold. So that
share of good documents is given up, and what scores below nearly all good documents goes. Documents of fewer
than LEAST_WORDS words don't count there. With fewer than `LEAST_HELD` held-out scores the quantile has no
document below it, and the threshold is `THRESHOLD`.

The corpus side counts every document, the trusted side every trusted one, and the threshold rests on all of
them. Up to `TRUSTED` ids are counted first and broadcast; more are joined by a shuffle.

Results: a null or empty text has no words, fails the base rules and has no score. A null doc_id is
never trusted. Repeated rows count, and are judged, each; a document with several labels is trusted
if one of them says so and none says toxic. Without documents there is no row; without labels the
trusted side is flat. Columns other than doc_id, text (and doc_id, quality, toxic) play no part.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.steps import Steps

BUCKETS = 1 << 14
TRUSTED = 100_000
THRESHOLD = -0.1
QUANTILE = 0.01
LEAST_HELD = 100
FOLDS = 4
LEAST_WORDS = 10
REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"

_SPACE = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, _SPACE), "")


def _with_words(docs: DataFrame) -> DataFrame:
    """row (all columns of the input), text, words."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text.alias("text")).withColumn("words", words_of(F.col("text")))


def _chained(a: str, b: str, apart: int) -> Column:
    """Hashes of all elements of a and those `apart` places on in b, as many as b has there."""
    n = F.greatest(F.size(b) - apart, F.lit(0))
    return F.zip_with(F.slice(a, 1, n), F.slice(b, apart + 1, n), lambda x, y: F.xxhash64(x, y))


def _with_windows(words: DataFrame) -> DataFrame:
    """The rows with `windows`, hashes of every WINDOW words of `words`: of words, two, four and five of them, so no word
    is hashed twice."""
    hashed = words.withColumn("ones", F.transform("words", lambda w: F.xxhash64(w)))
    hashed = hashed.withColumn("twos", _chained("ones", "ones", 1))
    hashed = hashed.withColumn("fours", _chained("twos", "twos", 2)).drop("twos")
    return hashed.withColumn("windows", _chained("fours", "ones", 4)).drop("ones", "fours")


def base_columns(docs: DataFrame) -> DataFrame:
    """row, words, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = _with_words(docs).select(
        "row", "words", F.size("words").alias("n"), lines.alias("lines"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", f"[{SYMBOLS}]", ""))).cast("long").alias("n_symbols"),
    )
    hashed = _with_windows(counted.select(
        "row", "words", "n", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    ))
    # Most documents repeat no window; the others sort theirs, so equal ones are neighbours.
    ordered = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    ordered = F.when(F.size("windows") > F.size(F.array_distinct("windows")), ordered)
    found = hashed.withColumn("ordered", ordered)
    pairs = F.zip_with(
        F.slice("ordered", 1, F.size("ordered") - 1), F.slice("ordered", 2, F.size("ordered") - 1),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])),
    )
    starts = F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull()))))
    found = found.withColumn("starts", F.when(F.col("ordered").isNotNull(), starts))
    gaps = F.zip_with(F.slice("starts", 2, F.size("starts") - 1), F.slice("starts", 1, F.size("starts") - 1), lambda b, a: F.least(b - a, F.lit(WINDOW)))
    covered = F.lit(WINDOW) + F.aggregate(gaps, F.lit(0), lambda s, g: s + g)
    judged = found.withColumn("repeats", F.when(F.col("starts").isNotNull(), covered).otherwise(0).cast("long"))
    failed = (F.col("n") < LEAST_WORDS) | (100 * F.col("repeats") > REPEAT_PERCENT * F.col("n"))
    return judged.select(
        "row", "words", F.col("n").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        F.col("repeats").alias("n_repeat_words"), failed.alias("base_failed"),
    )


def bucket_array(words: str, buckets: int = BUCKETS) -> Column:
    """Buckets of all words, then of all pairs of neighbours; the words are in lower case."""
    singles = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"))
    rest = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
    pairs = F.zip_with(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), rest,
        lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(buckets)).cast("int"),
    )
    return F.concat(singles, pairs)


def trusted_ids(labels: DataFrame, most: int | None = None) -> DataFrame:
    """Ids of all trusted documents; with `most`, those of the smallest hashes."""
    by_id = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("trusted_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max(F.coalesce(F.col("toxic"), F.lit(0))).alias("toxic")
    )
    good = by_id.where("good = 1 AND toxic = 0").select("trusted_id")
    return good if most is None else good.orderBy(F.xxhash64("trusted_id"), "trusted_id").limit(most)


def _fold() -> Column:
    """Part of a trusted document; null for the others."""
    return F.pmod(F.xxhash64("trusted_id", F.lit(1)), F.lit(FOLDS)).cast("int")


def _marked(docs: DataFrame, labels: DataFrame, how: str) -> DataFrame:
    """trusted, fold, words in lower case; `how` joins the trusted ids."""
    lowered = docs.select("doc_id", F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text"))
    ids = trusted_ids(labels)
    if ids.count() <= TRUSTED:
        ids = F.broadcast(ids)
    marked = lowered.join(ids, F.col("doc_id") == F.col("trusted_id"), how)
    trusted = F.col("trusted_id").isNotNull()
    return marked.select(trusted.alias("trusted"), F.when(trusted, _fold()).alias("fold"), words_of(F.col("text")).alias("words"))


def _gram_rows(marked: DataFrame, *columns: str, buckets: int = BUCKETS) -> DataFrame:
    """columns, bucket: a row for each word and each pair. As rows they are hashed in generated code; the last word of
    a document leads no pair."""
    after = F.slice("words", 2, F.greatest(F.size("words") - 1, F.lit(1)))
    both = F.inline(F.arrays_zip(F.concat("words", F.array().cast("array<string>")), after)).alias("word", "next")
    hashes = F.array(F.xxhash64("word"), F.when(F.col("next").isNotNull(), F.xxhash64("word", "next")))
    rows = marked.select(*columns, both).select(*columns, F.explode(hashes).alias("hash"))
    return rows.where("hash IS NOT NULL").select(*columns, F.pmod("hash", F.lit(buckets)).cast("int").alias("bucket"))


def log_ratios(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> list[list[float]]:
    """For every bucket the log of trusted over corpus probability: with all trusted documents, then
    without those of each fold. The counts, one row a bucket, meet on the driver: one pass gives all sums."""
    grams = _gram_rows(_marked(docs, labels, "left"), "trusted", "fold", buckets=buckets)
    without = [F.count_if(F.col("trusted") & (F.col("fold") != k)) for k in range(FOLDS)]
    counts = grams.groupBy("bucket").agg(F.count("*"), F.count_if("trusted"), *without).collect()
    every, *sides = ([0] * buckets for _ in range(2 + FOLDS))
    for bucket, n, *own in counts:
        every[bucket] = n
        for side, m in zip(sides, own, strict=True):
            side[bucket] = m
    every_n, good_n, out = sum(every), sum(sides[0]), []
    for side in sides:
        n = sum(side)
        # Fewer counts get a smaller addition, or held-out scores would lie below the others.
        add = n / good_n if n else 1.0
        out.append([math.log((m + add) / (n + add * buckets) / ((e + 1.0) / (every_n + buckets))) for m, e in zip(side, every, strict=True)])
    return out


def _table(ratios: list[float]) -> Column:
    """As text the numbers become a constant of the plan; subqueries can't stand in lambdas."""
    return F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")


def held_out_threshold(docs: DataFrame, labels: DataFrame, tables: list[Column]) -> float:
    """The QUANTILE of the scores of trusted documents, each under the table without its fold: the two scores that it
    lies between come from a sort by ranges, so no task holds all of them."""
    spark = docs.sparkSession
    steps, ratios = Steps(spark), []
    for k, table in enumerate(tables):
        # Written one by one: as constants of the plan below, all would be in every event that tells of it to the driver.
        ratios.append(steps.keep(spark.range(1).select(F.lit(k).alias("fold"), F.posexplode(table).alias("bucket", "ratio")), f"ratios-{k}"))
    numbered = _marked(docs, labels, "inner").select("fold", "words", F.monotonically_increasing_id().alias("row"), F.size("words").alias("n"))
    grams = _gram_rows(numbered, "fold", "row", "n").join(F.broadcast(reduce(DataFrame.union, ratios)), ["fold", "bucket"])
    # The grams of a row lie side by side, so a row's sum is made before anything is shuffled.
    sums = grams.groupBy("row", "n").agg(F.sum("ratio").alias("total"), F.count("*").alias("grams"))
    # Short ones go when the scores are read: a filter before would find the words a second time.
    scores = steps.keep(sums.select("n", (F.col("total") / F.col("grams")).alias("score")), "held-scores")
    scores = scores.where(F.col("n") >= LEAST_WORDS).select("score")
    n, cut = scores.count(), THRESHOLD
    if n >= LEAST_HELD:
        at = QUANTILE * (n - 1)
        low = math.floor(at)
        pair = [r.score for r in scores.orderBy("score").offset(low).limit(2).collect()]
        cut = pair[0] + (at - low) * (pair[-1] - pair[0])
    steps.drop("held-scores", *[f"ratios-{k}" for k in range(len(tables))])
    return cut


def scored(docs: DataFrame, labels: DataFrame, threshold: float | None = None) -> DataFrame:
    """row, the counts and verdict of the base rules, score, kept; without a threshold the held-out one is taken."""
    table, *without = map(_table, log_ratios(docs, labels))
    Steps(docs.sparkSession).drop()
    if threshold is None:
        threshold = held_out_threshold(docs, labels, without)
    based = base_columns(docs)
    lowered = based.withColumn("words", F.transform("words", F.lower))
    grams = lowered.withColumn("grams", bucket_array("words")).drop("words")
    total = F.aggregate("grams", F.lit(0.0), lambda s, b: s + F.get(table, b))
    mean = grams.withColumn("score", F.when(F.size("grams") > 0, total / F.size("grams"))).drop("grams")
    return mean.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("score") >= threshold, F.lit(False)))


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, with all their columns, that no rule rejects. A plain filter would be pushed down
    through every projection, and would find the words of a text once for each of its words."""
    judged = scored(docs, labels)
    rows = F.when(F.col("kept"), F.array("row")).otherwise(F.slice(F.array("row"), 1, 0))
    return judged.select(F.explode(F.concat(rows, F.slice(F.array("row"), 1, 0))).alias("row")).select("row.*")


def quality_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the counts and verdict of the base rules, score, kept of every document."""
    return scored(docs.select("doc_id", "text"), labels).select("row.doc_id", "*").drop("row")
