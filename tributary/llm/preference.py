"""Preference pairs: the longest common prefix of turns as prompt, two completions with loss masks.

A pair is a chosen and a rejected conversation. The turns that both begin with are rendered once, as
the prompt; what follows in each is its completion. A mask lists the spans of a completion (begin and
end, in characters) that carry loss: the words of assistant turns and the mark that ends them.

Pairs of a table: conversations with the same first turn are paired with the smallest of them, which is
the chosen one, so a first turn shared by many gives one pair each, not all pairs; besides, every even
conversation id is the chosen one to the id after it.

Results: turns are ordered by turn, role and text, equal rows count once, and nulls come first. A null role
is rendered as an empty one, a null text as empty; as turns, nulls equal nulls only. Rows without
conv_id belong to no conversation. If a conversation is the beginning of the other, or equals it, a
completion is empty. Columns other than conv_id, turn, role and text play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, END, MODEL = "<|im_start|>", "<|im_end|>", "assistant"


def _none(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id, turns (ordered, with their rendering) and the key of the first turn."""
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
    ).distinct()
    head = F.concat(F.lit(BEGIN), _none("role"), F.lit("\n"))
    turn = F.struct(
        "turn", "role", "text",
        F.concat(head, _none("text"), F.lit(END + "\n")).alias("shown"),
        F.length(head).alias("skip"),
        (F.coalesce(F.col("role") == MODEL, F.lit(False))).alias("learn"),
    )
    held = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    # Role and text behind length marks, so that no two first turns share a key.
    one = F.col("turns")[0]
    key = F.concat(*[F.concat(F.coalesce(F.length(one[c]).cast("string"), F.lit("-")), F.lit(":"), F.coalesce(one[c], F.lit(""))) for c in ("role", "text")])
    return held.withColumn("first", F.sha2(key, 256))


def pairs_of(held: DataFrame) -> DataFrame:
    """chosen, rejected: ids of the pairs of a table, each once."""
    ids = held.select("conv_id", "first")
    least = ids.groupBy("first").agg(F.min("conv_id").alias("chosen"))
    same = ids.join(least, "first").where("conv_id <> chosen").select("chosen", F.col("conv_id").alias("rejected"))
    even = ids.where("conv_id % 2 = 0").select(F.col("conv_id").alias("chosen"), (F.col("conv_id") + 1).alias("next"))
    beside = even.join(ids.select(F.col("conv_id").alias("rejected")), F.col("next") == F.col("rejected")).select("chosen", "rejected")
    return same.union(beside).distinct()


def _mask(turns: Column) -> Column:
    """Spans of the loss in a rendering of the turns."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def add(state, t):
        end = state["at"] + F.length(t["shown"])
        span = F.concat((state["at"] + t["skip"]).cast("string"), F.lit("-"), (end - 1).cast("string"))
        return F.struct(end.alias("at"), F.when(t["learn"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"))

    return F.aggregate(turns, start, add, lambda s: F.array_join(s["spans"], ","))


def formatted(held: DataFrame, pairs: DataFrame) -> DataFrame:
    """chosen, rejected, prompt_turns, prompt and, for both, the completion and its mask."""
    a = held.select(F.col("conv_id").alias("chosen"), F.col("turns").alias("a"))
    b = held.select(F.col("conv_id").alias("rejected"), F.col("turns").alias("b"))
    both = pairs.join(a, "chosen").join(b, "rejected")
    least = F.least(F.size("a"), F.size("b"))
    equal = F.zip_with(
        F.slice("a", 1, least), F.slice("b", 1, least),
        lambda x, y: x["role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"]),
    )
    common = F.coalesce(F.nullif(F.array_position(equal, F.lit(False)).cast("int"), F.lit(0)) - 1, F.size(equal))
    found = both.withColumn("common", common)
    rest = lambda c: F.slice(c, F.col("common") + 1, F.greatest(F.size(c) - F.col("common"), F.lit(0)))
    cut = found.select("chosen", "rejected", "common", F.slice("a", F.lit(1), F.col("common")).alias("p"), rest("a").alias("a"), rest("b").alias("b"))
    shown = lambda c: F.array_join(F.transform(c, lambda t: t["shown"]), "")
    return cut.select(
        "chosen", "rejected", F.col("common").cast("long").alias("prompt_turns"), shown("p").alias("prompt"),
        shown("a").alias("chosen_text"), _mask(F.col("a")).alias("chosen_mask"),
        shown("b").alias("rejected_text"), _mask(F.col("b")).alias("rejected_mask"),
    )


def preference_pairs(turns: DataFrame) -> DataFrame:
    held = conversations(turns)
    return formatted(held, pairs_of(held))


ORACLE = f"""
WITH t AS (
  SELECT conv_id, turn, role, text,
    '{BEGIN}' || coalesce(role, '') || chr(10) AS head,
    coalesce(role = '{MODEL}', false) AS learn,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS k
  FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL)
), shown AS (SELECT *, head || coalesce(text, '') || '{END}' || chr(10) AS shown FROM t),
firsts AS (SELECT conv_id, role, text FROM t WHERE k = 1),
least AS (SELECT role, text, min(conv_id) AS chosen FROM firsts GROUP BY ALL),
pairs AS (
  SELECT l.chosen, f.conv_id AS rejected FROM firsts f JOIN least l
    ON f.role IS NOT DISTINCT FROM l.role AND f.text IS NOT DISTINCT FROM l.text WHERE f.conv_id <> l.chosen
  UNION
  SELECT a.conv_id, b.conv_id FROM firsts a JOIN firsts b ON b.conv_id = a.conv_id + 1 WHERE a.conv_id % 2 = 0
), sizes AS (SELECT conv_id, max(k) AS n FROM t GROUP BY 1),
differ AS (
  SELECT p.chosen, p.rejected, min(a.k) AS k FROM pairs p JOIN shown a ON a.conv_id = p.chosen
  JOIN shown b ON b.conv_id = p.rejected AND b.k = a.k
  WHERE a.role IS DISTINCT FROM b.role OR a.text IS DISTINCT FROM b.text GROUP BY 1, 2
), cut AS (
  SELECT p.*, coalesce(d.k - 1, least(x.n, y.n)) AS common FROM pairs p LEFT JOIN differ d USING (chosen, rejected)
  JOIN sizes x ON x.conv_id = p.chosen JOIN sizes y ON y.conv_id = p.rejected
), ends AS (
  SELECT c.chosen, c.rejected, s.conv_id, s.k, s.shown, s.head, s.learn, c.common,
    sum(CASE WHEN s.k > c.common THEN length(s.shown) ELSE 0 END) OVER (PARTITION BY c.chosen, c.rejected, s.conv_id ORDER BY s.k) AS ending
  FROM cut c JOIN shown s ON s.conv_id IN (c.chosen, c.rejected)
), made AS (
  SELECT chosen, rejected, conv_id, any_value(common) AS common,
    coalesce(string_agg(shown, '' ORDER BY k) FILTER (k <= common), '') AS prompt,
    coalesce(string_agg(shown, '' ORDER BY k) FILTER (k > common), '') AS body,
    coalesce(string_agg(CAST(ending - length(shown) + length(head) AS BIGINT) || '-' || CAST(ending - 1 AS BIGINT), ',' ORDER BY k)
      FILTER (k > common AND learn), '') AS mask
  FROM ends GROUP BY 1, 2, 3
)
SELECT a.chosen, a.rejected, CAST(a.common AS BIGINT) AS prompt_turns, a.prompt, a.body AS chosen_text, a.mask AS chosen_mask,
  b.body AS rejected_text, b.mask AS rejected_mask
FROM made a JOIN made b USING (chosen, rejected) WHERE a.conv_id = a.chosen AND b.conv_id = b.rejected
"""
