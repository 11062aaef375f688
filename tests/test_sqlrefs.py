"""Statement text -> (inputs, outputs), checked against a small regex model."""

import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tributary.fixed_values import SQL_STOP_WORDS
from tributary.operators import statements

CASES = {
    "insert": ("INSERT INTO `ol-out` SELECT a FROM `ol-in`;", ["ol-in"], ["ol-out"]),
    "join": ("insert into t select * from a join b on a.x=b.x", ["a", "b"], ["t"]),
    "ctas": ("CREATE TABLE IF NOT EXISTS `x-y` AS SELECT * FROM z", ["z"], ["x-y"]),
    "line_comment": ("-- FROM ghost\nINSERT INTO t SELECT * FROM a", ["a"], ["t"]),
    "block_comment": ("INSERT INTO t /* FROM g\nJOIN h */ SELECT * FROM a", ["a"], ["t"]),
    "self": ("INSERT INTO t SELECT * FROM t", [], ["t"]),
    "subquery": ("INSERT INTO t SELECT * FROM (SELECT * FROM a) JOIN LATERAL b ON 1=1", ["a"], ["t"]),
    "comma": ("INSERT INTO t SELECT * FROM a, b", ["a"], ["t"]),
    "qualified": ("INSERT INTO t SELECT * FROM cat.db.a", ["cat"], ["t"]),
    "cte": ("INSERT INTO t WITH c AS (SELECT * FROM a) SELECT * FROM c", ["a", "c"], ["t"]),
    "table_word": ("INSERT INTO t SELECT * FROM TABLE(x)", ["TABLE"], ["t"]),
    "word_before": ("INSERT INTO t SELECT xFROM y, 1 FROM a", ["a"], ["t"]),
    "duplicates": ("INSERT INTO t SELECT * FROM a JOIN a; INSERT INTO t SELECT 1 FROM b", ["a", "b", "a"], ["t", "t"]),
    "extract": ("INSERT INTO t SELECT EXTRACT(DAY FROM ts) FROM a", ["ts", "a"], ["t"]),
    "nothing": ("SELECT 1", [], []),
    "unicode_space": ("INSERT INTO t SELECT * FROM `ü-topic`", ["ü-topic"], ["t"]),
    "keyword_name": ("INSERT INTO t SELECT * FROM FROM a JOIN JOIN b", ["FROM", "JOIN"], ["t"]),
}


def model(sql):
    sql = re.sub(r"/\*.*?\*/", " ", re.sub(r"--[^\n]*", " ", sql), flags=re.S)
    name = r"(?:`([^`]+)`|([A-Za-z_][A-Za-z0-9_\-]*))"
    pick = lambda pattern: [a or b for a, b in re.findall(pattern + name, sql, re.I)]
    outs = pick(r"(?:INSERT\s+INTO|CREATE\s+TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?)\s*")
    ins = pick(r"(?<!\w)FROM\s+") + pick(r"(?<!\w)JOIN\s+")
    return [n for n in ins if n.upper() not in SQL_STOP_WORDS and n not in outs], outs


def refs(spark, sqls):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sqls)], "name int, sql_text string")
    found = statements.statement_refs(df).orderBy("name").collect()
    return [(r.inputs, r.outputs) for r in found]


def test_cases(spark):
    got = refs(spark, [c[0] for c in CASES.values()])
    for (name, (sql, ins, outs)), found in zip(CASES.items(), got):
        assert found == (ins, outs), name
        assert model(sql) == (ins, outs), name


@settings(max_examples=12, deadline=None)
@given(st.lists(
    st.lists(st.sampled_from(
        ["FROM", "from", "JOIN", "INSERT INTO", "CREATE TABLE", "IF NOT EXISTS", "`a-b`", "`c d`", "x_1", "t-2",
         "SELECT", "--c\n", "/*", "*/", ",", "(", ")", "\n", "ON", "lateral", "9z"]), max_size=14).map(" ".join),
    min_size=60, max_size=60))
def test_equals_model(spark, sqls):
    for sql, found in zip(sqls, refs(spark, sqls)):
        assert found == model(sql), sql


def test_edges_need_both_sides_and_an_active_state(spark):
    df = spark.createDataFrame([
        ("a", "e", "running", "INSERT INTO o SELECT * FROM i JOIN j"),
        ("b", "e", "STOPPED", "INSERT INTO o SELECT * FROM i; INSERT INTO p SELECT 1"),
        ("c", "e", "FAILED", "INSERT INTO o SELECT * FROM i"),
        ("d", "e", "RUNNING", "SELECT * FROM i"),
        ("f", "e", "RUNNING", "INSERT INTO o SELECT * FROM o"),
    ], "name string, env_id string, status string, sql_text string")
    got = sorted((r.job_name, r.source_name, r.target_name) for r in statements.flink_edges(df).collect())
    assert got == [("a", "i", "o"), ("a", "j", "o"), ("b", "i", "o"), ("b", "i", "p")]


def test_regexes_run_once(spark):
    """The generators must not pull a second copy of the regular expressions to the scan."""
    df = spark.range(1).select(F.col("id").cast("string").alias("name"), F.lit("e").alias("env_id"),
                               F.lit("RUNNING").alias("status"), F.col("id").cast("string").alias("sql_text"))
    plan = statements.flink_edges(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 3
