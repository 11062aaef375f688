"""Preference pairs against a plain model and against the SQL."""

import os
import random

import pytest
from oracle_compare import connect, difference

from tributary.llm import preference

KINDS = "conv_id long, turn long, role string, text string, chosen int, prompt string"
SF = "/root/testdata/sf0.01"


def render(turns):
    out, spans = "", []
    for role, text in turns:
        head = f"<|im_start|>{role or ''}\n"
        if role == "assistant":
            spans.append(f"{len(out) + len(head)}-{len(out) + len(head) + len(text or '') + 10}")
        out += f"{head}{text or ''}<|im_end|>\n"
    return out, ",".join(spans)


def expected(rows):
    order = lambda r: tuple((x is not None, x if x is not None else 0) for x in r)
    held = {}
    for r in sorted({r[:4] for r in rows if r[0] is not None}, key=order):
        held.setdefault(r[0], []).append(r[2:4])
    firsts = {}
    for c in sorted(held):
        firsts.setdefault(held[c][0], []).append(c)
    pairs = {(g[0], c) for g in firsts.values() for c in g[1:]} | {(c, c + 1) for c in held if c % 2 == 0 and c + 1 in held}
    for a, b in pairs:
        x, y = held[a], held[b]
        n = 0
        while n < min(len(x), len(y)) and x[n] == y[n]:
            n += 1
        yield (a, b, n, render(x[:n])[0], *render(x[n:]), *render(y[n:]))


def turns():
    rng = random.Random(3)
    rows = [(None, 0, "user", "x"), (100, None, None, None), (101, 0, None, ""), (102, 0, "user", "é" * 9000), (102, 1, "assistant", "ü"), (102, 1, "assistant", "a"), (-4, 0, "user", "n")]
    for c in range(60):
        for k in range(rng.randint(1, 5)):
            rows.append((c, k, ["user", "assistant"][k % 2], rng.choice(["a", "b", None, "", "1:a"]) if k else rng.choice(["hi", "hot", "hot"])))
    rows += rows[20:30]
    return [(*r, 1, "p") for r in rows]


def test_model(spark):
    rows = turns()
    got = preference.preference_pairs(spark.createDataFrame(rows, KINDS).repartition(3))
    assert sorted(map(tuple, got.collect())) == sorted(expected(rows))


def test_empty_table(spark):
    assert preference.preference_pairs(spark.createDataFrame([], KINDS)).collect() == []


def test_sql_on_odd_rows(spark, tmp_path):
    df = spark.createDataFrame(turns(), KINDS)
    df.coalesce(1).write.parquet(str(tmp_path / "c"))
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/c/*.parquet')")
    assert difference(preference.preference_pairs(df), con, preference.ORACLE) is None


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data here")
def test_sql_on_the_table(spark):
    got = preference.preference_pairs(spark.read.parquet(f"{SF}/conversations.parquet"))
    assert difference(got, connect(SF), preference.ORACLE) is None
