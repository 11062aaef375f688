"""SQL statements: references and edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.fixed_values import ACTIVE_STATEMENT_STATES, TOPIC
from tributary.functions import sqlrefs
from tributary.functions.text import computed
from tributary.operators.edges import draft_edges


def active_statements(statements: DataFrame) -> DataFrame:
    return statements.where(F.upper("status").isin(*ACTIVE_STATEMENT_STATES))


def statement_refs(statements: DataFrame) -> DataFrame:
    """Add `inputs` and `outputs` (arrays in text order) and drop the statement text."""
    kept = [c for c in statements.columns if c != "sql_text"]
    stripped = statements.select(*kept, sqlrefs.strip_sql_comments(F.col("sql_text")).alias("_sql"))
    found = stripped.select(
        *kept, sqlrefs.extract_inputs(F.col("_sql")).alias("_read"),
        sqlrefs.extract_outputs(F.col("_sql")).alias("outputs"),
    )
    inputs = sqlrefs.drop_self_references(F.col("_read"), F.col("outputs"))
    return found.select(*kept, inputs.alias("inputs"), "outputs")


def cross_io(jobs: DataFrame) -> DataFrame:
    """Each input with each output of the same row. The arrays come from one row, so this is two
    generators in a row: nothing is shuffled and no two rows ever meet."""
    kept = [c for c in jobs.columns if c not in ("inputs", "outputs")]
    left = jobs.select(
        *kept, "outputs", F.posexplode(computed(F.col("inputs"))).alias("pos_in", "input"),
    )
    return left.select(
        *kept, "pos_in", "input", F.posexplode(computed(F.col("outputs"))).alias("pos_out", "output"),
    )


def flink_edges(statements: DataFrame) -> DataFrame:
    """A statement without both an input and an output has no edges."""
    rows = cross_io(statement_refs(active_statements(statements)))
    return draft_edges(
        rows, builder="flink", scope=F.col("env_id"),
        source=(F.col("input"), F.lit(TOPIC)), target=(F.col("output"), F.lit(TOPIC)),
        job=(F.col("name"), F.lit("flink_statement"), F.concat(F.lit("flink://"), "env_id")),
        pos_in=F.col("pos_in"), pos_out=F.col("pos_out"),
    )
