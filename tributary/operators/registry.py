"""Schema registry: latest versions, fields of every schema as rows, schemas per topic.

Schema texts are flattened level by level: one round turns each open node of each schema into
finished text or into open nodes one level further down, for all schemas at once. A round is
one scan-and-explode without a shuffle; the loop ends when nothing is open.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.fixed_values import PROTOBUF_DESCRIPTION_CHARS
from tributary.session import write_and_reload

SUBJECT = ["env_id", "subject", "version"]
FIELD_COLUMNS = [*SUBJECT, "path", "names", "depth", "pos", "name", "type", "description"]


def latest_schema_version(subjects: DataFrame) -> DataFrame:
    values = [c for c in subjects.columns if c not in ("env_id", "subject")]
    return subjects.groupBy("env_id", "subject").agg(
        F.max_by(F.struct(*values), "version").alias("r"),
    ).select("env_id", "subject", "r.*")


# --- JSON nodes travel as JSON text; the first character tells their kind -----------------------
#
# Rounds are written as SQL text: one parse instead of hundreds of calls per round.

def _json_at(v: str, path: str) -> str:
    return f"to_json(try_variant_get({v}, '{path}', 'variant'))"


def _text_at(v: str, path: str) -> str:
    return f"try_variant_get({v}, '{path}', 'string')"


def _items_at(v: str, path: str) -> str:
    return f"try_variant_get({v}, '{path}', 'array<variant>')"


def _string_at(v: str, path: str) -> str:
    """The text at a path if it is a JSON string, else NULL."""
    return f"CASE WHEN startswith({_json_at(v, path)}, '\"') THEN {_text_at(v, path)} END"


# --- Avro ---------------------------------------------------------------------------------------

def _node(status: str, path="path", names="names", about="description", ord_="ord", pre="pre",
          node="CAST(NULL AS STRING)", suf="''", live="live") -> str:
    return (
        f"named_struct('status', '{status}', 'path', {path}, 'names', {names}, 'description', {about},"
        f" 'ord', {ord_}, 'pre', {pre}, 'node', {node}, 'suf', {suf}, 'live', {live})"
    )


def _done(text: str) -> str:
    return f"array({_node('done', pre=f'concat(pre, coalesce({text}, {chr(39) * 2}), suf)')})"


def _go_on(child: str, before: str = "", after: str = "") -> str:
    return f"array({_node('open', pre=f'concat(pre, {before!r})', node=child, suf=f'concat({after!r}, suf)')})"


def _record_fields(record: str, path: str, names: str) -> str:
    """Open nodes for the named fields of a record, in order; what is no object has no name."""
    named = (
        f"filter({_items_at(record, '$.fields')},"
        f" f -> coalesce({_text_at('f', '$.name')}, '') <> '')"
    )
    node = _node(
        "open", f"concat({path}, array(i))", f"concat({names}, array({_text_at('f', '$.name')}))",
        _text_at("f", "$.doc"), "CAST(array() AS array<int>)", "''", _json_at("f", "$.type"), "''", "true",
    )
    return f"coalesce(transform({named}, (f, i) -> {node}), array())"


_UNION = "transform(branches, (x, i) -> " + _node(
    "open", ord_="concat(ord, array(i))",
    pre="CASE WHEN i = 0 THEN concat(pre, 'union<') ELSE ' | ' END", node="x",
    suf="CASE WHEN i = size(branches) - 1 THEN concat('>', suf) ELSE '' END", live="false",
) + ")"

_AVRO_STEP = f"""
    CASE
      WHEN startswith(node, '"') THEN {_done(_text_at('v', '$'))}
      WHEN size(known) = 1 THEN {_go_on('known[0]')}
      WHEN size(branches) = 0 THEN {_done("'union<>'")}
      WHEN branches IS NOT NULL THEN {_UNION}
      WHEN kind = 'record' THEN concat(
        {_done(f"concat('record<', coalesce({_text_at('v', '$.name')}, ''), '>')")},
        CASE WHEN live THEN {_record_fields('v', 'path', 'names')} ELSE array() END)
      WHEN kind = 'array' THEN {_go_on(_json_at('v', '$.items'), 'array<', '>')}
      WHEN kind = 'map' THEN {_go_on(_json_at('v', '$.values'), 'map<string,', '>')}
      WHEN kind = 'enum' THEN {_done(
        "concat('enum<', coalesce(array_join(try_variant_get(v, '$.symbols', 'array<string>'), ','), ''), '>')")}
      WHEN kind = 'fixed' THEN {_done(f"concat('fixed<', coalesce({_text_at('v', '$.size')}, '?'), '>')")}
      WHEN kind IS NOT NULL THEN {_done(
        f"concat(kind, coalesce(concat('(', nullif({_text_at('v', '$.logicalType')}, ''), ')'), ''))")}
      ELSE {_done("'unknown'")}
    END"""


def _avro_round(frontier: DataFrame) -> DataFrame:
    """Finish each open node or replace it by the nodes one level down."""
    rows = frontier.selectExpr("*", "try_parse_json(node) AS v").selectExpr(
        "*",
        f"CASE WHEN startswith(node, '{{') THEN {_string_at('v', '$.type')} END AS kind",
        f"CASE WHEN startswith(node, '[') THEN transform({_items_at('v', '$')}, x -> to_json(x)) END AS branches",
    ).selectExpr("*", """filter(branches, x -> x <> '"null"') AS known""")
    return rows.selectExpr(*SUBJECT, f"inline({_AVRO_STEP})")


def _avro_fields(subjects: DataFrame) -> DataFrame:
    """Fields of top-level records. A type is rendered in pieces: arrays, maps and single unions
    extend the text around their inner type, a wider union opens one piece per branch, ordered by
    `ord`. Nested fields are followed except below a wider union."""
    top = subjects.where(F.col("schema_type") == "AVRO").selectExpr(
        *SUBJECT, "try_parse_json(schema_text) AS v",
    ).where(f"{_string_at('v', '$.type')} = 'record'")
    fields = _record_fields("v", "CAST(array() AS array<int>)", "CAST(array() AS array<string>)")
    table = write_and_reload(top.selectExpr(*SUBJECT, f"inline({fields})"), "avro-0")
    tables = []
    while True:
        frontier = table.where(F.col("status") == "open")
        if frontier.isEmpty():
            break
        table = write_and_reload(_avro_round(frontier), f"avro-{len(tables) + 1}")
        tables.append(table.where(F.col("status") == "done"))
    pieces = reduce(DataFrame.union, tables) if tables else table.where(F.col("status") == "done")
    head = [*SUBJECT, "path", "names"]
    whole = pieces.where(F.size("ord") == 0).select(*head, F.col("pre").alias("type"), "description")
    # Pieces of one field come from one schema text, so these groups are as small as that text.
    glued = pieces.where(F.size("ord") > 0).groupBy(*head).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("ord", "pre"))), lambda p: p["pre"]), "",
        ).alias("type"),
        F.max("description").alias("description"),
    )
    return _with_position(whole.unionByName(glued))


def _with_position(fields: DataFrame) -> DataFrame:
    return fields.select(
        *SUBJECT, "path", "names", F.size("path").alias("depth"),
        F.element_at("path", -1).alias("pos"), F.element_at("names", -1).alias("name"),
        "type", "description",
    )


# --- JSON Schema --------------------------------------------------------------------------------

# How a list of type names prints.
_PRINTED_LIST = (
    f"concat('[', array_join(transform({_items_at('v', '$.items.type')}, x ->"
    f" CASE WHEN startswith(to_json(x), '\"') THEN concat('\\'', {_text_at('x', '$')}, '\\'') ELSE to_json(x) END), ', '), ']')"
)
_PROPERTY_TYPE = f"""
    CASE
      WHEN own IS NULL THEN 'unknown' WHEN own = 'null' THEN 'None'
      WHEN startswith(own, '[') THEN array_join(transform({_items_at('v', '$.type')}, x ->
        CASE WHEN to_json(x) = 'null' THEN 'None' ELSE {_text_at('x', '$')} END), ' | ')
      WHEN startswith(own, '"') THEN {_text_at('v', '$.type')} ELSE own
    END"""
_ITEM_TYPE = f"""
    CASE
      WHEN NOT startswith(items, '{{') THEN 'unknown' WHEN item IS NULL OR item = 'null' THEN 'None'
      WHEN startswith(item, '"') THEN {_text_at('v', '$.items.type')}
      WHEN startswith(item, '[') THEN {_PRINTED_LIST} ELSE item
    END"""
_CHILD = """
    CASE
      WHEN ptype = 'object' THEN get_json_object(raw, '$.properties')
      WHEN ptype = 'array' AND item = '"object"' THEN get_json_object(raw, '$.items.properties')
    END"""


def _json_round(frontier: DataFrame) -> DataFrame:
    """Properties of each open object, in the order of the text. Two maps are read from the same
    text: one keeps nested text as it is, the other tells strings from objects."""
    entries = frontier.selectExpr(
        *SUBJECT, "path AS above", "names AS names_above",
        "from_json(props, 'map<string,string>') AS raw", "from_json(props, 'map<string,variant>') AS typed",
    ).selectExpr(
        *SUBJECT, "above", "names_above",
        "posexplode(transform(map_keys(raw), (k, i) -> named_struct("
        "'name', k, 'raw', map_values(raw)[i], 'kind', to_json(map_values(typed)[i])))) AS (pos, e)",
    ).where("startswith(e.kind, '{')")
    rows = entries.selectExpr(
        *SUBJECT, "concat(above, array(pos)) AS path", "concat(names_above, array(e.name)) AS names",
        "e.raw AS raw", "try_parse_json(e.raw) AS v",
    ).selectExpr(
        "*", f"{_json_at('v', '$.type')} AS own", f"{_json_at('v', '$.items')} AS items",
        f"{_json_at('v', '$.items.type')} AS item",
    ).selectExpr("*", f"{_PROPERTY_TYPE} AS ptype").selectExpr("*", f"{_CHILD} AS child")
    return rows.selectExpr(
        *SUBJECT, "path", "names",
        f"CASE WHEN ptype = 'array' THEN concat('array<', {_ITEM_TYPE}, '>') ELSE ptype END AS type",
        f"{_text_at('v', '$.description')} AS description",
        "CASE WHEN startswith(child, '{') THEN child END AS props",
    )


def _json_fields(subjects: DataFrame) -> DataFrame:
    frontier = subjects.where(F.col("schema_type") == "JSON").selectExpr(
        *SUBJECT, "CAST(array() AS array<int>) AS path", "CAST(array() AS array<string>) AS names",
        "get_json_object(schema_text, '$.properties') AS props", "try_parse_json(schema_text) AS v",
    ).where("startswith(props, '{') AND v IS NOT NULL").drop("v")
    tables = []
    while True:
        table = write_and_reload(_json_round(frontier), f"json-{len(tables)}")
        tables.append(table.drop("props"))
        frontier = table.where(F.col("props").isNotNull())
        if frontier.isEmpty():
            return _with_position(reduce(DataFrame.unionByName, tables))


# --- All schema types ---------------------------------------------------------------------------

def _protobuf_fields(subjects: DataFrame) -> DataFrame:
    """Protobuf texts are shown as one opaque field."""
    return subjects.where(F.col("schema_type") == "PROTOBUF").select(
        *SUBJECT, F.array(F.lit(0)).alias("path"), F.array(F.lit("<protobuf>")).alias("names"),
        F.lit(1).alias("depth"), F.lit(0).alias("pos"), F.lit("<protobuf>").alias("name"),
        F.lit("protobuf").alias("type"),
        F.substring("schema_text", 1, PROTOBUF_DESCRIPTION_CHARS).alias("description"),
    )


def _spread(subjects: DataFrame) -> DataFrame:
    """The schemas over all cores: texts compress so well that a scan gives very many of them to one task, while each
    takes much work in every round. The written rounds keep the number of tasks."""
    tasks = 4 * subjects.sparkSession.sparkContext.defaultParallelism
    return write_and_reload(subjects.select(*SUBJECT, "schema_type", "schema_text").repartition(tasks, "schema_text", *SUBJECT), "schemas")


def flatten_schemas(subjects: DataFrame) -> DataFrame:
    """Every field of every schema: (env_id, subject, version, path, names, depth, pos, name, type,
    description). `path` holds positions, `names` the field names from the top. Texts that do not
    parse, and schemas that are not records or objects, have no fields."""
    subjects = _spread(subjects)
    parts = [_avro_fields(subjects), _json_fields(subjects), _protobuf_fields(subjects)]
    return reduce(DataFrame.unionByName, [p.select(*FIELD_COLUMNS) for p in parts])


def _with_topic(rows: DataFrame) -> DataFrame:
    """Split subjects of the form `<topic>-key` / `<topic>-value`; others belong to no topic."""
    part = F.when(F.col("subject").endswith("-key"), "key").when(F.col("subject").endswith("-value"), "value")
    return rows.withColumn("part", part).where(F.col("part").isNotNull()).withColumn(
        "topic", F.expr("left(subject, length(subject) - length(part) - 1)"),
    )


def topics_with_schema(topics: DataFrame, latest: DataFrame) -> DataFrame:
    """Topics of the graph that have a key or a value subject in their environment."""
    subjects = _with_topic(latest)
    by_topic = subjects.groupBy("env_id", "topic").agg(*[
        F.max(F.when(F.col("part") == part, F.col(c))).alias(f"{part}_{c}")
        for part in ("key", "value") for c in ("subject", "schema_type")
    ])
    return topics.join(by_topic, ["env_id", "topic"])


def schema_facet_fields(fields: DataFrame) -> DataFrame:
    """Fields per topic. Only top-level names carry the `key.` / `value.` prefix."""
    rows = _with_topic(fields)
    name = F.when(F.col("depth") == 1, F.concat_ws(".", "part", "name")).otherwise(F.col("name"))
    return rows.select("env_id", "topic", "part", "path", "depth", name.alias("name"), "type", "description")


def schema_facets(fields: DataFrame) -> DataFrame:
    """(env_id, topic, fields_json): the nested field list of each topic, key fields first.

    Children are folded into their parents from the deepest level upwards. All groups here lie
    within one schema text.
    """
    rows = schema_facet_fields(fields)
    head = ["env_id", "topic", "part"]
    own = F.to_json(F.struct("name", "type", "description"))
    rows = write_and_reload(rows.select(*head, "path", "depth", own.alias("own")), "facet-fields")
    deepest = rows.agg(F.max("depth")).first()[0] or 0
    children = None
    for level in range(deepest, 0, -1):
        here = rows.where(F.col("depth") == level)
        if children is not None:
            here = here.join(children, [*head, "path"], "left")
            nested = F.concat(F.expr("left(own, length(own) - 1)"), F.lit(',"fields":['), "inner", F.lit("]}"))
            here = here.withColumn("own", F.when(F.col("inner").isNotNull(), nested).otherwise(F.col("own")))
        above = F.slice("path", 1, level - 1) if level > 1 else F.array().cast("array<int>")
        children = here.groupBy(*head, above.alias("path")).agg(_joined("path").alias("inner"))
    if children is None:
        return rows.select("env_id", "topic", F.col("own").alias("fields_json")).limit(0)
    by_part = children.select("env_id", "topic", F.struct("part", "inner").alias("p"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["inner"]), ",")
    return by_part.groupBy("env_id", "topic").agg(
        F.concat(F.lit("["), listed, F.lit("]")).alias("fields_json"),
    )


def _joined(order: str) -> Column:
    ordered = F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), F.col("own").alias("own"))))
    return F.array_join(F.transform(ordered, lambda c: c["own"]), ",")


def schema_drift(old: DataFrame, new: DataFrame) -> DataFrame:
    """Fields that differ between two field tables, matched by subject and name path."""
    on = ["env_id", "subject", "names"]
    both = old.select(*on, F.col("type").alias("old_type")).join(
        new.select(*on, F.col("type").alias("new_type")), on, "full_outer",
    )
    change = (
        F.when(F.col("old_type").isNull(), "added").when(F.col("new_type").isNull(), "removed")
        .when(F.col("old_type") != F.col("new_type"), "retyped")
    )
    return both.withColumn("change", change).where("change IS NOT NULL")
