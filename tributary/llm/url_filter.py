"""Allow and block entries for URLs: a trie over reversed host labels and path segments, longest match first.

An entry is `host` or `host/path`. It fits a URL whose host is the entry's host or a subdomain of it and
whose path starts with the entry's path, also in the middle of a segment. Of the entries that fit, the one
with the longest host counts, of these the one with the longest path; of an allow and a block entry that
are the same, block. A URL that no entry fits gets the default, allow unless stated.

The trie goes to the executors while the entries are few: their number and bytes are counted first. Beyond
that bound the same nodes become tables and are looked up by joins, with equal results.

Results: the host is what stands between the first `://` and the next `/`, `?`, `#` or the end, A-Z in
lower case; user names and ports stay part of it. The path is what follows up to `?` or `#`, unchanged;
`http://a.org` has none, so `a.org/` does not fit it and `a.org` does. A null URL, or one without `://`,
has an empty host and path, which only an entry with neither fits. Repeated rows are each judged. Null,
and repeated entries count once or not at all; without entries every row gets the default, without rows
there are none. Other columns play no part; `allowed` gives all of them back, whatever their names.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Up to here the entries travel: about 100 bytes a node in each worker besides the text.
MOST_ENTRIES = 100_000
MOST_BYTES = 8 << 20

_URL = r"://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


class Trie:
    """Nodes are numbers; edges lead on by a host label (from the last one) or a whole path segment. What
    an entry has after its last slash may be part of a segment and is kept at the node, by its length."""

    def __init__(self, entries):
        self._edges: dict[tuple[int, str], int] = {}
        self._ends: dict[tuple[int, str], tuple[str, str]] = {}
        self._lengths: dict[int, list[int]] = {}
        lengths: dict[int, set[int]] = {}
        for rule, verdict in entries:
            host, slash, rest = rule.partition("/")
            *whole, tail = (slash + rest).split("/")
            node = 0
            for label in reversed(host.split(".") if host else []):
                node = self._edge(node, "." + label)
            for segment in whole:
                node = self._edge(node, "/" + segment)
            self._ends[node, tail] = rule, verdict
            lengths.setdefault(node, set()).add(len(tail))
        self._lengths = {node: sorted(n, reverse=True) for node, n in lengths.items()}

    def _edge(self, node: int, name: str) -> int:
        return self._edges.setdefault((node, name), len(self._edges) + 1)

    def hosts(self, host: str) -> list[int]:
        """Nodes of the host and its parent domains, the longest first."""
        nodes = [0]
        for label in reversed(host.split(".")):
            node = self._edges.get((nodes[-1], "." + label))
            if node is None:
                break
            nodes.append(node)
        return nodes[::-1]

    def below(self, node: int, segments: list[str]) -> tuple[str, str] | None:
        """The entry of this host with the longest path."""
        best = None
        for segment in segments:
            for n in self._lengths.get(node, ()):
                if n <= len(segment) and (end := self._ends.get((node, segment[:n]))):
                    best = end
                    break
            node = self._edges.get((node, "/" + segment))
            if node is None:
                break
        return best

    def find(self, nodes: list[int], path: str) -> tuple[str, str] | None:
        segments = path.split("/")
        return next((end for node in nodes if (end := self.below(node, segments))), None)


def _host(rule: str) -> Column:
    return F.substring_index(rule, "/", 1)


def _rest(rule: str) -> Column:
    """From the first slash on, slash included."""
    return F.substring(F.col(rule), F.length(_host(rule)) + 1, F.length(rule))


def _entries(rules: DataFrame) -> DataFrame:
    """rule, verdict: each entry once."""
    rule = F.concat(F.translate(_host("rule"), UPPER, LOWER), _rest("rule"))
    known = rules.where(F.col("rule").isNotNull() & F.col("verdict").isin(ALLOW, BLOCK))
    return known.groupBy(rule.alias("rule")).agg(F.max("verdict").alias("verdict"))


def _by_trie(urls: DataFrame, entries: list[tuple[str, str]]) -> DataFrame:
    trie = urls.sparkSession.sparkContext.broadcast(Trie(entries))

    @F.pandas_udf("rule string, verdict string")
    def found(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        known, nodes = trie.value, {}
        out = []
        for h, p in zip(host, path, strict=True):
            if h not in nodes:
                nodes[h] = known.hosts(h)
            out.append(known.find(nodes[h], p) or (None, None))
        return pd.DataFrame(out, columns=["rule", "verdict"], dtype=object)

    return urls.withColumn("found", found("host", "path"))


def _by_joins(urls: DataFrame, entries: DataFrame) -> DataFrame:
    """The trie's nodes as a table by host and whole segments, its ends by what follows; every distinct URL
    looks up the nodes on its way, then at each the lengths that occur there."""
    ends = entries.select("rule", "verdict", _host("rule").alias("at_host"), _rest("rule").alias("rest"))
    ends = ends.withColumn("tail", F.element_at(F.split("rest", "/"), -1)).select("rule", "verdict", "at_host", "tail", F.expr("substring(rest, 1, length(rest) - length(tail))").alias("head"))
    nodes = ends.groupBy("at_host", "head").agg(F.collect_set(F.length("tail")).alias("lengths"))
    one = urls.select("host", "path").distinct()
    labels, segments = F.split("host", r"\."), F.split("path", "/")
    ways = (
        one.select("host", "path", labels.alias("labels"), segments.alias("segments"))
        .select("host", "path", "segments", F.explode(F.expr("transform(sequence(1, size(labels) + 1), i -> array_join(slice(labels, i, size(labels)), '.'))")).alias("at_host"))
        .join(nodes.select("at_host").distinct(), "at_host", "left_semi")
        .select("host", "path", "at_host", F.explode(F.expr(
            "transform(sequence(1, size(segments)), k -> struct(array_join(slice(segments, 1, k - 1), '/') || if(k > 1, '/', '') AS head, segments[k - 1] AS segment))")).alias("at"))
        .select("host", "path", "at_host", "at.head", "at.segment")
    )
    looked = ways.join(nodes, ["at_host", "head"]).select("host", "path", "at_host", "head", "segment", F.explode("lengths").alias("n"))
    looked = looked.where(F.col("n") <= F.length("segment")).withColumn("tail", F.expr("substring(segment, 1, n)"))
    best = looked.join(ends, ["at_host", "head", "tail"]).groupBy("host", "path").agg(
        F.max_by(F.struct("rule", "verdict"), F.struct(F.length("at_host"), F.length("rule"))).alias("found"))
    return urls.join(best, ["host", "path"], "left")


def with_verdicts(rows: DataFrame, rules: DataFrame, url: str = "url", default: str = ALLOW, most_entries: int = MOST_ENTRIES) -> DataFrame:
    """row (a struct of all columns), host, path, rule (null: the default), verdict of every row; rules
    holds rule and verdict (allow or block)."""
    entries = _entries(rules)
    size = entries.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("rule")), F.lit(0))).first()
    urls = rows.select(F.struct(*[rows[c] for c in rows.columns]).alias("row"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    if size[0] <= most_entries and size[1] <= MOST_BYTES:
        judged = _by_trie(urls, [tuple(r) for r in entries.collect()])
    else:
        judged = _by_joins(urls, entries)
    return judged.select("row", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", F.lit(default)).alias("verdict"))


def verdicts(rows: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = ALLOW) -> DataFrame:
    """key, host, path, rule, verdict of every row."""
    return with_verdicts(rows.select(key, url), rules, url, default).select(f"row.{key}", "host", "path", "rule", "verdict")


def allowed(rows: DataFrame, rules: DataFrame, url: str = "url", default: str = ALLOW) -> DataFrame:
    """The rows that may stay, with their columns."""
    return with_verdicts(rows, rules, url, default).where(F.col("verdict") == ALLOW).select("row.*")


# The entries of the registered query, which SQL holds too.
ENTRIES = [("org/", ALLOW), ("example.org/es/", BLOCK), ("example.org/en/1", BLOCK), ("com/fr/", ALLOW), ("com/de/", BLOCK)]

ORACLE = r"""
WITH rules(rule, verdict) AS (
  VALUES ('org/', 'allow'), ('example.org/es/', 'block'), ('example.org/en/1', 'block'), ('com/fr/', 'allow'), ('com/de/', 'block')
), entries AS (
  SELECT rule, verdict, split_part(rule, '/', 1) AS h, substr(rule, length(split_part(rule, '/', 1)) + 1) AS p FROM rules
), urls AS (
  SELECT row_number() OVER () AS n, page_id,
    coalesce(translate(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), found AS (
  SELECT n, arg_max(struct_pack(rule := rule, verdict := verdict), length(h) * 100000 + length(p)) AS best
  FROM urls JOIN entries ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY n
)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM urls LEFT JOIN found USING (n)
"""
