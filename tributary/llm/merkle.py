"""A dataset manifest: one hash tree per group of rows and one over the groups, with a proof for every row.

Rows of a group, in ascending order of their id, are the leaves; every 8 consecutive nodes become the hash
of their digests (the last run may hold fewer, even one) while there are several. What remains is the
group's subroot; the subroots, in order of the groups, are joined the same way to the root. Hashes are
SHA-256 of the digests written one after another as lower-case hex.

A tree is cut into aligned blocks of four levels (4,096 leaves), each built in one task; the roots of the
blocks are the leaves of the next round, until one is left. A block stores its nodes in the van Emde Boas
order: its levels are split at half height, first the upper part, then the lower subtrees from left to
right, each split in the same way. The address of a node follows by arithmetic from its level and number,
whatever the sizes of caches; construction and the retrieval of siblings both use it. Positions come from
a sort by ranges and the counts of its parts, so no group of rows is ever in one task.

Results: null fields have a text of their own, so null and empty differ; the group null comes first. Rows
without id come first in their group, rows of equal id in the order of their digests. Repeated rows are
leaves of their own. Texts are hashed whole by Spark and travel no further. An empty table has no rows in
the manifest and no root. Columns other than the named ones play no part, whatever their names.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.steps import Steps

ARITY = 8
BLOCK_LEVELS = 4
BLOCK = ARITY**BLOCK_LEVELS
HASH = 32


def field_text(value: Column) -> Column:
    """- for null, else the count of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field_text, fields)), 256))


def joined(digests: bytes) -> bytes:
    """The digest of a run of digests."""
    return hashlib.sha256(digests.hex().encode()).digest()


# --- Layout of one block -------------------------------------------------------------------------

def nodes_of(levels: int) -> int:
    """Nodes of a complete tree with so many levels of nodes."""
    return (ARITY**levels - 1) // (ARITY - 1)


def address(depth: int, index: np.ndarray, levels: int) -> np.ndarray:
    """Places of the nodes `index` of one level (0: the root) in the van Emde Boas order of a tree with so many levels of nodes."""
    place = np.zeros_like(index)
    while levels > 1:
        upper = levels // 2
        if depth < upper:
            levels = upper
            continue
        depth, levels = depth - upper, levels - upper
        place += nodes_of(upper) + index // ARITY**depth * nodes_of(levels)
        index = index % ARITY**depth
    return place


@lru_cache(maxsize=64)
def addresses(depth: int, levels: int) -> np.ndarray:
    """Places of all nodes of one level."""
    return address(depth, np.arange(ARITY**depth), levels)


def height_of(n: int) -> int:
    """Rounds of joining until n nodes are one."""
    height = 0
    while n > 1:
        n, height = -(-n // ARITY), height + 1
    return height


class Block(NamedTuple):
    """An aligned subtree: its nodes in van Emde Boas order and the number of its leaves."""

    nodes: bytes
    height: int
    n: int

    @property
    def root(self) -> bytes:
        return self.nodes[:HASH]

    def siblings(self, leaf: int) -> list[tuple[int, bytes]]:
        """For each level upwards: the place in the run, and the digests of the run's others."""
        out, n = [], self.n
        for depth in range(self.height, 0, -1):
            first = leaf - leaf % ARITY
            run = addresses(depth, self.height + 1)[first : min(n, first + ARITY)].tolist()
            del run[leaf - first]
            out.append((leaf - first, b"".join([self.nodes[a * HASH : (a + 1) * HASH] for a in run])))
            leaf, n = leaf // ARITY, -(-n // ARITY)
        return out


def build(leaves: list[bytes], height: int) -> Block:
    """The block over some leaves; beyond one run, height says how often runs are joined."""
    nodes = np.zeros((nodes_of(height + 1), HASH), dtype=np.uint8)
    level = leaves
    for depth in range(height, -1, -1):
        nodes[addresses(depth, height + 1)[: len(level)]] = np.frombuffer(b"".join(level), dtype=np.uint8).reshape(-1, HASH)
        if depth:
            level = [joined(b"".join(level[k : k + ARITY])) for k in range(0, len(level), ARITY)]
    return Block(nodes.tobytes(), height, len(leaves))


def packed(siblings: list[tuple[int, bytes]]) -> bytes:
    """A proof as bytes: for each level the place, the number of others, their digests."""
    return b"".join([bytes((place, len(others) // HASH)) + others for place, others in siblings])


def unpacked(proof: bytes) -> list[tuple[int, bytes]]:
    out, at = [], 0
    while at < len(proof):
        end = at + 2 + proof[at + 1] * HASH
        out.append((proof[at], proof[at + 2 : end]))
        at = end
    return out


def folded(leaf: bytes, siblings: list[tuple[int, bytes]]) -> bytes:
    """The root that follows from a leaf and its siblings."""
    for place, others in siblings:
        leaf = joined(others[: place * HASH] + leaf + others[place * HASH :])
    return leaf


# --- Forests as tables ----------------------------------------------------------------------------

def _group_key(group: Column) -> Column:
    """A text for every group that sorts like the group, null first, and is never null itself."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def _positions(steps: Steps, rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """rows with pos (place in its key's ascending order) and n (rows of the key).

    The rows are dealt by ranges of (key, order); a place in the whole follows from the counts of the
    parts. The last part of the order is a number of each row's own, so that even equal rows can be dealt
    to several tasks.
    """
    parts = rows.repartitionByRange("key", *order, "row").sortWithinPartitions("key", *order, "row")
    dealt = steps.keep(parts.withColumn("at", F.monotonically_increasing_id()), name)
    part = F.shiftright("at", 33)
    counts = dealt.groupBy("key", part.alias("part")).agg(F.count("*").alias("own"), F.min("at").alias("first"))
    # At most one row for each part and key: a key's window holds as many rows as there are parts.
    ordered, whole = Window.partitionBy("key").orderBy("part"), Window.partitionBy("key")
    starts = counts.select("key", "part", "first", (F.sum("own").over(ordered) - F.col("own")).alias("before"), F.sum("own").over(whole).alias("n"))
    starts = steps.keep(starts, f"{name}-starts")
    return (
        dealt.withColumn("part", part).join(starts, ["key", "part"])
        .withColumn("pos", F.col("at") - F.col("first") + F.col("before")).drop("at", "part", "first", "before")
    )


def _blocks(nodes: DataFrame) -> DataFrame:
    """key, block, n (leaves of the tree), height, leaves, nodes, of nodes (key, pos, n, digest)."""

    def of_group(table: pa.Table) -> pa.Table:
        order = np.argsort(table["pos"].to_numpy())
        digests = table["digest"].to_pylist()
        n = table["n"][0].as_py()
        block = build([digests[k] for k in order.tolist()], min(BLOCK_LEVELS, height_of(n)))
        return pa.table({
            "key": table["key"][:1], "block": table["block"][:1], "n": table["n"][:1],
            "height": pa.array([block.height], pa.int32()), "leaves": pa.array([block.n], pa.int32()), "nodes": pa.array([block.nodes], pa.binary()),
        })

    own = nodes.select("key", F.floor(F.col("pos") / BLOCK).cast("long").alias("block"), "pos", "n", "digest")
    return own.groupBy("key", "block").applyInArrow(of_group, "key string, block long, n long, height int, leaves int, nodes binary")


class Forest:
    """One tree for each key, as rounds of blocks. leaves has key, pos, n, digest; pos counts from 0."""

    def __init__(self, steps: Steps, leaves: DataFrame, name: str):
        self._steps, self._name = steps, name
        self.rounds: list[DataFrame] = []
        while True:
            blocks = steps.keep(_blocks(leaves), f"{name}-round-{len(self.rounds)}")
            self.rounds.append(blocks)
            if blocks.where(F.col("n") > BLOCK).limit(1).count() == 0:
                break
            roots = blocks.where(F.col("n") > BLOCK)
            leaves = roots.select(
                "key", F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK).alias("n"), F.substring("nodes", 1, HASH).alias("digest"))

    def subroots(self) -> DataFrame:
        """key, digest: the root of every tree."""
        tops = [b.where(F.col("n") <= BLOCK).select("key", F.substring("nodes", 1, HASH).alias("digest")) for b in self.rounds]
        out = tops[0]
        for top in tops[1:]:
            out = out.union(top)
        return out

    def proofs_above_blocks(self, above: DataFrame) -> DataFrame:
        """key, block, proof: siblings from the roots of the first round's blocks upwards; above has key and the
        proof of every subroot."""
        proofs = None
        for k, blocks in reversed(list(enumerate(self.rounds))):
            tops = blocks.where(F.col("n") <= BLOCK).select("key", "block").join(above, "key")
            proofs = tops if proofs is None else tops.union(proofs)
            proofs = self._steps.keep(proofs, f"{self._name}-proofs-{k}")
            if k:
                proofs = self._node_proofs(blocks, proofs)
        return proofs

    @staticmethod
    def _node_proofs(blocks: DataFrame, proofs: DataFrame) -> DataFrame:
        """key, block (the number of a leaf of these blocks), proof."""

        def of_group(own: pa.Table, above: pa.Table) -> pa.Table:
            key, number = own["key"][0].as_py(), own["block"][0].as_py()
            block = Block(own["nodes"][0].as_py(), own["height"][0].as_py(), own["leaves"][0].as_py())
            rest = above["proof"][0].as_py()
            return pa.table({
                "key": pa.array([key] * block.n, pa.string()),
                "block": pa.array([number * BLOCK + k for k in range(block.n)], pa.int64()),
                "proof": pa.array([packed(block.siblings(k)) + rest for k in range(block.n)], pa.binary()),
            })

        return blocks.groupBy("key", "block").cogroup(proofs.groupBy("key", "block")).applyInArrow(of_group, "key string, block long, proof binary")


def _leaf_proofs(leaves: DataFrame, blocks: DataFrame, above: DataFrame) -> DataFrame:
    """id, group, leaf, subroot and root digests, proof digest and folded root of every leaf."""

    def of_group(own: pa.Table, tree: pa.Table) -> pa.Table:
        block = Block(tree["nodes"][0].as_py(), tree["height"][0].as_py(), tree["leaves"][0].as_py())
        above, root = unpacked(tree["proof"][0].as_py()), tree["root"][0].as_py()
        proofs, roots = [], []
        for pos, digest, changed in zip(own["pos"].to_pylist(), own["digest"].to_pylist(), own["changed"].to_pylist(), strict=True):
            siblings = block.siblings(pos % BLOCK) + above
            proofs.append(hashlib.sha256(b"".join([others for _, others in siblings]).hex().encode()).digest())
            roots.append(folded(changed or digest, siblings))
        n = own.num_rows
        return pa.table({
            "id": own["id"], "digest": own["digest"],
            "subroot": pa.array([tree["subroot"][0].as_py()] * n, pa.binary()), "root": pa.array([root] * n, pa.binary()),
            "proof": pa.array(proofs, pa.binary()), "folded": pa.array(roots, pa.binary()),
        })

    trees = blocks.join(above, ["key", "block"])
    own = leaves.withColumn("block", F.floor(F.col("pos") / BLOCK).cast("long"))
    schema = "id long, digest binary, subroot binary, root binary, proof binary, folded binary"
    return own.groupBy("key", "block").cogroup(trees.groupBy("key", "block")).applyInArrow(of_group, schema)


class Manifest:
    """The trees of a table, kept in the shared folder. `forest` and `top` hold the blocks.

    fields are the columns of a leaf's digest in order, id the long column that orders leaves, group the column with
    one tree for each value; changed gives the digest of the row as it is held against the trees (null: as it is)."""

    def __init__(self, rows: DataFrame, fields: list[str], id: str, group: str, changed: Column | None = None):
        steps = self._steps = Steps(rows.sparkSession)
        chosen = rows.select(
            rows[id].cast("long").alias("id"), _group_key(rows[group]).alias("key"), leaf_digest([rows[f] for f in fields]).alias("digest"),
            (F.lit(None).cast("binary") if changed is None else changed).alias("changed"),
            F.monotonically_increasing_id().alias("row"))
        self.leaves = steps.keep(_positions(steps, steps.keep(chosen, "merkle-leaves"), ["id", "digest"], "merkle-dealt"), "merkle-places")
        steps.drop("merkle-leaves", "merkle-dealt", "merkle-dealt-starts")
        self.forest = Forest(steps, self.leaves, "merkle-groups")
        groups = self.forest.subroots().select(F.lit("").alias("key"), F.col("key").alias("group"), "digest", F.lit(0).alias("row"))
        self.groups = steps.keep(_positions(steps, groups, ["group"], "merkle-order"), "merkle-subroots")
        self.top = Forest(steps, self.groups, "merkle-top")

    def root(self) -> DataFrame:
        """digest: one row, none for an empty table."""
        return self.top.subroots().select("digest")

    def proofs(self) -> DataFrame:
        """id, digest, subroot, root, proof (digest of all siblings) and folded root of every row, as bytes."""
        none = self.top.subroots().select("key", F.lit(b"").alias("proof"))
        top = self._steps.keep(self.top.proofs_above_blocks(none), "merkle-top-proofs")
        own = self.top._node_proofs(self.top.rounds[0], top).select(F.col("block").alias("pos"), "proof")
        subroots = self._steps.keep(
            self.groups.select("pos", F.col("group").alias("key"), F.col("digest").alias("subroot")).join(own, "pos").drop("pos"), "merkle-above")
        above = self.forest.proofs_above_blocks(subroots.select("key", "proof"))
        root = self.root().first()
        above = above.join(subroots.select("key", "subroot"), "key").withColumn("root", F.lit(bytes(root[0]) if root else b""))
        return _leaf_proofs(self.leaves, self.forest.rounds[0], above)


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def tampered(rows: DataFrame, fields: list[str], text: str, where: Column) -> Column:
    """The leaf's digest with A-Z of the text in lower case where the condition holds, else null."""
    low = F.translate(rows[text], "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(where, leaf_digest([low if f == text else rows[f] for f in fields]))


def verified_documents(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: every document held against the manifest,
    those whose id's checksum 3 divides after their text was put in lower case."""
    third = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 3 == 0
    found = Manifest(docs, FIELDS, "doc_id", "lang", tampered(docs, FIELDS, "text", third)).proofs()
    shown = lambda c: F.lower(F.hex(c))
    return found.select(
        F.col("id").alias("doc_id"), shown("digest").alias("leaf"), shown("subroot").alias("subroot"), shown("root").alias("root"),
        shown("proof").alias("proof_sha256"), shown("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


ORACLE = r"""
WITH RECURSIVE bits AS (
  SELECT row_number() OVER (ORDER BY doc_id) AS rid, doc_id, lang, source, n_chars, text,
    list_reduce(
      list_prepend(4294967295, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: list_concat([CAST(ascii(x) AS BIGINT)], list_transform(range(8), lambda i: -1))))),
      lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END) AS crc
  FROM documents
), leaves AS (
  SELECT rid, doc_id, coalesce('=' || lang, '') AS grp, (4294967295 - crc) % 3 = 0 AS third,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') AS fields,
    text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM bits
), hashed AS (
  SELECT rid, doc_id, grp, sha256(fields || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN third THEN sha256(fields || coalesce(strlen(low) || ':' || low, '-')) END AS changed
  FROM leaves
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY grp) AS n FROM hashed
), tree AS (
  SELECT grp, 0 AS level, pos, n, leaf AS digest FROM placed
  UNION ALL
  SELECT grp, level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM tree WHERE n > 1 GROUP BY grp, level, pos // 8, n
), subroots AS (
  SELECT grp, digest AS subroot, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n, level AS height FROM tree WHERE n = 1
), top AS (
  SELECT 0 AS level, pos, n, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY level, pos // 8, n
), steps AS (
  SELECT p.rid, t.level, t.digest, t.pos < p.pos // CAST(8 ** t.level AS BIGINT) AS left_side, t.pos = p.pos // CAST(8 ** t.level AS BIGINT) AS own, t.pos
  FROM placed p JOIN tree t ON t.grp = p.grp AND t.n > 1 AND t.pos // 8 = p.pos // CAST(8 ** (t.level + 1) AS BIGINT)
  UNION ALL
  SELECT p.rid, s.height + t.level, t.digest, t.pos < s.pos // CAST(8 ** t.level AS BIGINT), t.pos = s.pos // CAST(8 ** t.level AS BIGINT), t.pos
  FROM placed p JOIN subroots s ON s.grp = p.grp JOIN top t ON t.n > 1 AND t.pos // 8 = s.pos // CAST(8 ** (t.level + 1) AS BIGINT)
), siblings AS (
  SELECT rid, level, coalesce(string_agg(digest, '' ORDER BY pos) FILTER (left_side), '') AS before,
    coalesce(string_agg(digest, '' ORDER BY pos) FILTER (NOT left_side AND NOT own), '') AS after
  FROM steps GROUP BY rid, level
), proofs AS (
  SELECT rid, sha256(string_agg(before || after, '' ORDER BY level)) AS proof_sha256 FROM siblings GROUP BY rid
), folds AS (
  SELECT rid, 0 AS level, coalesce(changed, leaf) AS digest FROM hashed
  UNION ALL
  SELECT f.rid, f.level + 1, sha256(s.before || f.digest || s.after) FROM folds f JOIN siblings s ON s.rid = f.rid AND s.level = f.level
), folded AS (SELECT rid, arg_max(digest, level) AS folded_root FROM folds GROUP BY rid)
SELECT p.doc_id, p.leaf, s.subroot, r.digest AS root, coalesce(q.proof_sha256, sha256('')) AS proof_sha256, f.folded_root, f.folded_root = r.digest AS verified
FROM placed p JOIN subroots s USING (grp) JOIN folded f USING (rid) LEFT JOIN proofs q USING (rid), (SELECT digest FROM top WHERE n = 1) r
"""
