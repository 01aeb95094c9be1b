"""Merkle manifest of a dataset: a root, and for every row a witness that it is in it.

Rows are leaves (a digest of their fields), in order within their group; groups
in order make the tree above. Every two neighbours become one node, a last one
alone is hashed alone, until one is left.

Witnesses grow while leaves are appended. A task takes one aligned block of at
most ``2**height`` leaves and appends them in order to a frontier of open
subtrees. A subtree that meets its sibling closes: the leaves on either side get
the other's root as the next entry of their partial witness. What is open at the
end is promoted to the block's height. The roots of all blocks are then appended
in the same way, as leaves of the next round, until a group has one root; groups
are appended once more above. A leaf's witness is its entries in its block, then
its block's, then its group's, put together by joins on (group, block). So a task
holds one block, rounds grow with the logarithm of the rows, and tables of
later rounds are a thousandth of the one before.

Order is made by a range partitioning and counts by partition and group, whose
running sums are one row per partition and group: nothing is numbered in one task.
The order's last key is a row number, so equal rows spread over partitions.
Folding a leaf and its witness to a root is DataFrame functions only.

Defined results: rows with one id stand by their leaf digest, a null id or group
before all others; equal rows are leaves of their own, each with its own
witness. A null field is a mark of its own, not an empty text. A tree of one
leaf is that leaf, its witness is empty (the digest of no bytes). An empty table gives no
rows. Long texts count whole. Columns that are no fields are ignored, whatever
their names.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, StructType

from .common import landed, query, table

#: Leaves of a block: two to this power.
HEIGHT = 10
ENTRY = [pa.field("left", pa.bool_()), pa.field("digest", pa.binary())]
WITNESSED = StructType().add("witness", ArrayType(StructType().add("left", BooleanType()).add("digest", BinaryType()))).add("root", BinaryType())


def field_text(value: Column) -> Column:
    """``-`` if null, else byte count, colon and value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(*fields: Column) -> Column:
    """SHA-256 of the fields one after another, 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field_text(f) for f in fields]).cast("binary"), 256))


def hex_text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def node_digest(children: list[bytes]) -> bytes:
    """SHA-256 of the children's digests as hex text."""
    return sha256("".join(c.hex() for c in children).encode()).digest()


class Frontier:
    """Open subtrees, larger ones first, and the partial witnesses of the leaves appended so far.

    A witness entry is (sibling stands on the left, its digest); a node without a sibling has (False, None).
    """

    def __init__(self) -> None:
        self.open: list[tuple[int, int, bytes]] = []  # height, first leaf, root
        self.witnesses: list[list[tuple[bool, bytes | None]]] = []

    def append(self, leaf: bytes) -> None:
        self.witnesses.append([])
        self._settle(0, len(self.witnesses) - 1, leaf)

    def _settle(self, height: int, first: int, root: bytes) -> None:
        """Open a subtree, closing it with its left sibling as long as there is one."""
        while self.open and self.open[-1][0] == height:
            _, start, left = self.open.pop()
            for w in self.witnesses[start:first]:
                w.append((False, root))
            for w in self.witnesses[first:]:
                w.append((True, left))
            height, first, root = height + 1, start, node_digest([left, root])
        self.open.append((height, first, root))

    def close(self, height: int | None = None) -> bytes:
        """Promote what has no sibling until one subtree is left, of that height if one is given."""
        while len(self.open) > 1 or (height is not None and self.open[0][0] < height):
            at, first, root = self.open.pop()
            for w in self.witnesses[first:]:
                w.append((False, None))
            self._settle(at + 1, first, node_digest([root]))
        return self.open[0][2]


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, the place among the rows of the group in that order, and ``total``, their number."""
    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    ranged = landed(ranged.withColumn("_at", F.monotonically_increasing_id()), "ranged")
    chunk = F.shiftright("_at", 33)
    chunks = ranged.groupBy(chunk.alias("_chunk"), F.col(group).alias("_group")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy("_group").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select(
        "_chunk", "_group", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy("_group")).alias("total"),
    )
    met = ranged.join(chunks, (chunk == F.col("_chunk")) & F.col(group).eqNullSafe(F.col("_group")))
    return met.withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_chunk", "_group", "_first", "_before")


def _appended(block: pa.Table, height: int) -> pa.Table:
    """One block: its leaves in order through a frontier."""
    block = block.sort_by("pos")
    frontier = Frontier()
    for leaf in block.column("digest").to_pylist():
        frontier.append(leaf)
    root = frontier.close(height if block.column("total")[0].as_py() > 1 << height else None)
    sizes, entries = [0], []
    for w in frontier.witnesses:
        entries += w
        sizes.append(len(entries))
    sides, digests = pa.array([left for left, _ in entries], pa.bool_()), pa.array([digest for _, digest in entries], pa.binary())
    flat = pa.StructArray.from_arrays([sides, digests], fields=ENTRY)
    witness = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), flat)
    return block.append_column("witness", witness).append_column("root", pa.array([root] * block.num_rows, pa.binary()))


def _rounds(nodes: DataFrame, group: str, height: int) -> list[DataFrame]:
    """Nodes (group, pos, total, digest, further columns) with ``witness`` and ``root`` in their block; then the blocks alike, and so on."""
    rounds, extra = [], [c for c in nodes.columns if c not in (group, "pos", "total", "digest")]
    while True:
        kept = nodes.select(group, "pos", "total", "digest", *extra)
        types = StructType([*kept.schema.fields, *WITNESSED.fields])
        blocks = kept.groupBy(group, F.shiftright("pos", height)).applyInArrow(lambda block: _appended(block, height), types)
        rounds.append(landed(blocks, "witnesses"))
        nodes = rounds[-1].where(F.col("pos").bitwiseAND((1 << height) - 1) == 0)
        if nodes.where(F.col("total") > 1 << height).isEmpty():
            return rounds
        nodes = nodes.select(
            group, F.shiftright("pos", height).alias("pos"), F.shiftright(F.col("total") + ((1 << height) - 1), height).alias("total"),
            F.col("root").alias("digest"),
        )
        extra = []


def _continued(nodes: DataFrame, above: DataFrame, on: Column) -> DataFrame:
    """Witnesses of nodes go on with those of ``above`` (_witness and the columns that replace or join theirs)."""
    met = nodes.drop(*[c[1:] for c in above.columns if c in ("_root", "_subroot")]).join(above, on)
    met = met.withColumn("witness", F.concat("witness", "_witness"))
    return met.withColumnsRenamed({"_root": "root", "_subroot": "subroot"}).drop("_group", "_pos", "_witness")


def _assembled(rounds: list[DataFrame], group: str, height: int) -> DataFrame:
    """Nodes of the first round with whole witnesses, from the last round down by (group, block)."""
    result = rounds[-1]
    for nodes in reversed(rounds[:-1]):
        above = result.select(*[F.col(c).alias(f"_{c}") for c in ("pos", "witness", "root", "subroot") if c in result.columns], F.col(group).alias("_group"))
        result = _continued(nodes, above, F.col(group).eqNullSafe(F.col("_group")) & (F.shiftright("pos", height) == F.col("_pos")))
    return result


def manifest(leaves: DataFrame, group: str, order: list[str], height: int = HEIGHT) -> DataFrame:
    """Leaves (group, order columns, ``digest``, further ones) with ``pos``, ``total``, ``witness`` to ``root``, and their group's ``subroot``.

    A witness is an array of (left, digest) from the leaf up; a null digest is a node without a sibling.
    """
    rounds = _rounds(numbered(leaves, group, order), group, height)
    # groups are the leaves above; their witnesses join the last round, which has at most 2**height nodes a group
    subroots = rounds[-1].where("pos = 0").select(group, F.col("root").alias("digest"), F.lit(0).alias("_all"))
    above = _assembled(_rounds(numbered(subroots, "_all", [group]), "_all", height), "_all", height)
    above = above.select(F.col(group).alias("_group"), F.col("witness").alias("_witness"), F.col("root").alias("_root"), F.col("digest").alias("_subroot"))
    rounds[-1] = _continued(rounds[-1], above, F.col(group).eqNullSafe(F.col("_group")))
    return _assembled(rounds, group, height)


def folded(leaf: Column, witness: Column) -> Column:
    """The root, as hex text, to which a leaf and its witness fold."""

    def step(below: Column, entry: Column) -> Column:
        sibling = hex_text(entry["digest"])
        pair = F.when(entry["digest"].isNull(), below).when(entry["left"], F.concat(sibling, below)).otherwise(F.concat(below, sibling))
        return F.sha2(pair.cast("binary"), 256)

    return F.aggregate(witness, hex_text(leaf), step)


def proof_digest(witness: Column) -> Column:
    """SHA-256, as hex text, of the siblings from the leaf up."""
    siblings = F.transform(F.filter(witness, lambda w: w["digest"].isNotNull()), lambda w: hex_text(w["digest"]))
    return F.sha2(F.array_join(siblings, "").cast("binary"), 256)


def document_leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, digest, tampered, number) of documents; some have a second digest, after a change of n_chars."""
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    leaf = leaf_digest(*fields)
    changed = leaf_digest(*fields[:3], fields[3].cast("decimal(20,0)") + 1, fields[4])
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return docs.select(
        "doc_id", "lang", leaf.alias("digest"), F.when(hit, changed).alias("tampered"), F.monotonically_increasing_id().alias("number"),
    )


@query(
    """
WITH RECURSIVE f AS (
  SELECT doc_id, lang, n_chars, source, text,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail FROM documents),
leaves AS (
  SELECT doc_id, lang, head, tail, n_chars, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf FROM f),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
tree AS (
  SELECT lang, 0 AS lvl, pos AS idx, leaf AS h FROM placed
  UNION ALL
  SELECT lang, lvl + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER (PARTITION BY lang) AS n FROM tree) WHERE n > 1 GROUP BY lang, lvl, idx // 2),
subroots AS (
  SELECT lang, lvl AS height, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos
  FROM tree t WHERE lvl = (SELECT max(lvl) FROM tree u WHERE u.lang IS NOT DISTINCT FROM t.lang)),
top AS (
  SELECT 0 AS lvl, pos AS idx, subroot AS h FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER () AS n FROM top) WHERE n > 1 GROUP BY lvl, idx // 2),
root AS (SELECT h AS root FROM top ORDER BY lvl DESC LIMIT 1),
steps AS (
  SELECT p.lang, p.pos, t.lvl, (p.pos >> t.lvl) & 1 AS on_right, s.h AS sibling
  FROM placed p JOIN (SELECT DISTINCT lang, lvl FROM tree) t ON p.lang IS NOT DISTINCT FROM t.lang
  JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang AND t.lvl < r.height
  LEFT JOIN tree s ON s.lang IS NOT DISTINCT FROM p.lang AND s.lvl = t.lvl AND s.idx = xor(p.pos >> t.lvl, 1)
  UNION ALL
  SELECT p.lang, p.pos, r.height + t.lvl, (r.pos >> t.lvl) & 1, s.h
  FROM placed p JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang
  JOIN (SELECT DISTINCT lvl FROM top) t ON t.lvl < (SELECT max(lvl) FROM top)
  LEFT JOIN top s ON s.lvl = t.lvl AND s.idx = xor(r.pos >> t.lvl, 1)),
proofs AS (
  SELECT lang, pos, sha256(coalesce(string_agg(sibling, '' ORDER BY lvl), '')) AS proof_sha256, count(*) AS height FROM steps GROUP BY lang, pos),
started AS (
  SELECT doc_id, lang, pos, leaf, CASE WHEN crc % 7 = 0
    THEN sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) ELSE leaf END AS first
  FROM (SELECT *, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda a, b: xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))), 4294967295) AS crc FROM placed)),
fold AS (
  SELECT lang, pos, 0 AS lvl, first AS h FROM started
  UNION ALL
  SELECT f.lang, f.pos, f.lvl + 1, sha256(CASE WHEN sibling IS NULL THEN h WHEN on_right = 1 THEN sibling || h ELSE h || sibling END)
  FROM fold f JOIN steps s ON s.lang IS NOT DISTINCT FROM f.lang AND s.pos = f.pos AND s.lvl = f.lvl)
SELECT s.doc_id, s.leaf, r.subroot, root.root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = root.root AS verified
FROM started s JOIN subroots r ON r.lang IS NOT DISTINCT FROM s.lang CROSS JOIN root
LEFT JOIN proofs p ON p.lang IS NOT DISTINCT FROM s.lang AND p.pos = s.pos
JOIN fold f ON f.lang IS NOT DISTINCT FROM s.lang AND f.pos = s.pos AND f.lvl = coalesce(p.height, 0)"""
)
def op13_merkle_manifest(spark, sf_dir):
    """Leaf, roots and witness digest of every document; some are tampered with, and fold to another root."""
    leaves = landed(document_leaves(table(spark, sf_dir, "documents")), "leaves")
    rows = manifest(leaves, "lang", ["doc_id", "digest", "number"])
    root = hex_text(F.col("root"))
    again = folded(F.coalesce("tampered", "digest"), F.col("witness"))
    return rows.select(
        "doc_id", hex_text(F.col("digest")).alias("leaf"), hex_text(F.col("subroot")).alias("subroot"), root.alias("root"),
        proof_digest(F.col("witness")).alias("proof_sha256"), again.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
