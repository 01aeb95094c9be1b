"""WARC fixity audit with Merkle trees.

A record's digest is the SHA-256 of its bytes. Above the records a tree stands on
offset ranges of the file: a node of level 1 hashes, in the order of offsets, the
offset, length and digest of every record that begins in its ``range_bytes``; a
node of a higher level hashes its up to ``fanout`` children. Ranges and not record
numbers carry the tree, so a record that is lost or rotten in its place changes
its own path only. Where a replica was written anew and what follows a longer or
shorter record has moved, the rest of that file differs and is reported.

Two replicas are compared from the roots down: only children of nodes that
differ are read at the next level, and only records of level-1 ranges that
differ are compared one by one. Replicas of a clean file cost one row.

DataFrame functions only. The digests are computed once and kept as a narrow
table in the shared folder (checkpoint); groups are bounded by the records of a
range and by ``fanout``; joins are on (file, node).

Defined results: records found in one replica only are ``missing`` (not in the
second) or ``extra`` (not in the first); otherwise ``changed``. Several records
at one offset of a file are compared as a sorted list, and reported together
with the length of the longest and their digests in order. A file that is in one
replica only differs in all its records. Null payloads are empty, a null url is
the empty url; records with a null file or offset cannot be placed and are left
out. Clashing other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import query, table



def record_bytes(url: Column, payload: Column, name: Column) -> Column:
    """A response record as it stands in the file."""
    payload, url = F.coalesce(payload, F.lit("")), F.coalesce(url, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), F.coalesce(name.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), url, F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"), payload, F.lit("\r\n\r\n"),
    )


def located(pages: DataFrame, records_per_file: int = 1000, **replicas: Column) -> DataFrame:
    """Digests and places of the records of ``pages`` (page_id, url, html), files cut by ranges of page_id.

    Within a file records stand by page_id, then digest; pages without an id are
    left out. Each of ``replicas`` is another html for every page; what it makes of
    the record at the same place is added as ``<name>_length`` and ``<name>_digest``.
    """

    def measured(html: Column, prefix: str = "") -> list[Column]:
        record = record_bytes(F.col("url"), html, F.col("page_id"))
        return [F.octet_length(record).cast("long").alias(f"{prefix}length"), F.sha2(record.cast("binary"), 256).alias(f"{prefix}digest")]

    others = [c for name, html in replicas.items() for c in measured(html, f"{name}_")]
    rows = pages.where(F.col("page_id").isNotNull()).select(
        F.floor(F.col("page_id") / records_per_file).cast("long").alias("file"), "page_id", *measured(F.col("html")), *others,
    )
    before = Window.partitionBy("file").orderBy("page_id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    place = F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset")
    return rows.select("file", place, "length", "digest", "page_id", *[f"{name}_{part}" for name in replicas for part in ("length", "digest")])


def _hashed(children: Column) -> Column:
    return F.sha2(F.array_join(children, "\n").cast("binary"), 256)


def merkle_levels(records: DataFrame, levels: int, range_bytes: int, fanout: int) -> list[DataFrame]:
    """Nodes (file, idx, hash, n_records) of levels 1 to ``levels``."""
    line = F.concat_ws(" ", F.lpad(F.col("offset").cast("string"), 20, "0"), "length", "digest")
    first = records.groupBy("file", F.floor(F.col("offset") / range_bytes).cast("long").alias("idx")).agg(
        _hashed(F.sort_array(F.collect_list(line))).alias("hash"), F.count("*").alias("n_records")
    )
    out = [cut_lineage(first)]
    for _ in range(levels - 1):
        line = F.concat_ws(" ", F.lpad(F.col("idx").cast("string"), 20, "0"), "hash")
        out.append(out[-1].groupBy("file", F.floor(F.col("idx") / fanout).cast("long").alias("idx")).agg(
            _hashed(F.sort_array(F.collect_list(line))).alias("hash"), F.sum("n_records").alias("n_records")
        ))
    return out


def _levels(a: DataFrame, b: DataFrame, range_bytes: int, fanout: int) -> int:
    """How many levels lead to one node for each file."""
    last = a.select("offset").unionAll(b.select("offset")).agg(F.max("offset").alias("m")).first()["m"] or 0
    nodes, levels = last // range_bytes + 1, 1
    while nodes > 1:
        nodes, levels = -(-nodes // fanout), levels + 1
    return levels


def audit(a: DataFrame, b: DataFrame, range_bytes: int = 65_536, fanout: int = 16) -> DataFrame:
    """Records on which two replicas (file, offset, length, digest) differ.

    Returns file, offset, length_a, length_b, digest_a, digest_b, status, root_a and root_b of the file.
    """
    place = F.col("file").isNotNull() & F.col("offset").isNotNull()
    a, b = [cut_lineage(x.where(place).select("file", "offset", "length", "digest")) for x in (a, b)]
    levels = _levels(a, b, range_bytes, fanout)
    trees = [merkle_levels(x, levels, range_bytes, fanout) for x in (a, b)]
    bad = roots = None
    for level in range(levels - 1, -1, -1):
        nodes = []
        for tree, side in zip(trees, "ab", strict=True):
            rows = tree[level].select("file", "idx", F.col("hash").alias(f"hash_{side}"))
            if bad is not None:  # children of differing nodes only
                rows = rows.withColumn("parent", F.floor(F.col("idx") / fanout).cast("long"))
                rows = rows.join(bad.select("file", F.col("idx").alias("parent")), ["file", "parent"], "left_semi").drop("parent")
            nodes.append(rows)
        both = nodes[0].join(nodes[1], ["file", "idx"], "full")
        bad = both.where(~F.col("hash_a").eqNullSafe(F.col("hash_b")))
        if roots is None:
            roots = bad.select("file", F.col("hash_a").alias("root_a"), F.col("hash_b").alias("root_b"))
    found = []
    for rows, side in ((a, "a"), (b, "b")):
        rows = rows.withColumn("idx", F.floor(F.col("offset") / range_bytes).cast("long"))
        rows = rows.join(bad.select("file", "idx"), ["file", "idx"], "left_semi")
        found.append(rows.groupBy("file", "offset").agg(
            F.max("length").alias(f"length_{side}"), F.array_join(F.sort_array(F.collect_list("digest")), ",").alias(f"digest_{side}")
        ))
    records = found[0].join(found[1], ["file", "offset"], "full")
    records = records.where(~(F.col("digest_a").eqNullSafe(F.col("digest_b")) & F.col("length_a").eqNullSafe(F.col("length_b"))))
    status = F.when(F.col("digest_b").isNull(), "missing").when(F.col("digest_a").isNull(), "extra").otherwise("changed")
    return records.withColumn("status", status).join(roots, "file", "left").select(
        "file", "offset", "length_a", "length_b", "digest_a", "digest_b", "status", "root_a", "root_b"
    )


def rotten(html: str) -> Column:
    """The page as a replica has it: in some a letter changed, in some the end lost."""
    text = F.coalesce(html, F.lit(""))
    return (
        F.when(F.col("page_id") % 997 == 3, F.concat(F.lit("?"), F.substring(text, 2, 1_000_000_000)))
        .when(F.col("page_id") % 1999 == 7, F.expr(f"substring(coalesce({html}, ''), 1, length(coalesce({html}, '')) - 9)"))
        .otherwise(text)
    )


@query(
    r"""
WITH r AS (
  SELECT page_id, page_id // 1000 AS file, coalesce(url, '') AS url, coalesce(html, '') AS html,
    CASE WHEN page_id % 997 = 3 THEN '?' || substring(coalesce(html, ''), 2)
         WHEN page_id % 1999 = 7 THEN substring(coalesce(html, ''), 1, length(coalesce(html, '')) - 9)
         ELSE coalesce(html, '') END AS rot
  FROM pages WHERE page_id IS NOT NULL),
t AS (
  SELECT page_id, file,
    'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || page_id
    || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10)
    || 'Content-Length: ' AS head, html, rot, chr(13) || chr(10) || chr(13) || chr(10) AS gap FROM r),
w AS (
  SELECT page_id, file, head || strlen(html) || gap || html || gap AS ra, head || strlen(rot) || gap || rot || gap AS rb FROM t),
l AS (
  SELECT *, CAST(sum(strlen(ra)) OVER (PARTITION BY file ORDER BY page_id) - strlen(ra) AS BIGINT) AS "offset" FROM w)
SELECT file, "offset", strlen(ra) AS length_a, CASE WHEN page_id % 1499 <> 5 THEN strlen(rb) END AS length_b,
  sha256(ra) AS digest_a, CASE WHEN page_id % 1499 <> 5 THEN sha256(rb) END AS digest_b,
  CASE WHEN page_id % 1499 = 5 THEN 'missing' ELSE 'changed' END AS status
FROM l WHERE page_id % 1499 = 5 OR ra <> rb"""
)
def op6_warc_fixity(spark, sf_dir):
    """The archive of all pages against a replica with rot and lost records; every record that differs."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    records = located(pages, copy=rotten("html"))
    second = records.where(F.col("page_id") % 1499 != 5).select("file", "offset", F.col("copy_length").alias("length"), F.col("copy_digest").alias("digest"))
    return audit(records, second).drop("root_a", "root_b")
