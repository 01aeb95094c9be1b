"""Exact duplicates by two passes over narrow rows, with a Bloom filter between them.

Texts are read once, into rows of id, row number and SHA-256 (landed in the
shared folder). Pass one: every digest sets two bits in one block of a blocked
Bloom filter; a bit that two rows set is kept, a bit of one row alone is not.
Blocks are 4 KB bitmaps made by Spark's bitmap functions, for ``bits_per_row``
bits a row. Pass two: a row whose two bits are both kept may be repeated; only
such rows are shuffled and grouped by their whole digest, all others pass
straight through as the only ones of their text (about 5 in 100 of those are
shuffled too, and found single).

The filter is broadcast: its size is known before, a byte a row, and never above
``max_filter_mb``. In a larger corpus the bits fill up, so more rows are
shuffled, in the end all; results do not change. Groups fold in the map tasks.
A group of a thousandth of all rows or more (there are at most a thousand such)
reaches its rows by a broadcast, so that no task holds all copies of one text.

DataFrame functions only.

Defined results: a null text is the empty text, and empty texts are copies of one
another. Of equal texts the row with the largest id stays; a null id is below
all others; of rows equal in text and id, one stays, the one read last. Rows with
one id and different texts are judged apart. An empty table gives no rows. Long
texts count whole. Columns other than the id, the text and those in ``keep`` are
ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import landed, query, table

BLOCK_BITS = 32_768  # of one bitmap of Spark's bitmap functions


def text_digest(text: Column) -> Column:
    """SHA-256 of the UTF-8 bytes, 32 bytes; null is empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def _places(digest: Column, blocks: int) -> tuple[Column, Column, Column]:
    """Block and two bit positions of a digest."""
    h = F.xxhash64(digest)
    return (
        F.pmod(F.shiftrightunsigned(h, 30), F.lit(blocks)).cast("int"),
        h.bitwiseAND(BLOCK_BITS - 1), F.shiftrightunsigned(h, 15).bitwiseAND(BLOCK_BITS - 1),
    )


def _bit(bits: Column, at: Column) -> Column:
    """Whether a bit of a bitmap is set; null where there is no bitmap."""
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(at, 3).cast("int") + 1, 1)), 16, 10).cast("int")
    return F.getbit(byte, at.bitwiseAND(7).cast("int")) == 1


def repeat_filter(rows: DataFrame, digest: str, blocks: int) -> DataFrame:
    """(block, bits): the bits that the digests of two rows or more set."""
    block, first, second = _places(F.col(digest), blocks)
    slots = rows.select(block.alias("block"), F.explode(F.array_distinct(F.array(first, second))).alias("slot"))
    shared = slots.groupBy("block", "slot").agg(F.count("*").alias("n")).where("n >= 2")
    return shared.repartition("block").groupBy("block").agg(F.bitmap_construct_agg("slot").alias("bits"))


def maybe_repeated(rows: DataFrame, digest: str, blocks: int, repeats: DataFrame) -> DataFrame:
    """``rows`` with a column ``maybe``: false is certain, true may be a chance hit of other digests."""
    block, first, second = _places(F.col(digest), blocks)
    hit = _bit(F.col("_bits"), first) & _bit(F.col("_bits"), second)
    filters = F.broadcast(repeats.select(F.col("block").alias("_block"), F.col("bits").alias("_bits")))
    return rows.join(filters, block == F.col("_block"), "left").withColumn("maybe", F.coalesce(hit, F.lit(False))).drop("_block", "_bits")


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
    bits_per_row: int = 8, max_filter_mb: int = 128,
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256, passed (true: never shuffled as a possible copy).

    ``keep`` names columns to carry along; they may not have the names of results.
    """
    taken = {id_col, "keep_id", "group_size", "kept", "text_sha256", "passed"} & set(keep)
    if taken:
        raise ValueError(f"columns to keep have names of results: {sorted(taken)}")
    spark = docs.sparkSession
    rows = landed(docs.select(
        F.col(id_col).alias("_id"), F.monotonically_increasing_id().alias("_row"), text_digest(F.col(text_col)).alias("_digest"),
        F.struct(*keep).alias("_keep") if keep else F.lit(None).cast("boolean").alias("_keep"),
    ), "digests")
    n_rows = rows.count()
    blocks = max(1, min(-(-n_rows * bits_per_row // BLOCK_BITS), max_filter_mb * 2**20 * 8 // BLOCK_BITS))
    repeats = landed(repeat_filter(rows, "_digest", blocks), "repeat-filter")
    flagged = maybe_repeated(rows, "_digest", blocks, repeats)

    top = F.max(F.struct("_id", "_row")).alias("_top")
    groups = landed(flagged.where("maybe").groupBy("_digest").agg(F.count("*").alias("_n"), top), "copy-groups")
    large = max(2, n_rows // 1000 + 1)
    hot = F.broadcast(groups.where(F.col("_n") >= large).select("_digest", "_n", "_top"))
    met = flagged.join(hot, "_digest", "left")
    straight = met.where(~F.col("maybe") | F.col("_n").isNotNull())
    rest = met.where(F.col("maybe") & F.col("_n").isNull()).drop("_n", "_top").join(groups.where(F.col("_n") < large), "_digest")
    result = straight.unionByName(rest)
    return result.select(
        F.col("_id").alias(id_col),
        F.when(F.col("maybe"), F.col("_top._id")).otherwise(F.col("_id")).alias("keep_id"),
        F.coalesce("_n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("_top._row") == F.col("_row"), F.lit(True)).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"),
        (~F.col("maybe")).alias("passed"),
        *[F.col(f"_keep.{name}").alias(name) for name in keep],
    )


@query(
    """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))"""
)
def op11_bloom_dedup(spark, sf_dir):
    """Which document of equal texts stays, for all documents."""
    return exact_duplicates(table(spark, sf_dir, "documents")).drop("passed")
