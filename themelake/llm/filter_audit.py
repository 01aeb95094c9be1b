"""Filter interaction audit: what every order of a set of filters would do.

Every document has a failure mask, one bit a filter. Masks are counted by part
into at most 2^k cells (documents, and sums of further measures). The Gray-code
walk then visits all 2^k sets of active filters, each one toggle from the one
before: a toggle changes the active-failure counter of the cells that fail this
filter; a cell whose counter leaves or reaches zero leaves or joins the running
survivors. The survivors of each set are stored, 32 states for five filters.
A step of an order is the difference of two states (before and after its
filter), so all k! orders come from the states alone, as does the Shapley share.

Cells are counted by Spark. The walk is numpy over Arrow batches of parts, all
parts of a batch at once; a part is one row of 2^k numbers a measure. Orders are
unfolded by Spark from a constant list.

The fifth filter of the query needs the smallest id of each text. Equal texts
fail the other filters alike, so only sums by (text, part) meet there, with the
sums of the rows that have the smallest id; documents fold by id and text before
labels are joined, and by text and part before digests meet. No task holds all
rows of a hot id, text or part.

Defined results: a null text is empty, and has no words (fails A, not B or C). A
null part is the empty string's part. Equal ids with equal text do not fail E; a
null id neither fails E nor counts as the smaller id, and has no labels. Several
labels of one id count as one that has all their marks. Repeated rows count each.
An empty table has no parts, so no rows. Long texts count whole. Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bloom_dedup import text_digest
from .common import query, table

FILTERS = "ABCDE"


def failure_mask(conditions: list[Column]) -> Column:
    """Bit i is set where condition i holds; null does not hold."""
    return sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(conditions)), F.lit(0)).cast("int")


def gray_walk(cells: np.ndarray) -> np.ndarray:
    """(parts, 2^k) cell sums by mask -> (parts, 2^k) survivors by set of active filters.

    One filter is toggled at a time; ``active`` counts each cell's failures among the active ones.
    """
    n_masks = cells.shape[1]
    masks = np.arange(n_masks)
    active = np.zeros(n_masks, np.int64)
    running, state = cells.sum(axis=1), 0
    states = np.empty_like(cells)
    states[:, 0] = running
    for step in range(1, n_masks):
        bit = (step & -step).bit_length() - 1  # the bit in which Gray codes step - 1 and step differ
        failing = masks >> bit & 1 == 1
        state ^= 1 << bit
        if state >> bit & 1:
            gone = failing & (active == 0)
            active[failing] += 1
            running = running - cells[:, gone].sum(axis=1)
        else:
            active[failing] -= 1
            back = failing & (active == 0)
            running = running + cells[:, back].sum(axis=1)
        states[:, state] = running
    return states


def surviving_states(cells: DataFrame, k: int, measures: list[str], part: str = "part", mask: str = "mask") -> DataFrame:
    """Counts by (part, mask) -> one row per part, each measure an array of 2^k survivors by set of active filters."""
    entry = F.struct(mask, *measures)
    rows = cells.groupBy(part).agg(F.collect_list(entry).alias("cells"))

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, n = batch.column("cells"), batch.num_rows
            values = lists.flatten()
            row = np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy()))
            at = values.field(0).to_numpy(zero_copy_only=False)
            columns = [batch.column(part)]
            for i in range(len(measures)):
                grid = np.zeros((n, 1 << k), np.int64)
                np.add.at(grid, (row, at), values.field(i + 1).to_numpy(zero_copy_only=False))
                states = gray_walk(grid)
                columns.append(pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) << k, states.ravel()))
            yield pa.RecordBatch.from_arrays(columns, names=[part, *measures])

    return rows.mapInArrow(walked, f"`{part}` {dict(rows.dtypes)[part]}, " + ", ".join(f"`{m}` array<bigint>" for m in measures))


def shapley_sums(states: str, k: int) -> Column:
    """Array: what each filter removes, summed over all orders."""
    full = 1 << k

    def share(f: int) -> Column:
        terms = []
        for s in range(full):
            if not s >> f & 1:
                before = bin(s).count("1")
                weight = factorial(before) * factorial(k - 1 - before)
                terms.append(F.lit(weight) * (F.get(states, F.lit(s)) - F.get(states, F.lit(s | 1 << f))))
        return sum(terms[1:], terms[0])

    return F.array(*[share(f) for f in range(k)])


def order_steps(states: DataFrame, names: str, count: str, lost: dict[str, str], part: str = "part") -> DataFrame:
    """Every step of every order of the filters, by difference of states.

    ``count`` is the array of documents, ``lost`` maps result names to further arrays.
    """
    k, orders = len(names), []
    for order in permutations(range(k)):
        before = 0
        for step, f in enumerate(order, 1):
            orders.append((("".join(names[i] for i in order)), step, f, before, before | 1 << f))
            before |= 1 << f
    all_on = (1 << k) - 1
    steps = F.from_json(
        F.lit("[" + ",".join(f'{{"o":"{o}","s":{s},"f":{f},"x":{x},"y":{y}}}' for o, s, f, x, y in orders) + "]"),
        "array<struct<o:string,s:int,f:int,x:int,y:int>>",
    )
    rows = states.select("*", shapley_sums(count, k).alias("_shares")).select("*", F.inline(steps))

    def at(column: str, state: Column | int) -> Column:
        return F.get(column, state if isinstance(state, Column) else F.lit(state))

    alone = F.expr("shiftleft(1, f)")
    removed = at(count, F.col("x")) - at(count, F.col("y"))
    return rows.select(
        part, F.col("o").alias("filter_order"), F.col("s").alias("step"), at(count, F.col("y")).alias("kept"), removed.alias("removed"),
        (at(count, 0) - at(count, alone) - removed).alias("redundant"),
        (at(count, F.lit(all_on).bitwiseXOR(alone)) - at(count, all_on)).alias("unique_fails"),
        *[(at(c, F.col("x")) - at(c, F.col("y"))).alias(name) for name, c in lost.items()],
        F.get("_shares", F.col("f")).alias("shapley"),
    )


def text_conditions(text: Column) -> list[Column]:
    """Failure of A, B, C and D on a text that is not null."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n_words = F.size(words)
    return [
        n_words < 100, 100 * F.size(F.array_distinct(words)) < 80 * n_words,
        100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.char_length(text), text.rlike("[#$%&*|]"),
    ]


def audit_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, documents, good, toxic) of documents under the filters A to E."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), text_digest(F.col("text")).alias("digest"),
        failure_mask(text_conditions(text)).alias("mask"),
    )
    by_id = rows.groupBy("doc_id", "part", "digest", "mask").agg(F.count("*").alias("n"))
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"),
    )
    marked = by_id.join(marks, "doc_id", "left").select(
        "doc_id", "part", "digest", "mask", "n", *[(F.coalesce(c, F.lit(0)) * F.col("n")).alias(c) for c in ("good", "toxic")],
    )
    # sums of all rows, of those with a null id, and the row of the smallest id, by text and part
    sums = ["n", "good", "toxic"]
    has_id = F.col("doc_id").isNotNull()
    by_text = marked.groupBy("digest", "part", "mask").agg(
        *[F.sum(c).alias(c) for c in sums],
        *[F.sum(F.when(has_id, 0).otherwise(F.col(c))).alias(f"null_{c}") for c in sums],
        F.min(F.when(has_id, F.struct("doc_id", *sums))).alias("first"),
    )
    by_text = by_text.withColumn("smallest", F.min("first.doc_id").over(Window.partitionBy("digest")))
    holds_it = F.coalesce(F.col("first.doc_id") == F.col("smallest"), F.lit(False))
    split = by_text.select(
        "part", "mask", F.inline(F.array(*[
            F.struct(F.lit(e).alias("fails_e"), *[value(c).cast("long").alias(c) for c in sums])
            for e, value in (
                (0, lambda c: F.col(f"null_{c}") + F.when(holds_it, F.col(f"first.{c}")).otherwise(0)),
                (16, lambda c: F.col(c) - F.col(f"null_{c}") - F.when(holds_it, F.col(f"first.{c}")).otherwise(0)),
            )
        ])),
    )
    mask = F.col("mask").bitwiseOR(F.col("fails_e")).alias("mask")
    return split.where("n > 0").groupBy("part", mask).agg(*[F.sum(c).alias(c) for c in sums])


@query(
    r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
m AS (
  SELECT doc_id, part,
    CASE WHEN len(w) < 100 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 10 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask FROM d),
l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
c AS (
  SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
s AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, bits[step] AS bit, list_sum(bits[1:step]) - bits[step] AS before
  FROM o, range(1, 6) r(step)),
x AS (
  SELECT part, filter_order, step, bit,
    CAST(sum(CASE WHEN mask & (before + bit)::INT = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
    CAST(sum(CASE WHEN mask & before::INT = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
    CAST(sum(CASE WHEN mask & before::INT <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
    CAST(sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
    CAST(sum(CASE WHEN mask & before::INT = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost,
    CAST(sum(CASE WHEN mask & before::INT = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM c, s GROUP BY ALL)
SELECT * EXCLUDE (bit), CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM x"""
)
def op12_filter_audit(spark, sf_dir):
    """Every order of five filters over all documents, by language: what each step keeps, removes and loses."""
    cells = audit_cells(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    states = surviving_states(cells, len(FILTERS), ["n", "good", "toxic"])
    return order_steps(states, FILTERS, "n", {"good_lost": "good", "toxic_lost": "toxic"})
