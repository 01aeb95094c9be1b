r"""Near-duplicate documents by bottom-k sketches of one hash function.

A document is the set of its distinct shingles (``words`` neighbouring words;
the whole sequence if it has fewer). Two documents are linked if the Jaccard
similarity of their sets is at least ``percent`` / 100.

1. One hash function orders all shingles. A document keeps the ``K`` (128) smallest
   values of its set, in order: its sketch. Documents with equal sets (equal
   128-bit digest) become one class, of which the smallest doc_id stands for all.
2. Inverted lists: each run of ``RUN`` neighbouring values among the first 64 of a sketch is a key
   (single values are shared by unrelated texts that hold a common phrase; runs
   hardly ever). Similar sets share most values, hence runs: for sets of up to 64
   shingles, one at least by the pigeonhole principle; beyond that two sets of
   similarity 0.85 miss all with a probability under 1e-12, of 0.8 under 1e-9.
3. Star rounds: each document of a list is paired with the smallest document in
   it, and of all its partners the one it shares most keys with is tested.
   Confirmed links give components. So a group of thousands of copies costs one
   test for each copy. Rounds go on, with partners from other components not
   tested yet, while they find links.
4. Rest: documents of lists that still hold several components. Of each sketch
   the values held by the fewest components come first, and only as many become
   keys of new lists as similar sketches can differ in, and one more: two
   sketches of sufficient overlap share one of these (prefix filtering; common
   phrases come last and mostly fall away). Documents in lists that are still long
   go through the same again with their whole sets, whose prefixes are shorter
   and exact. Every pair across components in
   these lists whose sizes allow the similarity is tested, once. A link inside a
   component would not change it and is not looked for.
5. A pair is tested in two steps. The smallest K values of both sketches together
   are the sketch of the union; the share of them that both hold estimates the
   similarity, and pairs more than six standard deviations below the threshold
   drop out. For the rest the texts are fetched and the full sets compared.

Texts never go through a shuffle whole but once, compressed, for the documents
that share a list with another. Keys are counted in the map tasks; hot keys and
hot classes meet others only in equi-joins, which adaptive execution splits.

Defined results: documents without words (null, empty, blank) have an empty set
and are linked with nothing. A null doc_id has no component (null) and is kept.
Rows that share a doc_id count as one document. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, forget, landed, mixed, query, runs, table
from .components import components

K, RUN, SMALL = 128, 3, 12
#: So many values of a sketch make runs.
RUN_VALUES = 64
#: Lists of more documents are resolved by whole sets.
TOGETHER = 64
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
CHUNK_BYTES = 2_000_000
STAR_ROUNDS = 4


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased."""
    return text.translate(LOWER).split()


def shingle_set(text: bytes, words: int) -> set[tuple[bytes, ...]]:
    w = words_of(text)
    if len(w) < words:
        return {tuple(w)} if w else set()
    return set(zip(*[w[i:] for i in range(words)], strict=False))


def _hashes(bags: list[list[bytes]], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, and where each document's begin."""
    sizes = np.array([len(b) for b in bags], dtype=np.int64)
    word = np.fromiter(map(xxhash.xxh3_64_intdigest, (w for b in bags for w in b)), np.uint64, int(sizes.sum()))
    begin = np.cumsum(sizes) - sizes
    h = np.zeros(max(len(word) - words + 1, 0), dtype=np.uint64)
    for k in range(words):
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + word[k : k + len(h)])
    count = np.where(sizes >= words, sizes - words + 1, np.minimum(sizes, 1))
    at = np.cumsum(count) - count
    out = np.zeros(int(count.sum()), dtype=np.uint64)
    full = np.flatnonzero(sizes >= words)
    place = np.arange(int(count[full].sum())) - np.repeat(np.cumsum(count[full]) - count[full], count[full])
    out[np.repeat(at[full], count[full]) + place] = h[np.repeat(begin[full], count[full]) + place]
    for d in np.flatnonzero((sizes < words) & (sizes > 0)):
        out[at[d]] = xxhash.xxh3_64_intdigest(b" ".join(bags[d]), seed=1)
    return out, np.append(at, len(out))


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, digest of the whole set, sketch (ordered) of every row."""

    def sketched(batches):
        for batch in batches:
            texts = byte_texts(batch.column("text"))
            sizes, digests, lowest = [], [], []
            for i, j in runs([len(t) for t in texts], CHUNK_BYTES):
                h, cut = _hashes([words_of(t) for t in texts[i:j]], words)
                for a, b in zip(cut, cut[1:], strict=False):
                    own = np.unique(h[a:b])
                    sizes.append(len(own))
                    digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                    lowest.append(own[:K].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(lowest, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "digest", "sketch"],
            )

    return docs.select("doc_id", "text").mapInArrow(sketched, "doc_id long, n_shingles long, digest binary, sketch array<long>")


def _keys(classes: DataFrame) -> DataFrame:
    """(key, rep, n): a row for each run of each class's sketch."""
    s, size = F.col("sketch"), F.least(F.size("sketch"), F.lit(RUN_VALUES))

    def run(length: int):
        hashed = lambda i: F.xxhash64(F.lit(length), *[F.element_at(s, i + k) for k in range(length)])
        return F.when(size >= length, F.transform(F.sequence(F.lit(1), size - (length - 1)), hashed)).otherwise(F.array().cast("array<bigint>"))

    keys = F.when(F.col("n") <= SMALL, F.concat(run(RUN), run(RUN - 1))).otherwise(run(RUN))
    return classes.select(F.explode(F.array_distinct(keys)).alias("key"), "rep", "n")


def _least_shared(size: Column, percent: int) -> Column:
    """Values that ``size`` values of a union sketch have in common at least, six deviations below the mean."""
    t = percent / 100
    return F.greatest(F.lit(1), F.floor(size * t - 6 * F.sqrt(size * t * (1 - t))))


def _prefixes(values: DataFrame, percent: int, sketch: bool) -> DataFrame:
    """Of each rep's ``values`` (rep, n, c, size, value) those by which a similar one of another component can be found.

    Values held by the fewest components come first. Two sets of sizes m <= n
    share t / (1 + t) * (m + n) values at least, so the smaller one can be found
    by its first m - 2t / (1 + t) * m + 1 (``rank < index``), by the first
    n - t * n + 1 of the larger. Sketches of larger sets share as much as they must.
    """
    held = values.select("value", "c").distinct().groupBy("value").agg(F.count("*").alias("held")).where("held > 1")
    size = F.col("size")
    whole = F.col("n") <= int(K * percent / 100) if sketch else F.lit(True)  # and so is any partner
    need = F.when(whole, F.ceil(size * percent / 100)).otherwise(_least_shared(size, percent)).cast("int")
    need_larger = F.when(whole, F.ceil(size * (2 * percent) / (100 + percent))).otherwise(need).cast("int")
    ranked = values.join(held, "value").groupBy("rep", "n", "c", "size").agg(F.sort_array(F.collect_list(F.struct("held", "value"))).alias("shared"))
    # values of one component stand first and find nobody
    alone = size - F.size("shared")
    taken = F.slice("shared", 1, F.greatest(F.lit(0), size - need + 1 - alone).cast("int"))
    keys = ranked.select(
        "rep", "n", "c", "size", need.alias("need"), (size - need_larger + 1).alias("index"), whole.alias("whole"), alone.alias("alone"),
        F.posexplode(taken).alias("pos", "s"),
    )
    rank = (F.col("pos") + F.col("alone")).alias("rank")
    return keys.select("rep", "n", "c", "size", "need", "index", "whole", rank, F.col("s.value").alias("value"))


def _across(keys: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that share a value of ``keys`` and may share enough others."""
    smaller = keys.where("rank < index").drop("index")
    larger = keys.drop("index").withColumnsRenamed({c: f"{c}_b" for c in keys.columns if c not in ("value", "index")})
    order = (F.col("n") < F.col("n_b")) | ((F.col("n") == F.col("n_b")) & (F.col("rep") < F.col("rep_b")))
    sizes = 100 * F.col("n") >= percent * F.col("n_b")
    # a first shared value at these ranks leaves so many at most, itself included
    most = F.least(F.col("size") - F.col("rank"), F.col("size_b") - F.col("rank_b"))
    both = F.when(F.col("whole") & F.col("whole_b"), F.ceil((F.col("n") + F.col("n_b")) * percent / (100 + percent))).otherwise(0)
    pairs = smaller.join(larger, "value").where(order & sizes & (F.col("c") != F.col("c_b")) & (most >= F.greatest("need", "need_b", both)))
    return pairs.select(F.greatest("rep", "rep_b").alias("a"), F.least("rep", "rep_b").alias("b")).distinct()


def _whole_sets(reps: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(rep, n, c, size, value) for all shingles of the texts of ``reps`` (rep, c)."""

    def hashed(batches):
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            packed = batch.column("packed").to_pylist()
            for i, j in runs([len(x) for x in packed], CHUNK_BYTES // 4):
                h, cut = _hashes([words_of(unzip.decompress(x)) for x in packed[i:j]], words)
                sets = [np.unique(h[a:b]).view(np.int64) for a, b in zip(cut, cut[1:], strict=False)]
                ends = np.cumsum([0] + [len(x) for x in sets])
                values = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets)))
                yield pa.RecordBatch.from_arrays([batch.column("rep")[i:j], batch.column("c")[i:j], values], names=["rep", "c", "set"])

    rows = reps.join(texts.withColumnRenamed("doc_id", "rep"), "rep").select("rep", "c", "packed")
    sets = rows.mapInArrow(hashed, "rep long, c long, set array<long>")
    n = F.size("set").cast("long")
    return sets.select("rep", n.alias("n"), "c", F.size("set").alias("size"), F.explode("set").alias("value"))


def _rest(lists: DataFrame, classes: DataFrame, texts: DataFrame, words: int, percent: int, spent: list[str]) -> DataFrame:
    """Pairs (a, b) of different components to test, of the documents in ``lists`` (rep, n, c).

    Tables that the pairs are made from are added to ``spent``.
    """
    open_ = lists.select("rep", "c").distinct().join(classes, "rep")
    values = landed(open_.select("rep", "n", "c", F.size("sketch").alias("size"), F.explode("sketch").alias("value")), "values", spent=spent)
    keys = landed(_prefixes(values, percent, sketch=True), "prefixes", spent=spent)
    long = landed(keys.groupBy("value").agg(F.count("*").alias("m")).where(F.col("m") > TOGETHER).select("value"), "long", spent=spent)
    pairs = _across(keys.join(long, "value", "left_anti"), percent)
    # documents that only long lists bring together: prefixes of the sets themselves tell more than those of sketches
    dense = keys.join(long, "value", "left_semi").select("rep", "c").distinct()
    sets = landed(_whole_sets(dense, texts, words), "sets", spent=spent)
    return pairs.unionAll(_across(_prefixes(sets, percent, sketch=False), percent)).distinct()


def _alike(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes and union sketch allow the similarity."""
    for side in "ab":
        pairs = pairs.join(classes.select(F.col("rep").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"s_{side}")), side)
    least, most = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    # hashes are unsigned and stored as signed numbers; flipping the top bit gives their order
    order = lambda c: F.transform(c, lambda x: x.bitwiseXOR(F.lit(-(2**63)).cast("long")))
    union = F.slice(F.sort_array(order(F.array_union("s_a", "s_b"))), 1, K)
    shared = F.size(F.array_intersect(union, order(F.array_intersect("s_a", "s_b"))))
    enough = shared >= _least_shared(F.size(union), percent)
    return pairs.where((100 * least >= percent * most) & enough).select("a", "b")


def _confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets are similar enough, compared word by word."""
    rows = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("packed").alias("t_b")), "b")
    rows = rows.join(texts.select(F.col("doc_id").alias("a"), F.col("packed").alias("t_a")), "a").select("a", "b", "t_a", "t_b")

    def compared(batches):
        unzip = zstandard.ZstdDecompressor()
        last, other = None, set()
        for batch in batches:
            keep = []
            for b, t_a, t_b in zip(batch.column("b").to_pylist(), batch.column("t_a").to_pylist(), batch.column("t_b").to_pylist(), strict=True):
                if last != (b, t_b):
                    last, other = (b, t_b), shingle_set(unzip.decompress(t_b), words)
                own = shingle_set(unzip.decompress(t_a), words)
                both = len(own & other)
                keep.append(100 * both >= percent * (len(own) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return rows.sortWithinPartitions("b").mapInArrow(compared, "a long, b long").distinct()


def _packed(docs: DataFrame) -> DataFrame:
    """Texts, each compressed."""

    def packed(batches):
        for batch in batches:
            zip_ = zstandard.ZstdCompressor(level=1)
            out = [zip_.compress(t) for t in byte_texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], names=["doc_id", "packed"])

    return docs.select("doc_id", "text").mapInArrow(packed, "doc_id long, packed binary")


def _labelled(listed: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return listed.withColumn("c", F.col("rep"))
    return listed.join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left").select(
        *listed.columns, F.coalesce("component", "rep").alias("c")
    )


def _links(listed: DataFrame, classes: DataFrame, texts: DataFrame, words: int, percent: int, held: list[str]) -> DataFrame:
    """Links (a, b) that give the components of all similar classes; their tables are added to ``held``."""
    spark, spent = listed.sparkSession, []
    tested = links = labels = None
    for _ in range(STAR_ROUNDS):
        lists = _labelled(listed, labels)
        hubs = lists.groupBy("key").agg(F.min("rep").alias("hub"), F.min("c").alias("c_lo"), F.max("c").alias("c_hi")).where("c_lo < c_hi")
        open_ = lists.join(hubs.select("key", "hub"), "key")
        pairs = open_.where("rep <> hub").groupBy(F.col("rep").alias("a"), F.col("hub").alias("b")).agg(F.count("*").alias("keys"), F.min("c").alias("c"))
        if labels is not None:
            pairs = _labelled(pairs.withColumnsRenamed({"c": "c_a", "b": "rep"}), labels).where("c <> c_a").withColumnRenamed("rep", "b")
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        best = pairs.groupBy("a").agg(F.max(F.struct("keys", (-F.col("b")).alias("b"))).alias("m")).select("a", (-F.col("m.b")).alias("b"))
        best = landed(best, "stars", spent=spent)
        if best.isEmpty():
            break
        found = landed(_confirmed(_alike(best, classes, percent), texts, words, percent), "links", spent=held)
        tested = best if tested is None else tested.unionAll(best)
        if found.isEmpty():
            break
        links = found if links is None else links.unionAll(found)
        labels = components(links)
    lists = _labelled(listed, labels)
    hubs = lists.groupBy("key").agg(F.min("c").alias("c_lo"), F.max("c").alias("c_hi")).where("c_lo < c_hi").select("key")
    across = _rest(lists.join(hubs, "key"), classes, texts, words, percent, spent)
    if tested is not None:
        across = across.join(tested, ["a", "b"], "left_anti")
    found = landed(_confirmed(_alike(across, classes, percent), texts, words, percent), "links", spent=held)
    forget(spark, *spent)
    return found if links is None else links.unionAll(found)


def near_duplicates(docs: DataFrame, words: int = 3, percent: int = 85) -> DataFrame:
    """doc_id (a number), n_shingles, component_id and kept of each row of ``docs`` (doc_id, text)."""
    if not 75 <= percent <= 100:
        raise ValueError("a similarity from 75 to 100 percent")
    docs, spent = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), []
    sets = landed(sketches(docs, words), "sketches", spent=spent)
    sizes = landed(sets.select("doc_id", "n_shingles"), "sizes")
    filled = sets.where("n_shingles > 0 AND doc_id IS NOT NULL")
    reps = filled.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    members = landed(filled.select("doc_id", "digest").join(reps, "digest").select("doc_id", "rep").distinct(), "members", spent=spent)
    # rows that share a doc_id are one document: its classes are linked
    classes = filled.join(reps.select("digest", "rep"), "digest").where("doc_id = rep")
    classes = landed(classes.select("rep", F.col("n_shingles").alias("n"), "sketch", "digest").dropDuplicates(["rep", "digest"]).drop("digest"), "classes", spent=spent)
    keys = _keys(classes)
    shared = keys.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi").select("key")
    listed = landed(keys.join(shared, "key"), "lists", spent=spent)
    wanted = listed.select(F.col("rep").alias("doc_id")).distinct()
    texts = landed(_packed(docs).join(wanted, "doc_id"), "texts", spent=spent)
    links = _links(listed, classes, texts, words, percent, spent)
    linked = members.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b").unionAll(links.select("a", "b"))
    found = components(linked).withColumnRenamed("node", "doc_id")
    forget(docs.sparkSession, *spent)  # sizes and components are all that the result reads
    own = F.coalesce("component", "doc_id")
    return sizes.join(found, "doc_id", "left").select(
        "doc_id", "n_shingles", own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept")
    )


@query()
def op7_bottomk_dedup(spark, sf_dir):
    """Classes of near-duplicates among all whole documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))
