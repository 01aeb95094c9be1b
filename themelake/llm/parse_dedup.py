"""Repeated byte strings, found by content-defined parsing and ordering to a bounded depth.

A byte is removed if a string of ``length`` bytes around it also starts in a
document with a smaller doc_id. Strings never cross documents.

The texts are parsed at triggers of a rolling hash of ``gram`` bytes. A trigger is
the position whose hash is least among those of some string of ``length`` bytes
(plain "hash modulo p" triggers can leave gaps longer than a string; these cannot:
every string holds one). A phrase is the text of all neighbouring strings with the
same trigger, so phrases overlap by ``length - 1`` bytes and equal strings lie in
phrases with equal trigger grams. The suffix order of dictionary and parse is
needed to a depth of ``length`` bytes only, where it is a grouping by equality;
it is resolved from the coarse to the fine, each step on what the last one left:

1. Trigger grams: a gram that occurs in one document alone cannot start a repeat.
   Counting needs smallest and largest document of each gram, folded in the map
   tasks. Highly repetitive text collapses here and in the next step.
2. Dictionary of the phrases left: phrases are equal if their grams' hashes and
   their digests are (64 bits each). A phrase's place travels as one number. All but those in the smallest document of a phrase are removed whole.
3. Phrases of the dictionary that share a trigger gram but are not equal (where
   repeats begin and end, in different contexts) are cut into their strings, that
   is suffixes to ``length`` bytes. Up to ``TOGETHER`` phrases of a gram are
   compared in one place; the strings of more frequent grams are grouped by
   128-bit digest in turn, folded in the map tasks.
4. The parse maps the strings found back to each document.

Texts are taken from a batch in groups of about ``SLICE`` bytes, and each group's
phrases or strings are hashed, sorted and compared as numpy arrays. Where few
phrases share a gram, strings meet by a 64-bit hash and neighbours in its order are
compared byte by byte; should one differ, the group is ordered by all its bytes.

Each step is a map and an equi-join or grouping with map-side folding; joins on
grams and digests can be hot and are split by adaptive execution. Step results
are written to the shared folder, and removed there when a later result is. Texts are compressed for the three joins that
bring positions to them. Long texts are parsed in slices of ``SLICE`` starts.

Defined results: null texts are empty and lose nothing, as do texts shorter than
``length``. A null doc_id is neither smaller nor greater than any: such rows keep
all bytes and cause no removals. Rows that share a doc_id do not remove from each
other, and what one of them loses is found in its own text. Other columns are
ignored. Strings of frequent grams are equal if 128 bits of hashes are, phrases
if their gram's and their own digest are (128 bits together); others are compared
byte by byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch
from .common import byte_texts, forget, landed, mixed, query, runs, table

# Bytes parsed, hashed or compared at a time: arrays of eight bytes for each then stay in a core's cache.
SLICE = 125_000
TOGETHER = 4096


def _lanes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number."""
    x = data.astype(np.uint64)
    x = x[:-1] | (x[1:] << np.uint64(8))
    x = x[:-2] | (x[2:] << np.uint64(16))
    return x[:-4] | (x[4:] << np.uint64(32))


def _grams(lanes: np.ndarray, at: np.ndarray | None, size: int, seed: int = 0) -> np.ndarray:
    """Hash of the ``size`` (8 or more) bytes from each position on; at every position, or those of ``at``.

    Lanes times odd random numbers, summed, then mixed.
    """
    n = len(lanes) + 8 - size
    steps = [*range(0, size - 8, 8), size - 8]
    odd = np.random.default_rng([seed, size]).integers(1 << 63, size=len(steps), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    h = np.full(n if at is None else len(at), seed, dtype=np.uint64)
    for k, m in zip(steps, odd, strict=True):
        h += (lanes[k : k + n] if at is None else lanes[at + k]) * m
    return mixed(h)


def _lanes_at(data: bytes) -> np.ndarray:
    """The eight bytes from each position on as one number, without a copy; to be read by index."""
    return np.ndarray((max(len(data) - 7, 0),), "<u8", data, 0, (1,))


def _digest(lanes: np.ndarray, at: np.ndarray, size: np.ndarray, seed: np.ndarray | int) -> np.ndarray:
    """Hash of the ``size`` (8 or more) bytes from each of ``at`` on and of ``seed``; every bit is mixed before the next eight bytes join."""
    size = np.broadcast_to(np.asarray(size, dtype=np.int64), at.shape)
    h = mixed((size.astype(np.uint64) << np.uint64(32)) ^ mixed(np.atleast_1d(seed).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)))
    for k in range(0, int(size.max(initial=0)), 8):
        more = mixed(h ^ lanes[at + np.minimum(k, size - 8)])
        h = np.where(k < size, more, h)
    return h


def _unpacked(batch: pa.RecordBatch, lists: str) -> Iterator[tuple[int, int, list[bytes], np.ndarray, list[np.ndarray]]]:
    """Texts of a batch in groups of about SLICE bytes: first and last row, texts, and of the list of structs ``lists``
    the row within the group and each field."""
    unzip = zstandard.ZstdDecompressor()
    packed, column = batch.column("packed"), batch.column(lists)
    count = pc.fill_null(column.value_lengths(), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    fields = [f.to_numpy(zero_copy_only=False) for f in column.flatten().flatten()]
    bound = np.concatenate([[0], np.cumsum(count)])
    sizes = [zstandard.frame_content_size(x.as_buffer()) for x in packed]
    for i, j in runs(sizes, SLICE):
        texts = [unzip.decompress(x.as_buffer()) for x in packed[i:j]]
        yield i, j, texts, np.repeat(np.arange(j - i), count[i:j]), [f[bound[i] : bound[j]] for f in fields]


def _starts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Where each text begins once they are joined, and its length."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    return np.cumsum(sizes) - sizes, sizes


def _slices(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Texts in groups of about SLICE bytes: (number, first byte, part); parts of a long text overlap."""
    parts = []
    for d, t in enumerate(texts):
        parts += [(d, s, t[s : s + SLICE + length - 1]) for s in range(0, max(len(t) - length + 1, 0), SLICE)]
    for i, j in runs([len(p) for _, _, p in parts], SLICE):
        yield parts[i:j]


def phrases(parts: list[tuple[int, int, bytes]], length: int, gram: int) -> dict[str, np.ndarray]:
    """Phrases of some texts: text number, trigger gram's hash, trigger, first and last start (counted in the text)."""
    data = np.frombuffer(b"".join(p for _, _, p in parts), dtype=np.uint8)
    sizes = np.array([len(p) for _, _, p in parts], dtype=np.int64)
    h = _grams(_lanes(data), None, gram)
    bits = np.uint64(int(len(h)).bit_length())
    least = ((h >> bits) << bits) | np.arange(len(h), dtype=np.uint64)
    wide, step = length - gram + 1, 1
    while 2 * step <= wide:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < wide:
        least = np.minimum(least[: len(least) - (wide - step)], least[wide - step :])
    begin = np.cumsum(sizes) - sizes
    inside = np.ones(len(least), dtype=bool)  # starts whose string ends in its own part
    inside[((begin[1:] - length + 1)[:, None] + np.arange(length - 1)).ravel()] = False
    start = np.flatnonzero(inside)
    trigger = (least[start] & ((np.uint64(1) << bits) - np.uint64(1))).view(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (trigger[1:] != trigger[:-1]) | (start[1:] != start[:-1] + 1)]))
    last = np.append(new[1:], len(start)) - 1
    shift = np.array([s for _, s, _ in parts], dtype=np.int64) - begin
    own = np.searchsorted(begin, start[new], "right") - 1
    return {
        "text": np.array([d for d, _, _ in parts], dtype=np.int64)[own], "gram": h[trigger[new]].view(np.int64),
        "trigger": trigger[new] + shift[own], "first": start[new] + shift[own], "last": start[last] + shift[own],
    }


def _parsed(docs: DataFrame, length: int, gram: int, places: bool) -> DataFrame:
    """Trigger grams of all texts by document, with their places if asked for: first start (32 bits), bytes from there
    to the trigger and to the last start (16 bits each)."""

    def parsed(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for parts in _slices(byte_texts(batch.column("text")), length):
                p = phrases(parts, length, gram)
                columns = {"gram": p["gram"], "doc_id": ids[p["text"]].astype(np.int64)}
                if places:
                    columns["place"] = p["first"] << 32 | (p["trigger"] - p["first"]) << 16 | (p["last"] - p["first"])
                yield pa.RecordBatch.from_pydict(columns)

    rows = docs.where("doc_id IS NOT NULL").select("doc_id", "text")
    return rows.mapInArrow(parsed, "gram long, doc_id long" + (", place long" if places else ""))


def _dictionary_rows(work: DataFrame, length: int) -> DataFrame:
    """Phrases at shared triggers: gram, digest, document, first start and how many follow.

    Where rows share a doc_id they also get each other's places; what stands there
    is a string of their own, so nothing false comes of it.
    """

    def rows(batches):
        for batch in batches:
            ids, versions = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "version")]
            for i, j, texts, row, (grams, place) in _unpacked(batch, "places"):
                begin, sizes = _starts(texts)
                first, before, span = place >> 32, place >> 16 & 0xFFFF, place & 0xFFFF
                fits = first + span + length <= sizes[row]
                row, grams, first, before, span = [x[fits] for x in (row, grams, first, before, span)]
                digests = _digest(_lanes_at(b"".join(texts)), begin[row] + first, span + length, before)
                yield pa.RecordBatch.from_pydict({
                    "gram": grams, "digest": digests.view(np.int64), "doc_id": ids[i:j][row], "version": versions[i:j][row],
                    "first": first.astype(np.int32), "span": span.astype(np.int32),
                })

    found = work.where("places IS NOT NULL").select("doc_id", "version", "packed", "places")
    return found.mapInArrow(rows, "gram long, digest long, doc_id long, version long, first int, span int")


def _suffix_rows(joined: DataFrame, length: int) -> DataFrame:
    """What the phrases in ``ranges`` (gram, many, first, last) hold: of frequent grams (``many``) the digest of each
    string, of others the phrase whole."""

    def rows(batches):
        for batch in batches:
            ids, versions = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "version")]
            for i, j, texts, row, (grams, many, first, last) in _unpacked(batch, "ranges"):
                begin, _ = _starts(texts)
                data, own = b"".join(texts), (ids[i:j], versions[i:j])
                for few in np.array_split(np.flatnonzero(~many), 1 + len(row) // SLICE):
                    at = begin[row[few]]
                    keys = [data[a:b] for a, b in zip((at + first[few]).tolist(), (at + last[few] + length).tolist(), strict=True)]
                    yield _batch(grams[few], False, keys, *[x[row[few]] for x in own], first[few])
                often = np.flatnonzero(many)
                often = often[np.argsort(begin[row[often]] + first[often])]
                lanes, count = _lanes_at(data), (last - first + 1)[often]
                for k, m in runs(count.tolist(), SLICE):
                    n, some = count[k:m], often[k:m]
                    at = np.arange(int(n.sum())) + np.repeat((begin[row] + first)[some] - (np.cumsum(n) - n), n)
                    at, one = np.unique(at, return_index=True)
                    whose = np.repeat(row[some], n)[one]
                    both = np.stack([_digest(lanes, at, length, seed) for seed in (1, 2)], axis=1).tobytes()
                    keys = [both[x : x + 16] for x in range(0, len(both), 16)]
                    yield _batch(np.zeros(len(at), np.int64), True, keys, *[x[whose] for x in own], at - begin[whose])

    def _batch(grams, many, keys, ids, versions, starts):
        return pa.RecordBatch.from_arrays([
            pa.array(grams, pa.int64()), pa.array(np.full(len(keys), many)), pa.array(keys, pa.binary()), pa.array(ids, pa.int64()),
            pa.array(versions, pa.int64()), pa.array(starts, pa.int64()),
        ], names=["gram", "many", "key", "doc_id", "version", "start"])

    return joined.mapInArrow(rows, "gram long, many boolean, key binary, doc_id long, version long, start long")


def repeated(keys: list[bytes], group: np.ndarray, doc: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of strings of ``length`` bytes in ``keys`` that a key of the same group, of a smaller document, holds too: key, first and last start."""
    begin, sizes = _starts(keys)
    count = sizes - length + 1
    key = np.repeat(np.arange(len(keys)), count)
    at = np.arange(int(count.sum())) + np.repeat(begin - (np.cumsum(count) - count), count)
    lanes, where = _lanes_at(b"".join(keys)), group[key]
    steps = [*range(0, length - 8, 8), length - 8]
    h = _digest(lanes, at, length, where)

    def alike(order):
        same = where[order][1:] == where[order][:-1]
        for k in steps:
            x = lanes[at[order] + k]
            same &= x[1:] == x[:-1]
        return same

    order = np.argsort(h)
    same = alike(order)
    if (same != (h[order][1:] == h[order][:-1])).any():  # different strings with one hash
        order = np.lexsort([*(lanes[at + k] for k in steps), where])
        same = alike(order)
    first = np.flatnonzero(np.concatenate([[True], ~same]))
    docs = doc[key][order]
    smallest = np.repeat(np.minimum.reduceat(docs, first), np.diff(np.append(first, len(order))))
    found = np.zeros(len(at) + 2, dtype=bool)
    found[1:-1][order] = smallest < docs
    joined = found[1:-2] & found[2:-1] & (key[1:] == key[:-1])
    opens = np.flatnonzero(found[1:-1] & ~np.concatenate([[False], joined]))
    closes = np.flatnonzero(found[1:-1] & ~np.concatenate([joined, [False]]))
    return key[opens], (at - begin[key])[opens], (at - begin[key])[closes]


def _compared(groups: DataFrame, length: int) -> DataFrame:
    """Starts of strings that a smaller document has, among the phrases of each gram (``phrases``: key, doc_id, version, start)."""

    def compared(batches):
        for batch in batches:
            column = batch.column("phrases")
            count = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            keys, ids, versions, starts = column.flatten().flatten()
            ids, versions, starts = [x.to_numpy(zero_copy_only=False) for x in (ids, versions, starts)]
            bound = np.concatenate([[0], np.cumsum(count)])
            total = np.concatenate([[0], np.cumsum(pc.binary_length(keys).to_numpy(zero_copy_only=False).astype(np.int64))])
            for i, j in runs(np.diff(total[bound]).tolist(), SLICE):
                some = slice(int(bound[i]), int(bound[j]))
                key, first, last = repeated(keys[some].to_pylist(), np.repeat(np.arange(j - i), count[i:j]), ids[some], length)
                at = starts[some][key]
                yield pa.RecordBatch.from_pydict({"doc_id": ids[some][key], "version": versions[some][key], "first": at + first, "last": at + last})

    return groups.mapInArrow(compared, "doc_id long, version long, first long, last long")


def _packed(docs: DataFrame, keep: list[str]) -> DataFrame:
    """doc_id, version (a number of the row, fixed once the texts are landed), compressed text, columns to keep."""
    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def packed(batches):
        for batch in batches:
            zip_ = zstandard.ZstdCompressor(level=1)
            out = [zip_.compress(t) for t in byte_texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("version"), pa.array(out, pa.binary()), *[batch.column(c) for c in keep]],
                names=["doc_id", "version", "packed", *keep],
            )

    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("version"), "text", *keep)
    return rows.mapInArrow(packed, "doc_id long, version long, packed binary" + (f", {kept}" if keep else ""))


def kept_text(text: bytes, spans: list[tuple[int, int]]) -> str:
    """What is left as text: a character that lost a byte goes whole."""
    out, at = [], 0
    for a, b in spans:
        while a > at and text[a] & 0xC0 == 0x80:
            a -= 1
        while b < len(text) and text[b] & 0xC0 == 0x80:
            b += 1
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]]).decode("utf-8", "replace")


def _removed(rows: DataFrame, length: int, keep: list[str], texts: bool) -> DataFrame:
    """Spans and what is left of each text, from ``ranges`` of starts."""
    kept = "".join(f", `{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    schema = "doc_id long, n_bytes long, spans array<struct<start:bigint,stop:bigint>>, kept_sha256 string" + kept + (", text string" if texts else "")

    def removed(batches):
        for batch in batches:
            for i, j, bodies, row, (first, last) in _unpacked(batch, "ranges"):
                begin, sizes = _starts(bodies)
                begin = begin + np.arange(len(bodies))  # a byte between texts, so that their spans never meet
                order = np.argsort(begin[row] + first)
                a, b = (begin[row] + first)[order], np.maximum.accumulate((begin[row] + last)[order] + length)
                new = np.flatnonzero(np.concatenate([[True], a[1:] > b[:-1]])) if len(a) else np.zeros(0, np.int64)
                whose = row[order][new]
                a, b = a[new] - begin[whose], b[np.append(new[1:], len(b))[: len(new)] - 1] - begin[whose]
                bound = np.concatenate([[0], np.cumsum(np.bincount(whose, minlength=len(bodies)))])
                spans = list(zip(a.tolist(), b.tolist(), strict=True))
                digests, left = [], []
                for text, k, m in zip(bodies, bound[:-1].tolist(), bound[1:].tolist(), strict=True):
                    digest, at = hashlib.sha256(), 0
                    for start, stop in spans[k:m]:
                        digest.update(text[at:start])
                        at = stop
                    digest.update(text[at:] if at else text)
                    digests.append(digest.hexdigest())
                    if texts:
                        left.append(kept_text(text, spans[k:m]))
                found = pa.ListArray.from_arrays(pa.array(bound, pa.int32()), pa.StructArray.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["start", "stop"]))
                columns = [batch.column("doc_id")[i:j], pa.array(sizes, pa.int64()), found, pa.array(digests, pa.string())]
                columns += [batch.column(c)[i:j] for c in keep] + ([pa.array(left, pa.string())] if texts else [])
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "spans", "kept_sha256", *keep, *(["text"] if texts else [])])

    return rows.select("doc_id", "packed", "ranges", *keep).mapInArrow(removed, schema)


def remove_repeats(docs: DataFrame, length: int = 50, gram: int = 20, keep: tuple[str, ...] = (), texts: bool = False) -> DataFrame:
    """doc_id (a number), n_bytes, spans (removed byte ranges) and kept_sha256 of each row of ``docs`` (doc_id, text).

    ``keep`` names columns to hand through; with ``texts`` the text left is added.
    """
    if not 8 <= gram <= length <= 65_535:
        raise ValueError("a gram from 8 bytes to the length, a length to 65,535")
    keep = list(keep)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *keep)
    spark, spent = docs.sparkSession, []
    paths = {name: scratch(spark, name) for name in ("grams", "places", "parse", "dictionary")}
    grams = _parsed(docs, length, gram, places=False).groupBy("gram").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    shared = landed(grams.where("lo < hi").select("gram"), "grams", paths["grams"])
    places = _parsed(docs, length, gram, places=True).join(shared.hint("shuffle_hash"), "gram")
    places = landed(places.groupBy("doc_id").agg(F.collect_list(F.struct("gram", "place")).alias("places")), "places", paths["places"])
    forget(spark, paths.pop("grams"))
    packed = _packed(docs, keep)
    work = landed(packed, "texts")
    parse = landed(_dictionary_rows(work.select("doc_id", "version", "packed").join(places, "doc_id"), length), "parse", paths["parse"])
    forget(spark, paths.pop("places"))
    dictionary = landed(parse.groupBy("gram", "digest").agg(F.min("doc_id").alias("smallest")), "dictionary", paths["dictionary"])
    several = dictionary.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1")
    marked = dictionary.join(several, "gram", "left").select("gram", "digest", "smallest", F.col("n").isNotNull().alias("several"))
    whole = F.col("smallest") < F.col("doc_id")
    resolved = landed(parse.join(marked.hint("shuffle_hash"), ["gram", "digest"]).where("smallest < doc_id OR several").select(
        F.when(~whole, F.col("gram")).alias("gram"), "doc_id", "version", F.col("first").cast("long").alias("first"),
        (F.col("first") + F.col("span")).cast("long").alias("last"), whole.alias("whole"),
    ), "phrases", spent=spent)
    forget(spark, *paths.values())
    to_cut = resolved.where("NOT whole")
    frequent = to_cut.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > TOGETHER).select("gram", F.lit(True).alias("many"))
    to_cut = to_cut.join(frequent, "gram", "left").withColumn("many", F.coalesce("many", F.lit(False)))
    to_cut = to_cut.groupBy("doc_id", "version").agg(F.collect_list(F.struct("gram", "many", "first", "last")).alias("ranges"))
    bodies = work.select("doc_id", "version", "packed")
    suffixes = landed(_suffix_rows(bodies.join(to_cut, ["doc_id", "version"]), length), "suffixes", spent=spent)
    groups = suffixes.where("NOT many").groupBy("gram").agg(F.collect_list(F.struct("key", "doc_id", "version", "start")).alias("phrases"))
    strings = suffixes.where("many").select("key", "doc_id", "version", "start")
    first = strings.groupBy("key").agg(F.min("doc_id").alias("smallest"), F.max("doc_id").alias("largest")).where("smallest < largest")
    one = F.struct("first", "last")
    starts = strings.join(first, "key").where("smallest < doc_id").select("doc_id", "version", F.col("start").alias("first"), F.col("start").alias("last"))
    starts = starts.unionAll(_compared(groups, length))
    ranges = resolved.where("whole").select("doc_id", "version", "first", "last").unionAll(starts)
    ranges = landed(ranges.groupBy("doc_id", "version").agg(F.collect_list(one).alias("ranges")), "ranges")
    forget(spark, *spent)  # texts and ranges are all that the result reads
    return _removed(work.join(ranges, ["doc_id", "version"], "left"), length, keep, texts)


@query()
def op5_parse_dedup(spark, sf_dir):
    """What every whole document keeps without the strings of 50 bytes that start in a smaller one."""
    found = remove_repeats(table(spark, sf_dir, "documents"))
    length = lambda s: s["stop"] - s["start"]
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + length(s))
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
