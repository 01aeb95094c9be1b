r"""Benchmark decontamination: which words of a document lie in a benchmark passage.

A window is ``window`` consecutive words of a benchmark item (a shorter item is
one window). A document contains a window only if it contains all its shingles
(``shingle`` consecutive words), so by prefix filtering one shingle of each
window is enough to find it: the rarest one, by how often the corpus holds it.

1. Count in one pass over the documents how often each benchmark shingle occurs.
2. Take the rarest shingle of each window (a prefix of one, as the whole window
   must be there) with its place in the window.
3. In a second pass look the document's shingles up. A match at word p of a
   shingle at place o is a candidate window at p - o, if it fits into the
   document (positional and length bounds). Compare it word by word.

Both passes are maps over the documents; nothing but counts is shuffled. The
benchmark goes to the executors in blocks of at most about ``block_words``
words (a longer item is a block of its own), a size that is counted before; more
blocks mean more maps in one stage, not more reads. Blocks are stable: items are
dealt by the hash of their id.

Defined results: null or empty texts have no words and are not contaminated.
Items with a null id, or without words, are ignored; rows of one item id count
as one item. Repeated documents are judged once per row; documents keep a null
id. Other columns are ignored. Without items nothing is hit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, mixed, query, runs, table

#: Word bytes lower-cased, all other bytes blank: words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z are lower-cased.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
CHUNK_BYTES = 4_000_000


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class _Known(dict):
    """Numbers of benchmark words; -1 for any other."""

    def __missing__(self, word: bytes) -> int:
        return -1


@dataclass
class Block:
    """Windows of some benchmark items, over word numbers."""

    words: dict[bytes, int]
    shingle: int
    windows: dict[int, np.ndarray]  # by length: distinct windows, one a row
    items: dict[int, list[list[str]]]  # by length: item ids of each window
    #: by shingle length: sorted distinct hashes
    hashes: dict[int, np.ndarray]
    #: by window length: row of ``hashes`` of each window's shingles, one column for each place
    places: dict[int, np.ndarray]
    #: by window length: place of the shingle that is looked up
    rarest: dict[int, np.ndarray] | None = None

    @classmethod
    def of(cls, items: list[tuple[str, bytes]], window: int, shingle: int) -> Block:
        words: dict[bytes, int] = {}
        found: dict[int, dict[tuple[int, ...], set[str]]] = {}
        for item, text in items:
            ids = [words.setdefault(w, len(words)) for w in words_of(text)]
            size = min(window, len(ids))
            for i in range(len(ids) - size + 1) if ids else ():
                found.setdefault(size, {}).setdefault(tuple(ids[i : i + size]), set()).add(item)
        windows = {n: np.array(list(w), dtype=np.int64).reshape(len(w), n) for n, w in found.items()}
        each: dict[int, list[np.ndarray]] = {}
        placed = {}
        for n, w in windows.items():
            s = min(shingle, n)
            placed[n] = np.stack([_hash(w[:, i : i + s]) for i in range(n - s + 1)], axis=1)
            each.setdefault(s, []).append(placed[n].ravel())
        hashes = {s: np.unique(np.concatenate(h)) for s, h in each.items()}
        places = {n: np.searchsorted(hashes[min(shingle, n)], h) for n, h in placed.items()}
        return cls(words, shingle, windows, {n: [sorted(s) for s in w.values()] for n, w in found.items()}, hashes, places)

    def ranked(self, seen: dict[int, np.ndarray]) -> Block:
        """Pick the shingle that the corpus holds least often, the first of equals."""
        self.rarest = {n: seen[min(self.shingle, n)][p].argmin(axis=1) for n, p in self.places.items()}
        return self

    def numbers(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all texts one after another, -1 after each text; words of each text."""
        known, ids, counts = _Known(self.words), [], []
        for t in texts:
            w = words_of(t)
            counts.append(len(w))
            ids.extend(map(known.__getitem__, w))
            ids.append(-1)
        return np.array(ids, dtype=np.int64), np.array(counts, dtype=np.int64)

    def lookups(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Shingle length, word positions and rows of ``hashes`` where a benchmark shingle stands."""
        known = np.concatenate([[0], np.cumsum(ids >= 0)])
        for s, table_ in self.hashes.items():
            if len(ids) < s:
                continue
            at = np.flatnonzero(known[s:] - known[:-s] == s)
            h = _hash(ids[at[:, None] + np.arange(s)])
            row = np.minimum(np.searchsorted(table_, h), len(table_) - 1)
            same = table_[row] == h
            yield s, at[same], row[same]

    def hits(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Window length, first word and window of every occurrence."""
        for s, at, row in self.lookups(ids):
            for n, windows in self.windows.items():
                if min(self.shingle, n) != s or not len(at):
                    continue
                place = self.rarest[n]
                key = self.places[n][np.arange(len(windows)), place]
                order = np.argsort(key, kind="stable")
                lo = np.searchsorted(key[order], row, "left")
                count = np.searchsorted(key[order], row, "right") - lo
                which = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
                window = order[which]
                start = np.repeat(at, count) - place[window]
                fits = (start >= 0) & (start + n <= len(ids))
                start, window = start[fits], window[fits]
                same = (ids[start[:, None] + np.arange(n)] == windows[window]).all(axis=1)
                yield n, start[same], window[same]


def _hash(words: np.ndarray) -> np.ndarray:
    """One number for each row of word numbers."""
    h = np.full(len(words), words.shape[1], dtype=np.uint64)
    for k in range(words.shape[1]):
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + words[:, k].astype(np.uint64))
    return h


def _count(df: DataFrame, block: Block) -> dict[int, np.ndarray]:
    """How often the documents hold each shingle of the block."""
    shared = df.sparkSession.sparkContext.broadcast(block)

    def seen(batches):
        block = shared.value
        total = {s: np.zeros(len(h), dtype=np.int64) for s, h in block.hashes.items()}
        for batch in batches:
            texts = byte_texts(batch.column("text"))
            for i, j in runs([len(t) for t in texts], CHUNK_BYTES):
                for s, _, row in block.lookups(block.numbers(texts[i:j])[0]):
                    total[s] += np.bincount(row, minlength=len(total[s]))
        for s, n in total.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({"size": np.full(len(some), s), "row": some, "n": n[some]})

    counted = df.select("text").mapInArrow(seen, "size long, row long, n long")
    counted = counted.groupBy("size", "row").agg(F.sum("n").alias("n")).toPandas()
    out = {s: np.zeros(len(h), dtype=np.int64) for s, h in block.hashes.items()}
    for s, part in counted.groupby("size"):
        out[s][part["row"].to_numpy()] = part["n"].to_numpy()
    return out


def _matched(df: DataFrame, block: Block) -> DataFrame:
    """Add the block's hits to ``spans`` (first and behind-last words, merged) and ``items``."""
    shared = df.sparkSession.sparkContext.broadcast(block)

    def matched(batches):
        block = shared.value
        for batch in batches:
            texts = byte_texts(batch.column("text"))
            spans, items = batch.column("spans").to_pylist(), batch.column("items").to_pylist()
            words = np.zeros(len(texts), dtype=np.int64)
            for i, j in runs([len(t) for t in texts], CHUNK_BYTES):
                ids, words[i:j] = block.numbers(texts[i:j])
                first = np.cumsum(words[i:j] + 1) - words[i:j] - 1
                edge = np.zeros(len(ids) + 1, dtype=np.int64)
                for d in range(i, j):
                    for a, b in zip(spans[d][::2], spans[d][1::2], strict=True):
                        edge[first[d - i] + a] += 1
                        edge[first[d - i] + b] -= 1
                for n, start, window in block.hits(ids):
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + n, -1)
                    doc = np.searchsorted(first, start, "right") - 1 + i
                    for d, w in np.unique(np.stack([doc, window], axis=1), axis=0).tolist():
                        items[d] = sorted({*items[d], *block.items[n][w]})
                inside = np.concatenate([[0], np.cumsum(edge[:-1]) > 0, [0]])
                turns = np.flatnonzero(np.diff(inside))
                # a document's spans never reach the gap behind it, so each pair of turns lies in one document
                doc = np.searchsorted(first, turns, "right") - 1
                doc[1::2] = doc[::2]
                cut = np.searchsorted(doc, np.arange(j - i + 1))
                for d in range(j - i):
                    spans[i + d] = (turns[cut[d] : cut[d + 1]] - first[d]).tolist()
            new = {"n_words": pa.array(words), "spans": pa.array(spans, pa.list_(pa.int64())), "items": pa.array(items, pa.list_(pa.string()))}
            columns = {name: new.get(name, batch.column(name)) for name in batch.schema.names}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return df.mapInArrow(matched, df.schema)


def _blocks(benchmark: DataFrame, window: int, shingle: int, block_words: int) -> Iterator[Block]:
    """The benchmark in blocks of about ``block_words`` words; an empty block if there are no items."""
    items = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    items = items.select(F.col("item_id").cast("string").alias("item_id"), "text")
    size = items.agg(F.sum(F.size(F.split("text", r"[^0-9A-Za-z\x{80}-\x{10FFFF}]+")).cast("long")).alias("n")).first()["n"] or 0
    n = -(-size // block_words) or 1
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k)
        yield Block.of([(i, t.encode()) for i, t in part.toLocalIterator()], window, shingle)


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = 13, shingle: int = 5, min_percent: int = 5,
    block_words: int = 2_000_000, keep: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted ids), spans (word ranges), contaminated and ``keep`` columns of each document.

    ``contaminated`` is ``n_hit > 0`` and at least ``min_percent`` percent of the words hit.
    """
    carried = [F.col(c).alias(f"kept {c}") for c in keep if c != "text"]
    rows = docs.select("doc_id", "text", *carried).withColumns({
        "n_words": F.lit(0).cast("long"), "spans": F.array().cast("array<bigint>"), "items": F.array().cast("array<string>"),
    })
    for block in _blocks(benchmark, window, shingle, block_words):
        rows = _matched(rows, block.ranked(_count(docs, block)))
    n_hit = F.aggregate(F.transform("spans", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0).cast("long"), lambda s, x: s + x)
    hit = (n_hit > 0) & (100 * n_hit >= min_percent * F.col("n_words"))
    kept = [F.col("text" if c == "text" else f"kept {c}").alias(c) for c in keep]
    return rows.select("doc_id", "n_words", n_hit.alias("n_hit"), "items", "spans", hit.alias("contaminated"), *kept)


def digest(items: Column) -> Column:
    return F.sha2(F.array_join(items, ",").cast("binary"), 256)


@query()
def op3_decontaminate(spark, sf_dir):
    """Hits of all benchmark items in every document."""
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        digest(F.col("items")).alias("items_sha256"), "contaminated",
    )
