"""Token ids packed into fixed-length sequences, as binary matrices.

Each task tokenizes its documents and fills buckets of about ``bucket_tokens``
tokens. Segments of a bucket are packed best-fit-decreasing: longest first, each
into the sequence with the least room that still takes it, found in a segment
tree over capacities. A document longer than a sequence is split into full
sequences and a rest, so no token is lost; a mark (``end_id``) closes every
document, so even an empty one is there. No shuffle; memory is bounded by the
bucket, and one document more.

A row is a matrix of at most ``rows_per_matrix`` sequences:

    matrix_id, n_rows, ids         sequences one after another, little-endian, ``pad_id`` behind the last segment
    positions                      same shape, counting from 0 again in every segment
    cu_seqlens                     for each sequence 0 and the end of each segment
    doc_ids, parts                 document and number of the part, for each segment

Ids and positions take 2 bytes where the vocabulary and the length allow, else 4.
Defined results: null texts are empty; a null doc_id stays null; repeated rows
are packed once per row; other columns are ignored; an empty table gives no rows.
Which documents share a sequence depends on how Spark splits the input.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import query, runs, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


class Room:
    """Open sequences by free room: the least room that takes a segment, in logarithmic time."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.some = [0] * (2 * self.leaves)  # open sequences below each node
        self.open: list[list[int]] = [[] for _ in range(most + 1)]

    def put(self, free: int, sequence: int) -> None:
        self.open[free].append(sequence)
        self._add(free, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """Free room and sequence of the tightest fit; none if a new sequence is needed."""
        node = need + self.leaves
        if not self.some[node]:
            while node > 1 and (node & 1 or not self.some[node + 1]):
                node >>= 1
            if node == 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.some[2 * node] else 2 * node + 1
        free = node - self.leaves
        self._add(free, -1)
        return free, self.open[free].pop()

    def _add(self, free: int, n: int) -> None:
        node = free + self.leaves
        while node:
            self.some[node] += n
            node >>= 1


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Numbers of the segments of each sequence; longest first, earlier first among equals."""
    room, sequences = Room(size), []
    for s in sorted(range(len(lengths)), key=lambda s: -lengths[s]):
        found = room.take(lengths[s])
        free, k = found if found else (size, len(sequences))
        if not found:
            sequences.append([])
        sequences[k].append(s)
        room.put(free - lengths[s], k)
    return sequences


def segments(doc_id, ids: np.ndarray, size: int) -> Iterator[tuple]:
    """Full sequences and the rest of one document: (doc_id, part, ids)."""
    for part, i in enumerate(range(0, len(ids), size)):
        yield doc_id, part, ids[i : i + size]


def matrices(bucket: list[tuple], size: int, rows: int, pad_id: int, kind: np.dtype) -> Iterator[dict]:
    packed = best_fit([len(ids) for _, _, ids in bucket], size)
    for i in range(0, len(packed), rows):
        part = packed[i : i + rows]
        ids, positions = np.full((len(part), size), pad_id, kind), np.zeros((len(part), size), kind)
        ends: list[list[int]] = []
        for r, sequence in enumerate(part):
            at = 0
            ends.append([0])
            for s in sequence:
                n = len(bucket[s][2])
                ids[r, at : at + n], positions[r, at : at + n] = bucket[s][2], np.arange(n)
                at += n
                ends[-1].append(at)
        yield {
            "n_rows": len(part), "ids": ids.tobytes(), "positions": positions.tobytes(), "cu_seqlens": ends,
            "doc_ids": [[bucket[s][0] for s in q] for q in part], "parts": [[bucket[s][1] for s in q] for q in part],
        }


@lru_cache(maxsize=2)
def tokenizer(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


BLANK = "\u2581"  # how the model writes a blank
TOGETHER = 8_000_000  # characters whose words are looked up at once


class Words:
    """Ids of texts, by their words where the model allows it.

    Where blanks stand only at the front of pieces, and line breaks in none, no
    piece spans two words. The words of many texts are then told apart by Arrow,
    each different one is encoded once and remembered, and ids are gathered by
    numpy. Texts with blanks at an end or next to one another are encoded whole.
    """

    MOST = 400_000

    def __init__(self, model):
        self.model, self.known = model, {}
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        kept = "".join(model.encode("a  b", out_type=str)) == f"{BLANK}a{BLANK}{BLANK}b"  # a blank in front, none lost
        self.apart = kept and not any(BLANK in p.lstrip(BLANK) or "\n" in p for p in pieces)
        self.blank = [model.piece_to_id(BLANK)]

    def __call__(self, texts: list[str]) -> Iterator[list[int] | np.ndarray]:
        """Ids of each text, in order."""
        for i, j in runs([len(t) for t in texts], TOGETHER):
            some = texts[i:j]
            plain = [k for k, t in enumerate(some) if self.apart and t and t[0] not in " \n" and t[-1] != " " and "  " not in t and BLANK not in t]
            found = dict(zip(plain, self._by_word([some[k] for k in plain]), strict=True))
            for k, t in enumerate(some):
                yield found[k] if k in found else self.model.encode(t)

    def _by_word(self, texts: list[str]) -> Iterator[np.ndarray]:
        if not texts:
            return
        # a word begins at a blank, which it leaves, or at a line break, which it keeps
        split = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " \n"), " ")
        coded = split.flatten().dictionary_encode()
        if len(self.known) > self.MOST:
            self.known.clear()
        different = coded.dictionary.to_pylist()
        new = [word for word in different if word not in self.known]
        for word, found in zip(new, self.model.encode(new, num_threads=1), strict=True):
            self.known[word] = (found[1:] if word[:1] == "\n" else found) if word else self.blank  # less the blank the model puts first
        ids = [self.known[word] for word in different]
        sizes = np.array([len(x) for x in ids], np.int64)
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum()))
        first, at = np.cumsum(sizes) - sizes, coded.indices.to_numpy()
        count = sizes[at]
        ends = np.cumsum(count)
        gathered = flat[np.repeat(first[at] - (ends - count), count) + np.arange(int(ends[-1]))]
        cuts = np.concatenate([[0], ends])[split.offsets.to_numpy()]
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            yield gathered[a:b]


@lru_cache(maxsize=2)
def words(path: str) -> Words:
    return Words(tokenizer(path))


def pack(
    docs: DataFrame, model: str = MODEL, size: int = 2048, bucket_tokens: int = 1_000_000, rows_per_matrix: int = 64,
    end_id: int = 2, pad_id: int = 0,
) -> DataFrame:
    """Matrices of all ``docs`` (doc_id, text)."""
    doc_kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"matrix_id long, n_rows int, ids binary, positions binary, cu_seqlens array<array<int>>, "
        f"doc_ids array<array<{doc_kind}>>, parts array<array<int>>"
    )

    def packed(batches):
        model_, encode, to_arrow = tokenizer(model), words(model), None
        kind = np.dtype("<u2" if max(model_.get_piece_size(), size) < 1 << 16 else "<i4")
        number = TaskContext.get().partitionId() << 40
        bucket: list[tuple] = []
        held = 0

        def emit():
            nonlocal number
            made = []
            for m in matrices(bucket, size, rows_per_matrix, pad_id, kind):
                made.append({"matrix_id": number, **m})
                number += 1
            return pa.RecordBatch.from_pylist(made, to_arrow)

        for batch in batches:
            to_arrow = to_arrow or pa.schema([
                ("matrix_id", pa.int64()), ("n_rows", pa.int32()), ("ids", pa.binary()), ("positions", pa.binary()),
                ("cu_seqlens", pa.list_(pa.list_(pa.int32()))), ("doc_ids", pa.list_(pa.list_(batch.schema.field("doc_id").type))), ("parts", pa.list_(pa.list_(pa.int32()))),
            ])
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc_id, found in zip(batch.column("doc_id").to_pylist(), encode(texts), strict=True):
                ids = np.append(found, end_id).astype(kind)
                bucket.extend(segments(doc_id, ids, size))
                held += len(ids)
                if held >= bucket_tokens:
                    yield emit()
                    bucket.clear()
                    held = 0
        if bucket:
            yield emit()

    return docs.select("doc_id", "text").mapInArrow(packed, schema)


def unpack(packed: DataFrame, size: int = 2048, bytes_per_id: int = 2) -> DataFrame:
    """doc_id, part, ids of every segment, read back from the matrices."""
    doc_kind = packed.schema["doc_ids"].dataType.elementType.elementType.simpleString()

    def read(batches):
        for batch in batches:
            out: dict[str, list] = {"doc_id": [], "part": [], "ids": []}
            for m in batch.to_pylist():
                ids = np.frombuffer(m["ids"], f"<u{bytes_per_id}").reshape(m["n_rows"], size)
                for row, ends, names, parts in zip(ids, m["cu_seqlens"], m["doc_ids"], m["parts"], strict=True):
                    for a, b, name, part in zip(ends, ends[1:], names, parts, strict=False):
                        out["doc_id"].append(name)
                        out["part"].append(part)
                        out["ids"].append(row[a:b].astype(np.int32))
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("doc_id", batch.schema.field("doc_ids").type.value_type.value_type), ("part", pa.int32()), ("ids", pa.list_(pa.int32())),
            ]))

    return packed.mapInArrow(read, f"doc_id {doc_kind}, part int, ids array<int>")


def write_packed(packed: DataFrame, path: str) -> None:
    """Write the matrices as Parquet files with binary columns, lightly compressed."""
    packed.write.option("compression", "lz4").parquet(path)


@query()
def op8_packing(spark, sf_dir):
    """All documents as packed matrices."""
    return pack(table(spark, sf_dir, "documents"))
