"""SentencePiece encoding and decoding by streaming Viterbi.

Among all ways to cut a text into pieces of the vocabulary, the one with the
highest sum of piece scores is chosen (a unigram model over the vocabulary).
Blanks are marked ``▁``, one more stands before a text that is not empty.
A character without a piece of its own costs the lowest score less 10 and
becomes the ids of its UTF-8 bytes. Of equal scores, the cut that reaches a
boundary first from the left wins, that is the longest last piece.

The encoder reads a text character by character and looks back no further than
the longest piece. Boundaries within that window are alive; whenever the
backpointer paths of all of them meet in one boundary, the ids before it are
committed and forgotten. Text between two boundaries that no piece can span
(before a blank mark that follows another character; around a line break, if no
piece has one) always commits as a whole, so its ids are remembered, in a table
of at most ``MEMO`` entries. Memory is bounded by that table, the window and the
uncommitted part, whatever the length of the text.

A map over the documents: no shuffle. Defined results: null and empty texts have
no ids and decode to the empty text. A text that holds the blank mark itself
decodes with a blank in its place (``round_trip`` is false). Repeated rows are
encoded once per row, other columns ignored.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import query, table

BLANK = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
UNKNOWN_PENALTY = 10.0
MEMO = 600_000


class Pieces:
    """Vocabulary: piece texts and scores, as a tree of characters."""

    def __init__(self, pieces: list[tuple[str, float]], byte_ids: list[int], spellings: list[bytes]):
        """``pieces``: text and score by id, a score of None where a text is never used to encode."""
        self.tree: dict = {}
        self.byte_ids, self.spellings = byte_ids, spellings
        used = [(i, p, s) for i, (p, s) in enumerate(pieces) if s is not None and p]
        for i, p, s in used:
            node = self.tree
            for c in p:
                node = node.setdefault(c, {})
            node[""] = (i, s)
        self.longest = max((len(p) for _, p, _ in used), default=1)
        self.unknown = min((s for _, _, s in used), default=0.0) - UNKNOWN_PENALTY
        inner = any(BLANK in p.lstrip(BLANK) for _, p, _ in used)
        lines = any("\n" in p for _, p, _ in used)
        #: cuts a text where no piece reaches across
        self.spans = re.compile("(?s).+" if inner else f"{BLANK}*[^{BLANK}]+|{BLANK}+" if lines else f"{BLANK}*[^{BLANK}\n]+|\n|{BLANK}+")
        self.recent: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    @classmethod
    def load(cls, path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        byte_ids, pieces, spellings = [0] * 256, [], []
        for i in range(model.get_piece_size()):
            text = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(text[3:5], 16)] = i
                pieces.append((text, None))
                spellings.append(bytes([int(text[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                pieces.append((text, None))
                spellings.append(b"")
            else:
                pieces.append((text, model.get_score(i)))
                spellings.append(text.replace(BLANK, " ").encode())
        return cls(pieces, byte_ids, spellings)

    def stream(self, text: str) -> list[int]:
        """Ids of one span, committed as soon as they are certain."""
        out: list[int] = []
        base, n, tree, unknown, least = 0, len(text), self.tree, self.unknown, float("-inf")
        limit = 4 * self.longest
        room = min(n, limit + self.longest) + 1
        # by boundary less base: best score, boundary before, id of the piece between (-1: none)
        score, back, piece = [least] * room, [-1] * room, [-1] * room
        score[0] = 0.0
        for p in range(n):
            at = p - base
            here, node, q, single = score[at], tree, p, False
            for c in text[p : p + self.longest]:
                node = node.get(c)
                if node is None:
                    break
                q += 1
                end = node.get("")
                if end is not None:
                    if q == p + 1:
                        single = True
                    s = here + end[1]
                    if s > score[q - base]:
                        score[q - base], back[q - base], piece[q - base] = s, p, end[0]
            if not single and here + unknown > score[at + 1]:
                score[at + 1], back[at + 1], piece[at + 1] = here + unknown, p, -1
            if at >= limit and p + 1 < n:
                meet = self._meeting(back, base, p + 1)
                out += self._path(text, back, piece, base, meet)
                done = meet - base
                del score[:done], back[:done], piece[:done]
                base = meet
                limit = max(4 * self.longest, p + 1 - base + self.longest)
                more = limit + self.longest + 1 - len(score)
                score += [least] * more
                back += [-1] * more
                piece += [-1] * more
        return out + self._path(text, back, piece, base, n)

    @staticmethod
    def _meeting(back: list, base: int, first: int) -> int:
        """The boundary where the paths of all live boundaries (from ``first`` on) meet."""
        alive = {k + base for k in range(first - base, len(back)) if back[k] >= 0}
        while len(alive) > 1:
            last = max(alive)
            alive.remove(last)
            alive.add(back[last - base])
        return alive.pop()

    def _path(self, text: str, back: list, piece: list, base: int, end: int) -> list[int]:
        found: list[int] = []
        while end > base:
            i, start = piece[end - base], back[end - base]
            if i >= 0:
                found.append(i)
            else:
                found += [self.byte_ids[b] for b in reversed(text[start:end].encode("utf-8", "surrogatepass"))]
            end = start
        return found[::-1]

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        out: list[int] = []
        recent = self.recent.get
        for span in self.spans.findall(BLANK + text.replace(" ", BLANK)):
            ids = recent(span)
            if ids is None:
                ids = self._remembered(span)
                recent = self.recent.get
            out += ids
        return out

    def _remembered(self, span: str) -> tuple[int, ...]:
        """Ids of a span not met recently: from the older half of the memory, or encoded."""
        ids = self.older.get(span) or tuple(self.stream(span))
        if len(span) <= 64:
            if 2 * len(self.recent) >= MEMO:
                self.older, self.recent = self.recent, {}
            self.recent[span] = ids
        return ids

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.spellings.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """The vocabulary, loaded once in each worker."""
    return Pieces.load(path)


def encode(docs: DataFrame, model: str = MODEL, column: str = "text") -> DataFrame:
    """doc_id, ids and whether decoding the ids gives the text back (null as the empty text)."""

    def encoded(batches):
        vocabulary = pieces(model)
        for batch in batches:
            counts, parts, same = [0], [], []
            for text in batch.column(column).to_pylist():
                ids = vocabulary.encode(text)
                counts.append(len(ids))
                parts.append(np.array(ids, dtype=np.int32))
                same.append(vocabulary.decode(ids) == (text or ""))
            values = np.concatenate(parts) if parts else np.zeros(0, np.int32)
            ids = pa.ListArray.from_arrays(pa.array(np.cumsum(counts), pa.int32()), pa.array(values))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, pa.array(same, pa.bool_())], names=["doc_id", "ids", "round_trip"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", column).mapInArrow(encoded, f"doc_id {kind}, ids array<int>, round_trip boolean")


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and text of rows with ``ids``; null ids are the empty text."""

    def decoded(batches):
        vocabulary = pieces(model)
        for batch in batches:
            texts = [vocabulary.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(decoded, f"doc_id {kind}, text string")


@query()
def op2_sentencepiece(spark, sf_dir):
    """Ids of every whole document, and whether they decode to it."""
    return encode(table(spark, sf_dir, "documents"))
