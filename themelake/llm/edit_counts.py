"""Token counts that follow edits.

A text is cut into pre-tokens by the tokenizer's pattern; tokens never cross
them, so a count is the sum over pre-tokens. Each document keeps a segment tree
over them: a leaf holds ``leaf`` neighbouring pre-tokens, an inner node the
characters and tokens below it. An edit (replace ``length`` characters at
``start`` by ``text``) descends to the leaf at ``start - CONTEXT`` characters (no
rule of the pattern looks further ahead than that, and a pre-token's match
depends on nothing before it), and cuts anew from that pre-token on until a cut
behind the edit meets an old cut; from there on the old pre-tokens hold. Only the
pre-tokens between are encoded again; leaves that changed pass their new sums up.

Edits of a document are applied in the order of ``seq``, each to the text the
one before left. Positions beyond the end are cut back to it, negative ones and
null ones are 0, a null ``text`` is empty.

Maps over the documents. Attaching edits from a table is one equi-join on doc_id
after they are gathered by document (bounded by the edits of one document).
Defined results: null texts are empty; documents without edits keep their count;
repeated documents are edited once per row; edits with a null or unknown doc_id
are ignored; other columns too. Trees are arrays in the row (``state``), so that
a state can be stored and edited later.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import query, table

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The pattern of this public vocabulary, a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CONTEXT = 4
MEMO = 600_000
EDIT = "array<struct<seq:bigint,start:bigint,length:bigint,text:string>>"


class Counter:
    """Tokens of a pre-token, remembered."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encode = tiktoken.Encoding("counts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.cut = regex.compile(PATTERN)
        self.known: dict[str, int] = {}

    def __call__(self, piece: str) -> int:
        n = self.known.get(piece)
        if n is None:
            n = len(self.encode(piece))
            if len(piece) <= 64:
                if len(self.known) >= MEMO:
                    self.known.clear()
                self.known[piece] = n
        return n


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


class Tree:
    """Segment tree over runs of pre-tokens. Leaves hold (characters, tokens) of each pre-token."""

    def __init__(self, sizes: list[int], tokens: list[int], leaf: int):
        cuts = range(0, max(len(sizes), 1), leaf)
        self.grow([(sizes[i : i + leaf], tokens[i : i + leaf]) for i in cuts], leaf)

    def grow(self, pieces: list[tuple[list[int], list[int]]], leaf: int) -> None:
        """A tree over these leaves."""
        self.leaf, self.pieces = leaf, pieces
        self.width = 1 << (len(self.pieces) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for k, (s, t) in enumerate(self.pieces):
            self.chars[self.width + k], self.tokens[self.width + k] = sum(s), sum(t)
        for node in range(self.width - 1, 0, -1):
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def find(self, at: int) -> tuple[int, int]:
        """Leaf that holds character ``at`` (the last one beyond the end), and where it begins."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if at - start >= self.chars[node] and self.chars[node + 1]:
                start += self.chars[node]
                node += 1
        return min(node - self.width, len(self.pieces) - 1), start

    def settle(self, k: int) -> None:
        """Cut a leaf of more than twice the size, drop empty ones once they are many.

        A new tree then stands over the leaves; it takes as many edits' growth to make the next one needed.
        """
        sizes, tokens = self.pieces[k]
        empty = sum(not s for s, _ in self.pieces) if not sizes or len(sizes) > 2 * self.leaf else 0
        if len(sizes) > 2 * self.leaf:
            cut = [(sizes[i : i + self.leaf], tokens[i : i + self.leaf]) for i in range(0, len(sizes), self.leaf)]
            self.grow([p for p in self.pieces[:k] if p[0]] + cut + [p for p in self.pieces[k + 1 :] if p[0]], self.leaf)
        elif 2 * empty > len(self.pieces) > 1:
            self.grow([p for p in self.pieces if p[0]] or [([], [])], self.leaf)

    def put(self, k: int, sizes: list[int], tokens: list[int]) -> None:
        """Replace a leaf; its sums and those above follow."""
        self.pieces[k] = (sizes, tokens)
        node = self.width + k
        self.chars[node], self.tokens[node] = sum(sizes), sum(tokens)
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]


def build(text: str, count: Counter, leaf: int) -> Tree:
    pieces = count.cut.findall(text)
    return Tree(list(map(len, pieces)), list(map(count, pieces)), leaf)


def edit(tree: Tree, text: str, start: int, length: int, new: str, count: Counter) -> tuple[str, int]:
    """Apply one edit to the tree; returns the text behind it and how many pre-tokens were encoded."""
    start = min(max(start, 0), len(text))
    end = min(start + max(length, 0), len(text))
    after, moved = text[:start] + new + text[end:], len(new) - (end - start)
    first, begin = tree.find(max(start - CONTEXT, 0))
    sizes, tokens = tree.pieces[first]
    skip = 0
    while skip < len(sizes) and begin + sizes[skip] < start - CONTEXT:
        begin += sizes[skip]
        skip += 1
    # old cuts behind the edit, leaf by leaf, as far as the new cuts come
    k, i, old = first, skip, begin
    done, fresh_sizes, fresh_tokens = begin, [], []
    for piece in count.cut.finditer(after, begin):
        fresh_sizes.append(piece.end() - piece.start())
        fresh_tokens.append(count(piece.group()))
        done = piece.end()
        while k < len(tree.pieces) and old < end or old + moved < done:
            if i == len(tree.pieces[k][0]):
                if k + 1 == len(tree.pieces):
                    break
                k, i = k + 1, 0
                continue
            old += tree.pieces[k][0][i]
            i += 1
        if old >= end and old + moved == done and done >= start + len(new):
            break
    else:  # the text ended first: nothing old is left
        k, i = len(tree.pieces) - 1, len(tree.pieces[-1][0])
    rest = (tree.pieces[k][0][i:], tree.pieces[k][1][i:])
    head = (sizes[:skip], tokens[:skip])
    for gone in range(first + 1, k + 1):
        tree.put(gone, [], [])
    tree.put(first, head[0] + fresh_sizes + rest[0], head[1] + fresh_tokens + rest[1])
    tree.settle(first)
    return after, len(fresh_sizes)


STATE = "leaf_sizes array<int>, piece_chars array<int>, piece_tokens array<int>"


def _restored(sizes: list[int], chars: list[int], tokens: list[int], leaf: int) -> Tree:
    tree, i = Tree([], [], leaf), 0
    if sizes:
        leaves = []
        for n in sizes:
            leaves.append((chars[i : i + n], tokens[i : i + n]))
            i += n
        tree.grow(leaves, leaf)
    return tree


def with_edits(docs: DataFrame, edits: DataFrame) -> DataFrame:
    """Add ``edits`` (doc_id, seq, start, length, text) as an array column; nothing where a document has none."""
    one = F.struct(*[F.col(c).cast("bigint").alias(c) for c in ("seq", "start", "length")], F.col("text").cast("string").alias("text"))
    gathered = edits.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.sort_array(F.collect_list(one)).alias("edits"))
    return docs.drop("edits").join(gathered, "doc_id", "left")


def count_after_edits(docs: DataFrame, ranks: str = RANKS, leaf: int = 32, keep_state: bool = False) -> DataFrame:
    """Counts before and after the ``edits`` of each row of ``docs`` (doc_id, text, edits).

    Returns doc_id, n_before, n_after, n_pieces (pre-tokens afterwards) and
    n_encoded (pre-tokens that the edits encoded again); with ``keep_state``
    also the text afterwards and its tree.
    """
    doc_kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_kind}, n_before long, n_after long, n_pieces long, n_encoded long"
    if keep_state:
        schema += f", text string, {STATE}"

    def counted(batches):
        count = counter(ranks)
        for batch in batches:
            out: dict[str, list] = {c.split()[0]: [] for c in schema.split(", ")[1:]}
            for text, edits in zip(batch.column("text").to_pylist(), batch.column("edits").to_pylist(), strict=True):
                text, encoded = text or "", 0
                tree = build(text, count, leaf)
                out["n_before"].append(tree.tokens[1])
                for e in sorted(edits or [], key=lambda e: e["seq"] or 0):
                    text, n = edit(tree, text, e["start"] or 0, e["length"] or 0, e["text"] or "", count)
                    encoded += n
                out["n_after"].append(tree.tokens[1])
                out["n_pieces"].append(sum(len(s) for s, _ in tree.pieces))
                out["n_encoded"].append(encoded)
                if keep_state:
                    out["text"].append(text)
                    out["leaf_sizes"].append(np.array([len(s) for s, _ in tree.pieces], np.int32))
                    out["piece_chars"].append(np.array([x for s, _ in tree.pieces for x in s], np.int32))
                    out["piece_tokens"].append(np.array([x for _, t in tree.pieces for x in t], np.int32))
            arrays = [batch.column("doc_id")] + [
                pa.array(v, pa.string() if c == "text" else pa.int64() if c.startswith("n_") else pa.list_(pa.int32())) for c, v in out.items()
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *out])

    return docs.select("doc_id", "text", F.col("edits").cast(EDIT).alias("edits")).mapInArrow(counted, schema)


def edit_state(state: DataFrame, ranks: str = RANKS, leaf: int = 32) -> DataFrame:
    """Apply ``edits`` to stored trees (doc_id, text, tree columns, edits): texts are not cut again as a whole."""
    doc_kind = state.schema["doc_id"].dataType.simpleString()

    def edited(batches):
        count = counter(ranks)
        for batch in batches:
            before, after, encoded = [], [], []
            rows = zip(*[batch.column(c).to_pylist() for c in ("text", "edits", "leaf_sizes", "piece_chars", "piece_tokens")], strict=True)
            for text, edits, sizes, chars, tokens in rows:
                text, tree, n = text or "", _restored(sizes, chars, tokens, leaf), 0
                before.append(tree.tokens[1])
                for e in sorted(edits or [], key=lambda e: e["seq"] or 0):
                    text, k = edit(tree, text, e["start"] or 0, e["length"] or 0, e["text"] or "", count)
                    n += k
                after.append(tree.tokens[1])
                encoded.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(x, pa.int64()) for x in (before, after, encoded)]],
                names=["doc_id", "n_before", "n_after", "n_encoded"],
            )

    columns = ["doc_id", "text", F.col("edits").cast(EDIT).alias("edits"), "leaf_sizes", "piece_chars", "piece_tokens"]
    return state.select(*columns).mapInArrow(edited, f"doc_id {doc_kind}, n_before long, n_after long, n_encoded long")


@query()
def op9_edit_counts(spark, sf_dir):
    """Every whole document with three edits: a word in the middle replaced, a phrase put in, the first blank-led part cut."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = F.length("text").cast("bigint")
    one = lambda seq, start, length, text: F.struct(
        F.lit(seq).cast("bigint").alias("seq"), start.cast("bigint").alias("start"), F.lit(length).cast("bigint").alias("length"), F.lit(text).alias("text")
    )
    edits = F.array(
        one(1, F.floor(n / 2), 7, " replaced"), one(2, F.floor(n / 3), 0, "it's 42 new\n\n words"), one(3, F.locate(" ", F.col("text")) - 1, 5, "")
    )
    return count_after_edits(docs.withColumn("edits", edits))
