"""Roots and witnesses against a tree built level by level."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from themelake.llm import merkle_manifest as M
from themelake.llm.queries import QUERIES


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(leaves):
    """Root, and for each leaf its siblings as (left, digest or None)."""
    siblings, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for i, p in enumerate(at):
            other = p ^ 1
            siblings[i].append((p % 2 == 1, level[other] if other < len(level) else None))
        level = [h("".join(level[i : i + 2])) for i in range(0, len(level), 2)]
        at = [p // 2 for p in at]
    return level[0], siblings


def fold(leaf, siblings):
    for left, s in siblings:
        leaf = h(leaf if s is None else s + leaf if left else leaf + s)
    return leaf


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(row, more=0):
    doc_id, source, lang, n, text = row
    return h("".join(field(v) for v in (doc_id, source, lang, None if n is None else n + more, text)))


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    inner, subroots = [], []
    for g in names:
        mine = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        subroot, siblings = tree([leaf_of(r) for r in mine])
        subroots.append(subroot)
        inner.append((mine, siblings))
    root, above = tree(subroots)
    out = []
    for (mine, siblings), subroot, top in zip(inner, subroots, above, strict=True):
        for r, s in zip(mine, siblings, strict=True):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            got = fold(leaf_of(r, 1 if hit else 0), s + top)
            out.append((r[0], leaf_of(r), subroot, root, h("".join(d for _, d in s + top if d)), got, got == root))
    return sorted(out, key=repr)


def written(spark, folder, rows):
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    docs.select("*", F.lit("x").alias("digest"), F.lit(3).alias("pos"), F.lit("r").alias("root"), F.lit(0).alias("number")).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def rows_of(n):
    return [(i * 3 % 101, f"s{i % 3}", ["en", "de", "fr"][i % 7 % 3], i, f"text {i} é") for i in range(n)]


DIRTY = [
    (1, None, "en", None, None), (2, "s", "en", 3, ""), (2, "s", "en", 3, ""), (2, "s", "en", 3, "other"), (None, "s", "en", 1, "null id"),
    (None, "s", "en", 1, "null id"), (3, "s", None, 1, "null lang"), (4, "s", "", 1, "empty lang"), (5, "s", "É", 1, "x"), (6, "s", "z", 1, "y"),
    (-7, "s", "z", 1, "negative"), (8, "1:a", "z", -5, "-"), (9, "s", "z", 9223372036854775806, "long " * 300_000),
] + [(i, "s", "z", 1, "t") for i in range(100, 130)]
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def found(df):
    return sorted([tuple(r) for r in df.select(*COLUMNS).collect()], key=repr)


@pytest.mark.parametrize("rows", [DIRTY, rows_of(1), rows_of(2), rows_of(100)], ids=["dirty", "one", "two", "hundred"])
def test_query(spark, tmp_path, rows):
    assert found(QUERIES["op13_merkle_manifest"](spark, written(spark, tmp_path, rows))) == brute(rows)


def test_empty_table(spark, tmp_path):
    assert QUERIES["op13_merkle_manifest"](spark, written(spark, tmp_path, [])).count() == 0


def test_frontier_grows_witnesses_for_every_number_of_leaves():
    for n in range(1, 70):
        leaves = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
        frontier = M.Frontier()
        for leaf in leaves:
            frontier.append(leaf)
        root, siblings = tree([x.hex() for x in leaves])
        assert frontier.close().hex() == root
        assert [[(left, d and d.hex()) for left, d in w] for w in frontier.witnesses] == [[(left and d is not None, d) for left, d in s] for s in siblings]


@pytest.mark.parametrize("sizes", [(1,), (4,), (5,), (64, 1, 17), (300, 3, 65, 16)])
def test_blocks_of_four_in_several_rounds(spark, sizes):
    rows = [(f"g{g}", i, hashlib.sha256(f"{g}.{i}".encode()).digest(), "extra") for g, n in enumerate(sizes) for i in range(n)]
    leaves = spark.createDataFrame(rows, "name string, k long, digest binary, note string").repartition(5)
    got = M.manifest(leaves, "name", ["k"], height=2)
    inner = [tree([r[2].hex() for r in rows if r[0] == f"g{g}"]) for g in range(len(sizes))]
    root, above = tree([r for r, _ in inner])
    expected = {(f"g{g}", i): (inner[g][0], fold(None or rows_leaf, s + above[g])) for g, n in enumerate(sizes) for i, s in enumerate(inner[g][1])
                for rows_leaf in [hashlib.sha256(f"{g}.{i}".encode()).hexdigest()]}
    again = got.select("name", "k", M.hex_text(F.col("subroot")).alias("s"), M.hex_text(F.col("root")).alias("r"), M.folded(F.col("digest"), F.col("witness")).alias("f"),
                       "pos", "total", "note", F.size("witness").alias("w"))
    out = again.collect()
    assert len(out) == len(rows) and all(r.r == root == r.f and r.pos == r.k and r.note == "extra" for r in out)
    assert {(r.name, r.k): (r.s, r.f) for r in out} == expected
    assert all(r.w == len(inner[int(r.name[1:])][1][r.k]) + len(above[int(r.name[1:])]) for r in out)


def test_equal_rows_spread_over_partitions(spark):
    """A thousand equal rows are leaves of their own, numbered without gaps."""
    same = spark.range(1000).select(F.lit("g").alias("g"), F.lit(5).alias("k"), F.unhex(F.lit("ab")).alias("digest"), "id")
    got = M.numbered(same, "g", ["k", "digest", "id"])
    assert sorted(r.pos for r in got.select("pos").collect()) == list(range(1000))
    assert got.select("total").distinct().collect()[0].total == 1000
