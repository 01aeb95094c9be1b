"""Counts after edits against counting the edited text anew."""

import random

from themelake.llm import edit_counts as E

LETTERS = list("ab cd'’ \n\t 12,.!éß'srelvetm日") + ["'ll", "'re", "  ", "\n\n", "word ", " 42"]


def applied(text, start, length, new):
    start = min(max(start or 0, 0), len(text))
    return text[:start] + (new or "") + text[start + max(length or 0, 0) :]


def test_tree_follows_edits():
    count, rng = E.Counter(E.RANKS), random.Random(1)
    for _ in range(400):
        text = "".join(rng.choice(LETTERS) for _ in range(rng.randrange(300)))
        tree = E.build(text, count, rng.choice([1, 2, 4, 32]))
        for _ in range(5):
            edit = rng.randrange(-2, len(text) + 5), rng.randrange(12), "".join(rng.choice(LETTERS) for _ in range(rng.randrange(8)))
            after, _ = E.edit(tree, text, *edit, count)
            assert after == applied(text, *edit)
            text = after
            assert [n for sizes, _ in tree.pieces for n in sizes] == list(map(len, count.cut.findall(text)))
            assert tree.tokens[1] == len(count.encode(text))


def test_edits_touch_little():
    count = E.Counter(E.RANKS)
    text = "The quick brown fox jumps over the lazy dog. " * 5000
    tree = E.build(text, count, 32)
    after, encoded = E.edit(tree, text, 100_000, 5, "slow", count)
    assert encoded < 20 and tree.tokens[1] == len(count.encode(after))


def test_rows(spark):
    count = E.Counter(E.RANKS)
    texts = {1: "It's a test, isn't it?", 2: None, 3: "", 4: "no edits here", 5: "word " * 20_000}
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts.items()] + [(None, "null id", "x"), (4, "no edits here", "x")], "doc_id long, text string, edits string")
    listed = [(1, 2, 0, 2, "That"), (1, 1, 4, 0, " not"), (2, 1, 3, 3, "new text"), (3, 1, None, None, None), (5, 1, 50_000, 9, "12 34"), (None, 1, 0, 1, "z"), (99, 1, 0, 0, "q")]
    edits = spark.createDataFrame(listed, "doc_id long, seq long, start long, length long, text string")
    rows = E.count_after_edits(E.with_edits(docs, edits), leaf=4, keep_state=True).collect()
    assert len(rows) == 7
    for r in rows:
        text = (texts.get(r.doc_id) or "") if r.doc_id else "null id"
        assert r.n_before == len(count.encode(text))
        for e in sorted(x for x in listed if x[0] is not None and x[0] == r.doc_id):
            text = applied(text, *e[2:])
        assert r.text == text and r.n_after == len(count.encode(text)) and r.n_pieces == len(count.cut.findall(text))
    # stored trees go on from there
    state = E.count_after_edits(E.with_edits(docs, edits), leaf=4, keep_state=True)
    more = spark.createDataFrame([(1, 1, 3, 4, "xyz"), (3, 1, 0, 0, "first words")], "doc_id long, seq long, start long, length long, text string")
    after = {r.doc_id: r for r in E.edit_state(E.with_edits(state, more), leaf=4).collect()}
    left = {r.doc_id: r.text for r in rows}
    assert after[1].n_after == len(count.encode(applied(left[1], 3, 4, "xyz"))) and after[3].n_after == len(count.encode("first words"))
    assert after[5].n_after == after[5].n_before and after[5].n_encoded == 0
    assert E.count_after_edits(E.with_edits(docs.limit(0), edits)).count() == 0


def test_leaves_stay_small_under_large_insertions_and_cuts():
    count, rng = E.Counter(E.RANKS), random.Random(3)
    text = "The quick brown fox. " * 50
    tree = E.build(text, count, 32)
    text, _ = E.edit(tree, text, 500, 0, " word" * 40_000, count)
    assert max(len(s) for s, _ in tree.pieces) <= 64 and tree.tokens[1] == len(count.encode(text))
    for _ in range(60):
        at = rng.randrange(len(text))
        text, n = E.edit(tree, text, at, rng.choice([3, 2000]), " new words" * rng.choice([1, 30, 400]), count)
        assert max(len(s) for s, _ in tree.pieces) <= 64 and n < 2000
    assert tree.tokens[1] == len(count.encode(text)) and [n for s, _ in tree.pieces for n in s] == list(map(len, count.cut.findall(text)))
    text, _ = E.edit(tree, text, 0, len(text), "", count)
    assert text == "" and tree.tokens[1] == 0
    text, _ = E.edit(tree, text, 0, 0, "back again", count)
    assert tree.tokens[1] == len(count.encode(text))
