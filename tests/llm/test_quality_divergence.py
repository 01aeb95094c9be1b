"""Base counts against plain Python; verdicts on texts that are not language."""

import random
import re

from themelake.llm import quality_divergence as Q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, lines = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(covered), failed


def test_counts(spark):
    rng = random.Random(4)
    words = ["the", "The", "a", "der", "été", "x#", "|", "a.b", "\u00a0", "né\u2028"]
    texts = [None, "", " \t\n", "one", "two words", "a b a b a b", "x\n\nx\n x\nx\r\n", "a\x0bb\x0cc", "the " * 300, "😀 😀 😀 😀 z"]
    texts += [rng.choice(" \n").join(rng.choice(words) + rng.choice(["", "", "\n", "  "]) for _ in range(rng.randrange(160))) for _ in range(80)]
    docs = spark.createDataFrame([(i, t, rng.choice(["en", "de", "xx", None]), 7) for i, t in enumerate(texts)], "doc_id long, text string, lang string, n_words long")
    got = {r.doc_id: r for r in Q.quality_verdicts(docs).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(t), (i, t)
        assert not (r.base_failed and r.kept)
    assert got[0].char_distance is None and got[1].word_distance is None
    assert Q.quality_verdicts(docs.limit(0)).count() == 0


def test_distance(spark):
    rng = random.Random(1)
    prose = lambda: " ".join(rng.choice(Q.COMMON_WORDS["en"] + ["house", "garden", "runs", "green", "letters", "window"]) for _ in range(120))
    rows = [(i, prose(), "en") for i in range(40)] + [(40, " ".join("%x" % rng.randrange(10**9) for _ in range(120)), "en"), (41, prose(), "en"), (41, prose(), "en")]
    rows.append((42, " ".join("$$%d##" % rng.randrange(10**6) for _ in range(100)), "en"))
    got = {r.doc_id: r for r in Q.quality_verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[i].kept for i in range(40)) and got[41].kept
    assert not got[40].kept and not got[42].kept and not got[40].base_failed


def test_unlisted_languages_have_references_of_their_own(spark):
    rng = random.Random(2)
    prose = lambda letters, n=120: " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(3, 9))) for _ in range(n))
    latin, cyrillic = "abcdefghijklmnoprstuvz", "абвгдежзийклмнопрстуфхцчшщыьэюя"
    rows = [(i, prose(latin), "it") for i in range(30)] + [(100 + i, prose(cyrillic), "ru") for i in range(30)]
    rows += [(200 + i, prose(cyrillic), None) for i in range(3)] + [(300 + i, prose(latin), None) for i in range(30)]
    rows += [(400 + i, prose(latin if i else cyrillic, 2000), "pl") for i in range(2)] + [(500, prose(latin), "ru")]
    rows.append((501, " ".join(rng.choice(Q.COMMON_WORDS["en"]) + " " + prose(cyrillic, 1) for _ in range(100)), "ru"))
    got = {r.doc_id: r for r in Q.quality_verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert len(got) == len(rows) and {i for i, r in got.items() if not r.kept} == {500, 501}
    assert all(got[i].char_distance < 0.2 and got[i].word_distance is not None for i in range(100, 130))
    # no language, or two documents in it: nothing to compare with
    assert all(got[i].char_distance is None and got[i].word_distance is None for i in got if 200 <= i < 500)


def test_native_plan(spark, plan):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    text = plan(Q.text_counts(docs))
    assert "Python" not in text and "Arrow" not in text and "Exchange" not in text


def test_the_sql_knows_languages_that_are_not_listed(spark, tmp_path):
    """Two languages without a list, one of them too small for a reference, and rows without a language."""
    import random

    import duckdb
    from compare import difference
    from themelake.llm.queries import QUERIES, SQL

    rng, rows = random.Random(3), []
    for lang, letters, n in (("xx", "abcdefghij", 30), ("ru", "абвгдежз", 25), ("tiny", "klmnop", 4), (None, "qrstuv", 6), ("en", "abcdefghijklmnop", 20)):
        for _ in range(n):
            words = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(90, 140))]
            rows.append((len(rows), " ".join([*words, "the", "of"] if lang == "en" else words), lang, "s", 1))
    rows += [(len(rows), "абв " * 3 + " ".join(f"w{i}x" for i in range(200)), "xx", "s", 1), (len(rows) + 1, None, "ru", "s", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    found = QUERIES["op4_quality_divergence"](spark, str(tmp_path))
    assert difference(found, con, SQL["op4_quality_divergence"]) is None
    by_lang = {(r.doc_id, r.char_distance is None) for r in found.collect()}
    assert all((i, True) in by_lang for i, _, lang, _, _ in rows if lang in ("tiny", None))
    assert sum((i, False) in by_lang for i, _, lang, _, _ in rows if lang in ("xx", "ru")) > 50
