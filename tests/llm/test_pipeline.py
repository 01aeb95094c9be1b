"""The pipeline over the smallest tables against its stages done plainly; odd rows pass every stage."""

import corpus_pipeline
from brute import components, repeats
from compare import duck
from test_decontaminate import brute as contaminated

from themelake.llm.queries import SQL
from themelake.llm.viterbi_pieces import MODEL, Pieces

SF = "/root/testdata/sf0.001"


def left(text, covered):
    """Text without the characters that lost a byte."""
    out, at = [], 0
    for c in text:
        n = len(c.encode())
        if not any(covered[at : at + n]):
            out.append(c)
        at += n
    return "".join(out)


def test_same_as_plain_stages(spark):
    con = duck(SF)
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({SQL['op4_quality_divergence']}) WHERE kept").fetchall()}
    docs = [r for r in con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall() if r[0] in kept]
    assert 0 < len(docs) < con.execute("SELECT count(*) FROM documents").fetchone()[0]
    linked = components(docs, 5, 80)
    docs = [(d, t) for d, t in docs if linked[d][1] == d]
    docs = [(d, left(t, r[5])) for (d, t), r in zip(docs, repeats(docs), strict=True)]
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    bad = {r[0] for r in contaminated(docs, items) if r[5]}
    vocabulary = Pieces.load(MODEL)
    expected = {d: vocabulary.encode(t) for d, t in docs if d not in bad}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: r.ids for r in rows} == expected and len(rows) == len(expected)


def test_stages(spark):
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["quality", "near_dedup", "repeats", "decontaminate", "pieces"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(None, None, None, None, None), (9001, None, "en", None, 0), (9002, "", None, "s", 0), (9003, "short text", "xx", "s", 10)]
    docs = docs.limit(20).unionAll(spark.createDataFrame(odd, docs.schema)).withColumn("n_words", docs.doc_id * 0)
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == corpus_pipeline.COLUMNS
        assert {9001, 9002, 9003, None} <= {r.doc_id for r in out.collect()}
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert {r.doc_id for r in corpus_pipeline.quality(spark, docs, SF).collect()} & {9001, 9002, 9003} == set()


def test_quality_judges_rows_not_ids(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.quality(spark, docs, SF)
    assert kept.schema.names == corpus_pipeline.COLUMNS
    good = kept.orderBy("doc_id").first()
    junk = [(None, None, None, None, None), (None, "", "en", "s", 0), (None, "junk text", "en", None, 9), (good.doc_id, "junk", "en", "s", 4)]
    clean = [(None, good.text, good.lang, None, 7), (good.doc_id, good.text, good.lang, "again", None)]
    before = sorted(map(tuple, kept.collect()), key=repr)
    after = corpus_pipeline.quality(spark, docs.unionAll(spark.createDataFrame(junk + clean, docs.schema)), SF).collect()
    assert sorted(map(tuple, after), key=repr) == sorted(before + clean, key=repr)
