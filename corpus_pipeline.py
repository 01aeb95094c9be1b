"""Corpus pipeline: stages applied to ``documents`` one after another.

Every stage works on all rows of the one before and returns the columns of
``documents``, the last one the ids of the pieces. Rows with a null doc_id pass
the stages that compare documents. Empty input gives empty output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from themelake.llm.bottomk_dedup import near_duplicates
from themelake.llm.common import landed, let_workers_import, table
from themelake.llm.decontaminate import find_contamination
from themelake.llm.parse_dedup import remove_repeats
from themelake.llm.quality_divergence import quality_verdicts
from themelake.llm.viterbi_pieces import encode

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: SQL cannot express the sketches, the parse and the pieces; tests compare the rows with brute force.
ORACLE_SQL = None


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` less the ids in ``dropped``."""
    return docs.select(*COLUMNS).join(dropped.select("doc_id").distinct(), "doc_id", "left_anti").select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality rules reject go, each by its own verdict, whatever its id."""
    judged = quality_verdicts(docs, keep=("text", "lang", "source", "n_chars"))
    return judged.where("kept").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 on shingles of five words, the one with the smallest id stays."""
    return _without(docs, near_duplicates(docs, words=5, percent=80).where("NOT kept"))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes that start in a document with a smaller id are cut out; a character goes whole."""
    cut = remove_repeats(docs, keep=("lang", "source"), texts=True)
    return cut.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    judged = find_contamination(docs, table(spark, sf_dir, "benchmark"), keep=("text", "lang", "source", "n_chars"))
    return judged.where("NOT contaminated").select(*COLUMNS)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the pieces of each text."""
    return encode(docs)


STAGES = [
    ("quality rules", quality), ("near duplicates", near_dedup), ("repeated strings", repeats),
    ("benchmark decontamination", decontaminate), ("pieces", pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again before the next."""
    let_workers_import(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = landed(docs, f"stage{k}")
    return docs
