"""Quality rules: base counts, and the divergence of a text from its language.

Two histograms describe a text: its characters by class, and its words, one bin
for each common word of the known languages and one for all others. References
are the pooled histograms of all documents of a language that pass the base
rules. The Jensen-Shannon distance (square root of the divergence in bits, 0 to
1) of either histogram from its reference is compared with a threshold, unless
the text is too short for that histogram to say much (``min_chars``,
``min_words``).

DataFrame functions only. Texts are read once, in one pass without a shuffle:
repeated windows and histograms come from sorted arrays inside a row, linear in
the text but for the sort. Only counts and the columns in ``keep`` are kept
(landed in the shared folder), then counts are summed by language. References are landed too, one row for each value of
``lang`` with enough text, so Spark knows their size and broadcasts them while
they are under its own threshold.

Defined results: a null or empty text has no words, fails the base rules and
has null distances. Every value of ``lang`` has a reference of its own, whether
``common_words`` lists it or not, if at least ``min_reference_docs`` documents
with ``min_reference_chars`` characters together pass the base rules in it. A
null language has none. A histogram below its minimum, or without a reference,
has a null distance and rejects nothing. Repeated rows and repeated ids are
judged once per row; other columns are ignored unless ``keep`` names them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import computed_once
from .common import landed, query, table

SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
#: Character classes in the order in which they are taken out of a text; the rest is the last one.
CLASSES = {
    "lower": "[a-z]+", "space": SPACE, "other_script": r"[^\x00-\x7F]+", "upper": "[A-Z]+",
    "stop": "[.,;:!?'\"()-]+", "digit": "[0-9]+", "symbol": r"[#*$%&|<>]+",
}
COMMON_WORDS = {
    "en": "the of and to in is was for that with on are this by it be as at he an or a".split(),
    "de": "der die das und in den von zu mit auf für ist im sich des dem ein eine nicht auch".split(),
    "fr": "le la les de des et un une du en que qui dans pas pour au par sur est ne".split(),
    "es": "de la el que y en los se del las por un con no una su para es al lo".split(),
}


def _covered(starts: Column) -> Column:
    """Distinct positions in windows of three that begin at ``starts``."""
    return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda p: F.array(p, p + 1, p + 2)))))


def text_counts(
    docs: DataFrame, common_words: dict[str, list[str]] = COMMON_WORDS, keep: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, lang, base counts, ``chars`` (count by class), ``common`` (word, count) of each text, ``kept c`` of columns c."""
    known = sorted({w for words in common_words.values() for w in words})
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", "lang", text.alias("text"), *[F.col(c).alias(f"kept {c}") for c in keep])
    trimmed = F.btrim("text", F.lit(SPACE_CHARS))
    rows = computed_once(rows, words=F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE)))
    n = F.size("words")
    # window i as a long: hash in the high bits, i in the low ones, so that sorting plain longs brings equal windows together
    bits = F.ceil(F.log2(n + 1)).cast("int")
    keys = F.transform(
        F.sequence(F.lit(1), n - 2),
        lambda i: F.call_function("shiftleft", F.xxhash64(*[F.element_at("words", i + k) for k in range(3)]), F.col("bits")).bitwiseOR(i.cast("long")),
    )
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    common = F.sort_array(F.filter(F.transform("words", lambda w: F.lower(w)), lambda w: w.isin(known)))
    rows = computed_once(rows, bits=bits)
    rows = computed_once(rows, keys=F.sort_array(F.when(n >= 3, keys)), lines=lines, common=common)
    firsts = F.filter(
        F.when(F.size("common") > 0, F.sequence(F.lit(1), F.size("common"))),
        lambda j: (j == 1) | (F.element_at("common", j) != F.element_at("common", F.greatest(j - 1, F.lit(1)))),
    )
    near = F.transform("keys", lambda x, j: F.when(_high(x) == _high(F.get("keys", j + 1)), j))
    rows = computed_once(rows, near=F.filter(near, lambda j: j.isNotNull()), firsts=firsts)
    # neighbours with equal hashes, word by word
    pairs = F.transform("near", lambda j: F.struct(_low(F.get("keys", j)).alias("a"), _low(F.get("keys", j + 1)).alias("b")))
    same = lambda p: F.forall(F.array(*map(F.lit, range(3))), lambda k: (
        F.element_at("words", p["a"] + k) == F.element_at("words", p["b"] + k)
    ))
    repeats = F.flatten(F.transform(F.filter(pairs, same), lambda p: F.array(p["a"], p["b"])))
    counted = F.transform("firsts", lambda f, k: F.struct(
        F.element_at("common", f).alias("word"),
        (F.coalesce(F.get("firsts", k + 1), F.size("common") + 1) - f).alias("n"),
    ))
    rows = _peeled(computed_once(rows, repeats=repeats, common_counts=counted))
    classes = {name: F.element_at("class_counts", k + 1) for k, name in enumerate(CLASSES)}
    return rows.select(
        "doc_id", "lang", n.cast("long").alias("n_words"),
        (F.col("n_chars_all") - classes["space"]).cast("long").alias("word_chars"),
        classes["symbol"].cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(_covered(F.col("repeats")), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.col("n_chars_all").cast("long").alias("n_text_chars"),
        F.col("class_counts").alias("chars"),
        F.coalesce("common_counts", F.array()).alias("common"),
        *[F.col(f"kept {c}") for c in keep],
    )


def _high(key: Column) -> Column:
    return F.call_function("shiftrightunsigned", key, F.col("bits"))


def _low(key: Column) -> Column:
    return key.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bits")) - 1).cast("int")


def _peeled(rows: DataFrame) -> DataFrame:
    """``class_counts``: characters of each class, taken out of the text one class after another."""
    rows, lengths = computed_once(rows, left0=F.col("text"), length0=F.length("text")), [F.col("length0")]
    for k, pattern in enumerate(CLASSES.values()):
        rows = computed_once(rows, **{f"left{k + 1}": F.regexp_replace(f"left{k}", pattern, "")}).drop(f"left{k}")
        rows = computed_once(rows, **{f"length{k + 1}": F.length(f"left{k + 1}")})
        lengths.append(F.col(f"length{k + 1}"))
    counts = [a - b for a, b in zip(lengths, lengths[1:], strict=False)] + [lengths[-1]]
    return rows.select("*", F.col("length0").alias("n_chars_all"), F.array(*counts).alias("class_counts"))


def base_failed(min_words: int = 50, max_repeat_percent: int = 50) -> Column:
    n = F.col("n_words")
    return (n < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * n)


def references(counts: DataFrame, min_docs: int = 10, min_chars: int = 10_000) -> DataFrame:
    """Pooled histograms of each language with enough text: ``ref_chars`` shares by class, ``ref_words`` shares by common word."""
    good = counts.where(~F.col("base_failed") & F.col("lang").isNotNull())
    chars = good.groupBy("lang").agg(
        *[F.sum(F.element_at("chars", k + 1)).alias(f"c{k}") for k in range(len(CLASSES) + 1)],
        F.sum("n_words").alias("words"), F.count(F.lit(1)).alias("docs"),
    )
    total = sum((F.col(f"c{k}") for k in range(1, len(CLASSES) + 1)), F.col("c0"))
    chars = chars.where((F.col("docs") >= min_docs) & (total >= min_chars)).select(
        "lang", "words", F.array(*[F.col(f"c{k}") / total for k in range(len(CLASSES) + 1)]).alias("ref_chars"),
    )
    words = good.select("lang", F.inline("common")).groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = words.join(chars.select("lang", "words"), "lang").groupBy("lang").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("word", (F.col("n") / F.col("words")).alias("q"))))).alias("ref_words"),
    )
    # a language may use none of the common words: all of its words are in the last bin
    ref_words = F.coalesce("ref_words", F.create_map().cast("map<string,double>")).alias("ref_words")
    return chars.join(words, "lang", "left").select("lang", "ref_chars", ref_words)


def _part(p: Column, q: Column) -> Column:
    """What one bin adds to twice the divergence, in nats."""
    half = lambda a, b: F.when(a > 0, a * F.log(2 * a / (a + b))).otherwise(0.0)
    return half(p, q) + half(q, p)


def _total(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)


def _distance(nats: Column) -> Column:
    # greatest() passes over null: without a reference there is no distance
    return F.when(nats.isNotNull(), F.round(F.sqrt(F.greatest(nats / (2 * F.log(F.lit(2.0))), F.lit(0.0))), 6))


def quality_verdicts(
    docs: DataFrame, common_words: dict[str, list[str]] = COMMON_WORDS, max_char_distance: float = 0.31,
    max_word_distance: float = 0.35, min_chars: int = 200, min_words: int = 80, min_reference_docs: int = 10,
    min_reference_chars: int = 10_000, keep: tuple[str, ...] = (),
) -> DataFrame:
    """Base counts, distances, ``kept`` and ``keep`` columns of each row of ``docs`` (doc_id, text, lang)."""
    counts = landed(text_counts(docs, common_words, keep).withColumn("base_failed", base_failed()), "quality-counts")
    refs = landed(references(counts, min_reference_docs, min_reference_chars), "quality-references")
    rows = counts.join(refs, "lang", "left")
    p = lambda c: c / F.col("n_text_chars")
    char_nats = _total(F.zip_with("chars", "ref_chars", lambda c, q: _part(p(c), q)))
    share = lambda s: s["n"] / F.col("n_words")
    q_of = lambda s: F.coalesce(F.element_at("ref_words", s["word"]), F.lit(0.0))
    # a bin that only the reference has adds q * ln 2, so those are left at that: all of q less what the text has
    both = _total(F.transform("common", lambda s: _part(share(s), q_of(s)) - q_of(s) * F.log(F.lit(2.0))))
    common_n = F.aggregate("common", F.lit(0), lambda s, x: s + x["n"])
    all_q = _total(F.map_values("ref_words"))
    rows = computed_once(rows, all_q=all_q, common_n=common_n)
    rest = _part(1 - F.col("common_n") / F.col("n_words"), F.greatest(1 - F.col("all_q"), F.lit(0.0)))
    word_nats = both + F.col("all_q") * F.log(F.lit(2.0)) + rest
    rows = computed_once(
        rows,
        char_distance=F.when(F.col("n_text_chars") >= min_chars, _distance(char_nats)),
        word_distance=F.when(F.col("n_words") >= min_words, _distance(word_nats)),
    )
    far = (F.col("char_distance") > max_char_distance) | (F.col("word_distance") > max_word_distance)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~F.coalesce(far, F.lit(False))).alias("kept"), "char_distance", "word_distance",
        *[F.col(f"kept {c}").alias(c) for c in keep],
    )


_WORDS_SQL = ", ".join(f"('{lang}', '{w}')" for lang, words in COMMON_WORDS.items() for w in words)


@query(
    r"""
WITH words_of(lang, word) AS (VALUES """
    + _WORDS_SQL
    + r"""),
d AS (
  SELECT doc_id, coalesce(text, '') AS text,
    lang AS lang_group FROM documents),
w AS (
  SELECT doc_id, lang_group, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
  FROM (SELECT doc_id, lang_group, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d)),
tri AS (
  SELECT doc_id, i, CASE WHEN lead(w, 2) OVER o IS NOT NULL THEN w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o END AS t
  FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
dup AS (
  SELECT doc_id, i, t IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, t) > 1 AS hit FROM tri),
cov AS (
  SELECT doc_id, count(*) FILTER (hit OR h1 OR h2) AS n_repeat_words, count(*) AS n_words
  FROM (SELECT doc_id, hit, coalesce(lag(hit) OVER o, FALSE) AS h1, coalesce(lag(hit, 2) OVER o, FALSE) AS h2 FROM dup
        WINDOW o AS (PARTITION BY doc_id ORDER BY i)) GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
counts AS (
  SELECT d.doc_id, lang_group, coalesce(n_words, 0) AS n_words, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(n_dup_lines, 0) AS n_dup_lines, length(text) AS n_text_chars,
    length(regexp_replace(text, '[^a-z]', '', 'g')) AS c0, length(regexp_replace(text, '[^\x20\x09-\x0D]', '', 'g')) AS c1,
    length(regexp_replace(text, '[\x00-\x7F]', '', 'g')) AS c2, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS c3,
    length(regexp_replace(text, '[^.,;:!?''"()-]', '', 'g')) AS c4, length(regexp_replace(text, '[^0-9]', '', 'g')) AS c5,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS c6
  FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN lines USING (doc_id)),
based AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    n_text_chars - c0 - c1 - c2 - c3 - c4 - c5 - c6 AS c7 FROM counts),
big AS (
  SELECT lang_group FROM based WHERE NOT base_failed AND lang_group IS NOT NULL
  GROUP BY lang_group HAVING count(*) >= 10 AND sum(n_text_chars) >= 10000),
bins AS (
  SELECT doc_id, k, n, n / nullif(n_text_chars, 0) AS p, lang_group, base_failed
  FROM based, LATERAL (VALUES (0, c0), (1, c1), (2, c2), (3, c3), (4, c4), (5, c5), (6, c6), (7, c7)) v(k, n)),
pooled AS (SELECT lang_group, k, sum(n) AS n FROM bins JOIN big USING (lang_group) WHERE NOT base_failed GROUP BY lang_group, k),
ref AS (SELECT lang_group, k, n / sum(n) OVER (PARTITION BY lang_group) AS q FROM pooled),
char_d AS (
  SELECT doc_id, sum(CASE WHEN p > 0 THEN p * ln(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(2 * q / (p + q)) ELSE 0 END) AS nats
  FROM bins JOIN ref USING (lang_group, k) GROUP BY doc_id),
common AS (
  SELECT doc_id, w.lang_group, lower(w) AS word, count(*) AS n FROM w WHERE lower(w) IN (SELECT word FROM words_of) GROUP BY ALL),
totals AS (SELECT lang_group, sum(n_words) AS words FROM based JOIN big USING (lang_group) WHERE NOT base_failed GROUP BY ALL),
wref AS (
  SELECT lang_group, word, sum(n) / any_value(words) AS q
  FROM common JOIN based USING (doc_id, lang_group) JOIN totals USING (lang_group) WHERE NOT base_failed GROUP BY ALL),
wall AS (SELECT lang_group, coalesce(sum(q), 0) AS all_q FROM totals LEFT JOIN wref USING (lang_group) GROUP BY ALL),
share AS (
  SELECT doc_id, sum(p) AS all_p, sum(p * ln(2 * p / (p + q)) + CASE WHEN q > 0 THEN q * ln(2 * q / (p + q)) ELSE 0 END - q * ln(2)) AS nats
  FROM (SELECT doc_id, n / n_words AS p, coalesce(q, 0) AS q
        FROM common JOIN based USING (doc_id, lang_group) LEFT JOIN wref USING (lang_group, word)) GROUP BY doc_id),
rest AS (
  SELECT doc_id, greatest(1 - coalesce(all_p, 0), 0) AS p, greatest(1 - all_q, 0) AS q, coalesce(nats, 0) + all_q * ln(2) AS nats
  FROM based JOIN wall USING (lang_group) LEFT JOIN share USING (doc_id)),
word_d AS (
  SELECT doc_id, nats + CASE WHEN p > 0 THEN p * ln(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(2 * q / (p + q)) ELSE 0 END AS nats
  FROM rest),
judged AS (
  SELECT b.*, CASE WHEN n_text_chars >= 200 AND c.nats IS NOT NULL THEN round(sqrt(greatest(c.nats / (2 * ln(2)), 0)), 6) END AS char_distance,
    CASE WHEN n_words >= 80 AND w.nats IS NOT NULL THEN round(sqrt(greatest(w.nats / (2 * ln(2)), 0)), 6) END AS word_distance
  FROM based b LEFT JOIN char_d c USING (doc_id) LEFT JOIN word_d w USING (doc_id))
SELECT doc_id, n_words, n_text_chars - c1 AS word_chars, c6 AS n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(char_distance > 0.31, FALSE) AND NOT coalesce(word_distance > 0.35, FALSE) AS kept,
  char_distance, word_distance
FROM judged"""
)
def op4_quality_divergence(spark, sf_dir):
    """Every document's counts, distances from its language and verdict."""
    return quality_verdicts(table(spark, sf_dir, "documents"))
