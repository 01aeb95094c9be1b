"""Viterbi pieces against the public library's unigram encoder over the same vocabulary, and round trips."""

import random

import pytest
import sentencepiece

from themelake.llm import viterbi_pieces as V


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    """The model file with its type set to unigram, so that the library runs Viterbi on its scores."""
    data = open(V.MODEL, "rb").read()
    assert data.count(b"tok_v0\x18\x02") == 1
    return sentencepiece.SentencePieceProcessor(model_proto=data.replace(b"tok_v0\x18\x02", b"tok_v0\x18\x01"))


TEXTS = [
    "", " ", "  ", "a", "The quick brown fox jumps over the lazy dog.", "  two  blanks   and\nlines\n\n", "naïve über ßtraße ñandú",
    "日本語の文章です。漢字", "emoji 👩‍👩‍👧‍👧 ok", "tab\tand\rreturn", "x" * 300, "IllegalArgumentException addEventListener", "\n", " \n ", "a ",
]


def test_as_good_as_library(unigram):
    """The library's best path (of its exact n-best search) has the same score; of equal scores either may win."""
    vocabulary = V.Pieces.load(V.MODEL)
    rng = random.Random(3)
    made = [" ".join("".join(rng.choice("abcdefgheèñ.ITtheofanding") for _ in range(rng.randrange(1, 15))) for _ in range(rng.randrange(1, 12))) for _ in range(300)]
    for text in ["The quick brown fox jumps over the lazy dog.", "naïve über", "IllegalArgumentException addEventListener", *made]:
        ours, theirs = vocabulary.encode(text), unigram.nbest_encode_as_ids(text, 2)[0]
        assert sum(map(unigram.get_score, ours)) == sum(map(unigram.get_score, theirs)), repr(text)


def test_round_trips():
    vocabulary = V.Pieces.load(V.MODEL)
    for text in TEXTS:
        assert vocabulary.decode(vocabulary.encode(text)) == text


def _brute(pieces, text, penalty):
    """Best score by plain recursion over all boundaries."""
    best = {0: 0.0}
    for end in range(1, len(text) + 1):
        best[end] = max(
            best[start] + (pieces[text[start:end]] if text[start:end] in pieces else penalty)
            for start in range(end) if text[start:end] in pieces or end - start == 1
        )
    return best[len(text)]


def test_window_commits_the_best_path():
    rng = random.Random(5)
    words = {"".join(rng.choice("ab▁") for _ in range(rng.randrange(1, 6))): -rng.random() * 9 for _ in range(30)}
    listed = list(words.items())
    v = V.Pieces(listed, list(range(1000, 1256)), [])
    scores = [s for _, s in listed]
    for n in (1, 5, 40, 2000):
        text = "".join(rng.choice("ab▁c") for _ in range(n))
        ids = v.stream(text)
        total = sum(scores[i] if i < 1000 else v.unknown for i in ids)
        blanks = sum(1 for i in ids if i >= 1000 and i - 1000 >= 128)  # a blank mark that is unknown gives three byte ids
        total -= v.unknown * (blanks - blanks // 3)
        assert total == pytest.approx(_brute(words, text, v.unknown), rel=1e-9)


def test_pending_text_is_bounded(monkeypatch):
    vocabulary = V.Pieces.load(V.MODEL)
    held = []
    meeting = V.Pieces._meeting
    monkeypatch.setattr(V.Pieces, "_meeting", staticmethod(lambda back, base, first: held.append(len(back)) or meeting(back, base, first)))
    ids = vocabulary.stream("internationalisation" * 5000)
    assert max(held) < 200 and len(ids) > 5000


def test_rows(spark):
    docs = spark.createDataFrame(
        [(1, "Hello  wörld\n", "x"), (2, None, "x"), (None, "", "y"), (3, "a▁b", None), (3, "a▁b", None), (4, "word " * 30000, None)],
        "doc_id long, text string, ids string",
    )
    out = V.encode(docs).collect()
    assert len(out) == 6
    by = {r.doc_id: r for r in out}
    assert by[2].ids == [] and by[2].round_trip and by[None].ids == [] and not by[3].round_trip and by[4].round_trip
    back = {r.doc_id: r.text for r in V.decode(V.encode(docs)).collect()}
    assert back[1] == "Hello  wörld\n" and back[2] == "" and back[3] == "a b" and back[4] == "word " * 30000
    assert V.encode(docs.limit(0)).count() == 0
