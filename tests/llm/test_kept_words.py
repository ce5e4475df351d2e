"""Words and neighbours that workers keep."""

import sentencepiece

from skylag.llm import pieces, queries, token_files


def test_frequent_words_are_composed_once(monkeypatch):
    """Words that come again stay when the kept ones are too many."""
    monkeypatch.setattr(pieces, "KEPT_WORDS", 10)
    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    fst, composed = pieces.Transducer(queries.PIECES), []
    word = fst._word
    monkeypatch.setattr(fst, "_word", lambda w: composed.append(w) or word(w))
    for k in range(60):
        text = f"hello wörld{k}x, hello 日本{k}."
        assert fst.encode(text) == library.encode(text) and fst.decode(fst.encode(text)) == text
    assert composed.count("▁hello") == 1
    assert len(fst.known) + len(fst.older) <= 20


def test_neighbours_are_kept_within_bounds(monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_PAIRS", 5)
    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    fst = pieces.Transducer(queries.PIECES)
    for text in ("internationalisation, of unbelievable", "  a  b ", "▁▁ x", "\n\t ...!? É́ 😀", "a" * 300, ""):
        assert fst.encode(text) == library.encode(text)
        assert len(fst.near) <= 5


def test_words_of_several_tasks_are_kept():
    """A worker keeps the words of its next tasks: clearing them at half a million made most of them new again."""
    encoder = token_files.WordEncoder(queries.TOKENIZER, "<u2")
    encoder.known.update((b"%d" % k, b"") for k in range(600_000))
    first = encoder.encode(["Hello there."])
    learned = []
    encoder._learn = learned.append
    assert encoder.encode(["Hello there."]) == first and not learned
    assert len(encoder.known) > 600_000
