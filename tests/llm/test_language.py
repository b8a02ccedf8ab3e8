import random
import zlib

import numpy as np

from starling.llm import language
from starling.llm.language import CrossParser, LanguageModel, identify, learn_languages, suffix_automaton


def longest_match_phrases(text, training):
    """Cross-parsing by brute force over symbol strings."""
    n, i = 0, 0
    while i < len(text):
        length = 1
        while i + length < len(text) and text[i:i + length + 1] in training:
            length += 1
        n, i = n + 1, i + (length if text[i:i + length] in training else 1)
    return n


def test_automaton_accepts_exactly_the_substrings():
    text = [0, 1, 1, 2, 0, 1, 2, 2, 1, 0, 0, 1]
    step = suffix_automaton(text, 3)
    inside = {tuple(text[a:b]) for a in range(len(text)) for b in range(a, len(text) + 1)}
    from itertools import product
    for n in range(1, 6):
        for word in product(range(3), repeat=n):
            state = 0
            for symbol in word:
                state = step[state, symbol] if state >= 0 else -1
            assert (state >= 0) == (word in inside)


def test_phrases_by_brute_force():
    model = LanguageModel((("a", "the cat sat on the mat and the hat"), ("b", "der hund und die katze")))
    parser = CrossParser(model)
    texts = ["the hat sat", "und die hunde", "zzz qqq", "x", "the " * 300, "", "the cat sat " * 900, "e" * 40_000,
             "".join(random.Random(5).choice("the catsondru ") for _ in range(9000))]
    symbols = [parser.symbols(t) for t in texts]
    training = ["".join(map(chr, parser.symbols(t) + 65)) for _, t in model.texts]
    got = parser.phrases(symbols)
    for row, s in zip(got, symbols):
        for k, train in enumerate(training):
            assert row[k] == longest_match_phrases("".join(map(chr, s + 65)), train)


def test_phrases_run_on_over_chunks_of_blocks(monkeypatch):
    """Texts of many blocks, few of which are parsed together; one whose phrases never fall into step."""
    monkeypatch.setattr(language, "_BLOCK", 16)
    monkeypatch.setattr(language, "_TOGETHER", 64)
    monkeypatch.setattr(language, "_ROUNDS", 2)
    parser = CrossParser(LanguageModel((("a", "a" * 11), ("b", "abcab cabbac"))))
    rnd = random.Random(6)
    texts = ["a" * 700, "abc", "", "".join(rnd.choice("abc ") for _ in range(900)), "a" * 333]
    symbols = [parser.symbols(t) for t in texts]
    training = ["".join(map(chr, parser.symbols(t) + 65)) for t in ("a" * 11, "abcab cabbac")]
    coded = ["".join(map(chr, s + 65)) for s in symbols]
    assert parser.phrases(symbols).tolist() == [[longest_match_phrases(c, t) for t in training] for c in coded]


def test_training_takes_whole_texts(spark):
    rows = [(n, f"word{'x' * n} ", "en") for n in range(30)] + [(50, "lang " * 2000, "de"), (51, "kurz", "fr")]
    model = dict(learn_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows=4).texts)
    assert model.keys() == {"en", "de", "fr"} and model["de"] == "lang " * 2000
    assert set(model["en"].split("\n")) <= {text for _, text, lang in rows if lang == "en"}


def test_languages_in_many_scripts():
    """Two languages in each script, told apart by their words; Han has more letters than columns."""
    rnd = random.Random(4)
    scripts = {"greek": (0x3B1, 24, 9), "cyrillic": (0x430, 32, 9), "arabic": (0x627, 28, 9),
               "han": (0x4E00, 3000, 2), "latin": (0x61, 26, 9)}
    words = {
        f"{name}{n}": ["".join(chr(low + rnd.randrange(size)) for _ in range(rnd.randrange(1, most + 1)))
                       for _ in range(400)]
        for name, (low, size, most) in scripts.items() for n in (1, 2)
    }
    text = lambda lang, n: " ".join(rnd.choice(words[lang]) for _ in range(n))
    for symbols in (62, 5):
        # The more a script is written, the more frequent its letters: han comes last.
        model = LanguageModel(tuple((k, text(k, 400 if "han" in k else 1500)) for k in sorted(words)), symbols)
        parser = CrossParser(model)
        texts = [text(lang, 40) for lang in words]
        assert parser.predict(texts)[0] == list(words)
        coded = ["".join(map(chr, parser.symbols(t) + 65)) for t in texts]
        training = ["".join(map(chr, parser.symbols(t) + 65)) for _, t in model.texts]
        want = [[longest_match_phrases(c, t) for t in training] for c in coded]
        assert parser.phrases([parser.symbols(t) for t in texts]).tolist() == want


def test_held_out_accuracy(small_batches):
    docs = small_batches.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = {i for i in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    train = docs.where(~docs.doc_id.isin(list(held)))
    got = {r.doc_id: r for r in identify(docs, learn_languages(train)).collect()}
    assert got.keys() == rows.keys()
    assert all(0 <= r.score <= 1 for r in got.values())
    right = [got[i].lang_pred == rows[i] for i in held]
    assert np.mean(right) > 0.97


def test_odd_rows(odd, empty, clashing):
    model = learn_languages(odd)
    for docs in (odd, clashing):
        got = {r.doc_id: r.lang_pred for r in identify(docs, model).collect()}
        assert got[1] == got[2] == got[3] == "und"
        assert {got[4], got[5], got[8]} <= {"en", "de"}
    assert identify(empty, model).count() == 0
    nothing = learn_languages(empty)
    assert {r.lang_pred for r in identify(odd, nothing).collect()} == {"und"}
