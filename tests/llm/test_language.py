"""Cross-parsing against a plain walk, and held-out accuracy."""

import random
import zlib

import numpy as np

from statmart.llm import langid


def phrases_by_search(sample, symbols):
    """Greedy parse of each block by substring search; an unknown symbol ends a phrase, too."""
    total = 0
    for at in range(0, len(symbols), langid.BLOCK):
        total += 1
        phrase = b""
        for c in symbols[at:at + langid.BLOCK]:
            c = bytes([c])
            if phrase + c in sample:
                phrase += c
            else:
                total += 1
                phrase = c if c in sample else b""
    return total


def test_phrases_equal_a_plain_parse():
    rnd = random.Random(4)
    texts = {g: ["".join(rnd.choice(a) for _ in range(300)) for _ in range(3)]
             for g, a in (("a", "abc d"), ("b", "bcde "), ("c", "xyz "))}
    model = langid.build_model(texts, alphabet=6)
    tests = ["".join(rnd.choice("abcdexyzé \n,") for _ in range(n)) for n in (0, 1, 3, 50, 511, 512, 513, 2000)]
    symbols = [model.symbols(t) for t in tests]
    got = model.phrases(symbols)
    for k, g in enumerate(model.languages):
        joined = b"".join(bytes(model.symbols(t)) + b"\xff" for t in texts[g])
        other = model.lookup.max()
        for i, s in enumerate(symbols):
            s = bytes(x if x != other else 254 for x in s)  # letters outside the alphabet match nothing
            want = phrases_by_search(joined.replace(bytes([other]), b"\xff"), s)
            assert got[i, k] == want, (g, tests[i][:40])


def test_predictions_of_odd_texts(spark):
    train = spark.createDataFrame(
        [(i, t, g, "x") for i, (t, g) in enumerate([("the cat and the dog sat", "en"), ("der hund und die katze", "de")] * 8
                                                  + [(None, "en"), ("...", "de"), ("lost", None)])],
        "doc_id long, text string, lang string, lang_pred string")
    model = langid.fit_language_model(train)
    rows = [(1, None), (2, ""), (3, "12 ...!"), (4, "the dog and the cat"), (5, "die katze und der hund"),
            (5, "die katze und der hund"), (6, "the dog sat " * 20_000)]
    out = langid.predict_language(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    got = sorted((r["doc_id"], r["lang_pred"]) for r in out)
    assert got == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (5, "de"), (5, "de"), (6, "en")]
    assert all(0 <= r["score"] <= 1 for r in out)
    empty = langid.fit_language_model(train.limit(0))
    assert {r["lang_pred"] for r in langid.predict_language(train, empty).collect()} == {"und"}


def test_wrong_labels_are_left_out():
    rnd = random.Random(1)
    words = {"a": ["abba", "baba", "aab"], "b": ["xyy", "yxxy", "xyx"]}
    make = lambda g: " ".join(rnd.choice(words[g]) for _ in range(60))
    texts = {g: [make(g) for _ in range(20)] for g in words}
    texts["a"][3], texts["a"][8] = make("b"), make("b")
    model = langid.build_model(texts)
    assert model.predict([make("a"), make("b")])[0] == ["a", "b"]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    out = langid.op3_language_id(spark, sf).collect()
    lang = {r[0]: r[1] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    assert len(out) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    right = [r["lang_pred"] == lang[r["doc_id"]] for r in out if r["held_out"]]
    assert np.mean(right) > 0.97


def spoken(rnd, words, n=60):
    return " ".join(rnd.choice(words) for _ in range(n))


def test_stage_rejects_by_entropy(spark):
    import corpus_pipeline as cp
    rnd = random.Random(7)
    syllables = {"en": ["the", "and", "ing", "tion", "her", "was", "out"], "de": ["der", "und", "ich", "sch", "ein", "ung", "keit"],
                 "xx": ["qax", "zob", "vyk", "jwu", "xif", "pqo", "kzy"]}
    words = {g: ["".join(rnd.choice(s) for _ in range(rnd.randint(1, 3))) for _ in range(80)] for g, s in syllables.items()}
    rows = [(i, spoken(rnd, words[g]), g) for i, g in enumerate(["en", "de"] * 60)]
    odd = {1000: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(300)),  # gibberish
           1001: spoken(rnd, words["xx"]),  # a language that was never learned
           1002: "12 % 4411 // 99 ++ a 3 ## 17.50 -- 8", 1003: "1234 ...", 1004: None}
    good = {2000: spoken(rnd, words["en"], 8), 2001: spoken(rnd, words["de"], 400), 2002: "Out.", 2003: words["en"][3]}
    rows += [(i, t, None) for i, t in {**odd, **good}.items()]
    docs = spark.createDataFrame([(i, t, g, "s", len(t or "")) for i, t, g in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in cp.language_id(spark, docs, "").collect()}
    assert kept == {i for i, _, _ in rows} - set(odd)


def test_stage_keeps_all_without_labels(spark):
    import corpus_pipeline as cp
    docs = spark.createDataFrame([(1, "some text", None, "s", 9), (2, "12", None, "s", 2)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    assert cp.language_id(spark, docs, "").count() == 2


def test_scripts_of_many_letters(spark):
    """Two labels in Han with disjoint characters, two in Cyrillic, Greek, Hangul and Latin."""
    rnd = random.Random(11)
    alphabets = {"zh": [chr(0x4E00 + i) for i in range(0, 3000)], "ja": [chr(0x6000 + i) for i in range(0, 3000)],
                 "ru": list("абвгдежзийклмнопрстуфхцчшщъыьэюя"), "bg": list("абвгдежзийклмнопрстуфхцчшщъьюя"),
                 "el": list("αβγδεζηθικλμνξοπρστυφχψω"), "ko": [chr(0xAC00 + 7 * i) for i in range(1200)],
                 "en": list("abcdefghijklmnopqrstuvwxyz")}
    words = {g: ["".join(rnd.choice(a) for _ in range(rnd.randint(2, 5))) for _ in range(400)] for g, a in alphabets.items()}
    train = spark.createDataFrame([(i, spoken(rnd, words[g]), g) for i, g in enumerate(list(words) * 30)],
                                  "doc_id long, text string, lang string")
    model = langid.fit_language_model(train)
    assert model.step.nbytes < 200 << 20
    for g in words:
        assert set(model.predict([spoken(rnd, words[g], n) for n in (5, 20, 200)])[0]) == {g}
    never = "".join(chr(0x0E01 + rnd.randrange(40)) for _ in range(300))  # a script that was never learned
    assert model.told([never, spoken(rnd, words["zh"], 100), spoken(rnd, words["bg"], 100)]).tolist() == [False, True, True]


def test_spelled_letters_are_told_apart():
    rnd = random.Random(3)
    letters = [chr(0x4E00 + 5 * i) for i in range(2500)] + list("abcdefghij")
    text = "".join(rnd.choice(letters) for _ in range(6000)) + "abcdefghij" * 500
    model = langid.build_model({"x": [text, "".join(letters)]})
    spelled = {bytes(model.symbols(c)) for c in letters}
    assert len(spelled) == len(letters) and model.step.size < 1 << 31
    assert bytes(model.symbols(text)) == b"".join(bytes(model.symbols(c)) for c in text)
    assert len(model.symbols("a")) == 1  # the commonest stay single
    symbols = [model.symbols(t) for t in (text[100:700], "龥" + text[:40], "a龥b")]
    joined = bytes(model.symbols(text)) + b"\xff" + bytes(model.symbols("".join(letters))) + b"\xff"
    other = int(model.lookup.max())
    want = [phrases_by_search(joined, bytes(254 if x == other else x for x in s)) for s in symbols]
    assert model.phrases(symbols)[:, 0].tolist() == want


def test_many_labels_bound_the_model(spark, monkeypatch):
    monkeypatch.setattr(langid, "MODEL_SYMBOLS", 20_000)
    rnd = random.Random(5)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    words = {f"l{i:02d}": ["".join(rnd.choice(letters) for _ in range(6)) for _ in range(12)] for i in range(40)}
    rows = [(i, spoken(rnd, words[g], 30), g) for i, g in enumerate(list(words) * 6)]
    rows.append((len(rows), spoken(rnd, words["l00"], 50_000), "l00"))  # one very long text
    model = langid.fit_language_model(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.step.size < 4 * 20_000 * 28
    assert model.predict([spoken(rnd, words[g], 10) for g in words])[0] == list(words)
