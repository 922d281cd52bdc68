import random

import numpy as np
import pytest

from procura.llm import language as lang


def substring_phrases(word, text):
    """Greedy phrases of ``word`` over the substrings of ``text``."""
    n, at = 0, 0
    while at < len(word):
        end = at + 1
        while end < len(word) and word[at:end + 1] in text:
            end += 1
        n, at = n + 1, end
    return n


def test_automaton_and_phrases_against_substrings():
    rng = random.Random(1)
    for _ in range(20):
        text = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 60)))
        code = {c: i for i, c in enumerate("abc z")}
        table = lang.automaton(text, code)
        words = sorted(("".join(rng.choice("abcz?") for _ in range(rng.randint(1, 12))) + " " for _ in range(50)),
                       key=len, reverse=True)
        sizes = np.array([len(w) for w in words])
        codes = np.zeros((len(words), sizes[0]), np.int32)
        for i, w in enumerate(words):
            codes[i, :len(w)] = [code.get(c, len(code)) for c in w]
        assert lang.count_phrases(table, codes, sizes).tolist() == [substring_phrases(w, text) for w in words]


def brute(text, training):
    words = lang.words_of(text or "")
    if not words or not training:
        return "und"
    chars = sum(len(w) + 1 for w in words)
    cost = {k: sum(substring_phrases(w + " ", t) for w in words) * np.log2(len(t) + 1) / chars for k, t in training.items()}
    return min(sorted(cost), key=lambda k: round(cost[k], 12))


def test_identify_against_brute_force(spark, table):
    rng = random.Random(2)
    parts = {"xa": "ba ke lu".split(), "xb": "ist ner ung".split(), "xc": "ère ção ñe".split()}

    def text(k, n):
        return " ".join("".join(rng.choice(parts[k]) for _ in range(rng.randint(1, 4))).capitalize() for _ in range(n))

    rows = [(i, text(k, rng.randint(1, 40)), k) for i, k in enumerate(rng.choices(list(parts), k=150))]
    rows += [(900, None, "xa"), (901, "", "xb"), (902, "12 !! _", None), (903, "北京", None), (904, text("xb", 6000), None),
             (3, rows[3][1], "xc"), (None, text("xc", 9), "xa")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as score", "'q' as lang_pred")
    training = lang.training_text(df)
    assert set(training) == set(parts)
    out = lang.identify(df.repartition(3), lang.train(training)).collect()
    assert len(out) == len(rows)
    want = {(d, t): brute(t, training) for d, t, _ in rows if d != 3}
    right = 0
    for r in out:
        if r.doc_id != 3:
            (t,) = [t for d, t, _ in rows if d == r.doc_id]
            assert r.lang_pred == want[(r.doc_id, t)]
            assert 0 <= r.score <= 1 and (r.lang_pred != "und" or r.score == 0)
            right += r.doc_id is not None and r.doc_id < 900 and r.lang_pred == rows[r.doc_id][2]
    assert right > 140


def test_held_out_and_foreign_columns_are_not_learnt_from(spark):
    import zlib
    rows = [(i, "abba" if zlib.crc32(str(i).encode()) % 4 != 2 else "zyzzy", "k") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert "z" not in lang.training_text(df)["k"]
    out = lang.identify(df, lang.train(lang.training_text(df))).collect()
    assert {r.doc_id for r in out if r.held_out} == {i for i, t, _ in rows if t == "zyzzy"}


def test_nothing_to_learn_from_and_empty_table(spark):
    df = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    model = lang.train(lang.training_text(df))
    assert [(r.lang_pred, r.score) for r in lang.identify(df, model).collect()] == [("und", 0.0)]
    assert lang.identify(df.limit(0), model).collect() == []


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    out = lang.op7_language_id(spark, f"/root/testdata/{sf}").join(docs, "doc_id").filter("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in out) / len(out) > 0.97


def labelled(spark, texts):
    """Documents that may be learnt from, ids counting up over ``texts``."""
    import zlib
    ids = (i for i in range(10 ** 6) if zlib.crc32(str(i).encode()) % 4 != 2)
    return spark.createDataFrame([(next(ids), t, k) for k, ts in texts.items() for t in ts],
                                 "doc_id long, text string, lang string").repartition(3)


def test_languages_of_long_or_short_documents_alone_are_learnt(spark):
    texts = {"long": ["lomba renke " * 6_000] * 40, "one": ["sufi tarka " * 20_000], "short": ["gip zed"] * 9_000,
             "block": ["ж" * 90_000] * 3, "digits": ["12 34"] * 20_000}
    training = lang.training_text(labelled(spark, texts))
    assert set(training) == {"long", "one", "short", "block"}
    for k, t in training.items():
        assert 0.9 * lang.TRAIN_CHARS <= len(t) <= lang.TRAIN_CHARS + 2, k
        assert set(t.split()) <= {w for d in texts[k] for w in d.split()} or k == "block"
    out = lang.identify(spark.createDataFrame([(1, "renke lomba"), (2, "tarka sufi"), (3, "zed gip")], "doc_id long, text string"),
                        lang.train(training)).collect()
    assert {r.doc_id: r.lang_pred for r in out} == {1: "long", 2: "one", 3: "short"}


def test_one_long_document_fills_what_others_leave(spark):
    training = lang.training_text(labelled(spark, {"k": ["abc"] * 10 + ["lomba renke " * 10_000]}))
    assert 0.9 * lang.TRAIN_CHARS <= len(training["k"]) <= lang.TRAIN_CHARS + 2


def test_letters_and_marks():
    assert lang.words_of("हिन्दी भाषा") == ["हिन्दी", "भाषा"] and lang.words_of("ภาษาไทยนี้ดี") == ["ภาษาไทยนี้ดี"]
    assert lang.words_of("½ ² ① Ⅷ ٣ ́ _ 7") == [] and lang.words_of("É2a_b") == ["é", "a", "b"]
    import re
    import unicodedata
    for c in map(chr, range(0x3000)):
        assert bool(re.fullmatch(lang._WORD, c)) == unicodedata.category(c).startswith("L"), hex(ord(c))


def test_a_text_of_number_signs_is_undetermined(spark):
    docs = spark.createDataFrame([(k, "one two three four", "en") for k in range(8)] + [(20, "½ ² ①", "en"), (21, "ab", None)],
                                 "doc_id long, text string, lang string")
    out = {r.doc_id: r for r in lang.identify(docs, lang.train(lang.training_text(docs))).collect()}
    assert out[20].lang_pred == "und" and out[20].score == 0 and out[21].lang_pred == "en"


def test_plain_texts_have_the_same_words():
    rng = random.Random(5)
    every = [chr(c) for c in (*range(0x300), *range(0x2000, 0x2070), *range(0x20a0, 0x20d0))]
    for c in every:
        assert lang._PLAIN.findall(c) == lang._WORD.findall(c), hex(ord(c))
    for _ in range(300):
        text = "".join(rng.choice(every + ["a", "é", " "] * 60) for _ in range(60))
        assert lang.words_of(text) == lang._WORD.findall(text.lower())
